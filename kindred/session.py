"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("kindred")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application.

    The driver serves the archive; a cluster on which the package is installed, or that got it by ``--py-files``,
    needs no call.
    """
    context = spark.sparkContext
    name = f"kindred-{context.applicationId}.zip"
    if any(file.endswith(name) for file in context._python_includes):
        return
    package = Path(__file__).resolve().parent
    archive = shutil.make_archive(
        str(Path(tempfile.mkdtemp(prefix="kindred-")) / name.removesuffix(".zip")), "zip", package.parent, package.name
    )
    context.addPyFile(archive)


def scratch_root(spark: SparkSession) -> str:
    """Folder shared by all executors, as named by ``spark.checkpoint.dir``.

    A session that names none gets a temporary one if it runs in one process; on a cluster, where executors would not see
    one another's folders, that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="kindred-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, private to this application."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/kindred/{app}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on whatever file system its scheme names."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hadoop_path))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written to the shared folder: computed once, and safe if executors are lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the tables this application wrote below the shared folder; call it when its results are done."""
    jvm = spark.sparkContext._jvm
    app = spark.sparkContext.applicationId
    own = jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/kindred/{app}")
    own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(own, True)
