import numpy as np

from kindred.config import Limits
from kindred.operators.profile import frequent_values, histogram, missing_profile
from kindred.operators.sample import first_middle_last, nth_id, seeded_sample


def test_missing(spark):
    df = spark.createDataFrame([(1, None, None), (2, "x", None)], "a int, b string, c string")
    assert [tuple(r) for r in missing_profile(df).collect()] == [("c", 100.0), ("b", 50.0)]


def test_frequent(spark):
    df = spark.createDataFrame([(x,) for x in ["b", "a", "b", "c", "a", None]], "v string")
    assert [tuple(r) for r in frequent_values(df, "v", 2).collect()] == [("a", 2), ("b", 2)]


def test_histogram_equals_numpy(spark):
    x = np.random.default_rng(1).gamma(2.0, 120.0, size=2000)
    df = spark.createDataFrame([(float(a),) for a in x] + [(None,), (float("nan"),)], "p double")
    rows = histogram(df, "p").orderBy("bin").collect()
    counts, edges = np.histogram(x[x < 500], bins=50)
    assert [r["n"] for r in rows] == list(counts)
    assert np.allclose([r["low"] for r in rows], edges[:-1]) and np.allclose(rows[-1]["high"], edges[-1])
    assert histogram(df.where("false"), "p").count() == 0
    same = spark.createDataFrame([(3.0,)] * 4, "p double")
    assert sum(r["n"] for r in histogram(same, "p").collect()) == 4


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(1000).selectExpr("cast(id as string) as uniq_id")
    a = {r[0] for r in seeded_sample(df.repartition(7), 50).collect()}
    assert a == {r[0] for r in seeded_sample(df.coalesce(1), 50).collect()} and len(a) == 50
    assert a != {r[0] for r in seeded_sample(df, 50, seed=1).collect()}


def test_positions(spark):
    values = sorted(f"{i * 37 % 1000:03d}é" for i in range(1000)) + ["zz", "zz1"]
    df = spark.createDataFrame([(x,) for x in values], "uniq_id string")
    tight = Limits(collect_values=3)
    for position in (0, 1, 499, 1000, 1001):
        assert nth_id(df, position, limits=tight) == nth_id(df, position) == values[position]
    assert nth_id(df, 1002, limits=tight) is None
    found = {r[0] for r in first_middle_last(df, limits=tight).collect()}
    assert found == {values[0], values[501], values[-1]}
    assert first_middle_last(df.where("false")).count() == 0
