"""A raw product catalogue made from the whole ``part`` table, and its search index.

Every part is a product.  Its fields are written the way a raw catalogue writes
them: numbers as text with signs and units, missing values, key-value text.
Vectors come from ``embeddings``; parts beyond its size share vectors, so groups
of exact copies occur.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from kindred.functions.vectors import floats, l2_normalize
from kindred.plans.build import build_index, load_or_build
from kindred.session import scratch_root, stored
from kindred.sources.artifacts import SearchIndex
from kindred.sources.catalogue import clean

TOP_N_BRANDS = 10
TOP_N_COLORS = 5
N_CELLS = 32

# Read by both engines: it makes the input, it does not check anything.
RAW_SQL = """
select
  cast(p_partkey as string) as uniq_id,
  p_name as product_name,
  case when p_partkey % 19 = 0 then null else p_brand end as brand,
  case when p_partkey % 31 = 0 then '$1,' || cast(p_retailprice as string)
       when p_partkey % 37 = 0 then 'n/a'
       else '$' || cast(p_retailprice as string) end as sales_price,
  case when p_size % 7 = 0 then '999999999'
       when p_size % 5 = 0 then cast(p_size as string) || ' g'
       else cast(p_size as string) || 'g' end as weight,
  case when p_partkey % 17 = 0 then null else cast(p_size / 10e0 as string) end as rating,
  case when p_partkey % 23 = 0 then null
       when p_partkey % 29 = 0 then '{{''' || p_type || ''': ''Men''s''}}'
       when p_partkey % 13 = 0 then '{{"Womens": "#1", "' || p_type || '": "#2"}}'
       when p_partkey % 11 = 0 then '{{''Mens'': ''#1'', ''' || p_type || ''': ''#2''}}'
       else '{{''' || p_type || ''': ''#1'', ''Size ' || cast(p_size as string) || ''': ''#2''}}'
       end as parent___child_category__all,
  case when p_partkey % 25 = 0 then 'ftp://img.example.com/' || cast(p_partkey as string)
       when p_partkey % 41 = 0 then null
       else 'http://img.example.com/' || cast(p_partkey as string) || '.jpg |http://img.example.com/b.jpg'
       end as medium,
  case when p_partkey % 43 = 0 then null
       else p_name || ', ' || p_type || ', ' || p_brand || ', ' || p_name end as meta_keywords,
  case when p_size % 4 = 0 then null when p_size % 4 = 1 then 'store' else 'merchant' end as delivery_type,
  case when p_size % 3 = 0 then 'Y' when p_size % 3 = 1 then 'y' when p_size = 5 then null else 'N' end
    as amazon_prime__y_or_n,
  case when coalesce(reviews, 0) > 30 then 'Y' else 'N' end as best_seller_tag__y_or_n,
  case when p_partkey % 47 = 0 then '  ' else ' ' || upper(split_part(p_name, ' ', 1)) || ' ' end as colour,
  case when p_partkey % 53 = 0 then null
       when p_partkey % 3 = 0 then '{{"Colour": " ' || split_part(p_name, ' ', 1) || '", "color": "x"}}'
       when p_partkey % 3 = 1 then '{{''Color'': ''' || upper(split_part(p_name, ' ', 1)) || ' '', ''Fit'': ''slim''}}'
       else '{{''Colour'': ''Blue'', ''Fit'': ''slim''}}' end as product_details__k_v_pairs,
  cast(floor(discount_points * 100 / cast(reviews as double)) / 100 as string) || '%' as discount_percentage,
  cast(reviews as string) as no__of_reviews
from {part} left join (
  select l_partkey, count(*) as reviews, sum(cast(round(l_discount * 100) as bigint)) as discount_points
  from {lineitem} group by l_partkey
) on l_partkey = p_partkey
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, spread over the cores: the test file is a single split, unlike a large table."""
    docs = table(spark, sf_dir, "documents")
    cores = spark.sparkContext.defaultParallelism
    return docs.repartition(cores) if docs.rdd.getNumPartitions() < cores else docs


def raw_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_SQL, part=table(spark, sf_dir, "part"), lineitem=table(spark, sf_dir, "lineitem"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(raw_catalogue(spark, sf_dir))


def product_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(uniq_id, text_vector, image_vector): the halves of an embedding; some images are missing."""
    part = table(spark, sf_dir, "part").select("p_partkey")
    embeddings = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    n = embeddings.count()
    joined = part.join(embeddings, F.col("p_partkey") % n == F.col("vec_id"))
    image = floats(l2_normalize(F.slice("embedding", 33, 32)))
    zero = F.array_repeat(F.lit(0.0).cast("float"), 32)
    return joined.select(
        F.col("p_partkey").cast("string").alias("uniq_id"),
        floats(l2_normalize(F.slice("embedding", 1, 32))).alias("text_vector"),
        F.when(F.col("p_partkey") % 25 == 0, zero).otherwise(image).alias("image_vector"),
    )


def own_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A path of this application for tables made from ``sf_dir``."""
    folder = hashlib.sha256(sf_dir.rstrip("/").encode()).hexdigest()[:16]
    return f"{scratch_root(spark)}/kindred/{spark.sparkContext.applicationId}/{name}-{folder}"


def index_path(spark: SparkSession, sf_dir: str) -> str:
    return own_path(spark, sf_dir, "index")


def build(spark: SparkSession, sf_dir: str, path: str) -> SearchIndex:
    # read by the checks and by the joins of the build: made once
    vectors = stored(product_vectors(spark, sf_dir), "product-vectors")
    return build_index(
        products(spark, sf_dir),
        vectors.select("uniq_id", "text_vector"),
        path,
        image_vectors=vectors.select("uniq_id", "image_vector"),
        top_n_brands=TOP_N_BRANDS,
        top_n_colors=TOP_N_COLORS,
        n_cells=N_CELLS,
    )


def search_index(spark: SparkSession, sf_dir: str) -> SearchIndex:
    """The index of the catalogue: built by the first query of an application, opened by the others."""
    return load_or_build(spark, index_path(spark, sf_dir), lambda path: build(spark, sf_dir, path))
