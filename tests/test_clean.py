import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from kindred.functions import clean as c, text as t
from kindred.session import scratch_path
from kindred.sources.catalogue import CLEAN_SCHEMA, clean, duplicate_ids, load_and_clean, product_card, read_raw

STRING = T.StringType()


def column(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


def test_numeric(spark):
    values = ["200.00", "₹200.5", "10%", "$1,200.00", "", ".", None, "1.2.3", "$5d", "12g", "12 g", "-5"]
    first = [200.0, 200.5, 10.0, None, None, None, None, None, None, 12.0, None, 5.0]
    every = [200.0, 200.5, 10.0, 1200.0, None, None, None, None, 5.0, 12.0, 12.0, 5.0]
    assert column(spark, values, c.numeric) == first
    assert column(spark, values, lambda x: c.numeric(x, "all")) == every
    with pytest.raises(ValueError):
        c.numeric(F.col("x"), "some")


def test_sentinel(spark):
    weights = column(spark, ["999999999", "1000000000", "12"], lambda x: c.below_sentinel(c.numeric(x)))
    assert weights == [None, None, 12.0]


def test_flag(spark):
    assert column(spark, ["y", "Y", "N", None], c.yes_flag) == [1, 1, 0, 0]


def test_plain_color(spark):
    assert column(spark, [" Navy Blue ", "  ", None, " Red\x1f"], c.plain_color) == [
        "navy blue", "unknown", "unknown", "red",
    ]


def test_kv_color(spark):
    values = [
        '{"Color": "Red", "Colour": "Blue"}', "{'Color': ' Red'}", "{'Colour': 'Blue'}", "junk", None, '{"Fit": "x"}',
    ]
    expected = ["blue", "red", "unknown", "unknown", None, "unknown"]
    assert column(spark, values, lambda x: c.kv_color(x, STRING)) == expected
    assert column(spark, values, lambda x: c.kv_color(x, STRING, "unknown"))[4] == "unknown"


def test_kv_as_map(spark):
    kind = T.MapType(STRING, STRING)
    values = [{"color": " X "}, {}, None]
    assert column(spark, values, lambda x: c.kv_color(x, kind), "map<string,string>") == ["x", "unknown", None]
    assert column(spark, values, lambda x: c.category_keys(x, kind), "map<string,string>") == ["color", "", None]
    with pytest.raises(TypeError):
        c.as_kv(F.col("x"), T.StructType())


def test_category_keys(spark):
    values = [
        "{'B': '#1', 'A': '#2'}", "{'A': 'Men's'}", "{}", "junk", None, '{"A": "Men\'s", "B": "1"}', "{'A': '1'} x",
        '{"A": "1", "A": "2"}',
    ]
    expected = ["B A", "unknown", "", "unknown", None, "A B", "unknown", "A"]
    assert column(spark, values, lambda x: c.category_keys(x, STRING)) == expected


def test_first_url(spark):
    values = ["http://a/1.jpg|http://a/2.jpg", "ftp://x", None, " http://a", "http://a |b", ""]
    assert column(spark, values, c.first_url) == ["http://a/1.jpg", "", None, "", "http://a", ""]
    assert column(spark, values, c.has_http_url) == [True, False, False, False, True, False]


def test_profile_price(spark):
    assert column(spark, ["$1,200.50", "from 7.", "none", None], c.profile_price) == [1200.5, 7.0, None, None]


def test_audience(spark):
    names = ["Mens Shirt", "Womens Top", "Female Watch", "Boys Cap", "Scarf", "the man in", "Men"]
    classes = column(spark, names, lambda x: t.audience(F.lit("c"), x))
    assert classes == ["Men", "Women", "Women", "Men", "Unisex", "Men", "Unisex"]


def test_texts(spark):
    assert column(spark, [" A  b\tA c ", "", None], t.tokens) == [["a", "b", "a", "c"], [], []]
    row = spark.createDataFrame([("Shirt", " ", "unknown", "a  b c d", "k" * 200)], "n string, b string, c string, g string, k string")
    text = row.select(t.embedding_text(*[F.col(x) for x in "nbcgk"])).first()[0]
    assert text == "Shirt | a b c | " + "k" * 150
    nulls = spark.createDataFrame([("Shirt", "B", None, None, "")], "n string, b string, c string, g string, k string")
    assert nulls.select(t.embedding_text(*[F.col(x) for x in "nbcgk"])).first()[0] == "Shirt | B | None | None"
    long = nulls.select(t.long_pair_text(F.col("n"), F.col("b"), F.col("c"), F.col("g"))).first()[0]
    assert long == "Audience: Unisex | Category: None | Item: Shirt | Color: None | Brand: B"


def record(**changes):
    base = {
        "uniq_id": "a", "product_name": "Mens Shirt", "brand": None, "sales_price": "$200.00", "weight": 999999999,
        "rating": "4.5", "parent___child_category__all": {"Tops": "#1", "Mens": "#2"}, "medium": "http://i/1|http://i/2",
        "meta_keywords": "k", "delivery_type": None, "amazon_prime__y_or_n": "y", "best_seller_tag__y_or_n": None,
        "product_details__k_v_pairs": {"Colour": " Navy "},
    }
    return {k: v for k, v in (base | changes).items() if v != "absent"}


@pytest.fixture()
def write(tmp_path):
    def save(*records):
        path = tmp_path / "raw.ldjson"
        path.write_text("".join(json.dumps(x) + "\n" for x in records))
        return str(path)

    return save


def test_load_and_clean(spark, write):
    path = write(record(), record(uniq_id="b", parent___child_category__all="{'X': '1'}", weight="12g"))
    df = load_and_clean(spark, path)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in CLEAN_SCHEMA]
    a, b = df.orderBy("uniq_id").collect()
    named = load_and_clean(spark, path, columns=list(record()))
    assert sorted(named.collect()) == sorted(df.collect())
    assert (a.brand, a.delivery_type, a.color, a.categories) == ("Unknown", "unknown", "navy", "Tops Mens")
    assert (a.sales_price, a.weight, a.rating, a.image_url) == (200.0, None, 4.5, "http://i/1")
    assert (a.is_prime, a.is_bestseller, a.discount_percentage, a.no_of_reviews) == (1, 0, 0.0, 0.0)
    assert (b.categories, b.weight) == ("X", 12.0)


def test_optional_columns(spark, write):
    df = load_and_clean(spark, write(record(colour=" RED ", discount_percentage="10%", no__of_reviews=None)))
    row = df.first()
    assert (row.color, row.discount_percentage, row.no_of_reviews) == ("red", 10.0, 0.0)


def test_missing_columns(spark, write):
    with pytest.raises(ValueError, match="rating"):
        read_raw(spark, write(record(rating="absent")))
    with pytest.raises(ValueError, match="colour"):
        load_and_clean(spark, write(record(product_details__k_v_pairs="absent")))


def test_duplicates_and_card(spark, write):
    df = load_and_clean(spark, write(record(), record(), record(uniq_id="b")))
    assert [r["uniq_id"] for r in duplicate_ids(df).collect()] == ["a"]
    nan = df.withColumn("rating", F.lit(float("nan")))
    assert product_card(nan).first()["rating"] is None


def test_cleaning_works_on_a_stream(spark, write):
    path = write(record(), record(uniq_id="b"))
    schema = read_raw(spark, path).schema
    stream = clean(spark.readStream.schema(schema).json(str(Path(path).parent)))
    out = scratch_path(spark, "stream")
    q = (
        stream.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", out + "-log").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 2
