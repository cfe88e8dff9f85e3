import numpy as np
import pytest

from kindred.config import Limits
from kindred.operators.encode import StructuredEncoder, StructuredModel
from kindred.operators.quantiles import exact_quantiles
from kindred.session import scratch_path
from checks.catalogue import products

COLUMNS = (
    "uniq_id string, sales_price double, rating double, discount_percentage double, no_of_reviews double, "
    "brand string, color string, delivery_type string, is_prime int, is_bestseller int"
)
ROWS = [
    ("a", 10.0, None, 5.0, 1.0, "X", "red", "fast", 1, 0),
    ("b", 20.0, 1.0, 5.0, 2.0, "X", "blue", "slow", 0, 0),
    ("c", 30.0, 3.0, 5.0, 3.0, "Y", "red", "fast", 0, 1),
    ("d", None, 2.0, 5.0, 10.0, "Z", "green", "fast", 0, 0),
]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, COLUMNS)


def vectors(df):
    return {r["uniq_id"]: list(r["structured"]) for r in df.collect()}


def test_vector(table):
    model = StructuredEncoder(top_n_brands=2, top_n_colors=1).fit(table)
    assert model.numeric["sales_price"] == (20.0, 10.0, 30.0)
    assert model.numeric["no_of_reviews"][0] == 2.5
    # equal counts are settled by value: Y before Z
    assert model.vocabulary == {"brand": ["Other", "X", "Y"], "color": ["Other", "red"], "delivery_type": ["fast", "slow"]}
    made = vectors(model.transform(table))
    # numbers (a constant column gives 0), brand, colour, delivery, flags
    assert made["a"] == [0.0, 0.5, 0.0, 0.0, 0, 1, 0, 0, 1, 1, 0, 1, 0]
    assert made["d"] == pytest.approx([0.5, 0.5, 0.0, 1.0, 1, 0, 0, 1, 0, 1, 0, 0, 0])
    assert all(len(x) == model.dim for x in made.values())


def test_unseen_values(spark, table):
    model = StructuredEncoder().fit(table)
    assert "Other" not in model.vocabulary["brand"]
    new = spark.createDataFrame([("n", 50.0, 1.0, 5.0, 1.0, "New", None, "drone", 0, 0)], COLUMNS)
    made = vectors(model.transform(new))["n"]
    assert made[0] == 2.0  # not clipped
    assert made[4:-2] == [0.0] * (model.dim - 6)


def test_other_bucket_holds_nulls_and_its_own_name(spark, table):
    more = spark.createDataFrame([("n", 1.0, 1.0, 1.0, 1.0, None, "Other", "fast", 0, 0)], COLUMNS)
    model = StructuredEncoder(3, 4).fit(table.unionByName(more))
    assert model.vocabulary["brand"] == ["Other", "X", "Y", "Z"]
    assert model.vocabulary["color"] == ["Other", "blue", "green", "red"]


def test_fit_then_transform_equals_fit_transform_and_survives_storage(spark, sf_dir):
    df = products(spark, sf_dir)
    encoder = StructuredEncoder(10, 5)
    model = encoder.fit(df)
    expected = vectors(encoder.fit_transform(df))
    assert vectors(model.transform(df)) == expected
    assert len(expected) == df.count()
    assert np.isfinite(np.array(list(expected.values()))).all()
    path = scratch_path(spark, "encoder")
    model.write(spark, path)
    assert vectors(StructuredModel.read(spark, path).transform(df)) == expected


@pytest.mark.parametrize("bound", [100_000, 40, 3])
def test_quantiles_equal_numpy(spark, bound):
    rng = np.random.default_rng(3)
    x = rng.lognormal(size=5000)
    x[::3] = 1.25  # a third of the rows hold one value
    y = np.round(rng.normal(size=5000), 1)
    rows = [(float(a), float(b)) for a, b in zip(x, y)] + [(None, float("nan"))] * 7
    df = spark.createDataFrame(rows, "x double, y double")
    points = [0.0, 0.3, 0.5, 0.95, 0.99, 1.0]
    found = exact_quantiles(df, ["x", "y"], points, Limits(collect_values=bound))
    assert found["x"] == pytest.approx(list(np.quantile(x, points)))
    assert found["y"] == pytest.approx(list(np.quantile(y, points)))


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(df, ["x"], [0.5]) == {"x": [None]}


def test_vocabulary_bound_is_an_argument(spark, table):
    with pytest.raises(ValueError, match="more than 1 values"):
        StructuredEncoder(max_vocabulary=1).fit(table)
