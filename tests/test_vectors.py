import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred.functions import vectors as v
from kindred.operators import blocks
from kindred.operators.attach import (
    attach_image_vectors, attach_text_vectors, count_present, hashed_text_vectors, is_present,
)

RNG = np.random.default_rng(0)


def frame(spark, **columns):
    n = len(next(iter(columns.values())))
    rows = [(i, *[[float(x) for x in c[i]] for c in columns.values()]) for i in range(n)]
    return spark.createDataFrame(rows, "i int, " + ", ".join(f"{c} array<float>" for c in columns))


def values(df, expr):
    return np.array([r[0] for r in df.orderBy("i").select(expr).collect()])


def test_unit_norm_and_zero(spark):
    x = RNG.random((100, 50))
    unit = values(frame(spark, x=x), v.l2_normalize(F.col("x")))
    assert np.allclose(np.linalg.norm(unit, axis=1), 1, atol=1e-6)
    zero = values(frame(spark, x=np.zeros((5, 10))), v.l2_normalize(F.col("x")))
    assert (zero == 0).all()


def test_distances(spark):
    a, b = RNG.normal(size=(20, 8)), RNG.normal(size=(20, 8))
    df = frame(spark, a=a, b=b)
    assert np.allclose(values(df, v.dot(F.col("a"), F.col("b"))), (a * b).sum(1), atol=1e-5)
    assert np.allclose(values(df, v.squared_l2(F.col("a"), F.col("b"))), ((a - b) ** 2).sum(1), atol=1e-5)


def test_fused_vectors_agree_with_the_closed_form(spark):
    n = 30
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-30)
    t, s, g = unit(RNG.normal(size=(n, 6))), RNG.random((n, 5)), unit(RNG.normal(size=(n, 4)))
    g[::3] = 0
    df = frame(spark, t=t, s=s, g=g)
    two = values(df, v.fuse_two(F.col("t"), F.col("s")))
    three = values(df, v.fuse_three(F.col("t"), F.col("s"), F.col("g")))
    assert np.allclose(np.linalg.norm(three, axis=1), 1)
    left = frame(spark, t=t, s=s, g=g).select("i", F.col("t"), F.col("s"), F.col("g"))
    right = left.select([F.col(x).alias(x + "2") for x in left.columns])
    pairs = left.join(right, F.col("i") <= F.col("i2"))
    closed = v.fused_cosine(
        (v.dot(F.col("t"), F.col("t2")) + v.dot(v.l2_normalize(F.col("s")), v.l2_normalize(F.col("s2")))) / 2,
        v.dot(F.col("g"), F.col("g2")),
        is_present(F.col("g")),
        is_present(F.col("g2")),
    )
    for r in pairs.select("i", "i2", closed.alias("c")).collect():
        assert r["c"] == pytest.approx(float(three[r["i"]] @ three[r["i2"]]), abs=1e-6)
    assert np.allclose(np.linalg.norm(two, axis=1), 1)


def test_length_check(spark):
    df = frame(spark, x=np.ones((2, 3)))
    assert values(df, v.checked(F.col("x"), 3)).shape == (2, 3)
    with pytest.raises(Exception, match="vector length must be 4, got 3"):
        df.select(v.checked(F.col("x"), 4)).collect()


def stub(dim):
    def make():
        def predict(inputs):
            return np.array([[len(x) + j for j in range(dim)] for x in inputs], dtype=np.float32)

        return predict

    return make


def test_model_vectors(spark):
    texts = spark.createDataFrame([("a", "hello"), ("b", None), ("c", "hi")], "uniq_id string, text string")
    found = {r[0]: r[2] for r in attach_text_vectors(texts, "text", stub(4), dim=4).collect()}
    expected = np.array([5, 6, 7, 8]) / np.linalg.norm([5, 6, 7, 8])
    assert np.allclose(found["a"], expected, atol=1e-6) and found["b"] == [0.0] * 4
    images = spark.createDataFrame([("a", bytearray(b"123")), ("b", None)], "uniq_id string, content binary")
    made = attach_image_vectors(images, "content", stub(3), dim=3)
    assert tuple(count_present(made, "image_vector").first()) == (1, 1)


def test_hashed_vectors(spark):
    df = spark.createDataFrame([("a", "x y"), ("b", "y x"), ("c", "z"), ("d", "")], "uniq_id string, text string")
    found = {r[0]: np.array(r[2]) for r in hashed_text_vectors(df, "text", 16).collect()}
    assert np.allclose(found["a"], found["b"]) and np.linalg.norm(found["c"]) == pytest.approx(1)
    assert not found["d"].any()


def test_sums_by_group():
    rng = np.random.default_rng(1)
    group, rows = rng.integers(0, 5, 300), rng.normal(size=(300, 7))
    expected = np.zeros((6, 7))
    np.add.at(expected, group, rows)
    assert np.allclose(blocks.sums_by(group, rows, 6), expected, rtol=0, atol=1e-12)
