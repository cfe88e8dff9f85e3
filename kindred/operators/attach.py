"""Vectors from models (V7, V8): batch inference with a model the user supplies."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import HashingTF, IDF, Normalizer
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F, types as T

from kindred.config import IMAGE_DIM, TEXT_DIM
from kindred.functions.text import tokens
from kindred.functions.vectors import checked, floats, l2_normalize, norm


def attach_vectors(
    df: DataFrame,
    source: str,
    make_predict,
    dim: int,
    output: str = "vector",
    batch_size: int = 512,
) -> DataFrame:
    """Adds unit vectors predicted from a column; a null input gives the zero vector.

    ``make_predict()`` loads the model, once per Python worker, and returns a
    function from a batch of inputs to a matrix with ``dim`` columns.
    """


    def make_masked():
        predict = make_predict()

        def masked(inputs: np.ndarray) -> np.ndarray:
            # the model sees no null; those rows get any vector here and the zero vector later
            present = np.array([x is not None and x == x for x in inputs], bool)
            out = np.zeros((len(inputs), dim), np.float32)
            if present.any():
                found = np.asarray(predict(inputs[present]), np.float32)
                if found.shape[1] != dim:
                    return np.zeros((len(inputs), found.shape[1]), np.float32)
                out[present] = found
            return out

        return masked

    predict = predict_batch_udf(make_masked, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size)
    zero = F.array_repeat(F.lit(0.0).cast("float"), dim)
    predicted = df.withColumn(output, predict(F.col(source)))
    unit = floats(l2_normalize(checked(F.col(output), dim)))
    return predicted.withColumn(output, F.when(F.col(source).isNull(), zero).otherwise(unit))


def attach_text_vectors(df: DataFrame, text: str, make_predict, dim: int = TEXT_DIM, **kw) -> DataFrame:
    """V7: text vectors, in batches of 512 texts."""
    return attach_vectors(df, text, make_predict, dim, kw.pop("output", "text_vector"), **kw)


def attach_image_vectors(df: DataFrame, content: str, make_predict, dim: int = IMAGE_DIM, **kw) -> DataFrame:
    """V8: image vectors from stored bytes, for example a ``binaryFile`` column."""
    kw.setdefault("batch_size", 32)
    return attach_vectors(df, content, make_predict, dim, kw.pop("output", "image_vector"), **kw)


def hashed_text_vectors(df: DataFrame, text: str, dim: int = TEXT_DIM, output: str = "text_vector") -> DataFrame:
    """Model-free text vectors: hashed term counts weighted by rarity, at unit length."""
    words = df.withColumn("_words", tokens(F.col(text)))
    counted = HashingTF(inputCol="_words", outputCol="_tf", numFeatures=dim).transform(words)
    weighted = IDF(inputCol="_tf", outputCol="_tfidf").fit(counted).transform(counted)
    unit = Normalizer(inputCol="_tfidf", outputCol="_unit").transform(weighted)
    return unit.withColumn(output, vector_to_array("_unit", "float32")).drop("_words", "_tf", "_tfidf", "_unit")


def is_present(vector: Column, epsilon: float = 1e-5) -> Column:
    """Whether a vector is more than the zero marker for 'missing'."""
    return norm(vector) > epsilon


def count_present(df: DataFrame, vector: str, epsilon: float = 1e-5) -> DataFrame:
    """How many vectors are there, and how many are missing."""
    return df.agg(
        F.count_if(is_present(F.col(vector), epsilon)).alias("valid"),
        F.count_if(~is_present(F.col(vector), epsilon)).alias("dead"),
    )
