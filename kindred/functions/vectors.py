"""Vector columns: arrays of float, computed in double precision."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from kindred.config import IMAGE_WEIGHT, TEXT_STRUCT_WEIGHT


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def floats(v: Column) -> Column:
    return v.cast("array<float>")


def dot(a: Column, b: Column) -> Column:
    """V2: inner product of two arrays of equal length."""
    products = F.zip_with(doubles(a), doubles(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it.

    Array functions are interpreted, and Spark does not share their repeated
    arguments; nested uses would multiply.
    """
    return F.transform(F.array(value), body)[0]


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(doubles(v), F.lit(0.0), lambda s, x: s + x * x))


def squared_l2(a: Column, b: Column) -> Column:
    """V3: squared Euclidean distance; lower is closer."""
    diffs = F.zip_with(doubles(a), doubles(b), lambda x, y: (x - y) * (x - y))
    return F.aggregate(diffs, F.lit(0.0), lambda s, x: s + x)


def l2_normalize(v: Column) -> Column:
    """V1: unit vector in double precision; a zero vector stays zero."""

    def divided(d: Column) -> Column:
        divisor = let(norm(d), lambda n: F.when(n == 0.0, F.lit(1.0)).otherwise(n))
        # pairing with the repeated divisor keeps it out of the per-element lambda
        return F.zip_with(d, F.array_repeat(divisor, F.size(d)), lambda x, s: x / s)

    return let(doubles(v), divided)


def scale(v: Column, factor: float) -> Column:
    return F.transform(doubles(v), lambda x: x * F.lit(float(factor)))


def fuse_two(text: Column, structured: Column) -> Column:
    """V4, V5: unit vector of text followed by the normalised structured group."""
    return l2_normalize(F.concat(doubles(text), l2_normalize(structured)))


def fuse_three(
    text: Column,
    structured: Column,
    image: Column,
    text_weight: float = TEXT_STRUCT_WEIGHT,
    image_weight: float = IMAGE_WEIGHT,
) -> Column:
    """V6: unit vector of the weighted text+structured and image groups."""
    return l2_normalize(
        F.concat(
            scale(fuse_two(text, structured), text_weight), scale(l2_normalize(image), image_weight)
        )
    )


def fused_cosine(
    cos_text_struct: Column,
    cos_image: Column,
    left_has_image: Column,
    right_has_image: Column,
    text_weight: float = TEXT_STRUCT_WEIGHT,
    image_weight: float = IMAGE_WEIGHT,
) -> Column:
    """V6 in closed form: the cosine of two fused vectors from the cosines of their groups."""
    tw, iw = text_weight**2, image_weight**2
    both = (F.lit(tw) * cos_text_struct + F.lit(iw) * cos_image) / F.lit(tw + iw)
    one = F.lit(text_weight / (tw + iw) ** 0.5) * cos_text_struct
    return (
        F.when(left_has_image & right_has_image, both)
        .when(left_has_image | right_has_image, one)
        .otherwise(cos_text_struct)
    )


def checked(v: Column, dim: int) -> Column:
    """V9: the same vector, failing the job when its length differs from ``dim``."""

    def check(x: Column) -> Column:
        bad = F.concat(F.lit(f"vector length must be {dim}, got "), F.size(x).cast("string"))
        return F.when(F.size(x) == dim, x).otherwise(F.raise_error(bad).cast("array<float>"))

    return let(v, check)
