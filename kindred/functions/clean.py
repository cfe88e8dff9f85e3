"""Column expressions that turn raw catalogue fields into typed values.

Every function takes a column and returns a column, so a whole cleaning step is
one projection that Spark can prune and push down.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from kindred.config import WEIGHT_SENTINEL

# The characters a Python ``str.strip``/``str.split`` treats as blank.
BLANK = r"[\s\p{Z}\x1c-\x1f\x85]"

# The colour keys, in order of preference.
COLOR_KEYS = ("Colour", "Color", "colour", "color")
COLOR_TEXT = r"'(?:Colour|Color|colour|color)': '([^']+)'"

NUMBER = r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$"

# Single quotes do not delimit JSON strings, although Spark would accept them.
_JSON = {"allowSingleQuotes": "false"}


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{BLANK}+|{BLANK}+$", "")


def text_or(c: Column, default: str) -> Column:
    """Text with a default for null."""
    return F.coalesce(c.cast("string"), F.lit(default))


def numeric(c: Column, strip_chars: str = "first") -> Column:
    """A number from text such as ``$200.00``; null when none can be read.

    ``strip_chars="first"`` drops only the first foreign character, so
    ``$1,200.00`` gives null; ``"all"`` drops every one.
    """
    text = c.cast("string")
    if strip_chars == "first":
        text = F.regexp_replace(text, r"^([\p{Nd}.]*)[^\p{Nd}.]", "$1")
    elif strip_chars == "all":
        text = F.regexp_replace(text, r"[^\p{Nd}.]", "")
    else:
        raise ValueError(f"strip_chars must be 'first' or 'all', not {strip_chars!r}")
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def below_sentinel(c: Column, sentinel: float = WEIGHT_SENTINEL) -> Column:
    """Null for values at or above the marker for 'unknown'."""
    return F.when(c < F.lit(sentinel), c)


def yes_flag(c: Column) -> Column:
    """P5: 1 for y/Y, else 0."""
    return F.coalesce((F.upper(c.cast("string")) == "Y").cast("int"), F.lit(0))


def plain_color(c: Column) -> Column:
    """Trimmed lower-case colour; blank and null give ``unknown``."""
    value = F.lower(strip(F.coalesce(c.cast("string"), F.lit(""))))
    return F.when(value == "", F.lit("unknown")).otherwise(value)


def as_kv(c: Column, dtype: T.DataType) -> Column:
    """A key-value field as a map; null where the value is not an object."""
    if isinstance(dtype, T.MapType):
        return c
    if isinstance(dtype, T.StructType):
        raise TypeError("read key-value fields as text or map: a struct carries the keys of all rows")
    return F.from_json(c, "map<string,string>", _JSON)


def kv_color(c: Column, dtype: T.DataType = T.StringType(), null_result: str | None = None) -> Column:
    """Colour from a key-value field given as an object or as quoted text."""
    kv = as_kv(c, dtype)
    from_map = F.coalesce(
        *[F.lower(strip(F.try_element_at(kv, F.lit(key)))) for key in COLOR_KEYS], F.lit("unknown")
    )
    if isinstance(dtype, T.MapType):
        return F.when(c.isNotNull(), from_map).otherwise(F.lit(null_result))
    found = F.nullif(F.regexp_extract(c, COLOR_TEXT, 1), F.lit(""))
    from_text = F.when(
        F.contains(F.lower(c), F.lit("color")), F.coalesce(F.lower(strip(found)), F.lit("unknown"))
    ).otherwise(F.lit("unknown"))
    return (
        F.when(c.isNull(), F.lit(null_result)).when(kv.isNotNull(), from_map).otherwise(from_text)
    )


def category_keys(c: Column, dtype: T.DataType = T.StringType(), null_result: str | None = None) -> Column:
    """The keys of a key-value field, joined by a space, in document order."""

    def keys(kv: Column) -> Column:
        return F.array_join(F.array_distinct(F.map_keys(kv)), " ")

    kv = as_kv(c, dtype)
    if isinstance(dtype, T.MapType):
        return F.when(c.isNotNull(), keys(kv)).otherwise(F.lit(null_result))
    requoted = F.when(
        F.startswith(c, F.lit("{")) & F.endswith(strip(c), F.lit("}")),
        F.from_json(F.translate(c, "'", '"'), "map<string,string>", _JSON),
    )
    return F.when(c.isNull(), F.lit(null_result)).otherwise(
        F.coalesce(keys(kv), keys(requoted), F.lit("unknown"))
    )


def first_url(c: Column, null_result: str | None = None) -> Column:
    """The first of the URLs joined by ``|`` when it is an http(s) one, else blank."""
    head = F.split_part(c, F.lit("|"), F.lit(1))
    return F.when(c.isNull(), F.lit(null_result)).otherwise(
        F.when(F.startswith(head, F.lit("http")), strip(head)).otherwise(F.lit(""))
    )


def has_http_url(c: Column) -> Column:
    """whether a URL can be fetched at all."""
    return F.coalesce(F.startswith(c, F.lit("http")), F.lit(False))


def profile_price(c: Column) -> Column:
    """First number in a price text after dropping ``$`` and ``,``."""
    digits = F.regexp_extract(F.translate(c, "$,", ""), r"\p{Nd}+\.?\p{Nd}*", 0)
    return F.when(digits != "", digits.try_cast("double"))
