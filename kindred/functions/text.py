"""Texts made from product fields: for embedding, lexical search and re-ranking."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from kindred.functions.clean import BLANK, strip

# Substrings that decide the audience class, tested in this order.
WOMEN_WORDS = ("women", "woman", "girls", "girl", "lady", "ladies", "female")
MEN_WORDS = ("men ", "men'", "mens", " man ", "boys", "boy", "male")


def shown(c: Column) -> Column:
    """Text of a value the way it is printed: a null prints as ``None``."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def tokens(c: Column) -> Column:
    """Lower-case tokens between blanks; null gives no tokens."""
    parts = F.split(F.lower(F.coalesce(c, F.lit(""))), f"{BLANK}+")
    return F.array_remove(parts, "")


def embedding_text(
    name: Column, brand: Column, color: Column, categories: Column, keywords: Column
) -> Column:
    """Name | brand | colour | first three category words | 150 characters of keywords."""
    color_text = shown(color)
    words = F.array_remove(F.split(shown(categories), f"{BLANK}+"), "")
    parts = [
        shown(name),
        shown(brand),
        F.when(color_text == "unknown", F.lit("")).otherwise(color_text),
        F.array_join(F.slice(words, 1, 3), " "),
        F.substring(shown(keywords), 1, 150),
    ]
    # concat_ws leaves out nulls, which is how blank parts disappear
    return F.concat_ws(" | ", *[F.when(strip(p) != "", p) for p in parts])


def lexical_text(name: Column, brand: Column, categories: Column) -> Column:
    """Text of a product in the lexical index, and of a product used as query."""
    blank = F.lit("")
    return F.concat_ws(
        " ", F.coalesce(name, blank), F.coalesce(brand, blank), F.coalesce(categories, blank)
    )


def short_pair_text(name: Column, brand: Column, categories: Column) -> Column:
    """Text shown to the pair scorer when only ids are wanted."""
    return F.concat_ws(" ", shown(name), shown(brand), shown(categories))


def audience(categories: Column, name: Column) -> Column:
    """Women, Men or Unisex by substrings of categories and name."""
    text = F.lower(F.concat_ws(" ", shown(categories), shown(name)))
    return (
        F.when(text.rlike("|".join(WOMEN_WORDS)), F.lit("Women"))
        .when(text.rlike("|".join(MEN_WORDS)), F.lit("Men"))
        .otherwise(F.lit("Unisex"))
    )


def long_pair_text(
    name: Column, brand: Column, color: Column, categories: Column
) -> Column:
    """Labelled text shown to the pair scorer for detailed answers."""
    return F.concat(
        F.lit("Audience: "), audience(categories, name),
        F.lit(" | Category: "), shown(categories),
        F.lit(" | Item: "), shown(name),
        F.lit(" | Color: "), shown(color),
        F.lit(" | Brand: "), shown(brand),
    )
