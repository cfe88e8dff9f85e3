"""Exact order statistics that no single task has to hold.

Spark's exact ``percentile`` merges a map of all distinct values into one task.
Here an approximate sketch brackets each wanted rank, rows below the bracket are
only counted, and the bracket is narrowed until its distinct values are few
enough to collect.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, floor

from pyspark.sql import Column, DataFrame, functions as F

from kindred.config import LIMITS, Limits

_ACCURACY = 10_000


@dataclass
class _Bracket:
    """The value at ``rank`` (0-based) of a column is known to lie in ``[low, high]``."""

    column: str
    rank: int
    inside: int
    below: int = 0
    low: float | None = None
    high: float | None = None
    margin: float = 3.0 / _ACCURACY
    value: float | None = None

    def under(self) -> Column:
        return F.lit(False) if self.low is None else F.col(self.column) < F.lit(self.low)

    def over(self) -> Column:
        return F.lit(False) if self.high is None else F.col(self.column) > F.lit(self.high)


def exact_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float], limits: Limits = LIMITS
) -> dict[str, list[float | None]]:
    """Interpolated quantiles per column; nulls and NaN are left out."""
    values = df.select(*[F.when(~F.isnan(c), F.col(c).cast("double")).alias(c) for c in columns])
    counts = values.agg(*[F.count(c).alias(c) for c in columns]).first().asDict()
    brackets: dict[tuple[str, int], _Bracket] = {}
    for c in columns:
        for p in probabilities if counts[c] else ():
            position = p * (counts[c] - 1)
            for rank in (floor(position), ceil(position)):
                brackets[c, rank] = _Bracket(c, rank, counts[c])

    unsettled = list(brackets.values())
    while unsettled:
        _narrow(values, [b for b in unsettled if b.inside > limits.collect_values])
        _settle(values, [b for b in unsettled if b.value is None], limits.collect_values)
        unsettled = [b for b in unsettled if b.value is None]

    def interpolated(c: str, p: float) -> float | None:
        if not counts[c]:
            return None
        position = p * (counts[c] - 1)
        low, high = brackets[c, floor(position)].value, brackets[c, ceil(position)].value
        return low + (high - low) * (position - floor(position))

    return {c: [interpolated(c, p) for p in probabilities] for c in columns}


def exact_median(
    df: DataFrame, columns: list[str], limits: Limits = LIMITS
) -> dict[str, float | None]:
    """A1: exact interpolated medians."""
    return {c: q[0] for c, q in exact_quantiles(df, columns, [0.5], limits).items()}


def _narrow(values: DataFrame, brackets: list[_Bracket]) -> None:
    """Replace each bracket by a sketched one, where counts prove that it holds the rank."""
    if not brackets:
        return
    sketches = []
    for i, b in enumerate(brackets):
        at = (b.rank - b.below + 0.5) / b.inside
        points = [max(0.0, at - b.margin), min(1.0, at + b.margin)]
        inside = F.when(~b.under() & ~b.over(), F.col(b.column))
        sketches.append(F.percentile_approx(inside, points, _ACCURACY).alias(str(i)))
    sketched = values.agg(*sketches).first()
    tried = [
        _Bracket(b.column, b.rank, 0, 0, sketched[i][0], sketched[i][1])
        for i, b in enumerate(brackets)
    ]
    counted = values.agg(
        *[F.count_if(t.under()).alias(f"below{i}") for i, t in enumerate(tried)],
        *[F.count_if(~t.under() & ~t.over()).alias(f"inside{i}") for i, t in enumerate(tried)],
    ).first()
    for i, (b, t) in enumerate(zip(brackets, tried)):
        below, inside = counted[f"below{i}"], counted[f"inside{i}"]
        if below <= b.rank < below + inside:
            b.low, b.high, b.below, b.inside = t.low, t.high, below, inside
            b.value = t.low if t.low == t.high else None
        else:
            b.margin *= 4


def _settle(values: DataFrame, brackets: list[_Bracket], bound: int) -> None:
    """Pick the values of all brackets at once, unless too many distinct ones are left."""
    if not brackets:
        return
    tagged = F.array(
        *[
            F.when(
                F.col(b.column).isNotNull() & ~b.under() & ~b.over(),
                F.struct(F.lit(i).alias("bracket"), F.col(b.column).alias("value")),
            )
            for i, b in enumerate(brackets)
        ]
    )
    rows = (
        values.select(F.explode(F.array_compact(tagged)).alias("t"))
        .groupBy("t.bracket", "t.value")
        .count()
        .limit(bound * len(brackets) + 1)
        .collect()
    )
    if len(rows) > bound * len(brackets):
        for b in brackets:
            b.inside = max(b.inside, bound + 1)
        return
    for i, b in enumerate(brackets):
        seen = b.below
        for value, count in sorted((r["value"], r["count"]) for r in rows if r["bracket"] == i):
            seen += count
            if seen > b.rank:
                b.value = value
                break
