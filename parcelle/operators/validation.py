"""Row filters by rule, and the report of what they drop."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(*columns: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def in_range(column: str, low: float | None = None, high: float | None = None) -> Column:
    """Inclusive; a missing value or NaN is out of range.

    NaN sorts above every number, so an upper bound already excludes it.
    """
    c = F.col(column)
    if high is not None:
        return c.between(low, high) if low is not None else c <= high
    return F.nanvl(c.cast("double"), F.lit(None).cast("double")) >= low


def keep_valid(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, rules.values()))


def reject_report(df: DataFrame, rules: Mapping[str, Column], source: str) -> DataFrame:
    """Rows each rule drops, rules taken in order, in one pass over the data."""
    alive: Column = F.lit(True)
    counts = []
    for name, rule in rules.items():
        passed = F.coalesce(rule, F.lit(False))
        counts.append(F.count_if(alive & ~passed).alias(name))
        alive = alive & passed
    one = df.agg(*counts)
    rows = F.array(*(F.struct(F.lit(n).alias("rule"), F.col(n).alias("rejected")) for n in rules))
    return one.select(F.lit(source).alias("source"), F.explode(rows).alias("_r")).select(
        "source", "_r.rule", "_r.rejected"
    )


def where_given(df: DataFrame, filters: Mapping[str, object | None]) -> DataFrame:
    """Equality filters; one without a value is left out."""
    for column, value in filters.items():
        if value is not None:
            df = df.where(F.col(column) == F.lit(value))
    return df
