"""Profiles of a table: missing values, distributions, frequencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import group_stats, overall_stats


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column, in one pass."""
    one = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns))
    pairs = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in df.columns))
    return one.select(F.explode(pairs).alias("_p")).select("_p.*")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles, one row per column."""
    quartiles = {f"{c}|{n}": (c, p) for c in columns for n, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))}
    aggs = [
        f(c).alias(f"{c}|{n}")
        for c in columns
        for n, f in (("n", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))
    ]
    one = overall_stats(df, quartiles, aggs)
    parts = ("n", "mean", "std", "min", "q1", "median", "q3", "max")
    rows = F.array(
        *(
            F.struct(F.lit(c).alias("column_name"), *(F.col(f"`{c}|{n}`").cast("bigint" if n == "n" else "double").alias(n) for n in parts))
            for c in columns
        )
    )
    return one.select(F.explode(rows).alias("_d")).select("_d.*")


def value_counts(df: DataFrame, columns: Sequence[str], top: int | None = None) -> DataFrame:
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    ordered = counted.orderBy(F.desc("n"), *(F.asc_nulls_last(c) for c in columns))
    return ordered.limit(top) if top else ordered


def histogram(df: DataFrame, value: str, by: str, bins: int) -> DataFrame:
    """Rows per equal-width bin and group; bin 0 starts at the least value.

    The bounds are one row, so they reach the tasks as scalar subqueries.
    """
    df = df.where(F.col(value).isNotNull())
    low, high = df.agg(F.min(value)).scalar(), df.agg(F.max(value)).scalar()
    place = F.floor(F.try_divide((F.col(value) - low) * bins, high - low))
    bin_no = F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int")
    return df.groupBy(by, bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def box_stats(df: DataFrame, value: str, by: str) -> DataFrame:
    quartiles = {"q1": (value, 0.25), "median": (value, 0.5), "q3": (value, 0.75)}
    return group_stats(df, [by], quartiles, [F.min(value).alias("low"), F.max(value).alias("high")])


def upper_fence(df: DataFrame, value: str) -> DataFrame:
    """Third quartile plus one and a half interquartile ranges, over all rows."""
    q = overall_stats(df, {"q1": (value, 0.25), "q3": (value, 0.75)})
    return q.select("q1", "q3", (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("fence"))


def share(condition: Column) -> Column:
    """Share of rows that meet the condition."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))
