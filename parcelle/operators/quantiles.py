"""Exact interpolated percentiles for groups of any size, in one lazy plan.

Groups are counted by a hash of their key first. Those that are surely small are
sorted, each in one task, and their percentiles and other figures come from one
shuffle of the rows. In the others a wanted rank is found in three levels
(``levels``): the values are counted by wide range, those of the ranges that hold
a wanted rank by narrow range, and those of the narrow ranges that hold it one by
one. Counts combine in the tasks, and no such group or range is gathered: a
level's running sum meets one row per range or value, whose number has a bound
that does not grow with the table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .levels import NARROW, WIDE, image, within

Quantiles = Mapping[str, tuple[str, float]]  # result column -> (value column, fraction)

#: Hash buckets that groups are counted by, and the rows up to which the groups of a bucket are sorted.
BUCKETS, SMALL = 1 << 16, 1 << 16


def group_stats(df: DataFrame, keys: Sequence[str], quantiles: Quantiles, aggs: Sequence[Column] = ()) -> DataFrame:
    """``aggs`` and exact percentiles per group; no group of more than ``SMALL`` rows is sorted."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))
    full = df.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") > SMALL)
    # At most ``BUCKETS`` numbers. Where none is full, adaptive execution drops the levels without reading a row for them.
    full = F.broadcast(full.select("_bucket"))
    small, rest = (df.join(full, bucket == F.col("_bucket"), how) for how in ("left_anti", "left_semi"))
    groups = rest.groupBy(*keys).agg(*aggs) if aggs else rest.select(*keys).distinct()
    return _sorted_stats(small, keys, quantiles, aggs).unionByName(_add_selected(groups, rest, keys, quantiles))


def _sorted_stats(df: DataFrame, keys: Sequence[str], quantiles: Quantiles, aggs: Sequence[Column]) -> DataFrame:
    """The same from the rows of each group in order, shuffled once; NaN is the highest value."""
    values = list(dict.fromkeys(c for c, _ in quantiles.values()))
    number = {c: i for i, c in enumerate(values)}
    for c, i in number.items():
        order = Window.partitionBy(*keys).orderBy(F.col(f"_v{i}").asc_nulls_last())
        whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        df = df.withColumn(f"_v{i}", F.col(c).cast("double") + 0.0).withColumns(
            {f"_at{i}": F.row_number().over(order) - 1, f"_n{i}": F.count(f"_v{i}").over(whole)})
    position = {name: F.lit(float(p)) * (F.col(f"_n{number[c]}") - 1) for name, (c, p) in quantiles.items()}

    def at(name: str, rank: Column) -> Column:
        i = number[quantiles[name][0]]
        return F.max(F.when(F.col(f"_at{i}") == rank, F.col(f"_v{i}")))

    found = {name: _interpolated(at(name, F.floor(x)), at(name, F.ceil(x)), F.max(x)).alias(name) for name, x in position.items()}
    return df.groupBy(*keys).agg(*aggs, *found.values())


def overall_stats(df: DataFrame, quantiles: Quantiles, aggs: Sequence[Column] = ()) -> DataFrame:
    """One row, even over no rows; the whole table is one group."""
    one = df.agg(*aggs, F.lit(1).alias("_all"))
    return _add_selected(one, df.withColumn("_all", F.lit(1)), ["_all"], quantiles).drop("_all")


def _interpolated(low: Column, high: Column, position: Column) -> Column:
    return low + (position - F.floor(position)) * (high - low)


def _add_selected(groups: DataFrame, df: DataFrame, keys: Sequence[str], quantiles: Quantiles) -> DataFrame:
    """Percentile columns for groups already aggregated; a group with no value has none."""
    groups = _null_safe_join(groups, select_percentiles(df, keys, quantiles), keys, "left")
    return groups.select(*keys, *[c for c in groups.columns if c not in keys])


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    renamed = right.select(*(F.col(k).alias(f"_r_{k}") for k in keys), *[c for c in right.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*(f"_r_{k}" for k in keys))


def select_percentiles(df: DataFrame, keys: Sequence[str], quantiles: Quantiles) -> DataFrame:
    """Percentiles of any number of value columns, all in the same three passes; NaN is the highest value.

    Rows meet the chosen ranges of a level by group and wide range, so where the
    groups are too many to be broadcast the passes share one shuffle.
    """
    values = list(dict.fromkeys(c for c, _ in quantiles.values()))
    keys, by = list(keys), [*keys, "_c"]
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("_c"), F.col(c).cast("double").alias("_v")) for i, c in enumerate(values)]))
    rows = (
        df.select(*keys, cells.alias("_cell")).select(*keys, "_cell._c", (F.col("_cell._v") + 0.0).alias("_v")).where("_v is not null")
        .withColumn("_image", image(F.col("_v"))).withColumn("_wide", within(F.col("_image"), WIDE))
    )
    number = {c: i for i, c in enumerate(values)}
    position = {name: F.lit(float(p)) * (F.col("_n") - 1) for name, (_, p) in quantiles.items()}
    ranks = F.array_distinct(F.flatten(F.array(*[
        F.when(F.col("_c") == number[c], F.array(F.floor(position[name]), F.ceil(position[name]))).otherwise(F.array().cast("array<bigint>"))
        for name, (c, _) in quantiles.items()])))

    wide = rows.groupBy(*by, "_wide").agg(F.count(F.lit(1)).alias("_size"))
    wide = wide.withColumn("_n", F.sum("_size").over(Window.partitionBy(*by))).withColumns({"_base": F.lit(0).cast("long"), "_ranks": ranks})
    first = F.shiftleft("_wide", WIDE)
    chosen = _holding(wide, by, "_wide").withColumns({"_from": first, "_to": first + ((1 << WIDE) - 1)})

    narrow = _inside(rows, chosen, by).groupBy(*by, "_wide", "_n", "_base", "_ranks", within(F.col("_image"), NARROW).alias("_narrow")).agg(
        F.count(F.lit(1)).alias("_size"))
    first = F.shiftleft("_narrow", NARROW)
    chosen = _holding(narrow, [*by, "_wide"], "_narrow").withColumns({"_from": first, "_to": first + ((1 << NARROW) - 1)}).drop("_narrow")

    single = _inside(rows, chosen, by).groupBy(*by, "_wide", "_n", "_base", "_ranks", "_from", "_v").agg(F.count(F.lit(1)).alias("_size"))
    hits = _holding(single, [*by, "_wide", "_from"], "_v").withColumn("_rank", F.explode("_ranks"))

    def at(name: str, rank: Column) -> Column:
        return F.max(F.when((F.col("_c") == number[quantiles[name][0]]) & (F.col("_rank") == rank), F.col("_v")))

    found = hits.groupBy(*keys).agg(*(
        c for name, x in position.items()
        for c in (
            at(name, F.floor(x)).alias(f"_low_{name}"), at(name, F.ceil(x)).alias(f"_high_{name}"),
            F.max(F.when(F.col("_c") == number[quantiles[name][0]], x)).alias(f"_at_{name}"),
        )
    ))
    return found.select(*keys, *(_interpolated(F.col(f"_low_{n}"), F.col(f"_high_{n}"), F.col(f"_at_{n}")).alias(n) for n in quantiles))


def _holding(counts: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """The counted ranges that hold a wanted rank, with those ranks; ``_base`` becomes the number of values before the range."""
    running = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    placed = counts.withColumn("_end", F.col("_base") + F.sum("_size").over(running)).withColumn("_base", F.col("_end") - F.col("_size"))
    held = F.filter("_ranks", lambda r: (r >= F.col("_base")) & (r < F.col("_end")))
    return placed.withColumn("_ranks", held).where(F.size("_ranks") > 0).drop("_size", "_end")


def _inside(rows: DataFrame, chosen: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows beside the chosen range they lie in; the bounds are no join keys, so every level deals rows out alike."""
    joined = _null_safe_join(rows, chosen, [*by, "_wide"], "inner")
    return joined.where((F.col("_image") >= F.col("_from")) & (F.col("_image") <= F.col("_to")))
