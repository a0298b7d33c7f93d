"""Ranks over partitions of any size.

``rank()`` sorts a whole partition in one task. Here equal values are counted
first, and the rows before a value are added up in levels (``levels``): those of
lower wide ranges, those of lower narrow ranges in its wide one, and those of
lower values in its narrow one. A running sum meets one row per range, not the
partition's values. The ranges are fixed by the values alone: sampled ones could
differ between the branches of a plan. Null keys form partitions like any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .levels import NARROW, WIDE, image, within


def with_percent_rank(df: DataFrame, partition: Sequence[str], value: str, name: str) -> DataFrame:
    """``percent_rank`` of a numeric ``value``, missing ones last; 0 for a partition of one row."""
    placed = _with_places(df, partition, {name: value})
    share = F.when(F.col(f"_total_{name}") > 1, F.col(f"_below_{name}") / (F.col(f"_total_{name}") - 1)).otherwise(F.lit(0.0))
    return placed.withColumn(name, share).drop(f"_below_{name}", f"_total_{name}")


def with_rank(df: DataFrame, partition: Sequence[str], value: str, name: str) -> DataFrame:
    """Ascending ``rank`` of a numeric value; missing values come last, sharing one rank."""
    return with_ranks(df, partition, {name: value})


def with_ranks(df: DataFrame, partition: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Ascending ranks of several numeric columns (result name to value column), all counted in the same passes."""
    placed = _with_places(df, partition, columns)
    ranks = {name: (F.col(f"_below_{name}") + 1).cast("int") for name in columns}
    return placed.withColumns(ranks).drop(*(f"_{part}_{name}" for name in columns for part in ("below", "total")))


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)])


def _joined(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join in which null keys meet null keys."""
    others = [f"_r{k}" for k in keys]
    renamed = right.select(*(F.col(k).alias(o) for k, o in zip(keys, others)), *[c for c in right.columns if c not in keys])
    return left.join(renamed, _same(keys, others)).drop(*others)


def places(df: DataFrame, partition: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """(partition, _name, _v, _below, _total): rows with a lower value, and all rows, for every distinct value of every column.

    Values are compared as doubles for the ranges and as they are inside them.
    Missing values count as the highest.
    """
    by = [*partition, "_name"]
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("_name"), F.col(c).alias("_v")) for n, c in columns.items()]))
    values = df.select(*partition, cells.alias("_cell")).select(*partition, "_cell._name", "_cell._v").groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_size"))
    values = values.withColumn("_image", image(F.col("_v").cast("double")))
    values = values.select(*by, within(F.col("_image"), WIDE).alias("_wide"), within(F.col("_image"), NARROW).alias("_narrow"), "_v", "_size")

    def before(level: Sequence[str], order: str) -> Column:
        running = Window.partitionBy(*level).orderBy(F.col(order).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
        return F.sum("_size").over(running) - F.col("_size")

    size = F.sum("_size").alias("_size")
    wide = values.groupBy(*by, "_wide").agg(size).select(
        *by, "_wide", before(by, "_wide").alias("_before_wide"), F.sum("_size").over(Window.partitionBy(*by)).alias("_total"))
    narrow = values.groupBy(*by, "_wide", "_narrow").agg(size).select(
        *by, "_wide", "_narrow", before([*by, "_wide"], "_narrow").alias("_before_narrow"))
    inside = values.withColumn("_before", before([*by, "_wide", "_narrow"], "_v"))
    placed = _joined(inside, _joined(narrow, wide, [*by, "_wide"]), [*by, "_wide", "_narrow"])
    return placed.select(*by, "_v", (F.col("_before") + F.col("_before_narrow") + F.col("_before_wide")).alias("_below"), "_total")


def _with_places(df: DataFrame, partition: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """``df`` with ``_below_<name>`` and ``_total_<name>`` for each column; every row stays.

    Several columns are looked up for their distinct combinations and come back
    in one join, so the plan holds ``df`` as often as for one column, and once more.
    """
    found, by = places(df, partition, columns), list(partition)
    values = list(dict.fromkeys(columns.values()))
    keys, others = [*by, *values], [f"_p_{c}" for c in [*by, *values]]
    if len(columns) == 1:
        [name] = columns
        own = found.select(*by, F.col("_v").alias(values[0]), F.col("_below").alias(f"_below_{name}"), F.col("_total").alias(f"_total_{name}"))
    else:
        cells = F.explode(F.array(*[F.struct(F.lit(n).alias("_name"), F.col(c).alias("_v")) for n, c in columns.items()]))
        asked = df.select(*keys).distinct().select(*keys, cells.alias("_cell")).select(*keys, "_cell.*")
        own = _joined(asked, found, [*by, "_name", "_v"]).groupBy(*keys).agg(*(
            F.max(F.when(F.col("_name") == name, F.col(f"_{part}"))).alias(f"_{part}_{name}") for name in columns for part in ("below", "total")))
    own = own.select(*(F.col(c).alias(o) for c, o in zip(keys, others)), *own.columns[len(keys):])
    return df.join(own, _same(keys, others)).drop(*others)
