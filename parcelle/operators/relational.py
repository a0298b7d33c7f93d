"""Keep-first, latest, merge and key operators.

No join has a broadcast hint: Spark decides by measured size, and otherwise
sort-merges with skew splitting, so dimensions may grow.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, first in ``order``; NULL keys form one group.

    The ``= 1`` filter lets Spark drop all but one row per key in each task before
    the shuffle, so many copies of a key do not meet in one task. A hash of the
    keys leads the sort, so rows are told apart by one number, not by long texts.
    """
    lead = F.xxhash64(*(_hashable(df, k) for k in keys))
    w = Window.partitionBy(lead, *keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def _hashable(df: DataFrame, key: str) -> Column:
    """Adding zero makes the two zeros of a floating column one value."""
    floating = df.schema[key].dataType.typeName() in ("double", "float")
    return F.col(key) + F.lit(0.0) if floating else F.col(key)


def full_order(df: DataFrame, keys: Sequence[str], first: Sequence[Column] = ()) -> list[Column]:
    """``first``, then every other column: an order that leaves no choice open."""
    return [*first, *(F.col(c).asc_nulls_last() for c in df.columns if c not in keys)]


def dedup(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return keep_first(df, keys, full_order(df, keys) or [F.lit(1)])


def keep_latest_ties(df: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """Every row of the latest ``by`` per key.

    The latest value is a map-side aggregate; only it is joined back, so a key
    with many rows is never gathered in one task.
    """
    latest = df.groupBy(*keys).agg(F.max(by).alias(by))
    return df.join(latest, [*keys, by])


def latest_value(df: DataFrame, keys: Sequence[str], by: str, values: Sequence[str]) -> DataFrame:
    """Values of the latest row per key, as an aggregate."""
    return df.groupBy(*keys).agg(F.max(by).alias(by), *(F.max_by(v, by).alias(v) for v in values))


def insert_ignore(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Old rows, and the new rows whose key is not taken."""
    fresh = dedup(new, keys).join(old.select(*keys), list(keys), "left_anti")
    return old.unionByName(fresh.select(*old.columns))


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows merged by key: new values win, except in the columns to ``keep``."""
    o, n = old.alias("o"), new.alias("n")
    both = o.join(n, reduce(lambda a, b: a & b, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys]), "full_outer")
    found = F.col(f"n.{keys[0]}").isNotNull()

    def value(c: str) -> Column:
        if c in keys or c in keep:
            return F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}"))
        return F.when(found, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))

    return both.select(*(value(c).alias(c) for c in old.columns))


def keep_known(df: DataFrame, column: str, dimension: DataFrame, key: str | None = None) -> DataFrame:
    """Rows whose key is in the dimension."""
    known = dimension.select(F.col(key or column).alias(column))
    return df.join(known, column, "left_semi")


def orphans(df: DataFrame, column: str, dimension: DataFrame, key: str | None = None) -> DataFrame:
    """Rows whose key is set but not in the dimension."""
    known = dimension.select(F.col(key or column).alias(column))
    return df.where(F.col(column).isNotNull()).join(known, column, "left_anti")


def prefer(df: DataFrame, other: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``columns`` taken from ``other`` where it has a value, else kept."""
    right = other.select(key, *(F.col(c).alias(f"_{c}") for c in columns))
    joined = df.join(right, key, "left")
    return joined.select(
        *(F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns)
    )


def align(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Fixed columns in a fixed order; missing ones are NULL."""
    have = set(df.columns)
    return df.select(
        *((F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in schema.items())
    )


def first_existing(columns: Sequence[str], candidates: Sequence[str], but: str | None = None) -> str | None:
    """The first candidate present, ignoring case and outer spaces."""
    present = {c.strip().upper(): c for c in columns}
    for candidate in candidates:
        found = present.get(candidate.upper())
        if found is not None and found != but:
            return found
    return None


def require_one_of(columns: Sequence[str], candidates: Sequence[str]) -> str:
    found = next((c for c in candidates if c in columns), None)
    if found is None:
        raise ValueError(f"none of {list(candidates)} among {list(columns)}")
    return found


def tidy_names(columns: Sequence[str]) -> list[str]:
    """Column names usable in SQL. The second of equal names ends in _1, the third in _2, and so on."""
    clean = [
        re.sub(r"[ /]", "_", re.sub(r"[()]", "", stripped)) if (stripped := str(c).strip()).lower() not in ("", "nan") else f"col_sans_nom_{i}"
        for i, c in enumerate(columns)
    ]
    earlier = [clean[:i].count(name) for i, name in enumerate(clean)]
    return [f"{name}_{n}" if n else name for name, n in zip(clean, earlier)]


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
