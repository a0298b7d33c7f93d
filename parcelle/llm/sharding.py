"""Shuffled shards by a Feistel permutation of row numbers.

Rows are numbered 0 .. n-1 in the order of doc_id. A keyed Feistel network on
the grid of side ceil(sqrt(n)) permutes the grid's cells; a cell of n or more is
sent through again until it falls below n (cycle walking), which makes a
permutation of 0 .. n-1. Place p is slot p div shards of shard p mod shards. So
shard and slot of a row number are computed, and ``row_at`` computes the row
number of a shard's slot, without any table.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, stored, table

SHARDS = 40
SEED = 12
ROUNDS = 6
#: Added to the bytes of each text: what a record costs besides its text.
OVERHEAD = 16
PRIME = (1 << 31) - 1


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    """(multiplier, addend) of each round, from a linear congruence modulo PRIME."""
    keys, x = [], seed % PRIME
    for _ in range(rounds):
        x = (48271 * x + 11) % PRIME
        y = (48271 * x + 11) % PRIME
        keys.append((x | 1, y))
        x = y
    return keys


def side(n: int) -> int:
    """Least side of a square grid of n cells or more."""
    return isqrt(n - 1) + 1 if n > 1 else 1


def _mixed(x: np.ndarray, key: tuple[int, int]) -> np.ndarray:
    """The round function: two linear steps modulo PRIME with a folding between them."""
    y = (x % PRIME * key[0] + key[1]) % PRIME
    y = y ^ (y >> 15)
    y = (y * key[0] + key[1]) % PRIME
    return y ^ (y >> 13)


def _once(x: np.ndarray, a: int, keys: list[tuple[int, int]]) -> np.ndarray:
    left, right = x // a, x % a
    for key in keys:
        left, right = right, (left + _mixed(right, key)) % a
    return left * a + right


def _back(x: np.ndarray, a: int, keys: list[tuple[int, int]]) -> np.ndarray:
    left, right = x // a, x % a
    for key in reversed(keys):
        left, right = (right - _mixed(left, key)) % a, left
    return left * a + right


def _walked(x: np.ndarray, n: int, seed: int, step) -> np.ndarray:
    a, keys = side(n), round_keys(seed)
    x = step(np.atleast_1d(np.asarray(x, np.int64)), a, keys)
    outside = np.flatnonzero(x >= n)
    while len(outside):
        x[outside] = step(x[outside], a, keys)
        outside = outside[x[outside] >= n]
    return x


def permuted(row: np.ndarray, n: int, seed: int = SEED) -> np.ndarray:
    """Place of each row number below n. The grid has fewer than 2 sqrt(n) + 1 cells too many, so few rows walk on."""
    return _walked(row, n, seed, _once)


def row_at(shard: np.ndarray, slot: np.ndarray, n: int, shards: int = SHARDS, seed: int = SEED) -> np.ndarray:
    """Row number that lies in a shard's slot: the inverse of the permutation."""
    return _walked(np.asarray(slot, np.int64) * shards + np.asarray(shard, np.int64), n, seed, _back)


def row_numbers(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with their number 0 .. n-1 in the order of these columns, nulls last.

    Rows are range-partitioned, sorted within the ranges, and a range's rows
    follow on those of the ranges before it. Rows that agree in all columns may
    change places, so their place in the input splits them over the ranges:
    any number of copies of one row is dealt over many tasks. The numbering is
    stored, as a lost task could otherwise number copies anew.
    """
    spark, last, part, start = rows.sparkSession, free_name(rows, "last"), free_name(rows, "part"), free_name(rows, "start")
    keys = [F.col(c).asc_nulls_last() for c in [*order, last]]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = stored(
        rows.withColumn(last, F.monotonically_increasing_id()).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
        .drop(last).withColumn(name, F.monotonically_increasing_id()), "row-numbers",
    ).withColumn(part, F.shiftright(name, 33))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(part).agg(F.count(F.lit(1)).alias(start)).withColumn(start, F.coalesce(F.sum(start).over(before), F.lit(0)))
    return placed.join(F.broadcast(starts), part).withColumn(
        name, F.col(start) + F.col(name).bitwiseAND(F.lit((1 << 33) - 1))).drop(part, start)  # one row for each of the ranges above


def assign_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, row, shard, slot), one row per document.

    ``row`` is the document's number in the order of doc_id, then size and
    checksum of the text, nulls last; so the result depends on the rows alone,
    not on files or partitions. Shards differ by one row at most, and slots of a
    shard run from 0 without gaps. size is the text's UTF-8 bytes plus OVERHEAD,
    null text has no bytes and checksum 0. Repeated doc_ids are told apart by
    size and checksum; copies equal in all three are interchangeable. An empty
    table gives an empty result. Other columns are not read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).cast("long").alias("text_crc32"))
    rows = row_numbers(rows, ["doc_id", "size", "text_crc32"], "row")
    n = rows.count()

    @F.pandas_udf("long")
    def place(row: pd.Series) -> pd.Series:
        return pd.Series(permuted(row.to_numpy(), n, seed))

    return rows.withColumn("place", place("row")).select(
        "doc_id", "size", "text_crc32", "row", F.expr(f"cast(place % {int(shards)} as int)").alias("shard"), F.expr(f"place div {int(shards)}").alias("slot"))


def op12_sharding(spark, folder: str) -> DataFrame:
    """Law ``rows``. The method has no groups: equal texts are rows like any others."""
    x = assign_shards(table(spark, folder, "documents"))
    return x.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _network(source: str) -> str:
    """SQL of one pass through the network over (r, a, n, x) of a table; every round is one nested query."""
    sql = f"SELECT r, a, n, x // a AS l, x % a AS h FROM {source}"
    for m, c in round_keys(SEED):
        y = f"(SELECT *, ((h % {PRIME}) * {m} + {c}) % {PRIME} AS y FROM ({sql}))"
        z = f"(SELECT *, (xor(y, y >> 15) * {m} + {c}) % {PRIME} AS z FROM {y})"
        sql = f"SELECT r, a, n, h AS l, (l + xor(z, z >> 13)) % a AS h FROM {z}"
    return f"SELECT r, a, n, l * a + h AS x FROM ({sql})"


_BYTES = r"list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda b: ('0x' || b)::BIGINT)"
_BIT = "(CASE WHEN {0} % 2 = 1 THEN xor({0} >> 1, 3988292384) ELSE {0} >> 1 END)"
_STEPS = "SELECT i, i AS v FROM range(256) s(i)"
for _ in range(8):
    _STEPS = f"SELECT i, {_BIT.format('v')}::BIGINT AS v FROM ({_STEPS})"
OP12_SQL = f"""WITH RECURSIVE lookup AS (SELECT list(v ORDER BY i) AS v FROM ({_STEPS})),
d AS (SELECT doc_id, strlen(t)::BIGINT + 16 AS size,
  xor(list_reduce(list_prepend(4294967295::BIGINT, {_BYTES}), lambda c, b: xor(c >> 8, lookup.v[xor(c, b) % 256 + 1])), 4294967295)::BIGINT AS text_crc32
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents), lookup),
g AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS LAST, size, text_crc32) - 1 AS r FROM d),
c AS (SELECT count(*) AS n, ceil(sqrt(count(*)))::BIGINT AS a FROM d),
first AS (SELECT r, a, n, r AS x FROM g, c),
walk AS ({_network('first')} UNION ALL SELECT * FROM ({_network('(SELECT * FROM walk WHERE x >= n)')}))
SELECT doc_id, size, text_crc32, 'rows' AS law, (x % {SHARDS})::INT AS shard, x // {SHARDS} AS slot, NULL::INT AS grown_shard
FROM g JOIN (SELECT r, x FROM walk WHERE x < n) USING (r)"""
