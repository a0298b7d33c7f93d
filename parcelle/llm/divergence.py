"""Source divergence audit: how far each source's use of words is from the other sources of its language, and by which words.

Part ``pair`` sums the absolute differences of smoothed rates over all kept
terms; part ``term`` names the terms that a source uses most above its language.
The latter come from a dominance skyband: a term that fewer than k others
dominate (higher count in the group, lower count in the language, earlier in
UTF-8) may be among the first k, any other may not, whatever the smoothing.
Pieces of a group keep their own skybands, those are merged into the group's
skyband, and only that is ranked exactly.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, table
from .terms import LETTERS, term_lists

#: A term is kept in a language if this many of its documents hold it.
LEAST_DOCS = 30
TOP = 50
#: Entries of the counters that a task holds before it hands them on.
HELD = 300_000
#: Sources whose pairs are summed at a time, and pieces into which the terms of a group are dealt for the first skybands.
TILE, PIECES = 256, 16
COUNTED = "lang string, source string, term binary, count long, docs long"


def _counted(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term by group, summed within the task; term '' counts the group's documents."""
    held: dict[tuple, tuple[Counter, Counter]] = {}

    def handed() -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, docs) in held.items():
            terms = list(counts)
            n = len(terms)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), pa.array(terms, pa.binary()),
                pa.array(list(counts.values()), pa.int64()), pa.array([docs[t] for t in terms], pa.int64()),
            ], ["lang", "source", "term", "count", "docs"])
        held.clear()

    for batch in batches:
        for i, (lang, source, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)))):
            counts, docs = held.setdefault((lang, source), (Counter(), Counter()))
            distinct = {b""}
            for terms in term_lists(text, LETTERS):
                counts.update(terms)
                distinct.update(terms)
            counts[b""] += 1
            docs.update(distinct)
            if i % 64 == 63 and sum(len(c) for c, _ in held.values()) > most:
                yield from handed()
        if sum(len(c) for c, _ in held.values()) > most:
            yield from handed()
    yield from handed()


def term_counts(docs: DataFrame, least_docs: int = LEAST_DOCS, held: int = HELD) -> DataFrame:
    """(lang, source, term, count, lang_count) of the kept terms, stored; rows of term '' name every group.

    Counts are summed within the tasks first, so a hot source or word reaches
    the shuffle as one row a task. All rows of a term in a language share one
    task from there on, which serves both sums.
    """
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")), F.col("text").cast("string").cast("binary").alias("text"))
    parts = rows.mapInArrow(lambda batches: _counted(batches, held), COUNTED).withColumn("term", F.col("term").cast("string"))
    sums = parts.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    whole = Window.partitionBy("lang", "term")
    return stored(
        sums.withColumns({"lang_count": F.sum("count").over(whole), "lang_docs": F.sum("docs").over(whole)})
        .where((F.col("lang_docs") >= least_docs) | (F.col("term") == "")).select("lang", "source", "term", "count", "lang_count"), "term-counts")


def _rate(count: Column, total: Column, terms: Column) -> Column:
    """Smoothed rate in billionths, exact: the product may pass 64 bits."""
    return (F.lit(1) + F.call_function("div", F.lit(1_000_000_000).cast("decimal(18,0)") * (count + 5).cast("decimal(19,0)"), (total + 5 * terms).cast("decimal(20,0)"))).cast("long")


def group_sizes(counts: DataFrame) -> DataFrame:
    """(lang, source, place, total, terms, lang_total, base): one row per group; base is the rate of a term without occurrence, null if none is kept."""
    kept = counts.where("term <> ''")
    langs = kept.select("lang", "term", "lang_count").distinct().groupBy("lang").agg(
        F.count(F.lit(1)).alias("terms"), F.sum("lang_count").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    none = F.lit(0).cast("long")
    x = (
        counts.where("term = ''").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", *(F.coalesce(c, none).alias(c) for c in ("total", "terms", "lang_total")))
        .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    )
    return stored(x.withColumn("base", F.when(F.col("terms") > 0, _rate(none, F.col("total"), F.col("terms")))), "group-sizes")


# terms above the language

class Skyband:
    """Terms of one group with fewer than k dominators, fed in UTF-8 order.

    Whoever comes later cannot dominate whoever came before, and the first k
    dominators of a term are in the skyband themselves, so each term is
    compared with the skyband so far.
    """

    def __init__(self, k: int):
        self.k, self.high, self.low = k, np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, high: np.ndarray, low: np.ndarray, block: int = 256) -> np.ndarray:
        """Which of the next terms, given by group and language count, are in the skyband."""
        kept = []
        for at in range(0, len(high), block):
            h, w = high[at:at + block], low[at:at + block]
            before = ((self.high >= h[:, None]) & (self.low <= w[:, None])).sum(1)
            among = np.tril((h >= h[:, None]) & (w <= w[:, None]), -1).sum(1)
            kept.append(before + among < self.k)
            self.high, self.low = np.append(self.high, h[kept[-1]]), np.append(self.low, w[kept[-1]])
        return np.concatenate(kept) if kept else np.empty(0, bool)


def skyband(rows: DataFrame, k: int) -> DataFrame:
    """The rows of each partition's groups (lang, source) with fewer than k dominators there; one group is held at a time, as its skyband."""
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, band = None, None
        for batch in batches:
            keys = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
            high, low = batch.column("count").to_numpy(), batch.column("lang_count").to_numpy()
            mask, at = [], 0
            for key, run in groupby(keys):
                if key != group:
                    group, band = key, Skyband(k)
                n = sum(1 for _ in run)
                mask.append(band.add(high[at:at + n], low[at:at + n]))
                at += n
            if mask:
                yield batch.filter(pa.array(np.concatenate(mask)))

    return rows.sortWithinPartitions("lang", "source", "term").mapInArrow(kept, rows.schema)


def top_terms(counts: DataFrame, sizes: DataFrame, top: int = TOP, pieces: int = PIECES) -> DataFrame:
    """(lang, source, item, value, rank): per group the kept terms with the highest rate above the language's, at most ``top``."""
    x = counts.where("term <> ''").join(sizes.select("lang", "source", "total", "terms", "lang_total"), ["lang", "source"])
    value = _rate(F.col("count"), F.col("total"), F.col("terms")) - _rate(F.col("lang_count"), F.col("lang_total"), F.col("terms"))
    above = x.select("lang", "source", "term", "count", "lang_count", value.alias("value")).where("value > 0")  # dominators of a term above are above
    parts = skyband(above.repartition("lang", "source", F.pmod(F.xxhash64("term"), F.lit(pieces))), top)
    merged = skyband(parts.repartition("lang", "source"), top)
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term"))
    return merged.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", "source", F.col("term").alias("item"), "value", "rank")


# pairs of sources

def _distances(batches: Iterator[pa.RecordBatch], tile: int) -> Iterator[pa.RecordBatch]:
    """Sums over the task's terms for each pair of sources; one tile of pairs is held at a time."""
    key, total = None, None

    def handed() -> Iterator[pa.RecordBatch]:
        if key is None:
            return
        lang, i, j = key
        a, b = (x.ravel() for x in np.indices(total.shape))
        for left, right in [(a + i * tile, b + j * tile)] + ([(b + j * tile, a + i * tile)] if i < j else []):
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(a), pa.string()), pa.array(left, pa.int32()), pa.array(right, pa.int32()), pa.array(total.ravel(), pa.int64())],
                ["lang", "a", "b", "value"])

    def dense(batch: pa.RecordBatch, base: str, present: str, at: slice) -> np.ndarray:
        rates = np.tile(np.asarray(batch.column(base)[at.start].values, np.int64), (at.stop - at.start, 1))
        lists = batch.column(present).slice(at.start, at.stop - at.start)
        cells = lists.flatten()
        row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        rates[row, cells.field("place").to_numpy() % tile] = cells.field("rate").to_numpy()
        return rates

    for batch in batches:
        at = 0
        for own, run in groupby(zip(*(batch.column(c).to_pylist() for c in ("lang", "i", "j")))):
            n = sum(1 for _ in run)
            left, right = (dense(batch, f"base_{s}", f"present_{s}", slice(at, at + n)) for s in "ij")
            if own != key:
                yield from handed()
                key, total = own, np.zeros((left.shape[1], right.shape[1]), np.int64)
            weight = batch.column("weight").to_numpy()[at:at + n].astype(np.int64)
            for a in range(left.shape[1]):
                total[a] += weight @ np.abs(left[:, a:a + 1] - right)
            at += n
    yield from handed()


def pair_distances(counts: DataFrame, sizes: DataFrame, tile: int = TILE) -> DataFrame:
    """(lang, source, item, value, rank): each other source of the language by summed difference of the rates, all ranks.

    A term brings the rates of the sources that use it, the others have their
    base rate. Sources are taken ``tile`` at a time, so a task holds one square of
    sums; a row of weight 0 per language makes pairs that no term reaches.
    """
    used = counts.where("term <> ''").join(sizes.select("lang", "source", "place", "total", "terms"), ["lang", "source"]).select(
        "lang", "term", F.struct(F.col("place"), _rate(F.col("count"), F.col("total"), F.col("terms")).alias("rate")).alias("cell"))
    none = F.lit(None).cast("struct<place:int,rate:bigint>")
    langs = sizes.groupBy("lang").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", F.coalesce("base", F.lit(0).cast("long")).alias("base")))), lambda s: s["base"]).alias("base"))
    terms = used.unionByName(langs.select("lang", F.lit("").alias("term"), none.alias("cell"))).groupBy("lang", "term").agg(F.collect_list("cell").alias("present"))
    last = F.floor((F.size("base") - 1) / tile).cast("int")
    tiles = F.flatten(F.transform(F.sequence(F.lit(0), last), lambda i: F.transform(F.sequence(i, last), lambda j: F.struct(i.alias("i"), j.alias("j")))))
    x = terms.join(langs, "lang").withColumn("tile", F.explode(tiles))

    def part(side: str) -> list[Column]:
        t = F.col(f"tile.{side}")
        return [t.alias(side), F.slice("base", t * tile + 1, F.lit(tile)).alias(f"base_{side}"),
                F.filter("present", lambda c: F.floor(c["place"] / tile) == t).alias(f"present_{side}")]

    sums = (
        x.select("lang", (F.col("term") != "").cast("long").alias("weight"), *part("i"), *part("j")).sortWithinPartitions("lang", "i", "j")
        .mapInArrow(lambda batches: _distances(batches, tile), "lang string, a int, b int, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value")).where("a <> b")
    )
    names = sizes.select("lang", "source", "place")
    named = sums.join(names.withColumnRenamed("place", "a"), ["lang", "a"]).join(names.select("lang", F.col("place").alias("b"), F.col("source").alias("item")), ["lang", "b"])
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return named.withColumn("rank", rank).select("lang", "source", "item", "value", "rank")


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, held: int = HELD, tile: int = TILE, pieces: int = PIECES) -> DataFrame:
    """(lang, source, part, item, value, rank) of every group (lang, source).

    Null text, lang and source are read as ''. A language of one source has no
    pairs; where no term is kept, all pairs have value 0 and there are no terms.
    Equal values are ordered by item in UTF-8. Repeated rows count each; an
    empty table gives an empty result. Other columns are not read.
    """
    counts = term_counts(docs, least_docs, held)
    sizes = group_sizes(counts)
    names = ["lang", "source", "part", "item", "value", "rank"]
    return pair_distances(counts, sizes, tile).withColumn("part", F.lit("pair")).select(*names).unionByName(
        top_terms(counts, sizes, top, pieces).withColumn("part", F.lit("term")).select(*names))


def op11_divergence(spark, folder: str) -> DataFrame:
    return audit(table(spark, folder, "documents"))


_P = "(1 + (1000000000::HUGEINT * ({0} + 5)) // ({1} + 5 * v))"
OP11_SQL = rf"""WITH d AS (SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents),
w AS (SELECT n, lang, source, translate(unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
k AS (SELECT lang, term, count(*) AS lang_count FROM w GROUP BY lang, term HAVING count(DISTINCT n) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS count FROM w GROUP BY lang, source, term),
x AS (SELECT g.lang, g.source, k.term, coalesce(c.count, 0) AS count, k.lang_count FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
s AS (SELECT *, sum(count) OVER (PARTITION BY lang, source) AS total, sum(lang_count) OVER (PARTITION BY lang, source) AS lang_total,
  count(*) OVER (PARTITION BY lang, source) AS v FROM x),
p AS (SELECT *, {_P.format('count', 'total')} AS p, {_P.format('lang_count', 'lang_total')} AS q FROM s),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE count > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM o)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM r WHERE part = 'pair' OR rank <= 50"""
