"""Ranked lexical search: the best documents for each item of a query set, by branch and bound over document tries.

Documents are restricted to the terms of the items and their terms ordered by
frequency in the corpus, most frequent first. A task sorts its documents'
vectors, so that documents with the same first terms lie side by side and share
a path of the trie. Each node knows the greatest tf of each term and the least
length figure m of the documents beneath it; since a score rises with tf and
falls with m, they bound every score in the subtree. Per item the trie is
searched depth first, the most promising child first, and a subtree is left out
if its bound is below the item's k-th best score so far.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, table
from .terms import LETTERS_AND_DIGITS, term_lists

TOP = 10
#: Terms (with repeats) of the items that are searched in one pass over the documents. What the driver and
#: the tasks hold of the items grows with this figure only, unless one item alone is longer.
BLOCK_TERMS = 200_000
#: A trie holds at most so many documents or so many of their terms; subtrees of at most LEAF documents are not split.
TRIE_DOCS, TRIE_TERMS, LEAF = 16_384, 2_000_000, 64
#: Parts in which an item's results of all tasks are merged first.
PARTS = 32
UNIT = 1_000_000_000


# items

def item_blocks(items: DataFrame, block_terms: int = BLOCK_TERMS) -> Iterator[list[tuple]]:
    """Blocks of the items as lists of (item_id, distinct terms), one block at a time on the driver."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [[t for part in term_lists(text, LETTERS_AND_DIGITS) for t in part] for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([sorted(set(x)) for x in lists], pa.list_(pa.binary())), pa.array([len(x) for x in lists], pa.int64())],
                ["item_id", "terms", "n"])

    kind = items.schema["item_id"].dataType.simpleString()
    cut = stored(
        items.select(F.col("text").cast("string").cast("binary").alias("text"), "item_id").mapInArrow(split, f"item_id {kind}, terms array<binary>, n long")
        .where("n > 0"), "search-items")
    total = cut.agg(F.sum("n")).first()[0] or 0
    blocks = -(-total // block_terms)
    for block in range(blocks):
        rows = cut.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)) == block).collect()
        if rows:
            yield sorted(((r["item_id"], [bytes(t) for t in r["terms"]]) for r in rows), key=lambda x: (x[0] is None, x))


# documents

def restricted(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, ids, tfs): number of terms of every document, and those of its terms that are numbered, with their tf."""
    sent = docs.sparkSession.sparkContext.broadcast(number)  # bounded by BLOCK_TERMS

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            sizes, ids, tfs, ends = [], [], [], [0]
            for text in batch.column(0).to_pylist():
                counts: Counter = Counter()
                for terms in term_lists(text, LETTERS_AND_DIGITS):
                    counts.update(terms)
                sizes.append(counts.total())
                for t in counts.keys() & known.keys():
                    ids.append(known[t])
                    tfs.append(counts[t])
                ends.append(len(ids))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, kind)) for x, kind in ((ids, pa.int32()), (tfs, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "ids", "tfs"])

    rows = docs.select(F.col("text").cast("string").cast("binary").alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    return rows.mapInArrow(cut, "doc_id long, n long, ids array<int>, tfs array<long>").where("n > 0")


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Length of the common beginning."""
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[:n] != y[:n])
    return int(differ[0]) if len(differ) else n


class Trie:
    """Document vectors with shared paths.

    ``ids`` number terms by falling frequency. Nodes are given by the range of
    sorted documents beneath them; a path without branches is one node.
    """

    def __init__(self, docs: np.ndarray, ids: np.ndarray, tfs: np.ndarray, m: np.ndarray, leaf: int = LEAF):
        """``docs`` is the document of each cell (term id, tf), ``m`` the length figure of each document."""
        self.leaf = leaf
        order = np.lexsort((ids, docs))
        docs, ids, tfs = docs[order], ids[order], tfs[order]
        self.starts = np.searchsorted(docs, np.arange(len(m) + 1))
        self.paths = [ids[a:b] for a, b in zip(self.starts, self.starts[1:])]
        self.place = np.array(sorted(range(len(m)), key=lambda d: self.paths[d].tolist()), np.int64)  # sorted place -> document
        cells = np.concatenate([np.arange(self.starts[d], self.starts[d + 1]) for d in self.place]) if len(m) else np.empty(0, np.int64)
        sizes = np.diff(self.starts)[self.place]
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        self.ids, self.tfs, self.m = ids[cells], tfs[cells], m[self.place]
        self.value = UNIT * self.tfs // (1000 * self.tfs + 8 * np.repeat(self.m, sizes))
        self.paths = [self.paths[d] for d in self.place]
        self.lengths = sizes
        self.shared = np.array([0, *(_common(x, y) for x, y in zip(self.paths, self.paths[1:]))][:len(m)], np.int64)  # terms shared with the document before
        self.range: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        self.bound: list[tuple[np.ndarray, np.ndarray]] = []  # per node: terms beneath it, greatest value of each
        todo = [self._node(0, len(m))] if len(m) else []
        while todo:
            node = todo.pop()
            cuts = self._cuts(*self.range[node])
            if len(cuts) > 2:
                self.children[node] = [self._node(a, b) for a, b in zip(cuts, cuts[1:])]
                todo += self.children[node]

    def _node(self, low: int, high: int) -> int:
        cells = slice(self.starts[low], self.starts[high])
        order = np.argsort(self.ids[cells], kind="stable")
        terms, first = np.unique(self.ids[cells][order], return_index=True)
        most = np.maximum.reduceat(self.tfs[cells][order], first) if len(terms) else self.tfs[:0]
        self.range.append((low, high))
        self.children.append([])
        self.bound.append((terms, UNIT * most // (1000 * most + 8 * self.m[low:high].min())))
        return len(self.range) - 1

    def _cuts(self, low: int, high: int) -> list[int]:
        """Where a node's children begin and end.

        Paths branch where neighbours share least. A branch with most of the
        node's documents is split further at once, so that a node has at most
        three quarters of its parent's documents; small neighbours share a node.
        """
        cuts, a, b = {low, high}, low, high
        while b - a > max(self.leaf, (high - low) * 3 // 4):
            inner = self.shared[a + 1:b]
            least = int(inner.min())
            if least == self.lengths[a:b].max():  # all the same
                break
            at = [a, *(np.flatnonzero(inner == least) + a + 1).tolist(), b]
            cuts.update(at)
            a, b = max(zip(at, at[1:]), key=lambda r: r[1] - r[0])
        ordered = sorted(cuts)
        merged = [low]
        for x, y in zip(ordered[1:], ordered[2:]):
            if y - merged[-1] > self.leaf:
                merged.append(x)
        return [*merged, high]

    def scores(self, low: int, high: int, weight: np.ndarray) -> np.ndarray:
        a, b = self.starts[low], self.starts[high]
        sums = np.concatenate(([0], np.cumsum(weight[self.ids[a:b]] * self.value[a:b])))
        at = self.starts[low:high + 1] - a
        return sums[at[1:]] - sums[at[:-1]]

    def search(self, weight: np.ndarray, best: Best) -> int:
        """Feeds all documents that may be among the best to ``best``; returns how many were scored."""
        scored, stack = 0, [0] if self.range else []
        bounds = {0: self._bound(0, weight)} if stack else {}
        while stack:
            node = stack.pop()
            if bounds[node] <= 0 or bounds[node] < best.least:
                continue
            if self.children[node]:
                for child in self.children[node]:
                    bounds[child] = self._bound(child, weight)
                stack += sorted(self.children[node], key=bounds.__getitem__)
            else:
                low, high = self.range[node]
                best.add(self.scores(low, high, weight), self.place[low:high])
                scored += high - low
        return scored

    def _bound(self, node: int, weight: np.ndarray) -> int:
        terms, value = self.bound[node]
        return int(weight[terms] @ value)


class Best:
    """The k best of one item so far in one task: score, then least doc_id, null ids last."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.score, self.absent, self.doc = np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)

    def among(self, doc: np.ndarray, absent: np.ndarray) -> Best:
        self.all_doc, self.all_absent = doc, absent
        return self

    def add(self, score: np.ndarray, place: np.ndarray) -> None:
        good = np.flatnonzero(score >= self.least)
        if not len(good):
            return
        place = place[good]
        score = np.append(self.score, score[good])
        absent, doc = np.append(self.absent, self.all_absent[place]), np.append(self.doc, self.all_doc[place])
        first = np.lexsort((doc, absent, -score))[: self.k]
        self.score, self.absent, self.doc = score[first], absent[first], doc[first]
        if len(first) == self.k:
            self.least = int(self.score[-1])


def _searched(vectors: DataFrame, block: list[tuple], weights: list[int], ranks: list[int], n: int, length: int, k: int, trie_docs: int, leaf: int) -> DataFrame:
    """(item, doc_id, score) of each task's best for each item of the block."""
    sent = vectors.sparkSession.sparkContext.broadcast((
        [np.array(terms, np.int64) for _, terms in block], np.array(weights, np.int64), np.array(ranks, np.int32)))  # bounded by BLOCK_TERMS

    def tries(batches: Iterator[pa.RecordBatch], ranks: np.ndarray) -> Iterator[tuple]:
        held: list[pa.RecordBatch] = []
        size = cells = 0

        def made() -> tuple:
            rows = pa.Table.from_batches(held).combine_chunks()
            doc = rows.column("doc_id").combine_chunks()
            lists = [pa.concat_arrays(rows.column(c).chunks) if rows.column(c).num_chunks else pa.array([], rows.column(c).type) for c in ("ids", "tfs")]
            counts = np.diff(lists[0].offsets.to_numpy())
            m = np.array([10 + 90 * x * n // length for x in rows.column("n").to_pylist()], np.int64)
            cell_docs = np.repeat(np.arange(len(m)), counts)
            trie = Trie(cell_docs, ranks[lists[0].flatten().to_numpy()], lists[1].flatten().to_numpy(), m, leaf)
            return trie, doc.fill_null(0).to_numpy(zero_copy_only=False), doc.is_null().to_numpy(zero_copy_only=False)

        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                held.append(part)
                size += part.num_rows
                cells += len(part.column("ids").flatten())
                if size >= trie_docs or cells >= TRIE_TERMS:
                    yield made()
                    held, size, cells = [], 0, 0
        if held:
            yield made()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, ranks = sent.value
        best = [Best(k) for _ in items]
        weight = np.zeros(len(weights), np.int64)  # by rank; set for one item at a time
        for trie, doc, absent in tries(batches, ranks):
            for own, found in zip(items, best):
                weight[ranks[own]] = weights[own]
                trie.search(weight, found.among(doc, absent))
                weight[ranks[own]] = 0
        rows = [(i, None if a else int(d), int(s)) for i, b in enumerate(best) for s, a, d in zip(b.score, b.absent, b.doc)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in rows], kind) for c, kind in enumerate((pa.int32(), pa.int64(), pa.int64()))], ["item", "doc_id", "score"])

    return vectors.mapInArrow(run, "item int, doc_id long, score long")


def _first(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = TOP, block_terms: int = BLOCK_TERMS, trie_docs: int = TRIE_DOCS, leaf: int = LEAF) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents with a score above 0 for each row of ``items``.

    Equal scores are ordered by doc_id, null ids last. Null and empty texts have
    no terms: such documents are not counted, such items find nothing. Repeated
    documents are ranked each, repeated items answered each. Empty tables give
    an empty result. Other columns are not read. Items are searched in blocks of
    about ``block_terms`` terms, each in one pass over the documents.
    """
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    results = []
    for block in item_blocks(items, block_terms):
        number: dict[bytes, int] = {}
        numbered = [(item_id, [number.setdefault(t, len(number)) for t in terms]) for item_id, terms in block]
        vectors = stored(restricted(docs, number), "search-vectors")
        n, length = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n:
            break
        frequency = dict(vectors.select(F.explode("ids").alias("t")).groupBy("t").count().collect())  # at most a block's terms
        df = [frequency.get(t, 0) for t in range(len(number))]
        weights = [floor(1000 * log((2 * n + 2) / (2 * x + 1))) for x in df]
        ranks = np.empty(len(df), np.int64)
        ranks[sorted(range(len(df)), key=lambda t: -df[t])] = np.arange(len(df))
        found = _searched(vectors, numbered, weights, ranks.tolist(), n, length, k, trie_docs, leaf)
        merged = _first(_first(found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))), ["item", "part"], k).drop("rank"), ["item"], k)
        names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], f"item int, item_id {kind}")
        results.append(merged.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    if not results:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def op13_search(spark, folder: str) -> DataFrame:
    return search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


_TERMS = r"""unnest(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"""
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP13_SQL = f"""WITH d AS (SELECT doc_id, {_LOWER.format(_TERMS)} AS term FROM documents),
t AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY doc_id, term),
z AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM t GROUP BY doc_id),
c AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS len FROM z),
q AS (SELECT DISTINCT item_id, {_LOWER.format('term')} AS term FROM (SELECT item_id, {_TERMS} AS term FROM benchmark)),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM t, c GROUP BY term, docs),
m AS (SELECT doc_id, 10 + (90 * n * docs) // len AS m FROM z, c),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM q JOIN t USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id HAVING score > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM s)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10"""
