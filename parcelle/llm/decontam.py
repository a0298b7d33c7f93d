"""Benchmark decontamination with an FM-index per training shard.

A shard's text is a sequence of word numbers. Its Burrows-Wheeler transform,
held as a wavelet matrix for rank queries, answers by backward search how often
and where each test phrase occurs; places come from sampled suffix positions.
The words of all occurrences are merged into removal spans.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, stored, table

WINDOW = 13
#: Test items are searched in blocks of at most this many bytes, each block in a pass of its own; long items are cut into pieces.
BLOCK_BYTES = 4 << 20
PIECE_WORDS = 4096
SHARD_BYTES = 4 << 20
SAMPLE = 8
#: Bytes of words to lower case, all other ASCII to space; bytes above 127 belong to words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes, by doubling the compared length until all ranks differ."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        key = rank * (n + 1)
        key[: n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        if n == 0 or new.max() == n - 1:
            return order
        rank, step = new, step * 2


class FMIndex:
    """Index of runs of symbols 1..top, given with a 0 after every run."""

    def __init__(self, text: np.ndarray, top: int):
        ends = text == 0
        unique = text.astype(np.int64) + int(ends.sum())
        unique[ends] = np.arange(ends.sum())  # every end differs, so no comparison runs past one
        order = suffix_array(unique)
        self.bwt = text[order - 1]  # the symbol before position 0 is the last end
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=top + 1))))
        starts = np.concatenate(([True], ends[:-1]))
        self.marked = (order % SAMPLE == 0) | starts[order]  # run starts too: no walk crosses an end
        self.mark_rank = np.concatenate(([0], np.cumsum(self.marked)))
        self.sampled = order[self.marked]
        self.levels = []
        row = self.bwt
        for bit in reversed(range(max(1, int(top).bit_length()))):
            ones = ((row >> bit) & 1).astype(bool)
            self.levels.append((bit, np.concatenate(([0], np.cumsum(ones))), int(len(row) - ones.sum())))
            row = np.concatenate((row[~ones], row[ones]))
        self.base = self._descend(np.arange(top + 1), np.zeros(top + 1, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, ones, zeros in self.levels:
            up = ones[at]
            at = np.where((symbol >> bit) & 1, zeros + up, at - up)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place of the transform."""
        return self._descend(symbol, at) - self.base[symbol]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, low, high) of the phrases (rows of equal length) that occur, with their ranges of suffixes."""
        which = np.arange(len(phrases))
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), len(self.bwt), np.int64)
        for column in reversed(range(phrases.shape[1])):
            c = phrases[which, column]
            low = self.first[c] + self.rank(c, low)
            high = self.first[c] + self.rank(c, high)
            alive = low < high
            which, low, high = which[alive], low[alive], high[alive]
        return which, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: step back until a sampled one."""
        out = np.empty(len(rows), np.int64)
        left, rows, steps = np.arange(len(rows)), rows.copy(), 0
        while len(left):
            hit = self.marked[rows]
            out[left[hit]] = self.sampled[self.mark_rank[rows[hit]]] + steps
            left, rows = left[~hit], rows[~hit]
            c = self.bwt[rows]
            rows = self.first[c] + self.rank(c, rows)
            steps += 1
        return out


class Phrases:
    """The distinct windows of a block of test items: word numbers, and the items of each window.

    All in flat arrays, about 250 bytes for a word of the block.
    """

    def __init__(self, items: list[tuple[str, str | None]]):
        self.words: dict[bytes, int] = {}
        self.names = sorted({name for name, _ in items})
        code = {name: i for i, name in enumerate(self.names)}
        rows: dict[int, list[tuple[np.ndarray, int]]] = defaultdict(list)
        for name, text in items:
            numbers = np.array([self.words.setdefault(w, len(self.words) + 1) for w in words_of(text)], np.int32)
            if len(numbers):
                size = min(WINDOW, len(numbers))
                rows[size].append((np.lib.stride_tricks.sliding_window_view(numbers, size), code[name]))
        #: For each size: the distinct windows, and where each one's items start in the array of item codes.
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size, found in sorted(rows.items()):
            owner = np.repeat([c for _, c in found], [len(w) for w, _ in found])
            windows, which = np.unique(np.concatenate([w for w, _ in found]), axis=0, return_inverse=True)
            pairs = np.unique(which.reshape(-1).astype(np.int64) * len(code) + owner)
            starts = np.searchsorted(pairs // len(code), np.arange(len(windows) + 1))
            self.by_size[size] = windows, starts, pairs % len(code)

    def items_of(self, size: int, window: int) -> list[str]:
        _, starts, codes = self.by_size[size]
        return [self.names[c] for c in codes[starts[window]:starts[window + 1]]]

    def find(self, numbers: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """(places, windows, size) of all occurrences in word numbers, where 0 is any other word.

        Runs shorter than the shortest window hold no occurrence and are not indexed.
        """
        if not self.by_size:
            return
        inside = np.concatenate(([0], (numbers > 0).view(np.int8), [0]))
        edge = np.flatnonzero(np.diff(inside))
        starts, ends = edge[::2], edge[1::2]
        long = ends - starts >= min(self.by_size)
        starts, sizes = starts[long], (ends - starts)[long] + 1
        if not len(starts):
            return
        offset = np.concatenate(([0], np.cumsum(sizes)))
        place = np.arange(offset[-1]) - np.repeat(offset[:-1] - starts, sizes)
        text = numbers[np.minimum(place, len(numbers) - 1)]
        text[offset[1:] - 1] = 0
        index = FMIndex(text, len(self.words))
        for size, (windows, _, _) in self.by_size.items():
            which, low, high = index.search(windows)
            count = high - low
            rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - low, count)
            yield place[index.locate(rows)], np.repeat(which, count), size


def scan_shard(texts: list[str | None], blocks: list[Phrases]) -> list[tuple[int, list[str], list[tuple[int, int]]]]:
    """(words, items found, removal spans in words, end exclusive) of every text."""
    split = [words_of(t) for t in texts]
    sizes = np.array([len(w) for w in split], np.int64)
    start = np.concatenate(([0], np.cumsum(sizes + 1)))  # one place between texts
    cover = np.zeros(start[-1] + 1, np.int64)
    found: dict[int, set[str]] = defaultdict(set)
    for block in blocks:
        number = block.words.get
        flat = np.zeros(start[-1], np.int64)
        for at, words in zip(start, split):
            flat[at:at + len(words)] = [number(w, 0) for w in words]
        for places, windows, size in block.find(flat):
            np.add.at(cover, places, 1)
            np.add.at(cover, places + size, -1)
            owner = np.searchsorted(start, places, "right") - 1
            for text, window in np.unique(np.stack((owner, windows), 1), axis=0).tolist():
                found[text].update(block.items_of(size, window))
    hit = np.concatenate(([0], (np.cumsum(cover)[:-1] > 0).view(np.int8), [0]))
    edge = np.flatnonzero(np.diff(hit))
    spans: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        text = int(np.searchsorted(start, a, "right")) - 1
        spans[text].append((a - int(start[text]), b - int(start[text])))
    return [(int(n), sorted(found[i]) if i in found else [], spans.get(i, [])) for i, n in enumerate(sizes)]


def item_pieces(benchmark: DataFrame) -> DataFrame:
    """(item, text) of folded words: long items in pieces of PIECE_WORDS words, each sharing WINDOW - 1 with the next one.

    The pieces of an item have its windows and no others. Items without words have none.
    """
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, size = [], 0
            for name, text in zip(batch["item"], batch["text"]):
                words = words_of(text)
                for i in range(0, max(1, len(words) - WINDOW + 1), PIECE_WORDS - WINDOW + 1) if words else ():
                    out.append((name, b" ".join(words[i:i + PIECE_WORDS]).decode("utf-8", "surrogatepass")))
                    size += len(out[-1][1])
                    if size > BLOCK_BYTES:
                        yield pd.DataFrame(out, columns=["item", "text"])
                        out, size = [], 0
            yield pd.DataFrame(out, columns=["item", "text"])

    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(cut, "item string, text string")


def phrase_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Phrases]:
    """Blocks of pieces of at most block_bytes of UTF-8 (or one piece), one at a time; the driver reads them by partitions of the table."""
    items, size = [], 0
    for row in item_pieces(benchmark).withColumn("bytes", F.octet_length("text")).toLocalIterator():
        if items and size + row["bytes"] > block_bytes:
            yield Phrases(items)
            items, size = [], 0
        items.append((row["item"], row["text"]))
        size += row["bytes"]
    if items:
        yield Phrases(items)


def shards(texts: pd.Series, block: Phrases) -> list[tuple[int, list[str], list[tuple[int, int]]]]:
    """scan_shard over shards of bounded size."""
    rows, shard, size = [], [], 0
    for text in texts:
        shard.append(text)
        size += len(text or "")
        if size > SHARD_BYTES:
            rows += scan_shard(shard, [block])
            shard, size = [], 0
    return rows + (scan_shard(shard, [block]) if shard else [])


def as_spans(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    return [{"first": a, "last": b} for a, b in spans]


FOUND = "n_words bigint, items array<string>, spans array<struct<first:int,last:int>>"


def merged_spans(spans) -> list[dict[str, int]]:
    """Sorted spans of one document, with overlapping and touching ones joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["first"], s["last"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return as_spans(out)


def find_contamination(docs: DataFrame, benchmark: DataFrame, name: str = "found", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs with the struct ``name``: n_words, items (ids as strings, sorted) and spans (first, last word, end exclusive).

    Whole texts; null has no words. Windows are 13 words, or a whole shorter
    item; items without words match nothing, null ids read as empty. Rows stay
    as they are, repeated ones too; a column called ``name``, letter case
    aside, is replaced. A shard is a batch of texts of bounded size, within a
    task: nothing is shuffled where the test items fit one block.

    More test items take one pass over the documents for each block, so that
    the driver and a task hold one block at any time. Each pass stores what it
    finds; findings are merged per row at the end.
    """
    context = docs.sparkSession.sparkContext
    blocks = phrase_blocks(benchmark, block_bytes)
    first = next(blocks, None) or Phrases([])
    second = next(blocks, None)
    if second is None:
        one = context.broadcast(first)

        @F.pandas_udf(FOUND)
        def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                found = shards(batch, one.value)
                yield pd.DataFrame({"n_words": [r[0] for r in found], "items": [r[1] for r in found], "spans": [as_spans(r[2]) for r in found]})

        return docs.withColumn(name, scan(F.col("text")))

    key = free_name(docs, "row_key")
    rows = stored(docs.withColumn(key, F.monotonically_increasing_id()), "rows")  # keys differ when computed again
    passes = []
    for number, block in enumerate(chain((first, second), blocks)):
        sent = context.broadcast(block)

        def scan_rows(batches: Iterator[pd.DataFrame], sent=sent, number=number) -> Iterator[pd.DataFrame]:
            for batch in batches:
                found = [(k, *r) for k, r in zip(batch["k"], shards(batch["text"], sent.value)) if r[1] or not number]
                if not found:
                    continue
                yield pd.DataFrame({
                    "k": [r[0] for r in found], "n_words": [r[1] for r in found], "items": [r[2] for r in found], "spans": [as_spans(r[3]) for r in found]})

        passes.append(stored(rows.select(F.col(key).alias("k"), F.col("text").cast("string").alias("text")).mapInPandas(scan_rows, f"k bigint, {FOUND}"), "pass"))
        sent.destroy()
    joined = reduce(DataFrame.unionByName, passes).groupBy("k").agg(
        F.max("n_words").alias("n_words"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.flatten(F.collect_list("spans")).alias("spans"))
    merge = F.pandas_udf(lambda column: column.map(merged_spans), "array<struct<first:int,last:int>>", F.PandasUDFType.SCALAR)
    joined = joined.select(F.col("k").alias(key), F.struct("n_words", "items", merge("spans").alias("spans")).alias(name))
    others = [F.col(f"`{c}`") for c in rows.columns if c.lower() not in (key.lower(), name.lower())]
    return rows.select(key, *others).join(joined, key).drop(key)


def hit_words(found: Column) -> Column:
    return F.aggregate(found["spans"], F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])


def contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)


def op9_decontamination(spark, folder: str) -> DataFrame:
    x = find_contamination(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))
    x = x.select("doc_id", F.col("found.n_words").alias("n_words"), hit_words(F.col("found")).alias("n_hit"), F.col("found.items").alias("items"))
    return x.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


_FOLDED = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP9_SQL = f"""WITH d AS (SELECT doc_id, {_FOLDED} AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_FOLDED} AS w FROM benchmark),
i AS (SELECT item, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS pos FROM b WHERE len(w) > 0),
p AS (SELECT DISTINCT item, k, array_to_string(w[pos:pos + k - 1], ' ') AS phrase FROM i),
n AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS pos FROM d, (SELECT DISTINCT k FROM p)),
h AS (SELECT doc_id, item, pos, n.k FROM n JOIN p ON p.k = n.k AND phrase = array_to_string(w[pos:pos + n.k - 1], ' ')),
c AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + k)) AS j FROM h) GROUP BY doc_id),
s AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN s USING (doc_id)"""
