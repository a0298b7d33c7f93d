"""Repeated windows of fixed length over all documents, from a content-defined sample of positions.

Every window has an anchor: the position, among its first ones, where the hash
of the following symbols is least. Equal windows have equal anchors at equal
distance, so the anchors are a cover of all windows that depends on content
only, as a difference cover depends on position only, and about one position in
35 is kept. All windows of one anchor lie in one run of starts.

1. A core is the content that all windows of an anchor share. Anchors whose
   core occurs once have no repeated window and are dropped.
2. Anchors with the same whole run (all its windows) form a class: all members
   but the first repeat an earlier place, window by window.
3. First members whose core is also the core of another class hold the borders
   of repeats. They are sorted as suffixes from their anchors on, and as
   reversed prefixes, and adjacent ones are compared: the longest common
   prefixes bound which windows can occur twice. Only those are compared one by
   one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import OFFSET_BITS, stored

_SALTS = np.random.default_rng(20).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    """64-bit hash of pairs."""
    x = a * _SALTS[2 * salt] + b * _SALTS[2 * salt + 1]
    x ^= x >> np.uint64(29)
    x *= _SALTS[2 * salt + 32]
    x ^= x >> np.uint64(32)
    return x


@dataclass(frozen=True)
class Shape:
    """Window length, number of starts among which the anchor is chosen, symbols hashed to choose it, largest power used."""

    window: int
    reach: int
    gram: int
    power: int

    @property
    def core(self) -> int:
        """Symbols after the anchor that every window with this anchor contains."""
        return self.window - self.reach + 1


class Hashed:
    """Hashes of all substrings with a length that is a power of two, by doubling."""

    def __init__(self, symbols: np.ndarray, shape: Shape):
        self.shape, self.level = shape, {1: symbols}
        size = 1
        while size < shape.power:
            h = self.level[size]
            self.level[2 * size] = mix(h[:-size], h[size:], size.bit_length()) if len(h) > size else h[:0]
            if size not in (shape.gram, shape.power // 2):
                del self.level[size]
            size *= 2

    def fixed(self, at: np.ndarray, length: int, power: int, salt: int) -> np.ndarray:
        """Hash of the substrings of this length, from two of the given power that cover it."""
        h = self.level[power]
        return mix(h[at], h[at + (length - power)], salt)

    def runs(self, at: np.ndarray, length: np.ndarray, salt: int) -> np.ndarray:
        """Hash of substrings of varying length, from window to twice the window, and of the length."""
        q, h = self.shape.power, self.level[self.shape.power]
        return mix(mix(h[at], h[at + (length - q) // 2], salt), mix(h[at + length - q], length.astype(np.uint64), salt + 1), salt + 2)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of values[p:p + width] for every p, from running minima of blocks in both directions."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    block = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(block, 1).ravel()
    back = np.minimum.accumulate(block[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def anchor_runs(hashed: Hashed, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first start, last start, anchor) of every run of windows with one anchor; documents of the given sizes lie end to end."""
    shape, none = hashed.shape, np.empty(0, np.int64)
    total = int(sizes.sum())
    if total < shape.window:
        return none, none, none
    grams = hashed.level[shape.gram]
    ranked = (grams >> np.uint64(32) << np.uint64(32)) | np.arange(len(grams), dtype=np.uint64)  # ties: the leftmost
    anchor = (sliding_least(ranked, shape.reach) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    left = np.repeat(np.cumsum(sizes), sizes)[: total - shape.window + 1] - np.arange(total - shape.window + 1)
    start = np.flatnonzero(left >= shape.window)  # windows within one document
    if not len(start):
        return none, none, none
    anchor = anchor[start]
    new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)))
    begin = np.flatnonzero(new)
    end = np.concatenate((begin[1:], [len(start)])) - 1
    return start[begin], start[end], anchor[begin]


@dataclass(frozen=True)
class Alphabet:
    """Texts to 64-bit symbols, symbols to bytes of ``width`` each without loss, and back."""

    symbols: Callable[[Iterator[str | None]], Iterator[np.ndarray]]
    pack: Callable[[np.ndarray], bytes]
    unpack: Callable[[bytes], np.ndarray]
    width: int


def pieces(symbols: Iterator[np.ndarray], shape: Shape, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Documents end to end in pieces of about ``limit`` symbols: (symbols, number, offset, size) per part.

    A longer document is cut into parts that overlap by window - 1 symbols, so
    that each window lies in exactly one part.
    """
    held, number, offset, size, total = [], [], [], [], 0

    def out():
        return np.concatenate(held), np.array(number), np.array(offset), np.array(size)

    for k, x in enumerate(symbols):
        for first in range(0, max(1, len(x) - shape.window + 1), limit):
            part = x[first : first + limit + shape.window - 1]
            if len(part) < shape.window:
                continue
            held.append(part)
            number.append(k)
            offset.append(first)
            size.append(len(part))
            total += len(part)
            if total >= limit:
                yield out()
                held, number, offset, size, total = [], [], [], [], 0
    if held:
        yield out()


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    return n - -(-(int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])).bit_length() // 8) if n else 0


def adjacent_reach(batches: Iterator[pd.DataFrame], column: str, width: int) -> Iterator[pd.DataFrame]:
    """Rows sorted by (core, column) with ``reach``: symbols that the row shares with the neighbour it shares most with.

    Neighbours beyond the partition are unknown; the rows at its ends get their
    full length, which keeps too much rather than too little.
    """
    held, shared = None, 0
    for batch in batches:
        if not len(batch):
            continue
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        core, text = rows["core"].to_numpy(), rows[column].tolist()
        first = len(text[0]) if held is None else shared
        pairs = [common_prefix(x, y) if same else 0 for x, y, same in zip(text, text[1:], core[:-1] == core[1:])]
        before, after = np.array([first, *pairs]), np.array([*pairs, 0])
        held, shared = rows.iloc[-1:], before[-1]
        yield rows.iloc[:-1].assign(reach=(np.maximum(before, after)[:-1] // width).astype(np.int32))
    if held is not None:
        yield held.assign(reach=np.array([len(held[column].iloc[0]) // width], np.int32))


def place(n: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Number and offset in one long, in their order; refuses offsets that would lie in the next document."""
    if len(offset) and offset.max() >= 1 << OFFSET_BITS:
        raise ValueError(f"a text of more than {1 << OFFSET_BITS} symbols")
    return (n << OFFSET_BITS) + offset


def repeated_runs(docs: DataFrame, alphabet: Alphabet, shape: Shape, purpose: str, earlier_only: bool, limit: int = 1 << 20) -> DataFrame:
    """(n, first, last): runs of window starts that are repeated, of docs (n, text) with unique n.

    With ``earlier_only`` a window counts if it also starts earlier, by n and
    then offset; else if it starts anywhere else. Two passes over the texts:
    the second for the borders only. Cores and runs are compared by two 64-bit
    hashes together.
    """
    def sample(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n = batch["n"].to_numpy()
            for x, number, offset, size in pieces(alphabet.symbols(iter(batch["text"])), shape, limit):
                h = Hashed(x, shape)
                first, last, anchor = anchor_runs(h, size)
                start = np.cumsum(size) - size
                part = np.searchsorted(start, first, "right") - 1
                yield pd.DataFrame({
                    "core": h.fixed(anchor, shape.core, shape.gram, 10).view(np.int64),
                    "run": h.runs(first, last - first + shape.window, 11).view(np.int64) ^ (anchor - first),
                    "place": place(n[number[part]], offset[part] + first - start[part]),
                    "form": ((last - first) << 16 | (anchor - first)).astype(np.int32),
                })

    more, back = F.shiftright("form", 16), F.col("form").bitwiseAND(F.lit(0xFFFF))
    number, offset = F.shiftright("place", OFFSET_BITS), F.col("place").bitwiseAND(F.lit((1 << OFFSET_BITS) - 1)).cast("int")
    anchors = docs.select("n", "text").mapInPandas(sample, "core bigint, run bigint, place bigint, form int")
    # Counts are stored before they are joined: only then does a join split what a frequent core brings together.
    shared = stored(anchors.groupBy("core").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("core"), f"{purpose}-cores")
    found = stored(anchors.join(shared, "core"), f"{purpose}-anchors")

    classes = stored(
        found.groupBy("core", "run").agg(F.min("place").alias("lead"), F.count(F.lit(1)).alias("members"), F.min("form").alias("form")), f"{purpose}-classes")
    mixed = classes.groupBy("core").agg(F.count(F.lit(1)).alias("classes")).filter("classes > 1").select("core")
    mixed = stored(mixed, f"{purpose}-mixed")
    leads = classes.join(mixed, "core").withColumn("place", F.col("lead"))
    copies = found.join(classes.filter("members > 1").select("core", "run", "lead"), ["core", "run"])
    copies = copies.filter("place > lead") if earlier_only else copies
    whole = stored(copies.select(number.alias("n"), offset.alias("first"), (offset + more).alias("last")), f"{purpose}-copies")
    by_doc = leads.select(
        number.alias("n"), F.struct(offset.alias("first"), more.alias("more"), back.alias("back"), "core", (F.col("members") > 1).alias("copied")).alias("r"),
    ).groupBy("n").agg(F.collect_list("r").alias("runs"))  # at most the anchors of one document

    def border(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for n, text, runs in zip(batch["n"], batch["text"], batch["runs"]):
                x = next(alphabet.symbols(iter([text])))
                for r in runs:
                    at = r["first"] + r["back"]
                    rows.append((r["core"], (n << OFFSET_BITS) + r["first"], r["more"], r["copied"], alphabet.pack(x[r["first"]:at][::-1]),
                                 alphabet.pack(x[at:r["first"] + r["more"] + shape.window])))
            yield pd.DataFrame(rows, columns=["core", "place", "more", "copied", "ahead", "behind"])

    kind = "core bigint, place bigint, more int, copied boolean, ahead binary, behind binary"
    borders = stored(docs.select("n", "text").join(by_doc, "n").mapInPandas(border, kind), f"{purpose}-borders")

    def suffixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in adjacent_reach(batches, "behind", alphabet.width):
            yield rows[rows["reach"] >= shape.core].rename(columns={"reach": "right"})

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in adjacent_reach(batches, "ahead", alphabet.width):
            for first in range(0, len(rows), 4096):  # bounds the symbols held at once
                part = rows.iloc[first:first + 4096]
                before = part["ahead"].str.len().to_numpy() // alphabet.width
                # A window that starts d before the anchor needs d shared symbols before it and window - d after it.
                low = np.maximum(0, before - part["reach"].to_numpy())
                high = np.minimum(part["more"].to_numpy(), before - shape.window + part["right"].to_numpy())
                count = np.maximum(0, high - low + 1)
                if not count.sum():
                    continue
                texts = [np.concatenate((alphabet.unpack(a)[::-1], alphabet.unpack(b))) for a, b in zip(part["ahead"], part["behind"])]
                start = np.cumsum([0, *map(len, texts)])[:-1]
                step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - low, count)
                h = Hashed(np.concatenate(texts), shape)
                yield pd.DataFrame({
                    "core": np.repeat(part["core"].to_numpy(), count), "window": h.fixed(np.repeat(start, count) + step, shape.window, shape.power, 14).view(np.int64),
                    "place": np.repeat(part["place"].to_numpy(), count) + step, "copied": np.repeat(part["copied"].to_numpy(), count),
                })

    # The place only splits equal contents over partitions; their order does not matter.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = borders.repartitionByRange(parts, "core", "behind", "place").sortWithinPartitions("core", "behind").mapInPandas(suffixes, kind + ", right int")
    single = stored(
        kept.repartitionByRange(parts, "core", "ahead", "place").sortWithinPartitions("core", "ahead").mapInPandas(windows, "core bigint, window bigint, place bigint, copied boolean"),
        f"{purpose}-windows")
    met = stored(single.groupBy("core", "window").agg(F.min("place").alias("lead"), F.count(F.lit(1)).alias("rows")).filter("rows > 1"), f"{purpose}-met")
    again = single.join(met.select("core", "window", "lead"), ["core", "window"])
    again = again.filter("place > lead") if earlier_only else again.filter("not copied")
    again = stored(again.select(number.alias("n"), offset.alias("first"), offset.alias("last")), f"{purpose}-single")
    return whole.union(again)


def merged(first: np.ndarray, last: np.ndarray) -> list[tuple[int, int]]:
    """Runs (first, last inclusive) joined where they touch or overlap, as half-open intervals."""
    order = np.argsort(first, kind="stable")
    out: list[tuple[int, int]] = []
    for a, b in zip(first[order].tolist(), last[order].tolist()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b + 1))
        else:
            out.append((a, b + 1))
    return out
