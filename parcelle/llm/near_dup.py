"""Near-duplicates by MinHash bands, odd sketches and full sets.

1. Texts with the same shingle set are folded into their first.
2. Bands of the MinHash signature bring similar sets together. In each band
   bucket every member is paired only with the hub, the member that meets the
   most others over all its buckets.
3. An odd sketch (Mitzenmacher, Pagh and Pham 2014) folds a MinHash sample, the
   shingles with the least hashes (all of them, for most texts), into a parity
   bitmap; the ones in the XOR of two sketches estimate in how many elements
   the samples differ, precisely for similar sets. Pairs clearly below the
   threshold are left out; all others are confirmed on their full sets.
4. In buckets that hold more than one component after that, all members
   outside the bucket's largest component meet all members of other
   components. So any two members of a bucket are in one component or compared.
5. Buckets with more than ``FEW`` members outside the largest component, such as
   texts of one template that stay below the threshold, would need a square of
   pairs. Their members meet by rare shingles instead (``meet_by_prefix``): with
   shingles in the order of their frequency, rarest first, two similar sets
   share one among the first few of each. This loses no pair at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import components, numbered, stored, table
from .repeats import mix

#: Two sets are linked if 100 * intersection >= SHARE * union.
SHARE = 85
#: Rows of a band, and the probability with which a pair of exactly the threshold's similarity may miss all bands.
ROWS, MISS = 5, 1e-7
SKETCH_LONGS = 16
#: A sample holds the shingles whose hash is below 2 ** -level of the range; level 0 up to this many shingles.
SAMPLE = 2048
#: Standard deviations of the estimate by which a pair must miss the threshold to be left out. A pair at the threshold
#: whose sets are whole samples is left out with a probability below 1e-5, for any sizes (a test adds up the exact
#: distribution). Of larger sets both the sample and the bits vary, each with this allowance of its own.
SIGMAS = 5.0
#: Members outside its largest component up to which all pairs of a bucket are tried; each row then meets at most these.
FEW = 200
#: Bits of a shingle's hash by which frequencies are counted: 8 MB of them in every task that puts shingles in order.
PLACE_BITS = 20


def band_count(share: int) -> int:
    return max(1, ceil(log(MISS) / log(1 - min(0.99, share / 100) ** ROWS)))


class Hashes:
    """The linear hashes of a signature with the bands that the threshold needs."""

    def __init__(self, share: int):
        self.bands = band_count(share)
        rows, draw = self.bands * ROWS, np.random.default_rng(8)
        self.a = draw.integers(0, 1 << 31, rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.b = draw.integers(0, 1 << 32, rows, dtype=np.uint32)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """Least values of the hashes over the shingles."""
        low = (shingles >> np.uint64(32)).astype(np.uint32)
        least = np.full(len(self.a), np.iinfo(np.uint32).max, np.uint32)
        for first in range(0, len(low), 1024):
            np.minimum(least, (self.a[:, None] * low[first : first + 1024] + self.b[:, None]).min(1), out=least)
        return least

    def band_keys(self, least: np.ndarray) -> np.ndarray:
        rows = least.astype(np.uint64).reshape(self.bands, ROWS)
        key = np.arange(self.bands, dtype=np.uint64)
        for r in range(ROWS):
            key = mix(key, rows[:, r], 15)
        return key.view(np.int64)


def sample_level(size: int) -> int:
    return max(0, (size - 1) // SAMPLE).bit_length()


def odd_sketch(shingles: np.ndarray, level: int) -> tuple[int, np.ndarray]:
    """Size and parity bitmap of the sample at a level: every shingle in it flips one bit."""
    order = mix(shingles, shingles, 13)
    sample = shingles[order >> np.uint64(64 - level) == 0] if level else shingles
    bit = (sample * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(54)
    parity = np.bincount(bit.astype(np.int64), minlength=64 * SKETCH_LONGS) & 1
    return len(sample), np.packbits(parity.astype(np.uint8)).view(np.int64)


class Shingler:
    """Distinct hashed shingles of texts: lower case A-Z, windows of ``size`` words, a shorter text as one shingle."""

    def __init__(self, size: int):
        self.size, self.known = size, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if len(self.known) > 200_000:  # bounds memory; forgotten words are hashed again
            self.known.clear()
        known = self.known
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
        h = np.array([known[w] for w in words], np.uint64)
        if 0 < len(h) < self.size:
            return np.array([xxhash.xxh64_intdigest(h.tobytes(), len(h))], np.uint64)
        out = h[: max(0, len(h) - self.size + 1)]
        for k in range(1, self.size):
            out = mix(out, h[k : k + len(out)], 15)
        return np.unique(out)


def most_ones(total: Column, level: Column, share: int) -> Column:
    """Ones in the XOR of two odd sketches of samples of ``total`` elements together, beyond which a pair is left out.

    At the threshold the samples differ in d elements. Each flips one of the
    bits, and flips that meet cancel; samples also vary around their sets.
    """
    bits, t = 64.0 * SKETCH_LONGS, share / 100
    d = total * (1 - t) / (1 + t) + F.when(level > 0, SIGMAS * F.sqrt(total * (1 - t) / (1 + t))).otherwise(0.0)
    decay = F.exp(-4 * d / bits)
    spread = F.sqrt(F.greatest(F.lit(0.0), bits / 4 * (1 - decay) - d * decay))
    return bits / 2 * (1 - F.exp(-2 * d / bits)) + SIGMAS * spread + 1


def similar(a: str, b: str, share: int) -> Column:
    """Two odd sketches, at the higher level, do not differ too much for the threshold.

    Sets whose levels differ by more than one are too unequal in size.
    """
    def at_level(x: str, k: str, y: str, m: str) -> Column:
        ones = sum((F.bit_count(F.get(F.col(f"{x}.bits{k}"), i).bitwiseXOR(F.get(F.col(f"{y}.bits{m}"), i))) for i in range(SKETCH_LONGS)), F.lit(0))
        level = F.greatest(F.col(f"{a}.level"), F.col(f"{b}.level"))
        return ones <= most_ones(F.col(f"{x}.size{k}") + F.col(f"{y}.size{m}"), level, share)

    step = F.col(f"{a}.level") - F.col(f"{b}.level")
    return F.when(step == 0, at_level(a, "0", b, "0")).when(step == 1, at_level(a, "0", b, "1")).when(step == -1, at_level(a, "1", b, "0")).otherwise(F.lit(False))


def at_levels(rows: DataFrame, side: str) -> DataFrame:
    """Each row at its own level and one above, with the bitmap in columns of its own: cheap to test in a join."""
    both = F.array(*[
        F.struct((F.col("sketch.level") + k).alias("level"), F.lit(k == 1).alias("above"), F.col(f"sketch.size{k}").alias("size"), F.col(f"sketch.bits{k}").alias("bits"))
        for k in (0, 1)])
    x = rows.select(*[F.col(c).alias(c if c == "key" else f"{side}_{c}") for c in rows.columns if c != "sketch"], F.explode(both).alias("s"))
    return x.select(
        *[c for c in x.columns if c != "s"], F.col("s.level").alias("level"), F.col("s.above").alias(f"{side}_above"), F.col("s.size").alias(f"{side}_size"),
        *[F.get("s.bits", i).alias(f"{side}_{i}") for i in range(SKETCH_LONGS)])


def similar_at_level(share: int) -> Column:
    """``similar`` for rows x and y that were joined on the level."""
    ones = sum((F.bit_count(F.col(f"x_{i}").bitwiseXOR(F.col(f"y_{i}"))) for i in range(SKETCH_LONGS)), F.lit(0))
    return ~(F.col("x_above") & F.col("y_above")) & (ones <= most_ones(F.col("x_size") + F.col("y_size"), F.col("level"), share))


def described(docs: DataFrame, size: int, share: int) -> DataFrame:
    """(n, doc_id, n_shingles, s1, s2, bands, sketch) of numbered docs; s1 and s2 name the set."""
    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles, hashes = Shingler(size), Hashes(share)
        for batch in (b.iloc[k:k + 500] for b in batches for k in range(0, len(b), 500)):  # bounds the sets held at once
            sets = [shingles(t) for t in batch["text"]]
            levels = [sample_level(len(x)) for x in sets]
            own = [odd_sketch(x, k) for x, k in zip(sets, levels)]
            above = [odd_sketch(x, k + 1) for x, k in zip(sets, levels)]
            yield pd.DataFrame({
                "n": batch["n"], "doc_id": batch["doc_id"].astype("Int64"), "n_shingles": [len(s) for s in sets],
                "s1": [xxhash.xxh64_intdigest(s.tobytes(), 1) - (1 << 63) for s in sets],
                "s2": [xxhash.xxh64_intdigest(s.tobytes(), 2) - (1 << 63) for s in sets],
                "bands": [hashes.band_keys(hashes.signature(x)) for x in sets], "level": levels,
                "size0": [o[0] for o in own], "bits0": [o[1] for o in own], "size1": [o[0] for o in above], "bits1": [o[1] for o in above],
            })

    sketch = ["level", "size0", "bits0", "size1", "bits1"]
    x = docs.select("n", "doc_id", "text").mapInPandas(
        describe, "n bigint, doc_id bigint, n_shingles bigint, s1 bigint, s2 bigint, bands array<bigint>,"
        " level int, size0 int, bits0 array<bigint>, size1 int, bits1 array<bigint>")
    return x.withColumn("sketch", F.struct(*sketch)).drop(*sketch)


def with_sketches(pairs: DataFrame, sketches: DataFrame, share: int) -> DataFrame:
    """Pairs (a, b) whose sketches are similar enough to be confirmed."""
    left = sketches.select(F.col("n").alias("a"), F.col("sketch").alias("sketch_a"))
    right = sketches.select(F.col("n").alias("b"), F.col("sketch").alias("sketch_b"))
    return pairs.join(left, "a").join(right, "b").filter(similar("sketch_a", "sketch_b", share)).select("a", "b")


def confirmed(pairs: DataFrame, docs: DataFrame, size: int, share: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold. Only texts of pairs are turned into sets."""
    pairs = stored(pairs, "pairs")

    def to_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingler(size)
        for batch in batches:
            yield pd.DataFrame({"n": batch["n"], "shingles": [shingles(t).tobytes() for t in batch["text"]]})

    wanted = pairs.select(F.col("a").alias("n")).union(pairs.select("b")).distinct()
    sets = stored(docs.select("n", "text").join(wanted, "n").mapInPandas(to_sets, "n bigint, shingles binary"), "sets")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["set_a"], batch["set_b"]):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= share * (len(p) + len(q) - both))
            yield batch.loc[keep, ["a", "b"]]

    left = sets.select(F.col("n").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("n").alias("b"), F.col("shingles").alias("set_b"))
    return stored(pairs.join(left, "a").join(right, "b").mapInPandas(compare, "a bigint, b bigint"), "links")


def frequencies(sets: DataFrame) -> np.ndarray:
    """Occurrences of shingles by the first ``PLACE_BITS`` bits of their hash: a table of fixed size."""
    place = F.shiftrightunsigned(F.col("key"), 64 - PLACE_BITS).alias("place")
    counts = sets.select(F.explode("shingles").alias("key")).groupBy(place).agg(F.count(F.lit(1)).alias("rows")).toArrow()
    found = np.zeros(1 << PLACE_BITS, np.int64)
    found[counts["place"].to_numpy()] = counts["rows"].to_numpy()
    return found


def prefixes(crowded: DataFrame, docs: DataFrame, size: int, share: int) -> DataFrame:
    """(key, n, root, size, low) of the rows (n, root): the shingles by which similar sets must meet.

    Sets of sizes a <= b that reach the threshold have at least s(a + b) / (100 + s)
    shingles in common, which is sb / 100 or more. If all shingles stand in one
    order, the first common one is therefore followed by that many less one in
    either set. ``low`` counts a set's shingles from the end; those with too few
    behind them for any partner are left out. Shingles of a single row stand
    first and are no keys.

    Any order will do, so a shingle's own frequency need not be looked up: the
    order is by the frequency of its place among ``1 << PLACE_BITS``, which is no
    less, then by hash. A shingle alone in its place is one of a single row.
    """
    def to_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingler(size)
        for batch in (b.iloc[k:k + 100] for b in batches for k in range(0, len(b), 100)):
            yield pd.DataFrame({"n": batch["n"], "root": batch["root"], "shingles": [shingles(t).view(np.int64) for t in batch["text"]]})

    sets = stored(docs.select("n", "text").join(crowded, "n").mapInPandas(to_sets, "n bigint, root bigint, shingles array<bigint>"), "crowded_sets")
    frequent = sets.sparkSession.sparkContext.broadcast(frequencies(sets))

    def first_ones(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (b.iloc[k:k + 100] for b in batches for k in range(0, len(b), 100)):
            for n, root, shingles in zip(batch["n"], batch["root"], batch["shingles"]):
                keys = np.asarray(shingles, np.int64)
                rows = frequent.value[keys.view(np.uint64) >> np.uint64(64 - PLACE_BITS)]
                order = np.lexsort((keys, rows))[::-1]
                low = np.arange(1, len(keys) + 1)
                wanted = (low * 100 >= len(keys) * share) & (rows[order] > 1)
                yield pd.DataFrame({"key": keys[order][wanted], "n": n, "root": root, "size": len(keys), "low": low[wanted]})

    return sets.mapInPandas(first_ones, "key bigint, n bigint, root bigint, size bigint, low bigint")


def size_class(size: Column) -> Column:
    """Classes of sizes at most two per cent apart."""
    return F.floor(F.log(size.cast("double")) * 50)


def meet_by_prefix(crowded: DataFrame, docs: DataFrame, size: int, share: int) -> DataFrame:
    """Pairs (a, b) of the rows (n, root) of different roots, among them all whose full sets reach the threshold.

    Rows meet where a shingle may be their first common one: both must have
    s(a + b) / (100 + s) shingles from there on. The larger row goes to the size
    classes of the partners that its own place allows, so a row far down its
    prefix meets much smaller ones only. At each shingle, rows of the largest
    component meet only rows outside it.
    """
    keys = stored(prefixes(crowded, docs, size, share), "prefixes")
    parts = stored(keys.groupBy("key", "root").agg(F.count(F.lit(1)).alias("rows")), "prefix_parts")
    largest = parts.groupBy("key").agg(F.max_by("root", F.struct("rows", "root")).alias("largest"), F.count(F.lit(1)).alias("parts"))
    least, most = F.ceil(F.col("size") * share / 100), F.least("size", F.floor(F.col("low") * (100 + share) / share) - F.col("size"))
    met = keys.filter(least <= most).join(stored(largest.filter("parts > 1").select("key", "largest"), "largest_parts"), "key")
    met = stored(met, "met")
    y = stored(
        met.withColumn("class", F.explode(F.sequence(size_class(least), size_class(most)))), "larger")
    x = stored(met.filter(F.col("low") * (100 + share) >= F.col("size") * (2 * share)).withColumn("class", size_class(F.col("size"))), "smaller")
    inside, outside = F.col("root") == F.col("largest"), F.col("root") != F.col("largest")
    pairs = None
    for smaller, larger in ((x.filter(outside), y), (x.filter(inside), y.filter(outside))):
        p = smaller.select("key", "class", *[F.col(c).alias(f"x_{c}") for c in ("n", "root", "size", "low")])
        q = larger.select("key", "class", *[F.col(c).alias(f"y_{c}") for c in ("n", "root", "size", "low")])
        common = (F.col("x_size") + F.col("y_size")) * share <= F.least("x_low", "y_low") * (100 + share)
        fit = (F.col("x_root") != F.col("y_root")) & (F.col("x_size") <= F.col("y_size")) & common
        found = p.join(q, ["key", "class"]).filter(fit).select(F.least("x_n", "y_n").alias("a"), F.greatest("x_n", "y_n").alias("b"))
        pairs = found if pairs is None else pairs.union(found)
    return pairs.distinct()


def near_duplicates(docs: DataFrame, size: int = 3, share: int = SHARE, few: int = FEW) -> DataFrame:
    """(n, doc_id, n_shingles, root_id, kept) of every row of numbered docs.

    ``root_id`` is the doc_id of the first row of the component. Texts without
    words, and null texts, are linked with nothing. Repeated rows are copies of
    each other. Defaults are the contract's; the library's usual setting is
    five words and a similarity of 80.
    """
    info = stored(described(docs, size, share), "signatures")
    # Groups are stored before they are joined: only then does a join split what a large group brings together.
    firsts = stored(info.filter("n_shingles > 0").groupBy("s1", "s2").agg(F.min("n").alias("first")), "firsts")
    reps = stored(info.join(firsts.select(F.col("first").alias("n")), "n").select("n", "bands", "sketch"), "representatives")
    in_bands = reps.select("n", F.explode("bands").alias("key"))
    buckets = stored(in_bands.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1"), "buckets")
    members = stored(in_bands.join(buckets, "key"), "members")
    # The text that meets the most others is likeliest the one that the others are copies of.
    degree = members.groupBy("n").agg(F.sum("rows").alias("degree"))
    ranked = stored(members.join(degree, "n").select("key", "n", "degree"), "ranked")
    hubs = stored(ranked.groupBy("key").agg(F.max_by("n", F.struct("degree", -F.col("n"))).alias("hub")), "hubs")
    stars = ranked.join(hubs, "key").filter("n <> hub").select(F.least("n", "hub").alias("a"), F.greatest("n", "hub").alias("b")).distinct()
    tried = stored(with_sketches(stars, reps, share), "stars")
    links = confirmed(tried, docs, size, share)
    roots = stored(components(links), "components")

    placed = members.join(roots.withColumnRenamed("node", "n"), "n", "left").select("key", "n", F.coalesce("root", "n").alias("root"))
    parts = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("rows"))
    largest = parts.groupBy("key").agg(
        F.max_by("root", F.struct("rows", "root")).alias("largest"), (F.sum("rows") - F.max("rows")).alias("others")).filter("others > 0")
    largest = stored(largest, "largest")
    open_rows = placed.join(largest.filter(F.col("others") <= few).drop("others"), "key")
    open_rows = stored(open_rows.join(reps.select("n", "sketch"), "n"), "open")
    left = at_levels(open_rows.filter("root <> largest").drop("largest"), "x")
    right = at_levels(open_rows, "y")
    once = (F.col("y_root") == F.col("y_largest")) | (F.col("x_n") < F.col("y_n"))
    apart = left.join(right, ["key", "level"]).filter((F.col("x_root") != F.col("y_root")) & once & similar_at_level(share))
    more = apart.select(F.least("x_n", "y_n").alias("a"), F.greatest("x_n", "y_n").alias("b"))
    crowded = stored(placed.join(largest.filter(F.col("others") > few), "key").select("n", "root").distinct(), "crowded")
    if not crowded.isEmpty():
        more = more.union(with_sketches(meet_by_prefix(crowded, docs, size, share), reps, share))
    again = confirmed(more.distinct().join(tried, ["a", "b"], "left_anti"), docs, size, share)
    if not again.isEmpty():
        joined = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(again)
        roots = components(joined)

    out = info.select("n", "doc_id", "n_shingles", "s1", "s2").join(firsts, ["s1", "s2"], "left")
    out = out.withColumn("first", F.when(F.col("n_shingles") > 0, F.col("first")).otherwise(F.col("n")))
    out = out.join(roots.select(F.col("node").alias("first"), "root"), "first", "left").withColumn("root", F.coalesce("root", "first"))
    ids = info.select(F.col("n").alias("root"), F.col("doc_id").alias("root_id"))
    return out.join(ids, "root").select("n", "doc_id", "n_shingles", "root_id", (F.col("n") == F.col("root")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, size: int = 3, share: int = SHARE) -> DataFrame:
    """docs with the first document of each component only; same columns."""
    rows = numbered(docs, whole_rows=True)
    kept = near_duplicates(rows.select("n", "doc_id", "text"), size, share).filter("kept").select("n")
    return rows.select("n", "row").join(kept, "n").select("row.*")


def op8_near_dup(spark, folder: str) -> DataFrame:
    x = near_duplicates(numbered(table(spark, folder, "documents")))
    return x.select("doc_id", "n_shingles", F.col("root_id").alias("component_id"), "kept")


OP8_SQL = """WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * common >= 85 * (p.n + q.n - common)),
c AS (SELECT doc_id AS node, doc_id AS root FROM d UNION SELECT l.b, c.root FROM c JOIN l ON l.a = c.node WHERE c.root < l.b)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.root AS component_id, doc_id = m.root AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT node, min(root) AS root FROM c GROUP BY node) m ON m.node = doc_id"""
