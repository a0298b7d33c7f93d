import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelle.llm import near_dup, substrings, suffix_dedup
from parcelle.llm.common import components, numbered
from parcelle.llm.repeats import Hashed, Shape, anchor_runs, merged, pieces, sliding_least

from .helpers import awkward_texts, documents, duplicate_roots, removed_bytes, removed_words, words


def by_id(frame, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in frame.collect()}


def length(spans):
    return sum(s["last"] - s["first"] for s in spans)


def test_bytes_like_brute_force(spark):
    texts = awkward_texts()
    got = {r["doc_id"]: (r["n_bytes"], length(r["spans"]), len(r["spans"]), r["kept_sha256"]) for r in suffix_dedup.remove_repeats(documents(spark, texts)).collect()}
    assert got == dict(enumerate(removed_bytes(texts)))


def test_words_like_brute_force(spark):
    texts = awkward_texts()
    got = {r["doc_id"]: (r["n_words"], length(r["spans"]), r["kept_sha256"]) for r in substrings.remove_passages(documents(spark, texts)).collect()}
    assert got == dict(enumerate(removed_words(texts)))


def test_components_of_near_copies_like_brute_force(spark):
    rng = random.Random(3)
    texts = awkward_texts()
    for n in (20, 60, 200):
        base = words(rng, n).split()
        for k in range(12):  # a chain of small edits
            base = base[:]
            base[rng.randrange(n)] = f"e{k}"
            texts.append(" ".join(base))
    rows = numbered(documents(spark, texts))
    want = duplicate_roots(texts)
    got = by_id(near_dup.near_duplicates(rows), "n_shingles", "root_id", "kept")
    assert got == {i: (n, r, r == i) for i, (n, r) in enumerate(want)}


def test_near_copies_at_the_librarys_setting(spark):
    texts = awkward_texts()
    roots = duplicate_roots(texts, 5, 80)
    kept = near_dup.drop_near_duplicates(documents(spark, texts).withColumn("n", F.lit(7)).withColumn("row", F.lit("x")), 5, 80)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "n", "row"]
    assert {r["doc_id"] for r in kept.collect()} == {i for i, (_, r) in enumerate(roots) if r == i}


@pytest.mark.parametrize("run", [suffix_dedup.remove_repeats, substrings.remove_passages, lambda d: near_dup.near_duplicates(numbered(d))])
def test_empty_table(spark, run):
    assert run(documents(spark, ["a"]).limit(0)).count() == 0


def test_null_and_repeated_ids_get_numbers_in_order(spark):
    rows = [(5, "b"), (5, "b"), (None, "z"), (2, "a"), (1 << 50, "c"), (5, "a")]
    got = sorted(numbered(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert [r["n"] for r in got] == list(range(6))
    assert [r["doc_id"] for r in got] == [2, 5, 5, 5, 1 << 50, None]
    x = suffix_dedup.remove_repeats(spark.createDataFrame([(1, "q" * 150 + "é"), (1, "q" * 150 + "é"), (None, None)], "doc_id bigint, text string"))
    assert sorted(length(r["spans"]) for r in x.collect()) == [0, 149, 152]


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 3), (20, 21), (21, 20), (5, 5)] + [(100 + i, 101 + i) for i in range(60)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[k] for k in (1, 2, 3, 9)} == {1} and got[21] == 20 and {got[100 + i] for i in range(61)} == {100} and 5 not in got


def test_sliding_least():
    rng = np.random.default_rng(1)
    for n in (7, 20, 64):
        x = rng.integers(0, 50, n).astype(np.uint64)
        assert sliding_least(x, 7).tolist() == [x[i:i + 7].min() for i in range(n - 6)]


def test_every_window_lies_in_one_run_also_across_pieces():
    shape = Shape(window=10, reach=7, gram=4, power=8)
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 3, n).astype(np.uint64) for n in (0, 9, 10, 57, 200)]
    seen = []
    for x, number, offset, size in pieces(iter(docs), shape, 50):
        start = np.cumsum(size) - size
        for a, b, anchor in zip(*anchor_runs(Hashed(x, shape), size)):
            part = np.searchsorted(start, a, "right") - 1
            assert a <= b <= anchor <= a + 6
            seen += [(int(number[part]), int(offset[part] + p - start[part])) for p in range(a, b + 1)]
    assert sorted(seen) == [(k, p) for k, d in enumerate(docs) for p in range(len(d) - 9)]


def test_merged():
    assert merged(np.array([5, 0, 6, 20]), np.array([5, 3, 9, 21])) == [(0, 4), (5, 10), (20, 22)]


def test_sketch_estimates_high_similarity(spark):
    rng, rows = np.random.default_rng(4), []
    for share in (70, 78, 83, 86, 95):
        for size in (100, 1000, 2047, 2300, 9000):
            for _ in range(8):
                common = rng.integers(0, 1 << 63, size, dtype=np.uint64)
                extra = int(size * (100 / share - 1) / 2)
                pair = [np.concatenate((common, rng.integers(0, 1 << 63, extra, dtype=np.uint64))) for _ in "ab"]
                one = [{"level": k, **{f"{n}{i}": v for i in (0, 1) for n, v in zip(("size", "bits"), near_dup.odd_sketch(x, k + i))}}
                       for x in pair for k in [near_dup.sample_level(len(x))]]
                rows.append((share, *({**o, "bits0": o["bits0"].tolist(), "bits1": o["bits1"].tolist()} for o in one)))
    kind = "struct<level:int,size0:int,bits0:array<bigint>,size1:int,bits1:array<bigint>>"
    got = spark.createDataFrame(rows, f"share int, a {kind}, b {kind}").select("share", near_dup.similar("a", "b", 85).alias("ok")).collect()
    assert all(r["ok"] for r in got if r["share"] >= 86) and not any(r["ok"] for r in got if r["share"] <= 70)
    assert sum(r["ok"] for r in got if r["share"] == 78) <= 24


def test_numbers_that_do_not_fit_are_refused(spark, monkeypatch):
    from parcelle.llm import common

    docs = spark.createDataFrame([(i, "a") for i in range(9)], "doc_id bigint, text string")
    monkeypatch.setattr(common, "NUMBER_BITS", 3)
    with pytest.raises(ValueError, match="9 rows"):
        common.numbered(docs)
    assert common.numbered(docs.limit(8)).count() == 8


def test_offsets_that_do_not_fit_are_refused():
    from parcelle.llm import repeats
    from parcelle.llm.common import NUMBER_BITS, OFFSET_BITS

    numbers = np.array([-(1 << NUMBER_BITS), 0, 5, (1 << NUMBER_BITS) - 1])
    ends = repeats.place(numbers, np.array([(1 << OFFSET_BITS) - 1] * 4))
    assert (repeats.place(numbers, np.zeros(4, np.int64)) == numbers * (1 << OFFSET_BITS)).all() and (ends >> OFFSET_BITS == numbers).all()
    with pytest.raises(ValueError, match="symbols"):
        repeats.place(numbers, np.array([0, 0, 1 << OFFSET_BITS, 0]))
