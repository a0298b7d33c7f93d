"""Texts of one template in near-duplicate search: no square of pairs, no link lost; what the sketch leaves out."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelle.llm import near_dup
from parcelle.llm.common import numbered

from .helpers import documents, duplicate_roots, words


def template_texts(n, own, seed=1):
    """A template of 120 words, each time followed by ``own`` words that no other text has."""
    rng = random.Random(seed)
    template = words(rng, 120)
    return [template + " " + " ".join(f"own{i}x{k}" for k in range(own)) for i in range(n)]


def mixed_texts():
    """Texts of three templates on both sides of the threshold, groups of copies among them, and short ones."""
    rng = random.Random(7)
    texts = []
    for own in (4, 9, 11, 13, 20, 40):
        texts += template_texts(8, own, seed=own % 3)
    for t in list(texts[::3]):
        w = t.split()
        for k in (1, 3, 6):
            v = list(w)
            for p in rng.sample(range(len(w)), k):
                v[p] = f"new{rng.randrange(50)}"
            texts.append(" ".join(v))
    texts += [" ".join(f"s{rng.randrange(4)}" for _ in range(rng.randrange(1, 9))) for _ in range(60)]
    return texts + [texts[0], None, ""]


def sets_of(texts, size):
    split = [(t or "").lower().split() for t in texts]
    return [{tuple(w[p:p + size]) for p in range(max(1, len(w) - size + 1))} if w else set() for w in split]


@pytest.mark.parametrize("size, share", [(3, 85), (5, 80)])
def test_prefixes_lose_no_link(spark, size, share):
    texts = mixed_texts()
    docs = numbered(documents(spark, texts))
    rows = docs.filter("trim(text) <> ''").select("n", F.col("n").alias("root"))
    got = {(r["a"], r["b"]) for r in near_dup.meet_by_prefix(rows, docs, size, share).collect()}
    sets = sets_of(texts, size)
    want = {
        (a, b) for a in range(len(sets)) for b in range(a + 1, len(sets))
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= share * len(sets[a] | sets[b])}
    assert len(want) > 100 and want <= got
    # Rows of one root never meet.
    one = near_dup.meet_by_prefix(rows.withColumn("root", F.lit(0).cast("long")), docs, size, share)
    assert one.count() == 0


@pytest.mark.parametrize("size, share", [(3, 85), (5, 80)])
def test_crowded_buckets_same_as_brute_force(spark, size, share):
    texts = mixed_texts()
    want = duplicate_roots(texts, size, share)
    got = near_dup.near_duplicates(numbered(documents(spark, texts)), size, share, few=2).collect()
    assert {r["doc_id"]: r["root_id"] for r in got} == {i: root for i, (_, root) in enumerate(want)}


def test_pairs_of_a_template_grow_in_proportion(spark):
    """139 words of which 120 are the template's: similarity 0.76, seven shared buckets a pair."""
    counts = []
    for n in (250, 500, 1000):
        docs = numbered(documents(spark, template_texts(n, 19) + template_texts(n // 10, 3, seed=2)))
        rows = docs.select("n", F.col("n").alias("root"))
        counts.append(near_dup.meet_by_prefix(rows.filter(F.col("n") < n), docs, 3, 85).count())
    assert counts == [0, 0, 0]


@pytest.mark.parametrize("share", [80, 85])
def test_sketch_leaves_out_hardly_a_link(spark, share):
    """Exact: the odd bits after d flips of random bits are a Markov chain; d is the difference of a pair at the threshold."""
    bits = 64 * near_dup.SKETCH_LONGS
    totals = spark.range(2, 2 * near_dup.SAMPLE + 1).select(
        F.col("id").alias("total"), near_dup.most_ones(F.col("id"), F.lit(0), share).alias("most")).collect()
    most = {r["total"]: r["most"] for r in totals}
    odd = np.zeros(bits + 1)
    odd[0], k, worst, flips = 1.0, np.arange(bits + 1), 0.0, 0
    for total in range(2, 2 * near_dup.SAMPLE + 1):
        d = total * (100 - share) // (100 + share)
        while flips < d:
            up, down = odd * (1 - k / bits), odd * (k / bits)
            odd = np.concatenate([[0.0], up[:-1]]) + np.concatenate([down[1:], [0.0]])
            flips += 1
        worst = max(worst, odd[k > most[total]].sum())
    assert worst < 1e-5, worst


def test_no_row_for_every_shingle_of_a_crowded_text(spark):
    """Only the few shingles by which texts may meet become rows: 20 of 137 here, whose own ones no other text has."""
    docs = numbered(documents(spark, template_texts(60, 19)))
    rows = docs.select("n", F.col("n").alias("root"))
    found = near_dup.prefixes(rows, docs, 3, 85)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert {r["size"] for r in found.collect()} <= {137} and found.filter("low < 117").isEmpty() and found.count() < 60 * 3


def test_order_by_shared_places_loses_no_link(spark, monkeypatch):
    """With two places nearly all shingles count as equally frequent: slower, but the same links."""
    monkeypatch.setattr(near_dup, "PLACE_BITS", 1)
    texts = mixed_texts()
    want = duplicate_roots(texts, 3, 85)
    got = near_dup.near_duplicates(numbered(documents(spark, texts)), 3, 85, few=2).collect()
    assert {r["doc_id"]: r["root_id"] for r in got} == {i: root for i, (_, root) in enumerate(want)}
