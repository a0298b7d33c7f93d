"""Divergence audit, shards and ranked search against plain versions."""

import random
import re
from collections import Counter, defaultdict
from math import floor, log
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelle.llm import divergence, search, sharding
from parcelle.llm.terms import LETTERS, LETTERS_AND_DIGITS, term_lists

from .helpers import DOCS, awkward_texts

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
EXTRA = "doc_id bigint, text string, lang string, source string, n_chars bigint, term string, `Count` string, place string, size string, row string, score string, rank string"


def plain_terms(text, digits):
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+" if digits else r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
    return [t.translate(LOWER) for t in re.findall(pattern, text or "")]


def test_terms():
    rng = random.Random(1)
    texts = [None, "", "A1b2 Ünï-çödé İstanbul x\x00y", *awkward_texts(), "".join(rng.choice("aB3 é\n.@[`{~\x7f ") for _ in range(3000)), "x" * 500]
    for text in texts:
        for digits, table in ((False, LETTERS), (True, LETTERS_AND_DIGITS)):
            raw = None if text is None else text.encode()
            for piece in (1, 7, 64, 1 << 22):
                assert [t.decode() for part in term_lists(raw, table, piece) for t in part] == plain_terms(text, digits)


# divergence

def plain_audit(rows, least, top):
    rows = [(lang or "", source or "", plain_terms(text, False)) for text, lang, source in rows]
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in rows:
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = set()
    for lang in {r[0] for r in rows}:
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        own = {s: {t: c[t] for t in kept} for (g, s), c in counts.items() if g == lang}
        whole = {t: sum(c[t] for c in own.values()) for t in kept}
        p = lambda c: {t: 1 + 10**9 * (n + 5) // (sum(c.values()) + 5 * len(kept)) for t, n in c.items()}
        rates, q = {s: p(c) for s, c in own.items()}, p(whole)
        for s in own:
            pair = sorted((-sum(abs(rates[s][t] - rates[o][t]) for t in kept), o.encode()) for o in own if o != s)
            term = sorted((q[t] - rates[s][t], t.encode()) for t in kept if own[s][t] > 0 and rates[s][t] > q[t])[:top]
            out |= {(lang, s, part, item.decode(), -v, i + 1) for part, found in (("pair", pair), ("term", term)) for i, (v, item) in enumerate(found)}
    return out


def group_rows(rng, n, sources):
    vocabulary = [f"{a}{b}" for a in "abcdeéÿ𝒳" for b in "mnopqr"]
    rows = []
    for i in range(n):
        s = min(int(rng.expovariate(1)), sources - 1)
        rows.append((" ".join(rng.choice(vocabulary[s % 5:]) for _ in range(rng.randrange(40))), ["en", "fr", None, ""][min(i % 5, 3)], f"s{s}" if s else None))
    return [*rows, (None, "en", "empty"), ("12 34", "xx", "only"), ("", "xx", "other"), ("word", "yy", "alone"), *rows[:5]]


@pytest.mark.parametrize("tile,pieces,held", [(256, 16, 300_000), (2, 3, 40)])
def test_audit(spark, tile, pieces, held):
    rows = group_rows(random.Random(tile), 150, 7)
    frame = spark.createDataFrame([(i, *r, 0, "x", "y", "z", "a", "b", "c", "d") for i, r in enumerate(rows)], EXTRA)
    got = divergence.audit(frame.repartition(3), least_docs=4, top=6, held=held, tile=tile, pieces=pieces).collect()
    assert len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in got} == plain_audit(rows, 4, 6)
    assert divergence.audit(frame.limit(0)).count() == 0


def test_skyband_of_pieces():
    rng = np.random.default_rng(3)
    high, low = rng.integers(0, 40, 3000), rng.integers(0, 300, 3000)
    high = np.where(rng.random(3000) < 0.3, low, high)  # high counts with high counts: a broad skyband
    for k in (1, 4, 50):
        number = [int(((high[:i] >= high[i]) & (low[:i] <= low[i])).sum()) for i in range(3000)]
        assert (divergence.Skyband(k).add(high, low) == (np.array(number) < k)).all()
        piece = rng.integers(0, 4, 3000)
        first = np.concatenate([np.flatnonzero(piece == p)[divergence.Skyband(k).add(high[piece == p], low[piece == p])] for p in range(4)])
        first.sort()
        assert (first[divergence.Skyband(k).add(high[first], low[first])] == np.flatnonzero(np.array(number) < k)).all()


def test_rates_are_exact_past_64_bits(spark):
    counts = [(10**12, 3 * 10**12, 7), (0, 5 * 10**15, 10**6), (9 * 10**14, 9 * 10**14, 1)]
    rows = spark.createDataFrame(counts, "c long, n long, v long").select(divergence._rate(F.col("c"), F.col("n"), F.col("v")).alias("p"))
    assert sorted(r[0] for r in rows.collect()) == sorted(1 + 10**9 * (c + 5) // (n + 5 * v) for c, n, v in counts)


# shards

@pytest.mark.parametrize("n", [1, 2, 3, 39, 40, 41, 1000, 1024, 4097])
def test_permutation(n):
    place = sharding.permuted(np.arange(n), n)
    assert sorted(place) == list(range(n))
    assert (sharding.row_at(place % 40, place // 40, n) == np.arange(n)).all()
    if n > 1000:
        assert (place != sharding.permuted(np.arange(n), n, seed=13)).mean() > 0.9
        assert abs(np.corrcoef(np.arange(n), place)[0, 1]) < 0.1 and (np.diff(place) == 1).mean() < 0.01


def test_permutation_of_many_rows():
    n = 3 * 10**12 + 7
    row = np.random.default_rng(1).integers(0, n, 20_000)
    place = sharding.permuted(row, n)
    assert place.min() >= 0 and place.max() < n and len(set(place)) == len(set(row))
    assert (sharding.row_at(place % 40, place // 40, n) == row).all()


def test_shards(spark):
    texts = [*awkward_texts(), *["copy"] * 300]
    ids = [None, None, 5, 5, -3, 2**62] + list(range(100, 100 + len(texts) - 106)) + [7] * 100
    rows = [(i, t, None, None, 0, "x", "y", "z", "a", "b", "c", "d") for i, t in zip(ids, texts)]
    frame = spark.createDataFrame(rows, EXTRA)
    first = sharding.assign_shards(frame.repartition(5)).collect()
    again = sharding.assign_shards(frame.repartition(3, "text")).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in first) == Counter((i, len((t or "").encode()) + 16, crc32((t or "").encode())) for i, t in zip(ids, texts))
    slots = defaultdict(list)
    for r in first:
        slots[r["shard"]].append(r["slot"])
        assert sharding.row_at(r["shard"], r["slot"], len(rows)) == r["row"]
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and set(slots) == set(range(40))
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    order = sorted(first, key=lambda r: r["row"])
    assert [r["row"] for r in order] == list(range(len(rows)))
    assert [r["doc_id"] for r in order] == sorted((i for i in ids if i is not None)) + [None] * 2
    assert sharding.assign_shards(frame.limit(0)).count() == 0


# search

def plain_search(docs, items, k=10):
    terms = [Counter(plain_terms(t, True)) for _, t in docs]
    n, length = sum(1 for c in terms if c), sum(c.total() for c in terms)
    df = Counter(t for c in terms for t in c)
    w = {t: floor(1000 * log((2 * n + 2) / (2 * x + 1))) for t, x in df.items()}
    out = []
    for item, text in items:
        scored = []
        for (doc, _), c in zip(docs, terms):
            if c:
                m = 10 + 90 * c.total() * n // length
                s = sum(w[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(plain_terms(text, True)) if t in c)
                if s > 0:
                    scored.append((-s, doc is None, doc or 0))
        out += [(item, i + 1, None if absent else doc, -s) for i, (s, absent, doc) in enumerate(sorted(scored)[:k])]
    return Counter(out)


@pytest.mark.parametrize("leaf,trie_docs,block", [(64, 16_384, 200_000), (2, 50, 150)])
def test_search(spark, leaf, trie_docs, block):
    rng = random.Random(leaf)
    draw = lambda n: " ".join(f"W{min(int(rng.expovariate(0.03)), 300)}" for _ in range(n))
    texts = [draw(rng.randrange(1, 60)) for _ in range(150)]
    nested = [" ".join(f"W{j}" for j in range(i)) for i in range(1, 60)]
    texts += [None, "", "...", *texts[:20], *["W1 w2 W250"] * 40, *nested, *awkward_texts()]
    ids = [None, None, 3, 3] + list(range(10, 6 + len(texts)))
    docs = list(zip(ids, texts))
    items = [(1, draw(12)), (2, texts[7]), (3, None), (4, ""), (5, "absent words"), (6, "W250 W1 W299"), (None, draw(5)), (7, texts[7]), (8, " ".join(texts[10:20])), (9, "w1"), (10, "W0 w0")]
    frame = spark.createDataFrame([(i, t, None, None, 0, "x", "y", "z", "a", "b", "c", "d") for i, t in docs], EXTRA).repartition(3)
    queries = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, doc_id string")
    got = search.search(frame, queries, block_terms=block, trie_docs=trie_docs, leaf=leaf).select("item_id", "rank", "doc_id", "score").collect()
    assert Counter(map(tuple, got)) == plain_search(docs, items)


def test_search_repeated_items_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "s", 3), (2, "a", "en", "s", 1), (3, "c", "en", "s", 1)], DOCS)
    items = spark.createDataFrame([("x", "a"), ("x", "c"), ("y", "a")], "item_id string, text string")
    got = search.search(docs, items).collect()
    assert Counter((r["item_id"], r["rank"], r["doc_id"]) for r in got) == Counter([("x", 1, 2), ("x", 2, 1), ("x", 1, 3), ("y", 1, 2), ("y", 2, 1)])
    assert search.search(docs.limit(0), items).count() == search.search(docs, items.limit(0)).count() == search.search(docs.where("doc_id = 3"), items).where("rank > 1").count() == 0


def test_bounds_leave_documents_unscored():
    rng = np.random.default_rng(5)
    docs = np.repeat(np.arange(3000), 20)
    ids = np.concatenate([rng.choice(400, 20, replace=False) for _ in range(3000)])
    ids[:40] = np.tile(np.arange(400, 420), 2)  # two documents with rare terms
    trie = search.Trie(docs, ids, np.ones(60_000, np.int64), np.full(3000, 100))
    weight = np.zeros(420, np.int64)
    weight[395:] = 5000
    best = search.Best(2).among(np.arange(3000), np.zeros(3000, bool))
    scored = trie.search(weight, best)
    assert sorted(best.doc) == [0, 1] and scored < 1000
    assert max(h - l for (l, h), c in zip(trie.range, trie.children) if not c) <= search.LEAF
