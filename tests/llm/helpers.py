"""Small tables with the awkward cases, and plain versions of the contracts."""

import hashlib
import random
from collections import Counter, defaultdict

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(rng, n, size=300):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


def documents(spark, texts, **extra):
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def awkward_texts():
    """Null, empty, blank, short, long, repeated, near copies, shared passages, odd characters."""
    rng = random.Random(5)
    base, passage = words(rng, 400), words(rng, 70, 5000)
    near = base.split()
    near[100] = "changed"
    long = words(rng, 30_000, 20_000)
    return [
        None, "", " \n\t", "one", "one two", base, base, " ".join(near), base.upper(), words(rng, 50) + " " + passage, passage + " " + words(rng, 60),
        long, long[: len(long) // 2], "ab" * 400, "x" * 1000, "é😀 " * 200, "é😀 " * 120, passage[:250], "line\n" * 40 + words(rng, 80), None,
    ]


def removed_bytes(texts, size=100):
    """Per text: (bytes, removed, spans, kept) by the rule of strings that start earlier."""
    seen, out = set(), []
    for text in texts:
        b = (text or "").encode()
        hit = bytearray(len(b))
        for p in range(len(b) - size + 1):
            s = b[p:p + size]
            if s in seen:
                hit[p:p + size] = b"\1" * size
            seen.add(s)
        kept = bytes(x for x, h in zip(b, hit) if not h)
        spans = sum(1 for i, h in enumerate(hit) if h and not (i and hit[i - 1]))
        out.append((len(b), sum(hit), spans, hashlib.sha256(kept).hexdigest()))
    return out


def removed_words(texts, size=35):
    split = [(t or "").encode().split() for t in texts]
    count = Counter(tuple(w[p:p + size]) for w in split for p in range(len(w) - size + 1))
    out = []
    for w in split:
        hit = [False] * len(w)
        for p in range(len(w) - size + 1):
            if count[tuple(w[p:p + size])] > 1:
                hit[p:p + size] = [True] * size
        kept = b" ".join(x for x, h in zip(w, hit) if not h)
        out.append((len(w), sum(hit), hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, size=3):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1)))


def duplicate_roots(texts, size=3, share=85):
    """Per text: (set size, first text of its component), every pair compared."""
    sets = [shingles(t, size) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= share * (len(a) + len(sets[j]) - both):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def grouped(pairs):
    out = defaultdict(list)
    for a, b in pairs:
        out[a].append(b)
    return out
