"""Name similarity of many pairs, the bound from shared letter pairs, and how few pairs are scored."""

import random
from collections import Counter

from pyspark.sql import functions as F

from parcelle.functions.similarity import similarity
from parcelle.operators import matching
from tests.test_functions import slow_partial_ratio


def names(rng, n):
    parts = ["saint", "sur", "ville", "mont", "bourg", "neuf", "château", "roche", "val", "loire", "mer", "lès", "aix", "eu", "o", "puy", "clermont", "ferrand", "dun", "kerque"]
    return sorted({"-".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n)})


def plain(a, b):
    return slow_partial_ratio(a, b) if a and b else 100.0 if a == b else 0.0


def test_similarity_of_columns(spark):
    rng = random.Random(1)
    draw = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    pairs = [(draw(rng.randrange(12), "abcé"), draw(rng.randrange(12), "abcé")) for _ in range(250)] + [("", ""), ("", "a"), ("a", "a"), ("😀b", "a😀b")]
    pairs += [(draw(n, "ab"), draw(k, "ab")) for n, k in ((60, 64), (61, 61), (62, 62), (63, 70), (90, 62))]
    frame = spark.createDataFrame(pairs, "a string, b string")
    for r in frame.select("a", "b", similarity(F.col("a"), F.col("b")).alias("s")).collect():
        assert r.s == plain(r.a, r.b), (r.a, r.b)
    assert spark.createDataFrame([(None, "a")], "a string, b string").select(similarity(F.col("a"), F.col("b"))).first()[0] is None


def test_bound_is_never_below_the_score(spark):
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(9))) for _ in range(60)})
    bigrams = lambda x: Counter(x[i:i + 2] for i in range(len(x) - 1))
    rows = [(a, b, plain(a, b), (bigrams(a) & bigrams(b)).total()) for a in words for b in words]
    frame = spark.createDataFrame(rows, "name string, other string, score double, shared int")
    most = matching.bound(F.least(F.length("name"), F.length("other")), F.col("shared"))
    assert frame.where(F.col("score") > most).count() == 0
    counted = matching.sharing(frame.select("name"), frame.select("name"), []).where("other is not null")
    expected = frame.where("shared > 0").select("name", "other", most.alias("most"))
    assert counted.exceptAll(expected).count() == expected.exceptAll(counted).count() == 0


def test_best_match_scores_few_pairs_and_misses_none(spark):
    rng = random.Random(3)
    towns, units = names(rng, 60), names(rng, 500)
    towns = [t.replace("e", "é", 1) if i % 3 else t[: len(t) // 2 + 1] + "x" for i, t in enumerate(towns)] + ["zzzzqqqq", "w", ""]
    left = spark.createDataFrame([(t,) for t in towns], "name string")
    right = spark.createDataFrame([(u, f"{i:04d}", u.upper(), i % 4) for i, u in enumerate(units)], "name string, code string, label string, votes bigint")
    got = {r.name: (r.code, r.score) for r in matching.best_match(left, right, []).collect()}
    expected = {}
    for t in set(towns):
        score, _, code = min((-plain(t, u), -(i % 4), f"{i:04d}") for i, u in enumerate(units))
        expected[t] = (code, -score)
    assert got == expected
    pairs = matching.scored(left, right, []).select("name", "other").distinct().where("name not in ('zzzzqqqq', 'w', '')")
    assert pairs.count() < 0.2 * len(towns) * len(units)
    plan = matching.best_match(left, right, [])._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
