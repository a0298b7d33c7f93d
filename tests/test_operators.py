"""Operators: exactness on skewed groups, ranks, merges, matching, plans."""

import random
import struct

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from parcelle.operators import levels, matching, profile, quantiles, ranking, relational, validation
from tests.test_functions import slow_partial_ratio


@pytest.fixture(scope="module")
def skewed(spark):
    """One key with most rows, one value with most of those, NULL keys and values."""
    rng = random.Random(3)
    rows = [("hot", rng.choice([5.0, 5.0, 5.0, rng.uniform(0, 1000)])) for _ in range(6000)]
    rows += [("flat", 7.0)] * 900 + [("one", 1.5)] + [("void", None)] * 3
    rows += [(None, rng.uniform(-5, 5)) for _ in range(700)] + [("small", float(i)) for i in range(9)] + [("hot", None)] * 50
    return spark.createDataFrame(rows, "k string, v double").repartition(7)


FRACTIONS = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p73": 0.73, "p100": 1.0}


def _expected(rows):
    by = {}
    for k, v in rows:
        by.setdefault(k, []).append(v)
    out = {}
    for k, vs in by.items():
        known = [v for v in vs if v is not None]
        out[k] = (len(vs), *(float(np.quantile(known, p)) if known else None for p in FRACTIONS.values()))
    return out


@pytest.mark.parametrize("wide,narrow", [(20, 0), (61, 60), (34, 30)])
def test_percentiles_of_a_skewed_table(skewed, monkeypatch, wide, narrow):
    """The ranges decide how much is counted at a time, not the result."""
    monkeypatch.setattr(quantiles, "WIDE", wide)
    monkeypatch.setattr(quantiles, "NARROW", narrow)
    got = quantiles.group_stats(
        skewed, ["k"], {n: ("v", p) for n, p in FRACTIONS.items()}, [F.count(F.lit(1)).alias("n")]
    ).collect()
    expected = _expected([tuple(r) for r in skewed.collect()])
    assert {r.k for r in got} == set(expected) and len(got) == len(expected)
    for r in got:
        for mine, theirs in zip((r.n, *(r[n] for n in FRACTIONS)), expected[r.k]):
            assert mine == pytest.approx(theirs) if theirs is not None else mine is None


@pytest.mark.parametrize("buckets,small", [(1, 0), (1 << 16, 0), (1 << 16, 900), (3, 1000), (1 << 16, 1 << 16)])
def test_percentiles_of_sorted_and_of_counted_groups(skewed, monkeypatch, buckets, small):
    """The rows up to which groups are sorted decide how they are read, not the result."""
    monkeypatch.setattr(quantiles, "BUCKETS", buckets)
    monkeypatch.setattr(quantiles, "SMALL", small)
    rows = skewed.withColumn("w", -F.col("v") * 3)
    wanted = {n: ("v", p) for n, p in FRACTIONS.items()} | {"other": ("w", 0.25)}
    got = quantiles.group_stats(rows, ["k"], wanted, [F.count(F.lit(1)).alias("n")])
    assert got.columns == ["k", "n", *FRACTIONS, "other"]
    expected, got = _expected([tuple(r) for r in skewed.collect()]), got.collect()
    other = {k: v[1] for k, v in _expected([(r.k, r.w) for r in rows.collect()]).items()}
    other |= {k: float(np.quantile([r.w for r in rows.collect() if r.k == k and r.w is not None], 0.25)) for k in other if k != "void"}
    assert {r.k for r in got} == set(expected) and len(got) == len(expected)
    for r in got:
        for mine, theirs in zip((r.n, *(r[n] for n in FRACTIONS), r.other), (*expected[r.k], other[r.k])):
            assert mine == pytest.approx(theirs) if theirs is not None else mine is None


@pytest.mark.parametrize("small", [0, 1 << 16])
def test_group_keys_and_values_without_plain_order(spark, monkeypatch, small):
    monkeypatch.setattr(quantiles, "SMALL", small)
    nan = float("nan")
    df = spark.createDataFrame([(0.0, 1.0), (-0.0, 3.0), (nan, -0.0), (nan, 0.0), (nan, nan), (None, None), (None, 2.0)], "k double, v double")
    got = {str(r.k): (r.mid, r.top) for r in quantiles.group_stats(df, ["k"], {"mid": ("v", 0.5), "top": ("v", 1.0)}).collect()}
    assert set(got) == {"0.0", "nan", "None"} and got["0.0"] == (2.0, 3.0) and got["None"] == (2.0, 2.0)
    assert got["nan"][0] == 0.0 and got["nan"][1] != got["nan"][1]


def test_rows_of_small_groups_are_shuffled_once(spark):
    """Every level of ranges dealt them out again, with a row for each range: four times the bytes."""
    df = spark.range(1000).select((F.col("id") % 100).alias("k"), F.rand(1).alias("v"))
    plan = quantiles._sorted_stats(df, ["k"], {"m": ("v", 0.5)}, [F.avg("v").alias("a")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1


def test_small_groups_are_read_for_their_count_and_for_the_sort_only(spark, tmp_path):
    """Where no group is large, the levels are not run; where one is, they are."""
    read, path = spark.sparkContext.accumulator(0), str(tmp_path / "rows")
    spark.range(2000).selectExpr("id % 50 as k", "double(id) as v").write.parquet(path)

    def seen(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    rows = spark.read.parquet(path).mapInPandas(seen, "k bigint, v double")
    assert quantiles.group_stats(rows, ["k"], {"mid": ("v", 0.5)}, [F.count(F.lit(1)).alias("n")]).count() == 50
    found = quantiles.group_stats(rows, ["k"], {"mid": ("v", 0.5)}, [F.count(F.lit(1)).alias("n")])
    before = read.value
    assert {(r.k, r.mid, r.n) for r in found.collect()} == {(k, 975.0 + k, 40) for k in range(50)}
    assert read.value - before == 4000



def test_image_keeps_the_order_of_values(spark):
    rng = random.Random(4)
    edges = [m * 2.0**e for e in (-1074, -1073, -1023, -1022, -1021, -1, 0, 1, 52, 53, 1022, 1023) for m in (1.0, 1.5, 1.0 + 2.0**-52, 2.0 - 2.0**-52)]
    values = [0.0, -0.0, float("inf"), 1.7976931348623157e308, 5e-324, *edges, *(rng.uniform(0, 1) * 10 ** rng.randint(-320, 308) for _ in range(3000))]
    values = sorted(values + [-v for v in values]) + [float("nan")]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").coalesce(1).select(levels.image(F.col("v"))).collect()]
    assert got == sorted(got) and len(set(got)) > 5900
    assert got.count(0) == values.count(0.0) and got[0] < got[1 + got.count(got[0])] and got[-1] > got[-2] > got[-5]
    assert [r[0] for r in spark.createDataFrame([(None,)], "v double").select(levels.image(F.col("v"))).collect()] == [None]


@pytest.mark.parametrize("value,rows", [("id / 1e8", 1_000_000), ("1000 + id / 1e5", 1_000_000), ("id % 7", 100_000), ("(id - 50000) * 1e290", 100_000), ("123.25", 100_000)])
def test_no_running_sum_meets_a_large_part_of_dense_values(spark, value, rows):
    """Many values near zero, within a percent, or equal: same percentiles, and small levels."""
    df = spark.range(rows).select(F.expr(f"cast({value} as double)").alias("v"))
    wanted = {"a": ("v", 0.25), "b": ("v", 0.5), "c": ("v", 0.999)}
    got = quantiles.overall_stats(df, wanted).first()
    exact = df.agg(*(F.expr(f"percentile(v, {p})").alias(n) for n, (_, p) in wanted.items())).first()
    assert tuple(got) == pytest.approx(tuple(exact), rel=1e-12)
    x = levels.image(F.col("v"))
    sizes = df.select(levels.within(x, levels.WIDE).alias("w"), levels.within(x, levels.NARROW).alias("n"), "v").distinct()
    wide, narrow = sizes.agg(F.count_distinct("w")).first()[0], sizes.groupBy("w").agg(F.count_distinct("n").alias("c"))
    most = max(wide, narrow.agg(F.max("c")).first()[0], sizes.groupBy("n").count().agg(F.max("count")).first()[0])
    assert most <= rows / 5  # and bounded for any number of rows


def test_overall_percentiles_of_nothing(spark):
    empty = spark.createDataFrame([], "v double")
    assert [tuple(r) for r in profile.upper_fence(empty, "v").collect()] == [(None, None, None)]
    assert [(r.n, r.median) for r in profile.describe(empty, ["v"]).collect()] == [(0, None)]


def test_nearest_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(matching, "LIST_LENGTH", 3)
    rng = random.Random(2)
    names = sorted({"".join(rng.choice("ab c") for _ in range(rng.randint(1, 6))) for _ in range(40)})
    left = spark.createDataFrame([("k", n[::-1] + "x") for n in names[:10]], "key string, text string")
    right = spark.createDataFrame([("k", n) for n in names], "key string, name string")
    got = {r.text: (r.distance, r.name) for r in matching.nearest(left, right, ["key"], "text", "name").collect()}

    def edit(a, b):
        row = list(range(len(b) + 1))
        for i, c in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, d in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
        return row[-1]

    assert got == {t: min((edit(t, n), n) for n in names) for t in (n[::-1] + "x" for n in names[:10])}


@pytest.mark.parametrize("unique", [False, True])
def test_ranks_equal_the_window_functions(spark, unique):
    rng = random.Random(5)
    draw = (lambda i: i * 0.37 - 50) if unique else (lambda i: rng.choice([None, 1.0, 2.0, -0.0, 0.0, float("nan"), float(rng.randint(-50, 50))]))
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, None]), draw(i)) for i in range(900)] + [("alone", 1, 3.0), (None, None, None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "p string, k int, v double")
    w = Window.partitionBy("p", "k").orderBy(F.asc_nulls_last("v"))
    both = ranking.with_rank(ranking.with_percent_rank(df, ["p", "k"], "v", "pr"), ["p", "k"], "v", "r")
    checked = both.select("*", F.rank().over(w).alias("er"), F.percent_rank().over(w).alias("epr"))
    assert checked.count() == len(rows)
    assert checked.where((F.col("r") != F.col("er")) | (F.abs(F.col("pr") - F.col("epr")) > 1e-12)).count() == 0


def test_ranks_of_large_integers_and_without_partition(spark):
    rows = [(2**60 + i % 7,) for i in range(50)] + [(-(2**62),), (None,), (5,)]
    got = ranking.with_rank(spark.createDataFrame(rows, "v long"), [], "v", "r").collect()
    values = sorted((v is None, v or 0) for v, in rows)
    assert sorted(r["r"] for r in got) == sorted(values.index((v is None, v or 0)) + 1 for v, in rows)


def test_no_running_sum_over_all_values_of_a_partition(spark):
    """400 000 unique values in one partition: each running sum meets ranges of them."""
    df = spark.range(400_000).select(F.lit(None).cast("string").alias("p"), (F.col("id") * 0.25).alias("v"))
    got = ranking.with_rank(df, ["p"], "v", "r")
    assert got.where(F.col("r") != F.col("v") * 4 + 1).count() == 0 and got.count() == 400_000
    x = levels.image(F.col("v"))
    sizes = df.select(levels.within(x, levels.WIDE).alias("w"), levels.within(x, levels.NARROW).alias("n"))
    assert max(sizes.distinct().groupBy("w").count().agg(F.max("count")).first()[0], sizes.select("w").distinct().count()) < 20_000


def test_dedup_groups_missing_values_and_is_stable(spark):
    rows = [("a", None, 2, "x"), ("a", None, 1, "y"), ("a", 3, 9, None), ("a", 3, 9, "z"), ("b", None, 5, "q")]
    df = spark.createDataFrame(rows, "k string, rooms int, t int, c string")
    expected = {("a", None, 1, "y"), ("a", 3, 9, "z"), ("b", None, 5, "q")}
    for parts in (1, 5):
        got = relational.dedup(df.repartition(parts, "c"), ["k", "rooms"])
        assert {tuple(r) for r in got.collect()} == expected


def test_dedup_reduces_copies_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    plan = relational.dedup(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_merge_operators(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "id int, name string, score int")
    new = spark.createDataFrame([(2, "B", 21), (3, "C", None), (3, "D", 5)], "id int, name string, score int")
    kept = {tuple(r) for r in relational.insert_ignore(old, new, ["id"]).collect()}
    assert kept == {(1, "a", 10), (2, "b", 20), (3, "C", None)}
    merged = {tuple(r) for r in relational.upsert(old, new.where("name <> 'D'"), ["id"], keep=["name"]).collect()}
    assert merged == {(1, "a", 10), (2, "b", 21), (3, "C", None)}
    ties = relational.keep_latest_ties(new.union(old), ["id"], "score")
    assert {tuple(ties.select("id", "score").orderBy("id").collect()[i]) for i in range(3)} == {(1, 10), (2, 21), (3, 5)}


def test_names(spark):
    assert relational.tidy_names(["A b", "A/b", " (c) ", "", "nan", "A_b"]) == [
        "A_b", "A_b_1", "c", "col_sans_nom_3", "col_sans_nom_4", "A_b_2"]
    assert relational.first_existing([" insee ", "Commune"], ("L6A", "INSEE", "COMMUNE")) == " insee "
    assert relational.first_existing(["COMMUNE"], ("COMMUNE",), but="COMMUNE") is None
    with pytest.raises(ValueError):
        relational.require_one_of(["x"], ("nombre_observations",))


def test_ranges_drop_missing_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (-1.0,), (5.0,)], "v double")
    assert [r.v for r in df.where(validation.in_range("v", 0)).collect()] == [1.0, 5.0]
    assert [r.v for r in df.where(validation.in_range("v", 0, 5)).collect()] == [1.0, 5.0]
    report = validation.reject_report(df, {"range": validation.in_range("v", 0), "top": F.col("v") < 5}, "t").collect()
    assert [(r.rule, r.rejected) for r in report] == [("range", 3), ("top", 1)]


def test_best_match_equals_brute_force(spark, monkeypatch):
    """Keys with many candidates are split over lists; one key has none."""
    monkeypatch.setattr(matching, "LIST_LENGTH", 4)
    rng = random.Random(11)

    def word():
        return "".join(rng.choice("abcde ") for _ in range(rng.randint(1, 9)))

    towns = [("hot", word()) for _ in range(25)] + [("cold", word()) for _ in range(5)] + [("none", "abc")]
    units = [("hot", word(), f"{i:03d}", f"L{i}", rng.randint(1, 3)) for i in range(60)]
    units += [("cold", word(), f"c{i}", f"C{i}", 1) for i in range(3)]
    left = spark.createDataFrame(towns, "key string, name string")
    right = spark.createDataFrame(units, "key string, name string, code string, label string, votes bigint")
    got = {(r.key, r.name): (r.code, r.label, pytest.approx(r.score), r.votes) for r in matching.best_match(left, right, ["key"]).collect()}
    expected = {}
    for key, name in set(towns):
        scored = [(-slow_partial_ratio(name, n), -v, c, l) for k, n, c, l, v in units if k == key]
        if scored:
            score, votes, code, label = min(scored)
            expected[key, name] = (code, label, -score, -votes)
    assert got == expected


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select(F.col("id").cast("double").alias("surface"), (F.col("id") % 3).alias("annee"), F.lit("x").alias("unused")).write.partitionBy("annee").parquet(path)
    df = spark.read.parquet(path).where("surface > 3 and annee = 1").select("surface")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(surface,3.0)" in plan and "PartitionFilters: [isnotnull(annee" in plan and "unused" not in plan.split("ReadSchema")[1]


def test_several_ranks_at_once(spark):
    rows = [("a", 1.5, None), ("a", 1.5, 2.0), ("a", 0.1, 2.0), ("a", None, 1.0), (None, 3.0, 1.0), (None, 3.0, 0.5)]
    got = ranking.with_ranks(spark.createDataFrame(rows, "k string, x double, y double"), ["k"], {"rx": "x", "ry": "y"}).collect()
    assert {tuple(r) for r in got} == {
        ("a", 1.5, None, 2, 4), ("a", 1.5, 2.0, 2, 2), ("a", 0.1, 2.0, 1, 2), ("a", None, 1.0, 4, 1), (None, 3.0, 1.0, 1, 2), (None, 3.0, 0.5, 1, 1)}
