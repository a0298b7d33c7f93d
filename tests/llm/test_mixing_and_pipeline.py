import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from parcelle.llm import mixing, registered
from tests.compare import connect, difference

from .helpers import awkward_texts, documents, duplicate_roots

FOLDER = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def plain_targets(sizes, share=1.5, limit=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, free, target = share * sum(sizes.values()), set(sizes), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > limit * sizes[s]}
        for s in over or free:
            target[s] = limit * sizes[s] if over else level * weight[s]
        left -= sum(target[s] for s in over)
        free = free - over if over else set()
    return target


def test_mix(spark):
    texts = [t for t in awkward_texts() * 4] + ["a b c"] * 30
    rows = [(i if i % 9 else None, t, None if i % 11 == 0 else f"s{i % 7 // 2}") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("size", F.lit("clash")).withColumn("range", F.lit(0))
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes, taken = {}, {}
    for r in got:
        words = sum(p["words"] for p in r["passes"])
        assert words <= 2 * r["size"] and all(0 <= p["position"] <= 1 for p in r["passes"])
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + words
    want = plain_targets(sizes)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]], abs=1e-5)
    assert all(abs(taken[s] - want[s]) <= 0.51 for s in want)
    key = lambda r: (str(r["doc_id"]), str(r["source"]), r["size"], str(r["passes"]))
    assert sorted(map(key, got)) == sorted(map(key, mixing.mix(docs.repartition(5)).collect()))
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mix(docs.filter("text is null")).count() > 0


def test_positions_follow_the_schedules(spark):
    docs = documents(spark, ["a b c d e f g h i j"] * 3000)
    rows = mixing.training_order(mixing.mix(docs, ramps=((1.5, 0.5), (1.0, 1.0), (0.5, 1.5)))).collect()
    assert [r["position"] for r in rows] == sorted(r["position"] for r in rows)
    half = {}
    for r in rows:
        early, total = half.get(r["source"], (0, 0))
        half[r["source"]] = early + r["words"] * (r["position"] < 0.5), total + r["words"]
    shares = [half[s][0] / half[s][1] for s in ("s0", "s1", "s2")]
    assert shares == pytest.approx([0.625, 0.5, 0.375], abs=0.01)


def test_query_reads_the_written_order(spark, tmp_path, monkeypatch):
    texts = [t for t in awkward_texts() * 2] + ["a b c"] * 30
    rows = [(i % 5 if i % 3 else None, t, None if i % 11 == 0 else f"s{i % 7 // 2}") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    orders = []
    monkeypatch.setattr(mixing, "stored", lambda frame, purpose: orders.append(frame) or frame)
    got = registered.QUERIES["op7_mixing"](spark, str(tmp_path)).collect()
    [order] = orders
    positions = [r["position"] for r in order.collect()]
    known = [x for x in positions if x is not None]
    assert known and known == sorted(known) and None not in positions[: len(known)] and len(known) < len(positions)
    assert "rangepartitioning" in order._jdf.queryExecution().executedPlan().toString()
    want = []
    for r in mixing.mix(docs).collect():
        first = min((p["position"] for p in r["passes"]), default=None)
        want.append((r["doc_id"], r["size"], r["source_size"], r["target"], sum(p["words"] for p in r["passes"]), first if first is None else round(first, 9)))
    assert len(got) == len(rows) and sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))


@tables
@pytest.mark.parametrize("name", sorted(registered.SQL))
def test_same_as_sql(spark, name):
    assert difference(queries()[name](spark, FOLDER), connect(FOLDER), oracle_sql()[name]) is None


@tables
@pytest.mark.parametrize("name", sorted(set(registered.QUERIES) - set(registered.SQL)))
def test_one_row_per_input_row(spark, name):
    table = "pages" if name.startswith("op3") else "documents"
    assert queries()[name](spark, FOLDER).count() == spark.read.parquet(f"{FOLDER}/{table}.parquet").count()


@tables
def test_stages_against_plain_versions(spark):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_dedup", "decontaminate", "secrets", "mixing"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumn("base", F.lit("own"))
    own = sorted(docs.collect())
    kept = stages["near_dedup"](spark, docs, FOLDER)
    roots = duplicate_roots([r["text"] for r in own], 5, 80)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for i, r in enumerate(own) if roots[i][1] == i}
    bad = {r["doc_id"] for r in queries()["op9_decontamination"](spark, FOLDER).filter("contaminated").collect()}
    assert {r["doc_id"] for r in stages["decontaminate"](spark, docs, FOLDER).collect()} == {r["doc_id"] for r in own} - bad
    toxic = {r["doc_id"] for r in queries()["op5_toxicity"](spark, FOLDER).filter("predicted = 1").collect()}
    assert {r["doc_id"] for r in stages["toxicity"](spark, docs, FOLDER).collect()} == {r["doc_id"] for r in own} - toxic
    clean = {r["doc_id"]: r for r in stages["secrets"](spark, docs, FOLDER).collect()}
    spans = {r["doc_id"]: r["spans"] for r in queries()["op2_secrets"](spark, FOLDER).collect()}
    for r in own:
        mine = clean[r["doc_id"]]
        assert ("[SECRET]" in mine["text"]) == bool(spans[r["doc_id"]]) and mine["n_chars"] == len(mine["text"])
        assert spans[r["doc_id"]] or mine == r


@tables
def test_pipeline(spark):
    rows = queries()["pipeline"](spark, FOLDER).collect()
    assert rows and [r["position"] for r in rows] == sorted(r["position"] for r in rows)
    assert len({(r["doc_id"], r["pass"]) for r in rows}) == len(rows)
