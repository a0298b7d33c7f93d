"""Keyed merges, the event log, published versions, and reports from file metadata."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Row
from pyspark.sql import functions as F

from parcelle.operators.relational import dedup, insert_ignore, upsert
from parcelle.plans import ledger, marts
from parcelle.session import shared_folder
from parcelle.sources import readers, sinks
from parcelle.sources.keyed import KeyedTable
from parcelle.sources.layer import Layer, input_version
from parcelle.sources.starschema import SCHEMAS, YEAR_FLOOR, Star
from parcelle.streaming import incremental
from tests.test_silver import communes, file_of, rows, sale  # noqa: F401

SCHEMA = "id int, name string, score double"


def bag(df):
    return sorted(map(str, map(tuple, df.collect())))


def files(table):
    return {f for folder in table.version()[1].values() for f in table.spark.read.parquet(f"{table.root}/{folder}").inputFiles()}


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "keyed"), spark.createDataFrame([], SCHEMA).schema, ["id"], buckets=16)


def test_merges_equal_the_frames_and_leave_other_buckets(spark, table):
    old = spark.range(200).select(F.col("id").cast("int"), F.concat(F.lit("n"), "id").alias("name"), (F.col("id") / 2).alias("score"))
    assert table.read().count() == 0 and table.version() == (0, {})
    assert table.insert_ignore(old) == 1 and bag(table.read()) == bag(old)
    before, held = table.version()[1], files(table)
    new = spark.createDataFrame([(5, "five", None), (5, "also", 9.0), (900, None, 1.0)], SCHEMA)
    assert table.upsert(new, keep=["name"]) == 2
    assert bag(table.read()) == bag(upsert(old, dedup(new, ["id"]), ["id"], keep=["name"]))
    after = table.version()[1]
    assert 1 <= sum(after[b] != before.get(b) for b in after) <= 2 and len(files(table) & held) >= len(held) - 2
    kept = bag(insert_ignore(table.read(), new.withColumn("id", F.col("id") + 1), ["id"]))
    assert table.insert_ignore(new.withColumn("id", F.col("id") + 1)) == 3 and bag(table.read()) == kept
    assert table.upsert(new.where("false")) == 3


def test_failed_merge_leaves_the_old_version(spark, table):
    table.insert_ignore(spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], SCHEMA))
    held = bag(table.read())
    broken = spark.createDataFrame([(1, "x", 0.0), (3, "y", 0.0)], SCHEMA)
    failing = broken.withColumn("score", F.when(F.col("id") == 3, F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("score")))
    with pytest.raises(Exception, match="lost"):
        table.upsert(failing)
    assert bag(table.read()) == held and table.version()[0] == 1
    with pytest.raises(ValueError):
        table.upsert(spark.createDataFrame([(None, "x", 0.0)], SCHEMA))
    assert table.upsert(broken) == 2 and table.read().count() == 3


def test_a_version_is_published_once(spark, table):
    rows_ = spark.createDataFrame([(1, "a", 1.0)], SCHEMA)
    table.insert_ignore(rows_)
    table.version = lambda found=table.version(): (found[0] - 1, found[1])  # a second writer that saw the version before
    with pytest.raises(PySparkException):
        table.upsert(rows_.withColumn("name", F.lit("b")))
    del table.version
    assert bag(table.read()) == bag(rows_)


def test_old_versions_are_forgotten(spark, table):
    for i in range(5):
        table.upsert(spark.createDataFrame([(1, f"v{i}", 1.0)] + [(j, "same", 0.0) for j in range(2, 9) if i == 0], SCHEMA))
    held = bag(table.read())
    assert table.forget() == 3 and bag(table.read()) == held and table.version()[0] == 5
    assert sorted(r[0] for r in table._lists().select("version").distinct().collect()) == [4, 5]
    assert table.forget() == 0


def test_published_versions_are_kept_for_two(spark, tmp_path):
    folder = tmp_path / "published"
    for i in range(4):
        sinks.publish(spark.createDataFrame([(i,)], "v int"), "published_test", str(folder))
    assert [r.v for r in spark.table("published_test").collect()] == [3]
    assert len([p for p in folder.iterdir() if p.is_dir()]) == 2
    spark.sql("DROP VIEW published_test")


def test_killed_run_is_seen_and_tried_again(spark, communes, tmp_path, monkeypatch):  # noqa: F811
    source, target = str(tmp_path / "raw"), str(tmp_path / "clean")
    file_of(spark, source, 2021, sale())
    file_of(spark, source, 2022, sale(day="05/05/2022"))
    folder = str(tmp_path / "log")

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(incremental, "fact_transactions", killed)
        with pytest.raises(KeyboardInterrupt):
            incremental.load_logged_years(spark, source, communes, target, ledger.EventLog(spark, folder))
    log = ledger.EventLog(spark, folder)  # a new driver
    assert rows(log.read(), "source", "status") == [("silver.fact_transactions_2021", "running")]
    incremental.load_logged_years(spark, source, communes, target, log)
    assert rows(ledger.latest_status(log.read()), "source", "status", "rows_loaded", "events") == [
        ("silver.fact_transactions_2021", "success", 1, 3), ("silver.fact_transactions_2022", "success", 1, 2)]
    incremental.load_logged_years(spark, source, communes, target, log)
    assert log.read().count() == 5 and incremental.loaded_sales(spark, target).count() == 2


def test_event_log_is_one_scan(spark, tmp_path):
    log = ledger.EventLog(spark, str(tmp_path / "log"))
    assert log.read().count() == 0
    for i in range(6):
        log.record(f"s{i % 2}", ledger.ERROR if i < 4 else ledger.SUCCESS, datetime(2024, 1, 1, i), i, "x" if i < 4 else None)
    plan = log.read()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Union" not in plan
    assert rows(ledger.latest_status(log.read()), "source", "status", "events") == [("s0", "success", 3), ("s1", "success", 3)]


def test_formats_of_split_files(spark, tmp_path):
    body = "".join(f"{i};Évreux n°{i}\n" for i in range(4000))
    (tmp_path / "utf.csv").write_bytes(("code;nom é\n" + body).encode())
    (tmp_path / "latin.csv").write_bytes(("code;nom\n" + "1;plain\n" * 4000 + "2;Évreux\n").encode("latin-1"))
    (tmp_path / "header.csv").write_bytes("nom é;code\r\n1;plain\r\n".encode("latin-1"))
    (tmp_path / "empty.csv").write_bytes(b"")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        found = readers.file_formats(spark, str(tmp_path))
        assert found.rdd.getNumPartitions() >= 1
        got = {r.path.rsplit("/", 1)[1]: (r.encoding, r.header) for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {"utf.csv": ("UTF-8", "code;nom é"), "latin.csv": ("ISO-8859-1", "code;nom"), "header.csv": ("ISO-8859-1", "nom é;code")}


def test_source_report_opens_no_file(spark, tmp_path):
    for name, content in (("a b/x/1.csv", b"123"), ("a b/2.zip", b"4567"), ("bad/1.csv", b""), ("bad/2.csv", b"1"), ("other/1", b"1")):
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
    expected = spark.createDataFrame([("a b",), ("bad",), ("none",)], "source string")
    report = readers.source_report(spark, str(tmp_path / "in"), expected)
    assert rows(report, "source", "files", "bytes", "empty_files", "usable") == [("a b", 2, 7, 0, True), ("bad", 2, 1, 1, False), ("none", 0, 0, 0, False)]
    assert "content" not in report._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1].split("\n")[0]


def test_years_come_from_folders(spark):
    from __spark_entry__ import queries
    found = queries()["detect_years"](spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "l_" not in plan and "o_orderdate" not in plan and found.count() > 3


def test_layer_builds_once_per_version(spark, tmp_path):
    source, built = tmp_path / "in", []
    spark.range(3).write.parquet(str(source))

    def table():
        def build():
            built.append(1)
            return spark.read.parquet(str(source))
        return Layer(spark, str(tmp_path / "layer")).table("t", input_version(spark, str(source)), build)

    assert table().count() == 3 and table().count() == 3 and len(built) == 1
    for i in range(3):
        spark.range(1).write.mode("append").parquet(str(source))
        assert table().count() == 4 + i
    assert len(built) == 4 and table().count() == 6 and len(built) == 4
    assert len([p for p in (tmp_path / "layer" / "t").iterdir() if p.is_dir()]) == 2


def test_failed_build_leaves_no_entry(spark, tmp_path):
    layer = Layer(spark, str(tmp_path / "layer"))
    with pytest.raises(Exception, match="lost"):
        layer.table("t", "1", lambda: spark.range(2).select(F.raise_error(F.lit("lost")).cast("int").alias("x")))
    assert layer.entries().count() == 0 and layer.table("t", "1", lambda: spark.range(2)).count() == 2


@pytest.fixture
def star(spark, tmp_path):
    """Two nations with a commune each, three years of sales and one rent a year."""
    day = lambda year: datetime(year, 5, 1)
    lines = [(o, 1, s, n, 10.0 + n, 1000.0 * n + o, 0.0, 0.0, "AR"[n % 2], "O", day(2000 + o)) for o in (1, 2, 3) for s in (1, 2) for n in range(1, 25)]
    tables = {
        "region": [(0, "AFRICA")], "nation": [(0, "N0", 0), (1, "N1", 0)], "supplier": [(1, "S1", 0, 5.0), (2, "S2", 1, 5.0)],
        "customer": [(1, "C1", 0, 5.0, "FURNITURE"), (2, "C2", 1, 5.0, "BUILDING")],
        "orders": [(o, c, "F", 100.0 * o + c, day(2000 + o), "1-URGENT") for o in (1, 2, 3) for c in (1, 2)], "lineitem": lines,
    }
    for name, rows in tables.items():
        spark.createDataFrame(rows, SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    return Star(spark, str(tmp_path))


def test_a_query_has_those_marts_written_that_it_reads(spark, star, monkeypatch):
    """A check of prices does not wait for the ranks of rents; a mart is written once, after those it needs."""
    written, materialize = [], marts.materialize
    monkeypatch.setattr(marts, "materialize", lambda frames, *where: written.extend(frames) or materialize(frames, *where))
    prices = star.gold.prices.collect()
    assert prices and written == ["prix_m2_par_ville"]
    assert star.gold.tension.count() and written[1:] == ["ratio_loyer_revenu", "dynamisme_marche"]
    again = Star(spark, star.folder)
    assert again.gold.ratios.count() and again.gold.prices.collect() == prices and len(written) == 3
    assert again.gold.trend.count() and again.gold.inequality.count() and sorted(written) == sorted(marts.MARTS)
    marts.write_marts(star.sales, star.communes, star.rents, star.incomes, star.bridge, star.agglomerations, "all_marts", shared_folder(spark, "all"), YEAR_FLOOR)
    for mart in marts.MARTS:
        one, other = (sorted(map(str, x.collect())) for x in (again.written(mart), spark.table(f"all_marts.{mart}")))
        assert one == other


def test_names_are_made_for_segments_not_for_customers(spark, star):
    """A null segment keeps its rents, repeated nations repeat them, as when names were made for each customer."""
    spark.createDataFrame([(3, "C3", 0, 5.0, None), (4, "C4", None, 5.0, "FURNITURE")], SCHEMAS["customer"]).write.mode("append").parquet(f"{star.folder}/customer.parquet")
    spark.createDataFrame([(9, c, "F", 1.0, datetime(2001, 5, 1), "1-URGENT") for c in (1, 2, 3, 4)], SCHEMAS["orders"]).write.mode("append").parquet(f"{star.folder}/orders.parquet")
    spark.createDataFrame([(0, "N0", 0)], SCHEMAS["nation"]).write.mode("append").parquet(f"{star.folder}/nation.parquet")
    again = Star(spark, star.folder)
    names = again.agglomerations.where("nom_agglomeration is not null")
    rents = again.rents.where("loyer_mensuel_median = 1").join(names, "id_agglomeration", "left")
    got = sorted(map(str, rents.select("observatory_b", "nom_agglomeration").collect()))
    want = 2 * [("B00", "Agglomération de FURNITURE N0")] + 2 * [("B00", None)] + [("B01", "Eurométropole de AFRICA BUILDING 1")]
    assert got == sorted(str(Row(observatory_b=a, nom_agglomeration=b)) for a, b in want)
    # The customers are gathered to their segments before the nations come in.
    plan = again.agglomerations._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [c_nationkey" in plan


def test_rents_meet_their_names_by_key(spark, star):
    """Files of few bytes hold many rows: the orders and customers were broadcast, and one task joined them all."""
    plan = star.rents.select("observatory_b", "id_agglomeration").distinct()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin ") == 2
    spark.createDataFrame([(9, None, "F", 1.0, datetime(2001, 5, 1), "1-URGENT"), (9, 7, "F", 1.0, datetime(2001, 5, 1), "1-URGENT")], SCHEMAS["orders"]).write.mode("append").parquet(f"{star.folder}/orders.parquet")
    spark.createDataFrame([(1, "C1", 0, 5.0, None), (None, "C0", 0, 5.0, None)], SCHEMAS["customer"]).write.mode("append").parquet(f"{star.folder}/customer.parquet")
    again = Star(spark, star.folder)
    named = again.rents.join(again.agglomerations, "id_agglomeration", "left").groupBy("observatory_b", "nom_agglomeration").count()
    assert rows(named, "observatory_b", "nom_agglomeration", "count") == [
        ("B00", "Agglomération de FURNITURE N0", 3), ("B00", None, 3), ("B01", "Eurométropole de AFRICA BUILDING 1", 3)]
