"""Cleaned tables from hand-written rows in the French formats."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from parcelle.operators.validation import reject_report
from parcelle.plans import ledger, mapping, marts, quality, silver
from parcelle.session import shared_folder
from parcelle.sources import readers, sinks
from parcelle.streaming.incremental import load_new_sales, load_pending_years, loaded_sales

SALES = (
    "Code_departement string, Code_commune string, Date_mutation string, Nature_mutation string, Type_local string,"
    " Valeur_fonciere string, Surface_reelle_bati double, Surface_terrain double, Nombre_pieces_principales double,"
    " Nature_culture string"
)


def sale(dep="75", com="056", day="02/01/2021", nature="Vente", kind="Maison", price="100000,0", area=100.0, rooms=4.0, land=None, culture=None):
    return (dep, com, day, nature, kind, price, area, land, rooms, culture)


@pytest.fixture(scope="module")
def communes(spark):
    return spark.createDataFrame([("75056",), ("2A004",), ("01001",), ("974411",)], "code_insee string")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_sales(spark, communes):
    raw = spark.createDataFrame([
        sale(price="123456,78"),
        sale(dep="2A", com="4"), sale(dep="1", com="1"), sale(dep="974", com="411"),
        sale(nature="Echange"), sale(kind="Local industriel"), sale(area=0.0), sale(price=None), sale(price="abc"), sale(price="0"),
        sale(price="50000", area=100.0, rooms=1.0), sale(price="49999,9", rooms=1.0),
        sale(price="1373100", rooms=2.0), sale(price="1373100,1", rooms=2.0),
        sale(rooms=9.0, land=5.0), sale(rooms=9.0, land=3.0), sale(rooms=None, culture="S"), sale(rooms=None, culture="P"),
        sale(dep="99", com="999"), sale(day="31/02/2021"), sale(day=None), sale(area=0.5, price="5000"),
    ], SALES)
    got = silver.fact_transactions(raw, communes)
    assert rows(got, "code_insee", "annee", "valeur_fonciere", "nombre_pieces", "surface_terrain", "nature_culture") == sorted([
        ("75056", 2021, 123456.78, 4, None, None),
        ("2A004", 2021, 100000.0, 4, None, None), ("01001", 2021, 100000.0, 4, None, None), ("974411", 2021, 100000.0, 4, None, None),
        ("75056", 2021, 50000.0, 1, None, None), ("75056", 2021, 1373100.0, 2, None, None),
        ("75056", 2021, 100000.0, 9, 3.0, None), ("75056", 2021, 100000.0, None, None, "P"),
    ], key=repr)
    report = {r.rule: r.rejected for r in reject_report(silver.sale_rows(raw), silver.sale_rules(), "sales").collect()}
    assert report == {"not_null": 2, "prix_m2": 2, "surface_bati": 1}


def test_district_option(spark, communes):
    raw = spark.createDataFrame([sale(dep="75", com="101")], SALES)
    assert silver.fact_transactions(raw, communes).count() == 0
    assert rows(silver.fact_transactions(raw, communes, merge_districts=True), "code_insee") == [("75056",)]


def test_incomes(spark, communes):
    first = spark.createDataFrame([("1001", "s"), ("75056", "24000,6"), ("2A004", None), ("99999", "1")], "CODGEO string, Q217 string")
    second = spark.createDataFrame([("01001", 12000.0), ("75056", None)], "CODGEO string, Q218 double")
    got = silver.fact_revenus({2017: first, 2018: second}, communes)
    assert rows(got, "code_insee", "annee", "revenu_median", "revenu_mensuel") == [
        ("01001", 2018, 12000.0, 1000.0), ("75056", 2017, 24000.6, pytest.approx(2000.05))]


RENTS = ("Observatory string, agglomeration string, Data_year int, Type_habitat string, nombre_pieces_homogene string,"
         " loyer_mensuel_median double, loyer_median double, {} double")


def test_rents(spark):
    old = spark.createDataFrame([
        ("b1300.0", "Agglomération  de Marseille", 2014, None, "4P et plus", 700.0, 10.0, 3.0),
        ("B 1300", "Agglomération de Marseille", 2014, "Maison", None, None, 10.0, 3.0),
        ("B1300", "inconnue", 2014, "Maison", None, 1.0, 1.0, 1.0),
        (None, "Agglomération de Marseille", 2014, "Maison", None, 1.0, 1.0, 1.0),
    ], RENTS.format("nombre_obsservations"))
    new = spark.createDataFrame([
        ("B1300", "Agglomération de Marseille ", 2015, "Appartement ", "2P", 500.0, 11.0, 4.0),
        ("B1300", "Agglomération de Marseille", 2015, "Appartement", "2P", 450.0, 12.0, 5.0),
        ("B1300", "Agglomération de Marseille", 2015, "Appartement", "3P", -1.0, 12.0, 5.0),
    ], RENTS.format("nombre_observations"))
    agglomerations = silver.dim_agglomeration([new])
    got = silver.fact_loyers([old, new], agglomerations)
    assert rows(got, "observatory_b", "annee", "type_habitat", "nombre_pieces", "loyer_mensuel_median", "nombre_observations") == [
        ("B1300", 2014, "Ensemble", "4P+", 700.0, 3.0), ("B1300", 2015, "Appartement", "2P", 450.0, 5.0)]
    assert rows(silver.unmatched_agglomerations([old, new], agglomerations), "nom_agglomeration", "n") == [("inconnue", 1)]
    assert rows(silver.dim_observatoire([old, new]), "observatory_b") == [("B1300",)]
    with pytest.raises(ValueError):
        silver.rent_rows(spark.createDataFrame([], RENTS.format("autre")))


def test_agglomerations_keep_their_ids(spark):
    existing = spark.createDataFrame([(1, "Lyon")], "id_agglomeration int, nom_agglomeration string")
    raw = spark.createDataFrame([("Lyon",), ("Nice",), (None,)], "agglomeration string")
    got = {r.nom_agglomeration: r.id_agglomeration for r in silver.dim_agglomeration([raw], existing).collect()}
    assert got["Lyon"] == 1 and set(got) == {"Lyon", "Nice"} and 0 <= got["Nice"] < 2_000_000_000


def test_communes_and_bridge(spark):
    reference = spark.createDataFrame([("75056", "Paris", "75", "75001"), ("01001", "L'Abergement", "01", "nan")],
                                      "code_insee string, nom_standard string, dep_code string, code_postal string")
    sales = spark.createDataFrame([("1", "1", "AUTRE NOM", "1400"), ("2A", "4", "AJACCIO", "20000.0")],
                                  "Code_departement string, Code_commune string, Commune string, Code_postal string")
    zoning = spark.createDataFrame([(" 1002 ", "Ambérieu", "b01"), ("garbage", "x", "b01"), (None, "y", "b01"), ("75101", "Paris 1er", "b75"),
                                    ("974411", "six", "b01"), ("1002", "Ambérieu", "b01")], "CODE_INSEE string, LIB_COM string, observatory_b string")
    no_code = spark.createDataFrame([("a",)], "autre string")
    geo = spark.createDataFrame([("75056", "Paris", "75", "11", "00851")], "CODGEO string, LIBGEO string, DEP string, REG string, UU2020 string")
    dim = silver.dim_commune([
        silver.communes_from_reference(reference), silver.communes_from_sales(sales), silver.communes_from_zoning(zoning),
        silver.communes_from_zoning(no_code),
    ], silver.communes_geo(geo))
    assert rows(dim, "code_insee", "nom_commune", "code_postal", "code_departement", "uu2020", "reg") == [
        ("01001", "L'Abergement", None, "01", None, None), ("01002", "Ambérieu", None, None, None, None),
        ("2A004", "AJACCIO", "20000", "2A", None, None), ("75056", "Paris", "75001", "75", "00851", "11"),
        ("75101", "Paris 1er", None, None, None, None)]
    observatories = spark.createDataFrame([("B01",), ("B75",)], "observatory_b string")
    assert rows(silver.bridge([zoning], dim, observatories), "code_insee", "observatory_b") == [("01002", "B01"), ("75056", "B75")]


def _series(spark, spec):
    """Sales rows: (year, count, price per square metre)."""
    data = [("75056", year, "Maison", 100.0 * p, 100.0, p) for year, n, p in spec for _ in range(n)]
    return spark.createDataFrame(data, "code_insee string, annee int, type_local string, valeur_fonciere double, surface_bati double, prix_m2 double")


def test_price_mart_and_gates(spark):
    communes = spark.createDataFrame([("75056", "Paris", "75")], "code_insee string, nom_commune string, code_departement string")
    sales = _series(spark, [(2020, 9, 1000.0), (2021, 25, 1000.0), (2022, 25, 1100.0), (2023, 24, 1200.0), (2024, 25, 1300.0), (2026, 30, 1400.0)])
    prices = {r.annee: r for r in marts.prix_m2_par_ville(sales, communes).collect()}
    assert sorted(prices) == [2021, 2022, 2023, 2024, 2026]
    assert prices[2021].evolution_annuelle_pct is None and prices[2022].evolution_annuelle_pct == 10.0
    assert prices[2026].evolution_annuelle_pct == 7.69 and prices[2026].prix_m2_annee_precedente == 1300.0  # no gap rule here
    assert prices[2024].moving_avg_3ans == 1200.0 and prices[2022].moving_avg_3ans == 1050.0

    none = spark.createDataFrame([], "observatory_b string, annee int, ratio_tension_pct double")
    bridge = spark.createDataFrame([("75056", "B75")], "code_insee string, observatory_b string")
    tension = {r.annee: r for r in marts.dynamisme_marche(sales, communes, none, bridge).collect()}
    assert {y: r.hausse_prix_pct for y, r in tension.items()} == {2021: None, 2022: 10.0, 2023: None, 2024: None, 2026: None}
    assert tension[2022].score_tension == 30.0 and tension[2022].categorie_tension == "Modéré"
    ratios = spark.createDataFrame([("B75", 2022, 40.0), ("B75", 2022, 60.0), ("B75", 2022, None)], none.schema)
    scored = {r.annee: r for r in marts.dynamisme_marche(sales, communes, ratios, bridge).collect()}
    assert scored[2022].ratio_tension_pct == 50.0 and scored[2022].score_tension == 37.5
    low = _series(spark, [(2021, 30, 499.0), (2022, 30, 600.0), (2023, 30, 660.0)])
    rises = {r.annee: r.hausse_prix_pct for r in marts.dynamisme_marche(low, communes, none, bridge).collect()}
    assert rises == {2021: None, 2022: None, 2023: 10.0}
    assert marts.dynamisme_marche(_series(spark, [(2019, 30, 900.0)]), communes, none, bridge).count() == 0


def test_yearly_changes_per_agglomeration(spark):
    columns = "observatory_b string, nom_agglomeration string, annee int, type_habitat string, nombre_pieces string, ratio_tension_pct double"
    ratios = spark.createDataFrame([("B1", "a", 2020, "M", "T", 30.0), ("B1", "b", 2020, "M", "T", 50.0), ("B1", "a", 2021, "M", "T", 33.0),
                                    ("B1", "b", 2021, "M", "T", None), ("B1", "b", 2022, "M", "T", 40.0)], columns)
    assert rows(marts.evolution_tension(ratios), "nom_agglomeration", "annee", "evolution_ratio") == [
        ("a", 2020, None), ("a", 2021, 3.0), ("b", 2020, None), ("b", 2022, -10.0)]


def test_mapping(spark):
    agglomerations = spark.createDataFrame([(1, "Agglomération de Lyon"), (2, "Zone rurale du Rhône"), (3, "Agglomération d'Annecy"),
                                            (4, "Agglomération de Zzz"), (5, "Agglomération de Vienne")], "id_agglomeration int, nom_agglomeration string")
    rents = spark.createDataFrame([("B69", 1), ("B69", 1), ("B69", 2), ("B74", 3), ("B69", 3), ("B00", 4), ("B69", 5)], "observatory_b string, id_agglomeration int")
    bridge = spark.createDataFrame([("a", "B69"), ("b", "B69"), ("c", "B69"), ("d", "B69"), ("e", "B74"), ("r", "B69")], "code_insee string, observatory_b string")
    communes = spark.createDataFrame([("a", "00001"), ("b", "00001"), ("c", "00002"), ("d", "00004"), ("e", "00003"), ("r", "01000")], "code_insee string, uu2020 string")
    units = spark.createDataFrame([("00001", "Lyon"), ("00002", "Lyon (partie)"), ("00003", "Annecy"), ("00004", "Vienne"), ("01000", "Rural")], "uu2020 string, nom_uu string")
    got = {(r.observatory_b, r.id_agglomeration): (r.uu2020, r.score_fuzzy, r.nb_communes_vote)
           for r in mapping.map_agglomerations(rents, agglomerations, bridge, communes, units).collect()}
    assert got == {
        ("B69", 1): ("00001", 100.0, 2),    # equal scores: more votes
        ("B69", 3): ("00003", 100.0, 0),    # the country's best unit wins
        ("B74", 3): ("00003", 100.0, 1),
        ("B69", 5): ("00004", 100.0, 1),
    }
    quality_row = mapping.mapping_quality(mapping.map_agglomerations(rents, agglomerations, bridge, communes, units)).collect()[0]
    assert (quality_row.mapped, quality_row.by_vote, quality_row.by_fallback, quality_row.ambiguous) == (4, 3, 1, 0)


def test_ledger(spark):
    start, end = datetime(2024, 1, 1), datetime(2024, 1, 2)
    log = ledger.append(
        ledger.event(spark, "staging.a", ledger.RUNNING, start), ledger.event(spark, "staging.a", ledger.SUCCESS, start, 5, end),
        ledger.event(spark, "silver.b", ledger.RUNNING, start), ledger.event(spark, "staging.c", ledger.ERROR, start, None, end, "boom"),
    )
    sources = spark.createDataFrame([("staging.a",), ("silver.b",), ("staging.c",), ("staging.d",)], "source string")
    assert rows(ledger.pending(sources, log), "source") == [("silver.b",), ("staging.c",), ("staging.d",)]
    assert rows(ledger.latest_status(log), "source", "status") == [("silver.b", "running"), ("staging.a", "success"), ("staging.c", "error")]
    assert ledger.reset(log, "staging", "a").count() == 3 and ledger.reset(log, "silver").count() == 4 and ledger.reset(log).count() == 3
    counts = spark.createDataFrame([("staging.a", 5), ("silver.z", 2), ("silver.e", 0)], "source string, rows_loaded bigint")
    assert rows(ledger.bootstrap(counts, log), "source", "rows_loaded") == [("silver.z", 2)]


def test_quality_reports(spark):
    df = spark.createDataFrame([("1", 2011), ("1", 2030), (None, None), ("2", 2012)], "code_insee string, annee int")
    rules = quality.Rules(["code_insee"], {"annee": (2010, 2026)}, ["code_insee"], min_rows=10)
    report = {(r.rule, r.column_name): r.failures for r in quality.check_table(df, "t", rules).collect()}
    assert report == {("row_count", "*"): 6, ("not_null", "code_insee"): 1, ("between", "annee"): 1, ("unique", "code_insee"): 2}
    assert rows(quality.unexpected_values(df, "annee", [2011, 2012]), "annee", "n") == [(2030, 1)]


def test_files(spark, tmp_path):
    root = str(tmp_path)
    (tmp_path / "latin.csv").write_bytes("INSEE;LIB_COM\n01001;Ambérieu\n".encode("latin-1"))
    (tmp_path / "utf.csv").write_bytes("﻿INSEE;LIB COM\n02002;Étampes\n".encode("utf-8"))
    assert readers.fitting_encoding(spark, f"{root}/latin.csv") == "ISO-8859-1"
    assert readers.fitting_encoding(spark, f"{root}/utf.csv") == "UTF-8"
    zoning = readers.read_zoning(spark, readers.files_under(spark, f"{root}/*.csv"), "B01")
    assert rows(zoning, "INSEE", "LIB_COM", "observatory_b", "source_file") == [
        ("01001", "Ambérieu", "B01", "latin.csv"), ("02002", "Étampes", "B01", "utf.csv")]

    good, empty = str(tmp_path / "pq/good.parquet"), tmp_path / "pq/broken.parquet"
    df = spark.createDataFrame([("1", 2020), ("2", 2021)], "code string, annee int")
    df.coalesce(1).write.parquet(good)
    empty.write_bytes(b"not parquet")
    expected = spark.createDataFrame([("good.parquet",), ("broken.parquet",), ("absent.parquet",)], "file_name string")
    folder = F.regexp_extract("_metadata.file_path", r"([^/]+\.parquet)", 1)
    report = readers.file_report(spark, str(tmp_path / "pq"), expected, folder)
    assert rows(report, "file_name", "row_count", "usable") == [("absent.parquet", 0, False), ("broken.parquet", 0, False), ("good.parquet", 2, True)]


def test_partition_writes(spark):
    path = shared_folder(spark, "years")
    df = spark.createDataFrame([("1", 2020), ("2", 2021)], "code string, annee int")
    sinks.replace_partitions(df, path)
    sinks.replace_partitions(spark.createDataFrame([("9", 2021)], df.schema), path)
    assert rows(readers.read_years(spark, path), "code", "annee") == [("1", 2020), ("9", 2021)]
    pruned = readers.read_years(spark, path, [2020])
    assert rows(pruned, "code", "annee") == [("1", 2020)] and all("annee=2020" in f for f in pruned.inputFiles())
    assert rows(readers.years_in_folder(spark, path), "annee") == [(2020,), (2021,)]
    sinks.replace_all(spark.createDataFrame([("7", 2022)], df.schema), path, ["code", "annee"], by="annee")
    assert rows(readers.read_years(spark, path), "code", "annee") == [("7", 2022)]


def test_new_files_are_loaded_once(spark, communes, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    first = spark.createDataFrame([sale(), sale(), sale(day="05/05/2022")], SALES)
    first.write.parquet(source)
    for _ in range(2):
        load_new_sales(spark, source, first.schema, communes, target, progress)
    assert rows(spark.read.parquet(target), "annee") == [(2021,), (2022,)]
    spark.createDataFrame([sale(), sale(price="200000", rooms=None)], SALES).write.mode("append").parquet(source)
    load_new_sales(spark, source, first.schema, communes, target, progress)
    assert rows(spark.read.parquet(target), "annee", "valeur_fonciere") == [(2021, 100000.0), (2021, 200000.0), (2022, 100000.0)]


def file_of(spark, path, year, *sales):
    spark.createDataFrame(list(sales), SALES).withColumn("annee", F.lit(year)).write.mode("append").partitionBy("annee").parquet(path)


def test_only_pending_files_are_loaded(spark, communes, tmp_path):
    source, target = str(tmp_path / "raw"), str(tmp_path / "clean")
    file_of(spark, source, 2023, *(sale(day="02/03/2023", price=str(100000 + i)) for i in range(5)))
    log = load_pending_years(spark, source, communes, target, spark.createDataFrame([], ledger.COLUMNS))
    assert rows(log, "source", "status", "rows_loaded") == [
        ("silver.fact_transactions_2023", "running", None), ("silver.fact_transactions_2023", "success", 5)]
    # A later file holds a sale of the year before, one of them a copy; a third cleans to nothing.
    file_of(spark, source, 2024, sale(day="31/12/2023", price="90000"), sale(day="02/03/2023", price="100001"),
            *(sale(day="05/05/2024", price=str(80000 + i)) for i in range(3)))
    file_of(spark, source, 2025, sale(nature="Echange"))
    log = load_pending_years(spark, source, communes, target, log)
    assert rows(ledger.latest_status(log), "source", "status", "rows_loaded") == [
        (f"silver.fact_transactions_{y}", "success", n) for y, n in ((2023, 5), (2024, 5), (2025, 0))]
    assert sorted(r.annee for r in loaded_sales(spark, target).collect()) == [2023] * 6 + [2024] * 3
    assert load_pending_years(spark, source, communes, target, log).count() == log.count()
    again = load_pending_years(spark, source, communes, target, ledger.reset(log, "silver", "fact_transactions_2024"))
    assert again.count() == log.count() + 1 and loaded_sales(spark, target).count() == 9


def test_failed_file_is_logged_and_tried_again(spark, communes, tmp_path):
    source, target = str(tmp_path / "raw"), str(tmp_path / "clean")
    file_of(spark, source, 2021, sale())
    file_of(spark, source, 2022, sale(day="05/05/2022"))
    broken = tmp_path / "raw/annee=2022/part-x.parquet"
    broken.write_bytes(b"not parquet")
    log = load_pending_years(spark, source, communes, target, spark.createDataFrame([], ledger.COLUMNS))
    assert rows(ledger.latest_status(log), "source", "status") == [
        ("silver.fact_transactions_2021", "success"), ("silver.fact_transactions_2022", "error")]
    spark.createDataFrame([sale(day="06/05/2022")], SALES).coalesce(1).write.parquet(str(tmp_path / "good"))
    broken.write_bytes(next((tmp_path / "good").glob("*.parquet")).read_bytes())
    log = load_pending_years(spark, source, communes, target, log)
    assert rows(ledger.latest_status(log), "status") == [("success",), ("success",)]
    assert loaded_sales(spark, target).count() == 2


def test_same_result_for_any_partition_count(spark, communes):
    raw = spark.createDataFrame([sale(com=c, price=str(50000 + 10 * (i % 7)), land=float(i)) for c in ("056", "101") for i in range(40)], SALES)
    results = set()
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.add(tuple(rows(silver.fact_transactions(raw.repartition(int(n)), communes), "code_insee", "valeur_fonciere", "surface_terrain")))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(results) == 1
