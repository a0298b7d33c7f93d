"""Dashboard queries and mart checks on small hand-written marts."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from parcelle.plans import dashboard, quality
from parcelle.registry.quality import dq_accepted_values

TENSION = ("code_insee string, nom_commune string, code_departement string, annee int, type_local string, nb_transactions bigint,"
           " prix_m2_moyen double, hausse_prix_pct double, score_tension double, categorie_tension string")


@pytest.fixture(scope="module")
def tension(spark):
    return spark.createDataFrame([
        ("01001", "Belley", "1", 2024, "Maison", 30, 1500.4, 2.0, 80.0, "Très tendu"),
        ("01001", "Belley", "1", 2023, "Maison", 20, 1400.0, None, 90.0, "Très tendu"),
        ("01002", "Arles", "1", 2024, "Maison", 30, 1500.5, None, 80.0, "Très tendu"),
        ("75056", "Paris", "75", 2024, "Appartement", 90, 9000.0, 1.25, 60.04, "Tendu"),
        ("75056", "Paris", "75", 2024, "Maison", 10, 9500.0, -1.0, None, "Détendu"),
    ], TENSION)


@pytest.fixture(scope="module")
def communes(spark):
    return spark.createDataFrame([("01001", "84"), ("01002", "93"), ("75056", "11")], "code_insee string, reg string")


def test_map(spark, tension, communes):
    got = dashboard.map_rows(tension, communes).collect()
    assert [(r.nom_commune, r.score_tension, r.prix_m2_moyen) for r in got] == [
        ("Arles", 80.0, 1501.0), ("Belley", 80.0, 1500.0), ("Paris", 60.0, 9000.0)]
    assert [r.nom_commune for r in dashboard.map_rows(tension, communes, "hausse_prix_pct", 2024, "Maison").collect()] == ["Belley", "Paris"]
    assert dashboard.map_rows(tension, communes, annee=2023).count() == 1
    assert [r.nom_commune for r in dashboard.map_rows(tension, communes, region="11").collect()] == ["Paris"]
    with pytest.raises(ValueError):
        dashboard.map_rows(tension, communes, "annee; DROP TABLE")
    kpis = dashboard.map_kpis(dashboard.map_rows(tension, communes)).collect()[0]
    assert (kpis.val_moyenne, kpis.nb_communes, kpis.nb_tres_tendu, kpis.val_max, kpis.commune_top) == (73.3, 3, 2, 80.0, "Arles")
    departments = {r.code_departement: (r.valeur, r.prix_m2_moyen) for r in dashboard.map_departments(dashboard.map_rows(tension, communes)).collect()}
    assert departments == {"01": (80.0, 1500.0), "75": (60.0, 9000.0)}


def test_cities(tension):
    assert [r.score_tension for r in dashboard.city_tension(tension, "01001", "Maison").collect()] == [90.0, 80.0]
    pair = dashboard.city_pair(tension, {"01001": "Belley", "01002": "Arles"}, "Maison").collect()
    assert [(r.ville, r.annee) for r in pair] == [("Arles", 2024), ("Belley", 2023), ("Belley", 2024)]


RATIOS = ("observatory_b string, nom_agglomeration string, annee int, type_habitat string, nombre_pieces string,"
          " loyer_mensuel_median double, revenu_mensuel_moyen double, ratio_tension_pct double")


def test_search(spark):
    ratios = spark.createDataFrame([
        ("B1", "Évian", 2023, "Appartement", "Tous", 900.0, 2000.0, 45.0), ("B1", "Évian", 2022, "Appartement", "Tous", 100.0, 2000.0, 5.0),
        ("B1", "Évian", 2023, "Appartement", "4P+", 1200.0, 2000.0, 60.0), ("B2", "Gex", 2023, "Appartement", "Tous", 600.0, 2000.0, 30.0),
        ("B2", "Gex", 2021, "Maison", "Tous", 700.0, 2000.0, 35.0),
    ], RATIOS)
    agglomerations = spark.createDataFrame([(1, "Évian"), (2, "Gex")], "id_agglomeration int, nom_agglomeration string")
    mapping = spark.createDataFrame([("B1", 1, "u1"), ("B2", 2, "u1"), ("B2", 1, "u9")], "observatory_b string, id_agglomeration int, uu2020 string")
    communes = spark.createDataFrame([("74119", "Évian-les-Bains", "74", "84", "u1"), ("01173", "Gex", "01", "84", "u1"), ("x", "hors", "01", "84", None)],
                                     "code_insee string, nom_commune string, code_departement string, reg string, uu2020 string")

    def search(**options):
        return dashboard.search(ratios, agglomerations, mapping, communes, 2000, **options)

    assert {(r.code_insee, r.nom_agglomeration, r.taux_effort_vous) for r in search().collect()} == {("74119", "Gex", 30.0), ("01173", "Gex", 30.0)}
    assert {(r.loyer_median, r.code_insee) for r in search(nombre_pieces="4P+", departement="74").collect()} == {(1200.0, "74119")}
    assert {r.loyer_median for r in search(annee=2022).collect()} == {100.0}
    assert {r.annee_donnees for r in search(type_habitat="Maison").collect()} == {2021}
    counts = dashboard.search_counts(search()).collect()[0]
    assert (counts.n_total, counts.n_accessible, counts.n_tendu) == (2, 2, 0)
    shown = dashboard.search_display(search(nombre_pieces="4P+"), "evian").collect()
    assert [(r.nom_commune, r.accessibilite) for r in shown] == [("Gex", "🔴 Difficile"), ("Évian-les-Bains", "🔴 Difficile")]


def test_bound_values_are_not_sql(spark, tension):
    hostile = "x' OR '1'='1"
    got = dashboard.ad_hoc(spark, "SELECT * FROM {t} WHERE nom_commune = :name", {"t": tension}, name=hostile)
    assert got.count() == 0


def test_accepted_values_of_both_marts(spark, tension):
    prices = spark.createDataFrame([("01001", 2024), ("01001", 2020), ("01002", 2020), ("01002", None)], "code_insee string, annee int")
    odd = spark.createDataFrame([("Calme",), ("Calme",), ("tendu",), ("Tendu",), (None,)], "categorie_tension string")
    bands = tension.select("categorie_tension").unionByName(odd)
    star = SimpleNamespace(gold=SimpleNamespace(prices=prices, tension=bands))
    got = {(r.annee, r.categorie_tension): r.n for r in dq_accepted_values(star).collect()}
    assert got == {(2020, None): 2, (None, "Calme"): 2, (None, "tendu"): 1}


def test_mart_checks(spark, tension):
    years = tension.select("code_insee", "nom_commune", "annee", "type_local", "nb_transactions", F.lit(-1.0).alias("prix_m2_median"))
    ratios = spark.createDataFrame([("B1", "a", 2023, "Maison", "Tous", 1.0, 1.0, 250.0), ("B1", "a", 2022, "Maison", "Tous", 1.0, 1.0, None)], RATIOS)
    inequality = spark.createDataFrame([("B1", 2023, "Maison", 10.0, 9.0, 1, 0, 1)],
                                       "observatory_b string, annee int, type_habitat string, taux_effort_modeste_pct double, taux_effort_median_pct double,"
                                       " rang_accessibilite_modeste int, rang_accessibilite_median int, rang_accessibilite_aise int")
    report = quality.check_marts({
        "prix_m2_par_ville": years, "ratio_loyer_revenu": ratios, "dynamisme_marche": tension,
        "evolution_tension": ratios.limit(0), "inegalites": inequality,
    })
    failed = {(r.table_name, r.rule, r.column_name): r.failures for r in report.collect() if r.failures}
    assert failed == {
        ("ratio_loyer_revenu", "not_null", "ratio_tension_pct"): 1, ("dynamisme_marche", "not_null", "score_tension"): 1,
        ("evolution_tension", "row_count", "*"): 1, ("ratio_loyer_revenu", "bounds", "ratio_tension_pct"): 1,
        ("prix_m2_par_ville", "bounds", "prix_m2_median"): 5, ("inegalites", "bounds", "rang_accessibilite"): 1,
    }
