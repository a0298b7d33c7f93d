"""Dashboard queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import dashboard
from ..sources.starschema import Star, code5
from .base import Section, rnd, rnde

QUERIES = q = Section()

NAMES = ("Agglomération de HOUSEHOLD NATION_3", "Agglomération de FURNITURE NATION_7", "Agglomération de AUTOMOBILE NATION_12",
         "Eurométropole de AFRICA BUILDING 0", "Agglomération de HOUSEHOLD NATION_0", "Agglomération de HOUSEHOLD NATION_1")
LISTED = ", ".join(f"'{n}'" for n in NAMES)
COMPARED = f"nom_agglomeration IN ({LISTED}) AND type_habitat = 'Appartement'"
MAP = f"""(SELECT code_insee, nom_commune, t.code_departement, type_local, {rnd('score_tension', 1)} AS score_tension,
    {rnd('prix_m2_moyen', 0)} AS prix_m2_moyen, {rnd('hausse_prix_pct', 1)} AS hausse_prix_pct, nb_transactions,
    categorie_tension, c.reg FROM g_tension t JOIN g_communes c USING (code_insee, nom_commune)
    WHERE annee = (SELECT max(annee) FROM g_tension) AND score_tension IS NOT NULL)"""


@q(f"""SELECT (SELECT count(DISTINCT nom_commune) FROM g_prices) AS nb_communes,
    (SELECT {rnd('avg(ratio_tension_pct)', 1)} FROM g_ratios) AS ratio_moyen,
    min(annee) AS min_annee, max(annee) AS max_annee, max(annee) - min(annee) + 1 AS couverture,
    count(DISTINCT nom_commune) FILTER (categorie_tension IN ('Très tendu', 'Tendu') AND annee = (SELECT max(annee) FROM g_tension)) AS nb_tendu,
    (SELECT count(*) FROM g_obs) AS nb_obs FROM g_tension""")
def q_home_kpis(s: Star):
    return dashboard.home_kpis(s.spark, s.gold.prices, s.gold.ratios, s.gold.tension, s.observatories)


@q(f"SELECT * FROM {MAP} ORDER BY score_tension DESC, nom_commune, type_local")
def q_map(s: Star):
    return dashboard.map_rows(s.gold.tension, s.communes)


@q(f"""SELECT CASE WHEN length(code_departement) < 2 THEN '0' || code_departement ELSE code_departement END AS code_departement,
    {rnde('avg(score_tension)', 1)} AS valeur, {rnde('avg(prix_m2_moyen)', 0)} AS prix_m2_moyen,
    {rnde('avg(score_tension)', 1)} AS score_moyen, {rnde('avg(hausse_prix_pct)', 1)} AS hausse_moy FROM {MAP} GROUP BY 1""")
def q_map_department(s: Star):
    return dashboard.map_departments(dashboard.map_rows(s.gold.tension, s.communes))


@q(f"""SELECT {rnde('avg(score_tension)', 1)} AS val_moyenne, count(DISTINCT nom_commune) AS nb_communes,
    count(DISTINCT nom_commune) FILTER (categorie_tension = 'Très tendu') AS nb_tres_tendu,
    {rnde('max(score_tension)', 1)} AS val_max, (SELECT nom_commune FROM {MAP} GROUP BY 1
        ORDER BY avg(score_tension) DESC, nom_commune LIMIT 1) AS commune_top FROM {MAP}""")
def q_map_kpis(s: Star):
    return dashboard.map_kpis(dashboard.map_rows(s.gold.tension, s.communes))


@q(f"""SELECT nom_agglomeration, annee, loyer_mensuel_median, revenu_mensuel_moyen, ratio_tension_pct FROM
    (SELECT *, max(annee) OVER (PARTITION BY nom_agglomeration) AS last FROM g_ratios WHERE {COMPARED} AND nombre_pieces = 'Tous')
    WHERE annee = last""")
def q_compare_latest_rent(s: Star):
    return dashboard.compare_latest_rent(s.gold.ratios, NAMES)


@q(f"""SELECT nom_agglomeration, revenu_d1, revenu_median, revenu_d9, taux_effort_modeste_pct, taux_effort_median_pct,
    taux_effort_aise_pct, evolution_loyer_pct, evolution_revenu_pct FROM
    (SELECT *, max(annee) OVER (PARTITION BY nom_agglomeration) AS last FROM g_ineg WHERE {COMPARED}) WHERE annee = last""")
def q_compare_inequality(s: Star):
    return dashboard.compare_inequality(s.gold.inequality, NAMES)


@q(f"SELECT nom_agglomeration, annee, loyer_mensuel_median, ratio_tension_pct FROM g_ratios WHERE {COMPARED} AND nombre_pieces = 'Tous'")
def q_compare_series(s: Star):
    return dashboard.compare_series(s.gold.ratios, NAMES)


# The two busiest communes of all sales, so the queries follow the data.
BUSIEST = """(SELECT code_insee FROM g_sales GROUP BY 1 ORDER BY count(*) DESC, code_insee LIMIT 2)"""


def _busiest(s: Star, n: int) -> list[str]:
    counts = s.table("lineitem").groupBy(code5(F.col("l_suppkey")).alias("code")).agg(F.count(F.lit(1)).alias("n"))
    return [r.code for r in counts.orderBy(F.desc("n"), "code").limit(n).collect()]


@q(f"""SELECT annee, prix_m2_median, prix_m2_moyen, nb_transactions, evolution_annuelle_pct, moving_avg_3ans FROM g_prices
    WHERE code_insee = (SELECT code_insee FROM g_sales GROUP BY 1 ORDER BY count(*) DESC, code_insee LIMIT 1) AND type_local = 'Appartement'""")
def q_city_price(s: Star):
    return dashboard.city_price(s.gold.prices, _busiest(s, 1)[0])


@q("""SELECT annee, score_tension, categorie_tension, hausse_prix_pct FROM g_tension
    WHERE code_insee = (SELECT code_insee FROM g_sales GROUP BY 1 ORDER BY count(*) DESC, code_insee LIMIT 1) AND type_local = 'Appartement'""")
def q_city_tension(s: Star):
    return dashboard.city_tension(s.gold.tension, _busiest(s, 1)[0])


@q(f"""SELECT annee, score_tension, categorie_tension, hausse_prix_pct, 'Ville ' || code_insee AS ville FROM g_tension
    WHERE code_insee IN {BUSIEST} AND type_local = 'Appartement'""")
def q_city_pair(s: Star):
    return dashboard.city_pair(s.gold.tension, {code: f"Ville {code}" for code in _busiest(s, 2)})


SEARCH = f"""(SELECT DISTINCT ON (code_insee) * FROM (SELECT code_insee, nom_commune, code_departement, reg, nom_agglomeration,
        annee AS annee_donnees, {rnd('loyer_mensuel_median', 0)} AS loyer_median, {rnd('revenu_mensuel_moyen', 0)} AS revenu_local,
        {rnd('ratio_tension_pct', 1)} AS taux_effort_local, {rnd('loyer_mensuel_median / 600000 * 100', 1)} AS taux_effort_vous
    FROM (SELECT *, max(annee) OVER (PARTITION BY observatory_b, nom_agglomeration, type_habitat, nombre_pieces) AS last
          FROM g_ratios WHERE type_habitat = 'Appartement' AND nombre_pieces ILIKE '%4P+%') r
    JOIN g_agglos USING (nom_agglomeration)
    JOIN g_mapping m USING (observatory_b, id_agglomeration) JOIN g_communes c ON c.uu2020 = m.uu2020
    WHERE annee = last)
    ORDER BY code_insee, annee_donnees DESC, loyer_median NULLS LAST, nom_agglomeration, taux_effort_vous NULLS LAST)"""


def _search(s: Star):
    mapped = s.silver("mapping").select("observatory_b", "id_agglomeration", "uu2020")
    return dashboard.search(s.gold.ratios, s.agglomerations, mapped, s.communes, 600_000, nombre_pieces="4P+")


@q(f"SELECT * FROM {SEARCH}")
def q_search(s: Star):
    return _search(s)


@q(f"""SELECT *, CASE WHEN taux_effort_vous < 33 THEN '🟢 Accessible' WHEN taux_effort_vous < 50 THEN '🟡 Tendu'
    ELSE '🔴 Difficile' END AS accessibilite FROM {SEARCH}
    WHERE contains(lower(strip_accents(nom_agglomeration)), 'agglomeration') OR contains(lower(strip_accents(nom_commune)), 'agglomeration')""")
def q_search_display(s: Star):
    return dashboard.search_display(_search(s), "Agglomération")
