"""Marts and whole-table jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.codes import PARIS
from ..functions.numbers import exact_round
from ..plans import ledger, mapping, silver
from ..session import shared_folder
from ..sources.readers import years_in
from ..sources.starschema import Star
from ..streaming.incremental import load_pending_years, loaded_sales
from .base import TYPE_LOCAL, Section, pad, rnd

QUERIES = q = Section()


@q("SELECT * FROM g_prices")
def mart_price(s: Star):
    return s.prices


@q("SELECT * FROM g_ratios")
def mart_rent_income(s: Star):
    return s.ratios


@q(f"SELECT * REPLACE ({rnd('ratio_tension_pct', 6)} AS ratio_tension_pct) FROM g_tension")
def mart_tension(s: Star):
    return s.tension.withColumn("ratio_tension_pct", exact_round(F.col("ratio_tension_pct"), 6))


@q("SELECT * FROM g_trend")
def mart_tension_trend(s: Star):
    return s.trend


@q(f"""SELECT * REPLACE ({rnd('revenu_annee_precedente', 4)} AS revenu_annee_precedente,
    {rnd('loyer_annee_precedente', 4)} AS loyer_annee_precedente) FROM g_inequality""")
def mart_inequality(s: Star):
    return s.inequality.withColumns({
        c: exact_round(F.col(c), 4) for c in ("revenu_annee_precedente", "loyer_annee_precedente")
    })


@q("SELECT * FROM g_mapping")
def job_entity_mapping(s: Star):
    return s.mapping


@q(f"""SELECT count(*) AS mapped, {rnd('avg(score_fuzzy)', 2)} AS mean_score, count(*) FILTER (score_fuzzy < 70) AS ambiguous,
    count(*) FILTER (nb_communes_vote > 0) AS by_vote, count(*) FILTER (nb_communes_vote = 0) AS by_fallback FROM g_mapping""")
def agg_mapping_quality(s: Star):
    found = mapping.mapping_quality(s.mapping)
    return found.withColumn("mean_score", exact_round(F.col("mean_score"), 2))


@q("SELECT DISTINCT observatory_b FROM g_rents")
def job_dim_observatoire(s: Star):
    return silver.dim_observatoire([s.raw_rents])


@q("SELECT DISTINCT id_agglomeration, nom_agglomeration FROM g_rents")
def job_dim_agglomeration(s: Star):
    return silver.dim_agglomeration([s.raw_rents])


@q(f"""SELECT code_insee, nom_commune, code_postal, code_departement, NULL::VARCHAR AS region, uu2020, reg
    FROM g_communes WHERE region <> 'ASIA' AND length(code_insee) BETWEEN 5 AND 6
    UNION ALL SELECT code_insee, 'Ville ' || s_suppkey, CASE WHEN s_suppkey > 0 THEN {pad('s_suppkey * 10', 5)} END,
        (s_suppkey // 1000)::VARCHAR, NULL, uu2020, reg
    FROM g_communes JOIN supplier ON s_name = nom_commune WHERE region = 'ASIA' AND length(code_insee) BETWEEN 5 AND 6
    UNION ALL SELECT '75101', min(s_name), NULL, NULL, NULL, NULL, NULL FROM supplier WHERE s_acctbal < 0 HAVING count(*) > 0""")
def job_dim_commune(s: Star):
    sources = [
        silver.communes_from_reference(s.raw_communes), silver.communes_from_sales(s.raw_sales),
        silver.communes_from_income(s.raw_income), silver.communes_from_zoning(s.raw_zoning),
    ]
    return silver.dim_commune(sources, silver.communes_geo(s.raw_geo))


@q(f"""SELECT DISTINCT code_insee, observatory_b FROM
    (SELECT CASE WHEN s_acctbal < 0 THEN '75056' ELSE {pad('s_suppkey', 5)} END AS code_insee, 'B' || {pad('k', 2)} AS observatory_b
     FROM (SELECT *, unnest([s_nationkey, s_nationkey + 5]) AS k FROM supplier))
    WHERE observatory_b IN (SELECT observatory_b FROM g_obs) AND length(code_insee) = 5""")
def job_bridge(s: Star):
    city = s.spark.range(1).select(F.lit(PARIS).alias("code_insee"))
    return silver.bridge([s.raw_zoning], s.communes.select("code_insee").union(city), s.observatories)


@q("""SELECT observatory_b, id_agglomeration, annee, type_habitat, nombre_pieces, loyer_mensuel_median, loyer_median_m2,
        (o_orderkey % 90 + 10)::DOUBLE AS nombre_observations FROM g_rents
    QUALIFY row_number() OVER (PARTITION BY observatory_b, id_agglomeration, annee, type_habitat, nombre_pieces
        ORDER BY loyer_mensuel_median, loyer_median_m2, o_orderkey % 90) = 1""")
def job_fact_loyers(s: Star):
    return silver.fact_loyers([s.raw_rents], s.agglomerations)


@q(f"""SELECT {pad('l_suppkey', 5)} AS code_insee, annee, total + 0.5::DOUBLE AS revenu_median, {rnd('(total + 0.5::DOUBLE) / 12', 4)} AS revenu_mensuel
    FROM (SELECT l_suppkey, year(l_shipdate)::INT AS annee, round(sum(l_extendedprice::DECIMAL(18,2)), 0)::BIGINT AS total
          FROM lineitem GROUP BY ALL) JOIN supplier ON s_suppkey = l_suppkey WHERE total >= 500000""")
def job_fact_revenus(s: Star):
    facts = silver.income_facts(silver.income_rows(s.raw_income, F.col("annee"), "Q2"), s.communes)
    return facts.withColumn("revenu_mensuel", exact_round(F.col("revenu_mensuel"), 4))


@q(f"""SELECT code_insee, annee, type_local, nature_mutation, valeur_fonciere, surface_bati, surface_terrain, nombre_pieces,
        {rnd('prix_m2', 4)} AS prix_m2, nature_culture FROM
    (SELECT {pad('l_suppkey', 5)} AS code_insee, year(l_shipdate)::INT AS annee, {TYPE_LOCAL} AS type_local, 'Vente' AS nature_mutation,
        l_extendedprice AS valeur_fonciere, l_quantity AS surface_bati, l_tax * 100 AS surface_terrain, l_linenumber AS nombre_pieces,
        l_extendedprice / l_quantity AS prix_m2, CASE WHEN l_discount > 0.05 THEN 'S' END AS nature_culture
     FROM lineitem WHERE l_linestatus = 'O' AND l_returnflag IN ('A', 'R') AND l_quantity >= 1
        AND l_suppkey IN (SELECT s_suppkey FROM supplier))
    WHERE prix_m2 BETWEEN 500 AND 13731
    QUALIFY row_number() OVER (PARTITION BY code_insee, annee, type_local, valeur_fonciere, surface_bati, nombre_pieces
        ORDER BY surface_terrain, nature_culture NULLS LAST) = 1""")
def job_fact_transactions(s: Star):
    facts = silver.fact_transactions(s.raw_sales, s.communes)
    return facts.withColumn("prix_m2", exact_round(F.col("prix_m2"), 4))


@q(f"""SELECT annee, count(*) AS n, {rnd('sum(valeur_fonciere)', 2)} AS total FROM
    (SELECT DISTINCT {pad('l_suppkey', 5)} AS code_insee, year(l_shipdate)::INT AS annee, {TYPE_LOCAL} AS type_local,
        l_extendedprice AS valeur_fonciere, l_quantity AS surface_bati, l_linenumber AS nombre_pieces
     FROM lineitem WHERE l_linestatus = 'O' AND l_returnflag IN ('A', 'R') AND l_quantity >= 1
        AND l_suppkey IN (SELECT s_suppkey FROM supplier) AND l_extendedprice / l_quantity BETWEEN 500 AND 13731) GROUP BY 1""")
def job_incremental_sales(s: Star):
    """Two loads of yearly files, of which some hold sales dated the year before."""
    year = F.right("Date_mutation", F.lit(4)).cast("int") + (F.col("Nombre_pieces_principales") == 7).cast("int")
    files = s.raw_sales.withColumn("annee", year)
    folder = shared_folder(s.spark, "sales")
    log = s.spark.createDataFrame([], ledger.COLUMNS)
    for part in (files.where("annee <= 1995"), files.where("annee > 1995")):
        part.write.mode("append").partitionBy("annee").parquet(f"{folder}/raw")
        log = load_pending_years(s.spark, f"{folder}/raw", s.communes, f"{folder}/clean", log)
    return loaded_sales(s.spark, f"{folder}/clean").groupBy("annee").agg(
        F.count(F.lit(1)).alias("n"), exact_round(F.sum("valeur_fonciere"), 2).alias("total")
    )


@q("""SELECT annee FROM g_sales UNION SELECT annee FROM g_rents UNION SELECT annee FROM g_incomes""")
def job_dim_temps(s: Star):
    return silver.dim_temps(years_in(s.sales, s.rents, s.incomes))


@q("SELECT DISTINCT type_local AS type_bien FROM g_sales")
def job_dim_type_bien(s: Star):
    return silver.dim_type_bien(s.raw_sales)


@q("""SELECT uu2020, nom_uu, length(nom_uu)::VARCHAR AS nb_communes, count(code_insee) AS communes
    FROM g_units LEFT JOIN g_communes USING (uu2020) GROUP BY ALL""")
def job_ref_geo_split(s: Star):
    """Urban units of the reference table, with the communes its other level places in them."""
    communes, units = silver.communes_geo(s.raw_geo), silver.urban_units(s.raw_zones)
    counted = communes.groupBy("uu2020").agg(F.count(F.lit(1)).alias("communes"))
    return units.join(counted, "uu2020", "left").withColumn("communes", F.coalesce("communes", F.lit(0)))
