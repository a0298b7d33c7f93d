"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import exact_round
from ..functions.text import bare_name
from ..operators import relational
from ..operators.matching import best_match, nearest
from ..plans import dashboard, mapping, silver
from ..plans.marts import rent_signal
from ..sources.starschema import Star, unit
from .base import Section, rnd

QUERIES = q = Section()


@q(f"""SELECT nom_commune, code_departement, annee, count(*) AS n, {rnd('avg(prix_m2)', 2)} AS prix
    FROM g_sales JOIN g_communes USING (code_insee) GROUP BY ALL""")
def join_fact_dim(s: Star):
    by_code = s.sales.groupBy("code_insee", "annee").agg(
        F.count(F.lit(1)).alias("n"), F.sum("prix_m2").alias("total"), F.count("prix_m2").alias("priced")
    )
    # Towns of one name in one department are one group.
    named = by_code.join(s.communes, "code_insee").groupBy("nom_commune", "code_departement", "annee").agg(
        F.sum("n").alias("n"), (F.sum("total") / F.sum("priced")).alias("p")
    )
    return named.select("nom_commune", "code_departement", "annee", "n", exact_round(F.col("p"), 2).alias("prix"))


@q(f"SELECT code_insee, observatory_b, annee, {rnd('revenu_mensuel', 2)} AS revenu FROM g_incomes JOIN g_bridge USING (code_insee)")
def join_bridge_nn(s: Star):
    return s.incomes.join(s.bridge, "code_insee").select(
        "code_insee", "observatory_b", "annee", exact_round(F.col("revenu_mensuel"), 2).alias("revenu")
    )


@q(f"""SELECT observatory_b, annee, {rnd('loyer', 2)} AS loyer, {rnd('revenu', 2)} AS revenu
    FROM (SELECT observatory_b, annee, avg(loyer_mensuel_median) AS loyer FROM g_rents GROUP BY ALL)
    JOIN (SELECT observatory_b, annee, avg(revenu_median) AS revenu FROM g_incomes JOIN g_bridge USING (code_insee) GROUP BY ALL)
    USING (observatory_b, annee)""")
def join_composite_key(s: Star):
    rents = s.rents.groupBy("observatory_b", "annee").agg(exact_round(F.avg("loyer_mensuel_median"), 2).alias("loyer"))
    incomes = s.incomes.join(s.bridge, "code_insee").groupBy("observatory_b", "annee").agg(
        exact_round(F.avg("revenu_median"), 2).alias("revenu")
    )
    return rents.join(incomes, ["observatory_b", "annee"])


@q(f"""SELECT nom_agglomeration, type_habitat, {rnd('avg(loyer_mensuel_median)', 2)} AS loyer, {rnd('any_value(revenu)', 2)} AS revenu
    FROM g_rents JOIN (SELECT observatory_b, avg(revenu_mensuel) AS revenu FROM g_incomes JOIN g_bridge USING (code_insee) GROUP BY 1)
    USING (observatory_b) GROUP BY ALL""")
def join_three_way_star(s: Star):
    rents = s.rents.groupBy("observatory_b", "id_agglomeration", "type_habitat").agg(
        exact_round(F.avg("loyer_mensuel_median"), 2).alias("loyer")
    )
    incomes = s.incomes.join(s.bridge, "code_insee").groupBy("observatory_b").agg(
        exact_round(F.avg("revenu_mensuel"), 2).alias("revenu")
    )
    return rents.join(s.agglomerations, "id_agglomeration").join(incomes, "observatory_b").select(
        "nom_agglomeration", "type_habitat", "loyer", "revenu"
    )


@q(f"""SELECT code_insee, nom_commune, annee, {rnd('ratio_tension_pct', 4)} AS ratio
    FROM g_communes LEFT JOIN g_signal USING (code_insee)""")
def join_left_outer(s: Star):
    return s.communes.join(rent_signal(s.ratios, s.bridge), "code_insee", "left").select(
        "code_insee", "nom_commune", "annee", exact_round(F.col("ratio_tension_pct"), 4).alias("ratio")
    )


@q(f"""SELECT code_insee, {rnd('revenu_median', 2)} AS revenu FROM g_incomes
    WHERE annee = (SELECT max(annee) FROM g_incomes)""")
def join_scalar_subquery(s: Star):
    last = s.table("lineitem").agg(F.max(F.year("l_shipdate"))).scalar()
    return s.incomes.where(F.col("annee") == last).select("code_insee", exact_round(F.col("revenu_median"), 2).alias("revenu"))


@q("""SELECT r.c_custkey, r.o_orderkey, r.annee FROM (SELECT o_custkey AS c_custkey, o_orderkey, year(o_orderdate)::INT AS annee FROM orders) r
    JOIN (SELECT o_custkey, max(year(o_orderdate)) AS last FROM orders GROUP BY 1) m ON m.o_custkey = r.c_custkey AND m.last = r.annee""")
def join_latest_per_group(s: Star):
    orders = s.table("orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.year("o_orderdate").alias("annee"))
    return relational.keep_latest_ties(orders, ["c_custkey"], "annee").select("c_custkey", "o_orderkey", "annee")


@q("""SELECT code_insee, nom_agglomeration, type_habitat, annee, loyer_mensuel_median AS loyer
    FROM (SELECT *, rank() OVER (PARTITION BY observatory_b, nom_agglomeration, type_habitat ORDER BY annee DESC) AS r
          FROM g_ratios WHERE nombre_pieces = 'Tous')
    JOIN g_agglos USING (nom_agglomeration)
    JOIN (SELECT DISTINCT observatory_b, id_agglomeration, {unit} AS uu2020 FROM g_rents) USING (observatory_b, id_agglomeration)
    JOIN g_communes USING (uu2020) WHERE r = 1""".replace("{unit}", "lpad((substr(observatory_b, 2)::INT * 1000)::VARCHAR, greatest(5, length((substr(observatory_b, 2)::INT * 1000)::VARCHAR))::INT, '0')"))
def join_search_four_way(s: Star):
    """Latest rents, agglomeration by name, mapping by both keys, communes by unit."""
    rents = s.ratios.where(F.col("nombre_pieces") == dashboard.ALL_ROOMS)
    recent = relational.keep_latest_ties(rents, ["observatory_b", "nom_agglomeration", "type_habitat"], "annee")
    home = s.rents.select("observatory_b", "id_agglomeration").distinct().withColumn(
        "uu2020", unit(F.substring("observatory_b", 2, 9).cast("int"))
    )
    return (
        recent.join(s.agglomerations, "nom_agglomeration").join(home, ["observatory_b", "id_agglomeration"])
        .join(s.communes, "uu2020")
        .select("code_insee", "nom_agglomeration", "type_habitat", "annee", exact_round(F.col("loyer_mensuel_median"), 2).alias("loyer"))
    )


@q("""SELECT c_mktsegment AS segment, s_suppkey AS found, count(*) AS n
    FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN supplier ON s_suppkey = o_custkey AND s_acctbal > 3000 GROUP BY ALL""")
def join_lookup_map(s: Star):
    """Looked-up key, NULL where the map has none."""
    known = s.table("supplier").where("s_acctbal > 3000").select(F.col("s_suppkey").alias("found"))
    orders = s.table("orders").select("o_custkey").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("k"))
    named = orders.join(s.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
    looked = named.join(known, F.col("o_custkey") == F.col("found"), "left")
    return looked.groupBy(F.col("c_mktsegment").alias("segment"), "found").agg(
        F.sum("k").alias("n")
    )


@q("SELECT nom_agglomeration, count(*) AS n FROM g_rents WHERE NOT contains(nom_agglomeration, 'HOUSEHOLD') GROUP BY 1")
def report_unmatched_names(s: Star):
    """Survey names that the dimension lacks, with their lines; the dimension holds one segment only."""
    return silver.unmatched_agglomerations([s.raw_rents], s.agglomerations.where("contains(nom_agglomeration, 'HOUSEHOLD')"))


@q("""SELECT code_insee, coalesce(CASE WHEN reg = 'ASIA' THEN uu2020 END, 'old') AS uu2020,
    CASE WHEN reg = 'ASIA' THEN reg END AS reg FROM g_communes""")
def join_left_coalesce(s: Star):
    base = s.communes.select("code_insee", F.lit("old").alias("uu2020"), F.lit(None).cast("string").alias("reg"))
    geo = s.communes.where("reg = 'ASIA'").select("code_insee", "uu2020", "reg")
    return relational.prefer(base, geo, "code_insee", ["uu2020", "reg"])


@q("SELECT observatory_b, uu2020, nom_uu, votes FROM g_votes")
def join_votes(s: Star):
    return mapping.voted_units(s.bridge, s.communes, s.units)


@q("SELECT count(*) AS orphans FROM orders WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = o_custkey)")
def join_anti_orphans(s: Star):
    return relational.orphans(s.table("orders"), "o_custkey", s.table("supplier"), "s_suppkey").agg(
        F.count(F.lit(1)).alias("orphans")
    )


@q("""WITH names AS (SELECT DISTINCT p_brand, p_name FROM part),
    wanted AS (SELECT DISTINCT p_brand, p_type FROM part)
    SELECT p_brand, p_type, p_name AS best, levenshtein(lower(p_type), p_name) AS distance FROM wanted JOIN names USING (p_brand)
    QUALIFY row_number() OVER (PARTITION BY p_brand, p_type ORDER BY levenshtein(lower(p_type), p_name), p_name) = 1""")
def join_theta_similarity(s: Star):
    """Nearest part name within the brand for each part type."""
    part = s.table("part")
    wanted = part.select("p_brand", F.lower("p_type").alias("kind"), "p_type").distinct()
    best = nearest(wanted, part, ["p_brand"], "kind", "p_name")
    return wanted.join(best, ["p_brand", "kind"]).select(
        "p_brand", "p_type", F.col("p_name").alias("best"), F.col("distance").cast("bigint").alias("distance")
    )


@q("""SELECT name, f_score AS score, f_uu AS uu2020 FROM (SELECT DISTINCT name FROM g_towns t
        WHERE coalesce((SELECT max(score) FROM g_votes v JOIN g_scores ON b = {bare} WHERE a = t.name AND v.observatory_b = t.observatory_b), 0) < 70)
    JOIN (SELECT a, g_units.uu2020 AS f_uu, score AS f_score FROM g_units JOIN g_scores ON b = {bare}
          QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, uu2020) = 1) ON a = name""".replace(
    "{bare}", "lower(trim(regexp_replace(nom_uu, '\\(.*?\\)', '', 'g')))"))
def join_fallback_cross(s: Star):
    """Best unit of the country for the towns without a good vote."""
    weak = mapping.best_votes(s.rents, s.agglomerations, s.bridge, s.communes, s.units).where(F.col("score") < mapping.GOOD_SCORE)
    return best_match(weak, mapping.unit_names(s.units), []).select("name", "score", F.col("code").alias("uu2020"))
