"""Sorts, limits and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import relational
from ..plans import dashboard, mapping, silver
from ..sources.starschema import Star
from .base import Section

QUERIES = q = Section()


@q("SELECT nom_commune, annee, prix_m2_median FROM g_prices ORDER BY prix_m2_median DESC, nom_commune, annee")
def sort_multi_key(s: Star):
    return s.prices.select("nom_commune", "annee", "prix_m2_median").orderBy(F.desc("prix_m2_median"), "nom_commune", "annee")


@q("SELECT observatory_b, uu2020, nom_uu, votes FROM g_votes ORDER BY observatory_b, votes DESC, uu2020")
def sort_votes(s: Star):
    return mapping.voted_units(s.bridge, s.communes, s.units).orderBy("observatory_b", F.desc("votes"), "uu2020")


@q("SELECT nom_agglomeration, annee, ratio_tension_pct FROM g_ratios ORDER BY ratio_tension_pct NULLS LAST")
def sort_accessibility(s: Star):
    return s.ratios.select("nom_agglomeration", "annee", "ratio_tension_pct").orderBy(F.asc_nulls_last("ratio_tension_pct"))


@q("SELECT least(count(*), 1000) AS n FROM orders")
def limit_sample(s: Star):
    """A limit without an order: only its size is determined."""
    return s.table("orders").limit(1000).agg(F.count(F.lit(1)).alias("n"))


@q("""SELECT 'orders' AS name, EXISTS (SELECT 1 FROM orders) AS filled
    UNION ALL SELECT 'large', EXISTS (SELECT 1 FROM orders WHERE o_totalprice > 1e9)""")
def exists_nonempty(s: Star):
    orders = s.table("orders")
    parts = {"orders": orders, "large": orders.where("o_totalprice > 1e9")}
    one = s.spark.range(1)
    return relational.union_by_name(
        [one.select(F.lit(name).alias("name"), df.exists().alias("filled")) for name, df in parts.items()]
    )


@q("""SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000 ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def topk_threshold(s: Star):
    large = s.table("orders").where("o_totalprice > 250000").select("o_orderkey", "o_totalprice")
    return large.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@q("""SELECT 'reg' AS kind, reg AS label FROM (SELECT DISTINCT reg FROM g_communes)
    UNION ALL SELECT 'annee', annee::VARCHAR FROM (SELECT DISTINCT annee FROM g_ratios)
    UNION ALL SELECT 'ville', nom_commune FROM (SELECT DISTINCT nom_commune, code_insee FROM g_prices)""")
def topk_distinct_options(s: Star):
    lists = {
        "reg": (dashboard.options(s.communes, ["reg"]), "reg"),
        "annee": (dashboard.options(s.ratios, ["annee"], descending=True), "annee"),
        "ville": (dashboard.options(s.prices, ["nom_commune", "code_insee"]), "nom_commune"),
    }
    return relational.union_by_name(
        [df.select(F.lit(k).alias("kind"), F.col(c).cast("string").alias("label")) for k, (df, c) in lists.items()]
    ).orderBy("kind", F.when(F.col("kind") == "annee", -F.col("label").try_cast("int")), "label")


@q("SELECT l_suppkey AS code, year(l_shipdate)::INT AS annee FROM lineitem UNION ALL SELECT o_custkey, year(o_orderdate)::INT FROM orders")
def set_union_all(s: Star):
    sales = s.table("lineitem").select(F.col("l_suppkey").alias("code"), F.year("l_shipdate").alias("annee"))
    return sales.union(s.table("orders").select("o_custkey", F.year("o_orderdate")))


@q("""SELECT s_suppkey AS code, s_name AS name, NULL::DOUBLE AS balance FROM supplier
    UNION ALL SELECT c_custkey, NULL, c_acctbal FROM customer""")
def set_union_by_name(s: Star):
    suppliers = s.table("supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("code"))
    customers = s.table("customer").select(F.col("c_custkey").alias("code"), F.col("c_acctbal").alias("balance"))
    return relational.union_by_name([suppliers, customers])


@q("SELECT s_nationkey AS k FROM supplier UNION SELECT c_nationkey FROM customer")
def set_distinct(s: Star):
    return s.table("supplier").select(F.col("s_nationkey").alias("k")).union(s.table("customer").select("c_nationkey")).distinct()


@q(f"""SELECT * FROM (SELECT code_insee, annee, type_local, surface_bati,
        CASE WHEN nombre_pieces < 7 THEN nombre_pieces END AS nombre_pieces, valeur_fonciere FROM g_sales)
    QUALIFY row_number() OVER (PARTITION BY code_insee, annee, type_local, surface_bati, nombre_pieces ORDER BY valeur_fonciere) = 1""")
def set_dedup_subset(s: Star):
    """Bulk sales counted once; unknown rooms are one value."""
    rooms = F.when(F.col("nombre_pieces") < 7, F.col("nombre_pieces")).alias("nombre_pieces")
    rows = s.sales.select("code_insee", "annee", "type_local", "surface_bati", rooms, "valeur_fonciere")
    return relational.dedup(rows, ["code_insee", "annee", "type_local", "surface_bati", "nombre_pieces"])


@q("""SELECT observatory_b, id_agglomeration, annee, type_habitat, nombre_pieces, min(loyer_mensuel_median) AS loyer_mensuel_median
    FROM g_rents GROUP BY ALL""")
def set_dedup_grain(s: Star):
    rows = s.rents.select(*silver.RENT_GRAIN, "loyer_mensuel_median")
    return relational.dedup(rows, silver.RENT_GRAIN)


@q("SELECT n_nationkey AS k FROM nation EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 8000")
def set_except(s: Star):
    rich = s.table("supplier").where("s_acctbal > 8000").select("s_nationkey")
    return s.table("nation").select(F.col("n_nationkey").alias("k")).subtract(rich)
