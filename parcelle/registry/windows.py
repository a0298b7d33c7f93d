"""Window functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.numbers import change_pct, exact_round
from ..operators import ranking, relational
from ..plans import marts
from ..sources.starschema import YEAR_FLOOR, Star
from .base import Section, rnd

QUERIES = q = Section()

YEARLY = """(SELECT code_insee, type_local, annee, avg(valeur_fonciere) AS v, count(*) AS n FROM g_sales GROUP BY ALL)"""
SERIES = "WINDOW y AS (PARTITION BY code_insee, type_local ORDER BY annee)"


def _yearly(s: Star):
    return s.sales.groupBy("code_insee", "type_local", "annee").agg(
        F.avg("valeur_fonciere").alias("v"), F.count(F.lit(1)).alias("n")
    )


def _years():
    return Window.partitionBy("code_insee", "type_local").orderBy("annee")


KEY = ("code_insee", "type_local", "annee")


@q(f"SELECT code_insee, type_local, annee, {rnd('lag(v) OVER y', 2)} AS previous FROM {YEARLY} {SERIES}")
def win_lag(s: Star):
    return _yearly(s).select(*KEY, exact_round(F.lag("v").over(_years()), 2).alias("previous"))


@q(f"""SELECT code_insee, type_local, annee, {rnd('(v - lag(v) OVER y) / nullif(lag(v) OVER y, 0) * 100', 2)} AS change
    FROM {YEARLY} {SERIES}""")
def win_yoy_pct(s: Star):
    before = F.lag("v").over(_years())
    return _yearly(s).select(*KEY, exact_round(change_pct(F.col("v"), before), 2).alias("change"))


@q("SELECT code_insee, type_local, annee, nb_transactions, hausse_prix_pct FROM g_rising")
def win_yoy_gated(s: Star):
    groups = marts.market_groups(s.sales, YEAR_FLOOR)
    return groups.select(*KEY, "nb_transactions", marts.gated_rise(_years()).alias("hausse_prix_pct"))


@q(f"""SELECT observatory_b, nom_agglomeration, annee, type_habitat, nombre_pieces, CASE WHEN annee - lag(annee) OVER y <= 1 THEN
        {rnd('(rent - lag(rent) OVER y) / nullif(lag(rent) OVER y, 0) * 100', 2)} END AS change
    FROM (SELECT observatory_b, nom_agglomeration, annee, type_habitat, nombre_pieces, avg(loyer_mensuel_median) AS rent FROM g_rents GROUP BY ALL)
    WINDOW y AS (PARTITION BY observatory_b, nom_agglomeration, type_habitat, nombre_pieces ORDER BY annee)""")
def win_yoy_gap_guard(s: Star):
    """Series with missing years: no change is given across a gap."""
    by = ["observatory_b", "id_agglomeration", "type_habitat", "nombre_pieces"]
    means = s.rents.groupBy(*by, "annee").agg(F.avg("loyer_mensuel_median").alias("rent"))
    changed = marts.with_yearly_change(means, by, "rent", "rent").join(s.agglomerations, "id_agglomeration")
    return changed.select(
        "observatory_b", "nom_agglomeration", "annee", "type_habitat", "nombre_pieces", F.col("rent_change").alias("change")
    )


@q(f"""SELECT observatory_b, nom_agglomeration, annee, type_habitat, nombre_pieces,
    {rnd('ratio_tension_pct - lag(ratio_tension_pct) OVER y', 2)} AS step FROM g_ratios
    WINDOW y AS (PARTITION BY observatory_b, nom_agglomeration, type_habitat, nombre_pieces ORDER BY annee)""")
def win_lag_diff(s: Star):
    by = ["observatory_b", "nom_agglomeration", "type_habitat", "nombre_pieces"]
    before = F.lag("ratio_tension_pct").over(Window.partitionBy(*by).orderBy("annee"))
    return s.ratios.select(*by, "annee", exact_round(F.col("ratio_tension_pct") - before, 2).alias("step"))


@q(f"SELECT code_insee, type_local, annee, {rnd('avg(v) OVER (y ROWS 2 PRECEDING)', 2)} AS smooth FROM {YEARLY} {SERIES}")
def win_moving_avg_3(s: Star):
    return _yearly(s).select(*KEY, exact_round(F.avg("v").over(_years().rowsBetween(-2, 0)), 2).alias("smooth"))


@q(f"""SELECT code_insee, type_local, annee, {rnd('percent_rank() OVER (PARTITION BY annee, type_local ORDER BY n) * 100', 4)} AS volume
    FROM {YEARLY}""")
def win_percent_rank(s: Star):
    ranked = ranking.with_percent_rank(_yearly(s), ["annee", "type_local"], "n", "r")
    return ranked.select(*KEY, exact_round(F.col("r") * 100, 4).alias("volume"))


@q("""SELECT o_orderkey, o_orderpriority, rank() OVER (PARTITION BY o_orderpriority ORDER BY price NULLS LAST)::INT AS place
    FROM (SELECT *, CASE WHEN o_totalprice >= 50000 THEN floor(o_totalprice / 1000)::BIGINT END AS price FROM orders)""")
def win_rank(s: Star):
    """Ascending rank of whole orders, unknown prices last, in five large partitions."""
    price = F.when(F.col("o_totalprice") >= 50_000, F.floor(F.col("o_totalprice") / 1000))
    orders = s.table("orders").select("o_orderkey", "o_orderpriority", price.alias("price"))
    return ranking.with_rank(orders, ["o_orderpriority"], "price", "place").drop("price")


@q("""SELECT DISTINCT ON (o_custkey) o_custkey, year(o_orderdate)::INT AS annee, o_totalprice, o_orderkey FROM orders
    ORDER BY o_custkey, year(o_orderdate) DESC, o_totalprice NULLS LAST, o_orderkey""")
def win_distinct_on(s: Star):
    rows = s.table("orders").select("o_custkey", F.year("o_orderdate").alias("annee"), "o_totalprice", "o_orderkey")
    return relational.keep_first(rows, ["o_custkey"], [F.desc("annee"), F.asc_nulls_last("o_totalprice"), F.col("o_orderkey")])


@q("""SELECT code, name, priority FROM (
        SELECT c_custkey AS code, c_name AS name, 1 AS priority FROM customer WHERE c_acctbal > 5000
        UNION ALL SELECT s_suppkey, s_name, 0 FROM supplier
        UNION ALL SELECT p_partkey, p_name, 2 FROM part)
    QUALIFY row_number() OVER (PARTITION BY code ORDER BY priority, name) = 1""")
def win_keep_first_priority(s: Star):
    sources = (
        s.table("supplier").select(F.col("s_suppkey").alias("code"), F.col("s_name").alias("name")),
        s.table("customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("code"), F.col("c_name").alias("name")),
        s.table("part").select(F.col("p_partkey").alias("code"), F.col("p_name").alias("name")),
    )
    ranked = relational.union_by_name([df.withColumn("priority", F.lit(i)) for i, df in enumerate(sources)])
    return relational.keep_first(ranked, ["code"], [F.col("priority"), F.col("name")])


@q("""SELECT code_insee, type_local, max(annee) AS annee, arg_max(prix_m2_median, annee) AS prix_m2_median,
    arg_max(nb_transactions, annee) AS nb_transactions FROM g_prices GROUP BY ALL""")
def win_latest_row(s: Star):
    return relational.latest_value(s.prices, ["code_insee", "type_local"], "annee", ["prix_m2_median", "nb_transactions"])


@q("""SELECT page, site, page_id FROM (SELECT page_id, regexp_extract(url, '://([^/]+)/', 1) AS site, length(html) AS size,
        regexp_extract(url, '([0-9]+)', 1) AS page FROM pages)
    QUALIFY row_number() OVER (PARTITION BY site ORDER BY size DESC, page_id DESC) = 1""")
def win_latest_version(s: Star):
    """Newest resource per site: page size stands for the date of change."""
    pages = s.table("pages").select(
        "page_id", F.regexp_extract("url", "://([^/]+)/", 1).alias("site"), F.length("html").alias("size"),
        F.regexp_extract("url", "([0-9]+)", 1).alias("page"),
    )
    newest = F.max_by(F.struct("page_id", "page"), F.struct("size", "page_id")).alias("p")
    return pages.groupBy("site").agg(newest).select("site", "p.page_id", "p.page")
