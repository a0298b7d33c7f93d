"""Projections, filters, predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codes
from ..functions.numbers import exact_round
from ..functions.text import contains_folded
from ..operators import relational, validation
from ..plans import silver
from ..sources.starschema import Star
from .base import Section, rnd

QUERIES = q = Section()


@q("SELECT code_insee, nom_commune AS nom_standard, code_departement AS dep_code FROM g_communes")
def project_rename(s: Star):
    return s.communes.select("code_insee", "nom_commune", "code_departement").withColumnsRenamed(
        {"nom_commune": "nom_standard", "code_departement": "dep_code"}
    )


@q("""SELECT code_insee, nom_commune, NULL::VARCHAR AS code_postal, code_departement, NULL::VARCHAR AS region,
    NULL::VARCHAR AS uu2020, reg FROM g_communes""")
def project_schema_align(s: Star):
    partial = s.communes.select("reg", "code_departement", "nom_commune", "code_insee")
    return relational.align(partial, silver.COMMUNE_COLUMNS)


@q("""SELECT code_insee AS "code_insee", nom_commune AS "nom_commune", reg AS "nom_commune_1", reg AS "col_sans_nom_3"
    FROM g_communes""")
def project_column_sanitize(s: Star):
    raw = s.communes.select("code_insee", "nom_commune", "reg", F.col("reg").alias("again"))
    return raw.toDF(*relational.tidy_names([" code/insee", "nom (commune)", "nom_commune", "nan"]))


@q("SELECT code_insee, nom_commune FROM g_communes")
def project_column_candidates(s: Star):
    """The commune column names the code; the label must be another column."""
    raw = s.communes.select(F.col("code_insee").alias(" Commune "), F.col("nom_commune").alias("nom_com"))
    return silver.communes_from_zoning(raw)


@q(f"""SELECT code_insee, annee, {rnd('revenu_median', 2)} AS revenu FROM g_incomes WHERE annee BETWEEN 1995 AND 2001""")
def project_year_named_column(s: Star):
    """One frame per year, its value column named after the year, lifted into one long frame."""
    frames = []
    for year in range(1995, 2002):
        column = f"Q2{year % 100:02d}"
        raw = s.incomes.where(F.col("annee") == year).select(
            F.col("code_insee").alias("CODGEO"), exact_round(F.col("revenu_median"), 2).alias(column)
        )
        frames.append(silver.income_rows(raw, year, column))
    long = relational.union_by_name(frames)
    return long.select("code_insee", "annee", F.col("revenu").cast("double").alias("revenu"))


@q("SELECT o_orderpriority, sum(o_orderkey % 90 + 10)::BIGINT AS observations FROM orders GROUP BY 1")
def project_schema_drift_alias(s: Star):
    orders = s.table("orders").select("o_orderpriority", (F.col("o_orderkey") % 90 + 10).alias("nombre_obsservations"))
    column = relational.require_one_of(orders.columns, silver.OBSERVATION_COLUMNS)
    return orders.groupBy("o_orderpriority").agg(F.sum(column).alias("observations"))


@q("SELECT type_local, count(*) AS n FROM g_sales WHERE nature_mutation = 'Vente' GROUP BY 1")
def filter_equality(s: Star):
    return s.sales.where(F.col("nature_mutation") == "Vente").groupBy("type_local").agg(F.count(F.lit(1)).alias("n"))


@q("""SELECT code_insee, annee, type_local, nombre_pieces, valeur_fonciere FROM g_sales
    WHERE type_local IN ('Maison', 'Appartement')""")
def filter_in_list(s: Star):
    return s.sales.where(F.col("type_local").isin("Maison", "Appartement")).select(
        "code_insee", "annee", "type_local", "nombre_pieces", "valeur_fonciere"
    )


@q("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0 AND c_acctbal IS NOT NULL")
def filter_positive(s: Star):
    return s.table("customer").where((F.col("c_acctbal") > 0) & F.col("c_acctbal").isNotNull()).select("c_custkey", "c_acctbal")


@q("SELECT type_habitat, count(*) AS n FROM g_rents WHERE type_habitat <> 'Ensemble' GROUP BY 1")
def filter_not_equal(s: Star):
    """A missing value is dropped too; raw survey lines miss the type of all housing."""
    return s.rents.withColumn("type_habitat", F.nullif("type_habitat", F.lit("Ensemble"))).where(
        F.col("type_habitat") != "Ensemble"
    ).groupBy("type_habitat").agg(F.count(F.lit(1)).alias("n"))


@q("SELECT annee, count(*) AS n FROM g_sales WHERE annee >= 1999 GROUP BY 1")
def filter_year_floor(s: Star):
    return s.sales.where(F.col("annee") >= 1999).groupBy("annee").agg(F.count(F.lit(1)).alias("n"))


@q("""SELECT nom_agglomeration FROM g_agglos WHERE nom_agglomeration NOT ILIKE '%rural%'
    AND nom_agglomeration NOT ILIKE '%hors%'""")
def filter_not_ilike(s: Star):
    name = F.col("nom_agglomeration")
    return s.agglomerations.where(~name.ilike("%rural%") & ~name.ilike("%hors%")).select(name)


@q("SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority ILIKE '%high%' GROUP BY 1")
def filter_ilike_param(s: Star):
    return s.spark.sql(
        "SELECT o_orderpriority, count(*) AS n FROM {orders} WHERE o_orderpriority ILIKE :pattern GROUP BY 1",
        args={"pattern": "%high%"}, orders=s.table("orders"),
    )


@q("""SELECT code FROM (SELECT CASE WHEN s_acctbal < 3000 THEN '2' || chr(65 + s_nationkey % 3) || lpad(s_suppkey::VARCHAR, greatest(3, length(s_suppkey::VARCHAR))::INT, '0')
        ELSE lpad(s_suppkey::VARCHAR, greatest(5, length(s_suppkey::VARCHAR))::INT, '0') END AS code FROM supplier)
    WHERE regexp_full_match(code, '[0-9]{5}|2[AB][0-9]{3}')""")
def filter_regex_code(s: Star):
    key = F.col("s_suppkey").cast("string")
    corsican = F.concat(F.lit("2"), F.chr((F.col("s_nationkey") % 3 + 65).cast("bigint")), codes.zero_pad(key, 3))
    made = s.table("supplier").select(F.when(F.col("s_acctbal") < 3000, corsican).otherwise(codes.zero_pad(key, 5)).alias("code"))
    return made.where(codes.is_commune_code(F.col("code")))


@q("SELECT p_name, count(*) AS n FROM part WHERE length(p_name) BETWEEN 8 AND 9 GROUP BY 1")
def filter_length_between(s: Star):
    return s.table("part").where(F.length("p_name").between(8, 9)).groupBy("p_name").agg(F.count(F.lit(1)).alias("n"))


NULLED = """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS status,
    CASE WHEN o_totalprice < 100000 THEN NULL ELSE o_totalprice END AS price FROM orders"""


def _nulled(s: Star):
    return s.table("orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(F.col("o_totalprice") >= 100_000, F.col("o_totalprice")).alias("price"),
    )


@q(f"SELECT * FROM ({NULLED}) WHERE status IS NOT NULL AND price IS NOT NULL")
def filter_not_null(s: Star):
    return _nulled(s).where(validation.not_null("status", "price"))


@q(f"SELECT o_orderkey, price FROM ({NULLED}) WHERE price BETWEEN 150000 AND 300000")
def filter_range(s: Star):
    return _nulled(s).where(validation.in_range("price", 150_000, 300_000)).select("o_orderkey", "price")


@q("""SELECT c_custkey, c_nationkey FROM customer
    WHERE c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)""")
def filter_fk_semi(s: Star):
    rich = s.table("supplier").where("s_acctbal > 5000").select("s_nationkey")
    return relational.keep_known(s.table("customer").select("c_custkey", "c_nationkey"), "c_nationkey", rich, "s_nationkey")


@q("SELECT code_insee, reg FROM g_communes WHERE reg = 'EUROPE'")
def filter_optional(s: Star):
    """A department filter that is not given, and a region that is."""
    return validation.where_given(s.communes, {"code_departement": None, "reg": "EUROPE"}).select("code_insee", "reg")


@q("""SELECT doc_id FROM documents WHERE contains(regexp_replace(lower(strip_accents(text)), '[^\\x00-\\x7F]', '', 'g'), 'ere')
    OR contains(regexp_replace(lower(strip_accents(lang)), '[^\\x00-\\x7F]', '', 'g'), 'ere')""")
def filter_accent_insensitive(s: Star):
    found = contains_folded(F.col("text"), "ÈRE") | contains_folded(F.col("lang"), "ÈRE")
    return s.table("documents").where(found).select("doc_id")


@q(f"""WITH checked AS (SELECT *, status IS NOT NULL AS a, coalesce(price BETWEEN 150000 AND 300000, false) AS b,
        o_orderkey >= 100 AS c FROM ({NULLED}))
    SELECT 'orders' AS source, 'status' AS rule, count(*) FILTER (NOT a) AS rejected FROM checked
    UNION ALL SELECT 'orders', 'price', count(*) FILTER (a AND NOT b) FROM checked
    UNION ALL SELECT 'orders', 'key', count(*) FILTER (a AND b AND NOT c) FROM checked""")
def reject_report(s: Star):
    rules = {
        "status": validation.not_null("status"),
        "price": validation.in_range("price", 150_000, 300_000),
        "key": validation.in_range("o_orderkey", 100),
    }
    return validation.reject_report(_nulled(s), rules, "orders")
