"""Scalar functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codes, numbers, text
from ..functions.similarity import best_of
from ..plans.dashboard import ad_hoc
from ..plans.marts import income_profiles
from ..plans.silver import sale_rows
from ..sources.starschema import Star, agglomeration_name
from .base import AGGLO, Section, bare, pad, rnd, scored, sid

QUERIES = q = Section()

CORSICA = "CASE WHEN s_nationkey < 5 THEN '2A' WHEN s_nationkey < 10 THEN '2B' ELSE s_nationkey::VARCHAR END"


def _suppliers(s: Star):
    nation = F.col("s_nationkey")
    return s.table("supplier").withColumn(
        "dep", F.when(nation < 5, "2A").when(nation < 10, "2B").otherwise(nation.cast("string"))
    ).withColumn("com", F.col("s_suppkey").cast("string"))


@q("SELECT c_custkey, trim(upper('  ' || c_mktsegment || ' ')) AS label FROM customer")
def str_trim_upper(s: Star):
    raw = F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" "))
    return s.table("customer").select("c_custkey", text.trim_upper(raw).alias("label"))


@q("SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'Ensemble' ELSE o_orderstatus END AS habitat FROM orders")
def str_coalesce_default(s: Star):
    raw = F.concat(F.lit(" "), F.nullif("o_orderstatus", F.lit("P")))
    return s.table("orders").select("o_orderkey", text.or_default(raw, "Ensemble").alias("habitat"))


@q(f"SELECT c_custkey, 'B' || {pad('c_nationkey', 2)} AS code FROM customer")
def str_clean_obs_code(s: Star):
    """Non-breaking and inner spaces, full-width digits of a float, lower case."""
    nation = F.translate(codes.zero_pad(F.col("c_nationkey").cast("string"), 2), "0123456789", "０１２３４５６７８９")
    raw = F.concat(F.lit(" b "), nation, F.lit(".0"))
    return s.table("customer").select("c_custkey", text.clean_observatory_code(raw).alias("code"))


@q("SELECT c_custkey, c_mktsegment || ' ' || c_name AS label FROM customer")
def str_clean_text(s: Star):
    raw = F.concat(F.lit("  "), "c_mktsegment", F.lit("   \u0007"), "c_name", F.lit("\u0085 "))
    return s.table("customer").select("c_custkey", text.clean_label(raw).alias("label"))


@q(f"SELECT s_suppkey, {pad(CORSICA, 2)} || {pad('s_suppkey', 3)} AS code FROM supplier")
def str_compose_code(s: Star):
    return _suppliers(s).select("s_suppkey", codes.commune_code(F.col("dep"), F.col("com")).alias("code"))


@q(f"SELECT o_orderkey, {pad('o_orderkey * 37', 5)} AS code FROM orders")
def str_zfill(s: Star):
    return s.table("orders").select("o_orderkey", codes.zero_pad((F.col("o_orderkey") * 37).cast("string"), 5).alias("code"))


@q(f"SELECT p_partkey, nullif({pad('p_partkey * 13', 5)}, '00000') AS cp FROM part WHERE p_size > 10 UNION ALL SELECT p_partkey, NULL FROM part WHERE p_size <= 10")
def str_postcode(s: Star):
    number = (F.col("p_partkey") * 13).cast("double").cast("string")
    raw = F.when(F.col("p_size") > 10, number).when(F.col("p_size") > 5, "inconnu").otherwise("nan")
    return s.table("part").select("p_partkey", codes.postal_code(raw).alias("cp"))


@q("SELECT o_orderkey, CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS label FROM orders")
def str_null_token(s: Star):
    raw = F.when(F.col("o_orderstatus") == "O", "nan").otherwise(F.col("o_orderpriority"))
    return s.table("orders").select("o_orderkey", text.null_token(raw).alias("label"))


@q(f"""SELECT code, CASE WHEN code LIKE '751__' THEN '75056' WHEN code LIKE '6938_' THEN '69123'
        WHEN code LIKE '132__' AND code >= '13201' THEN '13055' ELSE code END AS city
    FROM (SELECT DISTINCT {pad('l_orderkey', 5)} AS code FROM lineitem UNION
          SELECT DISTINCT ((ARRAY[75100, 69380, 13195])[(1 + l_orderkey % 3)::INT] + l_orderkey % 30)::VARCHAR FROM lineitem)""")
def str_district_rollup(s: Star):
    key = F.col("l_orderkey")
    base = F.element_at(F.array(*map(F.lit, (75100, 69380, 13195))), (key % 3 + 1).cast("int"))
    orders = s.table("lineitem").select("l_orderkey").distinct()
    made = orders.select(codes.zero_pad(key.cast("string"), 5).alias("code")).union(
        orders.select((base + key % 30).cast("string"))
    ).distinct()
    return made.select("code", codes.merge_districts(F.col("code")).alias("city"))


@q("SELECT o_orderkey, substr(o_orderpriority, 1, 1) || 'P' || CASE WHEN o_orderpriority > '4' THEN '+' ELSE '' END AS rooms FROM orders")
def str_regex_suffix(s: Star):
    first = F.concat(F.substring("o_orderpriority", 1, 1), F.lit("P"))
    raw = F.when(F.col("o_orderpriority") > "4", F.concat(first, F.lit("  et plus "))).otherwise(first)
    return s.table("orders").select("o_orderkey", text.rooms_label(raw).alias("rooms"))


@q(f"SELECT nom_agglomeration, {bare('nom_agglomeration')} AS bare FROM g_agglos")
def str_strip_prefixes(s: Star):
    return s.agglomerations.select("nom_agglomeration", text.bare_name(F.col("nom_agglomeration")).alias("bare"))


@q("SELECT nom_agglomeration, trim(regexp_replace(nom_agglomeration, 'Agglomération (de |d''|du |des |)', '', 'g')) AS city FROM g_agglos")
def str_city_from_name(s: Star):
    return s.agglomerations.select("nom_agglomeration", text.city_of(F.col("nom_agglomeration")).alias("city"))


@q("""SELECT page_id, CASE WHEN length(n) = 4 THEN 'B' || n END AS code
    FROM (SELECT page_id, (page_id * 17 + 800)::VARCHAR AS n FROM pages)""")
def str_regex_extract(s: Star):
    """Archive names; only four-digit numbers are observatory codes."""
    name = F.concat(F.lit("base_L"), (F.col("page_id") * 17 + 800).cast("string"), F.lit(".ZIP"))
    return s.table("pages").select("page_id", text.zoning_code(name).alias("code"))


@q("SELECT doc_id, coalesce(contains(lower(CASE WHEN lang <> 'de' THEN text END), 'the'), false) AS found FROM documents")
def str_contains_ci(s: Star):
    docs = s.table("documents")
    known = F.when(F.col("lang") != "de", F.col("text"))
    return docs.select("doc_id", text.contains_ignore_case(known, F.lit("THE")).alias("found"))


@q(f"SELECT c_custkey, {sid('c_name')} AS id FROM customer UNION ALL SELECT -1 - c_nationkey, {sid('nom')} FROM (SELECT DISTINCT c_nationkey, {AGGLO} AS nom FROM g_customers WHERE c_mktsegment = 'HOUSEHOLD')")
def str_stable_id(s: Star):
    plain = s.table("customer").select("c_custkey", codes.stable_id(F.col("c_name")).alias("id"))
    names = s.customers.where("c_mktsegment = 'HOUSEHOLD'").select("c_nationkey", agglomeration_name().alias("nom")).distinct()
    accented = names.select((-1 - F.col("c_nationkey")).cast("bigint").alias("c_custkey"), codes.stable_id(F.col("nom")).alias("id"))
    return plain.union(accented)


@q(f"SELECT a, b, score FROM ({scored('SELECT DISTINCT p_name AS a, lower(p_type) AS b FROM part')})")
def str_partial_ratio(s: Star):
    pairs = s.table("part").select(F.col("p_name").alias("a"), F.lower("p_type").alias("b")).distinct()
    return pairs.select("a", "b", best_of("a", F.array("b"))["score"].alias("score"))


@q("SELECT annee, count(*) AS n FROM (SELECT CASE WHEN l_linenumber < 7 THEN year(l_shipdate)::INT END AS annee FROM lineitem) GROUP BY 1")
def date_parse_year(s: Star):
    """Year of a text date; impossible dates have none."""
    day = F.when(F.col("l_linenumber") < 7, F.date_format("l_shipdate", "dd/MM/yyyy")).otherwise("31/02/2000")
    return s.table("lineitem").groupBy(numbers.year_of(day).alias("annee")).agg(F.count(F.lit(1)).alias("n"))


@q("SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price FROM orders")
def num_decimal_comma(s: Star):
    raw = F.replace(F.format_string("%.2f", "o_totalprice"), F.lit("."), F.lit(","))
    bad = F.concat(raw, F.lit(" EUR"))
    return s.table("orders").select(
        "o_orderkey", numbers.to_number(F.when(F.col("o_orderstatus") == "P", bad).otherwise(raw)).alias("price")
    )


@q("SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS income FROM customer")
def num_secret_to_null(s: Star):
    raw = F.when(F.col("c_acctbal") < 0, "s").otherwise(F.format_string("%.2f", "c_acctbal"))
    return s.table("customer").select("c_custkey", numbers.secret_to_null(raw).alias("income"))


@q(f"SELECT type_local, nombre_pieces, {rnd('avg(prix_m2)', 3)} AS prix, {rnd('max(prix_m2)', 3)} AS haut FROM g_sales GROUP BY ALL")
def num_ratio_price_area(s: Star):
    price = numbers.ratio(F.col("valeur_fonciere"), F.col("surface_bati"))
    return s.sales.groupBy("type_local", "nombre_pieces").agg(
        numbers.exact_round(F.avg(price), 3).alias("prix"), numbers.exact_round(F.max(price), 3).alias("haut")
    )


@q(f"SELECT code_insee, annee, {rnd('revenu_median / 12', 2)} AS mois FROM g_incomes")
def num_annual_to_month(s: Star):
    return s.incomes.select("code_insee", "annee", numbers.exact_round(F.col("revenu_median") / 12, 2).alias("mois"))


@q(f"SELECT c_custkey, {rnd('c_acctbal / nullif(c_nationkey, 0)', 4)} AS share FROM customer")
def num_safe_div(s: Star):
    return s.table("customer").select(
        "c_custkey", numbers.exact_round(numbers.ratio(F.col("c_acctbal"), F.col("c_nationkey")), 4).alias("share")
    )


@q(f"SELECT observatory_b, annee, {rnd('d9 / nullif(d1, 0)', 2)} AS ratio_d9_d1 FROM g_profiles")
def num_interdecile(s: Star):
    return income_profiles(s.incomes, s.bridge).select(
        "observatory_b", "annee", numbers.exact_round(numbers.ratio(F.col("d9"), F.col("d1")), 2).alias("ratio_d9_d1")
    )


@q("""SELECT observatory_b, nom_agglomeration, annee, type_habitat, taux_effort_modeste_pct, taux_effort_median_pct,
    taux_effort_aise_pct, part_loyer_annuel_pct FROM g_ineg""")
def num_effort_rates(s: Star):
    return s.inequality.select(
        "observatory_b", "nom_agglomeration", "annee", "type_habitat", "taux_effort_modeste_pct", "taux_effort_median_pct",
        "taux_effort_aise_pct", "part_loyer_annuel_pct",
    )


@q(f"SELECT nom_agglomeration, annee, type_habitat, nombre_pieces, {rnd('loyer_mensuel_median / 650000 * 100', 1)} AS effort FROM g_ratios")
def num_effort_user(s: Star):
    return ad_hoc(
        s.spark,
        "SELECT nom_agglomeration, annee, type_habitat, nombre_pieces,"
        " cast(round(cast(loyer_mensuel_median / :revenu * 100 AS decimal(38,6)), 1) AS double) AS effort FROM {ratios}",
        {"ratios": s.ratios}, revenu=650_000.0,
    )


@q("SELECT code_insee, annee, type_local, coalesce(least(greatest(hausse_prix_pct, 0), 20), 0) / 20 * 100 AS rise FROM g_rising")
def num_clamp(s: Star):
    return s.tension.select("code_insee", "annee", "type_local", numbers.rise_score(F.col("hausse_prix_pct")).alias("rise"))


@q("SELECT c_custkey, coalesce(CASE WHEN c_acctbal > 0 THEN c_acctbal END, 50) AS volume FROM customer")
def num_coalesce_default(s: Star):
    known = F.when(F.col("c_acctbal") > 0, F.col("c_acctbal"))
    return s.table("customer").select("c_custkey", F.coalesce(known, F.lit(numbers.DEFAULT_VOLUME)).alias("volume"))


@q(f"SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, {rnd('l_extendedprice / l_quantity', 1)} AS prix, {rnd('l_tax * l_discount', 3)} AS t FROM lineitem")
def num_round(s: Star):
    return s.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
        numbers.exact_round(F.col("l_extendedprice") / F.col("l_quantity"), 1).alias("prix"),
        numbers.exact_round(F.col("l_tax") * F.col("l_discount"), 3).alias("t"),
    )


@q(f"""SELECT o_orderkey, {rnd('''CASE WHEN ratio IS NULL THEN least(greatest(rise, 0), 20) * 3.0 + volume * 0.4
    ELSE least(ratio, 100) * 0.4 + least(greatest(rise, 0), 20) * 1.75 + volume * 0.25 END''', 1)} AS score
    FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 2000 END AS ratio,
          coalesce(CASE WHEN o_orderstatus <> 'F' THEN o_custkey % 31 - 5 END, 0) AS rise,
          coalesce(CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey % 101 END, 50) AS volume FROM orders)""")
def num_weighted_score(s: Star):
    """All mixes of known and unknown signals."""
    status, known = F.col("o_orderstatus"), s.table("orders")
    score = numbers.tension_score(
        F.when(status != "P", F.col("o_totalprice") / 2000),
        F.when(status != "F", (F.col("o_custkey") % 31 - 5).cast("double")),
        F.when(F.col("o_orderpriority") != "5-LOW", (F.col("o_orderkey") % 101).cast("double")),
    )
    return known.select("o_orderkey", numbers.exact_round(score, 1).alias("score"))


@q("""SELECT o_orderkey, CASE WHEN s >= 75 THEN 'Très tendu' WHEN s >= 50 THEN 'Tendu' WHEN s >= 25 THEN 'Modéré' ELSE 'Détendu' END AS band
    FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderkey % 101 END AS s FROM orders)""")
def cond_category(s: Star):
    score = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey") % 101)
    return s.table("orders").select("o_orderkey", numbers.tension_band(score).alias("band"))


@q("""SELECT o_orderkey, CASE WHEN s < 33 THEN '🟢 Accessible' WHEN s < 50 THEN '🟡 Tendu' ELSE '🔴 Difficile' END AS band
    FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderkey % 101 END AS s FROM orders)""")
def cond_access_band(s: Star):
    effort = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey") % 101)
    return s.table("orders").select("o_orderkey", numbers.access_band(effort).alias("band"))


@q("SELECT code_insee, count(*) AS n FROM g_sales WHERE nature_mutation = 'Vente' AND type_local <> 'Local industriel' GROUP BY 1")
def udf_row_apply(s: Star):
    """Codes composed from two columns of every raw sale, without a function per row."""
    return sale_rows(s.raw_sales).groupBy("code_insee").agg(F.count(F.lit(1)).alias("n"))


@q(f"""SELECT 'B' || {pad('n_nationkey', 2)} AS observatory, nom AS name, {sid('nom')} AS id FROM
    (SELECT DISTINCT n_nationkey, {AGGLO} AS nom FROM orders JOIN g_customers ON c_custkey = o_custkey)""")
def udf_scalar_apply(s: Star):
    """The cleaning functions over distinct raw labels."""
    raw = s.raw_rents.select("Observatory", "agglomeration").distinct()
    name = text.clean_label(F.col("agglomeration"))
    cleaned = raw.select(text.clean_observatory_code(F.col("Observatory")).alias("observatory"), name.alias("name"))
    return cleaned.distinct().withColumn("id", codes.stable_id(F.col("name")))


@q("""SELECT annee, count(*) FILTER (evolution_ratio > 0) AS rising, count(*) FILTER (evolution_ratio <= 0) AS falling
    FROM g_trend GROUP BY 1""")
def model_ref(s: Star):
    """A query on a mart that is itself built from another mart."""
    return ad_hoc(
        s.spark,
        "SELECT annee, count_if(evolution_ratio > 0) AS rising, count_if(evolution_ratio <= 0) AS falling FROM {trend} GROUP BY annee",
        {"trend": s.trend},
    )
