"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import exact_round
from ..operators.relational import union_by_name
from ..plans import marts
from ..plans.dashboard import ad_hoc
from ..session import shared_folder
from ..sources import readers, sinks
from ..sources.keyed import KeyedTable
from ..sources.starschema import YEAR_FLOOR, Star, code5
from .base import Section, pad, rnd

QUERIES = q = Section()
#: Buckets of the keyed tables.
BUCKETS = 8

SALES_BY_YEAR = f"""SELECT annee, type_local, count(*) AS n, {rnd('sum(valeur_fonciere)', 2)} AS total
    FROM g_sales GROUP BY ALL"""


def _by_year(df):
    return df.groupBy("annee", "type_local").agg(
        F.count(F.lit(1)).alias("n"), exact_round(F.sum("valeur_fonciere"), 2).alias("total")
    )


@q("SELECT * FROM customer")
def scan_parquet(s: Star):
    return s.table("customer")


@q(SALES_BY_YEAR)
def scan_hive_partitioned(s: Star):
    path = shared_folder(s.spark, "sales")
    sinks.replace_partitions(s.sales, path)
    return _by_year(readers.read_years(s.spark, path))


@q("""SELECT DISTINCT annee FROM (SELECT annee FROM g_sales UNION ALL SELECT annee FROM g_rents
    UNION ALL SELECT annee FROM g_incomes)""")
def detect_years(s: Star):
    """Years of three sources landed by year, from the folders' names; the sale types stand for folders that are no year."""
    path = shared_folder(s.spark, "landed")
    not_years = s.sales.select(F.col("type_local").alias("annee")).distinct()
    for name, source in {"sales": s.sales, "rents": s.rents, "incomes": s.incomes}.items():
        years = source.select(F.col("annee").cast("string")).distinct().union(not_years)
        years.withColumn("landed", F.lit(True)).write.partitionBy("annee").parquet(f"{path}/{name}")
    return readers.years_in_folder(s.spark, path)


@q("SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL")
def scan_column_pruned(s: Star):
    return s.table("orders").select("o_orderpriority").where("o_orderpriority is not null").distinct()


@q("SELECT code_insee, nom_commune, code_departement, reg FROM g_communes")
def scan_csv_delims(s: Star):
    """The same commune rows through three delimiters, joined again."""
    parts = {"|": ["code_insee", "nom_commune"], ";": ["code_insee", "code_departement"], ",": ["code_insee", "reg"]}
    frames = []
    for sep, columns in parts.items():
        path = shared_folder(s.spark, "csv")
        s.communes.select(*columns).write.csv(path, sep=sep, header=True)
        frames.append(readers.read_delimited(s.spark, path, sep))
    return frames[0].join(frames[1], "code_insee").join(frames[2], "code_insee")


@q("SELECT nom_agglomeration, id_agglomeration::VARCHAR AS id_agglomeration FROM g_agglos")
def scan_csv_encoding(s: Star):
    path = shared_folder(s.spark, "latin")
    s.agglomerations.write.csv(path, sep=";", header=True, encoding="ISO-8859-1")
    return readers.read_delimited(s.spark, path, ";", readers.fitting_encoding(s.spark, path))


@q("""SELECT code_insee AS "INSEE", nom_commune AS "LIB_COM", NULL::VARCHAR AS "CODE_INSEE", 'B01' AS observatory_b,
        true AS tagged FROM g_communes
    UNION ALL SELECT NULL, NULL, code_insee, 'B01', true FROM g_communes""")
def scan_union_files_tagged(s: Star):
    """Two zoning files of one observatory with different columns."""
    one, two = shared_folder(s.spark, "zoning"), shared_folder(s.spark, "zoning")
    s.communes.select(F.col("code_insee").alias(" INSEE "), F.col("nom_commune").alias("LIB COM")).write.csv(one, sep=";", header=True)
    s.communes.select(F.col("code_insee").alias("CODE/INSEE")).write.csv(two, sep=";", header=True)
    read = readers.read_zoning(s.spark, [one, two], "B01")
    return read.select("INSEE", "LIB_COM", "CODE_INSEE", "observatory_b", F.col("source_file").endswith(".csv").alias("tagged"))


@q("""SELECT l_returnflag, count(*) AS n, count(DISTINCT l_suppkey) AS communes FROM lineitem
    WHERE l_linestatus = 'O' AND l_returnflag IN ('A', 'R') AND l_quantity > 0 AND l_extendedprice IS NOT NULL
    AND l_extendedprice > 0 GROUP BY 1""")
def scan_filter_pushdown(s: Star):
    kept = s.table("lineitem").where(
        (F.col("l_linestatus") == "O") & F.col("l_returnflag").isin("A", "R") & (F.col("l_quantity") > 0)
        & F.col("l_extendedprice").isNotNull() & (F.col("l_extendedprice") > 0)
    )
    return kept.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("l_suppkey").alias("communes"))


@q("SELECT DISTINCT code_insee, type_local FROM g_sales")
def scan_distinct_projection(s: Star):
    return s.sales.select("code_insee", "type_local").distinct()


@q("""SELECT code_insee, count(*) AS n FROM g_sales WHERE type_local = 'Maison' AND annee >= 1998 GROUP BY 1""")
def scan_ad_hoc_sql(s: Star):
    text = "SELECT code_insee, count(*) AS n FROM {sales} WHERE type_local = :kind AND annee >= :since GROUP BY 1"
    return ad_hoc(s.spark, text, {"sales": s.sales}, kind="Maison", since=1998)


@q("SELECT * FROM g_communes")
def sink_parquet(s: Star):
    path = shared_folder(s.spark, "communes")
    sinks.write_parquet(s.communes, path)
    return s.spark.read.parquet(path)


@q(f"SELECT code_insee, annee, {rnd('revenu_median', 2)} AS revenu_median FROM g_incomes")
def sink_truncate_load(s: Star):
    """A first content is wholly replaced by the second, which is complete before it shows."""
    folder = shared_folder(s.spark, "incomes")
    old = s.incomes.select(F.concat(F.lit("X"), F.col("code_insee")).alias("code_insee"), F.col("annee") + 500, "revenu_median")
    columns = ["code_insee", "annee", "revenu_median"]
    sinks.publish(old.toDF(*columns), "parcelle_incomes", folder)
    sinks.publish(s.incomes.select(*columns), "parcelle_incomes", folder)
    return s.spark.table("parcelle_incomes").select(
        "code_insee", "annee", exact_round(F.col("revenu_median"), 2).alias("revenu_median")
    )


@q("""SELECT code_insee, nom_commune, false AS fresh FROM g_communes WHERE reg <> 'ASIA'
    UNION ALL SELECT code_insee, upper(nom_commune), true FROM g_communes WHERE reg = 'ASIA'""")
def sink_insert_ignore(s: Star):
    old = s.communes.where("reg <> 'ASIA'").select("code_insee", "nom_commune", F.lit(False).alias("fresh"))
    new = s.communes.select("code_insee", F.upper("nom_commune").alias("nom_commune"), F.lit(True).alias("fresh"))
    table = KeyedTable(s.spark, shared_folder(s.spark, "keyed"), old.schema, ["code_insee"], BUCKETS)
    table.insert_ignore(old)
    table.insert_ignore(new)
    return table.read()


@q(f"""SELECT coalesce(o.code_insee, n.code_insee) AS code_insee, coalesce(o.name, n.name) AS name,
        CASE WHEN n.code_insee IS NULL THEN o.score ELSE n.score END AS score
    FROM (SELECT {pad('s_suppkey', 5)} AS code_insee, s_name AS name, s_acctbal AS score FROM supplier) o
    FULL JOIN (SELECT CASE WHEN code_insee[5] IN ('0', '5') THEN 'N' || code_insee ELSE code_insee END AS code_insee, 'from sales' AS name,
               max(valeur_fonciere) AS score FROM g_sales GROUP BY ALL) n ON o.code_insee = n.code_insee""")
def sink_upsert_update(s: Star):
    """Keys on one side only and on both: every fifth commune of the sales has a new code."""
    old = s.table("supplier").select(
        code5(F.col("s_suppkey")).alias("code_insee"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("score")
    )
    code = F.when(F.col("code_insee").rlike("^.{4}[05]"), F.concat(F.lit("N"), "code_insee")).otherwise(F.col("code_insee"))
    new = s.sales.groupBy(code.alias("code_insee")).agg(F.max("valeur_fonciere").alias("score")).withColumn("name", F.lit("from sales"))
    table = KeyedTable(s.spark, shared_folder(s.spark, "keyed"), old.schema, ["code_insee"], BUCKETS)
    table.insert_ignore(old)
    table.upsert(new, keep=["name"])
    return table.read()


@q("SELECT code_insee, reg FROM g_communes")
def sink_replace_table(s: Star):
    """A table recreated with other columns."""
    path = shared_folder(s.spark, "table")
    sinks.replace_table(s.communes, "parcelle_communes", path)
    sinks.replace_table(s.communes.select("code_insee", "reg"), "parcelle_communes", f"{path}-2")
    return s.spark.table("parcelle_communes")


GOLD = {"prix_m2_par_ville": ("g_prices", "nb_transactions"), "ratio_loyer_revenu": ("g_ratios", "ratio_tension_pct"),
        "dynamisme_marche": ("g_tension", "score_tension"), "evolution_tension": ("g_trend", "evolution_ratio"),
        "inegalites": ("g_inequality", "rang_accessibilite_modeste")}


@q(" UNION ALL ".join(
    f"SELECT '{mart}' AS mart, count(*) AS n, count({c}) AS known, {rnd(f'sum({c})', 1)} AS total FROM {part}" for mart, (part, c) in GOLD.items()))
def gold_materialize(s: Star):
    """The five marts written in the order of their needs, each read back by those that follow."""
    marts.write_marts(s.sales, s.communes, s.rents, s.incomes, s.bridge, s.agglomerations, "gold", shared_folder(s.spark, "gold"), year_floor=YEAR_FLOOR)
    return union_by_name([
        s.spark.table(f"gold.{mart}").agg(
            F.lit(mart).alias("mart"), F.count(F.lit(1)).alias("n"), F.count(c).alias("known"), exact_round(F.sum(c), 1).alias("total"))
        for mart, (_, c) in GOLD.items()
    ])
