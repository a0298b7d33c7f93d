"""Quality checks and the run ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.relational import union_by_name
from ..plans import ledger, quality
from ..session import shared_folder
from ..sources import readers, sinks
from ..sources.starschema import Star
from .base import SOURCE, Section

QUERIES = q = Section()

LEDGER = f"""(SELECT {SOURCE} AS source, CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'error' ELSE 'running' END AS status,
    CASE WHEN o_orderstatus = 'F' THEN o_orderkey END AS rows_loaded, o_orderdate AS started_at,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS finished_at FROM orders JOIN customer ON c_custkey = o_custkey)"""


def _rows(table: str, tests: list[tuple[str, str, str]], source: str) -> str:
    """Report rows (rule, column, count expression) over one table."""
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{column}' AS column_name, ({count})::BIGINT AS failures FROM {source}"
        for rule, column, count in tests
    )


def _repeats(column: str, source: str) -> str:
    return f"(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1))"


@q("SELECT 'orders' AS modele, count(*) AS nb FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'none', count(*) FROM orders WHERE o_totalprice < 0")
def dq_row_count_min(s: Star):
    orders = s.table("orders")
    return quality.row_counts({"orders": orders, "lineitem": s.table("lineitem"), "none": orders.where("o_totalprice < 0")})


@q(_rows("rents", [("not_null", "Type_habitat", "count(*) FILTER (o_orderstatus = 'P')"),
                   ("not_null", "nombre_pieces_homogene", "count(*) FILTER (o_orderpriority = '5-LOW')"),
                   ("not_null", "Observatory", "count(*) FILTER (false)")], "orders"))
def dq_not_null(s: Star):
    return quality.null_violations(s.raw_rents, "rents", ["Type_habitat", "nombre_pieces_homogene", "Observatory"])


@q(_rows("sales", [("between", "prix_m2", "count(*) FILTER (prix_m2 NOT BETWEEN 500 AND 1500)"),
                   ("between", "annee", "count(*) FILTER (annee NOT BETWEEN 1996 AND 2000)")], "g_sales"))
def dq_between(s: Star):
    return quality.range_violations(s.sales, "sales", {"prix_m2": (500, 1500), "annee": (1996, 2000)})


@q("SELECT o_custkey, annee, count(*) AS n FROM (SELECT o_custkey, year(o_orderdate)::INT AS annee FROM orders) GROUP BY ALL HAVING count(*) > 1")
def dq_unique(s: Star):
    keys = s.table("orders").select("o_custkey", F.year("o_orderdate").alias("annee"))
    return quality.duplicate_keys(keys, ["o_custkey", "annee"])


def _tables(s: Star) -> dict:
    return {
        "fact_loyers": s.rents, "fact_revenus": s.incomes, "fact_transactions": s.sales, "dim_commune": s.communes,
        "dim_agglomeration": s.agglomerations, "dim_observatoire": s.observatories,
        "dim_temps": s.sales.select("annee").distinct(), "dim_type_bien": s.sales.select(F.col("type_local").alias("type_bien")).distinct(),
        "bridge_commune_observatoire": s.bridge, "mapping_uu_agglomeration": s.mapping,
    }


@q("""SELECT 'fact_loyers' AS table_name, 'in dim_agglomeration' AS rule, 'id_agglomeration' AS column_name,
        count(*) AS failures FROM g_rents WHERE id_agglomeration NOT IN (SELECT id_agglomeration FROM g_agglos)
    UNION ALL SELECT 'fact_loyers', 'in dim_observatoire', 'observatory_b', count(*) FROM g_rents WHERE observatory_b NOT IN (SELECT observatory_b FROM g_obs)
    UNION ALL SELECT 'fact_revenus', 'in dim_commune', 'code_insee', count(*) FROM g_incomes WHERE code_insee NOT IN (SELECT code_insee FROM g_communes WHERE reg <> 'ASIA')
    UNION ALL SELECT 'fact_transactions', 'in dim_commune', 'code_insee', count(*) FROM g_sales WHERE code_insee NOT IN (SELECT code_insee FROM g_communes WHERE reg <> 'ASIA')
    UNION ALL SELECT 'bridge_commune_observatoire', 'in dim_commune', 'code_insee', count(*) FROM g_bridge WHERE code_insee NOT IN (SELECT code_insee FROM g_communes WHERE reg <> 'ASIA')
    UNION ALL SELECT 'bridge_commune_observatoire', 'in dim_observatoire', 'observatory_b', count(*) FROM g_bridge WHERE observatory_b NOT IN (SELECT observatory_b FROM g_obs)
    UNION ALL SELECT 'mapping_uu_agglomeration', 'in dim_agglomeration', 'id_agglomeration', count(*) FROM g_towns WHERE id_agglomeration NOT IN (SELECT id_agglomeration FROM g_agglos)""")
def dq_foreign_keys(s: Star):
    """Seven key pairs, with one region missing from the commune dimension."""
    tables = {**_tables(s), "dim_commune": s.communes.where("reg <> 'ASIA'")}
    return quality.check_foreign_keys(tables)


def _table_rules() -> str:
    sources = {
        "fact_loyers": "g_rents", "fact_revenus": "g_incomes", "fact_transactions": "g_sales", "dim_commune": "g_communes",
        "dim_agglomeration": "g_agglos", "dim_observatoire": "g_obs", "dim_temps": "(SELECT DISTINCT annee FROM g_sales)",
        "dim_type_bien": "(SELECT DISTINCT type_local AS type_bien FROM g_sales)", "bridge_commune_observatoire": "g_bridge",
        "mapping_uu_agglomeration": "g_mapping",
    }
    texts = []
    for table, source in sources.items():
        rules = quality.SILVER_RULES[table]
        tests = [("row_count", "*", f"greatest({rules.min_rows} - count(*), 0)")]
        tests += [("not_null", c, f"count(*) FILTER ({c} IS NULL)") for c in rules.not_null]
        tests += [("between", c, f"count(*) FILTER ({c} NOT BETWEEN {lo} AND {hi})") for c, (lo, hi) in rules.between.items()]
        texts.append(_rows(table, tests, source))
        texts += [
            f"SELECT '{table}', 'unique', '{c}', {_repeats(c, source)}::BIGINT" for c in rules.unique
        ]
    return " UNION ALL ".join(texts)


@q(_table_rules())
def dq_table_rules(s: Star):
    return quality.check_tables(_tables(s) | {"mapping_uu_agglomeration": s.silver("mapping")}, quality.SILVER_RULES)


@q("""SELECT r_name AS file_name, count(code_insee) AS row_count, count(code_insee) > 0 AS usable
    FROM region LEFT JOIN g_communes ON reg = r_name GROUP BY 1 UNION ALL SELECT 'ABSENT', 0, false""")
def dq_bronze_nonempty(s: Star):
    """One folder of files per region landed; an expected one that never arrived is reported."""
    path = shared_folder(s.spark, "bronze")
    s.communes.withColumn("folder", F.col("reg")).write.partitionBy("folder").parquet(path)
    expected = s.table("region").select(F.col("r_name").alias("file_name")).union(s.spark.range(1).select(F.lit("ABSENT")))
    folder = F.url_decode(F.regexp_extract("_metadata.file_path", "folder=([^/]+)/", 1))
    return readers.file_report(s.spark, path, expected, folder)


@q("""SELECT 'zoning ' || r_name AS source, count(code_insee) > 0 AS present, count(code_insee) > 0 AS usable
    FROM region LEFT JOIN g_communes ON reg = r_name GROUP BY r_name
    UNION ALL SELECT 'archive', true, true UNION ALL SELECT 'empty', true, false UNION ALL SELECT 'ABSENT', false, false""")
def dq_source_files(s: Star):
    """Zoning text by region, a compressed archive and an empty file landed; one expected source never arrived."""
    path = shared_folder(s.spark, "landed")
    folders = s.communes.select(F.concat_ws(";", "code_insee", "nom_commune").alias("line"), F.concat(F.lit("zoning "), "reg").alias("source"))
    folders.write.partitionBy("source").text(f"{path}/zoning")
    s.units.select(F.concat_ws(";", "uu2020", "nom_uu")).coalesce(1).write.option("compression", "gzip").text(f"{path}/archive")
    s.units.select("nom_uu").where("false").coalesce(1).write.text(f"{path}/empty")
    names = s.table("region").select(F.concat(F.lit("zoning "), "r_name").alias("source"))
    zoning = names.withColumn("source", F.concat(F.lit("source="), "source"))
    others = s.spark.createDataFrame([("archive",), ("empty",), ("ABSENT",)], "source string")
    found = readers.source_report(s.spark, f"{path}/zoning", zoning).withColumn("source", F.substring_index("source", "=", -1))
    found = found.unionByName(readers.source_report(s.spark, path, others))
    return found.select("source", (F.col("files") > 0).alias("present"), "usable")


@q("""SELECT annee, count(*) AS n, NULL::VARCHAR AS categorie_tension
    FROM g_prices WHERE annee NOT IN (2021, 2022, 2023, 2024, 2025) GROUP BY 1
    UNION ALL SELECT NULL, count(*), categorie_tension
    FROM g_tension WHERE categorie_tension NOT IN ('Très tendu', 'Tendu', 'Modéré', 'Détendu') GROUP BY 3""")
def dq_accepted_values(s: Star):
    """Years of the price mart and bands of the tension mart."""
    return quality.unexpected_mart_values(s.gold.prices, s.gold.tension)


GOLD = {"prix_m2_par_ville": "g_prices", "ratio_loyer_revenu": "g_ratios", "dynamisme_marche": "g_tension",
        "evolution_tension": "g_trend", "inegalites": "g_inequality"}


@q(" UNION ALL ".join(
    _rows(m, [("not_null", c, f"count(*) FILTER ({c} IS NULL)") for c in columns], GOLD[m])
    for m, columns in quality.GOLD_NOT_NULL.items()))
def dq_gold_not_null(s: Star):
    frames = {"prix_m2_par_ville": s.gold.prices, "ratio_loyer_revenu": s.gold.ratios, "dynamisme_marche": s.gold.tension,
              "evolution_tension": s.gold.trend, "inegalites": s.gold.inequality}
    return union_by_name([quality.null_violations(frames[m], m, c) for m, c in quality.GOLD_NOT_NULL.items()])


MART_TESTS = {
    "prix_m2_par_ville": [("accepted_values", "annee", "count(*) FILTER (annee NOT IN (2021, 2022, 2023, 2024, 2025))"),
                          ("bounds", "prix_m2_median", "count(*) FILTER (prix_m2_median <= 0)")],
    "ratio_loyer_revenu": [("bounds", "ratio_tension_pct", "count(*) FILTER (ratio_tension_pct NOT BETWEEN 1 AND 200)")],
    "dynamisme_marche": [("accepted_values", "categorie_tension", "count(*) FILTER (categorie_tension NOT IN ('Très tendu', 'Tendu', 'Modéré', 'Détendu'))"),
                         ("bounds", "score_tension", "count(*) FILTER (score_tension NOT BETWEEN 0 AND 100)")],
    "evolution_tension": [],
    "inegalites": [("bounds", "rang_accessibilite",
                    "count(*) FILTER (least(rang_accessibilite_modeste, rang_accessibilite_median, rang_accessibilite_aise) < 1)")],
}


@q(" UNION ALL ".join(
    _rows(m, [("not_null", c, f"count(*) FILTER ({c} IS NULL)") for c in quality.GOLD_NOT_NULL[m]]
          + [("row_count", "*", "greatest(1 - count(*), 0)"), *tests], GOLD[m])
    for m, tests in MART_TESTS.items()))
def dq_mart_report(s: Star):
    """Every check of the five marts in one report."""
    return quality.check_marts({
        "prix_m2_par_ville": s.gold.prices, "ratio_loyer_revenu": s.gold.ratios, "dynamisme_marche": s.gold.tension,
        "evolution_tension": s.gold.trend, "inegalites": s.gold.inequality,
    })


def _failing(df):
    return df.agg(F.count(F.lit(1)).alias("failing"))


@q("SELECT count(*) AS failing FROM g_tension WHERE score_tension * 3 - 30 < 0 OR score_tension * 3 - 30 > 100")
def dq_score_bounds(s: Star):
    """Scores moved so that some fail on either side."""
    return _failing(quality.bad_scores(s.gold.tension.withColumn("score_tension", F.col("score_tension") * 3 - 30)))


@q("SELECT observatory_b, annee, ratio_tension_pct FROM (SELECT observatory_b, annee, ratio_tension_pct * 3 AS ratio_tension_pct FROM g_ratios) WHERE ratio_tension_pct NOT BETWEEN 1 AND 200")
def dq_ratio_bounds(s: Star):
    tripled = s.gold.ratios.select("observatory_b", "annee", (F.col("ratio_tension_pct") * 3).alias("ratio_tension_pct"))
    return quality.bad_ratios(tripled)


@q("SELECT code_insee, annee, prix_m2_median - 1100 AS prix_m2_median FROM g_prices WHERE prix_m2_median <= 1100")
def dq_price_positive(s: Star):
    lowered = s.gold.prices.select("code_insee", "annee", (F.col("prix_m2_median") - 1100).alias("prix_m2_median"))
    return quality.bad_prices(lowered)


@q("SELECT count(*) AS failing FROM g_inequality WHERE least(rang_accessibilite_modeste - 2, rang_accessibilite_median, rang_accessibilite_aise) < 1")
def dq_rank_positive(s: Star):
    """One of the ranks lowered so that some fail."""
    lowered = F.col("rang_accessibilite_modeste") - 2
    return _failing(quality.bad_ranks(s.gold.inequality.withColumn("rang_accessibilite_modeste", lowered)))


@q(f"SELECT {SOURCE} AS source FROM customer WHERE {SOURCE} NOT IN (SELECT source FROM {LEDGER} WHERE status = 'success')")
def ledger_pending(s: Star):
    return ledger.pending(s.sources, s.ledger)


@q(f"""SELECT source, status, rows_loaded, events FROM
    (SELECT *, count(*) OVER (PARTITION BY source) AS events FROM
        (SELECT source, status, rows_loaded, started_at FROM {LEDGER}
         UNION ALL SELECT {SOURCE}, 'error', NULL, TIMESTAMP '2030-01-01' FROM customer WHERE c_acctbal < 0))
    WHERE started_at = TIMESTAMP '2030-01-01'""")
def ledger_append(s: Star):
    """New error events on top of the old ones decide the state of their sources."""
    at = F.lit("2030-01-01").cast("timestamp")
    failed = s.table("customer").where("c_acctbal < 0").select(
        Star.source_name().alias("source"), F.lit("error").alias("status"), F.lit(None).cast("bigint").alias("rows_loaded"),
        at.alias("started_at"), at.alias("finished_at"), F.lit("failed").alias("error_msg"),
    )
    log = ledger.EventLog(s.spark, shared_folder(s.spark, "ledger"))
    log.append(s.ledger)
    log.append(failed)
    state = ledger.latest_status(log.read())
    return state.join(failed.select("source"), "source", "left_semi")


@q(f"SELECT source, status, count(*) AS n FROM {LEDGER} WHERE NOT (status = 'success' AND source LIKE 'staging.%') GROUP BY ALL")
def ledger_reset(s: Star):
    return ledger.reset(s.ledger, schema="staging").groupBy("source", "status").agg(F.count(F.lit(1)).alias("n"))


@q(f"""SELECT source, rows_loaded FROM (SELECT {SOURCE} AS source, count(*) AS rows_loaded FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY ALL)
    WHERE source NOT IN (SELECT source FROM {LEDGER} WHERE status = 'success')""")
def ledger_bootstrap(s: Star):
    counts = s.ledger.groupBy("source").agg(F.count(F.lit(1)).alias("rows_loaded"))
    return ledger.bootstrap(counts, s.ledger)
