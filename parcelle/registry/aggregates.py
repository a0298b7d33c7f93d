"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import even_round, exact_round
from ..operators import profile
from ..operators.quantiles import group_stats
from ..plans import quality
from ..plans.marts import rent_signal
from ..sources.starschema import Star
from .base import MED, Section, rnd, rnde

QUERIES = q = Section()


def _count(df, *keys):
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@q(f"SELECT code_insee, annee, {rnd(MED, 4)} AS median FROM g_sales GROUP BY ALL")
def agg_median_cont(s: Star):
    stats = group_stats(s.sales.select("code_insee", "annee", "prix_m2"), ["code_insee", "annee"], {"m": ("prix_m2", 0.5)})
    return stats.select("code_insee", "annee", exact_round(F.col("m"), 4).alias("median"))


@q(f"""SELECT code_insee, {', '.join(f"{rnd(f'percentile_cont({p}) WITHIN GROUP (ORDER BY valeur_fonciere)', 3)} AS {n}"
    for n, p in (('d1', 0.1), ('d5', 0.5), ('d9', 0.9)))} FROM g_sales GROUP BY 1""")
def agg_deciles(s: Star):
    probabilities = {n: ("valeur_fonciere", p) for n, p in (("d1", 0.1), ("d5", 0.5), ("d9", 0.9))}
    stats = group_stats(s.sales.select("code_insee", "valeur_fonciere"), ["code_insee"], probabilities)
    return stats.select("code_insee", *(exact_round(F.col(n), 3).alias(n) for n in probabilities))


@q(f"""SELECT {rnd('q1', 3)} AS q1, {rnd('q3', 3)} AS q3, {rnd('q3 + 1.5 * (q3 - q1)', 3)} AS fence FROM
    (SELECT percentile_cont(0.25) WITHIN GROUP (ORDER BY prix_m2) AS q1,
            percentile_cont(0.75) WITHIN GROUP (ORDER BY prix_m2) AS q3 FROM g_sales)""")
def agg_iqr_fence(s: Star):
    fence = profile.upper_fence(s.sales, "prix_m2")
    return fence.select(*(exact_round(F.col(c), 3).alias(c) for c in fence.columns))


@q("""SELECT percentile_cont(0.5) WITHIN GROUP (ORDER BY n)::DOUBLE AS median FROM
    (SELECT count(*) AS n FROM g_sales GROUP BY code_insee, annee, type_local)""")
def agg_median_of_counts(s: Star):
    """Equal counts are weighted: there are far fewer distinct counts than groups."""
    counts = _count(s.sales, "code_insee", "annee", "type_local")
    weighted = counts.groupBy("n").agg(F.count(F.lit(1)).alias("times"))
    return weighted.agg(F.percentile("n", 0.5, F.col("times")).alias("median"))


@q(f"SELECT type_local, annee, {rnd('avg(prix_m2)', 2)} AS prix, {rnd('avg(surface_bati)', 2)} AS surface FROM g_sales GROUP BY ALL")
def agg_avg_round(s: Star):
    return s.sales.groupBy("type_local", "annee").agg(
        exact_round(F.avg("prix_m2"), 2).alias("prix"), exact_round(F.avg("surface_bati"), 2).alias("surface")
    )


@q(f"SELECT code_insee, {rnd('sum(valeur_fonciere)', 2)} AS total FROM g_sales GROUP BY 1")
def agg_sum_round(s: Star):
    return s.sales.groupBy("code_insee").agg(exact_round(F.sum("valeur_fonciere"), 2).alias("total"))


@q("""SELECT code_insee, annee, type_local, count(*) AS n FROM g_sales
    WHERE nature_mutation = 'Vente' AND prix_m2 BETWEEN 500 AND 13731 GROUP BY ALL HAVING count(*) >= 10""")
def agg_count_having(s: Star):
    kept = s.sales.where("nature_mutation = 'Vente' and prix_m2 between 500 and 13731")
    return _count(kept, "code_insee", "annee", "type_local").where("n >= 10")


@q("SELECT annee, count(DISTINCT code_insee) AS communes FROM g_sales GROUP BY 1")
def agg_count_distinct(s: Star):
    return s.sales.groupBy("annee").agg(F.count_distinct("code_insee").alias("communes"))


@q("SELECT min(annee) AS first, max(annee) AS last, max(annee) - min(annee) + 1 AS coverage FROM g_sales")
def agg_min_max(s: Star):
    return s.sales.agg(
        F.min("annee").alias("first"), F.max("annee").alias("last"), (F.max("annee") - F.min("annee") + 1).alias("coverage")
    )


@q(f"SELECT {rnd('avg(ratio_tension_pct)', 1)} AS ratio FROM g_ratios")
def agg_global_avg(s: Star):
    return s.ratios.agg(exact_round(F.avg("ratio_tension_pct"), 1).alias("ratio"))


@q(f"""SELECT observatory_b, id_agglomeration, annee, type_habitat, nombre_pieces, {rnd('avg(loyer_mensuel_median)', 2)} AS loyer,
    {rnd('avg(loyer_median_m2)', 2)} AS m2 FROM g_rents GROUP BY ALL""")
def agg_group_avg(s: Star):
    return s.rents.groupBy("observatory_b", "id_agglomeration", "annee", "type_habitat", "nombre_pieces").agg(
        exact_round(F.avg("loyer_mensuel_median"), 2).alias("loyer"), exact_round(F.avg("loyer_median_m2"), 2).alias("m2")
    )


@q(f"SELECT code_insee, annee, {rnd('ratio_tension_pct', 4)} AS ratio FROM g_signal")
def agg_bridge_avg(s: Star):
    return rent_signal(s.ratios, s.bridge).select("code_insee", "annee", exact_round(F.col("ratio_tension_pct"), 4).alias("ratio"))


@q("SELECT observatory_b, reg, count(*) AS votes FROM g_bridge JOIN g_communes USING (code_insee) GROUP BY ALL")
def agg_vote_count(s: Star):
    return s.bridge.join(s.communes, "code_insee").groupBy("observatory_b", "reg").agg(F.count(F.lit(1)).alias("votes"))


@q(f"""SELECT code_departement, {rnde('avg(prix_m2_moyen)', 0)} AS prix, {rnde('avg(surface_moyenne)', 1)} AS surface,
    {rnde('avg(evolution_annuelle_pct)', 1)} AS hausse, {rnde('avg(nb_transactions)', 1)} AS ventes FROM g_prices GROUP BY 1""")
def agg_named_multi(s: Star):
    means = {"prix": ("prix_m2_moyen", 0), "surface": ("surface_moyenne", 1), "hausse": ("evolution_annuelle_pct", 1),
             "ventes": ("nb_transactions", 1)}
    return s.prices.groupBy("code_departement").agg(*(even_round(F.avg(c), n).alias(a) for a, (c, n) in means.items()))


@q("""SELECT annee, nom_commune AS top FROM (SELECT annee, nom_commune, avg(prix_m2_median) AS m FROM g_prices GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY annee ORDER BY m DESC, nom_commune) = 1""")
def agg_argmax_group(s: Star):
    means = s.prices.groupBy("annee", "nom_commune").agg(F.avg("prix_m2_median").alias("m"))
    best = means.groupBy("annee").agg(F.min(F.struct((-F.col("m")).alias("m"), "nom_commune")).alias("b"))
    return best.select("annee", F.col("b.nom_commune").alias("top"))


@q("""SELECT type_habitat, count(*) FILTER (ratio_tension_pct < 33) AS accessible,
    count(*) FILTER (ratio_tension_pct >= 33 AND ratio_tension_pct < 50) AS tendu,
    count(DISTINCT CASE WHEN ratio_tension_pct >= 50 THEN nom_agglomeration END) AS difficile FROM g_ratios GROUP BY 1""")
def agg_conditional_count(s: Star):
    ratio = F.col("ratio_tension_pct")
    return s.ratios.groupBy("type_habitat").agg(
        F.count_if(ratio < 33).alias("accessible"), F.count_if((ratio >= 33) & (ratio < 50)).alias("tendu"),
        F.count_distinct(F.when(ratio >= 50, F.col("nom_agglomeration"))).alias("difficile"),
    )


@q("SELECT p_name, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_name LIMIT 20")
def agg_value_counts(s: Star):
    return profile.value_counts(s.table("part"), ["p_name"], top=20)


@q("""SELECT unnest(['nombre_pieces_homogene', 'Type_habitat', 'loyer_median', 'loyer_mensuel_median', 'Observatory', 'agglomeration',
        'Data_year', 'nombre_obsservations']) AS column_name,
    unnest([count(*) FILTER (o_orderpriority = '5-LOW'), count(*) FILTER (o_orderstatus = 'P'), 0, 0, 0, 0, 0, 0]) AS nulls FROM orders""")
def agg_null_profile(s: Star):
    return profile.null_profile(s.raw_rents)


def _described(column: str, table: str) -> str:
    quartiles = ", ".join(
        rnd(f"percentile_cont({p}) WITHIN GROUP (ORDER BY {column})", 3) + f" AS {n}"
        for n, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
    )
    return (f"SELECT '{column}' AS column_name, count({column}) AS n, {rnd(f'avg({column})', 3)} AS mean,"
            f" {rnd(f'stddev_samp({column})', 3)} AS std, {rnd(f'min({column})', 3)} AS min, {quartiles},"
            f" {rnd(f'max({column})', 3)} AS max FROM {table}")


@q(_described("prix_m2", "g_sales") + " UNION ALL " + _described("surface_bati", "g_sales"))
def agg_describe(s: Star):
    found = profile.describe(s.sales, ["prix_m2", "surface_bati"])
    return found.select(*(c if c in ("column_name", "n") else exact_round(F.col(c), 3).alias(c) for c in found.columns))


@q("""SELECT annee, count(*) FILTER (revenu < 500000) AS secret, count(*) FILTER (revenu >= 500000) AS available
    FROM (SELECT annee, round(revenu_median::DECIMAL(38,6), 0) AS revenu FROM g_incomes) GROUP BY 1""")
def agg_secrecy_rate(s: Star):
    return s.raw_income.groupBy("annee").agg(
        F.count_if(F.col("Q2") == "s").alias("secret"), F.count_if(F.col("Q2") != "s").alias("available")
    )


@q(f"""SELECT 'bin' AS kind, type_local, least(floor((valeur_fonciere - lo) * 50 / (hi - lo)), 49)::DOUBLE AS key, count(*)::DOUBLE AS value
    FROM g_sales, (SELECT min(valeur_fonciere) AS lo, max(valeur_fonciere) AS hi FROM g_sales) GROUP BY ALL
    UNION ALL SELECT 'box', type_local, p, {rnd('v', 3)} FROM (
        SELECT type_local, 0.25 AS p, percentile_cont(0.25) WITHIN GROUP (ORDER BY valeur_fonciere) AS v FROM g_sales GROUP BY 1
        UNION ALL SELECT type_local, 0.5, percentile_cont(0.5) WITHIN GROUP (ORDER BY valeur_fonciere) FROM g_sales GROUP BY 1
        UNION ALL SELECT type_local, 0.75, percentile_cont(0.75) WITHIN GROUP (ORDER BY valeur_fonciere) FROM g_sales GROUP BY 1)""")
def agg_histogram_box(s: Star):
    bins = profile.histogram(s.sales, "valeur_fonciere", "type_local", 50).select(
        F.lit("bin").alias("kind"), "type_local", F.col("bin").cast("double").alias("key"), F.col("n").cast("double").alias("value")
    )
    quartiles = profile.box_stats(s.sales.select("type_local", "valeur_fonciere"), "valeur_fonciere", "type_local")
    sides = F.map_from_arrays(F.array(*map(F.lit, (0.25, 0.5, 0.75))), F.array("q1", "median", "q3"))
    box = quartiles.select(F.lit("box").alias("kind"), "type_local", F.explode(sides).alias("key", "v")).select(
        "kind", "type_local", "key", exact_round(F.col("v"), 3).alias("value")
    )
    return bins.unionByName(box)


@q(f"""SELECT nom_agglomeration, {rnd('percentile_cont(0.5) WITHIN GROUP (ORDER BY loyer_mensuel_median)', 2)} AS loyer
    FROM g_rents GROUP BY 1 ORDER BY loyer DESC, nom_agglomeration LIMIT 10""")
def agg_top_median(s: Star):
    stats = group_stats(
        s.rents.select("id_agglomeration", "loyer_mensuel_median"), ["id_agglomeration"], {"m": ("loyer_mensuel_median", 0.5)}
    )
    named = stats.join(s.agglomerations, "id_agglomeration").select("nom_agglomeration", exact_round(F.col("m"), 2).alias("loyer"))
    return named.orderBy(F.desc("loyer"), "nom_agglomeration").limit(10)


@q("""SELECT 'prix_m2_par_ville' AS modele, count(*) AS nb FROM g_prices
    UNION ALL SELECT 'ratio_loyer_revenu', count(*) FROM g_ratios
    UNION ALL SELECT 'dynamisme_marche', count(*) FROM g_tension
    UNION ALL SELECT 'evolution_tension', count(*) FROM g_trend
    UNION ALL SELECT 'inegalites', count(*) FROM g_inequality""")
def agg_row_counts_union(s: Star):
    """All five marts with their rows; a check keeps those with none."""
    return quality.row_counts({
        "prix_m2_par_ville": s.gold.prices, "ratio_loyer_revenu": s.gold.ratios, "dynamisme_marche": s.gold.tension,
        "evolution_tension": s.gold.trend, "inegalites": s.gold.inequality,
    })


@q(f"""SELECT lang, count(*) AS docs, count(quality) AS matched, {rnd('avg(CASE WHEN quality IS NULL THEN 0 ELSE 1 END)', 4)} AS coverage
    FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""")
def agg_coverage_rate(s: Star):
    joined = s.table("documents").select("doc_id", "lang").join(s.table("labels"), "doc_id", "left")
    return joined.groupBy("lang").agg(
        F.count(F.lit(1)).alias("docs"), F.count("quality").alias("matched"),
        exact_round(profile.share(F.col("quality").isNotNull()), 4).alias("coverage"),
    )
