"""Queries over the marts. Parameters are values, never pieces of SQL text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import zero_pad
from ..functions.numbers import access_band, even_round, exact_round, ratio
from ..functions.text import contains_folded
from ..operators.relational import keep_first, keep_latest_ties
from ..operators.validation import where_given

# Labels of the dashboard.
ALL_ROOMS = "Tous"
VERY_TENSE, TENSE = "Très tendu", "Tendu"
INDICATORS = ("score_tension", "prix_m2_moyen", "hausse_prix_pct")


def ad_hoc(spark: SparkSession, sql: str, tables: dict[str, DataFrame], **values) -> DataFrame:
    """A SQL text over named frames (``{name}``), with ``:name`` values bound."""
    return spark.sql(sql, args=values, **tables)


def options(df: DataFrame, columns: Sequence[str], descending: bool = False) -> DataFrame:
    order = [F.desc(c) if descending else F.asc_nulls_last(c) for c in columns]
    return df.select(*columns).where(F.col(columns[0]).isNotNull()).distinct().orderBy(*order)


def home_kpis(
    spark: SparkSession, prices: DataFrame, ratios: DataFrame, tension: DataFrame, observatories: DataFrame
) -> DataFrame:
    """One row; each mart is read once."""
    tense = F.col("categorie_tension").isin(VERY_TENSE, TENSE)
    by_year = tension.groupBy("annee").agg(F.count_distinct(F.when(tense, F.col("nom_commune"))).alias("n"))
    years = by_year.agg(
        F.min("annee").alias("min_annee"), F.max("annee").alias("max_annee"),
        (F.max("annee") - F.min("annee") + 1).alias("couverture"), F.max_by("n", "annee").alias("nb_tendu"),
    )
    return years.withColumns({
        "nb_communes": prices.agg(F.count_distinct("nom_commune")).scalar(),
        "ratio_moyen": ratios.agg(exact_round(F.avg("ratio_tension_pct"), 1)).scalar(),
        "nb_obs": observatories.agg(F.count(F.lit(1))).scalar(),
    })


def map_rows(
    tension: DataFrame, communes: DataFrame, indicator: str = "score_tension",
    annee: int | None = None, type_local: str | None = None, region: str | None = None,
) -> DataFrame:
    """Communes of one year (the last by default), highest indicator first."""
    if indicator not in INDICATORS:
        raise ValueError(f"indicator must be one of {INDICATORS}")
    year = F.lit(annee) if annee is not None else tension.agg(F.max("annee")).scalar()
    chosen = where_given(tension.where(F.col("annee") == year), {"type_local": type_local})
    chosen = chosen.where(F.col(indicator).isNotNull()).withColumn("_by", F.col(indicator))
    regions = where_given(communes.select("code_insee", "reg"), {"reg": region})
    return (
        chosen.join(regions, "code_insee")
        .orderBy(F.desc("_by"), "nom_commune", "type_local")
        .select(
            "code_insee", "nom_commune", "code_departement", "type_local",
            exact_round(F.col("score_tension"), 1).alias("score_tension"),
            exact_round(F.col("prix_m2_moyen"), 0).alias("prix_m2_moyen"),
            exact_round(F.col("hausse_prix_pct"), 1).alias("hausse_prix_pct"),
            "nb_transactions", "categorie_tension", "reg",
        )
    )


def map_departments(rows: DataFrame, indicator: str = "score_tension") -> DataFrame:
    return (
        rows.groupBy("code_departement")
        .agg(F.avg(indicator).alias("v"), F.avg("prix_m2_moyen").alias("p"),
             F.avg("score_tension").alias("s"), F.avg("hausse_prix_pct").alias("h"))
        .select(
            zero_pad(F.col("code_departement"), 2).alias("code_departement"),
            even_round(F.col("v"), 1).alias("valeur"),
            even_round(F.col("p"), 0).alias("prix_m2_moyen"),
            even_round(F.col("s"), 1).alias("score_moyen"),
            even_round(F.col("h"), 1).alias("hausse_moy"),
        )
    )


def map_kpis(rows: DataFrame, indicator: str = "score_tension") -> DataFrame:
    """One row over towns summed first, so the map's rows are read once.

    Equal means go to the first name.
    """
    towns = rows.groupBy("nom_commune").agg(
        F.sum(indicator).alias("s"), F.count(indicator).alias("n"), F.max(indicator).alias("top"),
        F.max(F.col("categorie_tension") == VERY_TENSE).alias("very"),
    )
    order = F.struct((-F.col("s") / F.col("n")).alias("m"), "nom_commune")
    return towns.agg(
        even_round(F.sum("s") / F.sum("n"), 1).alias("val_moyenne"),
        F.count(F.lit(1)).alias("nb_communes"),
        F.count_if("very").alias("nb_tres_tendu"),
        even_round(F.max("top"), 1).alias("val_max"),
        F.min_by("nom_commune", order).alias("commune_top"),
    )


def _compared(mart: DataFrame, names: Sequence[str], type_habitat: str) -> DataFrame:
    return mart.where(F.col("nom_agglomeration").isin(list(names)) & (F.col("type_habitat") == type_habitat))


def compare_latest_rent(ratios: DataFrame, names: Sequence[str], type_habitat: str = "Appartement") -> DataFrame:
    rows = _compared(ratios, names, type_habitat).where(F.col("nombre_pieces") == ALL_ROOMS)
    return keep_latest_ties(rows, ["nom_agglomeration"], "annee").orderBy("loyer_mensuel_median").select(
        "nom_agglomeration", "annee", "loyer_mensuel_median", "revenu_mensuel_moyen", "ratio_tension_pct"
    )


def compare_inequality(inequality: DataFrame, names: Sequence[str], type_habitat: str = "Appartement") -> DataFrame:
    return keep_latest_ties(_compared(inequality, names, type_habitat), ["nom_agglomeration"], "annee").select(
        "nom_agglomeration", "revenu_d1", "revenu_median", "revenu_d9",
        "taux_effort_modeste_pct", "taux_effort_median_pct", "taux_effort_aise_pct",
        "evolution_loyer_pct", "evolution_revenu_pct",
    )


def compare_series(ratios: DataFrame, names: Sequence[str], type_habitat: str = "Appartement") -> DataFrame:
    return (
        _compared(ratios, names, type_habitat).where(F.col("nombre_pieces") == ALL_ROOMS)
        .select("nom_agglomeration", "annee", "loyer_mensuel_median", "ratio_tension_pct")
        .orderBy("nom_agglomeration", "annee")
    )


def _of_city(mart: DataFrame, code: str, type_local: str) -> DataFrame:
    return mart.where((F.col("code_insee") == code) & (F.col("type_local") == type_local))


def city_price(prices: DataFrame, code: str, type_local: str = "Appartement") -> DataFrame:
    return _of_city(prices, code, type_local).select(
        "annee", "prix_m2_median", "prix_m2_moyen", "nb_transactions", "evolution_annuelle_pct", "moving_avg_3ans"
    ).orderBy("annee")


def city_tension(tension: DataFrame, code: str, type_local: str = "Appartement") -> DataFrame:
    return _of_city(tension, code, type_local).select(
        "annee", "score_tension", "categorie_tension", "hausse_prix_pct"
    ).orderBy("annee")


def city_pair(tension: DataFrame, cities: Mapping[str, str], type_local: str = "Appartement") -> DataFrame:
    """Yearly scores of two cities, one below the other, labelled (code to name)."""
    labels = F.create_map(*(F.lit(x) for pair in cities.items() for x in pair))
    rows = tension.where(F.col("code_insee").isin(list(cities)) & (F.col("type_local") == type_local))
    return rows.withColumn("ville", labels[F.col("code_insee")]).orderBy("ville", "annee").select(
        "annee", "score_tension", "categorie_tension", "hausse_prix_pct", "ville"
    )


def _rooms(nombre_pieces: str) -> Column:
    if nombre_pieces == ALL_ROOMS:
        return F.col("nombre_pieces") == ALL_ROOMS
    return F.col("nombre_pieces").ilike(f"%{nombre_pieces}%")


def search(
    ratios: DataFrame, agglomerations: DataFrame, mapping: DataFrame, communes: DataFrame, revenu: float,
    type_habitat: str = "Appartement", nombre_pieces: str = ALL_ROOMS,
    departement: str | None = None, annee: int | None = None,
) -> DataFrame:
    """Rent burden per commune for a monthly income, from the latest rents."""
    rents = where_given(ratios, {"type_habitat": type_habitat, "annee": annee}).where(_rooms(nombre_pieces))
    recent = keep_latest_ties(rents, ["observatory_b", "nom_agglomeration", "type_habitat", "nombre_pieces"], "annee")
    places = where_given(communes, {"code_departement": departement}).select(
        "code_insee", "nom_commune", "code_departement", "reg", "uu2020"
    )
    found = (
        recent.join(agglomerations.select("nom_agglomeration", "id_agglomeration"), "nom_agglomeration")
        .join(mapping.select("observatory_b", "id_agglomeration", "uu2020"), ["observatory_b", "id_agglomeration"])
        .join(places, "uu2020")
        .select(
            "code_insee", "nom_commune", "code_departement", "reg", "nom_agglomeration",
            F.col("annee").alias("annee_donnees"),
            exact_round(F.col("loyer_mensuel_median"), 0).alias("loyer_median"),
            exact_round(F.col("revenu_mensuel_moyen"), 0).alias("revenu_local"),
            exact_round(F.col("ratio_tension_pct"), 1).alias("taux_effort_local"),
            exact_round(ratio(F.col("loyer_mensuel_median"), F.lit(float(revenu))) * 100, 1).alias("taux_effort_vous"),
        )
    )
    order = [F.desc("annee_donnees"), F.asc_nulls_last("loyer_median"), F.col("nom_agglomeration"),
             F.asc_nulls_last("taux_effort_vous")]
    return keep_first(found, ["code_insee"], order)


def search_counts(found: DataFrame) -> DataFrame:
    effort = F.col("taux_effort_vous")
    return found.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(effort < 33).alias("n_accessible"),
        F.count_if((effort >= 33) & (effort < 50)).alias("n_tendu"),
    )


def search_display(found: DataFrame, wanted: str | None = None) -> DataFrame:
    """Text filter without accents or case, cheapest first, with a band."""
    if wanted:
        found = found.where(
            contains_folded(F.col("nom_commune"), wanted) | contains_folded(F.col("nom_agglomeration"), wanted)
        )
    return found.withColumn("accessibilite", access_band(F.col("taux_effort_vous"))).orderBy(
        F.asc_nulls_last("taux_effort_vous"), "code_insee"
    )
