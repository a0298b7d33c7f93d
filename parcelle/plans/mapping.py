"""Survey agglomerations matched to urban units by votes and name similarity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import bare_name
from ..operators.matching import best_match

# Score asked of a voted unit, and names that are no town.
GOOD_SCORE = 70
NO_UNIT = "01000"
RURAL, OUTSIDE, OUTSIDE_UNITS = "%rural%", "%hors%", "Communes hors%"


def surveyed_towns(rents: DataFrame, agglomerations: DataFrame) -> DataFrame:
    named = rents.select("observatory_b", "id_agglomeration").distinct().join(agglomerations, "id_agglomeration")
    name = F.col("nom_agglomeration")
    return named.where(~name.ilike(RURAL) & ~name.ilike(OUTSIDE)).select(
        "observatory_b", "id_agglomeration", "nom_agglomeration"
    )


def voted_units(bridge: DataFrame, communes: DataFrame, units: DataFrame) -> DataFrame:
    """Units of each observatory's communes, with the number of those communes.

    Votes belong to the observatory, so they are counted before its
    agglomerations come in.
    """
    votes = (
        bridge.join(communes.select("code_insee", "uu2020").where(F.col("uu2020") != NO_UNIT), "code_insee")
        .groupBy("observatory_b", "uu2020").agg(F.count(F.lit(1)).alias("votes"))
    )
    named = votes.join(units.where(~F.col("nom_uu").ilike(OUTSIDE_UNITS)).select("uu2020", "nom_uu"), "uu2020")
    return named.select("observatory_b", "uu2020", "nom_uu", "votes")


def unit_names(units: DataFrame) -> DataFrame:
    """Units as candidates of a nation-wide search, without votes."""
    return units.select(
        bare_name(F.col("nom_uu")).alias("name"), F.col("uu2020").alias("code"), F.col("nom_uu").alias("label"),
        F.lit(0).cast("bigint").alias("votes"),
    )


def best_votes(
    rents: DataFrame, agglomerations: DataFrame, bridge: DataFrame, communes: DataFrame, units: DataFrame
) -> DataFrame:
    """Every surveyed town with its best voted unit; the score is 0 where there is none."""
    towns = surveyed_towns(rents, agglomerations).withColumn("name", bare_name(F.col("nom_agglomeration")))
    voted = voted_units(bridge, communes, units).select(
        "observatory_b", bare_name(F.col("nom_uu")).alias("name"),
        F.col("uu2020").alias("code"), F.col("nom_uu").alias("label"), "votes",
    )
    local = best_match(towns, voted, ["observatory_b"])
    return towns.join(local, ["observatory_b", "name"], "left").withColumn("score", F.coalesce("score", F.lit(0.0)))


def map_agglomerations(
    rents: DataFrame, agglomerations: DataFrame, bridge: DataFrame, communes: DataFrame, units: DataFrame
) -> DataFrame:
    """One unit per observatory and agglomeration.

    The best voted unit is taken. If it scores under 70 the best unit of the whole
    country replaces it where that one scores strictly higher, with no vote. An
    agglomeration with neither stays unmapped.
    """
    first = best_votes(rents, agglomerations, bridge, communes, units)
    weak = first.where(F.col("score") < GOOD_SCORE)
    wide = best_match(weak, unit_names(units), []).select(
        "name", F.col("code").alias("wide_code"), F.col("label").alias("wide_label"), F.col("score").alias("wide_score")
    )
    both = first.join(wide, "name", "left")
    better = (F.col("score") < GOOD_SCORE) & F.coalesce(F.col("wide_score") > F.col("score"), F.lit(False))

    def pick(new, old):
        return F.when(better, new).otherwise(old)

    return both.select(
        pick(F.col("wide_code"), F.col("code")).alias("uu2020"),
        pick(F.col("wide_label"), F.col("label")).alias("nom_uu"),
        "observatory_b", "id_agglomeration", "nom_agglomeration",
        F.bround(pick(F.col("wide_score"), F.col("score")), 1).alias("score_fuzzy"),
        pick(F.lit(0), F.col("votes")).cast("int").alias("nb_communes_vote"),
    ).where("uu2020 is not null")


def mapping_quality(mapping: DataFrame) -> DataFrame:
    return mapping.agg(
        F.count(F.lit(1)).alias("mapped"),
        F.avg("score_fuzzy").alias("mean_score"),
        F.count_if(F.col("score_fuzzy") < GOOD_SCORE).alias("ambiguous"),
        F.count_if(F.col("nb_communes_vote") > 0).alias("by_vote"),
        F.count_if(F.col("nb_communes_vote") == 0).alias("by_fallback"),
    )
