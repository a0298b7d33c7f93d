"""The five marts.

Dimension columns that depend on the group key (commune name, department) are
joined after the aggregation, so the sales are never joined. Lag windows run over
the aggregated rows: at most one row per year in a partition.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import change_pct, exact_round, ratio, tension_band, tension_score
from ..operators.quantiles import group_stats
from ..operators.ranking import with_percent_rank, with_ranks
from ..sources.sinks import materialize

# Thresholds of the marts.
MIN_SALES = 10
MIN_SALES_FOR_RISE = 25
MIN_PREVIOUS_PRICE = 500
MAX_YEAR_GAP = 1
YEAR_FLOOR = 2020
ALL_HOUSING = "Ensemble"
DWELLINGS = ("Appartement", "Maison")

SALE_GROUP = ["code_insee", "annee", "type_local"]


def _named(df: DataFrame, communes: DataFrame) -> DataFrame:
    return df.join(communes.select("code_insee", "nom_commune", "code_departement"), "code_insee")


def prix_m2_par_ville(sales: DataFrame, communes: DataFrame) -> DataFrame:
    """Median and mean price per square metre by commune, year and type."""
    stats = group_stats(
        sales.where("prix_m2 is not null and type_local is not null").select(*SALE_GROUP, "prix_m2", "surface_bati"),
        SALE_GROUP,
        {"median": ("prix_m2", 0.5)},
        [F.avg("prix_m2").alias("mean"), F.count(F.lit(1)).alias("nb_transactions"), F.avg("surface_bati").alias("area")],
    ).where(F.col("nb_transactions") >= MIN_SALES)

    years = Window.partitionBy("code_insee", "type_local").orderBy("annee")
    before = F.lag("median").over(years)
    return _named(stats, communes).select(
        "code_insee", "nom_commune", "code_departement", "annee", "type_local",
        exact_round(F.col("median"), 2).alias("prix_m2_median"),
        exact_round(F.col("mean"), 2).alias("prix_m2_moyen"),
        "nb_transactions",
        exact_round(F.col("area"), 2).alias("surface_moyenne"),
        exact_round(before, 2).alias("prix_m2_annee_precedente"),
        exact_round(change_pct(F.col("median"), before), 2).alias("evolution_annuelle_pct"),
        exact_round(F.avg("median").over(years.rowsBetween(-2, 0)), 2).alias("moving_avg_3ans"),
    )


def _income_by_observatory(incomes: DataFrame, bridge: DataFrame) -> DataFrame:
    return incomes.where("revenu_median is not null").join(bridge, "code_insee")


def ratio_loyer_revenu(rents: DataFrame, incomes: DataFrame, bridge: DataFrame, agglomerations: DataFrame) -> DataFrame:
    """Rent against the latest year's income, per agglomeration, year, type and rooms."""
    grain = ["observatory_b", "id_agglomeration", "annee", "type_habitat", "nombre_pieces"]
    means = rents.where("loyer_median_m2 is not null").groupBy(*grain).agg(
        F.avg("loyer_median_m2").alias("m2"), F.avg("loyer_mensuel_median").alias("month")
    )
    latest = incomes.where(F.col("annee") == incomes.agg(F.max("annee")).scalar())
    local = _income_by_observatory(latest, bridge).groupBy("observatory_b").agg(
        F.avg("revenu_median").alias("year_income"), F.avg("revenu_mensuel").alias("month_income")
    )
    return means.join(agglomerations, "id_agglomeration").join(local, "observatory_b").select(
        "observatory_b", "nom_agglomeration", "annee", "type_habitat", "nombre_pieces",
        exact_round(F.col("m2"), 2).alias("loyer_median_m2"),
        exact_round(F.col("month"), 2).alias("loyer_mensuel_median"),
        exact_round(F.col("year_income"), 2).alias("revenu_median_moyen"),
        exact_round(F.col("month_income"), 2).alias("revenu_mensuel_moyen"),
        exact_round(ratio(F.col("month"), F.col("month_income")) * 100, 2).alias("ratio_tension_pct"),
    )


def rent_signal(ratios: DataFrame, bridge: DataFrame) -> DataFrame:
    """Mean rent ratio per commune and year over its observatories.

    Sums per observatory and year go through the bridge instead of the single
    ratios, so the join makes one row per bridge pair and year.
    """
    sums = ratios.where("ratio_tension_pct is not null").groupBy("observatory_b", "annee").agg(
        F.sum("ratio_tension_pct").alias("total"), F.count(F.lit(1)).alias("n")
    )
    return bridge.join(sums, "observatory_b").groupBy("code_insee", "annee").agg(
        (F.sum("total") / F.sum("n")).alias("ratio_tension_pct")
    )


def gated_rise(years) -> Column:
    """Price change, unknown after a gap, a tiny previous price or too few sales."""
    price, sales = F.col("prix_m2_moyen"), F.col("nb_transactions")
    before = F.lag(price).over(years)
    usable = ~(
        F.coalesce(before < MIN_PREVIOUS_PRICE, F.lit(False))
        | F.coalesce(F.col("annee") - F.lag("annee").over(years) > MAX_YEAR_GAP, F.lit(False))
        | F.coalesce(F.lag(sales).over(years) < MIN_SALES_FOR_RISE, F.lit(False))
        | (sales < MIN_SALES_FOR_RISE)
    )
    return F.when(usable, exact_round(change_pct(price, before), 2))


def market_groups(sales: DataFrame, year_floor: int = YEAR_FLOOR) -> DataFrame:
    """Dwelling sales by commune, year and type, from ``year_floor`` on."""
    kept = sales.where(
        F.col("valeur_fonciere").isNotNull() & F.col("type_local").isin(*DWELLINGS) & (F.col("annee") >= year_floor)
    ).select(*SALE_GROUP, "prix_m2", "valeur_fonciere")
    stats = group_stats(
        kept, SALE_GROUP, {"median": ("prix_m2", 0.5)},
        [F.count(F.lit(1)).alias("nb_transactions"), F.sum("valeur_fonciere").alias("total")],
    ).where(F.col("nb_transactions") >= MIN_SALES)
    return stats.select(
        *SALE_GROUP, "nb_transactions",
        exact_round(F.col("median"), 2).alias("prix_m2_moyen"),
        exact_round(F.col("total"), 2).alias("volume_total"),
    )


def dynamisme_marche(
    sales: DataFrame, communes: DataFrame, ratios: DataFrame, bridge: DataFrame,
    year_floor: int = YEAR_FLOOR,
) -> DataFrame:
    """Composite tension score from price rise, sales volume and rent burden.

    All three signals are columns of the same grouped rows, so there is no
    self-join.
    """
    groups = _named(market_groups(sales, year_floor), communes)
    years = Window.partitionBy("code_insee", "type_local").orderBy("annee")
    rising = groups.withColumn("hausse_prix_pct", gated_rise(years))
    ranked = with_percent_rank(rising, ["annee", "type_local"], "nb_transactions", "volume")
    scored = ranked.join(rent_signal(ratios, bridge), ["code_insee", "annee"], "left").withColumn(
        "score_tension",
        exact_round(tension_score(F.col("ratio_tension_pct"), F.col("hausse_prix_pct"), F.col("volume") * 100), 1),
    )
    return scored.select(
        "code_insee", "nom_commune", "code_departement", "annee", "type_local", "nb_transactions", "volume_total",
        "prix_m2_moyen", "hausse_prix_pct", "ratio_tension_pct", "score_tension",
        tension_band(F.col("score_tension")).alias("categorie_tension"),
    )


def evolution_tension(ratios: DataFrame) -> DataFrame:
    """Yearly change of the rent ratio, each agglomeration on its own."""
    years = Window.partitionBy("observatory_b", "nom_agglomeration", "type_habitat", "nombre_pieces").orderBy("annee")
    before = F.lag("ratio_tension_pct").over(years)
    return ratios.where("ratio_tension_pct is not null").select(
        "observatory_b", "nom_agglomeration", "annee", "type_habitat", "nombre_pieces", "ratio_tension_pct",
        before.alias("ratio_annee_precedente"),
        exact_round(F.col("ratio_tension_pct") - before, 2).alias("evolution_ratio"),
    )


def income_profiles(incomes: DataFrame, bridge: DataFrame) -> DataFrame:
    """Tenth, fiftieth and ninetieth percentile of commune incomes per observatory and year."""
    rows = _income_by_observatory(incomes, bridge).select("observatory_b", "annee", "revenu_median")
    return group_stats(
        rows, ["observatory_b", "annee"],
        {"d1": ("revenu_median", 0.1), "d5": ("revenu_median", 0.5), "d9": ("revenu_median", 0.9)},
        [F.avg("revenu_median").alias("mean")],
    )


def with_yearly_change(df: DataFrame, partition: list[str], value: str, prefix: str) -> DataFrame:
    """Previous value, and change unless a year is missing between the two."""
    years = Window.partitionBy(*partition).orderBy("annee")
    before = F.lag(value).over(years)
    gap = F.col("annee") - F.lag("annee").over(years)
    change = F.when(gap > MAX_YEAR_GAP, None).otherwise(exact_round(change_pct(F.col(value), before), 2))
    return df.withColumns({f"{prefix}_before": before, f"{prefix}_change": change})


PROFILES: Mapping[str, str] = {"modeste": "d1", "median": "d5", "aise": "d9"}


def inegalites(
    rents: DataFrame, incomes: DataFrame, bridge: DataFrame, agglomerations: DataFrame
) -> DataFrame:
    """Affordability per agglomeration and housing type for three income profiles.

    Yearly changes are taken at their own grain, before incomes meet rents: one
    row per year in each partition. Ranks run over the distinct rates, which have
    one decimal.
    """
    income = with_yearly_change(income_profiles(incomes, bridge), ["observatory_b"], "mean", "income")
    means = rents.where((F.col("type_habitat") != ALL_HOUSING) & F.col("loyer_mensuel_median").isNotNull()).groupBy(
        "observatory_b", "id_agglomeration", "annee", "type_habitat"
    ).agg(F.avg("loyer_mensuel_median").alias("rent"))
    rent = with_yearly_change(means, ["observatory_b", "id_agglomeration", "type_habitat"], "rent", "rent")

    joined = rent.join(income, ["observatory_b", "annee"]).join(agglomerations, "id_agglomeration")
    efforts = {
        f"taux_effort_{name}_pct": exact_round(ratio(F.col("rent"), F.col(d) / 12) * 100, 1)
        for name, d in PROFILES.items()
    }
    table = joined.select(
        "observatory_b", "nom_agglomeration", "annee", "type_habitat",
        exact_round(F.col("d1"), 2).alias("revenu_d1"),
        exact_round(F.col("d5"), 2).alias("revenu_median"),
        exact_round(F.col("d9"), 2).alias("revenu_d9"),
        exact_round(ratio(F.col("d9"), F.col("d1")), 2).alias("ratio_d9_d1"),
        exact_round(F.col("mean"), 2).alias("revenu_median_moyen"),
        exact_round(F.col("rent"), 2).alias("loyer_mensuel_moyen"),
        *(c.alias(name) for name, c in efforts.items()),
        exact_round(ratio(F.col("rent") * 12, F.col("mean")) * 100, 2).alias("part_loyer_annuel_pct"),
        F.col("income_before").alias("revenu_annee_precedente"),
        F.col("income_change").alias("evolution_revenu_pct"),
        F.col("rent_before").alias("loyer_annee_precedente"),
        F.col("rent_change").alias("evolution_loyer_pct"),
    )
    return with_ranks(table, ["annee", "type_habitat"], {f"rang_accessibilite_{name}": f"taux_effort_{name}_pct" for name in PROFILES})


#: Marts that another one reads as written.
NEEDS: Mapping[str, tuple[str, ...]] = {"dynamisme_marche": ("ratio_loyer_revenu",), "evolution_tension": ("ratio_loyer_revenu",)}
MARTS = ("prix_m2_par_ville", "ratio_loyer_revenu", "inegalites", "dynamisme_marche", "evolution_tension")


def write_marts(
    sales: DataFrame, communes: DataFrame, rents: DataFrame, incomes: DataFrame, bridge: DataFrame, agglomerations: DataFrame,
    schema: str, location: str, year_floor: int = YEAR_FLOOR, wanted: Collection[str] = MARTS,
) -> None:
    """The wanted marts, all five by default, as tables of ``schema``; what a mart needs is written before it and read back."""
    spark = sales.sparkSession
    ratios = lambda: spark.table(f"{schema}.ratio_loyer_revenu")
    build = {
        "prix_m2_par_ville": lambda: prix_m2_par_ville(sales, communes),
        "ratio_loyer_revenu": lambda: ratio_loyer_revenu(rents, incomes, bridge, agglomerations),
        "inegalites": lambda: inegalites(rents, incomes, bridge, agglomerations),
        "dynamisme_marche": lambda: dynamisme_marche(sales, communes, ratios(), bridge, year_floor),
        "evolution_tension": lambda: evolution_tension(ratios()),
    }
    for mart in MARTS:
        if mart in wanted:
            materialize({mart: build[mart]()}, schema, location)
