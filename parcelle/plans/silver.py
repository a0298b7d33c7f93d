"""Cleaned dimension, bridge and fact tables from raw frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes, numbers, text
from ..operators.relational import (
    align,
    dedup,
    first_existing,
    insert_ignore,
    keep_first,
    keep_known,
    prefer,
    require_one_of,
    union_by_name,
)
from ..operators.validation import in_range, keep_valid, not_null

# Column names and codes of the source files.
COMMUNE_COLUMNS = {
    "code_insee": "string", "nom_commune": "string", "code_postal": "string",
    "code_departement": "string", "region": "string", "uu2020": "string", "reg": "string",
}
ZONING_CODE_COLUMNS = ("INSEE", "CODE INSEE", "L6A", "CODE_INSEE", "COMMUNE")
ZONING_NAME_COLUMNS = ("LIB_COM", "LIBCOM", "NOM_COM", "COMMUNE")
INCOME_COLUMNS = {2017: "Q217", 2018: "Q218", 2019: "Q219", 2020: "Q220", 2021: "Q221"}
OBSERVATION_COLUMNS = ("nombre_observations", "nombre_obsservations")
SALE, DWELLINGS = "Vente", ("Maison", "Appartement")
SALE_KEY = ("code_insee", "annee", "type_local", "valeur_fonciere", "surface_bati", "nombre_pieces")
RENT_GRAIN = ("observatory_b", "id_agglomeration", "annee", "type_habitat", "nombre_pieces")
URBAN_UNIT_LEVEL = "UU2020"


def _number(df: DataFrame, column: str) -> Column:
    """A numeric column as it is (so filters reach the scan), text parsed."""
    text_type = df.schema[column].dataType.typeName() == "string"
    return numbers.to_number(F.col(column)) if text_type else F.col(column).cast("double")


def sale_rows(raw: DataFrame) -> DataFrame:
    """Dwelling sales in the table's columns, before range checks."""
    price, area = _number(raw, "Valeur_fonciere"), _number(raw, "Surface_reelle_bati")
    sales = raw.where(
        (F.col("Nature_mutation") == SALE) & F.col("Type_local").isin(*DWELLINGS)
        & (area > 0) & F.col("Valeur_fonciere").isNotNull() & (price > 0)
    )
    return sales.select(
        codes.commune_code(F.col("Code_departement"), F.col("Code_commune")).alias("code_insee"),
        numbers.year_of(F.col("Date_mutation")).alias("annee"),
        F.col("Type_local").alias("type_local"),
        F.col("Nature_mutation").alias("nature_mutation"),
        price.alias("valeur_fonciere"),
        area.alias("surface_bati"),
        _number(raw, "Surface_terrain").alias("surface_terrain"),
        _number(raw, "Nombre_pieces_principales").cast("int").alias("nombre_pieces"),
        numbers.ratio(price, area).alias("prix_m2"),
        F.col("Nature_culture").alias("nature_culture"),
    )


def sale_rules() -> dict[str, Column]:
    return {
        "not_null": not_null("code_insee", "annee", "valeur_fonciere", "surface_bati"),
        "prix_m2": in_range("prix_m2", numbers.PRICE_FLOOR, numbers.PRICE_CEILING),
        "surface_bati": in_range("surface_bati", 1),
    }


def fact_transactions(raw: DataFrame, communes: DataFrame, merge_districts: bool = False) -> DataFrame:
    """One row per sale: plausible, of a known commune, bulk sales counted once.

    The dedup comes before the key filter: its shuffle is by all six keys, which
    spreads a commune with very many sales over the tasks.
    """
    valid = keep_valid(sale_rows(raw), sale_rules())
    if merge_districts:
        valid = valid.withColumn("code_insee", codes.merge_districts(F.col("code_insee")))
    return keep_known(dedup(valid, SALE_KEY), "code_insee", communes).select(*valid.columns)


def fact_revenus(by_year: Mapping[int, DataFrame], communes: DataFrame, columns: Mapping[int, str] = INCOME_COLUMNS) -> DataFrame:
    """Income per commune and year; the value's column is named after the year."""
    return income_facts(union_by_name([income_rows(df, year, columns[year]) for year, df in by_year.items()]), communes)


def income_rows(raw: DataFrame, year: int | Column, column: str) -> DataFrame:
    """One year's file with its value column under a common name."""
    return raw.select(
        F.col("CODGEO").alias("code_insee"),
        (F.lit(year) if isinstance(year, int) else year).alias("annee"),
        F.col(column).cast("string").alias("revenu"),
    )


def income_facts(rows: DataFrame, communes: DataFrame) -> DataFrame:
    value = numbers.secret_to_null(F.col("revenu"))
    clean = rows.select(
        codes.zero_pad(F.trim(F.col("code_insee")), 5).alias("code_insee"),
        F.col("annee").cast("string").try_cast("int").alias("annee"),
        value.alias("revenu_median"),
        (value / 12).alias("revenu_mensuel"),
    ).where(not_null("code_insee", "revenu_median"))
    return keep_known(clean, "code_insee", communes)


def rent_rows(raw: DataFrame) -> DataFrame:
    """Rent survey lines with cleaned labels; one of two spellings of the count column.

    Labels are cleaned once per distinct pair and joined back: the lines
    themselves never go through Python.
    """
    count = require_one_of(raw.columns, OBSERVATION_COLUMNS)
    raw = raw.where(not_null("Observatory", "agglomeration"))
    labels = raw.select("Observatory", "agglomeration").distinct().select(
        "Observatory", "agglomeration", text.clean_observatory_code(F.col("Observatory")).alias("observatory_b"),
        text.clean_label(F.col("agglomeration")).alias("nom_agglomeration"),
    )
    return raw.join(labels, ["Observatory", "agglomeration"]).select(
        "observatory_b", "nom_agglomeration",
        F.col("Data_year").cast("string").try_cast("int").alias("annee"),
        text.or_default(F.col("Type_habitat"), "Ensemble").alias("type_habitat"),
        text.rooms_label(text.or_default(F.col("nombre_pieces_homogene"), "Tous")).alias("nombre_pieces"),
        _number(raw, "loyer_mensuel_median").alias("loyer_mensuel_median"),
        _number(raw, "loyer_median").alias("loyer_median_m2"),
        _number(raw, count).alias("nombre_observations"),
    )


def fact_loyers(raws: Sequence[DataFrame], agglomerations: DataFrame) -> DataFrame:
    rows = union_by_name([rent_rows(raw) for raw in raws])
    placed = rows.join(agglomerations.select("nom_agglomeration", "id_agglomeration"), "nom_agglomeration")
    valid = keep_valid(placed, {
        "not_null": not_null("observatory_b", "id_agglomeration", "annee"),
        "loyer_mensuel_median": in_range("loyer_mensuel_median", 0),
        "loyer_median_m2": in_range("loyer_median_m2", 0),
    }).drop("nom_agglomeration")
    return dedup(valid, RENT_GRAIN).select(
        *RENT_GRAIN, "loyer_mensuel_median", "loyer_median_m2", "nombre_observations"
    )


def unmatched_agglomerations(raws: Sequence[DataFrame], agglomerations: DataFrame) -> DataFrame:
    """Names in the survey that the dimension does not have, with their rows."""
    rows = union_by_name([rent_rows(raw).select("nom_agglomeration") for raw in raws])
    return (
        rows.join(agglomerations.select("nom_agglomeration"), "nom_agglomeration", "left_anti")
        .groupBy("nom_agglomeration").agg(F.count(F.lit(1)).alias("n"))
    )


def dim_observatoire(raws: Sequence[DataFrame]) -> DataFrame:
    # Distinct before cleaning: the Arrow function sees each raw spelling once.
    raw = union_by_name([r.select("Observatory") for r in raws]).where("Observatory is not null").distinct()
    return raw.select(text.clean_observatory_code(F.col("Observatory")).alias("observatory_b")).distinct()


def dim_agglomeration(raws: Sequence[DataFrame], existing: DataFrame | None = None) -> DataFrame:
    raw = union_by_name([r.select("agglomeration") for r in raws]).where("agglomeration is not null").distinct()
    names = raw.select(text.clean_label(F.col("agglomeration")).alias("nom_agglomeration")).distinct()
    found = names.select(codes.stable_id(F.col("nom_agglomeration")).alias("id_agglomeration"), "nom_agglomeration")
    return found if existing is None else insert_ignore(existing, found, ["nom_agglomeration"])


def dim_temps(years: DataFrame) -> DataFrame:
    return years.select(F.col("annee").cast("string").try_cast("int").alias("annee")).where("annee is not null").distinct()


def dim_type_bien(sales: DataFrame) -> DataFrame:
    return sales.select(F.col("Type_local").alias("type_bien")).where("type_bien is not null").distinct()


def communes_from_reference(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed({"nom_standard": "nom_commune", "dep_code": "code_departement"})


def communes_from_sales(raw: DataFrame) -> DataFrame:
    named = raw.select("Code_departement", "Code_commune", "Commune", "Code_postal").distinct()
    return named.select(
        codes.commune_code(F.col("Code_departement"), F.col("Code_commune")).alias("code_insee"),
        F.col("Commune").alias("nom_commune"),
        F.col("Code_postal").cast("string").alias("code_postal"),
        F.col("Code_departement").cast("string").alias("code_departement"),
    )


def communes_from_income(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("CODGEO").alias("code_insee"), F.col("LIBGEO").alias("nom_commune")).distinct()


def communes_from_zoning(raw: DataFrame) -> DataFrame | None:
    """None where the file has no column with commune codes."""
    code = first_existing(raw.columns, ZONING_CODE_COLUMNS)
    if code is None:
        return None
    name = first_existing(raw.columns, ZONING_NAME_COLUMNS, but=code)
    rows = raw.where(F.col(f"`{code}`").isNotNull()).select(
        codes.zero_pad(F.trim(F.col(f"`{code}`")), 5).alias("code_insee"),
        (F.trim(F.col(f"`{name}`")) if name else F.lit(None).cast("string")).alias("nom_commune"),
    )
    return rows.where(codes.is_commune_code(F.col("code_insee"))).distinct()


def dim_commune(sources: Sequence[DataFrame | None], geography: DataFrame | None = None) -> DataFrame:
    """One row per commune from sources in falling priority, then geography on top.

    Within one source the first row in column order is kept, so the choice does
    not depend on how the files were split.
    """
    ranked = union_by_name([
        align(df, COMMUNE_COLUMNS).withColumn("_priority", F.lit(i))
        for i, df in enumerate(sources) if df is not None
    ])
    clean = ranked.select("_priority", *(text.null_token(F.col(c)).alias(c) for c in COMMUNE_COLUMNS))
    clean = clean.withColumn("code_insee", text.strip_spaces(F.col("code_insee"))).where(
        F.length("code_insee").between(5, 6)
    )
    order = [F.col("_priority"), *(F.col(c).asc_nulls_last() for c in COMMUNE_COLUMNS if c != "code_insee")]
    kept = keep_first(clean, ["code_insee"], order).withColumn("code_postal", codes.postal_code(F.col("code_postal")))
    kept = kept.select(*COMMUNE_COLUMNS)
    if geography is None:
        return kept
    geo = geography.select(F.trim("code_insee").alias("code_insee"), "uu2020", "reg")
    return prefer(kept, geo, "code_insee", ["uu2020", "reg"])


def bridge_rows(raw: DataFrame, observatory: Column | None = None) -> DataFrame | None:
    """Commune and observatory pairs of zoning rows, districts under their city."""
    code = first_existing(raw.columns, ZONING_CODE_COLUMNS)
    if code is None:
        return None
    padded = raw.where(F.col(f"`{code}`").isNotNull()).select(
        codes.zero_pad(F.trim(F.col(f"`{code}`")), 5).alias("code_insee"),
        F.upper(F.col("observatory_b") if observatory is None else observatory).alias("observatory_b"),
    )
    return padded.where(codes.is_commune_code(F.col("code_insee"))).select(
        codes.merge_districts(F.col("code_insee")).alias("code_insee"), "observatory_b"
    )


def bridge(zonings: Sequence[DataFrame], communes: DataFrame, observatories: DataFrame) -> DataFrame:
    rows = [b for b in (bridge_rows(z) for z in zonings) if b is not None]
    pairs = union_by_name(rows).distinct()
    return keep_known(keep_known(pairs, "code_insee", communes), "observatory_b", observatories).select(
        "code_insee", "observatory_b"
    )


def communes_geo(reference: DataFrame) -> DataFrame:
    """Commune rows of the geographic reference table."""
    return reference.where("CODGEO is not null").select(
        F.col("CODGEO").alias("code_insee"), F.col("LIBGEO").alias("nom_commune"),
        F.col("DEP").alias("dep"), F.col("REG").alias("reg"), F.col("UU2020").alias("uu2020"),
    )


def urban_units(reference: DataFrame) -> DataFrame:
    """Urban-unit rows of the supra-communal reference table."""
    return reference.where((F.col("NIVGEO") == URBAN_UNIT_LEVEL) & F.col("CODGEO").isNotNull()).select(
        F.col("CODGEO").alias("uu2020"), F.col("LIBGEO").alias("nom_uu"), F.col("NB_COM").alias("nb_communes")
    )
