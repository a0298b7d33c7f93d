"""The engine's inputs expressed over a star schema of orders and suppliers.

A supplier stands for a commune, an order line for a sale, an order for a rent
survey line, a nation for a survey observatory and an urban unit, a nation and
market segment for an agglomeration. Codes are the supplier key on five places.
Raw frames have the columns and text formats of the source files.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import stable_id, zero_pad
from ..plans import marts
from ..plans.mapping import map_agglomerations
from ..session import shared_folder
from .layer import Layer, input_version
from .readers import read_table

# Which star-schema label plays which label of the housing data.
TYPES = {"A": "Appartement", "R": "Maison"}
OTHER_TYPE = "Local industriel"
HOUSING = {"F": "Appartement", "O": "Maison", "P": "Ensemble"}
ROOMS = {"1-URGENT": "1P", "2-HIGH": "2P", "3-MEDIUM": "3P", "4-NOT SPECIFIED": "4P+", "5-LOW": "Tous"}
RAW_ROOMS = {**ROOMS, "4-NOT SPECIFIED": "4P et plus", "5-LOW": None}
YEAR_FLOOR = 1997

# Columns of the tables.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
              " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
                " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
                " l_linestatus string, l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "pages": "page_id bigint, url string, html string",
    "labels": "doc_id bigint, quality int, toxic int",
}


def _mapped(c: Column, labels: dict, default=None) -> Column:
    chain = F
    for key, label in labels.items():
        chain = chain.when(c == key, F.lit(label))
    return chain.otherwise(F.lit(default))


def code5(c: Column) -> Column:
    return zero_pad(c.cast("string"), 5)


def observatory(nation: Column) -> Column:
    return F.concat(F.lit("B"), zero_pad(nation.cast("string"), 2))


def unit(nation: Column) -> Column:
    return code5(nation * 1000)


def agglomeration_name() -> Column:
    """Name of a nation and segment; one segment is rural, one lacks the nation's name."""
    return (
        F.when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("Zone rurale de "), F.col("n_name")))
        .when(
            F.col("c_mktsegment") == "BUILDING",
            F.concat(F.lit("Eurométropole de "), F.col("r_name"), F.lit(" BUILDING "), F.col("n_nationkey").cast("string")),
        )
        .otherwise(F.concat(F.lit("Agglomération de "), F.col("c_mktsegment"), F.lit(" "), F.col("n_name")))
    )


#: Where a session writes the marts of a version of a folder, and those it has written; where it keeps its silver layer.
_WRITTEN: dict[tuple[str, str, str], tuple[str, set[str]]] = {}
_LAYERS: dict[tuple[str, str], str] = {}


@dataclass(frozen=True)
class Gold:
    """Written marts; a query has those written that it reads."""

    star: Star

    prices = property(lambda self: self.star.written("prix_m2_par_ville"))
    ratios = property(lambda self: self.star.written("ratio_loyer_revenu"))
    tension = property(lambda self: self.star.written("dynamisme_marche"))
    trend = property(lambda self: self.star.written("evolution_tension"))
    inequality = property(lambda self: self.star.written("inegalites"))


class Star:
    """Frames over the tables of one folder; nothing is read until an action."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name, SCHEMAS[name])

    # Cleaned tables.

    @cached_property
    def nations(self) -> DataFrame:
        return self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))

    @cached_property
    def communes(self) -> DataFrame:
        joined = self.table("supplier").join(self.nations, F.col("s_nationkey") == F.col("n_nationkey"))
        return joined.select(
            code5(F.col("s_suppkey")).alias("code_insee"),
            F.col("s_name").alias("nom_commune"),
            code5(F.col("s_suppkey") + 1).alias("code_postal"),
            F.col("n_nationkey").cast("string").alias("code_departement"),
            F.col("r_name").alias("region"),
            unit(F.col("n_nationkey")).alias("uu2020"),
            F.col("r_name").alias("reg"),
        )

    @cached_property
    def sales(self) -> DataFrame:
        return self.table("lineitem").select(
            code5(F.col("l_suppkey")).alias("code_insee"),
            F.year("l_shipdate").alias("annee"),
            _mapped(F.col("l_returnflag"), TYPES, OTHER_TYPE).alias("type_local"),
            F.when(F.col("l_linestatus") == "O", "Vente").otherwise("Echange").alias("nature_mutation"),
            F.col("l_extendedprice").alias("valeur_fonciere"),
            F.col("l_quantity").alias("surface_bati"),
            F.col("l_linenumber").alias("nombre_pieces"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("prix_m2"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        return self.table("customer").join(self.nations, F.col("c_nationkey") == F.col("n_nationkey"))

    @cached_property
    def segments(self) -> DataFrame:
        """The nations' market segments, each once for every row of its nation."""
        known = self.table("customer").select("c_nationkey", "c_mktsegment").distinct()
        return known.join(self.nations, F.col("c_nationkey") == F.col("n_nationkey"))

    @cached_property
    def rents(self) -> DataFrame:
        # Names and digests are made for each nation and segment, not for each customer or order.
        named = self.segments.select(
            F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"),
            observatory(F.col("n_nationkey")).alias("observatory_b"), stable_id(agglomeration_name()).alias("id_agglomeration"))
        same = (F.col("c_nationkey") == F.col("nation")) & F.col("c_mktsegment").eqNullSafe(F.col("segment"))
        # Merged by key: by the size of their files, millions of rows of few columns would be broadcast, and joined in the one task that has the names.
        named = self.table("customer").hint("merge").join(named, same).select("c_custkey", "observatory_b", "id_agglomeration")
        joined = self.table("orders").hint("merge").join(named, F.col("o_custkey") == F.col("c_custkey"))
        return joined.select(
            "observatory_b",
            "id_agglomeration",
            F.year("o_orderdate").alias("annee"),
            _mapped(F.col("o_orderstatus"), HOUSING).alias("type_habitat"),
            _mapped(F.col("o_orderpriority"), ROOMS).alias("nombre_pieces"),
            F.col("o_totalprice").alias("loyer_mensuel_median"),
            (F.col("o_totalprice") / 50).alias("loyer_median_m2"),
        )

    @cached_property
    def agglomerations(self) -> DataFrame:
        names = self.segments.select(agglomeration_name().alias("nom_agglomeration")).distinct()
        return names.select(stable_id(F.col("nom_agglomeration")).alias("id_agglomeration"), "nom_agglomeration")

    @cached_property
    def observatories(self) -> DataFrame:
        return self.table("customer").select(observatory(F.col("c_nationkey")).alias("observatory_b")).distinct()

    @cached_property
    def incomes(self) -> DataFrame:
        sums = self.table("lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("annee")).agg(
            F.sum("l_extendedprice").alias("revenu_median")
        )
        return sums.select(
            code5(F.col("l_suppkey")).alias("code_insee"), "annee", "revenu_median",
            (F.col("revenu_median") / 12).alias("revenu_mensuel"),
        )

    @cached_property
    def bridge(self) -> DataFrame:
        """A commune in credit belongs to its nation's observatory and the next one of the region."""
        pairs = self.table("supplier").where("s_acctbal >= 0").select(
            code5(F.col("s_suppkey")).alias("code_insee"),
            F.explode(F.array(F.col("s_nationkey"), F.col("s_nationkey") + 5)).alias("n_nationkey"),
        )
        known = pairs.join(self.table("nation").select("n_nationkey"), "n_nationkey", "left_semi")
        return known.select("code_insee", observatory(F.col("n_nationkey")).alias("observatory_b"))

    @cached_property
    def units(self) -> DataFrame:
        outside = F.concat(F.lit("Communes hors unité "), F.col("n_name"))
        inside = F.concat(F.col("n_name"), F.lit(" ("), F.col("r_name"), F.lit(")"))
        return self.nations.select(
            unit(F.col("n_nationkey")).alias("uu2020"),
            F.when(F.col("r_name") == "MIDDLE EAST", outside).otherwise(inside).alias("nom_uu"),
        )

    # Marts.

    @cached_property
    def prices(self) -> DataFrame:
        return marts.prix_m2_par_ville(self.sales, self.communes)

    @cached_property
    def ratios(self) -> DataFrame:
        return marts.ratio_loyer_revenu(self.rents, self.incomes, self.bridge, self.agglomerations)

    @cached_property
    def tension(self) -> DataFrame:
        return marts.dynamisme_marche(self.sales, self.communes, self.ratios, self.bridge, YEAR_FLOOR)

    @cached_property
    def trend(self) -> DataFrame:
        return marts.evolution_tension(self.ratios)

    @cached_property
    def inequality(self) -> DataFrame:
        return marts.inegalites(self.rents, self.incomes, self.bridge, self.agglomerations)

    @cached_property
    def gold(self) -> Gold:
        """The five marts as written tables."""
        return Gold(self)

    def written(self, mart: str) -> DataFrame:
        """A mart as written, with those it needs, when it is first asked for in a session and version of the folder; then only read."""
        known = (self.spark.sparkContext.applicationId, self.folder, self.version)
        if known not in _WRITTEN:
            _WRITTEN[known] = shared_folder(self.spark, "marts"), set()
        location, done = _WRITTEN[known]
        wanted = [m for m in (*marts.NEEDS.get(mart, ()), mart) if m not in done]
        if wanted:
            schema = "marts_" + hashlib.md5(location.encode()).hexdigest()[:8]
            marts.write_marts(self.sales, self.communes, self.rents, self.incomes, self.bridge, self.agglomerations, schema, location, YEAR_FLOOR, wanted)
            done.update(wanted)
        return self.spark.read.parquet(f"{location}/{mart}")

    @cached_property
    def version(self) -> str:
        """Of the folder's files: a changed file makes the written tables anew."""
        return input_version(self.spark, self.folder)

    def silver(self, name: str) -> DataFrame:
        """A cleaned table as written once for a version of the inputs."""
        known = (self.spark.sparkContext.applicationId, self.folder)
        if known not in _LAYERS:
            _LAYERS[known] = shared_folder(self.spark, "silver")
        return Layer(self.spark, _LAYERS[known]).table(name, self.version, lambda: getattr(self, name))

    @cached_property
    def mapping(self) -> DataFrame:
        return map_agglomerations(self.rents, self.agglomerations, self.bridge, self.communes, self.units)

    # Raw frames.

    @cached_property
    def raw_sales(self) -> DataFrame:
        key = F.col("l_suppkey")
        return self.table("lineitem").select(
            F.floor(key / 1000).cast("string").alias("Code_departement"),
            (key % 1000).cast("string").alias("Code_commune"),
            F.date_format("l_shipdate", "dd/MM/yyyy").alias("Date_mutation"),
            F.when(F.col("l_linestatus") == "O", "Vente").otherwise("Echange").alias("Nature_mutation"),
            _mapped(F.col("l_returnflag"), TYPES, OTHER_TYPE).alias("Type_local"),
            F.translate(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"), ".", ",").alias("Valeur_fonciere"),
            F.col("l_quantity").alias("Surface_reelle_bati"),
            (F.col("l_tax") * 100).alias("Surface_terrain"),
            F.col("l_linenumber").cast("double").alias("Nombre_pieces_principales"),
            F.when(F.col("l_discount") > 0.05, "S").alias("Nature_culture"),
            F.concat(F.lit("Ville "), key.cast("string")).alias("Commune"),
            F.when(key > 0, (key * 10).cast("double")).alias("Code_postal"),
        )

    @cached_property
    def raw_rents(self) -> DataFrame:
        joined = self.table("orders").join(self.customers, F.col("o_custkey") == F.col("c_custkey"))
        return joined.select(
            F.concat(F.lit(" b"), zero_pad(F.col("n_nationkey").cast("string"), 2), F.lit(".0")).alias("Observatory"),
            F.concat(F.lit(" "), F.replace(agglomeration_name(), F.lit(" "), F.lit("  "))).alias("agglomeration"),
            F.year("o_orderdate").alias("Data_year"),
            F.when(F.col("o_orderstatus") != "P", _mapped(F.col("o_orderstatus"), HOUSING)).alias("Type_habitat"),
            _mapped(F.col("o_orderpriority"), RAW_ROOMS).alias("nombre_pieces_homogene"),
            F.col("o_totalprice").alias("loyer_mensuel_median"),
            (F.col("o_totalprice") / 50).alias("loyer_median"),
            (F.col("o_orderkey") % 90 + 10).alias("nombre_obsservations"),
        )

    @cached_property
    def raw_income(self) -> DataFrame:
        """Yearly revenue as text with a decimal comma; below half a million it is withheld."""
        sums = self.table("lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("annee")).agg(
            F.round(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")), 0).cast("bigint").alias("total")
        )
        return sums.select(
            F.col("l_suppkey").cast("string").alias("CODGEO"),
            F.concat(F.lit("Revenu "), F.col("l_suppkey").cast("string")).alias("LIBGEO"),
            "annee",
            F.when(F.col("total") < 500_000, F.lit("s")).otherwise(F.concat(F.col("total").cast("string"), F.lit(",5"))).alias("Q2"),
        )

    @cached_property
    def raw_zoning(self) -> DataFrame:
        """Unpadded commune codes per observatory, some of them districts of Paris or Lyon."""
        pairs = self.table("supplier").select(
            F.when(F.col("s_acctbal") < 0, F.lit("75101")).otherwise(F.col("s_suppkey").cast("string")).alias("code_insee"),
            F.col("s_name").alias("LIB_COM"),
            F.explode(F.array(F.col("s_nationkey"), F.col("s_nationkey") + 5)).alias("nation"),
        )
        return pairs.select(
            F.concat(F.lit(" "), F.col("code_insee")).alias("Insee "), "LIB_COM",
            F.lower(observatory(F.col("nation"))).alias("observatory_b"),
        )

    @cached_property
    def raw_communes(self) -> DataFrame:
        return self.communes.where(F.col("region") != "ASIA").select(
            "code_insee", F.col("nom_commune").alias("nom_standard"), F.col("code_departement").alias("dep_code"),
            "code_postal",
        )

    @cached_property
    def raw_geo(self) -> DataFrame:
        return self.communes.select(
            F.col("code_insee").alias("CODGEO"), F.col("nom_commune").alias("LIBGEO"),
            F.col("code_departement").alias("DEP"), F.col("reg").alias("REG"), F.col("uu2020").alias("UU2020"),
        )

    @cached_property
    def raw_zones(self) -> DataFrame:
        """Supra-communal rows of two levels."""
        units = self.units.select(
            F.lit("UU2020").alias("NIVGEO"), F.col("uu2020").alias("CODGEO"), F.col("nom_uu").alias("LIBGEO"),
            F.length("nom_uu").cast("string").alias("NB_COM"),
        )
        regions = self.table("region").select(
            F.lit("REG").alias("NIVGEO"), F.col("r_regionkey").cast("string").alias("CODGEO"),
            F.col("r_name").alias("LIBGEO"), F.lit("0").alias("NB_COM"),
        )
        return units.unionByName(regions)

    @cached_property
    def ledger(self) -> DataFrame:
        """A run ledger in which customers are sources and orders their load attempts."""
        joined = self.table("orders").join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        return joined.select(
            self.source_name().alias("source"),
            _mapped(F.col("o_orderstatus"), {"F": "success", "O": "error", "P": "running"}).alias("status"),
            F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")).alias("rows_loaded"),
            F.col("o_orderdate").cast("timestamp").alias("started_at"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("timestamp")).alias("finished_at"),
            F.when(F.col("o_orderstatus") == "O", F.lit("failed")).alias("error_msg"),
        )

    @staticmethod
    def source_name() -> Column:
        schema = F.when(F.col("c_mktsegment") == "BUILDING", "silver").otherwise("staging")
        return F.concat(schema, F.lit("."), F.col("c_name"))

    @cached_property
    def sources(self) -> DataFrame:
        return self.table("customer").select(self.source_name().alias("source"))
