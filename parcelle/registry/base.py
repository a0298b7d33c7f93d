"""Registration, and the shared parts of the expected-result SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..functions.numbers import NOISE
from ..sources.starschema import YEAR_FLOOR, Star


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


@dataclass
class Section:
    entries: dict[str, Query] = field(default_factory=dict)

    def __call__(self, sql: str | None = None):
        """Register the decorated function, which takes a ``Star``, under its own name."""

        def add(build: Callable[[Star], DataFrame]):
            self.entries[build.__name__] = Query(
                lambda spark, folder: build(Star(spark, folder)), None if sql is None else with_parts(sql)
            )
            return build

        return add


def pad(x: str, width: int) -> str:
    return f"lpad(({x})::VARCHAR, greatest({width}, length(({x})::VARCHAR))::INT, '0')"


def rnd(x: str, places: int) -> str:
    return f"round((({x})::DOUBLE * {1 + NOISE!r})::DECIMAL(38,10), {places})::DOUBLE"


def rnde(x: str, places: int) -> str:
    """Half to even."""
    return f"round_even(({x})::DECIMAL(38,6), {places})::DOUBLE"


def sid(x: str) -> str:
    """Stable id: md5 hex folded digit by digit."""
    return (
        f"list_reduce(range(1, 33), lambda a, i: (a * 16 + strpos('0123456789abcdef', substr(md5({x}), i::INT, 1)) - 1)"
        " % 2000000000, 0::BIGINT)::INT"
    )


def bare(x: str) -> str:
    """Name without brackets, generic opening and outer spaces, lower case."""
    # Fixed value: the generic openings of agglomeration names.
    opening = (
        "agglom[eé]ration\\s+(de\\s+l[a'']?|d[u'']?\\s+|des\\s+|de\\s+)?|"
        "communaut[eé]\\s+d.agglom[eé]ration\\s+(de\\s+|du\\s+|d[e'']?\\s+)?|"
        "eurom[eé]tropole\\s+(de\\s+)?|"
        "unit[eé]\\s+urbaine\\s+(de\\s+l.)?agglom[eé]ration\\s+(de\\s+)?|"
        "communaut[eé]s?\\s+de\\s+communes?\\s+"
    )
    return f"lower(trim(regexp_replace(regexp_replace({x}, '\\(.*?\\)', '', 'g'), '{opening}', '', 'gi')))"


def scored(pairs: str) -> str:
    """Best-window similarity of the pairs (a, b).

    The row of unmatched letters is a bit set, one bit per letter of the shorter
    name; names of equal length are tried both ways.
    """
    return f"""SELECT a, b, max(200.0 * (length(s) - bit_count(list_reduce(masks,
            lambda r, x: ((r + (r & x)) | (r - (r & x))) & whole, whole))) / (length(s) + length(w))) AS score
        FROM (SELECT a, b, s, w, (1::BIGINT << length(s)::INT) - 1 AS whole,
              list_transform(string_split(w, ''), lambda c: list_sum(list_transform(range(1, length(s) + 1),
              lambda i: CASE WHEN substr(s, i, 1) = c THEN 1::BIGINT << (i - 1)::INT ELSE 0::BIGINT END))::BIGINT) AS masks
              FROM (SELECT a, b, s, substr(l, greatest(1, e - length(s) + 1)::INT,
                    (least(e, length(l)) - greatest(1, e - length(s) + 1) + 1)::INT) AS w
                    FROM (SELECT *, unnest(range(1, length(s) + length(l))) AS e FROM
                          (SELECT a, b, CASE WHEN length(a) <= length(b) THEN a ELSE b END AS s,
                                  CASE WHEN length(a) <= length(b) THEN b ELSE a END AS l FROM ({pairs})
                           UNION ALL SELECT a, b, b, a FROM ({pairs}) WHERE length(a) = length(b))))) GROUP BY a, b"""


AGGLO = (
    "CASE c_mktsegment WHEN 'MACHINERY' THEN 'Zone rurale de ' || n_name"
    " WHEN 'BUILDING' THEN 'Eurométropole de ' || r_name || ' BUILDING ' || n_nationkey"
    " ELSE 'Agglomération de ' || c_mktsegment || ' ' || n_name END"
)
TYPE_LOCAL = "CASE l_returnflag WHEN 'A' THEN 'Appartement' WHEN 'R' THEN 'Maison' ELSE 'Local industriel' END"
ROOMS = (
    "CASE o_orderpriority WHEN '1-URGENT' THEN '1P' WHEN '2-HIGH' THEN '2P' WHEN '3-MEDIUM' THEN '3P'"
    " WHEN '4-NOT SPECIFIED' THEN '4P+' ELSE 'Tous' END"
)
HABITAT = "CASE o_orderstatus WHEN 'F' THEN 'Appartement' WHEN 'O' THEN 'Maison' ELSE 'Ensemble' END"
SOURCE = "CASE WHEN c_mktsegment = 'BUILDING' THEN 'silver' ELSE 'staging' END || '.' || c_name"

MED = "percentile_cont(0.5) WITHIN GROUP (ORDER BY prix_m2)"
EFFORT = "rent / nullif({d} / 12, 0) * 100"

# Named parts: a query's text may use any of them by name.
PARTS = {
    "g_nations": "SELECT * FROM nation JOIN region ON r_regionkey = n_regionkey",
    "g_communes": f"""SELECT {pad('s_suppkey', 5)} AS code_insee, s_name AS nom_commune,
        {pad('s_suppkey + 1', 5)} AS code_postal, n_nationkey::VARCHAR AS code_departement, r_name AS region,
        {pad('n_nationkey * 1000', 5)} AS uu2020, r_name AS reg
        FROM supplier JOIN g_nations ON n_nationkey = s_nationkey""",
    "g_sales": f"""SELECT {pad('l_suppkey', 5)} AS code_insee, year(l_shipdate)::INT AS annee, {TYPE_LOCAL} AS type_local,
        CASE l_linestatus WHEN 'O' THEN 'Vente' ELSE 'Echange' END AS nature_mutation,
        l_extendedprice AS valeur_fonciere, l_quantity AS surface_bati, l_linenumber AS nombre_pieces,
        l_extendedprice / l_quantity AS prix_m2 FROM lineitem""",
    "g_customers": "SELECT * FROM customer JOIN g_nations ON n_nationkey = c_nationkey",
    "g_agglos": f"""SELECT {sid('nom_agglomeration')} AS id_agglomeration, nom_agglomeration
        FROM (SELECT DISTINCT {AGGLO} AS nom_agglomeration FROM g_customers)""",
    "g_rents": f"""SELECT 'B' || {pad('n_nationkey', 2)} AS observatory_b, id_agglomeration, nom_agglomeration,
        year(o_orderdate)::INT AS annee, {HABITAT} AS type_habitat, {ROOMS} AS nombre_pieces,
        o_totalprice AS loyer_mensuel_median, o_totalprice / 50 AS loyer_median_m2, o_orderkey
        FROM orders JOIN (SELECT *, {AGGLO} AS nom_agglomeration FROM g_customers) ON c_custkey = o_custkey
        JOIN g_agglos USING (nom_agglomeration)""",
    "g_obs": f"SELECT DISTINCT 'B' || {pad('c_nationkey', 2)} AS observatory_b FROM customer",
    "g_incomes": f"""SELECT {pad('l_suppkey', 5)} AS code_insee, year(l_shipdate)::INT AS annee,
        sum(l_extendedprice) AS revenu_median, sum(l_extendedprice) / 12 AS revenu_mensuel
        FROM lineitem GROUP BY l_suppkey, year(l_shipdate)""",
    "g_bridge": f"""SELECT {pad('s_suppkey', 5)} AS code_insee, 'B' || {pad('k', 2)} AS observatory_b
        FROM (SELECT s_suppkey, unnest([s_nationkey, s_nationkey + 5]) AS k FROM supplier WHERE s_acctbal >= 0)
        WHERE k IN (SELECT n_nationkey FROM nation)""",
    "g_units": f"""SELECT {pad('n_nationkey * 1000', 5)} AS uu2020,
        CASE r_name WHEN 'MIDDLE EAST' THEN 'Communes hors unité ' || n_name
        ELSE n_name || ' (' || r_name || ')' END AS nom_uu FROM g_nations""",
    "g_prices": f"""SELECT code_insee, nom_commune, code_departement, annee, type_local,
        {rnd('med', 2)} AS prix_m2_median, {rnd('mean', 2)} AS prix_m2_moyen, n AS nb_transactions,
        {rnd('area', 2)} AS surface_moyenne, {rnd('lag(med) OVER y', 2)} AS prix_m2_annee_precedente,
        {rnd('(med - lag(med) OVER y) / nullif(lag(med) OVER y, 0) * 100', 2)} AS evolution_annuelle_pct,
        {rnd('avg(med) OVER (y ROWS 2 PRECEDING)', 2)} AS moving_avg_3ans
        FROM (SELECT code_insee, annee, type_local, {MED} AS med, avg(prix_m2) AS mean, count(*) AS n,
              avg(surface_bati) AS area FROM g_sales WHERE prix_m2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10)
        JOIN g_communes USING (code_insee) WINDOW y AS (PARTITION BY code_insee, type_local ORDER BY annee)""",
    "g_ratios": f"""SELECT observatory_b, nom_agglomeration, annee, type_habitat, nombre_pieces,
        {rnd('m2', 2)} AS loyer_median_m2, {rnd('rent', 2)} AS loyer_mensuel_median,
        {rnd('year_income', 2)} AS revenu_median_moyen, {rnd('month_income', 2)} AS revenu_mensuel_moyen,
        {rnd('rent / nullif(month_income, 0) * 100', 2)} AS ratio_tension_pct
        FROM (SELECT observatory_b, nom_agglomeration, annee, type_habitat, nombre_pieces, avg(loyer_median_m2) AS m2,
              avg(loyer_mensuel_median) AS rent FROM g_rents GROUP BY ALL)
        JOIN (SELECT observatory_b, avg(revenu_median) AS year_income, avg(revenu_mensuel) AS month_income
              FROM g_incomes JOIN g_bridge USING (code_insee)
              WHERE annee = (SELECT max(annee) FROM g_incomes) GROUP BY 1) USING (observatory_b)""",
    "g_signal": """SELECT code_insee, annee, avg(ratio_tension_pct) AS ratio_tension_pct
        FROM g_ratios JOIN g_bridge USING (observatory_b) GROUP BY ALL""",
    "g_market": f"""SELECT code_insee, nom_commune, code_departement, annee, type_local, count(*) AS nb_transactions,
        {rnd(MED, 2)} AS prix_m2_moyen, {rnd('sum(valeur_fonciere)', 2)} AS volume_total
        FROM g_sales JOIN g_communes USING (code_insee)
        WHERE type_local <> 'Local industriel' AND annee >= {YEAR_FLOOR} GROUP BY ALL HAVING count(*) >= 10""",
    "g_rising": f"""SELECT *, percent_rank() OVER (PARTITION BY annee, type_local ORDER BY nb_transactions) * 100 AS volume,
        CASE WHEN lag(prix_m2_moyen) OVER y >= 500 AND annee - lag(annee) OVER y <= 1
             AND least(nb_transactions, lag(nb_transactions) OVER y) >= 25
             THEN {rnd('(prix_m2_moyen - lag(prix_m2_moyen) OVER y) / lag(prix_m2_moyen) OVER y * 100', 2)} END
        AS hausse_prix_pct
        FROM g_market WINDOW y AS (PARTITION BY code_insee, type_local ORDER BY annee)""",
    "g_tension": f"""SELECT * EXCLUDE (volume), CASE WHEN score_tension >= 75 THEN 'Très tendu'
        WHEN score_tension >= 50 THEN 'Tendu' WHEN score_tension >= 25 THEN 'Modéré' ELSE 'Détendu' END AS categorie_tension
        FROM (SELECT *, {rnd('''CASE WHEN ratio_tension_pct IS NULL
            THEN least(greatest(coalesce(hausse_prix_pct, 0), 0), 20) * 3.0 + volume * 0.4
            ELSE least(ratio_tension_pct, 100) * 0.4 + least(greatest(coalesce(hausse_prix_pct, 0), 0), 20) * 1.75
                 + volume * 0.25 END''', 1)} AS score_tension
        FROM g_rising LEFT JOIN g_signal USING (code_insee, annee))""",
    "g_trend": f"""SELECT observatory_b, nom_agglomeration, annee, type_habitat, nombre_pieces, ratio_tension_pct,
        lag(ratio_tension_pct) OVER y AS ratio_annee_precedente,
        {rnd('ratio_tension_pct - lag(ratio_tension_pct) OVER y', 2)} AS evolution_ratio
        FROM g_ratios WHERE ratio_tension_pct IS NOT NULL WINDOW y AS
        (PARTITION BY observatory_b, nom_agglomeration, type_habitat, nombre_pieces ORDER BY annee)""",
    "g_profiles": """SELECT observatory_b, annee, percentile_cont(0.1) WITHIN GROUP (ORDER BY revenu_median) AS d1,
        percentile_cont(0.5) WITHIN GROUP (ORDER BY revenu_median) AS d5,
        percentile_cont(0.9) WITHIN GROUP (ORDER BY revenu_median) AS d9, avg(revenu_median) AS mean
        FROM g_incomes JOIN g_bridge USING (code_insee) GROUP BY ALL""",
    "g_ineg": f"""SELECT observatory_b, nom_agglomeration, annee, type_habitat, {rnd('d1', 2)} AS revenu_d1,
        {rnd('d5', 2)} AS revenu_median, {rnd('d9', 2)} AS revenu_d9, {rnd('d9 / nullif(d1, 0)', 2)} AS ratio_d9_d1,
        {rnd('mean', 2)} AS revenu_median_moyen, {rnd('rent', 2)} AS loyer_mensuel_moyen,
        {rnd(EFFORT.format(d='d1'), 1)} AS taux_effort_modeste_pct,
        {rnd(EFFORT.format(d='d5'), 1)} AS taux_effort_median_pct,
        {rnd(EFFORT.format(d='d9'), 1)} AS taux_effort_aise_pct,
        {rnd('rent * 12 / nullif(mean, 0) * 100', 2)} AS part_loyer_annuel_pct,
        income_before AS revenu_annee_precedente, evolution_revenu_pct,
        rent_before AS loyer_annee_precedente, evolution_loyer_pct
        FROM (SELECT *, lag(mean) OVER y AS income_before, CASE WHEN annee - lag(annee) OVER y <= 1 THEN
                {rnd('(mean - lag(mean) OVER y) / nullif(lag(mean) OVER y, 0) * 100', 2)} END AS evolution_revenu_pct
              FROM g_profiles WINDOW y AS (PARTITION BY observatory_b ORDER BY annee))
        JOIN (SELECT *, lag(rent) OVER y AS rent_before, CASE WHEN annee - lag(annee) OVER y <= 1 THEN
                {rnd('(rent - lag(rent) OVER y) / nullif(lag(rent) OVER y, 0) * 100', 2)} END AS evolution_loyer_pct
              FROM (SELECT observatory_b, nom_agglomeration, annee, type_habitat, avg(loyer_mensuel_median) AS rent
                    FROM g_rents WHERE type_habitat <> 'Ensemble' GROUP BY ALL)
              WINDOW y AS (PARTITION BY observatory_b, nom_agglomeration, type_habitat ORDER BY annee))
        USING (observatory_b, annee)""",
    "g_inequality": """SELECT *,
        rank() OVER (PARTITION BY annee, type_habitat ORDER BY taux_effort_modeste_pct NULLS LAST)::INT AS rang_accessibilite_modeste,
        rank() OVER (PARTITION BY annee, type_habitat ORDER BY taux_effort_median_pct NULLS LAST)::INT AS rang_accessibilite_median,
        rank() OVER (PARTITION BY annee, type_habitat ORDER BY taux_effort_aise_pct NULLS LAST)::INT AS rang_accessibilite_aise
        FROM g_ineg""",
    "g_votes": """SELECT observatory_b, uu2020, nom_uu, count(*) AS votes
        FROM g_bridge JOIN g_communes USING (code_insee) JOIN g_units USING (uu2020)
        WHERE uu2020 <> '01000' AND nom_uu NOT ILIKE 'Communes hors%' GROUP BY ALL""",
    "g_towns": f"""SELECT DISTINCT observatory_b, id_agglomeration, nom_agglomeration, {bare('nom_agglomeration')} AS name
        FROM g_rents WHERE nom_agglomeration NOT ILIKE '%rural%' AND nom_agglomeration NOT ILIKE '%hors%'""",
    "g_scores": scored(f"""SELECT DISTINCT t.name AS a, u.uname AS b FROM g_towns t
        CROSS JOIN (SELECT {bare('nom_uu')} AS uname FROM g_units) u"""),
    "g_mapping": f"""SELECT CASE WHEN wide THEN f_uu ELSE v_uu END AS uu2020, CASE WHEN wide THEN f_nom ELSE v_nom END AS nom_uu,
        observatory_b, id_agglomeration, nom_agglomeration,
        round_even(CASE WHEN wide THEN f_score ELSE coalesce(v_score, 0) END, 1)::DOUBLE AS score_fuzzy,
        CASE WHEN wide THEN 0 ELSE votes END::INT AS nb_communes_vote
        FROM (SELECT t.*, v_uu, v_nom, votes, v_score, f_uu, f_nom, f_score,
                     coalesce(v_score, 0) < 70 AND f_score > coalesce(v_score, 0) AS wide
              FROM g_towns t
              LEFT JOIN (SELECT observatory_b, a, uu2020 AS v_uu, nom_uu AS v_nom, votes, score AS v_score
                         FROM g_votes JOIN g_scores ON b = {bare('nom_uu')}
                         QUALIFY row_number() OVER (PARTITION BY observatory_b, a ORDER BY score DESC, votes DESC, uu2020) = 1) v
                ON v.observatory_b = t.observatory_b AND v.a = t.name
              JOIN (SELECT a, uu2020 AS f_uu, nom_uu AS f_nom, score AS f_score FROM g_units JOIN g_scores ON b = {bare('nom_uu')}
                    QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, uu2020) = 1) f ON f.a = t.name)
        WHERE CASE WHEN wide THEN f_uu ELSE v_uu END IS NOT NULL""",
}


def with_parts(body: str) -> str:
    """The query text preceded by the named parts it uses, in order of need."""
    needed: dict[str, None] = {}

    def visit(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"\bg_\w+", text)):
            if name not in needed and name in PARTS:
                visit(PARTS[name])
                needed[name] = None

    visit(body)
    if not needed:
        return body.strip()
    parts = ",\n".join(f"{name} AS ({PARTS[name]})" for name in needed)
    return f"WITH {parts}\n{body.strip()}"
