"""Numbers: parsing, rounding, rates, scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Price per square metre kept, and the score's bands and weights.
PRICE_FLOOR, PRICE_CEILING = 500.0, 13731.0
RISE_CAP = 20.0
DEFAULT_VOLUME = 50.0
WEIGHTS_WITH_RENT = {"rent": 0.40, "rise": 0.35, "volume": 0.25}
WEIGHTS_WITHOUT_RENT = {"rise": 0.60, "volume": 0.40}
TENSION_BANDS = ((75, "Très tendu"), (50, "Tendu"), (25, "Modéré"))
TENSION_LOWEST = "Détendu"
ACCESS_BANDS = ((33, "🟢 Accessible"), (50, "🟡 Tendu"))
ACCESS_LAST = "🔴 Difficile"


def to_number(c: Column) -> Column:
    """Double from text with a decimal comma or point; NULL if it is no number.

    A letter ``d`` or ``f``, which a cast would take for a type suffix, is spoiled
    first. The argument occurs once, so a filter on the result parses it once.
    """
    text = F.translate(c.cast("string"), ",dDfF", ".xxxx")
    return F.nanvl(text.try_cast("double"), F.lit(None).cast("double"))


def secret_to_null(c: Column) -> Column:
    """``s`` marks a figure withheld for statistical secrecy."""
    return to_number(F.nullif(c.cast("string"), F.lit("s")))


#: What a floating sum may lose to the order of its terms, relative to the value.
NOISE = 1e-13


def exact_round(c: Column, places: int) -> Column:
    """Round once, half away from zero, in decimal arithmetic, back to double.

    Moving the value away from zero by ``NOISE`` first keeps a tie a tie whatever
    the order of the sum it comes from.
    """
    return F.round((c.cast("double") * F.lit(1 + NOISE)).cast("decimal(38,10)"), places).cast("double")


def even_round(c: Column, places: int) -> Column:
    """Round half to even, as the department and map figures are; ties are told at six decimals."""
    return F.bround(c.cast("decimal(38,6)"), places).cast("double")


def ratio(a: Column, b: Column) -> Column:
    """NULL when the divisor is zero."""
    return F.try_divide(a, b)


def change_pct(new: Column, old: Column) -> Column:
    return F.try_divide(new - old, old) * 100


def year_of(c: Column) -> Column:
    """Year of a ``DD/MM/YYYY`` text; NULL for an impossible date."""
    return F.year(F.try_to_date(c, "dd/MM/yyyy"))


def clamp(c: Column, low: float, high: float) -> Column:
    """A NULL value clamps to ``low``: greatest and least skip NULLs."""
    return F.least(F.greatest(c, F.lit(float(low))), F.lit(float(high)))


def rise_score(rise: Column) -> Column:
    """0 for no rise or none known, 100 from a rise of twenty percent."""
    return clamp(rise, 0, RISE_CAP) / RISE_CAP * 100


def tension_score(rent_ratio: Column, rise: Column, volume: Column) -> Column:
    """Weighted score; the rent share is spread over the others where it is unknown."""
    volume = F.coalesce(volume, F.lit(DEFAULT_VOLUME))
    bare = rise_score(rise) * WEIGHTS_WITHOUT_RENT["rise"] + volume * WEIGHTS_WITHOUT_RENT["volume"]
    full = (
        F.least(rent_ratio, F.lit(100.0)) * WEIGHTS_WITH_RENT["rent"]
        + rise_score(rise) * WEIGHTS_WITH_RENT["rise"]
        + volume * WEIGHTS_WITH_RENT["volume"]
    )
    return F.when(rent_ratio.isNull(), bare).otherwise(full)


def tension_band(score: Column) -> Column:
    return _banded(score, TENSION_BANDS, TENSION_LOWEST, at_least=True)


def access_band(effort: Column) -> Column:
    return _banded(effort, ACCESS_BANDS, ACCESS_LAST, at_least=False)


def _banded(c: Column, bands, last: str, at_least: bool) -> Column:
    chain = F
    for limit, label in bands:
        chain = chain.when(c >= limit if at_least else c < limit, label)
    return chain.otherwise(last)
