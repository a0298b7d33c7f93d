"""Geographic and survey codes. Codes are strings: leading zeros matter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shape of a commune code, and the codes of the three cities
# whose districts are rolled up.
COMMUNE_CODE = r"^(\d{5}|2[AB]\d{3})$"
PARIS, LYON, MARSEILLE = "75056", "69123", "13055"
ID_MODULUS = 2_000_000_000


def zero_pad(c: Column, width: int) -> Column:
    """Left pad with zeros; longer values stay whole (``lpad`` alone cuts them)."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def commune_code(department: Column, commune: Column) -> Column:
    """Department (two places, ``2A``/``2B`` included) followed by commune (three)."""
    dep = F.trim(department.cast("string"))
    com = F.trim(commune.cast("string"))
    return F.concat(zero_pad(dep, 2), zero_pad(com, 3))


def is_commune_code(c: Column) -> Column:
    return c.rlike(COMMUNE_CODE)


def merge_districts(c: Column) -> Column:
    """City code for the district codes of Paris, Lyon and Marseille."""
    return (
        F.when(c.rlike("^751..$"), PARIS)
        .when(c.rlike("^6938.$"), LYON)
        .when(c.rlike(r"^132\d\d$") & (c >= "13201"), MARSEILLE)
        .otherwise(c)
    )


def postal_code(c: Column) -> Column:
    """Five places from a number or text; NULL where there is no usable number."""
    number = c.cast("string").try_cast("double")
    whole = F.coalesce(F.when(~F.isnan(number) & (F.abs(number) < 1e15), number), F.lit(0.0)).cast("bigint")
    return F.nullif(zero_pad(whole.cast("string"), 5), F.lit("00000"))


def stable_id(c: Column) -> Column:
    """md5 of the text, read as one number, modulo two thousand million.

    The digest is folded 32 bits at a time; remainder times 2**32 still fits a
    bigint, so no step overflows.
    """
    digest = F.md5(c.cast("binary"))
    words = [F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint") for start in (1, 9, 17, 25)]
    rest = words[0] % ID_MODULUS
    for word in words[1:]:
        rest = (rest * F.lit(1 << 32) + word) % ID_MODULUS
    return rest.cast("int")
