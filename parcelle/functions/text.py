"""Cleaning of names and labels."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Generic openings of agglomeration names, matched without case.
GENERIC_PREFIXES = (
    r"agglom[eé]ration\s+(de\s+l[a']?|d[u']?\s+|des\s+|de\s+)?|"
    r"communaut[eé]\s+d.agglom[eé]ration\s+(de\s+|du\s+|d[e']?\s+)?|"
    r"eurom[eé]tropole\s+(de\s+)?|"
    r"unit[eé]\s+urbaine\s+(de\s+l.)?agglom[eé]ration\s+(de\s+)?|"
    r"communaut[eé]s?\s+de\s+communes?\s+"
)
CITY_PREFIX = r"Agglomération (de |d'|du |des |)"
ROOMS_AND_MORE = r"\s*et\s+plus\s*$"
ZONING_FILE = r"_L(\d{1,2}[AB]\d{2}|\d{4})\.zip"
CONTROL_CHARACTERS = r"[\x00-\x1F\x7F-\x9F]"
ANY_SPACE = r"(?U)[\s\x1C-\x1F]+"


@F.pandas_udf(StringType())
def _nfkc(values: pd.Series) -> pd.Series:
    distinct = {v: unicodedata.normalize("NFKC", v) for v in values.dropna().unique()}
    return pd.Series([distinct.get(v) for v in values], dtype=object)


def nfkc(c: Column) -> Column:
    """Compatibility normal form; Spark has no built-in, so one Arrow batch function."""
    return _nfkc(c.cast("string"))


def strip_spaces(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def trim_upper(c: Column) -> Column:
    return F.trim(F.upper(c))


def clean_observatory_code(c: Column, unicode: bool = True) -> Column:
    """Normal form, no trailing ``.0``, no white space, upper case."""
    text = nfkc(c) if unicode else c.cast("string")
    return F.upper(F.regexp_replace(F.regexp_replace(text, r"\.0$", ""), ANY_SPACE, ""))


def clean_label(c: Column, unicode: bool = True) -> Column:
    """Normal form, no control characters, single spaces, no outer space."""
    text = nfkc(c) if unicode else c.cast("string")
    return F.trim(F.regexp_replace(F.regexp_replace(text, CONTROL_CHARACTERS, ""), ANY_SPACE, " "))


def null_token(c: Column) -> Column:
    """As text, with the text ``nan`` read as missing."""
    return F.nullif(c.cast("string"), F.lit("nan"))


def or_default(c: Column, default: str) -> Column:
    return F.coalesce(F.trim(c), F.lit(default))


def rooms_label(c: Column) -> Column:
    """``4P et plus`` becomes ``4P+``."""
    return F.trim(F.regexp_replace(c, ROOMS_AND_MORE, "+"))


def bare_name(c: Column) -> Column:
    """Name to compare: no brackets, no generic opening, trimmed, lower case."""
    short = F.regexp_replace(F.regexp_replace(c, r"\(.*?\)", ""), f"(?iu){GENERIC_PREFIXES}", "")
    return F.lower(strip_spaces(short))


def city_of(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, CITY_PREFIX, ""))


def zoning_code(c: Column) -> Column:
    """Observatory code held in the name of a zoning archive, NULL if none."""
    code = F.regexp_extract(c, f"(?i){ZONING_FILE}", 1)
    return F.when(code != "", F.concat(F.lit("B"), F.upper(code)))


def contains_ignore_case(c: Column, needle: Column) -> Column:
    """False, never NULL, for missing text."""
    return F.coalesce(F.lower(c).contains(F.lower(needle)), F.lit(False))


def _folding_table() -> tuple[str, str]:
    """Accented Latin letters and their plain letters, from the Unicode tables."""
    accented, plain = [], []
    for point in (*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)):
        letter = chr(point)
        parts = unicodedata.normalize("NFD", letter)
        if len(parts) > 1 and parts[0].isascii() and not any(p.isascii() for p in parts[1:]):
            accented.append(letter)
            plain.append(parts[0])
    return "".join(accented), "".join(plain)


_ACCENTED, _PLAIN = _folding_table()


def fold(c: Column) -> Column:
    """Plain lower-case ASCII: accents dropped, other non-ASCII characters removed.

    Text with as many bytes as characters is ASCII already.
    """
    plain = F.regexp_replace(F.translate(c, _ACCENTED, _PLAIN), r"[^\x00-\x7F]", "")
    return F.lower(F.when(F.octet_length(c) == F.length(c), c).otherwise(plain))


def fold_python(text: str) -> str:
    """The same folding for a search word typed by the user."""
    return unicodedata.normalize("NFD", text).encode("ascii", "ignore").decode().lower()


def contains_folded(c: Column, needle: str) -> Column:
    return F.coalesce(F.contains(fold(c), F.lit(fold_python(needle))), F.lit(False))
