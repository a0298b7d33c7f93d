"""Best candidate by name similarity, without scoring every pair.

Names meet candidates over shared letter pairs, an inverted index. The number of
shared pairs bounds the score (``bound``): a name's most promising candidates are
scored first, then only those whose bound reaches the best score so far, and of
the candidates that share no pair only those of lengths at which such a score is
possible at all. What is left out cannot be the best.

``nearest`` packs candidates into lists of bounded length instead; a left row
meets each list once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import similarity

LIST_LENGTH = 256
#: Candidates of each name that are scored before any is left out.
FIRST = 4


def _listed(left: DataFrame, candidates: DataFrame, keys: list[str], spread: str, packed: list) -> DataFrame:
    """Left rows beside each list (``_packed``) of their key's candidates.

    The number of lists follows the number of candidates, so a list stays near
    ``LIST_LENGTH``; rows and lists meet by key and list number.
    """
    count = F.ceil(F.count(F.lit(1)) / F.lit(LIST_LENGTH)).cast("int").alias("_lists")
    if keys:
        lists = candidates.groupBy(*keys).agg(count)
        candidates, left = candidates.join(lists, keys), left.join(lists, keys)
    else:  # one number for all rows: a scalar subquery, so that rows and lists still meet by list number
        number = candidates.agg(count).scalar()
        candidates, left = candidates.withColumn("_lists", number), left.withColumn("_lists", number).where("_lists > 0")
    filled = (
        candidates
        .withColumn("_list", F.pmod(F.xxhash64(spread), F.col("_lists")).cast("int"))
        .groupBy(*keys, "_list")
        .agg(F.sort_array(F.collect_list(F.struct(*packed))).alias("_packed"))
    )
    asked = left.withColumn(
        "_list", F.explode(F.sequence(F.lit(0), F.col("_lists") - 1))
    ).drop("_lists")
    return asked.join(filled, [*keys, "_list"])


def bound(shorter: Column, shared: Column) -> Column:
    """The score that names can reach at most, from the shorter one's length m and their shared letter pairs c.

    Let l letters of the shorter name match in a window of w letters. Dropping
    the other m - l letters breaks at most two of its m - 1 pairs each, putting
    in the window's other w - l breaks one each, and the rest are shared: so
    l <= (c + m + 1 + w) / 3, and l <= w. 200 l / (m + w) is then greatest where
    both are equal, at w = (c + m + 1) / 2, or at w = m if that is less.
    """
    w = F.least(shorter.cast("double"), (shared + shorter + 1) / 2)
    return F.when(shorter < 2, 100.0).otherwise(200.0 * w / (shorter + w) + 1e-9)


def _pairs_of(name: Column) -> Column:
    """(pair, number) of the name's letter pairs: a pair that comes twice has the numbers 1 and 2."""
    places = F.sequence(F.lit(1), F.greatest(F.length(name) - 1, F.lit(1)))
    pairs = F.when(F.length(name) > 1, F.transform(places, lambda i: F.substring(name, i, F.lit(2)))).otherwise(F.array().cast("array<string>"))
    return F.transform(F.array_sort(pairs), lambda p, i: F.struct(p.alias("pair"), (i - F.array_position(F.array_sort(pairs), p)).alias("number")))


def sharing(left: DataFrame, candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, name, other, most): names and distinct candidate names with a common letter pair, and the bound of their score.

    Every name has a row more, without a candidate.
    """
    keys = list(keys)
    mine = left.select(*keys, "name").distinct().select(*keys, "name", F.explode_outer(_pairs_of(F.col("name"))).alias("_pair"))
    theirs = candidates.select(*keys, F.col("name").alias("other")).distinct().select(*keys, "other", F.explode(_pairs_of(F.col("other"))).alias("_pair"))
    met = mine.join(theirs, [*keys, "_pair"], "left").select(*keys, "name", F.explode(F.array_distinct(F.array("other", F.lit(None)))).alias("other"))
    counted = met.groupBy(*keys, "name", "other").agg(F.count(F.lit(1)).alias("_shared"))
    shorter = F.least(F.length("name"), F.length("other"))
    return counted.select(*keys, "name", "other", F.when(F.col("other").isNotNull(), bound(shorter, F.col("_shared"))).alias("most"))


def scored(left: DataFrame, candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, name, other, score): every pair that had to be scored; the best of each name is among them.

    ``left`` is read once: a name's row without a candidate asks for the lengths
    at which candidates without a common pair may still reach its best score.
    """
    keys = list(keys)
    by = [*keys, "name"]
    order = Window.partitionBy(*by).orderBy(F.desc_nulls_last("most"), "other")
    ranked = sharing(left, candidates, keys).withColumn("_rn", F.row_number().over(order))
    # A function in Python is called for every row, whatever condition stands around it: rows without need get no name.
    first = ranked.withColumn("score", similarity(F.when(F.col("_rn") <= FIRST, F.col("name")), F.col("other")))
    first = first.withColumn("_best", F.max("score").over(Window.partitionBy(*by)))
    longest = candidates.agg(F.max(F.length("name"))).scalar()
    first = first.withColumn("_lengths", F.sequence(F.lit(0), F.coalesce(longest, F.lit(0))))

    ask = lambda other, score, length: F.struct(other.alias("other"), score.alias("score"), length.alias("length"))
    reach = F.filter("_lengths", lambda n: F.coalesce(bound(F.least(n, F.length("name")), F.lit(0)) >= F.col("_best"), F.lit(True)))
    far = F.transform(reach, lambda n: ask(F.lit(None).cast("string"), F.lit(None).cast("double"), n))
    near = F.array(ask(F.col("other"), F.col("score"), F.lit(None).cast("int")))
    wanted = F.when(F.col("other").isNull(), far).when((F.col("_rn") <= FIRST) | (F.col("most") >= F.col("_best")), near)
    asked = first.select(*by, F.explode(wanted).alias("_ask")).select(*by, F.col("_ask.other").alias("_near"), "_ask.score", F.col("_ask.length").alias("_length"))

    others = candidates.select(*keys, F.col("name").alias("_far"), F.length("name").alias("_length")).distinct()
    met = asked.join(others, [*keys, "_length"], "left").withColumn("other", F.coalesce("_near", "_far")).where("other is not null")
    return met.select(*by, "other", F.coalesce("score", similarity(F.when(F.col("score").isNull(), F.col("name")), F.col("other"))).alias("score"))


def best_match(left: DataFrame, candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Best candidate for every ``(keys, name)`` of ``left``.

    ``candidates`` has the keys, ``name``, ``code``, ``label`` and ``votes``. Equal
    scores go to more votes, then to the lower code. Rows of ``left`` whose keys
    have no candidate are absent from the result.
    """
    keys = list(keys)
    by = [*keys, "name"]
    pairs = scored(left, candidates, keys)
    named = candidates.select(*keys, F.col("name").alias("other"), "code", "label", "votes")
    best = pairs.join(named, [*keys, "other"]).groupBy(*by).agg(
        F.min(F.struct((-F.col("score")).alias("against"), (-F.col("votes")).alias("fewer"), "code", "label")).alias("_w"))
    return best.select(*by, F.col("_w.code").alias("code"), F.col("_w.label").alias("label"), (-F.col("_w.against")).alias("score"), (-F.col("_w.fewer")).alias("votes"))


def nearest(left: DataFrame, candidates: DataFrame, keys: Sequence[str], text: str, name: str) -> DataFrame:
    """Candidate ``name`` with the least edit distance to ``text``, and the distance.

    Equal distances go to the first name in order.
    """
    keys = list(keys)
    asked = left.select(*keys, text).distinct()
    listed = _listed(asked, candidates.select(*keys, name).distinct(), keys, name, [name])
    local = F.array_min(
        F.transform("_packed", lambda c: F.struct(F.levenshtein(F.col(text), c[name]).alias("distance"), c[name].alias(name)))
    )
    best = listed.groupBy(*keys, text).agg(F.min(local).alias("_w"))
    return best.select(*keys, text, F.col(f"_w.{name}").alias(name), F.col("_w.distance").alias("distance"))
