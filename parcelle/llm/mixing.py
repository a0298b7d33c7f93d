"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over training time 0..1. Its integral up
to t, scaled to the source's target, is the source's cumulative demand; the
inverse of that integral turns a document's place in its source into the time
at which it is due. Documents are then range-sorted by that time, and the query
reads its figures from the order so written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, table, word_count

WEIGHTS = (5, 2, 1)
SHARE, LIMIT = 1.5, 2.0
#: (weight at the start, weight at the end) of the linear schedules, dealt to the sources in turn.
RAMPS = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
#: A source is split by a hash of doc_id into 16**3 ranges, summed first and then run through one by one.
RANGE_DIGITS = 3


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """(source, source_size, place, target) of (source, source_size), one row per source.

    Weights repeat in code-point order, null last. A source is full if the
    level that fills it costs no more than the total; the other sources divide
    the rest by weight. That is the fixed point of resharing the excess.
    """
    everything = Window.partitionBy()
    filling = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    x = (
        sizes.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
        .withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(limit)))
        .withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("level", F.sum("most").over(filling) + F.col("ratio") * (F.sum("weight").over(everything) - F.sum("weight").over(filling)))
        .withColumn("full", F.col("level") <= F.col("total"))
    )
    left = F.col("total") - F.sum(F.when(F.col("full"), F.col("most")).otherwise(0.0)).over(everything)
    open_weight = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(everything)
    target = F.when(F.col("full"), F.col("most")).otherwise(F.least(F.col("most"), left * F.col("weight") / open_weight))
    return x.select("source", "source_size", "place", F.round(target, 6).alias("target"))


def due(fraction: Column, place: Column, ramps=RAMPS) -> Column:
    """Time at which a source's schedule has used up this fraction of its demand.

    The integral of a linear ramp from a to b is quadratic; this is its
    inverse in the form that also holds for a = b.
    """
    pick = lambda k: F.element_at(F.array(*[F.lit(float(r[k])) for r in ramps]), (place % len(ramps) + 1).cast("int"))
    a, b = pick(0), pick(1)
    return fraction * (a + b) / (a + F.sqrt(a * a + (b * b - a * a) * fraction))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT, ramps=RAMPS) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, start, passes.

    ``passes`` lists (pass, words, position) for every time the document is
    taken: whole in full passes over its source, and in the last pass until
    the target is met, so that a source's words sum to its rounded target. The
    order within a source is that of md5(doc_id), then doc_id and size, so
    reruns agree. Size is the word count; null text has size 0 and no pass. A
    null source is a source of its own. Repeated rows count each. ``start`` is
    the number of words before the document in its source: with the source it
    tells all documents with words apart.

    Cumulative sizes: sums per source and hash range, then a running sum
    inside each range; a source with a third of the corpus is 4096 ranges.
    """
    by = ["source", "range"]
    x = docs.select(
        F.col("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("order"),
    ).withColumn("range", F.substring("order", 1, RANGE_DIGITS))
    ranges = x.groupBy(*by).agg(F.sum("size").alias("range_size"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(*by, F.coalesce(F.sum("range_size").over(before), F.lit(0)).alias("range_start"))
    targets = source_targets(ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, share, limit)
    starts = starts.alias("s").join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source"))).select(
        F.col("s.source").alias("s_source"), F.col("range").alias("s_range"), "range_start", "source_size", "place", "target")
    inside = Window.partitionBy(*by).orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        x.withColumn("inside", F.sum("size").over(inside) - F.col("size"))
        .join(starts, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("range") == F.col("s_range")))
        .withColumn("start", F.col("range_start") + F.col("inside"))
        .withColumn("demand", F.round("target").cast("long"))
        .withColumn("full", F.when(F.col("source_size") > 0, F.floor(F.col("demand") / F.col("source_size"))).otherwise(0).cast("int"))
        .withColumn("rest", F.greatest(F.lit(0), F.least("size", F.col("demand") - F.col("full") * F.col("source_size") - F.col("start"))))
    )

    def one(p: Column) -> Column:
        words = F.when(p < F.col("full"), F.col("size")).otherwise(F.col("rest")).cast("long")
        middle = p.cast("double") * F.col("source_size") + F.col("start") + words / 2.0
        return F.struct(p.alias("pass"), words.alias("words"), due(middle / F.col("demand"), F.col("place"), ramps).alias("position"))

    passes = F.filter(F.transform(F.sequence(F.lit(0), F.col("full")), one), lambda r: r["words"] > 0)
    return placed.select("doc_id", "source", "size", "source_size", "target", "start", passes.alias("passes"))


def training_order(mixed: DataFrame, untaken: bool = False, also: Sequence[str] = ()) -> DataFrame:
    """One row per document and pass, range-sorted by position: (position, doc_id, source, pass, words) and the columns ``also``.

    With ``untaken`` a document without a pass has a row too, behind all others
    and without position, pass and words.
    """
    each = F.explode_outer if untaken else F.explode
    rows = mixed.select("doc_id", "source", *also, each("passes").alias("p")).select(
        F.col("p.position").alias("position"), "doc_id", "source", F.col("p.pass").alias("pass"), F.col("p.words").alias("words"), *also)
    return rows.orderBy(F.asc_nulls_last("position"), "doc_id", "pass")


def op7_mixing(spark, folder: str) -> DataFrame:
    """Every document with what the stored training order holds of it."""
    sizes = ["size", "source_size", "target"]
    order = stored(training_order(mix(table(spark, folder, "documents")), untaken=True, also=[*sizes, "start"]), "training-order")
    taken = order.filter("position is not null").groupBy("doc_id", "source", "start", *sizes).agg(
        F.sum("words").alias("taken"), F.round(F.min("position"), 9).alias("first_position"))
    none = order.filter("position is null").select("doc_id", *sizes, F.lit(0).cast("long").alias("taken"), F.lit(None).cast("double").alias("first_position"))
    return taken.select(*none.columns).unionByName(none)


_SIZED = """SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '')) AS h FROM documents"""
_RAMP = "CASE place % 3 WHEN 0 THEN {0} WHEN 1 THEN {1} ELSE {2} END::DOUBLE"
_A, _B = _RAMP.format(1.5, 1.0, 0.5), _RAMP.format(0.5, 1.0, 1.5)
OP7_SQL = f"""WITH d AS ({_SIZED}),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight,
  row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place, source_size * 2.0::DOUBLE AS most, (sum(source_size) OVER ())::DOUBLE * 1.5 AS total FROM s),
l AS (SELECT *, sum(most) OVER f + most / weight * (sum(weight) OVER () - sum(weight) OVER f) <= total AS is_full FROM w
  WINDOW f AS (ORDER BY most / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
t AS (SELECT source, source_size, place, round(CASE WHEN is_full THEN most ELSE least(most,
  (total - sum(CASE WHEN is_full THEN most ELSE 0 END) OVER ()) * weight / sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ()) END, 6)::DOUBLE AS target FROM l),
p AS (SELECT d.doc_id, size, source_size, target, place, round(target)::BIGINT AS demand,
  (sum(size) OVER (PARTITION BY d.source ORDER BY h, d.doc_id, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, CASE WHEN source_size > 0 THEN demand // source_size ELSE 0 END AS k FROM p),
r AS (SELECT *, greatest(0, least(size, demand - k * source_size - start))::BIGINT AS rest FROM q),
m AS (SELECT *, CASE WHEN size > 0 AND k > 0 THEN size WHEN rest > 0 THEN rest END AS first_words FROM r),
u AS (SELECT *, {_A} AS a, {_B} AS b, (start + first_words / 2.0) / demand AS f FROM m)
SELECT doc_id, size, source_size, target, (k * size + rest)::BIGINT AS taken, round(f * (a + b) / (a + sqrt(a * a + (b * b - a * a) * f)), 9)::DOUBLE AS first_position FROM u"""
