"""Shared parts of the operators: table access, words, document numbers, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

#: White space between words: space, tab, line feed, vertical tab, form feed, carriage return.
GAP = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
#: Document numbers below 2**NUMBER_BITS and offsets below 2**OFFSET_BITS share one long.
NUMBER_BITS, OFFSET_BITS = 33, 29


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words as long; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared folder and read back: computed once, safe when executors are lost.

    The write's shuffle files are no longer needed; the driver's garbage
    collection lets Spark's cleaner delete them before the next step adds its own.
    """
    spark = frame.sparkSession
    path = shared_folder(spark, purpose)
    frame.write.parquet(path)
    spark.sparkContext._jvm.java.lang.System.gc()
    return spark.read.schema(frame.schema).parquet(path)


def free_name(frame: DataFrame, wanted: str) -> str:
    """A column name not yet in the frame, whatever its letter case."""
    taken = {c.lower() for c in frame.columns}
    return wanted if wanted.lower() not in taken else f"{wanted}_{uuid.uuid4().hex[:8]}"


def numbered(docs: DataFrame, whole_rows: bool = False) -> DataFrame:
    """(n, doc_id, text): n is unique, never null, in the order of doc_id, and fits NUMBER_BITS with a sign.

    With ``whole_rows`` the given columns follow as the struct ``row``.

    Unique ids in range are their own numbers. Otherwise (null, repeated or
    huge ids) rows are numbered in the order of doc_id, nulls last, repeated
    ids by text; that numbering is stored, as a recomputed one could differ.
    """
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if whole_rows else []
    names = ["doc_id", "text"] + ["row"] * whole_rows
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *row)
    rows, given, low, high = docs.agg(
        F.count(F.lit(1)), F.count("doc_id"), F.min("doc_id"), F.max("doc_id")
    ).first()
    limit = 1 << NUMBER_BITS
    if rows == 0:
        return docs.select(F.col("doc_id").alias("n"), *names)
    if rows > limit:
        raise ValueError(f"{rows} rows do not fit numbers of {NUMBER_BITS} bits")
    if rows == given and -limit <= low and high < limit:
        repeated = docs.groupBy("doc_id").count().filter("count > 1").limit(1).count()
        if not repeated:
            return docs.select(F.col("doc_id").alias("n"), *names)
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stored(
        docs.repartitionByRange(parts, *order).sortWithinPartitions(*order, "text")
        .select(F.monotonically_increasing_id().alias("m"), *names),
        "numbered",
    ).withColumn("part", F.shiftright("m", 33))
    sizes = placed.groupBy("part").count().orderBy("part").collect()  # one row per partition
    starts, total = {}, 0
    for row in sizes:
        starts[row["part"]] = total
        total += row["count"]
    start = F.create_map(*[F.lit(x) for pair in starts.items() for x in pair])[F.col("part")]
    return placed.select((start + F.col("m").bitwiseAND(F.lit((1 << 33) - 1))).alias("n"), *names)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b): root is the smallest node of its component.

    Large-star and small-star steps in turn (Kiveris et al. 2014), each one
    stored; the edge count never grows, and hubs are grouped by minimum only.
    Raises if ``rounds`` steps do not settle, which logarithmic convergence
    makes impossible for real inputs.
    """
    e = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges")
    before = None
    for _ in range(rounds):
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").select(F.when(F.col("lo") == F.col("m"), F.col("hi")).otherwise(F.col("lo")).alias("hi"), F.col("m").alias("lo"))
        e = stored(small.filter("hi <> lo").distinct(), "edges")
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(e.select("lo", "lo").distinct())
