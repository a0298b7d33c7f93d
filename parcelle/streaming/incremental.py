"""Load only what is new: arrived files as a stream, or yearly files the ledger lacks.

Sales arrive as yearly files. One ``availableNow`` run takes the files not seen
before, cleans them, and appends the sales the table does not hold yet. Of bulk
copies that arrive in different runs the first to arrive stays, where a full load
keeps the first in column order; they differ in land area and culture only.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..plans import ledger
from ..plans.silver import SALE_KEY, fact_transactions
from ..operators.relational import dedup
from ..sources.readers import read_years, years_in_folder


def load_new_sales(
    spark: SparkSession, source: str, schema: StructType, communes: DataFrame, target: str, progress: str
) -> None:
    """Run once over what is new under ``source``; the folder ``progress`` keeps the stream's state between runs.

    A repeated batch appends nothing twice: sales already in the target are left
    out by the same key that removes bulk copies.
    """
    stream = spark.readStream.schema(schema).parquet(source)

    def load(batch: DataFrame, _: int) -> None:
        fresh = fact_transactions(batch, communes)
        years = [r.annee for r in fresh.select("annee").distinct().collect()]  # one row per year: prunes the target
        held = _existing(spark, target, fresh).where(F.col("annee").isin(years))
        same = reduce(lambda a, b: a & b, [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in SALE_KEY])
        new = fresh.alias("n").join(held.alias("o"), same, "left_anti")
        new.hint("rebalance", "annee").write.mode("append").partitionBy("annee").parquet(target)

    (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def load_pending_years(
    spark: SparkSession, source: str, communes: DataFrame, target: str, log: DataFrame
) -> DataFrame:
    """Clean the yearly files of ``source`` with no success in the ledger; returns the ledger with the new events.

    A file's sales stay in the partition of the file's year (``file_year``),
    whatever year they are dated, so loading one file cannot touch another's
    sales. Each file gets a ``running`` event and then ``success`` with its rows
    or ``error`` with the reason; a file that failed is tried again next time,
    and the others are still loaded. Read the table with ``loaded_sales``.
    """
    for file in _due(spark, source, log):
        started = datetime.now()
        log = ledger.append(log, ledger.event(spark, file.source, ledger.RUNNING, started))
        status, rows, reason = _loaded(spark, source, file.annee, communes, target)
        log = ledger.append(log, ledger.event(spark, file.source, status, started, rows, datetime.now(), reason))
    return log


def load_logged_years(spark: SparkSession, source: str, communes: DataFrame, target: str, log: ledger.EventLog) -> None:
    """As ``load_pending_years``, with every event written to the log at once.

    ``running`` is on disk before a file is touched. If the driver is killed, the
    next run finds the file without success and loads it anew; the half-written
    partition is overwritten.
    """
    for file in _due(spark, source, log.read()):
        started = datetime.now()
        log.record(file.source, ledger.RUNNING, started)
        status, rows, reason = _loaded(spark, source, file.annee, communes, target)
        log.record(file.source, status, started, rows, reason)


def _due(spark: SparkSession, source: str, log: DataFrame) -> list[Row]:
    """Yearly files without success, as (annee, source); one row per file year."""
    years = years_in_folder(spark, source)
    name = F.concat(F.lit("silver.fact_transactions_"), F.col("annee").cast("string")).alias("source")
    return ledger.pending(years.select("annee", name), log).orderBy("annee").collect()


def _loaded(spark: SparkSession, source: str, year: int, communes: DataFrame, target: str) -> tuple[str, int | None, str | None]:
    """Cleans one yearly file into its partition; (status, rows, reason)."""
    try:
        # The partition column is the file's year; the cleaned table has the sale's own.
        raw = read_years(spark, source, [year]).drop("annee")
        part = f"{target}/file_year={year}"
        fact_transactions(raw, communes).write.mode("overwrite").parquet(part)
        return ledger.SUCCESS, spark.read.parquet(part).count(), None
    except (PySparkException, Py4JJavaError) as error:
        return ledger.ERROR, None, str(error)[:500]


def loaded_sales(spark: SparkSession, target: str) -> DataFrame:
    """The sales of all loaded files; a sale that two files hold counts once, as in a full load."""
    held = spark.read.parquet(target)
    return dedup(held.drop("file_year"), SALE_KEY)


def _existing(spark: SparkSession, target: str, like: DataFrame) -> DataFrame:
    """Keys in the target; none before the first load."""
    try:
        return spark.read.schema(like.schema).parquet(target).select(*SALE_KEY)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return like.select(*SALE_KEY).limit(0)
