"""Run ledger: which sources are loaded, and what is still to do.

The ledger is a table of events; nothing is updated in place. A source is done
once it has a ``success`` event; ``running`` and ``error`` mean it is tried again.
``EventLog`` keeps them in a shared folder, so that a run that is killed leaves
its ``running`` events behind.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SUCCESS, RUNNING, ERROR = "success", "running", "error"
COLUMNS = (
    "source string, status string, rows_loaded bigint, started_at timestamp, finished_at timestamp, error_msg string"
)


def done(ledger: DataFrame) -> DataFrame:
    return ledger.where(F.col("status") == SUCCESS).select("source").distinct()


def pending(sources: DataFrame, ledger: DataFrame) -> DataFrame:
    return sources.join(done(ledger), "source", "left_anti")


def event(
    spark: SparkSession, source: str, status: str, started: datetime,
    rows: int | None = None, finished: datetime | None = None, error: str | None = None,
) -> DataFrame:
    return spark.createDataFrame([(source, status, rows, started, finished, error)], COLUMNS)


def append(ledger: DataFrame, *events: DataFrame) -> DataFrame:
    for e in events:
        ledger = ledger.unionByName(e)
    return ledger


class EventLog:
    """Events as files of a folder: an append is one committed write, and a read sees all committed ones.

    The plan of a read is one scan, however many events were appended.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(COLUMNS).parquet(self.folder)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], COLUMNS)

    def append(self, events: DataFrame) -> None:
        names = [f.name for f in self.spark.createDataFrame([], COLUMNS).schema]
        events.select(*names).hint("rebalance").write.mode("append").parquet(self.folder)

    def record(self, source: str, status: str, started: datetime, rows: int | None = None, error: str | None = None) -> None:
        """One event; all but ``running`` end now."""
        finished = None if status == RUNNING else datetime.now()
        self.append(event(self.spark, source, status, started, rows, finished, error))


def latest_status(ledger: DataFrame) -> DataFrame:
    """Current state per source: a finished event outranks the start it answers."""
    when = F.struct("started_at", F.coalesce("finished_at", F.lit(datetime(1970, 1, 1)).cast("timestamp")))
    return ledger.groupBy("source").agg(
        F.max_by("status", when).alias("status"), F.max_by("rows_loaded", when).alias("rows_loaded"),
        F.count(F.lit(1)).alias("events"),
    )


def reset(ledger: DataFrame, schema: str | None = None, table: str | None = None) -> DataFrame:
    """The ledger without success events: all, those of a schema, or one table's."""
    hit = F.col("status") == SUCCESS
    if schema is not None and table is not None:
        hit = hit & (F.col("source") == f"{schema}.{table}")
    elif schema is not None:
        hit = hit & F.col("source").startswith(f"{schema}.")
    return ledger.where(~F.coalesce(hit, F.lit(False)))


def bootstrap(counts: DataFrame, ledger: DataFrame) -> DataFrame:
    """Tables that hold rows but have no success event yet, as (source, rows_loaded)."""
    filled = counts.where("rows_loaded > 0").select("source", "rows_loaded")
    return pending(filled, ledger)
