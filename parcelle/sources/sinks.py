"""Writers. A lost executor's tasks are rerun; a reader sees a write only when it is committed.

An overwrite deletes the old content first, so a job that fails in between leaves
none; ``publish`` keeps the old content until the new one is complete.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def replace_all(df: DataFrame, path: str, columns: Sequence[str], by: str | None = None) -> None:
    """The table's content becomes exactly these columns of these rows."""
    out = df.select(*columns)
    if by is None:
        out.write.mode("overwrite").parquet(path)
    else:
        _by_partition(out, by).option("partitionOverwriteMode", "static").parquet(path)


def replace_partitions(df: DataFrame, path: str, by: str = "annee") -> None:
    """Only partitions present in ``df`` are replaced."""
    _by_partition(df, by).option("partitionOverwriteMode", "dynamic").parquet(path)


def _by_partition(df: DataFrame, by: str):
    # The rebalance hint gathers small partitions and splits a large year over tasks.
    return df.hint("rebalance", by).write.mode("overwrite").partitionBy(by)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of any store Spark writes to."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _folders(spark: SparkSession, folder: str) -> list[str]:
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return [s.getPath().getName() for s in place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place) if s.isDirectory()]


def publish(df: DataFrame, name: str, folder: str, keep: int = 2) -> None:
    """A new version beside the old one, then the table points to it: a failed write changes nothing.

    Of the versions under ``folder`` the last ``keep`` stay, so that a reader of
    the version before can finish.
    """
    spark, version = df.sparkSession, f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(f"{folder}/{version}")
    spark.sql(f"CREATE OR REPLACE VIEW `{name}` AS SELECT * FROM parquet.`{folder}/{version}`")
    for old in sorted(_folders(spark, folder))[:-keep]:
        remove_folder(spark, f"{folder}/{old}")


def replace_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Drop and recreate with the frame's own schema; at ``path`` if given."""
    writer = df.write.mode("overwrite").option("overwriteSchema", "true")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def materialize(frames: Mapping[str, DataFrame], schema: str, location: str) -> None:
    """Every frame becomes a table of ``schema``, which is created at ``location`` if needed."""
    spark = next(iter(frames.values())).sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}` LOCATION '{location}'")
    for name, df in frames.items():
        replace_table(df, f"{schema}.{name}", f"{location}/{name}")
