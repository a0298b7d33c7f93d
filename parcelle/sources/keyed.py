"""A table with a unique key that is changed by merges.

Rows lie in buckets by the hash of their key. A merge reads and rewrites only
the buckets that its new rows fall into, beside the old ones, and then publishes
a list of all buckets' folders as the next version. The list is one file and
appears when its write is committed: a merge that fails before leaves the old
version, one that succeeds shows all its rows at once.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.relational import dedup, insert_ignore, upsert
from .sinks import remove_folder

LIST = "version long, bucket int, folder string"
_BUCKET = "bucket"


class KeyedTable:
    """The table under ``root``; one writer at a time, as of two equal version numbers the second is refused.

    ``buckets`` belongs to the table: it must be the same in every session.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: Sequence[str], buckets: int = 64):
        self.spark, self.root, self.schema, self.keys, self.buckets = spark, root.rstrip("/"), schema, list(keys), buckets

    def _lists(self) -> DataFrame:
        return self.spark.read.schema(LIST).option("recursiveFileLookup", "true").parquet(f"{self.root}/versions")

    def version(self) -> tuple[int, dict[int, str]]:
        """Number of the newest version and the folder of each bucket that holds rows; (0, {}) before the first."""
        try:
            rows = self._lists()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0, {}
        newest = rows.agg(F.max("version")).first()[0] or 0
        found = rows.where(F.col("version") == newest).collect()  # one row per bucket
        return newest, {r.bucket: r.folder for r in found if r.folder}

    def read(self, only: Sequence[int] | None = None) -> DataFrame:
        """The newest version, or some buckets of it."""
        folders = [f for b, f in self.version()[1].items() if only is None or b in set(only)]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.root}/{f}" for f in sorted(folders)))

    def upsert(self, new: DataFrame, keep: Sequence[str] = ()) -> int:
        """New values win, except in the columns to ``keep``; returns the version."""
        return self._merge(new, lambda old, rows: upsert(old, rows, self.keys, keep))

    def insert_ignore(self, new: DataFrame) -> int:
        """Only rows whose key is not taken come in; returns the version."""
        return self._merge(new, lambda old, rows: insert_ignore(old, rows, self.keys))

    def _merge(self, new: DataFrame, merge) -> int:
        """Of new rows with one key the first in the order of all columns counts; a missing key is refused before any write."""
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        new = new.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema))
        missing = F.greatest(*(F.col(k).isNull() for k in self.keys), F.lit(False))
        touched = new.groupBy(bucket.alias(_BUCKET)).agg(F.max(missing).alias("missing")).collect()  # one row per bucket
        if any(r.missing for r in touched):
            raise ValueError(f"rows without a value in {self.keys}")
        number, folders = self.version()
        if not touched:
            return number
        old = self.read([r[_BUCKET] for r in touched])
        part = f"data/{uuid.uuid4().hex}"
        merged = merge(old, dedup(new, self.keys)).select(*self.schema.names).withColumn("_bucket", bucket)
        merged.hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(f"{self.root}/{part}")
        folders |= {r[_BUCKET]: f"{part}/_bucket={r[_BUCKET]}" for r in touched}
        rows = [(number + 1, b, f) for b, f in sorted(folders.items())]
        self.spark.createDataFrame(rows, LIST).coalesce(1).write.parquet(f"{self.root}/versions/{number + 1}")
        return number + 1

    def forget(self, keep: int = 2) -> int:
        """Removes all but the last versions and the bucket folders that only they name; returns how many folders went."""
        number, _ = self.version()
        if number <= keep:
            return 0
        rows = self._lists().collect()  # versions x buckets
        kept = {r.folder for r in rows if r.version > number - keep}
        gone = {r.folder for r in rows} - kept
        for folder in sorted(gone):
            remove_folder(self.spark, f"{self.root}/{folder}")
        for old in {r.version for r in rows if r.version <= number - keep}:
            remove_folder(self.spark, f"{self.root}/versions/{old}")
        return len(gone)
