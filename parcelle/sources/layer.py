"""Tables written once for each version of their inputs, and read by whoever needs them."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sinks import remove_folder

ENTRY = "name string, version string, folder string, written long"


def input_version(spark: SparkSession, folder: str) -> str:
    """Changes with any file of the folder: from names, sizes and times alone, no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    state = F.xxhash64("path", "length", "modificationTime").cast("decimal(20,0)")
    count, total = files.agg(F.count(F.lit(1)), F.sum(state)).first()
    return f"{count}-{total}"


class Layer:
    """Written tables under ``root`` and the manifest that lists them.

    A table's entry is appended when its files are complete, so a write that
    fails shows nothing and is done anew.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def entries(self) -> DataFrame:
        try:
            return self.spark.read.schema(ENTRY).parquet(f"{self.root}/manifest")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], ENTRY)

    def table(self, name: str, version: str, build: Callable[[], DataFrame], keep: int = 2) -> DataFrame:
        """The table for this version of its inputs, built and written if there is none yet; the last ``keep`` versions stay."""
        live: dict[str, str] = {}  # by version, oldest first
        for r in self.entries().where(F.col("name") == name).orderBy("written").collect():  # one row per version written or removed
            live.pop(r.version, None)
            if r.folder is not None:
                live[r.version] = r.folder
        if version in live:
            return self.spark.read.parquet(f"{self.root}/{live[version]}")
        folder = f"{name}/{uuid.uuid4().hex}"
        frame = build()
        frame.write.parquet(f"{self.root}/{folder}")
        self._enter(name, version, folder)
        for old in list(live)[: max(0, len(live) + 1 - keep)]:
            self._enter(name, old, None)  # first out of the manifest, then the files
            remove_folder(self.spark, f"{self.root}/{live[old]}")
        return self.spark.read.schema(frame.schema).parquet(f"{self.root}/{folder}")

    def _enter(self, name: str, version: str, folder: str | None) -> None:
        self.spark.createDataFrame([(name, version, folder, time.time_ns())], ENTRY).coalesce(1).write.mode("append").parquet(f"{self.root}/manifest")
