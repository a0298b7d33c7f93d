"""Readers for Parquet, year-partitioned folders and delimited text."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import tidy_names, union_by_name

# Encodings tried in turn for survey zoning files.
ENCODINGS = ("UTF-8", "ISO-8859-1")


def read_table(spark: SparkSession, folder: str, name: str, schema: str | None = None) -> DataFrame:
    """One Parquet table; with a known schema no file footer is read while planning."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_years(spark: SparkSession, path: str, years: Iterable[int] | None = None) -> DataFrame:
    """A folder of ``annee=YYYY`` partitions; only the years asked for are read.

    Their files' schemas are merged, so a column that came later is null before;
    files of other years are not opened.
    """
    if years is None:
        return spark.read.option("mergeSchema", "true").parquet(path)
    wanted = [f"{path}/annee={y}" for y in years]
    return spark.read.option("mergeSchema", "true").option("basePath", path).parquet(*wanted)


def years_in_folder(spark: SparkSession, path: str) -> DataFrame:
    """Years of a folder of ``annee=YYYY`` partitions, from the folder names: no file is opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.regexp_extract("path", r"/annee=([^/]+)/", 1).try_cast("int").alias("annee")
    return listed.select(name).where("annee is not null").distinct()


def years_in(*sources: DataFrame) -> DataFrame:
    """Distinct years over several sources; names that are no year are skipped."""
    years = union_by_name([s.select(F.col("annee").cast("string").try_cast("int").alias("annee")) for s in sources])
    return years.where("annee is not null").distinct()


def read_delimited(
    spark: SparkSession, paths: str | Sequence[str], sep: str, encoding: str = "UTF-8"
) -> DataFrame:
    """Delimited text with a header; every column is text, so codes keep their zeros."""
    return spark.read.csv(
        paths if isinstance(paths, str) else list(paths), sep=sep, header=True, encoding=encoding, inferSchema=False
    )


def file_formats(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path, encoding, header) of text files with a line, in one pass over the lines of all of them.

    A file that is no UTF-8 is read as ISO-8859-1, which decodes any byte; a
    third choice would never be reached. Lines are read as their bytes, and no
    character of either encoding holds the byte of a line end, so files are
    split like any text and none is held whole. The header is the first line of
    the split that begins the file.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(paths if isinstance(paths, str) else list(paths))
    place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())  # order of the lines of a file
    lines = lines.select(F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("line"), F.is_valid_utf8("value").alias("valid"), place.alias("place"))
    files = lines.groupBy("path").agg(F.bool_and("valid").alias("valid"), F.min_by("line", "place").alias("first"))
    encoding = F.when(F.col("valid"), F.lit(ENCODINGS[0])).otherwise(F.lit(ENCODINGS[1]))
    header = F.when(F.col("valid"), F.decode("first", ENCODINGS[0])).otherwise(F.decode("first", ENCODINGS[1]))
    return files.select("path", encoding.alias("encoding"), header.alias("header"))


def fitting_encoding(spark: SparkSession, path: str) -> str:
    """UTF-8 if all files of the path are, else ISO-8859-1."""
    return file_formats(spark, path).agg(F.min("encoding")).first()[0] or ENCODINGS[0]


def files_under(spark: SparkSession, pattern: str) -> list[str]:
    """Paths of matching files (names only, no content is read)."""
    return sorted(r.path for r in spark.read.format("binaryFile").load(pattern).select("path").collect())


def read_zoning(spark: SparkSession, paths: Sequence[str], observatory: str, sep: str = ";") -> DataFrame:
    """All zoning files of one observatory, tagged with it and with the file's name.

    Files of one encoding and header share a reader; the driver sees one small
    row per file.
    """
    groups: dict[tuple[str, str], list[str]] = {}
    for f in file_formats(spark, paths).orderBy("path").collect():
        groups.setdefault((f.encoding, f.header), []).append(f.path)
    frames = []
    for (encoding, _), same in groups.items():
        df = read_delimited(spark, same, sep, encoding)
        file_name = F.col("_metadata.file_name").alias("source_file")
        columns = [F.col(f"`{c}`").alias(n) for c, n in zip(df.columns, tidy_names(df.columns))]
        frames.append(df.select(*columns, F.lit(observatory).alias("observatory_b"), file_name))
    return union_by_name(frames)


def file_report(spark: SparkSession, path: str, expected: DataFrame, name: Column | None = None) -> DataFrame:
    """Rows per expected Parquet file; missing, empty or unreadable files count as not usable.

    ``expected`` has a ``file_name`` column; ``name`` derives it from the file's
    metadata, and is the plain file name by default. Only rows are counted, so any
    schema will do and no file has to be opened to find one.
    """
    found = (
        spark.read.schema("any_column string")
        .option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true").parquet(path)
        .groupBy((F.col("_metadata.file_name") if name is None else name).alias("file_name"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    rows = F.coalesce(F.col("row_count"), F.lit(0))
    return expected.join(found, "file_name", "left").select("file_name", rows.alias("row_count"), (rows > 0).alias("usable"))


def source_report(spark: SparkSession, root: str, expected: DataFrame) -> DataFrame:
    """(source, files, bytes, empty_files, usable) for each expected source, from file names and sizes alone.

    A source is a folder under ``root``, with files of any format at any depth.
    It is usable if it has a file and no file is empty; one without a folder has
    no files. No file is opened. Readers leave empty files out, so those are the
    listed names beyond the files that a reader sees; the driver has the names
    from listing the folder.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)

    def source(path: Column) -> Column:
        return F.substring_index(F.substring_index(path, f"/{root.rstrip('/').rsplit('/', 1)[-1]}/", -1), "/", 1).alias("source")

    names = spark.createDataFrame([(name,) for name in reader.inputFiles()], "path string").select(source(F.url_decode("path")))
    named = names.groupBy("source").agg(F.count(F.lit(1)).alias("files"))
    seen = reader.select(source(F.col("path")), "length").groupBy("source").agg(F.count(F.lit(1)).alias("seen"), F.sum("length").alias("bytes"))
    found = expected.select("source").join(named, "source", "left").join(seen, "source", "left")
    files, filled, size = (F.coalesce(c, F.lit(0).cast("long")) for c in ("files", "seen", "bytes"))
    return found.select("source", files.alias("files"), size.alias("bytes"), (files - filled).alias("empty_files"), ((files > 0) & (files == filled)).alias("usable"))
