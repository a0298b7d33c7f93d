"""Corpus pipeline: toxicity, near-duplicates, benchmark decontamination, secrets, mixing.

Each stage takes (spark, docs, sf_dir) and works on what its predecessor kept.
All stages but the last return the columns they were given; the last returns
the training order: one row per document and pass, range-sorted by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.llm.common import free_name, stored, table
from parcelle.llm.decontam import contaminated, find_contamination, hit_words
from parcelle.llm.mixing import mix, training_order
from parcelle.llm.near_dup import drop_near_duplicates
from parcelle.llm.secrets import find_secrets, redact
from parcelle.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine rejects go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate component stays: five-word shingles, similarity 0.8 or more."""
    return drop_near_duplicates(docs, size=5, share=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which test phrases cover a twentieth of the words or more go."""
    name = free_name(docs, "found")
    x = find_contamination(docs, table(spark, sf_dir, "benchmark"), name)
    found = F.col(name)
    return x.filter(~contaminated(hit_words(found), found["n_words"])).drop(name)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays. n_chars follows the text where there is one."""
    base, spans = free_name(docs, "base"), free_name(docs, "spans")
    x = find_secrets(docs, base=base, spans=spans)
    x = x.withColumn("text", redact(F.col("text"), F.col(spans))).select(*docs.columns)
    return x.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else x


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training order of the mix by the sources' curriculum."""
    return training_order(mix(docs))


STAGES = [
    ("toxicity", toxicity), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("secrets", secrets), ("mixing", mixing),
]
#: Learned scores and MinHash components have no SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
