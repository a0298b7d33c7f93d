"""Repeated passages of words: each word covered by a window of 35 words that also starts anywhere else."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, table
from .repeats import Alphabet, Shape, merged, repeated_runs

WORDS = 35
SHAPE = Shape(window=WORDS, reach=24, gram=8, power=32)


def words_of(text: str | None) -> list[bytes]:
    """Words of a whole text; bytes.split cuts at the same six characters as the pattern of words."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def word_symbols(texts: Iterator[str | None]) -> Iterator[np.ndarray]:
    known: dict[bytes, int] = {}
    for text in texts:
        words = words_of(text)
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
        yield np.array([known[w] for w in words], np.uint64)
        if len(known) > 200_000:  # bounds memory; forgotten words are hashed again
            known.clear()


ALPHABET = Alphabet(word_symbols, lambda x: x.astype(">u8").tobytes(), lambda b: np.frombuffer(b, ">u8").astype(np.uint64), 8)


def remove_passages(docs: DataFrame) -> DataFrame:
    """One row per document: n, doc_id, n_words, spans (removed words, end exclusive), kept (words joined by one space).

    Null text has no words. Repeated or null ids are told apart by
    ``numbered``. Windows are judged on the input.
    """
    docs = numbered(docs)
    runs = repeated_runs(docs, ALPHABET, SHAPE, "passages", earlier_only=False)
    by_doc = runs.groupBy("n").agg(F.collect_list("first").alias("firsts"), F.collect_list("last").alias("lasts"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes, spans, kept = [], [], []
            for text, firsts, lasts in zip(batch["text"], batch["firsts"], batch["lasts"]):
                words = words_of(text)
                own = merged(np.asarray(firsts), np.asarray(lasts) + WORDS - 1) if firsts is not None else []
                at, left = 0, []
                for a, b in own:
                    left += words[at:a]
                    at = b
                sizes.append(len(words))
                spans.append([{"first": a, "last": b} for a, b in own])
                kept.append(b" ".join([*left, *words[at:]]))
            yield pd.DataFrame({
                "n": batch["n"], "doc_id": batch["doc_id"].astype("Int64"), "n_words": sizes, "spans": spans,
                "kept_sha256": [hashlib.sha256(k).hexdigest() for k in kept], "kept": [k.decode("utf-8", "surrogatepass") for k in kept],
            })

    return docs.join(by_doc, "n", "left").mapInPandas(
        cut, "n bigint, doc_id bigint, n_words bigint, spans array<struct<first:int,last:int>>, kept_sha256 string, kept string")


def op6_substring_dedup(spark, folder: str) -> DataFrame:
    x = remove_passages(table(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return x.select("doc_id", "n_words", removed.alias("n_removed"), "kept_sha256")


OP6_SQL = """WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY array_to_string(w[i:i + 34], ' ')) AS n FROM p) WHERE n > 1),
x AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM r),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS kept FROM
  (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d) ANTI JOIN x USING (doc_id, j) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT doc_id, count(*) AS n FROM x GROUP BY doc_id) USING (doc_id) LEFT JOIN k USING (doc_id)"""
