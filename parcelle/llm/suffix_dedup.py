"""Exact substring removal on bytes: each byte covered by a 100-byte string that also starts earlier.

See ``repeats`` for how the suffixes to compare are sampled, named and merged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, table
from .repeats import Alphabet, Shape, merged, repeated_runs

BYTES = 100
SHAPE = Shape(window=BYTES, reach=69, gram=32, power=64)
#: A 64-bit symbol of every byte.
_CODES = np.random.default_rng(4).integers(0, 1 << 63, 256, dtype=np.uint64) << np.uint64(8) | np.arange(256, dtype=np.uint64)


def raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def byte_symbols(texts: Iterator[str | None]) -> Iterator[np.ndarray]:
    for text in texts:
        yield _CODES[np.frombuffer(raw(text), np.uint8)]


ALPHABET = Alphabet(byte_symbols, lambda x: (x & np.uint64(255)).astype(np.uint8).tobytes(), lambda b: _CODES[np.frombuffer(b, np.uint8)], 1)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: n, doc_id, text, spans (removed bytes, end exclusive, maximal), kept (binary).

    Null text counts as empty. Repeated or null ids are told apart and ordered
    by ``numbered``. Strings are judged on the input, and never cross documents.
    """
    docs = numbered(docs)
    runs = repeated_runs(docs, ALPHABET, SHAPE, "suffixes", earlier_only=True)
    by_doc = runs.groupBy("n").agg(F.collect_list("first").alias("firsts"), F.collect_list("last").alias("lasts"))
    joined = docs.join(by_doc, "n", "left")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            spans, kept = [], []
            for text, firsts, lasts in zip(batch["text"], batch["firsts"], batch["lasts"]):
                data = raw(text)
                own = merged(np.asarray(firsts), np.asarray(lasts) + BYTES - 1) if firsts is not None else []
                at, parts = 0, []
                for a, b in own:
                    parts.append(data[at:a])
                    at = b
                spans.append([{"first": a, "last": b} for a, b in own])
                kept.append(b"".join([*parts, data[at:]]))
            yield pd.DataFrame({
                "n": batch["n"], "doc_id": batch["doc_id"].astype("Int64"), "n_bytes": [len(raw(t)) for t in batch["text"]], "spans": spans,
                "kept_sha256": [hashlib.sha256(k).hexdigest() for k in kept], "kept": kept,
            })

    return joined.mapInPandas(cut, "n bigint, doc_id bigint, n_bytes bigint, spans array<struct<first:int,last:int>>, kept_sha256 string, kept binary")


def op4_suffix_dedup(spark, folder: str) -> DataFrame:
    x = remove_repeats(table(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return x.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
