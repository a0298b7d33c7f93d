"""Toxicity score: a factorization machine over hashed terms.

The linear weights add up; the factors give every pair of terms a weight of
its own, so an insult together with the mention of a group can weigh more than
both alone. Fitted on a bounded sample of labelled rows, applied to all rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, stored, table

_WORD = re.compile(r"[^\W\d_]+")
#: Lengths in letters of the word beginnings that are terms beside the words.
STEMS = (4, 5, 6)
THRESHOLD = 0.7


def word_terms(word: str) -> list[int]:
    """Hashes of a word and of its beginnings."""
    names = [word, *("^" + word[:n] for n in STEMS if len(word) > n)]
    return [xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) - (1 << 63) for t in names]


def terms(text: str | None) -> set[int]:
    """Hashed terms of a whole text, lower case; none for null."""
    return {t for word in set(_WORD.findall((text or "").lower())) for t in word_terms(word)}


def association(with_1: Column, with_0: Column, n1: int, n0: int) -> Column:
    """G statistic of a term's presence against the label, from its text counts by label."""
    part = lambda count, expected: F.when(count > 0, 2 * count * F.log(count / expected)).otherwise(0.0)
    share = (with_1 + with_0) / F.lit(float(n1 + n0))
    return sum((part(seen, n * share) + part(n - seen, n * (1 - share)) for seen, n in ((with_1, n1), (with_0, n0))), F.lit(0.0))


@dataclass(frozen=True)
class Machine:
    """logit = bias + sum of w + sum over pairs of <v_i, v_j>, over the terms of a text that the sample had."""

    keys: np.ndarray
    w: np.ndarray
    v: np.ndarray
    bias: float

    def rows(self) -> dict[int, int]:
        return dict(zip(self.keys.tolist(), range(len(self.keys))))

    def score(self, at: np.ndarray) -> float:
        v = self.v[at]
        total = v.sum(0)
        logit = self.bias + float(self.w[at].sum()) + 0.5 * float(total @ total - np.einsum("ij,ij", v, v))
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


def fit_machine(
    keys: np.ndarray, at: list[np.ndarray], labels: np.ndarray, prior: float, rank: int = 6, epochs: int = 60,
    rate: float = 0.2, decay: float = 2e-5, batch: int = 128, seed: int = 7,
) -> Machine:
    """Adaptive gradient descent on the logistic loss; ``at`` lists the places in ``keys`` of every text's terms.

    ``prior`` is the share of label 1 among all labelled rows: the sample may
    hold more of them, and the bias is moved back by that odds ratio. Without
    both labels every text gets the prior.
    """
    if len(at) == 0 or labels.min() == labels.max():
        p = min(max(prior, 1e-3), 1 - 1e-3)
        return Machine(np.empty(0, np.int64), np.empty(0), np.empty((0, rank)), float(np.log(p / (1 - p))))
    rng = np.random.default_rng(seed)
    w, v = np.zeros(len(keys)), rng.normal(0, 0.01, (len(keys), rank))
    gw, gv, bias, gb = np.full(len(keys), 1e-3), np.full((len(keys), rank), 1e-3), 0.0, 1e-3
    y = labels.astype(float)
    for _ in range(epochs):
        order = rng.permutation(len(at))
        for start in range(0, len(order), batch):
            part = order[start:start + batch]
            sizes = np.array([len(at[i]) for i in part])
            flat, owner = np.concatenate([at[i] for i in part]), np.repeat(np.arange(len(part)), sizes)
            vf = v[flat]
            total = np.stack([np.bincount(owner, vf[:, k], len(part)) for k in range(rank)], 1)
            squares = np.bincount(owner, (vf * vf).sum(1), len(part))
            logit = bias + np.bincount(owner, w[flat], len(part)) + 0.5 * ((total * total).sum(1) - squares)
            miss = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[part]
            used, back = np.unique(flat, return_inverse=True)
            dw = np.bincount(back, miss[owner], len(used)) / len(part) + decay * w[used]
            pull = miss[owner, None] * (total[owner] - vf)
            dv = np.stack([np.bincount(back, pull[:, k], len(used)) for k in range(rank)], 1) / len(part) + decay * v[used]
            db = miss.mean()
            gw[used] += dw * dw
            gv[used] += dv * dv
            gb += db * db
            w[used] -= rate * dw / np.sqrt(gw[used])
            v[used] -= 0.3 * rate * dv / np.sqrt(gv[used])
            bias -= rate * db / np.sqrt(gb)
    share = float(y.mean())
    p = min(max(prior, 1e-3), 1 - 1e-3)
    bias += float(np.log(p / (1 - p)) - np.log(share / (1 - share)))
    return Machine(keys, w, v, bias)


def held_out() -> Column:
    """crc32 of doc_id as text, modulo 3, is 1; a null id counts as empty text and is not held out."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def learn(
    docs: DataFrame, labels: DataFrame, max_positive: int = 6000, max_negative: int = 10000, min_docs: int = 4, min_g: float = 15.0, **options,
) -> Machine:
    """Fit on at most max_positive + max_negative labelled rows that are not held out.

    The rows with the smallest hash of doc_id are taken, so reruns agree. Term
    hashes and their counts are made on the executors. Terms in fewer than
    min_docs texts of the sample, or whose presence says little about the label
    (G below min_g), are left out, so rare words are not learned by heart; the
    driver gets the terms that remain, and their places in the texts. Rows with
    null ids or labels are not used; a repeated label counts as its maximum. Of
    the rows of a repeated id the one of the least text hash (then the least
    text) is used, chosen on the executors, so the bound holds for rows too.
    """
    marked = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("y")).filter(~held_out())
    counts = {r["y"]: r["count"] for r in marked.groupBy("y").count().collect()}
    draw = lambda y, n: marked.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    chosen = draw(1, max_positive).union(draw(0, max_negative)).select(F.col("doc_id").alias("id"), "y")

    @F.pandas_udf("array<bigint>")
    def hashed(text: pd.Series) -> pd.Series:
        return text.map(lambda t: np.fromiter(sorted(terms(t)), np.int64))

    sample = stored(
        docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))  # bounded by the two parameters
        .groupBy(F.col("id").alias("doc_id"), "y").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
        .select("doc_id", "y", hashed("least.text").alias("terms")), "terms")
    sizes = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    seen = sample.select("y", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("y").alias("a"), F.count("y").alias("n")).filter(F.col("n") >= min_docs)
    a, n = F.col("a").cast("double"), F.col("n").cast("double")
    keys = np.array(sorted(r["term"] for r in seen.filter(association(a, n - a, n1, n0) >= min_g).select("term").collect()), np.int64)

    @F.pandas_udf("array<int>")
    def places(found: pd.Series) -> pd.Series:
        return found.map(lambda t: np.flatnonzero(np.isin(keys, t)).astype(np.int32))

    rows = sample.select("doc_id", "y", places("terms").alias("at")).toPandas().sort_values("doc_id")
    total = sum(counts.values())
    return fit_machine(
        keys, [np.asarray(t, np.int64) for t in rows["at"]], rows["y"].to_numpy(), counts.get(1, 0) / total if total else 0.0, **options)


def with_score(docs: DataFrame, machine: Machine, name: str = "score") -> DataFrame:
    """docs with a score from 0 to 1 of the whole text; empty and null texts get the score of no terms."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # as large as the bounded sample allows

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        rows, known = m.rows(), {}

        def places(word: str) -> tuple[int, ...]:
            if word not in known:
                if len(known) > 150_000:  # bounds memory; forgotten words are hashed again
                    known.clear()
                known[word] = tuple(i for i in (rows.get(t, -1) for t in word_terms(word)) if i >= 0)
            return known[word]

        for texts in batches:
            out = []
            for text in texts:
                at: set[int] = set()
                for word in set(_WORD.findall((text or "").lower())):
                    at.update(places(word))
                out.append(m.score(np.fromiter(sorted(at), int, len(at))))
            yield pd.Series(out, dtype="float64")

    return docs.withColumn(name, scored("text"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """docs without those that score threshold or more; same columns."""
    name = free_name(docs, "toxicity")
    return with_score(docs, learn(docs, labels, **options), name).filter(F.col(name) < threshold).drop(name)


def op5_toxicity(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = with_score(docs.select("doc_id", "text"), learn(docs, table(spark, folder, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
