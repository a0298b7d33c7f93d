"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole and encoded once, with the character offsets
of every token. The spans of its turns are sorted, as are the tokens, so the
tokens of each assistant text are found by binary search.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

#: Control strings of the template; fixed values. Each becomes one token of its own.
START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
TRAINED = ("assistant",)

_OPEN = re.compile(r"<(\\*)\|")
_SHUT = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(MIDDLE) + "(.*?)" + re.escape(END), re.S)


def escape(text: str) -> str:
    r"""One more backslash between every ``<`` and ``|``, so that no control string can appear; ``unescape`` takes it away."""
    return _OPEN.sub(r"<\\\1|", text) if "|" in text else text


def unescape(text: str) -> str:
    return _SHUT.sub(r"<\1|", text) if "|" in text else text


def render(roles: list[str], texts: list[str], trained=TRAINED) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the sorted, disjoint spans of the trained texts in it."""
    parts, spans, at = [], [], 0
    for role, text in zip(roles, texts):
        head, body = START + escape(role) + MIDDLE, escape(text)
        if role in trained:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += (head, body, END)
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def token_mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """True for the tokens inside a span. Both sides are sorted: two binary searches per span.

    Control tokens stand on either side of every span, so no token crosses its border.
    """
    mask = np.zeros(len(starts), bool)
    for a, b in spans:
        if a < b:
            mask[np.searchsorted(starts, a, "left"):np.searchsorted(ends, b, "right")] = True
    return mask


def masked_text(formatted: str, starts, ends, mask) -> str:
    """The characters under the mask. Tokens that share a character (parts of its bytes) give it once."""
    parts, done = [], 0
    for a, b in zip(np.asarray(starts)[mask].tolist(), np.asarray(ends)[mask].tolist()):
        a = max(a, done)
        if a < b:
            parts.append(formatted[a:b])
            done = b
    return "".join(parts)


def masked_runs(formatted: str, starts, ends, mask) -> list[str]:
    """The masked text of each run of the mask: control tokens between turns are not masked, so of each trained text that is not empty."""
    starts, ends, mask = np.asarray(starts), np.asarray(ends), np.asarray(mask, bool)
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return [masked_text(formatted, starts[a:b], ends[a:b], mask[a:b]) for a, b in zip(edge[::2], edge[1::2])]


@lru_cache(maxsize=2)
def _tokenizer(definition: str):
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.add_special_tokens([AddedToken(t, special=True, normalized=False) for t in (START, MIDDLE, END)])
    return tokenizer


def format_chats(turns: DataFrame, tokenizer: str = TOKENIZER, trained=TRAINED) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, token_ids, starts, ends, loss_mask.

    Turns are ordered by turn, nulls first, ties by role and text; repeated
    rows are turns of their own. Null roles and texts are empty. Rows without
    a conv_id are one conversation. The tokenizer's definition (a file of fixed
    size) is read once on the driver and travels with the tasks.
    """
    definition = Path(tokenizer).read_text(encoding="utf-8")
    shared = turns.sparkSession.sparkContext.broadcast(definition)
    clean = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", clean("role").alias("role"), clean("text").alias("text")))).alias("turns"))
    whole = whole.select("conv_id", F.transform("turns", lambda t: t["role"]).alias("roles"), F.transform("turns", lambda t: t["text"]).alias("texts"))
    schema = "conv_id bigint, n_turns bigint, formatted string, token_ids array<int>, starts array<int>, ends array<int>, loss_mask array<boolean>"

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _tokenizer(shared.value)
        for batch in batches:
            for first in range(0, len(batch), 256):  # bounds the tokens held at once
                part = batch.iloc[first:first + 256]
                done = [render(list(r), list(t), trained) for r, t in zip(part["roles"], part["texts"])]
                rows = []
                for (formatted, spans), e in zip(done, encoder.encode_batch([f for f, _ in done], add_special_tokens=False)):
                    offsets = np.asarray(e.offsets, np.int32).reshape(-1, 2)
                    starts, ends = np.ascontiguousarray(offsets[:, 0]), np.ascontiguousarray(offsets[:, 1])
                    rows.append((np.asarray(e.ids, np.int32), starts, ends, token_mask(starts, ends, spans)))
                yield pd.DataFrame({
                    "conv_id": part["conv_id"].astype("Int64").values, "n_turns": [len(r) for r in part["roles"]],
                    "formatted": [f for f, _ in done], "token_ids": [r[0] for r in rows], "starts": [r[1] for r in rows],
                    "ends": [r[2] for r in rows], "loss_mask": [r[3] for r in rows],
                })

    return whole.mapInPandas(encode, schema)


def read_back(chats: DataFrame) -> DataFrame:
    """conv_id, turns (role, text) and loss_text, from the formatted text, the offsets and the mask alone.

    Texts were escaped one by one, so they are unescaped one by one.
    """
    @F.pandas_udf("turns array<struct<role:string,text:string>>, loss_text string")
    def read(formatted: pd.Series, starts: pd.Series, ends: pd.Series, mask: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({
            "turns": [[{"role": r, "text": t} for r, t in parse(f)] for f in formatted],
            "loss_text": ["".join(map(unescape, masked_runs(f, a, b, m))) for f, a, b, m in zip(formatted, starts, ends, mask)],
        })

    return chats.withColumn("r", read("formatted", "starts", "ends", "loss_mask")).select(
        "conv_id", "n_turns", F.char_length("formatted").cast("long").alias("formatted_chars"), "r.turns", "r.loss_text")


def op1_chat_format(spark, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = END + START + "assistant ok"
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    x = read_back(format_chats(turns.unionByName(own)))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return x.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(joined.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


OP1_SQL = """WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e AS (SELECT *, regexp_replace(text, '<(\\\\*)\\|', '<\\\\\\1|', 'g') AS body, regexp_replace(role, '<(\\\\*)\\|', '<\\\\\\1|', 'g') AS name FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  sum(length(body) + length(name) + 32)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id"""
