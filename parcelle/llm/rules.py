"""Quality rules: text statistics, and a learned ordered list of threshold rules over them.

Only DataFrame functions: statistics are array expressions per row, learning
is a few aggregations over labelled statistics, and the learned list is one
ordered CASE expression.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import GAP, stored, table

SYMBOLS = "#*$%&|<>"
WINDOW = 3
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Name and expression of the values that rules test; all from the statistics, with at least one word as divisor.
FEATURES = {
    "n_words": "cast(n_words as double)",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_lines_per_word": "n_dup_lines / greatest(n_words, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(word_chars, 1)",
}


def _let(value: Column, body) -> Column:
    """body(value) with value computed once per row; an expression inside a lambda would be computed per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated(words: Column) -> Column:
    """Words inside windows of three that occur twice or more, given the array of words (three or more)."""
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            same = lambda x, j: F.get(s, j - 1)["h"].eqNullSafe(x["h"]) | F.get(s, j + 1)["h"].eqNullSafe(x["h"])
            return F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"]))

        def length(at: Column) -> Column:
            return F.aggregate(
                at, F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
                lambda a, i: F.struct((i + WINDOW).alias("end"), (a["n"] + i + WINDOW - F.greatest(i, a["end"])).alias("n")),
                lambda a: a["n"],
            )

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(_let(_let(placed, places), length))

    return _let(windows, covered)


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of the whole text; null text counts as empty, and has zeros.

    Windows of three words are compared by 64-bit hash within one text.
    Repeated rows and null ids stay rows of their own.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    gap = F.lit(GAP)
    x = docs.select("doc_id", text.alias("text"), F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("words"))
    lines = F.filter(F.split("text", "\n", -1), lambda s: F.btrim(s, gap) != "")
    solid = F.translate("text", GAP, "")
    drop = lambda chars: (F.length(solid) - F.length(F.translate(solid, chars, ""))).cast("long")
    return x.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), F.length(solid).cast("long").alias("word_chars"),
        drop(SYMBOLS).alias("n_symbols"),
        _let(lines, lambda a: (F.size(a) - F.size(F.array_distinct(a))).cast("long")).alias("n_dup_lines"),
        F.when(F.size("words") < WINDOW, F.lit(0).cast("long")).otherwise(_repeated(F.col("words"))).alias("n_repeat_words"),
        drop("ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_upper"), drop("!?").alias("n_marks"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    """All conditions (feature, '>' or '<=', threshold) hold: reject (label 0) or keep (label 1)."""

    conditions: tuple[tuple[str, str, float], ...]
    label: int = 0

    def column(self) -> Column:
        test = F.lit(True)
        for name, side, limit in self.conditions:
            value = F.expr(FEATURES[name])
            test = test & ((value > F.lit(limit)) if side == ">" else (value <= F.lit(limit)))
        return test


def learn_rules(
    labelled: DataFrame, cuts: int = 40, max_rules: int | None = None, max_conditions: int = 3, min_precision: float = 0.97, min_rows: int = 5,
    min_share: float = 0.005,
) -> list[Rule]:
    """An ordered list of rules for either label, learned from rows of (statistics, label, prune).

    Sequential covering. For each label a rule grows by the condition with the
    best FOIL gain on the grow rows, until it covers no row of the other label
    or has ``max_conditions``; conditions are dropped from its end while that
    raises (p - n) / (p + n) on the prune rows (a third by hash). Of the two the
    one of better worth is taken, a reject rule before a keep rule of the same
    worth; the rows it covers then leave, so later rules only see what earlier
    ones left.
    A rule must have ``min_precision`` on all remaining rows, cover ``min_rows``
    and ``min_share`` of its label's rows, and leave uncovered all but a share
    of 1 - ``min_precision`` of the other label's remaining rows. The list ends
    when neither label has such a rule, or at ``max_rules`` if that is given;
    ``uncovered`` tells what it leaves. Rows no rule covers are kept.
    Each step is one aggregation over all labelled rows; only its counts, a
    fixed number for the number of candidate thresholds, reach the driver.
    Rows with null or other labels are ignored; without rows the list is empty.
    """
    names = list(FEATURES)
    x = labelled.filter(F.col("label").isin(0, 1)).select(
        *STATISTICS, "n_upper", "n_marks", "label", "prune").withColumns({f"f_{k}": F.expr(v).cast("double") for k, v in FEATURES.items()})
    shares = [i / cuts for i in range(1, cuts)]
    # Thresholds from both classes: quantiles of all rows and of the bad rows only.
    marks = x.agg(*[F.percentile_approx(f"f_{k}", shares, 2000).alias(f"a_{k}") for k in names],
                  *[F.percentile_approx(F.when(F.col("label") == 0, F.col(f"f_{k}")), shares, 2000).alias(f"b_{k}") for k in names]).first()
    limits = {k: sorted({*(marks[f"a_{k}"] or []), *(marks[f"b_{k}"] or [])}) for k in names}
    tests = [(k, side, t) for k in names for t in limits[k] for side in (">", "<=")]
    if not tests:
        return []
    rules: list[Rule] = []
    left = F.lit(True)
    grow = ~F.col("prune")

    def count(*conditions: Column) -> list[int]:
        return [v or 0 for v in x.filter(left).agg(*[F.count_if(c) for c in conditions]).first()]

    def of(label: int) -> Column:
        return F.col("label") == label

    def bin_of(value: Column, marks: list[float]) -> Column:
        return F.size(F.filter(F.array(*[F.lit(t) for t in marks]), lambda t: value > t))

    def histogram(inside: Column) -> list[tuple[int, int]]:
        """Grow rows of labels 0 and 1 of every test: counts between neighbouring thresholds, summed on the driver."""
        bins = [bin_of(F.col(f"f_{k}"), limits[k]) for k in names]
        counts = x.filter(left & grow & inside).select("label", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), e.alias("bin")) for k, e in zip(names, bins)])).alias("s"))
        found = {(r["k"], r["bin"], r["label"]): r["count"] for r in counts.groupBy("s.k", "s.bin", "label").count().collect()}
        out = []
        for k in names:
            upto = [[sum(found.get((k, b, y), 0) for b in range(at + 1)) for y in (0, 1)] for at in range(len(limits[k]) + 1)]
            for at in range(len(limits[k])):
                out += [tuple(upto[-1][y] - upto[at][y] for y in (0, 1)), tuple(upto[at])]
        return out

    def grown(label: int) -> list[tuple[str, str, float]]:
        """Conditions for a label in the order in which they were added."""
        chosen: list[tuple[str, str, float]] = []
        p0, n0 = count(of(label) & grow, of(1 - label) & grow)
        while n0 and p0 >= min_rows and len(chosen) < max_conditions:
            counts = [(c[label], c[1 - label]) for c in histogram(Rule(tuple(chosen)).column())]
            gain = lambda c: c[0] * (log2(c[0] / (c[0] + c[1])) - log2(p0 / (p0 + n0))) if c[0] >= min_rows else 0.0
            best = max(range(len(tests)), key=lambda i: (gain(counts[i]), -i))
            if gain(counts[best]) <= 1e-9:
                break
            chosen.append(tests[best])
            p0, n0 = counts[best]
        return chosen

    def pruned(label: int) -> tuple[float, Rule] | None:
        """The best beginning of the grown rule with its worth, or none if it does not qualify."""
        chosen = grown(label)
        heads = [Rule(tuple(chosen[:k]), label) for k in range(1, len(chosen) + 1)]
        if not heads:
            return None
        own, other = of(label), of(1 - label)
        others, *seen = count(other, *[c for r in heads for c in (own & ~grow & r.column(), other & ~grow & r.column(), own & r.column(), other & r.column())])
        worth = lambda k: (seen[4 * k] - seen[4 * k + 1]) / max(1, seen[4 * k] + seen[4 * k + 1])
        best = max(range(len(heads)), key=lambda k: (worth(k), k))
        covered, wrong = seen[4 * best + 2], seen[4 * best + 3]
        enough = covered >= max(min_rows, min_share * total[label]) and covered >= min_precision * (covered + wrong)
        return (worth(best), heads[best]) if enough and wrong <= (1 - min_precision) * others else None

    total = count(of(0), of(1))
    while max_rules is None or len(rules) < max_rules:
        found = [r for r in (pruned(0), pruned(1)) if r]
        if not found:
            break
        rule = max(found, key=lambda r: (r[0], -r[1].label))[1]
        rules.append(rule)
        left = left & ~rule.column()
    return rules


def uncovered(labelled: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per label: rows, rows that no rule covers, and rows that a rule gives the other label."""
    rule = verdict(rules)
    return labelled.filter(F.col("label").isin(0, 1)).groupBy("label").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(rule.isNull()).alias("n_uncovered"), F.count_if(label_of(rule, rules) != F.col("label")).alias("n_wrong"))


def verdict(rules: list[Rule]) -> Column:
    """Ordered conditional: number of the first rule that holds, or null."""
    out = F.when(F.lit(False), F.lit(0))
    for number, rule in enumerate(rules, 1):
        out = out.when(rule.column(), F.lit(number))
    return out


def label_of(number: Column, rules: list[Rule]) -> Column:
    """Label of a rule by its number; null without a rule."""
    return F.get(F.array(*[F.lit(r.label) for r in rules]).cast("array<int>"), number - 1)


def apply_rules(docs: DataFrame, labels: DataFrame, **options) -> tuple[DataFrame, list[Rule]]:
    """Statistics, base_failed, rule and kept of every document, and the learned list.

    The statistics are computed once and stored; base failures are left out of
    learning because the base already rejects them.
    """
    stats = stored(text_statistics(docs), "statistics")
    marks = labels.groupBy("doc_id").agg(F.max("quality").alias("label"))
    labelled = stored(stats.filter(~base_failed()).join(marks, "doc_id").withColumn("prune", F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0), "labelled")
    rules = learn_rules(labelled, **options)
    rule = verdict(rules)
    out = stats.withColumn("base_failed", base_failed()).withColumn("rule", rule)
    return out.withColumn("kept", ~F.col("base_failed") & (F.coalesce(label_of(F.col("rule"), rules), F.lit(1)) == 1)), rules


def op10_quality_rules(spark, folder: str) -> DataFrame:
    out, _ = apply_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return out.select("doc_id", *STATISTICS, "base_failed", "kept", "rule")
