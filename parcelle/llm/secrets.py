"""Secret scan: fixed patterns, and a battery of randomness tests for tokens of an encoding.

Only DataFrame functions; all work on a row stays in the row.

A token is tested for what random bytes in its encoding look like: chi-squared
tests of uniform symbols, over all symbols and over two coarse divisions of them
(the commonest letters of prose against the rest, lower case against the rest),
a runs test about the middle of the alphabet and a lag-one serial correlation.
The smallest of the five tail probabilities times five is its randomness. Short
identifiers pass such tests by chance more often than long ones, so the
threshold is set per encoding and length band: each token has a decoy, an
identifier of its length, case and digits made of the words before it, put
through the same tests; the lowest threshold at which the decoys that pass are
at most ``max_fdr`` of the tokens that pass is taken, or none. Candidate tokens
and matches of the fixed patterns are no ordinary words, so lists of keys do not
become their own decoys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, table

#: Kinds in listed order with their patterns; fixed values.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX, LEAST_TOKEN = 6, 20, 24, 20

TOKEN = r"[A-Za-z0-9+/_-]{20,}"
UPPER, LOWER, DIGIT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Encoding, what a token of it matches, and its symbols in order of value. The first match counts.
ENCODINGS = (
    ("hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", DIGIT + "abcdef"),
    ("base32", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$", UPPER + "234567"),
    ("base36", r"^(?=.*[0-9])(?:[a-z0-9]+|[A-Z0-9]+)$", DIGIT + LOWER),
    ("base62", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9]+$", UPPER + LOWER + DIGIT),
    ("base64", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/]+$", UPPER + LOWER + DIGIT + "+/"),
    ("base64url", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9_-]+$", UPPER + LOWER + DIGIT + "-_"),
)
#: The commonest letters of prose in European languages.
COMMON = "etaoinsr"
#: Decoys that a false-discovery share is read from at least.
LEAST_DECOYS = 20
GRID = (0.01, 0.02, 0.03, 0.05, 0.07, 0.1, 0.15, 0.2, 0.35, 0.5)
BANDS = 12
_BLOCK = 512
_SPAN = "struct<start:bigint,kind:int,end:bigint>"


def _let(value: Column, body) -> Column:
    """body(value) with value computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _scan(values: Column, zero: int, op) -> Column:
    """Running op over an array of long, in blocks, so that appending stays cheap for long arrays."""
    none = F.array().cast("array<bigint>")

    def inside(acc: Column, v: Column) -> Column:
        return _let(op(acc["last"], v), lambda x: F.struct(x.alias("last"), F.array_append(acc["out"], x).alias("out")))

    def over_blocks(v: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(v) - 1) / _BLOCK).cast("int")), lambda b: F.slice(v, b * _BLOCK + 1, F.lit(_BLOCK)))
        start = F.struct(F.lit(zero).cast("bigint").alias("last"), F.array().cast("array<array<bigint>>").alias("out"))

        def outer(acc: Column, block: Column) -> Column:
            run = F.aggregate(block, F.struct(acc["last"].alias("last"), none.alias("out")), inside)
            return _let(run, lambda r: F.struct(r["last"].alias("last"), F.array_append(acc["out"], r["out"]).alias("out")))

        return F.flatten(F.aggregate(blocks, start, outer, lambda a: a["out"]))

    return F.when(F.size(values) == 0, none).otherwise(_let(values, over_blocks))


def _found(text: Column, pattern: str) -> Column:
    """Leftmost matches with their places: array of (match, start, end), code points, end exclusive.

    The text between matches comes from a split at the same pattern; lengths
    add up to places.
    """
    def place(matches: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        lengths = F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), matches, lambda g, m: (F.length(g) + F.length(m)).cast("bigint"))
        ends = _scan(lengths, 0, lambda a, b: a + b)
        return F.zip_with(matches, ends, lambda m, e: F.struct(m.alias("match"), (e - F.length(m)).alias("start"), e.alias("end")))

    none = F.array().cast("array<struct<match:string,start:bigint,end:bigint>>")
    return F.when(text.rlike(pattern), _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), place)).otherwise(none)


def _overwritten(text: Column, pattern: str, mark: str, keep=None) -> Column:
    """The text with every match (that keep accepts) replaced by as many marks, so that places stay."""
    def over(matches: Column) -> Column:
        marks = F.transform(matches, lambda m: F.when(F.lit(True) if keep is None else keep(m), F.repeat(F.lit(mark), F.length(m))).otherwise(m))
        return F.array_join(F.zip_with(F.split(text, pattern, -1), F.concat(marks, F.array(F.lit(""))), lambda g, m: F.concat(g, m)), "")

    return F.when(text.rlike(pattern), _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), over)).otherwise(text)


def _ordinary(text: Column) -> Column:
    """The text with fixed-pattern matches and all candidate tokens overwritten, places unchanged.

    Access keys and hex runs are parts of candidate tokens. The mark of the
    first step belongs to tokens, so a token that an assignment cuts stays one run.
    """
    long_value = lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= LEAST_VALUE
    return _let(_overwritten(text, ASSIGN, "-", long_value), lambda t: _overwritten(t, TOKEN, " "))


def _kind(found: Column, number: int, keep) -> Column:
    spans = F.transform(F.filter(found, keep), lambda m: F.struct(m["start"].alias("start"), F.lit(number).alias("kind"), m["end"].alias("end")))
    return spans.cast(f"array<{_SPAN}>")


def base_spans(text: Column) -> Column:
    """Sorted spans of the fixed patterns, per kind leftmost and non-overlapping; matches that are too short are dropped."""
    value = lambda m: F.length(F.regexp_extract(m["match"], ASSIGN, 1)) >= LEAST_VALUE
    return F.sort_array(F.concat(
        _kind(_found(text, ASSIGN), 0, value),
        _kind(_found(text, ACCESS), 1, lambda m: F.length(m["match"]) >= LEAST_ACCESS),
        # Runs below the least length are dropped anyway, so they need not be matched.
        _kind(_found(text, HEX.replace("+", f"{{{LEAST_HEX},}}")), 2, lambda m: F.length(m["match"]) >= LEAST_HEX),
    ))


def _upper_tail(z: Column) -> Column:
    """Normal tail probability, by the logistic form good to 2e-4."""
    bounded = F.greatest(F.lit(-8.0), F.least(F.lit(8.0), z))
    return _let(bounded, lambda z: 1 / (1 + F.exp(1.5976 * z + 0.070566 * z * z * z)))


def _randomness(token: Column, encoding: Column) -> Column:
    """Five times the smallest tail probability of the five tests, at most 1, of a token of two or more symbols.

    Letter case does not count where the encoding has one case.
    """
    def of(values) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), encoding)

    alphabets = [e[2] for e in ENCODINGS]
    alphabet, a = of(alphabets), of([float(len(x)) for x in alphabets])
    half = of(["".join("0" if i < len(x) // 2 else "1" for i in range(len(x))) for x in alphabets])
    common = of([sum(c.lower() in COMMON for c in x) / len(x) for x in alphabets])
    lower = of([sum(c.islower() for c in x) / len(x) if UPPER in x and LOWER in x else 0.0 for x in alphabets])
    fold = of([1 if x == x.lower() else 2 if x == x.upper() else 0 for x in alphabets])
    count = lambda s, part: (F.length(s) - F.length(F.replace(s, F.lit(part), F.lit("")))).cast("double") / len(part)

    def battery(s: Column) -> Column:
        n = F.length(s).cast("double")
        symbols = F.split(s, "")
        squares = F.aggregate(
            F.array_distinct(symbols), F.lit(0.0),
            lambda t, c: t + F.pow((F.length(s) - F.length(F.replace(s, c, F.lit("")))).cast("double"), F.lit(2.0)))
        k = a - 1
        z_chi = (F.cbrt(F.greatest(a / n * squares - n, F.lit(0.0)) / k) - (1 - 2 / (9 * k))) / F.sqrt(2 / (9 * k))

        def share(members: str, expected: Column) -> Column:
            """Deviation of the number of these symbols: the root of the chi-squared over two cells."""
            found = n - F.length(F.call_function("translate", s, F.lit(members), F.lit("")))
            return F.when((expected > 0) & (expected < 1), (found - n * expected) / F.sqrt(n * expected * (1 - expected))).otherwise(0.0)

        def runs(bits: Column) -> Column:
            ones = count(bits, "1")
            mean = 2 * ones * (n - ones) / n + 1
            spread = (mean - 1) * (mean - 2) / (n - 1)
            return F.when(spread > 0, (1 + count(bits, "01") + count(bits, "10") - mean) / F.sqrt(spread)).otherwise(F.lit(8.0))

        def serial(v: Column) -> Column:
            zero = F.struct(F.lit(None).cast("double").alias("before"), F.lit(0.0).alias("cross"), F.lit(0.0).alias("power"))
            return _let(F.aggregate(v, F.lit(0.0), lambda t, x: t + x) / n, lambda m: F.aggregate(
                v, zero,
                lambda t, x: F.struct((x - m).alias("before"), (t["cross"] + F.coalesce(t["before"] * (x - m), F.lit(0.0))).alias("cross"),
                                      (t["power"] + (x - m) * (x - m)).alias("power")),
                lambda t: F.when(t["power"] > 0, (t["cross"] / t["power"] + 1 / n) * F.sqrt(n)).otherwise(F.lit(8.0))))

        z_runs = _let(F.call_function("translate", s, alphabet, half), runs)
        z_serial = _let(F.transform(symbols, lambda c: F.position(c, alphabet).cast("double")), serial)
        return _let(
            F.array(_upper_tail(z_chi), _upper_tail(share(COMMON + COMMON.upper(), common)), 2 * _upper_tail(F.abs(share(LOWER, lower))),
                    2 * _upper_tail(F.abs(z_runs)), 2 * _upper_tail(F.abs(z_serial))),
            lambda tails: F.least(F.lit(1.0), 5 * F.array_min(tails)))

    return F.when(token.isNotNull(), _let(F.when(fold == 1, F.lower(token)).when(fold == 2, F.upper(token)).otherwise(token), battery))


def tokens(text: Column) -> Column:
    """Tokens of an encoding: array of (start, end, encoding, band, p, decoy).

    A decoy is what passes by mistake: an identifier. Words of the ordinary text
    in the three lengths before the token are run together, each with a capital
    if the token has capitals, and end in the token's digits. It is null where
    that text is too short. Tokens of less than 20 characters are not tested.
    """
    def encoding(token: Column) -> Column:
        return reduce(lambda out, e: F.when(token.rlike(e[1][1]), F.lit(e[0])).otherwise(out), reversed(list(enumerate(ENCODINGS))), F.lit(None).cast("int"))

    marked = F.filter(
        F.transform(_found(text, TOKEN), lambda m: F.struct(m["match"].alias("match"), m["start"].alias("start"), m["end"].alias("end"), encoding(m["match"]).alias("encoding"))),
        lambda m: m["encoding"].isNotNull())

    def tested(m: Column, ordinary: Column) -> Column:
        n = F.length(m["match"])
        lead = F.substring(ordinary, F.greatest(F.lit(1), m["start"].cast("int") + 1 - 3 * n), F.least(3 * n, m["start"].cast("int")))
        cased = F.when(m["match"].rlike("[A-Z]"), F.initcap(lead)).otherwise(F.lower(lead))
        plain, digits = F.regexp_replace(cased, "[^A-Za-z0-9]", ""), F.regexp_replace(m["match"], "[^0-9]", "")
        decoy = F.when(F.length(plain) >= n, F.concat(F.right(plain, n - F.length(digits)), digits))
        return F.struct(
            m["start"].alias("start"), m["end"].alias("end"), m["encoding"].alias("encoding"),
            F.least(F.lit(BANDS), F.floor(F.log2(n.cast("double"))).cast("int")).alias("band"),
            _randomness(m["match"], m["encoding"]).alias("p"), _randomness(decoy, m["encoding"]).alias("decoy"))

    return _let(_ordinary(text), lambda ordinary: F.transform(marked, lambda m: tested(m, ordinary)))


def thresholds(tested: DataFrame, max_fdr: float = 0.05) -> DataFrame:
    """One row: a map from encoding * 100 + band to the lowest accepted randomness. ``tested`` has the array ``tokens``.

    At that randomness the decoys that pass are at most ``max_fdr`` of the tokens
    that pass, among the tokens that have a decoy. That says little of few: below
    LEAST_DECOYS the counts of the encoding are taken, then those of all tokens,
    and if these are too few as well nothing is accepted. Counts per encoding,
    band and step of the grid: a few hundred rows at any size of the corpus.
    """
    t = tested.select(F.explode("tokens").alias("t")).select("t.encoding", "t.band", "t.p", "t.decoy")
    own = F.col("decoy").isNotNull()
    counts = t.groupBy("encoding", "band").agg(F.count_if(own).alias("n"), *[
        F.count_if(own & (F.col(c) >= g)).alias(f"{c}{i}") for i, g in enumerate(GRID) for c in ("p", "decoy")])
    levels = (Window.partitionBy("encoding", "band"), Window.partitionBy("encoding"), Window.partitionBy())
    limit = F.lit(None).cast("double")
    for level in reversed(levels):
        step = F.lit(None).cast("double")
        for i, g in reversed(list(enumerate(GRID))):
            p, decoy = (F.sum(f"{c}{i}").over(level) for c in ("p", "decoy"))
            step = F.when((p > 0) & (decoy <= max_fdr * p), F.lit(g)).otherwise(step)
        limit = F.when(F.sum("n").over(level) >= LEAST_DECOYS, step).otherwise(limit)
    return counts.select((F.col("encoding") * 100 + F.col("band")).alias("key"), limit.alias("limit")).filter("limit is not null").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "limit")))).alias("limits"))


def find_secrets(docs: DataFrame, max_fdr: float = 0.05, base: str = "base", spans: str = "spans") -> DataFrame:
    """docs with the arrays of spans (start, kind, end): the base ones, and all with the random tokens outside them.

    Whole texts; null counts as empty and has no spans. Rows stay as they are,
    repeated ones too. Spans are in code points, end exclusive, by start and
    kind. Overlong tokens are tested whole.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    limits = thresholds(docs.select(tokens(text).alias("tokens")), max_fdr).scalar()
    limits_name, tokens_name = free_name(docs, "limits"), free_name(docs, "tokens")
    x = docs.withColumn(base, base_spans(text)).withColumn(limits_name, limits).withColumn(tokens_name, tokens(text))
    accepted = F.filter(tokens_name, lambda t: t["p"] >= F.try_element_at(F.col(limits_name), t["encoding"] * 100 + t["band"]))
    apart = F.filter(accepted, lambda t: ~F.exists(F.col(base), lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    extra = F.transform(apart, lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end"))).cast(f"array<{_SPAN}>")
    return x.withColumn(spans, F.sort_array(F.concat(F.col(base), extra))).drop(limits_name, tokens_name)


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every run of overlapping or touching spans replaced by one mark."""
    def rebuilt(s: Column) -> Column:
        ends = _scan(F.transform(s, lambda x: x["end"]), 0, lambda a, b: F.greatest(a, b))

        def pieces(e: Column) -> Column:
            befores = F.concat(F.array(F.lit(0).cast("bigint")), F.slice(e, F.lit(1), F.size(e) - 1))
            pairs = F.filter(F.zip_with(s, befores, lambda x, b: F.struct(x["start"].alias("start"), b.alias("before"))), lambda p: (p["start"] > p["before"]) | (p["before"] == 0))
            part = lambda a, b: F.substring(text, a.cast("int") + 1, (b - a).cast("int"))
            rest = F.substring(text, F.element_at(e, -1).cast("int") + 1, F.length(text))
            return F.array_join(F.concat(F.transform(pairs, lambda p: part(p["before"], p["start"])), F.array(rest)), mark)

        return _let(ends, pieces)

    return F.when(F.size(spans) > 0, _let(spans, rebuilt)).otherwise(text)


def digest(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op2_secrets(spark, folder: str) -> DataFrame:
    x = find_secrets(table(spark, folder, "documents").select("doc_id", "text"))
    of = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return x.select("doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"),
                    F.sha2(digest(F.col("base")).cast("binary"), 256).alias("base_sha256"), digest(F.col("spans")).alias("spans"))
