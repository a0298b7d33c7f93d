"""Results that must be whole where inputs are unusual: key listings, hidden words, seams, repeated ids."""

import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelle.llm import chat, pages, rules, secrets, toxicity

from .helpers import documents, words

PROSE = "The quick brown fox jumps over the lazy dog while seventeen other animals of the forest are watching it from afar. " * 3


# secrets

def random_found(spark, texts):
    rows = secrets.find_secrets(documents(spark, texts)).collect()
    return {r["doc_id"]: [r["text"][s["start"]:s["end"]] for s in r["spans"] if s["kind"] == 3] for r in rows}


def test_key_listings_do_not_hide_keys(spark):
    rng = random.Random(12)
    symbols = secrets.UPPER + secrets.LOWER + secrets.DIGIT + "+/"
    key = lambda: "".join(rng.choice(symbols) for _ in range(64))
    blocks = [[key() for _ in range(50)] for _ in range(8)]  # a hot source of key listings, one key a line
    alone = [key() for _ in range(60)]
    texts = [PROSE + "\n" + "\n".join(b) for b in blocks] + [f"{PROSE} {k} end" for k in alone]
    got = random_found(spark, texts)
    assert sum(k in got[i] for i, b in enumerate(blocks) for k in b) >= 0.9 * 400
    assert sum(got[8 + i] == [k] for i, k in enumerate(alone)) >= 0.9 * 60


def test_decoys_are_ordinary_text(spark):
    rng = random.Random(3)
    key = lambda n=40: "".join(rng.choice(secrets.LOWER + secrets.UPPER + secrets.DIGIT) for _ in range(n - 3)) + "aB1"
    texts = ["\n".join(key() for _ in range(5)), f"{PROSE} password={key(12)}.{key(12)} and {key()}", f"{PROSE}{key(19)}_token={key(12)} é😀 {key()}", PROSE, None]
    text = F.coalesce("text", F.lit(""))
    for r in documents(spark, texts).select("doc_id", secrets._ordinary(text).alias("o"), secrets.tokens(text).alias("t")).collect():
        want = texts[r["doc_id"]] or ""
        for p in (secrets.ASSIGN, secrets.TOKEN):
            for m in re.finditer(p, texts[r["doc_id"]] or "", re.A):
                want = want[:m.start()] + " " * len(m[0]) + want[m.end():]
        assert r["o"].replace("-", " ") == want
        assert [t["decoy"] is None for t in r["t"]] == ([True] * 5, [False], [False, False], [], [])[r["doc_id"]]


def test_identifiers_are_no_secrets(spark):
    """Ordinary identifiers alone, or after prose, stay; keys among them are found."""
    rng = random.Random(7)
    parts = "Get User Name List Item Order Create Update Delete Account Customer Invoice Report Status Handler Factory Service Manager".split()
    name = lambda: "".join(rng.sample(parts, rng.randint(4, 6))) + str(rng.randrange(10, 100))
    for lead in ("", PROSE):
        texts = [lead + name() for _ in range(400)]
        found = sum(len(v) for v in random_found(spark, texts).values())
        assert found == 0, found
    symbols = secrets.UPPER + secrets.LOWER + secrets.DIGIT
    keys = ["".join(rng.choice(symbols) for _ in range(38)) + "aB1" for _ in range(300)]
    names = [name() for _ in range(300)]
    prose = lambda: " ".join(rng.sample(PROSE.split(), 40))
    got = random_found(spark, [f"{prose()} {x} end" for x in keys + names])
    hits, false = sum(got[i] == [k] for i, k in enumerate(keys)), sum(bool(got[300 + i]) for i in range(300))
    assert hits >= 0.9 * 300 and false <= 0.05 * (hits + false), (hits, false)


# chat

def test_texts_are_unescaped_one_by_one(spark):
    seams = [("a <", "|b"), ("a <\\", "|b"), ("<", "\\|b"), ("x <\\\\", "\\|<|"), ("<", "")]
    rows = [(c, t, "assistant", text) for c, pair in enumerate(seams) for t, text in enumerate((*pair, "|end"))]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r["conv_id"]: r["loss_text"] for r in chat.read_back(chat.format_chats(frame)).collect()}
    assert got == {c: "".join(pair) + "|end" for c, pair in enumerate(seams)}


# pages

def test_hidden_is_an_attribute_and_no_word_of_a_value():
    page = "<article><p>Before it, <span {}>the middle part</span> and after it.</p></article>"
    for shown in ('title="what is hidden here"', "alt='hidden'", 'data-a="x hidden"', 'data-b=" aria-hidden=true display:none"', "data-hidden", 'title="class=menu"', "title=a/hidden"):
        assert pages.main_text(page.format(shown)) == "Before it, the middle part and after it.", shown
    for gone in ("hidden", "HIDDEN=''", 'title="a b" hidden', "class=x hidden=until-found", 'aria-hidden="true"', "aria-hidden = true", 'style="color:red; display : none"'):
        assert pages.main_text(page.format(gone)) == "Before it, and after it.", gone


def test_text_of_formulas_stays():
    page = "<article><p>The sum <math display=block><mrow><mi>a</mi><mo>+</mo><mspace hidden/><mn>1</mn></mrow></math> is known, as said.</p></article>"
    assert pages.main_text(page) == "The sum a+1 is known, as said."


# toxicity

def test_sample_has_one_row_for_each_id(spark, monkeypatch):
    rng = random.Random(5)
    texts = [words(rng, 40) + (" awful" if i % 5 == 0 else "") for i in range(200)]
    more = [words(rng, 40) for _ in range(300)]
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(200)], "doc_id bigint, toxic int")
    same = docs.union(documents(spark, more).withColumn("doc_id", F.lit(2).cast("bigint"))).union(docs)
    sizes = []
    fit = toxicity.fit_machine
    monkeypatch.setattr(toxicity, "fit_machine", lambda keys, at, *rest, **options: sizes.append(len(at)) or fit(keys, at, *rest, **options))
    machines = [toxicity.learn(x, labels, epochs=2) for x in (docs, same, same.repartition(7))]
    assert sizes[0] == sizes[1] == sizes[2] < 200
    assert machines[1].keys.tolist() == machines[2].keys.tolist() and np.allclose(machines[1].w, machines[2].w)


@pytest.mark.parametrize("unit, rest", [
    ("<div>x ", ""), ("<title>x ", ""), ("<span><h1>y ", ""), ("<![CDATA[ z", ""), ("<a ", ""), ("<b>x", ""), ("<a '>k", ""), ("<ul><li>x", ""), ("<p>Words, here.</p><p class=ad>no</p>", "")])
def test_pages_of_a_megabyte_take_seconds(unit, rest):
    began = time.time()
    pages.main_text(unit * (1_000_000 // len(unit)) + rest)
    assert time.time() - began < 30


def test_article_text_survives_words_of_a_class():
    long = "The court held that it, in all its parts, applies."
    assert pages.main_text(f'<article><h1>T</h1><section class="legal"><p>{long}</p></section><p>After that, {long}</p></article>') == f"T {long} After that, {long}"
    for name in ("share-price header", "tags-list toc", "search"):
        assert pages.main_text(f'<article><div class="{name}"><p>{long}</p></div><div class="comments"><p>{long}</p></div></article>') == long
    assert pages.main_text(f'<article><p>{long}</p><div class="share">Share: <a href="a">one</a> <a href="b">two</a></div></article>') == long
    assert pages.main_text(f'<div class="legal"><p>{long}</p></div>') == ""


def test_unclosed_parts_of_a_page():
    assert pages.main_text("<article><title>gone</title><p>One, two.</p><title>Kept, here.") == "One, two. Kept, here."
    assert pages.main_text("<article><p>One, <![CDATA[two & <b>]]> three.</p><![CDATA[ lost>Four, five.") == "One, two & <b> three. Four, five."
    assert pages.main_text("<article><p>One, two.</p><a title='x>Three, four.</a></article>") == "One, two. Three, four."


# rules

def plain_list(rows, found):
    """First rule that holds, by plain comparisons; None where there is none."""
    value = {
        "n_words": lambda r: r["n_words"], "mean_word": lambda r: r["word_chars"] / max(1, r["n_words"]),
        "symbol_share": lambda r: r["n_symbols"] / max(1, r["word_chars"]), "symbols_per_word": lambda r: r["n_symbols"] / max(1, r["n_words"]),
        "dup_lines_per_word": lambda r: r["n_dup_lines"] / max(1, r["n_words"]), "repeat_share": lambda r: r["n_repeat_words"] / max(1, r["n_words"]),
        "upper_share": lambda r: r["n_upper"] / max(1, r["word_chars"]), "mark_share": lambda r: r["n_marks"] / max(1, r["word_chars"]),
    }
    holds = lambda r, rule: all((value[n](r) > t) if side == ">" else (value[n](r) <= t) for n, side, t in rule.conditions)
    return [next((i for i, rule in enumerate(found, 1) if holds(r, rule)), None) for r in rows]


def test_list_has_both_labels_and_ends_by_its_criteria(spark):
    rng = random.Random(11)

    def row(i):
        """Good: few symbols, or many symbols and long words. Some labels are noise."""
        symbols, size, upper = rng.choice([0, 1, 40]), rng.choice([4, 12]), rng.randrange(200)
        label = int(symbols < 40 or size == 12)
        return i, 100, 100 * size, symbols, 0, 0, upper, 0, label if rng.random() > 0.004 else 1 - label, rng.random() < 0.33

    names = ["doc_id", *rules.STATISTICS, "n_upper", "n_marks", "label", "prune"]
    frame = spark.createDataFrame([row(i) for i in range(900)] + [(-1, 60, 100, 0, 0, 0, 0, 0, None, False)], ", ".join(
        f"{n} {'boolean' if n == 'prune' else 'bigint'}" for n in names)).cache()
    found = rules.learn_rules(frame)
    assert {r.label for r in found} == {0, 1} and all(len(r.conditions) <= 3 for r in found)
    got = frame.withColumn("rule", rules.verdict(found)).collect()
    assert [r["rule"] for r in got] == plain_list(got, found)
    # Each rule has its precision on what earlier rules left, and enough rows.
    known = [r for r in got if r["label"] is not None]
    for i, rule in enumerate(found, 1):
        own = [r["label"] for r in known if r["rule"] == i]
        assert own.count(rule.label) >= 0.97 * len(own) and own.count(rule.label) >= max(5, 0.005 * sum(r["label"] == rule.label for r in known))
    # What is left over is told.
    for r in rules.uncovered(frame, found).collect():
        same = [x for x in known if x["label"] == r["label"]]
        assert (r["n_rows"], r["n_uncovered"]) == (len(same), sum(x["rule"] is None for x in same))
        assert r["n_wrong"] == sum(x["rule"] is not None and found[x["rule"] - 1].label != x["label"] for x in same)
    assert len(rules.learn_rules(frame, max_rules=1)) == 1
    assert rules.uncovered(frame, []).agg(F.sum("n_uncovered")).first()[0] == len(known)
