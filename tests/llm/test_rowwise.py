"""Operators that judge each row alone, against plain versions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelle.llm import chat, decontam, pages, rules, secrets, toxicity

from .helpers import awkward_texts, documents, words


# chat

def test_chat_masks_and_round_trip(spark):
    texts = ["", None, "plain", "<|im_end|><|im_start|>assistant ok", "<\\|x <\\\\| <| a|", "é😀\n\n  tail ", "<", "|", "<|endoftext|>", "\\", "한국어 text"]
    roles = ["user", "assistant", "assistant", None, "system"]
    rows = [(c, t, roles[(c + t) % 5], texts[(c * 3 + t) % len(texts)]) for c in range(8) for t in range(c)]
    rows += [(None, 0, "assistant", "no id"), (50, None, "assistant", "no turn"), (50, 1, "assistant", "same"), (50, 1, "assistant", "same")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("starts", F.lit(1))
    chats = chat.format_chats(frame.repartition(3))
    back = {r["conv_id"]: r for r in chat.read_back(chats).collect()}
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        assert [(t["role"], t["text"]) for t in back[c]["turns"]] == [(r[2] or "", r[3] or "") for r in own]
        assert back[c]["loss_text"] == "".join(r[3] or "" for r in own if r[2] == "assistant")
    for r in chats.collect():
        assert len(r["token_ids"]) == len(r["starts"]) == len(r["ends"]) == len(r["loss_mask"])
    assert chat.format_chats(frame.limit(0)).count() == 0


def test_token_mask_equals_a_plain_test():
    starts, ends = np.array([0, 3, 5, 5, 8, 10]), np.array([3, 5, 8, 8, 10, 12])
    for spans in ([(3, 8)], [(0, 3), (8, 12)], [(5, 5)], []):
        want = [any(a <= s and e <= b for a, b in spans) for s, e in zip(starts, ends)]
        assert chat.token_mask(starts, ends, spans).tolist() == want


# secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def plain_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


SECRETS = awkward_texts() + [
    "password: hunter22 x", 'API_KEY = "abcdef123"', "secret=token:abcdefghi", "token=ab token = 'abcdef'", "AKIA" + "A1" * 8 + "AKIA" + "B2" * 9,
    "a" * 24 + " " + "0123456789abcdef" * 3, "é" * 10 + "passwd=0123456789abcdef0123456789", "secret:" + "x" * 5, "apikey:" * 50 + "zzzzzz",
    " ".join(f"token={i:06d}" for i in range(1500)),
]


def test_base_spans(spark):
    frame = documents(spark, SECRETS).withColumn("limits", F.lit(0)).withColumn("tokens", F.lit("t"))
    x = secrets.find_secrets(frame)
    assert x.columns == [*frame.columns, "base", "spans"]
    for r in x.collect():
        assert [tuple(s) for s in r["base"]] == plain_spans(SECRETS[r["doc_id"]])
        assert set(r["base"]) <= set(r["spans"])


def test_redact(spark):
    x = secrets.find_secrets(documents(spark, SECRETS)).withColumn("out", secrets.redact(F.col("text"), F.col("spans")))
    for r in x.collect():
        text, want, at = r["text"], "", 0
        if text is None:
            assert r["out"] is None
            continue
        for s in r["spans"]:
            want += text[at:s["start"]] + "\0" if s["start"] > at or not at else ""
            at = max(at, s["end"])
        assert r["out"] == (want + text[at:]).replace("\0", "[SECRET]") if r["spans"] else r["out"] == text


def test_random_tokens_are_told_from_ordinary_ones(spark):
    rng = random.Random(9)
    symbols = secrets.UPPER + secrets.LOWER + secrets.DIGIT
    lead = "The quick brown fox jumps over the lazy dog while seventeen other animals of the forest are watching it from afar. " * 2
    random_ones = ["".join(rng.choice(symbols) for _ in range(rng.randrange(30, 60))) for _ in range(60)]
    ordinary = ["Aaaaaaaaaaaaaaaaaaaaaaaaaaaa11", "ThisIsAVeryLongIdentifierOfTheTestNumber1", "abcABC123abcABC123abcABC123abcABC123"] * 5
    texts = [f"{lead} {t} end" for t in random_ones + ordinary]
    got = {r["doc_id"]: [r["text"][s["start"]:s["end"]] for s in r["spans"] if s["kind"] == 3] for r in secrets.find_secrets(documents(spark, texts)).collect()}
    assert sum(got[i] == [t] for i, t in enumerate(random_ones)) >= 54
    assert not any(got[60 + i] for i in range(len(ordinary)))


def test_secrets_of_nothing(spark):
    assert secrets.find_secrets(documents(spark, ["a"]).limit(0)).count() == 0


# pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header class="site-header"><a href="/">Home</a></header><nav><ul><li><a href=x>Menu one</a><li><a href=y>Menu two</a></ul></nav>
<div id="cookie-notice"><p>We use cookies, please accept them all now.</p></div>
<div class="ad">Buy this now, it is very cheap today.</div>
<main><article><h1>Title &amp; more</h1><p>First   sentence, with <b>bold</b> text.<p>Second &eacute;&#233; one.<br>New line
<script>var x = "<p>no</p>";</script><table><tr><td>Cell one, here<td>Cell two</table><ul><li>A listed point, with words.</ul>
<div class="comments"><p>Reader: what a nice article, thanks a lot!</p></div></article></main>
<aside class=sidebar><p>Related stories, all of them long enough to matter here.</p></aside>
<form><label>Name</label><input><p>Subscribe to our newsletter, it is free.</p></form><footer><p>&copy; 2020 All rights reserved, by us.</p></footer>"""


def test_main_text_of_a_page():
    assert pages.main_text(PAGE) == (
        "Title & more First sentence, with bold text. Second éé one. New line Cell one, here Cell two A listed point, with words.")


def test_pages_of_all_kinds(spark):
    htmls = [None, "", "plain words, without any markup at all.", "<p", "<nav><a href=x>only</a></nav>", "<article><p>" + "Long text, so long. " * 5000, PAGE,
             "<article>" * 300 + "Deep text, here." + "</p>" * 300]
    frame = spark.createDataFrame([(i, f"u{i}", h, "x") for i, h in enumerate(htmls)] + [(6, "u6", PAGE, "x")], "page_id bigint, url string, html string, n_chars string")
    got = pages.with_main_text(frame).collect()
    text = {r["page_id"]: r["text"] for r in got}
    assert len(got) == 9 and text[0] == text[1] == text[4] == "" and text[6] == pages.main_text(PAGE)
    assert text[5] == " ".join(["Long text, so long."] * 5000) and text[7] == "Deep text, here."
    assert pages.with_main_text(frame.limit(0)).count() == 0


def test_minimum_cut_equals_the_best_of_all_labellings():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randrange(1, 8)
        costs = [(rng.random() * 3, rng.random() * 3) for _ in range(n)]
        ties = [(a, b, rng.random() * 2) for a in range(n) for b in range(a) if rng.random() < 0.5]
        price = lambda side: sum(d if s else u for s, (u, d) in zip(side, costs)) + sum(c for a, b, c in ties if side[a] != side[b])
        best = min(price([bool(k >> i & 1) for i in range(n)]) for k in range(1 << n))
        assert price(pages.min_cut(costs, ties)) == pytest.approx(best)


# decontamination

def test_fm_index_finds_all_places():
    rng = np.random.default_rng(3)
    for _ in range(30):
        runs = [rng.integers(1, 4, rng.integers(1, 40)) for _ in range(rng.integers(1, 6))]
        text = np.concatenate([np.append(r, 0) for r in runs])
        index = decontam.FMIndex(text, 3)
        for size in (1, 2, 4):
            phrases = rng.integers(1, 4, (10, size))
            found = {}
            for w, a, b in zip(*index.search(phrases)):
                found[int(w)] = sorted(index.locate(np.arange(a, b)).tolist())
            for k, p in enumerate(phrases):
                want = [i for i in range(len(text) - size + 1) if (text[i:i + size] == p).all()]
                assert found.get(k, []) == want


def test_contamination_like_brute_force(spark):
    rng = random.Random(4)
    items = [words(rng, 30, 4000), words(rng, 13, 4000), "Short ITEM here", "", None, words(rng, 20, 4000)]
    texts = awkward_texts() + [
        f"{words(rng, 40)} {items[0]} {words(rng, 300)}", items[1].upper(), "a short, item; here b short item", items[5][: len(items[5]) // 2],
        " ".join([items[0]] * 3 + items[0].split()[5:25]), "É" + items[1], "short item here " * 400,
    ]
    bench = spark.createDataFrame([*enumerate(items), (2, items[2])], "item_id bigint, text string")
    x = decontam.find_contamination(documents(spark, texts).withColumn("n_words", F.lit("x")), bench)
    windows = {}
    for i, t in enumerate(items):
        w = decontam.words_of(t)
        k = min(13, len(w))
        for p in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[p:p + k]), set()).add(str(i))
    for r in x.collect():
        w = decontam.words_of(texts[r["doc_id"]])
        hit, found = [False] * len(w), set()
        for k in {len(p) for p in windows}:
            for p in range(len(w) - k + 1):
                if own := windows.get(tuple(w[p:p + k])):
                    hit[p:p + k] = [True] * k
                    found |= own
        f = r["found"]
        assert f["n_words"] == len(w) and f["items"] == sorted(found)
        mine = [False] * len(w)
        for s in f["spans"]:
            mine[s["first"]:s["last"]] = [True] * (s["last"] - s["first"])
        assert mine == hit
    assert decontam.find_contamination(documents(spark, texts), bench.limit(0)).filter("size(found.items) > 0").count() == 0
    assert decontam.find_contamination(documents(spark, texts).limit(0), bench).count() == 0


def test_blocks_of_test_items_do_not_change_the_result(spark):
    bench = spark.createDataFrame([(i, words(random.Random(i), 20)) for i in range(9)], "item_id bigint, text string")
    blocks = list(decontam.phrase_blocks(bench, 150))
    assert len(blocks) > 3
    texts = [words(random.Random(i), 20) + " zz " + words(random.Random(i + 1), 20) for i in range(8)]
    assert decontam.scan_shard(texts, blocks) == decontam.scan_shard(texts, list(decontam.phrase_blocks(bench)))


def test_one_pass_for_each_block_finds_the_same(spark, monkeypatch):
    rng = random.Random(6)
    items = [words(rng, 200, 3000), words(rng, 13, 3000), "short item", "", None, words(rng, 90, 3000), "short item here"]
    texts = awkward_texts() + [
        f"{words(rng, 30)} {items[0]} {items[5]} {words(rng, 30)}", f"x {items[1]} short item here", " ".join(items[0].split()[20:60]), " ".join(items[5].split()[-14:])]
    bench = spark.createDataFrame([*enumerate(items), (None, items[1])], "item_id bigint, text string")
    docs = documents(spark, texts + texts[-2:]).withColumn("Found", F.lit("x")).withColumn("k", F.lit(1))
    plain = lambda x: sorted(map(repr, x.select("doc_id", "k", "found").collect()))
    whole = plain(decontam.find_contamination(docs, bench))
    monkeypatch.setattr(decontam, "PIECE_WORDS", 40)
    assert sum(1 for _ in decontam.item_pieces(bench).collect()) > len(items)
    split = decontam.find_contamination(docs, bench, block_bytes=300)
    assert split.columns == ["doc_id", *[c for c in docs.columns if c not in ("doc_id", "Found")], "found"] and plain(split) == whole


# rules

def plain_statistics(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    count, hit = Counter(windows), set()
    for i, x in enumerate(windows):
        if count[x] > 1:
            hit |= {i, i + 1, i + 2}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_statistics(spark):
    texts = awkward_texts() + ["a\nb\na\n\n \n \na", "a b c a b c", "#*$%&|<> x", "x y z " * 30, " a\x0bb\x0cc\rd "]
    frame = documents(spark, texts).withColumn("words", F.lit(1)).withColumn("n_words", F.lit("clash"))
    got = {r["doc_id"]: tuple(r[c] for c in rules.STATISTICS) for r in rules.text_statistics(frame).collect()}
    assert got == {i: plain_statistics(t) for i, t in enumerate(texts)}
    assert rules.text_statistics(frame.limit(0)).count() == 0


def test_rules_are_learned_and_keep_good_documents(spark):
    rng = random.Random(6)
    texts = [words(rng, 80) if i % 4 else " ".join(w + "$$$" for w in words(rng, 80).split()) for i in range(240)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(160)] + [(None, 1), (3, None)], "doc_id bigint, quality int")
    out, found = rules.apply_rules(documents(spark, texts), labels)
    assert found and all(len(r.conditions) <= 3 for r in found)
    assert {r["doc_id"] for r in out.collect() if not r["kept"]} == {i for i in range(240) if i % 4 == 0}
    out, found = rules.apply_rules(documents(spark, texts), labels.limit(0))
    assert found == [] and out.filter("kept").count() == 240


# toxicity

def test_machine_learns_a_pair_of_terms():
    rng = random.Random(1)
    at = [np.array(sorted(rng.sample(range(6), 3))) for _ in range(3000)]
    y = np.array([int(0 in a and 1 in a) for a in at])
    m = toxicity.fit_machine(np.arange(6), at, y, float(y.mean()))
    score = np.array([m.score(a) for a in at])
    assert score[y == 1].min() > score[y == 0].max()
    assert 0 <= m.score(np.empty(0, int)) <= 1


def test_score_keeps_rows_and_learns_only_what_is_not_held_out(spark):
    rng = random.Random(8)
    texts = [words(rng, 40) + (" awful" if i % 5 == 0 else "") for i in range(400)]
    docs = documents(spark, texts).withColumn("score", F.lit("clash")).withColumn("toxicity", F.lit(1))
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)] + [(None, 1), (7, None)], "doc_id bigint, toxic int")
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i in range(400) if i % 5}
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.learn(docs, x) for x in (labels, flipped))
    assert a.keys.tolist() == b.keys.tolist() and np.allclose(a.w, b.w)
    odd = toxicity.with_score(documents(spark, awkward_texts()), a)
    assert all(0 <= r["score"] <= 1 for r in odd.collect()) and odd.count() == len(awkward_texts())
    assert toxicity.with_score(docs.limit(0).drop("score"), a).count() == 0
    nothing = toxicity.learn(docs, labels.limit(0))
    assert toxicity.with_score(docs.drop("score"), nothing).filter("score >= 0.7").count() == 0


def test_held_out_is_the_stated_remainder(spark):
    import zlib

    got = {r[0]: r[1] for r in spark.range(500).select(F.col("id").alias("doc_id")).select("doc_id", toxicity.held_out()).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in range(500)}


def test_digest_is_comma_joined(spark):
    r = secrets.find_secrets(documents(spark, ["token=abcdef " + "0" * 24])).select(secrets.digest(F.col("base")).alias("d")).first()
    assert r["d"] == "assign:0:12,hex:13:37"
    assert hashlib.sha256(r["d"].encode()).hexdigest()
