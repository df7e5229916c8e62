"""Language ID, classifier, search, token counts and chat templates."""

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from weftline.llm import byte_bpe, chat_format, language_id, quality_classifier, token_counts, topk
from weftline.llm.queries import QUERIES, SAID
from weftline.llm.templates import TemplateError, compile_template, escape, fold_all, parse, unescape

ROOT = "/root/testdata/sf0.01"
BYTES = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_language_held_out_accuracy(spark):
    got = {r.doc_id: r for r in QUERIES["op4_language_id"](spark, ROOT).collect()}
    documents = spark.read.parquet(f"{ROOT}/documents.parquet").collect()
    assert len(got) == len(documents)
    tried = [d for d in documents if zlib.crc32(str(d.doc_id).encode()) % 5 == 0]
    assert {d.doc_id for d in tried} == {i for i, r in got.items() if r.held_out}
    right = sum(got[d.doc_id].lang_pred == d.lang for d in tried)
    assert right >= 0.97 * len(tried)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_odd_rows(spark):
    rows = [(1, "one word and one more", "en"), (2, "ein Wort und noch eins", "de"), (3, "12 34", None), (None, None, "en"), (5, "²", "fr"), (6, "ein", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    model = language_id.learn(df)
    got = {r.doc_id: r.lang_pred for r in language_id.identify(df, ["doc_id"], model).collect()}
    assert got == {1: "en", 2: "de", 3: "und", None: "und", 5: "und", 6: "de"}
    nothing = language_id.learn(df.limit(0))
    assert {r.lang_pred for r in language_id.identify(df, ["doc_id"], nothing).collect()} == {"und"}
    assert language_id.identify(df.limit(0), ["doc_id"], model).collect() == []
    fold = df.select(language_id.held_out(F.col("doc_id"))).collect()
    assert [r[0] for r in fold] == [d is None or zlib.crc32(str(d).encode()) % 5 == 0 for d, _, _ in rows]


def predictions(spark, model, asked):
    """What is told about each text, by the text."""
    df = spark.createDataFrame([(t,) for t in asked], "text string")
    return {r.text: (r.lang_pred, r.score) for r in language_id.identify(df, ["text"], model).collect()}


def same_answers(got, want):
    for text, (lang, score) in want.items():
        assert got[text][1] == pytest.approx(score, abs=1e-3)
        # Where two languages are as good as equal, rounding decides.
        assert got[text][0] == lang or score < 0.501
    assert len(got) == len(want)


def test_unseen_words_back_off(spark):
    rows = [("a", "whole whole quiet q"), ("b", "xyz xyzz ball"), ("c", "unter über")]
    model = language_id.learn(spark.createDataFrame(rows, "lang string, text string"))
    asked = ["whole", "xyzzz", "q", "kkk", "quietly xyz", "ÜBERALL", "字", "holes and balls", "", "12"]
    want = {t: brute.Languages(rows).predict(t) for t in asked}
    same_answers(predictions(spark, model, asked), want)
    assert want["xyzzz"][0] == "b" and want["ÜBERALL"][0] == "c"


@pytest.mark.parametrize("at_hand", [0, 500, 10**6])
def test_language_query_against_brute_force(spark, at_hand):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    fold = language_id.held_out(F.col("doc_id"))
    model = language_id.learn(documents.where(~fold), max_words=at_hand)
    assert len(model.words) <= at_hand
    rows = documents.collect()
    held = {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    plain = brute.Languages([(r.lang, r.text) for r in rows if r.doc_id not in held and r.lang and r.text])
    want = {r.doc_id: plain.predict(r.text) for r in rows}
    same_answers({r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(documents, ["doc_id"], model).collect()}, want)
    if at_hand == 500:
        same_answers({r.doc_id: (r.lang_pred, r.score) for r in QUERIES["op4_language_id"](spark, "/root/testdata/sf0.001").collect()}, want)


def test_capacity_keeps_the_most_frequent(spark):
    rows = [("x", f"w{i}", 2**i) for i in range(12)]
    counts = spark.createDataFrame(rows, "lang string, entry string, n long")
    got = language_id.most_frequent(counts, 4, F.lit(0)).collect()
    assert {r.entry for r in got} == {"w11", "w10", "w9", "w8"}


@pytest.mark.parametrize("at_hand", [0, 300])
def test_language_does_not_depend_on_what_is_broadcast(spark, at_hand):
    df = spark.read.parquet(f"{ROOT}/documents.parquet").select("doc_id", "text", "lang", "source")
    odd = [(None, None, None, "row"), (-1, "", None, "n"), (-1, "² 12", None, "n"), (-2, "字字字 x é\U0001f600", None, "w"), (-3, "zzqqyyzz", None, "w")]
    df = df.where("doc_id % 4 = 0").union(spark.createDataFrame(odd, df.schema)).withColumnRenamed("source", "row")
    train = df.where("doc_id % 3 = 0")
    every, few = (language_id.learn(train, max_words=n) for n in (10**9, at_hand))
    assert len(few.words) <= at_hand
    want, got = (
        sorted((r.doc_id or 0, r.row, r.lang_pred, round(r.score, 12)) for r in language_id.identify(df, ["doc_id", "row"], m).collect())
        for m in (every, few)
    )
    assert got == want
    assert {x[2] for x in want} > {"und"}


def test_words_at_hand_have_their_counts_in_every_language(spark):
    # Cut language by language, "both" stays in "a" alone, with no count in "b".
    rows = [("both " * 5, "a")] + [("both " * 4 + "some " * 9 + "other " * 9, "b")]
    df = spark.createDataFrame(rows, "text string, lang string")
    model = language_id.learn(df, max_words=3)
    assert len(model.words) == 3
    plain = brute.Languages([(lang, text) for text, lang in rows])
    same_answers(predictions(spark, model, ["both"]), {"both": plain.predict("both")})


def test_classifier_agrees_with_labels(spark):
    got = {r.doc_id: r for r in QUERIES["op10_quality_classifier"](spark, ROOT).collect()}
    assert len(got) == spark.read.parquet(f"{ROOT}/documents.parquet").count()
    labels = spark.read.parquet(f"{ROOT}/labels.parquet").collect()
    good = [got[x.doc_id].kept for x in labels if x.quality == 1]
    bad = [not got[x.doc_id].kept for x in labels if x.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) > 0.9


def plain_votes(text, frequent):
    """The labellers, one by one."""
    words = text.split()
    n = len(words)
    if not n:
        return (0,) * 9
    three = lambda x, bad, good: 0 if x > bad else 2 if x < good else 1
    again = sum(a == b for a, b in zip(words, words[1:])) / n
    most = max(words.count(w) for w in set(words)) / n
    return (
        0 if n < 20 else 2 if n >= 60 else 1,
        three(again, 0.1, 0.03),
        three(sum(w.isupper() for w in words) / n, 0.5, 0.2),
        three(sum(c in "#*$%&|<>" for c in text) / len(text), 0.03, 0.005),
        three(text.count("!") / n, 0.3, 0.05),
        three(abs(sum(len(w) for w in words) / n - 6), 4, 2),
        2 if sum(w.lower() in frequent for w in words) / n >= 0.08 else 1,
        three(most, 0.3, 0.15),
        0 if n >= 40 and len(set(words)) / n < 0.3 and again > 0.05 else 1,
    )


def plain_posteriors(found, rounds=100):
    """Expectation-maximisation over documents, one at a time."""
    good = [0.1 if 0 in v else 0.5 if set(v) == {1} else 0.9 for v in found]
    for _ in range(rounds):
        share, logs = sum(good) / len(good), []
        for side in (0, 1):
            weigh = [g if side else 1 - g for g in good]
            table = []
            for k in range(len(found[0])):
                count = [0.1, 0.1, 0.1]
                for v, w in zip(found, weigh):
                    count[v[k]] += w
                table.append([math.log(c / sum(count)) for c in count])
            prior = math.log(max(share if side else 1 - share, 1e-6))
            logs.append([prior + sum(t[x] for t, x in zip(table, v)) for v in found])
        new = [1 / (1 + math.exp(max(-50, min(50, a - b)))) for a, b in zip(*logs)]
        done, good = max(abs(a - b) for a, b in zip(new, good)) < 1e-6, new
        if done:
            break
    return good


def test_classifier_query_against_brute_force(spark):
    root = "/root/testdata/sf0.001"
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{root}/documents.parquet").collect()}
    found = {}
    for t in rows.values():
        for w in {w for w in t.lower().split() if len(w) <= 5 and w.isalpha()}:
            found[w] = found.get(w, 0) + 1
    least = math.ceil(len(rows) * 2 / 100)
    frequent = set(sorted((w for w, n in found.items() if n >= least), key=lambda w: (-found[w], w))[:500])
    labels = dict(zip(rows, plain_posteriors([plain_votes(t, frequent) for t in rows.values()])))
    # All documents are in the sample; the fit is done on a dense matrix.
    features, x = quality_classifier.Features(), np.zeros((len(rows), quality_classifier.BUCKETS))
    for row, t in zip(x, rows.values()):
        np.add.at(row, features(t), 1)
        row /= row.sum()
    used = x.any(0)
    x, y = np.hstack([x[:, used], np.ones((len(rows), 1))]), np.array(list(labels.values()))
    w, total = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for _ in range(150):
        step = x.T @ (1 / (1 + np.exp(-x @ w)) - y) / len(y)
        total += step * step
        w -= step / np.sqrt(total + 1e-12)
    scores = dict(zip(rows, 1 / (1 + np.exp(-x @ w))))
    got = {r.doc_id: r for r in QUERIES["op10_quality_classifier"](spark, root).collect()}
    assert len(got) == len(rows)
    for i, r in got.items():
        assert r.weak_label == pytest.approx(labels[i], abs=1e-4)
        assert r.score == pytest.approx(scores[i], abs=1e-3)
        assert r.kept == (r.score >= 0.5)


def test_a_rare_language_is_not_bad(spark):
    """Clean texts in a language that one document in fifty has get no bad vote for it."""
    draw = random.Random(3)
    usual, rare = (["".join(draw.choice(letters) for _ in range(draw.randint(2, 8))) for _ in range(300)] for letters in ("abcdeft", "wzkyjow"))
    texts = [" ".join(draw.choice(rare if i % 60 == 0 else usual) for _ in range(120)) for i in range(600)]
    texts += ["!!! $$$ *** ### " * 30 + str(i) for i in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in quality_classifier.classify(df, ["doc_id"]).collect()}
    assert all(got[i].kept and got[i].weak_label > 0.9 for i in range(600))
    assert not any(got[i].kept for i in range(600, 640))


def test_labeller_accuracies_from_votes_alone():
    draw, counts = random.Random(4), {}
    truths = {}
    for _ in range(4000):
        good = draw.random() < 0.7
        v = tuple(
            quality_classifier.NOTHING if draw.random() < 0.3
            else (2 if good == (draw.random() < right) else 0)
            for right in (0.9, 0.85, 0.8, 0.8, 0.75)
        )
        counts[v] = counts.get(v, 0) + 1
        truths.setdefault(v, []).append(good)
    posterior = quality_classifier.fit_labellers(counts)
    right = sum(sum((posterior[v] >= 0.5) == g for g in gs) for v, gs in truths.items())
    assert right > 0.85 * 4000
    assert quality_classifier.fit_labellers({}) == {}


def test_classifier_odd_rows(spark):
    rows = [(1, "a b", None), (None, None, 1.0), (2, "", None), (2, "", None), (3, "x " * 30000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double")
    got = quality_classifier.classify(df, ["doc_id"]).collect()
    assert len(got) == 5 and all(math.isfinite(r.score) for r in got)
    assert quality_classifier.classify(df.limit(0), ["doc_id"]).collect() == []


def exact(rows, k):
    vectors = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        x = [math.floor(64 * c) for c in v]
        vectors[i] = min(vectors.get(i, x), x)
    out = {}
    for q, x in vectors.items():
        if q % 20 == 0:
            scored = [(-sum(a * b for a, b in zip(x, y)), i) for i, y in vectors.items() if i != q]
            out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return out


@pytest.mark.parametrize("first", [1, 7, 256])
def test_top_k(spark, monkeypatch, first):
    monkeypatch.setattr(topk, "STEP", first)
    draw = np.random.default_rng(first)
    rows = [(i, draw.normal(size=8).tolist()) for i in range(300)]
    rows += [(i, [0.25] * 8) for i in range(300, 340)]  # ties
    rows += [(400, None), (401, [1.0, None] + [0.0] * 6), (402, [math.nan] * 8), (403, [math.inf] * 8)]
    rows += [(None, [1.0] * 8), (20, rows[20][1]), (21, [5.0] * 8), (404, [3.0, 2.0]), (405, [-1e6] * 8), (406, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("x"))
    got = {}
    for r in topk.top_k(df, F.col("vec_id") % 20 == 0, block=7, n_pivots=5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert {q: sorted(v) for q, v in got.items()} == exact(rows, 20)
    few = df.where("vec_id < 5")
    assert topk.top_k(few, F.col("vec_id") % 20 == 0).count() == 4
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_token_counts(spark):
    encoding, sizes = token_counts.codec(BYTES, public_tokenizers.PATTERN)
    rows = [(1, "s", "one line\n\nanother\n \n"), (2, None, None), (2, None, None), (None, "x", "é漢\n\n\n\n字"), (4, "", "ab " * 9000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("field", F.lit(1))
    got = token_counts.count_tokens(df, ["doc_id"], ["source", "text"], BYTES, public_tokenizers.PATTERN).collect()
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert len(by_doc[2]) == 4
    for doc_id, source, text in rows:
        whole = (source or "") + "\n\n" + (text or "")
        mine = by_doc[doc_id][: len(by_doc[doc_id]) // (2 if doc_id == 2 else 1)]
        ids = encoding.encode_ordinary(whole)
        assert sum(r.n_tokens for r in mine) == len(ids) == mine[0].n_document
        assert "".join(whole[r.start : r.end] for r in mine) == whole
        ends = [len(whole[: r.end].encode()) for r in mine]
        want, at = [0] * len(mine), 0
        for i in ids:
            inside = [0] * len(mine)
            for byte in range(at, at + sizes[i]):
                inside[next(k for k, e in enumerate(ends) if byte < e)] += 1
            want[inside.index(max(inside))] += 1
            at += sizes[i]
        assert [r.n_tokens for r in mine] == want
    empty = token_counts.count_tokens(df.limit(0), ["doc_id"], ["text"], BYTES, public_tokenizers.PATTERN)
    assert empty.collect() == []


@pytest.mark.parametrize("blank", [" ", "\n", " \n\u3000"])
def test_token_counts_of_very_long_blanks(spark, blank):
    """The library gives up on these; the ids are those of this subpackage's encoder."""
    text = "word" + blank * 2_000_000 + "end"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = token_counts.count_tokens(df, ["doc_id"], ["text"], BYTES, public_tokenizers.PATTERN, divider="")
    row = got.collect()[0]
    own = byte_bpe.codec(BYTES, public_tokenizers.PATTERN)
    assert row.n_tokens == row.n_document == len(own.encode(text)) and row.end == len(text)
    encoding, _ = token_counts.codec(BYTES, public_tokenizers.PATTERN)
    short = "word" + blank * 20_000 + "end"
    assert own.encode(short).tolist() == encoding.encode_ordinary(short)


def render(source, messages):
    return list(compile_template(source)(messages))


def test_template_language():
    m = [{"role": "user", "text": "Hi"}, {"role": "assistant", "text": "Yo"}]
    source = "{% for x in messages %}{% if loop.first and not loop.last %}<{% elif x['role'] == \"assistant\" or false %}{% generation %}{{ x.text|lower + '!' }}{% endgeneration %}{% else %}?{% endif %}{{ loop.index }}{% endfor %}"
    assert render(source, m) == [("<", False), ("1", False), ("yo!", True), ("2", False)]
    assert render(source, []) == []


def test_constants_are_folded():
    tree = fold_all(parse("a{{ 'b' + ('c' | upper) }}{% if 1 == 2 or false %}x{% else %}d{% endif %}{{ 3 }}"))
    assert len(tree) == 1 and tree[0].value.value == "abCd3"


@pytest.mark.parametrize(
    "source",
    ["{{ x() }}", "{{ 'a'|eval }}", "{% if 1 %}", "{% import os %}", "{{ }}", "{{ 'a' 'b' }}", "{% for x %}{% endfor %}"],
)
def test_bad_templates(source):
    with pytest.raises(TemplateError):
        compile_template(source)


@pytest.mark.parametrize("source", ["{{ x }}", "{{ messages.__class__ }}", "{% for m in messages %}{{ m.role.upper }}{% endfor %}"])
def test_nothing_else_can_be_reached(source):
    with pytest.raises(TemplateError):
        render(source, [{"role": "user", "text": ""}])


def test_escapes_are_undone():
    draw = random.Random(1)
    for _ in range(5000):
        text = "".join(draw.choice("<|\\>a") for _ in range(draw.randint(0, 9)))
        assert "<|" not in escape(text) and unescape(escape(text)) == text


def digests(turns):
    loss = "".join(t or "" for _, r, t in turns if r == "assistant")
    whole = "".join(f"{r or ''}\n{t or ''}\n" for _, r, t in turns)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return len(turns), sha(whole), len(loss), sha(loss)


def test_chat_round_trip(spark, monkeypatch):
    rows = [
        (1, 0, "user", "<|end|>\n<|start|>assistant<|text|>no<|end|>"), (1, 1, "assistant", "<|\\|<"), (1, 1, "assistant", "<|\\|<"),
        (2, 0, None, None), (2, 1, "assistant", ""), (2, 2, "assistant", None), (2, None, "sys\ntem<|", "é漢😀"),
        (None, 3, "assistant", "a"), (None, 1, "assistant", "b"), (3, 0, "user", "x" * 300_000), (3, 1, "assistant", "<|" * 200_000),
    ]
    rows += [(4, k, "assistant" if k % 2 else "user", f"turn {k} <|") for k in range(5000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(1))
    got = {r.conv_id: tuple(r)[1:5] for r in chat_format.read_back(chat_format.format_chats(df)).collect()}
    want = {}
    for c in (1, 2, None, 3, 4):
        turns = [r[1:] for r in rows if r[0] == c]
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1] or "", t[2] or ""))
        want[c] = digests(turns)
    assert got == want
    parts = chat_format.format_chats(df.where("conv_id = 4")).collect()
    text = "".join(p.text for p in sorted(parts, key=lambda p: p.part))
    assert text.startswith("<|start|>user<|text|>turn 0 <\\|<|end|>\n<|start|>assistant<|text|>")
    assert chat_format.read_back(chat_format.format_chats(df.limit(0))).collect() == []


def test_chat_query(spark):
    turns = {}
    for r in spark.read.parquet(f"{ROOT}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    turns[-1] = [(0, "user", SAID), (1, "assistant", SAID)]
    got = {r.conv_id: tuple(r)[1:5] for r in QUERIES["op6_chat_format"](spark, ROOT).collect()}
    assert got == {c: digests(t) for c, t in turns.items()}
