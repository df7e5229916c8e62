"""Jaccard join, line dedup, quality rules and packing against brute force."""

import hashlib
import itertools
import json
import random
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import brute
from weftline.llm import components, jaccard_join, line_dedup, packing, quality_rules
from weftline.llm.queries import QUERIES

ROOT = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, n string, key string, line string"
WORDS = public_tokenizers.path("word_bpe_49k.json")


def frame(spark, rows):
    """Documents with more columns, whose names the operators use themselves."""
    return spark.createDataFrame([(d, t, s, None, "x", "y") for d, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet(f"{ROOT}/documents.parquet").select("doc_id", "text", "source").collect()
    return [tuple(r) for r in rows]


@pytest.fixture(scope="module")
def made():
    """Small and large sets, chains of near copies, copies, shared passages."""
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(3))
    rows, passage = [], " ".join(word() for _ in range(60))
    for size in (1, 3, 4, 5, 6, 8, 9, 10, 12, 15, 20, 30, 60, 80, 200):
        for _ in range(2):
            text = [word() for _ in range(size)]
            for _ in range(8):  # a chain: each differs a little from the one before
                rows.append(" ".join(text))
                text = list(text)
                text[draw.randrange(size)] = word()
    rows += [passage + " " + " ".join(word() for _ in range(n)) for n in (5, 10, 20, 40, 80) * 3]
    rows += ["", None, " \n\t", "One two THREE four FIVE", "one\ttwo three  four five", "é à b c d e"]
    rows += rows[:5]
    draw.shuffle(rows)
    return [(i, t, "s") for i, t in enumerate(rows)]


def test_jaccard_components(spark, made):
    want = brute.components([(d, t) for d, t, _ in made])
    got = jaccard_join.jaccard_components(frame(spark, made)).collect()
    assert len(got) == len(made)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert any(c != d for d, (_, c) in want.items())


def test_tallies_bound_the_intersection():
    draw = np.random.default_rng(8)
    for n, m, shared in ((1, 1, 1), (5, 6, 5), (300, 350, 20), (300, 300, 299), (900, 1200, 100), (5000, 700, 600)):
        common = draw.integers(0, 2**63, shared, dtype=np.uint64)
        a, b = (np.unique(np.concatenate([common, draw.integers(0, 2**63, k - shared, dtype=np.uint64)])) for k in (n, m))
        most = jaccard_join.most_shared(jaccard_join.tally(a), jaccard_join.tally(b))
        assert len(np.intersect1d(a, b)) <= most <= min(n, m)
    few, many = (draw.integers(0, 2**63, 300, dtype=np.uint64) for _ in range(2))
    assert jaccard_join.most_shared(jaccard_join.tally(few), jaccard_join.tally(many)) < 250
    same_bin = np.arange(300, dtype=np.uint64) << np.uint64(40)
    assert jaccard_join.tally(same_bin) == b"" and jaccard_join.most_shared(b"", jaccard_join.tally(few)) is None


@pytest.mark.parametrize("boundary", [0, 8, 64])
def test_any_boundary_finds_the_same(spark, made, boundary, monkeypatch):
    monkeypatch.setattr(jaccard_join, "light_size", lambda *a: boundary)
    want = brute.components([(d, t) for d, t, _ in made])
    got = jaccard_join.jaccard_components(frame(spark, made)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_salted_keys_find_the_same(spark, made, monkeypatch):
    monkeypatch.setattr(jaccard_join, "HOT_LEVEL", 1)
    want = brute.components([(d, t) for d, t, _ in made])
    got = jaccard_join.jaccard_components(frame(spark, made)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


@pytest.mark.parametrize("block", [2, 256])
def test_jaccard_links(spark, made, block, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    odd = [(None, "p q r s t u v w", "s"), (7, "p q r s t u v w", "s"), (7, "p q r s t u v w x", "s"), (7, "other words", "s")]
    rows = made + odd
    links, placed = jaccard_join.jaccard_links(frame(spark, rows))
    links, placed = links.collect(), placed.collect()
    assert len(placed) == len(rows)
    sets = {frozenset(s) for _, t, _ in rows if (s := brute.shingles(t))}
    linked = {x: set() for x in sets}
    for x in sets:
        for y in sets:
            if x != y and 100 * len(x & y) >= 80 * len(x | y):
                linked[x].add(y)
    assert len(links) == len({(r.a, r.b) for r in links}) == sum(map(len, linked.values())) // 2 > 80
    want = sorted((d or 0, len(linked.get(frozenset(brute.shingles(t)), ()))) for d, t, _ in rows)
    assert sorted((r.doc_id or 0, r.n_links) for r in placed) == want
    assert sum(r.set_id is None for r in placed) == sum(not brute.shingles(t) for _, t, _ in rows)
    assert all(100 * r.n_shared >= 80 * (r.n_a + r.n_b - r.n_shared) for r in links)
    none, nowhere = jaccard_join.jaccard_links(frame(spark, rows).limit(0))
    assert none.collect() == [] == nowhere.collect()


@pytest.mark.parametrize("paired", [False, True])
def test_sets_that_are_still_apart(spark, paired):
    """Every pair that meets often enough comes out, and rows do not carry their sets' keys."""
    draw = random.Random(7 + paired)
    odd = jaccard_join.KEY_BITS
    sets = {v: (draw.randrange(8, 30), draw.randrange(6), set(draw.sample(range(60), draw.randrange(1, 25)))) for v in range(60)}
    rows = [(k | (paired and k % 15 == 0) << odd, (v, n), c) for v, (n, c, keys) in sets.items() for k in keys]
    df = spark.createDataFrame(rows, "key long, x struct<v:long,n:int>, c long").repartition(5)
    apart = jaccard_join.still_apart(df, 80)
    want = set()
    for a, b in itertools.combinations(sets, 2):
        (n, c, x), (m, d, y) = sets[a], sets[b]
        needed = -(-80 * (n + m) // 180) - -(-80 * max(n, m) // 100) + 1
        both = x & y
        often = len([k for k in both if not (paired and k % 15 == 0)]) >= needed
        if c != d and 100 * min(n, m) >= 80 * max(n, m) and (often or paired and any(k % 15 == 0 for k in both)):
            want.add((a, b))
    got = [tuple(r) for r in apart.collect()]
    assert want and sorted(got) == sorted(want)
    assert "collect_list" not in apart._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("paired", [False, True])
def test_first_meetings_miss_no_pair(spark, paired):
    """Every two sets that share as many keys as links do come out, those of a component do not."""
    draw = random.Random(11 + paired)
    high = paired << jaccard_join.KEY_BITS
    sets = {v: (draw.randrange(8, 30), draw.randrange(6), {k * k // 60 for k in draw.sample(range(60), draw.randrange(1, 40))}) for v in range(60)}
    rows = [(k | high, v, n) for v, (n, _, keys) in sets.items() for k in keys]
    placed = jaccard_join.placed_keys(spark.createDataFrame(rows, "key long, v long, n int").repartition(5))
    assert {(r.key, r.x.v): r.sets for r in placed.collect()} == {(k | high, v): sum(k in x for _, _, x in sets.values()) for v, (_, _, keys) in sets.items() for k in keys}
    of = spark.createDataFrame([(v, c) for v, (_, c, _) in sets.items()], "v long, c long")
    rows = placed.withColumn("v", F.col("x.v")).join(of, "v").select("key", "x", "after", "c").localCheckpoint()
    got = [tuple(r) for r in jaccard_join.first_meetings(rows, 80).collect()]
    want, shared = set(), set()
    for a, b in itertools.combinations(sets, 2):
        (n, c, x), (m, d, y) = sets[a], sets[b]
        if c != d and 100 * min(n, m) >= 80 * max(n, m) and x & y:
            shared.add((a, b))
            needed = -(-80 * (n + m) // 180) - -(-80 * max(n, m) // 100) + 1
            if len(x & y) >= (needed * (needed + 1) // 2 if paired else needed):
                want.add((a, b))
    assert len(got) == len(set(got)) and want and want <= set(got) < shared
    if not paired:
        assert {tuple(r) for r in jaccard_join.still_apart(rows, 80).collect()} == want


def test_rounds_see_keys_of_many_sets_only(spark, made, monkeypatch):
    """Keys of a few sets are compared at once and do not come back in each round."""
    seen, staged = {}, jaccard_join.staged

    def kept(df, name="stage"):
        seen.setdefault(name, []).append(df := staged(df, name))
        return df

    monkeypatch.setattr(jaccard_join, "staged", kept)
    # Without levels the order of shingles is random, so unlike sets meet, too.
    monkeypatch.setattr(jaccard_join, "levels_of", lambda sketch: np.zeros(len(sketch), np.uint64))
    got = jaccard_join.jaccard_components(frame(spark, made)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.components([(d, t) for d, t, _ in made])
    sets = {r["key"]: r["count"] for r in seen["meeting"][0].groupBy("key").count().collect()}
    left = {r["key"] for df in seen["open"] for r in df.select("key").collect()}
    assert min(sets.values()) == 2 and left and min(sets[k] for k in left) > 8


def test_a_round_joins_rows_with_components_once(spark, monkeypatch):
    """Also of texts that share a passage, and so stay apart."""
    draw = random.Random(9)
    words = lambda n: " ".join("".join(draw.choice("abcdefgh") for _ in range(4)) for _ in range(n))
    passage, rows = words(60), []
    for _ in range(60):
        text = f"{passage} {words(40)}"
        rows += [text, text + " end"]  # linked with each other alone
    rows, joins, staged = [(i, t, "s") for i, t in enumerate(rows)], [], jaccard_join.staged

    def counted(df, name="stage"):
        joins.append((name, df._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter")))
        return staged(df, name)

    monkeypatch.setattr(jaccard_join, "staged", counted)
    monkeypatch.setattr(jaccard_join, "FEW", 1)
    monkeypatch.setattr(jaccard_join, "light_size", lambda *a: 0)
    monkeypatch.setattr(jaccard_join, "levels_of", lambda sketch: np.zeros(len(sketch), np.uint64))
    got = jaccard_join.jaccard_components(frame(spark, rows)).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i - i % 2 for i, _, _ in rows}
    opened = [name for name, _ in joins].count("open")
    assert opened == sum(n for name, n in joins if name in ("located", "several", "open")) > 0


@pytest.mark.parametrize("part", [7, 1 << 17])
def test_components_of_a_long_chain(spark, part, monkeypatch):
    """Vertices in a random order along chains; one part of links needs no rounds."""
    draw, seen, staged = random.Random(3), [], components.staged
    names = draw.sample(range(-500, 5000), 600)
    chains = [names[:400], names[400:401], names[401:]]
    links = [(a, b) for c in chains for a, b in zip(c, c[1:])] * 2 + [(names[0], names[0])]
    monkeypatch.setattr(components, "PART", part)
    monkeypatch.setattr(components, "staged", lambda df, name="stage": seen.append(name) or staged(df, name))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(map(tuple, got)) == sorted((v, min(c)) for c in chains if len(c) > 1 for v in c)
    assert len(seen) == 2 if part > len(links) else len(seen) > 2
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_marks_part_a_group_below_the_threshold(spark):
    """Of copies that all differ a little too much only those that link are taken for pairs."""
    draw = np.random.default_rng(4)
    base = draw.integers(0, 2**63, 130, dtype=np.uint64)
    sets = []
    for k in range(60):
        own = draw.integers(0, 2**63, 20 + k % 2, dtype=np.uint64)  # 110 of 130 and 20 others each
        sets.append(np.unique(np.concatenate([draw.permutation(base)[:110], own])))
    sets += [np.unique(np.concatenate([sets[0][:120], draw.integers(0, 2**63, 10, dtype=np.uint64)]))]
    want = {(a, b) for (a, x), (b, y) in itertools.combinations(enumerate(sets), 2) if 180 * len(np.intersect1d(x, y)) >= 80 * (len(x) + len(y))}
    for x, y in itertools.combinations(sets, 2):
        marks = zip(jaccard_join.mark(x), jaccard_join.mark(y))
        assert sum(((p ^ q) & (1 << 64) - 1).bit_count() for p, q in marks) <= len(np.setxor1d(x, y))
    rows = [(1, (v, len(h)), 99, v, jaccard_join.mark(h)) for v, h in enumerate(sets)]
    df = spark.createDataFrame(rows, "key long, x struct<v:long,n:int>, after int, c long, mark array<long>")
    all_pairs = jaccard_join.first_meetings(df.drop("mark"), 80).count()
    got = {tuple(r) for r in jaccard_join.first_meetings(df, 80).collect()}
    assert want and want <= got and all_pairs == 61 * 60 // 2 and len(got) < all_pairs // 10


def test_shared_postings_once(spark):
    rows = [(5, 1), (5, 2), (5, 2), (5, 2), (5, 3), (6, 1), (6, 1), (7, 4), (8, 1), (8, 2)] * 2
    posted = spark.createDataFrame(rows, "key long, s1 long").withColumn("salt", F.lit(0))
    for size in (1, 3, 10_000):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        got = jaccard_join.shared_postings(posted).collect()
        assert sorted(map(tuple, got)) == [(5, 1), (5, 2), (5, 3), (8, 1), (8, 2)]
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_jaccard_odd_rows(spark):
    text = "a b c d e f g h"
    rows = [(None, text, None), (4, text, None), (7, text, None), (7, text, None), (7, "other words", None), (None, "x", None)]
    got = jaccard_join.jaccard_components(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(None, 4, 4), (4, 4, 4), (7, 4, 4), (7, 4, 4), (7, 1, 7), (None, 1, None)], key=str
    )
    assert jaccard_join.jaccard_components(frame(spark, rows).limit(0)).collect() == []


def test_line_dedup(spark, documents):
    repeated = "This line stands in many documents, as it is a licence."
    rows = documents + [(10_000 + i, f"own {i}\n  {repeated.upper()}\n{repeated}", None) for i in range(6)]
    rows += [(20_000, None, None), (20_001, "", None)]
    want = brute.dedup_lines([(d, t) for d, t, _ in rows])
    got = line_dedup.dedup_lines(frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in got} == want
    assert want[10_005][1] == 0 and want[10_000][1] == 2


def test_line_dedup_small_filters_and_odd_rows(spark, documents):
    want = brute.dedup_lines([(d, t) for d, t, _ in documents], min_docs=2, min_chars=3)
    got = line_dedup.dedup_lines(frame(spark, documents), min_docs=2, min_chars=3, bits=1 << 16)
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in got.collect()} == want
    line = "x" * 40
    rows = [(None, line, None)] * 6 + [(1, line, None)] * 6 + [(k, "y" * 40, None) for k in (1, 1, 2, 3, 4)]
    got = line_dedup.dedup_lines(frame(spark, rows)).collect()
    assert len(got) == len(rows) and sum(r.n_dropped for r in got) == 0  # four documents at most
    assert line_dedup.dedup_lines(frame(spark, rows).limit(0)).collect() == []


def test_quality_rules(spark, documents):
    line = "every page of this host ends with this very line of text"
    rows = documents + [(10_000 + i, f"word{i} a\n{line}", "h") for i in range(9)]
    long = " ".join(f"w{k}" for k in range(60))
    rows += [(20_000 + i, f"{long}\nown {i}", "h") for i in range(9)] + [(20_100, f"{long}\nown 3", "h")]
    rows += [(30_000, None, None), (30_001, "a b c a b c\n\n \n" * 30, None), (30_002, "#*$%&|<> é漢", None)]
    want = brute.judge([(d, s, t) for d, t, s in rows], max_docs=5)
    got = quality_rules.judge_documents(frame(spark, rows), ["doc_id"], max_docs=5).collect()
    assert len(got) == len(rows)
    for r in got:
        s = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert (s, r.n_removed, r.base_failed, r.kept) == want[r.doc_id], r
    assert want[20_000][3] and not want[20_001][3]


def test_quality_rules_clean_texts(spark, documents):
    line = "All pages | Contact us"
    words = " ".join(f"w{k}" for k in range(60))
    rows = documents + [(10_000 + i, f"{words}\n \n{line}\nown {i}\n\n  {line.upper()}", "h") for i in range(9)]
    rows += [(20_000 + i, f"{line}\n{words} {i}", "other") for i in range(3)] + [(30_000, line, "h"), (30_001, None, "h")]
    want = brute.cleaned([(d, s, t) for d, t, s in rows], max_docs=5)
    got = quality_rules.judge_documents(frame(spark, rows), ["doc_id"], max_docs=5, cleaned=True).collect()
    assert {r.doc_id: r.cleaned for r in got} == want and len(got) == len(rows)
    assert want[10_000] == rows[len(documents)][1] and want[10_001] == " \nown 1\n"
    odd = [(None, line, "h")] * 3 + [(1, f"{line}\na", "h"), (1, f"{line}\nb", "h"), (2, f"{line}\na", "h"), (2, f"{line}\na", "h")]
    got = quality_rules.judge_documents(frame(spark, odd), ["doc_id"], max_docs=1, cleaned=True).collect()
    assert sorted((r.doc_id or 0, r.cleaned) for r in got) == [(0, "")] * 3 + [(1, f"{line}\na"), (1, f"{line}\nb"), (2, ""), (2, "")]


def test_quality_rules_count_documents(spark):
    """Copies are documents; a small host's share counts as a large host's number does."""
    words = " ".join(f"w{k}" for k in range(60))
    rows = [(i, f"{words}\nfoot", "copies") for i in range(7)] + [(100 + i, f"{words} {i}\nfoot line", "host") for i in range(5)]
    rows += [(200 + i, f"{words} {i} of its own", "host") for i in range(50)] + [(300 + i, f"{words} x{i}\nfour", "host") for i in range(4)]
    rows += [rows[0]]  # a repeated row is no further document
    want = brute.judge([(d, s, t) for d, t, s in rows], max_docs=100)
    got = quality_rules.judge_documents(frame(spark, rows), ["doc_id"], cleaned=True).collect()
    assert {r.doc_id: (r.n_removed, r.kept) for r in got} == {d: (w[1], w[3]) for d, w in want.items()}
    assert [want[i][3] for i in range(7)] == [True] + [False] * 6
    assert [want[100 + i][1] for i in range(5)] == [0, 0, 0, 0, 0] and want[300][1] == 0
    few = [(i, f"{words} {i}\nfoot line", "host") for i in range(5)]
    got = quality_rules.judge_documents(frame(spark, few), ["doc_id"], cleaned=True).collect()
    assert sorted((r.doc_id, r.n_removed, r.cleaned == f"{words} {r.doc_id}") for r in got) == [(0, 0, False)] + [(i, 2, True) for i in range(1, 5)]


def test_quality_query_removes_lines(spark):
    got = QUERIES["op5_quality_rules"](spark, "/root/testdata/sf0.01").collect()
    assert sum(r.n_removed > 0 for r in got) > 20


def test_quality_rules_odd_rows(spark):
    rows = [(None, "a", None), (None, "a", None), (1, "a", "h"), (1, "b", "h"), (1, "a", "h")]
    got = quality_rules.judge_documents(frame(spark, rows), ["doc_id", "n", "key", "line"], max_docs=0)
    assert len(got.collect()) == len(rows)
    assert quality_rules.judge_documents(frame(spark, rows).limit(0), ["doc_id"]).collect() == []


def test_plan_is_best_fit_decreasing():
    draw = random.Random(1)
    for _ in range(200):
        limit = draw.choice([5, 20, 64])
        counts = {draw.randint(1, limit): draw.randint(1, 30) for _ in range(draw.randint(0, 12))}
        placed = {}
        for length, first, last, sequence, offset in packing.plan_best_fit(counts, limit):
            for k in range(last - first + 1):
                placed.setdefault(sequence + k, []).append((offset, length))
        bins = []
        for length in sorted((x for x, n in counts.items() for _ in range(n)), reverse=True):
            fits = [i for i, room in enumerate(bins) if room >= length]
            if fits:
                bins[min(fits, key=lambda i: bins[i])] -= length
            else:
                bins.append(limit - length)
        assert len(placed) == len(bins)
        check_gapless(placed, limit)
        got = sorted(n for pieces in placed.values() for _, n in pieces)
        assert got == sorted(x for x, n in counts.items() for _ in range(n))
    with pytest.raises(ValueError):
        packing.plan_best_fit({7: 1}, 6)


def check_gapless(placed, limit):
    for pieces in placed.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= limit


def test_words_of_the_tokenizer():
    draw = random.Random(2)
    letters = " \t\n\x1c\x85\xa0 　aabbcZé漢字1２'st'll,.!!—😀éΣİJ̌ǰÀ́²ß"
    some = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 30))) for _ in range(3000)]
    some += ["one <|endoftext|> two", "<|startoftext|>", "<|ENDOFTEXT|> x", "a<|endoftext|><|startoftext|>b", "<|endof text|>"]
    some += ["x" * 5000, "ab " * 3000, "0<|</w> </w>", "don't 'til 'S '' '''s l'l", "x1 1x x. .x x.y 1. .1 é, ß9"]
    mine, library = packing.WordTokenizer(WORDS), Tokenizer.from_file(WORDS)
    for _ in range(2):  # unseen, and then remembered
        for text, data, want in zip(some, mine.encode_all(some), library.encode_batch(some, add_special_tokens=False)):
            assert np.frombuffer(data, "<u4").tolist() == want.ids, text
    assert library.encode("one <|endoftext|> two", add_special_tokens=False).ids == [637, 49407, 1237]


def test_other_tokenizer_files_are_refused(tmp_path):
    with pytest.raises(ValueError):
        packing.WordTokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    rules = json.loads(Path(WORDS).read_text())
    added = [{**t, "normalized": True} for t in rules["added_tokens"]]
    for change in ({"normalizer": None}, {"pre_tokenizer": None}, {"added_tokens": added}):
        (tmp_path / "other.json").write_text(json.dumps(rules | change))
        with pytest.raises(ValueError):
            packing.WordTokenizer(str(tmp_path / "other.json"))


def test_pack_documents(spark, documents):
    rows = documents + [(9000, None, None), (9001, "", None), (9001, "", None), (9002, "long words " * 9000, None)]
    got = packing.pack_documents(frame(spark, rows), "doc_id", WORDS).collect()
    library, placed, pieces = Tokenizer.from_file(WORDS), {}, {}
    for r in got:
        placed.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    check_gapless(placed, 4096)
    for doc_id, text, _ in rows:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        want = [
            (k, at, len(ids[at : at + 4096]), zlib.crc32(ids[at : at + 4096].tobytes()))
            for k, at in enumerate(range(0, len(ids), 4096))
        ]
        assert sorted(set(pieces[doc_id])) == want
    assert len(pieces[9001]) == 2
    assert len(placed) <= -(-sum(r.length for r in got) // 4096) + 1
    assert packing.pack_documents(frame(spark, rows).limit(0), "doc_id", WORDS).collect() == []


def test_query_digests(spark, documents):
    want = brute.dedup_lines([(d, t) for d, t, _ in documents])
    for r in QUERIES["op2_line_dedup"](spark, ROOT).collect():
        n, dropped, kept = want[r.doc_id]
        assert (r.n_lines, r.n_dropped) == (n, dropped)
        assert r.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()
