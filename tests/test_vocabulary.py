"""Growing vocabularies, and looking items up in small and large tables."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from weftline.functions.tokens import RegexTokenizer, stored_vocabulary
from weftline.operators import inspect, vocabulary
from weftline.operators.lookup import hot_entries, look_up
from weftline.session import staged


def texts(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "t string")


def grown(vocab, df, specials=(), **how):
    return staged(vocabulary.grow_vocabulary(vocab, df, F.col("t"), specials, **how), "vocab")


def ids_of(vocab):
    rows = vocab.collect()
    assert len({r.token_id for r in rows}) == len({r.piece for r in rows}) == len(rows)
    return {r.piece: r.token_id for r in rows}


def test_ids_stay_and_go_on_without_a_gap(spark):
    none = vocabulary.no_vocabulary(spark)
    first = grown(none, texts(spark, "a b a", "<s> c", None, ""), ["<s>", "</s>"])
    second = grown(first, texts(spark, "c d", "e <x> a"), ["<x>", "<s>"])
    third = grown(second, texts(spark, "a b", "e"))
    one, two = ids_of(first), ids_of(second)
    assert (one["<s>"], one["</s>"]) == (0, 1) and sorted(one.values()) == [0, 1, 256, 257, 258]
    assert two.items() >= one.items() and ids_of(third) == two
    assert two["<x>"] == 2 and {two["d"], two["e"]} == {259, 260}
    rows = {r.piece: r for r in third.collect()}
    assert (rows["a"].version, rows["a"].n, rows["d"].version, rows["<x>"].special) == (0, 2, 1, True)
    assert vocabulary.special_tokens(second) == ["<s>", "</s>", "<x>"]
    assert vocabulary.vocabulary_tokenizer(second).specials == ("<s>", "</s>", "<x>")


def test_the_order_of_rows_decides_nothing(spark):
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(500)]
    shuffled = words * 2
    random.Random(1).shuffle(shuffled)
    none = vocabulary.no_vocabulary(spark)
    a, b = grown(none, texts(spark, *words)), grown(none, texts(spark, *shuffled).repartition(7))
    assert ids_of(a) == ids_of(b) and sorted(ids_of(a).values()) == list(range(256, 756))


def test_known_tokens_add_nothing_and_reserved_ids_run_out(spark):
    none = vocabulary.no_vocabulary(spark)
    first = grown(none, texts(spark, "plain word"), ["<s>"])
    again = grown(first, texts(spark, "word"), ["<s>", "plain"])
    assert ids_of(again) == ids_of(first) and not again.where("piece = 'plain'").first().special
    with pytest.raises(ValueError):
        grown(first, texts(spark, "x"), ["<a>", "<b>"], reserved=2)
    assert ids_of(grown(none, texts(spark))) == {}


def test_grown_ids_decode_older_data(spark):
    old = texts(spark, "one two <s> three").withColumn("k", F.lit(1))
    first = grown(vocabulary.no_vocabulary(spark), old, ["<s>"])
    tok = vocabulary.vocabulary_tokenizer(first)
    ids = staged(inspect.encode_stored(old, ["k"], F.col("t"), tok, first), "ids")
    later = grown(first, texts(spark, "four five"), ["</s>"])
    assert inspect.decode_ids(ids, ["k"], "ids", later).first().pieces == ["one", "two", "<s>", "three"]


@pytest.mark.parametrize("room", [0, 60, 400, 1 << 20])
def test_any_room_for_hot_entries_gives_the_same(spark, room):
    draw = random.Random(room)
    table = [(f"w{i}", i, 2 ** (12 - i % 12)) for i in range(60)]
    entries = spark.createDataFrame(table, "from string, to long, n long")
    rows = [(draw.choice([None, 1, 2]), [draw.choice(["w3", "w3", f"w{draw.randrange(70)}", None, "é"]) for _ in range(draw.randrange(9))]) for _ in range(300)]
    rows += [(5, None), (5, []), (6, ["w0"] * 2000 + ["new"])]
    df = spark.createDataFrame(rows, "k int, v array<string>").withColumns({"_row": F.lit(1), "to": F.lit("x")}).repartition(3)
    hot = hot_entries(entries, room)
    assert sum(len(x.as_py()) + 2 for x in hot.items) <= max(room, 1) and hot.whole == (room == 1 << 20)
    got = look_up(df, ["k", "to"], "v", entries, -1, "ids", room).collect()
    known = {w: i for w, i, _ in table}
    want = [(k, "x", [known.get(x, -1) for x in v or []]) for k, v in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_found_and_moved_items_are_merged_outside_the_plan(spark):
    """Ids are not made into a struct each and sorted, and a null entry is unknown in either part."""
    entries = spark.createDataFrame([("hot", None, 99), ("a", 1, 98), ("cold", None, 1), ("b", 2, 1)], "from string, to long, n long")
    df = spark.createDataFrame([(1, ["b", "hot", "a", "cold", "no"]), (2, ["hot", "a"]), (3, None)], "k int, v array<string>")
    found = look_up(df, ["k"], "v", entries, -1, "w", 30)
    assert "_codes" in found._jdf.queryExecution().optimizedPlan().toString()
    assert "sort_array" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert {r.k: r.w for r in found.collect()} == {1: [2, -1, 1, -1, -1], 2: [-1, 1], 3: []}


def test_atoms_that_start_alike_are_tried_once(spark):
    """The pattern that texts are cut by finds what the plain one finds."""
    specials = ("<s>", "</s>", "<s", "<", "[A]", "[AB]", "<|x-1|>", "\u00a7", "\U0001f600b")
    draw = random.Random(2)
    rows = ["".join(draw.choice([*specials, " ", "\n", "s", "A", "]", ">", "|", "7", "é", "\U0001f600"]) for _ in range(30)) for _ in range(300)]
    df = texts(spark, *rows, "", None)
    for tok in (RegexTokenizer(specials), RegexTokenizer((*specials, "s>", "7é")), RegexTokenizer(), RegexTokenizer(())):
        plain = F.regexp_extract_all("t", F.lit(tok.pattern), F.lit(0))
        assert df.where(~tok.pieces(F.col("t")).eqNullSafe(plain)).count() == 0
        assert not tok.specials or tok.fast_pattern.count("<") < tok.pattern.count("<")


def test_no_shuffle_where_the_table_fits(spark):
    entries = spark.createDataFrame([(i, str(i)) for i in range(1000)], "from long, to string")
    df = spark.range(50).select("id", F.array("id", F.lit(7), F.lit(-5)).alias("v"))
    found = look_up(df, ["id"], "v", entries, "?", "w")
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert {r.id: r.w for r in found.collect()} == {i: [str(i), "7", "?"] for i in range(50)}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "from string, to long, n long")
    df = spark.createDataFrame([(1, ["a", None])], "k int, v array<string>")
    assert look_up(df, ["k"], "v", none, -1, "w").collect()[0].w == [-1, -1]
    assert look_up(df.limit(0), ["k"], "v", none, -1, "w").collect() == []


def test_a_vocabulary_cuts_each_text_once(spark):
    df = texts(spark, "a b a", "<s> c", None, "").repartition(3)
    vocab = stored_vocabulary(df, F.col("t"), RegexTokenizer())
    assert "regexp_extract_all" not in vocab._jdf.queryExecution().optimizedPlan().toString()
    rows = vocab.collect()
    assert {r.piece: r.n for r in rows} == {"a": 2, "b": 1, "<s>": 1, "c": 1} and sorted(r.token_id for r in rows) == [0, 1, 2, 3]
