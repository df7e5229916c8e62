"""Markers, decoding and vocabularies."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions.tokens import RegexTokenizer, stored_vocabulary, vocabulary
from weftline.operators import inspect
from weftline.session import staged

TOK, BARE = RegexTokenizer(), RegexTokenizer(specials=())


def test_marker_positions(spark):
    df = spark.createDataFrame(
        [("plain",), ("[INST]a[/INST]b",), ("[/INST][/INST] x [/INST]",)], "t string"
    )
    p, f = inspect.marker_positions(F.col("t"), TOK, "[/INST]", "INST")
    got = df.select("t", p.alias("p"), f.alias("f")).collect()
    assert [r["p"] for r in got] == [[], [2], [0, 1, 3]]
    assert all(r["f"] == [] for r in got)
    p, f = inspect.marker_positions(F.col("t"), BARE, "[/INST]", "INST")
    cut = df.select(p.alias("p"), f.alias("f")).collect()
    assert [r["p"] for r in cut] == [[], [], []]
    assert cut[1]["f"] == ["1:INST", "6:INST"]


def test_decode_with_frequent_and_rare_tokens(spark):
    texts = ["de " * 500 + f"w{i} x" for i in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    vocab = staged(stored_vocabulary(df, F.col("t"), TOK), "vocabulary")
    assert vocab.select("token_id").distinct().count() == vocab.count() == 23
    ids = inspect.encode_stored(df, ["k"], F.col("t"), TOK, vocab)
    back = inspect.decode_ids(ids, ["k"], "ids", vocab)
    want = dict(df.select("k", TOK.pieces(F.col("t"))).collect())
    assert dict(back.collect()) == want


def test_unknown_ids_and_empty_rows_stay(spark):
    df = spark.createDataFrame([(1, "aa cc"), (2, ""), (3, None), (None, "bb aa")], "k long, t string")
    vocab = staged(stored_vocabulary(df.where("k is null"), F.col("t"), TOK), "vocabulary")
    ids = inspect.encode_stored(df, ["k"], F.col("t"), TOK, vocab)
    got = dict(inspect.decode_ids(ids, ["k"], "ids", vocab).collect())
    assert got == {1: ["aa", "<unk>"], 2: [], 3: [], None: ["bb", "aa"]}


def test_vocabulary_names_the_most_frequent_piece(spark):
    """Two pieces that share an id count together."""
    import zlib
    from itertools import count

    seen, pair = {}, None
    for i in count():
        piece = "w" + "".join(chr(97 + int(d, 16)) for d in f"{i * 2654435761 % 2**32:x}")
        key = zlib.crc32(piece.encode()) & ((1 << 30) - 1)
        if key in seen:
            pair = (seen[key], piece)
            break
        seen[key] = piece
    a, b = pair
    df = spark.createDataFrame([(f"{a} {b} {b}",)], "t string")
    row = vocabulary(df, F.col("t"), TOK).collect()
    assert len(row) == 1
    assert (row[0]["piece"], row[0]["n"], row[0]["n_pieces"]) == (b, 3, 2)


def test_specials(spark):
    df = spark.createDataFrame([("<s>[INST]a[/INST]b</s><|task-2-bow|>",)], "t string")
    vocab = {r["token"]: (r["token_id"], r["n"]) for r in inspect.special_vocabulary(df, F.col("t"), TOK).collect()}
    assert len(vocab) == len(TOK.specials)
    assert vocab["[INST]"] == (TOK.special_id("[INST]"), 1) and vocab["<pad>"][1] == 0
    trip = inspect.special_roundtrip(df, F.col("t"), TOK).collect()
    assert {r["token"] for r in trip} == set(TOK.specials) and len(trip) == 26
    seen = {"<s>", "[INST]", "[/INST]", "</s>", "<|task-2-bow|>"}
    assert all(r["n_single"] == r["n_same"] == int(r["token"] in seen) for r in trip)


def test_specials_that_start_like_words(spark):
    tok = RegexTokenizer(specials=("abc", "ab"))
    df = spark.createDataFrame([("abcab x",)], "t string")
    assert df.select(tok.pieces(F.col("t"))).first()[0] == ["abc", "ab", "x"]


def test_token_report(spark):
    df = spark.createDataFrame(
        [(1, [("a\n", False), ("b", True)])], "k long, s array<struct<text:string,trainable:boolean>>"
    )
    got = inspect.token_report(df, ["k"], "s", TOK).orderBy("index").collect()
    assert [(r["index"], r["piece"], r["label"]) for r in got] == [(0, "a", "SKIP"), (1, "b", "TRAIN")]
