"""Byte-level BPE against the library whose ids it must give."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from weftline.llm.byte_bpe import ByteBpe, decode_documents, encode_documents, round_trip_documents
from weftline.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bpe():
    return ByteBpe(PATH, PATTERN)


@pytest.fixture(scope="module")
def wanted(bpe):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


def test_random_texts(bpe, wanted):
    draw = random.Random(3)
    letters = " \t\n\r\x0b\x0c\x1c\x85\xa0 　aabbcZé漢字1２'st'll,.!!—😀é"
    for _ in range(3000):
        text = "".join(draw.choice(letters) for _ in range(draw.randint(0, 30)))
        assert bpe.encode(text).tolist() == wanted.encode_ordinary(text), text


@pytest.mark.parametrize(
    "text", ["a" * 20000, "ab" * 9000, "é漢" * 5000, "=" * 9000, " " * 5000, "<|endoftext|> x"]
)
def test_very_long_pre_tokens(bpe, wanted, text):
    ids = bpe.encode(text).tolist()
    assert ids == wanted.encode_ordinary(text)
    assert bpe.decode(ids) == text.encode()


def test_cache_overflow_changes_nothing(bpe, wanted, monkeypatch):
    monkeypatch.setattr("weftline.llm.byte_bpe.MOST_CHUNKS", 3)
    text = "one two three, four five six seven. One two three"
    assert ByteBpe(PATH, PATTERN).encode(text).tolist() == wanted.encode_ordinary(text)


def test_any_number_of_ranks(bpe, tmp_path):
    """The same vocabulary with ranks far apart merges alike."""
    spread = {token: rank if rank < 256 else 256 + 5 * rank for token, rank in bpe.ranks.items()}
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in spread.items()))
    wide = ByteBpe(str(path), PATTERN)
    assert max(wide.ranks.values()) > 250_000
    for text in ["many words, some of them long: internationalisation", "ab" * 500, "é漢字 1234 'll"]:
        assert wide.encode(text).tolist() == [spread[bpe.table[i]] for i in bpe.encode(text).tolist()]
        assert wide.decode(wide.encode(text).tolist()) == text.encode()


def test_one_pass_equals_two(spark):
    df = spark.createDataFrame([(1, "a b  c"), (None, None), (3, " \n x" * 50)], "doc_id long, text string")
    both = round_trip_documents(df, ["doc_id"], PATH, PATTERN)
    ids = encode_documents(df, ["doc_id"], PATH, PATTERN)
    assert sorted(map(tuple, both.select("doc_id", "ids").collect()), key=str) == sorted(map(tuple, ids.collect()), key=str)
    assert {(r.doc_id, bytes(r.decoded).decode()) for r in both.collect()} == {(1, "a b  c"), (None, ""), (3, " \n x" * 50)}
    assert round_trip_documents(df.limit(0), ["doc_id"], PATH, PATTERN).collect() == []


def test_nulls_repeats_and_clashing_names(spark, wanted):
    rows = [(1, None, "x"), (1, "", "x"), (None, "a b", None), (2, "a b", "x"), (2, "a b", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = encode_documents(df, ["doc_id"], PATH, PATTERN)
    ids = wanted.encode_ordinary("a b")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, []), (1, []), (None, ids), (2, ids), (2, ids)], key=str
    )
    assert encode_documents(df.limit(0), ["doc_id"], PATH, PATTERN).collect() == []


def test_unknown_ids_show(spark):
    df = spark.createDataFrame([([1, None, 99_999_999],), (None,)], "ids array<int>")
    first, second = decode_documents(df, [], PATH, PATTERN).collect()
    assert bytes(first.decoded).endswith("��".encode()) and second.decoded == b""


def test_query(spark, wanted):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op8_byte_bpe"](spark, ROOT).collect()}
    assert len(got) == len(docs)
    for doc_id, text in docs:
        ids = wanted.encode_ordinary(text or "")
        row = got[doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
