"""Labels, masks and examples, checked against plain Python."""

from __future__ import annotations

import zlib

import pytest
import regex
from pyspark.sql import functions as F

from weftline.functions.templates import RenderOptions, segments, segments_text
from weftline.functions.tokens import FIRST_SPECIAL_ID, RegexTokenizer
from weftline.operators import examples

TOK = RegexTokenizer()
CHAT = "conv_id long, messages array<struct<role:string,content:string>>"
LOG = "conv_id long, turn long, role string, text string"


def plain_ids(text: str) -> list[int]:
    found = regex.findall(TOK.pattern, text)
    return [
        TOK.special_id(p) if p in TOK.specials else zlib.crc32(p.encode()) & (FIRST_SPECIAL_ID - 1)
        for p in found
    ]


def plain_simple(messages) -> list[tuple[str, bool]]:
    out = []
    for i, (role, content) in enumerate(messages):
        if role == "user":
            out.append((("<s>" if i == 0 else "") + f"[INST]{content}[/INST]", False))
        elif role == "assistant":
            out.append((content + "</s>", True))
    return out


def prefix_labels(messages, limit: int) -> tuple[list[int], list[int]]:
    """Labels found by encoding every prefix of the chat again."""

    def text(part):
        return "".join(s for s, _ in plain_simple(part))

    ids = plain_ids(text(messages))[:limit]
    labels = [-100] * len(ids)
    for k, (role, _) in enumerate(messages):
        if role == "assistant":
            start = len(plain_ids(text(messages[:k])))
            end = min(len(plain_ids(text(messages[: k + 1]))), len(ids))
            labels[start:end] = ids[start:end]
    return ids, labels


@pytest.mark.parametrize("limit", [3, 9, 40, 4000])
def test_labels_equal_the_prefix_method(spark, tables, limit):
    from checks import views

    chats = views.chats(tables)
    got = examples.instruction_examples(chats, ["conv_id"], TOK, limit).collect()
    plain = {r["conv_id"]: [(m["role"], m["content"]) for m in r["messages"]] for r in chats.collect()}
    assert len(got) == len(plain)
    for row in got:
        ids, labels = prefix_labels(plain[row["conv_id"]], limit)
        assert (row["input_ids"], row["labels"]) == (ids, labels)
        assert row["attention_mask"] == [1] * len(ids)


def test_role_tags_do_not_unmask_the_next_turn(spark):
    chat = [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")]
    df = spark.createDataFrame([(1, chat)], CHAT)
    row = examples.instruction_examples(df, ["conv_id"], TOK, 100, "role_tags").first()
    trained = [i for i in row["labels"] if i != -100]
    end, eos = TOK.special_id("<|end|>"), TOK.special_id("</s>")
    assert trained == [*plain_ids("b"), end, *plain_ids("d"), end, eos]


def test_chat_without_an_answer_stays_with_no_labels(spark):
    df = spark.createDataFrame([(1, [("user", "a b c")])], CHAT)
    row = examples.instruction_examples(df, ["conv_id"], TOK, 100).first()
    assert set(row["labels"]) == {-100} and len(row["input_ids"]) == 6


def test_rows_that_are_left_out(spark):
    rows = [(1, None), (2, []), (3, [("system", "only")]), (4, [("user", "x")])]
    df = spark.createDataFrame(rows, CHAT)
    kept = examples.instruction_examples(df, ["conv_id"], TOK, 10).collect()
    assert [r["conv_id"] for r in kept] == [4]


@pytest.mark.parametrize("variant", ["marked", "v1_simple", "v2_multiline", "v3_no_bos_in_loop", "v4_eos_inside"])
def test_hello_pair_is_trainable_in_every_variant(spark, variant):
    df = spark.createDataFrame([(1, [("user", "Hello"), ("assistant", "Hi there!")])], CHAT)
    row = examples.assistant_masks(df, ["conv_id"], TOK, variant).first()
    answer = plain_ids("Hi there!") + ([] if variant == "v3_no_bos_in_loop" else plain_ids("</s>"))
    assert [i for i, m in zip(row["input_ids"], row["assistant_mask"]) if m] == answer
    assert row["input_ids"] == plain_ids("<s>[INST]Hello[/INST]Hi there!</s>")


def test_special_inside_an_answer_is_one_token(spark):
    said = "I'm doing well! <|task-1-indicator|> This is a test."
    df = spark.createDataFrame([(1, [("user", "Hello, how are you?"), ("assistant", said)])], CHAT)
    row = examples.instruction_examples(df, ["conv_id"], TOK, 100).first()
    assert row["input_ids"].count(TOK.special_id("<|task-1-indicator|>")) == 1
    glued = spark.createDataFrame([("x<|task-1-indicator|>y",)], "t string")
    ids = glued.select(TOK.encode(F.col("t"))).first()[0]
    assert len(ids) == 3 and ids[1] >= FIRST_SPECIAL_ID


@pytest.mark.parametrize("template", ["simple", "role_tags", "marked", "v2_multiline", "v3_no_bos_in_loop"])
@pytest.mark.parametrize("fan_in", [2, 3, 4096])
def test_log_examples_equal_chat_examples(spark, tables, template, fan_in):
    from checks import views

    options = RenderOptions(default_system="Be kind.")
    for limit in (60, 5000):
        want = examples.instruction_examples(
            views.chats(tables), ["conv_id"], TOK, limit, template, options=options
        )
        got = examples.examples_from_log(
            tables.conversations, TOK, limit, template, options, fan_in=fan_in
        )
        assert sorted(got.collect()) == sorted(want.collect())


def test_one_chat_with_most_of_the_log(spark):
    """A chat of 30,000 turns among small ones: only its first tokens count."""
    hot = spark.range(30_000).selectExpr(
        "0 conv_id", "id turn", "if(id % 2 = 0, 'user', 'assistant') role", "concat('w', id) text"
    )
    small = spark.range(1, 3_000).selectExpr("id conv_id", "0 turn", "'user' role", "'hi' text")
    got = examples.examples_from_log(hot.unionAll(small), TOK, 512, fan_in=64)
    assert got.count() == 3_000
    row = got.where("conv_id = 0").first()
    chat = [("user" if i % 2 == 0 else "assistant", f"w{i}") for i in range(600)]
    assert (row["input_ids"], row["labels"]) == prefix_labels(chat, 512)


def test_second_bos_on_request(spark):
    df = spark.createDataFrame([(1, [("user", "a"), ("assistant", "b")])], CHAT)
    row = examples.encode_chats(df, ["conv_id"], TOK, 100, add_bos=True).first()
    bos = TOK.special_id("<s>")
    assert row["input_ids"][:2] == [bos, bos] and row["labels"][0] == -100
    assert len(row["input_ids"]) == len(row["labels"]) == len(row["attention_mask"])
    texts = spark.createDataFrame([("x",)], "text string")
    assert examples.encode_texts(texts, [], TOK, 9, add_bos=True).first()["labels"][0] == bos


def test_rendered_text_equals_plain_python(spark, tables):
    from checks import views

    rows = views.chats(tables).select(
        "messages", segments_text(segments(F.col("messages"))).alias("t")
    ).collect()
    for r in rows:
        want = "".join(s for s, _ in plain_simple([(m["role"], m["content"]) for m in r["messages"]]))
        assert r["t"] == want
