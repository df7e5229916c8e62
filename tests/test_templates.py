"""Rendered texts and error codes of literal chats."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weftline.functions.templates import (
    RICH,
    RenderOptions,
    alternates,
    render,
    rich_messages,
    segments,
    template_for_model,
)

PLAIN = "id int, messages array<struct<role:string,content:string>>"
NEW = f"id int, messages {RICH}"


def plain(spark, chat, template, **options):
    df = spark.createDataFrame([(1, chat)], PLAIN)
    return df.select(render(F.col("messages"), template, **options).alias("r")).first()["r"]["text"]


def rich(spark, chat, **options):
    full = [(*m, *[None] * (4 - len(m))) for m in chat]
    df = spark.createDataFrame([(1, full)], NEW)
    r = df.select(render(F.col("messages"), "full", **options).alias("r")).first()["r"]
    assert (r["text"] is None) != (r["error"] is None)
    return r["error"] or r["text"]


@pytest.mark.parametrize(
    "chat, text",
    [
        ([("user", "a"), ("assistant", "b")], "<s>[INST]a[/INST]b</s>"),
        ([("system", "s"), ("user", "a"), ("assistant", "b")], "[INST]a[/INST]b</s>"),
        ([("assistant", "b"), ("user", "a")], "b</s>[INST]a[/INST]"),
        ([("user", "a"), ("tool", "t"), ("user", "c")], "<s>[INST]a[/INST][INST]c[/INST]"),
        ([("system", "s")], ""),
    ],
)
def test_simple(spark, chat, text):
    assert plain(spark, chat, "simple") == text
    assert plain(spark, chat, "simple", add_generation_prompt=True) == text


def test_role_tags(spark):
    chat = [("system", " \t　"), ("user", "  a\n"), ("assistant", "b ")]
    body = "<|user|>\na<|end|>\n<|assistant|>\nb<|end|>\n"
    assert plain(spark, chat, "role_tags") == body + "</s>"
    assert plain(spark, chat, "role_tags", add_generation_prompt=True) == body + "<|assistant|>\n"
    assert plain(spark, [("system", "s")], "role_tags") == "<|system|>\ns<|end|>\n</s>"


def test_marked_and_variants(spark):
    chat = [("system", "s"), ("user", "a"), ("assistant", "b"), ("user", "c")]
    assert plain(spark, chat, "marked") == "<s>[SYSTEM_PROMPT]s[/SYSTEM_PROMPT][INST]a[/INST]b</s>[INST]c[/INST]"
    assert plain(spark, chat[1:], "marked", default_system="d").startswith("<s>[SYSTEM_PROMPT]d[/")
    one = "<s>[INST]a[/INST]b</s>[INST]c[/INST]"
    for name in ("v1_simple", "v3_no_bos_in_loop", "v4_eos_inside"):
        assert plain(spark, chat, name) == one
    assert plain(spark, chat, "v2_multiline") == "<s>[INST]a[/INST]b</s><s>[INST]c[/INST]"
    df = spark.createDataFrame([(1, chat)], PLAIN)
    spans = df.select(segments(F.col("messages"), "v3_no_bos_in_loop").alias("s")).first()["s"]
    assert [s["text"] for s in spans if s["trainable"]] == ["b"]


def test_full_text_and_blocks(spark):
    assert rich(spark, [("user", "a"), ("assistant", "b")]) == "<s>[INST]a[/INST]b</s>"
    two = [("text", "t"), ("image", None)]
    for blocks in (two, two[::-1]):
        assert rich(spark, [("user", None, blocks)]) == "<s>[INST][IMG]t[/INST]"
    three = [("text", "t"), ("image_url", None), ("text", "u")]
    assert rich(spark, [("user", None, three)]) == "<s>[INST]t[IMG]u[/INST]"
    system = ("system", None, [("text", "x"), ("text", "y")])
    assert rich(spark, [system, ("user", "a")]) == "<s>[SYSTEM_PROMPT]xy[/SYSTEM_PROMPT][INST]a[/INST]"
    assert rich(spark, [("user", ""), ("assistant", None, [("text", "b")])]) == "<s>[INST][/INST]b</s>"


def test_full_tools(spark):
    calls = [("f", '{"x":1}'), ("g", "")]
    chat = [
        ("user", "a"), ("assistant", None, None, calls), ("tool", "42"), ("assistant", "b")
    ]
    want = (
        '<s>[AVAILABLE_TOOLS][{"name":"f"}][/AVAILABLE_TOOLS][INST]a[/INST]'
        '[TOOL_CALLS]f[ARGS]{"x":1}[TOOL_CALLS]g[ARGS]{}</s>[TOOL_RESULTS]42[/TOOL_RESULTS]b</s>'
    )
    assert rich(spark, chat, tools=F.lit('[{"name":"f"}]')) == want
    for none in (F.lit(None).cast("string"), F.lit("[]"), F.lit("")):
        assert "AVAILABLE" not in rich(spark, chat, tools=none)


def test_full_default_system(spark):
    given = [("system", "s"), ("user", "a")]
    assert rich(spark, given, default_system="d") == "<s>[SYSTEM_PROMPT]s[/SYSTEM_PROMPT][INST]a[/INST]"
    assert rich(spark, given[1:], default_system="d") == "<s>[SYSTEM_PROMPT]d[/SYSTEM_PROMPT][INST]a[/INST]"
    assert rich(spark, given[1:], default_system="") == "<s>[INST]a[/INST]"


@pytest.mark.parametrize(
    "chat, code",
    [
        ([], "no_messages"),
        ([("system", None, [("image", None)]), ("user", "a")], "system_block_type"),
        ([("user", "a"), ("user", "b")], "roles_not_alternating"),
        ([("user", "a"), ("assistant", "b"), ("assistant", "c")], "roles_not_alternating"),
        ([("assistant", "b")], "roles_not_alternating"),
        ([("user", "a"), ("system", "s")], "unknown_role"),
        ([("user", "a"), ("critic", "s")], "unknown_role"),
        ([("user", None, [])], "user_content_empty"),
        ([("user", None)], "user_content_empty"),
        ([("user", None, [("audio", None)])], "user_block_type"),
        ([("user", "a"), ("assistant", "")], "assistant_content_empty"),
        ([("user", "a"), ("assistant", None, [], [])], "assistant_content_empty"),
        ([("user", "a"), ("assistant", None, [("image", None)])], "assistant_block_type"),
        # The chat's order is judged before its messages.
        ([("user", None, []), ("user", "b")], "roles_not_alternating"),
    ],
)
def test_full_errors(spark, chat, code):
    assert rich(spark, chat) == code


def test_alternation_of_plain_chats(spark):
    rows = [
        (1, [("system", "s"), ("user", "a"), ("assistant", "b")]),
        (2, [("user", "a"), ("user", "b")]),
        (3, []),
    ]
    df = spark.createDataFrame(rows, PLAIN).select("id", alternates(F.col("messages")).alias("ok"))
    assert dict(df.collect()) == {1: True, 2: False, 3: True}


def test_rich_messages_of_both_content_types(spark):
    text = spark.createDataFrame([(1, [("user", "a")])], PLAIN)
    listed = spark.createDataFrame(
        [(1, [("user", [("text", "a")])])],
        "id int, messages array<struct<role:string,content:array<struct<type:string,text:string>>>>",
    )
    for df in (text, listed):
        got = df.select(render(rich_messages(df), "full", RenderOptions(bos="")).alias("r")).first()
        assert got["r"]["text"] == "[INST]a[/INST]"


@pytest.mark.parametrize(
    "model, template",
    [("org/Ministral-3-14B", "simple"), ("Mistral-7B", "simple"), ("x/Phi-3.5-mini", "role_tags"),
     ("phi3", "role_tags"), ("other", "full")],
)
def test_template_of_a_model_family(model, template):
    assert template_for_model(model) == template


def test_missing_and_nested_fields(spark):
    from weftline.errors import SourceError

    df = spark.createDataFrame([([("x",)],)], "messages array<struct<content:string>>")
    with pytest.raises(SourceError):
        rich_messages(df)
    kind = "messages array<struct<content:string,role:string,tool_calls:string>>"
    calls = '[{"function": {"arguments": {"x": 1}, "name": "look"}}, {"arguments": "", "name": "b"}]'
    rows = [([('[{"type": "text", "text": "hi"}]', "user", None), ("plain", "assistant", calls)],)]
    df = spark.createDataFrame(rows, kind)
    first, second = df.select(rich_messages(df, json_blocks=True).alias("m")).first()["m"]
    assert first["text"] is None and [tuple(b) for b in first["blocks"]] == [("text", "hi")]
    assert second["text"] == "plain" and second["role"] == "assistant"
    assert [tuple(c) for c in second["tool_calls"]] == [("look", '{"x":1}'), ("b", "")]
    assert df.select(rich_messages(df).alias("m")).first()["m"][0]["blocks"] is None
