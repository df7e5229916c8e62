"""Chat templates as column expressions.

A template turns a chat into *segments*, ``array<struct<text, trainable>>``.
The rendered text is their concatenation and the loss mask is their flags, so
the two cannot disagree. A chat that breaks a template's rules gets an error
code in a column; nothing is raised on an executor.

Plain templates take messages of ``struct<role, content>``. The full template
takes *rich* messages, ``struct<role, text, blocks, tool_calls>``: content is a
string when ``text`` is set, a list when ``blocks`` is set, and missing when
neither is. A null content string counts as empty.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.errors import SourceError
from weftline.functions.text import strip
from weftline.params import BOS, EOS

SEGMENTS = "array<struct<text:string,trainable:boolean>>"
BLOCKS = "array<struct<type:string,text:string>>"
TOOL_CALLS = "array<struct<name:string,arguments:string>>"
RICH = f"array<struct<role:string,text:string,blocks:{BLOCKS},tool_calls:{TOOL_CALLS}>>"


@dataclass(frozen=True)
class RenderOptions:
    bos: str = BOS
    eos: str = EOS
    add_generation_prompt: bool = False
    default_system: str | None = None
    tools: Column | None = None


@dataclass(frozen=True)
class Template:
    """Pieces of a template: what stands before, for each and after messages."""

    head: Callable[[Column, RenderOptions], Column]
    message: Callable[[Column, Column, RenderOptions], Column]
    tail: Callable[[RenderOptions], Column]
    error: Callable[[Column], Column]
    rich: bool = False


def _text(value: Column | str, trainable: bool = False) -> Column:
    value = F.lit(value) if isinstance(value, str) else value
    return F.struct(value.alias("text"), F.lit(trainable).alias("trainable"))


def _segments(*parts: Column) -> Column:
    return F.array(*parts).cast(SEGMENTS)


def _nothing() -> Column:
    return F.array().cast(SEGMENTS)


def _content(m: Column) -> Column:
    return F.coalesce(m["content"], F.lit(""))


def _no_error(messages: Column) -> Column:
    return F.lit(None).cast("string")


def _no_head(messages: Column, o: RenderOptions) -> Column:
    return _nothing()


def _no_tail(o: RenderOptions) -> Column:
    return _nothing()


def _bos_head(messages: Column, o: RenderOptions) -> Column:
    return _segments(_text(o.bos))


# --- simple: a BOS only before a user turn that opens the chat ---------------


def _simple_message(m: Column, i: Column, o: RenderOptions) -> Column:
    asked = F.concat(
        F.when(i == 0, F.lit(o.bos)).otherwise(F.lit("")),
        F.lit("[INST]"),
        _content(m),
        F.lit("[/INST]"),
    )
    return (
        F.when(m["role"] == "user", _segments(_text(asked)))
        .when(
            m["role"] == "assistant",
            _segments(_text(F.concat(_content(m), F.lit(o.eos)), True)),
        )
        .otherwise(_nothing())
    )


# --- role tags: each turn between its role tag and an end tag ----------------


def _tagged_message(m: Column, i: Column, o: RenderOptions) -> Column:
    body = strip(_content(m))
    closed = F.concat(body, F.lit("<|end|>\n"))
    return (
        F.when(
            (m["role"] == "system") & (body != ""),
            _segments(_text(F.concat(F.lit("<|system|>\n"), closed))),
        )
        .when(m["role"] == "user", _segments(_text(F.concat(F.lit("<|user|>\n"), closed))))
        .when(
            m["role"] == "assistant",
            _segments(_text("<|assistant|>\n"), _text(closed, True)),
        )
        .otherwise(_nothing())
    )


def _tagged_tail(o: RenderOptions) -> Column:
    if o.add_generation_prompt:
        return _segments(_text("<|assistant|>\n"))
    return _segments(_text(o.eos, True))


# --- marked: an explicit trainable span per assistant turn -------------------


def _default_system(o: RenderOptions) -> Column:
    if not o.default_system:
        return _nothing()
    return _segments(_text(f"[SYSTEM_PROMPT]{o.default_system}[/SYSTEM_PROMPT]"))


def _marked_head(messages: Column, o: RenderOptions) -> Column:
    first = F.get(messages, F.lit(0))
    system = _segments(
        _text(F.concat(F.lit("[SYSTEM_PROMPT]"), _content(first), F.lit("[/SYSTEM_PROMPT]")))
    )
    return F.concat(
        _segments(_text(o.bos)),
        F.when(first["role"] == "system", system).otherwise(_default_system(o)),
    )


def _marked_message(
    m: Column,
    i: Column,
    o: RenderOptions,
    bos_each_user: bool = False,
    eos_trainable: bool = True,
) -> Column:
    asked = F.concat(
        F.lit((o.bos if bos_each_user else "") + "[INST]"), _content(m), F.lit("[/INST]")
    )
    if eos_trainable:
        answer = _segments(_text(F.concat(_content(m), F.lit(o.eos)), True))
    else:
        answer = _segments(_text(_content(m), True), _text(o.eos))
    return (
        F.when(m["role"] == "user", _segments(_text(asked)))
        .when(m["role"] == "assistant", answer)
        .otherwise(_nothing())
    )


def _bos_per_user(m, i, o):
    return _marked_message(m, i, o, bos_each_user=True)


def _eos_outside(m, i, o):
    return _marked_message(m, i, o, eos_trainable=False)


# --- full: system prompt, tools, content blocks, tool calls and checks -------


def _has_calls(m: Column) -> Column:
    return F.coalesce(F.size(m["tool_calls"]) > 0, F.lit(False))


def _has_blocks(m: Column) -> Column:
    return F.coalesce(F.size(m["blocks"]) > 0, F.lit(False))


def _ordered_blocks(blocks: Column) -> Column:
    """Exactly two blocks are put in order of type; other lists stay."""
    one, two = F.get(blocks, F.lit(0)), F.get(blocks, F.lit(1))
    return F.when(
        (F.size(blocks) == 2) & (one["type"] > two["type"]), F.array(two, one)
    ).otherwise(blocks)


def _join_blocks(blocks: Column) -> Column:
    shown = F.transform(
        blocks,
        lambda b: F.when(b["type"].isin("image", "image_url"), F.lit("[IMG]")).otherwise(
            F.coalesce(b["text"], F.lit(""))
        ),
    )
    return F.array_join(shown, "")


def _full_head(messages: Column, o: RenderOptions) -> Column:
    first = F.get(messages, F.lit(0))
    body = F.coalesce(first["text"], _join_blocks(first["blocks"]), F.lit(""))
    system = _segments(
        _text(F.concat(F.lit("[SYSTEM_PROMPT]"), body, F.lit("[/SYSTEM_PROMPT]")))
    )
    parts = [
        _segments(_text(o.bos)),
        F.when(first["role"] == "system", system).otherwise(_default_system(o)),
    ]
    if o.tools is not None:
        shown = F.concat(F.lit("[AVAILABLE_TOOLS]"), o.tools, F.lit("[/AVAILABLE_TOOLS]"))
        given = o.tools.isNotNull() & ~o.tools.isin("", "[]")
        parts.append(F.when(given, _segments(_text(shown))).otherwise(_nothing()))
    return F.concat(*parts)


def _full_message(m: Column, i: Column, o: RenderOptions) -> Column:
    asked = F.coalesce(m["text"], _join_blocks(_ordered_blocks(m["blocks"])), F.lit(""))
    said = F.coalesce(m["text"], _join_blocks(m["blocks"]), F.lit(""))
    calls = F.transform(
        F.coalesce(m["tool_calls"], F.array().cast(TOOL_CALLS)),
        lambda c: F.concat(
            F.lit("[TOOL_CALLS]"),
            c["name"],
            F.lit("[ARGS]"),
            F.when(c["arguments"] == "", F.lit("{}")).otherwise(c["arguments"]),
        ),
    )
    answer = F.concat(said, F.array_join(calls, ""), F.lit(o.eos))
    result = F.coalesce(m["text"], F.to_json(m["blocks"]), F.lit("None"))
    return (
        F.when(
            m["role"] == "user",
            _segments(_text(F.concat(F.lit("[INST]"), asked, F.lit("[/INST]")))),
        )
        .when(m["role"] == "assistant", _segments(_text(answer, True)))
        .when(
            m["role"] == "tool",
            _segments(
                _text(F.concat(F.lit("[TOOL_RESULTS]"), result, F.lit("[/TOOL_RESULTS]")))
            ),
        )
        .otherwise(_nothing())
    )


def alternates(messages: Column, rich: bool = False) -> Column:
    """True when user turns and plain assistant turns take strict turns.

    Assistant turns that only call tools, tool results and the system turn are
    not counted.
    """

    def counted(m: Column) -> Column:
        answer = m["role"] == "assistant"
        return (m["role"] == "user") | ((answer & ~_has_calls(m)) if rich else answer)

    turns = F.filter(messages, counted)
    right = F.transform(turns, lambda m, i: (m["role"] == "user") == (i % 2 == 0))
    return F.forall(right, lambda ok: ok)


def _message_error(m: Column, i: Column) -> Column:
    def any_block(*kinds: str) -> Column:
        blocks = F.coalesce(m["blocks"], F.array().cast(BLOCKS))
        return F.exists(blocks, lambda b: ~F.coalesce(b["type"].isin(*kinds), F.lit(False)))

    is_text = m["text"].isNotNull()
    role = m["role"]
    empty = ~F.coalesce(F.length(m["text"]) > 0, F.lit(False)) & ~_has_blocks(m)
    return (
        F.when(
            role == "user",
            F.when(is_text, F.lit(None))
            .when(~_has_blocks(m), F.lit("user_content_empty"))
            .when(any_block("text", "image", "image_url"), F.lit("user_block_type")),
        )
        .when(
            role == "assistant",
            F.when(empty & ~_has_calls(m), F.lit("assistant_content_empty")).when(
                ~is_text & any_block("text"), F.lit("assistant_block_type")
            ),
        )
        .when(role == "tool", F.lit(None))
        .when((role == "system") & (i == 0), F.lit(None))
        .otherwise(F.lit("unknown_role"))
    )


def _full_error(messages: Column) -> Column:
    first = F.get(messages, F.lit(0))
    bad_system = (
        (first["role"] == "system")
        & first["text"].isNull()
        & F.exists(
            F.coalesce(first["blocks"], F.array().cast(BLOCKS)),
            lambda b: ~F.coalesce(b["type"] == "text", F.lit(False)),
        )
    )
    per_message = F.filter(F.transform(messages, _message_error), lambda e: e.isNotNull())
    return (
        F.when(F.coalesce(F.size(messages), F.lit(0)) < 1, F.lit("no_messages"))
        .when(bad_system, F.lit("system_block_type"))
        .when(~alternates(messages, rich=True), F.lit("roles_not_alternating"))
        .otherwise(F.get(per_message, F.lit(0)))
    )


TEMPLATES = {
    "simple": Template(_no_head, _simple_message, _no_tail, _no_error),
    "role_tags": Template(_no_head, _tagged_message, _tagged_tail, _no_error),
    "marked": Template(_marked_head, _marked_message, _no_tail, _no_error),
    "v1_simple": Template(_bos_head, _marked_message, _no_tail, _no_error),
    "v2_multiline": Template(_no_head, _bos_per_user, _no_tail, _no_error),
    "v3_no_bos_in_loop": Template(_bos_head, _eos_outside, _no_tail, _no_error),
    "v4_eos_inside": Template(_bos_head, _marked_message, _no_tail, _no_error),
    "full": Template(_full_head, _full_message, _no_tail, _full_error, rich=True),
}


def template_of(template: str | Template) -> Template:
    """A built-in template by its name; one that was compiled is taken as it is."""
    return template if isinstance(template, Template) else TEMPLATES[template]


def template_for_model(model: str, otherwise: str = "full") -> str:
    """Template of a model family, from its name."""
    name = model.lower()
    if "mistral" in name or "ministral" in name:
        return "simple"
    if "phi-3" in name or "phi3" in name:
        return "role_tags"
    return otherwise


def segments(messages: Column, template: str | Template = "simple", options: RenderOptions | None = None,
             **changes) -> Column:
    """Segments of a chat, in order."""
    o = replace(options or RenderOptions(), **changes)
    t = template_of(template)
    body = F.flatten(F.transform(messages, lambda m, i: t.message(m, i, o)))
    return F.concat(t.head(messages, o), body, t.tail(o))


def segments_text(segs: Column) -> Column:
    return F.array_join(F.transform(segs, lambda s: s["text"]), "")


def render_error(messages: Column, template: str | Template = "simple") -> Column:
    """Null, or the code of the first rule the chat breaks."""
    return template_of(template).error(messages)


def render(messages: Column, template: str | Template = "simple", options: RenderOptions | None = None,
           **changes) -> Column:
    """``struct<text, error>``: exactly one of the two is set."""
    error = render_error(messages, template)
    text = segments_text(segments(messages, template, options, **changes))
    return F.struct(
        F.when(error.isNull(), text).alias("text"), error.cast("string").alias("error")
    )


def _fields(kind: T.DataType) -> dict[str, T.DataType]:
    """Field types of a list's items, by name."""
    item = kind.elementType if isinstance(kind, T.ArrayType) else None
    return {f.name: f.dataType for f in item.fields} if isinstance(item, T.StructType) else {}


def _blocks(content: Column, kind: T.DataType) -> Column:
    names = _fields(kind)
    if "type" not in names:
        raise SourceError(f"content blocks lack a type: {kind.simpleString()}")
    return F.transform(
        content,
        lambda b: F.struct(
            b["type"].cast("string").alias("type"),
            (b["text"] if "text" in names else F.lit(None)).cast("string").alias("text"),
        ),
    )


def _as_text(value: Column, kind: T.DataType) -> Column:
    return value if isinstance(kind, T.StringType) else F.to_json(value)


def _tool_calls(calls: Column, kind: T.DataType) -> Column:
    """Calls as (name, arguments): flat or under ``function``, typed or JSON text."""
    if isinstance(kind, T.NullType):
        return calls.cast(TOOL_CALLS)
    if isinstance(kind, T.StringType):
        # A text field takes any JSON value, as text.
        one = "name:string,arguments:string"
        parsed = f"array<struct<{one},function:struct<{one}>>>"
        calls, kind = F.from_json(calls, parsed), T.StructType.fromDDL(f"x {parsed}")["x"].dataType
    fields = _fields(kind)
    nested = fields.get("function")
    inner = {f.name: f.dataType for f in nested.fields} if nested is not None else {}
    if "name" not in fields and "name" not in inner:
        raise SourceError(f"tool calls lack a name: {kind.simpleString()}")

    def part(call: Column, name: str) -> Column:
        found = []
        if name in inner:
            found.append(_as_text(call["function"][name], inner[name]))
        if name in fields:
            found.append(_as_text(call[name], fields[name]))
        return F.coalesce(*found, F.lit(None).cast("string")).alias(name)

    return F.transform(calls, lambda c: F.struct(part(c, "name"), part(c, "arguments")))


def rich_messages(df: DataFrame, column: str = "messages", json_blocks: bool = False) -> Column:
    """Bring ``column`` to the rich message type, whatever its content type is.

    Fields are matched by name, in messages, blocks and tool calls. With
    ``json_blocks``, text content that is a JSON list of objects is read as
    blocks, so a column may mix texts and lists row by row.
    """
    fields = _fields(df.schema[column].dataType)
    if "role" not in fields:
        raise SourceError(f"messages lack a role: {df.schema[column].dataType.simpleString()}")

    def convert(m: Column) -> Column:
        content = fields.get("content")
        nothing = F.lit(None)
        if content is None:
            text = m["text"] if "text" in fields else nothing
            blocks = _blocks(m["blocks"], fields["blocks"]) if "blocks" in fields else nothing
        elif isinstance(content, T.StringType):
            text, blocks = m["content"], nothing
            if json_blocks:
                listed = m["content"].rlike(r"^\s*\[\s*\{")
                blocks = F.when(listed, F.from_json(m["content"], BLOCKS))
                text = F.when(blocks.isNull(), m["content"])
        else:
            text, blocks = nothing, _blocks(m["content"], content)
        calls = nothing.cast(TOOL_CALLS)
        if "tool_calls" in fields:
            calls = _tool_calls(m["tool_calls"], fields["tool_calls"])
        return F.struct(
            m["role"].cast("string").alias("role"),
            text.cast("string").alias("text"),
            blocks.cast(BLOCKS).alias("blocks"),
            calls.alias("tool_calls"),
        )

    return F.transform(F.col(column), convert)
