"""Training examples: token ids, attention mask and loss labels.

A rendered chat is a list of segments, and each segment is encoded once. Labels
follow the segments' flags, so the work is linear in the chat's length and a
label never spills into the next turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.arrays import ones_like, truncate
from weftline.functions.templates import (
    RenderOptions,
    Template,
    render_error,
    rich_messages,
    segments,
    template_of,
)
from weftline.functions.text import is_nonblank
from weftline.functions.tokens import RegexTokenizer
from weftline.operators.filters import has_messages
from weftline.params import IGNORE_INDEX

Tokenizer = RegexTokenizer


def _template_input(df: DataFrame, template: str | Template, column: str) -> Column:
    return rich_messages(df, column) if template_of(template).rich else F.col(column)


def rendered(
    df: DataFrame,
    template: str | Template = "simple",
    column: str = "messages",
    options: RenderOptions | None = None,
) -> DataFrame:
    """Add ``segments`` and ``error``; rows with an error have null segments."""
    chat = _template_input(df, template, column)
    error = render_error(chat, template)
    return df.withColumn("error", error.cast("string")).withColumn(
        "segments",
        F.when(F.col("error").isNull(), segments(chat, template, options)),
    )


def template_rejects(
    df: DataFrame,
    keys: list[str],
    template: str | Template = "full",
    column: str = "messages",
    options: RenderOptions | None = None,
) -> DataFrame:
    """Chats that break the template's rules, with the rule they break first."""
    return (
        rendered(df, template, column, options)
        .where(F.col("error").isNotNull())
        .select(*keys, "error")
    )


def encode_segments(segs: Column, tokenizer: Tokenizer) -> Column:
    """``array<struct<ids, trainable>>`` of ``array<struct<text, trainable>>``."""
    ids = tokenizer.encode_many(F.transform(segs, lambda s: s["text"]))
    return F.zip_with(
        segs,
        ids,
        lambda s, x: F.struct(x.alias("ids"), s["trainable"].alias("trainable")),
    )


def joined_ids(encoded: Column) -> Column:
    return F.flatten(F.transform(encoded, lambda e: e["ids"]))


def joined_labels(encoded: Column) -> Column:
    return F.flatten(
        F.transform(
            encoded,
            lambda e: F.when(e["trainable"], e["ids"]).otherwise(
                F.array_repeat(F.lit(IGNORE_INDEX), F.size(e["ids"]))
            ),
        )
    )


def joined_mask(encoded: Column) -> Column:
    """1 for trainable tokens, else 0."""
    return F.flatten(
        F.transform(
            encoded,
            lambda e: F.array_repeat(e["trainable"].cast("int"), F.size(e["ids"])),
        )
    )


def usable_chats(
    df: DataFrame,
    tokenizer: Tokenizer,
    template: str | Template = "simple",
    column: str = "messages",
    options: RenderOptions | None = None,
) -> DataFrame:
    """Chats that have messages, render without error, and have a token.

    The last is decided on the text, so nothing is encoded to count rows.
    """
    shown = rendered(df.where(has_messages(F.col(column))), template, column, options)
    kept = shown.where(F.col("error").isNull()).where(
        F.exists("segments", lambda s: tokenizer.has_token(s["text"]))
    )
    return kept.select(*df.columns)


def encode_chats(
    df: DataFrame,
    keep: list[str],
    tokenizer: Tokenizer,
    max_length: int,
    template: str | Template = "simple",
    column: str = "messages",
    options: RenderOptions | None = None,
    add_bos: bool = False,
) -> DataFrame:
    """(keep, input_ids, attention_mask, labels) of usable chats, row by row.

    ``add_bos`` puts a BOS before the text's own, as tokenizers that add
    special tokens by themselves do.
    """
    extra = [tokenizer.special_id(tokenizer.markers.bos)] if add_bos else []
    chat = _template_input(df, template, column)
    encoded = df.select(
        *keep, encode_segments(segments(chat, template, options), tokenizer).alias("_e")
    )
    return with_mask(
        encoded.select(
            *keep,
            truncate(_led(joined_ids(F.col("_e")), extra), max_length).alias("input_ids"),
            truncate(
                _led(joined_labels(F.col("_e")), [IGNORE_INDEX] * len(extra)), max_length
            ).alias("labels"),
        )
    )


def _led(ids: Column, lead: list[int]) -> Column:
    return F.concat(F.array(*map(F.lit, lead)), ids) if lead else ids


def with_mask(df: DataFrame) -> DataFrame:
    """Add the all-ones attention mask of unpadded rows."""
    rest = [c for c in df.columns if c not in ("input_ids", "labels")]
    mask = ones_like(F.col("input_ids")).alias("attention_mask")
    return df.select(*rest, "input_ids", mask, "labels")


def instruction_examples(
    df: DataFrame,
    keys: list[str],
    tokenizer: Tokenizer,
    max_length: int,
    template: str | Template = "simple",
    column: str = "messages",
    options: RenderOptions | None = None,
) -> DataFrame:
    """(keys, input_ids, attention_mask, labels) of every chat that renders.

    Chats without messages, chats that break the template's rules and chats
    without a token are left out. A chat whose trainable tokens are all cut off
    stays, with every label ignored.
    """
    kept = usable_chats(df, tokenizer, template, column, options)
    return encode_chats(kept, keys, tokenizer, max_length, template, column, options)


def assistant_masks(
    df: DataFrame,
    keys: list[str],
    tokenizer: Tokenizer,
    template: str | Template = "marked",
    column: str = "messages",
    options: RenderOptions | None = None,
) -> DataFrame:
    """(keys, input_ids, assistant_mask) from a template's trainable spans."""
    shown = rendered(df, template, column, options).where(F.col("error").isNull())
    encoded = shown.withColumn("_e", encode_segments(F.col("segments"), tokenizer))
    return encoded.select(
        *keys,
        joined_ids(F.col("_e")).alias("input_ids"),
        joined_mask(F.col("_e")).alias("assistant_mask"),
    )


def usable_texts(df: DataFrame, tokenizer: Tokenizer, column: str = "text") -> DataFrame:
    """Rows whose text is not blank and has a token; nothing is encoded."""
    text = F.col(column)
    return df.where(is_nonblank(text) & tokenizer.has_token(text))


def encode_texts(
    df: DataFrame,
    keep: list[str],
    tokenizer: Tokenizer,
    max_length: int,
    column: str = "text",
    add_bos: bool = False,
) -> DataFrame:
    """(keep, input_ids, attention_mask, labels); labels equal the ids."""
    lead = [tokenizer.special_id(tokenizer.markers.bos)] if add_bos else []
    ids = _led(tokenizer.encode(F.col(column)), lead)
    cut = df.select(*keep, truncate(ids, max_length).alias("input_ids"))
    return with_mask(cut.withColumn("labels", F.col("input_ids")))


def text_examples(
    df: DataFrame,
    keys: list[str],
    tokenizer: Tokenizer,
    max_length: int,
    column: str = "text",
) -> DataFrame:
    """Examples from raw text; blank text is left out."""
    return encode_texts(
        usable_texts(df, tokenizer, column), keys, tokenizer, max_length, column
    )


def examples_from_log(
    log: DataFrame,
    tokenizer: Tokenizer,
    max_length: int,
    template: str | Template = "simple",
    options: RenderOptions | None = None,
    fan_in: int = 4096,
    add_bos: bool = False,
) -> DataFrame:
    """Examples straight from a message log (conv_id, turn, role, text).

    Equal to gathering each chat and calling :func:`instruction_examples`, but
    nothing gathers more than ``fan_in`` turns. Joining two parts of a chat and
    cutting the result to ``max_length`` is associative, so chats are joined as
    a tree: blocks of ``fan_in`` turns are encoded and cut, then ``fan_in``
    blocks are joined and cut, and so on. The longest chat, measured first,
    sets the number of levels; logs whose chats have fewer than ``fan_in``
    turns need one. For templates that look at one message at a time.
    """
    o = options or RenderOptions()
    t = template_of(template)
    if t.rich:
        raise ValueError(f"template {template!r} checks whole chats")
    last_turn = log.agg(F.max("turn")).first()[0] or 0
    levels = 1
    while fan_in**levels <= last_turn:
        levels += 1

    def cut(ids: Column) -> Column:
        return truncate(ids, max_length)

    def body(turns: Column, first: bool) -> Column:
        shift = 0 if first else 1
        parts = F.flatten(F.transform(turns, lambda m, i: t.message(m, i + shift, o)))
        return F.concat(t.head(turns, o), parts) if first else parts

    def block(column: str) -> Column:
        return F.floor(F.col(column) / fan_in).alias("block")

    turn = F.struct("turn", "role", F.col("text").alias("content"))
    first = F.floor(F.greatest("turn", F.lit(0)) / fan_in).alias("block")
    turns = log.groupBy("conv_id", first).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    # Which block opens a chat is only known at the end, so a block is encoded
    # both ways: as the opening one and as a later one. With a single level
    # nothing uses the second, and the optimizer drops it.
    encoded = turns.select(
        "conv_id",
        "block",
        encode_segments(body(F.col("turns"), True), tokenizer).alias("_a"),
        encode_segments(body(F.col("turns"), False), tokenizer).alias("_b"),
    )
    parts = encoded.select(
        "conv_id",
        "block",
        cut(joined_ids(F.col("_a"))).alias("open_ids"),
        cut(joined_labels(F.col("_a"))).alias("open_labels"),
        cut(joined_ids(F.col("_b"))).alias("ids"),
        cut(joined_labels(F.col("_b"))).alias("labels"),
    )
    for level in range(1, levels):
        last = level == levels - 1
        group = ["conv_id"] if last else ["conv_id", block("block")]
        part = F.struct("block", "open_ids", "open_labels", "ids", "labels")
        joined = parts.groupBy(*group).agg(F.sort_array(F.collect_list(part)).alias("p"))

        def tree(opening: str, later: str) -> Column:
            pieces = F.transform(
                "p", lambda x, i: F.when((i == 0) & F.lit(opening != later), x[opening]).otherwise(x[later])
            )
            return cut(F.flatten(pieces))

        parts = joined.select(
            *(["conv_id"] if last else ["conv_id", "block"]),
            tree("open_ids", "ids").alias("open_ids"),
            tree("open_labels", "labels").alias("open_labels"),
            tree("ids", "ids").alias("ids"),
            tree("labels", "labels").alias("labels"),
        )
    tail = encode_segments(t.tail(o), tokenizer)
    lead = [tokenizer.special_id(tokenizer.markers.bos)] if add_bos else []
    whole = parts.select(
        "conv_id",
        cut(_led(F.concat("open_ids", joined_ids(tail)), lead)).alias("input_ids"),
        cut(_led(F.concat("open_labels", joined_labels(tail)), [IGNORE_INDEX] * len(lead))).alias("labels"),
    )
    return with_mask(whole.where(F.size("input_ids") > 0))
