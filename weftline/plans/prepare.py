"""From chats or raw text to packed or padded training rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weftline.functions.templates import RenderOptions, Template, template_for_model
from weftline.operators.examples import (
    Tokenizer,
    encode_chats,
    encode_texts,
    examples_from_log,
    usable_chats,
    usable_texts,
)
from weftline.operators.indexing import KEY, dense_index, place_in_chunks
from weftline.operators.packing import PLACE, arrange_chunks, pack_arranged, pad_batches
from weftline.operators.sampling import split_train_eval
from weftline.params import DataParams
from weftline.session import staged
from weftline.sources.readers import chat_column, read_params, with_row_key
from weftline.sources.splits import resolve_splits


def packed_or_padded(
    rows: DataFrame,
    keys: list[str],
    tokenizer: Tokenizer,
    params: DataParams,
    encode: Callable[[DataFrame, list[str]], DataFrame] | None = None,
) -> DataFrame:
    """Put the rows of each split in seeded order, then pack or pad them.

    For packing the rows move once, as they come, as text or messages;
    ``encode`` turns them into ids after that shuffle, since text is smaller
    than its ids, mask and labels.
    """
    encode = encode or (lambda df, keep: df)
    if params.use_packing:
        chunks = place_in_chunks(
            rows, keys, params.seed, params.num_shards, params.chunk_rows, groups=("split",)
        )
        placed = arrange_chunks(chunks, order=KEY)
        return pack_arranged(
            encode(placed, PLACE), params.max_seq_length, tokenizer.pad_id
        )
    indexed = dense_index(rows, keys, params.seed, groups=("split",))
    return pad_batches(
        encode(indexed, [*keys, "split", "idx"]),
        params.batch_rows,
        tokenizer.pad_id,
        params.pad_to_multiple_of,
    )


def prepare_instruction(
    chats: DataFrame,
    keys: list[str],
    tokenizer: Tokenizer,
    params: DataParams,
    template: str | Template = "simple",
    options: RenderOptions | None = None,
) -> DataFrame:
    """Split, render, encode, label and pack (or pad) chats."""
    split = resolve_splits(chats, keys, params.validation_split, params.seed, fixed=True)
    kept = usable_chats(split, tokenizer, template, options=options)

    def encode(df: DataFrame, keep: list[str]) -> DataFrame:
        return encode_chats(
            df, keep, tokenizer, params.max_seq_length, template, options=options,
            add_bos=params.add_bos,
        )

    return packed_or_padded(
        kept.select(*keys, "split", "messages"), keys, tokenizer, params, encode
    )


def prepare_instruction_log(
    log: DataFrame,
    tokenizer: Tokenizer,
    params: DataParams,
    template: str | Template = "simple",
    options: RenderOptions | None = None,
) -> DataFrame:
    """:func:`prepare_instruction` from a message log, never gathering a whole
    chat: only what the sequence length keeps of it is brought together.

    The examples are written once, because numbering and packing both read them.
    """
    chat_ids = log.select("conv_id").distinct()
    examples = split_train_eval(
        examples_from_log(
            log, tokenizer, params.max_seq_length, template, options, add_bos=params.add_bos
        ).drop("attention_mask"),
        ["conv_id"],
        params.validation_split,
        params.seed,
        population=chat_ids,
        fixed=True,
    )
    return packed_or_padded(staged(examples, "examples"), ["conv_id"], tokenizer, params)


def prepare_pretrain(
    texts: DataFrame, keys: list[str], tokenizer: Tokenizer, params: DataParams
) -> DataFrame:
    """Split, encode and pack (or pad) raw text."""
    column = params.text_column
    split = resolve_splits(texts, keys, params.validation_split, params.seed, fixed=True)
    kept = usable_texts(split, tokenizer, column).select(*keys, "split", column)

    def encode(df: DataFrame, keep: list[str]) -> DataFrame:
        rows = encode_texts(df, keep, tokenizer, params.max_seq_length, column, params.add_bos)
        return rows.drop("labels")

    return packed_or_padded(kept, keys, tokenizer, params, encode)


def prepare_dataset(
    df: DataFrame, keys: list[str], tokenizer: Tokenizer, params: DataParams, **how
) -> DataFrame:
    """Raw text or chats, as the parameters say.

    A model named in ``params`` chooses the template, unless one is given.
    """
    if params.is_continue_pretrain:
        return prepare_pretrain(df, keys, tokenizer, params)
    if params.model_name is not None:
        how.setdefault("template", template_for_model(params.model_name))
    return prepare_instruction(chat_column(df), keys, tokenizer, params, **how)


def prepare_job(
    spark: SparkSession, tokenizer: Tokenizer, params: DataParams, keys: list[str] | None = None, **how
) -> DataFrame:
    """Read what ``params`` names and prepare it; stored rows are keyed by their
    place where ``keys`` names no columns that do."""
    df = read_params(spark, params)
    if keys is None:
        df, keys = with_row_key(df), ["row_key"]
    return prepare_dataset(df, keys, tokenizer, params, **how)
