"""Reshaping: unpivot task columns, tag chats, serialise metadata, preview."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.errors import SourceError
from weftline.functions.text import json_text
from weftline.operators.filters import has_messages
from weftline.params import COLUMN_TOKENS, TASK_COLUMNS



def named_messages(messages: Column, kind: T.DataType) -> Column:
    """Messages as ``array<struct<role, content>>``, fields matched by name."""
    names = kind.elementType.fieldNames() if isinstance(kind, T.ArrayType) else []
    missing = {"role", "content"} - set(names)
    if missing:
        raise SourceError(f"messages lack {sorted(missing)}: {kind.simpleString()}")
    return F.transform(
        messages,
        lambda m: F.struct(
            m["role"].cast("string").alias("role"), m["content"].cast("string").alias("content")
        ),
    )


def metadata_text(meta: Column, kind: T.DataType) -> Column:
    """Metadata as JSON text; text is taken to be that already."""
    if isinstance(kind, T.StringType):
        return F.coalesce(meta, F.lit("{}"))
    return json_text(meta)


def token_for_column(name: str) -> str:
    """The task token of a source column, from its name; empty when none fits."""
    for words, token in COLUMN_TOKENS:
        if any(word in name for word in words):
            return token
    return ""


def prefix_first(messages: Column, prefix: Column | str) -> Column:
    """Put ``prefix`` before the first message's content; a null stays null."""
    prefix = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.transform(
        messages,
        lambda m, i: F.when(
            i == 0, m.withField("content", F.concat(prefix, m["content"]))
        ).otherwise(m),
    )


def unpivot_tasks(
    df: DataFrame,
    keys: list[str],
    columns: tuple[str, ...] = TASK_COLUMNS,
    inject: bool = True,
    keep_empty: bool = False,
) -> DataFrame:
    """Turn the task columns a source has into chat rows.

    Columns that are absent and cells that are null are passed over. Each row
    is keyed by ``keys`` and ``column_idx``; ``metadata`` is JSON text, made per
    column because the columns' metadata types may differ. Chats without
    messages are dropped unless ``keep_empty``.
    """
    cells = []
    for k, name in enumerate(columns):
        if name not in df.columns:
            continue
        cell = F.col(f"`{name}`")
        kinds = {f.name: f.dataType for f in df.schema[name].dataType.fields}
        if "messages" not in kinds:
            raise SourceError(f"column {name} has no field messages")
        messages = named_messages(F.coalesce(cell["messages"], F.array()), kinds["messages"])
        if inject:
            messages = prefix_first(messages, token_for_column(name))
        meta = metadata_text(cell["meta"], kinds["meta"]) if "meta" in kinds else F.lit("{}")
        cells.append(
            F.when(
                cell.isNotNull(),
                F.struct(
                    F.lit(k).alias("column_idx"),
                    F.lit(name).alias("column_name"),
                    messages.alias("messages"),
                    meta.alias("metadata"),
                ),
            )
        )
    if not cells:
        raise SourceError(f"none of the task columns {list(columns)} in {df.columns}")
    rows = df.select(*keys, F.inline_outer(F.array_compact(F.array(*cells)))).where(
        F.col("column_idx").isNotNull()
    )
    return rows if keep_empty else rows.where(has_messages(F.col("messages")))


def align_chats(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Project to (``messages``, JSON ``metadata``) and the columns in ``keep``."""
    metadata = F.lit("{}")
    if "metadata" in df.columns:
        metadata = metadata_text(F.col("metadata"), df.schema["metadata"].dataType)
    return df.select(*(keep or []), "messages", metadata.alias("metadata"))


def column_kind(data_type: T.DataType) -> str:
    """``tokens`` for integer lists, ``text`` for strings, else ``other``."""
    if isinstance(data_type, T.ArrayType) and isinstance(
        data_type.elementType, T.IntegralType
    ):
        return "tokens"
    return "text" if isinstance(data_type, T.StringType) else "other"


def schema_probe(df: DataFrame) -> DataFrame:
    """(column, type, kind, n_rows, n_filled) for every column, in one scan.

    ``n_filled`` counts cells that are neither null nor empty, over all rows
    rather than the first.
    """
    rows = []
    for f in df.schema.fields:
        kind, c = column_kind(f.dataType), F.col(f"`{f.name}`")
        filled = c.isNotNull()
        if kind == "text":
            filled = F.length(c) > 0
        elif isinstance(f.dataType, T.ArrayType):
            filled = F.size(c) > 0
        rows.append(
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.lit(kind).alias("kind"),
                F.count(F.lit(1)).alias("n_rows"),
                F.count_if(filled).alias("n_filled"),
            )
        )
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def row_lengths(df: DataFrame, keys: list[str]) -> DataFrame:
    """Size of each row: token count when there are ids, else JSON text length."""
    if "input_ids" in df.columns:
        return df.select(*keys, F.size("input_ids").cast("bigint").alias("length"))
    return df.select(
        *keys, F.length(F.to_json("messages")).cast("bigint").alias("length")
    )
