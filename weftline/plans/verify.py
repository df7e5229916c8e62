"""Whole-table checks of a chat dataset before it is handed to a trainer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions.arrays import positions_of
from weftline.functions.tokens import RegexTokenizer
from weftline.operators.examples import encode_segments, joined_ids, joined_mask, rendered
from weftline.functions.templates import Template, segments_text
from weftline.sources.readers import chat_column


def verify_dataset(
    df: DataFrame,
    tokenizer: RegexTokenizer,
    template: str | Template = "full",
    text_marker: str = "[INST]",
    id_marker: str = "[/INST]",
) -> DataFrame:
    """(check, n) over every row, in one scan.

    Counts rows, rows that do not render, rows whose text holds the opening
    marker, rows whose ids hold the closing one and how often, rows whose ids
    hold a system prompt, rows with a trainable token, and rows where ids and mask differ in size.
    """
    shown = rendered(chat_column(df), template)
    encoded = shown.withColumn("_e", encode_segments(F.col("segments"), tokenizer))
    facts = encoded.select(
        F.col("error").isNotNull().alias("bad"),
        segments_text(F.col("segments")).contains(text_marker).alias("opens"),
        F.size(
            positions_of(joined_ids(F.col("_e")), tokenizer.special_id(id_marker))
        ).alias("closes"),
        F.array_contains(
            joined_ids(F.col("_e")), tokenizer.special_id("[SYSTEM_PROMPT]")
        ).alias("prompted"),
        F.array_contains(joined_mask(F.col("_e")), 1).alias("trainable"),
        (F.size(joined_ids(F.col("_e"))) == F.size(joined_mask(F.col("_e")))).alias("aligned"),
    )
    checks = {
        "rows": F.count(F.lit(1)),
        "template_errors": F.count_if("bad"),
        "text_has_marker": F.count_if("opens"),
        "ids_have_marker": F.count_if(F.col("closes") > 0),
        "marker_occurrences": F.coalesce(
            F.sum(F.when(F.col("closes") > 0, F.col("closes"))), F.lit(0)
        ),
        "ids_have_system_prompt": F.count_if("prompted"),
        "has_trainable": F.count_if("trainable"),
        "ids_and_mask_differ": F.count_if(~F.col("aligned")),
    }
    rows = [
        F.struct(F.lit(name).alias("check"), n.cast("bigint").alias("n"))
        for name, n in checks.items()
    ]
    return facts.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
