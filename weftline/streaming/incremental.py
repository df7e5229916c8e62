"""The row-by-row operators on a stream of new rows.

Rendering, filtering and encoding look at one row at a time, so they run on a
streaming frame as they are. Shuffling, splitting, sampling and packing need a
finished table and are left to batch jobs over what the stream has written.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from weftline.functions.templates import Template
from weftline.operators.examples import Tokenizer, instruction_examples, text_examples
from weftline.params import DataParams


def read_new_files(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows of the files that appear below ``path``."""
    return spark.readStream.schema(schema).parquet(path)


def encode_new_rows(
    rows: DataFrame,
    keys: list[str],
    tokenizer: Tokenizer,
    params: DataParams,
    template: str | Template = "simple",
) -> DataFrame:
    """Training examples of the rows of a stream, chats or raw text."""
    if params.is_continue_pretrain:
        return text_examples(rows, keys, tokenizer, params.max_seq_length, params.text_column)
    return instruction_examples(rows, keys, tokenizer, params.max_seq_length, template)


def append_examples(examples: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write what is there now and stop; the next start goes on from there."""
    return (
        examples.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", os.path.join(checkpoint, "examples"))
        .trigger(availableNow=True)
        .start(path)
    )
