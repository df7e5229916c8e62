"""Replacing array items through a large table, hot items first.

Items are looked up where their rows are, in a dictionary of the table's most
frequent entries, whose size is measured before it is sent anywhere. A table that
fits as a whole needs no shuffle at all. Of a larger one only the items that are
not in the dictionary move: once to the table, and once back to their rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.session import staged

HOT_BYTES = 32 << 20  # of the dictionary, in every worker
ENTRY = 16  # bytes of an entry besides its texts
STEPS = 4  # steps of frequency per doubling


@dataclass
class Hot:
    """The frequent part of a table, and whether that is all of it."""

    items: pa.Array
    values: pa.Array
    whole: bool


def hot_entries(table: DataFrame, most_bytes: int = HOT_BYTES) -> Hot:
    """The most frequent entries of (from, to[, n]) that fit in ``most_bytes``.

    Frequencies fall into steps; steps are taken from the top while their
    measured sizes fit. Without ``n`` all entries are one step: all or none.
    """
    n = F.col("n") if "n" in table.columns else F.lit(1)
    size = F.octet_length(F.col("from").cast("string")) + F.octet_length(F.col("to").cast("string")) + ENTRY
    step = F.floor(F.log2(F.greatest(n, F.lit(1)).cast("double")) * STEPS).cast("int").alias("step")
    sized = table.select("from", "to", step, size.cast("bigint").alias("size"))
    # A step per fraction of a doubling: a few hundred rows at most.
    steps = sized.groupBy("step").agg(F.sum("size").alias("size")).orderBy(F.desc("step")).collect()
    room, cut = most_bytes, None
    for row in steps:
        if row["size"] > room:
            break
        room, cut = room - row["size"], row["step"]
    if cut is None:
        empty = table.limit(0).select("from", "to").toArrow()
        return Hot(*(c.combine_chunks() for c in empty.columns), whole=not steps)
    found = sized.where(F.col("step") >= cut).select("from", "to").toArrow()
    return Hot(*(c.combine_chunks() for c in found.columns), whole=cut == steps[-1]["step"])


def _offsets(column: pa.ListArray) -> np.ndarray:
    """Where the items of each row begin among all, null rows being empty."""
    return np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy())))


def _hot_places(column: pa.ListArray, hot: Hot) -> tuple[pa.Array, np.ndarray, pa.Array]:
    """Places in the dictionary by item (null if not hot), row offsets, and the items."""
    items = column.flatten()
    return pc.index_in(items, value_set=hot.items), _offsets(column), items


def _lists(values: pa.Array, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def look_up(
    df: DataFrame,
    keep: list[str],
    values: str,
    table: DataFrame,
    unknown: str | int,
    out: str,
    most_bytes: int = HOT_BYTES,
) -> DataFrame:
    """``keep`` columns and ``out``: the items of ``values`` replaced through ``table``.

    ``table`` has (from, to) and, best, ``n``, how frequent an entry is; each
    ``from`` is there once. Items that it lacks, null ones too, become
    ``unknown``; null and empty arrays become empty ones. Rows are told apart by
    themselves, so nothing is asked of ``keep``.
    """
    spark = df.sparkSession
    hot = spark.sparkContext.broadcast(hot_entries(table, most_bytes))
    to_type = table.schema["to"].dataType
    rows = df.select(*[F.col(f"`{k}`") for k in keep], F.col(f"`{values}`").alias("_values"))
    kept, k = rows.schema.fields[: len(keep)], len(keep)
    result = T.StructField(out, T.ArrayType(to_type))
    if hot.value.whole:

        def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at, offsets, _ = _hot_places(batch.column(k), hot.value)
                found = hot.value.values.take(at)
                filled = pc.fill_null(found, pa.scalar(unknown, found.type))
                yield pa.RecordBatch.from_arrays([*batch.columns[:k], _lists(filled, offsets)], names=[*keep, out])

        return rows.mapInArrow(replace, T.StructType([*kept, result]))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, offsets, items = _hot_places(batch.column(k), hot.value)
            codes = at.fill_null(-1).to_numpy().astype(np.int32, copy=False)
            # Cold items with their places, row by row.
            cold = np.flatnonzero(codes < 0)
            row = np.searchsorted(offsets, cold, "right") - 1
            bounds = np.searchsorted(row, np.arange(batch.num_rows + 1))
            places = pa.array(cold - offsets[row], pa.int32())
            entries = pa.StructArray.from_arrays([places, items.take(pa.array(cold))], names=["at", "item"])
            ends = pa.array(4 * offsets, pa.int32()).buffers()[1]
            packed = pa.BinaryArray.from_buffers(pa.binary(), batch.num_rows, [None, ends, pa.py_buffer(codes.tobytes())])
            columns = [*batch.columns[:k], packed, _lists(entries, bounds)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "_codes", "_cold"])

    cold_type = T.ArrayType(T.StructType([T.StructField("at", T.IntegerType()), T.StructField("item", table.schema["from"].dataType)]))
    # Places in the dictionary, four bytes each, stand for its values until the end.
    codes = T.StructField("_codes", T.BinaryType())
    parted = rows.mapInArrow(part, T.StructType([*kept, codes, T.StructField("_cold", cold_type)]))
    # Written, so that a row keeps the number by which its items find back to it.
    first = staged(parted.withColumn("_row", F.monotonically_increasing_id()), "looked_up")
    cold = first.select("_row", F.inline("_cold"))
    entries = table.select(F.col("from").alias("item"), F.col("to").alias("_to"))
    # An item can be frequent and yet not in the table; the adaptive planner
    # splits what such an item makes of the left side.
    met = cold.join(entries, "item", "left").select("_row", F.struct("at", "_to").alias("x"))
    back = met.groupBy("_row").agg(F.collect_list("x").alias("_back"))
    joined = first.join(back, "_row", "left").select(*[F.col(f"`{c}`") for c in keep], "_codes", "_back")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed, cold = batch.column(k), batch.column(k + 1)
            offsets = np.concatenate(([0], np.cumsum(pc.binary_length(packed).to_numpy() // 4)))
            at = np.frombuffer(b"".join(packed.to_pylist()), np.int32).astype(np.int64)
            entries = cold.flatten()
            row = np.repeat(np.arange(batch.num_rows), np.diff(_offsets(cold)))
            # The values that were moved follow those of the dictionary.
            at[offsets[row] + entries.field("at").to_numpy()] = len(hot.value.values) + np.arange(len(entries))
            found = pa.concat_arrays([hot.value.values, entries.field("_to")]).take(pa.array(at))
            filled = pc.fill_null(found, pa.scalar(unknown, found.type))
            yield pa.RecordBatch.from_arrays([*batch.columns[:k], _lists(filled, offsets)], names=[*keep, out])

    return joined.mapInArrow(fill, T.StructType([*kept, result]))
