"""Packing a stream of examples into fixed-length rows.

Packing is next-fit over the order of arrival, as
:mod:`weftline.operators.packing` does it for a finished table. The state of a
shard is its open bin and the number of the next one, carried from micro-batch
to micro-batch in the query's checkpoint; so a stream that is stopped and started
again packs as if it had never stopped. A full bin is given away when a row comes
that does not fit; the last one of each shard waits for more.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from weftline.operators.packing import _flat, next_fit
from weftline.params import IGNORE_INDEX

BIN = "shard long, bin long, n_rows long, n_tokens long, ids {}"
STATE = "bin long, n_rows long, ids array<int>"
WIDTH = 4  # bytes of an id
EMITTED = 1 << 20  # tokens of the full bins that a task holds at a time


def shard_of(key: Column, num_shards: int) -> Column:
    """An even shard for every row, the same in every run."""
    return F.pmod(F.xxhash64(key), F.lit(num_shards)).cast("bigint")


def _to_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids as bytes: as values of pandas, lists would take ten times their room."""
    for batch in batches:
        values, offsets = _flat(batch.column("ids"))
        data = [None, pa.py_buffer((offsets * WIDTH).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values, np.int32))]
        ids = pa.Array.from_buffers(pa.binary(), batch.num_rows, data)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids], names=batch.schema.names)


def _to_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.frombuffer(b"".join(batch.column("ids").to_pylist()), np.int32)
        ends = np.cumsum(batch.column("n_tokens").to_numpy())
        offsets = pa.array(np.concatenate(([0], ends)), pa.int32())
        ids = pa.ListArray.from_arrays(offsets, pa.array(values))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids], names=batch.schema.names)


def _pack(limit: int):
    most = max(1, EMITTED // limit)  # bins per emitted frame

    def frame(key: tuple, bins: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame([(key[0], *b) for b in bins], columns=["shard", "bin", "n_rows", "n_tokens", "ids"])

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        number, n_rows, held = state.get if state.exists else (0, 0, [])
        held = np.asarray(held, np.int32).tobytes()
        with tempfile.TemporaryFile() as kept:
            # The new rows of one shard in one micro-batch. They come in any order, so
            # their ids wait in a file; only order and lengths are held.
            seqs, sizes = [], []
            for rows in frames:
                kept.writelines(rows["ids"])
                seqs.append(rows["seq"])
                sizes.append(np.fromiter(map(len, rows["ids"]), np.int64, len(rows)))
            size = np.concatenate(sizes)
            at = np.cumsum(size) - size
            order = pd.concat(seqs, ignore_index=True).sort_values(kind="stable").index.to_numpy()

            def ids_of(row: int) -> bytes:
                kept.seek(int(at[row]))
                return kept.read(int(size[row]))

            # The open bin takes part as if it were the first row.
            starts = next_fit(np.concatenate(([len(held)], size[order])), limit * WIDTH)
            bounds = np.append(starts, len(order) + 1) - 1
            done = []
            for k in range(len(starts)):
                first, last = max(int(bounds[k]), 0), int(bounds[k + 1])
                if k:
                    done.append((number, n_rows, len(held) // WIDTH, held))
                    number, n_rows, held = number + 1, 0, b""
                    if len(done) >= most:
                        yield frame(key, done)
                        done = []
                held = b"".join([held, *map(ids_of, order[first:last])])
                n_rows += last - first
        state.update((number, n_rows, np.frombuffer(held, np.int32).tolist()))
        yield frame(key, done)

    return run


def pack_stream(
    rows: DataFrame, shard: str, seq: str, max_length: int, pad_id: int, ids: str = "input_ids"
) -> DataFrame:
    """(shard, bin, n_rows, n_tokens, input_ids, attention_mask, labels) of a stream.

    ``seq`` orders the rows of a micro-batch; rows of a later one come after. A
    task keeps the new ids of one shard in a temporary file of its own and holds
    ``seq`` and the length of each row. Rows are cut to ``max_length`` before they
    move; null and empty ones join a bin without tokens. Padding carries the pad
    id, mask 0 and the ignored label.
    """
    cut = F.slice(F.coalesce(F.col(f"`{ids}`"), F.array().cast("array<int>")), 1, max_length)
    lean = rows.select(
        F.col(f"`{shard}`").cast("bigint").alias("shard"), F.col(f"`{seq}`").alias("seq"), cut.alias("ids")
    )
    flat = T.StructType([*lean.schema.fields[:-1], T.StructField("ids", T.BinaryType())])
    bins = (
        lean.mapInArrow(_to_bytes, flat)
        .groupBy("shard")
        .applyInPandasWithState(_pack(max_length), BIN.format("binary"), STATE, "append", GroupStateTimeout.NoTimeout)
        .mapInArrow(_to_lists, BIN.format("array<int>"))
    )
    n = F.col("n_tokens").cast("int")

    def filled(body: Column, value: int) -> Column:
        return F.concat(body, F.array_repeat(F.lit(value), max_length - n))

    return bins.select(
        "shard",
        "bin",
        "n_rows",
        "n_tokens",
        filled(F.col("ids"), pad_id).alias("input_ids"),
        filled(F.array_repeat(F.lit(1), n), 0).alias("attention_mask"),
        filled(F.col("ids"), IGNORE_INDEX).alias("labels"),
    )


def append_packed(packed: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the bins that are full by now and stop; the next start goes on from there."""
    return (
        packed.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", os.path.join(checkpoint, "packed"))
        .trigger(availableNow=True)
        .start(path)
    )
