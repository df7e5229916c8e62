"""Packing rows into fixed-length sequences, and padding batches.

Packing is order-preserving next-fit inside a chunk: rows are appended while
they fit, otherwise the open bin is padded and closed. A bin is therefore a
contiguous run of its chunk's token stream. Rows are hash-partitioned by chunk,
sorted, and streamed through Arrow batches; a task holds one batch and one open
bin, not a chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.arrays import ones_like, pad_right
from weftline.params import IGNORE_INDEX

PACKED = (
    "split string, shard bigint, chunk bigint, bin bigint, n_rows bigint, n_tokens bigint, "
    "input_ids array<int>"
)
BINS = (
    "split string, shard bigint, chunk bigint, idx bigint, bin bigint, "
    "bin_start bigint, n_tokens bigint"
)
PLACE = ["split", "shard", "chunk"]


def next_fit(lengths: np.ndarray, limit: int) -> np.ndarray:
    """First row of every bin; no length exceeds ``limit``."""
    ends = np.cumsum(lengths)
    starts, row = [], 0
    while row < len(lengths):
        starts.append(row)
        room = limit + (ends[row - 1] if row else 0)
        row = int(np.searchsorted(ends, room, side="right"))
    return np.asarray(starts, dtype=np.int64)


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and row offsets of a list column."""
    offsets = np.asarray(column.offsets)
    values = np.asarray(column.values)[offsets[0] : offsets[-1]]
    return values, offsets - offsets[0]


def _truncate(values: np.ndarray, offsets: np.ndarray, limit: int):
    """Cut every row to ``limit`` values."""
    lengths = np.diff(offsets)
    if not len(lengths) or lengths.max() <= limit:
        return values, offsets
    inside = np.arange(len(values)) - np.repeat(offsets[:-1], lengths)
    return values[inside < limit], np.concatenate(
        ([0], np.cumsum(np.minimum(lengths, limit)))
    )


def _places(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [batch.column(c).to_numpy(zero_copy_only=False) for c in PLACE]


def _group_edges(*keys: np.ndarray) -> np.ndarray:
    """Bounds of the runs of equal keys."""
    n = len(keys[0])
    changed = np.zeros(n, dtype=bool)
    for k in keys:
        changed[1:] |= k[1:] != k[:-1]
    return np.concatenate(([0], np.flatnonzero(changed), [n]))


class _OpenBin:
    """The bin that the next row of the same chunk may still join."""

    def __init__(self, key, n_lists, number=0):
        self.key, self.number, self.rows = key, number, 0
        self.lists = [np.empty(0, dtype=np.int32)] * n_lists

    def __len__(self):
        return len(self.lists[0])


def _pack_batches(limit: int, pads: dict[str, int]):
    """Packer of the list columns in ``pads``, each filled up with its value."""
    names = list(pads)

    def closed(bins: list[_OpenBin]) -> pa.RecordBatch:
        n = len(bins)
        edges = pa.array(np.arange(0, (n + 1) * limit, limit, dtype=np.int32))
        filled = []
        for j, name in enumerate(names):
            out = np.full((n, limit), pads[name], dtype=np.int32)
            for k, b in enumerate(bins):
                out[k, : len(b)] = b.lists[j]
            filled.append(pa.ListArray.from_arrays(edges, pa.array(out.ravel())))
        columns = [
            pa.array([b.key[0] for b in bins], pa.string()),
            pa.array([b.key[1] for b in bins], pa.int64()),
            pa.array([b.key[2] for b in bins], pa.int64()),
            pa.array([b.number for b in bins], pa.int64()),
            pa.array([b.rows for b in bins], pa.int64()),
            pa.array([len(b) for b in bins], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(
            [*columns, *filled], names=[*PLACE, "bin", "n_rows", "n_tokens", *names]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _OpenBin | None = None
        done: list[_OpenBin] = []
        most = max(1, (8 << 20) // limit)  # bins per emitted batch
        for batch in batches:
            if batch.num_rows == 0:
                continue
            places = _places(batch)
            lists, offsets = [], None
            for name in names:
                values, offsets = _truncate(*_flat(batch.column(name)), limit)
                lists.append(values)
            edges = _group_edges(*places)
            for a, z in zip(edges[:-1], edges[1:]):
                key = tuple(p[a] for p in places)
                if current is None or current.key != key:
                    if current is not None:
                        done.append(current)
                    current = _OpenBin(key, len(names))
                # The open bin takes part as if it were the first row.
                lengths = np.concatenate(([len(current)], np.diff(offsets[a : z + 1])))
                starts = next_fit(lengths, limit)
                bounds = np.append(starts, len(lengths)) - 1  # row 0 is the open bin
                for k in range(len(starts)):
                    first, last = max(int(bounds[k]), 0), int(bounds[k + 1])
                    lo, hi = offsets[a + first], offsets[a + last]
                    if k:
                        done.append(current)
                        current = _OpenBin(key, len(names), current.number + 1)
                    current.lists = [
                        np.concatenate((held, values[lo:hi])) if len(held) else values[lo:hi]
                        for held, values in zip(current.lists, lists)
                    ]
                    current.rows += last - first
                    if len(done) >= most:
                        yield closed(done)
                        done = []
        if current is not None:
            done.append(current)
        if done:
            yield closed(done)

    return run


def arrange_chunks(df: DataFrame, order: str = "idx") -> DataFrame:
    """Bring every chunk's rows into one task, in order: the packing shuffle.

    Row-by-row work on the result keeps the arrangement, so rows can be moved
    as text and encoded afterwards.
    """
    return df.repartition(*PLACE).sortWithinPartitions(*PLACE, order)


def pack_arranged(rows: DataFrame, max_length: int, pad_id: int) -> DataFrame:
    """:func:`pack_sequences` of rows that :func:`arrange_chunks` has placed.

    Rows without ``labels`` get their ids as labels; only the ids are packed
    then, and the labels are made from them.
    """
    own_labels = "labels" in rows.columns
    pads = {"input_ids": pad_id, **({"labels": IGNORE_INDEX} if own_labels else {})}
    schema = PACKED + (", labels array<int>" if own_labels else "")
    packed = rows.select(*PLACE, *pads).mapInArrow(_pack_batches(max_length, pads), schema)
    n = F.col("n_tokens").cast("int")

    def filled(body: Column, value: int) -> Column:
        return F.concat(body, F.array_repeat(F.lit(value), max_length - n))

    labels = (
        F.col("labels")
        if own_labels
        else filled(F.slice("input_ids", F.lit(1), n), IGNORE_INDEX).alias("labels")
    )
    mask = filled(F.array_repeat(F.lit(1), n), 0).alias("attention_mask")
    return packed.select(*PLACE, "bin", "n_rows", "n_tokens", "input_ids", mask, labels)


def pack_sequences(df: DataFrame, max_length: int, pad_id: int) -> DataFrame:
    """Pack (split, shard, chunk, idx, input_ids[, labels]) into rows of ``max_length``.

    Longer rows are cut to ``max_length`` first. Padding carries the pad id,
    mask 0 and the ignored label.
    """
    lists = [c for c in ("input_ids", "labels") if c in df.columns]
    rows = arrange_chunks(df.select(*PLACE, "idx", *lists))
    return pack_arranged(rows, max_length, pad_id)


def _assign_batches(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, number, used = None, 0, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            places = _places(batch)
            size = np.minimum(batch.column("n_tokens").to_numpy(), limit)
            bins = np.empty(len(size), dtype=np.int64)
            at = np.empty(len(size), dtype=np.int64)
            edges = _group_edges(*places)
            for a, z in zip(edges[:-1], edges[1:]):
                here = tuple(p[a] for p in places)
                if key != here:
                    key, number, used = here, 0, 0
                starts = next_fit(np.concatenate(([used], size[a:z])), limit)
                # Bin of each row, and where the bin's own tokens begin.
                rows = np.arange(1, z - a + 1)
                which = np.searchsorted(starts, rows, side="right") - 1
                before = np.concatenate(([0], np.cumsum(np.concatenate(([used], size[a:z])))))
                bins[a:z] = number + which
                at[a:z] = before[rows] - before[starts[which]]
                number += len(starts) - 1
                used = int(at[z - 1] + size[z - 1])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in (*PLACE, "idx")),
                 pa.array(bins), pa.array(at), pa.array(size.astype(np.int64))],
                names=[*PLACE, "idx", "bin", "bin_start", "n_tokens"],
            )

    return run


def assign_bins(df: DataFrame, max_length: int) -> DataFrame:
    """Where packing puts each row, from lengths alone: (bin, bin_start).

    Takes (split, shard, chunk, idx, n_tokens); carries no tokens, so it is cheap
    enough to size a packing before doing it.
    """
    sized = df.select(*PLACE, "idx", F.col("n_tokens").cast("bigint").alias("n_tokens"))
    return arrange_chunks(sized).mapInArrow(_assign_batches(max_length), BINS)


def padded_size(longest: Column, multiple: int) -> Column:
    return (F.ceil(longest / multiple) * multiple).cast("int")


def pad_batches(
    indexed: DataFrame, batch_rows: int, pad_id: int, multiple: int = 64
) -> DataFrame:
    """Pad consecutive batches of a split to their longest row, rounded up to
    ``multiple``. A batch has ``batch_rows`` rows at most, so the window is small.
    Rows without ``labels`` get their ids as labels, made after they have moved.
    """
    labels = "labels" if "labels" in indexed.columns else "input_ids"
    indexed = indexed.drop("attention_mask")
    batched = indexed.withColumn(
        "batch", F.floor(F.col("idx") / batch_rows).cast("bigint")
    ).withColumn(
        "_to",
        padded_size(F.max(F.size("input_ids")).over(Window.partitionBy("split", "batch")), multiple),
    )
    to = F.col("_to")
    return batched.select(
        *[c for c in indexed.columns if c not in ("input_ids", "attention_mask", "labels")],
        "batch",
        pad_right(F.col("input_ids"), pad_id, to).alias("input_ids"),
        pad_right(ones_like(F.col("input_ids")), 0, to).alias("attention_mask"),
        pad_right(F.col(labels), IGNORE_INDEX, to).alias("labels"),
    )


def length_check(packed: DataFrame, max_length: int) -> DataFrame:
    """Whether every packed row has the same, wanted length in all columns."""
    sizes = [F.size(c) for c in ("input_ids", "attention_mask", "labels")]
    return packed.agg(
        F.count("*").alias("n_rows"),
        F.min(F.least(*sizes)).cast("bigint").alias("min_size"),
        F.max(F.greatest(*sizes)).cast("bigint").alias("max_size"),
    ).withColumn(
        "stackable",
        F.coalesce(
            (F.col("min_size") == max_length) & (F.col("max_size") == max_length), F.lit(True)
        ),
    )
