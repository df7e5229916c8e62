"""Bloom filters of a fixed size, built by all tasks and merged by blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCK = 1 << 16  # bits that travel together


def places(hashes: np.ndarray, bits: int, n: int) -> np.ndarray:
    """``n`` bit numbers of each hash; hashes are (rows, 2) unsigned 64-bit numbers."""
    steps = np.arange(n, dtype=np.uint64)
    odd = hashes[:, 1:] | np.uint64(1)
    return (hashes[:, :1] + steps * odd) & np.uint64(bits - 1)


class Bits:
    """A bit array; hashes that share a bit with others may be found by mistake."""

    def __init__(self, bits: int, n: int, data: np.ndarray | None = None):
        if bits < BLOCK or bits & (bits - 1):
            raise ValueError(f"bits must be a power of two from {BLOCK}")
        self.bits, self.n = bits, n
        self.data = np.zeros(bits >> 3, np.uint8) if data is None else data

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = places(hashes, self.bits, self.n)
        found = self.data[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)
        return (found & 1).all(axis=1)

    def add(self, hashes: np.ndarray) -> None:
        at = places(hashes, self.bits, self.n).ravel()
        bit = np.left_shift(1, (at & np.uint64(7)).astype(np.uint8)).astype(np.uint8)
        np.bitwise_or.at(self.data, at >> np.uint64(3), bit)


def seen_filters(
    df: DataFrame,
    hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]],
    bits: int,
    n: int = 4,
) -> tuple[Bits, Bits]:
    """Filters of all hashes that occur, and of all that occur in two rows.

    Each task fills a filter of what it has seen once and one of what it has
    seen again. Merging two tasks adds to the second whatever both have in the
    first: if both saw a hash, all its bits are in both. ``hashes`` gives, for
    each row, its distinct hashes. The tasks' filters are merged block by block
    in a stream; ``bits / 4`` bytes come to the driver, whatever the input.
    """

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = Bits(bits, n), Bits(bits, n)
        for batch in batches:
            for found in hashes(batch):
                if len(found):
                    again = once.has(found)
                    once.add(found)
                    if again.any():
                        twice.add(found[again])
        size = BLOCK >> 3
        for k in range(bits // BLOCK):
            a, b = (x.data[k * size : (k + 1) * size] for x in (once, twice))
            if a.any():
                yield from rows([(k, a, b)])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for k, a, b in zip(*(batch.column(i).to_pylist() for i in range(3))):
                a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
                if k in kept:
                    once, twice = kept[k]
                    twice |= b | (once & a)
                    once |= a
                else:
                    kept[k] = a.copy(), b.copy()
        yield from rows([(k, *both) for k, both in kept.items()])

    def rows(found: list[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for k, once, twice in found:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([once.tobytes()]), pa.array([twice.tobytes()])],
                names=["block", "once", "twice"],
            )

    schema = "block int, once binary, twice binary"
    merged = df.mapInArrow(fill, schema).repartition("block").mapInArrow(merge, schema)
    result = Bits(bits, n), Bits(bits, n)
    for k, *both in merged.collect():
        at = k * (BLOCK >> 3)
        for filled, data in zip(result, both):
            filled.data[at : at + (BLOCK >> 3)] = np.frombuffer(data, np.uint8)
    return result
