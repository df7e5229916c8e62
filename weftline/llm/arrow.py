"""Small helpers for work on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_SEEN = 400_000
LONGEST_SEEN = 64
ROWS = 1000  # rows worked on at a time, so that a task holds few texts and results
BYTES = 1 << 23  # and bytes, unless one row alone has more


_held: dict[tuple, object] = {}


def held(name: tuple, make: Callable[[], object]) -> object:
    """The one large object that a worker keeps from task to task.

    Workers outlive jobs, so what they kept for one operator would stay in memory
    while they work for the next.
    """
    if name not in _held:
        _held.clear()
        _held[name] = make()
    return _held[name]


def let_go() -> None:
    """For tasks that keep nothing: free what an earlier operator has kept."""
    _held.clear()


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """Cut batches into pieces of at most ``rows`` rows, and few bytes."""
    for batch in batches:
        todo = [batch.slice(start, rows) for start in range(0, batch.num_rows, rows)][::-1]
        while todo:
            part = todo.pop()
            if part.num_rows > 1 and part.nbytes > BYTES:
                half = part.num_rows // 2
                todo += [part.slice(half), part.slice(0, half)]
            else:
                yield part


def add_columns(
    df: DataFrame,
    keep: list[str],
    read: dict[str, Column],
    added: str,
    make: Callable[[], Callable[[dict[str, pa.Array]], list[pa.Array]]],
    rows: int = ROWS,
) -> DataFrame:
    """``keep`` columns and the columns named in the DDL text ``added``.

    ``make`` runs once per task and gives a function from the ``read`` columns of
    some rows to the added ones. Read columns get names of their own, so a kept
    column may be called anything.
    """
    names = {f"_read_{n}": c for n, c in read.items()}
    both = df.select(*[F.col(f"`{k}`") for k in keep], *[c.alias(n) for n, c in names.items()])
    k = len(keep)
    fields = T.StructType.fromDDL(added)
    inputs, outputs = list(read), [*keep, *fields.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in slices(batches, rows):
            got = {name: batch.column(k + i) for i, name in enumerate(inputs)}
            columns = [batch.column(i) for i in range(k)] + list(work(got))
            yield pa.RecordBatch.from_arrays(columns, names=outputs)

    schema = T.StructType([*both.schema.fields[:k], *fields.fields])
    return both.mapInArrow(run, schema)


def list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """A list column from one numpy array per row."""
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    values = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def texts(column: pa.Array) -> list[str]:
    """Python strings; null is the empty text."""
    return [t or "" for t in column.to_pylist()]


def int_lists(column: pa.ListArray) -> list[list[int]]:
    """A list of numbers per row; a null row is empty, a null number is -1."""
    offsets = column.offsets.to_numpy().tolist()
    values = column.values.fill_null(-1).to_numpy(zero_copy_only=False)
    valid = column.is_valid().to_pylist()
    return [
        values[a:b].tolist() if ok else [] for a, b, ok in zip(offsets, offsets[1:], valid)
    ]


def forget(seen: dict, most: int) -> None:
    """Halve a full cache; what came first is most frequent, and stays."""
    if len(seen) > most:
        for key in list(islice(reversed(seen), most // 2)):
            del seen[key]


class Seen(dict):
    """Results of ``make`` for short keys, kept up to a fixed number."""

    def __init__(self, make: Callable[[str], bytes]):
        self.make = make

    def __missing__(self, key: str) -> bytes:
        made = self.make(key)
        if len(key) <= LONGEST_SEEN:
            forget(self, MOST_SEEN)
            self[key] = made
        return made


class Known(dict):
    """Ids, as bytes, of texts seen so far; new ones are made many at a time."""

    def __init__(self, make: Callable[[list[str]], Iterable[bytes]], most: int | None = None):
        self.make, self.most = make, most

    def join(self, rows: list[list[str]]) -> list[bytes]:
        """For each row its texts' ids, one after another."""
        forget(self, self.most or MOST_SEEN)
        new = list(set().union(*rows).difference(self))
        if new:
            self.update(zip(new, self.make(new)))
        joined = [b"".join(map(self.__getitem__, row)) for row in rows]
        for text in new:
            if len(text) > LONGEST_SEEN:
                del self[text]
        return joined
