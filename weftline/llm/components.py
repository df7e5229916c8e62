"""Connected components of a table of links, by large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.session import staged

PART = 1 << 17  # links that a task closes by itself


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(v, component): every vertex of the links (a, b) and the smallest reachable one.

    First every task closes a part of the links of a fixed size, so what goes on
    are stars, and a table of one part is done. Of others each round hangs vertices under the smallest vertex they see, first their
    larger neighbours, then themselves. The rounds, of the order of the log of
    the number of vertices, end when no link changes. Links are combined by
    minimum and joined, never gathered per vertex, and each round is written,
    so a lost executor costs no earlier round.
    """
    ordered = links.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).where("a <> b").distinct()
    now = staged(ordered, "links")
    parts = max(1, -(-now.count() // PART))
    now = staged(now.coalesce(parts).mapInArrow(_closed, "a long, b long"), "links")
    if parts > 1:
        now = _starred(now, most_rounds)
    roots = now.select(F.col("b").alias("v")).distinct()
    return now.select(F.col("a").alias("v"), F.col("b").alias("component")).union(
        roots.select("v", F.col("v").alias("component"))
    )


def _closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b): each vertex of a task's links but the smallest of a component, and that one."""
    pairs = [[c.to_numpy() for c in batch.columns] for batch in batches]
    if not pairs:
        return
    a, b = (np.concatenate(x) for x in zip(*pairs))
    vertices, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    above = list(range(len(vertices)))

    def root(v: int) -> int:
        while above[v] != v:
            above[v] = v = above[above[v]]
        return v

    for v, w in zip(places[: len(a)].tolist(), places[len(a) :].tolist()):
        v, w = root(v), root(w)
        above[max(v, w)] = min(v, w)
    lowest = np.array([root(v) for v in above], np.int64)
    hung = np.flatnonzero(lowest != np.arange(len(lowest)))
    yield pa.RecordBatch.from_arrays([pa.array(vertices[hung]), pa.array(vertices[lowest[hung]])], names=["a", "b"])


def _starred(now: DataFrame, most_rounds: int) -> DataFrame:
    """Links (a, b), b < a, as stars: every vertex hangs under the smallest of its component."""
    state = _state(now)
    for _ in range(most_rounds):
        both = now.union(now.select("b", "a"))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(lowest, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        now = staged(small.union(joined.select("a", F.col("m").alias("b"))).distinct(), "links")
        before, state = state, _state(now)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return now


def _state(links: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(links.agg(F.count("*"), total).first())
