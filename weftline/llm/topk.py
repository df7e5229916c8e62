"""Exact top-k inner products by pivot-table elimination.

Every vector is stored with its distances to a few hundred pivots. By the
triangle inequality the largest difference between a query's and a candidate's
entries is a lower bound of their distance, and so, with their norms, gives an
upper bound of their inner product. A query evaluates candidates in the order of
these bounds, some at a time, and stops when the next bound does not reach its
k-th best score: candidates behind it are never scored, and nothing is
approximate.

Queries come in blocks of a fixed size, one after another. A block is broadcast,
each task runs it against its candidates and hands on k rows per query, and what
is found is written before the next block: candidates are never shuffled, no
pair of rows is listed, and one block at a time is held.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.arrow import slices
from weftline.session import scratch_path, staged

STEP = 256  # candidates evaluated between two looks at the bounds
GROUP = 128  # queries worked on together
BATCH = 8192  # candidates worked on together
EXACT = 2.0**53
MOST_PIVOT_ROWS = 4096  # rows that pivots are chosen from


def whole_numbers(vector: Column, scale: float) -> Column:
    """floor(scale * x) of each component; null where a vector takes no part."""
    doubles = vector.cast("array<double>")
    bad = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(
        doubles.isNotNull() & ~bad, F.transform(doubles, lambda x: F.floor(x * scale).cast("bigint"))
    )


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """One row per vector; shorter ones end in zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    begin = 0
    for i, n in enumerate(sizes.tolist()):
        out[i, :n] = flat[begin : begin + n]
        begin += n
    return out


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The pivot table: a row of distances per vector."""
    x, p = x.astype(float), pivots.astype(float)
    squares = (x * x).sum(1)[:, None] + (p * p).sum(1)[None] - 2 * (x @ p.T)
    return np.sqrt(np.maximum(squares, 0)).astype(np.float32)


def spread_out(x: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows of ``x``, each as far as can be from those before it."""
    chosen, far = [], np.full(len(x), np.inf)
    for _ in range(min(n, len(x))):
        # Equal rows are at no distance, so they are not taken twice.
        i = int(far.argmax())
        if far[i] <= 0:
            break
        chosen.append(i)
        far = np.minimum(far, distances(x, x[i : i + 1])[:, 0])
        far[i] = 0
    return x[chosen]


class Queries:
    """A block of queries, and the best candidates they have met."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, table: np.ndarray, k: int):
        self.ids, self.x, self.table, self.k = ids, x, table, k
        self.norms = (x.astype(float) ** 2).sum(1)
        self.floor = np.full(len(ids), -np.inf)  # the k-th best score so far
        self.found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in ids]
        self.scored, self.met = 0, 0

    def meet(self, ids: np.ndarray, x: np.ndarray, table: np.ndarray) -> None:
        norms = (x.astype(float) ** 2).sum(1)
        widest = np.abs(x).max(initial=0) * float(np.abs(self.x).max(initial=0)) * x.shape[1]
        kind = float if widest < EXACT else np.int64  # whole either way
        x, columns = x.astype(kind), np.ascontiguousarray(table.T)
        for at in range(0, len(self.ids), GROUP):
            group = np.arange(at, min(at + GROUP, len(self.ids)))
            bound = self._bounds(group, columns, norms)
            bound[self.ids[group, None] == ids[None]] = -np.inf  # not itself
            for row, b in zip(group, bound):
                self._evaluate(row, ids, x, b, self.x[row].astype(kind))
            self.met += bound.size

    def _bounds(self, group: np.ndarray, columns: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """The most that each query's score with each candidate can be."""
        low = np.zeros((len(group), len(norms)), np.float32)
        gap = np.empty_like(low)
        for p, entries in enumerate(columns):
            np.subtract(self.table[group, p, None], entries[None], out=gap)
            np.maximum(low, np.abs(gap, out=gap), out=low)
        # Distances are rounded, so bounds are taken a little wider.
        wide = 1e-5 * (np.sqrt(self.norms[group])[:, None] + np.sqrt(norms)[None] + 1)
        low = np.maximum(low - wide, 0)
        bound = (self.norms[group, None] + norms[None] - low * low) / 2
        bound += 1e-12 * np.abs(bound)
        return bound

    def _evaluate(self, row: int, ids: np.ndarray, x: np.ndarray, bound: np.ndarray, q: np.ndarray) -> None:
        """Candidates in the order of their bounds, until none left can matter."""
        # A bound that equals the floor may still be a tie with a smaller id.
        left = np.flatnonzero((bound >= self.floor[row]) & (bound > -np.inf))
        left = left[np.argsort(-bound[left])]
        for at in range(0, len(left), STEP):
            if bound[left[at]] < self.floor[row]:
                return
            some = left[at : at + STEP]
            self._keep(row, ids[some], x[some] @ q)
            self.scored += len(some)

    def _keep(self, row: int, ids: np.ndarray, scores: np.ndarray) -> None:
        taken = scores >= self.floor[row]
        if not taken.any():
            return
        old_ids, old = self.found[row]
        ids = np.concatenate([old_ids, ids[taken]])
        scores = np.concatenate([old, scores[taken].astype(np.int64)])
        best = np.lexsort((ids, -scores))[: self.k]
        self.found[row] = ids[best], scores[best]
        if len(best) == self.k:
            self.floor[row] = scores[best[-1]]


def query_blocks(asked: DataFrame, block: int, key: str = "id") -> Iterator[DataFrame]:
    """Hashed parts of the queries, none with more than ``block`` rows."""
    n_blocks = max(1, -(-asked.count() // block))
    while n_blocks > 1:
        part = F.pmod(F.xxhash64(key), F.lit(n_blocks))
        most = asked.groupBy(part.alias("p")).count().agg(F.max("count")).first()[0]
        if most <= block:
            break
        n_blocks += 1 + n_blocks // 4
    for part in range(n_blocks):
        yield asked.where(F.pmod(F.xxhash64(key), F.lit(n_blocks)) == part)


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: float = 64.0,
    n_pivots: int = 256,
    block: int = 8192,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score``, exactly.

    Queries are the rows for which ``is_query`` holds, candidates all rows but
    the query's own. Components are floored multiples of 1 / ``scale``. Vectors
    that are null, or hold a null or non-finite component, and rows without a
    key take no part. A key that repeats counts once, with its least vector;
    shorter vectors are continued with zeros. Ties go to the smaller key, and a
    query with fewer than ``k`` candidates gets all. An empty table, or one
    without queries, gives no rows. Scores beyond a long wrap.

    Pivots are ``n_pivots`` rows far apart, chosen from the first 4,096 by hashed
    key: a bounded sample that decides how much is skipped, never what is found.
    At most ``block`` queries are on the driver or broadcast at a time.
    """
    spark = df.sparkSession
    plain = staged(
        df.select(
            F.col(f"`{key}`").cast("bigint").alias("id"),
            whole_numbers(F.col(f"`{vector}`"), scale).alias("x"),
            is_query.alias("asks"),
        )
        .dropna(subset=["id", "x"])
        .groupBy("id")
        .agg(F.min("x").alias("x"), F.bool_or("asks").alias("asks")),
        "vectors",
    )
    width = max(1, plain.agg(F.max(F.size("x"))).first()[0] or 1)
    sample = plain.orderBy(F.xxhash64("id"), "id").limit(MOST_PIVOT_ROWS).select("x").toArrow()
    pivots = spread_out(matrix(sample["x"].combine_chunks(), width), n_pivots)
    vectors = staged(_with_table(plain, pivots, width), "pivot_table")
    out, written = scratch_path(spark, "found"), False
    for mine in query_blocks(vectors.where("asks").select("id", "x", "table"), block):
        found = mine.toArrow().combine_chunks()
        if not found.num_rows:
            continue
        table = found["table"].combine_chunks().flatten().to_numpy().reshape(found.num_rows, -1)
        queries = found["id"].to_numpy(), matrix(found["x"].combine_chunks(), width), table
        shared = spark.sparkContext.broadcast(queries)
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        (
            _search(vectors, shared, k, width)
            .withColumn("rank", F.row_number().over(best))
            .where(F.col("rank") <= k)
            .write.mode("append")
            .parquet(out)
        )
        written = True
        shared.destroy()
    schema = "query_id long, vec_id long, score long, rank int"
    found = spark.read.schema(schema).parquet(out) if written else spark.createDataFrame([], schema)
    return found.select("query_id", "rank", "vec_id", "score")


def _with_table(plain: DataFrame, pivots: np.ndarray, width: int) -> DataFrame:
    """The rows with their entries of the pivot table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BATCH):
            table = distances(matrix(batch.column(1), width), pivots)
            rows = pa.array(list(table), pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, rows], names=["id", "x", "asks", "table"])

    return plain.mapInArrow(run, "id long, x array<long>, asks boolean, table array<float>")


def _search(vectors: DataFrame, shared, k: int, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = None
        for part in slices(batches, BATCH):
            if not part.num_rows:
                continue
            queries = queries or Queries(*shared.value, k)
            table = part.column(2).flatten().to_numpy().reshape(part.num_rows, -1)
            queries.meet(part.column(0).to_numpy(), matrix(part.column(1), width), table)
        if queries is not None:
            counts = [len(found) for found, _ in queries.found]
            columns = [
                np.repeat(queries.ids, counts),
                np.concatenate([a for a, _ in queries.found]),
                np.concatenate([b for _, b in queries.found]),
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"]
            )

    return vectors.select("id", "x", "table").mapInArrow(run, "query_id long, vec_id long, score long")
