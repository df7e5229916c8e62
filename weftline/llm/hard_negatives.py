"""Hard negatives by rotated one-bit codes with exact intervals.

Every vector is rotated by one fixed orthogonal matrix and kept as one-bit codes:
the signs of the rotated vector, then the signs of what the codes before leave
over, a few levels deep. With each code its alignment is stored, the inner
product of the vector left over and the code's unit vector, and at the end the
length of what no code holds. An anchor is cut into bit planes, so its inner
products with the codes are popcounts. They give an estimate of the score, and
by Cauchy-Schwarz the rest of both sides gives how far off it can be: the score
lies in an interval for certain. Only candidates whose interval reaches what is
still looked for are scored in whole numbers, so results are exact.

Anchors come in blocks of a fixed size, one after another. A block is broadcast,
meets all rows twice - first for its positives, then, these being known, for
their negatives - and is written before the next one is read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.arrow import slices
from weftline.llm.topk import matrix, query_blocks, whole_numbers
from weftline.session import scratch_path, staged

LEVELS = 4  # one-bit codes of a vector
PLANES = 8  # bits of an anchor's component
BATCH = 8192  # candidates worked on together
GROUP = 64  # anchors worked on together
NUMBERS = 1 << 22  # components that are multiplied at a time
SEED = 11


def rotation(width: int) -> np.ndarray:
    """A fixed orthogonal matrix over whole words of 64 components."""
    d = -(-max(width, 1) // 64) * 64
    return np.linalg.qr(np.random.default_rng(SEED).normal(size=(d, d)))[0]


def rotated(x: np.ndarray, turn: np.ndarray) -> np.ndarray:
    return x.astype(float) @ turn[: x.shape[1]]


def packed(signs: np.ndarray) -> np.ndarray:
    """Rows of booleans as 64-bit words."""
    return np.packbits(signs, axis=1, bitorder="little").view(np.uint64)


@dataclass
class Codes:
    """One-bit codes of vectors: words by level, alignments, and what is left."""

    words: np.ndarray  # vectors, levels, words
    align: np.ndarray  # vectors, levels
    rest: np.ndarray
    norm: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray, turn: np.ndarray, levels: int) -> Codes:
        left = rotated(x, turn)
        norm = np.sqrt((left * left).sum(1))
        words, align = [], []
        for _ in range(levels):
            signs = left >= 0
            unit = np.where(signs, 1.0, -1.0) / np.sqrt(len(turn))
            a = (left * unit).sum(1)
            left = left - a[:, None] * unit
            words.append(packed(signs))
            align.append(a)
        rest = np.sqrt((left * left).sum(1))
        return cls(np.stack(words, 1), np.stack(align, 1), rest, norm)


class Anchors:
    """A block of anchors as bit planes of their rotated components."""

    def __init__(self, x: np.ndarray, turn: np.ndarray):
        self.d = len(turn)
        y = rotated(x, turn)
        self.low = y.min(1) if len(y) else np.zeros(0)
        self.step = np.maximum((y.max(1) if len(y) else np.zeros(0)) - self.low, 1e-9) / (2**PLANES - 1)
        k = np.rint((y - self.low[:, None]) / self.step[:, None]).astype(np.int64)
        self.planes = np.stack([packed((k >> p & 1).astype(bool)) for p in range(PLANES)], 1)
        self.total = k.sum(1)
        lost = y - (self.low[:, None] + self.step[:, None] * k)
        self.lost = np.sqrt((lost * lost).sum(1))
        self.norm = np.sqrt((y * y).sum(1))

    def intervals(self, group: slice, codes: Codes) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest score of each anchor of the group and each candidate."""
        planes, root = self.planes[group], np.sqrt(self.d)
        low, step = self.low[group, None], self.step[group, None]
        lost, norm = self.lost[group, None], self.norm[group, None]
        estimate = np.zeros((len(planes), len(codes.norm)))
        for level in range(codes.words.shape[1]):
            words = codes.words[:, level]
            ones = np.bitwise_count(words).sum(1, dtype=np.int64)
            inside = np.zeros(estimate.shape, np.int32)
            for p in range(PLANES):
                for w in range(words.shape[1]):
                    shared = np.bitwise_count(planes[:, p, w, None] & words[None, :, w])
                    inside += shared.astype(np.int32) << p
            # The sum of the anchor's components where the code is 1, less the others.
            along = step * (2.0 * inside - self.total[group, None]) + low * (2.0 * ones[None] - self.d)
            along /= root
            estimate += codes.align[None, :, level] * along
        # What is left over is at right angles to the last code, so it meets
        # only that part of the anchor which is so too; along is off by lost.
        sure = np.maximum(np.abs(along) - lost, 0)
        off = codes.rest[None] * np.sqrt(np.maximum(norm * norm - sure * sure, 0))
        off += (codes.norm + codes.rest)[None] * lost
        off += 1e-9 * norm * codes.norm[None] + 1e-6  # for rounding
        return estimate - off, estimate + off


def kth_largest(values: np.ndarray, k: int) -> np.ndarray:
    """Of every row; -inf where it has fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, -k, axis=1)[:, -k]


class Best:
    """The ``k`` best rows met so far, for each of ``n`` places."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(n)]
        self.floor = np.full(n, -np.inf)  # the k-th best score so far

    def add(self, place: int, ids: np.ndarray, scores: np.ndarray) -> None:
        if not len(ids):
            return
        ids = np.concatenate([self.found[place][0], ids])
        scores = np.concatenate([self.found[place][1], scores])
        best = np.lexsort((ids, -scores))[: self.k]
        self.found[place] = ids[best], scores[best]
        if len(best) == self.k:
            self.floor[place] = max(self.floor[place], scores[best[-1]])

    def columns(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place, id and score of all that were found."""
        counts = [len(ids) for ids, _ in self.found]
        places = np.repeat(np.arange(len(counts)), counts)
        ids = [ids for ids, _ in self.found] or [np.zeros(0, np.int64)]
        scores = [s for _, s in self.found] or [np.zeros(0, np.int64)]
        return places, np.concatenate(ids), np.concatenate(scores)


@dataclass
class Batch:
    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    codes: Codes


class Block:
    """A block of anchors with what it looks for."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, turn: np.ndarray, k: int):
        self.ids, self.labels, self.x, self.k = ids, labels, x, k
        self.anchors = Anchors(x, turn)
        self.scored, self.met = 0, 0

    def scores(self, rows: np.ndarray, batch: Batch, columns: np.ndarray) -> np.ndarray:
        """Whole-number scores of pairs, a bounded number at a time."""
        out, most = np.zeros(len(rows), np.int64), max(1, NUMBERS // max(1, self.x.shape[1]))
        for at in range(0, len(rows), most):
            r, c = rows[at : at + most], columns[at : at + most]
            out[at : at + most] = np.einsum("nd,nd->n", self.x[r], batch.x[c])
        return out

    def _groups(self, batch: Batch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Anchors' places, whether labels agree, and the ends of the intervals."""
        for at in range(0, len(self.ids), GROUP):
            group = slice(at, min(at + GROUP, len(self.ids)))
            same = self.labels[group, None] == batch.labels[None]
            yield np.arange(group.start, group.stop), same, *self.anchors.intervals(group, batch.codes)

    def _survivors(self, group: np.ndarray, batch: Batch, wanted: np.ndarray):
        """Place of the anchor, candidates' ids and scores, for each anchor that has any."""
        rows, columns = np.nonzero(wanted)
        scores = self.scores(group[rows], batch, columns)
        self.scored, self.met = self.scored + len(rows), self.met + wanted.size
        ends = np.searchsorted(rows, np.arange(len(group) + 1))
        for i, (a, b) in enumerate(zip(ends, ends[1:])):
            if b > a:
                yield group[i], batch.ids[columns[a:b]], scores[a:b]


class Positives(Block):
    """The best other rows of an anchor's label."""

    def __init__(self, *anchors, k: int):
        super().__init__(*anchors, k)
        self.best = Best(len(self.ids), k)

    def meet(self, batch: Batch) -> None:
        for group, same, low, high in self._groups(batch):
            fit = same & (self.ids[group, None] != batch.ids[None])
            floor = np.maximum(self.best.floor[group], kth_largest(np.where(fit, low, -np.inf), self.k))
            for place, ids, scores in self._survivors(group, batch, fit & (high >= floor[:, None])):
                self.best.add(place, ids, scores)

    def results(self) -> tuple[np.ndarray, ...]:
        places, ids, scores = self.best.columns()
        return self.ids[places], ids, scores


class Negatives(Block):
    """For each positive the best rows of other labels within its window."""

    def __init__(
        self, *anchors, k: int, positives: np.ndarray, scores: np.ndarray, has: np.ndarray, least_pct: int
    ):
        super().__init__(*anchors, k)
        # One column per positive; those that are missing have no window.
        self.positives, self.wanted, self.has, self.least_pct = positives, scores, has, least_pct
        self.best = Best(positives.size, k)

    def meet(self, batch: Batch) -> None:
        width = self.positives.shape[1]
        for group, same, low, high in self._groups(batch):
            other, needed = ~same, np.zeros(same.shape, bool)
            for j in range(width):
                top = np.where(self.has[group, j], self.wanted[group, j].astype(float), np.nan)[:, None]
                least = top * self.least_pct / 100
                inside = np.where(other & (low >= least) & (high <= top), low, -np.inf)
                floor = np.maximum(self.best.floor[group * width + j], kth_largest(inside, self.k))
                reach = np.fmax(least, floor[:, None])
                needed |= other & (high >= reach - 1e-6) & (low <= top)
            for place, ids, scores in self._survivors(group, batch, needed):
                for j in np.flatnonzero(self.has[place]):
                    top = self.wanted[place, j]
                    fit = (self.least_pct * top <= 100 * scores) & (scores <= top)
                    self.best.add(place * width + j, ids[fit], scores[fit])

    def results(self) -> tuple[np.ndarray, ...]:
        places, ids, scores = self.best.columns()
        anchor, j = np.divmod(places, max(1, self.positives.shape[1]))
        return self.ids[anchor], self.positives[anchor, j], ids, self.wanted[anchor, j], scores


def with_codes(rows: DataFrame, width: int, levels: int) -> DataFrame:
    """``rows`` (id, label, x) with their codes as stored columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(width)
        for batch in slices(batches, BATCH):
            codes = Codes.of(matrix(batch.column(2), width), turn, levels)
            flat = codes.words.reshape(batch.num_rows, -1)
            columns = [
                *batch.columns,
                pa.array([w.tobytes() for w in flat], pa.binary()),
                pa.array(list(codes.align), pa.list_(pa.float64())),
                pa.array(codes.rest),
                pa.array(codes.norm),
            ]
            names = [*batch.schema.names, "code", "align", "rest", "norm"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(
        run, "id long, label long, x array<long>, code binary, align array<double>, rest double, norm double"
    )


def _batches(batches: Iterator[pa.RecordBatch], width: int, levels: int) -> Iterator[Batch]:
    for batch in slices(batches, BATCH):
        if not batch.num_rows:
            continue
        ids, labels, x, code, align, rest, norm = batch.columns
        words = np.frombuffer(b"".join(code.to_pylist()), np.uint64).reshape(batch.num_rows, levels, -1)
        alignments = align.flatten().to_numpy().reshape(-1, levels)
        codes = Codes(words, alignments, rest.to_numpy(), norm.to_numpy())
        yield Batch(ids.to_numpy(), labels.to_numpy(), matrix(x, width), codes)


def _search(
    vectors: DataFrame, make: Callable[[], Block], width: int, levels: int, names: list[str]
) -> DataFrame:
    """What a block finds in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for batch in _batches(batches, width, levels):
            block = block or make()
            block.meet(batch)
        if block is not None:
            found = [pa.array(c, pa.int64()) for c in block.results()]
            yield pa.RecordBatch.from_arrays(found, names=names)

    return vectors.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _first(df: DataFrame, by: list[str], score: str, key: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), key)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine_negatives(
    df: DataFrame,
    is_anchor: Column,
    label: Column | str = "label",
    key: str = "vec_id",
    vector: str = "embedding",
    scale: float = 256.0,
    n_positives: int = 5,
    n_negatives: int = 5,
    least_pct: int = 80,
    levels: int = LEVELS,
    block: int = 4096,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores.

    Components are floored multiples of 1 / ``scale``; scores are whole inner
    products with the anchor; higher ones come first, ties by smaller key. An
    anchor's positives are its ``n_positives`` first other rows of its label. For
    each, its negatives are the ``n_negatives`` first rows of another label whose
    score is at most the positive's and at least ``least_pct`` percent of it (so
    none, where the positive's is below 0). An anchor without positives, and a
    positive without negatives, gives no rows.

    Rows without key, label or vector, or whose vector holds a null or non-finite
    component, take no part. A key that repeats counts once, with its least label
    and vector; shorter vectors are continued with zeros. Other columns may have
    any names. An empty table gives no rows. Scores beyond a long wrap.

    ``levels`` one-bit codes a vector decide how much is scored, never what is
    found. At most ``block`` anchors are on the driver or broadcast at a time.
    """
    spark = df.sparkSession
    label = F.col(f"`{label}`") if isinstance(label, str) else label
    rows = (
        df.select(
            F.col(f"`{key}`").cast("bigint").alias("id"),
            label.cast("bigint").alias("label"),
            whole_numbers(F.col(f"`{vector}`"), scale).alias("x"),
            is_anchor.alias("asks"),
        )
        .dropna(subset=["id", "label", "x"])
        .groupBy("id")
        .agg(F.min(F.struct("label", "x")).alias("r"), F.bool_or("asks").alias("asks"))
        .select("id", "r.label", "r.x", "asks")
    )
    plain = staged(rows, "vectors")
    width = max(1, plain.agg(F.max(F.size("x"))).first()[0] or 1)
    vectors = staged(with_codes(plain.select("id", "label", "x"), width, levels), "codes")
    asked = plain.where("asks").select("id", "label", "x")
    out = scratch_path(spark, "negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    written = False
    for mine in query_blocks(asked, block):
        found = mine.toArrow().combine_chunks()
        if not found.num_rows:
            continue
        ids, labels = found["id"].to_numpy(), found["label"].to_numpy()
        shared = spark.sparkContext.broadcast((ids, labels, matrix(found["x"].combine_chunks(), width)))

        def positives(shared=shared) -> Block:
            return Positives(*shared.value, rotation(width), k=n_positives)

        names = ["anchor_id", "positive_id", "positive_score"]
        best = _search(vectors, positives, width, levels, names)
        best = _first(best, ["anchor_id"], "positive_score", "positive_id", n_positives).toArrow()
        # At most n_positives rows for each anchor of the block.
        place = {a: i for i, a in enumerate(ids.tolist())}
        known = np.full((len(ids), n_positives), -1, np.int64)
        scores = np.zeros((len(ids), n_positives), np.int64)
        has = np.zeros((len(ids), n_positives), bool)
        for a, p, s, r in zip(*[best[c].to_pylist() for c in (*names, "rank")]):
            i = place[a], r - 1
            known[i], scores[i], has[i] = p, s, True
        goals = spark.sparkContext.broadcast((known, scores, has))

        def negatives(shared=shared, goals=goals) -> Block:
            known, scores, has = goals.value
            return Negatives(
                *shared.value,
                rotation(width),
                k=n_negatives,
                positives=known,
                scores=scores,
                has=has,
                least_pct=least_pct,
            )

        names = ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"]
        best = _search(vectors, negatives, width, levels, names)
        best = _first(best, ["anchor_id", "positive_id", "positive_score"], "negative_score", "negative_id", n_negatives)
        best.select(*[c.split()[0] for c in schema.split(", ")]).write.mode("append").parquet(out)
        written = True
        # Written, so the block is not needed again.
        shared.destroy()
        goals.destroy()
    return spark.read.schema(schema).parquet(out) if written else spark.createDataFrame([], schema)
