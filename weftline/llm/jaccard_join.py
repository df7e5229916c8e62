"""N-gram Jaccard join: a size-aware join of light and heavy sets.

Shingles have one global order, rare ones first: by their counts in a sketch of
fixed size, then by hash. Two sets that reach the threshold share one of their
first ``n - c + 1`` shingles and two of their first ``n - c + 2``, where ``c`` is
the least overlap that a set of ``n`` shingles can link with.

* Light sets enumerate the pairs among the first ``n - c + 2``: many keys, but
  two sets rarely share one by accident.
* Heavy sets post the first ``n - c + 1`` to inverted lists, which are scanned.
  So do the light sets that are large enough to link with a heavy one.

The size that divides them has the least estimated cost over all sets.

Keys that two sets share are all the join works on from there, in one order: those
of few sets first. Two sets that can be a link share so many keys that the first
one has enough of each set's keys after it; they meet only in keys that have.

Whole groups of near copies share keys, so their pairs are not listed: only keys of
a few sets compare every two. In the others each set is first compared with the
key's few heads, links are closed to components, and then only pairs in one key but
in different components are compared. Any link between components is found this
way, so the components are exact. Sets that are equal count as one throughout.

Rows of common keys carry a mark of their set, 256 bits that tell for each of as many
bins whether the set has an odd number of shingles there. Where two marks differ, so
do the sets, so most pairs of a group that is not quite alike never meet.

Before two sets are fetched to be compared, their tallies are: how many of their
shingles fall into each of some bins. The sum of the lesser counts bounds the
intersection, so sets that merely share a passage are let go for a few bytes.

The links themselves come from :func:`jaccard_links`, which compares every pair
that can still be one, also inside a component.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.arrow import Seen, let_go, list_array, slices
from weftline.llm.components import components
from weftline.llm.filters import seen_filters
from weftline.llm.quality_rules import let
from weftline.session import staged

BINS = 20  # the sketch counts shingles by this many leading bits of their hash
SKETCH_BLOCK = 1 << 14
KEY_BITS = 53  # of a posted key; above them one bit for pairs, then the bin's level
STEPS = 16  # levels per doubling of a count: a bin's own noise is then visible
PAIR = np.uint64(1 << KEY_BITS)
HOT_LEVEL = STEPS * 17  # bins with more than 2**17 sets have their keys salted
LARGEST_LIGHT = 64  # pairs of larger sets are never enumerated
COMPARE = 8  # cost of comparing two sets, in posted keys
MARKS = 4  # words of a set's mark
FEW = 8  # sets of a key, up to which every two are compared at once
HEADS = 3
MOST_ROUNDS = 3
BLOCK = 256  # sets of one key that one row's pairs are made with at a time


def _odd(seed: int) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(b"", seed) | 1)


MULTIPLIERS = [_odd(i) for i in range(64)]
SHIFT = np.uint64(31)


def mixed(h: np.ndarray, seed: int) -> np.ndarray:
    h = (h ^ (h >> SHIFT)) * MULTIPLIERS[seed]
    return h ^ (h >> SHIFT)


class Shingler:
    """Sorted hashes of the distinct word shingles of a text."""

    def __init__(self, width: int):
        let_go()
        self.width = width
        self.words = Seen(lambda w: xxhash.xxh64_digest(w))

    def __call__(self, text: str | None) -> np.ndarray:
        # Bytes lower A-Z alone and split at exactly the six ASCII blanks.
        words = (text or "").encode().lower().split()
        hashes = np.frombuffer(b"".join(map(self.words.__getitem__, words)), np.uint64)
        n = len(words)
        if not n:
            return hashes
        used = min(n, self.width)
        total = np.full(n - used + 1, used, np.uint64)
        for k in range(used):
            total += hashes[k : n - used + 1 + k] * MULTIPLIERS[k]
        return np.unique(mixed(total, 40))


def signature(h: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    return tuple(int(mixed(h, seed).sum().astype(np.int64)) for seed in (41, 42))


def tally(h: np.ndarray) -> bytes:
    """Counts of a set's hashes by bin, a byte each, eight hashes to a bin or less.

    Nothing, where a count does not fit a byte: then the tally says nothing.
    """
    size = max(64, 1 << max(0, -(-len(h) // 8) - 1).bit_length())
    counts = np.bincount((h >> np.uint64(8) & np.uint64(size - 1)).astype(np.int64), minlength=size)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else b""


def mark(h: np.ndarray) -> list[int]:
    """By bin whether it has an odd number of the hashes: ``MARKS`` signed words of 64 bins.

    Two marks differ in no more bins than their sets have shingles of their own.
    """
    odd = np.bincount((h >> np.uint64(24) & np.uint64(64 * MARKS - 1)).astype(np.int64), minlength=64 * MARKS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def most_shared(a: bytes, b: bytes) -> int | None:
    """The most that two sets can have in common, None if a tally says nothing."""
    if not a or not b:
        return None
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) != len(y):
        # The bins of the smaller one are those of the larger one, several at a time.
        x, y = (v.reshape(-1, min(len(x), len(y))).sum(0) for v in (x, y))
    return int(np.minimum(x, y).sum())


def least_overlap(n: int, percent: int) -> int:
    """The least intersection with which a set of ``n`` can be linked."""
    return -(-percent * n // 100)


def profiles(documents: DataFrame, width: int) -> DataFrame:
    """Per row: doc_id, n, s1, s2, tally, mark; and per task: the sketch of its shingles' counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, counts = Shingler(width), np.zeros(1 << BINS, np.int64)
        for batch in slices(batches):
            sizes, signs, tallies, marks = [], [], [], []
            for text in batch.column(1).to_pylist():
                h = shingles(text)
                np.add.at(counts, h >> np.uint64(64 - BINS), 1)
                sizes.append(len(h))
                signs.append(signature(h))
                tallies.append(tally(h))
                marks.append(mark(h))
            none = [None] * len(sizes)
            yield rows(batch.column(0), sizes, [a for a, _ in signs], [b for _, b in signs], tallies, marks, none, none)
        for k in range(0, 1 << BINS, SKETCH_BLOCK):
            block = counts[k : k + SKETCH_BLOCK]
            if block.any():
                data = block.astype(np.uint32).tobytes()
                yield rows(pa.array([None], pa.int64()), [None], [None], [None], [None], [None], [k], [data])

    def rows(ids, n, s1, s2, tallies, marks, block, data):
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(n, pa.int32()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
             pa.array(tallies, pa.binary()), pa.array(marks, pa.list_(pa.int64())),
             pa.array(block, pa.int32()), pa.array(data, pa.binary())],
            names=["doc_id", "n", "s1", "s2", "tally", "mark", "block", "counts"],
        )

    return documents.mapInArrow(
        run, "doc_id long, n int, s1 long, s2 long, tally binary, mark array<long>, block int, counts binary"
    )


def merged_sketch(blocks: DataFrame) -> np.ndarray:
    """The sum of all tasks' sketches: ``2**BINS`` counts."""

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = np.frombuffer(data, np.uint32).astype(np.int64)
                total[k] = total[k] + counts if k in total else counts
        for k, counts in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([counts.tobytes()])], names=["block", "counts"]
            )

    whole = np.zeros(1 << BINS, np.int64)
    summed = blocks.repartition("block").mapInArrow(run, "block int, counts binary")
    for k, data in summed.collect():
        whole[k : k + SKETCH_BLOCK] = np.frombuffer(data, np.int64)
    return whole


def light_size(sizes: dict[int, int], sketch: np.ndarray, percent: int) -> int:
    """The largest size of a light set: the boundary of least estimated cost.

    Enumerating costs a posted key per pair. A list costs a posted key, and a
    comparison with every other set expected in it: as many as hold a random
    shingle, from the second moment of the counts.
    """
    n, bins = float(sketch.sum()), float(len(sketch))
    if not n:
        return 0
    second = (float((sketch.astype(float) ** 2).sum()) - n * n / bins) / (1 - 1 / bins)
    others = max(0.0, second / n - 1)

    def cost(boundary: int) -> float:
        total = 0.0
        for size, count in sizes.items():
            first = size - least_overlap(size, percent) + 1
            if size <= boundary:
                total += count * comb(first + 1, 2)
            elif size <= LARGEST_LIGHT:
                total += count * first * (1 + COMPARE * others)
            if least_overlap(boundary + 1, percent) <= size <= boundary:
                total += count * first
        return total

    return min(range(LARGEST_LIGHT + 1), key=cost)


def levels_of(sketch: np.ndarray) -> np.ndarray:
    """``STEPS`` levels per doubling of the count."""
    return np.floor(STEPS * np.log2(np.maximum(sketch, 1))).astype(np.uint64)


def posted_keys(h: np.ndarray, levels: np.ndarray, boundary: int, percent: int) -> np.ndarray:
    """The keys under which a set is found, of both kinds."""
    n, low = len(h), np.uint64((1 << KEY_BITS) - 1)
    level = levels[h >> np.uint64(64 - BINS)]
    order = np.sort(level << np.uint64(KEY_BITS + 1) | h & low)
    c = least_overlap(n, percent)
    keys = []
    if n <= boundary and c >= 2:
        i, j = np.triu_indices(n - c + 2, 1)
        # The rarer shingle bounds how often a pair occurs, and it comes first.
        pair = mixed(order[i] * MULTIPLIERS[43] + order[j], 44) & low
        keys.append(order[i] & ~low | PAIR | pair)
    if n >= least_overlap(boundary + 1, percent):
        keys.append(order[: n - c + 1])
    return np.concatenate(keys) if keys else order[:0]


def postings(
    documents: DataFrame, width: int, percent: int, levels: np.ndarray, boundary: int
) -> DataFrame:
    """(key, salt, s1) of every set with a word."""
    shared = documents.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, level_of = Shingler(width), shared.value
        posted = Seen(lambda _: b"")  # sets of this task; equal ones post once
        for batch in slices(batches, 500):
            keys, signs = [], []
            for text in batch.column(0).to_pylist():
                h = shingles(text)
                if not len(h):
                    continue
                s1, s2 = signature(h)
                if (name := f"{s1} {s2}") in posted:
                    continue
                posted[name]
                keys.append(posted_keys(h, level_of, boundary, percent))
                signs.append(np.full(len(keys[-1]), s1, np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(signs))],
                    names=["key", "s1"],
                )

    level = F.shiftrightunsigned("key", KEY_BITS + 1)
    parts = F.pow(F.lit(2.0), (level - HOT_LEVEL) / STEPS).cast("bigint")
    salt = F.when(level > HOT_LEVEL, F.pmod("s1", parts) + 1).otherwise(F.lit(0))
    return documents.select("text").mapInArrow(run, "key long, s1 long").withColumn("salt", salt)


def shared_postings(posted: DataFrame) -> DataFrame:
    """(key, s1), each once, where a second set has the key; of salted keys, all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last row waits for the next batch, with whether it is to be kept.
        key, sign, salt = (np.zeros(0, np.int64) for _ in range(3))
        keep_first = False
        for batch in batches:
            new = [batch.column(i).to_numpy() for i in range(3)]
            key, sign, salt = (np.concatenate(x) for x in zip((key, sign, salt), new))
            if not len(key):
                continue
            same = (key[1:] == key[:-1]) & (salt[1:] == salt[:-1])
            # A set that several tasks have posted is one.
            first = np.concatenate(([True], ~(same & (sign[1:] == sign[:-1]))))
            key, sign, salt = key[first], sign[first], salt[first]
            same = (key[1:] == key[:-1]) & (salt[1:] == salt[:-1])
            keep = salt > 0
            keep[1:] |= same
            keep[:-1] |= same
            keep[0] |= keep_first
            out = np.flatnonzero(keep[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[out]), pa.array(sign[out])], names=["key", "s1"]
            )
            keep_first = bool(keep[-1])
            key, sign, salt = key[-1:], sign[-1:], salt[-1:]
        if keep_first:
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(sign)], names=["key", "s1"])

    dealt = posted.select("key", "s1", F.col("salt").cast("bigint")).repartition("key", "salt")
    return dealt.sortWithinPartitions("key", "salt", "s1").mapInArrow(run, "key long, s1 long")


def rows_of(pairs: DataFrame, bits: int) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    """Cuts batches down to rows whose first column is in one of the pairs (a, b).

    By a filter of a fixed size, so other rows need not be moved; the few that it
    lets through are joined by nothing.
    """

    def id_hashes(ids: np.ndarray) -> np.ndarray:
        h = ids.astype(np.int64).view(np.uint64)
        return np.stack([mixed(h, 45), mixed(h, 46)], axis=1)

    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield id_hashes(batch.column(0).to_numpy())

    # A filter asks for nothing once, so vertices of several pairs need not be told from others.
    vertices = pairs.select(F.explode(F.array("a", "b")).alias("v"))
    wanted, _ = seen_filters(vertices, hashes, bits)
    return lambda batch: batch.take(pa.array(np.flatnonzero(wanted.has(id_hashes(batch.column(0).to_numpy())))))


def sets_of(documents: DataFrame, pairs: DataFrame, width: int, bits: int) -> DataFrame:
    """(v, n, h array<long>): the shingles of the texts in the pairs (a, b), and of a few others."""
    cut = rows_of(pairs, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(width)
        for batch in map(cut, slices(batches)):
            found = [shingles(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(h) for h in found], pa.int32()),
                 list_array([h.view(np.int64) for h in found], pa.int64())],
                names=["v", "n", "h"],
            )

    return documents.where("doc_id is not null").mapInArrow(run, "v long, n int, h array<long>")


def close_pairs(pairs: DataFrame, tallies: DataFrame, percent: int, bits: int) -> DataFrame:
    """The pairs (a, b) whose tallies (v, n, tally) allow a link."""
    cut = rows_of(pairs, bits)
    tallies = tallies.select("v", "n", "tally")
    # Written, so that no task has a Python worker for this and one for what follows.
    few = staged(tallies.mapInArrow(lambda batches: map(cut, batches), tallies.schema), "tallies")

    def side(name: str) -> DataFrame:
        return few.select(
            F.col("v").alias(name), F.col("n").alias(f"n{name}"), F.col("tally").alias(f"t{name}")
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for row, (n, m, x, y) in enumerate(zip(*[c.to_pylist() for c in batch.columns[2:]])):
                both = most_shared(x, y)
                if both is None or 100 * both >= percent * (n + m - both):
                    rows.append(row)
            found = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(found.columns[:2], names=["a", "b"])

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "ta", "tb")
    return both.mapInArrow(run, "a long, b long").distinct()


def linked(
    pairs: DataFrame, tallies: DataFrame, documents: DataFrame, width: int, percent: int, bits: int
) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold."""
    pairs = staged(close_pairs(pairs, tallies, percent, bits), "close")
    sets = staged(sets_of(documents, pairs, width, bits), "sets")

    def side(name: str) -> DataFrame:
        return sets.select(
            F.col("v").alias(name), F.col("n").alias(f"n{name}"), F.col("h").alias(f"h{name}")
        )

    both = F.size(F.array_intersect("ha", "hb"))
    return (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .where(100 * both >= percent * (F.col("na") + F.col("nb") - both))
        .select("a", "b")
    )


def likely(met: DataFrame, percent: int) -> DataFrame:
    """(a, b) of those (key, x, y) meetings that can still be links.

    The set whose posted shingles end first in the order shares, beyond them,
    no more than the ``c - 1`` shingles it has left. So the two must meet in as
    many keys as are then missing from the intersection that both sizes ask
    for. Pairs of shingles, which only light sets post, are always followed up.
    """
    first, second = F.least("x", "y"), F.greatest("x", "y")
    n, m = F.col("first.n"), F.col("second.n")
    return (
        met.select("key", first.alias("first"), second.alias("second"), _of_pair(F.col("key")).alias("pair"))
        .where((F.col("first.v") != F.col("second.v")) & _comparable(n, m, percent))
        .groupBy("first", "second")
        .agg(F.sum(1 - F.col("pair")).alias("keys"), F.max("pair").alias("pair"))
        .where((F.col("pair") > 0) | (F.col("keys") >= _keys_needed(n, m, percent)))
        .select(F.col("first.v").alias("a"), F.col("second.v").alias("b"))
    )


def _of_pair(key: Column) -> Column:
    """1 for the key of a pair of shingles, else 0."""
    return F.shiftrightunsigned(key, KEY_BITS).bitwiseAND(F.lit(1)).cast("int")


def _comparable(n: Column, m: Column, percent: int) -> Column:
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _keys_needed(n: Column, m: Column, percent: int) -> Column:
    # The sizes as whole numbers: ceil(a / b) is -floor(-a / b).
    asked = -F.floor(-percent * (n + m) / (100 + percent) + 1e-9)
    return asked + F.floor(-percent * F.greatest(n, m) / 100 + 1e-9) + 1


def still_apart(open_rows: DataFrame, percent: int) -> DataFrame:
    """(a, b): sets in different components that can still be links, by all their meetings.

    The join takes :func:`first_meetings`, which needs one meeting of two sets and
    finds all of these pairs; tests hold it against this. A row carries the key's place among its set's keys and how many follow, not
    the keys: two sets share no more keys before a place, and after it, than the
    lesser of the two has there. Meetings that this does not rule out are counted
    (see :func:`likely`).
    """
    whole = Window.partitionBy("x")
    rows = open_rows.select("key", "x", "c").withColumns(
        {"before": F.row_number().over(whole.orderBy("key")) - 1, "k": F.count("*").over(whole).cast("int")}
    )
    rows = rows.withColumn("after", F.col("k") - F.col("before") - 1).drop("k")
    # Both sides have the same columns in the same order, so one shuffle serves both.
    others = rows.select("key", *[F.col(n).alias(f"{n}2") for n in ("x", "c", "before", "after")])
    most = F.least("before", "before2") + 1 + F.least("after", "after2")
    often = most >= _keys_needed(F.col("x.n"), F.col("x2.n"), percent)
    apart = (F.col("x.v") < F.col("x2.v")) & (F.col("c") != F.col("c2"))
    apart &= _comparable(F.col("x.n"), F.col("x2.n"), percent) & (often | (_of_pair(F.col("key")) > 0))
    return likely(rows.join(others, "key").where(apart).select("key", "x", F.col("x2").alias("y")), percent)


def placed_keys(meeting: DataFrame) -> DataFrame:
    """(key, x, sets, after): how many sets have the key, and where it stands in its set.

    The keys of a set have one order, those of few sets first; ``after`` counts the
    set's keys of the same kind that follow. Sets that share an id count as one,
    which only lets more pairs meet.
    """
    sets = meeting.groupBy("key").agg(F.count("*").alias("sets"))
    backwards = Window.partitionBy("v", "pair").orderBy(F.desc("sets"), F.desc("key"))
    return (
        meeting.join(sets, "key")
        .withColumn("pair", _of_pair(F.col("key")))
        .select("key", F.struct("v", "n").alias("x"), "sets", (F.row_number().over(backwards) - 1).alias("after"))
    )


def _first_shared(x: Column, y: Column, percent: int, marked: bool) -> Column:
    """Whether ``key`` can be the first one that the linked sets ``x`` and ``y`` share.

    Both are (v, n, after[, mark]). All keys that they share besides are after it
    in both. How many they share at least is told by :func:`_keys_needed`; sets
    that post pairs of shingles share one shingle more there, and all its pairs.
    """
    asked = _keys_needed(x["n"], y["n"], percent)
    asked = F.when(_of_pair(F.col("key")) > 0, asked * (asked + 1) / 2).otherwise(asked)
    can = _comparable(x["n"], y["n"], percent) & (F.least(x["after"], y["after"]) + 1 >= asked)
    if not marked:
        return can
    apart = [F.bit_count(x["mark"][k].bitwiseXOR(y["mark"][k])) for k in range(MARKS)]
    # Of n + m shingles, an intersection of a share of their union leaves so many out.
    return can & ((100 + percent) * sum(apart[1:], apart[0]) <= (100 - percent) * (x["n"] + y["n"]))


def _met(rows: DataFrame) -> tuple[DataFrame, bool]:
    """(key, x, c) with all that a meeting looks at in ``x``; whether that has marks."""
    marks = [c for c in ("mark",) if c in rows.columns]
    return rows.select("key", F.struct("x.v", "x.n", "after", *marks).alias("x"), "c"), bool(marks)


def first_meetings(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b): sets of (key, x, after, c[, mark]), in different components, that can be links by their first key."""
    rows, marked = _met(rows)
    # Both sides have the same columns in the same order, so one shuffle serves both.
    others = rows.select("key", F.col("x").alias("y"), F.col("c").alias("d"))
    x, y = F.col("x"), F.col("y")
    apart = (x["v"] < y["v"]) & (F.col("c") != F.col("d")) & _first_shared(x, y, percent, marked)
    return rows.join(others, "key").where(apart).select(F.col("x.v").alias("a"), F.col("y.v").alias("b")).distinct()


def _head_meetings(rows: DataFrame, turn: int, percent: int) -> DataFrame:
    """(a, b): sets of (key, x, after, c[, mark]) and the heads of their keys, where these can be links."""
    rows, marked = _met(rows)
    seeds = range(turn * HEADS, (turn + 1) * HEADS)
    heads = rows.groupBy("key").agg(
        *[F.min(F.struct(F.xxhash64("x.v", F.lit(k)), "x", "c")).alias(f"head{k}") for k in seeds]
    )
    chosen = F.array_distinct(F.array(*[F.struct(f"head{k}.x", f"head{k}.c") for k in seeds]))
    # Those that a set cannot link with are dropped before there is a row for each.
    can = F.filter(chosen, lambda h: (F.col("c") != h["c"]) & _first_shared(F.col("x"), h["x"], percent, marked))
    met = rows.join(heads, "key").select("x", F.explode(can).alias("head"))
    v, w = F.col("x.v"), F.col("head.x.v")
    return met.select(F.least(v, w).alias("a"), F.greatest(v, w).alias("b")).distinct()


def _rows_with(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    """(key, x, after, c[, mark]): rows (key, x, after[, mark]) with the components of their sets."""
    columns = [c for c in ("key", "x", "after", "mark") if c in rows.columns]
    rows = rows.select(*columns, F.col("x.v").alias("v"))
    if roots is None:
        return rows.withColumnRenamed("v", "c")
    return rows.join(roots, "v", "left").select(*columns, F.coalesce("component", "v").alias("c"))


def _pairs_apart(rows: DataFrame) -> DataFrame:
    """(key, pairs): keys whose rows (key, c) are of several components, and their pairs apart.

    These are all pairs without those inside a component.
    """
    n = F.col("count").cast("double")
    inside = rows.groupBy("key", "c").count()
    return inside.groupBy("key").agg(((F.sum(n) ** 2 - F.sum(n * n)) / 2).alias("pairs")).where("pairs > 0")


def _close_groups(
    placed: DataFrame, tallies: DataFrame, documents: DataFrame, width: int, percent: int, bits: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Compare the sets of keys that few have, and those of others with the heads.

    Returns the pairs compared, the components, and the rows of :func:`_rows_with`
    whose keys join several of them. A key's heads are its sets with the smallest hashes, others in
    each round. Only sets outside a head's component meet it, so a round costs a
    few pairs per posting, and a group of near copies falls into few components
    after a few rounds. They end when the pairs that are still apart are no more
    than the postings, or a later round has linked nothing new or has closed less
    than a quarter of those pairs: texts that only share a passage stay apart.
    """
    tried = links = None
    # Sets that share an id and a size have a row each; then either may meet.
    marks = tallies.select(F.struct("v", "n").alias("x"), "mark").distinct()
    common = staged(placed.where(F.col("sets") > FEW).join(marks, "x"), "common")
    rows, size, before = _rows_with(common, None), placed.count(), None
    for turn in range(MOST_ROUNDS):
        new = _head_meetings(rows, turn, percent)
        if tried is None:
            every = _rows_with(placed.where(F.col("sets") <= FEW), None)
            new = new.union(first_meetings(every, percent)).distinct()
        else:
            new = new.join(tried, ["a", "b"], "left_anti")
        new = staged(new, "tried")
        found = staged(linked(new, tallies, documents, width, percent, bits), "found")
        tried = new if tried is None else tried.union(new)
        links = found if links is None else links.union(found)
        if turn and not found.head(1):
            break
        roots = staged(components(links), "components")
        # Written before they are looked at twice; a closed key stays closed.
        located = staged(_rows_with(rows, roots), "located")
        several = staged(_pairs_apart(located), "several")
        rows = staged(located.join(several.select("key"), "key"), "open")
        apart = several.agg(F.sum("pairs")).first()[0] or 0
        if apart <= size or before is not None and 4 * apart > 3 * before:
            break
        before = apart
    return tried, roots, rows


def _distinct_sets(documents: DataFrame, width: int) -> DataFrame:
    """(v, n, h): every distinct set of shingles, named by its signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, posted = Shingler(width), Seen(lambda _: b"")
        for batch in slices(batches):
            signs, found = [], []
            for h in map(shingles, batch.column(0).to_pylist()):
                if not len(h) or (name := str(s1 := signature(h)[0])) in posted:
                    continue
                posted[name]
                signs.append(s1)
                found.append(h)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signs, pa.int64()), pa.array([len(h) for h in found], pa.int32()),
                 list_array([h.view(np.int64) for h in found], pa.int64())],
                names=["v", "n", "h"],
            )

    return documents.select("text").mapInArrow(run, "v long, n int, h array<long>").dropDuplicates(["v"])


def candidates(meeting: DataFrame, percent: int) -> DataFrame:
    """(a, b): every two sets of (key, v, n) that can be a link, once, a < b.

    The sets of a key are dealt to blocks, and every two blocks meet by
    themselves, so a key with many sets is spread over many tasks.
    """
    keys = meeting.groupBy("v").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    blocks = meeting.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).alias("m"))
    rows = meeting.join(blocks, "key").join(keys, "v").withColumn("p", F.pmod(F.xxhash64("v", F.lit(1)), "m"))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("m") - 1))
    left = rows.select("key", F.col("p"), every.alias("q"), F.col("v").alias("a"), F.col("n").alias("na"), F.col("keys").alias("ka"))
    right = rows.select("key", every.alias("p"), F.col("p").alias("q"), F.col("v").alias("b"), F.col("n").alias("nb"), F.col("keys").alias("kb"))

    def both(common: Column) -> Column:
        often = F.size(common) >= _keys_needed(F.col("na"), F.col("nb"), percent)
        return (F.array_min(common) == F.col("key")) & (often | F.exists(common, lambda k: _of_pair(k) > 0))

    near = (F.col("a") < F.col("b")) & _comparable(F.col("na"), F.col("nb"), percent)
    return left.join(right, ["key", "p", "q"]).where(near & let(F.array_intersect("ka", "kb"), both)).select("a", "b")


def jaccard_links(
    df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80
) -> tuple[DataFrame, DataFrame]:
    """All links between different sets, and the set of every row.

    The links (a, b, n_a, n_b, n_shared) name two sets, a < b, each pair once;
    the rows are ``doc_id``, ``set_id`` and ``n_links``, how many other sets
    theirs is linked with. Rows with equal sets share a ``set_id`` and so all
    links; a row without a word has a null one and no link. Nothing is asked of
    the key: it may be null or repeated. 64 bits tell sets apart.
    """
    documents = df.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    first = staged(profiles(documents, width), "profiles")
    sketch = merged_sketch(first.where("block is not null").select("block", "counts"))
    sizes = first.where("block is null").where(F.col("n").between(1, LARGEST_LIGHT)).groupBy("n").count().collect()
    boundary = light_size({r["n"]: r["count"] for r in sizes}, sketch, percent)
    posted = postings(documents, width, percent, levels_of(sketch), boundary)
    sizes_of = first.where("n > 0").select(F.col("s1").alias("v"), "n").distinct()
    meeting = staged(
        shared_postings(posted).select("key", F.col("s1").alias("v")).distinct().join(sizes_of, "v"), "meeting"
    )
    pairs = staged(candidates(meeting.select("key", "v", "n"), percent), "candidates")
    sets = staged(_distinct_sets(documents, width), "sets")
    a, b = (sets.select(F.col("v").alias(x), F.col("n").alias(f"n_{x}"), F.col("h").alias(f"h{x}")) for x in "ab")
    shared = F.size(F.array_intersect("ha", "hb"))
    links = staged(
        pairs.join(a, "a")
        .join(b, "b")
        .select("a", "b", "n_a", "n_b", shared.alias("n_shared"))
        .where(100 * F.col("n_shared") >= percent * (F.col("n_a") + F.col("n_b") - F.col("n_shared"))),
        "links",
    )
    degrees = links.select(F.explode(F.array("a", "b")).alias("set_id")).groupBy("set_id").agg(F.count("*").alias("n_links"))
    rows = first.where("block is null").select("doc_id", F.when(F.col("n") > 0, F.col("s1")).alias("set_id"))
    return links, rows.join(degrees, "set_id", "left").select("doc_id", "set_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def jaccard_components(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 80,
    bits: int = 1 << 24,
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row.

    Words are runs of anything but the six ASCII blanks, A-Z lowered; a text
    with fewer than ``width`` words is one shingle. Two sets link when their
    intersection is at least ``percent`` of their union; a component is named by
    its smallest key. Null and empty texts have no shingles and are their own
    component. Repeated rows get the same answer; rows that share a key are
    linked through it. A row without a key joins the component of its copies,
    if any, and else has a null one. An empty table gives an empty result.
    """
    documents = df.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    first = staged(profiles(documents, width), "profiles")
    sketch = merged_sketch(first.where("block is not null").select("block", "counts"))
    rows = first.where("block is null").select("doc_id", "n", "s1", "s2")
    sizes = rows.where(F.col("n").between(1, LARGEST_LIGHT)).groupBy("n").count().collect()
    boundary = light_size({r["n"]: r["count"] for r in sizes}, sketch, percent)

    copies = rows.where("n > 0").groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("v"))
    posted = postings(documents, width, percent, levels_of(sketch), boundary)
    # The keys that different sets share.
    meeting = shared_postings(posted).join(copies.where("v is not null"), "s1").select("key", "v", "n")
    placed = staged(placed_keys(staged(meeting, "meeting")), "placed")
    tallies = first.where("n > 0 and doc_id is not null").select(F.col("doc_id").alias("v"), "n", "tally", "mark")
    tried, roots, rows_left = _close_groups(placed, tallies, documents, width, percent, bits)

    rest = staged(first_meetings(rows_left, percent).join(tried, ["a", "b"], "left_anti"), "rest")
    bridges = linked(rest, tallies, documents, width, percent, bits)
    # Links between components, by the components' names.
    for side in ("a", "b"):
        named = roots.select(F.col("v").alias(side), F.col("component").alias("_c"))
        bridges = bridges.join(named, side, "left").withColumn(side, F.coalesce("_c", side)).drop("_c")
    larger = staged(components(bridges), "components")
    joined = larger.select(F.col("v").alias("component"), F.col("component").alias("_larger"))
    final = roots.join(joined, "component", "left").select(
        "v", F.coalesce("_larger", "component").alias("component")
    )
    alone = larger.select("v", "component").join(roots, "v", "left_anti")
    final = final.unionByName(alone)

    of_copies = copies.join(final, "v", "left").select(
        "s1", "s2", "n", F.coalesce("component", "v").alias("component")
    )
    return rows.join(of_copies, ["s1", "s2", "n"], "left").select(
        "doc_id",
        F.col("n").cast("bigint").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
    )
