"""Quality classifier: weak labels by expectation-maximisation, then a linear scorer.

Heuristic labellers vote good, bad or nothing on every document. How often each
combination of votes occurs, over all documents, is a table of at most
3 ** labellers rows; on it, expectation-maximisation estimates how often each
labeller says what about good and bad documents, without any true label. The
posterior of a document's votes is its weak label.

A linear scorer over hashed features then learns these posteriors from a sample
of at most ``sample`` documents, drawn by hashed key, and scores every document.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.arrow import MOST_SEEN, Seen, add_columns, let_go, texts

GOOD, BAD, NOTHING = 2, 0, 1
BUCKETS = 1 << 16
SYMBOLS = frozenset("#*$%&|<>")
SHORT = 5  # letters of a word that can be a common one


def _between(value: float, bad_above: float, good_below: float) -> int:
    return BAD if value > bad_above else GOOD if value < good_below else NOTHING


def short_words(text: str) -> set[str]:
    """The different short words of letters, in small letters."""
    return {w for w in text.lower().split() if len(w) <= SHORT and w.isalpha()}


def common_words(
    df: DataFrame, text: str, least_pct: int = 2, most_words: int = 500
) -> frozenset[str]:
    """Short words that stand in ``least_pct`` percent of all documents, in any language.

    The most frequent come first, ties in order of text; at most ``most_words``
    come to the driver. Documents that repeat count again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        counts: Counter = Counter()

        def give() -> pa.RecordBatch:
            columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

        for batch in batches:
            for t in texts(batch.column(0)):
                counts.update(short_words(t))
                if len(counts) > MOST_SEEN:
                    yield give()
        yield give()

    found = df.select(F.col(f"`{text}`").cast("string")).mapInArrow(run, "word string, n long")
    found = found.groupBy("word").agg(F.sum("n").alias("n"))
    least = max(1, -(-df.count() * least_pct // 100))
    top = found.where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(most_words)
    return frozenset(r["word"] for r in top.collect())


def votes(text: str, frequent: frozenset[str] = frozenset()) -> tuple[int, ...]:
    """What each labeller says; a text without words is bad to all that look at words.

    A text without ``frequent`` words may be of a rare language, so their lack
    says nothing.
    """
    words = text.split()
    n = len(words)
    if not n:
        return (BAD,) * len(LABELLERS)
    counts = Counter(words)
    again = sum(map(str.__eq__, words, words[1:])) / n
    upper = sum(map(str.isupper, words)) / n
    marks = sum(map(text.count, SYMBOLS)) / len(text)
    shouts = text.count("!") / n
    length = sum(map(len, words)) / n
    common = sum(c for w, c in counts.items() if w.lower() in frequent) / n
    top = counts.most_common(1)[0][1] / n
    return (
        BAD if n < 20 else GOOD if n >= 60 else NOTHING,
        _between(again, 0.1, 0.03),
        _between(upper, 0.5, 0.2),
        _between(marks, 0.03, 0.005),
        _between(shouts, 0.3, 0.05),
        _between(abs(length - 6), 4.0, 2.0),
        GOOD if common >= 0.08 else NOTHING,
        _between(top, 0.3, 0.15),
        BAD if n >= 40 and len(counts) / n < 0.3 and again > 0.05 else NOTHING,
    )


LABELLERS = ("long", "stutter", "capitals", "symbols", "shouting", "word_length", "common_words", "one_word", "loop")


def fit_labellers(patterns: dict[tuple[int, ...], int], rounds: int = 100) -> dict[tuple[int, ...], float]:
    """The probability that a document with these votes is good, by pattern.

    Two classes; given the class, votes are independent. It starts at 0.1 where
    any labeller says bad, at 0.5 where none says anything, and else at 0.9. With
    no document there is no pattern.
    """
    if not patterns:
        return {}
    keys = list(patterns)
    votes_of = np.array(keys)
    n = np.array([patterns[k] for k in keys], float)
    one_hot = np.stack([votes_of == v for v in (BAD, NOTHING, GOOD)], axis=2).astype(float)
    cast = (votes_of != NOTHING).sum(1)
    # A single bad vote weighs as much as all good ones: labellers look at different faults.
    good = np.where((votes_of == BAD).any(1), 0.1, 0.9)
    good = np.where(cast == 0, 0.5, good)
    for _ in range(rounds):
        share = (n * good).sum() / n.sum()
        tables = []
        for weight in (n * (1 - good), n * good):
            counts = (weight[:, None, None] * one_hot).sum(0) + 0.1
            tables.append(np.log(counts / counts.sum(1, keepdims=True)))
        prior = np.log([max(1 - share, 1e-6), max(share, 1e-6)])
        logs = [prior[c] + (one_hot * tables[c][None]).sum((1, 2)) for c in (0, 1)]
        new = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
        if np.abs(new - good).max() < 1e-6:
            good = new
            break
        good = new
    return dict(zip(keys, good.tolist()))


def shape(word: str) -> str:
    """The word with runs of capitals, small letters and digits as one letter each."""
    out = []
    for c in word:
        kind = "X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out[:8])


class Features:
    """Bucket numbers of a text's features, one per occurrence."""

    def __init__(self):
        self.of_word = Seen(
            lambda w: np.array(
                [bucket(f"w {w.lower()}"), bucket(f"s {shape(w)}"), bucket(f"n {min(len(w), 20)}")], np.uint32
            ).tobytes()
        )

    def __call__(self, text: str) -> np.ndarray:
        words = text.split()
        ids = np.frombuffer(b"".join(map(self.of_word.__getitem__, words)), np.uint32)
        again = sum(map(str.__eq__, words, words[1:]))
        size = bucket(f"length {len(words).bit_length()}")
        extra = np.full(again, bucket("again"), np.uint32)
        return np.concatenate([ids, extra, np.full(len(words) // 4 + 1, size, np.uint32)])


def bucket(feature: str) -> int:
    return xxhash.xxh32_intdigest(feature) % BUCKETS


def train(rows: list[np.ndarray], goal: np.ndarray, rounds: int = 150, rate: float = 1.0) -> np.ndarray:
    """Weights by bucket, and the bias last, of a logistic fit to soft labels.

    A row's score is the mean weight of its features. Features that a row repeats
    are folded to one entry with their share, once, before the rounds.
    """
    weights = np.zeros(BUCKETS + 1)
    if not rows:
        return weights
    folded = [np.unique(r, return_counts=True) for r in rows]
    at = np.concatenate([buckets for buckets, _ in folded])
    share = np.concatenate([n / n.sum() for _, n in folded])
    row = np.repeat(np.arange(len(rows)), [len(n) for _, n in folded])
    total = np.zeros(BUCKETS + 1)
    for _ in range(rounds):
        score = np.bincount(row, weights[at] * share, len(rows)) + weights[-1]
        error = 1 / (1 + np.exp(-np.clip(score, -50, 50))) - goal
        step = np.append(np.bincount(at, error[row] * share, BUCKETS), error.sum()) / len(rows)
        total += step * step
        weights -= rate * step / np.sqrt(total + 1e-12)
    return weights


def classify(
    df: DataFrame, keep: list[str], key: str = "doc_id", text: str = "text", sample: int = 6000,
    threshold: float = 0.5,
) -> DataFrame:
    """``keep`` columns, ``weak_label`` (posterior of the votes), ``score`` and ``kept``.

    All rows are voted on and scored, over whole texts; only the scorer is fitted
    on a sample. One labeller knows the corpus's own frequent short words, see
    :func:`common_words`. Null and empty texts get bad votes and a score like any
    other, very long ones are judged whole;
    rows are judged by text alone, so repeated rows fare alike, and rows without
    a key are judged but never sampled. An empty table gives no rows.
    """

    frequent = common_words(df, text)

    def judge():
        def work(columns):
            found = [votes(t, frequent) for t in texts(columns["text"])]
            return [pa.array(["".join(map(str, v)) for v in found])]

        return work

    body = {"text": F.col(f"`{text}`")}
    patterns = add_columns(df, [], body, "pattern string", judge).groupBy("pattern").count().collect()
    counts = {tuple(map(int, r["pattern"])): r["count"] for r in patterns}
    good = fit_labellers(counts)
    n = sum(counts.values())

    # Rows by hashed key, then a hard bound; the draw aims a little below it.
    cut = int(2**62 * min(1.0, 0.9 * sample / max(n, 1)))
    drawn = df.where(F.shiftrightunsigned(F.xxhash64(f"`{key}`"), 2) < cut).where(
        F.col(f"`{key}`").isNotNull()
    )
    drawn = drawn.select(F.col(f"`{text}`").alias("text")).limit(sample).repartition(1)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, rows, goal = Features(), [], []
        for batch in batches:
            for t in texts(batch.column(0)):
                rows.append(features(t))
                goal.append(good[votes(t, frequent)])
        weights = train(rows, np.array(goal)).astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()])], names=["weights"])

    found = drawn.mapInArrow(fit, "weights binary").collect()  # one row, none of no rows
    fitted = np.frombuffer(found[0]["weights"]) if found else train([], np.zeros(0))
    shared = df.sparkSession.sparkContext.broadcast((fitted, good))

    def score():
        weights, labels = shared.value
        features = Features()

        def work(columns):
            all_texts = texts(columns["text"])
            raw = np.array([weights[features(t)].mean() + weights[-1] for t in all_texts])
            raw = 1 / (1 + np.exp(-np.clip(raw, -50, 50)))
            label = [labels[votes(t, frequent)] for t in all_texts]
            return [pa.array(label, pa.float64()), pa.array(raw, pa.float64()), pa.array(raw >= threshold)]

        return work

    return add_columns(df, keep, body, "weak_label double, score double, kept boolean", score)
