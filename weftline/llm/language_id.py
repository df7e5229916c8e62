"""Language identification: known words first, then shorter and shorter n-grams.

A word that was learned scores by its log frequency in each language. An unseen
word is looked up by its character n-grams: the longest order of which any is
known decides. Word counts come from all training rows, combined inside tasks;
n-gram counts from the distinct words. All counts are kept, in stored tables.
The most frequent words over all languages together are broadcast too, each
with its counts in every language: they are scored where the text is read, and
the other words of the documents by joins with the tables. So the size of the
broadcast part decides how many words are joined, and no result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.arrow import add_columns, let_go
from weftline.session import staged

LETTERS = re.compile(r"[^\W\d_]+")
ORDERS = (5, 4, 3, 2, 1)
UNKNOWN = "und"
CALM = 20  # a text counts as so many words at most in the score
FINE = 2.0**18  # log frequencies are whole multiples of 1 / FINE, so sums are exact in any order
MOST_HELD = 200_000  # counters that a task holds before it gives them away


def letter_words(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def grams(word: str, order: int) -> list[str]:
    padded = f"<{word}>"
    return [padded[i : i + order] for i in range(len(padded) - order + 1)]


def _counted(items: Iterator[tuple[str, list[str]]]) -> Iterator[pa.RecordBatch]:
    """(lang, entry, n) of what ``items`` lists, given away in parts."""
    let_go()
    counted: dict[str, Counter] = {}

    def give() -> pa.RecordBatch:
        rows = [(lang, e, n) for lang, c in counted.items() for e, n in c.items()]
        counted.clear()
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())],
            names=["lang", "entry", "n"],
        )

    for lang, entries in items:
        counted.setdefault(lang, Counter()).update(entries)
        if sum(map(len, counted.values())) > MOST_HELD:
            yield give()
    yield give()


def count_words(df: DataFrame, lang: str, text: str) -> DataFrame:
    """(lang, entry, n) over all rows with both columns."""
    rows = df.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text")).dropna()

    def run(batches):
        yield from _counted(
            (lang, letter_words(text))
            for b in batches
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
        )

    return rows.mapInArrow(run, "lang string, entry string, n long").groupBy("lang", "entry").agg(F.sum("n").alias("n"))


def count_grams(words: DataFrame) -> DataFrame:
    """(lang, entry, n): in how many distinct words each n-gram stands how often."""

    def run(batches):
        yield from _counted(
            (lang, [g for order in ORDERS for g in grams(word, order)])
            for b in batches
            for lang, word in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
        )

    # The stored words lie in few files; their n-grams are many times as many.
    n_parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = words.repartition(n_parts, "entry")
    return dealt.mapInArrow(run, "lang string, entry string, n long").groupBy("lang", "entry").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, capacity: int, group: Column) -> DataFrame:
    """The most frequent entries per language and group, ``capacity`` in all at most.

    Counts fall into steps of a sixteenth of a doubling. Every group is cut at
    a step, found from the number of entries per step, so no task and no sort
    sees all entries of a language.
    """
    stepped = counts.select(
        "*", group.alias("group"), F.floor(F.log2("n") * 16).cast("int").alias("step")
    )
    sizes = stepped.groupBy("lang", "group", "step").count().collect()
    groups = {(r["lang"], r["group"]) for r in sizes}
    each = capacity // max(1, len(groups))
    cut = {}
    for g in groups:
        room = each
        for step, n in sorted(((r["step"], r["count"]) for r in sizes if (r["lang"], r["group"]) == g), reverse=True):
            if n > room:
                break
            room -= n
            cut[g] = step
    if not cut:
        return stepped.limit(0)
    # One row per language and group.
    cuts = counts.sparkSession.createDataFrame(
        [(lang, group, step) for (lang, group), step in cut.items()], "lang string, group int, cut int"
    )
    return stepped.join(F.broadcast(cuts), ["lang", "group"]).where(F.col("step") >= F.col("cut"))


def log_table(counts: DataFrame, languages: list[str], totals: dict[str, int]) -> DataFrame:
    """(entry, n, v): the count over all languages, and the log frequency in each."""
    entries = counts.groupBy("entry").agg(
        F.sum("n").alias("n"),
        *[F.sum(F.when(F.col("lang") == x, F.col("n")).otherwise(0)).alias(f"n{i}") for i, x in enumerate(languages)],
    )
    # Every entry counts half once more; a whole number of halves is exact.
    extra = 0.5 * entries.count()
    logs = [F.log((F.col(f"n{i}") + 0.5) / (totals.get(x, 0) + extra)) for i, x in enumerate(languages)]
    return entries.select("entry", "n", F.array(*[F.rint(x * FINE) / FINE for x in logs]).cast("array<float>").alias("v"))


class Model:
    """Log frequencies by language.

    The most frequent words are at hand, in ``words``; all words and n-grams are
    in the stored tables ``word_table`` and ``gram_table``.
    """

    word_table: DataFrame | None = None
    gram_table: DataFrame | None = None

    def __init__(self, languages: list[str], words: dict[str, bytes]):
        self.languages, self.words = languages, words

    def __getstate__(self):
        return self.languages, self.words  # tasks have no use for tables

    def __setstate__(self, state):
        self.languages, self.words = state

    def _rows(self, data: bytes) -> np.ndarray:
        return np.frombuffer(data, np.float32).reshape(-1, len(self.languages))

    def scored(self, text: str | None) -> tuple[int, np.ndarray, Counter]:
        """How many words there are, the sum of those at hand, and the others.

        No word if the text has no letter or nothing was learned.
        """
        words = letter_words(text or "")
        # The pattern also lets through a few numerals, such as superscripts.
        if not self.languages or not any(c.isalpha() for w in words for c in w):
            return 0, np.zeros(len(self.languages)), Counter()
        rest: Counter = Counter()
        found = list(map(self.words.get, words))
        if None in found:
            rest.update(w for w, v in zip(words, found) if v is None)
            found = [v for v in found if v is not None]
        return len(words), self._rows(b"".join(found)).sum(0, dtype=float), rest


def learn(df: DataFrame, lang: str = "lang", text: str = "text", max_words: int = 120_000) -> Model:
    """A model of all given rows that have a language and a text.

    ``max_words`` words are at hand at most, on the driver and in every task.
    Languages are counted on the driver and are columns of the model, so they are
    to be names, not free text. Without rows there are no languages.
    """
    words = staged(count_words(df, lang, text), "words")
    totals = {r["lang"]: r["n"] for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    model = Model(languages, {})
    if not languages:
        return model
    all_grams = staged(count_grams(words), "grams")
    gram_totals = {
        r["lang"]: r["n"] for r in all_grams.groupBy("lang").agg(F.sum("n").alias("n")).collect()
    }
    model.word_table = staged(log_table(words, languages, totals), "word_logs")
    model.gram_table = staged(log_table(all_grams, languages, gram_totals), "gram_logs")
    held = most_frequent(model.word_table.withColumn("lang", F.lit("")), max_words, F.lit(0))
    model.words = {r["entry"]: np.array(r["v"], np.float32).tobytes() for r in held.select("entry", "v").collect()}
    return model


def _grams_of(word: Column, order: int) -> Column:
    padded = F.concat(F.lit("<"), word, F.lit(">"))
    last = F.length(padded) - order + 1
    places = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.substring(padded, i, F.lit(order)))


def word_vectors(vocabulary: DataFrame, model: Model) -> DataFrame:
    """(w, v) of those words of which anything is known, from the stored tables."""
    size = len(model.languages)
    known = model.word_table.select(F.col("entry").alias("w"), "v")
    found = vocabulary.join(known, "w")
    left = staged(vocabulary.join(known, "w", "left_anti"), "unseen")
    for order in ORDERS:
        if not left.head(1):
            break
        table = model.gram_table.where(F.length("entry") == order).select("entry", "v")
        sums = (
            left.select("w", F.explode(_grams_of(F.col("w"), order)).alias("entry"))
            .join(table, "entry")
            .groupBy("w")
            .agg(F.count("*").alias("n"), *[F.sum(F.get("v", F.lit(i)).cast("double")).alias(f"s{i}") for i in range(size)])
        )
        means = [F.rint(F.col(f"s{i}") / F.col("n") * FINE) / FINE for i in range(size)]
        new = staged(sums.select("w", F.array(*means).cast("array<float>").alias("v")), "unseen_logs")
        found = found.union(new)
        left = staged(left.join(new.select("w"), "w", "left_anti"), "unseen")
    return found


def held_out(key: Column, folds: int = 5) -> Column:
    """Whether a row is kept from learning; a row without a key always is."""
    return F.coalesce(F.crc32(key.cast("string")) % folds == 0, F.lit(True))


def identify(df: DataFrame, keep: list[str], model: Model, text: str = "text") -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` (0 to 1, how sure).

    Only the text is looked at, all of it, however long. A null text, or one
    without a letter, is ``und`` with score 0, and so is every text if nothing
    could be learned. Equal texts get equal answers; an empty table gives no rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make_parts():
        let_go()
        scored = shared.value.scored

        def work(columns):
            found = [scored(t) for t in columns["text"].to_pylist()]
            return [
                pa.array([n for n, _, _ in found], pa.int64()),
                pa.array([logs.tolist() for _, logs, _ in found], pa.list_(pa.float64())),
                pa.array([list(rest) for _, _, rest in found], pa.list_(pa.string())),
                pa.array([list(rest.values()) for _, _, rest in found], pa.list_(pa.int64())),
            ]

        return work

    # Names of their own, so that kept columns may be called anything.
    kept = ["t" if k == text else f"kept{i}" for i, k in enumerate(keep)]
    plain = df.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{text}`").alias("t"),
        *[F.col(f"`{k}`").alias(c) for c, k in zip(kept, keep) if c != "t"],
    )
    # Where texts are kept, rows are written with their numbers, so that texts
    # need not come back through the workers.
    texts_kept = "t" in kept
    plain = staged(plain, "rows") if texts_kept else plain
    through = ["row"] if texts_kept else ["row", *kept]
    added = "n long, logs array<double>, rest array<string>, times array<long>"
    parts = staged(add_columns(plain, through, {"text": F.col("t")}, added, make_parts), "parts")
    rest = parts.select("row", F.inline(F.arrays_zip(F.col("rest").alias("w"), F.col("times").alias("k"))))
    names = F.array(*[F.lit(x) for x in model.languages]).cast("array<string>")
    size, logs = range(len(model.languages)), F.col("logs")
    if model.languages:
        vectors = staged(word_vectors(staged(rest.select("w").distinct(), "vocabulary"), model), "vectors")
        more = (
            rest.join(vectors, "w")
            .groupBy("row")
            .agg(F.array(*[F.sum(F.col("k") * F.get("v", F.lit(i)).cast("double")) for i in size]).alias("more"))
        )
        parts = parts.join(more, "row", "left")
        calm = F.least(F.lit(1.0), F.lit(float(CALM)) / F.col("n"))
        logs = F.array(*[(F.get("logs", F.lit(i)) + F.coalesce(F.get("more", F.lit(i)), F.lit(0.0))) * calm for i in size])
    likely = F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.array_max("logs")))
    some = F.col("n") > 0
    told = parts.select(*through, "n", F.when(some, logs).alias("logs")).select(
        *through,
        # Ties: the first in order of names.
        F.when(some, F.get(names, (F.array_position("logs", F.array_max("logs")) - 1).cast("int")))
        .otherwise(UNKNOWN)
        .alias("lang_pred"),
        F.when(some, 1 / likely).otherwise(0.0).alias("score"),
    )
    if texts_kept:
        told = plain.join(told, "row")
    return told.select(*[F.col(c).alias(k) for c, k in zip(kept, keep)], "lang_pred", "score")
