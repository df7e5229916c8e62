"""Spelling variants: words that differ by one letter, found in a bit-sliced index.

For every position and letter the index has one set of bits over the vocabulary:
the words with that letter there. A word is looked up in as many steps as it has
letters. Each step takes whole sets at a time, and keeps three: the words that
agree so far, those that agree but for one replaced letter, and those that agree
but for one letter more, which are read one position later.

One index over all words would not hold, so they are dealt by what two near words
must share. If the shorter one has ``m`` letters, either its first ``m // 2``
letters stand at the start of both, or its other letters stand at the end of
both. Groups of words that share such a part are cut into blocks of a bounded
number of letters, and every block of a group meets every other as lookups.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.quality_rules import LOWER, UPPER, let
from weftline.session import staged

RUN = r"[A-Za-zÀ-ÿ]+"
BLOCK_LETTERS = 1 << 16  # letters in a block of a group, so in one index
LOOKED_UP, INDEXED = 1, 2
GIVEN = 20_000  # results that a task holds before it gives them away


class PositionIndex:
    """Sets of words, as bits of whole numbers, by position and letter."""

    def __init__(self, words: list[str]):
        self.all = (1 << len(words)) - 1
        self.at: list[dict[str, int]] = [{} for _ in range(max(map(len, words), default=0))]
        self.ends: dict[int, int] = {}
        bit = 1
        for word in words:
            for sets, letter in zip(self.at, word):
                sets[letter] = sets.get(letter, 0) | bit
            self.ends[len(word)] = self.ends.get(len(word), 0) | bit
            bit <<= 1

    def near(self, word: str) -> list[int]:
        """Places of the words with one letter replaced, or one letter more."""
        same, replaced, longer = self.all, 0, self.all
        at, n = self.at, len(self.at)
        for p, letter in enumerate(word):
            here = at[p].get(letter, 0) if p < n else 0
            after = at[p + 1].get(letter, 0) if p + 1 < n else 0
            still = same & here
            replaced = replaced & here | same ^ still
            longer = longer & after | still
            same = still
        m = len(word)
        left = replaced & self.ends.get(m, 0) | longer & self.ends.get(m + 1, 0)
        places = []
        while left:
            low = left & -left
            places.append(low.bit_length() - 1)
            left ^= low
        return places


def counted_words(
    df: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = 6, least: int = 5, slip: int = 199
) -> DataFrame:
    """(word, n): the words of whole texts, A-Z lowered, and how often they occur.

    A word is a run of Latin letters of at least ``shortest`` code points with at
    least ``least`` occurrences. To have variants to find, every occurrence for
    which ``slip`` divides the CRC-32 of key and word loses the letter that the
    CRC-32 names; ``slip=0`` leaves all as they are. Null texts have no words, a
    null key counts as the empty text, rows that repeat count again.
    """
    runs = F.regexp_extract_all(F.translate(F.col(f"`{text}`"), UPPER, LOWER), F.lit(RUN), F.lit(0))
    # A slip only shortens a word, so shorter runs are never words.
    runs = F.filter(runs, lambda w: F.length(w) >= shortest)
    words = df.select(
        F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("k"), F.explode(runs).alias("word")
    )
    if slip:
        h = F.crc32(F.concat("k", F.lit(":"), "word"))
        cut = (h % F.length("word")).cast("int")
        short = F.concat(F.substring("word", F.lit(1), cut), F.substring("word", cut + 2, F.length("word")))
        words = words.select(F.when(h % slip == 0, short).otherwise(F.col("word")).alias("word"))
        words = words.where(F.length("word") >= shortest)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _posted(words: DataFrame) -> DataFrame:
    """(part, m, starts, word, n, letters): each word under the parts that a near word shares.

    ``m`` is the length of the shorter one: that of the word, or one less.
    """

    def of(m: Column) -> list[Column]:
        half = F.floor(m / 2).cast("int")
        start = F.substring("word", F.lit(1), half)
        end = F.substring("word", F.col("letters") - (m - half) + 1, m - half)
        return [
            F.struct(start.alias("part"), m.alias("m"), F.lit(True).alias("starts")),
            F.struct(end.alias("part"), m.alias("m"), F.lit(False).alias("starts")),
        ]

    rows = words.select("word", "n", F.length("word").alias("letters"))
    parts = F.array(*of(F.col("letters")), *of(F.col("letters") - 1))
    return rows.select("word", "n", "letters", F.inline(parts))


def _meetings(posted: DataFrame, block_letters: int) -> DataFrame:
    """Postings with ``index`` and ``lookup`` block, and the ``role`` they have there.

    A group of one block meets itself, in one row per posting.
    """
    group = ["part", "m", "starts"]
    blocks = F.ceil(F.sum("letters") / block_letters).cast("int")
    large = posted.groupBy(*group).agg(blocks.alias("blocks")).where("blocks > 1")
    mine = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    both = F.lit(LOOKED_UP | INDEXED)

    def meet(index: Column, lookup: Column, role: Column) -> Column:
        return F.struct(index.alias("index"), lookup.alias("lookup"), role.alias("role"))

    def all_blocks(block: Column) -> Column:
        others = F.sequence(F.lit(0), F.col("blocks") - 1)
        # Only the shorter words of a group are looked up.
        asked = F.when(
            F.col("letters") == F.col("m"), F.transform(others, lambda j: meet(j, block, F.lit(LOOKED_UP)))
        ).otherwise(F.array().cast("array<struct<index:int,lookup:int,role:int>>"))
        return F.concat(F.transform(others, lambda j: meet(block, j, F.lit(INDEXED))), asked)

    alone = F.array(meet(F.lit(0), F.lit(0), both))
    meetings = F.when(F.col("blocks").isNull(), alone).otherwise(let(mine, all_blocks))
    return posted.join(large, group, "left").select(*group, "word", "n", F.inline(meetings))


def _found(rows: list[tuple]) -> Iterator[tuple[str, str, int]]:
    """(word, near word, its n) both ways, of the postings that meet in one place."""
    (_, m, starts, _, _) = rows[0][:5]
    half = m // 2
    indexed = [(word, n) for *_, role, word, n in rows if role & INDEXED]
    asked = [(word, n) for *_, role, word, n in rows if role & LOOKED_UP and len(word) == m]
    if not asked or not indexed or len(indexed) == 1 and indexed[0] == asked[0]:
        return
    index = PositionIndex([word for word, _ in indexed])
    for word, n in asked:
        for place in index.near(word):
            other, k = indexed[place]
            # What also shares its start is found there.
            if not starts and word[:half] == other[:half]:
                continue
            yield word, other, k
            if len(other) > m:  # of equal length, the other one finds this one itself
                yield other, word, n


def near_words(words: DataFrame, block_letters: int = BLOCK_LETTERS) -> DataFrame:
    """(word, n_near, best): near words of each word that has any.

    ``best`` is the most frequent of them, as (-n, form), ties to the smaller.
    Counts and the best one combine per word, so pairs are never listed.
    """
    cell = ["part", "m", "starts", "index", "lookup"]
    meetings = _meetings(_posted(words), block_letters).select(*cell, "role", "word", "n")
    n_parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = meetings.repartition(n_parts, *cell).sortWithinPartitions(*cell)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*[c.to_pylist() for c in b.columns]))
        held: dict[str, list] = {}

        def give() -> pa.RecordBatch:
            columns = [list(held), *map(list, zip(*held.values()))] if held else [[], [], [], []]
            held.clear()
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["word", "n_near", "n", "form"]
            )

        for _, group in groupby(rows, key=lambda r: r[:5]):
            for word, other, k in _found(list(group)):
                now = held.get(word)
                if now is None:
                    held[word] = [1, k, other]
                else:
                    now[0] += 1
                    if k > now[1] or k == now[1] and other < now[2]:
                        now[1:] = k, other
            if len(held) > GIVEN:
                yield give()
        yield give()

    partial = dealt.mapInArrow(run, "word string, n_near long, n long, form string")
    return partial.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("n")).alias("minus_n"), "form")).alias("best")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the chain of forms (word, form) from each word ends.

    Every round doubles the step, and is written, so rounds are the log of the
    longest chain. A form is several times as frequent as its word, so chains
    are short and never close.
    """
    now = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = now.select(F.col("word").alias("at"), F.col("root").alias("further"))
        joined = now.join(step, F.col("root") == F.col("at"), "left")
        now = staged(
            joined.select("word", F.coalesce("further", "root").alias("root"), F.col("at").isNotNull().alias("went")),
            "roots",
        )
        went = now.where("went").head(1)
        now = now.select("word", "root")
        if not went:
            return now


def spelling_groups(words: DataFrame, times: int = 5, block_letters: int = BLOCK_LETTERS) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of every word.

    ``words`` has (word, n), each word once. Two words are near if they differ
    by exactly one inserted, deleted or replaced code point; ``n_near`` counts
    them. A word's form is its most frequent near word, ties to the first in
    order of code points, if that is at least ``times`` as frequent; else form
    and ``form_n`` are null. ``root`` is where following forms ends: the word
    itself if it has none. Null and empty words are left out; no words give no
    rows. Very long words are indexed whole, a block each.
    """
    if times < 2:
        raise ValueError("a form has to be more frequent than its word")
    known = staged(words.where(F.col("word") != "").select("word", "n"), "words")
    found = near_words(known, block_letters)
    better = -F.col("best.minus_n") >= times * F.col("n")
    formed = staged(
        known.join(found, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(better, F.col("best.form")).alias("form"),
            F.when(better, -F.col("best.minus_n")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(formed.where("form is not null"))
    return formed.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
