"""Quality rules: signals of a text by itself, and lines that a whole host repeats.

Everything here is DataFrame expressions. Lines are normalised and hashed; for
each host the distinct documents that hold a line are counted. A line is above
the limits if more than ``max_docs`` documents of the host hold it, or if at
least ``min_docs`` do and these are more than ``max_share_pct`` percent of the
host's documents, so that the rule holds for small hosts too. Such a line goes
from all of them but the document with the smallest id. A document that keeps
too few of its words is depleted and rejected, so of many copies on a host one
stays; the others can be had without the lines that go.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.session import staged

BLANK = " \t\n\x0b\x0c\r"
BLANKS = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SYMBOLS = "#*$%&|<>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BLANKS), lambda w: w != "")


def has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def lines_of(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(text, "\n"), has_word)


def repeated_words(words: Column) -> Column:
    """How many words stand in a 3-word window that the text holds twice or more."""
    windows = F.when(
        F.size(words) >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))

    def covered(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        # Equal windows are neighbours once sorted.
        starts = let(
            ordered,
            lambda o: F.transform(
                F.filter(
                    F.transform(
                        o,
                        lambda x, j: F.struct(
                            x["i"].alias("i"),
                            F.coalesce(
                                (F.get(o, j - 1)["h"] == x["h"]) | (F.get(o, j + 1)["h"] == x["h"]),
                                F.get(o, j - 1)["h"] == x["h"],
                                F.get(o, j + 1)["h"] == x["h"],
                                F.lit(False),
                            ).alias("twice"),
                        ),
                    ),
                    lambda x: x["twice"],
                ),
                lambda x: x["i"],
            ),
        )
        spans = F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))
        return F.size(F.array_distinct(spans))

    return let(
        windows,
        lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0),
    )


def signals(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    t = F.coalesce(text, F.lit(""))
    counted = let(
        words_of(t),
        lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("repeated")),
    )
    bigint = "bigint"
    return let(
        counted,
        lambda c: F.struct(
            c["n"].cast(bigint).alias("n_words"),
            F.length(F.translate(t, BLANK, "")).cast(bigint).alias("word_chars"),
            (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast(bigint).alias("n_symbols"),
            let(lines_of(t), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast(bigint).alias("n_dup_lines"),
            c["repeated"].cast(bigint).alias("n_repeat_words"),
        ),
    )


def removed_lines(df: DataFrame, max_docs: int, min_docs: int, max_share_pct: int, places: bool) -> DataFrame:
    """(_id, _host, _copy, n_removed): words in lines that go, for rows that lose any.

    With ``places`` also ``_gone``, the places of these lines in the text.
    """
    line = F.translate(F.btrim(F.col("line"), F.lit(BLANK)), UPPER, LOWER)
    of_text = F.split("_text", "\n")
    if places:
        lines = df.select("_id", "_host", "_copy", F.posexplode(of_text).alias("at", "line"))
        lines = lines.where(has_word(F.col("line")))
        # Rows of one key, host and text are the same places over again.
        found, lost = [F.collect_set("at").alias("at")], [F.flatten(F.collect_list("at")).alias("_gone")]
        kept = ["at"]
    else:
        lines = df.select("_id", "_host", "_copy", F.explode(lines_of(F.col("_text"))).alias("line"))
        found, lost, kept = [], [], []
    postings = staged(
        lines.select(
            "_id",
            "_host",
            "_copy",
            # 96 bits tell lines apart.
            F.xxhash64(line).alias("h"),
            F.hash(line).alias("g"),
            F.size(words_of(F.col("line"))).alias("n"),
            *kept,
        )
        .groupBy("_id", "_host", "_copy", "h", "g")
        .agg(F.sum("n").alias("n"), *found),
        "lines",
    )
    # Documents are keys: rows without one are not counted, and rows that share
    # a key count once. Each step combines inside tasks before it is shuffled.
    hosts = df.groupBy("_host").agg(F.count_distinct("_id").alias("n_host"))
    frequent = (
        postings.groupBy("_host", "h", "g", "_id")
        .agg(F.lit(1))
        .groupBy("_host", "h", "g")
        .agg(F.count("_id").alias("n_docs"), F.min("_id").alias("_first"))
        .where(F.col("n_docs") >= min(min_docs, max_docs + 1))
    )
    n = F.col("n_docs")
    above = (n > max_docs) | ((n >= min_docs) & (100 * n > max_share_pct * F.col("n_host")))
    # Written, so that the join below knows its size, and a line that very many
    # documents hold can be split among tasks.
    common = staged(frequent.join(hosts, "_host").where(above).select("_host", "h", "g", "_first"), "common")
    return (
        postings.join(common, ["_host", "h", "g"])
        .where(~F.col("_id").eqNullSafe(F.col("_first")))
        .groupBy("_id", "_host", "_copy")
        .agg(F.sum("n").alias("n_removed"), *lost)
    )


def without_lines(text: Column, gone: Column) -> Column:
    """The text without the lines at the places ``gone``; all of it if that is null."""

    def left(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n")

    return F.when(gone.isNull(), text).otherwise(let(F.split(text, "\n"), left))


def judge_documents(
    df: DataFrame,
    keep: list[str],
    key: str = "doc_id",
    host: str = "source",
    text: str = "text",
    max_docs: int = 100,
    min_docs: int = 5,
    max_share_pct: int = 10,
    min_left_pct: int = 30,
    min_words: int = 50,
    max_repeat_pct: int = 50,
    cleaned: bool = False,
) -> DataFrame:
    """``keep`` columns, the signals, ``n_removed``, ``base_failed`` and ``kept``.

    With ``cleaned`` there is also ``cleaned``, the text without the lines that
    go. Its other lines, blank ones too, stay as they are and in their order.

    A row fails the base rules with fewer than ``min_words`` words or more than
    ``max_repeat_pct`` percent of them repeated; it is depleted when less than
    ``min_left_pct`` percent of its words are left. Null and empty texts have no
    words and fail; very long ones are judged whole. Null hosts are one host. Rows
    with equal key, host and text are judged alike; rows that share a key but not
    the text are judged each by itself. Rows without a key are no document: they
    are not counted, and never the one that keeps a line. An empty table gives no
    rows.
    """
    rows = df.select(
        F.col(f"`{key}`").alias("_id"),
        F.coalesce(F.col(f"`{host}`").cast("string"), F.lit("")).alias("_host"),
        F.xxhash64(f"`{text}`", F.length(f"`{text}`")).alias("_copy"),
        F.col(f"`{text}`").alias("_text"),
        *[F.col(f"`{k}`").alias(f"_kept_{k}") for k in keep],
    )
    kept = [f"`_kept_{k}`" for k in keep]
    texts = ["_text"] if cleaned else []
    own = rows.select("_id", "_host", "_copy", *kept, *texts, signals(F.col("_text")).alias("_s"))
    removed = removed_lines(rows, max_docs, min_docs, max_share_pct, cleaned)
    removed = removed.withColumnsRenamed({"_id": "_id2", "_host": "_host2", "_copy": "_copy2"})
    joined = own.join(
        removed,
        F.col("_id").eqNullSafe(F.col("_id2"))
        & (F.col("_host") == F.col("_host2"))
        & F.col("_copy").eqNullSafe(F.col("_copy2")),
        "left",
    )
    n, gone = F.col("_s.n_words"), F.coalesce("n_removed", F.lit(0))
    failed = (n < min_words) | (100 * F.col("_s.n_repeat_words") > max_repeat_pct * n)
    return joined.select(
        *[F.col(c).alias(k) for c, k in zip(kept, keep)],
        "_s.*",
        gone.alias("n_removed"),
        failed.alias("base_failed"),
        (~failed & (100 * (n - gone) >= min_left_pct * n)).alias("kept"),
        *[without_lines(F.col(t), F.col("_gone")).alias("cleaned") for t in texts],
    )
