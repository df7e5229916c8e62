"""Line dedup: two Bloom filters find suspects, and only those are confirmed.

A first pass fills a filter of line hashes seen once and one of those seen
again (see :func:`weftline.llm.filters.seen_filters`). A second pass shuffles the
digests of suspected lines alone: they are counted exactly, and the document
that keeps the line is chosen. Filters only ever suspect too much, so a small
``bits`` for a large corpus costs shuffle, never a line.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.arrow import add_columns, let_go, texts
from weftline.llm.filters import seen_filters
from weftline.session import staged

BLANK = " \t\n\x0b\x0c\r"


def line_digest(line: str, min_chars: int) -> bytes | None:
    """128-bit digest of a line's key, None if the key is too short to count."""
    key = line.strip(BLANK)
    # Bytes lower A-Z alone.
    return xxhash.xxh3_128_digest(key.encode().lower()) if len(key) >= min_chars else None


def digests(text: str, min_chars: int) -> set[bytes]:
    found = {line_digest(line, min_chars) for line in text.split("\n")}
    found.discard(None)
    return found


def as_hashes(found: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(found), np.uint64).reshape(-1, 2)


def repeated_lines(
    df: DataFrame, key: str, text: str, min_docs: int, min_chars: int, bits: int
) -> DataFrame:
    """(doc_id, drop array<binary>): the line digests that each document loses."""
    documents = df.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    documents = documents.where("doc_id is not null and text is not null")

    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for t in texts(batch.column(0)):
            yield as_hashes(sorted(digests(t, min_chars)))

    # Rows of one document may repeat; they only add suspects.
    _, suspected = seen_filters(documents.select("text"), hashes, bits)

    def suspects():
        let_go()

        def work(columns):
            rows = []
            for t in texts(columns["text"]):
                found = sorted(digests(t, min_chars))
                keep = suspected.has(as_hashes(found)) if found else ()
                rows.append([d for d, ok in zip(found, keep) if ok])
            return [pa.array(rows, pa.list_(pa.binary()))]

        return work

    lists = add_columns(
        documents, ["doc_id"], {"text": F.col("text")}, "lines array<binary>", suspects
    )
    postings = staged(
        lists.select("doc_id", F.explode("lines").alias("line")).distinct(), "suspects"
    )
    # Written, so that the join knows its size, and a line that very many
    # documents hold can be split among tasks: an aggregate under it prevents that.
    repeated = staged(
        postings.groupBy("line")
        .agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
        .where(F.col("n") >= min_docs),
        "repeated",
    )
    return (
        postings.join(repeated, "line")
        .where(F.col("doc_id") != F.col("keeper"))
        .groupBy("doc_id")
        .agg(F.collect_list("line").alias("drop"))
    )


def dedup_lines(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    keep: tuple[str, ...] = (),
    min_docs: int = 5,
    min_chars: int = 40,
    bits: int = 1 << 26,
) -> DataFrame:
    """Drop lines found in ``min_docs`` documents from all but the largest key.

    Gives ``key``, the ``keep`` columns, ``n_lines`` before, ``n_dropped`` and
    the ``kept`` text. A line's key is the line without blanks at its ends, A-Z
    lowered; shorter keys than ``min_chars`` code points are left alone. The
    keeper keeps every copy that it holds. A null text is one empty line. Rows
    with the same key count as one document; rows without a key are no document
    and lose nothing. Dropping all lines leaves the empty text; very long lines
    and texts are treated as any other. An empty table gives no rows.
    """
    drops = repeated_lines(df, key, text, min_docs, min_chars, bits)
    plain = df.select(
        *[F.col(f"`{c}`") for c in dict.fromkeys((key, *keep))], F.col(f"`{text}`").alias("_text")
    )
    joined = plain.join(
        drops.select(F.col("doc_id").alias("_id"), F.col("drop").alias("_drop")),
        F.col(f"`{key}`") == F.col("_id"),
        "left",
    )

    def make():
        def work(columns):
            counts, dropped, kept = [], [], []
            for t, drop in zip(texts(columns["text"]), columns["drop"].to_pylist()):
                lines = t.split("\n")
                counts.append(len(lines))
                if drop:
                    gone = set(drop)
                    lines = [x for x in lines if line_digest(x, min_chars) not in gone]
                    t = "\n".join(lines)
                dropped.append(counts[-1] - len(lines))
                kept.append(t)
            return [pa.array(counts, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())]

        return work

    return add_columns(
        joined,
        list(dict.fromkeys((key, *keep))),
        {"text": F.col("_text"), "drop": F.col("_drop")},
        "n_lines long, n_dropped long, kept string",
        make,
    )
