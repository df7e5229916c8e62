"""Token counts by section: whole documents are encoded once, spans are joined.

A document is its fields, joined. It is encoded as one text, so the tokens are
those that a model would see; their byte spans then meet the sorted spans of the
sections in an interval join. A token inside one section counts there. A token
that crosses a boundary counts where most of its bytes are, at a tie in the
earliest such section; so section counts always add up to the document's.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm import byte_bpe
from weftline.llm.arrow import slices

# The library cannot cut very long runs of white space; this subpackage's encoder
# gives the same ids.
LONG_BLANK = re.compile(r"\s{50000}")
ADDED = "field string, section int, start long, end long, n_tokens long, n_crossing long, n_document long"


@lru_cache(maxsize=2)
def codec(path: str, pattern: str):
    """The library's encoder, and the number of bytes of every id."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return encoding, sizes


def sections(values: list[str | None], joiner: str, divider: str) -> list[tuple[int, int, str]]:
    """(field number, section number, text) in order; they make up the document.

    A field is divided after every ``divider``; a ``joiner`` belongs to the last
    section before it.
    """
    found = []
    for f, value in enumerate(values):
        parts = (value or "").split(divider) if divider else [value or ""]
        texts = [p + divider for p in parts[:-1]] + parts[-1:]
        if f < len(values) - 1:
            texts[-1] += joiner
        found += [(f, k, text) for k, text in enumerate(texts)]
    return found


def allot(sizes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens, and tokens that crossed a boundary, by section.

    ``sizes`` are the bytes of the tokens in order, ``ends`` where sections end.
    """
    stop = np.cumsum(sizes)
    start = stop - sizes
    first = np.searchsorted(ends, start, "right")
    last = np.searchsorted(ends, stop - 1, "right")
    owner = first.copy()
    crossing = np.flatnonzero(first != last)
    for t in crossing.tolist():
        span = np.arange(first[t], last[t] + 1)
        begins = np.where(span > 0, ends[span - 1], 0)
        inside = np.minimum(ends[span], stop[t]) - np.maximum(begins, start[t])
        owner[t] = span[inside.argmax()]
    n = len(ends)
    return np.bincount(owner, minlength=n), np.bincount(owner[crossing], minlength=n)


def count_tokens(
    df: DataFrame,
    keep: list[str],
    fields: list[str],
    path: str,
    pattern: str,
    joiner: str = "\n\n",
    divider: str = "\n",
) -> DataFrame:
    """One row per section: ``keep`` columns, ``field`` and ``section`` number,
    its ``start`` and ``end`` in code points of the document, the tokens allotted
    to it, how many of these crossed a boundary, and the document's tokens.

    Null fields are empty; an empty field is one empty section. Strings of
    special tokens are ordinary text. Very long texts, blank ones too, are encoded
    whole. Rows are independent, so repeated rows give repeated sections, and an
    empty table gives none.
    """
    both = df.select(
        *[F.col(f"`{k}`") for k in keep],
        *[F.col(f"`{f}`").cast("string").alias(f"_field{i}") for i, f in enumerate(fields)],
    )
    n_keep = len(keep)
    schema = T.StructType([*both.schema.fields[:n_keep], *T.StructType.fromDDL(ADDED).fields])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, size_of = codec(path, pattern)

        def encode(text: str) -> np.ndarray:
            if LONG_BLANK.search(text):
                return byte_bpe.codec(path, pattern).encode(text).astype(np.int64)
            return np.array(encoding.encode_ordinary(text), np.int64)

        for batch in slices(batches):
            columns = [batch.column(n_keep + i).to_pylist() for i in range(len(fields))]
            rows, field, number, lengths, counts, crossed, whole = [], [], [], [], [], [], []
            for row, values in enumerate(zip(*columns)):
                parts = sections(values, joiner, divider)
                texts = [text for _, _, text in parts]
                ids = encode("".join(texts))
                ends = np.cumsum([len(t.encode()) for t in texts])
                own, over = allot(size_of[ids], ends)
                rows.append(np.full(len(parts), row))
                field += [fields[f] for f, _, _ in parts]
                number += [k for _, k, _ in parts]
                lengths.append(np.cumsum([len(t) for t in texts]))
                counts.append(own)
                crossed.append(over)
                whole.append(np.full(len(parts), len(ids)))
            end = np.concatenate(lengths)
            start = np.concatenate([np.append(0, e[:-1]) for e in lengths])
            taken = pa.array(np.concatenate(rows), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).take(taken) for i in range(n_keep)]
                + [pa.array(field), pa.array(number, pa.int32())]
                + [pa.array(x, pa.int64()) for x in (start, end, np.concatenate(counts),
                   np.concatenate(crossed), np.concatenate(whole))],
                names=names,
            )

    return both.mapInArrow(run, schema)
