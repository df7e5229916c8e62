"""Chat formatting: conversations through a compiled template, and back.

Turns are hash-partitioned by conversation, sorted, and streamed through the
template's closures: a task holds one part of one conversation, however long
that is. (The digest that the query returns runs through a whole conversation
in order, so one conversation is always one task's stream.)
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.templates import compile_template, unescape

TURNS = (
    "{% for m in messages %}{{ '<|start|>' + m.role|escape + '<|text|>' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text|escape }}{% endgeneration %}"
    "{% else %}{{ m.text|escape }}{% endif %}{{ '<|end|>\\n' }}{% endfor %}"
)
_TURN = re.compile(r"<\|start\|>(.*?)<\|text\|>(.*?)<\|end\|>\n", re.S)
PART = 1 << 18  # code points after which a part is given away
FORMATTED = "conv_id long, part int, text string, spans array<struct<start:long,end:long>>"
READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def format_chats(
    df: DataFrame,
    template: str = TURNS,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``conv_id``, ``part`` from 0, its ``text`` and the trained ``spans`` in it.

    A conversation's text is its parts, joined; parts end between template
    pieces. Turns go by number, those with equal numbers by role and text, nulls
    first; repeated rows are repeated turns. Null roles and texts are empty. Rows
    without a conversation form one together. An empty table gives no rows.
    """
    compile_template(template)  # refuse a bad template here, not in a task
    names = {"conv_id": conv, "turn": turn, "role": role, "text": text}
    rows = df.select(*[F.col(f"`{c}`").alias(n) for n, c in names.items()])
    filled = rows.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        ready, size = [], 0
        for conv_id, messages in groupby(_rows(batches), key=lambda r: r["conv_id"]):
            number, pieces, spans, length = 0, [], [], 0
            for piece, trained in render(messages):
                if length > PART:
                    ready.append((conv_id, number, "".join(pieces), spans))
                    number, size = number + 1, size + length
                    pieces, spans, length = [], [], 0
                if trained and piece:
                    spans.append({"start": length, "end": length + len(piece)})
                pieces.append(piece)
                length += len(piece)
                if size > 8 * PART:
                    yield batch_of(ready)
                    ready, size = [], 0
            for _ in messages:  # a template need not read all turns
                pass
            ready.append((conv_id, number, "".join(pieces), spans))
            size += length
        yield batch_of(ready)

    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def batch_of(ready: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int32(), pa.string(), spans_type)
        columns = list(zip(*ready)) or [()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=["conv_id", "part", "text", "spans"],
        )

    dealt = filled.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(run, FORMATTED)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of the turns and of the trained text, parsed from formatted text.

    Takes the output of :func:`format_chats` under the ``TURNS`` template, its
    parts in order within partitions, and undoes the escapes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        results = []
        for conv_id, parts in groupby(_rows(batches), key=lambda r: r["conv_id"]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n_turns = loss_chars = total = 0
            rest = ""
            for part in parts:
                total += len(part["text"])
                for span in part["spans"]:
                    # A span holds whole pieces, so escapes are never cut.
                    trained = unescape(part["text"][span["start"] : span["end"]])
                    loss.update(trained.encode())
                    loss_chars += len(trained)
                rest, at = rest + part["text"], 0
                while m := _TURN.match(rest, at):
                    role, text = map(unescape, m.groups())
                    turns.update(f"{role}\n{text}\n".encode())
                    n_turns, at = n_turns + 1, m.end()
                rest = rest[at:]
            if rest:
                raise ValueError(f"conversation {conv_id}: {rest[:80]!r} is no turn")
            results.append((conv_id, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), total))
            if len(results) >= 1000:
                yield _result(results)
                results = []
        yield _result(results)

    return formatted.mapInArrow(run, READ)


def _result(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    columns = list(zip(*rows)) or [()] * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)],
        names=[x.strip().split(" ")[0] for x in READ.split(",")],
    )
