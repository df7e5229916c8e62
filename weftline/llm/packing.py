"""Best-fit packing, planned over a histogram of lengths.

Best fit decreasing looks only at lengths, so it can be run over counts: all
pieces of one length are placed together, into ranges of equally full sequences.
The histogram has at most ``limit`` rows, whatever the corpus; the plan made of
it says which ranks of a length go to which sequences at which offset. Pieces
then take their slots by joining on length and rank.

The plan is broadcast. Its size does not follow the corpus: a step either uses
up a length or fills a whole range of sequences, and only the first kind, and
opening sequences, adds a range. So there are at most 3 ranges per length, each
filled at most once for every length that still fits it.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from unicodedata import is_normalized, normalize

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.arrow import LONGEST_SEEN, Known, held, list_array, slices, texts
from weftline.operators.indexing import dense_index
from weftline.session import staged

# The steps of a vocabulary file that this module takes itself, as the
# file says them, and the end of a piece that ends a part.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZER = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]
PRE_TOKENIZER = [
    {"type": "Split", "pattern": {"Regex": PARTS}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
PART_END = "</w>"

SPLIT = regex.compile(PARTS)
# What Python's split takes for white space but that pattern does not.
ODD_SPACE = "\x1c-\x1f\x85"
MOST_WORDS = 1_000_000  # that a task remembers
AT_ONCE = 500  # parts that go through the library as one text
PLAN = "length int, first long, last long, first_sequence long, offset long"


class WordTokenizer:
    """Ids of a vocabulary file that never joins text across white space.

    White-space separated words are encoded and remembered, with their parts, in
    one table of a fixed size. The library encodes many new parts as one text, in
    which the ends of parts can be told from the pieces. Texts with a special token in them go through the library as they are.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        steps = [rules[k] and rules[k].get(of) for k, of in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
        if steps != [NORMALIZER, PRE_TOKENIZER] or rules["model"].get("end_of_word_suffix") != PART_END:
            raise ValueError(f"{path}: text is not cut as this module does it")
        if any(t["normalized"] for t in rules["added_tokens"]):
            raise ValueError(f"{path}: its special tokens are looked for in lowered text")
        self.odd, self.added = re.compile(f"[{ODD_SPACE}]"), [t["content"] for t in rules["added_tokens"]]
        vocabulary = self.library.get_vocab(True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith(PART_END)]] = True
        self.words = Known(self.encode_words, MOST_WORDS)

    def encode_whole(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", f.ids).tobytes() for f in found]

    def encode_parts(self, parts: list[str]) -> list[bytes]:
        """Ids of different parts, each what ``SPLIT`` finds."""
        groups = [parts[at : at + AT_ONCE] for at in range(0, len(parts), AT_ONCE)]
        texts = self.library.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)
        found: list[bytes] = []
        for group, text in zip(groups, texts):
            ids = np.array(text.ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(group) and stops[-1] == len(ids):
                data, stops = ids.tobytes(), (4 * stops).tolist()
                found += [data[a:b] for a, b in zip([0, *stops[:-1]], stops)]
            else:  # a part was cut otherwise next to others
                found += self.encode_whole(group)
        return found

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of words; a part of a word is a word as well."""
        split = []
        for word in words:
            # The file's own steps: compose, then lower each character for itself.
            lower = word if word.isascii() else normalize("NFC", word).replace("Σ", "σ")
            lower = lower.lower()
            if not lower.isascii() and not is_normalized("NFC", lower):
                split.append(None)  # the parts would be composed once more
            elif lower.isalpha():
                split.append((lower,))
            elif lower[:-1].isalpha() and not lower[-1].isalpha():
                split.append((lower[:-1], lower[-1]))
            else:
                split.append(SPLIT.findall(lower))
        known = self.words
        new = list(set().union(*[s for s in split if s is not None]).difference(known))
        made = dict(zip(new, self.encode_parts(new)))
        for part, ids in made.items():
            if len(part) <= LONGEST_SEEN:
                known[part] = ids
        whole = iter(self.encode_whole([w for w, s in zip(words, split) if s is None]))
        return [
            next(whole) if s is None else b"".join([made[k] if k in made else known[k] for k in s])
            for s in split
        ]

    def encode_all(self, documents: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers (on the usual machines)."""
        odd = [self.odd.search(t) is not None or any(x in t for x in self.added) for t in documents]
        whole = iter(self.encode_whole([t for t, x in zip(documents, odd) if x]))
        joined = iter(self.words.join([t.split() for t, x in zip(documents, odd) if not x]))
        return [next(whole if x else joined) for x in odd]


def tokenizer(path: str) -> WordTokenizer:
    """One per Python worker, as long as it works with the same file."""
    return held((WordTokenizer, path), lambda: WordTokenizer(path))


def cut_documents(
    df: DataFrame,
    keep: list[str],
    path: str,
    limit: int = 4096,
    end_id: int = 1,
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Encode whole texts and cut what is longer than ``limit`` tokens.

    One row per piece: ``keep`` columns, ``piece`` from 0, ``start`` (ids before
    it), ``length``, ``ids_crc32`` and, if asked for, ``ids``. A document is its
    ids and then ``end_id``, so null and empty texts give one piece of length 1;
    a very long text gives many. Ids are the library's, which takes the strings
    of the file's special tokens for these tokens. Rows are independent of each
    other; repeated rows give repeated pieces, an empty table gives none.
    """
    both = df.select(*[F.col(f"`{k}`") for k in keep], F.col(f"`{text}`").alias("_text"))
    n_keep = len(keep)
    added = "piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    schema = T.StructType([*both.schema.fields[:n_keep], *T.StructType.fromDDL(added).fields])
    names = schema.names
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path).encode_all
        for batch in slices(batches):
            rows, pieces, starts, lengths, sums, ids = [], [], [], [], [], []
            for row, data in enumerate(encode(texts(batch.column(n_keep)))):
                data += end
                for piece, at in enumerate(range(0, len(data), 4 * limit)):
                    part = data[at : at + 4 * limit]
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(at // 4)
                    lengths.append(len(part) // 4)
                    sums.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<i4"))
            taken = [batch.column(i).take(pa.array(rows, pa.int32())) for i in range(n_keep)]
            columns = [pa.array(pieces, pa.int32())]
            columns += [pa.array(x, pa.int64()) for x in (starts, lengths, sums)]
            columns += [list_array(ids, pa.int32())] * with_ids
            yield pa.RecordBatch.from_arrays(taken + columns, names=names)

    return both.mapInArrow(run, schema)


def plan_best_fit(counts: dict[int, int], limit: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank, first sequence, offset) of every placed range.

    Best fit decreasing: the longest lengths first, each piece into the fullest
    sequence that still takes it. Equal sequences are kept as ranges by the room
    left in them; ``rooms`` has a bit for every room that some sequence has.
    """
    plan: list[tuple[int, int, int, int, int]] = []
    free: dict[int, list[tuple[int, int]]] = {}
    rooms, sequences = 0, 0

    def put_back(room: int, first: int, n: int) -> None:
        nonlocal rooms
        if room and n:
            free.setdefault(room, []).append((first, n))
            rooms |= 1 << room

    for length in sorted((x for x, n in counts.items() if n), reverse=True):
        if not 0 < length <= limit:
            raise ValueError(f"a piece of {length} tokens does not fit {limit}")
        left, rank = counts[length], 0
        while left:
            fitting = rooms >> length
            if fitting:
                room = length + (fitting & -fitting).bit_length() - 1
                first, n = free[room].pop()
                if not free[room]:
                    del free[room]
                    rooms ^= 1 << room
            else:  # open as many sequences as the pieces fill, or one for the last few
                room = limit
                first, n = sequences, max(1, left // (limit // length))
                sequences += n
            each = min(room // length, left)
            used = min(n, left // each)
            for k in range(each):
                plan.append((length, rank, rank + used - 1, first, limit - room + k * length))
                rank += used
            left -= used * each
            put_back(room - each * length, first, used)
            put_back(room, first + used, n - used)
    return plan


def pack_best_fit(pieces: DataFrame, keys: list[str], limit: int = 4096) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a stored table of pieces.

    ``pieces`` needs ``length`` from 1 to ``limit`` and ``keys`` that tell its
    rows apart; rows equal in all keys may trade places, nothing else. An empty
    table stays empty. Ranks within a length come from counts per bucket of
    hashed keys, so a length that a third of all pieces have is still numbered
    by many tasks.
    """
    counted = pieces.groupBy("length").count().collect()  # at most ``limit`` rows
    plan = plan_best_fit({r["length"]: r["count"] for r in counted}, limit)
    slots = pieces.sparkSession.createDataFrame(plan, PLAN)
    ranked = dense_index(pieces, keys, groups=("length",), out="_rank", digits=3)
    at = (ranked["length"] == slots["length"]) & ranked["_rank"].between(
        slots["first"], slots["last"]
    )
    return ranked.join(F.broadcast(slots), at).select(
        *[ranked[c] for c in pieces.columns],
        (slots["first_sequence"] + ranked["_rank"] - slots["first"]).alias("sequence_id"),
        slots["offset"],
    )


def pack_documents(
    df: DataFrame, key: str, path: str, limit: int = 4096, end_id: int = 1, text: str = "text"
) -> DataFrame:
    """Cut, then pack: one row per piece with its place.

    The pieces are written once, as counting and placing both read them.
    """
    pieces = staged(cut_documents(df, [key], path, limit, end_id, text), "pieces")
    return pack_best_fit(pieces, [key, "piece", "ids_crc32"], limit)
