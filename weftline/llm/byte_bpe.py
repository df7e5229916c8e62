"""Byte-level BPE by rank files: a rank queue over a hierarchical bitmap.

Merging always takes the lowest rank that is present, leftmost first. The queue
keeps one bucket of linked-list positions per merge rank, and two levels of bits
that say which buckets hold something: words of 256 ranks, and one word over
these. Find-first-set on each level gives the next rank, however long the
pre-token. When a
merge changes a pair, its old entry stays in its bucket and is skipped as stale
once its bucket is drained; so a pre-token of n bytes costs at most 3 n entries.

Many pre-tokens share one queue: they are laid out one after another with a gap
between them that no merge crosses. Pre-tokens repeat, and so do the chunks of
text between spaces, so each task keeps the ids of those it has seen in one
table of a fixed size, and queues only new ones.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.arrow import LONGEST_SEEN, Known, add_columns, held, int_lists, list_array, texts

# White space as Unicode defines it, which is what the split pattern's \s means;
# Python's own class also holds U+001C to U+001F.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CHUNK = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
UNEVEN = re.compile(f"[{SPACE}][{SPACE}]|^ | $")
WORD = 8  # a bitmap word has 256 bits
LOW = (1 << WORD) - 1
PLAIN = "\n"  # what marks a chunk that has no space before it
MOST_CHUNKS = 1_000_000  # that a task remembers


class ByteBpe:
    """Encoder and decoder of one rank file and split pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {
                base64.b64decode(token): int(rank)
                for token, rank in (line.split() for line in lines if line.strip())
            }
        self.split = regex.compile(pattern.replace(r"\s", f"[{SPACE}]").replace(
            rf"[^[{SPACE}]", f"[^{SPACE}").replace(r"(?!\S)", f"(?![^{SPACE}])"))
        self.longest = max(map(len, self.ranks))
        # As many words as the ranks need, and as many bits over them.
        self.n_words = (max(self.ranks.values()) >> WORD) + 1
        self.bit = [1 << i for i in range(max(self.n_words, 1 << WORD))]
        self.table = {rank: token for token, rank in self.ranks.items()}
        two = range(256)
        self.of_two = np.array([self.ranks.get(bytes((a, b)), -1) for a in two for b in two])
        self.of_one = np.array([self.ranks[bytes((a,))] for a in two], np.int32)
        # Ids of chunks: by the word after one space, as most are, or after PLAIN.
        self.chunks = Known(self.encode_chunks, MOST_CHUNKS)

    def merge(self, pieces: list[str]) -> list[bytes]:
        """Ids of each pre-token, as bytes of 32-bit numbers."""
        data = [p.encode() for p in pieces]
        get, longest = self.ranks.get, self.longest
        done = [get(d) if len(d) <= longest else None for d in data]
        merged = iter(self.merge_bytes([d for d, rank in zip(data, done) if rank is None]))
        return [next(merged) if rank is None else rank.to_bytes(4, "little") for rank in done]

    def merge_bytes(self, pieces: list[bytes]) -> list[bytes]:
        if not pieces:
            return []
        get, longest = self.ranks.get, self.longest
        # Every pre-token is followed by a gap of one position.
        text = b"\0".join(pieces) + b"\0"
        n = len(text)
        ends = np.cumsum([len(p) + 1 for p in pieces]) - 1
        codes = np.frombuffer(text, np.uint8).astype(np.int64)
        ranks = np.full(n, -1)
        ranks[:-1] = self.of_two[codes[:-1] << 8 | codes[1:]]
        ranks[ends] = ranks[ends - 1] = -1
        gap = np.zeros(n + 1, np.uint8)
        gap[ends] = gap[-1] = 1  # before[0] is -1, so the last is a gap as well
        gap = gap.tobytes()
        # A part is named by where it begins; ``after`` is where it ends, ``pair``
        # the rank of it with the next part, -1 if they do not merge, and ``name``
        # its id, -1 once it is in the part before.
        pair, after, before = ranks.tolist(), list(range(1, n + 2)), list(range(-1, n))
        name = self.of_one[codes]
        name[ends] = -1
        name = name.tolist()
        order = np.argsort(ranks, kind="stable")
        order = order[np.searchsorted(ranks[order], 0) :]
        present, begins = np.unique(ranks[order], return_index=True)
        buckets = dict(zip(present.tolist(), (x.tolist() for x in np.split(order, begins[1:]))))
        bucket_of = buckets.get
        words, top, bit = [0] * self.n_words, 0, self.bit
        for rank in buckets:
            words[rank >> WORD] |= bit[rank & LOW]
            top |= bit[rank >> WORD]
        while top:
            # x & -x keeps the lowest set bit: first the word, then the rank.
            w = (top & -top).bit_length() - 1
            bits = words[w]
            first = bits & -bits
            rank = w << WORD | first.bit_length() - 1
            bits = words[w] = bits ^ first
            if not bits:
                top ^= bit[w]
            bucket = buckets.pop(rank)
            bucket.sort()  # leftmost first
            lower = False
            for k, i in enumerate(bucket):
                if pair[i] != rank:
                    continue  # stale: a neighbour has changed since
                gone = after[i]
                end = after[i] = after[gone]
                before[end] = i
                pair[gone] = name[gone] = -1
                name[i] = rank
                new = -1
                if not gap[end]:
                    stop = after[end]
                    if stop - i <= longest:
                        new = get(text[i:stop], -1)
                        if new >= 0:
                            if (waiting := bucket_of(new)) is not None:
                                waiting.append(i)
                            else:
                                buckets[new] = [i]
                                words[new >> WORD] |= bit[new & LOW]
                                top |= bit[new >> WORD]
                            lower = new < rank
                pair[i] = new
                at = before[i]
                if not gap[at]:
                    new = get(text[at:end], -1) if end - at <= longest else -1
                    pair[at] = new
                    if new >= 0:
                        if (waiting := bucket_of(new)) is not None:
                            waiting.append(at)
                        else:
                            buckets[new] = [at]
                            words[new >> WORD] |= bit[new & LOW]
                            top |= bit[new >> WORD]
                        lower = lower or new < rank
                if lower and k + 1 < len(bucket):
                    # A lower rank has appeared, so it is next; the rest waits.
                    buckets[rank] = bucket[k + 1 :]
                    words[w] |= first
                    top |= bit[w]
                    break
        name = np.array(name, np.int32)
        stops = 4 * np.cumsum(name >= 0)[ends]
        ids = name[name >= 0].tobytes()
        return [ids[a:b] for a, b in zip([0, *stops[:-1].tolist()], stops.tolist())]

    def encode_chunks(self, keys: list[str]) -> list[bytes]:
        """Ids of chunks, by their keys; a pre-token is a chunk as well."""
        split = []
        for key in keys:
            if key.isalpha():  # a space and a word are one pre-token
                split.append((key,))
            elif key[:-1].isalpha() and not key[-1].isalpha():  # and one more sign another
                split.append((key[:-1], PLAIN + key[-1]))
            else:
                chunk = key[1:] if key[:1] == PLAIN else " " + key
                split.append([self.key_of(p) for p in self.split.findall(chunk)])
        known = self.chunks
        new = list(set().union(*split).difference(known))
        made = dict(zip(new, self.merge([k[1:] if k[:1] == PLAIN else " " + k for k in new])))
        for key, ids in made.items():
            if len(key) <= LONGEST_SEEN:
                known[key] = ids
        return [b"".join([made[k] if k in made else known[k] for k in own]) for own in split]

    @staticmethod
    def key_of(chunk: str) -> str:
        # No word begins with PLAIN, so the two kinds of keys differ.
        return chunk[1:] if chunk[0] == " " and chunk[1:] and chunk[1] != PLAIN else PLAIN + chunk

    def encode_all(self, documents: list[str]) -> list[np.ndarray]:
        """Ids of whole texts.

        No pre-token runs on from visible characters into white space, so a text
        falls into chunks of a space and a word, or of white space alone, that
        are split further each for itself.
        """
        rows = []
        for text in documents:
            if UNEVEN.search(text):
                rows.append([self.key_of(c) for c in CHUNK.findall(text)])
            else:  # single white space only: cutting at spaces gives whole chunks
                row = text.split(" ")
                row[0] = PLAIN + row[0]
                rows.append(row)
        return [np.frombuffer(ids, np.int32) for ids in self.chunks.join(rows)]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of the ids; an id outside the vocabulary gives U+FFFD."""
        try:
            return b"".join(map(self.table.__getitem__, ids))
        except KeyError:
            return b"".join([self.table.get(i, b"\xef\xbf\xbd") for i in ids])


def codec(path: str, pattern: str) -> ByteBpe:
    """One codec per Python worker, as long as it works with the same vocabulary."""
    return held((ByteBpe, path, pattern), lambda: ByteBpe(path, pattern))


def encode_documents(
    df: DataFrame, keep: list[str], path: str, pattern: str, text: str = "text"
) -> DataFrame:
    """``keep`` columns and ``ids array<int>``, the ids of the whole text.

    Null and empty texts have no ids; very long ones are encoded whole, by the
    same queue. Rows are independent: repeated rows and null keys give one output
    row each, an empty table gives none, and other columns are ignored. ``path``
    is a rank file every executor can open, of any number of ranks; strings of
    special tokens are ordinary text.
    """

    def make():
        bpe = codec(path, pattern)

        def work(columns):
            return [list_array(bpe.encode_all(texts(columns["text"])), pa.int32())]

        return work

    return add_columns(df, keep, {"text": F.col(f"`{text}`")}, "ids array<int>", make)


def round_trip_documents(
    df: DataFrame, keep: list[str], path: str, pattern: str, text: str = "text"
) -> DataFrame:
    """``keep`` columns, ``ids`` and ``decoded``: encoded, and decoded again from the ids.

    As :func:`encode_documents` and then :func:`decode_documents`, in one pass
    over the rows.
    """

    def make():
        bpe = codec(path, pattern)

        def work(columns):
            rows = bpe.encode_all(texts(columns["text"]))
            back = pa.array([bpe.decode(r.tolist()) for r in rows], pa.binary())
            return [list_array(rows, pa.int32()), back]

        return work

    return add_columns(df, keep, {"text": F.col(f"`{text}`")}, "ids array<int>, decoded binary", make)


def decode_documents(
    df: DataFrame, keep: list[str], path: str, pattern: str, ids: str = "ids"
) -> DataFrame:
    """``keep`` columns and ``decoded binary``: the bytes that the ids stand for.

    Null or no ids give no bytes; an unknown or null id gives U+FFFD.
    """

    def make():
        bpe = codec(path, pattern)

        def work(columns):
            rows = int_lists(columns["ids"])
            return [pa.array([bpe.decode(r) for r in rows], pa.binary())]

        return work

    return add_columns(df, keep, {"ids": F.col(f"`{ids}`")}, "decoded binary", make)
