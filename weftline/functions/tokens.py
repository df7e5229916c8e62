"""A tokenizer that is a column expression and stays in the JVM.

Every registered special token is one atomic id, which is what makes
segment-wise encoding equal to encoding a whole rendered chat.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators.indexing import dense_index
from weftline.params import SPECIALS, SpecialTokens
from weftline.session import staged

WORDS = r"\p{L}+|\p{N}+"
OTHER = r"[^ \t\n\x0B\f\r\p{L}\p{N}]"  # one visible character

# An ordinary id is the low 30 bits of its piece's CRC-32, so no vocabulary has
# to be built or joined to encode; specials are numbered above them.
FIRST_SPECIAL_ID = 1 << 30
UNKNOWN_ID, UNKNOWN_PIECE = -1, "<unk>"


@dataclass(frozen=True)
class RegexTokenizer:
    specials: tuple[str, ...] = SPECIALS
    markers: SpecialTokens = SpecialTokens()

    @property
    def pattern(self) -> str:
        atoms = [re.escape(s) for s in sorted(self.specials, key=lambda s: (-len(s), s))]
        # Specials only compete with words where one starts like a word; most
        # pieces are words, so otherwise words are tried first.
        if any(s[0].isalnum() for s in self.specials):
            return "|".join([*atoms, WORDS, OTHER])
        return "|".join([WORDS, *atoms, OTHER])

    @property
    def fast_pattern(self) -> str:
        """Finds what ``pattern`` finds: atoms that start alike are tried once, by that character.

        So a blank or a sign that starts none is not held against every atom.
        """
        alike: dict[str, list[str]] = {}
        for s in sorted(self.specials, key=lambda s: (-len(s), s)):
            alike.setdefault(s[0], []).append(re.escape(s[1:]))
        atoms = [f"{re.escape(c)}(?:{'|'.join(rest)})" for c, rest in alike.items()]
        if any(c.isalnum() for c in alike):
            return "|".join([*atoms, WORDS, OTHER])
        return "|".join([WORDS, *atoms, OTHER])

    def special_id(self, token: str) -> int:
        return FIRST_SPECIAL_ID + self.specials.index(token)

    @property
    def pad_id(self) -> int:
        return self.special_id(self.markers.pad_token)

    def pieces(self, text: Column) -> Column:
        return F.regexp_extract_all(text, F.lit(self.fast_pattern), F.lit(0))

    def piece_id(self, piece: Column) -> Column:
        hashed = F.crc32(piece).bitwiseAND(F.lit(FIRST_SPECIAL_ID - 1)).cast("int")
        if not self.specials:
            return hashed
        # Only pieces that start like a special are looked up.
        starts = sorted({s[0] for s in self.specials})
        like_special = reduce(or_, [F.startswith(piece, F.lit(c)) for c in starts])
        table = F.array(*[F.lit(s) for s in self.specials])
        slot = F.array_position(table, piece).cast("int")
        special = F.when(slot > 0, F.lit(FIRST_SPECIAL_ID - 1) + slot).otherwise(hashed)
        return F.when(like_special, special).otherwise(hashed)

    def encode(self, text: Column) -> Column:
        return F.transform(self.pieces(text), self.piece_id)

    def encode_many(self, texts: Column) -> Column:
        return F.transform(texts, self.encode)

    def count(self, text: Column) -> Column:
        return F.size(self.pieces(text))

    def has_token(self, text: Column) -> Column:
        """Equal to ``count(text) > 0``, but stops at the first piece."""
        return F.coalesce(text.rlike(self.fast_pattern), F.lit(False))


def vocabulary(df: DataFrame, text: Column, tokenizer: RegexTokenizer) -> DataFrame:
    """(token_id, piece, n, n_pieces): the pieces that occur, by id.

    ``n`` counts all occurrences of the id. Ids are 30-bit hashes, so a large
    vocabulary has pieces that share one; ``piece`` is then the most frequent
    of the ``n_pieces``. Counts combine before each shuffle, so a very frequent
    piece costs one row per task.
    """
    # The outer form: the inner one makes the optimizer add a filter on the
    # array's size, which would tokenize every text again.
    pieces = (
        df.select(F.explode_outer(tokenizer.pieces(text)).alias("piece"))
        .where(F.col("piece").isNotNull())
        .groupBy("piece")
        .agg(F.count("*").alias("n"))
    )
    return (
        pieces.groupBy(tokenizer.piece_id(F.col("piece")).alias("token_id"))
        .agg(
            F.max(F.struct("n", "piece"))["piece"].alias("piece"),
            F.sum("n").alias("n"),
            F.count("*").alias("n_pieces"),
        )
    )


def stored_vocabulary(df: DataFrame, text: Column, tokenizer: RegexTokenizer) -> DataFrame:
    """(token_id, piece, n): an id of its own, from 0 on, for every piece that occurs.

    Unlike hashed ids these never collide, so decoding by the vocabulary is
    exact; white space is no piece and does not come back. Write the table
    before use: ids hold for the vocabulary that they came from. One that keeps
    its ids as data comes is made by
    :func:`weftline.operators.vocabulary.grow_vocabulary`.
    """
    pieces = (
        df.select(F.explode_outer(tokenizer.pieces(text)).alias("piece"))
        .where(F.col("piece").isNotNull())
        .groupBy("piece")
        .agg(F.count("*").alias("n"))
    )
    # Written, since numbering counts the pieces before it moves them: else every
    # text is cut into pieces twice.
    counted = staged(pieces, "pieces")
    return dense_index(counted, ["piece"], out="token_id", digits=2).select("token_id", "piece", "n")
