"""A stored vocabulary that grows: old ids stay, new pieces get the next ones.

Ids below ``reserved`` are for special tokens, in the order of registration;
ordinary pieces are numbered from there on. Growing compares pieces with the
stored table and numbers only the new ones, so a table that was used to encode
data still decodes it after any number of steps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.tokens import RegexTokenizer
from weftline.operators.indexing import dense_index
from weftline.session import staged

VOCABULARY = "token_id long, piece string, special boolean, version int, n long"
RESERVED = 256


def no_vocabulary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], VOCABULARY)


def special_tokens(vocab: DataFrame) -> list[str]:
    """The registered special tokens, by id; there are fewer than reserved ids."""
    rows = vocab.where("special").select("token_id", "piece").collect()
    return [r["piece"] for r in sorted(rows)]


def vocabulary_tokenizer(vocab: DataFrame) -> RegexTokenizer:
    """A tokenizer that keeps the vocabulary's special tokens in one piece."""
    return RegexTokenizer(specials=tuple(special_tokens(vocab)))


def piece_counts(df: DataFrame, text: Column, tokenizer: RegexTokenizer) -> DataFrame:
    """(piece, n): combined inside each task, so a frequent piece costs a row per task."""
    # The outer form: the inner one makes the optimizer add a filter on the
    # array's size, which would tokenize every text again.
    pieces = df.select(F.explode_outer(tokenizer.pieces(text)).alias("piece"))
    return pieces.where(F.col("piece").isNotNull()).groupBy("piece").agg(F.count("*").alias("n"))


def grow_vocabulary(
    vocab: DataFrame,
    df: DataFrame,
    text: Column,
    specials: Sequence[str] = (),
    reserved: int = RESERVED,
    seed: int = 42,
) -> DataFrame:
    """``vocab`` with the pieces of ``df`` and the special tokens that it lacks.

    Rows are (token_id, piece, special, version, n). Those that are there stay
    as they are; new ones carry the next version, and ``n``, how often a piece
    occurs in ``df``. Ordinary ids go on from the largest one without a gap, in
    an order that the pieces alone decide. A special token that is known, as
    special or as a piece, adds nothing; more than ``reserved`` are an error.
    Write the result before it is used: it is made anew each time it is read.
    """
    spark = df.sparkSession
    known = vocab.where("special").select("piece", "token_id").collect()
    last = vocab.agg(
        F.max("version").alias("version"), F.max(F.when(~F.col("special"), F.col("token_id"))).alias("ordinary")
    ).first()
    version = 0 if last["version"] is None else last["version"] + 1
    ids = {r["piece"]: r["token_id"] for r in known}
    asked = [s for s in dict.fromkeys(specials) if s not in ids]
    taken = {r["piece"] for r in vocab.where(F.col("piece").isin(asked)).select("piece").collect()} if asked else set()
    new_specials = [s for s in asked if s not in taken]
    first = max(ids.values(), default=-1) + 1
    if first + len(new_specials) > reserved:
        raise ValueError(f"{first + len(new_specials)} special tokens, but only {reserved} reserved ids")
    registered = spark.createDataFrame(
        [(first + k, s, True, version, 0) for k, s in enumerate(new_specials)], VOCABULARY
    )
    every = [*sorted(ids, key=ids.get), *new_specials]
    counts = piece_counts(df, text, RegexTokenizer(specials=tuple(every)))
    # Both sides are dealt by piece, as the counts already are. Written, since
    # numbering counts the pieces before it moves them.
    ordinary = counts.where(~F.col("piece").isin(every)) if every else counts
    new = staged(ordinary.join(vocab.select("piece"), "piece", "left_anti"), "pieces")
    base = reserved if last["ordinary"] is None else last["ordinary"] + 1
    numbered = dense_index(new, ["piece"], seed, out="_place")
    added = numbered.select(
        (F.col("_place") + base).alias("token_id"),
        "piece",
        F.lit(False).alias("special"),
        F.lit(version).alias("version"),
        "n",
    )
    return vocab.select(*added.columns).unionByName(registered).unionByName(added)
