"""Checks of tokenized data: markers, special tokens, decoding, token reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.arrays import positions_of
from weftline.functions.text import escape_newlines
from weftline.functions.tokens import (
    FIRST_SPECIAL_ID,
    UNKNOWN_ID,
    UNKNOWN_PIECE,
    RegexTokenizer,
    vocabulary,
)
from weftline.operators.lookup import HOT_BYTES, look_up


def marker_positions(
    text: Column, tokenizer: RegexTokenizer, marker: str, fragment: str
) -> tuple[Column, Column]:
    """Where a marker's id stands, and the pieces it was cut into if nowhere.

    The second column lists pieces that hold ``fragment`` as ``index:piece``:
    a marker that is not registered as special is cut apart.
    """
    pieces = tokenizer.pieces(text)
    if marker in tokenizer.specials:
        ids = F.transform(pieces, tokenizer.piece_id)
        positions = positions_of(ids, tokenizer.special_id(marker))
    else:
        positions = F.array().cast("array<int>")
    broken = F.filter(
        F.transform(
            pieces,
            lambda p, i: F.when(
                p.contains(fragment), F.concat_ws(":", i.cast("string"), p)
            ),
        ),
        lambda x: x.isNotNull(),
    )
    nothing = F.array().cast("array<string>")
    return positions, F.when(F.size(positions) == 0, broken).otherwise(nothing)


def token_report(
    df: DataFrame, keys: list[str], segs: str, tokenizer: RegexTokenizer
) -> DataFrame:
    """One row per token: its index, id, piece and whether it is trained on."""
    pieces = F.flatten(
        F.transform(
            segs,
            lambda s: F.transform(
                tokenizer.pieces(s["text"]),
                lambda p: F.struct(p.alias("piece"), s["trainable"].alias("trainable")),
            ),
        )
    )
    rows = df.select(*keys, F.posexplode_outer(pieces).alias("index", "t"))
    return rows.where(F.col("index").isNotNull()).select(
        *keys,
        F.col("index").cast("bigint").alias("index"),
        tokenizer.piece_id(F.col("t.piece")).cast("bigint").alias("token_id"),
        escape_newlines(F.col("t.piece")).alias("piece"),
        F.when(F.col("t.trainable"), F.lit("TRAIN")).otherwise(F.lit("SKIP")).alias("label"),
    )


def special_vocabulary(df: DataFrame, text: Column, tokenizer: RegexTokenizer) -> DataFrame:
    """(token, token_id, n) of every special, with its count in the texts."""
    used = vocabulary(df, text, tokenizer).where(F.col("token_id") >= FIRST_SPECIAL_ID)
    spark = df.sparkSession
    known = spark.createDataFrame(
        [(s, tokenizer.special_id(s)) for s in tokenizer.specials],
        "token string, token_id int",
    )
    # Both sides have one row per registered special.
    return known.join(used.select("token_id", "n"), "token_id", "left").select(
        "token",
        F.col("token_id").cast("bigint").alias("token_id"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def special_roundtrip(df: DataFrame, text: Column, tokenizer: RegexTokenizer) -> DataFrame:
    """(token, n_single, n_same) of every special: how often its text stays a
    single piece in the data, and how often that piece's id leads back to it."""
    back = F.create_map(
        *[F.lit(x) for s in tokenizer.specials for x in (tokenizer.special_id(s), s)]
    )
    known = df.sparkSession.createDataFrame([(s,) for s in tokenizer.specials], "token string")
    pieces = (
        df.select(F.explode_outer(tokenizer.pieces(text)).alias("token"))
        .where(F.col("token").isin(*tokenizer.specials))
        .groupBy("token")
        .agg(F.count("*").alias("n"))
    )
    decoded = F.try_element_at(back, tokenizer.piece_id(F.col("token")))
    # Both sides have one row per registered special.
    n = F.coalesce("n", F.lit(0))
    return known.join(pieces, "token", "left").select(
        "token",
        n.alias("n_single"),
        F.when(decoded == F.col("token"), n).otherwise(0).alias("n_same"),
    )


def encode_stored(
    df: DataFrame,
    keys: list[str],
    text: Column,
    tokenizer: RegexTokenizer,
    vocab: DataFrame,
    most_bytes: int = HOT_BYTES,
) -> DataFrame:
    """(keys, ids): texts by a stored vocabulary; ``UNKNOWN_ID`` for new pieces.

    ``most_bytes`` is what a worker may hold of it, see
    :func:`weftline.operators.lookup.look_up`.
    """
    table = _entries(vocab, "piece", "token_id")
    pieces = df.select(*keys, tokenizer.pieces(text).alias("_pieces"))
    return look_up(pieces, keys, "_pieces", table, UNKNOWN_ID, "ids", most_bytes)


def decode_ids(
    df: DataFrame, keys: list[str], ids: str, vocab: DataFrame, most_bytes: int = HOT_BYTES
) -> DataFrame:
    """(keys, pieces): ids back to pieces; ``UNKNOWN_PIECE`` for ids not in ``vocab``."""
    table = _entries(vocab, "token_id", "piece")
    return look_up(df, keys, ids, table, UNKNOWN_PIECE, "pieces", most_bytes)


def _entries(vocab: DataFrame, of: str, to: str) -> DataFrame:
    counts = ["n"] if "n" in vocab.columns else []
    return vocab.select(F.col(of).alias("from"), F.col(to).alias("to"), *counts)
