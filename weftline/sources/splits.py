"""Choosing the train and evaluation splits of a dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.sampling import split_train_eval


def resolve_splits(
    df: DataFrame,
    keys: list[str],
    test_size: float = 0.05,
    seed: int = 42,
    fixed: bool = False,
) -> DataFrame:
    """Rows of the train and evaluation split, as ``train`` and ``validation``.

    Given splits are used, and ``validation`` wins over ``test``. With only
    ``train``, or no split at all, an exact share is split off.
    """
    if "split" not in df.columns:
        return split_train_eval(df, keys, test_size, seed, fixed=fixed)
    # One row, whatever the table's size; only the split column is read.
    seen = df.agg(
        *[F.coalesce(F.bool_or(F.col("split") == s), F.lit(False)).alias(s)
          for s in ("train", "validation", "test")]
    ).first()
    if not seen["train"]:
        raise ValueError("the dataset has splits, but no split named train")
    held_out = next((s for s in ("validation", "test") if seen[s]), None)
    if held_out is None:
        train = df.where(F.col("split") == "train").drop("split")
        return split_train_eval(train, keys, test_size, seed, fixed=fixed)
    named = F.when(F.col("split") == "train", F.lit("train")).otherwise(F.lit("validation"))
    return df.where(F.col("split").isin("train", held_out)).withColumn("split", named)
