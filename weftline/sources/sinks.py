"""Writing datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_train_split(df: DataFrame) -> DataFrame:
    """A table without splits becomes the ``train`` split."""
    return df if "split" in df.columns else df.withColumn("split", F.lit("train"))


def save_dataset(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write parquet with one directory per split, each task writing its own
    files: no shuffle is added, and a large split is not gathered."""
    with_train_split(df).write.mode(mode).partitionBy("split").parquet(path)
