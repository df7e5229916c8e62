"""From task sources to one shuffled chat table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.indexing import seeded_shuffle
from weftline.operators.project import align_chats, unpivot_tasks
from weftline.operators.setops import union_all


def curate_tasks(
    sources: dict[str, DataFrame], keys: list[str], seed: int = 42, ordered: bool = True
) -> DataFrame:
    """Unpivot, tag and union task sources; rows are keyed by source, ``keys``
    and column, and come in seeded random order unless ``ordered`` is off."""
    frames = [
        unpivot_tasks(df, keys).withColumn("source", F.lit(name))
        for name, df in sources.items()
    ]
    rows = union_all(frames).drop("column_name")
    full_key = ["source", *keys, "column_idx"]
    return seeded_shuffle(rows, full_key, seed) if ordered else rows


def merge_aligned(
    curated: DataFrame, new_rows: DataFrame, keys: list[str], seed: int = 42,
    ordered: bool = True,
) -> DataFrame:
    """Align a new chat source with the curated one, check, union, shuffle."""
    merged = union_all([align_chats(curated, keys), align_chats(new_rows, keys)])
    return seeded_shuffle(merged, keys, seed) if ordered else merged
