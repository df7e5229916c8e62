"""Length report of a text dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.profile import (
    length_coverage,
    length_histogram,
    length_percentiles,
    length_recommend,
    length_stats,
)
from weftline.operators.sampling import take_exact
from weftline.sources.readers import spread


def text_length_histogram(
    texts: DataFrame, keys: list[str], tokenizer, column: str = "text",
    sample: int | None = None, seed: int = 42,
) -> DataFrame:
    """Token-length histogram of all rows, or of an exact sample of them."""
    rows = texts if sample is None else take_exact(texts, keys, sample, seed)
    return length_histogram(spread(rows.select(column)), tokenizer.count(F.col(column)))


def length_report(hist: DataFrame) -> DataFrame:
    """(section, item, metric, value): every statistic of a histogram."""

    def long(df: DataFrame, section: str, item: str | None) -> DataFrame:
        metrics = [c for c in df.columns if c != item]
        label = F.col(item).cast("string") if item else F.lit("all")
        cells = [
            F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
            for m in metrics
        ]
        return df.select(
            F.lit(section).alias("section"), label.alias("item"), F.inline(F.array(*cells))
        )

    return (
        long(length_stats(hist), "stats", None)
        .unionByName(long(length_percentiles(hist), "percentile", "percentile"))
        .unionByName(long(length_coverage(hist), "coverage", "context_length"))
        .unionByName(long(length_recommend(hist), "recommend", "target"))
    )
