"""Counts and length statistics.

Length statistics are taken from a histogram (length, rows). Building it is the
only pass over the data; it combines inside each task, and it has one row per
distinct length, so everything after it is small however many rows there are.

Where values are not bounded as lengths are, so that a histogram could have as
many rows as the data, quantiles come from sketches of a fixed size with a stated
rank error. Sketches can be stored, and merged later.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.params import CONTEXT_LENGTHS, PERCENTILES


def stage_counts(df: DataFrame, **stages: Column) -> DataFrame:
    """(stage, n) for several conditions in one scan; ``all`` counts every row."""
    rows = [F.struct(F.lit("all").alias("stage"), F.count(F.lit(1)).alias("n"))]
    rows += [
        F.struct(F.lit(name).alias("stage"), F.count_if(condition).alias("n"))
        for name, condition in stages.items()
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def length_histogram(df: DataFrame, length: Column) -> DataFrame:
    """(length, rows)."""
    return (
        df.select(length.cast("bigint").alias("length"))
        .groupBy("length")
        .agg(F.count("*").alias("rows"))
    )


def length_stats(hist: DataFrame) -> DataFrame:
    """count, mean, median, population deviation, min and max of the lengths."""
    n, rows = F.col("length"), F.col("rows")
    moments = hist.agg(
        F.sum("rows").alias("n"),
        F.sum(n * rows).alias("s1"),
        F.sum((n * n).cast("decimal(38,0)") * rows).alias("s2"),
        F.percentile("length", F.lit(0.5), F.col("rows")).alias("median"),
        F.min("length").alias("min_length"),
        F.max("length").alias("max_length"),
    )
    mean = F.col("s1") / F.col("n")
    spread = F.col("s2").cast("double") / F.col("n") - mean * mean
    return moments.select(
        "n",
        mean.alias("mean_length"),
        F.col("median").alias("median_length"),
        F.sqrt(F.greatest(spread, F.lit(0.0))).alias("std_length"),
        "min_length",
        "max_length",
    )


def length_percentiles(
    hist: DataFrame, percentiles: tuple[float, ...] = PERCENTILES
) -> DataFrame:
    """(percentile, length, coverage): exact, linearly interpolated values and
    the share of rows not longer than each, in percent."""
    shares = F.array(*[F.lit(p / 100.0) for p in percentiles])
    values = hist.agg(F.percentile("length", shares, F.col("rows"))).scalar()
    at = [F.get("v", F.lit(k)) for k in range(len(percentiles))]
    rows = F.array(
        *[
            F.struct(
                F.lit(p).cast("int").alias("percentile"),
                F.max(v).alias("length"),
                (
                    F.sum(F.when(F.col("length") <= v, F.col("rows")).otherwise(0))
                    / F.sum("rows")
                    * 100.0
                ).alias("coverage"),
            )
            for p, v in zip(percentiles, at)
        ]
    )
    return (
        hist.withColumn("v", values).agg(rows.alias("out")).select(F.inline("out"))
    )


def length_coverage(
    hist: DataFrame, context_lengths: tuple[int, ...] = CONTEXT_LENGTHS
) -> DataFrame:
    """Per context length: share that fits, rows and share cut, and the mean
    number of tokens cut over all rows."""
    n, rows, total = F.col("length"), F.col("rows"), F.sum("rows")
    out = []
    for limit in context_lengths:
        fits = F.sum(F.when(n <= limit, rows).otherwise(0))
        out.append(
            F.struct(
                F.lit(limit).alias("context_length"),
                (fits / total * 100.0).alias("coverage"),
                (total - fits).alias("n_truncated"),
                ((total - fits) / total * 100.0).alias("truncated"),
                (F.sum(F.greatest(n - limit, F.lit(0)) * rows) / total).alias("mean_excess"),
            )
        )
    return hist.agg(F.array(*out).alias("out")).select(F.inline("out"))


def length_recommend(
    hist: DataFrame,
    targets: tuple[float, ...] = (0.90, 0.95),
) -> DataFrame:
    """(target, length): the length that covers each target share of rows."""
    values = F.percentile("length", F.array(*[F.lit(t) for t in targets]), F.col("rows"))
    rows = F.array(
        *[
            F.struct(F.lit(t).alias("target"), F.get("v", F.lit(k)).alias("length"))
            for k, t in enumerate(targets)
        ]
    )
    return hist.agg(values.alias("v")).select(F.inline(rows))


SKETCH_SIZE = 4096


def rank_error(k: int = SKETCH_SIZE) -> float:
    """How far the rank of a quantile from a sketch of size ``k`` can be off, as a
    share of all rows, with 99 percent confidence. Up to ``k`` rows it is exact."""
    return 2.296 / k**0.9021


def value_sketches(
    df: DataFrame, value: Column, groups: tuple[str, ...] = (), k: int = SKETCH_SIZE
) -> DataFrame:
    """(groups, sketch, rows): a summary of the whole numbers in ``value``.

    Its size depends on ``k`` alone, however many values there are: each task
    makes one per group, and these are merged. Nulls are left out; groups of
    nulls only, and no rows at all, give a null sketch and no rows.
    """
    rows = df.select(*groups, value.cast("bigint").alias("_v"))
    return _summed(rows.groupBy(*groups), F.kll_sketch_agg_bigint("_v", F.lit(k)), F.count("_v"))


def merge_sketches(sketches: DataFrame, groups: tuple[str, ...] = (), k: int = SKETCH_SIZE) -> DataFrame:
    """Sketches of parts, stored at any time, as sketches of ``groups``."""
    full = sketches.where(F.col("rows") > 0)
    return _summed(full.groupBy(*groups), F.kll_merge_agg_bigint("sketch", F.lit(k)), F.sum("rows"))


def _summed(grouped, sketch: Column, rows: Column) -> DataFrame:
    found = grouped.agg(sketch.alias("sketch"), F.coalesce(rows, F.lit(0)).alias("rows"))
    return found.withColumn("sketch", F.when(F.col("rows") > 0, F.col("sketch")))


def sketch_percentiles(
    sketches: DataFrame, groups: tuple[str, ...] = (), percentiles: tuple[float, ...] = PERCENTILES
) -> DataFrame:
    """(groups, percentile, value): values whose rank is the percentile's, within
    :func:`rank_error`; null without rows."""
    cells = [
        F.struct(
            F.lit(float(p)).alias("percentile"),
            F.when(
                F.col("sketch").isNotNull(), F.kll_sketch_get_quantile_bigint("sketch", F.lit(p / 100.0))
            ).alias("value"),
        )
        for p in percentiles
    ]
    return sketches.select(*groups, F.inline(F.array(*cells)))


def label_stats(df: DataFrame, mask: Column) -> DataFrame:
    """Rows, trainable tokens, and rows without any trainable token."""
    trained = F.aggregate(mask, F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    return df.select(trained.alias("t"), F.size(mask).alias("n")).agg(
        F.count("*").alias("n_rows"),
        F.sum("n").alias("n_tokens"),
        F.sum("t").alias("n_trainable"),
        F.count_if(F.col("t") == 0).alias("n_untrainable_rows"),
    )


def epoch_steps(df: DataFrame, batch: int, accumulate: int = 1, workers: int = 1) -> DataFrame:
    """Optimizer steps of one pass over the rows."""
    effective = batch * accumulate * workers
    return df.agg(F.count("*").alias("n_rows")).select(
        "n_rows",
        F.lit(effective).cast("bigint").alias("effective_batch"),
        F.ceil(F.col("n_rows") / effective).alias("steps"),
    )


def vector_mean(df: DataFrame, column: str = "embedding") -> DataFrame:
    """(pos, mean): mean of every vector component that is not null.

    Every task adds up its vectors and hands on one row per component.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(0), np.zeros(0, np.int64)
        for batch in batches:
            offsets = batch.column(0).offsets.to_numpy()
            values = batch.column(0).flatten()
            sizes = np.where(batch.column(0).is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0)
            begins = np.cumsum(sizes) - sizes
            at = np.arange(len(values)) - np.repeat(begins, sizes)
            there = values.is_valid().to_numpy(zero_copy_only=False)
            width = max(len(sums), int(sizes.max(initial=0)))
            x = values.fill_null(0).to_numpy(zero_copy_only=False)
            sums = np.pad(sums, (0, width - len(sums))) + np.bincount(at, x, width)
            counts = np.pad(counts, (0, width - len(counts))) + np.bincount(at[there], minlength=width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(sums)), pa.int32()), pa.array(sums), pa.array(counts)],
            names=["pos", "s", "n"],
        )

    vectors = df.select(F.col(f"`{column}`").cast("array<double>").alias("v"))
    parts = vectors.mapInArrow(run, "pos int, s double, n long")
    return parts.groupBy("pos").agg(F.try_divide(F.sum("s"), F.sum("n")).alias("mean"))


def new_vector(df: DataFrame, column: str = "embedding", scale: float = 0.01, seed: int = 42) -> DataFrame:
    """(pos, value): the mean vector plus seeded normal noise.

    The noise is a Box-Muller draw from a hash of the component's position, so
    it repeats whatever the partitioning.
    """

    def uniform(salt: str) -> Column:
        text = F.concat_ws(":", F.lit(str(seed)), F.lit(salt), F.col("pos").cast("string"))
        return (F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") + 1) / float(
            16**12 + 1
        )

    noise = F.sqrt(-2 * F.log(uniform("a"))) * F.cos(2 * F.pi() * uniform("b"))
    return vector_mean(df, column).select("pos", (F.col("mean") + scale * noise).alias("value"))


def marker_audit(
    df: DataFrame, text: Column, ids: Column, text_marker: str, id_marker: int
) -> DataFrame:
    """Rows whose text and whose token ids hold a marker, over all rows."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(text.contains(text_marker)).alias("n_text_marker"),
        F.count_if(F.array_contains(ids, id_marker)).alias("n_id_marker"),
    )


def padding_waste(
    sized: DataFrame, batch_rows: int, max_length: int, multiple: int = 64
) -> DataFrame:
    """(split, n_rows, n_batches, n_tokens, n_cells, waste) of padded batches.

    Takes (split, idx, n_tokens), rows numbered by split; no array is built, so
    this tells what padding would cost before anything is padded or packed.
    Rows are cut to ``max_length``, a batch is padded to its longest row, rounded
    up to ``multiple``; ``waste`` is the share of cells that hold padding.
    """
    n = F.least(F.col("n_tokens"), F.lit(max_length)).cast("bigint")
    batch = F.floor(F.col("idx") / batch_rows).cast("bigint")
    batches = (
        sized.groupBy("split", batch.alias("batch"))
        .agg(F.count("*").alias("rows"), F.sum(n).alias("tokens"), F.max(n).alias("longest"))
        .withColumn("cells", F.col("rows") * (F.ceil(F.col("longest") / multiple) * multiple).cast("bigint"))
    )
    return batches.groupBy("split").agg(
        F.sum("rows").alias("n_rows"),
        F.count("*").alias("n_batches"),
        F.sum("tokens").alias("n_tokens"),
        F.sum("cells").alias("n_cells"),
    ).withColumn("waste", _waste())


def packing_waste(bins: DataFrame, max_length: int) -> DataFrame:
    """The same of packed rows, from where :func:`~weftline.operators.packing.assign_bins`
    puts each row; a bin is a row of ``max_length`` cells."""
    place = ["split", "shard", "chunk", "bin"]
    sums = bins.groupBy(*place).agg(F.count("*").alias("rows"), F.sum("n_tokens").alias("tokens"))
    return sums.groupBy("split").agg(
        F.sum("rows").alias("n_rows"),
        F.count("*").alias("n_batches"),
        F.sum("tokens").alias("n_tokens"),
        (F.count("*") * max_length).cast("bigint").alias("n_cells"),
    ).withColumn("waste", _waste())


def _waste() -> Column:
    return F.when(F.col("n_cells") > 0, 1 - F.col("n_tokens") / F.col("n_cells"))


def pack_stats(packed: DataFrame, max_length: int) -> DataFrame:
    """Rows in and out of packing, their ratio, and the share of real tokens."""
    return packed.agg(
        F.sum("n_rows").alias("n_input"),
        F.count("*").alias("n_packed"),
        F.sum("n_tokens").alias("n_tokens"),
    ).select(
        F.coalesce("n_input", F.lit(0)).alias("n_input"),
        "n_packed",
        F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"),
        F.when(F.col("n_packed") > 0, F.col("n_input") / F.col("n_packed")).alias("ratio"),
        F.when(
            F.col("n_packed") > 0, F.col("n_tokens") / (F.col("n_packed") * max_length)
        ).alias("fill"),
    )
