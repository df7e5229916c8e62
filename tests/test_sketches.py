"""Quantile sketches, vector sums and padding figures."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.operators import packing, profile

SHARES = (1, 25, 50, 75, 99)


def test_quantiles_of_many_distinct_values(spark):
    """Ten million different values: within the rank error, from a sketch of fixed size."""
    n, k = 10_000_000, 1024
    value = (F.col("id") * 7_919 + 3) % F.lit(n)  # every number below n once
    sketches = profile.value_sketches(spark.range(n, numPartitions=16), value, k=k)
    row = sketches.first()
    assert row["rows"] == n and len(row["sketch"]) < 64_000
    for r in profile.sketch_percentiles(sketches, percentiles=SHARES).collect():
        assert abs(r.value / n - r.percentile / 100) <= 2 * profile.rank_error(k)


def test_no_row_per_value_is_shuffled(spark):
    sketches = profile.value_sketches(spark.range(1000, numPartitions=5), F.col("id"))
    plan = sketches._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" in plan and "hashpartitioning" not in plan


def test_sketches_merge(spark):
    draw = np.random.default_rng(1)
    rows = [("abc"[g], int(v)) for g, v in zip(draw.integers(0, 3, 3000), draw.integers(0, 10**12, 3000))]
    df = spark.createDataFrame([*rows, ("a", None), ("d", None)], "g string, v long").withColumn("part", F.abs(F.hash("v")) % 4)
    parts = profile.value_sketches(df, F.col("v"), ("g", "part"))
    merged = profile.merge_sketches(parts, ("g",))
    assert {r.g: r.rows for r in merged.collect()} == {g: sum(x == g for x, _ in rows) for g in "abc"}
    # Fewer values than the sketch has room for: exact.
    for r in profile.sketch_percentiles(merged, ("g",), SHARES).collect():
        own = sorted(v for g, v in rows if g == r.g)
        below, upto = (np.searchsorted(own, r.value, side) / len(own) for side in ("left", "right"))
        assert below - 1e-9 <= r.percentile / 100 <= upto + 1e-9
    whole = profile.merge_sketches(merged)
    assert whole.first()["rows"] == len(rows)


def test_sketches_of_nothing(spark):
    none = spark.createDataFrame([], "v long")
    sketches = profile.value_sketches(none, F.col("v"))
    assert sketches.first()["rows"] == 0
    assert {r.value for r in profile.sketch_percentiles(sketches).collect()} == {None}
    assert profile.merge_sketches(sketches).first()["rows"] == 0


def test_vector_mean_of_uneven_vectors(spark):
    rows = [([1.0, 2.0, 3.0],), ([None, 4.0],), (None,), ([],), ([5.0],)]
    df = spark.createDataFrame(rows, "embedding array<float>").repartition(2)
    assert {r.pos: r["mean"] for r in profile.vector_mean(df).collect()} == {0: 3.0, 1: 3.0, 2: 3.0}
    assert profile.vector_mean(df.limit(0)).collect() == []
    only_null = spark.createDataFrame([([None],)], "embedding array<float>")
    assert profile.vector_mean(only_null).first()["mean"] is None


@pytest.mark.parametrize("batch_rows", [1, 4, 1000])
def test_padding_figures_equal_padded_rows(spark, batch_rows):
    draw = random.Random(batch_rows)
    rows = [("ab"[i % 2], i // 2, [1] * draw.randrange(1, 90)) for i in range(61)]
    df = spark.createDataFrame(rows, "split string, idx long, input_ids array<int>")
    cut = df.withColumn("input_ids", F.slice("input_ids", 1, 70))
    padded = packing.pad_batches(cut, batch_rows, pad_id=0, multiple=16)
    want = {}
    for r in padded.collect():
        n, tokens, cells = want.get(r.split, (0, 0, 0))
        want[r.split] = n + 1, tokens + sum(r.attention_mask), cells + len(r.input_ids)
    sized = df.select("split", "idx", F.size("input_ids").alias("n_tokens"))
    got = profile.padding_waste(sized, batch_rows, 70, 16).collect()
    assert {r.split: (r.n_rows, r.n_tokens, r.n_cells) for r in got} == want
    assert all(r.waste == pytest.approx(1 - r.n_tokens / r.n_cells) for r in got)


def test_packing_figures_equal_packed_rows(spark):
    draw = random.Random(9)
    rows = [("a", 0, i % 2, i, draw.randrange(1, 40)) for i in range(50)]
    sized = spark.createDataFrame(rows, "split string, shard long, chunk long, idx long, n_tokens long")
    full = sized.withColumn("input_ids", F.array_repeat(F.lit(1), F.col("n_tokens").cast("int")))
    packed = packing.pack_sequences(full, 32, 0).agg(F.count("*"), F.sum("n_rows"), F.sum("n_tokens")).first()
    (got,) = profile.packing_waste(packing.assign_bins(sized, 32), 32).collect()
    assert (got.n_batches, got.n_rows, got.n_tokens) == tuple(packed) and got.n_cells == 32 * got.n_batches
