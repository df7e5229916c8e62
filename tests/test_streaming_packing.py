"""Packing a stream: equal to next-fit over the order of arrival, however it is cut."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest

from weftline.params import IGNORE_INDEX
from weftline.streaming import incremental
from weftline.streaming import packing as stream_packing

LIMIT, PAD = 12, 7


def next_fit(rows):
    """All but the last bin of (seq, ids) rows: (bin, n_rows, tokens)."""
    bins = [[0, []]]
    for _, ids in sorted(rows, key=lambda r: r[0]):
        ids = (ids or [])[:LIMIT]
        if len(bins[-1][1]) + len(ids) > LIMIT:
            bins.append([0, []])
        bins[-1][0] += 1
        bins[-1][1].extend(ids)
    return [(k, n, ids) for k, (n, ids) in enumerate(bins[:-1])]


@pytest.mark.parametrize("cuts", [[], [1], [40, 41, 100]])
def test_stream_equals_next_fit(spark, tmp_path, cuts):
    draw = random.Random(len(cuts))
    rows = [(draw.randrange(3), k, [draw.randrange(100, 999) for _ in range(draw.choice([0, 1, 3, 5, 12, 30]))]) for k in range(150)]
    rows[5] = (rows[5][0], 5, None)
    schema = "shard long, seq long, input_ids array<int>"
    for a, b in zip([0, *cuts], [*cuts, len(rows)]):
        part = rows[a:b]
        draw.shuffle(part)
        spark.createDataFrame(part, schema).repartition(3).write.mode("append").parquet(str(tmp_path / "in"))
        # The query ends and starts anew after each delivery.
        stream = incremental.read_new_files(spark, str(tmp_path / "in"), schema)
        packed = stream_packing.pack_stream(stream, "shard", "seq", LIMIT, PAD)
        stream_packing.append_packed(packed, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = {}
    for r in spark.read.parquet(str(tmp_path / "out")).collect():
        n = r.n_tokens
        assert len(r.input_ids) == LIMIT and r.input_ids[n:] == [PAD] * (LIMIT - n)
        assert r.labels == r.input_ids[:n] + [IGNORE_INDEX] * (LIMIT - n)
        assert r.attention_mask == [1] * n + [0] * (LIMIT - n)
        got.setdefault(r.shard, []).append((r.bin, r.n_rows, r.input_ids[:n]))
    want = {s: next_fit([(k, ids) for t, k, ids in rows if t == s]) for s in range(3)}
    assert {s: sorted(b) for s, b in got.items()} == want


def test_shards_are_even_and_repeat(spark):
    df = spark.range(2000)
    shards = df.select(stream_packing.shard_of(df.id, 5).alias("s")).groupBy("s").count().collect()
    assert sorted(r.s for r in shards) == list(range(5)) and min(r["count"] for r in shards) > 300


def test_a_task_does_not_hold_its_shard():
    """48 MB of ids in random order, of which a few are in memory at a time."""
    draw, n_frames, rows, size = np.random.default_rng(3), 120, 100, 1000
    seqs = draw.permutation(n_frames * rows).reshape(n_frames, rows)

    class State:
        exists = False

        def update(self, value):
            self.value = value

    def frames():
        for s in seqs:
            yield pd.DataFrame({"seq": s, "ids": [np.full(size, x, np.int32).tobytes() for x in s]})

    state, found = State(), []
    tracemalloc.start()
    for part in stream_packing._pack(2 * size + 1)((5,), frames(), state):
        for number, n, data in zip(part["bin"], part["n_rows"], part["ids"]):
            ids = np.frombuffer(data, np.int32)
            found.append((number, n, int(ids[0]), int(ids[-1])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    last = n_frames * rows // 2 - 1
    assert found == [(k, 2, 2 * k, 2 * k + 1) for k in range(last)]
    assert state.value[:2] == (last, 2) and len(state.value[2]) == 2 * size
    assert peak < 24 << 20
