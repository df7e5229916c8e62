"""Rows by position, opening only the files that hold them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weftline.sources import positions


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """Ten files of uneven length, one of them empty, and the values in stored order."""
    folder = tmp_path_factory.mktemp("rows here") / "t"
    sizes = [5, 1, 0, 40, 3, 17, 2, 9, 100, 6]
    at = 0
    for k, n in enumerate(sizes):
        rows = spark.range(at, at + n).select("id", (F.col("id") * 2).alias("_at"), F.lit("x").alias("file"))
        rows.coalesce(1).write.parquet(str(folder / f"part={k}"))
        at += n
    return str(folder), at


def test_index_covers_every_row(spark, table):
    path, n = table
    rows = sorted(positions.positional_index(spark, path).collect(), key=lambda r: r.first)
    assert [r.first for r in rows] == [sum(x.rows for x in rows[:k]) for k in range(len(rows))]
    assert sum(r.rows for r in rows) == n and len(rows) == 9


@pytest.mark.parametrize("block", [4, 1 << 20])
def test_rows_at(spark, table, block, monkeypatch):
    monkeypatch.setattr(positions, "BLOCK", block)
    path, n = table
    index = positions.positional_index(spark, path)
    asked = [0, 4, 5, 6, 45, n - 1, n - 1, n, -1, 10**9]
    df = spark.createDataFrame([(p,) for p in asked], "position long")
    got = positions.rows_at(spark, path, index, df).collect()
    assert sorted((r.position, r.id, r._at, r.file) for r in got) == sorted((p, p, 2 * p, "x") for p in asked if 0 <= p < n)
    assert positions.rows_at(spark, path, index, df.limit(0)).collect() == []


def test_other_files_are_not_opened(spark, tmp_path):
    for k in range(3):
        spark.range(10 * k, 10 * k + 10).coalesce(1).write.parquet(str(tmp_path / "t" / f"part={k}"))
    index = positions.positional_index(spark, str(tmp_path / "t"))
    kept = spark.createDataFrame(index.collect(), index.schema)
    broken = next((tmp_path / "t" / "part=1").glob("part-*.parquet"))
    size = broken.stat().st_size
    content = bytearray(broken.read_bytes())
    content[4 : size // 2] = bytes(size // 2 - 4)
    broken.write_bytes(bytes(content))
    (broken.parent / f".{broken.name}.crc").unlink()
    df = spark.createDataFrame([(3,), (27,)], "position long")
    assert sorted(r.id for r in positions.rows_at(spark, str(tmp_path / "t"), kept, df).collect()) == [3, 27]


def test_few_positions_do_not_move_the_table(spark, table):
    path, n = table
    asked = spark.createDataFrame([(3,), (n - 1,)], "position long")
    rows = positions.rows_at(spark, path, positions.positional_index(spark, path), asked)
    assert "Exchange hashpartitioning" not in rows._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.id for r in rows.collect()) == [3, n - 1]


def test_a_part_is_dealt_to_several_tasks(spark, tmp_path, monkeypatch):
    """No file, and so no task that wrote it, holds a whole part where a part is large."""
    from checks import q_tables
    from checks.registry import QUERIES

    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.md5(F.col("id").cast("string")).alias("text"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(q_tables, "scratch_path", lambda *_: str(tmp_path / "files"))
    adaptive = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(adaptive, "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        got = QUERIES["rows_at_positions"](spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset(adaptive)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    order = sorted(range(4000), key=lambda d: (d % 8, d))
    assert len(got) == 100 and all(order[r.position] == r.doc_id for r in got)
    index = positions.positional_index(spark, str(tmp_path / "files")).collect()
    assert len(index) >= 40 and max(r.rows for r in index) < 400
