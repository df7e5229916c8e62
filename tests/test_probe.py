"""Sources of which some files cannot be read."""

from __future__ import annotations

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from weftline.errors import SourceError
from weftline.sources import probe, readers

ROWS = 40


def files_of(folder: Path) -> list[Path]:
    return sorted(folder.glob("**/part-*.parquet"))


def put(file: Path, content: bytes) -> None:
    """New content, without the checksum that a local file system keeps beside it."""
    file.write_bytes(content)
    (file.parent / f".{file.name}.crc").unlink(missing_ok=True)


@pytest.fixture()
def parts(spark, tmp_path):
    """Six parts of a table in a folder whose name has to be encoded."""
    folder = tmp_path / "a b%20c"
    df = spark.range(6 * ROWS).select("id", F.repeat(F.md5(F.col("id").cast("string")), 60).alias("text"))
    df = df.withColumns({"part": F.col("id") % 6, "tags": F.create_map(F.lit("a"), "id")})
    df.repartition("part").write.partitionBy("part").parquet(str(folder))
    return folder


def test_sound_files_are_all_read(spark, parts):
    for deep in (False, True):
        got = probe.probe_files(spark, {"s": str(parts), "none": str(parts / "none")}, deep).collect()
        assert sorted((r.source, r.rows, r.reason) for r in got) == [("s", ROWS, None)] * 6
    df = probe.read_sound_files(spark, str(parts), probe.probe_files(spark, {"s": str(parts)}), "s")
    assert df.count() == 6 * ROWS and "file_path" not in df._jdf.queryExecution().toString()


def test_broken_files_are_left_out_and_named(spark, parts):
    cut, pages, empty, kind = files_of(parts)[:4]
    put(cut, cut.read_bytes()[:-50])
    content = bytearray(pages.read_bytes())
    for i in range(400, len(content) // 2):
        content[i] ^= 0x5A
    put(pages, bytes(content))
    put(empty, b"")
    spark.range(3).select(F.lit("x").alias("id"), F.lit("y").alias("text")).coalesce(1).write.parquet(str(parts / "new"))
    shutil.copy(files_of(parts / "new")[0], kind)
    (kind.parent / f".{kind.name}.crc").unlink()
    shutil.rmtree(parts / "new")
    (parts / "part=5" / "_hidden").write_bytes(b"not a data file")
    got = probe.probe_files(spark, {"s": str(parts)}, deep=True)
    by_part = {r.file.split("part=")[1][0]: (r.rows, r.reason is None) for r in got.collect()}
    lost, kept = (None, False), (ROWS, True)
    # No scan opens a file of no bytes.
    assert by_part == {"0": lost, "1": lost, "3": lost, "4": kept, "5": kept}
    assert got.where("reason is not null").count() == 3
    df = probe.read_sound_files(spark, str(parts), got, "s")
    assert sorted(r.part for r in df.select("part").collect()) == [4] * ROWS + [5] * ROWS
    assert df.select("id", "text", "tags").where("id % 6 = part").count() == 2 * ROWS


def test_footers_alone_do_not_show_broken_pages(spark, parts):
    pages = files_of(parts)[0]
    content = bytearray(pages.read_bytes())
    for i in range(400, len(content) // 2):
        content[i] ^= 0x5A
    put(pages, bytes(content))
    shallow = probe.probe_files(spark, {"s": str(parts)})
    assert shallow.where("reason is null").count() == 6
    deep = probe.probe_files(spark, {"s": str(parts)}, deep=True)
    assert [r.rows for r in deep.where("reason is not null").collect()] == [None]


def test_files_without_rows_are_sound(spark, tmp_path):
    spark.range(0).write.parquet(str(tmp_path / "t"))
    got = probe.probe_files(spark, {"s": str(tmp_path / "t")}, deep=True)
    assert [(r.rows, r.reason) for r in got.collect()] == [(0, None)]
    assert probe.read_sound_files(spark, str(tmp_path / "t"), got, "s").collect() == []


def test_load_by_file(spark, parts, tmp_path):
    put(files_of(parts)[5], b"PAR1 not really PAR1")
    (tmp_path / "lost").mkdir()
    (tmp_path / "lost" / "part-0.parquet").write_bytes(b"nothing")
    paths = {"s": str(parts), "lost": str(tmp_path / "lost"), "absent": str(tmp_path / "absent")}
    loaded = readers.load_sources(spark, paths, lambda df, name: df.select("id"), by_file=True)
    assert loaded.union().count() == 5 * ROWS
    assert sorted(loaded.skipped) == ["absent", "lost"]
    rejects = loaded.rejects().collect()
    assert sorted(r.source for r in rejects) == ["lost", "s"] and all(r.reason for r in rejects)
    with pytest.raises(SourceError):
        readers.load_sources(spark, {"lost": paths["lost"]}, by_file=True)
    with pytest.raises(ValueError):
        readers.load_sources(spark, {"b": "/root/testdata/sf0.001/benchmark.parquet"}).rejects()
