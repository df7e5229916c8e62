"""Which files of a source can be read, found out in parallel before a long job.

One unreadable part file ends a job at run time, hours after its plan was made.
A probe opens every file's footer in the tasks of one scan, and with ``deep``
also decodes every row group, so what it costs is known: footers, or one read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.errors import SourceError
from weftline.session import staged

FILE = "_metadata.file_path"
PROBE = "source string, file string, rows long, reason string"
MOST_BYTES = 1 << 28  # a larger unreadable file is reported without a closer look


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, path, bytes) of every data file below ``path``; no content is read.

    ``file`` is the name that a scan gives its rows' file, in which signs such as
    spaces are encoded; ``path`` is what a reader takes.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.col(FILE).alias("file"), "path", F.col("length").alias("bytes"))


def source_schema(spark: SparkSession, path: str) -> T.StructType:
    """The schema of a source, partition columns included.

    It is that of the footer Spark looks at first, or, if that cannot be read,
    of the first file by path that can.
    """
    try:
        return spark.read.parquet(path).schema
    except AnalysisException:
        raise
    except Exception:  # the one footer that was looked at cannot be read
        for row in list_files(spark, path).select("path").orderBy("path").toLocalIterator():
            try:
                fields = spark.read.parquet(row["path"]).schema
            except Exception:
                continue
            return spark.read.schema(fields).parquet(path).schema
    raise SourceError(f"no file of {path} can be read")


def probe_files(
    spark: SparkSession, paths: dict[str, str], deep: bool = False
) -> DataFrame:
    """(source, file, rows, reason): every file of every source that exists.

    ``reason`` is null for files that can be read, and ``rows`` is their number
    of rows; else ``rows`` is null. Footers are opened by the scan itself, many
    at a time. ``deep`` decodes all columns too, and so finds row groups that
    are broken behind a sound footer, and columns of another type than the
    source has. Files without rows are readable; files of no bytes are opened by
    no scan, and not listed. Sources without any file, or that do not exist, have
    no rows here.
    """
    found = []
    for source, path in paths.items():
        try:
            listed = list_files(spark, path)
            schema = source_schema(spark, path)
        except AnalysisException:  # there is nothing at the path
            continue
        except SourceError:
            schema = None
        found.append(_probe(spark, source, path, listed, schema, deep))
    probe = spark.createDataFrame([], PROBE)
    for one in found:
        probe = probe.unionByName(one)
    return staged(probe, "probe")


def _probe(
    spark: SparkSession, source: str, path: str, listed: DataFrame, schema: T.StructType | None, deep: bool
) -> DataFrame:
    """The probe of one source, whose schema may be unknown for want of a readable file."""
    listed = listed.withColumn("source", F.lit(source))
    if schema is None:
        counts = spark.createDataFrame([], "file string, rows long, decoded long")
    else:
        rows = spark.read.schema(schema).option("ignoreCorruptFiles", "true").parquet(path)
        # Counting rows needs footers alone: no column is read.
        counts = rows.groupBy(F.col(FILE).alias("file")).agg(F.count("*").alias("rows"))
        if deep:
            decoded = rows.select(F.col(FILE).alias("file"), _every_value(schema).alias("h"))
            # A file that breaks off gives the rows before, so these are fewer.
            whole = decoded.groupBy("file").agg(F.count("*").alias("decoded"), F.max("h").alias("h"))
            # The hash is used, or no column would be read.
            counts = counts.join(whole, "file", "left").withColumn("decoded", F.when(F.col("h").isNotNull(), F.col("decoded")))
        else:
            counts = counts.withColumn("decoded", F.col("rows"))
    joined = staged(listed.join(counts, "file", "left"), "probed")
    sound = F.col("decoded").isNotNull() & (F.col("decoded") == F.col("rows"))
    good = joined.where(sound).select("source", "file", "rows", F.lit(None).cast("string").alias("reason"))
    # Files that gave no row, or too few: broken ones, and those that are empty.
    doubtful = joined.where(~F.coalesce(sound, F.lit(False)))
    return good.unionByName(_reasons(spark, doubtful, deep))


def _every_value(schema: T.StructType):
    """A hash that needs every column, so all of them are decoded."""
    names = [f.name for f in schema.fields]
    values = [F.to_json(F.struct(F.col(f"`{n}`"))) if _has_map(schema[n].dataType) else F.col(f"`{n}`") for n in names]
    return F.xxhash64(*values) if values else F.lit(0)


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType | T.VariantType):
        return True
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, T.StructType) and any(_has_map(f.dataType) for f in kind.fields)


def _reasons(spark: SparkSession, doubtful: DataFrame, deep: bool) -> DataFrame:
    """A closer look at the files that gave too few rows, each in a task of its own."""
    if not doubtful.head(1):
        return spark.createDataFrame([], PROBE)
    small = [r["path"] for r in doubtful.where(F.col("bytes") <= MOST_BYTES).select("path").collect()]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, reason = inspect_parquet(content.as_buffer(), deep)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([rows], pa.int64()), pa.array([reason], pa.string())],
                    names=["path", "rows", "reason"],
                )

    seen = "path string, rows long, reason string"
    looked = spark.createDataFrame([], seen)
    if small:
        content = spark.read.format("binaryFile").load(small).select("path", "content")
        looked = content.repartition(min(len(small), 200)).mapInArrow(look, seen)
    unsure = F.lit("fewer rows could be read than the file holds")
    return doubtful.select("source", "file", "path").join(looked, "path", "left").select(
        "source",
        "file",
        # A sound file without rows; one whose rows cannot be read as the source's is not sound.
        F.when(F.col("reason").isNull() & (F.col("rows") == 0), F.lit(0)).cast("bigint").alias("rows"),
        F.when(F.col("reason").isNull() & (F.col("rows") == 0), F.lit(None)).otherwise(
            F.coalesce("reason", unsure)
        ).alias("reason"),
    )


def inspect_parquet(content: pa.Buffer, deep: bool) -> tuple[int | None, str | None]:
    """Rows of a parquet file, or why it cannot be read."""
    try:
        file = pq.ParquetFile(pa.BufferReader(content))
        for group in range(file.num_row_groups if deep else 0):
            file.read_row_group(group)
        return file.metadata.num_rows, None
    except Exception as problem:
        return None, _first_line(problem)


def _first_line(problem: Exception) -> str:
    return (str(problem).splitlines() or [type(problem).__name__])[0][:200]


def read_sound_files(spark: SparkSession, path: str, probe: DataFrame, source: str) -> DataFrame:
    """The rows of a source's readable files; the others are not opened.

    The paths of unreadable files become a filter on the file's own path, which
    prunes them from the listing, so the plan grows with what is broken alone.
    """
    mine = probe.where(F.col("source") == source)
    bad = [r["file"] for r in mine.where(F.col("reason").isNotNull()).select("file").collect()]
    if not mine.where(F.col("reason").isNull()).head(1):
        raise SourceError(f"no file of {path} can be read")
    df = spark.read.schema(source_schema(spark, path)).parquet(path)
    return df.where(~F.col(FILE).isin(bad)) if bad else df
