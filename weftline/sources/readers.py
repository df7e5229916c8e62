"""Reading datasets: by path, by partition, from several sources at once."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.errors import SourceError
from weftline.operators.setops import union_all
from weftline.params import DataParams
from weftline.sources.probe import probe_files, read_sound_files


def read_dataset(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    **partitions: str | None,
) -> DataFrame:
    """Read parquet; ``partitions`` (config, revision, split) prune directories."""
    df = spark.read.parquet(path)
    for name, value in partitions.items():
        if value is not None:
            df = df.where(F.col(name) == value)
    return df.select(*columns) if columns else df


def read_params(spark: SparkSession, params: DataParams) -> DataFrame:
    """Read what ``params`` names: a revision and split of a named dataset below
    ``dataset_path``, or that path itself."""
    if params.dataset_name:
        parts = [p for p in (params.dataset_path, params.dataset_name, params.data_dir) if p]
        df = spark.read.parquet(os.path.join(*parts))
        wanted = {"revision": params.dataset_revision, "split": params.dataset_split}
        for name, value in wanted.items():
            # A dataset without splits is its train split.
            if value is None or (name == "split" and value == "train" and name not in df.columns):
                continue
            if name not in df.columns:
                raise SourceError(f"{params.dataset_name} has no {name}, so none called {value!r}")
            df = df.where(F.col(name) == value)
        return df
    if params.dataset_path:
        return spark.read.parquet(params.dataset_path)
    raise ValueError("either dataset_name or dataset_path is needed")


def with_row_key(df: DataFrame, name: str = "row_key") -> DataFrame:
    """Add a key to a table as read from parquet: each row's file and its place there.

    It names the stored row, so it is the same under any partitioning and in any
    retry, as long as the files stay. Use it before anything but reading.
    """
    place = [F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string")]
    return df.select("*", F.concat_ws("#", *place).alias(name))


def spread(df: DataFrame) -> DataFrame:
    """``df``, its rows dealt out anew if its files keep most cores idle.

    A scan has no more busy tasks than its files have row groups, and costly
    work on the rows, such as encoding, follows the scan. Only where there are
    fewer files than cores are their footers read to see how many parts hold
    rows; larger tables are left as they are, and so are frames that do not come
    from parquet files.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    files = df.inputFiles()
    if not files or len(files) >= cores or not all(f.endswith(".parquet") for f in files):
        return df
    parts = spark.read.parquet(*files).select("_metadata.file_path", "_metadata.file_block_start")
    return df if parts.distinct().count() >= cores else df.repartition(cores)


@dataclass
class LoadedSources:
    """What could be read, by source name, and why the rest could not.

    ``probe`` says so for every file, where sources were read by file.
    """

    frames: dict[str, DataFrame] = field(default_factory=dict)
    skipped: dict[str, str] = field(default_factory=dict)
    probe: DataFrame | None = None

    def report(self, spark: SparkSession) -> DataFrame:
        """(source, loaded, reason), one row per source."""
        rows = [(name, True, None) for name in self.frames]
        rows += [(name, False, reason) for name, reason in self.skipped.items()]
        return spark.createDataFrame(rows, "source string, loaded boolean, reason string")

    def rejects(self) -> DataFrame:
        """(source, file, reason) of the files that were left out."""
        if self.probe is None:
            raise ValueError("only sources that are read by file have rejects")
        return self.probe.where(F.col("reason").isNotNull()).select("source", "file", "reason")

    def union(self, strict: bool = True) -> DataFrame:
        return union_all(list(self.frames.values()), strict=strict)


def load_sources(
    spark: SparkSession,
    paths: dict[str, str],
    prepare: Callable[[DataFrame, str], DataFrame] | None = None,
    by_file: bool = False,
    deep: bool = False,
) -> LoadedSources:
    """Read every source that can be read; raise only if none can.

    A source fails here when its files or columns are missing: reading its
    schema and planning ``prepare`` touch no rows. With ``by_file`` its files are
    probed first, and those that cannot be read are left out alone, see
    :func:`weftline.sources.probe.probe_files`; without, one broken file ends
    the job that reads it. Other errors are faults of the code, and are raised.
    """
    loaded = LoadedSources(probe=probe_files(spark, paths, deep) if by_file else None)
    for name, path in paths.items():
        try:
            if loaded.probe is None:
                df = spark.read.parquet(path)
            else:
                df = read_sound_files(spark, path, loaded.probe, name)
            if prepare is not None:
                df = prepare(df, name)
            df.schema  # noqa: B018 - resolves the plan, so a bad source fails now
            loaded.frames[name] = df
        except (AnalysisException, SourceError) as problem:
            loaded.skipped[name] = str(problem).splitlines()[0]
    if not loaded.frames:
        raise SourceError(f"no source could be read: {loaded.skipped}")
    return loaded


def chat_column(df: DataFrame) -> DataFrame:
    """Call the chat column ``messages``, also where it is ``conversations``."""
    if "messages" in df.columns:
        return df
    if "conversations" in df.columns:
        return df.withColumnRenamed("conversations", "messages")
    raise SourceError(f"no chat column in {df.columns}")


def chats_from_log(log: DataFrame) -> DataFrame:
    """Gather a message log (conv_id, turn, role, text) into one row per chat.

    A chat is one value of the data model, so this is for logs whose chats fit
    a row. ``weftline.operators.examples.examples_from_log`` builds training
    examples from a log without that assumption.
    """
    turn = F.struct("turn", "role", F.col("text").alias("content"))
    ordered = F.sort_array(F.collect_list(turn))
    return log.groupBy("conv_id").agg(
        F.transform(
            ordered, lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))
        ).alias("messages")
    )
