"""Rows of a stored table by position, without numbering or moving the others.

A table's rows have a place already: files in order of their paths, rows in the
order in which they are stored. An index with one row per file says at which
position a file begins; it is made from footers, and holds for as long as the
files stay as they are. Taking positions then opens only the files they are in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.session import staged

FILE, PLACE = "_metadata.file_path", "_metadata.row_index"
BLOCK = 1 << 20  # positions and files meet by blocks of so many positions


def positional_index(spark: SparkSession, path: str) -> DataFrame:
    """(file, first, rows): every file with rows, and the position of its first row.

    Write it if it is used again. No column is read, only footers; the running
    sum is over files, not rows.
    """
    files = spark.read.parquet(path).groupBy(F.col(FILE).alias("file")).agg(F.count("*").alias("rows"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("file", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("first"), "rows")


def locate(index: DataFrame, positions: DataFrame, position: str = "position") -> DataFrame:
    """(positions' columns, file, row): which row of which file each position is.

    Positions outside the table are left out; repeated ones stay repeated. Files
    and positions meet in blocks, so that neither side is compared with all of
    the other.
    """
    last = F.col("first") + F.col("rows") - 1
    blocks = F.sequence(F.floor(F.col("first") / BLOCK), F.floor(last / BLOCK))
    spread = index.select("file", "first", "rows", F.explode(blocks).alias("_block"))
    asked = positions.withColumn("_block", F.floor(F.col(f"`{position}`") / BLOCK))
    inside = (F.col(f"`{position}`") >= F.col("first")) & (F.col(f"`{position}`") < F.col("first") + F.col("rows"))
    met = asked.join(spread, "_block").where(inside)
    return met.select(*positions.columns, "file", (F.col(f"`{position}`") - F.col("first")).alias("row"))


def rows_at(
    spark: SparkSession, path: str, index: DataFrame, positions: DataFrame, position: str = "position"
) -> DataFrame:
    """The table's columns and ``position``, for each of ``positions``.

    The names of the files that are needed, no more than there are files, become
    a filter on the file's own path, which prunes the others from the listing.
    """
    # Written: read twice, and by its size the planner knows whether the table must move.
    found = staged(locate(index, positions.select(F.col(f"`{position}`").cast("bigint").alias(position)), position), "located")
    needed = [r["file"] for r in found.select("file").distinct().collect()]
    table = spark.read.parquet(path)
    rows = table.where(F.col(FILE).isin(needed)).select(
        F.struct(*[F.col(f"`{c}`") for c in table.columns]).alias("_data"), F.col(FILE).alias("_file"), F.col(PLACE).alias("_at")
    )
    at = (F.col("_file") == F.col("file")) & (F.col("_at") == F.col("row"))
    return rows.join(found, at).select("_data.*", F.col(position))
