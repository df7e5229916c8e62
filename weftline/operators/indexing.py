"""Positions without a global sort: dense index, shuffle, gather, chunks.

Order comes from an *order key*, the md5 of a seed and a unique row key, so it
does not depend on how the input is partitioned. The key's leading hex digits
cut the table into buckets of near-equal size. Rows are numbered inside their
bucket and shifted by the number of rows in earlier buckets: one shuffle of the
rows plus a count per bucket, and no task that sees the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.session import staged

KEY = "_order_key"
BUCKET = "_bucket"
HEX_DIGITS = 4  # 65,536 buckets: about 1.5 GB each when 100 TB are numbered


def order_key(seed: int | str, *keys: str) -> Column:
    """Text that sorts like a seeded random permutation of the rows.

    Each key part carries its length, and a null part is told from an empty
    one, so different keys never have the same text before it is hashed.
    """
    parts = [F.col(k).cast("string") for k in keys]
    told = [F.concat(F.lit(":"), F.length(p).cast("string"), F.lit("="), p) for p in parts]
    return F.md5(F.concat(F.lit(str(seed)), *[F.coalesce(x, F.lit(":")) for x in told]))


def with_order_key(df: DataFrame, keys: list[str], seed: int, digits: int = HEX_DIGITS) -> DataFrame:
    keyed = df.withColumn(KEY, order_key(seed, *keys))
    return keyed.withColumn(BUCKET, F.substring(KEY, 1, digits))


def bucket_counts(keyed: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, bucket, n, before, total): row counts with their running sum.

    At most 16**digits rows per group, whatever the table's size; the counts
    combine inside each task before they are shuffled.
    """
    return running_counts(keyed.groupBy(*groups, BUCKET).agg(F.count("*").alias("n")), groups)


def running_counts(counts: DataFrame, groups: list[str]) -> DataFrame:
    """Add ``before`` and ``total`` to (groups, bucket, n)."""
    whole = Window.partitionBy(*groups) if groups else Window.partitionBy()
    earlier = whole.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        *groups,
        BUCKET,
        "n",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.sum("n").over(whole).alias("total"),
    )


def dense_index(
    df: DataFrame,
    keys: list[str],
    seed: int = 42,
    groups: tuple[str, ...] = (),
    out: str = "idx",
    total: str | None = None,
    population: DataFrame | None = None,
    digits: int = HEX_DIGITS,
) -> DataFrame:
    """Number rows 0..n-1 in seeded order, per group if ``groups`` is given.

    ``keys`` must be unique within a group. The numbering window and the join
    with the bucket offsets share one hash partitioning, so the rows move once.
    ``population`` may give the same keys from a cheaper source to count them.
    """
    groups = list(groups)
    keyed = with_order_key(df, keys, seed, digits)
    inside = Window.partitionBy(*groups, BUCKET).orderBy(KEY, *keys)
    numbered = keyed.withColumn("_rn", F.row_number().over(inside))
    counted = with_order_key(df if population is None else population, keys, seed, digits)
    offsets = bucket_counts(counted, groups).drop("n")
    joined = numbered.join(offsets, [*groups, BUCKET])
    extra = [F.col("total").alias(total)] if total else []
    return joined.select(
        *df.columns, (F.col("before") + F.col("_rn") - 1).cast("bigint").alias(out), *extra
    )


def seeded_shuffle(
    df: DataFrame, keys: list[str], seed: int = 42, partitions: int | None = None
) -> DataFrame:
    """A reproducible permutation: partitions and rows in order-key order.

    Order keys are uniform, so a row's partition follows from its key. A sort
    would first read all rows once more to sample its ranges. The adaptive
    planner does not change their number, so ``partitions``, or the session's
    shuffle partitions, must suit the table: 128 to 256 MB in each are right.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = with_order_key(df, keys, seed)
    bucket = F.conv(BUCKET, 16, 10).cast("bigint")
    target = F.floor(bucket * n / 16**HEX_DIGITS).cast("int")
    return keyed.repartitionById(n, target).sortWithinPartitions(KEY, *keys).select(*df.columns)


def head_rows(df: DataFrame, order: list[str], k: int) -> DataFrame:
    """First ``k`` rows of an order; each task keeps ``k`` candidates at most."""
    return df.orderBy(*order).limit(k)


def gather(
    draws: DataFrame, indexed: DataFrame, groups: tuple[str, ...] = (), idx: str = "idx"
) -> DataFrame:
    """Rows at the drawn positions, repeats included.

    Positions are spread evenly by the hash that draws them. A position can be
    hot only when there are few rows to draw from, and then that side is small
    enough for the adaptive planner to broadcast it after measuring it.
    """
    return draws.join(indexed, [*groups, idx])


def hash_draw(seed: int, n: Column, *parts: Column) -> Column:
    """A repeatable uniform draw from 0..n-1."""
    text = F.concat_ws(":", F.lit(str(seed)), *(p.cast("string") for p in parts))
    number = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    return number % n


def assign_chunks(
    indexed: DataFrame,
    num_shards: int = 64,
    chunk_rows: int = 10_000,
    idx: str = "idx",
    total: str = "total",
) -> DataFrame:
    """Add ``shard`` and ``chunk``: contiguous shards cut into row batches.

    The first ``n mod num_shards`` shards hold one row more than the others.
    """
    n, i = F.col(total), F.col(idx)
    small, larger = F.floor(n / num_shards), n % num_shards
    edge = larger * (small + 1)
    shard = F.when(i < edge, F.floor(i / (small + 1))).otherwise(
        larger + F.floor((i - edge) / F.greatest(small, F.lit(1)))
    )
    with_shard = indexed.withColumn("shard", shard.cast("bigint"))
    return with_shard.withColumn(
        "chunk", F.floor(_place_in_shard(i, n, num_shards) / chunk_rows).cast("bigint")
    )


def _place_in_shard(i: Column, n: Column, num_shards: int) -> Column:
    s = F.col("shard")
    return i - (s * F.floor(n / num_shards) + F.least(s, n % num_shards))


def chunk_bounds(
    df: DataFrame,
    keys: list[str],
    seed: int,
    num_shards: int,
    chunk_rows: int,
    groups: tuple[str, ...] = (),
    digits: int = HEX_DIGITS,
) -> DataFrame:
    """(groups, bucket, bounds): the order keys at which chunks begin.

    Only order keys are shuffled and ranked, not the rows. ``bounds`` lists a
    bucket's first key and the first key of every chunk that begins in it, with
    shard and chunk: one entry per ``chunk_rows`` rows, and one per bucket.
    """
    groups = list(groups)
    light = with_order_key(df, keys, seed, digits).select(*groups, KEY, BUCKET)
    inside = Window.partitionBy(*groups, BUCKET)
    ranked = light.select(
        "*",
        F.row_number().over(inside.orderBy(KEY)).alias("_rn"),
        F.count("*").over(inside).alias("_n"),
    )
    # Read off the ranked keys, so both sides share one exchange.
    sizes = ranked.where(F.col("_rn") == F.col("_n")).select(
        *groups, BUCKET, F.col("_n").alias("n")
    )
    joined = ranked.join(running_counts(sizes, groups).drop("n"), [*groups, BUCKET])
    placed = assign_chunks(
        joined.withColumn("idx", F.col("before") + F.col("_rn") - 1), num_shards, chunk_rows
    )
    begins = (
        _place_in_shard(F.col("idx"), F.col("total"), num_shards) % chunk_rows == 0
    ) | (F.col("_rn") == 1)
    bound = F.struct(F.col(KEY).alias("key"), "shard", "chunk")
    return (
        placed.where(begins)
        .groupBy(*groups, BUCKET)
        .agg(F.sort_array(F.collect_list(bound)).alias("bounds"))
    )


def place_in_chunks(
    df: DataFrame,
    keys: list[str],
    seed: int,
    num_shards: int,
    chunk_rows: int,
    groups: tuple[str, ...] = (),
) -> DataFrame:
    """Add ``shard``, ``chunk`` and the order key, without moving the rows.

    Gives the chunks of :func:`dense_index` and :func:`assign_chunks`, but a
    row finds its chunk by comparing its key with the written chunk bounds, one
    row per bucket. The planner knows the size of that table, and joins it by
    broadcasting it or by shuffling, as it does with any other.
    """
    bounds = staged(
        chunk_bounds(df, keys, seed, num_shards, chunk_rows, groups), "bounds"
    )
    last = F.element_at(F.filter("bounds", lambda b: b["key"] <= F.col(KEY)), -1)
    return (
        with_order_key(df, keys, seed)
        .join(bounds, [*groups, BUCKET])
        .withColumn("_at", last)
        .select(*df.columns, KEY, F.col("_at.shard").alias("shard"), F.col("_at.chunk").alias("chunk"))
    )


def cutoffs(
    df: DataFrame,
    keys: list[str],
    seed: int,
    size: Callable[[Column], Column],
    groups: tuple[str, ...] = (),
    digits: int = HEX_DIGITS,
) -> DataFrame:
    """(groups, cutoff): the order key of the last of the first ``k`` rows.

    ``size`` maps a group's row count to ``k``. Only the one bucket that the
    cut falls into is ranked; every other row is judged by its key alone, so
    taking an exact number of rows needs no shuffle of the rows. At most one
    row per group comes out, and none where ``k`` is zero. If several rows have
    the key at the cut, no number of them is exact: the job fails and says so.
    """
    groups = list(groups)
    keyed = with_order_key(df, keys, seed, digits).select(*groups, KEY, BUCKET)
    counts = bucket_counts(keyed, groups)
    k = F.least(size(F.col("total")).cast("bigint"), F.col("total"))
    edge = counts.where((F.col("before") < k) & (k <= F.col("before") + F.col("n"))).select(
        *groups, BUCKET, (k - F.col("before")).alias("_need")
    )
    inside = Window.partitionBy(*groups, BUCKET).orderBy(KEY)
    same = Window.partitionBy(*groups, BUCKET, KEY)
    ranked = keyed.join(F.broadcast(edge), [*groups, BUCKET]).select(
        "*", F.row_number().over(inside).alias("_rn"), F.count("*").over(same).alias("_same")
    )
    repeated = F.raise_error(F.concat(F.lit("several rows have one key, among "), F.lit(str(keys))))
    return ranked.where(F.col("_rn") == F.col("_need")).select(
        *groups, F.when(F.col("_same") > 1, repeated).otherwise(F.col(KEY)).alias("cutoff")
    )
