"""Exact-size, repeatable sampling and splitting.

Sizes are exact and results do not depend on partitioning: a row's place is
decided by the hash of its key, never by a random generator per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators.indexing import (
    cutoffs,
    dense_index,
    gather,
    hash_draw,
    order_key,
)
from weftline.params import BALANCE_POLICY, TaskLimit


def take_exact(df: DataFrame, keys: list[str], k: int, seed: int = 42) -> DataFrame:
    """``min(k, n)`` rows without replacement."""
    cut = cutoffs(df, keys, seed, lambda n: F.lit(k)).scalar()
    return df.where(order_key(seed, *keys) <= cut)


def split_train_eval(
    df: DataFrame,
    keys: list[str],
    test_size: float = 0.05,
    seed: int = 42,
    population: DataFrame | None = None,
    fixed: bool = False,
) -> DataFrame:
    """Add ``split``: exactly ``ceil(test_size * n)`` rows are ``validation``.

    ``population`` holds the keys to split when ``df`` is a part of them or has
    several rows per key. ``fixed`` finds the one cutoff key now, so that
    several jobs over the result do not each look for it.
    """
    found = cutoffs(
        df if population is None else population,
        keys,
        seed,
        lambda n: F.ceil(n * F.lit(float(test_size))),
    )
    if fixed:
        row = found.first()
        cut = F.lit(row["cutoff"] if row else None).cast("string")
    else:
        cut = found.scalar()
    is_eval = F.coalesce(order_key(seed, *keys) <= cut, F.lit(False))
    return df.withColumn(
        "split", F.when(is_eval, F.lit("validation")).otherwise(F.lit("train"))
    )


def _draws(df: DataFrame, targets: dict[str, int]) -> DataFrame:
    """(task, draw): one row per row to be drawn, made in parallel."""
    spark = df.sparkSession
    frames = [
        spark.range(n).select(F.lit(task).alias("task"), F.col("id").alias("draw"))
        for task, n in targets.items()
    ]
    return reduce(DataFrame.unionAll, frames)


def _wanted(targets: dict[str, int]) -> Column:
    """The target of a row's task; null where there is none."""
    if not targets:
        return F.lit(None).cast("int")
    table = F.create_map(*[F.lit(x) for kv in targets.items() for x in kv])
    return F.try_element_at(table, F.col("task"))


def balance(
    df: DataFrame,
    keys: list[str],
    policy: dict[str, TaskLimit] | None = None,
    seed: int = 42,
    marks: DataFrame | None = None,
) -> DataFrame:
    """Apply a policy to rows classified by ``task``; adds ``draw``.

    Classes above ``max_rows`` are cut down without replacement, by comparing
    each row's key with the class's cutoff: kept rows do not move. Classes
    below ``min_rows`` are drawn up to it with replacement; an empty class
    stays empty. Others come back whole. A null ``draw`` marks a row taken
    once, a number the draw that chose it.

    ``marks`` may hold just the keys and tasks of ``df``, already written
    somewhere; classes are then counted and ranked there and ``df`` itself is
    read once per kind of result only.
    """
    policy = BALANCE_POLICY if policy is None else policy
    most = {t: p.max_rows for t, p in policy.items() if p.max_rows is not None}
    least = {t: p.min_rows for t, p in policy.items() if p.min_rows is not None}
    marks = (df if marks is None else marks).select(*keys, "task")

    # At most one row per task of the policy, whatever other tasks there are.
    ruled = F.col("task").isin(*policy)
    sizes = marks.where(ruled).groupBy("task").agg(F.count("*").alias("class_size"))
    short = F.coalesce(F.col("class_size") < _wanted(least), F.lit(False))
    rules = sizes.select("task", short.alias("_short"))
    if most:
        cut = cutoffs(
            marks.where(F.col("task").isin(*most)),
            ["task", *keys],
            seed,
            lambda n: _wanted(most),
            groups=("task",),
        )
        rules = rules.join(cut, "task", "left")
    else:
        rules = rules.withColumn("cutoff", F.lit(None).cast("string"))
    uncapped = ~F.col("task").isin(*most) if most else F.lit(True)
    within = F.coalesce(order_key(seed, "task", *keys) <= F.col("cutoff"), F.lit(False))
    once = (
        df.join(F.broadcast(rules), "task", "left")
        .where(~F.coalesce("_short", F.lit(False)) & (uncapped | within))
        .select(*df.columns, F.lit(None).cast("bigint").alias("draw"))
    )
    if not least:
        return once

    few = F.broadcast(sizes.where(short))
    in_least = F.col("task").isin(*least)
    pool = df.where(in_least).join(few.select("task"), "task")
    indexed = dense_index(
        pool,
        ["task", *keys],
        seed,
        groups=("task",),
        population=marks.where(in_least).join(few.select("task"), "task"),
    )
    drawn = (
        _draws(df, least)
        .join(few, "task")
        .withColumn("idx", hash_draw(seed, F.col("class_size"), F.col("task"), F.col("draw")))
        .select("task", "draw", "idx")
    )
    return once.unionByName(
        gather(drawn, indexed, groups=("task",)).select(*df.columns, "draw")
    )


def upsample(df: DataFrame, keys: list[str], targets: dict[str, int], seed: int = 42) -> DataFrame:
    """Draw classes that are below their target up to it, with replacement."""
    return balance(df, keys, {t: TaskLimit(min_rows=n) for t, n in targets.items()}, seed)


def downsample(df: DataFrame, keys: list[str], targets: dict[str, int], seed: int = 42) -> DataFrame:
    """Cut classes above their target down to it, without replacement."""
    policy = {t: TaskLimit(max_rows=n) for t, n in targets.items()}
    return balance(df, keys, policy, seed).drop("draw")


def upsample_ratio(n: Column, target: Column) -> Column:
    """Target over current size; null for an empty class."""
    return F.when(n > 0, target / n)
