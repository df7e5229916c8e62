"""Queries over the test tables, each beside the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The test tables of one scale, read on use."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def texts(self) -> DataFrame:
        """Documents as (doc_id, text)."""
        return self.documents.select("doc_id", "text")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def query(name: str, sql: str | None = None):
    """Register ``build(tables)`` under ``name``, with its SQL if there is one."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, root: build(Tables(spark, root))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def digest(items: Column) -> Column:
    """md5 of an array's items joined by commas."""
    return F.md5(F.array_join(items.cast("array<string>"), ","))


def chat_text(messages: Column) -> Column:
    """A chat as one text, to compare chats by."""
    return F.array_join(
        F.transform(messages, lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\n"
    )
