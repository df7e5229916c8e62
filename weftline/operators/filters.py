"""Row predicates and task classification; every one is a native expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import is_nonblank
from weftline.functions.tokens import RegexTokenizer
from weftline.params import TASK_2_REQUIRED, TASK_TOKENS


def has_messages(messages: Column) -> Column:
    return F.coalesce(F.size(messages) > 0, F.lit(False))


def first_content(messages: Column) -> Column:
    return F.get(messages, F.lit(0))["content"]


def is_valid_chat(messages: Column) -> Column:
    """Has a message, and the first one's content is neither null nor empty."""
    return has_messages(messages) & (F.coalesce(first_content(messages), F.lit("")) != "")


def nonempty_messages(df: DataFrame, column: str = "messages") -> DataFrame:
    return df.where(has_messages(F.col(column)))


def valid_chats(df: DataFrame, column: str = "messages") -> DataFrame:
    return df.where(is_valid_chat(F.col(column)))


def with_token(df: DataFrame, token: str, column: str = "messages") -> DataFrame:
    """Chats whose first message holds ``token`` anywhere."""
    return df.where(first_content(F.col(column)).contains(token))


def is_complete_task2(content: Column) -> Column:
    return content.contains(TASK_2_REQUIRED[0]) & content.contains(TASK_2_REQUIRED[1])


def nonblank_text(df: DataFrame, column: str = "text") -> DataFrame:
    return df.where(is_nonblank(F.col(column)))


def nonempty_tokens(df: DataFrame, column: str = "input_ids") -> DataFrame:
    return df.where(F.size(column) > 0)


def nonempty_encoding(df: DataFrame, text: Column, tokenizer: RegexTokenizer) -> DataFrame:
    """Rows whose encoding is not empty, decided before anything is encoded."""
    return df.where(tokenizer.has_token(text))


def classify_tasks(
    df: DataFrame,
    column: str = "messages",
    tokens: dict[str, str] | None = None,
    complete_task2: bool = True,
) -> DataFrame:
    """One row per (chat, task token it holds), in a single scan.

    A chat with two tokens comes out twice, one without any not at all. With
    ``complete_task2`` a task 2 chat must hold both of its word-list markers.
    """
    tokens = tokens or TASK_TOKENS
    content = first_content(F.col(column))
    marks = []
    for task, token in tokens.items():
        hit = content.contains(token)
        if complete_task2 and task == "task_2":
            hit = hit & is_complete_task2(content)
        marks.append(F.when(hit, F.lit(task)))
    # The outer form spares the filter that the optimizer adds to the inner one,
    # which would search every text a second time.
    tasks = df.withColumn("task", F.explode_outer(F.array_compact(F.array(*marks))))
    return tasks.where(F.col("task").isNotNull())


def task_counts(
    df: DataFrame, column: str = "messages", tokens: dict[str, str] | None = None
) -> DataFrame:
    """(task, n, n_rejected) for every task, zeros included, in one scan.

    ``n_rejected`` counts task 2 chats that miss a word-list marker.
    """
    tokens = tokens or TASK_TOKENS
    content = first_content(F.col(column))
    sums = []
    for task, token in tokens.items():
        hit = content.contains(token)
        good = hit & is_complete_task2(content) if task == "task_2" else hit
        sums.append(
            F.struct(
                F.lit(task).alias("task"),
                F.count_if(good).alias("n"),
                F.count_if(hit & ~good).alias("n_rejected"),
            )
        )
    return df.agg(F.array(*sums).alias("rows")).select(F.inline("rows"))
