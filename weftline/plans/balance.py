"""From mixed chats to an exact task mix."""

from __future__ import annotations

from pyspark.sql import DataFrame

from weftline.operators.filters import classify_tasks, task_counts, valid_chats
from weftline.operators.indexing import seeded_shuffle
from weftline.operators.sampling import balance
from weftline.operators.setops import union_drifted
from weftline.params import TaskLimit
from weftline.session import staged


def balanced_dataset(
    frames: list[DataFrame],
    keys: list[str],
    policy: dict[str, TaskLimit] | None = None,
    seed: int = 42,
    ordered: bool = True,
    stage: bool = True,
    stage_chats: bool = False,
) -> DataFrame:
    """Union, validate, classify and sample to the policy's sizes.

    ``keys`` identify a chat across the frames. A row of the result is
    identified by ``keys``, ``task`` and ``draw``. With ``stage`` the keys and
    tasks, a sliver of the chats, are written to the shared folder first, so
    the chats are not read again for every count. ``stage_chats`` writes the
    chats as well: for frames that are costly to make, such as chats gathered
    from a log, and not for tables as they are stored.
    """
    classified = classify_tasks(valid_chats(union_drifted(frames, keys)))
    if stage_chats:
        classified = staged(classified, "chats")
    marks = staged(classified.select(*keys, "task"), "marks") if stage else None
    mixed = balance(classified, keys, policy, seed, marks)
    return seeded_shuffle(mixed, [*keys, "task", "draw"], seed) if ordered else mixed


def balance_audit(balanced: DataFrame) -> DataFrame:
    """Task counts of a balanced table, found anew from its chats."""
    return task_counts(valid_chats(balanced))
