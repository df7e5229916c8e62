"""Union of datasets, with and without equal schemas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from weftline.operators.project import align_chats


def require_same_columns(frames: list[DataFrame]) -> None:
    """Raise, naming the columns of both sides, unless all column sets agree."""
    first = frames[0]
    for other in frames[1:]:
        if set(first.columns) != set(other.columns):
            raise ValueError(
                f"columns differ: {sorted(first.columns)} against {sorted(other.columns)}"
            )


def union_all(frames: list[DataFrame], strict: bool = True) -> DataFrame:
    """UNION ALL by column name, without removing duplicates."""
    if not frames:
        raise ValueError("nothing to union")
    if strict:
        require_same_columns(frames)
    rows = [f.select("*") for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=not strict), rows)


def union_drifted(frames: list[DataFrame], keep: list[str] | None = None) -> DataFrame:
    """Union raw chat sources whose metadata types or extra columns differ."""
    return union_all([align_chats(f, keep) for f in frames])
