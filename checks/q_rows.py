"""Positions, sampling, splits, balance."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as v
from checks.q_tables import CHAT_MD5, chat_md5
from checks.registry import Tables, query
from weftline.operators import filters, indexing, sampling
from weftline.plans import balance as balance_plan
from weftline.plans import curate

SHARDS, CHUNK_ROWS = 8, 100
KEY = v.key_sql("doc_id")


@query(
    "row_index",
    f"SELECT doc_id, row_number() OVER (ORDER BY {KEY}) - 1 AS idx FROM documents",
)
def row_index(t: Tables):
    return indexing.dense_index(t.documents.select("doc_id"), ["doc_id"])


@query(
    "chunk_assign",
    v.with_views(
        "SELECT doc_id, shard, chunk FROM chunked",
        chunked=((), v.chunk_cte("(SELECT *, 'train' AS split FROM documents)", "doc_id",
                                 SHARDS, CHUNK_ROWS)),
    ),
)
def chunk_assign(t: Tables):
    indexed = indexing.dense_index(t.documents.select("doc_id"), ["doc_id"], total="total")
    chunks = indexing.assign_chunks(indexed, SHARDS, CHUNK_ROWS)
    return chunks.select("doc_id", "shard", "chunk")


@query(
    "seeded_shuffle",
    f"SELECT doc_id, md5(text) AS text_md5, row_number() OVER (ORDER BY {KEY}) - 1 AS pos "
    "FROM documents",
)
def seeded_shuffle(t: Tables):
    docs = t.documents.select("doc_id", F.md5("text").alias("text_md5"))
    placed = indexing.dense_index(docs, ["doc_id"], out="pos")
    return indexing.seeded_shuffle(placed, ["doc_id"])


@query(
    "head_k",
    "SELECT doc_id, n_chars, md5(text) AS text_md5 FROM documents "
    "ORDER BY n_chars DESC, doc_id LIMIT 20",
)
def head_k(t: Tables):
    docs = t.documents.withColumn("_desc", -F.col("n_chars"))
    top = indexing.head_rows(docs, ["_desc", "doc_id"], 20)
    return top.select("doc_id", "n_chars", F.md5("text").alias("text_md5"))


@query(
    "gather_by_index",
    f"""SELECT draw, doc_id, md5(text) AS text_md5 FROM
    (SELECT doc_id AS draw, ('0x' || substr(md5('42:' || doc_id), 1, 15))::BIGINT
      % (SELECT count(*) FROM documents) AS idx FROM documents)
  JOIN (SELECT doc_id, text, row_number() OVER (ORDER BY {KEY}) - 1 AS idx FROM documents)
  USING (idx)""",
)
def gather_by_index(t: Tables):
    indexed = indexing.dense_index(
        t.documents.select("doc_id", F.md5("text").alias("text_md5")), ["doc_id"]
    )
    n = t.documents.agg(F.count("*")).scalar()
    draws = t.documents.select(
        F.col("doc_id").alias("draw"), indexing.hash_draw(42, n, F.col("doc_id")).alias("idx")
    )
    return indexing.gather(draws, indexed).select("draw", "doc_id", "text_md5")


_UP_SQL = """SELECT conv_id, task, draw FROM
    (SELECT task, draw, ('0x' || substr(md5('42:' || task || ':' || draw), 1, 15))::BIGINT % n AS idx
     FROM (SELECT task, count(*) AS n FROM {source} GROUP BY task), range(15000) d(draw)
     WHERE task IN ('task_4_1', 'task_4_2') AND n < 15000)
  JOIN (SELECT *, row_number() OVER (PARTITION BY task ORDER BY {key}) - 1 AS idx
     FROM {source}) USING (task, idx)
  UNION ALL
  SELECT conv_id, task, NULL::BIGINT FROM
    (SELECT *, count(*) OVER (PARTITION BY task) AS n FROM {source})
  WHERE n >= 15000 AND task IN ('task_4_1', 'task_4_2')""".format(
    key=v.key_sql("task", "conv_id"), source="{source}"
)
_DOWN_SQL = """SELECT conv_id, task FROM (SELECT *, row_number() OVER (PARTITION BY task
    ORDER BY {key}) AS r FROM {source}) WHERE task NOT IN ('task_4_1', 'task_4_2')
    AND (task <> 'task_2' OR r <= 20)""".format(
    key=v.key_sql("task", "conv_id"), source="{source}"
)


@query("upsample_exact", v.with_views(_UP_SQL.format(source="classified"), "classified"))
def upsample_exact(t: Tables):
    rows = filters.classify_tasks(v.tagged(t)).where(F.col("task").isin("task_4_1", "task_4_2"))
    targets = {"task_4_1": 15_000, "task_4_2": 15_000}
    return sampling.upsample(rows, ["conv_id"], targets).select("conv_id", "task", "draw")


@query("downsample_exact", v.with_views(
    _DOWN_SQL.format(source="classified") + " AND task = 'task_2'", "classified"))
def downsample_exact(t: Tables):
    rows = filters.classify_tasks(v.tagged(t)).where(F.col("task") == "task_2")
    return sampling.downsample(rows, ["conv_id"], {"task_2": 20}).select("conv_id", "task")


def _mix_sql(source: str) -> str:
    return (
        f"SELECT conv_id, task, NULL::BIGINT AS draw FROM ({_DOWN_SQL.format(source=source)}) "
        f"UNION ALL {_UP_SQL.format(source=source)}"
    )


@query("balanced_mix", v.with_views(_mix_sql("classified"), "classified"))
def balanced_mix(t: Tables):
    rows = filters.classify_tasks(v.tagged(t))
    return sampling.balance(rows, ["conv_id"], v.POLICY).select("conv_id", "task", "draw")


@query(
    "upsample_ratio",
    v.with_views(
        """SELECT task, count(*) AS n, round(15000 / count(*)::DOUBLE, 6) AS ratio FROM classified
  WHERE task IN ('task_4_1', 'task_4_2') GROUP BY task""",
        "classified",
    ),
)
def upsample_ratio(t: Tables):
    rows = filters.classify_tasks(v.tagged(t)).where(F.col("task").isin("task_4_1", "task_4_2"))
    sizes = rows.groupBy("task").agg(F.count("*").alias("n"))
    ratio = sampling.upsample_ratio(F.col("n"), F.lit(15_000))
    return sizes.select("task", "n", F.round(ratio, 6).alias("ratio"))


@query(
    "train_eval_split",
    v.with_views(
        "SELECT doc_id, split FROM parted", parted=((), v.split_cte("documents", "doc_id"))
    ),
)
def train_eval_split(t: Tables):
    return sampling.split_train_eval(t.documents.select("doc_id"), ["doc_id"])


@query(
    "sample_k",
    f"SELECT doc_id, md5(text) AS text_md5 FROM documents ORDER BY {KEY} LIMIT 500",
)
def sample_k(t: Tables):
    sample = sampling.take_exact(t.documents.select("doc_id", "text"), ["doc_id"], 500)
    return sample.select("doc_id", F.md5("text").alias("text_md5"))


@query(
    "curate_tasks",
    v.with_views(
        "SELECT *, row_number() OVER (ORDER BY "
        + v.key_sql("source", "row_id", "column_idx")
        + f") - 1 AS pos FROM (SELECT 'a' AS source, row_id, column_idx, metadata, {CHAT_MD5} "
        f"FROM tagged_wide UNION ALL SELECT 'b', row_id, column_idx, metadata, {CHAT_MD5} "
        "FROM tagged_wide WHERE column_idx < 2)",
        "tagged_wide",
    ),
)
def curate_tasks(t: Tables):
    rows = curate.curate_tasks(
        {"a": v.wide(t), "b": v.wide(t, 2)}, ["row_id"], ordered=False
    )
    keys = ["source", "row_id", "column_idx"]
    slim = rows.select(*keys, "metadata", chat_md5())
    return indexing.seeded_shuffle(indexing.dense_index(slim, keys, out="pos"), keys)


@query(
    "merge_aligned",
    v.with_views(
        f"SELECT *, row_number() OVER (ORDER BY {v.key_sql('conv_id')}) - 1 AS pos FROM "
        f"(SELECT conv_id, metadata, {CHAT_MD5} FROM new_rows UNION ALL "
        f"SELECT conv_id, metadata, {CHAT_MD5} FROM old_rows)",
        "new_rows",
        "old_rows",
    ),
)
def merge_aligned(t: Tables):
    merged = curate.merge_aligned(v.old_rows(t), v.new_rows(t), ["conv_id"], ordered=False)
    slim = merged.select("conv_id", "metadata", chat_md5())
    placed = indexing.dense_index(slim, ["conv_id"], out="pos")
    return indexing.seeded_shuffle(placed, ["conv_id"])


_MERGED_CLASSES = (
    ("new_rows", "old_rows", "task_tokens"),
    "SELECT conv_id, messages, metadata, task FROM (SELECT * FROM new_rows UNION ALL "
    "SELECT * FROM old_rows), task_tokens WHERE messages[1].content <> '' "
    "AND contains(messages[1].content, token) AND (task <> 'task_2' OR "
    f"(contains(messages[1].content, '{v.BOW}') AND contains(messages[1].content, '{v.EOW}')))",
)


@query(
    "balanced_dataset",
    v.with_views(
        f"SELECT conv_id, task, draw, metadata, {CHAT_MD5} FROM ({_mix_sql('merged')}) "
        "JOIN merged USING (conv_id, task)",
        merged=_MERGED_CLASSES,
    ),
)
def balanced_dataset(t: Tables):
    mixed = balance_plan.balanced_dataset(
        [v.new_rows(t), v.old_rows(t)], ["conv_id"], v.POLICY, ordered=True, stage_chats=True
    )
    return mixed.select("conv_id", "task", "draw", "metadata", chat_md5())


@query(
    "balance_audit",
    v.with_views(
        """SELECT task, coalesce(n, 0) AS n, 0::BIGINT AS n_rejected FROM task_tokens LEFT JOIN (
    SELECT t.task, count(*) AS n FROM (SELECT messages[1].content AS c FROM (SELECT * FROM mixed)
      JOIN merged USING (conv_id, task)) x, task_tokens t WHERE contains(c, t.token)
    GROUP BY t.task) USING (task)""",
        merged=_MERGED_CLASSES,
        mixed=(("merged",), _mix_sql("merged")),
    ),
)
def balance_audit(t: Tables):
    mixed = balance_plan.balanced_dataset(
        [v.new_rows(t), v.old_rows(t)], ["conv_id"], v.POLICY, ordered=False, stage_chats=True
    )
    return balance_plan.balance_audit(mixed)
