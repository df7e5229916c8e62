"""Reading, writing, reshaping, filtering, union."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as v
from checks.registry import Tables, chat_text, query
from weftline.functions.text import preview
from weftline.functions.templates import alternates
from weftline.operators import filters, indexing, profile, project, setops
from weftline.params import TASK_COLUMNS
from weftline.session import scratch_path, staged
from weftline.sources import positions, probe, readers, sinks, splits

TEXT_MD5 = "md5(text) AS text_md5"
CHAT_MD5 = f"md5({v.chat_sql('messages')}) AS chat_md5"


def chat_md5():
    return F.md5(chat_text(F.col("messages"))).alias("chat_md5")


def text_md5():
    return F.md5("text").alias("text_md5")


@query("scan_documents", f"SELECT doc_id, {TEXT_MD5} FROM documents")
def scan_documents(t: Tables):
    docs = readers.read_dataset(t.spark, t.path("documents"), ["doc_id", "text"])
    return docs.select("doc_id", text_md5())


@query(
    "scan_partition",
    v.with_views(
        f"SELECT doc_id, {TEXT_MD5}, split, revision FROM split_docs "
        "WHERE revision = 'r1' AND split = 'train'",
        "split_docs",
    ),
)
def scan_partition(t: Tables):
    path = scratch_path(t.spark, "partitioned")
    v.split_docs(t).write.partitionBy("revision", "split").parquet(path)
    part = readers.read_dataset(t.spark, path, revision="r1", split="train")
    return part.select("doc_id", text_md5(), "split", "revision")


@query(
    "split_resolve",
    v.with_views("SELECT doc_id, split FROM split_docs WHERE split <> 'test'", "split_docs"),
)
def split_resolve(t: Tables):
    return splits.resolve_splits(v.split_docs(t), ["doc_id"]).select("doc_id", "split")


@query(
    "multi_source_load",
    f"SELECT 'documents' AS origin, doc_id AS id, {TEXT_MD5} FROM documents "
    f"UNION ALL SELECT 'benchmark', item_id, {TEXT_MD5} FROM benchmark",
)
def multi_source_load(t: Tables):
    def prepare(df, name):
        key = "item_id" if name == "benchmark" else "doc_id"
        return df.select(F.lit(name).alias("origin"), F.col(key).alias("id"), text_md5())

    names = ("documents", "absent", "benchmark", "region")
    loaded = readers.load_sources(t.spark, {n: t.path(n) for n in names}, prepare)
    return loaded.union()


@query(
    "sources_report",
    """SELECT 'documents' AS source, true AS loaded, count(*) AS n FROM documents
  UNION ALL SELECT 'benchmark', true, count(*) FROM benchmark
  UNION ALL SELECT unnest(['absent', 'region']), false, 0""",
)
def sources_report(t: Tables):
    """What could be read, as rows, with the rows of each."""

    def prepare(df, name):
        return df.select(F.lit(name).alias("source"), text_md5())

    names = ("documents", "absent", "benchmark", "region")
    loaded = readers.load_sources(t.spark, {n: t.path(n) for n in names}, prepare)
    counts = loaded.union().groupBy("source").agg(F.count("*").alias("n"))
    report = loaded.report(t.spark).select("source", "loaded")
    return report.join(counts, "source", "left").select("source", "loaded", F.coalesce("n", F.lit(0)).alias("n"))


_PARTS = 8


def _damaged(t: Tables) -> dict[str, str]:
    """Documents in parts of which one is no parquet, and a source with no sound file."""
    path, lost = scratch_path(t.spark, "damaged"), scratch_path(t.spark, "lost")
    docs = t.documents.withColumn("part", F.pmod("doc_id", F.lit(_PARTS)))
    docs.where("part <> 3").write.partitionBy("part").parquet(path)
    docs.where("part = 3").select("text").write.text(f"{path}/part=3")
    t.benchmark.select("text").write.text(lost)
    return {"documents": path, "benchmark": t.path("benchmark"), "lost": lost, "absent": f"{lost}-not"}


@query(
    "tolerant_files",
    f"SELECT 'documents' AS origin, doc_id AS id, {TEXT_MD5} FROM documents "
    f"WHERE doc_id % {_PARTS} <> 3 UNION ALL SELECT 'benchmark', item_id, {TEXT_MD5} FROM benchmark",
)
def tolerant_files(t: Tables):
    """Every row but those of one broken part, which costs its source nothing else."""

    def prepare(df, name):
        key = "item_id" if name == "benchmark" else "doc_id"
        return df.select(F.lit(name).alias("origin"), F.col(key).alias("id"), text_md5())

    return readers.load_sources(t.spark, _damaged(t), prepare, by_file=True, deep=True).union()


@query(
    "probed_files",
    f"""SELECT 'documents' AS source, doc_id % {_PARTS} AS part, doc_id % {_PARTS} <> 3 AS sound,
    count(*) FILTER (doc_id % {_PARTS} <> 3) AS n FROM documents GROUP BY ALL
  UNION ALL SELECT 'benchmark', NULL, true, count(*) FROM benchmark
  UNION ALL SELECT 'lost', NULL, false, 0""",
)
def probed_files(t: Tables):
    """The files of each source and part: can they be read, and how many rows they hold."""
    found = probe.probe_files(t.spark, _damaged(t), deep=True)
    part = F.regexp_extract("file", "/part=([0-9]+)/", 1)
    part = F.when(part != "", part.cast("bigint"))
    by = ["source", part.alias("part"), F.col("reason").isNull().alias("sound")]
    return found.groupBy(*by).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"))


_DRAWN = "('0x' || substr(md5('7:' || k), 1, 15))::BIGINT % (SELECT count(*) FROM documents)"


@query(
    "rows_at_positions",
    f"""SELECT position, doc_id, {TEXT_MD5}
  FROM (SELECT {_DRAWN} AS position FROM range(100) AS r(k))
  JOIN (SELECT *, row_number() OVER (ORDER BY doc_id % {_PARTS}, doc_id) - 1 AS position FROM documents)
  USING (position)""",
)
def rows_at_positions(t: Tables):
    """A hundred positions, some of them twice, of a table in eight parts of one or more files."""
    path = scratch_path(t.spark, "files")
    docs = t.documents.withColumn("part", F.pmod("doc_id", F.lit(_PARTS)))
    # Files are named by the number of their range, so a part's files are in order.
    dealt = docs.repartitionByRange("part", "doc_id").sortWithinPartitions("part", "doc_id")
    dealt.write.partitionBy("part").parquet(path)
    index = staged(positions.positional_index(t.spark, path), "positions")
    n = index.agg(F.sum("rows")).first()[0]
    drawn = t.spark.range(100).select(indexing.hash_draw(7, F.lit(n), F.col("id")).alias("position"))
    return positions.rows_at(t.spark, path, index, drawn).select("position", "doc_id", text_md5())


@query(
    "keyed_documents",
    "SELECT doc_id, 1::BIGINT AS n FROM documents",
)
def keyed_documents(t: Tables):
    """Every document with the number of rows that its stored key names."""
    keyed = readers.with_row_key(t.documents).select("doc_id", "row_key")
    rows = keyed.repartition(7, "doc_id").groupBy("row_key").agg(F.count("*").alias("n"))
    return keyed.join(rows, "row_key").select("doc_id", "n")


@query(
    "train_wrap",
    f"SELECT 'train' AS split, doc_id, {TEXT_MD5} FROM documents",
)
def train_wrap(t: Tables):
    return sinks.with_train_split(t.documents).select("split", "doc_id", text_md5())


@query(
    "sink_roundtrip",
    v.with_views(f"SELECT doc_id, {TEXT_MD5}, split FROM split_docs", "split_docs"),
)
def sink_roundtrip(t: Tables):
    path = scratch_path(t.spark, "saved")
    sinks.save_dataset(v.split_docs(t).drop("revision"), path)
    return readers.read_dataset(t.spark, path).select("doc_id", text_md5(), "split")


_WIDE_SQL = (
    "SELECT row_id, column_idx, CASE column_idx "
    + " ".join(f"WHEN {k} THEN '{name}'" for k, name in enumerate(TASK_COLUMNS))
    + f" END AS column_name, len(messages) AS n_messages, {CHAT_MD5} FROM wide_rows"
)


@query("unpivot_tasks", v.with_views(_WIDE_SQL, "wide_rows"))
def unpivot_tasks(t: Tables):
    return _unpivoted(v.wide(t))


@query("unpivot_field_order", v.with_views(_WIDE_SQL, "wide_rows"))
def unpivot_field_order(t: Tables):
    """The same rows from structs whose fields come in another order."""

    def turned(name):
        cell = F.col(f"`{name}`")
        messages = F.transform(
            cell["messages"],
            lambda m: F.struct(m["content"].alias("content"), F.lit(1).alias("n"), m["role"].alias("role")),
        )
        meta = F.to_json(cell["meta"]).alias("meta")
        return F.when(cell.isNotNull(), F.struct(meta, messages.alias("messages"))).alias(name)

    return _unpivoted(v.wide(t).select("row_id", *[turned(n) for n in TASK_COLUMNS]))


def _unpivoted(wide):
    rows = project.unpivot_tasks(wide, ["row_id"], inject=False)
    return rows.select(
        "row_id",
        "column_idx",
        "column_name",
        F.size("messages").cast("bigint").alias("n_messages"),
        chat_md5(),
    )


@query(
    "inject_task_token",
    v.with_views(
        f"SELECT row_id, column_idx, messages[1].content AS first_content, {CHAT_MD5} "
        "FROM tagged_wide",
        "tagged_wide",
    ),
)
def inject_task_token(t: Tables):
    rows = project.unpivot_tasks(v.wide(t), ["row_id"])
    return rows.select(
        "row_id",
        "column_idx",
        filters.first_content(F.col("messages")).alias("first_content"),
        chat_md5(),
    )


@query(
    "metadata_json",
    v.with_views("SELECT row_id, column_idx, metadata FROM wide_rows", "wide_rows"),
)
def metadata_json(t: Tables):
    return project.unpivot_tasks(v.wide(t), ["row_id"]).select("row_id", "column_idx", "metadata")


@query(
    "align_schema",
    v.with_views(f"SELECT conv_id, metadata, {CHAT_MD5} FROM new_rows", "new_rows"),
)
def align_schema(t: Tables):
    aligned = project.align_chats(v.new_rows(t), ["conv_id"])
    return aligned.select("conv_id", "metadata", chat_md5())


@query(
    "preview_rows",
    """SELECT conv_id, turn, CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...'
    ELSE text END AS cut_200, substr(text, 1, 100) || '...' AS cut_100,
    substr(text, 1, 500) AS cut_500 FROM conversations""",
)
def preview_rows(t: Tables):
    text = F.col("text")
    return t.conversations.select(
        "conv_id",
        "turn",
        preview(text, 200).alias("cut_200"),
        preview(text, 100, always_dots=True).alias("cut_100"),
        preview(text, 500, dots=False).alias("cut_500"),
    )


def _probe_sql() -> str:
    rows = [
        ("doc_id", "bigint", "other", "doc_id IS NOT NULL"),
        ("text", "string", "text", "length(text) > 0"),
        ("lang", "string", "text", "length(lang) > 0"),
        ("source", "string", "text", "length(source) > 0"),
        ("n_chars", "bigint", "other", "n_chars IS NOT NULL"),
        ("input_ids", "array<int>", "tokens", f"len({v.pieces('text')}) > 0"),
    ]
    selects = [
        f'SELECT \'{c}\' AS "column", \'{kind}\' AS type, \'{k}\' AS kind, '
        f"count(*) AS n_rows, count_if({filled})::BIGINT AS n_filled FROM blanked_docs"
        for c, kind, k, filled in rows
    ]
    return v.with_views(" UNION ALL ".join(selects), "blanked_docs")


@query("schema_probe", _probe_sql())
def schema_probe(t: Tables):
    docs = v.blanked_docs(t)
    return project.schema_probe(docs.withColumn("input_ids", v.TOK.encode(F.col("text"))))


@query(
    "row_lengths",
    v.with_views("SELECT conv_id, length(to_json(messages)::VARCHAR) AS length FROM chats", "chats"),
)
def row_lengths(t: Tables):
    return project.row_lengths(v.chats(t), ["conv_id"])


@query(
    "filter_nonempty_messages",
    v.with_views("SELECT conv_id, len(messages) AS n FROM emptied WHERE len(messages) > 0", "emptied"),
)
def filter_nonempty_messages(t: Tables):
    kept = filters.nonempty_messages(v.emptied_chats(t))
    return kept.select("conv_id", F.size("messages").cast("bigint").alias("n"))


@query(
    "filter_valid",
    v.with_views(
        f"SELECT conv_id, {CHAT_MD5} FROM emptied "
        "WHERE len(messages) > 0 AND messages[1].content <> ''",
        "emptied",
    ),
)
def filter_valid(t: Tables):
    return filters.valid_chats(v.emptied_chats(t)).select("conv_id", chat_md5())


@query(
    "filter_by_token",
    v.with_views(
        f"SELECT conv_id, {CHAT_MD5} FROM tagged WHERE contains(messages[1].content, '{v.TWO}')",
        "tagged",
    ),
)
def filter_by_token(t: Tables):
    return filters.with_token(v.tagged(t), v.TWO).select("conv_id", chat_md5())


@query(
    "filter_task2_complete",
    v.with_views(
        "SELECT conv_id, contains(c, '{b}') AND contains(c, '{e}') AS complete FROM "
        "(SELECT conv_id, messages[1].content AS c FROM tagged) WHERE contains(c, '{t}')".format(
            b=v.BOW, e=v.EOW, t=v.TWO
        ),
        "tagged",
    ),
)
def filter_task2_complete(t: Tables):
    content = filters.first_content(F.col("messages"))
    return filters.with_token(v.tagged(t), v.TWO).select(
        "conv_id", filters.is_complete_task2(content).alias("complete")
    )


@query(
    "filter_nonblank_text",
    v.with_views(
        f"SELECT doc_id, {TEXT_MD5} FROM blanked_docs WHERE text IS NOT NULL AND "
        + v.NONBLANK.format("text"),
        "blanked_docs",
    ),
)
def filter_nonblank_text(t: Tables):
    return filters.nonblank_text(v.blanked_docs(t)).select("doc_id", text_md5())


@query(
    "filter_nonempty_tokens",
    v.with_views(
        f"SELECT doc_id, n_tokens FROM (SELECT doc_id, len({v.pieces('text')}) AS n_tokens "
        "FROM blanked_docs) WHERE n_tokens > 0",
        "blanked_docs",
    ),
)
def filter_nonempty_tokens(t: Tables):
    docs = v.blanked_docs(t).withColumn("input_ids", v.TOK.encode(F.col("text")))
    kept = filters.nonempty_tokens(docs)
    return kept.select("doc_id", F.size("input_ids").cast("bigint").alias("n_tokens"))


@query("classify_tasks", v.with_views("SELECT conv_id, task FROM classified", "classified"))
def classify_tasks(t: Tables):
    return filters.classify_tasks(v.tagged(t)).select("conv_id", "task")


_COUNT_SQL = f"""SELECT task, coalesce(sum((hit AND good)::INT), 0)::BIGINT AS n,
    coalesce(sum((hit AND NOT good)::INT), 0)::BIGINT AS n_rejected
  FROM (SELECT task, contains(messages[1].content, token) AS hit, task <> 'task_2' OR
      (contains(messages[1].content, '{v.BOW}') AND contains(messages[1].content, '{v.EOW}')) AS good
    FROM task_tokens LEFT JOIN tagged ON true) GROUP BY task"""


@query("task_counts", v.with_views(_COUNT_SQL, "tagged", "task_tokens"))
def task_counts(t: Tables):
    return filters.task_counts(v.tagged(t))


@query(
    "stage_counts",
    v.with_views(
        f"""SELECT 'all' AS stage, count(*) AS n FROM blanked_docs
  UNION ALL SELECT 'nonblank', count(*) FROM blanked_docs WHERE {v.NONBLANK.format('text')}
  UNION ALL SELECT 'tokens', count(*) FROM blanked_docs WHERE len({v.pieces('text')}) > 0""",
        "blanked_docs",
    ),
)
def stage_counts(t: Tables):
    text = F.col("text")
    return profile.stage_counts(
        v.blanked_docs(t),
        nonblank=filters.is_nonblank(text),
        tokens=v.TOK.has_token(text),
    )


@query(
    "union_sources",
    v.with_views(
        f"SELECT 'a' AS source, row_id, column_idx, {CHAT_MD5} FROM tagged_wide "
        f"UNION ALL SELECT 'b', row_id, column_idx, {CHAT_MD5} FROM tagged_wide WHERE column_idx < 2",
        "tagged_wide",
    ),
)
def union_sources(t: Tables):
    frames = [
        project.unpivot_tasks(v.wide(t, n), ["row_id"]).withColumn("source", F.lit(name))
        for name, n in (("a", 4), ("b", 2))
    ]
    return setops.union_all(frames).select("source", "row_id", "column_idx", chat_md5())


@query(
    "union_drifted",
    v.with_views(
        f"SELECT conv_id, metadata, {CHAT_MD5} FROM new_rows "
        f"UNION ALL SELECT conv_id, metadata, {CHAT_MD5} FROM old_rows",
        "new_rows",
        "old_rows",
    ),
)
def union_drifted(t: Tables):
    merged = setops.union_drifted([v.new_rows(t), v.old_rows(t)], ["conv_id"])
    return merged.select("conv_id", "metadata", chat_md5())


@query(
    "validate_alternation",
    v.with_views(
        """SELECT conv_id, coalesce(bool_and((role = 'user') = (k % 2 = 0)), true) AS alternating
  FROM (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS k
    FROM broken_log WHERE role IN ('user', 'assistant')) GROUP BY conv_id""",
        "broken_log",
    ),
)
def validate_alternation(t: Tables):
    return v.broken_chats(t).select("conv_id", alternates(F.col("messages")).alias("alternating"))
