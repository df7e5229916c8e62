"""Inputs derived from the test tables: one rule, written for Spark and for SQL.

The tables have no task tokens, no faulty chats and no blank texts, so rows are
altered by a rule on their key. Every row of a table is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from checks.registry import Tables
from weftline.functions.templates import BLOCKS, TOOL_CALLS
from weftline.functions.tokens import FIRST_SPECIAL_ID, RegexTokenizer
from weftline.params import TASK_COLUMNS, TASK_SPECIALS, TASK_TOKENS, TaskLimit
from weftline.sources.readers import chats_from_log

TOK = RegexTokenizer()
POLICY = {
    "task_1": TaskLimit(),
    "task_2": TaskLimit(max_rows=20),
    "task_3": TaskLimit(),
    "task_4_1": TaskLimit(min_rows=15_000),
    "task_4_2": TaskLimit(min_rows=15_000),
}
ONE, TWO, BOW, EOW, THREE, FOUR_1, FOUR_2 = TASK_SPECIALS

# ------------------------------------------------------------------- Spark


def chats(t: Tables) -> DataFrame:
    return chats_from_log(t.conversations)


def tagged_log(t: Tables) -> DataFrame:
    slot = F.col("conv_id") % 10
    task2 = F.when(F.col("conv_id") % 3 == 0, F.lit(TWO + BOW)).otherwise(F.lit(TWO + BOW + EOW))
    prefix = (
        F.when(slot == 0, F.lit(ONE))
        .when(slot <= 4, task2)
        .when(slot == 5, F.lit(THREE))
        .when(slot == 6, F.lit(FOUR_1))
        .when(slot == 7, F.lit(FOUR_2))
        .when(slot == 8, F.lit(FOUR_1 + FOUR_2))
        .otherwise(F.lit(""))
    )
    text = F.when(F.col("turn") == 0, F.concat(prefix, "text")).otherwise(F.col("text"))
    return t.conversations.withColumn("text", text)


def tagged(t: Tables) -> DataFrame:
    return chats_from_log(tagged_log(t))


def wide(t: Tables, columns: int = 4) -> DataFrame:
    """One row per four chats, each in its own task column."""
    meta = F.when(
        F.col("conv_id") % 9 != 0,
        F.struct(
            "conv_id",
            F.size("messages").cast("bigint").alias("n_turns"),
            F.lit(None).cast("string").alias("note"),
        ),
    )
    cell = F.struct("messages", meta.alias("meta"))
    cells = [
        F.any_value(F.when(F.col("conv_id") % 4 == k, cell), True).alias(name)
        for k, name in enumerate(TASK_COLUMNS[:columns])
    ]
    return chats(t).groupBy(F.floor(F.col("conv_id") / 4).alias("row_id")).agg(*cells)


def new_rows(t: Tables) -> DataFrame:
    """Newer chats: metadata is a struct, null on some, and there is a source."""
    meta = F.when(
        F.col("conv_id") % 5 != 0,
        F.struct("conv_id", F.size("messages").cast("bigint").alias("n_turns")),
    )
    return chats(t).select("conv_id", "messages", meta.alias("metadata"), F.lit("log").alias("source"))


def old_rows(t: Tables) -> DataFrame:
    """Curated chats: metadata is JSON text already."""
    return tagged(t).select(
        (F.col("conv_id") + 1_000_000_000).alias("conv_id"),
        "messages",
        F.concat(F.lit('{"id":'), F.col("conv_id").cast("string"), F.lit("}")).alias("metadata"),
    )


def broken_chats(t: Tables) -> DataFrame:
    """The second turn of some chats is a second question."""
    asks_again = (F.col("conv_id") % 7 == 0) & (F.col("turn") == 1)
    role = F.when(asks_again, F.lit("user")).otherwise(F.col("role"))
    return chats_from_log(t.conversations.withColumn("role", role))


def emptied_chats(t: Tables) -> DataFrame:
    part = F.col("conv_id") % 11
    empty = F.array().cast("array<struct<role:string,content:string>>")
    blanked = F.transform(
        "messages",
        lambda m, i: F.when(i == 0, m.withField("content", F.lit(""))).otherwise(m),
    )
    return chats(t).withColumn(
        "messages",
        F.when(part == 0, F.lit(None))
        .when(part == 1, empty)
        .when(part == 2, blanked)
        .otherwise(F.col("messages")),
    )


def blanked_docs(t: Tables) -> DataFrame:
    part = F.col("doc_id") % 13
    return t.documents.withColumn(
        "text",
        F.when(part == 0, F.lit(None))
        .when(part == 1, F.lit(""))
        .when(part == 2, F.lit(" \t\n"))
        .when(part == 3, F.lit("　"))
        .when(part == 4, F.lit("\x1c"))
        .otherwise(F.col("text")),
    )


def split_docs(t: Tables) -> DataFrame:
    part = F.col("doc_id") % 20
    return t.documents.withColumn(
        "split",
        F.when(part == 0, F.lit("validation"))
        .when(part == 1, F.lit("test"))
        .otherwise(F.lit("train")),
    ).withColumn("revision", F.concat(F.lit("r"), (F.col("doc_id") % 2).cast("string")))


def rich_chats(t: Tables, faulty: bool = False) -> DataFrame:
    """Chats with content blocks, tool calls and tools; some with faults."""

    def blocks(*items: tuple[str, Column | None]) -> Column:
        return F.array(
            *[
                F.struct(
                    F.lit(kind).alias("type"),
                    (F.lit(None) if text is None else text).cast("string").alias("text"),
                )
                for kind, text in items
            ]
        ).cast(BLOCKS)

    no_blocks, no_calls = F.lit(None).cast(BLOCKS), F.lit(None).cast(TOOL_CALLS)
    conv, text, role = F.col("conv_id"), F.col("text"), F.col("role")

    def message(role, text, blocks, calls):
        return F.struct(
            (F.lit(role) if isinstance(role, str) else role).alias("role"),
            text.cast("string").alias("text"),
            blocks.alias("blocks"),
            calls.alias("tool_calls"),
        )

    calls = F.array(
        F.struct(F.lit("lookup").alias("name"), F.lit("").alias("arguments")),
        F.struct(F.lit("calc").alias("name"), F.lit('{"x":1}').alias("arguments")),
    ).cast(TOOL_CALLS)
    plain = message(role, text, no_blocks, no_calls)
    parts = (
        F.when(
            (role == "user") & (conv % 3 == 1),
            F.array(message(role, F.lit(None), blocks(("text", text), ("image", None)), no_calls)),
        )
        .when(
            (role == "user") & (conv % 3 == 2),
            F.array(
                message(
                    role,
                    F.lit(None),
                    blocks(("text", text), ("image_url", None), ("text", F.lit("?"))),
                    no_calls,
                )
            ),
        )
        .when(
            (role == "assistant") & (conv % 4 == 1),
            F.array(
                message("assistant", F.lit(None), no_blocks, calls),
                message("tool", F.lit("42"), no_blocks, no_calls),
                plain,
            ),
        )
        .otherwise(F.array(plain))
    )
    if faulty:
        second, third = F.col("turn") == 1, F.col("turn") == 2
        parts = (
            F.when(second & (conv % 7 == 0), F.array(message("user", text, no_blocks, no_calls)))
            .when(second & (conv % 11 == 3), F.array(message("critic", text, no_blocks, no_calls)))
            .when(
                third & (role == "user") & (conv % 13 == 4),
                F.array(message(role, F.lit(None), blocks(("audio", None)), no_calls)),
            )
            .when(
                (role == "assistant") & (conv % 17 == 5),
                F.array(message(role, F.lit(""), no_blocks, no_calls)),
            )
            .when(
                (role == "system") & (conv % 2 == 0),
                F.array(message(role, F.lit(None), blocks(("image", None)), no_calls)),
            )
            .otherwise(parts)
        )
    ordered = F.sort_array(F.collect_list(F.struct("turn", parts.alias("parts"))))
    return (
        t.conversations.groupBy("conv_id")
        .agg(F.flatten(F.transform(ordered, lambda x: x["parts"])).alias("messages"))
        .withColumn(
            "tools",
            F.when(conv % 6 == 0, F.lit('[{"name":"lookup"}]')).when(conv % 6 == 1, F.lit("[]")),
        )
    )


# --------------------------------------------------------------------- SQL


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


PATTERN = quoted(TOK.pattern)
SPECIAL_LIST = "[" + ", ".join(quoted(s) for s in TOK.specials) + "]"
PAD_ID = TOK.pad_id


def pieces(text: str) -> str:
    return f"regexp_extract_all({text}, {PATTERN})"


def _crc_table() -> str:
    """The 256 remainders of the CRC-32 polynomial, as an SQL list."""
    table = []
    for k in range(256):
        for _ in range(8):
            k = (k >> 1) ^ (0xEDB88320 if k & 1 else 0)
        table.append(k)
    return "[" + ", ".join(map(str, table)) + "]::BIGINT[]"


CRC_TABLE = _crc_table()


def piece_id(p: str) -> str:
    slot = f"coalesce(list_position({SPECIAL_LIST}, {p}), 0)"
    octets = f"[('0x' || substr(hex({p}), 2 * o + 1, 2))::BIGINT FOR o IN range(length(hex({p})) // 2)]"
    crc = (
        f"xor(list_reduce({octets}, lambda c, b: "
        f"xor(c >> 8, ({CRC_TABLE})[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"
    )
    return (
        f"CASE WHEN {slot} > 0 THEN {FIRST_SPECIAL_ID - 1} + {slot} "
        f"ELSE {crc} & {FIRST_SPECIAL_ID - 1} END"
    )


def ids(text: str) -> str:
    return f"[{piece_id('p')} FOR p IN {pieces(text)}]"


def digest_sql(items: str) -> str:
    return f"md5(array_to_string({items}, ','))"


def key_sql(*keys: str, seed: int = 42) -> str:
    told = [f"coalesce(':' || length({k}::VARCHAR) || '=' || {k}::VARCHAR, ':')" for k in keys]
    return f"md5('{seed}' || " + " || ".join(told) + ")"


def chat_sql(messages: str) -> str:
    return f"array_to_string([m.role || ':' || m.content FOR m IN {messages}], chr(10))"


NONBLANK = r"regexp_matches({}, '[^\s\pZ\x0b\x1c-\x1f\x{{85}}]')"

_PREFIX = f"""CASE WHEN conv_id % 10 = 0 THEN '{ONE}'
  WHEN conv_id % 10 <= 4 THEN '{TWO}{BOW}' || CASE WHEN conv_id % 3 = 0 THEN '' ELSE '{EOW}' END
  WHEN conv_id % 10 = 5 THEN '{THREE}' WHEN conv_id % 10 = 6 THEN '{FOUR_1}'
  WHEN conv_id % 10 = 7 THEN '{FOUR_2}' WHEN conv_id % 10 = 8 THEN '{FOUR_1}{FOUR_2}'
  ELSE '' END"""

_MESSAGES = "list({'role': role, 'content': text} ORDER BY turn) AS messages"
_TASK_VALUES = ", ".join(f"('{k}', '{v}')" for k, v in TASK_TOKENS.items())
_BLOCK = "STRUCT(type VARCHAR, text VARCHAR)[]"
_CALLS = "STRUCT(name VARCHAR, arguments VARCHAR)[]"
_TWO_CALLS = (
    "[{'name': 'lookup', 'arguments': ''}, {'name': 'calc', 'arguments': '{\"x\":1}'}]"
)


def _rich_rows(source: str) -> str:
    return f"""
  SELECT conv_id, turn, 0 AS part, role, NULL::VARCHAR AS txt,
    [{{'type': 'text', 'text': text}}, {{'type': 'image', 'text': NULL}}]::{_BLOCK} AS blocks,
    NULL::{_CALLS} AS calls FROM {source} WHERE role = 'user' AND conv_id % 3 = 1
  UNION ALL
  SELECT conv_id, turn, 0, role, NULL,
    [{{'type': 'text', 'text': text}}, {{'type': 'image_url', 'text': NULL}},
     {{'type': 'text', 'text': '?'}}]::{_BLOCK}, NULL FROM {source}
  WHERE role = 'user' AND conv_id % 3 = 2
  UNION ALL
  SELECT conv_id, turn, 0, 'assistant', NULL, NULL, {_TWO_CALLS}::{_CALLS} FROM {source}
  WHERE role = 'assistant' AND conv_id % 4 = 1
  UNION ALL
  SELECT conv_id, turn, 1, 'tool', '42', NULL, NULL FROM {source}
  WHERE role = 'assistant' AND conv_id % 4 = 1
  UNION ALL
  SELECT conv_id, turn, CASE WHEN role = 'assistant' AND conv_id % 4 = 1 THEN 2 ELSE 0 END,
    role, text, NULL, NULL FROM {source}
  WHERE NOT (role = 'user' AND conv_id % 3 > 0)"""


CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "chats": ((), f"SELECT conv_id, {_MESSAGES} FROM conversations GROUP BY conv_id"),
    "tagged_log": (
        (),
        f"SELECT conv_id, turn, role, CASE WHEN turn = 0 THEN {_PREFIX} || text ELSE text END "
        "AS text FROM conversations",
    ),
    "tagged": (("tagged_log",), f"SELECT conv_id, {_MESSAGES} FROM tagged_log GROUP BY conv_id"),
    "wide_rows": (
        ("chats",),
        "SELECT conv_id // 4 AS row_id, (conv_id % 4)::INT AS column_idx, messages, "
        "CASE WHEN conv_id % 9 = 0 THEN '{}' ELSE to_json({'conv_id': conv_id, "
        "'n_turns': len(messages), 'note': NULL})::VARCHAR END AS metadata FROM chats",
    ),
    "tagged_wide": (
        ("wide_rows",),
        "SELECT row_id, column_idx, metadata, [{'role': m.role, 'content': CASE WHEN i = 1 "
        f"THEN CASE WHEN column_idx < 2 THEN '{FOUR_1}' ELSE '{FOUR_2}' END ELSE '' END || m.content}} "
        "FOR m, i IN messages] AS messages FROM wide_rows",
    ),
    "new_rows": (
        ("chats",),
        "SELECT conv_id, messages, CASE WHEN conv_id % 5 = 0 THEN '{}' ELSE "
        "to_json({'conv_id': conv_id, 'n_turns': len(messages)})::VARCHAR END AS metadata FROM chats",
    ),
    "old_rows": (
        ("tagged",),
        "SELECT conv_id + 1000000000 AS conv_id, messages, '{\"id\":' || conv_id || '}' AS metadata "
        "FROM tagged",
    ),
    "broken_log": (
        (),
        "SELECT conv_id, turn, CASE WHEN conv_id % 7 = 0 AND turn = 1 THEN 'user' ELSE role END "
        "AS role, text FROM conversations",
    ),
    "emptied": (
        ("chats",),
        "SELECT conv_id, CASE WHEN conv_id % 11 = 0 THEN NULL WHEN conv_id % 11 = 1 THEN [] "
        "WHEN conv_id % 11 = 2 THEN [{'role': m.role, 'content': CASE WHEN i = 1 THEN '' ELSE "
        "m.content END} FOR m, i IN messages] ELSE messages END AS messages FROM chats",
    ),
    "blanked_docs": (
        (),
        "SELECT doc_id, CASE doc_id % 13 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN "
        "' ' || chr(9) || chr(10) WHEN 3 THEN chr(12288) WHEN 4 THEN chr(28) ELSE text END AS text, "
        "lang, source, n_chars FROM documents",
    ),
    "split_docs": (
        (),
        "SELECT *, CASE doc_id % 20 WHEN 0 THEN 'validation' WHEN 1 THEN 'test' ELSE 'train' END "
        "AS split, 'r' || doc_id % 2 AS revision FROM documents",
    ),
    "task_tokens": ((), f"SELECT * FROM (VALUES {_TASK_VALUES}) v(task, token)"),
    "classified": (
        ("tagged", "task_tokens"),
        "SELECT conv_id, messages, task FROM tagged, task_tokens "
        "WHERE contains(messages[1].content, token) AND (task <> 'task_2' OR "
        f"(contains(messages[1].content, '{BOW}') AND contains(messages[1].content, '{EOW}')))",
    ),
    "rich": ((), _rich_rows("conversations")),
    "faulty": (
        (),
        f"""
  SELECT conv_id, turn, 0 AS part, CASE kind WHEN 'again' THEN 'user' WHEN 'role' THEN 'critic'
      ELSE role END AS role,
    CASE kind WHEN 'again' THEN text WHEN 'role' THEN text WHEN 'empty' THEN '' END AS txt,
    CASE kind WHEN 'audio' THEN [{{'type': 'audio', 'text': NULL}}]
      WHEN 'system' THEN [{{'type': 'image', 'text': NULL}}] END::{_BLOCK} AS blocks,
    NULL::{_CALLS} AS calls
  FROM fault_kinds WHERE kind <> ''
  UNION ALL SELECT * FROM (SELECT * FROM ({_rich_rows("(SELECT * FROM fault_kinds WHERE kind = '')")}))""",
    ),
    "fault_kinds": (
        (),
        """SELECT *, CASE WHEN turn = 1 AND conv_id % 7 = 0 THEN 'again'
    WHEN turn = 1 AND conv_id % 11 = 3 THEN 'role'
    WHEN turn = 2 AND role = 'user' AND conv_id % 13 = 4 THEN 'audio'
    WHEN role = 'assistant' AND conv_id % 17 = 5 THEN 'empty'
    WHEN role = 'system' AND conv_id % 2 = 0 THEN 'system' ELSE '' END AS kind
  FROM conversations""",
    ),
    # (conv_id, ord, text, trainable) of three templates
    "simple_segments": (
        (),
        """SELECT conv_id, turn AS ord, CASE role WHEN 'user' THEN
      CASE WHEN turn = 0 THEN '<s>' ELSE '' END || '[INST]' || text || '[/INST]'
      ELSE text || '</s>' END AS text, role = 'assistant' AS trainable
  FROM conversations WHERE role IN ('user', 'assistant')""",
    ),
    "role_tag_segments": (
        (),
        r"""SELECT conv_id, turn * 2 AS ord, '<|' || role || '|>' || chr(10) || CASE role
      WHEN 'assistant' THEN '' ELSE body || '<|end|>' || chr(10) END AS text, false AS trainable
  FROM stripped WHERE role <> 'system' OR body <> ''
  UNION ALL SELECT conv_id, turn * 2 + 1, body || '<|end|>' || chr(10), true FROM stripped
  WHERE role = 'assistant'
  UNION ALL SELECT conv_id, 1000000000, '</s>', true FROM conversations GROUP BY conv_id""",
    ),
    "stripped": (
        (),
        r"""SELECT conv_id, turn, role, regexp_replace(text,
    '^[\s\pZ\x0b\x1c-\x1f\x{85}]+|[\s\pZ\x0b\x1c-\x1f\x{85}]+\z', '', 'g') AS body
  FROM conversations""",
    ),
    "marked_segments": (
        (),
        """SELECT conv_id, turn AS ord, CASE role WHEN 'user' THEN '[INST]' || text || '[/INST]'
      WHEN 'system' THEN '[SYSTEM_PROMPT]' || text || '[/SYSTEM_PROMPT]'
      ELSE text || '</s>' END AS text, role = 'assistant' AS trainable
  FROM conversations WHERE role <> 'system' OR turn = 0
  UNION ALL SELECT conv_id, -1, '<s>', false FROM conversations GROUP BY conv_id""",
    ),
    "doc_tokens": (
        (),
        f"SELECT doc_id, {ids('text')} AS ids FROM documents",
    ),
}
_MATERIALIZED = {"doc_tokens", "simple_tokens", "examples", "packed", "bins", "chunked"}


def _closure(names: tuple[str, ...], extra: dict) -> list[str]:
    done: list[str] = []

    def visit(name: str) -> None:
        if name in done:
            return
        for need in {**CTES, **extra}[name][0]:
            visit(need)
        done.append(name)

    for name in names:
        visit(name)
    return done


CTES["faulty"] = (("fault_kinds",), CTES["faulty"][1])
CTES["role_tag_segments"] = (("stripped",), CTES["role_tag_segments"][1])


def encoded_cte(segments: str) -> tuple[tuple[str, ...], str]:
    """(conv_id, ids, labels, mask) of a segment view."""
    return (
        (segments,),
        f"""SELECT conv_id, flatten(list(ids ORDER BY ord)) AS ids,
    flatten(list([CASE WHEN trainable THEN x ELSE -100 END FOR x IN ids] ORDER BY ord)) AS labels,
    flatten(list([CASE WHEN trainable THEN 1 ELSE 0 END FOR x IN ids] ORDER BY ord)) AS mask
  FROM (SELECT conv_id, ord, trainable, {ids('text')} AS ids FROM {segments}) GROUP BY conv_id""",
    )


CTES["simple_tokens"] = encoded_cte("simple_segments")
CTES["role_tag_tokens"] = encoded_cte("role_tag_segments")
CTES["marked_tokens"] = encoded_cte("marked_segments")


def with_views(body: str, *names: str, recursive: bool = False, **extra) -> str:
    """``body`` with the views it needs as common table expressions."""
    parts = []
    for name in _closure((*names, *extra), extra):
        how = "MATERIALIZED " if name in _MATERIALIZED else ""
        parts.append(f"{name} AS {how}({ {**CTES, **extra}[name][1] })")
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(parts) + "\n" + body


def split_cte(source: str, key: str, share: float = 0.05) -> str:
    """Rows with the exact evaluation share marked as validation."""
    return (
        f"SELECT *, CASE WHEN row_number() OVER (ORDER BY {key_sql(key)}) <= "
        f"ceil({share}::DOUBLE * count(*) OVER ()) THEN 'validation' ELSE 'train' END AS split "
        f"FROM {source}"
    )


def chunk_cte(source: str, key: str, shards: int, rows: int) -> str:
    """Rows of each split numbered in seeded order and put into chunks."""
    return f"""SELECT *, (idx - shard * (n // {shards}) - least(shard, n % {shards})) // {rows} AS chunk
  FROM (SELECT *, CASE WHEN idx < (n % {shards}) * (n // {shards} + 1)
      THEN idx // (n // {shards} + 1)
      ELSE n % {shards} + (idx - (n % {shards}) * (n // {shards} + 1)) // greatest(n // {shards}, 1)
      END AS shard
    FROM (SELECT *, row_number() OVER (PARTITION BY split ORDER BY {key_sql(key)}) - 1 AS idx,
        count(*) OVER (PARTITION BY split) AS n FROM {source}))"""


def bins_ctes(length: int) -> dict:
    """Next-fit bins of ``chunked`` (split, shard, chunk, idx, ids), row by row."""
    return {
        "chunk_rows": (
            ("chunked",),
            f"""SELECT split, shard, chunk, idx, least(len(ids), {length}) AS k,
    row_number() OVER (PARTITION BY split, shard, chunk ORDER BY idx) AS r FROM chunked""",
        ),
        "fold": (
            ("chunk_rows",),
            f"""SELECT split, shard, chunk, idx, k, r, 0::BIGINT AS bin, 0::BIGINT AS start_at
    FROM chunk_rows WHERE r = 1
  UNION ALL SELECT c.split, c.shard, c.chunk, c.idx, c.k, c.r,
    CASE WHEN f.start_at + f.k + c.k > {length} THEN f.bin + 1 ELSE f.bin END,
    CASE WHEN f.start_at + f.k + c.k > {length} THEN 0 ELSE f.start_at + f.k END
  FROM fold f JOIN chunk_rows c ON c.split = f.split AND c.shard = f.shard
    AND c.chunk = f.chunk AND c.r = f.r + 1""",
        ),
        "packed": (
            ("fold", "chunked"),
            f"""SELECT split, shard, chunk, bin, count(*) AS n_rows, sum(k)::BIGINT AS n_tokens,
    flatten(list(ids[1:{length}] ORDER BY idx)) AS ids,
    flatten(list(labels[1:{length}] ORDER BY idx)) AS labels
  FROM fold JOIN chunked USING (split, shard, chunk, idx) GROUP BY split, shard, chunk, bin""",
        ),
    }


def packed_sql(length: int) -> str:
    pad = "[{} FOR x IN range({} - n_tokens)]"
    return (
        "SELECT split, shard, chunk, bin, n_rows, n_tokens, "
        + digest_sql(f"ids || {pad.format(PAD_ID, length)}") + " AS ids_md5, "
        + digest_sql(f"labels || {pad.format(-100, length)}") + " AS labels_md5, "
        + "n_tokens AS mask_sum FROM packed"
    )
