"""Templates, tokens, examples, packing, prepared datasets."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import views as v
from checks.q_profile import rounded
from checks.q_rows import CHUNK_ROWS, SHARDS
from checks.registry import Tables, digest, query
from weftline.functions.arrays import total
from weftline.functions.template_text import compile_template
from weftline.functions.templates import (
    RenderOptions,
    Template,
    rich_messages,
    segments,
    segments_text,
    template_for_model,
)
from weftline.functions.tokens import RegexTokenizer, stored_vocabulary
from weftline.operators import examples, indexing, inspect, packing, profile, vocabulary
from weftline.operators.lookup import HOT_BYTES
from weftline.params import DataParams
from weftline.plans import prepare
from weftline.session import scratch_path, staged
from weftline.sources.readers import chat_column, spread
from weftline.streaming import incremental
from weftline.streaming import packing as stream_packing
from weftline.plans.verify import verify_dataset as verify_plan

SYSTEM = "You are a helpful tutor."
PACK_LENGTH, CHAT_LENGTH = 1536, 256
PRETRAIN = DataParams(
    max_seq_length=PACK_LENGTH, is_continue_pretrain=True, num_shards=SHARDS, chunk_rows=CHUNK_ROWS
)
INSTRUCT = DataParams(max_seq_length=CHAT_LENGTH, num_shards=4, chunk_rows=25)

# ------------------------------------------------------------------ templates


def _rendered(df: DataFrame, template: str | Template, **options) -> DataFrame:
    shown = examples.rendered(df, template, options=RenderOptions(**options))
    trained = F.aggregate(
        F.filter("segments", lambda s: s["trainable"]),
        F.lit(0),
        lambda acc, s: acc + F.length(s["text"]),
    )
    return shown.where(F.col("error").isNull()).select(
        "conv_id",
        F.md5(segments_text(F.col("segments"))).alias("text_md5"),
        trained.cast("bigint").alias("n_trainable_chars"),
    )


def _rendered_sql(segs: str) -> str:
    return f"""SELECT conv_id, md5(string_agg(text, '' ORDER BY ord)) AS text_md5,
    coalesce(sum(length(text)) FILTER (trainable), 0)::BIGINT AS n_trainable_chars
  FROM {segs} GROUP BY conv_id"""


@query("render_simple", v.with_views(_rendered_sql("simple_segments"), "simple_segments"))
def render_simple(t: Tables):
    return _rendered(v.chats(t), "simple")


@query("render_role_tags", v.with_views(_rendered_sql("role_tag_segments"), "role_tag_segments"))
def render_role_tags(t: Tables):
    return _rendered(v.chats(t), "role_tags")


@query(
    "render_by_family",
    v.with_views(
        f"""SELECT 'mistral' AS family, * FROM ({_rendered_sql('simple_segments')})
  UNION ALL SELECT 'phi-3', * FROM ({_rendered_sql('role_tag_segments')})""",
        "simple_segments",
        "role_tag_segments",
    ),
)
def render_by_family(t: Tables):
    """Templates chosen by model names."""
    models = {"mistral": "Org/Mistral-7B-v0.3", "phi-3": "org/Phi-3-mini"}
    frames = [
        _rendered(v.chats(t), template_for_model(model)).withColumn("family", F.lit(family))
        for family, model in models.items()
    ]
    return frames[0].unionByName(frames[1])


@query("render_spans", v.with_views(_rendered_sql("marked_segments"), "marked_segments"))
def render_spans(t: Tables):
    return _rendered(v.chats(t), "marked")


# The built-in plain templates as a file would give them.
TEMPLATE_TEXTS = {
    "simple": """
{%- for message in messages -%}
    {%- if message.role == 'user' -%}
        {{ bos_token if_first }}[INST]{{ message.content }}[/INST]
    {%- elif message['role'] == "assistant" -%}
        {% generation %}{{ message['content'] + eos_token }}{% endgeneration %}
    {%- endif -%}
{%- endfor -%}""".replace("{{ bos_token if_first }}", "{% if loop.index0 == 0 %}{{ bos_token }}{% endif %}"),
    "role_tags": """
{%- for message in messages %}
    {% if message.role == 'system' and message.content | trim %}
{{ '<|system|>\\n' }}{{ message.content | trim }}{{ "<|end|>\\n" -}}
    {% elif message.role == 'user' %}
{{ '<|user|>\\n' + (message.content | trim) ~ '<|end|>\\n' -}}
    {% elif message.role == 'assistant' %}
<|assistant|>
{% generation %}{{ message.content | trim }}<|end|>
{% endgeneration %}
    {%- endif %}
{% endfor -%}
{% if add_generation_prompt %}{{ '<|assistant|>\\n' }}{% else %}{% generation %}{{ eos_token }}{% endgeneration %}{% endif %}""",
    "marked": """{# a system prompt, then turns #}{{ bos_token }}
{%- if messages[0].role == 'system' -%}
    [SYSTEM_PROMPT]{{ messages[0]['content'] }}[/SYSTEM_PROMPT]
{%- elif default_system -%}
    [SYSTEM_PROMPT]{{ default_system }}[/SYSTEM_PROMPT]
{%- endif %}
{% for message in messages %}
{% if message.role == 'user' %}[INST]{{ message.content }}[/INST]
{%- elif not (message.role != 'assistant') %}{% generation %}{{ message.content }}{{ eos_token }}{% endgeneration %}{% endif %}
{% endfor %}""",
    "v3_no_bos_in_loop": """{{- bos_token -}}
{%- for message in messages -%}
    {%- if message.role == 'user' -%}
        [INST]{{ message.content }}[/INST]
    {%- elif message.role == 'assistant' -%}
        {%- generation -%}{{ message.content }}{%- endgeneration -%}{{ eos_token }}
    {%- endif -%}
{%- endfor -%}""",
}


def _variant_sql(variant: str, bos_head: bool, bos_user: str, eos_inside: bool) -> str:
    head = (
        "UNION ALL SELECT conv_id, -1, '<s>', false FROM conversations GROUP BY conv_id"
        if bos_head
        else ""
    )
    if eos_inside:
        answer = "SELECT conv_id, turn * 2, text || '</s>', true FROM conversations WHERE role = 'assistant'"
    else:
        answer = (
            "SELECT conv_id, turn * 2, text, true FROM conversations WHERE role = 'assistant' UNION ALL "
            "SELECT conv_id, turn * 2 + 1, '</s>', false FROM conversations WHERE role = 'assistant'"
        )
    segs = (
        f"(SELECT conv_id, turn * 2 AS ord, '{bos_user}[INST]' || text || '[/INST]' AS text, "
        f"false AS trainable FROM conversations WHERE role = 'user' UNION ALL {answer} {head})"
    )
    return f"SELECT '{variant}' AS variant, * FROM ({_rendered_sql(segs)})"


@query(
    "render_variants",
    " UNION ALL ".join(
        [
            _variant_sql("v1_simple", True, "", True),
            _variant_sql("v2_multiline", False, "<s>", True),
            _variant_sql("v3_no_bos_in_loop", True, "", False),
            _variant_sql("v4_eos_inside", True, "", True),
        ]
    ),
)
def render_variants(t: Tables):
    names = ("v1_simple", "v2_multiline", "v3_no_bos_in_loop", "v4_eos_inside")
    chats = v.chats(t)
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("variant"),
                "conv_id",
                segments(F.col("messages"), name).alias("segments"),
            )
            for name in names
        ]
    )
    flat = chats.select(F.inline(rows))
    trained = F.aggregate(
        F.filter("segments", lambda s: s["trainable"]),
        F.lit(0),
        lambda acc, s: acc + F.length(s["text"]),
    )
    return flat.select(
        "variant",
        "conv_id",
        F.md5(segments_text(F.col("segments"))).alias("text_md5"),
        trained.cast("bigint").alias("n_trainable_chars"),
    )


def full_segments(source: str, default_system: str = "", tools: bool = False) -> str:
    """Segments of the full template from rich message rows."""
    head = "'<s>'"
    if default_system:
        head += (
            " || CASE WHEN bool_or(role = 'system' AND turn = 0) THEN '' ELSE "
            f"'[SYSTEM_PROMPT]{default_system}[/SYSTEM_PROMPT]' END"
        )
    offered = (
        "CASE WHEN conv_id % 6 = 0 THEN '[AVAILABLE_TOOLS][{\"name\":\"lookup\"}][/AVAILABLE_TOOLS]' "
        "ELSE '' END"
        if tools
        else "''"
    )
    return rf"""
  SELECT conv_id, -2 AS ord, {head} AS text, false AS trainable FROM {source} GROUP BY conv_id
  UNION ALL SELECT conv_id, CASE WHEN bool_or(role = 'system' AND turn = 0) THEN 5 ELSE -1 END,
    {offered}, false FROM {source} GROUP BY conv_id
  UNION ALL SELECT conv_id, turn * 10 + part, CASE role
      WHEN 'system' THEN '[SYSTEM_PROMPT]' || txt || '[/SYSTEM_PROMPT]'
      WHEN 'user' THEN '[INST]' || coalesce(txt, array_to_string([CASE WHEN b.type = 'text'
          THEN b.text ELSE '[IMG]' END FOR b IN CASE WHEN len(blocks) = 2
          THEN [blocks[2], blocks[1]] ELSE blocks END], '')) || '[/INST]'
      WHEN 'tool' THEN '[TOOL_RESULTS]' || txt || '[/TOOL_RESULTS]'
      ELSE coalesce(txt, '') || coalesce(array_to_string(['[TOOL_CALLS]' || c.name || '[ARGS]' ||
          CASE WHEN c.arguments = '' THEN '{{}}' ELSE c.arguments END FOR c IN calls], ''), '')
          || '</s>' END, role = 'assistant' FROM {source}"""


@query(
    "render_full",
    v.with_views(_rendered_sql("segs"), segs=(("rich",), full_segments("rich"))),
)
def render_full(t: Tables):
    return _rendered(v.rich_chats(t), "full")


@query(
    "render_full_nested_calls",
    v.with_views(_rendered_sql("segs"), segs=(("rich",), full_segments("rich"))),
)
def render_full_nested_calls(t: Tables):
    """The same chats with fields in another order and calls under ``function``."""

    def nested(m):
        calls = F.transform(
            m["tool_calls"],
            lambda c: F.struct(
                F.lit("call").alias("id"),
                F.struct(c["arguments"].alias("arguments"), c["name"].alias("name")).alias("function"),
            ),
        )
        blocks = F.transform(m["blocks"], lambda b: F.struct(b["text"].alias("text"), b["type"].alias("type")))
        return F.struct(
            calls.alias("tool_calls"), blocks.alias("blocks"), m["text"].alias("text"), m["role"].alias("role")
        )

    return _rendered(v.rich_chats(t).withColumn("messages", F.transform("messages", nested)), "full")


@query(
    "render_full_default_system",
    v.with_views(_rendered_sql("segs"), segs=(("rich",), full_segments("rich", SYSTEM, True))),
)
def render_full_default_system(t: Tables):
    return _rendered(
        v.rich_chats(t), "full", default_system=SYSTEM, tools=F.col("tools")
    )


_ERRORS = {
    "coded": (
        ("faulty",),
        """SELECT conv_id, turn, part, CASE
      WHEN role = 'user' AND txt IS NULL AND len(list_filter([b.type FOR b IN blocks],
        lambda x: x NOT IN ('text', 'image', 'image_url'))) > 0 THEN 'user_block_type'
      WHEN role = 'assistant' AND coalesce(txt, '') = '' AND blocks IS NULL AND calls IS NULL
        THEN 'assistant_content_empty'
      WHEN role NOT IN ('user', 'assistant', 'tool', 'system') THEN 'unknown_role' END AS code
    FROM faulty""",
    ),
    "turns": (
        ("faulty",),
        """SELECT conv_id, bool_and((role = 'user') = (k % 2 = 0)) AS fine FROM (SELECT conv_id, role,
      row_number() OVER (PARTITION BY conv_id ORDER BY turn, part) - 1 AS k FROM faulty
      WHERE role = 'user' OR (role = 'assistant' AND calls IS NULL)) GROUP BY conv_id""",
    ),
    "rejects": (
        ("coded", "turns", "faulty"),
        """SELECT conv_id, CASE WHEN system_bad THEN 'system_block_type'
      WHEN fine = false THEN 'roles_not_alternating' ELSE code END AS error
    FROM (SELECT conv_id, first(code ORDER BY turn, part) FILTER (code IS NOT NULL) AS code
      FROM coded GROUP BY conv_id)
    JOIN (SELECT conv_id, bool_or(role = 'system' AND txt IS NULL) AS system_bad FROM faulty
      GROUP BY conv_id) USING (conv_id)
    LEFT JOIN turns USING (conv_id)""",
    ),
}


@query(
    "template_rejects",
    v.with_views("SELECT conv_id, error FROM rejects WHERE error IS NOT NULL", **_ERRORS),
)
def template_rejects(t: Tables):
    return examples.template_rejects(v.rich_chats(t, faulty=True), ["conv_id"])


# --------------------------------------------------------------------- tokens


@query(
    "tokenize_regex",
    v.with_views(
        f"SELECT doc_id, len(ids) AS n_tokens, {v.digest_sql('ids')} AS ids_md5 FROM doc_tokens",
        "doc_tokens",
    ),
)
def tokenize_regex(t: Tables):
    docs = spread(t.texts()).select("doc_id", v.TOK.encode(F.col("text")).alias("ids"))
    return docs.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), digest(F.col("ids")).alias("ids_md5")
    )


@query(
    "tokenize_truncate",
    v.with_views(
        f"SELECT doc_id, len(ids[1:64]) AS n_tokens, {v.digest_sql('ids[1:64]')} AS ids_md5 "
        "FROM doc_tokens",
        "doc_tokens",
    ),
)
def tokenize_truncate(t: Tables):
    cut = examples.text_examples(t.texts(), ["doc_id"], v.TOK, 64)
    return cut.select(
        "doc_id",
        F.size("input_ids").cast("bigint").alias("n_tokens"),
        digest(F.col("input_ids")).alias("ids_md5"),
    )


_PIECES_MD5 = v.digest_sql("p")


BOS_ID = v.TOK.special_id(v.TOK.markers.bos)


@query(
    "encode_with_bos",
    v.with_views(
        f"SELECT doc_id, len(a) AS n_tokens, {v.digest_sql('a')} AS ids_md5 "
        f"FROM (SELECT doc_id, ([{BOS_ID}] || ids)[1:64] AS a FROM doc_tokens)",
        "doc_tokens",
    ),
)
def encode_with_bos(t: Tables):
    rows = examples.encode_texts(t.texts(), ["doc_id"], v.TOK, 64, add_bos=True)
    return rows.select(
        "doc_id",
        F.size("input_ids").cast("bigint").alias("n_tokens"),
        digest(F.col("input_ids")).alias("ids_md5"),
    )


@query(
    "decode_roundtrip",
    f"""SELECT doc_id, len(p) AS n_pieces, {_PIECES_MD5} AS pieces_md5
  FROM (SELECT doc_id, {v.pieces("text")} AS p FROM documents)""",
)
def decode_roundtrip(t: Tables):
    return _decoded(t.texts(), t.texts())


@query(
    "decode_split",
    f"""SELECT doc_id, len(p) AS n_pieces, {_PIECES_MD5} AS pieces_md5
  FROM (SELECT doc_id, {v.pieces("text")} AS p FROM documents)""",
)
def decode_split(t: Tables):
    """With room for a few hundred frequent pieces: the others are looked up by a shuffle."""
    return _decoded(t.texts(), t.texts(), most_bytes=1 << 14)


@query(
    "decode_known",
    v.with_views(
        f"""SELECT doc_id, len(p) AS n_pieces, {_PIECES_MD5} AS pieces_md5
  FROM (SELECT doc_id, coalesce(list(CASE WHEN known.piece IS NULL THEN '<unk>' ELSE x END ORDER BY i)
      FILTER (x IS NOT NULL), []) AS p
    FROM (SELECT doc_id, NULL AS x, 0 AS i FROM blanked_docs UNION ALL
      SELECT doc_id, unnest({v.pieces("text")}), generate_subscripts({v.pieces("text")}, 1)
      FROM blanked_docs)
    LEFT JOIN (SELECT DISTINCT unnest({v.pieces("text")}) AS piece FROM documents
      WHERE doc_id % 2 = 0) known ON known.piece = x GROUP BY doc_id)""",
        "blanked_docs",
    ),
)
def decode_known(t: Tables):
    """A vocabulary of half the documents: unknown pieces and empty rows show."""
    return _decoded(v.blanked_docs(t), t.texts().where(F.col("doc_id") % 2 == 0))


def _decoded(docs: DataFrame, source: DataFrame, most_bytes: int = HOT_BYTES) -> DataFrame:
    vocab = staged(stored_vocabulary(spread(source), F.col("text"), v.TOK), "vocabulary")
    ids = inspect.encode_stored(spread(docs), ["doc_id"], F.col("text"), v.TOK, vocab, most_bytes)
    back = inspect.decode_ids(ids, ["doc_id"], "ids", vocab, most_bytes)
    return back.select(
        "doc_id",
        F.size("pieces").cast("bigint").alias("n_pieces"),
        digest(F.col("pieces")).alias("pieces_md5"),
    )


def _grown(t: Tables) -> DataFrame:
    """A vocabulary after three deliveries of documents, the second with a new special token."""
    vocab = vocabulary.no_vocabulary(t.spark)
    for turn, specials in enumerate((v.TOK.specials, ["<|extra|>", v.TOK.specials[0]], [])):
        docs = t.texts().where(F.pmod("doc_id", F.lit(3)) == turn)
        vocab = staged(vocabulary.grow_vocabulary(vocab, docs, F.col("text"), specials), "grown")
    return vocab


_GROWN = {
    "delivered": (
        (),
        f"""SELECT piece, doc_id % 3 AS turn, count(*) AS n
  FROM (SELECT doc_id, unnest({v.pieces("text")}) AS piece FROM documents)
  WHERE NOT list_contains({v.SPECIAL_LIST}, piece) GROUP BY ALL""",
    ),
    "numbered": (
        ("delivered",),
        f"""SELECT *, row_number() OVER (PARTITION BY version ORDER BY {v.key_sql('piece')}) AS place
  FROM (SELECT piece, min(turn) AS version, arg_min(n, turn) AS n FROM delivered GROUP BY piece)""",
    ),
    "grown": (
        ("numbered",),
        f"""SELECT 255 + place + (SELECT count(*) FROM numbered b WHERE b.version < a.version) AS token_id,
    piece, false AS special, version::INT AS version, n FROM numbered a
  UNION ALL SELECT k - 1, ({v.SPECIAL_LIST} || ['<|extra|>'])[k], true,
    CASE WHEN k > {len(v.TOK.specials)} THEN 1 ELSE 0 END, 0 FROM range(1, {len(v.TOK.specials) + 2}) AS r(k)""",
    ),
}


@query("grow_vocabulary", v.with_views("SELECT * FROM grown", "grown", **_GROWN))
def grow_vocabulary(t: Tables):
    """Ids that stay as data and special tokens are added."""
    return _grown(t)


@query(
    "encode_grown",
    v.with_views(
        f"""SELECT doc_id, len(ids) AS n_tokens, {v.digest_sql('ids')} AS ids_md5 FROM (
    SELECT doc_id, coalesce(list(token_id ORDER BY i) FILTER (token_id IS NOT NULL), []) AS ids FROM (
      SELECT doc_id, NULL AS piece, 0 AS i FROM documents UNION ALL
      SELECT doc_id, unnest({v.pieces("text")}), generate_subscripts({v.pieces("text")}, 1) FROM documents)
    LEFT JOIN grown USING (piece) GROUP BY doc_id)""",
        "grown",
        **_GROWN,
    ),
)
def encode_grown(t: Tables):
    """All documents by the grown vocabulary."""
    ids = inspect.encode_stored(t.texts(), ["doc_id"], F.col("text"), v.TOK, _grown(t))
    return ids.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), digest(F.col("ids")).alias("ids_md5"))


@query(
    "render_from_text",
    v.with_views(
        f"""SELECT 'simple' AS variant, * FROM ({_rendered_sql('simple_segments')})
  UNION ALL SELECT 'role_tags', * FROM ({_rendered_sql('role_tag_segments')})
  UNION ALL SELECT 'marked', * FROM ({_rendered_sql('marked_segments')})
  UNION ALL {_variant_sql('v3_no_bos_in_loop', True, '', False)}""",
        "simple_segments",
        "role_tag_segments",
        "marked_segments",
    ),
)
def render_from_text(t: Tables):
    """The four plain templates, compiled from text."""
    frames = [
        _rendered(v.chats(t), compile_template(text)).withColumn("variant", F.lit(name))
        for name, text in TEMPLATE_TEXTS.items()
    ]
    return reduce(DataFrame.unionByName, frames)


@query(
    "mask_labels_from_text",
    v.with_views(
        f"""SELECT conv_id, {v.digest_sql(f'ids[1:{CHAT_LENGTH}]')} AS ids_md5,
    {v.digest_sql(f'labels[1:{CHAT_LENGTH}]')} AS labels_md5 FROM simple_tokens""",
        "simple_tokens",
    ),
)
def mask_labels_from_text(t: Tables):
    """Ids and labels of chats under a template that was given as text."""
    rows = examples.encode_chats(
        v.chats(t), ["conv_id"], v.TOK, CHAT_LENGTH, compile_template(TEMPLATE_TEXTS["simple"])
    )
    return rows.select(
        "conv_id", digest(F.col("input_ids")).alias("ids_md5"), digest(F.col("labels")).alias("labels_md5")
    )


def _tagged_text(t: Tables) -> DataFrame:
    return v.tagged(t).select(
        "conv_id", segments_text(segments(F.col("messages"), "simple")).alias("text")
    )


_TAGGED_TEXT = (
    ("tagged_log",),
    """SELECT conv_id, string_agg(CASE role WHEN 'user' THEN CASE WHEN turn = 0 THEN '<s>' ELSE ''
    END || '[INST]' || text || '[/INST]' ELSE text || '</s>' END, '' ORDER BY turn) AS text
  FROM tagged_log WHERE role IN ('user', 'assistant') GROUP BY conv_id""",
)
_PIECE_COUNTS = (
    ("tagged_text",),
    f"SELECT piece, count(*) AS n FROM (SELECT unnest({v.pieces('text')}) AS piece FROM tagged_text) "
    "GROUP BY piece",
)


@query(
    "special_vocab",
    v.with_views(
        f"SELECT token, ({v.FIRST_SPECIAL_ID - 1} + list_position({v.SPECIAL_LIST}, token))::BIGINT AS token_id, "
        f"coalesce(n, 0) AS n FROM (SELECT unnest({v.SPECIAL_LIST}) AS token) "
        "LEFT JOIN piece_counts ON piece = token",
        tagged_text=_TAGGED_TEXT,
        piece_counts=_PIECE_COUNTS,
    ),
)
def special_vocab(t: Tables):
    return inspect.special_vocabulary(_tagged_text(t), F.col("text"), v.TOK)


@query(
    "special_roundtrip",
    v.with_views(
        f"""SELECT token, coalesce(n, 0) AS n_single, CASE WHEN
    {v.SPECIAL_LIST}[{v.piece_id("token")} - {v.FIRST_SPECIAL_ID - 1}] = token THEN coalesce(n, 0) ELSE 0 END
    AS n_same FROM (SELECT unnest({v.SPECIAL_LIST}) AS token) LEFT JOIN piece_counts ON piece = token""",
        tagged_text=_TAGGED_TEXT,
        piece_counts=_PIECE_COUNTS,
    ),
)
def special_roundtrip(t: Tables):
    return inspect.special_roundtrip(_tagged_text(t), F.col("text"), v.TOK)


_BARE = RegexTokenizer(specials=())


@query(
    "marker_positions",
    v.with_views(
        f"""SELECT conv_id, array_to_string([i - 1 FOR x, i IN a IF x = '[/INST]'], ',') AS positions,
    array_to_string([(i - 1)::VARCHAR || ':' || x FOR x, i IN b IF contains(x, 'INST')], ',')
      AS fragments
  FROM (SELECT conv_id, {v.pieces('text')} AS a,
    regexp_extract_all(text, {v.quoted(_BARE.pattern)}) AS b FROM tagged_text)""",
        tagged_text=_TAGGED_TEXT,
    ),
)
def marker_positions(t: Tables):
    text = F.col("text")
    positions, _ = inspect.marker_positions(text, v.TOK, "[/INST]", "INST")
    _, fragments = inspect.marker_positions(text, _BARE, "[/INST]", "INST")
    return _tagged_text(t).select(
        "conv_id",
        F.array_join(positions.cast("array<string>"), ",").alias("positions"),
        F.array_join(fragments, ",").alias("fragments"),
    )


@query(
    "token_report",
    v.with_views(
        f"""SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY ord, i) - 1 AS index,
    {v.piece_id('p')} AS token_id, replace(p, chr(10), '\\n') AS piece,
    CASE WHEN trainable THEN 'TRAIN' ELSE 'SKIP' END AS label
  FROM (SELECT conv_id, ord, trainable, unnest(pieces) AS p, generate_subscripts(pieces, 1) AS i
    FROM (SELECT conv_id, ord, trainable, {v.pieces('text')} AS pieces FROM marked_segments))""",
        "marked_segments",
    ),
)
def token_report(t: Tables):
    shown = examples.rendered(v.chats(t), "marked")
    return inspect.token_report(shown, ["conv_id"], "segments", v.TOK)


@query(
    "marker_audit",
    v.with_views(
        f"""SELECT count(*) AS n_rows, count_if(contains(text, '[INST]'))::BIGINT AS n_text_marker,
    count_if(list_contains({v.pieces('text')}, '[/INST]'))::BIGINT AS n_id_marker FROM tagged_text""",
        tagged_text=_TAGGED_TEXT,
    ),
)
def marker_audit(t: Tables):
    text = F.col("text")
    return profile.marker_audit(
        _tagged_text(t), text, v.TOK.encode(text), "[INST]", v.TOK.special_id("[/INST]")
    )


# ------------------------------------------------------------------- examples


def _example_digests(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(
        *keys,
        F.size("input_ids").cast("bigint").alias("n_tokens"),
        digest(F.col("input_ids")).alias("ids_md5"),
        digest(F.col("labels")).alias("labels_md5"),
        F.size(F.filter("labels", lambda x: x != -100)).cast("bigint").alias("n_labels"),
    )


def _example_sql(source: str, length: int) -> str:
    return f"""SELECT conv_id, len(ids[1:{length}]) AS n_tokens,
    {v.digest_sql(f'ids[1:{length}]')} AS ids_md5, {v.digest_sql(f'labels[1:{length}]')} AS labels_md5,
    len([x FOR x IN labels[1:{length}] IF x <> -100]) AS n_labels FROM {source}"""


@query(
    "mask_labels", v.with_views(_example_sql("simple_tokens", CHAT_LENGTH), "simple_tokens")
)
def mask_labels(t: Tables):
    rows = examples.instruction_examples(v.chats(t), ["conv_id"], v.TOK, CHAT_LENGTH)
    return _example_digests(rows, "conv_id")


@query(
    "mask_labels_role_tags",
    v.with_views(_example_sql("role_tag_tokens", CHAT_LENGTH), "role_tag_tokens"),
)
def mask_labels_role_tags(t: Tables):
    rows = examples.instruction_examples(
        v.chats(t), ["conv_id"], v.TOK, CHAT_LENGTH, template="role_tags"
    )
    return _example_digests(rows, "conv_id")


@query(
    "mask_labels_log", v.with_views(_example_sql("marked_tokens", CHAT_LENGTH), "marked_tokens")
)
def mask_labels_log(t: Tables):
    rows = examples.examples_from_log(t.conversations, v.TOK, CHAT_LENGTH, template="marked")
    return _example_digests(rows, "conv_id")


@query(
    "pretrain_examples",
    v.with_views(
        f"""SELECT doc_id, len(ids) AS n_tokens, {v.digest_sql('ids')} AS ids_md5,
    {v.digest_sql('ids')} AS labels_md5, len(ids) AS n_labels
  FROM (SELECT doc_id, {v.ids('text')}[1:512] AS ids FROM blanked_docs
    WHERE {v.NONBLANK.format('text')})""",
        "blanked_docs",
    ),
)
def pretrain_examples(t: Tables):
    rows = examples.text_examples(v.blanked_docs(t), ["doc_id"], v.TOK, 512)
    return _example_digests(rows, "doc_id")


@query(
    "assistant_mask",
    v.with_views(
        f"SELECT conv_id, len(ids) AS n_tokens, list_sum(mask)::BIGINT AS n_trained, "
        f"{v.digest_sql('mask')} AS mask_md5 FROM marked_tokens",
        "marked_tokens",
    ),
)
def assistant_mask(t: Tables):
    rows = examples.assistant_masks(v.chats(t), ["conv_id"], v.TOK)
    return rows.select(
        "conv_id",
        F.size("input_ids").cast("bigint").alias("n_tokens"),
        total(F.col("assistant_mask")).alias("n_trained"),
        digest(F.col("assistant_mask")).alias("mask_md5"),
    )


@query(
    "label_stats",
    v.with_views(
        f"""SELECT count(*) AS n_rows, sum(len(m))::BIGINT AS n_tokens, sum(list_sum(m))::BIGINT
    AS n_trainable, count_if(list_sum(m) = 0)::BIGINT AS n_untrainable_rows
  FROM (SELECT mask[1:{CHAT_LENGTH}] AS m FROM simple_tokens)""",
        "simple_tokens",
    ),
)
def label_stats(t: Tables):
    rows = examples.instruction_examples(v.chats(t), ["conv_id"], v.TOK, CHAT_LENGTH)
    mask = F.transform("labels", lambda x: (x != -100).cast("int"))
    return profile.label_stats(rows, mask)


# -------------------------------------------------------------------- packing

_DOC_EXAMPLES = (
    ("doc_tokens",),
    f"SELECT doc_id, 'train' AS split, ids[1:{PACK_LENGTH}] AS ids, ids[1:{PACK_LENGTH}] AS labels "
    "FROM doc_tokens WHERE len(ids) > 0",
)
_DOC_PACK = {
    "examples": _DOC_EXAMPLES,
    "chunked": (("examples",), v.chunk_cte("examples", "doc_id", SHARDS, CHUNK_ROWS)),
    **v.bins_ctes(PACK_LENGTH),
}


def _doc_rows(t: Tables) -> DataFrame:
    return examples.usable_texts(t.texts().withColumn("split", F.lit("train")), v.TOK)


def _doc_sizes(t: Tables) -> DataFrame:
    """Lengths and places of the documents; no array of tokens moves."""
    size = F.least(v.TOK.count(F.col("text")), F.lit(PACK_LENGTH))
    rows = spread(_doc_rows(t)).select("doc_id", "split", size.alias("n_tokens"))
    indexed = indexing.dense_index(rows, ["doc_id"], groups=("split",), total="total")
    return indexing.assign_chunks(indexed, SHARDS, CHUNK_ROWS)


def _doc_packed(t: Tables) -> DataFrame:
    """Documents move once, as text, and are encoded where they are packed."""
    rows = _doc_rows(t)
    chunks = indexing.place_in_chunks(rows, ["doc_id"], 42, SHARDS, CHUNK_ROWS, groups=("split",))
    placed = packing.arrange_chunks(chunks, order=indexing.KEY)
    encoded = examples.encode_texts(placed, packing.PLACE, v.TOK, PACK_LENGTH)
    return packing.pack_arranged(encoded.drop("labels"), PACK_LENGTH, v.PAD_ID)


def _packed_digests(packed: DataFrame) -> DataFrame:
    return packed.select(
        "split", "shard", "chunk", "bin", "n_rows", "n_tokens",
        digest(F.col("input_ids")).alias("ids_md5"),
        digest(F.col("labels")).alias("labels_md5"),
        total(F.col("attention_mask")).alias("mask_sum"),
    )


@query(
    "pack_bins",
    v.with_views(
        "SELECT split, shard, chunk, idx, bin, start_at AS bin_start, k AS n_tokens FROM fold",
        recursive=True,
        **_DOC_PACK,
    ),
)
def pack_bins(t: Tables):
    return packing.assign_bins(_doc_sizes(t), PACK_LENGTH)


@query("pack_sequences", v.with_views(v.packed_sql(PACK_LENGTH), recursive=True, **_DOC_PACK))
def pack_sequences(t: Tables):
    return _packed_digests(_doc_packed(t))


@query(
    "pack_stats",
    v.with_views(
        f"""SELECT sum(n_rows)::BIGINT AS n_input, count(*) AS n_packed, sum(n_tokens)::BIGINT AS n_tokens,
    round(sum(n_rows) / count(*), 6) AS ratio,
    round(sum(n_tokens) / (count(*) * {PACK_LENGTH}), 6) AS fill FROM packed""",
        recursive=True,
        **_DOC_PACK,
    ),
)
def pack_stats(t: Tables):
    packed = _doc_packed(t)
    return rounded(profile.pack_stats(packed, PACK_LENGTH), "ratio", "fill")


@query(
    "padding_waste",
    v.with_views(
        f"""SELECT layout, split, n_rows, n_batches, n_tokens, n_cells,
    round(1 - n_tokens / n_cells, 6) AS waste FROM (
      SELECT 'padded' AS layout, split, sum(n)::BIGINT AS n_rows, count(*) AS n_batches,
        sum(k)::BIGINT AS n_tokens, sum(n * ceil(m / 64) * 64)::BIGINT AS n_cells
      FROM (SELECT split, idx // 16 AS batch, count(*) AS n, sum(k) AS k, max(k) AS m
        FROM (SELECT split, idx, least(len(ids), {PACK_LENGTH}) AS k FROM chunked) GROUP BY ALL)
      GROUP BY split
      UNION ALL SELECT 'packed', split, sum(n_rows)::BIGINT, count(*), sum(n_tokens)::BIGINT,
        count(*) * {PACK_LENGTH} FROM packed GROUP BY split)""",
        recursive=True,
        **_DOC_PACK,
    ),
)
def padding_waste(t: Tables):
    """What padding costs in batches and in packed rows, from lengths alone."""
    sized = _doc_sizes(t)
    before = profile.padding_waste(sized, 16, PACK_LENGTH).select(F.lit("padded").alias("layout"), "*")
    after = profile.packing_waste(packing.assign_bins(sized, PACK_LENGTH), PACK_LENGTH)
    return rounded(before.unionByName(after.select(F.lit("packed").alias("layout"), "*")), "waste")


@query(
    "packed_length_check",
    v.with_views(
        f"SELECT count(*) AS n_rows, {PACK_LENGTH}::BIGINT AS min_size, "
        f"{PACK_LENGTH}::BIGINT AS max_size, true AS stackable FROM packed",
        recursive=True,
        **_DOC_PACK,
    ),
)
def packed_length_check(t: Tables):
    packed = _doc_packed(t)
    return packing.length_check(packed, PACK_LENGTH)


@query(
    "pad_batches",
    v.with_views(
        f"""SELECT doc_id, batch, size, {v.digest_sql(f"ids || [{v.PAD_ID} FOR x IN range(size - len(ids))]")}
    AS ids_md5, {v.digest_sql("ids || [-100 FOR x IN range(size - len(ids))]")} AS labels_md5,
    len(ids) AS mask_sum
  FROM (SELECT *, (ceil(max(len(ids)) OVER (PARTITION BY batch) / 64) * 64)::BIGINT AS size
    FROM (SELECT *, (row_number() OVER (ORDER BY {v.key_sql('doc_id')}) - 1) // 16 AS batch
      FROM examples))""",
        examples=_DOC_EXAMPLES,
    ),
)
def pad_batches(t: Tables):
    rows = examples.text_examples(
        spread(t.texts()).withColumn("split", F.lit("train")), ["doc_id", "split"], v.TOK, PACK_LENGTH
    )
    lean = rows.drop("attention_mask", "labels")  # made again from the ids
    indexed = indexing.dense_index(lean, ["doc_id"], groups=("split",))
    padded = packing.pad_batches(indexed, 16, v.PAD_ID)
    return padded.select(
        "doc_id",
        "batch",
        F.size("input_ids").cast("bigint").alias("size"),
        digest(F.col("input_ids")).alias("ids_md5"),
        digest(F.col("labels")).alias("labels_md5"),
        total(F.col("attention_mask")).alias("mask_sum"),
    )


def _arrivals(t: Tables) -> list[DataFrame]:
    """All documents in four deliveries, in order of their ids."""
    last = t.documents.agg(F.max("doc_id")).first()[0] or 0
    part = F.floor(F.col("doc_id") * 4 / (last + 1))
    return [t.texts().where(part == k) for k in range(4)]


@query(
    "pack_stream",
    v.with_views(
        f"""SELECT shard, bin, n_rows, n_tokens,
    {v.digest_sql(f"ids || [{v.PAD_ID} FOR x IN range({PACK_LENGTH} - n_tokens)]")} AS ids_md5,
    {v.digest_sql(f"ids || [-100 FOR x IN range({PACK_LENGTH} - n_tokens)]")} AS labels_md5,
    n_tokens AS mask_sum FROM packed p
  WHERE bin < (SELECT max(bin) FROM packed q WHERE q.shard = p.shard)""",
        recursive=True,
        chunked=(
            ("doc_tokens",),
            "SELECT 'train' AS split, doc_id % 4 AS shard, 0 AS chunk, doc_id AS idx, ids, ids AS labels FROM doc_tokens",
        ),
        **v.bins_ctes(PACK_LENGTH),
    ),
)
def pack_stream(t: Tables):
    """Bins of a stream that is stopped after each delivery; the last one of a shard is still open."""
    source, out, state = (scratch_path(t.spark, n) for n in ("arrivals", "bins", "state"))
    for docs in _arrivals(t):
        docs.write.mode("append").parquet(source)
        rows = incremental.read_new_files(t.spark, source, docs.schema)
        rows = rows.select("doc_id", F.pmod("doc_id", F.lit(4)).alias("shard"), v.TOK.encode(F.col("text")).alias("input_ids"))
        packed = stream_packing.pack_stream(rows, "shard", "doc_id", PACK_LENGTH, v.PAD_ID)
        stream_packing.append_packed(packed, out, state).awaitTermination()
    return t.spark.read.parquet(out).select(
        "shard",
        "bin",
        "n_rows",
        "n_tokens",
        digest(F.col("input_ids")).alias("ids_md5"),
        digest(F.col("labels")).alias("labels_md5"),
        total(F.col("attention_mask")).alias("mask_sum"),
    )


# ---------------------------------------------------------- prepared datasets


@query(
    "prepare_without_key",
    f"""SELECT count(*) AS n_rows, sum(len(ids)) AS n_tokens
  FROM (SELECT {v.ids("text")}[1:{PACK_LENGTH}] AS ids FROM documents) WHERE len(ids) > 0""",
)
def prepare_without_key(t: Tables):
    """A table of text alone, its rows keyed by their place in the files."""
    path = scratch_path(t.spark, "texts")
    t.documents.select("text").write.parquet(path)
    packed = prepare.prepare_job(t.spark, v.TOK, replace(PRETRAIN, dataset_path=path))
    return packed.agg(F.sum("n_rows").alias("n_rows"), F.sum("n_tokens").alias("n_tokens"))


@query(
    "conversations_column",
    v.with_views(_rendered_sql("simple_segments"), "simple_segments"),
)
def conversations_column(t: Tables):
    """Chats whose column is called ``conversations``."""
    return _rendered(chat_column(v.chats(t).withColumnRenamed("messages", "conversations")), "simple")


_PRETRAIN_PACK = {
    "parted": (("blanked_docs",), v.split_cte("blanked_docs", "doc_id")),
    "examples": (
        ("parted",),
        f"SELECT doc_id, split, ids, ids AS labels FROM (SELECT doc_id, split, "
        f"{v.ids('text')}[1:{PACK_LENGTH}] AS ids FROM parted WHERE {v.NONBLANK.format('text')}) "
        "WHERE len(ids) > 0",
    ),
    "chunked": (("examples",), v.chunk_cte("examples", "doc_id", SHARDS, CHUNK_ROWS)),
    **v.bins_ctes(PACK_LENGTH),
}


@query(
    "prepare_pretrain", v.with_views(v.packed_sql(PACK_LENGTH), recursive=True, **_PRETRAIN_PACK)
)
def prepare_pretrain(t: Tables):
    return _packed_digests(
        prepare.prepare_dataset(v.blanked_docs(t), ["doc_id"], v.TOK, PRETRAIN)
    )


def _instruct_pack(tokens: str) -> dict:
    return {
        "parted": (
            (),
            v.split_cte("(SELECT DISTINCT conv_id FROM conversations)", "conv_id"),
        ),
        "examples": (
            ("parted", tokens),
            f"SELECT conv_id, split, ids[1:{CHAT_LENGTH}] AS ids, labels[1:{CHAT_LENGTH}] AS labels "
            f"FROM {tokens} JOIN parted USING (conv_id) WHERE len(ids) > 0",
        ),
        "chunked": (("examples",), v.chunk_cte("examples", "conv_id", 4, 25)),
        **v.bins_ctes(CHAT_LENGTH),
    }


@query(
    "prepare_instruction",
    v.with_views(v.packed_sql(CHAT_LENGTH), recursive=True, **_instruct_pack("simple_tokens")),
)
def prepare_instruction(t: Tables):
    return _packed_digests(
        prepare.prepare_dataset(v.chats(t), ["conv_id"], v.TOK, INSTRUCT, template="simple")
    )


@query(
    "prepare_instruction_log",
    v.with_views(v.packed_sql(CHAT_LENGTH), recursive=True, **_instruct_pack("role_tag_tokens")),
)
def prepare_instruction_log(t: Tables):
    return _packed_digests(
        prepare.prepare_instruction_log(t.conversations, v.TOK, INSTRUCT, template="role_tags")
    )


_VERIFY = {
    **_ERRORS,
    "segs": (
        ("faulty", "rejects"),
        "SELECT s.* FROM (" + full_segments("faulty") + ") s JOIN rejects r "
        "ON r.conv_id = s.conv_id AND r.error IS NULL",
    ),
    "facts": (
        ("segs",),
        f"""SELECT conv_id, string_agg(text, '' ORDER BY ord) AS text,
      bool_or(trainable AND len({v.pieces('text')}) > 0) AS trainable FROM segs GROUP BY conv_id""",
    ),
    "counts": (
        ("facts",),
        f"""SELECT count_if(contains(text, '[INST]')) AS opens, count_if(c > 0) AS closes,
      sum(c) AS occurrences, count_if(trainable) AS trained, count_if(prompt) AS prompted
    FROM (SELECT *, list_contains({v.pieces('text')}, '[SYSTEM_PROMPT]') AS prompt, len([p FOR p IN {v.pieces('text')} IF p = '[/INST]']) AS c FROM facts)""",
    ),
}


@query(
    "verify_dataset",
    v.with_views(
        """SELECT 'rows' AS "check", count(*)::BIGINT AS n FROM rejects
  UNION ALL SELECT 'template_errors', count(error) FROM rejects
  UNION ALL SELECT 'text_has_marker', opens::BIGINT FROM counts
  UNION ALL SELECT 'ids_have_marker', closes::BIGINT FROM counts
  UNION ALL SELECT 'marker_occurrences', occurrences::BIGINT FROM counts
  UNION ALL SELECT 'ids_have_system_prompt', prompted::BIGINT FROM counts
  UNION ALL SELECT 'has_trainable', trained::BIGINT FROM counts
  UNION ALL SELECT 'ids_and_mask_differ', 0 FROM counts""",
        **_VERIFY,
    ),
)
def verify_dataset(t: Tables):
    return verify_plan(v.rich_chats(t, faulty=True), v.TOK)
