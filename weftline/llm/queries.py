"""The queries of these operators over the test tables, with their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import (
    byte_bpe,
    chat_format,
    hard_negatives,
    jaccard_join,
    language_id,
    line_dedup,
    packing,
    quality_classifier,
    quality_rules,
    spelling,
    token_counts,
    topk,
    url_filters,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")



UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Of every document the words, A-Z lowered.
WORDS_SQL = rf"""
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[^\x20\x09-\x0D]+') AS w FROM documents"""


@query(
    "op1_jaccard_join",
    f"""
    WITH RECURSIVE words AS ({WORDS_SQL}),
    sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
            ELSE list_distinct([w[i : i + 4] FOR i IN range(1, len(w) - 3)]) END AS s FROM words),
    parts AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
    shared AS (
        SELECT a.doc_id AS p, b.doc_id AS q, a.n AS n, b.n AS m, count(*) AS k
        FROM parts a JOIN parts b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (SELECT p, q FROM shared WHERE 100 * k >= 80 * (n + m - k)),
    reach(doc_id, v) AS (
        SELECT doc_id, doc_id FROM sets
        UNION SELECT r.doc_id, l.q FROM reach r JOIN links l ON l.p = r.v)
    SELECT doc_id, any_value(len(s))::BIGINT AS n_shingles, min(v) AS component_id
    FROM reach JOIN sets USING (doc_id) GROUP BY doc_id""",
)
def op1(spark: SparkSession, root: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, root, "documents"))


# Lines with their place and key, and the keys that only one document keeps.
LINES_SQL = f"""
    lines AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
            generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
    keyed AS (
        SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            '{UPPER}', '{LOWER}') AS k FROM lines),
    repeated AS (
        SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
        GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
    marked AS (
        SELECT doc_id, i, line, keeper IS NOT NULL AND keeper <> doc_id AS gone
        FROM keyed LEFT JOIN repeated USING (k))"""


@query(
    "op2_line_dedup",
    f"""
    WITH {LINES_SQL}
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY doc_id""",
)
def op2(spark: SparkSession, root: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, root, "documents"))
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


@query(
    "op3_topk_search",
    """
    WITH v AS (
        SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
        WHERE embedding IS NOT NULL
            AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
    SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
        FROM scored) WHERE rank <= 20""",
)
def op3(spark: SparkSession, root: str) -> DataFrame:
    return topk.top_k(table(spark, root, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op4_language_id")
def op4(spark: SparkSession, root: str) -> DataFrame:
    """Learn from four folds of five, then predict every document; SQL has no such model."""
    documents = table(spark, root, "documents")
    fold = language_id.held_out(F.col("doc_id"))
    model = language_id.learn(documents.where(~fold))
    return language_id.identify(documents.withColumn("held_out", fold), ["doc_id", "held_out"], model)


RULES_SQL = r"""
    docs AS (
        SELECT doc_id, coalesce(source, '') AS host, text, coalesce(text, '') AS t,
            regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    windows AS (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, three) AS n FROM (
            SELECT doc_id, generate_subscripts(threes, 1) AS i, unnest(threes) AS three FROM (
                SELECT doc_id, [w[i : i + 2] FOR i IN range(1, len(w) - 1)] AS threes FROM docs))),
    repeats AS (
        SELECT doc_id, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE n >= 2) GROUP BY doc_id),
    raw AS (
        SELECT doc_id, host, i, line FROM (
            SELECT doc_id, host, unnest(string_split(t, chr(10))) AS line,
                generate_subscripts(string_split(t, chr(10)), 1) AS i FROM docs)
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
    dups AS (
        SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM raw GROUP BY doc_id),
    norm AS (
        SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k,
            len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM raw),
    hosts AS (SELECT host, count(DISTINCT doc_id) AS n_host FROM docs GROUP BY host),
    common AS (
        SELECT host, k, min(doc_id) AS keeper FROM norm JOIN hosts USING (host) GROUP BY host, k, n_host
        HAVING count(DISTINCT doc_id) > 100
            OR (count(DISTINCT doc_id) >= 5 AND 100 * count(DISTINCT doc_id) > 10 * n_host)),
    gone AS (SELECT doc_id, i, n FROM norm JOIN common USING (host, k) WHERE doc_id <> keeper),
    losses AS (SELECT doc_id, sum(n)::BIGINT AS n_removed FROM gone GROUP BY doc_id),
    cleaned AS (
        SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS cleaned FROM (
            SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                generate_subscripts(string_split(text, chr(10)), 1) AS i FROM docs)
        ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
    judged AS (
        SELECT doc_id, len(w)::BIGINT AS n_words,
            length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
            length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
            coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
            coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
            coalesce(n_removed, 0)::BIGINT AS n_removed,
            CASE WHEN text IS NOT NULL THEN sha256(coalesce(cleaned, '')) END AS cleaned_sha256
        FROM docs LEFT JOIN repeats USING (doc_id) LEFT JOIN dups USING (doc_id)
        LEFT JOIN losses USING (doc_id) LEFT JOIN cleaned USING (doc_id)),
    rules AS (
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
            NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
            AND 100 * (n_words - n_removed) >= 30 * n_words AS kept FROM judged)"""


@query("op5_quality_rules", f"WITH {RULES_SQL} SELECT * FROM rules")
def op5(spark: SparkSession, root: str) -> DataFrame:
    judged = quality_rules.judge_documents(table(spark, root, "documents"), ["doc_id"], cleaned=True)
    digest = F.sha2(F.col("cleaned").cast("binary"), 256).alias("cleaned_sha256")
    return judged.select("*", digest).drop("cleaned")


SAID = "</s>[INST] ok [/INST]"


@query(
    "op6_chat_format",
    rf"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '{SAID}' UNION ALL SELECT -1, 1, 'assistant', '{SAID}'),
    said AS (
        SELECT conv_id, coalesce(string_agg(text, '' ORDER BY turn, role, text)
            FILTER (role = 'assistant'), '') AS loss,
            string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
            count(*) AS n_turns,
            sum(length('<|start|><|text|><|end|>') + 1
                + length(regexp_replace(role, '<(\\*)\|', '<\1\\|', 'g'))
                + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')))::BIGINT AS formatted_chars
        FROM turns GROUP BY conv_id)
    SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
        sha256(loss) AS loss_sha256, formatted_chars FROM said""",
)
def op6(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", SAID), (-1, 1, "assistant", SAID)], rows.schema)
    return chat_format.read_back(chat_format.format_chats(rows.union(more)))


@query("op7_token_counts")
def op7(spark: SparkSession, root: str) -> DataFrame:
    """Tokens of every line of source and text; SQL knows no tokenizer."""
    rules = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return token_counts.count_tokens(
        table(spark, root, "documents"), ["doc_id"], ["source", "text"], *rules
    )


@query("op8_byte_bpe")
def op8(spark: SparkSession, root: str) -> DataFrame:
    """Encode every document, then decode its ids; SQL cannot merge byte pairs."""
    rules = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    decoded = byte_bpe.round_trip_documents(table(spark, root, "documents"), ["doc_id"], *rules)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op9_best_fit_packing")
def op9(spark: SparkSession, root: str) -> DataFrame:
    """Cut and pack all documents; SQL knows no tokenizer."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(table(spark, root, "documents"), "doc_id", path)


@query("op10_quality_classifier")
def op10(spark: SparkSession, root: str) -> DataFrame:
    """Label, fit and score all documents; SQL has no such model."""
    return quality_classifier.classify(table(spark, root, "documents"), ["doc_id"])


@query(
    "op11_hard_negatives",
    """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            [floor(256 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
        WHERE embedding IS NOT NULL AND label IS NOT NULL
            AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    scored AS (
        SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
            list_inner_product(a.e, c.e)::BIGINT AS score
        FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
    negatives AS (
        SELECT anchor_id, positive_id, n.vec_id AS negative_id, positive_score, n.score AS negative_score,
            row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) AS rank
        FROM positives p JOIN scored n USING (anchor_id)
        WHERE NOT n.same AND 80 * positive_score <= 100 * n.score AND n.score <= positive_score)
    SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
    FROM negatives WHERE rank <= 5""",
)
def op11(spark: SparkSession, root: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    label = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine_negatives(table(spark, root, "embeddings"), vec_id % 100 == 0, label)


URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def _labelled_sql() -> str:
    rows = [(u, 1) for u in url_filters.BLOCKED] + [(u, 0) for u in url_filters.ALLOWED]
    return ", ".join(f"('{u}', {y})" for u, y in rows)


def _grams_sql(kind: str, text: str) -> str:
    letters = f"['^'] || regexp_extract_all({text}, '(?s).') || ['$']"
    each = " || ".join(
        f"['{kind}' || array_to_string(({letters})[i : i + {n - 1}], '') "
        f"FOR i IN range(1, len({letters}) - {n - 2})]"
        for n in url_filters.ORDERS
    )
    return f"CASE WHEN {text} = '' THEN [] ELSE {each} END"


@query(
    "op12_url_filters",
    rf"""
    WITH RECURSIVE labelled(url, blocked) AS (VALUES {_labelled_sql()}),
    urls AS (
        SELECT page_id, coalesce(url, '') AS url, NULL::INTEGER AS blocked FROM pages
        UNION ALL SELECT NULL, url, blocked FROM labelled),
    rests AS (
        SELECT row_number() OVER () AS i, *, CASE WHEN strpos(url, '://') > 0
            THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM urls),
    parts AS (
        SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
    grams AS (
        SELECT i, page_id, blocked, host, path,
            list_distinct([('0x' || substr(md5(g), 1, 8))::BIGINT % {url_filters.BUCKETS} FOR g IN
                ({_grams_sql('h', 'host')}) || ({_grams_sql('p', 'path')})]) AS buckets FROM parts),
    features AS (
        SELECT i, page_id, blocked, 1 / sqrt(len(buckets) + 1) AS scale,
            unnest(buckets || [{url_filters.BUCKETS}]) AS bucket
        FROM grams WHERE len(buckets) > 0),
    trained AS (SELECT * FROM features WHERE blocked IS NOT NULL),
    fit(r, bucket, w) AS (
        SELECT DISTINCT 0, bucket, 0.0::DOUBLE FROM trained
        UNION ALL
        SELECT f.r + 1, f.bucket, f.w + {url_filters.RATE} * (g.slope - {url_filters.SHRINK} * f.w)
        FROM fit f JOIN (
            SELECT x.bucket, sum(e.miss) / (SELECT count(*) FROM labelled) AS slope
            FROM trained x JOIN (
                SELECT i, t.scale * (t.blocked - 1 / (1 + exp(-t.scale * sum(w)))) AS miss
                FROM fit JOIN trained t USING (bucket) GROUP BY t.i, t.blocked, t.scale) e USING (i)
            GROUP BY x.bucket) g USING (bucket)
        WHERE f.r < {url_filters.ROUNDS}),
    scores AS (
        SELECT i, any_value(scale) * sum(coalesce(w, 0)) AS logit FROM features
        LEFT JOIN (SELECT bucket, w FROM fit WHERE r = {url_filters.ROUNDS}) USING (bucket)
        WHERE blocked IS NULL GROUP BY i),
    rules(verdict, rule) AS (VALUES {", ".join(map(str, URL_RULES))}),
    fitting AS (
        SELECT i, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
        FROM parts JOIN rules ON (host = split_part(rule, '/', 1)
                OR ends_with(host, '.' || split_part(rule, '/', 1)))
            AND starts_with(path, substr(rule, strpos(rule, '/')))
        GROUP BY i)
    SELECT page_id, host, path, rule,
        coalesce(verdict, CASE WHEN logit > 0 THEN 'block' ELSE 'allow' END) AS verdict
    FROM grams LEFT JOIN fitting USING (i) LEFT JOIN scores USING (i) WHERE blocked IS NULL""",
)
def op12(spark: SparkSession, root: str) -> DataFrame:
    judged = url_filters.judge_urls(table(spark, root, "pages"), ["page_id"], URL_RULES)
    return judged.drop("score")


# The CRC-32 of a run's bytes, by the rule of its table.
CRC_SQL = """
    step(i, k, c) AS (
        SELECT range, 0, range FROM range(256)
        UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
        FROM step WHERE k < 8),
    crc(t) AS (SELECT list(c ORDER BY i) FROM step WHERE k = 8)"""


@query(
    "op13_spelling_variants",
    rf"""
    WITH RECURSIVE {CRC_SQL},
    runs AS (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'),
            '[A-Za-zÀ-ÿ]+')) AS w FROM documents),
    -- Equal runs of one document are hashed once.
    own AS (SELECT doc_id, w, count(*) AS n FROM runs WHERE length(w) >= 6 GROUP BY ALL),
    hashed AS (
        SELECT w, n, xor(list_reduce(
            [4294967295] || flatten([CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT]
                ELSE [195, ord(c)::BIGINT - 64] END FOR c IN string_split(doc_id || ':' || w, '')]),
            lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS h
        FROM own, crc),
    words AS (
        SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, (h % length(w))::BIGINT)
            || substr(w, (h % length(w))::BIGINT + 2) ELSE w END AS word, sum(n)::BIGINT AS n
        FROM hashed GROUP BY 1),
    v AS (SELECT * FROM words WHERE length(word) >= 6 AND n >= 5),
    cuts AS (
        SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b
        FROM v, unnest(range(1, length(word) + 1)) AS u(i)),
    pairs AS (
        SELECT p.word, q.word AS other, q.n AS m FROM cuts p JOIN cuts q
            ON p.i = q.i AND p.a = q.a AND p.b = q.b AND p.word <> q.word
        UNION SELECT c.word, v.word, v.n FROM cuts c JOIN v ON v.word = c.a || c.b
        UNION SELECT v.word, c.word, c.n FROM cuts c JOIN v ON v.word = c.a || c.b),
    best AS (
        SELECT word, count(*) AS n_near, max(m) AS m, arg_min(other, (-m, other)) AS form
        FROM pairs GROUP BY word),
    forms AS (
        SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * n THEN form END AS form,
            CASE WHEN m >= 5 * n THEN m END AS form_n
        FROM v LEFT JOIN best USING (word)),
    walk(word, place, form) AS (
        SELECT word, word, form FROM forms
        UNION ALL SELECT w.word, w.form, f.form FROM walk w JOIN forms f ON f.word = w.form)
    SELECT f.*, w.place AS root FROM forms f JOIN walk w ON w.word = f.word AND w.form IS NULL""",
)
def op13(spark: SparkSession, root: str) -> DataFrame:
    return spelling.spelling_groups(spelling.counted_words(table(spark, root, "documents")))
