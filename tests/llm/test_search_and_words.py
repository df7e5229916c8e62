"""Hard negatives, URL filters and spelling variants against brute force."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from weftline.llm import hard_negatives, spelling, topk, url_filters
from weftline.llm.queries import QUERIES, URL_RULES

ROOT = "/root/testdata/sf0.001"


def negatives(rows, scale, is_anchor, k=5):
    """(id, label, vector) rows to the set of all results, straight from the contract."""
    taken = {}
    for i, label, x in rows:
        if None in (i, label, x) or any(v is None or not np.isfinite(v) for v in x):
            continue
        whole = [int(np.floor(v * scale)) for v in x]
        taken[i] = min(taken.get(i, (label, whole)), (label, whole))
    score = lambda a, b: sum(p * q for p, q in zip(taken[a][1], taken[b][1]))
    out = set()
    for a in filter(is_anchor, taken):
        order = sorted((i for i in taken if i != a), key=lambda i: (-score(a, i), i))
        for p in [i for i in order if taken[i][0] == taken[a][0]][:k]:
            top = score(a, p)
            fit = [i for i in order if taken[i][0] != taken[a][0] and 80 * top <= 100 * score(a, i) <= 100 * top]
            out |= {(a, p, r, i, top, score(a, i)) for r, i in enumerate(fit[:k], 1)}
    return out


@pytest.mark.parametrize("width", [3, 64, 100])
def test_hard_negatives(spark, width):
    draw = random.Random(width)
    near = [[draw.gauss(0, 1) for _ in range(width)] for _ in range(4)]
    rows = [(i, draw.randrange(3), [v + draw.gauss(0, 0.4) for v in draw.choice(near)]) for i in range(300)]
    rows += [(300 + i, i % 3, near[0]) for i in range(40)]  # ties
    rows += [(400, None, near[0]), (401, 1, None), (402, 1, [None] * width), (403, 1, [float("nan")] * width)]
    rows += [(404, 1, [float("inf")] * width), (None, 1, near[0]), (20, 2, near[1]), (20, 2, near[1]), (405, 2, [])]
    rows += [(406, 0, [0.0] * width), (-20, 0, near[2]), (407, 1, near[3][:2])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumn("x", F.lit("y"))
    df = df.withColumns({"rank": F.lit(1), "code": F.lit(2)}).repartition(5)
    anchors = F.col("vec_id") % 20 == 0
    want = negatives(rows, 256, lambda i: i % 20 == 0)
    for block in (4096, 5):
        got = hard_negatives.mine_negatives(df, anchors, block=block)
        assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        got = got.collect()
        assert len(got) == len(want) and set(map(tuple, got)) == want
    assert want
    assert hard_negatives.mine_negatives(df.limit(0), anchors).collect() == []
    assert hard_negatives.mine_negatives(df, F.lit(False)).collect() == []


def test_intervals_hold():
    draw = np.random.default_rng(3)
    for width in (1, 64, 130):
        x = np.concatenate([draw.normal(0, 300, (200, width)), np.zeros((2, width)), np.full((2, width), 9)]).astype(int)
        turn = hard_negatives.rotation(width)
        exact, kept = x[:20] @ x.T, []
        for levels in (1, 2, 4):
            codes = hard_negatives.Codes.of(x, turn, levels)
            low, high = hard_negatives.Anchors(x[:20], turn).intervals(slice(0, 20), codes)
            assert (low <= exact).all() and (exact <= high).all()
            kept.append((high - low).mean())
        assert kept[0] > kept[1] > kept[2]  # each code narrows them


def test_codes_leave_candidates_out(spark):
    """On the test vectors most pairs are never scored."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.floor(256 * np.array([r.embedding for r in rows], float)).astype(np.int64)
    labels, turn = np.array([r.label for r in rows]), hard_negatives.rotation(64)
    batch = hard_negatives.Batch(ids, labels, x, hard_negatives.Codes.of(x, turn, hard_negatives.LEVELS))
    block = hard_negatives.Positives(ids[::100], labels[::100], x[::100], turn, k=5)
    block.meet(batch)
    assert block.scored < 0.1 * block.met


def test_pivots_leave_candidates_out():
    """Clustered vectors: candidates behind the stop are not scored."""
    draw = np.random.default_rng(4)
    near = draw.normal(0, 100, (30, 64))
    x = (near[draw.integers(0, 30, 5000)] + draw.normal(0, 5, (5000, 64))).astype(np.int64)
    table = topk.distances(x, topk.spread_out(x[:1000], 64))
    queries = topk.Queries(np.arange(50), x[:50], table[:50], 20)
    queries.meet(np.arange(5000), x, table)
    for i, (ids, scores) in enumerate(queries.found):
        exact = sorted((-int(s), j) for j, s in enumerate(x[i] @ x.T) if j != i)[:20]
        assert [(-s, j) for j, s in zip(ids, scores)] == exact
    assert queries.scored < 0.2 * queries.met


def verdicts(urls, rules, weigh):
    out = []
    for url in urls:
        rest = (url or "").split("://", 1)
        rest = rest[1] if len(rest) > 1 else ""
        n = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        host, rest = brute.low(rest[:n]), rest[n:]
        path = rest[: next((i for i, c in enumerate(rest) if c in "?#"), len(rest))]
        fit = [
            (len(r), r, v)
            for v, r in rules
            if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0]))
            and path.startswith("/" + r.split("/", 1)[1])
        ]
        _, rule, verdict = max(fit, default=(0, None, None))
        out.append((host, path, rule, verdict or ("block" if weigh(host, path) > 0 else "allow")))
    return out


def url_features(host, path):
    found = set()
    for kind, text in (("h", host), ("p", path)):
        text = f"^{text}$" if text else ""
        for n in (3, 4, 5):
            for i in range(len(text) - n + 1):
                digest = brute.md5((kind + text[i : i + n]).encode())
                found.add(int(digest[:8], 16) % url_filters.BUCKETS)
    return sorted(found)


def fitted(labelled):
    """Gradient descent on dense features."""
    parts = [verdicts([u], [], lambda h, p: 0)[0][:2] for u, _ in labelled]
    x = np.zeros((len(labelled), url_filters.BUCKETS + 1))
    for row, (host, path) in zip(x, parts):
        row[[*url_features(host, path), url_filters.BUCKETS]] = 1
        row /= np.sqrt(row.sum())
    y, w = np.array([b for _, b in labelled], float), np.zeros(x.shape[1])
    for _ in range(url_filters.ROUNDS):
        w += url_filters.RATE * (x.T @ (y - 1 / (1 + np.exp(-x @ w))) / len(y) - url_filters.SHRINK * w)

    def weigh(host, path):
        found = url_features(host, path)
        return (w[found].sum() + w[-1]) / np.sqrt(len(found) + 1) if found else -1.0

    return weigh


ODD_URLS = [
    None, "", "no scheme", "://", "http://", "http:///en/x", "HTTP://WWW.Example.COM/en/a?b#c", "http://com/", "http://com",
    "http://xcom/", "http://a.net/es/", "http://a.net/esx", "http://net/fr/", "http://Ä.net/ES/", "http://x.org?y=/en/", "http://x.org#/z",
    "a://b://c/d", "http://x.com:80/", "http://casino-bets.org/\nwin", "http://www.example.com/en/", "http://a.www.example.com/en/1",
    "http://example.com/en/1", "http://x.org/" + "long/" * 20_000, "http://😀.org/é漢",
]


def test_url_filters(spark):
    rows = [(i, u) for i, u in enumerate(ODD_URLS)] + [(0, None), (7, ODD_URLS[7])]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns(
        {c: F.lit("x") for c in ("host", "path", "w", "buckets", "found")}
    )
    weigh = fitted([(u, 1) for u in url_filters.BLOCKED] + [(u, 0) for u in url_filters.ALLOWED])
    judged = url_filters.judge_urls(df, ["page_id", "found"], URL_RULES)
    got = Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in judged.collect())
    want = Counter((i, *v) for (i, _), v in zip(rows, verdicts([u for _, u in rows], URL_RULES, weigh)))
    assert got == want
    assert {v for *_, v in got} == {"allow", "block"}
    assert url_filters.judge_urls(df.limit(0), ["page_id"], URL_RULES).collect() == []


def test_url_filters_without_rules_or_labels(spark):
    df = spark.createDataFrame([("http://casino-win.test/bonus",), (None,)], "url string")
    assert [r.verdict for r in url_filters.judge_urls(df, ["url"], []).collect()] == ["block", "allow"]
    none = url_filters.labelled_urls(spark).limit(0)
    assert {r.verdict for r in url_filters.judge_urls(df, [], [], none).collect()} == {"allow"}


def test_labelled_urls_are_learned(spark):
    """Held out: every fourth labelled URL is judged by a fit on the others."""
    rows = spark.createDataFrame(
        [(i, u, y) for y, urls in ((1, url_filters.BLOCKED), (0, url_filters.ALLOWED)) for i, u in enumerate(urls)],
        "i int, url string, blocked int",
    )
    right, n = 0, 0
    for fold in range(4):
        held, rest = rows.where(f"i % 4 = {fold}"), rows.where(f"i % 4 <> {fold}").select("url", "blocked")
        judged = url_filters.judge_urls(held, ["blocked"], [], rest).collect()
        right, n = right + sum((r.verdict == "block") == bool(r.blocked) for r in judged), n + len(judged)
    assert n == 80 and right >= 0.8 * n


def variants(words, times=5):
    """{word: n} to {word: (n, n_near, form, form_n, root)}, all pairs compared."""

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(b) - len(a) > 1 or a == b:
            return False
        i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return a[i + (len(a) == len(b)) :] == b[i + 1 :]

    out, forms = {}, {}
    for w, n in words.items():
        found = sorted((-words[x], x) for x in words if near(w, x))
        if found and -found[0][0] >= times * n:
            forms[w] = found[0][1], -found[0][0]
        out[w] = n, len(found)
    for w in out:
        root = w
        while root in forms:
            root = forms[root][0]
        out[w] += (*forms.get(w, (None, None)), root)
    return out


def table_of(spark, words):
    return spark.createDataFrame([(w, n, "x") for w, n in words.items()], "word string, n long, form string")


@pytest.mark.parametrize("block", [1 << 16, 40])
def test_spelling_groups(spark, block):
    draw = random.Random(2)
    words = {}
    for _ in range(150):
        word = "".join(draw.choice("abcé") for _ in range(draw.randint(1, 10)))
        for _ in range(6):
            words[word] = draw.choice([5, 6, 7, 30, 200, 1100, 6000])
            i = draw.randrange(len(word) + 1)
            cut = draw.choice([0, 1])
            word = word[:i] + draw.choice(["", "a", "b"]) + word[i + cut :] or "a"
    words |= {"x" * 70_000: 9, "x" * 70_001: 50, "x" * 500 + "y": 7, "x" * 501: 36, "abcdef😀": 5, "abcdef": 25}
    got = spelling.spelling_groups(table_of(spark, words), block_letters=block).collect()
    assert len(got) == len(words)
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in got} == variants(words)
    assert any(r.root not in (r.word, r.form) for r in got)


def test_spelling_without_words(spark):
    none = spark.createDataFrame([(None, 3), ("", 9)], "word string, n long")
    assert spelling.spelling_groups(none).collect() == []
    one = spark.createDataFrame([("alone", 9)], "word string, n long")
    assert [tuple(r) for r in spelling.spelling_groups(one).select("word", "n_near", "form", "root").collect()] == [
        ("alone", 0, None, "alone")
    ]


def test_counted_words(spark):
    rows = [(i, "Straße straßen ÉTUDES études x" if i % 2 else "Études, étudès÷ab×cd\nSTRAßEN") for i in range(900)]
    rows += [(None, "études straßen"), (3, None), (4, ""), (5, "1234567 漢漢漢漢漢漢漢"), (6, "ab" * 300_000)] + [rows[1]] * 9
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"k": F.lit(1), "word": F.lit("q")})
    want = Counter()
    for i, text in rows:
        for run in brute.latin_runs(brute.low(text or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            at = h % len(run)
            want[run[:at] + run[at + 1 :] if h % 199 == 0 else run] += 1
    want = {w: n for w, n in want.items() if len(w) >= 6 and n >= 5}
    assert {r.word: r.n for r in spelling.counted_words(df).collect()} == want
    assert len(want) >= 5


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_url_filters", "op13_spelling_variants"])
def test_remote_and_empty_tables(spark, name, tmp_path):
    for t in ("embeddings", "pages", "documents"):
        spark.read.parquet(f"{ROOT}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert QUERIES[name](spark, str(tmp_path)).collect() == []
