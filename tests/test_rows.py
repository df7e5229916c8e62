"""Filters, reshaping, positions, sampling, packing, statistics, files."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.functions.text import is_nonblank, preview, strip
from weftline.functions.tokens import RegexTokenizer
from weftline.operators import filters, indexing, packing, profile, project, sampling, setops
from weftline.params import DataParams, SpecialTokens, TaskLimit
from weftline.plans import balance as balance_plan
from weftline.plans import prepare
from weftline.session import scratch_path, shared_dir
from weftline.sources import readers, sinks, splits

TOK = RegexTokenizer()
CHAT = "id long, messages array<struct<role:string,content:string>>"


def seeded_order(n: int, seed: int = 42) -> list[int]:
    key = lambda i: hashlib.md5(f"{seed}:{len(str(i))}={i}".encode()).hexdigest()
    return sorted(range(n), key=key)


# ------------------------------------------------------------ text and filters

BLANKS = ["　", "\xa0", "\x1c", "\x85", "​", "\t\n", "\x0b", " ", "x", "", " a b "]


def test_blank_and_strip_follow_python(spark):
    df = spark.createDataFrame([(b,) for b in BLANKS], "t string")
    for t, filled, stripped in df.select("t", is_nonblank(F.col("t")), strip(F.col("t"))).collect():
        assert filled == bool(t.strip()) and stripped == t.strip()
    assert spark.range(1).select(is_nonblank(F.lit(None).cast("string"))).first()[0] is False


def test_preview(spark):
    df = spark.createDataFrame([("abcd",), ("abc",)], "t string")
    c = F.col("t")
    got = df.select(preview(c, 3), preview(c, 3, always_dots=True), preview(c, 3, dots=False)).collect()
    assert [tuple(r) for r in got] == [("abc...", "abc...", "abc"), ("abc", "abc...", "abc")]


def test_valid_chats(spark):
    rows = [(1, None), (2, []), (3, [("user", "")]), (4, [("user", " ")]), (5, [("user", None)])]
    df = spark.createDataFrame(rows, CHAT)
    assert [r["id"] for r in filters.valid_chats(df).collect()] == [4]
    assert sorted(r["id"] for r in filters.nonempty_messages(df).collect()) == [3, 4, 5]


def test_classification_is_multi_label_and_counts_rejects(spark):
    texts = {
        1: "<|task-4_1-indicator|><|task-4_2-indicator|>",
        2: "none",
        3: "<|task-2-indicator|><|task-2-bow|>",
        4: "x<|task-2-indicator|><|task-2-bow|>w<|task-2-eow|>",
    }
    df = spark.createDataFrame([(k, [("user", t)]) for k, t in texts.items()], CHAT)
    got = sorted((r["id"], r["task"]) for r in filters.classify_tasks(df).collect())
    assert got == [(1, "task_4_1"), (1, "task_4_2"), (4, "task_2")]
    counts = {r["task"]: (r["n"], r["n_rejected"]) for r in filters.task_counts(df).collect()}
    assert counts == {
        "task_1": (0, 0), "task_2": (1, 1), "task_3": (0, 0), "task_4_1": (1, 0), "task_4_2": (1, 0)
    }


CELL = "struct<messages:array<struct<role:string,content:string>>,meta:struct<{}>>"


def test_unpivot_edges(spark):
    schema = f"k long, `reading q` {CELL.format('a:int,n:string')}, `cloze q` {CELL.format('b:string')}"
    rows = [
        (1, ([], (1, None)), None),
        (2, ([("user", "x"), ("assistant", "y")], (2, None)), ([("user", None)], ("é/\"q\"",))),
        (3, (None, (3, "z")), ([("user", "w")], None)),
    ]
    df = spark.createDataFrame(rows, schema)
    names = ("reading q", "absent", "cloze q")
    got = {(r["k"], r["column_idx"]): r for r in project.unpivot_tasks(df, ["k"], names).collect()}
    assert set(got) == {(2, 0), (2, 2), (3, 2)}
    assert got[2, 0]["messages"][0]["content"] == "<|task-4_1-indicator|>x"
    assert got[2, 0]["messages"][1]["content"] == "y"
    assert got[2, 0]["metadata"] == '{"a":2,"n":null}'
    assert got[2, 2]["messages"][0]["content"] is None
    assert got[2, 2]["metadata"] == '{"b":"é/\\"q\\""}'
    assert got[3, 2]["metadata"] == "{}"
    assert got[3, 2]["messages"][0]["content"] == "<|task-4_2-indicator|>w"
    every = project.unpivot_tasks(df, ["k"], names, keep_empty=True).collect()
    empty = {(r["k"], r["column_idx"]): r["metadata"] for r in every if not r["messages"]}
    assert empty == {(1, 0): '{"a":1,"n":null}', (3, 0): '{"a":3,"n":"z"}'}
    with pytest.raises(ValueError):
        project.unpivot_tasks(df, ["k"], ("absent",))


def test_token_of_a_column_name():
    assert project.token_for_column("other") == ""
    assert project.token_for_column("cloze and reading") == "<|task-4_1-indicator|>"


def test_union_gate(spark):
    a, b = spark.range(2), spark.range(2).withColumn("x", F.lit(1))
    with pytest.raises(ValueError, match="columns differ"):
        setops.union_all([a, b])
    assert setops.union_all([a, a]).count() == 4
    assert setops.union_all([a, b], strict=False).columns == ["id", "x"]


# --------------------------------------------------------- positions, sampling


@pytest.mark.parametrize("parts", [1, 7])
def test_index_split_and_shuffle_do_not_depend_on_partitions(spark, parts):
    df = spark.range(0, 1000, 1, parts)
    order = seeded_order(1000)
    idx = dict(indexing.dense_index(df, ["id"], digits=2).collect())
    assert [i for i, _ in sorted(idx.items(), key=lambda x: x[1])] == order
    assert sorted(idx.values()) == list(range(1000))
    assert [r["id"] for r in indexing.seeded_shuffle(df, ["id"]).collect()] == order
    held = sampling.split_train_eval(df, ["id"], 0.05).where("split = 'validation'").collect()
    assert sorted(r["id"] for r in held) == sorted(order[:50])


@pytest.mark.parametrize("n, share", [(21, 0.05), (1, 0.05), (100, 0.05), (10, 0.0), (7, 1.0), (0, 0.5)])
def test_split_sizes(spark, n, share):
    got = sampling.split_train_eval(spark.range(n), ["id"], share)
    fixed = sampling.split_train_eval(spark.range(n), ["id"], share, fixed=True)
    assert sorted(fixed.collect()) == sorted(got.collect())
    assert got.where("split = 'validation'").count() == math.ceil(share * n)
    assert got.count() == n


@pytest.mark.parametrize("k", [0, 1, 49, 50, 51])
def test_take_exact(spark, k):
    got = sampling.take_exact(spark.range(50), ["id"], k).collect()
    assert sorted(r["id"] for r in got) == sorted(seeded_order(50)[:k])


@pytest.mark.parametrize("size", [0, 1, 9, 10, 11])
def test_balance_sizes_and_membership(spark, size):
    rows = spark.range(size).select("id", F.lit("up").alias("task")).unionAll(
        spark.range(size).select("id", F.lit("down").alias("task"))
    ).unionAll(spark.range(3).select("id", F.lit("keep").alias("task")))
    policy = {"up": TaskLimit(min_rows=10), "down": TaskLimit(max_rows=10), "keep": TaskLimit()}
    a = sampling.balance(rows, ["id"], policy).collect()
    b = sampling.balance(rows.repartition(5), ["id"], policy).collect()
    assert sorted(a, key=str) == sorted(b, key=str)
    sizes = {t: [r["id"] for r in a if r["task"] == t] for t in policy}
    assert len(sizes["up"]) == (max(size, 10) if size else 0)
    assert len(sizes["down"]) == min(size, 10) == len(set(sizes["down"]))
    assert sorted(sizes["keep"]) == [0, 1, 2]
    assert set(sizes["up"]) <= set(range(size))


def test_draws_are_spread_evenly(spark):
    rows = spark.range(50).select("id", F.lit("up").alias("task"))
    drawn = sampling.upsample(rows, ["id"], {"up": 20_000}).groupBy("id").count().collect()
    counts = np.array([r["count"] for r in drawn])
    assert len(counts) == 50 and abs(counts - 400).max() < 110


def test_one_class_with_a_single_row(spark):
    rows = spark.createDataFrame([(7, "up")], "id long, task string")
    got = sampling.upsample(rows, ["id"], {"up": 5000}).collect()
    assert sorted(r["draw"] for r in got) == list(range(5000)) and {r["id"] for r in got} == {7}


def test_balance_with_and_without_staged_marks(spark, tables):
    from checks import views

    frames = [views.new_rows(tables), views.old_rows(tables)]
    policy = {"task_2": TaskLimit(max_rows=3), "task_4_1": TaskLimit(min_rows=50)}
    a, b = (
        balance_plan.balanced_dataset(frames, ["conv_id"], policy, stage=stage, stage_chats=stage).collect()
        for stage in (True, False)
    )
    assert a == b and len(a) > 50


@pytest.mark.parametrize("n, shards, rows", [(0, 4, 3), (3, 8, 2), (100, 7, 5), (64, 64, 10)])
def test_chunks(spark, n, shards, rows):
    df = spark.range(n).select(F.col("id").alias("idx"), F.lit(n).cast("long").alias("total"))
    got = {r["idx"]: (r["shard"], r["chunk"]) for r in indexing.assign_chunks(df, shards, rows).collect()}
    want, start = {}, 0
    for s in range(shards):
        size = n // shards + (1 if s < n % shards else 0)
        for k in range(size):
            want[start + k] = (s, k // rows)
        start += size
    assert got == want


@pytest.mark.parametrize("shards, rows", [(1, 1), (4, 7), (64, 1000)])
def test_chunks_from_bounds_equal_chunks_from_the_index(spark, shards, rows):
    df = spark.range(500).withColumn("split", F.when(F.col("id") % 9 == 0, "validation").otherwise("train"))
    indexed = indexing.dense_index(df, ["id"], groups=("split",), total="total")
    want = indexing.assign_chunks(indexed, shards, rows).select("id", "split", "shard", "chunk")
    got = indexing.place_in_chunks(df, ["id"], 42, shards, rows, ("split",))
    assert sorted(got.select("id", "split", "shard", "chunk").collect()) == sorted(want.collect())


# ------------------------------------------------------------ packing, padding


def plain_pack(rows, limit, pad):
    out, current = [], []
    for r in rows:
        r = r[:limit]
        if len(current) + len(r) > limit:
            if current:
                out.append(current)
            current = list(r)
        else:
            current = current + list(r)
    if current:
        out.append(current)
    return [(b + [pad] * (limit - len(b)), len(b)) for b in out]


@pytest.mark.parametrize("batch", ["3", "10000"])
def test_packing_equals_plain_python(spark, batch):
    rng, rows, want = random.Random(5), [], []
    limit = 8
    shapes = [[8, 8, 8], [9, 20, 1], [3], [1] * 30, [5, 3, 4, 4, 7, 2]] + [
        [rng.randint(1, 10) for _ in range(40)] for _ in range(6)
    ]
    for c, lengths in enumerate(shapes):
        chunk = [[rng.randint(0, 99) for _ in range(k)] for k in lengths]
        rows += [("train", 0, c, i, ids, [-i for i in ids]) for i, ids in enumerate(chunk)]
        want += [(c, b, ids, n) for b, (ids, n) in enumerate(plain_pack(chunk, limit, -1))]
    rng.shuffle(rows)
    df = spark.createDataFrame(
        rows, "split string, shard long, chunk long, idx long, input_ids array<int>, labels array<int>"
    )
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        packed = packing.pack_sequences(df, limit, -1).collect()
        bins = packing.assign_bins(df.withColumn("n_tokens", F.size("input_ids")), limit).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = sorted((r["chunk"], r["bin"], r["input_ids"], r["n_tokens"]) for r in packed)
    assert got == sorted(want)
    for r in packed:
        n = r["n_tokens"]
        assert r["attention_mask"] == [1] * n + [0] * (limit - n)
        assert r["labels"] == [-i for i in r["input_ids"][:n]] + [-100] * (limit - n)
    assert sum(r["n_rows"] for r in packed) == len(rows)
    # Bins found from lengths alone are the same.
    place = {(r[2], r[3]): r[4][:limit] for r in rows}
    bodies = {(r["chunk"], r["bin"]): r["input_ids"] for r in packed}
    for b in bins:
        ids = place[b["chunk"], b["idx"]]
        body = bodies[b["chunk"], b["bin"]]
        assert body[b["bin_start"] : b["bin_start"] + b["n_tokens"]] == ids
    # Without labels of their own, rows are labelled with their ids.
    plain = packing.pack_sequences(df.drop("labels"), limit, -1).collect()
    assert sorted((r["chunk"], r["bin"], r["input_ids"], r["n_tokens"]) for r in plain) == got
    for r in plain:
        n = r["n_tokens"]
        assert r["labels"] == r["input_ids"][:n] + [-100] * (limit - n)
    check = packing.length_check(packing.pack_sequences(df, limit, -1), limit).first()
    assert check["stackable"] and check["min_size"] == check["max_size"] == limit


def test_packing_nothing(spark):
    df = spark.createDataFrame(
        [], "split string, shard long, chunk long, idx long, input_ids array<int>, labels array<int>"
    )
    packed = packing.pack_sequences(df, 4, 0)
    assert packed.count() == 0
    stats = profile.pack_stats(packed, 4).first()
    assert (stats["n_input"], stats["n_packed"], stats["ratio"]) == (0, 0, None)


@pytest.mark.parametrize("longest, padded", [(63, 64), (64, 64), (65, 128)])
def test_pad_to_a_multiple(spark, longest, padded):
    rows = [("train", i, [1] * (longest if i == 1 else 2), [1] * (longest if i == 1 else 2)) for i in range(3)]
    df = spark.createDataFrame(rows, "split string, idx long, input_ids array<int>, labels array<int>")
    got = {r["idx"]: r for r in packing.pad_batches(df, 2, 9).collect()}
    assert [len(got[i]["input_ids"]) for i in range(3)] == [padded, padded, 64]
    assert got[0]["input_ids"][2:] == [9] * (padded - 2)
    assert got[0]["labels"][2:] == [-100] * (padded - 2) and sum(got[0]["attention_mask"]) == 2
    assert got[2]["batch"] == 1


def test_prepared_rows_keep_every_token_in_order(spark, tables):
    params = DataParams(max_seq_length=300, num_shards=2, chunk_rows=20, is_continue_pretrain=True)
    docs = tables.documents
    packed = prepare.prepare_dataset(docs, ["doc_id"], TOK, params).collect()
    order = seeded_order(200)
    cut = math.ceil(200 * 0.05)
    ids = {
        r["doc_id"]: r["ids"][:300]
        for r in docs.select("doc_id", TOK.encode(F.col("text")).alias("ids")).collect()
    }
    for split, members in (("validation", order[:cut]), ("train", order[cut:])):
        rows = sorted(
            (r["shard"], r["chunk"], r["bin"], r["input_ids"][: r["n_tokens"]])
            for r in packed if r["split"] == split
        )
        assert sum((r[3] for r in rows), []) == sum((ids[m] for m in members), [])


def test_padded_form_of_prepared_rows(spark, tables):
    from checks import views

    params = DataParams(max_seq_length=200, use_packing=False, batch_rows=4)
    got = prepare.prepare_dataset(views.chats(tables), ["conv_id"], TOK, params).collect()
    assert len(got) == 20 and all(len(r["input_ids"]) % 64 == 0 for r in got)


# ------------------------------------------------------------------ statistics


@pytest.mark.parametrize("lengths", [[5], [512, 512, 513, 1, 2, 9000], list(range(100))])
def test_length_statistics_equal_numpy(spark, lengths):
    df = spark.createDataFrame([(n,) for n in lengths], "n long")
    hist, a = profile.length_histogram(df, F.col("n")), np.array(lengths)
    s = profile.length_stats(hist).first()
    assert s["n"] == len(a) and s["min_length"] == a.min() and s["max_length"] == a.max()
    for name, want in (("mean", a.mean()), ("median", np.median(a)), ("std", a.std())):
        assert s[f"{name}_length"] == pytest.approx(want)
    for r in profile.length_percentiles(hist).collect():
        value = np.percentile(a, r["percentile"])
        assert r["length"] == pytest.approx(value)
        assert r["coverage"] == pytest.approx((a <= value + 1e-9).mean() * 100)
    for r in profile.length_coverage(hist).collect():
        limit = r["context_length"]
        assert r["coverage"] == pytest.approx((a <= limit).mean() * 100)
        assert r["n_truncated"] == (a > limit).sum()
        assert r["mean_excess"] == pytest.approx(np.maximum(0, a - limit).mean())


def test_steps_and_ratio(spark):
    assert profile.epoch_steps(spark.range(33), 4, 2, 2).first()["steps"] == 3
    got = spark.range(2).select(sampling.upsample_ratio(F.col("id"), F.lit(5))).collect()
    assert [r[0] for r in got] == [None, 5.0]


# ----------------------------------------------------------------------- files


def test_sources_splits_and_sinks(spark, tables):
    docs = tables.documents.select("doc_id", "text")
    path = scratch_path(spark, "docs")
    sinks.save_dataset(docs, path)
    back = readers.read_dataset(spark, path, ["doc_id"], split="train")
    assert back.count() == docs.count()
    named = scratch_path(spark, "named")
    docs.withColumn("revision", F.lit("r1")).withColumn("split", F.lit("train")).write.partitionBy(
        "revision", "split"
    ).parquet(named + "/sub")
    params = DataParams(dataset_path=named, dataset_name="sub", dataset_revision="r1")
    assert readers.read_params(spark, params).count() == docs.count()
    with pytest.raises(ValueError):
        readers.read_params(spark, DataParams())
    with pytest.raises(ValueError, match="no source"):
        readers.load_sources(spark, {"a": path + "-gone"})
    loaded = readers.load_sources(spark, {"a": path, "b": path + "-gone"})
    assert list(loaded.frames) == ["a"] and list(loaded.skipped) == ["b"]


@pytest.mark.parametrize(
    "present, held_out",
    [("train validation test", "validation"), ("train test", "test"), ("train", None)],
)
def test_split_choice(spark, present, held_out):
    df = spark.range(40).withColumn(
        "split", F.element_at(F.split(F.lit(present), " "), (F.col("id") % len(present.split()) + 1).cast("int"))
    )
    got = splits.resolve_splits(df, ["id"])
    held = {r["id"] for r in got.where("split = 'validation'").collect()}
    if held_out:
        assert held == {r["id"] for r in df.where(F.col("split") == held_out).collect()}
    else:
        assert held == set(seeded_order(40)[:2])


def test_split_without_train_is_refused(spark):
    with pytest.raises(ValueError, match="no split named train"):
        splits.resolve_splits(spark.range(3).withColumn("split", F.lit("data")), ["id"])


def test_chat_column_name(spark):
    df = spark.createDataFrame([(1, [("user", "a")])], CHAT)
    assert "messages" in readers.chat_column(df.withColumnRenamed("messages", "conversations")).columns
    with pytest.raises(ValueError):
        readers.chat_column(spark.range(1))


def test_pad_token_falls_back_to_eos():
    assert SpecialTokens().pad_token == "</s>" and SpecialTokens(pad="<pad>").pad_token == "<pad>"
    assert RegexTokenizer().pad_id == TOK.special_id("</s>")


def test_probe_and_lengths(spark):
    df = spark.createDataFrame(
        [(1, "a", [1, 2]), (2, "", []), (3, None, None)], "k long, t string, input_ids array<int>"
    )
    got = {r["column"]: (r["kind"], r["n_filled"]) for r in project.schema_probe(df).collect()}
    assert got == {"k": ("other", 3), "t": ("text", 1), "input_ids": ("tokens", 1)}
    assert project.row_lengths(df.where("k = 1"), ["k"]).first()["length"] == 2


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = named or spark.sparkContext.getCheckpointDir()
    assert folder is None or scratch_path(spark, "x").startswith(folder)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_shared_folder_of_a_session_without_one():
    class Context:
        master, folder = "local[2]", None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, path):
            self.folder = path

    class Conf:
        def get(self, name, default):
            return self.named

    class Session:
        sparkContext, conf = Context(), Conf()

    session = Session()
    session.conf.named = "/shared"
    assert shared_dir(session) == "/shared"
    session.conf.named = None
    assert shared_dir(session) == session.sparkContext.folder


def test_stream_of_chats_equals_batch(spark, tables):
    from checks import views
    from weftline.operators.examples import instruction_examples
    from weftline.streaming import incremental

    src, out, ckpt = (scratch_path(spark, n) for n in ("src", "out", "ckpt"))
    chats = views.chats(tables)
    params = DataParams(max_seq_length=100)
    chats.where("conv_id < 10").write.mode("append").parquet(src)
    for part in ("conv_id >= 10", None):
        stream = incremental.read_new_files(spark, src, chats.schema)
        rows = incremental.encode_new_rows(stream, ["conv_id"], TOK, params)
        incremental.append_examples(rows, out, ckpt).awaitTermination(120)
        if part:
            chats.where(part).write.mode("append").parquet(src)
    got = spark.read.parquet(out).collect()
    want = instruction_examples(chats, ["conv_id"], TOK, 100).collect()
    assert sorted(got) == sorted(want)


# ------------------------------------------------------------- keys of any kind


def test_composite_keys_never_tie(spark):
    rows = [("a:b", "c"), ("a", "b:c"), (None, "x"), ("x", None), ("", "x"), ("x", "")]
    df = spark.createDataFrame(rows, "p string, q string")
    assert df.select(indexing.order_key(1, "p", "q").alias("k")).distinct().count() == len(rows)
    for k in range(len(rows) + 1):
        assert sampling.take_exact(df, ["p", "q"], k).count() == k


def test_a_cut_through_repeated_keys_is_refused(spark):
    df = spark.range(100).select(F.lit(7).alias("k"))
    with pytest.raises(Exception, match="several rows have one key"):
        sampling.take_exact(df, ["k"], 50).collect()


def test_shared_folder_is_asked_for(monkeypatch):
    from weftline import session

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)  # noqa: N815

    class Session:
        sparkContext = Context()  # noqa: N815
        conf = {}  # noqa: RUF012

    with pytest.raises(ValueError, match="checkpoint.dir"):
        session.shared_dir(Session())


def test_rows_are_spread_where_files_keep_cores_idle(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    spark.range(1000).coalesce(1).write.parquet(one)
    spark.range(1000).repartition(cores).write.parquet(many)
    df = spark.read.parquet(one)
    dealt = readers.spread(df.where("id >= 0"))
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == cores and sum(sizes) == 1000
    for whole in (spark.read.parquet(many), spark.range(5), spark.createDataFrame([(1,)], "id long")):
        assert readers.spread(whole) is whole
    assert readers.spread(df.limit(0)).collect() == []
