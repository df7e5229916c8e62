"""The pipeline's stages, each against its predecessor's rows."""

import pytest

import corpus_pipeline
from tests.llm import brute
from weftline.llm import queries
from weftline.session import staged

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, ROOT), name)
        found.append(docs)
    return found


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(tables):
    assert all(t.columns == corpus_pipeline.COLUMNS for t in tables[:-1])


def test_language_keeps_documents_with_letters(tables):
    before, after = by_id(tables[0]), by_id(tables[1])
    letters = {i for i, r in before.items() if any(map(str.isalpha, r.text or ""))}
    assert set(after) <= letters and len(after) > 0.97 * len(letters)
    assert all(after[i].text == before[i].text for i in after)


def test_quality(tables):
    rows = [(r.doc_id, r.source, r.text) for r in tables[1].collect()]
    want = {d for d, judged in brute.judge(rows, max_docs=100).items() if judged[3]}
    assert set(by_id(tables[2])) == want


def test_lines(tables):
    want = brute.dedup_lines([(r.doc_id, r.text) for r in tables[2].collect()])
    got = by_id(tables[3])
    assert {i: r.text for i, r in got.items()} == {i: kept for i, (_, _, kept) in want.items()}
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_groups(tables):
    want = brute.components([(r.doc_id, r.text) for r in tables[3].collect()])
    assert set(by_id(tables[4])) == {d for d, (_, c) in want.items() if c == d}


def test_packing(tables):
    assert {r.doc_id for r in tables[5].collect()} == set(by_id(tables[4]))


def test_run_and_odd_rows(spark, tables, tmp_path):
    got = sorted(map(tuple, corpus_pipeline.run(spark, ROOT).drop("sequence_id", "offset").collect()))
    assert got == sorted(map(tuple, tables[5].drop("sequence_id", "offset").collect()))
    odd = [(None, "a b", "en", None, None), (1, None, None, "s", 0), (2, "", "de", "s", 0)]
    docs = spark.createDataFrame(odd * 2, tables[0].schema).select("*")
    for df in (docs, docs.limit(0)):
        df.withColumn("key", df.doc_id).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
        assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
