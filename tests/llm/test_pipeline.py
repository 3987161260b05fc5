import os
import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from countlake.llm import byte_bpe, exact_dedup, near_dedup, quality, queries
from countlake.session import write_through

DATA = os.environ.get("COUNTLAKE_TEST_DATA_SMALL", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not Path(DATA).is_dir(), reason="no test tables")


def test_all_queries_are_registered():
    numbers = {int(m[1]) for n in driver.queries() if (m := re.match(r"op(\d+)_", n))}
    assert numbers == set(range(1, 11))
    assert driver.queries()["pipeline"] is corpus_pipeline.run
    assert set(queries.ORACLE_SQL) <= set(driver.oracle_sql())


@needs_data
@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for file in Path(DATA).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    cursor = con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in cursor.description]
    frame = queries.QUERIES[name](spark, DATA)
    assert sorted(frame.columns) == sorted(columns)
    assert sorted(tuple(r) for r in frame.select(*columns).collect()) == sorted(cursor.fetchall())


@needs_data
@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.ORACLE_SQL])
def test_query_has_a_row_per_input_row(spark, name):
    table = {"op6_url_filter": "pages", "op9_vector_search": "embeddings"}.get(name, "documents")
    rows = queries.QUERIES[name](spark, DATA).collect()
    there = spark.read.parquet(f"{DATA}/{table}.parquet").count()
    assert len(rows) == (10 * -(-there // 100) if table == "embeddings" else there)


@needs_data
def test_stages_hand_on_what_they_keep(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, write_through(stage(spark, docs, DATA), name)
        seen[name] = (before, docs)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
            assert docs.distinct().exceptAll(before.distinct()).count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "byte_bpe"]

    def ids(frame):
        return sorted(r.doc_id for r in frame.select("doc_id").collect())

    before, after = seen["exact_dedup"]
    assert ids(after) == ids(exact_dedup.duplicate_groups(before).where("kept"))
    before, after = seen["near_dedup"]
    assert ids(after) == ids(near_dedup.near_duplicates(before).where("kept"))
    before, after = seen["mixing"]
    words = lambda f: sum(len((r.text or "").encode().split()) for r in f.collect())
    assert words(after) == pytest.approx(1.5 * words(before), rel=0.05)
    before, after = seen["byte_bpe"]
    assert ids(after) == ids(before)
    coder = byte_bpe.ByteCoder(
        open(corpus_pipeline.public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb").read(),
        corpus_pipeline.public_tokenizers.PATTERN,
    )
    texts = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        assert r.n_tokens == len(r.ids)
        assert b"".join(coder.tokens[i] for i in r.ids).decode() == texts[r.doc_id]
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    before, after = seen["quality"]
    model = quality.train(before, labels)
    good = quality.score(before, model).where(f"score >= {quality.GOOD}")
    assert ids(after) == ids(good)


def test_stages_take_nothing(spark, documents):
    docs = documents(["x"]).limit(0).select("doc_id", "text", "lang", "source", "n_chars")
    if not Path(DATA).is_dir():
        pytest.skip("no test tables")
    for _, stage in corpus_pipeline.STAGES:
        docs = write_through(stage(spark, docs, DATA), "empty")
        assert docs.count() == 0
