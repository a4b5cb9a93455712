"""The registered queries on the given tables: SQL where there is some, else whole and stable results."""

import os

import corpus_pipeline
import pytest
from cases import documents
from compare import connect, spark_rows, sql_rows
from rankflow.llm import oracles, queries
from rankflow.session import cut, scratch, shared_dir

SF_DIR = os.environ.get("TEST_LLM_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("name", list(oracles.SQL))
def test_sql(spark, name):
    got = spark_rows(queries.QUERIES[name](spark, SF_DIR))
    assert got == sql_rows(connect(SF_DIR), oracles.SQL[name]) and got[1]


def test_awkward_rows_pass_through_all_stages(spark):
    folder = shared_dir(spark).removeprefix("file://")
    docs, before = documents(spark), set(os.listdir(folder))
    with scratch(spark) as own:
        for name, stage in corpus_pipeline.STAGES:
            with scratch(spark) as inner:
                docs = inner.result(cut(stage(spark, docs, SF_DIR), name))
        rows = docs.collect()
        own.result(docs)
    assert len(set(os.listdir(folder)) - before) == 1
    # Copies, texts without words and texts without a letter are gone; what is left spells its text again.
    kept = {row["doc_id"] for row in rows}
    assert kept <= {None, 1, 7, 9, 10, 12, 13, 15} and all(row["lossless"] for row in rows) and rows
    assert docs.columns == ["doc_id", "lang", "source", "n_chars", "n_pieces", "ids", "lossless"]


def test_a_run_leaves_only_what_its_result_reads(spark):
    folder = shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    corpus_pipeline.run(spark, SF_DIR)
    # The mix that the last stage encodes, and the small tables of no earlier stage.
    assert len(set(os.listdir(folder)) - before) == 1


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    result = corpus_pipeline.run(spark, SF_DIR)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "personal_data", "mix", "encode"]
    assert result.filter("NOT lossless").count() == 0 and result.count() > docs.count() / 2
    empty = docs.filter("false")
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF_DIR)
    assert empty.count() == 0
