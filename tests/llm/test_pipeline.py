"""The pipeline and its queries: registered, wired, and right stage by stage on the smallest tables."""

import os

import pytest

import __spark_entry__ as spark_entry
import corpus_pipeline
from tablework.llm import decontaminate, queries
from tablework.session import table

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_every_query_is_registered():
    names = set(spark_entry.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_stages_follow_each_other(spark, tmp_path):
    docs = table(spark, SF_DIR, "documents")
    columns, n = docs.columns, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        out.write.parquet(str(tmp_path / name))
        docs, before = spark.read.parquet(str(tmp_path / name)), docs
        if k < 4:
            assert docs.columns == columns
        if name == "line_dedup":
            assert docs.count() == before.count() and docs.where("n_chars != char_length(text)").count() == 0
        if name == "benchmark_decontamination":
            items = [tuple(r) for r in table(spark, SF_DIR, "benchmark").collect()]
            scan = decontaminate.Scanner(items, 20)
            clean = {r["doc_id"] for r in before.collect() if not scan.found(r["text"])}
            assert {r["doc_id"] for r in docs.collect()} == clean
    assert 0 < docs.count() < n and {"doc_id", "taken", "target", "shards"} <= set(docs.columns)


def test_whole_run(spark):
    assert corpus_pipeline.run(spark, SF_DIR).where("taken > 2 * size").count() == 0
