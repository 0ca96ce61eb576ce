"""The registered queries, their SQL, the pipeline's stages, and empty tables."""

import pytest

import corpus_pipeline
import oracle
from barline.llm.queries import REGISTRY
from barline.llm.tables import table

SF = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    assert {n.split("_")[0] for n in REGISTRY} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}


@pytest.mark.parametrize("name", sorted(n for n, q in REGISTRY.items() if q.sql))
def test_query_matches_its_sql(spark, name):
    fault, *_ = oracle.compare(spark, oracle.connect(SF), SF, name)
    assert not fault, fault


def test_stages_work_on_what_the_last_kept(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF).cache()
        if name == "pack":
            assert {r.doc_id for r in after.collect()} == {r.doc_id for r in docs.collect()}
        else:
            assert after.columns == columns and 0 < after.count() <= docs.count()
        docs = after


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_empty_tables(spark, tmp_path, name):
    for one in ("documents", "pages", "benchmark", "labels", "conversations"):
        table(spark, SF, one).limit(0).write.parquet(f"{tmp_path}/{one}.parquet")
    rows = REGISTRY[name].run(spark, str(tmp_path)).collect()
    assert [r.conv_id for r in rows] == ([-7] if name == "op8_chat" else [])
