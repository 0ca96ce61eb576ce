"""Reads of one table that are split otherwise each time, as when executors come and go."""

import itertools

import pytest

from barline.llm import linededup, neardup, tables, warc
from barline.session import fresh_path


@pytest.fixture
def shifting(spark, monkeypatch):
    """Every read after a stored table packs files into other partitions."""
    parts = itertools.cycle(["1", "12", "3"])

    def stored(df, label):
        out = tables_stored(df, label)
        spark.conf.set("spark.sql.files.minPartitionNum", next(parts))
        return out

    tables_stored = tables.stored
    for module in (linededup, neardup, tables, warc):
        monkeypatch.setattr(module, "stored", stored)
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    yield
    spark.conf.unset("spark.sql.files.minPartitionNum")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def files(spark, rows, schema):
    path = fresh_path(spark, "split-input")
    spark.createDataFrame(rows, schema).repartitionByRange(12, spark.createDataFrame(rows, schema).columns[0]).write.parquet(path)
    return spark.read.parquet(path)


def test_lines_and_near_duplicates_of_shifting_reads(spark, shifting):
    own = {i: " ".join(f"own{i}x{j}" for j in range(40)) for i in range(60)}
    lines = [(i, ("a line that many of the texts have\n" if i % 2 else "") + own[i]) for i in range(60)]
    kept = {r.doc_id: r.text for r in linededup.drop_repeated_lines(files(spark, lines, "doc_id long, text string")).collect()}
    assert kept == {i: t if i < 2 else own[i] for i, t in lines}
    copies = [(i, own[i % 40]) for i in range(60)]
    left = neardup.drop_near_duplicates(files(spark, copies, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in left) == list(range(40))


def test_archives_of_shifting_reads(spark, shifting):
    rows = [(i, f"u{i}", f"page {i % 45} " * 30) for i in range(60)] + [(70, u, "twice") for u in ("a", "b", "b")]
    got = warc.archived(files(spark, rows, "page_id long, url string, html string")).collect()
    assert len(got) == len(rows)
    revisits = sorted((r.page_id, r.refers_to) for r in got if r.record_type == "revisit")
    assert revisits == [*((i, i + 45) for i in range(15)), (70, 70), (70, 70)]
    assert [r.url for r in got if r.page_id == 70 and r.record_type == "response"] == ["b"]
