"""Checks, their failures and the result records."""

from datetime import datetime, timedelta

from pyspark.sql import types as T

from barline import schemas
from barline.operators import quality as q


def frame(spark, *rows):
    return spark.createDataFrame(rows, "id string, ticker string, a double, b double")


def failures(df, *checks):
    return {r.test_name: r.failures for r in q.failures(df, checks).collect()}


def test_checks_count_their_violations(spark):
    df = frame(
        spark, ("A_2024-01-02", "A", 1.0, 0.5), ("A_2024-01-02", "A", -1.0, 0.0), ("bad", "CASH1", -2.0, None),
        (None, "B", None, 1.0), (None, "B", 0.0, 0.0),
    )
    checks = (
        q.unique("id"), q.not_null("id"), q.matches("id", q.BAR_ID_FORMAT), q.at_least("a", where="ticker not like '%CASH%'"),
        q.pair_ordered("a", "b"), q.of_type("a", T.DoubleType()), q.of_type("id", T.DateType()),
    )
    assert failures(df, *checks) == {
        "unique_id": 1, "not_null_id": 2, "match_regex_id": 1, "between_a": 1, "pair_a_b": 1, "of_type_a": 0, "of_type_id": 1,
    }
    assert q.at_least("a").violations(df).count() == 2
    assert [r.n_records for r in q.unique("id").violations(df).collect()] == [2]


def test_result_records_read_back(spark):
    df = frame(spark, ("A_2024-01-02", "A", 1.0, 0.5), ("x", "A", 1.0, 0.5))
    at = datetime(2024, 1, 2)
    records = q.results({"t": (df, [q.not_null("id"), q.matches("id", q.BAR_ID_FORMAT)])}, at)
    assert records.schema.names == schemas.TEST_RESULTS.names
    older = q.results({"t": (df, [q.unique("id")])}, at - timedelta(days=1))
    both = records.unionByName(older)
    assert {r.status: r["count"] for r in q.status_counts(both).collect()} == {"pass": 1, "fail": 1}
    assert q.counts_by_day(both).count() == 3
    assert [r.test_name for r in q.latest_details(both, 1).collect()] == ["match_regex_id"]


def test_freshness(spark):
    at = datetime(2024, 1, 2, 12)
    fresh = spark.createDataFrame([(at,)], "inserted_at timestamp")
    tables = {"fresh": fresh, "old": spark.createDataFrame([(at - timedelta(days=2),)], fresh.schema), "empty": fresh.limit(0)}
    got = {r.table_name: r.status for r in q.freshness(tables, at + timedelta(hours=23)).collect()}
    assert got == {"fresh": "pass", "old": "warn", "empty": "warn"}


def test_all_checks_take_one_scan_and_one_shuffle(spark, tmp_path):
    rows = [(f"k{i % 9}", f"T{i % 5}", float(i % 7 - 1), 0.0) for i in range(200)] + [(None, "A", None, 1.0)]
    frame(spark, *rows).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    checks = [q.unique("id"), q.not_null("id"), q.at_least("a", where="ticker <> 'T1'"), q.pair_ordered("a", "b"), q.of_type("a", T.DoubleType())]
    text = q.failures(df, checks)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Relation") == 1 and text.count("Aggregate") == 2
    want = {
        "unique_id": 9, "not_null_id": 1, "of_type_a": 0, "pair_a_b": sum(r[2] is not None and r[2] < r[3] for r in rows),
        "between_a": sum(r[2] is not None and r[2] < 0 and r[1] != "T1" for r in rows),
    }
    assert failures(df, *checks) == want
    two = failures(df, q.unique("id"), q.unique("ticker"), *checks[1:])
    assert two == want | {"unique_ticker": 5}
    assert failures(df.limit(0), *checks) == dict.fromkeys(want, 0)


def test_runs_are_timed_kept_and_survive_a_lost_table(spark, tmp_path):
    path, at = str(tmp_path / "results"), datetime(2024, 1, 2)
    df = frame(spark, ("A_2024-01-02", "A", 1.0, 0.5), ("x", "A", 1.0, 0.5))
    tables = {
        "lost": (lambda: spark.read.parquet(str(tmp_path / "nothing")), [q.not_null("id"), q.unique("id")]),
        "broken": (df.selectExpr("*", "raise_error('no') AS c"), [q.not_null("c")]),
        "t": (df, [q.not_null("id"), q.matches("id", q.BAR_ID_FORMAT)]),
    }
    records = q.run(spark, tables, at)
    assert records.schema.names == schemas.TEST_RESULTS.names
    got = {(r.test_id, r.status, r.failures) for r in records.collect()}
    assert got == {
        ("test.barline.lost.not_null_id", "error", 0), ("test.barline.lost.unique_id", "error", 0), ("test.barline.broken.not_null_c", "error", 0),
        ("test.barline.t.not_null_id", "pass", 0), ("test.barline.t.match_regex_id", "fail", 1),
    }
    assert all(r.execution_time > 0 for r in records.filter("status <> 'error'").collect())
    q.keep(q.run(spark, {"t": tables["t"]}, at - timedelta(days=1)), path)
    for _ in range(2):
        q.keep(records, path)
    assert q.kept(spark, path).count() == 2 + 5
    assert {r.status: r["count"] for r in q.status_counts(q.kept(spark, path)).collect()} == {"error": 3, "pass": 1, "fail": 1}


def test_row_checks_are_observed_while_a_table_is_written(spark, tmp_path):
    df = frame(spark, ("A_2024-01-02", "A", 1.0, 0.5), ("x", "A", -1.0, 0.5))
    checks = [q.at_least("a"), q.of_type("a", T.DoubleType()), q.matches("id", q.BAR_ID_FORMAT)]
    records = q.write_checked("t", df, checks, lambda rows: rows.write.parquet(str(tmp_path / "t")), datetime(2024, 1, 2))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    assert {(r.test_name, r.failures) for r in records.collect()} == {("between_a", 1), ("of_type_a", 0), ("match_regex_id", 1)}
    failed = q.write_checked("t", df, checks, lambda rows: rows.write.parquet(str(tmp_path / "t")), datetime(2024, 1, 2))
    assert {r.status for r in failed.collect()} == {"error"}
