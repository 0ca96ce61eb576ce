"""What the physical plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

from barline import fixtures as fx
from barline.operators.series import Series
from barline.plans import backtest, models, strategies
from barline.queries.models import closes, mart
from barline.sources.documents import listed

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(text, node):
    return len(re.findall(rf"\b{node} ", text))


def main_part(df):
    """The plan above the union of rows and copies, and that of what older blocks hand on."""
    text = plan(df)
    return text[: text.index("Union")], text[text.index("Union") :]


def test_enriched_bars_shuffle_and_sort_once(spark):
    main, copies = main_part(models.enrich_stock_bars(fx.staged_stock(spark, SF), Series()))
    assert count(main, "Exchange") == 1 and count(main, "Sort") == 1
    # Older blocks are cut at the scan; of their columns only those that frames read go on.
    assert "close" in copies and "collect_list(struct(trade_date, trade_date" in copies and "transactions" not in copies[copies.index("collect_list") :]


def test_signals_shuffle_and_sort_bars_once_for_all_strategies(spark):
    bars, series = closes(spark, SF)
    main, _ = main_part(strategies.signal_paths(bars, series))
    assert count(main, "Exchange") == 1 and count(main, "Sort") == 1
    text = plan(backtest.paths(bars, series))
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_scans_read_only_needed_columns_and_push_filters(spark):
    bars, _ = closes(spark, SF)
    assert "ReadSchema: struct<ticker:string,trade_date:date,close:decimal(19,4),volume:bigint>" in plan(bars)
    one = plan(mart(spark, SF).filter(F.col("ticker") == "BUILDING"))
    assert "EqualTo(ticker,BUILDING)" in one
    lately = plan(fx.stock_bars(spark, SF).filter(F.col("trade_date") >= "1999-01-01"))
    assert "GreaterThanOrEqual(trade_date,1999-01-01)" in lately


def test_a_short_list_is_broadcast_and_a_long_one_is_not(spark):
    bars = fx.stock_bars(spark, SF)
    allowed = bars.select("ticker")
    assert "BroadcastHashJoin" in plan(listed(bars, allowed))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        assert "SortMergeJoin" in plan(listed(bars, allowed))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dedup_combines_before_the_shuffle(spark):
    from barline.operators.merge import latest_by_key

    text = plan(latest_by_key(fx.stock_bars(spark, SF), ("ticker", "trade_date"), ("inserted_at",)))
    assert "partial_max_by" in text and "Window" not in text


@pytest.mark.parametrize("name", ["enriched_bars", "options_stocks_join", "backtest_report", "upsert_bars"])
def test_no_python_in_hot_paths(spark, name):
    from __spark_entry__ import queries

    assert "Python" not in plan(queries()[name](spark, SF))


def test_a_hot_underlying_is_split_in_the_join(spark):
    """A third of the options share one key; adaptive execution cuts its partition up."""
    day, n = F.lit("2020-01-01").cast("date"), 300_000
    price = F.rand(1).cast("decimal(19,4)")
    hot = F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("T"), (F.col("id") % 500).cast("string")))
    prices = ("open_price", "high_price", "low_price", "close_price", "volume_weighted_average_price", "strike_price")
    options = spark.range(n).select(
        F.col("id").cast("string").alias("option_bar_id"), F.sha2(F.col("id").cast("string"), 256).alias("option_symbol"),
        hot.alias("underlying_ticker"), day.alias("trade_date"), day.alias("expiration_date"), F.lit("call").alias("option_type"),
        *[price.alias(c) for c in prices], F.col("id").alias("volume"), F.col("id").alias("transactions"), F.lit(0).alias("days_to_expiration"),
    ).repartition(8)
    stocks = options.select(F.col("underlying_ticker").alias("ticker"), "trade_date").distinct().withColumns(
        {c: F.lit(1).cast("decimal(19,4)") for c in ("close_price", *models.AVERAGES)}
    )
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "300k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in small}
    try:
        for name, value in small.items():
            spark.conf.set(name, value)
        joined = models.join_options_to_stocks(options, stocks)
        assert len(joined.select("option_bar_id", "moneyness").toPandas()) == n
        query = joined.select("option_bar_id", "moneyness")
        execution = query._jdf.queryExecution()
        query._jdf.collectToPython()
        assert "SortMergeJoin(skew=true)" in execution.executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
