"""Every registered query against its SQL, at the smallest scale."""

import pytest

import oracle
from __spark_entry__ import entry
from barline.queries import REGISTRY

SF = "/root/testdata/sf0.001"
# Keys of the blueprint's operator tables.
WANTED = """
src_stock_json src_option_json src_history_json src_option_history_json grouped_daily_split range_bars_split
contract_pages chain_flatten seed_scan manifest_scan filename_key quarantine_split mart_scan ticker_dim
dq_artifact_scan typed_cast upsert_bars upsert_dq incremental_merge incremental_filter full_refresh scd2_snapshot
landing_envelope manifest_write archive_stream current_rows stg_stock_bars stg_option_bars fct_stock_performance
ticker_filter date_slice allowlist_semi unexpired_filter nonempty_filter validate_symbols dq_latest trade_events
parse_occ parse_occ_plain expiry_date epoch_date bar_id days_to_expiration price_round moneyness daily_range
dq_by_day last_segment path_rewrite trading_calendar target_date flatten_lists batch_ids options_stocks_join
portfolio dq_status_counts distinct_tickers date_bounds profit_factor sharpe_sortino total_return num_trades
max_drawdown sma price_change rolling_mean rolling_mean_full bollinger ema diff returns drawdown ffill momentum
dq_top20 union_batches dedup_latest rsi macd enriched_bars enriched_options mean_reversion macd_strategy
rsi_strategy all_strategies backtest_report dq_unique dq_not_null dq_regex dq_type dq_between dq_row_condition
dq_pair dq_freshness dq_results stream_load late_bar_recompute backfill_grid
""".split()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_every_operator_is_registered_and_checked():
    assert set(WANTED) <= set(REGISTRY)
    assert all(q.sql for q in REGISTRY.values())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_its_sql(spark, con, name):
    fault, *_ = oracle.compare(spark, con, SF, name)
    assert not fault, fault


def test_entry_has_rows_and_a_stable_schema(spark):
    first = entry(spark)
    assert first.limit(1).count() == 1
    assert first.schema == entry(spark).schema
