"""Bar tables derived from the order, line item and event tables.

Tickers are the market segments (long series, prices above and below 1) and the
event users (many short, volatile series). Prices are cut to whole units before
they become decimals, so that no engine has a tie to round.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline import schemas
from barline.operators.history import first_snapshot
from barline.plans import models
from barline.session import fresh_path
from barline.sources.tables import rebuild

FIRST_LOAD = datetime(2024, 6, 1)
CORRECTED = datetime(2024, 6, 8)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _price(units: Column, scale: int) -> Column:
    return (F.floor(units) / F.lit(scale)).cast(schemas.PRICE)


def _bars(rows: DataFrame, keys: list[str], value: str, order: Column, size: Column, scale: int) -> DataFrame:
    """Open, high, low, close, volume, volume-weighted price and trades per key."""
    whole = F.floor(value).cast("bigint")
    return rows.groupBy(*keys).agg(
        _price(F.min_by(value, order), scale).alias("open"),
        _price(F.max(value), scale).alias("high"),
        _price(F.min(value), scale).alias("low"),
        _price(F.max_by(value, order), scale).alias("close"),
        F.sum(size).alias("volume"),
        F.sum(whole * size).alias("_spent"),
        F.count("*").alias("transactions"),
    ).withColumn("vwap", _price(F.expr("_spent div volume"), scale)).drop("_spent")


def segment_bars(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    orders = table(spark, sf_dir, "orders").filter(where)
    customers = table(spark, sf_dir, "customer")
    rows = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_mktsegment").alias("ticker"), F.to_date("o_orderdate").alias("trade_date"),
        "o_totalprice", "o_orderkey", (F.floor(F.col("o_totalprice") / 1000) + 1).alias("size"),
    )
    return _bars(rows, ["ticker", "trade_date"], "o_totalprice", F.col("o_orderkey"), F.col("size"), 10000)


def user_bars(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    events = table(spark, sf_dir, "events").filter(where)
    rows = events.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ticker"),
        F.to_date("ts").alias("trade_date"), "event_id",
        F.round(F.col("value") * 100).alias("cents"), F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    ).withColumn("size", F.coalesce("k", F.lit(0)) + 1)
    return _bars(rows, ["ticker", "trade_date"], "cents", F.col("event_id"), F.col("size"), 100)


def _loaded(bars: DataFrame, at: datetime, schema) -> DataFrame:
    return schemas.conform(bars.withColumn("inserted_at", F.lit(at)), schema)


def _source_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Size and time of the source tables, so that a changed table is read anew."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    state = []
    for name in ("orders", "customer", "lineitem", "events"):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        status = path.getFileSystem(conf).getFileStatus(path)
        state.append((status.getLen(), status.getModificationTime()))
    return tuple(state)


_written: dict[tuple, str] = {}


def stored(build: Callable[[SparkSession, str], DataFrame], schema: T.StructType | None = None):
    """A table that is written on first use in a session and read from then on.

    The models read tables that loads have written, not views that work each
    bar out again; so do the queries.
    """

    @wraps(build)
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir, build.__name__, _source_state(spark, sf_dir))
        if key not in _written:
            path = fresh_path(spark, build.__name__.strip("_"))  # a leading _ would hide it
            rebuild(build(spark, sf_dir), path)
            _written[key] = path
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(_written[key])

    return read


def _stock_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw stock table after its first load."""
    bars = segment_bars(spark, sf_dir).unionByName(user_bars(spark, sf_dir))
    return _loaded(bars, FIRST_LOAD, schemas.STOCK_BARS)


def _corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later batch: bars again, from urgent orders and purchases only."""
    bars = segment_bars(spark, sf_dir, "o_orderpriority = '1-URGENT'").unionByName(
        user_bars(spark, sf_dir, "event_type = 'purchase'")
    )
    return _loaded(bars, CORRECTED, schemas.STOCK_BARS)


def _option_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw option table: line items traded on their ship date.

    Lines are dealt by order once, brought down to a row per order, day and type, and meet
    their order where they are. From there on an order's number alone tells which line is the
    first and which the last, so bars are added up in buffers of a fixed size, by hashing;
    ordered by all that places a line they would be sorted, and spilled, before and after.
    """
    items = table(spark, sf_dir, "lineitem").filter(F.col("l_orderkey").isNotNull()).select(
        "l_orderkey", F.to_date("l_shipdate").alias("trade_date"),
        F.when(F.col("l_linestatus") == "O", "call").otherwise("put").alias("option_type"),
        "l_extendedprice", F.col("l_quantity").cast("bigint").alias("size"), "l_linenumber", "l_partkey", "l_suppkey",
    )
    place = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    value, whole = "l_extendedprice", F.floor("l_extendedprice").cast("bigint")
    lines = items.repartition("l_orderkey").groupBy("l_orderkey", "trade_date", "option_type").agg(
        F.min_by(value, place).alias("open"), F.max(value).alias("high"), F.min(value).alias("low"),
        F.max_by(value, place).alias("close"), F.sum("size").alias("volume"),
        F.sum(whole * F.col("size")).alias("spent"), F.count("*").alias("transactions"),
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("underlying_ticker"))
    orders = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "underlying_ticker", F.to_date("o_orderdate").alias("expiration_date"),
        F.floor(F.col("o_totalprice") / 10000).cast("int").alias("strike"),
    )
    keys = ["underlying_ticker", "trade_date", "expiration_date", "strike", "option_type"]
    bars = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(*keys).agg(
        _price(F.min_by("open", "l_orderkey"), 10000).alias("open"), _price(F.max("high"), 10000).alias("high"),
        _price(F.min("low"), 10000).alias("low"), _price(F.max_by("close", "l_orderkey"), 10000).alias("close"),
        F.sum("volume").alias("volume"), F.sum("spent").alias("_spent"), F.sum("transactions").alias("transactions"),
    ).withColumn("vwap", _price(F.expr("_spent div volume"), 10000)).drop("_spent")
    symbol = F.concat(
        F.lit("O:"), "underlying_ticker", F.date_format("expiration_date", "yyMMdd"),
        F.upper(F.substring("option_type", 1, 1)), F.lpad((F.col("strike") * 1000).cast("string"), 8, "0"),
    )
    bars = bars.withColumns({"option_symbol": symbol, "strike_price": F.col("strike")})
    return _loaded(bars, FIRST_LOAD, schemas.OPTION_BARS)


stock_bars = stored(_stock_bars, schemas.STOCK_BARS)
corrections = stored(_corrections, schemas.STOCK_BARS)
option_bars = stored(_option_bars, schemas.OPTION_BARS)


def staged_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.stage_stock_bars(first_snapshot(stock_bars(spark, sf_dir), schemas.STOCK_KEY))


def staged_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.stage_option_bars(first_snapshot(option_bars(spark, sf_dir), schemas.OPTION_KEY))
