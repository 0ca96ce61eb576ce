"""Raw JSON documents to bar rows, with a reason for every document refused.

Readers give (path, doc) rows. Parsers work on that shape whether it came from
a folder, a file stream or a table. Each adds ``reject_reason``: null on good
rows. ``accepted`` and ``rejected`` split the two.
"""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barline import schemas
from barline.functions import symbols
from barline.functions.dates import in_calendar, utc_date
from barline.functions.keys import file_key, last_segment
from barline.functions.shapes import computed_once, objects, scalars
from barline.operators.merge import replace_by_key
from barline.sources.versions import commit, period, read

REASON = "reject_reason"


def read_documents(spark: SparkSession, path: str | list[str], one_per_file: bool = True) -> DataFrame:
    """(path, doc) rows of a folder: a document per file, or one per line."""
    text = spark.read.text(path, wholetext=one_per_file, recursiveFileLookup=True)
    return as_documents(text)


def as_documents(text: DataFrame) -> DataFrame:
    return text.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("doc"))


def placed_documents(text: DataFrame) -> DataFrame:
    """(path, doc, at) rows: ``at`` grows with the place of a document in its file, once
    ``numbered`` has told the lines of one split apart."""
    start = F.array(F.col("_metadata.file_block_start"))
    return text.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("doc"), start.alias("at"))


def numbered(docs: DataFrame) -> DataFrame:
    """Documents as they were scanned: the number of a row grows within a split, and the
    split's first byte comes before it, so that files may be split in any way."""
    return docs.withColumn("at", F.concat("at", F.array(F.monotonically_increasing_id())))


def _origin(rows: DataFrame) -> list[Column]:
    """Where a row comes from: the columns that documents were read with."""
    return [F.col(c) for c in ("path", "doc", "at") if c in rows.columns]


def _parsed(docs: DataFrame, fields: str) -> DataFrame:
    """Add ``d``, the parsed document, and ``_broken`` where the text is not JSON."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = computed_once(docs, "d", F.from_json("doc", f"{fields}, _corrupt string", options))
    return parsed.withColumn("_broken", F.col("d").isNull() | F.col("d._corrupt").isNotNull())


def _first(*rules: tuple[Column, str]) -> Column:
    """The first reason whose condition holds."""
    return F.coalesce(*[F.when(F.coalesce(cond, F.lit(False)), why) for cond, why in rules])


def accepted(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(rows: DataFrame) -> DataFrame:
    """The refused documents, one row each, with the reason."""
    return rows.filter(F.col(REASON).isNotNull()).select("path", "doc", REASON)


def loaded_paths(rows: DataFrame) -> DataFrame:
    """Files that gave at least one row: the ones to archive."""
    return accepted(rows).select("path").distinct()


# The wire names of a bar's prices.
PRICE_FIELDS = ("o", "h", "l", "c", "vw")
PRICE_LIMIT = 1e15  # of decimal(19,4)


def _unstorable(prices: list[Column], counts: list[Column]) -> Column:
    """Whether a number does not fit its column, which would fail the whole load."""
    too_many = [c.isNotNull() & c.try_cast("bigint").isNull() for c in counts]
    return (F.greatest(*[F.abs(p) for p in prices]) >= PRICE_LIMIT) | reduce(or_, too_many)


def _has_bars() -> Column:
    return (F.col("d.resultsCount") > 0) & (F.size("d.results") > 0)


def nonempty(docs: DataFrame) -> DataFrame:
    """Documents that report and hold at least one result."""
    return _parsed(docs, schemas.BAR_DOCUMENT).filter(_has_bars()).select("path", "doc")


def _single_bar(docs: DataFrame) -> tuple[DataFrame, list[tuple[Column, str]]]:
    """Parsed documents with the first result as ``bar``, and what may be wrong with them."""
    rows = _parsed(docs, schemas.BAR_DOCUMENT).withColumn("bar", F.get("d.results", F.lit(0)))
    bar = F.col("bar")
    single = (F.col("d.resultsCount") == 1) & (F.size("d.results") > 0)
    rules = [
        (F.col("_broken"), "malformed json"),
        (F.col("d.ticker").isNull() & F.coalesce(single, F.lit(False)), "no ticker"),
        (~F.coalesce(single, F.lit(False)), "no single result"),
        (bar["t"].isNull(), "no time"),
        (~in_calendar(bar["t"]), "time out of range"),
        (_unstorable([bar[f] for f in PRICE_FIELDS], [bar["v"], bar["n"]]), "number out of range"),
    ]
    return rows, rules


def _bar_columns() -> list[Column]:
    names = {"v": "volume", "vw": "vwap", "o": "open", "c": "close", "h": "high", "l": "low", "n": "transactions"}
    return [utc_date(F.col("bar.t")).alias("trade_date"), *[F.col(f"bar.{f}").alias(n) for f, n in names.items()]]


def stock_bars(docs: DataFrame) -> DataFrame:
    """One bar from each document that holds exactly one result."""
    rows, rules = _single_bar(docs)
    rows = computed_once(rows, REASON, _first(*rules))
    return rows.select(*_origin(rows), REASON, F.col("d.ticker").alias("ticker"), *_bar_columns())


def option_bars(docs: DataFrame) -> DataFrame:
    """As ``stock_bars``, with the contract read from the document's symbol."""
    rows, rules = _single_bar(docs)
    rows = symbols.with_contract(rows.withColumn("option_symbol", F.col("d.ticker")), "option_symbol")
    (broken, *others) = rules
    named = (F.col("option_symbol").isNull(), "no ticker")
    rows = computed_once(rows, REASON, _first(broken, named, *_contract_rules(), *others))
    return rows.select(*_origin(rows), REASON, "option_symbol", *CONTRACT, *_bar_columns())


CONTRACT = ("underlying_ticker", "expiration_date", "option_type", "strike_price")


def _contract_rules() -> list[tuple[Column, str]]:
    return [
        (F.col("underlying_ticker").isNull(), "unreadable symbol"),
        (F.col("expiration_date").isNull(), "impossible expiry"),
    ]


def history_bars(docs: DataFrame) -> DataFrame:
    """One bar for each day of a broker history, which is one object or a list.

    The ticker is the file name up to the first underscore. Documents without a
    history keep one row, to carry the reason they are refused for.
    """
    rows = _parsed(docs, schemas.HISTORY_DOCUMENT)
    days = objects(F.col("d.history.day"), schemas.HISTORY_DAY)
    rows = computed_once(rows, "_days", days)
    rows = rows.select("*", F.posexplode_outer("_days").alias("_nth", "day"))
    if "at" in rows.columns:  # days of one document are in its order
        rows = rows.withColumn("at", F.concat("at", F.array(F.coalesce("_nth", F.lit(0)).cast("bigint"))))
    day = F.try_to_date(F.col("day.date"))
    prices = [F.col(f"day.{c}") for c in ("open", "high", "low", "close", "vwap")]
    volume = F.col("day.volume")
    rules = [
        (F.col("_broken"), "malformed json"),
        (F.coalesce(F.size("_days"), F.lit(0)) <= 0, "no history"),
        (day.isNull(), "no trade date"),
        (_unstorable(prices, [volume, volume]), "number out of range"),
    ]
    return computed_once(rows, REASON, _first(*rules)).select(
        *_origin(rows), REASON, file_key(F.col("path")).alias("ticker"), day.alias("trade_date"),
        *[F.col(f"day.{c}").alias(c) for c in ("volume", "vwap", "open", "close", "high", "low")],
    )


def option_history_bars(docs: DataFrame) -> DataFrame:
    """Broker option histories; the contract comes from the file name, whose
    faults come before any inside the document."""
    rows = history_bars(docs).withColumnRenamed("ticker", "option_symbol")
    rows = symbols.with_contract(rows, "option_symbol", symbols.BROKER_SYMBOL)
    return computed_once(rows, REASON, F.coalesce(_first(*_contract_rules()), F.col(REASON)))


def grouped_bars(docs: DataFrame, tickers: DataFrame) -> DataFrame:
    """A market-wide document per date to one single-result row per listed ticker."""
    rows = _parsed(docs, schemas.GROUPED_DOCUMENT).filter(_has_bars())
    # Names resolve without regard to case, so the feed's T and t need other ones.
    bars = F.col("d.results").cast(f"array<struct<ticker string, {schemas.BAR}>>")
    rows = rows.select(F.col("d.request_id").alias("request_id"), F.explode(bars).alias("bar"))
    return listed(rows.withColumn("ticker", F.col("bar.ticker")), tickers)


def listed(rows: DataFrame, tickers: DataFrame) -> DataFrame:
    """Rows whose ticker is in the list; broadcast only if the list is small."""
    return rows.join(tickers.select("ticker"), "ticker", "left_semi")


def range_bars(docs: DataFrame) -> DataFrame:
    """A contract's document of many bars to one row per contract and UTC date."""
    rows = _parsed(docs, schemas.BAR_DOCUMENT).filter(_has_bars())
    rows = rows.select(F.col("d.ticker").alias("ticker"), F.explode("d.results").alias("bar"))
    return rows.filter(in_calendar(F.col("bar.t"))).withColumn("trade_date", utc_date(F.col("bar.t")))


def contract_symbols(docs: DataFrame) -> DataFrame:
    """The contract symbols of all listing pages; next-page links are not needed."""
    rows = _parsed(docs, schemas.CONTRACT_PAGE)
    return rows.select(F.explode("d.results.ticker").alias("option_symbol")).filter(
        F.col("option_symbol").isNotNull()
    )


def expirations(docs: DataFrame) -> DataFrame:
    """(underlying, expiration) from (underlying, doc) rows, a date or a list each."""
    rows = _parsed(docs, schemas.EXPIRATIONS_DOCUMENT)
    return rows.select("underlying", F.explode(scalars(F.col("d.expirations.date"))).alias("expiration"))


def chain_symbols(expiration_docs: DataFrame, chain_docs: DataFrame) -> DataFrame:
    """Contract symbols of every listed expiration's chain, an object or a list.

    ``chain_docs`` has (underlying, expiration, doc). A missing or null level
    gives no rows.
    """
    wanted = expirations(expiration_docs)
    chains = _parsed(chain_docs, schemas.CHAIN_DOCUMENT).join(
        wanted, ["underlying", "expiration"], "left_semi"
    )
    entries = objects(F.col("d.options.option"), schemas.SYMBOL_ENTRY)
    return chains.select("underlying", "expiration", F.explode(entries.symbol).alias("option_symbol")).filter(
        F.col("option_symbol").isNotNull()
    )


def valid_tickers(lookups: DataFrame) -> DataFrame:
    """Tickers whose lookup reply names exactly them, from (ticker, doc) rows."""
    rows = _parsed(lookups, schemas.LOOKUP_DOCUMENT)
    found = objects(F.col("d.securities.security"), schemas.SYMBOL_ENTRY)
    return rows.filter(F.exists(found, lambda s: s["symbol"] == F.col("ticker"))).select("ticker")


def run_results(docs: DataFrame) -> DataFrame:
    """Result records of the tests in run documents; failures default to 0."""
    rows = _parsed(docs, schemas.RUN_ARTIFACT)
    rows = rows.select(
        F.to_timestamp("d.metadata.generated_at").alias("run_generated_at"),
        F.explode("d.results").alias("r"),
    ).filter(F.startswith(F.col("r.unique_id"), F.lit("test.")))
    return rows.select(
        F.col("r.unique_id").alias("test_id"), last_segment(F.col("r.unique_id")).alias("test_name"),
        F.col("r.status").alias("status"), F.coalesce("r.failures", F.lit(0)).alias("failures"),
        F.col("r.execution_time").alias("execution_time"), "run_generated_at",
    )


# --- Writing ---------------------------------------------------------------------


def envelope(ticker: Column, bar: Column, request_id: Column | None = None) -> Column:
    """The single-result document that the loads read, as JSON text."""
    fields = [
        ticker.alias("ticker"), F.lit(1).alias("queryCount"), F.lit(1).alias("resultsCount"),
        F.lit(True).alias("adjusted"),
        F.array(F.struct(*[bar[f].alias(f) for f in ("v", "vw", "o", "c", "h", "l", "t", "n")])).alias("results"),
        F.lit("OK").alias("status"),
    ]
    if request_id is not None:
        fields.append(request_id.alias("request_id"))
    return F.to_json(F.struct(*fields))


def landing(rows: DataFrame, prefix: str = "raw_data/") -> DataFrame:
    """(key, trade_date, doc): the landing documents of (ticker, bar) rows."""
    day = utc_date(F.col("bar.t"))
    request = F.col("request_id") if "request_id" in rows.columns else None
    return rows.select(
        F.concat(F.lit(prefix), "ticker", F.lit("_"), F.date_format(day, "yyyy-MM-dd"), F.lit(".json")).alias("key"),
        day.alias("trade_date"),
        envelope(F.col("ticker"), F.col("bar"), request).alias("doc"),
    )


def land(documents: DataFrame, path: str, grain: str = "day") -> None:
    """Add (key, trade_date, doc) rows to the landing store, replacing documents of their
    keys. A key is a symbol and a date, and a date is in one period, so only the periods of
    these documents are read and written, each as a few files rather than one a document,
    and a rerun of any part of a load leaves the same documents."""
    spark = documents.sparkSession
    periods = [row[0] for row in documents.select(period(grain)).distinct().collect()]
    if periods:
        before = read(spark, path, documents.schema, periods)
        commit(replace_by_key(before, documents, ("key",)), path, grain)


def landed(spark: SparkSession, path: str, since: date | None = None) -> DataFrame:
    """(path, doc) rows of the landing store, or of its periods from one on."""
    return read(spark, path, since=since).select(F.col("key").alias("path"), "doc")
