"""Document, manifest, seed and artifact scans.

Documents are made by Spark from the bar tables, in the shapes the feeds send:
good ones, and by a property of the bar, truncated, empty or otherwise wrong.
They are written first, as lines of files, or beside their paths or symbols as
a table, and parsed from what is scanned there.
"""

from pyspark.sql import functions as F

from barline import fixtures as fx
from barline.functions import keys
from barline.queries.registry import BARS, OPTIONS, query, shown, with_sql
from barline.queries.tables import RESULTS, test_results
from barline.session import fresh_path
from barline.sources import documents as docs
from barline.sources import tables
from barline.sources.listed import listed_documents
from barline.sources.versions import read

BAR_SHOWN = "open:n high:n low:n close:n volume:n vwap:n transactions:n"
BAR_NAMES = ("open", "high", "low", "close", "volume", "vwap", "transactions")


def wire_bar(df):
    """Bars as the feeds send them, in one struct of doubles and a millisecond time."""
    number = {"v": "volume", "vw": "vwap", "o": "open", "c": "close", "h": "high", "l": "low"}
    fields = [F.col(c).cast("double").alias(n) for n, c in number.items()]
    time = F.unix_millis(F.col("trade_date").cast("timestamp")) + 14 * 3_600_000
    fields += [time.alias("t"), F.col("transactions").alias("n")]
    return df.withColumn("bar", F.struct(*fields))


def spoiled(doc, day):
    """Documents of some days of the month cut short, emptied, doubled or made timeless."""
    return (
        F.when(day == 13, F.substring(doc, F.lit(1), F.length(doc) - 5))
        .when(day == 14, F.replace(doc, F.lit('"resultsCount":1'), F.lit('"resultsCount":0')))
        .when(day == 15, F.replace(doc, F.lit('"resultsCount":1'), F.lit('"resultsCount":2')))
        .when(day == 16, F.replace(doc, F.lit('"t":'), F.lit('"u":')))
        .when(day == 17, F.replace(doc, F.lit('"ticker":'), F.lit('"symbol":')))
        .otherwise(doc)
    )


REASONS = """CASE day(trade_date) WHEN 13 THEN 'malformed json' WHEN 14 THEN 'no single result'
  WHEN 15 THEN 'no single result' WHEN 16 THEN 'no time' WHEN 17 THEN 'no ticker' END"""
GOOD = "day(trade_date) NOT BETWEEN 13 AND 17"


def stock_documents(spark, sf_dir):
    bars = wire_bar(fx.stock_bars(spark, sf_dir))
    name = F.concat(F.lit("raw_data/"), "ticker", F.lit("_"), F.col("trade_date").cast("string"), F.lit(".json"))
    doc = spoiled(docs.envelope(F.col("ticker"), F.col("bar")), F.dayofmonth("trade_date"))
    return bars.select(name.alias("path"), doc.alias("doc"))


def option_documents(spark, sf_dir):
    """Option envelopes; on the first of a month the symbol is not one, on the second it expires in month 99."""
    bars = wire_bar(fx.option_bars(spark, sf_dir))
    day = F.dayofmonth("trade_date")
    symbol = (
        F.when(day == 1, F.col("underlying_ticker"))
        .when(day == 2, F.concat(F.lit("O:"), "underlying_ticker", F.lit("259901C00001000")))
        .otherwise(F.col("option_symbol"))
    )
    name = F.concat(F.lit("raw_data/options/"), symbol, F.lit("_"), F.col("trade_date").cast("string"), F.lit(".json"))
    return bars.select(name.alias("path"), spoiled(docs.envelope(symbol, F.col("bar")), day).alias("doc"))


def from_lines(spark, documents):
    """Documents written one a line and read from the folder."""
    path = fresh_path(spark, "documents")
    documents.select(F.col("doc").alias("value")).write.text(path)
    return docs.read_documents(spark, path, one_per_file=False)


def from_table(spark, documents):
    """Documents written beside their other columns and read from that table."""
    path = fresh_path(spark, "documents")
    tables.rebuild(documents, path)
    return spark.read.schema(documents.schema).parquet(path)


@query("src_stock_json", with_sql(BARS, f"SELECT ticker, {shown('trade_date:d ' + BAR_SHOWN)} FROM bars WHERE {GOOD}"))
def src_stock_json(spark, sf_dir):
    """Documents written one per line, read back from the folder and parsed."""
    found = from_lines(spark, stock_documents(spark, sf_dir))
    return docs.accepted(docs.stock_bars(found)).select("ticker", "trade_date", *BAR_NAMES)


@query("src_option_json", with_sql(OPTIONS, f"""
    SELECT {shown('option_symbol trade_date:d underlying_ticker expiration_date:d strike_price:n option_type ' + BAR_SHOWN)}
    FROM options WHERE {GOOD} AND day(trade_date) > 2"""))
def src_option_json(spark, sf_dir):
    rows = docs.accepted(docs.option_bars(from_lines(spark, option_documents(spark, sf_dir))))
    return rows.select(
        "option_symbol", "trade_date", "underlying_ticker", "expiration_date", "strike_price", "option_type", *BAR_NAMES
    )


@query("quarantine_split", with_sql(BARS, f"""
    SELECT 'raw_data/' || ticker || '_' || CAST(trade_date AS VARCHAR) || '.json' AS path,
      coalesce({REASONS}, 'loaded') AS outcome FROM bars"""))
def quarantine_split(spark, sf_dir):
    """Every document's fate: loaded, or refused for a reason."""
    rows = docs.stock_bars(from_table(spark, stock_documents(spark, sf_dir)))
    refused = docs.rejected(rows).select("path", F.col(docs.REASON).alias("outcome"))
    return docs.loaded_paths(rows).withColumn("outcome", F.lit("loaded")).unionByName(refused)


@query("nonempty_filter", with_sql(BARS, """
    SELECT 'raw_data/' || ticker || '_' || CAST(trade_date AS VARCHAR) || '.json' AS path FROM bars WHERE day(trade_date) NOT IN (13, 14)"""))
def nonempty_filter(spark, sf_dir):
    return docs.nonempty(from_table(spark, stock_documents(spark, sf_dir))).select("path")


# --- Broker histories: a list of days, one object, or nothing -----------------------------


def history_documents(bars, symbol):
    """A document per symbol and month holding a list in even quarters; one per day,
    holding an object, in odd ones; documents of single trades have no history."""
    day = F.struct(
        F.col("trade_date").cast("string").alias("date"),
        *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close", "volume", "vwap")],
    )
    rows = bars.select(symbol.alias("symbol"), "trade_date", "transactions", day.alias("day"))
    many = rows.filter(F.quarter("trade_date").isin(2, 4))
    lists = many.groupBy("symbol", F.trunc("trade_date", "month").alias("trade_date")).agg(
        F.collect_list("day").alias("day")  # at most one for each day of a month
    )
    as_list = lists.select("symbol", "trade_date", F.to_json(F.struct(F.struct("day").alias("history"))).alias("doc"))
    one = rows.filter(F.quarter("trade_date").isin(1, 3))
    as_object = one.select(
        "symbol", "trade_date",
        F.when(F.col("transactions") > 1, F.to_json(F.struct(F.struct("day").alias("history"))))
        .otherwise('{"history":null}').alias("doc"),
    )
    name = F.concat(F.lit("raw_data/"), "symbol", F.lit("_"), F.col("trade_date").cast("string"), F.lit(".json"))
    return as_list.unionByName(as_object).select(name.alias("path"), "doc")


HAS_HISTORY = "(quarter(trade_date) IN (2, 4) OR transactions > 1)"
DAY_SHOWN = "open:n high:n low:n close:n volume:n vwap:n"
DAY_NAMES = ("open", "high", "low", "close", "volume", "vwap")


@query("src_history_json", with_sql(BARS, f"SELECT ticker, {shown('trade_date:d ' + DAY_SHOWN)} FROM bars WHERE {HAS_HISTORY}"))
def src_history_json(spark, sf_dir):
    documents = from_table(spark, history_documents(fx.stock_bars(spark, sf_dir), F.col("ticker")))
    return docs.accepted(docs.history_bars(documents)).select("ticker", "trade_date", *DAY_NAMES)


@query("src_option_history_json", with_sql(OPTIONS, f"""
    SELECT substr(option_symbol, 3) AS option_symbol, {shown('trade_date:d underlying_ticker expiration_date:d strike_price:n option_type ' + DAY_SHOWN)}
    FROM options WHERE {HAS_HISTORY}"""))
def src_option_history_json(spark, sf_dir):
    documents = from_table(spark, history_documents(fx.option_bars(spark, sf_dir), F.substring("option_symbol", 3, 100)))
    return docs.accepted(docs.option_history_bars(documents)).select(
        "option_symbol", "trade_date", "underlying_ticker", "expiration_date", "strike_price", "option_type", *DAY_NAMES
    )


@query("filename_key", with_sql(BARS, """
    SELECT 'raw_data/' || ticker || '_' || CAST(trade_date AS VARCHAR) || '.json' AS path, ticker FROM bars"""))
def filename_key(spark, sf_dir):
    paths = from_table(spark, stock_documents(spark, sf_dir)).select("path")
    return paths.withColumn("ticker", keys.file_key(F.col("path")))


# --- Market-wide and per-contract documents, and landing --------------------------------------


def grouped_documents(spark, sf_dir):
    """A document per date and hundred users, and one per date for the segments.

    Documents of the 13th say they hold no results.
    """
    bars = wire_bar(fx.stock_bars(spark, sf_dir))
    user = F.regexp_extract("ticker", r"^U(\d+)$", 1)
    shelf = F.when(user == "", -1).otherwise(F.try_divide(F.nullif(user, F.lit("")).cast("int"), F.lit(100)).cast("int"))
    entry = F.struct(F.col("ticker").alias("T"), "bar.*")
    groups = bars.withColumn("shelf", shelf).groupBy("trade_date", "shelf").agg(F.collect_list(entry).alias("results"))
    count = F.when(F.dayofmonth("trade_date") == 13, 0).otherwise(F.size("results"))
    request = F.concat(F.lit("r"), F.date_format("trade_date", "yyyyMMdd"))
    doc = F.to_json(F.struct(count.alias("resultsCount"), request.alias("request_id"), "results"))
    return groups.select(request.alias("path"), doc.alias("doc"))


def solvent_segments(spark, sf_dir):
    customers = fx.table(spark, sf_dir, "customer").filter("c_acctbal > 0")
    return customers.select(F.col("c_mktsegment").alias("ticker")).distinct()


ALLOWED = "ticker IN (SELECT c_mktsegment FROM customer WHERE c_acctbal > 0) AND day(trade_date) <> 13"


@query("grouped_daily_split", with_sql(BARS, f"""
    SELECT ticker, CAST(trade_date AS VARCHAR) AS trade_date, 'r' || strftime(trade_date, '%Y%m%d') AS request_id,
      {shown('open:n close:n volume:n')}, transactions FROM bars WHERE {ALLOWED}"""))
def grouped_daily_split(spark, sf_dir):
    rows = docs.grouped_bars(from_lines(spark, grouped_documents(spark, sf_dir)), solvent_segments(spark, sf_dir))
    return rows.select(
        "ticker", docs.utc_date(F.col("bar.t")).alias("trade_date"), "request_id",
        F.col("bar.o").alias("open"), F.col("bar.c").alias("close"), F.col("bar.v").alias("volume"),
        F.col("bar.n").cast("bigint").alias("transactions"),
    )


@query("landing_envelope", with_sql(BARS, f"""
    SELECT 'raw_data/' || ticker || '_' || CAST(trade_date AS VARCHAR) || '.json' AS key, CAST(trade_date AS VARCHAR) AS trade_date,
      ticker, CAST(1 AS BIGINT) AS result_count, 'OK' AS status, CAST(close AS DOUBLE) AS close FROM bars WHERE {ALLOWED}"""))
def landing_envelope(spark, sf_dir):
    """Grouped documents rewritten as single-result ones and landed, those of one ticker
    again, then read back field by field."""
    rows = docs.grouped_bars(from_lines(spark, grouped_documents(spark, sf_dir)), solvent_segments(spark, sf_dir))
    path, documents = fresh_path(spark, "landing"), docs.landing(rows)
    docs.land(documents, path, "year")
    docs.land(documents.filter(F.get_json_object("doc", "$.ticker") == "BUILDING"), path, "year")
    landed = read(spark, path)

    def field(path):
        return F.get_json_object("doc", path)

    return landed.select(
        "key", "trade_date", field("$.ticker").alias("ticker"),
        field("$.resultsCount").cast("int").alias("result_count"), field("$.status").alias("status"),
        field("$.results[0].c").cast("double").alias("close"),
    )


@query("range_bars_split", with_sql(OPTIONS, f"SELECT option_symbol AS ticker, {shown('trade_date:d close:n volume:n')} FROM options"))
def range_bars_split(spark, sf_dir):
    """A document per contract and year, of at most a bar per day."""
    bars = wire_bar(fx.option_bars(spark, sf_dir))
    groups = bars.groupBy(F.col("option_symbol").alias("ticker"), F.year("trade_date")).agg(
        F.collect_list("bar").alias("results")
    )
    doc = F.to_json(F.struct("ticker", F.size("results").alias("resultsCount"), "results"))
    rows = docs.range_bars(from_lines(spark, groups.select(doc.alias("doc"))))
    return rows.select("ticker", "trade_date", F.col("bar.c").alias("close"), F.col("bar.v").alias("volume"))


# --- Contract lists, chains and lookups ----------------------------------------------------------


def contracts(spark, sf_dir):
    return fx.option_bars(spark, sf_dir).select(
        "option_symbol", "underlying_ticker", "expiration_date", "option_type"
    ).distinct()


@query("contract_pages", with_sql(OPTIONS, "SELECT DISTINCT option_symbol FROM options"))
def contract_pages(spark, sf_dir):
    """A page per underlying and expiry: its strike ladder."""
    pages = contracts(spark, sf_dir).groupBy("underlying_ticker", "expiration_date").agg(
        F.collect_list(F.struct(F.col("option_symbol").alias("ticker"))).alias("results")
    )
    doc = F.to_json(F.struct("results", F.concat(F.lit("next-"), "underlying_ticker").alias("next_url")))
    return docs.contract_symbols(from_lines(spark, pages.select(doc.alias("doc"))))


@query("chain_flatten", with_sql(OPTIONS, """
    SELECT DISTINCT underlying_ticker AS underlying, CAST(expiration_date AS VARCHAR) AS expiration, option_symbol
    FROM options WHERE day(expiration_date) NOT IN (30, 31)"""))
def chain_flatten(spark, sf_dir):
    """Expirations as a list per month, or as one date on the first; chains as lists,
    or one object for puts. The 30th is not listed, and chains of the 31st are null."""
    rows = contracts(spark, sf_dir).withColumnRenamed("underlying_ticker", "underlying").withColumn(
        "expiration", F.col("expiration_date").cast("string")
    )
    day = F.dayofmonth("expiration_date")
    dated = rows.filter(day != 30).select("underlying", "expiration", "expiration_date").distinct()
    single = dated.filter(day == 1).select(
        "underlying", F.to_json(F.struct(F.struct(F.col("expiration").alias("date")).alias("expirations"))).alias("doc")
    )
    many = dated.filter(day != 1).groupBy("underlying", F.trunc("expiration_date", "month")).agg(
        F.collect_list("expiration").alias("date")
    ).select("underlying", F.to_json(F.struct(F.struct("date").alias("expirations"))).alias("doc"))
    none = dated.select("underlying").distinct().withColumn("doc", F.lit('{"expirations":null}'))

    contract = F.struct(F.col("option_symbol").alias("symbol"))
    calls = rows.filter("option_type = 'call'").groupBy("underlying", "expiration", day.alias("day")).agg(
        F.collect_list(contract).alias("option")
    )
    chain = F.to_json(F.struct(F.struct("option").alias("options")))
    puts = rows.filter("option_type = 'put'").select("underlying", "expiration", day.alias("day"), contract.alias("option"))
    chains = calls.select("underlying", "expiration", "day", chain.alias("doc")).unionByName(
        puts.select("underlying", "expiration", "day", chain.alias("doc"))
    )
    doc = F.when(F.col("day") == 31, '{"options":null}').otherwise(F.col("doc"))
    chains = chains.select("underlying", "expiration", doc.alias("doc"))
    return docs.chain_symbols(from_table(spark, single.unionByName(many).unionByName(none)), from_table(spark, chains))


@query("validate_symbols", """
    SELECT 'U' || user_id AS ticker FROM events GROUP BY user_id
    HAVING count(*) FILTER (event_type = 'signup') >= count(*) FILTER (event_type = 'error')""")
def validate_symbols(spark, sf_dir):
    """Lookup replies name the user alone, among others, with a suffix only, or nobody."""
    events = fx.table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "signup").alias("signups"),
        F.count_if(F.col("event_type") == "error").alias("errors"),
        F.count_if(F.col("event_type") == "view").alias("views"),
    )
    users = events.withColumn("ticker", F.concat(F.lit("U"), F.col("user_id").cast("string")))
    exact = F.struct(F.col("ticker").alias("symbol"))
    longer = F.struct(F.concat("ticker", F.lit(".X")).alias("symbol"))
    found = F.when(F.col("views") > 10, F.to_json(F.array(longer, exact))).otherwise(F.to_json(exact))
    security = F.when(F.col("signups") >= F.col("errors"), found).when(
        F.col("views") > F.col("signups"), F.to_json(longer)
    )
    doc = F.when(security.isNull(), '{"securities":null}').otherwise(
        F.concat(F.lit('{"securities":{"security":'), security, F.lit("}}"))
    )
    return docs.valid_tickers(from_table(spark, users.select("ticker", doc.alias("doc"))))


# --- Manifests, seeds and run artifacts -------------------------------------------------------------


@query("manifest_write", with_sql(BARS, f"""
    SELECT 'raw_data/' || ticker || '_' || CAST(trade_date AS VARCHAR) || '.json' AS path FROM bars WHERE {GOOD}"""))
def manifest_write(spark, sf_dir):
    """The paths of loadable documents, each twice, written as a manifest and read as text."""
    target = fresh_path(spark, "manifest")
    paths = docs.loaded_paths(docs.stock_bars(stock_documents(spark, sf_dir)))
    tables.write_manifest(paths.unionByName(paths), target)
    return spark.read.text(target).withColumnRenamed("value", "path")


@query("manifest_scan", with_sql(BARS, f"""
    SELECT ticker, {shown('trade_date:d close:n')} FROM bars WHERE {GOOD} AND month(trade_date) % 2 = 0"""))
def manifest_scan(spark, sf_dir):
    """Documents in files by month; a manifest with blank lines lists the files of every other
    month, one of them twice, and only these are opened."""
    folder, target = fresh_path(spark, "landed"), fresh_path(spark, "manifest")
    bars = wire_bar(fx.stock_bars(spark, sf_dir))
    doc = spoiled(docs.envelope(F.col("ticker"), F.col("bar")), F.dayofmonth("trade_date"))
    bars.select(doc.alias("value"), F.month("trade_date").alias("month")).write.partitionBy("month").text(folder)
    files = spark.read.format("binaryFile").load(folder).select("path", "month")
    wanted = files.filter("month % 2 = 0").select(F.concat(F.lit(" "), "path").alias("value"))
    blank = files.select(F.lit("").alias("value"))
    wanted.unionByName(wanted.limit(1)).unionByName(blank).write.text(target)
    listed, _ = listed_documents(spark, tables.read_manifest(spark, target), folder, one_per_file=False, range_bytes=10_000)
    return docs.accepted(docs.stock_bars(listed)).select("ticker", "trade_date", "close")


@query("seed_scan", """
    SELECT c_name AS ticker, 'The "' || c_mktsegment || '", Inc' AS company_name, c_mktsegment AS sector FROM customer""")
def seed_scan(spark, sf_dir):
    """A company list written as CSV, quotes and commas included, and read as a seed."""
    path = fresh_path(spark, "seed")
    customers = fx.table(spark, sf_dir, "customer")
    company = F.concat(F.lit('The "'), "c_mktsegment", F.lit('", Inc'))
    seed = customers.select(
        F.col("c_name").alias("ticker"), company.alias("company_name"), F.col("c_mktsegment").alias("sector")
    )
    seed.write.option("header", True).option("escape", '"').csv(path)
    return tables.read_seed(spark, path)


@query("dq_artifact_scan", with_sql(RESULTS, f"SELECT {shown('test_id test_name status failures execution_time:r run_generated_at:t')} FROM results"))
def dq_artifact_scan(spark, sf_dir):
    """Run documents of one event type, each also holding a model that is no test."""
    results = test_results(spark, sf_dir)
    result = F.struct(
        F.col("test_id").alias("unique_id"), "status",
        F.when(F.col("failures") > 0, F.col("failures")).alias("failures"), "execution_time",
    )
    model = F.struct(
        F.concat(F.lit("model.bars."), "test_name").alias("unique_id"), F.lit("success").alias("status"),
        F.lit(None).cast("int").alias("failures"), F.lit(0.5).alias("execution_time"),
    )
    run = F.struct(F.date_format("run_generated_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("generated_at"))
    doc = F.to_json(F.struct(run.alias("metadata"), F.array(model, result).alias("results")))
    return docs.run_results(from_lines(spark, results.select(doc.alias("doc"))))
