"""Loading: landing text with injected dirt to typed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.catalog.duck import ASOF
from tapeline.catalog.registry import fragment, query
from tapeline.operators import rows
from tapeline.plans import loading
from tapeline.plans.daily import as_date
from tapeline.sources import panels
from tapeline.sources.files import table
from tapeline.sources.html import page_cells, page_tables

# --- the same landing text in SQL -------------------------------------------------------


def _price(c: str) -> str:
    return f"(({c} * 0.01)::DECIMAL(14,2))::VARCHAR"


def _dirty(pred: str, text: str, marker: str = "") -> str:
    return f"CASE WHEN {pred} THEN '{marker}' ELSE {text} END"


fragment(
    "l_quote",
    f"""
SELECT 'b' || strftime(load_date, '%Y%m') AS batch_id, code, {_dirty('v % 13 = 0', _price('o'))} AS open_price, {_dirty('v % 17 = 0', _price('h'))} AS high_price,
  {_dirty('v % 19 = 0', _price('l'))} AS low_price, {_price('c')} AS close_price, {_dirty('v % 29 = 0', _price('o'))} AS previous_close, v::VARCHAR AS volume,
  {_price('t')} AS turnover, {_price('p')} AS market_cap, {_price('h')} AS ask, {_price('l')} AS bid, load_date + INTERVAL 18 HOUR AS sys_load_time, v FROM d_base""",
)
_LAST = "CASE WHEN hour = 9 THEN " + _price("o") + " ELSE " + _price("c") + " END"
fragment(
    "l_finance",
    f"""
SELECT code, load_date, hour, {_dirty('v % 7 = 0', _price('o'))} AS market_open, {_dirty('v % 49 = 0', _price('o'))} AS regular_market_open,
  {_dirty('v % 7 = 1', _price('l'))} AS market_previous_close, {_price('l')} AS regular_market_previous_close,
  {_dirty('v % 7 = 2', _LAST)} AS market_price, {_LAST} AS current_price, {_dirty('v % 7 = 3', 'v::VARCHAR')} AS market_volume, v::VARCHAR AS regular_market_volume,
  {_dirty('v % 31 = 0', _price('l'))} AS target_low_price, {_price('h')} AS target_high_price, {_price('c')} AS target_median_price,
  CASE WHEN v % 11 = 0 THEN '' WHEN v % 13 = 0 THEN 'Infinity' ELSE ((((o + h) % 900) * 0.1)::DECIMAL(14,1))::VARCHAR END AS forward_pe,
  (v * 2000)::VARCHAR AS average_volume, (r0 % 9)::VARCHAR AS number_of_analyst, (((o % 41 + 10) * 0.1)::DECIMAL(14,1))::VARCHAR AS recommendation_mean,
  {_price('h')} AS market_day_high, {_price('l')} AS market_day_low
FROM (SELECT *, unnest(CASE WHEN v % 5 = 0 THEN [9, 17] ELSE [17] END) AS hour FROM d_base)""",
)
fragment(
    "t_finance",
    """
SELECT code, load_date, coalesce(nullif(market_open, ''), nullif(regular_market_open, ''))::DECIMAL(12,3) AS open,
  coalesce(nullif(market_previous_close, ''), nullif(regular_market_previous_close, ''))::DECIMAL(12,3) AS previous_close,
  coalesce(nullif(market_price, ''), nullif(current_price, ''))::DECIMAL(12,3) AS close,
  coalesce(nullif(market_volume, ''), nullif(regular_market_volume, ''))::BIGINT AS volume, pe4 AS forward_pe,
  CASE WHEN hi <> lo THEN round((mid - lo)::DOUBLE / (hi - lo)::DOUBLE, 3) ELSE 0 END AS target_ratio
FROM (SELECT *, coalesce(pe, lag(pe, 1) OVER w, lag(pe, 2) OVER w, lag(pe, 3) OVER w, lag(pe, 4) OVER w) AS pe4 FROM (
  SELECT *, nullif(target_low_price, '')::DECIMAL(12,3) AS lo, target_high_price::DECIMAL(12,3) AS hi, target_median_price::DECIMAL(12,3) AS mid,
    CASE WHEN forward_pe IN ('', 'Infinity') THEN NULL ELSE forward_pe::DECIMAL(8,1) END AS pe
  FROM l_finance QUALIFY row_number() OVER (PARTITION BY code, load_date ORDER BY hour DESC) = 1)
  WINDOW w AS (PARTITION BY code ORDER BY load_date))
WHERE pe4 IS NOT NULL""",
)
fragment(
    "l_consensus",
    f"""
SELECT ' ' || code || ' ' AS code, load_date, hour, {_dirty('v % 17 = 0', '(r0 + CASE WHEN hour = 9 THEN 1 ELSE 0 END)::VARCHAR')} AS buy, r1, r2, r3, r4,
  '$' || {_price('h')} AS high, '$' || {_price('c')} AS median, {_dirty('v % 19 = 0', "'$' || " + _price('l'), '-')} AS low, '$' || {_price('o')} AS average, v, h, c, l
FROM (SELECT *, unnest(CASE WHEN v % 4 = 0 THEN [9, 17] ELSE [17] END) AS hour FROM d_base)""",
)
fragment(
    "t_consensus",
    """
SELECT trim(code) AS code, load_date, (b + r1 + r2 + r3 + r4)::BIGINT AS analysis, round((b + 2 * r1 + 3 * r2 + 4 * r3 + 5 * r4)::DOUBLE / (b + r1 + r2 + r3 + r4), 3) AS weight,
  round((c - l)::DOUBLE / (h - l), 3) AS target_ratio
FROM (SELECT *, buy::BIGINT AS b FROM l_consensus WHERE buy <> '' AND low LIKE '$%' AND h > c AND c > l
  QUALIFY row_number() OVER (PARTITION BY code, load_date ORDER BY hour DESC) = 1) WHERE b + r1 + r2 + r3 + r4 > 3""",
)
fragment(
    "t_short",
    """
SELECT code, load_date, CASE WHEN v % 21 = 0 THEN NULL ELSE s + 17 END AS short_position, v * 100 AS total_in_issue, round(s::DOUBLE / v, 4) AS reported_position FROM d_base""",
)
fragment(
    "t_analysis",
    """
SELECT code, load_date, CASE WHEN v % 6 = 4 THEN NULL WHEN v % 30 = 5 THEN 0 ELSE m END AS revenue, CASE WHEN v % 6 = 5 THEN NULL ELSE sg * m END AS net_income,
  CASE WHEN v % 10 = 0 THEN NULL ELSE 1000 + h % 900 + 100 + 0.5 END AS net_profit_margin, CASE WHEN v % 8 = 0 THEN NULL ELSE sg * m END AS ebitda,
  CASE WHEN v % 11 = 0 OR v % 13 = 0 THEN NULL ELSE (h % 700) * 0.1 END AS fpe, CASE WHEN v % 15 = 0 THEN NULL ELSE h * 0.01 END AS reco_price,
  CASE WHEN c % 3 = 0 THEN 'Buy' WHEN c % 3 = 1 THEN 'Hold' ELSE 'Sell' END AS average_recommendation
FROM (SELECT *, (o % 5000) * 0.1 * CASE v % 6 WHEN 0 THEN 1000000 WHEN 1 THEN 1000 WHEN 2 THEN 1000000000 WHEN 3 THEN 1000000000000 ELSE 1 END AS m,
  CASE WHEN l % 2 = 0 THEN -1 ELSE 1 END AS sg FROM d_base)""",
)
fragment(
    "t_anc",
    """
SELECT DISTINCT 'Brand#' || (user_id % 25 + 1) AS code, date_trunc('minute', ts - INTERVAL 8247 DAY) AS pub_datetime FROM events WHERE value > 30""",
)


def _num(*cols: str) -> str:
    return ", ".join(f"{c}::DOUBLE AS {c}" for c in cols)


# --- queries ----------------------------------------------------------------------------


@query(
    "load_quotes",
    """
SELECT code, sys_load_time::DATE AS load_date, open::DOUBLE AS open, low::DOUBLE AS low, high::DOUBLE AS high, close::DOUBLE AS close, pclose::DOUBLE AS pclose, volume, turnover::DOUBLE AS turnover,
  market_cap::DOUBLE AS market_cap, ask::DOUBLE AS ask, bid::DOUBLE AS bid, round(close::DOUBLE / pclose::DOUBLE, 4) AS daily_change,
  (((coalesce(high, close) + coalesce(low, close) + close) * 1000)::BIGINT * 2 + 3) // 6 * 0.001::DOUBLE AS typ3,
  (((coalesce(high, close) + coalesce(low, close) + coalesce(open, close) + close) * 1000)::BIGINT + 2) // 4 * 0.001::DOUBLE AS typ4
FROM (SELECT code, sys_load_time, nullif(open_price, '')::DECIMAL(12,3) AS open, nullif(low_price, '')::DECIMAL(12,3) AS low, nullif(high_price, '')::DECIMAL(12,3) AS high, close_price::DECIMAL(12,3) AS close,
  nullif(previous_close, '')::DECIMAL(12,3) AS pclose, volume::BIGINT AS volume, turnover::DECIMAL(20,3) AS turnover, market_cap::DECIMAL(22,2) AS market_cap, ask::DECIMAL(12,3) AS ask, bid::DECIMAL(12,3) AS bid
  FROM l_quote WHERE v % 9 <> 0)""".replace("* 0.001::DOUBLE", "/ 1000.0"),
)
def load_quotes(spark: SparkSession, sf: str) -> DataFrame:
    totals = panels.totals_table(spark, sf)
    return loading.quotes_update(panels.web_quote(totals), panels.web_quote_ticks(totals))


@query("load_finance", f"SELECT code, load_date, volume, {_num('open', 'previous_close', 'close', 'forward_pe', 'target_ratio')} FROM t_finance")
def load_finance(spark: SparkSession, sf: str) -> DataFrame:
    return loading.finance_update(panels.web_finance(panels.daily_totals(spark, sf)))


@query(
    "load_finance_newest_day",
    f"SELECT code, load_date, volume, {_num('open', 'previous_close', 'close', 'forward_pe', 'target_ratio')} FROM t_finance WHERE load_date = (SELECT max(load_date) FROM t_finance)",
)
def load_finance_newest_day(spark: SparkSession, sf: str) -> DataFrame:
    return loading.finance_update(panels.web_finance(panels.daily_totals(spark, sf)), latest_only=True)


@query("load_consensus", f"SELECT code, load_date, analysis, {_num('weight', 'target_ratio')} FROM t_consensus")
def load_consensus(spark: SparkSession, sf: str) -> DataFrame:
    return loading.consensus_update(panels.web_consensus(panels.daily_totals(spark, sf)))


@query(
    "consensus_or_default",
    """
SELECT trim(code) || '.AX' AS code, load_date, CASE WHEN n = 0 THEN 5 ELSE round((b + 2 * r1 + 3 * r2 + 4 * r3 + 5 * r4)::DOUBLE / n, 3) END::DOUBLE AS adv_ratio, n::DOUBLE AS num,
  try_cast(high[2:] AS DOUBLE) AS high, try_cast(median[2:] AS DOUBLE) AS median, try_cast(low[2:] AS DOUBLE) AS low, try_cast(average[2:] AS DOUBLE) AS average
FROM (SELECT *, b + r1 + r2 + r3 + r4 AS n FROM (SELECT *, CASE WHEN buy = '' THEN 0 ELSE buy::BIGINT END AS b FROM l_consensus))""",
)
def consensus_or_default(spark: SparkSession, sf: str) -> DataFrame:
    return loading.consensus_or_default(panels.web_consensus(panels.daily_totals(spark, sf)))


@query("load_shorts", f"SELECT code, load_date, short_position, total_in_issue, {_num('reported_position')} FROM t_short")
def load_shorts(spark: SparkSession, sf: str) -> DataFrame:
    return loading.shorts_update(panels.web_short(panels.daily_totals(spark, sf)))


@query(
    "load_analysis",
    f"SELECT code, load_date, average_recommendation, {_num('revenue', 'net_income', 'net_profit_margin', 'ebitda', 'fpe', 'reco_price')} FROM t_analysis",
)
def load_analysis(spark: SparkSession, sf: str) -> DataFrame:
    return loading.analysis_update(panels.web_analysis(panels.daily_totals(spark, sf)))


@query(
    "landing_cleanup",
    """
SELECT code, sys_load_time, coalesce(nullif(open_price, ''), nullif(previous_close, ''))::DOUBLE AS first_price, nullif(high_price, '')::DOUBLE AS high_price, nullif(low_price, '')::DOUBLE AS low_price,
  CASE WHEN length(volume) > 1 THEN volume END::BIGINT AS volume FROM l_quote""",
)
def landing_cleanup(spark: SparkSession, sf: str) -> DataFrame:
    raw = panels.web_quote(panels.daily_totals(spark, sf))
    paired = rows.coalesce_pair(raw, "first_price", "open_price", "previous_close", "decimal(12,3)")
    clean = rows.drop_sentinels(rows.blank_to_null(paired, ["high_price", "low_price"]), ["volume"])
    typed = rows.cast_text(clean, {"high_price": "decimal(12,3)", "low_price": "decimal(12,3)", "volume": "long"})
    return typed.select("code", "sys_load_time", "first_price", "high_price", "low_price", "volume")


@query("load_announcements", "SELECT * FROM t_anc")
def load_announcements(spark: SparkSession, sf: str) -> DataFrame:
    return loading.announcements_update(panels.web_announcement(spark, sf))


_FOREX = """
SELECT event_type AS batch, ['EUR_USD', 'USD_JPY', 'AUD_USD', 'GBP_USD'][user_id % 4 + 1] AS instrument, date_trunc('second', ts) AS snapshot_on_gtc,
  (round(value * 100))::DOUBLE AS bid, (round(value * 100) + 3)::DOUBLE AS ask, ts AS sys_dt FROM events"""


@query("forex_rows", _FOREX)
def forex_rows(spark: SparkSession, sf: str) -> DataFrame:
    return loading.forex_rows(panels.forex_snapshot(spark, sf))


@query(
    "forex_queue_left",
    "SELECT event_type AS batch, count(*) AS n FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00') GROUP BY 1",
)
def forex_queue_left(spark: SparkSession, sf: str) -> DataFrame:
    queue = panels.forex_snapshot(spark, sf)
    taken = queue.where(F.col("sys_dt") < F.lit("2024-01-20").cast("timestamp_ntz"))
    return loading.drained(queue, taken).groupBy("batch").agg(F.count("*").alias("n"))


@query(
    "current_code_list",
    "SELECT user_id FROM events GROUP BY 1 HAVING max(ts::DATE) = (SELECT max(ts::DATE) FROM events)",
)
def current_code_list(spark: SparkSession, sf: str) -> DataFrame:
    return loading.code_list(table(spark, sf, "events"), "user_id", "ts")


_SDC = {"index_name": "INDEX NAME", "ric": "RIC", "sequence_no": "SEQUENCE NO.", "comments": "COMMENTS"}


def index_landing(totals: DataFrame) -> DataFrame:
    """Constituent rows with quoted names; the file name carries the date and a three-letter type."""
    kind = F.when(F.col("v") % 2 == 0, "SDC").otherwise("SDE")
    return totals.select(
        F.concat(F.lit("Index "), (F.col("v") % 3).cast("string")).alias("INDEX NAME"),
        F.concat("code", F.lit(".AX")).alias("RIC"),
        F.col("v").cast("string").alias("SEQUENCE NO."),
        F.when(F.col("v") % 4 != 0, F.concat(F.lit("note "), (F.col("v") % 5).cast("string"))).alias("COMMENTS"),
        F.concat(F.date_format("load_date", "yyyyMMdd"), F.lit("_"), kind, F.lit(".csv")).alias("source_file"),
        F.date_format("load_date", "yyyyMM").alias("batch_id"),
    )


@query(
    "index_landing_load",
    """
SELECT DISTINCT 'Index ' || (v % 3) AS index_name, code || '.AX' AS ric, v::VARCHAR AS sequence_no, CASE WHEN v % 4 <> 0 THEN 'note ' || (v % 5) ELSE '' END AS comments,
  CASE WHEN v % 2 = 0 THEN 'SDC' ELSE 'SDE' END AS info_type, load_date AS record_date FROM d_base WHERE month(load_date) % 3 <> 0""",
)
def index_landing_load(spark: SparkSession, sf: str) -> DataFrame:
    from tapeline.operators.tables import absent_rows

    landing = index_landing(panels.totals_table(spark, sf))
    control = landing.select("batch_id").distinct().withColumn("is_executed", F.substring("batch_id", 5, 2).cast("int") % 3 == 0)
    pending = loading.index_rows(landing, control, _SDC, ["comments"])
    return absent_rows(None, pending, ["index_name", "ric", "info_type", "record_date"])


@query(
    "sentiment_agg",
    "SELECT 'Brand#' || (user_id % 25 + 1) AS code, ts::DATE AS load_date, round(sum(round(value * 100)::BIGINT) / 100.0 / count(*), 6) AS sentiment, count(*) AS weight FROM events GROUP BY 1, 2",
)
def sentiment_agg(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select(
        F.concat(F.lit("Brand#"), (F.col("user_id") % 25 + 1).cast("string")).alias("code"),
        F.col("ts").cast("date").alias("load_date"),
        (F.round(F.col("value") * 100).cast("long") / 100.0).alias("sentiment"),
    )
    return loading.sentiment_agg(e).withColumn("sentiment", F.round("sentiment", 6))


@query(
    "first_titles",
    """
SELECT code, publish_title, d AS load_date FROM (
  SELECT event_type AS code, props AS publish_title, ts, (ts - INTERVAL 1 DAY * (user_id % 2))::DATE AS d, epoch(ts - INTERVAL 1 DAY * (user_id % 2))::BIGINT::VARCHAR AS pt FROM events
  QUALIFY row_number() OVER (PARTITION BY event_type, props ORDER BY ts, pt) = 1) WHERE ts::DATE = d""",
)
def first_titles(spark: SparkSession, sf: str) -> DataFrame:
    shifted = F.col("ts") - F.make_dt_interval((F.col("user_id") % 2).cast("int"))
    titles = table(spark, sf, "events").select(
        F.col("event_type").alias("code"),
        F.col("props").alias("publish_title"),
        F.unix_seconds(shifted.cast("timestamp")).cast("string").alias("publish_time"),
        F.col("ts").alias("sys_load_time"),
    )
    return loading.first_titles(titles)


@query(
    "build_transactions",
    """
SELECT f.code, f.load_date, f.close::DOUBLE AS close, s.short_position, coalesce(x.sentiment, 0) AS sentiment, coalesce(x.weight, 0) AS weight
FROM t_finance f LEFT JOIN t_short s ON f.code = s.code AND f.load_date = s.load_date
LEFT JOIN (SELECT p_brand AS code, l_shipdate::DATE AS load_date, round(avg(l_tax), 6) AS sentiment, count(*) AS weight FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_tax > 0.04 GROUP BY 1, 2) x
  ON f.code = x.code AND f.load_date = x.load_date""",
)
def build_transactions(spark: SparkSession, sf: str) -> DataFrame:
    totals = panels.totals_table(spark, sf)
    part = table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("code"))
    taxed = table(spark, sf, "lineitem").where("l_tax > 0.04").join(part, F.col("l_partkey") == F.col("p_partkey"))
    sentiment = loading.sentiment_agg(taxed.select("code", F.col("l_shipdate").cast("date").alias("load_date"), F.col("l_tax").alias("sentiment")))
    finance = loading.finance_update(panels.web_finance(totals))
    out = loading.build_transactions(finance, loading.shorts_update(panels.web_short(totals)), sentiment)
    return out.select("code", "load_date", "close", "short_position", F.round("sentiment", 6).alias("sentiment"), "weight")


@query(
    "merge_history",
    """
WITH old AS (SELECT code, load_date, close, short_position, weight FROM (SELECT f.code, f.load_date, f.close, s.short_position, c.weight FROM t_finance f
  LEFT JOIN t_short s ON f.code = s.code AND f.load_date = s.load_date LEFT JOIN t_consensus c ON f.code = c.code AND f.load_date = c.load_date))
SELECT code, load_date, close::DOUBLE AS close, short_position, weight FROM old WHERE load_date < DATE '1999-01-01'
UNION SELECT code, load_date, close::DOUBLE, short_position, weight FROM old WHERE load_date >= DATE '1998-01-01'""",
)
def merge_history(spark: SparkSession, sf: str) -> DataFrame:
    totals = panels.totals_table(spark, sf)
    finance = loading.finance_update(panels.web_finance(totals)).select("code", "load_date", "close")
    short = loading.shorts_update(panels.web_short(totals)).select("code", "load_date", "short_position")
    consensus = loading.consensus_update(panels.web_consensus(totals)).select("code", "load_date", "weight")
    keys = ["code", "load_date"]
    old = finance.join(short, keys, "left").join(consensus, keys, "left").where("load_date < DATE '1999-01-01'")
    return loading.merge_history(finance.where("load_date >= DATE '1998-01-01'"), short, consensus, old)


# Two loads of one moment: both of them are the latest.
fragment(
    "t_short_tied",
    "SELECT code, load_date, CASE WHEN v % 21 = 0 THEN NULL ELSE s + hour END AS short_position FROM (SELECT *, unnest(CASE WHEN v % 6 = 0 THEN [9, 17] ELSE [17] END) AS hour FROM d_base)",
)


@query(
    "merge_history_with_ties",
    """
SELECT f.code, f.load_date, f.close::DOUBLE AS close, short_position FROM t_finance f LEFT JOIN t_short s ON f.code = s.code AND f.load_date = s.load_date WHERE f.load_date < DATE '1999-01-01'
UNION SELECT f.code, f.load_date, f.close::DOUBLE, short_position FROM t_finance f LEFT JOIN t_short_tied s ON f.code = s.code AND f.load_date = s.load_date WHERE f.load_date >= DATE '1998-01-01'""",
)
def merge_history_with_ties(spark: SparkSession, sf: str) -> DataFrame:
    totals = panels.totals_table(spark, sf)
    finance = loading.finance_update(panels.web_finance(totals)).select("code", "load_date", "close")
    web_short, keys = panels.web_short(totals), ["code", "load_date"]
    tied = loading.shorts_update(web_short.withColumn("sys_load", F.date_trunc("day", "sys_load")), ties=True).select(*keys, "short_position")
    old = finance.join(loading.shorts_update(web_short).select(*keys, "short_position"), keys, "left").where("load_date < DATE '1999-01-01'")
    none = tied.select(*keys).limit(0)
    return loading.merge_history(finance.where("load_date >= DATE '1998-01-01'"), tied, none, old)


@query(
    "general_transactions",
    """
WITH e AS (SELECT b.*, (CASE WHEN v % 5 = 0 THEN NULL ELSE o END) AS ho FROM d_base b WHERE code <> 'Brand#3' AND load_date <> DATE '1998-04-26' AND v % 4 <> 0)
SELECT e.code || '.AX' AS code, e.load_date AS record_date, (coalesce(ho, h) * 0.01)::DOUBLE AS market_open, (c * 0.01)::DOUBLE AS market_price, v AS market_volume, i.date_index
FROM e JOIN (SELECT load_date, row_number() OVER (ORDER BY load_date) AS date_index FROM (SELECT DISTINCT load_date FROM e)) i ON e.load_date = i.load_date""",
)
def general_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return _general(spark, sf).select("code", "record_date", "market_open", "market_price", "market_volume", "date_index")


_GENERAL = """
WITH e AS (SELECT * FROM d_base WHERE code <> 'Brand#3' AND load_date <> DATE '1998-04-26' AND v % 4 <> 0),
g AS (SELECT code || '.AX' AS code, e.load_date AS record_date, c, h, l, date_index FROM e JOIN (SELECT load_date, row_number() OVER (ORDER BY load_date) AS date_index FROM (SELECT DISTINCT load_date FROM e)) i ON e.load_date = i.load_date)"""


@query("general_ranges", _GENERAL + " SELECT code, record_date, (h * 0.01)::DOUBLE AS market_day_high, (l * 0.01)::DOUBLE AS market_day_low, date_index FROM g")
def general_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return _general(spark, sf).select("code", "record_date", "market_day_high", "market_day_low", "date_index")


@query(
    "general_performance",
    _GENERAL + " SELECT s.code, s.date_index, (s.c * 0.01)::DOUBLE AS start_price, (e.c * 0.01)::DOUBLE AS end_price FROM g s JOIN g e ON s.code = e.code AND e.date_index = s.date_index + 25",
)
def general_performance(spark: SparkSession, sf: str) -> DataFrame:
    return loading.general_performance(_general(spark, sf))


def _general(spark: SparkSession, sf: str) -> DataFrame:
    totals = panels.totals_table(spark, sf)
    text = {c: F.col(c).cast("string") for c in ("open", "high", "low", "close")}
    hist = panels.quotes_of(totals).where("volume % 4 <> 0").select(
        "code",
        F.date_format("load_date", "MM/dd/yy").alias("date"),
        F.when(F.col("volume") % 5 != 0, text["open"]).alias("open"),
        *[text[c].alias(c) for c in ("high", "low", "close")],
        F.concat(F.col("volume").cast("string"), F.lit(".7")).alias("volume"),
    )
    export = panels.quotes_of(totals).select(
        F.concat("code", F.lit(".AX")).alias("code"),
        F.col("load_date").alias("record_date"),
        F.col("high").alias("market_open"),
        F.col("low").alias("market_price"),
        F.col("high").alias("market_day_high"),
        F.col("low").alias("market_day_low"),
        F.lit(0).cast("long").alias("market_volume"),
    )
    return loading.general(export, hist, ["Brand#3.AX"], ["1998-04-26"])


@query(
    "etl_log",
    """
WITH day AS (SELECT DATE '2001-06-29' AS d), b AS (SELECT DISTINCT 'b' || strftime(load_date, '%Y%m') AS batch_id FROM d_base WHERE load_date = (SELECT d FROM day)),
q AS (SELECT count(*) AS n FROM l_quote WHERE sys_load_time::DATE = (SELECT d FROM day)), f AS (SELECT count(*) AS n FROM l_finance WHERE load_date = (SELECT d FROM day))
SELECT 'dQuote' AS job_name, (SELECT n FROM q) AS records, TIMESTAMP '2001-06-29 18:00:00' AS started UNION ALL SELECT 'dStatement', (SELECT n FROM f), TIMESTAMP '2001-06-29 19:00:00' UNION ALL SELECT 'dIdle', 0, TIMESTAMP '2001-06-29 20:00:00'""",
)
def etl_log(spark: SparkSession, sf: str) -> DataFrame:
    totals = panels.totals_table(spark, sf)
    quote, finance = panels.web_quote(totals), panels.web_finance(totals)
    day = as_date(ASOF)
    jobs = F.array(*[F.struct(F.lit(j).alias("job_name"), F.lit(h).alias("hour")) for j, h in (("dQuote", 18), ("dStatement", 19), ("dIdle", 20))])
    day_batch = quote.where(F.col("sys_load_time").cast("date") == day).select("batch_id").distinct()
    batches = day_batch.select("batch_id", F.explode(jobs).alias("j")).select(
        F.when(F.col("j.job_name") == "dQuote", F.col("batch_id")).otherwise(F.col("j.job_name")).alias("batch_id"),
        "j.job_name",
        (day.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("j.hour"))).alias("start_time"),
    )
    return loading.etl_log(batches, {"quote": quote}, {"dStatement": finance}, day)


@query(
    "page_list_items",
    r"""
SELECT page_id, coalesce(x[1], '') AS cell1, coalesce(x[2], '') AS cell2, coalesce(x[3], '') AS cell3, coalesce(x[5], '') AS cell4, coalesce(x[8], '') AS cell5, len(x) AS n FROM (
  SELECT page_id, list_transform(regexp_extract_all(html, '(?s)<li[^>]*>(.*?)</li>', 1), lambda t: trim(regexp_replace(t, '<[^>]*>', '', 'g'))) AS x FROM pages)""",
)
def page_list_items(spark: SparkSession, sf: str) -> DataFrame:
    return page_cells(table(spark, sf, "pages"), "li", [1, 2, 3, 5, 8])


_CONSENSUS_TAKEN, _VALUE_TAKEN = (2, 5, 8, 11, 14), range(5)
_CELLS = [f"CASE WHEN page_id % 3 <> 0 THEN (page_id + {k})::VARCHAR ELSE '' END AS {n}" for k, n in zip(_CONSENSUS_TAKEN, ("buy", "overweight", "hold", "underweight", "sell"), strict=True)]
_CELLS += [f"CASE WHEN page_id % 2 = 0 THEN '$' || (page_id * 10 + {k}) ELSE '' END AS {n}" for k, n in zip(_VALUE_TAKEN, ("high", "median", "low", "average", "current"), strict=True)]


def pages_with_tables(pages: DataFrame) -> DataFrame:
    """The given pages with quote tables in them: a decoy on all, ratings on two of three, targets on every other."""

    def cells(n: int, text, cls: str = "data_data") -> list:
        return [c for i in range(n) for c in (F.lit(f'<td class="{cls}"> <b>'), text(i), F.lit("</b></td>"))]

    def box(head: str, parts: list):
        return F.concat(F.lit(f'<table class="cr_dataTable">{head}<tr>'), *parts, F.lit("</tr></table>"))

    rating = cells(15, lambda i: (F.col("page_id") + i).cast("string"))
    target = cells(5, lambda i: F.lit(f"label {i}"), "data_lbl") + cells(5, lambda i: F.concat(F.lit("$"), (F.col("page_id") * 10 + i).cast("string")))
    head = "<thead><tr><th>Rating</th><th>3 Months Ago</th><th>1 Month Ago</th></tr></thead>"
    decoy = box("", cells(4, lambda i: F.lit(str(i))))
    ratings = F.when(F.col("page_id") % 3 != 0, box(head, rating)).otherwise("")
    targets = F.when(F.col("page_id") % 2 == 0, box("", target)).otherwise("")
    return pages.select("page_id", F.concat("html", decoy, ratings, targets).alias("html"))


@query("page_tables", f"SELECT page_id, {', '.join(_CELLS)} FROM pages")
def page_table_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Consensus and value cells of data tables; five blanks where a page has no such table."""
    return page_tables(pages_with_tables(table(spark, sf, "pages")))
