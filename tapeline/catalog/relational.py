"""Row, join, aggregate, window and set operators on the given tables and the derived panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.catalog.duck import ASOF, DAY
from tapeline.catalog.registry import fragment, query
from tapeline.functions.numeric import dec, flag, ratio, squash
from tapeline.functions.series import EMA15, by
from tapeline.functions.text import joined
from tapeline.operators import aggregates, joins, rows, tables, windows
from tapeline.plans.daily import active_on, as_date, calendar
from tapeline.sources import panels
from tapeline.sources.files import table



def asof() -> Column:
    return as_date(ASOF)


def indexed(bars: DataFrame) -> DataFrame:
    """Add the ascending calendar index of each date."""
    return bars.join(calendar(bars).select("load_date", "date_index"), "load_date")


fragment("d_ix", "SELECT load_date, row_number() OVER (ORDER BY load_date) AS date_index FROM (SELECT DISTINCT load_date FROM d_base)")
fragment("d_ib", "SELECT b.*, i.date_index FROM d_bars b JOIN d_ix i ON b.load_date = i.load_date")

# --- projections, filters, predicates ---------------------------------------------------


@query(
    "volume_buckets",
    """
SELECT CASE WHEN volume >= 120 THEN 3 WHEN volume >= 80 THEN 2 WHEN volume >= 40 THEN 1 ELSE 0 END AS bucket, count(*) AS n, sum(volume)::BIGINT AS volume
FROM d_bars GROUP BY 1""",
)
def volume_buckets(spark: SparkSession, sf: str) -> DataFrame:
    v = F.col("volume")
    out = rows.bucketize(panels.quotes(spark, sf), "bucket", [(v >= 120, 3), (v >= 80, 2), (v >= 40, 1)], 0)
    return out.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("volume").alias("volume"))


@query(
    "known_change_rows",
    "SELECT code, count(*) AS n FROM d_bars WHERE pclose IS NOT NULL AND (close > pclose OR close IS NULL) GROUP BY 1",
)
def known_change_rows(spark: SparkSession, sf: str) -> DataFrame:
    bars = panels.quotes(spark, sf)
    kept = bars.where(F.col("pclose").isNotNull() & ((F.col("close") > F.col("pclose")) | F.col("close").isNull()))
    return kept.groupBy("code").agg(F.count("*").alias("n"))


@query(
    "listed_priorities",
    """
SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW') AND o_orderstatus NOT IN ('P') AND o_custkey <> 7 GROUP BY 1""",
)
def listed_priorities(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    kept = o.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "5-LOW") & ~F.col("o_orderstatus").isin("P") & (F.col("o_custkey") != 7))
    return kept.groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query(
    "name_patterns",
    "SELECT p_brand, count(*) AS n FROM part WHERE p_name LIKE 's%' AND p_name LIKE '%g' AND p_type NOT LIKE 'ECO%' GROUP BY 1",
)
def name_patterns(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    kept = p.where(F.col("p_name").startswith("s") & F.col("p_name").endswith("g") & ~F.col("p_type").like("ECO%"))
    return kept.groupBy("p_brand").agg(F.count("*").alias("n"))


@query(
    "strictly_ordered_prices",
    "SELECT code, load_date, high::DOUBLE AS high, close::DOUBLE AS close, low::DOUBLE AS low FROM d_bars WHERE high > close AND close > low",
)
def strictly_ordered_prices(spark: SparkSession, sf: str) -> DataFrame:
    return rows.monotone_filter(panels.quotes(spark, sf).select("code", "load_date", "high", "close", "low"), ["high", "close", "low"])


@query(
    "clamped_change",
    """
SELECT code, load_date, CASE WHEN x < -10 THEN -10.0 WHEN x > 10 THEN 10.0 ELSE x END AS change FROM (
  SELECT code, load_date, round((close::DOUBLE - pclose) / pclose * 100, 6) AS x FROM d_bars)""",
)
def clamped_change(spark: SparkSession, sf: str) -> DataFrame:
    change = F.round(ratio(F.col("close").cast("double") - F.col("pclose").cast("double"), F.col("pclose")) * 100, 6)
    return rows.clamp(panels.quotes(spark, sf).select("code", "load_date", change.alias("change")), "change", -10.0, 10.0)


@query(
    "trading_time_ticks",
    """
SELECT ts::DATE AS day, count(*) AS n FROM events WHERE isodow(ts) < 6 AND ts::TIME <= TIME '12:30:00' GROUP BY 1""",
)
def trading_time_ticks(spark: SparkSession, sf: str) -> DataFrame:
    kept = rows.trading_time(table(spark, sf, "events"), "ts", "12:30:00")
    return kept.groupBy(F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n"))


@query(
    "recent_rows",
    f"""
SELECT 'days' AS span, code, count(*) AS n FROM d_bars WHERE load_date > {DAY} - 168 AND load_date <= {DAY} GROUP BY 2
UNION ALL SELECT 'months', code, count(*) FROM d_bars WHERE load_date > {DAY} - INTERVAL 6 MONTH AND load_date <= {DAY} GROUP BY 2""",
)
def recent_rows(spark: SparkSession, sf: str) -> DataFrame:
    bars = panels.quotes_table(spark, sf).select("code", "load_date")

    def count(span: str, df: DataFrame) -> DataFrame:
        return df.groupBy("code").agg(F.count("*").alias("n")).select(F.lit(span).alias("span"), "code", "n")

    return count("days", rows.since(bars, "load_date", asof(), days=168)).unionByName(count("months", rows.since(bars, "load_date", asof(), months=6)))


@query(
    "newest_and_previous_day",
    f"""
WITH b AS (SELECT * FROM d_bars WHERE load_date <= {DAY})
SELECT 'newest' AS which, code, load_date, close::DOUBLE AS close FROM b WHERE load_date = (SELECT max(load_date) FROM b)
UNION ALL SELECT 'previous', code, load_date, close::DOUBLE FROM b WHERE load_date = (SELECT max(load_date) FROM b WHERE load_date < (SELECT max(load_date) FROM b))""",
)
def newest_and_previous_day(spark: SparkSession, sf: str) -> DataFrame:
    bars = panels.quotes_table(spark, sf).where(F.col("load_date") <= asof()).select("code", "load_date", "close")
    newest = rows.at_latest(bars, "load_date").select(F.lit("newest").alias("which"), "*")
    return newest.unionByName(windows.second_latest(bars, "load_date").select(F.lit("previous").alias("which"), "*"))


@query(
    "spread_quality",
    "SELECT code, load_date FROM d_bars WHERE CASE WHEN high <= low THEN 0 ELSE (close - low)::DOUBLE / (high - low)::DOUBLE END > 0.4",
)
def spread_quality(spark: SparkSession, sf: str) -> DataFrame:
    return rows.spread_quality(panels.quotes(spark, sf), "low", "close", "high", 0.4).select("code", "load_date")


@query(
    "balance_signs",
    """
SELECT c_mktsegment, CASE WHEN c_acctbal IS NULL THEN '0' WHEN c_acctbal > 0 THEN '+' ELSE '-' END AS c_acctbal, count(*) AS n FROM customer GROUP BY 1, 2""",
)
def balance_signs(spark: SparkSession, sf: str) -> DataFrame:
    out = rows.sign_map(table(spark, sf, "customer"), ["c_acctbal"], ("+", "0", "-"))
    return out.groupBy("c_mktsegment", "c_acctbal").agg(F.count("*").alias("n"))


@query(
    "null_to_text",
    "SELECT code, load_date, coalesce(pclose::VARCHAR, 'NULL') AS pclose, coalesce(CASE WHEN volume % 11 = 0 THEN NULL ELSE volume END::VARCHAR, 'NULL') AS volume FROM d_bars",
)
def null_to_text(spark: SparkSession, sf: str) -> DataFrame:
    b = panels.quotes(spark, sf).select("code", "load_date", "pclose", F.when(F.col("volume") % 11 != 0, F.col("volume")).alias("volume"))
    return rows.null_to_text(b, ["pclose", "volume"])


_SMALL = "CASE WHEN code = 'Brand#7' AND {c} < 20000 THEN {c} * 10 ELSE {c} END::DOUBLE AS {c}"


@query("rescaled_prices", "SELECT code, load_date, " + ", ".join(_SMALL.format(c=c) for c in ("open", "high", "low", "close")) + " FROM d_bars")
def rescaled_prices(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["open", "high", "low", "close"]
    bars = panels.quotes(spark, sf).select("code", "load_date", *cols)
    return rows.rescale_where(bars, cols, F.col("code") == "Brand#7", 20000, 10)


# --- joins ------------------------------------------------------------------------------


@query(
    "priority_revenue",
    """
SELECT o_orderpriority, count(*) AS n, (sum(round(l_extendedprice * 100)::BIGINT) / 100.0)::DOUBLE AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
)
def priority_revenue(spark: SparkSession, sf: str) -> DataFrame:
    line, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    return line.join(o, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), (F.sum(cents) / 100.0).alias("revenue")
    )


@query(
    "bars_with_shorts",
    """
SELECT b.code, b.load_date, b.close::DOUBLE AS close, coalesce(s.n, 0) AS returned FROM d_bars b LEFT JOIN (
  SELECT p_brand AS code, l_shipdate::DATE AS load_date, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'R' GROUP BY 1, 2) s
ON b.code = s.code AND b.load_date = s.load_date""",
)
def bars_with_shorts(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("code"))
    returned = (
        table(spark, sf, "lineitem")
        .where(F.col("l_returnflag") == "R")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("code", F.col("l_shipdate").cast("date").alias("load_date"))
        .agg(F.count("*").alias("returned"))
    )
    return joins.enrich(panels.quotes(spark, sf).select("code", "load_date", "close"), returned, ["code", "load_date"], {"returned": 0})


_LIST = """SELECT code, row_number() OVER (ORDER BY market_cap DESC, code) AS total_ranking FROM d_bars WHERE load_date = {d}"""


@query(
    "today_against_last_list",
    f"""
WITH t AS ({_LIST.format(d=DAY)}), y AS ({_LIST.format(d=f"(SELECT max(load_date) FROM d_bars WHERE load_date < {DAY})")})
SELECT coalesce(t.code, y.code) AS code, t.total_ranking, y.total_ranking AS last_total_ranking FROM t FULL JOIN y ON t.code = y.code""",
)
def today_against_last_list(spark: SparkSession, sf: str) -> DataFrame:
    bars = panels.quotes_table(spark, sf).where(F.col("load_date") <= asof()).select("code", "load_date", "market_cap")
    ranked = windows.rank_per_date(bars, "load_date", [F.desc("market_cap"), F.col("code")], "total_ranking")
    today = ranked.where(F.col("load_date") == asof())
    return joins.compare_lists(today, windows.second_latest(ranked, "load_date"), "code", [], ["total_ranking"])


@query(
    "scaled_volume",
    """
WITH p AS (SELECT min(volume) AS lo, avg(volume) AS mean FROM d_bars)
SELECT code, load_date, round((volume - p.lo) / (p.mean - p.lo), 6) AS scaled FROM d_bars, p""",
)
def scaled_volume(spark: SparkSession, sf: str) -> DataFrame:
    bars = panels.quotes_table(spark, sf).select("code", "load_date", "volume")
    out = joins.attach_scalar(bars, aggregates.scale_params(bars, ["volume"]))
    scaled = ratio(F.col("volume") - F.col("p.min_volume"), F.col("p.avg_volume") - F.col("p.min_volume"))
    return out.select("code", "load_date", F.round(scaled, 6).alias("scaled"))


@query(
    "forward_returns",
    """
SELECT s.code, s.date_index, round((e.close::DOUBLE - s.open::DOUBLE) / s.open::DOUBLE, 6) AS performance
FROM d_ib s JOIN d_ib e ON s.code = e.code AND s.date_index = e.date_index - 14""",
)
def forward_returns(spark: SparkSession, sf: str) -> DataFrame:
    pairs = joins.forward_return(indexed(panels.quotes_table(spark, sf)), "code", "date_index", 14, "open", "close")
    growth = ratio(F.col("end_price").cast("double") - F.col("start_price").cast("double"), F.col("start_price"))
    return pairs.select("code", "date_index", F.round(growth, 6).alias("performance"))


@query(
    "gapless_last_three",
    """
SELECT a.code, a.date_index, a.close::DOUBLE AS close, b.close::DOUBLE AS close_01, c.close::DOUBLE AS close_02
FROM d_ib a JOIN d_ib b ON a.code = b.code AND b.date_index = a.date_index - 1 JOIN d_ib c ON a.code = c.code AND c.date_index = a.date_index - 2""",
)
def gapless_last_three(spark: SparkSession, sf: str) -> DataFrame:
    return joins.with_last_n(indexed(panels.quotes_table(spark, sf)).select("code", "date_index", "close"), "code", "date_index", ["close"], 3)


@query(
    "price_lookback",
    """
SELECT t.code, t.load_date, count(*) AS n, round(avg(CASE WHEN e.close > e.open THEN 1.0 ELSE 0.0 END), 6) AS up_share
FROM (SELECT * FROM d_bars WHERE close > pclose * 3) t JOIN d_bars e ON t.code = e.code AND e.load_date BETWEEN t.load_date - 84 AND t.load_date GROUP BY 1, 2""",
)
def price_lookback(spark: SparkSession, sf: str) -> DataFrame:
    up = F.when(F.col("close") > F.col("open"), 1.0).otherwise(0.0)
    bars = panels.quotes(spark, sf).select("code", "load_date", (F.col("close") > F.col("pclose") * 3).alias("jump"), up.alias("up"))
    seen = joins.look_back(bars, "code", "load_date", 84, n=F.count("*"), up_share=F.avg("up"))
    return seen.where("jump").select("code", "load_date", "n", F.round("up_share", 6).alias("up_share"))


@query(
    "dense_filled_prices",
    f"""
WITH b AS (SELECT * FROM d_bars WHERE load_date <= {DAY}), g AS (SELECT c.code, i.load_date FROM (SELECT DISTINCT code FROM b) c CROSS JOIN (SELECT DISTINCT load_date FROM b) i)
SELECT g.code, g.load_date, n.open::DOUBLE AS open, n.close::DOUBLE AS close, g.load_date = n.load_date AS is_own
FROM g JOIN LATERAL (SELECT * FROM b WHERE b.code = g.code AND b.load_date >= g.load_date ORDER BY b.load_date LIMIT 1) n ON TRUE""",
)
def dense_filled_prices(spark: SparkSession, sf: str) -> DataFrame:
    bars = panels.quotes_table(spark, sf).where(F.col("load_date") <= asof()).select("code", "load_date", "open", "close")
    grid = joins.densify(bars.select("code").distinct(), bars, "load_date")
    wide = grid.join(bars, ["code", "load_date"], "left").withColumn("is_own", F.col("close").isNotNull())
    return joins.fill_from_next(wide, "code", "load_date", ["open", "close"], F.col("close").isNotNull())


@query(
    "orphan_lines",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 45)
  OR l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 23)""",
)
def orphan_lines(spark: SparkSession, sf: str) -> DataFrame:
    line = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    part = table(spark, sf, "part").where(F.col("p_size") <= 45)
    supplier = table(spark, sf, "supplier").where(F.col("s_nationkey") < 23)
    return joins.orphans(line, [(part, "l_partkey", "p_partkey"), (supplier, "l_suppkey", "s_suppkey")])


@query(
    "restricted_and_deleted",
    f"""
WITH k AS (SELECT code FROM d_bars WHERE load_date <= {DAY} GROUP BY 1 HAVING max(load_date) = {DAY})
SELECT 'kept' AS side, code, count(*) AS n FROM d_bars WHERE code IN (SELECT code FROM k) GROUP BY 2
UNION ALL SELECT 'deleted', code, count(*) FROM d_bars WHERE code NOT IN (SELECT code FROM k) GROUP BY 2""",
)
def restricted_and_deleted(spark: SparkSession, sf: str) -> DataFrame:
    bars = panels.quotes_table(spark, sf).select("code", "load_date")
    keys = active_on(bars, ASOF)
    kept = joins.restrict_to(bars, keys, ["code"]).groupBy("code").agg(F.count("*").alias("n"))
    gone = joins.delete_matching(bars, keys, ["code"]).groupBy("code").agg(F.count("*").alias("n"))
    return kept.select(F.lit("kept").alias("side"), "*").unionByName(gone.select(F.lit("deleted").alias("side"), "*"))


def _weights(spark: SparkSession, line: DataFrame) -> DataFrame:
    """The 15-term weight vector as a table (one row per order)."""
    return line.select(F.posexplode(F.array(*[F.lit(x) for x in EMA15])).alias("orders", "weight"))


@query(
    "weight_map_convolution",
    """
SELECT code, load_date, round(value, 4) AS value FROM (
  SELECT code, max(load_date) AS load_date, sum((close * 1000)::BIGINT * weight)::BIGINT / 1e12 AS value, count(*) AS n
  FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY load_date DESC) - 1 AS orders FROM d_bars) b JOIN w15 w ON b.orders = w.orders GROUP BY code) WHERE n = 15""",
)
def weight_map_convolution(spark: SparkSession, sf: str) -> DataFrame:
    bars = panels.quotes(spark, sf).select("code", "load_date", "close")
    out = joins.convolve(bars, _weights(spark, spark.range(1)), "code", "load_date", "close", 15)
    return out.withColumn("value", dec(F.col("value"), 4, 18))


@query(
    "convolution_by_position",
    """
SELECT code, round(sum((close * 1000)::BIGINT * weight)::BIGINT / 1e12, 4) AS value
FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY load_date DESC) AS back FROM d_bars QUALIFY back <= 15) b
JOIN w15 w ON (15 - back) + w.orders = 14 GROUP BY code""",
)
def convolution_by_position(spark: SparkSession, sf: str) -> DataFrame:
    bars = panels.quotes(spark, sf).select("code", "load_date", "close")
    newest = windows.top_k_per_group(bars, ["code"], [F.desc("load_date")], 15, "back").withColumn("pos", 15 - F.col("back"))
    out = joins.convolve_at(newest, _weights(spark, spark.range(1)), "code", "pos", "close", 14)
    return out.withColumn("value", dec(F.col("value"), 4, 18))


fragment("m_ret", "SELECT load_date, avg(CASE WHEN pclose IS NULL THEN 1.0 ELSE least(greatest(close::DOUBLE / pclose, 0.9), 1.1) END) AS g FROM d_bars GROUP BY 1")


@query(
    "running_growth",
    "SELECT load_date, round(ln(10) * sum(log10(g)) OVER (ORDER BY load_date), 6) AS log_growth FROM m_ret",
)
def running_growth(spark: SparkSession, sf: str) -> DataFrame:
    g = F.least(F.greatest(ratio(F.col("close"), F.col("pclose")), F.lit(0.9)), F.lit(1.1))
    daily = panels.quotes(spark, sf).groupBy("load_date").agg(F.avg(F.when(F.col("pclose").isNull(), 1.0).otherwise(g)).alias("growth"))
    out = joins.running_product(daily, "load_date", ["growth"])
    return out.select("load_date", F.round(F.ln("growth"), 6).alias("log_growth"))


@query(
    "position_pivot",
    """
WITH r AS (SELECT code, load_date, row_number() OVER (PARTITION BY load_date ORDER BY volume DESC, code) AS rk FROM d_bars)
SELECT load_date, max(CASE WHEN rk = 1 THEN code END) AS code1, max(CASE WHEN rk = 2 THEN code END) AS code2, max(CASE WHEN rk = 3 THEN code END) AS code3
FROM r WHERE rk <= 3 GROUP BY 1""",
)
def position_pivot(spark: SparkSession, sf: str) -> DataFrame:
    bars = panels.quotes(spark, sf).select("code", "load_date", "volume")
    ranked = windows.rank_per_date(bars, "load_date", [F.desc("volume"), F.col("code")], "rk")
    return joins.pivot_positions(ranked, "load_date", "rk", "code", 3, "code")


@query(
    "new_since_previous_day",
    f"""
SELECT c.code, p.code IS NULL AS is_new FROM d_bars c LEFT JOIN (SELECT code FROM d_bars WHERE load_date = (SELECT max(load_date) FROM d_bars WHERE load_date < {DAY})) p ON c.code = p.code
WHERE c.load_date = {DAY}""",
)
def new_since_previous_day(spark: SparkSession, sf: str) -> DataFrame:
    bars = panels.quotes_table(spark, sf).where(F.col("load_date") <= asof()).select("code", "load_date")
    return joins.flag_new(bars.where(F.col("load_date") == asof()), windows.second_latest(bars, "load_date"), "code").select("code", "is_new")


@query(
    "swing_pairs",
    """
WITH t AS (SELECT code, load_date, open <= close AS up, lag(open <= close) OVER w AS before, lead(open <= close) OVER w AS next FROM d_bars WINDOW w AS (PARTITION BY code ORDER BY load_date))
SELECT e.code, e.load_date AS entry_date, min(x.load_date) AS exit_date FROM t e JOIN t x ON e.code = x.code AND x.load_date > e.load_date
WHERE e.up AND NOT e.before AND x.up AND NOT x.next GROUP BY 1, 2""",
)
def swing_pairs(spark: SparkSession, sf: str) -> DataFrame:
    w = by()
    up = F.col("open") <= F.col("close")
    bars = panels.quotes(spark, sf).select("code", "load_date", up.alias("up"), F.lag(up).over(w).alias("before"), F.lead(up).over(w).alias("next"))
    return joins.pair_next(bars, "code", "load_date", F.col("up") & ~F.col("before"), F.col("up") & ~F.col("next"))


@query(
    "multiplication_lookup",
    """
SELECT p_brand, sum(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * l_quantity::BIGINT * round(l_discount * 100)::BIGINT)::BIGINT AS total
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def multiplication_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Signed products looked up in the mirrored product table instead of being computed."""
    n = 100
    side = F.col("l_quantity").cast("long")
    keys = table(spark, sf, "lineitem").select(
        "l_partkey",
        (F.lit(n) + F.when(F.col("l_returnflag") == "R", -side).otherwise(side)).alias("src"),
        F.round(F.col("l_discount") * 100).cast("long").alias("wgt"),
    )
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    counted = keys.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand", "src", "wgt").agg(F.count("*").alias("n"))
    return counted.join(joins.product_table(spark, n), ["src", "wgt"]).groupBy("p_brand").agg(F.sum(F.col("rst") * F.col("n")).alias("total"))


# --- aggregations -----------------------------------------------------------------------


@query(
    "grouped_measures",
    """
SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity)::BIGINT AS qty, round(avg(l_quantity), 6) AS avg_qty, min(l_extendedprice) AS low, max(l_extendedprice) AS high,
  round(stddev_samp(l_quantity), 6) AS dev FROM lineitem GROUP BY 1, 2""",
)
def grouped_measures(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"),
        F.sum("l_quantity").cast("long").alias("qty"),
        F.round(F.avg("l_quantity"), 6).alias("avg_qty"),
        F.min("l_extendedprice").alias("low"),
        F.max("l_extendedprice").alias("high"),
        F.round(F.stddev_samp("l_quantity"), 6).alias("dev"),
    )


@query(
    "direction_shares",
    """
SELECT code, count(*) AS total, round(avg(CASE WHEN close > open THEN 1.0 ELSE 0 END), 6) AS up, round(avg(CASE WHEN close > pclose THEN 1.0 ELSE 0 END), 6) AS gain FROM d_bars GROUP BY 1""",
)
def direction_shares(spark: SparkSession, sf: str) -> DataFrame:
    out = aggregates.share_where(panels.quotes(spark, sf), ["code"], {"up": F.col("close") > F.col("open"), "gain": F.col("close") > F.col("pclose")})
    return out.select("code", "total", F.round("up", 6).alias("up"), F.round("gain", 6).alias("gain"))


@query("busy_days", "SELECT load_date, count(*) AS n, round(avg(volume), 6) AS volume FROM d_bars GROUP BY 1 HAVING count(*) > 15 AND avg(volume) < 50")
def busy_days(spark: SparkSession, sf: str) -> DataFrame:
    days = panels.quotes(spark, sf).groupBy("load_date").agg(F.count("*").alias("n"), F.avg("volume").alias("volume"))
    return days.where("n > 15 AND volume < 50").withColumn("volume", F.round("volume", 6))


@query("active_codes", f"SELECT code FROM d_bars WHERE load_date <= {DAY} GROUP BY 1 HAVING max(load_date) = {DAY}")
def active_codes(spark: SparkSession, sf: str) -> DataFrame:
    return active_on(panels.quotes(spark, sf), ASOF)


@query(
    "list_regression",
    """
SELECT code, load_date, round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept FROM (
  SELECT a.code, a.load_date, b.close::DOUBLE AS y, (b.date_index - a.rn + 4)::DOUBLE AS x
  FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY load_date) AS rn FROM d_bars) a
  JOIN (SELECT code, close, row_number() OVER (PARTITION BY code ORDER BY load_date) AS date_index FROM d_bars) b ON a.code = b.code AND b.date_index BETWEEN a.rn - 4 AND a.rn
  WHERE a.rn >= 5) GROUP BY 1, 2""",
)
def list_regression(spark: SparkSession, sf: str) -> DataFrame:
    bars = windows.last_n_array(panels.quotes(spark, sf).select("code", "load_date", F.col("close").cast("double")), "code", "load_date", "close", 5, "ys")
    lists = bars.where(F.size("ys") == 5).withColumn("xs", F.array(*[F.lit(float(i)) for i in range(5)]))
    out = aggregates.list_slope(lists, ["code", "load_date"], "ys", "xs")
    return out.select("code", "load_date", F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"))


@query("true_median", "SELECT code, median(volume)::DOUBLE AS volume, median(close::DOUBLE) AS close FROM d_bars GROUP BY 1")
def true_median(spark: SparkSession, sf: str) -> DataFrame:
    return panels.quotes(spark, sf).groupBy("code").agg(F.median("volume").alias("volume"), F.median(F.col("close").cast("double")).alias("close"))


@query(
    "positional_median",
    """
SELECT code, load_date, list_sort(list(volume) OVER (PARTITION BY code ORDER BY load_date ROWS 9 PRECEDING))[5] AS m10,
  list_sort(list(volume) OVER (PARTITION BY code ORDER BY load_date ROWS 2 PRECEDING))[2] AS m03 FROM d_bars""",
)
def positional_median(spark: SparkSession, sf: str) -> DataFrame:
    bars = panels.quotes(spark, sf).select("code", "load_date", "volume")
    out = aggregates.positional_median(bars, "code", "load_date", "volume", 10, 5, "m10")
    return aggregates.positional_median(out, "code", "load_date", "volume", 3, 2, "m03").drop("volume")


@query("distinct_days", "SELECT DISTINCT l_shipdate::DATE AS day, l_returnflag FROM lineitem")
def distinct_days(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("day"), "l_returnflag").distinct()


@query("largest_key_count", "SELECT max(n) AS max_count FROM (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1)")
def largest_key_count(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.max_count_per_key(table(spark, sf, "lineitem"), "l_partkey")


@query(
    "category_rows_with_total",
    f"""
WITH s AS (SELECT category, b.load_date, sum(turnover) AS turnover, sum(volume)::BIGINT AS volume FROM d_bars b JOIN d_cat c ON b.code = c.code WHERE load_date = {DAY} GROUP BY 1, 2)
SELECT category, load_date, turnover::DOUBLE AS turnover, volume FROM s UNION ALL SELECT 'ALL', max(load_date), sum(turnover)::DOUBLE, sum(volume)::BIGINT FROM s""",
)
def category_rows_with_total(spark: SparkSession, sf: str) -> DataFrame:
    bars = panels.quotes_table(spark, sf).where(F.col("load_date") == asof())
    sums = bars.join(panels.categories(bars), "code").groupBy("category", "load_date").agg(F.sum("turnover").alias("turnover"), F.sum("volume").alias("volume"))
    return aggregates.with_total(sums, "category", "ALL", ["turnover", "volume"], "load_date")


@query(
    "weighted_prices",
    "SELECT load_date, (sum(close * volume)::DECIMAL(38,3))::DOUBLE AS value, round(sum(close * volume)::DOUBLE / sum(volume), 6) AS vwap FROM d_bars GROUP BY 1",
)
def weighted_prices(spark: SparkSession, sf: str) -> DataFrame:
    value = F.sum(F.col("close") * F.col("volume").cast("decimal(18,0)"))
    return panels.quotes(spark, sf).groupBy("load_date").agg(
        value.cast("decimal(38,3)").alias("value"), F.round(ratio(value, F.sum("volume")), 6).alias("vwap")
    )


@query(
    "ranked_groups",
    "SELECT code, year(load_date) AS year, sum(volume)::BIGINT AS value, row_number() OVER (PARTITION BY year(load_date) ORDER BY sum(volume) DESC, code) AS rank FROM d_bars GROUP BY 1, 2",
)
def ranked_groups(spark: SparkSession, sf: str) -> DataFrame:
    bars = panels.quotes(spark, sf).withColumn("year", F.year("load_date"))
    return aggregates.rank_groups(bars, ["code", "year"], ["year"], F.sum("volume"))


@query(
    "rank_capped_sums",
    """
WITH r AS (SELECT load_date, volume, row_number() OVER (PARTITION BY load_date ORDER BY market_cap DESC, code) AS rk FROM d_bars)
SELECT load_date, sum(CASE WHEN rk > 5 THEN 0 ELSE volume END)::BIGINT AS top5, sum(CASE WHEN rk > 10 THEN 0 ELSE volume END)::BIGINT AS top10 FROM r GROUP BY 1""",
)
def rank_capped_sums(spark: SparkSession, sf: str) -> DataFrame:
    bars = panels.quotes(spark, sf).select("code", "load_date", "volume", "market_cap")
    ranked = windows.rank_per_date(bars, "load_date", [F.desc("market_cap"), F.col("code")], "rk")
    return aggregates.capped_sum(ranked, ["load_date"], "rk", [5, 10], F.col("volume"), "top")


# --- windows ----------------------------------------------------------------------------


@query(
    "latest_line_per_part",
    """
SELECT l_partkey, l_shipdate, l_orderkey, l_linenumber, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) = 1""",
)
def latest_line_per_part(spark: SparkSession, sf: str) -> DataFrame:
    line = table(spark, sf, "lineitem").select("l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice")
    order = [F.desc(c) for c in ("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice")]
    return windows.latest_per_key(line, ["l_partkey"], order)


@query("daily_volume_rank", "SELECT code, load_date, row_number() OVER (PARTITION BY load_date ORDER BY volume DESC, code) AS rank FROM d_bars")
def daily_volume_rank(spark: SparkSession, sf: str) -> DataFrame:
    bars = panels.quotes(spark, sf).select("code", "load_date", "volume")
    return windows.rank_per_date(bars, "load_date", [F.desc("volume"), F.col("code")]).drop("volume")


@query("tied_ranks", "SELECT code, load_date, rank() OVER (PARTITION BY load_date ORDER BY volume DESC) AS rank FROM d_bars")
def tied_ranks(spark: SparkSession, sf: str) -> DataFrame:
    bars = panels.quotes(spark, sf).select("code", "load_date", "volume")
    return windows.rank_ties(bars, "load_date", F.desc("volume"), "rank").drop("volume")


@query("rank_over_all_orders", "SELECT o_orderkey, rank() OVER (ORDER BY round(o_totalprice / 100) DESC) AS rank FROM orders")
def rank_over_all_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", F.round(F.col("o_totalprice") / 100).cast("long").alias("hundreds"))
    return windows.rank_all(orders, "hundreds").select("o_orderkey", "rank")


@query(
    "lagged_and_leading_closes",
    """
SELECT code, load_date, lag(close, 1) OVER w::DOUBLE AS close_lag1, lag(close, 22) OVER w::DOUBLE AS close_lag22, lead(close, 1) OVER w::DOUBLE AS close_lead1, lead(close, 4) OVER w::DOUBLE AS close_lead4
FROM d_bars WINDOW w AS (PARTITION BY code ORDER BY load_date)""",
)
def lagged_and_leading_closes(spark: SparkSession, sf: str) -> DataFrame:
    bars = panels.quotes(spark, sf).select("code", "load_date", "close")
    return windows.leads(windows.lags(bars, "code", "load_date", "close", [1, 22]), "code", "load_date", "close", [1, 4]).drop("close")


@query(
    "lag_by_row_offset",
    """
SELECT code, load_date, back, lag(close, back::INT) OVER (PARTITION BY code ORDER BY load_date)::DOUBLE AS then_close FROM (
  SELECT *, 11 - row_number() OVER (PARTITION BY code ORDER BY load_date DESC) AS back FROM d_bars) WHERE back >= 0""",
)
def lag_by_row_offset(spark: SparkSession, sf: str) -> DataFrame:
    bars = panels.quotes(spark, sf).select("code", "load_date", "close")
    placed = windows.rank_offset(bars, "code", F.desc("load_date"), 11, "back").where("back >= 0")
    return windows.lag_by_column(placed, "code", "load_date", "close", "back", 11, "then_close").drop("close")


@query(
    "lag_by_any_offset",
    """
SELECT code, load_date, back, lag(close, back::INT) OVER (PARTITION BY code ORDER BY load_date)::DOUBLE AS then_close FROM (
  SELECT *, CASE WHEN (volume * 7) % 3 = 0 THEN (volume * 31) % 1500 ELSE volume % 40 END AS back FROM d_bars)""",
)
def lag_by_any_offset(spark: SparkSession, sf: str) -> DataFrame:
    far = F.when((F.col("volume") * 7) % 3 == 0, (F.col("volume") * 31) % 1500).otherwise(F.col("volume") % 40)
    bars = panels.quotes(spark, sf).select("code", "load_date", "close", far.alias("back"))
    return windows.lag_by_offset(bars, "code", "load_date", "close", "back", "then_close").drop("close")


fragment(
    "wk_span",
    "SELECT code, load_date AS lo, load_date + CASE WHEN v % 97 = 0 THEN 2000 WHEN v % 11 = 0 THEN 200 ELSE v % 25 END::INT AS hi FROM w_base WHERE v % 3 = 0",
)


@query(
    "bars_within_spans",
    """
SELECT s.code, s.lo, s.hi, count(*) AS n, sum(b.v)::BIGINT AS volume, max(b.h) / 100.0 AS top FROM wk_span s JOIN d_base b ON b.code = s.code AND b.load_date BETWEEN s.lo AND s.hi GROUP BY 1, 2, 3""",
)
def bars_within_spans(spark: SparkSession, sf: str) -> DataFrame:
    """Range join of two tables: weekly spans of 1 to 2001 days with the daily bars inside."""
    v = F.col("v")
    days = F.when(v % 97 == 0, 2000).when(v % 11 == 0, 200).otherwise(v % 25).cast("int")
    spans = panels.totals_table(spark, sf, "week").where(v % 3 == 0).select("code", F.col("load_date").alias("lo"), F.date_add("load_date", days).alias("hi"))
    bars = panels.totals_table(spark, sf).select("code", F.col("load_date").alias("day"), "v", "h")
    inside = joins.range_join(spans, bars, "code", "day", "lo", "hi")
    return inside.groupBy("code", "lo", "hi").agg(F.count("*").alias("n"), F.sum("v").alias("volume"), (F.max("h") / 100).cast("double").alias("top"))


@query(
    "rolling_frames",
    """
SELECT code, load_date, min(volume) OVER (PARTITION BY code ORDER BY load_date ROWS 13 PRECEDING) AS min14,
  round(avg(volume) OVER (PARTITION BY code ORDER BY load_date ROWS 19 PRECEDING), 6) AS avg, round(stddev_samp(volume) OVER (PARTITION BY code ORDER BY load_date ROWS 19 PRECEDING), 6) AS std,
  max(high) OVER (PARTITION BY code ORDER BY load_date ROWS 4 PRECEDING)::DOUBLE AS top, min(low) OVER (PARTITION BY code ORDER BY load_date ROWS 4 PRECEDING)::DOUBLE AS down FROM d_bars""",
)
def rolling_frames(spark: SparkSession, sf: str) -> DataFrame:
    bars = panels.quotes(spark, sf).select("code", "load_date", "volume", "high", "low")
    out = windows.rolling_min(bars, "code", "load_date", "volume", 14, "min14")
    out = windows.rolling_mean_std(out, "code", "load_date", "volume", 20)
    out = windows.rolling_high_low(out, "code", "load_date", "high", "low", 5)
    return out.select("code", "load_date", "min14", F.round("avg", 6).alias("avg"), F.round("std", 6).alias("std"), "top", "down")


@query(
    "volume_oscillator",
    """
SELECT code, load_date, round(s, 2) AS short_avg, round(l, 2) AS long_avg, round((s - l) / l * 100, 4) AS vos FROM (
  SELECT code, load_date, avg(volume) OVER (PARTITION BY code ORDER BY load_date DESC ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS s,
    avg(volume) OVER (PARTITION BY code ORDER BY load_date DESC ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS l FROM d_bars)""",
)
def volume_oscillator(spark: SparkSession, sf: str) -> DataFrame:
    out = windows.oscillator(panels.quotes(spark, sf).select("code", "load_date", "volume"), "code", "load_date", "volume")
    return out.select("code", "load_date", F.round("short_avg", 2).alias("short_avg"), F.round("long_avg", 2).alias("long_avg"), F.round("vos", 4).alias("vos"))


@query(
    "strict_rolling_mean",
    """
SELECT code, load_date, CASE WHEN count(pclose) OVER w = 5 THEN round(avg(pclose::DOUBLE) OVER w, 4) END AS mean5
FROM d_bars WINDOW w AS (PARTITION BY code ORDER BY load_date ROWS 4 PRECEDING)""",
)
def strict_rolling_mean(spark: SparkSession, sf: str) -> DataFrame:
    out = windows.rolling_mean_strict(panels.quotes(spark, sf).select("code", "load_date", "pclose"), "code", "load_date", "pclose", 5, "mean5")
    return out.select("code", "load_date", F.round("mean5", 4).alias("mean5"))


@query(
    "triangular_means",
    """
SELECT a.code, a.date_index, round((a.volume * 3 + b.volume * 2 + c.volume) / 6.0, 6) AS newest, round((a.volume + b.volume * 2 + c.volume * 3) / 6.0, 6) AS oldest
FROM d_ib a JOIN d_ib b ON a.code = b.code AND b.date_index = a.date_index - 1 JOIN d_ib c ON a.code = c.code AND c.date_index = a.date_index - 2""",
)
def triangular_means(spark: SparkSession, sf: str) -> DataFrame:
    bars = indexed(panels.quotes_table(spark, sf).select("code", "load_date", "volume"))
    out = windows.triangular_mean(bars, "code", "date_index", "volume", 3, "newest")
    out = windows.triangular_mean(out, "code", "date_index", "volume", 3, "oldest", newest_heaviest=False)
    return out.where("newest IS NOT NULL").select("code", "date_index", F.round("newest", 6).alias("newest"), F.round("oldest", 6).alias("oldest"))


@query(
    "filled_from_last_four",
    """
SELECT code, load_date, coalesce(x, lag(x, 1) OVER w, lag(x, 2) OVER w, lag(x, 3) OVER w, lag(x, 4) OVER w) AS filled FROM (
  SELECT code, load_date, CASE WHEN volume % 3 = 0 THEN volume END AS x FROM d_bars) WINDOW w AS (PARTITION BY code ORDER BY load_date)""",
)
def filled_from_last_four(spark: SparkSession, sf: str) -> DataFrame:
    bars = panels.quotes(spark, sf).select("code", "load_date", F.when(F.col("volume") % 3 == 0, F.col("volume")).alias("x"))
    return windows.fill_last(bars, "code", "load_date", "x", 4, "filled").drop("x")


@query(
    "renumbered_lists",
    """
SELECT code, load_date, val, row_number() OVER (PARTITION BY code, load_date ORDER BY val) AS ordinal FROM (
  SELECT code, load_date, unnest(list(volume) OVER (PARTITION BY code ORDER BY load_date ROWS 2 PRECEDING)) AS val FROM d_bars)""",
)
def renumbered_lists(spark: SparkSession, sf: str) -> DataFrame:
    bars = panels.quotes(spark, sf).select("code", "load_date", "volume")
    lists = windows.last_n_array(bars, "code", "load_date", "volume", 3, "vals")
    return windows.renumber(lists, ["code", "load_date"], "vals")


# --- top-k, sets, storage ---------------------------------------------------------------


@query("top_four_per_day", "SELECT code, load_date, row_number() OVER (PARTITION BY load_date ORDER BY turnover DESC, code) AS rnum FROM d_bars QUALIFY rnum <= 4")
def top_four_per_day(spark: SparkSession, sf: str) -> DataFrame:
    bars = panels.quotes(spark, sf).select("code", "load_date", "turnover")
    return windows.top_k_per_group(bars, ["load_date"], [F.desc("turnover"), F.col("code")], 4, "rnum").drop("turnover")


@query("newest_twenty_days", "SELECT code, load_date, volume FROM d_bars WHERE load_date IN (SELECT load_date FROM d_idx WHERE rnum <= 20)")
def newest_twenty_days(spark: SparkSession, sf: str) -> DataFrame:
    return windows.newest_dates(panels.quotes_table(spark, sf).select("code", "load_date", "volume"), "load_date", 20)


@query(
    "report_page",
    "SELECT code, load_date, volume FROM d_bars ORDER BY volume DESC, load_date DESC, code LIMIT 20 OFFSET 10",
)
def report_page(spark: SparkSession, sf: str) -> DataFrame:
    bars = panels.quotes(spark, sf).select("code", "load_date", "volume")
    return bars.orderBy(F.desc("volume"), F.desc("load_date"), "code").limit(30).offset(10)


@query(
    "set_unions",
    """
SELECT 'distinct' AS kind, count(*) AS n FROM (SELECT l_partkey AS k FROM lineitem WHERE l_quantity > 45 UNION SELECT p_partkey FROM part WHERE p_size < 5)
UNION ALL SELECT 'all', count(*) FROM (SELECT l_partkey AS k FROM lineitem WHERE l_quantity > 45 UNION ALL SELECT p_partkey FROM part WHERE p_size < 5)""",
)
def set_unions(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "lineitem").where(F.col("l_quantity") > 45).select(F.col("l_partkey").alias("k"))
    b = table(spark, sf, "part").where(F.col("p_size") < 5).select(F.col("p_partkey").alias("k"))
    keys = tables.union_keys("k", a, b).agg(F.lit("distinct").alias("kind"), F.count("*").alias("n"))
    return keys.unionByName(a.unionByName(b).agg(F.lit("all").alias("kind"), F.count("*").alias("n")))


@query(
    "overlay_of_provisional_day",
    f"""
SELECT code, load_date, close::DOUBLE AS close FROM d_bars WHERE load_date < {DAY}
UNION ALL SELECT code, load_date, open::DOUBLE FROM d_bars WHERE load_date = {DAY}""",
)
def overlay_of_provisional_day(spark: SparkSession, sf: str) -> DataFrame:
    bars = panels.quotes_table(spark, sf)
    history = bars.select("code", "load_date", "close")
    return tables.overlay(history, bars.select("code", "load_date", F.col("open").alias("close")), "load_date", asof())


@query("trading_calendar", "SELECT load_date, rnum, dayofweek(load_date) AS dow, row_number() OVER (ORDER BY load_date) AS date_index FROM d_idx")
def trading_calendar(spark: SparkSession, sf: str) -> DataFrame:
    bars = panels.quotes(spark, sf).select("code", "load_date")
    days = calendar(bars)
    dow = (F.dayofweek("load_date") - 1).alias("dow")
    return days.select("load_date", "rnum", dow, "date_index")


@query(
    "insert_if_absent",
    """
WITH old AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
new AS (SELECT o_custkey, o_orderdate, min(o_orderkey) AS o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1997-06-01' GROUP BY 1, 2)
SELECT n.* FROM new n WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.o_custkey = n.o_custkey AND old.o_orderdate = n.o_orderdate)""",
)
def insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    old = o.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    new = o.where(F.col("o_orderdate") >= F.lit("1997-06-01").cast("timestamp_ntz"))
    return tables.absent_rows(old, new, ["o_custkey", "o_orderdate"], [F.col("o_orderkey")])


@query(
    "pruned_to_thirty_days",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate::DATE IN (SELECT DISTINCT o_orderdate::DATE AS d FROM orders ORDER BY d DESC LIMIT 30)",
)
def pruned_to_thirty_days(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", F.col("o_orderdate").cast("date").alias("day"))
    return tables.keep_last_n_dates(o, "day").drop("day")


@query("deleted_by_predicate", "SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT (o_orderstatus = 'F' AND o_totalprice < 100000)")
def deleted_by_predicate(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return tables.delete_where(o, (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") < 100000)).select("o_orderkey", "o_orderstatus")


@query(
    "filled_rows_per_day",
    "SELECT ts::DATE AS day, count(*) AS rows, sum(CASE WHEN event_type <> '' THEN 1 ELSE 0 END)::BIGINT AS event_type_filled, sum(CASE WHEN props <> '' THEN 1 ELSE 0 END)::BIGINT AS props_filled FROM events GROUP BY 1",
)
def filled_rows_per_day(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.rows_per_day(table(spark, sf, "events"), "ts", ["event_type", "props"])


@query(
    "flag_counts",
    "SELECT l_shipdate::DATE AS day, sum(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END)::BIGINT AS n FROM lineitem GROUP BY l_shipdate::DATE",
)
def flag_counts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy(F.col("l_shipdate").cast("date").alias("day")).agg(F.sum(flag(F.col("l_discount") > 0.05)).alias("n"))


# --- scalar functions -------------------------------------------------------------------


@query(
    "text_functions",
    """
SELECT p_partkey, concat(p_brand, NULL, '/', p_type) AS joined, substring(p_name, 2, 3) AS part, strpos(p_name, 'r') AS at, length(p_name) AS n, trim('  ' || p_type || ' ') AS trimmed, replace(p_name, 'g', 'G') AS replaced, chr(65 + p_size % 26) AS letter FROM part""",
)
def text_functions(spark: SparkSession, sf: str) -> DataFrame:
    name = F.col("p_name")
    return table(spark, sf, "part").select(
        "p_partkey",
        joined(F.col("p_brand"), F.lit(None), "/", F.col("p_type")).alias("joined"),
        F.substring(name, 2, 3).alias("part"),
        F.locate("r", name).alias("at"),
        F.length(name).alias("n"),
        F.trim(F.concat(F.lit("  "), F.col("p_type"), F.lit(" "))).alias("trimmed"),
        F.replace(name, F.lit("g"), F.lit("G")).alias("replaced"),
        F.char(F.lit(65) + F.col("p_size") % 26).alias("letter"),
    )


@query(
    "date_functions",
    """
SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, dayofweek(o_orderdate) AS dow, isodow(o_orderdate) AS isodow, date_trunc('month', o_orderdate)::DATE AS month_start, o_orderdate::DATE - 28 AS earlier,
  (o_orderdate - INTERVAL 6 MONTH)::DATE AS half_year, o_orderdate + INTERVAL 11 HOUR AS market_time, strftime(o_orderdate, '%d/%m/%Y') AS day_text FROM orders""",
)
def date_functions(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("o_orderdate")
    day = t.cast("date")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.year(t).alias("y"),
        F.month(t).alias("m"),
        (F.dayofweek(t) - 1).alias("dow"),
        (F.weekday(t) + 1).alias("isodow"),
        F.trunc(day, "month").alias("month_start"),
        F.date_sub(day, 28).alias("earlier"),
        F.add_months(day, -6).alias("half_year"),
        (t + F.expr("INTERVAL '11' HOUR")).alias("market_time"),
        F.date_format(t, "dd/MM/yyyy").alias("day_text"),
    )


@query(
    "math_functions",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, greatest(l_discount, NULL, l_tax) AS hi, least(l_discount, NULL, l_tax) AS lo, round(log10(l_extendedprice), 6) AS lg, round(pow(1 + l_tax, 5), 6) AS grown,
  trunc(l_extendedprice) AS whole, ceil(l_extendedprice / 1000) AS thousands, l_quantity::BIGINT % 7 AS rest, l_quantity::BIGINT // 7 AS sevens, abs(l_discount - l_tax) AS gap, round(1 / (1 + exp(-l_discount)), 6) AS squashed FROM lineitem""",
)
def math_functions(spark: SparkSession, sf: str) -> DataFrame:
    price, qty = F.col("l_extendedprice"), F.col("l_quantity").cast("long")
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.greatest(F.col("l_discount"), F.lit(None), F.col("l_tax")).alias("hi"),
        F.least(F.col("l_discount"), F.lit(None), F.col("l_tax")).alias("lo"),
        F.round(F.log10(price), 6).alias("lg"),
        F.round(F.pow(F.lit(1) + F.col("l_tax"), F.lit(5)), 6).alias("grown"),
        F.floor(price).cast("double").alias("whole"),
        F.ceil(price / 1000).cast("double").alias("thousands"),
        (qty % 7).alias("rest"),
        F.expr("CAST(l_quantity AS BIGINT) div 7").alias("sevens"),
        F.abs(F.col("l_discount") - F.col("l_tax")).alias("gap"),
        F.round(squash(F.col("l_discount")), 6).alias("squashed"),
    )
