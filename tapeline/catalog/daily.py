"""Daily indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.catalog import duck  # noqa: F401
from tapeline.catalog.duck import ASOF, DAY
from tapeline.catalog.registry import query
from tapeline.operators.folds import parabolic_sar, parabolic_sars, smoothed_candles
from tapeline.plans import daily
from tapeline.sources.panels import quotes, quotes_table


def _classes(pairs: tuple) -> str:
    lines = [
        f"WHEN mv > {v} AND mc > {p} OR mv > {v2} AND mv * mc > {pv} THEN {i}" for i, (v, p, v2, pv) in enumerate(pairs, 1)
    ]
    return "CASE " + " ".join(lines) + " ELSE 4 END"


def _actionable(where: str, cuts: tuple, style: str, final: str = "") -> str:
    a, b, c = cuts
    return f"""
SELECT code, load_date, CASE WHEN rk <= {a} THEN 1 WHEN rk <= {b} THEN 2 WHEN rk <= {c} THEN 3 ELSE 4 END AS turnover,
  {_classes(daily.POPULARITY[style])} AS popularity
FROM (SELECT *, row_number() OVER (PARTITION BY load_date ORDER BY mv * mc DESC, code) AS rk FROM (
  SELECT code, load_date,
    min(volume) OVER (PARTITION BY code ORDER BY load_date ROWS 13 PRECEDING) AS mv,
    min(close) OVER (PARTITION BY code ORDER BY load_date ROWS 13 PRECEDING) AS mc
  FROM d_bars {where}) {final})"""


_LAST4 = f"WHERE load_date > {DAY} - INTERVAL 4 MONTH AND load_date <= {DAY}"


@query("actionable_list", _actionable("", (5, 10, 15), "wide"))
def actionable_list(spark: SparkSession, sf: str) -> DataFrame:
    """Liquidity classes of every code on every date."""
    return daily.actionable_list(quotes(spark, sf), None, turnover_cuts=(5, 10, 15))


@query("actionable_list_asof", _actionable(_LAST4, (100, 200, 500), "wide", f"WHERE load_date = {DAY}"))
def actionable_list_asof(spark: SparkSession, sf: str) -> DataFrame:
    return daily.actionable_list(quotes(spark, sf), ASOF)


@query(
    "actionable_list_six_months",
    _actionable(_LAST4.replace("4 MONTH", "6 MONTH"), (100, 200, 300), "narrow", f"WHERE load_date = {DAY}"),
)
def actionable_list_six_months(spark: SparkSession, sf: str) -> DataFrame:
    return daily.actionable_list(quotes(spark, sf), ASOF, months=6, turnover_cuts=(100, 200, 300), style="narrow")


_EMA = "SELECT code, load_date, price::DOUBLE AS price, ema15::DOUBLE AS ema15, ema40::DOUBLE AS ema40 FROM "


@query("moving_averages", _EMA + "d_ema")
def moving_averages(spark: SparkSession, sf: str) -> DataFrame:
    return daily.moving_averages(quotes(spark, sf))


@query("weighted_ma_asof", _EMA + f"d_ema WHERE load_date = {DAY}")
def weighted_ma_asof(spark: SparkSession, sf: str) -> DataFrame:
    return daily.weighted_ma_on(quotes(spark, sf), ASOF)


@query("weighted_ma_rolling", _EMA + "d_ema QUALIFY row_number() OVER (PARTITION BY code ORDER BY load_date DESC) <= 11")
def weighted_ma_rolling(spark: SparkSession, sf: str) -> DataFrame:
    return daily.weighted_ma_rolling(quotes(spark, sf))


@query("smoothed_candles", "SELECT code, load_date, open::DOUBLE AS open, high::DOUBLE AS high, low::DOUBLE AS low, close::DOUBLE AS close FROM d_ha")
def candles(spark: SparkSession, sf: str) -> DataFrame:
    return smoothed_candles(quotes(spark, sf))


@query("moving_averages_on_candles", _EMA + "h_ema")
def moving_averages_on_candles(spark: SparkSession, sf: str) -> DataFrame:
    return daily.moving_averages(smoothed_candles(quotes(spark, sf)))


@query("macd_on_candles", "SELECT code, load_date, diff::DOUBLE AS diff, dea::DOUBLE AS dea FROM h_macd")
def macd_on_candles(spark: SparkSession, sf: str) -> DataFrame:
    return daily.macd(daily.moving_averages(smoothed_candles(quotes(spark, sf))))


@query(
    "parabolic_sar",
    "SELECT code, load_date, extreme::DOUBLE AS extreme, ud_trend, af::DOUBLE AS af, sar::DOUBLE AS sar, n_sar::DOUBLE AS n_sar FROM d_sar",
)
def sar(spark: SparkSession, sf: str) -> DataFrame:
    return parabolic_sar(quotes(spark, sf))


@query(
    "parabolic_sar_two_settings",
    "SELECT code, load_date, ud_trend2, n_sar2::DOUBLE AS n_sar2, ud_trend3, n_sar3::DOUBLE AS n_sar3 FROM d_sar23",
)
def sar_two(spark: SparkSession, sf: str) -> DataFrame:
    both = parabolic_sars(quotes(spark, sf), {"2": (0.02, 0.2), "3": (0.03, 0.3)})
    return both.select("code", "load_date", "ud_trend2", "n_sar2", "ud_trend3", "n_sar3")


@query(
    "match_point",
    """
SELECT code, load_date, round(total / (1e9 - (SELECT weight FROM w40 WHERE orders = 0)) / 1000, 4) AS match_point FROM (
  SELECT a.code, a.load_date, sum((b.close * 1000)::BIGINT * w.weight)::BIGINT AS total
  FROM (SELECT code, load_date, row_number() OVER (PARTITION BY code ORDER BY load_date) AS rn FROM d_bars) a
  JOIN (SELECT code, close, row_number() OVER (PARTITION BY code ORDER BY load_date) AS rn FROM d_bars) b
    ON a.code = b.code AND b.rn BETWEEN a.rn - 38 AND a.rn
  JOIN w40 w ON w.orders = a.rn - b.rn + 1
  GROUP BY a.code, a.load_date HAVING count(*) = 39)""",
)
def match_point(spark: SparkSession, sf: str) -> DataFrame:
    return daily.match_point(quotes(spark, sf))


duck.fragment("d_dist", "SELECT code, load_date, round(price::DOUBLE / ema40::DOUBLE, 6)::DECIMAL(14,6) AS dist FROM d_ema")


@query("price_area", f"SELECT code, load_date, area::DOUBLE AS area FROM ({duck.ma_sql('d_dist', 'dist', 6, 'w15', 15, 'area')})")
def price_area(spark: SparkSession, sf: str) -> DataFrame:
    return daily.price_area(daily.moving_averages(quotes(spark, sf)))


def streak_sql(source: str, name: str, a: str, b: str) -> str:
    """Streak recursion, one step per row, written as the state machine itself."""
    return f"""
SELECT code, load_date, rn, CASE WHEN {a} >= {b} THEN 1 ELSE -1 END AS dir, CASE WHEN {a} >= {b} THEN 1 ELSE -1 END AS trend
FROM {source} WHERE rn = 1
UNION ALL
SELECT q.code, q.load_date, q.rn, CASE WHEN q.{a} >= q.{b} THEN 1 ELSE -1 END,
  CASE WHEN (q.{a} >= q.{b}) = (p.dir = 1) THEN p.trend + 1 ELSE 1 END
FROM {name} p JOIN {source} q ON q.code = p.code AND q.rn = p.rn + 1"""


duck.fragment("e_seq", "SELECT *, row_number() OVER (PARTITION BY code ORDER BY load_date) AS rn FROM d_ema")
for _n, _a, _b in (("e_s1", "price", "ema15"), ("e_s2", "price", "ema40"), ("e_s3", "ema15", "ema40")):
    duck.fragment(_n, streak_sql("e_seq", _n, _a, _b))
duck.fragment(
    "d_trend",
    """
SELECT x.code, x.load_date, x.dir AS prc_e10_direction, x.trend AS prc_e10_trend, y.dir AS prc_e25_direction, y.trend AS prc_e25_trend,
  z.dir AS e10_e25_direction, z.trend AS e10_e25_trend
FROM e_s1 x JOIN e_s2 y ON x.code = y.code AND x.rn = y.rn JOIN e_s3 z ON x.code = z.code AND x.rn = z.rn""",
)


@query("ema_trend", "SELECT * FROM d_trend")
def ema_trend(spark: SparkSession, sf: str) -> DataFrame:
    return daily.ema_trend(daily.moving_averages(quotes(spark, sf)))


@query(
    "ema_cross_period",
    """
WITH c AS (SELECT code, load_date, ema15, ema40, lag(ema15) OVER w AS p15, lag(ema40) OVER w AS p40 FROM d_ema WINDOW w AS (PARTITION BY code ORDER BY load_date)),
u AS (SELECT code, max(load_date) AS up FROM c WHERE ema15 > ema40 AND p15 <= p40 GROUP BY 1),
n AS (SELECT code, max(load_date) AS down FROM c WHERE ema15 < ema40 AND p15 >= p40 GROUP BY 1)
SELECT u.code, (SELECT max(load_date) FROM d_idx) AS load_date, CASE WHEN up > down THEN i.rnum ELSE 0 END AS trend_period
FROM u JOIN n ON u.code = n.code JOIN d_idx i ON i.load_date = u.up""",
)
def ema_cross_period(spark: SparkSession, sf: str) -> DataFrame:
    bars = quotes_table(spark, sf)
    return daily.ema_cross_period(daily.moving_averages(bars), daily.calendar(bars))


duck.fragment(
    "d_mr0",
    f"""
SELECT code, load_date,
  round(greatest(abs(1 - high::DOUBLE / pclose), abs(1 - low::DOUBLE / pclose), abs(1 - high::DOUBLE / close), abs(1 - low::DOUBLE / close)) * 100, 3) AS rng,
  round(abs(1 - close::DOUBLE / pclose) * 100, 3) AS diff
FROM d_bars WHERE load_date <= {DAY} QUALIFY row_number() OVER (PARTITION BY code ORDER BY load_date DESC) <= 60""",
)
duck.fragment(
    "d_mr",
    f"""
WITH k AS (SELECT code FROM d_mr0 GROUP BY code HAVING max(load_date) = {DAY}),
r AS (SELECT code, avg(rng) AS avg_range, stddev_samp(rng) AS std_range, count(*) AS n FROM (
  SELECT *, row_number() OVER (PARTITION BY code ORDER BY rng NULLS LAST, load_date) AS rk FROM d_mr0) WHERE rk BETWEEN 7 AND 54 GROUP BY 1),
f AS (SELECT code, avg(diff) AS avg_diff, stddev_samp(diff) AS std_diff, count(*) AS n FROM (
  SELECT *, row_number() OVER (PARTITION BY code ORDER BY diff NULLS LAST, load_date) AS rk FROM d_mr0) WHERE rk BETWEEN 7 AND 54 GROUP BY 1)
SELECT k.code, {DAY} AS load_date, avg_range, std_range, avg_diff, std_diff FROM k JOIN r ON k.code = r.code JOIN f ON k.code = f.code WHERE r.n = 48 AND f.n = 48""",
)


@query(
    "moving_range",
    "SELECT code, load_date, round(avg_range, 6) AS avg_range, round(std_range, 6) AS std_range, round(avg_diff, 6) AS avg_diff, round(std_diff, 6) AS std_diff FROM d_mr",
)
def moving_range(spark: SparkSession, sf: str) -> DataFrame:
    out = daily.moving_range(quotes(spark, sf), ASOF)
    return out.select("code", "load_date", *[F.round(c, 6).alias(c) for c in out.columns[2:]])


duck.fragment(
    "d_vol",
    f"""
WITH t AS (SELECT code, load_date, volume FROM d_bars WHERE load_date <= {DAY} QUALIFY row_number() OVER (PARTITION BY code ORDER BY load_date DESC) <= 60),
s AS (SELECT code, round(avg(volume))::BIGINT AS avg_volume, round(stddev_samp(volume))::BIGINT AS std_volume FROM (
  SELECT *, row_number() OVER (PARTITION BY code ORDER BY volume) AS rk FROM t) WHERE rk > 6 AND rk < 55 GROUP BY 1)
SELECT t.code, t.load_date, t.volume, avg_volume, std_volume, avg_volume + std_volume * 3 AS benchmark,
  CASE WHEN volume > avg_volume + std_volume * 3 THEN 1 ELSE 0 END AS flag FROM t JOIN s ON t.code = s.code WHERE t.load_date = {DAY}""",
)


@query("volume_bands", "SELECT * FROM d_vol")
def volume_bands(spark: SparkSession, sf: str) -> DataFrame:
    return daily.volume_bands(quotes_table(spark, sf), ASOF)


@query(
    "trading_days",
    f"""
WITH x AS (SELECT code, max(load_date) AS m, count(*) AS s, count(*) FILTER (WHERE load_date > {DAY} - 84) AS q, count(*) FILTER (WHERE load_date > {DAY} - 28) AS n
  FROM d_bars WHERE load_date <= {DAY} AND load_date > {DAY} - 168 GROUP BY 1)
SELECT max(m) AS load_date, max(s) AS semester_trading_days, max(q) AS quarterly_trading_days, max(n) AS monthly_trading_days FROM x""",
)
def trading_days(spark: SparkSession, sf: str) -> DataFrame:
    return daily.trading_days(quotes(spark, sf), ASOF)
