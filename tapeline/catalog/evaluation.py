"""Rankings, votes, back-tests and the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.catalog.features import panel, rank, score_sql
from tapeline.catalog.registry import fragment, query
from tapeline.operators.joins import orphans, star_join
from tapeline.plans import evaluation, loading
from tapeline.plans.daily import calendar
from tapeline.sources import panels
from tapeline.sources.files import table
from tapeline.staging import stage

_TARGET = "CASE WHEN hi <> lo THEN (mid - lo)::DOUBLE / (hi - lo)::DOUBLE ELSE 0 END"
fragment(
    "i_full",
    f"""
SELECT *, row_number() OVER (PARTITION BY load_date ORDER BY 1.0::DOUBLE + pe_rank + recommend * 0.5 DESC, code) AS ranking FROM (
  SELECT code, load_date, market_price, average_volume, greatest(1.0::DOUBLE - place / 100.0::DOUBLE, 0.0) AS pe_rank, coalesce(round({_TARGET}, 6), 0) AS target_ratio,
    CASE WHEN analysts >= 3 THEN (5 - rating)::DOUBLE / 5 ELSE 0 END AS recommend FROM (
    SELECT *, row_number() OVER (PARTITION BY load_date ORDER BY pe DESC, code) AS place FROM (
      SELECT code, load_date, coalesce(nullif(market_price, ''), current_price)::DECIMAL(12,3) AS market_price, average_volume::BIGINT AS average_volume, number_of_analyst::INT AS analysts, recommendation_mean::DECIMAL(5,3) AS rating,
        CASE WHEN forward_pe IN ('', 'Infinity') THEN NULL ELSE forward_pe::DECIMAL(8,1) END AS pe, nullif(target_low_price, '')::DECIMAL(12,3) AS lo, target_high_price::DECIMAL(12,3) AS hi, target_median_price::DECIMAL(12,3) AS mid
      FROM l_finance QUALIFY row_number() OVER (PARTITION BY code, load_date ORDER BY hour DESC) = 1) WHERE pe IS NOT NULL AND average_volume > 50000))""",
)
fragment(
    "i_good",
    "SELECT * REPLACE (row_number() OVER (PARTITION BY load_date ORDER BY 1.0::DOUBLE + pe_rank + recommend * 0.5 DESC, code) AS ranking) FROM i_full WHERE target_ratio > 0.5",
)
_INST = "SELECT code, load_date, market_price::DOUBLE AS market_price, average_volume, round(pe_rank, 6) AS pe_rank, target_ratio, round(recommend, 6) AS recommend, ranking FROM "


def _instances(spark: SparkSession, sf: str, min_target: float | None = 0.5) -> DataFrame:
    return evaluation.instances(panels.web_finance(panels.daily_totals(spark, sf)), min_target=min_target)


def _six(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


@query("instances", _INST + "i_good")
def instances(spark: SparkSession, sf: str) -> DataFrame:
    return _six(_instances(spark, sf), "pe_rank", "recommend")


@query("instances_full", _INST + "i_full")
def instances_full(spark: SparkSession, sf: str) -> DataFrame:
    return _six(_instances(spark, sf, None), "pe_rank", "recommend")


fragment("i_day", "SELECT load_date, row_number() OVER (ORDER BY load_date DESC) AS rnum, row_number() OVER (ORDER BY load_date) AS ix FROM (SELECT DISTINCT load_date FROM i_full)")


def _staged(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    full = stage(_instances(spark, sf, None))
    good = _instances(spark, sf)
    return stage(good), full, calendar(full)


@query(
    "nth_newest_lists",
    " UNION ALL ".join(f"SELECT {k} AS back, code, ranking FROM i_full WHERE load_date = (SELECT load_date FROM i_day WHERE rnum = {k + 1})" for k in range(5)),
)
def nth_newest_lists(spark: SparkSession, sf: str) -> DataFrame:
    full = stage(_instances(spark, sf, None))
    days = calendar(full)
    return evaluation.newest_lists(full, days, 5)


@query(
    "ranking_table",
    """
SELECT a.code, a.ranking AS m0, b.ranking AS m1, c.ranking AS m2, d.ranking AS m3, e.ranking AS m4 FROM (SELECT i.*, n.rnum FROM i_full i JOIN i_day n ON i.load_date = n.load_date) a
LEFT JOIN (SELECT i.*, n.rnum FROM i_full i JOIN i_day n ON i.load_date = n.load_date WHERE rnum = 2) b ON a.code = b.code LEFT JOIN (SELECT i.*, n.rnum FROM i_full i JOIN i_day n ON i.load_date = n.load_date WHERE rnum = 3) c ON a.code = c.code
LEFT JOIN (SELECT i.*, n.rnum FROM i_full i JOIN i_day n ON i.load_date = n.load_date WHERE rnum = 4) d ON a.code = d.code LEFT JOIN (SELECT i.*, n.rnum FROM i_full i JOIN i_day n ON i.load_date = n.load_date WHERE rnum = 5) e ON a.code = e.code
WHERE a.rnum = 1 AND a.ranking < 11""",
)
def ranking_table(spark: SparkSession, sf: str) -> DataFrame:
    full = stage(_instances(spark, sf, None))
    return evaluation.ranking_table(full, calendar(full))


@query("recent_list", "SELECT code, load_date, ranking FROM i_full WHERE ranking < 6 AND load_date IN (SELECT load_date FROM i_day WHERE rnum <= 10)")
def recent_list(spark: SparkSession, sf: str) -> DataFrame:
    full = stage(_instances(spark, sf, None))
    return evaluation.recent_list(full, calendar(full))


# --- rating list and votes --------------------------------------------------------------

fragment(
    "c_day",
    """
SELECT load_date, dayofweek(load_date) AS dow, row_number() OVER (ORDER BY load_date DESC) AS rnum FROM (SELECT load_date FROM t_consensus UNION SELECT load_date FROM t_finance UNION SELECT load_date FROM t_short)""",
)


def current_sql(where: str) -> str:
    return f"""
SELECT load_date, dow, rnum, analysis, weight, short_position, code, open, close, volume, target_ratio, pe_rank, (total + 5) // 10 / 1000.0 AS total_weight, rank() OVER (PARTITION BY load_date ORDER BY total) AS total_rank FROM (
  SELECT i.load_date, i.dow, i.rnum, c.analysis, c.weight, s.short_position, f.code, f.open, f.close, f.volume, f.target_ratio, f.pe_rank, round(c.weight * 1000)::BIGINT * 5 + f.pe_rank * 100 AS total
  FROM c_day i JOIN (SELECT *, rank() OVER (PARTITION BY load_date ORDER BY forward_pe DESC) AS pe_rank FROM t_finance {where}) f ON i.load_date = f.load_date
  JOIN t_short s ON f.code = s.code AND f.load_date = s.load_date JOIN t_consensus c ON f.code = c.code AND f.load_date = c.load_date)"""


fragment("c_cur", current_sql("WHERE target_ratio > 0.5"))
fragment("c_full", current_sql(""))
_CUR = "SELECT load_date, dow, rnum, analysis, weight, short_position, code, open::DOUBLE AS open, close::DOUBLE AS close, volume, target_ratio, pe_rank, total_weight, total_rank FROM "


def _feeds(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    totals = panels.totals_table(spark, sf)
    return (
        stage(loading.finance_update(panels.web_finance(totals))),
        stage(loading.consensus_update(panels.web_consensus(totals))),
        stage(loading.shorts_update(panels.web_short(totals))),
    )


@query("current_list", _CUR + "c_cur")
def current_list(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.current_list(*_feeds(spark, sf), newest=None)


@query("current_list_full", _CUR + "c_full")
def current_list_full(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.current_list(*_feeds(spark, sf), newest=None, min_target=None)


# Votes need five rated codes on a day, so they run on a list that every code is on.
fragment(
    "p_list",
    """
SELECT code, load_date, i.rnum, rank() OVER (PARTITION BY load_date ORDER BY v DESC, code) AS total_rank FROM d_base JOIN d_idx i USING (load_date)""",
)


def votes_sql(places: int = 5, days: int = 5) -> str:
    return f"""
WITH p AS (SELECT *, {", ".join(f"lead(code, {i}) OVER (PARTITION BY total_rank ORDER BY rnum) AS c{i}" for i in range(1, days))} FROM p_list WHERE total_rank <= {places}),
v AS (SELECT load_date, rnum, code AS c, 11 - total_rank AS w, total_rank FROM p UNION ALL {" UNION ALL ".join(f"SELECT load_date, rnum, c{i}, {11 - i} - total_rank, total_rank FROM p" for i in range(1, days))})
SELECT load_date, code, rnum, w / 10.0::DOUBLE AS weight, row_number() OVER (PARTITION BY load_date ORDER BY w DESC, code) AS wnum FROM (
  SELECT load_date, rnum, c AS code, sum(w) AS w FROM v WHERE c IS NOT NULL AND rnum IN (SELECT rnum FROM p GROUP BY 1 HAVING count(*) = {places}) GROUP BY 1, 2, 3)"""


fragment("p_vote", votes_sql())


def _listed(spark: SparkSession, sf: str) -> DataFrame:
    bars = stage(panels.quotes(spark, sf).select("code", "load_date", "volume"))
    from pyspark.sql import Window as W

    place = F.row_number().over(W.partitionBy("load_date").orderBy(F.desc("volume"), "code"))
    return bars.join(calendar(bars).select("load_date", "rnum"), "load_date").withColumn("total_rank", place)


@query("decay_votes", "SELECT * FROM p_vote")
def decay_votes(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.decay_votes(_listed(spark, sf), newest=None)


fragment(
    "p_hold",
    "SELECT wnum AS rank, rnum, code AS code0, "
    + ", ".join(f"lead(code, {i}) OVER (PARTITION BY wnum ORDER BY load_date DESC) AS code{i}" for i in range(1, 5))
    + " FROM p_vote WHERE wnum <= 5",
)
fragment("p_now", "SELECT min(rnum) AS r FROM p_vote")


@query("earlier_holders", "SELECT rank, code0, code1, code2, code3, code4 FROM p_hold WHERE rnum = (SELECT r FROM p_now)")
def earlier_holders(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.earlier_holders(_rebased(evaluation.decay_votes(_listed(spark, sf), newest=None)))


def _rebased(votes: DataFrame) -> DataFrame:
    """Number the days with votes from the newest one."""
    votes = stage(votes)
    return votes.withColumn("rnum", F.col("rnum") - votes.agg(F.min("rnum")).scalar() + 1)


@query(
    "normalised_prices",
    """
WITH b AS (SELECT code, wnum FROM p_vote WHERE rnum = (SELECT r FROM p_now) AND wnum <= 5),
r AS (SELECT q.code, b.wnum, q.load_date, q.close, 11 - row_number() OVER (PARTITION BY q.code ORDER BY q.load_date DESC) AS k FROM d_bars q JOIN b ON q.code = b.code),
x AS (SELECT load_date, wnum, round(close::DOUBLE / lag(close, k::INT) OVER (PARTITION BY code ORDER BY load_date)::DOUBLE, 3) AS ratio FROM r WHERE k >= 0)
SELECT load_date, max(CASE WHEN wnum = 1 THEN ratio END) AS ratio1, max(CASE WHEN wnum = 2 THEN ratio END) AS ratio2, max(CASE WHEN wnum = 3 THEN ratio END) AS ratio3, max(CASE WHEN wnum = 4 THEN ratio END) AS ratio4,
  max(CASE WHEN wnum = 5 THEN ratio END) AS ratio5 FROM x GROUP BY 1 HAVING count(DISTINCT wnum) = 5""",
)
def normalised_prices(spark: SparkSession, sf: str) -> DataFrame:
    votes = _rebased(evaluation.decay_votes(_listed(spark, sf), newest=None))
    return evaluation.normalised_prices(panels.quotes(spark, sf).select("code", "load_date", "close"), votes)


_POINTS = {5: (400_000.0, 100_000.0), 10: (700_000.0, 200_000.0), 15: (1_000_000.0, 250_000.0), 20: (1_200_000.0, 300_000.0)}


@query(
    "short_pressure",
    "SELECT load_date, "
    + ", ".join(f"round(1 - 1 / (1 + exp(-((s{k} - {a}) * {1 / b!r}::DOUBLE))), 4) AS s{k}" for k, (a, b) in _POINTS.items())
    + f", CASE WHEN s10 > {_POINTS[10][0]} AND s15 > {_POINTS[15][0]} THEN 0.0 ELSE 1.0 END::DOUBLE AS flag FROM (SELECT f.load_date, "
    + ", ".join(f"sum(CASE WHEN pe_rank > {k} THEN 0 ELSE close * short_position END)::DOUBLE AS s{k}" for k in _POINTS)
    + " FROM (SELECT *, rank() OVER (PARTITION BY load_date ORDER BY forward_pe DESC) AS pe_rank FROM t_finance) f JOIN t_short s ON f.code = s.code AND f.load_date = s.load_date GROUP BY 1)",
)
def short_pressure(spark: SparkSession, sf: str) -> DataFrame:
    totals = panels.totals_table(spark, sf)
    finance = loading.finance_update(panels.web_finance(totals))
    return evaluation.short_pressure(finance, loading.shorts_update(panels.web_short(totals)), _POINTS, newest=None)


fragment(
    "i_perf",
    """
SELECT a.code, a.ranking, e.load_date, (e.market_price - a.market_price)::DOUBLE / a.market_price::DOUBLE AS ratio
FROM i_full a JOIN i_day n ON a.load_date = n.load_date JOIN i_day m ON n.ix = m.ix - 1 JOIN i_full e ON e.load_date = m.load_date AND e.code = a.code WHERE a.ranking < 6""",
)


def _perf(spark: SparkSession, sf: str) -> DataFrame:
    full = stage(_instances(spark, sf, None))
    return evaluation.next_day_performance(full, full.select("code", "load_date", "market_price"), calendar(full), newest=None)


@query("next_day_performance", "SELECT * REPLACE (round(ratio, 6) AS ratio) FROM i_perf")
def next_day_performance(spark: SparkSession, sf: str) -> DataFrame:
    return _six(_perf(spark, sf), "ratio")


_TOPS = ", ".join(f"avg(CASE WHEN ranking <= {k} THEN ratio END) + 1 AS top{k}, max(CASE WHEN ranking = {k} THEN ratio END) + 1 AS view{k}" for k in range(1, 6))
fragment("i_daily", f"SELECT load_date, {_TOPS} FROM i_perf GROUP BY 1")
_ALL = [f"{p}{k}" for k in range(1, 6) for p in ("top", "view")]


@query("performance_by_place", "SELECT load_date, " + ", ".join(f"round({c}, 6) AS {c}" for c in _ALL) + " FROM i_daily")
def performance_by_place(spark: SparkSession, sf: str) -> DataFrame:
    return _six(evaluation.performance_by_place(_perf(spark, sf)), *_ALL)


@query(
    "cumulative_performance",
    "SELECT load_date, " + ", ".join(f"round(sum(log10({c})) OVER (ORDER BY load_date), 6) AS {c}" for c in ("top5", "top4")) + " FROM i_daily",
)
def cumulative_performance(spark: SparkSession, sf: str) -> DataFrame:
    daily = stage(evaluation.performance_by_place(_perf(spark, sf))).select("load_date", "top5", "top4")
    out = evaluation.cumulative_performance(daily, ["top5", "top4"])
    return out.withColumns({c: F.round(F.log10(c), 6) for c in ("top5", "top4")})


# --- rating sources ---------------------------------------------------------------------

MIN_RATED, MIN_VOLUME = 23, 70_000
_GOOD = f"average_volume > {MIN_VOLUME} AND CASE WHEN market_day_high <= market_day_low THEN 0 ELSE (market_price - market_day_low)::DOUBLE / (market_day_high - market_day_low)::DOUBLE END > 0.4"
fragment("e_pe", f"SELECT *, {rank('coalesce(forward_pe, 0) DESC')} AS pe_rank FROM w_tx")
fragment("e_org", f"SELECT load_date FROM w_tx WHERE recommendation_mean IS NOT NULL GROUP BY 1 HAVING count(*) > {MIN_RATED}")


@query(
    "score_per_date",
    f"""
SELECT load_date, round(avg(g) + 1, 6) AS growth FROM (
  SELECT *, {rank(score_sql('pe_rank', 'number_of_analyst', 'recommendation_mean', 40) + ' DESC')} AS rk FROM (
    SELECT *, CASE WHEN market_open <> 0 THEN round((market_price - market_open)::DOUBLE / market_open::DOUBLE, 3) ELSE 0 END AS g FROM e_pe WHERE {_GOOD} AND load_date IN (SELECT load_date FROM e_org))) WHERE rk <= 3 GROUP BY 1""",
)
def score_per_date(spark: SparkSession, sf: str) -> DataFrame:
    return _six(evaluation.score_per_date(panel(spark, sf), MIN_RATED, MIN_VOLUME), "growth")


# The second source refreshes on the weeks in which enough codes carry its ratings.
fragment("e_src", "SELECT * REPLACE (CASE WHEN date_index % 6 = 1 THEN mi_buy END AS mi_buy) FROM e_pe")
fragment("e_ref", "SELECT load_date, row_number() OVER (ORDER BY load_date) AS k FROM (SELECT DISTINCT load_date FROM e_src WHERE mi_buy IS NOT NULL)")
fragment(
    "e_prd",
    """
SELECT s.k AS period, s.load_date AS start_date, b.load_date AS end_date FROM e_ref s JOIN e_ref e ON s.k = e.k - 1 JOIN (SELECT DISTINCT load_date, date_index FROM w_tx) i ON e.load_date = i.load_date
JOIN (SELECT DISTINCT load_date, date_index FROM w_tx) b ON i.date_index = b.date_index + 1""",
)
fragment("e_comb", "SELECT p.period, min(o.load_date) AS start_date, max(o.load_date) AS end_date FROM e_org o JOIN e_prd p ON o.load_date BETWEEN p.start_date AND p.end_date GROUP BY 1")


def _source(spark: SparkSession, sf: str) -> DataFrame:
    tx = panel(spark, sf)
    return stage(tx.withColumn("mi_buy", F.when(F.col("date_index") % 6 == 1, F.col("mi_buy"))))


@query("rating_periods", "SELECT * FROM e_comb")
def rating_periods(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.rating_periods(_source(spark, sf), "mi_buy", MIN_RATED)


fragment(
    "e_cand",
    f"""
SELECT code, start_date, end_date, growth, row_number() OVER (PARTITION BY start_date ORDER BY {score_sql('pe_rank', 'n', 'm', 50)} DESC, code) AS mi_rank,
  row_number() OVER (PARTITION BY start_date ORDER BY {score_sql('pe_rank', 'number_of_analyst', 'recommendation_mean', 50)} DESC, code) AS org_rank FROM (
  SELECT a.*, p.start_date, p.end_date, b.market_price::DOUBLE / a.market_open::DOUBLE AS growth, a.mi_buy + a.mi_hold + a.mi_sell AS n,
    round(CASE WHEN a.mi_buy + a.mi_hold + a.mi_sell = 0 THEN 5 ELSE (a.mi_buy + a.mi_hold * 3 + a.mi_sell * 5)::DOUBLE / (a.mi_buy + a.mi_hold + a.mi_sell) END, 3) AS m
  FROM e_src a JOIN e_comb p ON a.load_date = p.start_date JOIN w_tx b ON b.load_date = p.end_date AND a.code = b.code WHERE a.mi_buy IS NOT NULL) WHERE {_GOOD}""",
)
fragment(
    "e_blend",
    "SELECT *, "
    + ", ".join(f"row_number() OVER (PARTITION BY start_date ORDER BY mi_rank * {a} + org_rank * {b}, mi_rank) AS {n}" for n, (a, b) in evaluation.BLENDS.items())
    + " FROM e_cand",
)


def _candidates(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    src = _source(spark, sf)
    return stage(evaluation.period_candidates(src, evaluation.rating_periods(src, "mi_buy", MIN_RATED), MIN_VOLUME)), calendar(src)


@query(
    "rating_differences",
    "SELECT code, start_date, round(growth, 6) AS growth, mrank, arank, orank FROM e_blend WHERE (mrank <> arank OR arank <> orank) AND (mrank < 4 OR arank < 4 OR orank < 4)",
)
def rating_differences(spark: SparkSession, sf: str) -> DataFrame:
    return _six(evaluation.rating_differences(_candidates(spark, sf)[0]), "growth")


@query(
    "period_returns",
    """
SELECT x.start_date, x.end_date, round(x.growth, 6) AS growth, b.date_index - a.date_index + 1 AS days FROM (SELECT start_date, end_date, avg(growth) AS growth FROM e_blend WHERE mrank < 4 GROUP BY 1, 2) x
JOIN (SELECT DISTINCT load_date, date_index FROM w_tx) a ON x.start_date = a.load_date JOIN (SELECT DISTINCT load_date, date_index FROM w_tx) b ON x.end_date = b.load_date""",
)
def period_returns(spark: SparkSession, sf: str) -> DataFrame:
    candidates, days = _candidates(spark, sf)
    return _six(evaluation.period_returns(candidates, days), "growth")


# --- star schema ------------------------------------------------------------------------


def _star(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    line = table(spark, sf, "lineitem")
    part = table(spark, sf, "part").where("p_size <= 45").select("p_partkey", "p_retailprice")
    supplier = table(spark, sf, "supplier").where("s_nationkey < 23").select("s_suppkey")
    return line, part, supplier


@query(
    "revenue_monthly",
    """
SELECT year(l_shipdate) AS year, month(l_shipdate) AS month, sum(round(l_extendedprice * 100)::BIGINT - round(p_retailprice * 100)::BIGINT)::BIGINT / 100.0 AS margin
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2""",
)
def revenue_monthly(spark: SparkSession, sf: str) -> DataFrame:
    line, part, supplier = (table(spark, sf, t) for t in ("lineitem", "part", "supplier"))
    fact = star_join(line, [(part, "l_partkey", "p_partkey"), (supplier, "l_suppkey", "s_suppkey")])
    cents = F.round(F.col("l_extendedprice") * 100).cast("long") - F.round(F.col("p_retailprice") * 100).cast("long")
    out = evaluation.revenue_monthly(fact, "l_shipdate", cents)
    return out.withColumn("margin", F.col("margin") / 100.0)


@query(
    "invalid_transactions",
    """
SELECT year(l_shipdate) AS year, count(*) AS n, sum(l_quantity)::BIGINT AS qty FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size <= 45) ON l_partkey = p_partkey
LEFT JOIN (SELECT * FROM supplier WHERE s_nationkey < 23) ON l_suppkey = s_suppkey WHERE p_partkey IS NULL OR s_suppkey IS NULL GROUP BY 1""",
)
def invalid_transactions(spark: SparkSession, sf: str) -> DataFrame:
    line, part, supplier = _star(spark, sf)
    bad = orphans(line.select("l_partkey", "l_suppkey", "l_shipdate", "l_quantity"), [(part, "l_partkey", "p_partkey"), (supplier, "l_suppkey", "s_suppkey")])
    return bad.groupBy(F.year("l_shipdate").alias("year")).agg(F.count("*").alias("n"), F.sum("l_quantity").cast("long").alias("qty"))
