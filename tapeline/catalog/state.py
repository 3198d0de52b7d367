"""Rankings, indices, current-state views and end-of-day reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.catalog.duck import ASOF, DAY
from tapeline.catalog.daily import _classes
from tapeline.catalog.registry import FRAGMENTS, at_other_day, fragment, query
from tapeline.operators.folds import parabolic_sar, smoothed_candles
from tapeline.plans import daily, loading, market_index, rankings, reports, views
from tapeline.plans.daily import as_date
from tapeline.plans.reports import DailyRun, Settings
from tapeline.sources import panels
from tapeline.staging import stage

# The derived panel has 25 codes that trade on three days out of five; the gates follow that.
SMALL = (
    (20, "0.2", 10, 400_000),
    (10, "0.1", 5, 150_000),
    (1, "0.05", 1, 20_000),
)
daily.POPULARITY["small"] = list(SMALL)
SETTINGS = Settings(
    min_share=0.7,
    popularity="small",
    turnover_cuts=(10, 20, 23),
    index_min_rows=16,
    index_top=20,
    semester_rows=100,
    quarter_rows=45,
    semester_steady=(100, 45.0),
    quarter_steady=(45, 22.0),
    direction_share=0.5,
    direction_flips=0,
)


def asof() -> Column:
    return as_date(ASOF)



def run_for(spark: SparkSession, sf: str, with_text: bool = False) -> DailyRun:
    totals = panels.daily_totals(spark, sf)
    extra = {}
    if with_text:
        totals = stage(totals)
        extra = {
            "shorts": loading.shorts_update(panels.web_short(totals)),
            "announcements": loading.announcements_update(panels.web_announcement(spark, sf)),
            "analysis": loading.analysis_update(panels.web_analysis(totals)),
        }
    return DailyRun(panels.quotes_of(totals), panels.categories, ASOF, SETTINGS, **extra)


#: The trading day before ASOF, for the check SQL; the plans find it themselves.
DAY_BEFORE = "DATE '2001-06-28'"


# --- rankings ---------------------------------------------------------------------------

fragment(
    "s_act",
    f"""
SELECT code, load_date, CASE WHEN rk <= 10 THEN 1 WHEN rk <= 20 THEN 2 WHEN rk <= 23 THEN 3 ELSE 4 END AS turnover, {_classes(SMALL)} AS popularity
FROM (SELECT *, row_number() OVER (PARTITION BY load_date ORDER BY mv * mc DESC, code) AS rk FROM (
  SELECT code, load_date, min(volume) OVER (PARTITION BY code ORDER BY load_date ROWS 13 PRECEDING) AS mv, min(close) OVER (PARTITION BY code ORDER BY load_date ROWS 13 PRECEDING) AS mc
  FROM d_bars WHERE load_date <= {DAY}))""",
)
fragment("s_ha", "SELECT code, load_date, close >= open AS up FROM d_ha")
fragment("s_sar", "SELECT code, load_date, ud_trend = 'up' AS up FROM d_sar")


def lookback_sql(state: str, side: str) -> str:
    up = "up AND NOT nx" if side == "long_end" else "NOT up AND nx"

    def days(n: int) -> str:
        return f"(SELECT max(n) FROM (SELECT count(*) AS n FROM d_bars b WHERE b.load_date <= cal AND b.load_date > cal - {n} GROUP BY b.code))"

    return f"""
WITH st AS (SELECT code, load_date, up, lead(up) OVER (PARTITION BY code ORDER BY load_date) AS nx FROM {state} WHERE load_date <= {DAY}),
act AS (SELECT code FROM st GROUP BY 1 HAVING max(load_date) = {DAY}),
td AS (SELECT code, max(load_date) AS cal FROM st WHERE {up} AND code IN (SELECT code FROM act) GROUP BY 1 HAVING max(load_date) > {DAY} - 28),
tc AS (SELECT cal, {days(168)} AS sd, {days(84)} AS qd FROM (SELECT DISTINCT cal FROM td)),
rw AS (SELECT st.code, st.load_date, st.up, td.cal, st.load_date > td.cal - 84 AS inq FROM st JOIN td ON st.code = td.code WHERE st.load_date > td.cal - 168 AND st.load_date <= td.cal),
sz AS (SELECT code, cal, count(*) AS s, count(*) FILTER (WHERE inq) AS q FROM rw GROUP BY 1, 2)
SELECT rw.code, rw.load_date, rw.up, rw.cal, sz.s > tc.sd * 0.7 AS ins, rw.inq AND sz.q > tc.qd * 0.7 AS inq FROM rw JOIN sz ON rw.code = sz.code JOIN tc ON rw.cal = tc.cal"""


for _f in ("ha", "sar"):
    for _side in rankings.SIDES:
        _lk = f"lk_{_f}_{_side}"
        fragment(_lk, lookback_sql(f"s_{_f}", _side))

        def _share(source: str, hit: str, side: str = _side) -> str:
            return f"""
SELECT * FROM (SELECT code, cal AS load_date, '{side}' AS usage_direction, round(count(*) FILTER (WHERE ins AND {hit})::DOUBLE / nullif(count(*) FILTER (WHERE ins), 0), 4) AS semester_ratio,
  round(count(*) FILTER (WHERE inq AND {hit})::DOUBLE / nullif(count(*) FILTER (WHERE inq), 0), 4) AS quarter_ratio FROM {source} GROUP BY 1, 2) WHERE semester_ratio IS NOT NULL OR quarter_ratio IS NOT NULL"""

        fragment(f"rk_state_{_f}_{_side}", _share(_lk, "up"))
        fragment(
            f"rk_ema_{_f}_{_side}",
            _share(f"(SELECT k.*, t.e10_e25_direction AS e FROM {_lk} k JOIN d_trend t ON k.code = t.code AND k.load_date = t.load_date)", "e = 1"),
        )
        fragment(
            f"rk_stb_{_f}_{_side}",
            f"""
WITH p AS (SELECT k.*, b.close AS price FROM {_lk} k JOIN d_bars b ON k.code = b.code AND k.load_date = b.load_date),
s AS (SELECT code, cal, round(avg(abs(a - b)), 3) AS x FROM (SELECT code, cal, row_number() OVER (PARTITION BY code ORDER BY price, load_date) AS a, row_number() OVER (PARTITION BY code ORDER BY load_date) AS b FROM p WHERE ins) GROUP BY 1, 2),
q AS (SELECT code, cal, round(avg(abs(a - b)), 3) AS x FROM (SELECT code, cal, row_number() OVER (PARTITION BY code ORDER BY price, load_date) AS a, row_number() OVER (PARTITION BY code ORDER BY load_date) AS b FROM p WHERE inq) GROUP BY 1, 2)
SELECT coalesce(s.code, q.code) AS code, coalesce(s.cal, q.cal) AS load_date, '{_side}' AS usage_direction, s.x AS semester_ratio, q.x AS quarter_ratio FROM s FULL JOIN q ON s.code = q.code""",
        )


def _register_ranking(name: str, measure: str, family: str) -> None:
    sql = " UNION ALL ".join(f"SELECT * FROM rk_{measure}_{family}_{side}" for side in rankings.SIDES)

    @query(name, sql)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        r = run_for(spark, sf)
        return r.ranking(measure, family, "long_end").unionByName(r.ranking(measure, family, "short_end"))


for _name, _m, _f in (
    ("ema_share_ranking_on_candles", "ema", "ha"),
    ("ema_share_ranking_on_sar", "ema", "sar"),
    ("green_share_ranking", "state", "ha"),
    ("up_share_ranking", "state", "sar"),
    ("stability_ranking_on_candles", "stb", "ha"),
    ("stability_ranking_on_sar", "stb", "sar"),
):
    _register_ranking(_name, _m, _f)


def _descending(measure: str, side: str) -> bool:
    return side == "long_end" if measure == "ema" else side == "short_end"


for _m in ("ema", "stb"):
    for _f in ("ha", "sar"):
        for _side in rankings.SIDES:
            _way = "DESC" if _descending(_m, _side) else "ASC"
            fragment(
                f"cur_{_m}_{_f}_{_side}",
                f"""
SELECT category, code, load_date, rank() OVER (ORDER BY sr * 2 + qr) AS total_ranking, rank() OVER (PARTITION BY category ORDER BY sr * 2 + qr) AS category_ranking FROM (
  SELECT c.category, t.code, t.load_date, row_number() OVER (ORDER BY t.semester_ratio {_way}, t.code) AS sr, row_number() OVER (ORDER BY t.quarter_ratio {_way}, t.code) AS qr
  FROM rk_{_m}_{_f}_{_side} t JOIN s_act a ON t.code = a.code AND t.load_date = a.load_date JOIN d_cat c ON t.code = c.code
  WHERE t.semester_ratio IS NOT NULL AND t.quarter_ratio IS NOT NULL AND a.turnover <> 4 AND a.popularity <> 4) WHERE load_date > {DAY} - 28""",
            )


def _register_current(name: str, measure: str, family: str) -> None:
    sql = " UNION ALL ".join(f"SELECT '{side}' AS side, * FROM cur_{measure}_{family}_{side}" for side in rankings.SIDES)

    @query(name, sql)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        r = run_for(spark, sf)
        parts = [r.current(measure, family, side).select(F.lit(side).alias("side"), "*") for side in rankings.SIDES]
        return parts[0].unionByName(parts[1])


for _name, _m, _f in (
    ("current_ema_on_candles", "ema", "ha"),
    ("current_ema_on_sar", "ema", "sar"),
    ("current_stability_on_candles", "stb", "ha"),
    ("current_stability_on_sar", "stb", "sar"),
):
    _register_current(_name, _m, _f)

for _side in rankings.SIDES:
    fragment(
        f"full_{_side}",
        f"""
SELECT category, code, d AS last_update_date, row_number() OVER (ORDER BY t, code) AS total_ranking, row_number() OVER (PARTITION BY category ORDER BY c, code) AS category_ranking FROM (
  SELECT a.category, a.code, greatest(a.load_date, b.load_date, x.load_date, y.load_date) AS d, a.total_ranking + b.total_ranking + x.total_ranking + y.total_ranking AS t,
    a.category_ranking + b.category_ranking + x.category_ranking + y.category_ranking AS c
  FROM cur_ema_ha_{_side} a JOIN cur_ema_sar_{_side} b ON a.code = b.code JOIN cur_stb_ha_{_side} x ON a.code = x.code JOIN cur_stb_sar_{_side} y ON a.code = y.code)""",
    )


@query("full_long_list", "SELECT * FROM full_long_end")
def full_long_list(spark: SparkSession, sf: str) -> DataFrame:
    return run_for(spark, sf).full_list("long_end")


@query("full_short_list", "SELECT * FROM full_short_end")
def full_short_list(spark: SparkSession, sf: str) -> DataFrame:
    return run_for(spark, sf).full_list("short_end")


def steady_sql(months: int, rows: int, below: float) -> str:
    return f"""
SELECT c.category, x.code, x.load_date, x.ratio FROM (SELECT code, max(load_date) AS load_date, count(*) AS n, round(avg(abs(a - b)), 3) AS ratio FROM (
  SELECT code, load_date, row_number() OVER (PARTITION BY code ORDER BY close, load_date) AS a, row_number() OVER (PARTITION BY code ORDER BY load_date) AS b
  FROM d_bars WHERE load_date > {DAY} - INTERVAL {months} MONTH AND load_date <= {DAY}) GROUP BY 1) x
JOIN s_act a ON x.code = a.code AND a.load_date = {DAY} JOIN d_cat c ON x.code = c.code WHERE n > {rows} AND ratio < {below} AND a.turnover <> 4 AND a.popularity <> 4"""


fragment("st_sem", steady_sql(6, 100, 45.0))
fragment("st_qtr", steady_sql(3, 45, 22.0))


@query("trend_stability_lists", "SELECT 'semester' AS span, * FROM st_sem UNION ALL SELECT 'quarter', * FROM st_qtr")
def trend_stability_lists(spark: SparkSession, sf: str) -> DataFrame:
    r = run_for(spark, sf)
    a, b = (r.steady(s).select(F.lit(s).alias("span"), "*") for s in ("semester", "quarter"))
    return a.unionByName(b)


def direction_sql(months: int, rows: int) -> str:
    share = ", ".join(
        f"round(avg(CASE WHEN {p} THEN 1.0 ELSE 0 END), 3) AS {n}" for n, p in (("pe2", "e.price > e.ema15"), ("pe5", "e.price > e.ema40"), ("e2e5", "e.ema15 > e.ema40"))
    )
    return f"""
WITH f AS (SELECT * FROM (SELECT code, load_date, ud_trend2 AS a, lag(ud_trend2) OVER w AS pa, ud_trend3 AS b, lag(ud_trend3) OVER w AS pb FROM d_sar23 WINDOW w AS (PARTITION BY code ORDER BY load_date))
  WHERE load_date > {DAY} - INTERVAL 2 MONTH AND load_date <= {DAY} AND (a = 'down' AND pa = 'up' OR b = 'down' AND pb = 'up'))
SELECT c.category, x.code, x.load_date, x.rec, x.pe2, x.pe5, x.e2e5, l.turnover, l.popularity FROM (
  SELECT f.code, f.load_date, count(*) AS rec, {share} FROM f JOIN d_ema e ON f.code = e.code AND e.load_date <= f.load_date AND e.load_date > f.load_date - INTERVAL {months} MONTH
  GROUP BY 1, 2 HAVING count(*) > {rows}) x JOIN s_act l ON x.code = l.code AND x.load_date = l.load_date JOIN d_cat c ON x.code = c.code WHERE pe2 > 0.5 OR pe5 > 0.5 OR e2e5 > 0.5"""


fragment("dr_sem", direction_sql(6, 100))
fragment("dr_qtr", direction_sql(3, 45))


@query("trend_directions", "SELECT 'semester' AS span, * FROM dr_sem UNION ALL SELECT 'quarter', * FROM dr_qtr")
def trend_directions(spark: SparkSession, sf: str) -> DataFrame:
    r = run_for(spark, sf)
    a, b = (r.directions(s).select(F.lit(s).alias("span"), "*") for s in ("semester", "quarter"))
    return a.unionByName(b)


for _n in ("sem", "qtr"):
    fragment(
        f"dl_{_n}",
        f"""
SELECT category, code, max(load_date) AS recent_calculation_date, ((sum(round((pe2 + pe5 + e2e5) * 1000)::BIGINT) * 20 + 3 * count(*)) // (6 * count(*)) / 10000.0)::DOUBLE AS trend, round(avg((popularity + turnover) // 2), 1) AS popularity
FROM dr_{_n} WHERE load_date > {DAY} - INTERVAL 2 MONTH GROUP BY 1, 2 HAVING count(*) > 0 AND avg((popularity + turnover) // 2) < 3""",
    )


@query("trend_direction_lists", "SELECT 'semester' AS span, * FROM dl_sem UNION ALL SELECT 'quarter', * FROM dl_qtr")
def trend_direction_lists(spark: SparkSession, sf: str) -> DataFrame:
    r = run_for(spark, sf)
    a, b = (r.direction_list(s).select(F.lit(s).alias("span"), "*") for s in ("semester", "quarter"))
    return a.unionByName(b)


# --- indices ----------------------------------------------------------------------------

fragment(
    "ix_comp",
    f"""
WITH dd AS (SELECT DISTINCT load_date FROM d_bars WHERE load_date <= {DAY} ORDER BY load_date DESC LIMIT 40),
pr AS (SELECT * FROM d_bars WHERE load_date IN (SELECT load_date FROM dd)),
top AS (SELECT code, close AS match_price, market_cap FROM pr WHERE load_date = {DAY} AND code IN (SELECT code FROM pr GROUP BY 1 HAVING count(*) >= 16) ORDER BY market_cap DESC, code LIMIT 20),
wt AS (SELECT code, match_price, round(market_cap::DOUBLE / (SELECT sum(market_cap) FROM top)::DOUBLE * 100, 4)::DECIMAL(9,4) AS weight_ratio FROM top),
gr AS (SELECT wt.code, dd.load_date FROM wt CROSS JOIN dd),
fl AS (SELECT g.code, g.load_date, n.open, n.low, n.high, n.close, n.volume FROM gr g JOIN LATERAL (SELECT * FROM pr WHERE pr.code = g.code AND pr.load_date >= g.load_date ORDER BY pr.load_date LIMIT 1) n ON TRUE)
SELECT fl.code, fl.load_date, round(open::DOUBLE / match_price::DOUBLE, 3)::DECIMAL(12,3) AS open, round(low::DOUBLE / match_price::DOUBLE, 3)::DECIMAL(12,3) AS low, round(high::DOUBLE / match_price::DOUBLE, 3)::DECIMAL(12,3) AS high,
  round(close::DOUBLE / match_price::DOUBLE, 3)::DECIMAL(12,3) AS close, volume, match_price, weight_ratio FROM fl JOIN wt ON fl.code = wt.code""",
)


@query(
    "index_components",
    "SELECT code, load_date, open::DOUBLE AS open, low::DOUBLE AS low, high::DOUBLE AS high, close::DOUBLE AS close, volume, match_price::DOUBLE AS match_price, weight_ratio::DOUBLE AS weight_ratio FROM ix_comp",
)
def index_components(spark: SparkSession, sf: str) -> DataFrame:
    return run_for(spark, sf).components.select("code", "load_date", "open", "low", "high", "close", "volume", "match_price", "weight_ratio")


def _rebased(c: str, digits: int) -> str:
    return f"(round({c}::DOUBLE / match_price::DOUBLE, 3)::DECIMAL({digits},3))::DOUBLE AS {c}"


@query(
    "index_components_whole",
    FRAGMENTS["ix_comp"].replace("n.volume FROM gr", "n.volume, n.typ3, n.typ4, n.turnover, n.market_cap FROM gr").split("SELECT fl.code, fl.load_date")[0]
    + f"SELECT fl.code, fl.load_date, {', '.join(_rebased(c, 12) for c in market_index.PRICES)}, {_rebased('turnover', 24)}, volume, market_cap::DOUBLE AS market_cap, "
    "match_price::DOUBLE AS match_price, weight_ratio::DOUBLE AS weight_ratio FROM fl JOIN wt ON fl.code = wt.code",
)
def index_components_whole(spark: SparkSession, sf: str) -> DataFrame:
    return run_for(spark, sf).components


def index_sql(prefix: str, comp: str) -> None:
    """Index rows, their candle recursion and the ratios, from a component table."""
    fragment(
        f"{prefix}_base",
        f"""
SELECT category, load_date, row_number() OVER (PARTITION BY category ORDER BY load_date) - 1 AS rnum,
  {", ".join(f"((sum({c} * weight_ratio)::DECIMAL(18,3)) * 1000)::BIGINT AS {c[0]}" for c in ("open", "high", "low", "close"))}
FROM {comp} r JOIN d_cat c ON r.code = c.code GROUP BY category, load_date""",
    )
    fragment(
        f"{prefix}_rec",
        f"""
SELECT category, rnum, load_date, o, h, l, c, (o + c + 1) // 2 AS ho, (o + h + l + c + 2) // 4 AS hc FROM {prefix}_base WHERE rnum = 0
UNION ALL
SELECT b.category, b.rnum, b.load_date, b.o, b.h, b.l, b.c, (p.ho + p.hc + 1) // 2, (b.o + b.h + b.l + b.c + 2) // 4 FROM {prefix}_rec p JOIN {prefix}_base b ON b.category = p.category AND b.rnum = p.rnum + 1""",
    )
    fragment(
        f"{prefix}_dir",
        f"""
WITH e25 AS (SELECT category, sum(c * weight)::HUGEINT / 1e9 AS ema25 FROM {prefix}_base JOIN w40 w ON rnum + w.orders = 39 GROUP BY 1),
e10 AS (SELECT category, sum(c * weight)::HUGEINT / 1e9 AS ema10 FROM {prefix}_base JOIN w15 w ON rnum + w.orders = 39 GROUP BY 1),
cb AS (SELECT a.category, a.load_date, p.c AS scp, p.hc AS hcp, a.o, a.c, a.h, a.l, a.ho, a.hc, greatest(a.h, a.ho, a.hc) AS hh, least(a.l, a.ho, a.hc) AS hl, ema25, ema10
  FROM {prefix}_rec a JOIN {prefix}_rec p ON a.category = p.category AND a.rnum = 39 AND p.rnum = 38 JOIN e25 ON a.category = e25.category JOIN e10 ON a.category = e10.category),
al AS (SELECT * FROM cb UNION ALL SELECT 'ASX300', max(load_date), sum(scp), sum(hcp), sum(o), sum(c), sum(h), sum(l), sum(ho), sum(hc), sum(hh), sum(hl), sum(ema25), sum(ema10) FROM cb)
SELECT category, load_date, {", ".join(f"round({a}::DOUBLE / scp, 3) AS {n}" for a, n in (("o", "s_open"), ("c", "s_close"), ("h", "s_high"), ("l", "s_low"), ("ema25", "ema25"), ("ema10", "ema10")))},
  {", ".join(f"round({a}::DOUBLE / hcp, 3) AS {n}" for a, n in (("ho", "h_open"), ("hc", "h_close"), ("hh", "h_high"), ("hl", "h_low")))} FROM al WHERE load_date IS NOT NULL""",
    )


index_sql("ix", "ix_comp")


@query("index_direction", "SELECT * FROM ix_dir")
def index_direction(spark: SparkSession, sf: str) -> DataFrame:
    return run_for(spark, sf).index


# --- current-state views ----------------------------------------------------------------

_UPTO = f"WHERE load_date <= {DAY}"
_NEWEST = "QUALIFY row_number() OVER (PARTITION BY code ORDER BY load_date DESC) = 1"


def _pct(expr: str, scale: int) -> str:
    return f"(round({expr}, {scale})::DECIMAL(9,{scale}))::VARCHAR || '%'"


fragment(
    "v_ema",
    f"""
SELECT code, load_date, CASE WHEN ema15 >= ema40 THEN 'BUY' ELSE 'SELL' END AS indicator, price,
  {_pct('(1 - ema15::DOUBLE / price::DOUBLE) * 100', 3)} || ' ~ ' || {_pct('(1 - ema40::DOUBLE / price::DOUBLE) * 100', 3)} AS ema FROM d_ema {_UPTO} {_NEWEST}""",
)
fragment("v_sar", f"SELECT code, load_date, ud_trend, n_sar FROM d_sar {_UPTO} {_NEWEST}")
fragment(
    "v_vol",
    "SELECT code, load_date, volume, avg_volume, std_volume, round(volume::DOUBLE / avg_volume, 3) AS ratio, CASE WHEN volume >= avg_volume + 3 * std_volume THEN 3 WHEN volume >= avg_volume + 2 * std_volume THEN 2 WHEN volume >= avg_volume + std_volume THEN 1 ELSE 0 END AS range FROM d_vol",
)


@query("ema_current", "SELECT code, load_date, indicator, price::DOUBLE AS price, ema FROM v_ema")
def ema_current(spark: SparkSession, sf: str) -> DataFrame:
    return views.ema_current(daily.moving_averages(panels.quotes(spark, sf)).where(F.col("load_date") <= asof()))


@query("sar_current", "SELECT code, load_date, ud_trend, n_sar::DOUBLE AS n_sar FROM v_sar")
def sar_current(spark: SparkSession, sf: str) -> DataFrame:
    return views.sar_current(parabolic_sar(panels.quotes(spark, sf)).where(F.col("load_date") <= asof()))


@query("volume_current", "SELECT * FROM v_vol")
def volume_current(spark: SparkSession, sf: str) -> DataFrame:
    return views.volume_current(daily.volume_bands(panels.quotes_table(spark, sf), ASOF))


fragment("hh", f"SELECT *, close >= open AS up, lag(close >= open) OVER (PARTITION BY code ORDER BY load_date) AS pup FROM d_ha {_UPTO}")
_STATUS = "CASE WHEN close >= open AND open = low THEN 'Positive' WHEN close < open AND open = high THEN 'Negative' WHEN close >= open THEN 'Long' ELSE 'Short' END"


@query(
    "candle_current",
    f"SELECT code, load_date, {_STATUS} AS status, CASE WHEN up <> pup THEN 'Reverse' ELSE 'Continuously' END AS trend FROM hh {_NEWEST}",
)
def candle_current(spark: SparkSession, sf: str) -> DataFrame:
    return views.candle_current(smoothed_candles(panels.quotes(spark, sf).where(F.col("load_date") <= asof())))


fragment("u_idx", f"SELECT load_date, row_number() OVER (ORDER BY load_date DESC) AS rnum FROM (SELECT DISTINCT load_date FROM d_base {_UPTO})")
fragment(
    "v_seq",
    f"""
SELECT c.code, c.load_date, i.rnum AS sequence, {_STATUS} AS status FROM hh c JOIN (SELECT code, max(load_date) AS day FROM hh WHERE up <> pup GROUP BY 1) t ON c.code = t.code
JOIN u_idx i ON i.load_date = t.day WHERE c.load_date = (SELECT max(load_date) FROM hh)""",
)


@query("candle_sequence", "SELECT * FROM v_seq")
def candle_sequence(spark: SparkSession, sf: str) -> DataFrame:
    r = run_for(spark, sf)
    return views.candle_sequence(r.candles, r.days)


@query("current_actionable", f"SELECT * FROM s_act WHERE load_date = {DAY} AND (turnover <> 4 OR popularity <> 4)")
def current_actionable(spark: SparkSession, sf: str) -> DataFrame:
    return views.current_actionable(run_for(spark, sf).actionable)


fragment(
    "rr_0",
    f"""
SELECT code, load_date, greatest(abs(1 - high::DOUBLE / pclose::DOUBLE), abs(1 - low::DOUBLE / pclose::DOUBLE), abs(1 - high::DOUBLE / close::DOUBLE), abs(1 - low::DOUBLE / close::DOUBLE)) * 100 AS rng,
  abs(1 - close::DOUBLE / pclose::DOUBLE) * 100 AS diff FROM d_bars {_UPTO} QUALIFY row_number() OVER (PARTITION BY code ORDER BY load_date DESC) < 40""",
)


@query(
    "recent_range",
    """
SELECT r.code, x.latest_date, round(r.a, 3) AS avg_range, round(r.s, 3) AS std_range, round(f.a, 3) AS avg_diff, round(f.s, 3) AS std_diff FROM (SELECT code, max(load_date) AS latest_date FROM rr_0 GROUP BY 1) x
JOIN s_act l ON x.code = l.code AND x.latest_date = l.load_date AND (l.turnover <> 4 OR l.popularity <> 4)
JOIN (SELECT code, avg(rng) AS a, stddev_samp(rng) AS s FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY rng NULLS LAST, load_date) AS k FROM rr_0) WHERE k > 5 AND k < 36 GROUP BY 1) r ON x.code = r.code
JOIN (SELECT code, avg(diff) AS a, stddev_samp(diff) AS s FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY diff NULLS LAST, load_date) AS k FROM rr_0) WHERE k > 5 AND k < 36 GROUP BY 1) f ON x.code = f.code""",
)
def recent_range(spark: SparkSession, sf: str) -> DataFrame:
    r = run_for(spark, sf)
    return daily.recent_range(r.bars, r.actionable)


fragment(
    "v_brk",
    f"""
SELECT x.*, row_number() OVER (PARTITION BY x.code ORDER BY x.load_date DESC) AS rnum, i.rnum AS cal_dist FROM (
  SELECT code, load_date, short, m + 2 * d AS up_band, m - 2 * d AS down_band, CASE WHEN short >= m + d * 1.28 THEN 1 ELSE -1 END AS short_amount FROM (
    SELECT code, load_date, short, avg(short) OVER w AS m, stddev_samp(short) OVER w AS d FROM (
      SELECT b.code, b.load_date, (sum(b.typ3 * s.short_position))::DOUBLE AS short FROM d_bars b JOIN t_short s ON b.code = s.code AND b.load_date = s.load_date WHERE b.load_date <= {DAY} GROUP BY 1, 2)
    WINDOW w AS (PARTITION BY code ORDER BY load_date ROWS 19 PRECEDING))
  WHERE m IS NOT NULL AND d IS NOT NULL AND (short >= m + d * 1.28 OR short < m - d * 1.28)) x JOIN u_idx i ON x.load_date = i.load_date""",
)
fragment(
    "v_sht",
    "SELECT a.code, a.short_amount AS nearest_break, b.short_amount AS previous_break, a.cal_dist AS nearest_distance, b.cal_dist AS previous_distance FROM v_brk a JOIN v_brk b ON a.code = b.code AND a.rnum = 1 AND b.rnum = 2",
)


@query("short_breaks", "SELECT code, load_date, round(short, 3) AS short, round(up_band, 3) AS up_band, round(down_band, 3) AS down_band, short_amount, rnum, cal_dist FROM v_brk")
def short_breaks(spark: SparkSession, sf: str) -> DataFrame:
    r = run_for(spark, sf, with_text=True)
    out = views.short_breaks(r.bars, r.shorts, r.days)
    rounded = {c: F.round(c, 3) for c in ("short", "up_band", "down_band")}
    return out.withColumns(rounded)


@query("short_current", "SELECT * FROM v_sht")
def short_current(spark: SparkSession, sf: str) -> DataFrame:
    r = run_for(spark, sf, with_text=True)
    return views.short_current(views.short_breaks(r.bars, r.shorts, r.days))


fragment(
    "v_anc",
    f"""
SELECT code, min(last_anc) AS last_anc FROM (SELECT code, 0 AS last_anc FROM t_anc WHERE pub_datetime::DATE = {DAY} AND pub_datetime < {DAY} + INTERVAL 10 HOUR
UNION ALL SELECT a.code, i.rnum FROM t_anc a JOIN u_idx i ON a.pub_datetime::DATE = i.load_date) GROUP BY 1""",
)


@query("announcement_age", "SELECT * FROM v_anc")
def announcement_age(spark: SparkSession, sf: str) -> DataFrame:
    r = run_for(spark, sf, with_text=True)
    return views.announcement_age(r.announcements, r.days, ASOF)


def analysis_sql(health: str) -> str:
    return f"""
SELECT category, code, load_date, rec, {health} AS financial_healthy, round(1 - (pe - 1)::DOUBLE / nullif(cnt - 1, 0), 3) AS pe_ranking FROM (
  SELECT c.category, x.*, row_number() OVER (PARTITION BY c.category ORDER BY coalesce(fpe, -999) DESC, x.code) AS pe, count(*) OVER (PARTITION BY c.category) AS cnt FROM (
    SELECT code, load_date, average_recommendation AS rec, fpe, revenue AS a, net_income AS b, net_profit_margin AS m, ebitda AS e FROM t_analysis {_UPTO} {_NEWEST}) x
  JOIN d_cat c ON x.code = c.code WHERE x.load_date > {DAY} - 14)"""


def _sign(c: str, pos: str, missing: str, neg: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN {missing} WHEN {c} > 0 THEN {pos} ELSE {neg} END"


fragment("v_ana", analysis_sql("round((" + " + ".join(_sign(c, "1", "0", "-1") for c in "abme") + " + 4) / 8.0, 2)::DOUBLE"))


@query("analysis_current", "SELECT * FROM v_ana")
def analysis_current(spark: SparkSession, sf: str) -> DataFrame:
    return run_for(spark, sf, with_text=True).analysis


@query("analysis_signs", analysis_sql(" || ' ~ ' || ".join(_sign(c, "'P'", "'/'", "'N'") for c in "abme")))
def analysis_signs(spark: SparkSession, sf: str) -> DataFrame:
    r = run_for(spark, sf, with_text=True)
    return views.analysis_current(r._analysis, r.cats, ASOF, as_text=True)


# --- reports ----------------------------------------------------------------------------

fragment(
    "r_long",
    f"""
WITH ks AS (SELECT code, max(CASE WHEN w = 'qd' THEN x END) AS qd, max(CASE WHEN w = 'sd' THEN x END) AS sd, max(CASE WHEN w = 'qs' THEN x END) AS qs, max(CASE WHEN w = 'ss' THEN x END) AS ss, max(dt) AS dt FROM (
  SELECT code, 'qd' AS w, trend AS x, recent_calculation_date AS dt FROM dl_qtr UNION ALL SELECT code, 'sd', trend, recent_calculation_date FROM dl_sem
  UNION ALL SELECT code, 'qs', ratio, NULL FROM st_qtr UNION ALL SELECT code, 'ss', ratio, NULL FROM st_sem) GROUP BY 1),
fa AS (SELECT code, max(CASE WHEN ud_trend2 = 'down' AND p2 = 'up' THEN load_date END) AS a, max(CASE WHEN ud_trend3 = 'down' AND p3 = 'up' THEN load_date END) AS b FROM (
  SELECT code, load_date, ud_trend2, ud_trend3, lag(ud_trend2) OVER w AS p2, lag(ud_trend3) OVER w AS p3 FROM d_sar23 {_UPTO} WINDOW w AS (PARTITION BY code ORDER BY load_date)) GROUP BY 1)
SELECT c.category, ks.code, {DAY} AS load_date, CASE WHEN qd IS NULL OR qd < 0.5 THEN 0 ELSE round((qd - 0.5) / 0.5 * 100)::INT END AS quarterly_direction,
  CASE WHEN sd IS NULL OR sd < 0.5 THEN 0 ELSE round((sd - 0.5) / 0.5 * 100)::INT END AS semester_direction,
  CASE WHEN qs IS NULL OR qs > 22 THEN 0 ELSE round((22 - qs) / 22.0 * 100)::INT END AS quarterly_stability, CASE WHEN ss IS NULL OR ss > 45 THEN 0 ELSE round((45 - ss) / 45.0 * 100)::INT END AS semester_stability
FROM ks JOIN fa ON ks.code = fa.code JOIN d_cat c ON ks.code = c.code WHERE (qs IS NOT NULL OR ss IS NOT NULL) AND (qd IS NOT NULL OR sd IS NOT NULL) AND a IS NOT NULL AND b IS NOT NULL AND least(a, b) <= dt""",
)


@query("daily_long_list", "SELECT * FROM r_long")
def daily_long_list(spark: SparkSession, sf: str) -> DataFrame:
    return reports.daily_long_list(run_for(spark, sf))


def _buff(c: str) -> str:
    return f"round(({c}::DOUBLE / price::DOUBLE - 1) * 100, 2)::DECIMAL(9,2)"


fragment(
    "r_sum",
    f"""
SELECT l.category, l.code, l.load_date AS report_date, e.price, {_pct('(e.price::DOUBLE / e.ema40::DOUBLE - 1) * 100', 2)} AS ema25,
  CASE WHEN ud_trend2 = 'down' AND ud_trend3 = 'down' THEN least({_buff('n_sar2')}, {_buff('n_sar3')})::VARCHAR || '%' WHEN ud_trend2 = 'down' THEN {_buff('n_sar2')}::VARCHAR || '%'
    WHEN ud_trend3 = 'down' THEN {_buff('n_sar3')}::VARCHAR || '%' END AS sar_buff,
  '(' || quarterly_direction || '~' || semester_direction || '),(' || quarterly_stability || '~' || semester_stability || ')' AS trend, a.rec, a.financial_healthy, a.pe_ranking
FROM r_long l LEFT JOIN v_ana a ON l.code = a.code JOIN d_ema e ON l.code = e.code AND e.load_date = {DAY} JOIN d_sar23 s ON l.code = s.code AND s.load_date = {DAY}
WHERE quarterly_direction <> 0 OR semester_direction <> 0""",
)


@query(
    "daily_summary",
    "SELECT category, code, report_date, price::DOUBLE AS price, ema25, sar_buff, trend, rec, financial_healthy, pe_ranking FROM r_sum",
)
def daily_summary(spark: SparkSession, sf: str) -> DataFrame:
    r = run_for(spark, sf, with_text=True)
    return reports.daily_summary(r, reports.daily_long_list(r))


@query(
    "daily_mail",
    f"""
SELECT s.category, s.code, s.price::VARCHAR AS price, s.ema25, coalesce(s.sar_buff || '~' || (round(avg_diff + std_diff, 2)::DECIMAL(9,2))::VARCHAR || '%', 'NULL') AS sar_buff, s.trend, coalesce(s.rec, 'NULL') AS rec,
  coalesce((financial_healthy::DECIMAL(3,2))::VARCHAR, 'NULL') AS financial_healthy, coalesce((pe_ranking::DECIMAL(4,3))::VARCHAR, 'NULL') AS pe_ranking,
  CASE WHEN s.code NOT IN (SELECT code FROM {at_other_day("r_sum", DAY, DAY_BEFORE)}) OR coalesce(s.sar_buff[:-2]::DOUBLE < avg_diff + std_diff, FALSE) THEN 'true' ELSE 'false' END AS watch_point
FROM r_sum s JOIN d_mr m ON s.code = m.code""",
)
def daily_mail(spark: SparkSession, sf: str) -> DataFrame:
    r = run_for(spark, sf, with_text=True)
    today = reports.daily_summary(r, reports.daily_long_list(r))
    before = r.day_before()
    return reports.daily_mail(today, reports.daily_summary(before, reports.daily_long_list(before)), r.ranges)


def _text(*parts: str) -> str:
    return "concat(" + ", ".join(parts) + ")"


def summary_sql(side: str, gap_down: str) -> str:
    stop = f"CASE WHEN s.ud_trend = 'down' THEN round({gap_down}, 3)::DECIMAL(9,3) ELSE round((s.n_sar::DOUBLE / e.price::DOUBLE - 1) * 100, 3)::DECIMAL(9,3) END"
    return f"""
WITH t AS (SELECT * FROM full_{side}), y AS (SELECT category, code, total_ranking, category_ranking FROM {at_other_day("full_" + side, DAY, DAY_BEFORE)}),
l AS (SELECT coalesce(t.category, y.category) AS category, coalesce(t.code, y.code) AS code, t.total_ranking, y.total_ranking AS lt, t.category_ranking, y.category_ranking AS lc FROM t FULL JOIN y ON t.code = y.code)
SELECT {_text("l.category", "'('", "CASE WHEN i.ema25 <= i.ema10 THEN '+' WHEN i.ema25 IS NULL THEN NULL ELSE '-' END", "', '", "CASE WHEN i.h_open <= i.h_close THEN '+' WHEN i.h_open IS NULL THEN NULL ELSE '-' END", "','", "CASE WHEN i.s_open <= i.s_close THEN '-' WHEN i.s_open IS NULL THEN NULL ELSE '+' END", "')'")} AS category,
  l.code, e.price::DOUBLE AS price, {_text("l.total_ranking", "'('", "l.category_ranking", "')/'", "l.lt", "'('", "l.lc", "')'")} AS ranking, e.indicator AS option, h.status, h.sequence AS trend,
  CASE WHEN v.code IS NOT NULL THEN {_text("v.range", "'('", "v.ratio::DECIMAL(9,3)", "')'")} END AS volume,
  CASE WHEN m.code IS NOT NULL THEN {_text("round(avg_diff + std_diff * 1.28, 2)::DECIMAL(9,2)", "'('", "round(avg_range + std_range * 1.28, 2)::DECIMAL(9,2)", "')'")} END AS daily_range,
  CASE WHEN b.code IS NOT NULL THEN {_text("b.nearest_break", "'('", "b.nearest_distance", "')/'", "b.previous_break", "'('", "b.previous_distance", "')'")} END AS short_indicator,
  {_text("CASE WHEN s.ud_trend = 'up' THEN '+' WHEN s.ud_trend = 'down' THEN '-' ELSE '' END", "'('", stop, "'%)'")} AS sar, a.last_anc, l.total_ranking AS rnum, l.category_ranking AS cnum
FROM l LEFT JOIN ix_dir i ON l.category = i.category LEFT JOIN (SELECT * FROM v_ema WHERE load_date = {DAY}) e ON l.code = e.code LEFT JOIN v_seq h ON l.code = h.code LEFT JOIN v_vol v ON l.code = v.code
LEFT JOIN v_sht b ON l.code = b.code LEFT JOIN d_mr m ON l.code = m.code LEFT JOIN v_anc a ON l.code = a.code LEFT JOIN v_sar s ON l.code = s.code"""


@query("long_summary_report", summary_sql("long_end", "(1 - s.n_sar::DOUBLE / e.price::DOUBLE) * 100"))
def long_summary_report(spark: SparkSession, sf: str) -> DataFrame:
    r = run_for(spark, sf, with_text=True)
    return reports.summary_report(r, "long_end", r.full_list("long_end"), r.day_before().full_list("long_end"))


@query(
    "long_summary_page",
    f"SELECT * EXCLUDE (rnum, cnum) FROM ({summary_sql('long_end', '(1 - s.n_sar::DOUBLE / e.price::DOUBLE) * 100')}) WHERE rnum <= 70 AND cnum <= 6",
)
def long_summary_page(spark: SparkSession, sf: str) -> DataFrame:
    r = run_for(spark, sf, with_text=True)
    return reports.summary_page(reports.summary_report(r, "long_end", r.full_list("long_end"), r.day_before().full_list("long_end")))


@query(
    "short_summary_page",
    f"SELECT * EXCLUDE (rnum, cnum) FROM ({summary_sql('short_end', '(s.n_sar::DOUBLE / e.price::DOUBLE - 1) * 100')}) WHERE rnum <= 70 AND cnum <= 6",
)
def short_summary_page(spark: SparkSession, sf: str) -> DataFrame:
    r = run_for(spark, sf, with_text=True)
    return reports.summary_page(reports.summary_report(r, "short_end", r.full_list("short_end"), r.day_before().full_list("short_end")))


@query(
    "index_flags",
    f"""
SELECT c.category, c.load_date, CASE WHEN c.s_close >= p.s_close THEN '+' ELSE '-' END AS daily_perf,
  CASE WHEN p.h_close >= p.h_open THEN '+' ELSE '-' END || CASE WHEN c.h_close >= c.h_open THEN '+' ELSE '-' END AS ha,
  CASE WHEN p.ema10 >= p.ema25 THEN '+' ELSE '-' END || CASE WHEN c.ema10 >= c.ema25 THEN '+' ELSE '-' END AS ema
FROM ix_dir c LEFT JOIN {at_other_day("ix_dir", DAY, DAY_BEFORE)} p ON c.category = p.category""",
)
def index_flags(spark: SparkSession, sf: str) -> DataFrame:
    r = run_for(spark, sf)
    return market_index.index_flags(r.index, r.day_before().index)


_COUNTS = {
    "actionable_list": f"SELECT count(*) FROM s_act WHERE load_date = {DAY}",
    "volume_bands": "SELECT count(*) FROM d_vol",
    "trading_days": "SELECT 1",
    "heikin_ashi": f"SELECT count(*) FROM d_ha WHERE load_date = {DAY}",
    "simple_moving_range": "SELECT count(*) FROM d_mr",
    "ema": f"SELECT count(*) FROM d_ema WHERE load_date = {DAY}",
    "ema_trend": f"SELECT count(*) FROM d_trend WHERE load_date = {DAY}",
    "sar": f"SELECT count(*) FROM d_sar WHERE load_date = {DAY}",
    "index_direction": "SELECT count(*) FROM ix_dir",
    "ha_ema": f"SELECT count(*) FROM h_ema WHERE load_date = {DAY}",
    "macd": f"SELECT count(*) FROM h_macd WHERE load_date = {DAY}",
} | {
    f"{n}_ranking": " + ".join(f"(SELECT count(*) FROM rk_{k}_{s})" for s in rankings.SIDES)
    for n, k in (("ema_on_ha", "ema_ha"), ("ema_on_sar", "ema_sar"), ("ha", "state_ha"), ("sar", "state_sar"), ("stb_on_ha", "stb_ha"), ("stb_on_sar", "stb_sar"))
}


@query(
    "daily_run_counts",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, ({s if s.startswith('SELECT') else 'SELECT ' + s}) AS rows" for n, s in _COUNTS.items()),
)
def daily_run_counts(spark: SparkSession, sf: str) -> DataFrame:
    return run_for(spark, sf).row_counts()
