"""Intraday: ticks to provisional bars, laid over the end-of-day history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.catalog import state
from tapeline.catalog.duck import DAY, ma_sql
from tapeline.catalog.registry import fragment, query
from tapeline.catalog.state import index_sql, run_for
from tapeline.operators.rows import null_to_text
from tapeline.plans import intraday, reports
from tapeline.plans.intraday import CUTOFFS, IntradayRun
from tapeline.plans.loading import typed_ticks
from tapeline.sources import panels

NOW = "2001-07-02"
TODAY = f"DATE '{NOW}'"


def intraday_for(spark: SparkSession, sf: str, cutoff: str = CUTOFFS[0], with_text: bool = False) -> IntradayRun:
    return IntradayRun(run_for(spark, sf, with_text), typed_ticks(panels.web_ticker(spark, sf)), NOW, cutoff)


fragment(
    "k_tick",
    """
SELECT 'Brand#' || (user_id % 25 + 1) AS code, round(value * 100)::BIGINT * 10 * 10000 AS p, date_trunc('second', ts - INTERVAL 8247 DAY) AS tick_ts FROM events""",
)


def bars_sql(cutoff: str) -> str:
    return f"""
SELECT code, tick_ts::DATE AS load_date, max(p) AS h, min(p) AS l,
  (min(epoch(tick_ts)::BIGINT::HUGEINT * 1000000000000 + p) % 1000000000000)::BIGINT AS o, (max(epoch(tick_ts)::BIGINT::HUGEINT * 1000000000000 + p) % 1000000000000)::BIGINT AS c
FROM k_tick WHERE tick_ts::DATE = (SELECT max(tick_ts::DATE) FROM k_tick WHERE isodow(tick_ts) < 6) AND tick_ts::TIME <= TIME '{cutoff}' GROUP BY 1, 2"""


for _i, _c in enumerate(CUTOFFS):
    fragment(f"k_bar{_i}", bars_sql(_c))


@query(
    "intraday_bars",
    " UNION ALL ".join(
        f"SELECT '{c}' AS cutoff, code, load_date, h / 1e4 AS high, l / 1e4 AS low, o / 1e4 AS open, c / 1e4 AS close, (2 * (h + l + c) + 3) // 6 / 1e4 AS typ3, (h + l + o + c + 2) // 4 / 1e4 AS typ4 FROM k_bar{i}"
        for i, c in enumerate(CUTOFFS)
    ),
)
def intraday_bars(spark: SparkSession, sf: str) -> DataFrame:
    ticks = typed_ticks(panels.web_ticker(spark, sf))
    return intraday.bars_by_cutoff(ticks, CUTOFFS)


# Candles of the provisional bar in ten-thousandths.
fragment(
    "k_ha",
    f"""
SELECT b.code, b.load_date, (po + pc) * 10 // 2 AS ho, (o + b.h + b.l + c + 2) // 4 AS hc, b.h, b.l
FROM k_bar0 b JOIN (SELECT code, (open * 1000)::BIGINT AS po, (close * 1000)::BIGINT AS pc FROM d_ha WHERE load_date <= {DAY} QUALIFY row_number() OVER (PARTITION BY code ORDER BY load_date DESC) = 1) p ON b.code = p.code""",
)
fragment(
    "k_cand",
    "SELECT code, load_date, (ho * 0.0001)::DECIMAL(14,4) AS open, (greatest(h, ho, hc) * 0.0001)::DECIMAL(14,4) AS high, (least(l, ho, hc) * 0.0001)::DECIMAL(14,4) AS low, (hc * 0.0001)::DECIMAL(14,4) AS close FROM k_ha",
)


@query("provisional_candles", "SELECT code, load_date, open::DOUBLE AS open, high::DOUBLE AS high, low::DOUBLE AS low, close::DOUBLE AS close FROM k_cand")
def provisional_candles(spark: SparkSession, sf: str) -> DataFrame:
    return intraday_for(spark, sf).candles()


fragment(
    "k_comp",
    f"""
SELECT t.code, {TODAY} AS load_date, {", ".join(f"coalesce(round({c[0]} / 10000.0::DOUBLE / match_price::DOUBLE, 3)::DECIMAL(12,3), t.close) AS {c}" for c in ("open", "low", "high", "close"))}, match_price, weight_ratio
FROM ix_comp t LEFT JOIN k_bar0 r ON t.code = r.code WHERE t.load_date = (SELECT max(load_date) FROM ix_comp)
UNION ALL SELECT code, load_date, open, low, high, close, match_price, weight_ratio FROM ix_comp WHERE load_date <> (SELECT min(load_date) FROM ix_comp)""",
)
index_sql("kx", "k_comp")


@query("provisional_index", "SELECT * FROM kx_dir")
def provisional_index(spark: SparkSession, sf: str) -> DataFrame:
    return intraday_for(spark, sf).index()


def _pm(a: str, b: str) -> str:
    return f"CASE WHEN {a} >= {b} THEN '+' ELSE '-' END"


fragment(
    "kx_flag",
    f"""
SELECT c.category, c.load_date, {_pm('c.s_close', 'p.s_close')} AS daily_perf, {_pm('p.h_close', 'p.h_open')} || {_pm('c.h_close', 'c.h_open')} AS ha, {_pm('p.ema10', 'p.ema25')} || {_pm('c.ema10', 'c.ema25')} AS ema
FROM kx_dir c LEFT JOIN ix_dir p ON c.category = p.category""",
)


@query("intraday_index_report", "SELECT * FROM kx_flag")
def intraday_index_report(spark: SparkSession, sf: str) -> DataFrame:
    return intraday_for(spark, sf).index_report()


def _overlay_ma(prefix: str, history: str, today: str, close: str) -> None:
    fragment(
        f"{prefix}_all",
        f"SELECT code, load_date, close::DECIMAL(14,4) AS close FROM {history} WHERE load_date <= {DAY} UNION SELECT code, load_date, {close} FROM {today}",
    )
    fragment(f"{prefix}_a15", ma_sql(f"{prefix}_all", "close", 4, "w15", 15, "ema"))
    fragment(f"{prefix}_a40", ma_sql(f"{prefix}_all", "close", 4, "w40", 40, "ema"))
    fragment(
        f"{prefix}_ema",
        f"""
SELECT b.code, b.load_date, b.close AS price, x.ema AS ema15, y.ema AS ema40 FROM {prefix}_all b JOIN {prefix}_a15 x ON b.code = x.code AND b.load_date = x.load_date
JOIN {prefix}_a40 y ON b.code = y.code AND b.load_date = y.load_date WHERE b.load_date = {TODAY}""",
    )


_overlay_ma("ko", "d_bars", "k_bar0", "(c * 0.0001)::DECIMAL(14,4)")
_overlay_ma("kh", "d_ha", "k_cand", "close")
_MEANS = "SELECT code, load_date, price::DOUBLE AS price, ema15::DOUBLE AS ema15, ema40::DOUBLE AS ema40 FROM "


@query("provisional_averages", _MEANS + "ko_ema")
def provisional_averages(spark: SparkSession, sf: str) -> DataFrame:
    return intraday_for(spark, sf).ema()


@query("provisional_candle_averages", _MEANS + "kh_ema")
def provisional_candle_averages(spark: SparkSession, sf: str) -> DataFrame:
    return intraday_for(spark, sf).candle_ema()


fragment(
    "km_diff",
    f"SELECT code, load_date, diff FROM h_diff WHERE load_date <= {DAY} UNION SELECT code, load_date, (ema15 - ema40)::DECIMAL(14,4) FROM kh_ema",
)
fragment("km_dea", ma_sql("km_diff", "diff", 4, "w15", 15, "dea"))
fragment("k_macd", f"SELECT d.code, d.load_date, d.diff, e.dea FROM km_diff d JOIN km_dea e ON d.code = e.code AND d.load_date = e.load_date WHERE d.load_date = {TODAY}")


@query("provisional_macd", "SELECT code, load_date, diff::DOUBLE AS diff, dea::DOUBLE AS dea FROM k_macd")
def provisional_macd(spark: SparkSession, sf: str) -> DataFrame:
    return intraday_for(spark, sf).macd()


fragment(
    "k_sw",
    f"""
SELECT code, load_date, close, g, lag(g) OVER w AS b, lead(g) OVER w AS n FROM (
  SELECT code, load_date, close, open <= close AS g FROM d_ha WHERE load_date <= {DAY} AND load_date > {TODAY} - 336 UNION ALL SELECT code, load_date, close, open <= close FROM k_cand)
WINDOW w AS (PARTITION BY code ORDER BY load_date)""",
)


def _points(up: bool) -> str:
    own, other = ("TRUE", "FALSE") if up else ("FALSE", "TRUE")
    return f"""
SELECT x.code, x.rk, {'max' if up else 'min'}(t.close) AS p FROM (
  SELECT *, row_number() OVER (PARTITION BY code ORDER BY exit_date DESC, entry_date DESC) AS rk FROM (
    SELECT i.code, i.load_date AS entry_date, min(o.load_date) AS exit_date FROM k_sw i JOIN k_sw o ON i.code = o.code AND o.load_date > i.load_date
    WHERE i.g = {own} AND i.b = {other} AND o.g = {own} AND o.n = {other} GROUP BY 1, 2)) x
JOIN k_sw t ON x.code = t.code AND t.load_date BETWEEN x.entry_date AND x.exit_date WHERE x.rk <= 2 GROUP BY 1, 2"""


fragment("k_hi", _points(True))
fragment("k_lo", _points(False))


@query(
    "swing_trend",
    f"""
SELECT h1.code, {TODAY} AS load_date, CASE WHEN h1.p > h2.p THEN 'i' ELSE 'd' END AS trend FROM k_hi h1 JOIN k_hi h2 ON h1.code = h2.code AND h1.rk = 1 AND h2.rk = 2
JOIN k_lo l1 ON h1.code = l1.code AND l1.rk = 1 JOIN k_lo l2 ON h1.code = l2.code AND l2.rk = 2 WHERE h1.p > h2.p AND l1.p > l2.p OR h1.p < h2.p AND l1.p < l2.p""",
)
def swing_trend(spark: SparkSession, sf: str) -> DataFrame:
    return intraday_for(spark, sf).trend()


def _compare(history: str, today: str, cols: tuple[str, str]) -> str:
    picks = ", ".join(f"{c}::DOUBLE AS current_{c}, lag({c}, 1) OVER w::DOUBLE AS last_{c}, lag({c}, 2) OVER w::DOUBLE AS previous_{c}" for c in cols)
    both = ", ".join(cols)
    return f"""
SELECT * FROM (SELECT code, load_date, {picks} FROM (SELECT code, load_date, {both} FROM {history} WHERE load_date <= {DAY} AND load_date > {TODAY} - 28 UNION ALL SELECT code, load_date, {both} FROM {today})
WINDOW w AS (PARTITION BY code ORDER BY load_date)) WHERE load_date = {TODAY}"""


fragment("kc_ha", _compare("d_ha", "k_cand", ("open", "close")))
fragment("kc_macd", _compare("h_macd", "k_macd", ("diff", "dea")))


@query("candle_comparison", "SELECT * FROM kc_ha")
def candle_comparison(spark: SparkSession, sf: str) -> DataFrame:
    return intraday_for(spark, sf).candle_comparison()


@query("macd_comparison", "SELECT * FROM kc_macd")
def macd_comparison(spark: SparkSession, sf: str) -> DataFrame:
    return intraday_for(spark, sf).macd_comparison()


_OVER = "(r.h / 1e4 > s.{n} AND s.{t} = 'down')"
_O2, _O3 = _OVER.format(n="n_sar2", t="ud_trend2"), _OVER.format(n="n_sar3", t="ud_trend3")


def _d2(expr: str) -> str:
    return f"(round({expr}, 2)::DECIMAL(9,2))::VARCHAR"


fragment(
    "k_list",
    f"""
SELECT c.category, r.code, r.load_date, round((l.turnover + l.popularity) / 2.0, 1)::DOUBLE AS popularity,
  CASE WHEN {_O2} AND {_O3} THEN '$' || n_sar2 || '~$' || n_sar3 WHEN {_O2} THEN '$' || n_sar2 || '~-' ELSE '-~$' || n_sar3 END AS sar,
  '(' || quarterly_direction || '~' || semester_direction || ',' || quarterly_stability || '~' || semester_stability || ')' AS trend,
  CASE WHEN e.code IS NOT NULL THEN 0 WHEN g.n < 10 THEN g.n ELSE -1 END AS reporting_date,
  {_d2('avg_diff * 2 - std_diff')} || '%~' || {_d2('avg_diff * 2')} || '%~' || {_d2('avg_diff * 2 + std_diff')} || '%' AS expect_ratio, a.rec, a.financial_healthy, a.pe_ranking
FROM k_bar0 r JOIN d_sar23 s ON r.code = s.code AND s.load_date = {DAY} JOIN s_act l ON r.code = l.code AND l.load_date = {DAY} AND (l.turnover <> 4 OR l.popularity <> 4)
JOIN r_long x ON r.code = x.code AND (quarterly_direction <> 0 OR semester_direction <> 0) JOIN d_cat c ON r.code = c.code JOIN d_mr m ON r.code = m.code
LEFT JOIN (SELECT DISTINCT code FROM t_anc WHERE pub_datetime::DATE = {TODAY} AND pub_datetime < {TODAY} + INTERVAL 10 HOUR) e ON r.code = e.code
LEFT JOIN (SELECT a.code, min(i.rnum) AS n FROM t_anc a JOIN u_idx i ON a.pub_datetime::DATE = i.load_date GROUP BY 1) g ON r.code = g.code
LEFT JOIN v_ana a ON r.code = a.code WHERE {_O2} OR {_O3}""",
)


def _break_list(spark: SparkSession, sf: str) -> DataFrame:
    run = intraday_for(spark, sf, CUTOFFS[0], with_text=True)
    return intraday.break_list(run.run, reports.daily_long_list(run.run), run.bars, NOW)


@query("break_list", "SELECT * FROM k_list")
def break_list(spark: SparkSession, sf: str) -> DataFrame:
    return _break_list(spark, sf)


@query(
    "break_list_text",
    "SELECT * REPLACE (coalesce(rec, 'NULL') AS rec, coalesce((financial_healthy::DECIMAL(3,2))::VARCHAR, 'NULL') AS financial_healthy, coalesce((pe_ranking::DECIMAL(4,3))::VARCHAR, 'NULL') AS pe_ranking) FROM k_list",
)
def break_list_text(spark: SparkSession, sf: str) -> DataFrame:
    return null_to_text(_break_list(spark, sf), ["rec", "financial_healthy", "pe_ranking"])


# The newest candle on the overlay, with the distance of its last colour change.
fragment("ka_ha", f"SELECT code, load_date, open, high, low, close FROM d_ha WHERE load_date <= {DAY} UNION ALL SELECT code, load_date, open, high, low, close FROM k_cand")
fragment("ka_up", "SELECT *, open <= close AS up, lag(open <= close) OVER (PARTITION BY code ORDER BY load_date) AS pup FROM ka_ha")
fragment(
    "ka_seq",
    f"""
SELECT c.code, i.rnum AS sequence, {state._STATUS} AS status FROM ka_up c JOIN (SELECT code, max(load_date) AS day FROM ka_up WHERE up <> pup GROUP BY 1) t ON c.code = t.code
JOIN (SELECT load_date, row_number() OVER (ORDER BY load_date DESC) AS rnum FROM (SELECT DISTINCT load_date FROM ka_ha)) i ON i.load_date = t.day WHERE c.load_date = (SELECT max(load_date) FROM ka_ha)""",
)


def _marks(up: str, down: str) -> str:
    return f"""CASE WHEN s.ud_trend = 'down' AND s.n_sar <= r.h / 1e4 THEN '{down}{up}' WHEN s.ud_trend = 'down' THEN '{down}{down}'
  WHEN s.ud_trend = 'up' AND s.n_sar > r.l / 1e4 THEN '{up}{down}' WHEN s.ud_trend = 'up' THEN '{up}{up}' ELSE '' END"""


_SHORT = "t.nearest_break || '(' || t.nearest_distance || ')/' || t.previous_break || '(' || t.previous_distance || ')'"


def report_sql(side: str) -> str:
    return f"""
SELECT concat(l.category, '(', i.daily_perf, ',', i.ema, ',', i.ha, ')') AS category, l.code || '(' || strftime(l.last_update_date, '%m-%d') || ')' AS code, l.total_ranking || '(' || l.category_ranking || ')' AS ranking,
  e.price::DOUBLE AS current_price, CASE WHEN e.code IS NULL THEN NULL WHEN e.ema15 >= e.ema40 THEN 'BUY' ELSE 'SELL' END AS option, concat(h.status, '(', h.sequence, ')') AS status, {_marks('+', '-')} AS sar,
  {_SHORT} AS short_indicator, a.last_anc, r.load_date
FROM full_{side} l JOIN k_bar0 r ON l.code = r.code LEFT JOIN kx_flag i ON l.category = i.category LEFT JOIN ko_ema e ON l.code = e.code LEFT JOIN ka_seq h ON l.code = h.code
LEFT JOIN v_sar s ON l.code = s.code LEFT JOIN v_sht t ON l.code = t.code LEFT JOIN v_anc a ON l.code = a.code WHERE l.total_ranking <= 40 AND l.category_ranking <= 4"""


@query("intraday_long_report", report_sql("long_end"))
def intraday_long_report(spark: SparkSession, sf: str) -> DataFrame:
    return intraday_for(spark, sf, with_text=True).report("long_end")


@query("intraday_short_report", report_sql("short_end"))
def intraday_short_report(spark: SparkSession, sf: str) -> DataFrame:
    return intraday_for(spark, sf, with_text=True).report("short_end")


def conversion_sql(side: str) -> str:
    rising = side == "long_end"

    def above(a: str, b: str) -> str:
        return f"({a} >= {b})" if rising else f"({a} < {b})"

    g = {k: f"({k}_diff - {k}_dea)" for k in ("current", "last", "previous")}
    op = "<" if rising else ">="
    flags = {
        "mt": f"{above('current_diff', 'current_dea')} AND NOT {above('last_diff', 'last_dea')}",
        "mr": f"{above(g['current'], g['last'])} AND {above(g['last'], g['previous'])}",
        "me": f"{above(g['current'], g['last'])} AND NOT {above(g['last'], g['previous'])}",
        "ht": f"{above('current_close', 'current_open')} AND NOT {above('last_close', 'last_open')}",
        "hr": f"previous_close {op} last_close AND last_close {op} current_close AND (NOT {above('previous_close', 'previous_open')} OR NOT {above('last_close', 'last_open')}) AND {above('current_close', 'current_open')}",
        "he": f"{above('current_close', 'last_close')} AND NOT {above('last_close', 'previous_close')}",
    }

    def kind(a: str, b: str) -> str:
        return f"CASE WHEN {a} AND {b} THEN 'BOTH' WHEN {a} THEN 'HA' WHEN {b} THEN 'MACD' ELSE '' END"

    return f"""
WITH x AS (SELECT l.*, r.h, r.l, CASE WHEN i.h_close >= i.h_open THEN '+' ELSE '-' END AS iha, CASE WHEN i.ema10 >= i.ema25 THEN '+' ELSE '-' END AS iema, {", ".join(f"coalesce({v}, FALSE) AS {k}" for k, v in flags.items())},
  t.nearest_break, t.previous_break, t.nearest_distance, t.previous_distance
  FROM full_{side} l JOIN k_bar0 r ON l.code = r.code JOIN kx_dir i ON l.category = i.category JOIN kc_macd m ON l.code = m.code JOIN kc_ha h ON l.code = h.code JOIN v_sht t ON l.code = t.code
  WHERE l.total_ranking <= 40 AND l.category_ranking <= 4)
SELECT r.category || '(' || iha || ',' || iema || ')' AS category, r.code || '(' || strftime(last_update_date, '%m-%d') || ')' AS code,
  row_number() OVER (PARTITION BY r.category ORDER BY category_ranking) || '(' || category_ranking || ', ' || total_ranking || ')' AS ranking,
  {kind('ht', 'mt')} AS conversion_type, {kind('hr', 'mr')} AS trend_type, {kind('he', 'me')} AS edge_type, {_SHORT.replace('t.', 'r.')} AS short_indicator, {_marks(chr(1784), chr(1783))} AS sar, a.last_anc
FROM x r LEFT JOIN v_sar s ON r.code = s.code LEFT JOIN v_anc a ON r.code = a.code WHERE ht OR mt"""


@query("conversion_long_report", conversion_sql("long_end"))
def conversion_long_report(spark: SparkSession, sf: str) -> DataFrame:
    return intraday_for(spark, sf, with_text=True).conversion_report("long_end")


@query("conversion_short_report", conversion_sql("short_end"))
def conversion_short_report(spark: SparkSession, sf: str) -> DataFrame:
    return intraday_for(spark, sf, with_text=True).conversion_report("short_end")
