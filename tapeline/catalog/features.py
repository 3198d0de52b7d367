"""Feature families, market indicators and training sets on the weekly panel."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.catalog.registry import FRAGMENTS, ORACLES, fragment, query
from tapeline.plans import eavt, features, market_features
from tapeline.plans.daily import calendar
from tapeline.plans.features import FAMILIES, MEDIAN_PLACE, SPANS
from tapeline.plans.market_features import SERIES
from tapeline.sources import panels
from tapeline.sources.files import table
from tapeline.staging import stage

CAP = 10
UNIVERSE = 25


def panel(spark: SparkSession, sf: str) -> DataFrame:
    """The weekly panel with its date index, written once: every family reads it."""
    tx = stage(panels.transactions(spark, sf, "week"))
    return tx.join(calendar(tx).select("load_date", "date_index"), "load_date")


fragment(
    "w_tx",
    """
SELECT code, load_date, dense_rank() OVER (ORDER BY load_date) AS date_index, (o * 0.01)::DECIMAL(12,3) AS market_open,
  (lag(c) OVER (PARTITION BY code ORDER BY load_date) * 0.01)::DECIMAL(12,3) AS market_previous_close, (h * 0.01)::DECIMAL(12,3) AS market_day_high, (l * 0.01)::DECIMAL(12,3) AS market_day_low,
  (c * 0.01)::DECIMAL(12,3) AS market_price, v AS market_volume, (r0 + r1 + r2 + r3 + r4) % 12 AS number_of_analyst,
  CASE WHEN v % 23 <> 0 THEN round((r0 + 2 * r1 + 3 * r2 + 4 * r3 + 5 * r4)::DOUBLE / (r0 + r1 + r2 + r3 + r4), 3) END AS recommendation_mean,
  CASE WHEN v % 11 <> 0 THEN (((o + h) % 900) * 0.1)::DECIMAL(8,1) END AS forward_pe, v * 1000 AS average_volume, s * 100 + 1 AS short_position, v * 100 AS total_in_issue,
  round(s::DOUBLE / v * 100, 3)::DECIMAL(8,3) AS reported_position, CASE WHEN v % 3 = 0 THEN r0 % 4 END AS mi_buy, CASE WHEN v % 3 = 0 THEN r1 % 4 END AS mi_hold, CASE WHEN v % 3 = 0 THEN r2 % 4 END AS mi_sell,
  row_number() OVER (PARTITION BY code ORDER BY load_date) AS rn
FROM w_base""",
)


# --- SQL pieces -------------------------------------------------------------------------


def sq(x: str, p: int = 3) -> str:
    return f"(round(2 / (1 + exp(-({x}))) - 1, {p})::DECIMAL(9,{p}))::DOUBLE"


def rank(key: str) -> str:
    return f"row_number() OVER (PARTITION BY date_index ORDER BY {key}, code)"


def mean(c: str, n: int, by: str = "PARTITION BY code ORDER BY date_index") -> str:
    w = f"OVER ({by} ROWS {n - 1} PRECEDING)"
    return f"CASE WHEN count({c}) {w} = {n} THEN sum({c}) {w}::DOUBLE / {n} END"


def kth(c: str, n: int, by: str = "PARTITION BY code ORDER BY date_index") -> str:
    return f"list_sort(list({c}) FILTER (WHERE {c} IS NOT NULL) OVER ({by} ROWS {n - 1} PRECEDING))[{MEDIAN_PLACE[n]}]"


def scale_sql(source: str, values: list, ratios: list, diffs: list, keys: str = "code, load_date, date_index") -> str:
    measured = [(v, v) for v in values] + [(n, f"({a} - {b})") for n, a, b in diffs]
    params = ", ".join(f"min({e})::DOUBLE AS mn_{n}, avg({e})::DOUBLE AS av_{n}" for n, e in measured)
    scaled = ", ".join(f"({e}::DOUBLE - mn_{n}) / nullif(av_{n} - mn_{n}, 0) AS x_{n}" for n, e in measured)
    flat = ", ".join(f"mn_{n} = av_{n} AS fl_{n}" for n, _, _ in diffs)
    out = [f"{sq('x_' + v)} AS {v}" for v in values]
    out += [f"CASE WHEN x_{b} = 0 THEN 1 ELSE {sq(f'x_{a} / x_{b}')} END AS {n}" for n, a, b in ratios]
    out += [f"CASE WHEN fl_{n} THEN 1 ELSE {sq('x_' + n)} END AS {n}" for n, _, _ in diffs]
    return f"""
WITH pr AS (SELECT {params} FROM {source}), sc AS (SELECT {keys}, {scaled}{', ' + flat if flat else ''} FROM {source}, pr)
SELECT {keys}, {", ".join(out)} FROM sc"""


def slopes(source: str, c: str, out: str, spans: tuple = (5, 10, 20), keep: str = "") -> str:
    """Slopes by joining each row with its last n rows and regressing."""
    base = f"(SELECT code, date_index{keep}, rn, {c}::DOUBLE AS v, {mean(c, 20)} AS m FROM {source})"
    parts = []
    for n in spans:
        parts.append(
            f"""(SELECT a.code, a.date_index, regr_slope(round((b.v - o.v) / nullif(a.m, 0), 7), (b.rn - a.rn + {n - 1})::DOUBLE) AS s FROM x a JOIN x o ON a.code = o.code AND o.rn = a.rn - {n - 1}
  JOIN x b ON a.code = b.code AND b.rn BETWEEN a.rn - {n - 1} AND a.rn WHERE a.m IS NOT NULL GROUP BY 1, 2) s{n:02d}"""
        )
    joins = " ".join(f"LEFT JOIN {p} ON x.code = s{n:02d}.code AND x.date_index = s{n:02d}.date_index" for n, p in zip(spans, parts, strict=True))
    cols = ", ".join(f"s{n:02d}.s AS {out}_{n:02d}" for n in spans)
    return f"WITH x AS {base} SELECT x.code, x.date_index, {cols} FROM x {joins}"


# --- families ---------------------------------------------------------------------------

fragment(
    "f_inc",
    f"""
SELECT *, {rank('irv DESC')}::DECIMAL(18,6) AS irr FROM (SELECT code, load_date, date_index, CASE WHEN market_open > 0 THEN round(((market_price - market_open) * 100)::DOUBLE / market_open::DOUBLE, 6)::DECIMAL(18,6) ELSE -100 END AS irv FROM w_tx)""",
)
_IR = [(k, c, n) for k in ("avg", "mdn") for c in ("irv", "irr") for n in SPANS]


def _ir_key(k: str, c: str, n: int) -> str:
    col = f"{k}_{c}_{n:02d}"
    col = f"coalesce({col}, -100)" if k == "mdn" else col
    return f"{col} DESC NULLS FIRST" if c == "irv" else f"{col} ASC NULLS LAST"


fragment(
    "f_ir0",
    "SELECT code, load_date, date_index, " + ", ".join(f"{mean(c, n) if k == 'avg' else kth(c, n)} AS {k}_{c}_{n:02d}" for k, c, n in _IR) + " FROM f_inc",
)
fragment(
    "f_ir",
    "SELECT code, load_date, date_index, "
    + ", ".join(f"round({k}_{c}_{n:02d}, 4) AS {k}_{c}_vl_{n:02d}, {rank(_ir_key(k, c, n))} AS {k}_{c}_rk_{n:02d}" for k, c, n in _IR)
    + " FROM f_ir0",
)
fragment("f_mp0", slopes("w_tx", "market_price", "slope_value"))
fragment(
    "f_mp",
    "SELECT t.code, t.load_date, t.date_index, slope_value_05, slope_value_10, slope_value_20, "
    + ", ".join(f"row_number() OVER (PARTITION BY t.date_index ORDER BY round(slope_value_{n:02d}, 9) DESC NULLS FIRST, t.code) AS slope_rank_{n:02d}" for n in (5, 10, 20))
    + " FROM w_tx t JOIN f_mp0 s ON t.code = s.code AND t.date_index = s.date_index",
)
fragment(
    "f_pe0", "SELECT code, load_date, date_index, " + ", ".join(f"{kth('pe', n)} AS mdn_pe_vl_{n:02d}" for n in SPANS) + " FROM (SELECT *, coalesce(forward_pe, -999) AS pe FROM w_tx)"
)
fragment("f_pe", "SELECT *, " + ", ".join(f"{rank(f'mdn_pe_vl_{n:02d} DESC NULLS FIRST')} AS mdn_pe_rk_{n:02d}" for n in SPANS) + " FROM f_pe0")

fragment(
    "f_rsv",
    """
SELECT code, load_date, date_index, rn, CASE WHEN top <= down THEN 0 ELSE (market_price - down)::DOUBLE / (top - down)::DOUBLE END AS rsv FROM (
  SELECT *, max(market_day_high) OVER w AS top, min(market_day_low) OVER w AS down FROM w_tx WINDOW w AS (PARTITION BY code ORDER BY date_index ROWS 4 PRECEDING))""",
)
_KIND = "(" + " + ".join([f"{2.0**5 / 3.0**6!r}"] + [f"{2.0**i / 3.0 ** (i + 1)!r} * {'rsv' if i == 0 else f'lag(rsv, {i}) OVER (PARTITION BY code ORDER BY date_index)'}" for i in (4, 3, 2, 1, 0)]) + ") * 1.09625::DOUBLE"
fragment("f_kind", f"SELECT code, load_date, date_index, round(rsv, 4)::DECIMAL(10,4) AS rsv, round({_KIND}, 4)::DECIMAL(10,4) AS kind FROM f_rsv")
fragment(
    "f_rk0",
    "SELECT code, load_date, date_index, " + ", ".join(f"{kth('rsv', n)} AS rsv_vl_mdn_{n:02d}, {kth('kind', n)} AS ki_{n:02d}" for n in (3, 5, 10)) + " FROM f_kind",
)
fragment(
    "f_rk",
    "SELECT code, load_date, date_index, "
    + ", ".join(
        f"rsv_vl_mdn_{n:02d}, {rank(f'rsv_vl_mdn_{n:02d} NULLS LAST')} AS rsv_rk_mdn_{n:02d}, CASE WHEN ki_{n:02d} >= 1 THEN 0.999 ELSE ki_{n:02d}::DECIMAL(5,3) END AS ki_vl_mdn_{n:02d}, {rank(f'ki_{n:02d} NULLS LAST')} AS ki_rk_mdn_{n:02d}"
        for n in (3, 5, 10)
    )
    + " FROM f_rk0",
)
fragment(
    "f_ss", "SELECT code, load_date, date_index, rn, round(short_position::DOUBLE / average_volume, 3)::DECIMAL(12,3) AS ss, reported_position AS rp FROM w_tx"
)
fragment("f_st0", "SELECT code, load_date, date_index, " + ", ".join(f"{kth(c, n)} AS {c}_{n:02d}" for c in ("ss", "rp") for n in (3, 5, 10)) + " FROM f_ss")
fragment(
    "f_st",
    "SELECT code, load_date, date_index, " + ", ".join(f"{rank(f'{c}_{n:02d} NULLS LAST')} AS mdn_{c}_rk_{n:02d}" for c in ("ss", "rp") for n in (3, 5, 10)) + " FROM f_st0",
)


def strength_sql(base: str, newest: bool) -> str:
    """Lags of the strength, kept where the date index has no gap over all of them."""
    first, reach = (0, 19) if newest else (1, 20)

    def back(n: int) -> str:
        terms = [f"{'s' if i + first == 0 else f's{i + first}'} * {float(n - i if newest else i + 1)!r}::DOUBLE" for i in range(n)]
        return "(" + " + ".join(terms) + f") / {n * (n + 1) / 2!r}::DOUBLE / vol"

    now = "s / vol" if newest else "s"
    lags = ", ".join(f"lag(s, {i}) OVER w AS s{i}" for i in range(1, reach + 1))
    return f"""
SELECT code, date_index, {now} AS strength00, {back(5)} AS strength05, {back(10)} AS strength10, {back(20)} AS strength20 FROM (
  SELECT *, {lags}, lag(date_index, {reach}) OVER w AS first FROM (
    SELECT code, date_index, average_volume::DOUBLE AS vol, market_volume::DOUBLE * (market_price::DOUBLE - {base}::DOUBLE) / {base}::DOUBLE AS s FROM w_tx WHERE {base} <> 0)
  WINDOW w AS (PARTITION BY code ORDER BY date_index)) WHERE date_index - first = {reach}"""


fragment("f_sg0", strength_sql("market_open", True))
fragment(
    "f_sg",
    "SELECT t.code, t.load_date, t.date_index, "
    + ", ".join(f"strength_{n:02d}, rank_{n:02d}" for n in (5, 10, 20))
    + " FROM w_tx t LEFT JOIN (SELECT code, date_index, "
    + ", ".join(f"round(strength{n:02d}, 6) AS strength_{n:02d}, {rank(f'strength{n:02d} DESC NULLS FIRST')} AS rank_{n:02d}" for n in (5, 10, 20))
    + " FROM f_sg0) s ON t.code = s.code AND t.date_index = s.date_index",
)

_FAMILY_NAMES = {
    "ir": "features_of_change",
    "mp": "features_of_price_slope",
    "pe": "features_of_earnings",
    "rk": "features_of_range_position",
    "st": "features_of_short_interest",
    "sg": "features_of_trading_strength",
}
for _key, _name in _FAMILY_NAMES.items():
    _, _values, _ratios, _diffs = FAMILIES[_key]
    fragment(f"z_{_key}", scale_sql(f"f_{_key}", _values, _ratios, _diffs))


def _register_family(key: str, name: str) -> None:
    @query(name, f"SELECT * FROM z_{key}")
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return features.family(panel(spark, sf), key)


for _key, _name in _FAMILY_NAMES.items():
    _register_family(_key, _name)


# --- older families ---------------------------------------------------------------------


def fl(x: str) -> str:
    return f"CASE WHEN round({x}, 3) = 0 THEN 0.001 ELSE round({x}, 3) END"


def sg(x: str) -> str:
    return f"1 / (1 + exp(-({x})))"


def quot(stem: str, out: str, spans: tuple, shape) -> str:
    pairs = [(a, b) for i, a in enumerate(spans) for b in spans[i + 1 :]]
    return ", ".join(f"(round({shape(f'({stem}{a}::DOUBLE / {stem}{b}::DOUBLE)')}, 3)::DECIMAL(9,3))::DOUBLE AS {out}_{a}{b}" for a, b in pairs)


def _dbl(x: str) -> str:
    return f"2 * ({sg(x)}) - 1"


_PC = "CASE WHEN market_previous_close > 0 THEN round(((market_price - market_previous_close) * 100)::DOUBLE / market_previous_close::DOUBLE, 6)::DECIMAL(18,6) ELSE -100 END"
fragment(
    "g_inc",
    f"SELECT *, {quot('inc', 'divided_inc', ('03', '05', '10', '20'), _dbl)} FROM (SELECT code, date_index, "
    + ", ".join(f"{fl(sg(f'm{n:02d} * 0.3::DOUBLE'))} AS inc{n:02d}" for n in (0, *SPANS))
    + " FROM (SELECT code, date_index, irv::DOUBLE AS m00, "
    + ", ".join(f"{mean('irv', n)} AS m{n:02d}" for n in SPANS)
    + f" FROM (SELECT code, date_index, {_PC} AS irv FROM w_tx)) WHERE date_index >= 20)",
)


def _pe_scale(x: str) -> str:
    return fl(sg(f"({x} - 15)::DOUBLE * 0.1::DOUBLE"))


fragment(
    "g_pe",
    f"SELECT *, {quot('pe_mdn', 'divided_pe', ('03', '05', '10', '20'), lambda x: sg(f'(CASE WHEN {x} > 10 THEN 10 WHEN {x} < -10 THEN -10 ELSE {x} END - 1) * 80'))} FROM (SELECT code, date_index, {_pe_scale('pe')} AS pe_cur, "
    + ", ".join(f"{_pe_scale(f'p{n:02d}')} AS pe_mdn{n:02d}" for n in SPANS)
    + " FROM (SELECT code, date_index, pe, "
    + ", ".join(f"{kth('pe', n)} AS p{n:02d}" for n in SPANS)
    + " FROM (SELECT *, coalesce(forward_pe, -999) AS pe FROM w_tx)))",
)
fragment(
    "g_slope",
    f"SELECT *, {quot('slope', 'divided_slope', ('05', '10', '20'), _dbl)} FROM (SELECT code, date_index, "
    + ", ".join(f"{fl(sg(f'slope_value_{n:02d} * 50'))} AS slope{n:02d}" for n in (5, 10, 20))
    + " FROM f_mp0)",
)
_POS = "CASE WHEN market_day_high <= market_day_low THEN 0 ELSE (market_price - market_day_low)::DOUBLE / (market_day_high - market_day_low)::DOUBLE END"
fragment(
    "f_pr",
    f"SELECT code, load_date, date_index, round(CASE WHEN raw > 1 THEN 1 WHEN raw < 0 THEN 0 ELSE raw END, 3) AS price_ratio, {rank('raw DESC')} AS rank FROM (SELECT *, {_POS} AS raw FROM w_tx)",
)


def _exact_mean(n: int) -> str:
    w = f"OVER (PARTITION BY code ORDER BY date_index ROWS {n - 1} PRECEDING)"
    s = f"sum(round(price_ratio * 1000)::BIGINT) {w}"
    return f"CASE WHEN count(*) {w} = {n} THEN CASE WHEN (2 * {s} + {n}) // {2 * n} = 0 THEN 0.001 ELSE ((2 * {s} + {n}) // {2 * n}) / 1000.0 END END"


fragment(
    "g_pr",
    f"SELECT *, {quot('pr', 'divided_pr', ('03', '05', '10', '20'), lambda x: sg(f'{x} * 5 - 5'))} FROM (SELECT code, date_index, price_ratio AS pr00, "
    + ", ".join(f"({_exact_mean(n)})::DOUBLE AS pr{n:02d}" for n in SPANS)
    + " FROM f_pr)",
)
fragment("f_sp0", strength_sql("market_previous_close", True))
fragment(
    "g_sg",
    f"SELECT *, {quot('strength', 'divided_strength', ('00', '05', '10', '20'), _dbl)} FROM (SELECT code, date_index, "
    + ", ".join(f"{fl(sg(f'strength{n:02d} * 50'))} AS strength{n:02d}" for n in (0, 5, 10, 20))
    + " FROM f_sp0)",
)
fragment(
    "g_k",
    f"SELECT *, {quot('k', 'divided_k', ('03', '05', '10'), lambda x: sg(f'{x} * 5 - 5'))} FROM (SELECT code, date_index, ki_vl_mdn_03::DOUBLE AS k03, ki_vl_mdn_05::DOUBLE AS k05, ki_vl_mdn_10::DOUBLE AS k10 FROM f_rk)",
)
fragment("f_sls", slopes("f_ss", "ss", "ss"))
fragment("f_slp", slopes("f_ss", "rp", "sp"))
fragment(
    "g_short",
    f"SELECT *, {quot('sp', 'divided_slope_sp', ('05', '10', '20'), _dbl)}, {quot('ss', 'divided_slope_ss', ('05', '10', '20'), _dbl)} FROM (SELECT a.code, a.date_index, "
    + ", ".join(f"{fl(sg(f'{p}_{n:02d} * 50'))} AS {p}{n:02d}" for p in ("sp", "ss") for n in (5, 10, 20))
    + " FROM f_sls a JOIN f_slp b ON a.code = b.code AND a.date_index = b.date_index)",
)


def _rounded_means(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(F.col(c).cast("double"), 8).alias(c) if "_avg" in c else F.col(c) for c in df.columns])


def _register(name: str, sql: str, make) -> None:
    @query(name, sql)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return make(panel(spark, sf))


_register("older_change_features", "SELECT * FROM g_inc", features.draft_increase)
_register("older_earnings_features", "SELECT * FROM g_pe", features.draft_pe)
_register("older_slope_features", "SELECT * FROM g_slope", features.draft_slope)
_register("price_position", "SELECT * FROM f_pr", features.price_position)
_register("older_price_features", "SELECT * FROM g_pr", features.draft_price)
_register("older_strength_features", "SELECT * FROM g_sg", features.draft_strength)
_register("older_k_features", "SELECT * FROM g_k", features.draft_k)
_register("short_slopes", "SELECT * FROM g_short", features.short_slopes)
_register(
    "short_strength_scaled",
    f"SELECT code, load_date, date_index, (round((({sg('r * 0.1::DOUBLE')}) - 0.5) * 2, 2)::DECIMAL(5,2))::DOUBLE AS short_strength FROM (SELECT *, round(short_position::DOUBLE / average_volume, 2) AS r FROM w_tx)",
    features.short_strength_scaled,
)
_register(
    "ask_bid",
    """
SELECT code, load_date, date_index, CASE WHEN x < 0 THEN 0 ELSE x END AS split_ratio, CASE WHEN a < p OR a < b THEN 0 WHEN b - a <> 0 THEN round((a - p) / (a - b), 5) END AS ask_strength FROM (
  SELECT *, CASE WHEN p <> 0 THEN round((a - b) / p, 5) WHEN a - b <> 0 THEN round((a - b) / (a + b) / 2, 5) ELSE 0 END AS x FROM (
    SELECT *, market_day_high::DOUBLE AS a, market_day_low::DOUBLE AS b, market_price::DOUBLE AS p FROM w_tx))""",
    features.ask_bid,
)
fragment("g_chg", f"SELECT *, {rank('irv DESC')}::DECIMAL(18,6) AS irr FROM (SELECT code, load_date, date_index, {_PC} AS irv FROM w_tx)")


def _frame(fn: str, c: str, n: int) -> str:
    return f"{fn}({c}) OVER (PARTITION BY code ORDER BY date_index ROWS {n - 1} PRECEDING)::DOUBLE"


_register(
    "change_extremes",
    "SELECT * FROM (SELECT code, load_date, date_index, "
    + ", ".join(f"{_frame('max', c, n)} AS {c}_grt{n:02d}, {_frame('min', c, n)} AS {c}_lst{n:02d}, round({mean(c, n)}, 8) AS {c}_avg{n:02d}" for c in ("irv", "irr") for n in SPANS)
    + " FROM g_chg) WHERE date_index > 20",
    lambda tx: _rounded_means(features.change_extremes(tx)),
)
fragment(
    "f_rank",
    f"""
SELECT *, round(pe_rank::DOUBLE / {UNIVERSE}, 3) AS pe_share, CASE WHEN count(*) OVER w = 6 THEN round(sum(pe_rank) OVER w::DOUBLE / {UNIVERSE * 5}, 3) END AS avg_pe_share FROM (
  SELECT code, load_date, date_index, {rank('market_volume DESC NULLS FIRST')} AS volume_rank, {rank('coalesce(forward_pe, -999) DESC')} AS pe_rank, {rank('irv DESC')} AS increase_rank, irv::DOUBLE AS increase_ratio
  FROM (SELECT *, {_PC} AS irv FROM w_tx)) WINDOW w AS (PARTITION BY code ORDER BY date_index ROWS 5 PRECEDING)""",
)
_register("simple_ranks", "SELECT * FROM f_rank", lambda tx: features.simple_ranks(tx, UNIVERSE))

fragment(
    "f_klong",
    "SELECT * FROM (SELECT code, load_date, date_index, "
    + " + ".join([f"{0.5 * (2.0**10 / 3.0**10)!r}"] + [f"{2.0 ** (i - 1) / 3.0**i!r} * lag(rsv, {i}) OVER (PARTITION BY code ORDER BY date_index)" for i in range(10, 0, -1)])
    + """ AS kind FROM (SELECT code, load_date, date_index, CASE WHEN top <= down THEN 0 ELSE (market_previous_close - down)::DOUBLE / (top - down)::DOUBLE END AS rsv FROM (
  SELECT *, max(market_day_high) OVER w AS top, min(market_day_low) OVER w AS down FROM w_tx WINDOW w AS (PARTITION BY code ORDER BY date_index ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)) WHERE date_index > 10)) WHERE kind IS NOT NULL""",
)
_register(
    "k_line_ten_rows",
    "SELECT code, load_date, date_index, round(kind, 6) AS kind FROM f_klong",
    lambda tx: features.k_line_long(tx).select("code", "load_date", "date_index", F.round("kind", 6).alias("kind")),
)

# --- market-wide ------------------------------------------------------------------------

_TERMS = {
    "trading_strength": "(market_price - market_open) * market_volume",
    "short_size": "market_price * short_position",
    "turnover": "market_price * market_volume",
    "over_value": "forward_pe * market_volume",
}
_IN = {"full": "TRUE", "pe": f"rpe <= {CAP}", "volume": f"rvl <= {CAP}"}
fragment(
    "m_raw",
    "SELECT load_date, date_index, "
    + ", ".join(
        f"sum(CASE WHEN {_IN[g]} THEN {t} ELSE 0 END)::DOUBLE AS {g}_{m}" if g != "full" else f"sum({t})::DOUBLE AS {g}_{m}" for g in _IN for m, t in _TERMS.items()
    )
    + """ FROM (SELECT *, row_number() OVER (PARTITION BY load_date ORDER BY coalesce(forward_pe, 0) DESC, code) AS rpe, row_number() OVER (PARTITION BY load_date ORDER BY market_price * market_volume DESC, code) AS rvl FROM w_tx) GROUP BY 1, 2""",
)
_FULL = list(SERIES.values())
fragment(
    "m_sum",
    "SELECT load_date, date_index, " + ", ".join(f"{g}_turnover / nullif({g}_short_size, 0) AS {g}_active_ts, {g}_trading_strength, {g}_short_size, {g}_over_value" for g in _IN) + " FROM m_raw",
)
fragment(
    "m_ind",
    "SELECT load_date, date_index, "
    + ", ".join(f"({c} - mn_{c}) / (av_{c} - mn_{c}) AS {c}" for c in _FULL)
    + " FROM m_sum, (SELECT "
    + ", ".join(f"min({c}) AS mn_{c}, avg({c}) AS av_{c}" for c in _FULL)
    + " FROM m_sum)",
)


def _rounded(df: DataFrame, digits: int, keys: tuple = ("load_date", "date_index")) -> DataFrame:
    return df.select(*keys, *[F.round(c, digits).alias(c) for c in df.columns if c not in keys])


_register(
    "market_indicators",
    "SELECT load_date, date_index, " + ", ".join(f"round({c}, 6) AS {c}" for c in _FULL) + " FROM m_ind",
    lambda tx: _rounded(market_features.market_indicators(tx, CAP), 6),
)

_MW = {}
for _s, _c in SERIES.items():
    for _n in SPANS:
        _MW[f"avg_{_s}_{_n:02d}"] = f"list_sum({_c}_l[1:{_n}]) / {_n}"
        _MW[f"mdn_{_s}_{_n:02d}"] = f"list_sort(list_transform({_c}_l[1:{_n}], lambda z: round(z, 7)))[{MEDIAN_PLACE[_n]}]"
fragment(
    "m_list",
    "SELECT load_date, date_index, "
    + ", ".join(f"list_reverse(list({c}) OVER (ORDER BY date_index ROWS 19 PRECEDING)) AS {c}_l" for c in _FULL)
    + ", date_index - lag(date_index, 19) OVER (ORDER BY date_index) AS gap FROM m_ind",
)
_SLOPE = ", ".join(
    f"regr_slope(round(b.{c}, 7), (b.date_index - a.date_index + {n - 1})::DOUBLE) FILTER (WHERE b.date_index > a.date_index - {n}) AS slope_{s}_{n:02d}" for s, c in SERIES.items() for n in SPANS
)
fragment("m_slope", f"SELECT a.date_index, {_SLOPE} FROM m_ind a JOIN m_ind b ON b.date_index BETWEEN a.date_index - 19 AND a.date_index GROUP BY 1")
fragment("m_win", "SELECT l.load_date, l.date_index, " + ", ".join(f"{e} AS {n}" for n, e in _MW.items()) + ", s.* EXCLUDE (date_index) FROM m_list l JOIN m_slope s ON l.date_index = s.date_index WHERE gap = 19")
_SL = [f"slope_{s}_{n:02d}" for s in SERIES for n in SPANS]
fragment(
    "m_scaled",
    "SELECT m_win.* REPLACE ("
    + ", ".join(f"({c} - mn_{c}) / nullif(av_{c} - mn_{c}, 0) AS {c}" for c in _SL)
    + ") FROM m_win, (SELECT "
    + ", ".join(f"min({c}) AS mn_{c}, avg({c}) AS av_{c}" for c in _SL)
    + " FROM m_win)",
)


def _pairs(stem: str, out: str) -> list:
    return features.span_pairs(stem, out, SPANS)


def _q(a: str, b: str) -> str:
    return f"CASE WHEN {b} = 0 THEN 1 ELSE {sq(f'{a} / {b}')} END"


_ALL = [f"{k}_{s}_{n:02d}" for k in ("avg", "mdn", "slope") for s in SERIES for n in SPANS]
_ALL_PAIRS = [p for k in ("avg", "mdn", "slope") for s in SERIES for p in _pairs(f"{k}_{s}", f"divided_{k}_{s}")]
fragment(
    "m_feat",
    "SELECT load_date, date_index, " + ", ".join(f"{sq(v)} AS {v}" for v in _ALL) + ", " + ", ".join(f"{_q(a, b)} AS {n}" for n, a, b in _ALL_PAIRS) + " FROM m_scaled",
)
_register("market_features", "SELECT * FROM m_feat", lambda tx: market_features.market_features(stage(market_features.market_indicators(tx, CAP))))


def _gap(a: str, b: str) -> str:
    return f"(round({sg(f'{a} - {b}')}, 3)::DECIMAL(9,3))::DOUBLE"


_DRAFT = []
for _s in SERIES:
    _g, _m = _s[0], _s[1:]
    _DRAFT += [f"{sq(f'avg_{_s}_{n:02d}')} AS {_g}_a_{_m}_{n:02d}, {sq(f'slope_{_s}_{n:02d}')} AS {_g}_s_{_m}_{n:02d}" for n in SPANS]
    _DRAFT += [f"{_q(a, b)} AS {n}" for n, a, b in _pairs(f"avg_{_s}", f"divided_{_g}_avg_{_m}")]
    _DRAFT += [f"{_gap(a, b)} AS {n}" for n, a, b in _pairs(f"slope_{_s}", f"divided_{_g}_s_{_m}")]
    if _g != "f":
        _DRAFT += [f"{_gap(f'slope_{_s}_{n:02d}', f'slope_f{_m}_{n:02d}')} AS divided_{_g}_f_s_{_m}_{n:02d}" for n in SPANS]
_register(
    "market_features_older",
    "SELECT load_date, date_index, " + ", ".join(_DRAFT) + " FROM m_scaled",
    lambda tx: market_features.market_features_draft(stage(market_features.market_indicators(tx, CAP))),
)

# --- training sets ----------------------------------------------------------------------

MIN_RATED, MIN_VOLUME = 20, 70_000


def score_sql(pe: str, analysts: str, rating: str, divisor: int) -> str:
    return f"(CASE WHEN {pe} < 100 THEN (100 - {pe}) / 100.0::DOUBLE ELSE 0 END + CASE WHEN {analysts} < 4 OR {rating} IS NULL THEN 0 ELSE (5 - {rating})::DOUBLE / {divisor} END)"


fragment(
    "tr_best",
    f"""
SELECT code, load_date, date_index, performance, rec_rank FROM (
  SELECT *, {rank(score_sql('pe_rank', 'number_of_analyst', 'recommendation_mean', 40) + ' DESC')} AS rec_rank FROM (
    SELECT t.*, CASE WHEN t.market_open <> 0 THEN round((e.market_price - t.market_open)::DOUBLE / t.market_open::DOUBLE + 1, 3) ELSE 1 END AS performance
    FROM (SELECT *, {rank('coalesce(forward_pe, 0) DESC')} AS pe_rank FROM w_tx) t JOIN w_tx e ON t.code = e.code AND e.date_index = t.date_index + 24
    WHERE t.date_index IN (SELECT date_index FROM w_tx WHERE recommendation_mean IS NOT NULL GROUP BY 1 HAVING count(*) > {MIN_RATED}) AND t.code <> 'Brand#13' AND t.average_volume > {MIN_VOLUME}
      AND CASE WHEN t.market_day_high <= t.market_day_low THEN 0 ELSE (t.market_price - t.market_day_low)::DOUBLE / (t.market_day_high - t.market_day_low)::DOUBLE END > 0.4)) WHERE date_index > 20""",
)


def _training_cols() -> list[tuple[str, str]]:
    out = []
    for k, (_, values, ratios, diffs) in FAMILIES.items():
        out += [(k, c) for c in [*values, *[r[0] for r in ratios], *[d[0] for d in diffs]]]
    return out


fragment(
    "tr_set",
    "SELECT b.code, b.load_date, b.date_index, b.performance, b.rec_rank, "
    + ", ".join(f"round(z_{k}.{c} * 1000)::INT AS {k}_{c}" for k, c in _training_cols())
    + " FROM tr_best b "
    + " ".join(f"JOIN z_{k} ON b.code = z_{k}.code AND b.date_index = z_{k}.date_index" for k in FAMILIES)
    + " QUALIFY row_number() OVER (PARTITION BY b.date_index ORDER BY b.rec_rank) <= 12",
)


def _training(spark: SparkSession, sf: str) -> DataFrame:
    return features.training_set(panel(spark, sf), MIN_RATED, MIN_VOLUME, ("Brand#13",), top=12)


@query("training_set", "SELECT * FROM tr_set")
def training_set(spark: SparkSession, sf: str) -> DataFrame:
    return _training(spark, sf)


@query(
    "training_output",
    """
SELECT 'individual' AS part, load_date, count(*) AS rows FROM tr_set WHERE load_date IN (SELECT load_date FROM m_feat) AND date_index <> 114 GROUP BY 2
UNION ALL SELECT 'market', load_date, count(*) FROM m_feat WHERE load_date IN (SELECT load_date FROM tr_set) AND date_index <> 114 GROUP BY 2""",
)
def training_output(spark: SparkSession, sf: str) -> DataFrame:
    tx = panel(spark, sf)
    individual = stage(features.training_set(tx, MIN_RATED, MIN_VOLUME, ("Brand#13",), top=12).select("code", "load_date", "date_index"))
    market = stage(market_features.market_features(stage(market_features.market_indicators(tx, CAP))).select("load_date", "date_index"))
    a, b = features.common_dates(individual, market, 114)
    one = a.groupBy("load_date").agg(F.count("*").alias("rows")).select(F.lit("individual").alias("part"), "load_date", "rows")
    return one.unionByName(b.groupBy("load_date").agg(F.count("*").alias("rows")).select(F.lit("market").alias("part"), "load_date", "rows"))


_G = ("g_inc", "g_pe", "g_slope", "g_pr", "g_sg", "g_k", "g_short")
_register(
    "older_training_set",
    "SELECT s.code, s.date_index, s.market_open::DOUBLE AS start_price, e.market_price::DOUBLE AS end_price, "
    + ", ".join(f"{g}.* EXCLUDE (code, date_index)" for g in _G)
    + " FROM w_tx s JOIN w_tx e ON s.code = e.code AND e.date_index = s.date_index + 25 "
    + " ".join(f"JOIN {g} ON s.code = {g}.code AND s.date_index = {g}.date_index" for g in _G)
    + " WHERE s.date_index >= 20",
    features.draft_training,
)
fragment("f_so", strength_sql("market_previous_close", False))
_register(
    "rank_training_set",
    f"""
SELECT p.code, p.date_index, p.performance, r.pe_share, r.avg_pe_share, (round({sg('r.increase_ratio')}, 3)::DECIMAL(9,3))::DOUBLE AS increase_ratio, round(r.increase_rank::DOUBLE / {UNIVERSE}, 3) AS increase_rank, u.f AS increase_filter,
  {", ".join(f"(round({sg(f'q.strength{n:02d}')}, 3)::DECIMAL(9,3))::DOUBLE AS strength_ratio_{n:02d}, round(({UNIVERSE} - q.k{n:02d})::DOUBLE / {UNIVERSE}, 3) AS strength_rank_{n:02d}" for n in (5, 10, 20))}
FROM (SELECT s.code, s.date_index, round((e.market_price::DOUBLE - s.market_open::DOUBLE) / s.market_open::DOUBLE, 6) AS performance FROM w_tx s JOIN w_tx e ON s.code = e.code AND e.date_index = s.date_index + 14 WHERE s.market_open <> 0) p
LEFT JOIN f_rank r ON p.code = r.code AND r.date_index = p.date_index - 1
LEFT JOIN (SELECT *, {", ".join(f"{rank(f'strength{n:02d} DESC')} AS k{n:02d}" for n in (5, 10, 20))} FROM f_so) q ON p.code = q.code AND q.date_index = p.date_index - 1
LEFT JOIN (SELECT date_index, round(max(increase_rank)::DOUBLE / {UNIVERSE}, 3) AS f FROM f_rank WHERE increase_ratio > 0 GROUP BY 1) u ON u.date_index = p.date_index - 1""",
    lambda tx: features.older_training(tx, UNIVERSE),
)


@query(
    "training_output_individual",
    "SELECT * FROM tr_set WHERE load_date IN (SELECT load_date FROM m_feat) AND date_index <> 114",
)
def training_output_individual(spark: SparkSession, sf: str) -> DataFrame:
    return _output(spark, sf)[0]


@query("training_output_market", f"SELECT * FROM ({ORACLES['market_features']}) WHERE load_date IN (SELECT load_date FROM tr_set) AND date_index <> 114")
def training_output_market(spark: SparkSession, sf: str) -> DataFrame:
    return _output(spark, sf)[1]


def _output(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    individual = stage(_training(spark, sf))
    market = stage(market_features.market_features(stage(market_features.market_indicators(panel(spark, sf), CAP))))
    return features.common_dates(individual, market, 114)


@query(
    "trends_long",
    " UNION ALL ".join(
        f"""SELECT code, date_index, 'list{n:02d}' AS attr, place - 1 AS place, round((vs[place] - vs[1]) / m, 6) AS val FROM (
  SELECT code, date_index, list(market_price::DOUBLE) OVER (PARTITION BY code ORDER BY date_index ROWS {n - 1} PRECEDING) AS vs,
    avg(market_price::DOUBLE) OVER (PARTITION BY code ORDER BY date_index ROWS 19 PRECEDING) AS m,
    count(*) OVER (PARTITION BY code ORDER BY date_index ROWS 19 PRECEDING) AS c FROM w_tx), unnest(range(1, {n + 1})) AS t(place) WHERE c = 20 AND date_index >= 20"""
        for n in (20, 10, 5)
    ),
)
def trends_long(spark: SparkSession, sf: str) -> DataFrame:
    """Every value of every list as a row."""
    lists = features.rebased_lists(panel(spark, sf))
    long = features.trends_long(lists, ["code", "date_index"], ["list20", "list10", "list05"])
    values = long.select("code", "date_index", "attr", F.posexplode("val").alias("place", "val"))
    return values.withColumns({"place": F.col("place").cast("long"), "val": F.round("val", 6)})


_PERIODS = {"s1": ("1995-01-01", "1997-06-01"), "s2": ("1999-02-17", "2000-05-18")}


def _period_sql(name: str, start: str, end: str) -> str:
    return f"""
SELECT '{name}' AS period, code, load_date, date_index, price_ratio, {rank('raw DESC')} AS rank FROM (
  SELECT code, load_date, dense_rank() OVER (ORDER BY load_date) AS date_index, {_POS} AS raw, round(CASE WHEN ({_POS}) > 1 THEN 1 WHEN ({_POS}) < 0 THEN 0 ELSE ({_POS}) END, 3) AS price_ratio
  FROM w_tx WHERE load_date >= DATE '{start}' AND load_date < DATE '{end}')"""


_register(
    "two_period_features",
    " UNION ALL ".join(_period_sql(n, a, b) for n, (a, b) in _PERIODS.items()),
    lambda tx: features.two_periods(tx, _PERIODS, features.price_position),
)

# The chain of both periods: the SQL reads a copy of the panel for each period, the plan all periods at once.
_X6 = ("strength00", "strength05", "strength10", "strength20")
_CHAIN = {
    "performance": "SELECT s.code, s.date_index, s.market_open::DOUBLE AS start_price, e.market_price::DOUBLE AS end_price FROM w_tx s JOIN w_tx e ON s.code = e.code AND e.date_index = s.date_index + 28",
    "ranks": "SELECT * FROM f_rank",
    "lists": " UNION ALL ".join(
        f"""SELECT code, date_index, 'list{n:02d}' AS attr, place - 1 AS place, round((vs[place] - vs[1]) / m, 6) AS val FROM (
  SELECT code, date_index, list(market_price::DOUBLE) OVER (PARTITION BY code ORDER BY date_index ROWS {n - 1} PRECEDING) AS vs,
    avg(market_price::DOUBLE) OVER (PARTITION BY code ORDER BY date_index ROWS 19 PRECEDING) AS m,
    count(*) OVER (PARTITION BY code ORDER BY date_index ROWS 19 PRECEDING) AS c FROM w_tx), unnest(range(1, {n + 1})) AS t(place) WHERE c = 20 AND date_index >= 20"""
        for n in (20, 10, 5)
    ),
    "strength": "SELECT code, date_index, " + ", ".join(f"round({c}, 6) AS {c}" for c in _X6) + " FROM f_so",
    "k_line": "SELECT code, load_date, date_index, round(kind, 6) AS kind FROM f_klong",
    "short_strength": ORACLES["short_strength_scaled"],
    "ask_bid": ORACLES["ask_bid"],
    "price_ratio": "SELECT * FROM f_pr",
}


def _of_period(text: str, period: str) -> str:
    """`text` over the panel of one period, with copies of the fragments that rest on the panel."""

    def rests(name: str) -> bool:
        return name != "w_tx" and any(m == "w_tx" or rests(m) for m in list(FRAGMENTS) if m != name and re.search(rf"\b{m}\b", FRAGMENTS[name]))

    for m in [m for m in list(FRAGMENTS) if re.search(rf"\b{m}\b", text) and rests(m)]:
        if f"{m}_{period}" not in FRAGMENTS:
            fragment(f"{m}_{period}", _of_period(FRAGMENTS[m], period))
        text = re.sub(rf"\b{m}\b", f"{m}_{period}", text)
    return re.sub(r"\bw_tx\b", f"w_tx_{period}", text)


def _chained(name: str) -> None:
    parts = [f"SELECT '{p}' AS period, * FROM ({_of_period(_CHAIN[name], p)})" for p in _PERIODS]

    @query(f"two_period_{name}", " UNION ALL ".join(parts))
    def run(spark: SparkSession, sf: str) -> DataFrame:
        out = features.by_period(features.period_chain(stage(features.in_periods(panel(spark, sf), _PERIODS)), UNIVERSE)[name]())
        if name == "lists":
            out = out.select("period", "code", "date_index", "attr", F.posexplode("val").alias("place", "val"))
            return out.withColumns({"place": F.col("place").cast("long"), "val": F.round("val", 6)})
        rounded = {"strength": _X6, "k_line": ("kind",)}.get(name, ())
        columns = ["period", "code", "date_index", *_X6] if name == "strength" else [c for c in out.columns if c != "rsv"]
        return out.select(*[F.round(c, 6).alias(c) if c in rounded else c for c in columns])


for _p, (_a, _b) in _PERIODS.items():
    _inside = f"SELECT * REPLACE (dense_rank() OVER (ORDER BY load_date) AS date_index) FROM w_tx WHERE load_date >= DATE '{_a}' AND load_date < DATE '{_b}'"
    fragment(f"w_tx_{_p}", _inside)
for _name in _CHAIN:
    _chained(_name)

# --- entity-attribute-value rows --------------------------------------------------------


def eavt_rows(spark: SparkSession, sf: str) -> DataFrame:
    """JSON statistics with bare NaN and infinities, and coefficient lists, made from event values."""
    v = F.col("value").cast("decimal(12,2)").cast("string")
    fields = []
    for i, s in enumerate(eavt.STATISTICS):
        x = F.when(F.col("user_id") % 7 == i, "NaN").when(F.col("user_id") % 11 == i, "-Infinity").when(F.col("user_id") % 13 == i, "Infinity").otherwise(v)
        fields += [F.lit(f'{"," if i else "{"}"{s}":'), x]
    basic = F.concat(*fields, F.lit("}"))
    curve = F.concat(F.lit("["), v, F.lit(","), v, F.when(F.col("user_id") % 2 == 0, F.concat(F.lit(","), v)).otherwise(""), F.lit("]"))
    kind = F.when(F.col("event_id") % 3 == 0, "price_basic").when(F.col("event_id") % 3 == 1, "price_linear").otherwise("price_quadratic")
    return table(spark, sf, "events").select(
        F.col("event_type").alias("entity"), kind.alias("attrib"), F.when(F.col("event_id") % 3 == 0, basic).otherwise(curve).alias("valu"), F.col("event_id").cast("string").alias("dindex")
    )


@query(
    "eavt_basic",
    "SELECT event_type AS entity, event_id::VARCHAR AS date_index, 'price_basic' AS attrib, "
    + ", ".join(f"CASE WHEN user_id % 7 = {i} OR user_id % 11 = {i} OR user_id % 13 = {i} THEN NULL ELSE round(value, 2) END AS {s}" for i, s in enumerate(eavt.STATISTICS))
    + " FROM events WHERE event_id % 3 = 0",
)
def eavt_basic(spark: SparkSession, sf: str) -> DataFrame:
    return eavt.eavt_basic(eavt_rows(spark, sf))


@query(
    "eavt_curve",
    "SELECT event_type AS entity, event_id::VARCHAR AS date_index, CASE WHEN event_id % 3 = 1 THEN 'price_linear' ELSE 'price_quadratic' END AS attrib, round(value, 2) AS zero, round(value, 2) AS first, CASE WHEN user_id % 2 = 0 THEN round(value, 2) END AS second FROM events WHERE event_id % 3 <> 0",
)
def eavt_curve(spark: SparkSession, sf: str) -> DataFrame:
    return eavt.eavt_curve(eavt_rows(spark, sf))
