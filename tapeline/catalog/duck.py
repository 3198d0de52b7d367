"""SQL fragments shared by the check queries: the derived panels, written independently in SQL."""

from __future__ import annotations

from tapeline.catalog.registry import fragment
from tapeline.functions.series import EMA15, EMA40

ASOF = "2001-06-29"
DAY = f"DATE '{ASOF}'"


def base_sql(day: str) -> str:
    cents = "round(l_extendedprice * 100)::BIGINT"
    seq = f"((l_orderkey * 10 + l_linenumber)::HUGEINT * 1000000000000 + {cents})"
    ratings = ", ".join(
        f"sum(CASE WHEN round(l_discount * 100)::INT % 5 = {i} THEN l_quantity::BIGINT ELSE 0 END)::BIGINT AS r{i}"
        for i in range(5)
    )
    return f"""
SELECT p_brand AS code, {day} AS load_date,
  (min({seq}) % 1000000000000)::BIGINT AS o, max({cents}) AS h, min({cents}) AS l,
  (max({seq}) % 1000000000000)::BIGINT AS c, sum(l_quantity::BIGINT)::BIGINT AS v,
  sum({cents})::BIGINT AS t, max(round(p_retailprice * 100)::BIGINT) AS p,
  sum(CASE WHEN l_returnflag = 'R' THEN l_quantity::BIGINT ELSE 0 END)::BIGINT AS s, {ratings}
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2"""


fragment("d_base", base_sql("l_shipdate::DATE"))
fragment("w_base", base_sql("date_trunc('week', l_shipdate)::DATE"))

fragment(
    "d_bars",
    """
SELECT code, load_date, (o * 0.01)::DECIMAL(12,3) AS open, (l * 0.01)::DECIMAL(12,3) AS low,
  (h * 0.01)::DECIMAL(12,3) AS high, (c * 0.01)::DECIMAL(12,3) AS close,
  (lag(c) OVER (PARTITION BY code ORDER BY load_date) * 0.01)::DECIMAL(12,3) AS pclose,
  v AS volume, (t * 0.01)::DECIMAL(20,3) AS turnover, (p * v * 0.01)::DECIMAL(22,2) AS market_cap,
  round(c::DOUBLE / lag(c) OVER (PARTITION BY code ORDER BY load_date), 4) AS daily_change,
  (((h + l + c) * 10 * 2 + 3) // 6 * 0.001)::DECIMAL(12,3) AS typ3,
  (((h + l + o + c) * 10 + 2) // 4 * 0.001)::DECIMAL(12,3) AS typ4
FROM d_base""",
)

fragment("d_cat", "SELECT DISTINCT code, 'Sector ' || (regexp_extract(code, '(\\d+)$', 1)::INT % 5) AS category FROM d_base")
fragment("d_idx", "SELECT load_date, row_number() OVER (ORDER BY load_date DESC) AS rnum FROM (SELECT DISTINCT load_date FROM d_base)")

for _name, _vec in (("w15", EMA15), ("w40", EMA40)):
    _rows = ", ".join(f"({i}, {int(x.scaleb(9))})" for i, x in enumerate(_vec))
    fragment(_name, f"SELECT * FROM (VALUES {_rows}) t(orders, weight)")

# Ordered rows with prices in thousandths, numbered per code.
fragment(
    "d_seq",
    """
SELECT code, load_date, o * 10 AS o, h * 10 AS h, l * 10 AS l, c * 10 AS c,
  row_number() OVER (PARTITION BY code ORDER BY load_date) AS rn FROM d_base""",
)

# Smoothed candles, one recursion step per bar, in thousandths with rounding at every step.
fragment(
    "d_ha0",
    """
SELECT code, load_date, rn, (o + c + 1) // 2 AS ho, (o + h + l + c + 2) // 4 AS hc, h, l FROM d_seq WHERE rn = 1
UNION ALL
SELECT q.code, q.load_date, q.rn, (p.ho + p.hc + 1) // 2, (q.o + q.h + q.l + q.c + 2) // 4, q.h, q.l
FROM d_ha0 p JOIN d_seq q ON q.code = p.code AND q.rn = p.rn + 1""",
)
fragment(
    "d_ha",
    """
SELECT code, load_date, (ho * 0.001)::DECIMAL(12,3) AS open, (greatest(h, ho, hc) * 0.001)::DECIMAL(12,3) AS high,
  (least(l, ho, hc) * 0.001)::DECIMAL(12,3) AS low, (hc * 0.001)::DECIMAL(12,3) AS close FROM d_ha0""",
)


def sar_sql(name: str, step: int, cap: int) -> str:
    """Stop-and-reverse in thousandths, acceleration in hundredths."""

    def nxt(sar: str, af: str, target: str) -> str:
        return f"({sar} * 100 + {af} * ({target} - ({sar})) + 50) // 100"

    keep_up, stop_up = "p.up AND p.n_sar <= q.l", "p.up AND p.n_sar > q.l"
    keep_dn = "NOT p.up AND p.n_sar >= q.h"
    up_af = f"CASE WHEN p.ext < q.h THEN least({cap}, p.af + {step}) ELSE p.af END"
    dn_af = f"CASE WHEN p.ext > q.l THEN least({cap}, p.af + {step}) ELSE p.af END"
    return f"""
SELECT code, load_date, rn, h AS ext, TRUE AS up, {step}::BIGINT AS af, l AS sar, {nxt('l', str(step), 'h')} AS n_sar
FROM d_seq WHERE rn = 1
UNION ALL
SELECT q.code, q.load_date, q.rn,
  CASE WHEN p.up THEN greatest(p.ext, q.h) ELSE least(p.ext, q.l) END,
  CASE WHEN {keep_up} THEN TRUE WHEN {stop_up} THEN FALSE WHEN {keep_dn} THEN FALSE ELSE TRUE END,
  CASE WHEN {keep_up} THEN {up_af} WHEN {keep_dn} THEN {dn_af} ELSE {step} END,
  CASE WHEN {keep_up} THEN p.n_sar WHEN {stop_up} THEN greatest(p.ext, q.h)
       WHEN {keep_dn} THEN p.n_sar ELSE least(p.ext, q.h) END,
  CASE WHEN {keep_up} THEN {nxt('p.n_sar', f'({up_af})', 'q.h')}
       WHEN {stop_up} THEN {nxt('greatest(p.ext, q.h)', str(step), 'q.l')}
       WHEN {keep_dn} THEN {nxt('p.n_sar', f'({dn_af})', 'q.l')}
       ELSE {nxt('least(p.ext, q.h)', str(step), 'q.l')} END
FROM {name} p JOIN d_seq q ON q.code = p.code AND q.rn = p.rn + 1"""


for _n, _step, _cap in (("d_sar0", 5, 50), ("d_sar2", 2, 20), ("d_sar3", 3, 30)):
    fragment(_n, sar_sql(_n, _step, _cap))
fragment(
    "d_sar",
    """
SELECT code, load_date, (ext * 0.001)::DECIMAL(12,3) AS extreme, CASE WHEN up THEN 'up' ELSE 'down' END AS ud_trend,
  (af * 0.01)::DECIMAL(5,3) AS af, (sar * 0.001)::DECIMAL(12,3) AS sar, (n_sar * 0.001)::DECIMAL(12,3) AS n_sar
FROM d_sar0""",
)
fragment(
    "d_sar23",
    """
SELECT a.code, a.load_date, CASE WHEN a.up THEN 'up' ELSE 'down' END AS ud_trend2, (a.n_sar * 0.001)::DECIMAL(12,3) AS n_sar2,
  CASE WHEN b.up THEN 'up' ELSE 'down' END AS ud_trend3, (b.n_sar * 0.001)::DECIMAL(12,3) AS n_sar3
FROM d_sar2 a JOIN d_sar3 b ON a.code = b.code AND a.load_date = b.load_date""",
)


def ma_sql(source: str, value: str, scale: int, weights: str, n: int, out: str) -> str:
    """Weighted mean of the last n rows by joining rows to weights on their distance."""
    return f"""
SELECT code, load_date, (sign(total) * ((abs(total) + {10 ** (5 + scale) // 2}) // {10 ** (5 + scale)}) * 0.0001)::DECIMAL(14,4) AS {out}
FROM (SELECT a.code, a.load_date, sum((b.{value} * {10**scale})::BIGINT * w.weight)::BIGINT AS total
FROM (SELECT code, load_date, row_number() OVER (PARTITION BY code ORDER BY load_date) AS rn FROM {source}) a
JOIN (SELECT code, {value}, row_number() OVER (PARTITION BY code ORDER BY load_date) AS rn FROM {source}) b
  ON a.code = b.code AND b.rn BETWEEN a.rn - {n - 1} AND a.rn
JOIN {weights} w ON w.orders = a.rn - b.rn
GROUP BY a.code, a.load_date HAVING count(*) = {n})"""


fragment("d_ma15", ma_sql("d_bars", "close", 3, "w15", 15, "ema"))
fragment("d_ma40", ma_sql("d_bars", "close", 3, "w40", 40, "ema"))
fragment(
    "d_ema",
    """
SELECT b.code, b.load_date, b.close AS price, x.ema AS ema15, y.ema AS ema40
FROM d_bars b JOIN d_ma15 x ON b.code = x.code AND b.load_date = x.load_date
JOIN d_ma40 y ON b.code = y.code AND b.load_date = y.load_date""",
)
fragment("h_ma15", ma_sql("d_ha", "close", 3, "w15", 15, "ema"))
fragment("h_ma40", ma_sql("d_ha", "close", 3, "w40", 40, "ema"))
fragment(
    "h_ema",
    """
SELECT b.code, b.load_date, b.close AS price, x.ema AS ema15, y.ema AS ema40
FROM d_ha b JOIN h_ma15 x ON b.code = x.code AND b.load_date = x.load_date
JOIN h_ma40 y ON b.code = y.code AND b.load_date = y.load_date""",
)
fragment("h_diff", "SELECT code, load_date, (ema15 - ema40)::DECIMAL(14,4) AS diff FROM h_ema")
fragment("h_dea", ma_sql("h_diff", "diff", 4, "w15", 15, "dea"))
fragment("h_macd", "SELECT d.code, d.load_date, d.diff, e.dea FROM h_diff d JOIN h_dea e ON d.code = e.code AND d.load_date = e.load_date")
