"""Equivalent SQL for the registered queries, written for DuckDB.

Smoothed columns are computed from their definition as weighted sums over all earlier rows, not by the engine's blocks.
"""

from __future__ import annotations

from quantloom.schema import FEATURES


def r(expr: str, digits: int, name: str | None = None) -> str:
    """Rounded value without a negative zero."""
    text = f"(round({expr}, {digits}) + 0.0::DOUBLE)"
    return f"{text} AS {name}" if name else text


ORDER_BARS = """
SELECT o_orderpriority AS ticker, date_trunc('day', o_orderdate)::TIMESTAMP AS date,
  first(o_totalprice ORDER BY o_orderdate, o_orderkey) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low,
  last(o_totalprice ORDER BY o_orderdate, o_orderkey) AS close, count(*)::DOUBLE AS volume
FROM orders GROUP BY ALL"""


def line_bars(key: str, price: str = "(l_extendedprice / l_quantity)") -> str:
    rank = f"l_shipdate, l_orderkey, l_linenumber, {price}"
    return f"""
SELECT {key}::VARCHAR AS ticker, date_trunc('day', l_shipdate)::TIMESTAMP AS date,
  first({price} ORDER BY {rank}) AS open, max({price}) AS high, min({price}) AS low,
  last({price} ORDER BY {rank}) AS close, sum(l_quantity) AS volume
FROM lineitem GROUP BY ALL"""


def event_bars(bucket: str) -> str:
    return f"""
SELECT event_type AS ticker, date_trunc('{bucket}', ts)::TIMESTAMP AS date,
  first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
  last(value ORDER BY ts, event_id) AS close, count(*)::DOUBLE AS volume
FROM events GROUP BY ALL"""


# daily order bars whose price is unknown for pending orders: some prices are null
NULL_BARS = """
SELECT o_orderpriority AS ticker, date_trunc('day', o_orderdate)::TIMESTAMP AS date,
  first(price ORDER BY o_orderdate, o_orderkey) AS open, max(price) AS high, min(price) AS low,
  last(price ORDER BY o_orderdate, o_orderkey) AS close, count(*)::DOUBLE AS volume
FROM (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price FROM orders) GROUP BY ALL"""

DIRTY_BARS = """
SELECT l_suppkey::VARCHAR AS ticker, l_shipdate AS date,
  l_extendedprice / l_quantity AS open,
  CASE WHEN l_discount = 0 AND l_tax = 0 AND l_quantity = 1 THEN 0.5 ELSE 1.1 END::DOUBLE * (l_extendedprice / l_quantity) AS high,
  CASE WHEN l_discount = 0 AND l_tax = 0 AND l_quantity = 1 THEN 0 ELSE l_extendedprice / l_quantity * (1 - l_tax) END::DOUBLE AS low,
  CASE WHEN l_linenumber = 1 AND l_returnflag = 'R' THEN NULL ELSE l_extendedprice / l_quantity * (1 + l_tax) END::DOUBLE AS close,
  greatest(l_quantity - 5, 0)::DOUBLE AS volume
FROM lineitem"""

_W = "PARTITION BY ticker ORDER BY date"


def _rolling(agg: str, col: str, n: int) -> str:
    frame = f"({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({col}) OVER {frame} = {n} THEN {agg}({col}) OVER {frame} END"


def _lag(n: int, col: str = "close") -> str:
    return f"lag({col}, {n}) OVER ({_W})"


def _ewm(alpha: str, col: str, adjust: bool) -> str:
    """Weighted sum over all earlier rows ``e`` for the row ``t``."""
    weight = f"power(1 - {alpha}, t.i - e.i)"
    if adjust:
        return f"sum({weight} * e.{col}) / nullif(sum(CASE WHEN e.{col} IS NOT NULL THEN {weight} END), 0)"
    return f"sum(CASE WHEN e.i = 0 THEN {weight} ELSE {alpha} * {weight} END * e.{col})"


def features_cte(bars: str, smoothing: bool = True, prefix: str = "") -> str:
    """``WITH`` list ending in ``f``: all rows with features and targets. The bars must have no nulls.

    ``prefix`` goes before each name, so two sets of bars fit into one statement.
    """
    lags = ", ".join(f"{_lag(n)} AS close_lag_{n}" for n in (1, 2, 3, 5, 10))
    changes = ", ".join(f"close / nullif({_lag(n)}, 0) - 1 AS returns_{n}d" for n in (1, 5, 10))
    lagged = ", ".join(f"{_lag(1)} / nullif({_lag(n + 1)}, 0) - 1 AS return_lag_{n}" for n in (1, 2, 3, 5, 10))
    base = f"""
@b AS ({bars}),
@p AS (SELECT *, row_number() OVER ({_W}) - 1 AS i, {_lag(1)} AS prev, lead(close, 1) OVER ({_W}) AS target_next_close FROM @b),
@s AS (SELECT *, CASE WHEN prev IS NOT NULL THEN greatest(close - prev, 0) END AS gain,
  CASE WHEN prev IS NOT NULL THEN greatest(prev - close, 0) END AS loss,
  greatest(high - low, coalesce(abs(high - prev), 0), coalesce(abs(low - prev), 0)) AS tr FROM @p),
@w AS (SELECT *, {changes}, {lags}, {lagged},
  (high - low) / nullif(close, 0) AS high_low_range, (close - open) / nullif(open, 0) AS close_open_spread,
  {_rolling('avg', 'close', 10)} AS sma_10, {_rolling('avg', 'close', 20)} AS sma_20, {_rolling('avg', 'close', 50)} AS sma_50,
  {_rolling('stddev_samp', 'close', 20)} AS std, {_rolling('avg', 'volume', 10)} AS volume_sma_10,
  ln(1 + volume) AS log_volume, target_next_close / nullif(close, 0) - 1 AS target_next_return FROM @s),
@x AS (SELECT *, close / nullif(sma_20, 0) - 1 AS close_to_sma20, close / nullif(sma_50, 0) - 1 AS close_to_sma50,
  sma_10 / nullif(sma_20, 0) - 1 AS sma10_sma20_cross, sma_20 + 2 * std AS bb_upper, sma_20 - 2 * std AS bb_lower,
  (sma_20 + 2 * std - (sma_20 - 2 * std)) / nullif(sma_20, 0) AS bb_width,
  (close - (sma_20 - 2 * std)) / ((sma_20 + 2 * std) - (sma_20 - 2 * std) + 1e-9) AS bb_pos,
  volume / (volume_sma_10 + 1e-9) AS volume_ratio FROM @w)"""
    if not smoothing:
        return (base + ",\n@f AS (SELECT * FROM @x)").replace("@", prefix)
    out = base + f""",
@m AS (SELECT t.ticker, t.i, {_ewm('(2.0::DOUBLE / 13)', 'close', False)} AS ema_12, {_ewm('(2.0::DOUBLE / 27)', 'close', False)} AS ema_26,
  {_ewm('(1.0::DOUBLE / 14)', 'gain', True)} AS ag, {_ewm('(1.0::DOUBLE / 14)', 'loss', True)} AS al,
  {_ewm('(1.0::DOUBLE / 14)', 'tr', True)} AS at
  FROM @s t JOIN @s e ON t.ticker = e.ticker AND e.i <= t.i GROUP BY t.ticker, t.i),
@c AS (SELECT *, ema_12 - ema_26 AS macd FROM @m),
@g AS (SELECT t.ticker, t.i, {_ewm('(2.0::DOUBLE / 10)', 'macd', False)} AS macd_signal
  FROM @c t JOIN @c e ON t.ticker = e.ticker AND e.i <= t.i GROUP BY t.ticker, t.i),
@f AS (SELECT x.*, c.ema_12, c.ema_26, c.macd, g.macd_signal, c.macd - g.macd_signal AS macd_hist,
  CASE WHEN x.i >= 14 THEN 100 - 100 / (1 + c.ag / (c.al + 1e-9)) END AS rsi_14, CASE WHEN x.i >= 13 THEN c.at END AS atr_14
  FROM @x x JOIN @c c USING (ticker, i) JOIN @g g USING (ticker, i))"""
    return out.replace("@", prefix)


WARM = "sma_50 IS NOT NULL AND i >= 14 AND close_lag_10 IS NOT NULL AND target_next_close IS NOT NULL"

# digits compared: averages of cents are exact at 4 digits, other price-like values are compared at 2
DIGITS = {
    **{f: 6 for f in FEATURES},
    **{f: 2 for f in ("ema_12", "ema_26", "macd", "macd_signal", "macd_hist", "bb_upper", "bb_lower", "atr_14")},
    **{f: 4 for f in ("sma_10", "sma_20", "sma_50", "rsi_14", "volume_sma_10", "log_volume", "open", "high", "low", "close", "volume")},
    **{f"close_lag_{n}": 4 for n in (1, 2, 3, 5, 10)},
    "target_next_close": 4,
    "target_next_return": 6,
}


def rounded(cols, digits=None) -> str:
    return ", ".join(r(c, (digits or DIGITS)[c], c) for c in cols)


_SPLIT = """CASE WHEN i2 < floor(n * 0.70::DOUBLE) THEN 'train'
  WHEN i2 < floor(n * (0.70::DOUBLE + 0.15::DOUBLE)) THEN 'val' ELSE 'test' END"""


def split_cte(bars: str, smoothing: bool = True) -> str:
    """Adds ``k``: warm rows with ``split``."""
    return features_cte(bars, smoothing) + f""",
z AS (SELECT *, row_number() OVER ({_W}) - 1 AS i2, count(*) OVER (PARTITION BY ticker) AS n FROM f WHERE {WARM}),
k AS (SELECT *, {_SPLIT} AS split FROM z)"""


def tall(cte: str, cols) -> str:
    names = ", ".join(cols)
    return f"(UNPIVOT (SELECT ticker, {names} FROM {cte}) ON {names} INTO NAME feature VALUE value)"


def scaler_cte(cols) -> str:
    """Adds ``sc``: center and scale per key and feature of the training rows in ``k``."""
    return f""",
tt AS (SELECT * FROM {tall("(SELECT * FROM k WHERE split = 'train')", cols)}),
sc AS (SELECT ticker, feature, quantile_cont(value, 0.5) AS center,
  CASE WHEN quantile_cont(value, 0.75) - quantile_cont(value, 0.25) < 10 * 2.220446049250313e-16 THEN 1.0::DOUBLE
    ELSE quantile_cont(value, 0.75) - quantile_cont(value, 0.25) END AS scale FROM tt GROUP BY ALL)"""


def ecdf_cte(ref: str, cur: str, cols) -> str:
    """Adds ``ec``: both distribution functions. ``ref`` and ``cur`` name earlier CTEs."""
    return f""",
u AS (SELECT ticker, feature, value, 1 AS nr, 0 AS nc FROM {tall(ref, cols)}
  UNION ALL SELECT ticker, feature, value, 0 AS nr, 1 AS nc FROM {tall(cur, cols)}),
v AS (SELECT ticker, feature, value, sum(nr) AS nr, sum(nc) AS nc FROM u GROUP BY ALL),
ec0 AS (SELECT ticker, feature, value, lead(value) OVER o AS next_value, sum(nr) OVER t AS n_ref, sum(nc) OVER t AS n_cur,
  sum(nr) OVER o AS ur, sum(nc) OVER o AS uc FROM v
  WINDOW o AS (PARTITION BY ticker, feature ORDER BY value), t AS (PARTITION BY ticker, feature)),
ec AS (SELECT ticker, feature, value, next_value, n_ref::BIGINT AS n_ref, n_cur::BIGINT AS n_cur,
  ur::DOUBLE / n_ref AS f_ref, uc::DOUBLE / n_cur AS f_cur FROM ec0 WHERE n_ref > 0 AND n_cur > 0)"""


def _pvalue(ks: str, n_ref: str, n_cur: str) -> str:
    lam = f"(sqrt(({n_ref})::DOUBLE * ({n_cur}) / (({n_ref}) + ({n_cur}))) * ({ks}))"
    terms = range(1, 9)
    tail = " + ".join(f"({'' if k % 2 else '-'}exp(-2.0::DOUBLE * {k * k} * {lam} * {lam}))" for k in terms)
    body = " + ".join(f"exp(-{(2 * k - 1) ** 2}::DOUBLE * pi() * pi() / 8 / ({lam} * {lam}))" for k in terms)
    return f"""greatest(0, least(1, CASE WHEN {lam} <= 0 THEN 1 WHEN {lam} < 1.18
      THEN 1 - sqrt(2 * pi()) / {lam} * ({body}) ELSE 2 * ({tail}) END))"""


def exact_law(name: str, source: str) -> str:
    """Adds ``name``: the exact p-value ``pe`` of every (n, m, h) in ``source``, h being n * m times the statistic."""
    return f"""{name}(n, m, h, t, a) USING KEY (n, m, h) AS (
  SELECT n::BIGINT, m::BIGINT, h::BIGINT, 0::BIGINT, list_transform(range(0, n::BIGINT + 1), lambda i: (i = 0 AND h > 0)::INT::DOUBLE) FROM ({source})
  UNION SELECT n, m, h, t + 1, list_transform(range(0, n + 1), lambda i: CASE WHEN abs(i * (n + m) - (t + 1) * n) < h AND t + 1 - i BETWEEN 0 AND m
    THEN (a[i + 1] * (m - t + i) + CASE WHEN i > 0 THEN a[i] * (n - i + 1) ELSE 0 END) / (n + m - t) ELSE 0 END) FROM {name} WHERE t < n + m)"""


def column_drift_cte(ref: str, cur: str, cols) -> str:
    """Adds ``cd``: test, score and verdict per key and feature."""
    return ecdf_cte(ref, cur, cols) + f""",
ts AS (SELECT ticker, feature, max(n_ref) AS n_ref, max(n_cur) AS n_cur, max(abs(f_ref - f_cur)) AS ks,
  sum(abs(f_ref - f_cur) * coalesce(next_value - value, 0)) AS wasserstein FROM ec GROUP BY ALL),
sd AS (SELECT ticker, feature, greatest(stddev_pop(value), 0.001::DOUBLE) AS spread FROM {tall(ref, cols)} GROUP BY ALL),
{exact_law("law", "SELECT DISTINCT n_ref AS n, n_cur AS m, round(ks * n_ref * n_cur) AS h FROM ts WHERE n_ref <= 1000 AND n_cur <= 10000")},
cd0 AS (SELECT ticker, feature, n_ref, n_cur, ks, CASE WHEN h IS NULL THEN {_pvalue('ks', 'n_ref', 'n_cur')} ELSE 1 - list_sum(a) END AS ks_pvalue,
  wasserstein / spread AS wasserstein_normed FROM ts JOIN sd USING (ticker, feature) LEFT JOIN law ON n = n_ref AND m = n_cur AND h = round(ks * n_ref * n_cur)),
cd AS (SELECT *, CASE WHEN n_ref <= 1000 THEN 'ks' ELSE 'wasserstein' END AS test,
  CASE WHEN n_ref <= 1000 THEN ks_pvalue ELSE wasserstein_normed END AS score,
  CASE WHEN n_ref <= 1000 THEN ks_pvalue < 0.05::DOUBLE ELSE wasserstein_normed >= 0.1::DOUBLE END AS drifted FROM cd0)"""


def pvalue(ks: str, n_ref: str, n_cur: str) -> str:
    return _pvalue(ks, n_ref, n_cur)


def ridge_cte(rows: str, cols, label: str, reg: float) -> str:
    """Adds ``rc``: intercept and coefficient ``i`` per key, from the training rows, by elimination row after row."""
    p = len(cols)
    return f""",
rv AS (SELECT ticker, [{", ".join([*cols, label])}] AS v FROM {rows} WHERE split = 'train'),
rm AS (SELECT ticker, i, count(*) AS n, avg(v[i]) AS m, stddev_pop(v[i]) AS s FROM rv, range(1, {p + 2}) g(i) GROUP BY ALL),
re AS (SELECT rv.ticker, a.i, b.i AS j, avg((v[a.i] - a.m) * (v[b.i] - b.m)) / any_value(a.s) / any_value(b.s) AS c
  FROM rv JOIN rm a ON a.ticker = rv.ticker JOIN rm b ON b.ticker = rv.ticker WHERE a.i <= {p} GROUP BY ALL),
rr AS (SELECT ticker, i, list(CASE WHEN i = j THEN 1 + {reg}::DOUBLE ELSE c END ORDER BY j) AS line FROM re GROUP BY ALL),
rg(ticker, k, a) AS (SELECT ticker, 1::BIGINT, list(line ORDER BY i) FROM rr GROUP BY ticker
  UNION ALL SELECT ticker, k + 1, list_transform(a, lambda line, i: CASE WHEN i = k THEN list_transform(line, lambda x: x / line[k])
    ELSE list_transform(line, lambda x, j: x - line[k] / a[k][k] * a[k][j]) END) FROM rg WHERE k <= {p}),
rb AS (SELECT rg.ticker, n, i, a[i][{p + 1}] * (SELECT s FROM rm y WHERE y.ticker = rg.ticker AND y.i = {p + 1}) / s AS coefficient, m
  FROM rg JOIN rm ON rm.ticker = rg.ticker AND i <= {p} WHERE k = {p + 1}),
rc AS (SELECT ticker, n, i, coefficient, (SELECT m FROM rm y WHERE y.ticker = rb.ticker AND y.i = {p + 1}) - sum(coefficient * m) OVER (PARTITION BY ticker) AS intercept FROM rb)"""
