"""Registered queries: each operator over the given tables, with equivalent SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.functions.ewm import ewm_mean
from quantloom.operators import drift, gates, linear, metrics, models, prep, score, validate
from quantloom.operators.features import compute_features
from quantloom.operators.layout import DAILY, HOURLY, Series
from quantloom.plans import oracles as Q
from quantloom.plans import pipeline
from quantloom.plans.oracles import DIGITS, r, rounded
from quantloom.schema import FEATURES, KEY, ORDER, SCORE_LOOKBACK_DAYS, TARGETS, WARMUP_DAYS
from quantloom.sources import bars as B
from quantloom.sources.stage import stage, stage_folder
from quantloom.streaming.ingest import store_delivery, stored_counts
from quantloom.streaming.ticks import TickColumns, ingest_ticks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BAR_COLS = "ticker, date, open, high, low, close, volume"
# fixed as-of dates near the end of the tables
ORDERS_ASOF = "2001-07-01"
SMOOTHED = ["ema_12", "ema_26", "macd", "macd_signal", "macd_hist"]


def query(name: str, sql: str | None = None):
    def add(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def order_bars(spark, sf, bucket="day"):
    return B.bars_from_ticks(
        table(spark, sf, "orders"), "o_orderpriority", "o_orderdate", "o_totalprice", bucket=bucket, seq="o_orderkey"
    )


def line_bars(spark, sf, key="l_returnflag", per_unit=True):
    price = F.col("l_extendedprice") / F.col("l_quantity") if per_unit else F.col("l_extendedprice")
    rank = ["l_shipdate", "l_orderkey", "l_linenumber", price]
    return B.bars_from_ticks(table(spark, sf, "lineitem"), key, "l_shipdate", price, "l_quantity", order_by=rank)


def event_bars(spark, sf, bucket="hour"):
    return B.bars_from_ticks(table(spark, sf, "events"), "event_type", "ts", "value", bucket=bucket, seq="event_id")


def null_bars(spark, sf):
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return B.bars_from_ticks(
        table(spark, sf, "orders"), "o_orderpriority", "o_orderdate", known, seq="o_orderkey"
    )


def dirty_bars(spark, sf):
    price = F.col("l_extendedprice") / F.col("l_quantity")
    free = (F.col("l_discount") == 0) & (F.col("l_tax") == 0) & (F.col("l_quantity") == 1)
    unknown = (F.col("l_linenumber") == 1) & (F.col("l_returnflag") == "R")
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias(KEY),
        F.col("l_shipdate").alias(ORDER),
        price.alias("open"),
        (F.when(free, F.lit(0.5)).otherwise(F.lit(1.1)) * price).alias("high"),
        F.when(free, F.lit(0.0)).otherwise(price * (1 - F.col("l_tax"))).alias("low"),
        F.when(~unknown, price * (1 + F.col("l_tax"))).alias("close"),
        F.greatest(F.col("l_quantity") - 5, F.lit(0.0)).alias("volume"),
    )


def keys_of(bars: DataFrame) -> DataFrame:
    return bars.select(KEY).distinct()


def show(df: DataFrame, cols, digits=None, keys=(KEY, ORDER)) -> DataFrame:
    """Round the given columns as the SQL does."""
    digits = digits or DIGITS
    return df.selectExpr(*keys, *[f"round({c}, {digits[c]}) AS {c}" for c in cols])


# --- sources, sinks, cleaning ---------------------------------------------------------------------------------------


@query("bars_from_ticks_orders", f"SELECT {BAR_COLS} FROM ({Q.ORDER_BARS})")
def _(spark, sf):
    return order_bars(spark, sf)


@query("bars_from_ticks_lineitem", f"SELECT {BAR_COLS} FROM ({Q.line_bars('l_returnflag')})")
def _(spark, sf):
    return line_bars(spark, sf)


@query("bars_from_ticks_many_keys", f"SELECT {BAR_COLS} FROM ({Q.line_bars('l_suppkey')})")
def _(spark, sf):
    return line_bars(spark, sf, "l_suppkey")


@query("bars_from_ticks_events_hour", f"SELECT {BAR_COLS} FROM ({Q.event_bars('hour')})")
def _(spark, sf):
    return event_bars(spark, sf)


@query("bars_from_ticks_events_minute", f"SELECT {BAR_COLS} FROM ({Q.event_bars('minute')})")
def _(spark, sf):
    return event_bars(spark, sf, "minute")


@query("bars_from_ticks_month", f"SELECT {BAR_COLS} FROM ({Q.ORDER_BARS.replace(chr(39) + 'day' + chr(39), chr(39) + 'month' + chr(39))})")
def _(spark, sf):
    return order_bars(spark, sf, "month")


@query(
    "date_range",
    f"SELECT {BAR_COLS} FROM ({Q.ORDER_BARS}) WHERE date >= TIMESTAMP '1996-03-01' AND date < TIMESTAMP '1999-03-01'",
)
def _(spark, sf):
    return B.date_range(order_bars(spark, sf), "1996-03-01", "1999-03-01")


@query(
    "missing_keys",
    f"""WITH b AS ({Q.ORDER_BARS}), k AS (SELECT DISTINCT ticker FROM b UNION SELECT DISTINCT c_mktsegment FROM customer)
SELECT ticker FROM k WHERE ticker NOT IN (SELECT ticker FROM b)""",
)
def _(spark, sf):
    bars = order_bars(spark, sf)
    segments = table(spark, sf, "customer").select(F.col("c_mktsegment").alias(KEY)).distinct()
    return B.missing_keys(bars, keys_of(bars).union(segments).distinct())


@query(
    "clean_bars",
    """SELECT l_returnflag AS ticker, l_shipdate AS date, l_extendedprice AS open, l_extendedprice AS high,
  l_extendedprice AS low, l_extendedprice AS close, l_quantity AS volume FROM lineitem""",
)
def _(spark, sf):
    names = {**dict.fromkeys(["open", "high", "low", "close"], "l_extendedprice"), "volume": "l_quantity"}
    return B.clean_bars(table(spark, sf, "lineitem"), "l_returnflag", "l_shipdate", names)


@query(
    "normalize_tz",
    "SELECT event_id, (ts + INTERVAL 5 HOUR)::TIMESTAMP AS utc FROM events",
)
def _(spark, sf):
    # the events of January read as New York wall clock: five hours behind UTC
    events = table(spark, sf, "events").select("event_id", F.col("ts").alias("utc"))
    return B.normalize_tz(events, "utc", "America/New_York")


_DELIVERY = """SELECT o_orderpriority AS ticker, o_orderdate AS date, o_totalprice AS close,
  o_custkey::DOUBLE AS volume, o_orderkey AS seq,
  CASE o_orderstatus WHEN 'F' THEN '2002-01-01' WHEN 'O' THEN '2002-01-02' ELSE '2002-01-03' END AS run_date FROM orders"""


def _delivery(spark, sf):
    run = F.when(F.col("o_orderstatus") == "F", "2002-01-01").when(F.col("o_orderstatus") == "O", "2002-01-02").otherwise("2002-01-03")
    return table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias(KEY),
        F.col("o_orderdate").alias(ORDER),
        F.col("o_totalprice").alias("close"),
        F.col("o_custkey").cast("double").alias("volume"),
        F.col("o_orderkey").alias("seq"),
        run.alias("run_date"),
    )


@query(
    "dedup_first",
    f"SELECT ticker, date, close, volume FROM ({_DELIVERY}) QUALIFY row_number() OVER (PARTITION BY ticker, date ORDER BY seq) = 1",
)
def _(spark, sf):
    return B.dedup_first(_delivery(spark, sf).drop("run_date"))


@query(
    "dedup_latest",
    f"""SELECT ticker, date, close, volume FROM ({_DELIVERY})
QUALIFY row_number() OVER (PARTITION BY ticker, date ORDER BY run_date DESC, seq DESC) = 1""",
)
def _(spark, sf):
    return B.dedup_latest(_delivery(spark, sf))


@query(
    "drop_empty_prices",
    f"""SELECT {BAR_COLS} FROM ({Q.NULL_BARS})
WHERE NOT (open IS NULL AND high IS NULL AND low IS NULL AND close IS NULL)""",
)
def _(spark, sf):
    return B.drop_empty_prices(null_bars(spark, sf))


@query(
    "lookback",
    f"""SELECT {BAR_COLS} FROM ({Q.ORDER_BARS})
WHERE date >= DATE '{ORDERS_ASOF}' - INTERVAL 150 DAY AND date < TIMESTAMP '{ORDERS_ASOF}'""",
)
def _(spark, sf):
    return B.lookback(order_bars(spark, sf), 90, ORDERS_ASOF)


# --- validation -----------------------------------------------------------------------------------------------------

_VALID = """SELECT ticker, count(*) AS row_count,
  avg((open IS NULL)::INT) AS n_open, avg((high IS NULL)::INT) AS n_high, avg((low IS NULL)::INT) AS n_low, avg((close IS NULL)::INT) AS n_close,
  coalesce(bool_or(open < 0.01::DOUBLE), false) AS l_open, coalesce(bool_or(high < 0.01::DOUBLE), false) AS l_high,
  coalesce(bool_or(low < 0.01::DOUBLE), false) AS l_low, coalesce(bool_or(close < 0.01::DOUBLE), false) AS l_close,
  coalesce(bool_or(open > 1000000), false) AS h_open, coalesce(bool_or(high > 1000000), false) AS h_high,
  coalesce(bool_or(low > 1000000), false) AS h_low, coalesce(bool_or(close > 1000000), false) AS h_close,
  coalesce(bool_or(volume < 0), false) AS neg,
  avg(CASE WHEN volume IS NOT NULL THEN (volume = 0)::INT END) AS zero,
  count(*) FILTER (WHERE open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL AND high < greatest(open, close, low)) AS bh,
  count(*) FILTER (WHERE open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL AND low > least(open, close, high)) AS bl
FROM b GROUP BY ticker"""


def _report_sql(bars: str, extra_keys: str | None = None) -> str:
    def pct(x):
        return f"printf('%.1f%%', round_even({x} * 100, 1))"

    prices = ("open", "high", "low", "close")
    errors = ["CASE WHEN row_count < 10 THEN 'row_count: ' || row_count END"]
    errors += [f"CASE WHEN n_{c} > 0.05::DOUBLE THEN 'null_share {c}: ' || {pct('n_' + c)} END" for c in prices]
    errors += [f"CASE WHEN l_{c} THEN 'price_floor {c}: 0.01' END" for c in prices]
    errors += ["CASE WHEN neg THEN 'sign volume: negative' END"]
    errors += ["CASE WHEN bh > 0 THEN 'bad_high rows: ' || bh END", "CASE WHEN bl > 0 THEN 'bad_low rows: ' || bl END"]
    warnings = [f"CASE WHEN n_{c} > 0 AND n_{c} <= 0.05::DOUBLE THEN 'null_share {c}: ' || {pct('n_' + c)} END" for c in prices]
    warnings += [f"CASE WHEN h_{c} THEN 'price_ceiling {c}: 1000000.0' END" for c in prices]
    warnings += [f"CASE WHEN zero > 0.1::DOUBLE THEN 'zero_share volume: ' || {pct('zero')} END"]
    out = f"""WITH b AS ({bars}), a AS ({_VALID}),
e AS (SELECT ticker, concat_ws(' | ', {', '.join(errors)}) AS errors, concat_ws(' | ', {', '.join(warnings)}) AS warnings,
  row_count::BIGINT AS row_count FROM a)"""
    if extra_keys:
        out += f""",
q AS ({extra_keys}), y AS (SELECT * FROM e WHERE ticker IN (SELECT ticker FROM q)
  UNION ALL SELECT ticker, 'no_rows', '', 0 FROM q WHERE ticker NOT IN (SELECT ticker FROM e))"""
    else:
        out += ", y AS (SELECT * FROM e)"
    return out + ", rep AS (SELECT ticker, errors = '' AS passed, errors, warnings, row_count FROM y)"


def _flat(report: DataFrame) -> DataFrame:
    return report.withColumn("errors", F.array_join("errors", " | ")).withColumn("warnings", F.array_join("warnings", " | "))


@query("validate_bars", _report_sql(Q.DIRTY_BARS) + " SELECT * FROM rep")
def _(spark, sf):
    return _flat(validate.validate_bars(dirty_bars(spark, sf)))


_CUSTOMER_BARS = """SELECT o_custkey::VARCHAR AS ticker, o_orderdate AS date, o_totalprice * 10 AS open, o_totalprice * 10 AS high,
  o_totalprice * 10 AS low, o_totalprice * 10 AS close, o_totalprice - 20000 AS volume FROM orders"""
_ALL_CUSTOMERS = "SELECT c_custkey::VARCHAR AS ticker FROM customer"


def _customer_bars(spark, sf):
    ten = F.col("o_totalprice") * 10
    return table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias(KEY),
        F.col("o_orderdate").alias(ORDER),
        *[ten.alias(c) for c in ("open", "high", "low", "close")],
        (F.col("o_totalprice") - 20000).alias("volume"),
    )


def _all_customers(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias(KEY))


@query("validate_requested_keys", _report_sql(_CUSTOMER_BARS, _ALL_CUSTOMERS) + " SELECT * FROM rep")
def _(spark, sf):
    return _flat(validate.validate_bars(_customer_bars(spark, sf), _all_customers(spark, sf)))


@query(
    "profile_bars",
    f"""WITH b AS ({Q.DIRTY_BARS}), a AS ({_VALID}) SELECT ticker, row_count::BIGINT AS row_count, {r('n_close', 6, 'close_null_share')},
  l_low AS low_too_low, h_high AS high_too_high, neg AS volume_negative, {r('zero', 6, 'zero_volume_share')},
  bh::BIGINT AS bad_high, bl::BIGINT AS bad_low FROM a""",
)
def _(spark, sf):
    return validate.profile_bars(dirty_bars(spark, sf)).select(
        KEY, "row_count", F.round("close_null_share", 6).alias("close_null_share"), "low_too_low", "high_too_high",
        "volume_negative", F.round("zero_volume_share", 6).alias("zero_volume_share"), "bad_high", "bad_low",
    )


@query("route_valid", _report_sql(Q.DIRTY_BARS) + """
SELECT ticker, date, open, volume FROM b WHERE ticker IN (SELECT ticker FROM rep WHERE passed)""")
def _(spark, sf):
    bars = dirty_bars(spark, sf)
    good, _bad = validate.route_valid(bars, validate.validate_bars(bars))
    return good.select(KEY, ORDER, "open", "volume")


@query("route_invalid", _report_sql(Q.DIRTY_BARS) + """
SELECT ticker, date, open, volume FROM b WHERE ticker IN (SELECT ticker FROM rep WHERE NOT passed)""")
def _(spark, sf):
    bars = dirty_bars(spark, sf)
    _good, bad = validate.route_valid(bars, validate.validate_bars(bars))
    return bad.select(KEY, ORDER, "open", "volume")


_STATUS = """, st AS (SELECT ticker, CASE WHEN passed THEN 'success' ELSE 'failed' END AS status,
  CASE WHEN NOT passed THEN replace(errors, ' | ', '; ') END AS reason FROM rep)"""


@query("run_keys_status", _report_sql(_CUSTOMER_BARS, _ALL_CUSTOMERS) + _STATUS + " SELECT * FROM st")
def _(spark, sf):
    keys = _all_customers(spark, sf)
    return validate.key_status(keys, validate.validate_bars(_customer_bars(spark, sf), keys))


@query("run_keys_counts", _report_sql(_CUSTOMER_BARS, _ALL_CUSTOMERS) + _STATUS + """
SELECT count(*)::BIGINT AS total, (count(*) FILTER (WHERE status = 'success'))::BIGINT AS success,
  (count(*) FILTER (WHERE status = 'failed'))::BIGINT AS failed FROM st""")
def _(spark, sf):
    keys = _all_customers(spark, sf)
    return validate.run_counts(validate.key_status(keys, validate.validate_bars(_customer_bars(spark, sf), keys)))


_SUMMARY = """, su AS (SELECT count(*)::BIGINT AS total, (count(*) FILTER (WHERE row_count > 0))::BIGINT AS downloaded,
  (count(*) FILTER (WHERE passed))::BIGINT AS validated, (count(*) FILTER (WHERE passed))::BIGINT AS stored,
  (count(*) FILTER (WHERE row_count > 0 AND NOT passed))::BIGINT AS failed_validation FROM rep)"""


def _summary(spark, sf):
    return validate.ingest_summary(validate.validate_bars(_customer_bars(spark, sf), _all_customers(spark, sf)))


@query("ingest_summary", _report_sql(_CUSTOMER_BARS, _ALL_CUSTOMERS) + _SUMMARY + " SELECT * FROM su")
def _(spark, sf):
    return _summary(spark, sf)


@query("ingest_outcomes", _report_sql(_CUSTOMER_BARS, _ALL_CUSTOMERS) + """
SELECT ticker, CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END AS validation, row_count AS rows, errors FROM rep""")
def _(spark, sf):
    out = validate.ingest_outcomes(validate.validate_bars(_customer_bars(spark, sf), _all_customers(spark, sf)))
    return out.withColumn("errors", F.array_join("errors", " | "))


@query("gate_stored", _report_sql(_CUSTOMER_BARS, _ALL_CUSTOMERS) + _SUMMARY + " SELECT stored, total, stored > 0 AS ok FROM su")
def _(spark, sf):
    return gates.stored_gate(_summary(spark, sf))


# --- features -------------------------------------------------------------------------------------------------------


def _feature_query(name, cols, bars, bars_sql, smoothing, digits=None, series=DAILY):
    digits = {**DIGITS, **(digits or {})}
    sql = f"WITH {Q.features_cte(bars_sql, smoothing)} SELECT ticker, date, {rounded(cols, digits)} FROM f"

    @query(name, sql)
    def _(spark, sf):
        return show(compute_features(bars(spark, sf), series, drop_warmup=False), cols, digits)


_feature_query(
    "features_returns",
    ["returns_1d", "returns_5d", "returns_10d", "high_low_range", "close_open_spread"],
    order_bars, Q.ORDER_BARS, False,
)
_feature_query(
    "features_moving_averages",
    ["sma_10", "sma_20", "sma_50", "close_to_sma20", "close_to_sma50", "sma10_sma20_cross"],
    order_bars, Q.ORDER_BARS, False,
)
_feature_query("features_ema_macd", SMOOTHED, order_bars, Q.ORDER_BARS, True)
_feature_query("features_rsi", ["rsi_14"], order_bars, Q.ORDER_BARS, True)
_feature_query("features_bollinger", ["bb_upper", "bb_lower", "bb_width", "bb_pos"], order_bars, Q.ORDER_BARS, False)
_feature_query("features_atr", ["atr_14"], order_bars, Q.ORDER_BARS, True)
_feature_query(
    "features_volume", ["volume_sma_10", "volume_ratio", "log_volume"], line_bars, Q.line_bars("l_returnflag"), False,
)
_feature_query(
    "features_lags",
    [f"{kind}_lag_{n}" for kind in ("close", "return") for n in (1, 2, 3, 5, 10)],
    order_bars, Q.ORDER_BARS, False,
)
_feature_query("features_passthrough", ["open", "high", "low", "close", "volume"], order_bars, Q.ORDER_BARS, False)
_feature_query("features_targets", TARGETS, order_bars, Q.ORDER_BARS, False)
_feature_query("features_hourly_events", ["sma_50", "ema_12", "rsi_14", "macd_signal", "atr_14"], event_bars, Q.event_bars("hour"), True, series=HOURLY)


@query(
    "compute_features",
    f"WITH {Q.features_cte(Q.ORDER_BARS)} SELECT ticker, date, {rounded(FEATURES + TARGETS)} FROM f WHERE {Q.WARM}",
)
def _(spark, sf):
    return show(compute_features(order_bars(spark, sf)), FEATURES + TARGETS)


@query(
    "compute_features_scoring",
    f"WITH {Q.features_cte(Q.ORDER_BARS)} SELECT ticker, date, {rounded(FEATURES)} FROM f WHERE sma_50 IS NOT NULL AND i >= 14",
)
def _(spark, sf):
    return show(compute_features(order_bars(spark, sf), require_target=False), FEATURES)


_LINE_TOTALS = Q.line_bars("l_returnflag", "l_extendedprice")


@query(
    "compute_features_segmented",
    f"WITH {Q.features_cte(_LINE_TOTALS)} SELECT ticker, date, {rounded(FEATURES)} FROM f WHERE {Q.WARM}",
)
def _(spark, sf):
    # keys cut into segments of 1024 rows, as for bars too fine for one task per key
    cut = Series(bucket="day", segment_rows=1024, force_segments=True)
    return show(compute_features(line_bars(spark, sf, per_unit=False), cut), FEATURES)


@query(
    "features_short_series_empty",
    f"WITH {Q.features_cte(Q.event_bars('day'))} SELECT ticker, date, close FROM f WHERE {Q.WARM}",
)
def _(spark, sf):
    return compute_features(event_bars(spark, sf, "day")).select(KEY, ORDER, "close")


def _ewm_sql(alpha, adjust, bars=Q.ORDER_BARS):
    return f"""WITH b AS ({bars}), s AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date) - 1 AS i FROM b)
SELECT t.ticker, t.date, {r(Q._ewm(alpha, 'close', adjust), 2, 'y')}
FROM s t JOIN s e ON t.ticker = e.ticker AND e.i <= t.i GROUP BY t.ticker, t.date, t.i"""


@query("ewm_span", _ewm_sql("(2.0::DOUBLE / 13)", False))
def _(spark, sf):
    return ewm_mean(order_bars(spark, sf), "close", "y", span=12, adjust=False).select(KEY, ORDER, F.round("y", 2).alias("y"))


@query("ewm_com_adjusted", _ewm_sql("(1.0::DOUBLE / 14)", True))
def _(spark, sf):
    return ewm_mean(order_bars(spark, sf), "close", "y", com=13).select(KEY, ORDER, F.round("y", 2).alias("y"))


@query(
    "ewm_nulls",
    f"""WITH RECURSIVE b AS ({Q.NULL_BARS}), s AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date) - 1 AS i FROM b),
w AS (SELECT ticker, date, i, close AS y, CASE WHEN close IS NULL THEN NULL::DOUBLE ELSE 1.0::DOUBLE END AS old FROM s WHERE i = 0
  UNION ALL
  SELECT s.ticker, s.date, s.i,
    CASE WHEN w.y IS NULL THEN s.close WHEN s.close IS NULL THEN w.y
      ELSE (w.old * 25.0::DOUBLE / 27 * w.y + 2.0::DOUBLE / 27 * s.close) / (w.old * 25.0::DOUBLE / 27 + 2.0::DOUBLE / 27) END,
    CASE WHEN s.close IS NOT NULL THEN 1.0::DOUBLE ELSE w.old * 25.0::DOUBLE / 27 END
  FROM w JOIN s ON s.ticker = w.ticker AND s.i = w.i + 1)
SELECT ticker, date, {r('y', 2, 'y')} FROM w""",
)
def _(spark, sf):
    return ewm_mean(null_bars(spark, sf), "close", "y", span=26, adjust=False).select(KEY, ORDER, F.round("y", 2).alias("y"))


_GAP_BARS = Q.NULL_BARS.replace("o_orderstatus <> 'P'", "year(o_orderdate) % 2 = 1")


@query(
    "ewm_nulls_segmented",
    f"""WITH RECURSIVE b AS ({_GAP_BARS}), s AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date) - 1 AS i FROM b),
w AS (SELECT ticker, date, i, close AS y, CASE WHEN close IS NULL THEN NULL::DOUBLE ELSE 1.0::DOUBLE END AS old, close AS z,
    CASE WHEN close IS NULL THEN NULL::DOUBLE ELSE 1.0::DOUBLE END AS weight, (close IS NOT NULL)::INT AS seen FROM s WHERE i = 0
  UNION ALL
  SELECT s.ticker, s.date, s.i,
    CASE WHEN w.y IS NULL THEN s.close WHEN s.close IS NULL THEN w.y
      ELSE (w.old * 25.0::DOUBLE / 27 * w.y + 2.0::DOUBLE / 27 * s.close) / (w.old * 25.0::DOUBLE / 27 + 2.0::DOUBLE / 27) END,
    CASE WHEN s.close IS NOT NULL THEN 1.0::DOUBLE ELSE w.old * 25.0::DOUBLE / 27 END,
    CASE WHEN w.z IS NULL THEN s.close WHEN s.close IS NULL THEN w.z
      ELSE (w.weight * 13.0::DOUBLE / 14 * w.z + s.close) / (w.weight * 13.0::DOUBLE / 14 + 1) END,
    CASE WHEN w.z IS NULL THEN CASE WHEN s.close IS NOT NULL THEN 1.0::DOUBLE END
      ELSE w.weight * 13.0::DOUBLE / 14 + (s.close IS NOT NULL)::INT END,
    w.seen + (s.close IS NOT NULL)::INT
  FROM w JOIN s ON s.ticker = w.ticker AND s.i = w.i + 1)
SELECT ticker, date, {r('y', 2, 'y')}, CASE WHEN seen >= 14 THEN {r('z', 2)} END AS z FROM w""",
)
def _(spark, sf):
    # every second year is without prices: runs of nulls are longer than the segments of 64 rows
    known = F.when(F.year("o_orderdate") % 2 == 1, F.col("o_totalprice"))
    bars = B.bars_from_ticks(table(spark, sf, "orders"), "o_orderpriority", "o_orderdate", known, seq="o_orderkey")
    cut = Series(bucket="day", segment_rows=64, force_segments=True)
    means = ewm_mean(bars, "close", "y", span=26, adjust=False, series=cut)
    means = ewm_mean(means, "close", "z", com=13, min_periods=14, series=cut)
    return means.select(KEY, ORDER, F.round("y", 2).alias("y"), F.round("z", 2).alias("z"))



# --- split, scale, sequences ----------------------------------------------------------------------------------------


def _split(spark, sf):
    return prep.chrono_split(compute_features(order_bars(spark, sf)))


@query("chrono_split", f"WITH {Q.split_cte(Q.ORDER_BARS, True)} SELECT ticker, date, split FROM k")
def _(spark, sf):
    return _split(spark, sf).select(KEY, ORDER, "split")


@query("chrono_split_hourly", f"WITH {Q.split_cte(Q.event_bars('hour'), True)} SELECT ticker, date, split FROM k")
def _(spark, sf):
    return prep.chrono_split(compute_features(event_bars(spark, sf), HOURLY), series=HOURLY).select(KEY, ORDER, "split")


@query(
    "fit_robust_scaler",
    f"WITH {Q.split_cte(Q.ORDER_BARS)}{Q.scaler_cte(FEATURES)} SELECT ticker, feature, {r('center', 6, 'center')}, {r('scale', 6, 'scale')} FROM sc",
)
def _(spark, sf):
    return show(prep.fit_robust_scaler(_split(spark, sf)), ["center", "scale"], {"center": 6, "scale": 6}, (KEY, "feature"))


@query(
    "fit_robust_scaler_hourly",
    f"WITH {Q.split_cte(Q.event_bars('hour'))}{Q.scaler_cte(FEATURES)} SELECT ticker, feature, {r('center', 5, 'center')}, {r('scale', 5, 'scale')} FROM sc",
)
def _(spark, sf):
    # hourly bars have no proven row bound: quantiles from ranked counts in slices
    split = stage(prep.chrono_split(compute_features(event_bars(spark, sf), HOURLY), series=HOURLY), "split")
    return show(prep.fit_robust_scaler(split, series=HOURLY), ["center", "scale"], {"center": 5, "scale": 5}, (KEY, "feature"))


_SCALED = [c for c in FEATURES]


def _scaled_cte() -> str:
    """Adds ``w2`` (one scaler row per key) and ``x2`` (scaled rows)."""
    wide = ", ".join(
        f"max(CASE WHEN feature = '{c}' THEN center END) AS {c}_c, max(CASE WHEN feature = '{c}' THEN scale END) AS {c}_s" for c in _SCALED
    )
    scaled = ", ".join(f"({c} - {c}_c) / {c}_s AS {c}" for c in _SCALED)
    return f""",
w2 AS (SELECT ticker, {wide} FROM sc GROUP BY ticker),
x2 AS (SELECT k.ticker, date, split, i2, {scaled}, target_next_close, target_next_return FROM k JOIN w2 ON k.ticker = w2.ticker)"""


_SCALED_SQL = f"WITH {Q.split_cte(Q.ORDER_BARS)}{Q.scaler_cte(FEATURES)}{_scaled_cte()}"


def _scaled(spark, sf):
    # fitting and applying both read the split table
    split = stage(_split(spark, sf), "split")
    return prep.apply_scaler(split, prep.fit_robust_scaler(split))


@query(
    "apply_scaler",
    f"{_SCALED_SQL} SELECT ticker, date, split, {', '.join(r(c, 5, c) for c in FEATURES)}, {r('target_next_close', 4, 'target_next_close')} FROM x2",
)
def _(spark, sf):
    return show(_scaled(spark, sf), FEATURES + ["target_next_close"], {**dict.fromkeys(FEATURES, 5), "target_next_close": 4}, (KEY, ORDER, "split"))


@query(
    "scaled_train_medians",
    f"""{_SCALED_SQL} SELECT ticker, feature, {r('median(value)', 6, 'center')}
FROM {Q.tall("(SELECT * FROM x2 WHERE split = 'train')", FEATURES)} GROUP BY ALL""",
)
def _(spark, sf):
    # the training part has median 0 after scaling
    scaled = stage(_scaled(spark, sf), "scaled")
    return prep.fit_robust_scaler(scaled).select(KEY, "feature", F.round("center", 6).alias("center"))


def _weighted(lists: str, col: str) -> str:
    """All steps of a feature in one number: the first step once, the second twice and so on."""
    return r(f"list_sum(list_transform({lists}, lambda v, i: v::DOUBLE * i))", 2, col)


def _sequence_sql(back: int, ahead: int) -> str:
    o = "OVER (PARTITION BY ticker, split ORDER BY date"
    frame = f"ROWS BETWEEN {back} PRECEDING AND {f'{ahead} PRECEDING' if ahead else 'CURRENT ROW'}"
    steps = ", ".join(f"list({c}::FLOAT) {o} {frame}) AS {c}" for c in FEATURES)
    return f"""{_SCALED_SQL}, l AS (SELECT ticker, date, split, target_next_close::FLOAT::DOUBLE AS y, row_number() {o}) AS rn, {steps} FROM x2)
SELECT ticker, date, split, 30::BIGINT AS steps, {len(FEATURES)}::BIGINT AS width, {", ".join(_weighted(c, c) for c in FEATURES)}, {r('y', 2, 'y')} FROM l WHERE rn > {back}"""


def _all_steps(steps):
    """The same number for every feature of a sequence."""

    def weighted(i: int):
        return F.aggregate(F.transform(steps, lambda row, s: row[i].cast("double") * (s + 1)), F.lit(0.0), lambda a, v: a + v)

    return [F.round(weighted(i), 2).alias(c) for i, c in enumerate(FEATURES)]


def _sequence_view(sequences):
    return sequences.select(
        KEY, ORDER, "split", F.size("X").cast("long").alias("steps"), F.size(F.element_at("X", 1)).cast("long").alias("width"),
        *_all_steps(F.col("X")), F.round(F.col("y").cast("double"), 2).alias("y"),
    )


@query("make_sequences", _sequence_sql(30, 1))
def _(spark, sf):
    return _sequence_view(prep.make_sequences(_scaled(spark, sf), FEATURES))


@query("make_sequences_current", _sequence_sql(29, 0))
def _(spark, sf):
    return _sequence_view(prep.make_sequences(_scaled(spark, sf), FEATURES, include_current=True))


@query(
    "split_report",
    f"""WITH {Q.split_cte(Q.ORDER_BARS)} SELECT ticker, (count(*) FILTER (WHERE split = 'train'))::BIGINT AS train_rows,
  (count(*) FILTER (WHERE split = 'val'))::BIGINT AS val_rows, (count(*) FILTER (WHERE split = 'test'))::BIGINT AS test_rows,
  40::BIGINT AS feature_count FROM k GROUP BY ticker""",
)
def _(spark, sf):
    return prep.split_report(_split(spark, sf))


@query(
    "reference_slice",
    f"WITH {Q.split_cte(Q.ORDER_BARS)} SELECT ticker, date, {rounded(FEATURES)} FROM k WHERE split = 'train'",
)
def _(spark, sf):
    return show(prep.reference_slice(compute_features(order_bars(spark, sf))), FEATURES)


# --- metrics, selection, registry -----------------------------------------------------------------------------------

# three plain forecasts of the next close stand for models: each is a feature the engine computes
_FORECASTS = {"random_forest": "sma_10", "boosted_trees": "close", "sequence": "ema_12"}


def _forecasts(spark, sf):
    split = _split(spark, sf)
    pairs = F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).alias("yhat")) for m, c in _FORECASTS.items()])
    return split.select(KEY, ORDER, "split", F.col("target_next_close").alias("y"), F.inline(pairs))


_FORECAST_SQL = f"WITH {Q.split_cte(Q.ORDER_BARS)}, fc AS (" + " UNION ALL ".join(
    f"SELECT ticker, date, split, target_next_close AS y, '{m}' AS model, {c} AS yhat FROM k" for m, c in _FORECASTS.items()
) + ")"


def _metrics_cte(by: str) -> str:
    return f""", me AS (SELECT {by}, round(avg(abs(y - yhat)), 4) AS mae, round(sqrt(avg((y - yhat) ^ 2)), 4) AS rmse,
  round(coalesce(avg(CASE WHEN y <> 0 THEN abs((y - yhat) / y) END) * 100, 'inf'::DOUBLE), 4) AS mape,
  round(CASE WHEN var_pop(y) > 0 THEN 1 - sum((y - yhat) ^ 2) / sum((y - m) ^ 2) ELSE 0 END, 4) AS r2
  FROM (SELECT *, avg(y) OVER (PARTITION BY {by}) AS m FROM fc) GROUP BY {by})"""


_METRICS_SQL = _FORECAST_SQL + _metrics_cte("ticker, model, split")


@query("forecast_metrics", _METRICS_SQL + " SELECT ticker, model, split, mae, rmse, mape, r2 FROM me")
def _(spark, sf):
    return metrics.forecast_metrics(_forecasts(spark, sf))


@query("forecast_metrics_by_model", _FORECAST_SQL + _metrics_cte("model, split") + " SELECT model, split, mae, rmse, mape, r2 FROM me")
def _(spark, sf):
    return metrics.forecast_metrics(_forecasts(spark, sf), by=("model", "split"))


_RANKED = """, rk AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY rmse,
  CASE model WHEN 'random_forest' THEN 1 WHEN 'boosted_trees' THEN 2 ELSE 3 END) AS place FROM me WHERE split = 'val')"""


@query("select_best", _METRICS_SQL + _RANKED + " SELECT ticker, model AS best_model, rmse AS val_rmse FROM rk WHERE place = 1")
def _(spark, sf):
    return metrics.select_best(metrics.forecast_metrics(_forecasts(spark, sf)))


@query(
    "run_log",
    _METRICS_SQL + """, lg AS (UNPIVOT (SELECT ticker, model, split, mae, rmse, mape, r2 FROM me) ON mae, rmse, mape, r2 INTO NAME metric VALUE value)
SELECT 'run-1' AS run_id, ticker, model, 'metric' AS kind, split || '_' || metric AS name, round(value, 4) AS value, 0::BIGINT AS step FROM lg""",
)
def _(spark, sf):
    log = metrics.run_log(metrics.forecast_metrics(_forecasts(spark, sf)), "run-1")
    return log.withColumn("value", F.round(F.col("value").cast("double"), 4))


def _registry(spark, sf):
    scored = stage(metrics.forecast_metrics(_forecasts(spark, sf)), "metrics")
    paths = scored.select(KEY, "model").distinct().withColumn("model_path", F.concat(F.lit("registry/"), "model", F.lit("/"), KEY))
    return metrics.build_registry(scored, paths, "run-1")


_REGISTRY_SQL = _METRICS_SQL + _RANKED + """, rg AS (SELECT v.ticker, v.model AS best_model, 'registry/' || v.model || '/' || v.ticker AS model_path,
  v.rmse AS val_rmse, v.r2 AS val_r2, t.rmse AS test_rmse, t.r2 AS test_r2,
  (SELECT string_agg(model || '=' || printf('%.2f', rmse), ',' ORDER BY CASE model WHEN 'random_forest' THEN 1 WHEN 'boosted_trees' THEN 2 ELSE 3 END)
   FROM me m WHERE m.ticker = v.ticker AND m.split = 'val') AS all_results
  FROM rk v JOIN me t ON t.ticker = v.ticker AND t.model = v.model AND t.split = 'test' WHERE place = 1)"""


def _flat_registry(registry):
    results = F.transform("all_results", lambda x: F.concat(x["model"], F.lit("="), F.format_string("%.2f", x["val_metrics"]["rmse"])))
    return registry.select(
        KEY, "best_model", "model_path", F.col("val_metrics.rmse").alias("val_rmse"), F.col("val_metrics.r2").alias("val_r2"),
        F.col("test_metrics.rmse").alias("test_rmse"), F.col("test_metrics.r2").alias("test_r2"), F.array_join(results, ",").alias("all_results"),
    )


@query("registry", _REGISTRY_SQL + " SELECT * FROM rg")
def _(spark, sf):
    return _flat_registry(_registry(spark, sf))


@query("list_keys", _REGISTRY_SQL + " SELECT ticker FROM rg ORDER BY ticker")
def _(spark, sf):
    return metrics.list_keys(_registry(spark, sf))


@query("list_models", _REGISTRY_SQL + " SELECT ticker, best_model, model_path FROM rg ORDER BY ticker")
def _(spark, sf):
    return metrics.list_models(_registry(spark, sf)).select(KEY, "best_model", "model_path")


@query("get_model", _REGISTRY_SQL + " SELECT * FROM rg WHERE upper(ticker) = '1-URGENT'")
def _(spark, sf):
    return _flat_registry(metrics.get_model(_registry(spark, sf), "1-urgent"))


# --- scoring --------------------------------------------------------------------------------------------------------


@query(
    "latest_features",
    f"""WITH {Q.features_cte(Q.ORDER_BARS)} SELECT ticker, date, {rounded(FEATURES)} FROM f WHERE sma_50 IS NOT NULL AND i >= 14
QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1""",
)
def _(spark, sf):
    return show(score.latest_features(compute_features(order_bars(spark, sf), require_target=False)), FEATURES)


@query(
    "latest_features_scaled",
    f"""{_SCALED_SQL}, n2 AS (SELECT * FROM x2 QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1)
SELECT ticker, date, {', '.join(r(c, 5, c) for c in FEATURES)} FROM n2""",
)
def _(spark, sf):
    # the newest bar whose next close is known, scaled with the stored scaler
    features = stage(compute_features(order_bars(spark, sf)), "features")
    newest = score.latest_features(features)
    scaler = prep.fit_robust_scaler(prep.chrono_split(features))
    return show(prep.apply_scaler(newest, scaler), FEATURES, dict.fromkeys(FEATURES, 5))


@query(
    "scoring_rows_lookback",
    f"""WITH {Q.features_cte("SELECT * FROM (" + Q.ORDER_BARS + f") WHERE date >= DATE '{ORDERS_ASOF}' - INTERVAL 180 DAY AND date < TIMESTAMP '{ORDERS_ASOF}'")}
SELECT ticker, date, {rounded(FEATURES)} FROM f WHERE sma_50 IS NOT NULL AND i >= 14""",
)
def _(spark, sf):
    # a scaler that changes nothing: what is compared is the choice of rows and their features
    bars = order_bars(spark, sf)
    same = bars.select(KEY).distinct().select(KEY, F.explode(F.array(*[F.lit(c) for c in FEATURES])).alias("feature"), F.lit(0.0).alias("center"), F.lit(1.0).alias("scale"))
    return show(score.scoring_rows(bars, same, ORDERS_ASOF, 120), FEATURES)


@query(
    "next_weekday",
    """SELECT event_id, (CASE dayofweek(ts) WHEN 5 THEN ts::DATE + 3 WHEN 6 THEN ts::DATE + 2 ELSE ts::DATE + 1 END)::VARCHAR AS day FROM events""",
)
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", score.next_weekday("ts").cast("string").alias("day"))


@query(
    "last_sequence",
    f"""{_SCALED_SQL}, o AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS back FROM x2),
l AS (SELECT ticker, max(date) AS date, {", ".join(f"list({c}::FLOAT ORDER BY date) AS {c}" for c in FEATURES)} FROM o WHERE back <= 30 GROUP BY ticker)
SELECT ticker, date, 30::BIGINT AS steps, {", ".join(_weighted(c, c) for c in FEATURES)} FROM l""",
)
def _(spark, sf):
    rows = score.last_sequence(_scaled(spark, sf), FEATURES)
    return rows.select(KEY, ORDER, F.size("X").cast("long").alias("steps"), *_all_steps(F.col("X")))


# --- drift ----------------------------------------------------------------------------------------------------------

# features that are the same to the last bit in any engine: sums of prices in another order may make one value two
_EXACT = [c for c in FEATURES if c in ("open", "high", "low", "close", "volume", "high_low_range", "close_open_spread") or c.startswith(("returns_", "close_lag_", "return_lag_"))]
_PAIR_SQL = f"WITH RECURSIVE {Q.split_cte(Q.ORDER_BARS)}, rf AS (SELECT * FROM k WHERE split = 'train'), cu AS (SELECT * FROM k WHERE split <> 'train')"
_EVENT_PAIR_SQL = f"WITH RECURSIVE {Q.split_cte(Q.event_bars('hour'))}, rf AS (SELECT * FROM k WHERE split = 'train'), cu AS (SELECT * FROM k WHERE split <> 'train')"


def _pair(spark, sf, bars=order_bars, series=DAILY):
    split = stage(prep.chrono_split(compute_features(bars(spark, sf), series), series=series), "split")
    return split.filter("split = 'train'"), split.filter("split <> 'train'")


def _ecdf_view(ecdf):
    # neighbouring sums of the same prices may differ in the last bit, so values are shown rounded
    digits = {"value": 9, "next_value": 9, "f_ref": 6, "f_cur": 6}
    return ecdf.select(KEY, "feature", *[F.round(c, d).alias(c) for c, d in digits.items()], "n_ref", "n_cur")


@query(
    "ecdf_pair",
    _PAIR_SQL + Q.ecdf_cte("rf", "cu", _EXACT) + f" SELECT ticker, feature, {r('value', 9, 'value')}, {r('next_value', 9, 'next_value')}, {r('f_ref', 6, 'f_ref')}, {r('f_cur', 6, 'f_cur')}, n_ref, n_cur FROM ec",
)
def _(spark, sf):
    ref, cur = _pair(spark, sf)
    return _ecdf_view(drift.ecdf_pair(ref, cur, _EXACT))


@query(
    "ecdf_pair_sliced",
    _EVENT_PAIR_SQL + Q.ecdf_cte("rf", "cu", _EXACT) + f" SELECT ticker, feature, {r('value', 9, 'value')}, {r('next_value', 9, 'next_value')}, {r('f_ref', 6, 'f_ref')}, {r('f_cur', 6, 'f_cur')}, n_ref, n_cur FROM ec",
)
def _(spark, sf):
    # hourly bars have no proven row bound: running counts in slices of neighbouring values
    ref, cur = _pair(spark, sf, event_bars, HOURLY)
    return _ecdf_view(drift.ecdf_pair(ref, cur, _EXACT, HOURLY))


@query(
    "two_sample_statistics",
    _PAIR_SQL + Q.ecdf_cte("rf", "cu", FEATURES) + f""" SELECT ticker, feature, max(n_ref) AS n_ref, max(n_cur) AS n_cur,
  {r('max(abs(f_ref - f_cur))', 6, 'ks')}, {r('sum(abs(f_ref - f_cur) * coalesce(next_value - value, 0))', 4, 'wasserstein')} FROM ec GROUP BY ALL""",
)
def _(spark, sf):
    stats = drift.two_sample(drift.ecdf_pair(*_pair(spark, sf), FEATURES))
    return stats.withColumns({"ks": F.round("ks", 6), "wasserstein": F.round("wasserstein", 4)})


@query(
    "ks_pvalue",
    f"""WITH a AS (SELECT event_id, value / 1000 AS d FROM events WHERE value IS NOT NULL)
SELECT event_id, {r(Q.pvalue('d', '900', '400'), 8, 'p')} FROM a""",
)
def _(spark, sf):
    events = table(spark, sf, "events").filter("value IS NOT NULL")
    p = drift.ks_pvalue(F.col("value") / 1000, F.lit(900), F.lit(400), exact_rows=0)
    return events.select("event_id", F.round(p, 8).alias("p"))


@query(
    "ks_pvalue_exact",
    """WITH RECURSIVE s AS (SELECT DISTINCT 1 + user_id % 23 AS n, 2 + event_id % 17 AS m, floor(value)::BIGINT AS v FROM events WHERE value IS NOT NULL),
d AS (SELECT DISTINCT n, m, 1 + v % (n * m) AS h FROM s),
paths(n, m, h, t, a) USING KEY (n, m, h) AS (
  SELECT n, m, h, 0::BIGINT, list_transform(range(0, n + 1), lambda i: (i = 0)::INT::HUGEINT) FROM d
  UNION SELECT n, m, h, t + 1, list_transform(range(0, n + 1), lambda i: CASE WHEN abs(i * m - (t + 1 - i) * n) < h AND t + 1 - i BETWEEN 0 AND m
    THEN a[i + 1] + CASE WHEN i > 0 THEN a[i] ELSE 0 END ELSE 0 END) FROM paths WHERE t < n + m),
every(n, m, t, a) USING KEY (n, m) AS (
  SELECT DISTINCT n, m, 0::BIGINT, list_transform(range(0, n + 1), lambda i: (i = 0)::INT::HUGEINT) FROM d
  UNION SELECT n, m, t + 1, list_transform(range(0, n + 1), lambda i: CASE WHEN t + 1 - i BETWEEN 0 AND m THEN a[i + 1] + CASE WHEN i > 0 THEN a[i] ELSE 0 END ELSE 0 END)
  FROM every WHERE t < n + m)
SELECT n AS n_ref, m AS n_cur, h, """ + r("1 - list_sum(p.a)::DOUBLE / list_sum(e.a)::DOUBLE", 10, "p") + """ FROM paths p JOIN every e USING (n, m)""",
)
def _(spark, sf):
    # samples of 1 to 23 and 2 to 18 values; the statistic is h / (n_ref * n_cur)
    events = table(spark, sf, "events").filter("value IS NOT NULL")
    sizes = events.selectExpr("1 + user_id % 23 AS n_ref", "2 + event_id % 17 AS n_cur", "bigint(floor(value)) AS v")
    cases = sizes.selectExpr("n_ref", "n_cur", "1 + v % (n_ref * n_cur) AS h").distinct()
    p = drift.ks_pvalue(F.col("h") / (F.col("n_ref") * F.col("n_cur")), F.col("n_ref"), F.col("n_cur"))
    return cases.withColumn("p", F.round(p, 10))


_COLUMN_DRIFT = " SELECT ticker, feature, n_ref, n_cur, " + ", ".join(
    r(c, 5, c) for c in ("ks", "ks_pvalue", "wasserstein_normed", "score")
) + ", test, drifted FROM cd"


def _column_view(df):
    return df.withColumns({c: F.round(c, 5) for c in ("ks", "ks_pvalue", "wasserstein_normed", "score")})


@query("column_drift", _PAIR_SQL + Q.column_drift_cte("rf", "cu", FEATURES) + _COLUMN_DRIFT)
def _(spark, sf):
    return _column_view(drift.column_drift(*_pair(spark, sf)))


@query("drift_from_baseline", _PAIR_SQL + Q.column_drift_cte("rf", "cu", FEATURES) + _COLUMN_DRIFT)
def _(spark, sf):
    # the reference is written as values and counts, and only that is read again
    root, bars = _new_root(spark, "baseline"), order_bars(spark, sf)
    features = stage(compute_features(bars), "features")
    pipeline.write_baseline(features, root)
    current = prep.chrono_split(features).filter("split <> 'train'")
    return _column_view(drift.column_verdicts(drift.baseline_statistics(B.read_stored(spark, f"{root}/baseline"), current, FEATURES)))


@query("column_drift_small_reference", _EVENT_PAIR_SQL + Q.column_drift_cte("rf", "cu", FEATURES) + _COLUMN_DRIFT)
def _(spark, sf):
    return _column_view(drift.column_drift(*_pair(spark, sf, event_bars, HOURLY), series=HOURLY))


_CURRENT_BARS = f"SELECT * FROM ({Q.ORDER_BARS}) WHERE date >= DATE '{ORDERS_ASOF}' - INTERVAL 180 DAY AND date < TIMESTAMP '{ORDERS_ASOF}'"


_TWO_SETS = f"""WITH RECURSIVE {Q.split_cte(Q.ORDER_BARS)}, rf AS (SELECT * FROM k WHERE split = 'train'),
{Q.features_cte(_CURRENT_BARS, prefix='q')},
cu AS (SELECT * FROM qf WHERE {Q.WARM})"""

_DATA_DRIFT = """, ks AS (SELECT DISTINCT ticker FROM b UNION ALL SELECT 'NONE'),
dk AS (SELECT ticker, avg(drifted::INT) AS share, string_agg(CASE WHEN drifted THEN feature END, ',' ORDER BY feature) AS names, count(*) AS total FROM cd GROUP BY ticker),
dd AS (SELECT ks.ticker, coalesce(share > 0.1::DOUBLE, false) AS drift_detected, round(coalesce(share, 0), 4) AS drift_score,
  coalesce(names, '') AS drifted_features, coalesce(total, 0)::BIGINT AS total_features,
  CASE WHEN ks.ticker NOT IN (SELECT ticker FROM cu) THEN 'no current rows'
       WHEN total IS NULL THEN 'no feature to compare' END AS error FROM ks LEFT JOIN dk ON ks.ticker = dk.ticker)"""


def _sides(spark, sf):
    """Split history, features of the last 120 days, and the keys to report.

    One key has no bars at all. Bars and features are stored first, as later steps share them.
    """
    bars = stage(order_bars(spark, sf), "bars")
    history = stage(prep.chrono_split(compute_features(bars)), "split")
    recent = B.lookback(bars, 120, ORDERS_ASOF)
    current = stage(compute_features(recent), "current")
    return history, current, keys_of(bars).union(validate.requested_keys(bars, ["NONE"]))


@query("data_drift", _TWO_SETS + Q.column_drift_cte("rf", "cu", FEATURES) + _DATA_DRIFT + " SELECT * FROM dd")
def _(spark, sf):
    history, current, keys = _sides(spark, sf)
    reference = history.filter("split = 'train'")
    return drift.data_drift(reference, current, keys).withColumn("drifted_features", F.array_join("drifted_features", ","))


_PREDICTED = """, pr AS (SELECT ticker, ema_12 AS predictions FROM k WHERE split = 'val'), pc AS (SELECT ticker, ema_12 AS predictions FROM cu)"""
_PREDICTION_DRIFT = """, pu AS (SELECT ticker, predictions AS value, 1 AS nr, 0 AS nc FROM pr UNION ALL SELECT ticker, predictions, 0, 1 FROM pc),
pv AS (SELECT ticker, value, sum(nr) AS nr, sum(nc) AS nc FROM pu GROUP BY ALL),
pe AS (SELECT ticker, sum(nr) OVER t AS n1, sum(nc) OVER t AS n2, sum(nr) OVER o AS ur, sum(nc) OVER o AS uc FROM pv
  WINDOW o AS (PARTITION BY ticker ORDER BY value), t AS (PARTITION BY ticker)),
pk AS (SELECT ticker, max(abs(ur::DOUBLE / n1 - uc::DOUBLE / n2)) AS ks, max(n1) AS n1, max(n2) AS n2 FROM pe WHERE n1 > 0 AND n2 > 0 GROUP BY ticker),
""" + Q.exact_law("plaw", "SELECT DISTINCT n1 AS n, n2 AS m, round(ks * n1 * n2) AS h FROM pk") + """,
pd AS (SELECT q.ticker, coalesce(ks > 0.1::DOUBLE, false) AS drift_detected, round(coalesce(ks, 0), 4) AS drift_score,
  CASE WHEN ks > 0.1::DOUBLE THEN 'predictions' ELSE '' END AS drifted_features, 1::BIGINT AS total_features,
  CASE WHEN ks IS NOT NULL THEN """ + r("1 - list_sum(a)", 6) + """ END AS p_value, CASE WHEN ks IS NULL THEN 'No predictions on one side' END AS error
  FROM (SELECT DISTINCT ticker FROM b UNION ALL SELECT 'NONE') q LEFT JOIN pk ON q.ticker = pk.ticker
  LEFT JOIN plaw ON n = n1 AND m = n2 AND h = round(ks * n1 * n2))"""


def _predictions(history, current):
    """The smoothed close as a stand-in forecast, on the validation split and on the current rows."""
    forecast = F.col("ema_12").alias("predictions")
    return history.filter("split = 'val'").select(KEY, forecast), current.select(KEY, forecast)


@query("prediction_drift", _TWO_SETS + _PREDICTED + _PREDICTION_DRIFT + " SELECT * FROM pd")
def _(spark, sf):
    history, current, keys = _sides(spark, sf)
    out = drift.prediction_drift(*_predictions(history, current), keys)
    return out.withColumn("drifted_features", F.array_join("drifted_features", ",")).withColumn("p_value", F.round("p_value", 6))


def _monitored(spark, sf):
    history, current, keys = _sides(spark, sf)
    data = drift.data_drift(history.filter("split = 'train'"), current, keys)
    return drift.monitor(keys, data, drift.prediction_drift(*_predictions(history, current), keys))


_MONITOR_SQL = _TWO_SETS + Q.column_drift_cte("rf", "cu", FEATURES) + _DATA_DRIFT + _PREDICTED + _PREDICTION_DRIFT + """,
mo AS (SELECT dd.ticker, CASE WHEN dd.error IS NOT NULL OR pd.error IS NOT NULL THEN 'failed' ELSE 'ok' END AS status,
  dd.drift_detected OR pd.drift_detected AS drift_detected, dd.drift_detected AS data_drift, pd.drift_detected AS prediction_drift,
  dd.drift_score AS data_score, pd.drift_score AS prediction_score, concat_ws('; ', dd.error, pd.error) AS error
  FROM dd JOIN pd ON dd.ticker = pd.ticker)"""


@query("monitor", _MONITOR_SQL + " SELECT * FROM mo")
def _(spark, sf):
    return _monitored(spark, sf)


@query(
    "monitor_totals",
    _MONITOR_SQL + """ SELECT count(*)::BIGINT AS total, bool_or(drift_detected) AS drift_detected,
  (count(*) FILTER (WHERE drift_detected))::BIGINT AS drifted, (count(*) FILTER (WHERE status = 'failed'))::BIGINT AS failed FROM mo""",
)
def _(spark, sf):
    return drift.monitor_totals(_monitored(spark, sf))


@query("retrain_list", _MONITOR_SQL + " SELECT ticker FROM mo WHERE drift_detected")
def _(spark, sf):
    return drift.retrain_list(_monitored(spark, sf))


# --- gates ----------------------------------------------------------------------------------------------------------


@query(
    "gate_outputs",
    f"""WITH {Q.split_cte(Q.ORDER_BARS)}, kk AS (SELECT DISTINCT ticker FROM b UNION SELECT DISTINCT event_type FROM events),
ex AS (SELECT ticker, unnest(['train', 'val', 'test']) AS output FROM kk)
SELECT ticker, output FROM ex WHERE (ticker, output) NOT IN (SELECT DISTINCT ticker, split FROM k)""",
)
def _(spark, sf):
    # daily bars of events are shorter than the warm-up: their outputs are missing
    events = table(spark, sf, "events").select(F.col("event_type").alias(KEY)).distinct()
    keys = keys_of(order_bars(spark, sf)).union(events).distinct()
    produced = _split(spark, sf).select(KEY, F.col("split").alias("output"))
    return gates.check_outputs(gates.expected_outputs(keys, ["train", "val", "test"]), produced)


@query(
    "gate_models",
    _REGISTRY_SQL + """, ex AS (SELECT ticker, unnest(['random_forest', 'boosted_trees', 'sequence', 'registry']) AS output
  FROM (SELECT DISTINCT ticker FROM b UNION SELECT DISTINCT event_type FROM events)),
have AS (SELECT DISTINCT ticker, model AS output FROM me UNION ALL SELECT ticker, 'registry' FROM rg)
SELECT ticker, output FROM ex WHERE (ticker, output) NOT IN (SELECT ticker, output FROM have)""",
)
def _(spark, sf):
    events = table(spark, sf, "events").select(F.col("event_type").alias(KEY)).distinct()
    keys = keys_of(order_bars(spark, sf)).union(events).distinct()
    models = _forecasts(spark, sf).select(KEY, F.col("model").alias("output"))
    rows = _registry(spark, sf).select(KEY, F.lit("registry").alias("output"))
    wanted = gates.expected_outputs(keys, ["random_forest", "boosted_trees", "sequence", "registry"])
    return gates.check_outputs(wanted, models.union(rows))


@query(
    "gate_no_leakage",
    f"""WITH {Q.split_cte(Q.ORDER_BARS)}, rg AS (SELECT ticker, split, min(date) AS first, max(date) AS last FROM k GROUP BY ALL)
SELECT ticker, split, first, last, coalesce(lag(last) OVER (PARTITION BY ticker ORDER BY first) < first, true) AS ok FROM rg""",
)
def _(spark, sf):
    return gates.check_no_leakage(_split(spark, sf))


# --- stored tables --------------------------------------------------------------------------------------------------


def _new_root(spark, name: str) -> str:
    return f"{stage_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query(
    "write_read_bars",
    f"""SELECT ticker, date, open, high, low, close, CASE WHEN date >= TIMESTAMP '2000-01-01' THEN volume * 2 ELSE volume END AS volume
FROM ({Q.ORDER_BARS}) WHERE ticker IN ('1-URGENT', '5-LOW') AND date >= TIMESTAMP '1997-01-01' AND date < TIMESTAMP '2001-01-01'""",
)
def _(spark, sf):
    # a second run delivers the later bars again with other volumes; writing it twice replaces it
    bars = stage(order_bars(spark, sf), "bars")
    path = _new_root(spark, "written")
    later = B.date_range(bars, "2000-01-01").withColumn("volume", F.col("volume") * 2)
    B.write_bars(bars, path, "2002-01-01")
    B.write_bars(later.withColumn("close", F.lit(0.0)), path, "2002-01-02")
    B.write_bars(later, path, "2002-01-02")
    return B.read_bars(spark, path, ["1-URGENT", "5-LOW"], "1997-01-01", "2001-01-01")


@query("ingest_two_batches", f"SELECT ticker, date, open, high, low, close, volume FROM ({Q.ORDER_BARS})")
def _(spark, sf):
    # one run date in three batches, the last of them one bar for each key
    bars = stage(order_bars(spark, sf).withColumn("seq", F.lit(0).cast("long")), "bars")
    newest = bars.groupBy(KEY).agg(F.max(ORDER).alias("newest"))
    parts = stage(bars.join(newest, KEY).withColumn("part", F.when(F.col(ORDER) == F.col("newest"), 2).when(F.year(ORDER) < 1998, 0).otherwise(1)).drop("newest"), "parts")
    root = _new_root(spark, "batches")
    for n in range(3):
        store_delivery(parts.filter(F.col("part") == n).drop("part"), root, "2002-01-01", batch=n)
    return B.read_bars(spark, f"{root}/bars")


@query("bars_from_stream", f"SELECT ticker, date, open, high, low, close, volume FROM ({Q.ORDER_BARS})")
def _(spark, sf):
    # orders in files of mixed dates, a few files at a time; the delay covers the whole table
    root, orders = _new_root(spark, "stream"), table(spark, sf, "orders")
    orders.repartition(6, F.xxhash64("o_orderkey")).write.parquet(f"{root}/ticks")
    columns = TickColumns("o_orderpriority", "o_orderdate", "o_totalprice", "o_orderkey")
    ingest_ticks(spark, f"{root}/ticks", orders.schema, f"{root}/bars", f"{root}/check", columns, "2002-01-01", delay="10000 days", files_per_trigger=2)
    return B.read_bars(spark, f"{root}/bars")


@query(
    "ingest_profile",
    f"""WITH b AS (SELECT ticker, date, open, high, low, close, CASE WHEN date >= TIMESTAMP '1998-01-01' AND NOT (date >= TIMESTAMP '1999-01-01' AND date < TIMESTAMP '2001-01-01')
  THEN 0 ELSE volume END AS volume FROM ({Q.ORDER_BARS}))
SELECT ticker, count(*) AS row_count, count(volume) AS volumes, count(*) FILTER (WHERE volume < 0) AS negative_volumes, count(*) FILTER (WHERE volume = 0) AS zero_volumes,
  count(*) FILTER (WHERE high < greatest(open, close, low)) AS bad_high, count(*) FILTER (WHERE low > least(open, close, high)) AS bad_low,
  {", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}_nulls, count(*) FILTER (WHERE {c} < 0.01) AS {c}_low, count(*) FILTER (WHERE {c} > 1000000) AS {c}_high" for c in ("open", "high", "low", "close"))}
FROM b GROUP BY ticker""",
)
def _(spark, sf):
    # the second delivery replaces all bars from 1998 on by ones without volume, the third takes back two years of it
    bars = stage(order_bars(spark, sf).withColumn("seq", F.lit(0).cast("long")), "bars")
    root = _new_root(spark, "profiled")
    store_delivery(bars, root, "2002-01-01")
    store_delivery(B.date_range(bars, "1998-01-01").withColumn("volume", F.lit(0.0)), root, "2002-01-02")
    store_delivery(B.date_range(bars, "1999-01-01", "2001-01-01"), root, "2002-01-03")
    return validate.add_counts(stored_counts(spark, root))


@query("write_read_features", f"WITH {Q.features_cte(Q.ORDER_BARS)} SELECT ticker, date, {rounded(FEATURES)} FROM f WHERE {Q.WARM}")
def _(spark, sf):
    path = _new_root(spark, "features")
    B.write_features(compute_features(order_bars(spark, sf)), path)
    return show(B.read_stored(spark, path), FEATURES)


@query(
    "etl_split_report",
    f"""WITH {Q.split_cte(Q.ORDER_BARS)} SELECT ticker, (count(*) FILTER (WHERE split = 'train'))::BIGINT AS train_rows,
  (count(*) FILTER (WHERE split = 'val'))::BIGINT AS val_rows, (count(*) FILTER (WHERE split = 'test'))::BIGINT AS test_rows,
  40::BIGINT AS feature_count FROM k GROUP BY ticker""",
)
def _(spark, sf):
    return spark.read.parquet(f"{_trained(spark, sf)}/split_report")


@query(
    "etl_missing_outputs",
    "SELECT 'NONE' AS ticker, unnest(['train', 'val', 'test', 'scaler', 'train_sequences']) AS output",
)
def _(spark, sf):
    return spark.read.parquet(f"{_trained(spark, sf)}/missing")


@query(
    "validate_missing_column",
    f"""SELECT ticker, false AS passed, 'absent: volume' AS errors,
  'order_type date: has a time zone' AS warnings, count(*)::BIGINT AS row_count FROM ({Q.ORDER_BARS}) GROUP BY ticker""",
)
def _(spark, sf):
    bars = order_bars(spark, sf).drop("volume").withColumn(ORDER, F.col(ORDER).cast("timestamp"))
    return _flat(validate.validate_bars(bars))


@query(
    "last_sequence_tiled",
    f"""{_SCALED_SQL}, o AS (SELECT * FROM x2 QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1)
SELECT ticker, date, 30::BIGINT AS steps, {", ".join(r(f"{c}::FLOAT::DOUBLE * 465", 2, c) for c in FEATURES)} FROM o""",
)
def _(spark, sf):
    rows = score.last_sequence(_scaled(spark, sf), FEATURES, tiled=True)
    return rows.select(KEY, ORDER, F.size("X").cast("long").alias("steps"), *_all_steps(F.col("X")))


# --- models at their default settings: SQL says which rows there must be, and Spark whether they agree ---------------

_ROOTS: dict[tuple[str, str], str] = {}


def _trained(spark, sf) -> str:
    """Folder of one whole run over the order bars: stored bars to trained models, made once per session and table."""
    run = (spark.sparkContext.applicationId, sf)
    if run not in _ROOTS:
        root = _new_root(spark, "run")
        bars = order_bars(spark, sf)
        keys = keys_of(bars).union(validate.requested_keys(bars, ["NONE"]))
        pipeline.ingest(bars, keys, root, "2002-01-01")
        report, missing = pipeline.prepare(spark, root, keys)
        report.write.parquet(f"{root}/split_report")
        missing.write.parquet(f"{root}/missing")
        pipeline.train(spark, root, "run-1", mode="pooled")
        _ROOTS[run] = root
    return _ROOTS[run]


@query("train_registry")
def _(spark, sf):
    return _flat_registry(spark.read.parquet(f"{_trained(spark, sf)}/registry")).drop("model_path")


@query("train_run_log")
def _(spark, sf):
    return spark.read.parquet(f"{_trained(spark, sf)}/run_log")


@query(
    "train_predictions",
    f"""WITH {Q.split_cte(Q.ORDER_BARS)}, n AS (SELECT ticker, split, count(*) AS n FROM k GROUP BY ALL)
SELECT ticker, model, split, CASE WHEN model = 'sequence' THEN greatest(n - 30, 0) ELSE n END AS n_rows, true AS logged, true AS known
FROM n, (SELECT unnest(['random_forest', 'boosted_trees', 'sequence']) AS model)""",
)
def _(spark, sf):
    # a forecast for every row of every split; the metrics in the run log are those of the stored forecasts
    root = _trained(spark, sf)
    stored = spark.read.parquet(f"{root}/predictions/run-1")
    again = stored.groupBy(KEY, "model", "split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sqrt(F.avg((F.col("y") - F.col("yhat")) ** 2)).alias("rmse"),
        (F.count_if(F.isnan("yhat") | F.col("yhat").isNull() | F.col("y").isNull()) == 0).alias("known"),
    )
    log = spark.read.parquet(f"{root}/run_log").filter("kind = 'metric'").withColumn("split", F.regexp_extract("name", "^(train|val|test)_rmse$", 1))
    log = log.filter("split <> ''").select(KEY, "model", "split", F.col("value").cast("double").alias("in_log"))
    near = F.abs(F.col("rmse") - F.col("in_log")) < 1e-3
    return again.join(log, [KEY, "model", "split"], "left").select(KEY, "model", "split", "n_rows", F.coalesce(near, F.lit(False)).alias("logged"), "known")


@query(
    "train_choice",
    f"""WITH {Q.split_cte(Q.ORDER_BARS)} SELECT DISTINCT ticker, 3::BIGINT AS compared, true AS least, true AS saved, true AS tested FROM k""",
)
def _(spark, sf):
    # the registry names the model with the least validation error of the stored forecasts, and where it is saved
    root = _trained(spark, sf)
    errors = spark.read.parquet(f"{root}/predictions/run-1").groupBy(KEY, "model", "split").agg(F.sqrt(F.avg((F.col("y") - F.col("yhat")) ** 2)).alias("rmse"))
    val, test = (errors.filter(F.col("split") == x) for x in ("val", "test"))
    best = val.groupBy(KEY).agg(F.min_by("model", F.round("rmse", 4)).alias("b_model"), F.count(F.lit(1)).alias("compared"))
    test = test.select(KEY, F.col("model").alias("best_model"), F.col("rmse").alias("t_rmse"))
    return spark.read.parquet(f"{root}/registry").join(best, KEY, "left").join(test, [KEY, "best_model"], "left").select(
        KEY, "compared", (F.col("best_model") == F.col("b_model")).alias("least"),
        F.col("model_path").endswith(F.concat(F.lit("/"), "best_model", F.lit("/" + models.POOLED))).alias("saved"),
        (F.abs(F.col("test_metrics.rmse") - F.col("t_rmse")) < 1e-3).alias("tested"),
    )


@query(
    "train_log_shape",
    f"""WITH {Q.split_cte(Q.ORDER_BARS)}, n AS (SELECT count(DISTINCT ticker) AS n FROM k), kinds AS (SELECT unnest(['random_forest', 'boosted_trees', 'sequence']) AS model)
SELECT model, 'metric' AS kind, s || '_' || x AS name, n AS rows, 1::BIGINT AS steps, true AS falls FROM n, kinds,
  (SELECT unnest(['train', 'val', 'test']) AS s), (SELECT unnest(['mae', 'rmse', 'mape', 'r2']) AS x)
UNION ALL SELECT model, 'time', 'seconds', n, 1, true FROM n, kinds
UNION ALL SELECT 'boosted_trees', 'loss', 'train_loss', 200, 200, true""",
)
def _(spark, sf):
    # names and numbers of what was logged; the loss of 200 rounds of boosting falls by more than half
    log = spark.read.parquet(f"{_trained(spark, sf)}/run_log").filter("kind <> 'param' AND NOT (kind = 'loss' AND model = 'sequence')")
    value = F.col("value").cast("double")
    return log.groupBy("model", "kind", "name").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("step").alias("steps"),
        F.when(F.first("kind") == "loss", F.max_by(value, "step") < 0.5 * F.min_by(value, "step")).otherwise(F.lit(True)).alias("falls"),
    )


@query(
    "score_dates",
    f"""WITH b AS ({Q.ORDER_BARS}), l AS (SELECT ticker, max(date)::DATE AS d FROM b WHERE date > (SELECT max(date)::DATE FROM b) - {SCORE_LOOKBACK_DAYS + WARMUP_DAYS}
  GROUP BY ticker HAVING count(*) >= 79)
SELECT ticker, (d + (CASE dayofweek(d) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END)::INTEGER)::DATE::VARCHAR AS prediction_date, 40::BIGINT AS features_used, true AS best, true AS plausible FROM l""",
)
def _(spark, sf):
    # one forecast per key with 30 rows past the warm-up in the look-back, from its best model, dated at the next weekday and inside ten times the range of its closes
    root = _trained(spark, sf)
    closes = order_bars(spark, sf).groupBy(KEY).agg(F.min("close").alias("low"), F.max("close").alias("high"))
    best = spark.read.parquet(f"{root}/registry").select(KEY, "best_model")
    reach = 10 * (F.col("high") - F.col("low"))
    return pipeline.score_keys(spark, root).join(best, KEY).join(closes, KEY).select(
        KEY, F.col("prediction_date").cast("string").alias("prediction_date"), "features_used", (F.col("model_used") == F.col("best_model")).alias("best"),
        F.col("predicted_close").between(F.col("low") - reach, F.col("high") + reach).alias("plausible"),
    )


@query("train_per_key")
def _(spark, sf):
    root = _trained(spark, sf)
    result = models.train_all(pipeline.read_splits(spark, root), f"{root}/per_key", mode="per_key", parallelism=8)
    return metrics.forecast_metrics(result.predictions)


# --- ridge models of all keys as one table ---------------------------------------------------------------------------

_RIDGE_SQL = _SCALED_SQL.replace("WITH", "WITH RECURSIVE", 1) + Q.ridge_cte("x2", FEATURES, "target_next_close", models.LINEAR["regParam"])


@query("ridge_per_key", _RIDGE_SQL + f""" SELECT ticker, n, {r("intercept", 2, "intercept")}, feature, {r("coefficient", 2, "coefficient")} FROM rc
  JOIN (SELECT unnest({FEATURES}) AS feature, unnest(range(1, {len(FEATURES) + 1})) AS i) USING (i)""")
def _(spark, sf):
    scaled = stage(_scaled(spark, sf), "scaled")
    stats = stage(linear.moments(scaled.filter("split = 'train'"), FEATURES), "moments")
    rows = linear.fit_ridge(stats).select(KEY, "n", "intercept", F.inline(F.arrays_zip("features", "coefficients")))
    return rows.select(KEY, "n", F.round("intercept", 2).alias("intercept"), F.col("features").alias("feature"), F.round("coefficients", 2).alias("coefficient"))


@query("train_tables", _RIDGE_SQL + f""" SELECT x2.ticker, date, 'ridge' AS model, split, {r("target_next_close", 2, "y")}, {r("any_value(intercept) + sum(coefficient * ([" + ", ".join(FEATURES) + "])[i])", 2, "yhat")}
  FROM x2 JOIN rc ON x2.ticker = rc.ticker GROUP BY ALL""")
def _(spark, sf):
    result = linear.train_tables(stage(_scaled(spark, sf), "scaled"), _new_root(spark, "tables"))
    return result.predictions.select(KEY, ORDER, "model", "split", F.round("y", 2).alias("y"), F.round("yhat", 2).alias("yhat"))


@query("score_latest")
def _(spark, sf):
    return pipeline.score_keys(spark, _trained(spark, sf))


@query("score_latest_known_target")
def _(spark, sf):
    # the second newest bar, dated one calendar day ahead, sequence model on a tiled row
    return pipeline.score_keys(
        spark, _trained(spark, sf), ORDERS_ASOF, newest_bar=False, tiled=True, calendar_date=True
    )


@query("monitor_models")
def _(spark, sf):
    bars = order_bars(spark, sf)
    keys = keys_of(bars).union(validate.requested_keys(bars, ["NONE"]))
    return pipeline.monitor(spark, _trained(spark, sf), keys, ORDERS_ASOF, "2002-01-02")
