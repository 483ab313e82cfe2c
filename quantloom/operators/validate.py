"""Bar checks as one aggregate per key, and what follows from them: routing, status and summary."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom import schema as S
from quantloom.schema import BAR_VALUES, KEY, ORDER, PRICES

@dataclass(frozen=True)
class Limits:
    min_rows: int = S.MIN_ROWS
    max_null_share: float = S.MAX_NULL_SHARE
    min_price: float = S.MIN_PRICE
    max_price: float = S.MAX_PRICE
    max_zero_volume_share: float = S.MAX_ZERO_VOLUME_SHARE


def _percent(share: Column) -> Column:
    return F.format_string("%.1f%%", F.bround(share * 100, 1))


def missing_columns(bars: DataFrame) -> list[str]:
    """Required bar columns that are absent."""
    return [c for c in BAR_VALUES if c not in bars.columns]


def order_column_message(bars: DataFrame, order: str = ORDER) -> tuple[str | None, str | None]:
    """Error and warning about the type of the order column."""
    if order not in bars.columns:
        return f"order_type {order}: absent", None
    kind = bars.schema[order].dataType
    if isinstance(kind, (T.TimestampNTZType, T.DateType)):
        return None, None
    if isinstance(kind, T.TimestampType):
        return None, f"order_type {order}: has a time zone"
    return f"order_type {order}: {kind.simpleString()}", None


def bar_counts(bars: DataFrame, limits: Limits = Limits(), by: Sequence[Column | str] = (KEY,)) -> DataFrame:
    """The counts behind the checks, one row per group. Counts of disjoint rows add up."""
    have = set(bars.columns)
    aggs = [F.count(F.lit(1)).alias("row_count")]
    for c in [p for p in PRICES if p in have]:
        aggs += [
            F.count_if(F.col(c).isNull()).alias(f"{c}_nulls"),
            F.count_if(F.col(c) < limits.min_price).alias(f"{c}_low"),
            F.count_if(F.col(c) > limits.max_price).alias(f"{c}_high"),
        ]
    if "volume" in have:
        volume = F.col("volume")
        aggs += [F.count("volume").alias("volumes"), F.count_if(volume < 0).alias("negative_volumes"), F.count_if(volume == 0).alias("zero_volumes")]
    if set(PRICES) <= have:
        o, h, l, c = (F.col(p) for p in PRICES)
        whole = o.isNotNull() & h.isNotNull() & l.isNotNull() & c.isNotNull()
        aggs += [
            F.count_if(whole & (h < F.greatest(o, c, l))).alias("bad_high"),
            F.count_if(whole & (l > F.least(o, c, h))).alias("bad_low"),
        ]
    return bars.groupBy(*by).agg(*aggs)


def add_counts(counts: DataFrame, key: str = KEY) -> DataFrame:
    """Counts of several disjoint parts as one row per key."""
    names = [f.name for f in counts.schema.fields if isinstance(f.dataType, T.LongType) and f.name != key]
    return counts.groupBy(key).agg(*[F.sum(c).alias(c) for c in names])


def profile_counts(counts: DataFrame, key: str = KEY) -> DataFrame:
    """Shares and flags from ``bar_counts``."""
    have, out = set(counts.columns), ["row_count"]
    for c in [p for p in PRICES if f"{p}_nulls" in have]:
        out += [
            F.try_divide(F.col(f"{c}_nulls"), F.col("row_count")).alias(f"{c}_null_share"),
            (F.col(f"{c}_low") > 0).alias(f"{c}_too_low"),
            (F.col(f"{c}_high") > 0).alias(f"{c}_too_high"),
        ]
    if "volumes" in have:
        out += [(F.col("negative_volumes") > 0).alias("volume_negative"), F.try_divide("zero_volumes", "volumes").alias("zero_volume_share")]
    return counts.select(key, *out, *[c for c in ("bad_high", "bad_low") if c in have])


def profile_bars(bars: DataFrame, limits: Limits = Limits(), key: str = KEY) -> DataFrame:
    """The numbers behind the checks: one row per key, combined on the map side."""
    return profile_counts(bar_counts(bars, limits, [key]), key)


def validate_bars(
    bars: DataFrame, keys: DataFrame | None = None, limits: Limits = Limits(), key: str = KEY, order: str = ORDER
) -> DataFrame:
    """``ticker, passed, errors, warnings, row_count``, one row per key.

    ``keys`` (column ``ticker``) lists the requested keys: one without rows fails as ``no_rows`` and skips other checks.
    Warnings never make a key fail. A finding reads ``check column: value``.
    """
    return report_profile(profile_bars(bars, limits, key), bars, keys, limits, key, order)


def report_profile(
    profile: DataFrame, bars: DataFrame, keys: DataFrame | None = None, limits: Limits = Limits(), key: str = KEY, order: str = ORDER
) -> DataFrame:
    """``validate_bars`` from a result of ``profile_bars``; of ``bars`` only the columns and their types matter."""
    have = set(bars.columns)
    found = [p for p in PRICES if p in have]

    def finding(when: Column, check: str, value: Column | str = "") -> Column:
        return F.when(when, F.concat(F.lit(f"{check}: "), F.lit(value) if isinstance(value, str) else value))

    errors: list[Column] = [finding(F.col("row_count") < limits.min_rows, "row_count", F.col("row_count").cast("string"))]
    warnings: list[Column] = []
    absent = missing_columns(bars)
    if absent:
        errors.append(F.lit(f"absent: {', '.join(absent)}"))
    for c in found:
        share = F.col(f"{c}_null_share")
        errors.append(finding(share > limits.max_null_share, f"null_share {c}", _percent(share)))
        warnings.append(finding((share > 0) & (share <= limits.max_null_share), f"null_share {c}", _percent(share)))
    for c in found:
        errors.append(finding(F.col(f"{c}_too_low"), f"price_floor {c}", f"{limits.min_price}"))
        warnings.append(finding(F.col(f"{c}_too_high"), f"price_ceiling {c}", f"{limits.max_price}"))
    if "volume" in have:
        share = F.col("zero_volume_share")
        errors.append(finding(F.col("volume_negative"), "sign volume", "negative"))
        warnings.append(finding(share > limits.max_zero_volume_share, "zero_share volume", _percent(share)))
    if set(PRICES) <= have:
        errors += [finding(F.col(name) > 0, f"{name} rows", F.col(name).cast("string")) for name in ("bad_high", "bad_low")]
    type_error, type_warning = order_column_message(bars, order)
    if type_error:
        errors.append(F.lit(type_error))
    if type_warning:
        warnings.append(F.lit(type_warning))

    none = F.array().cast("array<string>")
    report = profile.select(
        F.col(key).alias(KEY),
        F.array_compact(F.array(*errors)).alias("errors"),
        (F.array_compact(F.array(*warnings)) if warnings else none).alias("warnings"),
        "row_count",
    )
    if keys is not None:
        report = keys.select(KEY).distinct().join(report, KEY, "left").select(
            KEY,
            F.coalesce("errors", F.array(F.lit("no_rows"))).alias("errors"),
            F.coalesce("warnings", none).alias("warnings"),
            F.coalesce("row_count", F.lit(0)).cast("long").alias("row_count"),
        )
    return report.select(KEY, (F.size("errors") == 0).alias("passed"), "errors", "warnings", "row_count")


def route_valid(bars: DataFrame, report: DataFrame, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """Bars of keys that passed, and bars of keys that did not.

    No broadcast is forced: Spark picks one when the list of keys is small, else the join shuffles, and adaptive
    execution splits a skewed key.
    """
    good = report.filter("passed").select(F.col(KEY).alias(key))
    bad = report.filter("NOT passed").select(F.col(KEY).alias(key))
    return bars.join(good, key, "left_semi"), bars.join(bad, key, "left_semi")


def key_status(requested: DataFrame, report: DataFrame) -> DataFrame:
    """``ticker, status, reason`` for every requested key: ``success`` or ``failed``; a bad key stops no other."""
    joined = requested.join(report, KEY, "left")
    passed = F.coalesce(F.col("passed"), F.lit(False))
    return joined.select(
        KEY,
        F.when(passed, F.lit("success")).otherwise(F.lit("failed")).alias("status"),
        F.when(~passed, F.coalesce(F.array_join("errors", "; "), F.lit("no result"))).alias("reason"),
    )


def run_counts(status: DataFrame) -> DataFrame:
    """``total, success, failed``."""
    return status.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "success").alias("success"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )


def ingest_outcomes(report: DataFrame) -> DataFrame:
    """``ticker, validation, rows, errors``: what happened to each key."""
    return report.select(
        KEY,
        F.when(F.col("passed"), F.lit("PASS")).otherwise(F.lit("FAIL")).alias("validation"),
        F.col("row_count").alias("rows"),
        "errors",
    )


def ingest_summary(report: DataFrame) -> DataFrame:
    """One row of counts over all keys. The keys themselves stay in ``ingest_outcomes``: their number is unbounded."""
    return report.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("row_count") > 0).alias("downloaded"),
        F.count_if("passed").alias("validated"),
        F.count_if("passed").alias("stored"),
        F.count_if((F.col("row_count") > 0) & ~F.col("passed")).alias("failed_validation"),
    )


def requested_keys(bars: DataFrame, names: Sequence[str]) -> DataFrame:
    """A one-column table of requested keys."""
    spark = bars.sparkSession
    return spark.createDataFrame([(n,) for n in names], T.StructType([T.StructField(KEY, T.StringType())]))
