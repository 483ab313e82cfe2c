"""Bars from a stream of ticks.

Open bars are state: every trigger merges its ticks into them and hands out the bars that changed, complete as known so
far. A bar is closed when the watermark, the newest time seen less the allowed delay, has passed its end; later ticks of
it are late, dropped and counted. With a delay that covers the disorder of the files the stored bars are those of
``bars_from_ticks``, in whatever order files arrive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom.schema import KEY, ORDER
from quantloom.sources.bars import _EPOCH, _micros_since_epoch, _packed_order, stored_runs, write_bars

# bar sizes that are windows of fixed length from the epoch
WINDOWS = {"second": "1 second", "minute": "1 minute", "hour": "1 hour", "day": "1 day"}


@dataclass(frozen=True)
class TickColumns:
    """Columns of a tick table. ``seq`` is a non-negative long, unique among ticks of one key and time."""

    key: str
    ts: str
    price: Column | str
    seq: str
    size: Column | str | None = None


def stream_bars(ticks: DataFrame, columns: TickColumns, bucket: str = "day", delay: str = "1 day") -> DataFrame:
    """``ticker, date, open, high, low, close, volume, ticks`` of the bars that each trigger changes, for update mode.

    Ticks without a time are left out. The aggregate combines on the map side, and state holds one row per open bar.
    """

    def col(x: Column | str) -> Column:
        return F.col(x) if isinstance(x, str) else x

    size = F.lit(1.0) if columns.size is None else col(columns.size).cast("double")
    rows = ticks.select(
        F.col(columns.key).cast("string").alias(KEY),
        # watermarks need instants: the wall clock is taken as one of UTC, and back
        F.timestamp_micros(F.expr(_micros_since_epoch(columns.ts))).alias("_at"),
        col(columns.price).cast("double").alias("_price"),
        size.alias("_size"),
        _packed_order(F.expr(_micros_since_epoch(columns.ts)), F.col(columns.seq)).alias("_rank"),
    ).where("_at IS NOT NULL")
    bars = rows.withWatermark("_at", delay).groupBy(KEY, F.window("_at", WINDOWS[bucket]).alias("_bar")).agg(
        F.min_by("_price", "_rank").alias("open"),
        F.max("_price").alias("high"),
        F.min("_price").alias("low"),
        F.max_by("_price", "_rank").alias("close"),
        F.sum("_size").alias("volume"),
        F.count(F.lit(1)).alias("ticks"),
    )
    start = F.expr(f"timestampadd(MICROSECOND, unix_micros(_bar.start), {_EPOCH})")
    return bars.select(KEY, start.alias(ORDER), "open", "high", "low", "close", "volume", "ticks")


def ingest_ticks(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    path: str,
    checkpoint: str,
    columns: TickColumns,
    run_date: str,
    bucket: str = "day",
    delay: str = "1 day",
    files_per_trigger: int = 1000,
) -> dict[str, int]:
    """Take all tick files of ``source`` not seen before, store the bars they change under ``path``, and stop.

    Every trigger is a batch of its own in the stored layout, so a batch that is repeated after a failure replaces what it
    had written and ``read_bars`` gives each bar as the last batch left it. A path needs a checkpoint of its own, and one
    ``run_date``, as batch numbers come from there. Returns the rows read and how many ticks were late.
    """
    before = _ticks_stored(spark, path)

    def one_batch(bars: DataFrame, batch: int) -> None:
        write_bars(bars, path, run_date, batch)

    ticks = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
    known = ticks.where(F.col(columns.ts).isNotNull())
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 1_000_000)
    try:
        query = (
            stream_bars(known, columns, bucket, delay)
            .writeStream.outputMode("update")
            .foreachBatch(one_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        rows = sum(p.numInputRows for p in query.recentProgress)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    return {"rows": rows, "late": rows - (_ticks_stored(spark, path) - before)}


def _ticks_stored(spark: SparkSession, path: str) -> int:
    """Ticks in the stored bars, each as its last batch left it."""
    if stored_runs(spark, path).isEmpty():
        return 0
    stored = spark.read.parquet(path).groupBy(KEY, ORDER).agg(F.max_by("ticks", "batch").alias("ticks"))
    return stored.agg(F.coalesce(F.sum("ticks"), F.lit(0))).first()[0]
