"""Bar tables: building them from ticks, reading, cleaning, de-duplicating and writing."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom.schema import BAR_SCHEMA, BAR_VALUES, KEY, ORDER, PRICES, WARMUP_DAYS

_MICROS = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000}
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _micros_since_epoch(ts: str) -> str:
    return f"timestampdiff(MICROSECOND, {_EPOCH}, CAST({ts} AS TIMESTAMP_NTZ))"


def bucket_start(ts: str, bucket: str) -> Column:
    """Start of the bar a time falls into, without a time zone."""
    if bucket == "day":
        return F.expr(f"CAST(CAST({ts} AS DATE) AS TIMESTAMP_NTZ)")
    if bucket in ("week", "month", "quarter", "year"):
        return F.expr(f"CAST(trunc(CAST({ts} AS DATE), '{bucket}') AS TIMESTAMP_NTZ)")
    micros = _micros_since_epoch(ts)
    size = _MICROS[bucket]
    return F.expr(f"timestampadd(MICROSECOND, {micros} - pmod({micros}, {size}), {_EPOCH})")


def _packed_order(high: Column, low: Column) -> Column:
    """Two longs as one decimal that sorts like the pair. Decimals keep the aggregate hash based; a struct would not.

    ``low`` must not be negative: it fills the last 19 digits, and every long has at most 19.
    """
    digits = "decimal(20,0)"
    return (
        high.cast(digits) * F.lit(Decimal(10**19)).cast(digits) + F.coalesce(low, F.lit(0)).cast(digits)
    ).cast("decimal(38,0)")


def bars_from_ticks(
    ticks: DataFrame,
    key: str,
    ts: str,
    price: Column | str,
    size: Column | str | None = None,
    bucket: str = "day",
    seq: str | None = None,
    order_by: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Open, high, low, close and volume per key and bucket.

    Open and close are the prices of the first and last tick. ``seq`` is a non-negative long that is unique among ticks
    of one key and time; the aggregate is then hash based. Without such a column give ``order_by``, a list that orders
    the ticks fully. All aggregates combine on the map side, so a hot key costs one row per task and bucket.
    """
    if (seq is None) == (order_by is None):
        raise ValueError("give exactly one of seq and order_by")
    price = F.col(price) if isinstance(price, str) else price
    volume = F.count(F.lit(1)) if size is None else F.sum(F.col(size) if isinstance(size, str) else size)
    if seq is not None:
        rank = _packed_order(F.expr(_micros_since_epoch(ts)), F.col(seq))
    else:
        rank = F.struct(*order_by)
    return (
        ticks.select(
            F.col(key).cast("string").alias(KEY),
            bucket_start(ts, bucket).alias(ORDER),
            price.cast("double").alias("_price"),
            *([] if size is None else [(F.col(size) if isinstance(size, str) else size).cast("double").alias("_size")]),
            rank.alias("_rank"),
        )
        .groupBy(KEY, ORDER)
        .agg(
            F.min_by("_price", "_rank").alias("open"),
            F.max("_price").alias("high"),
            F.min("_price").alias("low"),
            F.max_by("_price", "_rank").alias("close"),
            (volume if size is None else F.sum("_size")).cast("double").alias("volume"),
        )
    )


STORED_SCHEMA = T.StructType(
    [*BAR_SCHEMA.fields, T.StructField("run_date", T.StringType()), T.StructField("batch", T.LongType())]
)


def stored_runs(spark: SparkSession, path: str) -> DataFrame:
    """Stored bars as they were delivered, with ``run_date`` and ``batch``; no rows where nothing is stored yet."""
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(sc._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], STORED_SCHEMA)
    return spark.read.schema(STORED_SCHEMA).parquet(path)


def read_bars(
    spark: SparkSession,
    path: str,
    keys: Sequence[str] | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Stored bars of all or some keys, ``start`` included and ``end`` excluded, latest run first in line.

    Key and run date are directory columns, so both filters prune files; the date filter reaches the parquet scan.
    Rows that several runs, or several batches of a run, delivered are reduced to the newest by ``dedup_latest``.
    """
    bars = spark.read.schema(STORED_SCHEMA).parquet(path)
    if keys is not None:
        bars = bars.filter(F.col(KEY).isin(list(keys)))
    bars = date_range(bars, start, end)
    return dedup_latest(bars, seq="batch")


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """A stored table with its key and run date as the text they were written with: ``0700`` stays ``0700``.

    Without a schema Spark guesses the type of directory columns from their names.
    """
    found = spark.read.parquet(path).schema
    text = (KEY, "run_date")
    fields = [T.StructField(f.name, T.StringType() if f.name in text else f.dataType) for f in found.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def missing_keys(bars: DataFrame, requested: DataFrame) -> DataFrame:
    """Requested keys (column ``ticker``) that have no bar."""
    return requested.join(bars.select(KEY).distinct(), KEY, "left_anti")


def date_range(bars: DataFrame, start: str | None = None, end: str | None = None, order: str = ORDER) -> DataFrame:
    """Rows with ``start <= date < end``."""
    if start is not None:
        bars = bars.filter(F.col(order) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        bars = bars.filter(F.col(order) < F.lit(end).cast("timestamp_ntz"))
    return bars


def lookback(bars: DataFrame, days: int, asof: str, order: str = ORDER) -> DataFrame:
    """Rows of the ``days`` calendar days before ``asof`` plus the days the long windows need to fill."""
    first = F.expr(f"CAST(date_sub(DATE'{asof}', {days + WARMUP_DAYS}) AS TIMESTAMP_NTZ)")
    return bars.filter((F.col(order) >= first) & (F.col(order) < F.lit(asof).cast("timestamp_ntz")))


def normalize_tz(df: DataFrame, column: str = ORDER, zone: str | None = None) -> DataFrame:
    """Zoned times become UTC times without a zone.

    A ``TIMESTAMP`` column is an instant: its UTC wall clock is kept. A zone-less or string column is read as wall
    clock of ``zone``; without ``zone`` it stays as it is.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampType):
        return df.withColumn(
            column, F.expr(f"timestampadd(MICROSECOND, unix_micros(`{column}`), {_EPOCH})")
        )
    naive = F.col(column).cast("timestamp_ntz")
    if zone is not None:
        naive = F.convert_timezone(F.lit(zone), F.lit("UTC"), naive)
    return df.withColumn(column, naive)


def drop_empty_prices(bars: DataFrame) -> DataFrame:
    """Drop a row only when every price column it has is null."""
    return bars.na.drop(how="all", subset=[c for c in PRICES if c in bars.columns])


def clean_bars(df: DataFrame, ticker: Column | str, date: str, columns: dict[str, str] | None = None) -> DataFrame:
    """Keep the bar columns under their standard names and add the key.

    ``columns`` maps standard to source names; case does not matter. A column the source lacks is left out.
    """
    names = {c: (columns or {}).get(c, c).lower() for c in BAR_VALUES}
    have = {c.lower() for c in df.columns}
    key = F.col(ticker) if isinstance(ticker, str) else ticker
    return df.select(
        key.cast("string").alias(KEY),
        F.col(date).alias(ORDER),
        *[F.col(names[c]).cast("double").alias(c) for c in BAR_VALUES if names[c] in have],
    )


def _pick(bars: DataFrame, pick, rank: Column, key: str, order: str, extra: Sequence[str] = ()) -> DataFrame:
    values = [c for c in bars.columns if c not in (key, order)]
    ranked = bars.withColumn("_rank", rank)
    out = ranked.groupBy(key, order).agg(*[pick(c, "_rank").alias(c) for c in values])
    return out.select(*[c for c in bars.columns if c not in extra])


def dedup_first(bars: DataFrame, seq: str = "seq", key: str = KEY, order: str = ORDER) -> DataFrame:
    """Of rows of one delivery with the same key and date keep the first to arrive.

    ``seq`` is the arrival number, unique per key and date. The aggregate combines on the map side: many copies of one
    row never meet in one task.
    """
    return _pick(bars, F.min_by, F.col(seq), key, order, extra=(seq,))


def dedup_latest(
    bars: DataFrame, run_date: str = "run_date", seq: str = "seq", key: str = KEY, order: str = ORDER
) -> DataFrame:
    """Of rows with the same key and date keep the one of the latest run, and of that run the last to arrive."""
    run = F.unix_date(F.col(run_date).cast("date")).cast("long")
    return _pick(bars, F.max_by, _packed_order(run, F.col(seq)), key, order, extra=(run_date, seq))


def _write(df: DataFrame, path: str, partitions: list[str], sort: list[str]) -> None:
    """Replace just the partitions present in ``df``.

    The rebalance hint groups rows by partition, lets adaptive execution join small groups and split a group that is
    too large for one task, so a key with very many rows is written by several tasks.
    """
    (
        df.hint("rebalance", *partitions)
        .sortWithinPartitions(*partitions, *sort)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def write_bars(bars: DataFrame, path: str, run_date: str, batch: int = 0) -> None:
    """Store one batch of a run. Writing the same batch again replaces it and leaves other batches and runs alone."""
    run = {"run_date": F.lit(run_date), "batch": F.lit(batch).cast("long")}
    _write(bars.withColumns(run), path, [KEY, "run_date", "batch"], [ORDER])


def write_features(features: DataFrame, path: str) -> None:
    """Store unscaled features, one directory per key."""
    _write(features, path, [KEY], [ORDER])


def write_splits(scaled: DataFrame, path: str) -> None:
    """Store scaled rows, one directory per split and key."""
    _write(scaled, path, ["split", KEY], [ORDER])


def write_scaler(scaler: DataFrame, path: str) -> None:
    scaler.write.mode("overwrite").parquet(path)


def write_sequences(sequences: DataFrame, path: str) -> None:
    """Store sequences, one directory per split and key."""
    _write(sequences, path, ["split", KEY], [ORDER])
