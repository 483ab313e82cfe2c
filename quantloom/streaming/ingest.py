"""The daily ingestion as an incremental job: each run takes the files that arrived since the last one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom.operators.validate import Limits, add_counts, bar_counts, profile_counts, report_profile, route_valid
from quantloom.schema import BAR_SCHEMA, KEY, ORDER
from quantloom.sources.bars import dedup_first, dedup_latest, drop_empty_prices, stored_runs, write_bars
from quantloom.sources.stage import stage


def _like(rows: DataFrame, bars: DataFrame) -> DataFrame:
    """Stored rows with the columns and types of a delivery, so that its checks see the delivery's own shape."""
    shared = [c for c in BAR_SCHEMA.names if c in bars.columns]
    return rows.select(*[F.col(c).cast(bars.schema[c].dataType).alias(c) for c in shared], "run_date", "batch")


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the stored versions of the profile, ascending."""
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(sc._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(where)] if fs.exists(where) else []
    done = [n for n in names if fs.exists(sc._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return sorted(int(n.removeprefix("version=")) for n in done if n.startswith("version="))


def _counted_with(limits: Limits) -> str:
    return f"{limits.min_price!r}..{limits.max_price!r}"


def stored_counts(spark: SparkSession, root: str, limits: Limits = Limits()) -> DataFrame | None:
    """The stored profile: counts per key and month, each from the last delivery that touched the month.

    Counts made with other price limits are left out. ``None`` where nothing is stored.
    """
    path = f"{root}/profile"
    versions = _versions(spark, path)
    if not versions:
        return None
    rows = spark.read.option("basePath", path).parquet(*[f"{path}/version={v}" for v in versions])
    rows = rows.withColumn(KEY, F.col(KEY).cast("string")).filter(F.col("limits") == _counted_with(limits))
    counts = [c for c in rows.columns if c not in (KEY, "month", "version", "limits")]
    return rows.groupBy(KEY, "month").agg(*[F.max_by(c, "version").alias(c) for c in counts]).filter("row_count > 0")


def compact_profile(spark: SparkSession, root: str, limits: Limits = Limits()) -> None:
    """Write the profile as one version and delete the older ones. An interrupted run leaves a profile that reads alike."""
    path, versions = f"{root}/profile", _versions(spark, f"{root}/profile")
    if len(versions) > 1:
        merged = stored_counts(spark, root, limits).withColumn("limits", F.lit(_counted_with(limits)))
        merged.write.mode("overwrite").parquet(f"{path}/version={versions[-1] + 1}")
        sc = spark.sparkContext
        for v in versions:
            where = sc._jvm.org.apache.hadoop.fs.Path(f"{path}/version={v}")
            where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


def store_delivery(
    delivery: DataFrame, root: str, run_date: str, seq: str = "seq", limits: Limits = Limits(), batch: int = 0
) -> DataFrame:
    """Reduce one delivery to one row per key and date, check it, store the keys that pass. Returns the report.

    A delivery may be an increment of any size: what is checked is the series that reading would give, stored bars and
    new ones. The stored profile holds counts per key and month; a delivery counts the months it touches anew, which
    takes the bars that it overwrites out and its own in, and adds the other months from the profile. So only the
    touched months of stored bars are read. A key without profile, or with one counted under other price limits, is
    counted whole once. Rows of a key whose only fault is too few rows are held and join its next delivery, until the
    key is stored. The same ``run_date`` and ``batch`` again replace what they had written.
    """
    spark = delivery.sparkSession
    bars = stage(drop_empty_prices(dedup_first(delivery, seq)), "delivery")
    keys = bars.select(KEY).distinct()
    run = {"run_date": F.lit(run_date), "batch": F.lit(batch).cast("long")}
    own = (F.col("run_date") == run_date) & (F.col("batch") == batch)

    def stored(name: str) -> DataFrame:
        return stored_runs(spark, f"{root}/{name}").join(keys, KEY, "left_semi")

    month = F.date_trunc("month", F.col(ORDER).cast("timestamp_ntz")).alias("month")
    # key and directory columns alone: no data is read for the keys that have stored bars
    in_store = stage(stored("bars").filter(~own).select(KEY).distinct(), "stored-keys")
    held = _like(stored("held").filter(~own), bars).join(in_store, KEY, "left_anti")
    fresh = held.unionByName(bars.withColumns(run), allowMissingColumns=True)
    fresh = stage(dedup_latest(fresh, seq="batch"), "fresh")

    # months to be counted: those of the new rows, those of rows that this batch had written before
    before = stored("bars").filter(own).select(KEY, month)
    touched = stage(fresh.select(KEY, month).union(before).distinct(), "touched")
    profile = stored_counts(spark, root, limits)
    known = profile.join(keys, KEY, "left_semi") if profile is not None else None
    unknown = in_store if known is None else in_store.join(known.select(KEY).distinct(), KEY, "left_anti")
    unknown = stage(unknown, "unprofiled")
    first, last = touched.agg(F.min("month"), F.max("month")).first()
    others = _like(stored("bars").filter(~own), bars)
    in_reach = (F.col(ORDER) >= F.lit(first)) & (F.col(ORDER) < F.expr(f"timestamp_ntz'{last or '1970-01-01'}' + INTERVAL 1 MONTH"))
    near = others.filter(in_reach).join(unknown, KEY, "left_anti").withColumn("month", month).join(touched, [KEY, "month"], "left_semi").drop("month")
    series = near.unionByName(others.join(unknown, KEY, "left_semi")).unionByName(fresh.withColumns(run), allowMissingColumns=True)
    counts = bar_counts(dedup_latest(series, seq="batch").withColumn("month", month), limits, [KEY, "month"])
    # a month all of whose rows went is counted as empty
    counts = stage(counts.join(touched, [KEY, "month"], "full").na.fill(0), "counts")
    whole = counts
    if known is not None:
        whole = counts.unionByName(known.join(counts.select(KEY, "month"), [KEY, "month"], "left_anti"), allowMissingColumns=True)
        whole = whole.select(*counts.columns)
    report = stage(report_profile(profile_counts(add_counts(whole)).join(keys, KEY, "left_semi"), bars, limits=limits), "report")

    good, _bad = route_valid(fresh, report)
    write_bars(good, f"{root}/bars", run_date, batch)
    short = report.filter((F.size("errors") == 1) & F.col("errors")[0].startswith("row_count:"))
    write_bars(bars.join(short.select(KEY), KEY, "left_semi"), f"{root}/held", run_date, batch)
    passed = counts.join(report.filter("passed").select(KEY), KEY, "left_semi").withColumn("limits", F.lit(_counted_with(limits)))
    version = max(_versions(spark, f"{root}/profile"), default=0) + 1
    passed.write.mode("overwrite").parquet(f"{root}/profile/version={version}")
    report.write.mode("overwrite").parquet(f"{root}/reports/run_date={run_date}/batch={batch}")
    return report


def ingest_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    root: str,
    checkpoint: str,
    run_date: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    seq: str = "seq",
    limits: Limits = Limits(),
) -> None:
    """Process all files of ``source`` not seen before and stop.

    All new files form one batch. A batch that is repeated after a failure replaces what it had written, as run date
    and batch number are part of the path; several batches of a date stand side by side, and on one bar the last one
    wins. A root needs a checkpoint of its own, as batch numbers come from there. ``prepare`` turns source rows into bars with an arrival number in ``seq``.
    """

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            store_delivery(prepare(batch), root, run_date, seq, limits, batch_id)

    (
        spark.readStream.schema(schema)
        .parquet(source)
        .writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
