"""How the rows of a keyed series are spread over tasks.

Every window in this package runs over the columns in ``Layout.part``. Two layouts exist:

* **per key** - one window group per key. Chosen when the declared bar size proves a bound on the rows a key can
  have: a key has at most one bar per bucket, and the timestamp range (years 1 to 9999) holds 3 652 059 days. Such a
  group always fits one task, so a hot key cannot exist.
* **segmented** - for finer bars a key may hold any share of all rows. Each key is cut into segments of
  ``segment_rows`` consecutive rows. A segment also receives copies of the ``before`` rows in front of it and the
  ``after`` rows behind it, so windows need to look no further than their own segment. The copies are dropped by
  ``Layout.finish``. Rows are numbered inside (key, time slice) and stored once; positions follow from the stored counts
  per slice and a running sum over these few counts, so at no point does one task see a whole key.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantloom.schema import KEY, ORDER
from quantloom.sources.stage import stage

DAY_OR_LONGER = ("day", "week", "month", "quarter", "year")

# time slice used to count rows of a key, by bar size
_SLICE_UNIT = {"hour": "month", "minute": "day", "second": "hour"}


@dataclass(frozen=True)
class Series:
    """Names the key and order columns of a bar table and its bar size (``None`` when unknown)."""

    key: str = KEY
    order: str = ORDER
    bucket: str | None = "day"
    segment_rows: int = 131_072
    force_segments: bool = field(default=False)

    @property
    def per_key(self) -> bool:
        return self.bucket in DAY_OR_LONGER and not self.force_segments

    @property
    def window(self):
        return Window.partitionBy(self.key).orderBy(self.order)

    def slice_column(self) -> Column:
        return F.date_trunc(_SLICE_UNIT.get(self.bucket or "", "day"), F.col(self.order))


DAILY = Series()
HOURLY = Series(bucket="hour")


@dataclass(frozen=True)
class Layout:
    """A DataFrame with ``_pos`` (0-based row position in its key) and the columns that form window groups."""

    df: DataFrame
    part: list[str]
    own: Column | None
    # the most segments that a key has
    segments: int = 1

    def with_df(self, df: DataFrame) -> Layout:
        return Layout(df, self.part, self.own, self.segments)

    def finish(self, df: DataFrame) -> DataFrame:
        """Drop the rows copied from neighbouring segments."""
        return df if self.own is None else df.filter(self.own)


def with_positions(df: DataFrame, series: Series = DAILY) -> DataFrame:
    """Add ``_pos``, the 0-based position of a row in its key, and ``_n``, the rows of the key."""
    if series.per_key:
        whole = Window.partitionBy(series.key)
        return df.withColumn("_pos", F.row_number().over(series.window).cast("long") - 1).withColumn(
            "_n", F.count(F.lit(1)).over(whole)
        )
    return _placed(*_numbered(df, series), series)


def _numbered(df: DataFrame, series: Series) -> tuple[DataFrame, DataFrame]:
    """The rows numbered in their time slice, stored, and per slice the rows of the key before it and in all."""
    in_slice = Window.partitionBy(series.key, "_slice").orderBy(series.order)
    numbered = stage(df.withColumn("_slice", series.slice_column()).withColumn("_row", F.row_number().over(in_slice)), "numbered")
    by_slice = Window.partitionBy(series.key).orderBy("_slice")
    counts = numbered.groupBy(series.key, "_slice").agg(F.max("_row").cast("long").alias("_rows"))
    offsets = counts.select(
        series.key,
        "_slice",
        F.coalesce(F.sum("_rows").over(by_slice.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_rows").over(Window.partitionBy(series.key)).alias("_n"),
    )
    return numbered, stage(offsets, "slice-offsets")


def _placed(numbered: DataFrame, offsets: DataFrame, series: Series) -> DataFrame:
    return numbered.join(offsets, [series.key, "_slice"]).withColumn("_pos", F.col("_off") + F.col("_row") - 1).drop("_slice", "_off", "_row")


def lay_out(
    df: DataFrame, series: Series = DAILY, before: int = 0, after: int = 0, positions: bool = True
) -> Layout:
    """Prepare ``df`` for windows that look at most ``before`` rows back and ``after`` rows ahead."""
    if series.per_key and not positions:
        return Layout(df, [series.key], None)
    if series.per_key:
        return Layout(df.withColumn("_pos", F.row_number().over(series.window).cast("long") - 1), [series.key], None)
    rows = series.segment_rows
    numbered, offsets = _numbered(df, series)
    most = offsets.agg(F.max("_n")).first()[0] or 0
    placed = _placed(numbered, offsets, series)
    first = F.expr(f"greatest(_pos - {after}, 0) div {rows}")
    last = F.expr(f"least(_pos + {before}, _n - 1) div {rows}")
    copies = placed.withColumn("_seg", F.explode(F.sequence(first, last))).drop("_n")
    return Layout(copies, [series.key, "_seg"], F.expr(f"_pos div {rows} = _seg"), -(-most // rows))
