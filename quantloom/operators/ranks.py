"""Values of one column per key and feature, collapsed to distinct values with running counts.

These are the shared steps of exact quantiles and of two-sample statistics. An aggregate counts equal values; the running
sum then needs the distinct values of a (key, feature) group in order. For keys with a proven row bound rows are dealt
out by group once and one window does that. Otherwise the counts combine on the map side and each group is cut into slices of neighbouring values, bounded by
approximate quantiles; the slices are summed on their own, and the few slice totals are added as offsets. The slice
bounds only steer the work: the counts are exact whatever they are. This second form runs a job when it is called, as it
stores the counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantloom.sources.stage import stage

SLICES = 64


def long_values(df: DataFrame, cols: Sequence[str], key: str, counts: Mapping[str, Column]) -> DataFrame:
    """``key, feature, value`` plus one column per entry of ``counts``; nulls are left out."""
    wide = df.selectExpr(key, *[f"double(`{c}`) AS `{c}`" for c in cols])
    tall = wide.unpivot([key], list(cols), "feature", "value")
    return tall.filter("value IS NOT NULL").withColumns({n: c.cast("long") for n, c in counts.items()})


def _with_slices(tall: DataFrame, key: str, slices: int) -> DataFrame:
    steps = [i / slices for i in range(1, slices)]
    bounds = tall.groupBy(key, "feature").agg(
        F.percentile_approx("value", F.array(*[F.lit(s) for s in steps]), F.lit(20 * slices)).alias("_bounds")
    )
    number = F.size(F.filter("_bounds", lambda b: b < F.col("value")))
    return tall.join(bounds, [key, "feature"]).withColumn("_slice", number).drop("_bounds")


def running_counts(
    tall: DataFrame, counts: Sequence[str], key: str, sliced: bool = False, slices: int = SLICES
) -> DataFrame:
    """One row per distinct value with ``<c>_upto`` (rows at or below it), ``<c>_all`` (rows of the group) for each
    count column, ``next_value`` (null on the last) and ``least`` (the smallest value of the group)."""
    group = [key, "feature"]
    if not sliced:
        # dealt out by group once: equal values meet there, and the windows need no second exchange
        merged = tall.repartition(*group).groupBy(*group, "value").agg(*[F.sum(c).alias(c) for c in counts])
        by_value = Window.partitionBy(*group).orderBy("value")
        whole = Window.partitionBy(*group)
        return merged.withColumns(
            {
                **{f"{c}_upto": F.sum(c).over(by_value.rowsBetween(Window.unboundedPreceding, 0)) for c in counts},
                **{f"{c}_all": F.sum(c).over(whole) for c in counts},
                "next_value": F.lead("value", 1).over(by_value),
                "least": F.min("value").over(whole),
            }
        )
    # two steps read the counts: a stage table spares them a second pass over the tall rows
    merged = stage(
        _with_slices(tall, key, slices).groupBy(*group, "_slice", "value").agg(*[F.sum(c).alias(c) for c in counts]),
        "counts",
    )
    by_slice = Window.partitionBy(*group).orderBy("_slice")
    totals = merged.groupBy(*group, "_slice").agg(F.min("value").alias("_first"), *[F.sum(c).alias(c) for c in counts])
    before = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *group,
        "_slice",
        F.lead("_first", 1).over(by_slice).alias("_next_first"),
        F.min("_first").over(Window.partitionBy(*group)).alias("least"),
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}_before") for c in counts],
        *[F.sum(c).over(Window.partitionBy(*group)).alias(f"{c}_all") for c in counts],
    )
    in_slice = Window.partitionBy(*group, "_slice").orderBy("value")
    local = merged.join(offsets, [*group, "_slice"]).withColumns(
        {
            **{
                f"{c}_upto": F.col(f"_{c}_before") + F.sum(c).over(in_slice.rowsBetween(Window.unboundedPreceding, 0))
                for c in counts
            },
            "next_value": F.coalesce(F.lead("value", 1).over(in_slice), F.col("_next_first")),
        }
    )
    return local.drop("_slice", "_next_first", *[f"_{c}_before" for c in counts])


def quantiles(ranked: DataFrame, count: str, points: Sequence[float], key: str) -> DataFrame:
    """``key, feature, q0, q1, ...``: exact quantiles with linear interpolation between neighbouring rows."""
    total, upto = F.col(f"{count}_all"), F.col(f"{count}_upto")
    start = upto - F.col(count)

    def value_at(rank: Column) -> Column:
        return F.max(F.when((start <= rank) & (rank < upto), F.col("value")))

    aggs, outs = [], []
    for i, p in enumerate(points):
        place = (total - 1) * F.lit(float(p))
        low = F.floor(place)
        aggs += [
            value_at(low).alias(f"_lo{i}"),
            value_at(F.least(low + 1, total - 1)).alias(f"_hi{i}"),
            F.max(place - low).alias(f"_f{i}"),
        ]
        outs.append((F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).alias(f"q{i}"))
    return ranked.groupBy(key, "feature").agg(*aggs).select(key, "feature", *outs)
