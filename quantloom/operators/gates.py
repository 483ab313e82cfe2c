"""Checks between stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantloom.schema import KEY, ORDER

# What each stage must produce for a key.
ETL_OUTPUTS = ["train", "val", "test", "scaler", "train_sequences"]


class GateError(RuntimeError):
    """A stage did not produce what the next one needs."""


def expected_outputs(keys: DataFrame, outputs: Sequence[str]) -> DataFrame:
    """``ticker, output`` for every key and expected output."""
    return keys.select(KEY, F.explode(F.array(*[F.lit(o) for o in outputs])).alias("output"))


def check_outputs(expected: DataFrame, produced: DataFrame) -> DataFrame:
    """The ``ticker, output`` pairs that are expected and were not produced."""
    return expected.join(produced.select(KEY, "output").distinct(), [KEY, "output"], "left_anti")


def require_complete(missing: DataFrame, shown: int = 20) -> None:
    """Stop when an output is missing; the message shows a few and the table holds all."""
    some = missing.orderBy(KEY, "output").limit(shown).collect()
    if some:
        raise GateError("Missing: " + ", ".join(f"{r[KEY]}/{r['output']}" for r in some))


def stored_gate(summary: DataFrame) -> DataFrame:
    """``stored, total, ok``: an ingestion that stored no key fails."""
    return summary.select("stored", "total", (F.col("stored") > 0).alias("ok"))


def require_stored(summary: DataFrame) -> None:
    row = stored_gate(summary).first()
    if not row["ok"]:
        raise GateError(f"Ingestion stored 0 of {row['total']} keys")


def check_no_leakage(df: DataFrame, key: str = KEY, order: str = ORDER) -> DataFrame:
    """``ticker, split, first, last, ok``: a split must begin after the one before it ended."""
    place = F.expr("CASE split WHEN 'train' THEN 0 WHEN 'val' THEN 1 ELSE 2 END")
    ranges = df.groupBy(key, "split").agg(F.min(order).alias("first"), F.max(order).alias("last"))
    before = F.lag("last", 1).over(Window.partitionBy(key).orderBy(place))
    return ranges.withColumn("ok", before.isNull() | (before < F.col("first")))
