"""Exact de-duplication by progressive refinement: length, then a hash of the beginning, then a hash of all.

Each round keeps the rows whose key so far occurs more than once; what is alone leaves at once. Lengths and beginnings
take 16 bytes a row; the whole content is read and hashed only where a filter of the surviving (length, beginning) keys,
whose size is bounded, does not rule the row out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantloom.llm.common import filter_rows, key_filter, may_be_in, whole
from quantloom.sources.stage import stage

PREFIX = 256


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", prefix: int = PREFIX, carry: Sequence[str] = ()) -> DataFrame:
    """Rows (doc_id, keep_id, group_size, kept, *carry), one for each input row; texts are equal when identical.

    Of equal texts the one with the largest id stays. Null text counts as empty. Null ids take part; one stays only if
    its group has no other id. Rows that repeat id and text count each and share the verdict. An empty table gives no
    rows; columns not in ``carry`` are ignored.
    """
    clash = {"keep_id", "group_size", "kept", doc_id.lower()} & {c.lower() for c in carry}
    if clash:
        raise ValueError(f"cannot carry {sorted(clash)}: the result has columns of these names")
    t = whole(text)
    size, head = F.octet_length(t), F.xxhash64(F.substring(t, 1, prefix))
    short = stage(docs.select(size.alias("size"), head.alias("head")), "refine-short")
    # round 1: lengths that occur more than once; round 2: beginnings among them
    lengths = stage(short.groupBy("size").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("size"), "refine-length")
    heads = short.join(lengths, "size", "left_semi").groupBy("size", "head").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    heads = stage(heads.select(F.xxhash64("size", "head").alias("key")), "refine-heads")
    # round 3: the whole content of what is left
    rows = filter_rows(heads.count())
    bitmap = stage(key_filter(heads, F.col("key"), rows), "refine-filter")
    left = docs.select(
        F.col(doc_id).alias("r_id"), t.alias("r_text"), F.xxhash64(size, head).alias("r_key"), F.struct(F.lit(0), *carry).alias("r_carry")
    )
    left = may_be_in(left, F.col("r_key"), bitmap, rows, "r_left")
    full = stage(left.select("r_id", "r_carry", F.when(F.col("r_left"), F.sha2("r_text", 256)).alias("full")), "refine-full")
    groups = full.where("full is not null").groupBy("full").agg(F.max("r_id").alias("last"), F.count(F.lit(1)).alias("n"))
    # stored, so that the join deals both sides anew and splits a text with very many copies
    groups = stage(groups.where("n > 1").withColumnRenamed("full", "g_full"), "refine-groups")
    alone = full.where("full is null").select("r_id", F.col("r_id").alias("last"), F.lit(1).cast("long").alias("n"), "r_carry")
    rest = full.where("full is not null").join(groups, F.col("full") == F.col("g_full"), "left")
    rest = rest.select(
        "r_id", F.when(F.col("n").isNull(), F.col("r_id")).otherwise(F.col("last")).alias("last"), F.coalesce("n", F.lit(1)).alias("n"), "r_carry"
    )
    return alone.union(rest).select(
        F.col("r_id").alias(doc_id), F.col("last").alias("keep_id"), F.col("n").alias("group_size"),
        F.col("r_id").eqNullSafe(F.col("last")).alias("kept"), *[F.col("r_carry")[c].alias(c) for c in carry],
    )
