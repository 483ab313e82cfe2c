"""Helpers shared by the text operators: words, bounded key filters, connected components."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.sources.stage import stage

# the white space that separates words: space, tab to carriage return
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
BITS_PER_ROW = 32768


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def whole(text: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Words of a text; only an empty text splits into an empty word, since the ends are trimmed."""
    bare = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(bare != "", F.split(bare, SPACE)).otherwise(F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    """Number of words, as long, without keeping the words."""
    bare = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, SPACE))).cast("long")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def _bit(key: Column, rows: int) -> tuple[Column, Column]:
    return F.pmod(key, F.lit(rows)).cast("long"), F.pmod(F.shiftrightunsigned(key, 34), F.lit(BITS_PER_ROW)).cast("long")


def filter_rows(keys: int, most_mb: int = 64) -> int:
    """Rows of 4 KB for about 16 bits a key, at most ``most_mb``; beyond that the filter lets more through."""
    return max(1, min(most_mb * 256, -(-16 * max(keys, 1) // BITS_PER_ROW)))


def key_filter(keys: DataFrame, key: Column, rows: int) -> DataFrame:
    """A bitmap of hashed keys in ``rows`` rows of 4 KB each."""
    row, bit = _bit(key, rows)
    return keys.select(row.alias("f_row"), bit.alias("f_bit")).groupBy("f_row").agg(F.bitmap_construct_agg("f_bit").alias("f_map"))


def may_be_in(df: DataFrame, key: Column, bitmap: DataFrame, rows: int, out: str) -> DataFrame:
    """Add boolean ``out``: false proves that the key is not in the filter. The filter's size is bounded by ``rows``."""
    row, bit = _bit(key, rows)
    f_map, f_row = free_name(df, "f_map"), free_name(df, "f_row")
    small = F.broadcast(bitmap.withColumnsRenamed({"f_map": f_map, "f_row": f_row}))
    joined = df.join(small, row == F.col(f_row), "left")
    byte = F.conv(F.hex(F.substring(F.col(f_map), (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.shiftright(byte, 0).bitwiseAND(F.call_function("shiftleft", F.lit(1), (bit % 8).cast("int"))) != 0
    return joined.withColumn(out, F.coalesce(hit, F.lit(False))).drop(f_map, f_row)


def union_all(parts: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step on edges (u, v)."""
    if large:
        near = edges.select("u", "v").union(edges.select("v", "u"))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = stage(near, "star-near")
    least = stage(near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "star-least")
    # both sides are stored, so that the join deals them anew and splits a node with very many neighbours
    joined = near.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m"))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (u, v): rows (id, component), the component being its smallest id.

    Alternates large-star and small-star until the edges stay the same; every step is stored, so that lineage stays
    short and a lost executor costs one step. Nodes without edges are not listed.
    """
    now = stage(edges.select("u", "v").where("u <> v").distinct(), "edges")
    seen = None
    while True:
        now = stage(_star(_star(now, large=True), large=False), "edges")
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 31)))).first()
        if state == seen:
            return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
                now.select(F.col("v").alias("id"), F.col("v").alias("component"))
            ).distinct()
        seen = state
