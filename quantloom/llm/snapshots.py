"""Logged conversations: keep the maximal ones, then render them.

A log that writes a conversation after every turn holds all its prefixes. Each turn gets two 64-bit hashes of its place,
role and text; their running exclusive-or is a 128-bit hash of the conversation up to that turn. A conversation whose last
hash is an inner hash of a longer one is a prefix of it and goes, found by an anti-join on hashes; texts are read again
for what stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantloom.sources.stage import stage

# text around a turn: opening, between role and text, closing
TEMPLATE = ("<|", "|>\n", "\n<|end|>\n")


def _content(seed: int) -> Column:
    """Hash of a turn's role and text; null differs from empty."""
    return F.xxhash64(F.lit(seed), F.col("t_role").isNull(), "t_role", F.col("t_text").isNull(), "t_text")


def _rows(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows (who, t_turn, t_role, t_text); a turn without conversation id is a conversation, known by its role and text."""
    rows = turns.select(
        F.col(conv_id).alias("conv"), F.col(turn).alias("t_turn"), F.col(role).cast("string").alias("t_role"), F.col(text).cast("string").alias("t_text")
    )
    alone = F.col("conv").isNull()
    own = F.when(alone, F.concat_ws(" ", _content(1), _content(2)))
    return rows.select(F.struct("conv", own.alias("own")).alias("who"), F.when(~alone, F.col("t_turn")).alias("t_turn"), "t_role", "t_text")


def prefix_hashes(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows (who, place, n_turns, h1, h2): the hash of each conversation up to each of its turns, counted from 1.

    Turns are dealt out by ranges in order, and places and running hashes are worked out within a range; a conversation
    over several ranges carries counts and hashes from range to range. So no task needs a whole conversation.
    """
    rows = _rows(turns, conv_id, turn, role, text)
    # repeated rows of a turn are one turn; equal turn numbers with different content follow in the order of content
    order = ["t_turn", "c1", "c2"]
    content = rows.select("who", "t_turn", _content(1).alias("c1"), _content(2).alias("c2")).distinct()
    ranged = stage(content.repartitionByRange("who", *order).withColumn("part", F.spark_partition_id()), "snapshots-ranges")
    # a range can share its first and its last conversation with others: few rows, whatever the number of turns
    wide = ranged.groupBy("who").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi")
    wide = stage(wide.select(F.col("who").alias("w_who")), "snapshots-wide")
    sizes = ranged.join(wide, F.col("who") == F.col("w_who")).groupBy("w_who", F.col("part").alias("w_part")).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("w_who").orderBy("w_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).withColumn("total", F.sum("n").over(Window.partitionBy("w_who")))
    offsets = stage(offsets.drop("n"), "snapshots-offsets")
    placed = ranged.join(offsets, (F.col("who") == F.col("w_who")) & (F.col("part") == F.col("w_part")), "left")
    here = Window.partitionBy("who", "part")
    inside = here.orderBy(*order)
    placed = placed.select(
        "who", "part", *order, F.col("total").isNotNull().alias("carries"),
        (F.row_number().over(inside) + F.coalesce("before", F.lit(0))).cast("long").alias("place"),
        F.coalesce("total", F.count(F.lit(1)).over(here)).alias("n_turns"),
    )
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    marks = [F.bit_xor(F.xxhash64(F.lit(10 + k), "place", "c1", "c2")).over(running).alias(f"h{k}") for k in (1, 2)]
    marks = stage(placed.select("who", "part", "carries", "place", "n_turns", *marks), "snapshots-marks")
    ends = marks.where("carries").groupBy(F.col("who").alias("w_who"), F.col("part").alias("w_part")).agg(
        *[F.max_by(f"h{k}", "place").alias(f"e{k}") for k in (1, 2)]
    )
    carried = ends.select("w_who", "w_part", *[F.coalesce(F.bit_xor(f"e{k}").over(earlier), F.lit(0)).alias(f"e{k}") for k in (1, 2)])
    linked = marks.join(stage(carried, "snapshots-carried"), (F.col("who") == F.col("w_who")) & (F.col("part") == F.col("w_part")), "left")
    return linked.select("who", "place", "n_turns", *[F.col(f"h{k}").bitwiseXOR(F.coalesce(f"e{k}", F.lit(0))).alias(f"h{k}") for k in (1, 2)])


def _maximal(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows (who, n_turns, copies) of the conversations that prefix no longer one."""
    marks = stage(prefix_hashes(turns, conv_id, turn, role, text), "snapshots")
    # of equal conversations the smallest id, an id before none
    named = F.struct(F.col("who.conv").isNull().alias("unnamed"), F.col("who.conv"), F.col("who.own"))
    last = marks.where("place = n_turns").groupBy("n_turns", "h1", "h2").agg(F.min(named).alias("best"), F.count(F.lit(1)).alias("copies"))
    inner = marks.where("place < n_turns").select(F.col("place").alias("i_place"), F.col("h1").alias("i_h1"), F.col("h2").alias("i_h2")).distinct()
    same = (F.col("n_turns") == F.col("i_place")) & (F.col("h1") == F.col("i_h1")) & (F.col("h2") == F.col("i_h2"))
    kept = last.join(inner, same, "left_anti")
    return kept.select(F.struct("best.conv", "best.own").alias("who"), F.col("n_turns").cast("long").alias("n_turns"), "copies")


def maximal_conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (conv_id, n_turns, copies): the conversations that prefix no longer one; of equal ones the smallest id.

    A conversation is its distinct (turn, role, text) rows in the order of turns; numbering may start anywhere. Null roles
    and texts are values of their own, null turns come first. A row without conversation id is a conversation of one turn;
    such rows with equal role and text are one. An empty table gives no rows; other columns are ignored. Conversations may
    be longer than a task can hold, and very many may be equal or begin alike, since equal hashes are combined before they
    are dealt out.
    """
    return _maximal(turns, conv_id, turn, role, text).select(F.col("who.conv").alias(conv_id), "n_turns", "copies")


def collapse_and_render(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", template: tuple[str, str, str] = TEMPLATE
) -> DataFrame:
    """Rows (conv_id, n_turns, copies, rendered) of the maximal conversations; see ``maximal_conversations``.

    ``rendered`` puts the turns in order as opening, role, middle, text, closing; a null role or text renders as empty. It
    is one string, so the text of a conversation that stays must fit a task.
    """
    kept = stage(_maximal(turns, conv_id, turn, role, text), "snapshots-kept").withColumnRenamed("who", "k_who")
    rows = _rows(turns, conv_id, turn, role, text)
    rows = rows.join(kept, F.col("who") == F.col("k_who"))
    opening, middle, closing = (F.lit(x) for x in template)
    body = F.concat(opening, F.coalesce("t_role", F.lit("")), middle, F.coalesce("t_text", F.lit("")), closing)
    one = F.struct("t_turn", _content(1).alias("c1"), _content(2).alias("c2"), body.alias("body"))
    joined = rows.groupBy("k_who", "n_turns", "copies").agg(F.sort_array(F.collect_set(one)).alias("turns"))
    return joined.select(F.col("k_who.conv").alias(conv_id), "n_turns", "copies", F.array_join("turns.body", "").alias("rendered"))
