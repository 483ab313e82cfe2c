"""Token counts with a two-tier lookup on the map side.

Tier one: the lengths of the pre-tokens that are frequent in the whole corpus, as a table of fixed size that every task
gets. Tier two: each worker's own cache, filled by encoding what the table lacks. Occurrences of pre-tokens are never
shuffled. To find the frequent ones each task keeps a bounded summary of its own part, and only the heads of those
summaries meet. The table steers speed alone: counts are the same with any table, the empty one included.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantloom.llm.bpe import PIECE_CHARS, PIECES, encoder
from quantloom.llm.common import whole
from quantloom.sources.stage import stage

TABLE_ENTRIES = 16384
SUMMARY_ENTRIES = 1 << 18


def frequent_pieces(docs: DataFrame, path: str, text: str = "text", entries: int = TABLE_ENTRIES) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of all texts; at most ``entries``, so the table is bounded.

    A task counts into a summary of at most ``SUMMARY_ENTRIES``; when it is full, the lower half goes. Pre-tokens of more
    than ``PIECE_CHARS`` characters stay out, so bytes are bounded too, and the heads meet in a task before the driver.
    """

    def summaries(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code, seen = encoder(path), Counter()
        for part in parts:
            for t in part["t"]:
                if code.plain(t):
                    pieces = PIECES.findall(t)
                    if max(map(len, pieces), default=0) > PIECE_CHARS:
                        pieces = [p for p in pieces if len(p) <= PIECE_CHARS]
                    seen.update(pieces)
                    if len(seen) > SUMMARY_ENTRIES:
                        seen = Counter(dict(seen.most_common(SUMMARY_ENTRIES // 2)))
        head = sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:entries]
        yield pd.DataFrame({"piece": [p for p, _ in head], "n": [n for _, n in head]}).astype({"piece": object, "n": "int64"})

    heads = docs.select(whole(text).alias("t")).mapInPandas(summaries, "piece string, n long")
    top = heads.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(entries)
    code = encoder(path)
    return {r.piece: code.length_of[r.piece] for r in stage(top, "frequent-pieces").collect()}


def count_tokens(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = 512, table: dict[str, int] | None = None
) -> DataFrame:
    """Rows (``doc_id``, n_bytes, n_tokens, over_limit), one per input row, in any order.

    ``path`` names a vocabulary file on every worker. Null text counts as empty: 0 bytes, 0 tokens. Repeated rows and null
    ids are counted row by row; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(frequent_pieces(docs, path, text) if table is None else table)

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = encoder(path)
        if not getattr(code, "seeded", False):
            code.length_of.update(known.value)
            code.seeded = True
        for part in parts:
            yield pd.DataFrame({"doc_id": part["doc_id"], "n_bytes": part["n_bytes"], "n_tokens": [code.count(t) for t in part["t"]]})

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.octet_length(whole(text)).cast("long").alias("n_bytes"), whole(text).alias("t"))
    # keys travel through pandas as strings: a null among integers would turn them into floats
    out = rows.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(count, "doc_id string, n_bytes long, n_tokens long")
    return out.select(
        F.col("doc_id").cast(kind).alias(doc_id), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )

