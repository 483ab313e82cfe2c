"""Packing documents into token sequences with a controlled mixture of sources.

Deficit round-robin: every source is a queue of tokens in arrival order. In each window the sources are visited in turn;
a visit adds the source's share of the window to its deficit counter, and the source hands over as many tokens as the
counter allows. What it is still owed is carried into the next window, so no window is off its target by more than one
token a source as long as the queues last; a source that runs dry leaves its share to the others.

The counter after window i follows from i alone: it is the share that the source has earned until the time at which all
sources together have handed over (i + 1) windows, less the whole tokens given. So the deficits are carried across
partitions without passing anything between tasks: each task works out the state of the windows its documents meet.

Up to ``FAN`` sources take turns in one round. More are grouped, and a group is a queue that is itself filled by turns,
window by window; so the work on a document grows with the number of levels, not of sources. A window then holds each
group's share to the token, and each source's over as many tokens as its group needs for a window.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantloom.llm.bpe import encoder
from quantloom.llm.common import whole
from quantloom.sources.stage import stage

WINDOW = 2048
FAN = 64
CELLS = 1 << 20

PIECES = (
    "doc_id string, source string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


class Schedule:
    """Tokens that each queue has handed over after each window; a pure function of the totals and weights."""

    def __init__(self, totals: np.ndarray, weights: np.ndarray, window: int):
        self.totals, self.weights, self.window = totals.astype(np.int64), weights.astype(float), window
        self.all = int(self.totals.sum())
        # time without rounding: between two queues' ends all others hand over at a constant rate
        ends = self.totals / self.weights
        order = np.argsort(ends, kind="stable")
        self.ends = np.concatenate([[0.0], ends[order]])
        rates = np.cumsum(self.weights[order][::-1])[::-1]
        self.rates = np.concatenate([rates, [rates[-1] if len(rates) else 1.0]])
        self.reached = np.concatenate([[0.0], np.cumsum(np.diff(self.ends) * rates)])

    def _time(self, tokens: np.ndarray) -> np.ndarray:
        """When all queues have handed over so many tokens, without rounding."""
        at = np.clip(np.searchsorted(self.reached, tokens, side="right") - 1, 0, len(self.reached) - 1)
        return np.maximum(0.0, self.ends[at] + (tokens - self.reached[at]) / self.rates[at])

    def _given(self, time: np.ndarray) -> np.ndarray:
        """Tokens due by a time, queue by queue: half a token early or late at most, never beyond the queue."""
        return np.minimum(np.floor(time[:, None] * self.weights + 0.5).astype(np.int64), self.totals)

    def after(self, windows: np.ndarray) -> np.ndarray:
        """Rows: the cumulative tokens of each queue after the window with this number (-1: before the first)."""
        goal = np.minimum((windows + 1) * self.window, self.all)
        # rounding moves the sum by at most half a token a queue
        slack = len(self.totals) / 2 + 1 + goal * 1e-9
        low, high = self._time(goal - slack), self._time(goal + slack)
        while True:
            before, at = self._given(low), self._given(high)
            before[goal == 0] = 0
            at[goal >= self.all] = self.totals
            wide = np.nonzero((at - before).max(axis=1, initial=0) > 1)[0]
            if not len(wide):
                break
            middle = (low[wide] + high[wide]) / 2
            if ((middle <= low[wide]) | (middle >= high[wide])).all():
                break
            enough = self._given(middle).sum(axis=1) >= goal[wide]
            high[wide], low[wide] = np.where(enough, middle, high[wide]), np.where(enough, low[wide], middle)
        # at most one token of each queue is in question now: the earliest are served, of equal ones in the queues' order
        due, left = at - before, goal - before.sum(axis=1)
        when = np.where(due > 0, (before + 0.5) / self.weights, np.inf)
        order = np.argsort(when, axis=1, kind="stable")
        ahead = np.cumsum(np.take_along_axis(due, order, axis=1), axis=1) - np.take_along_axis(due, order, axis=1)
        served = np.empty_like(due)
        np.put_along_axis(served, order, np.clip(left[:, None] - ahead, 0, np.take_along_axis(due, order, axis=1)), axis=1)
        return before + served

    def window_of(self, queue: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds on the window that holds the token at this place of its queue."""
        time = (token + 0.5) / self.weights[queue]
        at = np.clip(np.searchsorted(self.ends, time, side="right") - 1, 0, len(self.ends) - 1)
        rank = self.reached[at] + (time - self.ends[at]) * self.rates[at]
        slack = len(self.totals) + 2 + rank * 1e-9
        last = max(0, (self.all - 1) // self.window)
        low = np.clip((rank - slack) // self.window, 0, last).astype(np.int64)
        high = np.clip((rank + slack) // self.window, 0, last).astype(np.int64)
        return low, high

    def cut(self, queue: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """Cut stretches of queues at the windows: (row, begin, length, window, offset), begin counted from the stretch's."""
        low, high = self.window_of(queue, first)[0], self.window_of(queue, first + n - 1)[1]
        meets = high - low + 1
        step, parts = max(1, CELLS // max(1, len(self.totals))), []
        piece = (np.cumsum(meets) - meets) // step
        edges = [*np.searchsorted(piece, np.unique(piece)), len(piece)]
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            for begin in range(0, int(meets[lo:hi].sum()), step):  # a very long stretch meets many windows by itself
                row = np.repeat(np.arange(lo, hi), meets[lo:hi])
                at = low[row] + np.arange(len(row)) - np.repeat(np.cumsum(meets[lo:hi]) - meets[lo:hi], meets[lo:hi])
                row, at = row[begin : begin + step], at[begin : begin + step]
                wanted = np.unique(np.concatenate([at - 1, at]))
                given = self.after(wanted)
                here, back = np.searchsorted(wanted, at), np.searchsorted(wanted, at - 1)
                taken = given[here] - given[back]
                q = queue[row]
                own = np.arange(len(row))
                start, stop = given[back, q], given[here, q]
                offset = np.cumsum(taken, axis=1)[own, q] - taken[own, q]
                x = np.maximum(start, first[row])
                y = np.minimum(stop, first[row] + n[row])
                ok = y > x
                parts.append(np.stack([row, x - first[row], y - x, at, offset + x - start])[:, ok])
        found = np.concatenate(parts, axis=1) if parts else np.zeros((5, 0), np.int64)
        return tuple(found)


class Rounds:
    """Schedules by level: the sources' turns in their groups, the groups' in theirs, up to one round of at most ``fan``."""

    def __init__(self, totals: np.ndarray, weights: np.ndarray, window: int, fan: int = FAN):
        self.window, self.fan, self.levels = window, fan, []
        while True:
            starts = np.arange(0, len(totals), fan)
            self.levels.append([Schedule(totals[i : i + fan], weights[i : i + fan], window) for i in starts])
            if len(totals) <= fan:
                break
            totals, weights = np.add.reduceat(totals, starts), np.add.reduceat(weights, starts)

    def cut(self, source: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """Cut stretches of the sources' queues: (row, begin, length, window, offset)."""
        row, begin = np.arange(len(source)), np.zeros(len(source), np.int64)
        for plans in self.levels:
            group, parts = source // self.fan, []
            for g in np.unique(group):
                of = np.nonzero(group == g)[0]
                k, x, length, window, offset = plans[g].cut(source[of] % self.fan, first[of], n[of])
                parts.append(np.stack([row[of][k], begin[of][k] + x, length, window, offset, np.full(len(k), g)]))
            row, begin, n, window, offset, source = np.concatenate(parts, axis=1)
            first = window * self.window + offset  # the place in the group's own queue
        order = np.lexsort((begin, row))
        return row[order], begin[order], n[order], window[order], offset[order]


def encode_queue(docs: DataFrame, path: str, end_id: int, doc_id: str, text: str, source: str) -> DataFrame:
    """Stored rows (doc_id, source, n, part, local, ids): ids with the end id, and the tokens of the same source ahead in
    the same partition. Any partitioning will do; the stored order of rows is the order of the queues."""

    def encode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code, ahead, part_no = encoder(path), {}, TaskContext.get().partitionId()
        end = np.array([end_id], dtype=code.kind).tobytes()
        for part in parts:
            ids = [code.encode(t) + end for t in part["t"]]
            n = [len(x) // code.width for x in ids]
            local = []
            for s, k in zip(part["source"], n, strict=True):
                s = None if pd.isna(s) else s
                local.append(ahead.get(s, 0))
                ahead[s] = local[-1] + k
            yield pd.DataFrame({"doc_id": part["doc_id"], "source": part["source"], "n": n, "part": part_no, "local": local, "ids": ids})

    rows = docs.select(
        F.col(doc_id).cast("string").alias("doc_id"), F.col(source).cast("string").alias("source"), whole(text).alias("t")
    )
    return stage(rows.mapInPandas(encode, "doc_id string, source string, n long, part int, local long, ids binary"), "queue")


def pack(
    docs: DataFrame,
    path: str,
    end_id: int = 1,
    window: int = WINDOW,
    weights: dict[str | None, float] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Pack every token of every document into sequences of ``window`` tokens; only the last one can be shorter.

    Returns a row per piece: doc_id, source, start, length, ids_crc32 (of the piece's ids as little-endian unsigned 32-bit
    integers), doc_tokens (with the end id), sequence_id, offset. ``weights`` gives the target tokens of a source relative
    to the others; without it the target is the corpus itself, so that all queues end together.

    Null text is empty: the end id alone. A null source is a source of its own, null ids and repeated rows are documents
    like others, an empty table gives no pieces, other columns are ignored. A document of any length is cut across as
    many windows as it needs.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    queue = encode_queue(docs, path, end_id, doc_id, text, source)
    # one row for each partition and source, and one for each source in the driver: the running sum over them is the only step that follows the queues' order
    blocks = stage(queue.groupBy("source", "part").agg(F.sum("n").alias("n")), "queue-blocks")
    totals = blocks.groupBy("source").agg(F.sum("n").alias("n")).collect()
    totals = sorted(((r.source, r.n) for r in totals), key=lambda x: (x[0] is None, x[0] or ""))
    number = {s: i for i, (s, _) in enumerate(totals)}
    tokens = np.array([n for _, n in totals], dtype=np.int64)
    if weights is not None and any(not weights.get(s, 0) > 0 for s in number):
        raise ValueError("every source needs a weight above 0")
    rates = tokens if weights is None else np.array([weights[s] for s, _ in totals])
    order = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = blocks.select(
        F.col("source").alias("b_source"), F.col("part").alias("b_part"), F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before")
    )
    ahead = stage(ahead, "queue-before")
    placed = queue.join(ahead, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("part") == F.col("b_part")))
    placed = placed.select("doc_id", "source", "n", (F.col("before") + F.col("local")).alias("first"), "ids")

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plan, stored = Rounds(tokens, rates, window), encoder(path).kind
        for whole_part in parts:
            for at_row in range(0, len(whole_part), 512):
                part = whole_part.iloc[at_row : at_row + 512]
                source = np.fromiter((number[None if s != s else s] for s in part["source"]), np.int64, len(part))
                n = part["n"].to_numpy(np.int64)
                row, begin, length, at, offset = plan.cut(source, part["first"].to_numpy(np.int64), n)
                ids = memoryview(np.frombuffer(b"".join(part["ids"]), dtype=stored).astype("<u4")).cast("B")
                place = 4 * ((np.cumsum(n) - n)[row] + begin)
                crc = [zlib.crc32(ids[x:y]) for x, y in zip(place.tolist(), (place + 4 * length).tolist(), strict=True)]
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].to_numpy(object)[row], "source": part["source"].to_numpy(object)[row], "start": begin,
                    "length": length, "ids_crc32": crc, "doc_tokens": n[row], "sequence_id": at, "offset": offset,
                })

    pieces = placed.mapInPandas(cut, PIECES)
    return pieces.select(F.col("doc_id").cast(kind).alias(doc_id), *[c for c in pieces.columns if c != "doc_id"])
