"""Periodic runs of words: stretches that repeat one period at least three times.

The words of many documents are numbered and laid end to end. How far the words after two places agree (their longest
common extension) is found by a difference cover: for any two places some small shift brings both to sampled places. So
only the suffixes at sampled places are sorted, by their first words and then by doubling; two places are compared word
by word up to the shift, and from there on the answer is the least common prefix between two ranks, by a sparse table.

Runs are enumerated on a harmonic grid: for each period p places ``max(p, 12)`` words apart are compared with the place p
words on. Every run long enough holds such a place whose extension is long enough, and its first one gives the run's
beginning by bisection. A document of n words has about n log n places in the grid, taken in blocks of bounded size.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantloom.llm.common import whole

# fixed values: a difference cover modulo 31, each difference being that of exactly one pair
MODULUS, COVER = 31, (0, 1, 3, 8, 12, 18)
LEAST_WORDS, LEAST_PERIODS, STEP = 24, 3, 12
BATCH_WORDS, BLOCK = 1 << 18, 1 << 20

RESULT = (
    "doc_id string, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)


def _shifts() -> np.ndarray:
    """The smallest shift that brings two residues into the cover."""
    inside = np.isin(np.arange(MODULUS), COVER)
    at = np.arange(MODULUS)
    both = inside[(at[:, None, None] + at) % MODULUS] & inside[(at[None, :, None] + at) % MODULUS]
    return both.argmax(axis=2)


SHIFT = _shifts()


class Extensions:
    """How far the words after two places of one text agree.

    ``words`` holds the texts one after the other, each ended by a 0, with ``MODULUS`` zeros at the end; other words are
    above 0. ``owner`` is the number of the text at each place.
    """

    def __init__(self, words: np.ndarray, owner: np.ndarray):
        self.words = words
        n = len(words) - MODULUS
        rounds = -(-n // MODULUS)
        place = (np.arange(rounds)[:, None] * MODULUS + np.array(COVER)).ravel()
        self.slot = np.full(MODULUS, -1)
        self.slot[list(COVER)] = np.arange(len(COVER))
        self.place = place = place[place < n]
        number = len(place)
        width = int(words.max(initial=0)) + 1
        # rank: the place of its group in sorted order; only members of groups of two or more are sorted on
        texts = owner[place]
        rank = np.searchsorted(texts, texts)
        common = np.zeros(number + 1, dtype=np.int64)
        live = self._tied(rank, np.arange(number))
        for t in range(MODULUS):
            if not len(live):
                break
            live = self._refine(rank, live, words[place[live] + t], width, common, t)
        self.levels = []
        step = 0
        late = []
        while len(live):
            self.levels.append(rank.copy())
            ahead = live + (len(COVER) << step)
            follow = np.where(ahead < number, self.levels[-1][np.minimum(ahead, number - 1)], -1) + 1
            live = self._refine(rank, live, follow, number + 2, common, -1, late)
            step += 1
        self.rank = rank
        if late:
            self._measure(np.concatenate(late), common)
        self.table = [common[:number].astype(np.int32 if n < 1 << 31 else np.int64)]
        while 2 << len(self.table) - 1 <= number:
            last, half = self.table[-1], 1 << len(self.table) - 1
            self.table.append(np.minimum(last[:-half], last[half:]))

    @staticmethod
    def _tied(rank: np.ndarray, members: np.ndarray) -> np.ndarray:
        size = np.bincount(rank[members], minlength=len(rank) + 1)
        return members[size[rank[members]] > 1]

    def _refine(self, rank: np.ndarray, live: np.ndarray, by: np.ndarray, width: int, common: np.ndarray, t: int, late: list | None = None) -> np.ndarray:
        """Split the groups of ``live`` by ``by``; what two neighbours of a split group have in common is t, or is noted in ``late``."""
        key = rank[live] * width + by
        order = np.argsort(key, kind="stable")
        live, key = live[order], key[order]
        old = rank[live]
        index = np.arange(len(live))
        new_group = np.ones(len(live), bool)
        new_group[1:] = key[1:] != key[:-1]
        old_group = np.ones(len(live), bool)
        old_group[1:] = old[1:] != old[:-1]
        first_new = np.maximum.accumulate(np.where(new_group, index, 0))
        first_old = np.maximum.accumulate(np.where(old_group, index, 0))
        rank[live] = old + first_new - first_old
        split = new_group & ~old_group
        if late is None:
            common[rank[live[split]]] = t
        else:
            late.append(rank[live[split]])
        return self._tied(rank, live)

    def _measure(self, ranks: np.ndarray, common: np.ndarray) -> None:
        """Common prefixes of sorted neighbours that agree beyond the first block: down the levels, then word by word."""
        sorted_places = np.empty(len(self.place), np.int64)
        sorted_places[self.rank] = np.arange(len(self.place))
        x, y = sorted_places[ranks - 1], sorted_places[ranks]
        found = np.zeros(len(ranks), np.int64)
        for step in range(len(self.levels) - 1, -1, -1):
            inside = np.maximum(x, y) < len(self.place)
            a, b = np.minimum(x, len(self.place) - 1), np.minimum(y, len(self.place) - 1)
            same = inside & (self.levels[step][a] == self.levels[step][b])
            found += np.where(same, MODULUS << step, 0)
            x, y = x + np.where(same, len(COVER) << step, 0), y + np.where(same, len(COVER) << step, 0)
        x, y = self.place[np.minimum(x, len(self.place) - 1)], self.place[np.minimum(y, len(self.place) - 1)]
        live = np.arange(len(ranks))
        for t in range(MODULUS):
            live = live[self.words[x[live] + t] == self.words[y[live] + t]]
            found[live] += 1
            if not len(live):
                break
        common[ranks] = found

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from i < j on, both in one text."""
        shift = SHIFT[i % MODULUS, j % MODULUS]
        same = np.zeros(len(i), np.int64)
        live = np.arange(len(i))
        reached = [live[shift == 0]]
        live = live[shift > 0]
        for t in range(MODULUS):
            if not len(live):
                break
            live = live[self.words[i[live] + t] == self.words[j[live] + t]]
            same[live] += 1
            arrived = shift[live] == t + 1
            reached.append(live[arrived])
            live = live[~arrived]
        at = np.concatenate(reached)
        x, y = self.rank[self._number(i[at] + shift[at])], self.rank[self._number(j[at] + shift[at])]
        low, high = np.minimum(x, y) + 1, np.maximum(x, y) + 1
        level = np.frexp((high - low).astype(float))[1] - 1
        for k in np.unique(level):
            of = np.nonzero(level == k)[0]
            table = self.table[k]
            same[at[of]] += np.minimum(table[low[of]], table[high[of] - (1 << k)])
        return same

    def _number(self, place: np.ndarray) -> np.ndarray:
        return place // MODULUS * len(COVER) + self.slot[place % MODULUS]


def _grid(start: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks (place, period, first place of the text) of the grid's places."""
    periods = np.where(size >= LEAST_WORDS, size // LEAST_PERIODS, 0)
    for lo in _cuts(periods, BLOCK):
        n = periods[lo]
        text = np.repeat(lo, n)
        p = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + 1
        step = np.maximum(p, STEP)
        number = -(-(size[text] - p) // step)
        for rows in _cuts(number, BLOCK):
            k = number[rows]
            at = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
            yield np.repeat(start[text[rows]], k) + at * np.repeat(step[rows], k), np.repeat(p[rows], k), np.repeat(start[text[rows]], k)


def _cuts(number: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Indexes in pieces of about ``most`` in sum."""
    piece = (np.cumsum(number) - number) // most
    edges = [*np.searchsorted(piece, np.unique(piece)), len(number)]
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        yield np.arange(lo, hi)


def find_runs(words: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs (start, end, period) in texts laid out as for ``Extensions``, sorted; places count from the first text."""
    owner = np.zeros(len(words), np.int64)
    owner[start[1:]] = 1
    extend = Extensions(words, np.cumsum(owner))
    found = [np.zeros((3, 0), np.int64)]
    for i, p, first in _grid(start, size):
        for t in range(4):
            same = words[i + t] == words[i + p + t]
            i, p, first = i[same], p[same], first[same]
        step = np.maximum(p, STEP)
        least = np.maximum(LEAST_WORDS, LEAST_PERIODS * p)
        after = extend(i, i + p)
        ok = after >= least - p - step + 1
        i, p, first, step, least, after = (x[ok] for x in (i, p, first, step, least, after))
        # a run that holds the grid's last place too is found from there
        before = np.maximum(i - step, first)
        reaches = extend(before, before + p) >= i - before
        known = (i - step >= first) & reaches
        i, p, least, after, before, reaches = (x[~known] for x in (i, p, least, after, before, reaches))
        # no: the last place known to be outside the run; yes: the first known to be inside
        no, yes = np.where(reaches, before - 1, before), np.where(reaches, before, i)
        while (wide := np.nonzero(yes - no > 1)[0]).size:
            middle = (no[wide] + yes[wide]) // 2
            inside = extend(middle, middle + p[wide]) >= i[wide] - middle
            yes[wide[inside]] = middle[inside]
            no[wide[~inside]] = middle[~inside]
        ends = i + p + after
        ok = ends - yes >= least
        found.append(np.stack([yes[ok], ends[ok], p[ok]]))
    s, e, p = np.concatenate(found, axis=1)
    order = np.lexsort((p, e, s))
    s, e, p = s[order], e[order], p[order]
    smallest = np.ones(len(s), bool)
    smallest[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    s, e, p = s[smallest], e[smallest], p[smallest]
    order = np.lexsort((p, s))
    return s[order], e[order], p[order]


def repeated_source(doc: str | None, n: int) -> np.ndarray:
    """Which word of a text stands at each place: one text in ten repeats a part of itself, by the checksum of its id."""
    source = np.arange(n)
    if doc is not None and n:
        h = zlib.crc32(doc.encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            source[a:] = a + (source[a:] - a) % p
    return source


def _reported(doc: str | None, words: list[bytes], source: np.ndarray, s: np.ndarray, e: np.ndarray, p: np.ndarray) -> tuple:
    best = None
    for run in zip(s.tolist(), (e - s).tolist(), p.tolist(), strict=True):
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in zip(s.tolist(), (e - s).tolist(), p.tolist(), strict=True))
    depth = np.zeros(len(source) + 1, np.int64)
    np.add.at(depth, s + p, 1)
    np.add.at(depth, e, -1)
    kept = source[np.cumsum(depth[:-1]) == 0].tolist()
    text = b" ".join([words[k] for k in kept])
    values = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return doc, len(s), *values, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text).hexdigest()


def _batches(parts: Iterator[pd.DataFrame]) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    held, words = [], 0
    for part in parts:
        for doc, t in zip(part["doc_id"], part["t"], strict=True):
            found = t.encode().split()  # white space of bytes: space, tab to carriage return
            held.append((None if pd.isna(doc) else doc, found))
            words += len(found)
            if words >= BATCH_WORDS:
                yield held
                held, words = [], 0
    if held:
        yield held


def _report(docs: list[tuple[str | None, list[bytes]]], repeat: bool) -> Iterator[tuple]:
    size = np.array([len(w) for _, w in docs], dtype=np.int64)
    start = np.cumsum(size + 1) - size - 1
    ids = pd.factorize(np.array([w for _, words in docs for w in words], dtype=object))[0] + 1 if size.sum() else np.zeros(0, np.int64)
    laid = np.zeros(int(size.sum()) + len(docs) + MODULUS, np.int64)
    sources, at = [], 0
    for (doc, _), n, a in zip(docs, size.tolist(), start.tolist(), strict=True):
        source = repeated_source(doc, n) if repeat else np.arange(n)
        laid[a : a + n] = ids[at : at + n][source]
        sources.append(source)
        at += n
    s, e, p = find_runs(laid, start, size)
    edges = np.searchsorted(s, [*start, len(laid)])
    for k, (doc, words) in enumerate(docs):
        of = slice(edges[k], edges[k + 1])
        yield _reported(doc, words, sources[k], s[of] - start[k], e[of] - start[k], p[of])


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", repeat: bool = True) -> DataFrame:
    """A row per document: n_runs, its run of greatest exponent (start, length, period, exponent_milli), the hash of all
    its runs and the hash of its words without those that a run repeats.

    A run has at least 24 words and three times its smallest period, and cannot be extended. With ``repeat`` one document
    in ten repeats a part of itself first, as ``repeated_source`` says; without it texts are taken as they are. Null text
    has no words; a document without id is never made to repeat; each row is judged by itself, so repeated rows give
    repeated results; other columns are ignored; an empty table gives no rows. A text of any length is taken whole, in
    one task.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def report(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in RESULT.split(", ")]
        for held in _batches(parts):
            out = pd.DataFrame(list(_report(held, repeat)), columns=names)
            yield out.astype({c: "Int64" for c in ("start", "length", "period", "exponent_milli")} | {"doc_id": object})

    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), whole(text).alias("t")).mapInPandas(report, RESULT)
    return rows.select(F.col("doc_id").cast(kind).alias(doc_id), *[c for c in rows.columns if c != "doc_id"])
