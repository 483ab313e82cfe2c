"""Spelling variants: words one inserted, deleted or replaced letter apart, found in a trie of letter counts.

A word's vector counts its letters by group, and the trie arranges words by one count after the other. A search walks
down depth first with a budget of one surplus and one deficit: a word with one letter more has one count larger by one,
a replaced letter moves one count up and one down or, within a group, none. Of a pair only the word whose vector comes
first searches for the other, so a surplus is always spent before the deficit. Words of a leaf that share their first or
their second half with the searched word are compared letter by letter; a single edit leaves one half as it is.

The top of the trie, nodes with more than ``room`` words, is known to every task and deals words out to shards, the
subtrees below; ``room`` grows with the number of words, so that the top has at most ``TOP_NODES`` nodes a level. Each
shard is searched by the words that the top lets through to it. A shard that many words search is copied, a leaf with
too many words is cut, so no task depends on one hot subtree.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantloom.llm.common import whole
from quantloom.sources.stage import stage

RUN = re.compile("[a-zÀ-ÿ]+")
# fixed values: letters by group, in the order of the trie's levels; any other letter is in the last group
GROUPS = ("e", "t", "a", "io", "n", "s", "hr", "dl", "cm", "uw", "fgy", "bpvkjxqz")
LEVELS = len(GROUPS) + 1
ROOM, TOP_NODES = 2048, 20_000
SEARCHES = 1 << 14
BLOCK = 1 << 16
HELD_ENTRIES, HELD_CHARS = 1 << 18, 1 << 24
LONG = 64

_GROUP_OF = np.full(256, LEVELS - 1, dtype=np.int64)
for _i, _letters in enumerate(GROUPS):
    for _c in _letters:
        _GROUP_OF[ord(_c)] = _i


def _damaged(doc: str, text: str, one_in: int) -> Iterator[tuple[str, int]]:
    """Words of a document and their numbers, with one letter deleted from one in ``one_in``."""
    base = zlib.crc32(f"{doc}:".encode())
    lower = text.encode().lower().decode()
    for word, n in Counter(RUN.findall(lower)).items():
        h = zlib.crc32(word.encode(), base)
        if h % one_in == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        yield word, n


def count_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = 5, least_n: int = 3, one_in: int = 97) -> DataFrame:
    """Rows (word, n) of the words with enough letters and occurrences in all texts."""

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter[str] = Counter()
        chars = 0

        def out() -> pd.DataFrame:
            return pd.DataFrame({"word": list(held), "n": np.fromiter(held.values(), np.int64, len(held))})

        for part in parts:
            for doc, t in zip(part["doc"], part["t"], strict=True):
                for word, n in _damaged(doc, t, one_in):
                    if len(word) >= least_chars:
                        if word not in held:
                            chars += len(word)
                        held[word] += n
                if len(held) >= HELD_ENTRIES or chars >= HELD_CHARS:
                    yield out()
                    held.clear()
                    chars = 0
        if held:
            yield out()

    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc"), whole(text).alias("t"))
    parts = rows.mapInPandas(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


class Letters:
    """Letters of words, one byte each, with the counts of each word by group."""

    def __init__(self, words: list[str]):
        self.words = words
        self.codes = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        self.start = np.cumsum(self.size) - self.size
        owner = np.repeat(np.arange(len(words)), self.size)
        cells = np.bincount(owner * LEVELS + _GROUP_OF[self.codes], minlength=len(words) * LEVELS)
        self.counts = cells.reshape(len(words), LEVELS)
        self._sums = None

    def hashes(self, at: np.ndarray, until: np.ndarray) -> np.ndarray:
        """Hashes of the letters between places of ``codes``: equal letters have equal hashes."""
        if self._sums is None:
            powers = np.ones(len(self.codes) + 1, dtype=np.uint64)
            powers[1:] = np.uint64(0x9E3779B97F4A7C15)
            inverse = np.ones(len(self.codes) + 1, dtype=np.uint64)
            inverse[1:] = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
            powers, inverse = np.cumprod(powers), np.cumprod(inverse)
            sums = np.zeros(len(self.codes) + 1, dtype=np.uint64)
            np.cumsum((self.codes.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
            self._sums = sums, inverse
        sums, inverse = self._sums
        return (sums[until] - sums[at]) * inverse[at]


class Trie:
    """Nodes found by (parent, count); ``leaf`` is the number of the leaf that a node is, or -1."""

    def __init__(self, keys: np.ndarray, child: np.ndarray, leaf: np.ndarray, most: int):
        order = np.argsort(keys)
        self.keys, self.child, self.leaf, self.base = keys[order], child[order], leaf, most + 1

    @classmethod
    def of_paths(cls, paths: list[tuple[int, ...]]) -> Trie:
        """The trie of these paths; path i ends in leaf i."""
        node = {(): 0}
        base = max((c for p in paths for c in p), default=0) + 1
        keys, child, leaf = [], [], {}
        for i, path in enumerate(paths):
            for d in range(len(path)):
                if path[: d + 1] not in node:
                    node[path[: d + 1]] = len(node)
                    keys.append(node[path[:d]] * base + path[d])
                    child.append(len(node) - 1)
            leaf[node[path]] = i
        marks = np.full(len(node), -1, dtype=np.int64)
        marks[list(leaf)] = list(leaf.values())
        return cls(np.array(keys, np.int64), np.array(child, np.int64), marks, base - 1)

    @classmethod
    def of_words(cls, counts: np.ndarray, first: int) -> tuple[Trie, np.ndarray]:
        """The trie of count vectors from level ``first`` on, and the leaf of each vector."""
        most = int(counts.max(initial=0))
        at, nodes = np.zeros(len(counts), np.int64), 1
        keys, child = [], []
        for level in range(first, LEVELS):
            found, inverse = np.unique(at * (most + 1) + counts[:, level], return_inverse=True)
            keys.append(found)
            child.append(nodes + np.arange(len(found)))
            at = nodes + inverse
            nodes += len(found)
        leaf = np.full(nodes, -1, dtype=np.int64)
        leaf[at] = at
        if not keys:
            return cls(np.zeros(0, np.int64), np.zeros(0, np.int64), leaf, most), at
        return cls(np.concatenate(keys), np.concatenate(child), leaf, most), at

    def search(self, counts: np.ndarray, spent: np.ndarray, first: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Blocks (row, leaf, spent) of the leaves that each row reaches; spent: 0 nothing, 1 the surplus, 2 both.

        Rows go down together in blocks of bounded size, the deepest block first.
        """
        blocks = [(first, i + np.arange(min(BLOCK, len(counts) - i)), None, None) for i in range(0, len(counts), BLOCK)]
        while blocks:
            level, row, node, used = blocks.pop()
            if node is None:
                node, used = np.zeros(len(row), np.int64), spent[row]
            ends = self.leaf[node]
            if (ended := ends >= 0).any():
                yield row[ended], ends[ended], used[ended]
                row, node, used = row[~ended], node[~ended], used[~ended]
            if not len(row) or level == LEVELS or not len(self.keys):
                continue
            have, found = counts[row, level], []
            for step, may in ((0, None), (1, used == 0), (-1, used == 1)):
                r, n, u, c = (row, node, used, have) if may is None else (row[may], node[may], used[may] + 1, have[may] + step)
                key = n * self.base + c
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = (self.keys[at] == key) & (c >= 0) & (c < self.base)
                found.append((r[hit], self.child[at[hit]], u[hit]))
            row, node, used = (np.concatenate(x) for x in zip(*found, strict=True))
            blocks += [(level + 1, row[i : i + BLOCK], node[i : i + BLOCK], used[i : i + BLOCK]) for i in range(0, len(row), BLOCK)]


def _paths(counts: np.ndarray, open_paths: frozenset) -> list[tuple[int, ...]]:
    """Each vector's path to the first node that isn't open."""
    out = []
    for row in counts.tolist():
        depth = 1
        while depth < LEVELS and tuple(row[:depth]) in open_paths:
            depth += 1
        out.append(tuple(row[:depth]))
    return out


def _same(a: Letters, i: np.ndarray, b: Letters, j: np.ndarray, backwards: bool) -> np.ndarray:
    """Number of equal letters at the beginning, or the end, of word i of ``a`` and word j of ``b``."""
    least = np.minimum(a.size[i], b.size[j])
    same = np.zeros(len(i), np.int64)
    live = np.nonzero(least <= LONG)[0]
    for t in range(int(least[live].max(initial=0))):
        live = live[least[live] > t]
        x = a.start[i[live]] + (a.size[i[live]] - 1 - t if backwards else t)
        y = b.start[j[live]] + (b.size[j[live]] - 1 - t if backwards else t)
        live = live[a.codes[x] == b.codes[y]]
        same[live] += 1
        if not len(live):
            break
    for k in np.nonzero(least > LONG)[0]:
        x = a.codes[a.start[i[k]] :][: a.size[i[k]]]
        y = b.codes[b.start[j[k]] :][: b.size[j[k]]]
        if backwards:
            x, y = x[::-1], y[::-1]
        differ = x[: least[k]] != y[: least[k]]
        same[k] = differ.argmax() if differ.any() else least[k]
    return same


class Shard:
    """Words of a subtree, ready to be searched."""

    def __init__(self, words: list[str], n: np.ndarray, depth: int):
        self.letters, self.n, self.depth = Letters(words), n, depth
        self.trie, leaf = Trie.of_words(self.letters.counts, depth)
        size, start = self.letters.size, self.letters.start
        keys, owner = [], []
        for longer in (0, 1):  # the searched word is as long, or shorter by one
            half = (size - longer) // 2
            rest = size - longer - half
            keys += [self._key(leaf, longer, 0, self.letters.hashes(start, start + half))]
            keys += [self._key(leaf, longer, 1, self.letters.hashes(start + size - rest, start + size))]
            owner += [np.arange(len(words))] * 2
        keys, owner = np.concatenate(keys), np.concatenate(owner)
        order = np.argsort(keys, kind="stable")
        self.keys, self.owner = keys[order], owner[order]

    @staticmethod
    def _key(leaf: np.ndarray, longer: np.ndarray | int, side: int, hashes: np.ndarray) -> np.ndarray:
        place = (leaf * 4 + longer * 2 + side).astype(np.uint64)
        return (hashes ^ (place * np.uint64(0xD6E8FEB86659FD93))) * np.uint64(0xFF51AFD7ED558CCD)

    def near(self, words: list[str], spent: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks (row, word of the shard) of the pairs one edit apart; of two words with equal counts the first finds the second."""
        asked = Letters(words)
        half = asked.size // 2
        ends = asked.start + asked.size
        sides = asked.hashes(asked.start, asked.start + half), asked.hashes(asked.start + half, ends)
        for row, leaf, used in self.trie.search(asked.counts, spent, self.depth):
            found = []
            for side in (0, 1):
                key = self._key(leaf, (used == 1).astype(np.int64), side, sides[side][row])
                low, high = np.searchsorted(self.keys, key), np.searchsorted(self.keys, key, side="right")
                number = high - low
                place = np.repeat(low - (np.cumsum(number) - number), number) + np.arange(number.sum())
                found.append(np.repeat(row * 2 + (used == 0), number) * len(self.n) + self.owner[place])
            i, j = np.divmod(np.unique(np.concatenate(found)), len(self.n))
            i, level = i // 2, i % 2 == 1
            a, b = asked.size[i], self.letters.size[j]
            edits = _same(asked, i, self.letters, j, False) + _same(asked, i, self.letters, j, True)
            ok = ((a == b) & (edits == a - 1)) | ((b == a + 1) & (edits >= a))
            for k in np.nonzero(ok & level)[0]:
                ok[k] = words[i[k]] < self.letters.words[j[k]]
            if ok.any():
                yield i[ok], j[ok]


def _top(vocabulary: DataFrame, room: int) -> tuple[frozenset, list[tuple[int, ...]]]:
    """Paths of the nodes with more than ``room`` words, and of the nodes below them that are shards."""

    def nodes(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            counts = Letters(part["word"].tolist()).counts
            at, most = np.zeros(len(counts), np.int64), int(counts.max(initial=0))
            for level in range(LEVELS - 1):
                _, first, at, n = np.unique(at * (most + 1) + counts[:, level], return_index=True, return_inverse=True, return_counts=True)
                yield pd.DataFrame({"path": counts[first, : level + 1].tolist(), "n": n})

    number = vocabulary.select("word").mapInPandas(nodes, "path array<int>, n long").groupBy("path").agg(F.sum("n").alias("n"))
    open_paths = frozenset(tuple(r.path) for r in number.where(F.col("n") > room).select("path").collect())

    def shards(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame({"path": list({p: None for p in _paths(Letters(part["word"].tolist()).counts, open_paths)})})

    found = vocabulary.select("word").mapInPandas(shards, "path array<int>").distinct().collect()
    return open_paths, sorted(tuple(r.path) for r in found)


def near_pairs(vocabulary: DataFrame, room: int | None = None) -> DataFrame:
    """Rows (word, near, near_n) of the words one edit apart, both ways. ``vocabulary``: stored rows (word, n)."""
    room = room or max(ROOM, math.ceil(vocabulary.count() / TOP_NODES))
    open_paths, paths = _top(vocabulary, room)
    number = {p: i for i, p in enumerate(paths)}
    routed = "shard int, search boolean, spent int, word string, n long"

    def deal(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        top = Trie.of_paths(paths)
        for part in parts:
            counts, word, n = Letters(part["word"].tolist()).counts, part["word"].to_numpy(), part["n"].to_numpy()
            yield pd.DataFrame({"shard": [number[p] for p in _paths(counts, open_paths)], "search": False, "spent": 0, "word": word, "n": n})
            for row, shard, spent in top.search(counts, np.zeros(len(counts), np.int64), 0):
                yield pd.DataFrame({"shard": shard, "search": True, "spent": spent, "word": word[row], "n": n[row]})

    rows = stage(vocabulary.mapInPandas(deal, routed), "spelling-dealt")
    counted = rows.groupBy("shard").agg(F.count_if("search").alias("searches"), F.count_if(~F.col("search")).alias("words"))
    cuts = stage(
        counted.select(
            F.col("shard").alias("c_shard"),
            F.ceil(F.greatest(F.col("searches"), F.lit(1)) / SEARCHES).cast("int").alias("s_cuts"),
            F.ceil(F.greatest(F.col("words"), F.lit(1)) / (2 * room)).cast("int").alias("w_cuts"),
        ),
        "spelling-cuts",
    )
    cut = rows.join(cuts, F.col("shard") == F.col("c_shard"))
    own = F.pmod(F.xxhash64("word"), F.when(F.col("search"), F.col("s_cuts")).otherwise(F.col("w_cuts"))).cast("int")
    # a search goes to every cut of the words, and a word to every cut of the searches
    others = F.explode(F.sequence(F.lit(0), F.when(F.col("search"), F.col("w_cuts")).otherwise(F.col("s_cuts")) - 1))
    dealt = cut.select("shard", "search", "spent", "word", "n", own.alias("own"), others.alias("other"))
    cell = F.when(F.col("search"), F.struct(F.col("other").alias("w"), F.col("own").alias("s"))).otherwise(
        F.struct(F.col("own").alias("w"), F.col("other").alias("s"))
    )
    dealt = dealt.select("shard", cell.alias("cell"), "search", "spent", "word", "n").select(
        "shard", F.col("cell.w").alias("w"), F.col("cell.s").alias("s"), "search", "spent", "word", "n"
    )
    depths = np.array([len(p) for p in paths], dtype=np.int64)

    def find(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, words, shard, held_words = None, [], None, np.zeros(0, object)
        for part in parts:
            key = part[["shard", "w", "s", "search"]].to_numpy(np.int64)
            edges = np.nonzero((key[1:] != key[:-1]).any(axis=1))[0] + 1
            for lo, hi in zip([0, *edges], [*edges, len(key)], strict=True):
                piece, cell, search = part.iloc[lo:hi], tuple(key[lo, :3]), bool(key[lo, 3])
                if cell != at:
                    at, words, shard = cell, [], None
                if not search:  # the words come first
                    words.append(piece[["word", "n"]])
                    continue
                if not words:
                    continue
                if shard is None:
                    held = pd.concat(words)
                    held_words = held["word"].to_numpy()
                    shard = Shard(held["word"].tolist(), held["n"].to_numpy(), int(depths[cell[0]]))
                asked, n = piece["word"].to_numpy(), piece["n"].to_numpy()
                for i, j in shard.near(piece["word"].tolist(), piece["spent"].to_numpy(np.int64)):
                    there = held_words[j]
                    yield pd.DataFrame({"word": asked[i], "near": there, "near_n": shard.n[j]})
                    yield pd.DataFrame({"word": there, "near": asked[i], "near_n": n[i]})

    ordered = dealt.repartition("shard", "w", "s").sortWithinPartitions("shard", "w", "s", "search")
    return ordered.mapInPandas(find, "word string, near string, near_n long")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = 5, least_n: int = 3, room: int | None = None) -> DataFrame:
    """Rows (word, n, n_near, form, form_n, root) of all words with at least ``least_chars`` letters and ``least_n`` places.

    ``form`` is the most frequent word one edit away (ties: the first in code-point order) if it is at least twice as
    frequent, ``root`` the last word that forms lead to. Null text has no words, a null id counts as an empty one, rows
    that repeat id and text count as often as they occur, other columns are ignored, an empty table gives no rows. A run
    of letters of any length is one word.
    """
    vocabulary = stage(count_words(docs, doc_id, text, least_chars, least_n), "spelling-words")
    best = near_pairs(vocabulary, room).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best")
    )
    frequent = -F.col("best.n") >= 2 * F.col("n")
    words = stage(
        vocabulary.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(frequent, F.col("best.word")).alias("form"),
            F.when(frequent, -F.col("best.n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    # every step to a form doubles the frequency, so a path has at most 62 steps and the loop at most 7 rounds
    links = words.where("form is not null").select("word", F.col("form").alias("root"), F.lit(True).alias("moved"))
    while links.where("moved").limit(1).count():
        ahead = links.select(F.col("word").alias("l_word"), F.col("root").alias("l_root"))
        links = stage(
            links.join(ahead, F.col("root") == F.col("l_word"), "left").select("word", F.coalesce("l_root", "root").alias("root"), F.col("l_root").isNotNull().alias("moved")),
            "spelling-links",
        )
    roots = links.select(F.col("word").alias("l_word"), F.col("root").alias("l_root"))
    return words.join(roots, F.col("word") == F.col("l_word"), "left").select(
        "word", "form", F.coalesce("l_root", "word").alias("root"), "n", "n_near", "form_n"
    )
