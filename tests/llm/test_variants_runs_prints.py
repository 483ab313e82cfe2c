"""Spelling variants, periodic runs and fingerprints against brute force on small odd tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from quantloom.llm import imatch, periodic, spelling


def brute_variants(rows, least_n):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            n[word] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= least_n}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    linked = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for w, others in linked.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 2 * n[w]:
            form[w] = best
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n[w], len(linked[w]), n[form[w]] if w in form else None)
    return out


def test_variants_equal_brute_force(spark, odd_docs, no_docs):
    rng = np.random.default_rng(11)
    letters, pool = list("abeotnÀéz"), []
    for _ in range(60):
        w = [letters[k] for k in rng.integers(0, 9, int(rng.integers(5, 12)))]
        pool.append("".join(w))
        for _ in range(3):
            v, at = list(w), int(rng.integers(0, len(w)))
            v[at : at + int(rng.integers(0, 2))] = letters[int(rng.integers(0, 9))] * int(rng.integers(0, 3))
            pool.append("".join(v))
    pool += ["listen", "silent", "silest", "q" * 80, "q" * 40 + "x" + "q" * 39, "q" * 79, "Listen"]
    rows = [(i, " ".join(pool[k] for k in rng.zipf(1.3, 80) % len(pool))) for i in range(300)]
    rows += [(None, " ".join(pool[:40])), (7, None), (7, "listen listen silest")]
    rows += [(900 + i, " ".join(f"{c}{'hainest'[:k]}" for k in range(4, 8) for _ in range(3 << 2 * (7 - k)))) for i, c in enumerate("cdef")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute_variants(rows, 3)
    assert sum(x[0] is not None for x in want.values()) > 20 and sum(x[0] is not None and x[0] != x[1] for x in want.values()) > 3
    for room in (None, 4, 50):  # one shard, leaves that are cut, several levels
        got = spelling.variants(docs, room=room).collect()
        assert len(got) == len(want) and {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want
    assert {r.word for r in spelling.variants(odd_docs, least_n=1).collect()} == set(brute_variants([(r.doc_id, r.text) for r in odd_docs.collect()], 1))
    assert spelling.variants(no_docs).count() == 0


def test_searches_and_leaves_are_cut(spark, monkeypatch):
    monkeypatch.setattr(spelling, "SEARCHES", 3)
    words = [("a" * 4 + x + y, 3) for x in "bcdfgh" for y in "bcdfgh"] + [(p, 3) for p in ("abcde", "abced", "acbde", "badce", "abxde")]
    table = spelling.stage(spark.createDataFrame(words, "word string, n long"), "words")
    got = Counter((r.word, r.near) for r in spelling.near_pairs(table, room=2).collect())
    want = {(a, b) for a, _ in words for b, _ in words if len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1}
    assert set(got) == want and set(got.values()) == {1}


def brute_runs(words):
    found = {}
    for p in range(1, len(words) // 3 + 1):
        at = 0
        while at + p < len(words):
            if words[at] != words[at + p]:
                at += 1
                continue
            start = at
            while at + p < len(words) and words[at] == words[at + p]:
                at += 1
            if at + p - start >= max(24, 3 * p):
                found.setdefault((start, at + p), p)
    return sorted((s, e - s, p) for (s, e), p in found.items())


def brute_periodic(doc, text, repeat=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc).encode())
    if repeat and doc is not None and h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    gone = {i for s, k, p in runs for i in range(s + p, s + k)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    listed, left = "".join(f"{s},{k},{p}\n" for s, k, p in runs), " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc, len(runs), *best, best[1] and 1000 * best[1] // best[2], digest(listed), digest(left))


def test_runs_equal_brute_force(spark, odd_docs, no_docs):
    rng = np.random.default_rng(12)
    rows = []
    for i in range(250):
        w = [f"w{k}" for k in rng.integers(0, 2 if i % 3 else 400, int(rng.integers(0, 300)))]
        for _ in range(int(rng.integers(0, 3))):
            s, p = int(rng.integers(0, len(w) + 1)), int(rng.integers(1, 60))
            w[s : s + p] = w[s : s + p] * int(rng.integers(1, 6))
        rows.append((i, " \n".join(w)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for repeat in (True, False):
        got = {r.doc_id: tuple(r) for r in periodic.periodic_runs(docs, repeat=repeat).collect()}
        assert got == {i: brute_periodic(i, t, repeat) for i, t in rows}
    assert sum(r[1] > 1 for r in got.values()) > 10
    odd = sorted(map(tuple, periodic.periodic_runs(odd_docs).collect()), key=str)
    short = [r for r in odd_docs.collect() if r.doc_id != 11]
    assert [r for r in odd if r[0] != 11] == sorted((brute_periodic(r.doc_id, r.text) for r in short), key=str)
    assert [r[1:6] for r in odd if r[0] == 11] == [(1, 0, 30000, 1, 30000000)]
    assert periodic.periodic_runs(no_docs).count() == 0


def test_extensions_equal_counting():
    assert all({(i + periodic.SHIFT[i, j]) % 31, (j + periodic.SHIFT[i, j]) % 31} <= set(periodic.COVER) for i in range(31) for j in range(31))
    rng = np.random.default_rng(13)
    for size in (1, 30, 31, 32, 500):
        words = np.tile(rng.integers(1, 3, max(1, size // 3)), 4)[:size]
        laid = np.concatenate([words, np.zeros(32, np.int64)])
        i, j = (x.ravel() for x in np.meshgrid(np.arange(size), np.arange(size)))
        i, j = i[i < j], j[i < j]
        want = [next((t for t in range(size) if y + t >= size or words[x + t] != words[y + t]), size) for x, y in zip(i, j)]
        assert periodic.Extensions(laid, np.zeros(len(laid), np.int64))(i, j).tolist() == want


def brute_prints(rows, rarest, commonest):
    texts = {k: t or "" for k, t in rows}
    between = re.compile("[\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    terms = lambda t: {x for x in between.split(t.lower()) if x}
    df = Counter(x for t in texts.values() for x in terms(t))
    lexicon = {x for x, n in df.items() if n * rarest >= len(texts) and n * commonest <= len(texts)}
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()

    def parts(t):
        kept = sorted(terms(t) & lexicon, key=lambda x: x.encode())
        if len(kept) < 4:
            kept = sorted(terms(t), key=lambda x: x.encode())
        subsets = [[x for x in kept if int(md5(x)[:15], 16) % p == 0] for p in imatch.SUBSETS]
        return [md5(" ".join(kept) if kept else t)[:16], *(md5(" ".join(s))[:8] if s else "" for s in subsets)]

    def like(a, b):
        return sum(x == y != "" for x, y in zip(a, b)) / sum(x != "" or y != "" for x, y in zip(a, b))

    order, out = sorted(texts, reverse=True), {}
    for i, k in enumerate(order):
        t, follow = texts[k], texts[order[(i + 1) % len(order)]]
        edited = t[: len(t) - len(t) // 2] + follow[: len(t) // 2]
        a, b, c = parts(t), parts(edited), parts(follow)
        out[k] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), "-".join(a), "-".join(b), like(a, b), like(a, c))
    return out


def test_fingerprints_equal_brute_force(spark, odd_docs, no_docs):
    rng = np.random.default_rng(14)
    rows = [(int(i), " ".join(f"T{k}é" for k in rng.zipf(1.2, int(rng.integers(0, 90))) % 700)) for i in rng.permutation(150)]
    rows += [(500, None), (501, ""), (502, " \n"), (503, rows[0][1]), (504, "日本 x, Y"), (505, "a" * 5000)]
    got = {r[0]: tuple(r)[1:] for r in imatch.fingerprint_report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    want = brute_prints(rows, imatch.RAREST, imatch.COMMONEST)
    assert set(got) == set(want) and all(got[k][:4] == want[k][:4] and got[k][4:] == pytest.approx(want[k][4:]) for k in want)
    assert got[503][2] == got[rows[0][0]][2] and got[501][2] == got[500][2] != got[502][2]
    odd = imatch.fingerprint_report(odd_docs).collect()
    by = defaultdict(set)
    for r in odd:
        by[r.doc_id].add(tuple(r))
    # rows that repeat id and text are one document; the last in order, without id, is followed by the first
    assert len(odd) == 13 and all(len(v) == 1 for v in by.values()) and all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in odd)
    text = {r.doc_id: r.text or "" for r in odd_docs.collect()}
    last = next(iter(by[None]))
    assert last[2] == hashlib.sha256((text[None][:6] + text[11][:6]).encode()).hexdigest()
    assert imatch.fingerprint_report(no_docs).count() == 0


def test_likeness_falls_with_the_difference(spark):
    words = [f"word{k}" for k in range(200)]
    rows = [(i, " ".join(words[: 200 - 20 * i] + [f"own{i}x{k}" for k in range(20 * i)])) for i in range(11)]
    # ids descend from the copy with no change; each is compared with the one that has 20 words more changed
    docs = spark.createDataFrame([(100, rows[0][1]), (99, rows[0][1]), (98, rows[1][1]), (97, rows[9][1]), (96, "something else")], "doc_id bigint, text string")
    near = {r.doc_id: r.near_next for r in imatch.fingerprint_report(docs).collect()}
    assert near[100] == 1 and 0.2 < near[99] < 1 and near[98] < 0.5 * near[99] and near[97] == 0
