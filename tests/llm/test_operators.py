"""Each operator against a brute-force version on small odd tables, and on an empty one."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quantloom.llm import divergence, mixing, odd_sketch, packing, refine, snapshots, token_counts, token_store, url_rules, winnow
from quantloom.llm.bpe import Encoder
from quantloom.sources.stage import stage_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def ids():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def crc(x):
    return zlib.crc32(np.array(x, dtype="<u4"))


def test_packing_covers_every_token(odd_docs, ids):
    rows = packing.pack(odd_docs, PATH, window=64).collect()
    docs, seen = defaultdict(list), defaultdict(list)
    for r in odd_docs.collect():
        docs[r.doc_id].append([*ids(r.text), 1])
    for r in rows:
        seen[r.sequence_id].append((r.offset, r.length))
        assert any(crc(d[r.start : r.start + r.length]) == r.ids_crc32 and len(d) == r.doc_tokens for d in docs[r.doc_id])
    assert Counter(r.doc_id for r in rows for _ in range(r.length)) == Counter(k for k, v in docs.items() for d in v for _ in d)
    fill = []
    for k in sorted(seen):
        at = 0
        for o, n in sorted(seen[k]):
            assert o == at
            at += n
        fill.append(at)
    assert sorted(seen) == list(range(len(fill))) and all(x == 64 for x in fill[:-1]) and 0 < fill[-1] <= 64


def test_packing_holds_the_mixture_in_every_window():
    totals = np.array([5000, 300, 17, 1])
    plan = packing.Schedule(totals, totals, 100)
    after = plan.after(np.arange(-1, -(-totals.sum() // 100)))
    given = np.diff(after, axis=0)
    assert (given >= 0).all() and (after[-1] == totals).all() and (given[:-1].sum(axis=1) == 100).all()
    assert (abs(given[:-1] - 100 * totals / totals.sum()) <= 1.5).all()
    heavy = packing.Schedule(np.array([100, 1000]), np.array([1.0, 1.0]), 10)
    assert (heavy.after(np.arange(5))[:, 0] == [5, 10, 15, 20, 25]).all()


def turns(totals, weights, window):
    """Sequential round-robin: the queue whose next token is due first is served, until all are empty."""
    given, at, out = [0] * len(totals), 0, []
    while sum(given) < sum(totals):
        taken = [0] * len(totals)
        while sum(taken) < window and sum(given) < sum(totals):
            s = min((k for k in range(len(totals)) if given[k] < totals[k]), key=lambda k: ((given[k] + 0.5) / weights[k], k))
            given[s] += 1
            taken[s] += 1
        out += [(s, given[s] - n, n, at, sum(taken[:s])) for s, n in enumerate(taken) if n]
        at += 1
    return sorted(out)


def test_schedule_equals_sequential_turns():
    rng = np.random.default_rng(2)
    for _ in range(60):
        size, window = int(rng.integers(1, 12)), int(rng.integers(3, 60))
        totals = rng.integers(1, 300, size)
        weights = totals if rng.random() < 0.4 else rng.integers(1, 9, size)
        plan = packing.Rounds(totals, weights.astype(float), window)
        row, begin, length, at, offset = plan.cut(np.arange(size), np.zeros(size, np.int64), totals)
        assert sorted(zip(row.tolist(), begin.tolist(), length.tolist(), at.tolist(), offset.tolist())) == turns(totals.tolist(), weights.tolist(), window)
        # deficits: what a queue is owed stays under one token while it and the others last
        plan = packing.Schedule(totals, totals.astype(float), window)
        owed = plan.after(np.arange(totals.sum() // window)) - (np.arange(totals.sum() // window)[:, None] + 1) * window * totals / totals.sum()
        assert (abs(owed) <= 1).all()


def test_thousands_of_sources_fill_every_window():
    import tracemalloc

    rng = np.random.default_rng(4)
    totals = rng.integers(1, 400, 3000)
    plan = packing.Rounds(totals, totals.astype(float), 512)
    tracemalloc.start()
    row, begin, length, at, offset = plan.cut(np.arange(3000), np.zeros(3000, np.int64), totals)
    assert tracemalloc.get_traced_memory()[1] < 300e6
    tracemalloc.stop()
    assert len(plan.levels) == 2 and (np.bincount(row, length) == totals).all()
    fill = np.bincount(at, length)
    assert (fill[:-1] == 512).all() and fill.sum() == totals.sum()
    order = np.lexsort((offset, at))
    ends = offset + length
    assert (offset[order][1:] == np.where(at[order][1:] == at[order][:-1], ends[order][:-1], 0)).all()
    # the groups' shares in every window
    taken = np.zeros((len(fill), 47))
    np.add.at(taken, (at, row // 64), length)
    share = np.add.reduceat(totals, np.arange(0, 3000, 64)) / totals.sum()
    assert (abs(taken[:-1] - 512 * share) <= 1.5).all()


def test_token_store_round_trip(spark, odd_docs, ids):
    out = f"{stage_folder(spark)}/store-test-{id(odd_docs)}"
    token_store.write_store(odd_docs, PATH, out, partitions=3, shard_ids=50)
    got = sorted(token_store.read_documents(spark, out).collect(), key=lambda r: r.start)
    rows = sorted(odd_docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    at, want = 0, []
    for r in rows:
        d = [*ids(r.text), 0]
        want.append((r.doc_id, at, len(d), crc(d)))
        at += len(d)
    assert [tuple(r) for r in got] == want
    asked = spark.createDataFrame([(5,), (8,), (77,), (5,), (None,)], "k bigint")
    found = sorted(token_store.look_up(spark, out, asked, "k").collect(), key=lambda r: r.start)
    assert [(r.k, r.start, r.ids) for r in found] == [(r.doc_id, w[1], [*ids(r.text), 0]) for r, w in zip(rows, want) if r.doc_id in (5, 8)]


def test_perfect_hash_is_minimal_and_refuses_strangers():
    keys = token_store.hash_keys([str(i) for i in range(5000)])
    ph = token_store.PerfectHash.load(token_store.PerfectHash.build(keys).dump())
    assert sorted(ph.slot(keys)) == list(range(5000))


def test_token_counts_equal_the_library(odd_docs, ids):
    texts = {r.doc_id: r.text for r in odd_docs.collect()}
    for table in (None, {}):
        got = token_counts.count_tokens(odd_docs, PATH, table=table).collect()
        assert len(got) == 13
        for r in got:
            assert (r.n_tokens, r.n_bytes) == (len(ids(texts[r.doc_id])), len((texts[r.doc_id] or "").encode()))
            assert r.over_limit == (r.n_tokens > 512)


def test_long_pre_tokens_are_counted_and_not_kept(spark, ids, no_docs):
    rng = np.random.default_rng(3)
    runs = ["".join(rng.choice(list("abcdefgh"), 10_000)) for _ in range(40)]
    rows = [(i, f"short words here {runs[i % 40]}  {' ' * (i + 60)}end", "x") for i in range(120)] + [(None, "a" * 65 + " " + "b" * 64, "x"), (500, "", None), (500, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string")
    table = token_counts.frequent_pieces(docs, PATH)
    assert " words" in table and all(len(p) <= 64 for p in table)
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(docs, PATH).collect())
    assert got == Counter((i, len((t or "").encode()), len(ids(t))) for i, t, _ in rows)
    code = Encoder(PATH)
    assert [code.count(t or "") for _, t, _ in rows] == [len(ids(t)) for _, t, _ in rows]
    assert " words" in code.length_of and max(map(len, code.length_of)) <= 64
    assert token_counts.count_tokens(no_docs, PATH).collect() == []


def test_url_rules_mine_and_match(spark):
    rows = [(i, f"http://s{i % 3}.example.com/{p}/{i}?page=1") for i, p in enumerate(["de", "fr", "en", "es"] * 20)]
    rows += [(i, f"http://a.example.net/{p}/{i}") for i, p in enumerate(["de", "fr"] * 3, 100)] + [(200, None), (201, "no scheme"), (202, "HTTP://EXAMPLE.ORG")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    rules = [url_rules.ListRule("allow", "com/fr/"), url_rules.ListRule("block", "com/de/"), url_rules.ListRule("allow", "org/")]
    got = {r.page_id: r for r in url_rules.judge_urls(pages, rules, support=0.1).collect()}
    assert got[0].rule == "com/de/" and got[0].verdict == "block" and got[1].verdict == "allow" and len(got) == len(rows)
    assert got[100].rule is None and got[100].verdict == "block" and "path=de" in got[100].mined and got[101].verdict == "allow"
    assert (got[200].host, got[200].path, got[200].verdict) == ("", "", "allow") and got[201].host == "" and (got[202].host, got[202].path, got[202].rule) == ("example.org", "", None)
    assert got[2].mined is None or "label" not in got[2].mined
    # supports and confidences by counting
    tokens = pages.select(url_rules.url_tokens(F.col("url"), *url_rules.host_and_path(F.col("url"))).alias("t"), url_rules.list_rule(*url_rules.host_and_path(F.col("url")), rules)[1].alias("v"))
    marked = [(set(r.t), r.v) for r in tokens.collect() if r.v]
    for r in url_rules.mine_rules(tokens, "t", "v", 0.1, 0.8).collect():
        hit = [v for t, v in marked if set(r.tokens) <= t]
        assert r.confidence == pytest.approx(hit.count(r.label) / len(hit)) and r.support == pytest.approx(hit.count(r.label) / len(marked))


def test_quality_keeps_columns_and_rejects_repeats(odd_docs, no_docs):
    ref = divergence.fit_references(odd_docs)
    got = divergence.judged(odd_docs, ref).select("row.doc_id", "n_words", "n_repeat_words", "base_failed", "kept").collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 13 and by[1].n_words == 0 and by[1].base_failed and by[11].n_repeat_words == 30000 and not by[11].kept
    assert divergence.keep_good(odd_docs, ref).columns == odd_docs.columns
    assert divergence.keep_good(no_docs, divergence.fit_references(no_docs)).count() == 0


def test_common_words_of_any_length_are_compared(spark):
    long = [f"gemeinschaftswort{k}" for k in range(12)]
    rng = np.random.default_rng(9)
    rows = [(i, " ".join(long[k] if k < 12 else f"sonst{i}x{j}" for j, k in enumerate(rng.integers(0, 16, 120))), "de") for i in range(60)]
    rows.append((99, " ".join(f"fremd{j}" for j in range(120)), "de"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    ref = divergence.fit_references(docs)
    assert set(long) <= set(ref.first().common)
    got = {r.doc_id: r for r in divergence.judged(docs, ref).select("row.doc_id", "word_js", "kept").collect()}
    assert not got[99].kept and got[99].word_js > 0.42 and sum(r.kept for r in got.values()) == 60


def test_mixture_meets_targets(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "w " * int(rng.integers(1, 400)), [None, "a", "b", "c", ""][i % 5] if i % 3 else "a") for i in range(1500)]
    docs = spark.createDataFrame([*rows, (9999, None, "b")], "doc_id bigint, text string, source string")
    mixture = mixing.fit_mixture(docs)
    got = mixing.mixture_report(docs, mixture).collect()
    assert len(got) == 1501 and all(0 <= r.taken <= 2 * r["size"] for r in got)
    source = {r.doc_id: r.source for r in docs.collect()}
    taken, target = Counter(), {}
    for r in got:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    sizes = Counter()
    for r in got:
        sizes[source[r.doc_id]] += r["size"]
    assert target == pytest.approx(mixing.targets(sizes)) and sum(target.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert all(abs(taken[s] - target[s]) <= 0.01 * target[s] + 1 for s in target)
    again = {r.doc_id: r.taken for r in mixing.mixture_report(docs, mixing.fit_mixture(docs)).collect()}
    assert again == {r.doc_id: r.taken for r in got}
    assert mixing.mix(docs, mixture).count() == sum(r.copies for r in got)


def test_mixture_without_ids_and_with_repeated_ones(spark, odd_docs, no_docs):
    rng = np.random.default_rng(6)
    rows = [(None if i % 3 == 0 else i % 40 if i % 3 == 1 else i, f"t{i} " + "w " * int(rng.integers(1, 400)), "abc"[i % 7 % 3], "taken", 1.0) for i in range(900)]
    rows += [(5, "the same text " * 30, "a", "x", 2.0)] * 25
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, copies string, tilt double")
    got = mixing.mixture_report(docs, mixing.fit_mixture(docs)).collect()
    assert len(got) == len(rows) and all(r.copies <= 2 and r.taken <= 2 * r["size"] for r in got)
    taken, target = Counter(), {}
    for r in got:
        taken[r.source_size] += r.taken
        target[r.source_size] = r.target
    assert all(target[s] * 0.97 - 90 <= taken[s] <= target[s] * 1.0001 for s in target)
    assert mixing.mix(docs, mixing.fit_mixture(docs)).columns == docs.columns
    assert len(mixing.mixture_report(odd_docs, mixing.fit_mixture(odd_docs)).collect()) == 13
    assert mixing.mixture_report(no_docs, mixing.fit_mixture(no_docs)).count() == 0


def test_tilts_have_the_least_entropy(spark):
    """The rates before rounding, against a plain bisection of the dual in numpy."""
    rng = np.random.default_rng(8)
    rows = [(i, "w " * int(rng.integers(1, 300)), "ab"[i % 2]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    mixture = mixing.fit_mixture(docs)
    for s in mixture.sources:
        size = np.array([len(t.split()) for _, t, k in rows if k == s.name], dtype=float)
        low, high = -1.0, 1.0
        for _ in range(200):
            mid = (low + high) / 2
            over = (np.minimum(2, np.exp(np.minimum(50, mid * size))) * size).sum() > s.target
            low, high = (low, mid) if over else (mid, high)
        if 0 < s.target < 2 * s.size:
            assert s.tilt / s.unit == pytest.approx(low, rel=1e-3, abs=1e-9)


def test_targets_stop_at_twice_the_size():
    got = mixing.targets({"a": 10, "b": 100, None: 1000, "c": 0})
    assert got["a"] == 20 and got["c"] == 0 and sum(got.values()) == pytest.approx(1665) and all(got[s] <= 2 * n for s, n in {"a": 10, "b": 100, None: 1000}.items())


def test_snapshots_collapse(spark):
    long = [("user", "hi"), ("assistant", "yes"), ("user", None)]
    convs = {1: long[:1], 2: long[:2], 3: long, 4: long, 5: [("user", "other")], 6: [("user", "hi"), ("assistant", "no")]}
    rows = [(c, t + (10 if c == 2 else 0), *turn) for c, turns in convs.items() for t, turn in enumerate(turns)]
    turns = spark.createDataFrame([*rows, rows[0]], "conv_id bigint, turn int, role string, text string")
    got = {r.conv_id: r for r in snapshots.collapse_and_render(turns).collect()}
    assert sorted(got) == [3, 5, 6] and got[3].copies == 2 and got[3].n_turns == 3
    assert got[3].rendered == "<|user|>\nhi\n<|end|>\n<|assistant|>\nyes\n<|end|>\n<|user|>\n\n<|end|>\n"
    assert snapshots.collapse_and_render(turns.where("false")).count() == 0


def every_place(docs, least):
    """Delete, in order, every line of a run of at least ``least`` words that starts at any earlier place too."""
    order = sorted((i, t) for i, t in docs)
    lines = {k: [(n, x, len(x.split())) for n, x in enumerate(k[1].split("\n")) if x.split()] for k in order}
    places, gone = [(k, p) for k in order for p in range(len(lines[k]))], {k: set() for k in order}
    for at, (k, p) in enumerate(places):
        for k0, p0 in places[:at]:
            n = 0
            while p + n < len(lines[k]) and p0 + n < len(lines[k0]) and lines[k][p + n][1] == lines[k0][p0 + n][1]:
                n += 1
            if n and sum(w for _, _, w in lines[k][p : p + n]) >= least:
                gone[k] |= set(range(lines[k][p][0], lines[k][p + n - 1][0] + 1))
    return {k[0]: "\n".join(x for n, x in enumerate(k[1].split("\n")) if n not in gone[k]) for k in order}


def test_winnow_equals_brute_force(spark, odd_docs, no_docs):
    rng = np.random.default_rng(3)
    pool = [" ".join(f"t{rng.integers(1000)}" for _ in range(int(rng.integers(1, 30)))) for _ in range(30)] + ["", " "]
    rows = [(i, "\n".join(pool[int(x)] for x in (list(range(s, s + 6)) if i % 2 else rng.integers(0, 32, 7)))) for i, s in enumerate(rng.integers(0, 25, 60))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = every_place(rows, 20)
    got = winnow.dedup_lines(docs, min_words=20, report=True).collect()
    assert {r.doc_id: r.text for r in got} == want and sum(r.lines_removed > 0 for r in got) > 5
    out = winnow.dedup_lines(odd_docs)
    by = {r.doc_id: r.text for r in out.collect()}
    assert out.columns == odd_docs.columns and out.count() == 13 and by[5] == "" and by[1] is None and by[6] == "intro words here\nend of it"
    assert winnow.dedup_lines(no_docs).count() == 0


def test_exact_duplicates(odd_docs, no_docs):
    groups = defaultdict(list)
    for r in odd_docs.collect():
        groups[r.text or ""].append(r.doc_id)
    got = refine.exact_duplicates(odd_docs.withColumn("sha", F.sha2(F.coalesce("text", F.lit("")), 256)), carry=["sha"]).collect()
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in groups.items()}
    assert len(got) == 13
    for r in got:
        ids = by_sha[r.sha]
        assert r.group_size == len(ids) and r.keep_id == max((i for i in ids if i is not None), default=None) and r.kept == (r.doc_id == r.keep_id)
    assert refine.exact_duplicates(no_docs).count() == 0


def brute_near(docs):
    sets = {}
    for i, t in docs:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    part = {i: i for i in sets}

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                part[b] = a
    return {i: (len(sets[i]), root(i)) for i in sets}


def test_near_duplicates_equal_brute_force(spark, odd_docs, no_docs):
    rng = np.random.default_rng(5)
    base = [[f"v{x}" for x in rng.integers(0, 3000, 120)] for _ in range(4)]
    rows = []
    for i in range(160):
        w = list(base[i % 4])
        for _ in range(int(rng.integers(0, 7))):  # similarities on both sides of the limit
            w[int(rng.integers(0, len(w)))] = f"n{rng.integers(10**6)}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in odd_sketch.near_duplicates(docs).collect()}
    assert got == brute_near(rows)
    few = odd_sketch.near_duplicates(odd_docs).collect()
    want = brute_near([(r.doc_id, r.text) for r in odd_docs.where("doc_id is not null").collect()])
    assert len(few) == 13 and {r.doc_id: (r.n_shingles, r.component_id) for r in few if r.doc_id is not None} == want
    assert odd_sketch.keep_one_each(odd_docs).columns == odd_docs.columns and odd_sketch.near_duplicates(no_docs).count() == 0


def test_small_pairs_at_the_limit_are_linked(spark):
    rows, want = [], {}
    for common, union in ((6, 8), (9, 12), (12, 16), (13, 17), (15, 20), (16, 21), (30, 40), (38, 50), (75, 100), (150, 200), (300, 400), (14, 19), (74, 99)):
        for k in range(60):
            i, rest = len(rows), union - common
            shared = " ".join(f"c{i}x{n}" for n in range(common + 4))
            for d, own in ((i, rest // 2), (i + 1, rest - rest // 2)):
                rows.append((d, " ".join([f"d{d}x{n}" for n in range(own)] + [shared])))
                want[d] = (common + own, i if 100 * common >= 75 * union else d)
    assert brute_near(rows[:300]) == {i: want[i] for i in range(300)}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in odd_sketch.near_duplicates(docs).collect()} == want


def test_winnow_compares_every_earlier_place(spark):
    rng = np.random.default_rng(7)
    word = lambda name, n: " ".join(f"{name}{j}" for j in range(n))
    head, tail = word("x", 60), word("y", 30)
    rows = [(1, head), (2, f"{head}\n{tail}"), (3, f"{head}\n\n{tail}\nown end"), (4, f"{tail}\n{head}"), (5, f"{tail}\n{head}\n\n{word('z', 55)}"), (6, f"{head}\n\n{word('z', 55)}")]
    got = {r.doc_id: r.text for r in winnow.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == every_place(rows, 50) and got[3] == "own end" and got[2] == tail and got[6] == ""
    pool = [word(f"p{i}w", int(n)) for i, n in enumerate(rng.integers(1, 30, 9))] + [""]
    rows = [(i, "\n".join(pool[int(x)] for x in rng.integers(0, len(pool), 9))) for i in range(70)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id: r.text for r in winnow.dedup_lines(docs, min_words=20).collect()} == every_place(rows, 20)


def test_winnow_fingerprints_are_fewer_than_windows(spark):
    word = lambda name, n: " ".join(f"{name}{j}" for j in range(n))
    rows = [(i, "\n".join(word(f"d{i}l{k}", 5) for k in range(60))) for i in range(40)] + [(99, "\n".join(word(f"d3l{k}", 5) for k in range(20, 45)))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    lines = winnow.line_table(docs)
    prints, windows = winnow.fingerprints(lines).count(), 40 * 51 + 16
    assert 0 < prints < windows / 3
    got = {r.doc_id: r.lines_removed for r in winnow.dedup_lines(docs, report=True).collect()}
    assert {k for k, n in got.items() if n} == {99} and got[99] == 25
    # two places of one document; one that overlaps itself
    same = [(1, "\n".join([word("a", 30)] * 3)), (2, f"{word('b', 50)}\nx\n\n{word('b', 50)}\ny")]
    assert {r.doc_id: r.text for r in winnow.dedup_lines(spark.createDataFrame(same, "doc_id bigint, text string")).collect()} == every_place(same, 50) == {1: word("a", 30), 2: f"{word('b', 50)}\nx\n\ny"}


def test_printable_pre_tokens_need_no_table():
    code = Encoder(PATH)
    pieces = [chr(c) for c in range(256)] + [" " + chr(c) * 2 for c in range(256)] + ["   ", "\t ", " naïve", " Unglichber", "#$%" * 30]
    assert [code._piece(p) for p in pieces] == [code.library_ids(p) for p in pieces]
    assert [code._piece_bytes(p) for p in pieces] == [np.array(code.library_ids(p), dtype=code.kind).tobytes() for p in pieces]
    code.table = None
    assert code._piece(" Unglichber") == code.library_ids(" Unglichber")


def test_reading_a_store_shuffles_no_payload(spark, odd_docs, tmp_path):
    token_store.write_store(odd_docs, PATH, str(tmp_path / "store"), partitions=3, shard_ids=2000)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = token_store.read_documents(spark, str(tmp_path / "store"))
        plan = rows._jdf.queryExecution().executedPlan().toString()
        starts = [(r.start, r.n_tokens) for r in rows.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    starts.sort()
    assert len(starts) == 13 and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
