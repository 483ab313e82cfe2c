"""URL rules against all token combinations, and conversation logs against plain prefixes."""

import itertools
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantloom.llm import snapshots, url_rules

RULES = [url_rules.ListRule("allow", "com/fr/"), url_rules.ListRule("block", "com/de/")]


def brute_rules(labelled, support, confidence):
    """Every token combination of a labelled URL that reaches both bounds."""
    combos, least = Counter(), support * len(labelled)
    with_label = Counter()
    for tokens, label in labelled:
        for k in range(1, len(tokens) + 1):
            for c in itertools.combinations(sorted(tokens), k):
                combos[c] += 1
                with_label[c, label] += 1
    return {(c, x): (n / combos[c], n / len(labelled)) for (c, x), n in with_label.items() if n >= least and n / combos[c] >= confidence}


def test_verdicts_equal_all_combinations(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(260):
        lang = ["de", "fr", "en"][int(rng.integers(0, 3))]
        keys = ["a=1&b=2&c=3", "a=1", "q=7", ""][int(rng.integers(0, 4)) if lang != "de" else int(rng.integers(0, 2))]
        host = ["s.example.com", "t.example.com", "u.example.net"][int(rng.integers(0, 3))]
        rows.append((i if i % 9 else None, f"http://{host}/{lang}/p{int(rng.integers(0, 4))}x" + (f"?{keys}" if keys else ""), "clash", 1))
    rows += [rows[3]] * 4 + [(900, None, None, None), (901, "", "", 0), (902, "http://u.example.net/en/" + "z/" * 20000, "", 0)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, tokens string, rule int")
    host, path = url_rules.host_and_path(F.col("url"))
    plain = pages.select("page_id", "url", url_rules.url_tokens(F.col("url"), host, path).alias("t"), url_rules.list_rule(host, path, RULES)[1].alias("v")).collect()
    want_rules = brute_rules([(r.t, r.v) for r in plain if r.v], 0.05, 0.7)
    assert len(want_rules) > 50

    def best(tokens):
        fits = [(c, s, len(k), list(k), x) for (k, x), (c, s) in want_rules.items() if set(k) <= set(tokens)]
        return max(fits) if fits else None

    want = Counter()
    for r in plain:
        found = None if r.v else best(r.t)
        want[r.page_id, r.v or (found[4] if found else "allow"), " ".join(found[3]) if found else None] += 1
    got = url_rules.judge_urls(pages, RULES, support=0.05, confidence=0.7).collect()
    assert Counter((r.page_id, r.verdict, r.mined) for r in got) == want
    mined = url_rules.mine_rules(spark.createDataFrame([(r.t, r.v) for r in plain], "t array<string>, v string"), "t", "v", 0.05, 0.7).collect()
    spread = set()
    for r in mined:
        for parts in itertools.product(*[[c for k in range(1, len(g) + 1) for c in itertools.combinations(g, k)] for g in r.groups]):
            spread.add((tuple(sorted(itertools.chain(*parts))), r.label))
    assert spread == set(want_rules) and len(mined) < len(want_rules)


def test_many_tokens_of_one_site_are_one_item(spark):
    keys = "&".join(f"k{chr(97 + k // 26)}{chr(97 + k % 26)}=1" for k in range(60))
    rows = [(i, f"http://s.example.com/de/{i}?{keys}" if i < 20 else f"http://t.example.com/{['de', 'fr'][i % 2]}/x{i}") for i in range(520)]
    rows += [(600, f"http://v.example.net/?{keys}"), (601, "http://v.example.net/?kaa=2")]
    began = time.monotonic()
    got = {r.page_id: r for r in url_rules.judge_urls(spark.createDataFrame(rows, "page_id bigint, url string"), RULES, support=0.002).collect()}
    assert time.monotonic() - began < 60
    assert got[600].verdict == got[601].verdict == "block" and got[601].mined == "host=example key=kaa" and len(got[600].mined.split()) == 61


def test_no_pages_and_no_labels(spark):
    none = spark.createDataFrame([], "page_id bigint, url string")
    assert url_rules.judge_urls(none, RULES).collect() == []
    pages = spark.createDataFrame([(1, "http://a.example.net/x"), (None, None)], "page_id bigint, url string")
    assert {(r.page_id, r.verdict, r.mined) for r in url_rules.judge_urls(pages, RULES).collect()} == {(1, "allow", None), (None, "allow", None)}
    given = url_rules.judge_urls(pages, [], label=F.lit("block"), support=0.1).collect()
    assert {(r.page_id, r.verdict) for r in given} == {(1, "block"), (None, "allow")}


def brute_logs(rows):
    """Maximal conversations by comparing them as tuples."""
    convs = {}
    for c, t, role, text in {(c, t if c is not None else 0, role, text) for c, t, role, text in rows}:
        convs.setdefault((c, None) if c is not None else (None, (role, text)), []).append((t, role, text))
    told = {}
    for who, turns in convs.items():
        told.setdefault(tuple((r, x) for _, r, x in sorted(turns, key=lambda t: t[0])), []).append(who)
    inner = {t[:k] for t in told for k in range(1, len(t))}
    shown = lambda turns: "".join(f"<|{r or ''}|>\n{x or ''}\n<|end|>\n" for r, x in turns)
    return {(min((w[0] for w in who if w[0] is not None), default=None), len(t), len(who), shown(t)) for t, who in told.items() if t not in inner}


@pytest.mark.parametrize("merge", ["true", "false"])
def test_logs_equal_plain_prefixes(spark, merge):
    rng = np.random.default_rng(2)
    rows = []
    for c in range(60):
        base = [(["user", "assistant"][t % 2], f"w{c % 7}.{t}" if t % 5 else None) for t in range(int(rng.integers(1, 12)))]
        rows += [(c, t + c % 3, *turn) for t, turn in enumerate(base)]
    rows += [(1000, t, "user", f"long {t}") for t in range(3000)]  # most of all turns
    rows += [(1001, t, "user", f"long {t}") for t in range(1200)]  # a prefix of it
    rows += [(1002, t, "user", f"long {t}" if t < 1999 else "end") for t in range(2000)]
    rows += [(None, int(t), "user", f"loose {t % 40}") for t in range(400)] + [(None, 5, None, None), (None, 5, "user", "long 0"), rows[0], rows[0]]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string").withColumn("part", F.lit("x")).withColumn("who", F.lit(1))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merge)
    try:
        got = {(r.conv_id, r.n_turns, r.copies, r.rendered) for r in snapshots.collapse_and_render(turns).collect()}
        if merge == "false":
            assert snapshots.prefix_hashes(turns, "conv_id", "turn", "role", "text").where("n_turns = 3000").count() == 3000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got == brute_logs(rows)
