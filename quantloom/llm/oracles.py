"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from quantloom.llm.divergence import CLASSES, MARKS, Limits
from quantloom.llm.imatch import BETWEEN, COMMONEST, FEWEST, RAREST, SUBSETS
from quantloom.llm.url_rules import LOWER, UPPER

WORDS = r"regexp_extract_all({t}, '[^\x20\x09-\x0D]+')"

EXACT = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

SNAPSHOTS = """
WITH t AS (SELECT conv_id, CASE WHEN conv_id IS NOT NULL THEN turn END AS turn, role, text, CASE WHEN conv_id IS NULL THEN {'r': role, 't': text} END AS own
      FROM conversations GROUP BY ALL),
c AS (SELECT conv_id, own, list({'r': role, 't': text} ORDER BY turn) AS turns,
             string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || chr(10) || '<|end|>' || chr(10), '' ORDER BY turn) AS rendered
      FROM t GROUP BY conv_id, own),
u AS (SELECT turns, min(conv_id) AS conv_id, count(*) AS copies, any_value(rendered) AS rendered FROM c GROUP BY turns),
p AS (SELECT DISTINCT turns[1:k] AS turns FROM (SELECT turns, unnest(range(1, len(turns))) AS k FROM u))
SELECT u.conv_id, len(u.turns)::BIGINT AS n_turns, u.copies, u.rendered FROM u ANTI JOIN p ON u.turns = p.turns
"""

NEAR = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {WORDS.format(t=f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
k AS (SELECT doc_id, hash(g) AS g FROM s),
c AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM k a JOIN k b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT u, v FROM c JOIN n nu ON nu.doc_id = u JOIN n nv ON nv.doc_id = v WHERE 100 * c >= 75 * (nu.n + nv.n - c)),
sym AS (SELECT u, v FROM e UNION ALL SELECT v, u FROM e),
reach AS (SELECT u, v FROM sym UNION SELECT r.u, b.v FROM reach r JOIN sym b ON r.v = b.u),
m AS (SELECT u, least(u, min(v)) AS c FROM reach GROUP BY u)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.c, w.doc_id) AS component_id, coalesce(m.c, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN m ON m.u = w.doc_id
"""


def _count(chars: str) -> str:
    inside = chars.replace("'", "''")
    return f"(length(t) - length(regexp_replace(t, '[{inside}]', '', 'g')))"


def _quality(limits: Limits = Limits()) -> str:
    spaces = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    counts = {"space": f"(length(t) - length(translate(t, {spaces}, '')))", "lower": _count("a-z")} | {k: _count(c) for k, c in MARKS.items()}
    known = " - ".join(counts.values())
    counts["beyond"] = f"(length(t) - {known})"
    classes = ", ".join(f"{counts[c]}::DOUBLE" for c in CLASSES)
    js = """sqrt(greatest(0, list_sum(list_transform(range(1, len({p}) + 1), lambda i:
      (CASE WHEN {p}[i] > 0 THEN {p}[i] * log2(2 * {p}[i] / ({p}[i] + {q}[i])) ELSE 0 END)
      + (CASE WHEN {q}[i] > 0 THEN {q}[i] * log2(2 * {q}[i] / ({p}[i] + {q}[i])) ELSE 0 END))) / 2))"""
    share = "list_transform({c}, lambda x: CASE WHEN list_sum({c}) > 0 THEN x / list_sum({c}) ELSE 0 END)"
    return f"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
b AS (SELECT doc_id, lang, t, {WORDS.format(t="t")} AS w, [{classes}] AS cls,
             list_filter(string_split(t, chr(10)), lambda x: length(trim(x, {spaces})) > 0) AS lines FROM d),
wl AS (SELECT doc_id, lang, unnest(w) AS w0 FROM b),
wn AS (SELECT doc_id, lang, lower(w0) AS w FROM wl),
wc AS (SELECT lang, w, count(*) AS n FROM wn GROUP BY 1, 2),
top AS (SELECT * FROM (SELECT lang, w, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, w) AS k FROM wc) WHERE k <= {limits.n_common}),
topl AS (SELECT lang, list(w ORDER BY k) AS common, list(n::DOUBLE ORDER BY k) AS cn FROM top GROUP BY lang),
tot AS (SELECT lang, sum(len(w))::DOUBLE AS total FROM b GROUP BY lang),
ch AS (SELECT lang, list_transform(range(1, {len(CLASSES) + 1}), lambda i: 0) AS z, [{", ".join(f"sum(cls[{i + 1}])" for i in range(len(CLASSES)))}] AS csum FROM b GROUP BY lang),
ref AS (SELECT ch.lang AS rl, {share.format(c="csum")} AS cq, common, list_append(coalesce(cn, []), total - coalesce(list_sum(cn), 0)) AS wsum
        FROM ch LEFT JOIN tot ON ch.lang IS NOT DISTINCT FROM tot.lang LEFT JOIN topl ON ch.lang IS NOT DISTINCT FROM topl.lang),
hit AS (SELECT doc_id, k, count(*)::DOUBLE AS n FROM wn JOIN top ON wn.lang IS NOT DISTINCT FROM top.lang AND wn.w = top.w GROUP BY 1, 2),
hl AS (SELECT doc_id, map_from_entries(list({{'k': k, 'v': n}})) AS h FROM hit GROUP BY 1),
g AS (SELECT doc_id, i, hash(w[i:i + 7]) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM b WHERE len(w) >= 8)),
rep AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, h) > 1),
cov AS (SELECT doc_id, count(DISTINCT i + j)::BIGINT AS n FROM rep, range(0, 8) r(j) GROUP BY doc_id),
x AS (SELECT b.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, {_count(MARKS["symbol"])}::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
             length(t) AS n_chars, {share.format(c="cls")} AS cp, cq,
             list_transform(range(1, len(common) + 1), lambda i: coalesce(element_at(h, i::BIGINT)[1], 0)) AS cnt, len(w) AS nw, wsum
      FROM b LEFT JOIN ref ON b.lang IS NOT DISTINCT FROM ref.rl LEFT JOIN hl ON hl.doc_id = b.doc_id LEFT JOIN cov ON cov.doc_id = b.doc_id),
y AS (SELECT *, list_append(cnt, nw - coalesce(list_sum(cnt), 0)) AS wp0 FROM x),
z AS (SELECT *, {share.format(c="wp0")} AS wp, {share.format(c="wsum")} AS wq FROM y),
j AS (SELECT *, n_words < {limits.min_words} OR 100 * n_repeat_words > {limits.repeat_percent} * n_words AS base_failed,
             CASE WHEN n_chars >= {limits.char_guard} THEN {js.format(p="cp", q="cq")} END AS c0,
             CASE WHEN n_words >= {limits.word_guard} THEN {js.format(p="wp", q="wq")} END AS w0 FROM z)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(c0, 0) <= {limits.char_distance} AND coalesce(w0, 0) <= {limits.word_distance} AS kept,
       round(c0, 4) AS char_js, round(w0, 4) AS word_js FROM j
"""


def _fingerprints() -> str:
    joined = "md5(string_agg(term, ' ' ORDER BY term){f})"
    subsets = [f"coalesce(left({joined.format(f=f" FILTER (WHERE h % {p} = 0)")}, 8), '')" for p in SUBSETS]
    empty = ", ".join("''" for _ in SUBSETS)
    near = """list_sum(list_transform(range(1, len({a}) + 1), lambda i: ({a}[i] = {b}[i] AND {a}[i] <> '')::INT))::DOUBLE
      / list_sum(list_transform(range(1, len({a}) + 1), lambda i: ({a}[i] <> '' OR {b}[i] <> '')::INT))::DOUBLE"""
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
o AS (SELECT *, length(t) AS n, coalesce(lead(t) OVER w, first_value(t) OVER w) AS nt, coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS nid
      FROM d WINDOW w AS (ORDER BY doc_id DESC)),
e AS (SELECT doc_id, nid, n, t, substr(t, 1, n - n // 2) || substr(nt, 1, n // 2) AS x FROM o),
b AS (SELECT doc_id, 0 AS k, t AS s FROM e UNION ALL SELECT doc_id, 1, x FROM e),
w AS (SELECT DISTINCT doc_id, k, unnest(regexp_extract_all(lower(s), '{BETWEEN.replace("[", "[^")}')) AS term FROM b),
f AS (SELECT term FROM w WHERE k = 0 GROUP BY 1 HAVING count(*) * {RAREST} >= (SELECT count(*) FROM d) AND count(*) * {COMMONEST} <= (SELECT count(*) FROM d)),
m AS (SELECT w.*, f.term IS NOT NULL AS band FROM w LEFT JOIN f ON w.term = f.term),
c AS (SELECT *, count(*) FILTER (WHERE band) OVER (PARTITION BY doc_id, k) AS nb FROM m),
h AS (SELECT doc_id, k, term, ('0x' || left(md5(term), 15))::BIGINT AS h FROM c WHERE band OR nb < {FEWEST}),
p AS (SELECT doc_id, k, [left({joined.format(f="")}, 16), {", ".join(subsets)}] AS parts FROM h GROUP BY 1, 2),
q AS (SELECT b.doc_id, b.k, coalesce(parts, [left(md5(s), 16), {empty}]) AS parts FROM b LEFT JOIN p ON p.doc_id = b.doc_id AND p.k = b.k)
SELECT e.doc_id, n AS n_chars, sha256(x) AS edited_sha256, array_to_string(q0.parts, '-') AS fingerprint, array_to_string(q1.parts, '-') AS edited_fingerprint,
       {near.format(a="q0.parts", b="q1.parts")} AS near_edited, {near.format(a="q0.parts", b="q2.parts")} AS near_next
FROM e JOIN q q0 ON q0.doc_id = e.doc_id AND q0.k = 0 JOIN q q1 ON q1.doc_id = e.doc_id AND q1.k = 1 JOIN q q2 ON q2.doc_id = e.nid AND q2.k = 0
"""


ORACLES = {"op4_divergence": _quality(), "op6_snapshots": SNAPSHOTS, "op9_exact_dedup": EXACT, "op10_odd_sketch": NEAR, "op13_imatch": _fingerprints()}
