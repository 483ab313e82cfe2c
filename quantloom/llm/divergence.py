"""Quality rules by distribution divergence.

A document is compared with references of its language: the shares of its character classes, and the shares of the
language's most common words among its words. The measure is the Jensen-Shannon distance (base 2, 0 to 1). Short texts
are noisy, so each comparison needs a minimum length. The references are sums over all documents of a language, so one
odd document hardly moves them. All of it is DataFrame expressions: one pass makes the references, a second one judges
each row by itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantloom.llm.common import SPACE, SPACE_CHARS, whole, words
from quantloom.sources.stage import stage

# counted character classes, as the inside of a pattern
MARKS = {"upper": "A-Z", "digit": "0-9", "symbol": "#*$%&|<>", "punctuation": ".,;:!?'\"()-"}
CLASSES = ("space", "upper", "digit", "symbol", "punctuation", "beyond", "lower")


@dataclass(frozen=True)
class Limits:
    min_words: int = 20  # base rule
    repeat_percent: int = 30  # base rule
    n_common: int = 24
    char_guard: int = 200  # characters below which classes are not compared
    word_guard: int = 60  # words below which common words are not compared
    char_distance: float = 0.34
    word_distance: float = 0.42


def _with_classes(rows: DataFrame) -> DataFrame:
    """Add n_chars, word_chars, n_symbols and ``classes``, the counts in the order of CLASSES, to rows with t.

    White space and lower case are cut out first, so that the other classes are counted on the little that is left.
    """
    rows = rows.withColumns({
        "n_chars": F.length("t"), "marks": F.regexp_replace("t", r"[a-z\x20\x09-\x0D]+", ""),
        "word_chars": F.length(F.regexp_replace("t", SPACE, "")).cast("long"),
    })
    count = {k: F.length("marks") - F.length(F.regexp_replace("marks", f"[{chars}]+", "")) for k, chars in MARKS.items()}
    rows = rows.withColumns({f"n_{k}": c.cast("long") for k, c in count.items()})
    spaces, known = F.col("n_chars") - F.col("word_chars"), sum((F.col(f"n_{k}") for k in MARKS), F.lit(0))
    parts = {f"n_{k}": F.col(f"n_{k}") for k in MARKS}
    parts |= {"n_space": spaces, "n_beyond": F.length("marks") - known, "n_lower": F.col("n_chars") - spaces - F.length("marks")}
    classes = F.array(*[parts[f"n_{k}"].cast("double") for k in CLASSES])
    return rows.withColumn("classes", classes).withColumnRenamed("n_symbol", "n_symbols").drop("marks", *[f"n_{k}" for k in MARKS if k != "symbol"])


def _shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.transform(counts, lambda x: F.when(total > 0, x / total).otherwise(0.0))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares, in base 2."""

    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(F.lit(2.0) * x / (x + y))).otherwise(0.0)

    terms = F.zip_with(p, q, lambda x, y: part(x, y) + part(y, x))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2))


def references(docs: DataFrame, text: str = "text", lang: str = "lang", limits: Limits = Limits()) -> DataFrame:
    """Rows (r_lang, char_shares, common, word_shares): one for each language, over all its documents.

    ``common`` holds the most frequent words, ties in the order of the words; ``word_shares`` their shares and the rest's.
    """
    rows = docs.select(F.col(lang).cast("string").alias("lang"), whole(text).alias("t"))
    sums = [F.sum(F.col("classes")[i]) for i in range(len(CLASSES))]
    chars = _with_classes(rows).groupBy("lang").agg(F.array(*sums).alias("sums"))
    chars = chars.select("lang", _shares(F.col("sums")).alias("char_shares"))
    each = rows.select("lang", F.explode(words(F.col("t"))).alias("w")).select("lang", F.lower("w").alias("w"))
    counts = stage(each.groupBy("lang", "w").agg(F.count(F.lit(1)).alias("n")), "language-words")
    total = counts.groupBy(F.col("lang").alias("t_lang")).agg(F.sum("n").cast("double").alias("total"))
    chars = chars.join(total, F.col("lang").eqNullSafe(F.col("t_lang")), "left").select("lang", "char_shares", F.coalesce("total", F.lit(0.0)).alias("total"))
    # the limit on the rank keeps a few words of each task before anything is dealt out
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "w")
    top = counts.withColumn("k", F.row_number().over(order)).where(F.col("k") <= limits.n_common)
    top = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("k", "w", "n"))).alias("top"))
    top = top.withColumnRenamed("lang", "w_lang")
    out = chars.join(top, F.col("lang").eqNullSafe(F.col("w_lang")), "left")
    found = F.coalesce(F.transform(F.col("top.n"), lambda x: x.cast("double")), F.array().cast("array<double>"))
    out = out.select("lang", "char_shares", "total", F.coalesce("top.w", F.array().cast("array<string>")).alias("common"), found.alias("found"))
    rest = F.col("total") - F.aggregate("found", F.lit(0.0), lambda a, x: a + x)
    return out.select(F.col("lang").alias("r_lang"), "char_shares", "common", _shares(F.concat("found", F.array(rest))).alias("word_shares"))


def _with_repeats(rows: DataFrame) -> DataFrame:
    """Add n_repeat_words to rows with w8: the size of the union of the windows of 8 whose hash occurs twice.

    Only texts that repeat a window get their hashes sorted with their positions. Each step is a column of its own, so
    that it is worked out once.
    """
    empty = F.array().cast("array<struct<h:bigint,i:int>>")
    pairs = F.sort_array(F.transform("w8", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("pairs", F.when(F.size(F.array_distinct("w8")) < F.size("w8"), pairs).otherwise(empty)).drop("w8")
    # a pair is repeated if it equals its neighbour on either side
    follows = F.zip_with("pairs", F.slice("pairs", F.lit(2), F.size("pairs")), lambda a, b: a["h"].eqNullSafe(b["h"]))
    rows = rows.withColumn("same", follows)
    either = F.zip_with("same", F.concat(F.array(F.lit(False)), "same"), lambda x, y: F.coalesce(x, F.lit(False)) | y)
    marked = F.zip_with("pairs", F.slice(either, F.lit(1), F.size("pairs")), lambda p, m: F.when(m, p["i"]))
    rows = rows.withColumn("places", F.sort_array(F.array_compact(marked))).drop("pairs", "same")
    gaps = F.zip_with("places", F.slice("places", F.lit(2), F.size("places")), lambda a, b: F.least(F.lit(8), F.coalesce(b - a, F.lit(8))))
    return rows.withColumn("n_repeat_words", F.aggregate(gaps, F.lit(0), lambda a, x: a + x).cast("long")).drop("places")


def _with_windows(rows: DataFrame) -> DataFrame:
    """Add w8, a hash of each run of 8 words, doubling the run in three steps; empty where no run of 4 occurs twice."""
    rows = rows.withColumn("w1", F.transform("words", lambda w: F.xxhash64(w)))
    for have, name, into in ((1, "w1", "w2"), (2, "w2", "w4"), (4, "w4", "w8")):
        n = F.greatest(F.lit(0), F.size(name) - have)
        joined = F.zip_with(F.slice(F.col(name), F.lit(1), n), F.slice(F.col(name), F.lit(have + 1), n), lambda a, b: F.xxhash64(a, b))
        if into == "w8":
            joined = F.when(F.size(F.array_distinct(name)) < F.size(name), joined).otherwise(F.array().cast("array<bigint>"))
        rows = rows.withColumn(into, joined).drop(name)
    return rows


def judged(docs: DataFrame, reference: DataFrame, text: str = "text", lang: str = "lang", limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` as struct ``row``, with the base counts, both distances and the verdict.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed; char_js and word_js, null where the text is
    too short or its language has no reference; kept: the base rules and every distance that there is are met. Null text
    has no words. Repeated rows are judged alike; an empty table gives no rows; other columns stay in ``row``.
    """
    # a row for each language: the caller's table of references, not one that grows with documents
    small = F.broadcast(reference)
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), whole(text).alias("t"), F.col(lang).cast("string").alias("d_lang"))
    rows = rows.join(small, F.col("d_lang").eqNullSafe(F.col("r_lang")), "left").withColumn("words", words(F.col("t")))
    lines = F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    rows = _with_classes(rows.withColumn("lines", lines)).withColumns({
        "n_words": F.size("words").cast("long"), "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "lower": F.transform("words", lambda w: F.xxhash64(F.lower(w))), "common": F.transform("common", lambda w: F.xxhash64(w)),
    }).drop("t", "lines")
    rows = _with_repeats(_with_windows(rows).drop("words"))
    common = [(F.size("lower") - F.size(F.array_remove("lower", F.get("common", F.lit(i))))).cast("double") for i in range(limits.n_common)]
    counted = F.slice(F.array(*common), F.lit(1), F.greatest(F.lit(0), F.size("word_shares") - 1))
    rows = rows.withColumn("counted", counted).drop("lower")
    rest = F.col("n_words") - F.aggregate("counted", F.lit(0.0), lambda a, x: a + x)
    rows = rows.withColumn("counted", F.concat("counted", F.array(rest)))
    failed = (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > limits.repeat_percent * F.col("n_words"))
    char_js = F.when((F.col("n_chars") >= limits.char_guard) & F.col("char_shares").isNotNull(), js_distance(_shares(F.col("classes")), F.col("char_shares")))
    word_js = F.when((F.col("n_words") >= limits.word_guard) & F.col("word_shares").isNotNull(), js_distance(_shares(F.col("counted")), F.col("word_shares")))
    rows = rows.select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        char_js.alias("char_js"), word_js.alias("word_js"),
    )
    far = (F.coalesce("char_js", F.lit(0.0)) > limits.char_distance) | (F.coalesce("word_js", F.lit(0.0)) > limits.word_distance)
    return rows.withColumn("kept", ~F.col("base_failed") & ~far)


def fit_references(docs: DataFrame, text: str = "text", lang: str = "lang", limits: Limits = Limits()) -> DataFrame:
    """``references``, stored: the table of references of a corpus."""
    return stage(references(docs, text, lang, limits), "language-references")


def keep_good(docs: DataFrame, reference: DataFrame, text: str = "text", lang: str = "lang", limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that ``judged`` keeps, columns as they are."""
    # stored before the filter: over the chain of columns the optimizer would work out constraints for minutes
    return stage(judged(docs, reference, text, lang, limits).select("row", "kept"), "quality").where("kept").select("row.*")
