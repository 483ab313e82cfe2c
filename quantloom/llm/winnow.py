"""Line de-duplication by winnowing.

Lines with words are hashed. From each line starts a window, the shortest run of lines with at least ``min_words`` words;
the line with the least hash of each window is a fingerprint. Neighbouring windows mostly share theirs, so there are fewer
fingerprints than windows, yet every run of at least ``min_words`` words holds a whole window and so the same fingerprint
wherever it occurs. Fingerprints found at one place only are left out, and with them all text that occurs once.

Around the others matches are extended both ways. The lines that a match reaches are those of certain runs: the shortest
ones with enough words that start or end at each line, and hold a fingerprint found at several places. Take the smallest
part of a repeated run that holds a line and enough words; it has the line at one end, or loses too much with either end
line, and so is such a run. The same holds for two neighbouring lines unless each has enough words alone; such two are a
run of a third kind, for the lines without words between them. Runs are compared by two hashes of all their lines, 128
bits in all. So the lines to delete are those of all runs but the first place of each, in the order of (id, line),
whichever earlier place a run repeats. A passage in n documents makes n - 1 rows for each of its runs, no pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantloom.llm.common import filter_rows, key_filter, may_be_in, whole, word_count
from quantloom.sources.stage import stage

MIN_WORDS = 50


def _lines(text: Column) -> Column:
    """Lines with words as structs of i (number of the line in the text, from 0), h and g (hashes) and w (words)."""
    numbered = F.transform(
        F.split(text, "\n"),
        lambda x, i: F.struct(i.alias("i"), F.xxhash64(x).alias("h"), F.xxhash64(F.lit(5), x).alias("g"), word_count(x).cast("int").alias("w")),
    )
    return F.filter(numbered, lambda x: x["w"] > 0)


def _minima(lines: Column, min_words: int) -> Column:
    """The least hash of each line's window, and its place: distinct structs of h and at."""

    def fold(acc: Column, x: Column, j: Column | None = None) -> Column:
        less = acc["h"].isNull() | (x["h"] < acc["h"])
        more = F.struct(
            (acc["words"] + x["w"]).alias("words"), F.when(less, x["h"]).otherwise(acc["h"]).alias("h"),
            F.when(less, acc["n"]).otherwise(acc["at"]).alias("at"), (acc["n"] + 1).alias("n"),
        )
        return F.when(acc["words"] >= min_words, acc).otherwise(more)

    start = F.struct(F.lit(0).alias("words"), F.lit(None).cast("long").alias("h"), F.lit(0).alias("at"), F.lit(0).alias("n"))

    # every line has a word, so min_words lines are enough
    def least(x: Column, p: Column) -> Column:
        run = F.aggregate(F.slice(lines, p + 1, F.lit(min_words)), start, lambda acc, y: fold(acc, y))
        return F.when(run["words"] >= min_words, F.struct(run["h"].alias("h"), (p + run["at"]).alias("at")))

    return F.array_distinct(F.filter(F.transform(lines, least), lambda f: f.isNotNull()))


def _runs(lines: Column, min_words: int) -> Column:
    """The runs that start or end at each line and hold a marked one: structs of k and m (hashes of kind and lines), a and b
    (first and last place). A run that is shortest both ways is so wherever it occurs, and is listed once."""

    def fold(acc: Column, x: Column) -> Column:
        more = F.struct(
            (acc["words"] + x["w"]).alias("words"), F.xxhash64(acc["k"], x["h"]).alias("k"), F.xxhash64(acc["m"], x["g"]).alias("m"),
            (acc["n"] + 1).alias("n"), (acc["hit"] | x["hit"]).alias("hit"),
        )
        return F.when(acc["words"] >= min_words, acc).otherwise(more)

    def start(kind: int) -> Column:
        return F.struct(F.lit(0).alias("words"), F.lit(kind).cast("long").alias("k"), F.lit(kind).cast("long").alias("m"), F.lit(0).alias("n"), F.lit(False).alias("hit"))

    def forwards(x: Column, p: Column) -> Column:
        run = F.aggregate(F.slice(lines, p + 1, F.lit(min_words)), start(0), fold)
        return F.struct(run["k"].alias("k"), run["m"].alias("m"), p.alias("a"), (p + run["n"] - 1).alias("b"), ((run["words"] >= min_words) & run["hit"]).alias("full"))

    def backwards(x: Column, p: Column) -> Column:
        before = F.least(p + 1, F.lit(min_words))
        run = F.aggregate(F.reverse(F.slice(lines, p + 2 - before, before)), start(1), fold)
        # without its last line too short: the run that starts at its first line
        full = (run["words"] >= min_words) & (run["words"] - x["w"] >= min_words) & run["hit"]
        return F.struct(run["k"].alias("k"), run["m"].alias("m"), (p - run["n"] + 1).alias("a"), p.alias("b"), full.alias("full"))

    def both(x: Column, p: Column) -> Column:
        after = F.get(lines, p + 1)
        full = (x["w"] >= min_words) & F.coalesce((after["w"] >= min_words) & (x["hit"] | after["hit"]), F.lit(False))
        return F.struct(
            F.xxhash64(F.lit(2), x["h"], after["h"]).alias("k"), F.xxhash64(F.lit(2), x["g"], after["g"]).alias("m"),
            p.alias("a"), (p + 1).alias("b"), full.alias("full"),
        )

    return F.filter(F.concat(*[F.transform(lines, kind) for kind in (forwards, backwards, both)]), lambda f: f["full"])


def _marked(lines: Column, places: Column) -> Column:
    """``lines`` with hit: whether its place is one of ``places``, which are sorted."""
    steps = F.transform(places, lambda x, i: F.concat(F.repeat(F.lit("0"), x - F.coalesce(F.get(places, i - 1), F.lit(-1)) - 1), F.lit("1")))
    marks = F.encode(F.array_join(steps, ""), "utf-8")
    return F.transform(
        lines, lambda x, p: F.struct(*[x[c].alias(c) for c in "ihgw"], (F.substring(marks, p + 1, F.lit(1)) == F.encode(F.lit("1"), "utf-8")).alias("hit"))
    )


def _likely(rows: DataFrame, col: str, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose ``col`` a bitmap of the stored keys lets through, so that the others are not dealt out for a join."""
    bits = filter_rows(keys.count())
    bitmap = stage(key_filter(keys, F.col(key), bits), "winnow-filter")
    return may_be_in(rows, F.col(col), bitmap, bits, "likely").where("likely").drop("likely")


def fingerprints(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Rows (key, h, at) of the window minima of rows (key, lines)."""
    return lines.select("key", F.explode(_minima(F.col("lines"), min_words)).alias("f")).select("key", "f.h", "f.at")


def line_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, id, lines). ``key`` is the hash of id and text; rows that repeat both are one document."""
    t = whole(text)
    return docs.select(F.xxhash64(F.lit(3), F.col(doc_id), t).alias("key"), F.col(doc_id).alias("id"), _lines(t).alias("lines"))


def repeated_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Rows (key, gone): for each text with later repeated runs the numbers of their lines."""
    rows = stage(line_table(docs, doc_id, text), "winnow-lines")
    prints = stage(fingerprints(rows, min_words), "winnow-prints")
    place = F.xxhash64("key", "at")
    several = prints.groupBy("h").agg(F.min(place).alias("one"), F.max(place).alias("other")).where("one <> other").select(F.col("h").alias("s_h"))
    # both sides are stored, so that a fingerprint with very many places is split
    several = stage(several, "winnow-several")
    hits = _likely(prints, "h", several, "s_h").join(several, F.col("h") == F.col("s_h")).groupBy("key").agg(F.collect_set("at").alias("at"))
    hits = stage(hits.select(F.col("key").alias("h_key"), F.sort_array("at").alias("at")), "winnow-hits")
    marked = _likely(rows, "key", hits, "h_key").join(hits, F.col("key") == F.col("h_key")).select("key", "id", _marked(F.col("lines"), F.col("at")).alias("lines"))
    runs = marked.select("key", "id", "lines", F.explode(_runs(F.col("lines"), min_words)).alias("f")).select(
        "key", "id", F.col("f.k").alias("k"), F.col("f.m").alias("m"), F.col("f.a").alias("at"),
        F.get("lines", F.col("f.a"))["i"].alias("a"), F.get("lines", F.col("f.b"))["i"].alias("b"),
    )
    runs = stage(runs, "winnow-runs")
    first = runs.groupBy("k", "m").agg(F.min(F.struct("id", "key", "at")).alias("first"), F.max(F.struct("id", "key", "at")).alias("last"))
    first = first.where("first <> last").select(F.col("k").alias("k0"), F.col("m").alias("m0"), F.col("first.key").alias("key0"), F.col("first.at").alias("at0"))
    later = runs.join(stage(first, "winnow-first"), (F.col("k") == F.col("k0")) & (F.col("m") == F.col("m0"))).where("key <> key0 or at <> at0")
    cuts = later.groupBy("key").agg(F.collect_set(F.struct("a", "b")).alias("cuts"))
    return cuts.select("key", F.array_distinct(F.flatten(F.transform("cuts", lambda c: F.sequence(c["a"], c["b"])))).alias("gone"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, report: bool = False) -> DataFrame:
    """``docs`` with the later repeated runs cut out of ``text``; every row stays, its other columns as they are.

    With ``report`` a column ``lines_removed`` (replacing one of that name) tells the number of deleted lines. Order is by
    id, nulls first, then by a hash of the text where rows repeat an id; a row that repeats id and text is the same
    document and is cut alike. A later place may overlap the first: of three equal lines of 30 words the first one stays.
    Null text stays null, a text all of whose lines go becomes empty. Lines without words
    count for nothing and go only inside a run. An empty table gives no rows.
    """
    gone = stage(repeated_runs(docs, doc_id, text, min_words), "winnow-gone")
    rows = filter_rows(gone.count())
    bitmap = stage(key_filter(gone, F.col("key"), rows), "winnow-filter")
    names = [c for c in docs.columns if not (report and c.lower() == "lines_removed")]
    keyed = docs.select(F.struct(*[F.col(c) for c in names]).alias("row"), F.xxhash64(F.lit(3), F.col(doc_id), whole(text)).alias("d_key"))
    keyed = may_be_in(keyed, F.col("d_key"), bitmap, rows, "touched")
    # only rows that the filter lets through are dealt out and joined
    same = keyed.where("not touched").select("row", F.lit(None).cast("array<int>").alias("gone"))
    cut = keyed.where("touched").join(gone, F.col("d_key") == F.col("key"), "left").select("row", "gone")
    out = same.union(cut)
    split = F.split(F.col(f"row.`{text}`"), "\n")
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("gone")), lambda i: F.get(split, i))
    changed = F.when(F.col("gone").isNull(), F.col(f"row.`{text}`")).otherwise(F.array_join(left, "\n"))
    columns = [changed.alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in names]
    if report:
        columns.append(F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("lines_removed"))
    return out.select(*columns)
