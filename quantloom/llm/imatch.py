"""Document fingerprints by I-Match over randomised lexicon subsets.

The lexicon holds the terms whose inverse document frequency lies in a band: common terms say little, rare ones are often
misspelt. A document's distinct terms of the lexicon are sorted and hashed, once whole and once for each of several random
subsets of the lexicon: the terms whose hash a prime divides, which is independent from prime to prime. Two documents
agree in the hash of a subset if none of the terms in which they differ belongs to it, so dense subsets tell near copies
from the rest and sparse ones texts that share a part.

A term of the lexicon is in at least ``1 / RAREST`` of all documents, so the lexicon has at most ``RAREST`` times as many
terms, and characters, as a mean document, however many documents there are. That is why it can be handed to every task.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantloom.llm.common import whole
from quantloom.sources.stage import stage

# the band: terms in at least one of RAREST and at most one of COMMONEST documents
RAREST, COMMONEST = 1000, 10
# with fewer terms of the lexicon all terms of a document count
FEWEST = 4
# primes; the subset of a prime holds one term in so many
DENSE = (2, 3, 5, 7, 11, 13, 17, 19)
MIDDLE = (101, 103, 107, 109, 113, 127, 131, 137, 139, 149, 151, 157, 163, 167, 173, 179)
SPARSE = (503, 509, 521, 523, 541, 547, 557, 563)
SUBSETS = DENSE + MIDDLE + SPARSE
NOTHING = "d41d8cd9"  # the beginning of the MD5 of an empty text
# what lies between terms: ASCII characters that are neither letters nor digits
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def terms(text: Column) -> Column:
    """Distinct terms of a text in lower case; may hold an empty one."""
    return F.array_distinct(F.split(F.lower(text), BETWEEN))


def fit_lexicon(docs: DataFrame, text: str = "text", rarest: int = RAREST, commonest: int = COMMONEST) -> list[str]:
    """Terms in at least one of ``rarest`` and at most one of ``commonest`` of all rows."""
    number = docs.count()
    seen = docs.select(F.explode(terms(whole(text))).alias("term")).where("term <> ''").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return [r.term for r in seen.where((F.col("n") * rarest >= number) & (F.col("n") * commonest <= number)).select("term").collect()]


def _buckets(lexicon: DataFrame, number: int) -> str:
    """The terms as a JSON list of lists: a term stands in the list of its hash."""
    hashed = lexicon.groupBy(F.pmod(F.xxhash64("term"), F.lit(number)).cast("int").alias("k")).agg(F.collect_list("term").alias("terms"))
    lists: list[list[str]] = [[] for _ in range(number)]
    for r in hashed.collect():
        lists[r.k] = r.terms
    return json.dumps(lists)


def _parts(kept: Column, text: Column) -> Column:
    """Hashes of sorted terms, given as structs of t (term) and h (its number): all of them, then each subset, '' if empty."""

    def joined(x: Column, digits: int) -> Column:
        return F.left(F.md5(F.array_join(F.transform(x, lambda y: y["t"]), " ")), F.lit(digits))

    everything = F.when(F.size(kept) == 0, F.left(F.md5(text), F.lit(16))).otherwise(joined(kept, 16))
    def subset(prime: int) -> Column:
        return joined(F.filter(kept, lambda y: y["h"] % prime == 0), 8)

    subsets = F.array(*[subset(p) for p in SUBSETS])
    return F.concat(F.array(everything), F.transform(subsets, lambda x: F.when(x == NOTHING, "").otherwise(x)))


def fingerprint(text: Column, buckets: str, number: int) -> Column:
    """The hashes of a text's terms; the first is never empty."""
    table = F.from_json(F.lit(buckets), "array<array<string>>")

    def in_lexicon(term: Column) -> Column:
        return F.array_contains(F.get(table, F.pmod(F.xxhash64(term), F.lit(number)).cast("int")), term)

    def kept(f: Column) -> Column:
        chosen = F.when(F.size(f["band"]) < FEWEST, F.array_remove(f["all"], "")).otherwise(f["band"])
        numbered = F.transform(F.sort_array(chosen), lambda t: F.struct(t.alias("t"), F.conv(F.left(F.md5(t), F.lit(15)), 16, 10).cast("long").alias("h")))
        return F.struct(f["text"].alias("text"), numbered.alias("kept"))

    # each step is the body of a lambda over an array of one, so that its result is worked out once
    steps = F.transform(F.array(F.struct(text.alias("text"), terms(text).alias("all"))), lambda x: F.struct(x["text"].alias("text"), x["all"].alias("all"), F.filter(x["all"], in_lexicon).alias("band")))
    return F.transform(F.transform(steps, kept), lambda x: _parts(x["kept"], x["text"]))[0]


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among those that either has."""
    pairs = F.zip_with(a, b, lambda x, y: F.struct(((x == y) & (x != "")).cast("int").alias("same"), ((x != "") | (y != "")).cast("int").alias("any")))
    return F.aggregate(pairs, F.lit(0), lambda s, p: s + p["same"]) / F.aggregate(pairs, F.lit(0), lambda s, p: s + p["any"])


def followers(keys: DataFrame) -> DataFrame:
    """Rows (kid, th, n, next_kid, next_th): the document that follows each in descending order of id, the first after the last.

    ``keys``: distinct rows (id, kid, th, n). They are dealt out by ranges; only the first row of each range meets the
    others, so one task sees one row per range.
    """
    order = [F.col("id").desc_nulls_last(), F.col("th").desc()]
    ranged = stage(keys.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "imatch-order")
    inside = Window.partitionBy("part").orderBy(*order)
    firsts = ranged.withColumn("place", F.row_number().over(inside)).where("place = 1").select("part", "kid", "th")
    along = Window.orderBy("part")
    edge = firsts.select(
        F.col("part").alias("e_part"),
        *[F.coalesce(F.lead(c).over(along), F.first(c).over(along)).alias(f"e_{c}") for c in ("kid", "th")],
    )
    ahead = ranged.select("part", "kid", "th", "n", F.lead("kid").over(inside).alias("l_kid"), F.lead("th").over(inside).alias("l_th"))
    joined = ahead.join(stage(edge, "imatch-edges"), F.col("part") == F.col("e_part"))
    return joined.select("kid", "th", "n", F.coalesce("l_kid", "e_kid").alias("next_kid"), F.coalesce("l_th", "e_th").alias("next_th"))


def fingerprint_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: n_chars, fingerprints of its text and of its edited text, and their likeness to each other and
    to the fingerprint of the next document.

    The edited text has its last half replaced by the beginning of the next document in descending order of id, nulls
    last, the first after the last. Rows that repeat an id are ordered by a hash of their texts; rows that repeat id and
    text are one document and have equal results. Null text is empty. A text without terms has the fingerprint of the
    text itself. Other columns are ignored, an empty table gives no rows.
    """
    spark, t = docs.sparkSession, whole(text)
    lexicon = fit_lexicon(docs, text)
    number = 2 * len(lexicon) + 1
    buckets = _buckets(spark.createDataFrame([(x,) for x in lexicon], "term string"), number)
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(
        F.col(doc_id).alias("id"), F.coalesce(F.concat(F.lit("="), F.col(doc_id).cast("string")), F.lit("")).alias("kid"),
        F.xxhash64(t).alias("th"), t.alias("t"),
    )
    after = stage(followers(rows.select("id", "kid", "th", F.length("t").alias("n")).distinct()), "imatch-followers")
    # read twice below, with the same columns, so that Spark shuffles the texts once
    held = rows.select("kid", "th", "t", fingerprint(F.col("t"), buckets, number).alias("fp"))
    # the next document hands over the beginning that is needed, and its fingerprint
    wanted = after.select(F.col("kid").alias("w_kid"), F.col("th").alias("w_th"), "n", "next_kid", "next_th")
    given = held.join(wanted, (F.col("kid") == F.col("next_kid")) & (F.col("th") == F.col("next_th"))).select(
        "w_kid", "w_th", "n", F.expr("substring(t, 1, cast(n div 2 as int))").alias("ahead"), F.col("fp").alias("next_fp")
    )
    given = given.groupBy("w_kid", "w_th").agg(F.first("n").alias("n"), F.first("ahead").alias("ahead"), F.first("next_fp").alias("next_fp"))
    joined = held.join(given, (F.col("kid") == F.col("w_kid")) & (F.col("th") == F.col("w_th")))
    edited = joined.select(
        F.expr(f"cast(if(kid = '', null, substring(kid, 2)) as {kind})").alias("id"), "n", "fp", "next_fp", F.concat(F.expr("substring(t, 1, cast(n - n div 2 as int))"), F.col("ahead")).alias("edited")
    )
    parts = edited.select(
        "id", "n", "fp", "next_fp", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("edited"), buckets, number).alias("e_fp")
    )
    return parts.select(
        F.col("id").alias(doc_id), F.col("n").cast("long").alias("n_chars"), "edited_sha256",
        F.array_join("fp", "-").alias("fingerprint"), F.array_join("e_fp", "-").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("e_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
