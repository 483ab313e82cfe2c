"""Near-duplicates by MinHash with odd sketches.

A document is the set of its distinct 5-word shingles. MinHash samples of the set are cut into bands, whose equal keys
makes candidates. An odd sketch is a bitmap in which each member flips one bit; the exclusive-or of two sketches is the
sketch of the members in which they differ, so its population count estimates the similarity, best where it is high. A
small set is sketched whole, a large one by the least hashes of its bins: bins would cost a small set whole units of its
intersection. Candidates that the estimate cannot rule out are confirmed on the full sets.

Buckets may be very large, so pairs within a bucket are not written out. Equal sets are one class from the start. In each
bucket every class meets the bucket's hub, the one that meets most others over all its buckets. Classes linked with their hub are within a quarter of it, so
a class whose distance to the hub is beyond a half can be linked with none of those (the Jaccard distance is a metric).
What that leaves open, among classes not linked with their hub and between the middling ones and the linked ones, is
compared by sketches inside the join, and only for classes that are not yet in the same component.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantloom.llm.common import components, filter_rows, key_filter, may_be_in, whole
from quantloom.sources.stage import stage


@dataclass(frozen=True)
class Plan:
    """A pair at similarity 0.75 is missed by all 51 bands of 5 samples once in a million times.

    Sets of at most ``whole`` shingles are sketched whole. Members that meet in a bit only raise their estimate, which
    without such a meeting is 0.052 low at 3000 shingles in the union and less low below: there ``margin`` loses no linked
    pair, and up to ``whole`` it is 10 standard deviations. Larger sets are sketched by 2048 bins; in simulation the estimate
    is off by 0.0124 at 0.75 and 4096 shingles in the union, the worst size there (one standard deviation), so ``margin`` is
    5 of them. At 0.5 it is off by 0.020 at most, and ``far_margin`` is 5 of those. ``heads`` steers work alone."""

    shingle: int = 5
    percent: int = 75
    bands: int = 51
    rows: int = 5
    bins: int = 2048
    bits: int = 4096
    whole: int = 4096
    margin: float = 0.065
    far_margin: float = 0.1
    heads: int = 6

    @property
    def samples(self) -> int:
        return self.bands * self.rows


CACHE_WORDS = 1 << 19
BLOCK = 1024
FEATURES = "n long, digest binary, bands array<long>, filled int, sketch array<long>, whole array<long>"


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHE_WORDS:
            self[word] = value
        return value


_hashes = _WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles: runs of ``size`` words, A-Z lower-cased; fewer words are one run.

    Lower-casing and splitting bytes touches ASCII alone, which is what the definition of words asks for.
    """
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
        k = min(size, len(h))
        runs = np.full(len(h) - k + 1, k, np.uint64)
        for i in range(k):
            runs = _mix(runs * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - k + 1 + i])
    return np.unique(runs)


def _constants(plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        seeds = _mix(np.arange(1, 2 * plan.samples + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (seeds[: plan.samples] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (seeds[plan.samples :] >> np.uint64(32)).astype(np.uint32)


def min_hashes(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low = np.full(len(a), np.iinfo(np.uint32).max, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    with np.errstate(over="ignore"):
        for i in range(0, len(short), BLOCK):
            np.minimum(low, (short[i : i + BLOCK, None] * a + b).min(axis=0), out=low)
    return low


def band_keys(samples: np.ndarray, plan: Plan) -> np.ndarray:
    with np.errstate(over="ignore"):
        keys = np.arange(plan.bands, dtype=np.uint64)
        for column in samples.reshape(plan.bands, plan.rows).T:
            keys = _mix(keys * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64) + np.uint64(1))
    return keys


def odd_sketch(hashes: np.ndarray, plan: Plan) -> np.ndarray:
    """Parity bitmap of distinct hashes as 64-bit words."""
    with np.errstate(over="ignore"):
        at = _mix(hashes + np.uint64(0x9E3779B97F4A7C15)) % np.uint64(plan.bits)
    odd = np.bincount(at.astype(np.int64), minlength=plan.bits).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def sketches(shingles: np.ndarray, plan: Plan) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of bins in use, the sketch of their least hashes, and the sketch of the whole set; empty where not needed.

    Sets of which one has less than half the size of the other are far apart by their sizes, so those from half of
    ``whole`` to ``whole`` have both sketches, and any other two have one of a kind. The first bits of a hash name its bin,
    so the least hash of a bin is the first one in the sorted set.
    """
    none = np.zeros(0, np.int64)
    whole = odd_sketch(shingles, plan) if len(shingles) <= plan.whole else none
    if 2 * len(shingles) < plan.whole:
        return 0, none, whole
    bins = shingles >> np.uint64(64 - plan.bins.bit_length() + 1)
    least = shingles[np.concatenate([[True], bins[1:] != bins[:-1]])]
    return len(least), odd_sketch(least, plan), whole


def features(docs: DataFrame, plan: Plan, doc_id: str, text: str) -> DataFrame:
    """Stored rows (id, n, digest, bands, filled, sketch, whole), one for each input row; empty texts have n = 0 and no bands."""

    def describe(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = _constants(plan)
        for part in parts:
            out = []
            for t in part["t"]:
                s = shingle_set(t, plan.shingle)
                if not len(s):
                    out.append((0, b"", [], 0, [], []))
                    continue
                keys = band_keys(min_hashes(s, a, b), plan)
                out.append((len(s), xxhash.xxh3_128_digest(s.tobytes()), keys.view(np.int64), *sketches(s, plan)))
            frame = pd.DataFrame(out, columns=["n", "digest", "bands", "filled", "sketch", "whole"])
            frame.insert(0, "id", part["id"].to_numpy())
            yield frame

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("id"), whole(text).alias("t"))
    return stage(rows.mapInPandas(describe, f"id {kind}, {FEATURES}"), "sketches")


def estimate(one: Column, other: Column, plan: Plan) -> Column:
    """Similarity estimated from two structs of n, filled, sketch and whole; 0 where the sizes alone put it below a half.

    The flipped bits give the number of differing members. Of whole sets that gives the similarity. Of samples it gives the
    number of equal bins; a share of the bins that either set uses, whose number follows from the sizes and the similarity
    itself, hence the three rounds.
    """
    small, total = F.greatest(one["n"], other["n"]) <= plan.whole, one["n"] + other["n"]
    mine, its = (F.when(small, x["whole"]).otherwise(x["sketch"]) for x in (one, other))
    odd = F.aggregate(F.zip_with(mine, its, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    differ = F.log(1 - F.least(2.0 * odd / plan.bits, F.lit(0.9999))) * (-plan.bits / 2)
    equal = (one["filled"] + other["filled"] - differ) / 2
    used = lambda share: plan.bins * (1 - F.exp(-total / (plan.bins * (1 + share))))
    # ``equal`` stays one expression: the rounds run inside a fold over a constant array
    rounds = F.aggregate(F.array(F.lit(0), F.lit(0), F.lit(0)), F.struct(F.lit(plan.percent / 100).alias("j"), equal.alias("e")), lambda s, _: F.struct(F.least(F.lit(1.0), F.greatest(F.lit(0.0), s["e"] / used(s["j"]))).alias("j"), s["e"].alias("e")))
    apart = 2 * F.least(one["n"], other["n"]) < F.greatest(one["n"], other["n"])
    return F.when(apart, F.lit(0.0)).when(small, 2 * total / (total + differ) - 1).otherwise(rounds["j"])


def _sizes_fit(n: Column, m: Column, plan: Plan) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * plan.percent


def confirm(docs: DataFrame, pairs: DataFrame, plan: Plan, doc_id: str, text: str) -> DataFrame:
    """Of pairs (u, v) of ids those linked on their full shingle sets; the texts of the pairs' documents are read again."""
    ids = stage(pairs.select(F.col("u").alias("p_id")).union(pairs.select("v")).distinct(), "confirm-ids")
    rows = filter_rows(ids.count())
    bitmap = stage(key_filter(ids, F.xxhash64("p_id"), rows), "confirm-filter")
    asked = may_be_in(docs.select(F.col(doc_id).alias("id"), whole(text).alias("t")), F.xxhash64("id"), bitmap, rows, "asked")

    def sets(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            raw = [shingle_set(t, plan.shingle).tobytes() for t in part["t"]]
            yield pd.DataFrame({"id": part["id"], "digest": [xxhash.xxh3_128_digest(x) if x else b"" for x in raw], "shingles": raw})

    kind = docs.schema[doc_id].dataType.simpleString()
    asked = asked.where(F.col("asked") & F.col("id").isNotNull()).select("id", "t")
    found = asked.mapInPandas(sets, f"id {kind}, digest binary, shingles binary").join(ids, F.col("id") == F.col("p_id"), "left_semi")
    found = stage(found.groupBy("id").agg(F.min_by("shingles", "digest").alias("shingles")), "confirm-sets")
    both = pairs.join(found.select(F.col("id").alias("u"), F.col("shingles").alias("s")), "u")
    both = both.join(found.select(F.col("id").alias("v"), F.col("shingles").alias("t")), "v").select("u", "v", "s", "t")

    def linked(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            keep = []
            for s, t in zip(part["s"], part["t"], strict=True):
                x, y = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= plan.percent * (len(x) + len(y) - common))
            yield part.loc[keep, ["u", "v"]]

    return both.mapInPandas(linked, f"u {kind}, v {kind}")


def _edges(joined: DataFrame) -> DataFrame:
    return joined.select(F.col("component").alias("u"), F.col("id").alias("v"))


def _open_pairs(rest: DataFrame, heads: DataFrame, joined: DataFrame, plan: Plan, near: float, once: bool) -> DataFrame:
    """Pairs (u, v) of a bucket's members, one of them in ``heads``, that are in different components and that neither
    the hub nor the sizes nor the sketches rule out. Both are looked at inside the join, with ``once`` only in the first bucket
    that the two share, so a pair is compared once and written only if it is to be confirmed."""
    part = joined.select(F.col("id").alias("j_id"), "component")

    def located(rows: DataFrame, name: str) -> DataFrame:
        out = rows.join(part, F.col("id") == F.col("j_id"), "left").select("band", "id", "state", "d", "earlier", F.coalesce("component", "id").alias("component"))
        return stage(out, f"sketch-{name}")

    left, right = located(rest, "left"), located(heads, "right")
    other = right.select("band", *[F.col(c).alias(f"o_{c}") for c in ("id", "state", "d", "earlier", "component")])
    open_pair = (
        (F.col("component") != F.col("o_component")) & ~((F.col("state") == 0) & (F.col("o_state") == 0))
        & ~((F.col("state") + F.col("o_state") == 2) & (F.col("state") != 1)) & (~F.arrays_overlap("earlier", "o_earlier") if once else F.lit(True))
        & _sizes_fit(F.col("d.n"), F.col("o_d.n"), plan) & (estimate(F.col("d"), F.col("o_d"), plan) >= near)
    )
    pairs = left.join(other, "band").where(open_pair)
    return pairs.select(F.least("id", "o_id").alias("u"), F.greatest("id", "o_id").alias("v")).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", plan: Plan = Plan()) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one for each input row.

    Documents are linked from a similarity of ``percent`` on; ``component_id`` is the smallest id reachable over links and
    ``kept`` says that it is the row's own. Null and empty texts have no shingles and are linked with nothing. Rows that
    repeat an id are one document, whose set is that of the text with the smallest digest, the empty one first; rows with
    a null id have no component and no set and are kept. An empty table gives no rows; other columns are ignored.
    """
    made = features(docs, plan, doc_id, text)
    kind = docs.schema[doc_id].dataType
    # one set for each id, then classes of equal sets; members of a class are dealt with at the end
    each = made.groupBy("id").agg(F.min(F.struct("digest", "n")).alias("d"), F.count(F.lit(1)).alias("rows"))
    each = stage(each.select("id", "d.digest", "d.n", "rows"), "sketch-ids")
    classes = stage(each.where("n > 0").groupBy("digest").agg(F.min("id").alias("rep"), F.max("id").alias("last")), "sketch-classes")
    shared = classes.where("rep <> last").select(F.col("digest").alias("c_digest"), F.col("rep").alias("c_rep"))
    reps = classes.select(F.col("digest").alias("r_digest"), F.col("rep").alias("r_rep"))
    own = made.join(reps, (F.col("digest") == F.col("r_digest")) & (F.col("id") == F.col("r_rep")), "left_semi")
    own = stage(own.dropDuplicates(["id"]).select("id", "n", "bands", "filled", "sketch", "whole"), "sketch-own")
    banded = own.select("id", F.explode("bands").alias("band"))
    sizes = banded.groupBy("band").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    inside = stage(banded.join(stage(sizes, "sketch-sizes"), "band"), "sketch-inside")
    # the hub of a bucket is the member that meets most others over all its buckets: the middle of a group of copies
    weight = stage(inside.groupBy("id").agg(F.sum("m").alias("w")).select(F.col("id").alias("w_id"), "w"), "sketch-weights")
    weighed = stage(inside.join(weight, F.col("id") == F.col("w_id")).select("band", "id", "w"), "sketch-weighed")
    hubs = weighed.groupBy("band").agg(F.max_by("id", F.struct("w", "id")).alias("hub"))
    inside = stage(weighed.join(stage(hubs, "sketch-hubs"), "band").select("band", "id", "hub"), "sketch-inside")
    slim = own.select("id", F.struct("n", "filled", "sketch", "whole").alias("d"))

    def described(pairs: DataFrame) -> DataFrame:
        out = pairs.join(slim.toDF("u", "d_u"), "u").join(slim.toDF("v", "d_v"), "v")
        return out.select("u", "v", _sizes_fit(F.col("d_u.n"), F.col("d_v.n"), plan).alias("fit"), estimate(F.col("d_u"), F.col("d_v"), plan).alias("est"))

    near, far = plan.percent / 100 - plan.margin, 2 * plan.percent / 100 - 1 - plan.far_margin
    met = stage(described(inside.where("id <> hub").select(F.col("hub").alias("u"), F.col("id").alias("v")).distinct()), "sketch-met")
    first = stage(confirm(docs, met.where((F.col("est") >= near) & F.col("fit")).select("u", "v"), plan, doc_id, text), "sketch-linked")
    # what the hubs leave open: 0 linked with the hub or the hub itself, 1 middling, 2 far
    states = met.join(first.withColumn("linked", F.lit(True)), ["u", "v"], "left").select(
        F.col("u").alias("hub"), F.col("v").alias("id"), F.when(F.col("linked"), 0).when(F.col("est") >= far, 1).otherwise(2).alias("state")
    )
    placed = inside.join(states, ["hub", "id"], "left").select("band", "id", F.coalesce("state", F.lit(0)).alias("state"))
    placed = stage(placed, "sketch-placed")
    open_bands = placed.groupBy("band").agg(F.max("state").alias("worst"), F.max((F.col("state") == 1).cast("int")).alias("middling"), F.count(F.lit(1)).alias("m"))
    open_bands = stage(open_bands.where("worst > 0 and m > 2").select(F.col("band").alias("o_band"), "middling"), "sketch-open")
    rest = placed.join(open_bands, F.col("band") == F.col("o_band")).where("state > 0 or middling = 1")
    rest = rest.join(own.select("id", F.struct("n", "filled", "sketch", "whole").alias("d"), "bands"), "id")
    earlier = F.slice("bands", F.lit(1), F.array_position("bands", F.col("band")).cast("int") - 1)
    rest = stage(rest.select("band", "id", "state", "d", earlier.alias("earlier")), "sketch-rest")
    tested = met.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    joined = stage(components(first), "sketch-joined")
    # a few members of each bucket meet all others first: most of what can be joined is then joined
    order = Window.partitionBy("band").orderBy(F.xxhash64("id", "band"))
    heads = rest.withColumn("k", F.row_number().over(order)).where(F.col("k") <= plan.heads).drop("k")
    some = stage(_open_pairs(rest, stage(heads, "sketch-heads"), joined, plan, near, once=False).join(tested, ["u", "v"], "left_anti"), "sketch-some")
    second = stage(confirm(docs, some, plan, doc_id, text), "sketch-linked")
    joined = stage(components(_edges(joined).union(second)), "sketch-joined")
    last = _open_pairs(rest, rest, joined, plan, near, once=True).join(tested.union(some), ["u", "v"], "left_anti")
    third = confirm(docs, stage(last, "sketch-last"), plan, doc_id, text)
    linked = stage(components(_edges(joined).union(third)), "sketch-components")
    linked = linked.select(F.col("id").alias("l_id"), "component")
    rows = each.join(shared, F.col("digest") == F.col("c_digest"), "left").select("id", "n", "rows", F.coalesce("c_rep", "id").alias("rep"))
    rows = rows.join(linked, F.col("rep") == F.col("l_id"), "left").select("id", "n", F.coalesce("component", "rep").alias("component"), "rows")
    rows = rows.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))).drop("row", "rows")
    nameless = docs.where(F.col(doc_id).isNull()).select(F.lit(None).cast(kind).alias("id"), F.lit(None).cast("long").alias("n"), F.lit(None).cast(kind).alias("component"))
    return rows.union(nameless).select(
        F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def keep_one_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", plan: Plan = Plan()) -> DataFrame:
    """``docs`` without the rows that ``near_duplicates`` does not keep; columns as they are."""
    gone = near_duplicates(docs, doc_id, text, plan).where(~F.col("kept")).select(F.col(doc_id).alias("g_id")).distinct()
    gone = stage(gone, "sketch-gone")
    rows = filter_rows(gone.count())
    bitmap = stage(key_filter(gone, F.xxhash64("g_id"), rows), "sketch-gone-filter")
    keyed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(doc_id).alias("k_id"))
    keyed = may_be_in(keyed, F.xxhash64("k_id"), bitmap, rows, "asked")
    stay = keyed.where(~F.col("asked")).select("row").union(keyed.where("asked").join(gone, F.col("k_id") == F.col("g_id"), "left_anti").select("row"))
    return stay.select("row.*")
