"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the expected number of its copies. Among all rates between 0 and ``most`` that give each
source its target number of words, the ones closest to 1 in relative entropy are exponentially tilted:
``min(most, exp(lambda_s * size))``. The dual over lambda is convex; Newton steps solve it, each step one aggregate over
the documents for all sources at once, guarded by a bracket. Rates become copies by comparing their fraction with a
random number that belongs to the document's id and text, shifted by a constant of the source that the same kind of aggregate
finds, so reruns agree and whether a document stays depends on nothing but its source's constants. What is left to the
target is filled with the largest documents that fit.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.llm.common import whole, word_count
from quantloom.sources.stage import stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
# the sources are the mixture's own table in the driver
MOST_SOURCES = 100_000
STEPS, FILLS = 60, 8
GRID, GRID_ROUNDS = 16, 5
TOLERANCE = 1e-7


@dataclass
class Source:
    name: str | None
    size: int
    documents: int
    target: float
    tilt: float = 0.0
    shift: float = 0.0
    fills: tuple[int, ...] = ()

    @property
    def unit(self) -> float:
        return max(1.0, self.size / max(1, self.documents))


def targets(sizes: dict[str | None, int], weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> dict[str | None, float]:
    """Words to take from each source: ``share`` of all words by weight, at most ``most`` times a source's size; what goes
    beyond is shared again by weight among the others until none is above. Sources in the order of code points, null last."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    goal, full, left = share * sum(sizes.values()), {}, list(order)
    while left:
        rest = max(0.0, goal - sum(full.values()))
        total = sum(weight[s] for s in left)
        part = {s: rest * weight[s] / total for s in left}
        above = [s for s in left if part[s] > most * sizes[s]]
        if not above:
            return full | part
        full |= {s: float(most * sizes[s]) for s in above}
        left = [s for s in left if s not in full]
    return full


def _literal(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table from the driver, as an expression: no Python worker takes part."""
    text = F.lit(json.dumps(rows))
    return F.broadcast(spark.range(1).select(F.inline(F.from_json(text, f"array<struct<{schema}>>"))))


def _table(spark: SparkSession, sources: list[Source]) -> DataFrame:
    """The sources' constants: one row each, so of a size that the caller has checked."""
    rows = [
        {"m_source": s.name, "tilt": float(s.tilt), "unit": s.unit, "shift": float(s.shift), "target": float(s.target), "source_size": s.size, "fills": s.fills}
        for s in sources
    ]
    return _literal(
        spark, rows, "m_source: string, tilt: double, unit: double, shift: double, target: double, source_size: bigint, fills: array<bigint>"
    )


def _rate(most: float) -> Column:
    return F.least(F.lit(float(most)), F.exp(F.least(F.lit(50.0), F.col("tilt") * F.col("size") / F.col("unit"))))


def _copies(rate: Column, shift: Column) -> Column:
    """Whole copies, one more where the document's number is below the shifted fraction."""
    return F.floor(rate) + F.when(F.col("u") < rate - F.floor(rate) + shift, 1).otherwise(0)


def _bounded(copies: Column, most: int) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(most), copies)).cast("long")


class Mixture:
    """The fitted constants; ``copies`` adds columns to any table of the same documents, row by row."""

    def __init__(self, spark: SparkSession, sources: list[Source], most: int):
        self.spark, self.sources, self.most = spark, sources, most

    def rows(self, docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
        return docs.select(
            F.col(doc_id).alias("id"), _key(doc_id, text).alias("key"), word_count(whole(text)).alias("size"),
            F.col(source).cast("string").alias("source"), F.struct(*[F.col(c) for c in docs.columns]).alias("row"),
        ).withColumn("u", _number())

    def copies(self, rows: DataFrame) -> DataFrame:
        """Add source_size, target and copies to rows with key, size, source and u."""
        joined = rows.join(_table(self.spark, self.sources), F.col("source").eqNullSafe(F.col("m_source")))
        base = _bounded(_copies(_rate(self.most), F.col("shift")), self.most)
        return joined.withColumn("copies", _bounded(base + F.array_contains("fills", F.col("key")).cast("long"), self.most))


def _key(doc_id: str, text: str) -> Column:
    """A document's own key; rows without an id, or with the same one, differ by their texts."""
    return F.xxhash64(F.lit(5), F.col(doc_id), whole(text))


def _number() -> Column:
    """A number in [0, 1) that belongs to the key."""
    return F.pmod(F.xxhash64(F.lit(7), F.col("key")), F.lit(1 << 52)) / F.lit(float(1 << 52))


def fit_mixture(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST,
) -> Mixture:
    spark = docs.sparkSession
    slim = docs.select(
        _key(doc_id, text).alias("key"), word_count(whole(text)).alias("size"), F.col(source).cast("string").alias("source")
    ).withColumn("u", _number())
    slim = stage(slim, "mix-sizes")
    found = slim.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources; group them first")
    goal = targets({r.source: r["size"] for r in found}, weights, share, most)
    sources = [Source(r.source, r["size"], r.n, goal[r.source]) for r in found]
    mixture = Mixture(spark, sources, most)
    _solve_tilts(slim, mixture)
    _solve_shifts(slim, mixture)
    _fill(slim, mixture)
    return mixture


def _joined(slim: DataFrame, mixture: Mixture, only: list[Source]) -> DataFrame:
    return slim.join(_table(mixture.spark, only), F.col("source").eqNullSafe(F.col("m_source")))


def _solve_tilts(slim: DataFrame, mixture: Mixture) -> None:
    """Newton steps on the dual of all sources at once; a step that leaves its bracket is replaced by halving it."""
    low, high = {s.name: -64.0 for s in mixture.sources}, {s.name: 64.0 for s in mixture.sources}
    open_ = []
    for s in mixture.sources:
        if s.target >= mixture.most * s.size:  # all of it, as often as allowed
            s.tilt, s.shift = 64.0 * s.unit, 1.0
        elif s.target <= 0:
            s.tilt = -64.0 * s.unit
        elif abs(s.target - s.size) > TOLERANCE * s.target:
            open_.append(s)
    words = F.col("size").cast("double")
    for _ in range(STEPS):
        if not open_:
            return
        rate = _rate(mixture.most)
        bend = F.when(rate < mixture.most, rate * words * words / F.col("unit")).otherwise(0.0)
        now = _joined(slim, mixture, open_).groupBy("source").agg(F.sum(rate * words).alias("taken"), F.sum(bend).alias("slope")).collect()
        state, still = {r.source: r for r in now}, []
        for s in open_:
            r = state[s.name]
            if abs(r.taken - s.target) <= TOLERANCE * s.target or high[s.name] - low[s.name] < 1e-13:
                continue
            if r.taken > s.target:
                high[s.name] = s.tilt
            else:
                low[s.name] = s.tilt
            step = s.tilt - (r.taken - s.target) / r.slope if r.slope > 0 else None
            inside = step is not None and low[s.name] < step < high[s.name]
            s.tilt = step if inside else (low[s.name] + high[s.name]) / 2
            still.append(s)
        open_ = still


def _solve_shifts(slim: DataFrame, mixture: Mixture) -> None:
    """For each source the largest shift of the random numbers whose copies hold no more words than the target.

    Copies grow with the shift, so a round of one aggregate tries ``GRID - 1`` shifts of the bracket at once.
    """
    open_ = [s for s in mixture.sources if 0 < s.target < mixture.most * s.size]
    low, width = {s.name: -1.0 for s in open_}, 2.0
    for _ in range(GRID_ROUNDS):
        if not open_:
            return
        for s in open_:
            s.shift = low[s.name]
        rate = _rate(mixture.most)
        tries = [
            F.sum(_bounded(_copies(rate, F.col("shift") + F.lit(width * k / GRID)), mixture.most) * F.col("size")).alias(f"w{k}") for k in range(1, GRID)
        ]
        state = {r.source: r for r in _joined(slim, mixture, open_).groupBy("source").agg(*tries).collect()}
        for s in open_:
            fitting = [k for k in range(1, GRID) if state[s.name][f"w{k}"] <= s.target]
            low[s.name] += width * max(fitting, default=0) / GRID
        width /= GRID
    for s in open_:
        s.shift = low[s.name]


def _fill(slim: DataFrame, mixture: Mixture) -> None:
    """One more copy of the largest document that fits what is left, a few times over; each round is two aggregates.

    Rows that repeat id and text share a key and would all get the copy: they are counted, and passed over if together
    they do not fit.
    """
    rows = mixture.copies(slim).groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken")).collect()
    taken = {r.source: r.taken for r in rows}
    open_ = [s for s in mixture.sources if 0 < s.target < mixture.most * s.size]
    largest = {s.name: float(s.target - taken[s.name]) for s in open_}
    for _ in range(FILLS):
        if not open_:
            return
        gaps = _literal(mixture.spark, [{"g_source": s.name, "gap": largest[s.name]} for s in open_], "g_source: string, gap: double")
        free = mixture.copies(slim).where((F.col("copies") < mixture.most) & (F.col("size") > 0))
        fits = free.join(gaps, F.col("source").eqNullSafe(F.col("g_source"))).where(F.col("size") <= F.col("gap"))
        found = {r.source: r.best for r in fits.groupBy("source").agg(F.max(F.struct("size", "key")).alias("best")).collect()}
        open_ = [s for s in open_ if s.name in found and found[s.name].key not in s.fills]
        if not open_:
            return
        chosen = _literal(mixture.spark, [{"c_source": s.name, "c_key": found[s.name].key} for s in open_], "c_source: string, c_key: bigint")
        same = free.join(chosen, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("key") == F.col("c_key")))
        times = {r.source: r.n for r in same.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}
        for s in open_:
            words = found[s.name]["size"]
            if times[s.name] * words <= s.target - taken[s.name]:
                s.fills += (found[s.name].key,)
                taken[s.name] += times[s.name] * words
                largest[s.name] = float(s.target - taken[s.name])
            else:
                largest[s.name] = words - 1.0


def mix(docs: DataFrame, mixture: Mixture, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mixture itself: each document's row as many times as it has copies, none where it has 0."""
    rows = mixture.copies(mixture.rows(docs, doc_id, text, source))
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    return rows.where("copies > 0").select("row", times).select("row.*")


def mixture_report(docs: DataFrame, mixture: Mixture, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Rows (doc_id, size, source_size, target, copies, taken), one for each document.

    Size is the number of words; null text has none. A null source is a source of its own. Documents without words keep
    rate 1 and take nothing. Rows without an id or that repeat one are told apart by their texts; rows that repeat id and
    text are taken equally often. An empty table gives no rows; columns of other names are kept out.
    """
    rows = mixture.copies(mixture.rows(docs, doc_id, text, source))
    return rows.select(F.col("id").alias(doc_id), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
