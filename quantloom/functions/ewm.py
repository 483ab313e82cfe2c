"""Exponentially weighted means as column algebra over window sums.

With q = 1 - alpha a mean is a ratio of sums weighted by powers of q. Rows are cut into blocks by their position, and
running sums inside a block use weights q^-p for the position p in the block, so no weight leaves the double range. The
previous block enters as one carried value; older blocks would weigh at most q^block, which is below double precision
for blocks of ``block_rows`` length. Nulls follow pandas with ``ignore_na=False``: a null row repeats the last value
and widens the gap that discounts it.

In a segmented series each segment is smoothed by itself first. What the rows before it add is an affine function of one
state per mean: the last mean (or the sums behind it), its position and the number of values so far. Segments become one
row each, their functions are composed by an associative scan in log2(segments) steps, and each segment gets the state
it starts with. So the result is that of the whole key, however long a run of nulls is.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantloom.operators.layout import DAILY, Layout, Series, lay_out
from quantloom.sources.stage import stage

_MAX_EXPONENT = 500.0  # exp(500) times any price stays far below the largest double


def alpha_from(span: float | None = None, com: float | None = None) -> float:
    """The smoothing factor for a span or a centre of mass."""
    if (span is None) == (com is None):
        raise ValueError("give exactly one of span and com")
    return 2.0 / (span + 1.0) if span is not None else 1.0 / (1.0 + com)


@dataclass(frozen=True)
class Ewm:
    """One mean to compute.

    ``starts`` names a boolean column that is true on the first value of a key. Give it for a column without later
    nulls: gaps and counts then need no window of their own.
    """

    col: str
    out: str
    alpha: float
    adjust: bool
    min_periods: int = 0
    starts: str | None = None

    @property
    def q(self) -> float:
        return 1.0 - self.alpha


def block_rows(specs: list[Ewm]) -> int:
    """The longest block in which the weights of every mean stay in range."""
    return max(1, min(int(_MAX_EXPONENT / -math.log(s.q)) if s.q > 0 else 1 for s in specs))


def _num(x: float) -> str:
    return f"{x!r}D"


def _power(q: float, exponent: str) -> str:
    return f"power({_num(q)}, {exponent})"


def _add(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr("*", *[f"{sql} AS `{name}`" for name, sql in columns.items()]) if columns else df


def _ln(q: float) -> str:
    return _num(math.log(q)) if q > 0 else "-1.0e6D"


def _compose(df: DataFrame, maps: dict[str, tuple[str, list[str]]], part: str, rows: int) -> DataFrame:
    """Prefix compositions of affine functions along ``_seg``: each of ``maps`` names a factor and its added terms.

    In step k every row takes in the 2^k rows that end k rows before it; all steps share one sort.
    """
    step = 1
    over = f"OVER (PARTITION BY {part} ORDER BY _seg)"
    while step < rows:
        df = _add(
            df,
            {f"_prev_{a}": f"lag({a}, {step}, 1D) {over}" for a, _ in maps.values()}
            | {f"_prev_{b}": f"lag({b}, {step}, 0D) {over}" for _, terms in maps.values() for b in terms},
        )
        new = {b: f"{b} + {a} * _prev_{b}" for a, terms in maps.values() for b in terms} | {a: f"{a} * _prev_{a}" for a, _ in maps.values()}
        df = df.selectExpr(*[f"`{c}`" for c in df.columns if c not in new and not c.startswith("_prev_")], *[f"{x} AS `{c}`" for c, x in new.items()])
        step *= 2
    return df


def _starting_states(df: DataFrame, specs: list[Ewm], layout: Layout) -> DataFrame:
    """A row per segment with what the rows before it hand over to each mean.

    ``df`` holds the segments' own means. Columns: the key as ``_key``, ``_seg`` as ``_seg_in``; per column of values
    the position of the last value and the number of values so far; per mean its last value, and the correction.
    """
    key = layout.part[0]
    ends: dict[str, str] = {}
    for s in specs:
        known = f"CASE WHEN {s.col} IS NOT NULL THEN _pos END"
        ends |= {f"_n_{s.col}": f"count({s.col})", f"_fp_{s.col}": f"min({known})", f"_lp_{s.col}": f"max({known})"}
        if s.adjust:
            ends |= {f"_{n}_{s.out}": f"max_by({x}, {known})" for n, x in (("en", f"_num_{s.out}"), ("ed", f"_den_{s.out}"))}
        else:
            ends |= {f"_x_{s.out}": f"min_by({s.col}, {known})", f"_y_{s.out}": f"max_by(_mean_{s.out}, {known})", f"_e_{s.out}": f"max_by(_left_{s.out}, {known})"}
    summary = df.groupBy(key, "_seg").agg(*[F.expr(x).alias(n) for n, x in ends.items()])
    before = f"OVER (PARTITION BY {key} ORDER BY _seg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    state = {}
    for c in dict.fromkeys(s.col for s in specs):
        state |= {f"_inpos_{c}": f"last(_lp_{c}, true) {before}", f"_incnt_{c}": f"coalesce(sum(_n_{c}) {before}, 0L)"}
    summary = _add(summary, state)
    # the function of each segment: factor and added term; none without values, constant where nothing came before
    maps, weights, columns = {}, {}, {}
    for s in specs:
        a, none = f"_a_{s.out}", f"_n_{s.col} = 0"
        if s.adjust:
            columns[a] = f"CASE WHEN {none} THEN 1D WHEN _inpos_{s.col} IS NULL THEN 0D ELSE {_power(s.q, f'_lp_{s.col} - _inpos_{s.col}')} END"
            columns |= {f"_b{n}_{s.out}": f"CASE WHEN {none} THEN 0D ELSE _{n}_{s.out} END" for n in ("en", "ed")}
            maps[s.out] = (a, [f"_ben_{s.out}", f"_bed_{s.out}"])
            continue
        gap = _power(s.q, f"_fp_{s.col} - _inpos_{s.col}")
        weights[f"_w_{s.out}"] = f"CASE WHEN {none} OR _inpos_{s.col} IS NULL THEN 0D ELSE {gap} / ({gap} + {_num(s.alpha)}) END"
        columns[a] = f"CASE WHEN {none} THEN 1D ELSE _e_{s.out} * _w_{s.out} END"
        columns[f"_b_{s.out}"] = f"CASE WHEN {none} THEN 0D ELSE _y_{s.out} - _e_{s.out} * _w_{s.out} * _x_{s.out} END"
        maps[s.out] = (a, [f"_b_{s.out}"])
    composed = _compose(_add(_add(summary, weights), columns), maps, key, layout.segments)
    over = f"OVER (PARTITION BY {key} ORDER BY _seg)"
    composed = _add(composed, {f"_in{b}": f"lag({b}) {over}" for _, terms in maps.values() for b in terms})
    out = {f"_inpos_{s.col}": f"_inpos_{s.col}" for s in specs} | {f"_incnt_{s.col}": f"_incnt_{s.col}" for s in specs}
    for s in specs:
        begun = f"_inpos_{s.col} IS NOT NULL"
        if s.adjust:
            out |= {f"_in{n}_{s.out}": f"CASE WHEN {begun} THEN _in_b{n}_{s.out} END" for n in ("en", "ed")}
            out[f"_last_{s.out}"] = f"CASE WHEN {begun} THEN try_divide(_in_ben_{s.out}, _in_bed_{s.out}) END"
        else:
            out[f"_last_{s.out}"] = f"CASE WHEN {begun} THEN _in_b_{s.out} END"
            out[f"_shift_{s.out}"] = f"CASE WHEN {begun} THEN _w_{s.out} * (_in_b_{s.out} - _x_{s.out}) END"
    return composed.selectExpr(f"`{key}` AS _key", "_seg AS _seg_in", *[f"{x} AS `{n}`" for n, x in out.items()])


def add_ewm(df: DataFrame, specs: list[Ewm], layout: Layout, order: str, block: int) -> DataFrame:
    """Add every mean in ``specs``. ``df`` needs ``_pos``, ``_blk`` and ``_p`` as made by ``add_blocks``.

    In a segmented layout only a segment's own rows get means; its copies of other rows count for nothing.
    """
    part, kept, segmented = layout.part, list(df.columns), layout.own is not None
    if segmented:
        own = {s.col: f"_own_{s.col}" for s in specs}
        df = df.withColumns({name: F.when(layout.own, F.col(c)) for c, name in own.items()})
        specs = [replace(s, col=own[s.col], starts=None) for s in specs]
    group = ", ".join(part)
    up_to_here = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    so_far = f"OVER (PARTITION BY {group} ORDER BY _blk, {order} {up_to_here})"
    earlier = f"OVER (PARTITION BY {group} ORDER BY _blk, {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    in_block = f"OVER (PARTITION BY {group}, _blk ORDER BY {order} {up_to_here})"
    block_end = f"_p = {block - 1}"

    def gap_of(s: Ewm) -> str | None:
        return None if s.adjust or s.starts else f"_gap_{s.col}"

    # how many values came before, and how far back the last one is
    seen = {}
    for s in specs:
        if not s.starts:
            seen[f"_cnt_{s.col}"] = f"count({s.col}) {so_far}"
        if gap_of(s):
            last_known = f"last(CASE WHEN {s.col} IS NOT NULL THEN _pos END, true) {earlier}"
            seen[gap_of(s)] = f"CASE WHEN {s.col} IS NOT NULL THEN _pos - {last_known} END"
    df = _add(df, seen)

    # log of the renormalising divisor, only where nulls can open a gap
    renorm = {}
    for s in specs:
        gap = gap_of(s)
        if gap:
            divisor = f"{_power(s.q, gap)} + {_num(s.alpha)}"
            renorm[f"_c_{s.out}"] = f"sum(CASE WHEN {gap} > 1 THEN ln({divisor}) ELSE 0D END) {in_block}"
            if segmented:
                renorm[f"_opened_{s.out}"] = f"sum(CASE WHEN {gap} > 1 THEN ln({divisor}) ELSE 0D END) {so_far}"
                renorm[f"_fp_{s.col}"] = f"min(CASE WHEN {s.col} IS NOT NULL THEN _pos END) {so_far}"
    df = _add(df, renorm)

    # running sums inside the block
    sums = {}
    for s in specs:
        grow, known = _power(s.q, "-_p"), f"{s.col} IS NOT NULL"
        if s.adjust:
            sums[f"_num_{s.out}"] = f"sum(CASE WHEN {known} THEN {s.col} * {grow} ELSE 0D END) {in_block}"
            sums[f"_den_{s.out}"] = f"sum(CASE WHEN {known} THEN {grow} ELSE 0D END) {in_block}"
            continue
        gain, first = _num(s.alpha), s.starts
        gap = gap_of(s)
        if gap:
            gain = f"CASE WHEN {gap} = 1 THEN {gain} ELSE {gain} / ({_power(s.q, gap)} + {gain}) END"
            grow = f"{grow} * exp(_c_{s.out})"
            first = f"_cnt_{s.col} = 1"
        weight = f"(CASE WHEN {first} THEN 1D ELSE {gain} END)"
        sums[f"_sum_{s.out}"] = f"sum(CASE WHEN {known} THEN {s.col} * {weight} * {grow} END) {in_block}"
        sums[f"_at_{s.out}"] = f"max(CASE WHEN {known} THEN _p END) {in_block}"
    df = _add(df, sums)

    # what the previous block hands over
    shrink, carry = {}, {}
    for s in specs:
        if s.adjust:
            # a block without values hands over nothing, so the last block with one counts, from its distance
            closing = f"{block_end} AND _den_{s.out} > 0"
            for n in ("num", "den"):
                carry[f"_from_{n}_{s.out}"] = f"last(CASE WHEN {closing} THEN _{n}_{s.out} END, true) {earlier}"
            carry[f"_fromblk_{s.out}"] = f"last(CASE WHEN {closing} THEN _blk END, true) {earlier}"
            continue
        if segmented:
            # the weight that the segment's first value still has
            carry[f"_left_{s.out}"] = f"exp((_pos - _fp_{s.col}) * {_ln(s.q)} - _opened_{s.out})"
        fade = _power(s.q, f"_at_{s.out}")
        shrink[f"_shrink_{s.out}"] = f"{fade} * exp(-_c_{s.out})" if gap_of(s) else fade
        closing = f"CASE WHEN {block_end} THEN _shrink_{s.out} * _sum_{s.out} END"
        closing_pos = f"CASE WHEN {block_end} THEN _blk * {block} + _at_{s.out} END"
        carry[f"_from_{s.out}"] = f"last({closing}, true) {earlier}"
        carry[f"_frompos_{s.out}"] = f"last({closing_pos}, true) {earlier}"
    df = _add(_add(df, shrink), carry)

    # the mean at each value; null rows then repeat the last one, however long ago and whatever the block
    means, out = {}, {}
    for s in specs:
        if s.adjust:
            fade = _power(s.q, f"{block} * (_blk - _fromblk_{s.out})")
            means |= {f"_{n}_{s.out}": f"_{n}_{s.out} + coalesce(_from_{n}_{s.out} * {fade}, 0D)" for n in ("num", "den")}
            continue
        fade = _power(s.q, f"_blk * {block} - _frompos_{s.out}")
        means[f"_mean_{s.out}"] = f"CASE WHEN {s.col} IS NOT NULL THEN _shrink_{s.out} * (_sum_{s.out} + coalesce({fade} * _from_{s.out}, 0D)) END"
    df = df.selectExpr(*[f"`{c}`" for c in df.columns if c not in means], *[f"{x} AS `{n}`" for n, x in means.items()])
    if segmented:
        # sums count from the beginning of the block; below they count from the row itself
        scale = {f"_{n}_{s.out}": f"_{n}_{s.out} * {_power(s.q, '_p')}" for s in specs if s.adjust for n in ("num", "den")}
        df = df.selectExpr(*[f"`{c}`" for c in df.columns if c not in scale], *[f"{x} AS `{n}`" for n, x in scale.items()])
        # stored: the summary and the rows below would work out all windows twice
        needed = [n for s in specs for n in ((f"_num_{s.out}", f"_den_{s.out}") if s.adjust else (f"_mean_{s.out}", f"_left_{s.out}"))]
        columns = [*kept, *own.values(), *[f"_cnt_{c}" for c in own.values()], *needed]
        df = stage(df.select(*dict.fromkeys(columns)), "segment-means")
        states = _starting_states(df, specs, layout)
        df = df.join(states, (F.col(part[0]) == F.col("_key")) & (F.col("_seg") == F.col("_seg_in")), "left")
        handed = {}
        for s in specs:
            if s.adjust:
                fade = _power(s.q, f"_pos - _inpos_{s.col}")
                handed |= {f"_{n}_{s.out}": f"_{n}_{s.out} + coalesce(_in{e}_{s.out} * {fade}, 0D)" for n, e in (("num", "en"), ("den", "ed"))}
            else:
                handed[f"_mean_{s.out}"] = f"_mean_{s.out} + coalesce(_left_{s.out} * _shift_{s.out}, 0D)"
        df = df.selectExpr(*[f"`{c}`" for c in df.columns if c not in handed], *[f"{x} AS `{n}`" for n, x in handed.items()])
    ratios = {f"_mean_{s.out}": f"CASE WHEN {s.col} IS NOT NULL THEN try_divide(_num_{s.out}, _den_{s.out}) END" for s in specs if s.adjust}
    df = _add(df, ratios)
    for s in specs:
        if s.starts:
            out[s.out] = f"_mean_{s.out}"
            continue
        number, last = f"_cnt_{s.col}", f"last(_mean_{s.out}, true) {so_far}"
        if segmented:
            number, last = f"{number} + coalesce(_incnt_{s.col}, 0L)", f"coalesce({last}, _last_{s.out})"
        out[s.out] = f"CASE WHEN {number} >= {max(s.min_periods, 1)} THEN {last} END"
    return df.selectExpr(*[f"`{c}`" for c in kept if c not in out], *[f"{sql} AS `{n}`" for n, sql in out.items()])


def add_blocks(df: DataFrame, block: int) -> DataFrame:
    """Add the block number and the position inside the block."""
    return df.selectExpr("*", f"_pos div {block} AS _blk", f"_pos % {block} AS _p")


def ewm_mean(
    df: DataFrame,
    col: str,
    out: str,
    span: float | None = None,
    com: float | None = None,
    adjust: bool = True,
    min_periods: int = 0,
    series: Series = DAILY,
) -> DataFrame:
    """Exponentially weighted mean of one column, per key, with pandas' rules for nulls."""
    spec = Ewm(col, out, alpha_from(span, com), adjust, min_periods)
    block = block_rows([spec])
    layout = lay_out(df, series)
    smoothed = add_ewm(add_blocks(layout.df, block), [spec], layout, series.order, block)
    return layout.finish(smoothed).drop("_pos", "_blk", "_p", "_seg")
