"""Quota kernels: shares, exact rounding, proportional fitting, plans (survey N1-N8, P18, P19, V13, A19-A21).

Cell tables are products of small fixed axes. Kernels that iterate run on the driver over marginals whose number is checked;
rounding and filtering are window functions over the cells.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPS = 1e-6
MAX_AXIS = 100_000


def water_fill(weights: dict[str, float], low: float, high: float) -> dict[str, float]:
    """Shares in proportion to the weights, held within [low, high].

    In each pass all free shares outside the bounds, at the pass's own scale, are fixed at the bound they break. Shares
    that are fixed in one pass on both sides may leave a sum other than 1; ``rescaled`` mends that.
    """
    if not weights:
        raise ValueError("no shares to divide")
    n = len(weights)
    if n * low > 1 + EPS or n * high < 1 - EPS:
        raise ValueError(f"{n} shares can't sum to 1 within [{low}, {high}]")
    names = sorted(weights)
    w = np.maximum([float(weights[k]) for k in names], 0.0)
    share, free = np.zeros(n), np.ones(n, bool)
    while free.any():
        mass, scale = 1.0 - share[~free].sum(), w[free].sum()
        if scale <= 0:
            share[free] = mass / free.sum()
            break
        want = mass * w / scale
        under, over = free & (want < low - EPS), free & (want > high + EPS)
        if not (under.any() or over.any()):
            share[free] = want[free]
            break
        share[under], share[over] = low, high
        free &= ~(under | over)
    return dict(zip(names, share.tolist()))


def rescaled(shares: dict[str, float]) -> dict[str, float]:
    total = sum(shares.values())
    return {k: v / total for k, v in shares.items()}


def fit(seed: np.ndarray, rows: np.ndarray, cols: np.ndarray, iterations: int = 200) -> np.ndarray:
    """Iterative proportional fitting; zeros of the seed stay zero. Stops early only where another pass would change nothing."""
    m = seed.astype(float)
    for _ in range(iterations):
        was, r = m.copy(), m.sum(1)
        m *= np.divide(rows, r, out=np.zeros_like(r), where=r > 0)[:, None]
        c = m.sum(0)
        m *= np.divide(cols, c, out=np.zeros_like(c), where=c > 0)[None, :]
        if np.array_equal(m, was):
            break
    if m.sum() <= 0:
        raise ValueError("no feasible cell carries any share")
    return m / m.sum()


def normalized(df: DataFrame, weight: str, by: list[str] | None = None) -> DataFrame:
    """Adds ``share``; groups whose weights sum to 0 get nulls. Without groups the total is a scalar, not a window."""
    total = F.sum(weight).over(Window.partitionBy(*by)) if by else df.agg(F.sum(weight)).scalar()
    return df.withColumn("share", F.when(total > 0, F.col(weight) / total))


def largest_remainder(df: DataFrame, share: str, total: Column, keys: list[str], by: list[str] | None = None, out: str = "target") -> DataFrame:
    """Integers that sum to ``total`` within each group; ties of the remainder go to the smaller keys.

    Fractions are compared to nine digits, so that engines with other sums agree.
    """
    raw = F.col(share) * total
    x = df.withColumn("_floor", F.floor(F.round(raw, 9)).cast("long")).withColumn("_frac", F.round(raw - F.floor(F.round(raw, 9)), 9))
    if not by:
        return _one_group(x, total, keys, out)
    group = Window.partitionBy(*by)
    rest = total - F.sum("_floor").over(group)
    up = F.row_number().over(group.orderBy(F.desc("_frac"), *keys))
    down = F.row_number().over(group.orderBy("_frac", *keys))
    x = x.withColumn("_rest", rest).withColumn("_up", up).withColumn("_down", down)
    step = F.when((F.col("_rest") > 0) & (F.col("_up") <= F.col("_rest")), 1).when((F.col("_rest") < 0) & (F.col("_down") <= -F.col("_rest")), -1).otherwise(0)
    return x.withColumn(out, (F.col("_floor") + step).cast("long")).drop("_floor", "_frac", "_rest", "_up", "_down")


def _one_group(x: DataFrame, total: Column, keys: list[str], out: str) -> DataFrame:
    """Rounding of a whole table: sums by aggregate, the remainder by a top-k of the fractions; no row is brought to one task."""
    rest = int(x.agg((total - F.sum("_floor")).alias("r")).first()[0] or 0)
    order = [F.col("_frac").desc() if rest > 0 else F.col("_frac"), *keys]
    chosen = x.select(*keys, "_frac").orderBy(*order).limit(abs(rest)).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.lit(1 if rest > 0 else -1).alias("_step"))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    x = x.join(chosen, same, "left") if rest else x.withColumn("_step", F.lit(0))
    return x.withColumn(out, (F.col("_floor") + F.coalesce("_step", F.lit(0))).cast("long")).drop("_floor", "_frac", "_step", *[f"_k{i}" for i in range(len(keys))])


def block_shares(feasible: DataFrame, row: str, col: str, row_share: dict[str, float], col_share: dict[str, float], iterations: int = 200) -> DataFrame:
    """N4 over the feasible pairs: (row, col, share)."""
    pairs = feasible.select(row, col).distinct().limit(MAX_AXIS + 1).collect()
    if len(pairs) > MAX_AXIS:
        raise ValueError("the block of shares exceeds the driver's limit")
    rows, cols = sorted(row_share), sorted(col_share)
    at_r, at_c = ({k: i for i, k in enumerate(x)} for x in (rows, cols))
    seed = np.zeros((len(rows), len(cols)))
    for r, c in pairs:
        if r in at_r and c in at_c:
            seed[at_r[r], at_c[c]] = row_share[r] * col_share[c]
    m = fit(seed, np.array([row_share[r] for r in rows]), np.array([col_share[c] for c in cols]), iterations)
    out = [(rows[i], cols[j], float(m[i, j])) for i, j in zip(*np.nonzero(m))]
    return feasible.sparkSession.createDataFrame(out, f"`{row}` string, `{col}` string, share double")


def final_quotas(cells: DataFrame, keys: list[str], n: int, floor: int, cap: float, weight: str = "weight", observed: str = "observed") -> list[tuple]:
    """(keys..., quota): how many of ``n`` rows each cell gives. First every cell keeps its floor, then the rest is filled in
    proportion to weight times observed rows; no cell gives more than it has, or than ``cap`` of n.

    Cells are a product of small axes; their number is checked, and the filling runs on the driver.
    """
    rows = cells.select(*keys, F.col(weight).cast("double"), F.col(observed).cast("long")).limit(MAX_AXIS + 1).collect()
    if len(rows) > MAX_AXIS:
        raise ValueError("more cells than the driver's limit")
    rows = sorted(rows, key=lambda r: tuple(str(x) for x in r[:-2]))
    have, w = np.array([r[-1] for r in rows], float), np.array([r[-2] * r[-1] for r in rows])
    most = np.minimum(have, math.floor(cap * n + EPS))
    base = np.minimum(most, floor)
    if base.sum() > n:  # more floors than rows: the floors are shared out
        w, most, base = base, base, np.zeros_like(base)
    room, rest = most - base, min(n - base.sum(), (most - base).sum())
    more, free = np.zeros_like(base), room > 0
    while free.any():
        want = (rest - more[~free].sum()) * w / w[free].sum()
        over = free & (want > room)
        if not over.any():
            more[free] = want[free]
            break
        more[over] = room[over]
        free &= ~over
    whole = np.floor(np.round(more, 9))
    fraction = np.round(more - whole, 9)
    order = sorted(range(len(rows)), key=lambda i: (-fraction[i], i))
    for i in order[: int(round(rest - whole.sum()))]:
        whole[i] += 1
    return [(*r[:-2], int(q)) for r, q in zip(rows, base + whole)]


def spread(block: DataFrame, axes: dict[str, dict[str, float]]) -> DataFrame:
    """The block's shares times those of further independent axes."""
    out = block
    for name, shares in axes.items():
        values = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(float(v)).alias("v")) for k, v in sorted(shares.items())])
        out = out.withColumn("_a", F.explode(values)).withColumn(name, F.col("_a.k")).withColumn("share", F.col("share") * F.col("_a.v")).drop("_a")
    return out


def plan(shares: DataFrame, keys: list[str], total: int, min_cell: int = 1) -> DataFrame:
    """Rounded cells; cells below ``min_cell`` are dropped and their mass is divided among the rest."""
    cells = largest_remainder(shares, "share", F.lit(total), keys).filter(F.col("target") >= min_cell)
    lost = total - int(cells.agg(F.sum("target")).first()[0] or 0)
    cells = cells.withColumn("_s", F.col("share") / cells.agg(F.sum("share")).scalar())
    cells = largest_remainder(cells, "_s", F.lit(lost), keys, out="_more")
    return cells.withColumn("target", F.col("target") + F.col("_more")).filter("target > 0").drop("_s", "_more")


def scale(cells: DataFrame, target: str, total: int, keys: list[str]) -> DataFrame:
    """N7."""
    shares = cells.withColumn("_share", F.col(target) / cells.agg(F.sum(target)).scalar())
    return largest_remainder(shares, "_share", F.lit(total), keys, out="scaled").filter("scaled > 0").drop("_share")


def cap_violations(cells: DataFrame, axis: str, domain: list[str], low: float, high: float, target: str = "target") -> DataFrame:
    """(axis, value, share, rule) of the axis values outside the caps; values without a cell count as 0."""
    total = cells.agg(F.sum(target)).collect()[0][0] or 0
    have = cells.groupBy(F.col(axis).alias("value")).agg(F.sum(target).alias("n"))
    names = cells.sparkSession.createDataFrame([(d,) for d in domain], "value string")
    share = F.round(F.coalesce("n", F.lit(0)) / F.lit(float(total or 1)), 6)
    out = names.join(have, "value", "left").withColumn("share", share)
    rule = F.when(F.col("share") > high + EPS, "above").when(F.col("share") < low - EPS, "below")
    return out.select(F.lit(axis).alias("axis"), "value", "share", rule.alias("rule")).filter("rule is not null")


def capacity_violations(cells: DataFrame, pool: DataFrame, keys: list[str], per_item: int, target: str = "target") -> DataFrame:
    """Groups whose planned rows exceed their pool's size times the uses of one item."""
    want = cells.groupBy(*keys).agg(F.sum(target).alias("planned"))
    have = pool.groupBy(*keys).agg(F.count("*").alias("pool"))
    out = want.join(have, keys, "left").withColumn("pool", F.coalesce("pool", F.lit(0).cast("long")))
    return out.filter(F.col("planned") > F.col("pool") * per_item)
