"""Reproducibility of contact maps and hierarchical clustering, after their public descriptions.

Contact maps are sparse: chrom, i, j (bin numbers), n."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def smooth(contacts: DataFrame, h: int) -> DataFrame:
    """Mean over the (2h + 1) x (2h + 1) neighbourhood of every cell that has a contact in it."""
    shifts = F.sequence(F.lit(-h), F.lit(h))
    near = contacts.select("chrom", "i", "j", "n", F.explode(shifts).alias("di")).select("*", F.explode(shifts).alias("dj"))
    return near.groupBy("chrom", (F.col("i") + F.col("di")).alias("i"), (F.col("j") + F.col("dj")).alias("j")).agg((F.sum("n") / float((2 * h + 1) ** 2)).alias("n"))


def strata_correlation(a: DataFrame, b: DataFrame, most: int) -> DataFrame:
    """stratum (|i - j|), cells, rho of cells that either map holds. rho is null where a side doesn't vary."""
    one = a.select("chrom", "i", "j", F.col("n").cast("double").alias("x"))
    two = b.select("chrom", "i", "j", F.col("n").cast("double").alias("y"))
    both = one.join(two, ["chrom", "i", "j"], "full").fillna(0.0, ["x", "y"]).withColumn("stratum", F.abs(F.col("j") - F.col("i"))).where(F.col("stratum") <= most)
    t = both.groupBy("stratum").agg(F.count(F.lit(1)).alias("cells"), F.covar_pop("x", "y").alias("c"), F.var_pop("x").alias("vx"), F.var_pop("y").alias("vy"))
    return t.select("stratum", "cells", F.when((F.col("vx") > 0) & (F.col("vy") > 0), F.col("c") / F.sqrt(F.col("vx") * F.col("vy"))).alias("rho"), "vx", "vy")


def adjusted_correlation(a: DataFrame, b: DataFrame, most: int) -> DataFrame:
    """One row, scc, sd, strata: strata's correlations weighted by cells and by the spread of ranked values
    (variance-stabilised), and the standard deviation of that mean, a correlation's variance being (1 - rho^2)^2 / (cells - 1)."""
    t = strata_correlation(a, b, most).where(F.col("rho").isNotNull() & (F.col("cells") > 1))
    weight = F.col("cells") * (1 + 1 / F.col("cells")) / 12
    spread = F.pow(weight * (1 - F.col("rho") * F.col("rho")), 2) / (F.col("cells") - 1)
    return t.agg((F.sum(F.col("rho") * weight) / F.sum(weight)).alias("scc"), (F.sqrt(F.sum(spread)) / F.sum(weight)).alias("sd"), F.count(F.lit(1)).alias("strata"))


def thinned(contacts: DataFrame, total: int, seed: int = 0) -> DataFrame:
    """Contacts drawn from a map so that about `total` are left (all, if it has no more); a cell's draw depends on its place
    and the seed only."""
    have = contacts.agg(F.sum("n")).first()[0] or 0  # one number
    if have <= total:
        return contacts
    share = total / have

    @F.pandas_udf("long")
    def draw(n: pd.Series, place: pd.Series) -> pd.Series:
        return pd.Series([np.random.default_rng((seed, int(p) & (2**63 - 1))).binomial(int(k), share) for k, p in zip(n, place, strict=True)])

    return contacts.withColumn("n", draw(F.col("n").cast("long"), F.xxhash64("chrom", "i", "j"))).where("n > 0")


def train_smoothing(a: DataFrame, b: DataFrame, most: int, largest: int = 10, gain: float = 0.01) -> tuple[int, list[float]]:
    """The least h after which the correlation of smoothed maps grows by less than `gain`, and the correlations seen.

    A step is two smoothings and an aggregate; one number comes to the driver."""
    seen: list[float] = []
    for h in range(largest + 1):
        scc = adjusted_correlation(smooth(a, h), smooth(b, h), most).first()["scc"]
        seen.append(scc if scc is not None else 0.0)
        if h and seen[-1] - seen[-2] < gain:
            return h - 1, seen
    return largest, seen


def _merged(method: str, d: np.ndarray, i: int, j: int, size: np.ndarray, h: float) -> np.ndarray:
    """Distances of the union of i and j to all, after Lance and Williams."""
    a, b, x, y = size[i], size[j], d[i], d[j]
    if method == "single":
        return np.minimum(x, y)
    if method == "complete":
        return np.maximum(x, y)
    if method == "average":
        return (a * x + b * y) / (a + b)
    if method == "weighted":
        return (x + y) / 2
    with np.errstate(invalid="ignore"):
        if method == "ward":
            square = ((a + size) * x**2 + (b + size) * y**2 - size * h**2) / (a + b + size)
        elif method == "centroid":
            square = (a * x**2 + b * y**2) / (a + b) - a * b * h**2 / (a + b) ** 2
        elif method == "median":
            square = (x**2 + y**2) / 2 - h**2 / 4
        else:
            raise ValueError(f"no such method: {method}")
        return np.sqrt(np.maximum(square, 0.0))


def linkage(points: np.ndarray, method: str = "average") -> np.ndarray:
    """Rows (a, b, height, size) of agglomerative clustering of a group small enough for its distance matrix.

    Chains of nearest neighbours end in pairs that are each other's nearest; where merging can't bring others nearer (all
    methods but centroid and median) these merge at once, in a quadratic number of steps. The other two take the nearest pair
    by rows' minima. Merges come in the order of heights."""
    n = len(points)
    d = np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    size, live = np.ones(n), np.ones(n, bool)
    merges: list[tuple[int, int, float]] = []
    chain: list[int] = []
    near = d.argmin(1) if n else np.zeros(0, np.int64)
    while len(merges) < n - 1:
        if method in ("centroid", "median"):
            rows = np.flatnonzero(live)
            i = int(rows[np.argmin(d[rows, near[rows]])])
            j = int(near[i])
        else:
            if not chain:
                chain.append(int(np.flatnonzero(live)[0]))
            while True:
                i = chain[-1]
                j = int(np.argmin(d[i]))
                if len(chain) > 1 and d[i, chain[-2]] <= d[i, j]:
                    j = chain[-2]
                    break
                chain.append(j)
            del chain[-2:]
        i, j = min(i, j), max(i, j)
        h = float(d[i, j])
        merges.append((i, j, h))
        new = _merged(method, d, i, j, size, h)
        live[j] = False
        new[~live] = np.inf
        new[i] = np.inf
        d[i], d[:, i] = new, new
        d[j], d[:, j] = np.inf, np.inf
        size[i] += size[j]
        if method in ("centroid", "median"):
            stale = np.flatnonzero(live & ((near == i) | (near == j)))
            near[stale] = d[stale].argmin(1)
            closer = live & (d[:, i] < d[np.arange(n), near])
            near[closer] = i
            near[i] = int(d[i].argmin())
    # Names of clusters, and merges in the order of heights (as they came, where heights may fall).
    if method not in ("centroid", "median"):
        merges.sort(key=lambda m: m[2])
    name, count, out = list(range(n)), [1] * n, []
    parent = list(range(n))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for step, (i, j, h) in enumerate(merges):
        a, b = top(i), top(j)
        out.append((min(name[a], name[b]), max(name[a], name[b]), h, count[a] + count[b]))
        parent[b], name[a], count[a] = a, n + step, count[a] + count[b]
    return np.array(out) if out else np.zeros((0, 4))


def cluster_groups(rows: DataFrame, group: str, vector: str, method: str = "average") -> DataFrame:
    """group, step, a, b, height, size: a dendrogram for each group. A group must be small enough for one task."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_id")
        out = linkage(np.stack(pdf[vector].to_numpy()).astype(float), method)
        return pd.DataFrame({group: pdf[group].iloc[0], "step": np.arange(len(out)), "a": out[:, 0].astype(int), "b": out[:, 1].astype(int), "height": out[:, 2], "size": out[:, 3].astype(int)})

    kind = dict(rows.dtypes)[group]
    return rows.groupBy(group).applyInPandas(run, f"{group} {kind}, step long, a long, b long, height double, size long")
