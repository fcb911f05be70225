"""Distributions and corrections that Spark has no function for."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType
from pyspark.sql.window import Window


@F.pandas_udf(DoubleType())
def binomial_half(a: pd.Series, b: pd.Series) -> pd.Series:
    """Two-sided binomial test of a against b at one half, null where a count is. Each pair of counts is worked out once a
    batch."""
    pairs = pd.DataFrame({"a": a, "b": b})
    known = pairs.dropna().drop_duplicates()
    tails = []
    for x, y in known.itertuples(index=False):
        n, k = int(x + y), int(min(x, y))
        i = np.arange(k, dtype=float)
        log = np.concatenate((np.zeros(1), np.cumsum(np.log((n - i) / (i + 1))))) - n * math.log(2)
        tails.append(1.0 if x == y else min(1.0, 2 * float(np.exp(log).sum())))
    return pairs.merge(known.assign(p=tails), how="left", on=["a", "b"])["p"].astype(float)


def _noncentral(row: int, column: int, total: int, odds: float) -> tuple[int, np.ndarray]:
    """The least count that Fisher's noncentral hypergeometric distribution allows, and the weights from there on."""
    low, high = max(0, row + column - total), min(row, column)
    k = np.arange(low, high, dtype=float)
    log = np.concatenate((np.zeros(1), np.cumsum(np.log((row - k) * (column - k) / ((k + 1) * (total - row - column + k + 1)) * odds))))
    weight = np.exp(log - log.max())
    return low, weight / weight.sum()


def noncentral_tail(n: int, row: int, column: int, total: int, odds: float) -> float:
    """P(X >= n) for Fisher's noncentral hypergeometric distribution: of `total` draws `row` are marked, `column` taken."""
    low, weight = _noncentral(row, column, total, odds)
    return 1.0 if n <= low else float(min(1.0, weight[n - low :].sum()))


def _tables(row: np.ndarray, column: np.ndarray, total: np.ndarray, odds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of the same distribution for many arguments at once: their places, the least counts, and P(X = c) from there on, a row
    each. Arguments with about as many counts are worked out together."""
    low, high = np.maximum(0, row + column - total), np.minimum(row, column)
    size = high - low + 1
    for width in np.unique(1 << np.ceil(np.log2(np.maximum(size, 1))).astype(int)):
        some = np.flatnonzero((size <= width) & (2 * size > width))
        for i in range(0, len(some), max(1, (1 << 20) // width)):
            at = some[i : i + max(1, (1 << 20) // width)]
            k = low[at, None] + np.arange(width - 1)[None, :]
            r, c, n, o = (x[at, None] for x in (row, column, total, odds))
            inside = k < high[at, None]
            with np.errstate(divide="ignore", invalid="ignore"):
                steps = np.where(inside, np.log((r - k) * (c - k) / ((k + 1.0) * (n - r - c + k + 1)) * o), -np.inf)
            log = np.concatenate((np.zeros((len(at), 1)), np.cumsum(steps, 1)), 1)
            weight = np.exp(log - log.max(1, keepdims=True))
            yield at, low[at], weight / weight.sum(1, keepdims=True)


def noncentral_tails(n: np.ndarray, row: np.ndarray, column: np.ndarray, total: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """P(X >= n) for many arguments at once."""
    out = np.ones(len(n))
    for at, low, weight in _tables(row, column, total, odds):
        tail = weight[:, ::-1].cumsum(1)[:, ::-1]
        place = n[at] - low
        out[at] = np.where(place <= 0, 1.0, np.where(place < tail.shape[1], np.take_along_axis(tail, np.clip(place, 0, tail.shape[1] - 1)[:, None], 1)[:, 0], 0.0))
    return np.minimum(out, 1.0)


def noncentral_steps(row: np.ndarray, column: np.ndarray, total: np.ndarray, odds: np.ndarray, least: int, smallest: float, largest: float) -> tuple[np.ndarray, np.ndarray]:
    """P(X >= c) and P(X = c), for many arguments at once, of all c >= least where the first is at most `largest`; the counts
    where it is at most `smallest` are one entry of each argument."""
    tails, weights = [], []
    for _, low, weight in _tables(row, column, total, odds):
        tail = weight[:, ::-1].cumsum(1)[:, ::-1]
        wanted = (np.arange(tail.shape[1])[None, :] + low[:, None] >= least) & (tail > 0)
        deep = wanted & (tail <= smallest)
        first_deep = deep & (np.cumsum(deep, 1) == 1)
        use = ((wanted & ~deep) | first_deep) & (tail <= largest)
        tails.append(tail[use])
        weights.append(np.where(first_deep, tail, weight)[use])
    return (np.concatenate(tails), np.concatenate(weights)) if tails else (np.zeros(0), np.zeros(0))


@F.pandas_udf(DoubleType())
def noncentral_p(n: pd.Series, row: pd.Series, column: pd.Series, total: pd.Series, odds: pd.Series) -> pd.Series:
    """P(X >= n), 1 without odds, null where a count is."""
    table = pd.DataFrame({"n": n, "row": row, "column": column, "total": total, "odds": odds})
    known = table.dropna()
    counts = [known[c].to_numpy().astype(np.int64) for c in ("n", "row", "column", "total")]
    p = pd.Series(noncentral_tails(*counts, known["odds"].to_numpy(float)), known.index).reindex(table.index)
    return p.where(table["odds"].notna() | table.drop(columns="odds").isna().any(axis=1), 1.0)


def _poisson_terms(k: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """P(X = k) for k > 0, as a deviance and Stirling's error: k * log(mean) and log(k!) would cancel, and lose digits as k grows."""
    off, x = (k - mean) / mean, k.astype(float)
    near = np.minimum(off, 1.0)
    deviance = np.where(off > 1, x * (np.log(x) - np.log(mean)) + mean - x, mean * ((1 + near) * np.log1p(near) - near))
    small = np.array([0.0, *(math.lgamma(j + 1) - (j + 0.5) * math.log(j) + j - 0.5 * math.log(2 * math.pi) for j in range(1, 16))])
    series = (1 / 12 - (1 / 360 - (1 / 1260 - 1 / (1680 * x * x)) / (x * x)) / (x * x)) / x
    return np.exp(-deviance - np.where(k < 16, small[np.minimum(k, 15)], series)) / np.sqrt(2 * math.pi * x)


def poisson_tails(n: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """P(X >= n) of Poisson distributions. Above the mean the tail's own terms are summed, so that small values stay exact."""
    n, mean = np.asarray(n, np.int64), np.asarray(mean, float)
    out = np.ones(len(n))
    some = np.flatnonzero((n > 0) & (mean > 0))
    k, m = n[some], mean[some]
    with np.errstate(under="ignore"):
        term = _poisson_terms(k, m)
        up = k > m
        total, part, j = np.where(up, term, 0.0), np.where(up, term, 0.0), k.astype(float)
        while (part > total * 1e-17).any():
            j += 1
            part = part * m / j
            total += part
        low, part, j = np.zeros(len(k)), np.where(up, 0.0, term), k.astype(float)
        while (part > 1e-18).any():
            part = np.where(j > 0, part * j / m, 0.0)
            j -= 1
            low += part
    out[some] = np.where(up, total, np.clip(1 - low, 0, 1))
    out[(n > 0) & (mean <= 0)] = 0.0
    return out


@F.pandas_udf(DoubleType())
def poisson_p(n: pd.Series, mean: pd.Series) -> pd.Series:
    """P(X >= n), null where one is."""
    known = n.notna() & mean.notna()
    return pd.Series(poisson_tails(n[known].to_numpy(), mean[known].to_numpy()), n[known].index).reindex(n.index)


def _tile_of(p: Column) -> Column:
    """A tile of p, in its order: by thousandths, and by powers where p is small."""
    return F.when(p >= 0.01, F.floor(p * 1000)).otherwise(F.floor(F.log(F.greatest(p, F.lit(1e-300))) * 20) - 1000)


def hochberg(df: DataFrame, p: str, order: str, name: str = "padj") -> DataFrame:
    """Adds Hochberg's step-up adjusted p-values: the running least of k * p, k counted from the largest p. Null stays null.

    Equal p get the same value, that of the first of them, so windows see a row for each distinct p: within tiles of p
    first, then what the tiles of larger p add."""
    counts = df.where(F.col(p).isNotNull()).groupBy(F.col(p).alias("_p")).agg(F.count(F.lit(1)).alias("_n")).withColumn("_tile", _tile_of(F.col("_p")))
    desc = Window.partitionBy("_tile").orderBy(F.desc("_p"))
    above = Window.orderBy(F.desc("_tile")).rowsBetween(Window.unboundedPreceding, -1)
    sizes = counts.groupBy("_tile").agg(F.sum("_n").alias("_n"))
    sizes = sizes.select("_tile", F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_before"))
    k = F.col("_before") + F.coalesce(F.sum("_n").over(desc.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1
    t = counts.join(sizes, "_tile").withColumn("_v", k * F.col("_p"))
    best = t.groupBy("_tile").agg(F.min("_v").alias("_m")).select("_tile", F.min("_m").over(above).alias("_least"))
    t = t.withColumn("_run", F.min("_v").over(desc.rowsBetween(Window.unboundedPreceding, 0))).join(best, "_tile")
    t = t.select("_p", F.least(F.lit(1.0), "_run", F.coalesce("_least", "_run")).alias("_adjusted"))
    return df.join(t, F.col(p) == F.col("_p"), "left").select(*df.columns, F.col("_adjusted").alias(name))


def step_up(df: DataFrame, p: str, weight: str, total: float, name: str = "qvalue") -> DataFrame:
    """Adds step-up q-values: the least over all p' >= p of p' * total / (weight of the rows with at most p'), 1 at most.

    Equal p get the same value. Windows see a row for each distinct p: within tiles of p first, then what the tiles add."""
    counts = df.where(F.col(p).isNotNull()).groupBy(F.col(p).alias("_p")).agg(F.sum(weight).alias("_w")).withColumn("_tile", _tile_of(F.col("_p")))
    up, below = Window.partitionBy("_tile").orderBy("_p"), Window.orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
    sizes = counts.groupBy("_tile").agg(F.sum("_w").alias("_w"))
    sizes = sizes.select("_tile", F.coalesce(F.sum("_w").over(below), F.lit(0)).alias("_before"))
    rank = F.col("_before") + F.sum("_w").over(up.rowsBetween(Window.unboundedPreceding, 0))
    t = counts.join(sizes, "_tile").withColumn("_v", F.col("_p") * F.lit(float(total)) / rank)
    above = Window.orderBy(F.desc("_tile")).rowsBetween(Window.unboundedPreceding, -1)
    best = t.groupBy("_tile").agg(F.min("_v").alias("_m")).select("_tile", F.min("_m").over(above).alias("_least"))
    t = t.withColumn("_run", F.min("_v").over(up.rowsBetween(0, Window.unboundedFollowing))).join(best, "_tile")
    t = t.select("_p", F.least(F.lit(1.0), "_run", F.coalesce("_least", "_run")).alias("_q"))
    return df.join(t, F.col(p) == F.col("_p"), "left").select(*df.columns, F.col("_q").alias(name))


class Spline:
    """A natural cubic spline through a few hundred knots; beyond them it goes on in a straight line."""

    def __init__(self, x: list[float], y: list[float]):
        self.x, self.y = x_, y_ = np.asarray(x, float), np.asarray(y, float)
        n = len(x_)
        self.second = np.zeros(n)
        if n < 3:
            self.left = self.right = (y_[1] - y_[0]) / (x_[1] - x_[0]) if n == 2 else 0.0
            return
        h = np.diff(x_)
        a = np.zeros((n, n))
        b = np.zeros(n)
        a[0, 0] = a[-1, -1] = 1
        for i in range(1, n - 1):
            a[i, i - 1 : i + 2] = h[i - 1], 2 * (h[i - 1] + h[i]), h[i]
            b[i] = 6 * ((y_[i + 1] - y_[i]) / h[i] - (y_[i] - y_[i - 1]) / h[i - 1])
        self.second = m = np.linalg.solve(a, b)
        self.left = (y_[1] - y_[0]) / h[0] - h[0] * m[1] / 6
        self.right = (y_[-1] - y_[-2]) / h[-1] + h[-1] * m[-2] / 6

    def _powers(self) -> np.ndarray:
        """Of the line before the knots, of each piece and of the line behind: coefficients of t ** 0 .. 3 from its start on."""
        x, y, m, h = self.x, self.y, self.second, np.diff(self.x)
        inner = np.stack((y[:-1], np.diff(y) / h - h * (2 * m[:-1] + m[1:]) / 6, m[:-1] / 2, np.diff(m) / (6 * h)), 1)
        return np.concatenate(([[y[0], self.left, 0, 0]], inner, [[y[-1], self.right, 0, 0]]))

    def __call__(self, t: np.ndarray) -> np.ndarray:
        t = np.asarray(t, float)
        i = np.searchsorted(self.x, t, "right")
        u = t - self.x[np.maximum(i - 1, 0)]
        a, b, c, d = self._powers()[i].T
        return a + u * (b + u * (c + u * d))

    def pieces(self, low: int, high: int, widest: int) -> list[tuple[int, int, np.ndarray]]:
        """Integers low .. high in runs [start, stop) of at most `widest`, none over a knot, each with its coefficients from start on."""
        cuts = sorted({low, high + 1, *(int(np.ceil(k)) for k in self.x if low < np.ceil(k) <= high)})
        cuts = [c for a, b in zip(cuts[:-1], cuts[1:], strict=True) for c in range(a, b, widest)] + cuts[-1:]
        out, powers = [], self._powers()
        for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
            i = int(np.searchsorted(self.x, start, "right"))
            u = start - self.x[max(i - 1, 0)]
            a, b, c, d = powers[i]
            out.append((start, stop, np.array([a + u * (b + u * (c + u * d)), b + u * (2 * c + 3 * u * d), c + 3 * u * d, d])))
        return out


def odds(pair: Column, left: Column, right: Column, total: Column, least: float = 0.1) -> Column:
    """Of expected values of a pair, its two sides and all: the odds, null where the denominator vanishes."""
    below = (left - pair) * (right - pair)
    return F.when(below > 1e-20, F.greatest(pair * (2 * total - left - right + pair) / below, F.lit(least)))
