"""Significance of loops against the decay of contacts with distance.

Segments are a chromosome's anchors by mid-point. Pairs of segments within a band of distances have an expected count from
a spline over equal-count distance quantiles; a noncentral hypergeometric tail gives a p-value, a bisection the cutoff;
false positives are summed over all pairs of the band.

The fit lists no pairs. A chromosome's segments are dealt in tiles with a rim as wide as the band. How many pairs have each
distance comes from differences to the next, the next but one, ... segment, added up by distance in the task. What is expected of a segment with
all others is a sum of cubics of distances, one for each pair of neighbouring knots: it follows from the sums of the others'
mid-points to the powers 0 to 3 between the two places, differences of prefix sums. Those are integers modulo 2 ** 64, exact since
no piece's own sum reaches that."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociflow.functions.lineage import kept
from lociflow.functions.statistics import Spline, noncentral_p, noncentral_steps, odds

QUANTILES = 500
#: Least expected count of a pair.
LEAST_EXPECTED = 1e-20
#: Tiles are as wide as so many bands.
TILE_BANDS = 4
#: Widest run of distances of one cubic: the sum of so many cubes of distances stays below 2 ** 63.
WIDEST = 1 << 15


def segments(loops: DataFrame) -> DataFrame:
    """chrom, mid of all anchors."""
    mids = [F.floor((F.col(f"s{k}") + F.col(f"e{k}")) / 2) for k in (1, 2)]
    return loops.select("chrom", F.explode(F.array(*mids)).alias("mid")).distinct()


def observed(loops: DataFrame) -> DataFrame:
    """chrom, i < j (mid-points), n."""
    a, b = (F.floor((F.col(f"s{k}") + F.col(f"e{k}")) / 2) for k in (1, 2))
    return loops.select("chrom", F.least(a, b).alias("i"), F.greatest(a, b).alias("j"), "n").groupBy("chrom", "i", "j").agg(F.sum("n").alias("n"))


def marginals(pairs: DataFrame, value: str = "n") -> DataFrame:
    """chrom, mid, total: sums over the symmetric matrix of which `pairs` holds the upper triangle."""
    both = pairs.select("chrom", F.inline(F.array(F.struct(F.col("i").alias("mid"), F.col(value).alias("v")), F.struct(F.col("j").alias("mid"), F.col(value).alias("v")))))
    return both.groupBy("chrom", "mid").agg(F.sum("v").alias("total"))


def band_pairs(points: DataFrame, least: int, most: int) -> DataFrame:
    """All pairs of a chromosome's segments whose distance lies in [least, most]: an equi-join on bins of a quarter of `most`."""
    width = max(1, most // 4)
    reach = F.sequence(F.floor((F.col("mid") + least) / width), F.floor((F.col("mid") + most) / width))
    a = points.select("chrom", F.col("mid").alias("i"), F.explode(reach).alias("_bin"))
    b = points.select("chrom", F.col("mid").alias("j"), F.floor(F.col("mid") / width).alias("_bin"))
    return a.join(b, ["chrom", "_bin"]).withColumn("delta", F.col("j") - F.col("i")).where((F.col("delta") >= least) & (F.col("delta") <= most)).drop("_bin")


def _tiled(points: DataFrame, most: int) -> DataFrame:
    """chrom, tile, mid, own: each tile's segments, and those of its rim (not own)."""
    width = TILE_BANDS * max(most, 1)
    tiles = F.sequence(F.floor((F.col("mid") - most) / width), F.floor((F.col("mid") + most) / width))
    return points.select("chrom", "mid", F.explode(tiles).alias("tile")).withColumn("own", F.floor(F.col("mid") / width) == F.col("tile"))


def distance_counts(points: DataFrame, least: int, most: int) -> DataFrame:
    """delta, n: how many pairs of a chromosome's segments have each distance in [least, most]. At most a row a distance and task
    is shuffled."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("mid")
        mid = group["mid"].to_numpy(np.int64)
        counts = np.zeros(most + 1, np.int64)
        at, step = np.flatnonzero(group["own"].to_numpy(bool)), 0
        while len(at):
            step += 1
            at = at[at + step < len(mid)]
            delta = mid[at + step] - mid[at]
            near = delta <= most
            at, delta = at[near], delta[near]
            counts += np.bincount(delta, minlength=most + 1)
        found = np.flatnonzero(counts[least:]) + least
        return pd.DataFrame({"delta": found, "n": counts[found]})

    if least == 0:
        run_least = distance_counts(points, 1, most)
        own = points.agg(F.lit(0).cast("long").alias("delta"), F.count(F.lit(1)).alias("n"))
        return run_least.union(own).where("n > 0")
    parts = _tiled(points, most).groupBy("chrom", "tile").applyInPandas(run, "delta long, n long")
    return parts.groupBy("delta").agg(F.sum("n").alias("n"))


def range_sums(mid: np.ndarray, at: np.ndarray, pieces: list[tuple[int, int, np.ndarray]]) -> np.ndarray:
    """Of each place in `at` the sum over sorted `mid` of the cubic of the distance to the right."""
    m = mid.astype(np.uint64)
    prefix = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(p, dtype=np.uint64))) for p in (np.ones_like(m), m, m * m, m * m * m)]
    out = np.zeros(len(at))
    for start, stop, cubic in pieces:
        low, high = np.searchsorted(mid, at + start), np.searchsorted(mid, at + stop)
        s0, s1, s2, s3 = (p[high] - p[low] for p in prefix)
        # Sums of (mid - base) to the powers 0 to 3.
        base = (at + start).astype(np.uint64)
        t1 = s1 - base * s0
        t2 = s2 - np.uint64(2) * base * s1 + base * base * s0
        t3 = s3 - np.uint64(3) * base * s2 + np.uint64(3) * base * base * s1 - base * base * base * s0
        for power, total in zip(cubic, (s0, t1, t2, t3), strict=True):
            out += power * total.view(np.int64)
    return out


def expected_sums(points: DataFrame, curve: Spline, least: int, most: int) -> DataFrame:
    """chrom, mid, total: of each segment what is expected of all its pairs in the band."""
    pieces = curve.pieces(least, most, WIDEST)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("mid")
        mid, own = group["mid"].to_numpy(np.int64), group["own"].to_numpy(bool)
        origin = mid[0]
        right = mid - origin
        left = (right[-1] - right)[::-1].copy()
        total = range_sums(right, right[own], pieces) + range_sums(left, left[::-1][own], pieces)
        return pd.DataFrame({"chrom": group["chrom"].to_numpy()[own], "mid": mid[own], "total": total})

    kind = dict(points.dtypes)
    return _tiled(points, most).groupBy("chrom", "tile").applyInPandas(run, f"chrom {kind['chrom']}, mid {kind['mid']}, total double")


def distance_quantiles(counts: DataFrame, quantiles: int = QUANTILES) -> DataFrame:
    """quantile, low, high, median, pairs of chunks of equally many distances, from `distance_counts`; a remainder widens the last one only."""
    return _chunks(counts, quantiles)


def _chunks(counts: DataFrame, quantiles: int) -> DataFrame:
    order = Window.orderBy("delta").rowsBetween(Window.unboundedPreceding, 0)
    t = counts.withColumn("upto", F.sum("n").over(order)).withColumn("_size", F.greatest(F.floor(F.sum("n").over(Window.partitionBy()) / quantiles), F.lit(1)))
    t = t.withColumn("first", F.col("upto") - F.col("n"))
    last = F.lit(quantiles - 1)
    spread = t.withColumn("quantile", F.explode(F.sequence(F.least(F.floor(F.col("first") / F.col("_size")), last), F.least(F.floor((F.col("upto") - 1) / F.col("_size")), last))))
    middle = F.col("quantile") * F.col("_size") + F.floor((F.col("_size") - 1) / 2)
    upper = F.col("quantile") * F.col("_size") + F.floor(F.col("_size") / 2)
    has = lambda r: (F.col("first") <= r) & (r < F.col("upto"))
    inside = F.least("upto", F.when(F.col("quantile") == last, F.col("upto")).otherwise((F.col("quantile") + 1) * F.col("_size"))) - F.greatest("first", F.col("quantile") * F.col("_size"))
    q = spread.groupBy("quantile").agg(
        F.min("delta").alias("low"), F.max("delta").alias("high"), F.max(F.when(has(middle), F.col("delta"))).alias("_m"), F.max(F.when(has(upper), F.col("delta"))).alias("_u"), F.sum(inside).alias("pairs")
    )
    return q.select("quantile", "low", "high", F.floor((F.col("_m") + F.col("_u")) / 2).alias("median"), "pairs")


def decay(counts: DataFrame, seen: DataFrame, quantiles: int = QUANTILES) -> DataFrame:
    """median, mean: the mean count of a quantile's pairs, those without contacts included. At most `quantiles` rows.

    A distance that reaches over several chunks counts in the first of them, so a chunk in which no distance begins (its upper
    edge is the one before) has no row."""
    return _decay(counts, seen, quantiles)


def _decay(counts: DataFrame, seen: DataFrame, quantiles: int) -> DataFrame:
    pairs = counts.select("delta", F.col("n").alias("pairs"), F.lit(0).cast("long").alias("n"))
    sums = seen.groupBy((F.col("j") - F.col("i")).alias("delta")).agg(F.lit(0).cast("long").alias("pairs"), F.sum("n").cast("long").alias("n"))
    by_delta = pairs.unionByName(sums).groupBy("delta").agg(F.sum("pairs").alias("pairs"), F.sum("n").alias("n")).where("pairs > 0")
    upto = F.sum("pairs").over(Window.orderBy("delta").rowsBetween(Window.unboundedPreceding, -1))
    size = F.greatest(F.floor(F.sum("pairs").over(Window.partitionBy()) / quantiles), F.lit(1))
    first = by_delta.withColumn("quantile", F.least(F.floor(F.coalesce(upto, F.lit(0)) / size), F.lit(quantiles - 1)))
    mean = first.groupBy("quantile").agg((F.sum("n") / F.sum("pairs")).alias("mean"))
    return mean.join(_chunks(counts, quantiles).select("quantile", "median"), "quantile").groupBy("median").agg(F.avg("mean").alias("mean"))


def _fit(seen: DataFrame, points: DataFrame, counts: DataFrame, least: int, most: int, quantiles: int, masked: DataFrame | None = None) -> Callable[[DataFrame], DataFrame]:
    """What adds expected, _ni, _nj, _total and _odds to pairs of the band, of which `counts` holds delta, n. `seen` is what was
    observed. Masked pairs don't take part in the decay. Totals are each chromosome's."""
    free, within = counts, seen
    if masked is not None:
        gone = masked.groupBy((F.col("j") - F.col("i")).alias("delta")).agg((-F.count(F.lit(1))).alias("n"))
        free = counts.unionByName(gone).groupBy("delta").agg(F.sum("n").alias("n")).where("n > 0")
        within = seen.join(masked.select("chrom", "i", "j"), ["chrom", "i", "j"], "left_anti")
    knots = _decay(free, within, quantiles).orderBy("median").collect()  # a row per quantile
    curve = Spline([r["median"] for r in knots], [r["mean"] for r in knots]) if knots else Spline([0.0], [0.0])

    @F.pandas_udf("double")
    def expected(delta: pd.Series) -> pd.Series:
        return pd.Series(np.maximum(curve(delta.to_numpy()), LEAST_EXPECTED))

    sums = expected_sums(points, curve, least, most).join(marginals(seen).withColumnRenamed("total", "_n"), ["chrom", "mid"])
    sides = kept(sums)  # a row a segment
    all_seen = seen.groupBy("chrom").agg((2 * F.sum("n")).alias("_total"))
    totals = sides.groupBy("chrom").agg((F.sum("total") / 2).alias("_expected")).join(all_seen, "chrom")

    def add(t: DataFrame) -> DataFrame:
        t = t.withColumn("expected", expected("delta")).join(totals, "chrom")
        for k in "ij":
            t = t.join(sides.select("chrom", F.col("mid").alias(k), F.col("_n").alias(f"_n{k}"), F.col("total").alias(f"_l{k}")), ["chrom", k])
        return t.withColumn("_odds", odds(F.col("expected"), F.col("_li"), F.col("_lj"), F.col("_expected")))

    return add


def _tested(seen: DataFrame, least: int, most: int, add: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The observed pairs of the band: their ends are segments, so their distance tells."""
    t = add(seen.withColumn("delta", F.col("j") - F.col("i")).where((F.col("delta") >= least) & (F.col("delta") <= most)))
    p = noncentral_p(F.col("n"), F.col("_ni"), F.col("_nj"), F.col("_total"), F.col("_odds"))
    return t.select("chrom", "i", "j", "n", "expected", p.alias("pvalue"))


def _points_of(seen: DataFrame, least: int, most: int) -> tuple[DataFrame, DataFrame]:
    """The segments, and how many pairs of them have each distance of the band."""
    points = kept(seen.select("chrom", F.explode(F.array("i", "j")).alias("mid")).distinct())
    return points, kept(distance_counts(points, least, most))


def p_values(loops: DataFrame, least: int = 0, most: int = 1_000_000, quantiles: int = QUANTILES) -> DataFrame:
    """chrom, i, j, n, expected, pvalue of the observed pairs within the band."""
    seen = kept(observed(loops))  # read by the knots, the sums and the test
    points, counts = _points_of(seen, least, most)
    return _tested(seen, least, most, _fit(seen, points, counts, least, most, quantiles))


def tails(fitted: DataFrame, fdr: float, least_count: int = 3, steps: int = 22) -> DataFrame:
    """tail, weight: P(X >= c) and P(X = c) of every pair of the band and c >= least_count, pairs without contacts included.

    With c the least count whose tail is at most alpha, P(X >= c) is the sum of the weights whose tail is at most alpha.
    Counts below the smallest alpha of a search are one row a pair; tails above `fdr` are never asked for."""
    smallest = fdr / 100 / 2.0 ** (steps - 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            counts = [pdf[c].to_numpy().astype(np.int64) for c in ("_ni", "_nj", "_total")]
            tail, weight = noncentral_steps(*counts, pdf["_odds"].to_numpy(float), least_count, smallest, fdr)
            yield pd.DataFrame({"tail": tail, "weight": weight})

    # Without odds (their denominator vanishes) a pair isn't tested.
    return fitted.where(F.col("_odds").isNotNull()).select("_ni", "_nj", "_total", "_odds").mapInPandas(run, "tail double, weight double")


def error_counts(tested: DataFrame, tail: DataFrame, alpha: float, least_count: int = 3) -> DataFrame:
    """One row: positives (observed pairs of enough contacts and a p-value of at most alpha) and false_positives (summed over
    all pairs of the band)."""
    hits = tested.where((F.col("n") >= least_count) & (F.col("pvalue") <= alpha)).select(F.lit(1).alias("hit"), F.lit(0.0).alias("weight"))
    false = tail.where(F.col("tail") <= alpha).select(F.lit(0).alias("hit"), "weight")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return hits.unionByName(false).agg(total("hit").alias("positives"), total("weight").alias("false_positives"))


def fdr_cutoff(tested: DataFrame, fdr: float = 0.05, least_count: int = 3, steps: int = 22, tail: DataFrame | None = None) -> float:
    """The largest p-value cutoff of a bisection below which false positives / positives stay within the rate.

    `tail` has the tails of the whole band; where it isn't given, each of the tested pairs counts as alpha false positives.
    The search starts at fdr / 100 and ends when positives grow no more. Each step is an aggregate; nothing but sums comes
    to the driver."""
    strong = tested.where(F.col("n") >= least_count)
    tests, attainable = tested.count() if tail is None else 0, strong.count()
    low, high, alpha, most, rates = 0.0, fdr / 100, fdr / 100, 0, {}
    for step in range(steps):
        hits = strong.where(F.col("pvalue") <= alpha).count()
        false = alpha * tests if tail is None else tail.where(F.col("tail") <= alpha).agg(F.sum("weight")).first()[0] or 0.0
        rates[alpha] = false / hits if hits else 0.0
        if rates[alpha] >= fdr:
            high = alpha
        else:
            low, high = alpha, fdr if step == 0 else high
            if step and (hits <= most or hits == attainable):
                break
            most = hits
        alpha = (low + high) / 2
    found = 0.0
    for alpha in sorted(rates):
        if rates[alpha] > fdr:
            break
        found = alpha
    return found


def significant(tested: DataFrame, fdr: float = 0.05, least_count: int = 3, tail: DataFrame | None = None) -> DataFrame:
    return tested.where((F.col("n") >= least_count) & (F.col("pvalue") <= fdr_cutoff(tested, fdr, least_count, tail=tail)))


def refined(loops: DataFrame, least: int = 0, most: int = 1_000_000, quantiles: int = QUANTILES, fdr: float = 0.05, refine_fdr: float = 0.01, least_count: int = 3) -> DataFrame:
    """Significant pairs in two rounds: those of the first, at `refine_fdr`, are masked when the decay is fitted again.

    Tables that steps read again are cut from their plans, which would otherwise grow with each and fill the driver."""
    seen = kept(observed(loops))
    points, counts = _points_of(seen, least, most)
    masked = None
    for rate in (refine_fdr, fdr):
        add = _fit(seen, points, counts, least, most, quantiles, masked)
        tested, tail = kept(_tested(seen, least, most, add)), kept(tails(add(band_pairs(points, least, most)), rate, least_count))
        masked = significant(tested, rate, least_count, tail)
    return masked
