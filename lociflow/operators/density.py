"""Tag densities: smoothed profiles, fold over a control, crowded positions; peaks, broad clusters and binding positions.

Tags: chrom, pos, strand (+ or -). Every window around a tag is an interval, and how many tags a place has in its windows is a depth:
several depths come out of one pass over the positions (`intervals.layers`), so windows of any width cost the same.

* Peaks. The depth of fragments against the greatest of several local rates and the genome's, Poisson p-values and step-up
  q-values over bases, worked out once for each depth and background that occur.
* Broad clusters. z-scores of wide windows against a scaled control; clusters grow at a rim and need a seed.
* Binding positions. Forward tags before and reverse tags behind a place, less those on the wrong side; local maxima; the rate
  of false ones from tags that are redrawn by a hash.

They follow their public descriptions; the programs themselves aren't in the inventory."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociflow.functions.lineage import kept
from lociflow.functions.statistics import poisson_p, step_up
from lociflow.operators.intervals import coverage, inner_join, layers, merge, number_islands


def smoothed(tags: DataFrame, step: int = 100, bandwidth: int = 200) -> DataFrame:
    """chrom, bin, density: a Gaussian kernel over counts of bins of `step` bases, cut at three bandwidths."""
    reach = -(-3 * bandwidth // step)
    counts = tags.groupBy("chrom", F.floor(F.col("pos") / step).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    near = counts.withColumn("_d", F.explode(F.sequence(F.lit(-reach), F.lit(reach))))
    kernel = F.exp(-F.pow(F.col("_d") * step / bandwidth, 2) / 2) / (bandwidth * math.sqrt(2 * math.pi))
    return near.groupBy("chrom", (F.col("bin") + F.col("_d")).alias("bin")).agg(F.sum(F.col("n") * kernel).alias("density"))


def fold_profile(tags: DataFrame, control: DataFrame, width: int = 1000, z: float = 1.0, pseudo: float = 1.0) -> DataFrame:
    """chrom, bin, signal, background, fold (the likeliest) and least_fold (the lower end, z deviations on either side), the
    control scaled to the tags' number. Bins without tags and control aren't listed."""
    count = lambda t, s, c: t.groupBy("chrom", F.floor(F.col("pos") / width).alias("bin")).agg(F.sum(F.lit(s)).alias("signal"), F.sum(F.lit(c)).alias("background"))
    both = count(tags, 1, 0).unionByName(count(control, 0, 1)).groupBy("chrom", "bin").agg(F.sum("signal").alias("signal"), F.sum("background").alias("background"))
    n, m = tags.count(), control.count()  # two numbers
    scale = n / m if m else 1.0
    s, c = F.col("signal") + pseudo, (F.col("background") + pseudo) * scale
    low = F.greatest(s - z * F.sqrt(s), F.lit(0.0)) / (c + z * F.sqrt(c))
    return both.withColumns({"fold": s / c, "least_fold": low})


def cross_correlation(tags: DataFrame, most: int = 500, step: int = 10) -> DataFrame:
    """shift, n: pairs of a forward and a reverse tag so far apart; its peak tells of the fragments' length."""
    count = lambda s: tags.where(F.col("strand") == s).groupBy("chrom", F.floor(F.col("pos") / step).alias("bin")).agg(F.count(F.lit(1)).alias(f"n{s}"))
    forward = count("+").withColumn("shift", F.explode(F.sequence(F.lit(0), F.lit(most // step))))
    forward = forward.select("chrom", (F.col("bin") + F.col("shift")).alias("bin"), "shift", "n+")
    t = forward.join(count("-"), ["chrom", "bin"]).groupBy("shift").agg(F.sum(F.col("`n+`") * F.col("`n-`")).alias("n"))
    return t.select((F.col("shift") * step).alias("shift"), "n")


def without_anomalies(tags: DataFrame, width: int = 200, factor: float = 5.0) -> DataFrame:
    """Tags at positions that don't hold more than `factor` times the mean of their window's positions (and one more)."""
    at = tags.groupBy("chrom", "strand", "pos").agg(F.count(F.lit(1)).alias("_n")).withColumn("_window", F.floor(F.col("pos") / width))
    mean = at.groupBy("chrom", "_window").agg(F.avg("_n").alias("_mean"))
    odd = at.join(mean, ["chrom", "_window"]).where(F.col("_n") > factor * F.col("_mean") + 1).select("chrom", "strand", "pos")
    return tags.join(odd, ["chrom", "strand", "pos"], "left_anti")


def informative(tags: DataFrame, strand: str | None = None, least: int = 1) -> DataFrame:
    """Tags of one strand, or both, at positions that hold at least so many."""
    t = tags if strand is None else tags.where(F.col("strand") == strand)
    if least <= 1:
        return t
    held = t.groupBy("chrom", "strand", "pos").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least).drop("_n")
    return t.join(held, ["chrom", "strand", "pos"], "left_semi")


def poisson_cutoff(mean: float, p: float) -> int:
    """The least k with P(X >= k) <= p."""
    term = tail = math.exp(-mean)
    k, upto = 1, tail
    while 1 - upto > p:
        term *= mean / k
        upto += term
        k += 1
    return k


def call_peaks(intervals: DataFrame, genome: int, p: float = 1e-5, gap: int = 0, least: int = 1) -> DataFrame:
    """chrom, start, end, height of regions in which the depth of `intervals`(chrom, start, end) reaches the Poisson cutoff of
    their mean depth over `genome` bases; regions up to `gap` apart are one, those shorter than `least` go."""
    bases = intervals.agg(F.sum(F.col("end") - F.col("start"))).first()[0] or 0  # one number
    cutoff = poisson_cutoff(bases / genome, p)
    high = coverage(intervals, ["chrom"]).where(F.col("depth") >= cutoff)
    spread = high.select("chrom", "start", (F.col("end") + gap).alias("end"), "depth")
    peaks = merge(spread, ["chrom"]).select("chrom", "start", (F.col("end") - gap).alias("end")).where(F.col("end") - F.col("start") >= least)
    top = inner_join(peaks, high, ["chrom"]).groupBy(F.col("l_chrom").alias("chrom"), F.col("l_start").alias("start"), F.col("l_end").alias("end")).agg(F.max("r_depth").alias("height"))
    return top


def fragments(tags: DataFrame, length: int) -> DataFrame:
    """chrom, start, end of the fragment that begins at each tag's 5' end and goes on along its strand."""
    forward = F.col("strand") == "+"
    start = F.greatest(F.when(forward, F.col("pos")).otherwise(F.col("pos") - length + 1), F.lit(0))
    return tags.select("chrom", start.alias("start"), F.when(forward, F.col("pos") + length).otherwise(F.col("pos") + 1).alias("end"))


def _around(tags: DataFrame, width: int, layer: int, shift: int = 0) -> DataFrame:
    """The places x whose window [x - width / 2, x + width / 2) holds the tag, moved by `shift` along its strand."""
    at = F.col("pos") + F.when(F.col("strand") == "+", shift).otherwise(-shift)
    start = at - width // 2 + (1 - width % 2)
    return tags.select("chrom", F.greatest(start, F.lit(0)).alias("start"), F.greatest(start + width, F.lit(0)).alias("end"), F.lit(layer).alias("layer"))


def local_enrichment(tags: DataFrame, genome: int, control: DataFrame | None = None, length: int = 200, windows: tuple[int, ...] = (1000, 10_000)) -> DataFrame:
    """chrom, start, end, depth, background, pvalue, qvalue: runs of places with fragments.

    background: the depth that is expected there, the greatest of the rates of tags in windows around the place, and over the whole
    genome. Rates are the control's, scaled to the tags' number, and a window as wide as a fragment is one of them; without a control
    they're the tags' own, and then the widest window alone tells. q-values count bases of the genome."""
    n = tags.count()  # two numbers
    other = control if control is not None else tags
    scale = n / (control.count() or 1) if control is not None else 1.0
    widths = sorted({length, *windows}) if control is not None else [max(windows)]
    t = fragments(tags, length).withColumn("layer", F.lit(0))
    for k, w in enumerate(widths, 1):
        t = t.union(_around(other, w, k))
    names = ["depth", *(f"n{k}" for k in range(1, len(widths) + 1))]
    runs = kept(layers(t, ["chrom"], names).where("depth > 0"))
    rates = [F.col(f"n{k}") * (scale * length / w) for k, w in enumerate(widths, 1)]
    background = F.greatest(F.lit(n * length / genome), *rates)
    kinds = runs.groupBy(*names).agg(F.sum(F.col("end") - F.col("start")).alias("bases")).withColumn("background", background)
    tested = step_up(kept(kinds.withColumn("pvalue", poisson_p("depth", "background"))), "pvalue", "bases", genome).drop("bases")
    return runs.join(tested, names).select("chrom", "start", "end", "depth", "background", "pvalue", "qvalue")


def local_peaks(tags: DataFrame, genome: int, control: DataFrame | None = None, q: float = 0.05, length: int = 200, gap: int = 50, windows: tuple[int, ...] = (1000, 10_000)) -> DataFrame:
    """chrom, start, end, summit, height, background, pvalue, qvalue of peaks: places with a q-value of at most `q`, joined over gaps of
    up to `gap`, at least a fragment long. The summit is the middle of the deepest run, the least p-value and the first of equals, and
    tells background, p and q."""
    good = kept(local_enrichment(tags, genome, control, length, windows).where(F.col("qvalue") <= q))
    t = number_islands(good.withColumn("_reach", F.col("end") + gap), ["chrom"], "start", "_reach", "_peak")
    at = F.struct(F.col("depth"), -F.col("pvalue"), -F.col("start"))
    top = F.max_by(F.struct(F.floor((F.col("start") + F.col("end")) / 2).alias("summit"), F.col("depth").alias("height"), "background", "pvalue", "qvalue"), at).alias("top")
    peaks = t.groupBy("chrom", "_peak").agg(F.min("start").alias("start"), F.max("end").alias("end"), top).where(F.col("end") - F.col("start") >= length)
    return peaks.select("chrom", "start", "end", "top.*")


def broad_clusters(tags: DataFrame, control: DataFrame, window: int = 1000, shift: int = 0, seed: float = 6.0, rim: float = 3.0) -> DataFrame:
    """chrom, start, end, z: runs of places whose window's z-score is at least `rim`, with one of at least `seed`; z is the greatest.

    Tags are moved by `shift` along their strand. The control is scaled by k = tags / controls, and z = (s - k c) / sqrt(s + k^2 c)."""
    k = tags.count() / (control.count() or 1)  # two numbers
    t = layers(_around(tags, window, 0, shift).union(_around(control, window, 1, shift)), ["chrom"], ["s", "c"])
    z = F.when(F.col("s") > 0, (F.col("s") - k * F.col("c")) / F.sqrt(F.col("s") + k * k * F.col("c"))).otherwise(F.lit(0.0))
    high = kept(t.withColumn("z", z).where(F.col("z") >= rim))
    joined = number_islands(high, ["chrom"], "start", "end", "_cluster")
    return joined.groupBy("chrom", "_cluster").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("z").alias("z")).where(F.col("z") >= seed).drop("_cluster")


def binding_scores(tags: DataFrame, separation: int, half: int) -> DataFrame:
    """chrom, start, end, score of runs of places with tags on their right sides: 2 sqrt(forward before * reverse behind) less forward
    behind and reverse before. Sides are windows of `half` bases around half the separation before and behind a place."""
    away = separation // 2
    side = lambda d, layer: F.struct(F.greatest(F.col("pos") + d - half, F.lit(0)).alias("start"), F.greatest(F.col("pos") + d + half + 1, F.lit(0)).alias("end"), F.lit(layer).alias("layer"))
    forward, reverse = F.array(side(away, 0), side(-away, 1)), F.array(side(-away, 2), side(away, 3))
    t = tags.select("chrom", F.inline(F.when(F.col("strand") == "+", forward).otherwise(reverse)))
    runs = layers(t, ["chrom"], ["fb", "fa", "ra", "rb"]).where("fb > 0 AND ra > 0")
    return runs.select("chrom", "start", "end", (2 * F.sqrt((F.col("fb") * F.col("ra")).cast("double")) - F.col("fa") - F.col("rb")).alias("score"))


def local_maxima(runs: DataFrame, distance: int) -> DataFrame:
    """The runs (chrom, start, end, score) than which none within `distance` is better: of a greater score, or of an equal one and
    earlier. Places are the runs' middles.

    Of a bin as wide as the distance only the best can stay; it's compared with the runs of its own and the bins on both sides."""
    t = runs.withColumn("pos", F.floor((F.col("start") + F.col("end") - 1) / 2)).withColumn("_bin", F.floor(F.col("pos") / distance))
    best = t.groupBy("chrom", "_bin").agg(F.max_by(F.struct("pos", "score"), F.struct(F.col("score"), -F.col("pos"))).alias("b")).select("chrom", "b.*", "_bin")
    near = best.withColumn("_near", F.explode(F.array(F.col("_bin") - 1, F.col("_bin") + 1)))
    others = t.select(F.col("chrom").alias("_chrom"), F.col("_bin").alias("_other"), F.col("pos").alias("_pos"), F.col("score").alias("_score"))
    better = (F.col("_score") > F.col("score")) | ((F.col("_score") == F.col("score")) & (F.col("_pos") < F.col("pos")))
    beaten = near.join(others, (F.col("chrom") == F.col("_chrom")) & (F.col("_near") == F.col("_other")) & (F.abs(F.col("pos") - F.col("_pos")) <= distance) & better, "left_semi")
    return best.join(beaten.select("chrom", "_bin").distinct(), ["chrom", "_bin"], "left_anti").select("chrom", "pos", "score")


def _drawn(seed: int, key: str) -> Column:
    """A number below 16 ** 12 from a hash of the seed and `key`."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), 1, 12), 16, 10).cast("long")


def redrawn(tags: DataFrame, lengths: dict[str, int], seed: int = 1, key: str = "id") -> DataFrame:
    """Tags on their own strand at places that a hash of the seed and `key` draws from the whole chromosome (a row of `lengths` each)."""
    length = F.element_at(F.create_map(*(F.lit(x) for item in lengths.items() for x in item)), F.col("chrom"))
    return tags.withColumn("pos", _drawn(seed, key) % length)


def binding_positions(tags: DataFrame, lengths: dict[str, int], separation: int, half: int, distance: int | None = None, fdr: float = 0.01, least: float = 1.0, seed: int = 1, key: str = "id") -> DataFrame:
    """chrom, pos, score, fdr of point binding positions: local maxima of the score, from the least score on whose rate of false ones is
    within `fdr`. The rate at a score is that of positions among redrawn tags to positions among the tags."""
    distance = distance or separation
    found = [local_maxima(binding_scores(t, separation, half).where(F.col("score") >= least), distance) for t in (tags, redrawn(tags, lengths, seed, key))]
    real = kept(found[0])
    at = real.groupBy("score").agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("false"))
    at = at.union(found[1].groupBy("score").agg(F.lit(0).cast("long"), F.count(F.lit(1)))).groupBy("score").agg(F.sum("n").alias("n"), F.sum("false").alias("false"))
    down = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)  # a row a score that occurs
    rates = kept(at.select("score", "n", (F.sum("false").over(down) / F.greatest(F.sum("n").over(down), F.lit(1))).alias("fdr")))
    cutoff = rates.where((F.col("n") > 0) & (F.col("fdr") <= fdr)).agg(F.min("score")).first()[0]  # one number
    return real.join(rates.select("score", "fdr"), "score").where(F.col("score") >= F.lit(cutoff).cast("double")).select("chrom", "pos", "score", "fdr")


def separation_of(correlation: DataFrame, least: int = 0) -> int:
    """The shift at which forward and reverse tags meet most, the smallest of equals: one number."""
    top = correlation.where(F.col("shift") >= least).orderBy(F.desc("n"), "shift").first()
    return int(top["shift"]) if top else 0


def nested_counts(tags: DataFrame, control: DataFrame, shares: tuple[float, ...], width: int = 1000, seed: int = 1, key: str = "id") -> DataFrame:
    """chrom, bin, background, and signal1, signal2, ...: tags of each bin in nested subsamples, one for each of the growing `shares`.

    A tag's hash puts it into every subsample whose share is above it, so one pass counts them all."""
    drawn = _drawn(seed, key)
    names = [f"signal{k}" for k in range(1, len(shares) + 1)]
    at = F.floor(F.col("pos") / width).alias("bin")
    own = tags.select("chrom", at, F.lit(0).alias("background"), *((drawn < math.floor(f * 16**12)).cast("int").alias(n) for n, f in zip(names, shares, strict=True)))
    other = control.select("chrom", at, F.lit(1).alias("background"), *(F.lit(0).alias(n) for n in names))
    return own.union(other).groupBy("chrom", "bin").agg(*(F.sum(c).alias(c) for c in ("background", *names)))


def saturation(tags: DataFrame, control: DataFrame, shares: tuple[float, ...] = (0.5, 0.6, 0.7, 0.8, 0.9, 1.0), width: int = 1000, p: float = 1e-3, accept: float = 0.99, seed: int = 1, key: str = "id") -> DataFrame:
    """depth, tags, mser: of each subsample but the first its number of tags and its minimal saturated enrichment ratio.

    A bin is found in a subsample if its count has a Poisson p-value of at most `p` over the scaled control (and one more). The ratio is the least
    fold, in tenths, from which on `accept` of the bins found were found in the subsample before; null if there is none. Its
    dependency on the number of tags: `interpolated`. Folds that occur are few, so the running sums see a row for each."""
    names = [f"signal{k}" for k in range(1, len(shares) + 1)]
    t = kept(nested_counts(tags, control, shares, width, seed, key))
    totals = t.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("background", *names))).first()  # a number a subsample
    expected = [(F.col("background") + 1) * (totals[n] / (totals["background"] or 1)) for n in names]
    fold = lambda n, e: F.floor(10 * F.col(n) / e)
    each = F.array(*(F.struct(F.col(n).alias("n"), e.alias("mean"), fold(n, e).alias("fold"), F.lit(k).alias("depth")) for k, (n, e) in enumerate(zip(names, expected, strict=True))))
    found = t.select("chrom", "bin", F.inline(each)).where((F.col("n") > 0) & (F.col("n") > F.col("mean"))).withColumn("p", poisson_p("n", "mean")).where(F.col("p") <= p)
    before = F.lag("depth").over(Window.partitionBy("chrom", "bin").orderBy("depth"))
    counts = found.select("depth", "fold", F.coalesce(before == F.col("depth") - 1, F.lit(False)).cast("int").alias("again")).where("depth > 0")
    counts = counts.groupBy("depth", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("again").alias("again"))
    down = Window.partitionBy("depth").orderBy(F.desc("fold")).rowsBetween(Window.unboundedPreceding, 0)
    share = F.sum("again").over(down) / F.sum("n").over(down)
    least = counts.withColumn("share", share).groupBy("depth").agg(F.min(F.when(F.col("share") >= accept, F.col("fold"))).alias("mser"))
    sizes = tags.sparkSession.createDataFrame([(k, int(totals[n])) for k, n in enumerate(names)][1:], "depth int, tags long")
    return sizes.join(least, "depth", "left").select("depth", "tags", (F.col("mser") / 10).alias("mser"))


def interpolated(ratios: DataFrame, tags: int) -> float | None:
    """The ratio that a line through log(tags), log(mser) of a few subsamples has at a number of tags."""
    points = [(math.log(r["tags"]), math.log(r["mser"])) for r in ratios.collect() if r["mser"]]  # a row a subsample
    if len(points) < 2:
        return math.exp(points[0][1]) if points else None
    x, y = (sum(v) / len(points) for v in zip(*points, strict=True))
    spread = sum((a - x) ** 2 for a, _ in points)
    slope = sum((a - x) * (b - y) for a, b in points) / spread if spread else 0.0
    return math.exp(y + slope * (math.log(tags) - x))
