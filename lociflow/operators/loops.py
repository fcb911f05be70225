"""Loops (cis clusters): filters, anchors, annotation by peaks, replicates, domains.

Columns: loop_id, chrom, s1, e1, s2, e2, n."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociflow.functions.lineage import kept
from lociflow.functions.overlap import Overlap
from lociflow.operators.intervals import coverage, inner_join, merge, semi_join


def loops_of(clusters: DataFrame, min_count: int = 2) -> DataFrame:
    """Cis clusters of enough tags, numbered by place. Numbers within a chromosome start after those of the ones before."""
    cis = kept(clusters.where((F.col("tid") == F.col("mtid")) & (F.col("n") >= min_count)))  # few, and read twice
    order = [F.col(c) for c in ("s1", "e1", "s2", "e2", "island1", "island2")]
    counts = cis.groupBy("tid").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("tid", F.coalesce(F.sum("_n").over(Window.orderBy("tid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    t = cis.join(before, "tid")  # a row per chromosome, however many there are
    number = F.col("_before") + F.row_number().over(Window.partitionBy("tid").orderBy(*order))
    return t.select(number.alias("loop_id"), F.concat(F.lit("chr"), F.col("tid")).alias("chrom"), "s1", "e1", "s2", "e2", "n")


def min_count(loops: DataFrame, least: int = 3) -> DataFrame:
    return loops.where(F.col("n") >= least)


def min_span(loops: DataFrame, least: int = 50_000) -> DataFrame:
    return loops.where(F.abs((F.col("s2") + F.col("e2")) / 2 - (F.col("s1") + F.col("e1")) / 2) >= least)


def anchors(loops: DataFrame) -> DataFrame:
    """Two rows a loop: loop_id, side, anchor_id, chrom, start, end."""
    side = lambda k: F.struct(F.lit(k).alias("side"), F.greatest(F.col(f"s{k}"), F.lit(0)).alias("start"), F.col(f"e{k}").alias("end"))
    t = loops.select("loop_id", "chrom", F.inline(F.array(side(1), side(2))))
    return t.withColumn("anchor_id", F.concat_ws("_", F.col("loop_id").cast("string"), F.col("side").cast("string")))


def midpoints(loops: DataFrame, least: int = 2) -> DataFrame:
    return loops.where(F.col("n") >= least).select("loop_id", "chrom", F.floor((F.col("s1") + F.col("e1")) / 2).alias("start"), F.floor((F.col("s2") + F.col("e2")) / 2).alias("end"), "n")


def browser_rows(loops: DataFrame, half: int = 100) -> DataFrame:
    """Two rows a loop around the anchors' mid-points, each naming its partner and score."""
    m1, m2 = (F.floor((F.col(f"s{k}") + F.col(f"e{k}")) / 2) for k in (1, 2))
    row = lambda a, b, k: F.struct(
        (a - half).alias("start"), (a + half).alias("end"), F.concat(F.col("chrom"), F.lit(":"), b - half, F.lit("-"), b + half, F.lit(","), F.col("n")).alias("partner"), (F.col("loop_id") * 2 - 1 + k).alias("id")
    )
    return loops.select("chrom", F.inline(F.array(row(m1, m2, 0), row(m2, m1, 1))))


def peak_support(loops: DataFrame, peaks: DataFrame) -> DataFrame:
    """Adds how many of a loop's anchors overlap a peak."""
    hit = semi_join(anchors(loops), peaks, ["chrom"], "anchor_id").groupBy("loop_id").agg(F.count(F.lit(1)).alias("peak_support"))
    return loops.join(hit, "loop_id", "left").withColumn("peak_support", F.coalesce("peak_support", F.lit(0)))


def regulatory_class(loops: DataFrame, enhancers: DataFrame, promoters: DataFrame) -> DataFrame:
    """loop_id, class of loops whose both anchors are annotated: PP before EP before PE; two enhancers give none."""
    both = anchors(loops)
    marks = [semi_join(both, x, ["chrom"], "anchor_id").select("loop_id", F.concat(F.lit(kind), F.col("side")).alias("mark")) for kind, x in (("E", enhancers), ("P", promoters))]
    flags = marks[0].union(marks[1]).groupBy("loop_id").agg(*(F.max((F.col("mark") == m).cast("int")).alias(m) for m in ("E1", "E2", "P1", "P2")))
    kind = F.when((F.col("P1") + F.col("P2")) == 2, "PP").when((F.col("E1") + F.col("P2")) == 2, "EP").when((F.col("P1") + F.col("E2")) == 2, "PE")
    return flags.select("loop_id", kind.alias("class")).where(F.col("class").isNotNull())


def shared_loops(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs of loops whose left anchors overlap and whose right anchors overlap."""
    one = inner_join(a.withColumnsRenamed({"s1": "start", "e1": "end"}), b.withColumnsRenamed({"s1": "start", "e1": "end"}), ["chrom"])
    return one.where((F.col("l_s2") < F.col("r_e2")) & (F.col("r_s2") < F.col("l_e2"))).select(F.col("l_loop_id").alias("loop_a"), F.col("r_loop_id").alias("loop_b"))


def unshared_loops(a: DataFrame, b: DataFrame) -> DataFrame:
    """Loops of a that share no loop of b."""
    return a.join(shared_loops(a, b).select(F.col("loop_a").alias("loop_id")).distinct(), "loop_id", "left_anti")


def shared_summary(a: DataFrame, b: DataFrame) -> DataFrame:
    t = shared_loops(a, b).agg(F.count(F.lit(1)).alias("pairs"), F.countDistinct("loop_a").alias("a"), F.countDistinct("loop_b").alias("b"))
    return t.select("pairs", F.least("a", "b").alias("unique_loops"))


def first_peak(loops: DataFrame, peaks: DataFrame) -> DataFrame:
    """Each anchor with the first peak (by start, end, id) that it overlaps, or null."""
    both = anchors(loops)
    hits = inner_join(both.select("anchor_id", "chrom", "start", "end"), peaks.select("id", "chrom", "start", "end"), ["chrom"], Overlap.CLOSED)
    first = hits.groupBy(F.col("l_anchor_id").alias("anchor_id")).agg(F.min(F.struct("r_start", "r_end", "r_id")).alias("_f"))
    return both.join(first, "anchor_id", "left").select("anchor_id", F.col("_f.r_id").alias("peak_id"))


def anchor_heights(loops: DataFrame, intervals: DataFrame) -> DataFrame:
    """The greatest depth of `intervals` over each anchor, 0 where there is none."""
    both = anchors(loops)
    depth = coverage(intervals, ["chrom"])
    top = inner_join(both.select("anchor_id", "chrom", "start", "end"), depth, ["chrom"]).groupBy(F.col("l_anchor_id").alias("anchor_id")).agg(F.max("r_depth").alias("height"))
    return both.join(top, "anchor_id", "left").select("anchor_id", F.coalesce("height", F.lit(0)).alias("height"))


def rank_cutoff(values: DataFrame, value: str = "n", share: float = 0.67) -> DataFrame:
    """One row, `cutoff`: the value at rank floor(rows * share) in ascending order, 0 if that rank is 0.

    Distinct values are counted first, so that the running count sees a row for each of them."""
    counts = values.groupBy(F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    order = Window.orderBy("value")
    t = counts.withColumn("upto", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("rank", F.floor(F.sum("n").over(Window.partitionBy()) * share))
    return t.agg(F.coalesce(F.min(F.when((F.col("upto") >= F.col("rank")) & (F.col("rank") >= 1), F.col("value"))), F.lit(0)).alias("cutoff"))


def domains(loops: DataFrame, share: float = 0.67, least: int = 25_000, peaks: DataFrame | None = None) -> DataFrame:
    """Contact domains: merged mid-point spans of the loops at or above the rank cutoff that are longer than `least`."""
    cutoff = rank_cutoff(loops, "n", share).first()["cutoff"]  # one number
    strong = midpoints(loops, cutoff).drop("n")
    return merge(strong, ["chrom"]).withColumn("span", F.col("end") - F.col("start")).where(F.col("span") > least)
