"""Alignments: flags, mapping classes, pairing, pileups, hit counts.

Columns as in SAM: qname, flag, rname, pos (1-based), mapq, cigar, rnext, pnext, seq."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociflow.functions.sequence import reference_length
from lociflow.operators.intervals import inner_join, totals

# Flag bits.
PAIRED, PROPER, UNMAPPED, MATE_UNMAPPED, REVERSE, MATE_REVERSE, FIRST, SECOND, SECONDARY, FAILED, DUPLICATE = (1 << k for k in range(11))


def has(bit: int, flag: str = "flag") -> Column:
    return F.col(flag).bitwiseAND(F.lit(bit)) != 0


def scan(reads: DataFrame, region: tuple[str, int, int] | None = None, require: int = 0, exclude: int = 0, min_mapq: int = 0, simple_cigar: bool = False, columns: list[str] | None = None, tags: dict[str, list[str]] | None = None, predicate: Column | None = None) -> DataFrame:
    """Filters and projection of a scan; all of it reaches a Parquet source. tags: of each tag the values that are wanted; a
    record without it goes. predicate: any further condition."""
    t = reads if predicate is None else reads.where(predicate)
    for name, values in (tags or {}).items():
        t = t.where(F.try_element_at("tags", F.lit(name)).isin([str(v) for v in values]))
    if require:
        t = t.where(F.col("flag").bitwiseAND(F.lit(require)) == require)
    if exclude:
        t = t.where(F.col("flag").bitwiseAND(F.lit(exclude)) == 0)
    if min_mapq:
        t = t.where(F.col("mapq") >= min_mapq)
    if simple_cigar:
        t = t.where(F.col("cigar").rlike("^[0-9]+M$"))
    if region:
        chrom, start, end = region
        t = t.where((F.col("rname") == chrom) & (F.col("pos") <= end) & (F.col("pos") + reference_length(F.col("cigar")) > start))
    return t.select(*columns) if columns else t


def flag_summary(reads: DataFrame) -> DataFrame:
    bits = {"paired": PAIRED, "proper": PROPER, "unmapped": UNMAPPED, "reverse": REVERSE, "secondary": SECONDARY, "duplicate": DUPLICATE}
    return reads.agg(F.count(F.lit(1)).alias("records"), *(F.sum(has(b).cast("long")).alias(k) for k, b in bits.items()))


def mapping_state(xt: Column) -> Column:
    """Of a record and its XT tag: U, R, N, `unmapped`, or null where the tag is missing or unknown."""
    return F.when(has(UNMAPPED), "unmapped").when(xt.isin("U", "R", "N"), xt)


def count_regions(reads: DataFrame, regions: DataFrame, file: str | None = None, files: list[str] | None = None) -> DataFrame:
    """Records and bases of reads that start in each region(region_id, chrom, start, end), 0-based half-open. `file` names a
    column of the reads, `files` its values: a row for each region and file then."""
    n = F.coalesce(F.length("seq"), F.lit(0))
    own = [F.lit(True)] if file is None else [F.col(file) == v for v in files or []]
    cells = [(f"_records{k}", f"_bases{k}") for k in range(len(own))]
    of = [F.when(is_own, x).otherwise(0).cast("long").alias(c) for is_own, pair in zip(own, cells, strict=True) for c, x in zip(pair, (F.lit(1), n), strict=True)]
    points = reads.select(F.col("rname").alias("chrom"), (F.col("pos") - 1).alias("pos"), *of)
    within = regions.select("region_id", "chrom", F.col("start").cast("long").alias("start"), (F.col("end") - 1).cast("long").alias("end"))
    t = totals(within, points, ["chrom"], [c for pair in cells for c in pair])
    if file is None:
        return t.select("region_id", F.col("_records0").alias("records"), F.col("_bases0").alias("bases"))
    rows = [F.struct(F.lit(v).alias(file), F.col(r).alias("records"), F.col(b).alias("bases")) for v, (r, b) in zip(files or [], cells, strict=True)]
    return t.select("region_id", F.inline(F.array(*rows)))


def self_ligations(reads: DataFrame, most: int = 8000) -> DataFrame:
    return reads.where((F.col("rname") != "*") & ((F.col("rnext") == "=") | (F.col("rnext") == F.col("rname"))) & (F.abs(F.col("pos") - F.col("pnext")) <= most))


def to_pairs(reads: DataFrame) -> DataFrame:
    """Mapped pairs with both 5' ends; sides as they come."""
    shift = F.length("seq") - 1
    t = reads.where(F.col("flag").bitwiseAND(F.lit(UNMAPPED | MATE_UNMAPPED)) == 0)
    return t.select(
        F.col("qname").alias("read_id"), F.col("rname").alias("chr1"), F.when(has(REVERSE), F.col("pos") + shift).otherwise(F.col("pos")).alias("pos1"),
        F.when(F.col("rnext") == "=", F.col("rname")).otherwise(F.col("rnext")).alias("chr2"), F.when(has(MATE_REVERSE), F.col("pnext") + shift).otherwise(F.col("pnext")).alias("pos2"),
        F.when(has(REVERSE), "-").otherwise("+").alias("strand1"), F.when(has(MATE_REVERSE), "-").otherwise("+").alias("strand2"),
    )


def mates(reads: DataFrame) -> DataFrame:
    """qname, first, second: the primary records of both mates by name, as structs; null where one is missing."""
    t = reads.where(F.col("flag").bitwiseAND(F.lit(SECONDARY | 2048)) == 0)
    whole = F.struct(*(c for c in reads.columns if c != "qname"))
    one = F.when(has(FIRST), 1).when(has(SECOND), 2)
    return t.groupBy("qname").agg(*(F.min(F.when(one == k, whole)).alias(n) for k, n in ((1, "first"), (2, "second"))))


def unique_locus(mode: str = "mem") -> Column:
    """Of hit counts x0, x1 and scores y0, y1: whether a read has one best place."""
    few = F.col("x1") <= 10
    if mode == "aln":
        return (F.col("x0") == 1) & few
    return (F.col("x0") == 1) & (few | (F.col("y1") <= 0) | (F.try_divide(F.col("y1"), F.col("y0")) > 0.95))


def hit_counts(hits: DataFrame) -> DataFrame:
    """qname, x0, x1: how many alignments have the best and the second best score."""
    rank = F.dense_rank().over(Window.partitionBy("qname").orderBy(F.desc("score")))
    return hits.withColumn("_r", rank).groupBy("qname").agg(*(F.sum((F.col("_r") == k + 1).cast("long")).alias(f"x{k}") for k in (0, 1)))


def pair_tags(tags: DataFrame) -> DataFrame:
    """Of up to four tags of a pair (pair_id, read 1|2, tag 1|2, state U|R|N|., rname): the state of both anchors and class.

    Anchor 1 is read 1's first tag, read 2's second stands in; anchor 2 the other way round."""
    at = lambda r, t, c: F.max(F.when((F.col("read") == r) & (F.col("tag") == t), F.col(c)))
    pick = lambda a, b: F.when(a.isin("U"), a).when(b.isin("U"), b).when(a.isin("R") | b.isin("R"), F.lit("R")).otherwise(F.coalesce(a, b, F.lit(".")))
    t = tags.groupBy("pair_id").agg(*(at(r, k, c).alias(f"{c}{r}{k}") for r in (1, 2) for k in (1, 2) for c in ("state", "rname")))
    s = {x: F.col(f"state{x}") for x in ("11", "12", "21", "22")}
    apart = lambda a, b: (F.col(f"state{a}") == "U") & (F.col(f"state{b}") == "U") & (F.col(f"rname{a}") != F.col(f"rname{b}"))
    torn = F.coalesce(apart("11", "22") | apart("21", "12"), F.lit(False))
    one, two = pick(s["11"], s["22"]), pick(s["21"], s["12"])
    kind = F.when(torn, "discordant").when((one == "U") & (two == "U"), "UU").when((one == "U") | (two == "U"), "UxxU").when((one == "N") & (two == "N"), "nn").otherwise("xx")
    return t.select("pair_id", one.alias("anchor1"), two.alias("anchor2"), kind.alias("class"))


def pileup(
    reads: DataFrame, by_strand: bool = True, min_mapq: int = 0, min_depth: int = 1, by_base: bool = True, min_base_quality: int = 0, max_depth: int | None = None, min_minor: int = 0,
    deletions: bool = True, insertions: bool = False, cycle_bins: list[int] | None = None, from_left: bool = False, order: str = "qname",
) -> DataFrame:
    """Bases over each reference position: rname, pos, base[, strand][, bin], n.

    Deletions count as `-`, and where asked for insertions as `+` at the base before them; clips don't. min_base_quality takes
    bases whose quality (33 and up) reaches it. cycle_bins are edges: place p of a read, from its 5' end or from the left,
    is in bin k if edges[k] < p <= edges[k + 1], and left out of all. max_depth takes a position's first records in `order`;
    min_minor, positions where all bases but the commonest are that many."""
    ops = F.regexp_extract_all("cigar", F.lit("([0-9]+)[MIDNSHP=X]"), F.lit(1))
    kinds = F.regexp_extract_all("cigar", F.lit("[0-9]+([MIDNSHP=X])"), F.lit(1))
    t = reads.where((F.col("mapq") >= min_mapq) & ~has(UNMAPPED)).withColumn("_ops", F.arrays_zip(F.transform(ops, lambda x: x.cast("int")).alias("len"), kinds.alias("op")))
    # Each operation with where it begins on the read and on the reference.
    fold = F.aggregate(
        "_ops",
        F.struct(F.lit(1).alias("q"), F.col("pos").cast("int").alias("r"), F.array().cast("array<struct<op:string,len:int,q:int,r:int>>").alias("out")),
        lambda a, x: F.struct(
            (a["q"] + F.when(x["op"].isin("M", "I", "S", "=", "X"), x["len"]).otherwise(0)).alias("q"),
            (a["r"] + F.when(x["op"].isin("M", "D", "N", "=", "X"), x["len"]).otherwise(0)).alias("r"),
            F.array_append(a["out"], F.struct(x["op"].alias("op"), x["len"].alias("len"), a["q"].alias("q"), a["r"].alias("r"))).alias("out"),
        ),
    )
    wanted = ["M", "=", "X"] + ["D"] * deletions + ["I"] * insertions
    extra = (["qual"] if min_base_quality else []) + ([order] if max_depth else [])
    each = t.select("rname", F.when(has(REVERSE), "-").otherwise("+").alias("strand"), "seq", *extra, F.explode(fold["out"]).alias("o")).where(F.col("o.op").isin(wanted))
    one = F.col("o.op") == "I"  # an insertion is one symbol, at the base before it
    each = each.withColumn("k", F.explode(F.sequence(F.lit(0), F.when(one, 0).otherwise(F.col("o.len") - 1))))
    base = F.when(F.col("o.op") == "D", "-").when(one, "+").otherwise(F.substring("seq", F.col("o.q") + F.col("k"), F.lit(1)))
    at = F.when(one, F.col("o.r") - 1).otherwise(F.col("o.r") + F.col("k"))
    place = F.when(F.col("o.op").isin("D", "I"), F.col("o.q") - 1).otherwise(F.col("o.q") + F.col("k"))
    each = each.withColumns({"pos": at, "base": base, "_place": place})
    if min_base_quality:
        each = each.where(F.col("base").isin("-", "+") | (F.ascii(F.substring("qual", F.col("_place"), F.lit(1))) - 33 >= min_base_quality))
    if cycle_bins:
        cycle = F.col("_place") if from_left else F.when(F.col("strand") == "-", F.length("seq") - F.col("_place") + 1).otherwise(F.col("_place"))
        each = each.withColumn("bin", F.coalesce(*(F.when((cycle > a) & (cycle <= b), F.lit(k)) for k, (a, b) in enumerate(zip(cycle_bins[:-1], cycle_bins[1:], strict=True))))).where("bin IS NOT NULL")
    if max_depth:
        each = each.withColumn("_nth", F.row_number().over(Window.partitionBy("rname", "pos").orderBy(order, "strand"))).where(F.col("_nth") <= max_depth)
    keys = ["rname", "pos"] + ["base"] * by_base + ["strand"] * by_strand + ["bin"] * bool(cycle_bins)
    counted = each.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    if min_depth > 1 or min_minor:
        by_letter = each.groupBy("rname", "pos", "base").agg(F.count(F.lit(1)).alias("n")).groupBy("rname", "pos").agg(F.sum("n").alias("_d"), F.max("n").alias("_top"))
        counted = counted.join(by_letter.where((F.col("_d") >= min_depth) & (F.col("_d") - F.col("_top") >= min_minor)), ["rname", "pos"], "left_semi")
    return counted


def apply_pileups(piles: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str, window: int = 10_000) -> DataFrame:
    """A user's function over windows of positions."""
    return piles.withColumn("window", F.floor(F.col("pos") / window)).groupBy("rname", "window").applyInPandas(function, schema)


def merged(*tables: DataFrame) -> DataFrame:
    """Records of several files in the order of places; unplaced ones last."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out.orderBy(F.col("rname") == "*", "rname", "pos")


def adjust_anchors(anchors: DataFrame, depth: DataFrame) -> DataFrame:
    """anchor_id, start, end of each anchor's run of greatest depth, the nearest to its mid-point of equals, then the first.

    depth(chrom, start, end, depth) holds runs, as `intervals.coverage` returns them."""
    hits = inner_join(anchors.select("anchor_id", "chrom", "start", "end"), depth, ["chrom"])
    start, end = F.greatest("l_start", "r_start"), F.least("l_end", "r_end")
    away = F.abs((start + end) / 2 - (F.col("l_start") + F.col("l_end")) / 2)
    best = hits.groupBy(F.col("l_anchor_id").alias("anchor_id")).agg(F.min(F.struct((-F.col("r_depth")).alias("d"), away.alias("away"), start.alias("start"), end.alias("end"))).alias("b"))
    return best.select("anchor_id", F.col("b.start").alias("start"), F.greatest(F.col("b.end"), F.col("b.start") + 1).alias("end"))
