"""Paired-end tags: canonical order, duplicates, spans, extension, clusters.

Columns: tid, pos, endpos, strand of the first tag and mtid, mpos, mendpos, mstrand of the second; 0 is the forward strand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociflow.functions.lineage import counted, kept
from lociflow.functions.overlap import centre_span, outer_span
from lociflow.operators.graphs import components
from lociflow.operators.intervals import number_sides

SIDES = (("tid", "mtid"), ("pos", "mpos"), ("endpos", "mendpos"), ("strand", "mstrand"))
DUPLICATE_KEYS = ["tid", "pos", "endpos", "mtid", "mpos", "mendpos", "strand", "mstrand"]
LINKER_KEYS = ["class", "final_linker", "linker", "mlinker"]
SELF_LIGATION = 8000


def canonicalise(pets: DataFrame) -> DataFrame:
    """The tag that comes first in the genome is the first tag."""
    swap = (F.col("tid") > F.col("mtid")) | ((F.col("tid") == F.col("mtid")) & ((F.col("pos") > F.col("mpos")) | ((F.col("pos") == F.col("mpos")) & (F.col("endpos") > F.col("mendpos")))))
    new = {}
    for a, b in (s for s in (*SIDES, ("linker", "mlinker")) if s[0] in pets.columns):
        new[a], new[b] = F.when(swap, F.col(b)).otherwise(F.col(a)), F.when(swap, F.col(a)).otherwise(F.col(b))
    return pets.withColumns(new)


def drop_duplicates(pets: DataFrame, keys: list[str] | None = None, best: str = "qual", order: str = "pet_id", unmapped: int = -1) -> DataFrame:
    """Of canonical tags with equal keys the best stays, the first of equals. Adds copies.

    The keys are both places and strands, and where the tags have them the class, the final linker and each read's linker.
    Tags of which neither side is mapped (chromosome `unmapped`) are duplicates all."""
    keys = keys or DUPLICATE_KEYS + [c for c in LINKER_KEYS if c in pets.columns]
    pets = pets.where((F.col("tid") != unmapped) | (F.col("mtid") != unmapped))
    others = [c for c in pets.columns if c not in keys]
    top = F.max_by(F.struct(*others), F.struct(F.least(F.col(best), F.lit(127)).alias("best"), (-F.col(order)).alias("order")))
    out = canonicalise(pets).groupBy(*keys).agg(top.alias("_top"), F.count(F.lit(1)).alias("copies"))
    return out.select(*keys, "_top.*", "copies")


def complexity(pets: DataFrame) -> DataFrame:
    """One row: all tags, those left without duplicates, redundancy."""
    t = drop_duplicates(pets).agg(F.sum("copies").alias("pets"), F.count(F.lit(1)).alias("unique_pets"))
    return t.withColumn("redundancy", F.try_divide(F.col("pets") - F.col("unique_pets"), F.col("pets")))


def span() -> Column:
    return outer_span(*map(F.col, ("pos", "endpos", "mpos", "mendpos")))


def ligation_class(threshold: int = SELF_LIGATION) -> Column:
    return F.when(F.col("tid") != F.col("mtid"), "trans").when(span() < threshold, "self").otherwise("intra")


def span_classes(pets: DataFrame, threshold: int = SELF_LIGATION, min_quality: int = 20) -> DataFrame:
    """Tags of each ligation class that pass and fail the quality."""
    ok = F.col("qual") >= min_quality
    return pets.groupBy(ligation_class(threshold).alias("class")).agg(F.sum(ok.cast("long")).alias("passed"), F.sum((~ok).cast("long")).alias("failed"))


def orientation() -> Column:
    return F.concat(F.when(F.col("strand") == 0, "+").otherwise("-"), F.when(F.col("mstrand") == 0, "+").otherwise("-"))


def orientation_counts(pets: DataFrame) -> DataFrame:
    return pets.groupBy(ligation_class().alias("class"), orientation().alias("orientation")).agg(F.count(F.lit(1)).alias("n"))


def span_histogram(pets: DataFrame, lower: int = 1, upper: int = 100_000, bins: int = 1000, by: tuple[str, ...] = ()) -> DataFrame:
    """Spans of cis tags by bin (-1 below, `bins` above) with a column for each orientation; `by` adds columns to group by, such
    as the linker's class."""
    width = (upper - lower + 1) / bins
    place = F.floor((F.abs(span()) - lower) / F.lit(float(width)) + 0.5)
    bin_ = F.when(place < 0, -1).when(place >= bins, bins).otherwise(place).cast("long")
    t = pets.where("tid = mtid").withColumn("_o", orientation()).groupBy(*by, bin_.alias("bin")).pivot("_o", ["++", "+-", "-+", "--"])
    t = t.agg(F.count(F.lit(1)))
    return t.select(*by, "bin", *(F.coalesce(F.col(f"`{o}`"), F.lit(0)).cast("long").alias(n) for o, n in (("++", "ff"), ("+-", "fr"), ("-+", "rf"), ("--", "rr"))))


def extend(pets: DataFrame, upstream: int = 250, downstream: int = 250, lengths: DataFrame | None = None, anchor: str = "tag") -> DataFrame:
    """Adds windows s1, e1, s2, e2 around both tags, each from its 5' end's side, clamped to the chromosome.

    lengths(tid, length) clamps the ends too; it has a row per chromosome. anchor: what is extended, the whole `tag`, its
    `five` prime end or its `middle`."""
    if anchor not in ("tag", "five", "middle"):
        raise ValueError(f"no such anchor: {anchor}")

    def window(pos: str, end: str, strand: str) -> tuple[Column, Column]:
        forward = F.col(strand) == 0
        if anchor != "tag":
            at = F.floor((F.col(pos) + F.col(end)) / 2) if anchor == "middle" else F.when(forward, F.col(pos)).otherwise(F.col(end))
            return F.greatest(at - F.when(forward, upstream).otherwise(downstream), F.lit(0)), at + F.when(forward, downstream).otherwise(upstream)
        low = F.col(pos) - F.when(forward, upstream).otherwise(downstream)
        return F.greatest(low, F.lit(0)), F.col(end) + F.when(forward, downstream).otherwise(upstream)

    s1, e1 = window("pos", "endpos", "strand")
    s2, e2 = window("mpos", "mendpos", "mstrand")
    out = pets.withColumns({"s1": s1, "e1": e1, "s2": s2, "e2": e2})
    if lengths is not None:
        for t, e in (("tid", "e1"), ("mtid", "e2")):
            limit = lengths.select(F.col("tid").alias(t), F.col("length").alias("_length"))
            out = out.join(limit, t, "left").withColumn(e, F.least(F.col(e), F.coalesce("_length", F.col(e)))).drop("_length")
    cis = F.col("tid") == F.col("mtid")
    return out.withColumns({"s2": F.when(cis, F.greatest("s2", "s1")).otherwise(F.col("s2")), "e1": F.when(cis, F.least("e1", "e2")).otherwise(F.col("e1"))})


def usable(threshold: int = SELF_LIGATION) -> Column:
    return (F.col("tid") != F.col("mtid")) | (centre_span(*map(F.col, ("pos", "endpos", "mpos", "mendpos"))) > threshold)


def first_pass_bins(extended: DataFrame) -> DataFrame:
    """Adds island1 and island2: runs of overlapping windows on either side, within a pair of chromosomes."""
    return number_sides(extended, ["tid", "mtid"], {"island1": ("s1", "e1"), "island2": ("s2", "e2")})


def first_pass_clusters(extended: DataFrame) -> DataFrame:
    """Tags whose both sides share an island: tid, mtid, the bounding boxes, n."""
    box = [F.min("s1").alias("s1"), F.max("e1").alias("e1"), F.min("s2").alias("s2"), F.max("e2").alias("e2")]
    return first_pass_bins(extended).groupBy("tid", "mtid", "island1", "island2").agg(*box, F.count(F.lit(1)).alias("n"))


BOX = ["tid", "mtid", "s1", "e1", "s2", "e2"]
#: How much wider the cells of the next level are, for boxes of any size; the widest cells are 2 ** 36 bases.
CELL, WIDER, LEVELS = 512, 8, 10


def _common_points(boxes: DataFrame) -> DataFrame:
    """a, b: each box with the first box that holds the same point of a grid as it does.

    A box has points at the multiples of a power of two that is at most its side's length, so one to three on either side;
    those of larger boxes are points of smaller ones' grids too."""
    points = []
    for s, e in (("s1", "e1"), ("s2", "e2")):
        step = F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(F.col(e) - F.col(s) + 1, F.lit(1)).cast("double")))).cast("long")
        points.append(F.sequence(F.ceil(F.col(s) / step) * step, F.floor(F.col(e) / step) * step, step))
    t = boxes.select("tid", "mtid", "id", points[0].alias("_x"), points[1].alias("_y")).withColumn("x", F.explode("_x")).withColumn("y", F.explode("_y"))
    at = ["tid", "mtid", "x", "y"]
    first = t.groupBy(*at).agg(F.min("id").alias("b"), F.max("id").alias("_last")).where("b < _last").drop("_last")
    return t.join(first, at).where("id <> b").select(F.col("id").alias("a"), "b").distinct()


def _overlapping(boxes: DataFrame) -> DataFrame:
    """a, b: pairs of boxes that overlap on both sides. They meet in cells of a grid, at the level of the larger box, where either
    touches two cells a side at most; a pair counts in the cell of the later starts."""
    size = F.greatest(F.col("e1") - F.col("s1"), F.col("e2") - F.col("s2")) + 1
    level = F.lit(LEVELS - 1)
    for k in range(LEVELS - 2, -1, -1):
        level = F.when(size <= CELL * WIDER**k, k).otherwise(level)
    t = boxes.withColumn("_own", level)
    levels = sorted(r[0] for r in t.select("_own").distinct().collect())  # a handful of numbers
    width = F.element_at(F.array(*(F.lit(CELL * WIDER**k) for k in range(LEVELS))), F.col("level") + 1)
    t = t.withColumn("level", F.explode(F.filter(F.array(*map(F.lit, levels)), lambda k: k >= F.col("_own"))))
    for s, e, n in (("s1", "e1", "x"), ("s2", "e2", "y")):
        t = t.withColumn(n, F.explode(F.sequence(F.floor(F.col(s) / width), F.floor(F.col(e) / width))))
    names = ["tid", "mtid", "level", "x", "y"]
    one, two = (t.select(*names, *(F.col(c).alias(f"{c}_{k}") for c in ("id", "_own", "s1", "e1", "s2", "e2"))) for k in "ab")
    meet = (F.col("s1_a") <= F.col("e1_b")) & (F.col("s1_b") <= F.col("e1_a")) & (F.col("s2_a") <= F.col("e2_b")) & (F.col("s2_b") <= F.col("e2_a"))
    once = (F.floor(F.greatest("s1_a", "s1_b") / width) == F.col("x")) & (F.floor(F.greatest("s2_a", "s2_b") / width) == F.col("y")) & (F.greatest("_own_a", "_own_b") == F.col("level"))
    return one.join(two, names).where((F.col("id_a") < F.col("id_b")) & meet & once).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))


def closed_boxes(boxes: DataFrame) -> DataFrame:
    """Boxes (tid, mtid, s1, e1, s2, e2, n) merged until no two overlap on both sides. Growing a box only adds overlaps, so the end is
    unique.

    A round links boxes with the first that shares a grid point with them, and contracts what is linked to grown boxes. Only where
    no two share a point any more, so that few can overlap one place, overlapping pairs are listed and contracted."""
    boxes = counted(boxes.select(*BOX, "n").withColumn("id", F.monotonically_increasing_id()))[0]
    pairs_next = False
    while True:
        edges, seen = counted(_overlapping(boxes) if pairs_next else _common_points(boxes))
        if not seen["rows"]:
            if pairs_next:
                return boxes.drop("id")
            pairs_next = True
            continue
        pairs_next = False
        roots = components(edges)
        grown = boxes.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("id", F.coalesce("root", "id"))
        box = [F.min("s1").alias("s1"), F.max("e1").alias("e1"), F.min("s2").alias("s2"), F.max("e2").alias("e2"), F.sum("n").alias("n")]
        boxes = kept(grown.groupBy("tid", "mtid", "id").agg(*box).select(*BOX, "n", "id"))


def refined_clusters(extended: DataFrame) -> DataFrame:
    """Bounding boxes of tags that overlap, directly or through others, on both sides at once. Equal windows are added up first."""
    kinds = extended.select(*(F.col(c).cast("long").alias(c) for c in BOX)).groupBy(*BOX).agg(F.count(F.lit(1)).alias("n"))
    return closed_boxes(kinds)


def spectrum(clusters: DataFrame, top: int = 10) -> DataFrame:
    """How many clusters hold 1, 2, ... `top` and more tags, cis and trans."""
    size = F.when(F.col("n") > top, F.lit(f">{top}")).otherwise(F.col("n").cast("string"))
    return clusters.groupBy(F.when(F.col("tid") == F.col("mtid"), "cis").otherwise("trans").alias("class"), size.alias("size")).agg(F.count(F.lit(1)).alias("clusters"), F.sum("n").alias("pets"))


def pair_states(tags: DataFrame) -> DataFrame:
    """Mapping states of both mates against each other: `state1`, `state2` -> n."""
    return tags.groupBy("state1", "state2").agg(F.count(F.lit(1)).alias("n"))


def pair_state_passes(tags: DataFrame, min_quality: int = 20) -> DataFrame:
    """state1, state2, and of tags on one and on two chromosomes those that pass and fail the quality."""
    cis, ok = F.col("tid") == F.col("mtid"), F.col("qual") >= min_quality
    kinds = {"cis_passed": cis & ok, "cis_failed": cis & ~ok, "trans_passed": ~cis & ok, "trans_failed": ~cis & ~ok}
    return tags.groupBy("state1", "state2").agg(*(F.count_if(c).alias(k) for k, c in kinds.items()))


def longer_tag(tags: DataFrame) -> DataFrame:
    """pair_id, anchor and the tag that stands for it: of an anchor's uniquely mapped tags the longer mapped, the first of
    equals; else of the repeated ones, else of what there is.

    tags: pair_id, read 1|2, tag 1|2, state U|R|N|., rname, mapped (bases). Anchor 1 holds read 1's first tag and read 2's
    second, anchor 2 read 2's first and read 1's second."""
    anchor = F.when((F.col("read") == 1) == (F.col("tag") == 1), 1).otherwise(2)
    rank = F.when(F.col("state") == "U", 3).when(F.col("state") == "R", 2).when(F.col("state") == "N", 1).otherwise(0)
    t = tags.withColumns({"anchor": anchor, "_rank": rank}).withColumn("_first", F.when(F.col("read") == F.col("anchor"), 1).otherwise(0))
    best = F.max_by(F.struct("read", "tag", "state", "rname", "mapped"), F.struct("_rank", "mapped", "_first", "rname")).alias("best")
    torn = F.count_distinct(F.when(F.col("state") == "U", F.col("rname"))) > 1
    return t.groupBy("pair_id", "anchor").agg(best, torn.alias("discordant")).select("pair_id", "anchor", "best.*", "discordant")
