"""Linker tagging: the linker that a read holds, its tags, and the class of the pair.

A located read has the columns length, linker (its kind, `none` without one), tied (another kind fits as well) and begin, end
(0-based, half-open) of the linker's place in it. Alignment is one Arrow function for all linkers at once; every rule after it
is a column expression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociflow.operators.linker import MIN_TAG, local_alignment

NONE, TIED = "none", "tied"
# A linker that runs over a read's end counts if, from so many letters covered on, it has at least and at most
# so many lost points.
SINGLE_ENDS = ((18, 0, 4), (12, 0, 2))
HALF_ENDS = ((17, 0, 4), (14, 0, 2), (13, 2, 2))
FULL_ENDS = ((36, 0, 8), (32, 0, 6))
ADAPTER_ENDS = ((28, 0, 6), (18, 0, 4), (12, 0, 2))
# The pair's final linker by those of both reads; any other two are in conflict.
SINGLE_PAIRS = (("S", "rcS", "S"), ("rcS", "S", "rcS"))
DI_PAIRS = (
    ("AA", "AA", "AA"), ("BB", "BB", "BB"), ("AB", "BA", "AB"), ("BA", "AB", "BA"),
    ("AA", "A", "AA"), ("BB", "B", "BB"), ("AB", "B", "AB"), ("BA", "A", "BA"),
    ("A", "AA", "AA"), ("B", "BB", "BB"), ("B", "AB", "AB"), ("A", "BA", "BA"),
    ("A", "A", "AA"), ("B", "B", "BB"),
)
FULL = ("AA", "AB", "BB", "BA")
MIXED = ("AB", "BA")


@dataclass(frozen=True)
class Accept:
    """A placement is good from `full` points on, or from `partial` points where it runs over an end of the read, or over its last
    one only."""

    full: int
    partial: int
    ends: tuple[tuple[int, int, int], ...]
    at_start: bool = True


SINGLE_ACCEPT = Accept(16, 11, SINGLE_ENDS)
FULL_ACCEPT = Accept(30, 26, FULL_ENDS)
HALF_ACCEPT = Accept(14, 11, HALF_ENDS)
# Of the adapters of side 1 and side 2.
ADAPTER_ACCEPT = (Accept(28, 11, ADAPTER_ENDS, False), Accept(27, 11, ADAPTER_ENDS, False))


def reverse_of(linker: str) -> str:
    return linker.translate(str.maketrans("ACGT", "TGCA"))[::-1]


def placed(reads: DataFrame, linkers: dict[str, str], seq: str = "seq") -> DataFrame:
    """The reads without their sequence, but with its length and for every linker a struct of its best placement: score, begin,
    end in the read, first, last (half-open) in the linker. A null sequence is empty."""
    rest = [c for c in reads.columns if c != seq]
    parts = ("score", "begin", "end", "first", "last")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            seqs = pdf.pop(seq).fillna("").tolist()
            pdf["length"] = [len(s) for s in seqs]
            for name, linker in linkers.items():
                for part, values in zip(parts, local_alignment(seqs, linker), strict=True):
                    pdf[f"{name}_{part}"] = values
            yield pdf

    kinds = dict(reads.dtypes)
    flat = [f"{n}_{p} int" for n in linkers for p in parts]
    t = reads.select(*rest, seq).mapInPandas(run, ", ".join([f"`{c}` {kinds[c]}" for c in rest] + ["length int", *flat]))
    return t.select(*rest, "length", *(F.struct(*(F.col(f"{n}_{p}").alias(p) for p in parts)).alias(n) for n in linkers))


def _good(place: Column, linker_length: int, accept: Accept) -> Column:
    span = place["last"] - place["first"]
    lost = F.lit(False)
    for covered, least, most in reversed(accept.ends):
        lost = F.when(span >= covered, (span - place["score"]).between(least, most)).otherwise(lost)
    start = (place["begin"] == 0) & (place["last"] == linker_length) if accept.at_start else F.lit(False)
    end = (place["first"] == 0) & (place["end"] == F.col("length"))
    return (place["score"] >= accept.full) | ((place["score"] >= accept.partial) & (start | end) & lost)


def _best(linkers: tuple[str, ...]) -> Column:
    """Of placements in this order the best scored: kind, tied, place. A later one wins if it's better, and ties if equal."""
    best = F.struct(F.lit(linkers[0]).alias("kind"), F.lit(False).alias("tied"), F.col(linkers[0]).alias("place"))
    for name in linkers[1:]:
        here, top = F.col(name), best["place"]["score"]
        best = (
            F.when(here["score"] > top, F.struct(F.lit(name).alias("kind"), F.lit(False).alias("tied"), here.alias("place")))
            .when(here["score"] == top, F.struct(best["kind"].alias("kind"), F.lit(True).alias("tied"), best["place"].alias("place")))
            .otherwise(best)
        )
    return best


def _located(t: DataFrame, rest: list[str], best: Column, good: Column) -> DataFrame:
    t = t.withColumn("_best", best).withColumn("_good", good)
    place = lambda p: F.when(F.col("_good"), F.col(f"_best.place.{p}"))
    return t.select(*rest, "length", F.when(F.col("_good"), F.col("_best.kind")).otherwise(NONE).alias("linker"), (F.col("_good") & F.col("_best.tied")).alias("tied"), place("begin").alias("begin"), place("end").alias("end"))


def single_linker(reads: DataFrame, linker: str, accept: Accept = SINGLE_ACCEPT, seq: str = "seq") -> DataFrame:
    """Located reads: the linker (S) or its reverse complement (rcS), whichever scores more; of equals the one that starts
    earlier, tied unless both start at once, where it is S."""
    rest = [c for c in reads.columns if c != seq]
    t = placed(reads, {"S": linker, "rcS": reverse_of(linker)}, seq)
    one, two = F.col("S"), F.col("rcS")
    forward = (one["score"] > two["score"]) | ((one["score"] == two["score"]) & (one["begin"] <= two["begin"]))
    tied = (one["score"] == two["score"]) & (one["begin"] != two["begin"])
    pick = lambda name, place: F.struct(F.lit(name).alias("kind"), tied.alias("tied"), place.alias("place"))
    best = F.when(forward, pick("S", one)).otherwise(pick("rcS", two))
    return _located(t, rest, best, _good(best["place"], len(linker), accept))


def di_linker(reads: DataFrame, half_a: str, half_b: str | None = None, full: Accept = FULL_ACCEPT, half: Accept = HALF_ACCEPT, seq: str = "seq") -> DataFrame:
    """Located reads: the best full linker (a half and a half's reverse complement), else the best half linker.

    Without half_b there is one half linker, as in long mate pairs."""
    rest = [c for c in reads.columns if c != seq]
    halves = {"A": half_a} | ({"B": half_b} if half_b else {})
    linkers = {x + y: halves[x] + reverse_of(halves[y]) for x, y in FULL if x in halves and y in halves}
    whole = tuple(linkers)
    linkers |= halves | {f"rc{k}": reverse_of(s) for k, s in halves.items()}
    parts = tuple(k for k in linkers if k not in whole)
    t = placed(reads, linkers, seq).withColumns({"_full": _best(whole), "_half": _best(parts)})
    length = lambda best, kinds: F.element_at(F.create_map(*(x for k in kinds for x in (F.lit(k), F.lit(len(linkers[k]))))), best["kind"])
    is_full = _good(F.col("_full.place"), length(F.col("_full"), whole), full)
    best = F.when(is_full, F.col("_full")).otherwise(F.col("_half"))
    return _located(t, rest, best, is_full | _good(F.col("_half.place"), length(F.col("_half"), parts), half))


def with_tags(located: DataFrame, clipped: str | None = None) -> DataFrame:
    """Adds tag1 and tag2, the lengths left and right of the linker; a read without one is one tag. `clipped` names the place
    at which an adapter begins, null without one."""
    end = F.coalesce(F.col(clipped), F.col("length")) if clipped else F.col("length")
    none = (F.col("linker") == NONE) | F.col("tied")
    return located.withColumns({"tag1": F.when(none, end).otherwise(F.col("begin")), "tag2": F.when(none, 0).otherwise(F.greatest(end - F.col("end"), F.lit(0)))})


def _pairs(located: DataFrame) -> DataFrame:
    """A row per pair_id with the columns of both sides (1 and 2)."""
    names = ("linker", "tied", "tag1", "tag2")
    at = lambda c, k: F.max(F.when(F.col("side") == k, F.col(c))).alias(f"{c}_{k}")
    return located.groupBy("pair_id").agg(*(at(c, k) for c in names for k in (1, 2))).where("linker_1 IS NOT NULL AND linker_2 IS NOT NULL")


def _both_tags(least: int) -> Column:
    """Whether both ends of the fragment have a tag: read 1's first or read 2's second, and the other way round."""
    long = lambda c: F.col(c) >= least
    return (long("tag1_1") | long("tag2_2")) & (long("tag2_1") | long("tag1_2"))


def _final(pairs: tuple[tuple[str, str, str], ...]) -> Column:
    """The final linker of both reads' linkers, where one of them is none the other's, null in conflict."""
    table = F.create_map(*(x for a, b, c in pairs for x in (F.lit(f"{a}|{b}"), F.lit(c))))
    one, two = F.col("linker_1"), F.col("linker_2")
    return F.when(one == NONE, two).when(two == NONE, one).otherwise(F.try_element_at(table, F.concat_ws("|", one, two)))


def pair_class(located: DataFrame, least: int = MIN_TAG) -> DataFrame:
    """pair_id, final_linker, class: none, tied, conflict, one_tag or two_tag, of reads with a single linker (pair_id, side and
    `with_tags`). Two linkers must be each other's reverse complement. Pairs of one read only are left out."""
    t = _pairs(located).withColumn("_final", _final(SINGLE_PAIRS))
    kind = F.when(F.col("tied_1") | F.col("tied_2"), TIED).when(F.col("_final").isNull(), "conflict").when(F.col("_final") == NONE, NONE).when(_both_tags(least), "two_tag").otherwise("one_tag")
    return _named(t, kind)


def di_pair_class(located: DataFrame, least: int = MIN_TAG) -> DataFrame:
    """pair_id, final_linker, class: none, tied, conflict, half, or full with one or two tags, of the same linker on both halves
    (full_same_*) or of different ones (full_mixed_*)."""
    t = _pairs(located).withColumn("_final", _final(DI_PAIRS))
    tags = F.when(_both_tags(least), "two_tag").otherwise("one_tag")
    full = F.concat_ws("_", F.when(F.col("_final").isin(*MIXED), "full_mixed").otherwise("full_same"), tags)
    kind = F.when(F.col("tied_1") | F.col("tied_2"), TIED).when(F.col("_final").isNull(), "conflict").when(F.col("_final") == NONE, NONE).when(F.col("_final").isin(*FULL), full).otherwise("half")
    return _named(t, kind)


def _named(t: DataFrame, kind: Column) -> DataFrame:
    t = t.withColumn("class", kind)
    final = F.when(F.col("class") == TIED, TIED).when(F.col("class") == "conflict", NONE).otherwise(F.col("_final"))
    return t.select("pair_id", final.alias("final_linker"), "class", "linker_1", "linker_2", "tag1_1", "tag2_1", "tag1_2", "tag2_2")


def trimmed_length(qual: str = "qual", least: int = 20, offset: int = 33) -> Column:
    """Letters up to the last base of a quality of at least `least`."""
    high = "".join(f"\\x{c:02x}" for c in range(offset + least, 127))
    return F.length(F.regexp_replace(F.coalesce(F.col(qual), F.lit("")), f"[^{high}]+$", ""))


def trim_adapters(mates: DataFrame, adapter1: str, adapter2: str, accept: tuple[Accept, Accept] = ADAPTER_ACCEPT, least: int = MIN_TAG, quality: int = 20) -> DataFrame:
    """Reads of mates(pair_id, side, seq, qual) cut where side 1's or side 2's adapter begins, and where quality ends: pair_id,
    side, seq, qual, and route: paired, unpaired (its mate is short), unpaired_short or paired_short. A read is long if it has
    more than `least` letters. A short piece of an adapter counts at the read's last letters only."""
    t = placed(mates.withColumn("_seq", F.col("seq")), {"one": adapter1, "two": adapter2}, "_seq")
    here = F.when(F.col("side") == 1, F.col("one")).otherwise(F.col("two"))
    good = F.when(F.col("side") == 1, _good(F.col("one"), len(adapter1), accept[0])).otherwise(_good(F.col("two"), len(adapter2), accept[1]))
    keep = F.least(F.when(good, here["begin"]).otherwise(F.col("length")), trimmed_length("qual", quality))
    t = t.withColumn("_keep", keep)
    long = t.groupBy("pair_id").agg(*(F.max(F.when(F.col("side") == k, F.col("_keep") > least)).alias(f"_long{k}") for k in (1, 2)))
    own = F.when(F.col("side") == 1, F.col("_long1")).otherwise(F.col("_long2"))
    route = F.when(F.col("_long1") & F.col("_long2"), "paired").when(~F.col("_long1") & ~F.col("_long2"), "paired_short").when(own, "unpaired").otherwise("unpaired_short")
    cut = lambda c: F.substring(c, F.lit(1), F.col("_keep")).alias(c)
    return t.join(long, "pair_id").select("pair_id", "side", cut("seq"), cut("qual"), route.alias("route"))


def tag_reads(reads: DataFrame, located: DataFrame, least: int = MIN_TAG) -> DataFrame:
    """pair_id, side, tag, seq: the tags of reads(pair_id, side, seq) from stored decisions, without another alignment. Tags
    shorter than `least` are left out."""
    t = reads.select("pair_id", "side", "seq").join(located.select("pair_id", "side", "linker", "tied", "end", "tag1", "tag2"), ["pair_id", "side"])
    two = F.struct(F.lit(2).alias("tag"), F.substring("seq", F.coalesce("end", F.lit(0)) + 1, F.col("tag2")).alias("part"))
    both = F.array(F.struct(F.lit(1).alias("tag"), F.substring("seq", F.lit(1), F.col("tag1")).alias("part")), two)
    return t.select("pair_id", "side", F.inline(both)).where(F.length("part") >= least).withColumnRenamed("part", "seq")


def reclassified(located: DataFrame, least: int) -> DataFrame:
    """Classes of stored decisions under another least tag length."""
    return pair_class(located, least)


def positions(located: DataFrame, by: str = "linker") -> DataFrame:
    """Histograms of where linkers begin and how long tags are: `by`, measure, value, n."""
    row = lambda m, c: F.struct(F.lit(m).alias("measure"), F.col(c).cast("long").alias("value"))
    each = located.select(by, F.inline(F.array(row("begin", "begin"), row("tag1", "tag1"), row("tag2", "tag2"))))
    return each.where("value IS NOT NULL").groupBy(by, "measure", "value").agg(F.count(F.lit(1)).alias("n"))
