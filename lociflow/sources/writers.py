"""Writers. Text sinks are one column of lines; tables are sorted Parquet that readers can prune."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociflow.functions.lineage import kept
from lociflow.operators.phasing import peak_annotation, peak_phase, phased_peak_rows


def _line(*columns: Column | str) -> Column:
    return F.concat_ws("\t", *(F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(".")) for c in columns)).alias("value")


def write_clusters(clusters: DataFrame, path: str, name: str | bool | None = None) -> None:
    """Seven columns, or BEDPE with a name C_ (cis) or T_ and both islands, after a prefix if `name` is one; cis and trans in
    folders of their own."""
    kind = F.when(F.col("tid") == F.col("mtid"), "cis").otherwise("trans").alias("class")
    columns: list[Column | str] = [F.concat(F.lit("chr"), F.col("tid")), "s1", "e1", F.concat(F.lit("chr"), F.col("mtid")), "s2", "e2"]
    if name:
        kind_letter = F.when(F.col("tid") == F.col("mtid"), "C").otherwise("T")
        columns.append(F.concat_ws("_", *([F.lit(name)] if name is not True else []), kind_letter, "island1", "island2"))
    clusters.select(kind, _line(*columns, "n")).write.partitionBy("class").text(path)


def short_form(pets: DataFrame) -> DataFrame:
    """Lines of the short form: strand, chromosome without chr, 5' end, fragment 0 and 1."""
    chrom = lambda c: F.regexp_replace(F.col(c).cast("string"), "(?i)^chr", "")
    five = lambda s, a, b: F.when(F.col(s) == 0, F.col(a)).otherwise(F.col(b))
    flag = lambda s: F.when(F.col(s) == 0, "0").otherwise("16")
    return pets.select(F.concat_ws(" ", flag("strand"), chrom("tid"), five("strand", "pos", "endpos").cast("string"), F.lit("0"), flag("mstrand"), chrom("mtid"), five("mstrand", "mpos", "mendpos").cast("string"), F.lit("1")).alias("value"))


def annotation_lines(loops: DataFrame, colour: str = "0,204,255") -> DataFrame:
    """Two-dimensional browser annotations of loops."""
    return loops.select(_line("chrom", "s1", "e1", "chrom", "s2", "e2", F.lit(colour)))


def write_annotations(loops: DataFrame, path: str, colour: str = "0,204,255") -> None:
    """The same as files with a header."""
    names = ("chr1", "x1", "x2", "chr2", "y1", "y2", "color")
    columns = (F.col("chrom"), F.col("s1"), F.col("e1"), F.col("chrom"), F.col("s2"), F.col("e2"), F.lit(colour))
    loops.select(*(c.alias(n) for n, c in zip(names, columns, strict=True))).write.option("sep", "\t").option("header", True).csv(path)


def write_qc(table: DataFrame, path: str) -> None:
    """Lines of a quality table: metric and value, numbers with thousands parted."""
    value = F.when(F.col("value") == F.floor("value"), F.format_number("value", 0)).otherwise(F.col("value").cast("string"))
    table.select(_line("metric", value)).write.text(path)


def pairs_lines(pairs: DataFrame) -> DataFrame:
    return pairs.select(_line("read_id", "chr1", "pos1", "chr2", "pos2", "strand1", "strand2"))


def write_table(pairs: DataFrame, path: str, force: bool = False) -> None:
    """An indexed table: ranges of chromosome pairs and positions, sorted, so that statistics prune row groups."""
    t = pairs.repartitionByRange("chr1", "chr2", "pos1").sortWithinPartitions("chr1", "chr2", "pos1", "pos2")
    t.write.mode("overwrite" if force else "errorifexists").parquet(path)


def write_by_phase(loops: DataFrame, path: str) -> None:
    loops.write.partitionBy("phase").parquet(path)


def write_phased_peaks(peaks: DataFrame, snps: DataFrame, path: str) -> None:
    """The peaks' four outputs, a folder each: annotation (peaks with a phase and their SNPs), browser (all, with colours), Maternal
    and Paternal (all but the other side's)."""
    phases = kept(peak_phase(peaks, snps.withColumn("coverage", F.col("p") + F.col("m"))))
    peak_annotation(peaks, snps, phases).select(_line("place", "phased_snps", "phase", "snps")).write.text(f"{path}/annotation")
    rows = phased_peak_rows(peaks, phases)
    rows.where("sink = 'browser'").select(_line("chrom", "start", "end", "name", "colour")).write.text(f"{path}/browser")
    for side in ("Maternal", "Paternal"):
        rows.where(F.col("sink") == side).select(_line("chrom", "start", "end")).write.text(f"{path}/{side}")
