"""Readers of genomic text formats. All are column expressions over `spark.read.text` or `csv`: nothing is inferred."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociflow.functions.sequence import reference_length
from lociflow.operators.pairs import upper_triangle

LOOP = "chrom1 string, start1 int, end1 int, chrom2 string, start2 int, end2 int, pet_count int, peak_support int"
BED = "chrom string, start int, end int, name string, score string, strand string"
PAIR_COLUMNS = ["read_id", "chr1", "pos1", "chr2", "pos2", "strand1", "strand2"]


@dataclass(frozen=True)
class Preset:
    """1-based places of columns in a delimited file; what an index over it would need."""

    chr1: int
    start1: int
    end1: int
    chr2: int = 0
    start2: int = 0
    end2: int = 0
    separator: str = "\t"
    comment: str = "#"
    cigar: int = 0


# The places of columns in common formats.
PRESETS = {
    "bed": Preset(1, 2, 3),
    "gff": Preset(1, 4, 5),
    "vcf": Preset(1, 2, 2),
    "sam": Preset(3, 4, 4, comment="@", cigar=6),
    "psltbl": Preset(15, 17, 18),
    "pairs": Preset(2, 3, 3, 4, 5, 5),
    "merged_nodups": Preset(2, 3, 3, 6, 7, 7, separator=" "),
    "old_merged_nodups": Preset(3, 4, 4, 7, 8, 8, separator=" "),
}


def _lines(spark: SparkSession, path: str | list[str], comment: str = "#", anywhere: bool = False) -> DataFrame:
    t = spark.read.text(path)
    return t.where(~F.col("value").contains(comment) if anywhere else ~F.col("value").startswith(comment)).where(F.col("value") != "")


def _typed(parts: Column, schema: str) -> list[Column]:
    out = []
    for k, field in enumerate(schema.split(", ")):
        name, kind = field.split(" ")
        out.append(F.get(parts, k).try_cast(kind).alias(name) if kind != "string" else F.get(parts, k).alias(name))
    return out


def _from(parts: Column, first: int) -> Column:
    """All parts from the `first`-th on."""
    return F.slice(parts, F.lit(first), F.greatest(F.size(parts) - (first - 1), F.lit(0)))


def read_loops(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Loop files of 7 or 8 columns; lines with a # anywhere are comments."""
    return _lines(spark, path, anywhere=True).select(*_typed(F.split("value", "\t"), LOOP))


def read_bed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return _lines(spark, path).where(~F.col("value").startswith("track")).select(*_typed(F.split("value", "\t"), BED))


def read_peaks(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """narrowPeak and broadPeak: of rows that start at the same place the last one stays."""
    return read_bed(spark, path).withColumn("_at", F.monotonically_increasing_id()).groupBy("chrom", "start").agg(F.max_by("end", "_at").alias("end"))


def read_indexed(spark: SparkSession, path: str | list[str], preset: str | Preset) -> DataFrame:
    """chr1, start1, end1[, chr2, start2, end2] and the line, of any delimited file."""
    p = PRESETS[preset] if isinstance(preset, str) else preset
    parts = F.split("value", "\\Q" + p.separator + "\\E")
    names = [f.name for f in fields(p)[:6] if getattr(p, f.name)]
    cols = [(F.get(parts, getattr(p, n) - 1) if n.startswith("chr") else F.get(parts, getattr(p, n) - 1).try_cast("long")).alias(n) for n in names]
    if p.cigar:  # an alignment ends with the last base of the reference that it takes
        length = F.coalesce(reference_length(F.get(parts, p.cigar - 1), "MDN"), F.lit(0))
        cols[2] = (F.get(parts, p.start1 - 1).try_cast("long") + F.greatest(length, F.lit(1)) - 1).alias("end1")
    return _lines(spark, path, p.comment).select(*cols, F.col("value").alias("line"))


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """read_no, name, seq, qual. A line's number is its place in its block of the file and the lines of the blocks before, so a
    task sees a block only."""
    t = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
    t = t.withColumn("_at", F.monotonically_increasing_id())
    blocks = t.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("_file", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    t = t.withColumn("_no", F.row_number().over(Window.partitionBy("_file", "_block").orderBy("_at")) - 1)
    t = t.join(blocks, ["_file", "_block"]).withColumn("_no", F.col("_no") + F.col("_base"))
    record = t.groupBy("_file", F.floor(F.col("_no") / 4).alias("read_no")).agg(*(F.max(F.when(F.col("_no") % 4 == k, F.col("value"))).alias(n) for k, n in ((0, "name"), (1, "seq"), (3, "qual"))))
    return record.select("read_no", F.regexp_replace("name", "^@", "").alias("name"), "seq", "qual")


def read_fastq_pairs(spark: SparkSession, first: str, second: str) -> DataFrame:
    """Two files of mates, zipped by record number: pair_id, seq1, qual1, seq2, qual2."""
    a, b = (read_fastq(spark, p).select(F.col("read_no").alias("pair_id"), F.col("seq").alias(f"seq{k}"), F.col("qual").alias(f"qual{k}")) for k, p in ((1, first), (2, second)))
    return a.join(b, "pair_id")


def read_interleaved(spark: SparkSession, path: str) -> DataFrame:
    """One file with both mates of a pair in turn: pair_id, side (1 or 2), name, seq, qual."""
    return read_fastq(spark, path).select(F.floor(F.col("read_no") / 2).alias("pair_id"), (F.col("read_no") % 2 + 1).cast("int").alias("side"), "name", "seq", "qual")


def read_sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The eleven SAM columns, and tags as a map of name to value."""
    names = "qname string, flag int, rname string, pos int, mapq int, cigar string, rnext string, pnext int, tlen int, seq string, qual string"
    parts = F.split("value", "\t")
    tags = F.map_from_entries(F.transform(_from(parts, 12), lambda t: F.struct(F.substring(t, 1, 2), F.substr(t, F.lit(6)))))
    return _lines(spark, path, "@").select(*_typed(parts, names), tags.alias("tags"))


def read_pairs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Contact pairs of at least the seven reserved columns; `.` is null."""
    parts = F.transform(F.split("value", "\t"), lambda x: F.when(x != ".", x))
    kinds = ", ".join(f"{c} {'long' if c.startswith('pos') else 'string'}" for c in PAIR_COLUMNS)
    return _lines(spark, path).select(*_typed(parts, kinds), _from(parts, 8).alias("rest"))


def read_pairs_header(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """key, value of the header lines (`#chromsize: chr1 1000`)."""
    t = spark.read.text(path).where(F.col("value").startswith("#"))
    return t.select(F.regexp_extract("value", r"^#+\s*([^:\s]+):?\s*(.*)$", 1).alias("key"), F.regexp_extract("value", r"^#+\s*([^:\s]+):?\s*(.*)$", 2).alias("value"))


def read_merged_nodups(spark: SparkSession, path: str | list[str], max_mapq: int | None = None, old: bool = False, chroms: list[str] | None = None) -> DataFrame:
    """Pairs of a merged_nodups file, with fragments; with max_mapq, both qualities must be above it. With chroms, pairs of
    other chromosomes go, and sides come in their order."""
    parts, at = F.split("value", " "), 1 if old else 0
    strand = lambda k: F.when(F.get(parts, k) == "0", "+").otherwise("-")
    number = lambda k: F.get(parts, k).try_cast("long")
    cols = [
        (F.get(parts, 0) if old else F.get(parts, 14)).alias("read_id"), F.get(parts, at + 1).alias("chr1"), number(at + 2).alias("pos1"), F.get(parts, at + 5).alias("chr2"), number(at + 6).alias("pos2"),
        strand(at).alias("strand1"), strand(at + 4).alias("strand2"), number(at + 3).alias("frag1"), number(at + 7).alias("frag2"),
    ]
    t = _lines(spark, path)
    if max_mapq is not None:
        t = t.where((number(at + 8) > max_mapq) & (number(at + (9 if old else 11)) > max_mapq))
    return upper_triangle(t.select(*cols), chroms) if chroms else t.select(*cols)


def read_short_form(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Pairs of the eight-column short form; chromosomes get the prefix chr, there is no read id."""
    parts = F.split("value", " ")
    chrom = lambda k: F.concat(F.lit("chr"), F.get(parts, k))
    strand = lambda k: F.when(F.get(parts, k) == "0", "+").otherwise("-")
    number = lambda k: F.get(parts, k).try_cast("long")
    return _lines(spark, path).select(F.lit(None).cast("string").alias("read_id"), chrom(1).alias("chr1"), number(2).alias("pos1"), chrom(5).alias("chr2"), number(6).alias("pos2"), strand(0).alias("strand1"), strand(4).alias("strand2"))


def read_pileup(spark: SparkSession, path: str | list[str], variant: str | None = None) -> DataFrame:
    """chrom, pos, ref, depth, bases, quals; variant `indel` takes rows whose reference is *, `snp` the others."""
    t = _lines(spark, path).select(*_typed(F.split("value", "\t"), "chrom string, pos long, ref string, depth int, bases string, quals string"))
    return t if variant is None else t.where((F.col("ref") == "*") == (variant == "indel"))


def read_fasta(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """name, seq of each record."""
    t = spark.read.option("lineSep", ">").text(path).where(F.trim("value") != "")
    return t.select(F.regexp_extract("value", r"^(\S+)", 1).alias("name"), F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n", ""), r"\s", "").alias("seq"))


#: Bases of a chunk of a sequence.
CHUNK = 1 << 16


def read_fasta_chunks(spark: SparkSession, path: str | list[str], size: int = CHUNK) -> DataFrame:
    """name, chunk, seq: records cut into chunks of `size` bases, numbered from 0, so that a chromosome is many rows.

    A line's place in its record is what the lines before it in its block of the file hold, and, before a block's first header, what the
    blocks before hold of the same record: sums within a block, then a row a block."""
    t = spark.read.text(path).select(F.trim("value").alias("value"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
    t = t.withColumn("_at", F.monotonically_increasing_id()).where("value <> ''").withColumn("_head", F.col("value").startswith(">"))
    bases = F.when(F.col("_head"), 0).otherwise(F.length("value"))
    name = F.when(F.col("_head"), F.regexp_extract("value", r"^>\s*(\S*)", 1))
    here = Window.partitionBy("_file", "_block").orderBy("_at")
    t = t.withColumns({"_size": bases, "_name": name, "_record": F.count_if("_head").over(here.rowsBetween(Window.unboundedPreceding, 0))})
    own = Window.partitionBy("_file", "_block", "_record").orderBy("_at")
    t = t.withColumns({"_name": F.max("_name").over(own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), "_offset": F.coalesce(F.sum("_size").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    parts = t.groupBy("_file", "_block", "_record").agg(F.max("_name").alias("_name"), F.sum("_size").alias("_size"))
    last = parts.groupBy("_file", "_block").agg(F.max_by(F.struct("_name", "_size"), "_record").alias("_l"), (F.max("_record") > 0).alias("_heads"))
    upto = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)
    last = last.withColumn("_run", F.count_if("_heads").over(upto))
    run = Window.partitionBy("_file", "_run").orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)
    last = last.select("_file", "_block", F.max("_l._name").over(run).alias("_name"), F.sum("_l._size").over(run).alias("_size"))
    prior = Window.partitionBy("_file").orderBy("_block")
    carried = last.select("_file", "_block", F.lag("_name").over(prior).alias("_carried"), F.lag("_size").over(prior).alias("_carry"))
    first = F.col("_record") == 0
    t = t.join(carried, ["_file", "_block"]).where("NOT _head")
    t = t.select(F.when(first, F.col("_carried")).otherwise(F.col("_name")).alias("name"), (F.col("_offset") + F.when(first, F.coalesce("_carry", F.lit(0))).otherwise(0)).alias("at"), "value").where("name IS NOT NULL")
    chunks = F.sequence(F.floor(F.col("at") / size), F.floor((F.col("at") + F.length("value") - 1) / size))
    t = t.withColumn("chunk", F.explode(chunks))
    begin = F.greatest(F.col("chunk") * size - F.col("at"), F.lit(0)).cast("int")
    end = F.least((F.col("chunk") + 1) * size - F.col("at"), F.length("value")).cast("int")
    pieces = t.select("name", "chunk", F.struct((F.col("at") + begin).alias("at"), F.substring("value", begin + 1, end - begin).alias("part")).alias("piece"))
    return pieces.groupBy("name", "chunk").agg(F.array_join(F.transform(F.array_sort(F.collect_list("piece")), lambda p: p["part"]), "").alias("seq"))


def fetch_ranges(chunks: DataFrame, regions: DataFrame, size: int = CHUNK) -> DataFrame:
    """regions(name, start, end; 1-based, closed, and other columns) with their bases from `read_fasta_chunks`: each is joined with
    the chunks that it touches, and put together in their order. Places beyond a sequence's end have no bases; regions of unknown names go."""
    t = regions.withColumn("_id", F.monotonically_increasing_id())
    wanted = t.select("_id", "name", "start", "end", F.explode(F.sequence(F.floor((F.greatest("start", F.lit(1)) - 1) / size), F.floor((F.greatest("end", F.lit(1)) - 1) / size))).alias("chunk"))
    begin = F.greatest(F.col("start") - 1 - F.col("chunk") * size, F.lit(0)).cast("int")
    end = F.least(F.col("end") - F.col("chunk") * size, F.lit(size)).cast("int")
    parts = wanted.join(chunks, ["name", "chunk"]).select("_id", F.struct("chunk", F.substring("seq", begin + 1, F.greatest(end - begin, F.lit(0))).alias("part")).alias("part"))
    bases = parts.groupBy("_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["part"]), "").alias("bases"))
    known = t.join(chunks.select("name").distinct(), "name", "left_semi")
    return known.join(bases, "_id", "left").select(*regions.columns, F.coalesce("bases", F.lit("")).alias("bases"))


def fetch(sequences: DataFrame, regions: DataFrame) -> DataFrame:
    """regions(name, start, end; 1-based, closed) with their bases."""
    return regions.join(sequences, "name").withColumn("bases", F.substring("seq", F.col("start"), F.col("end") - F.col("start") + 1)).drop("seq")


def fetch_with(sequences: DataFrame, regions: DataFrame, function: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """A user's function over batches of fetched regions (name, start, end, bases and their other columns)."""
    return fetch(sequences, regions).mapInPandas(function, schema)


def read_motifs(spark: SparkSession, path: str | list[str], column: int = 0) -> DataFrame:
    """chrom, start, end, motif_id from `chr:start-end` texts, numbered in the order of places."""
    place = F.get(F.split("value", "\t"), column)
    t = _lines(spark, path).select(*(F.regexp_extract(place, r"^([^:]+):(\d+)-(\d+)", k).alias(n) for k, n in ((1, "chrom"), (2, "start"), (3, "end")))).where("chrom <> ''")
    t = t.select("chrom", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    return t.withColumn("motif_id", F.concat(F.lit("motif_"), F.col("chrom"), F.lit("_"), F.row_number().over(Window.partitionBy("chrom").orderBy("start", "end"))))


def read_header(spark: SparkSession, path: str | list[str], comment: str = "#") -> DataFrame:
    """line_no, line of the lines that start with the comment sign, in their order."""
    t = spark.read.text(path).withColumn("line_no", F.monotonically_increasing_id()).where(F.col("value").startswith(comment))
    return t.select("line_no", F.col("value").alias("line"))


def sequence_names(spark: SparkSession, path: str | list[str], preset: str | Preset) -> DataFrame:
    """chrom, records: the chromosomes of an indexed file."""
    return read_indexed(spark, path, preset).groupBy(F.col("chr1").alias("chrom")).agg(F.count(F.lit(1)).alias("records"))


def read_vcf_header(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """kind (contig, INFO, FORMAT, FILTER, samples or any other key), id, value of the header's lines."""
    t = read_header(spark, path)
    structured = F.regexp_extract("line", r"^##(\w+)=<ID=([^,>]+)", 2)
    key = F.regexp_extract("line", r"^##([^=]+)=", 1)
    samples = F.concat_ws(",", _from(F.split("line", "\t"), 10))
    is_columns = F.col("line").startswith("#CHROM")
    return t.select("line_no", F.when(is_columns, "samples").otherwise(key).alias("kind"), F.when(structured != "", structured).alias("id"), F.when(is_columns, samples).otherwise(F.regexp_extract("line", r"^##[^=]+=(.*)$", 1)).alias("value"))


def read_vcf(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """chrom, pos, id, ref, alt (array), qual, filter, info (map; a flag is null), format, samples (array); `.` is null."""
    parts = F.transform(F.split("value", "\t"), lambda x: F.when(x != ".", x))
    names = "chrom string, pos long, id string, ref string, alt string, qual double, filter string, info string, format string"
    t = _lines(spark, path).select(*_typed(parts, names), _from(parts, 10).alias("samples"))
    entry = lambda x: F.struct(F.get(F.split(x, "=", 2), 0), F.get(F.split(x, "=", 2), 1))
    info = F.map_from_entries(F.transform(F.split("info", ";"), entry))
    return t.withColumns({"alt": F.split("alt", ","), "info": F.when(F.col("info").isNotNull(), info)})


# 1-based places of name, strand, chromosome and position in the outputs of short-read aligners, what a position
# counts from, and how the reverse strand is written.
ALIGNERS = {"bowtie": (1, 2, 3, 4, 0, "-"), "eland": (1, 9, 7, 8, 1, "R"), "maq": (1, 4, 2, 3, 1, "-")}
REVERSE_FLAG = 16


def read_aligner(spark: SparkSession, path: str | list[str], kind: str) -> DataFrame:
    """name, chrom, pos (1-based), strand of mapped reads; rows without a place are left out."""
    name, strand, chrom, pos, base, reverse = ALIGNERS[kind]
    parts = F.split("value", "\t")
    at = lambda k: F.get(parts, k - 1)
    t = _lines(spark, path).select(at(name).alias("name"), F.regexp_replace(at(chrom), r"\.fa$", "").alias("chrom"), (at(pos).try_cast("long") + 1 - base).alias("pos"), F.when(at(strand) == reverse, "-").otherwise("+").alias("strand"))
    return t.where("chrom <> '' AND pos IS NOT NULL")


def tags_of(alignments: DataFrame) -> DataFrame:
    """name, chrom, pos, strand, length, quality of mapped alignments (the SAM columns): pos is the 5' end, 1-based, and length the bases
    of the reference that are taken."""
    length = F.greatest(reference_length(F.col("cigar"), "MDN=X"), F.lit(1))
    reverse = F.col("flag").bitwiseAND(REVERSE_FLAG) != 0
    mapped = alignments.where((F.col("flag").bitwiseAND(4) == 0) & (F.col("rname") != "*") & (F.col("pos") > 0))
    pos = F.col("pos").cast("long") + F.when(reverse, length - 1).otherwise(0)
    return mapped.select(F.col("qname").alias("name"), F.col("rname").alias("chrom"), pos.alias("pos"), F.when(reverse, "-").otherwise("+").alias("strand"), length.alias("length"), F.col("mapq").alias("quality"))


def read_alignment_tags(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """`tags_of` a SAM file."""
    return tags_of(read_sam(spark, path))


def read_meland(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """chrom, pos, strand, length of tags in a modified BED file of matches of varying length: chromosome, start, end (half-open), a
    name or mismatches, a score, strand. pos is the 5' end, 1-based."""
    t = _lines(spark, path).select(*_typed(F.split("value", r"\s+"), "chrom string, start long, end long, name string, score string, strand string"))
    pos = F.when(F.col("strand") == "-", F.col("end")).otherwise(F.col("start") + 1)
    return t.where("start IS NOT NULL AND end IS NOT NULL").select("chrom", pos.alias("pos"), F.when(F.col("strand") == "-", "-").otherwise("+").alias("strand"), (F.col("end") - F.col("start")).alias("length"))


def merge_lanes(spark: SparkSession, first: list[str], second: list[str]) -> DataFrame:
    """Mates of several lanes: lane, pair_id, seq1, qual1, seq2, qual2."""
    out = None
    for k, (a, b) in enumerate(zip(first, second, strict=True)):
        t = read_fastq_pairs(spark, a, b).withColumn("lane", F.lit(k))
        out = t if out is None else out.unionByName(t)
    return out
