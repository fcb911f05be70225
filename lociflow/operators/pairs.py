"""Contact pairs: region queries, order, fragments, contact bins.

A region is `chrom`, `chrom:start`, `chrom:start-end`, `.` or `*` (all), and two of them parted by `|` ask for both sides.
Coordinates are 1-based and closed."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

OPEN_END = 1 << 30


@dataclass(frozen=True)
class Region:
    chrom: str | None
    start: int
    end: int

    def holds(self, chrom: str, pos: str) -> Column:
        if self.chrom is None:
            return F.lit(True)
        here = F.col(chrom) == self.chrom
        if (self.start, self.end) == (0, OPEN_END):
            return here
        return here & (F.col(pos) > self.start) & (F.col(pos) <= self.end)


def parse_region(text: str) -> Region:
    text = re.sub(r"[,\s]", "", text)
    if text in (".", "*"):
        return Region(None, 0, OPEN_END)
    chrom, _, rest = text.partition(":")
    if not rest:
        return Region(chrom, 0, OPEN_END)
    first, _, last = rest.partition("-")
    if not first.isdigit() or (last and not last.isdigit()):
        raise ValueError(f"not a region: {text}")
    start, end = max(int(first) - 1, 0), int(last) if last else OPEN_END
    if start > end:
        raise ValueError(f"region ends before it starts: {text}")
    return Region(chrom, start, end)


def parse_query(text: str, separator: str = "|") -> tuple[Region, Region]:
    """One region asks for both sides in it."""
    one, _, two = text.partition(separator)
    return parse_region(one), parse_region(two or one)


def query(pairs: DataFrame, text: str, separator: str = "|", flip: bool = False) -> DataFrame:
    """Pairs with the first side in the first region and the second in the second. A filter that Parquet statistics prune.

    flip: if the pair of chromosomes isn't there but the swapped one is, the query is swapped."""
    a, b = parse_query(text, separator)
    if flip and a.chrom and b.chrom:
        there = lambda x, y: not pairs.where((F.col("chr1") == x.chrom) & (F.col("chr2") == y.chrom)).isEmpty()
        if not there(a, b) and there(b, a):
            a, b = b, a
    return pairs.where(a.holds("chr1", "pos1") & b.holds("chr2", "pos2"))


#: Widths of the cells of a region list's grid: the levels of regions' sides.
CELL, WIDER, LEVELS = 1 << 12, 8, 7
_SIDE = tuple[int, str, int, int]  # level, chromosome, first and last cell


def _side(region: Region) -> _SIDE:
    """Where a side of a query is looked up: -2 all chromosomes, -1 a whole one, else cells of the level that is as wide as it is long."""
    if region.chrom is None:
        return -2, "", 0, 0
    if (region.start, region.end) == (0, OPEN_END):
        return -1, region.chrom, 0, 0
    first, last = region.start + 1, max(region.end, region.start + 1)
    level = next((k for k in range(LEVELS) if last - first < CELL * WIDER**k), LEVELS - 1)
    width = CELL * WIDER**level
    return level, region.chrom, first // width, last // width


def _cell(level: int, chrom: str, pos: str) -> list[Column]:
    if level == -2:
        return [F.lit(""), F.lit(0).cast("long")]
    return [F.col(chrom), F.lit(0).cast("long") if level == -1 else F.floor(F.col(pos) / (CELL * WIDER**level))]


def query_list(pairs: DataFrame, texts: list[str], separator: str = "|") -> DataFrame:
    """Rows of each query, with its number; a row comes once for each query that it answers.

    Queries lie in cells of a two-dimensional grid, at a level for each side that is as wide as the side is long, wildcards in one cell
    without a chromosome. A pair looks up one cell for each pair of levels that occurs: a handful, whatever the list's length. The join is an
    equi-join with a small table, which the planner broadcasts by its size."""
    rows, kinds = [], set()
    for number, text in enumerate(texts):
        a, b = parse_query(text, separator)
        (p, chr1, x1, x2), (q, chr2, y1, y2) = _side(a), _side(b)
        kinds.add((p, q))
        bounds = (-1 if p < 0 else a.start, OPEN_END * 4 if p < 0 else a.end, -1 if q < 0 else b.start, OPEN_END * 4 if q < 0 else b.end)
        rows += [(number, p * 100 + q, chr1, x, chr2, y, *bounds) for x in range(x1, x2 + 1) for y in range(y1, y2 + 1)]
    schema = "query int, _kind int, _c1 string, _x long, _c2 string, _y long, _s1 long, _e1 long, _s2 long, _e2 long"
    table = pairs.sparkSession.createDataFrame(rows, schema)
    names = ["_kind", "_c1", "_x", "_c2", "_y"]
    cells = [F.struct(*(c.alias(n) for c, n in zip((F.lit(p * 100 + q), *_cell(p, "chr1", "pos1"), *_cell(q, "chr2", "pos2")), names, strict=True))) for p, q in sorted(kinds)]
    if not cells:
        return pairs.withColumn("query", F.lit(None).cast("int")).where("false")
    found = pairs.select("*", F.inline(F.array(*cells))).join(table, names)
    inside = (F.col("pos1") > F.col("_s1")) & (F.col("pos1") <= F.col("_e1")) & (F.col("pos2") > F.col("_s2")) & (F.col("pos2") <= F.col("_e2"))
    return found.where(inside).select(*pairs.columns, "query")


def ordered(pairs: DataFrame) -> DataFrame:
    """By chromosomes as text, then positions. Range-partitioned and sorted within partitions."""
    return pairs.orderBy("chr1", "chr2", "pos1", "pos2")


def merge(*tables: DataFrame) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return ordered(out)


def ordered_1d(pairs: DataFrame) -> DataFrame:
    """By the first side only, as one-dimensional readers want it."""
    return pairs.orderBy("chr1", "pos1")


def merge_headers(*headers: DataFrame) -> DataFrame:
    """line_no, line of a merged file's header: the first one's lines but its commands, then the commands of all in turn.

    headers(line_no, line) are a few lines each."""
    out = None
    for k, h in enumerate(headers):
        command = F.col("line").startswith("#command:")
        t = h.where(command if k else F.lit(True)).select(command.alias("_late"), F.lit(k).alias("_file"), "line_no", "line")
        out = t if out is None else out.unionByName(t)
    return out.select((F.row_number().over(Window.orderBy("_late", "_file", "line_no")) - 1).alias("line_no"), "line")


def distinct_header(header: DataFrame) -> DataFrame:
    """Of repeated lines the first stays."""
    return header.groupBy("line").agg(F.min("line_no").alias("line_no")).select("line_no", "line")


def replace_header(pairs_lines: DataFrame, header: DataFrame) -> DataFrame:
    """part (0 header, 1 body), line_no, line: the lines of a file under another header."""
    body = pairs_lines.where(~F.col("line").startswith("#")).select(F.lit(1).alias("part"), "line_no", "line")
    return header.select(F.lit(0).alias("part"), "line_no", "line").unionByName(body)


def remove_columns(pairs: DataFrame, columns: list[str | int]) -> DataFrame:
    """Without these columns, given by name or by 0-based place in the table as it comes."""
    return pairs.drop(*(pairs.columns[c] if isinstance(c, int) else c for c in columns))


def random_pairs(spark: SparkSession, n: int, chroms: dict[str, int], seed: int = 0) -> DataFrame:
    """n random pairs in the upper triangle, for tests. chroms: names and lengths."""
    names, sizes = F.array(*map(F.lit, chroms)), F.array(*map(F.lit, chroms.values()))
    t = spark.range(n).select("id", *(F.floor(F.rand(seed + k) * len(chroms)).cast("int").alias(f"_c{k}") for k in (1, 2)), *(F.rand(seed + 2 + k).alias(f"_p{k}") for k in (1, 2)))
    cols = [F.concat(F.lit("r"), "id").alias("read_id")]
    for k in (1, 2):
        cols += [F.get(names, F.col(f"_c{k}")).alias(f"chr{k}"), (F.floor(F.col(f"_p{k}") * F.get(sizes, F.col(f"_c{k}"))) + 1).alias(f"pos{k}")]
    return upper_triangle(t.select(*cols, F.lit("+").alias("strand1"), F.lit("+").alias("strand2")), list(chroms))


@dataclass(frozen=True)
class PairsTable:
    """A table of contact pairs with its header and the chromosomes' lengths, as one thing to ask."""

    pairs: DataFrame
    header: DataFrame | None = None
    separator: str = "|"

    def query(self, text: str, flip: bool = False) -> DataFrame:
        return query(self.pairs, text, self.separator, flip)

    def query_list(self, texts: list[str]) -> DataFrame:
        return query_list(self.pairs, texts, self.separator)

    def exists(self, chrom1: str, chrom2: str | None = None) -> bool:
        """Whether the table has pairs of these chromosomes; one is asked for as the name of its block."""
        one, two = (chrom1, chrom2) if chrom2 is not None else chrom1.split(self.separator)
        return not self.pairs.where((F.col("chr1") == one) & (F.col("chr2") == two)).isEmpty()

    def blocks(self) -> DataFrame:
        return block_list(self.pairs)

    def triangle(self) -> bool:
        return is_triangle(self.pairs).first()["triangle"]

    def line_count(self) -> int:
        return self.pairs.count()

    def chromosome_sizes(self) -> DataFrame:
        """chrom, length from the header's chromsize lines."""
        parts = F.split(F.regexp_replace("line", r"^#chromsize:\s*", ""), r"\s+")
        return self.header.where(F.col("line").startswith("#chromsize")).select(F.get(parts, 0).alias("chrom"), F.get(parts, 1).cast("long").alias("length"))

    def column(self, name: str) -> int:
        """The 0-based place of a column, -1 if there is none."""
        return self.pairs.columns.index(name) if name in self.pairs.columns else -1


def upper_triangle(pairs: DataFrame, chroms: list[str], strict: bool = False) -> DataFrame:
    """Sides in the order of `chroms`, then positions; pairs with a chromosome that isn't listed go.

    strict keeps only pairs that are in that order already, equal positions left out."""
    at = F.create_map(*(x for k, c in enumerate(chroms) for x in (F.lit(c), F.lit(k))))
    t = pairs.withColumns({"_a": F.try_element_at(at, "chr1"), "_b": F.try_element_at(at, "chr2")}).where("_a IS NOT NULL AND _b IS NOT NULL")
    if strict:
        return t.where("_a < _b OR (_a = _b AND pos1 < pos2)").drop("_a", "_b")
    swap = F.expr("_a > _b OR (_a = _b AND pos1 > pos2)")
    new = {}
    for a, b in (("chr1", "chr2"), ("pos1", "pos2"), ("strand1", "strand2")):
        if a in pairs.columns:
            new |= {a: F.when(swap, F.col(b)).otherwise(F.col(a)), b: F.when(swap, F.col(a)).otherwise(F.col(b))}
    return t.withColumns(new).drop("_a", "_b")


def is_triangle(pairs: DataFrame) -> DataFrame:
    """One row: whether no pair of different chromosomes comes in both orders."""
    blocks = pairs.where("chr1 <> chr2").select("chr1", "chr2").distinct()
    both = blocks.join(blocks.select(F.col("chr2").alias("chr1"), F.col("chr1").alias("chr2")), ["chr1", "chr2"], "left_semi")
    return both.agg((F.count(F.lit(1)) == 0).alias("triangle"))


def block_list(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("chr1", "chr2").agg(F.count(F.lit(1)).alias("n"))


def fragments(pairs: DataFrame, sites: DataFrame, position: str = "pos1", chrom: str | None = None, name: str = "fragment", tile: int = 1 << 20) -> DataFrame:
    """Adds the number of restriction sites at or before a position. sites(site[, chrom]).

    An as-of join by union: sites and rows are ordered together within tiles of positions; what the tiles before hold is
    added. No side is broadcast."""
    keys = [chrom] if chrom else []
    cuts = sites.groupBy(*keys, F.col("site").alias("_pos")).agg(F.count(F.lit(1)).alias("_step")).withColumn("_tile", F.floor(F.col("_pos") / tile))
    per = cuts.groupBy(*keys, "_tile").agg(F.sum("_step").alias("_n"))
    upto = Window.partitionBy(*keys).orderBy("_tile").rangeBetween(Window.unboundedPreceding, -1)
    rows = pairs.withColumn("_pos", F.col(position)).withColumn("_tile", F.floor(F.col(position) / tile))
    tiles = rows.select(*keys, "_tile").distinct().withColumn("_n", F.lit(0)).unionByName(per).groupBy(*keys, "_tile").agg(F.sum("_n").alias("_n"))
    base = tiles.select(*keys, "_tile", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_base"))
    both = rows.withColumn("_step", F.lit(0).cast("long")).unionByName(cuts, allowMissingColumns=True)
    order = Window.partitionBy(*keys, "_tile").orderBy("_pos").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    counted = both.withColumn("_is_row", F.col("_step") == 0).withColumn("_in", F.sum("_step").over(order)).where("_is_row")
    return counted.join(base, [*keys, "_tile"]).withColumn(name, F.col("_base") + F.col("_in")).select(*pairs.columns, name)


def contact_bins(pairs: DataFrame, resolutions: tuple[int, ...] = (100_000, 500_000, 1_000_000)) -> DataFrame:
    """Contacts by bin of both sides at each resolution."""
    t = pairs.withColumn("resolution", F.explode(F.array(*map(F.lit, resolutions))))
    return t.groupBy("resolution", "chr1", F.floor(F.col("pos1") / F.col("resolution")).alias("bin1"), "chr2", F.floor(F.col("pos2") / F.col("resolution")).alias("bin2")).agg(F.count(F.lit(1)).alias("n"))


def from_pets(pets: DataFrame) -> DataFrame:
    name = lambda c: F.concat(F.lit("chr"), F.col(c))
    sign = lambda c: F.when(F.col(c) == 0, "+").otherwise("-")
    return pets.select(
        F.concat(F.lit("r"), F.col("pet_id")).alias("read_id"), name("tid").alias("chr1"), F.col("pos").alias("pos1"), name("mtid").alias("chr2"), F.col("mpos").alias("pos2"),
        sign("strand").alias("strand1"), sign("mstrand").alias("strand2"),
    )
