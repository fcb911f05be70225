"""Interval joins, merging and coverage.

Joins turn the range predicate into an equi-join. Bins come in levels, each wider than the last; an interval belongs to the
level whose bins are as wide as it is long, where it touches two at most. Two intervals meet at the coarser of their levels, so each is
spread over its own and over the coarser ones that occur on the other side. Joined on chromosome, level and bin, a pair is kept in the bin
where the later start lies, so that it comes once. Catalyst is then free to broadcast, to sort-merge, or to split a skewed bin.

Merging and coverage are windows. A chromosome is few keys, so both work in two levels: over distinct positions within
coarse tiles first, then over a row a tile.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociflow.functions.lineage import kept
from lociflow.functions.overlap import Overlap, overlaps

#: Width of the finest bins, and how much wider those of the next level are.
BIN, WIDER = 4096, 16
LEVELS = 6


def _last(start: str, end: str, how: Overlap) -> Column:
    return F.col(end) if how is Overlap.CLOSED else F.greatest(F.col(end) - 1, F.col(start))


def _level(start: str, end: str, how: Overlap, bin_width: int) -> Column:
    """The finest level whose bins are no narrower than the interval."""
    size = _last(start, end, how) - F.col(start) + 1
    level = F.lit(LEVELS - 1)
    for k in range(LEVELS - 2, -1, -1):
        level = F.when(size <= bin_width * WIDER**k, k).otherwise(level)
    return level


def _levels(sides: list[tuple[DataFrame, str, str]], how: Overlap, bin_width: int) -> list[set[int]]:
    """The levels that occur on each side: a handful of numbers, from one job."""
    each = [df.select(F.lit(k).alias("side"), _level(s, e, how, bin_width).alias("level")) for k, (df, s, e) in enumerate(sides)]
    found = each[0].union(each[1]).distinct().collect()
    return [{r["level"] for r in found if r["side"] == k} for k in (0, 1)]


def _bins(start: Column, last: Column, width: int, rest: Column, name: str) -> Column:
    """The bins that an interval touches, each with what `rest` holds."""
    return F.transform(F.sequence(F.floor(start / width), F.floor(last / width)), lambda b: F.struct(b.alias(name), rest.alias("rest")))


def _spread(df: DataFrame, start: str, end: str, names: tuple[str, str, str], how: Overlap, bin_width: int, own: set[int], other: set[int]) -> DataFrame:
    """A row for each bin of each level at which an interval may meet one of the other side: the coarser of both intervals'
    levels. So it spreads to the level of its length, if the other side has finer or equal ones, and to coarser ones that the other side has.

    names: of the bin, its level, and whether that is the interval's own. The coarsest level alone may take more than two bins."""
    bin_, level, is_own = names
    mine, last = _level(start, end, how, bin_width), _last(start, end, how)
    parts = []
    for k in sorted(own | other):
        use = (mine == k) if k not in other else (mine <= k)
        if k in other and not any(x <= k for x in own):
            continue
        if k not in other and not any(x < k for x in other):
            continue
        width = bin_width * WIDER**k
        at = F.struct(F.lit(k).alias(level), (mine == k).alias(is_own))
        bins = _bins(F.col(start), last, width, at, bin_)
        parts.append(F.when(use, bins).otherwise(F.array().cast(f"array<struct<{bin_}:bigint,rest:struct<{level}:int,{is_own}:boolean>>>")))
    if not parts:
        return df.where("false").select("*", F.lit(None).cast("long").alias(bin_), F.lit(None).cast("int").alias(level), F.lit(None).cast("boolean").alias(is_own))
    return df.select("*", F.inline(parts[0] if len(parts) == 1 else F.concat(*parts))).select(*df.columns, bin_, "rest.*")


def inner_join(left: DataFrame, right: DataFrame, keys: list[str], how: Overlap = Overlap.HALF_OPEN, bin_width: int = BIN, start: str = "start", end: str = "end") -> DataFrame:
    """Pairs of overlapping intervals. Left columns get the prefix l_, right ones r_."""
    a, b = (df.select(*(F.col(c).alias(f"{p}_{c}") for c in df.columns)) for p, df in (("l", left), ("r", right)))
    one, two = _levels([(a, f"l_{start}", f"l_{end}"), (b, f"r_{start}", f"r_{end}")], how, bin_width)
    a = _spread(a, f"l_{start}", f"l_{end}", ("_bin", "_level", "_own"), how, bin_width, one, two)
    b = _spread(b, f"r_{start}", f"r_{end}", ("_rbin", "_rlevel", "_rown"), how, bin_width, two, one)
    same = (F.col("_bin") == F.col("_rbin")) & (F.col("_level") == F.col("_rlevel")) & (F.col("_own") | F.col("_rown"))
    for k in keys:
        same = same & (F.col(f"l_{k}") == F.col(f"r_{k}"))
    s1, e1, s2, e2 = (F.col(f"{p}_{c}") for p in "lr" for c in (start, end))
    width = F.element_at(F.array(*(F.lit(bin_width * WIDER**k) for k in range(LEVELS))), F.col("_level") + 1)
    once = F.col("_bin") == F.floor(F.greatest(s1, s2) / width)
    return a.join(b, same & overlaps(how, s1, e1, s2, e2) & once).drop("_bin", "_rbin", "_level", "_rlevel", "_own", "_rown")


def _matched(left: DataFrame, right: DataFrame, keys: list[str], kind: str, how: Overlap, bin_width: int, start: str, end: str, row_id: str) -> DataFrame:
    a = left.select(row_id, *keys, start, end)
    b = right.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col(start).alias("_s"), F.col(end).alias("_e"))
    one, two = _levels([(a, start, end), (b, "_s", "_e")], how, bin_width)
    a = _spread(a, start, end, ("_bin", "_level", "_own"), how, bin_width, one, two)
    b = _spread(b, "_s", "_e", ("_rbin", "_rlevel", "_rown"), how, bin_width, two, one)
    same = (F.col("_bin") == F.col("_rbin")) & (F.col("_level") == F.col("_rlevel")) & (F.col("_own") | F.col("_rown"))
    for k in keys:
        same = same & (F.col(k) == F.col(f"_{k}"))
    hit = a.join(b, same & overlaps(how, F.col(start), F.col(end), F.col("_s"), F.col("_e")), "left_semi").select(row_id).distinct()
    return left.join(hit, row_id, kind)


def semi_join(left: DataFrame, right: DataFrame, keys: list[str], row_id: str, how: Overlap = Overlap.HALF_OPEN, bin_width: int = BIN, start: str = "start", end: str = "end") -> DataFrame:
    """Left rows that overlap any right row. `row_id` names a unique column."""
    return _matched(left, right, keys, "left_semi", how, bin_width, start, end, row_id)


def anti_join(left: DataFrame, right: DataFrame, keys: list[str], row_id: str, how: Overlap = Overlap.HALF_OPEN, bin_width: int = BIN, start: str = "start", end: str = "end") -> DataFrame:
    """Left rows that overlap no right row."""
    return _matched(left, right, keys, "left_anti", how, bin_width, start, end, row_id)


def _local_runs(points: DataFrame, keys: list[str], start: str, end: str, touching: bool) -> DataFrame:
    """Adds _new, whether a run begins at this point as far as its tile tells, and _local, the run's number within the tile."""
    by = Window.partitionBy(*keys, "_tile").orderBy(start)
    reach = F.max(end).over(by.rowsBetween(Window.unboundedPreceding, -1))
    gap = (F.col(start) > reach) if touching else (F.col(start) >= reach)
    t = points.withColumn("_new", F.coalesce(gap, F.lit(True)))
    return t.withColumn("_local", F.sum(F.col("_new").cast("int")).over(by.rowsBetween(Window.unboundedPreceding, 0)))


def _tile_bases(local: DataFrame, keys: list[str], start: str, end: str, touching: bool) -> DataFrame:
    """keys, _tile, _joined, _base: how many of a tile's first runs go on from the tiles before, and how many runs came before.

    A row a tile, with the starts of its runs, goes through a chromosome's window."""
    tiles = local.groupBy(*keys, "_tile").agg(F.max(end).alias("_end"), F.collect_list(F.when(F.col("_new"), F.col(start))).alias("_heads"))
    before = Window.partitionBy(*keys).orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
    tiles = tiles.withColumn("_reach", F.max("_end").over(before))
    goes_on = F.filter("_heads", lambda h: (h <= F.col("_reach")) if touching else (h < F.col("_reach")))
    tiles = tiles.select(*keys, "_tile", F.size(goes_on).alias("_joined"), F.size("_heads").alias("_runs"))
    return tiles.select(*keys, "_tile", "_joined", F.coalesce(F.sum(F.col("_runs") - F.col("_joined")).over(before), F.lit(0)).alias("_base"))


def _number() -> Column:
    return F.col("_base") + F.greatest(F.col("_local") - F.col("_joined"), F.lit(0))


def number_sides(df: DataFrame, keys: list[str], sides: dict[str, tuple[str, str]], touching: bool = True, tile: int = 1 << 20) -> DataFrame:
    """Adds for each side (name: start, end) the number of the run of intervals that a row's belongs to, from 1 in the order of starts.

    One scan makes the starts of all sides distinct, with their greatest ends, so a window sees at most a tile's positions. These and
    a row a tile are written once; a second scan looks the rows' numbers up."""
    points = df.select(*keys, F.inline(F.array(*(F.struct(F.lit(k).alias("_side"), F.col(s).alias("_at"), F.col(e).alias("_end")) for k, (s, e) in enumerate(sides.values())))))
    by = [*keys, "_side"]
    points = points.groupBy(*by, "_at").agg(F.max("_end").alias("_end")).withColumn("_tile", F.floor(F.col("_at") / tile))
    local = kept(_local_runs(points, by, "_at", "_end", touching))
    tiles = kept(_tile_bases(local, by, "_at", "_end", touching))
    numbered = local.join(tiles, [*by, "_tile"])
    out = df
    for k, (name, (start, _)) in enumerate(sides.items()):
        own = numbered.where(F.col("_side") == k).select(*keys, F.col("_at").alias(start), _number().alias(name))
        out = out.join(own, [*keys, start])
    return out.select(*df.columns, *sides)


def number_islands(df: DataFrame, keys: list[str], start: str, end: str, name: str, touching: bool = True, tile: int = 1 << 20) -> DataFrame:
    """`number_sides` of one side."""
    return number_sides(df, keys, {name: (start, end)}, touching, tile)


def merge(df: DataFrame, keys: list[str], touching: bool = True, tile: int = 1 << 20, start: str = "start", end: str = "end", weight: str | None = None) -> DataFrame:
    """Unions of overlapping (with touching: or book-ended) intervals: keys, start, end, n.

    A tile's runs are written once; those that go on over tiles are put together by their numbers."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    points = df.groupBy(*keys, start).agg(F.max(end).alias(end), n.alias("n")).withColumn("_tile", F.floor(F.col(start) / tile))
    local = _local_runs(points, keys, start, end, touching)
    runs = kept(local.groupBy(*keys, "_tile", "_local").agg(F.min(start).alias(start), F.max(end).alias(end), F.sum("n").alias("n")))
    tiles = _tile_bases(runs.withColumn("_new", F.lit(True)), keys, start, end, touching)
    whole = runs.join(tiles, [*keys, "_tile"]).groupBy(*keys, _number().alias("_island"))
    return whole.agg(F.min(start).alias(start), F.max(end).alias(end), F.sum("n").alias("n")).drop("_island")


def layers(df: DataFrame, keys: list[str], names: list[str], layer: str = "layer", tile: int = 1 << 22, start: str = "start", end: str = "end") -> DataFrame:
    """Depths of several layers of intervals at once, as runs: keys, start, end, and a depth for each of `names` (the layers 0, 1, ...).

    Opening and closing events add up by position before they are summed along a chromosome; running sums start in each tile
    from what the tiles before add up to. Runs from the first position of a chromosome to the last come out, those without depth too."""
    step = lambda at, by: F.struct(F.col(at).alias("pos"), *(F.when(F.col(layer) == k, F.lit(by)).otherwise(F.lit(0)).alias(n) for k, n in enumerate(names)))
    events = df.where(F.col(start) < F.col(end)).select(*keys, F.inline(F.array(step(start, 1), step(end, -1))))
    steps = events.groupBy(*keys, "pos").agg(*(F.sum(n).alias(n) for n in names)).where(" OR ".join(f"`{n}` <> 0" for n in names))
    steps = steps.withColumn("_tile", F.floor(F.col("pos") / tile))
    sums = steps.groupBy(*keys, "_tile").agg(*(F.sum(n).alias(n) for n in names), F.min("pos").alias("_first"))
    by_key, in_tile = Window.partitionBy(*keys).orderBy("_tile"), Window.partitionBy(*keys, "_tile").orderBy("pos")
    before = by_key.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, "_tile", *(F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_{n}") for n in names), F.lead("_first").over(by_key).alias("_next"))
    upto = in_tile.rowsBetween(Window.unboundedPreceding, 0)
    runs = steps.join(sums, [*keys, "_tile"])
    runs = runs.select(*keys, F.col("pos").alias(start), F.coalesce(F.lead("pos").over(in_tile), "_next").alias(end), *((F.col(f"_{n}") + F.sum(n).over(upto)).alias(n) for n in names))
    return runs.where(F.col(end).isNotNull())


def coverage(df: DataFrame, keys: list[str], tile: int = 1 << 22, start: str = "start", end: str = "end") -> DataFrame:
    """Runs of equal depth above zero: keys, start, end, depth.

    Opening and closing events add up by position before they are summed along a chromosome; the running sum starts in
    each tile from what the tiles before add up to."""
    events = df.where(F.col(start) < F.col(end)).select(*keys, F.inline(F.array(F.struct(F.col(start).alias("pos"), F.lit(1).alias("step")), F.struct(F.col(end).alias("pos"), F.lit(-1).alias("step")))))
    steps = events.groupBy(*keys, "pos").agg(F.sum("step").alias("step")).where("step <> 0").withColumn("_tile", F.floor(F.col("pos") / tile))
    tiles = steps.groupBy(*keys, "_tile").agg(F.sum("step").alias("sum"), F.min("pos").alias("first"))
    by_key = Window.partitionBy(*keys).orderBy("_tile")
    tiles = tiles.select(*keys, "_tile", F.coalesce(F.sum("sum").over(by_key.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"), F.lead("first").over(by_key).alias("_next"))
    in_tile = Window.partitionBy(*keys, "_tile").orderBy("pos")
    runs = steps.join(tiles, [*keys, "_tile"])
    runs = runs.select(
        *keys,
        F.col("pos").alias(start),
        F.coalesce(F.lead("pos").over(in_tile), "_next").alias(end),
        (F.col("_base") + F.sum("step").over(in_tile.rowsBetween(Window.unboundedPreceding, 0))).alias("depth"),
    )
    return runs.where("depth > 0")


def _bits(name: str, x: Column, n: Column | int) -> Column:
    return F.call_function(name, x, F.lit(n) if isinstance(n, int) else n)


def _border_of(pos: Column, level: int) -> Column:
    """The odd multiple of 2 ** level around which the places lie that first differ from `pos` in that bit, or don't."""
    if level == 63:  # ends of different signs
        return F.lit(0).cast("long")
    return _bits("shiftleft", _bits("shiftright", pos, level + 1), level + 1) + (1 << level) if level < 62 else _bits("shiftleft", _bits("shiftright", pos, 63), 63) + F.lit(1 << 62)


def totals(ranges: DataFrame, points: DataFrame, keys: list[str], sums: list[str], greatest: list[str] = [], start: str = "start", end: str = "end", at: str = "pos") -> DataFrame:  # noqa: B006
    """Adds to each range, both ends included, what the points of its keys in it come to: the sums of `sums` (0 for none), and the
    greatest of each of `greatest` (null for none). The points' columns are named unlike the ranges'.

    No range meets its points one by one. Bit k is the first in which a range's ends differ, so one odd multiple of 2 ** k, its border, lies
    between them. Points are added up by place, then each is a row for every border around it, one for each k that occurs, if
    that k's ranges reach so far (a row for each k comes to the driver). Sums that run away from a border on both sides then hold what
    a range's two parts come to, so work grows with ranges and with places, whatever lies on a place or in a range."""
    s, e = F.col(start).cast("long"), F.col(end).cast("long")
    real = F.coalesce(s <= e, F.lit(False))
    t = ranges.withColumn("_level", F.when(real, F.length(F.bin(s.bitwiseXOR(e))) - 1))
    border = F.when(~real, s).when(s == e, s.bitwiseOR(F.lit(1))).otherwise(_bits("shiftleft", _bits("shiftright", e, F.col("_level")), F.col("_level")))
    t = t.withColumn("_border", border)
    before, behind = F.col("_border") - s, e - F.col("_border")
    reach = t.where(F.col("_level").isNotNull()).groupBy("_level").agg(F.max(before).alias("before"), F.max(behind).alias("behind")).collect()  # 64 rows at most
    known = points.dropna(subset=[*keys, at]).select(*keys, F.col(at).cast("long").alias("_at"), *sums, *greatest)
    places = known.groupBy(*keys, "_at").agg(*(F.sum(c).alias(c) for c in sums), *(F.max(c).alias(c) for c in greatest))
    near = [F.lit(None).cast("long")]
    for r in reach:
        b = _border_of(F.col("_at"), r["_level"])
        near.append(F.when(F.col("_at").between(b - r["before"], b + r["behind"]), b))
    here = [F.col("_at").cast(ranges.schema[c].dataType).alias(c) for c in (start, end)]
    spread = places.select(*keys, *here, *sums, *greatest, F.explode(F.array_compact(F.array(*near))).alias("_border"), F.lit(False).alias("_range"))
    both = t.drop("_level").withColumn("_range", F.lit(True)).unionByName(spread, allowMissingColumns=True).repartition(*keys, "_border")  # distances needn't travel
    both = both.withColumns({"_from": F.when(real, before).otherwise(F.lit(-1)), "_to": F.when(real, behind).otherwise(F.lit(-1))})
    upto = lambda c: Window.partitionBy(*keys, "_border").orderBy(c).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    part = lambda f, c, by, inside: f(F.when(~F.col("_range") & inside, F.col(c))).over(upto(by))
    each = [(F.sum, c) for c in sums] + [(F.max, c) for c in greatest]
    both = both.withColumns({f"_before_{c}": part(f, c, "_from", F.col("_from") > 0) for f, c in each}).where(F.col("_range") | (F.col("_to") >= 0))
    both = both.withColumns({f"_behind_{c}": part(f, c, "_to", F.col("_to") >= 0) for f, c in each}).where("_range")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return both.select(*ranges.columns, *((zero(f"_before_{c}") + zero(f"_behind_{c}")).alias(c) for c in sums), *(F.greatest(f"_before_{c}", f"_behind_{c}").alias(c) for c in greatest))


def first_met(left: DataFrame, right: DataFrame, keys: list[str], value: str, start: str = "start", end: str = "end", tile: int = 1 << 20) -> DataFrame:
    """Adds to each left row the `value` of the first right row, by start, end and value, that it overlaps (both ends included); null for none.

    Only right rows that end behind all before them can be first; of those the first one that doesn't end before a left row is the only one to look at: an as-of
    join by union. Running values are taken within tiles of positions, then over a row a tile."""
    of_tile = lambda c: F.floor(F.col(c) / tile)
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    by_tile = Window.partitionBy(*keys)
    spans = right.dropna(subset=[*keys, start, end]).groupBy(*keys, start, end).agg(F.min(value).alias(value)).withColumn("_tile", of_tile(start))
    tiles = spans.groupBy(*keys, "_tile").agg(F.max(end).alias("_m")).select(*keys, "_tile", F.max("_m").over(before(by_tile.orderBy("_tile"))).alias("_reach"))
    spans = spans.withColumn("_own", F.max(end).over(before(Window.partitionBy(*keys, "_tile").orderBy(start, end)))).join(tiles, [*keys, "_tile"])
    ahead = F.coalesce(F.col(end) > F.greatest("_own", "_reach"), F.lit(True))
    marks = kept(spans.where(ahead).select(*keys, F.col(end).alias("_at"), F.struct(F.col(end).alias("end"), F.col(start).alias("start"), F.col(value).alias("value")).alias("_mark"), of_tile(end).alias("_tile")))
    rows = left.withColumns({"_at": F.col(start), "_tile": of_tile(start), "_row": F.lit(True)})
    every = marks.groupBy(*keys, "_tile").agg(F.min("_mark").alias("_mark")).unionByName(rows.select(*keys, "_tile").distinct(), allowMissingColumns=True)
    every = every.groupBy(*keys, "_tile").agg(F.min("_mark").alias("_mark")).select(*keys, "_tile", F.min("_mark").over(before(by_tile.orderBy(F.desc("_tile")))).alias("_later"))
    down = Window.partitionBy(*keys, "_tile").orderBy(F.desc("_at")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    met = rows.unionByName(marks, allowMissingColumns=True).withColumn("_next", F.min("_mark").over(down)).where("_row").join(every, [*keys, "_tile"], "left")
    first = F.coalesce("_next", "_later")
    return met.select(*left.columns, F.when(first["start"] <= F.col(end), first["value"]).alias(value))
