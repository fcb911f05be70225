"""Near-dedup with SetSketch registers.

A document's set holds the distinct shingles of its lower-cased words. Register j holds the truncated logarithm, to a base
just above 1, of the least of the shingles' j-th exponential variates: sketches of parts merge by the larger register, and
equal registers tell of similar sets. Bands of register values propose candidates; a candidate's similarity is estimated
jointly from both sketches by likelihood; what may reach the threshold is verified on the full sets of the words themselves. Equal
sets are told by two sums of 64 bits over hashes that don't depend on each other.

Equal sets are one class from the start; a class has a number of its own, so doc_ids may repeat or be missing. Pairing a
bucket's members would cost its square, so candidates come in two ways:

* Rounds of leaders. Each bucket's best connected member meets all others of the bucket; classes contract; the best of those
  that are still apart from it leads the next round, as long as rounds link a fair share of what they compare. A round costs a
  comparison a member.
* An exact filter for buckets that still hold several classes. With L the bucket's first leader, let D_x be what x and L
  don't share (either way) and k = (1 - s) / (1 + s). Sets x, y are linked exactly if |x ^ y| <= k (|x| + |y|), where ^ is the
  symmetric difference, and |D_x & D_y| = (|D_x| + |D_y| - |x ^ y|) / 2, so a link shares at least (w_x + w_y) / 2 elements
  of D with w_x = |D_x| - k |x|. That is more than zero where either is not linked with L, so the rarest of D, a prefix, meet.
  Only pairs that meet so are estimated and verified, and no link between different classes is lost.

With BANDS of ROWS registers, a pair at the threshold s fails to meet with probability (1 - s ** ROWS) ** BANDS.

Defined results: a text without words (or null) has an empty set and is linked with nothing; rows without doc_id take part
by their text, a component's id being its smallest doc_id, and null where it has none; rows that repeat a doc_id take part
each by its own text; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociflow.llm.common import U64, blocks, counted, flat, in_small_batches, mix, stored, whole, word_hashes, word_spans
from lociflow.llm.components import components

BANDS, ROWS = 20, 4
REGISTERS = BANDS * ROWS
# SetSketch's parameters: base, rate of the exponential variates, largest register.
B, RATE, TOP = 1.001, 20.0, (1 << 16) - 2
#: An estimate may fall short of the threshold by this many standard deviations.
DEVIATIONS = 6.0
#: Texts whose shingles are hashed together: few enough to stay in the cache.
SLICE = 64
_random = np.random.default_rng(71)
FACTORS = _random.integers(1, 2**63, REGISTERS, dtype=np.uint64) * U64(2) + U64(1)
TERMS = _random.integers(0, 2**63, REGISTERS, dtype=np.uint64)


def shingles(data: np.ndarray, offsets: np.ndarray, width: int, second: bool = False) -> tuple[np.ndarray, ...]:
    """The sorted distinct shingle hashes of each text, and len + 1 offsets; a text of fewer words is one shingle. second: also
    hashes of the same shingles that don't depend on the first."""
    starts, ends, at = word_spans(data, offsets)
    n = np.diff(at)
    doc = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(doc)) - at[:-1][doc]
    use = (place <= n[doc] - width) | (place == 0)
    here = [np.arange(len(doc)) + k < at[1:][doc] for k in range(width)]
    found = []
    for h in word_hashes(data, starts, ends, True, (0, 1) if second else (0,)):
        total = np.zeros(len(h), np.uint64)
        for k in range(width):
            part = np.zeros(len(h), np.uint64)
            part[: len(h) - k] = mix(h[k:] + U64((k + 1) * 0xC2B2AE3D27D4EB4F % 2**64))
            total += np.where(here[k], part, U64(0))
        found.append(mix(total[use]))
    h, doc = found[0], doc[use]
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    edges = np.searchsorted(doc[new], np.arange(len(n) + 1))
    return (h[new], edges, found[1][order][new]) if second else (h[new], edges)


def shingle_set(text: str, width: int) -> set[tuple[bytes, ...]]:
    """The shingles themselves."""
    own = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z, and the white space that separates words
    return {tuple(own[i : i + width]) for i in range(max(1, len(own) - width + 1))} if own else set()


def registers(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row of REGISTERS 16-bit registers for each set h[at[i]:at[i + 1]]; empty sets have zeros."""
    some = np.flatnonzero(np.diff(at))
    out = np.zeros((len(at) - 1, REGISTERS), np.uint16)
    if len(some):
        least = np.empty((REGISTERS, len(some)), np.uint64)
        value = np.empty_like(h)
        for j in range(REGISTERS):
            np.multiply(h, FACTORS[j], out=value)
            value += TERMS[j]
            np.minimum.reduceat(value, at[some], out=least[j])
        v = -np.log1p(-(least.T.astype(np.float64) + 0.5) / 2.0**64) / RATE
        out[some] = np.clip(np.floor(1 - np.log(np.maximum(v, 1e-300)) / np.log(B)), 0, TOP + 1)
    return out


def likeliest(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The Jaccard similarity under which registers x and y of sets of n and m elements are likeliest."""
    more, less = (x > y).sum(1), (x < y).sum(1)
    same = x.shape[1] - more - less
    u = (n / (n + m))[:, None]
    v = 1 - u
    j = np.linspace(0, 1, 101)[None, :] * np.minimum(u / v, v / u)
    p = lambda z: -np.log1p(-np.clip(z, 0, 1) * (B - 1) / B) / np.log(B)
    a, b = p(u - v * j), p(v - u * j)
    fit = more[:, None] * np.log(np.maximum(a, 1e-12)) + less[:, None] * np.log(np.maximum(b, 1e-12)) + same[:, None] * np.log(np.maximum(1 - a - b, 1e-12))
    return np.take_along_axis(j, fit.argmax(1)[:, None], 1)[:, 0]


def _sketch(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            data, offsets = flat(batch.column(3))
            for i, j in blocks(offsets):
                h, edges, other = shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], width, second=True)
                n = np.diff(edges)
                sums = []
                for value in (h, other):
                    total = np.zeros(len(h) + 1, np.uint64)
                    np.cumsum(mix(value + U64(0x632BE59BD9B4E019)), out=total[1:])
                    sums.append((total[edges[1:]] - total[edges[:-1]]).astype(np.int64))
                rows.append((n, *sums, registers(h, edges)))
            if not rows:
                continue
            n, a, b, r = (np.concatenate(x) for x in zip(*rows, strict=True))
            sketch = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * REGISTERS), len(n), [None, pa.py_buffer(np.ascontiguousarray(r))]).cast(pa.binary())
            names = ["doc_id", "hash_a", "hash_b", "n_shingles", "set_a", "set_b", "sketch"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(n), pa.array(a), pa.array(b), sketch], names)

    return run


def _table(column: pa.Array) -> np.ndarray:
    data, _ = flat(column)
    return data.view(np.uint16).reshape(-1, REGISTERS)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        r = _table(batch.column(1)).astype(np.uint64).reshape(-1, BANDS, ROWS)
        key = np.zeros(r.shape[:2], np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * U64(0x9E3779B97F4A7C15)
        for k in range(ROWS):
            key = mix(key + r[:, :, k] * U64(0xD1B54A32D192ED03))
        yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(np.repeat(batch.column(0).to_numpy(), BANDS))], ["bucket", "id"])


def _may_reach(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, n, m, x, y = batch.columns
            n, m = n.to_numpy().astype(float), m.to_numpy().astype(float)
            guess = likeliest(_table(x), _table(y), n, m)
            slack = DEVIATIONS * np.sqrt(threshold * (1 - threshold) / REGISTERS)
            use = pa.array((guess >= threshold - slack) & (np.minimum(n, m) >= np.floor(threshold * np.maximum(n, m))))
            yield pa.RecordBatch.from_arrays([a.filter(use), b.filter(use)], ["a", "b"])

    return run


def _verify(width: int, percent: int):
    """a, b, linked: the words themselves are compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked, before, one = [], None, set()
            for s, t in zip(batch.column(2), batch.column(3), strict=True):
                s = s.as_py()
                if s != before:
                    before, one = s, shingle_set(s, width)
                two = shingle_set(t.as_py(), width)
                common = len(one & two)
                linked.append(100 * common >= percent * (len(one) + len(two) - common))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    return run


def _apart(width: int):
    """leader, id, inside, n, n_leader, d, element: what a set and its leader don't share, d elements, a row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE // 4):  # a row for each element comes out
                part = batch.slice(at, SLICE // 4)
                (h, p), (g, q) = shingles(*flat(part.column(3)), width), shingles(*flat(part.column(4)), width)
                rest = [np.setxor1d(h[p[i] : p[i + 1]], g[q[i] : q[i + 1]], assume_unique=True) for i in range(part.num_rows)]
                size = np.array([len(r) for r in rest], np.int64)
                each = [*(c.to_numpy(zero_copy_only=False) for c in part.columns[:3]), np.diff(p), np.diff(q), size]
                yield pa.RecordBatch.from_arrays([*(pa.array(np.repeat(c, size)) for c in each), pa.array(np.concatenate(rest).view(np.int64))], ["leader", "id", "inside", "n", "n_leader", "d", "element"])

    return run


KEY = ["set_a", "set_b", "n_shingles"]
#: A further round of leaders is worth its comparisons if the last one linked this share of them.
WORTH = 0.05


def _hashes(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("hash_a"), F.xxhash64(F.lit("second"), text).alias("hash_b")]


def _sketched(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, hash_a, hash_b of the text, and its set's size, key and sketch, for every row."""
    kind = dict(docs.dtypes)["doc_id"]
    rows = in_small_batches(docs).select("doc_id", *_hashes(whole("text")), whole("text").alias("text"))
    return stored(rows.mapInArrow(_sketch(width), f"doc_id {kind}, hash_a long, hash_b long, n_shingles long, set_a long, set_b long, sketch binary"))


def _again(column: str) -> Column:
    """A join key on which the other side isn't dealt out yet, so that the join may split a hot one."""
    return F.col(column).bitwiseXOR(F.lit(1))


def _components(docs: DataFrame, rows: DataFrame, width: int, percent: int) -> DataFrame:
    """Of every set in `rows`: its key, component_id (the smallest doc_id of its component) and root, a number of the component."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "hash_a", "hash_b")).alias("first")
    sets = rows.where("n_shingles > 0").groupBy(*KEY).agg(first, F.max("sketch").alias("sketch"))
    sets = stored(sets.withColumn("id", F.monotonically_increasing_id()))
    known = sets.select("id", F.col("n_shingles").alias("n"), "sketch")

    spread = known.select("id", "sketch").mapInArrow(_bands, "bucket long, id long")
    full = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select(_again("bucket").alias("_bucket"), "members")
    shared = stored(spread.withColumn("_bucket", _again("bucket")).join(full, "_bucket").select("bucket", "id", "members"))
    degree = shared.groupBy("id").agg(F.sum("members").alias("degree"))
    shared = stored(shared.select("bucket", "id").join(degree, "id"))
    wanted = sets.join(degree.select("id"), "id").select("id", F.col("first.doc_id").alias("_doc_id"), F.col("first.hash_a").alias("_a"), F.col("first.hash_b").alias("_b"))
    texts = docs.select("doc_id", *_hashes(whole("text")), whole("text").alias("text"))
    texts = texts.join(wanted.hint("merge"), (F.col("hash_a") == F.col("_a")) & (F.col("hash_b") == F.col("_b")) & F.col("doc_id").eqNullSafe(F.col("_doc_id")))
    texts = stored(texts.select("id", "text").dropDuplicates(["id"]))
    verified = functools.partial(_verified, known=known, texts=texts, width=width, percent=percent)

    links, roots, shared, pivots = _led(shared, verified)
    pairs, left = counted(_meeting(shared, pivots, texts, width, percent))
    if left["rows"]:
        found, more = counted(verified(pairs))
        roots = components(links.union(found)) if more["rows"] else roots

    placed = sets.select("id", *KEY, F.col("first.doc_id").alias("doc_id")).join(roots.withColumnRenamed("node", "id"), "id", "left")
    placed = placed.withColumn("root", F.coalesce("root", "id"))
    least = placed.groupBy("root").agg(F.min("doc_id").alias("component_id")).select(_again("root").alias("_root"), "component_id")
    return placed.select(*KEY, "root").withColumn("_root", _again("root")).join(least, "_root").drop("_root")


def _led(shared: DataFrame, verified: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The rounds of leaders: links, roots of their components, shared with roots, and bucket, leader of the first round."""
    left = shared.withColumn("root", F.col("id"))
    links = pivots = None
    while True:
        top = left.groupBy("bucket").agg(F.max(F.struct("degree", "id", "root")).alias("top"), F.min("root").alias("_low"), F.max("root").alias("_high")).where("_low < _high")
        top = stored(top.select("bucket", F.col("top.id").alias("leader"), F.col("top.root").alias("_led")))
        by = top.select(_again("bucket").alias("_bucket"), "leader", "_led")
        meet = left.withColumn("_bucket", _again("bucket")).join(by, "_bucket").where("root <> _led").select(F.col("id").alias("a"), F.col("leader").alias("b"))
        meet, seen = counted(meet.distinct())
        found, linked = counted(verified(meet))
        links = found if links is None else stored(links.union(found))
        roots = stored(components(links))
        pivots = top.select("bucket", "leader") if pivots is None else pivots
        shared = shared.drop("root").join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
        if linked["rows"] < max(1, WORTH * seen["rows"]):
            return links, roots, stored(shared), pivots
        # Whoever is apart from the leader's class goes on.
        led = top.select("bucket", "leader").join(roots.withColumnRenamed("node", "leader"), "leader", "left").select(_again("bucket").alias("_bucket"), F.coalesce("root", "leader").alias("_led"))
        rest = left.select("bucket", "id", "degree").join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
        left = stored(rest.withColumn("_bucket", _again("bucket")).join(led, "_bucket").where("root <> _led").select("bucket", "id", "degree", "root"))


def _meeting(shared: DataFrame, pivots: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """a, b: the pairs of different classes that share a bucket and may be linked, by the exact filter."""
    mixed = shared.groupBy("bucket").agg(F.min("root").alias("_low"), F.max("root").alias("_high")).where("_low < _high").join(pivots, "bucket").select(_again("bucket").alias("_bucket"), "leader")
    led = shared.withColumn("_bucket", _again("bucket")).join(mixed, "_bucket").select("leader", "id", "root").distinct()
    top = shared.select(F.col("id").alias("leader"), F.col("root").alias("_led")).distinct()
    led = stored(led.where("leader <> id").join(top.join(led.select("leader").distinct(), "leader"), "leader").withColumn("inside", F.col("root") == F.col("_led")).drop("_led"))
    both = led.select("leader", "id", "inside").join(texts, "id").join(texts.select(F.col("id").alias("leader"), F.col("text").alias("_text")), "leader")
    apart = both.select("leader", "id", "inside", "text", "_text").mapInArrow(_apart(width), "leader long, id long, inside boolean, n long, n_leader long, d long, element long")
    apart = stored(apart)

    # In units of 1 / (100 + percent): weight w, and of the elements of D that a link shares at least, half the sum of weights.
    unit, part = 100 + percent, 100 - percent
    weight = unit * F.col("d") - part * F.col("n")
    outside = part * F.col("n_leader")  # the weight of sets that aren't linked with the leader is greater
    whole_up = lambda c: F.greatest(F.ceil(c), F.lit(1))
    inner = F.when(F.col("inside"), (F.col("w") + outside) / (2 * unit)).otherwise(F.lit(0))
    # As the lighter of two, and as the heavier one: a lighter x has w_y <= d_x + k n_x.
    light, heavy = whole_up(F.greatest(F.col("w") / unit, inner)), whole_up(F.greatest((F.col("w") - part * F.floor(100 * F.col("n") / percent)) / unit, inner))
    held = apart.groupBy("leader", "element").agg(F.count(F.lit(1)).alias("held")).where("held > 1").select(_again("leader").alias("_leader"), F.col("element").alias("_element"), "held")
    ranked = apart.join(held, (_again("leader") == F.col("_leader")) & (F.col("element") == F.col("_element")), "left").drop("_leader", "_element")
    order = Window.partitionBy("leader", "id").orderBy(F.coalesce("held", F.lit(1)), "element")
    ranked = ranked.withColumn("place", F.row_number().over(order)).where("held > 1").withColumn("w", weight)
    ranked = ranked.withColumn("light", F.col("place") <= F.col("d") - light + 1).where(F.col("place") <= F.col("d") - heavy + 1)
    ranked = ranked.select("leader", "id", "element", "n", "d", "w", "place", "light").join(led.select("leader", "id", "root"), ["leader", "id"])
    ranked = stored(ranked)
    several = ranked.groupBy("leader", "element").agg(F.min("root").alias("_low"), F.max("root").alias("_high")).where("_low < _high").select("leader", "element")
    ranked = ranked.join(several.select(_again("leader").alias("_leader"), F.col("element").alias("_element")), (_again("leader") == F.col("_leader")) & (F.col("element") == F.col("_element"))).drop("_leader", "_element")
    x, y = (ranked.select("leader", "element", *(F.col(c).alias(f"{c}_{k}") for c in ("id", "root", "n", "d", "w", "place", "light"))) for k in "xy")
    lighter = (F.col("w_x") < F.col("w_y")) | ((F.col("w_x") == F.col("w_y")) & (F.col("id_x") < F.col("id_y")))
    alike = (F.col("root_x") != F.col("root_y")) & (F.least("n_x", "n_y") * 100 >= F.greatest("n_x", "n_y") * percent)
    # From the first element that they share, no more than the shorter rest can follow.
    enough = 2 * unit * (1 + F.least(F.col("d_x") - F.col("place_x"), F.col("d_y") - F.col("place_y"))) >= F.col("w_x") + F.col("w_y")
    meet = x.where("light_x").join(y, (x["leader"] == y["leader"]) & (x["element"] == y["element"]) & lighter & alike & enough)
    return meet.select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b")).distinct()


def _verified(pairs: DataFrame, known: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Of the pairs (a, b) those that are linked: the joint estimate lets them through, and their full sets are compared."""
    a, b = (known.select(F.col("id").alias(k), F.col("n").alias(f"n_{k}"), F.col("sketch").alias(f"sketch_{k}")) for k in "ab")
    likely = pairs.join(b, "b").join(a, "a").select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(_may_reach(percent / 100), "a long, b long")
    s, t = (texts.select(F.col("id").alias(k), F.col("text").alias(f"text_{k}")) for k in "ab")
    both = likely.join(t, "b").join(s, "a").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_verify(width, percent), "a long, b long, linked boolean").where("linked").select("a", "b")


def link(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of `docs`(doc_id, text).

    Documents are linked where 100 * intersection >= percent * union of their sets of `width`-word shingles. Rows without
    doc_id are kept if their component has no doc_id."""
    rows = _sketched(docs, width)
    out = rows.drop("sketch").join(_components(docs, rows, width, percent).drop("root"), KEY, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def dedup(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows that stay, one of each component, with their own columns: the one with the smallest doc_id, any of repeated
    rows, one without doc_id only where the component has none. Texts without words all stay."""
    rows = _sketched(docs, width)
    row = ["doc_id", "hash_a", "hash_b"]
    placed = stored(rows.where("n_shingles > 0").join(_components(docs, rows, width, percent), KEY).select("root", *row))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), *row)).alias("first")
    stays = placed.groupBy("root").agg(first).select(_again("root").alias("_root"), "first")
    same = F.lit(True)
    for c in row:
        same = same & F.col(c).eqNullSafe(F.col(f"first.{c}"))
    marked = placed.withColumn("_root", _again("root")).join(stays, "_root").select(*row, same.alias("stays"))
    copies = marked.groupBy(*row).agg(F.max("stays").alias("stays"), F.count(F.lit(1)).alias("copies"))
    odd, seen = counted(copies.where("NOT stays OR copies > 1"), again=F.col("stays").cast("int"))

    inner = docs.select(F.struct("*").alias("row"), *_hashes(whole("text")))
    on = (F.col("hash_a") == F.col("_a")) & (F.col("hash_b") == F.col("_b")) & F.col("row.doc_id").eqNullSafe(F.col("_doc_id"))
    names = [F.col("doc_id").alias("_doc_id"), F.col("hash_a").alias("_a"), F.col("hash_b").alias("_b")]
    out = inner.join(odd.select(*names), on, "left_anti")
    if seen["again"]:
        repeated = inner.join(odd.where("stays").select(*names), on, "left_semi").withColumn("_doc_id", F.col("row.doc_id"))
        out = out.unionByName(repeated.dropDuplicates(["_doc_id", "hash_a", "hash_b"]).drop("_doc_id"))
    return out.select("row.*")
