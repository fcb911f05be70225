"""Repeated windows of a corpus: what the substring and the suffix-array dedup share.

A window is a run of `window` units (words or bytes) of one text. It has an anchor: of its grams of `gram` units the one of
least hash, the leftmost of equals. Windows with the same anchor place are neighbours and make up a piece. Equal windows
have their anchor at the same place, so they lie in pieces with equal anchors: only pieces whose anchor occurs twice are
candidates, and nothing is sampled. One text of each candidate, with how often it occurs, goes to a shard of its anchor,
which a judge decides (an FM-index or a column-wise construction). Anchors with more than MAX_GROUP different pieces are
recut to single windows, which are counted: equal windows add up before the shuffle, so that no shard grows without bound.

Pieces are told apart by a 128-bit digest (BLAKE2b) of their bytes, words joined by one space each; single windows by two
independent hashes that double nonlinearly (a block's is scrambled from its halves'), so that no algebra of places makes
different ones alike; texts by two hashes of 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociflow.llm.common import BYTE_VALUES, SPACE_BYTES, U64, blocks, counted, flat, in_small_batches, mix, powers, stored, whole, word_hashes, words

MAX_GROUP = 16_384
SHARD_PIECES = 3000
_PLACE = U64((1 << 28) - 1)
_SPACED = bytes(32 if k in SPACE_BYTES else k for k in range(256))
PIECE = ["anchor", "piece_a", "piece_b"]
TEXT = ["text_a", "text_b"]
_PIECE = ", ".join(f"{c} long" for c in PIECE)
_TEXT = ", ".join(f"{c} long" for c in TEXT)


@dataclass(frozen=True)
class Units:
    kind: str
    window: int
    gram: int

    def of(self, data: np.ndarray, offsets: np.ndarray) -> Laid:
        """Values choose anchors only: they don't have to tell units apart, but equal ones must have equal values."""
        if self.kind == "bytes":
            return Laid(BYTE_VALUES[data], offsets, np.arange(len(data)), np.arange(1, len(data) + 1))
        starts, ends, values, at = words(data, offsets)
        return Laid(values, at, starts, ends)

    def exact(self, data: np.ndarray, laid: Laid) -> np.ndarray:
        """Values that tell units apart."""
        return laid.values if self.kind == "bytes" else word_hashes(data, laid.starts, laid.ends)[0]

    def odd_gaps(self, laid: Laid) -> np.ndarray:
        """How many words before each aren't parted from the next by one white space."""
        odd = np.zeros(len(laid.values) + 1, np.int32)
        if self.kind == "words":
            np.cumsum(laid.starts[1:] != laid.ends[:-1] + 1, out=odd[1:-1])
        return odd


@dataclass
class Laid:
    values: np.ndarray  # of all units
    at: np.ndarray  # len + 1 offsets of each text's units
    starts: np.ndarray  # where units begin and end in data
    ends: np.ndarray


@dataclass
class Pieces:
    text: np.ndarray
    first: np.ndarray  # unit at which the first window starts
    count: np.ndarray  # of windows
    lead: np.ndarray  # units from there to the anchor
    anchor: np.ndarray

    def bytes_of(self, units: Units, data: np.ndarray, laid: Laid, some: np.ndarray | None = None) -> list[bytes]:
        """The pieces' bytes, words parted by one space each."""
        first, count = (self.first, self.count) if some is None else (self.first[some], self.count[some])
        last = first + count + units.window - 2
        odd = units.odd_gaps(laid)
        raw = data.tobytes() if units.kind == "bytes" else data.tobytes().translate(_SPACED)
        out = [raw[a:b] for a, b in zip(laid.starts[first].tolist(), laid.ends[last].tolist(), strict=True)]
        for k in np.flatnonzero(odd[last] > odd[first]).tolist():
            out[k] = b" ".join(out[k].split())
        return out


def digests(contents: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each, as two halves."""
    h = hashlib.blake2b
    both = np.frombuffer(b"".join([h(c, digest_size=16).digest() for c in contents]), np.uint64).reshape(-1, 2)
    return np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1])


def cut_pieces(values: np.ndarray, at: np.ndarray, window: int, gram: int) -> Pieces:
    """The pieces of texts whose units are values[at[i]:at[i + 1]]."""
    n = len(values)
    count = np.maximum(np.diff(at) - window + 1, 0)
    total = int(count.sum())
    if not total:
        none = np.zeros(0, np.int64)
        return Pieces(none, none, none, none, none.view(np.uint64))
    g, span = values, 1
    while span < gram:  # a power of two
        h = g * powers(span)[span]
        h[: n - span] += g[span:]
        g, span = h, 2 * span
    g = mix(g)
    least = (g & ~_PLACE) | (np.arange(n, dtype=np.uint64) & _PLACE)
    width, span = window - gram + 1, 1
    while span < width:
        step = min(span, width - span)
        h = least.copy()
        np.minimum(least[: n - step], least[step:], out=h[: n - step])
        least, span = h, span + step
    ends = np.cumsum(count)
    s = np.arange(total) + np.repeat(at[:-1] - (ends - count), count)
    anchor = (least[s] & _PLACE).astype(np.int64)
    new = np.ones(total, bool)
    new[1:] = anchor[1:] != anchor[:-1]
    new[(ends - count)[count > 0]] = True
    k = np.flatnonzero(new)
    first, anchor, number = s[k], anchor[k], np.diff(np.append(k, total))
    text = np.searchsorted(ends, k, "right")
    return Pieces(text, first, number, anchor - first, g[anchor])


def window_hashes(values: np.ndarray, start: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of values[s : s + size] for each s of start."""
    out = []
    for salt in (0x2545F4914F6CDD1D, 0x9E6C63D0876A9A47):
        g, span = mix(values ^ U64(salt)), 1
        while 2 * span <= size:
            h = np.zeros_like(g)
            h[: len(g) - span] = mix(g[: len(g) - span] * U64(salt) + g[span:])
            g, span = h, 2 * span
        out.append(mix(g[start] * U64(salt) + g[start + size - span]))
    return out[0], out[1]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _distinct(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each different row of keys, and how often it comes."""
    order = np.lexsort(keys)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    at = np.flatnonzero(new)
    return order[at], np.diff(np.append(at, len(order)))


def _survey(units: Units) -> Callable:
    """Of each batch: anchor, piece, how often, and the hashes of a text that has it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column(2))
            one, two = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            found = []
            for i, j in blocks(offsets):
                part = data[offsets[i] : offsets[j]]
                laid = units.of(part, offsets[i : j + 1] - offsets[i])
                p = cut_pieces(laid.values, laid.at, units.window, units.gram)
                found.append((p.anchor, *digests(p.bytes_of(units, part, laid)), one[i:j][p.text], two[i:j][p.text]))
            if not found:
                continue
            *piece, a, b = (np.concatenate(x) for x in zip(*found, strict=True))
            k, n = _distinct(*piece)
            yield pa.RecordBatch.from_arrays([*(_signed(x[k]) for x in piece), pa.array(n), pa.array(a[k]), pa.array(b[k])], [*PIECE, "n", *TEXT])

    return run


def _occurrences(units: Units) -> Callable:
    """Each text's distinct pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column(2))
            one, two = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i, j in blocks(offsets):
                part = data[offsets[i] : offsets[j]]
                laid = units.of(part, offsets[i : j + 1] - offsets[i])
                p = cut_pieces(laid.values, laid.at, units.window, units.gram)
                piece = [p.anchor, *digests(p.bytes_of(units, part, laid))]
                yield pa.RecordBatch.from_arrays([*map(_signed, piece), pa.array(one[i:j][p.text]), pa.array(two[i:j][p.text])], [*PIECE, *TEXT])

    return run


def _fetch(units: Units) -> Callable:
    """The bytes of wanted pieces, with where their anchor lies and how many windows they have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column(0))
            lists = batch.column(1)
            wanted = [c.to_numpy().view(np.uint64) for c in lists.flatten().flatten()]
            edges = lists.offsets.to_numpy()
            edges = edges - edges[0]
            for i, j in blocks(offsets):
                part = data[offsets[i] : offsets[j]]
                laid = units.of(part, offsets[i : j + 1] - offsets[i])
                p = cut_pieces(laid.values, laid.at, units.window, units.gram)
                k = np.flatnonzero(np.isin(p.anchor, wanted[0][edges[i] : edges[j]]))
                contents = p.bytes_of(units, part, laid, k)
                a, b = digests(contents)
                use = np.isin(a, wanted[1][edges[i] : edges[j]]) & np.isin(b, wanted[2][edges[i] : edges[j]])
                own = np.flatnonzero(use)
                own = own[_distinct(p.anchor[k][own], a[own], b[own])[0]]
                k = k[own]
                yield pa.RecordBatch.from_arrays(
                    [_signed(p.anchor[k]), _signed(a[own]), _signed(b[own]), pa.array(p.lead[k].astype(np.int32)), pa.array(p.count[k].astype(np.int32)), pa.array([contents[x] for x in own], pa.binary())],
                    [*PIECE, "lead", "windows", "content"],
                )

    return run


def _windows(units: Units) -> Callable:
    """Each window of pieces of crowded anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column(3))
            laid = units.of(data, offsets)
            number = np.diff(laid.at) - units.window + 1
            place = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
            hashes = window_hashes(units.exact(data, laid), np.repeat(laid.at[:-1], number) + place, units.window)
            own = [pa.array(np.repeat(batch.column(k).to_numpy(), number)) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*map(_signed, hashes), *own, pa.array(place.astype(np.int32))], ["hash_a", "hash_b", *PIECE, "place"])

    return run


def _marked(groups: pa.Table) -> pa.Table:
    """place lists to masks."""
    lists = groups.column("places").combine_chunks()
    masks = [np.packbits(np.bincount(x.as_py()).astype(bool)).tobytes() for x in lists]
    return groups.drop_columns(["places"]).append_column("mask", pa.array(masks, pa.binary()))


Judge = Callable[[list[bytes], np.ndarray, np.ndarray, np.ndarray], list[np.ndarray]]


def _judged(judge: Judge) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        contents, lead, count, often = table["content"].to_pylist(), table["lead"].to_numpy(), table["windows"].to_numpy(), table["n"].to_numpy()
        masks = judge(contents, lead, count, often)
        use = [k for k, m in enumerate(masks) if m.any()]
        bits = [None if masks[k].all() else np.packbits(masks[k]).tobytes() for k in use]
        return pa.table({c: table[c].take(pa.array(use, pa.int64())) for c in PIECE} | {"mask": pa.array(bits, pa.binary())})

    return run




def _again(column: str) -> Column:
    """A join key on which the other side isn't dealt out yet, so that the join may split a hot one."""
    return F.col(column).bitwiseXOR(F.lit(1)).alias(f"_{column}")


def repeated_pieces(texts: DataFrame, units: Units, judge: Judge, max_group: int = MAX_GROUP, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """anchor, piece, mask: for every piece with a repeated window a bit for each window, or null if all are repeated."""
    seen = texts.mapInArrow(_survey(units), f"{_PIECE}, n long, {_TEXT}")
    seen = seen.groupBy(*PIECE).agg(F.sum("n").alias("n"), F.min(F.struct(*TEXT)).alias("text"))
    # Anchors that occur twice. Counts add up before the shuffle, and the join may split a crowded anchor.
    crowd = seen.groupBy("anchor").agg(F.count(F.lit(1)).alias("others"), F.sum("n").alias("total")).where("total > 1").select(_again("anchor"), "others")
    candidates, number = counted(seen.withColumn("_anchor", _again("anchor")).join(crowd, "_anchor").drop("_anchor"), crowded=(F.col("others") > max_group).cast("int"))

    wanted = candidates.groupBy("text").agg(F.collect_list(F.struct(*PIECE)).alias("wanted")).select("text.*", "wanted")
    once = texts.groupBy(*TEXT).agg(F.first("text").alias("text"))
    fetched = once.join(wanted, TEXT).select("text", "wanted").mapInArrow(_fetch(units), f"{_PIECE}, lead int, windows int, content binary")
    shards = max(1, -(-number["rows"] // shard_pieces))
    known = candidates.select(*PIECE, "n", "others", F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int").alias("shard"))
    fetched = fetched.join(known, PIECE)
    fetched = stored(fetched) if number["crowded"] else fetched
    small = fetched.where(F.col("others") <= max_group).select("shard", *PIECE, "n", "lead", "windows", "content")
    result = small.groupBy("shard").applyInArrow(_judged(judge), f"{_PIECE}, mask binary")
    if number["crowded"]:
        crowded = fetched.where(F.col("others") > max_group)
        each = crowded.where("n = 1").select(*PIECE, "content").mapInArrow(_windows(units), f"hash_a long, hash_b long, {_PIECE}, place int")
        all_windows = each.select("hash_a", "hash_b").union(crowded.where("n > 1").select(*PIECE, "content").mapInArrow(_windows(units), f"hash_a long, hash_b long, {_PIECE}, place int").select("hash_a", "hash_b"))
        twice = all_windows.groupBy("hash_a", "hash_b").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(_again("hash_a"), "hash_b")
        hits = each.withColumn("_hash_a", _again("hash_a")).join(twice, ["_hash_a", "hash_b"]).groupBy(*PIECE).agg(F.collect_set("place").alias("places"))
        marked = hits.mapInArrow(lambda batches: (_marked(pa.Table.from_batches([b])).to_batches()[0] for b in batches if b.num_rows), f"{_PIECE}, mask binary")
        result = result.union(marked).union(crowded.where("n > 1").select(*PIECE, F.lit(None).cast("binary")))
    return result


def with_repeats(docs: DataFrame, units: Units, judge: Judge, max_group: int = MAX_GROUP) -> DataFrame:
    """doc_id, text, and the repeated pieces (anchors, pieces, masks) of each text, null if there are none."""
    hashes = [F.xxhash64("text").alias("text_a"), F.xxhash64(F.lit("second"), F.col("text")).alias("text_b")]
    rows = in_small_batches(docs).select("doc_id", whole("text").alias("text")).select("doc_id", "text", *hashes)
    texts = rows.select(*TEXT, "text")
    pieces = stored(repeated_pieces(texts, units, judge, max_group))
    has = texts.mapInArrow(_occurrences(units), f"{_PIECE}, {_TEXT}").join(pieces, PIECE)
    has = has.groupBy(*TEXT).agg(F.collect_set(F.struct(*PIECE, "mask")).alias("found")).select(_again("text_a"), F.col("text_b").alias("_text_b"), "found")
    found = rows.withColumns({"_text_a": _again("text_a"), "_text_b": F.col("text_b")}).join(has, ["_text_a", "_text_b"], "left")
    return found.select("doc_id", "text", *(F.col(f"found.{c}").alias(f"found_{c}") for c in PIECE), F.col("found.mask").alias("masks"))


Found = list[dict[tuple[int, int, int], bytes | None]]


def covered(data: np.ndarray, laid: Laid, units: Units, found: Found) -> np.ndarray:
    """Of each unit: whether a repeated window covers it. found: of each text its repeated pieces' masks."""
    out = np.zeros(len(laid.values) + 1, np.int32)
    p = cut_pieces(laid.values, laid.at, units.window, units.gram)
    use = np.flatnonzero(np.array([bool(x) for x in found], bool)[p.text])
    keys = [p.anchor[use], *digests(p.bytes_of(units, data, laid, use))]
    for k, key in zip(use.tolist(), zip(*(x.view(np.int64).tolist() for x in keys), strict=True), strict=True):
        by = found[p.text[k]]
        if key not in by:
            continue
        mask, first, count = by[key], p.first[k], p.count[k]
        if mask is None:
            out[first] += 1
            out[first + count + units.window - 1] -= 1
        else:
            s = first + np.flatnonzero(np.unpackbits(np.frombuffer(mask, np.uint8))[:count])
            out[s] += 1  # distinct
            out[s + units.window] -= 1
    return np.cumsum(out[:-1]) > 0


def found_of(batch: pa.RecordBatch) -> Found:
    out = []
    for *piece, masks in zip(*(batch.column(c) for c in (*(f"found_{c}" for c in PIECE), "masks")), strict=True):
        if not masks.is_valid:
            out.append({})
        else:
            out.append(dict(zip(zip(*(x.values.to_numpy().tolist() for x in piece), strict=True), masks.as_py(), strict=True)))
    return out
