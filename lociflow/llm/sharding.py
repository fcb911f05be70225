"""Sharding by histogram sort.

Keys are 63-bit numbers: 32 bits of the text's hash, then 31 of the doc_id's, so that equal texts are neighbours. Rows with
equal keys are parted by a third, random one of 63 bits, which a checkpoint keeps. Counting rounds find the splitters: each
round counts, over all partitions, the exact bytes below some probes inside every splitter's interval, and narrows it, until
the bytes below a splitter are within the tolerance of its target. Then rows are exchanged once and sorted by key.

A shard is sorted by as many tasks as its rows need, parts between splitters of a wider tolerance. What comes to the driver is
a number for each probe and part.

Law `bytes`: shards hold nearly equal bytes. Defined results: a null text has no bytes (size 1) and hashes as empty; null
doc_ids share one key; repeated rows are parted like others; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociflow.llm.common import cut, utf8, whole

SHARDS = 16
#: Probes that a round has inside the interval of a splitter between shards, and of one between a shard's parts.
PROBES, PART_PROBES = 64, 8
TOLERANCE, PART_TOLERANCE = 0.001, 0.2
#: Rows that one sorting task should hold.
PART_ROWS = 4_000_000
TIE_BITS = 63
TOP = 1 << (63 + TIE_BITS)


def sized(docs: DataFrame) -> DataFrame:
    text = whole("text")
    key = F.shiftleft(F.shiftrightunsigned(F.xxhash64(text), 32), 31).bitwiseOR(F.shiftrightunsigned(F.xxhash64(F.lit("shard"), F.col("doc_id")), 33))
    tie = F.shiftrightunsigned(F.xxhash64(F.lit("tie"), F.monotonically_increasing_id()), 1)
    return docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(utf8(text)).alias("text_crc32"), key.alias("key"), tie.alias("tie"))


def places(probes: list[int]):
    """What finds, for keys and ties, how many of the ascending probes (key << TIE_BITS | tie) are at or below them."""
    keys = np.array([p >> TIE_BITS for p in probes], np.int64)
    ties = np.array([p & ((1 << TIE_BITS) - 1) for p in probes], np.int64)

    def find(key: np.ndarray, tie: np.ndarray) -> np.ndarray:
        first, at = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
        even = np.flatnonzero(first < at)  # rows with the key of some probes: their ties tell
        for k in np.unique(key[even]):
            rows = even[key[even] == k]
            a, b = first[rows[0]], at[rows[0]]
            at[rows] = a + np.searchsorted(ties[a:b], tie[rows], "right")
        return at

    return find


def bytes_between(rows: DataFrame, probes: list[int]) -> np.ndarray:
    """The bytes before the first probe, between neighbours, and from the last one on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, total = places(probes), np.zeros(len(probes) + 1, np.int64)
        for batch in batches:
            key, tie, size = (c.to_numpy() for c in batch.columns)
            total += np.bincount(find(key, tie), size, len(total)).astype(np.int64)
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total[place])], ["place", "bytes"])

    out = np.zeros(len(probes) + 1, np.int64)
    sums = rows.select("key", "tie", "size").mapInArrow(run, "place long, bytes long").groupBy("place").agg(F.sum("bytes").alias("bytes"))
    for r in sums.collect():
        out[r["place"]] = r["bytes"]
    return out


def splitters(rows: DataFrame, shards: int, per_shard: int, total: int, tolerance: float = TOLERANCE) -> list[int]:
    """shards * per_shard - 1 ascending keys (with ties) between parts; each per_shard-th one is between shards."""
    parts = shards * per_shard
    target = [total * (i + 1) / parts for i in range(parts - 1)]
    exact = [(i + 1) % per_shard == 0 for i in range(parts - 1)]
    near = [tolerance * total / shards if e else PART_TOLERANCE * total / parts for e in exact]
    # Of each splitter: an interval of keys, the bytes below its ends, and at last its key.
    low, below, high, below_high = [0] * len(target), [0] * len(target), [TOP - 1] * len(target), [total] * len(target)
    found: list[int | None] = [None] * len(target)
    while left := [i for i in range(len(target)) if found[i] is None]:
        probes: set[int] = set()
        for i in left:
            n = PROBES if exact[i] else PART_PROBES
            probes.update(low[i] + (high[i] - low[i]) * j // (n + 1) for j in range(1, n + 1))
        at = sorted(probes)
        under = np.cumsum(bytes_between(rows, at))[:-1].tolist()  # bytes below each probe
        for i in left:
            k = int(np.searchsorted(under, target[i], "right"))
            ends = [(low[i], below[i]), (high[i], below_high[i]), *((at[j], under[j]) for j in (k - 1, k) if 0 <= j < len(at))]
            low[i], below[i] = max(e for e in ends if e[1] <= target[i])
            high[i], below_high[i] = min(e for e in ends if e[1] > target[i] or e[0] == high[i])
            best = min(ends, key=lambda e: abs(e[1] - target[i]))
            if abs(best[1] - target[i]) <= near[i] or high[i] - low[i] <= 1:
                found[i] = best[0]
    return sorted(found)


def shard(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, part_rows: int = PART_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (gapless from 0 in each shard), grown_shard."""
    spark, kind = docs.sparkSession, dict(docs.dtypes)["doc_id"]
    rows = cut(sized(docs))
    whole_size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).first()
    n, total = whole_size["n"], whole_size["bytes"] or 0
    per_shard = max(1, -(-n // (shards * part_rows)))
    edges = splitters(rows, shards, per_shard, total, tolerance) if n else [TOP - 1] * (shards - 1)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = places(edges)
        for batch in batches:
            part = find(batch.column("key").to_numpy(), batch.column("tie").to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part.astype(np.int32))], [*batch.schema.names, "part"])

    rows = rows.mapInArrow(placed, f"doc_id {kind}, size long, text_crc32 long, key long, tie long, part int")
    counts = {r["part"]: r["n"] for r in rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, at = [], 0
    for p in range(shards * per_shard):
        at = 0 if p % per_shard == 0 else at
        starts.append((p, at))
        at += counts.get(p, 0)
    start = spark.createDataFrame(starts, "part int, start long")  # a row for each part
    order = Window.partitionBy("part").orderBy("key", "doc_id", "tie")
    rows = rows.withColumn("place", F.row_number().over(order) - 1).join(F.broadcast(start), "part")
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.expr(f"part div {per_shard}").cast("int").alias("shard"),
        (F.col("start") + F.col("place")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
