"""Centroid clustering of integer vectors by scalar lookup tables.

Components become integers floor(scale * x). Vectors are stored in blocks: of each dimension the integers that occur in the
block, and for each vector the place of its own among them. A round tabulates, for each dimension of a block, the squared
difference of every occurring integer to every centroid; distances are gathers from these tables, summed over
dimensions. A task adds up its clusters' components, Spark adds up tasks, and the driver holds no more than the centroids.

All of it is exact integer arithmetic, so results don't depend on the order or the dealing of rows.

Defined results: vectors of another length, null ones, and those with null or non-finite components take no part and have no
row. Integers beyond +-2 ** 27 count as that bound, so that a squared distance is a long; sums of distances beyond a long
count as its largest. Equal distances go to the smaller number. The first centroids are the vectors with the smallest
hashes of vec_id, then the smallest vec_id and components; rows without vec_id come last. With fewer vectors than
centroids there is a centroid for each. Repeated rows are vectors of their own; an empty centroid stays. An empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociflow.llm.common import stored

#: Vectors that share their tables.
BLOCK = 4096
#: Integers beyond this bound count as it.
BOUND = 1 << 27
_LONG = (1 << 63) - 1


def usable(vector: Column, dims: int) -> Column:
    """Whether a vector has `dims` components, none null or not finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) == dims) & ~odd


def _integers(values: np.ndarray, scale: int) -> np.ndarray:
    return np.clip(np.floor(values * scale), -BOUND, BOUND).astype(np.int64)


def _coded(dims: int, scale: int):
    """Blocks: vec_ids; occurring integers of each dimension; places among them, a dimension after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                n = part.num_rows
                values = _integers(part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, dims), scale)
                levels, places = zip(*(np.unique(values[:, d], return_inverse=True) for d in range(dims)), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), part.column(0)),
                        pa.array([[x.tolist() for x in levels]], pa.list_(pa.list_(pa.int64()))),
                        pa.array([np.concatenate(places).astype("<u2").tobytes()], pa.binary()),
                    ],
                    ["ids", "levels", "places"],
                )

    return run


def assign(levels: list[np.ndarray], places: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each vector of a block, the smaller number of equals, and the squared distance to it.

    levels: of each dimension the integers that occur; places[d, i]: which of them vector i has."""
    distance = np.zeros((places.shape[1], len(centroids)), np.int64)
    for d, occurring in enumerate(levels):
        table = (occurring[:, None] - centroids[None, :, d]) ** 2
        distance += table[places[d]]
    best = distance.argmin(1)
    return best, distance[np.arange(len(best)), best]


def _blocks(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[pa.Array, list[np.ndarray], np.ndarray]]:
    ids, levels, places = batch.columns
    for k in range(batch.num_rows):
        each = [np.array(x, np.int64) for x in levels[k].as_py()]
        yield ids[k].values, each, np.frombuffer(places[k].as_py(), "<u2").reshape(dims, -1)


def _sums(centroids: np.ndarray):
    """cluster, dim, total: a task's sums of components; at dim -1 its vectors, at -2 their distances."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [[0] * (dims + 2) for _ in range(k)]
        for batch in batches:
            for _, levels, places in _blocks(batch, dims):
                best, distance = assign(levels, places, centroids)
                for c in np.unique(best):
                    own = best == c
                    row = total[c]
                    for d, occurring in enumerate(levels):
                        row[d] += int((np.bincount(places[d][own], minlength=len(occurring)) * occurring).sum())
                    row[dims] += int(own.sum())
                    row[dims + 1] += sum(distance[own].tolist())
        names = [*range(dims), -1, -2]
        rows = [(c, d, str(v)) for c in range(k) if total[c][dims] for d, v in zip(names, total[c], strict=True)]
        if rows:
            types = (pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], ["cluster", "dim", "total"])

    return run


def _added(blocks: DataFrame, centroids: np.ndarray) -> dict[tuple[int, int], int]:
    """_sums of all tasks: a row for each centroid and dimension comes to the driver, whatever the table's size."""
    parts = blocks.mapInArrow(_sums(centroids), "cluster int, dim int, total string")
    rows = parts.groupBy("cluster", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    return {(r["cluster"], r["dim"]): int(r["total"]) for r in rows.collect()}


def _placed(centroids: np.ndarray, inertia: dict[int, int]):
    dims = centroids.shape[1]
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    whole = min(sum(inertia.values()), _LONG)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, levels, places in _blocks(batch, dims):
                best, distance = assign(levels, places, centroids)
                of = best.tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(best.astype(np.int32)),
                        pa.array(distance),
                        pa.array([min(inertia[c], _LONG) for c in of], pa.int64()),
                        pa.array(np.full(len(of), whole)),
                        pa.array([digests[c] for c in of]),
                    ],
                    ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
                )

    return run


def first_centroids(vectors: DataFrame, k: int, scale: int, seed: str = "1") -> np.ndarray:
    """The k vectors with the smallest sha256 of seed:vec_id, as integers, in that order. At most k rows come to the driver."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(digest.alias("digest"), "vec_id", "vector").orderBy(F.asc_nulls_last("digest"), "vec_id", "vector").limit(k)
    return np.array([_integers(np.array(r["vector"]), scale) for r in rows.select("vector").collect()], np.int64)


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, column: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every usable vector of `vectors`(vec_id, embedding)."""
    kind = dict(vectors.dtypes)["vec_id"]
    used = vectors.select("vec_id", F.col(column).cast("array<double>").alias("vector")).where(usable(F.col("vector"), dims))
    blocks = stored(used.mapInArrow(_coded(dims, scale), f"ids array<{kind}>, levels array<array<long>>, places binary"))
    centroids = first_centroids(used, k, scale)
    if not len(centroids):
        centroids = np.zeros((1, dims), np.int64)
    for _ in range(rounds):
        total = _added(blocks, centroids)
        for c in range(len(centroids)):
            if n := total.get((c, -1)):
                centroids[c] = [total[c, d] // n for d in range(dims)]
    inertia = {c: v for (c, d), v in _added(blocks, centroids).items() if d == -2}
    schema = f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    return blocks.mapInArrow(_placed(centroids, inertia), schema)
