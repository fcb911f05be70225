"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Rows are dealt to shards by hash; each shard builds its graph and stores it as flat neighbour arrays. Shards are as many
as the cluster has cores, and more where one would outgrow its bound in rows or bytes. Large blocks of queries
meet every shard's graph, which a task opens once a block, and shard results are merged by score. Rows with equal vectors are one node
that carries the smallest ids, as many as a result can show, so that copies neither tear the graph nor fill it. What a
search finds is scored anew in double precision on the original vectors.

Defined results: rows without id, and vectors that are null, zero, of another length than most, or hold null or non-finite
components take no part; of rows that repeat an id the smallest vector counts; equal scores go to the smaller id; fewer
candidates than k give fewer rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociflow.llm.common import stored

#: A shard's rows, at most and where there are fewer shards than cores; its vectors' bytes, at most.
SHARD_ROWS, SMALL_SHARD, SHARD_BYTES = 16_384, 4096, 32 << 20
#: Queries of a block, and those that search together.
BLOCK_QUERIES, TOGETHER = 16_384, 256
DEGREE = 16  # of upper levels; twice that at level 0
#: Nodes that a search keeps: in building, and in asking a small shard; larger ones take more in proportion.
BEAM_BUILD, BEAM_SEARCH = 64, 96


class Graph:
    """Unit vectors, and for each level an array of neighbours, -1 where there are none."""

    def __init__(self, vectors: np.ndarray, level: np.ndarray, seed: list[np.ndarray] | None = None):
        self.v = vectors
        self.level = level
        tops = int(level.max()) if len(level) else 0
        self.near = seed or [np.full((len(vectors), DEGREE * (2 if k == 0 else 1)), -1, np.int32) for k in range(tops + 1)]
        self.entry = int(level.argmax()) if len(level) else 0

    def beam(self, q: np.ndarray, start: np.ndarray, level: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The `width` best nodes found for each query, best first, and their similarities; -1 where fewer."""
        near, n = self.near[level], len(q)
        seen = np.zeros((n, len(self.v) + 1), bool)
        ids = np.full((n, width), -1, np.int32)
        sims = np.full((n, width), -np.inf, np.float32)
        ids[:, : start.shape[1]] = start
        s = np.einsum("qkd,qd->qk", self.v[start], q)
        sims[:, : start.shape[1]] = np.where(start >= 0, s, -np.inf)
        np.put_along_axis(seen, start, True, 1)
        done = np.zeros((n, width), bool)
        live = np.arange(n)
        while len(live):
            left = np.where(done[live], -np.inf, sims[live])
            best = left.argmax(1)
            some = np.isfinite(left[np.arange(len(live)), best])
            live, best = live[some], best[some]
            if not len(live):
                break
            done[live, best] = True
            near_ids = near[ids[live, best]]
            fresh = (near_ids >= 0) & ~np.take_along_axis(seen[live], near_ids, 1)
            seen[np.repeat(live, near_ids.shape[1]), np.where(fresh, near_ids, len(self.v)).ravel()] = True
            s = np.where(fresh, np.einsum("qkd,qd->qk", self.v[near_ids], q[live]), -np.inf).astype(np.float32)
            all_ids, all_sims = np.concatenate((ids[live], near_ids), 1), np.concatenate((sims[live], s), 1)
            all_done = np.concatenate((done[live], np.zeros_like(fresh)), 1)
            order = np.argsort(-all_sims, 1, kind="stable")[:, :width]
            ids[live], sims[live], done[live] = (np.take_along_axis(x, order, 1) for x in (all_ids, all_sims, all_done))
        ids[~np.isfinite(sims)] = -1
        return ids, sims

    def descend(self, q: np.ndarray, to: int) -> np.ndarray:
        """Each query's way from the entry down to above level `to`."""
        at = np.full((len(q), 1), self.entry, np.int32)
        for level in range(len(self.near) - 1, to, -1):
            at = self.beam(q, at, level, 8)[0][:, :1]
        return at

    def choose(self, base: np.ndarray, ids: np.ndarray, degree: int) -> np.ndarray:
        """Of candidates (a row each, -1 for none) those nearer to the base than to any chosen before; then the next best."""
        sims = np.where(ids >= 0, np.einsum("qkd,qd->qk", self.v[ids], base), -np.inf)
        order = np.argsort(-sims, 1, kind="stable")
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        between = self.v[ids] @ self.v[ids].transpose(0, 2, 1)
        again = np.zeros(ids.shape, bool)
        again[:, 1:] = (ids[:, :, None] == ids[:, None, :])[:, 1:, :].argmax(2) < np.arange(1, ids.shape[1])[None, :]
        valid = (ids >= 0) & ~again
        picked = np.zeros(ids.shape, bool)
        for k in range(ids.shape[1]):
            nearest = np.where(picked, between[:, k, :], -np.inf).max(1)
            picked[:, k] = valid[:, k] & (nearest < sims[:, k]) & (picked.sum(1) < degree)
        rank = np.where(picked, 0, np.where(valid, 1, 2)) * ids.shape[1] + np.arange(ids.shape[1])
        order = np.argsort(rank, 1)[:, :degree]
        out = np.where(np.take_along_axis(valid, order, 1), np.take_along_axis(ids, order, 1), -1)
        return np.pad(out, ((0, 0), (0, degree - out.shape[1])), constant_values=-1)

    def insert(self, nodes: np.ndarray) -> None:
        """Nodes of a batch are looked up in the graph so far, and among each other."""
        q = self.v[nodes]
        at = np.full((len(nodes), 1), self.entry, np.int32)
        for level in range(len(self.near) - 1, -1, -1):
            own = np.flatnonzero(self.level[nodes] >= level)
            if len(own):
                ids, _ = self.beam(q[own], at[own], level, BEAM_BUILD)
                mates = nodes[own]
                if len(own) > 1:
                    s = q[own] @ q[own].T
                    np.fill_diagonal(s, -np.inf)
                    k = min(DEGREE, len(own) - 1)
                    ids = np.concatenate((ids, mates[np.argpartition(-s, k - 1, 1)[:, :k]].astype(np.int32)), 1)
                ids = np.where(ids == mates[:, None], -1, ids)
                degree = self.near[level].shape[1]
                chosen = self.choose(q[own], ids, degree // 2 if level == 0 else degree)
                self.near[level][mates, : chosen.shape[1]] = chosen
                self._back(level, np.repeat(mates, chosen.shape[1]), chosen.ravel())
            if level:
                at = self.beam(q, at, level, 8)[0][:, :1]

    def _back(self, level: int, source: np.ndarray, target: np.ndarray) -> None:
        use = target >= 0
        source, target = source[use], target[use]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        hit, first, count = np.unique(target, return_index=True, return_counts=True)
        more = np.full((len(hit), int(count.max()) if len(hit) else 0), -1, np.int32)
        more[np.repeat(np.arange(len(hit)), count), np.arange(len(target)) - np.repeat(first, count)] = source
        for i in range(0, len(hit), 256):
            part = slice(i, i + 256)
            both = np.concatenate((self.near[level][hit[part]], more[part]), 1)
            self.near[level][hit[part]] = self.choose(self.v[hit[part]], both, self.near[level].shape[1])

    def search(self, q: np.ndarray, width: int) -> np.ndarray:
        return self.beam(q, self.descend(q, 0), 0, width)[0]


#: Tasks of a search at most: more pairs of a shard and a block share one.
MOST_TASKS = 50_000


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = _scaled(x)
    return (x / np.sqrt((x * x).sum(1, keepdims=True))).astype(np.float32)


def build(vectors: np.ndarray) -> Graph:
    n = len(vectors)
    r = np.random.default_rng(n)
    level = np.minimum((-np.log(1 - r.random(n)) / np.log(DEGREE)).astype(np.int64), 6)
    order = np.argsort(-level, kind="stable")  # upper levels first: every later search starts from all of them
    g = Graph(unit(vectors), level)
    g.entry = int(order[0])
    at = 1
    while at < n:
        size = min(512, max(8, at // 2), n - at)
        g.insert(order[at : at + size])
        at += size
    return g


def _scaled(x: np.ndarray) -> np.ndarray:
    """Vectors times the power of two that brings their largest component near one: exact, and squares stay finite and above zero."""
    x = x.astype(np.float64)
    return np.ldexp(x, -np.frexp(np.abs(x).max(-1, keepdims=True))[1]) if x.size else x


def cosines(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    q, v = _scaled(q), _scaled(v)
    return (v * q).sum(-1) / (np.sqrt((q * q).sum(-1)) * np.sqrt((v * v).sum(-1)))


def _flat(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _graphs(dim: int):
    def run(table: pa.Table) -> pa.Table:
        vectors = _flat(table["vector"], dim)
        ids = table["ids"].combine_chunks()
        g = build(vectors)
        blob = pickle.dumps({"vectors": vectors, "ids": ids.flatten().to_numpy(), "first": ids.offsets.to_numpy(), "level": g.level, "near": g.near, "entry": g.entry})
        return pa.table({"shard": table["shard"][:1], "graph": pa.array([blob], pa.large_binary()).cast(pa.binary())})

    return run


def _block(dim: int):
    def run(table: pa.Table) -> pa.Table:
        blob = pickle.dumps({"ids": table["vec_id"].to_numpy(), "vectors": _flat(table["vector"], dim)})
        return pa.table({"block": table["block"][:1], "queries": pa.array([blob], pa.binary())})

    return run


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for graph, queries in zip(batch.column(0), batch.column(1), strict=True):
                s, q = pickle.loads(graph.as_py()), pickle.loads(queries.as_py())
                g = Graph(unit(s["vectors"]), s["level"], s["near"])
                g.entry = s["entry"]
                asked, width = unit(q["vectors"]), min(BEAM_SEARCH * max(1.0, len(g.v) / SMALL_SHARD), max(len(g.v), 1))
                found = np.concatenate([g.search(asked[i : i + TOGETHER], int(width)) for i in range(0, len(asked), TOGETHER)])
                out: tuple[list, list, list] = ([], [], [])
                for i, own in enumerate(q["ids"].tolist()):
                    nodes = found[i][found[i] >= 0]
                    score = cosines(q["vectors"][i], s["vectors"][nodes])
                    best = sorted((-float(c), int(x)) for n, c in zip(nodes, score, strict=True) for x in s["ids"][s["first"][n] : s["first"][n + 1]] if x != own)[:k]
                    out[0].extend([own] * len(best))
                    out[1].extend(x for _, x in best)
                    out[2].extend(-c for c, _ in best)
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], ["query_id", "vec_id", "score"])

    return run


def nearest(rows: DataFrame, k: int = 5, every: int = 50, vector: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: of every row whose vec_id is divisible by `every` its k nearest other rows."""
    spark = rows.sparkSession
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)
    valid = rows.where(F.col("vec_id").isNotNull() & F.col(vector).isNotNull()).where(sound).select("vec_id", F.col(vector).alias("vector"))
    lengths = valid.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = lengths["dim"]
    valid = valid.where(F.size("vector") == dim).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    valid = stored(valid)
    by_vector = Window.partitionBy("vector").orderBy("vec_id")
    nodes = valid.withColumn("nth", F.row_number().over(by_vector)).where(F.col("nth") <= k + 1)
    nodes = nodes.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    nodes = stored(nodes)
    n = nodes.count()
    most = max(1, min(shard_rows, SHARD_BYTES // (4 * dim)))
    shards = max(1, -(-n // most), min(spark.sparkContext.defaultParallelism, -(-n // SMALL_SHARD)))
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int"))
    graphs = stored(dealt.groupBy("shard").applyInArrow(_graphs(dim), "shard int, graph binary"))
    asked = valid.where(F.col("vec_id") % every == 0)
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).groupBy("block").applyInArrow(_block(dim), "block int, queries binary")
    met = asked.select("queries", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")).join(graphs, "shard")
    met = met.repartition(min(shards * blocks, MOST_TASKS)) if shards * blocks > 1 else met
    found = met.select("graph", "queries").mapInArrow(_search(k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
