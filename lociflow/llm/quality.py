"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages (its bytes in blocks of PASSAGE). Every passage is encoded; gated attention weights,
learnt from the documents' labels alone, say how much each passage counts; the weighted mean of the encodings gives the
document's score. Whole texts are read, in training too. Texts are the only input of a score.

Training takes a bounded sample: of the labelled rows that aren't held out, those whose hashed doc_id is among the
SAMPLE smallest, in that order as long as their passages add up to SAMPLE_PASSAGES at most. Scoring is one pass without a shuffle.

Defined results: null counts as empty, and an empty text is one passage of zeros, which gets a score too; null or
repeated doc_ids keep a row each; rows without a label, or whose doc_id has labels that differ, teach nothing; without
labels of both kinds every score is the share of label 1 (1 if there is none); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociflow.llm.common import blocks, cut, flat, in_small_batches, mix, whole, words

PASSAGE = 512
SAMPLE, SAMPLE_PASSAGES = 6000, 200_000
THRESHOLD = 0.3
PAIRS = 64

_CLASS = np.full(256, 11, np.uint8)
for _k, _bytes in enumerate(
    [range(97, 123), range(65, 91), range(48, 58), b" ", b"\n\r", b".,;:", b"!?", b"|", b"#$%&*@^~+=<>", b"'\"()-", range(128, 256)]
):
    _CLASS[list(_bytes)] = _k
CLASSES = 12
_PAIR = (mix(np.arange(65536, dtype=np.uint64)) % np.uint64(PAIRS)).astype(np.uint8)
FEATURES = CLASSES + PAIRS + 6


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A row of features for each passage, and len + 1 offsets of each text's passages."""
    sizes = np.diff(offsets)
    count = np.maximum(-(-sizes // PASSAGE), 1)
    first = np.concatenate(([0], np.cumsum(count)))
    n = int(first[-1])
    x = np.zeros((n, FEATURES), np.float32)
    if len(data):
        text = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
        of = first[:-1][text] + (np.arange(len(data)) - offsets[:-1][text]) // PASSAGE
        length = np.bincount(of, minlength=n).astype(np.float32)
        share = np.maximum(length, 1)[:, None]
        x[:, :CLASSES] = np.bincount(of * CLASSES + _CLASS[data], minlength=n * CLASSES).reshape(n, CLASSES) / share
        pair = _PAIR[data[:-1].astype(np.uint16) * np.uint16(256) + data[1:]]
        within = text[1:] == text[:-1]
        x[:, CLASSES : CLASSES + PAIRS] = np.bincount((of[:-1] * PAIRS + pair)[within], minlength=n * PAIRS).reshape(n, PAIRS) / share
        starts, ends, hashes, at = words(data, offsets)
        if len(starts):
            own, doc = of[starts], text[starts]
            number = np.bincount(own, minlength=n).astype(np.float32)
            some = np.maximum(number, 1)
            k = CLASSES + PAIRS
            x[:, k] = number / share[:, 0]
            x[:, k + 1] = np.bincount(own, ends - starts, minlength=n) / some / 20
            # Of the words, those whose pair with the next one has come before in the text.
            following = np.where(np.roll(doc, -1) == doc, np.roll(hashes, -1), np.uint64(0))
            following[-1] = 0
            two = mix(hashes + following * np.uint64(3) + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            fresh = np.zeros(len(two), bool)
            fresh[np.unique(two, return_index=True)[1]] = True
            x[:, k + 2] = np.bincount(own, ~fresh, minlength=n) / some
            last = data[ends - 1]
            x[:, k + 3] = np.bincount(own, _CLASS[last] >= 5, minlength=n) / some
            x[:, k + 4] = np.bincount(own, (ends - starts) == 1, minlength=n) / some
        x[:, -1] = np.log1p(sizes[np.repeat(np.arange(len(sizes)), count)]) / 10
    return x, first


@dataclass
class Attention:
    """h = tanh(x U + u); weight ~ exp(w . (tanh(h V) * sigmoid(h G))); score = sigmoid(c . sum(weight h) + b)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    prior: float = 1.0

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        p, at, bags = self.weights, first[:-1], np.repeat(np.arange(len(first) - 1), np.diff(first))
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        h = np.tanh(x @ p["U"] + p["u"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["G"])))
        e = (t * g) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, at)[bags])
        a = e / np.add.reduceat(e, at)[bags]
        z = np.add.reduceat(a[:, None] * h, at)
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "y": 1 / (1 + np.exp(-(z @ p["c"] + p["b"]))), "bags": bags}

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(first) - 1, self.prior)
        return self.forward(x, first)["y"].astype(np.float64)


def gradient(model: Attention, x: np.ndarray, first: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean log loss of bags, by each weight."""
    f, p = model.forward(x, first), model.weights
    dy = (f["y"] - label) / len(label)
    dz = dy[:, None] * p["c"]
    da = np.einsum("ij,ij->i", dz[f["bags"]], f["h"])
    de = f["a"] * (da - np.add.reduceat(f["a"] * da, first[:-1])[f["bags"]])
    dt, dg = de[:, None] * p["w"] * f["g"] * (1 - f["t"] ** 2), de[:, None] * p["w"] * f["t"] * f["g"] * (1 - f["g"])
    dh = (f["a"][:, None] * dz[f["bags"]] + dt @ p["V"].T + dg @ p["G"].T) * (1 - f["h"] ** 2)
    return {"U": f["x"].T @ dh, "u": dh.sum(0), "V": f["h"].T @ dt, "G": f["h"].T @ dg, "w": (f["t"] * f["g"]).T @ de, "c": f["z"].T @ dy, "b": dy.sum()}


def fit(x: np.ndarray, first: np.ndarray, label: np.ndarray, hidden: int = 24, gate: int = 12, epochs: int = 40, rate: float = 0.01, batch: int = 256) -> Attention:
    """Adam on the log loss of the documents' labels."""
    if len(set(label.tolist())) < 2:
        return Attention(np.zeros(FEATURES), np.ones(FEATURES), {}, float(label.mean()) if len(label) else 1.0)
    mean, scale = x.mean(0), x.std(0) + 0.01
    r = np.random.default_rng(5)
    p = {
        "U": r.normal(0, 0.2, (x.shape[1], hidden)), "u": np.zeros(hidden), "V": r.normal(0, 0.3, (hidden, gate)), "G": r.normal(0, 0.3, (hidden, gate)),
        "w": r.normal(0, 0.3, gate), "c": r.normal(0, 0.3, hidden), "b": np.array(np.log(label.mean() / (1 - label.mean()))),
    }
    model, m, v, step = Attention(mean, scale, p), {k: 0.0 for k in p}, {k: 0.0 for k in p}, 0
    for epoch in range(epochs):
        order = r.permutation(len(label))
        for i in range(0, len(order), batch):
            docs = order[i : i + batch]
            rows = np.concatenate([np.arange(first[d], first[d + 1]) for d in docs])
            edges = np.concatenate(([0], np.cumsum(first[docs + 1] - first[docs])))
            grad = gradient(model, x[rows], edges, label[docs])
            step += 1
            for k in p:
                g = grad[k] + 1e-5 * p[k]
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g**2
                p[k] = p[k] - rate * (0.1 if epoch > 0.7 * epochs else 1) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, sample_passages: int = SAMPLE_PASSAGES) -> Attention:
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min(label).alias("_label"), F.max(label).alias("_other")).where("_label = _other").drop("_other")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # at most `sample` rows of two numbers
    # Their texts' passages, added up in the same order.
    size = F.greatest(F.ceil(F.octet_length(whole("text")) / PASSAGE), F.lit(1))
    sizes = docs.select("doc_id", size.alias("_size")).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "_label").agg(F.max("_size").alias("_size"))
    upto = F.sum("_size").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))
    # A text that alone has more passages than the sample may hold isn't one of it.
    chosen = cut(sizes.where(F.col("_size") <= sample_passages).withColumn("_upto", upto).where(F.col("_upto") <= sample_passages).select("doc_id", "_label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column("text"))
            for i, j in blocks(offsets):
                part = batch.slice(i, j - i)
                x, first = passages(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                lists = pa.ListArray.from_arrays(pa.array((first * FEATURES).astype(np.int32)), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("_label").cast(pa.float64()), lists], ["doc_id", "label", "x"])

    rows = docs.select("doc_id", whole("text").alias("text")).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "_label").agg(F.max("text").alias("text"))
    table = rows.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, label double, x array<float>").toArrow().sort_by("doc_id")
    x = table["x"].combine_chunks()
    x = x if isinstance(x, pa.Array) else x.chunk(0)
    sizes = np.diff(x.offsets.to_numpy()) // FEATURES
    return fit(x.flatten().to_numpy().reshape(-1, FEATURES).astype(np.float64), np.concatenate(([0], np.cumsum(sizes))), table["label"].to_numpy())


def _scored(docs: DataFrame, model: Attention, columns: list[str], text: str = "text") -> DataFrame:
    """The given columns as _k0, _k1, ... and _score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column("_text"))
            for i, j in blocks(offsets):
                part = batch.slice(i, j - i)
                x, first = passages(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(model.score(x, first))], [*part.schema.names[1:], "_score"])

    inner = in_small_batches(docs).select(whole(text).alias("_text"), *(F.col(k).alias(f"_k{i}") for i, k in enumerate(columns)))
    kinds = dict(inner.dtypes)
    return inner.mapInArrow(run, ", ".join(f"{k} {kinds[k]}" for k in inner.columns[1:]) + ", _score double")


def score(docs: DataFrame, model: Attention, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted, for every row."""
    out = _scored(docs, model, ["doc_id"])
    return out.select(F.col("_k0").alias("doc_id"), held_out(F.col("_k0")).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Attention, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score reaches the threshold, with their own columns."""
    return _scored(docs, model, docs.columns).where(F.col("_score") >= threshold).select(*(F.col(f"_k{i}").alias(k) for i, k in enumerate(docs.columns)))
