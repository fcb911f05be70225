"""Exact dedup by composable polynomial fingerprints.

A text, its white space runs replaced by one space each, is cut into chunks. Each chunk has a polynomial hash under two
moduli; chunk hashes combine by shifting the left one by the length of the right one, so the chunks of a huge document
can be hashed apart and in any grouping. Rows with equal fingerprints meet in one aggregation whose key also holds the
chunks: Spark compares them chunk by chunk, spills them if it must, and adds copies up before the shuffle.

Defined results: null counts as empty; empty texts are equal to each other; a row without doc_id comes after all others;
of rows that repeat both doc_id and text one stays; an empty table gives an empty result; other columns are kept by
`dedup` and not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociflow.llm.common import SPACE_CLASS, counted, flat, in_small_batches, stored, utf8, whole

CHUNK = 1 << 16
#: Bytes hashed together.
BLOCK = 1 << 18
# Two primes under 2 ** 31 and a base for each.
PRIMES = (2147483629, 2147483587)
BASES = (911382323, 972663749)
_tables: list[np.ndarray] = []


def _table(k: int) -> np.ndarray:
    """base ** 0 .. base ** (CHUNK - 1) modulo the prime."""
    if not _tables:
        for prime, base in zip(PRIMES, BASES, strict=True):
            t = np.ones(CHUNK, np.uint64)
            n = 1
            while n < CHUNK:
                t[n : 2 * n] = t[:n] * np.uint64(pow(base, n, prime)) % np.uint64(prime)
                n *= 2
            _tables.append(t)
    return _tables[k]


def combine(left: tuple[int, int], right: tuple[int, int], right_bytes: int) -> tuple[int, int]:
    """The fingerprint of two neighbouring pieces from theirs."""
    return tuple((a * pow(base, right_bytes, prime) + b) % prime for a, b, prime, base in zip(left, right, PRIMES, BASES, strict=True))  # type: ignore[return-value]


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each text data[offsets[i]:offsets[i + 1]]: two hashes; then where chunks begin, with the end, and each text's first chunk."""
    sizes = np.diff(offsets)
    chunks = np.maximum((sizes + CHUNK - 1) // CHUNK, 1)
    first = np.concatenate(([0], np.cumsum(chunks)))
    text = np.repeat(np.arange(len(sizes)), chunks)
    begin = offsets[:-1][text] + (np.arange(first[-1]) - first[:-1][text]) * CHUNK
    end = np.minimum(begin + CHUNK, offsets[1:][text])
    out = [np.zeros(first[-1], np.uint64) for _ in PRIMES]
    i = 0
    while i < first[-1]:  # a few chunks at a time: eight bytes a byte are needed
        j = max(i + 1, int(np.searchsorted(end, begin[i] + BLOCK, "right")))
        some = np.flatnonzero(end[i:j] > begin[i:j]) + i
        if len(some):
            lo, hi = begin[i], end[j - 1]
            place = np.repeat(end[i:j], end[i:j] - begin[i:j]) - 1 - np.arange(lo, hi)
            values = data[lo:hi].astype(np.uint64) + np.uint64(1)
            for k, prime in enumerate(PRIMES):
                out[k][some] = np.add.reduceat(values * _table(k)[place], begin[some] - lo) % np.uint64(prime)
        i = j
    whole_text = [h[first[:-1]].copy() for h in out]
    for i in np.flatnonzero(chunks > 1):
        value = (int(out[0][first[i]]), int(out[1][first[i]]))
        for j in range(first[i] + 1, first[i + 1]):
            value = combine(value, (int(out[0][j]), int(out[1][j])), int(end[j] - begin[j]))
        whole_text[0][i], whole_text[1][i] = value
    return whole_text[0], whole_text[1], np.append(begin, offsets[-1]), first


def _fingerprint(with_chunks: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            data, offsets = flat(text)
            a, b, begin, first = fingerprints(data, offsets)
            columns = [*batch.columns[:-1], pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64)), pa.array(np.diff(offsets))]
            names = [*batch.schema.names[:-1], "fp_a", "fp_b", "n_bytes"]
            if with_chunks:
                values = pa.Array.from_buffers(pa.binary(), len(begin) - 1, [None, pa.py_buffer(begin.astype(np.int32)), pa.py_buffer(data)])
                columns.append(pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), values))
                names.append("chunks")
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def normalised(docs: DataFrame) -> Column:
    return F.regexp_replace(whole("text"), f"[{SPACE_CLASS}]+", " ")


FP = ["fp_a", "fp_b", "n_bytes", "text_sha256"]


def classes(docs: DataFrame) -> DataFrame:
    """Of each class of equal texts: fp_a, fp_b, n_bytes, text_sha256, keep_id, group_size."""
    norm = normalised(docs)
    rows = in_small_batches(docs).select("doc_id", F.sha2(utf8(norm), 256).alias("text_sha256"), utf8(norm).alias("_text"))
    kind = dict(docs.dtypes)["doc_id"]
    rows = rows.mapInArrow(_fingerprint(True), f"doc_id {kind}, text_sha256 string, fp_a long, fp_b long, n_bytes long, chunks array<binary>")
    return rows.groupBy(*FP, "chunks").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).drop("chunks")


def _judged(docs: DataFrame) -> DataFrame:
    """doc_id, text_sha256, keep_id, group_size, kept of every row. Rows have numbers, so that of repeated ones one is kept."""
    norm = normalised(docs)
    kind = dict(docs.dtypes)["doc_id"]
    rows = in_small_batches(docs).select("doc_id", F.sha2(utf8(norm), 256).alias("text_sha256"), utf8(norm).alias("_text"))
    rows = rows.mapInArrow(_fingerprint(False), f"doc_id {kind}, text_sha256 string, fp_a long, fp_b long, n_bytes long")
    rows = stored(rows.withColumn("number", F.monotonically_increasing_id()))
    first = rows.groupBy(*FP).agg(F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "number")).alias("first"))
    found = classes(docs).join(first.select(*FP, F.col("first.number").alias("first")), FP)
    # On keys that found isn't dealt out by yet, so that the join may split a large class.
    found = found.withColumn("_fp_a", F.col("fp_a").bitwiseXOR(F.lit(1))).drop("fp_a")
    return rows.withColumn("_fp_a", F.col("fp_a").bitwiseXOR(F.lit(1))).join(found, ["_fp_a", *FP[1:]]).select("doc_id", "text_sha256", "keep_id", "group_size", (F.col("number") == F.col("first")).alias("kept"))


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    return _judged(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def dedup(docs: DataFrame) -> DataFrame:
    """The rows that stay, with their own columns; of rows that repeat doc_id and text, one."""
    copies = _judged(docs).groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("stays"), F.count(F.lit(1)).alias("copies"))
    odd, seen = counted(copies.where("NOT stays OR copies > 1"), again=F.col("stays").cast("int"))
    rows = docs.select(F.struct("*").alias("row"), F.sha2(utf8(normalised(docs)), 256).alias("sha"))
    on = (F.col("sha") == F.col("odd_sha")) & F.col("row.doc_id").eqNullSafe(F.col("odd_id"))
    names = [F.col("text_sha256").alias("odd_sha"), F.col("doc_id").alias("odd_id")]
    out = rows.join(odd.select(*names), on, "left_anti")
    if seen["again"]:
        repeated = rows.join(odd.where("stays").select(*names), on, "left_semi").withColumn("id", F.col("row.doc_id"))
        out = out.unionByName(repeated.dropDuplicates(["id", "sha"]).drop("id"))
    return out.select("row.*")
