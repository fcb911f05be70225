"""Chunked sequences, tags from alignments, the best of a key on a stream, nested subsamples."""

import hashlib
import random
from collections import Counter

import pytest

from lociflow.functions.statistics import poisson_tails
from lociflow.operators import density
from lociflow.sources import readers
from lociflow.streaming import incremental


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("block", [37, 200, 1 << 20])
def test_sequences_in_chunks(spark, tmp_path, block):
    r = random.Random(block)
    seqs = {f"s{k}": "".join(r.choice("ACGTN") for _ in range(n)) for k, n in enumerate([0, 1, 63, 64, 65, 500, 1003])}
    lines = []
    for name, seq in seqs.items():
        lines += [f">{name} some text", *(seq[i : i + 17] for i in range(0, len(seq), 17)), ""]
    (tmp_path / "a.fa").write_text("\n".join(lines))
    (tmp_path / "b.fa").write_text(">other\nACGT\nAC")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    try:
        chunks = readers.read_fasta_chunks(spark, [str(tmp_path / "a.fa"), str(tmp_path / "b.fa")], 64)
        got = {(x.name, x.chunk): x.seq for x in chunks.collect()}
        want = {(n, i // 64): s[i : i + 64] for n, s in (seqs | {"other": "ACGTAC"}).items() for i in range(0, len(s), 64)}
        assert got == want
        regions = [(k, n, a, a + d) for k, (n, a, d) in enumerate([("s6", 1, 0), ("s6", 60, 10), ("s6", 64, 0), ("s6", 65, 700), ("s6", 1000, 50), ("s5", 1, 499), ("s1", 5, 3), ("none", 1, 5), ("s6", 60, 10)])]
        found = {x.k: x.bases for x in readers.fetch_ranges(chunks, frame(spark, regions, "k long, name string, start long, end long"), 64).collect()}
        assert found == {k: seqs[n][a - 1 : b] for k, n, a, b in regions if n in seqs}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_tags_from_alignments(spark, tmp_path):
    (tmp_path / "x.sam").write_text("@HD\tVN:1.0\na\t0\tchr1\t100\t60\t4M1D2M\t*\t0\t0\tACGTAC\tIIIIII\nb\t16\tchr1\t200\t9\t2S4M\t*\t0\t0\tTTACGT\tIIIIII\nc\t4\t*\t0\t0\t*\t*\t0\t0\tAA\tII\nd\t1040\tchr2\t7\t1\t3M\t*\t0\t0\tAAA\tIII\n")
    got = {x.name: (x.chrom, x.pos, x.strand, x.length, x.quality) for x in readers.read_alignment_tags(spark, str(tmp_path / "x.sam")).collect()}
    assert got == {"a": ("chr1", 100, "+", 7, 60), "b": ("chr1", 203, "-", 4, 9), "d": ("chr2", 9, "-", 3, 1)}
    (tmp_path / "x.bed").write_text("#c\nchr1\t10\t46\tn\t0\t+\nchr1 50 80 n 1 -\nbad\tx\ty\n")
    got = sorted((x.chrom, x.pos, x.strand, x.length) for x in readers.read_meland(spark, str(tmp_path / "x.bed")).collect())
    assert got == [("chr1", 11, "+", 36), ("chr1", 80, "-", 30)]


PET = "pet_id long, tid long, pos long, endpos long, mtid long, mpos long, mendpos long, strand long, mstrand long, qual long, ts timestamp"


def test_best_of_a_key_on_a_stream(spark, tmp_path):
    """Late, better and equal tags, over several batches."""
    from pyspark.sql import functions as F

    place = lambda k: (0, 100 * k, 100 * k + 20, 0, 5000, 5020, 0, 0)
    batches = [
        [(1, *place(1), 10, 0), (2, *place(2), 30, 1), (3, *place(3), 200, 2)],
        [(4, *place(1), 40, 5), (5, *place(2), 30, 6), (6, *place(3), 150, 7), (9, 0, 5000, 5020, 0, 400, 420, 0, 0, 7, 8)],
        [(0, *place(1), 40, 9), (7, *place(2), 29, 9), (8, *place(9), 1, 30)],
        [(10, *place(1), 99, 31), (11, *place(9), 1, 200), (12, *place(1), 3, 1)],
        [(13, *place(8), 1, 400)],
    ]
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    source = tmp_path / "in"
    rows = lambda b: frame(spark, [(*x[:-1], x[-1]) for x in b], PET.replace("ts timestamp", "minute long")).withColumn("ts", F.timestamp_seconds((F.col("minute") + 1000) * 60)).drop("minute")
    for k, batch in enumerate(batches):
        rows(batch).coalesce(1).write.parquet(str(source / f"{k}"))
    stream = spark.readStream.schema(rows(batches[0]).schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(source))
    best = incremental.best_of_key(stream, late="1 minute", wait_ms=15 * 60_000)
    try:
        run = best.writeStream.format("memory").queryName("best").outputMode("append").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        assert run.awaitTermination(240)
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    got = sorted((x.pos, x.mpos, x.pet_id, x.qual, x.copies) for x in spark.table("best").collect())
    # Of equals the smaller number, quality at most 127; the swapped pair is canonical; what comes for a closed key opens it again.
    assert (100, 5000, 0, 40, 3) in got and (200, 5000, 2, 30, 3) in got and (300, 5000, 3, 200, 2) in got and (400, 5000, 9, 7, 1) in got
    assert (100, 5000, 10, 99, 1) in got and all(x[2] != 12 for x in got)


def test_nested_subsamples(spark):
    r = random.Random(7)
    rows = [(i, "c", r.choice([500, 1500, r.randrange(20_000)]) + r.randrange(300)) for i in range(4000)]
    others = [(i, "c", r.randrange(20_300)) for i in range(2000)]
    schema, shares = "id long, chrom string, pos long", (0.3, 0.6, 0.8, 1.0)
    t, control = (frame(spark, x, schema).repartition(3) for x in (rows, others))
    drawn = {i: int(hashlib.md5(f"1:{i}".encode()).hexdigest()[:12], 16) / 16**12 for i, _, _ in rows}
    levels = [Counter(p // 1000 for i, _, p in rows if drawn[i] < f) for f in shares]
    back = Counter(p // 1000 for _, _, p in others)
    got = {x.bin: (x.background, x.signal1, x.signal2, x.signal3, x.signal4) for x in density.nested_counts(t, control, shares).collect()}
    assert got == {b: (back[b], *(c[b] for c in levels)) for b in {*back, *levels[-1]}}
    totals = [sum(c.values()) for c in levels]
    found = []
    for c, n in zip(levels, totals, strict=True):
        mean = {b: (back[b] + 1) * n / 2000 for b in got}
        found.append({b: int(10 * c[b] / mean[b] // 1) for b in got if c[b] > mean[b] and poisson_tails([c[b]], [mean[b]])[0] <= 0.05})
    want = {}
    for k in range(1, 4):
        ok = [f for f in set(found[k].values()) if sum(b in found[k - 1] for b, v in found[k].items() if v >= f) >= 0.9 * sum(v >= f for v in found[k].values())]
        want[k] = (totals[k], min(ok) / 10 if ok else None)
    out = density.saturation(t, control, shares, p=0.05, accept=0.9)
    assert {x.depth: (x.tags, x.mser) for x in out.collect()} == want
    line = density.interpolated(frame(spark, [(1, 100, 4.0), (2, 400, 2.0)], "depth int, tags long, mser double"), 1600)
    assert abs(line - 1.0) < 1e-9
