"""Operators on small hand-made inputs and edge cases."""

import itertools
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociflow.functions import sequence, statistics
from lociflow.functions.overlap import Overlap
from lociflow.operators import alignments, density, intervals, linker, loops, pairs, pets, phasing, qc, reproducibility, significance, tagging
from lociflow.plans.catalogue import ORACLES, QUERIES
from lociflow.sources import config, readers, writers
from lociflow.streaming import incremental

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    import duckdb

    db = duckdb.connect()
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*' if os.path.isdir(path) else path}')")
    want = db.sql(ORACLES[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    order = sorted(got.columns)

    def plain(rows, columns):
        at = [list(columns).index(c) for c in order]
        return sorted(repr([round(float(r[i]), 6) + 0.0 if isinstance(r[i], (int, float)) and not isinstance(r[i], bool) or "Decimal" in type(r[i]).__name__ else r[i] for i in at]) for r in rows)

    assert plain(got.collect(), got.columns) == plain(want.fetchall(), want.columns)


def test_touching_intervals(spark):
    a = frame(spark, [(1, "c", 0, 10), (2, "c", 10, 20), (3, "d", 0, 10), (4, "c", 30, 30)], "id long, chrom string, start long, end long")
    b = frame(spark, [(9, "c", 10, 12), (8, "c", 20, 31)], "id long, chrom string, start long, end long")
    join = lambda how, width: {(r.l_id, r.r_id) for r in intervals.inner_join(a, b, ["chrom"], how, width).collect()}
    for width in (1, 3, 4096):
        assert join(Overlap.HALF_OPEN, width) == {(2, 9), (4, 8)}
        assert join(Overlap.CLOSED, width) == {(1, 9), (2, 9), (2, 8), (4, 8)}
    assert {r.id for r in intervals.anti_join(a, b, ["chrom"], "id").collect()} == {1, 3}
    merged = lambda touching, tile: sorted((r.chrom, r.start, r.end, r.n) for r in intervals.merge(a, ["chrom"], touching, tile).collect())
    for tile in (4, 1 << 22):
        assert merged(True, tile) == [("c", 0, 20, 2), ("c", 30, 30, 1), ("d", 0, 10, 1)]
        assert merged(False, tile) == [("c", 0, 10, 1), ("c", 10, 20, 1), ("c", 30, 30, 1), ("d", 0, 10, 1)]


def test_random_intervals(spark):
    r = random.Random(5)
    rows = [(k, r.choice("ab"), s := r.randrange(300), s + r.randrange(1, 40)) for k in range(200)]
    t = frame(spark, rows, "id long, chrom string, start long, end long")
    depth = {}
    for _, c, s, e in rows:
        for x in range(s, e):
            depth[c, x] = depth.get((c, x), 0) + 1
    for tile in (16, 1 << 22):
        cov = intervals.coverage(t, ["chrom"], tile).collect()
        assert {(x.chrom, p): x.depth for x in cov for p in range(x.start, x.end)} == depth
    pairs_ = {(a[0], b[0]) for a in rows for b in rows if a[1] == b[1] and a[2] < b[3] and b[2] < a[3]}
    assert {(x.l_id, x.r_id) for x in intervals.inner_join(t, t, ["chrom"], bin_width=8).collect()} == pairs_


def pet(k, pos, mpos, tid=0, mtid=0, strand=0, mstrand=1, qual=30):
    return (k, tid, pos, pos + 20, mtid, mpos, mpos + 20, strand, mstrand, qual)


PET = "pet_id long, tid long, pos long, endpos long, mtid long, mpos long, mendpos long, strand long, mstrand long, qual long"


def test_tags(spark):
    t = frame(spark, [pet(1, 100, 9000), pet(2, 9000, 100, strand=1, mstrand=0), pet(3, 100, 9000, qual=300), pet(4, 100, 9000, qual=127), pet(5, 5, 5), pet(6, 7, 9, 1, 0)], PET)
    left = {r.pet_id: r.copies for r in pets.drop_duplicates(t).collect()}
    assert left == {3: 4, 5: 1, 6: 1}  # quality saturates at 127, so the first of equals stays
    edge = frame(spark, [pet(1, 0, 7979), pet(2, 0, 7978), pet(3, 0, 8000), pet(4, 0, 7999)], PET)
    assert [r.c for r in edge.orderBy("pet_id").select(pets.ligation_class().alias("c")).collect()] == ["intra", "self", "intra", "intra"]
    assert [r.u for r in edge.orderBy("pet_id").select(pets.usable().alias("u")).collect()] == [False, False, True, False]
    assert pets.extend(t).where("tid = mtid AND (s2 < s1 OR e1 > e2)").count() == 0
    lengths = frame(spark, [(0, 9100), (1, 10)], "tid long, length long")
    assert pets.extend(t, lengths=lengths).agg(F.max("e2")).first()[0] <= 9100


def test_trans_tags_dont_bridge_islands(spark):
    t = frame(spark, [pet(1, 1000, 50_000), pet(2, 1400, 50_400, 0, 1), pet(3, 1800, 50_000)], PET)
    got = pets.first_pass_clusters(pets.extend(t)).collect()
    assert sorted((r.mtid, r.s1, r.n) for r in got) == [(0, 750, 1), (0, 1550, 1), (1, 1150, 1)]


def test_refined_clusters(spark):
    r = random.Random(2)
    rows = [pet(k, r.randrange(0, 6000), 60_000 + r.randrange(0, 6000), 0, r.choice([0, 0, 1])) for k in range(150)]
    ext = pets.extend(frame(spark, rows, PET), 200, 200)
    boxes = [[x.mtid, x.s1, x.e1, x.s2, x.e2, 1] for x in ext.collect()]
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(boxes, 2):
            if a[0] == b[0] and a[1] <= b[2] and b[1] <= a[2] and a[3] <= b[4] and b[3] <= a[4]:
                boxes = [x for x in boxes if x is not a and x is not b] + [[a[0], min(a[1], b[1]), max(a[2], b[2]), min(a[3], b[3]), max(a[4], b[4]), a[5] + b[5]]]
                changed = True
                break
    got = pets.refined_clusters(ext).collect()
    assert sorted([x.mtid, x.s1, x.e1, x.s2, x.e2, x.n] for x in got) == sorted(boxes)


def test_loops_of_many_contigs(spark):
    one = lambda k: F.lit(k).cast("long")
    t = spark.range(100_050).select(F.col("id").alias("tid"), F.col("id").alias("mtid"), *(one(0).alias(c) for c in ("island1", "island2")), *(one(k).alias(c) for k, c in enumerate(("s1", "e1", "s2", "e2", "n"), 1)))
    got = loops.loops_of(t).agg(F.count(F.lit(1)), F.countDistinct("chrom"), F.min("loop_id"), F.max("loop_id"), F.countDistinct("loop_id")).first()
    assert tuple(got) == (100_050, 100_050, 1, 100_050, 100_050)


def test_rank_cutoff(spark):
    values = lambda xs: frame(spark, [(x,) for x in xs], "n long")
    for xs in ([5], [], [3, 3, 3], [1, 2, 3, 4], list(range(100))):
        k = int(len(xs) * 0.67)
        assert loops.rank_cutoff(values(xs)).first()[0] == (sorted(xs)[k - 1] if k else 0)


def test_regions(spark):
    assert pairs.parse_region("chr1:1,000-2000") == pairs.Region("chr1", 999, 2000)
    assert pairs.parse_query("*|chr2:5")[0].chrom is None
    for bad in ("chr1:20-10", "chr1:x-y"):
        with pytest.raises(ValueError, match="region"):
            pairs.parse_region(bad)
    rows = [("r", "b", 10, "a", 20), ("s", "a", 5, "a", 9), ("t", "a", 1 << 30, "c", 1)]
    t = frame(spark, rows, "read_id string, chr1 string, pos1 long, chr2 string, pos2 long")
    ids = lambda q, **k: {r.read_id for r in pairs.query(t, q, **k).collect()}
    assert ids("b:10-10|a:20-20") == {"r"} and ids("b:11-12|a") == set() and ids("a|b") == set() and ids("a|b", flip=True) == {"r"}
    assert ids("a") == {"s"} and ids("a|*") == {"s", "t"} and ids(".") == {"r", "s", "t"} and ids("a:1-2^a:1", separator="^") == set()
    assert sorted(r["query"] for r in pairs.query_list(t, ["a", "a|*", "a:5-5|a"]).where("read_id = 's'").collect()) == [0, 1, 2]
    assert pairs.is_triangle(t).first()[0] and pairs.upper_triangle(t, ["a", "b"]).where("chr1 = 'a' AND chr2 = 'b'").count() == 1
    assert pairs.upper_triangle(t, ["a", "b", "c"], strict=True).count() == 2


def test_fragments_within_tiles(spark):
    t = frame(spark, [(k, p) for k, p in enumerate([0, 9, 10, 11, 25, 400, 1000])], "id long, pos1 long")
    sites = frame(spark, [(10,), (10,), (25,), (399,), (900,)], "site long")
    for tile in (8, 100, 1 << 20):
        assert [r.fragment for r in pairs.fragments(t, sites, tile=tile).orderBy("id").collect()] == [0, 0, 2, 2, 3, 4, 5]


def test_linkers(spark):
    t = frame(spark, [(1, "ACGTGATCGTTT"), (2, "GATCG"), (3, "ACGGATAGCC"), (4, ""), (5, None)], "id long, seq string")
    at = lambda m: [r[0] for r in t.orderBy("id").select(sequence.first_match(F.col("seq"), "GATCG", m)).collect()]
    assert at(0) == [4, 0, None, None, None] and at(1) == [4, 0, 3, None, None]
    assert [r[0] for r in t.where("id < 5").orderBy("id").select(linker.tag_before(F.col("seq"), "GATCG", 0)).collect()] == ["ACGT", "A", "ACGGATAGCC", ""]
    score, begin, end, first, last = linker.local_alignment(["TTTACGTACGTTT", "ACGT", "TTTT", ""], "ACGTACG")
    assert score.tolist() == [7, 4, 1, 0] and (begin[0], end[0], first[0], last[0]) == (3, 10, 0, 7)
    got = linker.align(frame(spark, [(1, "TTCGTACGTAA"), (2, None)], "id long, seq string"), "TACGTACG", 6).orderBy("id").collect()
    assert got[0].score >= 6 and got[0].accepted and not got[1].accepted


def test_linkers_beyond_the_first_120_letters(spark, tmp_path):
    r = random.Random(3)
    text = lambda n: "".join(r.choice("AC") for _ in range(n))
    aligned = "GTTGGATAAGATATCGC"
    reads = [text(200) + "GATCG" + text(90), text(700), text(118) + "GATCG", text(10) + "GATCG" + text(400), text(508) + aligned + text(40), text(300), text(150)]
    frame(spark, list(enumerate(reads)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    mates = frame(spark, [(k // 2, reads[k], reads[k + 1]) for k in (0, 2, 4)], "pair_id int, seq1 string, seq2 string")
    rows = {x.pair_id: (x.linkers, x.tags, x.route) for x in linker.route(mates, "GATCG", 0).collect()}
    assert rows == {0: (1, 2, "two_tag"), 1: (2, 1, "conflict"), 2: (0, 2, "none")}
    tags = {(x.pair_id, x.side): x.tag for x in QUERIES["linker_split"](spark, str(tmp_path)).collect()}
    assert tags == {(k // 2, k % 2 + 1): reads[k].split("GATCG")[0] for k in range(6)}
    got = {(x.pair_id, x.side): x for x in QUERIES["linker_align"](spark, str(tmp_path)).collect()}
    assert sorted(got) == sorted(tags) and (got[2, 1].score, got[2, 1].begin, got[2, 1].end, got[2, 1].strand) == (17, 508, 525, "+")
    whole = linker.local_alignment(reads, aligned, stretch=1000)
    for stretch, lanes in ((1, 3), (50, 2), (256, 4096)):
        assert all((a == b).all() for a, b in zip(linker.local_alignment(reads, aligned, stretch, lanes), whole, strict=True))


def test_statistics(spark):
    t = frame(spark, [(0, 0), (3, 3), (0, 5), (8, 2)], "p long, m long").select(statistics.binomial_half("p", "m").alias("v"))
    assert np.allclose([r.v for r in t.collect()], [1, 1, 0.0625, 0.109375])
    assert statistics.noncentral_tail(0, 5, 5, 20, 1.0) == 1 and statistics.noncentral_tail(6, 5, 5, 20, 1.0) == 0
    assert abs(statistics.noncentral_tail(4, 5, 5, 10, 1.0) - 26 / 252) < 1e-9
    p = [0.9, 0.5, 0.5, 0.04, 0.001, 0.03]
    got = statistics.hochberg(frame(spark, list(enumerate(p)), "id long, p double"), "p", "id").collect()
    ranked = sorted(p, reverse=True)
    want = [min(min((k + 1) * q for k, q in enumerate(ranked[: i + 1])), 1) for i in range(6)]
    assert np.allclose(sorted((r.padj for r in got), reverse=True), want)
    odd = frame(spark, [(1, 3), (None, 3), (4, None), (0, 0)], "p int, m int").select(statistics.binomial_half("p", "m").alias("v"))
    assert [r.v for r in odd.collect()] == [0.625, None, None, 1.0]
    with_null = statistics.hochberg(frame(spark, [(1, None), (2, 0.5), (3, 0.5), (4, 0.0)], "id long, p double"), "p", "id").orderBy("id").collect()
    assert [r.padj for r in with_null] == [None, 0.5, 0.5, 0.0]
    curve = statistics.Spline([0, 1, 2, 3], [0, 1, 8, 27])
    assert np.allclose(curve([0, 1, 2, 3]), [0, 1, 8, 27])
    assert np.allclose(np.diff(curve([3, 4, 5, 9])), [curve([4])[0] - 27] * 2 + [4 * (curve([4])[0] - 27)]) and abs((curve([3 + 1e-6])[0] - 27) / 1e-6 - (27 - curve([3 - 1e-6])[0]) / 1e-6) < 1e-3
    assert np.allclose(statistics.Spline([1, 3], [2, 6])([0, 5]), [0, 10]) and statistics.Spline([4], [2])([9])[0] == 2


def test_significance(spark):
    rows = [(k, "c", 1000 * (k % 7), 1000 * (k % 7) + 10, 50_000 + 1000 * (k % 5), 50_000 + 1000 * (k % 5) + 10, 30 if k == 0 else 2) for k in range(35)]
    t = frame(spark, rows, "loop_id long, chrom string, s1 long, e1 long, s2 long, e2 long, n long")
    tested = significance.p_values(t, 0, 100_000, 10)
    got = {(r.i, r.j): r for r in tested.collect()}
    assert all(0 <= r.pvalue <= 1 for r in got.values()) and min(got.values(), key=lambda r: r.pvalue).n == 30
    assert significance.fdr_cutoff(tested.cache()) >= 0


def test_false_positives_of_the_whole_band(spark):
    r = random.Random(8)
    mids = sorted(r.sample(range(0, 90_000, 500), 40))
    cells = {(a, b): r.choice([2, 2, 3, 5]) for a, b in itertools.combinations(mids, 2) if r.random() < 0.12}
    cells[mids[3], mids[30]] = 40
    rows = [(k, "c", i, i, j, j, n) for k, ((i, j), n) in enumerate(cells.items())]
    t = frame(spark, rows, "loop_id long, chrom string, s1 long, e1 long, s2 long, e2 long, n long")
    points = sorted({x for c in cells for x in c})
    band = [(i, j) for i, j in itertools.combinations(points, 2) if 2000 <= j - i <= 60_000]
    side = {x: sum(n for c, n in cells.items() if x in c) for x in points}

    def fit(masked):
        deltas = sorted((j - i, cells.get((i, j), 0)) for i, j in band if (i, j) not in masked)
        size = max(len(deltas) // 6, 1)
        begins = {}
        for k, (d, _) in enumerate(deltas):
            begins.setdefault(d, min(k // size, 5))
        knots = []
        for q in sorted(set(begins.values())):
            inside = [n for d, n in deltas if begins[d] == q]
            knots.append(((deltas[q * size + (size - 1) // 2][0] + deltas[q * size + size // 2][0]) // 2, sum(inside) / len(inside)))
        curve = statistics.Spline(*zip(*knots, strict=True))
        raw = {(i, j): float(curve([j - i])[0]) for i, j in band}
        sums = {x: sum(v for c, v in raw.items() if x in c) for x in points}
        total, lam = 2 * sum(raw.values()), {c: max(v, 1e-20) for c, v in raw.items()}
        odd = {(i, j): max(v * (total - sums[i] - sums[j] + v) / ((sums[i] - v) * (sums[j] - v)), 0.1) for (i, j), v in lam.items() if (sums[i] - v) * (sums[j] - v) > 1e-20}
        tail = lambda c, n: statistics.noncentral_tail(n, side[c[0]], side[c[1]], 2 * sum(cells.values()), odd[c])
        return lam, {c: tail(c, n) if c in odd else 1.0 for c, n in cells.items() if c in lam}, tail, odd

    def search(p, tail, odd, fdr):
        hits = lambda a: sum(cells[c] >= 3 and v <= a for c, v in p.items())
        false = lambda a: sum(tail(c, next(n for n in itertools.count(3) if tail(c, n) <= a)) for c in odd)
        low, high, alpha, most, rates = 0.0, fdr / 100, fdr / 100, 0, {}
        for step in range(22):
            rates[alpha] = false(alpha) / hits(alpha) if hits(alpha) else 0.0
            if rates[alpha] >= fdr:
                high = alpha
            else:
                low, high = alpha, fdr if step == 0 else high
                if step and (hits(alpha) <= most or hits(alpha) == hits(2)):
                    break
                most = hits(alpha)
            alpha = (low + high) / 2
        good = list(itertools.takewhile(lambda a: rates[a] <= fdr, sorted(rates)))
        return {c for c, v in p.items() if cells[c] >= 3 and v <= (good[-1] if good else 0)}

    masked = set()
    for fdr in (0.01, 0.05):
        lam, p, tail, odd = fit(masked)
        masked = search(p, tail, odd, fdr)
    got = {(x.i, x.j): x for x in significance.refined(t, 2000, 60_000, 6).collect()}
    assert set(got) == masked and (mids[3], mids[30]) in masked and len(band) > 2 * len(p)
    assert all(abs(x.expected - lam[c]) < 1e-9 and abs(x.pvalue - p[c]) < 1e-9 for c, x in got.items())
    once = significance.p_values(t, 2000, 60_000, 6)
    assert {(x.i, x.j) for x in significance.significant(once).collect()} != masked


def test_phasing(spark):
    peaks = frame(spark, [(1, "c", 0, 10), (2, "c", 20, 30), (3, "c", 40, 50), (4, "c", 60, 70)], "id long, chrom string, start long, end long")
    snps = frame(spark, [("c", 1, 5, "P"), ("c", 10, 5, "M"), ("c", 25, 9, "N"), ("c", 26, 9, "P"), ("c", 45, 1, "M")], "chrom string, pos long, coverage long, allele string")
    phased = phasing.peak_phase(peaks, snps)
    assert {r.id: r.phase for r in phased.collect()} == {1: "Mix", 2: "Unphased", 3: "M", 4: "Unphased"}
    loop = frame(spark, [(1, "c", 41, 42, 44, 46, 3)], "loop_id long, chrom string, s1 long, e1 long, s2 long, e2 long, n long")
    assert phasing.loop_phase(loop, peaks.join(phased, "id")).first().phase == "Maternal"
    assert phasing.allele_bias(frame(spark, [(1, 0, 40), (2, 5, 5)], "id long, p long, m long")).where("biased = 'Yes'").first().id == 1


SAM = [
    "@HD\tVN:1.0", "a\t99\tchr1\t100\t60\t4M1D2M\t=\t200\t106\tACGTAC\tIIIIII\tXT:A:U\tX0:i:1", "a\t147\tchr1\t200\t60\t2S4M\t=\t100\t-106\tTTACGT\tIIIIII",
    "b\t4\t*\t0\t0\t*\t*\t0\t0\tAAAA\tIIII", "c\t0\tchr2\t5\t10\t2M2I2M\tchr1\t9000\t0\tACGTAC\tIIIIII",
]


def test_sources(spark, tmp_path):
    (tmp_path / "x.sam").write_text("\n".join(SAM) + "\n")
    reads = readers.read_sam(spark, str(tmp_path / "x.sam"))
    assert reads.count() == 4 and reads.where("qname = 'a' AND flag = 99").first().tags["XT"] == "U"
    piles = {(r.rname, r.pos, r.base, r.strand): r.n for r in alignments.pileup(reads).collect()}
    assert piles["chr1", 104, "-", "+"] == 1 and piles["chr1", 105, "A", "+"] == 1 and piles["chr1", 200, "A", "-"] == 1 and piles["chr2", 7, "A", "+"] == 1
    assert alignments.scan(reads, ("chr1", 105, 106), columns=["qname"]).count() == 1 and alignments.scan(reads, simple_cigar=True).count() == 0
    assert alignments.scan(reads, exclude=alignments.UNMAPPED, min_mapq=20).count() == 2
    assert alignments.flag_summary(reads).first().unmapped == 1 and alignments.self_ligations(reads).count() == 2
    assert {(r.pos1, r.strand1, r.pos2, r.strand2) for r in alignments.to_pairs(reads).where("read_id = 'a'").collect()} == {(100, "+", 205, "-"), (205, "-", 100, "+")}
    regions = frame(spark, [(1, "chr1", 99, 150), (2, "chr9", 0, 9)], "region_id long, chrom string, start long, end long")
    assert {r.region_id: (r.records, r.bases) for r in alignments.count_regions(reads, regions).collect()} == {1: (1, 6), 2: (0, 0)}
    for k in (1, 2):
        (tmp_path / f"{k}.fq").write_text("".join(f"@r{i}/{k}\n{'ACGT' * i}\n+\n{'I' * 4 * i}\n" for i in range(1, 6)))
    both = readers.read_fastq_pairs(spark, str(tmp_path / "1.fq"), str(tmp_path / "2.fq"))
    assert both.count() == 5 and both.where("seq1 <> seq2").count() == 0
    (tmp_path / "x.pairs").write_text("## pairs format v1.0\n#chromsize: chr1 1000\n#columns: readID chr1 pos1 chr2 pos2 strand1 strand2\n.\tchr1\t5\tchr2\t7\t+\t-\textra\nq\tchr1\t6\tchr1\t8\t.\t-\n")
    got = readers.read_pairs(spark, str(tmp_path / "x.pairs")).orderBy("pos1").collect()
    assert got[0].read_id is None and got[0].rest == ["extra"] and got[1].strand1 is None
    assert readers.read_pairs_header(spark, str(tmp_path / "x.pairs")).where("key = 'chromsize'").first().value == "chr1 1000"
    assert readers.read_indexed(spark, str(tmp_path / "x.pairs"), "pairs").where("chr2 = 'chr2'").first().start2 == 7
    (tmp_path / "x.loops").write_text("# c\nchr1\t1\t2\tchr1\t9\t10\t3\nchr1\t1\t2\tchr1\t9\t10\t3\t#x\n")
    assert readers.read_loops(spark, str(tmp_path / "x.loops")).collect()[0].pet_count == 3 and readers.read_loops(spark, str(tmp_path / "x.loops")).count() == 1
    (tmp_path / "x.short").write_text("0 1 100 0 16 2 300 1\n")
    assert tuple(readers.read_short_form(spark, str(tmp_path / "x.short")).first())[1:] == ("chr1", 100, "chr2", 300, "+", "-")
    (tmp_path / "x.nodups").write_text("0 chr1 100 0 16 chr2 300 1 30 4M ACGT 0 4M ACGT r/1 r/2\n")
    assert readers.read_merged_nodups(spark, str(tmp_path / "x.nodups")).first().pos2 == 300 and readers.read_merged_nodups(spark, str(tmp_path / "x.nodups"), 0).count() == 0
    (tmp_path / "x.fa").write_text(">one first\nACGT\nAC\n>two\nGGG\n")
    seqs = readers.read_fasta(spark, str(tmp_path / "x.fa"))
    assert readers.fetch(seqs, frame(spark, [("one", 4, 5)], "name string, start int, end int")).first().bases == "TA"
    (tmp_path / "x.motif").write_text("chr1:5-9\nbad\nchr1:1-2\n")
    assert [r.motif_id for r in readers.read_motifs(spark, str(tmp_path / "x.motif")).orderBy("start").collect()] == ["motif_chr1_1", "motif_chr1_2"]
    (tmp_path / "x.pileup").write_text("c\t5\tA\t3\t.,$^Ig+1Tc\tIII\nc\t6\t*\t1\t+\tI\n")
    b = readers.read_pileup(spark, str(tmp_path / "x.pileup"), "snp").select(sequence.pileup_counts(F.col("bases"), F.col("ref")).alias("b")).first().b
    assert (b.a, b.c, b.g, b.t) == (2, 1, 1, 0)
    (tmp_path / "x.bed").write_text("track x\nchr1\t1\t5\nchr1\t1\t9\n")
    assert readers.read_peaks(spark, str(tmp_path / "x.bed")).first().end == 9


def test_sinks(spark, tmp_path):
    t = frame(spark, [("r", "b", 10, "a", 20, "+", "-"), ("s", "a", 5, "a", 9, None, "+")], "read_id string, chr1 string, pos1 long, chr2 string, pos2 long, strand1 string, strand2 string")
    writers.write_table(t, str(tmp_path / "t"))
    with pytest.raises(Exception, match="(?i)exists"):
        writers.write_table(t, str(tmp_path / "t"))
    writers.write_table(t, str(tmp_path / "t"), force=True)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    assert sorted(r.value for r in writers.pairs_lines(t).collect())[1] == "s\ta\t5\ta\t9\t.\t+"
    tags = frame(spark, [pet(1, 100, 90_000), pet(2, 100, 90_000, 0, 1)], PET)
    writers.write_clusters(pets.first_pass_clusters(pets.extend(tags)), str(tmp_path / "c"), "C")
    assert sorted(os.listdir(tmp_path / "c"))[-2:] == ["class=cis", "class=trans"]
    assert writers.short_form(tags).first().value == "0 0 100 0 16 0 90020 1"


def test_stream(spark, tmp_path):
    t = frame(spark, [pet(1, 100, 9000), pet(2, 9000, 100, strand=1, mstrand=0), pet(3, 5, 6)], PET).withColumn("ts", F.timestamp_seconds("pet_id"))
    t.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(t.schema).parquet(str(tmp_path / "in"))
    for name, made in (("once", incremental.drop_duplicates(stream)), ("classes", incremental.class_counts(stream))):
        run = made.writeStream.format("memory").queryName(name).outputMode("append" if name == "once" else "complete").trigger(availableNow=True).start()
        run.awaitTermination(120)
    assert spark.table("once").count() == 2 and spark.table("classes").agg(F.sum("n")).first()[0] == 3


def test_pairing_and_tables(spark):
    tags = frame(spark, [(1, 1, 1, "U", "a"), (1, 2, 1, "U", "a"), (2, 1, 1, "U", "a"), (2, 2, 2, "U", "b"), (3, 1, 1, "R", None), (3, 2, 1, "U", "a"), (4, 1, 1, "N", None), (4, 2, 1, "N", None)], "pair_id long, read int, tag int, state string, rname string")
    assert {r.pair_id: r["class"] for r in alignments.pair_tags(tags).collect()} == {1: "UU", 2: "discordant", 3: "UxxU", 4: "nn"}
    hits = frame(spark, [("q", 9), ("q", 9), ("q", 5), ("w", 1)], "qname string, score int")
    assert {r.qname: (r.x0, r.x1) for r in alignments.hit_counts(hits).collect()} == {"q": (2, 1), "w": (1, 0)}
    assert qc.linker_summary(frame(spark, [("none",), ("two_tag",)], "route string")).first().with_linker == 1
    a = frame(spark, [("c", 0, 0, 4), ("c", 1, 1, 2), ("c", 0, 1, 3), ("c", 1, 2, 6)], "chrom string, i long, j long, n long")
    assert reproducibility.adjusted_correlation(a, a, 5).first().scc == pytest.approx(1)
    assert reproducibility.smooth(a, 1).agg(F.sum("n")).first()[0] == pytest.approx(15)
    points = np.array([[0.0], [1.0], [5.0], [5.5], [20.0]])
    for method in ("single", "complete", "average", "weighted", "ward"):
        out = reproducibility.linkage(points, method)
        assert out[0].tolist()[:3] == [2, 3, 0.5] and out[-1][3] == 5 and (np.diff(out[:, 2]) >= 0).all()


def best_placement(read, pattern):
    """Smith-Waterman by the book: the best score, and all places in the read and the pattern that reach it."""
    cells = [[(0, {(i, j)}) for j in range(len(pattern) + 1)] for i in range(len(read) + 1)]
    top = (0, {(0, 0, 0, 0)})
    for i in range(1, len(read) + 1):
        for j in range(1, len(pattern) + 1):
            ways = [(cells[i - 1][j - 1][0] + (1 if read[i - 1] == pattern[j - 1] else -1), cells[i - 1][j - 1][1]), (cells[i - 1][j][0] - 1, cells[i - 1][j][1]), (cells[i][j - 1][0] - 1, cells[i][j - 1][1])]
            score = max(w[0] for w in ways)
            if score > 0:
                cells[i][j] = (score, set().union(*(w[1] for w in ways if w[0] == score)))
                places = {(a, i, b, j) for a, b in cells[i][j][1]}
                if score > top[0]:
                    top = (score, places)
                elif score == top[0]:
                    top[1].update(places)
    return top


def test_placements_against_a_plain_alignment():
    r = random.Random(5)
    text = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    pattern = "GTTGGATAAGATATCGC"
    seqs = [text(r.randint(0, 60)) for _ in range(40)] + [text(9) + pattern[:12] + text(3), pattern[5:] + text(30), text(30) + pattern[:13], text(8) + pattern[:8] + "A" + pattern[9:] + text(9)]
    for seq, *got in zip(seqs, *(x.tolist() for x in linker.local_alignment(seqs, pattern)), strict=True):
        score, places = best_placement(seq, pattern)
        assert got[0] == score and (not score or tuple(got[1:]) in places)


def test_linker_tagging(spark):
    s = "ACGCGATATCTTATCTGACT"
    back = tagging.reverse_of(s)
    tag, other = "CCCCCTTTTTCCCCCTTTTTCC", "GGGGGCCGGGGGCCGGGGGCC"
    reads = [
        (1, tag + s + other, other + back + tag), (2, tag + s + other, other + s + tag), (3, tag, other), (4, tag + s, other), (5, "C" * 5 + s, other),
        (6, tag + s[:13], tag), (7, s[8:] + tag, back[:12] + other), (8, tag + s[:11], tag), (9, tag + s + other + back, other), (10, None, ""),
    ]
    t = frame(spark, [(p, k + 1, x) for p, *both in reads for k, x in enumerate(both)], "pair_id long, side int, seq string")
    located = tagging.with_tags(tagging.single_linker(t, s))
    rows = {(r.pair_id, r.side): r for r in located.collect()}
    assert [(rows[1, k].linker, rows[1, k].begin, rows[1, k].end, rows[1, k].tag1, rows[1, k].tag2) for k in (1, 2)] == [("S", 22, 42, 22, 21), ("rcS", 21, 41, 21, 22)]
    assert rows[6, 1].linker == "S" and rows[6, 1].tag1 == 22 and rows[7, 1].linker == "S" and rows[7, 1].begin == 0 and rows[7, 1].tag2 == 22
    assert rows[8, 1].linker == "none" and rows[8, 1].tag1 == 33 and rows[9, 1].tied and rows[10, 1].linker == "none"
    got = {r.pair_id: (r["final_linker"], r["class"]) for r in tagging.pair_class(located).collect()}
    assert got == {1: ("S", "two_tag"), 2: ("none", "conflict"), 3: ("none", "none"), 4: ("S", "two_tag"), 5: ("S", "one_tag"), 6: ("S", "two_tag"), 7: ("S", "one_tag"), 8: ("none", "none"), 9: ("tied", "tied"), 10: ("none", "none")} | {7: got[7]}
    assert {r["class"] for r in tagging.reclassified(located, 30).where("pair_id = 1").collect()} == {"one_tag"}
    tags = {(r.pair_id, r.side, r.tag): r.seq for r in tagging.tag_reads(t, located).collect()}
    assert tags[1, 1, 1] == tag and tags[1, 1, 2] == other and tags[1, 2, 2] == tag and (5, 1, 1) not in tags and tags[3, 1, 1] == tag
    assert tagging.positions(located).where("linker = 'S' AND measure = 'begin' AND value = 22").first().n >= 4


def test_di_linkers(spark):
    a, b = "GTTGGATAAGATATCGC", "GTTGGAATGTATATCGC"
    ra, rb = map(tagging.reverse_of, (a, b))
    x, y = "CCTCTCCTTTCCTCCTCTTCCTT", "TTCCTTCTTTCTCCTTCCCTCTC"
    full = {"AA": a + ra, "BB": b + rb, "AB": a + rb, "BA": b + ra}
    reads = [(k, x + full[n] + y, y + full[m] + x) for k, (n, m) in enumerate([("AA", "AA"), ("AB", "BA"), ("AB", "AB"), ("BB", "AA")])]
    reads += [(4, x + full["AA"] + y, y + a), (5, x + a + y, y + a), (6, x + b + y, x), (7, x, y), (8, x + ra + y, y)]
    t = frame(spark, [(p, k + 1, s) for p, *both in reads for k, s in enumerate(both)], "pair_id long, side int, seq string")
    got = {r.pair_id: (r["final_linker"], r["class"]) for r in tagging.di_pair_class(tagging.with_tags(tagging.di_linker(t, a, b))).collect()}
    assert got == {
        0: ("AA", "full_same_two_tag"), 1: ("AB", "full_mixed_two_tag"), 2: ("none", "conflict"), 3: ("none", "conflict"), 4: ("AA", "full_same_two_tag"), 5: ("AA", "full_same_two_tag"),
        6: ("B", "half"), 7: ("none", "none"), 8: ("rcA", "half"),
    }
    mate = "CTGTCTCTTATACACATCT"
    lmp = frame(spark, [(1, 1, x + mate + tagging.reverse_of(mate) + y), (1, 2, y)], "pair_id long, side int, seq string")
    assert tagging.di_pair_class(tagging.with_tags(tagging.di_linker(lmp, mate))).first()["class"] == "full_same_two_tag"


def test_adapters(spark):
    one, two = "CTGTCTCTTATACACATCTCCGAGC", "CTGTCTCTTATACACATCTGACGCT"
    read = "ACGGTTCAGGCATTACGGATCAGGCTTACG"
    rows = [(1, 1, read + one, "I" * 55), (1, 2, read + two[:14], "I" * 44), (2, 1, read, "I" * 20 + "#" * 10), (2, 2, read[:18] + two, "I" * 43), (3, 1, "ACG", None), (3, 2, "", "")]
    got = {(r.pair_id, r.side): (r.seq, r.route) for r in tagging.trim_adapters(frame(spark, rows, "pair_id long, side int, seq string, qual string"), one, two).collect()}
    assert got[1, 1] == (read, "paired") and got[1, 2] == (read, "paired")
    assert got[2, 1] == (read[:20], "unpaired") and got[2, 2] == (read[:18], "unpaired_short") and got[3, 1] == ("", "paired_short")


def test_more_sources(spark, tmp_path):
    (tmp_path / "i.fq").write_text("".join(f"@r{i // 2}/{i % 2 + 1}\n{'ACGT' * (i + 1)}\n+\n{'I' * 4 * (i + 1)}\n" for i in range(8)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        rows = {(r.pair_id, r.side): (r.name, len(r.seq)) for r in readers.read_interleaved(spark, str(tmp_path / "i.fq")).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert rows == {(i // 2, i % 2 + 1): (f"r{i // 2}/{i % 2 + 1}", 4 * (i + 1)) for i in range(8)}
    (tmp_path / "x.vcf").write_text("##fileformat=VCFv4.2\n##contig=<ID=chr1,length=9>\n##INFO=<ID=DP,Number=1>\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2\nchr1\t5\t.\tA\tC,G\t9.5\tPASS\tDP=3;DB\tGT\t0|1\t1|1\nchr1\t7\trs1\tA\tT\t.\t.\t.\n")
    header = {(r.kind, r.id): r.value for r in readers.read_vcf_header(spark, str(tmp_path / "x.vcf")).collect()}
    assert header["samples", None] == "s1,s2" and header["contig", "chr1"] == "<ID=chr1,length=9>" and header["fileformat", None] == "VCFv4.2"
    one, two = readers.read_vcf(spark, str(tmp_path / "x.vcf")).orderBy("pos").collect()
    assert one.alt == ["C", "G"] and one.info == {"DP": "3", "DB": None} and one.samples == ["0|1", "1|1"] and one.id is None and two.info is None and two.samples == [] and two.qual is None
    assert readers.sequence_names(spark, str(tmp_path / "x.vcf"), "vcf").first().records == 2
    (tmp_path / "x.sam").write_text("\n".join(SAM) + "\n")
    assert {(r.start1, r.end1) for r in readers.read_indexed(spark, str(tmp_path / "x.sam"), "sam").where("chr1 = 'chr1'").collect()} == {(100, 106), (200, 203)}
    many = "a\t0\tchr1\t1\t9\t4M\t*\t0\t0\tACGT\tIIII\t" + "\t".join(f"{chr(65 + i // 26 % 26)}{chr(97 + i % 26)}:Z:{'v' * i}" for i in range(600))
    (tmp_path / "m.sam").write_text(many + "\n")
    tags = readers.read_sam(spark, str(tmp_path / "m.sam"))
    assert len(tags.first().tags) == 600 and alignments.scan(tags, tags={"Ab": ["v"]}).count() == 1 and alignments.scan(tags, tags={"Ab": ["w"]}).count() == 0
    (tmp_path / "x.bow").write_text("r1\t-\tchr1\t4\tACGT\n")
    assert tuple(readers.read_aligner(spark, str(tmp_path / "x.bow"), "bowtie").first()) == ("r1", "chr1", 5, "-")
    (tmp_path / "b.bed").write_text("chr1\t1\t9\nchr1\t1\t5\n")
    assert readers.read_peaks(spark, str(tmp_path / "b.bed")).first().end == 5
    (tmp_path / "n.nodups").write_text("0 chr2 100 0 16 chr1 300 1 30 4M ACGT 30 4M ACGT r/1 r/2\n0 chrX 1 0 0 chr1 3 1 30 4M A 30 4M A r q\n")
    got = readers.read_merged_nodups(spark, str(tmp_path / "n.nodups"), chroms=["chr1", "chr2"]).collect()
    assert [(r.chr1, r.pos1, r.chr2, r.pos2, r.strand1) for r in got] == [("chr1", 300, "chr2", 100, "-")]
    (tmp_path / "run.sh").write_text('# settings\nrun="LD"\nself_bp=9000 # bases\nz_thresh=5\nunknown="x"\n')
    assert config.read_settings(spark, str(tmp_path / "run.sh")) == config.Settings(run="LD", self_bp=9000, z_thresh=5.0)


def test_mates_and_callbacks(spark, tmp_path):
    (tmp_path / "x.sam").write_text("\n".join(SAM) + "\n")
    reads = readers.read_sam(spark, str(tmp_path / "x.sam")).drop("tags")
    got = {r.qname: r for r in alignments.mates(reads).collect()}
    assert got["a"].first.pos == 100 and got["a"].second.pos == 200 and got["c"].first is None and got["c"].second is None
    assert alignments.scan(reads, predicate=F.length("seq") > 4).count() == 3
    seqs = frame(spark, [("one", "ACGTACGT")], "name string, seq string")

    def lengths(batches):
        for pdf in batches:
            yield pdf.assign(n=pdf["bases"].str.len())[["name", "n"]]

    assert readers.fetch_with(seqs, frame(spark, [("one", 2, 5)], "name string, start int, end int"), lengths, "name string, n long").first().n == 4
    tested = frame(spark, [(5, 0.01), (2, 0.001), (4, 0.2)], "n long, pvalue double")
    row = significance.error_counts(tested, frame(spark, [(0.01, 0.5), (0.3, 0.25)], "tail double, weight double"), 0.05).first()
    assert tuple(row) == (1, 0.5) and tuple(significance.error_counts(tested.limit(0), frame(spark, [], "tail double, weight double"), 0.05).first()) == (0, 0)


def test_headers_and_tables(spark):
    head = lambda lines: frame(spark, list(enumerate(lines)), "line_no long, line string")
    merged = pairs.merge_headers(head(["## pairs", "#chromsize: chr1 10", "#command: a"]), head(["## pairs", "#command: b"]))
    assert [r.line for r in merged.orderBy("line_no").collect()] == ["## pairs", "#chromsize: chr1 10", "#command: a", "#command: b"]
    assert [r.line for r in pairs.distinct_header(head(["a", "b", "a"])).orderBy("line_no").collect()] == ["a", "b"]
    assert [r.line for r in pairs.replace_header(head(["#old", "x"]), head(["#new"])).orderBy("part", "line_no").collect()] == ["#new", "x"]
    table = pairs.PairsTable(frame(spark, [("r", "chr1", 5, "chr2", 7)], "read_id string, chr1 string, pos1 long, chr2 string, pos2 long"), head(["#chromsize: chr1 10"]))
    assert table.exists("chr1", "chr2") and table.exists("chr1|chr2") and not table.exists("chr2", "chr1") and table.triangle() and table.line_count() == 1
    assert table.chromosome_sizes().first().length == 10 and table.column("pos2") == 4 and table.column("x") == -1 and table.query("chr1:1-9|chr2").count() == 1 and table.blocks().count() == 1
    made = pairs.random_pairs(spark, 200, {"chr1": 100, "chr2": 50}, 3)
    assert made.count() == 200 and made.where("chr1 > chr2 OR (chr1 = chr2 AND pos1 > pos2) OR pos1 < 1 OR pos1 > 100").count() == 0
    assert sorted(map(tuple, made.collect())) == sorted(map(tuple, pairs.random_pairs(spark, 200, {"chr1": 100, "chr2": 50}, 3).collect()))


def test_more_sinks(spark, tmp_path):
    loop = frame(spark, [(1, "chr1", 5, 6, 8, 9, 3)], "loop_id long, chrom string, s1 long, e1 long, s2 long, e2 long, n long")
    writers.write_annotations(loop, str(tmp_path / "a"))
    assert sorted({r.value for r in spark.read.text(str(tmp_path / "a")).collect()}) == ["chr1\t5\t6\tchr1\t8\t9\t0,204,255", "chr1\tx1\tx2\tchr2\ty1\ty2\tcolor"]
    writers.write_qc(frame(spark, [("pairs", 800000.0), ("share", 0.25)], "metric string, value double"), str(tmp_path / "q"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "q")).collect()) == ["pairs\t800,000", "share\t0.25"]
    writers.write_clusters(pets.first_pass_clusters(pets.extend(frame(spark, [pet(1, 100, 90_000), pet(2, 100, 90_000, 0, 1)], PET))), str(tmp_path / "c"), True)
    assert sorted(r.value.split("\t")[6] for r in spark.read.text(str(tmp_path / "c")).collect()) == ["C_1_1", "T_1_1"]


def plain_linkage(points, method):
    """The textbook loop: the nearest two clusters merge, distances after the method's definition."""
    groups, d = {i: 1 for i in range(len(points))}, {}
    for i, j in itertools.combinations(range(len(points)), 2):
        d[i, j] = float(np.linalg.norm(points[i] - points[j]))
    heights, at = [], len(points)
    of = lambda a, b: d[min(a, b), max(a, b)]
    while len(groups) > 1:
        i, j = min(itertools.combinations(sorted(groups), 2), key=lambda p: of(*p))
        h, a, b = of(i, j), groups[i], groups[j]
        heights.append(h)
        for k in groups:
            if k not in (i, j):
                x, y, c = of(i, k), of(j, k), groups[k]
                square = {"ward": ((a + c) * x**2 + (b + c) * y**2 - c * h**2) / (a + b + c), "centroid": (a * x**2 + b * y**2) / (a + b) - a * b * h**2 / (a + b) ** 2, "median": (x**2 + y**2) / 2 - h**2 / 4}
                d[k, at] = {"single": min(x, y), "complete": max(x, y), "average": (a * x + b * y) / (a + b), "weighted": (x + y) / 2}.get(method) if method not in square else max(square[method], 0) ** 0.5
        del groups[i], groups[j]
        groups[at] = a + b
        at += 1
    return heights


@pytest.mark.parametrize("method", ["single", "complete", "average", "weighted", "ward", "centroid", "median"])
def test_linkage(method):
    r = np.random.default_rng(2)
    points = r.normal(0, 1, (40, 3))
    got = reproducibility.linkage(points, method)
    assert np.allclose(got[:, 2], plain_linkage(points, method)) and got[-1, 3] == 40
    seen = set()
    for step, (a, b, _, size) in enumerate(got):
        assert a < b < 40 + step and not {a, b} & seen
        seen |= {a, b}
        assert size == sum(1 if x < 40 else got[int(x) - 40, 3] for x in (a, b))
    assert len(reproducibility.linkage(points[:1], method)) == 0


def test_reproducibility_training(spark):
    r = random.Random(1)
    make = lambda: frame(spark, [("c", i, j, 1 + r.randint(0, 3) + 10 // (1 + j - i)) for i in range(30) for j in range(i, min(30, i + 8)) if r.random() < 0.8], "chrom string, i long, j long, n long")
    a, b = make(), make()
    h, seen = reproducibility.train_smoothing(a, b, 6, 3)
    assert 0 <= h <= 3 and len(seen) >= 2 and all(-1 <= x <= 1 for x in seen)
    row = reproducibility.adjusted_correlation(a, b, 6).first()
    assert 0 < row.sd < 1 and row.strata == 7
    total = a.agg(F.sum("n")).first()[0]
    less = reproducibility.thinned(a, total // 2)
    kept = less.agg(F.sum("n")).first()[0]
    assert abs(kept - total / 2) < 0.1 * total and less.join(a.withColumnRenamed("n", "m"), ["chrom", "i", "j"]).where("n > m").count() == 0
    assert kept == reproducibility.thinned(a.repartition(3), total // 2).agg(F.sum("n")).first()[0] and reproducibility.thinned(a, total).count() == a.count()


def test_islands_over_tiles(spark):
    r = random.Random(9)
    rows = [(k, r.choice("ab"), s, s + r.randint(0, 60)) for k in range(400) for s in [r.randint(0, 4000)]]
    t = frame(spark, rows, "id long, chrom string, start long, end long")
    for touching in (True, False):
        want, reach, number = {}, {}, {}
        for k, c, s, e in sorted(rows, key=lambda x: (x[1], x[2], x[3])):
            if c not in reach or (s > reach[c] if touching else s >= reach[c]):
                number[c] = number.get(c, 0) + 1
            reach[c] = max(reach.get(c, e), e)
            want[k] = number[c]
        for tile in (7, 100, 1 << 20):
            assert {x.id: x.n for x in intervals.number_islands(t, ["chrom"], "start", "end", "n", touching, tile).collect()} == want


def test_densities(spark):
    assert density.poisson_cutoff(2.0, 0.05) == 6 and density.poisson_cutoff(0.0, 0.5) == 1
    t = frame(spark, [("c", 1000, "+")] * 3 + [("c", 1300, "-")] * 2 + [("c", 40_000, "+")], "chrom string, pos long, strand string")
    assert max(density.cross_correlation(t, 500, 10).collect(), key=lambda r: r.n).shift == 300
    total = density.smoothed(t, 10, 50).agg(F.sum("density")).first()[0]
    assert abs(total * 10 - 6) < 0.05
