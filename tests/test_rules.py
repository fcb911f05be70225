"""Rules of linkers, adapters and phases on fixtures, and structures against plain versions."""

import itertools
import random

import numpy as np
import pytest

from lociflow.functions.overlap import Overlap
from lociflow.functions.statistics import Spline
from lociflow.operators import intervals, linker, loops, pets, phasing, significance, tagging
from lociflow.sources import writers

READ = "ACGGTTCAGGCATTACGGATCAGGCTTACGTTACCGGA"


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# --- linkers


def test_an_exact_linker_goes_before_an_earlier_fuzzy_one(spark):
    exact, fuzzy = "GATCGATCGATC", "GAACGATCGTTC"
    seqs = ["TTTTT" + fuzzy + "C" * 19 + exact + "GG", "TTTTT" + fuzzy + "C" * 19, "TTTTT", exact + "TT", fuzzy + "TT", "A" * 20 + exact[:11] + "A", "", None]
    t = frame(spark, [(k, s) for k, s in enumerate(seqs)], "k long, seq string")
    got = {r.k: r.tag for r in t.select("k", linker.tag_before(t.seq, exact, 2).alias("tag")).collect()}
    assert got == {0: "TTTTT" + fuzzy + "C" * 19, 1: "TTTTT", 2: "TTTTT", 3: "A", 4: "A", 5: "A" * 20, 6: "", 7: None}
    assert {r.k: r.tag for r in t.select("k", linker.tag_before(t.seq, exact, 0).alias("tag")).collect()}[1] == seqs[1]
    mates = frame(spark, [(1, seqs[0], "A" * 30), (2, seqs[1], "A" * 30)], "pair_id long, seq1 string, seq2 string")
    assert {r.pair_id: r.route for r in linker.route(mates, exact, 2).collect()} == {1: "two_tag", 2: "one_tag"}


def alignment(read, pattern):
    """Smith-Waterman by the book: score, begin, end, first, last of the best placement that ends first."""
    best, table = (0, 0, 0, 0, 0), [[(0, j, 0) for j in range(len(read) + 1)]]
    for i in range(1, len(pattern) + 1):
        table.append([(0, 0, i)])
        for j in range(1, len(read) + 1):
            hit = 1 if pattern[i - 1] == read[j - 1] else -1
            d, up, left = table[i - 1][j - 1], table[i - 1][j], table[i][j - 1]
            score, start = max((d[0] + hit, (d[1], d[2])), (up[0] - 1, (up[1], up[2])), (left[0] - 1, (left[1], left[2])), key=lambda x: x[0])
            table[i].append((score, *start) if score > 0 else (0, j, i))
    for j in range(len(read) + 1):
        for i in range(len(pattern) + 1):
            if table[i][j][0] > best[0]:
                best = (table[i][j][0], table[i][j][1], j, table[i][j][2], i)
    return best


def accepted(place, read, size, full, partial, ends, at_start):
    score, begin, end, first, last = place
    lost = last - first - score
    rule = next(((low, high) for covered, low, high in ends if last - first >= covered), None)
    at_end = first == 0 and end == len(read) or at_start and begin == 0 and last == size
    return score >= full or score >= partial and at_end and rule is not None and rule[0] <= lost <= rule[1]


def test_adapters_short_pieces_count_at_the_end_only(spark):
    one, two = "CTGTCTCTTATACACATCTCCGAGCCCACGAGAC", "CTGTCTCTTATACACATCTGACGCTGCCGACGA"
    pieces = {"whole": one, "17 in the middle": one[:17] + READ, "12": one[:12], "11": one[:11], "18": one[:18], "28 in the middle": one[:28] + READ, "27 in the middle": one[:27] + READ, "12, one lost": one[:5] + "A" + one[6:13]}
    rows = [(k, 1, READ + p) for k, p in enumerate(pieces.values())] + [(k, 2, READ + two[:27] + READ[:k]) for k in range(3)] + [(3, 2, READ + two[:26] + READ)]
    t = frame(spark, [(p, s, x, "I" * len(x)) for p, s, x in rows], "pair_id long, side int, seq string, qual string")
    got = {(r.pair_id, r.side): len(r.seq) for r in tagging.trim_adapters(t, one, two).collect()}
    want = {}
    for p, s, read in rows:
        place = alignment(read, (one, two)[s - 1])
        good = accepted(place, read, 0, (28, 27)[s - 1], 11, ((28, 0, 6), (18, 0, 4), (12, 0, 2)), False)
        want[p, s] = place[1] if good else len(read)
    assert got == want
    named = {n: want[k, 1] for k, n in enumerate(pieces)}
    assert named["17 in the middle"] == len(READ) + 17 + len(READ) and named["12"] == named["28 in the middle"] == len(READ) and named["11"] == len(READ) + 11


def test_half_linkers_at_a_read_s_end(spark):
    a, b = "GTTGGATAAGATATCGC", "GTTGGAATGTATATCGC"
    back = tagging.reverse_of
    reads = [a[5:] + READ, a[4:] + READ, a[3:] + READ, READ + a[:12], READ + a[:13], READ + a[:14], READ + b, a[:6] + "C" + a[7:] + READ, READ + back(b)[:14], READ]
    r = random.Random(4)
    for _ in range(40):
        piece = list(r.choice([a, b, back(a), back(b)]))
        for _ in range(r.randint(0, 3)):
            piece[r.randrange(len(piece))] = r.choice("ACGT")
        cut = r.randint(10, 17)
        reads.append("".join(piece[-cut:]) + READ if r.random() < 0.5 else READ + "".join(piece[:cut]))
    t = frame(spark, [(k, 1, s) for k, s in enumerate(reads)], "pair_id long, side int, seq string")
    got = {r.pair_id: (r.linker, r.tied) for r in tagging.di_linker(t, a, b).collect()}
    halves, ends = {"A": a, "B": b, "rcA": back(a), "rcB": back(b)}, ((17, 0, 4), (14, 0, 2), (13, 2, 2))
    for k, read in enumerate(reads):
        fulls = [alignment(read, x + back(y)) for x, y in itertools.product((a, b), repeat=2)]
        if any(accepted(f, read, 34, 30, 26, ((36, 0, 8), (32, 0, 6)), True) for f in fulls):
            continue
        best, tied = None, False
        for name, half in halves.items():
            place = alignment(read, half)
            if best is None or place[0] > best[1][0]:
                best, tied = (name, place), False
            elif place[0] == best[1][0]:
                tied = True
        good = accepted(best[1], read, 17, 14, 11, ends, True)
        assert got[k] == ((best[0], tied) if good else ("none", False)), (k, read, got[k], best)
    assert got[0] == ("none", False) and got[6][0] == "B"


# --- phases


def test_loops_are_phased_by_peaks_of_one_side(spark):
    kinds = [(1, "c", 0, 50, "Mix"), (2, "c", 40, 90, "P"), (3, "c", 60, 95, "M"), (4, "c", 200, 250, "Unphased"), (5, "c", 240, 260, "M"), (6, "c", 400, 420, "Unphased"), (7, "d", 0, 500, "P")]
    peaks = frame(spark, kinds, "id long, chrom string, start long, end long, phase string")
    boxes = [(1, "c", 30, 70, 400, 410), (2, "c", 245, 255, 400, 410), (3, "c", 45, 70, 230, 255), (4, "c", 300, 310, 405, 415), (5, "d", 490, 510, 500, 600), (6, "c", 300, 310, 405, 415), (7, "c", 92, 93, 96, 97)]
    t = frame(spark, [(*x, 3) for x in boxes], "loop_id long, chrom string, s1 long, e1 long, s2 long, e2 long, n long")
    got = {r.loop_id: (r["head"], r["tail"], r.phase) for r in phasing.loop_phase(t, peaks).collect()}
    assert got == {1: ("P", "NA", "Paternal"), 2: ("M", "NA", "Maternal"), 3: ("P", "M", "Crossed"), 5: ("P", "P", "Paternal"), 6: ("NA", "NA", "nonPhased"), 7: ("M", "NA", "Maternal")}


def test_phased_peaks_four_outputs(spark, tmp_path):
    peaks = frame(spark, [(1, "c", 0, 10), (2, "c", 20, 30), (3, "c", 40, 50), (4, "c", 60, 70), (5, "c", 80, 90), (6, "d", 0, 9)], "id long, chrom string, start long, end long")
    snps = [("c", 10, "A|C", 2, 5, "M"), ("c", 1, "A|G", 7, 1, "P"), ("c", 25, "x", 9, 9, "N"), ("c", 26, "y", 9, 3, "P"), ("c", 45, "z", 0, 1, "M"), ("c", 60, "v", 8, 1, "P"), ("c", 70, "w", 2, 2, "N"), ("c", 85, "o", 0, 0, "M")]
    t = frame(spark, snps, "chrom string, pos long, name string, p long, m long, allele string")
    phases = phasing.peak_phase(peaks, t.selectExpr("chrom", "pos", "p + m AS coverage", "allele"))
    assert {r.id: (r.phase, r.phased_snps) for r in phases.collect()} == {1: ("Mix", 2), 2: ("Unphased", 0), 3: ("M", 1), 4: ("P", 1), 5: ("Unphased", 0), 6: ("Unphased", 0)}
    writers.write_phased_peaks(peaks, t, str(tmp_path / "out"))
    lines = {k: sorted(r.value for r in spark.read.text(str(tmp_path / "out" / k)).collect()) for k in ("annotation", "browser", "Maternal", "Paternal")}
    assert lines["annotation"] == ["c:0-10\t2\tMix\t1,P,7:1,A:G|10,M,2:5,A:C", "c:40-50\t1\tM\t45,M,0:1,z", "c:60-70\t1\tP\t60,P,8:1,v"]
    assert lines["browser"][0] == "c\t0\t10\tMix\t209,229,240" and len(lines["browser"]) == 6 and "d\t0\t9\tUnphased\t153,153,153" in lines["browser"]
    assert lines["Maternal"] == ["c\t0\t10", "c\t20\t30", "c\t40\t50", "c\t80\t90", "d\t0\t9"] and "c\t60\t70" in lines["Paternal"] and "c\t40\t50" not in lines["Paternal"]


# --- intervals of all lengths


@pytest.mark.parametrize("how", list(Overlap))
def test_intervals_of_all_lengths(spark, how):
    r = random.Random(5)
    size = lambda: r.choice([0, 1, 15, 16, 17, 255, 256, 257, 5000, 70_000, 3_000_000])
    make = lambda n: [(k, r.choice("ab"), s, s + size()) for k in range(n) for s in [r.randrange(0, 400_000)]]
    schema = "id long, chrom string, start long, end long"
    for one, two in ((make(120), make(90)), (make(60), [(k, "a", 40 * k, 40 * k + 20) for k in range(60)]), ([(1, "a", 0, 250_000_000)], make(50)), (make(5), [])):
        a, b = frame(spark, one, schema), frame(spark, two, schema)
        meet = (lambda x, y: x[2] < y[3] and y[2] < x[3]) if how is Overlap.HALF_OPEN else (lambda x, y: x[2] <= y[3] and y[2] <= x[3])
        want = sorted((x[0], y[0]) for x in one for y in two if x[1] == y[1] and meet(x, y))
        got = sorted((x.l_id, x.r_id) for x in intervals.inner_join(a, b, ["chrom"], how, 16).collect())
        assert got == want
        assert {x.id for x in intervals.semi_join(a, b, ["chrom"], "id", how, 16).collect()} == {x for x, _ in want}


def test_long_intervals_take_few_rows(spark):
    t = frame(spark, [(1, "c", 1000, 250_000_000), (2, "c", 5, 10)], "id long, chrom string, start long, end long")
    out = intervals._spread(t, "start", "end", ("_b", "_l", "_o"), Overlap.HALF_OPEN, intervals.BIN, {0, 4}, {0, 4})
    assert out.where("id = 1").count() <= 2 and out.where("id = 2").count() <= 4


def test_islands_of_both_sides_scan_their_input_twice(spark):
    t = frame(spark, [(k, 0, 0, 100 * k, 100 * k + 150, 9000 + 70 * (k % 9), 9060 + 70 * (k % 9)) for k in range(40)], "pet_id long, tid long, mtid long, s1 long, e1 long, s2 long, e2 long")
    got = pets.first_pass_bins(t)
    assert {(r.island1, r.island2) for r in got.collect()} == {(1, k) for k in range(1, 10)}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1 and plan.count("Relation [") + plan.count("Relation parquet") <= 4


# --- significance without a list of pairs


def test_spline_pieces():
    curve = Spline([3, 10, 40, 41, 90], [5.0, 1.0, 2.0, 8.0, 3.0])
    t = np.arange(0, 200)
    for widest in (1, 7, 1000):
        got = np.concatenate([np.polynomial.polynomial.polyval(np.arange(b - a), c) for a, b, c in curve.pieces(0, 199, widest)])
        assert np.allclose(got, curve(t))
    for x, y in (([4], [2.0]), ([4, 6], [2.0, 8.0])):
        got = np.concatenate([np.polynomial.polynomial.polyval(np.arange(b - a), c) for a, b, c in Spline(x, y).pieces(0, 20, 8)])
        assert np.allclose(got, Spline(x, y)(np.arange(21)))


@pytest.mark.parametrize("least", [0, 2000])
def test_band_sums_against_listed_pairs(spark, least):
    r = random.Random(3)
    points = {c: sorted(r.sample(range(7, 3_000_000, 10), 250)) for c in "ab"} | {"c": [5], "d": [1, 900_000]}
    t = frame(spark, [(c, m) for c, ms in points.items() for m in ms], "chrom string, mid long").repartition(5)
    most, curve = 60_000, Spline([500, 9000, 30_000, 55_000], [9.0, 2.0, 1.5, 0.1])
    counts, sums = {}, {}
    for c, ms in points.items():
        for x in ms:
            sums[c, x] = sum(float(curve(abs(x - y))) for y in ms if least <= abs(x - y) <= most and x != y) + (2 * float(curve(0)) if least == 0 else 0)
        for x, y in itertools.combinations_with_replacement(ms, 2):
            if least <= y - x <= most:
                counts[y - x] = counts.get(y - x, 0) + 1
    assert {x.delta: x.n for x in significance.distance_counts(t, least, most).collect()} == counts
    got = {(x.chrom, x.mid): x.total for x in significance.expected_sums(t, curve, least, most).collect()}
    assert set(got) == set(sums) and all(abs(got[k] - v) < 1e-9 * max(1, abs(v)) for k, v in sums.items())


def test_band_sums_far_along_a_chromosome():
    """Exact where sums of cubes pass 2 ** 64."""
    mid = np.arange(0, 40_000_000, 11, dtype=np.int64) + 2_000_000_000
    at = mid[1_000_000:1_000_020]
    curve = Spline([1000, 20_000, 90_000], [7.0, 3.0, 1.0])
    want = [float(curve(mid[(mid >= x + 2000) & (mid <= x + 100_000)] - x).sum()) for x in at]
    assert np.allclose(significance.range_sums(mid, at, curve.pieces(2000, 100_000, significance.WIDEST)), want, rtol=1e-12)


def test_totals_are_each_chromosome_s(spark):
    rows = [(k, c, 1000 * (k % 7), 1000 * (k % 7), 50_000 + 1000 * (k % 5), 50_000 + 1000 * (k % 5), 2 + k % 3) for c in "ab" for k in range(35)]
    both = frame(spark, rows, "loop_id long, chrom string, s1 long, e1 long, s2 long, e2 long, n long")
    lone = {(x.chrom, x.i, x.j): x for c in "ab" for x in significance.p_values(both.where(f"chrom = '{c}'"), 2000, 100_000, 5).collect()}
    # Both chromosomes are alike, so a common decay is that of either.
    got = {(x.chrom, x.i, x.j): x for x in significance.p_values(both, 2000, 100_000, 5).collect()}
    assert set(got) == set(lone) and all(abs(x.pvalue - lone[k].pvalue) < 0.05 for k, x in got.items())
    assert loops.min_count(both, 4).count() > 0
