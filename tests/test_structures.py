"""Closure of boxes, spanning forests, region lists and tag densities against plain versions."""

import hashlib
import itertools
import math
import random
import time
from decimal import Decimal, localcontext

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociflow.functions.statistics import poisson_tails, step_up
from lociflow.operators import alignments, density, graphs, intervals, pairs, pets, phasing, reproducibility


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# --- closure of boxes

BOX = "tid long, mtid long, s1 long, e1 long, s2 long, e2 long, n long"


def closure(boxes):
    """Merges any two that overlap, until none do."""
    boxes = [list(b) for b in boxes]
    while True:
        for x, y in itertools.combinations(range(len(boxes)), 2):
            a, b = boxes[x], boxes[y]
            if a[:2] == b[:2] and a[2] <= b[3] and b[2] <= a[3] and a[4] <= b[5] and b[4] <= a[5]:
                boxes[x] = [*a[:2], min(a[2], b[2]), max(a[3], b[3]), min(a[4], b[4]), max(a[5], b[5]), a[6] + b[6]]
                del boxes[y]
                break
        else:
            return sorted(map(tuple, boxes))


@pytest.mark.parametrize("spread", [200, 2000, 30_000])
def test_closure_of_boxes(spark, spread):
    r = random.Random(spread)
    size = lambda: r.choice([0, 1, 3, 60, 64, 300, 900])
    rows = []
    for _ in range(120):
        s1, s2 = r.randrange(spread), r.randrange(spread)
        rows.append((r.randrange(2), 0, s1, s1 + size(), s2, s2 + size(), r.randint(1, 3)))
    rows += rows[:3] + [(5, 5, 10, 10, 10, 10, 1), (5, 5, 11, 11, 11, 11, 1), (5, 5, 0, 40_000_000, 60, 70, 1), (5, 5, 100, 110, 70, 90, 1)]
    assert sorted(map(tuple, pets.closed_boxes(frame(spark, rows, BOX)).collect())) == closure(rows)
    assert pets.closed_boxes(frame(spark, [], BOX)).count() == 0


def test_closure_of_a_crowded_bin(spark):
    """One place that holds 100,000 different boxes, a chain of them, and far ones."""
    k = F.col("id")
    crowd = spark.range(100_000).select(F.lit(0).cast("long").alias("tid"), F.lit(0).cast("long").alias("mtid"), (k % 400).alias("s1"), (k % 400 + 500).alias("e1"), F.floor(k / 400).alias("s2"), (F.floor(k / 400) + 500).alias("e2"), F.lit(1).cast("long").alias("n"))
    chain = [(1, 1, 400 * i, 400 * i + 450, 400 * i, 400 * i + 450, 1) for i in range(200)] + [(1, 1, 0, 9, 500_000, 500_009, 1)]
    got = sorted(map(tuple, pets.closed_boxes(crowd.union(frame(spark, chain, BOX))).collect()))
    assert got == [(0, 0, 0, 899, 0, 749, 100_000), (1, 1, 0, 9, 500_000, 500_009, 1), (1, 1, 0, 199 * 400 + 450, 0, 199 * 400 + 450, 200)]


# --- graphs


def test_components_and_forest(spark):
    r = random.Random(2)
    edges = [(r.randrange(300), r.randrange(300), r.choice([0.5, 1.0, 1.0, 2.0, 3.5])) for _ in range(400)] + [(500, 501, 1.0), (501, 500, 0.25), (7, 7, 0.1)]
    t = frame(spark, edges, "a long, b long, weight double").repartition(4)
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    want = set()
    for w, x, y in sorted((w, min(a, b), max(a, b)) for a, b, w in edges if a != b):
        if top(x) != top(y):
            parent[max(top(x), top(y))] = min(top(x), top(y))
            want.add((x, y, w))
    assert {tuple(e) for e in graphs.spanning_forest(t).collect()} == want
    roots = {x.node: x.root for x in graphs.components(t.select("a", "b")).collect()}
    assert roots == {x: top(x) for e in edges if e[0] != e[1] for x in e[:2]}
    assert graphs.components(t.select("a", "b").limit(0)).count() == 0 and graphs.spanning_forest(t.limit(0)).count() == 0


def test_single_linkage_is_the_forest(spark):
    r = np.random.default_rng(5)
    points = np.concatenate((r.normal(0, 1, (60, 2)), r.normal(6, 0.7, (40, 2))))
    t = frame(spark, [(i, p.tolist(), "x") for i, p in enumerate(points)], "id long, vector array<double>, kind string")
    forest = graphs.spanning_forest(graphs.near_pairs(t, 20.0, 2))
    want = reproducibility.linkage(points, "single")
    steps = graphs.merge_steps(forest, t).orderBy("step").collect()
    assert np.allclose([s.height for s in steps], want[:, 2]) and [s.step for s in steps] == list(range(99))
    near = {(x.a, x.b): x.weight for x in graphs.near_pairs(t, 0.8, 2, ["kind"]).collect()}
    every = {(i, j): float(np.sqrt(((points[i] - points[j]) ** 2).sum())) for i, j in itertools.combinations(range(100), 2)}
    assert set(near) == {k for k, d in every.items() if d <= 0.8} and all(abs(every[k] - d) < 1e-9 for k, d in near.items())
    flat = {x.id: x.cluster for x in graphs.flat_clusters(forest, t, 1.5).collect()}
    cut = {i: i for i in range(100)}
    for (i, j), d in every.items():
        if d <= 1.5:
            a, b = cut[i], cut[j]
            cut = {k: min(a, b) if v in (a, b) else v for k, v in cut.items()}
    assert flat == cut


def test_single_linkage_of_many_points(spark):
    """100,000 points of one group: a line of them with growing gaps, and its merges."""
    k = F.col("id")
    t = spark.range(100_000).select("id", F.array(k.cast("double") + F.floor(k / 1000) * 0.5, F.lit(0.0)).alias("vector"))
    forest = graphs.spanning_forest(graphs.near_pairs(t, 1.6, 2))
    got = {x.weight: x["count"] for x in forest.groupBy("weight").count().collect()}
    assert got == {1.0: 99_900, 1.5: 99}
    assert graphs.flat_clusters(forest, t, 1.2).select("cluster").distinct().count() == 100


# --- region lists


def test_region_lists(spark):
    r = random.Random(6)
    rows = [(f"r{i}", f"c{r.randrange(3)}", r.randrange(1, 60_000), f"c{r.randrange(3)}", r.randrange(1, 60_000)) for i in range(800)]
    t = frame(spark, rows, "read_id string, chr1 string, pos1 long, chr2 string, pos2 long")

    def side():
        kind, start = r.randrange(5), r.randrange(1, 60_000)
        return ["*", f"c{r.randrange(4)}", f"c{r.randrange(3)}:{start}", f"c{r.randrange(3)}:{start}-{start + r.choice([0, 1, 900, 5000, 50_000])}", f"c{r.randrange(3)}:{start:,}-{start + 4096:,}"][kind]

    texts = [f"{side()}|{side()}" for _ in range(300)] + ["c1", "c1:1-5000", ".", "*|c2:1-3000", "c2:1-3000|*", "c0:1-1|c0", "c1:1-5000", "c9"]
    got = sorted((x.read_id, x["query"]) for x in pairs.query_list(t, texts).collect())
    parsed = [pairs.parse_query(q) for q in texts]
    holds = lambda g, c, p: g.chrom is None or g.chrom == c and (g.start, g.end) == (0, pairs.OPEN_END) or g.chrom == c and g.start < p <= g.end
    want = sorted((i, k) for i, c1, p1, c2, p2 in rows for k, (a, b) in enumerate(parsed) if holds(a, c1, p1) and holds(b, c2, p2))
    assert got == want and len(want) > 1000
    assert pairs.query_list(t, texts).columns == [*t.columns, "query"] and pairs.query_list(t, []).count() == 0


def test_many_regions_plan_quickly(spark):
    t = frame(spark, [("r", "c1", 5000, "c1", 7_005_000)], "read_id string, chr1 string, pos1 long, chr2 string, pos2 long")
    texts = [f"c1:{700 * k + 1}-{700 * k + 1400}|c1:{7_000_000 + 700 * k}-{7_000_700 + 700 * k}" for k in range(10_000)]
    pairs.query_list(t, texts[:10]).count()
    start = time.time()
    out = pairs.query_list(t, texts)
    out._jdf.queryExecution().executedPlan()
    assert time.time() - start < 3
    assert sorted(x["query"] for x in out.collect()) == [7]


# --- densities


def test_poisson_tails_and_step_up(spark):
    for mean in (0.3, 4.0, 90.0):
        for n in (0, 1, 3, 90, 140):
            want = math.fsum(math.exp(j * math.log(mean) - mean - math.lgamma(j + 1)) for j in range(n, n + 600)) if n else 1.0
            assert abs(poisson_tails([n], [mean])[0] - want) <= 1e-9 * want
    assert poisson_tails([0, 2], [0.0, 0.0]).tolist() == [1.0, 0.0] and 0 < poisson_tails([100], [1.0])[0] < 1e-150 and poisson_tails([400], [1.0])[0] == 0
    r = random.Random(1)
    rows = [(k, r.choice([1e-12, 1e-9, 0.003, 0.0031, 0.2, 0.5, r.random()]), r.randint(1, 9)) for k in range(200)]
    total = sum(w for _, _, w in rows) * 2
    q = {x.k: x.qvalue for x in step_up(frame(spark, rows, "k long, p double, w long"), "p", "w", total).collect()}
    at = {p: p * total / sum(w for _, x, w in rows if x <= p) for _, p, _ in rows}
    assert all(abs(q[k] - min(1, min(v for x, v in at.items() if x >= p))) < 1e-12 for k, p, _ in rows)


def tags(spark, seed=3, n=900, size=9000):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        at = r.choice([2000, 2000, 6000, r.randrange(size)]) + int(r.gauss(0, 60))
        forward = r.random() < 0.5
        rows.append((i, r.choice("ab"), max(0, min(size - 1, at - 75 if forward else at + 75)), "+" if forward else "-"))
    return rows, frame(spark, rows, "id long, chrom string, pos long, strand string").repartition(4)


def depths(rows, size, low, high):
    """Of each place how many tags (chrom, pos, strand) have it in [low, high) of themselves."""
    out = {c: np.zeros(size, int) for c in "ab"}
    for _, c, p, s in rows:
        a, b = low(p, s), high(p, s)
        out[c][max(a, 0) : max(b, 0)] += 1
    return out


def test_poisson_tails_of_deep_places_keep_their_digits():
    with localcontext() as context:
        context.prec = 50
        for n, mean in ((462, 462.8277), (520, 462.8277), (1000, 1031.25), (1133, 925.6554), (95, 77.13795), (3, 1e-300)):
            below, term = Decimal(0), (-Decimal(mean)).exp()
            for j in range(n):
                below, term = below + term, term * Decimal(mean) / (j + 1)
            want = 1 - below
            assert abs(Decimal(float(poisson_tails([n], [mean])[0])) - want) <= Decimal("2e-13") * want + Decimal("1e-40")


@pytest.mark.parametrize("with_control", [True, False])
def test_local_background(spark, with_control):
    (rows, t), (others, control) = tags(spark), tags(spark, 9, 300)
    size, length, windows, genome = 9500, 100, (300, 1001), 20_000
    depth = depths(rows, size, lambda p, s: p if s == "+" else p - length + 1, lambda p, s: p + length if s == "+" else p + 1)
    own, scale = (others, len(rows) / len(others)) if with_control else (rows, 1.0)
    widths = (length, *windows) if with_control else (1001,)
    near = [depths(own, size, lambda p, s, w=w: p - w // 2 + 1 - w % 2, lambda p, s, w=w: p - w // 2 + 1 - w % 2 + w) for w in widths]
    places = {}
    for c in "ab":
        for x in np.flatnonzero(depth[c]):
            background = max(len(rows) * length / genome, *(m[c][x] * (scale * length / w) for m, w in zip(near, widths, strict=True)), 0)
            places[c, int(x)] = (int(depth[c][x]), background, float(poisson_tails([depth[c][x]], [background])[0]))
    ps = sorted(v[2] for v in places.values())
    q, least = {}, 1.0
    for p in sorted(set(ps), reverse=True):
        least = min(least, p * genome / sum(x <= p for x in ps))
        q[p] = least
    got = {}
    for x in density.local_enrichment(t, genome, control if with_control else None, length, windows).collect():
        got |= {(x.chrom, i): (x.depth, x.background, x.pvalue, x.qvalue) for i in range(x.start, x.end)}
    assert set(got) == set(places)
    assert all(np.allclose(got[k], (*v, q[v[2]]), rtol=1e-9) for k, v in places.items())
    peaks = sorted(map(tuple, density.local_peaks(t, genome, control if with_control else None, 0.05, length, 30, windows).collect()))
    want = []
    for c in "ab":
        good = [x for (k, x), v in sorted(places.items()) if k == c and q[v[2]] <= 0.05]
        runs = []
        for x in good:
            if runs and x - runs[-1][1] <= 30:
                runs[-1][1] = x + 1
            else:
                runs.append([x, x + 1])
        want += [(c, a, b, max(places[c, x][0] for x in range(a, b) if (c, x) in places and q[places[c, x][2]] <= 0.05)) for a, b in runs if b - a >= length]
    assert [(p[0], p[1], p[2], p[4]) for p in peaks] == want and want
    assert all(p[1] <= p[3] < p[2] for p in peaks)


def test_broad_clusters(spark):
    (rows, t), (others, control) = tags(spark), tags(spark, 9, 300)
    size, window, shift = 9500, 501, 20
    low = lambda p, s: p + (shift if s == "+" else -shift) - window // 2 + 1 - window % 2
    s, c = (depths(x, size, low, lambda p, k: low(p, k) + window) for x in (rows, others))
    k, want = len(rows) / len(others), []
    for chrom in "ab":
        z = [(a - k * b) / math.sqrt(a + k * k * b) if a else 0.0 for a, b in zip(s[chrom].tolist(), c[chrom].tolist(), strict=True)]
        runs = [list(g) for high, g in itertools.groupby(range(size), lambda x: z[x] >= 1.0) if high]
        want += [(chrom, g[0], g[-1] + 1, max(z[x] for x in g)) for g in runs if max(z[x] for x in g) >= 2.5]
    got = sorted(map(tuple, density.broad_clusters(t, control, window, shift, 2.5, 1.0).collect()))
    assert [x[:3] for x in got] == [x[:3] for x in want] and want and np.allclose([x[3] for x in got], [x[3] for x in want])


def test_binding_positions(spark):
    rows, t = tags(spark)
    size, separation, half, distance = 9500, 150, 40, 200

    def maxima(rows):
        at = {}
        for c in "ab":
            side = {k: np.zeros(size, int) for k in ("fb", "fa", "ra", "rb")}
            for _, chrom, p, s in rows:
                if chrom == c:
                    for name, d in (("fb", separation // 2), ("fa", -(separation // 2))) if s == "+" else (("ra", -(separation // 2)), ("rb", separation // 2)):
                        side[name][max(p + d - half, 0) : max(p + d + half + 1, 0)] += 1
            score = 2 * np.sqrt(side["fb"] * side["ra"]) - side["fa"] - side["rb"]
            key = list(zip(*side.values(), strict=True))
            runs = [list(g) for _, g in itertools.groupby(range(size), lambda x: key[x])]
            cand = [((g[0] + g[-1]) // 2, score[g[0]]) for g in runs if side["fb"][g[0]] > 0 and side["ra"][g[0]] > 0 and score[g[0]] >= 1]
            for p, v in cand:
                if not any(abs(p - o) <= distance and (w > v or w == v and o < p) for o, w in cand):
                    at[c, p] = float(v)
        return at

    real = maxima(rows)
    draw = lambda i: int(hashlib.md5(f"1:{i}".encode()).hexdigest()[:12], 16) % 9000
    false = sorted(maxima([(i, c, draw(i), s) for i, c, _, s in rows]).values())
    rate = {v: sum(f >= v for f in false) / max(1, sum(x >= v for x in real.values())) for v in real.values()}
    cutoff = min(v for v, f in rate.items() if f <= 0.3)
    got = density.binding_positions(t, {"a": 9000, "b": 9000}, separation, half, distance, 0.3).collect()
    assert {(x.chrom, x.pos): (x.score, x.fdr) for x in got} == {k: (v, rate[v]) for k, v in real.items() if v >= cutoff}
    assert any(abs(x.pos - 2000) < 60 for x in got)
    assert density.separation_of(density.cross_correlation(t, 400, 10), 50) in range(100, 200)


# --- what lies in ranges


def test_totals_of_ranges(spark):
    r = random.Random(3)
    place = lambda: r.choice([r.randint(-300, 3000), r.randint(-5, 5), r.randint(0, 1 << 40), 1 << 60])
    ranges = [(i, r.choice("ab"), s := place(), s + r.choice([0, 0, 1, -1, -7, 5, 100, 3000, 1 << 33, 1 << 59])) for i in range(300)] + [(300, "a", None, 5), (301, None, 1, 5)]
    points = [(r.choice("ab"), place(), r.randint(0, 9), r.choice([None, 3, 8, 9])) for _ in range(400)] + [("a", None, 1, 9), (None, 3, 1, 9)]
    got = intervals.totals(frame(spark, ranges, "id long, chrom string, start long, end long"), frame(spark, points, "chrom string, pos long, n long, v long"), ["chrom"], ["n"], ["v"]).collect()
    want = {}
    for i, chrom, s, e in ranges:
        inside = [p for p in points if chrom and s is not None and p[0] == chrom and p[1] is not None and s <= p[1] <= e]
        want[i] = (sum(p[2] for p in inside), max((p[3] for p in inside if p[3] is not None), default=None))
    assert {x.id: (x.n, x.v) for x in got} == want and len(got) == len(ranges)


def rows_of_plan(df):
    """The most rows that any part of the plan that ran gives."""
    most, left = 0, [df._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            left.append(node.executedPlan())
            continue
        if kind.endswith("QueryStageExec"):
            left.append(node.plan())
            continue
        if node.metrics().contains("numOutputRows"):
            most = max(most, node.metrics().apply("numOutputRows").value())
        left += [node.children().apply(k) for k in range(node.children().size())]
    return most


def test_crowded_peaks_are_phased_without_their_pairs(spark):
    n = 2000
    peaks = spark.range(n).selectExpr("id", "'c' AS chrom", "1000 + id AS start", "6000 + id AS end")
    snps = spark.range(n).selectExpr("'c' AS chrom", "5000 AS pos", "id % 40 AS coverage", "CASE WHEN id % 40 = 39 THEN 'M' WHEN id % 2 = 0 THEN 'P' ELSE 'N' END AS allele")
    t = phasing.peak_phase(peaks, snps)
    assert {(x.phase, x.phased_snps) for x in t.collect()} == {("Mix", n // 2 + n // 40)} and rows_of_plan(t) <= 4 * n
    sinks = phasing.phased_peak_rows(peaks, phasing.peak_phase(peaks, snps))
    assert len(sinks.collect()) == 3 * n and rows_of_plan(sinks) <= 4 * n
    tied = frame(spark, [("c", 5000, 9, a) for a in "NMN"] + [("c", 5001, 9, "N")], "chrom string, pos long, coverage long, allele string")
    assert {(x.phase, x.phased_snps) for x in phasing.peak_phase(peaks.where("id < 9"), tied).collect()} == {("M", 1)}


def test_reads_of_crowded_regions_are_counted_without_their_pairs(spark):
    n = 2000
    regions = spark.range(n).selectExpr("id AS region_id", "'c' AS chrom", "1000 + id AS start", "6000 + id AS end")
    reads = spark.range(n).selectExpr("'c' AS rname", "5000 + id % 2 AS pos", "'ACGT' AS seq", "CAST(id % 4 AS INT) AS lane")
    t = alignments.count_regions(reads, regions, "lane", [0, 1, 7])
    got = {(x.region_id, x.lane): (x.records, x.bases) for x in t.collect()}
    assert got == {(k, lane): (n // 4, n) if lane < 7 else (0, 0) for k in range(n) for lane in (0, 1, 7)} and rows_of_plan(t) <= 6 * n
    assert alignments.count_regions(reads, regions.where("region_id = 5")).first().bases == 4 * n


def test_first_of_those_that_meet(spark):
    r = random.Random(5)
    place = lambda: r.choice([r.randint(-60, 400), r.randint(0, 1 << 22)])
    some = lambda n, longest: [(i, r.choice("ab"), s := place(), s + r.choice([0, 3, r.randint(0, longest)])) for i in range(n)]
    right, left = some(150, 300) + [(150, "a", 5, None)], some(300, 2000) + [(300, None, 1, 5), (301, "c", 1, 5), (302, "a", None, 5)]
    right.append((151, "b", 200_000, 3_900_000))
    of = "id long, chrom string, start long, end long"
    got = {x.id: x.v for x in intervals.first_met(frame(spark, left, of), frame(spark, right, of).withColumnRenamed("id", "v"), ["chrom"], "v").collect()}
    want = {}
    for i, chrom, s, e in left:
        meets = [(a, b, k) for k, c, a, b in right if c == chrom and s is not None and b is not None and s <= b and a <= e]
        want[i] = min(meets)[2] if meets else None
    assert got == want and sum(v is not None for v in want.values()) > 100


def test_crowded_peaks_name_their_first_side_without_pairs(spark):
    n = 2000
    peaks = spark.range(n).selectExpr("id", "'chr0' AS chrom", "1000 + id AS start", "6000 + id AS end", "CASE WHEN id = 0 THEN 'Mix' WHEN id % 2 = 1 THEN 'P' ELSE 'M' END AS phase")
    loops = spark.range(n).selectExpr("id AS loop_id", "'chr0' AS chrom", "4000 AS s1", "4100 + id AS e1", "6500 AS s2", "9000 + id AS e2", "3 AS n")
    t = phasing.loop_phase(loops, peaks)
    assert {(x["head"], x["tail"], x.phase) for x in t.collect()} == {("P", "M", "Crossed")} and t.count() == n
    assert rows_of_plan(t) <= 6 * n


def test_crowded_peaks_are_annotated_without_their_pairs(spark):
    n = 400
    peaks = spark.range(n).selectExpr("id", "'c' AS chrom", "1000 + id AS start", "1500 + id AS end")
    peaks = peaks.union(frame(spark, [(n, "c", 0, 1 << 24), (n + 1, "c", 1500, 1500), (n + 2, "c", 70_000, 69_000), (n + 3, "d", 0, 9)], peaks.schema))
    snps = spark.range(n).selectExpr("'c' AS chrom", "1450 + id % 100 AS pos", "concat('s|', id) AS name", "id % 3 AS p", "1 AS m", "CASE id % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'N' ELSE 'P' END AS allele")
    phases = peaks.selectExpr("id", "IF(id = 7, 'Unphased', 'Mix') AS phase", "2L AS phased_snps")
    t = phasing.peak_annotation(peaks, snps, phases)
    rows, points = t.collect(), sorted((1450 + i % 100, f"{1450 + i % 100},{'M P'[i % 3]},{i % 3}:1,s:{i}") for i in range(n) if i % 3 != 1)
    want = {}
    for x in peaks.where("id <> 7").collect():
        if lines := [line for pos, line in points if x.start <= pos <= x.end]:
            want[f"{x.chrom}:{x.start}-{x.end}"] = "|".join(lines)
    assert {x.place: x.snps for x in rows} == want and len(rows) == len(want) and {(x.phase, x.phased_snps) for x in rows} == {("Mix", 2)}
    assert rows_of_plan(t) <= 8 * n
