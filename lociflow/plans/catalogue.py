"""Queries over the proxy relations, and the same in plain SQL for an oracle.

The SQL is written apart from the operators: theta joins, windows over whole chromosomes, correlated subqueries."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociflow.functions.lineage import kept
from lociflow.functions.sequence import first_match, pileup_counts, reverse_complement
from lociflow.operators import alignments, density, intervals, linker, loops, pairs, pets, phasing, qc, reproducibility, significance, tagging
from lociflow.plans.proxies import relation, sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
LINKER = "GATCG"
CHROMS = ["chr0", "chr1", "chr2"]
REGIONS = ["chr1:1000001-2000000|chr1:1000001-2000000", "chr0|chr1", "chr2:3000000"]


def query(oracle: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


# --- shared inputs -------------------------------------------------------------------------------------------------


def _tags(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    return relation(spark, sf, "tags").where(F.col("kind") == kind).drop("kind")


def _pets(spark: SparkSession, sf: str) -> DataFrame:
    return relation(spark, sf, "pets")


def _usable(spark: SparkSession, sf: str) -> DataFrame:
    return pets.extend(_pets(spark, sf).where(pets.usable()))


def _loops(spark: SparkSession, sf: str, least: int = 2) -> DataFrame:
    return kept(loops.loops_of(pets.first_pass_clusters(_usable(spark, sf)), least))


def _half(spark: SparkSession, sf: str, k: int) -> DataFrame:
    return kept(loops.loops_of(pets.first_pass_clusters(_usable(spark, sf).where(F.col("pet_id") % 2 == k)), 1))


def _peaks(spark: SparkSession, sf: str, *kinds: str) -> DataFrame:
    return relation(spark, sf, "peaks").where(F.col("kind").isin(*kinds))


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.from_pets(_pets(spark, sf))


def _snps(spark: SparkSession, sf: str) -> DataFrame:
    return relation(spark, sf, "snps").select("chrom", "pos", (F.col("p") + F.col("m")).alias("coverage"), phasing.allele().alias("allele"))


# Usable tags with their windows, clipped as `extend` does.
_WINDOWS = """usable AS (SELECT *, greatest(pos - 250, 0) AS s1, endpos + 250 AS f1, greatest(mpos - 250, 0) AS t2, mendpos + 250 AS e2 FROM pets
  WHERE tid <> mtid OR abs((pos + endpos) // 2 - (mpos + mendpos) // 2) + 1 > 8000),
ext AS (SELECT * EXCLUDE (f1, t2), CASE WHEN tid = mtid THEN greatest(t2, s1) ELSE t2 END AS s2, CASE WHEN tid = mtid THEN least(f1, e2) ELSE f1 END AS e1 FROM usable)"""


def _clusters(source: str = "ext", suffix: str = "") -> str:
    x = suffix
    return f"""g1{x} AS (SELECT *, max(e1) OVER (PARTITION BY tid, mtid ORDER BY s1, e1 DESC, pet_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r1,
  max(e2) OVER (PARTITION BY tid, mtid ORDER BY s2, e2 DESC, pet_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r2 FROM {source}),
g2{x} AS (SELECT *, sum(CASE WHEN r1 IS NULL OR s1 > r1 THEN 1 ELSE 0 END) OVER (PARTITION BY tid, mtid ORDER BY s1, e1 DESC, pet_id)::BIGINT AS island1,
  sum(CASE WHEN r2 IS NULL OR s2 > r2 THEN 1 ELSE 0 END) OVER (PARTITION BY tid, mtid ORDER BY s2, e2 DESC, pet_id)::BIGINT AS island2 FROM g1{x}),
clusters{x} AS (SELECT tid, mtid, island1, island2, min(s1) AS s1, max(e1) AS e1, min(s2) AS s2, max(e2) AS e2, count(*) AS n FROM g2{x} GROUP BY ALL)"""


def _loop_sql(least: int = 2, suffix: str = "") -> str:
    return f"""loops{suffix} AS (SELECT row_number() OVER (ORDER BY tid, s1, e1, s2, e2, island1, island2) AS loop_id, 'chr' || tid AS chrom, s1, e1, s2, e2, n
  FROM clusters{suffix} WHERE tid = mtid AND n >= {least})"""


_LOOPS = f"WITH {sql('pets')}, {_WINDOWS}, {_clusters()}, {_loop_sql()}"
_ANCHORS = """anchors AS (SELECT loop_id, 1 AS side, chrom, s1 AS start, e1 AS "end", loop_id || '_1' AS anchor_id FROM loops
  UNION ALL SELECT loop_id, 2, chrom, s2, e2, loop_id || '_2' FROM loops)"""
_HALVES = f"WITH {sql('pets')}, {_WINDOWS}, x0 AS (SELECT * FROM ext WHERE pet_id % 2 = 0), x1 AS (SELECT * FROM ext WHERE pet_id % 2 = 1), {_clusters('x0', '_a')}, {_loop_sql(1, '_a')}, {_clusters('x1', '_b')}, {_loop_sql(1, '_b')}"
_SHARED = f"{_HALVES}, shared AS (SELECT a.loop_id AS loop_a, b.loop_id AS loop_b FROM loops_a a JOIN loops_b b ON a.chrom = b.chrom AND a.s1 < b.e1 AND b.s1 < a.e1 AND a.s2 < b.e2 AND b.s2 < a.e2)"
_PAIRS = f"""WITH {sql('pets')}, pairs AS (SELECT 'r' || pet_id AS read_id, 'chr' || tid AS chr1, pos AS pos1, 'chr' || mtid AS chr2, mpos AS pos2,
  CASE WHEN strand = 0 THEN '+' ELSE '-' END AS strand1, CASE WHEN mstrand = 0 THEN '+' ELSE '-' END AS strand2 FROM pets)"""
_TWO = f"""WITH {sql('tags')}, a AS (SELECT * FROM tags WHERE kind = 'click'), b AS (SELECT * FROM tags WHERE kind = 'purchase')"""
_SPAN = "greatest(endpos, mendpos) - least(pos, mpos) + 1"
_CLASS = f"CASE WHEN tid <> mtid THEN 'trans' WHEN {_SPAN} < 8000 THEN 'self' ELSE 'intra' END"
_CANON = """canon AS (SELECT pet_id, qual, CASE WHEN sw THEN mtid ELSE tid END AS tid, CASE WHEN sw THEN mpos ELSE pos END AS pos, CASE WHEN sw THEN mendpos ELSE endpos END AS endpos,
  CASE WHEN sw THEN tid ELSE mtid END AS mtid, CASE WHEN sw THEN pos ELSE mpos END AS mpos, CASE WHEN sw THEN endpos ELSE mendpos END AS mendpos,
  CASE WHEN sw THEN mstrand ELSE strand END AS strand, CASE WHEN sw THEN strand ELSE mstrand END AS mstrand
  FROM (SELECT *, (tid, pos, endpos) > (mtid, mpos, mendpos) AS sw FROM pets))"""
_KEYS = ", ".join(pets.DUPLICATE_KEYS)
_MERGED = """m1 AS (SELECT *, max("end") OVER (PARTITION BY chrom ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {t}),
m2 AS (SELECT *, sum(CASE WHEN reach IS NULL OR start > reach THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS g FROM m1),
merged AS (SELECT chrom, min(start) AS start, max("end") AS "end", count(*) AS n FROM m2 GROUP BY chrom, g)"""
_DEPTH = """ev AS (SELECT chrom, start AS pos, 1 AS d FROM {t} UNION ALL SELECT chrom, "end", -1 FROM {t}), st AS (SELECT chrom, pos, sum(d) AS d FROM ev GROUP BY ALL HAVING sum(d) <> 0),
runs AS (SELECT chrom, pos AS start, lead(pos) OVER (PARTITION BY chrom ORDER BY pos) AS "end", sum(d) OVER (PARTITION BY chrom ORDER BY pos)::BIGINT AS depth FROM st), cov AS (SELECT * FROM runs WHERE depth > 0)"""

# --- intervals -----------------------------------------------------------------------------------------------------


@query(f'{_TWO} SELECT id, chrom, start, "end" FROM a WHERE EXISTS (SELECT 1 FROM b WHERE a.chrom = b.chrom AND a.start < b."end" AND b.start < a."end")')
def interval_semi_join(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.semi_join(_tags(spark, sf, "click"), _tags(spark, sf, "purchase"), ["chrom"], "id")


@query(f'{_TWO} SELECT id, chrom, start, "end" FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE a.chrom = b.chrom AND a.start < b."end" AND b.start < a."end")')
def interval_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.anti_join(_tags(spark, sf, "click"), _tags(spark, sf, "purchase"), ["chrom"], "id")


@query(f'{_TWO} SELECT a.id AS a_id, b.id AS b_id, least(a."end", b."end") - greatest(a.start, b.start) AS bases FROM a JOIN b ON a.chrom = b.chrom AND a.start < b."end" AND b.start < a."end"')
def interval_inner_join(spark: SparkSession, sf: str) -> DataFrame:
    t = intervals.inner_join(_tags(spark, sf, "click"), _tags(spark, sf, "purchase"), ["chrom"])
    return t.select(F.col("l_id").alias("a_id"), F.col("r_id").alias("b_id"), (F.least("l_end", "r_end") - F.greatest("l_start", "r_start")).alias("bases"))


@query(f"WITH {sql('tags')}, {_MERGED.format(t='tags')} SELECT * FROM merged")
def interval_merge(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.merge(relation(spark, sf, "tags"), ["chrom"])


@query(f"WITH {sql('tags')}, {_DEPTH.format(t='tags')} SELECT * FROM cov")
def interval_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.coverage(relation(spark, sf, "tags"), ["chrom"])


# --- paired-end tags -----------------------------------------------------------------------------------------------


@query(f"WITH {sql('pets')}, {_CANON} SELECT * FROM canon")
def pet_canonicalise(spark: SparkSession, sf: str) -> DataFrame:
    return pets.canonicalise(_pets(spark, sf))


@query(f"WITH {sql('pets')}, {_CANON}, r AS (SELECT *, row_number() OVER (PARTITION BY {_KEYS} ORDER BY qual DESC, pet_id) AS k, count(*) OVER (PARTITION BY {_KEYS}) AS copies FROM canon) SELECT * EXCLUDE (k) FROM r WHERE k = 1")
def pet_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return pets.drop_duplicates(_pets(spark, sf))


@query(f"WITH {sql('pets')}, {_CANON}, u AS (SELECT {_KEYS}, count(*) AS c FROM canon GROUP BY ALL) SELECT sum(c)::BIGINT AS pets, count(*) AS unique_pets, (sum(c) - count(*)) / sum(c) AS redundancy FROM u")
def library_complexity(spark: SparkSession, sf: str) -> DataFrame:
    return pets.complexity(_pets(spark, sf))


@query(f"WITH {sql('pets')} SELECT {_CLASS} AS class, sum((qual >= 20)::INT)::BIGINT AS passed, sum((qual < 20)::INT)::BIGINT AS failed FROM pets GROUP BY 1")
def span_classes(spark: SparkSession, sf: str) -> DataFrame:
    return pets.span_classes(_pets(spark, sf))


_STRANDS = "CASE WHEN strand = 0 THEN '+' ELSE '-' END || CASE WHEN mstrand = 0 THEN '+' ELSE '-' END"


@query(f"WITH {sql('pets')} SELECT {_CLASS} AS class, {_STRANDS} AS orientation, count(*) AS n FROM pets GROUP BY 1, 2")
def orientation_counts(spark: SparkSession, sf: str) -> DataFrame:
    return pets.orientation_counts(_pets(spark, sf))


@query(
    f"""WITH {sql('pets')}, b AS (SELECT floor((abs({_SPAN}) - 1) / 100.0 + 0.5) AS p, {_STRANDS} AS o FROM pets WHERE tid = mtid)
SELECT CASE WHEN p < 0 THEN -1 WHEN p >= 1000 THEN 1000 ELSE p END::BIGINT AS bin, count(*) FILTER (o = '++') AS ff, count(*) FILTER (o = '+-') AS fr, count(*) FILTER (o = '-+') AS rf, count(*) FILTER (o = '--') AS rr FROM b GROUP BY 1"""
)
def span_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return pets.span_histogram(_pets(spark, sf))


@query(f"WITH {sql('pets')}, {_WINDOWS} SELECT pet_id, tid, s1, e1, mtid, s2, e2 FROM ext")
def pet_extend(spark: SparkSession, sf: str) -> DataFrame:
    return _usable(spark, sf).select("pet_id", "tid", "s1", "e1", "mtid", "s2", "e2")


@query(f"WITH {sql('pets')}, {_WINDOWS}, {_clusters()} SELECT * FROM clusters")
def cluster_first_pass(spark: SparkSession, sf: str) -> DataFrame:
    return pets.first_pass_clusters(_usable(spark, sf))


@query()
def cluster_refined(spark: SparkSession, sf: str) -> DataFrame:
    return pets.refined_clusters(_usable(spark, sf))


@query(f"WITH {sql('pets')}, {_WINDOWS}, {_clusters()} SELECT CASE WHEN tid = mtid THEN 'cis' ELSE 'trans' END AS class, CASE WHEN n > 10 THEN '>10' ELSE n::VARCHAR END AS size, count(*) AS clusters, sum(n)::BIGINT AS pets FROM clusters GROUP BY 1, 2")
def loop_spectrum(spark: SparkSession, sf: str) -> DataFrame:
    return pets.spectrum(pets.first_pass_clusters(_usable(spark, sf)))


_STATE = "CASE WHEN {q} >= 40 THEN 'U' WHEN {q} >= 20 THEN 'R' ELSE 'N' END"


@query(f"WITH {sql('pets')} SELECT {_STATE.format(q='qual')} AS state1, {_STATE.format(q='(qual + pet_id % 3 * 10)')} AS state2, count(*) AS n FROM pets GROUP BY 1, 2")
def pair_state_matrix(spark: SparkSession, sf: str) -> DataFrame:
    state = lambda q: F.when(q >= 40, "U").when(q >= 20, "R").otherwise("N")
    t = _pets(spark, sf)
    return pets.pair_states(t.select(state(F.col("qual")).alias("state1"), state(F.col("qual") + F.col("pet_id") % 3 * 10).alias("state2")))


# --- loops ---------------------------------------------------------------------------------------------------------


@query(f"{_LOOPS} SELECT * FROM loops WHERE n >= 3")
def loop_min_count(spark: SparkSession, sf: str) -> DataFrame:
    return loops.min_count(_loops(spark, sf))


@query(f"{_LOOPS} SELECT * FROM loops WHERE abs((s2 + e2) / 2.0 - (s1 + e1) / 2.0) >= 15000")
def loop_span_filter(spark: SparkSession, sf: str) -> DataFrame:
    return loops.min_span(_loops(spark, sf), 15_000)


@query(f"{_LOOPS}, {_ANCHORS} SELECT * FROM anchors")
def loop_anchors(spark: SparkSession, sf: str) -> DataFrame:
    return loops.anchors(_loops(spark, sf))


@query(f'{_LOOPS} SELECT loop_id, chrom, (s1 + e1) // 2 AS start, (s2 + e2) // 2 AS "end", n FROM loops')
def loop_midpoints(spark: SparkSession, sf: str) -> DataFrame:
    return loops.midpoints(_loops(spark, sf))


@query(
    f"""{_LOOPS}, m AS (SELECT *, (s1 + e1) // 2 AS a, (s2 + e2) // 2 AS b FROM loops), r AS (SELECT chrom, a, b, loop_id * 2 - 1 AS id, n FROM m UNION ALL SELECT chrom, b, a, loop_id * 2, n FROM m)
SELECT chrom, a - 100 AS start, a + 100 AS "end", chrom || ':' || (b - 100) || '-' || (b + 100) || ',' || n AS partner, id FROM r"""
)
def browser_rows(spark: SparkSession, sf: str) -> DataFrame:
    return loops.browser_rows(_loops(spark, sf))


_OVER = 'x.chrom = k.chrom AND x.start < k."end" AND k.start < x."end"'


@query(f"{_LOOPS}, {_ANCHORS}, {sql('peaks')} SELECT l.*, (SELECT count(*) FROM anchors x WHERE x.loop_id = l.loop_id AND EXISTS (SELECT 1 FROM peaks k WHERE {_OVER})) AS peak_support FROM loops l")
def anchor_peak_support(spark: SparkSession, sf: str) -> DataFrame:
    return loops.peak_support(_loops(spark, sf), relation(spark, sf, "peaks"))


@query(
    f"""{_LOOPS}, {_ANCHORS}, {sql('peaks')}, f AS (SELECT x.loop_id, x.side, EXISTS (SELECT 1 FROM peaks k WHERE k.kind IN ('click', 'view') AND {_OVER}) AS e,
  EXISTS (SELECT 1 FROM peaks k WHERE k.kind IN ('purchase', 'signup') AND {_OVER}) AS p FROM anchors x),
g AS (SELECT a.loop_id, CASE WHEN a.p AND b.p THEN 'PP' WHEN a.e AND b.p THEN 'EP' WHEN a.p AND b.e THEN 'PE' END AS class FROM f a JOIN f b ON a.loop_id = b.loop_id AND a.side = 1 AND b.side = 2)
SELECT * FROM g WHERE class IS NOT NULL"""
)
def ep_annotation(spark: SparkSession, sf: str) -> DataFrame:
    return loops.regulatory_class(_loops(spark, sf), _peaks(spark, sf, "click", "view"), _peaks(spark, sf, "purchase", "signup"))


@query(f"{_SHARED} SELECT * FROM shared")
def replicate_loops(spark: SparkSession, sf: str) -> DataFrame:
    return loops.shared_loops(_half(spark, sf, 0), _half(spark, sf, 1))


@query(f"{_SHARED} SELECT count(*) AS pairs, least(count(DISTINCT loop_a), count(DISTINCT loop_b)) AS unique_loops FROM shared")
def replicate_summary(spark: SparkSession, sf: str) -> DataFrame:
    return loops.shared_summary(_half(spark, sf, 0), _half(spark, sf, 1))


@query(f'{_LOOPS}, {_ANCHORS}, {sql("peaks")} SELECT x.anchor_id, (SELECT k.id FROM peaks k WHERE x.chrom = k.chrom AND x.start <= k."end" AND k.start <= x."end" ORDER BY k.start, k."end", k.id LIMIT 1) AS peak_id FROM anchors x')
def first_overlapping_peak(spark: SparkSession, sf: str) -> DataFrame:
    return loops.first_peak(_loops(spark, sf), relation(spark, sf, "peaks"))


@query(f'{_LOOPS}, {_ANCHORS}, {sql("peaks")}, {_DEPTH.format(t="peaks")} SELECT x.anchor_id, coalesce((SELECT max(depth) FROM cov k WHERE {_OVER}), 0)::BIGINT AS height FROM anchors x')
def anchor_max_height(spark: SparkSession, sf: str) -> DataFrame:
    return loops.anchor_heights(_loops(spark, sf), relation(spark, sf, "peaks"))


_CUTOFF = "cut AS (SELECT coalesce((SELECT n FROM (SELECT n, row_number() OVER (ORDER BY n) AS k, floor(count(*) OVER () * 0.67) AS r FROM loops) WHERE k = r), 0) AS cutoff)"


@query(f"{_LOOPS}, {_CUTOFF} SELECT cutoff FROM cut")
def ccd_cutoff(spark: SparkSession, sf: str) -> DataFrame:
    return loops.rank_cutoff(_loops(spark, sf))


@query(f'{_LOOPS}, {_CUTOFF}, w AS (SELECT chrom, (s1 + e1) // 2 AS start, (s2 + e2) // 2 AS "end" FROM loops, cut WHERE n >= cutoff), {_MERGED.format(t="w")} SELECT *, "end" - start AS span FROM merged WHERE "end" - start > 15000')
def domain_call(spark: SparkSession, sf: str) -> DataFrame:
    return loops.domains(_loops(spark, sf), least=15_000)


@query(
    f"""{_LOOPS}, {_ANCHORS}, {sql('peaks')}, {_DEPTH.format(t='peaks')},
h AS (SELECT x.anchor_id, k.depth, greatest(x.start, k.start) AS s, least(x."end", k."end") AS e, (x.start + x."end") / 2.0 AS mid FROM anchors x JOIN cov k ON {_OVER})
SELECT anchor_id, s AS start, greatest(e, s + 1) AS "end" FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY depth DESC, abs((s + e) / 2.0 - mid), s) AS k FROM h) WHERE k = 1"""
)
def anchor_adjust(spark: SparkSession, sf: str) -> DataFrame:
    return alignments.adjust_anchors(loops.anchors(_loops(spark, sf)), intervals.coverage(relation(spark, sf, "peaks"), ["chrom"]))


# --- pairs ---------------------------------------------------------------------------------------------------------


@query(f"{_PAIRS} SELECT * FROM pairs WHERE chr1 = 'chr1' AND chr2 = 'chr1' AND pos1 BETWEEN 1000000 AND 1500000 AND pos2 BETWEEN 1000000 AND 1500000")
def region_1d(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.query(_pairs(spark, sf), "chr1:1,000,000-1,500,000")


@query(f"{_PAIRS} SELECT * FROM pairs WHERE chr1 = 'chr2' AND chr2 = 'chr2' AND pos1 BETWEEN 500000 AND 2500000 AND pos2 >= 510000")
def region_2d(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.query(_pairs(spark, sf), "chr2:500000-2500000|chr2:510000")


@query(f"{_PAIRS} SELECT * FROM pairs WHERE chr2 = 'chr3' AND pos2 BETWEEN 1 AND 3000000")
def region_wildcard(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.query(_pairs(spark, sf), "*|chr3:1-3000000")


@query(f"{_PAIRS} SELECT * FROM pairs WHERE chr1 = 'chr0' AND chr2 = 'chr1' AND pos2 BETWEEN 1 AND 4000000")
def region_autoflip(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.query(_pairs(spark, sf), "chr1:1-4000000|chr0", flip=True)


@query(
    f"""{_PAIRS} SELECT *, 0 AS query FROM pairs WHERE chr1 = 'chr1' AND chr2 = 'chr1' AND pos1 BETWEEN 1000001 AND 2000000 AND pos2 BETWEEN 1000001 AND 2000000
UNION ALL SELECT *, 1 FROM pairs WHERE chr1 = 'chr0' AND chr2 = 'chr1' UNION ALL SELECT *, 2 FROM pairs WHERE chr1 = 'chr2' AND chr2 = 'chr2' AND pos1 >= 3000000 AND pos2 >= 3000000"""
)
def region_list(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.query_list(_pairs(spark, sf), REGIONS)


_ORD = "list_position(['chr0', 'chr1', 'chr2'], {c})"


@query(
    f"""{_PAIRS}, o AS (SELECT *, {_ORD.format(c='chr1')} AS a, {_ORD.format(c='chr2')} AS b FROM pairs), s AS (SELECT *, a > b OR (a = b AND pos1 > pos2) AS sw FROM o WHERE a > 0 AND b > 0)
SELECT read_id, CASE WHEN sw THEN chr2 ELSE chr1 END AS chr1, CASE WHEN sw THEN pos2 ELSE pos1 END AS pos1, CASE WHEN sw THEN chr1 ELSE chr2 END AS chr2, CASE WHEN sw THEN pos1 ELSE pos2 END AS pos2,
CASE WHEN sw THEN strand2 ELSE strand1 END AS strand1, CASE WHEN sw THEN strand1 ELSE strand2 END AS strand2 FROM s"""
)
def pairs_upper_triangle(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.upper_triangle(_pairs(spark, sf), CHROMS)


@query(f"{_PAIRS} SELECT * FROM pairs WHERE chr1 = chr2 OR chr2 = 'chr1'")
def pairs_merge_sorted(spark: SparkSession, sf: str) -> DataFrame:
    t = _pairs(spark, sf)
    return pairs.merge(t.where("chr1 = chr2"), t.where("chr1 <> chr2 AND chr2 = 'chr1'"))


@query(f"{_PAIRS}, {sql('sites')} SELECT p.*, (SELECT count(*) FROM sites WHERE site <= pos1) AS fragment FROM pairs p")
def fragment_assign(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.fragments(_pairs(spark, sf), relation(spark, sf, "sites"))


@query(f"{_PAIRS} SELECT r AS resolution, chr1, pos1 // r AS bin1, chr2, pos2 // r AS bin2, count(*) AS n FROM pairs, (VALUES (100000), (500000), (1000000)) v(r) GROUP BY ALL")
def contact_bins(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.contact_bins(_pairs(spark, sf))


@query(f"{_PAIRS}, b AS (SELECT DISTINCT chr1, chr2 FROM pairs WHERE chr1 <> chr2) SELECT count(*) = 0 AS triangle FROM b x JOIN b y ON x.chr1 = y.chr2 AND x.chr2 = y.chr1")
def triangle_check(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.is_triangle(_pairs(spark, sf))


@query(f"{_PAIRS} SELECT chr1, chr2, count(*) AS n FROM pairs GROUP BY ALL")
def block_list(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.block_list(_pairs(spark, sf))


# --- quality tables ------------------------------------------------------------------------------------------------


@query(f"WITH {sql('pets')}, m AS (SELECT 'lib' || (pet_id % 3) AS lib, {_CLASS} AS metric, count(*) AS c FROM pets GROUP BY ALL) SELECT metric, sum(c) FILTER (lib = 'lib0')::BIGINT AS lib0, sum(c) FILTER (lib = 'lib1')::BIGINT AS lib1, sum(c) FILTER (lib = 'lib2')::BIGINT AS lib2 FROM m GROUP BY 1")
def qc_pivot(spark: SparkSession, sf: str) -> DataFrame:
    t = _pets(spark, sf).groupBy(F.concat(F.lit("lib"), F.col("pet_id") % 3).alias("library"), pets.ligation_class().alias("metric")).agg(F.count(F.lit(1)).alias("value"))
    return qc.pivot(t, ["lib0", "lib1", "lib2"])


@query(f"WITH {sql('pets')}, c AS (SELECT pet_id % 3 AS library, count(*) AS pets, count(*) FILTER ({_CLASS} = 'self') AS self, count(*) FILTER (tid <> mtid) AS trans FROM pets GROUP BY 1) SELECT *, round(self / pets, 4) AS self_share, round(trans / pets, 4) AS trans_share FROM c")
def qc_ratios(spark: SparkSession, sf: str) -> DataFrame:
    kind = pets.ligation_class()
    t = _pets(spark, sf).groupBy((F.col("pet_id") % 3).alias("library")).agg(F.count(F.lit(1)).alias("pets"), *(F.count_if(kind == k).alias(k) for k in ("self", "trans")))
    return qc.ratios(t, "pets", ["self", "trans"])


# --- linkers -------------------------------------------------------------------------------------------------------

_READS = f"WITH {sql('reads')}"
_MATE = f"{_READS}, mates AS (SELECT read_id // 2 AS pair_id, max(seq) FILTER (read_id % 2 = 0) AS seq1, max(seq) FILTER (read_id % 2 = 1) AS seq2 FROM reads GROUP BY 1 HAVING count(*) = 2)"
_SIDES = f"{_MATE}, sides AS (SELECT pair_id, 1 AS side, seq1 AS seq FROM mates UNION ALL SELECT pair_id, 2, seq2 FROM mates)"
FUZZY = "GATCGATCGATC"


@query(f"{_READS} SELECT read_id, reverse(translate(seq, 'ACGT', 'TGCA')) AS revcomp FROM reads")
def revcomp(spark: SparkSession, sf: str) -> DataFrame:
    return relation(spark, sf, "reads").select("read_id", reverse_complement(F.col("seq")).alias("revcomp"))


@query(f"{_READS}, a AS (SELECT *, instr(seq, '{LINKER}') AS pl FROM reads), b AS (SELECT read_id, CASE WHEN pl > 0 THEN pl - 1 ELSE length(seq) END AS l, CASE WHEN pl > 0 THEN length(seq) - pl + 1 - 5 ELSE 0 END AS r FROM a) SELECT read_id, l AS \"left\", r AS \"right\", (l >= 18)::INT + (r >= 18)::INT AS tags FROM b")
def tag_lengths(spark: SparkSession, sf: str) -> DataFrame:
    return linker.tag_lengths(relation(spark, sf, "reads"), LINKER)


@query(f"{_READS} SELECT read_id, (SELECT min(i) - 1 FROM range(1, length(seq) - 6) t(i) WHERE hamming(substr(seq, i, 8), 'GATCGATC') <= 1) AS place FROM reads WHERE length(seq) >= 8 UNION ALL SELECT read_id, NULL FROM reads WHERE length(seq) < 8")
def fuzzy_linker(spark: SparkSession, sf: str) -> DataFrame:
    return relation(spark, sf, "reads").select("read_id", first_match(F.col("seq"), "GATCGATC", 1).alias("place"))


# An exact copy of the linker comes first, wherever it is; only without one, one of at most two other letters.
_FIRST = "coalesce(nullif(position('" + FUZZY + "' IN {s}), 0), (SELECT min(i) FROM range(1, length({s}) - 10) t(i) WHERE hamming(substr({s}, i, 12), '" + FUZZY + "') <= 2))"


@query(
    f"""{_MATE}, a AS (SELECT *, CASE WHEN length(seq1) >= 12 THEN {_FIRST.format(s='seq1')} END AS a1, CASE WHEN length(seq2) >= 12 THEN {_FIRST.format(s='seq2')} END AS a2 FROM mates),
b AS (SELECT pair_id, (a1 > 0 IS TRUE)::INT + (a2 > 0 IS TRUE)::INT AS linkers, ((CASE WHEN a1 > 0 THEN greatest(a1 - 1, 1) ELSE length(seq1) END) >= 18)::INT + ((CASE WHEN a2 > 0 THEN greatest(a2 - 1, 1) ELSE length(seq2) END) >= 18)::INT AS tags FROM a)
SELECT *, CASE WHEN linkers = 0 THEN 'none' WHEN linkers = 2 OR tags = 0 THEN 'conflict' WHEN tags = 1 THEN 'one_tag' ELSE 'two_tag' END AS route FROM b"""
)
def linker_route(spark: SparkSession, sf: str) -> DataFrame:
    return linker.route(_mates(spark, sf), FUZZY, 2).drop("seq1", "seq2")


def _mates(spark: SparkSession, sf: str) -> DataFrame:
    t = relation(spark, sf, "reads").select(F.floor(F.col("read_id") / 2).alias("pair_id"), (F.col("read_id") % 2).alias("k"), "seq")
    return t.groupBy("pair_id").agg(F.count(F.lit(1)).alias("c"), *(F.max(F.when(F.col("k") == k, F.col("seq"))).alias(f"seq{k + 1}") for k in (0, 1))).where("c = 2").drop("c")


def _sides(spark: SparkSession, sf: str) -> DataFrame:
    """pair_id, side, seq of both reads of each pair."""
    side = lambda k: F.struct(F.lit(k).alias("side"), F.col(f"seq{k}").alias("seq"))
    return _mates(spark, sf).select("pair_id", F.inline(F.array(side(1), side(2))))


@query()
def linker_align(spark: SparkSession, sf: str) -> DataFrame:
    return linker.align(_sides(spark, sf), "GTTGGATAAGATATCGC", 9)


@query(f"{_SIDES} SELECT pair_id, side, CASE WHEN instr(seq, '{LINKER}') = 0 THEN seq WHEN instr(seq, '{LINKER}') = 1 THEN 'A' ELSE substr(seq, 1, instr(seq, '{LINKER}') - 1) END AS tag FROM sides")
def linker_split(spark: SparkSession, sf: str) -> DataFrame:
    return _sides(spark, sf).select("pair_id", "side", linker.tag_before(F.col("seq"), LINKER, 0).alias("tag"))


# Reads located by exact search: the first of these linkers wins, equal places tie.
_KINDS = {"S": "GATCCA", "rcS": "TGGATC"}
_DI = {"AA": "GATCGATC", "AB": "GATCCATG", "BB": "CATGCATG", "BA": "CATGGATC", "A": "GATCA", "B": "CATGA"}


def _exact(spark: SparkSession, sf: str, kinds: dict[str, str]) -> DataFrame:
    t = _sides(spark, sf).withColumns({f"_{k}": F.nullif(F.instr("seq", s), F.lit(0)) for k, s in kinds.items()})
    first = F.least(*(F.col(f"_{k}") for k in kinds))
    hits = sum((F.coalesce((F.col(f"_{k}") == F.col("_at")).cast("int"), F.lit(0)) for k in kinds), F.lit(0))
    name = F.coalesce(*(F.when(F.col(f"_{k}") == F.col("_at"), F.lit(k)) for k in kinds), F.lit("none"))
    size = F.coalesce(*(F.when(F.col(f"_{k}") == F.col("_at"), F.lit(len(s))) for k, s in kinds.items()))
    t = t.withColumn("_at", first).withColumns({"linker": name, "tied": hits > 1, "begin": F.col("_at") - 1, "end": F.col("_at") - 1 + size, "length": F.length("seq")})
    return tagging.with_tags(t.select("pair_id", "side", "length", "linker", "tied", "begin", "end"))


def _exact_sql(kinds: dict[str, str]) -> str:
    places = ", ".join(f"nullif(instr(seq, '{s}'), 0) AS p{k}" for k, s in kinds.items())
    names = " ".join(f"WHEN p{k} = spot THEN '{k}'" for k in kinds)
    sizes = " ".join(f"WHEN p{k} = spot THEN {len(s)}" for k, s in kinds.items())
    hits = " + ".join(f"(p{k} = spot IS TRUE)::INT" for k in kinds)
    return f"""{_SIDES}, e1 AS (SELECT *, {places} FROM sides), e2 AS (SELECT *, least({', '.join(f'p{k}' for k in kinds)}) AS spot FROM e1),
e3 AS (SELECT pair_id, side, length(seq) AS length, CASE {names} ELSE 'none' END AS linker, {hits} > 1 AS tied, spot - 1 AS b, spot - 1 + CASE {sizes} END AS e FROM e2),
located AS (SELECT *, CASE WHEN linker = 'none' OR tied THEN length ELSE b END AS t1, CASE WHEN linker = 'none' OR tied THEN 0 ELSE greatest(length - e, 0) END AS t2 FROM e3),
two AS (SELECT x.pair_id, x.linker AS l1, y.linker AS l2, x.tied OR y.tied AS tied, x.t1 AS a1, x.t2 AS a2, y.t1 AS b1, y.t2 AS b2,
  CASE WHEN (x.t1 >= 18 OR y.t2 >= 18) AND (y.t1 >= 18 OR x.t2 >= 18) THEN 'two_tag' ELSE 'one_tag' END AS tags FROM located x JOIN located y ON x.pair_id = y.pair_id AND x.side = 1 AND y.side = 2)"""


_COLUMNS = "l1 AS linker_1, l2 AS linker_2, a1 AS tag1_1, a2 AS tag2_1, b1 AS tag1_2, b2 AS tag2_2"


@query(
    f"""{_exact_sql(_KINDS)}, f AS (SELECT *, CASE WHEN tied THEN 'tied' WHEN l1 = 'none' THEN l2 WHEN l2 = 'none' OR l1 <> l2 THEN l1 END AS final FROM two)
SELECT pair_id, coalesce(final, 'none') AS final_linker, CASE WHEN final IS NULL THEN 'conflict' WHEN final IN ('tied', 'none') THEN final ELSE tags END AS class, {_COLUMNS} FROM f"""
)
def linker_pair_class(spark: SparkSession, sf: str) -> DataFrame:
    return tagging.pair_class(_exact(spark, sf, _KINDS))


@query(
    f"""{_exact_sql(_DI)}, f AS (SELECT *, CASE WHEN tied THEN 'tied' WHEN l1 = 'none' THEN l2 WHEN l2 = 'none' THEN l1
  WHEN length(l1) = 2 AND length(l2) = 2 THEN CASE WHEN l1 = reverse(l2) THEN l1 END
  WHEN length(l1) = 2 THEN CASE WHEN right(l1, 1) = l2 THEN l1 END WHEN length(l2) = 2 THEN CASE WHEN right(l2, 1) = l1 THEN l2 END WHEN l1 = l2 THEN l1 || l2 END AS final FROM two)
SELECT pair_id, coalesce(final, 'none') AS final_linker, CASE WHEN final IS NULL THEN 'conflict' WHEN final IN ('tied', 'none') THEN final WHEN length(final) = 1 THEN 'half'
  WHEN final IN ('AB', 'BA') THEN 'full_mixed_' || tags ELSE 'full_same_' || tags END AS class, {_COLUMNS} FROM f"""
)
def linker_di_class(spark: SparkSession, sf: str) -> DataFrame:
    return tagging.di_pair_class(_exact(spark, sf, _DI))


@query(f"{_exact_sql(_KINDS)}, m AS (SELECT linker, unnest(['begin', 'tag1', 'tag2']) AS measure, unnest([b, t1, t2]) AS value FROM located) SELECT linker, measure, value, count(*) AS n FROM m WHERE value IS NOT NULL GROUP BY ALL")
def linker_positions(spark: SparkSession, sf: str) -> DataFrame:
    return tagging.positions(_exact(spark, sf, _KINDS))


@query(
    f"""{_exact_sql(_KINDS)}, t AS (SELECT l.pair_id, l.side, unnest([1, 2]) AS tag, unnest([substr(s.seq, 1, t1), CASE WHEN t2 > 0 THEN substr(s.seq, e + 1, t2) ELSE '' END]) AS seq
FROM located l JOIN sides s USING (pair_id, side)) SELECT * FROM t WHERE length(seq) >= 18"""
)
def linker_tag_reads(spark: SparkSession, sf: str) -> DataFrame:
    return tagging.tag_reads(_sides(spark, sf), _exact(spark, sf, _KINDS))


@query()
def linker_single(spark: SparkSession, sf: str) -> DataFrame:
    return tagging.pair_class(tagging.with_tags(tagging.single_linker(_sides(spark, sf), "ACGCGATATCTTATCTGACT")))


@query()
def linker_di(spark: SparkSession, sf: str) -> DataFrame:
    return tagging.di_pair_class(tagging.with_tags(tagging.di_linker(_sides(spark, sf), "GTTGGATAAGATATCGC", "GTTGGAATGTATATCGC")))


@query()
def linker_mate_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return tagging.di_pair_class(tagging.with_tags(tagging.di_linker(_sides(spark, sf), "CTGTCTCTTATACACATCT")))


@query()
def adapter_route(spark: SparkSession, sf: str) -> DataFrame:
    t = _sides(spark, sf).withColumn("qual", F.regexp_replace("seq", "[ACGT]", "I"))
    return tagging.trim_adapters(t, "CTGTCTCTTATACACATCTCCGAGCCCACGAGAC", "CTGTCTCTTATACACATCTGACGCTGCCGACGA").select("pair_id", "side", F.length("seq").alias("length"), "route")


# --- alignments ----------------------------------------------------------------------------------------------------

_ALIGNED = f"WITH {sql('alignments')}"


def _aligned(spark: SparkSession, sf: str) -> DataFrame:
    return relation(spark, sf, "alignments")


@query(f"{_ALIGNED} SELECT count(*) AS records, " + ", ".join(f"sum((flag & {b} <> 0)::INT)::BIGINT AS {k}" for k, b in (("paired", 1), ("proper", 2), ("unmapped", 4), ("reverse", 16), ("secondary", 256), ("duplicate", 1024))) + " FROM alignments")
def flag_summary(spark: SparkSession, sf: str) -> DataFrame:
    return alignments.flag_summary(_aligned(spark, sf))


@query(f"{_ALIGNED} SELECT id, rname, pos, CASE cigar WHEN '5M2D7M' THEN 14 WHEN '4M1I7M' THEN 11 WHEN '3S9M' THEN 9 ELSE 12 END AS bases FROM alignments WHERE flag & 16 = 16 AND flag & 1028 = 0 AND mapq >= 10 AND rname = 'chr1' AND pos <= 2000000 AND pos + CASE cigar WHEN '5M2D7M' THEN 14 WHEN '4M1I7M' THEN 11 WHEN '3S9M' THEN 9 ELSE 12 END > 500000")
def alignment_scan(spark: SparkSession, sf: str) -> DataFrame:
    from lociflow.functions.sequence import reference_length

    t = alignments.scan(_aligned(spark, sf), ("chr1", 500_000, 2_000_000), require=16, exclude=1028, min_mapq=10)
    return t.select("id", "rname", "pos", reference_length(F.col("cigar")).alias("bases"))


@query(f"{_ALIGNED} SELECT id, CASE WHEN flag & 4 <> 0 THEN 'unmapped' ELSE state END AS mapping FROM alignments")
def mapping_state(spark: SparkSession, sf: str) -> DataFrame:
    return _aligned(spark, sf).select("id", alignments.mapping_state(F.col("state")).alias("mapping"))


@query(f"{_ALIGNED} SELECT id FROM alignments WHERE (rnext = '=' OR rnext = rname) AND abs(pos - pnext) <= 8000")
def self_ligations(spark: SparkSession, sf: str) -> DataFrame:
    return alignments.self_ligations(_aligned(spark, sf)).select("id")


@query(
    f"""{_ALIGNED}, {sql('peaks')}, f AS (SELECT id AS region_id, chrom, start, "end", unnest([0, 1, 2]) AS lane FROM peaks), a AS (SELECT *, id % 3 AS lane FROM alignments)
SELECT f.region_id, f.lane, count(a.id) AS records, coalesce(sum(length(a.seq)), 0)::BIGINT AS bases FROM f LEFT JOIN a ON a.rname = f.chrom AND a.pos > f.start AND a.pos <= f."end" AND a.lane = f.lane GROUP BY ALL"""
)
def count_regions(spark: SparkSession, sf: str) -> DataFrame:
    reads = _aligned(spark, sf).withColumn("lane", (F.col("id") % 3).cast("int"))
    return alignments.count_regions(reads, relation(spark, sf, "peaks").withColumnRenamed("id", "region_id"), "lane", [0, 1, 2])


@query(f"{_ALIGNED}, r AS (SELECT qname, dense_rank() OVER (PARTITION BY qname ORDER BY mapq DESC) AS k FROM alignments) SELECT qname, count(*) FILTER (k = 1) AS x0, count(*) FILTER (k = 2) AS x1 FROM r GROUP BY 1")
def hit_counts(spark: SparkSession, sf: str) -> DataFrame:
    return alignments.hit_counts(_aligned(spark, sf).withColumnRenamed("mapq", "score"))


@query(f"{_ALIGNED}, h AS (SELECT id, id % 2 AS x0, mapped AS x1, mapq AS y0, mapq - line AS y1 FROM alignments) SELECT id, x0 = 1 AND x1 <= 10 AS aln, x0 = 1 AND (x1 <= 10 OR y1 <= 0 OR (CASE WHEN y0 <> 0 THEN y1 / y0 END > 0.95) IS TRUE) AS mem FROM h")
def unique_locus(spark: SparkSession, sf: str) -> DataFrame:
    t = _aligned(spark, sf).select("id", (F.col("id") % 2).alias("x0"), F.col("mapped").alias("x1"), F.col("mapq").alias("y0"), (F.col("mapq") - F.col("line")).alias("y1"))
    return t.select("id", alignments.unique_locus("aln").alias("aln"), F.coalesce(alignments.unique_locus("mem"), F.lit(False)).alias("mem"))


_STATES = """w AS (SELECT pair_id, """ + ", ".join(f"max({c}) FILTER (read = {r} AND tag = {k}) AS {c}{r}{k}" for r in (1, 2) for k in (1, 2) for c in ("state", "rname")) + " FROM alignments GROUP BY 1)"
_PICK = "CASE WHEN {a} = 'U' OR {b} = 'U' THEN 'U' WHEN {a} = 'R' OR {b} = 'R' THEN 'R' ELSE coalesce({a}, {b}, '.') END"


@query(
    f"""{_ALIGNED}, {_STATES}, p AS (SELECT pair_id, {_PICK.format(a='state11', b='state22')} AS anchor1, {_PICK.format(a='state21', b='state12')} AS anchor2,
  ((state11 = 'U' AND state22 = 'U' AND rname11 <> rname22) OR (state21 = 'U' AND state12 = 'U' AND rname21 <> rname12)) IS TRUE AS torn FROM w)
SELECT pair_id, anchor1, anchor2, CASE WHEN torn THEN 'discordant' WHEN anchor1 = 'U' AND anchor2 = 'U' THEN 'UU' WHEN anchor1 = 'U' OR anchor2 = 'U' THEN 'UxxU' WHEN anchor1 = 'N' AND anchor2 = 'N' THEN 'nn' ELSE 'xx' END AS class FROM p"""
)
def pair_tags(spark: SparkSession, sf: str) -> DataFrame:
    return alignments.pair_tags(_aligned(spark, sf))


@query(
    f"""{_ALIGNED}, t AS (SELECT *, CASE WHEN (read = 1) = (tag = 1) THEN 1 ELSE 2 END AS anchor FROM alignments),
r AS (SELECT *, row_number() OVER (PARTITION BY pair_id, anchor ORDER BY CASE state WHEN 'U' THEN 0 WHEN 'R' THEN 1 ELSE 2 END, mapped DESC, read = anchor DESC, rname DESC) AS k,
  CASE WHEN state = 'U' THEN rname END AS place FROM t), d AS (SELECT pair_id, anchor, count(DISTINCT place) > 1 AS discordant FROM r GROUP BY 1, 2)
SELECT pair_id, anchor, read, tag, state, rname, mapped, discordant FROM r JOIN d USING (pair_id, anchor) WHERE k = 1"""
)
def longer_tag(spark: SparkSession, sf: str) -> DataFrame:
    return pets.longer_tag(_aligned(spark, sf))


# The operations of the proxy's four CIGARs, with where each begins on the read and on the reference.
_PILE = f"""{_ALIGNED}, ops(cigar, op, len, q, r) AS (VALUES ('12M', 'M', 12, 1, 0), ('5M2D7M', 'M', 5, 1, 0), ('5M2D7M', 'D', 2, 6, 5), ('5M2D7M', 'M', 7, 6, 7), ('4M1I7M', 'M', 4, 1, 0), ('4M1I7M', 'I', 1, 5, 4), ('4M1I7M', 'M', 7, 6, 4), ('3S9M', 'M', 9, 4, 0)),
pile AS (SELECT rname, CASE WHEN flag & 16 <> 0 THEN '-' ELSE '+' END AS strand, qual, id, pos + r + k AS pos, CASE op WHEN 'D' THEN '-' WHEN 'I' THEN '+' ELSE substr(seq, (q + k)::INT, 1) END AS base, CASE op WHEN 'M' THEN q + k ELSE q - 1 END AS place
  FROM (SELECT *, CASE op WHEN 'I' THEN -1 ELSE unnest(range(CASE op WHEN 'I' THEN 1 ELSE len END)) END AS k FROM alignments JOIN ops USING (cigar) WHERE flag & 4 = 0))"""


@query(f"{_PILE} SELECT rname, pos, base, strand, count(*) AS n FROM pile WHERE base <> '+' GROUP BY ALL")
def pileup(spark: SparkSession, sf: str) -> DataFrame:
    return alignments.pileup(_aligned(spark, sf))


@query(
    f"""{_PILE}, b AS (SELECT *, CASE WHEN c > 0 AND c <= 4 THEN 0 WHEN c > 4 AND c <= 12 THEN 1 END AS bin FROM (SELECT *, CASE strand WHEN '-' THEN 12 - place + 1 ELSE place END AS c FROM pile)
  WHERE base IN ('+', '-') OR ascii(substr(qual, place::INT, 1)) - 33 >= 20), c AS (SELECT * FROM b WHERE bin IS NOT NULL),
d AS (SELECT rname, pos FROM (SELECT rname, pos, base, count(*) AS n FROM c GROUP BY ALL) GROUP BY ALL HAVING sum(n) >= 2 AND sum(n) - max(n) >= 1)
SELECT rname, pos, base, bin, count(*) AS n FROM c JOIN d USING (rname, pos) GROUP BY ALL"""
)
def pileup_options(spark: SparkSession, sf: str) -> DataFrame:
    return alignments.pileup(_aligned(spark, sf), by_strand=False, min_depth=2, min_base_quality=20, min_minor=1, insertions=True, cycle_bins=[0, 4, 12])


@query(f"{_PILE}, s AS (SELECT rname, pos, row_number() OVER (PARTITION BY rname, pos ORDER BY id, strand) AS k FROM pile WHERE base <> '+') SELECT rname, pos, count(*) AS n FROM s WHERE k <= 3 GROUP BY ALL")
def pileup_depth(spark: SparkSession, sf: str) -> DataFrame:
    return alignments.pileup(_aligned(spark, sf), by_strand=False, by_base=False, max_depth=3, order="id")


@query(f"WITH {sql('pets')}, s AS (SELECT *, {_STATE.format(q='qual')} AS state1, {_STATE.format(q='(qual + pet_id % 3 * 10)')} AS state2 FROM pets) SELECT state1, state2, count(*) FILTER (tid = mtid AND qual >= 20) AS cis_passed, count(*) FILTER (tid = mtid AND qual < 20) AS cis_failed, count(*) FILTER (tid <> mtid AND qual >= 20) AS trans_passed, count(*) FILTER (tid <> mtid AND qual < 20) AS trans_failed FROM s GROUP BY 1, 2")
def pair_state_passes(spark: SparkSession, sf: str) -> DataFrame:
    state = lambda q: F.when(q >= 40, "U").when(q >= 20, "R").otherwise("N")
    t = _pets(spark, sf)
    return pets.pair_state_passes(t.withColumns({"state1": state(F.col("qual")), "state2": state(F.col("qual") + F.col("pet_id") % 3 * 10)}))


_LINKED = "SELECT *, pet_id % 3 AS class, pet_id % 2 AS final_linker, pet_id % 5 % 2 AS linker, pet_id % 4 % 2 AS mlinker FROM pets WHERE pet_id % 11 <> 0 UNION ALL SELECT * REPLACE (-1 AS tid, -1 AS mtid), 0, 0, 0, 0 FROM pets WHERE pet_id % 11 = 0"


@query(
    f"""WITH {sql('pets')}, linked AS ({_LINKED}), s AS (SELECT *, (tid, pos, endpos) > (mtid, mpos, mendpos) AS sw FROM linked WHERE tid >= 0 OR mtid >= 0),
c AS (SELECT * REPLACE (CASE WHEN sw THEN mtid ELSE tid END AS tid, CASE WHEN sw THEN mpos ELSE pos END AS pos, CASE WHEN sw THEN mendpos ELSE endpos END AS endpos, CASE WHEN sw THEN tid ELSE mtid END AS mtid, CASE WHEN sw THEN pos ELSE mpos END AS mpos,
  CASE WHEN sw THEN endpos ELSE mendpos END AS mendpos, CASE WHEN sw THEN mstrand ELSE strand END AS strand, CASE WHEN sw THEN strand ELSE mstrand END AS mstrand, CASE WHEN sw THEN mlinker ELSE linker END AS linker, CASE WHEN sw THEN linker ELSE mlinker END AS mlinker) FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY {_KEYS}, class, final_linker, linker, mlinker ORDER BY qual DESC, pet_id) AS k, count(*) OVER (PARTITION BY {_KEYS}, class, final_linker, linker, mlinker) AS copies FROM c) SELECT * EXCLUDE (k, sw) FROM r WHERE k = 1"""
)
def pet_dedup_linkers(spark: SparkSession, sf: str) -> DataFrame:
    t = _pets(spark, sf)
    odd = F.col("pet_id") % 11 == 0
    kinds = {"class": F.col("pet_id") % 3, "final_linker": F.col("pet_id") % 2, "linker": F.col("pet_id") % 5 % 2, "mlinker": F.col("pet_id") % 4 % 2}
    t = t.withColumns({k: F.when(odd, 0).otherwise(v) for k, v in kinds.items()} | {k: F.when(odd, -1).otherwise(F.col(k)) for k in ("tid", "mtid")})
    return pets.drop_duplicates(t)


@query(
    f"""WITH {sql('pets')}, b AS (SELECT pet_id % 3 AS linker_class, floor((abs({_SPAN}) - 1) / 100.0 + 0.5) AS p, {_STRANDS} AS o FROM pets WHERE tid = mtid)
SELECT linker_class, CASE WHEN p < 0 THEN -1 WHEN p >= 1000 THEN 1000 ELSE p END::BIGINT AS bin, count(*) FILTER (o = '++') AS ff, count(*) FILTER (o = '+-') AS fr, count(*) FILTER (o = '-+') AS rf, count(*) FILTER (o = '--') AS rr FROM b GROUP BY ALL"""
)
def span_histogram_linkers(spark: SparkSession, sf: str) -> DataFrame:
    return pets.span_histogram(_pets(spark, sf).withColumn("linker_class", F.col("pet_id") % 3), by=("linker_class",))


_MIDDLE = "(pos + endpos) // 2 AS m1, (mpos + mendpos) // 2 AS m2"


@query(
    f"""WITH {sql('pets')}, w AS (SELECT *, {_MIDDLE} FROM pets), e AS (SELECT pet_id, tid, mtid, greatest(m1 - CASE strand WHEN 0 THEN 400 ELSE 100 END, 0) AS s1, m1 + CASE strand WHEN 0 THEN 100 ELSE 400 END AS e1,
  greatest(m2 - CASE mstrand WHEN 0 THEN 400 ELSE 100 END, 0) AS s2, m2 + CASE mstrand WHEN 0 THEN 100 ELSE 400 END AS e2 FROM w)
SELECT pet_id, s1, CASE WHEN tid = mtid THEN least(e1, e2) ELSE e1 END AS e1, CASE WHEN tid = mtid THEN greatest(s2, s1) ELSE s2 END AS s2, e2 FROM e"""
)
def pet_extend_middle(spark: SparkSession, sf: str) -> DataFrame:
    return pets.extend(_pets(spark, sf), 400, 100, anchor="middle").select("pet_id", "s1", "e1", "s2", "e2")


@query(f"{_SHARED} SELECT * FROM loops_a WHERE loop_id NOT IN (SELECT loop_a FROM shared)")
def loop_difference(spark: SparkSession, sf: str) -> DataFrame:
    return loops.unshared_loops(_half(spark, sf, 0), _half(spark, sf, 1))


@query(f"{_PAIRS} SELECT * FROM pairs WHERE {_ORD.format(c='chr1')} < {_ORD.format(c='chr2')} OR (chr1 = chr2 AND pos1 < pos2 AND {_ORD.format(c='chr1')} > 0)")
def pairs_strict_triangle(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.upper_triangle(_pairs(spark, sf), CHROMS, strict=True)


@query(f"{_PAIRS} SELECT * EXCLUDE (read_id, strand1) FROM pairs")
def pairs_remove_columns(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.remove_columns(_pairs(spark, sf), [0, "strand1"])


# --- densities -----------------------------------------------------------------------------------------------------

_POINTS = f"{_ALIGNED}, points AS (SELECT rname AS chrom, pos, CASE WHEN flag & 16 <> 0 THEN '-' ELSE '+' END AS strand, id FROM alignments)"


def _points(spark: SparkSession, sf: str) -> DataFrame:
    return _aligned(spark, sf).select(F.col("rname").alias("chrom"), "pos", F.when(alignments.has(alignments.REVERSE), "-").otherwise("+").alias("strand"), "id")


@query(f"{_POINTS}, c AS (SELECT chrom, pos // 1000 AS bin, count(*) AS n FROM points GROUP BY 1, 2) SELECT chrom, bin + d AS bin, round(sum(n * exp(-power(d * 1000 / 1000.0, 2) / 2) / (1000 * sqrt(2 * pi()))), 9) AS density FROM c, range(-3, 4) t(d) GROUP BY 1, 2")
def tag_density(spark: SparkSession, sf: str) -> DataFrame:
    return density.smoothed(_points(spark, sf), 1000, 1000).select("chrom", "bin", F.round("density", 9).alias("density"))


@query(
    f"""{_POINTS}, b AS (SELECT chrom, pos // 1000 AS bin, count(*) FILTER (id % 2 = 0) AS signal, count(*) FILTER (id % 2 = 1) AS background FROM points GROUP BY 1, 2), t AS (SELECT sum(signal) / sum(background) AS k FROM b)
SELECT chrom, bin, signal, background, round((signal + 1) / ((background + 1) * k), 9) AS fold, round(greatest(signal + 1 - sqrt(signal + 1), 0) / ((background + 1) * k + sqrt((background + 1) * k)), 9) AS least_fold FROM b, t"""
)
def fold_profile(spark: SparkSession, sf: str) -> DataFrame:
    t = _points(spark, sf)
    out = density.fold_profile(t.where("id % 2 = 0"), t.where("id % 2 = 1"))
    return out.select("chrom", "bin", "signal", "background", F.round("fold", 9).alias("fold"), F.round("least_fold", 9).alias("least_fold"))


@query(f"{_POINTS}, c AS (SELECT chrom, strand, pos // 100 AS bin, count(*) AS n FROM points GROUP BY ALL) SELECT (b.bin - a.bin) * 100 AS shift, sum(a.n * b.n)::BIGINT AS n FROM c a JOIN c b ON a.chrom = b.chrom AND a.strand = '+' AND b.strand = '-' AND b.bin - a.bin BETWEEN 0 AND 10 GROUP BY 1")
def cross_correlation(spark: SparkSession, sf: str) -> DataFrame:
    return density.cross_correlation(_points(spark, sf), 1000, 100)


@query(
    f"""{_POINTS}, a AS (SELECT chrom, strand, pos, count(*) AS n FROM points GROUP BY ALL), m AS (SELECT chrom, pos // 10000 AS w, avg(n) AS mean FROM a GROUP BY ALL),
odd AS (SELECT a.chrom, a.strand, a.pos FROM a JOIN m ON a.chrom = m.chrom AND a.pos // 10000 = m.w WHERE a.n > 1.2 * mean + 1) SELECT id FROM points p WHERE NOT EXISTS (SELECT 1 FROM odd o WHERE o.chrom = p.chrom AND o.strand = p.strand AND o.pos = p.pos)"""
)
def tag_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    return density.without_anomalies(_points(spark, sf), 10_000, 1.2).select("id")


@query(f"{_POINTS}, a AS (SELECT chrom, pos, count(*) AS n FROM points WHERE strand = '-' GROUP BY ALL) SELECT id FROM points JOIN a USING (chrom, pos) WHERE strand = '-' AND n >= 2")
def informative_tags(spark: SparkSession, sf: str) -> DataFrame:
    return density.informative(_points(spark, sf), "-", 2).select("id")


@query(
    f"""WITH {sql('peaks')}, {_DEPTH.format(t='peaks')}, z AS (SELECT sum("end" - start) / 20000000.0 AS mean FROM peaks),
pm AS (SELECT k, sum(exp(-mean + k * ln(mean) - lgamma(k + 1))) OVER (ORDER BY k) AS upto FROM z, range(0, 200) t(k)), cut AS (SELECT min(k) + 1 AS cutoff FROM pm WHERE 1 - upto <= 0.01),
high AS (SELECT chrom, start, "end" + 100 AS "end", depth FROM cov, cut WHERE depth >= cutoff), {_MERGED.format(t='high')},
called AS (SELECT chrom, start, "end" - 100 AS "end" FROM merged WHERE "end" - 100 - start >= 50)
SELECT c.chrom, c.start, c."end", (SELECT max(depth) FROM high h WHERE h.chrom = c.chrom AND h.start < c."end" AND h."end" - 100 > c.start)::BIGINT AS height FROM called c"""
)
def call_peaks(spark: SparkSession, sf: str) -> DataFrame:
    return density.call_peaks(relation(spark, sf, "peaks"), 20_000_000, 0.01, 100, 50)


# Depths of several layers of intervals (chrom, start, end, layer) as runs.
_LAYERS = """ev AS (SELECT chrom, start AS pos, layer, 1 AS d FROM lay WHERE start < "end" UNION ALL SELECT chrom, "end", layer, -1 FROM lay WHERE start < "end"),
st AS (SELECT chrom, pos, {sums} FROM ev GROUP BY ALL HAVING {some}),
runs AS (SELECT chrom, pos AS start, lead(pos) OVER w AS "end", {upto} FROM st WINDOW w AS (PARTITION BY chrom ORDER BY pos) QUALIFY lead(pos) OVER w IS NOT NULL)"""


def _layers(*names: str) -> str:
    sums = ", ".join(f"sum(d) FILTER (layer = {k}) AS {n}" for k, n in enumerate(names))
    some = " OR ".join(f"coalesce(sum(d) FILTER (layer = {k}), 0) <> 0" for k in range(len(names)))
    return _LAYERS.format(sums=sums, some=some, upto=", ".join(f"sum(coalesce({n}, 0)) OVER w::BIGINT AS {n}" for n in names))


def _window_sql(source: str, width: int, layer: int, shift: int = 0) -> str:
    at = f"(pos + CASE WHEN strand = '+' THEN {shift} ELSE -{shift} END - {width // 2 - (1 - width % 2)})"
    return f"SELECT chrom, greatest({at}, 0) AS start, greatest({at} + {width}, 0) AS \"end\", {layer} AS layer FROM {source}"


_ENRICHED = f"""{_POINTS}, tr AS (SELECT * FROM points WHERE id % 4 <> 0), co AS (SELECT * FROM points WHERE id % 4 = 0), sc AS (SELECT (SELECT count(*) FROM tr) AS n, (SELECT count(*) FROM tr) / (SELECT count(*) FROM co) AS k),
lay AS (SELECT chrom, greatest(CASE WHEN strand = '+' THEN pos ELSE pos - 299 END, 0) AS start, CASE WHEN strand = '+' THEN pos + 300 ELSE pos + 1 END AS "end", 0 AS layer FROM tr
  UNION ALL {_window_sql('co', 300, 1)} UNION ALL {_window_sql('co', 2000, 2)} UNION ALL {_window_sql('co', 20000, 3)}), {_layers('depth', 'n1', 'n2', 'n3')},
kd AS (SELECT depth, n1, n2, n3, sum("end" - start) AS bases, greatest(any_value(n) * 300 / 20000000.0, n1 * any_value(k), n2 * any_value(k) * 300 / 2000, n3 * any_value(k) * 300 / 20000) AS bg FROM runs, sc WHERE depth > 0 GROUP BY depth, n1, n2, n3),
pv AS (SELECT *, list_sum(list_transform(range(depth, depth + 400), lambda j: exp(j * ln(bg) - bg - lgamma(j + 1)))) AS p FROM kd),
cu AS (SELECT *, p * 20000000.0 / sum(bases) OVER (ORDER BY p) AS v FROM pv), qv AS (SELECT *, least(1.0, min(v) OVER (ORDER BY p DESC)) AS q FROM cu),
enriched AS (SELECT chrom, start, "end", r.depth, bg, p, q FROM runs r JOIN qv USING (depth, n1, n2, n3))"""


@query(f"{_ENRICHED} SELECT chrom, start, \"end\", depth, round(bg, 8) AS background, round(p, 9) AS pvalue, round(q, 7) AS qvalue FROM enriched")
def local_enrichment(spark: SparkSession, sf: str) -> DataFrame:
    t = _points(spark, sf)
    out = density.local_enrichment(t.where("id % 4 <> 0"), 20_000_000, t.where("id % 4 = 0"), 300, (2000, 20_000))
    return out.withColumns({"background": F.round("background", 8), "pvalue": F.round("pvalue", 9), "qvalue": F.round("qvalue", 7)})


@query(
    f"""{_ENRICHED}, g1 AS (SELECT *, max("end" + 100) OVER (PARTITION BY chrom ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM enriched WHERE q <= 0.9),
g2 AS (SELECT *, sum(CASE WHEN reach IS NULL OR start > reach THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY start) AS g FROM g1),
g3 AS (SELECT *, row_number() OVER (PARTITION BY chrom, g ORDER BY depth DESC, p, start) AS k, min(start) OVER (PARTITION BY chrom, g) AS a, max("end") OVER (PARTITION BY chrom, g) AS b FROM g2)
SELECT chrom, a AS start, b AS "end", (start + "end") // 2 AS summit, depth AS height, round(bg, 8) AS background, round(p, 9) AS pvalue, round(q, 7) AS qvalue FROM g3 WHERE k = 1 AND b - a >= 300"""
)
def local_peaks(spark: SparkSession, sf: str) -> DataFrame:
    t = _points(spark, sf)
    out = density.local_peaks(t.where("id % 4 <> 0"), 20_000_000, t.where("id % 4 = 0"), 0.9, 300, 100, (2000, 20_000))
    return out.withColumns({"background": F.round("background", 8), "pvalue": F.round("pvalue", 9), "qvalue": F.round("qvalue", 7)})


@query(
    f"""{_POINTS}, tr AS (SELECT * FROM points WHERE id % 4 <> 0), co AS (SELECT * FROM points WHERE id % 4 = 0), sc AS (SELECT (SELECT count(*) FROM tr) / (SELECT count(*) FROM co) AS k),
lay AS ({_window_sql('tr', 5000, 0, 75)} UNION ALL {_window_sql('co', 5000, 1, 75)}), {_layers('s', 'c')},
zs AS (SELECT *, (s - k * c) / sqrt(s + k * k * c) AS z FROM runs, sc WHERE s > 0), hi AS (SELECT * FROM zs WHERE z >= 1.0),
g1 AS (SELECT *, max("end") OVER (PARTITION BY chrom ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM hi),
g2 AS (SELECT *, sum(CASE WHEN reach IS NULL OR start > reach THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY start) AS g FROM g1)
SELECT chrom, min(start) AS start, max("end") AS "end", round(max(z), 8) AS z FROM g2 GROUP BY chrom, g HAVING max(z) >= 2.5"""
)
def broad_clusters(spark: SparkSession, sf: str) -> DataFrame:
    t = _points(spark, sf)
    return density.broad_clusters(t.where("id % 4 <> 0"), t.where("id % 4 = 0"), 5000, 75, 2.5, 1.0).withColumn("z", F.round("z", 8))


def _maxima_sql(source: str, x: str) -> str:
    """Local maxima of the binding score among `source`'s tags, as maxima{x}."""
    sides = [("+", 150, 0), ("+", -150, 1), ("-", -150, 2), ("-", 150, 3)]
    lay = " UNION ALL ".join(f"SELECT chrom, greatest(pos + {d} - 100, 0) AS start, greatest(pos + {d} + 101, 0) AS \"end\", {k} AS layer FROM {source} WHERE strand = '{s}'" for s, d, k in sides)
    runs = _layers("fb", "fa", "ra", "rb")
    for name in ("ev", "st", "runs", "lay"):
        runs = re.sub(rf"\b{name}\b", name + x, runs)
    return f"""lay{x} AS ({lay}), {runs},
sco{x} AS (SELECT chrom, (start + "end" - 1) // 2 AS pos, 2 * sqrt((fb * ra)::DOUBLE) - fa - rb AS score FROM runs{x} WHERE fb > 0 AND ra > 0),
cand{x} AS (SELECT * FROM sco{x} WHERE score >= 1),
maxima{x} AS (SELECT * FROM cand{x} a WHERE NOT EXISTS (SELECT 1 FROM cand{x} b WHERE b.chrom = a.chrom AND b.pos BETWEEN a.pos - 300 AND a.pos + 300 AND (b.score > a.score OR (b.score = a.score AND b.pos < a.pos))))"""


# Tags on both sides of a place: forward ones before it, reverse ones behind.
_BOTH_SIDES = f"""WITH {sql('pets')}, points AS (SELECT 'chr' || tid AS chrom, pos + pet_id % 40 AS pos, '+' AS strand, 2 * pet_id AS id FROM pets
  UNION ALL SELECT 'chr' || tid, pos + 300 - pet_id % 30, '-', 2 * pet_id + 1 FROM pets)"""


def _both_sides(spark: SparkSession, sf: str) -> DataFrame:
    t, chrom = _pets(spark, sf), F.concat(F.lit("chr"), F.col("tid")).alias("chrom")
    forward = t.select(chrom, (F.col("pos") + F.col("pet_id") % 40).alias("pos"), F.lit("+").alias("strand"), (2 * F.col("pet_id")).alias("id"))
    return forward.union(t.select(chrom, F.col("pos") + 300 - F.col("pet_id") % 30, F.lit("-"), 2 * F.col("pet_id") + 1))


@query(
    f"""{_BOTH_SIDES}, drawn AS (SELECT chrom, strand, id, ('0x' || substr(md5('1:' || id), 1, 12))::BIGINT % 5000000 AS pos FROM points), {_maxima_sql('points', '_a')}, {_maxima_sql('drawn', '_b')},
sc AS (SELECT score, sum(n) AS n, sum(f) AS f FROM (SELECT score, 1 AS n, 0 AS f FROM maxima_a UNION ALL SELECT score, 0, 1 FROM maxima_b) GROUP BY 1),
ra AS (SELECT score, n, sum(f) OVER (ORDER BY score DESC) / greatest(sum(n) OVER (ORDER BY score DESC), 1) AS fdr FROM sc)
SELECT chrom, pos, round(score, 9) AS score, round(fdr, 9) AS fdr FROM maxima_a JOIN ra USING (score) WHERE score >= (SELECT min(score) FROM ra WHERE n > 0 AND fdr <= 0.05)"""
)
def binding_positions(spark: SparkSession, sf: str) -> DataFrame:
    lengths = {f"chr{k}": 5_000_000 for k in range(4)}
    out = density.binding_positions(_both_sides(spark, sf), lengths, 300, 100, fdr=0.05)
    return out.withColumns({"score": F.round("score", 9), "fdr": F.round("fdr", 9)})


@query(
    f"""{_POINTS}, h AS (SELECT *, ('0x' || substr(md5('1:' || id), 1, 12))::BIGINT AS d FROM points) SELECT chrom, pos // 10000 AS bin, count(*) FILTER (id % 4 = 0) AS background,
count(*) FILTER (id % 4 <> 0 AND d < floor(0.25 * 281474976710656)) AS signal1, count(*) FILTER (id % 4 <> 0 AND d < floor(0.5 * 281474976710656)) AS signal2, count(*) FILTER (id % 4 <> 0) AS signal3 FROM h GROUP BY 1, 2"""
)
def nested_tag_counts(spark: SparkSession, sf: str) -> DataFrame:
    t = _points(spark, sf)
    return density.nested_counts(t.where("id % 4 <> 0"), t.where("id % 4 = 0"), (0.25, 0.5, 1.0), 10_000)


# --- phasing -------------------------------------------------------------------------------------------------------


@query(f"WITH {sql('snps')} SELECT id, p, m, p + m AS coverage, CASE WHEN p > m THEN 'P' WHEN p < m THEN 'M' ELSE 'N' END AS allele FROM snps")
def allele_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts come out of pileup texts: p upper-case A and m lower-case c."""
    piles = relation(spark, sf, "snps").withColumn("bases", F.concat(F.lit("^]"), F.expr("repeat('A', int(p))"), F.lit("+2TT$"), F.expr("repeat('c', int(m))"), F.lit("*")))
    t = piles.withColumn("b", pileup_counts(F.col("bases"), F.lit("G"))).select("id", F.col("b.a").cast("long").alias("p"), F.col("b.c").cast("long").alias("m"))
    return t.select("id", "p", "m", (F.col("p") + F.col("m")).alias("coverage"), phasing.allele().alias("allele"))


# Many of these p-values lie halfway between two rounded ones; a little more takes both engines to the same side.
_BINOM = "CASE WHEN p = m THEN 1.0 ELSE least(1.0, 2 * (SELECT sum(exp(lgamma(p + m + 1) - lgamma(k + 1) - lgamma(p + m - k + 1) - (p + m) * ln(2))) FROM range(0, least(p, m) + 1) t(k))) END"


@query(f"WITH {sql('snps')} SELECT id, round({_BINOM} + 1e-12, 9) AS pvalue FROM snps")
def binomial_bias(spark: SparkSession, sf: str) -> DataFrame:
    from lociflow.functions.statistics import binomial_half

    return relation(spark, sf, "snps").select("id", F.round(binomial_half("p", "m") + 1e-12, 9).alias("pvalue"))


@query(f"WITH {sql('snps')}, k AS (SELECT id, pv, row_number() OVER (ORDER BY pv DESC, id DESC) AS k FROM snps) SELECT id, round(least(1.0, min(k * pv) OVER (ORDER BY k)), 9) AS padj FROM k")
def hochberg_adjust(spark: SparkSession, sf: str) -> DataFrame:
    from lociflow.functions.statistics import hochberg

    return hochberg(relation(spark, sf, "snps").select("id", "pv"), "pv", "id").select("id", F.round("padj", 9).alias("padj"))


_PHASED = f"""{sql('peaks', 'snps')}, s AS (SELECT chrom, pos, p + m AS coverage, CASE WHEN p > m THEN 'P' WHEN p < m THEN 'M' ELSE 'N' END AS allele FROM snps),
hit AS (SELECT k.id, s.*, row_number() OVER (PARTITION BY k.id ORDER BY coverage DESC, pos) AS r FROM peaks k JOIN s ON s.chrom = k.chrom AND s.pos >= k.start AND s.pos <= k."end"),
phased AS (SELECT id, coalesce(phase, 'Unphased') AS phase, CASE WHEN coalesce(phase, 'Unphased') = 'Unphased' THEN 0 ELSE sided END::BIGINT AS phased_snps
  FROM (SELECT k.id, count(*) FILTER (allele IN ('P', 'M')) AS sided, CASE WHEN coalesce(max(allele) FILTER (r = 1 AND coverage > 0), 'N') = 'N' THEN 'Unphased'
    WHEN bool_or(allele = 'P') AND bool_or(allele = 'M') THEN 'Mix' WHEN bool_or(allele = 'P') THEN 'P' WHEN bool_or(allele = 'M') THEN 'M' END AS phase FROM peaks k LEFT JOIN hit h ON h.id = k.id GROUP BY 1))"""


@query(f"WITH {_PHASED} SELECT * FROM phased")
def peak_phase(spark: SparkSession, sf: str) -> DataFrame:
    return phasing.peak_phase(relation(spark, sf, "peaks"), _snps(spark, sf))


@query(f"""WITH {_PHASED} SELECT sink, chrom, start, "end", CASE phase WHEN 'M' THEN 'Maternal' WHEN 'P' THEN 'Paternal' ELSE phase END AS name,
CASE phase WHEN 'M' THEN '215,48,39' WHEN 'P' THEN '26,152,80' WHEN 'Mix' THEN '209,229,240' ELSE '153,153,153' END AS colour
FROM peaks JOIN phased USING (id), (VALUES ('browser'), ('Maternal'), ('Paternal')) v(sink) WHERE NOT (sink = 'Maternal' AND phase = 'P') AND NOT (sink = 'Paternal' AND phase = 'M')""")
def phased_peak_sinks(spark: SparkSession, sf: str) -> DataFrame:
    peaks = relation(spark, sf, "peaks")
    return phasing.phased_peak_rows(peaks, phasing.peak_phase(peaks, _snps(spark, sf)))


@query(
    f"""WITH {_PHASED} SELECT k.chrom || ':' || k.start || '-' || k."end" AS place, any_value(phased_snps) AS phased_snps, any_value(phase) AS phase,
string_agg(n.pos || ',' || CASE WHEN p > m THEN 'P' ELSE 'M' END || ',' || p || ':' || m || ',' || n.id, '|' ORDER BY n.pos) AS snps
FROM peaks k JOIN phased h USING (id) JOIN snps n ON n.chrom = k.chrom AND n.pos BETWEEN k.start AND k."end" WHERE phase <> 'Unphased' AND p <> m GROUP BY k.id, 1"""
)
def phased_peak_annotation(spark: SparkSession, sf: str) -> DataFrame:
    peaks, snps = relation(spark, sf, "peaks"), relation(spark, sf, "snps")
    named = snps.select("chrom", "pos", F.col("id").cast("string").alias("name"), "p", "m", phasing.allele().alias("allele"))
    return phasing.peak_annotation(peaks, named, phasing.peak_phase(peaks, _snps(spark, sf)))


@query(
    f"""{_LOOPS}, {_ANCHORS}, {_PHASED}, pk AS (SELECT k.*, phase FROM peaks k JOIN phased USING (id) WHERE phase IN ('P', 'M')),
ty AS (SELECT x.loop_id, x.side, coalesce((SELECT k.phase FROM pk k WHERE x.chrom = k.chrom AND x.start <= k."end" AND k.start <= x."end" ORDER BY k.start, k."end", k.id LIMIT 1), 'NA') AS t FROM anchors x WHERE x.loop_id IN (SELECT max(loop_id) FROM loops GROUP BY chrom, s1, e1, s2, e2)),
ht AS (SELECT a.loop_id, a.t AS head, b.t AS tail FROM ty a JOIN ty b ON a.loop_id = b.loop_id AND a.side = 1 AND b.side = 2)
SELECT *, CASE WHEN 'P' IN (head, tail) AND 'M' IN (head, tail) THEN 'Crossed' WHEN 'P' IN (head, tail) THEN 'Paternal' WHEN 'M' IN (head, tail) THEN 'Maternal' ELSE 'nonPhased' END AS phase FROM ht"""
)
def loop_phase(spark: SparkSession, sf: str) -> DataFrame:
    peaks = relation(spark, sf, "peaks")
    return phasing.loop_phase(_loops(spark, sf), peaks.join(phasing.peak_phase(peaks, _snps(spark, sf)), "id"))


_BIASED = f"b AS (SELECT id, p, m, {_BINOM} AS pv FROM snps), k AS (SELECT *, row_number() OVER (ORDER BY pv DESC, id DESC) AS k FROM b), q AS (SELECT *, least(1.0, min(k * pv) OVER (ORDER BY k)) AS padj FROM k)"


@query(f"WITH {sql('snps')}, {_BIASED} SELECT id, round(pv + 1e-12, 9) AS pvalue, round(padj + 1e-12, 6) AS padj, CASE WHEN padj < 0.1 THEN 'Yes' ELSE 'No' END AS biased FROM q")
def allele_bias(spark: SparkSession, sf: str) -> DataFrame:
    t = phasing.allele_bias(relation(spark, sf, "snps").select("id", "p", "m"))
    return t.select("id", F.round(F.col("pvalue") + 1e-12, 9).alias("pvalue"), F.round(F.col("padj") + 1e-12, 6).alias("padj"), "biased")


@query(f"WITH {sql('snps')} SELECT chrom, pos AS start, pos + 200 AS \"end\", id AS name, '+' AS strand, p, m, pv AS pvalue, CASE WHEN p >= m THEN '26,152,80' ELSE '215,48,39' END AS colour FROM snps")
def snp_bed(spark: SparkSession, sf: str) -> DataFrame:
    return phasing.snp_bed(relation(spark, sf, "snps").select("chrom", "pos", F.col("id").alias("padj"), "p", "m", F.col("pv").alias("pvalue")))


@query(f"WITH {sql('snps')} SELECT chrom, pos AS start, pos + 100 AS \"end\", p AS value FROM snps UNION ALL SELECT chrom, pos, pos + 10, m FROM snps")
def allele_bedgraphs(spark: SparkSession, sf: str) -> DataFrame:
    t = relation(spark, sf, "snps")
    return phasing.allele_bedgraph(t, "p", 100).union(phasing.allele_bedgraph(t, "m", 10))


@query(
    f"""WITH {sql('snps')}, c AS (SELECT chrom, pos, sum(p) AS a, sum(m) AS c, count(*) AS g, max(id) AS t FROM snps GROUP BY 1, 2), s AS (SELECT DISTINCT chrom, pos, substr('ACGT', (pos % 4 + 1)::INT, 1) AS paternal, substr('CGTA', (pos % 4 + 1)::INT, 1) AS maternal FROM snps WHERE pos % 3 = 0)
SELECT chrom, pos, paternal, maternal, CASE paternal WHEN 'A' THEN a WHEN 'C' THEN c WHEN 'G' THEN g WHEN 'T' THEN t END::BIGINT AS p, CASE maternal WHEN 'A' THEN a WHEN 'C' THEN c WHEN 'G' THEN g WHEN 'T' THEN t END::BIGINT AS m FROM c LEFT JOIN s USING (chrom, pos)"""
)
def counts_at_snps(spark: SparkSession, sf: str) -> DataFrame:
    t = relation(spark, sf, "snps")
    counts = t.groupBy("chrom", "pos").agg(F.sum("p").alias("a"), F.sum("m").alias("c"), F.count(F.lit(1)).alias("g"), F.max("id").alias("t"))
    letter = lambda letters: F.substring(F.lit(letters), (F.col("pos") % 4 + 1).cast("int"), F.lit(1))
    known = t.where("pos % 3 = 0").select("chrom", "pos", letter("ACGT").alias("paternal"), letter("CGTA").alias("maternal")).distinct()
    return phasing.counts_at_snps(counts, known).select("chrom", "pos", "paternal", "maternal", "p", "m")


@query(f"WITH {sql('snps')}, u AS (SELECT DISTINCT chrom, pos FROM snps), x AS (SELECT *, pos % 5 AS d FROM u) SELECT chrom, pos, 'A' AS ref, (d + pos % 3)::BIGINT AS depth, repeat('a', d::INT) || repeat('C', (pos % 3)::INT) AS bases, repeat('I', d::INT) || repeat('J', (pos % 3)::INT) AS quals FROM x WHERE d + pos % 3 > 0")
def join_pileups(spark: SparkSession, sf: str) -> DataFrame:
    t = relation(spark, sf, "snps").select("chrom", "pos", F.lit("A").alias("ref")).distinct()
    pile = lambda n, base, qual: t.select("*", F.expr(f"pos % {n}").alias("depth"), F.expr(f"repeat('{base}', int(pos % {n}))").alias("bases"), F.expr(f"repeat('{qual}', int(pos % {n}))").alias("quals"))
    return phasing.join_pileups(pile(5, "a", "I"), pile(3, "C", "J"))


# --- significance and reproducibility ------------------------------------------------------------------------------

_SEEN = "seen AS (SELECT chrom, least((s1 + e1) // 2, (s2 + e2) // 2) AS i, greatest((s1 + e1) // 2, (s2 + e2) // 2) AS j, sum(n) AS n FROM loops GROUP BY 1, 2, 3)"
_BAND = "seg AS (SELECT DISTINCT chrom, unnest([(s1 + e1) // 2, (s2 + e2) // 2]) AS mid FROM loops), band AS (SELECT a.chrom, a.mid AS i, b.mid AS j, b.mid - a.mid AS delta FROM seg a JOIN seg b ON a.chrom = b.chrom AND b.mid - a.mid BETWEEN 5000 AND 200000)"
_QUANTILE = """rk AS (SELECT delta, row_number() OVER (ORDER BY delta) - 1 AS k, greatest(count(*) OVER () // {q}, 1) AS z FROM band), qs AS (SELECT delta, k, z, least(k // z, {q} - 1) AS quantile FROM rk),
quant AS (SELECT quantile, min(delta) AS low, max(delta) AS high, (max(delta) FILTER (k = quantile * z + (z - 1) // 2) + max(delta) FILTER (k = quantile * z + z // 2)) // 2 AS median, count(*) AS pairs FROM qs GROUP BY 1)"""
_QUANT = _QUANTILE.format(q=20)
_MEANS = """bn AS (SELECT b.delta, coalesce(s.n, 0) AS n FROM band b LEFT JOIN seen s USING (chrom, i, j)), fq AS (SELECT delta, min(quantile) AS quantile FROM qs GROUP BY 1),
me AS (SELECT quantile, sum(n) / count(*) AS mean FROM bn JOIN fq USING (delta) GROUP BY 1), knots AS (SELECT median AS x, avg(mean) AS y FROM me JOIN quant USING (quantile) GROUP BY 1)"""


@query(f"{_LOOPS}, {_SEEN} SELECT chrom, mid, sum(n)::BIGINT AS total FROM (SELECT chrom, i AS mid, n FROM seen UNION ALL SELECT chrom, j, n FROM seen) GROUP BY 1, 2")
def marginals(spark: SparkSession, sf: str) -> DataFrame:
    return significance.marginals(significance.observed(_loops(spark, sf)))


@query(f"{_LOOPS}, {_BAND}, {_QUANT} SELECT * FROM quant")
def distance_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    return significance.distance_quantiles(significance.distance_counts(significance.segments(_loops(spark, sf)), 5000, 200_000), 20)


@query(f"{_LOOPS}, {_SEEN}, {_BAND}, {_QUANT}, {_MEANS} SELECT x AS median, round(y, 9) AS mean FROM knots")
def expected_by_distance(spark: SparkSession, sf: str) -> DataFrame:
    t = _loops(spark, sf)
    return significance.decay(significance.distance_counts(significance.segments(t), 5000, 200_000), significance.observed(t), 20).select("median", F.round("mean", 9).alias("mean"))


# A natural cubic spline through the knots by elimination and back-substitution, then tails by log gamma over all pairs of the band.
_NCHG = f"""{_LOOPS.replace("WITH", "WITH RECURSIVE", 1)}, {_SEEN}, {_BAND}, {_QUANTILE.format(q=100)}, {_MEANS},
kn AS (SELECT *, row_number() OVER (ORDER BY x) - 1 AS k, count(*) OVER () AS z, lead(x) OVER (ORDER BY x) - x AS h, lead(y) OVER (ORDER BY x) - y AS dy FROM knots),
st AS (SELECT k, z, h, dy, lag(h) OVER (ORDER BY k) AS g, lag(dy) OVER (ORDER BY k) AS gy FROM kn),
fw AS (SELECT 0::BIGINT AS k, 0.0::DOUBLE AS c, 0.0::DOUBLE AS d
  UNION ALL SELECT st.k, h / (2 * (g + h) - g * c), (6 * (dy / h - gy / g) - g * d) / (2 * (g + h) - g * c) FROM fw JOIN st ON st.k = fw.k + 1 WHERE st.k < st.z - 1),
bw AS (SELECT (SELECT max(z) - 1 FROM st) AS k, 0.0::DOUBLE AS m UNION ALL SELECT fw.k, CASE WHEN fw.k = 0 THEN 0.0 ELSE fw.d - fw.c * bw.m END FROM bw JOIN fw ON fw.k = bw.k - 1),
pc AS (SELECT kn.k, z, x, y, h, dy, bw.m AS m1, lead(bw.m) OVER (ORDER BY kn.k) AS m2, lead(x) OVER (ORDER BY kn.k) AS x2 FROM kn JOIN bw USING (k)),
ln AS (SELECT min(x) AS x0, arg_min(y, x) AS y0, arg_min(dy / h - h * m2 / 6, CASE WHEN h IS NOT NULL THEN x END) AS b0, max(x) AS x1, arg_max(y, x) AS y1, arg_max(dy / h + h * m1 / 6, CASE WHEN h IS NOT NULL THEN x END) AS b1 FROM pc),
dl AS (SELECT DISTINCT delta FROM band),
ex AS (SELECT delta, CASE WHEN delta < x0 THEN y0 + b0 * (delta - x0) WHEN delta >= x1 THEN y1 + b1 * (delta - x1)
  ELSE y + (delta - x) * (dy / h - h * (2 * m1 + m2) / 6 + (delta - x) * (m1 / 2 + (delta - x) * (m2 - m1) / (6 * h))) END AS e FROM dl, ln LEFT JOIN pc ON delta >= x AND delta < x2),
be AS (SELECT chrom, i, j, e FROM band JOIN ex USING (delta)), li AS (SELECT chrom, mid, sum(e) AS l FROM (SELECT chrom, i AS mid, e FROM be UNION ALL SELECT chrom, j, e FROM be) GROUP BY 1, 2),
ni AS (SELECT chrom, mid, sum(n)::BIGINT AS n FROM (SELECT chrom, i AS mid, n FROM seen UNION ALL SELECT chrom, j, n FROM seen) GROUP BY 1, 2),
lt AS (SELECT chrom, sum(e) AS l FROM be GROUP BY 1), nt AS (SELECT chrom, (2 * sum(n))::BIGINT AS n FROM seen GROUP BY 1),
ar AS (SELECT s.chrom, s.i, s.j, s.n::BIGINT AS n, greatest(b.e, 1e-20) AS e, a.n AS r, c.n AS c, nt.n AS t, x.l AS lx, y.l AS ly, lt.l AS lt FROM seen s JOIN be b USING (chrom, i, j)
  JOIN ni a ON a.chrom = s.chrom AND a.mid = s.i JOIN ni c ON c.chrom = s.chrom AND c.mid = s.j JOIN li x ON x.chrom = s.chrom AND x.mid = s.i JOIN li y ON y.chrom = s.chrom AND y.mid = s.j
  JOIN lt ON lt.chrom = s.chrom JOIN nt ON nt.chrom = s.chrom),
od AS (SELECT *, greatest(0, r + c - t) AS low, CASE WHEN (lx - e) * (ly - e) > 1e-20 THEN greatest(e * (2 * lt - lx - ly + e) / ((lx - e) * (ly - e)), 0.1) END AS o FROM ar),
lw AS (SELECT *, list_transform(range(low, least(r, c) + 1), lambda k: k * ln(o) - lgamma(k + 1) - lgamma(r - k + 1) - lgamma(c - k + 1) - lgamma(t - r - c + k + 1)) AS w FROM od),
ew AS (SELECT *, list_transform(w, lambda v: exp(v - list_max(w))) AS x FROM lw)
SELECT chrom, i, j, n, round(e, 7) AS expected, round(CASE WHEN o IS NULL OR n <= low THEN 1.0 ELSE least(1.0, coalesce(list_sum(x[n - low + 1:]), 0) / list_sum(x)) END + 1e-12, 7) AS pvalue FROM ew"""


@query(_NCHG)
def nchg_pvalues(spark: SparkSession, sf: str) -> DataFrame:
    t = significance.p_values(_loops(spark, sf), 5000, 200_000, 100)
    return t.select("chrom", "i", "j", F.col("n").cast("long").alias("n"), F.round("expected", 7).alias("expected"), F.round(F.col("pvalue") + 1e-12, 7).alias("pvalue"))


@query()
def fdr_search(spark: SparkSession, sf: str) -> DataFrame:
    return significance.refined(_loops(spark, sf), 5000, 200_000, 100)


def _map(spark: SparkSession, sf: str, k: int) -> DataFrame:
    t = _pets(spark, sf).where((F.col("tid") == F.col("mtid")) & (F.col("pet_id") % 2 == k))
    bin_ = lambda c: F.floor(F.col(c) / 10_000)
    return t.groupBy(F.col("tid").alias("chrom"), bin_("pos").alias("i"), bin_("mpos").alias("j")).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {sql('pets')}, c AS (SELECT pet_id % 2 AS k, tid, pos // 10000 AS i, mpos // 10000 AS j, count(*) AS n FROM pets WHERE tid = mtid GROUP BY ALL),
x AS (SELECT * FROM c WHERE k = 0), y AS (SELECT * FROM c WHERE k = 1), b AS (SELECT abs(j - i) AS stratum, coalesce(x.n, 0) AS u, coalesce(y.n, 0) AS v FROM x FULL JOIN y USING (tid, i, j))
SELECT stratum, count(*) AS cells, round(CASE WHEN var_pop(u) > 0 AND var_pop(v) > 0 THEN covar_pop(u, v) / sqrt(var_pop(u) * var_pop(v)) END, 6) AS rho FROM b WHERE stratum <= 10 GROUP BY 1"""
)
def scc_by_stratum(spark: SparkSession, sf: str) -> DataFrame:
    t = reproducibility.strata_correlation(_map(spark, sf, 0), _map(spark, sf, 1), 10)
    return t.select("stratum", "cells", F.round("rho", 6).alias("rho"))


@query()
def scc_smoothed(spark: SparkSession, sf: str) -> DataFrame:
    return reproducibility.adjusted_correlation(reproducibility.smooth(_map(spark, sf, 0), 1), reproducibility.smooth(_map(spark, sf, 1), 1), 10)


@query()
def hclust_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Dendrograms of contact profiles: each chromosome's bins of 100 kb, by how far their contacts reach."""
    t = _pets(spark, sf).where("tid = mtid").groupBy(F.col("tid").alias("chrom"), F.floor(F.col("pos") / 100_000).alias("_id"))
    profile = F.array(*(F.count_if(F.floor((F.col("mpos") - F.col("pos")) / 3000) == k).cast("double") for k in range(7)))
    return reproducibility.cluster_groups(t.agg(profile.alias("profile")), "chrom", "profile")
