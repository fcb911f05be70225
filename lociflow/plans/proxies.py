"""Proxy relations over the given tables: paired-end tags, loops, peaks, SNPs and reads whose shape the operators expect.

Expressions are kept as text that, with `//` read as integer division, is plain SQL as well."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PETS = """SELECT o_orderkey AS pet_id, o_custkey % 4 AS tid, (o_custkey * 9973) % 5000000 AS pos, (o_custkey * 9973) % 5000000 + 20 AS endpos,
  CASE WHEN o_orderkey % 10 = 0 THEN (o_custkey % 4 + 1) % 4 ELSE o_custkey % 4 END AS mtid,
  (o_custkey * 9973) % 5000000 + (o_orderkey % 7) * 3000 + 20 AS mpos, (o_custkey * 9973) % 5000000 + (o_orderkey % 7) * 3000 + 40 AS mendpos,
  o_orderkey % 2 AS strand, (o_orderkey // 2) % 2 AS mstrand, CAST(substr(o_orderpriority, 1, 1) AS INT) * 10 AS qual FROM orders"""
TAGS = """SELECT event_id AS id, event_type AS kind, concat('chr', CAST(user_id % 5 AS VARCHAR(20))) AS chrom, (event_id % 1000) * 100 AS start,
  (event_id % 1000) * 100 + CAST(floor(value) AS BIGINT) + 1 AS "end" FROM events"""
PEAKS = """SELECT event_id AS id, event_type AS kind, concat('chr', CAST(user_id % 4 AS VARCHAR(20))) AS chrom, (event_id * 4999) % 5000000 AS start,
  (event_id * 4999) % 5000000 + 200 + CAST(floor(value) AS BIGINT) AS "end" FROM events"""
SNPS = """SELECT event_id AS id, concat('chr', CAST(user_id % 4 AS VARCHAR(20))) AS chrom, (event_id * 4999) % 5000000 + 50 AS pos, (event_id * 7) % 23 AS p,
  (event_id * 11) % 19 AS m, ((event_id * 7919) % 1000) / 1000.0 AS pv FROM events"""
SITES = "SELECT p_partkey * 2500 AS site FROM part"
READS = """SELECT doc_id AS read_id, regexp_replace(upper(translate(lower(text), 'bdefhijklmnopqrsuvwxyz', 'acgtacgtacgtacgtacgtac')), '[^ACGT]', ''{g}) AS seq FROM documents"""
ALIGNMENTS = """SELECT l_orderkey * 8 + l_linenumber AS id, concat('q', CAST(l_orderkey AS VARCHAR(20))) AS qname,
  CAST(1 + (l_linenumber % 2) * 16 + CASE WHEN l_partkey % 20 = 0 THEN 4 ELSE 0 END + CASE WHEN l_suppkey % 7 = 0 THEN 1024 ELSE 0 END + CASE WHEN l_partkey % 9 = 0 THEN 256 ELSE 0 END AS INT) AS flag,
  concat('chr', CAST(l_suppkey % 4 AS VARCHAR(20))) AS rname, CAST((l_partkey * 4999) % 5000000 + 1 AS BIGINT) AS pos, CAST(l_quantity AS INT) AS mapq,
  CASE l_linenumber % 4 WHEN 0 THEN '12M' WHEN 1 THEN '5M2D7M' WHEN 2 THEN '4M1I7M' ELSE '3S9M' END AS cigar,
  CASE WHEN l_partkey % 5 = 0 THEN '=' ELSE concat('chr', CAST(l_suppkey % 3 AS VARCHAR(20))) END AS rnext, CAST((l_partkey * 4999) % 5000000 + 1 + (l_partkey % 30) * 1000 AS BIGINT) AS pnext,
  CASE WHEN l_orderkey % 2 = 0 THEN 'ACGTACGTACGT' ELSE 'TTGCATTGCATT' END AS seq, CASE WHEN l_suppkey % 2 = 0 THEN 'IIII####IIII' ELSE 'IIIIIIIIIIII' END AS qual,
  l_orderkey * 2 + CASE WHEN l_linenumber > 4 THEN 1 ELSE 0 END AS pair_id, CAST((l_linenumber - 1) // 2 % 2 + 1 AS INT) AS read, CAST((l_linenumber - 1) % 2 + 1 AS INT) AS tag,
  CASE l_suppkey % 4 WHEN 0 THEN 'U' WHEN 1 THEN 'R' WHEN 2 THEN 'U' ELSE 'N' END AS state, CAST(l_partkey % 25 + 18 AS INT) AS mapped, CAST(l_linenumber AS INT) AS line FROM lineitem"""
RELATIONS = {"pets": PETS, "tags": TAGS, "peaks": PEAKS, "snps": SNPS, "sites": SITES, "reads": READS, "alignments": ALIGNMENTS}
_TABLE = {"pets": "orders", "tags": "events", "peaks": "events", "snps": "events", "sites": "part", "reads": "documents", "alignments": "lineitem"}


def sql(*names: str) -> str:
    """The relations as common table expressions, for any SQL engine."""
    return ", ".join(f"{n} AS ({RELATIONS[n].replace('{g}', ", 'g'")})" for n in names)


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table = _TABLE[name]
    text = RELATIONS[name].replace("{g}", "").replace("//", " div ").replace('"end"', "`end`").replace(" / 1000.0", " / 1000.0D")
    return spark.sql(text.replace(f"FROM {table}", "FROM {source}"), source=spark.read.parquet(f"{sf_dir}/{table}.parquet"))
