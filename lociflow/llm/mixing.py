"""Mixing sources to target weights.

Every document gets a hash-random key from its doc_id and text. Within its source, documents are ordered by that key; a distributed prefix sum of
their word counts (sums of key ranges, then sums within a range) tells where the source's budget cuts. A budget above the
source's size takes whole epochs first. DataFrame functions only.

Defined results: a null text has no words; documents without words are never taken; a null source is a source, the last
in order; repeated rows are documents of their own, in an order that their equal keys leave open but with equal sums;
an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociflow.llm.common import WORD_PATTERN, cut, whole

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
#: Documents that one range of keys should hold, so that a hot source is many ranges.
RANGE_ROWS = 1_000


def source_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds weight and target to `sources`(source, source_size, docs): one row per source, so few rows.

    Sharing the excess of capped sources by weight, until none is above its cap, ends where all others get the same
    amount per weight. Sorted by cap / weight, the capped ones are a prefix; running sums find it in one pass."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    share = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    cap = (F.col("source_size") * epochs).cast("double")
    t = sources.withColumn("weight", share).withColumn("_cap", cap).withColumn("_ratio", F.col("_cap") / F.col("weight"))
    everything = Window.partitionBy()
    before = Window.orderBy("_ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy("_ratio", F.col("source").asc_nulls_last()).rowsBetween(0, Window.unboundedFollowing)
    total = F.sum(F.col("source_size").cast("double")).over(everything)
    level = (total - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    t = t.withColumn("_level", F.when(level <= F.col("_ratio"), level))
    per_weight = F.min_by("_level", F.when(F.col("_level").isNotNull(), F.col("_ratio"))).over(everything)
    t = t.withColumn("_per_weight", per_weight)
    target = F.when(F.col("_per_weight").isNull(), F.col("_cap")).otherwise(F.least("_cap", F.col("_per_weight") * F.col("weight")))
    return t.withColumn("target", target).drop("_cap", "_ratio", "_level", "_per_weight")


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, epochs: int = MAX_EPOCHS, seed: str = "mix", keep: list[Column] | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, taken (words, repeats counted), copies (rows to emit), then `keep`."""
    extra = [c.alias(f"_keep{i}") for i, c in enumerate(keep or [])]
    base = [
        "doc_id",
        "source",
        F.regexp_count(whole("text"), F.lit(WORD_PATTERN)).cast("long").alias("size"),
        F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")), 33).alias("key"),
    ]
    light = cut(docs.select(*base))
    rows = docs.select(*base, *extra) if extra else light  # texts don't go through the checkpoint
    sources = source_targets(light.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs")), weights, epochs)
    sources = cut(sources).withColumnRenamed("source", "_source")

    def ranged(t: DataFrame) -> DataFrame:
        """Adds the source's columns and the range of the 31-bit key; as many ranges as the source's documents need."""
        t = t.join(sources, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        return t.withColumn("range", F.expr(f"(key * (1 + docs div {RANGE_ROWS})) div {1 << 31}"))

    sums = ranged(light).groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    upto = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("_source"), F.col("range").alias("_range"), F.coalesce(F.sum("range_size").over(upto), F.lit(0)).alias("range_start"))
    placed = ranged(rows).join(sums, F.col("source").eqNullSafe(F.col("_source")) & (F.col("range") == F.col("_range"))).drop("_source", "_range")
    within = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("start", F.col("range_start") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    budget = F.floor("target").cast("long")
    full = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(F.lit(0)).cast("long")
    rest = budget - full * F.col("source_size")
    part = F.least(F.greatest(rest - F.col("start"), F.lit(0).cast("long")), F.col("size"))
    out = placed.withColumn("taken", full * F.col("size") + part)
    copies = F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(F.lit(0)).cast("int")
    return out.select("doc_id", "source", "size", "source_size", "target", "taken", copies.alias("copies"), *(F.col(f"_keep{i}") for i in range(len(extra))))
