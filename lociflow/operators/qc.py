"""Quality tables: long (library, metric, value), pivots, ratios, formatting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot(table: DataFrame, libraries: list[str] | None = None) -> DataFrame:
    """A row for each metric, a column for each library."""
    grouped = table.groupBy("metric")
    return (grouped.pivot("library", libraries) if libraries else grouped.pivot("library")).agg(F.first("value"))


def ratios(counts: DataFrame, whole: str, parts: list[str]) -> DataFrame:
    """Adds `<part>_share` of `whole`, null where that is 0."""
    return counts.withColumns({f"{p}_share": F.round(F.try_divide(F.col(p), F.col(whole)), 4) for p in parts})


def thousands(value: str) -> "F.Column":
    return F.format_number(F.col(value), 0)


def group_by_factor(wide: DataFrame, cells: list[str], factor: str) -> DataFrame:
    """Of a long table (library, cell, factor, metric, value) the libraries of these cells with this factor."""
    return wide.where(F.col("cell").isin(cells) & (F.col("factor") == factor))


def linker_summary(routed: DataFrame) -> DataFrame:
    """One row: pairs, those with a linker, and each route."""
    count = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    kinds = {k: count(F.col("route") == k) for k in ("none", "conflict", "one_tag", "two_tag")}
    t = routed.agg(F.count(F.lit(1)).alias("pairs"), *(c.alias(k) for k, c in kinds.items()))
    return t.withColumn("with_linker", F.col("pairs") - F.col("none"))
