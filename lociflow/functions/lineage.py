"""Tables that several steps read, cut from their plans."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def kept(df: DataFrame) -> DataFrame:
    """Writes a table to the shared folder that the session names in spark.checkpoint.dir, and reads it back; where unset and
    all runs in one process, as in tests, to one of our own."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        folder = tempfile.mkdtemp(prefix="lociflow-")
        spark.conf.set("spark.checkpoint.dir", folder)
    path = f"{folder}/lociflow-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, **sums: Column) -> tuple[DataFrame, dict[str, int]]:
    """Like `kept`, and what the written rows add up to: `rows`, and each of `sums`. They're observed as the rows are written, so
    that a loop's end costs no job of its own."""
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows"), *(F.coalesce(F.sum(c), F.lit(0)).alias(k) for k, c in sums.items())]
    out = kept(df.observe(seen, *metrics))
    return out, seen.get
