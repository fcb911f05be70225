"""Streams of paired-end tags: duplicates dropped, the best tag of each key kept, and spans counted as tags arrive."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lociflow.operators.pets import DUPLICATE_KEYS, canonicalise, ligation_class


def drop_duplicates(tags: DataFrame, time: str = "ts", late: str = "1 hour", keys: list[str] | None = None) -> DataFrame:
    """The first tag of each key within the watermark; the state is as large as the watermark is long."""
    return canonicalise(tags).withWatermark(time, late).dropDuplicatesWithinWatermark(keys or DUPLICATE_KEYS)


def class_counts(tags: DataFrame, time: str = "ts", late: str = "1 hour", window: str = "10 minutes") -> DataFrame:
    """Ligation classes by event-time window."""
    t = tags.withWatermark(time, late).groupBy(F.window(time, window), ligation_class().alias("class")).agg(F.count(F.lit(1)).alias("n"))
    return t.select(F.col("window.start").alias("start"), "class", "n")


class _Best(StatefulProcessor):
    """Keeps the best row of a key, as packed text, for a wait from its first row's time on.

    A better row takes the kept one's place: a greater `best`, of equals the smaller `order`. Once the watermark has passed the wait, or a
    row of a time behind it comes, the kept row comes out once and its state goes, so the state is as large as the watermark is long."""

    def __init__(self, wait_ms: int):
        self.wait = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", "best long, order long, row string, copies long, until long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        have = tuple(self.kept.get()) if self.kept.exists() else None
        closed: list[tuple[str, int]] = []
        for pdf in rows:
            if not len(pdf):
                continue
            for at, best, order, row in pdf.sort_values("ms_")[["ms_", "best_", "order_", "row_"]].itertuples(index=False, name=None):
                if have is not None and at > have[4]:
                    closed.append(have[2:4])
                    have = None
                if have is None:
                    have = (int(best), int(order), row, 1, int(at) + self.wait)
                    self.handle.registerTimer(have[4])
                elif (best, -order) > (have[0], -have[1]):
                    have = (int(best), int(order), row, have[3] + 1, have[4])
                else:
                    have = (*have[:3], have[3] + 1, have[4])
        if have is not None:
            self.kept.update(have)
        if closed:
            yield pd.DataFrame(closed, columns=["row", "copies"])

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        if self.kept.exists():
            _, _, row, copies, until = self.kept.get()
            if expiredTimerInfo.getExpiryTimeInMs() >= until:  # not the timer of rows that are closed
                self.kept.clear()
                yield pd.DataFrame({"row": [row], "copies": [copies]})

    def close(self) -> None:
        pass


def best_of_key(tags: DataFrame, time: str = "ts", late: str = "1 hour", wait_ms: int = 3_600_000, best: str = "qual", order: str = "pet_id", keys: list[str] | None = None) -> DataFrame:
    """The best tag of each key within `wait_ms` of its first, and its copies, as they close: where `drop_duplicates` keeps the first to
    come, this keeps the greatest `best` (at most 127), of equals the smallest `order`, whichever comes later.

    A tag older than the watermark is dropped; one of a closed key opens it again. Needs the RocksDB state store
    (spark.sql.streaming.stateStore.providerClass)."""
    t = canonicalise(tags)
    names, schema = t.columns, t.schema
    held = t.withWatermark(time, late).withColumns({
        "best_": F.least(F.col(best), F.lit(127)).cast("long"), "order_": F.col(order).cast("long"), "ms_": F.unix_millis(F.col(time).cast("timestamp")), "row_": F.to_json(F.struct(*names)),
    })
    held = held.select(*(keys or DUPLICATE_KEYS), time, "best_", "order_", "ms_", "row_") if time not in (keys or DUPLICATE_KEYS) else held
    out = held.groupBy(*(keys or DUPLICATE_KEYS)).transformWithStateInPandas(_Best(wait_ms), "row string, copies long", "append", "eventTime")
    return out.select(F.from_json("row", schema).alias("r"), "copies").select("r.*", "copies")
