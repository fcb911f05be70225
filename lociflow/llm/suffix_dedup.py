"""Suffix-array dedup over bytes, by column-wise construction.

A shard's pieces are laid side by side with their anchors in one column. From the last column to the first, a round puts one
symbol of each piece in front of its suffix: the symbols, in the order of the suffixes so far, are the round's part of the
collection's Burrows-Wheeler transform; sorting them stably orders the longer suffixes, and the common prefix of two
neighbours with equal symbols is the least one between them, plus one. Rounds append transform and common prefixes to two
sequential files in the shared folder, and hold one column in memory. A second pass reads both files once, in step: the
transform alone gives every round's order back, and where a common prefix reaches a window, its suffixes' windows are
repeated. Equal windows have their anchor at the same place, so a window starts elsewhere too exactly if its suffix shares a
window's length with a neighbour in its column's order; a piece that occurs more than once is laid down twice. Files are
removed when their shard is done; a lost executor's are left behind under names of their own. Shards, pieces and crowded
ones: see `passages`.

Defined results: null counts as empty; texts shorter than a window lose nothing; rows that repeat a text lose all of it
that a window covers; null or repeated doc_ids keep a row each; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lociflow.llm.common import flat, shared_dir, shared_files
from lociflow.llm.passages import MAX_GROUP, Judge, Units, covered, found_of, with_repeats

GRAM = 32
SLICE = 256
_NONE = 256


def _rounds(begin: np.ndarray, stop: np.ndarray, place: Callable[[int, int], np.ndarray], files: tuple) -> None:
    """From the last column to the first: writes each round's part of the transform, and its common prefixes."""
    m = len(begin)
    order, common = np.arange(m), np.zeros(m + 1, np.int32)  # common[i]: of suffixes i - 1 and i
    for column in range(int(stop.max()) - 1, -1, -1):
        symbol = place(column, column + 1)[0][order]
        files[0].write(symbol.tobytes())
        step = np.argsort(symbol, kind="stable")
        order, symbol = order[step], symbol[step]
        a, b = step[:-1] + 1, step[1:] + 1
        same = np.flatnonzero((symbol[1:] == symbol[:-1]) & (symbol[1:] != _NONE))
        new = np.zeros(m + 1, np.int32)
        if len(same):
            pairs = np.stack((a[same], b[same]), 1).ravel()
            new[same + 1] = np.minimum.reduceat(common, pairs)[::2] + 1
        common = new
        files[1].write(common.tobytes())


def judge(window: int, folder: str) -> Judge:
    def run(contents: list[bytes], lead: np.ndarray, count: np.ndarray, often: np.ndarray) -> list[np.ndarray]:
        of = np.repeat(np.arange(len(contents)), np.where(often > 1, 2, 1))  # whose text a row is
        m = len(of)
        begin = (int(lead.max()) - lead)[of]
        stop = begin + np.array([len(c) for c in contents])[of]
        joined = np.frombuffer(b"".join(contents[k] for k in of), np.uint8)
        first = np.concatenate(([0], np.cumsum(stop - begin)))[:-1] - begin

        def place(low: int, high: int) -> np.ndarray:
            """The symbols of columns low to high, a row each."""
            at = np.arange(low, high)[:, None]
            there = (at >= begin) & (at < stop)
            return np.where(there, joined[np.where(there, first + at, 0)], np.uint16(_NONE)).astype(np.uint16)

        masks = np.zeros((len(contents), int(count.max())), bool)
        with shared_files(folder, 2) as (create, read):
            with create(0) as symbols, create(1) as prefixes:
                _rounds(begin, stop, place, (symbols, prefixes))
            order = np.arange(m)
            with read(0) as symbols, read(1) as prefixes:
                for column in range(int(stop.max()) - 1, -1, -1):
                    symbol = np.frombuffer(symbols.read(2 * m), np.uint16)
                    common = np.frombuffer(prefixes.read(4 * (m + 1)), np.int32)
                    order = order[np.argsort(symbol, kind="stable")]
                    long = common >= window
                    hit = order[long[:-1] | long[1:]]
                    if len(hit):
                        at = column - begin[hit]
                        use = (at >= 0) & (at < count[of[hit]])
                        masks[of[hit[use]], at[use]] = True
        return [masks[k, : count[k]] for k in range(len(contents))]

    return run


def remove_repeats(docs: DataFrame, window: int = 400, with_bytes: bool = False, max_group: int = MAX_GROUP) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with_bytes also the kept bytes and the spans' starts and ends.

    A byte goes if a string of `window` bytes that covers it also starts anywhere else."""
    units = Units("bytes", window, GRAM if window >= 2 * GRAM else 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for i in range(0, whole_batch.num_rows, SLICE):
                batch = whole_batch.slice(i, SLICE)
                data, offsets = flat(batch.column("text"))
                gone = covered(data, units.of(data, offsets), units, found_of(batch))
                kept = np.concatenate(([0], np.cumsum(~gone)))[offsets]
                raw = data[~gone].tobytes()
                before = np.concatenate(([False], gone))[:-1]
                before[offsets[:-1][offsets[:-1] < len(gone)]] = False
                after = np.concatenate((gone, [False]))[1:]
                after[offsets[1:][offsets[1:] > 0] - 1] = False
                starts, ends = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after) + 1
                first = np.searchsorted(starts, offsets)
                edges = kept.tolist()
                texts = [raw[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
                columns = {
                    "doc_id": batch.column("doc_id"),
                    "n_bytes": pa.array(np.diff(offsets)),
                    "n_removed": pa.array(np.diff(offsets) - np.diff(kept)),
                    "n_spans": pa.array(np.diff(first)),
                    "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                }
                if with_bytes:
                    spans = [pa.array([(edge[first[k] : first[k + 1]] - offsets[k]).tolist() for k in range(batch.num_rows)], pa.list_(pa.int64())) for edge in (starts, ends)]
                    columns |= {"kept": pa.array(texts, pa.binary()), "starts": spans[0], "ends": spans[1]}
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    rows = with_repeats(docs, units, judge(window, shared_dir(docs.sparkSession)), max_group)
    return rows.mapInArrow(run, schema + ", kept binary, starts array<long>, ends array<long>" * with_bytes)
