"""Substring dedup over words, by an FM-index per shard.

A shard's index holds the pieces of its anchors; places count as often as their piece occurs. Each piece is
streamed against it from the right: backward search over the wavelet matrix extends a match to the left as long as it
occurs twice; where it can't be extended, its length is the matching statistic of that end, and the interval is reported if it
reaches the window. A match can't run over a few words that occur once in the shard, so a piece is streamed in the parts
between those, if they hold a window. Shards, pieces and what happens to crowded ones: see `passages`.

Defined results: null counts as empty and has no words; texts shorter than a window lose nothing; rows that
repeat a text lose all of it that a window covers; null or repeated doc_ids keep a row each; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lociflow.llm.common import flat, mix
from lociflow.llm.fm_index import FmIndex
from lociflow.llm.passages import MAX_GROUP, Judge, Units, covered, found_of, with_repeats

GRAM = 8
#: Words that tell whether a match may run over them.
FEW = 4
#: Texts put together at once.
SLICE = 256


def judge(window: int) -> Judge:
    def run(contents: list[bytes], lead: np.ndarray, count: np.ndarray, often: np.ndarray) -> list[np.ndarray]:
        # Symbols are words themselves, not hashes of them.
        pieces = [c.split(b" ") for c in contents]
        at = np.concatenate(([0], np.cumsum([len(p) for p in pieces])))
        number: dict[bytes, int] = {}
        symbols = np.array([number.setdefault(w, len(number) + 1) for p in pieces for w in p], np.int64)
        weight = np.where(often > 1, 2, 1)
        own = np.repeat(np.arange(len(contents)), np.diff(at))
        # A separator after each piece.
        text = np.zeros(len(symbols) + len(contents), np.int64)
        text[np.arange(len(symbols)) + own] = symbols
        whose = np.repeat(np.arange(len(contents)), np.diff(at) + 1)
        index = FmIndex(text, int(symbols.max()) + 1, int(np.diff(at).max()), weight[whose])
        masks = [np.zeros(c, bool) for c in count]
        # The parts to stream: piece, first and last word.
        few = min(FEW, window)
        gram = np.zeros(len(symbols), np.uint64)
        for i in range(few):
            gram[: len(symbols) - i] = mix(gram[: len(symbols) - i] + symbols[i:].astype(np.uint64))
        place = np.flatnonzero(np.arange(len(symbols)) + few <= at[1:][own])
        known = np.unique(gram[place], return_inverse=True)[1]
        twice = place[np.bincount(known, weight[own[place]])[known] > 1]
        new = np.ones(len(twice), bool)
        new[1:] = (twice[1:] != twice[:-1] + 1) | (own[twice[1:]] != own[twice[:-1]])
        edge = np.flatnonzero(new)
        low_word, high_word = twice[edge], twice[np.append(edge, len(twice))[1:] - 1] + few if len(twice) else twice
        use = high_word - low_word >= window
        first, end = low_word[use], high_word[use].copy()
        # State of a stream: the end of its match, the match's start and interval. All streams step together.
        k = own[first]
        start, low, high = end.copy(), np.zeros(len(k), np.int64), np.full(len(k), index.size)
        while len(k):
            more = start > first
            symbol = symbols[np.maximum(start - 1, 0)]
            lo, hi = index.backward(symbol, low, high)
            grows = more & (index.count(lo, np.maximum(lo, hi)) >= 2)
            for i in np.flatnonzero(~grows & (end - start >= window)):
                masks[k[i]][start[i] - at[k[i]] : end[i] - at[k[i]] - window + 1] = True
            start, low, high = np.where(grows, start - 1, end - 1), np.where(grows, lo, 0), np.where(grows, hi, index.size)
            end = np.where(grows, end, end - 1)
            # A match that reached the part's start has reported all that shorter ends could.
            going = grows | (more & (end - first >= window))
            k, first, end, start, low, high = (x[going] for x in (k, first, end, start, low, high))
        return masks

    return run


def remove_repeats(docs: DataFrame, window: int = 50, with_text: bool = False, max_group: int = MAX_GROUP) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, and with_text also the kept text (words joined by one space).

    A word goes if a window of `window` words that covers it has a sequence that starts anywhere else too."""
    units = Units("words", window, GRAM if window >= 2 * GRAM else 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for i in range(0, whole_batch.num_rows, SLICE):
                batch = whole_batch.slice(i, SLICE)
                data, offsets = flat(batch.column("text"))
                laid = units.of(data, offsets)
                at, starts, ends = laid.at, laid.starts, laid.ends
                gone = covered(data, laid, units, found_of(batch))
                doc = np.repeat(np.arange(batch.num_rows), np.diff(at))
                # Of a kept word its bytes stay, and one for a space, unless it is its text's last.
                keep = ~gone
                last = np.zeros(len(keep), bool)
                kept = np.flatnonzero(keep)
                if len(kept):
                    last[kept[np.append(doc[kept[1:]] != doc[kept[:-1]], True)]] = True
                change = np.zeros(len(data) + 2, np.int8)
                change[starts[keep]] += 1
                change[ends[keep]] -= 1
                stays = np.cumsum(change[:-2], dtype=np.int8) > 0
                spaces = ends[keep & ~last]
                out = data.copy()
                out[spaces] = 32
                stays[spaces] = True
                edges = np.concatenate(([0], np.cumsum(stays)))[offsets].tolist()
                raw = out[stays].tobytes()
                texts = [raw[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
                removed = np.bincount(doc, gone, minlength=batch.num_rows).astype(np.int64) if len(doc) else np.zeros(batch.num_rows, np.int64)
                columns = [batch.column("doc_id"), pa.array(np.diff(at)), pa.array(removed), pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
                if with_text:
                    columns.append(pa.array([t.decode("utf-8", "replace") for t in texts], pa.string()))
                    names.append("text")
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = dict(docs.dtypes)["doc_id"]
    rows = with_repeats(docs, units, judge(window), max_group)
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string" + ", text string" * with_text)
