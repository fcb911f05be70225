"""Linkers in read pairs: exact and fuzzy search, local alignment, routing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociflow.functions.sequence import linker_place

MIN_TAG = 18
#: Letters of a stretch of a read, and stretches that are aligned together.
STRETCH, LANES = 256, 4096


def tag_before(seq: Column, linker: str, mismatches: int = 2) -> Column:
    """What a read holds left of the linker; the whole read if there is none, `A` if nothing is left of it."""
    at = linker_place(seq, linker, mismatches)
    return F.when(at.isNull(), seq).when(at == 0, F.lit("A")).otherwise(F.substring(seq, F.lit(1), at))


def route(pairs: DataFrame, linker: str, mismatches: int = 2, least: int = MIN_TAG) -> DataFrame:
    """Adds linkers (reads of the pair that hold it), tags (long enough) and route: none, conflict, one_tag or two_tag."""
    t = pairs.withColumns({f"_at{k}": linker_place(F.col(f"seq{k}"), linker, mismatches) for k in (1, 2)})
    found = sum((F.col(f"_at{k}").isNotNull().cast("int") for k in (1, 2)), F.lit(0))
    length = {k: F.when(F.col(f"_at{k}").isNull(), F.length(f"seq{k}")).otherwise(F.greatest(F.col(f"_at{k}"), F.lit(1))) for k in (1, 2)}
    tags = sum(((length[k] >= least).cast("int") for k in (1, 2)), F.lit(0))
    t = t.withColumns({"linkers": found, "tags": tags})
    where = F.when(F.col("linkers") == 0, "none").when((F.col("linkers") == 2) | (F.col("tags") == 0), "conflict").when(F.col("tags") == 1, "one_tag").otherwise("two_tag")
    return t.withColumn("route", where).drop("_at1", "_at2")


def _placements(reads: np.ndarray, pattern: np.ndarray) -> tuple[np.ndarray, ...]:
    """Score, start, end of the best placement in each column of `reads`, whose columns advance together, a letter a step, and
    its start and end in the pattern.

    A cell is one number: its score, then which way wins a tie (hit, gap in the linker, gap in the read), then its start in
    the read and the pattern; without a score the start is that of a placement from here on."""
    (width, n), m = reads.shape, len(pattern)
    side = m + 1
    bits = int((width + 1) * side).bit_length()
    first, one = 1 << bits, 1 << bits + 2
    plain = ~(3 * first)
    letters, row = np.unique(pattern, return_inverse=True)
    cells, new = np.repeat(np.arange(m + 1, dtype=np.int32)[:, None], n, 1), np.zeros((m + 1, n), np.int32)
    up, gap = np.empty((m, n), np.int32), np.empty(n, np.int32)
    best, begin, end, last = (np.zeros(n, np.int32) for _ in range(4))
    rows = np.arange(1, m + 1, dtype=np.int32)[:, None]
    for j in range(width):
        hit = np.where(reads[j] == letters[:, None], np.int32(one + 2 * first), np.int32(2 * first - one))
        np.take(hit, row, axis=0, out=new[1:])
        new[1:] += cells[:-1]
        np.add(cells[1:], first - one, out=up)
        np.maximum(new[1:], up, out=new[1:])
        np.copyto(new[1:], (j + 1) * side + rows, where=new[1:] < one)
        new[0] = (j + 1) * side
        for i in range(1, m + 1):
            np.subtract(new[i - 1], one, out=gap)
            np.maximum(new[i], gap, out=new[i])
            np.bitwise_and(new[i], plain, out=new[i])
        lanes = np.flatnonzero(new.max(0) // one > best)
        if len(lanes):
            score = new[:, lanes] // one
            at = score.argmax(0)
            best[lanes] = score[at, np.arange(len(lanes))]
            begin[lanes] = new[at, lanes] % first
            end[lanes] = j + 1
            last[lanes] = at
        cells, new = new, cells
    return best, begin // side, end, begin % side, last


def local_alignment(seqs: list[str], linker: str, stretch: int = STRETCH, lanes: int = LANES) -> tuple[np.ndarray, ...]:
    """Smith-Waterman (match 1, mismatch and gap -1) of many reads at once: score, start, end of the best placement, the
    leftmost end of equals, and its start and end in the linker.

    Reads of any length are dealt in stretches, `lanes` of them at a time. A placement with a score takes fewer than
    2 * len(linker) letters (it has fewer gaps than matches), so a stretch that starts that much early misses none."""
    lead, pattern = 2 * len(linker), np.frombuffer(linker.encode(), np.uint8)
    data = [s.encode("ascii", "replace") for s in seqs]
    count = np.array([max(-(-len(s) // stretch), 1) for s in data], np.int64)
    which = np.repeat(np.arange(len(data)), count)
    edges = np.concatenate((np.zeros(1, np.int64), np.cumsum(count)))
    before = np.maximum((np.arange(len(which)) - edges[which]) * stretch - lead, 0)
    parts = []
    for at in range(0, len(which), lanes):
        texts = [data[r][b : (k - edges[r] + 1) * stretch] for k, (r, b) in enumerate(zip(which[at : at + lanes], before[at : at + lanes], strict=True), at)]
        width = max(len(s) for s in texts)
        reads = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in texts), np.uint8).reshape(len(texts), width)
        parts.append(_placements(np.ascontiguousarray(reads.T), pattern))
    if not parts:
        return tuple(np.zeros(0, np.int32) for _ in range(5))
    score, begin, end, first_letter, last_letter = (np.concatenate(x) for x in zip(*parts, strict=True))
    top = np.flatnonzero(score == np.repeat(np.maximum.reduceat(score, edges[:-1]), count))
    first = top[np.unique(which[top], return_index=True)[1]]
    return score[first], begin[first] + before[first], end[first] + before[first], first_letter[first], last_letter[first]


def align(reads: DataFrame, linker: str, least: int, seq: str = "seq", limit: int | None = None) -> DataFrame:
    """Adds score, begin, end, strand and accepted of the linker's best placement on either strand; forward wins ties."""
    other = linker.translate(str.maketrans("ACGT", "TGCA"))[::-1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            seqs = pdf.pop(seq).fillna("").tolist()
            f, r = local_alignment(seqs, linker), local_alignment(seqs, other)
            back = (r[0] > f[0]) | ((r[0] == f[0]) & (r[1] < f[1]))
            for name, a, b in zip(("score", "begin", "end"), f[:3], r[:3], strict=True):
                pdf[name] = np.where(back, b, a).astype("int32")
            pdf["strand"] = np.where(pdf["score"] == 0, ".", np.where(back, "-", "+"))
            pdf["accepted"] = pdf["score"] >= least
            yield pdf

    rest = [c for c in reads.columns if c != seq]
    schema = ", ".join(f"{c} {t}" for c, t in reads.dtypes if c != seq)
    return reads.mapInPandas(run, f"{schema}, score int, begin int, end int, strand string, accepted boolean").select(*rest, "score", "begin", "end", "strand", "accepted")


def tag_lengths(reads: DataFrame, linker: str, least: int = MIN_TAG) -> DataFrame:
    """Per read the lengths of the tags on both sides of the first exact linker, and how many are long enough."""
    at = F.instr("seq", linker)
    left = F.when(at > 0, at - 1).otherwise(F.length("seq"))
    right = F.when(at > 0, F.length("seq") - at + 1 - len(linker)).otherwise(F.lit(0))
    return reads.select("read_id", left.alias("left"), right.alias("right"), ((left >= least).cast("int") + (right >= least).cast("int")).alias("tags"))
