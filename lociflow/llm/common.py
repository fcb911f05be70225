"""Helpers that several corpus operators share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# The white space that separates words.
SPACE_CLASS = r"\x20\x09-\x0D"
WORD_PATTERN = rf"[^{SPACE_CLASS}]+"
SPACE_BYTES = (32, 9, 10, 11, 12, 13)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

U64 = np.uint64


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir; where unset and all runs in one process, as in tests,
    one of our own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        folder = tempfile.mkdtemp(prefix="lociflow-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage by a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Writes a table to the shared folder and reads it back: columnar, and its real size is known to the planner."""
    path = f"{shared_dir(df.sparkSession)}/lociflow-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, **sums: Column) -> tuple[DataFrame, dict[str, int]]:
    """Like `stored`, and what the written rows add up to: `rows`, and each of `sums`. They're observed as the rows are
    written, so that a loop's end costs no job of its own."""
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows"), *(F.coalesce(F.sum(c), F.lit(0)).alias(k) for k, c in sums.items())]
    out = stored(df.observe(seen, *metrics))
    return out, seen.get


def in_small_batches(docs: DataFrame) -> DataFrame:
    """Bounds what Arrow sends to Python at a time: rows hold whole texts, and 10,000 of them are too many for a worker.

    Plans run after this returns, so the session keeps the bounds; smaller ones of its own stay."""
    conf = docs.sparkSession.conf
    for name, most in (("maxRecordsPerBatch", 1000), ("maxBytesPerBatch", 8 << 20)):
        now = conf.get(f"spark.sql.execution.arrow.{name}")
        if not (now.isdigit() and 0 < int(now) <= most):
            conf.set(f"spark.sql.execution.arrow.{name}", str(most))
    return docs


@contextlib.contextmanager
def shared_files(folder: str, number: int) -> Iterator[tuple[Callable[[int], pa.NativeFile], Callable[[int], pa.NativeFile]]]:
    """In a task: what creates and what opens sequential files of the shared folder, which are removed at the end."""
    local = folder.startswith(("/", "file:"))
    system, path = (LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")) if local else FileSystem.from_uri(folder)
    name = f"{path}/lociflow-{uuid.uuid4().hex}"
    try:
        yield lambda k: system.open_output_stream(f"{name}-{k}", buffer_size=1 << 20), lambda k: system.open_input_stream(f"{name}-{k}", buffer_size=1 << 20)
    finally:
        for k in range(number):
            with contextlib.suppress(FileNotFoundError):
                system.delete_file(f"{name}-{k}")


def whole(text: Column | str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def utf8(text: Column) -> Column:
    return text.cast("binary")


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of an Arrow string or binary column in a row, and len + 1 offsets into them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


#: Bytes of text that are worked on together: few enough to stay in the cache.
BLOCK = 1 << 18


def blocks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts of about BLOCK bytes, one text at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(offsets, offsets[i] + BLOCK, "right")) - 1))
        yield i, j
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(29))
    x = x * U64(0xFF51AFD7ED558CCD)
    return x ^ (x >> U64(32))


BYTE_VALUES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
LOWER_VALUES = BYTE_VALUES.copy()
LOWER_VALUES[65:91] = BYTE_VALUES[97:123]
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACE_BYTES)] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base ** 0 .. base ** n modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        have = np.full(max(n + 1, 1 << 16), base, np.uint64)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have[: n + 1]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values[i] * base ** i, modulo 2 ** 64; see span_hash."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[: len(values)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of values[start:end] that doesn't depend on where the span lies."""
    return mix((prefix[end] - prefix[start]) * powers(len(prefix), _INVERSE)[start] + (end - start).astype(np.uint64) * U64(0xA24BAED4963EE407))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts, and len + 1 offsets of each text's words."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    letter = ~IS_SPACE[data]
    starts_at = letter.copy()
    starts_at[1:] &= ~letter[:-1]
    ends_at = letter.copy()
    ends_at[:-1] &= ~letter[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    starts_at[edges] = letter[edges]
    ends_at[edges - 1] = letter[edges - 1]
    starts, ends = np.flatnonzero(starts_at), np.flatnonzero(ends_at) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts, features of them, and len + 1 offsets of each text's words.

    The features are polynomials modulo 2 ** 64, under which certain long words are alike: fit for statistics only. What
    must tell words apart takes `word_hashes`."""
    starts, ends, at = word_spans(data, offsets)
    prefix = prefix_hash((LOWER_VALUES if lower else BYTE_VALUES)[data])
    return starts, ends, span_hash(prefix, starts, ends), at


#: Places of a word that have values of their own for each letter.
PLACES = 64
_letters = np.random.default_rng(5 * 20240229).integers(0, 2**64, (2, PLACES * 256), dtype=np.uint64)
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32


def _letters_of(data: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The letters of spans in a row, and of each its span and its place there."""
    own = np.cumsum(size, dtype=np.int32) - size.astype(np.int32)
    span = np.repeat(np.arange(len(size), dtype=np.int32), size)
    place = np.arange(len(span), dtype=np.int32) - own[span]
    return data[starts[span] + place], span, place


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False, kinds: tuple[int, ...] = (0,)) -> list[np.ndarray]:
    """64-bit hashes of words, one for each of `kinds` (0, 1), which are independent.

    A letter has a random value for each place of a word, and a word their sum; from place to place further on the values come
    again, multiplied by a random odd number for each PLACES. No algebra of places makes two words alike. Few words are
    worked on together, since a letter takes tens of bytes meanwhile."""
    size = ends - starts
    out = [np.zeros(len(size), np.uint64) for _ in kinds]
    edges = np.concatenate(([0], np.cumsum(size)))
    for i, j in blocks(edges):
        letters, _, place = _letters_of(data, starts[i:j], size[i:j])
        index = (place & (PLACES - 1)) << 8 | (_lower[letters] if lower else letters)
        far = np.flatnonzero(place >= PLACES)
        for kind, found in zip(kinds, out, strict=True):
            value = _letters[kind][index]
            if len(far):
                value[far] *= mix((place[far] >> 6).astype(np.uint64) * U64(0x9E3779B97F4A7C15 + 2 * kind)) | U64(1)
            found[i:j] = mix(np.add.reduceat(value, edges[i:j] - edges[i]) + size[i:j].astype(np.uint64) * U64(0xA24BAED4963EE407))
    return out
