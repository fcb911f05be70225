"""Chat formatting with offset-aligned loss masks.

Turns are sorted by conversation and turn over ranges, so that a conversation of any size is spread over tasks. A task puts a
conversation's turns together by the template, encodes the whole of it once, and takes the tokens' offsets from their lengths in bytes.
Spans of the turns to learn from are sorted and so are the tokens' spans: binary searches give each turn's run of tokens.

The template marks a turn by control strings, which the tokenizer has as special tokens. In texts and roles every backslash is
doubled, and where a control string starts a backslash follows its first letter; so no text holds a control string, tokens never
reach over a turn's border, and dropping each first backslash gives the text back.

A conversation is one row, or several numbered parts: where a range ends inside it, and after PART bytes. Parts end
between turns, where tokens do too, so the encoding of the whole is that of its parts in a row.

Defined results: a null text or role is empty; an empty text is a turn without tokens; turns with the same number are ordered by role and
text, repeated rows all stay; rows without a number come first; rows without conv_id are one conversation; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociflow.llm.common import in_small_batches, stored, whole

#: Bytes after which a conversation goes on in a further part.
PART = 1 << 20


@dataclass(frozen=True)
class Template:
    """Control strings: each starts with a letter that it doesn't hold again, the same for all, and none is another's start."""

    turn: str = "<turn>"
    says: str = "<says>"
    end: str = "</turn>"
    learn: str = "assistant"

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.turn, self.says, self.end

    def __post_init__(self) -> None:
        first = self.turn[:1]
        if not first or any(m[:1] != first or first in m[1:] or "\\" in m or any(m != o and o.startswith(m) for o in self.marks) for m in self.marks):
            raise ValueError("control strings must start with one letter that comes in them once, and hold no backslash")

    def escaped(self, text: Column) -> Column:
        starts = "|".join(re.escape(m[1:]) for m in self.marks)
        return F.regexp_replace(text, rf"\\|{re.escape(self.turn[0])}(?=(?:{starts}))", r"$0\\")

    def turns(self, formatted: str) -> list[tuple[str, str]]:
        """Roles and texts of a formatted conversation."""
        a, b, c = map(re.escape, self.marks)
        return [(unescaped(role), unescaped(text)) for role, text in re.findall(f"{a}(.*?){b}(.*?){c}", formatted, re.DOTALL)]


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


class Tokens:
    """A rank file's tokenizer with the template's control strings as special tokens."""

    def __init__(self, path: str, pattern: str, marks: tuple[str, ...]):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        top = max(ranks.values()) + 1
        special = {m: top + k for k, m in enumerate(marks)}
        self.marks = frozenset(marks)
        self.encoding = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self.bytes_of = [b""] * (top + len(marks))
        for token, rank in (*ranks.items(), *((m.encode(), r) for m, r in special.items())):
            self.bytes_of[rank] = token
        self.sizes = np.array([len(t) for t in self.bytes_of], np.int64)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and len + 1 offsets in bytes."""
        ids = np.array(self.encoding.encode(text, allowed_special=set(self.marks)), np.int32)
        return ids, np.concatenate(([0], np.cumsum(self.sizes[ids])))

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids.tolist()])


_open: dict[tuple, Tokens] = {}


def tokens(path: str, pattern: str, marks: tuple[str, ...]) -> Tokens:
    """One for each Python worker."""
    key = (path, pattern, marks)
    if key not in _open:
        _open[key] = Tokens(*key)
    return _open[key]


def aligned(offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of each token [offsets[i], offsets[i + 1]) whether it shares a byte with one of the sorted spans [starts, ends)."""
    some = ends > starts
    first = np.searchsorted(offsets[1:], starts[some], "right")
    last = np.searchsorted(offsets[:-1], ends[some], "left")
    change = np.zeros(len(offsets), np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, last, -1)
    return np.cumsum(change)[:-1] > 0


PARTS = "part long, complete boolean, formatted string, ids array<int>, learnt array<boolean>"


def _formatted(path: str, pattern: str, template: Template):
    """Sorted turns to parts of conversations. complete: the part is known to be its whole conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokens(path, pattern, template.marks)
        number = TaskContext.get().partitionId() << 32
        kind = pa.null()

        def part(key: object, turns: list[tuple[str, str]], complete: bool) -> pa.RecordBatch:
            nonlocal number
            pieces, starts, ends, at = [], [], [], 0
            for role, text in turns:
                head = f"{template.turn}{role}{template.says}"
                if role == template.learn:
                    starts.append(at + len(head.encode()))
                    ends.append(starts[-1] + len(text.encode()))
                pieces.append(f"{head}{text}{template.end}")
                at += len(pieces[-1].encode())
            formatted = "".join(pieces)
            ids, offsets = own.encode(formatted)
            learnt = aligned(offsets, np.array(starts, np.int64), np.array(ends, np.int64))
            number += 1
            columns = [pa.array([key], kind), pa.array([number]), pa.array([complete]), pa.array([formatted]), pa.array([ids], pa.list_(pa.int32())), pa.array([learnt], pa.list_(pa.bool_()))]
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "part", "complete", "formatted", "ids", "learnt"])

        key, turns, size, begun, parts = None, [], 0, False, 0
        for batch in batches:
            kind = batch.schema.field(0).type
            for now, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if begun and now != key:
                    # The range's first conversation may have begun before it.
                    yield part(key, turns, parts > 0 and not split)
                    key, turns, size, parts, split = now, [], 0, parts + 1, False
                elif not begun:
                    key, begun, split = now, True, False
                elif size > PART:
                    yield part(key, turns, False)
                    turns, size, split = [], 0, True
                turns.append((role, text))
                size += len(role) + len(text)
        if turns:
            yield part(key, turns, False)

    return run


def format_conversations(turns: DataFrame, path: str, pattern: str, template: Template | None = None) -> DataFrame:
    """conv_id, part, complete, formatted, ids, learnt: formatted conversations, their tokens, and which of those to learn from.

    Parts of a conversation in their order make up the whole of it."""
    template = template or Template()
    kind = dict(turns.dtypes)["conv_id"]
    rows = in_small_batches(turns).select("conv_id", "turn", whole("role").alias("role"), whole("text").alias("text"))
    rows = rows.withColumn("_hash", F.xxhash64("text"))
    keys = ["conv_id", "turn", "role"]
    # The row's place comes last, so that equal rows don't all fall into one range.
    rows = rows.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(*keys, "_hash", "_at").sortWithinPartitions(*keys, "text", "_at")
    rows = rows.select("conv_id", template.escaped(F.col("role")).alias("role"), template.escaped(F.col("text")).alias("text"))
    return rows.mapInArrow(_formatted(path, pattern, template), f"conv_id {kind}, {PARTS}")


class _Digest:
    """What is read back from a conversation's parts."""

    def __init__(self) -> None:
        self.turns = self.letters = self.learnt = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, ids: np.ndarray, learnt: np.ndarray, own: Tokens, template: Template) -> None:
        for role, text in template.turns(formatted):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        self.letters += len(formatted)
        text = unescaped(own.decode(ids[learnt]).decode())
        self.learnt += len(text)
        self.loss.update(text.encode())

    def values(self) -> list:
        return [self.turns, self.all.hexdigest(), self.learnt, self.loss.hexdigest(), self.letters]


DIGESTS = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """conv_id, complete, and what a digest takes, of each part."""
    for k in range(batch.num_rows):
        row = [batch.column(c)[k] for c in ("conv_id", "complete", "formatted", "ids", "learnt")]
        yield row[0].as_py(), row[1].as_py(), row[2].as_py(), row[3].values.to_numpy(), row[4].values.to_numpy(zero_copy_only=False)


def _table(kind: pa.DataType, keys: list, rows: list[list]) -> pa.RecordBatch:
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(keys, kind), *(pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True))], ["conv_id", *names])


def _read_back(path: str, pattern: str, template: Template):
    """Digests of complete conversations; parts of the others go through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokens(path, pattern, template.marks)
        for batch in batches:
            digests = []
            for _, complete, *content in _rows(batch):
                digest = _Digest()
                if complete:
                    digest.add(*content, own, template)
                digests.append(digest.values() if complete else [None] * 5)
            if not digests:
                continue
            through = pa.compute.invert(batch.column("complete"))
            content = [pa.compute.if_else(through, batch.column(c), pa.scalar(None, batch.schema.field(c).type)) for c in ("formatted", "ids", "learnt")]
            done = _table(batch.schema.field(0).type, batch.column(0).to_pylist(), digests)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *content, *done.columns[1:]], [*batch.schema.names, *done.schema.names[1:]])

    return run


def _streamed(path: str, pattern: str, template: Template):
    """Digests of conversations whose parts come in order; one part is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokens(path, pattern, template.marks)
        key, digest, kind = None, None, pa.null()
        for batch in batches:
            kind = batch.schema.field(0).type
            for now, _, *content in _rows(batch):
                if digest is not None and now != key:
                    yield _table(kind, [key], [digest.values()])
                    digest = None
                key, digest = now, digest or _Digest()
                digest.add(*content, own, template)
        if digest is not None:
            yield _table(kind, [key], [digest.values()])

    return run


def digests(turns: DataFrame, path: str, pattern: str, template: Template | None = None) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from the formatted conversations.

    A digest takes its conversation from the start to the end: parts of those that more than one range holds are streamed in
    order, a row for each part."""
    template = template or Template()
    kind = dict(turns.dtypes)["conv_id"]
    parts = format_conversations(turns, path, pattern, template)
    read = stored(parts.mapInArrow(_read_back(path, pattern, template), f"conv_id {kind}, {PARTS}, {DIGESTS}"))
    names = [part.split()[0] for part in DIGESTS.split(", ")]
    rest = read.where("NOT complete").select("conv_id", "part", "complete", "formatted", "ids", "learnt").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return read.where("complete").select("conv_id", *names).union(rest.mapInArrow(_streamed(path, pattern, template), f"conv_id {kind}, {DIGESTS}"))


def with_sample(turns: DataFrame) -> DataFrame:
    """The turns and conversation -7, whose texts hold control strings."""
    kinds = dict(turns.dtypes)
    names = ["conv_id", "turn", "role", "text"]
    said = r"\### Assistant: </turn> ok"
    sample = turns.sparkSession.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return turns.select(*names).union(sample.select(*(F.col(n).cast(kinds[n]) for n in names)))
