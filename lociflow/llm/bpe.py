"""Byte-level BPE by recursive DuckDB queries.

Spark splits the texts by the tokenizer's pattern; each task hands their distinct words to DuckDB. There, rows (word,
position, token) join the merge table, and a recursive query contracts each word's pair of least rank, the leftmost first, until no pair
is left; a word that is a token of the vocabulary comes in as that token. Ordered aggregation turns a word's tokens back
into bytes. A task's documents are then put together from their words.

Whatever a merge makes is a token, and occurs in the word at its place. So a word falls apart wherever no token of the
vocabulary that occurs in it lies over a border (found by an automaton of all tokens), and only the parts, most of a few letters,
go through the query; equal parts of different words are worked out once. A step contracts all of a part's pairs of its least rank,
which are next one after the other anyway; of a run of pairs of equal tokens (aaaa) every other; and none
behind one whose token makes another of a lower rank with its neighbours, which comes first then. So steps are as many as ranks that a part
contracts, not as letters.

A worker remembers words: those that come again after their batch are settled, the others are forgotten when they are too many.
It remembers parts too, of which new words mostly consist, and forgets those that were not met for long.
DuckDB holds all in memory (MEMORY a worker) and never spills: a part of several million letters without a border is more than
that, and ends with DuckDB's error.

Defined results: null counts as empty, and an empty text has no tokens; null or repeated doc_ids keep a row each; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociflow.llm.common import in_small_batches, whole

#: Letters that one recursive query takes, and settled and new words that a Python worker remembers.
QUERY_LETTERS, SETTLED_WORDS, NEW_WORDS = 100_000, 150_000, 100_000
#: Parts that a worker remembers before those not met since the last time go, and the most bytes of one.
KNOWN_PARTS, PART_BYTES = 60_000, 64
#: Matches of tokens that are counted together, and letters, no bytes, that part words and their parts meanwhile.
MATCHES, GAP, EDGE = 1 << 14, "\u0100", "\u0101"
MEMORY = "600MB"

# A step contracts pairs of least rank. Positions and sizes count bytes; kind is 0 for pairs of different tokens, 1 for equal
# ones, of which neighbours overlap. Of 2 and 3, the same, the vocabulary has tokens of a lower rank with the pair's token as a
# part: of 2 all go up to the first whose neighbours make such a token, of 3 one at a time.
CONTRACT = """
WITH RECURSIVE step(word, pos, size, token, done) AS (
    SELECT word, pos, 1, token, false FROM start
  UNION ALL
    (WITH live AS MATERIALIZED (SELECT * FROM step WHERE NOT done),
     paired AS MATERIALIZED (
        SELECT a.word, a.pos, b.pos AS next_pos, b.size AS next_size, m.rank, m.kind
        FROM live a
        JOIN live b ON b.word = a.word AND b.pos = a.pos + a.size
        JOIN merges m ON m.first = a.token AND m.second = b.token),
     least AS MATERIALIZED (SELECT word, min(rank) AS rank FROM paired GROUP BY word),
     hits AS MATERIALIZED (SELECT p.* FROM paired p JOIN least l ON l.word = p.word AND l.rank = p.rank),
     counted AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY pos) AS nth FROM hits WHERE kind IN (1, 3)),
     near AS MATERIALIZED (
        SELECT h.word, h.pos, h.rank, p.token AS before, n.token AS after FROM hits h
        LEFT JOIN live p ON p.word = h.word AND p.pos + p.size = h.pos
        LEFT JOIN live n ON n.word = h.word AND n.pos = h.next_pos + h.next_size
        WHERE h.kind = 2),
     stops AS (
        SELECT word, min(pos) AS pos FROM (
            SELECT s.word, s.pos FROM near s JOIN merges m ON m.first = s.before AND m.second = s.rank AND m.rank < s.rank
          UNION ALL
            SELECT s.word, s.pos FROM near s JOIN merges m ON m.first = s.rank AND m.second = s.after AND m.rank < s.rank
          UNION ALL
            SELECT s.word, s.pos FROM near s JOIN merges m ON m.first = s.rank AND m.second = s.rank AND m.rank < s.rank)
        GROUP BY word),
     chosen AS MATERIALIZED (
        SELECT h.word, h.pos, next_pos, next_size, rank FROM hits h LEFT JOIN stops s ON s.word = h.word WHERE kind = 0 OR (kind = 2 AND (s.pos IS NULL OR h.pos <= s.pos))
      UNION ALL
        SELECT word, pos, next_pos, next_size, rank FROM counted
        QUALIFY CASE kind WHEN 1 THEN row_number() OVER (PARTITION BY word, pos - nth * (next_pos - pos) ORDER BY pos) % 2 = 1 ELSE nth = 1 END)
     SELECT l.word, l.pos, l.size + coalesce(c.next_size, 0), coalesce(c.rank, l.token), x.word IS NULL
     FROM live l
     LEFT JOIN least x ON x.word = l.word
     LEFT JOIN chosen c ON c.word = l.word AND c.pos = l.pos
     ANTI JOIN chosen g ON g.word = l.word AND g.next_pos = l.pos)
)
SELECT word, pos, token FROM step WHERE done
"""


def _runs(items: list, letters: Callable[[Any], int]) -> Iterator[list]:
    """Runs of items of QUERY_LETTERS together, or one longer item."""
    some, total = [], 0
    for x in items:
        n = letters(x)
        if some and total + n > QUERY_LETTERS:
            yield some
            some, total = [], 0
        some.append(x)
        total += n
    if some:
        yield some


class Bpe:
    """The vocabulary of one rank file in a DuckDB connection."""

    def __init__(self, path: str):
        import ahocorasick
        import duckdb

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.bytes_of = {r: b for b, r in self.ranks.items()}
        first, second, rank, alone = [], [], [], set()
        self.tokens = ahocorasick.Automaton()
        for token, r in self.ranks.items():
            if len(token) > 1:
                self.tokens.add_word(token.decode("latin-1"), len(token))
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    first.append(a)
                    second.append(b)
                    rank.append(r)
                    # A pair that this token's part makes later than the token: contract such pairs one at a time.
                    alone.update(x for x in (a, b) if x >= r)
        self.tokens.make_automaton()
        kind = [2 * (r in alone) + int(a == b) for a, b, r in zip(first, second, rank, strict=True)]
        db = self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
        for name, table in (
            ("merges", pa.table({n: pa.array(v, pa.int32()) for n, v in (("first", first), ("second", second), ("rank", rank), ("kind", kind))})),
            ("vocabulary", pa.table({"token": pa.array(list(self.bytes_of), pa.int32()), "bytes": pa.array(list(self.bytes_of.values()), pa.binary())})),
        ):
            db.register("given", table)
            db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            db.unregister("given")
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        # Ids of parts as bytes: met lately, and before; and what a part decodes to where that isn't the part itself.
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.odd_parts: dict[str, bytes] = {}
        # Ids of known words as bytes, and what a word decodes to where that isn't the word itself.
        self.settled: dict[str, bytes] = {}
        self.new: dict[str, bytes] = {}
        self.odd: dict[str, bytes] = {}

    def parts(self, words: list[bytes]) -> list[list[str]]:
        """Each word between the borders over which no token lies. A part has a letter for each byte."""
        out = [[w.decode("latin-1")] for w in words]
        cut = [k for k, w in enumerate(words) if len(w) > 1 and w not in self.ranks]
        for some in _runs(cut, lambda k: len(words[k])):
            raw = GAP.join([out[k][0] for k in some])
            change = np.zeros(len(raw) + 2, np.int64)
            found = itertools.chain.from_iterable(self.tokens.iter(raw))
            while len(ends := (matches := np.fromiter(itertools.islice(found, 2 * MATCHES), np.int64))[::2]):
                starts = ends - matches[1::2] + 2  # the border before the token's second letter
                for borders, by in ((starts, 1), (ends + 1, -1)):
                    low = borders.min()
                    number = np.bincount(borders - low)
                    change[low : low + len(number)] += by * number
            edges = np.flatnonzero(np.cumsum(change[:-2]) == 0)[1:]
            letters = np.insert(np.frombuffer(raw.encode("utf-16-le"), np.uint16), edges, ord(EDGE))
            for k, parted in zip(some, letters.tobytes().decode("utf-16-le").split(EDGE + GAP + EDGE), strict=True):
                out[k] = parted.split(EDGE)
        return out

    def learn(self, words: list[str]) -> None:
        """Encodes and decodes words."""
        raws = [w.encode("utf-8", "surrogatepass") for w in words]
        split = self.parts(raws)
        known: dict[str, bytes] = {}
        fresh = []
        for p in dict.fromkeys(itertools.chain.from_iterable(split)):
            ids = self.recent.get(p)
            if ids is None:
                ids = self.older.get(p)
            if ids is None:
                fresh.append(p)
            else:
                known[p] = ids
        for some in _runs(fresh, len):
            plain = [p.encode("latin-1") for p in some]
            ids, pieces, edges = self.contract(plain)
            data = ids.tobytes()
            known.update((p, data[4 * a : 4 * b]) for p, a, b in zip(some, edges[:-1], edges[1:], strict=True))
            if b"".join(pieces) != b"".join(plain):
                backs = (b"".join(pieces[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True))
                self.odd_parts.update((p, back) for p, own, back in zip(some, plain, backs, strict=True) if back != own)
        for word, raw, ps in zip(words, raws, split, strict=True):
            self.new[word] = known[ps[0]] if len(ps) == 1 else b"".join([known[p] for p in ps])
            if self.odd_parts and (back := b"".join([self.odd_parts.get(p) or p.encode("latin-1") for p in ps])) != raw:
                self.odd[word] = back
        self.recent.update((p, ids) for p, ids in known.items() if len(p) <= PART_BYTES)
        if len(self.recent) > KNOWN_PARTS:
            self.older, self.recent = self.recent, {}

    def contract(self, words: list[bytes]) -> tuple[np.ndarray, list[bytes], list[int]]:
        """Token ids and bytes of all words in a row, and len + 1 offsets of each word's."""
        whole = [self.ranks.get(w, -1) for w in words]
        sizes = np.array([len(w) if t < 0 else 1 for w, t in zip(words, whole, strict=True)])
        at = np.repeat(np.cumsum(sizes) - sizes, sizes)
        given = np.repeat(np.array(whole, np.int32), sizes)
        given[given < 0] = self.byte_ids[np.frombuffer(b"".join([w for w, t in zip(words, whole, strict=True) if t < 0]), np.uint8)]
        start = pa.table(
            {
                "word": pa.array(np.repeat(np.arange(len(words), dtype=np.int32), sizes)),
                "pos": pa.array((np.arange(sizes.sum()) - at).astype(np.int32)),
                "token": pa.array(given),
            }
        )
        self.db.register("given", start)
        self.db.execute("CREATE OR REPLACE TEMP TABLE start AS SELECT * FROM given")
        self.db.unregister("given")
        found = self.db.sql(
            f"SELECT list(e.token ORDER BY pos) AS ids, list(v.bytes ORDER BY pos) AS back FROM ({CONTRACT}) e JOIN vocabulary v ON v.token = e.token GROUP BY word ORDER BY word"
        ).to_arrow_table()
        ids, parts = found["ids"].combine_chunks(), found["back"].combine_chunks()
        return ids.flatten().to_numpy().astype("<u4"), parts.flatten().to_pylist(), ids.offsets.to_numpy().tolist()

    def find(self, words: list[str]) -> list[bytes]:
        """The ids of words. Words met again are settled."""
        settled, new = self.settled, self.new
        fresh = []
        for w in words:
            if w not in settled:
                if w not in new:
                    fresh.append(w)
                elif len(settled) < SETTLED_WORDS:
                    settled[w] = new.pop(w)
        if fresh:
            self.learn(fresh)
        found = [settled[w] if w in settled else new[w] for w in words]
        if len(new) > NEW_WORDS:
            self.new = {}
        return found


_open: dict[str, Bpe] = {}


def tokenizer(path: str) -> Bpe:
    """One for each Python worker."""
    if path not in _open:
        _open[path] = Bpe(path)
    return _open[path]


def _spans(values: pa.Array, edges: np.ndarray) -> list[memoryview]:
    """Of a binary array's values: those from edges[i] to edges[i + 1], one after the other."""
    ends = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1]
    data = memoryview(values.buffers()[2] or b"")
    at = ends[edges].tolist()
    return [data[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def encode(docs: DataFrame, path: str, pattern: str, with_tokens: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, and with_tokens also ids and decoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                lists = part.column(1)
                coded = lists.flatten().dictionary_encode()
                edges = lists.offsets.to_numpy() - lists.offsets[0].as_py()
                known = coded.dictionary.to_pylist()
                ids = pa.array(bpe.find(known), pa.binary()).take(coded.indices)
                back = coded.dictionary.cast(pa.binary())
                if bpe.odd:
                    back = pa.array([bpe.odd.get(w, raw) for w, raw in zip(known, back.to_pylist(), strict=True)], pa.binary())
                back = back.take(coded.indices)
                own, decoded = _spans(ids, edges), _spans(back, edges)
                columns = {
                    "doc_id": part.column(0),
                    "n_tokens": pa.array([len(x) // 4 for x in own], pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in own], pa.string()),
                    "decoded_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string()),
                }
                if with_tokens:
                    columns |= {"ids": pa.array([np.frombuffer(x, "<u4").astype(np.int64) for x in own], pa.list_(pa.int64())), "decoded": pa.array([bytes(x) for x in decoded], pa.binary())}
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    kinds = dict(docs.dtypes)
    schema = f"doc_id {kinds['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<long>, decoded binary" if with_tokens else "")
    # (?U): white space as Unicode has it. The pattern's matches leave nothing of a text out.
    words = F.regexp_extract_all(whole("text"), F.lit(f"(?U){pattern}"), F.lit(0))
    return in_small_batches(docs).select("doc_id", words.alias("words")).mapInArrow(run, schema)
