"""Edge cases and brute-force versions of the operators over documents."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PASSAGE = " ".join(f"shared{i} word" for i in range(60))


def rows():
    """Nulls, empty and long texts, ties, repeated rows, copies and passages."""
    r = np.random.default_rng(3)
    prose = lambda n: " ".join("".join(r.choice(list("abcdefghé"), r.integers(1, 8))) for _ in range(n))
    base = prose(120)
    near = base.split(" ")
    near[5] = "changed"
    out = [
        (1, base, "a"), (2, base, None), (3, " ".join(near), "a"), (4, base.upper(), "a"), (5, None, None), (6, "", "b"), (7, "  \t\n ", "b"), (8, "one", "b"), (9, "One", "b"),
        (10, "one  two", "b"), (11, "one\ttwo", "a"), (12, prose(40) + " " + PASSAGE + " " + prose(40), "a"), (13, prose(30) + "\n" + PASSAGE + " " + prose(60), "c"), (14, "x" * 5000, "c"),
        (15, "ab " * 3000, "c"), (16, "ab " * 3000, "c"), (16, "ab " * 3000, "c"), (None, base, "a"), (None, None, None), (17, "a", "a"), (18, prose(3000), "d"), (19, "😀 é\x1c\u00a0x ñ'll 12,5\n\n", "e"),
    ]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    schema = "doc_id long, text string, source string, score double, kept string, shard string, n long, id string, size string, key string, piece string, bucket string, component_id string"
    return spark.createDataFrame([(d, t, s, 0.5, "k", "s", 1, "i", "z", "y", "p", "b", "c") for d, t, s in rows()], schema).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_exact_dedup(docs, empty):
    from lociflow.llm.exact_dedup import dedup, judge

    got = judge(docs).collect()
    assert len(got) == len(rows())
    by = defaultdict(list)
    for d, t, _ in rows():
        by[norm(t)].append(d)
    seen = Counter()
    for d, t, _ in rows():
        ids = [x for x in by[norm(t)] if x is not None]
        mine = [g for g in got if g.doc_id == d and g.text_sha256 == hashlib.sha256(norm(t).encode()).hexdigest()]
        assert {(g.keep_id, g.group_size) for g in mine} == {(min(ids) if ids else None, len(by[norm(t)]))}
        seen[norm(t)] = sum(g.kept for g in got if g.text_sha256 == hashlib.sha256(norm(t).encode()).hexdigest())
    assert set(seen.values()) == {1}
    left = dedup(docs)
    assert left.columns == docs.columns
    assert sorted(norm(r.text) for r in left.collect()) == sorted(by)
    assert judge(empty).count() == 0 and dedup(empty).count() == 0


def test_fingerprints_compose():
    from lociflow.llm import exact_dedup as E

    data = np.random.default_rng(1).integers(0, 256, 3 * E.CHUNK + 17).astype(np.uint8)
    a, b, _, _ = E.fingerprints(data, np.array([0, len(data)]))
    for cut in (0, 1, E.CHUNK, len(data) - 5):
        x, y, _, _ = E.fingerprints(data, np.array([0, cut, len(data)]))
        assert E.combine((int(x[0]), int(y[0])), (int(x[1]), int(y[1])), len(data) - cut) == (int(a[0]), int(b[0]))
    by_hand = 0
    for byte in data[:1000].tolist():
        by_hand = (by_hand * E.BASES[0] + byte + 1) % E.PRIMES[0]
    assert int(E.fingerprints(data[:1000], np.array([0, 1000]))[0][0]) == by_hand


def sets(width):
    out = {}
    for k, (_, t, _) in enumerate(rows()):
        w = WORD.findall((t or "").translate(LOWER))
        out[k] = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    return out


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_dedup(docs, empty, width, percent):
    from lociflow.llm.near_dedup import dedup, link

    s, data = sets(width), rows()
    root = {k: k for k in s}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in s:
        for y in s:
            if x < y and s[x] and s[y] and 100 * len(s[x] & s[y]) >= percent * len(s[x] | s[y]):
                root[find(y)] = find(x)
    want = Counter()
    for x in s:
        ids = [data[y][0] for y in s if find(y) == find(x) and data[y][0] is not None]
        component = (min(ids) if ids else None) if s[x] else data[x][0]
        want[data[x][0], len(s[x]), component] += 1
    got = link(docs, width, percent).collect()
    assert Counter((g.doc_id, g.n_shingles, g.component_id) for g in got) == want
    assert all(g.kept == (g.component_id is None or g.doc_id == g.component_id) for g in got)
    kept = dedup(docs, width, percent)
    assert kept.columns == docs.columns
    # One row of each component: its smallest doc_id, and one of repeated rows; texts without words stay.
    left = defaultdict(list)
    for r in kept.collect():
        k = next(k for k in s if (data[k][0], data[k][1]) == (r.doc_id, r.text))
        left[find(k)].append(r.doc_id) if s[k] else None
    for x in s:
        if s[x] and find(x) == x:
            ids = [data[y][0] for y in s if find(y) == x and data[y][0] is not None]
            assert left[x] == [min(ids) if ids else None]
    assert kept.where("text IS NULL OR trim(text) IN ('', '\\t\\n')").count() == sum(1 for _, t, _ in data if not (t or "").strip())
    assert link(empty, width, percent).count() == 0 and dedup(empty, width, percent).count() == 0


def test_near_dedup_of_repeated_and_missing_ids(spark):
    """An id with another text, and a row without id, link as others do."""
    from lociflow.llm.near_dedup import dedup, link

    text = [f"word{i}" for i in range(300)]
    changed, other = list(text), [f"else{i}" for i in range(300)]
    changed[7] = "changed"
    rows = [(2, " ".join(text)), (5, " ".join(changed)), (5, " ".join(other)), (None, " ".join(changed[:299])), (None, " ".join(other[:299])), (None, "quite alone"), (None, "quite alone")]
    docs = spark.createDataFrame([(d, t, "x", "y", "z", 1) for d, t in rows], "doc_id long, text string, _doc_id string, hash_a string, row string, root int")
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in link(docs).collect())
    assert got == Counter([(2, 296, 2, True), (5, 296, 2, False), (5, 296, 5, True), (None, 295, 2, False), (None, 295, 5, False), (None, 1, None, True), (None, 1, None, True)])
    kept = dedup(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([(2, rows[0][1]), (5, rows[2][1]), (None, "quite alone")])


def test_near_dedup_of_a_group_without_a_centre(spark):
    """Members of one group that are mostly not linked, none of them equal: links of an exact search, and few comparisons."""
    from lociflow.llm import near_dedup

    r = np.random.default_rng(8)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for k in range(160):
        t = list(base)
        for i in r.choice(150, int(r.integers(2, 9)), replace=False):
            t[i] = f"v{r.integers(0, 40)}"
        texts.append(t if k % 5 else list(texts[-1][:149]) if texts else t)
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    s = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    root = list(range(len(s)))
    for x in range(len(s)):
        for y in range(x):
            if 100 * len(s[x] & s[y]) >= 80 * len(s[x] | s[y]):
                a, b = root[x], root[y]
                root = [min(a, b) if q in (a, b) else q for q in root]
    assert 20 < len(set(root)) < 150
    assert [g.component_id for g in near_dedup.link(docs).orderBy("doc_id").collect()] == root


def test_near_dedup_finds_links_away_from_the_leader(spark):
    """Variants that aren't linked with their base, but with each other."""
    from lociflow.llm.near_dedup import link

    base = [f"w{i}" for i in range(200)]
    texts = [list(base) for _ in range(12)]
    for k in range(2, 12):
        for i in range(10, 10 + 12 * (k // 2), 4):
            texts[k][i] = f"v{k // 2}x{i}"
    for k in range(3, 12, 2):
        texts[k][150] = f"own{k}"
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    s = [{tuple(t[i : i + 3]) for i in range(198)} for t in texts]
    root = list(range(12))
    for x in range(12):
        for y in range(x):
            if 100 * len(s[x] & s[y]) >= 85 * len(s[x] | s[y]):
                a, b = root[x], root[y]
                root = [min(a, b) if r in (a, b) else r for r in root]
    assert len(set(root)) > 2
    assert [r.component_id for r in link(docs, 3, 85).orderBy("doc_id").collect()] == root


def test_sketches_merge_and_estimate():
    from lociflow.llm.near_dedup import likeliest, registers

    r = np.random.default_rng(2)
    h = r.integers(0, 2**63, 4000, dtype=np.uint64)
    one, two, both = registers(h[:3000], np.array([0, 3000])), registers(h[1000:], np.array([0, 3000])), registers(h, np.array([0, 4000]))
    assert (np.maximum(one, two) == both).all()
    assert abs(float(likeliest(one, two, np.array([3000.0]), np.array([3000.0]))[0]) - 0.5) < 0.2


@pytest.mark.parametrize("crowd", [16384, 2])
def test_substring_dedup(docs, empty, crowd):
    from lociflow.llm.substring_dedup import remove_repeats

    window = 35
    texts = [WORD.findall(t or "") for _, t, _ in rows()]
    count = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    want = Counter()
    for (d, _, _), w in zip(rows(), texts, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want[d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    got = remove_repeats(docs, window, max_group=crowd).collect()
    assert Counter((g.doc_id, g.n_words, g.n_removed, g.kept_sha256) for g in got) == want
    assert remove_repeats(empty, window).count() == 0


@pytest.mark.parametrize("crowd", [16384, 2])
def test_suffix_dedup(docs, empty, crowd):
    from lociflow.llm.suffix_dedup import remove_repeats

    window = 400
    texts = [(t or "").encode() for _, t, _ in rows()]
    count = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    want = Counter()
    for (d, _, _), t in zip(rows(), texts, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if count[t[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        kept = bytes(x for x, g in zip(t, gone, strict=True) if not g)
        want[d, len(t), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()] += 1
    got = remove_repeats(docs, window, with_bytes=True, max_group=crowd).collect()
    assert Counter((g.doc_id, g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256) for g in got) == want
    assert all(sum(b - a for a, b in zip(g.starts, g.ends, strict=True)) == g.n_removed and hashlib.sha256(g.kept).hexdigest() == g.kept_sha256 for g in got)
    assert remove_repeats(empty, window).count() == 0


def repeated(units, offsets, window):
    """Of each unit whether a window that covers it starts twice. Windows have exact numbers: equal ones, and only those, the same."""
    rank, span, n = np.unique(units, return_inverse=True)[1].astype(np.int64), 1, len(units)

    def pairs(step):
        key = np.full(n, -1, np.int64)
        key[: n - step] = rank[: n - step] * (n + 1) + rank[step:]
        return np.unique(key, return_inverse=True)[1].astype(np.int64)

    while 2 * span <= window:
        rank, span = pairs(span), 2 * span
    rank = pairs(window - span) if window > span else rank
    number = np.maximum(np.diff(offsets) - window + 1, 0)
    at = np.arange(number.sum()) + np.repeat(offsets[:-1] - (np.cumsum(number) - number), number)
    hit = at[np.bincount(rank[at], minlength=n)[rank[at]] > 1]
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, hit, 1)
    np.add.at(change, hit + window, -1)
    return np.cumsum(change)[:-1] > 0


def test_suffix_dedup_of_a_whole_table(spark):
    from lociflow.llm.suffix_dedup import remove_repeats

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    table = docs.collect()
    texts = [(r.text or "").encode() for r in table]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    gone = repeated(np.frombuffer(b"".join(texts), np.uint8), offsets, 400)
    want = {}
    for r, t, a, b in zip(table, texts, offsets[:-1], offsets[1:], strict=True):
        kept = np.frombuffer(t, np.uint8)[~gone[a:b]].tobytes()
        want[r.doc_id] = (len(t), int(gone[a:b].sum()), hashlib.sha256(kept).hexdigest())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.kept_sha256) for r in remove_repeats(docs, 400).collect()}
    assert got == want and sum(n for _, n, _ in want.values()) > 100_000


def test_substring_dedup_of_a_whole_table(spark):
    from lociflow.llm.substring_dedup import remove_repeats

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    table = docs.collect()
    texts = [(r.text or "").encode().split() for r in table]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    numbers = {}
    gone = repeated(np.array([numbers.setdefault(w, len(numbers)) for t in texts for w in t]), offsets, 35)
    want = {}
    for r, t, a, b in zip(table, texts, offsets[:-1], offsets[1:], strict=True):
        kept = b" ".join(w for w, g in zip(t, gone[a:b], strict=True) if not g)
        want[r.doc_id] = (len(t), int(gone[a:b].sum()), hashlib.sha256(kept).hexdigest())
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in remove_repeats(docs, 35).collect()}
    assert got == want and sum(n for _, n, _ in want.values()) > 10_000


def thue_morse(n, a="a", b="b"):
    """Under any polynomial modulo 2 ** 64 this text and the one with its letters swapped are alike from 1,024 letters on."""
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


def test_words_that_polynomials_confuse(spark):
    """Near-dedup, substring dedup and suffix dedup tell them apart, with crowded anchors too."""
    from lociflow.llm import near_dedup, substring_dedup, suffix_dedup

    pairs = [(thue_morse(n), thue_morse(n, "b", "a")) for n in (1024, 2048, 4096)]
    odd = [w for pair in pairs for w in pair]
    assert len({int(x) for k in (0, 1) for x in near_hashes(odd, k)}) == 2 * len(odd)
    docs = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    assert all(r.component_id == r.doc_id and r.kept for r in near_dedup.link(docs, 3, 85).collect())

    lead = " ".join(f"word{i}" for i in range(34))
    docs = spark.createDataFrame([(k, f"{lead} {w}") for k, w in enumerate(odd)] + [(90, f"x {lead} twice"), (91, f"y {lead} twice")], "doc_id long, text string")
    for crowd in (16_384, 1):
        got = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(docs, window=35, max_group=crowd).collect()}
        assert got == {k: 0 for k in range(len(odd))} | {90: 35, 91: 35}

    docs = spark.createDataFrame([(0, pairs[0][0]), (1, pairs[0][1]), (2, "z" + thue_morse(1200) + "1"), (3, "y" + thue_morse(1200) + "2")], "doc_id long, text string")
    want = dict(zip(range(4), plain_bytes([r.text for r in docs.orderBy("doc_id").collect()], 1024), strict=True))
    for crowd in (16_384, 1):
        got = {r.doc_id: r.n_removed for r in suffix_dedup.remove_repeats(docs, window=1024, max_group=crowd).collect()}
        assert got == want and got[1] == 0


def near_hashes(texts, kind):
    from lociflow.llm.common import word_hashes

    data = "".join(texts).encode()
    ends = np.cumsum([len(t) for t in texts])
    return word_hashes(np.frombuffer(data, np.uint8), ends - [len(t) for t in texts], ends, kinds=(kind,))[0]


def plain_bytes(texts, window):
    """How many bytes of each text a window covers that starts twice."""
    starts = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    return [len({j for i in range(len(t) - window + 1) if starts[t[i : i + window]] > 1 for j in range(i, i + window)}) for t in texts]


def test_fm_index_counts():
    from lociflow.llm.fm_index import FmIndex

    text = np.array([1, 2, 1, 2, 3, 0, 2, 1, 2, 3, 0])
    weight = np.arange(1, 12)
    index, weighted = FmIndex(text, 4, 5), FmIndex(text, 4, 5, weight)
    for pattern in ([1], [1, 2], [2, 1, 2], [1, 2, 3], [3, 3], [2, 3, 0]):
        low, high = np.array([0]), np.array([len(text)])
        for symbol in pattern[::-1]:
            low, high = index.backward(np.array([symbol]), low, high)
        double = np.concatenate((text, text))
        hits = [double[i : i + len(pattern)].tolist() == pattern for i in range(len(text))]
        assert high[0] - low[0] == sum(hits)
        assert weighted.count(low, high)[0] == sum(w for w, hit in zip(weight, hits, strict=True) if hit)


def test_bpe(docs, empty):
    import base64

    import public_tokenizers as P
    import tiktoken

    from lociflow.llm.bpe import encode

    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for d, t, _ in rows():
        ids = np.array(own.encode_ordinary(t or ""), "<u4")
        want[d, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    got = encode(docs, path, P.PATTERN).collect()
    assert Counter((g.doc_id, g.n_tokens, g.ids_sha256, g.decoded_sha256) for g in got) == want
    assert all(len(g.ids) == g.n_tokens for g in got)
    assert encode(empty, path, P.PATTERN).count() == 0


def test_bpe_of_odd_words():
    """Words of equal letters, alternating ones, without borders and with nothing but borders, as the tokenizer's library has them,
    and in a time that grows with their letters."""
    import time

    import public_tokenizers as P
    import tiktoken

    from lociflow.llm import bpe as B

    b = B.tokenizer(P.path("byte_bpe_multi_50k.tiktoken"))
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=b.ranks, special_tokens={})
    r = np.random.default_rng(4)
    letters = lambda n, of: "".join(r.choice(list(of), n))
    words = ["aaaaaaaa", "aaaaaaa", "banana" * 9, "überraschung", " the" * 7, "x" * 150, "éèê" * 20, "ab" * 500, "aab" * 333, "abcabd" * 99, "", "\ud800"]
    words += [letters(n, "aab") for n in range(1, 120)] + [letters(n, "中文字漢ab") for n in range(1, 60)] + [letters(80, " \u3000🙂\u0301a") for _ in range(60)]
    words += [letters(3000, "etaoinshrdlu"), "thequickbrownfoxjumpsoverthelazydog" * 40]
    words = [w for w in dict.fromkeys(words) if w and "\ud800" not in w]
    for word, ids in zip(words, b.find(words), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain._encode_single_piece(word), word[:40]
    start = time.time()
    many = [letters(190, "abcdefghijklmnopqrstuvwxyz") for _ in range(2000)]
    long = [letters(100_000, "abcdefghijklmnopqrstuvwxyz"), "a" * 100_000, "ab" * 50_000]
    found = b.find(many + long)
    assert time.time() - start < 30  # seconds where nothing else runs
    for word, ids in zip(many[::100] + long, found[:2000:100] + found[2000:], strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain._encode_single_piece(word)


def test_bpe_never_spills():
    import public_tokenizers as P

    from lociflow.llm import bpe as B

    b = B.tokenizer(P.path("byte_bpe_multi_50k.tiktoken"))
    assert b.db.execute("SELECT current_setting('temp_directory')").fetchone()[0] == ""


def test_bpe_remembers_and_forgets(monkeypatch):
    """Words that come again are settled, others are forgotten, and all keep their ids."""
    import public_tokenizers as P

    from lociflow.llm import bpe as B

    monkeypatch.setattr(B, "SETTLED_WORDS", 3)
    monkeypatch.setattr(B, "NEW_WORDS", 4)
    b = B.Bpe(P.path("byte_bpe_multi_50k.tiktoken"))
    r = np.random.default_rng(1)
    words = [f" wörd{i}{'xyz' * (i % 3)}" for i in range(12)] + [" the", "a"]
    want = dict(zip(words, b.find(words), strict=True))
    for _ in range(8):
        some = r.choice(words, 5, replace=False).tolist()
        assert b.find(some) == [want[w] for w in some]
        assert len(b.settled) <= 3 and len(b.new) <= 4 + 5


def test_bpe_remembers_parts(monkeypatch):
    """New words of known parts, and words that were forgotten, don't go through the query again; parts not met for long go; all
    keep the ids of the tokenizer's library, and what ids decode to comes from the vocabulary, known parts included."""
    import public_tokenizers as P
    import tiktoken

    from lociflow.llm import bpe as B

    monkeypatch.setattr(B, "NEW_WORDS", 0)
    b = B.Bpe(P.path("byte_bpe_multi_50k.tiktoken"))
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=b.ranks, special_tokens={})
    given, contract = [], b.contract
    monkeypatch.setattr(b, "contract", lambda words: given.extend(words) or contract(words))

    def right(words):
        for word, ids in zip(words, b.find(words), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == plain._encode_single_piece(word), word[:40]

    r = np.random.default_rng(8)
    parts = ["zq", "xjx", "wörd", "q0", "中", "vvk", "aa", "\x7f"]
    words = list(dict.fromkeys(" " + "".join(r.choice(parts, n)) for n in r.integers(1, 9, 400).tolist()))
    right(words[:200])
    assert len(given) == len(set(given)) and not b.new
    once = len(given)
    right(words[:200])
    assert len(given) == once
    right(words[200:])
    assert len(given) == len(set(given))  # no part twice

    monkeypatch.setattr(B, "KNOWN_PARTS", 40)
    for k in range(0, len(words), 20):
        right(words[k : k + 20])
        assert len(b.recent) <= 40 and len(b.older) <= 40 + 20 * 17
    long = "zqxjx" * 4000 + "a" * 1000
    right([long, long[:300], "b" * 100, long[1:]])
    assert max(map(len, (*b.recent, *b.older))) <= B.PART_BYTES

    b = B.Bpe(P.path("byte_bpe_multi_50k.tiktoken"))
    b.db.execute("UPDATE vocabulary SET bytes = 'Q'::BLOB WHERE token = ?", [b.ranks[b"z"]])
    b.find(["z", "a"])
    assert b.odd == {"z": b"Q"}
    b.new, b.odd = {}, {}
    b.find(["z"])
    assert b.odd == {"z": b"Q"}


def test_sharding(docs, empty, spark):
    from lociflow.llm.sharding import shard

    got = shard(docs).collect()
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _ in rows())
    assert Counter((g.doc_id, g.size, g.text_crc32) for g in got) == want
    assert {g.law for g in got} == {"bytes"} and {g.grown_shard for g in got} == {None}
    many = spark.range(4000).selectExpr("id AS doc_id", "repeat('abc ', int(1 + id % 97)) AS text").union(spark.range(4000, 6000).selectExpr("id", "repeat('same ', 40)"))
    got = shard(many).collect()
    size = Counter()
    slots = defaultdict(list)
    for g in got:
        size[g.shard] += g.size
        slots[g.shard].append(g.slot)
    assert set(size) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(size.values()) - min(size.values()) < 0.02 * sum(size.values()) / 16
    again = {(g.doc_id, g.shard, g.slot) for g in shard(many.repartition(7)).collect()}
    assert again == {(g.doc_id, g.shard, g.slot) for g in got}
    assert shard(empty).count() == 0


def test_sharding_parts_repeated_rows(spark):
    """A third of the bytes in rows with one key, whose shards and slots still come out even."""
    from lociflow.llm.sharding import shard

    many = spark.range(2000).selectExpr("id AS doc_id", "repeat('abc ', int(1 + id % 97)) AS text").union(spark.range(2000).selectExpr("7L", "repeat('same ', 40)")).union(spark.range(300).selectExpr("CAST(NULL AS LONG)", "'none'"))
    for part_rows in (4_000_000, 50):
        got = shard(many, part_rows=part_rows).collect()
        size, slots = Counter(), defaultdict(list)
        for g in got:
            size[g.shard] += g.size
            slots[g.shard].append(g.slot)
        assert len(got) == 4300 and set(size) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert max(size.values()) - min(size.values()) <= 2 * max(400, 0.002 * sum(size.values()) / 16)


def test_splitters_against_a_sort(spark):
    from lociflow.llm import sharding

    r = np.random.default_rng(4)
    keys = np.concatenate((r.integers(0, 2**63, 700), np.full(300, 12345)))
    ties, sizes = r.integers(0, 2**63, 1000), r.integers(1, 500, 1000)
    rows = spark.createDataFrame([(int(k), int(t), int(z)) for k, t, z in zip(keys, ties, sizes)], "key long, tie long, size long")
    order = sorted((int(k) << sharding.TIE_BITS | int(t), int(z)) for k, t, z in zip(keys, ties, sizes))
    at, below = [k for k, _ in order], np.concatenate(([0], np.cumsum([z for _, z in order])))
    for shards, parts in ((16, 1), (4, 5)):
        edges = sharding.splitters(rows, shards, parts, int(sizes.sum()))
        assert len(edges) == shards * parts - 1 and edges == sorted(edges)
        find = sharding.places(edges)
        assert find(keys, ties).tolist() == [int(np.searchsorted(np.array(edges, object), (int(k) << sharding.TIE_BITS) | int(t), "right")) for k, t in zip(keys, ties)]
        for i, e in enumerate(edges):
            reached, wanted = below[sum(k < e for k in at)], sizes.sum() * (i + 1) / (shards * parts)
            assert abs(reached - wanted) <= (500 if (i + 1) % parts == 0 else 500 + 0.2 * sizes.sum() / (shards * parts))


def test_many_parts_plan_quickly(spark):
    import time

    from lociflow.llm.sharding import shard

    many = spark.range(40_000).selectExpr("id AS doc_id", "concat('t', id) AS text")
    start = time.time()
    assert shard(many, part_rows=10).selectExpr("count(DISTINCT shard)").first()[0] == 16
    assert time.time() - start < 60


def fill(sizes):
    """Targets by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        target = {s: 3.0 * sizes[s] if s in capped else rest * weight[s] / free for s in names}
        over = {s for s in names if s not in capped and target[s] > 3 * sizes[s]}
        if not over:
            return target
        capped |= over


def test_mixing(docs, empty):
    from lociflow.llm.mixing import mix_sources

    got = mix_sources(docs).collect()
    size = {k: len(WORD.findall(t or "")) for k, (_, t, _) in enumerate(rows())}
    total = defaultdict(int)
    for k, (_, _, s) in enumerate(rows()):
        total[s] += size[k]
    want = fill(total)
    assert Counter((g.doc_id, g.size, g.source_size) for g in got) == Counter((d, size[k], total[s]) for k, (d, _, s) in enumerate(rows()))
    taken = defaultdict(int)
    for g in got:
        assert abs(g.target - want[g.source]) < 1e-6 * max(1, want[g.source]) and 0 <= g.taken <= 3 * g.size
        taken[g.source] += g.taken
    assert all(want[s] - 1 <= taken[s] <= want[s] + 1e-6 for s in want)
    assert sorted(map(str, got)) == sorted(map(str, mix_sources(docs.repartition(2)).collect()))
    assert mix_sources(empty).count() == 0


def test_mixing_targets_against_rounds(spark):
    from lociflow.llm.mixing import source_targets

    r = np.random.default_rng(4)
    for _ in range(5):
        sizes = {f"s{i:02d}": int(r.integers(0, 2000)) for i in range(9)} | {None: 40}
        table = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, source_size long, docs long")
        got = {x.source: x.target for x in source_targets(table).collect()}
        want = fill(sizes)
        assert all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in sizes)


def test_attention_against_plain_loops():
    """Attention, scores and gradients of a small network, a number at a time."""
    import math

    from lociflow.llm import quality as Q

    r = np.random.default_rng(7)
    first = np.array([0, 3, 4, 6])
    x, label = r.normal(0, 1, (6, Q.FEATURES)), np.array([1.0, 0.0, 1.0])
    p = {"U": r.normal(0, 0.3, (Q.FEATURES, 4)), "u": r.normal(0, 1, 4), "V": r.normal(0, 1, (4, 3)), "G": r.normal(0, 1, (4, 3)), "w": r.normal(0, 1, 3), "c": r.normal(0, 1, 4), "b": np.array(0.2)}
    model = Q.Attention(np.zeros(Q.FEATURES), np.ones(Q.FEATURES), p)

    def by_hand(p):
        out = []
        for a, b in zip(first[:-1], first[1:]):
            hs, es = [], []
            for i in range(a, b):
                h = [math.tanh(sum(x[i, f] * p["U"][f, k] for f in range(Q.FEATURES)) + p["u"][k]) for k in range(4)]
                t = [math.tanh(sum(h[k] * p["V"][k, j] for k in range(4))) for j in range(3)]
                g = [1 / (1 + math.exp(-sum(h[k] * p["G"][k, j] for k in range(4)))) for j in range(3)]
                hs.append(h)
                es.append(math.exp(sum(t[j] * g[j] * p["w"][j] for j in range(3))))
            z = [sum(e * h[k] for e, h in zip(es, hs)) / sum(es) for k in range(4)]
            out.append(1 / (1 + math.exp(-(sum(z[k] * p["c"][k] for k in range(4)) + float(p["b"])))))
        return out

    assert np.allclose(model.score(x, first), by_hand(p))
    # One step of training moves each weight against its gradient, found here by differences.
    loss = lambda q: -sum(math.log(y if v else 1 - y) for y, v in zip(by_hand(q), label)) / len(label)
    grad = Q.gradient(model, x, first, label)
    for k in p:
        flat_index = tuple(int(r.integers(0, n)) for n in p[k].shape)
        up, down = ({n: v.copy() for n, v in p.items()} for _ in range(2))
        up[k][flat_index] += 1e-5
        down[k][flat_index] -= 1e-5
        assert abs((loss(up) - loss(down)) / 2e-5 - np.asarray(grad[k])[flat_index]) < 1e-6


def test_quality(docs, empty, spark):
    from lociflow.llm.quality import keep_good, score, train

    r = np.random.default_rng(8)
    made, labels = [], []
    for k in range(600):
        bad = k % 4 == 0
        words = ["".join(r.choice(list("abcdefg"), r.integers(1, 8))) for _ in range(r.integers(5, 150))]
        made.append((k, " ".join(w.upper() + "!!" if bad else w for w in words)))
        labels.append((k, 0 if bad else 1))
    table, marks = spark.createDataFrame(made, "doc_id long, text string"), spark.createDataFrame([*labels, (None, 1), (5000, None)], "doc_id long, quality int")
    got = score(table, train(table, marks)).collect()
    known = dict(labels)
    held = [g for g in got if g.held_out]
    assert {g.doc_id for g in held} == {k for k in known if zlib.crc32(str(k).encode()) % 5 == 0}
    assert sum(g.predicted == known[g.doc_id] for g in held) > 0.95 * len(held)
    model = train(table, marks)
    edge = score(docs, model).collect()
    assert len(edge) == len(rows()) and all(0 <= g.score <= 1 and g.predicted == int(g.score >= 0.3) for g in edge)
    kept = keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(g.predicted for g in edge)
    nothing = train(empty, spark.createDataFrame([], "doc_id long, quality int"))
    assert {g.score for g in score(table.limit(3), nothing).collect()} == {1.0}
    assert score(empty, model).count() == 0
