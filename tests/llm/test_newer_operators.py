"""Centroid clustering, chat formatting and the Merkle manifest against plain versions."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- clustering


def plain_clusters(rows, k, rounds, dims):
    """rows: (vec_id, components) of usable vectors."""
    data = [(i, [min(max(int(np.floor(64 * float(x))), -(1 << 27)), 1 << 27) for x in v]) for i, v in rows]
    order = sorted(range(len(data)), key=lambda j: (data[j][0] is None, sha(f"1:{data[j][0]}"), data[j][0] or 0, rows[j][1]))
    centroids = [list(data[j][1]) for j in order[:k]]

    def nearest(v):
        each = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
        return each.index(min(each)), min(each)

    for _ in range(rounds):
        own = [nearest(v)[0] for _, v in data]
        for c in range(len(centroids)):
            members = [v for (_, v), o in zip(data, own, strict=True) if o == c]
            if members:
                centroids[c] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    placed = [(i, *nearest(v)) for i, v in data]
    total = sum(d for _, _, d in placed)
    return sorted((str(i), c, d, sum(y for _, x, y in placed if x == c), total, sha(",".join(map(str, centroids[c])))) for i, c, d in placed)


def test_clusters(spark):
    from lociflow.llm.clustering import cluster

    r = np.random.default_rng(8)
    rows = [(int(i), (r.normal(0, 0.4, 4) + i % 5).astype(np.float32).tolist()) for i in range(300)]
    rows += [(900 + i, rows[0][1]) for i in range(150)] + [rows[3], rows[3], (None, rows[4][1]), (None, rows[5][1]), (7000, [1e9, -1e9, 0.0, 0.0])]
    odd = [(5000, None), (5001, [1.0, 2.0]), (5002, [None, 1.0, 1.0, 1.0]), (5003, [float("nan"), 1.0, 1.0, 1.0]), (5004, [float("-inf"), 0.0, 0.0, 0.0]), (5005, [])]
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + odd], "vec_id long, embedding array<float>, cluster string, distance int").repartition(7)
    got = cluster(table, k=6, rounds=3, dims=4)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    want = plain_clusters(rows, 6, 3, 4)
    assert sorted((str(g[0]), *g[1:]) for g in got.collect()) == want


def test_clusters_of_few_vectors(spark):
    from lociflow.llm.clustering import cluster

    kind = "vec_id string, embedding array<double>"
    rows = [("a", [0.5, -0.5]), ("b", [3.0, 3.0])]
    got = sorted(tuple(g) for g in cluster(spark.createDataFrame(rows, kind), dims=2).collect())
    assert got == plain_clusters(rows, 16, 3, 2)
    assert cluster(spark.createDataFrame([], kind), dims=2).count() == 0
    same = cluster(spark.createDataFrame([("a", [1.0, 1.0])] * 40, kind), dims=2).collect()
    assert {(g.cluster, g.distance, g.inertia) for g in same} == {(0, 0, 0)} and len(same) == 40


def test_sums_beyond_a_long(spark):
    from lociflow.llm.clustering import cluster

    far = [(i, [float((-1) ** i * 2**21)] * 64) for i in range(40)]
    got = cluster(spark.createDataFrame(far, "vec_id long, embedding array<double>"), k=1).collect()
    assert {g.inertia for g in got} == {2**63 - 1} and max(g.distance for g in got) > 2**59


def test_tables_against_plain_distances():
    from lociflow.llm.clustering import assign

    r = np.random.default_rng(2)
    values, centroids = r.integers(-9, 9, (50, 5)), r.integers(-9, 9, (4, 5))
    levels, places = zip(*(np.unique(values[:, d], return_inverse=True) for d in range(5)), strict=True)
    best, distance = assign(list(levels), np.array(places), centroids)
    each = ((values[:, None] - centroids[None]) ** 2).sum(2)
    assert best.tolist() == each.argmin(1).tolist() and distance.tolist() == each.min(1).tolist()


# --- chat


def plain_chat(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        turns = [(r[2] or "", r[3] or "") for r in own]
        learnt = "".join(t for r, t in turns if r == "assistant")
        letters = sum(len(s) + s.count("\\") + sum(s.count(m) for m in ("<turn>", "<says>", "</turn>")) for r, t in turns for s in (r, t)) + 19 * len(turns)
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learnt), sha(learnt), letters)
    return out


ODD = ["", None, "</turn>", "<turn>x<says>y</turn>", "\\", "\\\\<", "<</turn>", "<\\turn>", "ends with <", "/turn>", "a\nb\r\n\tc", "naïve — 中文 🙂 é", "<|endoftext|>", " ", "x" * 5000, "$0 \\1 $1"]


def chats(rows, spark):
    return spark.createDataFrame([(*r, "x", 3) for r in rows], "conv_id long, turn long, role string, text string, part string, ids int")


def test_chat(spark):
    from lociflow.llm.chat import digests

    rows = [(k, t, ("user", "assistant")[t % 2], text) for k in range(6) for t, text in enumerate(ODD[k:] + ODD[:k])]
    rows += [(50, 0, "system", "s"), (50, 1, "assistant", "a1"), (50, 2, "assistant", "a2"), (50, 3, None, "x"), (50, 4, "as<turn>\\", "y")]
    rows += [(51, 0, "user", "same"), (51, 0, "user", "same"), (51, 0, "assistant", "b"), (51, None, "assistant", "first"), (None, 0, "assistant", "nobody's"), (52, 0, "user", "no answer"), (53, 0, "assistant", None)]
    rows += [(9, t, ("user", "assistant")[t % 2], f"turn {t} of a long one") for t in range(3000)]
    got = digests(chats(rows, spark).repartition(6), RANKS, public_tokenizers.PATTERN)
    assert got.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    assert {g[0]: tuple(g[1:]) for g in got.collect()} == plain_chat(rows)
    assert got.count() == len({r[0] for r in rows})
    assert digests(chats(rows, spark).limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_chat_parts_make_up_one_encoding(spark, monkeypatch):
    """A conversation cut at any turn has the tokens of the whole, and its mask lies on the answers alone."""
    from lociflow.llm import chat

    rows = [(1, t, ("user", "assistant")[t % 2], text) for t, text in enumerate(ODD * 3)]
    parts = chat.format_conversations(chats(rows, spark).repartition(3), RANKS, public_tokenizers.PATTERN).orderBy("part").collect()
    own = chat.Tokens(RANKS, public_tokenizers.PATTERN, chat.Template().marks)
    whole = "".join(p.formatted for p in parts)
    ids, offsets = own.encode(whole)
    assert [i for p in parts for i in p.ids] == ids.tolist()
    assert own.decode(ids) == whole.encode()
    assert chat.Template().turns(whole) == [(("user", "assistant")[t % 2], text or "") for t, text in enumerate(ODD * 3)]
    learnt = np.array([m for p in parts for m in p.learnt])
    raw = whole.encode()
    spans = [raw[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    assert chat.unescaped(b"".join(s for s, m in zip(spans, learnt, strict=True) if m).decode()) == "".join(x or "" for x in (ODD * 3)[1::2])
    assert not any(s in (b"<turn>", b"<says>", b"</turn>") for s, m in zip(spans, learnt, strict=True) if m)


def test_small_parts(spark):
    from lociflow.llm import chat

    def cut(batches):  # in the workers
        chat.PART = 200
        yield from chat._formatted(RANKS, public_tokenizers.PATTERN, chat.Template())(batches)

    rows = [(k, t, ("user", "assistant")[t % 2], f"text {t} " * 9) for k in range(3) for t in range(40)]
    sorted_rows = chats(rows, spark).select("conv_id", "role", "text", "turn").repartition(1).sortWithinPartitions("conv_id", "turn").drop("turn")
    parts = sorted_rows.mapInArrow(cut, f"conv_id long, {chat.PARTS}").orderBy("part").collect()
    assert len(parts) > 30 and not any(p.complete for p in parts)
    for k in range(3):
        assert chat.Template().turns("".join(p.formatted for p in parts if p.conv_id == k)) == [(r[2], r[3]) for r in rows if r[0] == k]


def test_sample_conversation(spark):
    from lociflow.llm.chat import digests, with_sample

    got = {g.conv_id: g for g in digests(with_sample(chats([(1, 0, "user", "x")], spark)), RANKS, public_tokenizers.PATTERN).collect()}
    said = r"\### Assistant: </turn> ok"
    assert got[-7].loss_sha256 == sha(said) and got[-7].loss_chars == len(said) and got[-7].n_turns == 2
    assert got[-7].formatted_chars == 2 * (19 + len(said) + 2) + len("userassistant")


def test_aligned_tokens():
    from lociflow.llm.chat import aligned

    offsets = np.array([0, 3, 4, 8, 8, 10])
    assert aligned(offsets, np.array([3]), np.array([4])).tolist() == [False, True, False, False, False]
    assert aligned(offsets, np.array([1, 9]), np.array([5, 10])).tolist() == [True, True, True, False, True]
    assert aligned(offsets, np.array([4]), np.array([4])).tolist() == [False] * 5


def test_templates_that_could_be_confused():
    from lociflow.llm.chat import Template

    for marks in (("<a>", "b", "<c>"), ("<a", "<ab", "<c"), ("<a<", "<b", "<c"), ("<\\a", "<b", "<c"), ("", "<b", "<c")):
        with pytest.raises(ValueError):
            Template(*marks)


# --- manifest


def plain_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""

    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def grow(level):
        levels = [level]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
        return levels

    def siblings(levels, at):
        out = []
        for level in levels[:-1]:
            low = at // 8 * 8
            out.append((level[low:at], level[at + 1 : low + 8]))
            at //= 8
        return out

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = (own, grow([leaf(r) for r in own]))
    top = grow([trees[x][1][-1][0] for x in langs])
    out = []
    for k, lang in enumerate(langs):
        own, levels = trees[lang]
        for i, row in enumerate(own):
            proof = siblings(levels, i) + siblings(top, k)
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            h = leaf((*row[:4], row[4].translate(LOWER) if changed and row[4] is not None else row[4]))
            for before, after in proof:
                h = sha("".join([*before, h, *after]))
            out.append((str(row[0]), leaf(row), levels[-1][0], top[-1][0], sha("".join(x for p in proof for side in p for x in side)), h, h == top[-1][0]))
    return sorted(out)


def documents(rows, spark):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, leaf string, path string, idx int")


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 2}, {"en": 8, None: 1}, {"en": 700, "de": 65, "": 9, None: 1, "ä": 3}, {f"l{i}": 1 + i % 3 for i in range(70)}])
def test_manifest(spark, sizes):
    from lociflow.llm.merkle import tampering

    rows = [(1000 * k + i, f"s{i % 3}", lang, i, f"Text {i} of É{k}") for k, (lang, n) in enumerate(sizes.items()) for i in range(n)]
    got = tampering(documents(rows, spark).repartition(5))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((str(g[0]), *g[1:]) for g in got.collect()) == plain_manifest(rows)


def test_manifest_of_odd_rows(spark):
    from lociflow.llm.merkle import folded, manifest, tampering

    rows = [(3, "a", "en", 1, "X"), (3, "a", "en", 1, "X"), (3, "a", "en", 1, "Y"), (None, "a", "en", 1, "Z"), (None, None, None, None, None), (4, None, "en", None, None), (5, "", "", 0, ""), (-9, "a", "de", 1, "Ä 中 🙂" * 50_000)]
    rows += [(100 + i, "a", "en", 1, "same") for i in range(30)]
    assert sorted((str(g[0]), *g[1:]) for g in tampering(documents(rows, spark)).collect()) == plain_manifest(rows)
    assert tampering(documents(rows, spark).limit(0)).count() == 0
    whole = manifest(documents(rows, spark))
    assert whole.where(folded(whole.leaf, whole.proof) == whole.root).count() == len(rows)


# --- earlier operators' odd inputs


def test_nearest_of_extreme_magnitudes(spark):
    from lociflow.llm.hnsw import cosines, nearest

    assert np.allclose(cosines(np.array([1e-200, 2e-200]), np.array([[1.0, 2.0], [1e300, -1e300], [-3e-320, -6e-320]])), [1.0, -1 / np.sqrt(10), -1.0])
    vectors = [(0, [1e-200, 2e-200]), (1, [1.0, 2.0]), (2, [1e300, 2.1e300]), (3, [1e-310, 0.0]), (50, [-1e250, 5e250])]
    got = nearest(spark.createDataFrame(vectors, "vec_id long, embedding array<double>")).collect()
    mine = {(g.query_id, g["rank"]): (g.vec_id, g.score) for g in got}
    assert [mine[0, k][0] for k in (1, 2, 3, 4)] == [1, 2, 50, 3] and abs(mine[0, 1][1] - 1) < 1e-12 and all(np.isfinite(s) for _, s in mine.values())


def test_quality_of_other_ids(spark):
    from lociflow.llm.quality import score, train

    r = np.random.default_rng(3)
    good = lambda k: " ".join("".join(r.choice(list("abcdefg"), 5)) for _ in range(60)) + f" {k}."
    rows = [(f"d{k}", good(k) if k % 2 else "#$%^ " * 60 + str(k)) for k in range(200)] + [("big", "x" * 40_000)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    labels = spark.createDataFrame([(f"d{k}", k % 2) for k in range(200)] + [("big", 1)], "doc_id string, quality int")
    got = {g.doc_id: g.predicted for g in score(docs, train(docs, labels, sample_passages=60)).collect()}
    assert len(got) == 201 and sum(got[f"d{k}"] == k % 2 for k in range(200)) > 190
