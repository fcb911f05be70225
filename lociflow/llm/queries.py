"""The corpus operators as queries over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lociflow.llm.common import read


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lociflow.llm.quality import score, train

    docs = read(spark, sf_dir, "documents")
    return score(docs, train(docs, read(spark, sf_dir, "labels")))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lociflow.llm.near_dedup import link

    return link(read(spark, sf_dir, "documents"), width=3, percent=85)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lociflow.llm.url_filter import HOST_RULES, PATTERN_RULES, filter_urls, rule_table

    return filter_urls(read(spark, sf_dir, "pages"), rule_table(spark, HOST_RULES + PATTERN_RULES))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lociflow.llm.exact_dedup import judge

    return judge(read(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lociflow.llm.sharding import shard

    return shard(read(spark, sf_dir, "documents"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lociflow.llm.hnsw import nearest

    return nearest(read(spark, sf_dir, "embeddings"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lociflow.llm.mixing import mix_sources

    return mix_sources(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lociflow.llm.substring_dedup import remove_repeats

    return remove_repeats(read(spark, sf_dir, "documents"), window=35)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from lociflow.llm.bpe import encode

    return encode(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, with_tokens=False)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lociflow.llm.suffix_dedup import remove_repeats

    return remove_repeats(read(spark, sf_dir, "documents"), window=400)


def op11_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lociflow.llm.clustering import cluster

    return cluster(read(spark, sf_dir, "embeddings"))


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from lociflow.llm.chat import digests, with_sample

    return digests(with_sample(read(spark, sf_dir, "conversations")), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lociflow.llm.merkle import tampering

    return tampering(read(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality, op2_near_dedup, op3_url_filter, op4_exact_dedup, op5_sharding, op6_nearest, op7_mixing,
        op8_substring_dedup, op9_bpe, op10_suffix_dedup, op11_clusters, op12_chat, op13_manifest,
    )
}


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _clusters_sql(rounds: int = 3) -> str:
    """Centroid clustering, a round after the other; exact integers."""
    parts = [
        """v AS (SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS c FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        "c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, vec_id, c) - 1 AS k, c FROM v QUALIFY k < 16)",
    ]
    for r in range(rounds + 1):
        parts.append(
            f"""a{r} AS (SELECT n, arg_min(k, [d, k]) AS k, min(d) AS d FROM (
  SELECT v.n, m.k, list_sum(list_transform(range(1, 65), lambda i: (v.c[i] - m.c[i]) * (v.c[i] - m.c[i])))::BIGINT AS d FROM v, c{r} m) GROUP BY n)"""
        )
        if r < rounds:
            parts.append(
                f"""s{r} AS (SELECT k, i, sum(c[i])::BIGINT AS s, count(*) AS z FROM v JOIN a{r} USING (n), range(1, 65) t(i) GROUP BY k, i),
c{r + 1} AS (SELECT m.k, coalesce(x.c, m.c) AS c FROM c{r} m LEFT JOIN (SELECT k, list((s - ((s % z) + z) % z) // z ORDER BY i) AS c FROM s{r} GROUP BY k) x USING (k))"""
            )
    return (
        "WITH "
        + ",\n".join(parts)
        + f"""
SELECT vec_id, a.k::INTEGER AS cluster, a.d AS distance, sum(a.d) OVER (PARTITION BY a.k)::BIGINT AS cluster_inertia, sum(a.d) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(m.c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v USING (n) JOIN c{rounds} m ON m.k = a.k"""
    )


_CHAT = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
sized AS (SELECT *, list_sum(list_transform([role, text], lambda s: length(s) + length(s) - length(replace(s, '\', ''))
  + (length(s) - length(replace(s, '<turn>', ''))) // 6 + (length(s) - length(replace(s, '<says>', ''))) // 6 + (length(s) - length(replace(s, '</turn>', ''))) // 7)) AS letters FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  (sum(letters) + count(*) * 19)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id"""


def _manifest_sql(leaf_levels: int = 7, root_levels: int = 3) -> str:
    """A Merkle manifest of up to 8 ** leaf_levels rows a language, a level after the other."""
    lowered = f"translate(text, '{_UPPER}', '{_LOWER}')"
    field = "coalesce(strlen({0}::VARCHAR) || ':' || {0}, '-')".format
    leaf = lambda text: f"sha256({' || '.join(field(x) for x in ('doc_id', 'source', 'lang', 'n_chars', text))})"
    parts = [
        """crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t)""",
        f"""leaves AS (SELECT row_number() OVER () AS n, doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, {leaf("text")} AS h,
  CASE WHEN xor(list_reduce(list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 3 = 0 THEN {leaf(lowered)} END AS changed FROM documents, crc_table)""",
        "p0 AS (SELECT n, doc_id, g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY g) AS size, h, h AS own, coalesce(changed, h) AS f, '' AS proof FROM leaves)",
        "l0 AS (SELECT g, i, size, h FROM p0)",
    ]

    def level(k: int, before: str) -> None:
        parts.append(
            f"""r{k} AS (SELECT g, i // 8 AS up, size, list(h ORDER BY i) AS hs FROM l{before} WHERE size > 1 GROUP BY ALL),
l{k} AS (SELECT g, up AS i, (size + 7) // 8 AS size, sha256(array_to_string(hs, '')) AS h FROM r{k}),
p{k} AS (SELECT n, doc_id, p.g, coalesce(up, i) AS i, CASE WHEN up IS NULL THEN p.size ELSE (p.size + 7) // 8 END AS size, coalesce(sha256(array_to_string(hs, '')), p.h) AS h, own,
  CASE WHEN up IS NULL THEN f ELSE sha256(array_to_string(hs[1:i % 8], '') || f || array_to_string(hs[i % 8 + 2:], '')) END AS f,
  CASE WHEN up IS NULL THEN proof ELSE proof || array_to_string(hs[1:i % 8], '') || array_to_string(hs[i % 8 + 2:], '') END AS proof
  FROM p{before} p LEFT JOIN r{k} r ON r.g = p.g AND r.up = p.i // 8)"""
        )

    for k in range(1, leaf_levels + 1):
        level(k, str(k - 1))
    at = leaf_levels + 1
    parts.append(f"l{at}a AS (SELECT 0 AS g, g AS i, count(*) OVER () AS size, h FROM (SELECT DISTINCT g, h FROM p{leaf_levels}))")
    parts.append(f"p{at}a AS (SELECT n, doc_id, 0 AS g, g AS i, (SELECT count(*) FROM l{at}a) AS size, h, own, f, proof FROM p{leaf_levels})")
    level(at, f"{at}a")
    for k in range(at + 1, at + root_levels):
        level(k, str(k - 1))
    last = at + root_levels - 1
    return (
        "WITH "
        + ",\n".join(parts)
        + f"""
SELECT e.doc_id, e.own AS leaf, s.h AS subroot, e.h AS root, sha256(e.proof) AS proof_sha256, e.f AS folded_root, e.f = e.h AS verified FROM p{last} e JOIN p{leaf_levels} s USING (n)"""
    )


ORACLES = {
    "op3_url_filter": f"""
WITH rest AS (SELECT page_id, coalesce(CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) END, '') AS r FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(rule, rule_host, rule_path, rule_verdict) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
patterns(pattern_rule, pattern) AS (VALUES ('||spam-farm.', '^(?:[^/]*\\.)?spam-farm\\.'), ('||ads.', '^(?:[^/]*\\.)?ads\\.'), ('||adserver.', '^(?:[^/]*\\.)?adserver\\.'),
  ('||tracker.', '^(?:[^/]*\\.)?tracker\\.'), ('/casino/', '/casino/'), ('/phishing/', '/phishing/'), ('/wp-login/', '/wp-login/')),
judged AS (SELECT *,
  (SELECT arg_max({{'rule': rule, 'verdict': rule_verdict}}, length(rule)) FROM rules WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS best,
  (SELECT arg_max(pattern_rule, [length(pattern_rule)::VARCHAR, pattern_rule]) FROM patterns WHERE regexp_matches(host || path, pattern)) AS hit
  FROM parts)
SELECT page_id, host, path, best.rule AS rule, CASE WHEN best IS NOT NULL THEN best.verdict WHEN hit IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
  CASE WHEN best IS NULL THEN hit END AS pattern_rule
FROM judged""",
    "op4_exact_dedup": r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n""",
    "op11_clusters": _clusters_sql(),
    "op12_chat": _CHAT,
    "op13_manifest": _manifest_sql(),
}
