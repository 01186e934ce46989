"""Registered queries of the package: each applies its operator, with
production parameters, to the whole of its tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kestrel.llm import conversation_repair, decontaminate, feistel, line_crf, ngram_join, pii, quality_rules, sentencepiece_viterbi, token_orc, toxicity, vector_codes, vector_packing, warc
from kestrel.sources.tables import load

SHARDS = 24


def op1_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(load(spark, sf_dir, "documents"))


def op2_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_orc.round_trip(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_boosted_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(load(spark, sf_dir, "documents"))


def op4_tfidf_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op5_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(load(spark, sf_dir, "pages"))


def op6_minhash_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(load(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op7_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feistel.shard_documents(load(spark, sf_dir, "documents"), SHARDS)


def op8_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.score(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op9_prefix_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_viterbi.round_trip(load(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_benchmark_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.scan(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def benchmark_near_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.near_report(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op11_orchard_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(load(spark, sf_dir, "embeddings")).drop("label")


def op12_cyk_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = load(spark, sf_dir, "conversations")
    return conversation_repair.report(conversations, conversation_repair.damage(conversations))


def op13_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_packing.pack(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {f.__name__: f for f in (
    op1_robust_outliers, op2_token_orc, op3_boosted_spans, op4_tfidf_neighbours, op5_warc_transactions, op6_minhash_jaccard, op7_feistel_shards, op8_line_crf, op9_prefix_viterbi, op10_benchmark_phrases, benchmark_near_phrases, op11_orchard_codes,
    op12_cyk_repair, op13_vector_packing)}



def _orchard_sql() -> str:
    """Two rounds of assignment by comparing every part with every entry."""
    steps = ["""
        k AS (SELECT row_number() OVER () AS r, vec_id, label::BIGINT AS label, embedding AS e FROM embeddings
              WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        x AS MATERIALIZED (SELECT r, vec_id, e, p, list_transform(e[p * (len(e) // 16) + 1 : (p + 1) * (len(e) // 16)], lambda c: floor(256 * c)::BIGINT) AS v
              FROM k, (SELECT unnest(range(16)) AS p)),
        c0 AS MATERIALIZED (SELECT p, v, row_number() OVER (PARTITION BY p ORDER BY vec_id NULLS LAST, e) - 1 AS i FROM x
              QUALIFY i < 64)"""]
    for n in range(3):
        steps.append(f"""
        d{n} AS (SELECT r, x.p, x.v, i, list_sum(list_transform(range(1, len(x.v) + 1), lambda j: (x.v[j] - c.v[j]) * (x.v[j] - c.v[j])))::BIGINT AS d
              FROM x JOIN c{n} c ON c.p = x.p),
        a{n} AS MATERIALIZED (SELECT r, p, any_value(v) AS v, arg_min(i, d * 64 + i) AS i, min(d) AS d FROM d{n} GROUP BY r, p)""")
        if n < 2:
            steps.append(f"""
        u{n} AS (SELECT p, i, j, sum(x)::BIGINT AS s, count(*) AS n
              FROM (SELECT p, i, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM a{n}) GROUP BY p, i, j),
        m{n} AS (SELECT p, i, list((s - ((s % n) + n) % n) // n ORDER BY j) AS v FROM u{n} GROUP BY p, i),
        c{n + 1} AS MATERIALIZED (SELECT p, i, coalesce(m{n}.v, c{n}.v) AS v FROM c{n} LEFT JOIN m{n} USING (p, i))""")
    return "WITH " + ",".join(steps) + """,
        codes AS (SELECT r, string_agg(printf('%02x', i), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY r),
        books AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, i)) AS codebooks_sha256 FROM c2)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
        FROM k JOIN codes USING (r), books"""


ORACLES: dict[str, str] = {
    "op11_orchard_codes": _orchard_sql(),
    "op12_cyk_repair": r"""
        WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                      coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
        h AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda x: ascii(x)::BIGINT)),
                                lambda s, b: list_reduce(list_prepend(xor(s, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                                                         lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS h FROM k),
        d AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
                     CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
              FROM (SELECT *, unnest(CASE WHEN h = 3 THEN [0, 1] ELSE [0] END) FROM h WHERE h <> 0)),
        n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS pos,
                     left(role, 1) AS initial, trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown FROM d),
        g AS MATERIALIZED (SELECT *, CASE WHEN shown = '' THEN 'blank'
                          WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
                          WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
                     lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial AS pair FROM n),
        s AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                     count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
                     count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM g GROUP BY conv_id),
        steps(p, r, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
        eps(p, q, cost, audit) AS (VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 5, 'I'), (0, 3, 10, 'II'),
                                          (1, 2, 5, 'I'), (1, 3, 10, 'II'), (2, 3, 5, 'I'), (3, 2, 5, 'I')),
        m AS MATERIALIZED (SELECT conv_id, pos, p, p AS q, 2 AS cost, 'D' AS audit FROM g, (SELECT unnest(range(4)) AS p)
              UNION ALL SELECT conv_id, pos, p, q, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END, 'K' FROM g JOIN steps ON r = initial
                        WHERE fault NOT IN ('blank', 'duplicate')
              UNION ALL SELECT conv_id, pos, p, q, CASE fault WHEN 'truncated' THEN 6 ELSE 1 END, 'R' FROM g, steps
                        WHERE r IN ('u', 'a') AND fault NOT IN ('blank', 'duplicate')),
        w AS (SELECT conv_id, 0::BIGINT AS pos, q AS state, struct_pack(c := cost, a := audit) AS best FROM s, eps WHERE p = 0
              UNION ALL
              SELECT w.conv_id, w.pos + 1, e.q, min(struct_pack(c := w.best.c + m.cost + e.cost, a := w.best.a || m.audit || e.audit))
              FROM w JOIN m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.pos = w.pos + 1 AND m.p = w.state JOIN eps e ON e.p = m.q
              GROUP BY ALL),
        b AS MATERIALIZED (SELECT s.*, best.c AS cost, best.a AS audit FROM s JOIN (SELECT conv_id, pos, min(best) AS best FROM w WHERE state IN (0, 3) GROUP BY 1, 2) f
              ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.pos = s.n),
        o AS (SELECT conv_id, i, e, count(*) FILTER (e <> 'I') OVER u AS pos, count(*) FILTER (e <> 'D') OVER u AS place
              FROM (SELECT conv_id, generate_subscripts(string_split(audit, ''), 1) AS i, unnest(string_split(audit, '')) AS e FROM b WHERE audit <> '')
              WINDOW u AS (PARTITION BY conv_id ORDER BY i)),
        y AS (SELECT o.conv_id, i, place, e, g.role, g.text,
                     max(CASE WHEN place = 1 AND e = 'K' AND g.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY o.conv_id) AS sys
              FROM o LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM o.conv_id AND g.pos = o.pos AND e <> 'I' WHERE e <> 'D'),
        r AS (SELECT conv_id, sha256(string_agg(CASE WHEN e = 'K' THEN role WHEN (place - 1 - sys) % 2 = 0 THEN 'user' ELSE 'assistant' END
                                                || ':' || coalesce(text, ''), chr(10) ORDER BY i)) AS sha FROM y GROUP BY conv_id)
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
               coalesce(sha, sha256('')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM c.conv_id""",
    "op5_warc_transactions": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest FROM p),
        g AS (SELECT *, CASE WHEN payload_bytes >= 1000
                             THEN max(page_id) OVER (PARTITION BY payload_bytes, payload_digest) END AS stored FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN stored IS NOT NULL AND stored IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN stored IS DISTINCT FROM page_id THEN stored END AS refers_to
        FROM g""",
    "op6_minhash_jaccard": r"""
        WITH RECURSIVE d AS (SELECT doc_id, row_number() OVER () AS r,
                      list_filter(regexp_split_to_array(coalesce(text, ''), '[\x{20}\x{09}-\x{0D}]+'), lambda x: x <> '') AS w FROM documents),
        g AS MATERIALIZED (SELECT DISTINCT r, hash(array_to_string(w[s : s + least(5, len(w)) - 1], ' ')) AS gram
              FROM (SELECT r, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS s FROM d WHERE len(w) > 0)),
        n AS MATERIALIZED (SELECT r, count(*) AS n FROM g GROUP BY r),
        l AS MATERIALIZED (SELECT a, b FROM (SELECT x.r AS a, y.r AS b, count(*) AS c FROM g x JOIN g y ON x.gram = y.gram AND x.r <> y.r GROUP BY 1, 2)
              JOIN n na ON na.r = a JOIN n nb ON nb.r = b WHERE c >= 0.8 * (na.n + nb.n - c)),
        reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, l.b FROM reach JOIN l ON l.a = reach.b),
        cls AS (SELECT reach.a AS r, min(d.doc_id) AS class_id FROM reach JOIN d ON d.r = reach.b GROUP BY 1)
        SELECT doc_id, class_id, (SELECT count(*) FROM l WHERE l.a = d.r) AS n_links FROM d JOIN cls USING (r)""",
    "op10_benchmark_phrases": r"""
        WITH dw AS (SELECT doc_id, list_filter(regexp_split_to_array(
                      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+'), lambda x: x <> '') AS w,
                    row_number() OVER () AS r FROM documents),
        bw AS (SELECT item_id, list_filter(regexp_split_to_array(
                      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+'), lambda x: x <> '') AS w FROM benchmark),
        ph AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[s : s + least(10, len(w)) - 1], ' ') AS phrase
               FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS s FROM bw WHERE len(w) > 0)),
        lens AS (SELECT DISTINCT n FROM ph),
        m AS (SELECT r, s, g.n, ph.item_id
              FROM (SELECT r, s, n, array_to_string(w[s : s + n - 1], ' ') AS phrase
                    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM dw, lens WHERE len(w) >= n)) g
              JOIN ph ON ph.phrase = g.phrase AND ph.n = g.n),
        h AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS pos FROM m) GROUP BY r),
        i AS (SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
              FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM m) GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM dw LEFT JOIN h USING (r) LEFT JOIN i USING (r)""",
}
