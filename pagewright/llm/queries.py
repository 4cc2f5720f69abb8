"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm.license_scan import BLOCK, NOTICES, PERCENT, PHRASES, STEP
from pagewright.llm.shared import SPACE, documents, having_ids, shared_folder, written


def op4_simhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.fingerprints import fingerprint, neighbours

    return neighbours(written(fingerprint(documents(spark, sf_dir)), "simhashes"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.ngram_join import ngram_join

    return ngram_join(documents(spark, sf_dir), words=4, percent=85).drop("node")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in, the batch is sent twice; those of quality 0 are revised, with single spaces for white space, and those labelled toxic deleted."""
    from pagewright.llm.token_counts import TokenLedger

    docs = documents(spark, sf_dir)
    ledger = TokenLedger(spark, f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex}")
    load = docs.select(F.lit("insert").alias("op"), "doc_id", "text", "source", "lang")
    ledger.commit("load", load)
    ledger.commit("load", load)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    poor = having_ids(load, labels.filter("quality = 0").select("doc_id"))
    ledger.commit("poor", poor.select(F.lit("revise").alias("op"), "doc_id", F.regexp_replace("text", SPACE, " ").alias("text"), "source", "lang"))
    toxic = labels.filter("toxic = 1").select("doc_id")
    none = F.lit(None).cast("string")
    ledger.commit("toxic", toxic.select(F.lit("delete").alias("op"), "doc_id", none.alias("text"), none.alias("source"), none.alias("lang")))
    return ledger.totals()


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.exact_dedup import exact_dedup

    return exact_dedup(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.sharding import shard_and_grow

    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return shard_and_grow(documents(spark, sf_dir), 8).select("doc_id", "size", "text_crc32", law, "shard", "slot", grown, "virtual_slot", "version", "next_shard", "next_version")


def op1_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.mixing import mix

    return mix(documents(spark, sf_dir))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.packing import pack

    return pack(documents(spark, sf_dir))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.line_dedup import drop_repeated_lines

    return drop_repeated_lines(documents(spark, sf_dir))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.pii import find_personal_data

    return find_personal_data(documents(spark, sf_dir))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.language_id import identify

    return identify(documents(spark, sf_dir))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.divergence import source_divergence

    return source_divergence(documents(spark, sf_dir))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.prefix_trie import prefix_trie

    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.license_scan import license_scan

    return license_scan(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (op1_entropy_mixing, op2_sharding, op3_best_fit_packing, op4_simhash_fingerprints, op5_ngram_join, op6_token_counts, op7_exact_dedup, op8_line_dedup, op9_pii, op10_language_id, op11_source_divergence, op12_prefix_trie, op13_license_scan)}


def _values(pairs: Iterable[tuple[str, str]]) -> str:
    return ", ".join(f"('{a}', '{b}')" for a, b in pairs)


ORACLE_SQL = {
    "op7_exact_dedup": """
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                          sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS h FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
               row_number() OVER w = 1 AS kept, h AS text_sha256
        FROM d WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id NULLS LAST)
    """,
    "op8_line_dedup": """
        WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                          unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents),
        w AS (SELECT doc_id, pos, line || chr(10) || lead(line) OVER d || chr(10) || lead(line, 2) OVER d AS win,
                     trim(line || lead(line) OVER d || lead(line, 2) OVER d) <> '' AS words
              FROM l WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
        later AS (SELECT doc_id, pos FROM (SELECT doc_id, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS k
                                           FROM w WHERE win IS NOT NULL AND words) WHERE k > 1),
        gone AS (SELECT DISTINCT doc_id, pos + k AS pos FROM later, range(3) t(k)),
        runs AS (SELECT doc_id, min(pos) AS a, max(pos) AS b
                 FROM (SELECT doc_id, pos, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM gone) GROUP BY doc_id, run),
        spans AS (SELECT doc_id, string_agg(a || '-' || b, ',' ORDER BY a) AS removed FROM runs GROUP BY doc_id),
        body AS (SELECT l.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed,
                        coalesce(string_agg(line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL), '') AS text
                 FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos GROUP BY l.doc_id)
        SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(b.text, '') END AS text, coalesce(b.n_lines, 0) AS n_lines, coalesce(b.n_removed, 0) AS n_removed,
               coalesce(s.removed, '') AS removed
        FROM documents d LEFT JOIN body b USING (doc_id) LEFT JOIN spans s USING (doc_id)
    """,
    "op11_source_divergence": """
        WITH t AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
        c AS (SELECT lang, source, unnest(terms) AS term, 1 AS n, 0 AS docs FROM t
              UNION ALL SELECT lang, source, unnest(list_distinct(terms)), 0, 1 FROM t),
        counts AS (SELECT lang, source, term, sum(n) AS n, sum(docs) AS docs FROM c GROUP BY ALL),
        kept AS (SELECT lang, term, sum(n) AS lang_n FROM counts GROUP BY ALL HAVING sum(docs) >= 10),
        groups AS (SELECT DISTINCT lang, source FROM t),
        dense AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, k.lang_n::HUGEINT AS lang_n
                  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        share AS (SELECT lang, source, term, n,
                         (1 + (1000000000 * (n + 2)) // (sum(n) OVER own + 2 * count(*) OVER own))::BIGINT AS p,
                         (1 + (1000000000 * (lang_n + 2)) // (sum(lang_n) OVER own + 2 * count(*) OVER own))::BIGINT AS q
                  FROM dense WINDOW own AS (PARTITION BY lang, source)),
        summed AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
                   FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
                  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
                  LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
        terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM share WHERE n > 0 AND p > q)
        SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM pairs
        UNION ALL SELECT * FROM (SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM terms) WHERE rank <= 10
    """,
    "op12_prefix_trie": """
        WITH crc AS (SELECT list(v ORDER BY i) AS tab FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) t(i))),
        t AS (SELECT conv_id, sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS item, octet_length(encode(coalesce(text, ''))) AS bytes,
                     row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, item) - 1 AS pos FROM conversations WHERE conv_id IS NOT NULL),
        ids AS (SELECT DISTINCT conv_id FROM t),
        c AS (SELECT conv_id, conv_id - conv_id % 5 AS base,
                     xor(list_reduce([4294967295] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) % 9 AS h FROM ids, crc),
        r AS (SELECT c.conv_id, 1 AS part, pos, item, bytes FROM t JOIN c USING (conv_id) WHERE pos >= h
              UNION ALL SELECT c.conv_id, 0, pos, item, bytes FROM c JOIN t ON t.conv_id = c.base WHERE pos < h),
        s AS (SELECT conv_id, row_number() OVER o AS depth, list(item) OVER o AS path, bytes FROM r WINDOW o AS (PARTITION BY conv_id ORDER BY part, pos)),
        p AS (SELECT conv_id, depth, path, bytes FROM s UNION ALL SELECT conv_id, 0, []::VARCHAR[], 0 FROM ids),
        node AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes FROM p GROUP BY path, depth),
        ends AS (SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends FROM (SELECT conv_id, max_by(path, depth) AS path FROM p GROUP BY conv_id) GROUP BY path),
        kids AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1),
        u AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM node n LEFT JOIN kids USING (path)),
        below AS (SELECT path[1:k] AS path, sum((n_convs - 1) * bytes) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
                  FROM (SELECT u.*, unnest(range(depth + 1)) AS k FROM u) GROUP BY 1)
        SELECT u.conv_id, u.depth, a.conv_id AS parent_conv_id, u.n_convs, u.n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
        FROM u JOIN below USING (path) LEFT JOIN ends USING (path) LEFT JOIN node a ON u.depth > 0 AND a.path = u.path[1:u.depth - 1]
    """,
    "op13_license_scan": f"""
        WITH notice AS (SELECT label, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS pairs
                        FROM (SELECT label, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM (VALUES {_values(NOTICES)}) v(label, text))),
        phrase AS (SELECT label, string_split(text, ' ') AS w FROM (VALUES {_values((label, text) for text, label in PHRASES)}) v(label, text)),
        d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id,
                     regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
        place AS (SELECT row, label, unnest(list_filter(range(len(d.w)), lambda i: d.w[i + 1:i + len(p.w)] = p.w)) AS k FROM d, phrase p),
        base AS (SELECT row, count(*) AS n, min(k) AS first_word, max(k) AS last_word, list_distinct(list(label)) AS labels FROM place GROUP BY row),
        cut AS (SELECT row, w, unnest(range(0, greatest(len(w) - {STEP}, 1), {STEP})) AS s FROM d),
        block AS (SELECT row, s, list_distinct(list_transform(range(s + 1, least(s + {BLOCK}, len(w))), lambda i: w[i] || ' ' || w[i + 1])) AS pairs FROM cut),
        hit AS (SELECT row, s, label, len(list_intersect(block.pairs, notice.pairs)) AS n, len(notice.pairs) AS size FROM block, notice WHERE 100 * n >= {PERCENT} * size),
        own AS (SELECT row, list_distinct(list(label)) AS labels, max(n::DOUBLE / size) AS held, count(DISTINCT s) AS n_blocks FROM hit GROUP BY row)
        SELECT doc_id, len(w) AS n_words, coalesce(b.n, 0) AS n_base, b.first_word, b.last_word, coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
               array_to_string(list_sort(list_distinct(coalesce(b.labels, []) || coalesce(o.labels, []))), ',') AS labels,
               CASE WHEN b.n > 0 THEN 1.0 ELSE coalesce(o.held, 0.0) END::DOUBLE AS score, coalesce(o.n_blocks, 0) AS n_blocks
        FROM d LEFT JOIN base b USING (row) LEFT JOIN own o USING (row)
    """,
}
