"""Registered queries of the operators, with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (bpe_trie, bwt_dedup, decontaminate, divergence, exact_dedup, filter_audit, kd_shards, line_dedup,
                         minhash_dedup, mixing, quality, secret_scan, token_files)
from tessera.llm.common import read_table
from tessera.session import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return fn
    return add


@register("op1_bbit_minhash", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
             ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i+4], ' '))) END AS grams FROM w),
g AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * COUNT(*) >= 75 * (a.n + b.n - COUNT(*))),
r(doc_id, reached) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, p.y FROM r JOIN p ON p.x = r.reached),
c AS (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id)
SELECT s.doc_id, CAST(len(s.grams) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM s JOIN c ON c.doc_id = s.doc_id""")
def op1_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.link(read_table(spark, sf_dir, "documents"))


@register("op2_entropy_mix")
def op2_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


@register("op3_markov_secrets")
def op3_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read_table(spark, sf_dir, "documents"))


@register("op4_kd_shards")
def op4_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards.shards(read_table(spark, sf_dir, "documents"), 16)


@register("op5_mphf_exact_dedup", """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""")
def op5_mphf_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(read_table(spark, sf_dir, "documents")).drop("in_history")


@register("op6_parquet_token_lists")
def op6_parquet_token_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return token_files.encode_to_files(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), added_tokens=True)


@register("op7_bradley_terry_quality")
def op7_bradley_terry_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rank(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@register("op8_unit_dedup")
def op8_unit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_units(read_table(spark, sf_dir, "documents")).drop("kept_text")


@register("op9_bwt_substring_dedup", """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s
      FROM (SELECT doc_id, h, unnest(range(0, greatest(0, length(h) // 2 - 49))) AS i FROM d)),
m AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s),
r AS (SELECT w.doc_id, w.i, lag(w.i) OVER (PARTITION BY w.doc_id ORDER BY w.i) AS before
      FROM w JOIN m ON m.s = w.s WHERE m.first < w.doc_id),
k AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 50 THEN 1 ELSE 0 END)
             OVER (PARTITION BY doc_id ORDER BY i) AS run FROM r),
t AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM k GROUP BY doc_id, run),
g AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS from_byte FROM t),
c AS (SELECT g.doc_id, string_agg(substr(h, 2 * from_byte + 1, 2 * (a - from_byte)), '' ORDER BY a) AS head, max(b) AS last,
             sum(b - a) AS gone, COUNT(*) AS spans FROM g JOIN d ON d.doc_id = g.doc_id GROUP BY g.doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN c ON c.doc_id = d.doc_id""")
def op9_bwt_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwt_dedup.remove_repeats(read_table(spark, sf_dir, "documents")).drop("kept")


@register("op10_template_decontamination")
def op10_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@register("op11_trie_bpe")
def op11_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = bpe_trie.decode(bpe_trie.encode(read_table(spark, sf_dir, "documents"), path), path)
    return texts.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op12_lehmer_filter_audit", r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, len(w) < 50 AS a, 100 * len(list_distinct(w)) < 65 * len(w) AS b,
             100 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 5 * length(t) AS c,
             regexp_matches(t, '[#$%&*|]') AS d, coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false) AS e,
             coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
      FROM d LEFT JOIN l ON l.doc_id = d.doc_id),
m AS (SELECT part, a, b, c, d, e, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM x p, x q, x r, x s, x t
      WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
g AS (SELECT part, filter_order, n, good, toxic, CAST(a AS INT) + CAST(b AS INT) + CAST(c AS INT) + CAST(d AS INT) + CAST(e AS INT) AS fails,
             list_filter([CASE WHEN a THEN instr(filter_order, 'A') END, CASE WHEN b THEN instr(filter_order, 'B') END,
                          CASE WHEN c THEN instr(filter_order, 'C') END, CASE WHEN d THEN instr(filter_order, 'D') END,
                          CASE WHEN e THEN instr(filter_order, 'E') END], lambda y: y IS NOT NULL) AS steps FROM m, o),
h AS (SELECT *, coalesce(list_min(steps), 9) AS gone FROM g),
s AS (SELECT part, filter_order, CAST(step AS INT) AS step, substr(filter_order, step, 1) AS letter,
             CAST(sum(CASE WHEN gone > step THEN n ELSE 0 END) AS BIGINT) AS kept,
             CAST(sum(CASE WHEN gone = step THEN n ELSE 0 END) AS BIGINT) AS removed,
             CAST(sum(CASE WHEN gone < step AND list_contains(steps, step) THEN n ELSE 0 END) AS BIGINT) AS redundant,
             CAST(sum(CASE WHEN fails = 1 AND list_contains(steps, step) THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
             CAST(sum(CASE WHEN gone = step THEN good ELSE 0 END) AS BIGINT) AS good_lost,
             CAST(sum(CASE WHEN gone = step THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
      FROM h, (SELECT unnest(range(1, 6)) AS step) GROUP BY part, filter_order, step)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM s""")
def op12_lehmer_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@register("op13_cell_divergence", r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
x AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS lang_n FROM x GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
v AS (SELECT lang, count(*) AS v, sum(lang_n) AS total FROM k GROUP BY lang),
c AS (SELECT x.lang, x.source, x.term, count(*) AS n FROM x JOIN k ON k.lang = x.lang AND k.term = x.term GROUP BY ALL),
g AS (SELECT e.lang, e.source, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang, source FROM d) e
      LEFT JOIN c ON c.lang = e.lang AND c.source = e.source GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             1 + (1000000000 * CAST(coalesce(c.n, 0) + 2 AS HUGEINT)) // (g.total + 2 * v.v) AS p,
             1 + (1000000000 * CAST(k.lang_n + 2 AS HUGEINT)) // (v.total + 2 * v.v) AS q
      FROM g JOIN v ON v.lang = g.lang JOIN k ON k.lang = g.lang
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
      FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
      FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source
      LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
FROM u QUALIFY part = 'pair' OR rank <= 10""")
def op13_cell_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))
