"""Registered queries of this package and, where SQL can say it, their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyed.llm import convnet, divergence, mixing, packing, piece_table, records, resharding, rules, simhash, substring, token_counts, topk, toxicity
from keyed.llm.common import crc_mod, load, scratch


def op1_poisson_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(load(spark, sf, "documents"))


def op2_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    counted = token_counts.count_tokens(load(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = load(spark, sf, "documents"), load(spark, sf, "labels")
    model = toxicity.train(docs, labels, crc_mod("doc_id", 3) != 1)
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op4_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring.remove_repeats(load(spark, sf, "documents"), only_digest=True)


def op5_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.prints_of(load(spark, sf, "documents"))


def op6_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = load(spark, sf, "documents"), load(spark, sf, "labels")
    judged = rules.judge(docs.select("doc_id", "text"), rules.train(docs, labels))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_quality_network(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = load(spark, sf, "documents"), load(spark, sf, "labels")
    net = convnet.train(docs, labels, crc_mod("doc_id", 4) != 2)
    scored = convnet.score(docs.select("doc_id", "text"), net)
    return scored.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def op8_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(load(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end=0, capacity=2048)


def op9_exact_top_k(spark: SparkSession, sf: str) -> DataFrame:
    vectors = load(spark, sf, "embeddings")
    return topk.top_k(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


def op10_binary_records(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch(spark, "records")
    records.write_records(load(spark, sf, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), end=1)
    return records.digests(records.read_records(spark, folder))


def op11_flow_resharding(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents")
    old = resharding.write_store(docs, scratch(spark, "store"), F.pmod(F.xxhash64("doc_id"), F.lit(32)), 32)
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    return resharding.reshard(old, 40).read().select(
        F.col("row.doc_id").alias("doc_id"), "size", F.crc32(text).alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op12_piece_table(spark: SparkSession, sf: str) -> DataFrame:
    arranged = piece_table.fill_in_middle(load(spark, sf, "documents"), with_text=False)
    return arranged.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def op13_segment_tree_audit(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.audit(load(spark, sf, "documents"))


_FUNCTIONS = (
    op1_poisson_mixing,
    op2_token_counts,
    op3_toxicity,
    op4_substring_dedup,
    op5_simhash_near_dedup,
    op6_quality_rules,
    op7_quality_network,
    op8_best_fit_packing,
    op9_exact_top_k,
    op10_binary_records,
    op11_flow_resharding,
    op12_piece_table,
    op13_segment_tree_audit,
)
QUERIES = {f.__name__: f for f in _FUNCTIONS}

SQL = {
    "op1_poisson_mixing": """
        WITH RECURSIVE sizes AS (
            SELECT source AS s, sum(octet_length(encode(text)))::DOUBLE AS b FROM documents GROUP BY 1
        ), rates AS (
            SELECT s, sqrt(b) * (SELECT sum(b) FROM sizes) / b / (SELECT sum(sqrt(b)) FROM sizes WHERE b > 0) AS rate
            FROM sizes WHERE b > 0
        ), steps AS (
            SELECT s, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS c FROM rates
            UNION ALL
            SELECT s, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM steps WHERE k < rate + 12 * sqrt(rate) + 30
        ), drawn AS (
            SELECT d.*, ('0x' || substr(md5('mix-count|' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE / 16.0 ^ 13 AS u
            FROM documents d WHERE EXISTS (SELECT 1 FROM rates WHERE s IS NOT DISTINCT FROM d.source)
        ), counted AS (
            SELECT any_value(d.text) AS text, any_value(d.lang) AS lang, any_value(d.source) AS source, any_value(d.n_chars) AS n_chars,
                d.doc_id, count(*) FILTER (WHERE st.c <= d.u) AS n
            FROM drawn d JOIN steps st ON st.s IS NOT DISTINCT FROM d.source GROUP BY d.doc_id
        )
        SELECT doc_id, text, lang, source, n_chars, r::INTEGER AS replica, md5('mix-order|' || coalesce(doc_id::VARCHAR, 'null') || '|' || r) AS mix_key
        FROM (SELECT *, unnest(range(n)) AS r FROM counted)
    """,
    "op9_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS w FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.w::DOUBLE[], c.w::DOUBLE[])::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.w) = len(c.w) WHERE q.vec_id % 100 = 0
        )
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
        ) WHERE rank <= 10
    """,
    "op12_piece_table": """
        WITH hashed AS (
            SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, 'null')) AS h FROM documents
        ), drawn AS (
            SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS b,
                ('0x' || substr(h, 17, 8))::BIGINT % 100 AS c, ('0x' || substr(h, 25, 8))::BIGINT % 100 AS d FROM hashed
        ), cut AS (
            SELECT *, substr(t, 1, least(a, b)) AS prefix, substr(t, least(a, b) + 1, greatest(a, b) - least(a, b)) AS middle,
                substr(t, greatest(a, b) + 1) AS suffix,
                CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 90 THEN 'plain'
                    WHEN d < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(a, b) END AS prefix_chars,
            CASE WHEN form <> 'plain' THEN greatest(a, b) - least(a, b) END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
            sha256(t) AS restored_sha256
        FROM cut
    """,
    "op13_segment_tree_audit": """
        WITH docs AS (
            SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS d,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words FROM documents
        ), tokens AS (
            SELECT lang, source, d, unnest(words) AS term FROM docs
        ), kept AS (
            SELECT lang, term, count(*) AS n FROM tokens GROUP BY ALL HAVING count(DISTINCT d) >= 3
        ), groups AS (
            SELECT DISTINCT lang, source FROM docs
        ), held AS (
            SELECT lang, source, term, count(*) AS n FROM tokens SEMI JOIN kept USING (lang, term) GROUP BY ALL
        ), sizes AS (
            SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
        ), counts AS (
            SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n, sum(coalesce(h.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total, s.v,
                1 + (1000000000::HUGEINT * (k.n + 1)) // (s.total + s.v) AS q
            FROM groups g JOIN kept k USING (lang) JOIN sizes s USING (lang) LEFT JOIN held h USING (lang, source, term)
        ), shares AS (
            SELECT *, 1 + (1000000000::HUGEINT * (n + 1)) // (total + v) AS p FROM counts
        ), pairs AS (
            SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
            FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ), every AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM shares WHERE n > 0 AND p > q
        )
        SELECT lang, source, part, item, value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
        FROM every QUALIFY part = 'pair' OR rank <= 200
    """,
}
