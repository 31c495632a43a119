"""The registered queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemill.llm import align, bytebpe, decontam, jaccard, licenses, lm, packing, pii, rules, sharding, tokens, toxicity, whitening
from telemill.llm.common import remainder, table


def op1_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.fit(docs))
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s.base)
    return found.select(
        "doc_id", *[count(k) for k in pii.BASE], F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans")
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "links")


def op4_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = sharding.shard(docs, 16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = rules.applied(rules.ledger(table(spark, sf_dir, "documents")), "v2")
    base = F.col("failed").bitwiseAND(rules.mask(rules.POLICIES["base"])) != 0
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "failed"
    )


def op6_chain_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), lambda doc_id: remainder(doc_id, 4) != 2)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted", "spans")


def op7_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    base = F.filter("matches", lambda m: m.template < len(licenses.BASE))
    labels = lambda m: F.array_join(F.array_sort(F.array_distinct(F.transform(m, lambda x: x.label))), ",")
    found = found.withColumn("base", base)
    starts = F.transform("base", lambda m: m.start)
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels(F.col("base")).alias("base_labels"), labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m.share)), F.lit(0.0)).alias("score"),
    )


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.e - s.s)
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def op9_whole_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = remainder(F.col("doc_id"), 10)
    scored = lm.lm_scores(table(spark, sf_dir, "documents"), F.when(part == 0, 0).when(part == 1, 1).otherwise(2))
    return scored.select("doc_id", (F.col("fold") == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_chebyshev_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.integers(table(spark, sf_dir, "embeddings"))
    model = whitening.fit(rows, 4)
    found = whitening.whiten(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    explained = F.element_at(F.array(*map(F.lit, model.explained)), F.col("component")) if model and model.explained else F.lit(0.0)
    return found.withColumn("component", F.col("place") + 1).select(
        "vec_id", "component", F.lit(model.n if model else 0).cast("long").alias("n"), "deviation", "whitened",
        explained.alias("explained"), F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )


def op12_run_skipping_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")  # the ranks are byte_bpe_50k.json's
    return align.align(table(spark, sf_dir, "documents"), first, public_tokenizers.PATTERN, second)


def op13_backtracking_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bytebpe.decode(bytebpe.encode(table(spark, sf_dir, "documents"), vocabulary), vocabulary)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {
    q.__name__: q
    for q in (
        op1_weak_supervision, op2_best_fit_packing, op3_ngram_jaccard, op4_feistel_shards, op5_rule_ledger, op6_chain_toxicity, op7_license_index,
        op8_winnowing, op9_whole_token_counts, op10_deleted_interpolation, op11_chebyshev_whitening, op12_run_skipping_alignment, op13_backtracking_bpe,
    )
}

_RULE_BITS = " + ".join(f"CASE WHEN {r.fails} THEN {1 << k} ELSE 0 END" for k, r in enumerate(rules.RULES))
_SYMBOLS = "#*$%&|<>"

SQL = {
    "op5_rule_ledger": rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
l AS (SELECT rid, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT rid, i, ws[i:i + {rules.WINDOW - 1}] AS gram
      FROM (SELECT rid, ws, unnest(range(1, len(ws) - {rules.WINDOW - 2})) AS i FROM w WHERE len(ws) >= {rules.WINDOW})),
p AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS c FROM g) WHERE c > 1),
r AS (SELECT rid, sum(least({rules.WINDOW}, coalesce(nxt - i, {rules.WINDOW}))) AS n
      FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM p) GROUP BY rid),
m AS (SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(list_sum(list_transform(ws, lambda x: length(x))) AS BIGINT) AS wc,
             CAST(length(text) - length(regexp_replace(text, '[{_SYMBOLS}]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
      FROM d JOIN w USING (rid) JOIN l USING (rid) LEFT JOIN r USING (rid)),
n AS (SELECT * EXCLUDE (wc), coalesce(wc, 0) AS word_chars FROM m),
b AS (SELECT *, CAST({_RULE_BITS} AS BIGINT) AS failed FROM n)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, failed & {rules.mask(rules.POLICIES["v2"])} = 0 AS kept, failed
FROM b
""",
    "op8_winnowing": rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
           FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
      FROM benchmark),
bl AS (SELECT item, ws, least(len(ws), {decontam.SPAN}) AS k FROM b WHERE len(ws) > 0),
bg AS (SELECT DISTINCT item, k, array_to_string(ws[i:i + k - 1], ' ') AS gram FROM (SELECT item, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM bl)),
ks AS (SELECT DISTINCT k FROM bg),
dg AS (SELECT rid, i, k, array_to_string(ws[i:i + k - 1], ' ') AS gram
       FROM (SELECT rid, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, ks WHERE len(ws) >= k)),
h AS (SELECT rid, i, k, item FROM dg JOIN bg USING (k, gram)),
c AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS pos FROM (SELECT DISTINCT rid, i, k FROM h)) GROUP BY rid),
n AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN n USING (rid)
""",
}
