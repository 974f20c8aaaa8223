"""One query per operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gildmill.llm import (
    bagminhash,
    filter_audit,
    packing,
    phrase_mining,
    poisson_mix,
    pq_dedup,
    secret_scan,
    slot_shards,
    suffix_dedup,
    syncmers,
    token_counts,
    toxicity,
    warc_index,
)
from gildmill.llm.common import scratch_path, table, whole_text


def op1_syncmer_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return syncmers.edited_fingerprints(table(spark, folder, "documents"))


def op2_poisson_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = poisson_mix.poisson_mix(table(spark, folder, "documents"))
    return mixed.select(
        "doc_id",
        "source",
        "copies",
        "copy",
        "mix_key",
        F.sha2(whole_text("text").cast("binary"), 256).alias("text_sha256"),
    )


OP2_SQL = """
WITH sizes AS (
  SELECT source, sum(coalesce(strlen(text), 0) + 1)::BIGINT AS n_bytes FROM documents GROUP BY source),
rates AS (
  SELECT source, (1.0::DOUBLE / (SELECT count(*) FROM sizes)::DOUBLE)
                 * (SELECT sum(n_bytes) FROM sizes)::DOUBLE / n_bytes AS rate FROM sizes),
terms AS (
  SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1)))
         OVER (PARTITION BY source ORDER BY k) AS cdf
  FROM rates, LATERAL (SELECT unnest(generate_series(0, (rate + 12 * sqrt(rate) + 30)::BIGINT)) AS k)),
drawn AS (
  SELECT doc_id, source, text,
         ('0x' || substr(md5('20:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT
           / 4503599627370496.0::DOUBLE AS u FROM documents),
counted AS (
  SELECT d.doc_id, d.source, d.text, d.u,
         (SELECT count(*) FROM terms t WHERE t.source IS NOT DISTINCT FROM d.source AND t.cdf <= d.u)
           AS copies FROM drawn d),
copied AS (SELECT *, unnest(generate_series(1, copies)) AS copy FROM counted WHERE copies >= 1)
SELECT doc_id, source, copies, copy,
       ('0x' || substr(md5('20:' || coalesce(doc_id::VARCHAR, '') || ':' || copy), 1, 13))::BIGINT AS mix_key,
       sha256(coalesce(text, '')) AS text_sha256
FROM copied
"""


def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup.repeated_spans(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    learn = labels.filter(~toxicity.held_out())
    model = toxicity.train(docs, learn)
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.transform("offending", lambda s: F.concat_ws(":", s["start"], s["end"])).alias(
            "offending"
        ),
    )


def op5_pq_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return pq_dedup.near_vectors(table(spark, folder, "embeddings"))


def op6_warc_index(spark: SparkSession, folder: str) -> DataFrame:
    index = warc_index.archive_pages(table(spark, folder, "pages"))
    return index.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured"
    )


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.span_digest(table(spark, folder, "documents"))


def op8_bagminhash(spark: SparkSession, folder: str) -> DataFrame:
    found = bagminhash.near_duplicates(table(spark, folder, "documents"))
    return found.withColumn("kept", F.col("doc_id") == F.col("class_id"))


def op9_slot_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    first, grown = slot_shards.plan_shards(docs, scratch_path(spark, "slot-map"), 8)
    stored = slot_shards.write_shards(docs, first, scratch_path(spark, "shards"))
    moved = grown.select("vslot", "sub", F.col("shard").alias("rebalanced_shard"))
    return stored.join(F.broadcast(moved), ["vslot", "sub"]).select(
        "doc_id",
        slot_shards.size_of("text").alias("size"),
        F.crc32(whole_text("text").cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("vslot").alias("virtual_slot"),
        "rebalanced_shard",
    )


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"))


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return filter_audit.audit_documents(docs, labels)


OP11_SQL = r"""
WITH RECURSIVE marked AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
whole AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[ \t-\r]+'), lambda w: w <> '') AS ws FROM documents),
masks AS (
  SELECT doc_id, part,
         CASE WHEN len(ws) < 100 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask FROM whole),
counts AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good = 1) AS g, count(*) FILTER (toxic = 1) AS x
  FROM masks LEFT JOIN marked USING (doc_id) GROUP BY part, mask),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS f(letter, bit)),
prefixes AS (
  SELECT '' AS o, 0 AS before, 0 AS after
  UNION ALL
  SELECT o || letter, after, after + bit FROM prefixes, letters WHERE after & bit = 0),
steps AS (
  SELECT whole_order.o AS filter_order, length(p.o) AS step, p.before, p.after
  FROM prefixes whole_order, prefixes p
  WHERE length(whole_order.o) = 5 AND length(p.o) > 0 AND starts_with(whole_order.o, p.o)),
found AS (
  SELECT part, filter_order, step, after - before AS bit,
         coalesce(sum(n) FILTER (mask & after = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (mask & before = 0 AND mask & after <> 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (mask & before <> 0 AND mask & (after - before) <> 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = after - before), 0)::BIGINT AS unique_fails,
         coalesce(sum(g) FILTER (mask & before = 0 AND mask & after <> 0), 0)::BIGINT AS good_lost,
         coalesce(sum(x) FILTER (mask & before = 0 AND mask & after <> 0), 0)::BIGINT AS toxic_lost
  FROM counts, steps GROUP BY part, filter_order, step, before, after)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM found
"""


def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs).drop("text")


def op13_phrase_mining(spark: SparkSession, folder: str) -> DataFrame:
    return phrase_mining.mine_phrases(table(spark, folder, "documents"))


OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n-\r]')) AS piece FROM documents),
words AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS ws FROM pieces),
f1 AS (SELECT lang, w AS phrase, count(*) AS f FROM (SELECT lang, unnest(ws) AS w FROM words) GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS f FROM (
  SELECT lang, unnest(ws[:-2]) AS w1, unnest(ws[2:]) AS w2 FROM words WHERE len(ws) >= 2)
  GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM (
  SELECT lang, unnest(ws[:-3]) AS w1, unnest(ws[2:-2]) AS w2, unnest(ws[3:]) AS w3 FROM words WHERE len(ws) >= 3)
  GROUP BY ALL HAVING count(*) >= 10),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
cuts AS (
  SELECT f2.lang, w1 || ' ' || w2 AS phrase, 2 AS m, f2.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.phrase = w1 JOIN f1 y ON y.lang = f2.lang AND y.phrase = w2
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || w3, 3, f3.f, 1, x.f, y.f
  FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.phrase = f3.w1
  JOIN f2 y ON y.lang = f3.lang AND y.w1 = f3.w2 AND y.w2 = w3
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || w3, 3, f3.f, 2, x.f, y.f
  FROM f3 JOIN f2 x ON x.lang = f3.lang AND x.w1 = f3.w1 AND x.w2 = f3.w2
  JOIN f1 y ON y.lang = f3.lang AND y.phrase = w3),
scores AS (SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
lowest AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, w1 || ' ' || w2 AS phrase, f FROM f3 UNION ALL SELECT lang, w2 || ' ' || w3, f FROM f3),
kept AS (
  SELECT * FROM lowest WHERE NOT EXISTS (
    SELECT 1 FROM longer WHERE m = 2 AND longer.lang = lowest.lang AND longer.phrase = lowest.phrase
    AND 100 * longer.f >= 50 * a)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


QUERIES = {
    f.__name__: f
    for f in (
        op1_syncmer_fingerprints,
        op2_poisson_mix,
        op3_suffix_dedup,
        op4_toxicity,
        op5_pq_dedup,
        op6_warc_index,
        op7_secret_scan,
        op8_bagminhash,
        op9_slot_shards,
        op10_packing,
        op11_filter_audit,
        op12_token_counts,
        op13_phrase_mining,
    )
}
ORACLES = {
    "op2_poisson_mix": OP2_SQL.strip(),
    "op11_filter_audit": OP11_SQL.strip(),
    "op13_phrase_mining": OP13_SQL.strip(),
}
