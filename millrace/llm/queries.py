"""The registered queries of the text operators, with their SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import (
    bpe,
    decontamination,
    divergence,
    language_id,
    licenses,
    mixture,
    near_dedup,
    order_minhash,
    secrets,
    shards,
    substring_dedup,
    suffix_dedup,
    whitening,
)
from millrace.llm.settings import tuned

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tuned(spark).read.parquet(f"{folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            TWINS[name] = sql
        return build

    return register


@query(
    "op1_substring_dedup",
    r"""WITH texts AS (SELECT row_number() OVER () AS r, doc_id,
                          regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
             windows AS (SELECT r, i, array_to_string(ws[i : i + 34], ' ') AS w
                         FROM (SELECT r, ws, unnest(range(1, len(ws) - 33)) AS i FROM texts)),
             repeated AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
             gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS j FROM windows SEMI JOIN repeated USING (w)),
             words AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS j FROM texts),
             kept AS (SELECT r, string_agg(word, ' ' ORDER BY j) AS kept, count(*) AS n
                      FROM words ANTI JOIN gone USING (r, j) GROUP BY r)
        SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM texts LEFT JOIN kept USING (r)""",
)
def op1_substring_dedup(spark, folder):
    return substring_dedup.repeat_digests(table(spark, folder, "documents"))


@query("op2_language_id")
def op2_language_id(spark, folder):
    return language_id.identify(table(spark, folder, "documents")).select("doc_id", "held_out", "lang_pred", "score", "n_words", "n_switches")


@query("op3_decontamination")
def op3_decontamination(spark, folder):
    found = decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "score", "first_word", "end_word")


@query("op4_shards")
def op4_shards(spark, folder):
    return shards.shard_digests(table(spark, folder, "documents"))


@query("op5_order_minhash")
def op5_order_minhash(spark, folder):
    found = order_minhash.fingerprints(table(spark, folder, "documents"))
    return found.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@query("op6_suffix_dedup")
def op6_suffix_dedup(spark, folder):
    return suffix_dedup.repeat_digests(table(spark, folder, "documents"))


@query("op7_secrets")
def op7_secrets(spark, folder):
    return secrets.scan_digests(table(spark, folder, "documents"))


@query("op8_licenses")
def op8_licenses(spark, folder):
    return licenses.notices(table(spark, folder, "documents"))


@query("op9_bpe")
def op9_bpe(spark, folder):
    return bpe.token_digests(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op10_near_dedup")
def op10_near_dedup(spark, folder):
    return near_dedup.classes(table(spark, folder, "documents"))


@query("op11_whitening")
def op11_whitening(spark, folder):
    return whitening.whiten(table(spark, folder, "embeddings"))


@query("op12_mixture")
def op12_mixture(spark, folder):
    return mixture.plan(table(spark, folder, "documents"))


@query(
    "op13_divergence",
    r"""WITH docs AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
            words AS (SELECT r, lang, source, unnest(regexp_extract_all(
                        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
            kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
            langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS whole FROM kept GROUP BY lang),
            groups AS (SELECT DISTINCT lang, source FROM docs),
            counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
            masses AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS own FROM groups LEFT JOIN counts USING (lang, source) GROUP BY lang, source),
            shares AS (SELECT lang, source, term, k.n AS total, coalesce(c.n, 0) AS n,
                              1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (own + 2 * v) AS p, 1 + 1000000000::HUGEINT * (k.n + 2) // (whole + 2 * v) AS q
                       FROM masses JOIN langs USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
            pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
                      FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
            everything AS (
              SELECT lang, source, 'pair' AS part, item, coalesce(value, 0) AS value
              FROM (SELECT a.lang, a.source, b.source AS item FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source) LEFT JOIN pairs USING (lang, source, item)
              UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q),
            ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM everything)
       SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10""",
)
def op13_divergence(spark, folder):
    return divergence.audit(table(spark, folder, "documents"))
