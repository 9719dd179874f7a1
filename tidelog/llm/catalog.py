"""The registered queries of this folder and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import (additive, bk_simhash, doubling, feistel_shards, latent, periodic, pieces, repetition, resampling,
                         skip_chain, toxicity, url_filter, warc)
from tidelog.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


@query()
def op1_personal_data(spark, folder):
    docs = table(spark, folder, "documents")
    return skip_chain.detected(docs, skip_chain.fit(docs), keep=["doc_id"])


@query(feistel_shards.oracle())
def op2_feistel_shards(spark, folder):
    return feistel_shards.shards(table(spark, folder, "documents"))


@query(repetition.oracle())
def op3_repetition(spark, folder):
    return repetition.repeated(table(spark, folder, "documents"), keep=["doc_id"])


@query()
def op4_simhash_components(spark, folder):
    found = bk_simhash.clustered(table(spark, folder, "documents"))
    return found.select("doc_id", bk_simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


@query()
def op5_sentencepiece(spark, folder):
    return pieces.digests(table(spark, folder, "documents"))


@query()
def op6_quality(spark, folder):
    docs = table(spark, folder, "documents")
    model = additive.fit(docs, table(spark, folder, "labels"))
    return (additive.scored(docs, model, keep=["doc_id"])
            .withColumn("held_out", F.coalesce(additive.held_out(F.col("doc_id")), F.lit(False))))


@query()
def op7_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    return (toxicity.scored(docs, model, keep=["doc_id"])
            .withColumn("held_out", F.coalesce(toxicity.held_out(F.col("doc_id")), F.lit(False))))


@query()
def op8_benchmark_leaks(spark, folder):
    docs = table(spark, folder, "documents")
    return latent.leaked(docs, latent.indexes(docs, table(spark, folder, "benchmark")))


@query("""
WITH sized AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
coded AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first,
  array_to_string(list_transform(range(8), lambda g: array_to_string(list_transform(range(4), lambda k: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(h, 5 * g + 1, 5) AS BIGINT) >> (15 - 5 * k)) & 31) + 1, 1)),
    '')), '') AS payload_digest FROM sized)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM coded""")
def op9_arc_to_warc(spark, folder):
    return warc.archived(table(spark, folder, "pages"))


@query()
def op10_url_filter(spark, folder):
    return url_filter.judged(table(spark, folder, "pages"))


@query(doubling.oracle())
def op11_substring_dedup(spark, folder):
    kept = doubling.without_repeats(table(spark, folder, "documents"), keep=["doc_id"])
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query(resampling.oracle())
def op12_importance_resampling(spark, folder):
    docs = table(spark, folder, "documents")
    return resampling.resampled(docs, table(spark, folder, "benchmark"), keep=["doc_id"]).drop("n_words")


@query()
def op13_periodic_runs(spark, folder):
    return periodic.digests(table(spark, folder, "documents"))
