"""Registered queries of the training-data operators: thin callables that
apply an operator with production parameters to its whole table and derive the
digest columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from enrichkit.llm import (conversation_trie, exact_dedup, mixing, nn_descent, packing, quality, secrets, simhash, spelling, substring_dedup,
                           suffix_dedup, url_filter, warc_fixity)
from enrichkit.llm.common import ship, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return fn
    return deco


@query("op1_merkle_fixity", warc_fixity.ORACLE_SQL)
def q_merkle_fixity(spark, sf):
    records = warc_fixity.page_records(table(spark, sf, "pages"))
    return warc_fixity.audit_hashes(*warc_fixity.replicas(records, warc_fixity.damage(F.col("record_id"), F.col("payload"))))


@query("op2_packing")
def q_packing(spark, sf):
    out = packing.pack(table(spark, sf, "documents"), payload=packing.digest_payload())
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query("op3_suffix_dedup")
def q_suffix_dedup(spark, sf):
    out = suffix_dedup.suffix_dedup(table(spark, sf, "documents"), length=400)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_simhash")
def q_simhash(spark, sf):
    out = simhash.simhash_near_dedup(table(spark, sf, "documents"), shingle=3, radius=3)
    return out.select("doc_id", "fingerprint", "component_id")


@query("op5_substring_dedup")
def q_substring_dedup(spark, sf):
    out = substring_dedup.substring_dedup(table(spark, sf, "documents"), length=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_nn_descent")
def q_nn_descent(spark, sf):
    return nn_descent.embedding_near_dedup(table(spark, sf, "embeddings"), threshold=0.9)


@query("op7_secrets")
def q_secrets(spark, sf):
    return secrets.digest(secrets.scan_secrets(table(spark, sf, "documents")))


@query("op8_mixing")
def q_mixing(spark, sf):
    out = mixing.mix(table(spark, sf, "documents"), weights=(1, 2, 3), cap=3.0)
    return out.select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


@query("op9_quality")
def q_quality(spark, sf):
    docs = table(spark, sf, "documents")
    model = quality.train(docs, table(spark, sf, "labels"))
    return quality.score_quality(docs, model, threshold=0.7)


@query("op10_exact_dedup", exact_dedup.ORACLE_SQL)
def q_exact_dedup(spark, sf):
    return exact_dedup.exact_dedup(table(spark, sf, "documents"))


@query("op13_url_filter", url_filter.oracle_sql())
def q_url_filter(spark, sf):
    rules = url_filter.rules_frame(spark, url_filter.RULES)
    return url_filter.url_filter(table(spark, sf, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


@query("op11_spelling", spelling.ORACLE_SQL)
def q_spelling(spark, sf):
    return spelling.spelling_variants(table(spark, sf, "documents"), min_length=5, min_count=3, ratio=2, modulus=97)


@query("op12_conversation_trie", conversation_trie.ORACLE_SQL)
def q_conversation_trie(spark, sf):
    return conversation_trie.conversation_trie(table(spark, sf, "conversations"), rebuild=True)
