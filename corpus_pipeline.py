"""The training-data pipeline: quality, exact dedup, near dedup, mix, pack.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before
kept; all but the last return the columns of ``documents``. Defined cases, for all
stages: a null text is an empty one and stays null in what is returned, a null
source or language is a value like any other, a null id is an id like any other
but smaller. An empty table gives no rows. Columns besides those of ``documents``
are ignored and dropped, whatever their names. Texts of any length are whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from enrichkit.llm import exact_dedup, mixing, packing, quality, simhash
from enrichkit.llm.common import materialize, ship, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _with_keys(docs: DataFrame) -> DataFrame:
    """Non-null keys that tell a row by its id and text."""
    raw = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    return docs.select(*COLUMNS, F.xxhash64("doc_id").alias("_id"), F.sha2(raw, 256).alias("_sha"))


def _first_of_each(rows: DataFrame) -> DataFrame:
    """One row of those that agree in id and text. Their keys are already
    together after a join on them, so this needs no shuffle of its own."""
    nth = F.row_number().over(Window.partitionBy("_sha", "_id").orderBy("lang", "source"))
    return rows.withColumn("_nth", nth).filter("_nth = 1").drop("_nth")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier rejects go. Empty and null texts score 0
    and go; repeated rows and copies score alike and stay or go together; rows and
    their other columns are unchanged. Without labels of both classes nothing goes."""
    ship(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs.select(*COLUMNS), model)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id stays; of rows that agree in
    text and that id, the first by language and source. All empty and null texts
    are one group. Texts of one id that differ are different documents."""
    ship(spark)
    named = exact_dedup.exact_dedup(docs)
    kept = materialize(named.filter("kept").select(F.col("text_sha256").alias("_sha"),
                                                   F.xxhash64("doc_id").alias("_id")).distinct(), "pipe-exact")
    return _first_of_each(_with_keys(docs).join(kept, ["_sha", "_id"], "left_semi")).select(*COLUMNS)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate component, the row with the smallest id stays (null
    ids only where no row has one); of rows with that id the one with the smallest
    text hash, then the first by language and source. Texts without words have
    fingerprint zero and are one component."""
    ship(spark)
    keyed = _with_keys(docs)
    found = simhash.simhash_near_dedup(docs, shingle=3, radius=3)
    first = found.groupBy("label").agg(F.min(F.struct("component_id", "doc_id", "th")).alias("rep"),
                                       F.min(F.when(F.col("doc_id") == F.col("component_id"),
                                                    F.struct("doc_id", "th"))).alias("own"))
    rep = F.coalesce(F.col("own"), F.struct(F.col("rep.doc_id").alias("doc_id"), F.col("rep.th").alias("th")))
    kept = materialize(first.select(F.xxhash64(rep["doc_id"]).alias("_id"), rep["th"].alias("_th")), "pipe-near")
    raw = F.xxhash64(F.col("text").cast("binary"))
    rows = keyed.withColumn("_th", raw).join(kept, ["_id", "_th"], "left_semi")
    return _first_of_each(rows).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, up to three times, so rows
    may repeat in what is returned. A null source is a source of its own; texts
    without words are taken once and weigh nothing. Rows that agree in id and text
    come as copies of one of them, in the sum of their numbers."""
    ship(spark)
    keyed = _with_keys(docs)
    mixed = mixing.mix(docs, weights=(1, 2, 3), cap=3.0,
                       carry={"_sha": F.sha2(F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary")), 256)})
    copies = materialize(mixed.groupBy("_sha", F.xxhash64("doc_id").alias("_id"))
                         .agg(F.sum("copies").cast("int").alias("copies")).filter("copies > 0"), "pipe-copies")
    rows = _first_of_each(keyed.join(copies, ["_sha", "_id"]))
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of power-of-two lengths, no two documents in one. Each row
    is packed for itself, repeated ones too; an empty or null text is the end
    token alone."""
    ship(spark)
    out = packing.pack(docs, payload={**packing.digest_payload(), "ids": F.col("ids")})
    return out.select("sequence_id", "offset", "doc_id", "start", "length", "doc_tokens", "ids_crc32", "ids")


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("simhash", simhash_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: The stages cannot be written in SQL (a trained field, Newton steps, a
#: tokenizer); the pipeline is tested against a brute-force version.
ORACLE_SQL = None
