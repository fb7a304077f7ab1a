"""Sorts, limits and batching (SL-1 .. SL-5).

``assign_batches`` numbers rows in a global order without moving all rows
into one task: the frame is range-partitioned by the order, each partition
numbers its own rows, and a per-partition offset table (one row per
partition, so its size is bounded by the partition count) is broadcast back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs: Sequence[Column | str]) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def next_batch(df: DataFrame, order_by: Sequence[Column | str], n: int) -> DataFrame:
    """SL-2: ORDER BY ... LIMIT n (TakeOrderedAndProject: a top-n per
    partition, then a merge of at most n rows per partition)."""
    return df.orderBy(*_cols(order_by)).limit(n)


def latest_n(df: DataFrame, ts: str, n: int) -> DataFrame:
    """SL-3: ORDER BY ts DESC LIMIT n; ties go by every column in order."""
    return df.orderBy(F.col(ts).desc(), *[F.col(c).asc_nulls_last() for c in df.columns]).limit(n)


def global_rank(df: DataFrame, order_by: Sequence[Column | str], name: str = "rank",
                checkpoint: bool = True, with_total: bool = False) -> DataFrame:
    """1-based position of each row in a total order, computed distributed.

    ``order_by`` must be a total order (ties make the rank arbitrary). With
    ``checkpoint`` the indexed rows are cut from their lineage (reliable
    checkpoint in the cluster's checkpoint folder) so that a lost executor
    cannot renumber a partition differently between the two passes.
    """
    indexed = (df.orderBy(*_cols(order_by))
               .withColumn("_pid", F.spark_partition_id())
               .withColumn("_mid", F.monotonically_increasing_id()))
    if checkpoint:
        from enrichkit.session import cut_lineage
        indexed = cut_lineage(indexed)
    per_part = indexed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"),
                                           F.min("_mid").alias("_first"))
    # one row per partition: a window over it is tiny and runs on one task
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (per_part.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
               .withColumn("_total", F.sum("_n").over(Window.partitionBy())))
    out = (indexed.join(F.broadcast(offsets.select("_pid", "_off", "_first", "_total")), "_pid")
           .withColumn(name, F.col("_off") + (F.col("_mid") - F.col("_first")) + 1)
           .drop("_pid", "_mid", "_off", "_first"))
    return out if with_total else out.drop("_total")


def assign_batches(df: DataFrame, n: int, order_by: Sequence[Column | str],
                   label_prefix: str = "retry-", checkpoint: bool = True) -> DataFrame:
    """SL-4 + SL-5: chunk a set into batches of ``n`` in ``order_by`` order.

    Adds ``batch_no`` (1-based), ``batch_label`` ('retry-k'), ``batch_rows``
    (rows in that batch) and ``is_last`` (``batch_rows < n``, the reference's
    stop test; a full final batch is not last, the next fetch is empty).
    """
    ranked = global_rank(df, order_by, "_rank", checkpoint=checkpoint, with_total=True)
    b = F.floor((F.col("_rank") - 1) / F.lit(n)).cast("bigint") + 1
    rows_in = F.least(F.lit(n), F.col("_total") - (b - 1) * F.lit(n))
    return (ranked.withColumn("batch_no", b)
            .withColumn("batch_label", F.concat(F.lit(label_prefix), b.cast("string")))
            .withColumn("batch_rows", rows_in.cast("bigint"))
            .withColumn("is_last", F.col("batch_rows") < F.lit(n))
            .withColumnRenamed("_rank", "row_in_order")
            .drop("_total"))
