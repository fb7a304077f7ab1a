"""Retry list (PL-7, WN-3, FLT-4, FLT-6) and reconcile (PL-8, JN-10)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from enrichkit.functions.scalars import is_failure
from enrichkit.operators.batching import assign_batches
from enrichkit.operators.dedup import latest_per_key, latest_then_filter
from enrichkit.operators.joins import flag_present
from enrichkit.spec import RunSpec, ntz


def retry_window(dead_letter: DataFrame, spec: RunSpec, bounded: bool) -> DataFrame:
    """FLT-6 on the bare partition column (so partition pruning applies):
    device: partition_date >= D-n; geo: D-n .. D-m."""
    lo = spec.as_of - dt.timedelta(days=spec.retry_from_days)
    c = F.col("partition_date")
    if not bounded:
        return dead_letter.filter(c >= F.lit(lo))
    hi = spec.as_of - dt.timedelta(days=spec.retry_to_days)
    return dead_letter.filter(c.between(F.lit(lo), F.lit(hi)))


def retry_list(dead_letter: DataFrame, spec: RunSpec, key: str, bounded: bool) -> DataFrame:
    """PL-7: newest row per key inside the window, kept only if that newest
    row is a failure (the predicate runs after the rank), oldest update first."""
    w = retry_window(dead_letter, spec, bounded)
    return latest_then_filter(w, [key], [F.col("bq_updated_time").desc(), F.col("uuid").asc()],
                              is_failure("api_status")).orderBy(F.col("bq_updated_time").asc(), F.col("uuid").asc())


def retry_batches(retry: DataFrame, batch_size: int) -> DataFrame:
    """PL-7 chunking: batches 'retry-k' in update-time order (SL-4, SL-5)."""
    return assign_batches(retry, batch_size, [F.col("bq_updated_time").asc(), F.col("uuid").asc()],
                          label_prefix="retry-")


def to_candidates(retry: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """PRJ-6: geo dead-letter columns back to candidate columns (and ``carry``)."""
    return retry.select(
        "cuid", F.col("series_number").alias("serial_number"),
        F.col("contact_address").alias("current_detailed_address"),
        F.col("residence_address").alias("permanent_detailed_address"),
        "tax_code", "company_name",
        F.col("contract_longitude").alias("longitude"),
        F.col("contract_latitude").alias("latitude"),
        F.col("bq_updated_time").alias("created_at"), "partition_date", *carry)


def reconcile(dead_letter: DataFrame, raw: DataFrame, day: dt.date, now: dt.datetime,
              key: str = "series_number", raw_key: str = "serial_number") -> DataFrame:
    """PL-8: unresolved dead letters whose key reached RAW on ``day`` get
    status '200', update time ``now`` and partition ``day``. Returns the new
    version of the whole table with a ``reconciled`` flag. Parquet has no
    UPDATE: a zone appends the reconciled rows as newer versions and is read
    with ``latest_versions``."""
    landed = raw.filter(F.col("partition_date") == F.lit(day)).select(raw_key)
    flagged = flag_present(dead_letter, landed, key, raw_key, flag="_landed")
    hit = F.col("_hit")
    return (flagged
            .withColumn("_hit", F.col("_landed") & F.coalesce(is_failure("api_status"), F.lit(False)))
            .withColumn("api_status", F.when(hit, F.lit("200")).otherwise(F.col("api_status")))
            .withColumn("bq_updated_time", F.when(hit, ntz(now)).otherwise(F.col("bq_updated_time")))
            .withColumn("partition_date", F.when(hit, F.lit(day)).otherwise(F.col("partition_date")))
            .withColumnRenamed("_hit", "reconciled")
            .drop("_landed"))


def latest_versions(dead_letter: DataFrame) -> DataFrame:
    """The current row of every ``uuid`` of a zone to which newer versions of
    rows are appended (the newest update wins, a resolved row before another)."""
    return latest_per_key(dead_letter, ["uuid"], [
        F.col("bq_updated_time").desc(), is_failure("api_status").asc(), F.col("partition_date").desc()])
