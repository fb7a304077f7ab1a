"""Operational statistics over flow and API logs (AG-1 .. AG-5, AG-10, AG-11,
FN-10). All are partial-aggregating GROUP BYs: each task pre-aggregates its
rows before the shuffle, so a hot group costs one row per task."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from enrichkit.functions.scalars import is_failure, is_success_code

QUOTA_ALARM_PCT = 80.0


def flow_stats(flow_log: DataFrame) -> DataFrame:
    """AG-1: runs by flow, status and day."""
    return (flow_log.groupBy("flow_name", "status", F.to_date("datetime").alias("day"))
            .agg(F.count(F.lit(1)).alias("n")))


def api_stats(api_log: DataFrame) -> DataFrame:
    """AG-2: calls, average duration (s), retries by type, status, day."""
    secs = F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time"))
    return (api_log.groupBy("api_type", "status_code", F.to_date("start_time").alias("day"))
            .agg(F.count(F.lit(1)).alias("calls"),
                 F.round(F.avg(secs), 3).alias("avg_duration_s"),
                 F.sum("retry").alias("total_retries")))


def retry_stats(api_log: DataFrame) -> DataFrame:
    """AG-3: distribution of retry counts above zero."""
    return (api_log.filter(F.col("retry") > 0).groupBy("api_type", "retry")
            .agg(F.count(F.lit(1)).alias("n")))


def countif_stats(api_log: DataFrame, by_day: bool = True, api_type: str | None = None) -> DataFrame:
    """AG-4: conditional counts with max / avg and the last call's time,
    globally or by day, of all calls or one type. A call succeeds by the status
    rule of the lookups (2xx, or no status)."""
    if api_type is not None:
        api_log = api_log.filter(F.col("api_type") == F.lit(api_type))
    ok = is_success_code("status_code")
    keys = [F.to_date("start_time").alias("day")] if by_day else []
    g = api_log.groupBy(*keys) if keys else api_log.groupBy()
    return g.agg(F.count(F.lit(1)).alias("calls"),
                 F.count_if(ok).alias("ok_calls"),
                 F.count_if(~ok).alias("failed_calls"),
                 F.max("start_time").alias("last_call"),
                 F.max("retry").alias("max_retry"),
                 F.round(F.avg("retry"), 4).alias("avg_retry"))


def failed_since(dead_letter: DataFrame, since: dt.date) -> DataFrame:
    """AG-10: unresolved dead letters written since a date (a bare compare on
    the partition column, so old folders are not read)."""
    return (dead_letter.filter((F.col("partition_date") >= F.lit(since))
                               & F.coalesce(is_failure("api_status"), F.lit(False)))
            .agg(F.count(F.lit(1)).alias("failed")))


def quota_by_minute(calls: DataFrame, ts: str, limit_per_min: int,
                    alarm_pct: float = QUOTA_ALARM_PCT) -> DataFrame:
    """AG-11: calls per minute as a share of the limit, flagged above 80 %."""
    minute = F.date_trunc("minute", F.col(ts))
    if dict(calls.dtypes).get(ts) == "timestamp_ntz":   # date_trunc returns TIMESTAMP
        minute = minute.cast("timestamp_ntz")
    return (calls.groupBy(minute.alias("minute"))
            .agg(F.count(F.lit(1)).alias("calls"))
            .withColumn("usage_pct", F.round(F.col("calls") * 100.0 / F.lit(limit_per_min), 2))
            .withColumn("alarm", F.col("usage_pct") > F.lit(alarm_pct)))


def batch_summary(outcomes: DataFrame, batch_col: str, key: str, with_keys: bool = False) -> DataFrame:
    """AG-5: success / error / skipped counts per batch and, with
    ``with_keys``, the sorted keys a batch processed. Ask for the keys only
    when the batches are bounded (``assign_batches``)."""
    aggs = [F.count_if(F.col("outcome") == "success").alias("success_count"),
            F.count_if(F.col("outcome") == "error").alias("error_count"),
            F.count_if(F.col("outcome") == "skipped").alias("skipped_count")]
    if with_keys:
        aggs.append(F.sort_array(F.collect_list(F.col(key).cast("string"))).alias("processed"))
    return outcomes.groupBy(batch_col).agg(*aggs)
