"""Candidate selection (PL-1 .. PL-3).

Written in the source's evaluation order: WHERE -> window -> QUALIFY ->
DISTINCT -> ORDER BY -> LIMIT. Every step is a DataFrame operator, so
Catalyst prunes columns down to the scans and turns NOT EXISTS into
left-anti joins; AQE picks broadcast or shuffled joins from measured sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from enrichkit.operators.batching import next_batch
from enrichkit.operators.dedup import latest_per_key
from enrichkit.operators.joins import exclude_processed, keep_present, left_join_on_key_and_day
from enrichkit.session import cut_lineage
from enrichkit.spec import RunSpec


def _total(df: DataFrame, order: list[Column]) -> list[Column]:
    """``order`` and then every column, so that rows that tie are equal."""
    return [*order, *[F.col(c).asc_nulls_last() for c in df.columns]]


def latest_customers(customers: DataFrame) -> DataFrame:
    """WN-1: newest CUSTOMER row per id (tie: cuid, addresses for a total order)."""
    return latest_per_key(customers, ["id"], _total(customers, [F.col("partition_date").desc()]))


def latest_applications(apps: DataFrame) -> DataFrame:
    """WN-1 on a compound key (customer_id, serial_number)."""
    return latest_per_key(apps, ["customer_id", "serial_number"],
                          _total(apps, [F.col("partition_date").desc(), F.col("created_at").desc()]))


def _device_joined(events: DataFrame, customers: DataFrame, apps: DataFrame,
                   first_serial_only: bool = False) -> DataFrame:
    """JN-1 + JN-2. With ``first_serial_only`` the applications are first
    reduced to the lowest serial per (customer, day): when only that serial
    can survive the later de-duplication, this removes the join fan-out of a
    customer with many applications on one day before anything is shuffled."""
    c = latest_customers(customers).select(F.col("id").alias("c_id"), F.col("cuid").alias("c_cuid"))
    ap = latest_applications(apps).select("customer_id", "serial_number", "created_at")
    if first_serial_only:
        ap = (ap.groupBy("customer_id", F.to_date("created_at").alias("_day"))
              .agg(F.min("serial_number").alias("serial_number"))
              .select("customer_id", "serial_number", F.col("_day").cast("timestamp_ntz").alias("created_at")))
    # JN-1: candidate -> customer on cuid
    m = events.join(c, events["cuid"] == c["c_cuid"], "left")
    # JN-2: -> application on customer id and the calendar day
    return left_join_on_key_and_day(m, ap, "c_id", "customer_id", "created_timestamp", "created_at")


def daily_candidates(events: DataFrame, customers: DataFrame, apps: DataFrame,
                     done_tables: list[DataFrame], dead_letter: DataFrame,
                     spec: RunSpec, limit: bool = True) -> DataFrame:
    """PL-1: next batch of device references to look up, or everything pending
    without ``limit``.

    With ``limit`` the batch is cut before any join: the left joins and the
    latest row per reference keep exactly one row for each, so the batch is
    the smallest pending references, and only their rows are joined.

    ``done_tables``: frames with ``reference_id`` already in RAW (Android, iOS).
    ``dead_letter``: failed-retry rows; only those written on ``spec.as_of``
    (the run's partition date) exclude a reference (JN-6).
    """
    ev = events.filter(F.col("cuid").isNotNull() & F.col("reference_id").isNotNull())   # FLT-1
    if spec.device_type:                                                                  # FLT-8
        ev = ev.filter(F.upper("device_os") == F.lit(spec.device_type.upper()))
    failed_today = dead_letter.filter(F.col("partition_date") == F.lit(spec.as_of))
    done = [(d, {"reference_id": "reference_id"}) for d in done_tables]
    done.append((failed_today, {"reference_id": "reference_id"}))
    pending = exclude_processed(ev, done)                                                 # JN-5, JN-6
    if limit:                                                                             # SL-2
        first = cut_lineage(next_batch(pending.select("reference_id").distinct(), ["reference_id"],
                                       spec.batch_size))
        pending = ev.join(F.broadcast(first), "reference_id", "left_semi")                # at most batch_size keys
        own = pending.select(F.col("cuid").alias("c_cuid")).distinct()
        ids = customers.join(own, customers["cuid"] == own["c_cuid"], "left_semi").select("id").distinct()
        customers = keep_present(customers, ids, {"id": "id"})                            # JN-10
        apps = keep_present(apps, ids.withColumnRenamed("id", "owner"), {"customer_id": "owner"})
    # WN-2 keeps the lowest serial of a reference: reduce before joining
    j = _device_joined(pending, customers, apps, first_serial_only=True)
    proj = j.select("cuid", "reference_id", "device_os", "created_timestamp",
                    "serial_number", "partition_date")
    # WN-2: one row per reference after the join fan-out; tie -> lowest serial
    latest = latest_per_key(proj, ["reference_id"],
                            _total(proj, [F.col("partition_date").desc(), F.col("serial_number").asc_nulls_last()]))
    rows = latest.distinct()                                                              # AG-9
    return rows.orderBy("reference_id", "cuid") if limit else rows


def range_candidates(events: DataFrame, customers: DataFrame, apps: DataFrame,
                     done_tables: list[DataFrame], spec: RunSpec) -> DataFrame:
    """PL-2: references created in [start, end]; no cuid filter, no dead-letter
    exclusion, no post-join de-duplication, ordered by creation time."""
    s = spec.with_range_defaults()
    s.validate()
    ev = events.filter(F.to_date("created_timestamp").between(F.lit(s.start_date), F.lit(s.end_date))
                       & F.col("reference_id").isNotNull())                              # FLT-5
    ev = exclude_processed(ev, [(d, {"reference_id": "reference_id"}) for d in done_tables])
    j = _device_joined(ev, customers, apps)
    proj = j.select("cuid", "reference_id", "device_os", "created_timestamp", "serial_number")
    return next_batch(proj, [F.col("created_timestamp"), F.col("reference_id"),
                             F.col("serial_number").asc_nulls_last(), F.col("cuid").asc_nulls_last(),
                             F.col("device_os").asc_nulls_last()], s.batch_size)


def geo_candidates(customers: DataFrame, apps: DataFrame, apply_info: DataFrame,
                   geo_raw_done: DataFrame, geo_dead_letter: DataFrame,
                   spec: RunSpec, limit: bool = True) -> DataFrame:
    """PL-3 (daily): customer x application x apply-info, active applications
    with coordinates, not yet in RAW or in the failed-retry list: the next
    batch, or everything pending without ``limit``."""
    c = customers.select(F.col("id").alias("c_id"), F.col("cuid").alias("c_cuid"),
                         "current_detailed_address", "permanent_detailed_address")
    ap = apps.filter((F.col("status") == "ACTIVE") & F.col("serial_number").isNotNull())  # FLT-2
    ay = apply_info.filter((F.col("longitude") != F.lit("null"))
                           & (F.col("latitude") != F.lit("null")))                        # FLT-3
    j = (c.filter(F.col("c_cuid").isNotNull())
         .join(ap, F.col("c_id") == ap["customer_id"])                                    # JN-3
         .join(ay, F.col("c_cuid") == ay["cuid"]))
    j = exclude_processed(j, [(geo_raw_done, {"serial_number": "serial_number"}),
                              (geo_dead_letter, {"serial_number": "series_number"})])      # JN-5
    proj = j.select(F.col("c_cuid").alias("cuid"), "serial_number", "created_at",
                    "current_detailed_address", "permanent_detailed_address", "tax_code",
                    "company_name", "longitude", "latitude", "partition_date", "bq_updated_time")
    latest = latest_per_key(proj, ["cuid", "serial_number"],
                            _total(proj, [F.col("bq_updated_time").desc(), F.col("partition_date").desc()])) \
        .drop("bq_updated_time")
    return next_batch(latest, ["cuid", "serial_number"], spec.batch_size) if limit else latest


def geo_range_candidates(customers: DataFrame, apps: DataFrame, apply_info: DataFrame,
                         geo_raw_done: DataFrame, spec: RunSpec) -> DataFrame:
    """PL-3 (range): LEFT joins made inner by the date predicate (JN-4),
    distinct 4 columns. Unlike the source, done serials are excluded so a
    paging caller terminates; the caller pages with ``next_batch`` (the rows
    come in the key order of the source)."""
    s = spec.with_range_defaults()
    s.validate()
    c = customers.select(F.col("id").alias("c_id"), F.col("cuid").alias("c_cuid"))
    j = (c.join(apps, F.col("c_id") == apps["customer_id"], "left")
         .join(apply_info, F.col("c_cuid") == apply_info["cuid"], "left")
         .filter(F.col("c_cuid").isNotNull()
                 & F.col("partition_date").between(F.lit(s.start_date), F.lit(s.end_date))))
    j = exclude_processed(j, [(geo_raw_done, {"serial_number": "serial_number"})])
    proj = j.select(F.col("c_cuid").alias("cuid"), "serial_number", "longitude", "latitude",
                    "partition_date")
    latest = latest_per_key(proj, ["cuid", "serial_number"],
                            _total(proj, [F.col("partition_date").desc()]))
    return latest.drop("partition_date").distinct().orderBy("cuid", "serial_number")
