"""End-to-end runs (PL-10, PL-11) on zones under ``root``.

``run_geo``: reconcile -> candidates -> enrich -> retry -> flatten -> done
message; ``run_device``: candidates -> lookup -> landing -> RAW by device ->
dead letter -> both flattens -> done message. Both write landing documents,
API-log and flow-log rows.

Differences to the reference, on purpose:
- all pending candidates are enriched in one distributed pass (the
  reference's LIMIT loop existed for an external rate limit); batch numbers
  are still assigned (SL-4) for the summary;
- the dead-letter update of PL-8 is an append of newer versions (Parquet has
  no UPDATE); the zone is read with ``latest_versions``, so no old file has to
  be found and replaced;
- the done message is emitted only when the flatten step succeeded.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from enrichkit.operators.batching import assign_batches
from enrichkit.plans.candidates import daily_candidates, geo_candidates
from enrichkit.plans.enrich import (GEO_KEYS, geo_outcomes, geo_split, lookup_join, route_by_device,
                                    split_outcomes, to_dead_letter, to_raw)
from enrichkit.plans.flatten import flatten_device, flatten_geo, geo_feature_schema
from enrichkit.plans.mappings import ANDROID, IOS
from enrichkit.plans.opslog import batch_summary
from enrichkit.plans.retry import latest_versions, reconcile, retry_batches, retry_list, to_candidates
from enrichkit.plans.versions import current
from enrichkit.session import cut_lineage
from enrichkit.sources.zones import (api_log_rows, conform, flow_log_rows, land_json, read_zone,
                                     read_zone_or_none, write_zone)
from enrichkit.spec import RunSpec, ntz
from enrichkit.streaming.messages import done_message, outbox_frame

RAW, DEAD, FEATURES, LANDING = "geo_raw", "geo_dead_letter", "geo_features", "geo_landing"
DEVICE_RAW, DEVICE_DEAD, DEVICE_LANDING = "device_raw", "device_dead_letter", "device_landing"
DEVICE_FEATURES = {"android": "device_features_android", "ios": "device_features_ios"}
OUTBOX, FLOWLOG, APILOG = "outbox", "flow_log", "api_log"


@dataclass
class GeoSources:
    customers: DataFrame
    applications: DataFrame
    apply_info: DataFrame
    places: DataFrame
    failures: DataFrame | None = None     # lookup errors reported by the service hook


@dataclass
class DeviceSources:
    events: DataFrame
    customers: DataFrame
    applications: DataFrame
    payloads: DataFrame


def _zone(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """A zone, or an empty frame where it does not exist yet."""
    found = read_zone_or_none(spark, root, name)
    return spark.createDataFrame([], schema) if found is None else found


def _publish(spark: SparkSession, root: str, spec: RunSpec, file_list: list[str]) -> None:
    write_zone(outbox_frame(spark, [done_message(file_list)])
               .withColumn("partition_date", F.lit(spec.as_of)), f"{root}/{OUTBOX}")


def _step(log: list, code: str, name: str, work: Callable[[], None], done: str) -> bool:
    """Run a step and log its outcome with the whole error text."""
    try:
        work()
    except Exception as exc:
        log.append((code, name, "FAILED", str(exc)))
        return False
    log.append((code, name, "SUCCESS", done))
    return True


def reconcile_zone(spark: SparkSession, root: str, day: dt.date, now: dt.datetime) -> int:
    """PL-8 on the dead-letter zone: appends the resolved version of every
    unresolved row whose record reached RAW on ``day``; returns how many."""
    dead, raw = read_zone_or_none(spark, root, DEAD), read_zone_or_none(spark, root, RAW)
    if dead is None or raw is None:
        return 0
    hits = cut_lineage(reconcile(current(spark, f"{root}/{DEAD}"), raw, day, now).filter("reconciled").select(*dead.columns))
    n = hits.count()
    if n:
        write_zone(hits, f"{root}/{DEAD}")
    return n


def _geo_pass(spark: SparkSession, root: str, work: DataFrame, src: GeoSources, spec: RunSpec,
              now: dt.datetime) -> DataFrame:
    """Enrich one set of numbered records into RAW, dead letter, landing and
    API log; returns ``cuid, serial_number, batch_label, outcome``."""
    out = cut_lineage(geo_outcomes(work, src.places, src.failures))
    raw, dead = geo_split(out.select(*[c for c in out.columns if c not in _NUMBERS]), spec.as_of, now)
    raw = cut_lineage(raw)
    write_zone(raw, f"{root}/{RAW}")
    write_zone(dead, f"{root}/{DEAD}")
    land_json(raw, f"{root}/{LANDING}", ("partition_date",), key="serial_number", kind=None)
    calls = out.select("serial_number", F.explode("outcomes").alias("_o")).select(
        F.concat_ws("-", F.col("serial_number").cast("string"), "_o.scenario").alias("call"),
        # a record without coordinates is logged as a skipped call
        F.when(F.col("_o.ok") & (F.col("_o.count_text") == "null"), F.lit(None)).otherwise(F.col("_o.status"))
        .alias("status"), F.lit(None).cast("string").alias("error"), F.lit(0).alias("retry"))
    write_zone(api_log_rows(calls, "geo", "area_insights", "call", ntz(now), ntz(now), markers=[])
               .withColumn("partition_date", F.lit(spec.as_of)), f"{root}/{APILOG}")
    ok = F.forall("outcomes", lambda o: o["ok"])
    return out.select(*GEO_KEYS, "batch_label", F.when(ok, F.lit("success")).otherwise(F.lit("error")).alias("outcome"))


_NUMBERS = ("batch_no", "batch_label", "batch_rows", "is_last", "row_in_order")


def run_geo(spark: SparkSession, src: GeoSources, root: str, spec: RunSpec,
            now: dt.datetime) -> DataFrame:
    """One full geo run; returns the batch summary (AG-5) of new and retry work."""
    log: list[tuple] = []
    n_rec = reconcile_zone(spark, root, spec.as_of - dt.timedelta(days=1), now)
    log.append(("01", "reconcile", "SUCCESS", f"{n_rec} dead letters resolved"))

    pending = geo_candidates(src.customers, src.applications, src.apply_info,
                             _zone(spark, root, RAW, "serial_number bigint").select("serial_number"),
                             _zone(spark, root, DEAD, "series_number bigint").select("series_number"),
                             spec, limit=False)
    new = assign_batches(pending, spec.batch_size, [*GEO_KEYS], label_prefix="batch-")
    retry = read_zone_or_none(spark, root, DEAD)
    if retry is not None:                  # the failures of the window before this run's own (PL-7)
        old = retry_batches(retry_list(retry, spec, "series_number", bounded=True), spec.batch_size)
        retry = cut_lineage(to_candidates(old, _NUMBERS))
    results = [_geo_pass(spark, root, new, src, spec, now)]
    log.append(("02", "enrich", "SUCCESS", "new candidates enriched"))
    if retry is not None:
        results.append(_geo_pass(spark, root, retry, src, spec, now))
        log.append(("03", "retry", "SUCCESS", "retry list processed"))

    def flatten() -> None:
        raw = read_zone_or_none(spark, root, RAW)
        if raw is None:
            return
        target = _zone(spark, root, FEATURES, "serial_number bigint")
        feats = flatten_geo(raw, target.select("serial_number"))
        write_zone(conform(feats, geo_feature_schema()), f"{root}/{FEATURES}")   # SNK-2

    if _step(log, "04", "flatten", flatten, "features written"):
        _publish(spark, root, spec, [FEATURES])
    write_zone(flow_log_rows(spark, "geo_flow", spec.batch_uuid, log, now)
               .withColumn("partition_date", F.lit(spec.as_of)), f"{root}/{FLOWLOG}")
    work = results[0] if len(results) == 1 else results[0].unionByName(results[1])
    return (batch_summary(work, "batch_label", "serial_number").drop("skipped_count")
            .withColumn("records", F.col("success_count") + F.col("error_count")))


def run_device(spark: SparkSession, src: DeviceSources, root: str, spec: RunSpec,
               now: dt.datetime) -> DataFrame:
    """One full device run; returns the batch summary (AG-5)."""
    log: list[tuple] = []
    done = _zone(spark, root, DEVICE_RAW, "reference_id bigint").select("reference_id")
    dead_now = _zone(spark, root, DEVICE_DEAD, "reference_id bigint, partition_date date")
    pending = daily_candidates(src.events, src.customers, src.applications, [done],
                               dead_now.select(F.col("reference_id").cast("bigint").alias("reference_id"),
                                               "partition_date"), spec, limit=False)
    work = assign_batches(pending, spec.batch_size, ["reference_id", "cuid"], label_prefix="batch-")
    looked = cut_lineage(lookup_join(work, src.payloads, "reference_id"))
    ok, bad = split_outcomes(looked)
    raw = cut_lineage(to_raw(ok, spec.as_of, now, ["cuid", "reference_id", F.col("serial_number").alias("series_number"),
                                                   "device_os"]))
    write_zone(route_by_device(raw), f"{root}/{DEVICE_RAW}", ["route", "partition_date"])
    record = [c for c in pending.columns] + ["status", "error"]
    write_zone(to_dead_letter(bad, spec.as_of, now, {
        "cuid": ["cuid"], "reference_id": ["reference_id"], "series_number": ["serial_number"],
        "device_os": ["device_os"]}, payload_cols=record), f"{root}/{DEVICE_DEAD}")
    land_json(raw, f"{root}/{DEVICE_LANDING}")
    write_zone(api_log_rows(looked, "device", "insights", "reference_id", ntz(now), ntz(now))
               .withColumn("partition_date", F.lit(spec.as_of)), f"{root}/{APILOG}")
    log.append(("01", "enrich", "SUCCESS", "new references enriched"))

    def flatten(route: str, mapping) -> Callable[[], None]:
        def work() -> None:
            zone = read_zone_or_none(spark, root, DEVICE_RAW)
            if zone is None:
                return
            target = read_zone_or_none(spark, root, DEVICE_FEATURES[route])
            keys = None if target is None else target.select(F.col("raw_reference_id").alias("reference_number"))
            feats = flatten_device(zone.filter(F.col("route") == route), keys, mapping, with_key=True)
            write_zone(feats, f"{root}/{DEVICE_FEATURES[route]}")
        return work

    good = [_step(log, f"0{i}", f"flatten_{r}", flatten(r, m), "features written")
            for i, (r, m) in enumerate((("android", ANDROID), ("ios", IOS)), 2)]
    if all(good):
        _publish(spark, root, spec, list(DEVICE_FEATURES.values()))
    write_zone(flow_log_rows(spark, "device_flow", spec.batch_uuid, log, now)
               .withColumn("partition_date", F.lit(spec.as_of)), f"{root}/{FLOWLOG}")
    outcome = looked.select("batch_label", "reference_id", F.when(
        F.col("status").startswith("2"), F.lit("success")).otherwise(F.lit("error")).alias("outcome"))
    return (batch_summary(outcome, "batch_label", "reference_id").drop("skipped_count")
            .withColumn("records", F.col("success_count") + F.col("error_count")))
