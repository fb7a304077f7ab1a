"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
the analogy in ``enrichkit.sources.testdata``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from enrichkit.sources import testdata as td
from enrichkit.spec import DEVICE_DEFAULTS, GEO_DEFAULTS, RunSpec, ntz

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def device_spec(**kw) -> RunSpec:
    return RunSpec(**{"as_of": td.AS_OF, **DEVICE_DEFAULTS, **kw})


def geo_spec(**kw) -> RunSpec:
    return RunSpec(**{"as_of": td.AS_OF, **GEO_DEFAULTS, **kw})


@query("daily_candidates")
def q_daily_candidates(spark, sf):
    from enrichkit.plans.candidates import daily_candidates
    return daily_candidates(td.device_events(spark, sf), td.customers(spark, sf),
                            td.applications(spark, sf),
                            [td.device_raw_done(spark, sf, "android"), td.device_raw_done(spark, sf, "ios")],
                            td.device_dead_letter(spark, sf), device_spec())


@query("flatten_android")
def q_flatten_android(spark, sf):
    from enrichkit.plans.flatten import flatten_device
    from enrichkit.plans.mappings import ANDROID
    return flatten_device(td.device_raw(spark, sf), td.flattened_target(spark, sf), ANDROID)


@query("flatten_ios")
def q_flatten_ios(spark, sf):
    from enrichkit.plans.flatten import flatten_device
    from enrichkit.plans.mappings import IOS
    return flatten_device(td.device_raw(spark, sf, "IOS"), td.flattened_target(spark, sf), IOS)


@query("flatten_android_full")
def q_flatten_android_full(spark, sf):
    """PL-4 with payloads that fill all 222 columns."""
    from enrichkit.plans.flatten import flatten_device
    from enrichkit.plans.mappings import ANDROID
    return flatten_device(td.full_device_raw(spark, sf, ANDROID, "Android"), None, ANDROID)


@query("flatten_parsed")
def q_flatten_parsed(spark, sf):
    """PL-4, FN-1..4 from a RAW zone whose payloads were parsed when they landed."""
    from enrichkit.plans.flatten import flatten_device, parsed_raw
    from enrichkit.plans.mappings import ANDROID
    from enrichkit.session import scratch_path
    from enrichkit.sources.zones import read_zone, write_zone
    root = scratch_path(spark, "parsed")
    write_zone(parsed_raw(td.device_raw(spark, sf)), f"{root}/raw")
    return flatten_device(read_zone(spark, root, "raw"), td.flattened_target(spark, sf), ANDROID)


@query("flatten_ios_full")
def q_flatten_ios_full(spark, sf):
    """PL-5 with payloads that fill all 92 columns, sections in reverse order."""
    from enrichkit.plans.flatten import flatten_device
    from enrichkit.plans.mappings import IOS
    return flatten_device(td.full_device_raw(spark, sf, IOS, "IOS"), None, IOS)


@query("flatten_geo")
def q_flatten_geo(spark, sf):
    from enrichkit.plans.flatten import flatten_geo
    return flatten_geo(td.geo_raw(spark, sf), td.geo_target(spark, sf))


# ------------------------------------------------------------ dedup and joins
@query("latest_per_key")
def q_latest_per_key(spark, sf):
    from enrichkit.operators.dedup import latest_per_key
    ev = td.device_events(spark, sf)
    return latest_per_key(ev, ["cuid"], [F.col("created_timestamp").desc(), F.col("reference_id").asc()])


@query("latest_after_join")
def q_latest_after_join(spark, sf):
    from enrichkit.operators.dedup import latest_per_key
    from enrichkit.plans.candidates import latest_customers
    c = latest_customers(td.customers(spark, sf)).select("id", "cuid")
    a = td.applications(spark, sf)
    j = c.join(a, c["id"] == a["customer_id"], "left")
    return latest_per_key(j, ["id"], [F.col("created_at").desc(), F.col("serial_number").desc()]) \
        .select("id", "cuid", "serial_number", "created_at", "status")


@query("left_join_on_date")
def q_left_join_on_date(spark, sf):
    from enrichkit.operators.joins import left_join_on_key_and_day
    j = left_join_on_key_and_day(td.device_events(spark, sf), td.applications(spark, sf),
                                 "cuid", "customer_id", "created_timestamp", "created_at")
    return j.select("reference_id", "cuid", "created_timestamp", "serial_number")


@query("inner_chain")
def q_inner_chain(spark, sf):
    c = td.customers(spark, sf).select(F.col("id").alias("c_id"), F.col("cuid").alias("c_cuid"),
                                       "current_detailed_address")
    a = td.applications(spark, sf)
    ay = td.apply_info(spark, sf)
    j = c.join(a, F.col("c_id") == a["customer_id"]).join(ay, F.col("c_cuid") == ay["cuid"])
    return j.select(F.col("c_cuid").alias("cuid"), F.col("serial_number").alias("serial"),
                    F.col("created_at").alias("applied_at"),
                    F.col("current_detailed_address").alias("address"), "tax_code",
                    F.col("longitude").alias("lon"), F.col("latitude").alias("lat"))


@query("left_made_inner")
def q_left_made_inner(spark, sf):
    """JN-4: customer LEFT JOIN application LEFT JOIN line items, with a WHERE
    on the application side; Catalyst (EliminateOuterJoin) makes the first
    join inner, the second stays outer."""
    c = td.customers(spark, sf).select(F.col("id").alias("c_id"), F.col("cuid").alias("c_cuid"))
    a = td.applications(spark, sf)
    li = td.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    j = (c.join(a, F.col("c_id") == a["customer_id"], "left")
         .join(li, a["serial_number"] == li["l_orderkey"], "left")
         .filter(F.col("status") == "ACTIVE"))
    return j.select(F.col("c_cuid").alias("cuid"), "serial_number", "l_linenumber",
                    F.col("l_quantity").cast("bigint").alias("quantity"))


@query("exclude_processed")
def q_exclude_processed(spark, sf):
    from enrichkit.operators.joins import exclude_processed
    a = td.applications(spark, sf)
    li = td.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("serial_number"))
    dl_day = td.geo_dead_letter(spark, sf).filter(F.col("partition_date") == F.lit(dt.date(2024, 1, 5)))
    out = exclude_processed(a, [(li, {"serial_number": "serial_number"}),
                                (dl_day, {"serial_number": "series_number"})])
    return out.select("customer_id", "serial_number", "status")


@query("exclude_processed_sketch")
def q_exclude_processed_sketch(spark, sf):
    """JN-5 with the done tables sieved by a bit sketch of the pending keys."""
    from enrichkit.operators.joins import exclude_processed
    a = td.applications(spark, sf)
    done = td.table(spark, sf, "lineitem").select("l_orderkey")
    dl = td.geo_dead_letter(spark, sf).filter(F.col("partition_date") == F.lit(dt.date(2024, 1, 5)))
    return exclude_processed(a, [(done, {"serial_number": "l_orderkey"}), (dl, {"serial_number": "series_number"})],
                             sketch_bits=20).select("customer_id", "serial_number", "status")


@query("incremental")
def q_incremental(spark, sf):
    from enrichkit.operators.joins import incremental
    return incremental(td.geo_raw(spark, sf), td.geo_target(spark, sf),
                       "serial_number", "serial_number").select("serial_number", "cuid")


@query("semi_reconcile")
def q_semi_reconcile(spark, sf):
    from enrichkit.plans.retry import reconcile
    out = reconcile(td.geo_dead_letter(spark, sf, whole=True), td.geo_raw_landed(spark, sf),
                    dt.date(2024, 1, 15), dt.datetime(2024, 1, 31, 0, 0))
    return out.select("uuid", "series_number", "api_status", "bq_updated_time", "partition_date",
                      "reconciled")


# ------------------------------------------------------------ pipelines
@query("range_candidates")
def q_range_candidates(spark, sf):
    from enrichkit.plans.candidates import range_candidates
    return range_candidates(td.device_events(spark, sf), td.customers(spark, sf),
                            td.applications(spark, sf),
                            [td.device_raw_done(spark, sf, "android"), td.device_raw_done(spark, sf, "ios")],
                            device_spec(start_date=dt.date(2024, 1, 10), end_date=dt.date(2024, 1, 12)))


@query("geo_candidates")
def q_geo_candidates(spark, sf):
    from enrichkit.plans.candidates import geo_candidates
    return geo_candidates(td.customers(spark, sf), td.applications(spark, sf), td.apply_info(spark, sf),
                          td.geo_raw_done(spark, sf), td.geo_dead_letter(spark, sf), geo_spec())


@query("geo_range_candidates")
def q_geo_range_candidates(spark, sf):
    from enrichkit.plans.candidates import geo_range_candidates
    return geo_range_candidates(td.customers(spark, sf), td.applications(spark, sf),
                                td.apply_info(spark, sf), td.geo_raw_done(spark, sf),
                                geo_spec(start_date=dt.date(1998, 1, 1), end_date=dt.date(1998, 3, 31)))


@query("retry_list")
def q_retry_list(spark, sf):
    from enrichkit.plans.retry import retry_list
    return retry_list(td.device_dead_letter(spark, sf), device_spec(), "reference_id", bounded=False)


@query("retry_list_geo")
def q_retry_list_geo(spark, sf):
    from enrichkit.plans.retry import retry_list
    return retry_list(td.geo_dead_letter(spark, sf, whole=True), geo_spec(), "series_number", bounded=True)


@query("distinct_pairs")
def q_distinct_pairs(spark, sf):
    from enrichkit.operators.dedup import distinct_rows
    return distinct_rows(td.device_events(spark, sf), ["cuid", "device_os"])


@query("union_retry")
def q_union_retry(spark, sf):
    from enrichkit.plans.candidates import geo_candidates
    from enrichkit.plans.retry import retry_list, to_candidates
    cols = ["cuid", "serial_number", "current_detailed_address", "permanent_detailed_address",
            "tax_code", "company_name", "longitude", "latitude"]
    new = geo_candidates(td.customers(spark, sf), td.applications(spark, sf), td.apply_info(spark, sf),
                         td.geo_raw_done(spark, sf), td.geo_dead_letter(spark, sf), geo_spec())
    retry = to_candidates(retry_list(td.geo_dead_letter(spark, sf), geo_spec(), "series_number", True))
    return (new.select(*cols).withColumn("origin", F.lit("new"))
            .unionByName(retry.select(*cols).withColumn("origin", F.lit("retry"))))


# ------------------------------------------------------------ enrichment
@query("poi_counts")
def q_poi_counts(spark, sf):
    from enrichkit.operators.radius import poi_counts
    from enrichkit.plans.enrich import RADIUS_M, SCENARIOS
    a = td.apply_info(spark, sf)
    pts = a.select("cuid", F.col("latitude").try_cast("double").alias("lat"),
                   F.col("longitude").try_cast("double").alias("lon"))
    return poi_counts(pts, td.pois(spark, sf), SCENARIOS, RADIUS_M, point_key="cuid")


@query("scenario_gate")
def q_scenario_gate(spark, sf):
    from enrichkit.plans.enrich import geo_lookup, scenario_gate
    return scenario_gate(geo_lookup(td.geo_points(spark, sf), td.pois(spark, sf), td.geo_failures(spark, sf)))


@query("scenario_summary")
def q_scenario_summary(spark, sf):
    from enrichkit.plans.enrich import geo_lookup, scenario_summary
    return scenario_summary(geo_lookup(td.geo_points(spark, sf), td.pois(spark, sf), td.geo_failures(spark, sf)))


@query("geo_enrichment")
def q_geo_enrichment(spark, sf):
    from enrichkit.plans.enrich import geo_enrich
    raw, dead = geo_enrich(td.geo_points(spark, sf), td.pois(spark, sf), td.AS_OF,
                           dt.datetime(2024, 1, 31, 0, 0), td.geo_failures(spark, sf))
    r = raw.select(F.lit("raw").alias("zone"), "serial_number", "cuid", "raw_data",
                   F.lit(None).cast("string").alias("api_status"),
                   F.lit(None).cast("string").alias("api_payload_message"))
    d = dead.select(F.lit("dead_letter").alias("zone"), F.col("series_number").alias("serial_number"),
                    "cuid", F.lit(None).cast("string").alias("raw_data"), "api_status",
                    "api_payload_message")
    return r.unionByName(d)


def _device_lookup(spark, sf):
    from enrichkit.plans.enrich import lookup_join
    return lookup_join(td.device_events(spark, sf), td.device_payloads(spark, sf), "reference_id")


@query("device_enrichment")
def q_device_enrichment(spark, sf):
    from enrichkit.plans.enrich import split_outcomes, to_dead_letter, to_raw
    ok, bad = split_outcomes(_device_lookup(spark, sf))
    now = dt.datetime(2024, 1, 31, 0, 0)
    raw = to_raw(ok, td.AS_OF, now, ["cuid", "reference_id", "device_os"])
    dead = to_dead_letter(bad, td.AS_OF, now, {"cuid": ["cuid"], "reference_id": ["reference_id"],
                                               "device_os": ["device_os"]},
                          payload_cols=["cuid", "reference_id", "device_os"])
    r = raw.select(F.lit("raw").alias("zone"), F.col("cuid").cast("bigint").alias("cuid"),
                   F.col("reference_id").cast("bigint").alias("reference_id"), "device_os",
                   "raw_data", F.lit(None).cast("string").alias("api_status"))
    d = dead.select(F.lit("dead_letter").alias("zone"), F.col("cuid").cast("bigint").alias("cuid"),
                    F.col("reference_id").cast("bigint").alias("reference_id"), "device_os",
                    F.lit(None).cast("string").alias("raw_data"), "api_status")
    return r.unionByName(d)


@query("route_by_device")
def q_route_by_device(spark, sf):
    from enrichkit.plans.enrich import route_by_device, split_outcomes
    ok, _ = split_outcomes(_device_lookup(spark, sf))
    return route_by_device(ok.select("cuid", "reference_id", "device_os"))


@query("dead_letter")
def q_dead_letter(spark, sf):
    from enrichkit.plans.candidates import _device_joined
    from enrichkit.plans.enrich import split_outcomes, to_dead_letter
    _, bad = split_outcomes(_device_lookup(spark, sf))
    j = _device_joined(bad, td.customers(spark, sf), td.applications(spark, sf))
    dead = to_dead_letter(j, td.AS_OF, dt.datetime(2024, 1, 31), {
        "cuid": ["cuid"], "reference_id": ["reference_id"],
        "series_number": ["serial_number", "device_os"], "device_os": ["device_os"]},
        payload_cols=["reference_id", "status"])
    return dead.drop("uuid")


@query("raw_rows")
def q_raw_rows(spark, sf):
    from enrichkit.plans.enrich import split_outcomes, to_raw
    ok, _ = split_outcomes(_device_lookup(spark, sf))
    return to_raw(ok, td.AS_OF, dt.datetime(2024, 1, 31), ["cuid", "reference_id", "device_os"]).drop("uuid")


@query("enrich_lookup")
def q_enrich_lookup(spark, sf):
    from enrichkit.plans.enrich import lookup_with_resolver

    def resolver(pdf):
        import pandas as pd
        found = pdf["value"] >= 5
        payload = ('{"referenceNumber":"' + pdf["event_id"].astype(str) + '","props":'
                   + pdf["props"].astype(str) + "}")
        return pd.DataFrame({"payload": payload.where(found, None),
                             "status": found.map({True: "200", False: "404"}),
                             "error": found.map({True: None, False: "not found"}),
                             "retry": 0})

    e = td.table(spark, sf, "events").select("event_id", "value", "props")
    out = lookup_with_resolver(e, "event_id", resolver)
    return out.select("event_id", "status", "payload")


# ------------------------------------------------------------ functions
@query("json_scalar")
def q_json_scalar(spark, sf):
    from enrichkit.functions.json import json_value, parse
    e = td.table(spark, sf, "events")
    v = parse("props")
    return e.select("event_id", json_value(v, "$.k").alias("k"), json_value(v, "$").alias("whole"),
                    json_value(v, "$.missing").alias("missing"))


@query("json_explode")
def q_json_explode(spark, sf):
    from enrichkit.functions.json import json_array, json_query, json_value, parse
    from enrichkit.plans.flatten import latest_raw
    raw = latest_raw(td.device_raw(spark, sf), "reference_id")
    items = raw.select("reference_id", F.posexplode(json_array(parse("raw_data"), "$.insights")).alias("pos", "i"))
    return items.select("reference_id", "pos", json_value("i", "$.code").alias("code"),
                        json_value("i", "$.calculatedDate").alias("calculated_date"),
                        json_value(json_query("i", "$.value"), "$").alias("value_scalar"))


@query("log_search")
def q_log_search(spark, sf):
    from enrichkit.functions.scalars import extract_or_null
    p = td.table(spark, sf, "pages")
    return p.filter(F.col("url").contains("/en/")).select(
        "page_id", extract_or_null("url", r"/([0-9]+)(\?|#|$)").alias("url_id"))


@query("severity")
def q_severity(spark, sf):
    from enrichkit.functions.scalars import (RETRYABLE_DEVICE, RETRYABLE_GEO, is_retryable,
                                             severity)
    dl = td.device_dead_letter(spark, sf)
    return dl.select("uuid", "api_status", severity("api_status", "api_payload_message").alias("severity"),
                     is_retryable("api_status", RETRYABLE_DEVICE).alias("retry_device"),
                     is_retryable("api_status", RETRYABLE_GEO).alias("retry_geo"))


@query("coords_valid")
def q_coords_valid(spark, sf):
    from enrichkit.functions.scalars import coords_valid
    a = td.geo_raw(spark, sf)
    return a.select("serial_number",
                    coords_valid("contract_latitude", "contract_longitude").alias("valid"),
                    coords_valid("contract_latitude", "contract_longitude", strict=True).alias("strict_valid"))


@query("date_valid")
def q_date_valid(spark, sf):
    from enrichkit.functions.scalars import date_valid
    d = td.date_texts(spark, sf)
    return d.select("event_id", "date_text", date_valid("date_text"))


@query("count_normalise")
def q_count_normalise(spark, sf):
    from enrichkit.functions.json import parse
    from enrichkit.functions.scalars import count_normalise
    r = td.lookup_responses(spark, sf)
    return r.select("event_id", count_normalise(parse("response")).alias("count_text"))


@query("ids")
def q_ids(spark, sf):
    from enrichkit.functions.scalars import flow_id, split_code_name
    e = td.device_events(spark, sf)
    code_name = F.concat(F.lit("E"), F.lpad((F.col("cuid") % 100).cast("string"), 2, "0"),
                         F.lit("_load_"), F.lower(F.coalesce("device_os", F.lit("none"))))
    code, name = split_code_name(code_name)
    return e.select("reference_id",
                    flow_id(F.lit("credit_flow"), F.col("reference_id").cast("string")).alias("flow_id"),
                    F.concat(F.lit("credit_flow"), code).alias("task_code"),
                    code.alias("code"), name.alias("name"),
                    F.lower("device_os").alias("os_lower"), F.upper("device_os").alias("os_upper"),
                    F.concat_ws("_", F.col("partition_date").cast("string"), F.lower("device_os"),
                                F.col("reference_id").cast("string")).alias("landing_name"))


@query("masked")
def q_masked(spark, sf):
    from enrichkit.functions.masking import mask_columns
    a = td.apply_info(spark, sf)
    return mask_columns(a, ["longitude", "latitude", "company_name"], method="sha2")


@query("messages")
def q_messages(spark, sf):
    from enrichkit.streaming.messages import decode, route
    r = route(decode(td.control_messages(spark, sf)))
    return r.select("message_id", "message_type", "route", "batch_number", "start_date", "end_date",
                    "valid", "subscription")


# ------------------------------------------------------------ aggregates
@query("flow_stats")
def q_flow_stats(spark, sf):
    from enrichkit.plans.opslog import flow_stats
    return flow_stats(td.flow_log(spark, sf))


@query("api_stats")
def q_api_stats(spark, sf):
    from enrichkit.plans.opslog import api_stats
    return api_stats(td.api_log(spark, sf))


@query("retry_stats")
def q_retry_stats(spark, sf):
    from enrichkit.plans.opslog import retry_stats
    return retry_stats(td.api_log(spark, sf))


@query("countif_stats")
def q_countif_stats(spark, sf):
    from enrichkit.plans.opslog import countif_stats
    return countif_stats(td.api_log(spark, sf), by_day=True)


@query("countif_stats_global")
def q_countif_stats_global(spark, sf):
    from enrichkit.plans.opslog import countif_stats
    return countif_stats(td.api_log(spark, sf), by_day=False)


@query("failed_since")
def q_failed_since(spark, sf):
    from enrichkit.plans.opslog import failed_since
    return failed_since(td.device_dead_letter(spark, sf), dt.date(2024, 1, 15))


@query("quota_by_minute")
def q_quota_by_minute(spark, sf):
    from enrichkit.plans.opslog import quota_by_minute
    return quota_by_minute(td.table(spark, sf, "events"), "ts", limit_per_min=2)


@query("assign_batches")
def q_assign_batches(spark, sf):
    from enrichkit.operators.batching import assign_batches
    e = td.table(spark, sf, "events").select("event_id", "ts")
    return assign_batches(e, 500, [F.col("ts"), F.col("event_id")], label_prefix="batch-")


@query("batch_summary")
def q_batch_summary(spark, sf):
    from enrichkit.operators.batching import assign_batches
    from enrichkit.plans.opslog import batch_summary
    lk = _device_lookup(spark, sf)
    b = assign_batches(lk, 500, [F.col("reference_id")])
    outcome = (F.when(F.col("device_os").isNull(), F.lit("skipped"))
               .when(F.col("status").startswith("2"), F.lit("success")).otherwise(F.lit("error")))
    s = batch_summary(b.withColumn("outcome", outcome), "batch_no", "reference_id", with_keys=True)
    return s.withColumn("processed", F.array_join("processed", ","))


@query("next_batch")
def q_next_batch(spark, sf):
    from enrichkit.operators.batching import next_batch
    from enrichkit.operators.joins import exclude_processed
    ev = exclude_processed(td.device_events(spark, sf),
                           [(td.device_raw_done(spark, sf, "android"), {"reference_id": "reference_id"})])
    return next_batch(ev, ["reference_id"], 500)


@query("latest_n")
def q_latest_n(spark, sf):
    from enrichkit.operators.batching import latest_n
    return latest_n(td.table(spark, sf, "events").select("event_id", "ts", "event_type"), "ts", 10)


# ------------------------------------------------------------ sources / sinks
@query("sink_roundtrip")
def q_sink_roundtrip(spark, sf):
    from enrichkit.plans.enrich import split_outcomes, to_raw
    from enrichkit.session import scratch_path
    from enrichkit.sources.zones import land_json, read_landing, read_zone, write_zone
    ok, _ = split_outcomes(_device_lookup(spark, sf))
    raw = to_raw(ok, td.AS_OF, dt.datetime(2024, 1, 31), ["cuid", "reference_id", "device_os"])
    root = scratch_path(spark, "sinks")
    write_zone(raw, f"{root}/raw")                              # SNK-1
    land_json(raw, f"{root}/landing")                           # SNK-3
    back_raw = read_zone(spark, root, "raw")                    # SRC-1
    back_land = read_landing(spark, f"{root}/landing",          # SRC-4
                             "uuid string, cuid bigint, reference_id bigint, raw_data string, "
                             "bq_updated_time timestamp_ntz, landing_name string, "
                             "partition_date date, device_os string")
    cols = ["cuid", "reference_id", "device_os", "raw_data", "partition_date"]
    return (back_raw.select(F.lit("raw").alias("zone"), *cols)
            .unionByName(back_land.select(F.lit("landing").alias("zone"), *cols)))


@query("sql_job")
def q_sql_job(spark, sf):
    from enrichkit.sources.zones import run_sql_file
    return run_sql_file(spark, "device_failed_retry.sql", {"from_date": "2024-01-28"},
                        views={"device_dead_letter": td.device_dead_letter(spark, sf)})


@query("sql_flow_stats")
def q_sql_flow_stats(spark, sf):
    """SRC-3: a packaged job whose date parameter defaults to the run's."""
    from enrichkit.sources.zones import run_sql_file
    return run_sql_file(spark, "flow_statistics.sql", views={"flow_log": td.flow_log(spark, sf)},
                        as_of=dt.date(2024, 1, 15))


# Two invented rows.
INLINE_GEO_ROWS = [
    ("sample-1", "S-0001", "2024-02-01 08:30:00.5", "1 Harbour Street", "Flat 2, Mill Lane",
     None, "Example Foods", "106.70000000000001", "10.75", "2024-02-01"),
    ("sample-2", "S-0002", "2024-02-01 09:00:00", "22 Station Road", "Old Farm, Hill Village",
     "000111", "Example Coffee", "106.6789", "10.8000123", "2024-02-01"),
]


@query("inline_rows")
def q_inline_rows(spark, sf):
    from enrichkit.operators.joins import exclude_processed
    from enrichkit.sources.zones import inline_rows
    lit = inline_rows(spark, INLINE_GEO_ROWS,
                      "cuid string, serial_number string, created_at string, current_detailed_address string, "
                      "permanent_detailed_address string, tax_code string, company_name string, "
                      "longitude string, latitude string, partition_date string")
    lit = (lit.withColumn("created_at", F.to_timestamp_ntz("created_at"))
           .withColumn("partition_date", F.to_date("partition_date")))
    c = td.customers(spark, sf)
    a = td.applications(spark, sf)
    ay = td.apply_info(spark, sf)
    tab = (c.join(a, c["id"] == a["customer_id"]).join(ay, c["cuid"] == ay["cuid"])
           .select(c["cuid"].cast("string").alias("cuid"), a["serial_number"].cast("string").alias("serial_number"),
                   "created_at", "current_detailed_address", "permanent_detailed_address", "tax_code",
                   "company_name", "longitude", "latitude", a["partition_date"]))
    done = td.geo_raw_done(spark, sf).select(F.col("serial_number").cast("string").alias("serial_number"))
    return exclude_processed(lit.unionByName(tab), [(done, {"serial_number": "serial_number"})])


# ------------------------------------------------------------ streaming
def _stream_session(spark):
    """A session for the test streams: same SparkContext, own SQL conf. State
    partitions of a stream are fixed at its first start from
    spark.sql.shuffle.partitions; these inputs are small, so they get one per
    task slot. The caller's session is left as it is."""
    s = spark.newSession()
    s.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return s


@query("minute_metrics")
def q_minute_metrics(spark, sf):
    """SM-1 over files that arrive newest first: the days of the second half of
    the month, those of the first, and then a file with some events of each."""
    from enrichkit.session import scratch_path
    from enrichkit.streaming.pipeline import read_minute_counts, run_minute_counts
    ev = td.table(spark, sf, "events").select("event_id", "event_type", "ts")
    root = scratch_path(spark, "minute_metrics")
    late, early = F.col("event_id") % 10 == 7, F.dayofmonth("ts") < 16
    for part in (ev.filter(~late & ~early), ev.filter(~late & early), ev.filter(late)):
        part.write.mode("append").parquet(f"{root}/events")
    files = len(spark.read.schema(ev.schema).parquet(f"{root}/events").inputFiles())
    stream = (_stream_session(spark).readStream.schema(ev.schema).option("maxFilesPerTrigger", -(-files // 3))
              .parquet(f"{root}/events"))
    run_minute_counts(stream, f"{root}/minutes", f"{root}/checkpoint", "ts", F.col("event_type") == "purchase")
    return read_minute_counts(spark, f"{root}/minutes").drop("batches")


@query("message_stream")
def q_message_stream(spark, sf):
    """SRC-6, SM-3, SM-4, SNK-7 on a stream: envelopes are published to an
    outbox in two commits, read in micro-batches bounded by records, decoded and
    routed. The first consumer stops after two micro-batches; the second goes on
    behind it, with the second commit there."""
    from enrichkit.session import scratch_path
    from enrichkit.sources.outbox import append, consume, outbox_size
    from enrichkit.sources.zones import write_zone
    from enrichkit.streaming.messages import decode, route
    root = scratch_path(spark, "message_stream")
    sent = td.control_messages(spark, sf)
    append(sent.filter("message_id % 3 > 0"), f"{root}/outbox")
    step = outbox_size(f"{root}/outbox") // 3 + 1

    def work(batch, batch_id):
        write_zone(route(decode(batch)).withColumn("batch_id", F.lit(batch_id)).drop("msg", "data"), f"{root}/routed",
                   ["batch_id"], overwrite_partitions=True)

    consume(spark, f"{root}/outbox", work, f"{root}/state", step, max_batches=2)
    append(sent.filter("message_id % 3 = 0"), f"{root}/outbox")
    consume(spark, f"{root}/outbox", work, f"{root}/state", step)
    return spark.read.parquet(f"{root}/routed").select(
        "message_id", "message_type", "route", "batch_number", "start_date", "end_date", "valid", "subscription")


@query("stream_batches")
def q_stream_batches(spark, sf):
    """SM-2, SM-5, SNK-6: two runs on one checkpoint. The second run's files
    hold re-sent rows and events weeks older than those of the first; the very
    first RAW write fails and its batch is retried. Some rows have no reference:
    each is a dead letter of its own."""
    from pyspark.errors import StreamingQueryException

    from enrichkit.functions.scalars import is_failure
    from enrichkit.session import scratch_path
    from enrichkit.sources.zones import write_zone
    from enrichkit.streaming.pipeline import run_enrichment_stream
    ev = td.device_events(spark, sf)
    root = scratch_path(spark, "stream_batches")
    src, raw, dead, ck = f"{root}/input", f"{root}/raw", f"{root}/dead", f"{root}/checkpoint"
    payloads = td.device_payloads(spark, sf)
    cut = ntz(dt.datetime(2024, 1, 16))
    tries = []

    def flaky(df, path, parts, overwrite_partitions):
        if path == raw:
            tries.append(path)
            if len(tries) == 1:
                raise OSError("the RAW zone does not answer")
        write_zone(df, path, parts, overwrite_partitions=overwrite_partitions)

    lost = ev.filter(F.col("cuid") % 20 == 0).withColumn("reference_id", F.lit(None).cast("bigint"))
    runs = [[ev.filter(F.col("created_timestamp") >= cut).unionByName(lost)],
            [ev.filter(F.col("created_timestamp") < cut), ev.filter(F.col("device_os").isNull())]]
    ss = _stream_session(spark)
    for files in runs:
        for part in files:
            part.write.mode("append").parquet(src)
        for _ in range(2):
            stream = ss.readStream.schema(ev.schema).option("maxFilesPerTrigger", 4).parquet(src)
            try:
                run_enrichment_stream(stream, payloads, raw, dead, ck, "reference_id", dt.datetime(2024, 1, 31), flaky)
                break
            except StreamingQueryException:
                if len(tries) > 1:
                    raise
    text = lambda c: F.col(c).cast("bigint").alias(c)
    r = spark.read.parquet(raw).select(F.lit("raw").alias("zone"), text("reference_id"), text("cuid"), "device_os",
                                       "raw_data", F.lit(None).cast("string").alias("api_status"))
    d = spark.read.parquet(dead).filter(is_failure("api_status")).select(
        F.lit("dead_letter").alias("zone"), text("reference_id"), text("cuid"), "device_os",
        F.lit(None).cast("string").alias("raw_data"), "api_status")
    return r.unionByName(d)


@query("stream_record_batches")
def q_stream_record_batches(spark, sf):
    """SM-2, SM-5 by records: candidates arrive in a message log in one large and
    several small commits, some sent again, some without a reference; each
    micro-batch holds a quarter of them at most, and the key index is compacted
    on the way."""
    from enrichkit.functions.scalars import is_failure
    from enrichkit.session import scratch_path
    from enrichkit.sources.outbox import append, consume, outbox_size
    from enrichkit.streaming.pipeline import compact_key_index, enrichment_batch
    root = scratch_path(spark, "record_batches")
    raw, dead, log = f"{root}/raw", f"{root}/dead", f"{root}/candidates"
    ev = td.device_events(spark, sf)
    lost = ev.filter(F.col("cuid") % 20 == 0).withColumn("reference_id", F.lit(None).cast("bigint"))
    append(ev.filter("reference_id % 10 < 7"), log)
    for part in (ev.filter("reference_id % 10 = 7"), ev.filter("reference_id % 10 > 7"), lost, ev.filter("reference_id % 10 = 3")):
        append(part, log)
    step = outbox_size(log) // 4 + 1
    body = enrichment_batch(td.device_payloads(spark, sf), raw, dead, "reference_id", dt.datetime(2024, 1, 31), buckets=16)
    schema = "record long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ev.schema.fields)
    work = lambda batch, batch_id: body(batch.drop("record"), batch_id)
    consume(spark, log, work, f"{root}/state", step, schema, max_batches=2)
    compact_key_index(spark, raw)
    consume(spark, log, work, f"{root}/state", step, schema)
    text = lambda c: F.col(c).cast("bigint").alias(c)
    r = spark.read.parquet(raw).select(F.lit("raw").alias("zone"), text("reference_id"), text("cuid"), "device_os",
                                       "raw_data", F.lit(None).cast("string").alias("api_status"))
    d = spark.read.parquet(dead).filter(is_failure("api_status")).select(
        F.lit("dead_letter").alias("zone"), text("reference_id"), text("cuid"), "device_os",
        F.lit(None).cast("string").alias("raw_data"), "api_status")
    return r.unionByName(d)


@query("stream_flatten")
def q_stream_flatten(spark, sf):
    """SM-6: RAW arrives as files in two runs; a foreachBatch query flattens
    (iOS) what each micro-batch adds, skipping RAW references already
    flattened, whatever number their payload names. The whole input is sent
    once more at the end and must add nothing."""
    from enrichkit.plans.flatten import flatten_device
    from enrichkit.plans.mappings import IOS
    from enrichkit.session import scratch_path
    from enrichkit.streaming.pipeline import incremental_flatten_batch
    raw = td.device_raw(spark, sf, "IOS")
    root = scratch_path(spark, "stream_flatten")
    src, feats, ck = f"{root}/raw", f"{root}/features", f"{root}/checkpoint"
    cut = ntz(dt.datetime(1998, 1, 1))
    body = incremental_flatten_batch(lambda b, t: flatten_device(b, t, IOS, with_key=True), feats, "raw_reference_id")
    ss = _stream_session(spark)
    for part in [raw.filter(F.col("bq_updated_time") < cut), raw.filter(F.col("bq_updated_time") >= cut), raw]:
        part.write.mode("append").parquet(src)
        stream = ss.readStream.schema(raw.schema).parquet(src)
        q = (stream.writeStream.foreachBatch(body).option("checkpointLocation", ck)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.parquet(feats).drop("batch_id", "raw_reference_id")


@query("daily_candidates_android")
def q_daily_candidates_android(spark, sf):
    """PL-1 with the device-type restriction (FLT-8)."""
    from enrichkit.plans.candidates import daily_candidates
    return daily_candidates(td.device_events(spark, sf), td.customers(spark, sf),
                            td.applications(spark, sf),
                            [td.device_raw_done(spark, sf, "android"), td.device_raw_done(spark, sf, "ios")],
                            td.device_dead_letter(spark, sf), device_spec(device_type="android"))


def _geo_run(spark, sf):
    """A full geo run on fresh zones: dead letters from the table, RAW seeded
    with what landed (so reconcile has work and candidates are excluded)."""
    from enrichkit.plans.run import DEAD, RAW, GeoSources, run_geo
    from enrichkit.session import scratch_path
    from enrichkit.sources.zones import write_zone
    root = scratch_path(spark, "run_all")
    write_zone(td.geo_dead_letter(spark, sf), f"{root}/{DEAD}")
    write_zone(td.geo_raw_seed(spark, sf), f"{root}/{RAW}")
    src = GeoSources(td.customers(spark, sf), td.applications(spark, sf), td.apply_info(spark, sf),
                     td.pois(spark, sf), td.geo_failures_by_order(spark, sf))
    return root, run_geo(spark, src, root, geo_spec(batch_uuid="run-1"), dt.datetime(2024, 1, 31))


@query("run_all")
def q_run_all(spark, sf):
    """PL-11: the batch summary of one full geo run."""
    return _geo_run(spark, sf)[1]


@query("run_all_zones")
def q_run_all_zones(spark, sf):
    """PL-11: the records in every zone after one full geo run."""
    from enrichkit.plans.retry import latest_versions
    from enrichkit.plans.run import APILOG, DEAD, FEATURES, FLOWLOG, LANDING, OUTBOX, RAW
    from enrichkit.sources.zones import read_zone
    root, _ = _geo_run(spark, sf)
    none = F.lit(None).cast("string")
    key = lambda c: F.col(c).cast("string").alias("key")
    rows = [read_zone(spark, root, RAW).select(F.lit(RAW).alias("zone"), key("serial_number"),
                                               F.col("raw_data").alias("detail")),
            latest_versions(read_zone(spark, root, DEAD)).select(F.lit(DEAD).alias("zone"), key("series_number"),
                                                                 F.col("api_status").alias("detail")),
            read_zone(spark, root, FEATURES).select(F.lit(FEATURES).alias("zone"), key("serial_number"),
                                                    F.col("contract_poi_residential").alias("detail")),
            spark.read.schema("serial_number bigint").json(f"{root}/{LANDING}").select(
                F.lit(LANDING).alias("zone"), key("serial_number"), none.alias("detail")),
            read_zone(spark, root, APILOG).groupBy("status_code").agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(APILOG).alias("zone"), key("status_code"), F.col("n").cast("string").alias("detail")),
            read_zone(spark, root, FLOWLOG).select(F.lit(FLOWLOG).alias("zone"), key("task_name"),
                                                   F.col("status").alias("detail")),
            read_zone(spark, root, OUTBOX).select(F.lit(OUTBOX).alias("zone"), key("topic"),
                                                  F.col("message").alias("detail"))]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


@query("compact_zone")
def q_compact_zone(spark, sf):
    """PL-8: a dead-letter zone with appended versions, compacted after one
    reconcile and appended to by another one: its current rows."""
    from enrichkit.plans.run import DEAD, RAW, reconcile_zone
    from enrichkit.plans.versions import compact, current
    from enrichkit.session import scratch_path
    from enrichkit.sources.zones import write_zone
    root = scratch_path(spark, "compact_zone")
    write_zone(td.geo_dead_letter(spark, sf, whole=True), f"{root}/{DEAD}")
    write_zone(td.geo_raw_landed(spark, sf), f"{root}/{RAW}")
    compact(spark, f"{root}/{DEAD}")
    reconcile_zone(spark, root, dt.date(2024, 1, 15), dt.datetime(2024, 1, 31))
    compact(spark, f"{root}/{DEAD}")
    return current(spark, f"{root}/{DEAD}").select("uuid", "series_number", "api_status", "bq_updated_time", "partition_date")


@query("reconcile_zone")
def q_reconcile_zone(spark, sf):
    """PL-8 on a zone: the current version of the whole dead letter after the
    reconcile, every touched partition's old rows included."""
    from enrichkit.plans.retry import latest_versions
    from enrichkit.plans.run import DEAD, RAW, reconcile_zone
    from enrichkit.session import scratch_path
    from enrichkit.sources.zones import read_zone, write_zone
    root = scratch_path(spark, "reconcile_zone")
    write_zone(td.geo_dead_letter(spark, sf, whole=True), f"{root}/{DEAD}")
    write_zone(td.geo_raw_landed(spark, sf), f"{root}/{RAW}")
    reconcile_zone(spark, root, dt.date(2024, 1, 15), dt.datetime(2024, 1, 31))
    return latest_versions(read_zone(spark, root, DEAD)).select(
        "uuid", "series_number", "api_status", "bq_updated_time", "partition_date")


@query("run_device")
def q_run_device(spark, sf):
    """PL-10, PL-11: a full device run, run twice; the records in every zone
    (the second run adds nothing but its logs)."""
    from enrichkit.plans.run import (APILOG, DEVICE_DEAD, DEVICE_FEATURES, DEVICE_LANDING, DEVICE_RAW, FLOWLOG,
                                     OUTBOX, DeviceSources, run_device)
    from enrichkit.session import scratch_path
    from enrichkit.sources.zones import read_zone
    root = scratch_path(spark, "run_device")
    src = DeviceSources(td.device_events(spark, sf), td.customers(spark, sf), td.applications(spark, sf),
                        td.device_payloads(spark, sf))
    for name in ("run-1", "run-2"):
        run_device(spark, src, root, device_spec(batch_uuid=name), dt.datetime(2024, 1, 31))
    key = lambda c: F.col(c).cast("string").alias("key")
    none = F.lit(None).cast("string").alias("detail")
    raw = read_zone(spark, root, DEVICE_RAW)
    rows = [raw.select(F.concat(F.lit("raw_"), "route").alias("zone"), key("reference_id"), F.col("raw_data").alias("detail")),
            read_zone(spark, root, DEVICE_DEAD).select(F.lit(DEVICE_DEAD).alias("zone"), key("reference_id"),
                                                       F.col("api_status").alias("detail")),
            spark.read.schema("reference_id bigint").json(f"{root}/{DEVICE_LANDING}").select(
                F.lit(DEVICE_LANDING).alias("zone"), key("reference_id"), none),
            read_zone(spark, root, APILOG).groupBy("status_code", "severity").agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(APILOG).alias("zone"), F.concat_ws("/", "status_code", "severity").alias("key"),
                F.col("n").cast("string").alias("detail")),
            read_zone(spark, root, FLOWLOG).groupBy("task_name", "status").agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(FLOWLOG).alias("zone"), F.concat_ws("/", "task_name", "status").alias("key"),
                F.col("n").cast("string").alias("detail")),
            read_zone(spark, root, OUTBOX).select(F.lit(OUTBOX).alias("zone"), key("topic"), F.col("message").alias("detail"))]
    rows += [read_zone(spark, root, zone).select(F.lit(zone).alias("zone"), key("raw_reference_id"), none)
             for zone in DEVICE_FEATURES.values()]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


@query("call_plan")
def q_call_plan(spark, sf):
    """UD-1, FN-18, AG-11: every try of every device lookup under a limit of 30
    calls a minute, three tries; some records have no reference."""
    from enrichkit.plans.calls import run_calls
    ev = td.device_events(spark, sf).select("cuid", "reference_id", "created_timestamp")
    lost = ev.filter("cuid % 20 = 0").withColumn("reference_id", F.lit(None).cast("bigint"))
    tries = run_calls(ev.unionByName(lost), td.flaky_lookup(spark, sf), "reference_id",
                      ["created_timestamp", "reference_id"], per_minute=30)
    return tries.select("cuid", "reference_id", "try", "minute", "status", "payload", "error", "final")


@query("call_minutes")
def q_call_minutes(spark, sf):
    """AG-11 on the plan: calls and failures a minute; none is above the limit."""
    tries = QUERIES["call_plan"](spark, sf).filter("minute is not null")
    return tries.groupBy("minute").agg(F.count(F.lit(1)).alias("calls"), F.count_if(F.col("status") == "503").alias("failed"))


@query("api_log")
def q_api_log(spark, sf):
    """SNK-8: API-log rows of the device lookups, skipped ones included."""
    from enrichkit.sources.zones import api_log_rows
    e = td.table(spark, sf, "events").select(F.col("event_id").alias("reference_id"), F.col("ts").alias("t0"))
    lk = _device_lookup(spark, sf).join(e, "reference_id")
    lk = lk.withColumn("status", F.when(F.col("device_os").isNotNull(), F.col("status")))
    return api_log_rows(lk, "device", "insights", "reference_id", F.col("t0"), F.col("t0") + F.expr("INTERVAL 1500 MILLISECOND"))
