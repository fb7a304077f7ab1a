"""Shapes the driver's star-schema tables into the reference's table shapes.

The reference's own tables are not available, so each of its tables is
§2.12). Every frame is derived row by row from a full table (no id subsets),
so its size grows with the data. "Already done" sets are chosen by data
predicates, not by key ranges.

Mapping:
- device events (candidates)  <- events   (reference_id = event_id, cuid = user_id)
- CUSTOMER                    <- customer (id = cuid = c_custkey)
- APPLICATION                 <- orders   (serial_number = o_orderkey; created_at
                                            moved into 2024 so that day joins meet)
- APPLY_INFO                  <- customer (string coordinates, some 'null')
- device dead letter          <- events, 1..3 attempts per event
- device RAW (done)           <- events with low value (click -> Android, view -> iOS)
- geo RAW / geo dead letter   <- orders (serial_number) by price / priority
- POIs                        <- supplier (string coordinates, type by key)
- device payloads (RAW JSON)  <- orders (built with to_json, row by row)
- API log                     <- lineitem; flow log <- events
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from enrichkit.spec import ntz

AS_OF = dt.date(2024, 1, 31)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, as Spark splits it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Narrow rows dealt to all tasks before each becomes a payload many times its
    size: a file of few row groups is read by few tasks, whatever is made of it."""
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


# ---------------------------------------------------------------- device side

def device_os_of(event_type):
    return (F.when(event_type == "click", F.lit("Android"))
            .when(event_type == "purchase", F.lit("android"))
            .when(event_type == "view", F.lit("IOS"))
            .when(event_type == "signup", F.lit("windows"))
            .otherwise(F.lit(None).cast("string")))


def device_events(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("cuid"), F.col("event_id").alias("reference_id"),
                    device_os_of(F.col("event_type")).alias("device_os"),
                    F.col("ts").alias("created_timestamp"),
                    F.to_date("ts").alias("partition_date"))


def customers(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("cuid"),
                    F.col("c_name").alias("current_detailed_address"),
                    F.col("c_mktsegment").alias("permanent_detailed_address"),
                    F.lit(dt.date(2024, 1, 1)).alias("partition_date"))


def applications(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    created = F.make_timestamp_ntz(F.lit(2024), F.month("o_orderdate"), F.dayofmonth("o_orderdate"),
                                   F.lit(0), F.lit(0), F.lit(0))
    status = (F.when(F.col("o_orderstatus") == "O", F.lit("ACTIVE"))
              .when(F.col("o_orderstatus") == "F", F.lit("CLOSED"))
              .otherwise(F.lit("PENDING")))
    return o.select(F.col("o_custkey").alias("customer_id"),
                    F.col("o_orderkey").alias("serial_number"),
                    created.alias("created_at"), status.alias("status"),
                    F.to_date("o_orderdate").alias("partition_date"),
                    F.col("o_orderdate").alias("bq_updated_time"))


def coord_text_of(key, base: str, start: int, modulus: int):
    """'10.7xx' style coordinate text built from a key (exact decimal text)."""
    return F.concat(F.lit(base + "."), F.lpad((F.lit(start) + key % modulus).cast("string"), 3, "0"))


def apply_info(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    lat = coord_text_of(k, "10", 700, 100)
    lon = coord_text_of(k, "106", 600, 97)
    seg = F.col("c_mktsegment")
    return c.select(k.alias("cuid"), F.col("c_nationkey").cast("string").alias("tax_code"),
                    F.col("c_name").alias("company_name"),
                    F.when(seg == "BUILDING", F.lit("null")).otherwise(lon).alias("longitude"),
                    F.when(seg == "AUTOMOBILE", F.lit("null")).otherwise(lat).alias("latitude"))


def device_dead_letter(spark, sf_dir) -> DataFrame:
    """1..3 lookup attempts per event, one hour apart; earlier attempts failed
    with 503, the last one carries the status of the event's type."""
    e = table(spark, sf_dir, "events")
    n = (F.lit(1) + F.least(F.lit(2), F.floor(F.col("value") / 20))).cast("int")
    final = (F.when(F.col("event_type") == "purchase", F.lit("200"))
             .when(F.col("event_type") == "signup", F.lit("success"))
             .when(F.col("event_type") == "click", F.lit("404"))
             .when(F.col("event_type") == "view", F.lit("503"))
             .otherwise(F.lit("failed")))
    a = e.select("*", F.explode(F.sequence(F.lit(1), n)).alias("attempt"), n.alias("n_attempts"))
    upd = F.col("ts") + F.make_dt_interval(F.lit(0), F.col("attempt"))
    return a.select(F.concat_ws("-", F.col("event_id").cast("string"), F.col("attempt").cast("string")).alias("uuid"),
                    F.col("user_id").alias("cuid"), F.col("event_id").alias("reference_id"),
                    F.col("event_id").alias("series_number"),
                    device_os_of(F.col("event_type")).alias("device_os"),
                    F.to_json(F.struct(F.col("event_id").alias("reference_id"),
                                       F.col("attempt"))).alias("api_payload_message"),
                    F.when(F.col("attempt") == F.col("n_attempts"), final)
                    .otherwise(F.lit("503")).alias("api_status"),
                    upd.alias("bq_updated_time"), F.to_date(upd).alias("partition_date"))


def device_raw_done(spark, sf_dir, os_name: str) -> DataFrame:
    """Reference ids already in the Android (click) or iOS (view) RAW table."""
    e = table(spark, sf_dir, "events")
    et = "click" if os_name.lower() == "android" else "view"
    return e.filter((F.col("event_type") == et) & (F.col("value") < 10)).select(
        F.col("event_id").alias("reference_id"))


# ---------------------------------------------------------------- geo side

def geo_raw_done(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.filter(F.col("o_totalprice") < 50000).select(F.col("o_orderkey").alias("serial_number"))


def geo_dead_letter(spark, sf_dir, whole: bool = False) -> DataFrame:
    """Geo failed-retry list, written on the order's day moved into 2024 (so
    D-20 .. D-1 windows select some): the orders of low priority, as candidates
    need some serials outside it, or with ``whole`` all orders."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    day = F.make_date(F.lit(2024), F.lit(1), F.least(F.dayofmonth("o_orderdate"), F.lit(31)))
    status = (F.when(F.col("o_orderstatus") == "F", F.lit("200"))
              .when(F.col("o_orderstatus") == "O", F.lit("500"))
              .otherwise(F.lit("429")))
    lo = o if whole else o.filter(F.col("o_orderpriority") == "5-LOW")
    j = lo.join(c, lo["o_custkey"] == c["c_custkey"], "left")
    return j.select(F.col("o_orderkey").cast("string").alias("uuid"),
                    F.col("o_custkey").alias("cuid"), F.col("o_orderkey").alias("series_number"),
                    F.col("c_name").alias("contact_address"),
                    F.col("c_mktsegment").alias("residence_address"),
                    F.col("c_nationkey").cast("string").alias("tax_code"),
                    F.col("c_name").alias("company_name"),
                    coord_text_of(F.col("o_custkey"), "106", 600, 97).alias("contract_longitude"),
                    coord_text_of(F.col("o_custkey"), "10", 700, 100).alias("contract_latitude"),
                    F.lit(None).cast("string").alias("api_payload_message"),
                    status.alias("api_status"),
                    F.lit(None).cast("int").alias("retry_count"),
                    F.lit(None).cast("timestamp_ntz").alias("last_retry_time"),
                    F.col("o_orderdate").alias("bq_updated_time"),
                    day.alias("partition_date"))


def pois(spark, sf_dir) -> DataFrame:
    """Places: suppliers at synthetic coordinates; one type list per key."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    kind = k % 3
    types = (F.when(kind == 0, F.array(F.lit("bank"), F.lit("atm")))
             .when(kind == 1, F.array(F.lit("restaurant"), F.lit("store")))
             .otherwise(F.array(F.lit("apartment_building"))))
    return s.select(k.alias("place_id"),
                    coord_text_of(k, "10", 700, 100).cast("double").alias("lat"),
                    coord_text_of(k, "106", 600, 97).cast("double").alias("lon"),
                    types.alias("types"), (F.col("s_acctbal") >= 0).alias("operational"))


# ---------------------------------------------------------------- payloads

def device_raw(spark, sf_dir, device_os: str = "Android") -> DataFrame:
    """Device RAW rows with a JSON payload built from each order.

    One row per order, plus a second, newer version for orders in status F
    (so latest-per-key has work). Payload sections (positions in order):
    deviceInfo, ipInfo, velocity, deviceInfo (second copy, date shifted by
    priority), typing, expertScore, lastApps (1..5 apps by priority digit).
    Status P has no "insights" key; priority 5-LOW has "insights": [].
    Orders of priority 2-HIGH carry an object where deviceModel is expected.
    """
    o = spread(table(spark, sf_dir, "orders"))
    pr = F.substring("o_orderpriority", 1, 1).cast("int")
    d0 = F.to_date("o_orderdate")
    d1 = F.date_add(d0, pr - 3)
    k = F.col("o_orderkey")

    def ins(code, value_json, cdate):
        return F.concat(F.lit('{"code":"' + code + '","calculatedDate":"'), cdate.cast("string"),
                        F.lit('","value":'), value_json, F.lit("}"))

    # deviceModel is a plain string, except for 2-HIGH orders where it is a
    # JSON object (a scalar lookup on it must give NULL)
    model = F.when(pr == 2, F.lit('{"name":"x"}')).otherwise(
        F.concat(F.lit('"'), F.col("o_orderstatus"), F.lit('"')))
    device_a = F.concat(F.regexp_replace(F.to_json(F.struct(
        F.concat(F.lit("dev-"), k.cast("string")).alias("deviceId"),
        F.col("o_orderpriority").alias("deviceBrand"),
        (F.col("o_totalprice") > 200000).alias("deviceIsRooted"),
        F.col("o_custkey").alias("deviceRamTotalSize"))), r"\}$", ""),
        F.lit(',"deviceModel":'), model, F.lit("}"))
    device_b = F.to_json(F.struct(
        F.concat(F.lit("dev2-"), k.cast("string")).alias("deviceId"),
        F.lit("second").alias("deviceBrand")))
    ip = F.to_json(F.struct(F.concat(F.lit("10.0.0."), (k % 250).cast("string")).alias("ip"),
                            F.lit("VN").alias("country"),
                            (F.col("o_orderstatus") == "O").alias("privacyVpn")))
    velocity = F.when(F.col("o_orderstatus") == "O",
                      F.to_json(F.struct(F.col("o_custkey").alias("datasetsCountAllFromIp"))))\
        .otherwise(F.to_json(F.struct(F.col("o_custkey").alias("datasetsCountFromIpLastYear"))))
    typing = F.to_json(F.struct(pr.alias("textInputSpeed")))
    expert = F.to_json(F.struct(F.floor(F.col("o_totalprice") / 1000).cast("bigint").alias("score")))
    apps = F.to_json(F.transform(F.sequence(F.lit(1), pr), lambda i: F.struct(
        F.concat(F.lit("app."), k.cast("string"), F.lit("."), i.cast("string")).alias("appPackageName"),
        (i % 2 == 0).alias("appPaid"),
        i.alias("appDateInstalledRankDesc"))))

    insights = F.concat_ws(",", ins("deviceInfo", device_a, d0), ins("ipInfo", ip, d0),
                           ins("velocity", velocity, d0), ins("deviceInfo", device_b, d1),
                           ins("typing", typing, d0), ins("expertScore", expert, d0),
                           ins("lastApps", apps, d0))
    # version 2 exists for orders in status F: newer partition and requester
    v2 = F.col("_version") == 2
    requester = F.when(v2, F.lit("app-v2")).otherwise(F.lit("app"))
    # some payloads name another record, some none
    number = (F.when(k % 50 == 0, F.lit("")).when(k % 50 == 1, F.concat(F.lit('"referenceNumber":"X'), k.cast("string"), F.lit('",')))
              .otherwise(F.concat(F.lit('"referenceNumber":"'), k.cast("string"), F.lit('",'))))
    head = F.concat(F.lit("{"), number, F.lit('"requester":"'), requester,
                    F.lit('","requestedDate":"'), d0.cast("string"), F.lit('"'))
    body = (F.when(F.col("o_orderstatus") == "P", F.concat(head, F.lit("}")))
            .when(pr == 5, F.concat(head, F.lit(',"insights":[]}')))
            .otherwise(F.concat(head, F.lit(',"insights":['), insights, F.lit("]}"))))
    versions = F.when(F.col("o_orderstatus") == "F", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    ov = o.select("*", F.explode(versions).alias("_version"))
    return ov.select(F.concat(F.lit("u-"), k.cast("string"), F.when(v2, F.lit("-v2")).otherwise(F.lit("")))
                     .alias("uuid"),
                     F.col("o_custkey").cast("string").alias("cuid"),
                     k.cast("string").alias("reference_id"),
                     F.concat(F.lit("S"), k.cast("string")).alias("series_number"),
                     F.lit(device_os).alias("device_os"), body.alias("raw_data"),
                     F.col("o_orderdate").alias("bq_updated_time"),
                     F.when(v2, F.lit(dt.date(2024, 1, 25))).otherwise(F.lit(dt.date(2024, 1, 20)))
                     .alias("partition_date"))


def flattened_target(spark, sf_dir) -> DataFrame:
    """Feature rows already flattened: orders dated before 1996."""
    o = table(spark, sf_dir, "orders")
    return o.filter(F.col("o_orderdate") < ntz(dt.datetime(1996, 1, 1))).select(
        F.col("o_orderkey").cast("string").alias("reference_number"))


def geo_raw(spark, sf_dir) -> DataFrame:
    """Geo RAW rows from customers: coordinates text with 'null', '', junk."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    bal = F.col("c_acctbal")
    lon = (F.when(seg == "BUILDING", F.lit("null")).when(seg == "AUTOMOBILE", F.lit(""))
           .when(seg == "HOUSEHOLD", F.lit("abc"))
           .otherwise(F.concat(F.lit("106."), F.lpad(k.cast("string"), 7, "0"), F.lit("1"))))
    lat = F.format_string("%.2f", bal)
    counts = F.to_json(F.struct(F.struct(
        (k % 7).cast("string").alias("corporate_finance"),
        F.when(bal < 0, F.lit("null")).otherwise((k % 5).cast("string")).alias("residential"),
        (k % 11).cast("string").alias("commercial")).alias("scenario_counts")))
    return c.select(F.concat(F.lit("g-"), k.cast("string")).alias("uuid"), k.alias("cuid"),
                    k.alias("serial_number"),
                    F.when(seg == "FURNITURE", F.lit("   ")).otherwise(F.col("c_name")).alias("contact_address"),
                    F.col("c_mktsegment").alias("residence_address"),
                    F.col("c_name").alias("company_name"),
                    lon.alias("contract_longitude"), lat.alias("contract_latitude"),
                    counts.alias("raw_data"),
                    ntz(dt.datetime(2024, 1, 30, 12, 0)).alias("bq_updated_time"),
                    F.lit(dt.date(2024, 1, 30)).alias("partition_date"))


def geo_target(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.filter(F.col("c_nationkey") < 3).select(F.col("c_custkey").alias("serial_number"))


def api_log(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    return j.select(F.concat_ws("-", F.col("l_orderkey").cast("string"),
                                F.col("l_linenumber").cast("string")).alias("uuid_request"),
                    F.col("l_returnflag").alias("api_type"),
                    F.concat(F.lit("insights-"), F.col("l_returnflag")).alias("api_name"),
                    F.col("o_orderdate").alias("start_time"), F.col("l_shipdate").alias("end_time"),
                    F.when(F.col("l_linestatus") == "F", F.lit("200")).otherwise(F.lit("503")).alias("status_code"),
                    F.col("l_linestatus").alias("status_detail"),
                    (F.col("l_linenumber") - 1).alias("retry"))


def flow_log(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    status = F.when(F.col("event_type") == "error", F.lit("FAILED")).otherwise(F.lit("SUCCESS"))
    return e.select(F.concat(F.lit("flow_"), F.col("user_id").cast("string")).alias("flow_id"),
                    F.col("ts").alias("datetime"),
                    F.concat(F.lit("flow_"), F.col("event_type")).alias("flow_name"),
                    F.col("event_type").alias("task_code"), F.col("event_type").alias("task_name"),
                    status.alias("status"), F.col("props").alias("message"),
                    F.when(status == "FAILED", F.lit("ERROR")).otherwise(F.lit("Info")).alias("severity"))


def _shared_serial(cuid):
    """Two customers share one serial, so a record is (cuid, serial)."""
    return cuid - cuid % 2


def geo_points(spark, sf_dir) -> DataFrame:
    """Geo lookup records: every customer with its apply-info coordinates."""
    c = customers(spark, sf_dir)
    a = apply_info(spark, sf_dir)
    return c.join(a, "cuid").select("cuid", _shared_serial(F.col("cuid")).alias("serial_number"),
                                    "current_detailed_address", "permanent_detailed_address",
                                    "tax_code", "company_name", "longitude", "latitude")


def geo_failures(spark, sf_dir) -> DataFrame:
    """Lookup errors the service hook reports: the 'commercial' lookup fails
    with 503 for customers with a negative balance."""
    c = table(spark, sf_dir, "customer")
    return c.filter(F.col("c_acctbal") < 0).select(
        F.col("c_custkey").alias("cuid"), _shared_serial(F.col("c_custkey")).alias("serial_number"),
        F.lit("commercial").alias("scenario"), F.lit("503").alias("status"))


def geo_raw_landed(spark, sf_dir) -> DataFrame:
    """Serials that reached geo RAW, by day (open orders, dated into 2024-01)."""
    o = table(spark, sf_dir, "orders")
    return o.filter(F.col("o_orderstatus") == "O").select(
        F.col("o_orderkey").alias("serial_number"),
        F.make_date(F.lit(2024), F.lit(1), F.least(F.dayofmonth("o_orderdate"), F.lit(31))).alias("partition_date"))


def device_payloads(spark, sf_dir) -> DataFrame:
    """Lookup payloads: events with value >= 5 have one; the rest get 404."""
    e = table(spark, sf_dir, "events")
    return e.filter(F.col("value") >= 5).select(
        F.col("event_id").alias("key"),
        F.concat(F.lit('{"referenceNumber":"'), F.col("event_id").cast("string"),
                 F.lit('","props":'), F.col("props"), F.lit("}")).alias("payload"))


def control_messages(spark, sf_dir) -> DataFrame:
    """Base64 envelopes built from events: purchase -> daily_recall, click ->
    range_recall (dates of the event's day in processing_params), signup ->
    range_recall with the dates only at the top level and no end date, view ->
    unknown type, error -> a body that is not JSON."""
    e = table(spark, sf_dir, "events")
    day = F.to_date("ts").cast("string")
    bn = (F.col("user_id") % 9 + 1).cast("string")
    body = (F.when(F.col("event_type") == "purchase",
                   F.concat(F.lit('{"message_type":"daily_recall","processing_params":{"batch_number":'),
                            bn, F.lit(',"source":"daily_job"}}')))
            .when(F.col("event_type") == "click",
                  F.concat(F.lit('{"message_type":"range_recall","processing_params":{"start_date":"'), day,
                           F.lit('","end_date":"'), day, F.lit('","batch_number":'), bn,
                           F.lit(',"source":"get_data_range"}}')))
            .when(F.col("event_type") == "signup",
                  F.concat(F.lit('{"message_type":"range_recall","start_date":"'), day,
                           F.lit('","processing_params":{"batch_number":'), bn, F.lit("}}")))
            .when(F.col("event_type") == "view", F.lit('{"message_type":"reindex"}'))
            .otherwise(F.concat(F.lit("not json "), F.col("event_id").cast("string"))))
    # a third of the bad bodies are not base64 either
    data = F.when((F.col("event_type") == "error") & (F.col("event_id") % 3 == 0), F.lit("not base64!")) \
        .otherwise(F.base64(body))
    attrs = F.when(F.col("event_type") == "click",
                   F.create_map(F.lit("start_date"), day, F.lit("end_date"), day)) \
        .otherwise(F.create_map(F.lit("start_date"), F.lit(""), F.lit("end_date"), F.lit("")))
    return e.select(F.col("event_id").alias("message_id"), data.alias("data"),
                    attrs.alias("attributes"))


def lookup_responses(spark, sf_dir) -> DataFrame:
    """Area-count responses in the shapes the service returns, from events."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    resp = (F.when(F.col("event_type") == "click", F.concat(F.lit('{"count":"'), k, F.lit('"}')))
            .when(F.col("event_type") == "view",
                  F.concat(F.lit('{"insights":[{"name":"INSIGHT_COUNT","value":'), k, F.lit("}]}")))
            .when(F.col("event_type") == "purchase", F.lit("{}"))
            .when(F.col("event_type") == "signup", F.lit('{"count":"x"}'))
            .otherwise(F.concat(F.lit('{"insights":[{"name":"other","value":3},{"name":"count","count":"'),
                                k, F.lit('"}]}'))))
    return e.select("event_id", resp.alias("response"))


def date_texts(spark, sf_dir) -> DataFrame:
    """Date strings in good and bad shapes, from event days."""
    e = table(spark, sf_dir, "events")
    d = F.to_date("ts").cast("string")
    txt = (F.when(F.col("event_type") == "click", d)
           .when(F.col("event_type") == "view", F.regexp_replace(d, "-", "/"))
           .when(F.col("event_type") == "signup",
                 F.concat(F.lit("2024-02-"), F.lpad(F.dayofmonth("ts").cast("string"), 2, "0")))
           .when(F.col("event_type") == "purchase", F.concat(d, F.lit("x")))
           .otherwise(F.concat(F.lit("2023-"), F.lpad(F.dayofmonth("ts").cast("string"), 2, "0"), F.lit("-01"))))
    return e.select("event_id", txt.alias("date_text"))


def geo_failures_by_order(spark, sf_dir) -> DataFrame:
    """Lookup errors keyed by application serial: the 'commercial' lookup
    fails with 503 for orders of customers with a negative balance."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") < 0).select("c_custkey")
    return o.join(c, o["o_custkey"] == c["c_custkey"], "left_semi").select(
        F.col("o_custkey").alias("cuid"), F.col("o_orderkey").alias("serial_number"),
        F.lit("commercial").alias("scenario"),
        F.lit("503").alias("status"))


def geo_raw_seed(spark, sf_dir) -> DataFrame:
    """RAW rows that earlier runs wrote: orders under 50000, dated into 2024-01."""
    o = table(spark, sf_dir, "orders").filter(F.col("o_totalprice") < 50000)
    none = F.lit(None).cast("string")
    return o.select(F.concat(F.lit("seed-"), F.col("o_orderkey").cast("string")).alias("uuid"),
                    F.col("o_custkey").alias("cuid"), F.col("o_orderkey").alias("serial_number"),
                    none.alias("contact_address"), none.alias("residence_address"), none.alias("company_name"),
                    none.alias("contract_longitude"), none.alias("contract_latitude"),
                    F.lit('{"scenario_counts":{"residential":"1"}}').alias("raw_data"),
                    F.col("o_orderdate").alias("bq_updated_time"),
                    F.make_date(F.lit(2024), F.lit(1), F.least(F.dayofmonth("o_orderdate"), F.lit(31)))
                    .alias("partition_date"))


def flaky_lookup(spark, sf_dir):
    """UD-1 with a service that fails at times: events with an id divisible by
    7 answer '503' on the first try, by 77 on the second too, by 13 on every one;
    the others as the payload table has it. Gives a ``resolve`` for planned calls."""
    from enrichkit.plans.enrich import lookup_join
    payloads = device_payloads(spark, sf_dir)

    def resolve(planned):
        k = F.col("reference_id")
        down = (k % 13 == 0) | ((k % 7 == 0) & (F.col("try") == 1)) | ((k % 77 == 0) & (F.col("try") == 2))
        found = lookup_join(planned, payloads, "reference_id").drop("retry")
        down = F.coalesce(down, F.lit(False))
        return (found.withColumn("status", F.when(down, F.lit("503")).otherwise(F.col("status")))
                .withColumn("payload", F.when(~down, F.col("payload")))
                .withColumn("error", F.when(down, F.lit("unavailable")).otherwise(F.col("error"))))

    return resolve


def full_value(place: int, key: str) -> str:
    """JSON text of a section's field by its place: text, number or truth; ``@`` stands
    for the record's number."""
    return (f'"{key} @"', "@", "true")[place % 3]


def full_payload(sections, ios: bool, second: bool) -> str:
    """JSON text of a payload that fills every field of every section. Of fields
    with alternative names the first is there, or with ``second`` the last alone.
    A section that fans out holds two elements."""
    parts = []
    for code, keys, many in sections:
        fields = lambda extra: "{" + ",".join(
            f'"{alts[-1] if second else alts[0]}":{full_value(i, alts[0] + extra)}' for i, alts in enumerate(keys)) + "}"
        value = f"[{fields(' 1')},{fields(' 2')}]" if many else fields("")
        parts.append(f'{{"code":"{code}","calculatedDate":"2024-01-01","value":{value}}}')
    return ('{"referenceNumber":"#","requestedDate":"2024-01-02","requester":"full","insights":['
            + ",".join(parts if not ios else reversed(parts)) + "]}")


def payload_sections(mapping) -> list[tuple[str, list[tuple[str, ...]], bool]]:
    return [(s.code, [k if isinstance(k, tuple) else (k,) for k in s.keys], s.fan_out) for s in mapping.sections]


def full_device_raw(spark, sf_dir, mapping, device_os: str) -> DataFrame:
    """Device RAW rows, one an order, whose payloads fill every mapped field."""
    o = spread(table(spark, sf_dir, "orders"))
    k = F.col("o_orderkey")
    sections = payload_sections(mapping)
    ios = device_os == "IOS"

    def filled(text: str):
        """``text`` with the row's numbers, joined from its parts between them."""
        parts = [F.array(*[F.lit(p) for p in part.split("@")]) for part in text.split("#")]
        return reduce(lambda a, b: F.concat(a, k.cast("string"), b), [F.call_function("array_join", p, (k % 97).cast("string")) for p in parts])

    text = F.when(k % 2 == 0, filled(full_payload(sections, ios, False))).otherwise(filled(full_payload(sections, ios, True)))
    return o.select(F.concat(F.lit("u-"), k.cast("string")).alias("uuid"), F.col("o_custkey").cast("string").alias("cuid"),
                    k.cast("string").alias("reference_id"), F.concat(F.lit("S"), k.cast("string")).alias("series_number"),
                    F.lit(device_os).alias("device_os"), text.alias("raw_data"), F.col("o_orderdate").alias("bq_updated_time"),
                    F.lit(dt.date(2024, 1, 20)).alias("partition_date"))
