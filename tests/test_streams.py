"""Streams: message routing on readStream, replays on one checkpoint."""
import base64
import datetime as dt
import json

from pyspark.sql import functions as F

from enrichkit.session import scratch_path
from enrichkit.streaming.messages import decode, next_batch_message, route
from enrichkit.streaming.pipeline import run_enrichment_stream, run_to_parquet

EV = "cuid bigint, reference_id bigint, device_os string, created_timestamp timestamp_ntz, partition_date date"


def test_message_routing_on_a_stream(spark):
    root = scratch_path(spark, "msg_stream")
    body = {"message_type": "range_recall", "processing_params": {"start_date": "2025-01-15",
                                                                  "end_date": "2025-01-16", "batch_number": 3}}
    rows = [(base64.b64encode(json.dumps(body).encode()).decode(), {"start_date": "2025-01-15"}),
            (base64.b64encode(b"junk").decode(), {"start_date": ""})]
    spark.createDataFrame(rows, "data string, attributes map<string,string>").write.parquet(f"{root}/in")
    stream = spark.readStream.schema("data string, attributes map<string,string>").parquet(f"{root}/in")
    out = route(decode(stream)).select("route", "valid", "start_date", "end_date", "subscription")
    run_to_parquet(out, f"{root}/out", f"{root}/ck")
    got = sorted(tuple(r) for r in spark.read.parquet(f"{root}/out").collect())
    assert got == [("quarantine", False, None, None, "daily"),
                   ("range", True, "2025-01-15", "2025-01-16", "range")]


def test_next_batch_message():
    m = next_batch_message(2, dt.date(2025, 1, 15), dt.date(2025, 1, 15), "get_data_range", "t")
    body = json.loads(m["message"])
    assert body["message_type"] == "range_recall" and body["processing_params"]["batch_number"] == 3
    assert m["attributes"]["start_date"] == "2025-01-15"
    assert json.loads(next_batch_message(1, None, None, "daily_job", "t")["message"])["message_type"] == "daily_recall"


def test_enrichment_stream_replay_is_idempotent(spark):
    root = scratch_path(spark, "replay")
    src, raw, dead, ck = f"{root}/in", f"{root}/raw", f"{root}/dead", f"{root}/ck"
    ts = dt.datetime(2024, 1, 5)
    ev = spark.createDataFrame([(1, i, "Android", ts + dt.timedelta(minutes=i), dt.date(2024, 1, 5))
                                for i in range(20)], EV)
    payloads = spark.createDataFrame([(i, f'{{"id":{i}}}') for i in range(0, 20, 2)], "key bigint, payload string")
    ev.write.parquet(src)
    for _ in range(2):                                   # second run: nothing new, nothing repeated
        stream = spark.readStream.schema(ev.schema).parquet(src)
        run_enrichment_stream(stream, payloads, raw, dead, ck, "reference_id", dt.datetime(2024, 1, 31))
    ev.filter(F.col("reference_id") < 5).write.mode("append").parquet(src)   # re-delivered rows
    stream = spark.readStream.schema(ev.schema).parquet(src)
    run_enrichment_stream(stream, payloads, raw, dead, ck, "reference_id", dt.datetime(2024, 1, 31))
    late = spark.createDataFrame([(1, 100, "Android", ts - dt.timedelta(days=20), dt.date(2023, 12, 16))], EV)
    late.write.mode("append").parquet(src)               # weeks older than anything before
    stream = spark.readStream.schema(ev.schema).parquet(src)
    run_enrichment_stream(stream, payloads, raw, dead, ck, "reference_id", dt.datetime(2024, 1, 31))
    rows = spark.read.parquet(raw)
    r = [row.reference_id for row in rows.collect()]
    d = [int(row.reference_id) for row in spark.read.parquet(dead).collect()]
    assert sorted(r) == list(range(0, 20, 2)) and sorted(d) == [*range(1, 20, 2), 100]
    from enrichkit.plans.flatten import flatten_device
    from enrichkit.plans.mappings import IOS
    features = rows.withColumn("series_number", F.lit(None).cast("string"))
    assert flatten_device(features, None, IOS).count() == len(r)      # stream RAW has the columns of RAW


def test_raw_write_failure_sends_batch_to_dead_letter(spark):
    """SNK-6: a failing RAW write puts every row of the batch into the dead
    letter with status 'INSERT RAW TABLE FAILED' and re-raises."""
    import pytest
    from enrichkit.streaming.pipeline import enrichment_batch
    root = scratch_path(spark, "snk6")
    import glob
    blocker = f"{root}/raw"
    spark.createDataFrame([("x",)], "a string").write.text(blocker)
    first = sorted(glob.glob(blocker.replace("file:", "") + "/part-*"))[0]
    bad_raw = first + "/raw"                         # a folder below a file cannot be created
    ev = spark.createDataFrame([(1, i, "Android", dt.datetime(2024, 1, 5), dt.date(2024, 1, 5)) for i in range(4)], EV)
    payloads = spark.createDataFrame([(i, "{}") for i in range(4)], "key bigint, payload string")
    body = enrichment_batch(payloads, bad_raw, f"{root}/dead", "reference_id", dt.datetime(2024, 1, 31))
    with pytest.raises(Exception):
        body(ev, 0)
    dead = spark.read.parquet(f"{root}/dead").collect()
    assert sorted(int(r.reference_id) for r in dead) == [0, 1, 2, 3]
    assert {r.api_status for r in dead} == {"INSERT RAW TABLE FAILED"}
    # the retry that succeeds leaves no record both in RAW and unresolved
    enrichment_batch(payloads, f"{root}/good", f"{root}/dead", "reference_id", dt.datetime(2024, 1, 31))(ev, 0)
    assert spark.read.parquet(f"{root}/good").count() == 4
    assert {r.api_status for r in spark.read.parquet(f"{root}/dead").collect()} == {"200"}


def _minutes(spark, files, ts_type="timestamp_ntz"):
    from enrichkit.streaming.pipeline import read_minute_counts, run_minute_counts
    root = scratch_path(spark, "minutes")
    for rows in files:
        spark.createDataFrame(rows, f"ts {ts_type}, kind string").coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(f"ts {ts_type}, kind string").parquet(f"{root}/in")
        run_minute_counts(stream, f"{root}/out", f"{root}/ck", write_when=F.col("kind") == "w")
    return root, read_minute_counts(spark, f"{root}/out")


def test_late_events_are_counted_in_their_minute(spark):
    """Files in reverse time order, hours beyond any watermark, give the minutes
    that one file with all events gives."""
    t = dt.datetime(2024, 1, 5, 23, 58)
    rows = [(t + dt.timedelta(seconds=17 * i), "w" if i % 4 == 0 else "r") for i in range(400)] + [(None, "w")]
    old, new = rows[:150], rows[150:]
    root, late = _minutes(spark, [new, old[::2], old[1::2]])
    _, whole = _minutes(spark, [rows])
    figures = ["minute", "calls", "writes", "written_rows"]
    key = lambda r: str(r)
    got = sorted(late.select(*figures).collect(), key=key)
    assert got == sorted(whole.select(*figures).collect(), key=key) and sum(r.calls for r in got) == len(rows)
    assert {r.batches for r in late.collect()} >= {1, 2}
    from enrichkit.streaming.pipeline import read_minute_counts
    day = read_minute_counts(spark, f"{root}/out", (dt.date(2024, 1, 5), dt.date(2024, 1, 5)))
    assert sorted(r.minute for r in day.collect()) == [t, t + dt.timedelta(minutes=1)]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "day" in plan.split("PartitionFilters")[1][:200]


def test_replayed_micro_batch_does_not_count_twice(spark):
    from enrichkit.streaming.pipeline import _figures, read_minute_counts
    from enrichkit.sources.zones import write_zone
    root, _ = _minutes(spark, [[(dt.datetime(2024, 1, 5), "w")] * 5])
    share = spark.read.parquet(f"{root}/out")
    assert [c for c in share.columns if c not in ("minute", "day", "batch_id")] == ["calls", "writes", "written_rows"]
    write_zone(spark.createDataFrame(share.collect(), share.schema), f"{root}/out", ["day", "batch_id"],
               overwrite_partitions=True)                               # what a replay writes
    assert [r.calls for r in read_minute_counts(spark, f"{root}/out").collect()] == [5] and len(_figures()) == 3


def test_every_row_without_a_key_is_a_dead_letter(spark):
    from enrichkit.streaming.pipeline import enrichment_batch
    root = scratch_path(spark, "nullkeys")
    ts = dt.datetime(2024, 1, 5)
    ev = spark.createDataFrame([(i, None if i < 3 else 7, "Android", ts, ts.date()) for i in range(5)], EV)
    payloads = spark.createDataFrame([(7, "{}")], "key bigint, payload string")
    for batch_id in (0, 0, 1):                       # a replay, then the same rows sent again
        enrichment_batch(payloads, f"{root}/raw", f"{root}/dead", "reference_id", dt.datetime(2024, 1, 31))(ev, batch_id)
        dead = spark.read.parquet(f"{root}/dead").collect()
        assert sorted(d.cuid for d in dead if d.batch_id == 0) == ["0", "1", "2"]
        assert {(d.api_status, d.reference_id) for d in dead} == {("400", None)}
        assert [r.reference_id for r in spark.read.parquet(f"{root}/raw").collect()] == [7]


def test_key_index_reads_the_buckets_of_the_batch(spark):
    from enrichkit.sources.zones import write_zone
    from enrichkit.streaming.pipeline import index_path, key_bucket, landed_keys
    root = scratch_path(spark, "keyindex")
    raw = spark.range(500).select(F.col("id").alias("reference_id"), F.current_date().alias("partition_date"),
                                  (F.col("id") % 2).alias("batch_id"))
    assert landed_keys(spark, f"{root}/raw", raw, "reference_id", 9) is None
    write_zone(raw, f"{root}/raw", ["partition_date", "batch_id"])
    asked = spark.createDataFrame([(3,), (8,), (1000,), (None,)], "reference_id bigint")
    found = landed_keys(spark, f"{root}/raw", asked, "reference_id", 9, buckets=16)     # the index is made from RAW
    assert sorted(r.key for r in found.collect()) == ["3", "8"]
    again = landed_keys(spark, f"{root}/raw", asked, "reference_id", 1, buckets=16)     # not from its own batch
    assert [r.key for r in again.collect()] == ["8"]
    assert spark.read.parquet(index_path(f"{root}/raw")).count() == 500
    plan = found._jdf.queryExecution().optimizedPlan().toString() + found._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters")[1][:300]
    buckets = {r.bucket for r in asked.select(key_bucket(F.col("reference_id"), 16).alias("bucket")).collect()} - {None}
    assert all(f"{b}" in plan.split("PartitionFilters")[1][:300] for b in buckets) and len(buckets) <= 3


def test_compacted_minutes_and_keys_read_alike(spark):
    from enrichkit.plans.versions import pointer
    from enrichkit.sources.zones import write_zone
    from enrichkit.streaming.pipeline import (compact_key_index, compact_minute_counts, index_path, landed_keys,
                                              read_minute_counts, run_minute_counts, write_key_index)
    t = dt.datetime(2024, 1, 5, 23, 58)
    files = [[(t + dt.timedelta(seconds=40 * i + j), "w") for i in range(9)] for j in range(4)]
    root, counts = _minutes(spark, files)
    key = lambda r: str(r)
    want = sorted(counts.collect(), key=key)
    assert compact_minute_counts(spark, f"{root}/out") is not None
    assert sorted(read_minute_counts(spark, f"{root}/out").collect(), key=key) == want
    assert compact_minute_counts(spark, f"{root}/out") is None          # the last micro-batch stays
    last = spark.read.parquet(f"{root}/out").filter("batch_id = 3")
    write_zone(spark.createDataFrame(last.collect(), last.schema), f"{root}/out", ["day", "batch_id"], overwrite_partitions=True)
    assert sorted(read_minute_counts(spark, f"{root}/out").collect(), key=key) == want      # a replay of it
    spark.createDataFrame([(t, "r")], "ts timestamp_ntz, kind string").coalesce(1).write.mode("append").parquet(f"{root}/in")
    run_minute_counts(spark.readStream.schema("ts timestamp_ntz, kind string").parquet(f"{root}/in"), f"{root}/out",
                      f"{root}/ck", write_when=F.col("kind") == "w")
    compact_minute_counts(spark, f"{root}/out")
    got = {r.minute: (r.calls, r.batches) for r in read_minute_counts(spark, f"{root}/out").collect()}
    assert got[t] == (dict((r.minute, r.calls) for r in want)[t] + 1, 5) and pointer(spark, f"{root}/out")["number"] == 2

    raw = f"{root}/raw"
    for batch in range(3):
        rows = spark.range(batch * 10, batch * 10 + 15).select(F.col("id").alias("k"), F.lit(batch).cast("bigint").alias("batch_id"))
        write_key_index(rows, index_path(raw), "k", 8)
    asked = spark.range(100).select(F.col("id").alias("k"))
    before = {b: sorted(int(r.key) for r in landed_keys(spark, raw, asked, "k", b, 8).collect()) for b in (2, 9)}
    compact_key_index(spark, raw)
    after = {b: sorted(int(r.key) for r in landed_keys(spark, raw, asked, "k", b, 8).collect()) for b in (2, 9)}
    assert before == after == {2: list(range(25)), 9: list(range(35))}
