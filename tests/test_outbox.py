"""Message log: positions by record, bounded micro-batches, restarts, replays."""
import base64
import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from enrichkit.session import scratch_path
from enrichkit.sources.outbox import append, consume, log_entries, outbox_size, parts, publish, register, write_file
from enrichkit.sources.zones import write_zone

NUMBERS = "record long, n long, note string"


def numbers(spark, lo, hi, files=1):
    return spark.range(lo, hi, 1, files).select(F.col("id").alias("n"), F.concat(F.lit("note "), "id").alias("note"))


def collector(root):
    def work(batch, batch_id):
        write_zone(batch.withColumn("batch_id", F.lit(batch_id)), f"{root}/out", ["batch_id"], overwrite_partitions=True)
    return work


def test_batches_are_bounded_by_records_whatever_the_files(spark):
    root = scratch_path(spark, "outbox")
    append(numbers(spark, 0, 130), f"{root}/log")                # one large file
    for i in range(5):
        append(numbers(spark, 130 + 3 * i, 133 + 3 * i), f"{root}/log")
    append(numbers(spark, 145, 160, 4), f"{root}/log")           # a commit of several files
    append(numbers(spark, 0, 0), f"{root}/log")                  # and an empty one
    assert outbox_size(f"{root}/log") == 160
    ran = consume(spark, f"{root}/log", collector(root), f"{root}/state", 50, NUMBERS)
    rows = spark.read.parquet(f"{root}/out")
    assert ran == 4 and sorted(r["count"] for r in rows.groupBy("batch_id").count().collect()) == [10, 50, 50, 50]
    assert sorted((r.n, r.note) for r in rows.collect()) == [(i, f"note {i}") for i in range(160)]
    assert sorted(r.record for r in rows.collect()) == list(range(160))
    assert consume(spark, f"{root}/log", collector(root), f"{root}/state", 50, NUMBERS) == 0
    register(spark)
    whole = spark.read.format("outbox").schema(NUMBERS).load(f"{root}/log")
    assert sorted(r.n for r in whole.select("n").collect()) == list(range(160))


def test_restart_after_a_failure_loses_and_doubles_none(spark):
    root = scratch_path(spark, "outbox")
    append(numbers(spark, 0, 40, 3), f"{root}/log")
    good, seen = collector(root), []

    def flaky(batch, batch_id):
        good(batch, batch_id)                                    # the output is there, then the batch fails
        seen.append((batch_id, sorted(r.record for r in batch.select("record").collect())))
        if len(seen) == 2:
            raise OSError("stopped")
    with pytest.raises(Exception):
        consume(spark, f"{root}/log", flaky, f"{root}/state", 15, NUMBERS)
    append(numbers(spark, 40, 50), f"{root}/log")
    consume(spark, f"{root}/log", flaky, f"{root}/state", 25, NUMBERS)
    assert seen[1] == seen[2]                                    # the same records under the same id
    assert sorted(r.n for r in spark.read.parquet(f"{root}/out").collect()) == list(range(50))


def test_stream_writer_replay_adds_nothing(spark):
    root = scratch_path(spark, "outbox")
    numbers(spark, 0, 20).write.parquet(f"{root}/in")
    register(spark)
    for _ in range(2):
        q = (spark.readStream.schema("n long, note string").parquet(f"{root}/in").writeStream.format("outbox")
             .option("writer", "w").option("checkpointLocation", f"{root}/ck").trigger(availableNow=True).start(f"{root}/log"))
        q.awaitTermination()
    publish(f"{root}/log", [("twice.parquet", 20)], "w", 0)      # the replay of micro-batch 0
    assert outbox_size(f"{root}/log") == 20 and len(log_entries(f"{root}/log")) == 1
    with pytest.raises(Exception, match="only appended"):
        numbers(spark, 0, 2).write.format("outbox").mode("overwrite").save(f"{root}/log")


def test_writers_at_once_take_their_own_numbers(tmp_path):
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda i: publish(str(tmp_path), [(f"{i}.parquet", i)]), range(1, 41)))
    entries = log_entries(str(tmp_path))
    assert sorted(e["rows"] for e in entries) == list(range(1, 41))
    assert [e["first"] for e in entries] == [sum(e["rows"] for e in entries[:i]) for i in range(40)]
    spread = parts(entries, 5, 600)
    assert sum(p.take for p in spread) == 595 and spread[0].first == 5
    assert write_file(str(tmp_path), iter([])) == []


def test_messages_of_an_outbox_are_routed(spark):
    from enrichkit.streaming.messages import decode, route
    root = scratch_path(spark, "outbox")
    body = lambda d: base64.b64encode(json.dumps(d).encode()).decode()
    sent = [(1, body({"message_type": "daily_recall", "processing_params": {"batch_number": 2}}), {"start_date": ""}),
            (2, "not base64!", {}), (3, None, None)]
    append(spark.createDataFrame(sent, "message_id long, data string, attributes map<string,string>"), f"{root}/log")

    def work(batch, batch_id):
        route(decode(batch)).select("message_id", "route", "valid").write.mode("append").parquet(f"{root}/out")
    assert consume(spark, f"{root}/log", work, f"{root}/state", 2) == 2
    assert sorted(tuple(r) for r in spark.read.parquet(f"{root}/out").collect()) == [
        (1, "daily", True), (2, "quarantine", False), (3, "quarantine", False)]
