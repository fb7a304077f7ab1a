"""Latest unseen row per key by narrow passes: equal to the plain form, payloads
stay where they are."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from enrichkit.operators.dedup import latest_per_key, latest_unseen
from enrichkit.operators.joins import incremental
from enrichkit.session import scratch_path

ORDER = [("day", True), ("at", True), ("uuid", False)]
SCHEMA = "key string, day date, at timestamp_ntz, uuid string, payload string"


def rows(seed, keys=60, hot=False):
    rng = random.Random(seed)
    out = []
    for i in range(300):
        key = "hot" if hot and i % 3 == 0 else rng.choice([None, *map(str, range(keys))])
        out.append((key, rng.choice([None, dt.date(2024, 1, rng.randint(1, 4))]),
                    rng.choice([None, dt.datetime(2024, 1, 1, rng.randint(0, 3))]), rng.choice([None, f"u{i % 40}"]), f"p{i}"))
    return out + [out[5]] * 3 + [out[9]]


@pytest.mark.parametrize("limit", [32 << 20, 4000, 0])
@pytest.mark.parametrize("seen_keys", [None, [], ["1", "2", "3", "77", None], [str(i) for i in range(55)]])
def test_equals_the_plain_form(spark, limit, seen_keys):
    data = rows(len(seen_keys or []))
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    seen = None if seen_keys is None else spark.createDataFrame([(k,) for k in seen_keys], "k string")
    got = latest_unseen(df, "key", ORDER, seen, broadcast_bytes=limit)
    plain = df if seen is None else incremental(df, seen, "key", "k")
    plain = latest_per_key(plain.filter("key is not null"), ["key"],
                           [F.col("day").desc(), F.col("at").desc(), F.col("uuid").asc()])
    top = ["key", "day", "at", "uuid"]
    key = lambda r: str(r)
    assert sorted(got.select(top).collect(), key=key) == sorted(plain.select(top).collect(), key=key)
    assert {tuple(r) for r in got.collect()} <= {tuple(r) for r in data}


def test_hot_key_and_empty_table(spark):
    df = spark.createDataFrame(rows(3, hot=True), SCHEMA)
    assert latest_unseen(df, "key", ORDER).filter("key = 'hot'").count() == 1
    assert latest_unseen(df.limit(0), "key", ORDER, df.select("key")).count() == 0


def test_payloads_are_not_shuffled(spark):
    """A zone of RAW rows: after the narrow pass the plan has no exchange of
    rows, and the narrow pass reads no payload."""
    path = scratch_path(spark, "late")
    data = spark.range(3000).select((F.col("id") % 2000).cast("string").alias("key"), F.current_date().alias("day"),
                                    F.lit(None).cast("timestamp_ntz").alias("at"), F.uuid().alias("uuid"),
                                    F.repeat(F.lit("x"), 500).alias("payload"))
    data.write.parquet(path)
    zone = spark.read.parquet(path)
    out = latest_unseen(zone, "key", ORDER, spark.range(100).select(F.col("id").cast("string").alias("k")))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan and "BroadcastHashJoin" in plan
    assert out.count() == 1900


def test_flatten_plans_have_no_payload_exchange(spark):
    import __spark_entry__ as entry
    for name in ("flatten_android", "flatten_ios", "flatten_geo"):
        plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "Exchange range" not in plan and "Window" not in plan, name


def test_wide_rows_are_not_ranked_where_nothing_fits_a_broadcast(spark):
    data = spark.range(4000).select((F.col("id") % 1000).cast("string").alias("key"), F.col("id").alias("day"), F.lit(0).alias("at"),
                                    F.col("id").cast("string").alias("uuid"), F.repeat(F.lit("x"), 100).alias("payload"))
    seen = spark.range(100).select(F.col("id").cast("string").alias("k"))
    out = latest_unseen(data, "key", [("day", True), ("at", True), ("uuid", False)], seen, broadcast_bytes=0)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "LeftSemi" in plan
    assert sorted(r.uuid for r in out.collect()) == sorted(str(i) for i in range(3100, 4000))
