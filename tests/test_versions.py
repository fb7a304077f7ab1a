"""Compaction of versioned zones, sketches of pending keys, parsed payloads."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from enrichkit.operators.joins import bit_sketch, exclude_processed, sieve
from enrichkit.plans import versions
from enrichkit.plans.retry import latest_versions
from enrichkit.session import scratch_path
from enrichkit.sources.zones import write_zone

SCHEMA = "uuid string, api_status string, bq_updated_time timestamp_ntz, partition_date date, note string"


def rows(seed, n, hour):
    rng = random.Random(seed)
    return [(f"u{rng.randrange(40)}", rng.choice(["200", "500"]), dt.datetime(2024, 1, 1, hour, i % 60),
             dt.date(2024, 1, rng.randint(1, 3)), f"{seed}-{i}") for i in range(n)]


def put(spark, path, data):
    write_zone(spark.createDataFrame(data, SCHEMA), path)


def state(df):
    return sorted(tuple(sorted(r.asDict().items(), key=str)) for r in df.collect())


@pytest.mark.parametrize("limit", [200_000, 0])
def test_compaction_keeps_the_current_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(versions, "BROADCAST_KEYS", limit)
    path = scratch_path(spark, "versions")
    assert versions.current(spark, path) is None and versions.compact(spark, path) is None
    for step in range(3):
        put(spark, path, rows(step, 50, step))
        want = state(latest_versions(spark.read.parquet(path)))
        assert state(versions.current(spark, path)) == want
        folder = versions.compact(spark, path)
        assert state(versions.current(spark, path)) == want
        assert spark.read.parquet(folder).count() == len(want)
        assert versions.compact(spark, path) is None            # nothing new
    assert versions.pointer(spark, path)["number"] == 3 and len(versions.unused(spark, path)) > 3


def test_a_crash_between_the_steps_loses_nothing(spark, monkeypatch):
    path = scratch_path(spark, "versions")
    put(spark, path, rows(1, 60, 1))
    versions.compact(spark, path)
    put(spark, path, rows(2, 60, 2))
    want = state(latest_versions(spark.read.parquet(path)))
    real = type(spark).createDataFrame

    def broken(self, data, schema=None, **kw):
        if schema == versions.POINTER:
            raise OSError("stopped before the swap")
        return real(self, data, schema, **kw)
    monkeypatch.setattr(type(spark), "createDataFrame", broken)
    with pytest.raises(OSError):
        versions.compact(spark, path)
    monkeypatch.undo()
    assert versions.pointer(spark, path)["number"] == 1 and state(versions.current(spark, path)) == want
    versions.compact(spark, path)
    assert state(versions.current(spark, path)) == want


def test_rows_appended_during_a_compaction_stay(spark, monkeypatch):
    """A writer adds rows behind the snapshot's read and before the swap."""
    path = scratch_path(spark, "versions")
    put(spark, path, rows(1, 30, 1))
    before = versions._current

    def slow(snapshot, fresh, key):
        out = before(snapshot, fresh, key)
        put(spark, path, [("late", "500", dt.datetime(2024, 1, 2), dt.date(2024, 1, 2), "late")])
        return out
    monkeypatch.setattr(versions, "_current", slow)
    versions.compact(spark, path)
    monkeypatch.undo()
    assert state(versions.current(spark, path)) == state(latest_versions(spark.read.parquet(path)))
    assert versions.current(spark, path).filter("uuid = 'late'").count() == 1


def test_sieve_keeps_all_matches_and_few_others(spark):
    pending = spark.range(0, 3000, 3).select(F.col("id").alias("k"))
    done = spark.range(0, 100_000, 2).select(F.col("id").alias("d"))
    sketch = bit_sketch(F.col("k"), pending, 18)
    left = sieve(done, F.col("d"), sketch, 18)
    got = {r.d for r in left.collect()}
    assert set(range(0, 3000, 6)) <= got and len(got) < 500 + 50_000 * 0.01
    assert sketch.count() <= (1 << 18) // 32768 and sketch.agg(F.max(F.length("sketch"))).first()[0] == 4096
    for bits in (None, 10, 20):
        out = exclude_processed(pending, [(done, {"k": "d"})], sketch_bits=bits)
        assert sorted(r.k for r in out.collect()) == [i for i in range(0, 3000, 3) if i % 2]
    two = pending.withColumn("j", F.col("k") % 5)
    some = done.withColumn("m", F.lit(0).cast("bigint"))
    out = exclude_processed(two, [(some, {"k": "d", "j": "m"})], sketch_bits=16)
    assert out.count() == 900
    with pytest.raises(TypeError):
        exclude_processed(pending, [(done.withColumn("d", F.col("d").cast("string")), {"k": "d"})], sketch_bits=8)
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_parsed_raw_is_flattened_alike_without_parsing(spark):
    from enrichkit.plans.flatten import PARSED, flatten_device, parsed_raw
    from enrichkit.plans.mappings import IOS
    from enrichkit.sources import testdata as td
    raw = td.device_raw(spark, "/root/testdata/sf0.001", "IOS").unionByName(
        td.device_raw(spark, "/root/testdata/sf0.001", "IOS").limit(3).withColumn("raw_data", F.lit("{broken"))
        .withColumn("reference_id", F.concat(F.lit("bad"), "reference_id")))
    path = scratch_path(spark, "parsed")
    parsed_raw(raw).write.parquet(path)
    zone = spark.read.parquet(path)
    assert zone.filter(F.col(PARSED).isNull()).select("raw_data").distinct().collect()[0][0] == "{broken"
    a, b = flatten_device(raw, None, IOS), flatten_device(zone, None, IOS)
    key = lambda r: str(r)
    assert sorted(a.collect(), key=key) == sorted(b.collect(), key=key)
    assert "parse_json" not in b._jdf.queryExecution().executedPlan().toString()
