"""Sources, sinks, SQL jobs and plan shapes."""
import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from enrichkit.session import scratch_path
from enrichkit.sources.zones import conform, param_literal, read_zone, run_sql, write_zone

SF = "/root/testdata/sf0.001"


def test_param_binding_types(spark):
    row = run_sql(spark, "SELECT :a AS a, :b AS b, :c AS c, :d AS d, :e AS e",
                  {"a": True, "b": 3, "c": "2024-01-05", "d": None, "e": "x"}).collect()[0]
    assert row.a is True and row.b == 3 and row.c == dt.date(2024, 1, 5) and row.d is None and row.e == "x"
    types = dict(spark.range(1).select(param_literal(True).alias("t"),
                                       param_literal(dt.datetime(2024, 1, 5, 7)).alias("d")).dtypes)
    assert types == {"t": "boolean", "d": "timestamp_ntz"}
    at = run_sql(spark, "SELECT CAST(:d AS string) AS d", {"d": dt.datetime(2024, 1, 5, 7)}).collect()[0]
    assert at.d == "2024-01-05 07:00:00"


def test_conform(spark):
    target = StructType([StructField("a", StringType()), StructField("b", StringType())])
    df = spark.createDataFrame([(1,)], "a int")
    assert conform(df, target, pad_missing=True).dtypes == [("a", "string"), ("b", "string")]
    with pytest.raises(ValueError):
        conform(df, target)
    with pytest.raises(ValueError):
        conform(spark.createDataFrame([(1, 2, 3)], "a int, b int, c int"), target)


def test_batch_overwrite_is_idempotent(spark):
    path = scratch_path(spark, "test_zone")
    df = spark.createDataFrame([(1, 7), (2, 7)], "k int, batch_id int")
    write_zone(df, path, ["batch_id"], overwrite_partitions=True)
    write_zone(df, path, ["batch_id"], overwrite_partitions=True)          # replay of batch 7
    write_zone(spark.createDataFrame([(3, 8)], "k int, batch_id int"), path, ["batch_id"], overwrite_partitions=True)
    assert sorted(r.k for r in read_zone(spark, path, "").collect()) == [1, 2, 3]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_daily_candidates_plan_uses_anti_joins_and_pruning(spark):
    import __spark_entry__ as entry
    from enrichkit.catalog import device_spec
    from enrichkit.plans.candidates import daily_candidates
    from enrichkit.sources import testdata as td
    p = _plan(daily_candidates(td.device_events(spark, SF), td.customers(spark, SF), td.applications(spark, SF),
                               [td.device_raw_done(spark, SF, "android"), td.device_raw_done(spark, SF, "ios")],
                               td.device_dead_letter(spark, SF), device_spec(), limit=False))
    assert p.count("LeftAnti") == 3
    assert "WindowGroupLimit" in p                      # latest-per-key limited before the shuffle
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in p
    # a batch: its keys were cut before any join, and the joins see only theirs
    p = _plan(entry.queries()["daily_candidates"](spark, SF))
    assert "LeftAnti" not in p and p.count("LeftSemi") >= 3


def test_flatten_shuffles_only_for_dedup(spark):
    import __spark_entry__ as entry
    p = _plan(entry.queries()["flatten_ios"](spark, SF))
    # one exchange for latest-per-key; the anti join side is broadcast or a
    # second exchange; no per-section join or regroup
    assert p.count("Exchange hashpartitioning") <= 2
    assert "SortMergeJoin" not in p or p.count("SortMergeJoin") == 1


def test_landing_skips_unnamed_and_reports(spark):
    from enrichkit.sources.zones import land_json, landing_report, read_landing
    path = scratch_path(spark, "landing")
    df = spark.createDataFrame([(1, "Android", "{}", dt.date(2024, 1, 5)), (None, "IOS", "{}", dt.date(2024, 1, 5))],
                               "reference_id bigint, device_os string, raw_data string, partition_date date")
    landed, unnamed = land_json(df, path)
    assert landed.count() == 1 and [r.device_os for r in unnamed.collect()] == ["IOS"]
    back = read_landing(spark, path, "reference_id bigint, raw_data string, landing_name string, "
                                     "partition_date date, device_os string").collect()
    assert [(r.reference_id, r.landing_name) for r in back] == [(1, "2024-01-05_android_1.json")]
    rep = landing_report(df).collect()[0]
    assert (rep.total, rep.uploaded, rep.failed) == (2, 1, 1)


def test_left_chain_made_inner(spark):
    import __spark_entry__ as entry
    plan = entry.queries()["left_made_inner"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 1 and plan.count("LeftOuter") == 1


def test_flatten_since_prunes_raw_partitions(spark):
    from enrichkit.plans.flatten import flatten_geo
    from enrichkit.sources import testdata as td
    path = scratch_path(spark, "geo_raw_zone")
    raw = td.geo_raw(spark, SF)
    old = raw.withColumn("partition_date", F.lit(dt.date(2024, 1, 1)))
    write_zone(raw.unionByName(old.withColumn("serial_number", F.col("serial_number") + 100000)), path)
    zone = read_zone(spark, path, "")
    df = flatten_geo(zone, None, since=dt.date(2024, 1, 30))
    assert df.count() == raw.count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_date" in plan and "2024-01-30" in plan
