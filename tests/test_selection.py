"""Candidate selection, retry list, reconcile, batching (FIXTURES.md §5)."""
import datetime as dt

from pyspark.sql import functions as F

from enrichkit.operators.batching import assign_batches, global_rank
from enrichkit.operators.dedup import latest_per_key
from enrichkit.plans.candidates import daily_candidates
from enrichkit.plans.retry import reconcile, retry_list
from enrichkit.spec import RunSpec

AS_OF = dt.date(2024, 1, 31)
EV = "cuid bigint, reference_id bigint, device_os string, created_timestamp timestamp_ntz, partition_date date"
CUST = "id bigint, cuid bigint, current_detailed_address string, permanent_detailed_address string, partition_date date"
APP = ("customer_id bigint, serial_number bigint, created_at timestamp_ntz, status string, partition_date date, "
       "bq_updated_time timestamp_ntz")
DL = ("uuid string, cuid bigint, reference_id bigint, series_number bigint, device_os string, "
      "api_payload_message string, api_status string, bq_updated_time timestamp_ntz, partition_date date")


def ts(d, h=0):
    return dt.datetime(2024, 1, d, h)


def test_latest_per_key_is_deterministic_on_ties(spark):
    df = spark.createDataFrame([(1, "b", dt.date(2024, 1, 2)), (1, "a", dt.date(2024, 1, 2)),
                                (1, "z", dt.date(2024, 1, 1))], "k int, v string, d date")
    for _ in range(3):
        out = latest_per_key(df.repartition(3), ["k"], [F.col("d").desc(), F.col("v").asc()]).collect()
        assert [(r.k, r.v) for r in out] == [(1, "a")]


def _inputs(spark):
    ev = spark.createDataFrame([
        (1, 10, "Android", ts(5), dt.date(2024, 1, 5)),   # plain candidate
        (1, 11, "IOS", ts(5), dt.date(2024, 1, 5)),       # already in RAW
        (2, 12, "Android", ts(6), dt.date(2024, 1, 6)),   # failed yesterday only -> selected
        (2, 13, "Android", ts(6), dt.date(2024, 1, 6)),   # failed today -> excluded
        (3, 14, "Android", ts(7), dt.date(2024, 1, 7)),   # no application -> serial NULL
        (None, 15, "Android", ts(7), dt.date(2024, 1, 7)),  # no cuid -> dropped
    ], EV)
    cust = spark.createDataFrame([(1, 1, "a", "b", dt.date(2024, 1, 1)), (2, 2, "a", "b", dt.date(2024, 1, 1)),
                                  (3, 3, "a", "b", dt.date(2024, 1, 1))], CUST)
    app = spark.createDataFrame([(1, 500, ts(5, 9), "ACTIVE", dt.date(2024, 1, 5), ts(5)),
                                 (1, 501, ts(5, 10), "ACTIVE", dt.date(2024, 1, 5), ts(5)),
                                 (2, 600, ts(6, 1), "ACTIVE", dt.date(2024, 1, 6), ts(6))], APP)
    raw = spark.createDataFrame([(11,)], "reference_id bigint")
    dl = spark.createDataFrame([("x", 2, 12, None, "Android", None, "503", ts(30), dt.date(2024, 1, 30)),
                                ("y", 2, 13, None, "Android", None, "503", ts(31), AS_OF)], DL)
    return ev, cust, app, raw, dl


def test_daily_candidates_edge_cases(spark):
    ev, cust, app, raw, dl = _inputs(spark)
    out = daily_candidates(ev, cust, app, [raw], dl, RunSpec(as_of=AS_OF, batch_size=50)).collect()
    got = {r.reference_id: r.serial_number for r in out}
    assert got == {10: 500, 12: 600, 14: None}       # one row per reference; lowest serial on a tie
    assert [r.reference_id for r in out] == [10, 12, 14]


def test_daily_candidates_batch_limit(spark):
    ev, cust, app, raw, dl = _inputs(spark)
    out = daily_candidates(ev, cust, app, [raw], dl, RunSpec(as_of=AS_OF, batch_size=2)).collect()
    assert [r.reference_id for r in out] == [10, 12]


def test_retry_list_rules(spark):
    rows = []
    for i, st in enumerate(["200", "204", "success", "404", "failed", None]):
        rows.append((f"a{i}", 1, 100 + i, 100 + i, "Android", None, st, ts(29), dt.date(2024, 1, 29)))
    rows += [("b0", 1, 200, 200, "Android", None, "404", ts(29, 1), dt.date(2024, 1, 29)),
             ("b1", 1, 200, 200, "Android", None, "200", ts(30, 1), dt.date(2024, 1, 30)),   # newest success
             ("c0", 1, 300, 300, "Android", None, "404", ts(1), dt.date(2024, 1, 1))]         # outside window
    dl = spark.createDataFrame(rows, DL)
    out = retry_list(dl, RunSpec(as_of=AS_OF, retry_from_days=3), "reference_id", bounded=False).collect()
    assert sorted(r.reference_id for r in out) == [103, 104]


def test_geo_window_excludes_today_and_old(spark):
    rows = [("t", 1, 1, 1, None, None, "404", ts(31), AS_OF),
            ("y", 1, 2, 2, None, None, "404", ts(30), dt.date(2024, 1, 30)),
            ("o", 1, 3, 3, None, None, "404", dt.datetime(2024, 1, 10), dt.date(2024, 1, 10))]
    dl = spark.createDataFrame(rows, DL)
    spec = RunSpec(as_of=AS_OF, retry_from_days=20, retry_to_days=1)
    assert [r.series_number for r in retry_list(dl, spec, "series_number", bounded=True).collect()] == [2]


def test_reconcile_marks_landed_failures(spark):
    dl = spark.createDataFrame([("a", 1, 1, 7, None, None, "500", ts(10), dt.date(2024, 1, 10)),
                                ("b", 1, 2, 8, None, None, "200", ts(10), dt.date(2024, 1, 10)),
                                ("c", 1, 3, 9, None, None, "500", ts(10), dt.date(2024, 1, 10))], DL)
    raw = spark.createDataFrame([(7, dt.date(2024, 1, 15)), (8, dt.date(2024, 1, 15)), (9, dt.date(2024, 1, 14))],
                                "serial_number bigint, partition_date date")
    out = {r.series_number: r for r in reconcile(dl, raw, dt.date(2024, 1, 15), ts(31)).collect()}
    assert out[7].api_status == "200" and out[7].reconciled and out[7].partition_date == dt.date(2024, 1, 15)
    assert not out[8].reconciled and not out[9].reconciled and out[9].api_status == "500"


def test_batches_last_flag(spark):
    for n_rows, expect_last in [(4, True), (5, False), (6, True)]:
        df = spark.range(n_rows).repartition(3)
        out = assign_batches(df, 5, ["id"]).orderBy("id").collect()
        last_batch = max(r.batch_no for r in out)
        assert [r.row_in_order for r in out] == list(range(1, n_rows + 1))
        assert any(r.is_last for r in out) == expect_last
        assert all(r.batch_label == f"retry-{r.batch_no}" for r in out)
        assert {r.batch_rows for r in out if r.batch_no == last_batch} == {n_rows - 5 * (last_batch - 1)}


def test_global_rank_many_partitions(spark):
    df = spark.range(0, 1000, 1, 7).withColumn("k", (F.col("id") * 7919) % 1000)
    out = global_rank(df, ["k"], "r").collect()
    assert sorted((r.k, r.r) for r in out) == [(i, i + 1) for i in range(1000)]


def test_runspec_range_defaults():
    import pytest
    s = RunSpec(as_of=AS_OF).with_range_defaults()
    assert (s.start_date, s.end_date) == (dt.date(2024, 1, 30), dt.date(2024, 1, 30))
    s = RunSpec(as_of=AS_OF, start_date=dt.date(2024, 1, 10)).with_range_defaults()
    assert s.end_date == dt.date(2024, 1, 10)
    with pytest.raises(ValueError):
        RunSpec(as_of=AS_OF, start_date=dt.date(2024, 1, 10), end_date=dt.date(2024, 1, 9)).validate()
