"""Inputs that used to give wrong answers: ties, repeats, bad values."""
import base64
import datetime as dt

from pyspark.sql import functions as F

from enrichkit.functions.scalars import coord_text, round_text
from enrichkit.operators.batching import latest_n
from enrichkit.operators.radius import poi_counts
from enrichkit.plans import candidates
from enrichkit.plans.enrich import NO_REFERENCE, geo_enrich, lookup_join, lookup_with_resolver
from enrichkit.plans.flatten import flatten_device
from enrichkit.plans.mappings import IOS
from enrichkit.plans.opslog import countif_stats, failed_since
from enrichkit.spec import RunSpec
from enrichkit.streaming.messages import decode, done_message, route

NOW = dt.datetime(2024, 1, 31)


def test_bodies_that_are_not_base64_are_quarantined(spark):
    rows = [("A", {}), ("not base64!", {}), (None, {}), (base64.b64encode(b'{"message_type":"daily_recall"}').decode(), {})]
    df = spark.createDataFrame(rows, "data string, attributes map<string,string>")
    assert [r.route for r in route(decode(df)).collect()] == ["quarantine"] * 3 + ["daily"]


def test_done_message_starts_no_run(spark):
    m = done_message(["a", "b"])
    assert m["message"] == '{"file_list": ["a", "b"]}'
    df = spark.createDataFrame([(base64.b64encode(m["message"].encode()).decode(), {})],
                               "data string, attributes map<string,string>")
    assert [r.route for r in route(decode(df)).collect()] == ["error"]


def test_coordinate_text_out_of_range_is_null(spark):
    df = spark.createDataFrame([("1e40",), ("-181",), ("180",), ("NaN",), ("10.50",)], "x string")
    assert [r[0] for r in df.select(coord_text("x")).collect()] == [None, None, "180", None, "10.5"]
    big = spark.createDataFrame([(1e40,)], "x double")
    assert big.select(round_text("x")).collect()[0][0] is None


def test_one_bad_record_is_one_error(spark):
    df = spark.createDataFrame([(i if i != 7 else None,) for i in range(40)], "k bigint").coalesce(1)

    def resolver(pdf):
        import pandas as pd
        if (pdf["k"] == 13).any():
            raise RuntimeError("bad record " + "x" * 900)
        return pd.DataFrame({"payload": "p", "status": "200", "error": None, "retry": 0}, index=pdf.index)

    out = {r.k: r for r in lookup_with_resolver(df, "k", resolver).collect()}
    assert [k for k, r in out.items() if r.status == "ERROR"] == [13]
    assert len(out[13].error) > 900 and out[None].status == NO_REFERENCE[0]
    assert sum(r.status == "200" for r in out.values()) == 38


def test_lookup_gives_one_row_a_record(spark):
    cand = spark.createDataFrame([(1,), (2,), (None,)], "k bigint")
    pay = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (None, "x", 1)], "key bigint, payload string, t int")
    got = sorted(lookup_join(cand, pay, "k", latest_by="t").collect(), key=str)
    assert [(r.k, r.payload, r.status) for r in sorted(got, key=lambda r: (r.k is None, r.k))] == [
        (1, "new", "200"), (2, None, "404"), (None, None, "400")]


def test_repeated_place_counts_once_and_dense_cells_stay_exact(spark, monkeypatch):
    from enrichkit.operators import radius
    monkeypatch.setattr(radius, "CELL_PLACES", 3)
    places = [(i % 40, 10.0 + (i % 40) * 1e-5, 106.0, ["bank"], True) for i in range(80)]
    df = spark.createDataFrame(places, "place_id int, lat double, lon double, types array<string>, operational boolean")
    pts = spark.createDataFrame([(1, 10.0, 106.0), (2, 11.0, 106.0), (3, None, 1.0)], "p int, lat double, lon double")
    got = {r.p: r["count"] for r in poi_counts(pts, df, {"bank": ["bank"]}, 700.0, point_key="p").collect()}
    assert got == {1: 40, 2: 0, 3: None}


def test_records_that_share_a_serial_keep_their_own_outcome(spark):
    cols = ("cuid int, serial_number string, current_detailed_address string, permanent_detailed_address string, "
            "tax_code string, company_name string, longitude string, latitude string")
    cand = spark.createDataFrame([(1, "s", "a", "b", "t", "c", "106.0", "10.0"),
                                  (2, "s", "a", "b", "t", "c", "50.0", "50.0")], cols)
    places = spark.createDataFrame([(1, 10.0, 106.0, ["bank"], True)],
                                   "place_id int, lat double, lon double, types array<string>, operational boolean")
    fails = spark.createDataFrame([(2, "s", "residential", "503"), (2, "s", "residential", "503")],
                                  "cuid int, serial_number string, scenario string, status string")
    raw, dead = geo_enrich(cand, places, NOW.date(), NOW, fails)
    assert [(r.cuid, r.raw_data) for r in raw.collect()] == [
        (1, '{"scenario_counts":{"corporate_finance":"1","residential":"0","commercial":"0"}}')]
    d = dead.collect()
    assert [(r.cuid, r.api_status) for r in d] == [(2, "503")]
    assert '"company_name":"c"' in d[0].api_payload_message and '"scenario":"residential"' in d[0].api_payload_message
    plan = raw._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan                       # both results filter one written outcome


def test_tied_rows_in_any_order_give_one_answer(spark):
    schema = "cuid int, tax_code string, company_name string, longitude string, latitude string"
    rows = [(1, "t", "c", "106.1", "10.1"), (1, "t", "c", "106.2", "10.2")]
    cust = spark.createDataFrame([(1, 1, "a", "b", dt.date(2024, 1, 1))],
                                 "id int, cuid int, current_detailed_address string, permanent_detailed_address string, partition_date date")
    apps = spark.createDataFrame([(1, 5, NOW, "ACTIVE", dt.date(2024, 1, 1), NOW)],
                                 "customer_id int, serial_number int, created_at timestamp_ntz, status string, partition_date date, bq_updated_time timestamp_ntz")
    none = spark.createDataFrame([], "serial_number int, series_number int")
    got = set()
    for order in (rows, rows[::-1]):
        info = spark.createDataFrame(order, schema).coalesce(1)
        got |= {(r.latitude, r.longitude) for r in candidates.geo_candidates(
            cust, apps, info, none.select("serial_number"), none.select("series_number"),
            RunSpec(as_of=dt.date(2024, 1, 31))).collect()}
    assert len(got) == 1
    t = spark.createDataFrame([(3, NOW), (1, NOW), (2, NOW)], "id int, ts timestamp_ntz")
    assert [r.id for r in latest_n(t, "ts", 2).collect()] == [1, 2]


def test_status_rule_of_the_statistics(spark):
    log = spark.createDataFrame([("a", "200", NOW, 0), ("a", "503", NOW, 2), ("b", "204", NOW, 1), ("a", None, NOW, 0)],
                                "api_type string, status_code string, start_time timestamp_ntz, retry int")
    r = countif_stats(log, by_day=False).collect()[0]
    assert (r.ok_calls, r.failed_calls, r.last_call) == (3, 1, NOW)
    assert countif_stats(log, by_day=False, api_type="b").collect()[0].calls == 1
    dead = spark.createDataFrame([("503", dt.date(2024, 1, 2)), ("200", dt.date(2024, 1, 2)), ("404", dt.date(2024, 1, 1))],
                                 "api_status string, partition_date date")
    assert failed_since(dead, dt.date(2024, 1, 2)).collect()[0].failed == 1


def test_flatten_runs_twice_without_repeats(spark):
    rows = [("u1", "1", "r1", '{"referenceNumber":"other","insights":[]}'), ("u2", "1", "r2", '{"insights":[]}')]
    raw = spark.createDataFrame([(*r[:3], "s", "IOS", r[3], NOW, NOW.date()) for r in rows],
                                "uuid string, cuid string, reference_id string, series_number string, device_os string, "
                                "raw_data string, bq_updated_time timestamp_ntz, partition_date date")
    first = flatten_device(raw, None, IOS, with_key=True)
    assert sorted(r.raw_reference_id for r in first.collect()) == ["r1", "r2"]
    keys = first.select(F.col("raw_reference_id").alias("reference_number"))
    assert flatten_device(raw, keys, IOS, with_key=True).count() == 0
