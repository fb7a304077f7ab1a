"""Enrichment, gate, routing, functions (FIXTURES.md §3, §5)."""
import datetime as dt
import json

from pyspark.sql import functions as F

from enrichkit.functions.json import parse
from enrichkit.functions.masking import mask_columns, unmask_aes
from enrichkit.functions.scalars import count_normalise, severity
from enrichkit.operators.radius import haversine_m, poi_counts
from enrichkit.plans.enrich import (geo_enrich, lookup_with_resolver, route_by_device,
                                    scenario_summary, geo_lookup)
from enrichkit.streaming.messages import decode, route

NOW = dt.datetime(2024, 1, 31)
CAND = ("cuid string, serial_number string, current_detailed_address string, permanent_detailed_address string, "
        "tax_code string, company_name string, longitude string, latitude string")
PLACES = "place_id bigint, lat double, lon double, types array<string>, operational boolean"


def _places(spark):
    return spark.createDataFrame([
        (1, 10.0, 106.0, ["bank"], True),                 # at the point
        (2, 10.005, 106.0, ["restaurant", "store"], True),  # ~556 m north: counts once
        (3, 10.0, 106.0, ["atm"], False),                 # not operational
        (4, 10.01, 106.0, ["bank"], True),                # ~1.1 km: outside
    ], PLACES)


def test_poi_counts_radius(spark):
    pts = spark.createDataFrame([("p", 10.0, 106.0), ("far", 50.0, 50.0), ("bad", None, None)],
                                "point_id string, lat double, lon double")
    out = {(r.point_id, r.scenario): r["count"] for r in
           poi_counts(pts, _places(spark), {"fin": ["bank", "atm"], "com": ["store", "restaurant"],
                                            "res": ["apartment_building"]}).collect()}
    assert out[("p", "fin")] == 1 and out[("p", "com")] == 1 and out[("p", "res")] == 0
    assert out[("far", "fin")] == 0 and out[("bad", "fin")] is None


def test_poi_counts_near_pole_is_exact(spark):
    # at 80 degrees a 700 m radius spans several longitude cells
    lon_step = 0.03  # ~579 m at 80N
    places = spark.createDataFrame([(i, 80.0, 10.0 + lon_step * i, ["bank"], True) for i in range(-3, 4)], PLACES)
    pts = spark.createDataFrame([("p", 80.0, 10.0)], "point_id string, lat double, lon double")
    got = poi_counts(pts, places, {"fin": ["bank"]}).collect()[0]["count"]
    expect = places.filter(haversine_m(F.lit(80.0), F.lit(10.0), F.col("lat"), F.col("lon")) <= 700).count()
    assert got == expect == 3


def test_gate_and_dead_letters(spark):
    cand = spark.createDataFrame([("c1", "s1", "a", "b", None, "co", "106.0", "10.0"),
                                  ("c2", "s2", "a", "b", "t", "co", "106.0", "10.0"),
                                  ("c3", "s3", "a", "b", "t", "co", "null", "10.0")], CAND)
    fails = spark.createDataFrame([("c2", "s2", "commercial", "503")],
                                  "cuid string, serial_number string, scenario string, status string")
    raw, dead = geo_enrich(cand, _places(spark), dt.date(2024, 1, 31), NOW, fails)
    raw_rows = {r.serial_number: json.loads(r.raw_data) for r in raw.collect()}
    assert set(raw_rows) == {"s1", "s3"}                  # s2 failed one scenario -> no RAW row
    assert raw_rows["s1"]["scenario_counts"] == {"corporate_finance": "1", "residential": "0", "commercial": "1"}
    assert raw_rows["s3"]["scenario_counts"] == {"corporate_finance": "null", "residential": "null",
                                                 "commercial": "null"}   # invalid coords, no failure
    d = dead.collect()
    assert [(r.series_number, r.api_status) for r in d] == [("s2", "503")]
    summ = {r.serial_number: r for r in scenario_summary(
        geo_lookup(cand, _places(spark), fails, ["serial_number"]), ["serial_number"]).collect()}
    assert summ["s2"].successful == 2 and summ["s2"].errors == "commercial:503" and not summ["s2"].failed


def test_route_by_device(spark):
    df = spark.createDataFrame([("Android",), ("IOS",), ("windows",), (None,)], "device_os string")
    routes = route_by_device(df)
    assert sorted((r.route, str(r.device_os)) for r in routes.collect()) == [
        ("android", "Android"), ("ios", "IOS"), ("unrouted", "None"), ("unrouted", "windows")]
    assert routes._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1   # one pass


def test_resolver_errors_become_rows(spark):
    df = spark.createDataFrame([(1,), (2,)], "k bigint")

    def boom(pdf):
        raise RuntimeError("service down")

    out = lookup_with_resolver(df, "k", boom).collect()
    assert {r.status for r in out} == {"ERROR"} and len(out) == 2


def test_count_normalise_shapes(spark):
    resp = ['{"count": "4"}', '{"insights": [{"name": "INSIGHT_COUNT", "value": 7}]}', "{}", '{"count": "x"}',
            '{"count": 4.9}', '{"count": "4.0"}', '{"count": true}', '{"count": null, "insights": [{"name": "count"}]}',
            '{"insights": [{"name": "count", "count": 0, "value": 5}]}',
            '{"insights": [{"name": "other", "value": 1}, {"name": "count", "count": "3"}]}',
            '{"insights": {"name": "count"}}']
    df = spark.createDataFrame([(r,) for r in resp], "r string")
    assert [r.c for r in df.select(count_normalise(parse("r")).alias("c")).collect()] == [
        "4", "7", "0", "0", "4", "0", "1", "0", "5", "3", "0"]


def test_severity(spark):
    df = spark.createDataFrame([("400", "reference_number_invalid"), ("404", ""), ("200", ""), ("failed", ""),
                                ("400", "Dataset with the specified reference number does not exist"),
                                ("400", "dataset does not exist"), ("5xx", None)], "s string, b string")
    assert [r.v for r in df.select(severity("s", "b").alias("v")).collect()] == [
        "WARNING", "ERROR", "Info", "Info", "WARNING", "ERROR", "ERROR"]


def test_messages_routes(spark):
    import base64
    bodies = [{"message_type": "daily_recall", "processing_params": {"batch_number": 2, "source": "daily_job"}},
              {"message_type": "range_recall", "processing_params": {"start_date": "2025-01-15",
                                                                     "end_date": "2025-01-15", "batch_number": 3}},
              {"message_type": "nope"},
              {"message_type": "daily_recall", "processing_params": {"source": "daily_job"}}]
    rows = [(base64.b64encode(json.dumps(b).encode()).decode(), {"start_date": ""}) for b in bodies]
    rows.append((base64.b64encode(b"not json").decode(), {}))
    df = spark.createDataFrame(rows, "data string, attributes map<string,string>")
    out = route(decode(df)).collect()
    assert [r.route for r in out] == ["daily", "range", "error", "daily", "quarantine"]
    assert [r.valid for r in out] == [True, True, False, False, False]
    assert out[1].start_date == "2025-01-15" and out[0].batch_number == 2


def test_aes_masking_roundtrip(spark):
    key = "k" * 32
    df = spark.createDataFrame([("10.5", "addr")], "lat string, addr string")
    m = mask_columns(df, ["lat", "addr"], key=key, method="aes")
    row = m.select(unmask_aes("lat", key).alias("lat"), unmask_aes("addr", key).alias("addr")).collect()[0]
    assert (row.lat, row.addr) == ("10.5", "addr")
    assert m.collect()[0].lat != "10.5"


def test_date_valid_like_strptime(spark):
    from enrichkit.functions.scalars import date_valid
    cases = [("2024-01-05", True), ("2024-1-5", True), ("2024-01- 5", True), ("2024-02-29", True),
             ("2023-02-29", False), ("2024-13-01", False), ("2024/01/05", False), ("", False), (None, False),
             ("0000-01-01", False), ("2024-01-05 ", False), ("24-01-05", False)]
    df = spark.createDataFrame(cases, "t string, want boolean")
    got = [(r.t, r.date_valid) for r in df.select("t", date_valid("t")).collect()]
    assert got == [(t, w) for t, w in cases]
