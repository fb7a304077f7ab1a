"""Pipeline outputs conform exactly to the zone schemas (same columns)."""
import datetime as dt

from pyspark.sql import functions as F

from enrichkit import schemas
from enrichkit.plans.enrich import geo_enrich, lookup_join, split_outcomes, to_dead_letter, to_raw
from enrichkit.plans.flatten import flatten_device, flatten_geo
from enrichkit.plans.mappings import ANDROID, IOS
from enrichkit.sources import testdata as td
from enrichkit.sources.zones import conform

SF = "/root/testdata/sf0.001"
NOW = dt.datetime(2024, 1, 31)


def test_schema_sizes():
    assert len(schemas.device_features(ANDROID).fields) == 222
    assert len(schemas.device_features(IOS).fields) == 92
    assert len(schemas.geo_features().fields) == 53


def test_outputs_conform(spark):
    ok, bad = split_outcomes(lookup_join(td.device_events(spark, SF), td.device_payloads(spark, SF), "reference_id"))
    raw = to_raw(ok, td.AS_OF, NOW, ["cuid", "reference_id", F.lit(None).alias("series_number"), "device_os"])
    dead = to_dead_letter(bad, td.AS_OF, NOW, {"cuid": ["cuid"], "reference_id": ["reference_id"],
                                               "series_number": ["reference_id"], "device_os": ["device_os"]})
    assert conform(raw, schemas.DEVICE_RAW).count() == raw.count()
    assert conform(dead, schemas.DEVICE_DEAD_LETTER).count() == dead.count()
    g_raw, g_dead = geo_enrich(td.geo_points(spark, SF), td.pois(spark, SF), td.AS_OF, NOW,
                               td.geo_failures(spark, SF))
    assert conform(g_raw, schemas.GEO_RAW).columns == [f.name for f in schemas.GEO_RAW.fields]
    assert conform(g_dead, schemas.GEO_DEAD_LETTER).columns == [f.name for f in schemas.GEO_DEAD_LETTER.fields]
    assert conform(td.geo_dead_letter(spark, SF), schemas.GEO_DEAD_LETTER).count() > 0
    assert conform(td.flow_log(spark, SF), schemas.FLOW_LOG).count() > 0
    assert conform(td.api_log(spark, SF), schemas.API_LOG).count() > 0
    for m in (ANDROID, IOS):
        f = flatten_device(td.device_raw(spark, SF), None, m)
        assert conform(f, schemas.device_features(m)).columns == f.columns
    g = flatten_geo(td.geo_raw(spark, SF), None)
    assert conform(g, schemas.geo_features()).columns == g.columns
