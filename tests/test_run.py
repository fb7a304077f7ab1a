"""End-to-end geo run (PL-11) on fresh zones over sf0.001."""
import datetime as dt

from enrichkit.plans.run import DEAD, FEATURES, FLOWLOG, OUTBOX, RAW, GeoSources, run_geo
from enrichkit.session import scratch_path
from enrichkit.sources import testdata as td
from enrichkit.sources.zones import read_zone, write_zone
from enrichkit.spec import RunSpec

SF = "/root/testdata/sf0.001"


def test_run_geo_writes_every_zone(spark):
    root = scratch_path(spark, "test_run")
    write_zone(td.geo_dead_letter(spark, SF), f"{root}/{DEAD}")
    src = GeoSources(td.customers(spark, SF), td.applications(spark, SF), td.apply_info(spark, SF),
                     td.pois(spark, SF), td.geo_failures_by_order(spark, SF))
    spec = RunSpec(as_of=td.AS_OF, batch_size=50, retry_from_days=20, retry_to_days=1, batch_uuid="t")
    summary = run_geo(spark, src, root, spec, dt.datetime(2024, 1, 31)).collect()
    raw = read_zone(spark, root, RAW)
    feats = read_zone(spark, root, FEATURES)
    assert sum(r.success_count for r in summary) == raw.select("serial_number").distinct().count()
    assert feats.count() == raw.count() and len(feats.columns) == 53
    assert [(r.topic, r.message) for r in read_zone(spark, root, OUTBOX).collect()] == [
        ("anonymization", '{"file_list": ["geo_features"]}')]
    log = {r.task_name: r.status for r in read_zone(spark, root, FLOWLOG).collect()}
    assert log == {"reconcile": "SUCCESS", "enrich": "SUCCESS", "retry": "SUCCESS", "flatten": "SUCCESS"}
    # a second run finds nothing new to do and flattens nothing twice
    again = run_geo(spark, src, root, spec, dt.datetime(2024, 2, 1)).collect()
    assert read_zone(spark, root, FEATURES).count() == feats.count()
    assert not [r for r in again if r.batch_label.startswith("batch-")]


def test_reconcile_leaves_no_old_version(spark):
    """A partition whose rows are all resolved: each uuid has one current row."""
    from enrichkit.plans.retry import latest_versions
    from enrichkit.plans.run import reconcile_zone
    root = scratch_path(spark, "test_reconcile")
    dead = td.geo_dead_letter(spark, SF).filter("api_status = '500'")
    day = dt.date(2024, 1, 30)
    write_zone(dead, f"{root}/{DEAD}")
    write_zone(dead.selectExpr("series_number AS serial_number", "DATE '2024-01-30' AS partition_date"), f"{root}/{RAW}")
    assert reconcile_zone(spark, root, day, dt.datetime(2024, 1, 31)) == dead.count() > 0
    now = latest_versions(read_zone(spark, root, DEAD)).collect()
    assert len(now) == dead.count() and {(r.api_status, r.partition_date) for r in now} == {("200", day)}
    assert reconcile_zone(spark, root, day, dt.datetime(2024, 2, 1)) == 0


def test_broken_zone_is_not_an_empty_one(spark, tmp_path):
    import pytest
    from enrichkit.sources.zones import read_zone_or_none
    assert read_zone_or_none(spark, str(tmp_path), "none") is None
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        read_zone_or_none(spark, str(tmp_path), "bad").count()


def test_scratch_needs_a_shared_folder_on_a_cluster():
    import pytest
    from enrichkit.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())
