"""A third of all rows on one key / one coordinate: results stay whole and
exact, and the plans cut hot groups before they are shuffled."""
from pyspark.sql import functions as F

from enrichkit.operators.batching import assign_batches
from enrichkit.operators.dedup import latest_per_key
from enrichkit.operators.joins import exclude_processed
from enrichkit.operators.radius import poi_counts

N = 3000


def _skewed(spark):
    # key 0 holds a third of the rows, the rest are unique keys
    return spark.range(N).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                 F.col("id").alias("v"))


def test_latest_per_key_hot_key(spark):
    df = _skewed(spark).repartition(8)
    out = latest_per_key(df, ["k"], [F.col("v").desc()])
    rows = {r.k: r.v for r in out.collect()}
    assert rows[0] == N - 3 and len(rows) == 1 + (N - N // 3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    partial = plan.find("WindowGroupLimit [k")
    assert "Partial" in plan and partial != -1
    # the partial limit sits below (after, in the plan text) the exchange
    assert plan.rfind("Partial") > plan.find("Exchange hashpartitioning(k")


def test_anti_join_hot_done_key(spark):
    cand = spark.range(100).withColumnRenamed("id", "k")
    done = _skewed(spark).select("k").filter(F.col("k") < 50)      # key 0 repeated 1000 times
    out = exclude_processed(cand, [(done, {"k": "k"})])
    done_keys = {0 if i % 3 == 0 else i for i in range(N)}
    assert sorted(r.k for r in out.collect()) == [k for k in range(100) if not (k in done_keys and k < 50)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[k" in plan                          # done keys de-duplicated first


def test_poi_counts_many_copies_of_one_point(spark):
    pts = spark.range(N).select(F.col("id").alias("point_id"),
                                F.when(F.col("id") % 3 == 0, F.lit(10.0)).otherwise(F.lit(10.0) + F.col("id") * 1e-4)
                                .alias("lat"), F.lit(106.0).alias("lon"))
    places = spark.range(200).select(F.col("id").alias("place_id"), (F.lit(10.0) + F.col("id") * 1e-3).alias("lat"),
                                     F.lit(106.0).alias("lon"), F.array(F.lit("bank")).alias("types"),
                                     F.lit(True).alias("operational"))
    got = {r.point_id: r["count"] for r in poi_counts(pts, places, {"fin": ["bank"]}).collect()}
    assert len(got) == N
    # brute force on a sample of points, including copies of the hot coordinate
    from enrichkit.operators.radius import haversine_m
    for pid in [0, 3, 1, 2, 1501, 2999]:
        p = pts.filter(F.col("point_id") == pid).collect()[0]
        want = places.filter(haversine_m(F.lit(p.lat), F.lit(p.lon), F.col("lat"), F.col("lon")) <= 700).count()
        assert got[pid] == want


def test_batches_with_hot_sort_key(spark):
    df = _skewed(spark).repartition(8)
    out = assign_batches(df, 500, ["k", "v"]).collect()
    assert sorted(r.row_in_order for r in out) == list(range(1, N + 1))
    first = sorted(out, key=lambda r: r.row_in_order)[: N // 3]
    assert all(r.k == 0 for r in first)


def test_session_enables_skew_handling(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
