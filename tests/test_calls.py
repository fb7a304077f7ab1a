"""Call plan: the limit holds in every minute, back-offs are kept, every record ends."""
import pytest
from pyspark.sql import functions as F

from enrichkit.plans.calls import back_off, due, plan_calls, run_calls

SCHEMA = "id long, at long"


def resolver(spark, answers):
    """status of a try by id: a list of answers, the last one for ever."""
    def resolve(planned):
        rows = spark.createDataFrame([(i, t + 1, s) for i, a in answers.items() for t, s in enumerate(a + [a[-1]] * 5)],
                                     "k long, t int, status string")
        j = planned.join(rows, (F.col("id") == F.col("k")) & (F.col("try") == F.col("t")), "left").drop("k", "t")
        status = F.when(F.col("id").isNull(), F.lit("400")).otherwise(F.coalesce("status", F.lit("200")))
        return j.withColumn("status", status).withColumn("payload", F.lit(None).cast("string")).withColumn("error", F.lit(None).cast("string"))
    return resolve


@pytest.mark.parametrize("limit", [1, 7, 1000])
def test_limit_back_off_and_ends(spark, limit):
    pending = spark.createDataFrame([(i, i % 5) for i in range(60)] + [(None, 1), (None, 2)], SCHEMA).repartition(5)
    answers = {3: ["503", "200"], 4: ["500", "502", "200"], 5: ["504"], 6: ["404"], 7: ["503", "404"]}
    tries = run_calls(pending, resolver(spark, answers), "id", ["at", "id"], limit).collect()
    per = {}
    for r in tries:
        if r.minute is not None:
            per[r.minute] = per.get(r.minute, 0) + 1
    assert max(per.values()) <= limit
    by = {i: sorted((r["try"], r.minute, r.status, r.final) for r in tries if r.id == i) for i in range(60)}
    assert [s for _, _, s, _ in by[4]] == ["500", "502", "200"] and [s for _, _, s, _ in by[5]] == ["504"] * 3
    assert [s for _, _, s, _ in by[6]] == ["404"] and [s for _, _, s, _ in by[7]] == ["503", "404"]
    for runs in by.values():
        assert [f for *_, f in runs] == [False] * (len(runs) - 1) + [True]
        for a, b in zip(runs, runs[1:], strict=False):
            assert b[1] - a[1] > back_off(a[0])
    lost = [r for r in tries if r.id is None]
    assert [(r.status, r.minute, r["try"], r.final) for r in lost] == [("400", None, 1, True)] * 2


def test_plan_is_dense_and_ordered(spark):
    plan = plan_calls(spark.range(1000).select("id", (-F.col("id")).alias("at")).repartition(8), ["at", "id"], 60, 5)
    rows = {r.minute: r for r in plan.groupBy("minute").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("hi")).collect()}
    assert sorted(rows) == list(range(5, 22)) and all(rows[m].n == 60 for m in range(5, 21)) and rows[21].n == 40
    assert rows[5].hi == 999 and due(plan, 21).count() == 40
    with pytest.raises(ValueError):
        plan_calls(plan, ["id"], 0)


def test_nothing_pending(spark):
    assert run_calls(spark.createDataFrame([], SCHEMA), resolver(spark, {1: ["200"]}), "id", ["at", "id"], 5).count() == 0


def test_full_payloads_fill_every_column(spark):
    import __spark_entry__ as entry
    for name, width in (("flatten_android_full", 222), ("flatten_ios_full", 92)):
        df = entry.queries()[name](spark, "/root/testdata/sf0.001")
        assert len(df.columns) == width
        filled = df.agg(*[F.count(c).alias(c) for c in df.columns], F.count(F.lit(1)).alias("_n")).first().asDict()
        assert {filled[c] for c in df.columns} == {filled["_n"]}
