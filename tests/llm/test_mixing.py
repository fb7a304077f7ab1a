from collections import defaultdict

import pytest
from enrichkit.llm.mixing import mix, solve_tilts, source_targets, word_count
from pyspark.sql import functions as F


def plain_targets(sizes, weights, cap):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        total = sum(w[s] for s in free)
        over = [s for s in free if left * w[s] / total > cap * sizes[s]]
        if not over:
            return {**fixed, **{s: left * w[s] / total for s in free}}
        for s in over:
            fixed[s] = cap * sizes[s]
            left -= fixed[s]


def test_targets_and_copies(hard):
    rows = mix(hard).collect()
    assert len(rows) == hard.count()
    assert sorted(r["size"] for r in rows) == sorted(len((r.text or "").encode().split())
                                                    for r in hard.select("text").collect())
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += r["size"]
    want = plain_targets(dict(sizes), (1, 2, 3), 3.0)
    taken = defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r["size"]
        taken[r.source] += r.taken
    assert rows and sorted(map(str, rows)) == sorted(map(str, mix(hard).collect()))


def test_taken_words_come_near_the_target(spark):
    rows = [(i, "w " * (1 + i * 37 % 400), f"s{i % 5 if i % 3 else 0}") for i in range(3000)]
    rows += [(3000, "", "none"), (3001, None, "none"), (3002, "a b c", "tiny")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix(df)
    per = got.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"),
                                    F.min("rate").alias("lo"), F.max("rate").alias("hi")).collect()
    for r in per:
        assert abs(r.taken - r.target) <= max(3, 0.002 * r.target), r
    # tilt: within a source the rate is a monotone function of size alone
    one = got.filter("source = 's1'").select("size", "rate").distinct().orderBy("size").collect()
    rates = [r.rate for r in one]
    assert rates == sorted(rates) or rates == sorted(rates, reverse=True)
    assert len(rates) == len({r["size"] for r in one})


def test_word_count(spark):
    df = spark.createDataFrame([("a b\tc\x0bd",), (None,), ("",), (" x y",)], "text string")
    assert [r[0] for r in df.select(word_count()).collect()] == [4, 0, 0, 2]


def test_empty_table(nothing):
    assert mix(nothing).count() == 0


def test_rates_equal_a_plain_solution_of_the_dual(spark):
    """The tilt of each source by plain bisection on its own sizes: rate =
    min(cap, exp(lam * size / mean size)) with the target met exactly."""
    import math
    rng = __import__("random").Random(6)
    sizes = {f"s{j}": [rng.choice([1, 3, 20, 150, 800]) * rng.randint(1, 9) for _ in range(60 * (1 + 3 * (j == 0)))]
             for j in range(5)}
    rows = [(i, "w " * n, s) for i, (s, n) in enumerate((s, n) for s, ns in sizes.items() for n in ns)]
    got = mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    rate = {(r.source, r["size"]): r.rate for r in got.select("source", "size", "rate").distinct().collect()}
    target = dict(got.select("source", "target").distinct().collect())
    capped = 0
    for s, ns in sizes.items():
        mean = sum(ns) / len(ns)
        if target[s] >= 3 * sum(ns) * (1 - 1e-12):
            capped += 1
            assert all(rate[s, n] == 3.0 for n in ns)
            continue
        lo, hi = -1e4, 1e4
        mass = lambda lam: sum(n * math.exp(min(lam * n / mean, math.log(3))) for n in ns)  # noqa: B023, E731
        for _ in range(300):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if mass(mid) < target[s] else (lo, mid)
        for n in ns:
            assert rate[s, n] == pytest.approx(math.exp(min(lo * n / mean, math.log(3))), rel=1e-6)
    assert capped < len(sizes)


def test_tilts_and_targets_do_not_depend_on_the_order_of_rows(spark):
    rng = __import__("random").Random(4)
    sizes = sorted({rng.randint(1, 90_000) for _ in range(3000)})
    groups = spark.createDataFrame([(s, n, rng.randint(1, 40)) for s in range(3) for n in sizes], "sid long, size long, n long")
    src = groups.groupBy("sid").agg(F.sum("n").alias("n_docs"), F.sum(F.col("n") * F.col("size")).alias("source_size"),
                                    F.min("size").alias("min_size")).withColumn("target", F.col("source_size") * (F.col("sid") + 1) / 3.7)
    runs = [groups.orderBy(F.xxhash64("size", F.lit(seed))).repartition(parts) for seed, parts in ((1, 1), (3, 17))]
    lams = [sorted(map(tuple, solve_tilts(g, src, 3.0).collect())) for g in runs]
    assert len(lams[0]) == 3 and lams[0] == lams[1]
    docs = spark.createDataFrame([(f"s{i:03d}", rng.randint(1, 999)) for i in range(400)], "source string, size long")
    targets = [sorted(map(tuple, source_targets(d, (0.1, 0.7, 2.3), 1.1).select("source", "target").collect()))
               for d in (docs, docs.orderBy("size").repartition(13))]
    assert targets[0] == targets[1]
