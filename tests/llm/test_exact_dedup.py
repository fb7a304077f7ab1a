from collections import defaultdict
import hashlib

from enrichkit.llm.exact_dedup import block_identity, exact_dedup
from pyspark.sql import functions as F


def test_matches_brute_force(hard):
    got = exact_dedup(hard, block_bytes=64, probe_bytes=4).collect()
    groups = defaultdict(list)
    for r in hard.select("doc_id", "text").collect():
        groups[r.text or ""].append(r.doc_id)
    assert len(got) == hard.count()
    kept = defaultdict(int)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = by_sha[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert all(n == 1 for n in kept.values()) and len(kept) == len(groups)


def test_block_size_does_not_matter(hard):
    a, b = (sorted(map(str, exact_dedup(hard, block_bytes=n, probe_bytes=p).collect())) for n, p in ((7, 1), (4096, 64)))
    assert a == b


def test_roots_name_equal_bytes_only(spark):
    texts = ["a" * 9, "a" * 8, "a" * 9, "ab" * 5, "aabb", "aab", "b"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").select("k", F.encode("t", "utf-8").alias("b"))
    root = {r.k: r.root for r in block_identity(df, ["k"], "b", 2).collect()}
    for i, x in enumerate(texts):
        for j, y in enumerate(texts):
            if len(x) == len(y):
                assert (root[i] == root[j]) == (x == y)


def test_empty_table(nothing):
    assert exact_dedup(nothing).count() == 0


def test_a_row_repeated_in_a_third_of_the_table(spark):
    from pyspark.sql import functions as F
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("doc_id"),
                                    F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    out = exact_dedup(df.repartition(6))
    assert out.count() == 30_000 and out.filter("doc_id = 5 and text_sha256 = sha2('same', 256)").count() == 10_000
    hot = out.filter("group_size = 10000")
    assert hot.count() == 10_000 and hot.filter("kept").count() == 1
    assert "sequence" not in hot._jdf.queryExecution().executedPlan().toString()
