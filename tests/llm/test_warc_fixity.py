from enrichkit.llm import warc_fixity as wf

SCHEMA = "page_id long, url string, html string, file string, offset string, hash string, level string, idx string"


def make(n=400):
    rows = [(i, None if i % 9 == 0 else f"http://h/{i}", None if i % 11 == 0 else "" if i % 13 == 0 else f"p{i} " * (i % 50))
            for i in range(n)]
    rows += [(n, "u", "long " * 60000), (None, "u", "x"), (None, None, None), (4, "http://h/4", "p4 " * 4)]
    return [(*r, "a", "b", "c", "d", "e") for r in rows]


def test_finds_exactly_the_planted_damage(spark):
    records = wf.warc_records(spark.createDataFrame(make(), SCHEMA), per_file=90)
    left, right = records.collect(), wf.damaged(records).collect()
    a = {(r.file, r.offset): bytes(r.payload) for r in left}
    b = {(r.file, r.offset): bytes(r.payload) for r in right}
    want = {k: "missing" if k not in b else "changed" for k in a if a[k] != b.get(k)}
    assert want
    for size, fan in ((1 << 16, 16), (256, 2)):
        got = wf.fixity_audit(records, wf.damaged(records), size, fan).collect()
        assert {(r.file, r.offset): r.status for r in got} == want
        back = wf.fixity_audit(wf.damaged(records), records, size, fan).collect()
        assert {(r.file, r.offset): r.status for r in back} == {k: v.replace("missing", "extra") for k, v in want.items()}


def test_equal_replicas_have_equal_roots(spark):
    records = wf.warc_records(spark.createDataFrame(make(50), SCHEMA), per_file=10)
    assert wf.fixity_audit(records, records.repartition(5)).count() == 0
    tree = wf.merkle_tree(wf.record_hashes(records), 512, 2)
    top = tree.groupBy("file").agg({"level": "max"}).collect()
    assert len({r[1] for r in top}) == 1
    assert tree.filter(f"level = {top[0][1]}").groupBy("file").count().filter("count > 1").count() == 0


def test_files_cover_offsets_without_gaps(spark):
    at = {}
    for r in sorted(wf.warc_records(spark.createDataFrame(make(120), SCHEMA), per_file=50).collect(),
                    key=lambda r: (r.file, r.offset)):
        assert r.offset == at.get(r.file, 0)
        at[r.file] = r.offset + len(r.payload)


def test_empty_tables(spark):
    none = wf.warc_records(spark.createDataFrame([], SCHEMA))
    some = wf.warc_records(spark.createDataFrame(make(20), SCHEMA))
    assert wf.fixity_audit(none, none).count() == 0
    assert {r.status for r in wf.fixity_audit(some, none).collect()} == {"missing"}
    assert {r.status for r in wf.fixity_audit(none, some).collect()} == {"extra"}


def test_hashes_alone_find_the_same_damage(spark):
    """The audit of hashed records equals that of whole ones, its windows hold no
    payload, and records without ids are spread over files."""
    from pyspark.sql import functions as F
    pages = spark.createDataFrame(make(), SCHEMA).dropDuplicates(["page_id", "html"])
    records = wf.page_records(pages, per_file=90)
    left, right = wf.replicas(records, wf.damage(F.col("record_id"), F.col("payload")))
    got = {(r.record_id, r.status, r.left_sha256, r.right_sha256) for r in wf.audit_hashes(left, right).collect()}
    whole = wf.warc_records(pages, per_file=90)
    want = {(r.record_id, r.status, r.left_sha256, r.right_sha256) for r in wf.fixity_audit(whole, wf.damaged(whole)).collect()}
    assert got == want and got
    lost = spark.range(900).select(F.lit(None).cast("long").alias("page_id"), F.lit("u").alias("url"), F.col("id").cast("string").alias("html"))
    per = wf.page_records(lost).groupBy("file").count().agg(F.max("count"), F.count("*")).first()
    assert per[0] < 20 and per[1] > 300
