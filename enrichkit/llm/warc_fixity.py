"""Operator 1: Merkle fixity audit of WARC replicas.

Every record is hashed; records that start in one range of file offsets are
hashed together in offset order, ranges into wider ranges (``fanout`` at a
time), up to one root a file. Two replicas are compared by their roots, then
only below nodes that differ, down to the records that are corrupt. A tree is a
small table that can be kept beside a replica, so an audit reads no payload
again and touches a few nodes for every corrupt record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from enrichkit.llm.common import empty_text, left_lookup, materialize


#: Files among which records without an id are dealt by their content.
NULL_FILES = 1024


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
                 per_file: int = 1000) -> DataFrame:
    """Response records ``file, record_id, payload`` (bytes) of pages, ``per_file``
    ids to a file. Null ids go to the files -1 to -``NULL_FILES`` by their content;
    a null body is empty and a null address is an empty field."""
    body = F.encode(empty_text(body_col), "utf-8")
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), empty_text(url_col),
                    F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    payload = F.concat(F.encode(head, "utf-8"), body, F.encode(F.lit("\r\n\r\n"), "utf-8"))
    nowhere = F.lit(-1) - F.pmod(F.xxhash64(body), F.lit(NULL_FILES))
    return pages.select(F.coalesce(F.floor(F.col(id_col) / F.lit(per_file)), nowhere).alias("file"),
                        F.col(id_col).alias("record_id"), payload.alias("payload"))


def _ahead(order: list) -> Column:
    from pyspark.sql import Window
    return F.coalesce(F.sum("length").over(Window.partitionBy("file").orderBy(*order)
                                           .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset")


def warc_records(pages: DataFrame, **options) -> DataFrame:
    """``page_records`` with their ``offset`` in the file, in id order: what a
    writer of the files needs. An audit needs no payloads: see ``replicas``."""
    rows = page_records(pages, **options).withColumn("length", F.octet_length("payload").cast("long"))
    return rows.withColumn("offset", _ahead(["record_id", F.sha2("payload", 256)])).drop("length")


def replicas(records: DataFrame, copy: Column) -> tuple[DataFrame, DataFrame]:
    """Record hashes of two replicas: ``records`` (``file, record_id, payload``)
    and, for each, the bytes that another replica holds in its place (``copy``,
    null where it lacks the record). Both are hashed where they are read; what
    moves is a few dozen bytes a record. Records that agree in file, id and both
    payloads are one; offsets go by id, then hash."""
    size = lambda c: F.octet_length(c).cast("long")
    narrow = records.select("file", "record_id", size(F.col("payload")).alias("length"), F.sha2("payload", 256).alias("hash"),
                            size(copy).alias("r_length"), F.sha2(copy, 256).alias("r_hash")).distinct()
    placed = materialize(narrow.select("*", _ahead(["record_id", "hash", F.col("r_hash").asc_nulls_first()])), "merkle-records")
    left = placed.select("file", "offset", "record_id", "length", "hash")
    right = placed.filter("r_hash IS NOT NULL").select("file", "offset", "record_id", F.col("r_length").alias("length"),
                                                       F.col("r_hash").alias("hash"))
    return left, right


def record_hashes(records: DataFrame, file_col: str = "file", offset_col: str = "offset",
                  payload_col: str = "payload", id_col: str = "record_id") -> DataFrame:
    """``file, offset, record_id, length, hash`` of distinct records."""
    raw = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    return records.select(F.col(file_col).alias("file"), F.col(offset_col).cast("long").alias("offset"),
                          F.col(id_col).alias("record_id"), F.octet_length(raw).cast("long").alias("length"),
                          F.sha2(raw, 256).alias("hash")).distinct()


def _node(order: Column, parts: Column) -> Column:
    listed = F.array_sort(F.collect_list(F.struct(order.alias("at"), parts.alias("text"))))
    return F.sha2(F.concat_ws("\n", F.transform(listed, lambda x: F.concat_ws(":", x["at"], x["text"]))), 256)


def merkle_tree(hashes: DataFrame, range_bytes: int = 1 << 16, fanout: int = 16) -> DataFrame:
    """``file, level, idx, hash``: level 0 nodes cover offsets
    [idx * range_bytes, (idx + 1) * range_bytes), a node of level k ``fanout``
    nodes of level k - 1. A node hashes its children in offset order; a group is
    bounded by the range's bytes or by the fan-out."""
    level = (hashes.groupBy("file", F.floor(F.col("offset") / F.lit(range_bytes)).alias("idx"))
             .agg(_node(F.col("offset"), F.concat_ws(":", "length", "hash")).alias("hash")))
    level = materialize(level.select("file", F.lit(0).alias("level"), "idx", "hash"), "merkle-0")
    tree, top, k = level, level.agg(F.max("idx")).first()[0], 0
    while top is not None and top > 0:
        k, top = k + 1, top // fanout
        level = materialize(
            level.groupBy("file", F.floor(F.col("idx") / F.lit(fanout)).alias("idx"))
            .agg(_node(F.col("idx"), F.col("hash")).alias("hash"))
            .select("file", F.lit(k).alias("level"), "idx", "hash"), f"merkle-{k}")
        tree = tree.unionByName(level)
    return tree


def _differing(left: DataFrame, right: DataFrame, keys: list[str], carry: list[str]) -> DataFrame:
    """Full outer comparison on null-safe keys; rows whose hashes differ or
    that one side lacks."""
    a = left.select(*[F.col(c).alias(f"l_{c}") for c in [*keys, *carry, "hash"]])
    b = right.select(*[F.col(c).alias(f"r_{c}") for c in [*keys, *carry, "hash"]])
    cond = None
    for key in keys:
        c = F.col(f"l_{key}").eqNullSafe(F.col(f"r_{key}"))
        cond = c if cond is None else cond & c
    return a.join(b, cond, "full").filter(~F.col("l_hash").eqNullSafe(F.col("r_hash")))


def audit(left: DataFrame, right: DataFrame, left_tree: DataFrame, right_tree: DataFrame,
          range_bytes: int = 1 << 16, fanout: int = 16) -> DataFrame:
    """Corrupt records between two replicas: ``file, offset, record_id, status``
    (changed, missing or extra in the right replica), both lengths (0 where absent)
    and hashes (null where absent).

    ``left`` and ``right`` are ``record_hashes``; the trees are theirs.
    Defined cases: a null payload is an empty record; rows equal in file,
    offset, id and payload are one record; a file that one replica lacks counts
    as missing or extra records; a null file is a file like any other. Empty
    tables are equal to each other. Extra columns are ignored.
    """
    depth = left_tree.agg(F.max("level")).first()[0], right_tree.agg(F.max("level")).first()[0]
    top = max([d for d in depth if d is not None], default=0)
    frontier = None
    for level in range(top, -1, -1):
        sides = []
        for tree in (left_tree, right_tree):
            nodes = tree.filter(F.col("level") == level).select("file", "idx", "hash")
            if frontier is not None:
                nodes = nodes.withColumn("up", F.floor(F.col("idx") / F.lit(fanout)))
                nodes = left_lookup(nodes, frontier.select("file", F.col("idx").alias("up")), ["file", "up"],
                                    "left_semi").drop("up")
            sides.append(nodes)
        diff = _differing(*sides, ["file", "idx"], [])
        frontier = materialize(diff.select(
            F.when(F.col("l_hash").isNotNull(), F.col("l_file")).otherwise(F.col("r_file")).alias("file"),
            F.coalesce("l_idx", "r_idx").alias("idx")), f"merkle-frontier{level}")
    sides = [left_lookup(side.withColumn("idx", F.floor(F.col("offset") / F.lit(range_bytes))), frontier,
                         ["file", "idx"], "left_semi") for side in (left, right)]
    diff = _differing(*sides, ["file", "offset"], ["record_id", "length"])
    here = F.col("l_hash").isNotNull()
    pick = lambda c: F.when(here, F.col(f"l_{c}")).otherwise(F.col(f"r_{c}")).alias(c)
    status = F.when(~here, "extra").when(F.col("r_hash").isNull(), "missing").otherwise("changed")
    return diff.select(pick("file"), pick("offset"), pick("record_id"), status.alias("status"),
                       F.coalesce("l_length", F.lit(0)).alias("left_length"),
                       F.coalesce("r_length", F.lit(0)).alias("right_length"),
                       F.col("l_hash").alias("left_sha256"), F.col("r_hash").alias("right_sha256"))


def fixity_audit(left: DataFrame, right: DataFrame, range_bytes: int = 1 << 16, fanout: int = 16) -> DataFrame:
    """Build both trees and audit the replicas (records with ``file, offset,
    record_id, payload``)."""
    return audit_hashes(*[materialize(record_hashes(x), "merkle-records") for x in (left, right)], range_bytes, fanout)


def audit_hashes(left: DataFrame, right: DataFrame, range_bytes: int = 1 << 16, fanout: int = 16) -> DataFrame:
    """Build both trees of record hashes and audit the replicas."""
    return audit(left, right, *[merkle_tree(x, range_bytes, fanout) for x in (left, right)], range_bytes, fanout)


def damage(i: Column, raw: Column) -> Column:
    """A record's bytes in a replica with planted damage, by record id: some
    records lost (null), some cut in half, some with one byte changed."""
    half = F.floor(F.octet_length(raw) / 2).cast("int")
    flipped = F.concat(F.substring(raw, F.lit(1), half), F.encode(F.lit("#"), "utf-8"),
                       F.substring(raw, half + 2, F.octet_length(raw)))
    cut = F.substring(raw, F.lit(1), half)
    return F.when(F.coalesce(i % 107 != 3, F.lit(True)), F.when(i % 103 == 5, cut).when(i % 101 == 7, flipped).otherwise(raw))


def damaged(records: DataFrame) -> DataFrame:
    """The records of a replica with planted ``damage``."""
    return records.withColumn("payload", damage(F.col("record_id"), F.col("payload"))).filter("payload IS NOT NULL")


ORACLE_SQL = """
WITH b AS (
  SELECT page_id, CAST(floor(page_id / 1000.0) AS BIGINT) AS file,
         encode('WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
           || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: '
           || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '')
           || chr(13) || chr(10) || chr(13) || chr(10)) AS p
  FROM pages),
r AS (
  SELECT *, octet_length(p) AS n, octet_length(p) // 2 AS h,
         coalesce(sum(octet_length(p)) OVER (PARTITION BY file ORDER BY page_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS offs FROM b),
x AS (
  SELECT *, page_id % 107 = 3 AS lost, hex(p) AS hx,
         CASE WHEN page_id % 103 = 5 THEN left(hex(p), 2 * h)
              WHEN page_id % 101 = 7 THEN left(hex(p), 2 * h) || '23' || substr(hex(p), 2 * h + 3)
              ELSE hex(p) END AS hy FROM r)
SELECT file, offs AS "offset", page_id AS record_id,
       CASE WHEN lost THEN 'missing' ELSE 'changed' END AS status,
       n AS left_length, CASE WHEN lost THEN 0 ELSE length(hy) // 2 END AS right_length,
       sha256(p) AS left_sha256, CASE WHEN NOT lost THEN sha256(unhex(hy)) END AS right_sha256
FROM x WHERE lost OR hx <> hy
"""
