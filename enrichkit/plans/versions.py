"""Compaction of zones to which newer versions of rows are appended (PL-8).

A dead-letter zone only grows: a resolved row is appended again and
``latest_versions`` picks the current one. ``compact`` writes the current rows to a
snapshot folder of their own and then appends one row to a pointer table: the
snapshot's folder and the files of the zone that went into it. ``current`` reads
the newest pointer, its snapshot, and the zone's files that are not in it.

That one row is the swap. A reader sees the state before it or behind it and
never half of one; a crash before it leaves a folder that no pointer names; rows
that are appended meanwhile are in files that the pointer does not list, so they
are read from the zone. Of two compactions at once either pointer is right by
itself. Old files and folders may be removed once no reader uses them
(``unused``); nothing here removes any.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from enrichkit.plans.retry import latest_versions

POINTER = "number bigint, folder string, files array<string>"
#: Changed keys that may be broadcast against a snapshot.
BROADCAST_KEYS = 200_000


def _read(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def pointer(spark: SparkSession, path: str) -> Row | None:
    """The newest pointer of a zone, or None before its first compaction."""
    rows = _read(spark, f"{path.rstrip('/')}_pointer", POINTER)
    return None if rows is None else rows.orderBy(F.col("number").desc(), "folder").first()


def _state(spark: SparkSession, path: str) -> tuple[Row | None, DataFrame | None, DataFrame | None]:
    """(pointer, snapshot, the zone's rows that are not in it)."""
    at, zone = pointer(spark, path), _read(spark, path)
    if at is None:
        return None, None, zone
    snapshot = spark.read.parquet(at["folder"])
    if zone is not None and at["files"]:
        zone = zone.filter(~F.col("_metadata.file_path").isin(at["files"]))
    return at, snapshot, zone


def _current(snapshot: DataFrame | None, fresh: DataFrame | None, key: str) -> DataFrame:
    if snapshot is None or fresh is None:
        return latest_versions(fresh) if snapshot is None else snapshot
    fresh = fresh.select(*snapshot.columns)
    changed = fresh.select(F.col(key).alias("_changed")).distinct()
    if changed.count() <= BROADCAST_KEYS:
        changed = F.broadcast(changed)
    on = F.col(key) == F.col("_changed")
    # what no newer version names is current as it is: it is not ranked again
    return snapshot.join(changed, on, "left_anti").unionByName(
        latest_versions(snapshot.join(changed, on, "left_semi").unionByName(fresh)))


def current(spark: SparkSession, path: str, key: str = "uuid") -> DataFrame | None:
    """The current row of every key of a zone, or None for one that is not there."""
    _, snapshot, fresh = _state(spark, path)
    return None if snapshot is None and fresh is None else _current(snapshot, fresh, key)


def compact(spark: SparkSession, path: str, key: str = "uuid", partition_by: str = "partition_date") -> str | None:
    """Write the zone's current rows as a snapshot and point to it; returns its
    folder, or None where nothing was appended since the last one."""
    return fold(spark, path, lambda snapshot, fresh: _current(snapshot, fresh, key), partition_by)


def fold(spark: SparkSession, path: str, merge: Callable[[DataFrame | None, DataFrame], DataFrame], partition_by: str,
         settled: Column | None = None) -> str | None:
    """The general form: the new snapshot is ``merge(old snapshot, new rows)``.
    Only files whose rows are all ``settled`` take part (a stream's last
    micro-batch may be written again); returns the snapshot's folder, or None."""
    at, snapshot, fresh = _state(spark, path)
    if fresh is None:
        return None
    per = fresh.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(F.coalesce(settled, F.lit(False)) if settled is not None else F.lit(True)).alias("ok"))
    files = [r["file"] for r in per.filter("ok").select("file").collect()]
    if not files:
        return None
    folder = f"{path.rstrip('/')}_snapshots/{uuid.uuid4().hex}"
    new = fresh.filter(F.col("_metadata.file_path").isin(files))
    merge(snapshot, new).write.partitionBy(partition_by).parquet(folder)
    taken = sorted({*files, *(at["files"] if at else [])})
    row = [((at["number"] if at else 0) + 1, folder, taken)]
    spark.createDataFrame(row, POINTER).coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}_pointer")
    return folder


def folded(spark: SparkSession, path: str) -> tuple[DataFrame | None, DataFrame | None]:
    """(snapshot, rows that are not in it) of a zone; None for what is not there."""
    _, snapshot, fresh = _state(spark, path)
    return snapshot, fresh


def unused(spark: SparkSession, path: str) -> list[str]:
    """Files of the zone whose rows the current snapshot holds, and snapshots
    that newer ones replaced: what may be removed once no reader uses it."""
    rows = _read(spark, f"{path.rstrip('/')}_pointer", POINTER)
    if rows is None:
        return []
    at = pointer(spark, path)
    return [*at["files"], *[r[0] for r in rows.filter(F.col("folder") != at["folder"]).select("folder").collect()]]
