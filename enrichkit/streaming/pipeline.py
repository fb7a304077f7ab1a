"""Structured Streaming jobs (SM-1, SM-2, SM-5, SM-6, SNK-1, SNK-6).

- ``run_minute_counts``: calls and writes a minute, whatever the order in which
  events arrive. Every micro-batch writes its own share of each minute it holds,
  and a minute is the sum of its shares, so an event that comes days later is
  still counted in its minute and no state is kept in memory.
  ``minute_metrics`` is the windowed form with a watermark for a live display.
- ``run_enrichment_stream``: file stream of candidates, micro-batches of
  ``max_files`` files, ``trigger(availableNow)``; the checkpoint replaces the
  reference's batch_number chain. Each micro-batch is de-duplicated, anti-joined
  against the keys already in RAW (so nothing arrives too late), looked up once,
  and written with dynamic partition overwrite keyed by ``batch_id``: a replay
  of the same batch after a failure rewrites its own partitions instead of
  appending twice. What RAW holds is told by an index of its keys in hash
  buckets, of which a micro-batch reads the buckets of its own keys.
- ``incremental_flatten_batch``: SM-6, flatten of what RAW gained, in the
  same ``foreachBatch`` style.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from enrichkit.operators.dedup import latest_per_key
from enrichkit.plans.enrich import lookup_join, split_outcomes, to_dead_letter, to_raw
from enrichkit.plans.versions import fold, folded
from enrichkit.session import cut_lineage
from enrichkit.sources.zones import write_zone

RAW_FAILED = "INSERT RAW TABLE FAILED"


_ET = "_event_time"


def with_event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need TIMESTAMP; a TIMESTAMP_NTZ column is read in the
    session time zone (UTC here), which keeps the same instants."""
    return df.withColumn(_ET, F.col(ts).cast("timestamp"))


def minute_metrics(events: DataFrame, ts: str = "ts", watermark: str = "2 minutes",
                   write_when=None, rows_written=None) -> DataFrame:
    """SM-1, live form: calls and writes per minute (UTC) in windows that close
    behind a watermark; rows later than that are dropped here and counted by
    ``run_minute_counts``. ``write_when`` marks the events that are writes;
    ``writes`` counts those operations and ``written_rows`` sums
    ``rows_written`` (rows per write, 1 by default)."""
    ntz = dict(events.dtypes).get(ts) == "timestamp_ntz"
    return (with_event_time(events, ts).withWatermark(_ET, watermark)
            .groupBy(F.window(F.col(_ET), "1 minute").alias("w"))
            .agg(*_figures(write_when, rows_written))
            .select((F.col("w.start").cast("timestamp_ntz") if ntz else F.col("w.start")).alias("minute"),
                    "calls", "writes", "written_rows"))


def _figures(write_when=None, rows_written=None) -> list:
    w = write_when if write_when is not None else F.lit(False)
    n_rows = rows_written if rows_written is not None else F.lit(1)
    return [F.count(F.lit(1)).alias("calls"), F.count_if(w).alias("writes"),
            F.sum(F.when(w, n_rows).otherwise(F.lit(0))).cast("bigint").alias("written_rows")]


def run_minute_counts(events: DataFrame, out: str, checkpoint: str, ts: str = "ts", write_when=None,
                      rows_written=None) -> None:
    """SM-1 over a stream of events in any order: each micro-batch writes its
    counts by minute under the minute's ``day`` and its own ``batch_id``. A
    replayed micro-batch overwrites its shares; an event without a time belongs
    to the null minute. Only counts are written, at most one row a minute and
    micro-batch."""
    def save(batch: DataFrame, batch_id: int) -> None:
        share = (batch.groupBy(F.date_trunc("minute", F.col(ts)).cast(batch.schema[ts].dataType).alias("minute"))
                 .agg(*_figures(write_when, rows_written))
                 .withColumn("day", F.to_date("minute")).withColumn("batch_id", F.lit(batch_id).cast("bigint")))
        write_zone(share.repartition("day"), out, ["day", "batch_id"], overwrite_partitions=True)  # a file a day

    q = (events.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_minute_counts(spark: SparkSession, out: str, days: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    """``minute, calls, writes, written_rows, batches``: every minute as the sum
    of its shares; ``batches`` tells in how many micro-batches its events came
    (more than one: the first figure was corrected later). ``days`` (first, last)
    reads only those days' folders."""
    snapshot, fresh = folded(spark, out)
    names = ["minute", "calls", "writes", "written_rows", "batches"]
    rows = None
    for part in (snapshot, None if fresh is None else fresh.withColumn("batches", F.lit(1).cast("bigint"))):
        if part is not None:
            part = part if days is None else part.filter(F.col("day").between(F.lit(days[0]), F.lit(days[1])))
            rows = part.select(*names) if rows is None else rows.unionByName(part.select(*names))
    if rows is None:
        raise FileNotFoundError(out)
    return rows.groupBy("minute").agg(*[F.sum(c).alias(c) for c in names[1:]])


def compact_minute_counts(spark: SparkSession, out: str) -> str | None:
    """Fold the shares of all but the last micro-batch into one row a minute (a
    file or two a day in place of one a micro-batch). Readers see the state
    before or behind it, the same figures either way; the last micro-batch stays
    as it is, as its replay would write it again."""
    _, fresh = folded(spark, out)
    last = None if fresh is None else fresh.agg(F.max("batch_id")).first()[0]
    if last is None:
        return None

    def merge(snapshot, new):
        rows = new.withColumn("batches", F.lit(1).cast("bigint")).drop("batch_id")
        rows = rows if snapshot is None else rows.unionByName(snapshot.select(*rows.columns))
        return rows.groupBy("minute", "day").agg(*[F.sum(c).alias(c) for c in ("calls", "writes", "written_rows", "batches")]) \
            .repartition("day")

    return fold(spark, out, merge, "day", F.col("batch_id") < last)


def run_to_parquet(stream_df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Run a streaming frame over everything available, into Parquet."""
    q = (stream_df.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint).outputMode(mode)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    """A written folder, or None where there is none yet; other errors rise."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


#: Hash buckets of the key index of a RAW zone.
KEY_BUCKETS = 64


def key_bucket(key: Column, buckets: int = KEY_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def index_path(raw_path: str) -> str:
    return f"{raw_path.rstrip('/')}_keys"


def write_key_index(rows: DataFrame, path: str, key: str, buckets: int = KEY_BUCKETS) -> None:
    """Add the keys of RAW rows (with their ``batch_id``) to the index: a folder a
    bucket, one file a bucket and micro-batch, rewritten by a replay."""
    keys = rows.select(F.col(key).cast("string").alias("key"), key_bucket(F.col(key), buckets).alias("bucket"), "batch_id")
    write_zone(keys.distinct().repartition("bucket"), path, ["bucket", "batch_id"], overwrite_partitions=True)


def landed_keys(spark: SparkSession, raw_path: str, keys: DataFrame, key: str, batch_id: int,
                buckets: int = KEY_BUCKETS) -> DataFrame | None:
    """SM-5: which of ``keys`` RAW holds from other micro-batches, or None for a
    RAW zone that holds nothing. Only the index folders of the keys' own buckets
    are read (their numbers, ``buckets`` at most, are what the driver learns). A
    RAW zone without an index gets one first."""
    path = index_path(raw_path)
    found = [part for part in folded(spark, path) if part is not None]
    if not found:
        raw = _existing(spark, raw_path)
        if raw is None:
            return None
        write_key_index(raw, path, key, buckets)
        found = [spark.read.parquet(path)]
    mine = keys.select(F.col(key).cast("string").alias("key"), key_bucket(F.col(key), buckets).alias("bucket"))
    some = [r.bucket for r in mine.select("bucket").distinct().collect() if r.bucket is not None]
    old = None
    for part in found:
        part = part.filter(F.col("bucket").isin(some) & (F.col("batch_id") != F.lit(batch_id))).select("key", "bucket")
        old = part if old is None else old.unionByName(part)
    return old.join(mine.distinct(), ["key", "bucket"], "left_semi").select("key").distinct()


def compact_key_index(spark: SparkSession, raw_path: str) -> str | None:
    """Fold the index entries of all but the last micro-batch into one sorted
    file a bucket, behind a pointer: see ``versions.fold``."""
    path = index_path(raw_path)
    _, fresh = folded(spark, path)
    last = None if fresh is None else fresh.agg(F.max("batch_id")).first()[0]
    if last is None:
        return None

    def merge(snapshot, new):
        rows = new if snapshot is None else new.unionByName(snapshot.select(*new.columns))
        return rows.groupBy("bucket", "key").agg(F.min("batch_id").alias("batch_id")).repartition("bucket") \
            .sortWithinPartitions("bucket", "key")

    return fold(spark, path, merge, "bucket", F.col("batch_id") < last)


def enrichment_batch(payloads: DataFrame, raw_path: str, dead_path: str, key: str, now: dt.datetime,
                     writer: Callable = write_zone, buckets: int = KEY_BUCKETS) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` body: exclude done keys (JN-5/SM-5), look up
    (UD-1), split (UD-2), write RAW and dead-letter rows (PRJ-4, PRJ-5) by run
    date and ``batch_id``. If the RAW write fails, every row of the batch goes
    to the dead letter with status 'INSERT RAW TABLE FAILED' (SNK-6) and the
    error is raised again, so the batch is retried from the checkpoint; the
    retry that succeeds rewrites those rows as resolved (status 200).

    Re-sent rows are one row per key. A row without a key is no copy of another
    one: each becomes a dead letter of its own. The key index is written after
    RAW; a failure between the two replays the batch, which writes both again."""
    parts = ["partition_date", "batch_id"]

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        cols = [c for c in batch.columns if c not in parts]
        mine = F.lit(batch_id).cast("bigint")
        # re-sent rows: one row per key, the same one in every replay
        keyed = batch.filter(F.col(key).isNotNull())
        todo = latest_per_key(keyed, [key], [F.col(c).asc_nulls_last() for c in batch.columns]).select(*cols)
        prior = landed_keys(spark, raw_path, todo, key, batch_id, buckets)
        if prior is not None:
            todo = todo.join(prior, F.col(key).cast("string") == F.col("key"), "left_anti")
        before = _existing(spark, dead_path)
        if before is not None:      # JN-6: what failed on this date already is not tried again on it
            tried = before.filter((F.col("partition_date") == F.lit(now.date())) & (F.col("batch_id") != mine))
            tried = tried.select(F.col(key).alias("_tried")).distinct()
            todo = todo.join(tried, F.col(key).cast("string") == F.col("_tried"), "left_anti")
        todo = todo.unionByName(batch.filter(F.col(key).isNull()).select(*cols))
        looked = lookup_join(todo, payloads, key).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            ok, bad = split_outcomes(looked)
            fields = {c: [c] for c in cols}
            letter = lambda df: to_dead_letter(df, now.date(), now, fields, payload_cols=cols) \
                .withColumn("batch_id", mine)
            raw = to_raw(ok, now.date(), now, cols).withColumn("batch_id", mine)
            try:
                writer(raw, raw_path, parts, overwrite_partitions=True)
            except Exception:
                writer(letter(looked.withColumn("status", F.lit(RAW_FAILED))), dead_path, parts,
                       overwrite_partitions=True)
                raise
            write_key_index(raw, index_path(raw_path), key, buckets)
            dead = letter(bad)
            if before is not None:
                failed = before.filter((F.col("batch_id") == mine) & (F.col("api_status") == RAW_FAILED))
                landed = ok.select(F.col(key).cast("string").alias(key)).distinct()
                resolved = failed.join(landed, key, "left_semi").withColumn("api_status", F.lit("200"))
                dead = cut_lineage(dead.unionByName(resolved.select(*dead.columns)))
            writer(dead, dead_path, parts, overwrite_partitions=True)
        finally:
            looked.unpersist()

    return process


def run_enrichment_stream(candidates_stream: DataFrame, payloads: DataFrame, raw_path: str,
                          dead_path: str, checkpoint: str, key: str, now: dt.datetime,
                          writer: Callable = write_zone, buckets: int = KEY_BUCKETS) -> None:
    """SM-2 + SM-5: one availableNow run of the enrichment stream."""
    q = (candidates_stream.writeStream
         .foreachBatch(enrichment_batch(payloads, raw_path, dead_path, key, now, writer, buckets))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def incremental_flatten_batch(flatten: Callable[[DataFrame, DataFrame | None], DataFrame],
                              target_path: str, target_key: str) -> Callable[[DataFrame, int], None]:
    """SM-6: ``foreachBatch`` body that flattens new RAW rows not yet in the
    feature table (JN-7 against what is already written). ``target_key`` names
    the column with the RAW row's own key."""

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        target = _existing(spark, target_path)
        if target is not None:      # a replay writes its own rows again
            target = target.filter(F.col("batch_id") != F.lit(batch_id)).select(
                F.col(target_key).alias("reference_number"))
        feats = flatten(batch, target)
        write_zone(feats.withColumn("batch_id", F.lit(batch_id).cast("bigint")), target_path,
                   ["batch_id"], overwrite_partitions=True)

    return process
