"""Message log as a stream source and sink (SRC-6, SNK-7, SM-2).

An outbox is a shared folder: ``data`` holds Parquet files of records, ``log``
one small JSON entry a commit, which names the files and says how many records
they add. The entries in order number all records, so a position in the stream is
one number: a query that restarts goes on at the record behind the last one it
finished, whatever the sizes of the files, and a micro-batch can be bounded by
records.

- writing: ``df.write.format("outbox").mode("append").save(path)``, or
  ``df.writeStream.format("outbox")`` with an option ``writer``: a replayed
  micro-batch of the same writer adds nothing. Files become visible with their
  entry; a failed job leaves files that no entry names.
- reading: ``spark.readStream.format("outbox").load(path)`` gives the records with
  their number (``record``); ``until`` bounds the position.
- ``consume`` runs micro-batches of at most ``max_records`` until the log is read.

Messages are ``MESSAGE`` records; any other schema works the same way.
"""

from __future__ import annotations

import json
import os
import sys
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter,
                                    DataSourceStreamReader, InputPartition, WriterCommitMessage)

MESSAGE = "record long, message_id long, data string, attributes map<string,string>"

# Tasks run this module's code from its pickled text: they need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _at(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else os.path.abspath(path))


def log_entries(path: str, known: list[dict] | None = None) -> list[dict]:
    """The commits in order, each with the number of its ``first`` record.
    ``known`` are those read before: an entry never changes."""
    fs, root = _at(path)
    out = list(known or [])
    found = fs.get_file_info(pa.fs.FileSelector(f"{root}/log", allow_not_found=True))
    names = sorted(f.base_name for f in found if f.base_name.endswith(".json") and not f.base_name.startswith((".", "_")))
    total = out[-1]["first"] + out[-1]["rows"] if out else 0
    for name in names[len(out):]:
        with fs.open_input_stream(f"{root}/log/{name}") as f:
            entry = json.loads(f.read())
        entry["rows"] = sum(n for _, n in entry["files"])
        entry["first"] = total
        total += entry["rows"]
        out.append(entry)
    return out


def outbox_size(path: str) -> int:
    entries = log_entries(path)
    return entries[-1]["first"] + entries[-1]["rows"] if entries else 0


def publish(path: str, files: list[tuple[str, int]], writer: str | None = None, batch: int | None = None) -> None:
    """Add a commit. A local or mounted folder creates the next entry only if
    nobody else did (two writers cannot take one number); an object store has one
    writer at a time. A batch that a writer has committed already adds nothing."""
    fs, root = _at(path)
    body = json.dumps({"files": files, "writer": writer, "batch": batch}).encode()
    fs.create_dir(f"{root}/log", recursive=True)
    while True:
        entries = log_entries(path)
        if writer is not None and any(e["writer"] == writer and e["batch"] == batch for e in entries):
            return
        name = f"{root}/log/{len(entries):020d}.json"
        if not isinstance(fs, pa.fs.LocalFileSystem):
            with fs.open_output_stream(name) as f:
                f.write(body)
            return
        draft = f"{root}/log/.{uuid.uuid4().hex}"
        with open(draft, "wb") as f:
            f.write(body)
        try:
            os.link(draft, name)
            return
        except FileExistsError:
            continue
        finally:
            os.unlink(draft)


def write_file(path: str, batches: Iterator[pa.RecordBatch]) -> list[tuple[str, int]]:
    """One task's records as one file (none for no records)."""
    fs, root = _at(path)
    name, rows, out = f"{uuid.uuid4().hex}.parquet", 0, None
    for b in batches:
        if out is None and b.num_rows:
            fs.create_dir(f"{root}/data", recursive=True)
            out = pa.parquet.ParquetWriter(f"{root}/data/{name}", b.schema, filesystem=fs)
        if b.num_rows:
            out.write_batch(b)
            rows += b.num_rows
    if out is None:
        return []
    out.close()
    return [(name, rows)]


@dataclass
class Written(WriterCommitMessage):
    files: list


@dataclass
class Part(InputPartition):
    name: str
    skip: int
    take: int
    first: int


def parts(entries: list[dict], start: int, end: int) -> list[Part]:
    """The file ranges that hold records ``start`` to ``end`` (exclusive)."""
    out = []
    for e in entries:
        at = e["first"]
        if at + e["rows"] <= start or at >= end:
            continue
        for name, rows in e["files"]:
            lo, hi = max(start, at), min(end, at + rows)
            if lo < hi:
                out.append(Part(name, lo - at, hi - lo, lo))
            at += rows
    return out


def read_part(path: str, part: Part, names: list[str]) -> Iterator[pa.RecordBatch]:
    fs, root = _at(path)
    skip, take, record = part.skip, part.take, part.first
    with pa.parquet.ParquetFile(f"{root}/data/{part.name}", filesystem=fs) as f:
        have = [c for c in names if c != "record"]
        for b in f.iter_batches(columns=have):
            if skip >= b.num_rows:
                skip -= b.num_rows
                continue
            b = b.slice(skip, take)
            skip = 0
            cols = {c: b.column(c) for c in have} | {"record": pa.array(range(record, record + b.num_rows), pa.int64())}
            yield pa.record_batch([cols[c] for c in names], names=names)
            record += b.num_rows
            take -= b.num_rows
            if take <= 0:
                return


class _Reader(DataSourceReader):
    def __init__(self, path: str, names: list[str]):
        self.path, self.names = path, names

    def partitions(self) -> list[Part]:
        entries = log_entries(self.path)
        return parts(entries, 0, entries[-1]["first"] + entries[-1]["rows"]) if entries else []

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        if partition is not None:
            yield from read_part(self.path, partition, self.names)


class _Stream(DataSourceStreamReader):
    def __init__(self, path: str, names: list[str], start: int, until: int | None):
        self.path, self.names, self.start, self.until = path, names, start, until
        self.entries: list[dict] = []

    def initialOffset(self) -> dict:
        return {"record": self.start}

    def latestOffset(self) -> dict:
        self.entries = log_entries(self.path, self.entries)
        total = self.entries[-1]["first"] + self.entries[-1]["rows"] if self.entries else 0
        return {"record": total if self.until is None else min(total, self.until)}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        self.entries = log_entries(self.path, self.entries)
        return parts(self.entries, start["record"], end["record"])

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        yield from read_part(self.path, partition, self.names)


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return Written(write_file(self.path, iterator))

    def commit(self, messages: list) -> None:
        publish(self.path, [f for m in messages if m is not None for f in m.files])


class _StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str, writer: str):
        self.path, self.writer = path, writer

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return Written(write_file(self.path, iterator))

    def commit(self, messages: list, batchId: int) -> None:
        publish(self.path, [f for m in messages if m is not None for f in m.files], self.writer, batchId)


class OutboxSource(DataSource):
    """The ``outbox`` format; options ``path``, ``start`` and ``until`` (record
    numbers), ``writer`` (the name of a writing stream)."""

    @classmethod
    def name(cls) -> str:
        return "outbox"

    def schema(self) -> str:
        return MESSAGE

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], schema.names)

    def streamReader(self, schema) -> DataSourceStreamReader:
        until = self.options.get("until")
        return _Stream(self.options["path"], schema.names, int(self.options.get("start", 0)), None if until is None else int(until))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("an outbox is only appended to")
        return _Writer(self.options["path"])

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamArrowWriter:
        return _StreamWriter(self.options["path"], self.options.get("writer", "stream"))


def register(spark: SparkSession) -> None:
    """Make the format known; sessions of one application share it."""
    try:
        spark.dataSource.register(OutboxSource)
    except AnalysisException as e:
        if e.getCondition() != "DATA_SOURCE_ALREADY_EXISTS":
            raise


def append(df: DataFrame, path: str) -> None:
    """Add the rows of a batch frame as records, one commit."""
    register(df.sparkSession)
    df.write.format("outbox").mode("append").save(path)


def consume(spark: SparkSession, path: str, process: Callable[[DataFrame, int], None], state: str, max_records: int,
            schema: str = MESSAGE, max_batches: int | None = None) -> int:
    """SM-2 by records: run ``process(batch, batch_id)`` on micro-batches of at
    most ``max_records`` records until the log is read; returns how many ran.
    ``state`` holds the stream's checkpoint and, written behind each batch, how
    far it came. A batch that failed half way is run again with the same records
    and the same ``batch_id``, so a ``process`` that overwrites its own output
    neither loses nor doubles any."""
    register(spark)
    cursor_path = f"{state.rstrip('/')}/cursor"

    def body(batch: DataFrame, batch_id: int) -> None:
        process(batch, batch_id)
        batch.agg((F.max("record") + 1).alias("upto"), F.lit(batch_id).cast("bigint").alias("batch_id")) \
            .write.mode("append").json(cursor_path)

    done = 0
    while max_batches is None or done < max_batches:
        at = _cursor(spark, cursor_path)
        if at >= outbox_size(path):
            break
        stream = spark.readStream.format("outbox").schema(schema).option("until", at + max_records).load(path)
        q = (stream.writeStream.foreachBatch(body).option("checkpointLocation", f"{state.rstrip('/')}/checkpoint")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        done += 1
    return done


def _cursor(spark: SparkSession, path: str) -> int:
    try:
        row = spark.read.schema("upto long").json(path).agg(F.max("upto")).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    return row[0] or 0
