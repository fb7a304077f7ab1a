"""Sources and sinks (SRC-1 .. SRC-5, SNK-1 .. SNK-8).

Zones are Parquet folders partitioned by ``partition_date`` (RAW, dead
letter, features, logs) and a JSON landing folder. Writes append, or
overwrite only the partitions a batch touches (dynamic partition overwrite),
so a re-run of the same batch replaces its own rows instead of duplicating
them.
"""

from __future__ import annotations

import datetime as dt
import importlib.resources
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from enrichkit.functions.scalars import duration_ms, severity

_DATE_RE = re.compile(r"^\d{4}-\d{2}-\d{2}$")


# ------------------------------------------------------------------ sources
def read_zone(spark: SparkSession, root: str, name: str, schema: StructType | None = None) -> DataFrame:
    """SRC-1: a named, date-partitioned table; filters on ``partition_date``
    prune folders."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(f"{root.rstrip('/')}/{name}")


def read_zone_or_none(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A zone that may not exist yet: None when its folder is missing or holds
    no file. Every other error (access, broken files) rises."""
    try:
        return read_zone(spark, root, name)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_landing(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """SRC-4: landed JSON documents with a declared schema (no inference)."""
    return spark.read.schema(schema).json(path)


def param_literal(value) -> Column:
    """SRC-2 type binding: date and 'YYYY-MM-DD' text -> DATE; bool is tested
    before int (the reference tests int first and sends BOOL as INT64);
    datetime -> TIMESTAMP_NTZ (no time zone takes part); int -> INT or BIGINT by
    size; None -> NULL (Spark binds only literals, and its NULL literal is
    untyped and takes its type from use)."""
    if value is None:
        return F.lit(None)
    if isinstance(value, bool):
        return F.lit(value)
    if isinstance(value, dt.datetime):
        return F.expr(f"TIMESTAMP_NTZ '{value.isoformat(sep=' ')}'")   # parsed to a literal
    if isinstance(value, dt.date):
        return F.lit(value)
    if isinstance(value, str) and _DATE_RE.match(value):
        try:
            return F.lit(dt.date.fromisoformat(value))
        except ValueError:
            return F.lit(value)
    if isinstance(value, (int, float)):
        return F.lit(value)
    return F.lit(str(value))


def run_sql(spark: SparkSession, text: str, params: Mapping[str, object] | None = None) -> DataFrame:
    """SRC-2: parameterised SQL; values are bound, never spliced into text."""
    args = {k: param_literal(v) for k, v in (params or {}).items()}
    return spark.sql(text, args=args) if args else spark.sql(text)


def sql_text(name: str) -> str:
    return importlib.resources.files("enrichkit.sql").joinpath(name).read_text(encoding="utf-8")


def run_sql_file(spark: SparkSession, name: str, params: Mapping[str, object] | None = None,
                 views: Mapping[str, DataFrame] | None = None, as_of: dt.date | None = None) -> DataFrame:
    """SRC-3: packaged SQL job. ``views`` are registered as temp views first;
    ``partition_date`` defaults to ``as_of`` (explicit, never the clock)."""
    for n, df in (views or {}).items():
        df.createOrReplaceTempView(n)
    p = dict(params or {})
    if "partition_date" not in p and as_of is not None:
        p["partition_date"] = as_of
    return run_sql(spark, sql_text(name), p)


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """SRC-5: literal rows as a source (with a declared schema)."""
    return spark.createDataFrame(list(rows), schema)


# ------------------------------------------------------------------ sinks
def conform(df: DataFrame, target: StructType, pad_missing: bool = False) -> DataFrame:
    """SNK-2 / PRJ-3: select the target columns by name and cast them. Missing
    columns fail (or become typed NULLs with ``pad_missing``); extra columns
    fail, like an INSERT with an explicit column list."""
    have = {c.lower(): c for c in df.columns}
    want = [f.name.lower() for f in target.fields]
    extra = sorted(set(have) - set(want))
    if extra:
        raise ValueError(f"columns not in target: {extra}")
    cols = []
    for f in target.fields:
        src = have.get(f.name.lower())
        if src is None:
            if not pad_missing:
                raise ValueError(f"missing column {f.name}")
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.col(src).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def write_zone(df: DataFrame, path: str, partition_by: Sequence[str] = ("partition_date",),
               overwrite_partitions: bool = False) -> None:
    """SNK-1 / SNK-5 / SNK-8: append, or replace just the partitions present
    in ``df`` (idempotent re-runs of a batch)."""
    w = df.write.partitionBy(*partition_by)
    if overwrite_partitions:
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = w.mode("append")
    w.parquet(path)


def land_json(df: DataFrame, path: str, partition_by: Sequence[str] = ("partition_date", "device_os"),
              name_prefix: str = "", key: str = "reference_id", kind: str | None = "device_os"
              ) -> tuple[DataFrame, DataFrame]:
    """SNK-3: JSON landing zone, partitioned by date (and device). The
    per-record logical name ``{prefix}{date}_{kind}_{key}.json`` is kept as the
    ``landing_name`` column instead of one file per record. Returns the landed
    rows and the rows without a key, which cannot be named."""
    part = [F.lower(F.coalesce(F.col(kind), F.lit("unknown")))] if kind else []
    name = F.concat(F.lit(name_prefix), F.concat_ws("_", F.col("partition_date").cast("string"), *part,
                                                    F.col(key).cast("string")), F.lit(".json"))
    named = df.filter(F.col(key).isNotNull()).withColumn("landing_name", name)
    named.write.mode("append").partitionBy(*partition_by).json(path)
    return named, df.filter(F.col(key).isNull())


def landing_report(named: DataFrame, key: str = "reference_id") -> DataFrame:
    """SNK-3 report: total / uploaded / failed documents of a landing write.
    A document without a key cannot be named and counts as failed (the rest
    are written; one bad record does not stop the batch)."""
    ok = F.col(key).isNotNull()
    return named.agg(F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("uploaded"),
                     F.count_if(~ok).alias("failed"))


def flow_log_rows(spark: SparkSession, flow_name: str, run_id: str, entries: Sequence[tuple],
                  at: dt.datetime) -> DataFrame:
    """SNK-8: flow-log rows (task code, task name, status, message)."""
    rows = [(f"{flow_name}_{run_id}", at, flow_name, f"{flow_name}{code}", name, status, msg,
             "ERROR" if status == "FAILED" else "Info") for code, name, status, msg in entries]
    return spark.createDataFrame(rows, "flow_id string, datetime timestamp_ntz, flow_name string, "
                                       "task_code string, task_name string, status string, "
                                       "message string, severity string")


def api_log_rows(looked_up: DataFrame, api_type: str, api_name: str, key: str, started: Column, ended: Column,
                 markers: list[str] | None = None) -> DataFrame:
    """SNK-8: one API-log row per lookup, skipped ones (no status) included:
    request id, type, name, times, duration, status, severity, retries."""
    status = F.col("status").cast("string")
    return looked_up.select(
        F.concat_ws("-", F.lit(api_name), F.col(key).cast("string")).alias("uuid_request"),
        F.lit(api_type).alias("api_type"), F.lit(api_name).alias("api_name"),
        started.alias("start_time"), ended.alias("end_time"),
        duration_ms(started, ended).alias("duration_ms"),
        F.coalesce(status, F.lit("skipped")).alias("status_code"), F.col("error").alias("status_detail"),
        severity("status", "error", markers).alias("severity"), F.coalesce(F.col("retry"), F.lit(0)).alias("retry"))
