"""Control messages (SRC-6, SM-3, SM-4, SNK-7, FN-19).

Works on a batch or a streaming DataFrame with ``data`` (base64 text of a
JSON envelope) and ``attributes`` (MAP<STRING,STRING>). Decoding is
``try_to_binary`` + ``from_json`` with a fixed schema: no inference, bodies
that are not base64 or not JSON become a quarantine route instead of failing
the query.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ENVELOPE_SCHEMA = ("message_type string, start_date string, end_date string, "
                   "processing_params struct<batch_number: int, source: string, "
                   "start_date: string, end_date: string, file_list: array<string>>")

# Known message types.
DAILY = "daily_recall"
RANGE = "range_recall"


def decode(messages: DataFrame, data: str = "data") -> DataFrame:
    """SRC-6: base64 JSON envelope -> ``msg`` struct; ``malformed`` when the
    body is not base64 JSON."""
    body = F.try_to_binary(F.col(data), F.lit("base64")).cast("string")
    parsed = F.from_json(body, ENVELOPE_SCHEMA, {"mode": "PERMISSIVE"})
    ok = F.try_parse_json(body).isNotNull()
    return messages.withColumn("msg", F.when(ok, parsed)).withColumn("malformed", ~F.coalesce(ok, F.lit(False)))


def route(decoded: DataFrame, attributes: str = "attributes") -> DataFrame:
    """SM-3 + SM-4: route by ``message_type`` with required-parameter checks.

    Dates are read from ``processing_params`` first, then the top level
    (the reference's range callbacks lose them when they sit only in one).
    ``subscription`` mirrors the attribute filter: empty start_date -> daily.
    """
    m = F.col("msg")
    pp = m.getField("processing_params")
    start = F.coalesce(F.nullif(pp.getField("start_date"), F.lit("")), F.nullif(m.getField("start_date"), F.lit("")))
    end = F.coalesce(F.nullif(pp.getField("end_date"), F.lit("")), F.nullif(m.getField("end_date"), F.lit("")))
    mtype = m.getField("message_type")
    start_ok = F.try_to_date(start, "yyyy-MM-dd").isNotNull() & start.rlike(r"^\d{4}-\d{2}-\d{2}$")
    end_ok = F.try_to_date(end, "yyyy-MM-dd").isNotNull() & end.rlike(r"^\d{4}-\d{2}-\d{2}$")
    rt = (F.when(F.col("malformed"), F.lit("quarantine"))
          .when(mtype == DAILY, F.lit("daily"))
          .when(mtype == RANGE, F.lit("range"))
          .otherwise(F.lit("error")))
    # required parameters: a non-zero batch_number always; range messages
    # also need both dates (well-formed, start not after end)
    has_batch = F.coalesce(pp.getField("batch_number") != 0, F.lit(False))
    valid = (F.when(rt == "daily", has_batch)
             .when(rt == "range", has_batch & F.coalesce(
                 start_ok & end_ok & (F.try_to_date(start, "yyyy-MM-dd") <= F.try_to_date(end, "yyyy-MM-dd")),
                 F.lit(False)))
             .otherwise(F.lit(False)))
    sub_start = F.coalesce(F.col(attributes).getItem("start_date"), F.lit(""))
    return decoded.select(
        "*", mtype.alias("message_type"), rt.alias("route"),
        pp.getField("batch_number").alias("batch_number"), start.alias("start_date"),
        end.alias("end_date"), valid.alias("valid"),
        F.when(sub_start == "", F.lit("daily")).otherwise(F.lit("range")).alias("subscription"))


def next_batch_message(batch_number: int, start: dt.date | None, end: dt.date | None,
                       source: str, topic: str) -> dict:
    """SNK-7: the next-batch control message as an outbox row."""
    import json
    params = {"batch_number": batch_number + 1, "source": source}
    if start and end:
        params.update(start_date=start.isoformat(), end_date=end.isoformat())
    body = {"message_type": RANGE if start else DAILY, "processing_params": params}
    attrs = {"start_date": start.isoformat() if start else "", "end_date": end.isoformat() if end else ""}
    return {"topic": topic, "message": json.dumps(body), "attributes": attrs}


def done_message(file_list: Sequence[str], topic: str = "anonymization") -> dict:
    """SNK-7: the done message as an outbox row: the feature zones a run
    filled, for the consumer to read. It has no run type, so no run starts
    from it."""
    import json
    return {"topic": topic, "message": json.dumps({"file_list": list(file_list)}), "attributes": {}}


def outbox_frame(spark, rows: list[dict]) -> DataFrame:
    """Control messages as rows to append to an outbox table."""
    return spark.createDataFrame(rows, "topic string, message string, attributes map<string,string>")
