"""Enrichment (UD-1 .. UD-3, AG-7, AG-8, PRJ-4, PRJ-5, SNK-4, PL-9, PL-10).

The reference calls an external service per record in a Python loop. Here
the lookup is data: by default a join to a payload table (status 200, or 404
when missing); a caller with a real service plugs a ``resolver`` into
``lookup_with_resolver`` (``mapInPandas``: Arrow batches, one call per
batch, exceptions become rows). Outcomes are split into RAW and dead-letter
frames with filters; nothing is collected.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from enrichkit.functions.scalars import coords_valid, is_success_code
from enrichkit.operators.radius import poi_counts_wide
from enrichkit.session import cut_lineage
from enrichkit.spec import ntz

# ---------------------------------------------------------------------------
# POI scenarios and the place types each one counts, and the
# search radius, as the reference configures them.
SCENARIOS: dict[str, list[str]] = {
    "corporate_finance": ["corporate_office", "bank", "atm"],
    "residential": ["apartment_building", "apartment_complex", "condominium_complex",
                    "housing_complex"],
    "commercial": ["restaurant", "store", "clothing_store", "shopping_mall", "furniture_store",
                   "supermarket", "car_repair", "car_dealer", "electronics_store",
                   "convenience_store", "jewelry_store", "library", "school", "university",
                   "post_office", "local_government_office"],
}
RADIUS_M = 700.0
NULL_COUNT = "null"
# ---------------------------------------------------------------------------

LOOKUP_SCHEMA = "key string, payload string, status string, error string, retry int"


#: Outcome of a record without a reference: it is never looked up.
NO_REFERENCE = ("400", "reference_number_invalid: the record has no reference")


def lookup_join(candidates: DataFrame, payloads: DataFrame, key: str,
                payload_key: str = "key", payload_col: str = "payload",
                latest_by: str | None = None) -> DataFrame:
    """UD-1 default: LEFT join to a payload table; found -> '200', else '404',
    and a validation failure for a record without a key. A key with several
    payloads gives one, the newest by ``latest_by`` (else the greatest text)."""
    payload = F.col(payload_col)
    pick = F.max(F.struct(F.col(latest_by).alias("t"), payload.alias("p")))["p"] if latest_by else F.max(payload)
    p = (payloads.filter(F.col(payload_key).isNotNull()).groupBy(F.col(payload_key).alias("_pk"))
         .agg(pick.alias("payload")))
    j = candidates.join(p, candidates[key] == p["_pk"], "left").drop("_pk")
    none, found = F.col(key).isNull(), F.col("payload").isNotNull()
    return (j.withColumn("status", F.when(none, F.lit(NO_REFERENCE[0])).when(found, F.lit("200"))
                         .otherwise(F.lit("404")))
            .withColumn("error", F.when(none, F.lit(NO_REFERENCE[1])).when(~found, F.lit("not found")))
            .withColumn("retry", F.lit(0)))


def lookup_with_resolver(candidates: DataFrame, key: str,
                         resolver: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """UD-1 hook: ``resolver(batch)`` runs on Arrow batches inside the tasks
    and returns, row-aligned with ``batch``, the columns payload, status,
    error, retry. They are appended to the candidate columns in the task (no
    join back). When a batch fails its halves are tried, down to single
    records: only records that fail alone become error rows (status 'ERROR',
    the whole error text). A record without a key is a validation failure and
    never reaches the resolver."""
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType

    out_schema = StructType(list(candidates.schema.fields) + [
        StructField("payload", StringType()), StructField("status", StringType()),
        StructField("error", StringType()), StructField("retry", IntegerType())])

    def resolve(pdf: pd.DataFrame) -> pd.DataFrame:
        try:
            res = resolver(pdf).reset_index(drop=True)
            if len(res) != len(pdf):
                raise ValueError("resolver must return one row per input row")
            return res[["payload", "status", "error", "retry"]].astype({"payload": object, "error": object})
        except Exception as exc:  # one bad record must not lose the others
            if len(pdf) == 1:
                return pd.DataFrame({"payload": [None], "status": ["ERROR"], "error": [str(exc)], "retry": [0]},
                                    dtype=object)
            half = len(pdf) // 2
            return pd.concat([resolve(pdf.iloc[:half].reset_index(drop=True)),
                              resolve(pdf.iloc[half:].reset_index(drop=True))], ignore_index=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf.reset_index(drop=True)
            known = pdf[key].notna()
            res = pd.DataFrame({"payload": [None] * len(pdf), "status": NO_REFERENCE[0],
                                "error": NO_REFERENCE[1], "retry": 0}, dtype=object)
            if known.any():
                got = resolve(pdf[known].reset_index(drop=True))
                for c in res.columns:
                    res.loc[known.to_numpy(), c] = got[c].to_numpy(dtype=object)
            out = pdf.copy()
            for c in ("payload", "status", "error"):
                out[c] = res[c].astype(object).where(res[c].notna(), None)
            out["retry"] = pd.to_numeric(res["retry"]).fillna(0).astype("int32")
            yield out

    return candidates.mapInPandas(run, out_schema)


def split_outcomes(looked_up: DataFrame) -> tuple[DataFrame, DataFrame]:
    """UD-2: success (status 2xx or missing) vs failure."""
    ok = is_success_code("status")
    return looked_up.filter(ok), looked_up.filter(~ok)


def to_raw(df: DataFrame, spec_as_of: dt.date, now: dt.datetime, columns: Sequence,
           payload_col: str = "payload") -> DataFrame:
    """PRJ-4: RAW row = uuid, record keys, payload JSON text, update time, date.
    ``columns`` are names or Column expressions (e.g. a rename to the RAW
    table's ``series_number``)."""
    return df.select(F.expr("uuid()").alias("uuid"), *columns,
                     F.col(payload_col).alias("raw_data"),
                     ntz(now).alias("bq_updated_time"), F.lit(spec_as_of).alias("partition_date"))


def to_dead_letter(df: DataFrame, spec_as_of: dt.date, now: dt.datetime,
                   fields: Mapping[str, Sequence[str]], status_col: str = "status",
                   payload_cols: Sequence[str] | None = None) -> DataFrame:
    """PRJ-5: dead-letter row. ``fields`` maps each output column to source
    columns tried in order with Python ``a or b`` semantics (NULL and '' both
    fall through); the whole record is kept as JSON."""
    def first_truthy(srcs):
        return F.coalesce(*[F.nullif(F.col(s).cast("string"), F.lit("")) for s in srcs])

    rec = payload_cols or df.columns
    return df.select(F.expr("uuid()").alias("uuid"),
                     *[first_truthy(srcs).alias(out) for out, srcs in fields.items()],
                     F.to_json(F.struct(*rec)).alias("api_payload_message"),
                     F.col(status_col).cast("string").alias("api_status"),
                     ntz(now).alias("bq_updated_time"), F.lit(spec_as_of).alias("partition_date"))


ROUTES = ("android", "ios")


def route_by_device(raw: DataFrame, col: str = "device_os") -> DataFrame:
    """SNK-4: a ``route`` column (android, ios or unrouted) by lower(device_os).
    One pass: write the frame partitioned by ``route`` and read a route's folder."""
    d = F.lower(F.col(col))
    return raw.withColumn("route", F.when(d.isin(*ROUTES), d).otherwise(F.lit("unrouted")))


# ---------------------------------------------------------------- geo (PL-9)

GEO_KEYS = ("cuid", "serial_number")


def geo_outcomes(candidates: DataFrame, places: DataFrame, failures: DataFrame | None = None,
                 keys: Sequence[str] = GEO_KEYS, scenarios: Mapping[str, Sequence[str]] = SCENARIOS,
                 radius_m: float = RADIUS_M) -> DataFrame:
    """JN-11 + JN-12 + FN-15 + AG-7/8 in one pass: the candidate rows with an
    array ``outcomes`` of (scenario, status, ok, count_text) in configuration
    order. ``failures`` (keys, scenario, status) are lookup errors from the
    service hook, several of one scenario count once; they are pivoted to one
    row a record before the join. Invalid coordinates give 'null' counts, no
    error."""
    valid = coords_valid("latitude", "longitude")
    number = lambda c: F.when(valid, F.col(c).cast("string").try_cast("double"))
    out = poi_counts_wide(candidates.withColumn("_plat0", number("latitude")).withColumn("_plon0", number("longitude")),
                          places, scenarios, radius_m, lat="_plat0", lon="_plon0")
    names = list(scenarios)
    if failures is not None:
        bad = F.when(~F.col("status").startswith("2"), F.col("status"))
        f = failures.groupBy(*[F.col(k).alias(f"_f_{k}") for k in keys]).agg(
            *[F.max(F.when(F.col("scenario") == s, bad)).alias(f"_s{i}") for i, s in enumerate(names)])
        cond = None
        for k in keys:
            c = F.col(k).eqNullSafe(F.col(f"_f_{k}"))
            cond = c if cond is None else cond & c
        out = out.join(f, cond, "left").drop(*[f"_f_{k}" for k in keys])
    else:
        out = out.select("*", *[F.lit(None).cast("string").alias(f"_s{i}") for i in range(len(names))])
    each = []
    for i, s in enumerate(names):
        ok = F.col(f"_s{i}").isNull()
        text = F.when(ok & F.col(f"_n{i}").isNotNull(), F.col(f"_n{i}").cast("string")).otherwise(F.lit(NULL_COUNT))
        each.append(F.struct(F.lit(s).alias("scenario"), F.coalesce(F.col(f"_s{i}"), F.lit("200")).alias("status"),
                             ok.alias("ok"), text.alias("count_text")))
    return out.select(*[F.col(f"`{c}`") for c in candidates.columns], F.array(*each).alias("outcomes"))


def geo_lookup(candidates: DataFrame, places: DataFrame, failures: DataFrame | None = None,
               keys: Sequence[str] = GEO_KEYS) -> DataFrame:
    """``geo_outcomes`` as one row per (record, scenario)."""
    wide = geo_outcomes(candidates, places, failures, keys)
    return wide.select(*keys, F.explode("outcomes").alias("_o")).select(*keys, "_o.*")


def scenario_gate(per_scenario: DataFrame, keys: Sequence[str] = GEO_KEYS,
                  scenario_order: Sequence[str] = tuple(SCENARIOS)) -> DataFrame:
    """AG-8 + AG-7: one row per record: ``all_ok`` and the
    ``{"scenario_counts": {...}}`` JSON (scenarios in configuration order,
    failed scenarios as 'null')."""
    agg = per_scenario.groupBy(*keys).agg(
        F.bool_and("ok").alias("all_ok"),
        F.count_if(~F.col("ok")).alias("failed_scenarios"),
        *[F.max(F.when(F.col("scenario") == s, F.col("count_text"))).alias(f"_c_{s}")
          for s in scenario_order])
    counts = F.struct(*[F.col(f"_c_{s}").alias(s) for s in scenario_order])
    return (agg.withColumn("raw_data", F.to_json(F.struct(counts.alias("scenario_counts"))))
            .drop(*[f"_c_{s}" for s in scenario_order]))


def scenario_summary(per_scenario: DataFrame, keys: Sequence[str] = GEO_KEYS) -> DataFrame:
    """UD-3: successes per record, sorted error list, failed only if all failed."""
    return (per_scenario.groupBy(*keys)
            .agg(F.count_if("ok").alias("successful"),
                 F.count(F.lit(1)).alias("total"),
                 F.array_join(F.sort_array(F.collect_list(
                     F.when(~F.col("ok"), F.concat_ws(":", "scenario", "status")))), ",").alias("errors"))
            .withColumn("failed", F.col("successful") == 0))


GEO_RAW_FIELDS = {"cuid": "cuid", "serial_number": "serial_number",
                  "contact_address": "current_detailed_address",
                  "residence_address": "permanent_detailed_address",
                  "company_name": "company_name", "contract_longitude": "longitude",
                  "contract_latitude": "latitude"}


def geo_split(outcomes: DataFrame, as_of: dt.date, now: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """RAW and dead-letter rows of ``geo_outcomes`` rows: a record reaches RAW
    only if every scenario succeeded; each failed scenario makes its own
    dead-letter row with the whole record."""
    record = [c for c in outcomes.columns if c != "outcomes"]
    counts = F.to_json(F.struct(F.struct(*[
        F.get("outcomes", F.lit(i))["count_text"].alias(s) for i, s in enumerate(SCENARIOS)]).alias("scenario_counts")))
    raw = outcomes.filter(F.forall("outcomes", lambda o: o["ok"])).select(
        F.expr("uuid()").alias("uuid"), *[F.col(src).alias(out) for out, src in GEO_RAW_FIELDS.items()],
        counts.alias("raw_data"), ntz(now).alias("bq_updated_time"), F.lit(as_of).alias("partition_date"))
    bad = outcomes.select(*record, F.explode(F.filter("outcomes", lambda o: ~o["ok"])).alias("_o"))
    dead = bad.select(F.expr("uuid()").alias("uuid"), "cuid",
                      F.col("serial_number").alias("series_number"),
                      F.col("current_detailed_address").alias("contact_address"),
                      F.col("permanent_detailed_address").alias("residence_address"),
                      "tax_code", "company_name",
                      F.col("longitude").alias("contract_longitude"),
                      F.col("latitude").alias("contract_latitude"),
                      F.to_json(F.struct(*record, F.col("_o.scenario").alias("scenario"))).alias("api_payload_message"),
                      F.col("_o.status").alias("api_status"),
                      F.lit(None).cast("int").alias("retry_count"),
                      F.lit(None).cast("timestamp_ntz").alias("last_retry_time"),
                      ntz(now).alias("bq_updated_time"), F.lit(as_of).alias("partition_date"))
    return raw, dead


def geo_enrich(candidates: DataFrame, places: DataFrame, as_of: dt.date, now: dt.datetime,
               failures: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """PL-9: candidates -> (RAW rows, dead-letter rows). The outcomes are
    written once (reliable checkpoint), both results are filters over them."""
    return geo_split(cut_lineage(geo_outcomes(candidates, places, failures)), as_of, now)
