"""Zone table schemas (all columns nullable, as in the reference's tables).

Use with ``sources.zones.conform`` before writing: it selects these columns
by name, casts them, and fails on missing or extra columns.
"""

from __future__ import annotations

from pyspark.sql.types import (DateType, IntegerType, StringType, StructField, StructType,
                               TimestampNTZType)


def _s(*names: str) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


_TIMES = [StructField("bq_updated_time", TimestampNTZType()), StructField("partition_date", DateType())]

# Zone table columns, in the reference tables' order.
DEVICE_RAW = StructType(_s("uuid", "cuid", "reference_id", "series_number", "device_os", "raw_data") + _TIMES)

GEO_RAW = StructType(_s("uuid", "cuid", "serial_number", "contact_address", "residence_address",
                        "company_name", "contract_longitude", "contract_latitude", "raw_data") + _TIMES)

DEVICE_DEAD_LETTER = StructType(_s("uuid", "cuid", "reference_id", "series_number", "device_os",
                                   "api_payload_message", "api_status") + _TIMES)

GEO_DEAD_LETTER = StructType(
    _s("uuid", "cuid", "series_number", "contact_address", "residence_address", "tax_code", "company_name",
       "contract_longitude", "contract_latitude", "api_payload_message", "api_status")
    + [StructField("retry_count", IntegerType()), StructField("last_retry_time", TimestampNTZType())] + _TIMES)

FLOW_LOG = StructType([StructField("flow_id", StringType()), StructField("datetime", TimestampNTZType())]
                      + _s("flow_name", "task_code", "task_name", "status", "message", "severity"))

API_LOG = StructType(_s("uuid_request", "api_type", "api_name")
                     + [StructField("start_time", TimestampNTZType()), StructField("end_time", TimestampNTZType())]
                     + _s("status_code", "status_detail") + [StructField("retry", IntegerType())])


def device_features(mapping) -> StructType:
    """Android (222 columns) or iOS (92 columns) feature table."""
    from enrichkit.plans.mappings import BASE_COLUMNS
    fields = []
    for c in BASE_COLUMNS + mapping.feature_columns():
        if c == "bq_updated_time":
            fields.append(StructField(c, TimestampNTZType()))
        elif c == "partition_date":
            fields.append(StructField(c, DateType()))
        else:
            fields.append(StructField(c, StringType()))
    return StructType(fields)


def geo_features() -> StructType:
    """Geo feature table (53 columns)."""
    from enrichkit.plans.flatten import geo_feature_schema
    return geo_feature_schema(key_type="string")
