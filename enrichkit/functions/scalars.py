"""Column expressions used across the pipelines (FN-7 .. FN-19, PRJ-7, FLT-4).

Every function returns a Column built from ``pyspark.sql.functions`` only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same results.
# Retryable HTTP statuses: device service, then geo service (adds 429).
RETRYABLE_DEVICE = ["500", "502", "503", "504"]
RETRYABLE_GEO = ["429", "500", "502", "503", "504"]
# Sentinel text that means "missing" in string columns.
NULL_WORD = "null"
# 400 responses whose detail holds one of these texts are logged as WARNING.
WARNING_BODY_MARKERS = ["reference_number_invalid",
                        "Dataset with the specified reference number does not exist"]
# ---------------------------------------------------------------------------


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_failure(status: Column | str) -> Column:
    """FLT-4: NOT (status LIKE '2%' OR status = 'success'); NULL stays NULL,
    so a filter on it drops NULL statuses, as in SQL."""
    s = _c(status)
    return ~(s.like("2%") | (s == F.lit("success")))


def is_success_code(status: Column | str) -> Column:
    """UD-2: a status is a success when it starts with '2'; missing means 200."""
    return F.coalesce(_c(status).cast("string"), F.lit("200")).startswith("2")


def blank_to_null(x: Column | str) -> Column:
    """PRJ-7: NULL for NULL or whitespace-only text."""
    c = _c(x).cast("string")
    return F.when(c.isNull() | (F.trim(c) == F.lit("")), F.lit(None).cast("string")).otherwise(c)


def safe_double(x: Column | str) -> Column:
    """FN-7: SAFE_CAST(x AS FLOAT64)."""
    return _c(x).cast("string").try_cast("double")


def round_text(x: Column | str, digits: int = 4) -> Column:
    """FN-8: CAST(ROUND(x, digits) AS STRING) with whole numbers printed
    without a fraction ('10.5', '105.7663', '73'). Goes through a decimal so
    Spark never prints exponent notation; NULL where the decimal cannot hold
    the number (or it is not finite)."""
    d = F.round(_c(x), digits).try_cast(f"decimal(38,{digits})").cast("string")
    return F.regexp_replace(d, r"\.?0+$", "")


def coord_text(x: Column | str, digits: int = 4) -> Column:
    """PL-6 coordinate rule: NULL unless the text parses as a number of at
    most 180 degrees either way."""
    v = safe_double(x)
    ok = F.coalesce(F.abs(v) <= F.lit(180.0), F.lit(False))
    return F.when(ok, round_text(v, digits)).otherwise(F.lit(None).cast("string"))


def extract_or_null(text: Column | str, pattern: str, idx: int = 1) -> Column:
    """FN-9: REGEXP_EXTRACT with NULL (not '') when nothing matches."""
    return F.nullif(F.regexp_extract(_c(text), pattern, idx), F.lit(""))


# What strptime('%Y-%m-%d') accepts for each field.
_YMD = r"^(\d{4})-(1[0-2]|0[1-9]|[1-9])-(3[01]|[12]\d|0[1-9]|[1-9]| [1-9])$"


def date_valid(text: Column | str) -> Column:
    """FN-14: the text parses as '%Y-%m-%d' the way Python's strptime does
    (four-digit year >= 1, one- or two-digit month and day, a day may be
    ' 5') and names a real calendar date."""
    t = _c(text)
    y, m, d = (F.regexp_extract(t, _YMD, i) for i in (1, 2, 3))
    iso = F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(F.trim(d), 2, "0"))
    ok = t.rlike(_YMD) & (y.cast("int") >= 1) & F.try_to_date(iso, "yyyy-MM-dd").isNotNull()
    return F.coalesce(ok, F.lit(False)).alias("date_valid")


def coords_valid(lat: Column | str, lon: Column | str, strict: bool = False) -> Column:
    """FN-15: not NULL and not the word 'null' (any case). ``strict`` adds the
    numeric and range checks the documents state."""
    la, lo = _c(lat).cast("string"), _c(lon).cast("string")
    ok = (la.isNotNull() & lo.isNotNull()
          & (F.lower(la) != F.lit(NULL_WORD)) & (F.lower(lo) != F.lit(NULL_WORD)))
    if strict:
        dla, dlo = safe_double(la), safe_double(lo)
        ok = ok & dla.between(-90.0, 90.0) & dlo.between(-180.0, 180.0)
    return F.coalesce(ok, F.lit(False))


def severity(status: Column | str, body: Column | str, markers: list[str] | None = None) -> Column:
    """FN-17: status '400' whose detail contains a marker text (case as
    written) -> WARNING; any status text starting with '4' or '5' -> ERROR;
    else Info. The device rule by default; the geo rule has no markers (``[]``)."""
    s = _c(status).cast("string")
    b = F.coalesce(_c(body).cast("string"), F.lit(""))
    marker = F.lit(False)
    for m in WARNING_BODY_MARKERS if markers is None else markers:
        marker = marker | b.contains(m)
    return (F.when((s == F.lit("400")) & marker, F.lit("WARNING"))
            .when(s.startswith("4") | s.startswith("5"), F.lit("ERROR"))
            .otherwise(F.lit("Info")))


def is_retryable(status: Column | str, codes: list[str] = RETRYABLE_GEO) -> Column:
    """FN-18."""
    return F.coalesce(_c(status).cast("string").isin(codes), F.lit(False))


def duration_ms(start: Column | str, end: Column | str) -> Column:
    return F.timestamp_diff("MILLISECOND", _c(start), _c(end))


def flow_id(flow_name: Column | str, run_id: Column | str) -> Column:
    """FN-13: flow_id = flow_name + '_' + uuid."""
    return F.concat_ws("_", _c(flow_name), _c(run_id))


def split_code_name(text: Column | str) -> tuple[Column, Column]:
    """FN-13: 'E05_name_part' -> ('E05', 'name_part'), split at the first '_'."""
    t = _c(text)
    parts = F.split(t, "_", 2)
    return parts.getItem(0), F.try_element_at(parts, F.lit(2))


def _variant_kind(node: Column) -> Column:
    return F.schema_of_variant(node)


def _is_numeric_kind(kind: Column) -> Column:
    return (kind.isin("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE")
            | kind.startswith("DECIMAL"))


def _py_truthy(node: Column) -> Column:
    """Python truthiness of a JSON value: NULL/missing, false, 0, '', {} and
    [] are falsy."""
    kind = _variant_kind(node)
    return (F.when(node.isNull() | (kind == "VOID"), F.lit(False))
            .when(kind == "BOOLEAN", F.try_variant_get(node, "$", "boolean"))
            .when(_is_numeric_kind(kind), F.try_variant_get(node, "$", "double") != 0)
            .when(kind == "STRING", F.try_variant_get(node, "$", "string") != "")
            .when(kind.startswith("OBJECT"), kind != "OBJECT<>")
            .when(kind.startswith("ARRAY"), F.size(F.try_variant_get(node, "$", "array<variant>")) > 0)
            .otherwise(F.lit(True)))


def _py_int(node: Column) -> Column:
    """Python ``int(x)`` of a JSON value, NULL where it raises: numbers are
    truncated, integer text is parsed (decimal text is not), booleans give
    1 / 0, objects and arrays fail."""
    kind = _variant_kind(node)
    return (F.when(node.isNull() | (kind == "VOID"), F.lit(None).cast("bigint"))
            .when(kind == "BOOLEAN", F.try_variant_get(node, "$", "boolean").cast("bigint"))
            .when(_is_numeric_kind(kind), F.try_variant_get(node, "$", "double").try_cast("bigint"))
            .when(kind == "STRING", F.try_variant_get(node, "$", "string").try_cast("bigint"))
            .otherwise(F.lit(None).cast("bigint")))


def count_normalise(resp: Column | str) -> Column:
    """FN-16: lookup response (VARIANT) -> count text.

    ``count`` when the key is present (even if null); otherwise the first
    ``insights[]`` item named INSIGHT_COUNT or count, its ``count`` or, when
    that is falsy, its ``value``; then ``int()`` of it, and '0' when that is
    missing or fails."""
    from enrichkit.functions.json import json_array, json_value

    v = _c(resp)
    items = F.filter(json_array(v, "$.insights"),
                     lambda x: json_value(x, "$.name").isin("INSIGHT_COUNT", "count"))
    first = F.try_element_at(items, F.lit(1))
    first_count = F.try_variant_get(first, "$.count", "variant")
    item_val = F.when(_py_truthy(first_count), first_count).otherwise(
        F.try_variant_get(first, "$.value", "variant"))
    top = F.try_variant_get(v, "$.count", "variant")
    raw = F.when(top.isNotNull(), top).otherwise(item_val)
    return F.coalesce(_py_int(raw), F.lit(0)).cast("string")
