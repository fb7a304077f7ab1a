"""DuckDB oracle SQL for every registered query.

Written by another route than the Spark code: plain SQL over the driver's
pre-registered views (QUALIFY, NOT EXISTS, brute-force joins), sharing only
the analogy definitions below (the same table shapes as
``enrichkit.sources.testdata``).
"""

from __future__ import annotations

AS_OF = "DATE '2024-01-31'"

DEVICE_OS = ("CASE event_type WHEN 'click' THEN 'Android' WHEN 'purchase' THEN 'android' "
             "WHEN 'view' THEN 'IOS' WHEN 'signup' THEN 'windows' END")

VIEWS = {
    "dev_events": f"""SELECT user_id AS cuid, event_id AS reference_id, {DEVICE_OS} AS device_os,
        ts AS created_timestamp, CAST(ts AS DATE) AS partition_date FROM events""",
    "cust": """SELECT c_custkey AS id, c_custkey AS cuid, c_name AS current_detailed_address,
        c_mktsegment AS permanent_detailed_address, DATE '2024-01-01' AS partition_date FROM customer""",
    "app": """SELECT o_custkey AS customer_id, o_orderkey AS serial_number,
        make_timestamp(2024, month(o_orderdate), day(o_orderdate), 0, 0, 0) AS created_at,
        CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'F' THEN 'CLOSED' ELSE 'PENDING' END AS status,
        CAST(o_orderdate AS DATE) AS partition_date, o_orderdate AS bq_updated_time FROM orders""",
    "apply_info": """SELECT c_custkey AS cuid, CAST(c_nationkey AS VARCHAR) AS tax_code, c_name AS company_name,
        CASE WHEN c_mktsegment = 'BUILDING' THEN 'null'
             ELSE '106.' || lpad(CAST(600 + c_custkey % 97 AS VARCHAR), 3, '0') END AS longitude,
        CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'null'
             ELSE '10.' || lpad(CAST(700 + c_custkey % 100 AS VARCHAR), 3, '0') END AS latitude
        FROM customer""",
    "dl": f"""SELECT CAST(event_id AS VARCHAR) || '-' || CAST(a AS VARCHAR) AS uuid, user_id AS cuid,
        event_id AS reference_id, event_id AS series_number, {DEVICE_OS} AS device_os,
        '{{"reference_id":' || CAST(event_id AS VARCHAR) || ',"attempt":' || CAST(a AS VARCHAR) || '}}'
            AS api_payload_message,
        CASE WHEN a = n THEN (CASE event_type WHEN 'purchase' THEN '200' WHEN 'signup' THEN 'success'
             WHEN 'click' THEN '404' WHEN 'view' THEN '503' ELSE 'failed' END) ELSE '503' END AS api_status,
        ts + a * INTERVAL 1 HOUR AS bq_updated_time, CAST(ts + a * INTERVAL 1 HOUR AS DATE) AS partition_date
        FROM (SELECT *, unnest(generate_series(1, n)) AS a
              FROM (SELECT *, CAST(1 + least(2, floor(value / 20)) AS INTEGER) AS n FROM events))""",
    "done_android": "SELECT event_id AS reference_id FROM events WHERE event_type = 'click' AND value < 10",
    "done_ios": "SELECT event_id AS reference_id FROM events WHERE event_type = 'view' AND value < 10",
    "geo_done": "SELECT o_orderkey AS serial_number FROM orders WHERE o_totalprice < 50000",
    "geo_dl": """SELECT CAST(o_orderkey AS VARCHAR) AS uuid, o_custkey AS cuid, o_orderkey AS series_number,
        c_name AS contact_address, c_mktsegment AS residence_address, CAST(c_nationkey AS VARCHAR) AS tax_code,
        c_name AS company_name,
        '106.' || lpad(CAST(600 + o_custkey % 97 AS VARCHAR), 3, '0') AS contract_longitude,
        '10.' || lpad(CAST(700 + o_custkey % 100 AS VARCHAR), 3, '0') AS contract_latitude,
        CAST(NULL AS VARCHAR) AS api_payload_message,
        CASE o_orderstatus WHEN 'F' THEN '200' WHEN 'O' THEN '500' ELSE '429' END AS api_status,
        CAST(NULL AS INTEGER) AS retry_count, CAST(NULL AS TIMESTAMP) AS last_retry_time,
        o_orderdate AS bq_updated_time, make_date(2024, 1, least(day(o_orderdate), 31)) AS partition_date
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority = '5-LOW'""",
}


VIEWS["geo_dl_all"] = VIEWS["geo_dl"].replace(" WHERE o_orderpriority = '5-LOW'", "")


def with_views(names: list[str], body: str) -> str:
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names)
    return f"WITH {ctes}\n{body}"


ORACLES: dict[str, str] = {}

# Candidates, by set algebra: the keys still open are a difference of key sets,
# the lowest serial of a customer's day is an aggregate, and each key's columns
# are looked up afterwards.
_DAY_SERIAL = """
, day_serial AS (SELECT customer_id, CAST(created_at AS DATE) AS made_on, min(serial_number) AS lowest
                 FROM app GROUP BY 1, 2)
, holder AS (SELECT id, max(cuid) AS owner FROM cust GROUP BY id)"""


def _daily_sql(os_filter: str = "") -> str:
    return with_views(["dev_events", "cust", "app", "dl", "done_android", "done_ios"], f"""{_DAY_SERIAL}
, open_keys AS (
  SELECT reference_id FROM dev_events WHERE cuid IS NOT NULL{os_filter}
  EXCEPT SELECT reference_id FROM done_android
  EXCEPT SELECT reference_id FROM done_ios
  EXCEPT SELECT reference_id FROM dl WHERE partition_date = {AS_OF})
, batch AS (SELECT reference_id FROM open_keys WHERE reference_id IS NOT NULL ORDER BY 1 LIMIT 50)
SELECT e.cuid, e.reference_id, e.device_os, e.created_timestamp,
       (SELECT min(lowest) FROM day_serial s JOIN holder h ON s.customer_id = h.id
        WHERE h.owner = e.cuid AND s.made_on = CAST(e.created_timestamp AS DATE)) AS serial_number,
       e.partition_date
FROM batch SEMI JOIN dev_events USING (reference_id) JOIN dev_events e USING (reference_id)""")


ORACLES["daily_candidates"] = _daily_sql()


# ------------------------------------------------------------------ flatten
def _flatten_device_sql(ios: bool) -> str:
    from enrichkit.plans.mappings import ANDROID, BASE_COLUMNS, IOS
    m = IOS if ios else ANDROID
    tf = "CASE WHEN {c} THEN 'true' ELSE 'false' END"
    # values the payload builder puts in, read straight from orders
    second = "(has_ins AND pr = 4)" if ios else "FALSE"
    known = {
        "cuid": "CAST(o_custkey AS VARCHAR)",
        "seriesnumber": "'S' || CAST(o_orderkey AS VARCHAR)",
        "device_os": "'IOS'" if ios else "'Android'",
        "bq_updated_time": "o_orderdate",
        "partition_date": "CASE WHEN o_orderstatus = 'F' THEN DATE '2024-01-25' ELSE DATE '2024-01-20' END",
        "requested_date": "CAST(CAST(o_orderdate AS DATE) AS VARCHAR)",
        "requester": "CASE WHEN o_orderstatus = 'F' THEN 'app-v2' ELSE 'app' END",
        "reference_number": "CASE o_orderkey % 50 WHEN 0 THEN NULL WHEN 1 THEN 'X' || CAST(o_orderkey AS VARCHAR)"
                            " ELSE CAST(o_orderkey AS VARCHAR) END",
        "device_id": f"CASE WHEN NOT has_ins THEN NULL WHEN {second} THEN 'dev2-' || CAST(o_orderkey AS VARCHAR)"
                     " ELSE 'dev-' || CAST(o_orderkey AS VARCHAR) END",
        "device_brand": f"CASE WHEN NOT has_ins THEN NULL WHEN {second} THEN 'second' ELSE o_orderpriority END",
        "device_model": f"CASE WHEN NOT has_ins OR {second} OR pr = 2 THEN NULL ELSE o_orderstatus END",
        "device_is_rooted": f"CASE WHEN NOT has_ins OR {second} THEN NULL ELSE "
                            + tf.format(c="o_totalprice > 200000") + " END",
        "device_ram_total_size": f"CASE WHEN NOT has_ins OR {second} THEN NULL ELSE CAST(o_custkey AS VARCHAR) END",
        "ip": "CASE WHEN has_ins THEN '10.0.0.' || CAST(o_orderkey % 250 AS VARCHAR) END",
        "ip_country": "CASE WHEN has_ins THEN 'VN' END",
        "ip_privacy_vpn": "CASE WHEN has_ins THEN " + tf.format(c="o_orderstatus = 'O'") + " END",
        "velocity_datasets_count_all_from_ip":
            ("CASE WHEN has_ins THEN CAST(o_custkey AS VARCHAR) END" if ios else
             "CASE WHEN has_ins AND o_orderstatus = 'O' THEN CAST(o_custkey AS VARCHAR) END"),
        "typing_text_input_speed": "CASE WHEN has_ins THEN CAST(pr AS VARCHAR) END",
        "expert_score": "CASE WHEN has_ins THEN CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR) END",
        "app_package_name": "CASE WHEN i IS NOT NULL THEN 'app.' || CAST(o_orderkey AS VARCHAR) || '.' || CAST(i AS VARCHAR) END",
        "app_paid": "CASE WHEN i IS NOT NULL THEN " + tf.format(c="i % 2 = 0") + " END",
        "app_date_installed_rank_desc": "CAST(i AS VARCHAR)",
    }
    cols = BASE_COLUMNS + m.feature_columns()
    sel = ",\n  ".join(f"{known.get(c, 'CAST(NULL AS VARCHAR)')} AS {c}" for c in cols)
    apps = "" if ios else """
, apps AS (SELECT o_orderkey AS ak, unnest(generate_series(1, pr)) AS i FROM o WHERE has_ins)"""
    join = "" if ios else " LEFT JOIN apps ON apps.ak = o.o_orderkey"
    return f"""WITH o AS (
  SELECT *, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS pr,
         (o_orderstatus <> 'P' AND substr(o_orderpriority, 1, 1) <> '5') AS has_ins
  FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'){apps}
SELECT
  {sel}
FROM o{join}"""


ORACLES["flatten_android"] = _flatten_device_sql(ios=False)
ORACLES["flatten_ios"] = _flatten_device_sql(ios=True)


#: Column prefixes of the sections, and names off the rule.
_SECTION_PREFIX = {"ipInfo": "ip", "permissions": "permission", "riskyApps": "risky", "fraudAlerts": "fraud",
                   "velocity": "velocity", "typing": "typing",
                   "uiInteractions": "ui", "fingerGestures": "finger", "touchActions": "touch", "anomaly": "anomaly",
                   "expertScore": "expert"}
_OFF_RULE = {"deviceIsJailBroken": "device_is_jailbroken"}


def _column_of(code: str, key: str) -> str:
    """Column of a payload field: its words joined by underscores behind the
    section's prefix. A word is capitals, a capitalised word, or a number that
    another word follows; a number at the end belongs to the word before it."""
    import re
    if key in _OFF_RULE:
        return _OFF_RULE[key]
    if key.startswith("NS"):
        key = key.removeprefix("NS").removesuffix("Description")
    words = re.findall(r"[A-Z]+(?![a-z])\d*$|[A-Z]+(?![a-z])|[A-Z]?[a-z]+\d+$|[A-Z]?[a-z]+|\d+", key.replace("+", "Plus"))
    name = "_".join(words).lower()
    prefix = _SECTION_PREFIX.get(code, "")
    return name if not prefix or name == prefix or name.startswith(prefix + "_") else f"{prefix}_{name}"


def _flatten_full_sql(ios: bool) -> str:
    """Rows of payloads that fill every field: values by their place, straight
    from the order; column names by ``_column_of``."""
    from enrichkit.plans.mappings import ANDROID, IOS
    from enrichkit.sources.testdata import payload_sections
    cols = ["CAST(o_custkey AS VARCHAR) AS cuid", "'S' || CAST(o_orderkey AS VARCHAR) AS seriesnumber",
            f"'{'IOS' if ios else 'Android'}' AS device_os", "o_orderdate AS bq_updated_time",
            "DATE '2024-01-20' AS partition_date", "'2024-01-02' AS requested_date", "'full' AS requester",
            "CAST(o_orderkey AS VARCHAR) AS reference_number"]
    number = "CAST(o_orderkey % 97 AS VARCHAR)"
    for code, keys, many in payload_sections(IOS if ios else ANDROID):
        for i, alts in enumerate(keys):
            text = f"'{alts[0]} ' || {'app || chr(32) || ' if many else ''}{number}"
            value = (text, number, "'true'")[i % 3]
            cols.append(f"{value} AS {_column_of(code, alts[0])}")
    apps = "" if ios else ", (VALUES ('1'), ('2')) AS apps(app)"
    return "SELECT " + ",\n  ".join(cols) + f"\nFROM orders{apps}"


ORACLES["flatten_android_full"] = _flatten_full_sql(ios=False)
ORACLES["flatten_ios_full"] = _flatten_full_sql(ios=True)


ORACLES["flatten_parsed"] = ORACLES["flatten_android"]


def _flatten_geo_sql() -> str:
    from enrichkit.plans.flatten import GEO_PAD_COLUMNS
    rnd = ("CASE WHEN abs(try_cast({x} AS DOUBLE)) <= 180 THEN regexp_replace(CAST(CAST("
           "round(try_cast({x} AS DOUBLE), 4) AS DECIMAL(38,4)) AS VARCHAR), '\\.?0+$', '') END")
    pads = ",\n  ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in GEO_PAD_COLUMNS)
    return f"""WITH g AS (
  SELECT c_custkey AS cuid, c_custkey AS serial_number,
    CASE WHEN c_mktsegment = 'FURNITURE' THEN '   ' ELSE c_name END AS contact_address,
    c_mktsegment AS residence_address, c_name AS company_name,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'null' WHEN 'AUTOMOBILE' THEN '' WHEN 'HOUSEHOLD' THEN 'abc'
         ELSE '106.' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') || '1' END AS lon,
    printf('%.2f', c_acctbal) AS lat, c_custkey AS k, c_acctbal AS bal
  FROM customer WHERE c_nationkey >= 3)
SELECT cuid, serial_number,
  {rnd.format(x='lon')} AS contract_longitude,
  {rnd.format(x='lat')} AS contract_latitude,
  CASE WHEN contact_address IS NULL OR trim(contact_address) = '' THEN NULL ELSE contact_address END AS contact_address,
  CASE WHEN residence_address IS NULL OR trim(residence_address) = '' THEN NULL ELSE residence_address END
    AS residence_address,
  company_name,
  {pads},
  CAST(k % 7 AS VARCHAR) AS contract_poi_corporate_finance,
  CAST(k % 11 AS VARCHAR) AS contract_poi_commercial_facility,
  CASE WHEN bal < 0 THEN 'null' ELSE CAST(k % 5 AS VARCHAR) END AS contract_poi_residential,
  TIMESTAMP '2024-01-30 12:00:00' AS bq_updated_time, DATE '2024-01-30' AS partition_date
FROM g"""


ORACLES["flatten_geo"] = _flatten_geo_sql()


# ------------------------------------------------------------ dedup and joins
ORACLES["latest_per_key"] = with_views(["dev_events"], """
SELECT * FROM dev_events
QUALIFY row_number() OVER (PARTITION BY cuid ORDER BY created_timestamp DESC, reference_id) = 1""")

ORACLES["latest_after_join"] = with_views(["cust", "app"], """
, best AS (SELECT customer_id, arg_max(serial_number, (created_at, serial_number)) AS serial_number
           FROM app GROUP BY customer_id)
SELECT c.id, c.cuid, a.serial_number, a.created_at, a.status
FROM cust c LEFT JOIN best b ON b.customer_id = c.id
LEFT JOIN app a ON a.customer_id = b.customer_id AND a.serial_number = b.serial_number""")

ORACLES["left_join_on_date"] = with_views(["dev_events", "app"], """
SELECT m.reference_id, m.cuid, m.created_timestamp, a.serial_number
FROM dev_events m LEFT JOIN app a
  ON m.cuid = a.customer_id AND CAST(a.created_at AS DATE) = CAST(m.created_timestamp AS DATE)""")

ORACLES["inner_chain"] = with_views(["cust", "app", "apply_info"], """
SELECT c.cuid AS cuid, ap.serial_number AS serial, ap.created_at AS applied_at,
       c.current_detailed_address AS address, ay.tax_code, ay.longitude AS lon, ay.latitude AS lat
FROM cust c JOIN app ap ON c.id = ap.customer_id JOIN apply_info ay ON c.cuid = ay.cuid""")

ORACLES["left_made_inner"] = with_views(["cust", "app"], """
SELECT c.cuid, a.serial_number, l.l_linenumber, CAST(l.l_quantity AS BIGINT) AS quantity
FROM cust c JOIN app a ON c.id = a.customer_id LEFT JOIN lineitem l ON a.serial_number = l.l_orderkey
WHERE a.status = 'ACTIVE'""")

ORACLES["exclude_processed"] = with_views(["app", "geo_dl"], """
SELECT customer_id, serial_number, status FROM app a
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = a.serial_number)
  AND NOT EXISTS (SELECT 1 FROM geo_dl d WHERE d.series_number = a.serial_number
                  AND d.partition_date = DATE '2024-01-05')""")

ORACLES["incremental"] = """
SELECT c_custkey AS serial_number, c_custkey AS cuid FROM customer
WHERE c_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 3 AND c_custkey IS NOT NULL)"""

ORACLES["semi_reconcile"] = with_views(["geo_dl_all"], """
, landed AS (SELECT DISTINCT o_orderkey AS serial_number FROM orders
             WHERE o_orderstatus = 'O' AND make_date(2024, 1, least(day(o_orderdate), 31)) = DATE '2024-01-15')
, f AS (SELECT d.*, (d.series_number IN (SELECT serial_number FROM landed))
                    AND NOT (d.api_status LIKE '2%' OR d.api_status = 'success') AS hit FROM geo_dl_all d)
SELECT uuid, series_number,
  CASE WHEN hit THEN '200' ELSE api_status END AS api_status,
  CASE WHEN hit THEN TIMESTAMP '2024-01-31 00:00:00' ELSE bq_updated_time END AS bq_updated_time,
  CASE WHEN hit THEN DATE '2024-01-15' ELSE partition_date END AS partition_date,
  coalesce(hit, false) AS reconciled
FROM f""")

# ------------------------------------------------------------ pipelines
ORACLES["range_candidates"] = with_views(["dev_events", "cust", "app", "done_android", "done_ios"], """
, finished AS (SELECT reference_id FROM done_android UNION SELECT reference_id FROM done_ios)
, window_events AS (
  SELECT * FROM dev_events ANTI JOIN finished USING (reference_id)
  WHERE created_timestamp >= TIMESTAMP '2024-01-10' AND created_timestamp < TIMESTAMP '2024-01-13')
, made AS (SELECT k.cuid, CAST(a.created_at AS DATE) AS made_on, a.serial_number
           FROM app a, cust k WHERE k.id = a.customer_id GROUP BY ALL)
SELECT w.cuid, reference_id, device_os, created_timestamp, serial_number
FROM window_events w LEFT JOIN made ON made.cuid = w.cuid AND made_on = CAST(created_timestamp AS DATE)
ORDER BY created_timestamp, reference_id, serial_number NULLS LAST
LIMIT 50""")

_OPEN_SERIALS = """
, taken AS (SELECT serial_number FROM geo_done UNION SELECT series_number FROM geo_dl)
, open_serials AS (SELECT serial_number FROM app WHERE status = 'ACTIVE' EXCEPT SELECT serial_number FROM taken)
, located AS (SELECT * FROM apply_info WHERE 'null' NOT IN (longitude, latitude))
, pending AS (
  SELECT k.cuid, serial_number, created_at, current_detailed_address, permanent_detailed_address,
         tax_code, company_name, longitude, latitude, app.partition_date
  FROM located JOIN cust k USING (cuid), app SEMI JOIN open_serials USING (serial_number)
  WHERE app.customer_id = k.id)"""

ORACLES["geo_candidates"] = with_views(["cust", "app", "apply_info", "geo_done", "geo_dl"], _OPEN_SERIALS + """
SELECT * FROM pending ORDER BY cuid, serial_number LIMIT 500""")

ORACLES["geo_range_candidates"] = with_views(["cust", "app", "apply_info", "geo_done"], """
, quarter AS (SELECT customer_id, serial_number FROM app ANTI JOIN geo_done USING (serial_number)
              WHERE date_trunc('quarter', partition_date) = DATE '1998-01-01')
, owner AS (SELECT q.serial_number, k.cuid FROM quarter q, cust k WHERE q.customer_id = k.id)
SELECT owner.cuid, serial_number, longitude, latitude FROM owner LEFT JOIN apply_info USING (cuid)""")

ORACLES["retry_list"] = with_views(["dl"], """
, w AS (SELECT * FROM dl WHERE partition_date >= DATE '2024-01-28')
, latest AS (SELECT reference_id, arg_max(uuid, bq_updated_time) AS uuid FROM w GROUP BY reference_id)
SELECT w.* FROM w JOIN latest USING (reference_id, uuid)
WHERE NOT (w.api_status LIKE '2%' OR w.api_status = 'success')""")

ORACLES["retry_list_geo"] = with_views(["geo_dl_all"], """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY series_number ORDER BY bq_updated_time DESC, uuid) AS rn
  FROM geo_dl_all WHERE partition_date BETWEEN DATE '2024-01-11' AND DATE '2024-01-30')
WHERE rn = 1 AND NOT (api_status LIKE '2%' OR api_status = 'success')""")

ORACLES["distinct_pairs"] = with_views(["dev_events"], "SELECT DISTINCT cuid, device_os FROM dev_events")

_GEO_RETRY = """
, recent AS (SELECT series_number, max(struct_pack(t := bq_updated_time, u := uuid)) AS newest
             FROM geo_dl WHERE partition_date > DATE '2024-01-10' AND partition_date < DATE '2024-01-31'
             GROUP BY series_number)
, retry AS (SELECT d.* FROM geo_dl d JOIN recent r ON d.series_number = r.series_number AND d.uuid = r.newest.u
            WHERE d.api_status <> 'success' AND left(d.api_status, 1) <> '2')"""

ORACLES["union_retry"] = with_views(["cust", "app", "apply_info", "geo_done", "geo_dl"], _OPEN_SERIALS + _GEO_RETRY + """
, batch AS (SELECT * FROM pending ORDER BY cuid, serial_number LIMIT 500)
SELECT cuid, serial_number, current_detailed_address, permanent_detailed_address, tax_code, company_name,
       longitude, latitude, 'new' AS origin FROM batch
UNION ALL
SELECT cuid, series_number, contact_address, residence_address, tax_code, company_name,
       contract_longitude, contract_latitude, 'retry' FROM retry""")

# ------------------------------------------------------------ enrichment
_HAV = ("2 * 6371000.0 * asin(least(1.0, sqrt(pow(sin((radians(p.lat) - radians(q.lat)) / 2), 2)"
        " + cos(radians(q.lat)) * cos(radians(p.lat)) * pow(sin((radians(p.lon) - radians(q.lon)) / 2), 2))))")

_PLACES = """places AS (
  SELECT s_suppkey AS place_id,
    CAST('10.' || lpad(CAST(700 + s_suppkey % 100 AS VARCHAR), 3, '0') AS DOUBLE) AS lat,
    CAST('106.' || lpad(CAST(600 + s_suppkey % 97 AS VARCHAR), 3, '0') AS DOUBLE) AS lon,
    CASE s_suppkey % 3 WHEN 0 THEN 'corporate_finance' WHEN 1 THEN 'commercial' ELSE 'residential' END
      AS scenario
  FROM supplier WHERE s_acctbal >= 0),
scen AS (SELECT * FROM (VALUES ('corporate_finance'), ('residential'), ('commercial')) t(scenario))"""

ORACLES["poi_counts"] = with_views(["apply_info"], f"""
, {_PLACES}
, pts AS (SELECT cuid, try_cast(latitude AS DOUBLE) AS lat, try_cast(longitude AS DOUBLE) AS lon FROM apply_info)
SELECT q.cuid, s.scenario,
  CASE WHEN q.lat IS NULL OR q.lon IS NULL THEN NULL
       ELSE (SELECT count(*) FROM places p WHERE p.scenario = s.scenario AND {_HAV} <= 700.0) END AS count
FROM pts q, scen s""")

_GEO_PER = f"""
, {_PLACES}
, rec AS (SELECT cuid, cuid - cuid % 2 AS serial_number, latitude, longitude,
            latitude IS NOT NULL AND longitude IS NOT NULL AND lower(latitude) <> 'null'
            AND lower(longitude) <> 'null' AS valid FROM apply_info)
, fail AS (SELECT c_custkey AS cuid, 'commercial' AS scenario, '503' AS status
           FROM customer WHERE c_acctbal < 0)
, per AS (
  SELECT q.cuid, q.serial_number, s.scenario, coalesce(f.status, '200') AS status,
    (f.status IS NULL OR f.status LIKE '2%') AS ok,
    CASE WHEN NOT q.valid OR NOT (f.status IS NULL OR f.status LIKE '2%') THEN 'null'
         ELSE CAST((SELECT count(*) FROM places p WHERE p.scenario = s.scenario AND
              {_HAV.replace('q.lat', 'try_cast(q.latitude AS DOUBLE)').replace('q.lon', 'try_cast(q.longitude AS DOUBLE)')} <= 700.0)
              AS VARCHAR) END AS count_text
  FROM rec q CROSS JOIN scen s LEFT JOIN fail f ON f.cuid = q.cuid AND f.scenario = s.scenario)"""

ORACLES["scenario_gate"] = with_views(["apply_info"], _GEO_PER + """
SELECT cuid, serial_number, bool_and(ok) AS all_ok, count(*) FILTER (WHERE NOT ok) AS failed_scenarios,
  '{"scenario_counts":{"corporate_finance":"' || max(count_text) FILTER (WHERE scenario = 'corporate_finance')
  || '","residential":"' || max(count_text) FILTER (WHERE scenario = 'residential')
  || '","commercial":"' || max(count_text) FILTER (WHERE scenario = 'commercial') || '"}}' AS raw_data
FROM per GROUP BY cuid, serial_number""")

ORACLES["scenario_summary"] = with_views(["apply_info"], _GEO_PER + """
SELECT cuid, serial_number, count(*) FILTER (WHERE ok) AS successful, count(*) AS total,
  coalesce(array_to_string(list_sort(list(scenario || ':' || status) FILTER (WHERE NOT ok)), ','), '') AS errors,
  count(*) FILTER (WHERE ok) = 0 AS failed
FROM per GROUP BY cuid, serial_number""")

ORACLES["geo_enrichment"] = with_views(["apply_info"], _GEO_PER + """
, gate AS (
  SELECT cuid, serial_number, bool_and(ok) AS all_ok,
  '{"scenario_counts":{"corporate_finance":"' || max(count_text) FILTER (WHERE scenario = 'corporate_finance')
  || '","residential":"' || max(count_text) FILTER (WHERE scenario = 'residential')
  || '","commercial":"' || max(count_text) FILTER (WHERE scenario = 'commercial') || '"}}' AS raw_data
  FROM per GROUP BY cuid, serial_number)
SELECT 'raw' AS zone, serial_number, cuid, raw_data,
       CAST(NULL AS VARCHAR) AS api_status, CAST(NULL AS VARCHAR) AS api_payload_message
FROM gate WHERE all_ok
UNION ALL
SELECT 'dead_letter', p.serial_number, p.cuid, NULL, status,
       CAST(to_json({'cuid': p.cuid, 'serial_number': p.serial_number, 'current_detailed_address': c_name,
         'permanent_detailed_address': c_mktsegment, 'tax_code': CAST(c_nationkey AS VARCHAR), 'company_name': c_name,
         'longitude': longitude, 'latitude': latitude, 'scenario': scenario}) AS VARCHAR)
FROM per p JOIN apply_info USING (cuid) JOIN customer ON c_custkey = p.cuid WHERE NOT ok""")

_DEV_LOOKUP = f"""lk AS (
  SELECT user_id AS cuid, event_id AS reference_id, {DEVICE_OS} AS device_os,
    CASE WHEN value >= 5 THEN '{{"referenceNumber":"' || CAST(event_id AS VARCHAR) || '","props":' || props || '}}' END
      AS payload,
    CASE WHEN value >= 5 THEN '200' ELSE '404' END AS status
  FROM events)"""

ORACLES["device_enrichment"] = f"""WITH {_DEV_LOOKUP}
SELECT 'raw' AS zone, cuid, reference_id, device_os, payload AS raw_data, CAST(NULL AS VARCHAR) AS api_status
FROM lk WHERE status LIKE '2%'
UNION ALL
SELECT 'dead_letter', cuid, reference_id, device_os, NULL, status FROM lk WHERE status NOT LIKE '2%'"""

ORACLES["route_by_device"] = f"""WITH {_DEV_LOOKUP}
SELECT cuid, reference_id, device_os,
  CASE lower(device_os) WHEN 'android' THEN 'android' WHEN 'ios' THEN 'ios' ELSE 'unrouted' END AS route
FROM lk WHERE status LIKE '2%'"""

ORACLES["raw_rows"] = f"""WITH {_DEV_LOOKUP}
SELECT cuid, reference_id, device_os, payload AS raw_data, TIMESTAMP '2024-01-31 00:00:00' AS bq_updated_time,
  DATE '2024-01-31' AS partition_date
FROM lk WHERE status LIKE '2%'"""

ORACLES["dead_letter"] = with_views(["cust", "app"], f"""
, {_DEV_LOOKUP}
, ap AS (SELECT * FROM app QUALIFY row_number() OVER (
         PARTITION BY customer_id, serial_number ORDER BY partition_date DESC, created_at DESC) = 1)
SELECT CAST(m.cuid AS VARCHAR) AS cuid, CAST(m.reference_id AS VARCHAR) AS reference_id,
  coalesce(nullif(CAST(ap.serial_number AS VARCHAR), ''), nullif(m.device_os, '')) AS series_number,
  nullif(m.device_os, '') AS device_os,
  '{{"reference_id":' || CAST(m.reference_id AS VARCHAR) || ',"status":"' || m.status || '"}}' AS api_payload_message,
  m.status AS api_status, TIMESTAMP '2024-01-31 00:00:00' AS bq_updated_time, DATE '2024-01-31' AS partition_date
FROM lk m LEFT JOIN cust c ON c.cuid = m.cuid
LEFT JOIN ap ON c.id = ap.customer_id AND CAST(ap.created_at AS DATE) = CAST(
  (SELECT ts FROM events e WHERE e.event_id = m.reference_id) AS DATE)
WHERE m.status NOT LIKE '2%'""")

ORACLES["enrich_lookup"] = """
SELECT event_id, CASE WHEN value >= 5 THEN '200' ELSE '404' END AS status,
  CASE WHEN value >= 5 THEN '{"referenceNumber":"' || CAST(event_id AS VARCHAR) || '","props":' || props || '}' END
    AS payload
FROM events"""

# ------------------------------------------------------------ functions
ORACLES["json_scalar"] = """
SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS whole,
       CAST(NULL AS VARCHAR) AS missing
FROM events"""

ORACLES["json_explode"] = """
WITH o AS (SELECT *, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS pr FROM orders
           WHERE o_orderstatus <> 'P' AND substr(o_orderpriority, 1, 1) <> '5'),
codes AS (SELECT * FROM (VALUES (0, 'deviceInfo'), (1, 'ipInfo'), (2, 'velocity'), (3, 'deviceInfo'),
                                (4, 'typing'), (5, 'expertScore'), (6, 'lastApps')) t(pos, code))
SELECT CAST(o_orderkey AS VARCHAR) AS reference_id, pos, code,
  CAST(CASE WHEN pos = 3 THEN CAST(o_orderdate AS DATE) + (pr - 3) ELSE CAST(o_orderdate AS DATE) END AS VARCHAR)
    AS calculated_date,
  CAST(NULL AS VARCHAR) AS value_scalar
FROM o, codes"""

ORACLES["log_search"] = r"""
SELECT page_id, nullif(regexp_extract(url, '/([0-9]+)(\?|#|$)', 1), '') AS url_id
FROM pages WHERE url LIKE '%/en/%'"""

ORACLES["severity"] = with_views(["dl"], """
SELECT uuid, api_status,
  CASE WHEN api_status = '400' AND (contains(coalesce(api_payload_message, ''), 'reference_number_invalid')
            OR contains(coalesce(api_payload_message, ''),
                        'Dataset with the specified reference number does not exist'))
       THEN 'WARNING'
       WHEN starts_with(api_status, '4') OR starts_with(api_status, '5') THEN 'ERROR' ELSE 'Info' END AS severity,
  coalesce(api_status IN ('500', '502', '503', '504'), false) AS retry_device,
  coalesce(api_status IN ('429', '500', '502', '503', '504'), false) AS retry_geo
FROM dl""")

ORACLES["coords_valid"] = """
WITH g AS (SELECT c_custkey AS serial_number, printf('%.2f', c_acctbal) AS lat,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'null' WHEN 'AUTOMOBILE' THEN '' WHEN 'HOUSEHOLD' THEN 'abc'
       ELSE '106.' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') || '1' END AS lon FROM customer)
SELECT serial_number,
  coalesce(lat IS NOT NULL AND lon IS NOT NULL AND lower(lat) <> 'null' AND lower(lon) <> 'null', false) AS valid,
  coalesce(lat IS NOT NULL AND lon IS NOT NULL AND lower(lat) <> 'null' AND lower(lon) <> 'null'
           AND try_cast(lat AS DOUBLE) BETWEEN -90 AND 90 AND try_cast(lon AS DOUBLE) BETWEEN -180 AND 180,
           false) AS strict_valid
FROM g"""

ORACLES["date_valid"] = r"""
WITH d AS (SELECT event_id, CASE event_type
    WHEN 'click' THEN CAST(CAST(ts AS DATE) AS VARCHAR)
    WHEN 'view' THEN replace(CAST(CAST(ts AS DATE) AS VARCHAR), '-', '/')
    WHEN 'signup' THEN '2024-02-' || lpad(CAST(day(ts) AS VARCHAR), 2, '0')
    WHEN 'purchase' THEN CAST(CAST(ts AS DATE) AS VARCHAR) || 'x'
    ELSE '2023-' || lpad(CAST(day(ts) AS VARCHAR), 2, '0') || '-01' END AS date_text FROM events)
SELECT event_id, date_text,
  coalesce(regexp_full_match(date_text, '(\d{4})-(1[0-2]|0[1-9]|[1-9])-(3[01]|[12]\d|0[1-9]|[1-9]| [1-9])')
           AND TRY_CAST(split_part(date_text, '-', 1) AS INTEGER) >= 1
           AND try_strptime(split_part(date_text, '-', 1) || '-' || lpad(split_part(date_text, '-', 2), 2, '0')
                            || '-' || lpad(trim(split_part(date_text, '-', 3)), 2, '0'), '%Y-%m-%d') IS NOT NULL,
           false) AS date_valid
FROM d"""

ORACLES["count_normalise"] = """
SELECT event_id, CASE WHEN event_type IN ('purchase', 'signup') THEN '0'
                      ELSE json_extract_string(props, '$.k') END AS count_text
FROM events"""

ORACLES["ids"] = with_views(["dev_events"], """
SELECT reference_id, 'credit_flow_' || CAST(reference_id AS VARCHAR) AS flow_id,
  'credit_flowE' || lpad(CAST(cuid % 100 AS VARCHAR), 2, '0') AS task_code,
  'E' || lpad(CAST(cuid % 100 AS VARCHAR), 2, '0') AS code,
  'load_' || lower(coalesce(device_os, 'none')) AS name,
  lower(device_os) AS os_lower, upper(device_os) AS os_upper,
  concat_ws('_', CAST(partition_date AS VARCHAR), lower(device_os), CAST(reference_id AS VARCHAR)) AS landing_name
FROM dev_events""")

ORACLES["masked"] = with_views(["apply_info"], """
SELECT cuid, tax_code, sha256(company_name) AS company_name, sha256(longitude) AS longitude,
       sha256(latitude) AS latitude FROM apply_info""")

ORACLES["messages"] = """
SELECT event_id AS message_id,
  CASE event_type WHEN 'purchase' THEN 'daily_recall' WHEN 'click' THEN 'range_recall'
                  WHEN 'signup' THEN 'range_recall' WHEN 'view' THEN 'reindex' END AS message_type,
  CASE event_type WHEN 'purchase' THEN 'daily' WHEN 'click' THEN 'range' WHEN 'signup' THEN 'range'
                  WHEN 'view' THEN 'error' ELSE 'quarantine' END AS route,
  CASE WHEN event_type IN ('purchase', 'click', 'signup') THEN CAST(user_id % 9 + 1 AS INTEGER) END AS batch_number,
  CASE WHEN event_type IN ('click', 'signup') THEN CAST(CAST(ts AS DATE) AS VARCHAR) END AS start_date,
  CASE WHEN event_type = 'click' THEN CAST(CAST(ts AS DATE) AS VARCHAR) END AS end_date,
  event_type IN ('purchase', 'click') AS valid,
  CASE WHEN event_type = 'click' THEN 'range' ELSE 'daily' END AS subscription
FROM events"""

# ------------------------------------------------------------ aggregates
_API_LOG = """api AS (SELECT l_returnflag AS api_type, CASE l_linestatus WHEN 'F' THEN '200' ELSE '503' END AS status_code, o_orderdate AS start_time,
  l_shipdate AS end_time, l_linenumber - 1 AS retry FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

ORACLES["flow_stats"] = """
SELECT 'flow_' || event_type AS flow_name, CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  CAST(ts AS DATE) AS day, count(*) AS n
FROM events GROUP BY ALL"""

ORACLES["sql_flow_stats"] = ORACLES["flow_stats"].replace("FROM events", "FROM events WHERE ts < TIMESTAMP '2024-01-16'")

ORACLES["api_stats"] = f"""WITH {_API_LOG}
SELECT api_type, status_code, CAST(start_time AS DATE) AS day, count(*) AS calls,
  round(avg(date_diff('second', start_time, end_time)), 3) AS avg_duration_s, CAST(sum(retry) AS BIGINT) AS total_retries
FROM api GROUP BY ALL"""

ORACLES["retry_stats"] = f"""WITH {_API_LOG}
SELECT api_type, retry, count(*) AS n FROM api WHERE retry > 0 GROUP BY ALL"""

ORACLES["countif_stats"] = f"""WITH {_API_LOG}
SELECT CAST(start_time AS DATE) AS day, count(*) AS calls, CAST(count_if(status_code = '200') AS BIGINT) AS ok_calls,
  CAST(count_if(status_code = '503') AS BIGINT) AS failed_calls, max(start_time) AS last_call,
  max(retry) AS max_retry, round(avg(retry), 4) AS avg_retry
FROM api GROUP BY ALL"""

ORACLES["countif_stats_global"] = f"""WITH {_API_LOG}
SELECT count(*) AS calls, CAST(count_if(status_code = '200') AS BIGINT) AS ok_calls,
  CAST(count_if(status_code = '503') AS BIGINT) AS failed_calls, max(start_time) AS last_call, max(retry) AS max_retry,
  round(avg(retry), 4) AS avg_retry
FROM api"""

ORACLES["failed_since"] = with_views(["dl"], """
SELECT count(*) AS failed FROM dl
WHERE partition_date >= DATE '2024-01-15' AND api_status <> 'success' AND left(api_status, 1) <> '2'""")

ORACLES["quota_by_minute"] = """
SELECT date_trunc('minute', ts) AS minute, count(*) AS calls, round(count(*) * 100.0 / 2, 2) AS usage_pct,
  round(count(*) * 100.0 / 2, 2) > 80.0 AS alarm
FROM events GROUP BY ALL"""

ORACLES["assign_batches"] = """
WITH r AS (SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) AS rn, count(*) OVER () AS total
           FROM events)
SELECT event_id, ts, rn AS row_in_order, (rn - 1) // 500 + 1 AS batch_no,
  'batch-' || CAST((rn - 1) // 500 + 1 AS VARCHAR) AS batch_label,
  least(500, total - ((rn - 1) // 500) * 500) AS batch_rows,
  least(500, total - ((rn - 1) // 500) * 500) < 500 AS is_last
FROM r"""

ORACLES["batch_summary"] = f"""WITH {_DEV_LOOKUP}
, b AS (SELECT *, (row_number() OVER (ORDER BY reference_id) - 1) // 500 + 1 AS batch_no FROM lk)
SELECT batch_no,
  CAST(count_if(device_os IS NOT NULL AND status LIKE '2%') AS BIGINT) AS success_count,
  CAST(count_if(device_os IS NOT NULL AND NOT status LIKE '2%') AS BIGINT) AS error_count,
  CAST(count_if(device_os IS NULL) AS BIGINT) AS skipped_count,
  array_to_string(list_sort(list(CAST(reference_id AS VARCHAR))), ',') AS processed
FROM b GROUP BY batch_no"""

ORACLES["next_batch"] = with_views(["dev_events", "done_android"], """
SELECT * FROM dev_events m
WHERE NOT EXISTS (SELECT 1 FROM done_android a WHERE a.reference_id = m.reference_id)
ORDER BY reference_id LIMIT 500""")

ORACLES["latest_n"] = "SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id, event_type LIMIT 10"

# ------------------------------------------------------------ sources / sinks / streams
ORACLES["sink_roundtrip"] = f"""WITH {_DEV_LOOKUP}
SELECT z.zone, cuid, reference_id, device_os, payload AS raw_data, DATE '2024-01-31' AS partition_date
FROM lk, (VALUES ('raw'), ('landing')) z(zone) WHERE status LIKE '2%'"""

ORACLES["sql_job"] = ORACLES["retry_list"]

ORACLES["inline_rows"] = with_views(["cust", "app", "apply_info", "geo_done"], """
, lit AS (SELECT * FROM (VALUES
  ('sample-1', 'S-0001', TIMESTAMP '2024-02-01 08:30:00.5', '1 Harbour Street', 'Flat 2, Mill Lane',
   CAST(NULL AS VARCHAR), 'Example Foods', '106.70000000000001', '10.75', DATE '2024-02-01'),
  ('sample-2', 'S-0002', TIMESTAMP '2024-02-01 09:00:00', '22 Station Road', 'Old Farm, Hill Village',
   '000111', 'Example Coffee', '106.6789', '10.8000123', DATE '2024-02-01'))
  t(cuid, serial_number, created_at, current_detailed_address, permanent_detailed_address, tax_code,
    company_name, longitude, latitude, partition_date))
, u AS (SELECT * FROM lit UNION ALL
  SELECT CAST(c.cuid AS VARCHAR), CAST(a.serial_number AS VARCHAR), a.created_at, c.current_detailed_address,
         c.permanent_detailed_address, ay.tax_code, ay.company_name, ay.longitude, ay.latitude, a.partition_date
  FROM cust c JOIN app a ON c.id = a.customer_id JOIN apply_info ay ON c.cuid = ay.cuid)
SELECT * FROM u WHERE NOT EXISTS (SELECT 1 FROM geo_done g WHERE CAST(g.serial_number AS VARCHAR) = u.serial_number)""")

ORACLES["minute_metrics"] = """
SELECT date_trunc('minute', ts) AS minute, count(*) AS calls, CAST(count_if(event_type = 'purchase') AS BIGINT) AS writes,
  CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS written_rows
FROM events GROUP BY 1"""

ORACLES["stream_batches"] = f"""WITH {_DEV_LOOKUP}
SELECT CASE WHEN status LIKE '2%' THEN 'raw' ELSE 'dead_letter' END AS zone, reference_id, cuid, device_os,
  CASE WHEN status LIKE '2%' THEN payload END AS raw_data,
  CASE WHEN status LIKE '2%' THEN NULL ELSE status END AS api_status
FROM lk
UNION ALL
SELECT 'dead_letter', NULL, cuid, device_os, NULL, '400' FROM lk WHERE cuid % 20 = 0"""

ORACLES["stream_record_batches"] = ORACLES["stream_batches"]

ORACLES["message_stream"] = ORACLES["messages"]

# Rounds of tries under 30 calls a minute: the first holds all calls, the next
# what answered '503', behind a wait of 1 and 2 minutes.
_CALLS = """ev AS (SELECT user_id AS cuid, event_id AS reference_id, ts, CASE WHEN value >= 5 THEN '200' ELSE '404' END AS answer,
    CASE WHEN value >= 5 THEN '{"referenceNumber":"' || CAST(event_id AS VARCHAR) || '","props":' || props || '}' END AS payload
  FROM events)
, t1 AS (SELECT *, 1 AS try, (row_number() OVER (ORDER BY ts, reference_id) - 1) // 30 AS minute,
                reference_id % 13 = 0 OR reference_id % 7 = 0 AS down FROM ev)
, t2 AS (SELECT cuid, reference_id, ts, answer, payload, 2 AS try,
                (SELECT max(minute) FROM t1) + 2 + (row_number() OVER (ORDER BY ts, reference_id) - 1) // 30 AS minute,
                reference_id % 13 = 0 OR reference_id % 77 = 0 AS down FROM t1 WHERE down)
, t3 AS (SELECT cuid, reference_id, ts, answer, payload, 3 AS try,
                (SELECT max(minute) FROM t2) + 3 + (row_number() OVER (ORDER BY ts, reference_id) - 1) // 30 AS minute,
                reference_id % 13 = 0 AS down FROM t2 WHERE down)
, tries AS (SELECT * FROM t1 UNION ALL SELECT * FROM t2 UNION ALL SELECT * FROM t3)"""

ORACLES["call_plan"] = f"""WITH {_CALLS}
SELECT cuid, reference_id, CAST(try AS INTEGER) AS try, minute, CASE WHEN down THEN '503' ELSE answer END AS status,
  CASE WHEN NOT down THEN payload END AS payload,
  CASE WHEN down THEN 'unavailable' WHEN answer = '404' THEN 'not found' END AS error, NOT down OR try = 3 AS final
FROM tries
UNION ALL
SELECT user_id, NULL, 1, NULL, '400', NULL, 'reference_number_invalid: the record has no reference', TRUE
FROM events WHERE user_id % 20 = 0"""

ORACLES["call_minutes"] = f"""WITH {_CALLS}
SELECT minute, count(*) AS calls, CAST(count_if(down) AS BIGINT) AS failed FROM tries GROUP BY minute"""

ORACLES["stream_flatten"] = _flatten_device_sql(ios=True).replace(
    "FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'", "FROM orders")

ORACLES["daily_candidates_android"] = _daily_sql(" AND lower(device_os) = 'android'")

# One geo run on zones seeded with the dead letters and the RAW rows of orders
# under 50000. Resolved: unresolved dead letters whose order landed on the day
# before the run.
_RUN = """
, seed AS (SELECT o_orderkey AS serial_number, make_date(2024, 1, least(day(o_orderdate), 31)) AS landed
           FROM orders WHERE o_totalprice < 50000)
, resolved AS (SELECT uuid FROM geo_dl JOIN seed ON series_number = serial_number
               WHERE landed = DATE '2024-01-30' AND api_status <> 'success' AND left(api_status, 1) <> '2')
, bad_owner AS (SELECT c_custkey AS cuid FROM customer WHERE c_acctbal < 0)
, new_b AS (SELECT cuid, serial_number, longitude, latitude, 'batch-' || CAST(
              (row_number() OVER (ORDER BY cuid, serial_number) - 1) // 500 + 1 AS VARCHAR) AS batch_label
            FROM pending)
, again AS (SELECT * FROM retry ANTI JOIN resolved USING (uuid))
, retry_b AS (SELECT cuid, series_number AS serial_number, contract_longitude AS longitude,
                contract_latitude AS latitude, 'retry-' || CAST(
              (row_number() OVER (ORDER BY bq_updated_time, uuid) - 1) // 500 + 1 AS VARCHAR) AS batch_label
              FROM again)
, work AS (SELECT *, cuid NOT IN (SELECT cuid FROM bad_owner) AS good
           FROM (SELECT * FROM new_b UNION ALL SELECT * FROM retry_b))"""

_RUN_VIEWS = ["cust", "app", "apply_info", "geo_done", "geo_dl"]

ORACLES["run_all"] = with_views(_RUN_VIEWS, _OPEN_SERIALS + _GEO_RETRY + _RUN + """
SELECT batch_label, CAST(count_if(good) AS BIGINT) AS success_count,
  CAST(count_if(NOT good) AS BIGINT) AS error_count, count(*) AS records
FROM work GROUP BY batch_label""")

ORACLES["run_all_zones"] = with_views(_RUN_VIEWS, _OPEN_SERIALS + _GEO_RETRY + _RUN + f"""
, {_PLACES}
, per AS (SELECT q.cuid, q.serial_number, good, s.scenario,
            (SELECT count(*) FROM places p WHERE p.scenario = s.scenario AND
             {_HAV.replace('q.lat', 'CAST(q.latitude AS DOUBLE)').replace('q.lon', 'CAST(q.longitude AS DOUBLE)')} <= 700.0) AS n
          FROM work q, scen s)
, landed AS (SELECT serial_number,
               max(n) FILTER (WHERE scenario = 'corporate_finance') AS a,
               max(n) FILTER (WHERE scenario = 'residential') AS b,
               max(n) FILTER (WHERE scenario = 'commercial') AS c
             FROM per WHERE good GROUP BY cuid, serial_number)
SELECT 'geo_raw' AS zone, CAST(serial_number AS VARCHAR) AS key, '{{"scenario_counts":{{"corporate_finance":"' || a
  || '","residential":"' || b || '","commercial":"' || c || '"}}}}' AS detail FROM landed
UNION ALL SELECT 'geo_raw', CAST(serial_number AS VARCHAR), '{{"scenario_counts":{{"residential":"1"}}}}' FROM seed
UNION ALL SELECT 'geo_landing', CAST(serial_number AS VARCHAR), NULL FROM landed
UNION ALL SELECT 'geo_features', CAST(serial_number AS VARCHAR), CAST(b AS VARCHAR) FROM landed
UNION ALL SELECT 'geo_features', CAST(serial_number AS VARCHAR), '1' FROM seed
  WHERE serial_number NOT IN (SELECT serial_number FROM landed)
UNION ALL SELECT 'geo_dead_letter', CAST(series_number AS VARCHAR),
  CASE WHEN uuid IN (SELECT uuid FROM resolved) THEN '200' ELSE api_status END FROM geo_dl
UNION ALL SELECT 'geo_dead_letter', CAST(serial_number AS VARCHAR), '503' FROM work WHERE NOT good
UNION ALL SELECT 'api_log', '200', CAST(count(*) FILTER (WHERE good OR scenario <> 'commercial') AS VARCHAR) FROM per
UNION ALL SELECT 'api_log', '503', CAST(n AS VARCHAR) FROM (SELECT count(*) AS n FROM work WHERE NOT good) WHERE n > 0
UNION ALL SELECT 'flow_log', unnest(['reconcile', 'enrich', 'retry', 'flatten']), 'SUCCESS'
UNION ALL SELECT 'outbox', 'anonymization', '{{"file_list": ["geo_features"]}}'""")

ORACLES["reconcile_zone"] = ORACLES["semi_reconcile"].replace("  coalesce(hit, false) AS reconciled\n", "") \
    .replace("END AS partition_date,", "END AS partition_date")

ORACLES["run_device"] = with_views(["dev_events", "dl"], f"""
, {_DEV_LOOKUP}
, work AS (SELECT lk.*, CASE lower(device_os) WHEN 'android' THEN 'android' WHEN 'ios' THEN 'ios' ELSE 'unrouted' END AS os
           FROM lk WHERE cuid IS NOT NULL)
, ok AS (SELECT * FROM work WHERE status = '200')
SELECT 'raw_' || os AS zone, CAST(reference_id AS VARCHAR) AS key, payload AS detail FROM ok
UNION ALL SELECT 'device_dead_letter', CAST(reference_id AS VARCHAR), '404' FROM work WHERE status = '404'
UNION ALL SELECT 'device_landing', CAST(reference_id AS VARCHAR), NULL FROM ok
UNION ALL SELECT 'device_features_' || os, CAST(reference_id AS VARCHAR), NULL FROM ok WHERE os <> 'unrouted'
UNION ALL SELECT 'api_log', status || CASE status WHEN '200' THEN '/Info' ELSE '/ERROR' END, CAST(count(*) AS VARCHAR)
  FROM work GROUP BY status
UNION ALL SELECT 'flow_log', unnest(['enrich/SUCCESS', 'flatten_android/SUCCESS', 'flatten_ios/SUCCESS']), '2'
UNION ALL SELECT 'outbox', 'anonymization', '{{"file_list": ["device_features_android", "device_features_ios"]}}'
  FROM range(2)""")

ORACLES["api_log"] = f"""WITH {_DEV_LOOKUP}
SELECT 'insights-' || CAST(lk.reference_id AS VARCHAR) AS uuid_request, 'device' AS api_type, 'insights' AS api_name,
  ts AS start_time, ts + INTERVAL 1500 MILLISECOND AS end_time, CAST(1500 AS BIGINT) AS duration_ms,
  CASE WHEN device_os IS NULL THEN 'skipped' ELSE status END AS status_code,
  CASE status WHEN '404' THEN 'not found' END AS status_detail,
  CASE WHEN device_os IS NOT NULL AND status = '404' THEN 'ERROR' ELSE 'Info' END AS severity, 0 AS retry
FROM lk JOIN events ON event_id = lk.reference_id"""

ORACLES["compact_zone"] = ORACLES["reconcile_zone"]
ORACLES["exclude_processed_sketch"] = ORACLES["exclude_processed"]
