"""DuckDB SQL for each catalog query — written independently of the Spark code.

The ``flights`` derivation is the integer-only view shared with the Spark
side; everything after it restates each operator's definition in SQL.
"""

from __future__ import annotations

_CARRIERS = "['AA', 'UA', 'DL', 'WN', 'B6', 'AS']"
_AIRPORTS = ("['ATL', 'ORD', 'LAX', 'DFW', 'DEN', 'JFK', 'SFO', 'SEA', 'LAS', 'MCO', "
             "'EWR', 'CLT', 'PHX', 'MIA', 'BOS', 'BZN', 'BNA', 'SLC', 'PDX', 'SAN']")

FLIGHTS = """
flights AS (
 WITH o AS (
  SELECT o_orderkey AS flight_id, o_custkey AS c, o_orderdate AS d,
         CAST((o_orderkey*7919) % 24 AS INT) AS h FROM orders
 ), g AS (
  SELECT flight_id, c, d, h, CAST(extract(month FROM d) AS INT) AS m FROM o
 )
 SELECT flight_id,
  CASE WHEN flight_id % 97 = 0 THEN 'not-a-date' ELSE strftime(d, '%d-%m-%Y') END AS FL_DATE,
  CASE WHEN flight_id % 101 = 0 THEN NULL
       WHEN flight_id % 89 = 0 THEN ' ' || lower(CARRIERS[c % 6 + 1]) || ' '
       ELSE CARRIERS[c % 6 + 1] END AS OP_CARRIER,
  AIRPORTS[c % 20 + 1] AS ORIGIN,
  AIRPORTS[(c + 1 + flight_id % 19) % 20 + 1] AS DEST,
  CAST(h*100 + c % 60 AS INT) AS CRS_DEP_TIME,
  CAST(((h+3) % 24)*100 + c % 60 AS INT) AS CRS_ARR_TIME,
  CASE WHEN flight_id % 53 = 0 THEN NULL
       ELSE CAST(30 + ((flight_id*31) % 2800) // 8 AS DOUBLE) END AS CRS_ELAPSED_TIME,
  CAST(200 + (flight_id*31) % 2800 AS DOUBLE) AS DISTANCE,
  CASE WHEN flight_id % 59 = 0 THEN NULL
       ELSE CAST((flight_id*11 + c*7) % 60 - 20 AS DOUBLE) END AS DEP_DELAY,
  CASE WHEN flight_id % 59 = 0 THEN NULL
       ELSE CAST((flight_id*17 + c*13) % 60 - 20
                 + CASE WHEN h >= 18 THEN 15 ELSE 0 END
                 + CASE WHEN m IN (6,7,11,12) THEN 8 ELSE 0 END AS DOUBLE) END AS ARR_DELAY
 FROM g
)""".replace("CARRIERS[", f"({_CARRIERS})[").replace("AIRPORTS[", f"({_AIRPORTS})[")

# features of every row of a frame ``src`` with the frame's own frequencies
def _base(src: str) -> str:
    return f"""
 SELECT *,
  CASE WHEN dep_hour0 IS NULL THEN 3 WHEN dep_hour0 < 6 THEN 0 WHEN dep_hour0 < 12 THEN 1
       WHEN dep_hour0 < 18 THEN 2 ELSE 3 END AS dep_time_bucket,
  CAST(coalesce(dow >= 5, false) AS INT) AS is_weekend,
  CAST(coalesce(mon IN (6,7,11,12), false) AS INT) AS is_holiday_season,
  CAST(round_even(coalesce(CRS_ELAPSED_TIME, km / 12.0), 0) AS INT) AS scheduled_elapsed_min
 FROM (
  SELECT *,
   CASE WHEN CRS_DEP_TIME IS NULL THEN NULL
        ELSE CAST(least(greatest(floor(CRS_DEP_TIME / 100), 0), 23) AS INT) END AS dep_hour0,
   CAST(isodow(dt) - 1 AS INT) AS dow,
   CAST(month(dt) AS INT) AS mon,
   ORIGIN || '_' || DEST AS route,
   round_even(DISTANCE * 1.60934, 1) AS km
  FROM (SELECT * REPLACE (upper(trim(OP_CARRIER)) AS OP_CARRIER, upper(trim(ORIGIN)) AS ORIGIN,
                          upper(trim(DEST)) AS DEST),
               CAST(coalesce(try_strptime(FL_DATE, '%d-%m-%Y'),
                                try_strptime(FL_DATE, '%Y-%m-%d')) AS DATE) AS dt FROM {src}) s0
 ) s1"""


def _freq(key: str) -> str:
    return (f"CAST(CASE WHEN {key} IS NULL THEN 0 "
            f"ELSE count(*) OVER (PARTITION BY {key}) END AS BIGINT)")


HUBS = "('ATL','ORD','LAX','DFW','DEN','JFK','SFO','SEA','LAS','MCO','EWR','CLT','PHX','MIA')"

FEATURE_SELECT = f"""
  dep_hour0 AS dep_hour, dow AS dep_day_of_week, mon AS dep_month,
  is_weekend, is_holiday_season,
  {_freq('OP_CARRIER')} AS carrier_encoded,
  {_freq('ORIGIN')} AS origin_encoded,
  {_freq('DEST')} AS dest_encoded,
  km AS route_distance_km, scheduled_elapsed_min, dep_time_bucket,
  CAST(coalesce(ORIGIN IN {HUBS}, false) AS INT) AS is_hub_origin,
  CAST(coalesce(DEST IN {HUBS}, false) AS INT) AS is_hub_dest,
  {_freq('route')} AS route_id_encoded"""

LABELLED = """
labelled AS (
 SELECT *, CAST(ARR_DELAY >= 15 AS INT) AS delayed FROM flights WHERE ARR_DELAY IS NOT NULL
)"""

FEATURES = f"""
features AS (
 SELECT flight_id, {FEATURE_SELECT}, delayed
 FROM ({_base('labelled')}) b
)"""

PREFIX = f"WITH {FLIGHTS},{LABELLED},{FEATURES}"


def sql(body: str) -> str:
    return f"{PREFIX}\n{body}"


ORACLE: dict[str, str] = {}

ORACLE["engineer_features"] = sql("SELECT * FROM features")

# ── stratified split: row_number inside each label stratum ───────────
TEST, VAL = 0.15, 0.15
VAL_REL = VAL / (1.0 - TEST)

SPLIT = f"""
split AS (
 SELECT * EXCLUDE (rn, n_s, t1),
  CASE WHEN rn <= t1 THEN 'test'
       WHEN rn <= t1 + floor(CAST({VAL_REL!r} AS DOUBLE) * (n_s - t1) + 0.5) THEN 'val'
       ELSE 'train' END AS split
 FROM (
  SELECT *, floor(CAST({TEST!r} AS DOUBLE) * n_s + 0.5) AS t1 FROM (
   SELECT *, row_number() OVER (PARTITION BY delayed
                  ORDER BY md5('42|' || CAST(flight_id AS VARCHAR)), flight_id) AS rn,
          count(*) OVER (PARTITION BY delayed) AS n_s
   FROM features) a) b
),
train AS (SELECT * FROM split WHERE split = 'train')"""

RULE = """
scored AS (
 SELECT *, CAST(rule_score >= 0.5 AS INT) AS rule_pred FROM (
  SELECT *, (dep_hour + 4 * is_holiday_season + 3 * is_weekend) / CAST(40 AS DOUBLE) AS rule_score
  FROM features) s
)"""

PREFIX2 = f"{PREFIX},{SPLIT},{RULE}"


def sql2(body: str) -> str:
    return f"{PREFIX2}\n{body}"


FEATURE_NAMES = ["dep_hour", "dep_day_of_week", "dep_month", "is_weekend", "is_holiday_season",
                 "carrier_encoded", "origin_encoded", "dest_encoded", "route_distance_km",
                 "scheduled_elapsed_min", "dep_time_bucket", "is_hub_origin", "is_hub_dest",
                 "route_id_encoded"]
RAW_NAMES = ["FL_DATE", "OP_CARRIER", "ORIGIN", "DEST", "CRS_DEP_TIME", "CRS_ARR_TIME",
             "CRS_ELAPSED_TIME", "DISTANCE", "DEP_DELAY", "ARR_DELAY"]

ORACLE["label_rate"] = sql("""
SELECT count(*) AS rows, CAST(sum(delayed) AS BIGINT) AS positives,
       round_even(avg(CAST(delayed AS DOUBLE)), 4) AS positive_rate FROM labelled""")

ORACLE["frequency_counts"] = sql("""
SELECT feature, key, count(*) AS n FROM (
 SELECT 'carrier_encoded' AS feature, upper(trim(OP_CARRIER)) AS key FROM labelled
 UNION ALL SELECT 'origin_encoded', ORIGIN FROM labelled
 UNION ALL SELECT 'dest_encoded', DEST FROM labelled
 UNION ALL SELECT 'route_id_encoded', ORIGIN || '_' || DEST FROM labelled) u
WHERE key IS NOT NULL GROUP BY feature, key""")

ORACLE["time_bucket_counts"] = sql(
    "SELECT dep_time_bucket, count(*) AS n FROM features GROUP BY dep_time_bucket")

ORACLE["hub_flags"] = sql(
    "SELECT is_hub_origin, is_hub_dest, count(*) AS n FROM features GROUP BY 1, 2")

ORACLE["quality_report"] = sql("""
, a AS (
 SELECT count(*) AS n, count(OP_CARRIER) AS c1, count(ORIGIN) AS c2, count(DEST) AS c3,
   count(CRS_DEP_TIME) AS c4, min(CRS_DEP_TIME) AS dmin, max(CRS_DEP_TIME) AS dmax,
   min(DISTANCE) AS dist_min, min(CRS_ELAPSED_TIME) AS el_min, min(length(OP_CARRIER)) AS clen,
   avg(CASE WHEN ARR_DELAY IS NOT NULL THEN CAST(ARR_DELAY >= 15 AS DOUBLE) END) AS rate,
   count(DISTINCT OP_CARRIER) AS nc, count(DISTINCT ORIGIN) AS no, count(DISTINCT FL_DATE) AS nd,
   stddev_samp(CRS_DEP_TIME) AS dstd
 FROM flights
), d AS (
 SELECT sum(k) AS n_rows, count(*) AS n_distinct FROM (
  SELECT count(*) AS k FROM flights
  GROUP BY FL_DATE, OP_CARRIER, ORIGIN, DEST, CRS_DEP_TIME, CRS_ARR_TIME, CRS_ELAPSED_TIME,
           DISTANCE, DEP_DELAY, ARR_DELAY) g
)
SELECT 'required_columns' AS rule, CAST(0 AS DOUBLE) AS observed, true AS passed
UNION ALL SELECT 'min_rows', n, n >= 100 FROM a
UNION ALL SELECT 'not_all_null_OP_CARRIER', c1, c1 > 0 FROM a
UNION ALL SELECT 'not_all_null_ORIGIN', c2, c2 > 0 FROM a
UNION ALL SELECT 'not_all_null_DEST', c3, c3 > 0 FROM a
UNION ALL SELECT 'not_all_null_CRS_DEP_TIME', c4, c4 > 0 FROM a
UNION ALL SELECT 'dep_time_min', dmin, coalesce(dmin >= 0, true) FROM a
UNION ALL SELECT 'dep_time_max', dmax, coalesce(dmax <= 2359, true) FROM a
UNION ALL SELECT 'numeric_CRS_DEP_TIME', 0, true
UNION ALL SELECT 'numeric_DISTANCE', 0, true
UNION ALL SELECT 'distance_positive', dist_min, coalesce(dist_min > 0, false) FROM a
UNION ALL SELECT 'elapsed_positive', el_min, coalesce(el_min > 0, false) FROM a
UNION ALL SELECT 'carrier_min_length', clen, coalesce(clen >= 2, false) FROM a
UNION ALL SELECT 'delay_rate_range', round_even(rate, 4), coalesce(rate BETWEEN 0.05 AND 0.60, false) FROM a
UNION ALL SELECT 'min_carriers', nc, nc >= 3 FROM a
UNION ALL SELECT 'min_origins', no, no >= 10 FROM a
UNION ALL SELECT 'min_dates', nd, nd >= 2 FROM a
UNION ALL SELECT 'dep_time_std', round_even(dstd, 4), coalesce(dstd > 100, false) FROM a
UNION ALL SELECT 'min_rows_strict', n, n >= 1000 FROM a
UNION ALL SELECT 'duplicate_fraction', round_even((n_rows - n_distinct) / CAST(n_rows AS DOUBLE), 6),
                 round_even((n_rows - n_distinct) / CAST(n_rows AS DOUBLE), 6) < 0.05 FROM d
""".replace("\n, a AS", ", a AS", 1))

_REQ_CHECKS = [f"CASE WHEN {c} IS NULL THEN 'missing_{c}' END" for c in
               ["FL_DATE", "OP_CARRIER", "ORIGIN", "DEST", "CRS_DEP_TIME", "CRS_ARR_TIME",
                "CRS_ELAPSED_TIME", "DISTANCE"]] + [
    "CASE WHEN NOT (CRS_DEP_TIME BETWEEN 0 AND 2359) THEN 'range_CRS_DEP_TIME' END",
    "CASE WHEN NOT (CRS_ARR_TIME BETWEEN 0 AND 2359) THEN 'range_CRS_ARR_TIME' END",
    "CASE WHEN CRS_ELAPSED_TIME <= 0 THEN 'nonpositive_CRS_ELAPSED_TIME' END",
    "CASE WHEN DISTANCE <= 0 THEN 'nonpositive_DISTANCE' END",
    "CASE WHEN length(upper(trim(OP_CARRIER))) = 0 THEN 'empty_OP_CARRIER' END",
    "CASE WHEN NOT (length(upper(trim(ORIGIN))) BETWEEN 2 AND 4) THEN 'code_length_ORIGIN' END",
    "CASE WHEN NOT (length(upper(trim(DEST))) BETWEEN 2 AND 4) THEN 'code_length_DEST' END",
]

ORACLE["quarantine"] = sql(f"""
SELECT flight_id, errors FROM (
 SELECT flight_id, concat_ws(';', {', '.join(_REQ_CHECKS)}) AS errors FROM flights) q
WHERE errors <> ''""")

ORACLE["feature_profile"] = sql2("\nUNION ALL ".join(
    f"""SELECT '{c}' AS feature, round_even(avg(CAST({c} AS DOUBLE)), 4) AS mean,
  round_even(stddev_samp(CAST({c} AS DOUBLE)), 4) AS std,
  round_even(min(CAST({c} AS DOUBLE)), 4) AS min, round_even(max(CAST({c} AS DOUBLE)), 4) AS max,
  round_even(avg(CAST({c} IS NULL AS DOUBLE)), 4) AS null_pct FROM train""" for c in FEATURE_NAMES))

_Q = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
_QCOLS = ", ".join(
    f"min(CASE WHEN cum >= greatest(ceil(CAST({p!r} AS DOUBLE) * n), 1) THEN value END) "
    f"AS p{int(round(p * 100)):02d}" for p in _Q)
ORACLE["baseline_quantiles"] = sql2(f"""
, long AS (
 {' UNION ALL '.join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM train" for c in FEATURE_NAMES)}
), hist AS (
 SELECT feature, value, count(*) AS cnt FROM long WHERE value IS NOT NULL GROUP BY 1, 2
), cum AS (
 SELECT *, sum(cnt) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS cum,
        sum(cnt) OVER (PARTITION BY feature) AS n FROM hist
)
SELECT feature, CAST(max(n) AS BIGINT) AS n, {_QCOLS} FROM cum GROUP BY feature""".replace("\n, long", ", long", 1))

ORACLE["baseline_constraints"] = sql2("\nUNION ALL ".join(
    f"""SELECT '{c}' AS feature, round_even(count({c}) / CAST(count(*) AS DOUBLE), 4) AS completeness,
  coalesce(min({c}) >= 0, true) AS non_negative,
  CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM train""" for c in FEATURE_NAMES))

ORACLE["null_counts"] = sql("\nUNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count(*) - count({c}) AS BIGINT) AS nulls, "
    f"count({c}) = 0 AS all_null FROM flights" for c in RAW_NAMES))


def _dup(table: str, cols: str) -> str:
    return f"""
SELECT CAST(n_rows AS BIGINT) AS n_rows, n_distinct, CAST(n_rows - n_distinct AS BIGINT) AS dup_rows,
  round_even(coalesce((n_rows - n_distinct) / CAST(n_rows AS DOUBLE), 0.0), 6) AS dup_fraction
FROM (SELECT sum(k) AS n_rows, count(*) AS n_distinct FROM (
  SELECT count(*) AS k FROM {table} GROUP BY {cols}) g) t"""


ORACLE["dup_fraction_lineitem"] = _dup(
    "lineitem", "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
                "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")
ORACLE["dup_fraction_flights"] = sql(_dup("flights", ", ".join(RAW_NAMES)))

ORACLE["split_assign"] = sql2("SELECT flight_id, delayed, split FROM split")

ORACLE["split_counts"] = sql2("""
SELECT split, count(*) AS rows, CAST(sum(delayed) AS BIGINT) AS positives,
       round_even(avg(CAST(delayed AS DOUBLE)), 4) AS positive_rate FROM split GROUP BY split""")

ORACLE["reference_sample"] = sql2(f"""
SELECT flight_id, {', '.join(FEATURE_NAMES)}, delayed FROM train
ORDER BY md5('42|' || CAST(flight_id AS VARCHAR)), flight_id LIMIT 5000""")


def _metrics(by: str = "") -> str:
    sel = f"{by}, " if by else ""
    grp = f"GROUP BY {by}" if by else ""
    return f"""
SELECT {sel}n, tp, fp, fn, tn,
  round_even(coalesce((tp + tn) / CAST(nullif(n, 0) AS DOUBLE), 0.0), 4) AS accuracy,
  round_even(coalesce(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 0.0), 4) AS precision,
  round_even(coalesce(tp / CAST(nullif(tp + fn, 0) AS DOUBLE), 0.0), 4) AS recall,
  round_even(coalesce(2 * tp / CAST(nullif(2 * tp + fp + fn, 0) AS DOUBLE), 0.0), 4) AS f1
FROM (SELECT {sel}count(*) AS n,
  CAST(sum(CASE WHEN delayed = 1 AND rule_pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
  CAST(sum(CASE WHEN delayed = 0 AND rule_pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
  CAST(sum(CASE WHEN delayed = 1 AND rule_pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
  CAST(sum(CASE WHEN delayed = 0 AND rule_pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn
 FROM scored {grp}) c"""


ORACLE["binary_metrics"] = sql2(_metrics())
ORACLE["segment_metrics"] = sql2(_metrics("dep_time_bucket"))


def _auc(by: str = "") -> str:
    sel = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    grp = f"GROUP BY {by}" if by else ""
    return f"""
, ps AS (
 SELECT {sel}rule_score, sum(CASE WHEN delayed = 1 THEN 1 ELSE 0 END) AS pos,
        sum(CASE WHEN delayed <> 1 THEN 1 ELSE 0 END) AS neg
 FROM scored WHERE rule_score IS NOT NULL AND delayed IS NOT NULL GROUP BY {sel}rule_score
), c AS (
 SELECT *, coalesce(sum(neg) OVER ({part} ORDER BY rule_score
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM ps
)
SELECT {sel}CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives,
  round_even(sum(pos * (2 * below + neg)) / (2.0 * sum(pos) * sum(neg)), 4) AS auc
FROM c {grp}""".replace("\n, ps AS", ", ps AS", 1)


ORACLE["roc_auc"] = sql2(_auc())
ORACLE["segment_roc_auc"] = sql2(_auc("is_holiday_season"))

ORACLE["risk_confidence"] = sql2("""
SELECT s.flight_id, rule_pred AS delayed, p AS delay_probability,
  CASE WHEN p < 0.25 THEN 'LOW' WHEN p < 0.55 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level,
  CASE WHEN abs(p - 0.5) >= 0.35 THEN 'HIGH' WHEN abs(p - 0.5) >= 0.15 THEN 'MEDIUM' ELSE 'LOW' END AS confidence,
  f.ORIGIN || '-' || f.DEST || ' ' || upper(trim(f.OP_CARRIER)) AS flight
FROM (SELECT *, round_even(rule_score, 4) AS p FROM scored) s JOIN flights f USING (flight_id)""")

ORACLE["batch_summary"] = sql2("""
SELECT count(*) AS total, CAST(coalesce(sum(rule_pred), 0) AS BIGINT) AS delayed_count FROM scored""")

# ── registry / routing / monitoring over tables derived from events ──
REGISTRY = """
registry AS (
 SELECT event_id AS package_id,
  CASE user_id % 4 WHEN 0 THEN 'flight-delay-model-group' WHEN 1 THEN 'flight-delay-model-group'
                   WHEN 2 THEN 'ranking-model-group' ELSE 'churn-model-group' END AS group_name,
  CASE event_type WHEN 'purchase' THEN 'Approved' WHEN 'signup' THEN 'Rejected'
       WHEN 'view' THEN 'PendingManualApproval' WHEN 'click' THEN 'PendingManualApproval'
       WHEN 'error' THEN 'Failed' ELSE 'PendingManualApproval' END AS status,
  ts AS created_at,
  CASE WHEN event_id % 23 = 0 THEN ''
       ELSE 's3://flight-delay-artifacts/evaluation/' || CAST(event_id AS VARCHAR) || '/comparison.json'
  END AS metrics_uri,
  CASE WHEN event_id % 11 = 0 THEN NULL
       ELSE CAST(floor(value * 100) AS BIGINT) % 10000 END AS f1_bp
 FROM events
),
pkg AS (
 SELECT *, CASE WHEN metrics_uri <> '' AND f1_bp IS NOT NULL
                THEN CAST('0.' || lpad(CAST(f1_bp AS VARCHAR), 4, '0') AS DOUBLE) END AS val_f1
 FROM registry
),
latest_approved AS (
 SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY group_name
                ORDER BY created_at DESC, package_id DESC) AS rn FROM pkg WHERE status = 'Approved') a
 WHERE rn = 1
),
latest_pending AS (
 SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY group_name
                ORDER BY created_at DESC, package_id DESC) AS rn FROM pkg
                WHERE status = 'PendingManualApproval') a WHERE rn = 1
),
cmp AS (
 SELECT c.group_name, c.package_id AS challenger_package, p.package_id AS champion_package,
   coalesce(c.val_f1, 0.0) AS challenger_score, coalesce(p.val_f1, 0.0) AS champion_score
 FROM latest_pending c
 LEFT JOIN latest_approved p USING (group_name)
)"""

PREFIX_REG = f"WITH {REGISTRY}"

ORACLE["latest_approved"] = PREFIX_REG + """
SELECT group_name, package_id, created_at,
  regexp_extract(metrics_uri, '^s3://([^/]+)/(.*)$', 1) AS metrics_bucket,
  regexp_extract(metrics_uri, '^s3://([^/]+)/(.*)$', 2) AS metrics_key, val_f1
FROM latest_approved"""

ORACLE["compare_champion"] = PREFIX_REG + """
SELECT group_name, challenger_package, champion_package, challenger_score, champion_score,
  round_even(challenger_score - champion_score, 4) AS improvement,
  (challenger_score - champion_score) >= 0.01 AS beats_champion
FROM cmp"""

ORACLE["decision_json"] = PREFIX_REG + """
SELECT group_name, challenger_package,
  CASE WHEN (challenger_score - champion_score) >= 0.01 THEN 1.0 ELSE 0.0 END AS beats_value,
  challenger_score AS challenger_f1,
  round_even(challenger_score - champion_score, 4) AS improvement
FROM cmp"""

ORACLE["register_candidates"] = PREFIX_REG + """
SELECT c.group_name, c.challenger_package AS package_id, 'PendingManualApproval' AS status,
  's3://flight-delay-artifacts/models/' || CAST(c.challenger_package AS VARCHAR) || '/model.tar.gz' AS model_uri,
  r.metrics_uri
FROM cmp c JOIN registry r ON r.package_id = c.challenger_package
WHERE (challenger_score - champion_score) >= 0.01"""

ORACLE["approval_route"] = PREFIX_REG + """
, a AS (
 SELECT package_id AS event_id,
  CASE WHEN package_id % 13 = 0 THEN ''
       ELSE 'arn:aws:sagemaker:us-east-1:000000000000:model-package/' || group_name || '/'
            || CAST(package_id AS VARCHAR) END AS package_arn,
  group_name AS package_group, status AS approval_status
 FROM registry
)
SELECT event_id, package_arn, package_group, approval_status,
  (approval_status = 'Approved' AND package_group = 'flight-delay-model-group') AS rule_match,
  CASE WHEN package_arn = '' THEN 400 ELSE 200 END AS status_code,
  CASE WHEN package_arn = '' THEN 'missing_arn'
       WHEN package_group <> 'flight-delay-model-group' THEN 'skip_group'
       WHEN approval_status <> 'Approved' THEN 'skip_status' ELSE 'deploy' END AS outcome
FROM a""".replace("\n, a AS", ", a AS", 1)

ORACLE["object_route"] = """
WITH o AS (
 SELECT event_id,
  CASE WHEN user_id % 17 = 0 THEN '' ELSE 'flight-delay-data' END AS bucket,
  CASE event_type WHEN 'purchase' THEN 'data/raw/flights_' || CAST(event_id AS VARCHAR) || '.csv'
                  WHEN 'view' THEN 'data/raw/flights_' || CAST(event_id AS VARCHAR) || '.json'
                  WHEN 'click' THEN 'models/' || CAST(event_id AS VARCHAR) || '.csv'
                  WHEN 'signup' THEN 'data/raw/2024/' || CAST(event_id AS VARCHAR) || '.csv'
                  ELSE '' END AS key
 FROM events
)
SELECT event_id, bucket, key,
  (starts_with(key, 'data/raw/') AND bucket = 'flight-delay-data') AS rule_match,
  CASE WHEN bucket = '' OR key = '' THEN 400 ELSE 200 END AS status_code,
  CASE WHEN bucket = '' OR key = '' THEN 'missing_bucket_or_key'
       WHEN NOT (starts_with(key, 'data/raw/') AND ends_with(key, '.csv')) THEN 'skipped'
       ELSE 'triggered' END AS outcome
FROM o"""

MONITOR = """
WITH cap AS (
 SELECT ts AS captured_at, value AS v_value, CAST(value AS VARCHAR) AS t_value,
  TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS v_k, json_extract_string(props, '$.k') AS t_k,
  CAST(user_id AS DOUBLE) AS v_user_id, CAST(user_id AS VARCHAR) AS t_user_id
 FROM events
), long AS (
 SELECT captured_at, 'value' AS feature, v_value AS value, t_value AS text FROM cap
 UNION ALL SELECT captured_at, 'k', v_k, t_k FROM cap
 UNION ALL SELECT captured_at, 'user_id', v_user_id, t_user_id FROM cap
), cut AS (
 SELECT date_trunc('day', min(captured_at)) + INTERVAL 7 DAY AS c FROM cap
), ref AS (
 SELECT feature, avg(value) AS mean0, stddev_samp(value) AS std0,
        avg(CAST(value IS NULL AS DOUBLE)) AS null_frac0
 FROM long, cut WHERE captured_at < c GROUP BY feature
), stats AS (
 SELECT CAST(date_trunc('day', captured_at) AS DATE) AS day, feature, count(*) AS n,
   CAST(sum(CAST(value IS NULL AS INT)) AS BIGINT) AS nulls,
   CAST(sum(CAST(text IS NOT NULL AND value IS NULL AS INT)) AS BIGINT) AS type_errors,
   avg(value) AS mean, stddev_samp(value) AS std
 FROM long, cut WHERE captured_at >= c GROUP BY 1, 2
), viol AS (
 SELECT day, feature, 'baseline_drift' AS "check", round_even(mean, 4) AS observed,
        round_even(mean0, 4) AS baseline
 FROM stats JOIN ref USING (feature) WHERE abs(mean - mean0) / std0 > 0.1
 UNION ALL
 SELECT day, feature, 'missing_values', round_even(nulls / CAST(n AS DOUBLE), 4), round_even(null_frac0, 4)
 FROM stats JOIN ref USING (feature) WHERE nulls / CAST(n AS DOUBLE) > null_frac0 + 0.05
 UNION ALL
 SELECT day, feature, 'data_type_errors', CAST(type_errors AS DOUBLE), 0.0
 FROM stats JOIN ref USING (feature) WHERE type_errors > 0
)"""

ORACLE["daily_stats"] = MONITOR + """
SELECT day, feature, n, nulls, type_errors, round_even(mean, 4) AS mean, round_even(std, 4) AS std
FROM stats"""

ORACLE["daily_drift"] = MONITOR + "\nSELECT * FROM viol"

ORACLE["drift_alarm"] = MONITOR + """
SELECT d.day, CAST(coalesce(v.k, 0) AS BIGINT) AS drift_count, coalesce(v.k, 0) >= 1 AS alarm
FROM (SELECT DISTINCT day FROM stats) d
LEFT JOIN (SELECT day, count(*) AS k FROM viol WHERE "check" = 'baseline_drift' GROUP BY day) v
USING (day)"""

ORACLE["served_stats"] = """
SELECT count(*) AS predictions_served, max(ts) AS last_prediction FROM events"""

ORACLE["stream_daily_stats"] = MONITOR.replace("WHERE captured_at >= c GROUP BY 1, 2",
                                               "GROUP BY 1, 2") + """
SELECT day, feature, n, nulls, type_errors, round_even(mean, 4) AS mean, round_even(std, 4) AS std
FROM stats"""

ORACLE["stream_landing"] = sql("""
SELECT flight_id, FL_DATE, trim(OP_CARRIER) AS OP_CARRIER, ORIGIN, DEST, CRS_DEP_TIME, CRS_ARR_TIME,
  CRS_ELAPSED_TIME, DISTANCE, DEP_DELAY, ARR_DELAY, delayed
FROM labelled""")

_PSI_P = [i / 10 for i in range(1, 10)]
_EDGE_COLS = ", ".join(
    f"min(CASE WHEN cum >= greatest(ceil(CAST({p!r} AS DOUBLE) * n), 1) THEN value END) AS e{i}"
    for i, p in enumerate(_PSI_P, start=1))
_BIN = " + ".join(f"CAST(l.value > e.e{i} AS INT)" for i in range(1, 10))

ORACLE["daily_psi"] = MONITOR + f"""
, bh AS (
 SELECT feature, value, count(*) AS cnt FROM long, cut
 WHERE captured_at < c AND value IS NOT NULL GROUP BY 1, 2
), bc AS (
 SELECT *, sum(cnt) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS cum,
        sum(cnt) OVER (PARTITION BY feature) AS n FROM bh
), edges AS (
 SELECT feature, {_EDGE_COLS} FROM bc GROUP BY feature
), binned AS (
 SELECT l.captured_at, l.feature, ({_BIN}) AS bin, l.captured_at < cut.c AS is_base
 FROM long l JOIN edges e USING (feature), cut WHERE l.value IS NOT NULL
), expected AS (
 SELECT feature, bin, cnt / CAST(sum(cnt) OVER (PARTITION BY feature) AS DOUBLE) AS e FROM (
  SELECT feature, bin, count(*) AS cnt FROM binned WHERE is_base GROUP BY 1, 2) x
), actual AS (
 SELECT CAST(date_trunc('day', captured_at) AS DATE) AS day, feature, bin, count(*) AS c
 FROM binned WHERE NOT is_base GROUP BY 1, 2, 3
), totals AS (
 SELECT day, feature, sum(c) AS n FROM actual GROUP BY 1, 2
), grid AS (
 SELECT day, feature, n, b.bin FROM totals, (SELECT range AS bin FROM range(0, 10)) b
), terms AS (
 SELECT g.day, g.feature,
   greatest(coalesce(a.c, 0) / CAST(g.n AS DOUBLE), 0.0001) AS pa,
   greatest(coalesce(x.e, 0.0), 0.0001) AS pe
 FROM grid g LEFT JOIN actual a ON a.day = g.day AND a.feature = g.feature AND a.bin = g.bin
 LEFT JOIN expected x ON x.feature = g.feature AND x.bin = g.bin
)
SELECT day, feature, round_even(sum((pa - pe) * ln(pa / pe)), 4) AS psi FROM terms GROUP BY 1, 2"""


# ── champion loop ────────────────────────────────────────────────────
ORACLE["champion_loop"] = PREFIX_REG + """
SELECT group_name, k AS case, round_even((coalesce(val_f1, 0.0) + d) - coalesce(val_f1, 0.0), 4) AS improvement,
  (coalesce(val_f1, 0.0) + d) - coalesce(val_f1, 0.0) >= 0.01 AS beats_champion
FROM latest_pending,
 (VALUES ('equal', CAST(0.0 AS DOUBLE)), ('worse', CAST(-0.05 AS DOUBLE)), ('better', CAST(0.05 AS DOUBLE))) v(k, d)"""

# ── CSV files in several layouts ─────────────────────────────────────
ORACLE["csv_roundtrip"] = sql(f"""
SELECT flight_id, {', '.join('trim(OP_CARRIER) AS OP_CARRIER' if c == 'OP_CARRIER' else c for c in RAW_NAMES)},
  CAST(0 AS BIGINT) AS type_errors FROM flights""")

# ── captured flights against the baseline of the training rows ───────
_KEYS = {"carrier_encoded": "OP_CARRIER", "origin_encoded": "ORIGIN", "dest_encoded": "DEST",
         "route_id_encoded": "route"}


def _encoded(src: str) -> str:
    """The features of ``src`` (base columns) with the counts of the training rows."""
    plain = {"dep_hour": "dep_hour0", "dep_day_of_week": "dow", "dep_month": "mon", "route_distance_km": "km",
             "is_hub_origin": f"CAST(coalesce(ORIGIN IN {HUBS}, false) AS INT)",
             "is_hub_dest": f"CAST(coalesce(DEST IN {HUBS}, false) AS INT)"}
    cols = ", ".join(f"CAST(coalesce(n_{f}.n, 0) AS DOUBLE) AS {f}" if f in _KEYS
                     else f"CAST({plain.get(f, f)} AS DOUBLE) AS {f}" for f in FEATURE_NAMES)
    joins = " ".join(f"LEFT JOIN n_{f} ON n_{f}.k = b.{k}" for f, k in _KEYS.items())
    return f"SELECT b.flight_id, {cols} FROM {src} b {joins}"


_COUNTS = ", ".join(f"n_{f} AS (SELECT {k} AS k, count(*) AS n FROM train_base WHERE {k} IS NOT NULL GROUP BY 1)"
                    for f, k in _KEYS.items())
_LONG = " UNION ALL ".join(f"SELECT flight_id, '{f}' AS feature, {f} AS value FROM {{src}}" for f in FEATURE_NAMES)

CHECKS = f"""{PREFIX2},
train_base AS (SELECT b.* FROM ({_base('labelled')}) b JOIN train t ON t.flight_id = b.flight_id),
all_base AS ({_base('flights')}),
{_COUNTS},
ft AS ({_encoded('train_base')}), fa AS ({_encoded('all_base')}),
lt AS ({_LONG.format(src='ft')}), la AS ({_LONG.format(src='fa')}),
prof AS (
 SELECT feature, round_even(avg(value), 4) AS mean0, round_even(stddev_samp(value), 4) AS std0,
   round_even(avg(CAST(value IS NULL AS DOUBLE)), 4) AS null0,
   round_even(count(value) / CAST(count(*) AS DOUBLE), 4) AS completeness,
   coalesce(min(value) >= 0, true) AS non_negative, min(value) AS min0, max(value) AS max0,
   coalesce(bool_and(value = floor(value)), false) AS integral
 FROM lt GROUP BY feature
), st AS (
 SELECT CAST(DATE '2024-01-01' + CAST(flight_id % 14 AS INT) AS DATE) AS day, feature, count(*) AS n,
   count(*) - count(value) AS nulls, avg(value) AS mean, min(value) AS lo, max(value) AS hi,
   count(*) FILTER (value <> floor(value)) AS fractions
 FROM la GROUP BY 1, 2
), bh AS (SELECT feature, value, count(*) AS cnt FROM lt WHERE value IS NOT NULL GROUP BY 1, 2),
bc AS (
 SELECT *, sum(cnt) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS cum,
        sum(cnt) OVER (PARTITION BY feature) AS n FROM bh
), edges AS (SELECT feature, {_EDGE_COLS} FROM bc GROUP BY feature),
b0 AS (SELECT feature, {_BIN} AS bin, count(*) AS c FROM lt l JOIN edges e USING (feature)
       WHERE value IS NOT NULL GROUP BY 1, 2),
grid0 AS (SELECT e.feature, g.bin, coalesce(b0.c, 0) AS c0 FROM (SELECT feature FROM edges) e, range(0, 10) g(bin)
          LEFT JOIN b0 ON b0.feature = e.feature AND b0.bin = g.bin),
b1 AS (SELECT CAST(DATE '2024-01-01' + CAST(flight_id % 14 AS INT) AS DATE) AS day, feature, {_BIN} AS bin, count(*) AS c
       FROM la l JOIN edges e USING (feature) WHERE value IS NOT NULL GROUP BY 1, 2, 3),
tot AS (SELECT day, feature, sum(c) AS n1 FROM b1 GROUP BY 1, 2),
share AS (
 SELECT tot.day, tot.feature, greatest(coalesce(b1.c, 0) / CAST(n1 AS DOUBLE), 1e-4) AS a,
   greatest(c0 / CAST(sum(c0) OVER (PARTITION BY tot.day, tot.feature) AS DOUBLE), 1e-4) AS e
 FROM tot JOIN grid0 ON grid0.feature = tot.feature
 LEFT JOIN b1 ON b1.day = tot.day AND b1.feature = tot.feature AND b1.bin = grid0.bin
), psi AS (SELECT day, feature, round_even(sum((a - e) * ln(a / e)), 4) AS psi FROM share GROUP BY 1, 2
), j AS (
 SELECT *, abs(mean - mean0) AS shift, nulls / CAST(n AS DOUBLE) AS nf FROM st JOIN prof USING (feature)
), checked AS (
 SELECT day, feature, 'baseline_drift' AS "check",
   coalesce(CASE WHEN coalesce(std0, 0) = 0 THEN shift > 0 ELSE shift / nullif(std0, 0) > 0.1 END, false) AS failed,
   round_even(mean, 4) AS observed, round_even(mean0, 4) AS baseline FROM j
 UNION ALL SELECT day, feature, 'missing_values', coalesce(nf > null0 + 0.05, false), round_even(nf, 4),
   round_even(null0, 4) FROM j
 UNION ALL SELECT day, feature, 'data_type_errors', false, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM j
 UNION ALL SELECT day, feature, 'completeness', coalesce(1 - nf < completeness - 0.05, false),
   round_even(1 - nf, 4), completeness FROM j
 UNION ALL SELECT day, feature, 'non_negative', coalesce(non_negative AND lo < 0, false), lo, CAST(0 AS DOUBLE) FROM j
 UNION ALL SELECT day, feature, 'range_min', coalesce(lo < min0, false), round_even(lo, 4), round_even(min0, 4) FROM j
 UNION ALL SELECT day, feature, 'range_max', coalesce(hi > max0, false), round_even(hi, 4), round_even(max0, 4) FROM j
 UNION ALL SELECT day, feature, 'data_type', coalesce(integral AND fractions > 0, false), CAST(fractions AS DOUBLE),
   CAST(0 AS DOUBLE) FROM j
 UNION ALL SELECT day, feature, 'psi', coalesce(psi > 0.2, false), psi, CAST(0.2 AS DOUBLE)
   FROM j LEFT JOIN psi USING (day, feature)
)"""

ORACLE["flight_drift"] = CHECKS + """
SELECT * FROM checked WHERE "check" IN ('baseline_drift', 'missing_values', 'data_type_errors')"""
ORACLE["flight_constraints"] = CHECKS + """
SELECT * FROM checked WHERE "check" IN ('completeness', 'non_negative', 'range_min', 'range_max', 'data_type')"""
ORACLE["flight_psi"] = CHECKS + """
SELECT * FROM checked WHERE "check" = 'psi'"""
ORACLE["flight_bins"] = CHECKS + """
SELECT feature, bin, CAST(c0 AS BIGINT) AS rows FROM grid0"""
ORACLE["flight_alarm"] = CHECKS + """
SELECT day, count(DISTINCT feature) FILTER ("check" IN ('baseline_drift', 'psi') AND failed) AS drift_count,
  coalesce(bool_or("check" IN ('baseline_drift', 'psi') AND failed), false) AS alarm FROM checked GROUP BY day"""

# ── model queries: what must hold of the trees' output ───────────────
ORACLE["train_metrics"] = sql2("""
SELECT count(*) AS n, CAST(sum(delayed) AS BIGINT) AS positives, true AS cells_add_up, true AS ratios_follow,
  true AS auc_in_range FROM split WHERE split = 'val'""")
ORACLE["feature_importance"] = (
    "SELECT unnest([" + ", ".join(f"'{c}'" for c in FEATURE_NAMES) + "]) AS feature, "
    "true AS is_share, true AS is_ranked")
ORACLE["tree_walk"] = sql2(
    "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS differ FROM split WHERE split = 'val'")
ORACLE["importance_of_gains"] = (
    "SELECT unnest([" + ", ".join(f"'{c}'" for c in FEATURE_NAMES) + "]) AS feature, true AS agrees")
ORACLE["planted_fit"] = sql2(f"""
, b AS (SELECT b.*, s.split FROM ({_base('labelled')}) b JOIN split s ON s.flight_id = b.flight_id
        WHERE dep_hour0 IS NOT NULL AND mon IS NOT NULL),
t AS (
 SELECT (max(dep_hour0) FILTER (dep_hour0 < 15) + min(dep_hour0) FILTER (dep_hour0 >= 15)) / 2.0::DOUBLE AS hour,
   (max(mon) FILTER (mon <= 6) + min(mon) FILTER (mon > 6)) / 2.0::DOUBLE AS month FROM b WHERE split = 'train'),
v AS (SELECT count(*) AS rows, count(*) FILTER (dep_hour0 >= 15 AND mon <= 6) AS predicted, count(*) AS "right"
      FROM b WHERE split = 'val')
SELECT CAST(0 AS BIGINT) AS split, 'dep_hour' AS feature, hour AS threshold, v.* FROM t, v
UNION ALL SELECT CAST(1 AS BIGINT), 'dep_month', month, v.* FROM t, v""")
ORACLE["quality_gates"] = """
SELECT * FROM (VALUES ('accuracy', CAST(0.7 AS DOUBLE), true), ('f1', CAST(0.55 AS DOUBLE), true),
                      ('auc', CAST(0.7 AS DOUBLE), true)) t(gate, threshold, flag_follows)"""
ORACLE["run_record"] = """
SELECT CAST(5 AS BIGINT) AS n_params, 'GBTClassifier' AS model_type, CAST(5 AS BIGINT) AS n_metrics,
  true AS has_run_id, true AS has_model_uri"""
ORACLE["model_roundtrip"] = sql2(
    "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS changed FROM split WHERE split = 'val'")
ORACLE["behaviour_checks"] = sql2("""
SELECT count(*) AS pairs, true AS classes_ok, true AS probabilities_ok, true AS sums_ok,
  true AS evening_not_lower FROM split WHERE split = 'val'""")


def _scoring(id_col: str) -> str:
    return sql(f"""
SELECT flight_id AS {id_col}, CASE WHEN errors = '' THEN 'scored' ELSE 'rejected' END AS outcome,
  CASE WHEN errors = '' THEN ORIGIN || '-' || DEST || ' ' || upper(trim(OP_CARRIER)) END AS flight,
  CASE WHEN errors = '' THEN true END AS tiers_follow, CASE WHEN errors = '' THEN true END AS in_range
FROM (SELECT *, concat_ws(';', {', '.join(_REQ_CHECKS)}) AS errors FROM flights) q""")


ORACLE["score_flights"] = _scoring("flight_id")
ORACLE["stream_scoring_capture"] = _scoring("request_id")
