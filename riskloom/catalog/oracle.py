"""The registered queries in plain SQL over the provided tables."""

from __future__ import annotations

import re

from riskloom.plans.evaluate import MODEL_LABELS
from riskloom.sources.schemas import MERCHANT_CATEGORIES

# Named building blocks; each may use the ones it mentions.
PARTS: dict[str, str] = {}

PARTS["ev"] = """
SELECT e.event_id, e.user_id, e.ts, e.value, e.event_type, c.c_nationkey AS hk,
       CAST(regexp_extract(e.props, '[0-9]+') AS INTEGER) AS k
FROM events e JOIN customer c ON e.user_id = c.c_custkey"""

PARTS["placed"] = "SELECT *, CASE WHEN k >= 98 OR k < 3 THEN (hk + 7) % 25 ELSE hk END AS nk FROM ev"


def _lpad(prefix: str, number: str, width: int) -> str:
    return f"'{prefix}' || lpad(CAST({number} AS VARCHAR), {width}, '0')"


_CATEGORY = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(MERCHANT_CATEGORIES))

PARTS["fact"] = f"""
SELECT {_lpad('TXN', 'event_id', 8)} AS transaction_id,
       {_lpad('C', 'user_id', 6)} AS customer_id,
       CASE WHEN k IN (96, 98, 99) THEN {_lpad('X', 'event_id', 7)}
            ELSE {_lpad('D', '(user_id * 3 + event_id % 3)', 7)} END AS device_id,
       ts AS txn_timestamp,
       CAST(greatest(CASE WHEN k = 96 THEN CAST(1.0 AS DOUBLE) WHEN k = 97 THEN value * CAST(8.0 AS DOUBLE)
                     ELSE value END, CAST(0.5 AS DOUBLE)) AS DECIMAL(12,2)) AS amount,
       CASE k % 10 {_CATEGORY} END AS merchant_category,
       CASE WHEN k % 2 = 0 THEN 'online' ELSE 'in_store' END AS channel,
       n.n_name AS city,
       {_lpad('', 'nk', 2)} AS state,
       CAST(24.0 AS DOUBLE) + CAST(0.9 AS DOUBLE) * nk + ((event_id * 37) % 81 - 40) / CAST(1000.0 AS DOUBLE) AS latitude,
       CAST(-120.0 AS DOUBLE) + CAST(2.1 AS DOUBLE) * nk + ((event_id * 53) % 81 - 40) / CAST(1000.0 AS DOUBLE) AS longitude,
       k >= 95 AS is_fraud,
       CASE k WHEN 95 THEN 'friendly_fraud' WHEN 96 THEN 'card_testing' WHEN 97 THEN 'high_value_spend'
              WHEN 98 THEN 'account_takeover' WHEN 99 THEN 'impossible_travel' END AS fraud_scenario,
       event_type, value
FROM placed JOIN nation n ON nk = n.n_nationkey"""

PARTS["people"] = f"""
SELECT {_lpad('C', 'c_custkey', 6)} AS customer_id, n_name AS home_city, {_lpad('', 'c_nationkey', 2)} AS home_state,
       CAST(24.0 AS DOUBLE) + CAST(0.9 AS DOUBLE) * c_nationkey AS home_latitude,
       CAST(-120.0 AS DOUBLE) + CAST(2.1 AS DOUBLE) * c_nationkey AS home_longitude,
       18 + c_custkey % 60 AS age, lower(c_mktsegment) AS customer_segment,
       DATE '2015-01-01' + CAST(c_custkey % 2900 AS INTEGER) AS signup_date
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

PARTS["gear"] = """
SELECT device_id, customer_id, min(txn_timestamp) AS first_seen_at,
       CASE CAST(substr(device_id, 2) AS BIGINT) % 3
            WHEN 0 THEN 'mobile_ios' WHEN 1 THEN 'mobile_android' ELSE 'desktop_web' END AS device_type,
       device_id NOT LIKE 'X%' AS is_trusted
FROM fact GROUP BY device_id, customer_id"""

# Each transaction against all of its customer's, by a join: no window, no running total. Sums leave the row itself out.
def _others(days: str) -> str:
    return f"WHERE b.transaction_id <> a.transaction_id AND b.txn_timestamp BETWEEN a.txn_timestamp - INTERVAL {days} AND a.txn_timestamp"


_BEFORE = "(b.txn_timestamp, b.transaction_id) < (a.txn_timestamp, a.transaction_id)"
PARTS["around"] = f"""
SELECT a.transaction_id,
       {", ".join(
           f"coalesce(CAST(100 * sum(b.amount) FILTER ({_others(span)}) AS BIGINT), 0) AS cents_{tag}, "
           f"count(*) FILTER ({_others(span)}) AS others_{tag}"
           for tag, span in (("1h", "1 HOUR"), ("24h", "24 HOUR"), ("7d", "7 DAY"), ("30d", "30 DAY"))
       )},
       1 + count(*) FILTER (WHERE {_BEFORE}) AS place,
       max(CASE WHEN {_BEFORE} THEN struct_pack(at := b.txn_timestamp, id := b.transaction_id, lat := b.latitude,
                                                lon := b.longitude) END) AS last,
       min(b.txn_timestamp) FILTER (WHERE b.device_id = a.device_id) AS device_since
FROM fact a JOIN fact b ON b.customer_id = a.customer_id GROUP BY a.transaction_id"""


def _km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    root = (
        f"sqrt(power(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * power(sin(radians({lon2} - {lon1}) / 2), 2))"
    )
    return f"2 * CAST(6371.0 AS DOUBLE) * asin(CASE WHEN {root} > 1 THEN CAST(1.0 AS DOUBLE) ELSE {root} END)"


def _mean(tag: str) -> str:
    return f"CASE WHEN others_{tag} > 0 THEN ((2 * cents_{tag} + others_{tag}) // (2 * others_{tag})) / CAST(100 AS DOUBLE) END"


def _against_mean(tag: str) -> str:
    half_up = f"(2000 * own * others_{tag} + cents_{tag}) // (2 * cents_{tag})"
    return f"CASE WHEN cents_{tag} > 0 THEN ({half_up}) / CAST(1000 AS DOUBLE) END"


PARTS["feats"] = f"""
SELECT transaction_id, customer_id, txn_timestamp, amount, merchant_category, channel, place AS customer_txn_seq,
       {_mean("7d")} AS avg_amount_7d, {_mean("30d")} AS avg_amount_30d,
       {_against_mean("7d")} AS amount_to_avg_7d_ratio, {_against_mean("30d")} AS amount_to_avg_30d_ratio,
       others_1h + 1 AS txn_count_1h, others_24h + 1 AS txn_count_24h,
       (cents_1h + own) / CAST(100 AS DOUBLE) AS amount_sum_1h, (cents_24h + own) / CAST(100 AS DOUBLE) AS amount_sum_24h,
       ((idle + 3000000) // 6000000) / CAST(10 AS DOUBLE) AS minutes_since_prev_txn,
       round(moved, 1) AS km_from_prev_txn,
       round(moved / greatest(idle / CAST(3.6e9 AS DOUBLE), CAST(1 AS DOUBLE) / 60), 1) AS geo_velocity_kmh,
       round(away, 1) AS km_from_home, ((owned + 18000000) // 36000000) / CAST(100 AS DOUBLE) AS device_age_hours,
       CAST(hour(txn_timestamp) AS BIGINT) AS hour_of_day, CAST(dayofweek(txn_timestamp) AS BIGINT) AS day_of_week,
       hour(txn_timestamp) < 5 AS is_night, channel = 'online' AS is_online, is_fraud
FROM (SELECT f.*, r.* EXCLUDE (transaction_id), CAST(100 * amount AS BIGINT) AS own,
             epoch_us(txn_timestamp) - epoch_us(r.last.at) AS idle, epoch_us(txn_timestamp) - epoch_us(device_since) AS owned,
             {_km('r.last.lat', 'r.last.lon', 'latitude', 'longitude')} AS moved,
             {_km('home_latitude', 'home_longitude', 'latitude', 'longitude')} AS away
      FROM fact f JOIN around r USING (transaction_id) JOIN people USING (customer_id))"""

_SPLIT = (
    "CASE WHEN txn_timestamp < TIMESTAMP '2024-01-16' THEN 'train' "
    "WHEN txn_timestamp < TIMESTAMP '2024-01-21' THEN 'valid' ELSE 'test' END"
)

PARTS["outputs"] = f"""
SELECT transaction_id, {_SPLIT} AS dataset_split,
       least(100000, 15000 * (txn_count_1h - 1) + CASE WHEN km_from_prev_txn > 500 THEN 45000 ELSE 0 END
             + CASE WHEN device_age_hours = 0 THEN 35000 ELSE 0 END) AS p5,
       least(10000, 20 * CAST(floor(km_from_home) AS BIGINT)) AS i2
FROM feats"""

PARTS["blended"] = """
SELECT *, q + CASE WHEN r > 5000 OR (r = 5000 AND q % 2 = 1) THEN 1 ELSE 0 END AS score
FROM (SELECT *, (8 * p5 + 20 * i2) // 10000 AS q, (8 * p5 + 20 * i2) % 10000 AS r FROM outputs)"""

PARTS["scores"] = """
SELECT transaction_id, 'v1.0' AS model_version, dataset_split,
       p5 / CAST(100000 AS DOUBLE) AS xgb_fraud_probability, i2 / CAST(100 AS DOUBLE) AS isolation_anomaly_score,
       CAST(score AS BIGINT) AS anomaly_risk_score,
       CASE WHEN score >= 80 THEN 'Critical' WHEN score >= 60 THEN 'High' WHEN score >= 30 THEN 'Medium' ELSE 'Low' END
           AS risk_tier,
       score >= 60 AS is_flagged
FROM blended"""

PARTS["tested"] = """
SELECT s.*, f.amount, f.is_fraud, f.fraud_scenario
FROM scores s JOIN fact f USING (transaction_id) WHERE dataset_split = 'test'"""

PARTS["spot"] = "SELECT (count(*) - 1) * (CAST(1 AS DOUBLE) - avg(CAST(is_flagged AS INTEGER))) AS pos FROM tested"

PARTS["cutoff"] = """
SELECT a.x + (b.x - a.x) * (pos - floor(pos)) AS cut
FROM spot,
     (SELECT isolation_anomaly_score AS x, row_number() OVER (ORDER BY isolation_anomaly_score) - 1 AS i FROM tested) a,
     (SELECT isolation_anomaly_score AS x, row_number() OVER (ORDER BY isolation_anomaly_score) - 1 AS i FROM tested) b
WHERE a.i = floor(pos) AND b.i = ceil(pos)"""

PARTS["policies"] = """
SELECT 'rule: amount >= $500' AS model, CAST(amount AS DOUBLE) AS score, amount >= 500 AS flagged,
       is_fraud, amount, fraud_scenario FROM tested
UNION ALL SELECT 'isolation_forest', isolation_anomaly_score, isolation_anomaly_score >= (SELECT cut FROM cutoff),
       is_fraud, amount, fraud_scenario FROM tested
UNION ALL SELECT 'xgboost', xgb_fraud_probability, xgb_fraud_probability >= 0.5, is_fraud, amount, fraud_scenario FROM tested
UNION ALL SELECT 'risk_blend', CAST(anomaly_risk_score AS DOUBLE), is_flagged, is_fraud, amount, fraud_scenario FROM tested"""

PARTS["hist"] = """
SELECT model, score, sum(CASE WHEN is_fraud THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN is_fraud THEN 0 ELSE 1 END) AS neg
FROM policies GROUP BY model, score"""

PARTS["runs"] = """
SELECT *, sum(pos) OVER d AS pos_upto, sum(neg) OVER d AS neg_upto,
       sum(pos) OVER (PARTITION BY model) AS pos_all, sum(neg) OVER (PARTITION BY model) AS neg_all
FROM hist WINDOW d AS (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING)"""

PARTS["ranking"] = """
SELECT model,
       round(CAST(sum(pos * (2 * (neg_all - neg_upto) + neg)) AS DOUBLE) / 2 / CAST(max(pos_all * neg_all) AS DOUBLE), 4)
           AS roc_auc,
       round(sum(pos * (CAST(pos_upto AS DOUBLE) / CAST(pos_upto + neg_upto AS DOUBLE))) / CAST(max(pos_all) AS DOUBLE), 4)
           AS pr_auc
FROM runs GROUP BY model"""

PARTS["counted"] = """
SELECT model, count(*) FILTER (flagged) AS flagged_txns, count(*) FILTER (flagged AND is_fraud) AS tp,
       count(*) FILTER (flagged AND NOT is_fraud) AS fp, count(*) FILTER (is_fraud) AS y, count(*) FILTER (NOT is_fraud) AS ny,
       coalesce(sum(amount) FILTER (is_fraud), 0) AS fraud_dollars,
       coalesce(sum(amount) FILTER (flagged AND is_fraud), 0) AS caught
FROM policies GROUP BY model"""


def _rate(a: str, b: str, digits: int) -> str:
    """Half up on integers."""
    scale = 10**digits
    return f"((2 * {scale} * {a} + {b}) // (2 * {b})) / CAST({scale} AS DOUBLE)"


def _even(a: str, b: str, digits: int) -> str:
    """Ties to even, on integers."""
    units, scale = f"(CAST({10**digits} AS HUGEINT) * ({a}))", 10**digits
    quotient, rest = f"({units} // ({b}))", f"({units} % ({b}))"
    up = f"CASE WHEN 2 * {rest} > ({b}) OR (2 * {rest} = ({b}) AND {quotient} % 2 = 1) THEN 1 ELSE 0 END"
    return f"CAST({quotient} + {up} AS DOUBLE) / CAST({scale} AS DOUBLE)"


PARTS["quality"] = f"""
SELECT model, flagged_txns, {_even('tp', 'greatest(tp + fp, 1)', 3)} AS "precision",
       {_even('tp', 'greatest(y, 1)', 3)} AS recall, {_even('fp', 'greatest(ny, 1)', 4)} AS false_positive_rate,
       CAST(fraud_dollars AS DOUBLE) AS fraud_dollars, CAST(caught AS DOUBLE) AS fraud_dollars_caught,
       {_even('CAST(caught * 100 AS BIGINT)', 'greatest(CAST(fraud_dollars * 100 AS BIGINT), 1)', 3)} AS dollar_recall
FROM counted"""

_LABELS = " UNION ALL ".join(
    f"SELECT '{name}' AS id, '{label}' AS label, {order} AS sort_order" for name, (label, order) in MODEL_LABELS.items()
)
PARTS["labels_of_models"] = _LABELS

PARTS["performance"] = """
SELECT label AS model, CAST(sort_order AS BIGINT) AS sort_order, roc_auc, pr_auc, flagged_txns,
       "precision" AS precision_rate, recall AS recall_rate, false_positive_rate, fraud_dollars, fraud_dollars_caught,
       dollar_recall
FROM ranking JOIN quality USING (model) JOIN labels_of_models ON id = model"""


def _title(c: str) -> str:
    words = f"string_split({c}, '_')"
    return (
        f"array_to_string(list_transform({words}, lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ')"
    )


PARTS["recalls"] = f"""
SELECT label AS model, CAST(sort_order AS BIGINT) AS sort_order, {_title('fraud_scenario')} AS fraud_type,
       {_even('count(*) FILTER (flagged)', 'count(*)', 3)} AS recall_rate
FROM policies JOIN labels_of_models ON id = model WHERE is_fraud GROUP BY label, sort_order, fraud_scenario"""

PARTS["bifact"] = f"""
SELECT f.transaction_id, f.customer_id, f.device_id, f.txn_timestamp, CAST(f.txn_timestamp AS DATE) AS txn_date,
       CAST(hour(f.txn_timestamp) AS BIGINT) AS txn_hour, f.amount, {_title('f.merchant_category')} AS merchant_category,
       CASE f.channel WHEN 'online' THEN 'Online' ELSE 'In-store' END AS channel, city, state, latitude, longitude,
       {_title('g.device_type')} AS device_type, f.is_fraud,
       CASE WHEN fraud_scenario IS NULL THEN 'Legitimate' ELSE {_title('fraud_scenario')} END AS fraud_type,
       anomaly_risk_score, risk_tier,
       CAST(CASE risk_tier WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 WHEN 'High' THEN 3 ELSE 4 END AS BIGINT) AS risk_tier_order,
       CAST(anomaly_risk_score // 10 * 10 AS BIGINT) AS score_band, xgb_fraud_probability, isolation_anomaly_score, is_flagged,
       CASE WHEN is_flagged AND f.is_fraud THEN 'Fraud Prevented' WHEN f.is_fraud THEN 'Fraud Missed'
            WHEN is_flagged THEN 'False Alarm' ELSE 'Cleared' END AS outcome,
       CASE WHEN dataset_split = 'test' THEN 'Live (May to Jun)' ELSE 'Training (Jan to Apr)' END AS model_period,
       model_version, txn_count_1h, amount_to_avg_30d_ratio, geo_velocity_kmh, km_from_home, device_age_hours
FROM fact f JOIN scores USING (transaction_id) JOIN feats x USING (transaction_id) JOIN gear g ON g.device_id = f.device_id"""

PARTS["bicustomer"] = """
SELECT customer_id, home_city, home_state, upper(substr(customer_segment, 1, 1)) || substr(customer_segment, 2) AS customer_segment,
       CAST(age AS BIGINT) AS age,
       CASE WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' WHEN age < 50 THEN '35-49' WHEN age < 65 THEN '50-64'
            ELSE '65+' END AS age_band, signup_date
FROM people"""

PARTS["bidate"] = """
SELECT d AS date, CAST(year(d) AS BIGINT) AS year, CAST(month(d) AS BIGINT) AS month_number, strftime(d, '%b') AS month_short,
       strftime(d, '%Y-%m') AS year_month, CAST(date_trunc('week', d) AS DATE) AS week_start,
       CAST(isodow(d) AS BIGINT) AS day_of_week_number, strftime(d, '%a') AS day_name, isodow(d) IN (6, 7) AS is_weekend
FROM (SELECT CAST(unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d
      FROM events)"""

PARTS["live"] = "SELECT * FROM bifact WHERE model_period = 'Live (May to Jun)'"
PARTS["review"] = "SELECT * FROM live WHERE risk_tier IN ('Medium', 'High', 'Critical')"

PARTS["liverows"] = """
SELECT l.*, customer_segment, week_start, row_number() OVER (ORDER BY txn_timestamp, transaction_id) - 1 AS "row"
FROM live l JOIN bicustomer USING (customer_id) JOIN bidate ON date = txn_date"""

PARTS["raw"] = """
SELECT * REPLACE (CASE WHEN value < 1 THEN -amount ELSE amount END AS amount,
                  CASE WHEN event_type = 'view' THEN NULL WHEN event_type = 'signup' THEN 'kiosk' ELSE channel END AS channel,
                  CASE WHEN event_type <> 'error' THEN city END AS city,
                  CASE WHEN event_type = 'error' THEN event_type ELSE state END AS state)
FROM fact"""

SQL: dict[str, str] = {}


def _expand(final: str) -> str:
    """Prefix the parts that ``final`` needs, in dependency order."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in PARTS:
            if name not in order and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text):
                visit(PARTS[name])
                if name not in order:
                    order.append(name)

    visit(final)
    ctes = ",\n".join(f"{n} AS ({PARTS[n].strip()})" for n in order)
    return (f"WITH {ctes}\n" if ctes else "") + final.strip()


def _sql(name: str, text: str) -> None:
    SQL[name] = _expand(text)


def _ts(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {c.split('.')[-1]}"


def _day(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d') AS \"{c}\""


# ------------------------------------------------------------- load and checks

_COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {p}"
    for t, p in (("dim_customer", "people"), ("dim_device", "gear"), ("fact_transaction", "fact"))
)
_sql("load_counts", _COUNTS)
_sql("star_reload", _COUNTS)
_sql("csv_scan", f"SELECT * REPLACE (CAST(age AS BIGINT) AS age, strftime(signup_date, '%Y-%m-%d') AS signup_date) FROM people")
_sql("csv_scan_device", f"SELECT device_id, customer_id, device_type, {_ts('first_seen_at')}, is_trusted FROM gear")
_sql(
    "csv_scan_transaction",
    f"""SELECT transaction_id, customer_id, device_id, {_ts('txn_timestamp')}, CAST(amount AS DOUBLE) AS amount,
               merchant_category, channel, city, state, latitude, longitude, is_fraud, fraud_scenario FROM fact""",
)
_sql(
    "pk_violations",
    "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS rows FROM lineitem "
    "GROUP BY ALL HAVING count(*) > 1",
)
_sql(
    "pk_violations_packed",
    "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS rows FROM lineitem "
    "GROUP BY ALL HAVING count(*) > 1",
)
_sql(
    "event_key_report",
    " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, count(*) AS repeated_keys, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_rows "
        f"FROM (SELECT count(*) AS n FROM events GROUP BY {rule} HAVING count(*) > 1)"
        for rule in ("event_id", "user_id,ts")
    ),
)
_sql(
    "fk_violations",
    "SELECT c_custkey, count(*) AS rows FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events) GROUP BY c_custkey",
)


def _pk(table: str, part: str, key: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, 'primary_key' AS kind, '{key}' AS rule, "
        f"CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS violations FROM "
        f"(SELECT count(*) AS n FROM {part} GROUP BY {key} HAVING count(*) > 1)"
    )


def _fk(table: str, part: str, column: str, parent: str, parent_part: str) -> str:
    return (
        f"SELECT '{table}', 'foreign_key', '{column}->{parent}', count(*) FROM {part} c "
        f"WHERE {column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent_part} p WHERE p.{column} = c.{column})"
    )


_sql(
    "key_report",
    " UNION ALL ".join(
        [
            _pk("dim_customer", "people", "customer_id"),
            _pk("dim_device", "gear", "device_id"),
            _pk("fact_transaction", "fact", "transaction_id"),
            _pk("txn_features", "feats", "transaction_id"),
            _pk("txn_risk_scores", "scores", "transaction_id"),
            _fk("dim_device", "gear", "customer_id", "dim_customer", "people"),
            _fk("fact_transaction", "fact", "customer_id", "dim_customer", "people"),
            _fk("fact_transaction", "fact", "device_id", "dim_device", "gear"),
            _fk("txn_risk_scores", "scores", "transaction_id", "fact_transaction", "fact"),
        ]
    ),
)
_sql(
    "metric_key_report",
    _pk("model_performance", "performance", "model")
    + " UNION ALL "
    + _pk("scenario_recall", "recalls", "model,fraud_type"),
)


# The declared rules, written out here on their own: column, longest text or NULL; all but the last are required.
_DECLARED = {
    "dim_customer": (
        "people",
        {"customer_id": 10, "home_city": 50, "home_state": 2, "home_latitude": None, "home_longitude": None, "age": None,
         "customer_segment": 20, "signup_date": None},
    ),
    "dim_device": (
        "gear",
        {"device_id": 10, "customer_id": 10, "device_type": 20, "first_seen_at": None, "is_trusted": None},
    ),
    "fact_transaction": (
        "raw",
        {"transaction_id": 12, "customer_id": 10, "device_id": 10, "txn_timestamp": None, "amount": None,
         "merchant_category": 30, "channel": 10, "city": 50, "state": 2, "latitude": None, "longitude": None,
         "is_fraud": None, "fraud_scenario": 30},
    ),
}


def _rules(kind: str) -> str:
    out = []
    for table, (part, columns) in _DECLARED.items():
        if kind == "not_null":
            broken = {c: f"{c} IS NULL" for c in columns if c != "fraud_scenario"}
        elif kind == "limit":
            broken = {c: f"length({c}) > {n}" for c, n in columns.items() if n}
            if "amount" in columns:
                broken["amount_precision"] = "abs(amount) >= 10000000000"
        else:
            broken = {"amount_positive": "amount <= 0", "channel_known": "channel NOT IN ('online', 'in_store')"}
            broken = broken if "amount" in columns else {}
        out += [
            f"SELECT '{table}' AS table_name, '{kind}' AS kind, '{rule}' AS rule, count(*) FILTER ({test}) AS violations FROM {part}"
            for rule, test in broken.items()
        ]
    return " UNION ALL ".join(out)


_sql("check_violations", _rules("check"))
_sql("null_counts", _rules("not_null"))
_sql("limit_violations", _rules("limit"))

# ------------------------------------------------------------------- features

for _name, _columns in {
    "velocity_1h": "txn_count_1h, amount_sum_1h",
    "velocity_24h": "txn_count_24h, amount_sum_24h",
    "rolling_spend_7d": "avg_amount_7d",
    "rolling_spend_30d": "avg_amount_30d",
    "spend_ratio": "amount_to_avg_7d_ratio, amount_to_avg_30d_ratio",
    "txn_sequence": "customer_id, customer_txn_seq",
    "geo_jump": "minutes_since_prev_txn, km_from_prev_txn",
    "geo_velocity": "geo_velocity_kmh",
    "km_from_home": "km_from_home",
    "device_age": "device_age_hours",
    "calendar_context": "hour_of_day, day_of_week, is_night, is_online",
}.items():
    _sql(_name, f"SELECT transaction_id, {_columns} FROM feats")

_sql("txn_features", f"SELECT * REPLACE ({_ts('txn_timestamp')}, CAST(amount AS DOUBLE) AS amount) FROM feats")
_sql(
    "order_spend_90d",
    """SELECT o_orderkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER w AS BIGINT) AS cents_90d,
              count(*) OVER w AS orders_90d
       FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate
                                RANGE BETWEEN INTERVAL 90 DAYS PRECEDING AND CURRENT ROW)""",
)
SQL["txn_features_sliced"], SQL["order_spend_90d_sliced"] = SQL["txn_features"], SQL["order_spend_90d"]
SQL["txn_features_daily"] = SQL["txn_features_late"] = SQL["txn_features"]
_sql(
    "feature_validation",
    f"""SELECT coalesce(f.fraud_scenario, 'legit') AS scenario, count(*) AS txns,
               quantile_cont(CAST(x.amount AS DOUBLE), 0.5) AS med_amount,
               quantile_cont(amount_to_avg_30d_ratio, 0.5) AS med_ratio_30d,
               quantile_cont(CAST(txn_count_1h AS DOUBLE), 0.5) AS med_count_1h,
               quantile_cont(CAST(txn_count_24h AS DOUBLE), 0.5) AS med_count_24h,
               quantile_cont(geo_velocity_kmh, 0.5) AS med_geo_kmh, quantile_cont(km_from_home, 0.5) AS med_km_home,
               quantile_cont(device_age_hours, 0.5) AS med_device_age_h,
               {_rate('count(*) FILTER (is_night)', 'count(*)', 3)} AS night_share
        FROM feats x JOIN fact f USING (transaction_id) GROUP BY 1""",
)
_sql(
    "city_distance_pairs",
    f"""SELECT home_city, city, round(km, 1) AS km, count(*) AS txns
        FROM (SELECT p.home_city, f.city,
                     {_km('p.home_latitude', 'p.home_longitude', 'c.home_latitude', 'c.home_longitude')} AS km
              FROM fact f JOIN people p USING (customer_id)
              JOIN (SELECT city AS home_city, coalesce(min(q.home_latitude), min(latitude)) AS home_latitude,
                           coalesce(min(q.home_longitude), min(longitude)) AS home_longitude
                    FROM fact LEFT JOIN people q ON q.home_city = city GROUP BY city) c ON c.home_city = f.city)
        WHERE km >= 800 GROUP BY ALL""",
)
PARTS["homepoints"] = """
SELECT home_city, min(home_latitude) AS lat, min(home_longitude) AS lon FROM people GROUP BY home_city"""
PARTS["places"] = "SELECT latitude AS lat, longitude AS lon, count(*) AS n FROM fact GROUP BY ALL"
_sql(
    "far_city_pairs",
    f"""SELECT a.home_city, b.home_city AS city, round({_km('a.lat', 'a.lon', 'b.lat', 'b.lon')}, 1) AS km
        FROM homepoints a JOIN homepoints b ON {_km('a.lat', 'a.lon', 'b.lat', 'b.lon')} >= 800""",
)
_sql(
    "close_purchase_points",
    f"""SELECT a.lat AS lat1, a.lon AS lon1, b.lat AS lat2, b.lon AS lon2,
               CAST(round({_km('a.lat', 'a.lon', 'b.lat', 'b.lon')} * 1000) AS BIGINT) AS metres
        FROM places a JOIN places b ON (a.lat <> b.lat OR a.lon <> b.lon) AND {_km('a.lat', 'a.lon', 'b.lat', 'b.lon')} <= 2""",
)
_sql(
    "customers_by_distance",
    f"""SELECT lat AS lat1, lon AS lon1, count(*) FILTER (far) AS beyond, count(*) FILTER (NOT far) AS within
        FROM (SELECT a.lat, a.lon, {_km('a.lat', 'a.lon', 'home_latitude', 'home_longitude')} >= 800 AS far
              FROM places a CROSS JOIN people) GROUP BY lat, lon""",
)
_sql(
    "purchases_by_distance",
    f"""SELECT lat AS lat1, lon AS lon1, CAST(coalesce(sum(n) FILTER (far), 0) AS BIGINT) AS beyond,
               CAST(coalesce(sum(n) FILTER (NOT far), 0) AS BIGINT) AS within
        FROM (SELECT a.lat, a.lon, b.n, {_km('a.lat', 'a.lon', 'b.lat', 'b.lon')} >= 400 AS far
              FROM places a CROSS JOIN places b) GROUP BY lat, lon""",
)
_sql(
    "dense_txn_key",
    f"""SELECT transaction_id, strftime(date_trunc('second', txn_timestamp), '%Y-%m-%d %H:%M:%S.%f') AS txn_timestamp,
               {_lpad('TXN', 'row_number() OVER (ORDER BY txn_timestamp, customer_id, transaction_id)', 8)} AS dense_id
        FROM fact""",
)
_sql(
    "fraud_summary",
    """SELECT fraud_scenario, count(*) AS rows,
              ((2 * CAST(sum(amount) * 100 AS BIGINT) + count(*)) // (2 * count(*))) / CAST(100 AS DOUBLE) AS avg_amount,
              CAST(sum(amount) AS DOUBLE) AS total
       FROM fact WHERE is_fraud GROUP BY fraud_scenario""",
)
_sql(
    "table_totals",
    f"""SELECT (SELECT count(*) FROM people) AS customers, (SELECT count(*) FROM gear) AS devices,
               (SELECT count(*) FROM gear WHERE NOT is_trusted) AS untrusted_devices, count(*) AS transactions,
               strftime(min(txn_timestamp), '%Y-%m-%d %H:%M:%S.%f') AS first_txn,
               strftime(max(txn_timestamp), '%Y-%m-%d %H:%M:%S.%f') AS last_txn,
               count(*) FILTER (is_fraud) AS fraud_rows, CAST(sum(amount) AS DOUBLE) AS total_volume,
               CAST(sum(amount) FILTER (is_fraud) AS DOUBLE) AS fraud_volume,
               {_rate('count(*) FILTER (is_fraud)', 'count(*)', 4)} AS fraud_share
        FROM fact""",
)

# ------------------------------------------------------------ split and scores

_sql(
    "split_summary",
    f"""SELECT {_SPLIT} AS dataset_split, count(*) AS txns,
               {_rate('count(*) FILTER (is_fraud)', 'count(*)', 4)} AS fraud_rate,
               strftime(min(txn_timestamp), '%Y-%m-%d %H:%M:%S.%f') AS first_txn,
               strftime(max(txn_timestamp), '%Y-%m-%d %H:%M:%S.%f') AS last_txn
        FROM fact GROUP BY 1""",
)
_sql(
    "pos_weight",
    f"""SELECT CAST(count(*) FILTER (NOT is_fraud) AS DOUBLE) / CAST(greatest(count(*) FILTER (is_fraud), 1) AS DOUBLE)
               AS pos_weight FROM fact WHERE {_SPLIT} = 'train'""",
)
_sql("risk_scores", "SELECT * FROM scores")
_sql(
    "tier_counts",
    """SELECT t.risk_tier, CAST(t.o AS BIGINT) AS tier_order, n AS txns
       FROM (VALUES ('Low', 1), ('Medium', 2), ('High', 3), ('Critical', 4)) t(risk_tier, o)
       LEFT JOIN (SELECT risk_tier, count(*) AS n FROM scores WHERE dataset_split = 'test' GROUP BY 1) USING (risk_tier)""",
)
_sql("equal_volume_cut", "SELECT cut FROM cutoff")
_sql(
    "anomaly_scaling",
    f"""SELECT transaction_id, CAST(round_even(least(greatest((km_from_home - mid) / (top - mid), 0), 1) * 100 * 100, 0) AS BIGINT)
               AS hundredths
        FROM feats, (SELECT median(km_from_home) AS mid, max(km_from_home) AS top FROM feats WHERE {_SPLIT} = 'train')""",
)

_PLAIN = (
    "amount", "customer_txn_seq", "txn_count_1h", "txn_count_24h", "amount_sum_1h", "amount_sum_24h", "km_from_home",
    "device_age_hours", "hour_of_day", "day_of_week",
)
_FILLED = {
    "avg_amount_7d": "amount", "avg_amount_30d": "amount", "amount_to_avg_7d_ratio": "1", "amount_to_avg_30d_ratio": "1",
    "minutes_since_prev_txn": "43200", "km_from_prev_txn": "0", "geo_velocity_kmh": "0",
}
_sql(
    "model_matrix",
    "SELECT transaction_id, "
    + ", ".join(
        [f"CAST({c} AS DOUBLE) AS {c}" for c in _PLAIN]
        + [f"coalesce(CAST({c} AS DOUBLE), CAST({v} AS DOUBLE)) AS {c}" for c, v in _FILLED.items()]
        + [f"CAST(CAST({c} AS INTEGER) AS DOUBLE) AS {c}" for c in ("is_night", "is_online")]
        + ["CASE WHEN avg_amount_30d IS NULL THEN CAST(0 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS has_history"]
        + [
            f"CASE WHEN merchant_category = '{c}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS cat_{c}"
            for c in MERCHANT_CATEGORIES
        ]
    )
    + " FROM feats",
)

# ------------------------------------------------------------------ evaluation

_sql("roc_auc", "SELECT model, roc_auc FROM ranking")
_sql("average_precision", "SELECT model, pr_auc FROM ranking")
_sql("alert_policy_metrics", "SELECT * FROM quality")
_sql("model_performance", "SELECT * FROM performance")
_sql("metrics_json", "SELECT * FROM performance")
_sql("scenario_recall", "SELECT * FROM recalls")
_sql(
    "scorecard",
    """SELECT model, sort_order, roc_auc, pr_auc, precision_rate, recall_rate, false_positive_rate, flagged_txns,
              fraud_dollars_caught, dollar_recall FROM performance""",
)
_sql("model_vs_rule", "SELECT model, sort_order, dollar_recall, precision_rate FROM performance")
_sql(
    "scenario_matrix",
    """SELECT fraud_type, sum(recall_rate) FILTER (sort_order = 1) AS rule, sum(recall_rate) FILTER (sort_order = 2) AS isolation,
              sum(recall_rate) FILTER (sort_order = 3) AS boosted, sum(recall_rate) FILTER (sort_order = 4) AS blend
       FROM recalls GROUP BY fraud_type""",
)

# ------------------------------------------------------------------- reporting

_sql(
    "bi_fact",
    f"SELECT * REPLACE ({_ts('txn_timestamp')}, {_day('txn_date')}, CAST(amount AS DOUBLE) AS amount) FROM bifact",
)
_sql("bi_dim_customer", f"SELECT * REPLACE ({_day('signup_date')}) FROM bicustomer")
_sql("bi_dim_date", f"SELECT * REPLACE ({_day('date')}, {_day('week_start')}) FROM bidate")
PARTS["cal"] = """
SELECT d AS "Date", CAST(year(d) AS BIGINT) AS "Year", CAST(month(d) AS BIGINT) AS "MonthNo", strftime(d, '%B') AS "Month",
       CAST(quarter(d) AS BIGINT) AS "QuarterNo", 'Qtr ' || quarter(d) AS "Quarter", CAST(day(d) AS BIGINT) AS "Day"
FROM (SELECT CAST(unnest(generate_series(make_date(year(min(signup_date)), 1, 1), make_date(year(max(signup_date)), 12, 31),
                                         INTERVAL 1 DAY)) AS DATE) AS d FROM people)"""
_sql("auto_calendar", f"SELECT * REPLACE ({_day('Date')}) FROM cal")
PARTS["txncal"] = """
SELECT d AS "Date", CAST(year(d) AS BIGINT) AS "Year", CAST(month(d) AS BIGINT) AS "MonthNo", strftime(d, '%B') AS "Month",
       CAST(quarter(d) AS BIGINT) AS "QuarterNo", 'Qtr ' || quarter(d) AS "Quarter", CAST(day(d) AS BIGINT) AS "Day"
FROM (SELECT CAST(unnest(generate_series(make_date(year(min(ts)), 1, 1), make_date(year(max(ts)), 12, 31),
                                         INTERVAL 1 DAY)) AS DATE) AS d FROM events)"""
_sql("txn_calendar", f"SELECT * REPLACE ({_day('Date')}) FROM txncal")
_sql(
    "signups_by_quarter",
    'SELECT "Year", "Quarter", count(*) AS customers FROM people JOIN cal ON signup_date = "Date" GROUP BY ALL',
)
_sql(
    "period_outcome",
    "SELECT model_period, outcome, count(*) AS txns, CAST(sum(amount) AS DOUBLE) AS amount FROM bifact GROUP BY 1, 2",
)

# Measures; counts without rows are blank.
_COUNT = {
    "total_transactions": "true",
    "fraud_transactions": "is_fraud",
    "flagged_alerts": "is_flagged",
    "critical_alerts": "risk_tier = 'Critical'",
    "frauds_caught": "outcome = 'Fraud Prevented'",
    "false_alarms": "outcome = 'False Alarm'",
    "legit_transactions": "NOT is_fraud",
}
_MONEY = {
    "total_volume": "true",
    "fraud_exposure": "is_fraud",
    "fraud_prevented": "outcome = 'Fraud Prevented'",
    "fraud_missed": "outcome = 'Fraud Missed'",
}
_RATIO = {
    "fraud_rate": ("fraud_transactions", "total_transactions"),
    "prevention_rate": ("fraud_prevented", "fraud_exposure"),
    "alert_precision": ("frauds_caught", "flagged_alerts"),
    "fraud_catch_rate": ("frauds_caught", "fraud_transactions"),
    "false_positive_rate": ("false_alarms", "legit_transactions"),
    "fraud_prevented_per_alert": ("fraud_prevented", "flagged_alerts"),
}


def _m(name: str) -> str:
    if name in _COUNT:
        return f"nullif(count(*) FILTER ({_COUNT[name]}), 0)"
    if name in _MONEY:
        return f"CAST(sum(amount) FILTER ({_MONEY[name]}) AS DOUBLE)"
    if name in _RATIO:
        a, b = _RATIO[name]
        return f"CAST({_m(a)} AS DOUBLE) / nullif(CAST({_m(b)} AS DOUBLE), 0)"
    if name == "avg_risk_score":
        return "avg(CAST(anomaly_risk_score AS DOUBLE))"
    if name == "review_cost":
        return f"{_m('flagged_alerts')} * 5"
    if name == "net_savings":
        a, b = _m("fraud_prevented"), _m("review_cost")
        return f"CASE WHEN {a} IS NULL AND {b} IS NULL THEN NULL ELSE coalesce({a}, 0) - coalesce({b}, 0) END"
    if name == "report_subtitle":
        return (
            "'Model ' || CASE WHEN min(model_version) = max(model_version) THEN min(model_version) ELSE 'v1.0' END || '  |  ' || "
            "CASE WHEN min(model_period) = max(model_period) THEN min(model_period) ELSE 'All periods' END || '  |  ' || "
            "format('{:,}', count(*)) || ' transactions scored'"
        )
    raise KeyError(name)


def _ms(*names: str) -> str:
    return ", ".join(f"{_m(n)} AS {n}" for n in names)


_KPI = ("fraud_exposure", "fraud_prevented", "prevention_rate", "flagged_alerts", "alert_precision", "false_positive_rate")
_CARDS = ("flagged_alerts", "critical_alerts", "alert_precision", "fraud_prevented", "fraud_prevented_per_alert")
_sql("kpi_cards", f"SELECT {_ms(*_KPI)} FROM live")
_sql("headline_row", f"SELECT {_ms(*_KPI, 'report_subtitle')} FROM live")
_sql(
    "weekly_trend",
    f"""SELECT * FROM (SELECT strftime(week_start, '%Y-%m-%d') AS week_start, {_ms('fraud_prevented', 'fraud_missed')}
                       FROM live LEFT JOIN bidate ON date = txn_date GROUP BY 1)
        WHERE fraud_prevented IS NOT NULL OR fraud_missed IS NOT NULL""",
)
_sql(
    "exposure_by_attack",
    f"SELECT fraud_type, outcome, {_ms('fraud_exposure')} FROM live GROUP BY 1, 2 HAVING {_m('fraud_exposure')} IS NOT NULL",
)
_sql(
    "exposure_by_state",
    f"SELECT state, {_ms('fraud_exposure')} FROM live GROUP BY 1 HAVING {_m('fraud_exposure')} IS NOT NULL",
)
_sql(
    "alerts_by_tier",
    f"""SELECT risk_tier, risk_tier_order, {_ms('flagged_alerts')} FROM live GROUP BY 1, 2
        HAVING {_m('flagged_alerts')} IS NOT NULL""",
)
# [critical alerts] fixes the tier, so the page's tier filter does not reach it; critical rows are all in it anyway.
_sql("investigation_cards", f"SELECT {_ms(*_CARDS)} FROM review")
_sql(
    "drill_through",
    f"SELECT {_ms(*_CARDS)} FROM review WHERE fraud_type = 'Impossible Travel' AND state IN ('03', '07', '11', '19')",
)
_sql(
    "risk_scatter",
    """SELECT transaction_id, outcome, CAST(sum(amount) AS DOUBLE) AS sum_amount,
              CAST(sum(anomaly_risk_score) AS BIGINT) AS sum_risk_score FROM review GROUP BY 1, 2""",
)
_sql(
    "alerts_by_hour",
    f"SELECT txn_hour, {_ms('flagged_alerts')} FROM review GROUP BY 1 HAVING {_m('flagged_alerts')} IS NOT NULL",
)
_sql(
    "fraud_rate_by_band",
    f"SELECT score_band, {_ms('fraud_rate')} FROM live GROUP BY 1 HAVING {_m('fraud_rate')} IS NOT NULL",
)
_sql("band_counts", f"SELECT score_band, is_fraud, {_ms('total_transactions')} FROM live GROUP BY 1, 2")
_ALL = (
    "total_transactions", "total_volume", "fraud_transactions", "fraud_exposure", "fraud_rate", "fraud_prevented",
    "fraud_missed", "prevention_rate", "flagged_alerts", "critical_alerts", "frauds_caught", "false_alarms",
    "alert_precision", "fraud_catch_rate", "false_positive_rate", "avg_risk_score", "review_cost", "net_savings",
    "fraud_prevented_per_alert", "report_subtitle",
)
_sql(
    "all_measures",
    f"SELECT customer_segment, {_ms(*_ALL)} FROM bifact LEFT JOIN bicustomer USING (customer_id) GROUP BY 1",
)
_sql(
    "sliced_kpi_cards",
    f"""SELECT {_ms(*_KPI)} FROM live JOIN bicustomer USING (customer_id) JOIN bidate ON date = txn_date
        WHERE channel = 'Online' AND customer_segment IN ('Building', 'Household') AND month_short = 'Jan'
              AND merchant_category <> 'Gas'""",
)
_sql(
    "calculate_override",
    """SELECT g.risk_tier, g.state, CAST(c.n AS DOUBLE) AS critical_alerts, CAST(g.flagged AS DOUBLE) AS flagged_alerts,
              g.volume AS total_volume
       FROM (SELECT risk_tier, state, nullif(count(*) FILTER (is_flagged), 0) AS flagged, CAST(sum(amount) AS DOUBLE) AS volume
             FROM live WHERE risk_tier IN ('High', 'Medium') AND anomaly_risk_score BETWEEN 30 AND 100 GROUP BY 1, 2) g
       LEFT JOIN (SELECT state, count(*) AS n FROM live
                  WHERE risk_tier = 'Critical' AND anomaly_risk_score BETWEEN 30 AND 100 GROUP BY 1) c USING (state)""",
)
_sql(
    "alert_queue",
    f"""SELECT transaction_id, {_ts('txn_timestamp')}, customer_id, CAST(amount AS DOUBLE) AS amount, merchant_category, city,
               anomaly_risk_score, risk_tier, txn_count_1h, amount_to_avg_30d_ratio, geo_velocity_kmh, device_age_hours, outcome
        FROM review""",
)
_sql(
    "confusion_matrix",
    """SELECT is_fraud, nullif(count(*) FILTER (NOT is_flagged), 0) AS not_flagged,
              nullif(count(*) FILTER (is_flagged), 0) AS flagged FROM live GROUP BY 1""",
)
_sql(
    "overview_slicers",
    """SELECT DISTINCT 'month_short' AS slicer, month_short AS option FROM live JOIN bidate ON date = txn_date
       UNION SELECT 'channel', channel FROM live
       UNION SELECT 'customer_segment', customer_segment FROM live JOIN bicustomer USING (customer_id)
       UNION SELECT 'merchant_category', merchant_category FROM live""",
)
_sql(
    "investigation_slicers",
    """SELECT DISTINCT 'risk_tier' AS slicer, risk_tier AS option FROM review UNION SELECT 'state', state FROM review
       UNION SELECT 'merchant_category', merchant_category FROM review
       UNION SELECT 'model_period', model_period FROM review""",
)

# --------------------------------------------------------------------- extract

_CODED = ("merchant_category", "channel", "state", "customer_segment", "fraud_type", "outcome", "risk_tier")
_sql(
    "web_columns",
    f"""SELECT "row", dense_rank() OVER (ORDER BY week_start) - 1 AS week, CAST(txn_hour AS BIGINT) AS hour,
               CAST(amount * 100 AS BIGINT) AS cents, anomaly_risk_score AS score, CAST(is_fraud AS BIGINT) AS fraud,
               CAST(is_flagged AS BIGINT) AS flagged,
               {', '.join(f'dense_rank() OVER (ORDER BY {c}) - 1 AS {c}' for c in _CODED)}
        FROM liverows""",
)
_sql(
    "dictionary_codes",
    " UNION ALL ".join(
        f"SELECT '{n}' AS dimension, v AS value, row_number() OVER (ORDER BY v) - 1 AS code "
        f"FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM liverows)"
        for n, c in (("week", "week_start"), *((d, d) for d in _CODED))
    ),
)
_sql(
    "web_alerts",
    """SELECT transaction_id, customer_id, strftime(txn_timestamp, '%Y-%m-%d %H:%M') AS timestamp, city, txn_count_1h,
              CAST(round_even(CAST(amount_to_avg_30d_ratio AS DECIMAL(18,3)), 1) AS DOUBLE) AS spend_vs_30d_avg,
              CAST(round_even(geo_velocity_kmh, 0) AS BIGINT) AS geo_speed_kmh,
              CAST(round_even(CAST(device_age_hours AS DECIMAL(18,2)), 1) AS DOUBLE) AS device_age_hours, "row"
       FROM liverows WHERE anomaly_risk_score >= 30""",
)

# ---------------------------------------- long routes, row order, fitted models

SQL["feature_validation_bracketed"] = SQL["feature_validation"]
for _name in ("weekly_trend", "exposure_by_attack", "confusion_matrix"):
    SQL[f"{_name}_cube"] = SQL[_name]
_sql(
    "sketched_medians",
    """SELECT coalesce(f.fraud_scenario, 'legit') AS scenario, metric, true AS holds
       FROM feats x JOIN fact f USING (transaction_id),
            (VALUES ('med_amount'), ('med_ratio_30d'), ('med_count_1h'), ('med_count_24h'), ('med_geo_kmh'),
                    ('med_km_home'), ('med_device_age_h')) v(metric)
       GROUP BY ALL
       HAVING count(CASE metric WHEN 'med_ratio_30d' THEN amount_to_avg_30d_ratio WHEN 'med_geo_kmh' THEN geo_velocity_kmh
                    WHEN 'med_km_home' THEN km_from_home WHEN 'med_device_age_h' THEN device_age_hours ELSE 1 END) > 0""",
)
SQL["dictionary_codes_long"] = SQL["dictionary_codes"]
for _name, _order in {
    "alert_queue": "anomaly_risk_score DESC, transaction_id",
    "exposure_by_attack": "fraud_exposure DESC, fraud_type, outcome",
    "scorecard": "sort_order",
    "feature_validation": "txns DESC, scenario",
}.items():
    SQL[f"{_name}_order"] = f"SELECT *, row_number() OVER (ORDER BY {_order}) AS position FROM ({SQL[_name]})"
_sql(
    "kpi_cards_by_week",
    f"SELECT {_ms(*_KPI)} FROM live JOIN bidate ON date = txn_date WHERE day(week_start) > 15",
)
# Nothing here is computed: each property must hold, whatever the data.
SQL["fitted_properties"] = " UNION ALL ".join(
    f"SELECT '{p}' AS property, true AS holds"
    for p in (
        "anomaly scores lie in 0 to 100", "probabilities lie in 0 to 1", "up to the train median an anomaly score is 0",
        "from the train maximum an anomaly score is 100", "the maximum is a train row''s",
        "about half the train rows score 0", "average precision is above the base rate",
        "scores do not depend on the partitions", "importances sum to 1", "the forest has all its trees",
        "the number of boosted trees is allowed",
    )
)
