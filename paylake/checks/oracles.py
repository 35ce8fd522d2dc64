"""SQL for the queries of ``queries.py``, in DuckDB's dialect, from the same tables."""

from __future__ import annotations

VIEWS = {
    "payments": """
        SELECT o_orderkey AS payment_id, o_custkey AS merchant_id, o_custkey AS customer_id,
               o_orderkey AS invoice_id, CAST(o_orderkey % 25 AS INT) AS gateway_id,
               o_orderpriority AS payment_method_id,
               CAST(ROUND(o_totalprice * 100) AS BIGINT) AS amount, 'INR' AS currency,
               CASE o_orderstatus WHEN 'F' THEN 'Captured' WHEN 'O' THEN 'Pending'
                                  ELSE 'Failed' END AS payment_status,
               CAST(o_orderkey AS VARCHAR) AS payment_reference,
               o_orderdate AS initiated_at,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 DAY END AS completed_at,
               (o_orderkey * 37) % 5000 AS processing_time_ms
        FROM orders""",
    "merchants": """
        SELECT c_custkey AS merchant_id, c_name AS merchant_name, c_mktsegment AS industry,
               'Private Limited' AS business_type, r_name AS country, n_name AS city,
               CASE WHEN c_acctbal < 0 THEN 'High' WHEN c_acctbal < 5000 THEN 'Medium'
                    ELSE 'Low' END AS risk_level,
               'T+1' AS settlement_cycle, 'Verified' AS verification_status
        FROM customer JOIN nation ON c_nationkey = n_nationkey
                      JOIN region ON n_regionkey = r_regionkey""",
    "gateways": """
        SELECT n_nationkey AS gateway_id, n_name AS gateway_name, r_name AS provider,
               'Card' AS gateway_type, 'Active' AS status
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "methods": """
        SELECT DISTINCT o_orderpriority AS payment_method_id,
               SUBSTR(o_orderpriority, 3) AS payment_method_name, 'Card' AS category
        FROM orders""",
    "attempts": """
        SELECT l_orderkey AS payment_id, l_orderkey * 10 + l_linenumber AS attempt_id,
               CAST(l_suppkey % 25 AS INT) AS gateway_id, l_linenumber AS attempt_number,
               CASE l_returnflag WHEN 'R' THEN 'Failed' WHEN 'A' THEN 'Success'
                                 ELSE 'Pending' END AS attempt_status
        FROM lineitem""",
    "lifecycle": """
        SELECT event_id, user_id AS payment_id,
               CAST(json_extract_string(props, '$.k') AS INT) AS retry_count,
               ts AS event_timestamp
        FROM events""",
    "lines": """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS payment_id,
               o_custkey AS merchant_id, CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS cents,
               l_shipdate AS shipped, l_linestatus = 'F' AS done, l_returnflag AS flag,
               l_linestatus AS linestatus, l_suppkey,
               l_partkey * 1000000000 + l_suppkey AS arrival
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "refunds": """
        SELECT id AS refund_id, payment_id, merchant_id, cents AS refund_amount,
               shipped AS requested_at,
               CASE WHEN done THEN shipped + INTERVAL 2 DAY END AS completed_at, arrival
        FROM lines WHERE flag = 'R'""",
    "chargebacks": """
        SELECT id AS chargeback_id, payment_id, merchant_id, cents AS amount,
               shipped AS created_at, arrival
        FROM lines WHERE flag = 'A' AND linestatus = 'F'""",
    "settlements": """
        SELECT id AS settlement_id, payment_id, merchant_id, l_suppkey AS account_id,
               cents AS settlement_amount, shipped AS initiated_at,
               CASE WHEN done THEN shipped + INTERVAL 3 DAY END AS completed_at, arrival
        FROM lines WHERE flag = 'N'""",
}


def _latest(table: str, key: str, time: str) -> str:
    """The state of an entity: its last record by (time, partition, offset)."""
    return f"""
        SELECT * EXCLUDE (_rank) FROM (
            SELECT *, row_number() OVER (PARTITION BY {key}
                       ORDER BY {time} DESC, arrival % 3 DESC, arrival DESC) AS _rank
            FROM {table}) WHERE _rank = 1"""


# The same names over the state that the streaming jobs leave behind. Ids are text there.
STATE = {
    **{k: VIEWS[k] for k in ("payments", "merchants", "gateways", "methods", "lifecycle", "lines")},
    "all_refunds": VIEWS["refunds"],
    "all_chargebacks": VIEWS["chargebacks"],
    "all_settlements": VIEWS["settlements"],
    "refunds": _latest("all_refunds", "refund_id", "requested_at"),
    "chargebacks": _latest("all_chargebacks", "chargeback_id", "created_at"),
    "settlements": _latest("all_settlements", "settlement_id", "initiated_at"),
    "attempts": """
        SELECT payment_id, attempt_id, gateway_id, attempt_number, attempt_status FROM (
            SELECT l_orderkey AS payment_id, l_orderkey * 10 + l_linenumber AS attempt_id,
                   l_suppkey % 25 AS gateway_id, l_linenumber AS attempt_number,
                   CASE l_returnflag WHEN 'R' THEN 'Failed' WHEN 'A' THEN 'Success'
                                     ELSE 'Pending' END AS attempt_status,
                   row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                       ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS _rank
            FROM lineitem) WHERE _rank = 1""",
}

_ATTEMPTS = """count(DISTINCT attempt_id) AS attempt_count,
    CAST(sum(CASE WHEN attempt_status = 'Failed' THEN 1 ELSE 0 END) AS BIGINT)
        AS failed_attempt_count,
    CAST(sum(CASE WHEN attempt_status = 'Success' THEN 1 ELSE 0 END) AS BIGINT)
        AS successful_attempt_count,
    max(attempt_number) AS max_attempt_number"""
_LIFECYCLE = """count(DISTINCT event_id) AS event_count,
    CAST(sum(coalesce(retry_count, 0)) AS BIGINT) AS total_retry_count,
    max(event_timestamp) AS last_event_timestamp"""
_REFUNDS = """count(DISTINCT refund_id) AS refund_count,
    CAST(sum(coalesce(refund_amount, 0)) AS BIGINT) AS total_refund_amount"""
_CHARGEBACKS = """count(DISTINCT chargeback_id) AS chargeback_count,
    CAST(sum(coalesce(amount, 0)) AS BIGINT) AS total_chargeback_amount"""
_SETTLEMENTS = """count(DISTINCT settlement_id) AS settlement_count,
    CAST(sum(coalesce(settlement_amount, 0)) AS BIGINT) AS total_settlement_amount"""
_VOLUME = """count(DISTINCT payment_id) AS payment_count,
    CAST(sum(coalesce(amount, 0)) AS BIGINT) AS total_payment_amount"""
_CAPTURED = "CAST(sum(CASE WHEN payment_status = 'Captured' THEN 1 ELSE 0 END) AS BIGINT)"
_OTHER = "CAST(sum(CASE WHEN payment_status <> 'Captured' THEN 1 ELSE 0 END) AS BIGINT)"
_CAPTURED_AMOUNT = (
    "CAST(sum(CASE WHEN payment_status = 'Captured' THEN amount ELSE 0 END) AS BIGINT)"
)
_MERCHANT_PAYMENTS = f"""{_VOLUME},
    {_CAPTURED} AS successful_payment_count, {_OTHER} AS non_successful_payment_count,
    {_CAPTURED_AMOUNT} AS successful_payment_amount,
    avg(processing_time_ms) AS avg_processing_time_ms,
    max(completed_at) AS last_payment_completed_at"""
_GATEWAY_PAYMENTS = f"""{_VOLUME},
    {_CAPTURED} AS successful_payment_count, {_OTHER} AS failed_or_other_payment_count,
    avg(processing_time_ms) AS avg_processing_time_ms"""
_DAILY_PAYMENTS = f"""{_VOLUME},
    {_CAPTURED_AMOUNT} AS captured_payment_amount, {_CAPTURED} AS captured_payment_count"""

_DAYS = {
    "payments": "CAST(coalesce(completed_at, initiated_at) AS DATE)",
    "refunds": "CAST(coalesce(completed_at, requested_at) AS DATE)",
    "chargebacks": "CAST(created_at AS DATE)",
    "settlements": "CAST(coalesce(completed_at, initiated_at) AS DATE)",
}


def _with(body: str, views: dict[str, str] = VIEWS) -> str:
    names = ",\n".join(f"{name} AS ({text})" for name, text in views.items())
    return f"WITH {names}\n{body}"


def _by(table: str, key: str, measures: str) -> str:
    return f"SELECT {key}, {measures} FROM {table} GROUP BY {key}"


def _by_day(table: str, measures: str) -> str:
    return f"SELECT {_DAYS[table]} AS operation_date, {measures} FROM {table} GROUP BY 1"


def _zero(*names: str) -> str:
    return ", ".join(f"coalesce({n}, 0) AS {n}" for n in names)


_REVERSALS = (
    "refund_count", "total_refund_amount", "chargeback_count", "total_chargeback_amount",
    "settlement_count", "total_settlement_amount",
)


def _payment_performance(ids: str = "{}") -> str:
    """``ids`` formats an id column, e.g. as a cast to text."""
    id_columns = ("payment_id", "merchant_id", "customer_id", "invoice_id", "gateway_id")
    shown = ", ".join(f"{ids.format('p.' + c)} AS {c}" for c in id_columns)
    return f"""
        SELECT {shown}, p.payment_method_id, p.amount, p.currency, p.payment_status,
               p.payment_reference, p.initiated_at, p.completed_at, p.processing_time_ms,
               m.merchant_name, m.industry, m.risk_level,
               g.gateway_name, g.provider, g.gateway_type,
               pm.payment_method_name, pm.category,
               {_zero("attempt_count", "failed_attempt_count", "successful_attempt_count",
                      "max_attempt_number", "event_count", "total_retry_count")},
               last_event_timestamp, {_zero(*_REVERSALS)}
        FROM payments p
        LEFT JOIN merchants m ON p.merchant_id = m.merchant_id
        LEFT JOIN gateways g ON p.gateway_id = g.gateway_id
        LEFT JOIN methods pm ON p.payment_method_id = pm.payment_method_id
        LEFT JOIN ({_by("attempts", "payment_id", _ATTEMPTS)}) a ON p.payment_id = a.payment_id
        LEFT JOIN ({_by("lifecycle", "payment_id", _LIFECYCLE)}) e ON p.payment_id = e.payment_id
        LEFT JOIN ({_by("refunds", "payment_id", _REFUNDS)}) r ON p.payment_id = r.payment_id
        LEFT JOIN ({_by("chargebacks", "payment_id", _CHARGEBACKS)}) c
               ON p.payment_id = c.payment_id
        LEFT JOIN ({_by("settlements", "payment_id", _SETTLEMENTS)}) s
               ON p.payment_id = s.payment_id"""


def _merchant_performance(ids: str = "{}") -> str:
    return f"""
        SELECT {ids.format("m.merchant_id")} AS merchant_id, m.merchant_name, m.business_type,
               m.country, m.city, m.industry, m.risk_level, m.settlement_cycle,
               m.verification_status,
               {_zero("payment_count", "total_payment_amount", "successful_payment_count",
                      "non_successful_payment_count", "successful_payment_amount",
                      "avg_processing_time_ms", *_REVERSALS)},
               last_payment_completed_at
        FROM merchants m
        LEFT JOIN ({_by("payments", "merchant_id", _MERCHANT_PAYMENTS)}) p
               ON m.merchant_id = p.merchant_id
        LEFT JOIN ({_by("refunds", "merchant_id", _REFUNDS)}) r ON m.merchant_id = r.merchant_id
        LEFT JOIN ({_by("chargebacks", "merchant_id", _CHARGEBACKS)}) c
               ON m.merchant_id = c.merchant_id
        LEFT JOIN ({_by("settlements", "merchant_id", _SETTLEMENTS)}) s
               ON m.merchant_id = s.merchant_id"""


def _gateway_performance(ids: str = "{}") -> str:
    return f"""
        SELECT {ids.format("g.gateway_id")} AS gateway_id, g.gateway_name, g.provider,
               g.gateway_type, g.status,
               {_zero("payment_count", "total_payment_amount", "successful_payment_count",
                      "failed_or_other_payment_count", "avg_processing_time_ms",
                      "attempt_count", "failed_attempt_count", "successful_attempt_count",
                      "max_attempt_number")}
        FROM gateways g
        LEFT JOIN ({_by("payments", "gateway_id", _GATEWAY_PAYMENTS)}) p
               ON g.gateway_id = p.gateway_id
        LEFT JOIN ({_by("attempts", "gateway_id", _ATTEMPTS)}) a ON g.gateway_id = a.gateway_id"""


def _financial_operations() -> str:
    return f"""
        SELECT operation_date,
               {_zero("payment_count", "total_payment_amount", "captured_payment_amount",
                      "captured_payment_count", *_REVERSALS)},
               coalesce(captured_payment_amount, 0) - coalesce(total_refund_amount, 0)
                   - coalesce(total_chargeback_amount, 0) AS net_payment_amount
        FROM ({_by_day("payments", _DAILY_PAYMENTS)}) p
        FULL JOIN ({_by_day("refunds", _REFUNDS)}) r USING (operation_date)
        FULL JOIN ({_by_day("chargebacks", _CHARGEBACKS)}) c USING (operation_date)
        FULL JOIN ({_by_day("settlements", _SETTLEMENTS)}) s USING (operation_date)"""


PP, MP, GP, FO = (
    _payment_performance(), _merchant_performance(), _gateway_performance(),
    _financial_operations(),
)

_LINE_STATE = """
    SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_linestatus
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                     ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS _rank
          FROM lineitem WHERE {condition}) WHERE _rank = 1"""
_ALL_LINES = _LINE_STATE.format(condition="true")
_OPEN = _LINE_STATE.format(condition="l_linestatus = 'O'")
_DONE = _LINE_STATE.format(condition="l_linestatus = 'F'")

_ACTIVITY_CENTS = "CAST(ROUND(value * 100) AS BIGINT)"

# The records that arrive in one month.
BATCH = {
    **VIEWS,
    **{
        f"batch_{table}": f"""SELECT * FROM {table}
            WHERE {time} >= DATE '1995-03-01' AND {time} < DATE '1995-04-01'"""
        for table, time in (
            ("payments", "initiated_at"), ("refunds", "requested_at"),
            ("chargebacks", "created_at"), ("settlements", "initiated_at"),
        )
    },
}
_AFFECTED = """SELECT {key} FROM batch_payments UNION SELECT {key} FROM batch_refunds
    UNION SELECT {key} FROM batch_chargebacks UNION SELECT {key} FROM batch_settlements"""
_AFFECTED_DAYS = """SELECT CAST(initiated_at AS DATE) AS operation_date FROM batch_payments
    UNION SELECT CAST(completed_at AS DATE) FROM batch_payments WHERE completed_at IS NOT NULL
    UNION SELECT CAST(requested_at AS DATE) FROM batch_refunds
    UNION SELECT CAST(completed_at AS DATE) FROM batch_refunds WHERE completed_at IS NOT NULL
    UNION SELECT CAST(created_at AS DATE) FROM batch_chargebacks
    UNION SELECT CAST(initiated_at AS DATE) FROM batch_settlements
    UNION SELECT CAST(completed_at AS DATE) FROM batch_settlements
          WHERE completed_at IS NOT NULL"""

# Every fourth payment with another merchant, gateway and day.
MOVED = {
    **{k: v for k, v in VIEWS.items() if k != "payments"},
    "payments_before": VIEWS["payments"],
    "payments": """
        SELECT * REPLACE (
            CASE WHEN payment_id % 4 = 0 THEN 1 ELSE merchant_id END AS merchant_id,
            CASE WHEN payment_id % 4 = 0 THEN 7 ELSE gateway_id END AS gateway_id,
            CASE WHEN payment_id % 4 = 0 THEN initiated_at + INTERVAL 10 DAY
                 ELSE initiated_at END AS initiated_at,
            CASE WHEN payment_id % 4 = 0 THEN completed_at + INTERVAL 10 DAY
                 ELSE completed_at END AS completed_at)
        FROM payments_before""",
}

# The same over state with one row for each id.
MOVED_STATE = {
    **{k: v for k, v in STATE.items() if k != "payments"},
    "payments_before": MOVED["payments_before"],
    "payments": MOVED["payments"],
}

ORACLES: dict[str, str] = {
    "attempts_by_payment": _with(_by("attempts", "payment_id", _ATTEMPTS)),
    "events_by_payment": _with(_by("lifecycle", "payment_id", _LIFECYCLE)),
    "refunds_by_payment": _with(_by("refunds", "payment_id", _REFUNDS)),
    "chargebacks_by_payment": _with(_by("chargebacks", "payment_id", _CHARGEBACKS)),
    "settlements_by_payment": _with(_by("settlements", "payment_id", _SETTLEMENTS)),
    "payments_by_merchant": _with(_by("payments", "merchant_id", _MERCHANT_PAYMENTS)),
    "refunds_by_merchant": _with(_by("refunds", "merchant_id", _REFUNDS)),
    "chargebacks_by_merchant": _with(_by("chargebacks", "merchant_id", _CHARGEBACKS)),
    "settlements_by_merchant": _with(_by("settlements", "merchant_id", _SETTLEMENTS)),
    "payments_by_gateway": _with(_by("payments", "gateway_id", _GATEWAY_PAYMENTS)),
    "attempts_by_gateway": _with(_by("attempts", "gateway_id", _ATTEMPTS)),
    "payments_by_day": _with(_by_day("payments", _DAILY_PAYMENTS)),
    "refunds_by_day": _with(_by_day("refunds", _REFUNDS)),
    "chargebacks_by_day": _with(_by_day("chargebacks", _CHARGEBACKS)),
    "settlements_by_day": _with(_by_day("settlements", _SETTLEMENTS)),
    "payment_performance": _with(PP),
    "merchant_performance": _with(MP),
    "gateway_performance": _with(GP),
    "financial_operations": _with(FO),
    "payment_dataset": _with(PP),
    "dataset_row_counts": _with(
        f"""SELECT 'payment_performance' AS dataset, count(*) AS row_count FROM ({PP})
        UNION ALL SELECT 'merchant_performance', count(*) FROM ({MP})
        UNION ALL SELECT 'gateway_performance', count(*) FROM ({GP})
        UNION ALL SELECT 'financial_operations', count(*) FROM ({FO})"""
    ),
    "payment_count": """SELECT count(DISTINCT o_orderkey) AS payment_count,
        count(DISTINCT o_orderstatus) AS payment_status_count FROM orders""",
    "total_payment_amount": _with(
        "SELECT CAST(sum(amount) AS BIGINT) AS total_payment_amount FROM payments"
    ),
    "successful_payment_count": """SELECT count(*) AS successful_payment_count
        FROM orders WHERE o_orderstatus = 'F'""",
    "successful_payment_rate": """SELECT
        CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE)
            / count(DISTINCT o_orderkey) AS successful_payment_rate FROM orders""",
    "payment_status_distribution": _with(
        """SELECT payment_status, count(DISTINCT payment_id) AS payment_count
        FROM payments GROUP BY payment_status"""
    ),
    "weekly_payment_volume": _with(
        """SELECT CAST(date_trunc('week', initiated_at) AS DATE) AS week,
                  CAST(sum(amount) AS BIGINT) AS total_payment_amount
        FROM payments GROUP BY 1"""
    ),
    "merchant_volume": _with(
        f"""SELECT merchant_name, CAST(sum(amount) AS BIGINT) AS total_payment_amount
        FROM ({PP}) GROUP BY merchant_name"""
    ),
    "top_merchants": _with(
        f"""SELECT merchant_name, CAST(sum(amount) AS BIGINT) AS total_payment_amount
        FROM ({PP}) GROUP BY merchant_name
        ORDER BY total_payment_amount DESC, merchant_name LIMIT 10"""
    ),
    "gateway_payment_count": _with(
        f"""SELECT gateway_name, count(DISTINCT payment_id) AS payment_count
        FROM ({PP}) GROUP BY gateway_name"""
    ),
    "net_payment_trend": _with(
        f"""SELECT CAST(date_trunc('week', operation_date) AS DATE) AS week, net_payment_amount
        FROM ({FO})"""
    ),
    "net_payment_weekly": _with(
        f"""SELECT CAST(date_trunc('week', operation_date) AS DATE) AS week,
                   CAST(sum(net_payment_amount) AS BIGINT) AS net_payment_amount
        FROM ({FO}) GROUP BY 1"""
    ),
    "refund_total": _with(
        "SELECT CAST(sum(refund_amount) AS BIGINT) AS total_refund_amount FROM refunds"
    ),
    "chargeback_total": _with(
        "SELECT CAST(sum(amount) AS BIGINT) AS total_chargeback_amount FROM chargebacks"
    ),
    "lifecycle_violations": _with(
        f"""SELECT
            count(*) FILTER (WHERE payment_status <> 'Captured'
                AND refund_count + chargeback_count + settlement_count > 0)
                AS children_without_capture,
            count(*) FILTER (WHERE total_refund_amount > amount) AS refund_over_amount,
            count(*) FILTER (WHERE settlement_count > 0 AND total_settlement_amount <>
                greatest(0, amount - total_refund_amount - total_chargeback_amount))
                AS settlement_mismatch
        FROM ({PP})"""
    ),
    "merchant_account_pairs": """
        SELECT c_custkey AS merchant_id, c_name AS merchant_name, account_id, bank_name
        FROM customer JOIN (
            SELECT o_custkey, 'ACC' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS account_id,
                   o_orderpriority AS bank_name,
                   row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS _rank
            FROM orders) ON c_custkey = o_custkey
        WHERE _rank = 1""",
    "event_roundtrip": f"""SELECT event_type || '-events' AS topic,
            CAST(user_id % 3 AS INT) AS partition, event_id AS "offset", event_id, user_id,
            {_ACTIVITY_CENTS} AS value, props, ts AS kafka_timestamp, ts AS event_timestamp,
            ts AS created_at
        FROM events""",
    "raw_records": """SELECT event_type || '-events' AS topic,
            CAST(user_id % 3 AS INT) AS partition, event_id AS "offset",
            ts AS kafka_timestamp, props
        FROM events""",
    "tolerant_numbers": """SELECT event_id,
            CASE WHEN value = floor(value) THEN CAST(value AS BIGINT) END AS value
        FROM events""",
    "strict_numbers": f"""SELECT event_id, user_id,
            CASE WHEN event_id % 2 = 0 THEN {_ACTIVITY_CENTS} END AS value
        FROM events""",
    "malformed_events": f"""SELECT event_type || '-events' AS topic, count(*) AS record_count,
            count(*) FILTER (WHERE event_type IN ('error', 'view')) AS malformed,
            count(*) FILTER (WHERE event_type IN ('error', 'view')) AS null_event_id,
            count(*) FILTER (WHERE event_type = 'signup' AND {_ACTIVITY_CENTS} > 0)
                AS negative_value,
            count(*) FILTER (WHERE event_type = 'purchase') AS unreadable_created_at,
            count(*) FILTER (WHERE copy = 1 AND event_id % 10 = 0) AS duplicate_records,
            count(*) FILTER (WHERE copy = 1 AND event_type NOT IN ('error', 'view'))
                AS repeated_keys
        FROM events, (VALUES (0), (1)) AS copies(copy)
        WHERE copy = 0 OR event_id % 10 IN (0, 1)
        GROUP BY event_type""",
    "unreadable_values": """SELECT event_type || '-events' AS topic, event_id AS "offset",
            CASE WHEN value - 100 <> floor(value - 100) THEN 'unreadable:value'
                 ELSE 'negative:value' END AS errors
        FROM events
        WHERE value - 100 <> floor(value - 100) OR value - 100 < 0""",
    "refused_events": f"""SELECT event_type || '-events' AS topic, event_id AS "offset",
            CASE event_type WHEN 'signup' THEN 'negative:value'
                 WHEN 'purchase' THEN 'unreadable:created_at'
                 ELSE 'malformed,missing:event_id' END AS errors
        FROM events
        WHERE event_type IN ('error', 'view', 'purchase')
           OR (event_type = 'signup' AND {_ACTIVITY_CENTS} > 0)""",
    "undeclared_fields": """SELECT event_type || '-events' AS topic, field, count(*) AS records,
            CASE field WHEN 'user_id' THEN 'BIGINT' ELSE 'STRING' END AS kind
        FROM events, (VALUES ('user_id'), ('props'), ('created_at')) AS f(field)
        WHERE NOT (event_type = 'click' AND field = 'user_id')
        GROUP BY event_type, field""",
    "bad_event_times": """SELECT count(*) FILTER (WHERE event_type = 'error') AS bad_created_at,
            CAST(0 AS BIGINT) AS bad_due_date FROM events""",
    "required_nulls": """SELECT CAST(0 AS BIGINT) AS payment_id, CAST(0 AS BIGINT) AS merchant_id,
            count(*) FILTER (WHERE o_orderstatus <> 'F') AS completed_at,
            CAST(-1 AS BIGINT) AS absent_column
        FROM orders""",
    "negative_values": """SELECT count(*) FILTER (WHERE c_acctbal < 0) AS amount,
            count(*) FILTER (WHERE c_custkey < 0) AS refund_amount
        FROM customer""",
    "transport_duplicates": _with(
        """SELECT count(*) AS total_rows,
            count(DISTINCT (arrival % 3, CAST(requested_at AS DATE))) AS distinct_keys,
            count(*) - count(DISTINCT (arrival % 3, CAST(requested_at AS DATE)))
                AS duplicate_rows
        FROM refunds"""
    ),
    "key_duplicates": _with(
        """SELECT count(*) AS total_rows, count(DISTINCT attempt_id) AS distinct_keys,
            count(*) - count(DISTINCT attempt_id) AS duplicate_rows
        FROM attempts"""
    ),
    "grain_check": """SELECT count(*) AS total_rows, count(DISTINCT o_orderkey) AS distinct_keys
        FROM orders""",
    "id_hygiene": _with(
        f"SELECT count(*) FILTER (WHERE payment_reference LIKE '%-batch-%') AS bad_ids FROM ({PP})"
    ),
    "id_pattern_matches": _with(
        f"SELECT count(*) FILTER (WHERE payment_reference LIKE '%99%') AS bad_ids FROM ({PP})"
    ),
    "events_per_topic": """SELECT event_type || '-events' AS topic, count(*) AS event_count
        FROM events GROUP BY event_type ORDER BY topic""",
    "topic_counts": _with(
        """SELECT * FROM (
            SELECT 'merchant-events' AS topic, count(*) AS event_count FROM merchants
            UNION ALL SELECT 'payment-events', count(*) FROM payments
            UNION ALL SELECT 'refund-events', count(*) FROM refunds
            UNION ALL SELECT 'chargeback-events', count(*) FROM chargebacks
            UNION ALL SELECT 'settlement-events', count(*) FROM settlements)
        ORDER BY topic"""
    ),
    "keep_latest": _ALL_LINES,
    "upsert_snapshot": f"""
        WITH source AS ({_OPEN}), target AS ({_DONE})
        SELECT * FROM source
        UNION ALL
        SELECT t.* FROM target t WHERE NOT EXISTS (
            SELECT 1 FROM source s
            WHERE s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber)""",
    "upsert_newer_wins": _ALL_LINES,
    "upsert_ties": f"""SELECT * REPLACE (
            CASE WHEN l_orderkey % 2 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity)
        FROM ({_ALL_LINES})""",
    "affected_payments": _with(_AFFECTED.format(key="payment_id"), BATCH),
    "affected_merchants": _with(_AFFECTED.format(key="merchant_id"), BATCH),
    "affected_gateways": _with(
        """SELECT DISTINCT gateway_id FROM payments
        WHERE gateway_id IN (SELECT gateway_id FROM gateways WHERE provider = 'ASIA')"""
    ),
    "affected_days": _with(_AFFECTED_DAYS, BATCH),
    "incremental_payment_performance": _with(
        f"""SELECT * FROM ({PP})
        WHERE payment_id IN ({_AFFECTED.format(key="payment_id")})""",
        BATCH,
    ),
    "prefiltered_payment_performance": _with(
        f"""SELECT * FROM ({PP})
        WHERE payment_id IN ({_AFFECTED.format(key="payment_id")})""",
        BATCH,
    ),
    "incremental_merchant_performance": _with(
        f"""SELECT * FROM ({MP})
        WHERE merchant_id IN ({_AFFECTED.format(key="merchant_id")})""",
        BATCH,
    ),
    "incremental_gateway_performance": _with(
        f"SELECT * FROM ({GP}) WHERE provider = 'ASIA'"
    ),
    "incremental_financial_operations": _with(
        f"SELECT * FROM ({FO}) WHERE operation_date IN ({_AFFECTED_DAYS})", BATCH
    ),
    "bronze_stream_counts": """SELECT event_type || '-events' AS topic, count(*) AS event_count
        FROM events GROUP BY event_type ORDER BY topic""",
    "silver_stream_state": _with(
        """SELECT 'payments' AS entity, CAST(payment_id AS VARCHAR) AS id,
               CAST(payment_id AS VARCHAR) AS payment_id,
               CAST(merchant_id AS VARCHAR) AS merchant_id, amount,
               payment_id AS "offset", initiated_at AS kafka_timestamp FROM payments
        UNION ALL
        SELECT 'refunds', CAST(refund_id AS VARCHAR), CAST(payment_id AS VARCHAR),
               CAST(merchant_id AS VARCHAR), refund_amount, arrival, requested_at FROM refunds
        UNION ALL
        SELECT 'chargebacks', CAST(chargeback_id AS VARCHAR), CAST(payment_id AS VARCHAR),
               CAST(merchant_id AS VARCHAR), amount, arrival, created_at FROM chargebacks
        UNION ALL
        SELECT 'settlements', CAST(settlement_id AS VARCHAR), CAST(payment_id AS VARCHAR),
               CAST(merchant_id AS VARCHAR), settlement_amount, arrival, initiated_at
        FROM settlements""",
        STATE,
    ),
    "silver_all_entities": _with(
        """SELECT 'merchants' AS entity, CAST(merchant_id AS VARCHAR) AS id,
               CAST(NULL AS BIGINT) AS amount, TIMESTAMP '2020-01-01' AS kafka_timestamp
        FROM merchants
        UNION ALL SELECT 'customers', CAST(c_custkey AS VARCHAR), NULL, TIMESTAMP '2020-01-02'
        FROM customer
        UNION ALL SELECT 'invoices', CAST(invoice_id AS VARCHAR), amount, initiated_at
        FROM payments
        UNION ALL SELECT 'payments', CAST(payment_id AS VARCHAR), amount, initiated_at
        FROM payments
        UNION ALL SELECT 'refunds', CAST(refund_id AS VARCHAR), refund_amount, requested_at
        FROM refunds
        UNION ALL SELECT 'chargebacks', CAST(chargeback_id AS VARCHAR), amount, created_at
        FROM chargebacks
        UNION ALL SELECT 'settlements', CAST(settlement_id AS VARCHAR), settlement_amount,
               initiated_at FROM settlements""",
        STATE,
    ),
    "silver_last_arrival_state": _with(
        """SELECT CAST(payment_id AS VARCHAR) AS payment_id,
               CASE WHEN payment_id % 3 = 0 THEN amount + 1 ELSE amount END AS amount,
               CASE WHEN payment_id % 3 = 0 THEN initiated_at - INTERVAL 30 DAY
                    ELSE initiated_at END AS kafka_timestamp
        FROM payments"""
    ),
    "silver_replay_state": _with(
        """SELECT CAST(payment_id AS VARCHAR) AS payment_id, amount,
               initiated_at AS kafka_timestamp
        FROM payments"""
    ),
    "gold_after_moves": _with(
        f"""SELECT 'merchant_performance' AS metric, CAST(merchant_id AS VARCHAR) AS key,
               payment_count, total_payment_amount FROM ({MP})
        UNION ALL SELECT 'gateway_performance', CAST(gateway_id AS VARCHAR),
               payment_count, total_payment_amount FROM ({GP})
        UNION ALL SELECT 'financial_operations', CAST(operation_date AS VARCHAR),
               payment_count, total_payment_amount
        FROM ({_by_day("payments", _VOLUME)})""",
        MOVED,
    ),
    "kept_up_merchant_performance": _with(MP, MOVED_STATE),
    "kept_up_gateway_performance": _with(GP, MOVED_STATE),
    "monthly_financial_operations": _with(
        f"SELECT * FROM ({FO}) WHERE operation_date IN ({_AFFECTED_DAYS})", BATCH
    ),
    "bucketed_payment_performance": _with(PP),
    "attempts_by_merged_days": _with(
        "SELECT gateway_id, count(DISTINCT attempt_id) AS attempt_count FROM attempts GROUP BY gateway_id"
    ),
    "silver_added_column_state": _with(
        """SELECT CAST(payment_id AS VARCHAR) AS id, amount,
               CASE WHEN payment_id % 3 = 0 THEN processing_time_ms END AS processing_time_ms
        FROM payments"""
    ),
    "silver_winners_state": _with(
        """SELECT CAST(payment_id AS VARCHAR) AS payment_id,
               CASE WHEN payment_id % 3 = 0 THEN amount + 1 ELSE amount END AS amount,
               CASE WHEN payment_id % 3 = 0 THEN initiated_at - INTERVAL 30 DAY
                    ELSE initiated_at END AS kafka_timestamp
        FROM payments"""
    ),
    "gold_after_loads": _with(
        """SELECT CAST(p.payment_id AS VARCHAR) AS payment_id,
               CASE WHEN p.payment_id % 7 = 0 THEN 0 ELSE coalesce(attempt_count, 0) END AS attempt_count,
               CASE WHEN p.payment_id % 7 = 0 THEN 0 ELSE coalesce(failed_attempt_count, 0) END AS failed_attempt_count,
               CAST(CASE WHEN p.payment_id % 7 = 0 THEN 0
                    ELSE coalesce(max_attempt_number + CASE WHEN p.payment_id % 5 = 0 THEN 1 ELSE 0 END, 0) END AS INT)
                   AS max_attempt_number,
               CASE WHEN p.payment_id % 7 = 0 THEN 0 ELSE coalesce(event_count, 0) END AS event_count,
               CASE WHEN p.payment_id % 7 = 0 THEN 0
                    ELSE coalesce(total_retry_count + CASE WHEN p.payment_id % 5 = 0 THEN known ELSE 0 END, 0) END
                   AS total_retry_count
        FROM payments p
        LEFT JOIN (SELECT payment_id, count(*) AS attempt_count,
                   count(*) FILTER (WHERE attempt_status = 'Failed') AS failed_attempt_count,
                   max(attempt_number) AS max_attempt_number FROM attempts GROUP BY payment_id) a
               ON a.payment_id = p.payment_id
        LEFT JOIN (SELECT payment_id, count(*) AS event_count, count(retry_count) AS known,
                   CAST(sum(coalesce(retry_count, 0)) AS BIGINT) AS total_retry_count FROM lifecycle GROUP BY payment_id) e
               ON e.payment_id = p.payment_id""",
        STATE,
    ),
    "gold_following_merchants": _with(
        """SELECT CAST(p.payment_id AS VARCHAR) AS payment_id, CAST(p.merchant_id AS VARCHAR) AS merchant_id,
               CASE WHEN m.merchant_id % 3 = 0 THEN 'New ' || m.merchant_name ELSE m.merchant_name END AS merchant_name,
               p.amount
        FROM payments p LEFT JOIN merchants m ON m.merchant_id = p.merchant_id"""
    ),
    "static_typed_state": _with(
        """SELECT 'merchant_bank_accounts' AS dataset,
               'ACC' || lpad(CAST(payment_id AS VARCHAR), 12, '0') AS id,
               CAST(merchant_id AS VARCHAR) AS detail, payment_id AS number,
               initiated_at AS time
        FROM payments
        UNION ALL SELECT 'payment_methods', payment_method_id, category, NULL, NULL FROM methods
        UNION ALL SELECT 'payment_gateways', CAST(gateway_id AS VARCHAR), provider, NULL, NULL
        FROM gateways
        UNION ALL SELECT 'payment_attempts', CAST(attempt_id AS VARCHAR), attempt_status,
               attempt_number, NULL FROM attempts""",
        STATE,
    ),
    "static_silver_state": """SELECT CAST(event_id AS VARCHAR) AS event_id,
            CAST(user_id AS VARCHAR) AS payment_id,
            CAST(json_extract_string(props, '$.k') AS INT) AS retry_count,
            ts AS event_timestamp
        FROM events""",
    "gold_stream_state": _with(_payment_performance("CAST({} AS VARCHAR)"), STATE),
    "gold_stream_merchants": _with(
        f"""SELECT * FROM ({_merchant_performance("CAST({} AS VARCHAR)")})""", STATE
    ),
    "gold_stream_gateways": _with(
        f"""SELECT * FROM ({_gateway_performance("CAST({} AS VARCHAR)")})""", STATE
    ),
    "gold_stream_days": _with(FO, STATE),
}
