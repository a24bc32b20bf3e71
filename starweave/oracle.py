"""Reference SQL for the correctness gate (DuckDB dialect).

Written independently of the Spark plans: the source adapter and every model
as CTEs over the driver's tables, then one SELECT per registered query.
Column names and types are aligned with the Spark output (dw_updated_at is
left out on both sides).
"""

from __future__ import annotations


TS_KEY = "'%Y-%m-%d %H:%M:%S.%g'"

ADAPTER = f"""
raw_events AS (
  SELECT 'evt_' || CAST(event_id AS VARCHAR) AS event_id,
         'session_' || CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y%m%d') AS session_id,
         CASE event_type WHEN 'signup' THEN 'booking_started' WHEN 'purchase' THEN 'booking_submitted'
              WHEN 'view' THEN 'pro_viewed' WHEN 'click' THEN 'pro_viewed' WHEN 'error' THEN 'error' END AS event_type,
         ts AS event_ts,
         CASE WHEN event_type = 'purchase' AND event_id % 10 <> 0
              THEN '{{"sr_id": "sr_' || CAST(event_id AS VARCHAR) || '"}}' ELSE '{{}}' END AS properties,
         ts AS _loaded_at, 'events' AS _source_file
  FROM events
),
raw_sessions AS (
  SELECT session_id, min(ts) AS started_at,
         CASE WHEN max(event_id) % 5 <> 0 THEN max(ts) END AS ended_at,
         CASE min(event_id) % 4 WHEN 0 THEN 'home' WHEN 1 THEN 'search' WHEN 2 THEN 'booking_form'
              WHEN 3 THEN 'confirmation' END AS page_type,
         max(ts) AS updated_at, max(ts) AS _loaded_at, 'events' AS _source_file
  FROM (SELECT 'session_' || CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y%m%d') AS session_id,
               ts, event_id FROM events WHERE user_id % 11 <> 0)
  GROUP BY session_id
),
service_requests AS (
  SELECT sr_id, created_at, status, category, geography, sp_id,
         created_at + to_days(CAST(okey % 4 AS INTEGER)) AS updated_at,
         created_at + to_days(CAST(okey % 4 AS INTEGER)) AS _loaded_at, 'orders' AS _source_file
  FROM (
    SELECT o.o_orderkey AS okey, 'sr_' || CAST(o.o_orderkey AS VARCHAR) AS sr_id,
           o.o_orderdate + INTERVAL 25 YEAR AS created_at,
           CASE WHEN o.o_orderstatus = 'F' THEN 'completed' WHEN o.o_orderstatus = 'P' THEN 'matched'
                WHEN o.o_orderstatus = 'O' AND o.o_orderkey % 4 = 0 THEN 'cancelled'
                WHEN o.o_orderstatus = 'O' THEN 'submitted' END AS status,
           lower(c.c_mktsegment) AS category, lower(n.n_name) AS geography,
           'sp_' || CAST(l.min_supp AS VARCHAR) AS sp_id
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS min_supp FROM lineitem GROUP BY l_orderkey) l
      ON o.o_orderkey = l.l_orderkey)
),
raw_pro_profiles AS (
  SELECT *, updated_at AS _loaded_at, 'lineitem' AS _source_file FROM (
    SELECT DISTINCT 'sp_' || CAST(l.l_suppkey AS VARCHAR) AS sp_id, lower(n.n_name) AS market,
           lower(c.c_mktsegment) AS category,
           (l.l_suppkey + month(l.l_shipdate)) % 7 <> 0 AS is_active,
           CAST(date_trunc('month', l.l_shipdate) AS TIMESTAMP) + INTERVAL 25 YEAR AS updated_at
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN supplier s ON l.l_suppkey = s.s_suppkey
    JOIN nation n ON s.s_nationkey = n.n_nationkey)
),
raw_payments AS (
  SELECT payment_id, sr_id, payment_ts, payment_method, payment_status, gross_amount,
         commission_rate, commission_amount,
         CAST(gross_amount - commission_amount AS DECIMAL(14,2)) AS pro_payout_amount,
         payment_ts + to_days(CAST(okey % 3 AS INTEGER)) AS updated_at,
         payment_ts + to_days(CAST(okey % 3 AS INTEGER)) AS _loaded_at, 'lineitem' AS _source_file
  FROM (
    SELECT *, CAST(round(gross_amount * commission_rate, 2) AS DECIMAL(14,2)) AS commission_amount FROM (
      SELECT l_orderkey AS okey,
             'pay_' || CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS payment_id,
             'sr_' || CAST(l_orderkey AS VARCHAR) AS sr_id,
             max(l_shipdate) + INTERVAL 25 YEAR AS payment_ts,
             CASE l_linenumber % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'debit_card' WHEN 2 THEN 'ach'
                  WHEN 3 THEN 'digital_wallet' END AS payment_method,
             CASE WHEN max(l_returnflag) = 'A' THEN 'completed'
                  WHEN max(l_returnflag) = 'R' AND l_linenumber = 7 THEN 'chargeback'
                  WHEN max(l_returnflag) = 'R' AND l_linenumber <= 2 THEN 'refunded'
                  WHEN max(l_returnflag) = 'R' THEN 'completed'
                  WHEN max(l_returnflag) = 'N' AND l_linenumber = 6 THEN 'failed'
                  WHEN max(l_returnflag) = 'N' THEN 'pending' END AS payment_status,
             CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(14,2)) AS gross_amount,
             CAST(0.15 + max(CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(6,4)) AS commission_rate
      FROM lineitem GROUP BY l_orderkey, l_linenumber))
)"""


def _dims(sr="service_requests", sessions="raw_sessions", profiles="raw_pro_profiles"):
    return f"""
dim_date AS (
  SELECT strftime(d, '%Y%m%d') AS date_key, d AS full_date, CAST(year(d) AS INTEGER) AS year,
         CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
         strftime(d, '%b') AS month_name, CAST(weekofyear(d) AS INTEGER) AS week,
         strftime(d, '%a') AS day_of_week, CAST(isodow(d) AS INTEGER) AS day_of_week_num,
         isodow(d) IN (6, 7) AS is_weekend, false AS is_holiday,
         CAST(NULL AS SMALLINT) AS fiscal_year, CAST(NULL AS SMALLINT) AS fiscal_quarter,
         CAST(NULL AS VARCHAR) AS fiscal_period
  FROM (SELECT CAST(range AS DATE) AS d FROM range(DATE '2020-01-01', DATE '2035-12-31', INTERVAL 1 DAY))
),
dim_category AS (
  SELECT sha256(category) AS category_key, category, CAST(NULL AS VARCHAR) AS vertical,
         false AS is_seasonal, CAST(NULL AS DECIMAL(12,2)) AS avg_ticket_usd,
         CAST(NULL AS BOOLEAN) AS license_required
  FROM (SELECT DISTINCT category FROM {sr} WHERE category IS NOT NULL)
),
dim_geography AS (
  SELECT sha256(geography) AS geography_key, geography, CAST(NULL AS VARCHAR) AS city,
         CAST(NULL AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS state_code,
         CAST(NULL AS VARCHAR) AS region, CAST(NULL AS VARCHAR) AS market_tier,
         CAST(NULL AS VARCHAR) AS dma_code, CAST(NULL AS VARCHAR) AS dma_name,
         CAST(NULL AS DECIMAL(9,6)) AS latitude, CAST(NULL AS DECIMAL(9,6)) AS longitude
  FROM (SELECT DISTINCT geography FROM {sr} WHERE geography IS NOT NULL)
),
dim_session AS (
  SELECT session_id AS session_key, session_id, started_at, ended_at,
         date_diff('second', started_at, ended_at) AS session_duration_sec, page_type,
         ended_at IS NOT NULL AS is_clean_end
  FROM {sessions}
),
dim_pro AS (
  SELECT sha256(coalesce(sp_id, 'null') || '|' || coalesce(category, 'null') || '|' ||
                coalesce(strftime(updated_at, {TS_KEY}), 'null')) AS pro_key,
         sp_id, sha256(category) AS category_key, market, is_active, first_active_at, last_active_at,
         CAST(NULL AS VARCHAR) AS tier, CAST(NULL AS DECIMAL(3,2)) AS rating,
         CAST(NULL AS INTEGER) AS review_count, updated_at AS valid_from,
         CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current
  FROM (SELECT *, row_number() OVER (PARTITION BY sp_id, category
                    ORDER BY updated_at DESC NULLS LAST, market DESC NULLS LAST, is_active DESC NULLS LAST) AS rn,
               min(updated_at) OVER (PARTITION BY sp_id) AS first_active_at,
               max(updated_at) OVER (PARTITION BY sp_id) AS last_active_at
        FROM {profiles})
  WHERE rn = 1
),
dim_service_request AS (
  SELECT sha256(coalesce(sr.sr_id, 'null') || '|' || coalesce(strftime(sr.updated_at, {TS_KEY}), 'null'))
           AS service_request_key,
         sr.sr_id, sr.created_at, sr.status, sr.sp_id, dc.category_key, dg.geography_key,
         coalesce(sr.status = 'completed', false) AS is_completed,
         coalesce(sr.status = 'cancelled', false) AS is_cancelled,
         CAST(NULL AS VARCHAR) AS homeowner_key, sr.updated_at AS valid_from,
         CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current
  FROM {sr} sr LEFT JOIN dim_category dc ON sr.category = dc.category
  LEFT JOIN dim_geography dg ON sr.geography = dg.geography
)"""


def _facts(ev="raw_events", sr="service_requests", pay="raw_payments"):
    return f"""
fct_booking_events AS (
  SELECT sha256(coalesce(session_id, 'null') || '|' || coalesce(sr_id, 'null')) AS booking_event_key,
         session_id, sr_id, event_ts AS first_booking_ts, strftime(event_ts, '%Y%m%d') AS event_date,
         CAST(current_timestamp AS TIMESTAMP) AS dw_updated_at
  FROM (SELECT event_id, session_id, event_ts, json_extract_string(properties, '$.sr_id') AS sr_id,
               row_number() OVER (PARTITION BY session_id ORDER BY event_ts, event_id) AS rn
        FROM {ev}
        WHERE event_type = 'booking_submitted'
          AND json_extract_string(properties, '$.sr_id') IS NOT NULL)
  WHERE rn = 1
),
se_src AS (
  SELECT event_id, session_id, event_type, event_ts,
         json_extract_string(properties, '$.sr_id') AS properties_sr_id,
         CAST(row_number() OVER (PARTITION BY session_id ORDER BY event_ts, event_id) AS INTEGER) AS seq,
         lag(event_ts) OVER (PARTITION BY session_id ORDER BY event_ts, event_id) AS prev_ts,
         min(event_ts) OVER (PARTITION BY session_id) AS first_ts,
         max(event_ts) OVER (PARTITION BY session_id) AS last_ts
  FROM {ev}
),
se_aggs AS (
  SELECT session_id, count(*) AS session_event_count,
         CAST(sum(CASE WHEN event_type = 'booking_started' THEN 1 ELSE 0 END) AS BIGINT) AS session_booking_started_count,
         CAST(sum(CASE WHEN event_type = 'booking_submitted' THEN 1 ELSE 0 END) AS BIGINT) AS session_booking_submitted_count,
         CAST(sum(CASE WHEN event_type = 'pro_viewed' THEN 1 ELSE 0 END) AS BIGINT) AS session_pro_viewed_count,
         max(CASE WHEN event_type = 'booking_submitted' THEN 1 ELSE 0 END) AS session_has_booking
  FROM {ev} GROUP BY session_id
),
fct_session_events AS (
  SELECT sha256(coalesce(q.event_id, 'null') || '|' || coalesce(q.session_id, 'null') || '|' ||
                coalesce(strftime(q.event_ts, {TS_KEY}), 'null')) AS event_key,
         q.event_id, coalesce(s.session_key, q.session_id) AS session_key, q.event_type, q.event_ts,
         CAST(q.event_ts AS DATE) AS event_date_key, q.properties_sr_id,
         s.started_at AS session_started_at, s.ended_at AS session_ended_at, s.session_duration_sec,
         s.is_clean_end, a.session_event_count,
         CASE WHEN a.session_event_count = 1 THEN 1 ELSE 0 END AS is_bounce_session,
         date_diff('second', s.started_at, q.event_ts) AS seconds_since_session_start,
         s.page_type,
         CASE WHEN s.page_type = 'home' THEN 1 ELSE 0 END AS is_home_page,
         CASE WHEN s.page_type = 'search' THEN 1 ELSE 0 END AS is_search_page,
         CASE WHEN s.page_type = 'booking_form' THEN 1 ELSE 0 END AS is_booking_form_page,
         CASE WHEN s.page_type = 'confirmation' THEN 1 ELSE 0 END AS is_confirmation_page,
         q.seq AS event_sequence_number,
         CASE WHEN q.event_ts = q.first_ts THEN 1 ELSE 0 END AS is_first_event_in_session,
         CASE WHEN q.event_ts = q.last_ts THEN 1 ELSE 0 END AS is_last_event_in_session,
         date_diff('second', q.prev_ts, q.event_ts) AS seconds_since_prev_event,
         CASE WHEN q.properties_sr_id IS NOT NULL THEN 1 ELSE 0 END AS has_sr_id,
         CASE WHEN q.event_type = 'booking_started' THEN 1 ELSE 0 END AS is_booking_started,
         CASE WHEN q.event_type = 'booking_submitted' THEN 1 ELSE 0 END AS is_booking_submitted,
         CASE WHEN q.event_type = 'pro_viewed' THEN 1 ELSE 0 END AS is_pro_viewed,
         a.session_booking_started_count, a.session_booking_submitted_count,
         a.session_pro_viewed_count, a.session_has_booking AS session_has_booking_submitted,
         CAST(current_timestamp AS TIMESTAMP) AS dw_updated_at
  FROM se_src q LEFT JOIN dim_session s ON q.session_id = s.session_id
  LEFT JOIN se_aggs a ON q.session_id = a.session_id
),
cur_pro AS (SELECT sp_id, category_key, pro_key, market, is_active FROM dim_pro WHERE is_current),
cur_dsr AS (SELECT * FROM dim_service_request WHERE is_current),
first_booking AS (
  SELECT sr_id, first_booking_ts, session_id FROM (
    SELECT *, row_number() OVER (PARTITION BY sr_id ORDER BY first_booking_ts, session_id) AS rn
    FROM fct_booking_events) WHERE rn = 1
),
fct_booking_funnel AS (
  SELECT sr.sr_id AS booking_key, sr.sr_id, coalesce(s.session_key, 'unknown') AS session_key,
         d.service_request_key, sr.sp_id, p.pro_key, strftime(sr.created_at, '%Y%m%d') AS created_at_date_key,
         dg.geography_key, dc.category_key, s.started_at AS session_started_at, b.first_booking_ts,
         CASE WHEN sr.status = 'completed' THEN 1 ELSE 0 END AS is_converted,
         CASE WHEN sr.status = 'cancelled' THEN 1 ELSE 0 END AS is_cancelled,
         CASE WHEN sr.status IN ('matched', 'completed') THEN 1 ELSE 0 END AS is_matched,
         p.market, p.is_active AS pro_is_active, CAST(current_timestamp AS TIMESTAMP) AS dw_updated_at
  FROM {sr} sr
  LEFT JOIN dim_category dc ON sr.category = dc.category
  LEFT JOIN dim_geography dg ON sr.geography = dg.geography
  JOIN first_booking b ON sr.sr_id = b.sr_id
  LEFT JOIN cur_dsr d ON sr.sr_id = d.sr_id
  LEFT JOIN dim_session s ON b.session_id = s.session_id
  LEFT JOIN cur_pro p ON sr.sp_id = p.sp_id AND dc.category_key = p.category_key
),
fct_revenue AS (
  SELECT sha256(pay.payment_id) AS revenue_key, pay.payment_id, pay.sr_id, d.service_request_key,
         sr.sp_id, p.pro_key, strftime(pay.payment_ts, '%Y%m%d') AS payment_date_key,
         dc.category_key, dg.geography_key, pay.payment_ts, pay.payment_method, pay.payment_status,
         pay.gross_amount, pay.commission_rate, pay.commission_amount AS platform_commission,
         pay.pro_payout_amount,
         CASE WHEN pay.payment_status = 'completed' THEN 1 ELSE 0 END AS is_settled,
         CASE WHEN pay.payment_status = 'refunded' THEN 1 ELSE 0 END AS is_refunded,
         CASE WHEN pay.payment_status = 'chargeback' THEN 1 ELSE 0 END AS is_chargeback,
         CASE WHEN pay.payment_status = 'pending' THEN 1 ELSE 0 END AS is_pending,
         CAST(CASE WHEN pay.payment_status = 'completed' THEN pay.commission_amount
                   WHEN pay.payment_status IN ('refunded', 'chargeback') THEN -1 * pay.commission_amount
                   ELSE 0 END AS DECIMAL(14,2)) AS net_platform_revenue,
         CAST(CASE WHEN pay.payment_status = 'completed' THEN pay.pro_payout_amount
                   WHEN pay.payment_status IN ('refunded', 'chargeback') THEN -1 * pay.pro_payout_amount
                   ELSE 0 END AS DECIMAL(14,2)) AS net_pro_payout,
         d.status AS sr_status, coalesce(d.is_completed, false) AS sr_is_completed,
         p.market, p.is_active AS pro_is_active, CAST(current_timestamp AS TIMESTAMP) AS dw_updated_at
  FROM {pay} pay JOIN {sr} sr ON pay.sr_id = sr.sr_id
  LEFT JOIN dim_category dc ON sr.category = dc.category
  LEFT JOIN dim_geography dg ON sr.geography = dg.geography
  LEFT JOIN cur_dsr d ON pay.sr_id = d.sr_id
  LEFT JOIN cur_pro p ON sr.sp_id = p.sp_id AND dc.category_key = p.category_key
)"""


PREFIX = "WITH " + ADAPTER + "," + _dims() + "," + _facts()


def q(body: str) -> str:
    return PREFIX + "\n" + body


def r9(expr: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 9)"


def ratio(num: str, den: str) -> str:
    return f"round(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0), 9)"


MODEL_SQL = {name: q(f"SELECT * EXCLUDE (dw_updated_at) FROM {name}" if name.startswith("fct_")
                     else f"SELECT * FROM {name}") for name in [
    "dim_date", "dim_category", "dim_geography", "dim_session", "dim_pro", "dim_service_request",
    "fct_booking_events", "fct_session_events", "fct_booking_funnel", "fct_revenue"]}

# A third of the events in one session, a tenth of the others in none.
HOT_SQL = "WITH " + ADAPTER + """,
hot_events AS (
  SELECT * REPLACE (CASE WHEN CAST(substr(event_id, 5) AS BIGINT) % 3 = 0 THEN 'session_hot'
                         WHEN CAST(substr(event_id, 5) AS BIGINT) % 10 <> 1 THEN session_id END AS session_id)
  FROM raw_events
),
hot_sessions AS (
  SELECT session_id, started_at, ended_at, page_type, updated_at FROM raw_sessions
  UNION ALL
  SELECT 'session_hot', min(started_at), min(ended_at), min(page_type), min(updated_at) FROM raw_sessions
),""" + _dims(sessions="hot_sessions") + "," + _facts(ev="hot_events") + """
SELECT * EXCLUDE (dw_updated_at) FROM fct_session_events"""

# Events whose properties are null, cut off, or hold a number or JSON null; text that
# is no JSON is told apart before any path is read.
MIXED = """,
mixed_text AS (
  SELECT * REPLACE (CASE WHEN CAST(substr(event_id, 5) AS BIGINT) % 23 = 0 THEN NULL
                         WHEN CAST(substr(event_id, 5) AS BIGINT) % 19 = 0 THEN properties[:-2]
                         WHEN CAST(substr(event_id, 5) AS BIGINT) % 17 = 0 THEN '{"sr_id": ' || substr(event_id, 5) || '}'
                         WHEN CAST(substr(event_id, 5) AS BIGINT) % 13 = 0 THEN '{"sr_id": null}'
                         ELSE properties END AS properties)
  FROM raw_events
),
mixed_events AS (
  SELECT * REPLACE (CASE WHEN json_valid(properties) THEN properties END AS properties),
         CASE WHEN NOT json_valid(properties) THEN properties END AS malformed
  FROM mixed_text
)"""
PARSED_SQL = {
    **{f"{m}_parsed": "WITH " + ADAPTER + MIXED + "," + _dims() + "," + _facts(ev="mixed_events")
       + f"SELECT * EXCLUDE (dw_updated_at) FROM {m}" for m in ["fct_session_events", "fct_booking_events"]},
    "parsed_properties": "WITH " + ADAPTER + MIXED + """
SELECT event_id, json_extract_string(properties, '$.sr_id') AS properties_sr_id, malformed AS properties_malformed,
       properties IS NOT NULL AS is_json FROM mixed_events""",
    "properties_report": "WITH " + ADAPTER + MIXED + """
SELECT event_type, count(*) AS n_events, count(*) FILTER (WHERE properties IS NULL AND malformed IS NULL) AS n_absent,
       count(malformed) AS n_malformed, count(json_extract_string(properties, '$.sr_id')) AS n_sr_id,
       round(count(malformed) / nullif(count(*) FILTER (WHERE properties IS NOT NULL OR malformed IS NOT NULL), 0), 9) AS malformed_share
FROM mixed_events GROUP BY event_type""",
}

SOURCE_SQL = {name: q(f"SELECT * FROM {name}") for name in [
    "raw_events", "raw_sessions", "service_requests", "raw_pro_profiles", "raw_payments"]}


def _conv(dims: list[str], join_date: bool = False, where: str = "") -> str:
    sel = ", ".join(dims + [""]) if dims else ""
    src = ("fct_booking_funnel f LEFT JOIN (SELECT *, CAST(date_trunc('week', full_date) AS DATE) AS week_start "
           "FROM dim_date) dd ON f.created_at_date_key = dd.date_key"
           if join_date else "fct_booking_funnel f")
    grp = f" GROUP BY {', '.join(dims)}" if dims else ""
    return q(f"""SELECT {sel}
  count(DISTINCT CASE WHEN is_converted = 1 THEN booking_key END) AS converted_bookings,
  count(DISTINCT booking_key) AS total_bookings,
  {ratio("count(DISTINCT CASE WHEN is_converted = 1 THEN booking_key END)", "count(DISTINCT booking_key)")}
    AS booking_conversion_rate
FROM {src}{where}{grp}""")


def _rev(dims: list[str], join_date: bool = False, cols: str = "*", where: str = "") -> str:
    sel = ", ".join(dims + [""]) if dims else ""
    src = ("fct_revenue r LEFT JOIN dim_date dd ON r.payment_date_key = dd.date_key"
           if join_date else "fct_revenue r")
    grp = f" GROUP BY {', '.join(dims)}" if dims else ""
    gross = "sum(CASE WHEN payment_status = 'completed' THEN gross_amount END)"
    ref = "count(*) FILTER (WHERE is_refunded = 1)"
    sor = "count(*) FILTER (WHERE is_settled = 1 OR is_refunded = 1)"
    return q(f"""SELECT {cols} FROM (SELECT {sel}
  CAST({gross} AS DECIMAL(24,2)) AS gross_revenue,
  CAST(sum(net_platform_revenue) AS DECIMAL(24,2)) AS net_platform_revenue,
  CAST(sum(net_pro_payout) AS DECIMAL(24,2)) AS net_pro_payout,
  {ratio("sum(net_platform_revenue)", gross)} AS effective_take_rate,
  {ref} AS refunded_payments, {sor} AS settled_or_refunded_payments,
  {ratio(ref, sor)} AS refund_rate
FROM {src}{where}{grp})""")


IN_WINDOW = " WHERE {} BETWEEN '20200601' AND '20200614'"

METRIC_SQL = {
    "booking_conversion_rate": _conv([]),
    "conversion_by_category": _conv(["category_key"]),
    "conversion_by_geography": _conv(["geography_key"]),
    "conversion_by_month": _conv(["year", "month"], join_date=True),
    "conversion_by_weekend": _conv(["is_weekend"], join_date=True),
    "conversion_by_week": _conv(["week_start"], join_date=True),
    "conversion_by_calendar": _conv(["quarter", "month_name", "week", "day_of_week", "day_of_week_num"],
                                    join_date=True),
    "conversion_among_matched": _conv(["is_matched"]),
    "conversion_in_window": _conv(["category_key"], where=IN_WINDOW.format("created_at_date_key")),
    "revenue_in_window": _rev(["payment_method"], where=IN_WINDOW.format("payment_date_key")),
    "cancellation_rate": q(f"""SELECT CAST(sum(is_cancelled) AS BIGINT) AS cancelled_bookings,
  count(DISTINCT booking_key) AS total_bookings,
  {ratio("sum(is_cancelled)", "count(DISTINCT booking_key)")} AS cancellation_rate
FROM fct_booking_funnel"""),
    "session_to_booking_rate": q(f"""SELECT
  count(DISTINCT CASE WHEN session_has_booking_submitted = 1 THEN session_key END) AS sessions_with_booking,
  count(DISTINCT session_key) AS total_sessions,
  {ratio("count(DISTINCT CASE WHEN session_has_booking_submitted = 1 THEN session_key END)",
         "count(DISTINCT session_key)")} AS session_to_booking_rate
FROM fct_session_events"""),
    "revenue_summary": _rev([]),
    "gross_revenue": _rev([], cols="gross_revenue"),
    "net_platform_revenue": _rev([], cols="net_platform_revenue"),
    "net_pro_payout": _rev([], cols="net_pro_payout"),
    "effective_take_rate": _rev([], cols="effective_take_rate"),
    "refund_rate": _rev([], cols="refunded_payments, settled_or_refunded_payments, refund_rate"),
    "revenue_by_category": _rev(["category_key"]),
    "revenue_by_month": _rev(["year", "month"], join_date=True),
    "revenue_by_method": _rev(["payment_method"]),
    "revenue_by_sr_status": _rev(["sr_status"]),
    "revenue_by_geography": _rev(["geography_key"]),
    "revenue_by_status": _rev(["payment_status"]),
    "bounce_rate": q(f"""SELECT CAST(sum(is_bounce_session * is_first_event_in_session) AS BIGINT) AS bounce_sessions,
  count(DISTINCT session_key) AS total_sessions,
  {ratio("sum(is_bounce_session * is_first_event_in_session)", "count(DISTINCT session_key)")} AS bounce_rate
FROM fct_session_events"""),
    "avg_session_depth": q(f"""SELECT {r9("avg(CASE WHEN is_first_event_in_session = 1 THEN session_event_count END)")}
  AS avg_session_depth FROM fct_session_events"""),
    "avg_session_duration": q(f"""SELECT {r9("avg(CASE WHEN is_first_event_in_session = 1 THEN session_duration_sec END)")}
  AS avg_session_duration_sec FROM fct_session_events"""),
    "events_by_entry_page": q("""SELECT page_type, count(*) AS n_events FROM fct_session_events
  GROUP BY page_type"""),
    "booking_rate_by_entry_page": q(f"""SELECT page_type,
  CAST(sum(is_booking_submitted) AS BIGINT) AS booking_submitted_events,
  count(DISTINCT session_key) AS sessions,
  {ratio("sum(is_booking_submitted)", "count(DISTINCT session_key)")} AS booking_rate
FROM fct_session_events GROUP BY page_type"""),
    "avg_seconds_between_events": q(f"""SELECT
  {r9("avg(CASE WHEN event_sequence_number > 1 THEN seconds_since_prev_event END)")}
  AS avg_seconds_between_events FROM fct_session_events"""),
    "funnel_drop_off": q(f"""SELECT CAST(sum(is_booking_started) AS BIGINT) AS booking_started,
  CAST(sum(is_booking_submitted) AS BIGINT) AS booking_submitted,
  CAST(sum(is_booking_started) - sum(is_booking_submitted) AS BIGINT) AS drop_off,
  {ratio("sum(is_booking_submitted)", "sum(is_booking_started)")} AS submit_per_start
FROM fct_session_events"""),
    "sessions_with_conversion": q("""SELECT
  count(DISTINCT CASE WHEN session_has_booking_submitted = 1 THEN session_key END) AS sessions_with_conversion
FROM fct_session_events"""),
    "session_funnel_naive": q("""SELECT s.session_id, be.sr_id, s.started_at, be.first_booking_ts,
  sr.status, sr.category, sr.geography,
  CASE WHEN sr.status = 'completed' THEN 1 ELSE 0 END AS is_converted,
  coalesce(p.n, 0) AS pro_profile_rows, greatest(coalesce(p.n, 0), 1) AS naive_row_multiplicity
FROM raw_sessions s
LEFT JOIN (SELECT session_id, min(event_ts) AS first_booking_ts,
                  min(json_extract_string(properties, '$.sr_id')) AS sr_id
           FROM raw_events WHERE event_type = 'booking_submitted' GROUP BY session_id) be
  ON s.session_id = be.session_id
LEFT JOIN service_requests sr ON be.sr_id = sr.sr_id
LEFT JOIN (SELECT sp_id, count(*) AS n FROM raw_pro_profiles GROUP BY sp_id) p ON sr.sp_id = p.sp_id"""),
}


# The declared checks, written out here so that one that the engine
# lacks shows. Per line: severity, model, its columns; values and parents below.
CHECKS = {
    "unique": """
        error raw_events event_id
        error raw_sessions session_id
        error service_requests sr_id
        error raw_payments payment_id
        error fct_booking_events booking_event_key session_id
        error fct_session_events event_key
        error fct_booking_funnel booking_key
        error fct_revenue revenue_key payment_id""",
    "not_null": """
        error raw_events event_id event_ts
        error raw_sessions session_id started_at
        error service_requests sr_id created_at
        error raw_pro_profiles sp_id is_active
        error raw_payments payment_id sr_id payment_ts payment_status gross_amount commission_rate
        error fct_booking_events booking_event_key session_id sr_id first_booking_ts event_date dw_updated_at
        error fct_session_events event_key event_id event_type event_ts dw_updated_at
        error fct_booking_funnel booking_key
        error fct_revenue revenue_key payment_id sr_id payment_date_key gross_amount commission_rate payment_status dw_updated_at""",
    "accepted_values": """
        error raw_payments payment_status
        warn fct_session_events event_type
        error fct_revenue payment_status""",
    "relationships": """
        error fct_booking_events event_date
        error fct_revenue payment_date_key""",
}
ACCEPTED = {
    "payment_status": "'pending', 'completed', 'refunded', 'failed', 'chargeback'",
    "event_type": "'booking_started', 'booking_submitted', 'pro_viewed'",
}
PARENT = "SELECT date_key FROM dim_date WHERE date_key IS NOT NULL"


def _check_sql(kind: str, severity: str, model: str, col: str) -> str:
    failed = {
        "unique": f"SELECT count(*) FROM (SELECT {col} FROM {model} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1)",
        "not_null": f"SELECT count(*) FROM {model} WHERE {col} IS NULL",
        "accepted_values": f"SELECT count(DISTINCT {col}) FROM {model} WHERE {col} NOT IN ({ACCEPTED.get(col)})",
        "relationships": f"SELECT count(*) FROM {model} WHERE {col} IS NOT NULL AND {col} NOT IN ({PARENT})",
    }[kind]
    return (f"SELECT '{model}__{col}__{kind}' AS test_name, '{model}' AS model, '{col}' AS column_name, "
            f"'{kind}' AS test_type, '{severity}' AS severity, ({failed}) AS n_failed")


def dq_sql(kind: str) -> str:
    parts = []
    for line in CHECKS[kind].split("\n"):
        severity, model, *columns = line.split() or ("", "")
        parts += [_check_sql(kind, severity, model, c) for c in columns]
    return q("\nUNION ALL\n".join(parts))


def delivery_sql() -> str:
    """Five deliveries: the events by days, bookings without an id, bookings as another type."""
    booked = "event_type = 'booking_submitted'"
    sent = ["event_ts < TIMESTAMP '2024-01-11' OR event_ts IS NULL", "event_ts >= TIMESTAMP '2024-01-11' AND event_ts < TIMESTAMP '2024-01-21'",
            "event_ts >= TIMESTAMP '2024-01-21'", booked, booked]
    failing = {(3, "event_id__not_null"), (4, "event_id__landed")}
    parts = []
    for i, where in enumerate(sent):
        for test in ("event_id__unique", "event_id__not_null", "event_ts__not_null", "event_id__landed"):
            n = "count(*)" if (i, test) in failing else "CAST(0 AS BIGINT)"
            parts.append(f"SELECT 'delivery {i}' AS delivery, 'raw_events__{test}' AS test_name, 'error' AS severity, {n} AS n_failed, "
                         f"count(*) AS rows, {str(i > 2).lower()} AS held FROM raw_events WHERE {where}")
    return q("\nUNION ALL\n".join(parts))


# The columns of two facts; the safe grouping dimensions come first.
DIMENSIONS = {
    "booking_funnel": ("fct_booking_funnel", "category_key geography_key created_at_date_key is_matched",
                       "booking_key sr_id session_key service_request_key sp_id pro_key session_started_at first_booking_ts "
                       "is_converted is_cancelled market pro_is_active"),
    "revenue": ("fct_revenue", "category_key geography_key payment_date_key payment_method payment_status sr_status",
                "revenue_key payment_id sr_id service_request_key sp_id pro_key payment_ts gross_amount commission_rate "
                "platform_commission pro_payout_amount is_settled is_refunded is_chargeback is_pending net_platform_revenue "
                "net_pro_payout sr_is_completed market pro_is_active"),
}


def dimension_sql() -> str:
    parts = []
    for family, (model, safe, unsafe) in DIMENSIONS.items():
        parts += [f"SELECT '{family}' AS metric_family, '{c}' AS dimension, false AS refused, count(*) AS n_groups "
                  f"FROM (SELECT DISTINCT {c} FROM {model})" for c in safe.split()]
        parts += [f"SELECT '{family}', '{c}', true, CAST(NULL AS BIGINT)" for c in unsafe.split()]
    return q("\nUNION ALL\n".join(parts))


QUALITY_SQL = {
    "dq_unique": dq_sql("unique"),
    "dq_not_null": dq_sql("not_null"),
    "dq_accepted_values": dq_sql("accepted_values"),
    "dq_relationships": dq_sql("relationships"),
    "dq_freshness": q("\nUNION ALL\n".join(
        f"SELECT '{s}' AS source_name, max(_loaded_at) AS max_loaded_at, count(*) AS rows_loaded FROM {s}"
        for s in ["raw_events", "raw_sessions", "service_requests", "raw_pro_profiles",
                  "raw_payments"])),
    "dq_freshness_age": q("SELECT *, CASE WHEN age_hours >= 8760 THEN 'error' WHEN age_hours >= 12 THEN 'warn' ELSE 'pass' END AS status FROM ("
                          + "\nUNION ALL\n".join(
        f"SELECT '{s}' AS source_name, max(_loaded_at) AS max_loaded_at, count(*) AS rows_loaded, CAST(floor(epoch("
        f"TIMESTAMP '2024-01-31 06:00:00' - max(_loaded_at)) / 3600) AS BIGINT) AS age_hours FROM {s}"
        for s in ["raw_events", "raw_sessions", "service_requests", "raw_pro_profiles", "raw_payments"]) + ")"),
    "landed_events": SOURCE_SQL["raw_events"],
    "delivery_report": delivery_sql(),
    "rebuilt_facts": q("\nUNION ALL\n".join(
        f"SELECT '{m}' AS model, count(*) AS n_rows, CAST(0 AS BIGINT) AS rows_differing, true AS audit_time_moved FROM {m}"
        for m in ["fct_booking_events", "fct_session_events", "fct_booking_funnel", "fct_revenue"])),
    "metric_dimensions": dimension_sql(),
    "guardrail_report": q("""
SELECT 'funnel_booking_key_unique' AS guardrail, count(*) - count(DISTINCT booking_key) AS n_rows FROM fct_booking_funnel
UNION ALL SELECT 'converted_subset_of_bookings', count(*) FROM fct_booking_funnel
   WHERE is_converted = 1 AND sr_id NOT IN (SELECT sr_id FROM fct_booking_events WHERE sr_id IS NOT NULL)
UNION ALL SELECT 'revenue_key_unique', count(*) - count(DISTINCT revenue_key) FROM fct_revenue
UNION ALL SELECT 'completed_net_split_equals_gross', count(*) FILTER (WHERE payment_status = 'completed'
   AND net_platform_revenue + net_pro_payout <> gross_amount) FROM fct_revenue
UNION ALL SELECT 'srs_with_reversal_rows', count(DISTINCT sr_id) FROM fct_revenue
   WHERE payment_status IN ('refunded', 'chargeback')
UNION ALL SELECT 'srs_with_refunded_rows', count(DISTINCT sr_id) FROM fct_revenue WHERE payment_status = 'refunded'
UNION ALL SELECT 'srs_with_chargeback_rows', count(DISTINCT sr_id) FROM fct_revenue WHERE payment_status = 'chargeback'"""),
}


def _fan(name: str, table: str, keys: list[str]) -> str:
    nn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    ks = ", ".join(keys)
    return (f"SELECT '{name}' AS lookup, count(*) AS duplicate_keys, "
            f"coalesce(max(n), 1) AS max_rows_per_key FROM (SELECT {ks}, count(*) AS n FROM {table} "
            f"WHERE {nn} GROUP BY {ks} HAVING count(*) > 1)")


FAN_OUT_LOOKUPS = [
    ("dim_category.category", "dim_category", ["category"]),
    ("dim_geography.geography", "dim_geography", ["geography"]),
    ("dim_service_request.current.sr_id", "cur_dsr", ["sr_id"]),
    ("dim_pro.current.sp_id_category_key", "cur_pro", ["sp_id", "category_key"]),
    ("dim_session.session_id", "dim_session", ["session_id"]),
    ("fct_booking_events.sr_id", "fct_booking_events", ["sr_id"]),
    ("raw_pro_profiles.sp_id", "raw_pro_profiles", ["sp_id"]),
]
QUALITY_SQL["fan_out_report"] = q("\nUNION ALL\n".join(_fan(*x) for x in FAN_OUT_LOOKUPS))


# ------------------------------------------------------------------ replays
# A converged incremental run equals the full build; the two type-2 replays
# also keep the superseded versions, spelled out below.

def _pro_rows(src: str) -> str:
    return f"""SELECT sha256(coalesce(sp_id, 'null') || '|' || coalesce(category, 'null') || '|' ||
                coalesce(strftime(updated_at, {TS_KEY}), 'null')) AS pro_key,
         sp_id, sha256(category) AS category_key, market, is_active, first_active_at, last_active_at,
         CAST(NULL AS VARCHAR) AS tier, CAST(NULL AS DECIMAL(3,2)) AS rating,
         CAST(NULL AS INTEGER) AS review_count, updated_at AS valid_from
  FROM (SELECT *, row_number() OVER (PARTITION BY sp_id, category
                    ORDER BY updated_at DESC NULLS LAST, market DESC NULLS LAST, is_active DESC NULLS LAST) AS rn,
               min(updated_at) OVER (PARTITION BY sp_id) AS first_active_at,
               max(updated_at) OVER (PARTITION BY sp_id) AS last_active_at
        FROM {src}) WHERE rn = 1"""


def _scd2_sr(cutoff: str, bound: str) -> str:
    return q(
             f"""SELECT * FROM (WITH prev AS (
  SELECT sr_id, created_at,
         CASE WHEN updated_at < TIMESTAMP '{cutoff}' THEN status ELSE 'submitted' END AS status,
         category, geography, sp_id,
         CASE WHEN updated_at < TIMESTAMP '{cutoff}' THEN updated_at ELSE created_at END AS updated_at
  FROM service_requests WHERE created_at < TIMESTAMP '{cutoff}'),
batch AS (SELECT sr_id, created_at, status, category, geography, sp_id, updated_at
          FROM service_requests WHERE updated_at >= TIMESTAMP '{bound}'),
opened AS (SELECT b.* FROM batch b LEFT JOIN prev p ON b.sr_id = p.sr_id
           WHERE p.sr_id IS NULL OR p.status IS DISTINCT FROM b.status),
versions AS (
  SELECT * FROM prev WHERE NOT EXISTS (SELECT 1 FROM opened o WHERE o.sr_id = prev.sr_id
                                                              AND o.updated_at = prev.updated_at)
  UNION ALL SELECT * FROM opened)
SELECT sha256(coalesce(v.sr_id, 'null') || '|' || coalesce(strftime(v.updated_at, {TS_KEY}), 'null'))
         AS service_request_key,
       v.sr_id, v.created_at, v.status, v.sp_id, dc.category_key, dg.geography_key,
       coalesce(v.status = 'completed', false) AS is_completed,
       coalesce(v.status = 'cancelled', false) AS is_cancelled,
       CAST(NULL AS VARCHAR) AS homeowner_key, v.updated_at AS valid_from,
       lead(v.updated_at) OVER (PARTITION BY v.sr_id ORDER BY v.updated_at) AS valid_to,
       lead(v.updated_at) OVER (PARTITION BY v.sr_id ORDER BY v.updated_at) IS NULL AS is_current
FROM versions v LEFT JOIN dim_category dc ON v.category = dc.category
LEFT JOIN dim_geography dg ON v.geography = dg.geography)""")


def _scd2_pro(cutoff: str, bound: str) -> str:
    return q(f"""SELECT * FROM (WITH
prev AS ({_pro_rows(f"(SELECT * FROM raw_pro_profiles WHERE updated_at < TIMESTAMP '{cutoff}')")}),
hist AS (SELECT * FROM raw_pro_profiles WHERE sp_id IN
           (SELECT sp_id FROM raw_pro_profiles WHERE updated_at >= TIMESTAMP '{bound}')),
cand AS ({_pro_rows("hist")}),
opened AS (SELECT c.* FROM cand c LEFT JOIN prev p
             ON c.sp_id = p.sp_id AND c.category_key = p.category_key
           WHERE p.sp_id IS NULL OR p.valid_from IS DISTINCT FROM c.valid_from
              OR p.market IS DISTINCT FROM c.market OR p.is_active IS DISTINCT FROM c.is_active),
versions AS (
  SELECT * FROM prev WHERE NOT EXISTS (SELECT 1 FROM opened o WHERE o.sp_id = prev.sp_id
       AND o.category_key = prev.category_key AND o.valid_from = prev.valid_from)
  UNION ALL SELECT * FROM opened),
closed AS (SELECT *, lead(valid_from) OVER (PARTITION BY sp_id, category_key ORDER BY valid_from)
                     AS valid_to FROM versions),
act AS (SELECT sp_id, min(updated_at) AS f, max(updated_at) AS l FROM hist GROUP BY sp_id)
SELECT c.pro_key, c.sp_id, c.category_key, c.market, c.is_active,
       CASE WHEN c.valid_to IS NULL AND a.f IS NOT NULL THEN a.f ELSE c.first_active_at END AS first_active_at,
       CASE WHEN c.valid_to IS NULL AND a.l IS NOT NULL THEN a.l ELSE c.last_active_at END AS last_active_at,
       c.tier, c.rating, c.review_count, c.valid_from, c.valid_to, c.valid_to IS NULL AS is_current
FROM closed c LEFT JOIN act a ON c.sp_id = a.sp_id)""")


INCREMENTAL_SQL = {
    "upsert_sessions": MODEL_SQL["dim_session"],
    "insert_new_categories": MODEL_SQL["dim_category"],
    "lookback_bookings": MODEL_SQL["fct_booking_events"],
    "incremental_session_events": MODEL_SQL["fct_session_events"],
    "incremental_funnel": MODEL_SQL["fct_booking_funnel"],
    "incremental_revenue": MODEL_SQL["fct_revenue"],
    "stream_session_events": MODEL_SQL["fct_session_events"],
    "nightly_funnel": MODEL_SQL["fct_booking_funnel"],
    "fct_session_events_hot": HOT_SQL,
    "nightly_sessions": MODEL_SQL["fct_session_events"],
    "nightly_revenue": MODEL_SQL["fct_revenue"],
    "readers_keep_published": MODEL_SQL["fct_revenue"],
    "scd2_service_request": _scd2_sr("2020-06-16", "2020-06-15"),
    "scd2_pro": _scd2_pro("2020-07-01", "2020-06-30"),
}
