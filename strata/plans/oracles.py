"""Independent DuckDB SQL for every registered query.

Each statement rebuilds the replay view from the raw ``events`` table in
plain SQL (no shared code with the Spark side) and computes the query the way
the reference's SQL / notebook code states it, e.g. the gold KPIs with their
literal ``COUNT(DISTINCT ...)`` forms.  Column names equal the Spark output.
"""

from __future__ import annotations

# The replay view (see strata.sources.fixture) in SQL.
SILVER_CTE = r"""
_b AS (
  SELECT event_id AS _eid, ts, user_id AS _uid, event_type AS _raw,
         CAST(regexp_extract(props, '[0-9]+', 0) AS INTEGER) AS _k
  FROM events
), _m AS (
  SELECT *,
    CASE _raw WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'feature_used'
              WHEN 'purchase' THEN 'upgrade' WHEN 'signup' THEN 'signup'
              WHEN 'error' THEN CASE WHEN _k < 70 THEN 'login' ELSE 'churn' END END AS _et
  FROM _b
), silver AS (
  SELECT
    'evt_' || CAST(_eid AS VARCHAR) AS event_id,
    _et AS event_type,
    CAST(ts AS TIMESTAMP) AS event_timestamp,
    'sess_' || CAST(_uid AS VARCHAR) || '_' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
    CASE WHEN _et <> 'page_view' THEN 'u_' || CAST(_uid AS VARCHAR) END AS user_id,
    'anon_' || CAST(_uid AS VARCHAR) AS anonymous_id,
    CASE WHEN _et = 'page_view' THEN (['/home','/pricing','/features','/docs','/blog'])[_k % 5 + 1] END AS page,
    CASE WHEN _et = 'page_view' THEN (['google.com','github.com','twitter.com','direct'])[_k % 4 + 1] END AS referrer,
    CASE WHEN _et = 'page_view' THEN (['google','newsletter','social','organic'])[_k % 4 + 1] END AS utm_source,
    CASE WHEN _et = 'page_view' THEN (['cpc','email','referral'])[_k % 3 + 1] END AS utm_medium,
    CASE WHEN _et = 'page_view' THEN 'spring_launch' END AS utm_campaign,
    CASE WHEN _et = 'feature_used' THEN (['dashboard','reports','export','api','settings','integrations'])[_k % 6 + 1] END AS feature_name,
    CASE WHEN _et IN ('page_view', 'login') THEN (['mobile','desktop','tablet'])[_k % 3 + 1]
         WHEN _et = 'signup' THEN (['mobile','desktop'])[_k % 2 + 1] END AS device,
    CASE WHEN _et IN ('page_view', 'login', 'signup') THEN (['IN','US','GB','DE','SG'])[_uid % 5 + 1] END AS country,
    CASE WHEN _et = 'page_view' THEN (['Chennai','Austin','London','Berlin','Singapore City'])[_uid % 5 + 1] END AS city,
    CASE WHEN _et = 'signup' THEN 'free_trial'
         WHEN _et = 'feature_used' THEN (['free_trial','pro','enterprise'])[_k % 3 + 1]
         WHEN _et = 'churn' THEN (['pro','enterprise'])[_k % 2 + 1] END AS plan,
    CASE WHEN _et = 'upgrade' THEN (CASE WHEN _k % 2 = 0 THEN 49.0 ELSE 199.0 END)::DOUBLE END AS mrr_usd,
    CASE WHEN _et = 'churn' THEN 49.0::DOUBLE END AS mrr_lost_usd,
    CASE WHEN _et = 'upgrade' THEN 'free_trial' END AS from_plan,
    CASE WHEN _et = 'upgrade' THEN (['pro','enterprise'])[_k % 2 + 1] END AS to_plan,
    CASE WHEN _et = 'feature_used' THEN CAST(10 + (_eid * 37) % 3591 AS INTEGER) END AS duration_seconds,
    CASE WHEN _et = 'churn' THEN (['too_expensive','missing_features','switching_product','no_longer_needed'])[_k % 4 + 1] END AS reason,
    CAST(ts AS TIMESTAMP) AS processed_at,
    CAST(ts AS DATE) AS processing_date,
    _eid, _uid, _k
  FROM _m
), ev AS (
  SELECT *, CAST(event_timestamp AS DATE) AS date FROM silver
)"""

SILVER_COLS = """event_id, event_type, event_timestamp, session_id, user_id, anonymous_id,
  page, referrer, feature_name, device, country, city, plan, mrr_usd, mrr_lost_usd,
  from_plan, to_plan, duration_seconds, reason, processed_at, processing_date"""


def with_silver(body: str, extra_ctes: str = "") -> str:
    """``WITH <replay view>[, extra] <body>``."""
    ctes = SILVER_CTE + ((",\n" + extra_ctes) if extra_ctes.strip() else "")
    return f"WITH {ctes}\n{body}"


# ------------------------------------------------------------------ gold (reference formulas)
DAU_SQL = """
SELECT date,
  COUNT(DISTINCT user_id) AS dau_count,
  COUNT(DISTINCT CASE WHEN event_type = 'signup' THEN user_id END) AS new_users,
  COUNT(DISTINCT user_id) - COUNT(DISTINCT CASE WHEN event_type = 'signup' THEN user_id END) AS returning_users,
  COUNT(DISTINCT CASE WHEN event_type IS NOT NULL THEN
      concat_ws('_', CAST(weekofyear(date) AS VARCHAR), CAST(year(date) AS VARCHAR), user_id) END) AS wau_count,
  COUNT(DISTINCT CASE WHEN event_type IS NOT NULL THEN
      concat_ws('_', CAST(month(date) AS VARCHAR), CAST(year(date) AS VARCHAR), user_id) END) AS mau_count
FROM ev WHERE user_id IS NOT NULL AND date IS NOT NULL
GROUP BY date"""

FUNNEL_SQL = """
SELECT date, total_page_views, unique_visitors, signups, logins, feature_activations, upgrades, churns,
  CASE WHEN unique_visitors > 0 THEN round(signups / unique_visitors, 4) ELSE 0.0 END AS visitor_to_signup_rate,
  CASE WHEN signups > 0 THEN round(feature_activations / signups, 4) ELSE 0.0 END AS signup_to_activation_rate,
  CASE WHEN feature_activations > 0 THEN round(upgrades / feature_activations, 4) ELSE 0.0 END AS activation_to_upgrade_rate,
  CASE WHEN upgrades > 0 THEN round(churns / upgrades, 4) ELSE 0.0 END AS upgrade_to_churn_rate
FROM (
  SELECT date,
    COUNT(CASE WHEN event_type = 'page_view' THEN 1 END) AS total_page_views,
    COUNT(DISTINCT CASE WHEN event_type = 'page_view' THEN anonymous_id END) AS unique_visitors,
    COUNT(CASE WHEN event_type = 'signup' THEN 1 END) AS signups,
    COUNT(CASE WHEN event_type = 'login' THEN 1 END) AS logins,
    COUNT(CASE WHEN event_type = 'feature_used' THEN 1 END) AS feature_activations,
    COUNT(CASE WHEN event_type = 'upgrade' THEN 1 END) AS upgrades,
    COUNT(CASE WHEN event_type = 'churn' THEN 1 END) AS churns
  FROM ev WHERE date IS NOT NULL GROUP BY date) f"""

FEATURE_SQL = """
SELECT b.date, b.feature_name, b.unique_users, b.total_uses, b.avg_duration_seconds,
  COALESCE(p.plan_breakdown, '{}') AS plan_breakdown
FROM (
  SELECT date, feature_name, COUNT(DISTINCT user_id) AS unique_users, COUNT(*) AS total_uses,
    round(avg(duration_seconds), 2) AS avg_duration_seconds
  FROM ev WHERE event_type = 'feature_used' AND feature_name IS NOT NULL AND date IS NOT NULL
  GROUP BY date, feature_name) b
LEFT JOIN (
  SELECT date, feature_name,
    CAST(to_json(map_from_entries(list((plan, cnt) ORDER BY plan))) AS VARCHAR) AS plan_breakdown
  FROM (SELECT date, feature_name, plan, COUNT(*) AS cnt
        FROM ev WHERE event_type = 'feature_used' AND feature_name IS NOT NULL
          AND date IS NOT NULL AND plan IS NOT NULL
        GROUP BY date, feature_name, plan) c
  GROUP BY date, feature_name) p
ON b.date = p.date AND b.feature_name = p.feature_name"""

MRR_SQL = """
SELECT date, new_mrr, churned_mrr,
  round(new_mrr * 0.1, 2) AS expansion_mrr,
  round(new_mrr - churned_mrr + round(new_mrr * 0.1, 2), 2) AS net_mrr,
  round(new_mrr + round(new_mrr * 0.1, 2), 2) AS total_mrr,
  pro_users, enterprise_users
FROM (
  SELECT date,
    COALESCE(SUM(CASE WHEN event_type = 'upgrade' THEN mrr_usd END), 0) AS new_mrr,
    abs(COALESCE(SUM(CASE WHEN event_type = 'churn' THEN mrr_lost_usd END), 0)) AS churned_mrr,
    COUNT(DISTINCT CASE WHEN event_type = 'upgrade' AND to_plan = 'pro' THEN user_id END) AS pro_users,
    COUNT(DISTINCT CASE WHEN event_type = 'upgrade' AND to_plan = 'enterprise' THEN user_id END) AS enterprise_users
  FROM ev WHERE date IS NOT NULL GROUP BY date) m"""

# Sessions at the code grain (session_id, user_id, anonymous_id, device, country).
SESSIONS_ATTR_CTE = """
sess_attr AS (
  SELECT session_id, user_id, anonymous_id, device, country,
    MIN(event_timestamp) AS session_start, MAX(event_timestamp) AS session_end,
    COUNT(event_id) AS page_count,
    arg_min(page, (event_timestamp, event_id)) FILTER (WHERE page IS NOT NULL) AS entry_page,
    arg_max(page, (event_timestamp, event_id)) FILTER (WHERE page IS NOT NULL) AS exit_page
  FROM silver GROUP BY session_id, user_id, anonymous_id, device, country
), sess_attr_full AS (
  SELECT *, CAST(floor(epoch(session_end)) AS BIGINT) - CAST(floor(epoch(session_start)) AS BIGINT) AS session_duration_secs,
    page_count = 1 AS is_bounce, CAST(session_start AS DATE) AS session_date
  FROM sess_attr
)"""

SESSION_QUALITY_SQL = """
, sd AS (
  SELECT session_id, MIN(date) AS date FROM ev WHERE session_id IS NOT NULL GROUP BY session_id
), swd AS (
  SELECT s.*, sd.date FROM sess_attr_full s JOIN sd ON s.session_id = sd.session_id
  WHERE sd.date IS NOT NULL
), countries AS (
  SELECT date, CAST(to_json(map_from_entries(list((country, cnt) ORDER BY country))) AS VARCHAR) AS top_countries
  FROM (SELECT date, country, COUNT(*) AS cnt FROM swd WHERE country IS NOT NULL GROUP BY date, country) c
  GROUP BY date
), q AS (
  SELECT date,
    round(avg(session_duration_secs), 2) AS avg_session_duration_secs,
    round(avg(page_count), 2) AS avg_pages_per_session,
    round(SUM(CAST(is_bounce AS INTEGER)) / COUNT(*), 4) AS bounce_rate,
    round(SUM(CASE WHEN device = 'mobile' THEN 1 ELSE 0 END) / COUNT(*) * 100, 2) AS mobile_pct,
    round(SUM(CASE WHEN device = 'desktop' THEN 1 ELSE 0 END) / COUNT(*) * 100, 2) AS desktop_pct,
    round(SUM(CASE WHEN device = 'tablet' THEN 1 ELSE 0 END) / COUNT(*) * 100, 2) AS tablet_pct
  FROM swd GROUP BY date
)"""

SESSION_QUALITY_SELECT = """
SELECT q.*, COALESCE(c.top_countries, '{}') AS top_countries
FROM q LEFT JOIN countries c ON q.date = c.date"""

ORACLES: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    ORACLES[name] = sql


register("daily_active_users", with_silver(DAU_SQL))
register("funnel_metrics", with_silver(FUNNEL_SQL))
register("feature_adoption", with_silver(FEATURE_SQL))
register("mrr_metrics", with_silver(MRR_SQL))
register("session_quality",
         with_silver(SESSION_QUALITY_SELECT, SESSIONS_ATTR_CTE + SESSION_QUALITY_SQL))


# ------------------------------------------------------------------ bronze / contract
def _payload(eid: str = "event_id", etype: str = "event_type",
             ts: str = "strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%fZ')") -> str:
    """JSON text of the nested contract record (all 26 properties, nulls kept)."""
    return f"""CAST(to_json({{'event_id': {eid}, 'event_type': {etype}, 'timestamp': {ts},
  'session_id': session_id, 'user_id': user_id, 'anonymous_id': anonymous_id,
  'properties': {{'page': page, 'referrer': referrer, 'utm_source': utm_source,
    'utm_medium': utm_medium, 'utm_campaign': utm_campaign, 'device': device,
    'browser': NULL::VARCHAR, 'os': NULL::VARCHAR, 'country': country, 'city': city,
    'plan': plan, 'signup_method': NULL::VARCHAR, 'referral_source': NULL::VARCHAR,
    'login_method': NULL::VARCHAR, 'session_number': NULL::INTEGER,
    'feature_name': feature_name, 'duration_seconds': duration_seconds,
    'actions_taken': NULL::INTEGER, 'from_plan': from_plan, 'to_plan': to_plan,
    'mrr_usd': mrr_usd, 'payment_method': NULL::VARCHAR, 'billing_cycle': NULL::VARCHAR,
    'reason': reason, 'days_active': NULL::INTEGER, 'mrr_lost_usd': mrr_lost_usd}}}}) AS VARCHAR)"""


register("bronze_events", with_silver(f"""
SELECT '0000000001' || hex({_payload()}) AS value_hex,
  event_timestamp AS ingested_at, _eid AS kafka_offset,
  CAST(_eid % 3 AS INTEGER) AS kafka_partition, 'saas.events.raw' AS kafka_topic,
  CAST(event_timestamp AS DATE) AS processing_date
FROM silver"""))

_CORRUPT_PAYLOAD = _payload(
    eid="CASE WHEN _k = 0 THEN NULL ELSE event_id END",
    etype="CASE WHEN _k = 1 THEN NULL ELSE event_type END",
    ts="CASE WHEN _k = 2 THEN NULL WHEN _k = 4 THEN 'not-a-timestamp' "
       "ELSE strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%fZ') END")

register("dlq_events", with_silver(f"""
SELECT 'saas.events.raw' AS kafka_topic, CAST(_eid % 3 AS INTEGER) AS kafka_partition,
  _eid AS kafka_offset,
  CASE WHEN _k IN (0, 3) THEN NULL ELSE event_id END AS event_id,
  CASE WHEN _k = 3 THEN '<<garbage ' || event_id || '>>'
       WHEN _k = 5 THEN '{{"event_id":"' || event_id || '","event_type":"upgrade","timestamp":"2024-01-01T00:00:00Z","properties":{{"mrr_usd":"oops"}}}}'
       ELSE {_CORRUPT_PAYLOAD} END AS payload,
  CASE _k WHEN 0 THEN 'missing required field: event_id'
          WHEN 1 THEN 'missing required field: event_type'
          WHEN 2 THEN 'missing required field: timestamp'
          WHEN 3 THEN 'undecodable payload'
          WHEN 4 THEN 'unparsable timestamp'
          WHEN 5 THEN 'value of the wrong type' END AS error,
  event_timestamp AS ingested_at
FROM silver WHERE _k BETWEEN 0 AND 5"""))

register("contract_valid_events", with_silver(f"""
SELECT {SILVER_COLS} FROM silver WHERE _k NOT BETWEEN 0 AND 5"""))

# ------------------------------------------------------------------ silver
register("silver_events", with_silver(f"SELECT {SILVER_COLS} FROM silver"))
register("silver_events_dedup", with_silver(f"SELECT {SILVER_COLS}, _eid AS kafka_offset FROM silver"))
register("silver_time_bounds", with_silver("""
SELECT COUNT(*) AS total_records, MIN(event_timestamp) AS min_event_timestamp,
  MAX(event_timestamp) AS max_event_timestamp, MIN(processing_date) AS min_processing_date,
  MAX(processing_date) AS max_processing_date FROM silver"""))

register("sessions_by_attributes", with_silver("SELECT * FROM sess_attr_full", SESSIONS_ATTR_CTE))

SESSIONS_CTE = """
sess AS (
  SELECT session_id, MAX(user_id) AS user_id, MAX(anonymous_id) AS anonymous_id,
    arg_min(device, (event_timestamp, event_id)) FILTER (WHERE device IS NOT NULL) AS device,
    arg_min(country, (event_timestamp, event_id)) FILTER (WHERE country IS NOT NULL) AS country,
    MIN(event_timestamp) AS session_start, MAX(event_timestamp) AS session_end,
    COUNT(event_id) AS page_count,
    COUNT(CASE WHEN event_type = 'page_view' THEN 1 END) AS page_view_count,
    arg_min(page, (event_timestamp, event_id)) FILTER (WHERE page IS NOT NULL) AS entry_page,
    arg_max(page, (event_timestamp, event_id)) FILTER (WHERE page IS NOT NULL) AS exit_page
  FROM silver WHERE session_id IS NOT NULL GROUP BY session_id
), sess_full AS (
  SELECT *, CAST(floor(epoch(session_end)) AS BIGINT) - CAST(floor(epoch(session_start)) AS BIGINT) AS session_duration_secs,
    page_count = 1 AS is_bounce, CAST(session_start AS DATE) AS session_date
  FROM sess
)"""
register("sessions", with_silver("SELECT * FROM sess_full", SESSIONS_CTE))

register("users_plan_events", with_silver("""
SELECT user_id, plan, country, device, event_timestamp AS valid_from, TRUE AS is_current,
  CAST(NULL AS TIMESTAMP) AS valid_to
FROM silver WHERE event_type IN ('signup', 'upgrade', 'churn')"""))

register("user_signups", with_silver("""
SELECT user_id, anonymous_id, plan, country, device, event_timestamp AS signed_up_at
FROM silver WHERE event_type = 'signup'"""))

SCD2_CTE = """
scd AS (
  SELECT user_id, COALESCE(to_plan, plan) AS plan,
    last_value(country IGNORE NULLS) OVER w AS country,
    last_value(device IGNORE NULLS) OVER w AS device,
    event_timestamp AS valid_from,
    lead(event_timestamp) OVER (PARTITION BY user_id ORDER BY event_timestamp, event_id) AS valid_to,
    event_type AS change_type, event_id
  FROM silver
  WHERE event_type IN ('signup', 'upgrade', 'churn') AND user_id IS NOT NULL
  WINDOW w AS (PARTITION BY user_id ORDER BY event_timestamp, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), scd_full AS (
  SELECT user_id, plan, country, device, valid_from, valid_to, valid_to IS NULL AS is_current,
    change_type, event_id FROM scd
)"""
register("users_scd2", with_silver("SELECT * FROM scd_full", SCD2_CTE))
register("users_current", with_silver("SELECT * FROM scd_full WHERE is_current", SCD2_CTE))

register("events_with_plan_asof", with_silver("""
SELECT e.event_id, e.user_id, e.event_timestamp, e.event_type, u.plan AS plan_asof
FROM silver e LEFT JOIN scd_full u
  ON e.user_id = u.user_id AND e.event_timestamp >= u.valid_from
 AND (u.valid_to IS NULL OR e.event_timestamp < u.valid_to)""", SCD2_CTE))

register("feature_plan_breakdown", with_silver("""
SELECT date, feature_name, plan, COUNT(*) AS cnt FROM ev
WHERE event_type = 'feature_used' AND feature_name IS NOT NULL AND plan IS NOT NULL AND date IS NOT NULL
GROUP BY date, feature_name, plan"""))

register("session_country_breakdown", with_silver(
    "SELECT date, top_countries FROM countries", SESSIONS_ATTR_CTE + SESSION_QUALITY_SQL))


# ------------------------------------------------------------------ KPI trends
register("rolling_wau_mau", with_silver("""
SELECT c.date,
  COUNT(DISTINCT CASE WHEN a.date = c.date THEN a.user_id END) AS dau_count,
  COUNT(DISTINCT CASE WHEN a.date > c.date - 7 THEN a.user_id END) AS active_7d,
  COUNT(DISTINCT a.user_id) AS active_30d
FROM cal c LEFT JOIN act a ON a.date <= c.date AND a.date > c.date - 30
GROUP BY c.date""", """
act AS (SELECT DISTINCT user_id, date FROM ev WHERE user_id IS NOT NULL),
cal AS (SELECT CAST(unnest(generate_series(MIN(date), MAX(date), INTERVAL 1 DAY)) AS DATE) AS date FROM act)"""))

register("dau_growth", with_silver("""
SELECT date, dau_count, prev_dau_count,
  round(CAST(dau_count - prev_dau_count AS DOUBLE) * 100.0 / NULLIF(prev_dau_count, 0), 2) AS dau_growth_pct
FROM (SELECT date, dau_count, lag(dau_count) OVER (ORDER BY date) AS prev_dau_count FROM dau) x""",
    f"dau AS ({DAU_SQL})"))

register("mrr_cumulative", with_silver("""
SELECT date, net_mrr,
  round(SUM(net_mrr) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS cumulative_net_mrr
FROM mrr""", f"mrr AS ({MRR_SQL})"))

register("top_countries_by_date", with_silver("""
SELECT date, country, sessions, rank FROM (
  SELECT date, country, COUNT(*) AS sessions,
    row_number() OVER (PARTITION BY date ORDER BY COUNT(*) DESC, country) AS rank
  FROM swd WHERE country IS NOT NULL GROUP BY date, country) r
WHERE rank <= 3""", SESSIONS_ATTR_CTE + SESSION_QUALITY_SQL))

register("mrr_trend_30d", with_silver("""
SELECT date, total_mrr, net_mrr, new_mrr, churned_mrr FROM mrr ORDER BY date DESC LIMIT 30""",
    f"mrr AS ({MRR_SQL})"))

register("dau_mau_trend", with_silver("""
SELECT date, dau_count, wau_count, mau_count,
  round(CAST(dau_count AS DOUBLE) * 100.0 / NULLIF(mau_count, 0), 2) AS dau_mau_ratio
FROM dau ORDER BY date DESC LIMIT 30""", f"dau AS ({DAU_SQL})"))

# Average of the 2-dp daily averages taken over DECIMAL: the exact value can
# be a .xx5 tie (1715.975 at sf0.01), and a parallel double AVG lands on
# either side of it depending on summation order (observed both ways).
register("top_features", with_silver("""
SELECT feature_name, CAST(SUM(total_uses) AS BIGINT) AS total_uses,
  CAST(SUM(unique_users) AS BIGINT) AS unique_users,
  CAST(round(SUM(CAST(avg_duration_seconds AS DECIMAL(20, 2))) / COUNT(avg_duration_seconds), 2) AS DOUBLE)
    AS avg_duration_secs
FROM fa GROUP BY feature_name ORDER BY total_uses DESC""", f"fa AS ({FEATURE_SQL})"))

GOLD_CTES = (f"dau AS ({DAU_SQL}),\nmrr AS ({MRR_SQL}),\nfunnel AS ({FUNNEL_SQL}),\n"
             f"fa AS ({FEATURE_SQL}),\n" + SESSIONS_ATTR_CTE + SESSION_QUALITY_SQL
             + f",\nsq AS ({SESSION_QUALITY_SELECT})")
GOLD_VIEWS = {"daily_active_users": "dau", "funnel_metrics": "funnel", "feature_adoption": "fa",
              "mrr_metrics": "mrr", "session_quality": "sq"}
GOLD_COLS = {
    "daily_active_users": ["dau_count", "new_users", "returning_users", "wau_count", "mau_count"],
    "funnel_metrics": ["total_page_views", "unique_visitors", "signups", "logins",
                       "feature_activations", "upgrades", "churns", "visitor_to_signup_rate",
                       "signup_to_activation_rate", "activation_to_upgrade_rate",
                       "upgrade_to_churn_rate"],
    "feature_adoption": ["feature_name", "unique_users", "total_uses", "avg_duration_seconds",
                         "plan_breakdown"],
    "mrr_metrics": ["new_mrr", "churned_mrr", "expansion_mrr", "net_mrr", "total_mrr",
                    "pro_users", "enterprise_users"],
    "session_quality": ["avg_session_duration_secs", "avg_pages_per_session", "bounce_rate",
                        "mobile_pct", "desktop_pct", "tablet_pct", "top_countries"],
}


def _preview(name: str) -> str:
    v = GOLD_VIEWS[name]
    tie = ", feature_name" if name == "feature_adoption" else ""
    fields = ", ".join(f"'{c}': {c}" for c in GOLD_COLS[name])
    return (f"(SELECT '{name}' AS table_name, date, CAST(to_json({{{fields}}}) AS VARCHAR) AS row_json "
            f"FROM {v} ORDER BY date DESC{tie} LIMIT 5)")


register("gold_preview", with_silver("\nUNION ALL\n".join(_preview(n) for n in GOLD_VIEWS), GOLD_CTES))

register("check_row_counts", with_silver("\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {v}" for n, v in GOLD_VIEWS.items()),
    GOLD_CTES))

register("check_duplicates", with_silver("\nUNION ALL\n".join(
    f"""SELECT '{n}' AS table_name, COUNT(*) AS total_rows, COUNT(DISTINCT {k}) AS unique_keys,
  CASE WHEN COUNT(*) = COUNT(DISTINCT {k}) THEN '✅ No Duplicates' ELSE '❌ Duplicates Found' END AS status
FROM {v}""" for n, v, k in [(n, v, "date || feature_name" if n == "feature_adoption" else "date")
                           for n, v in GOLD_VIEWS.items()]), GOLD_CTES))

register("check_latest_date", with_silver("\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, MAX(date) AS latest_date FROM {v}" for n, v in GOLD_VIEWS.items()),
    GOLD_CTES))

# ------------------------------------------------------------------ warehouse load
WAREHOUSE_TYPES = {  # warehouse column types of the five gold tables
    "daily_active_users": [("date", "DATE")] + [(c, "INTEGER") for c in GOLD_COLS["daily_active_users"]],
    "mrr_metrics": [("date", "DATE"), ("new_mrr", "DOUBLE"), ("churned_mrr", "DOUBLE"),
                    ("expansion_mrr", "DOUBLE"), ("net_mrr", "DOUBLE"), ("total_mrr", "DOUBLE"),
                    ("pro_users", "INTEGER"), ("enterprise_users", "INTEGER"), ("plan", "VARCHAR"),
                    ("mrr_usd", "DOUBLE")],
    "funnel_metrics": [("date", "DATE")] + [(c, "INTEGER") for c in GOLD_COLS["funnel_metrics"][:7]]
                      + [(c, "DOUBLE") for c in GOLD_COLS["funnel_metrics"][7:]],
    "feature_adoption": [("date", "DATE"), ("feature_name", "VARCHAR"), ("unique_users", "INTEGER"),
                         ("total_uses", "INTEGER"), ("avg_duration_seconds", "DOUBLE"),
                         ("plan_breakdown", "VARCHAR")],
    "session_quality": [("date", "DATE")] + [(c, "DOUBLE") for c in GOLD_COLS["session_quality"][:6]]
                       + [("top_countries", "VARCHAR")],
}
WAREHOUSE_KEYS = {"feature_adoption": ["date", "feature_name"]}
MERGE_CHANGE_SQL = {
    "daily_active_users": ("dau_count", "dau_count + 1000"),
    "mrr_metrics": ("new_mrr", "new_mrr + 1000.0"),
    "funnel_metrics": ("signups", "signups + 1000"),
    "feature_adoption": ("total_uses", "total_uses + 1000"),
    "session_quality": ("bounce_rate", "bounce_rate + 1.0"),
}


def _conformed(name: str) -> str:
    v = GOLD_VIEWS[name]
    have = set(GOLD_COLS[name]) | {"date"}
    cols = ", ".join(f"CAST({c if c in have else 'NULL'} AS {t}) AS {c}" for c, t in WAREHOUSE_TYPES[name])
    return f"SELECT {cols} FROM {v}"


register("conform_gold_dau", with_silver(_conformed("daily_active_users"), GOLD_CTES))


def _merge_sql(name: str) -> str:
    keys = WAREHOUSE_KEYS.get(name, ["date"])
    cols = [c for c, _ in WAREHOUSE_TYPES[name]]
    types = dict(WAREHOUSE_TYPES[name])
    ch_col, ch_expr = MERGE_CHANGE_SQL[name]
    tgt_cols = ", ".join(
        "'legacy' AS plan" if (name == "mrr_metrics" and c == "plan") else
        "1.0::DOUBLE AS mrr_usd" if (name == "mrr_metrics" and c == "mrr_usd") else c
        for c in cols)
    src_cols = ", ".join(
        f"CAST(CASE WHEN day(date) = 15 THEN {ch_expr} ELSE {c} END AS {types[c]}) AS {c}"
        if c == ch_col else c for c in cols)
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    matched = f"s.{keys[0]} IS NOT NULL"
    out = []
    for c in cols:
        if c in keys:
            out.append(f"COALESCE(s.{c}, t.{c}) AS {c}")
        elif name == "mrr_metrics" and c == "plan":   # insert-only column
            out.append(f"CASE WHEN t.date IS NOT NULL THEN t.plan ELSE s.plan END AS plan")
        else:
            out.append(f"CASE WHEN {matched} THEN s.{c} ELSE t.{c} END AS {c}")
    extra = (GOLD_CTES + f",\ng AS ({_conformed(name)}),\n"
             f"tg AS (SELECT {tgt_cols} FROM g WHERE day(date) <= 20),\n"
             f"sr AS (SELECT DISTINCT {src_cols} FROM g WHERE day(date) >= 11)")
    return with_silver(f"SELECT {', '.join(out)} FROM tg t FULL OUTER JOIN sr s ON {on}", extra)


for _n, _q in [("daily_active_users", "merge_upsert_dau"), ("mrr_metrics", "merge_upsert_mrr"),
               ("funnel_metrics", "merge_upsert_funnel"), ("feature_adoption", "merge_upsert_feature"),
               ("session_quality", "merge_upsert_session")]:
    register(_q, _merge_sql(_n))

register("late_data_rerun", with_silver(_conformed("daily_active_users"), GOLD_CTES))

register("plan_breakdown_extract", with_silver("""
SELECT date, feature_name,
  CAST(SUM(CASE WHEN plan = 'free_trial' THEN 1 END) AS BIGINT) AS free_trial_uses,
  CAST(SUM(CASE WHEN plan = 'pro' THEN 1 END) AS BIGINT) AS pro_uses,
  CAST(SUM(CASE WHEN plan = 'enterprise' THEN 1 END) AS BIGINT) AS enterprise_uses
FROM ev WHERE event_type = 'feature_used' AND feature_name IS NOT NULL AND date IS NOT NULL
GROUP BY date, feature_name"""))

# ------------------------------------------------------------------ star schema
DIM_DATE_CTE = """
cal_all AS (SELECT CAST(unnest(generate_series(MIN(date), MAX(date), INTERVAL 1 DAY)) AS DATE) AS d FROM ev),
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date, year(d) AS year,
    quarter(d) AS quarter, month(d) AS month, weekofyear(d) AS iso_week,
    dayofweek(d) + 1 AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend
  FROM cal_all
)"""
register("dim_date", with_silver("SELECT * FROM dim_date", DIM_DATE_CTE))

register("dim_users", with_silver("""
SELECT user_id || ':' || event_id AS user_key, user_id, plan, country, device, valid_from, valid_to,
  is_current, change_type FROM scd_full""", SCD2_CTE))

DIM_FEATURES_CTE = """
dim_features AS (
  SELECT feature_name, MIN(event_timestamp) AS first_seen, MAX(event_timestamp) AS last_seen,
    COUNT(*) AS total_uses
  FROM silver WHERE event_type = 'feature_used' AND feature_name IS NOT NULL GROUP BY feature_name
)"""
register("dim_features", with_silver("SELECT * FROM dim_features", DIM_FEATURES_CTE))

register("dim_campaigns", with_silver("""
SELECT concat_ws('|', COALESCE(utm_source, ''), COALESCE(utm_medium, ''), COALESCE(utm_campaign, '')) AS campaign_key,
  utm_source, utm_medium, utm_campaign, MIN(event_timestamp) AS first_seen, COUNT(*) AS events
FROM silver WHERE COALESCE(utm_source, utm_medium, utm_campaign) IS NOT NULL
GROUP BY utm_source, utm_medium, utm_campaign"""))

FACT_EVENTS_CTE = SCD2_CTE + """,
fact_events AS (
  SELECT e.event_id, CAST(strftime(e.date, '%Y%m%d') AS INTEGER) AS date_key, e.event_timestamp,
    e.event_type, e.user_id, e.anonymous_id, e.session_id, e.feature_name,
    CASE WHEN COALESCE(e.utm_source, e.utm_medium, e.utm_campaign) IS NOT NULL THEN
      concat_ws('|', COALESCE(e.utm_source, ''), COALESCE(e.utm_medium, ''), COALESCE(e.utm_campaign, '')) END AS campaign_key,
    e.duration_seconds, e.mrr_usd, e.mrr_lost_usd,
    u.user_id || ':' || u.event_id AS user_key
  FROM ev e LEFT JOIN scd_full u
    ON e.user_id = u.user_id AND e.event_timestamp >= u.valid_from
   AND (u.valid_to IS NULL OR e.event_timestamp < u.valid_to)
)"""
register("fact_events", with_silver("SELECT * FROM fact_events", FACT_EVENTS_CTE))

register("fact_sessions", with_silver("""
SELECT session_id, CAST(strftime(session_date, '%Y%m%d') AS INTEGER) AS date_key, user_id, anonymous_id,
  device, country, session_start, session_duration_secs, page_count, page_view_count, is_bounce
FROM sess_full""", SESSIONS_CTE))

FACT_MRR_CTE = """
fact_mrr AS (
  SELECT event_id, CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, user_id,
    event_type AS movement_type,
    CASE WHEN event_type = 'upgrade' THEN to_plan ELSE plan END AS plan,
    CASE WHEN event_type = 'upgrade' THEN mrr_usd ELSE -mrr_lost_usd END AS mrr_delta
  FROM ev WHERE event_type IN ('upgrade', 'churn')
)"""
register("fact_mrr", with_silver("SELECT * FROM fact_mrr", FACT_MRR_CTE))

register("star_events_by_feature", with_silver("""
SELECT d.year, d.month, f.feature_name, COUNT(*) AS uses, COUNT(DISTINCT f.user_id) AS users,
  MIN(df.first_seen) AS first_seen
FROM fact_events f JOIN dim_date d ON f.date_key = d.date_key
JOIN dim_features df ON f.feature_name = df.feature_name
WHERE f.feature_name IS NOT NULL
GROUP BY d.year, d.month, f.feature_name""", FACT_EVENTS_CTE + "," + DIM_DATE_CTE + "," + DIM_FEATURES_CTE))

register("star_mrr_by_month", with_silver("""
SELECT d.year, d.month,
  COUNT(CASE WHEN movement_type = 'upgrade' THEN 1 END) AS upgrades,
  COUNT(CASE WHEN movement_type <> 'upgrade' THEN 1 END) AS churns,
  round(SUM(CASE WHEN movement_type = 'upgrade' THEN mrr_delta ELSE 0.0 END), 2) AS gross_new_mrr,
  round(-SUM(CASE WHEN movement_type <> 'upgrade' THEN mrr_delta ELSE 0.0 END), 2) AS churned_mrr,
  round(SUM(mrr_delta), 2) AS net_mrr_movement
FROM fact_mrr m JOIN dim_date d ON m.date_key = d.date_key
GROUP BY d.year, d.month""", FACT_MRR_CTE + "," + DIM_DATE_CTE))

# ------------------------------------------------------------------ dashboards
register("dashboard_new_vs_returning", with_silver("""
SELECT date, dau_count, new_users, returning_users,
  round(CAST(new_users AS DOUBLE) * 100.0 / NULLIF(dau_count, 0), 2) AS new_user_pct
FROM dau""", f"dau AS ({DAU_SQL})"))

register("dashboard_plan_tiers", with_silver("""
SELECT date, plan, CAST(SUM(cnt) AS BIGINT) AS uses, COUNT(DISTINCT feature_name) AS features_used
FROM (SELECT date, feature_name, plan, COUNT(*) AS cnt FROM ev
      WHERE event_type = 'feature_used' AND feature_name IS NOT NULL AND plan IS NOT NULL AND date IS NOT NULL
      GROUP BY date, feature_name, plan) b
GROUP BY date, plan"""))

register("dashboard_device_split", with_silver("""
SELECT date, 'mobile' AS device, mobile_pct AS session_pct FROM q
UNION ALL SELECT date, 'desktop', desktop_pct FROM q
UNION ALL SELECT date, 'tablet', tablet_pct FROM q""", SESSIONS_ATTR_CTE + SESSION_QUALITY_SQL))

register("session_quality_per_session", with_silver(
    SESSION_QUALITY_SELECT, SESSIONS_CTE + SESSION_QUALITY_SQL.replace("sess_attr_full", "sess_full")))


# ------------------------------------------------------------------ sinks / stage / streaming
register("gold_overwrite_roundtrip", with_silver("SELECT * FROM dau", GOLD_CTES))
register("gold_export_roundtrip", with_silver("SELECT * FROM fa", GOLD_CTES))
register("stage_typed_scan", with_silver(_conformed("mrr_metrics"), GOLD_CTES))
register("schema_evolution_union", with_silver(f"""
SELECT {SILVER_COLS.replace('duration_seconds,', 'CASE WHEN day(processing_date) <= 15 THEN NULL ELSE duration_seconds END AS duration_seconds,')}
FROM silver"""))
register("stream_silver_events", with_silver(f"SELECT {SILVER_COLS} FROM silver"))
register("stream_restart_exactly_once", with_silver(f"SELECT {SILVER_COLS} FROM silver"))
register("stream_sessions", with_silver("SELECT * FROM sess_attr_full", SESSIONS_ATTR_CTE))
register("stream_users_scd2", with_silver("SELECT * FROM scd_full", SCD2_CTE))

register("stream_dedup_redelivery", with_silver(f"SELECT {SILVER_COLS} FROM silver"))
register("stream_dlq_events", ORACLES["dlq_events"])
register("stream_bronze_to_silver", with_silver(f"SELECT {SILVER_COLS} FROM silver"))
register("stream_sessions_complete", with_silver("SELECT * FROM sess_attr_full", SESSIONS_ATTR_CTE))
register("stream_dedup_watermark", with_silver(f"""
SELECT {SILVER_COLS.replace(' processed_at,', '')} FROM silver
WHERE _k > 5"""))
register("stream_gold_self_healing", with_silver("""
SELECT 'daily_active_users' AS table_name, date, CAST(date AS VARCHAR) AS key, CAST(dau_count AS DOUBLE) AS value FROM dau
UNION ALL SELECT 'mrr_metrics', date, CAST(date AS VARCHAR), CAST(net_mrr AS DOUBLE) FROM mrr
UNION ALL SELECT 'funnel_metrics', date, CAST(date AS VARCHAR), CAST(unique_visitors AS DOUBLE) FROM funnel
UNION ALL SELECT 'feature_adoption', date, feature_name, CAST(unique_users AS DOUBLE) FROM fa
UNION ALL SELECT 'session_quality', date, CAST(date AS VARCHAR), CAST(avg_session_duration_secs AS DOUBLE) FROM sq""", GOLD_CTES))
register("stream_health", "SELECT 'silver' AS query_name, FALSE AS is_active, COUNT(*) AS total_input_rows FROM events")
register("stage_files", with_silver(" UNION ALL ".join(
    f"SELECT '{n}' AS stage, COUNT(*) AS row_count, TRUE AS sized FROM {c}" for n, c in (
        ("daily_active_users", "dau"), ("mrr_metrics", "mrr"), ("funnel_metrics", "funnel"), ("feature_adoption", "fa"),
        ("session_quality", "sq"))), GOLD_CTES))
register("batch_silver_reprocess", with_silver("""
SELECT 'event' AS part, event_id AS key, CAST(1 AS BIGINT) AS n, CAST(floor(epoch(event_timestamp)) AS BIGINT) AS total FROM silver
UNION ALL SELECT 'session', session_id, COUNT(*), CAST(SUM(page_count) AS BIGINT) FROM sess_attr_full GROUP BY session_id
UNION ALL SELECT 'user', user_id, COUNT(*), CAST(SUM(floor(epoch(COALESCE(valid_to, valid_from)))) AS BIGINT) FROM scd_full GROUP BY user_id""",
    SESSIONS_ATTR_CTE + ", " + SCD2_CTE))
register("merge_upsert_evolve", with_silver("""
SELECT *, CASE WHEN day(date) >= 11 THEN 'r' || CAST(day(date) AS VARCHAR) END AS region FROM (""" + _conformed("daily_active_users") + ") t",
    GOLD_CTES))
register("stream_users_scd2_upsert", with_silver("SELECT * FROM scd_full", SCD2_CTE))
register("rolling_wau_mau_late_day", ORACLES["rolling_wau_mau"])
register("plan_breakdown_rows", with_silver("""
SELECT date, feature_name, plan, COUNT(*) AS uses
FROM ev WHERE event_type = 'feature_used' AND feature_name IS NOT NULL AND date IS NOT NULL AND plan IS NOT NULL
GROUP BY date, feature_name, plan"""))
register("plan_breakdown_schema", with_silver("""
SELECT feature_name, 'OBJECT<' || string_agg(plan || ': BIGINT', ', ' ORDER BY plan) || '>' AS schema
FROM (SELECT DISTINCT feature_name, plan FROM ev
      WHERE event_type = 'feature_used' AND feature_name IS NOT NULL AND date IS NOT NULL AND plan IS NOT NULL) p
GROUP BY feature_name"""))
register("star_events_of_weeks", with_silver("""
SELECT d.year, d.iso_week, f.feature_name, COUNT(*) AS uses, COUNT(DISTINCT f.user_id) AS users
FROM fact_events f JOIN dim_date d ON f.date_key = d.date_key
WHERE f.feature_name IS NOT NULL AND d.iso_week IN (2, 3)
GROUP BY d.year, d.iso_week, f.feature_name""", FACT_EVENTS_CTE + "," + DIM_DATE_CTE))
