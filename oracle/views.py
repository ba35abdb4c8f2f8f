"""The stand-in views in SQL, as common table expressions over the driver tables."""

from __future__ import annotations

import re

from cohortline.sources import stand_in as s


def q(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def pick(values, index: str) -> str:
    return f"([{', '.join(q(v) for v in values)}])[CAST({index} AS BIGINT) + 1]"


def email(key: str) -> str:
    return f"('u' || ({key}) || '@d' || (({key}) % 25) || '.example')"


def domain(key: str) -> str:
    return f"('d' || (({key}) % 25) || '.example')"


def kind(key: str) -> str:
    return f"CASE {key} % 5 WHEN 0 THEN 'Internal' WHEN 1 THEN 'External Private User' ELSE 'External Company User' END"


ASSET_NOW = f"TIMESTAMP '{s.ASSET_AS_OF}'"
EVENT_NOW = f"TIMESTAMP '{s.EVENT_AS_OF}'"
TITLES = pick(("CTO", None, "Engineer", "Analyst"), "{0} % 4")

VIEWS: dict[str, str] = {
    "bare_assets": f"""
SELECT o_orderkey AS dbid, o_custkey AS userkey, {email('o_custkey')} AS email, {domain('o_custkey')} AS email_domain,
       {kind('o_custkey')} AS user_classification,
       {pick(('Enterprise', 'Direct', 'Free', 'GCP', 'GDS'), "CAST(o_orderpriority[1] AS INT) - 1")} AS tier,
       {pick(('enterprise', 'professional', 'free', 'professional', 'gds'), "CAST(o_orderpriority[1] AS INT) - 1")} AS db_tier,
       o_orderdate + to_hours(CAST(o_orderkey % 24 AS INT)) AS born,
       CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_hours(CAST(o_orderkey % 24 AS INT))
            + to_days(CAST(o_orderkey * 37 % 200 AS INT)) + to_hours(CAST(o_orderkey % 5 AS INT)) END AS died
FROM orders""",
    "assets": f"""
SELECT *, pow(2.0, dbid % 4) AS initial_size_gb, pow(2.0, (dbid + 2) % 4) AS most_recent_size_gb,
       pow(2.0, (dbid + 2) % 4) * 1024 AS most_recent_size_mb,
       CAST(pow(2.0, dbid % 4) AS INT) || 'GB' AS initial_size_label,
       dbid % 3 AS resize_count, date_sub('day', born, coalesce(died, {ASSET_NOW})) AS db_lifetime_days,
       (dbid % 400) / 4.0 AS total_cost_dollars, (dbid % 100) / 4.0 AS mrr_num,
       row_number() OVER (PARTITION BY userkey ORDER BY born, dbid) AS seq,
       row_number() OVER (PARTITION BY userkey ORDER BY born DESC, dbid DESC) AS rseq,
       CASE WHEN user_classification = 'External Private User' THEN CAST(userkey AS VARCHAR) ELSE email_domain END AS account_id,
       coalesce(died, {ASSET_NOW}) AS ended
FROM bare_assets""",
    "size_history": """
SELECT dbid, pow(2.0, (dbid + v) % 4) * 1024 AS db_size, born + to_days(30 * v) AS eff_from,
       CASE WHEN v < 2 THEN born + to_days(30 * (v + 1)) ELSE TIMESTAMP '9999-12-31 00:00:00' END AS eff_thru
FROM bare_assets, (VALUES (0), (1), (2)) AS versions(v)""",
    "billing_hours": """
SELECT l_orderkey AS dbid, l_shipdate + to_hours(l_linenumber) AS hour_of_day, l_quantity AS memory_gb FROM lineitem""",
    "asset_minutes": """
SELECT l_orderkey AS dbid, l_shipdate AS minute, l_linenumber % 3 AS queries,
       CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS loads
FROM lineitem""",
    "agent_facts": f"""
SELECT l_orderkey AS dbid, l_shipdate AS minute, {pick(s.AGENTS, 'l_suppkey % 5')} AS agent,
       {pick(s.AGENT_VERSIONS, 'l_partkey % 3')} AS agent_version
FROM lineitem""",
    "dump_uploads": f"""
SELECT {email('user_id')} AS owner, ts AS at FROM events WHERE event_type = 'purchase'""",
    "users": f"""
SELECT c_custkey AS userkey, {email('c_custkey')} AS email, {domain('c_custkey')} AS email_domain,
       {kind('c_custkey')} AS user_classification,
       coalesce((SELECT min(born) FROM bare_assets a WHERE a.userkey = c_custkey), TIMESTAMP '1995-01-01')
         - to_days(CAST(c_custkey % 10 AS INT)) AS createdat,
       CASE WHEN c_custkey % 4 <> 0 THEN {pick(('free', 'self_serve', 'enterprise'), 'c_custkey % 3')} END AS plan_type
FROM customer""",
    "snapshots": f"""
SELECT 'User, "' || c_custkey || '"' AS path, make_timestamp(2000, (c_custkey + v) % 3 + 1, 1, 0, 0, 0.0) AS seen_at,
       {pick(('free', None, 'enterprise', 'self_serve'), '(c_custkey + 2 * v) % 4')} AS plan_type
FROM customer, (VALUES (0), (1), (2)) AS versions(v)""",
    "contacts": f"""
SELECT 'c' || s_suppkey AS id, s_name AS name, {TITLES.format('s_suppkey')} AS title, 'a' || s_nationkey AS account_id,
       CASE WHEN s_suppkey % 9 <> 0 THEN {email('s_suppkey % 40')} END AS email
FROM supplier""",
    "accounts": f"""
SELECT 'a' || n_nationkey AS id, n_name AS name, {pick(('Retail', 'Energy', None), 'n_nationkey % 3')} AS industry,
       {pick(('Customer', 'Prospect'), 'n_nationkey % 2')} AS type, n_nationkey * 1000.0 AS annual_revenue
FROM nation WHERE n_nationkey % 6 <> 5""",
    "leads": f"""
SELECT 'l' || c_custkey AS id, c_name AS name, {pick(('Retail', 'Energy', None), 'c_custkey % 3')} AS industry,
       {TITLES.format('c_custkey')} AS title, CASE WHEN c_custkey % 11 <> 0 THEN {email('c_custkey % 200')} END AS email,
       CASE WHEN c_custkey % 3 = 0 THEN 'c' || c_custkey END AS converted
FROM customer""",
    "helpdesk": f"""
SELECT {email('c_custkey')} AS email, 'h' || c_custkey AS id, {pick(('vip', None), 'c_custkey % 2')} AS tags
FROM customer WHERE c_custkey % 4 = 1""",
    "subjects": """
SELECT c_custkey AS userkey, 'subject-' || c_custkey AS subject_id, 's' || (c_custkey % 100) AS short_subject_id
FROM customer WHERE c_custkey % 7 <> 0""",
    "ev": """
SELECT event_id, user_id, event_type, value, ts, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events""",
    "raw_events": f"""
SELECT ts, CAST(floor(epoch(ts)) AS BIGINT) AS secs, {pick(s.EVENT_NAMES, f'(k + event_id) % {len(s.EVENT_NAMES)}')} AS name,
       lower({pick(s.EVENT_NAMES, f'(k + event_id) % {len(s.EVENT_NAMES)}')}) AS lname,
       'd' || user_id || '-' || (event_id % 3) AS did,
       CASE WHEN event_type = 'signup' THEN {email('user_id')} END AS email,
       {pick(('browser', 'explorer'), 'k % 2')} AS label, {pick(('4.1', '4.2', None), 'k % 3')} AS version,
       (k % 8) || 'GB' AS size, {pick(('eu', 'us', 'ap'), 'event_id % 3')} AS region,
       CASE WHEN k % 2 = 0 THEN 'new' END AS installtype, {pick(s.STEPS, 'k % 3')} AS step, 'view' || (k % 5) AS view_name,
       {pick(('en', 'de'), 'k % 2')} AS language, (k % 4) || 'GB' AS old_size, (k % 6) || 'GB' AS new_size,
       CASE WHEN k % 3 = 0 THEN 'push' END AS push_command, lpad(CAST(event_id AS VARCHAR), 8, '0') AS url_id, k % 3 AS url_kind,
       'v' || user_id AS device, CASE WHEN event_id % 5 = 0 THEN 'U' || user_id END AS uid,
       CASE WHEN event_id % 7 = 0 THEN 'p' || user_id || '-' || (event_id % 2) END AS prior,
       {pick(('t1', 't1', 't1', 't2'), 'event_id % 4')} AS tenant, event_type
FROM ev""",
    "nested_events": f"""
SELECT {pick(s.PIVOT_EVENTS, f'(k + event_id) % {len(s.PIVOT_EVENTS)}')} AS event, CAST(ts AS DATE) AS day,
       'd' || user_id || '-' || (event_id % 3) AS did, {pick(('browser', 'explorer', None), 'k % 3')} AS label
FROM ev""",
    "visits": f"""
SELECT 'd' || user_id || '-' || (event_id % 3) AS did, 'v' || user_id AS device, CAST(floor(epoch(ts)) AS BIGINT) AS secs,
       epoch_us(ts) // 1000 AS ms, {pick(s.PATHS, 'event_id % 3')} AS pathname, {pick(s.REFERRERS, '(k + event_id) % 24')} AS referrer,
       {pick(('a.example', 'b.example', None), 'k % 3')} AS referring_domain,
       {pick([t[0] for t in s.TOUCHES], '(k + event_id) % 24')} AS ir, {pick([t[1] for t in s.TOUCHES], '(k + event_id) % 24')} AS ird,
       {pick([t[2] for t in s.TOUCHES], '(k + event_id) % 24')} AS us, {pick([t[3] for t in s.TOUCHES], '(k + event_id) % 24')} AS um,
       {pick([t[4] for t in s.TOUCHES], '(k + event_id) % 24')} AS uc,
       {pick(('US', 'DE', None), 'k % 3')} AS country, {pick(('CA', 'BE'), 'event_id % 2')} AS region,
       {pick(('t1', 't1', 't1', 't2'), 'k % 4')} AS tenant, event_type
FROM ev""",
    "page_views": "SELECT * FROM visits WHERE event_type IN ('view', 'click')",
    "navigation": "SELECT * FROM visits WHERE event_type IN ('signup', 'purchase')",
    "registrants": f"""
SELECT user_id AS userkey, {email('user_id')} AS email, min(ts) AS created FROM events WHERE event_type = 'signup' GROUP BY user_id""",
    "registrant_assets": f"""
SELECT {email('user_id')} AS email, min(ts) AS created FROM events WHERE event_type IN ('purchase', 'signup') GROUP BY user_id""",
    "identity": """
SELECT i.did, u.uid, m.email, p.prior
FROM (SELECT DISTINCT did FROM raw_events) i
LEFT JOIN (SELECT DISTINCT did, uid FROM raw_events WHERE uid IS NOT NULL) u USING (did)
LEFT JOIN (SELECT DISTINCT did, email FROM raw_events WHERE email IS NOT NULL) m USING (did)
LEFT JOIN (SELECT DISTINCT did, prior FROM raw_events WHERE prior IS NOT NULL) p USING (did)""",
    "query_log": f"""
SELECT ts, user_id AS dbid, {pick(('ann', 'bob', None), 'event_id % 3')} AS username,
       CASE WHEN event_type = 'purchase' THEN 'commit' ELSE 'start' END AS event, event_id AS id,
       CASE WHEN k % 10 = 3 THEN 'embedded-session' ELSE 'bolt-session' END AS session,
       event_id % 6 + 1 AS parts,
       CASE WHEN event_id % 6 >= 2 THEN {pick(s.DRIVERS, 'k % 5')} END AS driver_info,
       {pick(s.QUERIES, 'k % 8').replace(chr(10), "' || chr(10) || '")} AS query,
       {pick(s.ANNOTATIONS, '(k + event_id) % 4')} AS annotation,
       CASE WHEN k % 11 = 0 THEN 'failed' END AS failure,
       CASE WHEN k % 11 = 0 THEN 'ClientError: bad' || chr(10) || 'line ' || k END AS trace,
       CASE WHEN value * 4 - 100 < 0 THEN 0 ELSE value * 4 - 100 END AS raw_bytes, CASE WHEN value - 50 < 0 THEN 0 ELSE value - 50 END AS raw_millis,
       greatest(CAST(value * 4 - 100 AS DECIMAL(28,6)), 0) AS bytes, greatest(CAST(value - 50 AS DECIMAL(28,6)), 0) AS millis,
       CAST(k * 1.5 AS DECIMAL(28,6)) AS hits, CAST(k * 0.5 AS DECIMAL(28,6)) AS faults
FROM ev""",
}


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` preceded by the views it names, in dependency order."""
    known = VIEWS | (extra or {})
    seen: set[str] = set()
    order: list[str] = []

    def need(sql: str) -> None:
        for name in known:
            if name not in seen and re.search(rf"\b{name}\b", sql):
                seen.add(name)
                need(known[name])
                order.append(name)

    need(body)
    ctes = ",\n".join(f"{n} AS ({known[n].strip()})" for n in order)
    return f"WITH {ctes}\n{body.strip()}" if ctes else body.strip()
