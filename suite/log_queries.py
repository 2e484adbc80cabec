"""Parsing, log figures, reputation and lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suite.fixtures import YEAR, Inputs
from suite.registry import query
from watchfold.functions import extract_ip
from watchfold.operators import detect, intel, networks, sketches, summary
from watchfold.operators.logs import detect_format, parse_logs, rejects
from watchfold.functions.rules import uri_rule

# ---- parsing ---------------------------------------------------------------------

_WEB_COLUMNS = ("event_id", "format", "event_time", "ip_address", "status_code", "response_size", "user_agent")


@query("p1_extract_ip", "web", "SELECT event_id, ip_address FROM web")
def _(x: Inputs) -> DataFrame:
    return x.web_lines.select("event_id", extract_ip(F.col("raw")).alias("ip_address"))


@query(
    "p1_extract_ip_documents",
    sql=r"""
SELECT doc_id, nullif(regexp_extract(text,
  '(?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\.){3}(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)'), '') AS ip_address
FROM documents""",
)
def _(x: Inputs) -> DataFrame:
    return x.table("documents").select("doc_id", extract_ip(F.col("text")).alias("ip_address"))


@query(
    "p2_apache_common",
    "web",
    """SELECT event_id, 'apache_common' AS format, event_time, ip_address, status_code, response_size,
  CAST(NULL AS VARCHAR) AS user_agent FROM web""",
)
def _(x: Inputs) -> DataFrame:
    return parse_logs(x.web_lines, "apache_common").select(*_WEB_COLUMNS)


@query(
    "p3_apache_combined",
    "web",
    """SELECT event_id, CASE WHEN user_agent IS NULL THEN 'generic' ELSE 'apache_combined' END AS format,
  CASE WHEN user_agent IS NOT NULL THEN event_time END AS event_time, ip_address,
  CASE WHEN user_agent IS NOT NULL THEN status_code END AS status_code,
  CASE WHEN user_agent IS NOT NULL THEN response_size END AS response_size, user_agent FROM web""",
)
def _(x: Inputs) -> DataFrame:
    return parse_logs(x.web_lines, "apache").select(*_WEB_COLUMNS)


@query(
    "p4_nginx_default",
    "web",
    """SELECT event_id, 'nginx_default' AS format, event_time, ip_address, status_code, response_size,
  CAST(NULL AS VARCHAR) AS user_agent FROM web""",
)
def _(x: Inputs) -> DataFrame:
    return parse_logs(x.web_lines, "nginx").select(*_WEB_COLUMNS)


@query(
    "p5_nginx_upstream",
    "web",
    f"""SELECT w.event_id, 'nginx_upstream' AS format, event_time, ip_address, status_code,
  w.event_id % 5000 AS response_size, 'agent/' || (e.user_id % 9) AS user_agent
FROM web w JOIN events e ON w.event_id = e.event_id""",
)
def _(x: Inputs) -> DataFrame:
    return parse_logs(x.upstream_lines).select(*_WEB_COLUMNS)


_SSH_COLUMNS = ("event_id", "event_time", "ip_address", "username", "login_status")


def _ssh_oracle(status: str) -> str:
    def only(column: str) -> str:
        return f"CASE WHEN login_status = '{status}' THEN {column} END AS {column}"

    return f"SELECT event_id, {only('event_time')}, ip_address, {only('username')}, {only('login_status')} FROM ssh"


@query("p6_ssh_failed", "ssh", _ssh_oracle("failed"))
def _(x: Inputs) -> DataFrame:
    return parse_logs(x.ssh_lines, "ssh", year=YEAR).select(*_SSH_COLUMNS)


@query("p7_ssh_accepted", "ssh", _ssh_oracle("accepted"))
def _(x: Inputs) -> DataFrame:
    return parse_logs(x.ssh_lines, "ssh_accepted", year=YEAR).select(*_SSH_COLUMNS)


@query(
    "p8_generic",
    "web",
    """SELECT event_id, 'generic' AS format, ip_address, CAST(NULL AS INTEGER) AS status_code FROM web""",
)
def _(x: Inputs) -> DataFrame:
    return parse_logs(x.web_lines, "generic").select(
        "event_id", "format", "ip_address", "status_code"
    )


@query(
    "p9_fallback",
    "web ssh",
    """SELECT event_id, 'web' AS kind, 'generic' AS format, ip_address, CAST(NULL AS VARCHAR) AS username FROM web
UNION ALL SELECT event_id, 'ssh', CASE login_status WHEN 'failed' THEN 'ssh_failed' ELSE 'generic' END, ip_address,
  CASE WHEN login_status = 'failed' THEN username END FROM ssh""",
)
def _(x: Inputs) -> DataFrame:
    return parse_logs(x.mixed_lines, "ssh_failed", year=YEAR).select(
        "event_id", "kind", "format", "ip_address", "username"
    )


@query(
    "p10_rejects",
    sql=r"""
SELECT doc_id FROM documents WHERE NOT regexp_matches(text,
  '(?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\.){3}(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)')""",
)
def _(x: Inputs) -> DataFrame:
    lines = x.table("documents").select("doc_id", F.col("text").alias("raw"))
    return rejects(lines).select("doc_id")


@query(
    "p11_detect_format",
    "web ssh",
    """SELECT event_id, 'web' AS kind, format FROM web
UNION ALL SELECT event_id, 'ssh', 'ssh_' || login_status FROM ssh""",
)
def _(x: Inputs) -> DataFrame:
    return detect_format(x.mixed_lines).select("event_id", "kind", "format")


@query(
    "p11_file_format",
    "ssh",
    """WITH files AS (SELECT s.*, 'u' || (e.user_id % 7) AS file_path FROM ssh s JOIN events e ON s.event_id = e.event_id),
firsts AS (SELECT file_path, arg_min(login_status, event_id) AS file_status FROM files GROUP BY file_path)
SELECT event_id, file_path, ip_address, CASE WHEN login_status = file_status THEN username END AS username,
  CASE WHEN login_status = file_status THEN 'ssh_' || login_status ELSE 'generic' END AS format
FROM files JOIN firsts USING (file_path)""",
)
def _(x: Inputs) -> DataFrame:
    # The user number stands for the file; its smallest id is the first line.
    number = F.regexp_extract("raw", r" u(\d+) from", 1).cast("bigint")
    lines = x.ssh_lines.withColumn("file_path", F.concat(F.lit("u"), (number % 7).cast("string")))
    firsts = lines.groupBy("file_path").agg(F.min("event_id").alias("first_id"))
    numbered = lines.join(firsts, "file_path").withColumn(
        "line_number", F.when(F.col("event_id") == F.col("first_id"), 1).otherwise(2)
    )
    return parse_logs(numbered, "auto", detect="file", year=YEAR).select(
        "event_id", "file_path", "ip_address", "username", "format"
    )


@query(
    "p13_parse_logs",
    "web ssh",
    """SELECT event_id, 'web' AS kind, format, event_time, ip_address, status_code, response_size, user_agent,
  CAST(NULL AS VARCHAR) AS username, CAST(NULL AS VARCHAR) AS login_status, http_method, request_path FROM web
UNION ALL SELECT event_id, 'ssh', 'ssh_' || login_status, event_time, ip_address, NULL, NULL, NULL,
  username, login_status, NULL, NULL FROM ssh""",
)
def _(x: Inputs) -> DataFrame:
    return parse_logs(x.mixed_lines, year=YEAR).select(
        "event_id",
        "kind",
        "format",
        "event_time",
        "ip_address",
        "status_code",
        "response_size",
        "user_agent",
        "username",
        "login_status",
        "http_method",
        "request_path",
    )


@query("p14_web_time", "web", "SELECT event_id, timestamp_raw, event_time FROM web")
def _(x: Inputs) -> DataFrame:
    return x.web.select("event_id", "timestamp_raw", "event_time")


@query("p15_ssh_time", "ssh", "SELECT event_id, timestamp_raw, event_time FROM ssh")
def _(x: Inputs) -> DataFrame:
    return x.ssh.select("event_id", "timestamp_raw", "event_time")


@query("p16_numbers", "fx_web web", """SELECT w.event_id, trim(f.raw) AS raw, status_code, response_size
FROM web w JOIN fx_web f ON w.event_id = f.event_id""")
def _(x: Inputs) -> DataFrame:
    return x.web.select("event_id", "raw", "status_code", "response_size")


@query("p17_request_parts", "web", "SELECT event_id, http_method, request_path FROM web")
def _(x: Inputs) -> DataFrame:
    return x.web.select("event_id", "http_method", "request_path")


# ---- figures over entries ----------------------------------------------------------


@query("l1_unique_ips", "web", "SELECT DISTINCT ip_address FROM web")
def _(x: Inputs) -> DataFrame:
    return summary.unique_ips(x.web)


@query("l1_unique_ip_count", "web", "SELECT count(DISTINCT ip_address) AS unique_ips FROM web")
def _(x: Inputs) -> DataFrame:
    return summary.unique_ip_count(x.web)


@query("l2_ip_counts", "web", "SELECT ip_address, count(*) AS request_count FROM web GROUP BY 1")
def _(x: Inputs) -> DataFrame:
    return summary.ip_counts(x.web)


@query(
    "l3_indicators",
    "web fx_web fx_abuse fx_vt",
    """WITH ranked AS (SELECT ip_address, f.raw, row_number() OVER (PARTITION BY ip_address ORDER BY event_time, f.raw) AS r
  FROM web w JOIN fx_web f ON w.event_id = f.event_id),
samples AS (SELECT ip_address, string_agg(raw, '|' ORDER BY r) AS raw_lines FROM ranked WHERE r <= 5 GROUP BY 1),
activity AS (SELECT ip_address, min(event_time) AS first_seen, max(event_time) AS last_seen, count(*) AS request_count
  FROM web GROUP BY 1)
SELECT a.ip_address, first_seen, last_seen, request_count, abuse_confidence_score,
  coalesce(malicious, 0) > 0 AS is_malicious, country_code, country_name,
  coalesce(is_whitelisted, false) AS is_whitelisted, v.malicious AS vt_malicious, v.harmless AS vt_harmless, raw_lines
FROM activity a JOIN samples s ON a.ip_address = s.ip_address
LEFT JOIN fx_abuse b ON a.ip_address = b.ip_address LEFT JOIN fx_vt v ON a.ip_address = v.ip_address""",
)
def _(x: Inputs) -> DataFrame:
    return summary.indicators(x.web, x.abuse, x.vt).select(
        "ip_address",
        "first_seen",
        "last_seen",
        "request_count",
        "abuse_confidence_score",
        "is_malicious",
        "country_code",
        "country_name",
        "is_whitelisted",
        F.col("virus_total_stats.malicious").alias("vt_malicious"),
        F.col("virus_total_stats.harmless").alias("vt_harmless"),
        F.array_join("raw_log_entries", "|").alias("raw_lines"),
    )


@query(
    "l4_top_ips",
    "web",
    "SELECT ip_address, count(*) AS request_count FROM web GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
)
def _(x: Inputs) -> DataFrame:
    return summary.top_ips(x.web, 5)


_ENRICHED = """enriched AS (SELECT w.ip_address, b.ip_address IS NOT NULL AS has_abuse, v.ip_address IS NOT NULL AS has_vt,
  b.* EXCLUDE (ip_address), v.* EXCLUDE (ip_address)
  FROM (SELECT DISTINCT ip_address FROM web) w LEFT JOIN fx_abuse b ON w.ip_address = b.ip_address
  LEFT JOIN fx_vt v ON w.ip_address = v.ip_address WHERE b.ip_address IS NOT NULL OR v.ip_address IS NOT NULL)"""


@query(
    "l5_enrich",
    "web fx_abuse fx_vt",
    f"WITH {_ENRICHED} SELECT ip_address, has_abuse, has_vt, abuse_confidence_score, total_reports, malicious, harmless FROM enriched",
)
def _(x: Inputs) -> DataFrame:
    return intel.enrich(x.web, x.abuse, x.vt).select(
        "ip_address",
        F.col("abuse").isNotNull().alias("has_abuse"),
        F.col("vt").isNotNull().alias("has_vt"),
        "abuse.abuse_confidence_score",
        "abuse.total_reports",
        "vt.malicious",
        "vt.harmless",
    )


_FLAG = "(coalesce(abuse_confidence_score, 0) >= 50 OR coalesce(malicious, 0) > 0)"
_TIER = """CASE WHEN coalesce(abuse_confidence_score, 0) >= 80 THEN 'HIGH'
  WHEN coalesce(abuse_confidence_score, 0) >= 50 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier"""


@query(
    "l7_flag",
    "web fx_abuse fx_vt",
    f"WITH {_ENRICHED} SELECT ip_address FROM enriched WHERE (coalesce(abuse_confidence_score, 0) >= 70 OR coalesce(malicious, 0) > 0)",
)
def _(x: Inputs) -> DataFrame:
    return intel.flag(intel.enrich(x.web, x.abuse, x.vt), 70).select("ip_address")


@query(
    "l8_risk_tier",
    "web fx_abuse fx_vt",
    f"WITH {_ENRICHED} SELECT ip_address, {_TIER} FROM enriched",
)
def _(x: Inputs) -> DataFrame:
    return intel.with_tier(intel.enrich(x.web, x.abuse, x.vt)).select("ip_address", "risk_tier")


@query(
    "l9_flagged_ips",
    "web fx_abuse fx_vt",
    f"""WITH {_ENRICHED} SELECT ip_address, coalesce(abuse_confidence_score, 0) AS abuse_score,
  coalesce(malicious, 0) AS vt_malicious, coalesce(country_name, 'Unknown') AS country,
  coalesce(total_reports, 0) AS reports, {_TIER} FROM enriched WHERE {_FLAG} ORDER BY 2 DESC, 1""",
)
def _(x: Inputs) -> DataFrame:
    return intel.flagged_table(intel.enrich(x.web, x.abuse, x.vt))


@query(
    "l9_flagged_activity",
    "web fx_abuse fx_vt",
    f"""WITH {_ENRICHED}, counts AS (SELECT ip_address, count(*) AS request_count FROM web GROUP BY 1)
SELECT e.ip_address, coalesce(abuse_confidence_score, 0) AS abuse_score, coalesce(malicious, 0) AS vt_malicious,
  {_TIER}, request_count FROM enriched e JOIN counts c ON e.ip_address = c.ip_address WHERE {_FLAG}""",
)
def flagged_activity(x: Inputs) -> DataFrame:
    # Counting first makes the addresses distinct: one shuffle serves both steps.
    known = intel.attach(summary.ip_counts(x.web), x.abuse, x.vt)
    return intel.with_tier(intel.flag(known)).select(
        "ip_address",
        intel.abuse_score().alias("abuse_score"),
        intel.vt_malicious().alias("vt_malicious"),
        "risk_tier",
        "request_count",
    )


@query(
    "l10_summary",
    "web fx_abuse fx_vt",
    f"""WITH {_ENRICHED}, codes AS (SELECT status_code, count(*) AS n FROM web WHERE status_code > 0 GROUP BY 1)
SELECT (SELECT count(*) FROM web) AS total_entries, (SELECT count(DISTINCT ip_address) FROM web) AS unique_ips,
  count(*) FILTER (coalesce(abuse_confidence_score, 0) >= 50) AS flagged_ips,
  count(*) FILTER (coalesce(malicious, 0) > 0) AS malicious_ips,
  count(*) FILTER (coalesce(abuse_confidence_score, 0) >= 80) AS high_risk_ips,
  (SELECT string_agg(status_code || '=' || n, ',' ORDER BY status_code) FROM codes) AS status_codes,
  'abuse,vt' AS apis_queried FROM enriched""",
)
def _(x: Inputs) -> DataFrame:
    row = summary.summary_with_feeds(x.web, x.abuse, x.vt)
    pairs = F.transform(
        F.map_entries("status_code_distribution"),
        lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"].cast("string")),
    )
    return row.withColumns(
        {
            "status_codes": F.array_join(pairs, ","),
            "apis_queried": F.array_join("apis_queried", ","),
        }
    ).drop("status_code_distribution")


@query(
    "l11_status_distribution",
    "web",
    "SELECT status_code, count(*) AS n FROM web WHERE status_code > 0 GROUP BY 1",
)
def _(x: Inputs) -> DataFrame:
    return summary.status_distribution(x.web)


@query(
    "l12_ip_details",
    "web fx_abuse fx_vt",
    f"""WITH {_ENRICHED} SELECT ip_address, has_abuse, has_vt,
  coalesce(CAST(abuse_confidence_score AS VARCHAR), 'N/A') AS abuse_confidence_score,
  coalesce(country_name, 'Unknown') AS country_name, coalesce(country_code, 'N/A') AS country_code,
  coalesce(total_reports, 0) AS total_reports, coalesce(num_distinct_users, 0) AS num_distinct_users,
  CASE WHEN is_whitelisted THEN 'Yes' ELSE 'No' END AS whitelisted, coalesce(malicious, 0) AS malicious,
  coalesce(suspicious, 0) AS suspicious, coalesce(harmless, 0) AS harmless, coalesce(undetected, 0) AS undetected
FROM enriched""",
)
def _(x: Inputs) -> DataFrame:
    return intel.ip_details(intel.enrich(x.web, x.abuse, x.vt))


@query(
    "l13_status_table",
    "web",
    """SELECT status_code, count(*) AS n, CASE status_code WHEN 200 THEN 'Successful requests'
  WHEN 302 THEN 'Temporary redirects' WHEN 401 THEN 'Unauthorized - potential brute force'
  WHEN 500 THEN 'Server errors' END AS description FROM web GROUP BY 1""",
)
def _(x: Inputs) -> DataFrame:
    return summary.status_table(x.web)


# ---- detectors and lists over entries ----------------------------------------------


@query(
    "t7_brute_force_ssh",
    "ssh",
    """SELECT ip_address, time_bucket(INTERVAL '6 hours', event_time) AS window_start,
  time_bucket(INTERVAL '6 hours', event_time) + INTERVAL '6 hours' AS window_end, count(*) AS failures
FROM ssh WHERE login_status = 'failed' GROUP BY 1, 2, 3 HAVING count(*) >= 3""",
)
def _(x: Inputs) -> DataFrame:
    return detect.brute_force(x.ssh, 3, "6 hours")


@query(
    "t7_brute_force_sliding",
    "web",
    """WITH starts AS (SELECT ip_address, time_bucket(INTERVAL '1 hour', event_time) - INTERVAL (k) HOUR AS window_start
  FROM web, generate_series(0, 5) g(k) WHERE status_code = 401)
SELECT ip_address, window_start, window_start + INTERVAL '6 hours' AS window_end, count(*) AS failures
FROM starts GROUP BY 1, 2, 3 HAVING count(*) >= 5""",
)
def _(x: Inputs) -> DataFrame:
    return detect.brute_force(x.web, 5, "6 hours", "1 hour")


@query(
    "t11_odd_agent",
    "web",
    """SELECT user_agent, count(*) AS requests, count(DISTINCT ip_address) AS sources,
  CASE WHEN user_agent IS NULL THEN 'absent' ELSE 'rare' END AS reason
FROM web GROUP BY 1 HAVING user_agent IS NULL OR count(DISTINCT ip_address) < 10""",
)
def _(x: Inputs) -> DataFrame:
    return detect.odd_agent(x.web, 10)


@query(
    "t11_tool_agents",
    "web",
    """WITH w AS (SELECT ip_address, CASE WHEN event_id % 13 = 0 THEN 'curl/8.1' ELSE user_agent END AS user_agent FROM web)
SELECT user_agent, count(*) AS requests, count(DISTINCT ip_address) AS sources,
  CASE WHEN user_agent IS NULL THEN 'absent' WHEN user_agent LIKE 'curl%' THEN 'tool' ELSE 'rare' END AS reason
FROM w GROUP BY 1 HAVING user_agent IS NULL OR user_agent LIKE 'curl%' OR count(DISTINCT ip_address) < 10""",
)
def _(x: Inputs) -> DataFrame:
    agent = F.when(F.col("event_id") % 13 == 0, "curl/8.1").otherwise(F.col("user_agent"))
    return detect.odd_agent(x.web.withColumn("user_agent", agent), 10)


@query(
    "l5_feed_with_repeats",
    "web fx_abuse",
    """SELECT event_id, w.ip_address, abuse_confidence_score + 1 AS score FROM web w
LEFT JOIN fx_abuse b ON w.ip_address = b.ip_address""",
)
def _(x: Inputs) -> DataFrame:
    worse = x.abuse.withColumn("abuse_confidence_score", (F.col("abuse_confidence_score") + 1).cast("int"))
    known = intel.attach(x.web.select("event_id", "ip_address"), x.abuse.unionByName(worse), x.vt)
    return known.select("event_id", "ip_address", F.col("abuse.abuse_confidence_score").alias("score"))


@query(
    "a1_unauthorized",
    "web",
    """SELECT ip_address, count(*) AS refused, min(event_time) AS first_seen, max(event_time) AS last_seen
FROM web WHERE status_code IN (401, 403) GROUP BY 1""",
)
def _(x: Inputs) -> DataFrame:
    return summary.unauthorized(x.web)


@query(
    "a2_allow_list",
    "web fx_abuse",
    """SELECT event_id, ip_address FROM web
WHERE ip_address NOT IN (SELECT ip_address FROM fx_abuse WHERE is_whitelisted OR abuse_confidence_score < 30)""",
)
def _(x: Inputs) -> DataFrame:
    allowed = x.abuse.filter("is_whitelisted or abuse_confidence_score < 30")
    return summary.allow(x.web.select("event_id", "ip_address"), allowed)


@query(
    "a2_deny_list",
    "web fx_abuse",
    """SELECT event_id, ip_address FROM web
WHERE ip_address IN (SELECT ip_address FROM fx_abuse WHERE abuse_confidence_score >= 80)""",
)
def _(x: Inputs) -> DataFrame:
    denied = x.abuse.filter("abuse_confidence_score >= 80")
    return summary.deny(x.web.select("event_id", "ip_address"), denied)


_IN_NETWORK = """nets AS (SELECT DISTINCT CASE WHEN abuse_confidence_score % 3 = 0
    THEN split_part(ip_address, '.', 1) || '.0.0.0/8'
    WHEN abuse_confidence_score % 3 = 1 THEN regexp_replace(ip_address, '[.][0-9]+$', '.0') || '/24' ELSE ip_address END AS network
  FROM fx_abuse),
best AS (SELECT w.ip_address, max_by(n.network, length(n.network) - CASE WHEN n.network LIKE '%/8' THEN 9 ELSE 0 END
    + CASE WHEN n.network NOT LIKE '%/%' THEN 99 ELSE 0 END) AS network
  FROM (SELECT DISTINCT ip_address FROM web) w JOIN nets n ON w.ip_address = n.network
    OR (n.network LIKE '%/24' AND regexp_replace(w.ip_address, '[.][0-9]+$', '.0') || '/24' = n.network)
    OR (n.network LIKE '%/8' AND split_part(w.ip_address, '.', 1) || '.0.0.0/8' = n.network) GROUP BY 1)"""


def _networks(x: Inputs) -> DataFrame:
    ip, score = F.col("ip_address"), F.col("abuse_confidence_score")
    wide = F.concat(F.split_part(ip, F.lit("."), F.lit(1)), F.lit(".0.0.0/8"))
    near = F.concat(F.regexp_replace(ip, "[.][0-9]+$", ".0"), F.lit("/24"))
    return x.abuse.select(F.when(score % 3 == 0, wide).when(score % 3 == 1, near).otherwise(ip).alias("network")).distinct()


@query("a2_networks", "web fx_abuse", f"WITH {_IN_NETWORK} SELECT event_id, ip_address, network FROM web LEFT JOIN best USING (ip_address)")
def _(x: Inputs) -> DataFrame:
    """The most specific of nested networks for every request."""
    return networks.with_network(x.web.select("event_id", "ip_address"), _networks(x))


@query(
    "a2_deny_networks",
    "web fx_abuse",
    f"WITH {_IN_NETWORK} SELECT event_id, ip_address FROM web WHERE ip_address IN (SELECT ip_address FROM best)",
)
def _(x: Inputs) -> DataFrame:
    return networks.deny_networks(x.web.select("event_id", "ip_address"), _networks(x))


@query(
    "a2_update_list",
    "web fx_abuse fx_vt",
    """SELECT ip_address FROM web WHERE ip_address NOT IN (SELECT ip_address FROM fx_abuse WHERE abuse_confidence_score < 30)
UNION SELECT ip_address FROM fx_vt WHERE malicious > 1""",
)
def _(x: Inputs) -> DataFrame:
    return summary.update_list(
        summary.unique_ips(x.web),
        remove=x.abuse.filter("abuse_confidence_score < 30"),
        add=x.vt.filter("malicious > 1"),
    )


@query(
    "a3_sql_injection",
    "web",
    """SELECT event_id, ip_address, request_path, 'sql_injection' AS rule FROM web
WHERE event_id % 50 = 2""",
)
def _(x: Inputs) -> DataFrame:
    found = x.web.withColumn("rule", uri_rule(F.col("request_path")))
    return found.filter("rule = 'sql_injection'").select(
        "event_id", "ip_address", "request_path", "rule"
    )


@query(
    "a3_sql_injection_decoded",
    "web",
    """SELECT event_id, ip_address, request_path, 'sql_injection' AS rule FROM web
WHERE event_id % 50 IN (1, 2)""",
)
def _(x: Inputs) -> DataFrame:
    decoded = F.coalesce(F.try_url_decode("request_path"), F.col("request_path"))
    found = x.web.withColumn("rule", uri_rule(decoded))
    return found.filter("rule = 'sql_injection'").select(
        "event_id", "ip_address", "request_path", "rule"
    )


@query(
    "a4_brute_force_web",
    "web",
    """SELECT ip_address, time_bucket(INTERVAL '1 day', event_time) AS window_start,
  time_bucket(INTERVAL '1 day', event_time) + INTERVAL '1 day' AS window_end, count(*) AS failures
FROM web WHERE status_code = 401 GROUP BY 1, 2, 3 HAVING count(*) >= 5""",
)
def _(x: Inputs) -> DataFrame:
    return detect.brute_force(x.web, 5, "1 day")


_HISTORY = """history AS (SELECT ip_address, date_trunc('day', event_time) + INTERVAL 7 HOUR AS valid_from,
  CAST(count(*) % 101 AS INTEGER) AS abuse_confidence_score FROM web
  WHERE event_id % 5 < 3 GROUP BY 1, 2)"""


@query(
    "w3_feed_as_of",
    "web",
    f"""WITH {_HISTORY} SELECT event_id, w.ip_address, event_time, h.valid_from, h.abuse_confidence_score
FROM web w ASOF LEFT JOIN history h ON w.ip_address = h.ip_address AND w.event_time >= h.valid_from""",
)
def _(x: Inputs) -> DataFrame:
    """The response that was valid when each request came."""
    some = x.web.filter("event_id % 5 < 3")
    history = some.groupBy(
        "ip_address", (F.date_trunc("day", "event_time") + F.expr("INTERVAL 7 HOUR")).cast("timestamp_ntz").alias("valid_from")
    ).agg((F.count("*") % 101).cast("int").alias("abuse_confidence_score"))
    found = intel.attach_as_of(x.web.select("event_id", "ip_address", "event_time"), history, "abuse")
    return found.select("event_id", "ip_address", "event_time", "abuse.valid_from", "abuse.abuse_confidence_score")


@query(
    "l1_sketched_addresses",
    "web",
    """SELECT date_trunc('day', event_time) AS day, count(*) AS rows, count(DISTINCT ip_address || '/' || event_id) AS exact,
  true AS close FROM web GROUP BY 1""",
)
def _(x: Inputs) -> DataFrame:
    """Distinct requests a day from hourly sketches, beside the exact count they come close to."""
    value = F.concat_ws("/", "ip_address", "event_id")
    hours = sketches.hourly_sketches(x.web, [], value, ts="event_time")
    day = F.date_trunc("day", "bucket").cast("timestamp_ntz").alias("day")
    found = sketches.estimated(sketches.merged(hours, day), "guess")
    exact = x.web.groupBy(F.date_trunc("day", "event_time").cast("timestamp_ntz").alias("day")).agg(F.count_distinct(value).alias("exact"))
    close = F.abs(F.col("guess") - F.col("exact")) <= F.greatest(4 * sketches.error_bound() * F.col("exact"), F.lit(1.0))
    return found.join(exact, "day").select("day", "rows", "exact", close.alias("close"))
