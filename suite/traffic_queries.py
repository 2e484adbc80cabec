"""Traffic figures, detectors, indicators and report tables over packets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suite.fixtures import Inputs
from suite.registry import query
from watchfold.functions import flag_text, is_private, suspicious_domain, uri_rule
from watchfold.operators import detect, ioc, report, sketches, traffic

P = "fx_packets"

# ---- statistics ------------------------------------------------------------------


@query("n1_totals", P, "SELECT count(*) AS total_packets, CAST(sum(length) AS BIGINT) AS total_bytes FROM fx_packets")
def _(x: Inputs) -> DataFrame:
    return traffic.totals(x.packets)


@query(
    "n2_by_protocol",
    P,
    """SELECT protocol, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM fx_packets), 4) AS pct
FROM fx_packets GROUP BY 1""",
)
def _(x: Inputs) -> DataFrame:
    return traffic.by_protocol(x.packets)


@query("n3_by_source", P, "SELECT src_ip, count(*) AS n FROM fx_packets GROUP BY 1")
def _(x: Inputs) -> DataFrame:
    return traffic.by_source(x.packets)


@query("n4_by_destination", P, "SELECT dst_ip, count(*) AS n FROM fx_packets GROUP BY 1")
def _(x: Inputs) -> DataFrame:
    return traffic.by_destination(x.packets)


@query("n5_by_port", P, "SELECT dst_port, count(*) AS n FROM fx_packets GROUP BY 1")
def _(x: Inputs) -> DataFrame:
    return traffic.by_port(x.packets)


@query(
    "n6_top_sources",
    P,
    "SELECT src_ip, count(*) AS n FROM fx_packets GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
def _(x: Inputs) -> DataFrame:
    return traffic.top_talkers(x.packets)


@query(
    "n6_top_destinations",
    P,
    "SELECT dst_ip, count(*) AS n FROM fx_packets GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
def _(x: Inputs) -> DataFrame:
    return traffic.top_talkers(x.packets, side="dst_ip")


@query(
    "n7_unique_endpoints",
    P,
    """SELECT count(DISTINCT src_ip) AS unique_sources, count(DISTINCT dst_ip) AS unique_destinations
FROM fx_packets""",
)
def _(x: Inputs) -> DataFrame:
    return traffic.unique_endpoints(x.packets)


FLAGS = """concat_ws(',', CASE WHEN flag_bits & 2 = 2 THEN 'SYN' END, CASE WHEN flag_bits & 18 = 18 THEN 'SYN-ACK' END,
  CASE WHEN flag_bits & 16 = 16 THEN 'ACK' END, CASE WHEN flag_bits & 8 = 8 THEN 'PSH' END,
  CASE WHEN flag_bits & 1 = 1 THEN 'FIN' END, CASE WHEN flag_bits & 4 = 4 THEN 'RST' END)"""


@query(
    "n8_flows",
    "fx_packets fx_bidi",
    f"""WITH ordered AS (SELECT *, {FLAGS} AS flag_text,
  CASE WHEN (src_ip, src_port) <= (dst_ip, dst_port) THEN src_ip || ':' || src_port || '-' || dst_ip || ':' || dst_port
    ELSE dst_ip || ':' || dst_port || '-' || src_ip || ':' || src_port END AS pair FROM fx_bidi),
placed AS (SELECT *, row_number() OVER (PARTITION BY protocol, pair ORDER BY ts, packet_id) AS r FROM ordered)
SELECT max(src_ip) FILTER (r = 1) AS src_ip, max(dst_ip) FILTER (r = 1) AS dst_ip,
  max(src_port) FILTER (r = 1) AS src_port, max(dst_port) FILTER (r = 1) AS dst_port, protocol,
  min(ts) AS start_time, max(ts) AS end_time, count(*) AS packet_count, CAST(sum(length) AS BIGINT) AS byte_count,
  coalesce(string_agg(DISTINCT flag_text, '|' ORDER BY flag_text) FILTER (flag_text <> ''), '') AS flags
FROM placed GROUP BY protocol, pair""",
)
def flows(x: Inputs) -> DataFrame:
    return traffic.flows(x.bidi).withColumn("flags", F.array_join("flags", "|"))


_HTTP = "packet_id, ts, http_method, http_uri, http_host, src_ip, dst_ip"
_DNS = "packet_id, ts, dns_query, dns_response, src_ip, dst_ip"


@query("n9_http_requests", P, f"SELECT {_HTTP} FROM fx_packets WHERE http_method IS NOT NULL")
def _(x: Inputs) -> DataFrame:
    return traffic.http_requests(x.packets)


@query(
    "n9_http_first_100",
    P,
    f"SELECT {_HTTP} FROM fx_packets WHERE http_method IS NOT NULL ORDER BY ts, packet_id LIMIT 100",
)
def _(x: Inputs) -> DataFrame:
    return traffic.http_requests(x.packets, 100)


@query("n10_dns_queries", P, f"SELECT {_DNS} FROM fx_packets WHERE dns_query IS NOT NULL")
def _(x: Inputs) -> DataFrame:
    return traffic.dns_queries(x.packets)


@query(
    "n10_dns_first_100",
    P,
    f"SELECT {_DNS} FROM fx_packets WHERE dns_query IS NOT NULL ORDER BY ts, packet_id LIMIT 100",
)
def _(x: Inputs) -> DataFrame:
    return traffic.dns_queries(x.packets, 100)


_ATTEMPTS = """attempts AS (SELECT dst_ip, dst_port, count(*) AS attempts, max(ts) AS last_ts
  FROM fx_packets WHERE protocol = 'TCP' AND flag_bits & 18 = 2 GROUP BY 1, 2)"""


@query("n11_connection_attempts", P, f"WITH {_ATTEMPTS} SELECT * FROM attempts")
def _(x: Inputs) -> DataFrame:
    return traffic.connection_attempts(x.packets)


# ---- detectors -------------------------------------------------------------------

_COLUMNS = "severity, category, description, source_ip, destination_ip, evidence, ts"

_T1 = """SELECT 'high' AS severity, 'Port Scanning' AS category,
  'Host ' || dst_ip || ' received ' || attempts || ' connection attempts on port ' || dst_port AS description,
  CAST(NULL AS VARCHAR) AS source_ip, dst_ip AS destination_ip,
  'Connection attempts to port ' || dst_port AS evidence, last_ts AS ts FROM attempts WHERE attempts > 50"""
_T3 = """SELECT 'critical' AS severity, 'SYN Flood' AS category,
  'Potential SYN flood detected with ' || sum(attempts) || ' SYN packets' AS description,
  CAST(NULL AS VARCHAR) AS source_ip, CAST(NULL AS VARCHAR) AS destination_ip,
  'High volume of SYN packets without corresponding ACKs' AS evidence, max(last_ts) AS ts
FROM attempts HAVING sum(attempts) > 100"""
_T4 = """SELECT 'high' AS severity, 'Data Exfiltration' AS category,
  'Sensitive keyword "' || k || '" found in traffic' AS description, src_ip AS source_ip, dst_ip AS destination_ip,
  'Payload contains: ' || k AS evidence, ts
FROM (SELECT *, CASE packet_id % 200 WHEN 0 THEN 'password' WHEN 1 THEN 'key=' END AS k FROM fx_packets) WHERE k IS NOT NULL"""
_T6 = """SELECT 'medium' AS severity, 'DNS Tunneling' AS category,
  'Unusually long DNS query: ' || length(dns_query) || ' characters' AS description, src_ip AS source_ip,
  CAST(NULL AS VARCHAR) AS destination_ip, 'Query: ' || left(dns_query, 50) || '...' AS evidence, ts
FROM fx_packets WHERE length(dns_query) > 50"""
_ALERTS = f"{_ATTEMPTS}, alerts AS ({_T1} UNION ALL {_T3} UNION ALL {_T4} UNION ALL {_T6})"


def flat(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn("evidence", F.array_join("evidence", "; "))


@query("t1_service_hammering", P, f"WITH {_ATTEMPTS} {_T1}")
def _(x: Inputs) -> DataFrame:
    return flat(detect.service_hammering(x.packets))


@query(
    "t2_port_scan",
    P,
    """SELECT src_ip, dst_ip, count(DISTINCT dst_port) AS ports FROM fx_packets GROUP BY 1, 2
HAVING count(DISTINCT dst_port) >= 100""",
)
def _(x: Inputs) -> DataFrame:
    return detect.port_scan(x.packets)


@query(
    "t2_port_scan_sketched",
    P,
    """SELECT src_ip, dst_ip, count(DISTINCT dst_port) AS exact, true AS close FROM fx_packets GROUP BY 1, 2
HAVING count(DISTINCT dst_port) >= 20""",
)
def _(x: Inputs) -> DataFrame:
    """Pairs from stored sketches of each hour's ports, with exact counts of the suspects only."""
    hours = sketches.hourly_sketches(x.packets, ["src_ip", "dst_ip"], "dst_port")
    suspects = sketches.scan_suspects(hours, 20)
    pairs = x.packets.join(suspects.select("src_ip", "dst_ip"), ["src_ip", "dst_ip"], "left_semi")
    exact = pairs.groupBy("src_ip", "dst_ip").agg(F.count_distinct("dst_port").alias("exact")).filter("exact >= 20")
    close = F.abs(F.col("ports") - F.col("exact")) <= F.greatest(4 * sketches.error_bound() * F.col("exact"), F.lit(1.0))
    return exact.join(suspects, ["src_ip", "dst_ip"]).select("src_ip", "dst_ip", "exact", close.alias("close"))


@query("t3_syn_flood", P, f"WITH {_ATTEMPTS} {_T3}")
def _(x: Inputs) -> DataFrame:
    return flat(detect.syn_flood(x.packets))


@query(
    "t3_syn_flood_by_destination",
    P,
    f"""WITH {_ATTEMPTS} SELECT 'critical' AS severity, dst_ip AS destination_ip, max(last_ts) AS ts,
  'Potential SYN flood detected with ' || sum(attempts) || ' SYN packets' AS description
FROM attempts GROUP BY dst_ip HAVING sum(attempts) > 100""",
)
def _(x: Inputs) -> DataFrame:
    return detect.syn_flood(x.packets, by="dst_ip").select(
        "severity", "destination_ip", "ts", "description"
    )


@query("t4_sensitive_keyword", P, _T4)
def _(x: Inputs) -> DataFrame:
    return flat(detect.sensitive_keyword(x.packets))


@query(
    "t5_keyword_volume",
    P,
    """SELECT src_ip, dst_ip, count(*) AS hits FROM fx_packets WHERE packet_id % 200 IN (0, 1, 2)
GROUP BY 1, 2 HAVING count(*) >= 5""",
)
def _(x: Inputs) -> DataFrame:
    return detect.keyword_volume(x.packets)


@query("t6_dns_tunnel", P, _T6)
def _(x: Inputs) -> DataFrame:
    return flat(detect.dns_tunnel(x.packets))


_GAPS = """gaps AS (SELECT src_ip, dst_ip, epoch_us(ts) / 1e6
  - lag(epoch_us(ts) / 1e6) OVER (PARTITION BY src_ip, dst_ip ORDER BY ts) AS gap FROM {source}),
stats AS (SELECT src_ip, dst_ip, count(gap) AS gaps, avg(gap) AS mean_gap, stddev_pop(gap) AS sd_gap
  FROM gaps GROUP BY 1, 2)"""


def _rounded(stats: DataFrame) -> DataFrame:
    return stats.select(
        "src_ip",
        "dst_ip",
        "gaps",
        F.round("mean_gap", 4).alias("mean_gap"),
        F.round("sd_gap", 4).alias("sd_gap"),
    )


@query(
    "t8_beaconing",
    "fx_beacon",
    f"""WITH {_GAPS.format(source="fx_beacon")} SELECT src_ip, dst_ip, gaps, round(mean_gap, 4) AS mean_gap,
  round(sd_gap, 4) AS sd_gap FROM stats WHERE gaps >= 10 AND sd_gap <= mean_gap * 0.1""",
)
def _(x: Inputs) -> DataFrame:
    return _rounded(detect.beaconing(x.beacon))


@query(
    "t8_gap_statistics",
    P,
    f"""WITH {_GAPS.format(source="fx_packets")} SELECT src_ip, dst_ip, gaps, round(mean_gap, 4) AS mean_gap,
  round(sd_gap, 4) AS sd_gap FROM stats WHERE gaps > 0""",
)
def gap_statistics(x: Inputs) -> DataFrame:
    return _rounded(detect.gap_statistics(x.packets, ["src_ip", "dst_ip"]))


_PERIODS = """seconds AS (SELECT DISTINCT src_ip, dst_ip, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM {source}),
gaps AS (SELECT src_ip, dst_ip, s - lag(s) OVER (PARTITION BY src_ip, dst_ip, s // 86400 ORDER BY s) AS gap FROM seconds),
counted AS (SELECT src_ip, dst_ip, gap, count(*) AS n FROM gaps WHERE gap IS NOT NULL GROUP BY 1, 2, 3),
binned AS (SELECT src_ip, dst_ip, half, floor(ln(gap) / ln(1.1::DOUBLE) + half / 2.0::DOUBLE) AS bin, sum(n) AS n,
  CAST(sum(n * gap) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS p
  FROM counted, (VALUES (0), (1)) h(half) GROUP BY 1, 2, 3, 4),
ranked AS (SELECT *, row_number() OVER (PARTITION BY src_ip, dst_ip ORDER BY n DESC, p, half) AS r FROM binned),
proposed AS (SELECT DISTINCT src_ip, dst_ip, p * (1 + k / 128.0::DOUBLE) AS p FROM ranked, range(-2, 3) t(k) WHERE r <= 4),
turned AS (SELECT src_ip, dst_ip, p, s, s / p AS turns FROM seconds JOIN proposed USING (src_ip, dst_ip)),
folds AS (SELECT src_ip, dst_ip, p, floor(turns / 32) AS fold, sum(cos(2 * pi() * (turns - floor(turns)))) AS x,
  sum(sin(2 * pi() * (turns - floor(turns)))) AS y, CAST(count(*) AS DOUBLE) AS n, max(s) - min(s) AS long FROM turned GROUP BY 1, 2, 3, 4),
periods AS (SELECT src_ip, dst_ip, p, CAST(sum(n) AS BIGINT) AS beats, sum(n) / sum(1 + long / p) AS share,
  CASE WHEN sum(n * (n - 1)) > 0 THEN sum(x * x + y * y - n) / sum(n * (n - 1)) ELSE 0 END AS coherence FROM folds GROUP BY 1, 2, 3),
best AS (SELECT *, row_number() OVER (PARTITION BY src_ip, dst_ip ORDER BY round(coherence * least(share, 1), 9) DESC, p) AS r FROM periods)"""


def _period_columns(stats: DataFrame) -> DataFrame:
    return stats.select("src_ip", "dst_ip", "beats", *[F.round(c, 4).alias(c) for c in ("period", "share", "coherence")])


@query(
    "t8_missed_beats",
    "fx_beats",
    f"""WITH {_PERIODS.format(source="fx_beats")} SELECT src_ip, dst_ip, beats, round(p, 4) AS period,
  round(share, 4) AS share, round(coherence, 4) AS coherence FROM best
WHERE r = 1 AND beats >= 10 AND share >= 0.5 AND coherence >= 0.5""",
)
def _(x: Inputs) -> DataFrame:
    return _period_columns(detect.loose_beaconing(x.beats))


@query(
    "t8_periods",
    P,
    f"""WITH {_PERIODS.format(source="fx_packets")} SELECT src_ip, dst_ip, beats, round(p, 4) AS period,
  round(share, 4) AS share, round(coherence, 4) AS coherence FROM best WHERE r = 1""",
)
def _(x: Inputs) -> DataFrame:
    return _period_columns(detect.period_statistics(x.packets, ["src_ip", "dst_ip"]))


@query(
    "t9_lateral_movement",
    P,
    """SELECT src_ip, dst_ip, count(*) AS packets, min(ts) AS first_seen, max(ts) AS last_seen FROM fx_packets
WHERE protocol = 'TCP' AND dst_port = 445 AND regexp_matches(src_ip, '^(10|172[.]16)[.]') GROUP BY 1, 2""",
)
def _(x: Inputs) -> DataFrame:
    return detect.lateral_movement(x.packets)


@query(
    "t10_bad_domain",
    P,
    """WITH named AS (SELECT *, rtrim(coalesce(http_host, dns_query), '.') AS domain FROM fx_packets),
bad AS (SELECT DISTINCT domain FROM named WHERE domain LIKE '%.xyz' OR domain = 'h3.example.com')
SELECT domain, src_ip, count(*) AS packets, min(ts) AS first_seen, max(ts) AS last_seen FROM named
WHERE domain IN (SELECT domain FROM bad) GROUP BY 1, 2""",
)
def _(x: Inputs) -> DataFrame:
    name = F.regexp_replace(F.coalesce("http_host", "dns_query"), r"\.+$", "")
    feed = x.packets.select(name.alias("domain")).filter(
        "domain like '%.xyz' or domain = 'h3.example.com'"
    )
    return detect.bad_domain(x.packets, feed)


@query(
    "t10_bad_subdomain",
    P,
    """WITH named AS (SELECT *, rtrim(coalesce(http_host, dns_query), '.') AS domain FROM fx_packets),
bad AS (SELECT DISTINCT split_part(domain, '.', -2) || '.' || split_part(domain, '.', -1) AS listed FROM named
  WHERE domain LIKE '%.xyz' UNION SELECT DISTINCT domain FROM named WHERE domain = 'h3.example.com')
SELECT domain, listed, src_ip, count(*) AS packets, min(ts) AS first_seen, max(ts) AS last_seen
FROM named JOIN bad ON domain = listed OR domain LIKE '%.' || listed GROUP BY 1, 2, 3""",
)
def _(x: Inputs) -> DataFrame:
    name = F.regexp_replace(F.coalesce("http_host", "dns_query"), r"\.+$", "")
    names = x.packets.select(name.alias("domain"))
    parents = names.filter("domain like '%.xyz'").select(F.substring_index("domain", ".", -2).alias("domain"))
    return detect.bad_subdomain(x.packets, parents.unionByName(names.filter("domain = 'h3.example.com'")))


@query(
    "t12_subdomain_stats",
    P,
    """WITH named AS (SELECT rtrim(dns_query, '.') AS name FROM fx_packets WHERE dns_query IS NOT NULL),
parts AS (SELECT string_split(name, '.') AS p FROM named),
subs AS (SELECT p[-2] || '.' || p[-1] AS parent, array_to_string(p[1:-3], '.') AS sub FROM parts WHERE len(p) > 2),
chars AS (SELECT parent, unnest(string_split(sub, '')) AS ch FROM subs),
counted AS (SELECT parent, ch, count(*) AS n FROM chars GROUP BY 1, 2),
shares AS (SELECT parent, n * 1.0 / sum(n) OVER (PARTITION BY parent) AS p FROM counted),
entropies AS (SELECT parent, -sum(p * log2(p)) AS entropy FROM shares GROUP BY 1)
SELECT parent, count(*) AS queries, count(DISTINCT sub) AS subdomains, round(avg(length(sub)), 4) AS mean_length,
  round(max(entropy), 4) AS entropy FROM subs JOIN entropies USING (parent) GROUP BY 1""",
)
def _(x: Inputs) -> DataFrame:
    stats = detect.subdomain_stats(x.packets)
    return stats.withColumns(
        {"mean_length": F.round("mean_length", 4), "entropy": F.round("entropy", 4)}
    )


@query("t13_all_alerts", P, f"WITH {_ALERTS} SELECT {_COLUMNS} FROM alerts")
def _(x: Inputs) -> DataFrame:
    return flat(detect.all_alerts(x.packets))


# ---- indicators ------------------------------------------------------------------


@query(
    "n19_private_sources",
    P,
    """SELECT DISTINCT src_ip, split_part(src_ip, '.', 1) IN ('10', '172') AS private FROM fx_packets""",
)
def _(x: Inputs) -> DataFrame:
    return traffic.by_source(x.packets).select("src_ip", is_private(F.col("src_ip")).alias("private"))


_PUBLIC = "split_part(src_ip, '.', 1) NOT IN ('10', '172')"


@query(
    "n20_suspicious_ips",
    P,
    f"""SELECT src_ip, count(*) AS n, min(ts) AS first_seen, max(ts) AS last_seen FROM fx_packets
WHERE {_PUBLIC} GROUP BY 1 HAVING count(*) > 1000""",
)
def _(x: Inputs) -> DataFrame:
    return ioc.suspicious_ips(x.packets)


@query(
    "n21_suspicious_domains",
    P,
    """SELECT packet_id, rtrim(dns_query, '.') AS domain FROM fx_packets
WHERE dns_query IS NOT NULL AND packet_id % 7 IN (0, 1, 2)""",
)
def _(x: Inputs) -> DataFrame:
    domain = F.regexp_replace("dns_query", r"\.+$", "")
    return x.packets.select("packet_id", domain.alias("domain")).filter(
        suspicious_domain(F.col("domain"))
    )


# Hosts of pages, some under a risky top-level domain or with a label of many digits.
_PAGE_HOST = """CASE page_id % 5 WHEN 0 THEN regexp_replace(h, '[.][a-z]+$', '.Top')
  WHEN 1 THEN 'x' || CAST(1000000000000000 + page_id * 7919 AS {STR}) || 'a.' || h ELSE h END"""


@query(
    "n21_suspicious_page_hosts",
    sql=rf"""
WITH hosts AS (SELECT page_id, {_PAGE_HOST.replace("{STR}", "VARCHAR")} AS domain
  FROM (SELECT page_id, regexp_extract(url, '://([^/?#:]+)', 1) AS h FROM pages)),
labels AS (SELECT page_id, unnest(string_split(domain, '.')) AS label FROM hosts),
odd AS (SELECT DISTINCT page_id FROM labels WHERE length(label) > 15 AND regexp_matches(replace(label, ' ', ''), '^[\p{{L}}\p{{N}}]+$')
  AND 2 * length(regexp_replace(label, '[^0-9]', '', 'g')) > length(label))
SELECT page_id, domain FROM hosts WHERE length(domain) > 50
  OR regexp_matches(lower(domain), '\.(xyz|top|tk|ml|ga|cf|gq)$') OR page_id IN (SELECT page_id FROM odd)""",
)
def _(x: Inputs) -> DataFrame:
    host = F.regexp_extract("url", "://([^/?#:]+)", 1)
    return (
        x.table("pages")
        .select("page_id", host.alias("h"))
        .select("page_id", F.expr(_PAGE_HOST.replace("{STR}", "STRING")).alias("domain"))
        .filter(suspicious_domain(F.col("domain")))
    )


@query(
    "k4_flag_texts",
    P,
    f"SELECT packet_id, {FLAGS} AS flags FROM (SELECT packet_id, packet_id % 64 AS flag_bits FROM fx_packets)",
)
def _(x: Inputs) -> DataFrame:
    bits = (F.col("packet_id") % 64).cast("int")
    return x.packets.select("packet_id", flag_text(bits).alias("flags"))


@query(
    "t4_far_keywords",
    P,
    """SELECT src_ip AS source_ip, dst_ip AS destination_ip, count(*) AS alerts FROM fx_packets
WHERE packet_id % 200 < 2 GROUP BY 1, 2""",
)
def _(x: Inputs) -> DataFrame:
    far = F.concat(F.repeat(F.lit("x"), F.lit(150)), "payload_text").cast("binary")
    alerts = detect.sensitive_keyword(x.packets.withColumn("payload", far))
    return alerts.groupBy("source_ip", "destination_ip").agg(F.count("*").alias("alerts"))


_RULE = """CASE packet_id % 10 WHEN 0 THEN 'path_traversal' WHEN 1 THEN 'sql_injection'
  WHEN 2 THEN 'command_execution' WHEN 3 THEN 'shellshock' END"""


@query(
    "n22_suspicious_uris",
    P,
    f"SELECT packet_id, http_uri, {_RULE} AS rule FROM fx_packets WHERE http_method IS NOT NULL AND packet_id % 10 < 4",
)
def _(x: Inputs) -> DataFrame:
    rows = x.packets.filter("http_method is not null").select(
        "packet_id", "http_uri", uri_rule(F.col("http_uri")).alias("rule")
    )
    return rows.filter("rule is not null")


@query(
    "n22_suspicious_log_paths",
    "web",
    """SELECT event_id, ip_address, CASE event_id % 50 WHEN 0 THEN 'path_traversal' ELSE 'sql_injection' END AS rule
FROM web WHERE event_id % 50 IN (0, 2)""",
)
def _(x: Inputs) -> DataFrame:
    rows = x.web.select("event_id", "ip_address", uri_rule(F.col("request_path")).alias("rule"))
    return rows.filter("rule is not null")


_SCORES = """scores AS (SELECT ip, sum(CASE severity WHEN 'critical' THEN 50 WHEN 'high' THEN 30 WHEN 'medium' THEN 15 ELSE 0 END) AS s
  FROM (SELECT severity, source_ip AS ip FROM alerts WHERE source_ip IS NOT NULL
    UNION ALL SELECT severity, destination_ip FROM alerts WHERE destination_ip IS NOT NULL
      AND destination_ip IS DISTINCT FROM source_ip) GROUP BY 1),
confidence AS (SELECT src_ip, n, first_seen, last_seen, CAST(least(100, CASE WHEN n > 1000 THEN 30 WHEN n > 100 THEN 20 ELSE 0 END
  + coalesce(s, 0)) AS INTEGER) AS confidence
  FROM (SELECT src_ip, count(*) AS n, min(ts) AS first_seen, max(ts) AS last_seen FROM fx_packets GROUP BY 1)
  LEFT JOIN scores ON src_ip = ip)"""


@query("n23_ip_confidence", P, f"WITH {_ALERTS}, {_SCORES} SELECT src_ip, n, confidence FROM confidence")
def _(x: Inputs) -> DataFrame:
    return ioc.ip_confidence(x.packets, detect.all_alerts(x.packets))


_I1 = f"""SELECT 'ip' AS type, src_ip AS value, 'Source of ' || n || ' connections' AS context,
  first_seen, last_seen, confidence FROM confidence WHERE n > 1000 AND {_PUBLIC}"""
_I2 = """SELECT 'domain' AS type, rtrim(dns_query, '.') AS value, 'DNS query detected' AS context,
  ts AS first_seen, ts AS last_seen, 70 AS confidence FROM fx_packets WHERE dns_query IS NOT NULL AND packet_id % 7 IN (0, 1, 2)"""
_I3 = """SELECT 'url' AS type, coalesce('http://' || http_host || http_uri, http_uri) AS value,
  'HTTP ' || http_method || ' request' AS context, ts AS first_seen, ts AS last_seen, 60 AS confidence
FROM fx_packets WHERE http_method IS NOT NULL AND packet_id % 10 < 4"""
_IOCS = f"{_ALERTS}, {_SCORES}, iocs AS ({_I1} UNION ALL {_I2} UNION ALL {_I3})"
_MERGED = """SELECT type, value, context, min(first_seen) AS first_seen, max(last_seen) AS last_seen,
  max(confidence) AS confidence FROM ({}) GROUP BY 1, 2, 3"""


def iocs(x: Inputs, dedup: bool = False) -> DataFrame:
    return ioc.all_iocs(x.packets, detect.all_alerts(x.packets), dedup)


@query("i1_ip_iocs", P, f"WITH {_ALERTS}, {_SCORES} {_I1}")
def _(x: Inputs) -> DataFrame:
    return ioc.ip_iocs(x.packets, detect.all_alerts(x.packets))


@query("i2_domain_iocs", P, _I2)
def _(x: Inputs) -> DataFrame:
    return ioc.domain_iocs(x.packets)


@query("i2_domain_iocs_dedup", P, _MERGED.format(_I2))
def _(x: Inputs) -> DataFrame:
    return ioc.domain_iocs(x.packets, dedup=True)


@query("i3_url_iocs", P, _I3)
def _(x: Inputs) -> DataFrame:
    return ioc.url_iocs(x.packets)


@query("i3_url_iocs_dedup", P, _MERGED.format(_I3))
def _(x: Inputs) -> DataFrame:
    return ioc.url_iocs(x.packets, dedup=True)


@query(
    "i4_email_iocs",
    P,
    """SELECT 'email' AS type, 'u1@evil.example.com' AS value, 'Address in traffic' AS context,
  ts AS first_seen, ts AS last_seen, 0 AS confidence FROM fx_packets WHERE packet_id % 200 = 3""",
)
def _(x: Inputs) -> DataFrame:
    return ioc.email_iocs(x.packets, "payload_text")


@query(
    "i4_email_iocs_documents",
    sql=r"""
SELECT 'email' AS type, value, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text,
  '[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}')) AS value FROM documents) GROUP BY 1, 2""",
)
def _(x: Inputs) -> DataFrame:
    found = ioc.email_iocs(x.table("documents"), "text")
    return found.groupBy("type", "value").agg(F.count("*").alias("n"))


@query(
    "i5_hash_iocs",
    P,
    """SELECT 'hash' AS type, '0cc175b9c0f1b6a831c399e269772661' AS value, 'md5 token' AS context,
  ts AS first_seen, ts AS last_seen, 0 AS confidence FROM fx_packets WHERE packet_id % 200 = 4""",
)
def _(x: Inputs) -> DataFrame:
    return ioc.hash_iocs(x.packets, "payload_text")


@query("i6_all_iocs", P, f"WITH {_IOCS} SELECT * FROM iocs")
def _(x: Inputs) -> DataFrame:
    return iocs(x)


_TOKENS = """SELECT 'email' AS type, 'u1@evil.example.com' AS value, 'Address in traffic' AS context,
  ts AS first_seen, ts AS last_seen, 0 AS confidence FROM fx_packets WHERE packet_id % 200 = 3
UNION ALL SELECT 'hash', '0cc175b9c0f1b6a831c399e269772661', 'md5 token', ts, ts, 0 FROM fx_packets WHERE packet_id % 200 = 4"""


@query("i6_all_iocs_with_text", P, f"WITH {_IOCS} SELECT * FROM iocs UNION ALL {_TOKENS}")
def _(x: Inputs) -> DataFrame:
    return ioc.all_iocs(x.packets, detect.all_alerts(x.packets), text="payload_text")


@query("i7_blocking_iocs", P, f"WITH {_IOCS} SELECT * FROM iocs WHERE confidence > 70")
def _(x: Inputs) -> DataFrame:
    return ioc.above(iocs(x))


# ---- report tables ---------------------------------------------------------------


@query(
    "n7_capture_overview",
    P,
    f"""WITH {_IOCS} SELECT count(*) AS total_packets, CAST(sum(length) AS BIGINT) AS total_bytes,
  count(DISTINCT src_ip) AS unique_sources, count(DISTINCT dst_ip) AS unique_destinations,
  (SELECT count(*) FROM alerts) AS alerts, (SELECT count(*) FROM iocs) AS iocs FROM fx_packets""",
)
def _(x: Inputs) -> DataFrame:
    alerts = detect.all_alerts(x.packets)
    return report.capture_overview(x.packets, alerts, ioc.all_iocs(x.packets, alerts))


@query(
    "r1_severity_counts",
    P,
    f"""WITH {_ALERTS} SELECT r AS rank, s AS severity, (SELECT count(*) FROM alerts WHERE severity = s) AS n
FROM (VALUES (0, 'critical'), (1, 'high'), (2, 'medium'), (3, 'low')) v(r, s)""",
)
def _(x: Inputs) -> DataFrame:
    return report.severity_counts(detect.all_alerts(x.packets))


@query(
    "r2_timeline",
    P,
    f"""WITH {_ALERTS} SELECT ts, severity, category, left(description, 60) AS description FROM alerts
ORDER BY alerts.ts, category, alerts.description, source_ip, destination_ip, evidence LIMIT 20""",
)
def _(x: Inputs) -> DataFrame:
    return report.timeline(detect.all_alerts(x.packets))


@query(
    "r3_iocs_by_type",
    P,
    f"""WITH {_IOCS} SELECT type, CAST(r AS INTEGER) AS rank, left(value, 50) AS value, left(context, 40) AS context, confidence
FROM (SELECT *, row_number() OVER (PARTITION BY type ORDER BY confidence DESC, value, context, first_seen) AS r FROM iocs)
WHERE r <= 10""",
)
def _(x: Inputs) -> DataFrame:
    return report.iocs_by_type(iocs(x))


@query(
    "r4_http_sample",
    P,
    """SELECT ts, http_method, left(coalesce(http_host, ''), 25) AS host, left(http_uri, 30) AS uri, src_ip
FROM fx_packets WHERE http_method IS NOT NULL ORDER BY ts, packet_id LIMIT 15""",
)
def _(x: Inputs) -> DataFrame:
    return report.http_sample(x.packets)


@query(
    "r5_suspicious_dns",
    P,
    """SELECT ts, left(dns_query, 30) AS query, left(dns_response, 20) AS response, src_ip FROM fx_packets
WHERE dns_response IS NOT NULL AND length(dns_query) > 30 ORDER BY ts, packet_id LIMIT 10""",
)
def _(x: Inputs) -> DataFrame:
    return report.suspicious_dns(x.packets)


@query(
    "r6_findings",
    P,
    f"""WITH {_ALERTS} SELECT ts, upper(severity) AS severity, category, description, source_ip, destination_ip, evidence
FROM alerts ORDER BY ts, category, description, source_ip, destination_ip, evidence LIMIT 15""",
)
def _(x: Inputs) -> DataFrame:
    return report.findings(detect.all_alerts(x.packets))


@query(
    "r8_external_destinations",
    "fx_packets fx_bidi fx_abuse fx_vt",
    """WITH outside AS (SELECT dst_ip, count(*) AS packets FROM fx_bidi
  WHERE split_part(dst_ip, '.', 1) NOT IN ('10', '172', '192') GROUP BY 1)
SELECT o.dst_ip AS ip_address, packets, coalesce(country_name, 'Unknown') AS country,
  CASE WHEN coalesce(malicious, 0) > 0 THEN 'MALICIOUS' WHEN coalesce(abuse_confidence_score, 0) >= 50 THEN 'SUSPICIOUS'
    WHEN b.ip_address IS NULL AND v.ip_address IS NULL THEN 'UNKNOWN' ELSE 'CLEAN' END AS reputation
FROM outside o LEFT JOIN fx_abuse b ON o.dst_ip = b.ip_address LEFT JOIN fx_vt v ON o.dst_ip = v.ip_address""",
)
def _(x: Inputs) -> DataFrame:
    return report.external_destinations(x.bidi, x.abuse, x.vt)
