"""Sources and sinks: text, captures, feeds, reports, exports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suite.capture_data import CUT, FIRST_NUMBER, FRAGMENT_BYTES, fragments_of, frames_of, segments_of, write_captures
from suite.fixtures import YEAR, Inputs
from suite.registry import query
from suite.traffic_queries import _IOCS, P, iocs
from watchfold.functions import flag_text
from watchfold.operators import detect, intel, summary
from watchfold.operators.fragments import defragment
from watchfold.operators.ioc import above
from watchfold.operators.logs import parse_logs
from watchfold.operators import ioc
from watchfold.operators.carried_files import carried_files
from watchfold.operators.packets import decode, segments
from watchfold.operators.tcp_streams import gaps, reassemble, stream_keyword, stream_messages
from watchfold.session import scratch_dir
from watchfold.sources import sinks
from watchfold.sources.captures import MAX_RECORD, read_frames
from watchfold.sources.feeds import read_abuse, read_vt
from watchfold.sources.log_lines import read_log_lines

WHEN = datetime(2024, 2, 1, 12, 0, 0)

# ---- log files -------------------------------------------------------------------


@query(
    "s1_numbered_lines",
    sql="""SELECT count(*) AS lines, CAST(0 AS BIGINT) AS misnumbered, count(DISTINCT event_id) AS events FROM events""",
)
def _(x: Inputs) -> DataFrame:
    folder = scratch_dir(x.spark, "lines")
    lines = x.web_lines.select("event_id", F.concat_ws(" ", "event_id", "raw").alias("value"))
    ordered = lines.repartitionByRange(4, "event_id").sortWithinPartitions("event_id")
    ordered.select("value").write.text(folder)
    # Ids rise by one within a file, so id and line number differ by a constant.
    event = F.split_part("raw", F.lit(" "), F.lit(1)).cast("bigint")
    read = read_log_lines(x.spark, folder).withColumn("event_id", event)
    files = read.groupBy("file_path").agg(
        F.count("*").alias("lines"),
        F.min("line_number").alias("first"),
        F.max("line_number").alias("last"),
        F.min(event - F.col("line_number")).alias("low"),
        F.max(event - F.col("line_number")).alias("high"),
        F.count_distinct("event_id").alias("events"),
    )
    right = (
        (F.col("first") == 1) & (F.col("last") == F.col("lines")) & (F.col("low") == F.col("high"))
    )
    return files.agg(
        F.sum("lines").alias("lines"),
        F.sum(F.when(right, 0).otherwise(F.col("lines"))).cast("bigint").alias("misnumbered"),
        F.sum("events").alias("events"),
    )


@query(
    "s1_parse_files",
    "web ssh",
    """SELECT format, ip_address, status_code, username, count(*) AS n FROM (
  SELECT format, ip_address, status_code, NULL AS username FROM web
  UNION ALL SELECT 'ssh_' || login_status, ip_address, NULL, username FROM ssh) GROUP BY 1, 2, 3, 4""",
)
def _(x: Inputs) -> DataFrame:
    folder = scratch_dir(x.spark, "logs")
    x.mixed_lines.select("kind", "raw").write.partitionBy("kind").text(folder)
    entries = parse_logs(read_log_lines(x.spark, [f"{folder}/kind=web", f"{folder}/kind=ssh"]), year=YEAR)
    return entries.groupBy("format", "ip_address", "status_code", "username").agg(
        F.count("*").alias("n")
    )


# ---- captures --------------------------------------------------------------------

# The recipe counts users past 255, an answer on the wire cannot.
_ANSWER = """'93.184.216.' || CAST(split_part(dns_response, '.', 4) AS INTEGER) % 256 AS dns_response"""


def _carried(packets: DataFrame) -> DataFrame:
    octet = F.split_part("dns_response", F.lit("."), F.lit(4)).cast("int") % 256
    answer = F.concat(F.lit("93.184.216."), octet.cast("string"))
    return packets.withColumn("dns_response", answer)


_DECODED = """SELECT {id} ts, src_ip, dst_ip, CASE WHEN protocol = 'ICMP' THEN 0 ELSE src_port END AS src_port,
  CASE WHEN protocol = 'ICMP' THEN 0 ELSE dst_port END AS dst_port, protocol,
  CASE WHEN protocol = 'TCP' THEN flag_bits END AS flag_bits,
  rtrim(dns_query, '.') AS dns_query, {answer}, http_method, split_part(http_uri, ' ', 1) AS http_uri, http_host,
  CASE WHEN http_method IS NOT NULL THEN 'made/' || packet_id END AS http_user_agent,
  CASE WHEN http_method IS NULL AND dns_query IS NULL THEN payload_text END AS payload_text,
  CASE WHEN http_method IS NULL AND dns_query IS NULL
    THEN length(payload_text) + CASE protocol WHEN 'TCP' THEN 54 ELSE 42 END END AS text_length
FROM fx_packets"""
_DECODED_COLUMNS = (
    "ts",
    "src_ip",
    "dst_ip",
    "src_port",
    "dst_port",
    "protocol",
    "flag_bits",
    "dns_query",
    "dns_response",
    "http_method",
    "http_uri",
    "http_host",
    "http_user_agent",
    "payload_text",
    "text_length",
)


def _flat(packets: DataFrame) -> DataFrame:
    plain = F.col("http_method").isNull() & F.col("dns_query").isNull()
    return packets.withColumns(
        {
            "payload_text": F.when(plain, F.col("payload").cast("string")),
            "text_length": F.when(plain, F.col("length").cast("bigint")),
        }
    )


def _frames(x: Inputs, version: int = 4) -> DataFrame:
    """Frames as a stored table, which is what a capture scan amounts to."""
    folder = scratch_dir(x.spark, "frames")
    frames = frames_of(_carried(x.packets), version)
    frames.write.parquet(folder)
    return x.spark.read.schema(frames.schema).parquet(folder)


@query("k1_decode_packets", P, _DECODED.format(id="packet_id,", answer=_ANSWER))
def decode_packets(x: Inputs) -> DataFrame:
    return _flat(decode(_frames(x))).select("packet_id", *_DECODED_COLUMNS)


@query("k2_ipv4", P, "SELECT packet_id, src_ip, dst_ip, protocol FROM fx_packets")
def _(x: Inputs) -> DataFrame:
    return decode(_frames(x)).select("packet_id", "src_ip", "dst_ip", "protocol")


def _ipv6_text(column: str) -> str:
    """Groups are the octets in hexadecimal; a zero octet before the last joins the run."""
    octets = [f"CAST(split_part({column}, '.', {i}) AS INTEGER)" for i in range(1, 5)]
    groups = " || ':' || ".join(f"printf('%x', {o})" for o in octets)
    return f"'2001:db8::' || {groups} AS {column}"


@query(
    "k2_ipv6",
    P,
    f"SELECT packet_id, {_ipv6_text('src_ip')}, {_ipv6_text('dst_ip')}, protocol, "
    "CASE protocol WHEN 'ICMP' THEN 0 ELSE dst_port END AS dst_port FROM fx_packets",
)
def _(x: Inputs) -> DataFrame:
    return decode(_frames(x, 6)).select("packet_id", "src_ip", "dst_ip", "protocol", "dst_port")


_CUT = f"""packet_id % 2 = 0 AND (http_method IS NOT NULL OR dns_query IS NOT NULL
  OR (CASE protocol WHEN 'TCP' THEN 20 ELSE 8 END) + length(payload_text) > {FRAGMENT_BYTES})"""


@query(
    "k2_fragments",
    P,
    f"""WITH c AS (SELECT *, {_CUT} AS cut FROM fx_packets), w AS (SELECT *, cut AND packet_id % 10 = 0 AS hole FROM c)
SELECT packet_id * 100 AS packet_id, src_ip, dst_ip, protocol, CASE WHEN cut THEN NOT hole END AS whole,
  CASE WHEN protocol = 'ICMP' THEN 0 ELSE src_port END AS src_port,
  CASE WHEN protocol = 'ICMP' THEN 0 ELSE dst_port END AS dst_port,
  CASE WHEN protocol = 'TCP' THEN flag_bits END AS flag_bits,
  CASE WHEN NOT hole THEN rtrim(dns_query, '.') END AS dns_query,
  CASE WHEN NOT hole THEN split_part(http_uri, ' ', 1) END AS http_uri,
  CASE WHEN http_method IS NULL AND dns_query IS NULL AND NOT hole THEN payload_text END AS payload_text FROM w""",
)
def _(x: Inputs) -> DataFrame:
    packets = decode(defragment(fragments_of(_frames(x))))
    plain = F.col("http_method").isNull() & F.col("dns_query").isNull()
    return packets.withColumn("payload_text", F.when(plain, F.col("payload").cast("string"))).select(
        "packet_id", "src_ip", "dst_ip", "protocol", "whole", "src_port", "dst_port", "flag_bits", "dns_query",
        "http_uri", "payload_text",
    )


@query(
    "k2_later_fragments",
    P,
    """SELECT protocol, count(*) AS packets, CAST(0 AS BIGINT) AS invented FROM fx_packets
WHERE packet_id % 2 = 0 GROUP BY 1""",
)
def _(x: Inputs) -> DataFrame:
    """Fragments as they are: only a datagram's first one has ports."""
    packet = F.floor(F.col("packet_id") / 100)
    later = F.col("packet_id") % 100 > 0
    ports = (F.col("src_port") != 0) | (F.col("dst_port") != 0)
    named = F.col("flag_bits").isNotNull() | F.col("dns_query").isNotNull() | F.col("http_method").isNotNull()
    packets = decode(fragments_of(_frames(x))).filter(packet % 2 == 0)
    return packets.groupBy("protocol").agg(
        F.count_distinct(packet).alias("packets"),
        F.sum(F.when(later & (ports | named), 1).otherwise(0)).cast("bigint").alias("invented"),
    )


@query(
    "k3_tcp",
    P,
    """SELECT packet_id, src_port, dst_port, flag_bits,
  CASE WHEN http_method IS NULL THEN payload_text END AS payload_text FROM fx_packets WHERE protocol = 'TCP'""",
)
def _(x: Inputs) -> DataFrame:
    text = F.when(F.col("http_method").isNull(), F.col("payload").cast("string"))
    return (
        decode(_frames(x), transports=("TCP",))
        .withColumn("payload_text", text)
        .select("packet_id", "src_port", "dst_port", "flag_bits", "payload_text")
    )


@query(
    "k5_udp",
    P,
    "SELECT packet_id, src_port, dst_port, CAST(NULL AS INTEGER) AS flag_bits FROM fx_packets WHERE protocol = 'UDP'",
)
def _(x: Inputs) -> DataFrame:
    return decode(_frames(x), transports=("UDP",)).select(
        "packet_id", "src_port", "dst_port", "flag_bits"
    )


@query(
    "k6_http",
    P,
    """SELECT packet_id, http_method, split_part(http_uri, ' ', 1) AS http_uri, http_host,
  'made/' || packet_id AS http_user_agent FROM fx_packets WHERE http_method IS NOT NULL""",
)
def _(x: Inputs) -> DataFrame:
    return decode(_frames(x)).filter("http_method is not null").select(
        "packet_id", "http_method", "http_uri", "http_host", "http_user_agent"
    )


_STREAM = "PARTITION BY src_ip, src_port, dst_ip, dst_port ORDER BY ts, packet_id"
_BYTES = f"""b AS (SELECT *, CASE WHEN http_method IS NULL THEN payload_text ELSE http_method || ' ' || http_uri
  || ' HTTP/1.1' || chr(13) || chr(10) || 'Accept: */*' || chr(13) || chr(10)
  || coalesce('Host: ' || http_host || chr(13) || chr(10), '') || 'USER-AGENT:  made/' || packet_id || '1234' END AS data
  FROM fx_packets WHERE protocol = 'TCP')"""


def _streams(x: Inputs) -> DataFrame:
    folder = scratch_dir(x.spark, "segments")
    frames = segments_of(x.packets)
    frames.write.parquet(folder)
    return reassemble(segments(x.spark.read.schema(frames.schema).parquet(folder)))


@query(
    "k6_http_over_segments",
    P,
    f"""WITH m AS (SELECT *, packet_id % 10 = 3 AS lost, http_method || ' ' || http_uri AS line FROM fx_packets
  WHERE http_method IS NOT NULL)
SELECT packet_id * 10 AS packet_id, ts + CASE WHEN packet_id % 4 = 0 THEN INTERVAL 2 MICROSECOND ELSE INTERVAL 0 SECOND END AS ts,
  src_ip, dst_ip, src_port, dst_port, http_method,
  split_part(CASE WHEN lost THEN left(line, {CUT}) ELSE line END, ' ', 2) AS http_uri,
  CASE WHEN NOT lost THEN http_host END AS http_host,
  CASE WHEN NOT lost THEN 'made/' || packet_id END AS http_user_agent FROM m""",
)
def _(x: Inputs) -> DataFrame:
    """Messages whose headers lie in two segments, some lost, repeated or out of order."""
    return stream_messages(_streams(x)).filter("http_method is not null").select(
        "packet_id", "ts", "src_ip", "dst_ip", "src_port", "dst_port", "http_method", "http_uri", "http_host",
        "http_user_agent",
    )


@query(
    "k3_stream_gaps",
    P,
    f"""WITH {_BYTES}, placed AS (SELECT *, length(data) AS size, lead(ts) OVER w AS next_ts,
  coalesce(sum(length(data)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM b WINDOW w AS ({_STREAM}))
SELECT src_ip, src_port, dst_ip, dst_port, CAST({FIRST_NUMBER} AS BIGINT) AS stream,
  CAST(before + {CUT} AS BIGINT) AS place, CAST(size - {CUT} AS BIGINT) AS missing
FROM placed WHERE packet_id % 10 = 3 AND size > {CUT} AND next_ts IS NOT NULL""",
)
def _(x: Inputs) -> DataFrame:
    return gaps(_streams(x)).select("src_ip", "src_port", "dst_ip", "dst_port", "stream", "place", "missing")


@query(
    "t4_keyword_over_segments",
    P,
    """SELECT DISTINCT src_ip AS source_ip, dst_ip AS destination_ip, 'Payload contains: password' AS evidence
FROM fx_packets WHERE protocol = 'TCP' AND http_method IS NULL AND packet_id % 200 = 0""",
)
def _(x: Inputs) -> DataFrame:
    """The keyword's first letter ends one segment, the others begin the next."""
    found = stream_keyword(_streams(x)).select("source_ip", "destination_ip", F.col("evidence")[0].alias("evidence"))
    return found.filter("evidence like '%password'").distinct()


@query(
    "t5_keyword_volume_over_segments",
    P,
    """SELECT src_ip, dst_ip FROM fx_packets WHERE protocol = 'TCP' AND http_method IS NULL
  AND packet_id % 200 IN (0, 1, 2) GROUP BY 1, 2""",
)
def _(x: Inputs) -> DataFrame:
    return detect.keyword_volume(_streams(x), n=1).select("src_ip", "dst_ip")


# Responses with a body each, of known length or in two chunks.
_BODY = """repeat('event ' || event_id || ' ' || event_type || ';', CAST(1 + event_id % 40 AS INT))"""
_FILES = f"""b AS (SELECT *, {_BODY} AS body, event_id % 2 = 0 AS sized FROM events),
r AS (SELECT *, CAST(length(body) AS INT) AS size, CAST(length(body) / 3 AS INT) AS part FROM b),
m AS (SELECT *, CASE WHEN sized THEN 79 - 2 + length(CAST(size AS VARCHAR)) + size
  ELSE 87 + length(printf('%x', part)) + length(printf('%x', size - part)) + size + 13 END AS total FROM r),
f AS (SELECT *, NOT (event_id % 13 = 0 AND total > 100) AS ok FROM m)"""


def _responses(x: Inputs) -> DataFrame:
    """One connection per event, its response in segments of 100 bytes, some lost or sent again."""
    body = F.expr(_BODY)
    rows = x.table("events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), body.alias("body"))
    size = F.length("body")
    part = F.round(size / 3).cast("int")
    first, second = F.expr("left(body, cast(round(length(body) / 3) as int))"), F.expr("substring(body, cast(round(length(body) / 3) as int) + 1)")
    head = F.lit("HTTP/1.1 200 OK\r\nContent-Type: application/octet-stream\r\n")
    sized = F.concat(head, F.lit("Content-Length: "), size.cast("string"), F.lit("\r\n\r\n"), "body")
    crlf = F.lit("\r\n")
    chunked = F.concat(
        head, F.lit("Transfer-Encoding: chunked\r\n\r\n"), F.lower(F.hex(part)), crlf, first, crlf,
        F.lower(F.hex(size - part)), crlf, second, F.lit("\r\n0\r\n\r\n"),
    )
    rows = rows.withColumn("data", F.when(F.col("event_id") % 2 == 0, sized).otherwise(chunked))
    count = F.ceil(F.length("data") / 100).cast("int")
    rows = rows.withColumn("k", F.explode(F.flatten(F.array(F.sequence(F.lit(0), count - 1), F.array(F.lit(0))))))
    rows = rows.filter(~((F.col("event_id") % 13 == 0) & (F.col("k") == 1)))
    table = rows.select(
        F.concat(F.lit("c"), F.col("event_id").cast("string")).alias("capture"),
        (F.col("event_id") * 100 + F.col("k")).alias("packet_id"),
        "ts",
        F.lit("203.0.113.7").alias("src_ip"),
        F.lit("10.0.5.1").alias("dst_ip"),
        F.lit(80).alias("src_port"),
        F.lit(1024).alias("dst_port"),
        F.lit("TCP").alias("protocol"),
        F.lit(24).alias("flag_bits"),
        (F.col("k") * 100 + 5000).cast("bigint").alias("sequence"),
        F.expr("substring(data, k * 100 + 1, 100)").cast("binary").alias("payload"),
    )
    folder = scratch_dir(x.spark, "responses")
    table.write.parquet(folder)
    # small blocks, so that bodies go over their borders
    return carried_files(reassemble(x.spark.read.schema(table.schema).parquet(folder), 256, 128), 128)


@query(
    "i5_carried_files",
    sql=f"""WITH {_FILES} SELECT event_id, CASE WHEN sized THEN 'length' ELSE 'chunked' END AS framing, ok AS complete,
  CASE WHEN ok THEN size END AS body_bytes, CASE WHEN ok THEN md5(body) END AS md5,
  CASE WHEN ok THEN sha256(body) END AS sha256 FROM f""",
)
def _(x: Inputs) -> DataFrame:
    files = _responses(x).withColumn("event_id", F.expr("cast(substring(capture, 2) as bigint)"))
    size = F.when(F.col("complete"), F.col("body_bytes").cast("int")).alias("body_bytes")
    return files.select("event_id", "framing", "complete", size, "md5", "sha256")


@query(
    "i5_carried_file_hashes",
    sql=f"""WITH {_FILES} SELECT 'hash' AS type, md5(body) AS value, 'md5 of a carried file' AS context FROM f WHERE ok
UNION ALL SELECT 'hash', sha256(body), 'sha256 of a carried file' FROM f WHERE ok""",
)
def _(x: Inputs) -> DataFrame:
    return ioc.file_hash_iocs(_responses(x)).select("type", "value", "context")


@query(
    "k7_dns",
    P,
    f"""SELECT packet_id, rtrim(dns_query, '.') AS dns_query, {_ANSWER} FROM fx_packets
WHERE dns_query IS NOT NULL""",
)
def _(x: Inputs) -> DataFrame:
    return decode(_frames(x)).filter("dns_query is not null").select(
        "packet_id", "dns_query", "dns_response"
    )


@query(
    "k4_flag_names",
    P,
    """SELECT packet_id, CASE flag_bits WHEN 2 THEN 'SYN' WHEN 18 THEN 'SYN,SYN-ACK,ACK' WHEN 24 THEN 'ACK,PSH'
  WHEN 16 THEN 'ACK' END AS flags FROM fx_packets WHERE protocol = 'TCP'""",
)
def _(x: Inputs) -> DataFrame:
    tcp = decode(_frames(x)).filter("protocol = 'TCP'")
    return tcp.select("packet_id", flag_text(F.col("flag_bits")).alias("flags"))


@query(
    "k8_transports_only",
    P,
    """SELECT packet_id, protocol, http_method FROM fx_packets WHERE protocol IN ('TCP', 'UDP')""",
)
def _(x: Inputs) -> DataFrame:
    return decode(_frames(x), transports=("TCP", "UDP"), http_methods=("GET", "POST")).select(
        "packet_id", "protocol", "http_method"
    )


@query(
    "k9_payload_width",
    P,
    """SELECT packet_id, left(payload_text, 4) AS payload_text FROM fx_packets
WHERE http_method IS NULL AND dns_query IS NULL""",
)
def _(x: Inputs) -> DataFrame:
    packets = decode(_frames(x), payload_bytes=4)
    return packets.filter("http_method is null and dns_query is null").select(
        "packet_id", F.col("payload").cast("string").alias("payload_text")
    )


@query("s3_capture_files", P, _DECODED.format(id="", answer=_ANSWER))
def _(x: Inputs) -> DataFrame:
    folder = scratch_dir(x.spark, "captures")
    write_captures(frames_of(_carried(x.packets)), folder)
    return _flat(decode(read_frames(x.spark, folder))).select(*_DECODED_COLUMNS)


@query("s3_pcapng_files", P, _DECODED.format(id="", answer=_ANSWER))
def _(x: Inputs) -> DataFrame:
    """pcapng files of both byte orders and two clocks, read in ranges of the least size."""
    folder = scratch_dir(x.spark, "captures")
    write_captures(frames_of(_carried(x.packets)), folder, blocks=True)
    frames = read_frames(x.spark, folder, chunk_bytes=4 * MAX_RECORD)
    return _flat(decode(frames)).select(*_DECODED_COLUMNS)


# ---- reputation feeds ------------------------------------------------------------


@query(
    "s4_abuse_feed",
    "fx_abuse",
    """SELECT ip_address, abuse_confidence_score, country_code, country_name, is_whitelisted, total_reports,
  0 AS num_distinct_users, 0 AS n_categories FROM fx_abuse WHERE total_reports % 5 <> 0""",
)
def _(x: Inputs) -> DataFrame:
    data = F.struct(
        F.col("abuse_confidence_score").alias("abuseConfidenceScore"),
        F.col("country_code").alias("countryCode"),
        F.col("country_name").alias("countryName"),
        F.col("is_whitelisted").alias("isWhitelisted"),
        F.col("total_reports").alias("totalReports"),
    )
    # Some responses come without data, as for an address the service does not know.
    body = F.when(F.col("total_reports") % 5 == 0, '{"errors":[{"status":422}]}').otherwise(
        F.to_json(F.struct(data.alias("data")))
    )
    return read_abuse(x.spark, x.abuse.select("ip_address", body.alias("body"))).select(
        "ip_address",
        "abuse_confidence_score",
        "country_code",
        "country_name",
        "is_whitelisted",
        "total_reports",
        "num_distinct_users",
        F.size("categories").alias("n_categories"),
    )


@query(
    "s5_engine_feed",
    "fx_vt",
    """SELECT ip_address, harmless, malicious, suspicious, 0 AS undetected, malicious AS bad_votes, 0 AS reputation,
  '1705312800' AS last_analysis_date FROM fx_vt""",
)
def _(x: Inputs) -> DataFrame:
    stats = F.struct("harmless", "malicious", "suspicious")
    attributes = F.struct(
        stats.alias("last_analysis_stats"),
        F.create_map(F.lit("malicious"), F.col("malicious")).alias("total_votes"),
        F.lit(1705312800).alias("last_analysis_date"),
    )
    data = F.struct(F.col("ip_address").alias("id"), attributes.alias("attributes"))
    bodies = x.vt.select(F.to_json(F.struct(data.alias("data"))).alias("body"))
    return read_vt(x.spark, bodies).select(
        "ip_address",
        "harmless",
        "malicious",
        "suspicious",
        "undetected",
        F.col("total_votes")["malicious"].alias("bad_votes"),
        "reputation",
        "last_analysis_date",
    )


# ---- sinks -----------------------------------------------------------------------


def _report(x: Inputs) -> dict[str, str]:
    enriched = intel.enrich(x.web, x.abuse, x.vt)
    return sinks.write_report(
        x.web,
        enriched,
        summary.log_summary(x.web, enriched),
        scratch_dir(x.spark, "report"),
        "events",
        WHEN,
    )


@query(
    "s6_report_entries",
    "web",
    "SELECT event_id, ip_address, status_code, response_size, user_agent, request_path FROM web",
)
def _(x: Inputs) -> DataFrame:
    return x.spark.read.schema(x.web.schema).json(_report(x)["log_entries"]).select(
        "event_id", "ip_address", "status_code", "response_size", "user_agent", "request_path"
    )


@query(
    "s6_report_header",
    "web",
    """SELECT substr(md5('events2024-02-01T12:00:00'), 1, 12) AS analysis_id, '2024-02-01T12:00:00' AS generated_at,
  (SELECT count(*) FROM web) AS total_entries, (SELECT count(*) FROM web WHERE status_code = 401) AS refused""",
)
def _(x: Inputs) -> DataFrame:
    schema = """report_metadata struct<analysis_id: string, generated_at: string>,
      summary struct<total_entries: bigint, status_code_distribution: map<string, bigint>>"""
    return x.spark.read.schema(schema).json(_report(x)["report"]).select(
        "report_metadata.*",
        "summary.total_entries",
        F.col("summary.status_code_distribution")["401"].alias("refused"),
    )


@query(
    "s7_ioc_export",
    P,
    f"""WITH {_IOCS} SELECT type, value, context, confidence, count(*) AS n, (SELECT count(*) FROM iocs) AS ioc_count,
  '2024-02-01T12:00:00' AS exported_at FROM iocs GROUP BY 1, 2, 3, 4""",
)
def _(x: Inputs) -> DataFrame:
    rows = iocs(x)
    parts = sinks.write_iocs(rows, scratch_dir(x.spark, "iocs"), WHEN)
    # One header row: its two values become literals, no join.
    header = x.spark.read.schema("exported_at string, ioc_count bigint").json(parts["export"]).first()
    return (
        x.spark.read.schema(rows.schema)
        .json(parts["iocs"])
        .groupBy("type", "value", "context", "confidence")
        .agg(F.count("*").alias("n"))
        .withColumns(
            {"ioc_count": F.lit(header.ioc_count).cast("bigint"), "exported_at": F.lit(header.exported_at)}
        )
    )


@query(
    "s8_blocklist",
    P,
    f"WITH {_IOCS} SELECT DISTINCT value FROM iocs WHERE type = 'ip' AND confidence > 70",
)
def _(x: Inputs) -> DataFrame:
    folder = scratch_dir(x.spark, "blocklist")
    sinks.write_blocklist(above(iocs(x)), folder)
    return x.spark.read.text(folder)
