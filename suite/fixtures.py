"""Log lines, packets and feeds derived from the ``events`` table.

Each recipe is one SQL text for both engines: placeholders hide the differences.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchfold.operators.logs import parse_logs

YEAR = 2024

_SPARK = {
    "{STR}": "STRING",
    "{APACHE_TS}": "date_format(ts,'dd/MMM/yyyy:HH:mm:ss')",
    "{SSH_TS}": "date_format(ts,'MMM dd HH:mm:ss')",
    "{SEC_OPEN}": "CAST(timestamp_seconds(",
    "{SEC_CLOSE}": ") AS TIMESTAMP_NTZ)",
}
_DUCKDB = {
    "{STR}": "VARCHAR",
    "{APACHE_TS}": "strftime(ts,'%d/%b/%Y:%H:%M:%S')",
    "{SSH_TS}": "strftime(ts,'%b %d %H:%M:%S')",
    "{SEC_OPEN}": "make_timestamp(1000000 * (",
    "{SEC_CLOSE}": "))",
}

IP = """CASE user_id % 4 WHEN 0 THEN '10.0.5.' || CAST(user_id % 10 AS {STR})
  WHEN 1 THEN '203.0.113.7'
  WHEN 2 THEN '198.51.100.' || CAST(user_id % 3 AS {STR})
  ELSE '172.16.9.' || CAST(user_id % 6 AS {STR}) END"""

_REQUEST = """CASE event_id % 50 WHEN 0 THEN '/a/../../etc/passwd' WHEN 1 THEN '/q?id=1+union%20select'
    WHEN 2 THEN '/s?x=1/*c*/' ELSE '/p/' || CAST(event_id % 300 AS {STR}) END"""
_STATUS = """CASE event_type WHEN 'view' THEN '200' WHEN 'click' THEN '302' WHEN 'purchase' THEN '201'
    WHEN 'signup' THEN '401' ELSE '500' END"""

WEB = (
    "SELECT event_id, {IP} || ' - - [' || {APACHE_TS} || ' +0000] \"GET ' || "
    + _REQUEST
    + " || ' HTTP/1.1\" ' || "
    + _STATUS
    + """ || ' ' ||
  CASE WHEN event_id % 11 = 0 THEN '-' ELSE CAST(event_id % 5000 AS {STR}) END ||
  CASE WHEN event_id % 3 = 0 THEN ''
    ELSE ' "-" "agent/' || CAST(user_id % 9 AS {STR}) || '"' END AS raw
FROM events"""
)

# Two more tokens before the agent, and a named user.
UPSTREAM = (
    "SELECT event_id, {IP} || ' - u' || CAST(user_id AS {STR}) || ' [' || {APACHE_TS} || ' +0000] \"GET ' || "
    + _REQUEST
    + " || ' HTTP/1.1\" ' || "
    + _STATUS
    + """ || ' ' || CAST(event_id % 5000 AS {STR}) || ' 0.00' || CAST(event_id % 9 AS {STR})
  || ' 0.1 "agent/' || CAST(user_id % 9 AS {STR}) || '"' AS raw
FROM events"""
)

SSH = """SELECT event_id, {SSH_TS} || ' host1 sshd[' || CAST(1000 + event_id % 9000 AS {STR}) || ']: ' ||
  CASE WHEN event_type = 'signup' THEN 'Accepted publickey for u'
    WHEN event_id % 2 = 0 THEN 'Failed password for u'
    ELSE 'Failed password for invalid user u' END ||
  CAST(user_id AS {STR}) || ' from ' || {IP} || ' port 22 ssh2' AS raw
FROM events WHERE event_type IN ('signup', 'error')"""

PACKETS = """SELECT event_id AS packet_id, ts, {IP} AS src_ip,
  CASE WHEN event_type = 'error' THEN '192.168.10.99'
    ELSE '192.168.10.' || CAST(event_id % 20 AS {STR}) END AS dst_ip,
  CAST(1024 + event_id % 4 AS INT) AS src_port,
  CAST(CASE event_type WHEN 'view' THEN 80 WHEN 'click' THEN 443 WHEN 'purchase' THEN 53
    WHEN 'signup' THEN CASE WHEN event_id % 5 = 0 THEN 445 ELSE 22 END
    ELSE CASE WHEN event_id % 2 = 0 THEN 3389 ELSE event_id % 1024 END END AS INT) AS dst_port,
  CASE WHEN event_type = 'purchase' THEN 'UDP'
    WHEN event_type = 'click' AND event_id % 97 = 0 THEN 'ICMP' ELSE 'TCP' END AS protocol,
  CAST(60 + event_id % 1400 AS INT) AS length,
  CAST(CASE event_type WHEN 'error' THEN 2 WHEN 'signup' THEN 18 WHEN 'view' THEN 24
    WHEN 'click' THEN 16 ELSE NULL END AS INT) AS flag_bits,
  CASE event_id % 200 WHEN 0 THEN 'user=bob&PASSWORD=x' WHEN 1 THEN 'api key=abc token=def'
    WHEN 2 THEN 'monkey business' WHEN 3 THEN 'mail from u1@evil.example.com'
    WHEN 4 THEN 'md5 0cc175b9c0f1b6a831c399e269772661' ELSE 'hello' END AS payload_text,
  CASE WHEN event_type = 'purchase' THEN CASE event_id % 7
    WHEN 0 THEN 'cdn' || CAST(user_id AS {STR}) || '.evil.xyz.'
    WHEN 1 THEN 'a1b2c3d4e5f6a1b2c3d4e5f6a1b2c3d4e5f6a1b2c3d4e5f6a1b2.example.com.'
    WHEN 2 THEN '12345678901234ab.example.com.'
    WHEN 3 THEN '1234-5678-9012-3456.example.com.'
    ELSE 'www.example.com.' END END AS dns_query,
  CASE WHEN event_type = 'purchase' AND event_id % 3 > 0
    THEN '93.184.216.' || CAST(user_id AS {STR}) END AS dns_response,
  CASE WHEN event_type = 'view' THEN CASE WHEN event_id % 4 = 0 THEN 'POST' ELSE 'GET' END END AS http_method,
  CASE WHEN event_type = 'view' THEN CASE event_id % 10 WHEN 0 THEN '/x/../y'
    WHEN 1 THEN '/q?a=1 UNION select 2' WHEN 2 THEN '/run?c=/BIN/SH' WHEN 3 THEN '/u?q=() { :;}'
    ELSE '/p/' || CAST(event_id % 300 AS {STR}) END END AS http_uri,
  CASE WHEN event_type = 'view' AND event_id % 6 > 0
    THEN 'h' || CAST(user_id % 5 AS {STR}) || '.example.com' END AS http_host
FROM events"""

BIDI = """SELECT packet_id, ts, protocol, length, flag_bits,
  CASE WHEN packet_id % 3 = 0 THEN dst_ip ELSE src_ip END AS src_ip,
  CASE WHEN packet_id % 3 = 0 THEN src_ip ELSE dst_ip END AS dst_ip,
  CASE WHEN packet_id % 3 = 0 THEN dst_port ELSE src_port END AS src_port,
  CASE WHEN packet_id % 3 = 0 THEN src_port ELSE dst_port END AS dst_port
FROM fx_packets"""

_HK = """(SELECT {IP} AS src, 37 * (user_id % 4) + 29 * (CASE user_id % 4 WHEN 0 THEN user_id % 10
    WHEN 1 THEN 2 WHEN 2 THEN user_id % 3 ELSE user_id % 6 END) AS hk FROM events) t"""

ABUSE = (
    """SELECT DISTINCT src AS ip_address, CAST(hk % 101 AS INT) AS abuse_confidence_score,
  'C' || CAST(hk % 7 AS {STR}) AS country_code, 'Country ' || CAST(hk % 7 AS {STR}) AS country_name,
  hk % 13 = 0 AS is_whitelisted, CAST(hk % 160 AS INT) AS total_reports,
  CAST(hk % 40 AS INT) AS num_distinct_users
FROM """
    + _HK
    + " WHERE hk % 4 <> 3"
)

VT = (
    """SELECT DISTINCT src AS ip_address, CAST(hk % 5 AS INT) AS malicious,
  CAST(hk % 3 AS INT) AS suspicious, CAST(hk % 11 AS INT) AS harmless,
  CAST(hk % 6 AS INT) AS undetected
FROM """
    + _HK
    + " WHERE hk % 3 <> 1"
)

BEACON = """SELECT event_id AS packet_id,
  {SEC_OPEN}1704067200 + event_id * 150 + CASE WHEN event_id % 2 = 0 THEN 0 ELSE (event_id * event_id) % 1000 END{SEC_CLOSE} AS ts,
  '10.0.5.' || CAST(event_id % 2 AS {STR}) AS src_ip, '203.0.113.7' AS dst_ip
FROM events"""

# Four pairs: every 300 s with a fifth missing and jitter, every 60 s, without any clock,
# every 3600 s with half a beat's jitter.
BEATS = """SELECT event_id AS packet_id, {SEC_OPEN}1704067200 + CASE event_id % 4
    WHEN 0 THEN event_id * 75 + (event_id * 7919) % 31
    WHEN 1 THEN (event_id - 1) * 15
    WHEN 2 THEN (event_id * 104729) % 4000037
    ELSE (event_id - 3) * 900 + (event_id * 7919) % 1801 END{SEC_CLOSE} AS ts,
  '10.0.6.' || CAST(event_id % 4 AS {STR}) AS src_ip, '203.0.113.7' AS dst_ip
FROM events WHERE NOT (event_id % 4 = 0 AND (event_id * 31) % 5 = 0)"""

# What the lines say, taken from the source columns (DuckDB only).
WEB_ENTRIES = (
    "SELECT event_id, {IP} AS ip_address, date_trunc('second', ts) AS event_time, CAST("
    + _STATUS
    + """ AS INTEGER) AS status_code,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 5000 END AS response_size,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'agent/' || (user_id % 9) END AS user_agent,
  'GET' AS http_method, """
    + _REQUEST
    + """ AS request_path,
  CASE WHEN event_id % 3 = 0 THEN 'nginx_default' ELSE 'apache_combined' END AS format,
  {APACHE_TS} || ' +0000' AS timestamp_raw
FROM events"""
)
SSH_ENTRIES = """SELECT event_id, {IP} AS ip_address, date_trunc('second', ts) AS event_time,
  'u' || user_id AS username,
  CASE WHEN event_type = 'signup' THEN 'accepted' ELSE 'failed' END AS login_status,
  {SSH_TS} AS timestamp_raw
FROM events WHERE event_type IN ('signup', 'error')"""


def _filled(sql: str, names: dict[str, str]) -> str:
    sql = sql.replace("{IP}", IP)
    for key, value in names.items():
        sql = sql.replace(key, value)
    return sql


_CTES = {
    "fx_web": WEB,
    "fx_upstream": UPSTREAM,
    "fx_ssh": SSH,
    "fx_packets": PACKETS,
    "fx_bidi": BIDI,
    "fx_abuse": ABUSE,
    "fx_vt": VT,
    "fx_beacon": BEACON,
    "fx_beats": BEATS,
    "web": WEB_ENTRIES,
    "ssh": SSH_ENTRIES,
}


def oracle(names: str, body: str) -> str:
    """DuckDB query with the named recipes as common table expressions."""
    ctes = [f"{n} AS ({_filled(_CTES[n], _DUCKDB)})" for n in names.split()]
    own = body.strip()
    if own.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + own[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + own


class Inputs:
    """Spark inputs of the queries, batch or stream, over one scale's tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, stream: bool = False):
        self.spark, self.sf_dir, self.stream = spark, sf_dir.rstrip("/"), stream

    def table(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        table = self.spark.read.parquet(path)  # fails if there is none, as a stream would not
        if not self.stream:
            return table
        # A pattern stands for a file or a folder of files alike; a stream refuses the plain
        # path of a file. One file at a time.
        reader = self.spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1)
        return reader.parquet(path[:-1] + "[t]")

    def _sql(self, sql: str, **views: DataFrame) -> DataFrame:
        # Views of their own names, so that queries of one session cannot meet.
        names = []
        for name, df in (views or {"events": self.table("events")}).items():
            names.append(f"{name}_{uuid.uuid4().hex}")
            df.createOrReplaceTempView(names[-1])
            sql = sql.replace(f"FROM {name}", f"FROM {names[-1]}")
        result = self.spark.sql(_filled(sql, _SPARK))
        for name in names:
            self.spark.catalog.dropTempView(name)
        return result

    @cached_property
    def web_lines(self) -> DataFrame:
        return self._sql(WEB)

    @cached_property
    def upstream_lines(self) -> DataFrame:
        return self._sql(UPSTREAM)

    @cached_property
    def ssh_lines(self) -> DataFrame:
        return self._sql(SSH)

    @cached_property
    def mixed_lines(self) -> DataFrame:
        web = self.web_lines.withColumn("kind", F.lit("web"))
        return web.unionByName(self.ssh_lines.withColumn("kind", F.lit("ssh")))

    @cached_property
    def web(self) -> DataFrame:
        return parse_logs(self.web_lines, year=YEAR)

    @cached_property
    def ssh(self) -> DataFrame:
        return parse_logs(self.ssh_lines, year=YEAR)

    @cached_property
    def packets(self) -> DataFrame:
        packets = self._sql(PACKETS)
        return packets.withColumn("payload", F.col("payload_text").cast("binary"))

    @cached_property
    def bidi(self) -> DataFrame:
        return self._sql(BIDI, fx_packets=self.packets)

    @cached_property
    def beacon(self) -> DataFrame:
        return self._sql(BEACON)

    @cached_property
    def beats(self) -> DataFrame:
        return self._sql(BEATS)

    @cached_property
    def abuse(self) -> DataFrame:
        return Inputs(self.spark, self.sf_dir)._sql(ABUSE)

    @cached_property
    def vt(self) -> DataFrame:
        return Inputs(self.spark, self.sf_dir)._sql(VT)
