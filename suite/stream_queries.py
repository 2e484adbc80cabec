"""Streams over the events table, run until all of it is read.

Each stream writes to a folder below the shared checkpoint folder; the query's
result is what was written. Windowed streams in append mode give the windows that
the last watermark has closed, and so does the SQL.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suite.fixtures import YEAR, Inputs
from suite.registry import query
from suite.traffic_queries import FLAGS
from watchfold import streaming
from watchfold.operators import detect, intel
from watchfold.operators.logs import parse_logs
from watchfold.session import scratch_dir
from watchfold.sources.files import open_filesystem
from watchfold.sources.growing import read_growing_lines


def finished(stream: DataFrame, sink=None, mode: str = "append") -> str:
    """Runs a stream over all input there is; returns the folder of its output."""
    folder = scratch_dir(stream.sparkSession, "stream")
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/state")
    out = f"{folder}/out"
    if sink is None:
        writer = writer.format("parquet").option("path", out)
    else:
        writer = writer.foreachBatch(sink(out))
    writer.trigger(availableNow=True).start().awaitTermination()
    return out


def appended(stream: DataFrame) -> DataFrame:
    return stream.sparkSession.read.schema(stream.schema).parquet(finished(stream))


@query(
    "w1_stream_parse",
    "web",
    "SELECT event_id, format, event_time, ip_address, status_code, user_agent FROM web",
    stream=True,
)
def _(x: Inputs) -> DataFrame:
    return appended(
        x.web.select("event_id", "format", "event_time", "ip_address", "status_code", "user_agent")
    )


def _grow(folder: str, turn: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each task's lines of all turns so far, in order: its file of the turn before and more.

    The first task's file is renamed before the last turn and begins anew.
    """
    filesystem, root = open_filesystem(folder)
    context = TaskContext.get()
    draft = f"{root}/_draft-{context.taskAttemptId()}"
    rows = 0
    with filesystem.open_output_stream(draft) as out:
        for batch in batches:
            for line, of in zip(batch.column("raw").to_pylist(), batch.column("turn").to_pylist(), strict=True):
                if context.partitionId() or turn < 2 or of == 2:
                    out.write(f"{line}\n".encode())
                    rows += 1
    filesystem.move(draft, f"{root}/part-{context.partitionId()}.log")
    yield pa.RecordBatch.from_pydict({"rows": [rows]})


@query(
    "s2_growing_files",
    "web",
    "SELECT format, ip_address, status_code, count(*) AS n FROM web GROUP BY 1, 2, 3",
)
def _(x: Inputs) -> DataFrame:
    """Files that grow twice while a stream is stopped and restarted; one is renamed on the way."""
    folder, state, out = (scratch_dir(x.spark, name) for name in ("growing", "state", "lines"))
    filesystem, root = open_filesystem(folder)
    filesystem.create_dir(root)
    for turn in range(3):
        lines = x.web_lines.select("event_id", "raw", (F.col("event_id") % 3).alias("turn")).filter(F.col("turn") <= turn)
        lines = lines.repartition(4, "event_id").sortWithinPartitions("turn", "event_id")
        lines.mapInArrow(partial(_grow, folder, turn), "rows bigint").agg(F.sum("rows")).first()
        writer = read_growing_lines(x.spark, folder).writeStream.format("parquet").option("path", out)
        writer.option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
        if turn == 1:
            filesystem.move(f"{root}/part-0.log", f"{root}/part-0.log.1")
    lines = x.spark.read.schema("file_path string, line_number bigint, raw string, place bigint").parquet(out)
    return parse_logs(lines, year=YEAR).groupBy("format", "ip_address", "status_code").agg(F.count("*").alias("n"))


@query(
    "s2_follow_folder",
    "web ssh",
    """SELECT 'web' AS kind, ip_address, status_code, count(*) AS n FROM web GROUP BY 1, 2, 3
UNION ALL SELECT 'ssh', ip_address, NULL, count(*) FROM ssh GROUP BY 1, 2, 3""",
)
def _(x: Inputs) -> DataFrame:
    folder = scratch_dir(x.spark, "followed")
    x.mixed_lines.select("kind", "raw").write.partitionBy("kind").text(folder)
    entries = streaming.entry_stream(x.spark, f"{folder}/kind=*", YEAR, max_files_per_trigger=1)
    kind = F.when(F.col("login_status").isNull(), "web").otherwise("ssh").alias("kind")
    return (
        appended(entries.select(kind, "ip_address", "status_code"))
        .groupBy("kind", "ip_address", "status_code")
        .agg(F.count("*").alias("n"))
    )


_ACTIVITY = """SELECT ip_address, min(event_time) AS first_seen, max(event_time) AS last_seen,
  count(*) AS request_count"""


@query("w2_running_indicators", "web", f"{_ACTIVITY} FROM web GROUP BY 1", stream=True)
def _(x: Inputs) -> DataFrame:
    def sink(out: str):
        def write(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

        return write

    out = finished(streaming.indicator_stream(x.web), sink, "update")
    changes = x.spark.read.parquet(out)
    row = F.struct("first_seen", "last_seen", "request_count")
    return (
        changes.groupBy("ip_address")
        .agg(F.max_by(row, "batch_id").alias("row"))
        .select("ip_address", "row.*")
    )


@query(
    "w2_indicator_sink",
    "web fx_web",
    f"""WITH ranked AS (SELECT ip_address, f.raw, row_number() OVER (PARTITION BY ip_address ORDER BY event_time, f.raw) AS r
  FROM web w JOIN fx_web f ON w.event_id = f.event_id),
samples AS (SELECT ip_address, string_agg(raw, '|' ORDER BY r) AS raw_lines FROM ranked WHERE r <= 5 GROUP BY 1),
activity AS ({_ACTIVITY} FROM web GROUP BY 1)
SELECT a.*, raw_lines FROM activity a JOIN samples s ON a.ip_address = s.ip_address""",
    stream=True,
)
def _(x: Inputs) -> DataFrame:
    out = finished(x.web, streaming.indicator_sink)
    return streaming.latest_indicators(x.spark, out).withColumn(
        "raw_lines", F.array_join("raw_log_entries", "|")
    ).drop("raw_log_entries")


@query(
    "w3_stream_enrich",
    "web fx_abuse fx_vt",
    """SELECT event_id, w.ip_address, abuse_confidence_score, malicious FROM web w
LEFT JOIN fx_abuse b ON w.ip_address = b.ip_address LEFT JOIN fx_vt v ON w.ip_address = v.ip_address""",
    stream=True,
)
def _(x: Inputs) -> DataFrame:
    known = intel.attach(x.web.select("event_id", "ip_address"), x.abuse, x.vt)
    return appended(
        known.select("event_id", "ip_address", "abuse.abuse_confidence_score", "vt.malicious")
    )


@query(
    "w4_login_alerts",
    "ssh",
    """WITH failed AS (SELECT * FROM ssh WHERE login_status = 'failed')
SELECT ip_address, time_bucket(INTERVAL '6 hours', event_time) AS window_start,
  time_bucket(INTERVAL '6 hours', event_time) + INTERVAL '6 hours' AS window_end, count(*) AS failures
FROM failed GROUP BY 1, 2, 3 HAVING count(*) >= 3
  AND window_end <= (SELECT max(event_time) FROM failed) - INTERVAL '1 hour'""",
    stream=True,
)
def _(x: Inputs) -> DataFrame:
    return appended(streaming.login_alerts(x.ssh, "6 hours", n=3, delay="1 hour"))


@query(
    "w4_login_alerts_sliding",
    "web",
    """WITH failed AS (SELECT * FROM web WHERE status_code = 401),
starts AS (SELECT ip_address, time_bucket(INTERVAL '1 hour', event_time) - INTERVAL (k) HOUR AS window_start
  FROM failed, generate_series(0, 5) g(k))
SELECT ip_address, window_start, window_start + INTERVAL '6 hours' AS window_end, count(*) AS failures
FROM starts GROUP BY 1, 2, 3 HAVING count(*) >= 5
  AND window_end <= (SELECT max(event_time) FROM failed) - INTERVAL '1 hour'""",
    stream=True,
)
def _(x: Inputs) -> DataFrame:
    return appended(streaming.login_alerts(x.web, "6 hours", "1 hour", n=5, delay="1 hour"))


@query(
    "w5_scan_alerts",
    "fx_packets",
    """SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' AS window_end,
  src_ip, dst_ip, count(DISTINCT dst_port) AS ports FROM fx_packets GROUP BY 1, 2, 3, 4
HAVING count(DISTINCT dst_port) >= 5 AND window_end <= (SELECT max(ts) FROM fx_packets) - INTERVAL '1 hour'""",
    stream=True,
)
def _(x: Inputs) -> DataFrame:
    return appended(streaming.scan_alerts(x.packets, "1 day", 5, "1 hour"))


@query(
    "w5_flood_alerts",
    "fx_packets",
    """WITH opening AS (SELECT * FROM fx_packets WHERE protocol = 'TCP' AND flag_bits & 18 = 2)
SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' AS window_end,
  dst_ip, count(*) AS attempts FROM opening GROUP BY 1, 2, 3
HAVING count(*) > 60 AND window_end <= (SELECT max(ts) FROM opening) - INTERVAL '1 hour'""",
    stream=True,
)
def _(x: Inputs) -> DataFrame:
    return appended(streaming.flood_alerts(x.packets, "1 day", 60, "1 hour"))


@query(
    "w6_flow_sessions",
    "fx_packets fx_bidi",
    f"""WITH ordered AS (SELECT *, {FLAGS} AS flag_text,
  CASE WHEN (src_ip, src_port) <= (dst_ip, dst_port) THEN src_ip || ':' || src_port || '-' || dst_ip || ':' || dst_port
    ELSE dst_ip || ':' || dst_port || '-' || src_ip || ':' || src_port END AS pair FROM fx_bidi),
spaced AS (SELECT *, lag(ts) OVER (PARTITION BY protocol, pair ORDER BY ts, packet_id) AS before FROM ordered),
numbered AS (SELECT *, sum(CASE WHEN before IS NULL OR ts > before + INTERVAL '6 hours' THEN 1 ELSE 0 END)
  OVER (PARTITION BY protocol, pair ORDER BY ts, packet_id) AS session FROM spaced),
placed AS (SELECT *, row_number() OVER (PARTITION BY protocol, pair, session ORDER BY ts, packet_id) AS r FROM numbered)
SELECT max(src_ip) FILTER (r = 1) AS src_ip, max(dst_ip) FILTER (r = 1) AS dst_ip,
  max(src_port) FILTER (r = 1) AS src_port, max(dst_port) FILTER (r = 1) AS dst_port, protocol,
  min(ts) AS start_time, max(ts) AS end_time, count(*) AS packet_count, CAST(sum(length) AS BIGINT) AS byte_count,
  coalesce(string_agg(DISTINCT flag_text, '|' ORDER BY flag_text) FILTER (flag_text <> ''), '') AS flags
FROM placed GROUP BY protocol, pair, session
HAVING max(ts) + INTERVAL '6 hours' <= (SELECT max(ts) FROM fx_packets) - INTERVAL '1 hour'""",
    stream=True,
)
def _(x: Inputs) -> DataFrame:
    sessions = streaming.flow_sessions(x.bidi, "6 hours", "1 hour")
    return appended(sessions.withColumn("flags", F.array_join("flags", "|")))


@query(
    "w7_dedup_alerts",
    "fx_packets",
    """SELECT DISTINCT 'Data Exfiltration' AS category, src_ip AS source_ip, dst_ip AS destination_ip,
  'Sensitive keyword "' || CASE packet_id % 200 WHEN 0 THEN 'password' ELSE 'key=' END || '" found in traffic' AS description
FROM fx_packets WHERE packet_id % 200 < 2""",
    stream=True,
)
def _(x: Inputs) -> DataFrame:
    # The whole table is one file and so one batch: each alert comes through once.
    alerts = streaming.dedup_alerts(detect.sensitive_keyword(x.packets), "1 hour")
    return appended(alerts.select("category", "source_ip", "destination_ip", "description"))


@query(
    "w7_alert_bursts",
    "fx_packets",
    """WITH alerts AS (SELECT packet_id, ts, src_ip AS source_ip, dst_ip AS destination_ip,
  'Sensitive keyword "' || CASE packet_id % 200 WHEN 0 THEN 'password' ELSE 'key=' END || '" found in traffic' AS description
  FROM fx_packets WHERE packet_id % 200 < 2),
spaced AS (SELECT *, lag(ts) OVER (PARTITION BY source_ip, destination_ip, description ORDER BY ts, packet_id) AS before FROM alerts),
numbered AS (SELECT *, sum(CASE WHEN before IS NULL OR ts > before + INTERVAL '12 hours' THEN 1 ELSE 0 END)
  OVER (PARTITION BY source_ip, destination_ip, description ORDER BY ts, packet_id) AS burst FROM spaced)
SELECT 'Data Exfiltration' AS category, source_ip, destination_ip, description, min(ts) AS first_ts, max(ts) AS last_ts,
  count(*) AS alerts FROM numbered GROUP BY source_ip, destination_ip, description, burst
HAVING max(ts) + INTERVAL '12 hours' <= (SELECT max(ts) FROM alerts) - INTERVAL '1 hour'""",
    stream=True,
)
def _(x: Inputs) -> DataFrame:
    return appended(streaming.alert_bursts(detect.sensitive_keyword(x.packets), "12 hours", "1 hour"))


@query(
    "w2_compacted_indicators",
    "web fx_web",
    f"{_ACTIVITY} FROM web GROUP BY 1",
)
def _(x: Inputs) -> DataFrame:
    """All lines in 20 batches, merged in levels of three."""
    entries = x.web.select("ip_address", "event_time", "raw", F.pmod(F.xxhash64("event_id"), F.lit(20)).alias("turn"))
    turns, out = scratch_dir(x.spark, "turns"), scratch_dir(x.spark, "levels")
    entries.write.partitionBy("turn").parquet(turns)
    entries = x.spark.read.schema(entries.schema).parquet(turns)
    write = streaming.indicator_sink(out, fanout=3)
    for turn in range(20):
        write(entries.filter(F.col("turn") == turn), turn)
    return streaming.latest_indicators(x.spark, out).drop("raw_log_entries")
