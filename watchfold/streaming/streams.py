"""Streams of log entries and packets: running indicators, windowed alerts, sessions.

Expressions and thresholds are those of the batch operators. Stateless steps
(parsing, feed joins) need nothing of their own: ``parse_logs`` and ``attach`` take
streams as they are. Rows later than the watermark are dropped by the windowed ones.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from watchfold.functions.rules import syn_only
from watchfold.functions.times import as_instant, as_local
from watchfold.operators.detect import FAILURES, PORTS, SYN_FLOOD
from watchfold.operators.logs import failed_logins, parse_logs
from watchfold.operators.packets import decode
from watchfold.operators.summary import sample_lines
from watchfold.operators.traffic import PAIR, endpoint_pair, flow_aggregates, flow_columns
from watchfold.sources.captures import read_frame_stream
from watchfold.sources.files import open_filesystem
from watchfold.sources.log_lines import read_log_stream

#: Folders of running indicators that are merged into one.
FANOUT = 8


def entry_stream(
    spark: SparkSession, folder: str, year: int | Column | None = None, **options: int
) -> DataFrame:
    """Log entries of files that appear in a folder; every line detects its own format."""
    return parse_logs(read_log_stream(spark, folder, **options), year=year)


def packet_stream(spark: SparkSession, folder: str, **options: int) -> DataFrame:
    """Packets of capture files that appear in a folder."""
    return decode(read_frame_stream(spark, folder, **options))


def _activity(entries: DataFrame) -> DataFrame:
    return entries.groupBy("ip_address").agg(
        F.min("event_time").alias("first_seen"),
        F.max("event_time").alias("last_seen"),
        F.count("*").alias("request_count"),
    )


def indicator_stream(entries: DataFrame) -> DataFrame:
    """Running activity per address, for update or complete output mode."""
    return _activity(entries)


def _run(path: str, first: int, last: int) -> str:
    return f"{path.rstrip('/')}/first={first}/last={last}"


def _complete_runs(path: str) -> list[tuple[int, int]]:
    """First and last batch of the folders that are written to the end."""
    filesystem, root = open_filesystem(path)
    found = filesystem.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
    names = (re.search(r"/first=(\d+)/last=(\d+)/_SUCCESS$", f.path) for f in found)
    return sorted((int(m[1]), int(m[2])) for m in names if m)


def _cover(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The widest runs: those that lie in no other."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(runs, key=lambda r: (r[0], -r[1])):
        if not out or last > out[-1][1]:
            out.append((first, last))
    return out


def _merged_runs(spark: SparkSession, path: str, runs: list[tuple[int, int]], samples: int) -> DataFrame:
    """One row per address over runs of batches, sample lines of the earliest ones first."""
    root = path.rstrip("/")
    rows = spark.read.option("basePath", root).parquet(*[_run(root, *r) for r in runs])
    activity = rows.groupBy("ip_address").agg(
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.sum("request_count").alias("request_count"),
    )
    line = F.posexplode("raw_log_entries").alias("position", "raw")
    first = Window.partitionBy("ip_address").orderBy("first", "position")
    ranked = (
        rows.select("ip_address", "first", line)
        .withColumn("rank", F.row_number().over(first))
        .filter(F.col("rank") <= samples)
    )
    kept = F.array_sort(F.collect_list(F.struct("rank", "raw")))["raw"]
    return activity.join(
        ranked.groupBy("ip_address").agg(kept.alias("raw_log_entries")), "ip_address", "left"
    )


def compact_indicators(spark: SparkSession, path: str, batch_id: int, samples: int = 5, fanout: int = FANOUT) -> None:
    """Merges what batch ``batch_id`` completes: ``fanout`` folders of a level become one of the next.

    A batch that is repeated merges the same folders again. Folders go one merge later than
    they are merged, when no batch that could be repeated needs them and readers that listed
    them before have had ``fanout`` batches of time.
    """
    filesystem, _ = open_filesystem(path)
    size = fanout
    while (batch_id + 1) % size == 0:
        first = batch_id + 1 - size
        runs = _complete_runs(path)
        parts = _cover([r for r in runs if r[0] >= first and r[1] <= batch_id and r != (first, batch_id)])
        if parts:
            _merged_runs(spark, path, parts, samples).write.mode("overwrite").parquet(_run(path, first, batch_id))
        wide = [r for r in runs if r[1] < first and r[1] - r[0] + 1 == size]
        for low, high in runs:
            if high - low + 1 < size and any(w[0] <= low and high <= w[1] for w in wide):
                filesystem.delete_dir(open_filesystem(_run(path, low, high))[1])
        size *= fanout


def indicator_sink(path: str, samples: int = 5, fanout: int = FANOUT) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer of running indicators that keeps no state.

    Each batch becomes one row per address with its activity and at most ``samples``
    lines, in a folder of its own: a repeated batch overwrites itself, so results
    count every row once. Folders are merged by levels (``compact_indicators``), so that a
    reader opens at most ``fanout - 1`` of each level, a logarithm of the number of
    batches. ``latest_indicators`` merges them.
    """
    if fanout < 2:
        raise ValueError("fanout must be 2 or more")

    def write(batch: DataFrame, batch_id: int) -> None:
        # Two plans read the batch; kept lines save parsing it twice, lost ones are redone.
        kept = batch.select("ip_address", "event_time", "raw").persist()
        try:
            rows = _activity(kept).join(sample_lines(kept, samples), "ip_address", "left")
            rows.write.mode("overwrite").parquet(_run(path, batch_id, batch_id))
        finally:
            kept.unpersist()
        compact_indicators(batch.sparkSession, path, batch_id, samples, fanout)

    return write


def latest_indicators(spark: SparkSession, path: str, samples: int = 5) -> DataFrame:
    """Indicators over all written batches, sample lines of the earliest ones first."""
    return _merged_runs(spark, path, _cover(_complete_runs(path)), samples)


def _timed(rows: DataFrame, ts: str, delay: str) -> DataFrame:
    """Adds the instant ``_at`` of a zone-less time, with a watermark on it."""
    return rows.withColumn("_at", as_instant(F.col(ts))).withWatermark("_at", delay)


def _bounds() -> list[Column]:
    """Start and end of the window ``w`` as zone-less times."""
    return [as_local(F.col(f"w.{side}")).alias(f"window_{side}") for side in ("start", "end")]


def login_alerts(
    entries: DataFrame,
    window: str = "10 minutes",
    slide: str | None = None,
    n: int = FAILURES,
    delay: str = "10 minutes",
) -> DataFrame:
    """Addresses with at least ``n`` failed logins per tumbling or sliding window."""
    return (
        _timed(failed_logins(entries), "event_time", delay)
        .groupBy(F.window("_at", window, slide).alias("w"), "ip_address")
        .agg(F.count("*").alias("failures"))
        .filter(F.col("failures") >= n)
        .select("ip_address", *_bounds(), "failures")
    )


def scan_alerts(
    packets: DataFrame, window: str = "10 minutes", ports: int = PORTS, delay: str = "10 minutes"
) -> DataFrame:
    """Pairs of hosts with at least ``ports`` distinct destination ports per window.

    Two aggregations in a row, by port and then by pair, make the count exact where
    a distinct count is not allowed on streams, and spread a busy pair over tasks.
    """
    by_port = (
        _timed(packets, "ts", delay)
        .groupBy(F.window("_at", window).alias("w"), "src_ip", "dst_ip", "dst_port")
        .agg(F.count("*").alias("packets"))
    )
    return (
        by_port.groupBy("w", "src_ip", "dst_ip")
        .agg(F.count("*").alias("ports"))
        .filter(F.col("ports") >= ports)
        .select(*_bounds(), "src_ip", "dst_ip", "ports")
    )


def flood_alerts(
    packets: DataFrame, window: str = "10 minutes", n: int = SYN_FLOOD, delay: str = "10 minutes"
) -> DataFrame:
    """Destinations with more than ``n`` connection attempts per window."""
    opening = packets.filter(syn_only(F.col("flag_bits"), F.col("protocol")))
    return (
        _timed(opening, "ts", delay)
        .groupBy(F.window("_at", window).alias("w"), "dst_ip")
        .agg(F.count("*").alias("attempts"))
        .filter(F.col("attempts") > n)
        .select(*_bounds(), "dst_ip", "attempts")
    )


def flow_sessions(
    packets: DataFrame, gap: str = "30 minutes", delay: str = "10 minutes"
) -> DataFrame:
    """Bidirectional flows that end after an idle gap, once the watermark passes it.

    Set ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition`` so
    that each task merges a busy flow's packets before the shuffle.
    """
    grouped = (
        endpoint_pair(_timed(packets, "ts", delay))
        .groupBy(F.session_window("_at", gap).alias("session"), *PAIR)
        .agg(*flow_aggregates())
    )
    return flow_columns(grouped)


def dedup_alerts(
    alerts: DataFrame,
    delay: str = "10 minutes",
    keys: tuple[str, ...] = ("category", "source_ip", "destination_ip", "description"),
) -> DataFrame:
    """Lets the first of equal alerts within the delay through."""
    return _timed(alerts, "ts", delay).dropDuplicatesWithinWatermark(list(keys)).drop("_at")


def alert_bursts(
    alerts: DataFrame,
    quiet: str = "10 minutes",
    delay: str = "10 minutes",
    keys: tuple[str, ...] = ("category", "source_ip", "destination_ip", "description"),
) -> DataFrame:
    """Equal alerts that follow each other within ``quiet`` as one row: first, last, how many.

    A row comes when the watermark has passed its last alert and ``quiet``. Other than
    :func:`dedup_alerts` the result does not depend on how rows are dealt to batches. Null
    keys are equal, alerts without ts are left out.
    """
    return (
        _timed(alerts, "ts", delay)
        .groupBy(F.session_window("_at", quiet).alias("burst"), *keys)
        .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count("*").alias("alerts"))
        .drop("burst")
    )
