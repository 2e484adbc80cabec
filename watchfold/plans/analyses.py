"""Log analysis and capture analysis: every output of a run as a lazy DataFrame."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from watchfold.functions.text import clean_utf8
from watchfold.operators import detect, intel, ioc, report, summary, traffic
from watchfold.operators.fragments import defragment
from watchfold.operators.logs import parse_logs
from watchfold.operators.packets import decode
from watchfold.session import scratch_dir
from watchfold.sources.captures import read_frames
from watchfold.sources.log_lines import read_log_lines


@dataclass(frozen=True)
class LogAnalysis:
    entries: DataFrame
    enriched: DataFrame
    flagged: DataFrame
    details: DataFrame
    status: DataFrame
    summary: DataFrame


def analyze_logs(
    spark: SparkSession,
    paths: str | list[str],
    abuse: DataFrame,
    vt: DataFrame,
    fmt: str = "auto",
    detect_by: str = "line",
    year: int | Column | None = None,
    min_confidence: int = 50,
    max_ips: int | None = None,
    table: str | None = None,
) -> LogAnalysis:
    """Parse log files once into a parquet table, then look up, flag and summarise.

    ``table`` is the folder of the entries; by default a new one below the
    cluster's checkpoint folder. ``max_ips`` limits the lookup to the busiest addresses, as a lookup against a
    metered service would; tables need no limit.
    """
    table = table or scratch_dir(spark, "entries")
    parse_logs(read_log_lines(spark, paths), fmt, detect_by, year).write.parquet(table)
    entries = spark.read.parquet(table)
    asked = entries if max_ips is None else summary.top_ips(entries, max_ips)
    enriched = intel.enrich(asked, abuse, vt)
    return LogAnalysis(
        entries=entries,
        enriched=enriched,
        flagged=intel.flagged_table(enriched, min_confidence),
        details=intel.ip_details(enriched),
        status=summary.status_table(entries),
        summary=summary.log_summary(entries, enriched, min_confidence),
    )


@dataclass(frozen=True)
class CaptureAnalysis:
    packets: DataFrame
    totals: DataFrame
    protocols: DataFrame
    sources: DataFrame
    destinations: DataFrame
    ports: DataFrame
    flows: DataFrame
    alerts: DataFrame
    iocs: DataFrame
    http_requests: DataFrame
    dns_queries: DataFrame
    overview: DataFrame
    severities: DataFrame
    timeline: DataFrame


def analyze_packets(packets: DataFrame, table: str, sample: int | None = None) -> CaptureAnalysis:
    """Statistics, flows, alerts, indicators and report tables of stored packets.

    Alerts and indicators, which several outputs read, are written below ``table``.
    ``sample`` cuts the lists of HTTP requests and DNS queries to the first so many.
    """
    spark = packets.sparkSession
    detect.all_alerts(packets).write.parquet(f"{table}/alerts")
    alerts = spark.read.parquet(f"{table}/alerts")
    text = clean_utf8(F.col("payload").cast("string"))
    ioc.all_iocs(packets, alerts, text=text).write.parquet(f"{table}/iocs")
    iocs = spark.read.parquet(f"{table}/iocs")
    return CaptureAnalysis(
        packets=packets,
        totals=traffic.totals(packets),
        protocols=traffic.by_protocol(packets),
        sources=traffic.by_source(packets),
        destinations=traffic.by_destination(packets),
        ports=traffic.by_port(packets),
        flows=traffic.flows(packets),
        alerts=alerts,
        iocs=iocs,
        http_requests=traffic.http_requests(packets, sample),
        dns_queries=traffic.dns_queries(packets, sample),
        overview=report.capture_overview(packets, alerts, iocs),
        severities=report.severity_counts(alerts),
        timeline=report.timeline(alerts),
    )


def analyze_capture(
    spark: SparkSession,
    paths: str | list[str],
    table: str | None = None,
    transports: tuple[str, ...] | None = None,
    assemble: bool = False,
) -> CaptureAnalysis:
    """Decode captures once into a parquet table and analyse that.

    With ``assemble`` fragments are put together first, and a datagram is one packet.
    ``table`` is the folder for packets, alerts and indicators; by default a new
    one below the cluster's checkpoint folder.
    """
    table = table or scratch_dir(spark, "capture")
    frames = read_frames(spark, paths)
    if assemble:
        frames = defragment(frames)
    decode(frames, transports=transports).write.parquet(f"{table}/packets")
    return analyze_packets(spark.read.parquet(f"{table}/packets"), table)
