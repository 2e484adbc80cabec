"""Report tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchfold.functions.net import is_private
from watchfold.operators.intel import abuse_score, attach, vt_malicious
from watchfold.operators.traffic import (
    by_destination,
    dns_queries,
    endpoint_summary,
    http_requests,
)

# Severities in report order.
SEVERITIES = ("critical", "high", "medium", "low")


def severity_counts(alerts: DataFrame) -> DataFrame:
    """Alerts per severity, all four present, worst first: one aggregation, no join."""
    counts = alerts.agg(*[F.count_if(F.col("severity") == s).alias(s) for s in SEVERITIES])
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("rank"), F.lit(s).alias("severity"), F.col(s).alias("n"))
            for i, s in enumerate(SEVERITIES)
        ]
    )
    return counts.select(F.inline(rows)).orderBy("rank")


def _by_time() -> list[Column]:
    """A total order over alerts, so that a cut at n rows is the same on every run."""
    return [
        F.col("ts").asc_nulls_last(),
        F.col("category"),
        F.col("description"),
        F.col("source_ip"),
        F.col("destination_ip"),
        F.col("evidence"),
    ]


def timeline(alerts: DataFrame, n: int = 20) -> DataFrame:
    """The first alerts by time, descriptions cut for display."""
    return (
        alerts.orderBy(*_by_time())
        .limit(n)
        .select("ts", "severity", "category", F.substring("description", 1, 60).alias("description"))
    )


def iocs_by_type(iocs: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` surest indicators of each type, texts cut for display.

    Spark keeps ``n`` rows per type in each task before the shuffle.
    """
    best = Window.partitionBy("type").orderBy(
        F.desc("confidence"), F.asc("value"), F.asc("context"), F.asc("first_seen")
    )
    return (
        iocs.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= n)
        .select(
            "type",
            "rank",
            F.substring("value", 1, 50).alias("value"),
            F.substring("context", 1, 40).alias("context"),
            "confidence",
        )
    )


def http_sample(packets: DataFrame, n: int = 15) -> DataFrame:
    """The first HTTP requests, host and URI cut for display."""
    return http_requests(packets, n).select(
        "ts",
        "http_method",
        F.substring(F.coalesce("http_host", F.lit("")), 1, 25).alias("host"),
        F.substring(F.coalesce("http_uri", F.lit("")), 1, 30).alias("uri"),
        "src_ip",
    )


def suspicious_dns(packets: DataFrame, n: int = 10, longer_than: int = 30) -> DataFrame:
    """The first answered queries with a long name, cut for display."""
    answered = dns_queries(packets).filter(
        (F.coalesce("dns_response", F.lit("")) != "") & (F.length("dns_query") > longer_than)
    )
    return (
        answered.orderBy("ts", "packet_id")
        .limit(n)
        .select(
            "ts",
            F.substring("dns_query", 1, 30).alias("query"),
            F.substring("dns_response", 1, 20).alias("response"),
            "src_ip",
        )
    )


def findings(alerts: DataFrame, n: int = 15) -> DataFrame:
    """The first alerts in full with their evidence as one text."""
    return (
        alerts.orderBy(*_by_time())
        .limit(n)
        .select(
            "ts",
            F.upper("severity").alias("severity"),
            "category",
            "description",
            "source_ip",
            "destination_ip",
            F.array_join("evidence", "; ").alias("evidence"),
        )
    )


def external_destinations(packets: DataFrame, abuse: DataFrame, vt: DataFrame) -> DataFrame:
    """Public destinations with packet count, country and reputation."""
    outside = by_destination(packets.filter(~is_private(F.col("dst_ip"))))
    known = attach(outside.withColumnRenamed("dst_ip", "ip_address"), abuse, vt)
    reputation = (
        F.when(vt_malicious() > 0, "MALICIOUS")
        .when(abuse_score() >= 50, "SUSPICIOUS")
        .when(F.col("abuse").isNull() & F.col("vt").isNull(), "UNKNOWN")
        .otherwise("CLEAN")
    )
    return known.select(
        "ip_address",
        F.col("n").alias("packets"),
        F.coalesce("abuse.country_name", F.lit("Unknown")).alias("country"),
        reputation.alias("reputation"),
    )


def capture_overview(packets: DataFrame, alerts: DataFrame, iocs: DataFrame) -> DataFrame:
    """One row: packets, bytes, unique ends, alerts and indicators."""
    parts = (
        endpoint_summary(packets)
        .unionByName(alerts.agg(F.count("*").alias("alerts")), allowMissingColumns=True)
        .unionByName(iocs.agg(F.count("*").alias("iocs")), allowMissingColumns=True)
    )
    return parts.agg(*[F.max(c).alias(c) for c in parts.columns])
