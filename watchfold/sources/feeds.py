"""Reputation responses (JSON) as lookup tables with one row per address."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from watchfold import schemas


def _bodies(spark: SparkSession, source: DataFrame | str, schema: str) -> DataFrame:
    """``ip_address`` (asked address, may be absent) and the parsed response."""
    if isinstance(source, str):
        source = spark.read.text(source).withColumnRenamed("value", "body")
    asked = F.col("ip_address") if "ip_address" in source.columns else F.lit(None)
    return source.select(
        asked.cast("string").alias("asked"), F.from_json("body", schema).alias("r")
    ).filter("r.data is not null")


def _or(column: str, default: Column) -> Column:
    return F.coalesce(F.col(column), default)


def _one_per_ip(rows: DataFrame, order: Column) -> DataFrame:
    """The newest response of each address; partial aggregation keeps it skew-free."""
    row = F.struct(*[c for c in rows.columns])
    return (
        rows.filter("ip_address is not null")
        .groupBy("ip_address")
        .agg(F.max_by(row, order).alias("row"))
        .select("row.*")
    )


def read_abuse(spark: SparkSession, source: DataFrame | str) -> DataFrame:
    """Abuse-report responses: ``(ip_address, body)`` rows or a folder of JSON lines.

    Responses without ``data`` are dropped, absent figures become 0.
    """
    d = "r.data."
    rows = _bodies(spark, source, schemas.ABUSE_BODY).select(
        F.coalesce("asked", d + "ipAddress").alias("ip_address"),
        _or(d + "abuseConfidenceScore", F.lit(0)).alias("abuse_confidence_score"),
        F.col(d + "countryCode").alias("country_code"),
        F.col(d + "countryName").alias("country_name"),
        _or(d + "isWhitelisted", F.lit(False)).alias("is_whitelisted"),
        _or(d + "totalReports", F.lit(0)).alias("total_reports"),
        _or(d + "numDistinctUsers", F.lit(0)).alias("num_distinct_users"),
        F.col(d + "lastReportedAt").alias("last_reported_at"),
        _or(d + "categories", F.array().cast("array<int>")).alias("categories"),
    )
    newest = F.struct(
        F.coalesce("last_reported_at", F.lit("")), "abuse_confidence_score", "total_reports"
    )
    return _one_per_ip(rows, newest)


def read_vt(spark: SparkSession, source: DataFrame | str) -> DataFrame:
    """Multi-engine responses: ``(ip_address, body)`` rows or a folder of JSON lines."""
    a = "r.data.attributes."
    stats = a + "last_analysis_stats."
    rows = _bodies(spark, source, schemas.VT_BODY).select(
        F.coalesce("asked", "r.data.id").alias("ip_address"),
        *[
            _or(stats + name, F.lit(0)).alias(name)
            for name in ("harmless", "malicious", "suspicious", "undetected")
        ],
        _or(a + "total_votes", F.expr("cast(map() as map<string,int>)")).alias("total_votes"),
        _or(a + "reputation", F.lit(0)).alias("reputation"),
        F.col(a + "last_analysis_date").alias("last_analysis_date"),
    )
    newest = F.struct(
        F.coalesce("last_analysis_date", F.lit("")), "malicious", "suspicious"
    )
    return _one_per_ip(rows, newest)
