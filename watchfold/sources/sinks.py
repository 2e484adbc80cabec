"""Report datasets, indicator exports and blocklists.

Row sets stay sharded: every sink writes from all tasks, and only one-row headers
are single documents.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOOL_VERSION = "1.0.0"


def analysis_id(source: str | Column, time: str | Column) -> Column:
    """First twelve hex digits of the md5 of source path and time."""
    parts = [F.lit(x) if isinstance(x, str) else x for x in (source, time)]
    return F.substring(F.md5(F.concat(*parts).cast("binary")), 1, 12)


def report_header(
    summary: DataFrame, source: str, generated_at: datetime, tool: str = "watchfold"
) -> DataFrame:
    """One JSON document with the report's metadata and summary."""
    stamp = generated_at.isoformat()
    metadata = F.struct(
        analysis_id(source, stamp).alias("analysis_id"),
        F.lit(stamp).alias("generated_at"),
        F.lit(TOOL_VERSION).alias("tool_version"),
        F.lit(tool).alias("tool_name"),
    )
    body = F.struct(metadata.alias("report_metadata"), F.struct("*").alias("summary"))
    return summary.select(F.to_json(body).alias("value"))


def write_report(
    entries: DataFrame,
    enriched: DataFrame,
    summary: DataFrame,
    path: str,
    source: str,
    generated_at: datetime,
    mode: str = "errorifexists",
) -> dict[str, str]:
    """Writes header, ``threat_intelligence`` and ``log_entries``; returns their folders."""
    parts = {name: f"{path.rstrip('/')}/{name}" for name in ("report", "threat_intelligence", "log_entries")}
    report_header(summary, source, generated_at).write.mode(mode).text(parts["report"])
    enriched.write.mode(mode).json(parts["threat_intelligence"])
    entries.write.mode(mode).json(parts["log_entries"])
    return parts


def write_iocs(
    iocs: DataFrame, path: str, exported_at: datetime, mode: str = "errorifexists"
) -> dict[str, str]:
    """Writes ``iocs`` as JSON rows and a header with time and number of rows written.

    The number is read back from the written rows, so that both agree.
    """
    spark = iocs.sparkSession
    parts = {name: f"{path.rstrip('/')}/{name}" for name in ("export", "iocs")}
    iocs.write.mode(mode).json(parts["iocs"])
    written = spark.read.schema(iocs.schema).json(parts["iocs"])
    header = written.agg(F.count("*").alias("ioc_count")).select(
        F.to_json(F.struct(F.lit(exported_at.isoformat()).alias("exported_at"), "ioc_count"))
    )
    header.write.mode(mode).text(parts["export"])
    return parts


def blocklist(iocs: DataFrame) -> DataFrame:
    """Distinct addresses among the indicators."""
    return iocs.filter(F.col("type") == "ip").select("value").distinct()


def write_blocklist(iocs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One address per line."""
    blocklist(iocs).write.mode(mode).text(path)
