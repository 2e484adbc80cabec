"""Structured Streaming forms of the operators."""

from watchfold.streaming.streams import (
    alert_bursts,
    compact_indicators,
    dedup_alerts,
    entry_stream,
    flow_sessions,
    flood_alerts,
    indicator_sink,
    indicator_stream,
    latest_indicators,
    login_alerts,
    packet_stream,
    scan_alerts,
)

__all__ = [
    "alert_bursts",
    "compact_indicators",
    "dedup_alerts",
    "entry_stream",
    "flood_alerts",
    "flow_sessions",
    "indicator_sink",
    "indicator_stream",
    "latest_indicators",
    "login_alerts",
    "packet_stream",
    "scan_alerts",
]
