"""Schemas of the tables that operators exchange, as Spark DDL."""

LOG_LINES = "file_path string, line_number bigint, raw string"

ABUSE_BODY = """data struct<
  ipAddress: string, abuseConfidenceScore: int, countryCode: string, countryName: string,
  isWhitelisted: boolean, totalReports: int, numDistinctUsers: int, lastReportedAt: string,
  categories: array<int>>"""

VT_BODY = """data struct<id: string, attributes: struct<
  last_analysis_stats: struct<harmless: int, malicious: int, suspicious: int, undetected: int>,
  total_votes: map<string, int>, reputation: int, last_analysis_date: string>>"""

FRAMES = "capture string, packet_id bigint, ts timestamp_ntz, orig_len bigint, frame binary, link int"

ALERTS = """severity string, category string, description string, source_ip string,
  destination_ip string, evidence array<string>, ts timestamp_ntz"""

IOCS = """type string, value string, context string, first_seen timestamp_ntz,
  last_seen timestamp_ntz, confidence int"""
