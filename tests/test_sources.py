import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from watchfold.operators.logs import parse_logs
from watchfold.plans import analyze_capture, analyze_logs
from watchfold.sources import sinks
from watchfold.sources.feeds import read_abuse, read_vt
from watchfold.sources.log_lines import read_log_lines


def test_lines_are_numbered_per_file_over_many_splits(spark, tmp_path):
    for name, count in (("a", 5000), ("b", 1), ("c", 700)):
        (tmp_path / f"{name}.log").write_text("".join(f"{i + 1} {'x' * (i % 90)}\n" for i in range(count)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        lines = read_log_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 8
        wrong = lines.filter(F.split_part("raw", F.lit(" "), F.lit(1)).cast("bigint") != F.col("line_number"))
        assert wrong.count() == 0 and lines.count() == 5701
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_line_ends_and_bad_bytes(spark, tmp_path):
    (tmp_path / "a.log").write_bytes(b"one\ntwo\r\nth\xffree\rfour\n\nsix")
    rows = read_log_lines(spark, str(tmp_path / "a.log")).orderBy("line_number").collect()
    assert [(r.line_number, r.raw) for r in rows] == list(enumerate(["one", "two", "three", "four", "", "six"], 1))
    assert rows[0].file_path.endswith("a.log")
    unnumbered = read_log_lines(spark, str(tmp_path / "a.log"), numbered=False)
    assert unnumbered.count() == 6 and unnumbered.filter("line_number is not null").count() == 0


def test_missing_files_are_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_log_lines(spark, str(tmp_path / "none.log"))


def test_abuse_responses(spark, tmp_path):
    bodies = [
        {"data": {"ipAddress": "1.1.1.1", "abuseConfidenceScore": 90, "categories": [18, 22], "isWhitelisted": None}},
        {"data": {"ipAddress": "1.1.1.1", "abuseConfidenceScore": 95, "lastReportedAt": "2024-01-15T10:00:00+00:00"}},
        {"data": {"ipAddress": "2.2.2.2", "abuseConfidenceScore": None}},
        {"errors": [{"detail": "no"}]},
    ]
    (tmp_path / "a.json").write_text("\n".join(map(json.dumps, bodies)) + "\nnot json\n")
    rows = {r.ip_address: r for r in read_abuse(spark, str(tmp_path)).collect()}
    assert set(rows) == {"1.1.1.1", "2.2.2.2"}
    assert (rows["1.1.1.1"].abuse_confidence_score, rows["1.1.1.1"].categories) == (95, [])
    row = rows["2.2.2.2"]
    assert (row.abuse_confidence_score, row.total_reports, row.is_whitelisted) == (0, 0, False)


def test_engine_responses(spark):
    body = {"data": {"attributes": {"last_analysis_stats": {"malicious": 3}, "last_analysis_date": 1705312800}}}
    source = spark.createDataFrame([("1.1.1.1", json.dumps(body)), ("2.2.2.2", "{}")], "ip_address string, body string")
    (row,) = read_vt(spark, source).collect()
    assert (row.ip_address, row.malicious, row.harmless, row.reputation) == ("1.1.1.1", 3, 0, 0)
    assert row.total_votes == {} and row.last_analysis_date == "1705312800"


LINE = '{ip} - - [10/Jan/2024:13:55:36 +0000] "GET / HTTP/1.1" {status} 10 "-" "a"'


def test_log_analysis_end_to_end(spark, tmp_path):
    text = [LINE.format(ip=f"1.1.1.{i % 3}", status=200 if i % 4 else 404) for i in range(40)]
    (tmp_path / "access.log").write_text("\n".join(text))
    abuse = spark.createDataFrame(
        [("1.1.1.0", 85, "X", "Xland", False, 3, 1)],
        "ip_address string, abuse_confidence_score int, country_code string, country_name string,"
        " is_whitelisted boolean, total_reports int, num_distinct_users int",
    )
    vt = spark.createDataFrame([("1.1.1.1", 0, 0, 9, 1)], "ip_address string, malicious int, suspicious int, harmless int, undetected int")
    run = analyze_logs(spark, str(tmp_path / "access.log"), abuse, vt)
    row = run.summary.first()
    assert (row.total_entries, row.unique_ips, row.flagged_ips, row.malicious_ips, row.high_risk_ips) == (40, 3, 1, 0, 1)
    assert row.status_code_distribution == {200: 30, 404: 10}
    assert [r.ip_address for r in run.flagged.collect()] == ["1.1.1.0"]
    assert run.details.count() == 2
    limited = analyze_logs(spark, str(tmp_path / "access.log"), abuse, vt, max_ips=1)
    assert [r.ip_address for r in limited.details.collect()] == ["1.1.1.0"]

    parts = sinks.write_report(run.entries, run.enriched, run.summary, str(tmp_path / "out"), "access.log", datetime(2024, 1, 1))
    header = json.loads(spark.read.text(parts["report"]).first()[0])
    assert len(header["report_metadata"]["analysis_id"]) == 12
    assert header["summary"]["total_entries"] == 40
    assert spark.read.json(parts["log_entries"]).count() == 40
    with pytest.raises(Exception, match="already exists"):
        sinks.write_report(run.entries, run.enriched, run.summary, str(tmp_path / "out"), "access.log", datetime(2024, 1, 1))


def test_capture_analysis_end_to_end(spark, tmp_path):
    from tests.test_captures import ipv4, tcp, write

    frames = [ipv4(6, tcp(b"", 1024 + i, 22, 2), src="8.8.8.8") for i in range(120)]
    frames += [ipv4(6, tcp(b"my password is", dport=25), src="8.8.8.8")]
    write(tmp_path / "in", frames)
    run = analyze_capture(spark, str(tmp_path / "in"), table=str(tmp_path / "packets"))
    row = run.overview.first()
    assert (row.total_packets, row.unique_sources, row.alerts, row.iocs) == (121, 1, 3, 0)
    assert {(r.severity, r.n) for r in run.severities.collect()} == {("critical", 1), ("high", 2), ("medium", 0), ("low", 0)}
    assert [r.severity for r in run.severities.collect()] == ["critical", "high", "medium", "low"]
    assert run.flows.count() == 121 and run.timeline.count() == 3


def test_ioc_export_and_blocklist(spark, tmp_path):
    rows = [("ip", "1.1.1.1", "c", None, None, 90), ("ip", "1.1.1.1", "d", None, None, 80), ("url", "http://x", "c", None, None, 60)]
    iocs = spark.createDataFrame(rows, "type string, value string, context string, first_seen timestamp_ntz, last_seen timestamp_ntz, confidence int")
    parts = sinks.write_iocs(iocs, str(tmp_path / "iocs"), datetime(2024, 1, 1, 12))
    header = json.loads(spark.read.text(parts["export"]).first()[0])
    assert header == {"exported_at": "2024-01-01T12:00:00", "ioc_count": 3}
    sinks.write_blocklist(iocs, str(tmp_path / "block"))
    assert [r.value for r in spark.read.text(str(tmp_path / "block")).collect()] == ["1.1.1.1"]


def test_rerun_with_one_partition_agrees(spark, tmp_path):
    from watchfold.operators import summary

    (tmp_path / "a.log").write_text("\n".join(LINE.format(ip=f"1.1.1.{i % 9}", status=200) for i in range(99)))
    results = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        entries = parse_logs(read_log_lines(spark, str(tmp_path / "a.log")))
        results.append(sorted(map(tuple, summary.ip_counts(entries).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] and sum(n for _, n in results[0]) == 99
