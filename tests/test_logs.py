from datetime import datetime

import pytest
from pyspark.sql import functions as F

from watchfold.operators import detect, intel, summary
from watchfold.operators.logs import detect_format, parse_logs, rejects

COMBINED = '10.77.3.9 - - [28/Mar/2024:07:08:09 +0100] "PUT /cart/7 HTTP/2" 204 77 "https://shop.test/a" "probe/3.1"'
COMMON = '198.18.5.6 - eve [02/Apr/2024:23:59:01 +0000] "DELETE /item/12 HTTP/1.0" 403 88'
DEFAULT = '198.18.5.6 - - [02/Apr/2024:23:58:00 +0000] "HEAD /feed HTTP/1.1" 206 3141'
UPSTREAM = '198.18.5.6 - eve [02/Apr/2024:23:58:00 +0000] "GET / HTTP/1.1" 200 4523 0.1 0.2 "agent x"'
FAILED = "Nov 21 04:05:06 gate7 sshd[88]: Failed password for carol from 198.18.5.6 port 50022 ssh2"
INVALID = "Nov  2 04:05:06 gate7 sshd[88]: Failed password for invalid user dave from 198.18.9.9 port 50022 ssh2"
ACCEPTED = "Nov 21 04:05:06 gate7 sshd[88]: Accepted publickey for erin from 192.0.2.77 port 50022 ssh2"


def lines(spark, *texts):
    rows = [("f", i + 1, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "file_path string, line_number bigint, raw string")


def parsed(spark, *texts, **options):
    options.setdefault("year", 2024)
    rows = parse_logs(lines(spark, *texts), **options).orderBy("line_number").collect()
    return rows if len(texts) > 1 else (rows[0] if rows else None)


def test_every_format_is_detected(spark):
    texts = (COMBINED, DEFAULT, UPSTREAM, COMMON, FAILED, ACCEPTED, "only 10.0.0.1 here", "nothing")
    found = detect_format(lines(spark, *texts)).orderBy("line_number").collect()
    assert [r.format for r in found] == [
        "apache_combined",
        "nginx_default",
        "nginx_upstream",
        "apache_common",
        "ssh_failed",
        "ssh_accepted",
        "generic",
        "generic",
    ]


def test_combined_line(spark):
    row = parsed(spark, COMBINED)
    assert (row.ip_address, row.status_code, row.response_size) == ("10.77.3.9", 204, 77)
    assert (row.user_agent, row.http_method, row.request_path) == ("probe/3.1", "PUT", "/cart/7")
    assert row.event_time == datetime(2024, 3, 28, 7, 8, 9)
    assert row.timestamp_raw == "28/Mar/2024:07:08:09 +0100"
    assert row.username is None and row.login_status is None


@pytest.mark.parametrize("alias", ["apache", "apache2", "apache_combined"])
def test_aliases_extract_fields(spark, alias):
    assert parsed(spark, COMBINED, fmt=alias).status_code == 204


def test_a_line_of_another_format_keeps_its_address_only(spark):
    row = parsed(spark, COMMON, fmt="apache")
    assert (row.format, row.ip_address, row.status_code, row.event_time) == (
        "generic",
        "198.18.5.6",
        None,
        None,
    )
    assert parsed(spark, ACCEPTED, fmt="ssh").username is None
    assert parsed(spark, FAILED, fmt="ssh").username == "carol"


def test_unknown_names_are_refused(spark):
    with pytest.raises(ValueError, match="format"):
        parse_logs(lines(spark, COMMON), "iis")
    with pytest.raises(ValueError, match="detect"):
        parse_logs(lines(spark, COMMON), detect="sometimes")


def test_upstream_agent(spark):
    assert parsed(spark, UPSTREAM).user_agent == "agent x"
    assert parsed(spark, UPSTREAM, fmt="nginx").format == "generic"


def test_ssh_lines(spark):
    failed, invalid, accepted = parsed(spark, FAILED, INVALID, ACCEPTED)
    assert (failed.username, failed.login_status, failed.ip_address) == ("carol", "failed", "198.18.5.6")
    assert (invalid.username, invalid.ip_address) == ("dave", "198.18.9.9")
    assert invalid.event_time == datetime(2024, 11, 2, 4, 5, 6)
    assert (accepted.username, accepted.login_status) == ("erin", "accepted")


def test_odd_values(spark):
    row = parsed(spark, DEFAULT.replace(" 206 3141", " 000 -"))
    assert (row.status_code, row.response_size) == (0, None)
    row = parsed(spark, DEFAULT.replace("02/Apr/2024:23:58:00 +0000", " "))
    assert row.event_time is None and row.status_code == 206
    row = parsed(spark, DEFAULT.replace("02/Apr", "31/Feb"))
    assert row.event_time is None and row.timestamp_raw.startswith("31/Feb")
    row = parsed(spark, DEFAULT.replace("198.18.5.6", "2001:db8::1"))
    assert (row.ip_address, row.format) == ("2001:db8::1", "nginx_default")
    row = parsed(spark, COMBINED.replace('"probe/3.1"', '""'))
    assert (row.format, row.user_agent) == ("apache_combined", "")
    row = parsed(spark, FAILED.replace("Nov 21", "Feb 29"), year=2023)
    assert row.event_time is None and row.timestamp_raw == "Feb 29 04:05:06"


def test_other_line_separators_are_ordinary_characters(spark):
    row = parsed(spark, COMBINED.replace("probe/3.1", "a\u2028b\u0085c") + " tail\u2029")
    assert (row.format, row.user_agent) == ("apache_combined", "a\u2028b\u0085c")
    assert parsed(spark, COMBINED.replace("probe/3.1", "a\nb")).user_agent == "a b"


def test_text_of_the_line_is_trimmed_but_matched_as_it_is(spark):
    row = parsed(spark, f"  {DEFAULT}\t")
    assert row.raw == DEFAULT and row.format == "generic" and row.status_code is None
    assert parsed(spark, DEFAULT + " \r\n").format == "nginx_default"


def test_strict_addresses(spark):
    assert parsed(spark, "x 300.1.2.3 y").ip_address == "00.1.2.3"
    assert parsed(spark, "x 300.1.2.3 y", strict=True) is None
    assert parsed(spark, DEFAULT, strict=True).ip_address == "198.18.5.6"


def test_rejects_are_the_rest(spark):
    texts = (COMBINED, "std::map", "", "   ", "1.2.3.4", FAILED)
    everything = lines(spark, *texts)
    kept = {r.line_number for r in parse_logs(everything, year=2024).collect()}
    dropped = {r.line_number for r in rejects(everything).collect()}
    assert kept == {1, 5, 6} and dropped == {2, 3, 4}


def test_first_line_decides_for_the_file(spark):
    rows = [("a", 1, ACCEPTED), ("a", 2, FAILED), ("b", 1, FAILED), ("b", 2, ACCEPTED), ("c", 1, "junk"), ("c", 2, DEFAULT)]
    df = spark.createDataFrame(rows, "file_path string, line_number bigint, raw string")
    out = parse_logs(df, detect="file", year=2024)
    found = {(r.file_path, r.line_number): (r.format, r.username) for r in out.collect()}
    assert found == {
        ("a", 1): ("ssh_accepted", "erin"),
        ("a", 2): ("generic", None),
        ("b", 1): ("ssh_failed", "carol"),
        ("b", 2): ("generic", None),
        ("c", 2): ("generic", None),
    }


def test_lines_without_numbers_have_no_first_one(spark):
    df = lines(spark, FAILED).withColumn("line_number", F.lit(None).cast("bigint"))
    with pytest.raises(Exception, match="numbered lines"):
        parse_logs(df, detect="file").collect()


def test_patterns_run_once(spark):
    plan = parse_logs(lines(spark, COMBINED))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace(") == 1


def feeds(spark):
    abuse = spark.createDataFrame(
        [("1.1.1.1", 90, "Land", 5), ("2.2.2.2", 50, None, 0), ("3.3.3.3", 10, "Land", 1)],
        "ip_address string, abuse_confidence_score int, country_name string, total_reports int",
    )
    vt = spark.createDataFrame(
        [("3.3.3.3", 1), ("4.4.4.4", 0), ("9.9.9.9", 7)], "ip_address string, malicious int"
    )
    return abuse, vt


def test_enrichment_and_flags(spark):
    abuse, vt = feeds(spark)
    ips = spark.createDataFrame([(f"{i}.{i}.{i}.{i}",) for i in (1, 1, 2, 3, 4, 5)], "ip_address string")
    known = intel.enrich(ips, abuse, vt)
    assert {r.ip_address for r in known.collect()} == {"1.1.1.1", "2.2.2.2", "3.3.3.3", "4.4.4.4"}
    table = intel.flagged_table(known, limit=10).collect()
    assert [(r.ip_address, r.abuse_score, r.vt_malicious, r.country, r.risk_tier) for r in table] == [
        ("1.1.1.1", 90, 0, "Land", "HIGH"),
        ("2.2.2.2", 50, 0, "Unknown", "MEDIUM"),
        ("3.3.3.3", 10, 1, "Land", "LOW"),
    ]
    assert {r.ip_address for r in intel.flagged_table(known, 70).collect()} == {"1.1.1.1", "3.3.3.3"}
    assert [r.ip_address for r in intel.flagged_table(known, limit=1).collect()] == ["1.1.1.1"]


def test_a_feed_with_two_rows_for_an_address_counts_once(spark):
    abuse, vt = feeds(spark)
    more = abuse.union(spark.createDataFrame([("1.1.1.1", 95, "Land", 5), ("1.1.1.1", 20, "Land", 9)], abuse.schema))
    ips = spark.createDataFrame([("1.1.1.1",), ("1.1.1.1",)], "ip_address string")
    rows = intel.attach(ips, more, vt.union(vt)).collect()
    assert [r.abuse.abuse_confidence_score for r in rows] == [95, 95]


def test_summary_of_no_entries(spark):
    abuse, vt = feeds(spark)
    none = parse_logs(lines(spark, "nothing here"))
    row = summary.log_summary(none, intel.enrich(none, abuse, vt)).first()
    assert (row.total_entries, row.unique_ips, row.flagged_ips, row.status_code_distribution) == (0, 0, 0, {})


def test_samples_are_the_first_lines_and_bounded(spark):
    rows = [("1.1.1.1", datetime(2024, 1, 1, 0, 0, i % 60), f"line {i:04d}") for i in range(500)]
    entries = spark.createDataFrame(rows, "ip_address string, event_time timestamp_ntz, raw string")
    out = summary.sample_lines(entries.repartition(8), 3)
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()
    assert out.first().raw_log_entries == ["line 0000", "line 0060", "line 0120"]


def test_list_update(spark):
    def frame(*ips):
        return spark.createDataFrame([(i,) for i in ips], "ip_address string")

    out = summary.update_list(frame("a", "a", "b"), remove=frame("b", "c"), add=frame("c", "d"))
    assert sorted(r.ip_address for r in out.collect()) == ["a", "c", "d"]


def test_brute_force_threshold_is_inclusive(spark):
    entries = parse_logs(lines(spark, *[FAILED] * 3, INVALID, ACCEPTED), year=2024)
    rows = detect.brute_force(entries, 3, "10 minutes").collect()
    assert [(r.ip_address, r.failures, r.window_start) for r in rows] == [
        ("198.18.5.6", 3, datetime(2024, 11, 21, 4, 0))
    ]
    assert detect.brute_force(entries, 4, "10 minutes").count() == 0


def test_odd_agents(spark):
    def entry(ip, agent):
        return (ip, agent)

    rows = [entry("a", None), entry("a", "curl/7"), entry("a", "Rare"), entry("a", "Usual"), entry("b", "Usual")]
    df = spark.createDataFrame(rows, "ip_address string, user_agent string")
    found = {r.user_agent: r.reason for r in detect.odd_agent(df, 2).collect()}
    assert found == {None: "absent", "curl/7": "tool", "Rare": "rare"}


def test_status_table_knows_its_texts(spark):
    df = spark.createDataFrame([(200,), (404,), (404,), (0,), (None,), (418,)], "status_code int")
    found = {r.status_code: (r.n, r.description) for r in summary.status_table(df).collect()}
    assert found == {
        200: (1, "Successful requests"),
        404: (2, "Not found - directory enumeration"),
        418: (1, None),
    }


def test_approximate_and_exact_counts_agree_on_little_data(spark):
    df = spark.createDataFrame([(str(i % 7),) for i in range(100)], "ip_address string")
    assert summary.unique_ip_count(df).first()[0] == 7
    assert summary.unique_ip_count(df, approximate=True).first()[0] == 7
    assert summary.top_ips(df, 2).collect() == df.groupBy("ip_address").agg(
        F.count("*").alias("request_count")
    ).orderBy(F.desc("request_count"), "ip_address").limit(2).collect()
