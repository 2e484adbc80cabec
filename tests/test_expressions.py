import ipaddress
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from watchfold import functions as fn


def values(spark, inputs, column):
    """Results of a column of ``v`` over input values, in order."""
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, "i int, v string")
    return [r.out for r in df.select("i", column(F.col("v")).alias("out")).orderBy("i").collect()]


def test_first_address_of_a_text(spark):
    cases = {
        "from 10.0.0.1 to 10.0.0.2": "10.0.0.1",
        "2001:db8::1 says": "2001:db8::1",
        "at [2001:db8:0:0:0:0:0:1], then": "2001:db8:0:0:0:0:0:1",
        "see fe80::1%eth0.": "fe80::1%eth0",
        "x ::ffff:1.2.3.4 y": "::ffff:1.2.3.4",
        "loop ::1": "::1",
        "std::map<int>": None,
        "a::b is code, 12:30:45 a time": "a::b",
        "300.1.2.3": "00.1.2.3",
        "1.2.3.4567": "1.2.3.45",
        "no address": None,
        "": None,
    }
    assert values(spark, cases, fn.extract_ip) == list(cases.values())


def test_strict_addresses_need_boundaries(spark):
    cases = {
        "300.1.2.3": None,
        "1.2.3.4567": None,
        "1.2.3.4.5 then 9.9.9.9": "9.9.9.9",
        "ok 10.1.2.3.": "10.1.2.3",
    }
    assert values(spark, cases, lambda c: fn.extract_ip(c, strict=True)) == list(cases.values())


@settings(max_examples=15, deadline=None)
@given(st.lists(st.ip_addresses(), min_size=1, max_size=30))
def test_any_address_is_found_whole(spark, addresses):
    texts = [f"client {a} said" for a in addresses]
    assert values(spark, texts, fn.extract_ip) == [str(a) for a in addresses]


def test_private_addresses_match_the_networks(spark):
    edges = ["9.255.255.255", "10.0.0.0", "10.255.255.255", "11.0.0.0", "126.0.0.1", "127.0.0.1"]
    edges += ["172.15.255.255", "172.16.0.0", "172.31.255.255", "172.32.0.0", "128.0.0.0"]
    edges += ["192.167.255.255", "192.168.0.0", "192.168.255.255", "192.169.0.0", "8.8.8.8"]
    networks = [ipaddress.ip_network(n) for n in ("10.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16", "127.0.0.0/8")]
    expected = [any(ipaddress.ip_address(e) in n for n in networks) for e in edges]
    assert values(spark, edges, fn.is_private) == expected
    assert values(spark, ["::1", "fe80::1", "10.1", "", None, "10.0.0.300"], fn.is_private) == [False] * 6


def test_web_times(spark):
    cases = {
        "10/Jan/2024:13:55:36 +0000": datetime(2024, 1, 10, 13, 55, 36),
        "05/dec/2023:01:02:03": datetime(2023, 12, 5, 1, 2, 3),
        "29/Feb/2024:00:00:00 -0500": datetime(2024, 2, 29),
        "29/Feb/2023:00:00:00 +0000": None,
        "10/Anf/2024:13:55:36 +0000": None,
        "10/Jan/2024:24:55:36 +0000": None,
        " ": None,
        "yesterday": None,
    }
    assert values(spark, cases, fn.web_time) == list(cases.values())


def test_ssh_times_take_the_given_year(spark):
    cases = {
        "Jan 10 13:55:36": datetime(2024, 1, 10, 13, 55, 36),
        "Jan  5 01:02:03": datetime(2024, 1, 5, 1, 2, 3),
        "Feb 29 00:00:00": datetime(2024, 2, 29),
        "Foo 10 13:55:36": None,
    }
    assert values(spark, cases, lambda c: fn.ssh_time(c, 2024)) == list(cases.values())
    assert values(spark, ["Feb 29 00:00:00"], lambda c: fn.ssh_time(c, 2023)) == [None]


def test_times_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 on this day does not exist in that zone
        gap = "10/Mar/2024:02:30:00 +0000"
        assert values(spark, [gap], fn.web_time) == [datetime(2024, 3, 10, 2, 30)]
        seconds = values(spark, [gap], lambda c: fn.epoch_seconds(fn.web_time(c)).cast("string"))
        assert seconds == ["1710037800.000000"]
        from watchfold.functions.times import as_instant, as_local

        back = values(spark, [gap], lambda c: as_local(as_instant(fn.web_time(c))))
        assert back == [datetime(2024, 3, 10, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_flag_names(spark):
    df = spark.createDataFrame([(2,), (18,), (16,), (24,), (17,), (4,), (0,), (32,)], "b int")
    rows = df.select("b", fn.flag_text(F.col("b")).alias("t")).collect()
    assert {r.b: r.t for r in rows} == {
        2: "SYN",
        18: "SYN,SYN-ACK,ACK",
        16: "ACK",
        24: "ACK,PSH",
        17: "ACK,FIN",
        4: "RST",
        0: "",
        32: "",
    }


@pytest.mark.parametrize(
    ("domain", "expected"),
    [
        ("www.example.com", False),
        ("x.evil.xyz", True),
        ("x.evil.XYZ", True),
        ("evilxyz", False),
        ("a" * 51, True),
        ("a" * 50, False),
        ("1234567890123456.example.com", True),
        ("123456789012345.example.com", False),
        ("1234-5678-9012-3456.example.com", False),
        ("12345678aaaaaaaa.example.com", False),
        ("123456789aaaaaaa.example.com", True),
        (None, False),
    ],
)
def test_suspicious_domains(spark, domain, expected):
    assert values(spark, [domain], fn.suspicious_domain) == [expected]


def test_uri_rules(spark):
    cases = {
        "/a/../b": "path_traversal",
        "/a/..\\b": "path_traversal",
        "/q?a=1 UNION select 2": "sql_injection",
        "/q?a=' or '1'='1": "sql_injection",
        "/a--b": "sql_injection",
        "/a/*": "sql_injection",
        "/x;drop TABLE t": "sql_injection",
        "/XP_CMDSHELL": "sql_injection",
        "/u?q=() { :;}": "shellshock",
        "/run?c=/BIN/SH": "command_execution",
        "/CMD.exe": "command_execution",
        "/PowerShell": "command_execution",
        "/plain": None,
        None: None,
    }
    assert values(spark, cases, fn.uri_rule) == list(cases.values())


def test_keywords_in_list_order(spark):
    cases = {
        "TOKEN and Password": "password",
        "api key=abc token=def": "key=",
        "monkey business": None,
        "Secret": "secret",
        None: None,
    }
    assert values(spark, cases, fn.keyword_hit) == list(cases.values())


def test_risk_tiers(spark):
    tiers = values(spark, ["0", "49", "50", "79", "80"], lambda c: fn.risk_tier(c.cast("int")))
    assert tiers == ["LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH"]


def test_bad_bytes_are_dropped_and_real_replacement_marks_kept(spark):
    df = spark.createDataFrame([(bytearray(b"a\xffb\xe2\x82c"),), (bytearray("x�y".encode()),)], "b binary")
    rows = df.select(fn.clean_utf8(F.col("b").cast("string")).alias("t")).collect()
    assert [r.t for r in rows] == ["abc", "x�y"]
