import random
import statistics
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from watchfold.operators import detect, ioc, report, traffic

START = datetime(2024, 1, 1)
SCHEMA = """packet_id bigint, ts timestamp_ntz, src_ip string, dst_ip string, src_port int, dst_port int,
  protocol string, length int, flag_bits int, payload binary, dns_query string, dns_response string,
  http_method string, http_uri string, http_host string"""


def packet(i, src="10.0.0.1", dst="8.8.8.8", sport=1, dport=80, **more):
    row = {
        "packet_id": i,
        "ts": START + timedelta(seconds=i),
        "src_ip": src,
        "dst_ip": dst,
        "src_port": sport,
        "dst_port": dport,
        "protocol": "TCP",
        "length": 100,
        "flag_bits": 16,
        "payload": bytearray(b""),
        "dns_query": None,
        "dns_response": None,
        "http_method": None,
        "http_uri": None,
        "http_host": None,
    }
    row.update(more)
    return row


def frame(spark, *rows):
    return spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)


def test_flows_against_a_plain_loop(spark):
    rng = random.Random(7)
    hosts = ["10.0.0.1", "10.0.0.2", "9.9.9.9"]
    rows = []
    for i in range(400):
        src, dst = rng.choice(hosts), rng.choice(hosts)
        ts = START + timedelta(seconds=rng.randrange(60))
        rows.append(
            packet(i, src, dst, rng.choice([1, 80]), rng.choice([1, 80]), ts=ts, flag_bits=rng.choice([None, 0, 2, 16, 18, 24, 1]),
                   protocol=rng.choice(["TCP", "UDP"]), length=rng.randrange(1000))
        )
    expected = {}
    for r in sorted(rows, key=lambda r: (r["ts"], r["packet_id"])):
        ends = sorted([(r["src_ip"], r["src_port"]), (r["dst_ip"], r["dst_port"])])
        first = (r["src_ip"], r["src_port"], r["dst_ip"], r["dst_port"])
        flow = expected.setdefault((r["protocol"], *ends), [first, r["ts"], r["ts"], 0, 0, set()])
        flow[2] = r["ts"]
        flow[3] += 1
        flow[4] += r["length"]
        text = {2: "SYN", 16: "ACK", 18: "SYN,SYN-ACK,ACK", 24: "ACK,PSH", 1: "FIN"}.get(r["flag_bits"])
        flow[5] |= {text} if text else set()
    got = {
        (r.protocol, *sorted([(r.src_ip, r.src_port), (r.dst_ip, r.dst_port)])): [
            (r.src_ip, r.src_port, r.dst_ip, r.dst_port), r.start_time, r.end_time, r.packet_count, r.byte_count, set(r.flags),
        ]
        for r in traffic.flows(frame(spark, *rows)).collect()
    }
    assert got == expected
    assert sum(f[3] for f in got.values()) == len(rows)


def test_crossed_ports_are_two_flows(spark):
    rows = [packet(0, "a", "b", 80, 443), packet(1, "a", "b", 443, 80), packet(2, "b", "a", 443, 80)]
    assert sorted(r.packet_count for r in traffic.flows(frame(spark, *rows)).collect()) == [1, 2]


def test_flows_hash_aggregate(spark):
    plan = traffic.flows(frame(spark, packet(0)))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan and "Window" not in plan


def gaps(times):
    times = sorted(times)
    return [(b - a).total_seconds() for a, b in zip(times, times[1:])]


@pytest.mark.parametrize("spans", [(60,), (60, 86400), (1,), ()])
def test_gap_statistics_against_a_plain_loop(spark, spans):
    rng = random.Random(3)
    times = defaultdict(list)
    for i in range(600):
        key = rng.choice(["a", "b"])
        times[key].append(START + timedelta(microseconds=rng.randrange(400_000_000_000)))
        if i % 5 == 0:
            times[key].append(times[key][-1])
    times["even"] = [START + timedelta(seconds=300 * i) for i in range(50)]
    times["one"] = [START]
    rows = [(k, t) for k, ts in times.items() for t in ts]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz")
    got = {r.k: (r.gaps, r.mean_gap, r.sd_gap) for r in detect.gap_statistics(df, ["k"], spans=spans).collect()}
    assert set(got) == {"a", "b", "even"}
    for key, (count, mean, sd) in got.items():
        own = gaps(times[key])
        assert count == len(own)
        assert mean == pytest.approx(statistics.fmean(own))
        assert sd == pytest.approx(statistics.pstdev(own), abs=1e-6)


def test_beacons_are_even(spark):
    even = [packet(i, "10.0.0.1", "1.1.1.1", ts=START + timedelta(seconds=300 * i)) for i in range(20)]
    odd = [packet(i, "10.0.0.2", "1.1.1.1", ts=START + timedelta(seconds=i * i * 40)) for i in range(20)]
    rows = detect.beaconing(frame(spark, *even, *odd)).collect()
    assert [(r.src_ip, r.gaps, r.mean_gap, r.sd_gap) for r in rows] == [("10.0.0.1", 19, 300.0, 0.0)]


def test_syn_thresholds_are_exclusive(spark):
    rows = [packet(i, dport=22, flag_bits=2) for i in range(50)] + [packet(99, dport=22, flag_bits=18)]
    assert detect.service_hammering(frame(spark, *rows)).count() == 0
    rows.append(packet(100, dport=22, flag_bits=2))
    alert = detect.service_hammering(frame(spark, *rows)).first()
    assert (alert.severity, alert.destination_ip, alert.source_ip) == ("high", "8.8.8.8", None)
    assert alert.description == "Host 8.8.8.8 received 51 connection attempts on port 22"
    assert alert.ts == START + timedelta(seconds=100)
    assert detect.syn_flood(frame(spark, *rows)).count() == 0
    assert detect.syn_flood(frame(spark, *rows), n=50).first().severity == "critical"
    assert detect.syn_flood(frame(spark, *rows), n=50, by="dst_ip").first().destination_ip == "8.8.8.8"
    assert detect.syn_flood(frame(spark, packet(0))).count() == 0


def test_port_scan(spark):
    rows = [packet(i, dport=i % 7) for i in range(50)]
    assert detect.port_scan(frame(spark, *rows), 7).first().ports == 7
    assert detect.port_scan(frame(spark, *rows), 8).count() == 0


def test_keywords_count_wherever_they_stand(spark):
    rows = [
        packet(0, payload=bytearray(b"x" * 95 + b"token")),
        packet(1, payload=bytearray(b"x" * 96 + b"token")),
        packet(2, payload=bytearray(b"PASS\xffWORD and secret")),
        packet(3, payload=bytearray(b"monkey")),
    ]
    got = detect.sensitive_keyword(frame(spark, *rows), payload_bytes=100).orderBy("ts").collect()
    assert [a.description for a in got] == [
        'Sensitive keyword "token" found in traffic',
        'Sensitive keyword "password" found in traffic',
    ]
    assert detect.sensitive_keyword(frame(spark, *rows)).count() == 3
    assert detect.keyword_volume(frame(spark, *rows), 3).first().hits == 4
    assert detect.keyword_volume(frame(spark, *rows), 3, payload_bytes=100).first().hits == 3


def test_long_queries(spark):
    rows = [packet(0, dns_query="q" * 50), packet(1, dns_query="q" * 51)]
    (alert,) = detect.dns_tunnel(frame(spark, *rows)).collect()
    assert alert.evidence == ["Query: " + "q" * 50 + "..."] and alert.severity == "medium"


def test_all_alerts_is_the_union_of_the_detectors(spark):
    rows = [packet(i, dport=22, flag_bits=2, payload=bytearray(b"secret"), dns_query="d" * 60) for i in range(120)]
    df = frame(spark, *rows)
    parts = detect.service_hammering(df).unionByName(detect.syn_flood(df))
    parts = parts.unionByName(detect.sensitive_keyword(df)).unionByName(detect.dns_tunnel(df))
    together = detect.all_alerts(df)
    assert together.count() == 242
    assert together.exceptAll(parts).count() == 0 and parts.exceptAll(together).count() == 0


def test_lateral_movement_stays_inside(spark):
    rows = [
        packet(0, "10.0.0.1", "192.168.0.1", dport=445),
        packet(1, "10.0.0.1", "8.8.8.8", dport=445),
        packet(2, "10.0.0.1", "192.168.0.1", dport=446),
        packet(3, "10.0.0.1", "192.168.0.1", dport=445, protocol="UDP"),
    ]
    assert [r.packets for r in detect.lateral_movement(frame(spark, *rows)).collect()] == [1]


def test_known_bad_domains(spark):
    rows = [packet(0, http_host="Bad.com"), packet(1, dns_query="bad.com."), packet(2, dns_query="good.com")]
    feed = spark.createDataFrame([("bad.com",), ("bad.com",)], "domain string")
    assert [(r.domain, r.packets) for r in detect.bad_domain(frame(spark, *rows), feed).collect()] == [("bad.com", 2)]


def test_entropy_of_subdomains(spark):
    rows = [packet(0, dns_query="ab.x.com"), packet(1, dns_query="ab.x.com."), packet(2, dns_query="x.com"), packet(3, dns_query="aaaa.y.com")]
    got = {r.parent: (r.queries, r.subdomains, r.mean_length, r.entropy) for r in detect.subdomain_stats(frame(spark, *rows)).collect()}
    assert got == {"x.com": (2, 1, 2.0, 1.0), "y.com": (1, 1, 4.0, 0.0)}


def test_confidence_counts_an_alert_once_per_address(spark):
    df = frame(spark, *[packet(i, "1.1.1.1") for i in range(101)])
    rows = [("high", "1.1.1.1", "1.1.1.1"), ("medium", None, "1.1.1.1"), ("low", "1.1.1.1", None), ("critical", "2.2.2.2", None)]
    alerts = spark.createDataFrame(rows, "severity string, source_ip string, destination_ip string")
    assert [(r.n, r.confidence) for r in ioc.ip_confidence(df, alerts).collect()] == [(101, 65)]
    many = alerts.unionByName(alerts).unionByName(alerts)
    assert ioc.ip_confidence(df, many).first().confidence == 100


def test_only_public_busy_sources_are_indicators(spark):
    df = spark.range(3003).select(
        F.when(F.col("id") % 3 == 0, "10.0.0.1").when(F.col("id") % 3 == 1, "1.1.1.1").otherwise("2001:db8::1").alias("src_ip"),
        F.lit(START).cast("timestamp_ntz").alias("ts"),
    )
    assert {r.src_ip for r in ioc.suspicious_ips(df).collect()} == {"1.1.1.1", "2001:db8::1"}
    assert ioc.suspicious_ips(df.limit(3000)).count() == 0


def test_url_and_domain_indicators(spark):
    rows = [
        packet(0, http_method="GET", http_uri="/../a", http_host="h"),
        packet(1, http_method="GET", http_uri="/../a", http_host="h"),
        packet(2, http_method="POST", http_uri="/--", http_host=None),
        packet(3, http_method="GET", http_uri="/fine", http_host="h"),
        packet(4, dns_query="evil.top."),
    ]
    df = frame(spark, *rows)
    assert sorted((r.value, r.context) for r in ioc.url_iocs(df).collect()) == [
        ("/--", "HTTP POST request"), ("http://h/../a", "HTTP GET request"), ("http://h/../a", "HTTP GET request"),
    ]
    merged = ioc.url_iocs(df, dedup=True).filter("value = 'http://h/../a'").first()
    assert merged.last_seen - merged.first_seen == timedelta(seconds=1)
    assert [r.value for r in ioc.domain_iocs(df).collect()] == ["evil.top"]


def test_text_tokens(spark):
    text = "a.b+c@mail.example.com, x@y and " + "0" * 31 + " " + "A" * 32 + " " + "b" * 40 + " " + "c" * 64 + " " + "d" * 65
    df = spark.createDataFrame([(text,)], "text string")
    assert [r.value for r in ioc.email_iocs(df).collect()] == ["a.b+c@mail.example.com"]
    assert [(r.value, r.context) for r in ioc.hash_iocs(df).collect()] == [
        ("a" * 32, "md5 token"), ("b" * 40, "sha1 token"), ("c" * 64, "sha256 token"),
    ]


def test_token_patterns_run_once(spark):
    df = spark.createDataFrame([("x",)], "text string")
    for tokens in (ioc.email_iocs(df), ioc.hash_iocs(df)):
        plan = tokens._jdf.queryExecution().executedPlan().toString()
        assert plan.count("regexp_extract_all(") == 1 and "RLIKE" not in plan


def test_endpoint_figures(spark):
    rows = [packet(0, "a", "b"), packet(1, "a", "c"), packet(2, "b", "c", length=5)]
    assert tuple(traffic.endpoint_summary(frame(spark, *rows)).first()) == (3, 205, 2, 2)
    assert tuple(traffic.unique_endpoints(frame(spark, *rows)).first()) == (2, 2)
    assert tuple(traffic.endpoint_summary(frame(spark, *rows).filter("false")).first()) == (0, 0, 0, 0)


def test_report_tables_survive_absent_fields(spark):
    rows = [packet(0, http_method="GET", http_uri=None), packet(1, dns_query="d" * 31, dns_response="1.2.3.4"), packet(2, dns_query="d" * 31)]
    df = frame(spark, *rows)
    assert [(r.host, r.uri) for r in report.http_sample(df).collect()] == [("", "")]
    assert [r.response for r in report.suspicious_dns(df).collect()] == ["1.2.3.4"]


def test_shares_add_up(spark):
    rows = [packet(i, protocol="UDP" if i % 3 else "TCP") for i in range(9)]
    assert {(r.protocol, r.n, r.pct) for r in traffic.by_protocol(frame(spark, *rows)).collect()} == {
        ("UDP", 6, 66.6667), ("TCP", 3, 33.3333),
    }
    assert tuple(traffic.totals(frame(spark, *rows)).first()) == (9, 900)
    assert tuple(traffic.totals(frame(spark, *rows).filter("false")).first()) == (0, 0)
