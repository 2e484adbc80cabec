"""Networks and domain suffixes against Python's own rules."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from watchfold.functions import extract_ip
from watchfold.functions.net import address_digits
from watchfold.operators import detect, networks

V6 = ["::", "::1", "2001:db8::1", "2001:db8:0:0:1::", "1:2:3:4:5:6:7:8", "fe80::1%eth0", "64:ff9b::192.0.2.33", "::ffff:1.2.3.4",
      "1:2:3:4:5:6:1.2.3.4", "FEBF::a", "2001:DB8::ff00:42:8329", "::2:3:4:5:6:7:8", "1:2:3:4:5:6:7::"]
V4 = ["10.0.0.1", "10.1.2.3", "0.0.0.0", "255.255.255.255", "192.168.1.77"]


def column(spark, values, make):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", make(F.col("v")).alias("r"))
    return [r["r"] for r in rows.orderBy("i").collect()]


def test_digits_of_addresses(spark):
    expected = [ipaddress.ip_address(a).packed.hex().upper() for a in V4 + V6]
    assert column(spark, V4 + V6, address_digits) == expected
    assert column(spark, ["", None, "10.0.0", "10.0.0.256", "1::2::3", "a.b", "12:30:45"], address_digits) == [None] * 7


def test_addresses_are_found_in_texts(spark):
    texts = [f"x {a} y" for a in V6] + ["from fe80:1:2:3:4:5:6:7%en1, ok", "2001:db8::1%20x"]
    assert column(spark, texts, extract_ip) == [*V6, "fe80:1:2:3:4:5:6:7%en1", "2001:db8::1"]


def brute(addresses, listed):
    out = {}
    for a in addresses:
        try:
            ip = ipaddress.ip_address(a)
        except (ValueError, TypeError):
            continue
        found = []
        for n in listed:
            try:
                net = ipaddress.ip_network(n, strict=False)
            except (ValueError, TypeError):
                continue
            if net.version == ip.version and ipaddress.ip_address(ip.packed) in net:
                found.append((-net.prefixlen, n))
        if found:
            out[a] = min(found)[1]
    return out


NETWORKS = ["10.0.0.0/8", "10.1.0.0/16", "10.1.2.0/23", "10.1.2.3", "10.1.2.3/32", "0.0.0.0/0", "192.168.1.77/29", "2001:db8::/32",
            "2001:db8::/125", "2001:db8::1", "fe80::/10", "::/0", "64:ff9b::/96", "10.0.0.0/33", "::/129", "10.0.0.0/", "nonsense", "", None,
            "10.9.9.9/x", "1.2.3.4/8/9"]


def test_the_most_specific_network_wins(spark):
    rng = random.Random(5)
    addresses = V4 + V6 + [f"10.{rng.randrange(3)}.{rng.randrange(4)}.{rng.randrange(8)}" for _ in range(200)]
    addresses += [str(ipaddress.IPv6Address((0x20010DB8 << 96) + rng.randrange(64))) for _ in range(50)] + ["no address", None]
    df = spark.createDataFrame([(a,) for a in addresses * 2], "ip_address string")
    listed = spark.createDataFrame([(n, f"about {n}") for n in NETWORKS], "network string, note string")
    for some in (NETWORKS, NETWORKS[1:5], NETWORKS[7:9], []):
        nets = listed.filter(F.col("network").isin(some)) if some else listed.limit(0)
        expected = brute(set(addresses), some)
        rows = networks.match_networks(df, nets).collect()
        assert {r["ip_address"]: r["network"] for r in rows} == expected
        assert all(r["note"] == f"about {r['network']}" for r in rows)
        denied = networks.deny_networks(df, nets).count()
        assert denied == 2 * sum(a in expected for a in addresses)
        assert networks.allow_networks(df, nets).count() == 2 * len(addresses) - denied
        assert networks.with_network(df, nets).filter("network is null").count() == 2 * len(addresses) - denied


def test_ranges_are_joined_by_equality(spark):
    df = spark.range(10).select(F.lit("10.0.0.1").alias("ip_address"))
    nets = spark.createDataFrame([("10.0.0.0/8",), ("::/3",)], "network string")
    plan = networks.match_networks(df, nets)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize(
    ("name", "listed"),
    [
        ("a.b.evil.xyz", "evil.xyz"),
        ("EVIL.xyz.", "evil.xyz"),
        ("notevil.xyz", None),
        ("x.deep.evil.xyz", "deep.evil.xyz"),
        ("evil.xyz.com", None),
        ("xyz", None),
        ("one.tk", "tk"),
        (None, None),
    ],
)
def test_names_below_a_listed_domain(spark, name, listed):
    packets = spark.createDataFrame([(name, None, "10.0.0.1", 5)] * 3, "dns_query string, http_host string, src_ip string, ts long")
    feed = spark.createDataFrame([("evil.xyz",), ("Evil.XYZ.",), ("deep.evil.xyz",), ("tk",), ("",), (None,)], "domain string")
    rows = detect.bad_subdomain(packets, feed).collect()
    assert [(r["listed"], r["packets"]) for r in rows] == ([(listed, 3)] if listed else [])
    assert detect.bad_subdomain(packets, feed.limit(0)).collect() == []
