import socket
import struct
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from suite.capture_data import global_header, record
from watchfold.operators.packets import decode
from watchfold.sources import captures
from watchfold.sources.captures import read_frames

MICROS = 1705312800_123456
ETHERNET = b"\x02" * 12


def ipv4(number, body, src="10.0.0.1", dst="10.0.0.2", options=b""):
    ihl = 5 + len(options) // 4
    size = ihl * 4 + len(body)
    head = struct.pack(">BBHHHBBH", 0x40 | ihl, 0, size, 1, 0, 64, number, 0)
    return ETHERNET + b"\x08\x00" + head + socket.inet_aton(src) + socket.inet_aton(dst) + options + body


def ipv6(number, body, src="2001:db8::1", dst="::1"):
    head = struct.pack(">IHBB", 6 << 28, len(body), number, 64)
    pton = [socket.inet_pton(socket.AF_INET6, a) for a in (src, dst)]
    return ETHERNET + b"\x86\xdd" + head + b"".join(pton) + body


def tcp(payload=b"", sport=1024, dport=443, flags=24, options=b""):
    offset = 5 + len(options) // 4
    return struct.pack(">HHIIBBHHH", sport, dport, 1, 1, offset << 4, flags, 0, 0, 0) + options + payload


def udp(payload=b"", sport=1024, dport=9):
    return struct.pack(">HHHH", sport, dport, 8 + len(payload), 0) + payload


def name(text):
    return b"".join(bytes([len(p)]) + p.encode() for p in text.split(".")) + b"\0"


def write(folder: Path, frames, order="<", nanos=False, file="a.pcap"):
    folder.mkdir(exist_ok=True)
    data = global_header(order, nanos)
    for i, frame in enumerate(frames):
        data += record(MICROS + i, frame, order, nanos)
    (folder / file).write_bytes(data)
    return data


def packets(spark, tmp_path, *frames, **options):
    write(tmp_path / "in", frames)
    rows = decode(read_frames(spark, str(tmp_path / "in")), **options).orderBy("packet_id").collect()
    return rows if len(frames) > 1 else (rows[0] if rows else None)


@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("nanos", [False, True])
def test_byte_orders_and_clocks(spark, tmp_path, order, nanos):
    write(tmp_path / "in", [b"first", b"second!"], order, nanos)
    rows = read_frames(spark, str(tmp_path / "in")).orderBy("packet_id").collect()
    assert [(r.packet_id, bytes(r.frame), r.orig_len) for r in rows] == [(24, b"first", 5), (45, b"second!", 7)]
    assert rows[0].ts == datetime(2024, 1, 15, 10, 0, 0, 123456)
    assert rows[0].capture.endswith("/in/a.pcap")


def test_a_cut_off_record_gives_what_is_there(spark, tmp_path):
    data = write(tmp_path / "in", [b"x" * 100, b"y" * 100])
    (tmp_path / "in" / "a.pcap").write_bytes(data[:-40])
    rows = read_frames(spark, str(tmp_path / "in")).orderBy("packet_id").collect()
    assert [len(r.frame) for r in rows] == [100, 60]
    (tmp_path / "in" / "a.pcap").write_bytes(data[:-110])
    assert read_frames(spark, str(tmp_path / "in")).count() == 1


def test_other_files_are_refused(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("no capture at all, but long enough")
    with pytest.raises(Exception, match="not a classic capture"):
        read_frames(spark, str(tmp_path / "in")).collect()
    with pytest.raises(ValueError, match="chunk_bytes"):
        read_frames(spark, str(tmp_path / "in"), chunk_bytes=1000)


def test_a_large_file_is_read_in_parallel_and_in_full(spark, tmp_path):
    frames = [bytes([i % 251]) * (200 + 37 * (i % 300)) for i in range(1500)]
    write(tmp_path / "in", frames)
    chunk = 4 * captures.MAX_RECORD
    whole = read_frames(spark, str(tmp_path / "in"), on_damage="stop")
    parts = read_frames(spark, str(tmp_path / "in"), chunk_bytes=chunk)
    assert parts.rdd.getNumPartitions() >= 6
    assert parts.count() == len(frames)
    assert whole.exceptAll(parts).count() == 0 and parts.exceptAll(whole).count() == 0


def test_payloads_that_look_like_records_do_not_fool_the_split(spark, tmp_path):
    # Each frame carries a small capture of its own, as in a file transfer.
    inner = b"".join(record(MICROS, b"z" * 60) for _ in range(700))
    frames = [inner[: 40_000 + 17 * i] for i in range(120)]
    write(tmp_path / "in", frames)
    got = read_frames(spark, str(tmp_path / "in"), chunk_bytes=4 * captures.MAX_RECORD)
    assert sorted(len(r.frame) for r in got.select("frame").collect()) == sorted(map(len, frames))


def test_long_records_are_read(spark, tmp_path):
    frames = [b"a" * 60, b"b" * 300_000, b"c" * 60, b"d" * 900_000]
    data = bytearray(write(tmp_path / "in", frames))
    data[16:20] = (1 << 20).to_bytes(4, "little")
    (tmp_path / "in" / "a.pcap").write_bytes(data)
    for chunk in (captures.CHUNK_BYTES, 4 * captures.MAX_RECORD):
        rows = read_frames(spark, str(tmp_path / "in"), chunk_bytes=chunk).orderBy("packet_id").collect()
        assert [len(r.frame) for r in rows] == [len(f) for f in frames]


def test_damage_in_a_small_file_fails(spark, tmp_path):
    data = bytearray(write(tmp_path / "in", [b"a" * 100 for _ in range(51)]))
    data[24 + 116 + 8 : 24 + 116 + 12] = b"\xff\xff\xff\x7f"
    (tmp_path / "in" / "a.pcap").write_bytes(data)
    with pytest.raises(Exception, match="damaged record at byte 140"):
        read_frames(spark, str(tmp_path / "in")).count()
    assert read_frames(spark, str(tmp_path / "in"), on_damage="stop").count() == 1
    row = captures.skipped_bytes(spark, str(tmp_path / "in")).first()
    assert (row.damaged_at, row.skipped_bytes) == (140, len(data) - 140)
    with pytest.raises(ValueError, match="on_damage"):
        read_frames(spark, str(tmp_path / "in"), on_damage="ignore")


def test_damage_fails_a_split_read_and_ends_a_serial_one(spark, tmp_path):
    frames = [b"a" * 3000 for _ in range(1000)]
    data = bytearray(write(tmp_path / "in", frames))
    at = 24 + 500 * 3016
    data[at + 8 : at + 12] = b"\xff\xff\xff\x7f"
    (tmp_path / "in" / "a.pcap").write_bytes(data)
    with pytest.raises(Exception, match="on_damage"):
        read_frames(spark, str(tmp_path / "in"), chunk_bytes=4 * captures.MAX_RECORD).count()
    assert read_frames(spark, str(tmp_path / "in"), on_damage="stop").count() == 500


def test_tcp_headers(spark, tmp_path):
    row = packets(spark, tmp_path, ipv4(6, tcp(b"hello", 1025, 443, 18, b"\1" * 8), options=b"\1" * 4))
    assert (row.src_ip, row.dst_ip, row.src_port, row.dst_port) == ("10.0.0.1", "10.0.0.2", 1025, 443)
    assert (row.protocol, row.flag_bits, bytes(row.payload)) == ("TCP", 18, b"hello")
    assert row.length == 14 + 24 + 28 + 5 and row.ts == datetime(2024, 1, 15, 10, 0, 0, 123456)


def test_other_protocols(spark, tmp_path):
    frames = [
        ipv4(17, udp(b"data", 1, 65535)),
        ipv4(1, b"\x08\0\0\0\0\1\0\1ping"),
        ipv4(47, b"12345678rest"),
        ipv6(58, b"\x80\0\0\0\0\1\0\1x"),
        ETHERNET + b"\x08\x06" + b"\0" * 28,
        b"short",
        ipv4(6, b"too short"),
    ]
    rows = packets(spark, tmp_path, *frames)
    assert [(r.protocol, r.src_port, r.dst_port, bytes(r.payload)) for r in rows] == [
        ("UDP", 1, 65535, b"data"),
        ("ICMP", 0, 0, b"ping"),
        ("47", 0, 0, b"rest"),
        ("ICMPv6", 0, 0, b"x"),
        ("TCP", 0, 0, b""),
    ]
    kept = packets(spark, tmp_path, *frames, transports=("TCP", "UDP"))
    assert [r.protocol for r in kept] == ["UDP", "TCP"]


ADDRESSES = [
    "2001:db8::1", "::", "::1", "fe80::", "1::8", "2001:db8:0:1:1:1:1:1", "1:0:0:2:0:0:0:3",
    "1:0:0:2:3:0:0:4", "0:1::", "a:b:c:d:e:f:1:2", "ff02::1:ff00:0", "0:1:2:3:4:5:6:0",
]


def test_ipv6_addresses_are_canonical(spark, tmp_path):
    rows = packets(spark, tmp_path, *[ipv6(17, udp(b"q"), a, "::1") for a in ADDRESSES])
    expected = [socket.inet_ntop(socket.AF_INET6, socket.inet_pton(socket.AF_INET6, a)) for a in ADDRESSES]
    assert [r.src_ip for r in rows] == expected and {r.dst_ip for r in rows} == {"::1"}


def http(spark, tmp_path, text, **ports):
    ports.setdefault("dport", 80)
    return packets(spark, tmp_path, ipv4(6, tcp(text, **ports)))


def test_http_request(spark, tmp_path):
    text = b"GET /a?b=c HTTP/1.1\r\nX: y\r\nHOST :  one\r\nhost: two \r\nUser-Agent: ua/1 (x: y)\r\nReferer: r\r\nContent-Type: t/x\r\n\r\nbody"
    row = http(spark, tmp_path, text)
    assert (row.http_method, row.http_uri, row.http_host) == ("GET", "/a?b=c", "two")
    assert (row.http_user_agent, row.http_referer, row.http_content_type) == ("ua/1 (x: y)", "r", "t/x")
    assert row.http_status is None and row.payload.endswith(b"body")


def test_http_response_and_other_text(spark, tmp_path):
    row = http(spark, tmp_path, b"HTTP/1.1 404 Not Found\r\nContent-Type: text/html\r\n\r\n", sport=80, dport=5)
    assert (row.http_method, row.http_status, row.http_content_type) == (None, "404", "text/html")
    row = http(spark, tmp_path, b"NOISE\r\nHost: h\r\n")
    assert (row.http_method, row.http_host, row.http_status) == (None, None, None)
    row = http(spark, tmp_path, b"GET /a HTTP/1.1\r\nHost: h\r\n", dport=8080)
    assert row.http_method is None and row.http_host is None
    row = http(spark, tmp_path, b"PUT /\xff\xfex HTTP/1.1\r\n\r\n")
    assert (row.http_method, row.http_uri, row.http_host) == ("PUT", "/x", None)


def test_fewer_http_methods(spark, tmp_path):
    frames = [ipv4(6, tcp(b"PUT /a HTTP/1.1\r\n\r\n", dport=80)), ipv4(6, tcp(b"POST /a HTTP/1.1\r\n\r\n", dport=80))]
    rows = packets(spark, tmp_path, *frames, http_methods=("GET", "POST"))
    assert [r.http_method for r in rows] == [None, "POST"]


def dns(spark, tmp_path, message):
    row = packets(spark, tmp_path, ipv4(17, udp(message, 53, 1025)))
    return row.dns_query, row.dns_response


def answer(kind, data, owner=b"\xc0\x0c"):
    return owner + struct.pack(">HHIH", kind, 1, 60, len(data)) + data


def test_dns_messages(spark, tmp_path):
    question = name("www.example.com") + b"\0\1\0\1"
    ask = struct.pack(">HHHHHH", 1, 0x0100, 1, 0, 0, 0) + question
    reply = struct.pack(">HHHHHH", 1, 0x8180, 1, 2, 0, 0) + question
    address = answer(1, bytes([93, 184, 216, 34]))
    alias = answer(5, name("cdn.example.net"))
    assert dns(spark, tmp_path, ask) == ("www.example.com", None)
    assert dns(spark, tmp_path, reply + address) == ("www.example.com", "93.184.216.34")
    assert dns(spark, tmp_path, reply + alias + address) == ("www.example.com", "93.184.216.34")
    assert dns(spark, tmp_path, reply + answer(28, b"\0" * 16)) == ("www.example.com", None)
    assert dns(spark, tmp_path, reply[:-3]) == ("www.example.com", None)


def test_broken_dns_messages(spark, tmp_path):
    loop = struct.pack(">HHHHHH", 1, 0x0100, 1, 0, 0, 0) + b"\1a\xc0\x0c\0\1\0\1"
    assert dns(spark, tmp_path, loop) == ("a", None)
    assert dns(spark, tmp_path, b"short") == (None, None)
    assert dns(spark, tmp_path, struct.pack(">HHHHHH", 1, 0x8180, 1, 9, 0, 0) + b"\x3fab") == ("ab", None)
    assert dns(spark, tmp_path, struct.pack(">HHHHHH", 1, 0x0100, 1, 0, 0, 0) + b"\xc0") == (None, None)


def test_dns_only_on_its_port_and_only_udp(spark, tmp_path):
    message = struct.pack(">HHHHHH", 1, 0x0100, 1, 0, 0, 0) + name("a.b") + b"\0\1\0\1"
    rows = packets(spark, tmp_path, ipv4(17, udp(message, 9, 10)), ipv4(6, tcp(message, dport=53)))
    assert [r.dns_query for r in rows] == [None, None]


def test_unused_python_steps_are_pruned(spark, tmp_path):
    write(tmp_path / "in", [ipv4(17, udp(b"x"))])
    counts = decode(read_frames(spark, str(tmp_path / "in"))).groupBy("src_ip").agg(F.count("*"))
    assert "ArrowEvalPython" not in counts._jdf.queryExecution().executedPlan().toString()


def test_vlan_tags_and_padding(spark, tmp_path):
    plain = ipv4(6, tcp(b"", 1025, 443, 16))
    tagged = plain[:12] + b"\x81\x00\x00\x07" + plain[12:]
    twice = plain[:12] + b"\x88\xa8\x00\x01\x81\x00\x00\x07" + plain[12:]
    padded = plain + b"\0" * 6
    other = plain[:12] + b"\x81\x00\x00\x07\x08\x06" + plain[14:]
    rows = packets(spark, tmp_path, plain, tagged, twice, padded, other)
    assert [(r.src_ip, r.dst_port, r.flag_bits, bytes(r.payload)) for r in rows] == [("10.0.0.1", 443, 16, b"")] * 4


@pytest.mark.parametrize(
    ("link", "before"),
    [(101, b""), (228, b""), (113, b"\0" * 14 + b"\x08\x00"), (0, b"\x02\0\0\0"), (1, ETHERNET + b"\x08\x00")],
)
def test_link_types(spark, tmp_path, link, before):
    data = bytearray(write(tmp_path / "in", [before + ipv4(17, udp(b"data", 7, 9))[14:]]))
    data[20:24] = link.to_bytes(4, "little")
    (tmp_path / "in" / "a.pcap").write_bytes(data)
    row = decode(read_frames(spark, str(tmp_path / "in"))).first()
    assert (row.src_ip, row.src_port, row.dst_port, bytes(row.payload)) == ("10.0.0.1", 7, 9, b"data")


def test_unknown_link_types_fail(spark, tmp_path):
    data = bytearray(write(tmp_path / "in", [b"x" * 60]))
    data[20:24] = (147).to_bytes(4, "little")
    (tmp_path / "in" / "a.pcap").write_bytes(data)
    with pytest.raises(Exception, match="link type is not supported: 147"):
        decode(read_frames(spark, str(tmp_path / "in"))).collect()


def test_ipv6_extension_headers(spark, tmp_path):
    body = tcp(b"hi", 1025, 443, 18)
    hop = b"\x3c\x01" + b"\0" * 14  # options, 16 bytes, then destination options
    options = b"\x2c\x00" + b"\0" * 6  # 8 bytes, then a fragment
    fragment = b"\x06\x00" + b"\0" * 6  # then TCP
    rows = packets(spark, tmp_path, ipv6(0, hop + options + fragment + body), ipv6(6, body), ipv6(60, b"\x06"))
    assert [(r.protocol, r.src_port, bytes(r.payload)) for r in rows] == [
        ("TCP", 1025, b"hi"),
        ("TCP", 1025, b"hi"),
        ("60", 0, b""),
    ]


def test_dns_over_tcp(spark, tmp_path):
    message = struct.pack(">HHHHHH", 1, 0x0100, 1, 0, 0, 0) + name("www.example.com") + b"\0\1\0\1"
    frames = [ipv4(6, tcp(len(message).to_bytes(2, "big") + message, 1024, 53)), ipv4(6, tcp(b"", 1024, 53))]
    rows = packets(spark, tmp_path, *frames)
    assert [r.dns_query for r in rows] == ["www.example.com", None]
