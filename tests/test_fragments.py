"""Datagrams from fragments in every order, with holes, repeats and overlaps."""

import random
import socket
import struct
from datetime import datetime, timedelta

import pytest

from tests.test_captures import ETHERNET, ipv4, tcp, udp
from watchfold.operators.fragments import _checksum, defragment
from watchfold.operators.packets import decode

START = datetime(2024, 1, 15, 10, 0, 0)
FRAMES = "capture string, packet_id long, ts timestamp_ntz, orig_len long, frame binary"


def four(data, place, more, number=17, ident=7, src="10.0.0.1"):
    head = struct.pack(">BBHHHBBH", 0x45, 0, 20 + len(data), ident, (0x2000 if more else 0) | place // 8, 64, number, 0)
    return ETHERNET + b"\x08\x00" + head + socket.inet_aton(src) + socket.inet_aton("10.0.0.2") + data


def six(data, place, more, number=17, ident=7, options=False):
    fragment = struct.pack(">BBHI", number, 0, place | more, ident) + data
    body = (b"\x2c\0\1\4\0\0\0\0" if options else b"") + fragment
    head = struct.pack(">IHBB", 6 << 28, len(body), 0 if options else 44, 64)
    pton = [socket.inet_pton(socket.AF_INET6, a) for a in ("2001:db8::1", "::1")]
    return ETHERNET + b"\x86\xdd" + head + b"".join(pton) + body


def pieces(make, data, size=16, **options):
    return [make(data[i : i + size], i, i + size < len(data), **options) for i in range(0, len(data), size)]


def run(spark, frames, seconds=None, **options):
    rows = [
        ("c", i, START + timedelta(seconds=seconds[i] if seconds else 0, microseconds=i), len(f), f)
        for i, f in enumerate(frames)
    ]
    whole = defragment(spark.createDataFrame(rows, FRAMES).repartition(3), **options)
    return decode(whole).orderBy("packet_id").collect()


BODY = udp(b"payload of some length, cut up " * 3, dport=53 + 1000)


@pytest.mark.parametrize("make", [four, six])
@pytest.mark.parametrize("seed", range(4))
def test_any_order_gives_the_datagram(spark, make, seed):
    frames = pieces(make, BODY)
    random.Random(seed).shuffle(frames)
    row, = run(spark, frames)
    assert (row.src_port, row.dst_port, row.protocol, row.whole) == (1024, 1053, "UDP", True)
    assert bytes(row.payload) == BODY[8:]
    assert row.packet_id == next(i for i, f in enumerate(frames) if BODY[:8] in f)


def test_other_extension_headers_stay(spark):
    row, = run(spark, pieces(six, BODY, options=True))
    assert (row.dst_port, bytes(row.payload)) == (1053, BODY[8:])


def test_what_is_no_fragment_stays(spark):
    atomic = six(BODY, 0, False)
    rows = run(spark, [ipv4(6, tcp(b"x")), atomic, ETHERNET + b"\x08\x06" + bytes(28)])
    assert [(r.packet_id, r.dst_port, r.whole) for r in rows] == [(0, 443, None), (1, 1053, None)]


def test_later_fragments_have_no_ports(spark):
    rows = [("c", i, START, len(f), f) for i, f in enumerate([*pieces(four, BODY), *pieces(six, BODY), *pieces(four, tcp(b"z" * 60), number=6)])]
    found = decode(spark.createDataFrame(rows, FRAMES)).collect()
    # the first sixteen bytes hold no whole TCP header
    assert sorted((r.src_port, r.dst_port) for r in found if r.src_port or r.dst_port) == [(1024, 1053), (1024, 1053)]
    assert all(r.flag_bits is None for r in found)


@pytest.mark.parametrize("lost", [1, 3])
def test_holes_give_ports_but_no_payload(spark, lost):
    frames = pieces(four, BODY)
    row, = run(spark, [f for i, f in enumerate(frames) if i != lost])
    assert (row.dst_port, row.whole, row.payload) == (1053, False, None)


def test_without_the_first_there_are_no_ports(spark):
    row, = run(spark, pieces(four, BODY)[1:])
    assert (row.src_port, row.dst_port, row.whole, row.payload) == (0, 0, False, None)


def test_repeats_and_overlaps(spark):
    a, b, c = (four(BODY[i:j], i, j < len(BODY)) for i, j in ((0, 32), (16, 64), (56, len(BODY))))
    row, = run(spark, [a, a, c, b, c, a, b])
    assert bytes(row.payload) == BODY[8:]


def test_identifications_come_again(spark):
    other = udp(b"another payload, and longer by a bit " * 3, sport=9, dport=8)
    rows = run(spark, [*pieces(four, BODY), *pieces(four, other), *pieces(four, BODY)])
    assert [bytes(r.payload) for r in rows] == [BODY[8:], other[8:], BODY[8:]]
    # the first's rest is lost, and much later the same identification begins anew
    cut = [pieces(four, BODY)[0], *pieces(four, BODY)]
    rows = run(spark, cut, seconds=[0, *[100] * (len(cut) - 1)])
    assert [r.whole for r in rows] == [False, True]
    rows = run(spark, cut, seconds=[0, *[29] * (len(cut) - 1)])
    assert [r.whole for r in rows] == [True]


def test_keys_keep_datagrams_apart(spark):
    parts = [pieces(four, udp(bytes([65 + k]) * 50), ident=k % 3, src=f"10.0.{k}.1", number=17) for k in range(9)]
    frames = [p[i] for i in range(4) for p in parts]
    rows = run(spark, frames)
    assert sorted(bytes(r.payload) for r in rows) == [bytes([65 + k]) * 50 for k in range(9)]


def test_headers_of_the_whole_are_right(spark):
    rows = [("c", i, START, len(f), f) for i, f in enumerate(pieces(four, BODY))]
    row = defragment(spark.createDataFrame(rows, FRAMES)).first()
    head = bytes(row.frame[14:34])
    assert int.from_bytes(head[2:4], "big") == 20 + len(BODY) and head[6:8] == b"\0\0"
    assert _checksum(head) == 0 and (row.fragments, row.orig_len, row.link) == (len(rows), 34 + len(BODY), 1)


def test_no_rows_and_no_times(spark):
    assert defragment(spark.createDataFrame([], FRAMES)).collect() == []
    rows = [("c", i, None, len(f), f) for i, f in enumerate(pieces(four, BODY))]
    assert [r.whole for r in defragment(spark.createDataFrame(rows, FRAMES)).collect()] == [True]
