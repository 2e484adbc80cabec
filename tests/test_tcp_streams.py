"""Byte streams against a plain walk over the segments of each connection."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from watchfold.operators.detect import keyword_volume
from watchfold.operators.tcp_streams import gaps, placed, reassemble, stream_keyword, stream_messages

START = datetime(2024, 1, 15, 10, 0, 0)
SCHEMA = """capture string, packet_id long, ts timestamp_ntz, src_ip string, dst_ip string, src_port int, dst_port int,
  protocol string, flag_bits int, sequence long, payload binary"""


def row(packet_id, sequence, payload, ms=None, flags=24, src="10.0.0.1", dport=80):
    ts = START + timedelta(milliseconds=packet_id if ms is None else ms)
    return ("c", packet_id, ts, src, "10.0.0.2", 1024, dport, "TCP", flags, sequence % (1 << 32), payload)


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def sent(data, first, sizes, seed, lost=0.0, start=1):
    """SYN and segments of a stream, shuffled a little, some lost, repeated or overlapping."""
    rng, out, at = random.Random(seed), [row(start, first, b"", flags=2)], 0
    pieces = []
    while at < len(data):
        size = rng.choice(sizes)
        pieces.append((at, data[at : at + size]))
        if rng.random() < 0.2:  # sent again, cut otherwise
            low = max(0, at - rng.randrange(9))
            pieces.append((low, data[low : at + rng.randrange(1, size + 1)]))
        at += size
    pieces = [p for p in pieces if rng.random() >= lost]
    order = sorted(range(len(pieces)), key=lambda i: i + rng.randrange(4))
    return out + [row(start + 1 + k, first + 1 + pieces[i][0], pieces[i][1]) for k, i in enumerate(order)]


def own_bytes(rows):
    return {r.place + i: b for r in rows for i, b in enumerate(bytes(r.payload)[: r.own])}


@pytest.mark.parametrize("first", [0, 4_294_967_290])
@pytest.mark.parametrize("sizes", [(64, 16), (100, 7), (1 << 20, 1 << 16)])
def test_bytes_come_back(spark, first, sizes):
    data = random.Random(1).randbytes(3000)
    segments = sent(data, first, (1, 5, 40, 90), 2, lost=0.1)
    there = {}
    for r in sorted(segments[1:], key=lambda r: r[1]):
        for i, b in enumerate(r[10]):
            there.setdefault((r[9] - first - 1) % (1 << 32) + i, b)
    streams = reassemble(table(spark, segments), *sizes)
    rows = streams.collect()
    assert own_bytes(rows) == there
    assert {r.stream for r in rows} == {first}
    by_id = {r[1]: r for r in segments}
    for r in rows:
        brought = by_id[r.packet_id]
        at = r.place - (brought[9] - first - 1) % (1 << 32)
        assert 0 <= at < len(brought[10]) and brought[10][at] == r.payload[0]
    missing = {p for g in gaps(streams, sizes[0]).collect() for p in range(g.place, g.place + g.missing)}
    assert missing == set(range(min(there), max(there))) - set(there)


def test_later_connections_between_the_same_ports(spark):
    segments = sent(b"a" * 500, 77, (50,), 1) + sent(b"b" * 500, 5_000, (50,), 2, start=2_000)
    segments += sent(b"c" * 500, 100, (50,), 3, start=2_500) + [row(9_000, 101 + 500, b"later")]
    rows = reassemble(table(spark, segments)).collect()
    assert sorted((r.stream, bytes(r.payload)) for r in rows) == [
        (77, b"a" * 500),
        (100, b"c" * 500 + b"later"),
        (5_000, b"b" * 500),
    ]


def test_streams_without_a_beginning(spark):
    first = 4_294_967_200
    segments = [row(10, first + 60, b"B" * 60), row(11, first, b"A" * 60), row(4_000, first + 120, b"C" * 60)]
    rows = reassemble(table(spark, segments)).collect()
    # a block begins at place 0; what lies before reads on
    assert sorted((r.stream, r.place, r.own, bytes(r.payload)) for r in rows) == [
        (None, -60, 60, b"A" * 60 + b"B" * 60 + b"C" * 60),
        (None, 0, 120, b"B" * 60 + b"C" * 60),
    ]


def test_places_beyond_four_gigabytes(spark):
    step = 1_500_000_000
    segments = [row(0, 9, b"", flags=2)] + [row(i, 10 + i * step, b"x", ms=i * 1_000) for i in range(1, 9)]
    rows = placed(table(spark, segments)).orderBy("packet_id").collect()
    assert [r.place for r in rows] == [i * step for i in range(1, 9)]


def test_data_with_the_syn_and_syns_sent_again(spark):
    segments = [row(1, 500, b"GET", flags=2), row(2, 500, b"GET", flags=2), row(1_500, 500, b"GET", flags=2), row(1_600, 504, b" /")]
    rows = reassemble(table(spark, segments)).collect()
    assert [(r.stream, r.place, bytes(r.payload)) for r in rows] == [(500, 0, b"GET /")]


REQUEST = b"GET /search?q=abc HTTP/1.1\r\nHost: h.example\r\nUser-Agent: one\r\n\r\n"
POST = b"POST /f HTTP/1.1\r\nHost: i.example\r\nContent-Length: 12\r\n\r\nsecret=abcde"


@pytest.mark.parametrize("size", [1, 3, 17, 200])
@pytest.mark.parametrize("block", [50, 1 << 20])
def test_messages_are_found_wherever_they_are_cut(spark, size, block):
    data = REQUEST + POST + REQUEST + b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\nbody"
    streams = reassemble(table(spark, sent(data, 3, (size,), 5)), block, 300)
    heads = stream_messages(streams).orderBy("place").collect()
    assert [(r.place, r.http_method, r.http_uri, r.http_host, r.http_status) for r in heads] == [
        (0, "GET", "/search?q=abc", "h.example", None),
        (len(REQUEST), "POST", "/f", "i.example", None),
        (len(REQUEST + POST), "GET", "/search?q=abc", "h.example", None),
        (len(REQUEST + POST + REQUEST), None, None, None, "200"),
    ]
    assert own_bytes(streams.collect()) == dict(enumerate(data))


@pytest.mark.parametrize("block", [20, 64, 1 << 20])
def test_keywords_over_borders_count_once(spark, block):
    data = b"x" * 15 + b"PassWord" + b"y" * 30 + b"\xff\xfekey=" + b"z" * 40
    streams = reassemble(table(spark, sent(data, 3, (4,), 1) + [row(5_000, 1, b"quiet", src="10.0.0.9")]), block, 32)
    found = sorted(r.description for r in stream_keyword(streams).collect())
    assert found[-1] == 'Sensitive keyword "password" found in traffic'
    assert len(found) == (2 if block == 20 else 1)
    assert [tuple(r)[:2] for r in keyword_volume(streams, n=1).collect()] == [("10.0.0.1", "10.0.0.2")]


def test_holes_are_told(spark):
    segments = [row(1, 9, b"", flags=2), row(2, 10, b"a" * 10), row(3, 30, b"b" * 10), row(4, 200, b"c" * 10)]
    for block in (16, 64, 1 << 20):
        streams = reassemble(table(spark, segments), block, 8)
        assert sorted((g.place, g.missing) for g in gaps(streams, block).collect()) == [(10, 10), (30, 160)]
    assert [r.gap_after for r in streams.orderBy("place").collect()] == [10, 160, None]


def test_no_rows_and_no_bytes(spark):
    assert reassemble(table(spark, [row(1, 9, b"", flags=2), row(2, 10, None)])).collect() == []
    assert reassemble(spark.createDataFrame([], SCHEMA)).collect() == []
    no_time = table(spark, [row(1, 10, b"ab"), row(2, 12, b"cd")]).withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    assert [bytes(r.payload) for r in reassemble(no_time).collect()] == [b"abcd"]
