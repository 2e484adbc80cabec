"""Bodies of messages against the bytes that were sent."""

import hashlib
import random

import pytest

from tests.test_tcp_streams import SCHEMA, row, sent, table
from watchfold.operators.carried_files import carried_files
from watchfold.operators.ioc import file_hash_iocs
from watchfold.operators.tcp_streams import reassemble

OK = b"HTTP/1.1 200 OK\r\nServer: s\r\n"


def sized(body, head=OK):
    return head + b"content-length:  %d \r\n\r\n" % len(body) + body


def chunked(body, rng, trailer=b""):
    out, at = OK + b"Content-Length: 3\r\nTransfer-Encoding: gzip, Chunked\r\n\r\n", 0
    while at < len(body):
        n = rng.randrange(1, 200)
        out += b"%X;x=y\r\n" % len(body[at : at + n]) + body[at : at + n] + b"\r\n"
        at += n
    return out + b"0\r\n" + trailer + b"\r\n"


def got(spark, segments, block=1 << 20, carry=1 << 16):
    rows = carried_files(reassemble(table(spark, segments), block, carry), carry).orderBy("place").collect()
    return [(r.framing, r.body_bytes, r.complete, r.md5, r.sha256) for r in rows]


def whole(framing, body):
    return (framing, len(body), True, hashlib.md5(body).hexdigest(), hashlib.sha256(body).hexdigest())


@pytest.mark.parametrize("block", [256, 1000, 1 << 20])
def test_hashes_are_those_of_the_bytes(spark, block):
    rng = random.Random(4)
    a, b, c, d = (rng.randbytes(n) for n in (5000, 3001, 1, 700))
    inside = b"before" + sized(b"xyz") + b"GET / HTTP/1.1\r\nHost: a\r\n\r\nafter"
    post = b"POST /up HTTP/1.1\r\nHost: h\r\n"
    data = sized(a) + chunked(b, rng, b"Last: one\r\n") + b"HTTP/1.1 204 No Content\r\nContent-Length: 9\r\n\r\n"
    data += sized(c, post) + sized(b"") + sized(inside) + b"GET /x HTTP/1.1\r\nHost: h\r\n\r\n" + OK + b"\r\n" + d
    segments = sent(data, 4_294_967_000, (1, 40, 300), 3)
    assert got(spark, segments, block, 200) == [
        whole("length", a), whole("chunked", b), whole("length", c), whole("length", inside), whole("close", d)
    ]


def test_holes_and_damage_give_no_hashes(spark):
    body = b"z" * 300
    data = sized(body) + sized(b"fine")
    syn = row(1, 0, b"", flags=2)
    holed = [syn, row(2, 1, data[:100]), row(3, 151, data[150:])]
    assert [x[:3] for x in got(spark, holed)] == [("length", 100 - len(data) + len(body) + len(sized(b"fine")), False), ("length", 4, True)]
    assert got(spark, holed)[1] == whole("length", b"fine") and got(spark, holed)[0][3:] == (None, None)
    short = [syn, row(2, 1, sized(body)[:-1])]
    assert [x[1:] for x in got(spark, short)] == [(299, False, None, None)]
    damaged = OK + b"Transfer-Encoding: chunked\r\n\r\n5\r\nhello\r\nzz\r\nmore\r\n0\r\n\r\n"
    assert got(spark, [syn, row(2, 1, damaged)]) == [("chunked", 5, False, None, None)]
    unended = OK + b"Transfer-Encoding: chunked\r\n\r\n5\r\nhello\r\n"
    assert got(spark, [syn, row(2, 1, unended)]) == [("chunked", 5, False, None, None)]
    assert got(spark, [syn, row(2, 1, OK + b"Content-Length: 5\r\n")]) == []  # no end of the head


def test_no_files(spark):
    assert got(spark, [row(1, 0, b"", flags=2), row(2, 1, b"no message\r\n\r\nat all")]) == []
    empty = carried_files(reassemble(spark.createDataFrame([], SCHEMA)))
    assert empty.collect() == [] and file_hash_iocs(empty).collect() == []


def test_hashes_become_indicators(spark):
    segments = [row(1, 0, b"", flags=2), row(2, 1, sized(b"abc"))]
    rows = file_hash_iocs(carried_files(reassemble(table(spark, segments)))).collect()
    assert sorted((r.type, r.value, r.context) for r in rows) == [
        ("hash", hashlib.md5(b"abc").hexdigest(), "md5 of a carried file"),
        ("hash", hashlib.sha256(b"abc").hexdigest(), "sha256 of a carried file"),
    ]


def test_streams_are_put_together_once(spark):
    """Only the hashing runs in Python behind the stored streams."""
    files = carried_files(reassemble(table(spark, [row(1, 0, b"", flags=2), row(2, 1, sized(b"abc"))])))
    plan = files._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "_hashed" in plan
