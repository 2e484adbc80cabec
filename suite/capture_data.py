"""Frames and capture files built from packet rows, to read back and decode."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from watchfold.sources.files import open_filesystem


def _num(value: Column | int, digits: int) -> Column:
    value = F.lit(value) if isinstance(value, int) else value
    return F.lpad(F.hex(value.cast("bigint")), digits, "0")


def _address(ip: Column) -> Column:
    return F.concat(*[_num(F.split_part(ip, F.lit("."), F.lit(i)), 2) for i in range(1, 5)])


def _chars(text: Column) -> Column:
    return F.hex(F.encode(text, "UTF-8"))


def _dns_message(query: Column, response: Column) -> Column:
    """A query, or a reply whose answer points back to the queried name."""
    labels = F.split(F.regexp_replace(query, r"\.+$", ""), r"\.")
    name = F.array_join(
        F.transform(labels, lambda label: F.concat(_num(F.length(label), 2), _chars(label))), ""
    )
    question = F.concat(name, F.lit("0000010001"))
    asked = F.concat(F.lit("12340100" + "0001" + "0000" + "00000000"), question)
    answer = F.concat(F.lit("c00c00010001000000ff0004"), _address(response))
    replied = F.concat(F.lit("12348180" + "0001" + "0001" + "00000000"), question, answer)
    return F.when(response.isNull(), asked).otherwise(replied)


def _ipv6_address(ip: Column) -> Column:
    """``2001:db8::`` with the octets of a dotted quad as the last four groups."""
    octets = [F.split_part(ip, F.lit("."), F.lit(i)) for i in range(1, 5)]
    return F.concat(F.lit("20010db800000000"), *[_num(o, 4) for o in octets])


def _payload(packets: DataFrame) -> Column:
    """A packet's bytes as hexadecimal digits: a request, a name to resolve, or its text."""
    if "data" in packets.columns:
        return F.hex("data")
    request = F.concat(
        F.col("http_method"),
        F.lit(" "),
        F.col("http_uri"),
        F.lit(" HTTP/1.1\r\nAccept: */*\r\n"),
        F.coalesce(F.concat(F.lit("Host: "), F.col("http_host"), F.lit("\r\n")), F.lit("")),
        F.lit("USER-AGENT:  made/"),
        F.col("packet_id").cast("string"),
        F.lit("\r\n\r\n"),
    )
    return (
        F.when(F.col("dns_query").isNotNull(), _dns_message(F.col("dns_query"), F.col("dns_response")))
        .when(F.col("http_method").isNotNull(), _chars(request))
        .otherwise(_chars(F.col("payload_text")))
    )


def frames_of(packets: DataFrame, version: int = 4) -> DataFrame:
    """Ethernet frames of packet rows, as the frame table of a capture named ``made``.

    Columns ``data`` (bytes) and ``sequence`` count where they are there.
    """
    payload = _payload(packets)
    size = F.length(payload) / 2
    ports = F.concat(_num(F.col("src_port"), 4), _num(F.col("dst_port"), 4))
    tcp = F.concat(
        ports,
        _num(F.col("sequence"), 8) if "sequence" in packets.columns else F.lit("00000001"),
        F.lit("00000000" + "50"),
        _num(F.coalesce("flag_bits", F.lit(0)), 2),
        F.lit("200000000000"),
    )
    udp = F.concat(ports, _num(size + 8, 4), F.lit("0000"))
    icmp = F.lit("0800000000010001")
    tcp_row, udp_row = F.col("protocol") == "TCP", F.col("protocol") == "UDP"
    transport = F.when(tcp_row, tcp).when(udp_row, udp).otherwise(icmp)
    number = F.when(tcp_row, F.lit("06")).when(udp_row, F.lit("11")).otherwise(F.lit("01"))
    carried = F.length(transport) / 2 + size
    link = F.lit("020000000001" + "020000000002")
    if version == 4:
        network = F.concat(
            F.lit("08004500"),
            _num(carried + 20, 4),
            F.lit("0001000040"),
            number,
            F.lit("0000"),
            _address(F.col("src_ip")),
            _address(F.col("dst_ip")),
        )
    else:
        network = F.concat(
            F.lit("86dd60000000"),
            _num(carried, 4),
            number,
            F.lit("40"),
            _ipv6_address(F.col("src_ip")),
            _ipv6_address(F.col("dst_ip")),
        )
    frame = F.concat(link, network, transport, payload)
    return packets.select(
        F.lit("made").alias("capture"),
        "packet_id",
        "ts",
        (F.length(frame) / 2).cast("bigint").alias("orig_len"),
        F.unhex(frame).alias("frame"),
    )


#: Bytes of the IP payload that a made fragment holds, at most.
FRAGMENT_BYTES = 24


def fragments_of(frames: DataFrame) -> DataFrame:
    """Frames of :func:`frames_of` with every second one cut into fragments.

    Fragment i of packet p has the id 100 p + i. Of every tenth packet the second one is
    lost, of every sixth the first one comes twice, and those of every fourth come last first.
    """
    p, f, part = F.col("packet_id"), F.col("frame"), F.col("part")
    data = F.substring(f, F.lit(35), F.length(f))
    parts = F.sequence(F.lit(0), F.length(data) - 1, F.lit(FRAGMENT_BYTES))
    wanted = F.when(p % 10 == 0, F.filter(parts, lambda x: x != FRAGMENT_BYTES)).otherwise(parts)
    wanted = F.when(p % 6 == 0, F.concat(wanted, F.array(F.lit(0)))).otherwise(wanted)
    cut = (p % 2 == 0) & (F.length(data) > FRAGMENT_BYTES)
    rows = frames.filter(cut).withColumn("size", F.length(data)).withColumn("part", F.explode(wanted))
    taken = F.least(F.lit(FRAGMENT_BYTES), F.col("size") - part)
    more = F.when(part + taken < F.col("size"), 0x2000).otherwise(0)
    header = F.concat(
        F.hex(F.substring(f, F.lit(1), F.lit(16))),
        _num(taken + 20, 4),
        _num(p % 65536, 4),
        _num(more + (part / 8).cast("int"), 4),
        F.hex(F.substring(f, F.lit(23), F.lit(12))),
    )
    frame = F.unhex(F.concat(header, F.hex(F.substring(f, part + 35, taken))))
    number = (part / FRAGMENT_BYTES).cast("int")
    late = F.when(p % 4 == 0, (F.col("size") / FRAGMENT_BYTES).cast("int") - number).otherwise(number)
    pieces = rows.select(
        "capture",
        (p * 100 + number).alias("packet_id"),
        (F.col("ts") + F.make_dt_interval(secs=late / 1_000_000)).alias("ts"),
        F.length(frame).cast("bigint").alias("orig_len"),
        frame.alias("frame"),
    )
    return frames.filter(~cut).withColumn("packet_id", p * 100).unionByName(pieces)


#: The number of the SYN of made streams: their numbers wrap soon.
FIRST_NUMBER = 4_294_967_000
#: Where packets of made streams are cut in two.
CUT = 10


def segments_of(packets: DataFrame) -> DataFrame:
    """Frames of TCP streams: the bytes of all packets between two ports, one after another.

    Packets longer than CUT bytes are two segments, with ids 10 p and 10 p + 1. Of those with
    p % 10 = 3 the second one is lost, of every fourth it comes before the first, and of
    every sixth the first one comes again at the end. A SYN opens each stream.
    """
    keys = ["src_ip", "src_port", "dst_ip", "dst_port"]
    tcp = packets.filter("protocol = 'TCP'").withColumn("data", F.unhex(_payload(packets)))
    size, p = F.length("data"), F.col("packet_id")
    order = Window.partitionBy(*keys).orderBy("ts", "packet_id")
    before = F.coalesce(F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tcp = tcp.withColumn("before", before).withColumn("turn", F.row_number().over(order))
    whole = F.struct(F.lit(0).alias("part"), F.lit(0).alias("at"), size.alias("size"), F.lit(0).alias("late"))
    late = F.when(p % 4 == 0, 2).otherwise(0)
    first = F.struct(F.lit(0).alias("part"), F.lit(0).alias("at"), F.lit(CUT).alias("size"), late.alias("late"))
    second = F.struct(F.lit(1).alias("part"), F.lit(CUT).alias("at"), (size - CUT).alias("size"), F.lit(1).alias("late"))
    again = F.struct(F.lit(2).alias("part"), F.lit(0).alias("at"), F.lit(CUT).alias("size"), F.lit(5).alias("late"))
    parts = F.array_compact(F.array(first, F.when(p % 10 != 3, second), F.when(p % 6 == 0, again)))
    syn = F.struct(F.lit(3).alias("part"), F.lit(0).alias("at"), F.lit(0).alias("size"), F.lit(-1).alias("late"))
    parts = F.when(size > CUT, parts).otherwise(F.array(whole))
    parts = F.when(F.col("turn") == 1, F.concat(F.array(syn), parts)).otherwise(parts)
    rows = tcp.withColumn("x", F.explode(parts))
    opening = F.col("x.part") == 3
    number = F.when(opening, F.lit(FIRST_NUMBER)).otherwise(FIRST_NUMBER + 1 + F.col("before") + F.col("x.at"))
    rows = rows.select(
        *keys,
        "protocol",
        (p * 10 + F.col("x.part")).alias("packet_id"),
        (F.col("ts") + F.make_dt_interval(secs=F.col("x.late") / 1_000_000)).alias("ts"),
        F.when(opening, 2).otherwise(24).alias("flag_bits"),
        F.substring("data", F.col("x.at") + 1, F.col("x.size")).alias("data"),
        (number % (1 << 32)).alias("sequence"),
    )
    return frames_of(rows)


def global_header(order: str = "<", nanos: bool = False, snaplen: int = 262144) -> bytes:
    magic = 0xA1B23C4D if nanos else 0xA1B2C3D4
    return struct.pack(order + "IHHiIII", magic, 2, 4, 0, 0, snaplen, 1)


def record(micros: int, frame: bytes, order: str = "<", nanos: bool = False) -> bytes:
    seconds, rest = divmod(micros, 1_000_000)
    ticks = rest * 1000 if nanos else rest
    return struct.pack(order + "IIII", seconds, ticks, len(frame), len(frame)) + frame


def block(kind: int, body: bytes, order: str = "<") -> bytes:
    """A pcapng block with its length at both ends."""
    body += b"\0" * (-len(body) % 4)
    size = struct.pack(order + "I", len(body) + 12)
    return struct.pack(order + "I", kind) + size + body + size


def section(order: str = "<") -> bytes:
    return block(0x0A0D0D0A, struct.pack(order + "IHHq", 0x1A2B3C4D, 1, 0, -1), order)


def interface(link: int = 1, limit: int = 262144, resolution: int | None = None, offset: int = 0, order: str = "<") -> bytes:
    """An interface whose clock ticks as option 9 says and begins at ``offset`` seconds."""
    options = b""
    if resolution is not None:
        options += struct.pack(order + "HHBxxx", 9, 1, resolution)
    if offset:
        options += struct.pack(order + "HHq", 14, 8, offset)
    return block(1, struct.pack(order + "HHI", link, 0, limit) + options + (bytes(4) if options else b""), order)


def packet_block(number: int, units: int, frame: bytes, order: str = "<", original: int | None = None) -> bytes:
    size = len(frame) if original is None else original
    body = struct.pack(order + "IIIII", number, units >> 32, units & 0xFFFFFFFF, len(frame), size) + frame
    return block(6, body, order)


# Two interfaces of made files: microseconds, and nanoseconds counted from a later second.
_CLOCKS = ((1_000_000, 0), (1_000_000_000, 1_700_000_000))


def _pcapng(micros: int, frame: bytes, order: str) -> bytes:
    number = micros % 2
    per_second, offset = _CLOCKS[number]
    return packet_block(number, (micros - offset * 1_000_000) * (per_second // 1_000_000), frame, order)


def _pcapng_head(order: str) -> bytes:
    return section(order) + interface(order=order) + interface(resolution=9, offset=_CLOCKS[1][1], order=order)


def _write(folder: str, blocks: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One capture file per task, renamed when complete so that a retry leaves no half.

    pcapng files (``blocks``) differ in byte order and begin a section with each batch.
    """
    filesystem, root = open_filesystem(folder)
    context = TaskContext.get()
    name = f"{root}/part-{context.partitionId():05d}.pcap"
    draft = f"{root}/_draft-{context.taskAttemptId()}"
    filesystem.create_dir(root)
    rows = 0
    with filesystem.open_output_stream(draft) as out:
        order = "<>"[context.partitionId() % 2]
        if not blocks:
            out.write(global_header())
        for batch in batches:
            if blocks:
                out.write(_pcapng_head(order))
            stamps = batch.column(batch.schema.get_field_index("ts")).cast(pa.int64()).to_pylist()
            frames = batch.column(batch.schema.get_field_index("frame")).to_pylist()
            made = (_pcapng(m, f, order) if blocks else record(m, f) for m, f in zip(stamps, frames))
            out.write(b"".join(made))
            rows += len(frames)
    filesystem.move(draft, name)
    yield pa.RecordBatch.from_pydict({"name": [name], "rows": [rows]})


def write_captures(frames: DataFrame, folder: str, blocks: bool = False) -> int:
    """Writes capture files, pcapng if ``blocks``, from all tasks; returns the number of records."""
    written = frames.select("ts", "frame").mapInArrow(
        partial(_write, folder, blocks), "name string, rows bigint"
    )
    return written.agg(F.sum("rows")).first()[0]
