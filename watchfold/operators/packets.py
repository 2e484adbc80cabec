"""Frames into packets: link, network and transport headers, HTTP and DNS."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watchfold.functions.text import clean_utf8
from watchfold.session import ship

# Numbers and words of the protocols.
IPV4_TYPE, IPV6_TYPE = "0800", "86DD"
VLAN_TYPES = ("8100", "88A8", "9100")
ETHERNET, COOKED = 1, 113
RAW_LINKS, LOOPBACK_LINKS = (12, 14, 101, 228, 229), (0, 108)
# IPv6 headers that may stand before the transport: options, routing, fragment, authentication
HOP_OPTIONS, ROUTING, FRAGMENT, AUTHENTICATION, END_OPTIONS = 0, 43, 44, 51, 60
EXTENSIONS = (HOP_OPTIONS, ROUTING, FRAGMENT, AUTHENTICATION, END_OPTIONS)
PROTOCOLS = {6: "TCP", 17: "UDP", 1: "ICMP", 58: "ICMPv6"}
HTTP_METHODS = ("GET", "POST", "PUT", "DELETE", "HEAD", "OPTIONS")
HTTP_PORT, DNS_PORT = 80, 53


def _hex(data: Column, offset: Column | int, size: int) -> Column:
    at = (F.lit(offset) if isinstance(offset, int) else offset) + 1
    return F.hex(F.substring(data, at, F.lit(size)))


def _uint(data: Column, offset: Column | int, size: int) -> Column:
    """Big-endian unsigned number at a byte offset, as ``bigint``."""
    return F.conv(_hex(data, offset, size), 16, 10).cast("bigint")


def _ipv4_text(word: Column) -> Column:
    octets = [F.shiftright(word, s).bitwiseAND(255).cast("string") for s in (24, 16, 8, 0)]
    return F.concat_ws(".", *octets)


def _zero_run() -> str:
    """Matches one address around its longest run of zero groups, the first if several."""
    forms = (rf"([^|]*?)(?::0){{{n}}}(?=[:|]|$)([^|]*)" for n in range(8, 1, -1))
    return rf"(?<![^|])(?:{'|'.join(forms)})"


def _ipv6_texts(data: Column) -> Column:
    """Both addresses of an IPv6 header in canonical text, joined by a bar.

    Groups lose their leading zeros and the longest run of zero groups becomes
    ``::``. One chain of patterns treats both.
    """
    at = F.col("_ip")
    text = F.concat_ws("|", _hex(data, at + 8, 16), _hex(data, at + 24, 16))
    text = F.regexp_replace(F.lower(text), "([0-9a-f]{4})", ":$1")
    text = F.regexp_replace(text, ":0{1,3}", ":")
    before, after = ("".join(f"${i}" for i in range(first, 15, 2)) for first in (1, 2))
    text = F.regexp_replace(text, _zero_run(), f"{before}:{after}")
    # Every group has its leading colon; only `::` keeps one at either end.
    return F.regexp_replace(F.regexp_replace(text, ":(?=[|]|$)", "::"), "(?<![^|]):(?!:)", "")


def _columns(frames: DataFrame) -> list[str]:
    return ["capture", "packet_id", "ts", "frame", *(["whole"] if "whole" in frames.columns else [])]


def _links(frames: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Adds where the network header begins (``_ip``) and its ``_kind``.

    Ethernet frames may carry two VLAN tags. Frames without a ``link`` column are
    Ethernet; a link type that is not known fails the job. ``whole`` stays if it is there.
    """
    f = F.col("frame")
    link = F.coalesce("link", F.lit(ETHERNET)) if "link" in frames.columns else F.lit(ETHERNET)
    tag, second = _hex(f, 12, 2).isin(*VLAN_TYPES), _hex(f, 16, 2).isin(*VLAN_TYPES)
    unknown = F.raise_error(F.concat(F.lit("link type is not supported: "), link.cast("string"))).cast("int")
    at = (
        F.when(link == ETHERNET, F.when(~tag, 14).when(~second, 18).otherwise(22))
        .when(link == COOKED, 16)
        .when(link.isin(*RAW_LINKS), 0)
        .when(link.isin(*LOOPBACK_LINKS), 4)
        .otherwise(unknown)
    )
    columns = keep or _columns(frames)
    placed = frames.select(*columns, F.inline(F.array(F.struct(at.alias("_ip"), link.alias("_link")))))
    ip = F.col("_ip")
    version = F.substring(_hex(f, ip, 1), 1, 1)
    kind = F.when(F.col("_link").isin(ETHERNET, COOKED), _hex(f, ip - 2, 2)).otherwise(
        F.when(version == "4", IPV4_TYPE).when(version == "6", IPV6_TYPE)
    )
    return placed.select(*columns, "_ip", "_link", kind.alias("_kind"))


def _behind_extensions(data: Column, number: Column, named: Column, at: Column) -> Column:
    """Protocol ``number`` and offset ``at`` behind an IPv6 packet's extension headers.

    ``named`` is where the protocol is named, ``later`` whether the data begins in the
    middle of a fragmented packet, whose headers are elsewhere; ``cut`` is the offset of a
    fragment header, if there is one, and ``cut_named`` where that one is named.
    """
    none = F.lit(None).cast("int")
    start = F.struct(
        number.alias("number"), named.cast("int").alias("named"), at.cast("int").alias("at"),
        F.lit(False).alias("later"), none.alias("cut"), none.alias("cut_named"),
    )

    def step(s: Column, _: Column) -> Column:
        here = s["at"]
        known = s["number"].isin(*EXTENSIONS) & (here + 8 <= F.length(data)) & ~s["later"]
        fragment = s["number"] == FRAGMENT
        units = _uint(data, here + 1, 1).cast("int")
        size = (
            F.when(fragment, 8)
            .when(s["number"] == AUTHENTICATION, (units + 2) * 4)
            .otherwise((units + 1) * 8)
        )
        after = F.struct(
            _uint(data, here, 1).cast("int").alias("number"),
            here.alias("named"),
            (here + size).cast("int").alias("at"),
            (fragment & (_uint(data, here + 2, 2) >= 8)).alias("later"),
            F.when(fragment, here).otherwise(s["cut"]).alias("cut"),
            F.when(fragment, s["named"]).otherwise(s["cut_named"]).alias("cut_named"),
        )
        return F.when(known, after).otherwise(s)

    walked = F.aggregate(F.sequence(F.lit(1), F.lit(8)), start, step)
    return F.when(number.isin(*EXTENSIONS), walked).otherwise(start)


def _headers(frames: DataFrame) -> DataFrame:
    """IPv4 and IPv6 frames with ``_v4``, the protocol ``_number``, the transport's offset
    ``_at``, the packet's ``_end``, behind which a link may pad, and whether it is a
    ``_later`` fragment, which begins with other bytes than a transport header.

    The generator drops other frames. Its output stands for itself in later steps,
    where a projection's expressions would be copied into each use.
    """
    f, ip, kind = F.col("frame"), F.col("_ip"), F.col("_kind")
    size = F.length(f)
    words = (_uint(f, ip, 1).bitwiseAND(15) * 4).cast("int")
    total = _uint(f, ip + 2, 2).cast("int")
    v4 = F.struct(
        F.lit(True).alias("_v4"),
        _uint(f, ip + 12, 4).alias("_src"),
        _uint(f, ip + 16, 4).alias("_dst"),
        _uint(f, ip + 9, 1).cast("int").alias("_number"),
        (ip + words).alias("_at"),
        # 0 where the network card cuts the packet up
        F.when((total >= words) & (ip + total <= size), ip + total).otherwise(size).alias("_end"),
        (_uint(f, ip + 6, 2).bitwiseAND(8191) > 0).alias("_later"),
    )
    rest = _uint(f, ip + 4, 2).cast("int")
    behind = _behind_extensions(f, _uint(f, ip + 6, 1).cast("int"), ip + 6, ip + 40)
    v6 = F.struct(
        F.lit(False).alias("_v4"),
        F.lit(0).cast("bigint").alias("_src"),
        F.lit(0).cast("bigint").alias("_dst"),
        behind["number"].alias("_number"),
        behind["at"].alias("_at"),
        F.when((rest > 0) & (ip + 40 + rest <= size), ip + 40 + rest).otherwise(size).alias("_end"),
        behind["later"].alias("_later"),
    )
    found = F.when((kind == IPV4_TYPE) & (size >= ip + 20), F.array(v4)).when(
        (kind == IPV6_TYPE) & (size >= ip + 40), F.array(v6)
    )
    return _links(frames).select(*_columns(frames), "_ip", F.inline(found))


def _transport(headers: DataFrame) -> DataFrame:
    """Adds ports, flag bits and payload.

    Headers that are cut off give port 0 and no payload. Only TCP and UDP have
    ports; the payload of other protocols starts after the eight bytes that their
    headers share. Later fragments have no header: port 0, and all of it is payload.
    """
    f, at, number, later = F.col("frame"), F.col("_at"), F.col("_number"), F.col("_later")
    left = F.col("_end") - at
    tcp = (number == 6) & (left >= 20) & ~later
    ports = tcp | ((number == 17) & (left >= 8) & ~later)
    # The high half-byte of the first of these two bytes counts words, the second holds flags.
    control = F.when(tcp, _uint(f, at + 12, 2).cast("int"))
    skip = (
        F.when(later, F.lit(0))
        .when(tcp, F.shiftright(F.col("_control"), 12) * 4)
        .when((number != 6) & (left >= 8), F.lit(8))
    )
    rest = F.coalesce(F.substring(f, at + skip + 1, F.greatest(left - skip, F.lit(0))), F.lit(b""))
    parts = F.struct(
        F.when(ports, _uint(f, at, 4)).otherwise(0).alias("_ports"),
        F.when(tcp, _uint(f, at + 4, 4)).alias("sequence"),
        control.alias("_control"),
    )
    words = headers.select("*", F.inline(F.array(parts)))
    return words.select(
        *headers.columns,
        F.shiftright("_ports", 16).cast("int").alias("src_port"),
        F.col("_ports").bitwiseAND(65535).cast("int").alias("dst_port"),
        F.col("_control").bitwiseAND(255).alias("flag_bits"),
        "sequence",
        rest.alias("payload"),
    )


def _packets(headers: DataFrame, sequence: bool = False) -> DataFrame:
    f, v4 = F.col("frame"), F.col("_v4")
    names = F.create_map(*[F.lit(x) for pair in PROTOCOLS.items() for x in pair])
    protocol = F.coalesce(F.try_element_at(names, F.col("_number")), F.col("_number").cast("string"))
    # NULL for IPv4 frames, which skip the patterns
    texts = _transport(headers).withColumn("_v6", F.when(~v4, _ipv6_texts(f)))

    def address(word: str, place: int) -> Column:
        v6 = F.split_part("_v6", F.lit("|"), F.lit(place))
        return F.when(v4, _ipv4_text(F.col(word))).otherwise(v6)

    payload = F.when(F.coalesce("whole", F.lit(True)), F.col("payload")) if "whole" in headers.columns else F.col("payload")
    return texts.select(
        "capture",
        "packet_id",
        "ts",
        address("_src", 1).alias("src_ip"),
        address("_dst", 2).alias("dst_ip"),
        "src_port",
        "dst_port",
        protocol.alias("protocol"),
        F.length(f).alias("length"),
        payload.alias("payload"),
        "flag_bits",
        *(["whole"] if "whole" in headers.columns else []),
        *(["sequence"] if sequence else []),
    )


def segments(frames: DataFrame) -> DataFrame:
    """TCP packets with their ``sequence`` number; no text is parsed."""
    return _packets(_headers(frames), sequence=True).filter("protocol = 'TCP' and sequence is not null")


def _either_port(number: int) -> Column:
    return (F.col("src_port") == number) | (F.col("dst_port") == number)


# Header names in the order of their fields.
_HTTP_HEADERS = {
    "http_host": "host",
    "http_user_agent": "user-agent",
    "http_referer": "referer",
    "http_content_type": "content-type",
}


def _message_pattern(methods: tuple[str, ...]) -> str:
    """Optional look-aheads over a whole message, so that one pass finds everything.

    Groups: 1 method and 2 URI of a request, 3 mark of a response, 4 second word
    of the first line, then the headers. The last of several equal headers wins.
    """
    finds = [
        rf"({'|'.join(methods)}) ([^ \r\n]*)",
        r"[^\r\n]*?(HTTP/)",
        r"[^ \r\n]* ([^ \r\n]*)",
    ]
    finds += [rf".*\r\n[ \t]*(?i:{h})[ \t]*:[ \t]*([^\r\n]*)" for h in _HTTP_HEADERS.values()]
    return "(?s)^" + "".join(f"(?=(?:{f})?)" for f in finds) + ".*$"


def parse_http(packets: DataFrame, methods: tuple[str, ...] = HTTP_METHODS) -> DataFrame:
    """Adds the HTTP columns of TCP packets from or to port 80; absent or empty ones are NULL."""
    web = (F.col("protocol") == "TCP") & _either_port(HTTP_PORT) & (F.length("payload") > 0)
    text = F.when(web, clean_utf8(F.col("payload").cast("string")))
    packed = "".join(f"\n${i}" for i in range(1, 5 + len(_HTTP_HEADERS)))
    found = F.split(F.regexp_replace("_text", _message_pattern(methods), packed), "\n")
    staged = packets.withColumn("_text", text).withColumn("_found", found)

    def field(i: int) -> Column:
        return F.get("_found", F.lit(i))

    request, response = field(1) != "", (field(1) == "") & (field(3) != "")

    def header(i: int) -> Column:
        return F.when(request | response, F.nullif(F.rtrim(field(i)), F.lit("")))

    return staged.select(
        *packets.columns,
        F.when(request, field(1)).alias("http_method"),
        F.when(request, field(2)).alias("http_uri"),
        *[header(5 + i).alias(name) for i, name in enumerate(_HTTP_HEADERS)],
        F.when(response, F.nullif(field(4), F.lit(""))).alias("http_status"),
    )


def _dns_name(message: bytes, at: int) -> tuple[str, int]:
    """Name at an offset and the offset behind it; pointers are followed backwards only."""
    labels, after, lowest = [], None, at
    while at < len(message) and message[at]:
        size = message[at]
        if size >= 192:
            target = (size & 63) << 8 | message[at + 1]
            after = at + 2 if after is None else after
            if target >= lowest:
                break
            at = lowest = target
            continue
        labels.append(message[at + 1 : at + 1 + size].decode("ascii", errors="ignore"))
        at += size + 1
    return ".".join(labels), at + 1 if after is None else after


def _dns_message(message: bytes) -> tuple[str | None, str | None]:
    """Queried name and the first IPv4 address among the answers."""
    if len(message) < 12:
        return None, None
    flags, questions, answers = (int.from_bytes(message[i : i + 2], "big") for i in (2, 4, 6))
    query, address = None, None
    try:
        at = 12
        for i in range(questions):
            name, at = _dns_name(message, at)
            query = query if i else (name or None)
            at += 4
        if flags >> 15:
            for _ in range(answers):
                _, at = _dns_name(message, at)
                kind = int.from_bytes(message[at : at + 2], "big")
                size = int.from_bytes(message[at + 8 : at + 10], "big")
                data = message[at + 10 : at + 10 + size]
                if kind == 1 and len(data) == 4:
                    address = ".".join(map(str, data))
                    break
                if at >= len(message):
                    break
                at += 10 + size
    except IndexError:
        pass
    return query, address


@F.arrow_udf(T.StructType([T.StructField(n, T.StringType()) for n in ("query", "response")]))
def _dns(payload: pa.Array) -> pa.Array:
    pairs = [(None, None) if m is None else _dns_message(m) for m in payload.to_pylist()]
    query = pa.array([q for q, _ in pairs], pa.string())
    response = pa.array([r for _, r in pairs], pa.string())
    return pa.StructArray.from_arrays([query, response], ["query", "response"])


def parse_dns(packets: DataFrame) -> DataFrame:
    """Adds name and answer of UDP and TCP packets from or to port 53.

    Over TCP two bytes of length precede the message. Only messages travel to Python,
    everything else is NULL there.
    """
    payload, port = F.col("payload"), _either_port(DNS_PORT)
    message = F.when(port & (F.col("protocol") == "UDP"), payload).when(
        port & (F.col("protocol") == "TCP") & (F.length("payload") > 2), F.substring("payload", 3, F.length("payload"))
    )
    return packets.withColumn("_dns", _dns(message)).select(
        *packets.columns,
        F.col("_dns.query").alias("dns_query"),
        F.col("_dns.response").alias("dns_response"),
    )


def decode(
    frames: DataFrame,
    payload_bytes: int | None = None,
    transports: tuple[str, ...] | None = None,
    http_methods: tuple[str, ...] = HTTP_METHODS,
) -> DataFrame:
    """Packets of frames; frames that carry no IP are dropped.

    Fragments other than a datagram's first have port 0; ``fragments.defragment`` puts
    datagrams together, and those with holes (``whole`` is false) have no payload here.
    ``transports`` keeps only the named protocols. ``payload_bytes`` cuts the stored
    payload after HTTP and DNS have seen all of it; detectors then see what is left. Write the result as
    a table when several operators are to read it.
    """
    ship(frames.sparkSession, "watchfold")
    packets = _packets(_headers(frames))
    if transports is not None:
        packets = packets.filter(F.col("protocol").isin(*transports))
    # DNS first: its Python step divides the generated code into two moderate methods.
    parsed = parse_http(parse_dns(packets), http_methods)
    if payload_bytes is None:
        return parsed
    return parsed.withColumn("payload", F.substring("payload", 1, payload_bytes))
