"""Statistics, flows and request lists over packets."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchfold.functions.rules import ACK, FIN, FLAG_NAMES, PSH, RST, SYN, syn_only
from watchfold.functions.times import epoch_seconds


def totals(packets: DataFrame) -> DataFrame:
    return packets.agg(
        F.count("*").alias("total_packets"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"),
    )


def by_protocol(packets: DataFrame) -> DataFrame:
    """Packets per protocol and their share; the window sees one row per protocol."""
    share = F.col("n") * 100 / F.sum("n").over(Window.partitionBy())
    counts = packets.groupBy("protocol").agg(F.count("*").alias("n"))
    return counts.withColumn("pct", F.round(share, 4))


def by_source(packets: DataFrame) -> DataFrame:
    return packets.groupBy("src_ip").agg(F.count("*").alias("n"))


def by_destination(packets: DataFrame) -> DataFrame:
    return packets.groupBy("dst_ip").agg(F.count("*").alias("n"))


def by_port(packets: DataFrame) -> DataFrame:
    return packets.groupBy("dst_port").agg(F.count("*").alias("n"))


def top_talkers(packets: DataFrame, n: int = 10, side: str = "src_ip") -> DataFrame:
    """The ``n`` busiest addresses of one side."""
    counts = packets.groupBy(side).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(side)).limit(n)


def endpoint_summary(packets: DataFrame) -> DataFrame:
    """One row: packets, bytes and the numbers of sources and destinations.

    Two narrow scans, each combined per address within its tasks; two distinct
    counts in one aggregation would triple the rows instead.
    """
    sources = packets.groupBy("src_ip").agg(F.count("*").alias("n"), F.sum("length").alias("b"))
    first = sources.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_packets"),
        F.coalesce(F.sum("b"), F.lit(0)).alias("total_bytes"),
        F.count("src_ip").alias("unique_sources"),
    )
    destinations = packets.select("dst_ip").distinct()
    second = destinations.agg(F.count("dst_ip").alias("unique_destinations"))
    parts = first.unionByName(second, allowMissingColumns=True)
    return parts.agg(*[F.max(c).alias(c) for c in parts.columns])


def unique_endpoints(packets: DataFrame) -> DataFrame:
    return endpoint_summary(packets).select("unique_sources", "unique_destinations")


_NAMED_FLAGS = FIN | SYN | RST | PSH | ACK
_ENDPOINTS = ("src_ip", "dst_ip", "src_port", "dst_port")


def endpoint_pair(packets: DataFrame) -> DataFrame:
    """Adds the ordered pair ``lo_ip, lo_port, hi_ip, hi_port`` and ``forward``.

    ``forward`` tells that the source is the low end. Both directions of a
    conversation share the pair, and no two conversations do.
    """
    src_first = (F.col("src_ip") < F.col("dst_ip")) | (
        (F.col("src_ip") == F.col("dst_ip")) & (F.col("src_port") <= F.col("dst_port"))
    )

    def pick(a: str, b: str) -> Column:
        return F.when(src_first, F.col(a)).otherwise(F.col(b))

    return packets.select(
        *[c for c in packets.columns if c not in _ENDPOINTS],
        pick("src_ip", "dst_ip").alias("lo_ip"),
        pick("src_port", "dst_port").alias("lo_port"),
        pick("dst_ip", "src_ip").alias("hi_ip"),
        pick("dst_port", "src_port").alias("hi_port"),
        src_first.alias("forward"),
    )


PAIR = ("protocol", "lo_ip", "lo_port", "hi_ip", "hi_port")


def flow_aggregates() -> list[Column]:
    """Aggregates of a flow, all of fixed width so that Spark can hash-aggregate them.

    The set of flag combinations is a bitmap (the five named flags make at most 32),
    and the earliest packet of each direction is one number: its time in
    microseconds, then its id (below 10^18) to break ties.
    """
    micros = (epoch_seconds(F.col("ts")) * 1000000).cast("decimal(19,0)")
    shifted = (micros * F.lit(Decimal(10**18))).cast("decimal(38,0)")
    order = (shifted + F.col("packet_id")).cast("decimal(38,0)")
    bits = F.col("flag_bits").bitwiseAND(_NAMED_FLAGS)
    seen = F.when(bits > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), bits))
    return [
        F.min("ts").alias("start_time"),
        F.max("ts").alias("end_time"),
        F.count("*").alias("packet_count"),
        F.sum("length").alias("byte_count"),
        F.bit_or(seen).alias("_flags"),
        F.min(F.when(F.col("forward"), order)).alias("_first_forward"),
        F.min(F.when(~F.col("forward"), order)).alias("_first_backward"),
    ]


def _combination(bits: int) -> str:
    return ",".join(name for name, mask in FLAG_NAMES if bits & mask == mask)


def flow_columns(grouped: DataFrame) -> DataFrame:
    """Endpoints in the first packet's direction and the flag combinations as text."""
    forward = F.col("_first_backward").isNull() | (
        F.col("_first_forward") < F.col("_first_backward")
    )
    forward = F.coalesce(forward, F.lit(False))

    def pick(a: str, b: str) -> Column:
        return F.when(forward, F.col(a)).otherwise(F.col(b))

    # The bitmap's positions are the flag combinations, whose texts are known beforehand.
    texts = [
        F.when(F.expr(f"_flags & {1 << bits}L") != 0, _combination(bits))
        for bits in range(1, _NAMED_FLAGS + 1)
    ]
    return grouped.select(
        pick("lo_ip", "hi_ip").alias("src_ip"),
        pick("hi_ip", "lo_ip").alias("dst_ip"),
        pick("lo_port", "hi_port").alias("src_port"),
        pick("hi_port", "lo_port").alias("dst_port"),
        "protocol",
        "start_time",
        "end_time",
        "packet_count",
        "byte_count",
        F.sort_array(F.array_compact(F.array(*texts))).alias("flags"),
    )


def flows(packets: DataFrame) -> DataFrame:
    """Bidirectional flows: one row per protocol and pair of endpoints.

    One hash aggregation with map-side combine and one shuffle of partial rows; a
    flow that holds a third of all packets is one partial row per task.
    """
    return flow_columns(endpoint_pair(packets).groupBy(*PAIR).agg(*flow_aggregates()))


def _capped(df: DataFrame, limit: int | None) -> DataFrame:
    return df if limit is None else df.orderBy("ts", "packet_id").limit(limit)


def http_requests(packets: DataFrame, limit: int | None = None) -> DataFrame:
    """HTTP requests; ``limit`` takes the first ones by time."""
    rows = packets.filter("http_method is not null").select(
        "packet_id", "ts", "http_method", "http_uri", "http_host", "src_ip", "dst_ip"
    )
    return _capped(rows, limit)


def dns_queries(packets: DataFrame, limit: int | None = None) -> DataFrame:
    """DNS queries; ``limit`` takes the first ones by time."""
    rows = packets.filter("dns_query is not null").select(
        "packet_id", "ts", "dns_query", "dns_response", "src_ip", "dst_ip"
    )
    return _capped(rows, limit)


def connection_attempts(packets: DataFrame) -> DataFrame:
    """Packets that open a TCP connection, per service they address."""
    return (
        packets.filter(syn_only(F.col("flag_bits"), F.col("protocol")))
        .groupBy("dst_ip", "dst_port")
        .agg(F.count("*").alias("attempts"), F.max("ts").alias("last_ts"))
    )
