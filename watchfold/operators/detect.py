"""Detectors: packets or log entries in, alert or finding rows out."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchfold.functions.net import is_private
from watchfold.functions.rules import KEYWORD_PATTERN, keyword_hit, syn_only
from watchfold.functions.text import clean_utf8
from watchfold.functions.times import epoch_seconds
from watchfold.operators.logs import failed_logins
from watchfold.operators.traffic import connection_attempts

# Thresholds and texts of the alerts.
HAMMERING, SYN_FLOOD, LONG_QUERY = 50, 100, 50
PORTS, FAILURES, KEYWORD_PACKETS = 100, 50, 5
SMB_PORT = 445

# Substrings of agents that scripted tools send.
TOOL_AGENTS = ("curl/", "wget/", "python-", "powershell", "sqlmap", "nikto", "nmap", "masscan")


def _text(value: str | Column) -> Column:
    return (F.lit(value) if isinstance(value, str) else value).cast("string")


def _alert(
    severity: str,
    category: str,
    description: str | Column,
    evidence: str | Column,
    ts: Column,
    source: Column | None = None,
    destination: Column | None = None,
) -> list[Column]:
    absent = F.lit(None).cast("string")
    return [
        F.lit(severity).alias("severity"),
        F.lit(category).alias("category"),
        _text(description).alias("description"),
        (absent if source is None else source).alias("source_ip"),
        (absent if destination is None else destination).alias("destination_ip"),
        F.array(_text(evidence)).alias("evidence"),
        ts.alias("ts"),
    ]


def service_hammering(packets: DataFrame, n: int = HAMMERING) -> DataFrame:
    """More than ``n`` connection attempts to one service."""
    return _hammering(connection_attempts(packets), n)


def _hammering(attempts: DataFrame, n: int) -> DataFrame:
    text = F.format_string(
        "Host %s received %d connection attempts on port %d", "dst_ip", "attempts", "dst_port"
    )
    evidence = F.concat(F.lit("Connection attempts to port "), F.col("dst_port").cast("string"))
    return attempts.filter(F.col("attempts") > n).select(
        *_alert(
            "high",
            "Port Scanning",
            text,
            evidence,
            F.col("last_ts"),
            destination=F.col("dst_ip"),
        )
    )


def port_scan(packets: DataFrame, ports: int = PORTS) -> DataFrame:
    """Pairs of hosts with at least ``ports`` distinct destination ports.

    Spark first drops duplicates by (source, destination, port), spread over all
    tasks, and counts what is left: at most 65,536 rows per pair.
    """
    return (
        packets.groupBy("src_ip", "dst_ip")
        .agg(F.count_distinct("dst_port").alias("ports"))
        .filter(F.col("ports") >= ports)
    )


def syn_flood(packets: DataFrame, n: int = SYN_FLOOD, by: str | None = None) -> DataFrame:
    """More than ``n`` opening packets in all, or per value of the column ``by``."""
    opening = packets.filter(syn_only(F.col("flag_bits"), F.col("protocol")))
    grouped = opening.groupBy(by) if by else opening.groupBy()
    counts = grouped.agg(F.count("*").alias("attempts"), F.max("ts").alias("last_ts"))
    return _flood(counts, n, by)


def _flood(counts: DataFrame, n: int, by: str | None = None) -> DataFrame:
    text = F.format_string("Potential SYN flood detected with %d SYN packets", "attempts")
    return counts.filter(F.col("attempts") > n).select(
        *_alert(
            "critical",
            "SYN Flood",
            text,
            "High volume of SYN packets without corresponding ACKs",
            F.col("last_ts"),
            source=F.col(by) if by == "src_ip" else None,
            destination=F.col(by) if by == "dst_ip" else None,
        )
    )


def _payload_text(payload_bytes: int | None) -> Column:
    payload = F.col("payload") if payload_bytes is None else F.substring("payload", 1, payload_bytes)
    return clean_utf8(payload.cast("string"))


def keyword_alert(hit: Column) -> tuple[Column, list[Column]]:
    """A keyword that was hit and its alert."""
    return hit, _alert(
        "high",
        "Data Exfiltration",
        F.concat(F.lit('Sensitive keyword "'), hit, F.lit('" found in traffic')),
        F.concat(F.lit("Payload contains: "), hit),
        F.col("ts"),
        F.col("src_ip"),
        F.col("dst_ip"),
    )


def _tunnel_alert(n: int) -> tuple[Column, list[Column]]:
    size = F.length("dns_query")
    return size > n, _alert(
        "medium",
        "DNS Tunneling",
        F.concat(F.lit("Unusually long DNS query: "), size.cast("string"), F.lit(" characters")),
        F.concat(F.lit("Query: "), F.substring("dns_query", 1, 50), F.lit("...")),
        F.col("ts"),
        F.col("src_ip"),
    )


def sensitive_keyword(packets: DataFrame, payload_bytes: int | None = None) -> DataFrame:
    """One alert per packet whose payload holds a sensitive keyword."""
    hit, alert = keyword_alert(keyword_hit(_payload_text(payload_bytes)))
    return packets.filter(hit.isNotNull()).select(*alert)


def dns_tunnel(packets: DataFrame, n: int = LONG_QUERY) -> DataFrame:
    """One alert per DNS query longer than ``n`` characters."""
    hit, alert = _tunnel_alert(n)
    return packets.filter(hit).select(*alert)


def keyword_volume(
    packets: DataFrame, n: int = KEYWORD_PACKETS, payload_bytes: int | None = None
) -> DataFrame:
    """Pairs of hosts with at least ``n`` packets that match the keyword pattern."""
    return (
        packets.filter(_payload_text(payload_bytes).rlike(KEYWORD_PATTERN))
        .groupBy("src_ip", "dst_ip")
        .agg(F.count("*").alias("hits"))
        .filter(F.col("hits") >= n)
    )


def brute_force(
    entries: DataFrame, n: int = FAILURES, window: str = "10 minutes", slide: str | None = None
) -> DataFrame:
    """Addresses with at least ``n`` failed logins within one time window."""
    return (
        failed_logins(entries)
        .groupBy("ip_address", F.window("event_time", window, slide).alias("w"))
        .agg(F.count("*").alias("failures"))
        .filter(F.col("failures") >= n)
        .select(
            "ip_address",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "failures",
        )
    )


def gap_statistics(
    df: DataFrame, keys: list[str], ts: str = "ts", spans: tuple[int, ...] = (60,)
) -> DataFrame:
    """Count, mean and standard deviation of the gaps between consecutive events.

    Exact, without putting all events of one key into one task. Events with equal
    time are counted first (their gaps are zero), so that a minute of one key holds
    at most 60 million times. Then runs of events are merged in steps: all runs of
    a key within ``spans[0]`` seconds become one run that keeps its ends and the
    squared distances of its gaps from their mean, and so on. The last step sees one row per key and
    minute, half a million a year. More ``spans`` make more and smaller steps.
    """
    runs = (
        df.groupBy(*keys, ts)
        .agg(F.count("*").alias("events"))
        .select(
            *keys,
            epoch_seconds(F.col(ts)).alias("first"),
            epoch_seconds(F.col(ts)).alias("last"),
            "events",
            F.lit(0.0).alias("spread"),
        )
    )

    def mean_gap() -> Column:
        gaps = F.greatest(F.col("events") - 1, F.lit(1))
        return (F.col("last") - F.col("first")).cast("double") / gaps

    for span in (*spans, None):
        cell = [*keys]
        if span:
            runs = runs.withColumn("cell", F.floor(F.col("first") / span))
            cell.append("cell")
        whole = Window.partitionBy(*cell)
        before = F.lag("last").over(whole.orderBy("first"))
        # the merged run's mean gap, from which its parts' spreads are taken anew: no
        # difference of large squares, so that even gaps stay exactly even
        events, first, last = F.sum("events"), F.min("first"), F.max("last")
        mean = (last.over(whole) - first.over(whole)).cast("double") / F.greatest(events.over(whole) - 1, F.lit(1))
        runs = runs.withColumn("mean", mean).withColumn("gap", (F.col("first") - before).cast("double"))
        inner, outer = mean_gap() - F.col("mean"), F.coalesce(F.col("gap") - F.col("mean"), F.lit(0.0))
        spread = F.col("spread") + (F.col("events") - 1) * inner * inner + outer * outer
        runs = runs.groupBy(*cell).agg(
            first.alias("first"), last.alias("last"), events.alias("events"), F.sum(spread).alias("spread")
        )
    gaps = F.col("events") - 1
    return runs.filter(F.col("events") > 1).select(
        *keys, gaps.alias("gaps"), mean_gap().alias("mean_gap"), F.sqrt(F.col("spread") / gaps).alias("sd_gap")
    )


def beaconing(
    packets: DataFrame, min_gaps: int = 10, max_cv: float = 0.1, protocol: str | None = None
) -> DataFrame:
    """Pairs of hosts that talk at even intervals: gaps that vary little around their mean."""
    rows = packets if protocol is None else packets.filter(F.col("protocol") == protocol)
    stats = gap_statistics(rows.select("src_ip", "dst_ip", "ts"), ["src_ip", "dst_ip"])
    return stats.filter(
        (F.col("gaps") >= min_gaps)
        & (F.col("mean_gap") > 0)
        & (F.col("sd_gap") <= F.col("mean_gap") * max_cv)
    )


def period_statistics(
    df: DataFrame, keys: list[str], ts: str = "ts", tries: int = 4, fold: int = 32, span: int = 86_400, ratio: float = 1.1
) -> DataFrame:
    """The best period of each key's events: ``keys, period, beats, share, coherence``.

    Seconds with an event are folded at periods that their gaps propose. Gaps between
    neighbouring seconds (of one ``span``) are counted in bins as wide as ``ratio``, which
    overlap by half; the mean gaps of the ``tries`` fullest bins and four close values of
    each are the periods. A fold covers ``fold`` periods, so that a clock that drifts stays
    in phase. ``coherence`` is the mean cosine of the phase difference of two events of a
    fold: 1 for a clock, about 0 for chance however many events there are. ``share`` is the
    number of seconds with an event by that of beats between the first and the last of each
    fold, so that long pauses between folds do not count. The period with the highest
    coherence times share (at most 1) wins, the shorter one of equals.

    No task sorts all events of a key, only those of one ``span``, at most one a second; the rest
    are sums. Null times are left out, repeated rows count once, keys with fewer than two seconds
    in every span have no row. Periods beyond ``span`` are not found.
    """
    seconds = df.filter(F.col(ts).isNotNull()).select(*keys, F.floor(epoch_seconds(F.col(ts))).alias("_s")).distinct()
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    own = [f"_k{i}" for i in range(len(keys))]
    seconds = seconds.select(*named, "_s")
    before = F.lag("_s").over(Window.partitionBy(*own, F.floor(F.col("_s") / span)).orderBy("_s"))
    gaps = seconds.select(*own, (F.col("_s") - before).alias("gap")).filter("gap is not null")
    counted = gaps.groupBy(*own, "gap").agg(F.count("*").alias("n"))
    halves = counted.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("half"))
    bin_ = F.floor(F.log("gap") / F.log(F.lit(ratio)) + F.col("half") / 2)
    binned = halves.groupBy(*own, "half", bin_.alias("bin")).agg(
        F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("gap")) / F.sum("n")).alias("period")
    )
    fullest = Window.partitionBy(*own).orderBy(F.desc("n"), "period", "half")
    proposed = binned.withColumn("rank", F.row_number().over(fullest)).filter(F.col("rank") <= tries)
    near = F.array(*[F.col("period") * (1 + k / (4 * fold)) for k in (-2, -1, 0, 1, 2)])
    proposed = proposed.groupBy(*own).agg(F.array_distinct(F.flatten(F.collect_list(near))).alias("periods"))
    same = F.lit(True)
    for k in own:
        same = same & F.col(f"s.{k}").eqNullSafe(F.col(f"p.{k}"))
    met = seconds.alias("s").join(proposed.alias("p"), same).select("s.*", F.explode("periods").alias("period"))
    turns = F.col("_s") / F.col("period")
    angle = 2 * math.pi * (turns - F.floor(turns))
    folds = met.groupBy(*own, "period", F.floor(turns / fold).alias("fold")).agg(
        F.sum(F.cos(angle)).alias("x"),
        F.sum(F.sin(angle)).alias("y"),
        F.count("*").cast("double").alias("n"),
        (F.max("_s") - F.min("_s")).alias("long"),
    )
    n = F.col("n")
    pairs = F.sum(n * (n - 1))
    coherence = F.when(pairs > 0, F.sum(F.col("x") * F.col("x") + F.col("y") * F.col("y") - n) / pairs).otherwise(0.0)
    found = folds.groupBy(*own, "period").agg(
        F.sum(n).cast("long").alias("beats"),
        (F.sum(n) / F.sum(1 + F.col("long") / F.col("period"))).alias("share"),
        coherence.alias("coherence"),
    )
    # rounded, so that sums in another order choose alike
    score = F.round(F.col("coherence") * F.least(F.col("share"), F.lit(1.0)), 9)
    best = F.max_by(F.struct("period", "beats", "share", "coherence"), F.struct(score, -F.col("period")))
    back = [F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)]
    return found.groupBy(*own).agg(best.alias("best")).select(*back, "best.*")


def loose_beaconing(
    packets: DataFrame,
    min_beats: int = 10,
    min_share: float = 0.5,
    min_coherence: float = 0.5,
    protocol: str | None = None,
) -> DataFrame:
    """Pairs of hosts that talk at a steady period though beats are late, early or missing.

    See :func:`period_statistics`; a pair's period must have at least ``min_share`` of its beats.
    """
    rows = packets if protocol is None else packets.filter(F.col("protocol") == protocol)
    stats = period_statistics(rows.select("src_ip", "dst_ip", "ts"), ["src_ip", "dst_ip"])
    enough = (F.col("beats") >= min_beats) & (F.col("share") >= min_share)
    return stats.filter(enough & (F.col("coherence") >= min_coherence))


def lateral_movement(packets: DataFrame, port: int = SMB_PORT) -> DataFrame:
    """File-sharing traffic between two internal hosts."""
    return (
        packets.filter(
            (F.col("protocol") == "TCP")
            & (F.col("dst_port") == port)
            & is_private(F.col("src_ip"))
            & is_private(F.col("dst_ip"))
        )
        .groupBy("src_ip", "dst_ip")
        .agg(
            F.count("*").alias("packets"),
            F.min("ts").alias("first_seen"),
            F.max("ts").alias("last_seen"),
        )
    )


def bad_domain(packets: DataFrame, feed: DataFrame) -> DataFrame:
    """Traffic to known-bad domains per source: HTTP hosts and DNS queries.

    Packets shrink to one row per source and name before they meet the feed.
    """
    name = F.lower(F.regexp_replace(F.coalesce("http_host", "dns_query"), r"\.+$", ""))
    seen = (
        packets.select("src_ip", "ts", name.alias("domain"))
        .filter(F.col("domain").isNotNull())
        .groupBy("src_ip", "domain")
        .agg(
            F.count("*").alias("packets"),
            F.min("ts").alias("first_seen"),
            F.max("ts").alias("last_seen"),
        )
    )
    return seen.join(feed.select("domain").distinct(), "domain", "left_semi")


def bad_subdomain(packets: DataFrame, feed: DataFrame) -> DataFrame:
    """:func:`bad_domain` for names below a listed domain too, with the ``listed`` one.

    A name meets the feed by its suffixes of whole labels, of as many as the feed's names
    have; the longest listed one counts. Names are made distinct before they are taken apart.
    """
    name = F.lower(F.regexp_replace(F.coalesce("http_host", "dns_query"), r"\.+$", ""))
    named = packets.select("src_ip", "ts", name.alias("domain")).filter(F.col("domain").isNotNull())
    listed = feed.select(F.lower(F.regexp_replace("domain", r"\.+$", "")).alias("listed")).filter("listed <> ''").distinct()
    parts = F.split("domain", r"\.")
    size = F.size(parts)
    longest = listed.agg(F.max(F.size(F.split("listed", r"\.")))).first()[0] or 0
    depth = F.least(size, F.lit(max(1, longest)))
    suffixes = F.transform(F.sequence(F.lit(1), depth), lambda n: F.array_join(F.slice(parts, size - n + 1, n), "."))
    known = named.select("domain").distinct().withColumn("listed", F.explode(suffixes)).join(listed, "listed")
    best = known.groupBy("domain").agg(F.max_by("listed", F.length("listed")).alias("listed"))
    seen = named.groupBy("src_ip", "domain").agg(
        F.count("*").alias("packets"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen")
    )
    return seen.join(best, "domain")


def odd_agent(entries: DataFrame, few_sources: int = 2) -> DataFrame:
    """User agents that are absent, name a tool, or come from few addresses."""
    lowered = F.lower("user_agent")
    tool = F.lit(False)
    for needle in TOOL_AGENTS:
        tool = tool | lowered.contains(needle)
    reason = (
        F.when(F.col("user_agent").isNull(), "absent")
        .when(tool, "tool")
        .when(F.col("sources") < few_sources, "rare")
    )
    return (
        entries.groupBy("user_agent")
        .agg(F.count("*").alias("requests"), F.count_distinct("ip_address").alias("sources"))
        .withColumn("reason", reason)
        .filter(F.col("reason").isNotNull())
    )


def subdomain_stats(packets: DataFrame, parent_labels: int = 2) -> DataFrame:
    """Per parent domain: queries, distinct subdomains, their mean length and entropy.

    Equal subdomains are counted before their characters are spread out, and the
    entropy needs one row per parent and character only.
    """
    name = F.regexp_replace(F.col("dns_query"), r"\.+$", "")
    parent = F.substring_index(name, ".", -parent_labels)
    sub = F.expr("substring(name, 1, length(name) - length(parent) - 1)")
    subs = (
        packets.filter("dns_query is not null")
        .select(name.alias("name"), parent.alias("parent"))
        .filter(F.length("name") > F.length("parent"))
        .groupBy("parent", sub.alias("sub"))
        .agg(F.count("*").alias("queries"))
    )
    sizes = subs.groupBy("parent").agg(
        F.sum("queries").alias("queries"),
        F.count("*").alias("subdomains"),
        (F.sum(F.length("sub") * F.col("queries")) / F.sum("queries")).alias("mean_length"),
    )
    chars = (
        subs.select("parent", "queries", F.explode(F.split("sub", "")).alias("ch"))
        .groupBy("parent", "ch")
        .agg(F.sum("queries").cast("double").alias("n"))
        .groupBy("parent")
        .agg(
            (F.log2(F.sum("n")) - F.sum(F.col("n") * F.log2("n")) / F.sum("n")).alias("entropy")
        )
    )
    return sizes.join(chars, "parent", "left")


def all_alerts(
    packets: DataFrame,
    hammering: int = HAMMERING,
    flood: int = SYN_FLOOD,
    long_query: int = LONG_QUERY,
    payload_bytes: int | None = None,
) -> DataFrame:
    """Alerts of the four packet detectors, duplicates kept.

    Two passes over packets instead of four: both counting detectors read the
    attempts per service, and both per-packet detectors share one scan.
    """
    attempts = connection_attempts(packets)
    total = attempts.agg(F.sum("attempts").alias("attempts"), F.max("last_ts").alias("last_ts"))
    keyword, found_alert = keyword_alert(keyword_hit(_payload_text(payload_bytes)))
    tunnel, tunnel_alert = _tunnel_alert(long_query)
    per_packet = packets.select(
        F.inline(
            F.array_compact(
                F.array(
                    F.when(keyword.isNotNull(), F.struct(*found_alert)),
                    F.when(tunnel, F.struct(*tunnel_alert)),
                )
            )
        )
    )
    return (
        _hammering(attempts, hammering).unionByName(_flood(total, flood)).unionByName(per_packet)
    )
