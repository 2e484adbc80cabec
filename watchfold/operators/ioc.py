"""Indicators of compromise."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchfold.functions.net import is_private
from watchfold.functions.rules import suspicious_domain, suspicious_uri

# Thresholds, weights and confidences of the scoring.
MANY, SOME = 1000, 100
MANY_SCORE, SOME_SCORE = 30, 20
SEVERITY_SCORE = {"critical": 50, "high": 30, "medium": 15}
DOMAIN_CONFIDENCE, URL_CONFIDENCE = 70, 60
BLOCKING = 70

# Tokens to look for in text.
EMAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}"
HASH = r"\b(?:[0-9A-Fa-f]{64}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{32})\b"


def _ioc(
    kind: str, value: Column, context: Column, first: Column, last: Column, confidence: Column
) -> list[Column]:
    return [
        F.lit(kind).alias("type"),
        value.alias("value"),
        context.alias("context"),
        first.alias("first_seen"),
        last.alias("last_seen"),
        confidence.cast("int").alias("confidence"),
    ]


def suspicious_ips(packets: DataFrame, n: int = MANY) -> DataFrame:
    """Public sources of more than ``n`` packets."""
    return (
        packets.filter(~is_private(F.col("src_ip")))
        .groupBy("src_ip")
        .agg(F.count("*").alias("n"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))
        .filter(F.col("n") > n)
    )


def alert_scores(alerts: DataFrame) -> DataFrame:
    """Sum of severity weights per address that alerts name on either end."""
    weights = F.create_map(*[F.lit(x) for pair in SEVERITY_SCORE.items() for x in pair])
    weight = F.coalesce(F.try_element_at(weights, F.col("severity")), F.lit(0))
    ends = F.array_distinct(F.array_compact(F.array("source_ip", "destination_ip")))
    return (
        alerts.select(F.explode(ends).alias("src_ip"), weight.alias("w"))
        .groupBy("src_ip")
        .agg(F.sum("w").alias("alert_score"))
    )


def _confidence(scored: DataFrame) -> DataFrame:
    volume = F.when(F.col("n") > MANY, MANY_SCORE).when(F.col("n") > SOME, SOME_SCORE).otherwise(0)
    total = F.least(F.lit(100), volume + F.coalesce("alert_score", F.lit(0)))
    return scored.withColumn("confidence", total.cast("int"))


def ip_confidence(packets: DataFrame, alerts: DataFrame) -> DataFrame:
    """Confidence 0-100 of every source: its volume and the alerts that name it."""
    counts = packets.groupBy("src_ip").agg(F.count("*").alias("n"))
    return _confidence(counts.join(alert_scores(alerts), "src_ip", "left")).select(
        "src_ip", "n", "confidence"
    )


def ip_iocs(packets: DataFrame, alerts: DataFrame, n: int = MANY) -> DataFrame:
    """Suspicious sources with their confidence."""
    scored = _confidence(suspicious_ips(packets, n).join(alert_scores(alerts), "src_ip", "left"))
    context = F.format_string("Source of %d connections", "n")
    return scored.select(
        *_ioc(
            "ip",
            F.col("src_ip"),
            context,
            F.col("first_seen"),
            F.col("last_seen"),
            F.col("confidence"),
        )
    )


def _deduplicated(iocs: DataFrame, dedup: bool) -> DataFrame:
    if not dedup:
        return iocs
    merged = iocs.groupBy("type", "value", "context").agg(
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.max("confidence").alias("confidence"),
    )
    return merged.select(*iocs.columns)


def _domain_ioc() -> tuple[Column, list[Column]]:
    domain = F.regexp_replace(F.col("dns_query"), r"\.+$", "")
    hit = F.col("dns_query").isNotNull() & suspicious_domain(domain)
    ts = F.col("ts")
    return hit, _ioc(
        "domain", domain, F.lit("DNS query detected"), ts, ts, F.lit(DOMAIN_CONFIDENCE)
    )


def _url_ioc() -> tuple[Column, list[Column]]:
    url = F.coalesce(F.concat(F.lit("http://"), "http_host", "http_uri"), F.col("http_uri"))
    hit = F.col("http_method").isNotNull() & suspicious_uri(F.col("http_uri"))
    context = F.concat(F.lit("HTTP "), F.col("http_method"), F.lit(" request"))
    ts = F.col("ts")
    return hit, _ioc("url", url, context, ts, ts, F.lit(URL_CONFIDENCE))


def domain_iocs(packets: DataFrame, dedup: bool = False) -> DataFrame:
    """Suspicious queried domains, one row per query unless ``dedup``."""
    hit, row = _domain_ioc()
    return _deduplicated(packets.filter(hit).select(*row), dedup)


def url_iocs(packets: DataFrame, dedup: bool = False) -> DataFrame:
    """Suspicious requested URLs, one row per request unless ``dedup``."""
    hit, row = _url_ioc()
    return _deduplicated(packets.filter(hit).select(*row), dedup)


def _tokens(texts: DataFrame, text: str, pattern: str) -> DataFrame:
    """Every token of a pattern in whole texts, with the row's time if it has one.

    The outer generator keeps Spark from filtering on the array first, which would
    run the pattern a second time.
    """
    ts = F.col("ts") if "ts" in texts.columns else F.lit(None).cast("timestamp_ntz")
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), 0)
    tokens = texts.select(ts.alias("ts"), F.explode_outer(found).alias("token"))
    return tokens.filter(F.col("token").isNotNull())


def _email_ioc(token: Column, ts: Column) -> list[Column]:
    return _ioc("email", token, F.lit("Address in traffic"), ts, ts, F.lit(0))


def _hash_ioc(token: Column, ts: Column) -> list[Column]:
    kind = F.when(F.length(token) == 32, "md5").when(F.length(token) == 40, "sha1").otherwise("sha256")
    return _ioc("hash", F.lower(token), F.concat(kind, F.lit(" token")), ts, ts, F.lit(0))


def email_iocs(texts: DataFrame, text: str = "text", dedup: bool = False) -> DataFrame:
    """Every address token of a text column."""
    rows = _tokens(texts.filter(F.col(text).contains("@")), text, EMAIL)
    return _deduplicated(rows.select(*_email_ioc(F.col("token"), F.col("ts"))), dedup)


def hash_iocs(texts: DataFrame, text: str = "text", dedup: bool = False) -> DataFrame:
    """Every md5, sha1 or sha256 token of a text column."""
    rows = _tokens(texts, text, HASH)
    return _deduplicated(rows.select(*_hash_ioc(F.col("token"), F.col("ts"))), dedup)


def file_hash_iocs(files: DataFrame, dedup: bool = False) -> DataFrame:
    """The md5 and sha256 of every file of ``carried_files`` that is complete."""
    kinds = [
        F.struct(*_ioc("hash", F.col(kind), F.lit(f"{kind} of a carried file"), F.col("ts"), F.col("ts"), F.lit(0)))
        for kind in ("md5", "sha256")
    ]
    return _deduplicated(files.filter("complete").select(F.inline(F.array(*kinds))), dedup)


def _token_iocs(text: Column) -> list[Column]:
    """Arrays of the indicators in a text; a cheap test goes before either pattern."""

    def rows(may: Column, pattern: str, ioc: Callable[[Column, Column], list[Column]]) -> Column:
        found = F.transform(F.regexp_extract_all(text, F.lit(pattern), 0), lambda x: F.struct(*ioc(x, F.col("ts"))))
        return F.coalesce(F.when(may, found), F.array())

    # 32 letters or digits in a row, however they go on
    long = text.rlike("[0-9A-Fa-f]{32}")
    return [rows(text.contains("@"), EMAIL, _email_ioc), rows(long, HASH, _hash_ioc)]


def all_iocs(
    packets: DataFrame, alerts: DataFrame, dedup: bool = False, text: str | Column | None = None
) -> DataFrame:
    """Address, domain and URL indicators in one table.

    With ``text``, the text of a packet, also the mail addresses and hashes in it. All but
    the addresses share one scan.
    """
    found = F.array_compact(F.array(*[F.when(hit, F.struct(*row)) for hit, row in (_domain_ioc(), _url_ioc())]))
    if text is None:
        named = packets.select(F.inline(found))
    else:
        staged = packets.withColumn("_text", F.col(text) if isinstance(text, str) else text)
        # outer, or Spark would look whether there are any first, with every pattern
        named = staged.select(F.inline_outer(F.concat(found, *_token_iocs(F.col("_text"))))).filter("type is not null")
    return ip_iocs(packets, alerts).unionByName(_deduplicated(named, dedup))


def above(iocs: DataFrame, confidence: int = BLOCKING) -> DataFrame:
    """Indicators sure enough to block."""
    return iocs.filter(F.col("confidence") > confidence)
