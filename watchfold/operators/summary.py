"""Figures over log entries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from watchfold.operators.intel import abuse_score, enrich, attach, vt_malicious
from watchfold.functions.rules import HIGH_RISK

# The report's wording per status code.
STATUS_TEXT = {
    200: "Successful requests",
    301: "Permanent redirects",
    302: "Temporary redirects",
    400: "Bad request",
    401: "Unauthorized - potential brute force",
    403: "Forbidden - probe attempts",
    404: "Not found - directory enumeration",
    500: "Server errors",
}
UNAUTHORIZED = (401, 403)


def unique_ips(entries: DataFrame) -> DataFrame:
    return entries.select("ip_address").distinct()


def unique_ip_count(entries: DataFrame, approximate: bool = False) -> DataFrame:
    """Number of addresses; the approximate form keeps a small sketch per task."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return entries.agg(count("ip_address").alias("unique_ips"))


def ip_counts(entries: DataFrame) -> DataFrame:
    return entries.groupBy("ip_address").agg(F.count("*").alias("request_count"))


def top_ips(entries: DataFrame, n: int = 50) -> DataFrame:
    """The busiest addresses, as the batch to look up."""
    return ip_counts(entries).orderBy(F.desc("request_count"), F.asc("ip_address")).limit(n)


def sample_lines(entries: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` raw lines of each address.

    Spark cuts each partition to ``n`` rows per address before the shuffle, so a
    hot address sends few rows and no list is longer than ``n``.
    """
    first = Window.partitionBy("ip_address").orderBy("event_time", "raw")
    ranked = (
        entries.select("ip_address", "event_time", "raw")
        .withColumn("rank", F.row_number().over(first))
        .filter(F.col("rank") <= n)
    )
    lines = F.array_sort(F.collect_list(F.struct("rank", "raw")))["raw"]
    return ranked.groupBy("ip_address").agg(lines.alias("raw_log_entries"))


def indicators(
    entries: DataFrame, abuse: DataFrame, vt: DataFrame, samples: int = 5
) -> DataFrame:
    """One threat indicator per address: activity, reputation and sample lines."""
    activity = entries.groupBy("ip_address").agg(
        F.min("event_time").alias("first_seen"),
        F.max("event_time").alias("last_seen"),
        F.count("*").alias("request_count"),
    )
    known = attach(activity, abuse, vt).select(
        "ip_address",
        "first_seen",
        "last_seen",
        "request_count",
        F.col("abuse.abuse_confidence_score").alias("abuse_confidence_score"),
        (vt_malicious() > 0).alias("is_malicious"),
        F.col("abuse.country_code").alias("country_code"),
        F.col("abuse.country_name").alias("country_name"),
        F.coalesce("abuse.is_whitelisted", F.lit(False)).alias("is_whitelisted"),
        *(
            [F.col("abuse.categories").cast("array<string>").alias("threat_categories")]
            if "categories" in abuse.columns
            else []
        ),
        F.col("vt").alias("virus_total_stats"),
    )
    return known.join(sample_lines(entries, samples), "ip_address", "left")


def status_distribution(entries: DataFrame) -> DataFrame:
    """Entries per status code; absent and zero codes do not count."""
    return (
        entries.filter(F.col("status_code") > 0)
        .groupBy("status_code")
        .agg(F.count("*").alias("n"))
    )


def status_table(entries: DataFrame) -> DataFrame:
    """The distribution with the report's wording; a literal map needs no join."""
    texts = F.create_map(*[F.lit(x) for pair in STATUS_TEXT.items() for x in pair])
    return status_distribution(entries).withColumn(
        "description", F.try_element_at(texts, F.col("status_code"))
    )


def log_summary(
    entries: DataFrame,
    enriched: DataFrame,
    min_confidence: int = 50,
    sources: tuple[str, ...] = ("abuse", "vt"),
) -> DataFrame:
    """One row: entry, address and risk counts and the status distribution as a map.

    Entries are scanned once, down to one row per address and status; both figures
    over entries come from that. The one-row parts meet in a union, not a join.
    """
    return _summary(_per_ip_status(entries), enriched, min_confidence, sources)


def summary_with_feeds(
    entries: DataFrame,
    abuse: DataFrame,
    vt: DataFrame,
    min_confidence: int = 50,
    sources: tuple[str, ...] = ("abuse", "vt"),
) -> DataFrame:
    """The summary of entries whose addresses are looked up in the feeds here.

    The addresses come from the same counts as the other figures, so that entries are
    parsed once.
    """
    counts = _per_ip_status(entries)
    # the filter holds always; with it both uses read the same shuffle
    return _summary(counts, enrich(counts.filter("n > 0"), abuse, vt), min_confidence, sources)


def _per_ip_status(entries: DataFrame) -> DataFrame:
    return entries.groupBy("ip_address", "status_code").agg(F.count("*").alias("n"))


def _summary(
    per_ip_status: DataFrame, enriched: DataFrame, min_confidence: int, sources: tuple[str, ...]
) -> DataFrame:
    totals = per_ip_status.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_entries"),
        F.count_distinct("ip_address").alias("unique_ips"),
    )
    by_status = (
        per_ip_status.groupBy("status_code")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("status_code") > 0)
        # at most one row per three-digit code
        .agg(
            F.map_from_entries(F.array_sort(F.collect_list(F.struct("status_code", "n")))).alias(
                "status_code_distribution"
            )
        )
    )
    risks = enriched.agg(
        F.count_if(abuse_score() >= min_confidence).alias("flagged_ips"),
        F.count_if(vt_malicious() > 0).alias("malicious_ips"),
        F.count_if(abuse_score() >= HIGH_RISK).alias("high_risk_ips"),
    )
    parts = totals.unionByName(risks, allowMissingColumns=True).unionByName(
        by_status, allowMissingColumns=True
    )
    counts = ("total_entries", "unique_ips", "flagged_ips", "malicious_ips", "high_risk_ips")
    return parts.agg(
        *[F.max(c).alias(c) for c in counts],
        F.first("status_code_distribution", ignorenulls=True).alias("status_code_distribution"),
    ).withColumn("apis_queried", F.array(*[F.lit(s) for s in sources]))


def unauthorized(entries: DataFrame) -> DataFrame:
    """Refused web requests (401, 403) per address."""
    return (
        entries.filter(F.col("status_code").isin(*UNAUTHORIZED))
        .groupBy("ip_address")
        .agg(
            F.count("*").alias("refused"),
            F.min("event_time").alias("first_seen"),
            F.max("event_time").alias("last_seen"),
        )
    )


def allow(df: DataFrame, ips: DataFrame) -> DataFrame:
    """Rows whose address is not on the allow list."""
    return df.join(ips.select("ip_address").distinct(), "ip_address", "left_anti")


def deny(df: DataFrame, ips: DataFrame) -> DataFrame:
    """Rows whose address is on the deny list."""
    return df.join(ips.select("ip_address").distinct(), "ip_address", "left_semi")


def update_list(ips: DataFrame, remove: DataFrame, add: DataFrame) -> DataFrame:
    """A list without the removed addresses and with the added ones."""
    key = ["ip_address"]
    return (
        ips.select(key)
        .join(remove.select(key).distinct(), key, "left_anti")
        .unionByName(add.select(key))
        .distinct()
    )
