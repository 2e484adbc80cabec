"""Reputation lookup: join feeds, flag and tier addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchfold.functions.rules import risk_tier


def _as_struct(feed: DataFrame, name: str) -> DataFrame:
    """One row per address; of several the one whose fields, in order, are largest."""
    fields = [c for c in feed.columns if c != "ip_address"]
    return feed.groupBy("ip_address").agg(F.max(F.struct(*fields)).alias(name))


def attach(df: DataFrame, abuse: DataFrame, vt: DataFrame) -> DataFrame:
    """Left joins of both feeds as the struct columns ``abuse`` and ``vt``.

    A feed with several rows for an address counts with the largest. There is no
    broadcast hint: Spark
    broadcasts a feed only when its size is below the session's threshold, at
    planning time or from the measured size at run time, and shuffles otherwise
    with its skew handling on. Works with a stream on the left side.
    """
    return df.join(_as_struct(abuse, "abuse"), "ip_address", "left").join(
        _as_struct(vt, "vt"), "ip_address", "left"
    )


def enrich(ips: DataFrame, abuse: DataFrame, vt: DataFrame) -> DataFrame:
    """One row per address that at least one feed knows: ``ip_address, abuse, vt``.

    Addresses become distinct before the joins, so a hot address is one row by then.
    """
    return attach(ips.select("ip_address").distinct(), abuse, vt).filter(
        F.col("abuse").isNotNull() | F.col("vt").isNotNull()
    )


def attach_as_of(
    df: DataFrame, feed: DataFrame, name: str, ts: str = "event_time", valid_from: str = "valid_from", every: str = "day"
) -> DataFrame:
    """Adds the struct ``name`` of the response that was valid at each row's time.

    ``feed`` has a row per ``ip_address`` and ``valid_from``; a response holds until the next
    one. Of several with one time the one whose fields are largest counts. A busy address is
    cut into days (``every``): the last response of each day, a row per address and day,
    is carried on to the days behind it, so that no window is longer than one of them.
    Rows before the first response, without time or without address get NULL.
    """
    fields = [c for c in feed.columns if c not in ("ip_address", valid_from)]
    held = F.struct(F.col(valid_from).alias("valid_from"), *fields)
    dated = feed.filter(F.col("ip_address").isNotNull() & F.col(valid_from).isNotNull())
    dated = dated.groupBy("ip_address", F.col(valid_from).alias("_time")).agg(F.max(held).alias(name))

    def day(time: Column) -> Column:
        return F.date_trunc(every, time).cast("timestamp_ntz").alias("_day")

    dated = dated.select("ip_address", "_time", name, day(F.col("_time")))
    known = dated.groupBy("ip_address", "_day").agg(F.max_by(name, "_time").alias("_last"))
    wanted = df.filter(F.col("ip_address").isNotNull() & F.col(ts).isNotNull())
    wanted = wanted.select("ip_address", day(F.col(ts))).distinct().withColumn("_asked", F.lit(1))
    days = known.join(wanted, ["ip_address", "_day"], "full")
    before = Window.partitionBy("ip_address").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    carried = days.withColumn(name, F.last("_last", ignorenulls=True).over(before))
    carried = carried.filter(F.col("_asked").isNotNull() & F.col(name).isNotNull())
    # what is carried comes first, then responses, then the rows that ask for them
    asking = F.struct(*df.columns)
    rows = df.select("ip_address", F.col(ts).alias("_time"), day(F.col(ts)), F.lit(2).alias("_kind"), asking.alias("_row"))
    states = carried.select("ip_address", F.col("_day").alias("_time"), "_day", F.lit(0).alias("_kind"), name).unionByName(
        dated.select("ip_address", "_time", "_day", F.lit(1).alias("_kind"), name)
    )
    every_row = rows.unionByName(states, allowMissingColumns=True)
    so_far = Window.partitionBy("ip_address", "_day").orderBy("_time", "_kind")
    found = every_row.withColumn(name, F.last(name, ignorenulls=True).over(so_far)).filter("_kind = 2")
    askable = F.col("ip_address").isNotNull() & F.col("_time").isNotNull()
    return found.select("_row.*", F.when(askable, F.col(name)).alias(name))


def abuse_score() -> Column:
    return F.coalesce("abuse.abuse_confidence_score", F.lit(0))


def vt_malicious() -> Column:
    return F.coalesce("vt.malicious", F.lit(0))


def flag(enriched: DataFrame, min_confidence: int = 50) -> DataFrame:
    """Addresses with a high enough abuse score or any engine that calls them malicious."""
    return enriched.filter((abuse_score() >= min_confidence) | (vt_malicious() > 0))


def with_tier(enriched: DataFrame) -> DataFrame:
    """Adds ``risk_tier``."""
    return enriched.withColumn("risk_tier", risk_tier(abuse_score()))


def flagged_table(enriched: DataFrame, min_confidence: int = 50, limit: int | None = None) -> DataFrame:
    """Flagged addresses with score, malicious count, country and reports.

    With ``limit`` the worst so many, in order; a whole table has no order.
    """
    rows = (
        with_tier(flag(enriched, min_confidence))
        .select(
            "ip_address",
            abuse_score().alias("abuse_score"),
            vt_malicious().alias("vt_malicious"),
            F.coalesce("abuse.country_name", F.lit("Unknown")).alias("country"),
            F.coalesce("abuse.total_reports", F.lit(0)).alias("reports"),
            "risk_tier",
        )
    )
    return rows if limit is None else rows.orderBy(F.desc("abuse_score"), F.asc("ip_address")).limit(limit)


def ip_details(enriched: DataFrame) -> DataFrame:
    """All figures per address with the report's defaults for absent ones."""
    listed = F.coalesce("abuse.is_whitelisted", F.lit(False))
    return enriched.select(
        "ip_address",
        F.col("abuse").isNotNull().alias("has_abuse"),
        F.col("vt").isNotNull().alias("has_vt"),
        F.coalesce(F.col("abuse.abuse_confidence_score").cast("string"), F.lit("N/A")).alias(
            "abuse_confidence_score"
        ),
        F.coalesce("abuse.country_name", F.lit("Unknown")).alias("country_name"),
        F.coalesce("abuse.country_code", F.lit("N/A")).alias("country_code"),
        F.coalesce("abuse.total_reports", F.lit(0)).alias("total_reports"),
        F.coalesce("abuse.num_distinct_users", F.lit(0)).alias("num_distinct_users"),
        F.when(listed, "Yes").otherwise("No").alias("whitelisted"),
        *[
            F.coalesce(f"vt.{name}", F.lit(0)).alias(name)
            for name in ("malicious", "suspicious", "harmless", "undetected")
        ],
    )
