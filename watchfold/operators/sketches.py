"""Distinct counts as sketches that are stored per stretch of time and merged over any window.

A sketch has a bounded size whatever it counts, and sketches of neighbouring stretches
merge without the rows behind them: a table of hourly sketches answers for every day, week
or pair of hosts without another scan. Partial sketches are built within tasks, so that a
busy key is one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Logarithm of a sketch's number of buckets.
PRECISION = 12


def error_bound(precision: int = PRECISION) -> float:
    """Relative standard error of an estimate."""
    return 1.04 / 2 ** (precision / 2)


def hourly_sketches(
    df: DataFrame, keys: list[str], value: str | Column, ts: str = "ts", every: str = "hour", precision: int = PRECISION
) -> DataFrame:
    """``keys, bucket, rows, sketch``: distinct values of each key in each ``every`` (hour, day).

    NULL values are not counted; rows without ts have a NULL bucket.
    """
    value = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*keys, F.date_trunc(every, ts).cast("timestamp_ntz").alias("bucket")).agg(
        F.count("*").alias("rows"), F.hll_sketch_agg(value, F.lit(precision)).alias("sketch")
    )


def merged(sketches: DataFrame, *keys: str | Column) -> DataFrame:
    """``keys, rows, sketch``: sketches of all stretches, and of all keys that are not named.

    The result can be stored and merged again; filter by ``bucket`` first for a window.
    """
    return sketches.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.hll_union_agg("sketch").alias("sketch"))


def estimated(sketches: DataFrame, name: str = "distinct") -> DataFrame:
    """Sketches with their estimates in place of them."""
    return sketches.withColumn(name, F.hll_sketch_estimate("sketch")).drop("sketch")


def scan_suspects(sketches: DataFrame, ports: int, deviations: float = 3.0, precision: int = PRECISION) -> DataFrame:
    """Pairs of hosts whose merged sketch of ports may reach ``ports``, from the stored table.

    The estimate counts with ``deviations`` standard errors on top, so that hardly a pair that
    an exact count would name is missing.
    """
    pairs = estimated(merged(sketches, "src_ip", "dst_ip"), "ports")
    return pairs.filter(F.col("ports") * (1 + deviations * error_bound(precision)) >= ports)
