"""Reproducible shuffle into shards by a Feistel permutation.

Rows get global numbers without a global sort: they are dealt to buckets by a hash of all
their columns, numbered within their bucket, and buckets start where the ones before
them end. A Feistel network permutes the numbers below the next power of four; walking
its cycles until a number below n comes up makes it a permutation of 0 to n - 1. The
permuted number's remainder is the shard and its quotient the slot, so that shards are
at most one row apart and slots have no gaps, and either can be computed from a row's
number alone.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from watchfold.llm import words
from watchfold.llm.graphs import fresh, stored
from watchfold.session import ship

ROUNDS = 6
#: Rows of a bucket, on average.
BUCKET_ROWS = 1 << 14


def permute(number: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Where a permutation of 0 to n - 1 takes each number."""
    half = (max(n - 1, 1).bit_length() + 1) // 2
    mask = np.uint64((1 << half) - 1)
    keys = words.mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) + words.mix(np.array([seed], np.uint64)))
    out = np.array(number, dtype=np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        x = out[walking]
        left, right = x >> np.uint64(half), x & mask
        for key in keys:
            left, right = right, left ^ (words.mix(right + key) & mask)
        out[walking] = (left << np.uint64(half)) | right
        walking = walking[out[walking] >= n]
    return out.astype(np.int64)


def numbered(rows: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``rows`` with a column of their global numbers from 0, and how many they are.

    The numbers depend on the rows alone, not on files or partitions. Equal rows are
    grouped before they are shuffled and numbered one after the other.
    """
    columns = rows.columns
    copies, bucket, place, before, start, size = (
        fresh(columns, x) for x in ("copies", "bucket", "place", "before", "start", "size")
    )
    groups = stored(rows.groupBy(*columns).agg(F.count("*").alias(copies)), "rows")
    total, distinct = groups.agg(F.sum(copies), F.count("*")).first()
    buckets = -(-distinct // BUCKET_ROWS) or 1
    hashed = groups.withColumn(bucket, F.pmod(F.xxhash64(*columns), F.lit(buckets)))
    sizes = hashed.groupBy(bucket).agg(F.sum(copies).alias(size))
    earlier = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(bucket, F.coalesce(F.sum(size).over(earlier), F.lit(0)).alias(start))
    within = Window.partitionBy(bucket).orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    placed = hashed.withColumn(before, F.coalesce(F.sum(copies).over(within), F.lit(0))).join(sizes, bucket)
    placed = placed.withColumn(place, F.explode(F.sequence(F.lit(0).cast("long"), F.col(copies) - 1)))
    number = F.col(start) + F.col(before) + F.col(place)
    return placed.select(*columns, number.alias(name)), total or 0


def shard(rows: DataFrame, shards: int, seed: int = 1) -> DataFrame:
    """``rows`` with ``shard`` (int, from 0) and ``slot`` (long, from 0 in each shard).

    Any columns that Spark can group and order will do, nulls included; columns named
    shard or slot are replaced. Equal rows get numbers of their own. An empty table stays
    empty. Numbers change with ``seed`` and, as a shuffle must, with the set of rows.
    """
    ship(rows.sparkSession, "watchfold")
    rows = rows.drop("shard", "slot")
    name = fresh(rows.columns, "number")
    found, total = numbered(rows, name)

    @F.pandas_udf("long")
    def permuted(number: pd.Series) -> pd.Series:
        return pd.Series(permute(number.to_numpy(), total, seed))

    found = found.withColumn(name, permuted(F.col(name)))
    return (
        found.withColumn("shard", (F.col(name) % shards).cast("int"))
        .withColumn("slot", F.expr(f"`{name}` div {int(shards)}"))
        .drop(name)
    )
