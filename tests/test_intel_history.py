"""Responses as of a time against a plain search, and sketches against exact counts."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from watchfold.operators import intel, sketches

START = datetime(2024, 1, 1)


def test_each_row_gets_the_response_of_its_time(spark):
    rng = random.Random(4)

    def time():
        return START + timedelta(hours=rng.randrange(24 * 12))

    rows = [(i, f"10.0.0.{rng.choice([0, 0, 0, 1, 2, 3])}", time()) for i in range(400)]
    rows += [(900, None, time()), (901, "10.0.0.0", None), (902, "10.9.9.9", time())]
    feed = [(f"10.0.0.{rng.choice([0, 1, 2, 7])}", time(), rng.randrange(100)) for _ in range(60)]
    feed += [(None, time(), 1), ("10.0.0.1", None, 2), feed[0], (feed[0][0], feed[0][1], 1000)]
    expected = {}
    for i, ip, at in rows:
        before = [(t, s) for a, t, s in feed if a == ip and a is not None and t is not None and at is not None and t <= at]
        expected[i] = max(before) if before else None
    df = spark.createDataFrame(rows, "id int, ip_address string, event_time timestamp_ntz")
    history = spark.createDataFrame(feed, "ip_address string, valid_from timestamp_ntz, score int")
    for every in ("day", "hour", "year"):
        found = intel.attach_as_of(df.repartition(3), history, "abuse", every=every).collect()
        assert {r["id"]: tuple(r["abuse"]) if r["abuse"] else None for r in found} == expected
        assert len(found) == len(rows)
    assert all(r["abuse"] is None for r in intel.attach_as_of(df, history.limit(0), "abuse").collect())
    assert intel.attach_as_of(df.limit(0), history, "abuse").collect() == []


def test_merged_sketches_come_close(spark):
    df = spark.range(200_000).select(
        (F.col("id") % 3).alias("k"),
        (F.col("id") % 50_000).alias("v"),
        (F.lit(START) + F.make_dt_interval(secs=(F.col("id") % 200) * 1000)).cast("timestamp_ntz").alias("ts"),
    )
    hours = sketches.hourly_sketches(df, ["k"], "v")
    assert hours.select("bucket").distinct().count() == 56
    bound = 4 * sketches.error_bound()
    (all_,) = sketches.estimated(sketches.merged(hours)).collect()
    assert abs(all_["distinct"] - 50_000) <= bound * 50_000 and all_["rows"] == 200_000
    window = hours.filter(F.col("bucket") < F.lit(START + timedelta(hours=10)))
    exact = df.filter(F.col("ts") < F.lit(START + timedelta(hours=10))).groupBy("k").agg(F.count_distinct("v").alias("n"))
    for row in sketches.estimated(sketches.merged(window, "k")).join(exact, "k").collect():
        assert abs(row["distinct"] - row["n"]) <= bound * row["n"]


def test_nulls_count_as_rows_only(spark):
    df = spark.createDataFrame([(None, START), (None, None), (1, START)], "v int, ts timestamp_ntz")
    (row,) = sketches.estimated(sketches.merged(sketches.hourly_sketches(df, [], "v"))).collect()
    assert (row["rows"], row["distinct"]) == (3, 1)
    assert sketches.hourly_sketches(df.limit(0), [], "v").collect() == []
