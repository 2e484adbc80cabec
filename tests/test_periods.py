"""Periods of events with jitter, missing beats and none at all."""

import random
import re
from datetime import datetime, timedelta

import pytest

from watchfold.operators.detect import beaconing, loose_beaconing, period_statistics

START = datetime(2024, 1, 15)
SCHEMA = "src_ip string, dst_ip string, ts timestamp_ntz"


def pair(name, seconds):
    return [(name, "203.0.113.7", START + timedelta(seconds=s)) for s in seconds]


def beats(rng, period, n, missing=0.0, jitter=0.0, drift=False):
    out, at = [], 0.0
    for k in range(n):
        late = rng.uniform(-jitter, jitter)
        at = at + period + late if drift else k * period + late
        if rng.random() >= missing:
            out.append(1000 + at)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_clocks_are_found_and_chance_is_not(spark, seed):
    rng = random.Random(seed)
    clocks = {
        "even": (300, beats(rng, 300, 200)),
        "missing": (300, beats(rng, 300, 500, missing=0.2, jitter=10)),
        "drifting": (60, beats(rng, 60, 2000, missing=0.2, jitter=3, drift=True)),
        "slow": (3600, beats(rng, 3600, 60, missing=0.2, jitter=120)),
        "two days": (600, beats(rng, 600, 100) + [s + 9_999_999 for s in beats(rng, 600, 100)]),
    }
    chance = {}
    for i, mean in enumerate((5, 60, 300, 300, 1800)):
        at, times = 0.0, []
        for _ in range(400):
            at += rng.expovariate(1 / mean)
            times.append(at)
        chance[f"chance {i}"] = times
    rows = [r for name, (_, s) in clocks.items() for r in pair(name, s)]
    rows += [r for name, s in chance.items() for r in pair(name, s)]
    rows += pair("two", [5, 10]) + pair("one", [5]) + [("null", "203.0.113.7", None)]
    packets = spark.createDataFrame(rows, SCHEMA)
    got = {r.src_ip: r.period for r in loose_beaconing(packets).collect()}
    assert set(got) == set(clocks)
    for name, (period, _) in clocks.items():
        assert got[name] == pytest.approx(period, rel=0.02)
    even = {r.src_ip for r in beaconing(packets).collect()}
    assert "even" in even and "missing" not in even  # what the new one is for


def test_nulls_repeats_and_empty_tables(spark):
    rows = pair(None, [0, 60, 120, 180]) * 3 + pair("a", [0, 60, 120, 180])
    stats = {r.src_ip: r for r in period_statistics(spark.createDataFrame(rows, SCHEMA), ["src_ip", "dst_ip"]).collect()}
    assert tuple(stats[None])[2:] == tuple(stats["a"])[2:]
    assert (stats["a"].period, stats["a"].beats) == (60.0, 4)
    assert stats["a"].coherence == pytest.approx(1) and stats["a"].share == pytest.approx(1)
    named = spark.createDataFrame(pair("a", [0, 7, 14]), "period string, gap string, ts timestamp_ntz")
    assert period_statistics(named, ["gap"]).first()["period"] == 7.0
    assert loose_beaconing(spark.createDataFrame([], SCHEMA)).count() == 0


def test_plan_has_no_window_over_a_whole_key(spark):
    df = spark.createDataFrame(pair("a", [0, 60]), SCHEMA)
    plan = period_statistics(df, ["src_ip"])._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"lag\(.*\[_k0#\d+, _w\d+#\d+\], \[_s", plan)
