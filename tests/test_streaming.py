"""Streams fed file by file must agree with the batch operators."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check import compare, connect
from suite.capture_data import global_header, record
from watchfold import streaming
from watchfold.operators import summary
from watchfold.operators.detect import sensitive_keyword
from watchfold.operators.logs import parse_logs
from watchfold.operators.traffic import flows
from watchfold.sources.log_lines import read_log_lines
from watchfold.streaming import streams

START = datetime(2024, 1, 1)
LINE = 'Jan {d:2d} {h:02d}:{m:02d}:00 host sshd[1]: Failed password for u from 1.1.1.{i} port 22 ssh2'


@pytest.fixture
def log_folder(tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    for day in range(1, 6):
        lines = [LINE.format(d=day, h=h, m=m, i=m % 3) for h in range(24) for m in range(0, 60, 5)]
        (folder / f"{day}.log").write_text("\n".join(lines) + "\nnoise\n")
    return str(folder)


def finish(stream, tmp_path, sink=None, mode="append"):
    out = str(tmp_path / "out")
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", str(tmp_path / "state"))
    writer = writer.foreachBatch(sink(out)) if sink else writer.format("parquet").option("path", out)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    assert sum(p.numInputRows > 0 for p in query.recentProgress) > 1, "expected several batches"
    return out


def test_stream_parses_like_batch(spark, log_folder, tmp_path):
    stream = streaming.entry_stream(spark, log_folder, 2024, max_files_per_trigger=1)
    got = spark.read.schema(stream.schema).parquet(finish(stream, tmp_path)).drop("file_path", "line_number")
    batch = parse_logs(read_log_lines(spark, log_folder), year=2024).drop("file_path", "line_number")
    assert got.count() == 5 * 288
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_indicator_batches_merge_to_the_batch_result(spark, log_folder, tmp_path):
    stream = streaming.entry_stream(spark, log_folder, 2024, max_files_per_trigger=1)
    out = finish(stream, tmp_path, streaming.indicator_sink)
    got = {r.ip_address: r for r in streaming.latest_indicators(spark, out).collect()}
    entries = parse_logs(read_log_lines(spark, log_folder), year=2024)
    samples = {r.ip_address: r.raw_log_entries for r in summary.sample_lines(entries).collect()}
    assert len(got) == 3
    for r in entries.groupBy("ip_address").agg(F.min("event_time").alias("a"), F.max("event_time").alias("b"), F.count("*").alias("n")).collect():
        own = got[r.ip_address]
        assert (own.first_seen, own.last_seen, own.request_count) == (r.a, r.b, r.n)
        assert len(own.raw_log_entries) == 5
    assert set(samples) == set(got)


def test_a_repeated_batch_counts_once(spark, log_folder, tmp_path):
    entries = parse_logs(read_log_lines(spark, log_folder), year=2024)
    write = streaming.indicator_sink(str(tmp_path / "out"))
    write(entries, 0)
    write(entries, 0)
    assert streaming.latest_indicators(spark, str(tmp_path / "out")).agg(F.sum("request_count")).first()[0] == 5 * 288


@pytest.mark.parametrize(("batches", "fanout"), [(1, 2), (7, 2), (100, 8)])
def test_merged_levels_equal_the_batch_and_stay_few(spark, tmp_path, batches, fanout):
    out = str(tmp_path / "out")
    rows = [(f"1.1.1.{i % 7}", START + timedelta(minutes=i), f"line {i}") for i in range(300)]
    write = streaming.indicator_sink(out, fanout=fanout)
    schema = "ip_address string, event_time timestamp_ntz, raw string"
    for k in range(batches):
        some = spark.createDataFrame([r for i, r in enumerate(rows) if i * batches // 300 == k], schema).coalesce(1)
        write(some, k)
        if k % 25 == 6:  # the last batch again
            write(some, k)
    got = sorted(map(tuple, streaming.latest_indicators(spark, out).collect()))
    want = []
    for i in range(7):
        own = [r for r in rows if r[0] == f"1.1.1.{i}"]
        want.append((own[0][0], own[0][1], own[-1][1], len(own), [r[2] for r in own[:5]]))
    assert got == want
    runs = streams._cover(streams._complete_runs(out))
    assert [a for a, _ in runs] == [0, *(b + 1 for _, b in runs[:-1])] and runs[-1][1] == batches - 1
    levels = 1
    while fanout**levels <= batches:
        levels += 1
    assert len(runs) <= (fanout - 1) * levels
    # unmerged and merged folders on disk, one merge back at most
    assert len(streams._complete_runs(out)) <= 3 * fanout * levels


def test_bursts_do_not_depend_on_batches(spark, packet_stream, tmp_path):
    stream, batch = packet_stream
    bursts = streaming.alert_bursts(sensitive_keyword(stream), "30 minutes", "10 minutes")
    rows = sorted((r.first_ts, r.last_ts, r.alerts) for r in spark.read.parquet(finish(bursts, tmp_path)).collect())
    # 60 alerts a minute apart, an hour of quiet; the last hour is still open
    assert rows == [(START + timedelta(hours=h), START + timedelta(hours=h, minutes=59), 60) for h in (0, 2, 4)]
    whole = streaming.alert_bursts(sensitive_keyword(batch), "30 minutes")
    assert whole.count() == 4
    nothing = streaming.alert_bursts(sensitive_keyword(batch.limit(0)), "30 minutes")
    assert nothing.count() == 0


def test_login_alerts_of_closed_windows(spark, log_folder, tmp_path):
    entries = streaming.entry_stream(spark, log_folder, 2024, max_files_per_trigger=1)
    out = finish(streaming.login_alerts(entries, "1 hour", n=4, delay="10 minutes"), tmp_path)
    rows = spark.read.parquet(out).collect()
    # 5 days of 24 hours and 3 addresses; the last window is still open
    assert len(rows) == (5 * 24 - 1) * 3 and {r.failures for r in rows} == {4}
    assert max(r.window_end for r in rows) == datetime(2024, 1, 5, 23)


PACKETS = """packet_id bigint, ts timestamp_ntz, src_ip string, dst_ip string, src_port int, dst_port int,
  protocol string, length int, flag_bits int, payload binary"""


@pytest.fixture
def packet_stream(spark, tmp_path):
    folder = str(tmp_path / "packets")
    for part in range(4):
        rows = [
            (i, START + timedelta(minutes=part * 120 + i), "10.0.0.1", "8.8.8.8", 1, i % 30, "TCP", 10, 2, bytearray(b"a token"))
            for i in range(60)
        ]
        spark.createDataFrame(rows, PACKETS).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(PACKETS).option("maxFilesPerTrigger", 1).parquet(folder), spark.read.parquet(folder)


def test_scans_count_distinct_ports(spark, packet_stream, tmp_path):
    stream, _ = packet_stream
    rows = spark.read.parquet(finish(streaming.scan_alerts(stream, "1 hour", 30, "10 minutes"), tmp_path)).collect()
    # the fourth hour of traffic stays open
    assert sorted(r.window_start.hour for r in rows) == [0, 2, 4] and {r.ports for r in rows} == {30}


def test_floods_per_window(spark, packet_stream, tmp_path):
    stream, _ = packet_stream
    rows = spark.read.parquet(finish(streaming.flood_alerts(stream, "1 hour", 50, "10 minutes"), tmp_path)).collect()
    assert sorted((r.window_start.hour, r.attempts) for r in rows) == [(0, 60), (2, 60), (4, 60)]


def test_sessions_split_flows_at_idle_gaps(spark, packet_stream, tmp_path):
    stream, batch = packet_stream
    same_port = batch.withColumn("dst_port", F.lit(80))
    out = finish(streaming.flow_sessions(stream.withColumn("dst_port", F.lit(80)), "30 minutes", "10 minutes"), tmp_path)
    rows = spark.read.parquet(out).orderBy("start_time").collect()
    assert [(r.start_time.hour, r.packet_count, r.flags) for r in rows] == [(h, 60, ["SYN"]) for h in (0, 2, 4)]
    assert flows(same_port).first().packet_count == 240


def test_equal_alerts_come_through_once_per_delay(spark, packet_stream, tmp_path):
    stream, batch = packet_stream
    alerts = streaming.dedup_alerts(sensitive_keyword(stream), "1 hour")
    rows = spark.read.parquet(finish(alerts, tmp_path)).count()
    assert 2 <= rows <= 4 and sensitive_keyword(batch).count() == 240


def test_captures_arrive_as_packets(spark, tmp_path):
    from tests.test_captures import ipv4, udp

    folder = tmp_path / "captures"
    folder.mkdir()
    for i in range(3):
        body = global_header() + b"".join(record(1_000_000 * k, ipv4(17, udp(b"x", 5, i))) for k in range(4))
        (folder / f"{i}.pcap").write_bytes(body)
    stream = streaming.packet_stream(spark, str(folder), max_files_per_trigger=1)
    rows = spark.read.parquet(finish(stream.select("dst_port", "ts"), tmp_path)).groupBy("dst_port").count().collect()
    assert sorted(map(tuple, rows)) == [(0, 4), (1, 4), (2, 4)]


@pytest.mark.parametrize(
    "name",
    # what comes through w7_dedup_alerts depends on the batches, and its SQL is that of one
    [n for n in sorted(entry.queries()) if n.startswith("w") and n != "w7_dedup_alerts"],
)
def test_streams_read_folders_file_by_file(spark, split_events, name):
    """The same rows in several time-ordered files, one per batch, give the same results."""
    folder, duck = split_events
    assert compare(spark, duck, folder, name).startswith("ok")


@pytest.fixture(scope="module")
def split_events(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    rows = spark.read.parquet("/root/testdata/sf0.001/events.parquet").toPandas().sort_values(["ts", "event_id"])
    (folder / "events.parquet").mkdir()
    for k in range(4):
        some = rows.iloc[len(rows) * k // 4 : len(rows) * (k + 1) // 4]
        path = folder / "events.parquet" / f"part-{k}.parquet"
        some.to_parquet(path, coerce_timestamps="us", index=False)
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))  # files come in the order of their age
    return str(folder), connect(str(folder))


def test_a_missing_table_fails(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        entry.queries()["w1_stream_parse"](spark, str(tmp_path))
