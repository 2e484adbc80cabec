"""pcapng files, and range borders of both formats at every byte."""

import random
import struct
from datetime import datetime

import pytest

from suite.capture_data import block, global_header, interface, packet_block, section
from watchfold.sources import captures
from watchfold.sources.captures import read_frames, skipped_bytes

MICROS = 1705312800_123456


def frames(count, seed=1, low=20, high=900):
    made = random.Random(seed)
    # the first bytes of a frame, read as lengths, are larger than any packet
    return [b"\x02\x7f" * 6 + made.randbytes(made.randrange(low, high)) for _ in range(count)]


def classic(rows, order="<", limit=262144, cut=None):
    out = global_header(order, snaplen=limit)
    for i, frame in enumerate(rows):
        kept = frame[:limit] if cut is None else frame[:cut]
        out += struct.pack(order + "IIII", 1705312800 + i, 5 * i, len(kept), len(frame)) + kept
    return out


def blocks(rows, order="<", every=40):
    """Sections of ``every`` packets in turn of both byte orders, interfaces added on the way."""
    out = b""
    for i, frame in enumerate(rows):
        if i % every == 0:
            order = "<>"[i // every % 2]
            out += section(order) + interface(order=order)
        if i % every == every // 2:
            out += interface(link=101, resolution=9, offset=1_700_000_000, order=order)
        if i % 7 == 0:
            out += block(5, bytes(20), order)  # statistics: not a packet
        late = i % every >= every // 2
        units = (MICROS + i - 1_700_000_000_000_000) * 1000 if late else MICROS + i
        out += packet_block(int(late), units, frame, order)
    return out


def opened(tmp_path, data):
    path = tmp_path / "x.cap"
    path.write_bytes(data)
    return captures._open(str(path), len(data))


@pytest.mark.parametrize("kind", ["lawful", "cut at the limit", "cut below the limit", "big-endian", "empty frames", "pcapng"])
def test_every_byte_as_border_finds_the_next_record(tmp_path, monkeypatch, kind):
    monkeypatch.setattr(captures, "MAX_RECORD", 2000)
    rows = frames(60)
    if kind == "pcapng":
        data = blocks(rows)
    elif kind == "cut at the limit":
        data = classic(rows, limit=300)
    elif kind == "cut below the limit":
        data = classic(rows, cut=200)
    elif kind == "empty frames":
        data = classic([b"" if i % 5 == 0 else f for i, f in enumerate(rows)])
    else:
        data = classic(rows, ">" if kind == "big-endian" else "<")
    capture = opened(tmp_path, data)
    if kind == "pcapng":
        starts = [at for _, at, _, _ in capture._walk(0, len(data), captures._Section(), "fail")]
    else:
        starts = [r.at for r in capture.records(24, len(data))]
    expected, wrong = iter([*starts, len(data)]), []
    current = next(expected)
    for border in range(len(data)):
        while current < border:
            current = next(expected)
        if capture.first_record(border) != current:
            wrong.append((border, current))
    assert wrong == []


def written(tmp_path, **files):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, data in files.items():
        (folder / name).write_bytes(data)
    return str(folder)


def test_ranges_read_what_one_task_reads(spark, tmp_path):
    rows = frames(4000)
    folder = written(tmp_path, a=blocks(rows, every=900), b=blocks(rows[:50]), c=classic(rows[:2500]))
    whole = read_frames(spark, folder, on_damage="stop")
    parts = read_frames(spark, folder, chunk_bytes=4 * captures.MAX_RECORD)
    assert parts.count() == 6550
    assert whole.exceptAll(parts).count() == 0 and parts.exceptAll(whole).count() == 0
    got = parts.filter("capture like '%/a'").orderBy("packet_id").collect()
    assert [bytes(r.frame) for r in got] == rows
    assert [r.link for r in got] == [101 if i % 900 >= 450 else 1 for i in range(4000)]
    assert [r.ts for r in got] == [datetime.fromtimestamp((MICROS + i) // 10**6).replace(microsecond=(MICROS + i) % 10**6) for i in range(4000)]


@pytest.mark.parametrize("order", ["<", ">"])
def test_ranges_within_one_section_of_either_byte_order(spark, tmp_path, order):
    rows = frames(6000)
    data = section(order) + interface(order=order)
    data += b"".join(packet_block(0, MICROS + i, frame, order) for i, frame in enumerate(rows))
    assert len(data) > 2 * 4 * captures.MAX_RECORD
    parts = read_frames(spark, written(tmp_path, a=data), chunk_bytes=4 * captures.MAX_RECORD)
    assert [bytes(r.frame) for r in parts.orderBy("packet_id").collect()] == rows


def borders_within(data, capture):
    """For places a little behind each block's begin: where they are, and the block that follows."""
    ends = [end for _, _, _, end in capture._walk(0, len(data), captures._Section(), "fail")]
    return [(start + late, end) for start, end in zip([0, *ends], ends) for late in (4, 28, 48) if start + late <= end]


@pytest.mark.parametrize("order", ["<", ">"])
def test_equal_words_far_apart_are_no_block(tmp_path, monkeypatch, order):
    monkeypatch.setattr(captures, "MAX_RECORD", 2000)
    word = struct.pack(order + "I", 4096)  # longer than a usual record
    data = section(order) + interface(order=order)
    data += b"".join(packet_block(0, MICROS + i, word * 50, order) for i in range(100))
    capture = opened(tmp_path, data)
    assert [x for x in borders_within(data, capture) if capture.first_record(x[0]) != x[1]] == []


@pytest.mark.parametrize("order", ["<", ">"])
def test_lengths_read_in_the_other_byte_order_are_no_block(tmp_path, monkeypatch, order):
    monkeypatch.setattr(captures, "MAX_RECORD", 20_000)
    made, data = random.Random(3), section(order) + interface(order=order)
    for i in range(1500):  # every second block is of 256 bytes, which read the other way are 65536
        frame = made.randbytes(224 if i % 2 else 4 * made.randrange(12, 40))
        data += packet_block(0, MICROS + i, frame[:36] + struct.pack(order + "I", 256) + frame[40:], order)
    capture = opened(tmp_path, data)
    assert [x for x in borders_within(data, capture) if capture.first_record(x[0]) != x[1]] == []


def test_blocks_of_other_kinds_and_long_ones_are_borders(tmp_path, monkeypatch):
    monkeypatch.setattr(captures, "MAX_RECORD", 2000)
    made = random.Random(4)
    data = section() + b"".join(block(0x80000001, made.randbytes(4 * made.randrange(9, 200))) for _ in range(80))
    data += interface() + b"".join(packet_block(0, MICROS, made.randbytes(7000)) for _ in range(40))
    capture = opened(tmp_path, data)
    starts = {at for _, at, _, _ in capture._walk(0, len(data), captures._Section(), "fail")} | {len(data)}
    assert {capture.first_record(border) for border in range(0, len(data), 97)} <= starts


@pytest.mark.parametrize("order", ["<", ">"])
def test_ranges_over_packets_of_equal_words(spark, tmp_path, order):
    word = struct.pack(order + "I", 655_360)
    rows = [word * (10 + i % 40) for i in range(20_000)]
    data = section(order) + interface(order=order)
    data += b"".join(packet_block(0, MICROS + i, frame, order) for i, frame in enumerate(rows))
    assert len(data) > 2 * 4 * captures.MAX_RECORD
    parts = read_frames(spark, written(tmp_path, a=data), chunk_bytes=4 * captures.MAX_RECORD)
    assert [bytes(r.frame) for r in parts.orderBy("packet_id").collect()] == rows


def test_damage_in_a_later_range_is_told_where_it_is(tmp_path, monkeypatch):
    monkeypatch.setattr(captures, "MAX_RECORD", 2000)
    made = [packet_block(0, MICROS + i, frame, ">") for i, frame in enumerate(frames(60))]
    head = section(">") + interface(order=">")
    start, bad = len(head) + len(made[0]), len(head) + sum(map(len, made[:40]))
    data = bytearray(head + b"".join(made))
    data[bad + 4] ^= 0x70  # the length of a packet behind forty others
    with pytest.raises(ValueError, match=f"damaged record at byte {bad} "):
        opened(tmp_path, bytes(data)).descriptions(start, len(data))


@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize(("resolution", "per_second"), [(None, 10**6), (3, 10**3), (9, 10**9), (0x80 | 20, 1 << 20)])
def test_clocks(spark, tmp_path, order, resolution, per_second):
    units = 1705312800 * per_second + per_second // 4
    data = section(order) + interface(resolution=resolution, order=order) + packet_block(0, units, b"abc", order, original=9)
    row = read_frames(spark, written(tmp_path, a=data)).first()
    assert (row.ts, row.orig_len, bytes(row.frame)) == (datetime(2024, 1, 15, 10, 0, 0, 250000), 9, b"abc")


def test_simple_and_old_packets(spark, tmp_path):
    data = section() + interface(limit=6)
    data += block(3, struct.pack("<I", 8) + b"abcdef")
    data += block(2, struct.pack("<HHIIII", 0, 3, MICROS >> 32, MICROS & 0xFFFFFFFF, 2, 4) + b"xy")
    rows = read_frames(spark, written(tmp_path, a=data)).orderBy("packet_id").collect()
    assert [(r.ts, r.orig_len, bytes(r.frame)) for r in rows] == [
        (None, 8, b"abcdef"),
        (datetime(2024, 1, 15, 10, 0, 0, 123456), 4, b"xy"),
    ]


def test_damage_fails_or_ends_the_file(spark, tmp_path):
    good = section() + interface() + packet_block(0, MICROS, b"a" * 40)
    bad = bytearray(good + packet_block(0, MICROS, b"b" * 40) + packet_block(0, MICROS, b"c" * 40))
    bad[len(good) + 72 - 4] ^= 1  # the length behind the second packet
    folder = written(tmp_path, a=bytes(bad))
    with pytest.raises(Exception, match="damaged"):
        read_frames(spark, folder).collect()
    assert read_frames(spark, folder, on_damage="stop").count() == 1
    row = skipped_bytes(spark, folder).first()
    assert (row.damaged_at, row.skipped_bytes) == (len(good), len(bad) - len(good))
    (tmp_path / "in" / "a").write_bytes(section() + packet_block(0, MICROS, b"no interface"))
    with pytest.raises(Exception, match="damaged"):
        read_frames(spark, folder).collect()


def test_a_cut_off_block_gives_what_is_there(spark, tmp_path):
    data = section() + interface() + packet_block(0, MICROS, b"a" * 40) + packet_block(0, MICROS, b"b" * 40)
    rows = read_frames(spark, written(tmp_path, a=data[:-20])).orderBy("packet_id").collect()
    assert [len(r.frame) for r in rows] == [40, 24]
    (tmp_path / "in" / "a").write_bytes(section())
    assert read_frames(spark, str(tmp_path / "in")).count() == 0


def test_small_files_are_read_by_several_tasks(spark, tmp_path):
    folder = written(tmp_path, **{f"f{i}": classic(frames(3)) for i in range(20)})
    parts = read_frames(spark, folder)
    assert parts.rdd.getNumPartitions() == 8 and parts.count() == 60


def test_streams_read_block_files(spark, tmp_path):
    folder = written(tmp_path, a=blocks(frames(3000)), b=classic(frames(10)))
    stream = captures.read_frame_stream(spark, folder, chunk_bytes=4 * captures.MAX_RECORD)
    query = stream.writeStream.format("memory").queryName("blocks").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("blocks").count() == 3010
