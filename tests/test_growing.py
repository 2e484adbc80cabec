"""Streams over files that grow, rotate and are cut into small ranges."""

import random

import pytest

from watchfold.sources import growing
from watchfold.sources.growing import _Reader, read_growing_lines


def lines_of(reader, start, end):
    out = []
    for part in reader.partitions(start, end):
        for batch in reader.read(part):
            out += zip(batch.column("place").to_pylist(), batch.column("line").to_pylist(), strict=True)
    return out


@pytest.mark.parametrize("size", [1, 2, 7, 50, 10_000])
def test_ranges_of_any_size_give_every_line_once(tmp_path, monkeypatch, size):
    rng = random.Random(size)
    monkeypatch.setattr(growing, "_READ", 16)
    lines = [bytes(rng.randrange(97, 123) for _ in range(rng.choice([0, 1, 5, 40]))) for _ in range(120)]
    (tmp_path / "a.log").write_bytes(b"\n".join(lines) + b"\nunfinished")
    reader = _Reader(str(tmp_path), size)
    end = reader.latestOffset()
    got = lines_of(reader, {}, end)
    assert [line for _, line in sorted(got)] == lines and len(got) == len(lines)
    assert lines_of(reader, end, reader.latestOffset()) == []


def test_rotated_and_replaced_files(tmp_path):
    log, old = tmp_path / "x.log", tmp_path / "x.log.1"
    reader = _Reader(str(tmp_path), 1 << 20)

    def take(state=[{}]):  # noqa: B006
        end = reader.latestOffset()
        got = [line.decode() for _, line in lines_of(reader, state[0], end)]
        state[0] = end
        return got

    log.write_text("one\ntwo\n")
    assert take() == ["one", "two"]
    with log.open("a") as file:
        file.write("three\r\nfou")
    assert take() == ["three"]
    with log.open("a") as file:
        file.write("r\n")
    log.rename(old)
    log.write_text("new one\n")
    assert sorted(take()) == ["four", "new one"]
    assert take() == []
    log.write_text("a\n")  # cut off and begun anew
    assert take() == ["a"]
    log.write_text("something else, and longer than before\n")
    assert take() == ["something else, and longer than before"]
    old.unlink()
    (tmp_path / "_hidden").write_text("no\n")
    (tmp_path / "empty").write_text("")
    assert take() == []


def run(spark, folder, out, checkpoint):
    stream = read_growing_lines(spark, str(folder), range_bytes=40)
    query = stream.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(checkpoint))
    query.trigger(availableNow=True).start().awaitTermination()
    return sorted(r.raw for r in spark.read.parquet(str(out)).collect())


def test_appended_lines_come_once_over_restarts(spark, tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    log = folder / "a.log"
    log.write_text("".join(f"line {i:03}\n" for i in range(30)))
    args = (folder, tmp_path / "out", tmp_path / "checkpoint")
    assert run(spark, *args) == [f"line {i:03}" for i in range(30)]
    with log.open("a") as file:
        file.write("".join(f"line {i:03}\n" for i in range(30, 50)) + "line 05")
    (folder / "b.log").write_text("﻿other é\n")
    assert run(spark, *args) == [f"line {i:03}" for i in range(50)] + ["﻿other é"]
    log.rename(folder / "a.log.1")
    with (folder / "a.log.1").open("a") as file:
        file.write("0\n")
    log.write_text("line 051\n")
    assert run(spark, *args) == [f"line {i:03}" for i in range(52)] + ["﻿other é"]
    assert run(spark, *args) == [f"line {i:03}" for i in range(52)] + ["﻿other é"]
