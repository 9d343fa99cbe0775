"""The .zst source: frames at any place, lines across frames, streams that grow, cut files."""

from __future__ import annotations

import os
import random

import pytest
import zstandard

from threadloom.sources import lines as ln, zst


def packed(data: bytes, rng, sizes=(1, 7, 40, 500)) -> bytes:
    out, at = [], 0
    while at < len(data):
        step = rng.choice(sizes)
        pack = zstandard.ZstdCompressor(write_checksum=rng.random() < 0.5, write_content_size=rng.random() < 0.5)
        out.append(pack.compress(data[at : at + step]))
        if rng.random() < 0.1:  # a skippable frame that looks like a frame inside
            out.append((0x184D2A51).to_bytes(4, "little") + (6).to_bytes(4, "little") + zst.FRAME_MAGIC + b"xy")
        at += step
    return b"".join(out)


def split_lines(data: bytes) -> list[bytes]:
    found = data.split(b"\n")
    return found[:-1] if found and found[-1] == b"" else found


def test_ranges(monkeypatch, tmp_path):
    rng = random.Random(3)
    for t in range(80):
        monkeypatch.setattr(zst, "SPLIT_BYTES", rng.choice([50, 300, 4000]))
        monkeypatch.setattr(zst, "WINDOW", rng.choice([5, 64, 4096]))
        data = b"".join(os.urandom(rng.randint(0, 80)).replace(b"\n", b"") + b"\n" * (rng.random() < 0.7) for _ in range(rng.randint(0, 60)))
        if t % 7 == 0:
            data = zst.FRAME_MAGIC * 500 + b"\n" * (t % 2)
        raw = packed(data, rng)
        path = tmp_path / f"{t}.zst"
        path.write_bytes(raw)
        split = rng.choice([10, 37, 200, 5000])
        got = []
        for r in zst._ranges(str(path), 0, len(raw), len(raw), split, True):
            for lines in zst.read_range(r.path, str(tmp_path), r.low, r.high, r.size, r.to_end):
                got += lines
        assert got == split_lines(data)


def test_round_trip_and_bad_bytes(spark, tmp_path):
    lines = [f"{k} é😀 " + "x" * (k % 50) for k in range(3000)] + ["", "a\r"]
    given = spark.createDataFrame([(x,) for x in lines], "line string").repartition(4)
    path = str(tmp_path / "dump")
    ln.write_zst_lines(given, path, frame_bytes=5_000)
    names = [n for n in os.listdir(path) if n.endswith(".zst")]
    assert len(names) == 4 and len(os.listdir(path)) == 4
    read = ln.read_zst_lines(spark, path, split_bytes=3_000)
    assert read.rdd.getNumPartitions() >= 1
    assert sorted(r["line"] for r in read.collect()) == sorted(x.removesuffix("\r") for x in lines)
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.zst").write_bytes(zstandard.compress(b"ok\n\xff\xfe{\nlast"))
    assert [r["line"] for r in ln.read_zst_lines(spark, str(tmp_path / "bad")).collect()] == ["ok", "��{", "last"]
    (tmp_path / "none").mkdir()
    assert ln.read_zst_lines(spark, str(tmp_path / "none")).count() == 0


def test_cut_off_file_names_its_place(spark, tmp_path):
    raw = zstandard.compress(b"a\n") + zstandard.compress(os.urandom(5000))
    (tmp_path / "cut.zst").write_bytes(raw[:-10])
    with pytest.raises(Exception, match="inside a frame"):
        ln.read_zst_lines(spark, str(tmp_path)).collect()


def test_stream_of_a_growing_file(spark, tmp_path):
    """Frames arrive one by one; lines across them come once, when their line feed is there; a restart goes on."""
    source, state, table = tmp_path / "in", str(tmp_path / "state"), str(tmp_path / "out")
    source.mkdir()
    first, second = source / "a.zst", source / "b.zst"

    def run():
        lines = ln.stream_zst_lines(spark, str(source))
        lines.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(table).awaitTermination()
        return sorted(r["line"] for r in spark.read.parquet(table).collect()) if os.path.isdir(table) and os.listdir(table) else []

    frame = zstandard.compress
    first.write_bytes(frame(b"one\ntw"))
    assert run() == ["one"]
    tail = frame(b"four\n")
    first.write_bytes(first.read_bytes() + frame(b"o") + frame(b"\nthree\n") + tail[:5])
    assert run() == ["one", "three", "two"]
    first.write_bytes(first.read_bytes() + tail[5:])
    second.write_bytes(frame(b"other\n"))
    assert run() == ["four", "one", "other", "three", "two"]
    assert run() == ["four", "one", "other", "three", "two"]


def test_window_larger_than_the_default(tmp_path):
    """Frames made with long-distance windows are read as well."""
    data = os.urandom(1 << 20).replace(b"\n", b"") + b"\n"
    params = zstandard.ZstdCompressionParameters.from_level(3, window_log=28, enable_ldm=True)
    pack = zstandard.ZstdCompressor(compression_params=params).compressobj()
    raw = b"".join(pack.compress(data) for _ in range(3)) + pack.flush()
    (tmp_path / "w.zst").write_bytes(raw)
    got = [x for part in zst.read_range(str(tmp_path / "w.zst"), str(tmp_path), 0, len(raw), len(raw), True) for x in part]
    assert got == [data[:-1]] * 3
