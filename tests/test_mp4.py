import struct

import pytest

from scribemill.sources import mp4

ENGLISH = [(500, 900, "first"), (900, 1000, "next")]
SWEDISH = [(0, 1000, "ett"), (1500, 2500, "två\nrader"), (2500, 2600, "å" * 300), (4000, 4001, "sist")]


def test_tracks_packets_and_subtitles(spark, tmp_path):
    (tmp_path / "two.mp4").write_bytes(mp4.subtitle_file([("eng", ENGLISH), ("swe", SWEDISH), ("swe", [(0, 1, "no")])]))
    (tmp_path / "none.mp4").write_bytes(mp4.subtitle_file([("eng", ENGLISH), ("fin", [])]))
    (tmp_path / "text.mp4").write_bytes(b"this is no such file at all")
    cut = mp4.subtitle_file([("swe", SWEDISH)])
    (tmp_path / "cut.mp4").write_bytes(cut[:-9])
    paths = spark.createDataFrame([(f"{tmp_path}/{x}.mp4",) for x in ("two", "none", "text", "cut", "missing")] + [(None,)], "path string")
    name = lambda r: r[0].rsplit("/", 1)[1][:-4]
    tracks = {(name(r), r["track"]): (r["kind"], r["codec"], r["language"], r["samples"]) for r in mp4.probe(paths).where("error is null").collect()}
    assert tracks == {("two", 0): ("sbtl", "tx3g", "eng", 3), ("two", 1): ("sbtl", "tx3g", "swe", 6), ("two", 2): ("sbtl", "tx3g", "swe", 1), ("none", 0): ("sbtl", "tx3g", "eng", 3), ("none", 1): ("sbtl", "tx3g", "fin", 0)}
    failed = {name(r): r["error"] for r in mp4.probe(paths).where("error is not null").collect()}
    assert set(failed) == {"text", "cut", "missing"} and failed["missing"].startswith("FileNotFound")
    raw = (tmp_path / "two.mp4").read_bytes()
    rows = sorted((r for r in mp4.packets(paths).where("track = 1").collect() if name(r) == "two"), key=lambda r: r["number"])
    assert [(r["start"], r["duration"], raw[r["offset"] + 2 : r["offset"] + r["size"]].decode()) for r in rows] == [(0, 1000, "ett"), (1000, 500, ""), (1500, 1000, "två\nrader"), (2500, 100, "å" * 300), (2600, 1400, ""), (4000, 1, "sist")]
    found = mp4.subtitles(paths).collect()
    assert [tuple(r)[1:5] for r in sorted((r for r in found if name(r) == "two"), key=lambda r: r["idx"])] == [(k, *x) for k, x in enumerate(SWEDISH)]
    assert {name(r) for r in found} == {"two", "text", "cut", "missing"}
    assert [(r["start"], r["text"]) for r in mp4.subtitles(paths, "eng").where("error is null").orderBy("file_id", "idx").collect()] == [(500, "first"), (900, "next")] * 2


def test_large_boxes_and_wide_places(spark, tmp_path):
    """A box with a length of 64 bits, chunk places of 64 bits, samples of one size, and text in UTF-16."""
    text = struct.pack(">H", 8) + "﻿abc".encode("utf-16-be")
    media = text * 3
    head = mp4.box(b"ftyp", b"isom", bytes(4))
    mdat = struct.pack(">I4sQ", 1, b"mdat", 16 + 5 + len(media)) + b"hello" + media
    first = len(head) + 16 + 5
    stbl = mp4.box(b"stbl", mp4.box(b"stsd", bytes(4), struct.pack(">I", 1), mp4.box(b"tx3g", bytes(38))), mp4.full(b"stts", "5I", 2, 1, 45_000, 2, 90_000), mp4.full(b"stsz", "II", len(text), 3), mp4.full(b"stsc", "4I", 1, 1, 3, 1), mp4.full(b"co64", "IQ", 1, first))
    mdhd = mp4.box(b"mdhd", b"\x01\0\0\0", struct.pack(">QQIQHH", 0, 0, 90_000, 225_000, (19 << 10) + (23 << 5) + 5, 0))
    trak = mp4.box(b"trak", mp4.box(b"mdia", mdhd, mp4.full(b"hdlr", "I4s", 0, b"text"), mp4.box(b"minf", stbl)))
    (tmp_path / "wide.mp4").write_bytes(head + mdat + mp4.box(b"moov", trak))
    paths = spark.createDataFrame([(f"file://{tmp_path}/wide.mp4",)], "path string")
    got = mp4.subtitles(paths).orderBy("idx").collect()
    assert [tuple(r)[1:] for r in got] == [(0, 0, 500, "abc", None), (1, 500, 1500, "abc", None), (2, 1500, 2500, "abc", None)]
    with pytest.raises(ValueError):
        list(mp4.boxes(memoryview(struct.pack(">I4s", 99, b"free"))))
