"""MP4 files: tracks, packet tables and subtitle tracks, by range reads.

A file is a row of boxes. The headers of the outer ones lead to moov, which alone is read; its sample tables (durations, sizes,
samples a chunk, places of chunks) become packet rows with times and byte ranges, and subtitle samples are read by these
ranges. All text samples are timed text (tx3g): a length and UTF-8, or UTF-16 behind its mark.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from scribemill.sources.audio import opened
from scribemill.sources.readers import swedish_stream

#: bytes of sample tables that are read; a file with more has an error
MOST_TABLES = 1 << 28


def boxes(data: memoryview) -> Iterator[tuple[bytes, memoryview]]:
    """(kind, body) of the boxes in a body; a box that goes beyond it is an error."""
    at = 0
    while at + 8 <= len(data):
        size, kind = struct.unpack_from(">I4s", data, at)
        head = 8
        if size == 1:
            size, head = struct.unpack_from(">Q", data, at + 8)[0], 16
        size = size or len(data) - at
        if size < head or at + size > len(data):
            raise ValueError(f"a box {kind!r} of {size} bytes at {at}")
        yield kind, data[at + head : at + size]
        at += size


def child(data: memoryview, *path: bytes) -> memoryview:
    """The body of the first box of each kind, one in the other."""
    for kind in path:
        found = next((body for k, body in boxes(data) if k == kind), None)
        if found is None:
            raise ValueError(f"no box {kind.decode()}")
        data = found
    return data


def movie(file) -> memoryview:
    """The body of moov."""
    at, size = 0, file.size()
    while at + 8 <= size:
        file.seek(at)
        length, kind, large = struct.unpack(">I4sQ", file.read(16).ljust(16, b"\0"))
        length, head = (large, 16) if length == 1 else (length or size - at, 8)
        if length < head or at + length > size:
            raise ValueError(f"a box of {length} bytes at {at}")
        if kind == b"moov":
            if length > MOST_TABLES:
                raise ValueError(f"tables of {length} bytes")
            file.seek(at + head)
            return memoryview(file.read(length - head))
        at += length
    raise ValueError("no box moov")


def table(body: memoryview, columns: int, kind: str = ">u4") -> np.ndarray:
    """A full box's rows of whole numbers, after their number."""
    n = struct.unpack_from(">I", body, 4)[0]
    return np.frombuffer(body, kind, n * columns, 8).astype(np.int64).reshape(n, columns)


class Track:
    """Kind (vide, soun, sbtl, text, ...), codec, language (three letters), and of every sample start and duration in ms, byte offset and size."""

    def __init__(self, body: memoryview):
        mdhd = child(body, b"mdia", b"mdhd")
        self.timescale, code = (struct.unpack_from(">I", mdhd, 20)[0], struct.unpack_from(">H", mdhd, 32)[0]) if mdhd[0] else (struct.unpack_from(">I", mdhd, 12)[0], struct.unpack_from(">H", mdhd, 20)[0])
        self.language = "".join(chr(0x60 + (code >> k & 31)) for k in (10, 5, 0))
        self.kind = bytes(child(body, b"mdia", b"hdlr")[8:12]).decode("latin-1")
        self.stbl = child(body, b"mdia", b"minf", b"stbl")
        self.codec = bytes(child(self.stbl, b"stsd")[12:16]).decode("latin-1")
        sizes = child(self.stbl, b"stsz")
        one, self.n = struct.unpack_from(">II", sizes, 4)
        self.sizes = np.full(self.n, one, np.int64) if one else np.frombuffer(sizes, ">u4", self.n, 12).astype(np.int64)

    def packets(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        runs = table(child(self.stbl, b"stts"), 2)
        lengths = np.repeat(runs[:, 1], runs[:, 0])
        kinds = {k for k, _ in boxes(self.stbl)}
        places = table(child(self.stbl, b"co64"), 1, ">u8")[:, 0] if b"co64" in kinds else table(child(self.stbl, b"stco"), 1)[:, 0]
        spans = table(child(self.stbl, b"stsc"), 3)
        if not self.timescale or len(lengths) != self.n:
            raise ValueError(f"{len(lengths)} times of {self.n} samples, {self.timescale} a second")
        # a row holds from its first chunk to the next row's; of the last row's chunks the samples that are left
        per = np.repeat(spans[:, 1], np.diff(np.append(spans[:, 0], len(places) + 1))) if len(spans) else np.zeros(0, np.int64)
        if len(per) != len(places) or per.sum() != self.n:
            raise ValueError(f"{per.sum()} places of {self.n} samples")
        before = np.cumsum(self.sizes) - self.sizes
        first = np.cumsum(per) - per
        offset = np.repeat(places, per) + before - np.repeat(before[np.minimum(first, max(0, self.n - 1))] if self.n else first, per)
        ends = np.cumsum(lengths)
        start, end = ((x * 1000) // self.timescale for x in (ends - lengths, ends))
        return start, end - start, offset, self.sizes


def tracks(file) -> list[Track]:
    return [Track(body) for kind, body in boxes(movie(file)) if kind == b"trak"]


#: rows that are passed on at once
BATCH_ROWS = 5000


def over_files(files: DataFrame, columns: str, rows, path: str = "path") -> DataFrame:
    """path, the columns of rows(open file, row of files) and, alone, an error for each file that cannot be read. All cores
    open files, however short the list is in bytes."""
    names = [x.split()[0] for x in columns.split(", ")]
    types = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    kinds = [pa.string(), *(types[x.split()[1]] for x in columns.split(", ")), pa.string()]

    def run(batches) -> Iterator[pa.RecordBatch]:
        held = [[] for _ in kinds]

        def made():
            out = pa.record_batch([pa.array(c, k) for c, k in zip(held, kinds, strict=True)], names=["path", *names, "error"])
            for c in held:
                c.clear()
            return out

        for batch in batches:
            for row in batch.to_pylist():
                try:
                    with opened(row[path]) as file:
                        found = rows(file, row)
                    found = [list(x) for x in found]
                    out = [[row[path]] * len(found[0]), *found, [None] * len(found[0])]
                except Exception as e:  # noqa: BLE001 - any file may be broken in any way
                    out = [[row[path]], *([None] for _ in names), [f"{type(e).__name__}: {e}"]]
                for c, x in zip(held, out, strict=True):
                    c += x
                if len(held[0]) >= BATCH_ROWS:
                    yield made()
        yield made()

    files = files.where(F.col(path).isNotNull()).repartition(3 * files.sparkSession.sparkContext.defaultParallelism, path)
    return files.mapInArrow(run, f"path string, {columns}, error string")


def probe(files: DataFrame) -> DataFrame:
    """path, track (from 0), kind, codec, language, samples of every track; error for a file that cannot be read."""

    def look(file, _):
        found = tracks(file)
        return range(len(found)), [t.kind for t in found], [t.codec for t in found], [t.language for t in found], [t.n for t in found]

    return over_files(files, "track int, kind string, codec string, language string, samples long", look)


def packets(files: DataFrame) -> DataFrame:
    """path, track, number (from 0), start and duration (ms), offset and size (bytes) of every sample; or error."""

    def look(file, _):
        parts = [(np.full(t.n, k), np.arange(t.n), *t.packets()) for k, t in enumerate(tracks(file))]
        return [np.concatenate(x).tolist() for x in zip(*parts, strict=True)] or [[]] * 6

    return over_files(files, "track int, number long, start long, duration long, offset long, size long", look)


def sample_text(raw: bytes) -> str:
    n = struct.unpack_from(">H", raw)[0] if len(raw) > 1 else 0
    body = raw[2 : 2 + n]
    return body.decode("utf-16" if body[:2] in (b"\xfe\xff", b"\xff\xfe") else "utf-8")


def subtitles(files: DataFrame, language: str = "swe") -> DataFrame:
    """file_id (path), idx, start, end, text of the first subtitle track of each file in the language; or error. Samples
    without text, which stand for gaps, have no row. Files without such a track have none."""
    found = probe(files)
    streams = found.where(F.col("kind").isin("sbtl", "text", "subt") & (F.col("codec") == "tx3g"))
    streams = streams.select(F.col("path").alias("file_id"), F.col("track").alias("stream"), "language")
    chosen = swedish_stream(streams, language).withColumnRenamed("file_id", "path")
    broken = found.where("error is not null").select("path", F.lit(None).cast("int").alias("stream"))

    def read(file, row):
        start, duration, offset, size = tracks(file)[row["stream"] or 0].packets()
        out = []
        for a, d, at, n in zip(start.tolist(), duration.tolist(), offset.tolist(), size.tolist(), strict=True):
            file.seek(at)
            if text := sample_text(file.read(n)):
                out.append((len(out), a, a + d, text))
        return list(zip(*out, strict=True)) or [[]] * 4

    found = over_files(chosen.unionByName(broken), "idx int, start long, end long, text string", read)
    return found.withColumnRenamed("path", "file_id")


# Writing


def box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I4s", 8 + len(body), kind) + body


def full(kind: bytes, form: str, *values) -> bytes:
    return box(kind, bytes(4), struct.pack(">" + form, *values))


def subtitle_file(streams: list[tuple[str, list[tuple[int, int, str]]]]) -> bytes:
    """An MP4 file of subtitle tracks (language, [(start, end, text), ...] in order and apart), times in ms; gaps are empty samples."""
    media, traks, head = b"", [], len(box(b"ftyp", b"isom", bytes(4))) + 8
    for number, (language, rows) in enumerate(streams, 1):
        samples, lengths, now = [], [], 0
        for start, end, text in rows:
            for length, words in ((start - now, ""), (end - start, text)):
                if length > 0:
                    raw = words.encode()
                    samples.append(struct.pack(">H", len(raw)) + raw)
                    lengths.append(length)
            now = max(now, end)
        # two samples a chunk, the last chunk with what is left
        places, at = [], head + len(media)
        for k in range(0, len(samples), 2):
            places.append(at)
            at += sum(map(len, samples[k : k + 2]))
        media += b"".join(samples)
        code = sum((ord(x) - 0x60) << k for x, k in zip(language, (10, 5, 0), strict=True))
        whole, odd = divmod(len(samples), 2)
        spans = [(1, 2, 1)] * (whole > 0) + [(whole + 1, 1, 1)] * odd
        stbl = box(
            b"stbl",
            box(b"stsd", bytes(4), struct.pack(">I", 1), box(b"tx3g", bytes(6), struct.pack(">H", 1), bytes(30))),
            full(b"stts", f"I{2 * len(lengths)}I", len(lengths), *(x for n in lengths for x in (1, n))),
            full(b"stsz", f"II{len(samples)}I", 0, len(samples), *map(len, samples)),
            full(b"stsc", f"I{3 * len(spans)}I", len(spans), *(x for row in spans for x in row)),
            full(b"stco", f"I{len(places)}I", len(places), *places),
        )
        mdia = box(b"mdia", full(b"mdhd", "IIIIHH", 0, 0, 1000, sum(lengths), code, 0), full(b"hdlr", "I4s12s", 0, b"sbtl", b""), box(b"minf", stbl))
        traks.append(box(b"trak", full(b"tkhd", "II", 0, number), mdia))
    return box(b"ftyp", b"isom", bytes(4)) + box(b"mdat", media) + box(b"moov", full(b"mvhd", "IIII", 0, 0, 1000, 0), *traks)


def subtitle_files(streams: Column) -> Column:
    """MP4 files of array<struct<language:string,rows:array<struct<start:long,end:long,text:string>>>>."""

    @F.arrow_udf(BinaryType())
    def make(column: pa.Array) -> pa.Array:
        out = [None if x is None else subtitle_file([(t["language"], [(r["start"], r["end"], r["text"] or "") for r in t["rows"]]) for t in x]) for x in column.to_pylist()]
        return pa.array(out, pa.binary())

    return make(streams)
