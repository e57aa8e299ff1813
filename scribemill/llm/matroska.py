"""Matroska media columns: write samples into EBML clusters, read them back into packet tables.

Sizes and ids are variable-length integers; blocks carry one frame or several by Xiph, EBML or fixed-size lacing;
cues point at clusters by their position in the segment.
"""

from __future__ import annotations

import struct
import zlib
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scribemill.llm._arrays import tidy

# Element ids of the public format.
EBML, DOC_TYPE, SEGMENT, INFO, TIMESTAMP_SCALE, DURATION = 0x1A45DFA3, 0x4282, 0x18538067, 0x1549A966, 0x2AD7B1, 0x4489
TRACKS, TRACK, TRACK_NUMBER, TRACK_TYPE, CODEC = 0x1654AE6B, 0xAE, 0xD7, 0x83, 0x86
AUDIO, SAMPLING, CHANNELS, BIT_DEPTH, DEFAULT_DURATION = 0xE1, 0xB5, 0x9F, 0x6264, 0x23E383
CLUSTER, TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1
CUES, CUE_POINT, CUE_TIME, CUE_POSITIONS, CUE_TRACK, CUE_CLUSTER = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
#: elements that stand beside clusters, and so end one of unknown size
SEEK_HEAD, TAGS, CHAPTERS, ATTACHMENTS = 0x114D9B74, 0x1254C367, 0x1043A770, 0x1941A469
BESIDE = {EBML, SEGMENT, INFO, TRACKS, CLUSTER, CUES, SEEK_HEAD, TAGS, CHAPTERS, ATTACHMENTS}
MASTERS = {EBML, SEGMENT, INFO, TRACKS, TRACK, AUDIO, CLUSTER, BLOCK_GROUP, CUES, CUE_POINT, CUE_POSITIONS}

NO_LACING, XIPH, FIXED, EBML_LACING = 0, 1, 2, 3
FRAME, RATE = 192, 8000
PER_BLOCK, PER_CLUSTER = 8, 32


def size_bytes(n: int, width: int = 0) -> bytes:
    """A variable-length integer; the value of all ones is kept for an unknown size."""
    width = width or next(w for w in range(1, 9) if n < (1 << 7 * w) - 1)
    return (n | 1 << 7 * width).to_bytes(width, "big")


def element(kind: int, body: bytes) -> bytes:
    return kind.to_bytes((kind.bit_length() + 7) // 8, "big") + size_bytes(len(body)) + body


def number(kind: int, n: int) -> bytes:
    return element(kind, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


def read_size(data: bytes, at: int) -> tuple[int, int]:
    """Value (-1: unknown) and position after it."""
    width = 9 - data[at].bit_length()
    if width > 8:
        raise ValueError("no variable-length integer")
    value = int.from_bytes(data[at : at + width], "big") & (1 << 7 * width) - 1
    return (-1 if value == (1 << 7 * width) - 1 else value), at + width


def read_id(data: bytes, at: int) -> tuple[int, int]:
    width = 9 - data[at].bit_length()
    if width > 4:
        raise ValueError("no element id")
    return int.from_bytes(data[at : at + width], "big"), at + width


def unknown_end(data: bytes, kind: int, at: int, end: int) -> int:
    """Where the body of a segment or cluster of unknown size ends: before the first element that is none of its
    children."""
    if kind not in (SEGMENT, CLUSTER):
        raise ValueError("only segments and clusters may be of unknown size")
    others = {EBML, SEGMENT} if kind == SEGMENT else BESIDE
    while at < end:
        start = at
        child, at = read_id(data, at)
        if child in others:
            return start
        size, at = read_size(data, at)
        at = unknown_end(data, child, at, end) if size < 0 else at + size
    return min(at, end)


def elements(data: bytes, at: int, end: int):
    """(id, start of the element, start and end of its body), without the children."""
    while at < end:
        start = at
        kind, at = read_id(data, at)
        size, at = read_size(data, at)
        stop = unknown_end(data, kind, at, end) if size < 0 else at + size
        if stop > end:
            raise ValueError("an element passes its parent's end")
        yield kind, start, at, stop
        at = stop


def lace(frames: list[bytes], how: int) -> bytes:
    """Number of frames and their sizes as a block's head has them, and the frames."""
    if how == NO_LACING:
        return frames[0]
    head = bytes([len(frames) - 1])
    sizes = [len(x) for x in frames]
    if how == XIPH:
        head += b"".join(b"\xff" * (n // 255) + bytes([n % 255]) for n in sizes[:-1])
    elif how == EBML_LACING:
        head += size_bytes(sizes[0])
        for a, b in zip(sizes[:-2], sizes[1:-1], strict=True):
            width = next(w for w in range(1, 9) if abs(b - a) < (1 << 7 * w - 1) - 1)
            head += size_bytes(b - a + (1 << 7 * width - 1) - 1, width)
    elif len(set(sizes)) > 1:
        raise ValueError("fixed-size lacing of frames that differ in size")
    return head + b"".join(frames)


def laced(data: bytes, at: int, end: int, how: int) -> list[tuple[int, int]]:
    """Byte ranges of a block's frames."""
    if how == NO_LACING:
        return [(at, end)]
    n, at = data[at] + 1, at + 1
    sizes = []
    if how == FIXED:
        if (end - at) % n:
            raise ValueError("fixed-size lacing does not fill the block")
        step = (end - at) // n
        return [(at + k * step, at + (k + 1) * step) for k in range(n)]
    for k in range(n - 1):
        if how == XIPH:
            size = 0
            while data[at] == 255:
                size, at = size + 255, at + 1
            size, at = size + data[at], at + 1
        else:
            start = at
            size, at = read_size(data, at)
            if k:
                size += sizes[-1] - (1 << 7 * (at - start) - 1) + 1
        sizes.append(size)
    sizes.append(end - at - sum(sizes))
    if min(sizes) < 0:
        raise ValueError("lacing passes the block's end")
    ends = np.cumsum(sizes) + at
    return [(int(e) - s, int(e)) for s, e in zip(sizes, ends, strict=True)]


def head(n_frames: int, frame: int = FRAME, rate: int = RATE) -> tuple[bytes, bytes]:
    """EBML header, and the Info and Tracks elements of one track of 8-bit samples."""
    ms = frame * 1000 // rate
    info = element(INFO, number(TIMESTAMP_SCALE, 1_000_000) + element(DURATION, struct.pack(">d", n_frames * ms)))
    audio = element(AUDIO, element(SAMPLING, struct.pack(">d", rate)) + number(CHANNELS, 1) + number(BIT_DEPTH, 8))
    track = element(TRACKS, element(TRACK, number(TRACK_NUMBER, 1) + number(TRACK_TYPE, 2) + element(CODEC, b"A_PCM/INT/LIT") + number(DEFAULT_DURATION, ms * 1_000_000) + audio))
    return element(EBML, element(DOC_TYPE, b"matroska")), info + track


def write(payload: bytes, frame: int = FRAME, rate: int = RATE, how: int = FIXED) -> bytes:
    """A file of one audio track of unsigned 8-bit samples, `frame` samples a frame."""
    ms = frame * 1000 // rate
    n = len(payload) // frame
    start, body = head(n, frame, rate)
    parts, cues, at = [body], [], len(body)
    for first in range(0, n, PER_CLUSTER):
        blocks = [number(TIMESTAMP, first * ms)]
        last = min(first + PER_CLUSTER, n)
        for k in range(first, last, 1 if how == NO_LACING else PER_BLOCK):
            own = [payload[i * frame : (i + 1) * frame] for i in range(k, min(k + (1 if how == NO_LACING else PER_BLOCK), last))]
            used = how if len(own) > 1 else NO_LACING
            blocks.append(element(SIMPLE_BLOCK, b"\x81" + struct.pack(">hB", (k - first) * ms, 0x80 | used << 1) + lace(own, used)))
        cluster = element(CLUSTER, b"".join(blocks))
        cues.append(element(CUE_POINT, number(CUE_TIME, first * ms) + element(CUE_POSITIONS, number(CUE_TRACK, 1) + number(CUE_CLUSTER, at))))
        parts.append(cluster)
        at += len(cluster)
    return start + element(SEGMENT, b"".join(parts) + element(CUES, b"".join(cues)))


def packets(media: bytes) -> tuple[list[tuple[int, int, int, int]], list[tuple[int, int]]]:
    """Packets (timestamp in ms, track, first byte, end byte) and cues (time, byte of the cluster in the file).

    Laced frames follow each other by the track's default duration. Unknown elements are passed over.
    """
    rows, cues, steps, scale = [], [], {}, 1_000_000
    integer = lambda a, b: int.from_bytes(media[a:b], "big")

    def block(a, b, time):
        track, at = read_size(media, a)
        offset, flags = struct.unpack_from(">hB", media, at)
        for k, (s, e) in enumerate(laced(media, at + 3, b, flags >> 1 & 3)):
            rows.append(((time + offset) * scale // 1_000_000 + k * steps.get(track, 0), track, s, e))

    for kind, _, a, b in elements(media, 0, len(media)):
        if kind != SEGMENT:
            continue
        for kind1, _, a1, b1 in elements(media, a, b):
            if kind1 == INFO:
                scale = next((integer(x, y) for k, _, x, y in elements(media, a1, b1) if k == TIMESTAMP_SCALE), scale)
            elif kind1 == TRACKS:
                for k, _, x, y in elements(media, a1, b1):
                    own = {k2: integer(x2, y2) for k2, _, x2, y2 in elements(media, x, y) if k2 in (TRACK_NUMBER, DEFAULT_DURATION)} if k == TRACK else {}
                    steps[own.get(TRACK_NUMBER, 0)] = own.get(DEFAULT_DURATION, 0) // 1_000_000
            elif kind1 == CLUSTER:
                time = 0
                for k, _, x, y in elements(media, a1, b1):
                    if k == TIMESTAMP:
                        time = integer(x, y)
                    elif k == SIMPLE_BLOCK:
                        block(x, y, time)
                    elif k == BLOCK_GROUP:
                        for k2, _, x2, y2 in elements(media, x, y):
                            if k2 == BLOCK:
                                block(x2, y2, time)
            elif kind1 == CUES:
                for k, _, x, y in elements(media, a1, b1):
                    point = {}
                    for k2, _, x2, y2 in elements(media, x, y):
                        if k2 == CUE_TIME:
                            point["time"] = integer(x2, y2)
                        elif k2 == CUE_POSITIONS:
                            point |= {"cluster": a + integer(x3, y3) for k3, _, x3, y3 in elements(media, x2, y2) if k3 == CUE_CLUSTER}
                    if len(point) == 2:
                        cues.append((point["time"], point["cluster"]))
    return rows, cues


def payload_of(data: bytes, multiple: int = FRAME) -> bytes:
    """The bytes with spaces appended up to a positive multiple."""
    return data + b" " * (-len(data) % multiple if data else multiple)


def media_column(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", how: int = FIXED) -> DataFrame:
    """The id, n_bytes of the text's UTF-8 (null: 0) and `media`, a Matroska file of its padded bytes, for every row.

    Null and empty texts are one frame of spaces; equal rows give equal files; an empty table gives no row; a null id
    stays null and further columns play no part.
    """

    def encode(batches):
        for batch in batches:
            own = [b"" if x is None else x.encode() for x in batch.column(1).to_pylist()]
            # a part at a time: the media column of a whole batch may be large
            for k in range(0, len(own), 1000):
                part = own[k : k + 1000]
                yield pa.record_batch([batch.column(0).slice(k, 1000), pa.array([len(x) for x in part], pa.int64()), pa.array([write(payload_of(x), how=how) for x in part], pa.binary())], names=[id_col, "n_bytes", "media"])

    rows = docs.select(id_col, F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidy(encode), f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_bytes long, media binary")


PACKETS = "array<struct<timestamp_ms:bigint,track:int,first:bigint,end:bigint>>"


def packet_table(media: DataFrame, media_col: str = "media") -> DataFrame:
    """All columns but the media, with `packets` (timestamp, track, byte range) and `cues`; a null file has neither.
    A file that is no Matroska has an `error` and no packets. Equal rows each get a row, an empty table none; columns
    named packets, cues or error are replaced."""
    rest = [c for c in media.columns if c not in (media_col, "packets", "cues", "error")]
    fields = ", ".join(f"`{c}` {media.schema[c].dataType.simpleString()}" for c in rest)

    def parse(batches):
        for batch in batches:
            rows, cues, errors = [], [], []
            for x in batch.column(len(rest)).to_pylist():
                try:
                    p, c = packets(x) if x is not None else ([], [])
                    error = None
                except (ValueError, IndexError, struct.error) as e:
                    p, c, error = [], [], str(e) or type(e).__name__
                rows.append([dict(zip(("timestamp_ms", "track", "first", "end"), y, strict=True)) for y in p])
                cues.append([dict(zip(("time_ms", "cluster"), y, strict=True)) for y in c])
                errors.append(error)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], pa.array(rows, pa.list_(pa.struct([("timestamp_ms", pa.int64()), ("track", pa.int32()), ("first", pa.int64()), ("end", pa.int64())]))), pa.array(cues, pa.list_(pa.struct([("time_ms", pa.int64()), ("cluster", pa.int64())]))), pa.array(errors, pa.string())], names=[*rest, "packets", "cues", "error"])

    return media.select(*rest, media_col).mapInArrow(tidy(parse), f"{fields}, packets {PACKETS}, cues array<struct<time_ms:bigint,cluster:bigint>>, error string")


def features(samples: np.ndarray, n_packets: int, n_cues: int, last_ms: int) -> str:
    """Packets, cues, last timestamp, mean and energy of the samples around 128 (thousandths), zero crossings."""
    x = samples.astype(np.int64) - 128
    crossings = int(((x[1:] < 0) != (x[:-1] < 0)).sum())
    return f"packets={n_packets};cues={n_cues};last_ms={last_ms};mean={int(x.sum()) * 1000 // len(x)};energy={int((x * x).sum()) * 1000 // len(x)};crossings={crossings}"


DIGESTS = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def digests(media: DataFrame) -> DataFrame:
    """What the stored bytes say: the payload gathered from the packets' byte ranges, and features of the samples.

    A row for every row with doc_id, n_bytes and media, which must be files of media_column; equal rows have equal
    values, and an empty table gives no row."""

    def read(batches):
        for batch in batches:
            out = []
            for doc_id, n, stored in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                rows, cues = packets(stored)
                payload = b"".join([stored[a:b] for _, _, a, b in rows])
                out.append((doc_id, n, len(payload), sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(stored), sha256(stored).hexdigest(), features(np.frombuffer(payload, np.uint8), len(rows), len(cues), rows[-1][0])))
            if out:
                yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)], names=[x.split()[0] for x in DIGESTS.split(", ")])

    return media.select(F.col("doc_id").cast("long"), "n_bytes", "media").mapInArrow(tidy(read), DIGESTS)


def op9_media_columns(spark, sf_dir: str) -> DataFrame:
    """The contract's columns for every document, from its stored Matroska file."""
    return digests(media_column(spark.read.parquet(f"{sf_dir}/documents.parquet")))
