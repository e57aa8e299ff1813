"""PCM WAV files by byte ranges: a chunk reads its own samples, whatever the length of its file.

The header says where the samples are and how wide they are; it is read once a file, from its first bytes. A chunk's
milliseconds are then a byte range, which a task reads by itself through the Hadoop file systems that Spark reads
(`wav_format` for the layout, `read_chunks` for the samples). Chunks are grouped by file only to share an open file.
"""

from __future__ import annotations

import functools
import math
import struct
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

AUDIO_RATE = 16_000
#: bytes of a block that say what it is
BLOCK_BYTES = 48


def opened(path: str):
    """A random-access file of a local path or of a store that Arrow knows by its address (hdfs, s3, gs)."""
    parts = urlparse(path)
    if parts.scheme in ("", "file"):
        return pafs.LocalFileSystem().open_input_file(unquote(parts.path))
    store, place = pafs.FileSystem.from_uri(path)
    return store.open_input_file(place)


class Wav:
    """Where a file's samples are: kind (1 whole numbers, 3 floats), channels, rate, bytes of a sample, first byte, samples of a channel."""

    def __init__(self, file):
        self.file, self.read = file, 0
        size = file.size()
        head = self.bytes(0, 12)
        if head[:4] not in (b"RIFF", b"RF64") or head[8:12] != b"WAVE":
            raise ValueError("not a WAV file")
        at, form, wide = 12, None, None
        while at + 8 <= size:
            # a block's first bytes; what a block of another kind holds is not read
            block = self.bytes(at, BLOCK_BYTES)
            name, length = block[:4], struct.unpack_from("<I", block, 4)[0]
            if name == b"data":
                break
            if name == b"fmt ":
                form = struct.unpack_from("<HHIIHH", block, 8)
                if form[0] == 0xFFFE and length >= 26:  # the kind stands in the extension
                    form = (struct.unpack_from("<H", block, 32)[0], *form[1:])
            elif name == b"ds64":
                wide = struct.unpack_from("<Q", block, 16)[0]
            at += 8 + length + length % 2
        else:
            raise ValueError("no samples")
        if form is None:
            raise ValueError("no format")
        self.kind, self.channels, self.rate, self.width, self.first = form[0], form[1], form[2], form[5] // 8, at + 8
        if (self.kind, self.width) not in KINDS or not self.channels or not self.rate:
            raise ValueError(f"samples of kind {self.kind} and {self.width} bytes")
        length = wide if wide is not None and length == 0xFFFFFFFF else length
        self.samples = min(length, size - self.first) // (self.width * self.channels)

    def bytes(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        out = self.file.read(n)
        self.read += len(out)
        return out

    def slice(self, start: int, end: int) -> np.ndarray:
        """Samples [start, end) of the mean of all channels, between -1 and 1."""
        start, end = max(0, min(start, self.samples)), max(0, min(end, self.samples))
        step = self.width * self.channels
        raw = self.bytes(self.first + start * step, max(0, end - start) * step)
        return KINDS[self.kind, self.width](raw).reshape(-1, self.channels).mean(axis=1)


def of_three(raw: bytes) -> np.ndarray:
    four = np.zeros((len(raw) // 3, 4), np.uint8)
    four[:, 1:] = np.frombuffer(raw, np.uint8).reshape(-1, 3)
    return four.view("<i4").ravel() / float(1 << 31)


KINDS = {
    (1, 1): lambda raw: (np.frombuffer(raw, "u1").astype(np.float64) - 128) / 128,
    (1, 2): lambda raw: np.frombuffer(raw, "<i2") / float(1 << 15),
    (1, 3): of_three,
    (1, 4): lambda raw: np.frombuffer(raw, "<i4") / float(1 << 31),
    (3, 4): lambda raw: np.frombuffer(raw, "<f4").astype(np.float64),
    (3, 8): lambda raw: np.frombuffer(raw, "<f8"),
}

#: zero crossings of the low-pass on either side, and the steepness of its Kaiser window
CROSSINGS, BETA = 24, 9.0


@functools.lru_cache(16)
def phases(up: int, down: int) -> tuple[np.ndarray, int]:
    """Filters of the `up` phases, a row each, and how many samples before the present one a row begins: a windowed sinc
    that lets through what is below half of the lower rate."""
    cut = min(1.0, up / down) * 0.95
    reach = math.ceil(CROSSINGS / cut)
    taps = np.arange(-reach, reach + 1)[None, :] - np.arange(up)[:, None] / up
    window = np.i0(BETA * np.sqrt(np.maximum(0, 1 - (taps / (reach + 1)) ** 2))) / np.i0(BETA)
    rows = cut * np.sinc(cut * taps) * window
    return rows / rows.sum(axis=1, keepdims=True), reach


def margin(rate: int, to: int = AUDIO_RATE) -> int:
    """Samples on either side of a span that its resampling looks at."""
    g = math.gcd(rate, to)
    return 0 if rate == to else phases(to // g, rate // g)[1] + 1


def resampled(x: np.ndarray, rate: int, start: int, n: int, first: int = 0, to: int = AUDIO_RATE) -> np.ndarray:
    """n samples at the rate `to` from number `start` on, of samples at `rate` from number `first` on; zero beyond them.
    Samples of a span are the same whatever else of the file is at hand, if its margin is."""
    if rate == to:
        out = np.zeros(n)
        a, b = max(start, first), min(start + n, first + len(x))
        out[a - start : max(a, b) - start] = x[a - first : max(a, b) - first]
        return out
    g = math.gcd(rate, to)
    up, down = to // g, rate // g
    rows, reach = phases(up, down)
    at = (start + np.arange(n, dtype=np.int64)) * down
    centre, phase = at // up - first, at % up
    padded = np.concatenate([np.zeros(reach), x, np.zeros(reach)])
    out = np.zeros(n)
    for p in np.unique(phase):
        # of each phase all outputs at once, a block at a time
        own = np.flatnonzero(phase == p)
        for part in np.array_split(own, max(1, len(own) // 16_384)):
            inside = part[(centre[part] >= -reach) & (centre[part] < len(x) + reach)]
            if len(inside):
                taps = centre[inside][:, None] + np.arange(2 * reach + 1)
                out[inside] = (padded[np.clip(taps, 0, len(padded) - 1)] * ((taps >= 0) & (taps < len(padded)))) @ rows[p]
    return out


LAYOUT = "rate int, channels int, width int, samples long, error string"


def wav_format(files: DataFrame, path: str = "path") -> DataFrame:
    """Adds rate, channels, width (bytes) and samples (of a channel) of each file, from its header alone, or an error."""

    def look(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name in batch.column(batch.schema.get_field_index(path)).to_pylist():
                try:
                    with opened(name) as file:
                        w = Wav(file)
                    rows.append((w.rate, w.channels, w.width, w.samples, None))
                except Exception as e:  # noqa: BLE001 - any file may be broken in any way
                    rows.append((None, None, None, None, f"{type(e).__name__}: {e}"))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=[*batch.schema.names, "rate", "channels", "width", "samples", "error"])

    return files.drop("rate", "channels", "width", "samples", "error").mapInArrow(look, StructType([*files.drop("rate", "channels", "width", "samples", "error").schema.fields, *_parse_datatype_string(LAYOUT).fields]))


def read_chunks(chunks: DataFrame, path: str = "path", start: str = "start", end: str = "end") -> DataFrame:
    """Adds audio (mono floats at 16 kHz of [start, end) ms, as far as the file goes), bytes_read, and error for what cannot be read.

    A chunk reads its own samples and the margin that resampling needs. Rows without path or times have no audio. A file's chunks
    stand in row order in a task, which opens each file once; a file with many chunks is dealt out over tasks by time.
    """
    kept = chunks.drop("audio", "bytes_read", "error")
    schema = StructType([*kept.schema.fields, *_parse_datatype_string("audio array<float>, bytes_read long, error string").fields])

    def read(batches) -> Iterator[pa.RecordBatch]:
        name, file, wav = None, None, None
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (path, start, end)]
            for k, (p, a, b) in enumerate(zip(*columns, strict=True)):
                audio, n, error = None, 0, None
                if p is not None and a is not None and b is not None:
                    try:
                        if p != name:
                            if file is not None:
                                file.close()
                            name, file, wav = p, None, None
                            file = opened(p)
                            wav = Wav(file)
                        elif wav is None:
                            raise ValueError("not readable")
                        n, wav.read = wav.read, 0
                        audio = chunk_of(wav, a, b)
                        n, wav.read = n + wav.read, 0
                    except Exception as e:  # noqa: BLE001 - any file may be broken in any way
                        error = f"{type(e).__name__}: {e}"
                row = batch.slice(k, 1)
                yield pa.RecordBatch.from_arrays([*row.columns, pa.array([audio], pa.list_(pa.float32())), pa.array([n], pa.int64()), pa.array([error], pa.string())], names=schema.names)

    # a file's chunks of ten minutes are a task's
    dealt = kept.repartition(path, F.floor(F.col(start) / 600_000)).sortWithinPartitions(path, start)
    return dealt.mapInArrow(read, schema)


def chunk_of(wav: Wav, start_ms: int, end_ms: int, to: int = AUDIO_RATE) -> np.ndarray:
    """The samples of [start, end) ms at the rate `to`."""
    whole = wav.samples * to // wav.rate
    first, last = (min(max(0, ms) * to // 1000, whole) for ms in (start_ms, end_ms))
    n = max(0, last - first)
    side = margin(wav.rate, to)
    a = max(0, first * wav.rate // to - side)
    b = -(-(first + n) * wav.rate // to) + side
    return resampled(wav.slice(a, b), wav.rate, first, n, a, to).astype(np.float32)
