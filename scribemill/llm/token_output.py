"""Token-ID output: shards of independent zstandard frames, each with a checksum, and a trailing seek table.

A shard follows the public zstd seekable format: a frame of little-endian uint32 ids for each document, then a
skippable frame that lists compressed size, decompressed size and the low 32 bits of XXH64 for every frame. A reader
seeks to the frames of the documents it wants and decompresses only those.
"""

from __future__ import annotations

import functools
import itertools
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from scribemill.llm._arrays import NOT_SPACE, binary, coded, ragged, sliced, texts, tidy
from scribemill.llm._shared import left_behind, shared_dir, written

SEEK_MAGIC, SKIPPABLE = 0x8F92EAB1, 0x184D2A5E
#: a longer document takes several frames
FRAME_IDS = 1 << 24
#: bytes that may belong to white space beyond ASCII's, or to separators that libraries treat differently
ODD = np.zeros(256, dtype=bool)
ODD[[0x1C, 0x1D, 0x1E, 0x1F]] = True


def seek_table(frames: list[tuple[int, int, int]]) -> bytes:
    """The trailing skippable frame: (compressed bytes, decompressed bytes, checksum) of every frame."""
    body = b"".join(struct.pack("<III", *x) for x in frames) + struct.pack("<IBI", len(frames), 0x80, SEEK_MAGIC)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(tail) -> list[tuple[int, int, int]]:
    """Frames of a seekable file-like object."""
    tail.seek(-9, 2)
    n, flags, magic = struct.unpack("<IBI", tail.read(9))
    if magic != SEEK_MAGIC or not flags & 0x80:
        raise ValueError("no seek table with checksums")
    tail.seek(-9 - 12 * n, 2)
    return list(struct.iter_unpack("<III", tail.read(12 * n)))


class ShardReader:
    """Random access to the ids of a shard; decompresses only the frames asked for and checks their checksums."""

    def __init__(self, file):
        self.file, self.frames = file, read_seek_table(file)
        self.at = np.cumsum([0] + [x[0] for x in self.frames])
        self.ids_at = np.cumsum([0] + [x[1] // 4 for x in self.frames])
        self.n_ids, self.held = int(self.ids_at[-1]), (-1, np.zeros(0, "<u4"))

    def frame(self, k: int) -> np.ndarray:
        if self.held[0] != k:
            self.file.seek(int(self.at[k]))
            raw = zstandard.ZstdDecompressor().decompress(self.file.read(self.frames[k][0]), max_output_size=self.frames[k][1])
            if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.frames[k][2]:
                raise ValueError(f"frame {k}: wrong checksum")
            self.held = (k, np.frombuffer(raw, "<u4"))
        return self.held[1]

    def read(self, start: int, n: int) -> np.ndarray:
        """n ids from id number `start` of the shard on."""
        if start < 0 or start + n > self.n_ids:
            raise ValueError("outside the shard")
        parts, k = [], int(np.searchsorted(self.ids_at, start, side="right")) - 1
        while n:
            part = self.frame(k)[start - self.ids_at[k] :][:n]
            parts.append(part)
            start, n, k = start + len(part), n - len(part), k + 1
        return np.concatenate(parts) if parts else np.zeros(0, "<u4")


class ShardWriter:
    """Writes documents' ids to a file-like object, a frame each, and at last the seek table."""

    def __init__(self, file, frame_ids: int = FRAME_IDS):
        self.file, self.frame_ids, self.frames = file, frame_ids, []
        self.press = zstandard.ZstdCompressor(level=1, write_checksum=True)

    def add(self, ids: np.ndarray) -> None:
        for i in range(0, len(ids), self.frame_ids):
            raw = ids[i : i + self.frame_ids].astype("<u4").tobytes()
            out = self.press.compress(raw)
            self.frames.append((len(out), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
            self.file.write(out)

    def finish(self) -> None:
        self.file.write(seek_table(self.frames))


@functools.lru_cache(2)
def tokenizer(path: str):
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.lru_cache(2)
def id_bytes(path: str) -> np.ndarray:
    """Bytes of text that each id of a byte-level tokenizer stands for."""
    t = tokenizer(path)
    added = {i: len(x.content.encode()) for i, x in t.get_added_tokens_decoder().items()}
    return np.array([added[i] if i in added else len(t.id_to_token(i) or "") for i in range(t.get_vocab_size())], dtype=np.int64)


def encode_each(chunks: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of Arrow binary values, each encoded by itself."""
    found = [e.ids for e in tokenizer(path).encode_batch_fast([x.decode("utf-8", "replace") for x in chunks.to_pylist()], add_special_tokens=False)]
    return np.fromiter(itertools.chain.from_iterable(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found))


def encode_joined(chunks: pa.Array, path: str, piece: int = 1 << 15) -> tuple[np.ndarray, np.ndarray]:
    """The same for chunks that do not end in white space, many at once: joined, with a line feed before each that does
    not begin with white space. A line feed between other characters is an id of its own, so the ids' bytes tell
    where each chunk's ids begin."""
    data, offsets = texts(chunks)
    bare = NOT_SPACE[data[offsets[:-1]]]
    at = offsets[:-1] + np.cumsum(bare)  # where each chunk begins after the line feeds are put in
    joined = np.full(len(data) + int(bare.sum()), 10, dtype=np.uint8)
    joined[ragged(at, np.diff(offsets))] = data
    begins = np.append(at - bare, len(joined))
    strings = [joined[begins[i] : begins[j]].tobytes().decode("utf-8", "replace") for i, j in sliced(begins, piece)]
    ids = np.concatenate([np.array(e.ids, np.uint32) for e in tokenizer(path).encode_batch_fast(strings, add_special_tokens=False)])
    ends = np.concatenate([[0], np.cumsum(id_bytes(path)[ids])])
    first, last = np.searchsorted(ends, at), np.searchsorted(ends, begins[1:])
    if ends[-1] != len(joined) or (ends[first] != at).any() or (ends[last] != begins[1:]).any():
        return encode_each(chunks, path)  # not a byte-level tokenizer
    return ids[ragged(first, last - first)], last - first


class Memo:
    """Ids of chunks that this worker has met, by their bytes; emptied when it holds `most`."""

    def __init__(self, most: int = 500_000):
        self.most = most
        self.clear()

    def clear(self):
        self.slots, self.n, self.used = {}, 0, 0
        self.starts, self.lengths, self.flat = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), np.zeros(1 << 18, np.uint32)

    @staticmethod
    def grown(x: np.ndarray, n: int) -> np.ndarray:
        return x if n <= len(x) else np.concatenate([x, np.zeros(max(n, 2 * len(x)) - len(x), x.dtype)])

    def add(self, keys: list[bytes], ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The slots of new chunks."""
        n, used = self.n + len(keys), self.used + len(ids)
        self.starts, self.lengths, self.flat = self.grown(self.starts, n), self.grown(self.lengths, n), self.grown(self.flat, used)
        self.starts[self.n : n] = self.used + np.cumsum(lengths) - lengths
        self.lengths[self.n : n], self.flat[self.used : used] = lengths, ids
        slots = range(self.n, n)
        self.slots.update((k, s) for k, s in zip(keys, slots, strict=True) if len(k) <= 48)
        self.n, self.used = n, used
        return np.arange(slots.start, n)


_memos: dict[str, Memo] = {}


def encode(data: np.ndarray, offsets: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts (bytes between offsets) by the tokenizer file, and the n + 1 id offsets.

    A byte-level pre-tokenizer never joins a character with white space that follows it, so a text's ids are those of
    its chunks (white space, then what follows up to the next white space) one after the other. Each distinct chunk
    is encoded once, as long as the worker remembers it. A text with white space beyond ASCII's is encoded as one chunk.
    """
    space = np.zeros(256, dtype=bool)
    space[[0x20, 9, 10, 11, 12, 13]] = True
    white = space[data]
    cut = np.zeros(len(data), dtype=bool)
    cut[1:] = white[1:] & ~white[:-1]
    odd = ODD[data]
    if len(data) > 2:
        odd[1:] |= (data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0))
        odd[2:] |= (data[:-2] == 0xE1) & (data[1:-1] == 0x9A) & (data[2:] == 0x80)
        odd[2:] |= (data[:-2] == 0xE2) & (((data[1:-1] == 0x80) & ((data[2:] <= 0x8A) | (data[2:] == 0xA8) | (data[2:] == 0xA9) | (data[2:] == 0xAF))) | ((data[1:-1] == 0x81) & (data[2:] == 0x9F)))
        odd[2:] |= (data[:-2] == 0xE3) & (data[1:-1] == 0x80) & (data[2:] == 0x80)
    whole = np.unique(np.searchsorted(offsets, np.flatnonzero(odd), side="right") - 1)
    for at in whole:
        cut[offsets[at] : offsets[at + 1]] = False
    cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    begins = np.concatenate([np.flatnonzero(cut), [len(data)]])
    codes, distinct = coded(binary(data, begins))
    memo = _memos.setdefault(path, Memo())
    if memo.n > memo.most:
        memo.clear()
    keys = distinct.to_pylist()
    slots = np.fromiter((memo.slots.get(x, -1) for x in keys), np.int64, len(keys))
    raw, bounds = texts(distinct)
    plain = np.zeros(len(distinct), dtype=bool)
    full = bounds[:-1] < bounds[1:]
    plain[full] = NOT_SPACE[raw[bounds[1:][full] - 1]]
    plain &= ~np.isin(np.arange(len(distinct)), codes[np.searchsorted(begins[:-1], offsets[:-1][whole])]) if len(whole) else True
    # a text encoded as one chunk may be a chunk that stands for itself elsewhere: both have the same ids
    for chosen, how in ((np.flatnonzero(plain & (slots < 0)), encode_joined), (np.flatnonzero(~plain & (slots < 0)), encode_each)):
        if len(chosen):
            slots[chosen] = memo.add([keys[i] for i in chosen], *how(distinct.take(pa.array(chosen)), path))
    lengths, starts, flat = memo.lengths[slots], memo.starts[slots], memo.flat
    per = lengths[codes]
    ids = flat[ragged(starts[codes], per)]
    ends = np.concatenate([[0], np.cumsum(per)])
    return ids, ends[np.searchsorted(begins[:-1], offsets)]


def with_ends(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with the end id appended to each document."""
    n = len(offsets) - 1
    out, at = np.full(len(ids) + n, end_id, dtype=np.uint32), offsets + np.arange(n + 1)
    out[ragged(at[:-1], np.diff(offsets))] = ids
    return out, at


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, frame_ids: int = FRAME_IDS) -> DataFrame:
    """Encode every text and write shards under `path`, in ascending order of the id column.

    Documents are dealt out by ranges of (id, hash of the text), nulls first, whole duplicates in any order; so neither a
    hot source nor a group of copies nor different texts of one id stand in one task. Each task writes its
    shard under another name and renames it, so that a task that is run again replaces it whole. A null text is
    empty, an empty table gives no shard; further columns play no part.

    Returns a row per document: shard (file name), doc_id, first (ids in the shard before it), n_tokens with the end
    id, part (number of the shard in ascending order).
    """
    fs, root = pafs.FileSystem.from_uri(path)
    fs.create_dir(root, recursive=True)

    def write(batches):
        from pyspark import TaskContext

        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        own, own_root = pafs.FileSystem.from_uri(path)
        own.create_dir(own_root, recursive=True)
        name, temporary = f"{own_root}/part-{part:06d}.zst", f"{own_root}/.part-{part:06d}-{attempt}"
        first, file, shard = 0, None, None
        for batch in batches:
            data, offsets = texts(batch.column(1))
            for i, j in sliced(offsets, 4 << 20):
                if file is None:
                    file = own.open_output_stream(temporary)
                    shard = ShardWriter(file, frame_ids)
                ids, at = with_ends(*encode(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], tokenizer_path), end_id)
                for k in range(j - i):
                    shard.add(ids[at[k] : at[k + 1]])
                yield pa.record_batch([pa.array([f"part-{part:06d}.zst"] * (j - i)), batch.column(0).slice(i, j - i).cast(pa.int64()), pa.array(at[:-1] + first), pa.array(np.diff(at)), pa.array([part] * (j - i), pa.int32())], names=["shard", "doc_id", "first", "n_tokens", "part"])
                first += len(ids)
        if file is not None:
            shard.finish()
            file.close()
            if own.get_file_info(name).type != pafs.FileType.NotFound:  # of an attempt before, and the same
                own.delete_file(name)
            own.move(temporary, name)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    dealt = rows.withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    return written(dealt.mapInArrow(tidy(write), "shard string, doc_id long, first long, n_tokens long, part int"), "token-index")


def starts(index: DataFrame) -> DataFrame:
    """The index with `start`, the ids of all documents before each. One row a shard meets in one task."""
    totals = index.groupBy("part").agg(F.max(F.col("first") + F.col("n_tokens")).alias("total"))
    before = totals.withColumn("before", F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long"))
    return index.join(before.select("part", "before"), "part").withColumn("start", F.col("before") + F.col("first"))


def read_documents(index: DataFrame, path: str) -> DataFrame:
    """Rows of the index with ids_crc32, taken from the shards by their seek tables; the ids stay in the task."""
    wanted = index.columns

    def read(batches):
        own, root = pafs.FileSystem.from_uri(path)
        name, reader = "", None
        for batch in batches:
            out = []
            for shard, first, n in zip(batch.column(wanted.index("shard")).to_pylist(), batch.column(wanted.index("first")).to_pylist(), batch.column(wanted.index("n_tokens")).to_pylist(), strict=True):
                if shard != name:
                    name, reader = shard, ShardReader(own.open_input_file(f"{root}/{shard}"))
                out.append(crc32(reader.read(first, n)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], names=[*batch.schema.names, "ids_crc32"])

    return index.mapInArrow(tidy(read), StructType([*index.schema.fields, StructField("ids_crc32", LongType())]))


def op1_token_output(spark, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the shards."""
    import public_tokenizers

    return token_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))


def token_digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    path = left_behind(docs.sparkSession, shared_dir(docs.sparkSession, "tokens"))
    index = starts(write_tokens(docs, path, tokenizer_path))
    return read_documents(index, path).select("doc_id", "start", "n_tokens", "ids_crc32", "shard", "first")
