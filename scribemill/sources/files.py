"""A sink of files that the rows name themselves: one file a document, subtitle stream or chunk.

A task writes each file under a hidden name beside its place and renames it when it is whole, so that there is never a
part of a file under its own name, and a task that is run again puts the same files in place. What a task has written it
lists in a file of the folder _written; when the job succeeds, these lists go and _SUCCESS stands instead, with the number of
files; when it fails, the files in the lists are deleted.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import BinaryType, StructType

from scribemill.functions.text import clean_subtitle
from scribemill.sources import writers
from scribemill.sources.audio import AUDIO_RATE

FORMAT, LISTS, DONE = "named_files", "_written", "_SUCCESS"


def store_of(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path, of this machine or of a store that Arrow knows by its address, and the place in it."""
    parts = urlparse(path)
    if parts.scheme in ("", "file"):
        return pafs.LocalFileSystem(), unquote(parts.path).rstrip("/")
    store, place = pafs.FileSystem.from_uri(path)
    return store, place.rstrip("/")


def put(store: pafs.FileSystem, place: str, content: bytes, mark: str, folders: set[str] | None = None) -> None:
    """A file in its place, whole or not at all. folders: those that are known to be there, to which its own is added."""
    folder, name = place.rsplit("/", 1)
    if folders is None or folder not in folders:
        store.create_dir(folder, recursive=True)
        if folders is not None:
            folders.add(folder)
    hidden = f"{folder}/.{name}.{mark}"
    try:
        with store.open_output_stream(hidden) as out:
            out.write(content)
        store.move(hidden, place)
    except BaseException:
        if store.get_file_info(hidden).type == pafs.FileType.File:
            store.delete_file(hidden)
        raise


@dataclass
class Written(WriterCommitMessage):
    files: int


class NamedFilesWriter(DataSourceWriter):
    def __init__(self, path: str, schema: StructType):
        self.path, self.job = path, uuid.uuid4().hex[:12]
        if schema.names[:2] != ["name", "content"]:
            raise ValueError("the columns are name and content")

    def write(self, iterator: Iterator[Row]) -> Written:
        from pyspark import TaskContext

        store, base = store_of(self.path)
        task = TaskContext.get()
        mark = f"{self.job}-{task.partitionId()}-{task.taskAttemptId()}"
        # rows of one name come to one task
        names: dict[str, None] = {}
        folders: set[str] = set()
        try:
            for row in iterator:
                name, content = row[0], row[1]
                if not name or name.startswith("/") or any(x in ("", ".", "..") or x.startswith("_written") for x in name.split("/")):
                    raise ValueError(f"not a name of a file: {name!r}")
                if name in names:
                    continue
                put(store, f"{base}/{name}", bytes(content or b""), mark, folders)
                names[name] = None
        finally:
            # of a task that fails too: the job's end deletes what it has put in place
            if names:
                put(store, f"{base}/{LISTS}/{self.job}/{mark}", json.dumps(list(names)).encode(), "list")
        return Written(len(names))

    def lists(self, store, base: str):
        folder = f"{base}/{LISTS}/{self.job}"
        if store.get_file_info(folder).type == pafs.FileType.Directory:
            yield from store.get_file_info(pafs.FileSelector(folder))

    def clear(self, store, base: str) -> None:
        folder = f"{base}/{LISTS}"
        if store.get_file_info(f"{folder}/{self.job}").type == pafs.FileType.Directory:
            store.delete_dir(f"{folder}/{self.job}")
        if store.get_file_info(folder).type == pafs.FileType.Directory and not store.get_file_info(pafs.FileSelector(folder)):
            store.delete_dir(folder)

    def commit(self, messages: list[Written | None]) -> None:
        store, base = store_of(self.path)
        store.create_dir(base, recursive=True)
        self.clear(store, base)
        put(store, f"{base}/{DONE}", json.dumps({"files": sum(m.files for m in messages if m)}).encode(), self.job)

    def abort(self, messages: list[Written | None]) -> None:
        store, base = store_of(self.path)
        for found in self.lists(store, base):
            with store.open_input_stream(found.path) as x:
                names = json.loads(x.read())
            for name in names:
                if store.get_file_info(f"{base}/{name}").type == pafs.FileType.File:
                    store.delete_file(f"{base}/{name}")
        self.clear(store, base)


class NamedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> NamedFilesWriter:
        return NamedFilesWriter(self.options["path"], schema)


def write_files(rows: DataFrame, path: str, name: str = "name", content: str = "content") -> None:
    """A file for each row: its name below path, with / between folders, and its content (text as UTF-8, or bytes; null: empty).
    All cores write, however few bytes the files have. Files of these names are replaced, others stay. Names without a part or with .. are errors; of rows of one name
    one is kept."""
    rows.sparkSession.dataSource.register(NamedFiles)
    text = F.col(content) if isinstance(rows.schema[content].dataType, BinaryType) else F.encode(F.col(content).cast("string"), "UTF-8")
    rows.select(F.col(name).cast("string").alias("name"), text.alias("content")).repartition(3 * rows.sparkSession.sparkContext.defaultParallelism, "name").write.format(FORMAT).mode("append").save(path)


def write_document_files(docs: DataFrame, path: str, ascii_only: bool = False, suffix: str | None = None) -> None:
    """A JSON file for each document (file_id: its name below path), NaN as null; with a suffix, under its name with that
    suffix instead of its own."""
    name = writers.output_name(F.col("file_id"), suffix) if suffix else F.col("file_id")
    write_files(writers.json_texts(docs, ascii_only).select(name.alias("name"), "value"), path, content="value")


def write_srt_files(subs: DataFrame, path: str, suffix: str = ".srt") -> None:
    """An SRT file for each file_id, under its name with that suffix."""
    write_files(writers.srt_texts(subs).select(writers.output_name(F.col("file_id"), suffix).alias("name"), "value"), path, content="value")


def wav_bytes(audio: Column, rate: int = AUDIO_RATE) -> Column:
    """Mono samples between -1 and 1 as a WAV file of 16 bits."""

    @F.arrow_udf(BinaryType())
    def encode(column: pa.Array) -> pa.Array:
        import struct

        out = []
        for x in column:
            if not x.is_valid:
                out.append(None)
                continue
            samples = x.values.cast(pa.float64()).fill_null(0).to_numpy(zero_copy_only=False)
            data = np.clip(np.rint(samples * 32_768), -32_768, 32_767).astype("<i2").tobytes()
            out.append(b"RIFF" + struct.pack("<I", 36 + len(data)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, 2 * rate, 2, 16) + b"data" + struct.pack("<I", len(data)) + data)
        return pa.array(out, pa.binary())

    return encode(audio)


def write_chunk_files(rows: DataFrame, path: str, stage: str = "stage1_wav2vec", clean=clean_subtitle) -> None:
    """Chunks of a stage as pairs of files, <file_id without suffix>/chunks/<start>_<end>.wav and .txt, the text cleaned."""
    kept = rows.where(F.col(stage))
    base = F.concat(writers.output_name(F.col("file_id"), "/chunks/"), F.col("start").cast("string"), F.lit("_"), F.col("end").cast("string"))
    both = kept.select(base.alias("base"), wav_bytes(F.col("audio")).alias("wav"), F.encode(clean(F.col("text")), "UTF-8").alias("txt"))
    pair = F.array(*(F.struct(F.concat("base", F.lit(f".{x}")).alias("name"), F.col(x).alias("content")) for x in ("wav", "txt")))
    write_files(both.select(F.inline(pair)), path)
