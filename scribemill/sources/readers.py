"""Readers of subtitles, annotations, documents, manifests and tables as DataFrames."""

from __future__ import annotations

import fnmatch
import os
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote, urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scribemill.functions.arrays import seconds_to_ms, srt_ms
from scribemill.functions.text import without_tags
from scribemill.operators.sequence import SILENCE
from scribemill.operators.tables import stored
from scribemill.sources.audio import AUDIO_RATE, Wav, resampled

SUB = "struct<start:bigint,end:bigint,duration:bigint,text:string,duplicate:boolean,live:boolean,id:int,speaker_id:string>"
SCORES = "struct<bleu:double,wer:double,first:double,last:double>"
TRANSCRIPTION = f"struct<text:string,model:string,word_timestamps:array<struct<word:string,start_time:double,end_time:double>>,scores:{SCORES}>"
FILTERS = "struct<stage1_whisper:boolean,stage2_whisper:boolean,stage2_whisper_timestamps:boolean,stage1_wav2vec:boolean,silence:boolean>"
CHUNK = f"struct<start:bigint,end:bigint,duration:bigint,text:string,text_whisper:string,sub_ids:array<int>,subs:array<{SUB}>,transcription:array<{TRANSCRIPTION}>,language_probs:map<string,map<string,double>>,filters:{FILTERS}>"
METADATA = "struct<audio_path:string,channel:string,subchannel:string,data_source:string,year:int,month:int,day:int,from_time:int,to_time:int,category:string,location:string,speaker_id:string,version:string,dialect:string,id:string,program_title:string,video_file:string,caption_file:string,program_classification:string,is_asrun:boolean,production_year:string>"
DOCUMENT = f"metadata {METADATA}, subs array<{SUB}>, chunks array<{CHUNK}>"
# Audio extensions, the one to take first.
EXTENSIONS = ["webm", "wav", "m4a", "mp3", "mp4", "mkv", "flac"]


def of_channels(files: DataFrame, channels: list[str], depth: int = -2) -> DataFrame:
    """Files (path) whose folder at this place from the end is one of the channels."""
    return files.where(F.element_at(F.split("path", "/"), depth).isin(channels))


def read_shard_stats(spark: SparkSession, path, schema: str | None = None) -> DataFrame:
    """Statistics of shards, one JSON object a file, with the file's name (file) and its folder's (dataset)."""
    reader = spark.read.option("recursiveFileLookup", True)
    out = (reader.schema(schema) if schema else reader).json(path)
    steps = F.split(F.col("_metadata.file_path"), "/")
    return out.withColumns({"file": F.element_at(steps, -1), "dataset": F.element_at(steps, -2)})


def literal_table(spark: SparkSession, tables: dict[str, dict], key: str = "name") -> DataFrame:
    """A row for each entry of a dictionary of dictionaries, under its key; what an entry lacks is null."""
    names = list(dict.fromkeys(k for x in tables.values() for k in x))
    return spark.createDataFrame([{key: k, **{n: x.get(n) for n in names}} for k, x in tables.items()])


#: bytes and files that a task passes on at once
BATCH_BYTES, BATCH_FILES = 4 << 20, 1000


def files_below(folder: str, glob: str | None) -> Iterator[str]:
    """Places of the files below a folder, as a stream; names that begin with _ or . are hidden, as Spark has it."""
    hidden = re.compile(r"\.|_(?!.*=)")
    folders = [folder]
    while folders:
        with os.scandir(folders.pop()) as entries:
            for x in entries:
                if hidden.match(x.name):
                    continue
                if x.is_dir():
                    folders.append(x.path)
                elif glob is None or fnmatch.fnmatchcase(x.name, glob):
                    yield x.path


def address(place: str) -> str:
    """The address of a file of a local or mounted folder, as Spark writes it."""
    return "file:" + re.sub(r'[\x00-\x20"%<>?#\[\\\]^`{|}\x7f]', lambda c: quote(c[0]), place)


def folder_files(spark: SparkSession, folder: str, glob: str | None, empty: bool = False) -> DataFrame:
    """path and value of the files below a local or mounted folder: one task lists them, as a stream, and all read them,
    so that neither the driver holds the list nor a task is made for a few files."""

    def listed(batches):
        for _ in batches:
            names = []
            for name in files_below(folder, glob):
                names.append(name)
                if len(names) == 10_000:
                    yield pa.record_batch([pa.array(names, pa.string())], names=["place"])
                    names = []
            yield pa.record_batch([pa.array(names, pa.string())], names=["place"])

    def read(batches):
        for batch in batches:
            paths, texts, size = [], [], 0
            for place in batch.column(0).to_pylist():
                try:
                    with open(place, "rb") as x:
                        text = x.read()
                except FileNotFoundError:
                    continue
                if not text and not empty:
                    continue
                paths.append(address(place))
                texts.append(text)
                size += len(text)
                if size >= BATCH_BYTES or len(paths) == BATCH_FILES:
                    yield pa.record_batch([pa.array(paths, pa.string()), pa.array(texts, pa.binary())], names=["path", "value"])
                    paths, texts, size = [], [], 0
            if paths:
                yield pa.record_batch([pa.array(paths, pa.string()), pa.array(texts, pa.binary())], names=["path", "value"])

    places = spark.range(0, 1, 1, 1).mapInArrow(listed, "place string")
    places = places.repartition(3 * spark.sparkContext.defaultParallelism, "place")
    return places.mapInArrow(read, "path string, value binary").select("path", F.col("value").cast("string").alias("value"))


def whole_files(spark: SparkSession, path, glob: str | None = None, empty: bool = False) -> DataFrame:
    """path and value (the whole text) of every file below a folder. Files without a byte are passed over, as Spark does;
    with `empty` those of a local or mounted folder are rows too."""
    parts = urlparse(path) if isinstance(path, str) else None
    # a local or mounted folder; globs of several alternatives, lists, single files and other stores are Spark's own
    if parts and parts.scheme in ("", "file") and not re.search(r"[{\\]|\[\^", glob or ""):
        folder = os.path.abspath(unquote(parts.path) if parts.scheme else path)
        if os.path.isdir(folder):
            return folder_files(spark, folder, glob, empty)
    reader = spark.read.option("recursiveFileLookup", True).option("ignoreMissingFiles", True)
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    return reader.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")


TIME_LINE = r"\d+:\d+:\d+[,.]\d+ *--> *\d+:\d+:\d+[,.]\d+"
#: xmin, xmax and text of an interval; of the text only doubled quotes are taken one by one, which long ones bear
INTERVAL = r'xmin = ([\d.eE+-]+)\s+xmax = ([\d.eE+-]+)\s+text = "([^"]*+(?:""[^"]*+)*+)"'


def failed_files(spark: SparkSession, path, kind: str, glob: str | None = None) -> DataFrame:
    """file_id and error of the files that the reader of a kind (srt, textgrid, manifest) has no rows of; files without
    a byte, which Spark passes over, are not among them."""
    found = {"srt": ("*.srt", F.regexp_like("value", F.lit(TIME_LINE)), "no time line"), "textgrid": ("*.TextGrid", F.regexp_like("value", F.lit(INTERVAL)), "no interval"), "manifest": ("*.json", F.from_json("value", "array<string>").isNotNull(), "not a JSON list")}
    glob_, good, error = (glob or found[kind][0], *found[kind][1:])
    # what is not UTF-8 is no text to look into
    utf8 = F.is_valid_utf8("value")
    why = F.when(~utf8, "not UTF-8").when(~F.coalesce(F.when(utf8, good), F.lit(False)), error)
    return whole_files(spark, path, glob_).select(F.col("path").alias("file_id"), why.alias("error")).where("error is not null")


def read_srt(spark: SparkSession, path, glob: str = "*.srt") -> DataFrame:
    """file_id (path), idx (from 0), start, end, text without tags. Blocks without a time line are passed over; files
    without any and those that are not valid UTF-8 have no rows here but one in `failed_files`."""
    files = whole_files(spark, path, glob).where(F.is_valid_utf8("value"))
    body = F.regexp_replace(F.regexp_replace(F.regexp_replace("value", "^\ufeff", ""), r"\r\n?", "\n"), r"\n[ \t]+\n", "\n\n")
    # numbered in the file's own list, without a window over its rows
    blocks = files.select("path", F.posexplode(F.filter(F.split(body, r"\n{2,}"), lambda b: F.regexp_like(b, F.lit(TIME_LINE)))).alias("idx", "b"))
    times = r"(\d+:\d+:\d+[,.]\d+) *--> *(\d+:\d+:\d+[,.]\d+)"
    get = lambda i: F.regexp_extract("b", times if i < 3 else rf"(?s){times}[^\n]*\n?(.*)\z", i)
    return blocks.select(F.col("path").alias("file_id"), "idx", srt_ms(get(1)).alias("start"), srt_ms(get(2)).alias("end"), F.trim(without_tags(F.regexp_replace(get(3), r"\n+$", ""))).alias("text"))


def read_textgrid(spark: SparkSession, path, glob: str = "*.TextGrid") -> DataFrame:
    """Intervals of all tiers in order: file_id, idx, start, end, duration (each rounded by itself), text; a blank mark
    is a silence. Long-format files; others have no rows here but one in `failed_files`."""
    part = lambda i: F.regexp_extract_all("value", F.lit(INTERVAL), F.lit(i))
    rows = whole_files(spark, path, glob).select("path", F.posexplode(F.arrays_zip(part(1).alias("a"), part(2).alias("b"), part(3).alias("t"))).alias("idx", "x"))
    a, b = F.col("x.a").cast("double"), F.col("x.b").cast("double")
    text = F.replace(F.col("x.t"), F.lit('""'), F.lit('"'))
    return rows.select(F.col("path").alias("file_id"), "idx", seconds_to_ms(a).alias("start"), seconds_to_ms(b).alias("end"), seconds_to_ms(b - a).alias("duration"), F.when(F.trim(text) == "", SILENCE).otherwise(text).alias("text"))


def speaker_subs(rows: DataFrame) -> DataFrame:
    """Rows (sub_start, sub_end in seconds, speaker_id, text) as subtitles in ms, without transcribers' rows and rows of
    no duration."""
    kept = rows.where(~F.contains("speaker_id", F.lit("trans"))).withColumns({"start": seconds_to_ms(F.col("sub_start")), "end": seconds_to_ms(F.col("sub_end")), "duration": seconds_to_ms(F.col("sub_end") - F.col("sub_start"))})
    return kept.where("duration <> 0").drop("sub_start", "sub_end")


def read_pipe_csv(spark: SparkSession, path, schema: str, quoted: bool) -> DataFrame:
    """Headerless tables with | between the columns."""
    return spark.read.schema(schema).options(sep="|", quote='"' if quoted else "").csv(path)


def read_csv(spark: SparkSession, path, schema: str | None = None) -> DataFrame:
    """Tables with a header, from one path or many, with the file they come from."""
    reader = spark.read.option("header", True)
    out = (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)
    return out.withColumn("file", F.col("_metadata.file_path"))


def read_documents(spark: SparkSession, path, schema: str = DOCUMENT, once: bool = False) -> tuple[DataFrame, DataFrame]:
    """JSON documents, one a file, with file_id; and apart from them the files that do not parse (file_id, text). With
    `once`, files are read and parsed into a table of the shared folder, for those who use both."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    raw = whole_files(spark, path).select(F.col("path").alias("file_id"), F.from_json("value", f"{schema}, _corrupt string", options).alias("d")).select("file_id", "d.*")
    raw = stored(raw, "documents-read") if once else raw
    return raw.where("_corrupt is null").drop("_corrupt"), raw.where("_corrupt is not null").select("file_id", F.col("_corrupt").alias("text"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Paths of a manifest: lines of text, or a JSON list of paths or of [document, audio] pairs; path and audio. A JSON
    file that is no list has no rows here but one in `failed_files`."""
    if path.endswith(".json"):
        text = spark.read.text(path, wholetext=True)
        items = text.select(F.explode(F.from_json("value", "array<string>")).alias("x"))
        pair = F.from_json("x", "array<string>")
        return items.select(F.coalesce(F.get(pair, F.lit(0)), F.col("x")).alias("path"), F.get(pair, F.lit(1)).alias("audio"))
    lines = spark.read.text(path).where(F.trim("value") != "").select(F.split(F.trim("value"), r"\s+").alias("x"))
    return lines.select(F.get("x", F.lit(0)).alias("path"), F.get("x", F.lit(1)).alias("audio"))


def read_transcripts(spark: SparkSession, path, glob: str = "*.txt", space: str = r"(?U)\s") -> DataFrame:
    """filename and transcription of text files that hold one transcript each, without the white space (space, a pattern
    of one character) at its end. A file without a byte is an empty transcript, if `whole_files` has it."""
    rows = whole_files(spark, path, glob, empty=True)
    # a run is tried from its start only
    end = rf"(?<!{space}){space}+\z"
    return rows.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("filename"), F.regexp_replace("value", end, "").alias("transcription"))


def read_audio(spark: SparkSession, path, glob: str = "*.wav") -> DataFrame:
    """path, rate and audio (mono floats at 16 kHz, through a low-pass) of whole PCM WAV files; a file that cannot be
    read has an error and no audio. Other containers have to be converted first. Of long files, take chunks
    (`audio.read_chunks`)."""

    def decode(frames):
        for df in frames:
            out = []
            for name, content in zip(df["path"], df["content"], strict=True):
                try:
                    wav = Wav(pa.BufferReader(content))
                    whole = resampled(wav.slice(0, wav.samples), wav.rate, 0, wav.samples * AUDIO_RATE // wav.rate)
                    out.append((name, wav.rate, whole.astype(np.float32), None))
                except Exception as e:  # noqa: BLE001 - any file may be broken in any way
                    out.append((name, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["path", "rate", "audio", "error"]).astype({"rate": "Int32"})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select("path", "content").mapInPandas(decode, "path string, rate int, audio array<float>, error string")


def audio_of(bases: DataFrame, listing: DataFrame, base: str = "base") -> DataFrame:
    """Adds audio_path: of the listed paths that are the base and a known extension, that of the first extension."""
    split = lambda i: F.regexp_extract("path", r"^(.*)\.([^./]+)$", i)
    rank = F.array_position(F.array(*map(F.lit, EXTENSIONS)), split(2))
    known = listing.select(split(1).alias(base), "path", rank.alias("rank")).where("rank > 0").groupBy(base).agg(F.min_by("path", "rank").alias("audio_path"))
    return bases.join(known, base, "left")


def swedish_stream(streams: DataFrame, language: str = "swe") -> DataFrame:
    """Of each file's subtitle streams (file_id, stream, language) the first whose language names Swedish, or another."""
    return streams.where(F.contains(F.lower("language"), F.lit(language))).groupBy("file_id").agg(F.min("stream").alias("stream"))


def program_parts(name: Column) -> dict[str, Column]:
    """Channel, subchannel, year, month, day, from_time and to_time of names of six parts between underscores; null
    for other names."""
    parts = F.split(name, "_")
    part = lambda i: F.when(F.size(parts) == 6, F.get(parts, F.lit(i)))
    date = F.split(part(3), "-")
    number = lambda x: F.try_to_number(x, F.lit("999999999999")).cast("int")
    return {
        "channel": part(0),
        "subchannel": part(1),
        **{k: number(F.get(date, F.lit(i))) for i, k in enumerate(("year", "month", "day"))},
        "from_time": number(F.left(part(4), F.lit(6))),
        "to_time": number(F.left(part(5), F.lit(6))),
    }
