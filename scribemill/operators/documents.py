"""Documents (metadata, subs, chunks with transcriptions) as flat rows, and flat rows made ready for training.

A null in any column stays null unless said otherwise; documents without chunks give no rows, equal rows stay apart,
and empty tables give none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scribemill.functions import text as T
from scribemill.functions.arrays import audio_slice, frames
from scribemill.functions.names import EXCLUDED_RECORDINGS, recording_name
from scribemill.operators import quality, sequence

# What documents without a field have in statistics.
UNKNOWN = {"channel": "Unknown Channel", "id": "Unknown ID", "program_title": "Unknown Title", "video_file": "Unknown Video File", "caption_file": "Unknown Caption File", "data_source": "Unknown Source"}
#: the models whose texts flat rows have, if none are given
WHISPER, WAV2VEC = "models/whisper", "models/wav2vec2"
NO_SPEECH = "<|nospeech|>"
SCORES = ["bleu", "wer", "first", "last"]
FILTERS = ["stage1_whisper", "stage2_whisper", "stage2_whisper_timestamps", "stage1_wav2vec", "silence"]


def sub_rows(docs: DataFrame, field: str = "subs") -> DataFrame:
    """file_id, idx and the fields of every element of a list of structs; of an empty or null list one row of nulls."""
    rows = docs.select("file_id", F.posexplode_outer(field).alias("idx", "x"))
    return rows.select("file_id", "idx", *(F.col("x")[f.name].alias(f.name) for f in docs.schema[field].dataType.elementType.fields if f.name not in ("file_id", "idx")))


def transcribed_chunks(docs: DataFrame) -> DataFrame:
    """file_id, metadata, number and chunk (c) of the chunks that have a transcription."""
    rows = docs.select("file_id", "metadata", F.posexplode("chunks").alias("number", "c"))
    return rows.where(F.size("c.transcription") > 0)


def chunk_scores() -> dict[str, Column]:
    """Scores by place: those of the first transcription if its model is a whisper, else null; those of the second if
    there is one and it is a wav2vec, else 0."""
    first, second = F.get("c.transcription", F.lit(0)), F.get("c.transcription", F.lit(1))
    a = {f"{s}_whisper": F.when(F.contains(first["model"], F.lit("whisper")), first["scores"][s]) for s in SCORES}
    is_second = F.coalesce(F.contains(second["model"], F.lit("wav2vec")), F.lit(False))
    return a | {f"{s}_wav2vec": F.when(is_second, second["scores"][s]).otherwise(0.0) for s in SCORES}


def chunk_filters(prefix: str = "") -> dict[str, Column]:
    """The stage columns of a chunk; what is missing is false."""
    return {f"{prefix}{f}": F.coalesce(F.col("c.filters")[f], F.lit(False)) for f in FILTERS}


def text_of_model(model: str) -> Column:
    """The text of a chunk's last transcription by just that model; null without one."""
    own = F.filter("c.transcription", lambda t: t["model"] == model)
    return F.when(F.size(own) > 0, F.element_at(own, -1)["text"])


def chunk_rows(docs: DataFrame, audio: DataFrame | None = None) -> DataFrame:
    """A row for each chunk with a transcription: ids of its subtitles as text, source, times, texts, transcriptions,
    scores and stages. With audio (file_id, audio_path, audio), the chunk's samples and path too."""
    text = lambda f: F.coalesce(F.col(f"c.{f}"), F.lit("")).alias(f)
    ids = F.concat(F.lit("["), F.array_join(F.col("c.sub_ids").cast("array<string>"), ", "), F.lit("]")).alias("sub_ids")
    rows = transcribed_chunks(docs).select(
        "file_id",
        "number",
        ids,
        F.col("metadata.data_source").alias("source"),
        "c.start",
        "c.end",
        text("text"),
        text("text_whisper"),
        text_of_model(WHISPER).alias("whisper_transcription"),
        text_of_model(WAV2VEC).alias("wav2vec_transcription"),
        *(x.alias(k) for k, x in (chunk_scores() | chunk_filters()).items()),
    )
    if audio is None:
        return rows
    own = audio_slice(F.col("audio"), frames(F.col("start")), frames(F.col("end")))
    return rows.join(audio.select("file_id", "audio_path", "audio"), "file_id").withColumn("audio", own)


def stat_rows(docs: DataFrame) -> DataFrame:
    """A row for each chunk with a transcription, for statistics: metadata with defaults, duration, texts by place,
    scores and stages. What was captioned as run (is_asrun) is told by the channel where the metadata do not say."""
    known = lambda f: F.coalesce(F.col(f"metadata.{f}"), F.lit(UNKNOWN[f]))
    text = lambda x: F.coalesce(x, F.lit(""))
    place = lambda i: text(F.get("c.transcription", F.lit(i))["text"])
    as_run = F.coalesce(F.col("metadata.is_asrun"), F.contains(F.upper("metadata.channel"), F.lit("ASRUN")), F.lit(False))
    return transcribed_chunks(docs).select(
        "file_id",
        "number",
        *(known(f).alias("source" if f == "data_source" else f) for f in UNKNOWN),
        as_run.alias("is_asrun"),
        (F.col("c.end") - F.col("c.start")).alias("duration_ms"),
        "metadata.production_year",
        "metadata.program_classification",
        F.col("c.start").alias("start_time"),
        F.col("c.end").alias("end_time"),
        text(F.col("c.text")).alias("text"),
        text(F.col("c.text_whisper")).alias("text_whisper"),
        place(0).alias("transcription_whisper"),
        place(1).alias("transcription_wav2vec2"),
        *(x.alias(k) for k, x in (chunk_scores() | chunk_filters()).items()),
    )


# Rows made ready


def sub_id_list(text: Column) -> Column:
    """The ids of a list in text, [1, -2]; null for anything else."""
    return F.from_json(text, "array<int>")


def with_sub_ids(rows: DataFrame) -> DataFrame:
    """Rows whose sub_ids, a list in text, are not '' or '[]'."""
    return rows.where(~F.col("sub_ids").isin("", "[]"))


def first_and_last(ids: Column) -> dict[str, Column]:
    """The first and the last id of a list, without their signs."""
    return {"sub_id_first": F.abs(F.get(ids, F.lit(0))), "sub_id_last": F.abs(F.get(ids, F.size(ids) - 1))}


def standard_names(rows: DataFrame, dataset: str) -> DataFrame:
    """The columns' usual names: audio as audio_tensor, but in isof, whose audio is a path."""
    if dataset == "isof":
        return rows.withColumnsRenamed({"start_time": "start", "end_time": "end", "audio": "audio_path"})
    return rows if "audio_tensor" in rows.columns else rows.withColumnRenamed("audio", "audio_tensor")


def with_previous_text(rows: DataFrame, dataset: str) -> DataFrame:
    """Adds previous_text: of speeches by chunk_id, of broadcasts and videos by the first subtitle's id within the audio
    file; other datasets have none. Videos without subtitle ids go."""
    if dataset == "rixvox":
        return sequence.previous_text(rows, "speech_id", "chunk_id")
    if dataset not in ("svt", "smdb", "youtube"):
        return rows.withColumn("previous_text", F.lit(None).cast("string"))
    rows = with_sub_ids(rows) if dataset == "youtube" else rows
    ids = sub_id_list(F.col("sub_ids")) if dict(rows.dtypes)["sub_ids"] == "string" else F.col("sub_ids")
    return sequence.previous_text(rows.withColumns(first_and_last(ids)), "audio_path", "sub_id_first")


def prepared(rows: DataFrame, dataset: str, clean: Callable[[Column], Column] = T.clean_text, metrics: bool = True) -> DataFrame:
    """Flat chunk rows for training: texts cleaned, words counted, timestamps as tokens, silences told and marked, names
    made alike, the text before, the samples' number, and with `metrics` the scores that the stages use.

    Features and token ids come from models: see operators.models.with_model.
    """
    silent = quality.is_silence(F.col("text"), F.col("wav2vec_transcription"))
    mark = lambda x: F.when(F.col("is_silence"), F.concat(F.lit(NO_SPEECH), x)).otherwise(x)
    out = rows.withColumn("text", clean(F.col("text")))
    out = out.withColumns({"n_words": T.word_count(F.col("text")), "text_timestamps": T.timestamp_tokens(clean(F.col("text_whisper"))), "is_silence": F.coalesce(silent, F.lit(False))})
    out = out.withColumns({c: mark(F.col(c)) for c in ("text", "text_timestamps")})
    out = with_previous_text(standard_names(out, dataset), dataset)
    if "audio_tensor" in out.columns:
        out = out.withColumn("input_length", F.size("audio_tensor"))
    if metrics:
        out = quality.with_metrics(out.withColumn("__silence", F.col("is_silence"))).withColumn("is_silence", F.col("__silence")).drop("__silence")
    return out


WHISPER_COLUMNS = "input_features attention_mask labels labels_timestamps text text_timestamps previous_text previous_tokens duration audio_path is_silence stage2_whisper_timestamps data_source".split()


def selected(rows: DataFrame, columns: list[str] = WHISPER_COLUMNS) -> DataFrame:
    """Of the columns those that the rows have."""
    return rows.select(*(c for c in columns if c in rows.columns))


# Filters of files and rows


def transcription_state(chunks: Column, model: str) -> dict[str, Column]:
    """What a document's first chunk tells: transcribed at all, by the model, and with a language."""
    first = F.get(chunks, F.lit(0))
    own = first["transcription"]
    by = F.coalesce(F.exists(own, lambda t: t["model"] == model), F.lit(False))
    return {"is_transcribed": F.coalesce(F.size(own) > 0, F.lit(False)), "is_transcribed_same_model": by, "is_langdetected": F.coalesce(F.size(F.map_keys(first["language_probs"])) > 0, F.lit(False))}


def without_excluded(rows: DataFrame, name: str, excluded: list[str] = EXCLUDED_RECORDINGS) -> DataFrame:
    """Rows of recordings that are not on a list; a null name stays."""
    return rows.where(~F.coalesce(recording_name(F.col(name)).isin(excluded), F.lit(False)))


def with_audio(rows: DataFrame, listing: DataFrame, path: str = "audio_path") -> DataFrame:
    """Rows whose audio file is in a listing (path)."""
    return rows.join(listing.select(F.col("path").alias("__listed")), F.col(path) == F.col("__listed"), "left_semi")


def long_buckets(buckets: DataFrame, least_ms: int = 2000) -> DataFrame:
    return buckets.where(F.col("end_bucket") - F.col("start_bucket") >= least_ms)


def with_metadata(files: DataFrame, metadata: DataFrame) -> DataFrame:
    """Files (path) with the metadata of the folder that they stand in: metadata's `folder` is its last part."""
    return files.withColumn("folder", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)).join(metadata, "folder")


def transcription_entries(texts: Column, model: str, word_times: Column | None = None) -> Column:
    """Entries (text, model[, word_timestamps]) of a list of texts, without null ones."""
    zipped = F.arrays_zip(texts.alias("text"), word_times.alias("word_timestamps")) if word_times is not None else F.arrays_zip(texts.alias("text"))
    kept = F.filter(zipped, lambda x: x["text"].isNotNull())
    return F.transform(kept, lambda x: F.struct(x["text"].alias("text"), *([x["word_timestamps"].alias("word_timestamps")] if word_times is not None else []), F.lit(model).alias("model")))


# Subtitles with marks in their texts

DUPLICATE, LIVE = "<duplicate>", "<live_sub>"


def marks(text: Column) -> dict[str, Column]:
    """duplicate, live (where the text begins so, and is no duplicate) and is_silence of marked texts; a null has none."""
    said = lambda x: F.coalesce(x, F.lit(False))
    twice = said(F.contains(text, F.lit(DUPLICATE)))
    return {"duplicate": twice, "live": said(F.startswith(text, F.lit(LIVE))) & ~twice, "is_silence": said((text == "") | (text == sequence.SILENCE))}


def marked_stats(subs: DataFrame) -> DataFrame:
    """Of each file of subtitles marked in their texts: number and duration in all, of duplicates and of live ones."""
    rows = subs.withColumns(marks(F.col("text"))).withColumn("d", F.col("end") - F.col("start"))
    of = lambda k, x: F.sum(F.when(F.col(k), x).otherwise(0)).cast("long")
    pairs = [x for k, n in (("duplicate", "duplicates"), ("live", "livesubs")) for x in (of(k, F.lit(1)).alias(f"{n}_count"), of(k, F.col("d")).alias(f"subs_duration_{k}"))]
    return rows.groupBy("file_id").agg(F.count("*").alias("subs_count"), F.sum("d").alias("subs_duration"), *pairs)
