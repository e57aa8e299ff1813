"""Subtitle-like views of the test tables, as DataFrames and as the DuckDB text that oracles start from.

Documents' lines stand for subtitles, with times made from whole numbers; pairs of a line's words and two versions of
it stand for a text and two transcriptions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scribemill.operators.documents import WAV2VEC, WHISPER
from scribemill.operators.sequence import digest


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt_out(rows: DataFrame, key: str, tasks: int = 3) -> DataFrame:
    """The rows by key over all cores, some tasks for each, for work that costs more than a shuffle. A table's splits do
    not tell: those without the start of a row group are empty."""
    return rows.repartition(max(tasks * rows.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions()), key)


def doc_lines(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """file_id, idx, text, source, lang; with `dealt` the documents are dealt out over all cores before."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    docs = dealt_out(docs, "doc_id") if dealt else docs
    return docs.select(F.col("doc_id").alias("file_id"), "source", "lang", F.posexplode(F.split("text", "\n")).alias("idx", "text"))


def timed(lines: DataFrame, digests: bool = False) -> DataFrame:
    """start and end in ms: 600 + 20 * (characters % 400) long, with gaps of 0, 400 or 800 after them. With `digests` the
    texts are left behind, and their SHA-256 stand for them. Of rows with one file_id and idx the order is fixed."""
    long, tie = 600 + 20 * (F.length("text") % 400), F.xxhash64("text")
    lines = lines.withColumns({"__long": long, "__tie": tie} | ({"text": digest(F.col("text"))} if digests else {}))
    w = Window.partitionBy("file_id").orderBy("idx", "__tie").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("__long") + (F.col("idx") % 3) * 400).over(w), F.lit(0)).cast("long")
    return lines.withColumn("start", start).withColumn("end", (F.col("start") + F.col("__long")).cast("long")).drop("__long", "__tie")


def subs(spark: SparkSession, sf_dir: str, digests: bool = False) -> DataFrame:
    """file_id, idx, start, end, text, source, lang."""
    return timed(doc_lines(spark, sf_dir), digests)


def rollup_subs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live captions: of every line, growing numbers of words."""
    lines = doc_lines(spark, sf_dir).withColumn("k", F.explode(F.sequence(F.lit(1), 1 + F.col("idx") % 4)))
    text = F.array_join(F.slice(F.split("text", " "), F.lit(1), F.col("k")), " ")
    return lines.select("file_id", (F.col("idx") * 10 + F.col("k")).alias("idx"), text.alias("text"))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pair_id (file_id and, in the low 32 bits, idx), ref, hyp_a (without every fifth word), hyp_b (every seventh word
    is x), of all words of all lines in ASCII."""
    ascii_ = F.regexp_replace("text", "[^ -~]", "")
    words = F.filter(F.split(ascii_, " "), lambda x: x != "")
    pair_id = F.shiftleft(F.col("file_id").cast("long"), 32) + F.col("idx")
    rows = doc_lines(spark, sf_dir, dealt=True).select(pair_id.alias("pair_id"), "file_id", "idx", "source", words.alias("w"))
    a = F.filter("w", lambda x, i: (i + 1) % 5 != 0)
    b = F.transform("w", lambda x, i: F.when((i + 1) % 7 == 0, F.lit("x")).otherwise(x))
    return rows.select("pair_id", "file_id", "idx", "source", *(F.array_join(x, " ").alias(n) for x, n in ((F.col("w"), "ref"), (a, "hyp_a"), (b, "hyp_b"))))


def documents(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """Documents as the pipeline's files have them: metadata, subs and chunks, a chunk for each line. By the line's number
    a chunk has no transcription, a whisper's, a whisper's and a wav2vec's, or these two the other way round."""
    docs = table(spark, sf_dir, "documents")
    docs = dealt_out(docs, "doc_id") if dealt else docs
    n = F.col("doc_id")
    channel = F.when(n % 3 == 1, "cmore_AsRun").when(n % 3 == 2, F.col("source"))
    metadata = F.struct(F.when(n % 2 == 0, F.concat(F.lit("id"), n.cast("string"))).alias("id"), channel.alias("channel"), F.col("source").alias("data_source"), F.when(n % 5 == 0, n % 2 == 0).alias("is_asrun"), F.lit(None).cast("string").alias("program_title"), F.col("lang").alias("video_file"), F.when(n % 7 > 0, F.lit("c.srt")).alias("caption_file"), F.lit("2020").alias("production_year"), F.lit(None).cast("string").alias("program_classification"))

    def scores(i, by):
        return F.struct(*((F.pmod(i * by + k, F.lit(11)) / 10).alias(s) for k, s in enumerate(("bleu", "wer", "first", "last"))))

    def chunk(t, i):
        entry = lambda m, x, by: F.struct(x.alias("text"), F.lit(m).alias("model"), scores(i, by).alias("scores"))
        w, v = entry(WHISPER, F.concat(F.lit("W "), t), 3), entry(WAV2VEC, F.concat(F.lit("v "), t), 7)
        kinds = F.when(i % 4 == 1, F.array(w)).when(i % 4 == 2, F.array(w, v)).when(i % 4 == 3, F.array(v, w)).otherwise(F.slice(F.array(w), 1, 0))
        filters = F.when(i % 3 > 0, F.struct(*((i % k == 0).alias(f) for k, f in enumerate(("stage1_whisper", "stage2_whisper", "stage2_whisper_timestamps", "stage1_wav2vec"), 2)), F.lit(None).cast("boolean").alias("silence")))
        end = i * 1000 + 600 + F.length(t) % 400
        return F.struct((i * 1000).cast("long").alias("start"), end.cast("long").alias("end"), F.when(i % 6 > 0, t).alias("text"), F.lit(None).cast("string").alias("text_whisper"), F.array(i, i + 1).alias("sub_ids"), kinds.alias("transcription"), filters.alias("filters"), F.when(i % 2 == 0, F.create_map(F.lit("m"), F.lit(1.0))).alias("language_probs"))

    lines = F.split("text", "\n")
    subs = F.transform(lines, lambda t, i: F.struct((i * 1000).cast("long").alias("start"), t.alias("text")))
    return docs.select(n.alias("file_id"), metadata.alias("metadata"), subs.alias("subs"), F.transform(lines, chunk).alias("chunks"))


def language_probs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and a map from six languages to thousandths, made from md5."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    p = lambda x: F.conv(F.substring(F.md5(F.concat(F.col("doc_id").cast("string"), F.lit(x))), 1, 4), 16, 10).cast("int") % 1000
    return docs.select("doc_id", "source", "n_chars", F.map_from_arrays(F.array(*map(F.lit, LANGUAGES)), F.array(*(p(x) / 1000.0 for x in LANGUAGES))).alias("probs"))


LANGUAGES = ["da", "de", "en", "fi", "no", "sv"]

LINES = """lines as (select doc_id as file_id, source, lang, cast(unnest(range(len(l))) as int) as idx, unnest(l) as text from (select *, string_split(text, chr(10)) as l from documents)),
subs as (select file_id, idx, source, lang, text, s as start, s + d as "end" from (select *, 600 + 20 * (length(text) % 400) as d, cast(coalesce(sum(600 + 20 * (length(text) % 400) + (idx % 3) * 400) over (partition by file_id order by idx rows between unbounded preceding and 1 preceding), 0) as bigint) as s from lines))"""

PAIRS = r"""pairs as (select file_id * 4294967296 + idx as pair_id, file_id, idx, source, array_to_string(w, ' ') as ref, array_to_string(list_filter(w, lambda x, i: i % 5 <> 0), ' ') as hyp_a, array_to_string(list_transform(w, lambda x, i: case when i % 7 = 0 then 'x' else x end), ' ') as hyp_b
from (select *, list_filter(string_split(regexp_replace(text, '[^ -~]', '', 'g'), ' '), lambda x: x <> '') as w from lines))"""

PROBS = "probs as (select doc_id, source, n_chars, [" + ", ".join(f"{{'l': '{x}', 'p': (('0x' || substr(md5(doc_id || '{x}'), 1, 4))::int % 1000) / 1000.0::double}}" for x in LANGUAGES) + "] as p from documents)"
