"""Statistics of files, shards and corpora."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scribemill.functions.text import word_count


def kind(duplicate: Column, live: Column, silence: Column) -> Column:
    """What a subtitle counts as: duplicate before live before silence."""
    return F.when(duplicate, "duplicate").when(live, "live").when(silence, "silence").otherwise("speech")


def subtitle_stats(subs: DataFrame, key: str = "file_id") -> DataFrame:
    """Of each file: subtitles and durations in all and by kind, words, mean duration."""
    named = {"duplicate": "duplicate", "live": "live", "silence": "is_silence"}
    flag = lambda x: F.coalesce(F.col(x), F.lit(False)) if x in subs.columns else F.lit(False)
    rows = subs.withColumns({"kind": kind(*(flag(x) for x in named.values())), "n_words": word_count(F.col("text"))})
    of = lambda k, x: F.sum(F.when(F.col("kind") == k, x).otherwise(0)).cast("long")
    by_kind = [x for k in named for x in (of(k, F.lit(1)).alias(f"n_{k}"), of(k, F.col("duration")).alias(f"{k}_duration"))]
    return rows.groupBy(key).agg(F.count("*").alias("n_subs"), F.sum("duration").alias("subs_duration"), of("speech", F.col("n_words")).alias("n_words"), F.avg("duration").alias("mean_duration"), *by_kind)


def corpus_stats(files: DataFrame) -> DataFrame:
    """Sums over files, and speech net of silence, live and duplicate subtitles."""
    names = [x for x in files.columns if x.startswith("n_") or x.endswith("_duration") and x != "mean_duration"]
    total = files.agg(F.count("*").alias("n_files"), *(F.sum(x).alias(x) for x in names))
    return total.withColumn("net_duration", F.expr("subs_duration - silence_duration - live_duration - duplicate_duration"))


def stage_table(rows: DataFrame, stages: list[str], duration: str = "duration", file: str = "file_id") -> DataFrame:
    """stage, value, count, duration, files of every stage in one pass."""
    long = rows.select(file, duration, F.explode(F.array(*(F.struct(F.lit(s).alias("stage"), F.col(s).alias("value")) for s in stages))).alias("x"))
    return long.groupBy("x.stage", "x.value").agg(F.count("*").alias("n"), F.sum(duration).alias("duration"), F.count_distinct(file).alias("n_files"))


def stage_as_run_table(rows: DataFrame, stages: list[str], duration: str = "duration", file: str = "file_id") -> DataFrame:
    """stage, value, count, hours, files, and of the rows those captioned as run and those not, in one pass. A null stage
    is false; a null file is not counted."""
    flag = lambda s: F.coalesce(F.col(s), F.lit(False))
    long = rows.select(file, duration, "is_asrun", F.explode(F.array(*(F.struct(F.lit(s).alias("stage"), flag(s).alias("value")) for s in stages))).alias("x"))
    counts = [F.count("*").alias("n"), (F.sum(duration) / 3_600_000).alias("hours"), F.count_distinct(file).alias("n_files"), F.count_if(F.col("is_asrun")).alias("n_asrun"), F.count_if(~F.col("is_asrun")).alias("n_not_asrun")]
    return long.groupBy("x.stage", "x.value").agg(*counts).orderBy(F.col("n").desc(), "stage", "value")


def folder_of(dataset: Column, file: Column) -> Column:
    """A shard's folder: datasets of two parts by the part that the file's name has, none if it has neither."""
    part = lambda *names: F.coalesce(*(F.when(F.contains(file, F.lit(n)), n) for n in names))
    return F.when(F.contains(dataset, F.lit("rixvox")), part("riksdagen_web", "riksdagen_old")).when(F.contains(dataset, F.lit("svt")), part("svt1", "svt2")).otherwise(dataset)


def folder_stats(shards: DataFrame) -> DataFrame:
    """Sums of shards (dataset, file, ...) by folder and over all."""
    return rolled_up(shards.withColumn("folder", folder_of(F.col("dataset"), F.col("file"))).where("folder is not null"), "folder")


def group_stage_counts(rows: DataFrame, group: str, stages: list[str]) -> DataFrame:
    """Chunks of each group in and out of every stage."""
    return rows.groupBy(group).agg(F.count("*").alias("n"), *(F.count_if(F.col(s)).alias(f"n_{s}") for s in stages), *(F.count_if(~F.col(s)).alias(f"n_not_{s}") for s in stages))


def shard_stats(rows: DataFrame, group: str) -> DataFrame:
    """n, n_silence, n_previous_text, n_words, n_tokens, hours of every shard. Columns that lack count as nothing."""
    has = lambda x: x in rows.columns
    count = lambda x: F.count_if(F.col(x)) if has(x) else F.lit(None).cast("long")
    total = lambda x: F.sum(x) if has(x) else F.lit(None).cast("long")
    hours = lambda x: F.sum(x) / 3_600_000
    silent = F.sum(F.when(F.col("is_silence"), F.col("duration")).otherwise(0)) / 3_600_000 if has("is_silence") else F.lit(None).cast("double")
    previous = F.count("previous_text") if has("previous_text") else F.lit(None).cast("long")
    return rows.groupBy(group).agg(F.count("*").alias("n"), count("is_silence").alias("n_silence"), previous.alias("n_previous_text"), total("n_words").alias("n_words"), total("n_tokens").alias("n_tokens"), hours("duration").alias("duration_hours"), silent.alias("duration_hours_silence"))


def rolled_up(shards: DataFrame, by: str) -> DataFrame:
    """Sums of shards by group and over all (group null), with means as ratios of the sums; a null counts as 0."""
    sums = ["n", "n_silence", "n_previous_text", "n_words", "n_tokens", "duration_hours", "duration_hours_silence"]
    out = shards.rollup(by).agg(*(F.sum(F.coalesce(F.col(x), F.lit(0))).alias(x) for x in sums), F.grouping(by).alias("is_total"))
    return out.withColumns({"mean_duration_s": F.try_divide(F.col("duration_hours") * 3600, F.col("n")), "mean_silence_s": F.try_divide(F.col("duration_hours_silence") * 3600, F.col("n_silence"))})


def sampling_weights(datasets: DataFrame, name: str, amount: str, factors: dict[str, float] | None = None) -> DataFrame:
    """Each dataset's share of an amount, re-weighted by factors and made to sum to 1, and over the least and the
    greatest share; all to four digits, half to even. One row a dataset."""
    whole = Window.partitionBy()
    factor = F.lit(1.0)
    for k, v in (factors or {"nst": 2.5}).items():
        factor = F.when(F.col(name) == k, v).otherwise(factor)
    share = F.col(amount) / F.sum(amount).over(whole)
    rows = datasets.select(name, amount, share.alias("share")).withColumn("scaled", F.col("share") * factor)
    rows = rows.withColumn("weight", F.col("scaled") / F.sum("scaled").over(whole))
    out = rows.withColumns({"to_least": F.col("weight") / F.min("weight").over(whole), "to_greatest": F.col("weight") / F.max("weight").over(whole)})
    return out.select(name, *(F.bround(x, 4).alias(x) for x in ("share", "weight", "to_least", "to_greatest")))


def language_totals(chunks: DataFrame, subs: DataFrame, lang: str = "sv", least_ms: int = 20_000) -> DataFrame:
    """Of each file: its subtitles, those that chunks in the language (longer than least_ms) name by id, each once, and
    their durations. chunks: file_id, language, duration, sub_ids; subs: file_id, idx, duration."""
    named = chunks.where((F.col("duration") > least_ms) & (F.col("language") == lang)).select("file_id", F.explode("sub_ids").alias("idx")).where("idx > 0").distinct()
    hit = named.join(subs.select("file_id", "idx", "duration"), ["file_id", "idx"]).groupBy("file_id").agg(F.count("*").alias("n_lang"), F.sum("duration").alias("lang_duration"))
    per = subs.groupBy("file_id").agg(F.count("*").alias("n_subs"), F.sum("duration").alias("duration"))
    out = per.join(hit, "file_id", "left").na.fill(0, ["n_lang", "lang_duration"])
    return out.withColumn("share", F.try_divide(F.col("lang_duration"), F.col("duration")))


def language_flags(sub_ids: Column, named: Column) -> dict[str, Column]:
    """all_/any_subs over a chunk's ids above 0; both hold where there are none."""
    own = F.filter(sub_ids, lambda i: i > 0)
    inside = lambda i: F.array_contains(named, i)
    return {"all_subs": F.forall(own, inside), "any_subs": F.forall(own, inside) | F.exists(own, inside)}
