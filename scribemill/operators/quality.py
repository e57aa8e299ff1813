"""Quality stages of chunks as boolean columns over scores."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scribemill.functions import metrics as M
from scribemill.functions import text as T

# Thresholds of the stages by dataset.
# stage1, bleu, rouge, head, tail, timestamp bleu, whisper head, whisper tail, wav2vec head, wav2vec tail
THRESHOLDS = {
    "default": (0.2, 0.8, 0.8, 0.2, 0.2, 0.6, 0.2, 0.2, 0.4, 0.4),
    "sls": (0.2, 0.8, 0.8, 0.2, 0.2, 0.6, 0.2, 0.2, 0.4, 0.4),
    "rixvox": (0.3, 0.7, 0.7, 0.2, 0.2, 0.6, 0.2, 0.2, 0.4, 0.4),
    "smdb": (0.2, 0.7, 0.7, 0.2, 0.2, 0.6, 0.2, 0.2, 0.4, 0.4),
    "youtube": (0.2, 0.7, 0.7, 0.2, 0.2, 0.6, 0.2, 0.2, 0.4, 0.4),
    "isof": (0.01, 0.01, 0.01, 1.0, 1.0, 0.6, 0.2, 0.2, 0.4, 0.4),
    "nst": (0.01, 0.01, 0.01, 1.0, 1.0, 0.6, 0.2, 0.2, 0.4, 0.4),
}
# Of short chunks up to so many seconds this share stays.
SUBSAMPLE = {"smdb": (10, 0.45), "youtube": (15, 0.3)}

c = F.col


def every(*conditions: Column) -> Column:
    return functools.reduce(lambda a, b: a & b, conditions)


def large_enough(size: Column, least: int = 225) -> Column:
    """Files of more bytes than a header has."""
    return size > least


def without_spoken_marks(text: Column) -> Column:
    """Not a dictation whose punctuation is spoken."""
    return ~F.coalesce(F.contains(text, F.lit("\\Komma")) | F.contains(text, F.lit("\\Punkt")), F.lit(False))


def is_silence(text: Column, transcription: Column) -> Column:
    return (T.strip(text) == "") & (transcription == "")


def chunk_scores(text: Column, transcription: Column, model: Column) -> Column:
    """bleu, wer, first, last and silence of normalised texts: four zeros if one is empty; silence if both are and the
    model is a wav2vec2."""
    words = (text != "") & (transcription != "")
    scores = {
        "bleu": M.bleu(text, transcription),
        "wer": M.wer(text, transcription),
        "first": M.first_ratio(text, transcription),
        "last": M.last_ratio(text, transcription),
    }
    silence = (text == "") & (transcription == "") & F.contains(F.lower(model), F.lit("wav2vec2"))
    return F.struct(*(F.when(words, x).otherwise(0.0).alias(k) for k, x in scores.items()), silence.alias("silence"))


def with_metrics(rows: DataFrame, text: str = "text", whisper: str = "whisper_transcription", wav2vec: str = "wav2vec_transcription", normalize=T.normalize_text) -> DataFrame:
    """Adds the three normalised texts and, for the stages, is_silence and seven scores (w_... and v_...) of each transcription."""
    rows = rows.withColumns({f"{x}_normalized": normalize(c(x)) for x in (text, whisper, wav2vec)})
    a, out = c(f"{text}_normalized"), {"is_silence": is_silence(c(text), c(wav2vec))}
    for m, x in (("w", whisper), ("v", wav2vec)):
        b = c(f"{x}_normalized")
        out |= {
            f"{m}_bleu": M.bleu(a, b, M.RECALL_WEIGHTS),
            f"{m}_rouge": M.rouge(a, b),
            f"{m}_wer": M.wer(a, b),
            f"{m}_first": M.first_ratio(a, b),
            f"{m}_last": M.last_ratio(a, b),
            f"{m}_head": M.edge_cer(a, b),
            f"{m}_tail": M.edge_cer(a, b, tail=True),
        }
    return rows.withColumns(out)


def scorer_stages(live_aware: bool = False, strict_bleu: bool = False) -> dict[str, Column]:
    """Stages of scored chunks: columns w_bleu, w_wer, w_first, w_last and v_... of two models, and as_run if
    live_aware (what was not captioned as run needs less in the first stage). The BLEU clause of the last stage
    counts only with strict_bleu."""
    least = F.when(c("as_run"), 0.4).otherwise(0.11) if live_aware else F.lit(0.4)
    stage2 = (c("w_bleu") > 0.8) & (c("w_wer") < 0.2)
    both = [c(f"{m}_{e}") >= 80 for m in "wv" for e in ("first", "last")] + [c("w_wer") < 0.2, c("v_wer") < 0.2]
    if strict_bleu:
        both += [(c("w_bleu") > 0.8) | (c("v_bleu") > 0.8)]
    return {
        "stage1_whisper": (c("v_bleu") > least) | (c("w_bleu") > least),
        "stage2_whisper": stage2,
        "stage2_whisper_timestamps": stage2 & (c("w_first") >= 80) & (c("w_last") >= 80),
        "stage1_wav2vec": every(*both),
    }


def within(head: float, tail: float, model: str = "w") -> Column:
    return (c(f"{model}_head") <= head) & (c(f"{model}_tail") <= tail)


def general_stages(dataset: str = "default", **changes: float) -> dict[str, Column]:
    """Stages by a dataset's thresholds: columns w_/v_ bleu, rouge, head, tail and is_silence. changes: other values
    for bleu, rouge, whisper_head, whisper_tail."""
    s1, b, r, h, t, tb, wh, wt, vh, vt = THRESHOLDS[dataset]
    b, r, wh, wt = (changes.get(k, x) for k, x in (("bleu", b), ("rouge", r), ("whisper_head", wh), ("whisper_tail", wt)))
    silence = c("is_silence")
    return {
        "stage1": (c("w_bleu") >= s1) | silence,
        "stage2": every(within(h, t), c("w_bleu") >= b, c("w_rouge") >= r) | silence,
        "stage_wav2vec2": every(within(h, t), within(h, t, "v"), c("w_bleu") >= b, c("v_bleu") >= b, c("w_rouge") >= r, c("v_rouge") >= r)
        | every(c("v_bleu") >= 0.85, c("v_rouge") >= 0.85, within(wh, wt)),
        "stage2_whisper_timestamps": every(within(wh, wt), within(vh, vt, "v"), c("w_bleu") >= tb) | silence,
    }


def svt_stages() -> dict[str, Column]:
    """Stages of broadcasts, which ask less of what was not captioned as run (as_run)."""
    run, silence = c("as_run"), c("is_silence")
    tight, loose = within(0.2, 0.2), within(0.2, 0.2) & within(0.2, 0.2, "v")
    split = lambda yes, no: (run & yes) | (~run & no)
    return {
        "stage1": split(c("w_bleu") >= 0.4, c("w_bleu") >= 0.15) | silence,
        "stage2": split(every(c("w_bleu") >= 0.9, c("w_rouge") >= 0.9, tight), every(c("w_bleu") >= 0.7, c("w_rouge") >= 0.7, tight)) | silence,
        "stage2_svt": split((c("w_bleu") >= 0.3) & within(0.3, 0.3), (c("w_bleu") >= 0.2) & within(0.4, 0.4)) | silence,
        "stage_wav2vec2": loose & split((c("w_bleu") >= 0.9) & (c("w_rouge") > 0.9), (c("w_bleu") >= 0.8) & (c("w_rouge") > 0.8)),
        "stage2_whisper_timestamps": tight & within(0.4, 0.4, "v") & split(c("w_bleu") >= 0.8, c("w_bleu") >= 0.6),
    }


def whole_files(chunks: DataFrame, ok: Column, key: str = "file_id") -> DataFrame:
    """Chunks of files whose every chunk is ok."""
    return chunks.withColumn("__ok", F.bool_and(ok).over(Window.partitionBy(key))).where("__ok").drop("__ok")


def share_of_short(rows: DataFrame, short: Column, share: float, key: str, least_rows: int = 0, seed: int = 42) -> DataFrame:
    """Of the short rows exactly the share (half to even), by the order of an md5 of the key; all others. Tables of no
    more than least_rows rows stay whole.

    Ranks come from counts of 4096 classes of the md5, so that only the class at the limit is put in order.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), c(key).cast("string")))
    rows = rows.withColumns({"__short": F.coalesce(short, F.lit(False)), "__h": digest, "__class": F.substring(digest, 1, 3)})
    by_class = rows.where("__short").groupBy("__class").agg(F.count("*").alias("__n"))
    w = Window.orderBy("__class")
    by_class = by_class.withColumns({"__before": F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, 0)) - c("__n"), "__most": F.bround(F.sum("__n").over(Window.partitionBy()) * share)}).drop("__n")
    total = rows.agg((F.count("*") > least_rows).alias("__cut"))
    out = rows.join(F.broadcast(by_class), "__class", "left").crossJoin(F.broadcast(total))
    edge = c("__short") & c("__cut") & (c("__before") < c("__most"))
    rank = Window.partitionBy("__class").orderBy("__h", key)
    kept = out.where(~(c("__short") & c("__cut")))
    ranked = out.where(edge).withColumn("__place", F.row_number().over(rank)).where(c("__before") + c("__place") <= c("__most")).drop("__place")
    return kept.unionByName(ranked).drop("__short", "__h", "__class", "__before", "__most", "__cut")


def filter_dataset(rows: DataFrame, dataset: str, stage: str, stages: dict[str, Column] | None = None, length: tuple[int, int] = (8000, 480_000), labels: int = 448, key: str = "row_id", least_rows: int = 0) -> DataFrame:
    """Rows of a stage: stage columns, subsampling of short chunks, input length, label lengths, then the stage itself.

    Tables of no more than least_rows rows are not subsampled. Columns: input_length, labels_length, labels_timestamps_length, duration (s) and those of the stages.
    """
    stages = stages or (svt_stages() if dataset == "svt" else general_stages(dataset))
    if stage not in stages:
        raise ValueError(f"{dataset} has no stage {stage}")
    out = rows.withColumns(stages)
    if dataset in SUBSAMPLE:
        seconds, share = SUBSAMPLE[dataset]
        out = share_of_short(out, (c("duration") <= seconds) & ~c("is_silence"), share, key, least_rows)
    return out.where(c("input_length").between(*length)).where((c("labels_length") <= labels) & (c("labels_timestamps_length") <= labels)).where(c(stage))
