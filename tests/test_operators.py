import random
import uuid

import pytest
from pyspark.sql import functions as F

from scribemill.functions import names as N
from scribemill.operators import documents as D
from scribemill.operators import models, quality, sequence, splits, stats

SUBS = "file_id long, idx int, start long, end long, text string"


def frame(spark, rows, schema=SUBS):
    return spark.createDataFrame(rows, schema)


def subs(spark, *items, file=1):
    return frame(spark, [(file, i, *x) for i, x in enumerate(items)])


def texts(spark, *files):
    return frame(spark, [(f, i, 0, 0, t) for f, ts in enumerate(files) for i, t in enumerate(ts)])


def column(df, name, order=("file_id", "idx")):
    return [r[name] for r in df.orderBy(*order).collect()]


def test_fuse(spark):
    got = sequence.fuse(subs(spark, (0, 1000, "A"), (1000, 2000, "A"), (2000, 3000, "B"), (3000, 3000, "C"), (3500, 4000, "A"))).orderBy("idx").collect()
    assert [tuple(r)[1:] for r in got] == [(0, 0, 2000, "A"), (1, 2000, 3000, "B"), (2, 3500, 4000, "A")]
    assert sequence.fuse(subs(spark, (0, 1, None), (1, 2, None))).count() == 1


def test_fill_silence(spark):
    rows = subs(spark, (500, 1000, "a"), (1000, 1500, "b"), (1400, 2000, "c"))
    got = [(r["start"], r["end"], r["duration"], r["is_silence"]) for r in sequence.fill_silence(rows).orderBy("idx").collect()]
    assert got == [(0, 500, 500, True), (500, 1000, 500, False), (1000, 1500, 500, False), (1500, 1400, -100, True), (1400, 2000, 600, False)]
    assert len(sequence.fill_silence(rows, lead_in=False).collect()) == 4


def plain_live(ts):
    """A sliding window of seven flags, three before and three after the row in the middle."""
    c = [i > 0 and t.startswith(ts[i - 1]) for i, t in enumerate(ts)]
    if len(ts) <= 6:
        return [False] * len(ts)
    m = [c[i] if i < 3 else c[i] or (i + 1 < len(c) and c[i + 1]) for i in range(len(c))]
    out = []
    for i in range(len(c)):
        if i < 3:
            before, own, after = sum(c[:3]), (c[3] if i == 0 else c[3] or c[4]), sum(c[4 : 4 + i])
        else:
            before, own, after = sum(m[i - 3 : i]), m[i], sum(c[i + 1 : i + 4])
        out.append(not (before == 3 and not own and after == 0) and before + own + after >= 3)
    return out


def test_mark_live(spark):
    r = random.Random(3)
    files = [["x", "x y", "x y z", "q", "q r", "q r s", "q r s t"], ["a"] * 6, ["a", "a b", "a b c", "a b c d", "z", "y", "w", "v"]]
    for _ in range(40):
        t, out = "", []
        for _ in range(r.randint(1, 25)):
            t = t + "w" if r.random() < 0.6 else r.choice("abc")
            out.append(t)
        files.append(out)
    got = sequence.mark_live(texts(spark, *files))
    assert column(got, "live") == [x for ts in files for x in plain_live(ts)]
    assert plain_live(files[0]) == [False] + [True] * 6 and plain_live(files[2]) == [True] * 4 + [False] * 4


def plain_duplicates(files, shared=True):
    seen, out = set(), []
    for ts in files:
        if not shared:
            seen = set()
        marks, run = [False] * len(ts), []
        flags = []
        for t in ts:
            flags.append(t in seen)
            seen.add(t)
        for i, f in enumerate([*flags, False]):
            if f and i < len(ts):
                run.append(i)
                continue
            if len(run) >= 4:
                for k in run:
                    marks[k - 1] = True  # the row before; from the first round to the last
                    if k >= len(ts) - 4:
                        marks[k] = True
            run = []
        out += marks
    return out


@pytest.mark.parametrize("scope", ["global", "file"])
def test_mark_duplicates(spark, scope):
    r = random.Random(5)
    files = [list("abababacdef"), list("ababacuvwzy"), ["a", "b", "a", "b", "u2", "v2", "w2", "z2", "y2"]]
    files += [[r.choice("abcdefgh") + str(r.choice([0, 0, 0, r.randint(1, 99)])) for _ in range(r.randint(1, 30))] for _ in range(30)]
    got = sequence.mark_duplicates(texts(spark, *files), scope=scope)
    assert column(got, "duplicate") == plain_duplicates(files, scope == "global")
    exact = column(sequence.mark_duplicates(texts(spark, list("ababababx")), offset=False), "duplicate")
    assert exact == [False, False, True, True, True, True, True, True, False]


def marked(spark, *items, **flags):
    df = frame(spark, [(1, 0, 0, 0, "first"), *[(1, i + 1, *x) for i, x in enumerate(items)], (1, 99, 0, 0, "last")])
    return df


def chunks(df, *args, **options):
    return [(r["start"], r["end"], r["text"], r["sub_ids"], r["text_timestamps"]) for r in sequence.pack_chunks(df, *args, **options).orderBy("chunk").collect()]


def test_pack_chunks(spark):
    s = sequence.SILENCE
    got = chunks(marked(spark, (1000, 13000, "A"), (13000, 15000, s), (15000, 27000, "B"), (27000, 35000, "C")))
    assert got == [(1000, 27000, "A B", [0, -1, 2], "<0.00>A<12.00><14.00>B<26.00>")]
    got = chunks(marked(spark, (1000, 3000, "A"), (3000, 32000, "B")))
    assert [(a, b, t) for a, b, t, *_ in got] == [(1000, 3000, "A"), (3000, 32000, "B")]
    got = chunks(marked(spark, (1000, 21000, "A"), (21000, 91000, s), (91000, 103000, "B")))
    assert [(a, b, t, i) for a, b, t, i, _ in got] == [(1000, 31000, "A", [0, -1]), (91000, 103000, "B", [2])]
    live = marked(spark, (0, 12000, "A"), (12000, 14000, "L"), (14000, 30000, "B")).withColumn("live", F.col("text") == "L")
    assert [t for _, _, t, *_ in chunks(live)] == ["A", "B"]
    got = chunks(marked(spark, (0, 12000, "A"), (12000, 14000, "x|y"), (14000, 30000, "Bing dong")), exclude=("|",), remove=(r"\w+ing ",), flush_marked=False)
    assert [t for _, _, t, *_ in got] == ["A", "dong"]
    alone = chunks(marked(spark, (0, 12000, "A"), (12000, 14000, s), (14000, 30000, "B")), surround=False)
    assert [t for _, _, t, *_ in alone] == ["A"]  # without silence around, a chunk takes one subtitle


def test_packed_chunks_part_the_subtitles(spark):
    r = random.Random(1)
    rows, t = [], 0
    for i in range(120):
        n = r.choice([500, 2000, 9000, 40_000])
        rows.append((1, i, t, t + n, sequence.SILENCE if r.random() < 0.3 else f"w{i}"))
        t += n
    got = sequence.pack_chunks(frame(spark, rows), 1, 30_000).orderBy("chunk").collect()
    ids = [abs(x) for c in got for x in c["sub_ids"]]
    assert ids == sorted(ids) and {k for c in got for k in c["sub_ids"] if k > 0} >= {i - 1 for i, x in enumerate(rows[1:-1], 1) if x[4] != sequence.SILENCE} - {0}
    assert all(c["duration"] <= 30_000 or len([x for x in c["sub_ids"]]) == 1 for c in got)
    many = sequence.pack_many(frame(spark, rows), [(1, 5000), (1, 30_000)])
    assert {r["most"] for r in many.collect()} == {5000, 30_000}


def test_folds(spark):
    got = sequence.bucket_spans(subs(spark, (0, 10000, ""), (10000, 29000, ""), (29000, 31000, ""), (31000, 58000, ""), (58000, 60000, "")))
    assert column(got, "bucket") == [0, 0, 1, 1, 2] and column(got, "since") == [10000, 29000, 2000, 29000, 2000]
    for values, want in (([60, 50, 30, 80, 10], [1, 1, 2, 2, 3]), ([60, 40, 5], [1, 1, 1])):
        df = frame(spark, [(1, i, v) for i, v in enumerate(values)], "k int, o int, d long")
        assert column(sequence.shard_by_duration(df, "k", "o", "d", 100), "shard", ("o",)) == want


def test_previous_text_and_fallback(spark):
    rows = frame(spark, [(1, 0, 0, 10, "a"), (1, 1, 10, 20, "<|nospeech|>"), (1, 2, 20, 30, "c"), (1, 3, 31, 40, "d"), (2, 0, 40, 50, "e"), (2, 1, 50, 60, "f")])
    assert column(sequence.previous_text(rows), "previous_text") == [None, "a", None, None, None, "e"]
    buckets = frame(spark, [(1, 0, "sv", 0.9), (1, 1, "no", 0.9), (1, 2, "no", 0.9), (1, 4, "sv", 0.4), (2, 0, "no", 0.9)], "file_id long, bucket int, language string, p double")
    assert sorted(r["bucket"] for r in sequence.language_fallback(buckets).collect()) == [0, 1]


def test_greedy_split_and_ratios(spark):
    sizes = [15, 10, 4, 12, 10, 949]
    groups = frame(spark, [(i, n) for i, n in enumerate(sizes)], "g int, n long")
    assert column(splits.greedy_group_split(groups, "g"), "split", ("g",)) == ["validation", "test", "test", "train", "test", "train"]
    counts = {r["split"]: r["count"] for r in splits.ratio_split(spark.range(25), "id").groupBy("split").count().collect()}
    assert counts == {"train": 20, "test": 2, "validation": 3}
    assert splits.greedy_group_split(groups.limit(0), "g").count() == 0


def test_share_of_short(spark):
    rows = spark.range(6001).withColumn("short", F.col("id") % 3 == 0)
    got = quality.share_of_short(rows, F.col("short"), 0.45, "id")
    assert got.where("short").count() == 900 and got.where("not short").count() == 4000 and got.columns == ["id", "short"]
    assert quality.share_of_short(rows.limit(5000), F.col("short"), 0.45, "id", least_rows=5000).count() == 5000
    again = quality.share_of_short(rows.repartition(7), F.col("short"), 0.45, "id")
    assert again.exceptAll(got).count() == 0


def test_stages(spark):
    row = {k: 0.0 for k in ("w_bleu", "v_bleu", "w_rouge", "v_rouge", "w_head", "w_tail", "v_head", "v_tail", "w_wer", "v_wer", "w_first", "w_last", "v_first", "v_last")}
    df = spark.createDataFrame([{**row, "as_run": False, "is_silence": False}, {**row, "as_run": True, "is_silence": True}, {**row, "w_bleu": 0.81, "v_bleu": 0.5, "w_rouge": 0.81, "w_first": 80.0, "w_last": 80.0, "v_first": 80.0, "v_last": 80.0, "as_run": False, "is_silence": False}])
    got = df.select(*(c.alias(k) for k, c in quality.scorer_stages().items())).collect()
    assert [tuple(r) for r in got] == [(False,) * 3 + (False,), (False,) * 4, (True, True, True, True)]
    assert df.select(quality.scorer_stages(strict_bleu=True)["stage1_wav2vec"]).collect()[2][0] is True
    got = df.select(*(c.alias(k) for k, c in quality.general_stages("isof").items())).collect()
    assert got[1]["stage1"] and got[1]["stage2"] and not got[0]["stage1"] and got[2]["stage2"]
    with pytest.raises(ValueError):
        quality.filter_dataset(df, "smdb", "stage2_svt")


def test_statistics(spark):
    rows = frame(spark, [(1, 10, True, False, False), (1, 20, True, True, False), (1, 30, False, True, True), (1, 40, False, False, True), (1, 50, False, False, False)], "file_id long, duration long, duplicate boolean, live boolean, is_silence boolean").withColumn("text", F.lit("a b"))
    r = stats.subtitle_stats(rows).first()
    assert (r["n_duplicate"], r["n_live"], r["n_silence"], r["duplicate_duration"], r["live_duration"], r["silence_duration"], r["n_words"]) == (2, 1, 1, 30, 30, 40, 2)
    weights = {r["d"]: r for r in stats.sampling_weights(frame(spark, [("nst", 1.0), ("x", 3.0)], "d string, h double"), "d", "h").collect()}
    assert weights["nst"]["share"] == 0.25 and weights["nst"]["weight"] == 0.4545 and weights["x"]["to_least"] == 1.2
    flags = stats.language_flags(F.col("ids"), F.col("named"))
    got = frame(spark, [([0, -1], [1]), ([1, 2], [1]), ([1], [1])], "ids array<int>, named array<int>").select(*(c.alias(k) for k, c in flags.items())).collect()
    assert [tuple(x) for x in got] == [(True, True), (False, True), (True, True)]
    shards = frame(spark, [("a", 1, 0, None, 2, None, 1.0, 0.0), ("b", 3, 1, 1, 2, 3, 2.0, 1.0)], "d string, n long, n_silence long, n_previous_text long, n_words long, n_tokens long, duration_hours double, duration_hours_silence double")
    total = stats.rolled_up(shards, "d").where("is_total = 1").first()
    assert (total["n"], total["n_previous_text"], total["mean_duration_s"], total["mean_silence_s"]) == (4, 1, 2700.0, 3600.0)


def test_model_hook(spark):
    df = spark.createDataFrame([(i, "x" * i) for i in range(40)], "id int, text string")
    got = models.with_model(df, "text", "size", "int", lambda: lambda xs: [len(x) for x in xs]).collect()
    assert all(r["size"] == r["id"] for r in got)
    with pytest.raises(Exception, match="another number"):
        models.with_model(df, "text", "size", "int", lambda: lambda xs: [1]).collect()


def test_folds_bear_ties_nulls_and_equal_rows(spark):
    rows = [(1, 0, 0, 10, "a"), (1, 0, 0, 10, "a"), (1, 1, None, None, None), (None, 0, 0, 40_000, "b"), (1, 2, 20_000, 31_000, "c")]
    subs = spark.createDataFrame(rows, "file_id long, idx int, start long, end long, text string")
    got = sorted(((r["file_id"], r["idx"], r["bucket"], r["since"], r["text"]) for r in sequence.bucket_spans(subs).collect()), key=str)
    assert got == sorted([(1, 0, 0, 10, "a"), (1, 0, 0, 10, "a"), (1, 1, 0, None, None), (1, 2, 1, 11_000, "c"), (None, 0, 1, 40_000, "b")], key=str)
    sharded = sequence.shard_by_duration(subs.withColumn("d", F.col("end") - F.col("start")), "file_id", "idx", "d", 15)
    assert sorted((r["file_id"] or 0, r["idx"], r["shard"]) for r in sharded.collect()) == [(0, 0, 1), (1, 0, 1), (1, 0, 1), (1, 1, 2), (1, 2, 2)]
    assert sequence.pack_chunks(subs, 1).count() == 1 and sequence.bucket_spans(subs.limit(0)).count() == 0


def test_packing_takes_all_subtitles_unless_told(spark):
    subs = spark.createDataFrame([(1, i, i * 1000, i * 1000 + 1000, f"t{i}") for i in range(60)], "file_id long, idx int, start long, end long, text string")
    chunks = lambda **o: sequence.pack_many(subs, [(1, 5000), (1, 30_000)], **o)
    ids = lambda df, most: sorted(i for r in df.where(F.col("most") == most).collect() for i in r["sub_ids"])
    assert ids(chunks(), 5000) == ids(chunks(), 30_000) == list(range(58))
    some = chunks(first={(1, 5000): 20})
    assert ids(some, 5000) == list(range(20)) and ids(some, 30_000) == list(range(58))


def test_row_numbers_and_interval_points(spark):
    rows = spark.createDataFrame([(k % 3, k * 7) for k in range(500)] + [(None, 1), (None, 2)], "k int, n long")
    got = sequence.row_numbers(rows, "k", "n", width=100).collect()
    for key in (0, 1, 2, None):
        own = sorted((r["n"], r["index"]) for r in got if r["k"] == key)
        assert [i for _, i in own] == list(range(len(own)))
    spans = spark.createDataFrame([(1, 0, 10), (2, 5, 25), (3, 30, 30), (4, None, 5)], "id int, start long, end long")
    points = spark.createDataFrame([(0,), (7,), (10,), (24,), (25,), (None,)], "at long")
    assert sorted((r["id"], r["at"]) for r in sequence.interval_points(spans, points, "at", 10).collect()) == [(1, 0), (1, 7), (2, 7), (2, 10), (2, 24)]


def test_documents_in_small(spark):
    score = lambda x: (x, None, 1.0, None)
    W, V = D.WHISPER, D.WAV2VEC
    chunks = [(0, 1000, "t", None, [1, -2], [("w", W, score(0.1)), ("v", V, score(0.2))], None, None), (1000, 2000, None, None, None, [], None, None), (0, 5, "x", "y", [3], [("v", V, score(0.3)), ("w2", W, None), ("w3", W, score(0.4))], (True, None, False, None, None), {"m": 1.0})]
    schema = "file_id long, metadata struct<channel:string,id:string,program_title:string,video_file:string,caption_file:string,data_source:string,is_asrun:boolean,production_year:string,program_classification:string>, subs array<struct<start:long,text:string>>, chunks array<struct<start:long,end:long,text:string,text_whisper:string,sub_ids:array<int>,transcription:array<struct<text:string,model:string,scores:struct<bleu:double,wer:double,first:double,last:double>>>,filters:struct<stage1_whisper:boolean,stage2_whisper:boolean,stage2_whisper_timestamps:boolean,stage1_wav2vec:boolean,silence:boolean>,language_probs:map<string,double>>>"
    docs = spark.createDataFrame([(1, ("x_asrun", *[None] * 8), [], chunks), (2, None, None, None)], schema)
    a, b = sorted(D.chunk_rows(docs).collect(), key=lambda r: r["number"])
    assert (a["sub_ids"], a["whisper_transcription"], a["wav2vec_transcription"], a["bleu_whisper"], a["bleu_wav2vec"], a["wer_wav2vec"], a["silence"]) == ("[1, -2]", "w", "v", 0.1, 0.2, None, False)
    # by place, the first is no whisper and the second no wav2vec; by name, the last of a model counts
    assert (b["whisper_transcription"], b["wav2vec_transcription"], b["bleu_whisper"], b["bleu_wav2vec"], b["stage1_whisper"]) == ("w3", "v", None, 0.0, True)
    r = sorted(D.stat_rows(docs).collect(), key=lambda r: r["number"])[1]
    assert (r["channel"], r["is_asrun"], r["id"], r["transcription_whisper"], r["transcription_wav2vec2"], r["duration_ms"]) == ("x_asrun", True, "Unknown ID", "v", "w2", 5)
    assert {x["file_id"]: (x["idx"], x["text"]) for x in D.sub_rows(docs).collect()} == {1: (None, None), 2: (None, None)}
    state = docs.select("file_id", *(c.alias(k) for k, c in D.transcription_state(F.col("chunks"), V).items()))
    assert {tuple(x) for x in state.collect()} == {(1, True, True, False), (2, False, False, False)}


def test_names_and_lists(spark):
    rows = spark.createDataFrame([("bar_om_1s.gloss", "[1, -2]"), ("abc_gloss", "[]"), (None, "")], "name string, sub_ids string")
    assert [r["name"] for r in D.without_excluded(rows, "name").collect()] == ["abc_gloss", None]
    assert [r["name"] for r in D.with_sub_ids(rows).collect()] == ["bar_om_1s.gloss"]
    one = rows.select(*(c.alias(k) for k, c in D.first_and_last(D.sub_id_list(F.col("sub_ids"))).items())).first()
    assert tuple(one) == (1, 2)
    pick = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    assert pick(N.broadcast_date(F.lit(2021), F.lit(2), F.lit(30))) is None and pick(N.clock_time(F.lit("0930001.1"))) == "09:30:00" and pick(N.clock_time(F.lit(93000))) == "09:30:00"
    assert pick(N.program_of_chunk(F.lit("cmore_a-2020-x_17-3.wav"))) == "cmore_a_2020_x_17" and pick(N.dialect_parts(F.lit("a_b"))["location"]) is None
    assert pick(N.snr_channel(F.lit("a" * 11 + "tv4" + "b" * 34))) == "tv4" and pick(N.prefixed("p/", F.lit("x"))) == "p/x"
    entries = pick(D.transcription_entries(F.array(F.lit("a"), F.lit(None), F.lit("b")), "m"))
    assert [tuple(x) for x in entries] == [("a", "m"), ("b", "m")]
    files = spark.createDataFrame([("/x/a.wav",), ("/x/b.wav",)], "audio_path string")
    assert D.with_audio(files, spark.createDataFrame([("/x/a.wav",)] * 2, "path string")).count() == 1


def test_a_model_is_loaded_once_a_process(spark):
    """Whatever processes the jobs meet, each has loaded the model of one name once; unnamed models are loaded anew."""
    rows = spark.createDataFrame([("a", "old"), (None, "old"), ("b", None)], "text string, out string").repartition(3)

    def factory():
        import os
        import uuid

        mark = f"{os.getpid()} {uuid.uuid4().hex}"
        return lambda xs: [mark for _ in xs]

    def marks(**options):
        return {r["out"] for _ in range(3) for r in models.with_model(rows, "text", "out", "string", factory, **options).collect()}

    named = marks(name=f"kept {uuid.uuid4()}")
    assert len(named) == len({x.split()[0] for x in named}) and rows.columns == ["text", "out"]
    assert len(marks()) >= 3
