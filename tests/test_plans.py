import random
import re

import pytest
from pyspark.sql import functions as F

from scribemill.functions import arrays as A
from scribemill.functions import metrics as M
from scribemill.operators import quality
from scribemill.plans import queries as Q
from scribemill.plans import views as V
from tests.test_functions import edits, plain_bleu
from tests.test_operators import plain_live


def long_documents(n: int = 12):
    """Documents of 30 lines and more, with lines of up to 60 words."""
    r = random.Random(5)
    words = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 5))) for _ in range(40)]
    lines = lambda: [" ".join(r.choice(words) for _ in range(r.randint(0, 60))) for _ in range(r.randint(30, 60))]
    return [(i, "\n".join(lines()), r.choice(["en", "de"]), f"src{i % 3}") for i in range(n)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(long_documents(), "doc_id long, text string, lang string, source string").write.parquet(f"{d}/documents.parquet")
    return d


def plain_pairs():
    for doc_id, text, _, source in long_documents():
        for idx, line in enumerate(text.split("\n")):
            w = [x for x in re.sub("[^ -~]", "", line).split(" ") if x]
            a = [x for i, x in enumerate(w) if (i + 1) % 5]
            b = [x if (i + 1) % 7 else "x" for i, x in enumerate(w)]
            yield (doc_id << 32) + idx, source, w, a, b


def test_pairs_are_of_all_lines_and_words(spark, folder):
    want = {k: (source, " ".join(w), " ".join(a), " ".join(b)) for k, source, w, a, b in plain_pairs()}
    got = V.pairs(spark, folder).collect()
    assert len(got) == len(want) and {r["pair_id"]: (r["source"], r["ref"], r["hyp_a"], r["hyp_b"]) for r in got} == want


def test_scores_of_whole_lines(spark, folder):
    pairs = {k: x for k, *x in plain_pairs()}
    wer = {k: edits(w, b) / len(w) for k, (_, w, _, b) in pairs.items() if w}
    got = Q.wer_pairs(spark, folder).collect()
    assert {r["pair_id"]: r["wer_b"] for r in got} == pytest.approx(wer)
    assert {r["pair_id"]: r["wer_a"] for r in got} == pytest.approx({k: edits(w, a) / len(w) for k, (_, w, a, _) in pairs.items() if w})
    cer = {r["pair_id"]: r["cer"] for r in Q.cer_head_tail(spark, folder).where("cer is not null").limit(60).collect()}
    assert len(cer) == 60 and cer == pytest.approx({k: edits(" ".join(w), " ".join(a)) / len(" ".join(w)) for k, (_, w, a, _) in pairs.items() if k in cer})
    bleu = {k: plain_bleu(" ".join(w), " ".join(b)) for k, (_, w, _, b) in pairs.items()}
    assert {r["pair_id"]: r["bleu"] for r in Q.bleu_scores(spark, folder).collect()} == pytest.approx(bleu, abs=2e-6)
    by_source = {s: [wer[k] for k, x in pairs.items() if x[0] == s and k in wer] for s in ("src0", "src1", "src2")}
    got = {r["source"]: (r["n"], r["wer"]) for r in Q.macro_wer(spark, folder).collect()}
    assert got == {s: (len(x), pytest.approx(sum(x) / len(x))) for s, x in by_source.items()}
    assert Q.fuzzy_first_last(spark, folder).count() == Q.ndiff_html(spark, folder).count() == len(pairs)


def test_live_mark_of_all_lines(spark, folder):
    want = {}
    for doc_id, text, *_ in long_documents():
        rows = [(idx * 10 + k, " ".join(line.split(" ")[:k])) for idx, line in enumerate(text.split("\n")) for k in range(1, 2 + idx % 4)]
        want |= {(doc_id, i): (t, live) for (i, t), live in zip(rows, plain_live([t for _, t in rows]), strict=True)}
    got = Q.live_mark(spark, folder).collect()
    assert len(got) == len(want) and {(r["file_id"], r["idx"]): (r["text"], r["live"]) for r in got} == want


def test_bucket_relative_times_of_all_lines(spark, folder):
    want = {}
    for doc_id, text, *_ in long_documents():
        at, buckets = 0, {}
        for idx, line in enumerate(text.split("\n")):
            long = 600 + 20 * (len(line) % 400)
            buckets.setdefault(at // 30_000, []).append((idx, at, at + long, line))
            at += long + idx % 3 * 400
        for rows in buckets.values():
            first, joined = rows[0][1], " ".join(x[3] for x in rows)
            want |= {(doc_id, i): (a - first, b - first, rows[-1][2] - first, joined) for i, a, b, _ in rows}
    got = Q.bucket_relative_times(spark, folder).collect()
    assert len(got) == len(want) and {(r["file_id"], r["idx"]): tuple(r)[2:] for r in got} == want


def test_scores_of_texts(spark):
    rows = spark.createDataFrame([(1, "", "", "a wav2vec2"), (2, "", "", "whisper"), (3, "a b", "", "wav2vec2"), (4, "", "a", "wav2vec2"), (5, "a b c d", "a x c d", "Wav2Vec2")], "k int, a string, b string, m string")
    got = rows.select("k", quality.chunk_scores(F.col("a"), F.col("b"), F.col("m")).alias("s")).select("k", "s.*").orderBy("k").collect()
    assert [tuple(r)[1:] for r in got[:4]] == [(0.0, 0.0, 0.0, 0.0, k == 1) for k in range(1, 5)]
    assert tuple(got[4])[1:] == (pytest.approx(plain_bleu("a b c d", "a x c d")), 0.25, 100.0, 100.0, False)
    rows = spark.createDataFrame([("Ett, två tre FYRA fem!", "ett två tre fyra fem", "ett två tre fyr"), (" ", "a", "")], "text string, whisper_transcription string, wav2vec_transcription string")
    r, s = quality.with_metrics(rows).collect()
    a, b = "ett två tre fyra fem", "ett två tre fyr"
    assert r["text_normalized"] == r["whisper_transcription_normalized"] == a and not r["is_silence"] and s["is_silence"]
    assert (r["w_wer"], r["w_head"], r["w_tail"], r["w_first"], r["w_last"]) == (0, 0, 0, 100, 100) and r["v_wer"] == 0.4
    assert r["v_bleu"] == pytest.approx(plain_bleu(a, b, M.RECALL_WEIGHTS)) and r["v_rouge"] == pytest.approx(plain_bleu(b, a, M.RECALL_WEIGHTS))
    assert r["v_tail"] == edits(a[-10:], b[-10:]) / 10


def test_stages_of_texts_are_of_scores(spark, folder):
    got = Q.stages_of_texts(spark, folder).limit(40).collect()
    assert len(got) == 40 and any(r["stage1"] for r in got)
    assert all(r["stage1"] == (r["w_bleu"] >= 0.2) for r in got if abs(r["w_bleu"] - 0.2) > 1e-5 and r["w_wer"] is not None)
    assert Q.chunk_scores(spark, folder).count() == Q.stages_of_texts(spark, folder).count() == len(list(plain_pairs()))


def test_small_predicates(spark):
    rows = spark.createDataFrame([("a \\Komma b", 225), ("\\Punkt", 226), ("Komma", 0), (None, 1)], "t string, n long")
    assert [tuple(r) for r in rows.select(quality.without_spoken_marks(F.col("t")), quality.large_enough(F.col("n"))).collect()] == [(False, False), (False, True), (True, False), (True, False)]
    c = F.col("x")
    rows = spark.createDataFrame([(["<|sv|>", "<|haw|>", "<|translate|>", "a/Whisper-x", "wav2vec2-whisper", "big-wav2vec2", "whisper-2"],)], "x array<string>")
    got = rows.select(A.token_languages(F.slice(c, 1, 3)), A.model_of_kind(c, "wav2vec2"), A.model_of_kind(c, "whisper"), A.model_of_kind(F.slice(c, 1, 3), "whisper")).first()
    assert tuple(got) == (["sv", "haw"], "big-wav2vec2", "whisper-2", None)
    got = spark.createDataFrame([("en",), ("sv",), ("su",), ("xx",)], "x string").select(A.language_id(c)).collect()
    assert [r[0] for r in got] == [50259, A.LANGUAGE_IDS["sv"], 50357, None] and len(A.LANGUAGE_IDS) == 99


def test_small_jobs_take_every_row(spark, folder):
    r = random.Random(2)
    vectors = {k: [r.random() for _ in range(64)] for k in range(50)}
    spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<float>").write.mode("overwrite").parquet(f"{folder}/embeddings.parquet")
    spark.createDataFrame([(k, "") for k in [*range(24), 30]], "page_id long, html string").write.mode("overwrite").parquet(f"{folder}/pages.parquet")
    got = {r["vec_id"]: (r["n"], r["total"]) for r in Q.audio_slice(spark, folder).collect()}
    assert got == {k: (max(k % 40 - 2, 0), pytest.approx(sum(v[2 : k % 40]), abs=1e-5)) for k, v in vectors.items()}
    got = {r["vec_id"]: (r["n"], r["total"]) for r in Q.pad_batch(spark, folder).collect()}
    assert got == {k: (100, pytest.approx(sum(v), abs=1e-5)) for k, v in vectors.items()}
    got = {r["base"]: r["audio_path"] for r in Q.extension_priority(spark, folder).collect()}
    assert len(got) == 7 and got["7"] is None and got["1"] == "1.webm"
    assert Q.model_hook_stub(spark, folder).count() == len(list(plain_pairs()))


def test_the_whole_projection(spark, folder):
    """Cleaned texts, scores of normalised texts and stages of every chunk row."""
    rows = Q.prepared_scored(spark, folder).collect()
    own = Q.chunk_rows(spark, folder).collect()
    assert len(rows) == len(own) and {(r["file_id"], r["number"]) for r in rows} == {(r["file_id"], r["number"]) for r in own}
    lines = {(doc_id, i): x for doc_id, text, *_ in long_documents() for i, x in enumerate(text.split("\n"))}
    for r in rows:
        said = " ".join(lines[r["file_id"], r["number"]].split()) if r["number"] % 6 else ""
        assert r["is_silence"] == (said == "" and r["number"] % 4 == 1) and r["n_words"] == len(said.split())
        if said:
            heard = f"w {lines[r['file_id'], r['number']]}"
            assert r["text_normalized"] == said == r["text"] and r["w_bleu"] == pytest.approx(plain_bleu(said, heard, M.RECALL_WEIGHTS), abs=2e-6)
            assert r["w_wer"] == pytest.approx(1 / len(said.split()), abs=2e-6) and r["stage1"] == (r["w_bleu"] >= 0.2)
    assert {r["stage2"] for r in rows} >= {True, False} and any(r["is_silence"] and r["text"] == "<|nospeech|>" for r in rows)
