import base64
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scribemill.functions import arrays as A
from scribemill.functions import speech as S


def labelling(alignment, blank=0):
    return tuple(k for k, _ in itertools.groupby(alignment) if k != blank)


def test_ctc_words(spark):
    vocabulary = ["_", "|", "a", "b"]
    one = lambda best: [[5.0 if k == b else float(-k) for k in range(4)] for b in best]
    cases = {
        (2, 2, 0, 2, 1, 1, 3, 3): [("aa", 0, 4), ("b", 6, 8)],
        (0, 0): [],
        (1, 2, 3, 1, 0): [("ab", 1, 3)],
        (3,): [("b", 0, 1)],
        (): [],
    }
    rows = [(k, one(b)) for k, b in enumerate(cases)] + [(8, None), (9, [[1.0, 2.0], [1.0]])]
    df = spark.createDataFrame(rows, "k int, x array<array<float>>")
    got = {r["k"]: r["w"] for r in df.select("k", S.ctc_words(F.col("x"), vocabulary).alias("w")).collect()}
    assert [[tuple(w) for w in got[k]] for k in range(len(cases))] == list(cases.values()) and got[8] is None and got[9] is None
    times = df.where("k = 0").select(A.word_times(S.ctc_words(F.col("x"), vocabulary), 0.02).alias("t")).first()["t"]
    assert [tuple(x) for x in times] == [("aa", 0.0, 0.08), ("b", 0.12, 0.16)]


def test_ctc_search(spark):
    """Against the sum over all alignments, and with few prefixes never above it."""
    r = np.random.default_rng(4)
    cases = [r.normal(size=(n, 3)) * 2 for n in (1, 2, 3, 5, 6)]
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(cases)] + [(9, None)], "k int, x array<array<double>>")
    got = {x["k"]: x for x in df.select("k", S.ctc_search(F.col("x"), width=10**6).alias("best"), S.ctc_search(F.col("x"), width=1).alias("narrow")).collect()}
    for k, x in enumerate(cases):
        p = np.exp(x) / np.exp(x).sum(axis=1, keepdims=True)
        sums = {}
        for alignment in itertools.product(range(3), repeat=len(x)):
            own = labelling(alignment)
            sums[own] = sums.get(own, 0) + math.prod(p[i, a] for i, a in enumerate(alignment))
        best = max(sums, key=sums.get)
        assert tuple(got[k]["best"]["labels"]) == best and got[k]["best"]["log_prob"] == pytest.approx(math.log(sums[best]))
        narrow = got[k]["narrow"]
        assert narrow["log_prob"] <= math.log(sums[tuple(narrow["labels"])]) + 1e-9
    assert got[9]["best"] is None


def test_mel_features(spark):
    length, rate = 16_000, 16_000
    t = np.arange(length) / rate
    tone = np.sin(2 * np.pi * 1000 * t)
    out = S.log_mel(tone, length)
    assert out.shape == (80, 100)
    # the loudest band is that of the tone, in every frame that it fills
    centres = S.hertz(np.linspace(0, S.mel(8000), 82))[1:-1]
    assert set(np.argmin(np.abs(centres - 1000)) - out[:, 2:-2].argmax(axis=0)) <= {-1, 0, 1}
    # against a plain discrete Fourier transform of one frame
    frame = tone[1600 - 200 : 1600 + 200] * (0.5 - 0.5 * np.cos(2 * np.pi * np.arange(400) / 400))
    dft = np.array([abs(sum(frame * np.exp(-2j * np.pi * k * np.arange(400) / 400))) ** 2 for k in range(201)])
    energy = np.log10(np.maximum(S.mel_bank(16_000, 400, 80) @ dft, 1e-10))
    kept = energy > out.max() * 4 - 4 - 8
    assert np.allclose(out[kept, 10] * 4 - 4, energy[kept])
    # ten times the samples: two more in the log of the energy, so half of one here
    assert np.allclose(S.log_mel(tone * 10, length), out + 0.5)
    # triangles between neighbours, each of the same area; mels there and back
    assert np.allclose(S.hertz(S.mel([0, 440, 1000, 7000])), [0, 440, 1000, 7000])
    bank = S.mel_bank(16_000, 4000, 20)
    assert np.allclose(bank.sum(axis=1) * 4, 1, atol=0.05) and (bank >= 0).all()
    rows = [(tone[:5000].tolist(),), ([],), (None,), ((tone * 2).tolist() * 2,)]
    got = [x["m"] for x in spark.createDataFrame(rows, "x array<float>").select(S.mel_features(F.col("x"), length).alias("m")).collect()]
    assert [x and (len(x["features"]), len(x["features"][0]), sum(x["attention_mask"]), x["input_length"]) for x in got] == [(80, 100, 32, 5000), (80, 100, 0, 0), None, (80, 100, 100, 32_000)]
    assert np.allclose(got[0]["features"], S.log_mel(np.float32(tone[:5000]), length), atol=1e-6) and set(np.ravel(got[1]["features"])) == {-1.5}


RANKS = {bytes([b]): b for b in range(256)} | {x: 256 + k for k, x in enumerate([b"he", b"ll", b"llo", b" w", b"or", b"hello", b" wor", b"ld", b"\xc3\xa5", b"aa", b"aaaa"])}


def plain_merge(piece):
    parts = [bytes([b]) for b in piece]
    while True:
        found = [(RANKS[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in RANKS]
        if not found:
            return [RANKS[x] for x in parts]
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_token_ids(spark, tmp_path):
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(k) + b" %d\n" % v for k, v in RANKS.items()))
    texts = ["hello world", "aaaaaaa å  hello's 123\n", "", None, "hello " * 300]
    for t in texts:
        assert S.merged((t or "").encode(), RANKS) == plain_merge((t or "").encode())
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    back = {v: k for k, v in RANKS.items()}

    def run(*a, **o):
        return {r["k"]: r["i"] for r in df.select("k", S.token_ids(F.col("t"), str(path), *a, **o).alias("i")).collect()}

    plain = run()
    assert plain[3] is None and plain[2] == [] and plain[0] == [RANKS[b"hello"], *plain_merge(b" world")]
    some, again, other, all_ = run(0.3, 1), run(0.3, 1), run(0.3, F.col("k") + 7), run(1.0)
    assert some == again and some[4] != other[4] and plain[4] != some[4]
    for ids in (plain, some, other, all_):
        assert all(b"".join(back[i] for i in ids[k]) == (texts[k] or "").encode() for k in (0, 1, 2, 4))
    assert all_[0] == list(b"hello world")
    # of 1,500 merges of one kind in a text about three in ten are left out
    assert 0.27 < np.mean([S.dropped(1, p, 300, 0.3) for p in range(4000)]) < 0.33
    long = b"a" * 30_001 + b"hello" * 9
    assert S.merged(long, RANKS)[:3] == [RANKS[b"aaaa"]] * 3 and len(S.merged(long, RANKS)) == 7500 + 1 + 9
    r = random.Random(6)
    for _ in range(300):
        piece = bytes(r.choice(b"aelhow ") for _ in range(r.randint(0, 30)))
        assert S.merged(piece, RANKS) == plain_merge(piece)


def test_labels(spark):
    df = spark.createDataFrame([("a b", "<a> b"), (None, "")], "text string, text_timestamps string")
    encode = lambda c: F.transform(F.filter(F.split(c, ""), lambda x: x != ""), lambda x: F.ascii(x))
    got = [tuple(r) for r in S.with_labels(df, encode, [1, 2], 3, 9).drop("text", "text_timestamps").collect()]
    assert got == [([1, 2, 3, 97, 32, 98, 9], [1, 2, 60, 97, 62, 32, 98, 9], 7, 8), ([1, 2, 3, 9], [1, 2, 9], 4, 3)]
    cut = [tuple(r) for r in S.with_labels(df, encode, [1, 2], 3, 9, most=5).select("labels", "labels_timestamps_length").collect()]
    assert cut == [([1, 2, 3, 97, 9], 5), ([1, 2, 3, 9], 3)]


def test_merges_of_many_pieces():
    """Pieces merged together have the ids that each has by itself, whatever their lengths, places and seeds."""
    r = random.Random(8)
    pieces = [bytes(r.choice(b"aelhow \xc3") for _ in range(r.choice([1, 2, 5, 9, 30, 48, 49, 70]))) for _ in range(400)]
    lengths, data = np.array([len(x) for x in pieces]), np.frombuffer(b"".join(pieces), np.uint8)
    places, seeds = np.array([r.randrange(10**6) for _ in pieces]), np.array([r.randrange(-(2**63), 2**63) for _ in pieces])
    for rate in (0.0, 0.05, 0.5, 1.0):
        ids, counts = S.merged_many(data, lengths, places, seeds, RANKS, S.joins(RANKS), rate)
        want = [S.merged(x, RANKS, rate, int(s), int(p)) for x, p, s in zip(pieces, places, seeds, strict=True)]
        assert counts.tolist() == [len(x) for x in want] and ids.tolist() == [x for own in want for x in own]
    none = np.zeros(0, np.int64)
    assert [len(x) for x in S.merged_many(data[:0], none, none, none, RANKS, S.joins(RANKS), 0.1)] == [0, 0]


def test_left_out_merges_of_rows(spark, tmp_path):
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(k) + b" %d\n" % v for k, v in RANKS.items()))
    texts = ["hello world aaaa", None, "", "å hello's 123\n" * 9, "hello " * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").coalesce(1)
    got = {r["k"]: r["i"] for r in df.select("k", S.token_ids(F.col("t"), str(path), 0.2, F.when(F.col("k") != 4, F.col("k") - 3)).alias("i")).collect()}
    cut = S.encoder(str(path), S.PIECES)[1]
    for k, t in enumerate(texts):
        if t is None:
            assert got[k] is None
            continue
        want, place = [], 0
        for piece in map(str.encode, cut.findall(t)):
            want += S.merged(piece, RANKS, 0.2, k - 3 if k != 4 else 0, place)
            place += len(piece)
        assert got[k] == want
