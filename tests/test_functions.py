import collections
import math
import random
import re
import string
import time
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scribemill.functions import arrays as A
from scribemill.functions import edits as E
from scribemill.functions import metrics as M
from scribemill.functions import text as T

TEXTS = ["", "a", "the cat sat on the mat", "the cat the cat on a mat", "å-b ö", "x y z", "on the mat sat the cat today again", "kitten", "sitting"]


def values(spark, rows, schema, **columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns.values()).collect()]


def plain_bleu(r, h, w=(0.25,) * 4):
    r, h = r.split(), h.split()
    grams = lambda x, n: collections.Counter(tuple(x[i : i + n]) for i in range(len(x) - n + 1))
    match = [sum((grams(r, n) & grams(h, n)).values()) for n in range(1, 5)]
    if not match[0]:
        return 0.0
    k, logs = 0, 0.0
    for n in range(1, 5):
        top = match[n - 1]
        if top == 0:
            k += 1
            top = math.log(len(h)) / (2**k * 5) if len(h) > 1 else 0
        p = top / max(1, len(h) - n + 1)
        logs += w[n - 1] * math.log(p) if w[n - 1] and p > 0 else 0
    return math.exp(logs) * (1 if len(h) > len(r) else math.exp(1 - len(r) / len(h)))


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            old, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, old + (x != y))
    return row[-1]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = 0
        for j, y in enumerate(b, 1):
            old, row[j] = row[j], old + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def random_pairs(n=1500, seed=1):
    r = random.Random(seed)
    for _ in range(n):
        k = r.randint(1, 5)
        yield [r.randrange(k) for _ in range(r.randint(0, 12))], [r.randrange(k) for _ in range(r.randint(0, 12))]
    for n in (63, 64, 65, 130, 300):
        a = [r.randrange(20) for _ in range(n)]
        b = [x if r.random() < 0.9 else r.randrange(20) for x in a if r.random() < 0.8]
        yield from ((a, b), (b, a), (a, a), (a, []))


def test_edits():
    for a, b in random_pairs():
        common = lcs(a, b)
        assert E.edit_distance(a, b) == edits(a, b) and E.common_length(a, b) == common
        i, out, changes = 0, [], 0
        for kind, x, y, n in E.edit_script(a, b):
            assert x == i and y == len(out) and n > 0
            if kind == "=":
                assert a[x : x + n] == b[y : y + n]
            changes += n * (kind != "=")
            i += n * (kind != "+")
            out += [] if kind == "-" else b[y : y + n]
        assert i == len(a) and out == b and changes == len(a) + len(b) - 2 * common
    assert E.edit_distance("kitten", "sitting") == 3 and E.common_length("", "a") == 0


def test_edits_of_many_pairs():
    """Pairs of a group, moved together, have the edits that each has by itself, whatever the lengths and alphabet."""
    r = random.Random(3)
    for longest, letters in ((9, 3), (64, 4), (130, 400), (700, 30)):
        a = ["".join(chr(97 + r.randrange(letters)) for _ in range(r.randrange(longest))) for _ in range(300)]
        b = ["".join(x for x in t if r.random() < 0.8) if r.random() < 0.7 else t[::-1] for t in a]
        a[0] = None
        codes, of_a, of_b, distinct = E.coded_texts(pa.array(a, pa.string()), pa.array(b, pa.string()))
        assert E.distances(codes, of_a, of_b, distinct).tolist() == [E.edit_distance(x or "", y) for x, y in zip(a, b, strict=True)]
        assert E.common_lengths(codes, of_a, of_b).tolist() == [E.common_length(x or "", y) for x, y in zip(a, b, strict=True)]
    codes, of_a, of_b, distinct = E.coded_texts(*[pa.array(["x", "ab", "", None, "\u00e5\U0001f600"], pa.string())[1:]] * 2)
    assert E.distances(codes, of_a, of_b, distinct).tolist() == [0] * 4 and len(codes) == 8


def test_matched_ngrams():
    pairs = list(random_pairs(300, 2))
    as_lists = [pa.array([None if k == 7 else [str(x) for x in p[side]] for k, p in enumerate(pairs)], pa.list_(pa.string())) for side in (0, 1)]
    for cut in (slice(0, None), slice(5, 40)):
        a, of_a, b, of_b, _ = E.coded_lists(*(x[cut] for x in as_lists))
        grams = lambda x, n: collections.Counter(tuple(x[i : i + n]) for i in range(len(x) - n + 1))
        want = [[0 if k == 7 else sum((grams(x, n) & grams(y, n)).values()) for n in range(1, 5)] for k, (x, y) in list(enumerate(pairs))[cut]]
        assert E.matched_ngrams(a, of_a, b, of_b).tolist() == want
    assert E.matched_ngrams(*[np.zeros(k, np.int64) for k in (0, 3, 0, 3)]).tolist() == [[0] * 4] * 2


def test_word_differences(spark):
    a, b = F.col("a"), F.col("b")
    rows = [("a b c", "a x c"), ("a <b>", "a"), ("", "x y"), ("", ""), (None, "a"), ("a", None), ("same \u00a0 words", "same words")]
    got = values(spark, rows, "a string, b string", d=T.difference_html(a, b))
    assert [x[0] for x in got] == ["a <del>b</del> <ins>x</ins> c", "a <del>&lt;b&gt;</del>", "<ins>x</ins> <ins>y</ins>", "", None, None, "same words"]


def test_scores_of_long_texts(spark):
    """Texts of many words, whole, and the scores of one pair from one call."""
    r = random.Random(3)
    x = [str(r.randrange(9000)) for _ in range(4000)]
    y = [w if k % 7 else "x" for k, w in enumerate(x)]
    rows = [(" ".join(x), " ".join(y))]
    a, b = F.col("a"), F.col("b")
    wer, bleu, ratio = values(spark, rows, "a string, b string", w=M.wer(a, b), b=M.bleu(a, b), r=M.indel_ratio(F.left(a, F.lit(3000)), F.left(b, F.lit(3000))))[0]
    assert wer == sum(p != q for p, q in zip(x, y, strict=True)) / 4000 and bleu == pytest.approx(plain_bleu(*rows[0]))
    assert ratio == pytest.approx(200 * lcs(rows[0][0][:3000], rows[0][1][:3000]) / 6000)
    plan = spark.createDataFrame(rows, "a string, b string").select(M.bleu(a, b), M.bleu(a, b, M.RECALL_WEIGHTS), M.wer(a, b))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and set(re.findall(r"pythonUDF\d+", plan)) == {"pythonUDF0", "pythonUDF1"}


def test_scores_of_pairs(spark):
    pairs = [(a, b) for a in TEXTS for b in TEXTS]
    a, b = F.col("a"), F.col("b")
    got = values(spark, pairs, "a string, b string", bleu=M.bleu(a, b), long=M.bleu(a, b, M.RECALL_WEIGHTS), rouge=M.rouge(a, b), wer=M.wer(a, b), cer=M.cer(a, b), ratio=M.indel_ratio(a, b), head=M.edge_cer(a, b), tail=M.edge_cer(a, b, tail=True))
    for (x, y), (bleu, long, rouge, wer, cer, ratio, head, tail) in zip(pairs, got, strict=True):
        assert bleu == pytest.approx(plain_bleu(x, y)) and long == pytest.approx(plain_bleu(x, y, M.RECALL_WEIGHTS)) and rouge == pytest.approx(plain_bleu(y, x, M.RECALL_WEIGHTS))
        assert wer == (pytest.approx(edits(x.split(), y.split()) / len(x.split())) if x.split() else None)
        assert cer == (pytest.approx(edits(x, y) / len(x)) if x else None)
        assert ratio == pytest.approx(200 * lcs(x, y) / (len(x) + len(y)) if x + y else 100)
        for got_edge, (p, q) in ((head, (x[:10], y[:10])), (tail, (x[-10:], y[-10:]))):
            assert got_edge == pytest.approx(edits(p, q) / max(len(p), len(q)) if p + q else 0)
    assert values(spark, [("a b c d", "a x c"), (None, "a")], "a string, b string", wer=M.wer(a, b), bleu=M.bleu(a, b))[0][0] == 0.5
    assert values(spark, [(None, "a")], "a string, b string", bleu=M.bleu(a, b), r=M.indel_ratio(a, b)) == [(None, None)]


def test_numbers_in_words():
    want = {0: "noll", 7: "sju", 19: "nitton", 21: "tjugoett", 80: "åttio", 100: "etthundra", 123: "etthundratjugotre", 2000: "tvåtusen", 1_000_000: "en miljon", 2_500_000: "två miljoner femhundratusen"}
    assert {n: T.swedish_digits(str(n)) for n in want} == want
    more = {"0007": "sju", "000": "noll", "1000000000": "en miljard", "2000000001": "två miljarder ett", "1" + "0" * 18: "en miljard miljarder", "5" + "0" * 17 + "5": "fem miljarder miljarder fem"}
    assert {n: T.swedish_digits(n) for n in more} == more
    assert T.swedish_digits("3" + "0" * 4999) == "trettiotusen" + " miljarder" * 555


def test_normalisation(spark):
    c = F.col("t")
    rows = [("Bl.a. 21 ÄPPLEN, t.ex.  50%!",), ("ﬁn-fin /x/ ö–ö",), (None,), ("",)]
    got = values(spark, rows, "t string", a=T.normalize_text(c), b=T.normalize_text_svt(c))
    assert [x[0] for x in got] == ["bland annat tjugoett äpplen till exempel femtioprocent", "finfin x ö–ö", None, ""]
    assert got[1][1] == "fin fin ö ö" and got[2] == (None, None) and got[3] == ("", "")
    long = values(spark, [("9" * 5000,), ("a\u0663b",), ("x-y\n",)], "t string", a=T.normalize_text(c))
    assert long[0][0].count("miljarder") == 555 and [x[0] for x in long[1:]] == ["atreb", "xy"]
    bare = values(spark, [(string.punctuation + "a",)], "t string", a=T.delete_punctuation(c))
    assert bare == [("a",)]


def test_cleaning(spark):
    c = F.col("t")
    cases = {
        "- Hej (skratt) du [ljud] <i>där</i>": "Hej du där",
        "<|2.24|>- ja": "<|2.24|> ja",
        "ett *brus* två - -tre": "ett två tre",
        "...början": "början",
        "å- b -c d-e": "å b c d-e",
        "säger/viskar/ nej": "säger nej",
        None: None,
        "ﬁ": unicodedata.normalize("NFKC", "ﬁ"),
    }
    got = values(spark, [(x,) for x in cases], "t string", a=T.clean_text(c))
    assert [x[0] for x in got] == list(cases.values())
    cues = {"HUNDEN SKÄLLER Nu går vi": "Nu går vi", "HEJ DÄR Nu": "HEJ DÄR Nu", "MUSIK a APPLÅD b": "a b", "I MUSIK": ""}
    got = values(spark, [(x,) for x in cues], "t string", a=T.clean_text(c, cues=True))
    assert [x[0] for x in got] == list(cues.values())


def test_words_and_times(spark):
    c = F.col("t")
    got = values(spark, [("  a  b c\n",), ("",), (" ",), (None,)], "t string", n=T.word_count(c), s=T.strip(c))
    assert [x[0] for x in got][:3] == [3, 0, 0] and got[0][1].startswith("a") and got[2][1] == ""
    n = F.col("n")
    got = values(spark, [(1234,), (0,), (12000,), (1250,), (1230,)], "n long", a=T.seconds_token(n), b=A.floor20(n), c=A.nearest20_seconds(n), f=A.frames(n))
    assert [x[0] for x in got] == ["<1.22>", "<0.00>", "<12.00>", "<1.24>", "<1.22>"]
    assert [x[1] for x in got] == [1220, 0, 12000, 1240, 1220] and [x[2] for x in got] == [1.24, 0, 12, 1.24, 1.24]
    assert values(spark, [(1001,)], "n long", f=A.frames(n)) == [(16015,)]
    assert values(spark, [("01:02:03,045",)], "t string", m=A.srt_ms(c)) == [(3723045,)]
    assert values(spark, [(0.0025,), (0.0035,)], "n double", m=A.seconds_to_ms(n)) == [(2,), (4,)]


def test_languages_and_upserts(spark):
    p = F.col("p")
    got = values(spark, [({"en": 0.4, "de": 0.3, "fr": 0.2, "es": 0.05, "it": 0.03, "sv": 0.02},), ({"a": 0.5, "b": 0.5},)], "p map<string,double>", t=F.array_sort(F.map_keys(A.top_languages(p))), best=A.likeliest(p))
    assert got == [(["de", "en", "es", "fr", "it", "sv"], "en"), (["a", "b"], "a")]
    entry = F.struct(F.lit("m2").alias("model"), F.lit("new").alias("text"))
    rows = [([("m1", "x")],), ([("m2", "old")],)]
    e = F.col("e")
    got = values(spark, rows, "e array<struct<model:string,text:string>>", a=A.list_upsert(e, entry), m=A.list_upsert(e, entry, "model"), r=A.list_upsert(e, entry, "all"))
    assert [[tuple(x) for x in c] for c in got[0]] == [[("m1", "x"), ("m2", "new")], [("m1", "x")], [("m2", "new")]]
    assert [[tuple(x) for x in c] for c in got[1]] == [[("m2", "old")], [("m2", "new")], [("m2", "new")]]


def test_softmax_prompt_and_snr(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(3, 40)).astype(np.float32)
    rows = [(v.tolist(),) for v in x]
    c = F.col("x")
    got = values(spark, rows, "x array<double>", s=A.softmax(c), m=A.softmax(c, F.transform(c, lambda v, i: i < 5)), snr=A.snr_db(c))
    table = np.array(A.SNR_RATIOS)
    for v, (s, m, snr) in zip(x.astype(float), got, strict=True):
        assert np.allclose(s, np.exp(v) / np.exp(v).sum()) and np.allclose(m[:5], np.exp(v[:5]) / np.exp(v[:5]).sum()) and sum(m[5:]) == 0
        a = np.maximum(np.abs(v) / np.abs(v).max(), 1e-10)
        level = np.log(a.mean()) - np.log(a).mean()
        below = np.flatnonzero(table < level)
        k = below.max() if len(below) else None
        want = -20 if k is None else 100 if k == 120 else k - 20 + (level - table[k]) / (table[k + 1] - table[k])
        assert snr == pytest.approx(want)
    tokens = values(spark, [([str(i) for i in range(300)],), (["a"],)], "x array<string>", p=A.prompt(c, F.lit("s")))
    assert len(tokens[0][0]) == 192 and tokens[0][0][:2] == ["s", "109"] and tokens[1][0] == ["s", "a"]


def test_clean_text_of_a_long_line(spark):
    """Time in proportion to a line: the last rule tries it once, not from each of its places. It takes the last "... ..." of a line
    that has something before it."""
    rule = T.CLEANING[-1]
    texts = ["a... ... b", "... ...", "x... ... ... ...y", "... ... ... z", "a\n... ...\nb... ... c... ...d", "... ...... ..."]
    want = [re.sub(r"([^\n]+)\.\.\. \.\.\.", r"\1 ", t) for t in texts]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string").orderBy("k")
    assert [x[0] for x in rows.select(F.regexp_replace("t", *rule)).collect()] == want
    began = time.time()
    assert spark.range(1).select(F.length(T.clean_text(F.repeat(F.lit("ab. "), 100_000)))).first()[0] == 399_999
    assert time.time() - began < 20


def test_work_is_dealt_out(spark):
    """A table whose rows stand in one of many splits, too."""
    from scribemill.plans import views as V

    cores = spark.sparkContext.defaultParallelism
    rows = V.dealt_out(spark.range(1000).coalesce(1).union(spark.range(0).repartition(4 * cores).toDF("id")), "id")
    assert sum(x > 0 for x in rows.rdd.glom().map(len).collect()) >= 3 * cores
