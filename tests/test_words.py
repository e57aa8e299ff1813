import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scribemill.functions import edits as E
from scribemill.functions import metrics as M
from scribemill.functions import text as T
from scribemill.plans import queries as Q
from tests.test_functions import plain_bleu
from tests.test_plans import folder, plain_pairs  # noqa: F401

WHITE = "\t\n\x0b\x0c\r \x85\xa0        　"
#: no white space, though some of them are close to it or are to Python
OTHERS = "\x1c\x1f᠎​‐⁠Â一\U0001f600aé"


def mixed_texts(n: int = 300):
    r = random.Random(3)
    return [None, "", " ", *("".join(r.choice(r.choice([WHITE, OTHERS, "ab "])) for _ in range(r.randint(0, 20))) for _ in range(n))]


def test_words_of_texts():
    texts = mixed_texts()
    white = re.compile(f"[{WHITE}]+")
    want = [[w for w in white.split(t or "") if w] for t in texts]
    for cut, kind in ((slice(None), pa.string()), (slice(7, 200), pa.large_string()), (slice(0, 0), pa.string()), (slice(0, 3), pa.string())):
        words, of = E.words_of(pa.array(texts, kind)[cut])
        words = words.to_pylist()
        assert [words[a:b] for a, b in zip(of, of[1:], strict=False)] == want[cut] and len(words) == sum(map(len, want[cut]))


def test_matches_are_those_of_numbered_ngrams(monkeypatch):
    """Whether the numbers of an n-gram go into one or not."""
    r = random.Random(1)
    texts = [[" ".join(r.choice("abcde") for _ in range(r.randint(0, 30))) for _ in range(50)] for _ in "xy"]
    a, of_a, b, of_b, _ = E.coded_words(*map(pa.array, texts))
    want = E.matched_ngrams(a, of_a, b, of_b)
    for most in (1, 3000, 40_000):
        monkeypatch.setattr(E, "MOST", most)
        assert np.array_equal(E.matched_ngrams(a, of_a, b, of_b), want)


def test_normalised_white_space(spark):
    rows = spark.createDataFrame(list(enumerate(mixed_texts())), "k int, t string")
    got = {r["k"]: r["x"] for r in rows.select("k", T.normalize_text(F.col("t")).alias("x")).collect()}
    want = {r["k"]: r["x"] for r in rows.select("k", T.strip(T.collapse(T.spoken(T.expand_abbreviations(F.lower("t"))))).alias("x")).collect()}
    assert got == want and got[0] is None


def test_first_and_last_words(spark):
    rows = spark.createDataFrame([(1, "ett två", " ett tre "), (2, " ", "a"), (3, None, "a"), (4, "häst", "hast")], "k int, a string, b string")
    a, b = F.col("a"), F.col("b")
    got = [tuple(r) for r in rows.orderBy("k").select(M.first_ratio(a, b), M.last_ratio(a, b), M.first_word(b), M.last_word(b)).collect()]
    assert got == [(100.0, pytest.approx(100 / 3), "ett", "tre"), (None, None, "a", "a"), (None, None, "a", "a"), (75.0, 75.0, "hast", "hast")]


def plan(rows) -> str:
    return rows._jdf.queryExecution().optimizedPlan().toString()


def test_texts_are_cut_once(spark, folder):  # noqa: F811
    """No pattern runs over a text once for each of its uses, and no list of words goes to Python."""
    assert Q.bleu_scores(spark, folder).count() == len(list(plain_pairs()))
    for query, most in ((Q.bleu_scores, 0), (Q.chunk_scores, 0), (Q.stages_of_texts, 2)):
        assert plan(query(spark, folder)).count("(?U)") <= most, query.__name__


def test_recall_and_precision_share_a_count(spark):
    rows = spark.createDataFrame([("a b c d e", "a b x d e f"), ("a", None), ("", "a")], "a string, b string")
    a, b = F.col("a"), F.col("b")
    both = rows.select(M.bleu(a, b, M.RECALL_WEIGHTS).alias("p"), M.rouge(a, b).alias("r"))
    first, *rest = [tuple(r) for r in both.collect()]
    assert first == pytest.approx((plain_bleu("a b c d e", "a b x d e f", M.RECALL_WEIGHTS), plain_bleu("a b x d e f", "a b c d e", M.RECALL_WEIGHTS)))
    assert rest == [(None, None), (0.0, 0.0)] and both._jdf.queryExecution().executedPlan().toString().count("matches_of_words(") == 1


def test_scripts_of_many_pairs():
    """Scripts of pairs halved together are shortest, the same as each by itself, and a long pair among short ones is
    done by its diagonals at once."""
    r = random.Random(6)
    rows = [[r.randrange(k) for _ in range(r.randint(0, 30))] for k in (2, 3, 9) for _ in range(40)] + [[], []]
    other = [[x if r.random() < 0.8 else r.randrange(9) for x in row if r.random() < 0.9] for row in rows]
    rows.append([r.randrange(300) for _ in range(6000)])
    other.append([301 if i % 7 == 6 else x for i, x in enumerate(rows[-1])])
    of = [np.concatenate([[0], np.cumsum([len(x) for x in side])]) for side in (rows, other)]
    flat = [np.array([x for row in side for x in row], np.int64) for side in (rows, other)]
    pair, kind, at_a, at_b, length = E.edit_scripts(flat[0], of[0], flat[1], of[1])
    for k in [*range(0, len(rows), 7), len(rows) - 2]:
        own = pair == k
        got = [("=-+"[x], *p) for x, *p in zip(kind[own].tolist(), (at_a[own] - of[0][k]).tolist(), (at_b[own] - of[1][k]).tolist(), length[own].tolist(), strict=True)]
        assert got == E.edit_script(rows[k], other[k])
    changes = np.bincount(pair, length * (kind != E.SAME), len(rows))
    assert changes.tolist() == [len(x) + len(y) - 2 * E.common_length(x, y) for x, y in zip(rows, other, strict=True)]


def test_marked_words(spark):
    rows = spark.createDataFrame([(1, "a <b> c", "a x c d"), (2, "", "q q"), (3, None, "a"), (4, " a  b", "b")], "k int, a string, b string")
    got = [r[0] for r in rows.orderBy("k").select(T.difference_html(F.col("a"), F.col("b"))).collect()]
    assert got == ["a <del>&lt;b&gt;</del> <ins>x</ins> c <ins>d</ins>", "<ins>q</ins> <ins>q</ins>", None, "<del>a</del> b"]
