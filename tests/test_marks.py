import random
from collections import Counter

from pyspark.sql import functions as F

from scribemill.operators import sequence
from scribemill.plans import queries as Q
from tests.test_operators import plain_duplicates


def test_texts_do_not_move_with_their_marks(spark, monkeypatch):
    """Rows meet the first places of their texts by digest, also those of a null file and a null text."""
    met, own = [], sequence.with_first_places

    def recorded(subs, *rest):
        met.append(subs.columns)
        return own(subs, *rest)

    monkeypatch.setattr(sequence, "with_first_places", recorded)
    rows = [(None, i, t) for i, t in enumerate("abcdx")] + [(1, i, t) for i, t in enumerate("abcdy")] + [(2, i, t) for i, t in enumerate([None, "a", None, "b", "c", "d"])]
    df = spark.createDataFrame(rows, "file_id long, idx int, text string")
    got = {(r["file_id"], r["idx"]): r["duplicate"] for r in sequence.mark_duplicates(df, offset=False).collect()}
    # a null file comes first; runs of four rows met before, and a null is a text
    assert got == {(f, i): f == 1 and i < 4 or f == 2 and i > 0 for f, i, _ in rows}
    assert all("text" not in columns for columns in met) and len(met) == 1
    both = sequence.mark_duplicates(df.withColumn("more", F.lit(1)), scope="file")
    assert both.columns == ["file_id", "idx", "text", "more", "duplicate"] and both.where("duplicate").count() == 0 and both.count() == len(rows)


def moved(plan):
    """Types of what each exchange of a plan moves."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return moved(plan.initialPlan())
    own = [[plan.output().apply(i).dataType().simpleString() for i in range(plan.output().size())]] if plan.nodeName() == "Exchange" else []
    return own + [x for i in range(plan.children().size()) for x in moved(plan.children().apply(i))]


def test_digests_move_instead_of_texts(spark, monkeypatch, tmp_path):
    """Of documents, also with null ids, ids of two documents and lines that stand for silence, the marks are those of plain
    Python; texts are in one exchange only, and texts that one row alone has meet no other."""
    r, kept, own = random.Random(4), {}, sequence.stored
    pool = [f"line {k} {'x' * k}" for k in range(25)] + ["", sequence.SILENCE]
    text = lambda i: "\n".join(f"own {i} {k}" if r.random() < 0.1 else r.choice(pool) for k in range(r.randint(1, 60)))
    docs = [(None if i < 2 else i // 2 if i < 8 else i, text(i), "en", "s") for i in range(30)] + [(99, None, "en", "s"), (98, "", "en", "s")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")

    def recorded(df, name):
        kept[name] = (moved(df._jdf.queryExecution().executedPlan()), own(df, name))
        return kept[name][1]

    monkeypatch.setattr(sequence, "stored", recorded)
    marked = Q._marked(spark, str(tmp_path))
    assert kept["places"][0] and not any("string" in x for x in kept["places"][0])
    assert sum("string" in x for x in moved(marked._jdf.queryExecution().executedPlan())) == 1
    first = kept["first-places"][1]
    rows = sorted(marked.collect(), key=lambda x: (x["file_id"] is not None, x["file_id"] or 0, x["idx"]))
    often = {t for t, n in Counter(x["text"] for x in rows).items() if n > 1}
    assert first.count() == len(often) and first.where("n < 2").count() == 0
    files = {}
    for x in rows:
        files.setdefault(x["file_id"], []).append(x)
    assert all([x["idx"] for x in f] == list(range(len(f))) for f in files.values())
    assert [x["duplicate"] for x in rows] == plain_duplicates([[x["text"] for x in f] for f in files.values()])
    assert 0 < sum(x["duplicate"] for x in rows) < len(rows)


def test_fused_rows_keep_their_order(spark):
    """Not renumbered, rows have the idx of a run's first row; of times, those of its ends, whatever stands between."""
    rows = [(1, 3, 5, 9, "a"), (1, 4, 0, 99, "a"), (1, 7, 9, 12, "a"), (1, 8, 12, 13, None), (1, 9, 13, 14, None), (1, 11, 14, 14, "b"), (None, 2, 0, 4, "a")]
    df = spark.createDataFrame(rows, "file_id long, idx int, start long, end long, text string")
    assert set(map(tuple, sequence.fuse(df, renumbered=False).collect())) == {(1, 3, 5, 12, "a"), (1, 8, 12, 14, None), (None, 2, 0, 4, "a")}
    assert set(map(tuple, sequence.fuse(df).collect())) == {(1, 0, 5, 12, "a"), (1, 1, 12, 14, None), (None, 0, 0, 4, "a")}
