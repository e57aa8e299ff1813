import random

import pytest
from pyspark.sql import functions as F

from scribemill.operators import sequence
from scribemill.operators.seen import SeenTexts

SUBS = "file_id int, idx int, text string, first string"


def plain_marks(files, lookback=4):
    """Runs of rows seen before, in file order."""
    seen, out = set(), {}
    for f, texts in sorted(files.items()):
        flags = []
        for t in texts:
            flags.append(t in seen)
            seen.add(t)
        i = 0
        while i < len(flags):
            k = i
            while k < len(flags) and flags[k] == flags[i]:
                k += 1
            for j in range(i, k):
                out[f, j] = flags[i] and k - i >= lookback
            i = k
    return out


def corpus(seed=2, hot=0.35):
    r = random.Random(seed)
    pool = [f"line {i}" for i in range(60)] + [None, ""]
    return {f: ["<|silence|>" if r.random() < hot else r.choice(pool) if r.random() < 0.7 else f"own {f} {i}" for i in range(r.randint(1, 60))] for f in range(24)}


def rows_of(files):
    return [(f, i, t, "clash") for f, texts in files.items() for i, t in enumerate(texts)]


@pytest.mark.parametrize("most", [sequence.FREQUENT_BYTES, 0])
def test_frequent_texts(spark, monkeypatch, most):
    """A text of a third of all rows, by a broadcast or, if the frequent ones are too long, by a join."""
    monkeypatch.setattr(sequence, "FREQUENT_BYTES", most)
    files = corpus()
    df = spark.createDataFrame(rows_of(files), SUBS).drop("first")
    got = {(x["file_id"], x["idx"]): x["duplicate"] for x in sequence.mark_duplicates(df, offset=False).collect()}
    assert got == plain_marks(files) and any(got.values()) and not all(got.values())
    own = {(x["file_id"], x["idx"]): x["duplicate"] for x in sequence.mark_duplicates(df, offset=False, scope="file").collect()}
    want = {}
    for f, texts in files.items():
        want |= plain_marks({f: texts})
    assert own == want


def test_a_frequent_text_is_spread(spark):
    """Rows of a frequent text are dealt out evenly."""
    rows = spark.range(40_000).select((F.col("id") / 100).cast("int").alias("file_id"), (F.col("id") % 100).cast("int").alias("idx"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("t"), F.col("id").cast("string"))).otherwise("hot").alias("text"))
    first = rows.groupBy("text").agg(F.min(F.struct("file_id", "idx")).alias("first"), F.count("*").alias("n"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    for k, v in zip(before, ("16", "false", "-1"), strict=True):
        spark.conf.set(k, v)
    try:
        sizes = [x["count"] for x in sequence.with_first_places(rows, first, ["text"]).groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 16 and max(sizes) < 2 * sorted(sizes)[8] and sum(sizes) == 40_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_two_runs_are_one(spark, tmp_path):
    files = corpus(5, 0.2)
    halves = [{f: x for f, x in files.items() if (f >= 11) == late} for late in (False, True)]
    tables = [spark.createDataFrame(rows_of(x), SUBS) for x in halves]
    mark = lambda df, **o: {(x["file_id"], x["idx"]): x["duplicate"] for x in sequence.mark_duplicates(df.drop("first"), offset=False, **o).collect()}
    seen = SeenTexts(spark, f"file://{tmp_path}/seen", "int", buckets=4)
    first = mark(tables[0], seen=seen, run="a")
    seen.add(tables[0], "a")
    both = first | mark(tables[1], seen=seen, run="b")
    assert both == plain_marks(files) == mark(spark.createDataFrame(rows_of(files), SUBS))
    seen.add(tables[1], "b")
    kept = sorted(map(str, seen.places().collect()))
    assert len(kept) == len({t for x in files.values() for t in x})
    # runs again under their names: the same marks, and nothing new
    assert mark(tables[0], seen=seen, run="a") | mark(tables[1], seen=seen, run="b") == both
    seen.add(tables[0], "a")
    seen.add(tables[1], "b")
    # another session that knows the path alone
    spark.sql(f"DROP TABLE {seen.name}")
    again = SeenTexts(spark, f"file://{tmp_path}/seen", "int", buckets=4)
    assert sorted(map(str, again.places().collect())) == kept
    # the table stays where it is: the run's own texts alone are dealt out
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        distinct = tables[1].groupBy("text").agg(F.min(F.struct("file_id", "idx")).alias("first"), F.count("*").alias("n"))
        plan = again.marked(distinct, "b")._jdf.queryExecution().executedPlan().toString()
        joined = plan[plan.index("SortMergeJoin") :]
        assert joined.count("Exchange hashpartitioning(__own") == 1 and "Exchange hashpartitioning(__digest" not in joined and "Exchange hashpartitioning(digest" not in joined
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    with pytest.raises(ValueError):
        sequence.mark_duplicates(tables[0].drop("first"), scope="file", seen=again)
