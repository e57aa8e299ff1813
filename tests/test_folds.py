import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scribemill.operators import folds, sequence


def plain_shards(lengths, limit):
    shard, total, out = 1, 0, []
    for x in lengths:
        out.append(shard)
        total += x or 0
        if total > limit:
            shard, total = shard + 1, 0
    return out


def plain_buckets(spans, limit):
    bucket, anchor, out = 0, None, []
    for start, end in spans:
        if start is None or end is None:
            out.append((bucket, None))
            continue
        anchor = start if anchor is None else anchor
        if end - anchor >= limit:
            bucket, anchor = bucket + 1, start
        out.append((bucket, end - anchor))
    return out


def test_next_at_least():
    r = np.random.default_rng(1)
    for n in (1, 2, 3, 7, 8, 9, 31, 200):
        marks = r.integers(-5, 30, n)
        after, bounds = r.integers(-1, n, 300), r.integers(-10, 40, 300)
        want = [next((j for j in range(a + 1, n) if marks[j] >= b), n) for a, b in zip(after, bounds, strict=True)]
        assert folds.next_at_least(marks, after, bounds).tolist() == want
        jumps = folds.next_at_least(marks, np.arange(n), marks + 3)
        for i, (to, hops) in enumerate(zip(*folds.last_places(jumps), strict=True)):
            k, m = i, 0
            while jumps[k] < n:
                k, m = jumps[k], m + 1
            assert (to, hops) == (k, m)


@pytest.fixture
def many_parts(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", before)


# limits far below a range, of about its length and far above it, and one that nothing passes
@pytest.mark.parametrize("limit", [0, 40, 600, 9000, 10**9])
def test_shards(many_parts, limit):
    spark, r = many_parts, random.Random(limit)
    # a key holds nearly all rows; nulls, zeros, a null key, keys of one row, a column to be replaced
    rows = [("hot" if r.random() < 0.9 else r.choice(["b", "c", None, str(i)]), i, r.choice([None, 0, 1, 5, 30, 200]), "x", 7) for i in range(3000)]
    got = sequence.shard_by_duration(spark.createDataFrame(rows, "k string, o long, d long, extra string, shard int").repartition(5), "k", "o", "d", limit)
    assert got.columns == ["k", "o", "d", "extra", "shard"]
    want = {}
    for key in {x[0] for x in rows}:
        own = [x for x in rows if x[0] == key]
        want |= {x[1]: s for x, s in zip(own, plain_shards([x[2] for x in own], limit), strict=True)}
    assert {x["o"]: x["shard"] for x in got.collect()} == want and got.count() == len(rows)
    assert sequence.shard_by_duration(spark.createDataFrame(rows, "k string, o long, d long, extra string, shard int").limit(0), "k", "o", "d").count() == 0


@pytest.mark.parametrize("limit,jitter,gaps", [(50, 0, 0), (3000, 0, 0.2), (700, 400, 0), (700, 5000, 0.3), (10**9, 0, 0.9)])
def test_buckets(many_parts, limit, jitter, gaps):
    spark, r = many_parts, random.Random(limit + jitter)
    rows, at = [], 0
    for i in range(2500):
        start = at + r.randint(-jitter, jitter)
        end = start + r.randint(0, 90)
        rows.append((1 if i < 2300 else i % 3, i, None if r.random() < gaps or i < 40 * (gaps > 0) else start, None if r.random() < gaps / 2 else end))
        at += r.randint(0, 60)
    got = sequence.bucket_spans(spark.createDataFrame(rows, "file_id int, idx int, start long, end long").repartition(4), limit).collect()
    want = {}
    for key in {x[0] for x in rows}:
        own = [x for x in rows if x[0] == key]
        want |= {x[1]: b for x, b in zip(own, plain_buckets([x[2:4] for x in own], limit), strict=True)}
    assert {x["idx"]: (x["bucket"], x["since"]) for x in got} == want and len(got) == len(rows)


def test_one_key_is_spread(spark):
    """With one key for all rows, no task holds a fiftieth of them."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "120")
    try:
        rows = spark.range(60_000).select(F.lit(1).alias("k"), F.col("id").alias("o"), (F.col("id") % 97).alias("d"))
        got = sequence.shard_by_duration(rows, "k", "o", "d", 5000)
        assert [x["shard"] for x in got.orderBy("o").collect()] == plain_shards([i % 97 for i in range(60_000)], 5000)
        table = next(x for x in got.inputFiles() if "/fold-" in x).rsplit("/", 1)[0]
        most = spark.read.parquet(table).groupBy("__range").count().agg(F.max("count")).first()[0]
        assert most < 60_000 / 50
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
