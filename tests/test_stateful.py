import datetime
import random

import pytest

from scribemill.operators import sequence
from scribemill.streaming import stateful

SCHEMA = "file_id string, idx int, start long, end long, text string, live boolean, arrived timestamp"


def files(seed=3):
    """Rows of a few files; by the batch that each arrives in, the last batch of another file alone, far later."""
    r = random.Random(seed)
    batches = [[] for _ in range(4)]
    for f in ("a", "b", "c"):
        at = 0
        for i in range(r.choice([2, 40, 90])):
            long = r.randint(100, 9000)
            text = sequence.SILENCE if r.random() < 0.25 else None if r.random() < 0.1 else f"{f} {i}"
            start = None if r.random() < 0.05 else at
            batches[min(2, i // (9 if f == "a" else 30))].append((f, i, start, at + long, text, r.random() < 0.1))
            at += long
    batches[3] = [("z", 0, 0, 5, "z", False)]
    day = datetime.datetime(2024, 1, 1)
    return [[(*x, day + datetime.timedelta(seconds=k if k < 3 else 10_000)) for x in rows] for k, rows in enumerate(batches)]


@pytest.mark.parametrize("fold", ["buckets", "chunks"])
def test_a_file_in_three_batches(spark, tmp_path, fold):
    batches = files()
    spark.createDataFrame(batches[0], SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    ranges = [(1, 5000), (1, 20_000), (15_000, 30_000)]
    if fold == "buckets":
        out = stateful.arriving_buckets(stream, 7000, idle_ms=60_000, late="1 second")
    else:
        out = stateful.arriving_chunks(stream, ranges, idle_ms=60_000, late="1 second", exclude=("7",))
    query = out.writeStream.format("memory").queryName(f"arrived_{fold}").outputMode("append").option("checkpointLocation", f"{tmp_path}/check").start()
    try:
        query.processAllAvailable()
        for rows in batches[1:]:
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            query.processAllAvailable()
        got = spark.table(f"arrived_{fold}").where("file_id <> 'z'").collect()
    finally:
        query.stop()
    whole = spark.createDataFrame([x for rows in batches[:3] for x in rows], SCHEMA).drop("arrived")
    if fold == "buckets":
        want = sequence.bucket_spans(whole, 7000).select("file_id", "idx", "start", "end", "text", "bucket", "since").collect()
    else:
        want = sequence.pack_many(whole, ranges, exclude=("7",)).collect()
        assert len({tuple(x[1:3]) for x in want}) == 3
    assert sorted(map(str, got)) == sorted(map(str, want)) and want
