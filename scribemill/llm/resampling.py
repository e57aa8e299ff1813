"""Importance resampling towards a target distribution over hashed runs of words.

A document is scanned once. A ring holds the running CRC-32 states of the last n word starts; a word extends each state
by a space and itself and opens a state of its own, so the states after it are the checksums of all runs that end in it,
and no run is ever put together as a string. What the scan emits, a bucket for each run, stands in a table of the
shared folder; counts and weights both come from there.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scribemill.llm._arrays import ALNUM, LOWER, texts, tidy
from scribemill.llm._shared import written

#: of every byte: A-Z lower-cased, what is in no word as a space
FOLDED = bytes(np.where(ALNUM, LOWER, 32).astype(np.uint8))
#: bytes of a text that are split into words at a time
PIECE = 1 << 20
#: bytes of buckets that a row of the table holds at most, of further ones a row each
ROW_BYTES = 4 << 20

EMITTED = "doc_id long, row long, n_words long, buckets binary"


def pieces(text: bytes, size: int = PIECE):
    """Lists of consecutive words, lower-cased, of about `size` bytes of the text each."""
    at = 0
    while at < len(text):
        end = at + size
        part = text[at:end].translate(FOLDED)
        if end < len(text):
            # the word at the cut, and all of it if it is longer than a piece
            while not part.endswith(b" ") and end < len(text):
                more = text[end : end + 4096].translate(FOLDED)
                gap = more.find(b" ")
                part, end = (part + more, end + len(more)) if gap < 0 else (part + more[: gap + 1], end + gap + 1)
        yield part.split()
        at = end


def scan(words, runs: int, ring: list[int]) -> list[int]:
    """The checksums of all runs of 1 to `runs` words that end in one of the words. ring: states of the last starts, kept
    up to date from call to call."""
    crc, out = zlib.crc32, []
    keep = runs - 1
    for word in words:
        step = b" " + word
        ring[:] = [crc(step, state) for state in ring]
        ring.append(crc(word))
        out += ring
        if len(ring) > keep:
            del ring[0]
    return out


def emitted(docs: DataFrame, runs: int = 2, buckets: int = 10_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, n_words, buckets) in the shared folder: little-endian uint16 buckets, uint32 where there are more
    than 65,536. A document of very many words has several rows of one `row` number, which is its own."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def run(batches):
        from pyspark import TaskContext

        row, held, size = (TaskContext.get().partitionId() << 40) - 1, [], 0

        def out():
            nonlocal held, size
            ids, rows, n, found = zip(*held, strict=True)
            held, size = [], 0
            return pa.record_batch([pa.array(ids, pa.int64()), pa.array(rows, pa.int64()), pa.array(n, pa.int64()), pa.array(found, pa.binary())], names=["doc_id", "row", "n_words", "buckets"])

        for batch in batches:
            data, offsets = texts(batch.column(1))
            for k, doc_id in enumerate(batch.column(0).to_pylist()):
                row, ring, n, parts, kept = row + 1, [], 0, [], 0
                for words in pieces(data[offsets[k] : offsets[k + 1]].tobytes()):
                    if kept > ROW_BYTES:
                        held.append((doc_id, row, n, b"".join(parts)))
                        size, n, parts, kept = size + kept, 0, [], 0
                        yield out()
                    found = (np.array(scan(words, runs, ring), np.int64) % buckets).astype(kind).tobytes()
                    parts.append(found)
                    n, kept = n + len(words), kept + len(found)
                held.append((doc_id, row, n, b"".join(parts)))
                size += kept + 32
                if size > ROW_BYTES:
                    yield out()
        if held:
            yield out()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return written(rows.mapInArrow(tidy(run), EMITTED), "runs-of-words")


def bucket_counts(table: DataFrame, buckets: int = 10_000) -> np.ndarray:
    """Runs in each bucket. A task sends one row for each bucket it has, and the driver gets as many rows as buckets."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for x in batch.column(0):
                total += np.bincount(np.frombuffer(x.as_buffer(), kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in table.select("buckets").mapInArrow(tidy(count), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of each of B buckets, in doubles."""
    n = float(len(source))
    s_all, t_all = float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def gumbel(doc_id: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln u)), u from the sha256 of seed and id (null: no id)."""
    h = F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000.0 * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resampled(docs: DataFrame, target: DataFrame, runs: int = 2, buckets: int = 10_000, least_words: int = 20, percent: int = 25, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_features, weight, score, rank (null: not drawn).

    Features are the runs of 1 to `runs` words, repeats counted. A weight is the floored mean of its features' gains; a
    score adds Gumbel noise to it, so that the highest scores are a draw without replacement by exp(weight / 1000). Of the
    documents with at least `least_words` words, `percent` in 100 are drawn, rounded down; ties go to the smaller id,
    null last, and rows that share score and id are numbered in any order. Null texts have no words and weight 0. An
    empty table gives no row; an empty target makes all gains depend on the documents alone.

    Ranks come from counts of equal scores, which are at most some 120,000 numbers: gains lie within +-1000 ln of the number of
    runs, noise between -3,130 and 22,900. Documents meet only others of their score, by the noise at most 1 in
    2,700 of all; a score that more rows have (repeated ids) is numbered by a sort of its rows.
    """
    spark = docs.sparkSession
    table = emitted(docs, runs, buckets, id_col, text_col)
    gain = gains(bucket_counts(table, buckets), bucket_counts(emitted(target.select(F.lit(0).alias("doc_id"), F.col(target_text).alias("text")), runs, buckets), buckets))
    known = spark.sparkContext.broadcast(gain)
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def weigh(batches):
        for batch in batches:
            sums, sizes = [], []
            for x in batch.column("buckets"):
                at = np.frombuffer(x.as_buffer(), kind)
                sums.append(int(known.value[at].sum()))
                sizes.append(len(at))
            yield pa.record_batch([batch.column("doc_id"), batch.column("row"), batch.column("n_words"), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64())], names=["doc_id", "row", "n_words", "n_features", "gain"])

    parts = table.mapInArrow(tidy(weigh), "doc_id long, row long, n_words long, n_features long, gain long")
    rows = parts.groupBy("doc_id", "row").agg(*(F.sum(c).alias(c) for c in ("n_words", "n_features", "gain")))
    weight = F.when(F.col("n_features") > 0, F.expr("(gain - pmod(gain, n_features)) div n_features")).otherwise(0)
    rows = rows.withColumn("weight", weight.cast("long"))
    rows = written(rows.select("doc_id", "n_words", "n_features", "weight", (F.col("weight") + gumbel(F.col("doc_id"), seed)).alias("score")), "scores")
    asked = F.col("n_words") >= least_words
    per = rows.where(asked).groupBy("score").agg(F.count("*").alias("n"))
    down = Window.orderBy(F.col("score").desc())
    per = per.select(F.col("score").alias("__score"), (F.sum("n").over(down) - F.col("n")).alias("before"), F.floor(F.sum("n").over(Window.partitionBy()) * F.lit(percent) / 100).alias("drawn"))
    place = F.row_number().over(Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last()))
    ranked = rows.where(asked).withColumn("place", place).join(F.broadcast(per), F.col("score") == F.col("__score"))
    rank = F.col("before") + F.col("place")
    ranked = ranked.select(*rows.columns, F.when(rank <= F.col("drawn"), rank).cast("long").alias("rank"))
    return ranked.unionByName(rows.where(~asked).withColumn("rank", F.lit(None).cast("long")))


def op11_resampling(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document."""
    out = resampled(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


OP11_SQL = r"""
with recursive d as (select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
f as (select rid, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as g from d),
h as (select unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as g from b),
g as materialized (select g, hex(encode(g)) as x from (select g from f union select g from h)),
c(g, x, pos, crc) as (select g, x, 1, 4294967295::bigint from g
    union all
    select g, x, pos + 2, list_reduce([xor(crc, ('0x' || x[pos:pos + 1])::bigint)] || range(8), lambda v, i: case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end) from c where pos < len(x)),
k as (select g, xor(crc, 4294967295) % 10000 as bucket from c where pos > len(x)),
s as (select bucket, count(*) as n from f join k using (g) group by bucket),
t as (select bucket, count(*) as n from h join k using (g) group by bucket),
gain as (select bucket, cast(floor(1000 * ln((coalesce(t.n, 0) + 1.0::double) * ((select coalesce(sum(n), 0) from s) + 10000.0::double) / ((coalesce(s.n, 0) + 1.0::double) * ((select coalesce(sum(n), 0) from t) + 10000.0::double)))) as bigint) as gain
    from range(10000) r(bucket) left join s using (bucket) left join t using (bucket)),
w as (select rid, count(*) as n, cast(sum(gain) as bigint) as total from f join k using (g) join gain using (bucket) group by rid),
z as (select d.rid, doc_id, len(w) as n_words, coalesce(n, 0) as n_features, coalesce((total - (((total % n) + n) % n)) // n, 0) as weight,
    cast('0x' || substr(sha256('7:' || coalesce(cast(doc_id as varchar), '')), 1, 8) as bigint) as h from d left join w using (rid)),
y as (select *, cast(weight + floor(-1000.0::double * ln(-ln((h + 0.5::double) / 4294967296.0::double))) as bigint) as score from z),
r as (select rid, row_number() over (order by score desc, doc_id) as rank, count(*) over () as n from y where n_words >= 20)
select doc_id, cast(n_features as bigint) as n_features, cast(weight as bigint) as weight, score, case when rank <= 25 * n // 100 then rank end as rank from y left join r using (rid)
"""
