"""Line dedup with a sharded minimal perfect hash over the distinct line hashes.

A line's hash is the 128-bit BLAKE2 digest of its key. Rows of a batch's distinct hashes are added up by Spark, which
gives each hash its documents and the largest id among them. The hashes that enough documents hold go into arrays: a
shard of the hash space maps its n hashes to 0 .. n - 1 by a minimal perfect hash and keeps, at those numbers, a 64-bit
fingerprint, the count and the largest id. Documents probe the arrays with all their lines, most of which are in no
array and must be refused by the fingerprint; a line is never joined with a line. Arrays of a checked size go to all
tasks; larger ones stay by shard, and documents' hashes go to them.
"""

from __future__ import annotations

import pickle
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scribemill.llm._arrays import LOWER, NOT_SPACE, mix, sliced, texts, tidy
from scribemill.llm._shared import BLOCK_BYTES, block_texts, blocks, rows_of, written

NO_ID = np.iinfo(np.int64).min
#: hashes of a shard
SHARD_KEYS = 500_000
#: arrays of more bytes than this stay by shard
BROADCAST_BYTES = 32 << 20
#: blocks whose hashes meet a shard's arrays together, for each shard there is
MEETING = 64


class MinimalPerfectHash:
    """Level by level, keys alone in their cell of a bit array are placed; the others go on to the next level.

    A key is a pair of 64-bit hashes. Its number is the count of set bits before its own, of which every 64-bit word
    knows those before it: some four bits a key. `find` of a key that was not built in gives some number or -1, so a
    fingerprint must be compared.
    """

    LOAD = 0.5

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.levels, done = [], 0
        while len(a):
            size = max(64, int(len(a) / self.LOAD) + 63 & ~63)
            cell = self.cell(a, b, len(self.levels), size)
            alone = np.bincount(cell, minlength=size) == 1
            bits = np.packbits(alone, bitorder="little").view("<u8")
            ones = np.bitwise_count(bits).astype(np.int64)
            self.levels.append((bits, (np.cumsum(ones) - ones + done).astype(np.uint32)))
            done += int(ones.sum())
            placed = alone[cell]
            a, b = a[~placed], b[~placed]

    @staticmethod
    def cell(a, b, level: int, size: int) -> np.ndarray:
        return (mix(a + mix(b + np.uint64(level + 1))) % np.uint64(size)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out, left = np.full(len(a), -1, np.int64), np.arange(len(a))
        for k, (bits, before) in enumerate(self.levels):
            cell = self.cell(a[left], b[left], k, 64 * len(bits))
            word, place = bits[cell >> 6], (cell & 63).astype(np.uint64)
            here = (word >> place & np.uint64(1)) > 0
            below = np.bitwise_count(word & ((np.uint64(1) << place) - np.uint64(1)))
            out[left[here]] = (before[cell >> 6] + below)[here]
            left = left[~here]
        return out


class LineArrays:
    """A shard: the hash of its distinct lines and the arrays that it indexes."""

    def __init__(self, a: np.ndarray, b: np.ndarray, docs: np.ndarray, largest: np.ndarray):
        self.hash = MinimalPerfectHash(a, b)
        at = self.hash.find(a, b)
        self.fingerprints, self.counts, self.largest = np.zeros(len(a), np.uint64), np.zeros(len(a), np.uint32), np.zeros(len(a), np.int64)
        self.fingerprints[at], self.counts[at], self.largest[at] = b, np.minimum(docs, (1 << 32) - 1), largest

    def probe(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents with each line (0: the line is not in the arrays) and their largest id."""
        if not len(self.counts):
            return np.zeros(len(a), np.int64), np.full(len(a), NO_ID)
        at = self.hash.find(a, b)
        known = (at >= 0) & (self.fingerprints[at] == b)
        return np.where(known, self.counts[at].astype(np.int64), 0), np.where(known, self.largest[at], NO_ID)


def lines(data: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Of all lines of all texts: document number, start, end, whether the key has `least` code points, and for those
    that do the two halves of the key's digest."""
    breaks = np.flatnonzero(data == 10)
    doc_of_break = np.searchsorted(offsets, breaks, side="right") - 1
    starts = np.concatenate([offsets[:-1], breaks + 1])
    doc = np.concatenate([np.arange(len(offsets) - 1), doc_of_break])
    order = np.lexsort((starts, doc))
    starts, doc = starts[order], doc[order]
    ends = np.append(starts[1:] - 1, 0)
    last = np.append(doc[1:] != doc[:-1], True)
    ends[last] = offsets[doc[last] + 1]
    solid = np.flatnonzero(NOT_SPACE[data])
    a, b = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    some = a < b
    from_, to = starts.copy(), starts.copy()
    from_[some], to[some] = solid[a[some]], solid[b[some] - 1] + 1
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    counted = points[to] - points[from_] >= least
    low = LOWER[data].tobytes()
    digests = b"".join([blake2b(low[i:j], digest_size=16).digest() for i, j in zip(from_[counted].tolist(), to[counted].tolist(), strict=True)])
    return doc, starts, ends, counted, *np.frombuffer(digests, "<u8").reshape(-1, 2).T


def tally(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Distinct hashes (two halves), the documents that hold each, and the largest id among them."""
    doc, _, _, counted, a, b = lines(data, offsets, least)
    doc = doc[counted]
    order = np.lexsort((doc, b, a))
    doc, a, b = doc[order], a[order], b[order]
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first, once = np.flatnonzero(new), np.ones(len(a), dtype=np.int64)
    once[1:] = new[1:] | (doc[1:] != doc[:-1])
    n, largest = (np.add.reduceat(once, first), np.maximum.reduceat(ids[doc], first)) if len(first) else (once, ids[:0])
    return a[first], b[first], n, largest


def without(ids: np.ndarray, data: np.ndarray, offsets: np.ndarray, least: int, probe, least_docs: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Lines, dropped lines and what stays of every text; probe(a, b) gives documents and largest id of hashes."""
    doc, starts, ends, counted, a, b = lines(data, offsets, least)
    docs, largest = probe(a, b)
    gone = np.zeros(len(doc), dtype=bool)
    gone[counted] = (docs >= least_docs) & (largest != ids[doc[counted]])
    raw, bounds = data.tobytes(), np.searchsorted(doc, np.arange(len(ids) + 1))
    dropped = np.add.reduceat(gone.astype(np.int64), bounds[:-1]) if len(ids) else bounds[:0]
    kept = [raw[i:j] for i, j in zip(offsets.tolist(), offsets[1:].tolist(), strict=False)]
    for d in np.flatnonzero(dropped).tolist():
        kept[d] = b"\n".join(raw[starts[k] : ends[k]] for k in range(bounds[d], bounds[d + 1]) if not gone[k])
    return np.diff(bounds), dropped, kept


def numbers(ids) -> np.ndarray:
    return np.array([NO_ID if x is None else x for x in ids], np.int64)


KEPT = "doc_id long, n_lines long, n_dropped long, text string"


def kept_table(ids: list, data, offsets, least, probe, least_docs) -> pa.RecordBatch:
    n, dropped, kept = without(numbers(ids), data, offsets, least, probe, least_docs)
    return pa.record_batch([pa.array(ids, pa.int64()), pa.array(n), pa.array(dropped), pa.array(kept, pa.binary()).cast(pa.string())], names=[x.split()[0] for x in KEPT.split(", ")])


def line_arrays(docs: DataFrame, least_chars: int, least_docs: int) -> tuple[DataFrame, int]:
    """(shard, arrays), pickled `LineArrays` of the lines that least_docs documents hold, and the number of shards.
    docs: doc_id, text."""

    def count(batches):
        for batch in batches:
            data, offsets = texts(batch.column(1))
            ids = numbers(batch.column(0).to_pylist())
            for i, j in sliced(offsets, 4 << 20):
                yield pa.record_batch([pa.array(x.astype("<i8", copy=False).view(np.int64)) for x in tally(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], ids[i:j], least_chars)], names=["a", "b", "docs", "largest"])

    found = docs.mapInArrow(tidy(count), "a long, b long, docs long, largest long").groupBy("a", "b").agg(F.sum("docs").alias("docs"), F.max("largest").alias("largest"))
    found = written(found.where(F.col("docs") >= least_docs), "line-hashes")
    n_shards = max(1, -(-found.count() // SHARD_KEYS))

    def build(table: pa.Table) -> pa.Table:
        a, b, n, largest = (table.column(c).to_numpy() for c in ("a", "b", "docs", "largest"))
        arrays = LineArrays(a.view(np.uint64), b.view(np.uint64), n, largest)
        return pa.table([pa.array([table.column("shard")[0].as_py()], pa.int32()), pa.array([pickle.dumps(arrays)], pa.binary())], names=["shard", "arrays"])

    return written(found.withColumn("shard", shard_of(F.col("a"), n_shards)).groupBy("shard").applyInArrow(tidy(build), "shard int, arrays binary"), "line-arrays"), n_shards


def shard_of(a, n_shards: int):
    """The shard of a hash by its upper half's upper 32 bits: a Column, or numpy values."""
    if isinstance(a, np.ndarray):
        return (a >> np.uint64(32)).astype(np.int64) % n_shards
    return F.pmod(F.shiftrightunsigned(a, 32), F.lit(n_shards)).cast("int")


def dedup_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Drop repeated lines: doc_id, n_lines, n_dropped, text (the lines that stay, joined by a line feed).

    A line's key is the line without white space at its ends and with A-Z lower-cased. Keys of at least least_chars
    code points that at least least_docs documents hold are dropped, but for the document of the largest id. Keys are
    equal if their 128-bit BLAKE2 digests are. A null or empty text is one empty line. Equal rows count as documents of
    their own and, with the largest id, all keep the line; a null id is below all others. An empty table gives no row;
    further columns play no part.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    arrays, n_shards = line_arrays(rows, least_chars, least_docs)
    size = arrays.agg(F.coalesce(F.sum(F.octet_length("arrays")), F.lit(0))).first()[0]
    if size > broadcast_bytes:
        return by_shards(blocks(docs, id_col, text_col, block_bytes), arrays, n_shards, least_chars, least_docs)
    sent = docs.sparkSession.sparkContext.broadcast({r["shard"]: bytes(r["arrays"]) for r in arrays.collect()})

    def drop(batches):
        shards = {s: pickle.loads(x) for s, x in sent.value.items()}

        def probe(a, b):
            own, n, largest = shard_of(a, n_shards), np.zeros(len(a), np.int64), np.full(len(a), NO_ID)
            for s, shard in shards.items():
                at = np.flatnonzero(own == s)
                n[at], largest[at] = shard.probe(a[at], b[at])
            return n, largest

        for batch in batches:
            data, offsets = texts(batch.column(1))
            ids = batch.column(0).to_pylist()
            for i, j in sliced(offsets, 4 << 20):
                yield kept_table(ids[i:j], data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], least_chars, probe, least_docs)

    return rows.mapInArrow(tidy(drop), KEPT)


def by_shards(packs: DataFrame, arrays: DataFrame, n_shards: int, least_chars: int, least_docs: int) -> DataFrame:
    """The same with arrays that stay by shard: blocks send their hashes, and get those that are in the arrays."""
    packs = written(packs, "line-blocks")
    n_parts = max(1, -(-packs.count() // (MEETING * n_shards)))

    def ask(batches):
        for batch in batches:
            for row in rows_of(batch):
                a, b = lines(*block_texts(row), least_chars)[4:]
                a, b = np.unique(np.stack([a, b]), axis=1)
                shard = shard_of(a, n_shards)
                order = np.argsort(shard, kind="stable")
                cut = np.searchsorted(shard[order], np.arange(n_shards + 1))
                full = np.flatnonzero(np.diff(cut))
                own = [order[cut[s] : cut[s + 1]] for s in full]
                yield pa.record_batch([pa.array(full, pa.int32()), pa.array([row["block"] % n_parts] * len(full), pa.int32()), pa.array([row["block"]] * len(full), pa.int64()), *(pa.array([x[i].tobytes() for i in own], pa.binary()) for x in (a, b))], names=["shard", "part", "block", "a", "b"])

    asked = packs.select("block", "ends", "data").mapInArrow(tidy(ask), "shard int, part int, block long, a binary, b binary")
    # an array meets a bounded number of blocks at a time
    held = arrays.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))))

    def answer(asked: pa.Table, held: pa.Table) -> pa.Table:
        out = []
        if held.num_rows:
            shard = pickle.loads(held.column("arrays")[0].as_py())
            for x in asked.to_pylist():
                a, b = np.frombuffer(x["a"], "<u8"), np.frombuffer(x["b"], "<u8")
                n, largest = shard.probe(a, b)
                hit = n >= least_docs
                if hit.any():
                    out.append((x["block"], *(y[hit].tobytes() for y in (a, b, n, largest))))
        return pa.table([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), *[pa.binary()] * 4))], names=["block", "a", "b", "docs", "largest"])

    keys = ("shard", "part")
    found = asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(tidy(answer), "block long, a binary, b binary, docs binary, largest binary")

    def drop(pack: pa.Table, answer: pa.Table) -> pa.Table:
        a, b, n, largest = (np.frombuffer(b"".join(answer.column(c).to_pylist()), t) for c, t in (("a", "<u8"), ("b", "<u8"), ("docs", "<i8"), ("largest", "<i8")))
        known = LineArrays(a, b, n, largest)
        return pa.Table.from_batches([kept_table(row["ids"], *block_texts(row), least_chars, known.probe, least_docs) for row in pack.to_pylist()])

    return packs.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(tidy(drop), KEPT)


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every document."""
    kept = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP6_SQL = r"""
with line as (select rid, doc_id, i, l, translate(trim(l, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from (select rid, doc_id, unnest(string_split(t, chr(10))) as l, unnest(range(len(string_split(t, chr(10))))) as i from (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents))),
hot as (select k, max(doc_id) as largest from line where length(k) >= 20 group by k having count(distinct rid) >= 3),
mark as (select rid, line.doc_id, i, l, largest is not null and largest <> line.doc_id as gone from line left join hot using (k))
select doc_id, count(*) as n_lines, cast(sum(cast(gone as int)) as bigint) as n_dropped, sha256(coalesce(string_agg(l, chr(10) order by i) filter (not gone), '')) as kept_sha256
from mark group by rid, doc_id
"""
