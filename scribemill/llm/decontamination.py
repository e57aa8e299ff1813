"""Benchmark decontamination by a distributed positional inverted index over the training documents.

The index is partitioned by documents: each of its rows holds the whole postings of some consecutive documents, so a
frequent term is spread over all rows, and a query is answered where the documents are. In a row all postings lie in
one array, by term and position, which makes (term, position) pairs searchable at once: a window's candidates come
from its rarest term's list, moved back by that term's offset, and must be found in every other term's moved list.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scribemill.llm._arrays import ALNUM, binary, coded, ragged, sliced, texts, tidy, words
from scribemill.llm._shared import BLOCK_BYTES, rows_of, written

INDEX = "number long, ids array<bigint>, hashes array<bigint>, firsts binary, terms binary, term_ends binary, list_ends binary, positions binary"
#: bytes of benchmark text that one broadcast may hold; a larger benchmark is taken in blocks of that size
QUERY_BYTES = 16 << 20
#: places of rarest terms that are looked at together
CANDIDATES = 1 << 18


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The index of all words of all texts (null: none), written to the shared folder.

    Columns: the number of the row's first document, ids and text hashes of its documents, `firsts` (number of each document's first word within the row, and the
    total), the terms (bytes and ends, in no order), and their lists: ends and ascending word positions.
    """

    def index(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            data, offsets = texts(batch.column(1))
            ids, hashes = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for i, j in sliced(offsets, block_bytes):
                found, firsts = words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], ALNUM)
                codes, distinct = coded(found)
                order = np.argsort(codes, kind="stable").astype("<u4")
                raw, ends = texts(distinct)
                lists = np.cumsum(np.bincount(codes, minlength=len(distinct)))
                yield pa.record_batch([pa.array([number], pa.int64()), *(pa.array([x[i:j]], pa.list_(pa.int64())) for x in (ids, hashes)), *(pa.array([x.tobytes()], pa.binary()) for x in (firsts.astype("<i8"), raw, ends[1:].astype("<i8"), lists.astype("<i8"), order))], names=["number", "ids", "hashes", "firsts", "terms", "term_ends", "list_ends", "positions"])
                number += j - i

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    return written(rows.mapInArrow(tidy(index), INDEX), "postings", "snappy")


class Postings:
    """A row of the index."""

    def __init__(self, row: dict):
        self.ids = row["ids"]
        self.firsts = np.frombuffer(row["firsts"], "<i8")
        self.terms = binary(np.frombuffer(row["terms"], np.uint8), np.concatenate([[0], np.frombuffer(row["term_ends"], "<i8")]))
        self.starts = np.concatenate([[0], np.frombuffer(row["list_ends"], "<i8")]).astype(np.int64)
        self.positions = np.frombuffer(row["positions"], "<u4").astype(np.int64)
        self.n = int(self.firsts[-1]) if len(self.firsts) else 0
        self.sizes = np.diff(self.starts)
        self.keys = None

    def lookup(self, terms: pa.Array) -> np.ndarray:
        """Term numbers, -1 where the row lacks a term."""
        import pyarrow.compute as pc

        return pc.fill_null(pc.index_in(terms, value_set=self.terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def holds(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Whether each term stands at the position."""
        if self.keys is None:
            self.keys = np.repeat(np.arange(len(self.sizes)), self.sizes) * (self.n + 1) + self.positions
        key = term * (self.n + 1) + np.clip(position, 0, self.n)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return (self.keys[at] == key) & (position >= 0) & (position < self.n)

    def phrases(self, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, start) of every exact occurrence within one document. windows: term numbers, a row each."""
        width = windows.shape[1]
        inside = np.arange(width) < lengths[:, None]
        live = np.flatnonzero(((windows >= 0) | ~inside).all(1) & (lengths > 0))
        w, ok = windows[live], inside[live]
        rarity = np.where(ok, self.sizes[np.where(ok, w, 0)], np.iinfo(np.int64).max)
        by_rarity = np.argsort(rarity, axis=1, kind="stable")
        found_w, found_s = [], []
        a, upto = 0, np.cumsum(rarity.min(axis=1, initial=np.iinfo(np.int64).max)) if len(live) else rarity
        while a < len(live):
            # so many candidates at a time, or those of one window
            z = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + CANDIDATES, side="right")))
            part, order = w[a:z], by_rarity[a:z]
            rare = order[:, 0]
            term = part[np.arange(len(part)), rare]
            n = self.sizes[term]
            which = np.repeat(np.arange(len(part)), n)
            start = self.positions[ragged(self.starts[term], n)] - rare[which]
            n_terms = lengths[live[a:z]]
            for k in range(1, width):
                if not len(which):
                    break
                asked = n_terms[which] > k
                offset = order[which, k]
                good = ~asked
                good[asked] = self.holds(part[which[asked], offset[asked]], start[asked] + offset[asked])
                which, start = which[good], start[good]
            good = (start >= 0) & (start + n_terms[which] <= self.n)
            which, start = which[good], start[good]
            last = start + n_terms[which] - 1
            same = np.searchsorted(self.firsts, start, side="right") == np.searchsorted(self.firsts, last, side="right")
            found_w.append(live[a + which[same]])
            found_s.append(start[same])
            a = z
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *found_w]), np.concatenate([none, *found_s])

    def near(self, term_sets: list[np.ndarray], within: int) -> list[tuple[int, int]]:
        """(query, document number) wherever all terms of the query stand within so many consecutive words."""
        out = []
        for q, terms in enumerate(term_sets):
            terms = np.unique(terms)
            if not len(terms) or terms[0] < 0:
                continue
            lists = sorted((self.positions[self.starts[t] : self.starts[t + 1]] for t in terms), key=len)
            # a span that holds all terms begins at one of them: for each start, the farthest of the next occurrences
            begin = np.unique(np.concatenate(lists))
            end = begin.copy()
            for x in lists:
                at = np.searchsorted(x, begin)
                end = np.maximum(end, np.where(at < len(x), x[np.minimum(at, len(x) - 1)], np.iinfo(np.int64).max))
            good = (end - begin < within) & (end < self.n)
            first, last = (np.searchsorted(self.firsts, x[good], side="right") - 1 for x in (begin, end))
            out += [(q, int(d)) for d in np.unique(first[first == last])]
        return out


class Queries:
    """A bounded set of items as windows of term codes; sent to every task."""

    def __init__(self, item_ids: list, item_texts: list, width: int):
        data, offsets = texts(pa.array(item_texts, pa.string()))
        found, firsts = words(data, offsets, ALNUM)
        codes, self.terms = coded(found)
        n = np.diff(firsts)
        per = np.where(n > 0, np.maximum(n - width + 1, 1), 0)
        self.item_ids, self.item = item_ids, np.repeat(np.arange(len(n)), per)
        self.lengths = np.minimum(n, width)[self.item]
        at = ragged(firsts[:-1], per)
        self.windows = np.where(np.arange(width) < self.lengths[:, None], np.append(codes, 0)[np.minimum(at[:, None] + np.arange(width), len(codes))], -1) if len(at) else np.zeros((0, width), np.int64)
        self.sets = [np.unique(codes[a:b]) for a, b in zip(firsts, firsts[1:], strict=False)]


def query_blocks(items: DataFrame, id_col: str, text_col: str, width: int):
    """The items as `Queries` of at most QUERY_BYTES of text each (or one item): one, for a usual benchmark."""
    rows = items.select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 40), F.lit(0))).first()[0]
    n = max(1, -(-2 * size // QUERY_BYTES)) if size > QUERY_BYTES else 1
    for k in range(n):
        part = (rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k) if n > 1 else rows).toPandas()
        yield Queries(part["id"].where(part["id"].notna(), None).tolist(), part["text"].tolist(), width)


HITS = "doc_id long, text_hash long, n_words long, spans array<struct<s:long,e:long>>, items array<string>, rid long"


def phrase_matches(index: DataFrame, items: DataFrame, width: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Documents with the exact occurrences of the items' windows of `width` consecutive words.

    An item of fewer words is one window; one without words has none. Returns a row per document and query block:
    doc_id, text_hash, n_words, spans (hit words [s, e), apart and ascending), items (ids of items with an occurrence, distinct),
    rid (number of the document in the index). An item without an id hits words and is not listed.
    """
    return _hits(index, items, width, id_col, text_col)[0]


def _hits(index: DataFrame, items: DataFrame, width: int, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, int]:

    def probe(queries):
        def run(batches):
            for batch in batches:
                for row in rows_of(batch):
                    p = Postings(row)
                    known = np.append(p.lookup(queries.value.terms), -1)
                    which, start = p.phrases(known[queries.value.windows], queries.value.lengths)
                    doc = np.searchsorted(p.firsts, start, side="right") - 1
                    order = np.lexsort((start, doc))
                    which, start, doc = which[order], start[order], doc[order]
                    ends, bounds = start + queries.value.lengths[which], np.searchsorted(doc, np.arange(len(p.ids) + 1))
                    spans, items_of = [], []
                    for d in range(len(p.ids)):
                        a, b, own = bounds[d], bounds[d + 1], []
                        for s, e in zip((start[a:b] - p.firsts[d]).tolist(), (ends[a:b] - p.firsts[d]).tolist(), strict=True):
                            if own and s <= own[-1]["e"]:
                                own[-1]["e"] = max(e, own[-1]["e"])
                            else:
                                own.append({"s": s, "e": e})
                        spans.append(own)
                        items_of.append(list(dict.fromkeys(x for k in np.unique(queries.value.item[which[a:b]]) if (x := queries.value.item_ids[k]) is not None)))
                    yield pa.record_batch([pa.array(p.ids, pa.int64()), pa.array(row["hashes"], pa.int64()), pa.array(np.diff(p.firsts)), pa.array(spans, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))), pa.array(items_of, pa.list_(pa.string())), pa.array(np.arange(len(p.ids)) + row["number"])], names=["doc_id", "text_hash", "n_words", "spans", "items", "rid"])

        return run

    spark, out, n = index.sparkSession, None, 0
    for block in query_blocks(items, id_col, text_col, width):
        hits = index.mapInArrow(tidy(probe(spark.sparkContext.broadcast(block))), HITS)
        out, n = hits if out is None else out.unionByName(hits), n + 1
    return out, n


def proximity_matches(index: DataFrame, items: DataFrame, within: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id) wherever all distinct words of an item stand within so many consecutive words of a document."""

    def probe(queries):
        def run(batches):
            for batch in batches:
                for row in rows_of(batch):
                    p = Postings(row)
                    known = p.lookup(queries.value.terms)
                    found = p.near([known[x] for x in queries.value.sets], within)
                    yield pa.record_batch([pa.array([p.ids[d] for _, d in found], pa.int64()), pa.array([queries.value.item_ids[q] for q, _ in found], pa.string())], names=["doc_id", "item_id"])

        return run

    spark, out = index.sparkSession, None
    for block in query_blocks(items, id_col, text_col, 1):
        hits = index.mapInArrow(probe(spark.sparkContext.broadcast(block)), "doc_id long, item_id string")
        out = hits if out is None else out.unionByName(hits)
    return out


def contamination(docs: DataFrame, items: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, text_hash (xxhash64), n_words, n_hit (words inside an occurrence of a window), items (sorted ids), contaminated.

    Null and empty texts have no words; equal rows each get a row; an empty table gives none; further columns of
    either table play no part.
    """
    hits, blocks = _hits(build_index(docs, id_col, text_col), items, width)
    if blocks > 1:
        hits = hits.groupBy("rid").agg(
            F.first("doc_id").alias("doc_id"),
            F.first("text_hash").alias("text_hash"),
            F.first("n_words").alias("n_words"),
            F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        )
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to"))
    covered = F.aggregate("spans", zero, lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], a["to"]))).cast("long").alias("n"), F.greatest(a["to"], x["e"]).alias("to")))["n"]
    return hits.select("doc_id", "text_hash", "n_words", covered.alias("n_hit"), F.array_sort("items").alias("items"), (F.size("spans") > 0).alias("contaminated"))


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    found = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


OP10_SQL = r"""
with d as (select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
win as (select distinct item_id, least(len(w), 10) as k, list_aggregate(w[i:i + 9], 'string_agg', ' ') as g from (select item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) as i from b where len(w) > 0)),
ks as (select distinct k from win),
grams as (select rid, k, i, list_aggregate(w[i:i + k - 1], 'string_agg', ' ') as g from (select rid, w, k, unnest(range(1, len(w) - k + 2)) as i from d, ks where len(w) >= k)),
hits as (select rid, i, grams.k, item_id from grams join win on grams.g = win.g and grams.k = win.k),
hit as (select rid, count(distinct p) as n_hit from (select rid, unnest(range(i, i + k)) as p from hits) group by rid),
item as (select rid, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids from hits group by rid)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (rid) left join item using (rid)
"""
