"""Ranked lexical search by Fagin's threshold algorithm.

The index is partitioned by documents: a row holds the inverted lists of some consecutive documents and their lengths. A
task answers every item on its rows, one row after the other. There it puts the lists of the items' terms in
descending order of impact, which depends on means over all documents, and turns them round into a forward index (a
document's asked terms with impacts). For an item, the lists of its terms are read round-robin, some places of each at a
time; a document seen for the first time gets its whole score from the forward index. No unseen document can score more
than the weighted sum of the impacts that stand next in the lists, so the item is done with the row when that sum is
strictly below the k-th best score so far, of this row or an earlier one of the task: equal scores still count, for
ties go by id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scribemill.llm._arrays import ALNUM, binary, coded, ragged, sliced, texts, tidy, words
from scribemill.llm._shared import rows_of, temporary_tables, written

#: bytes of text that a row of the index covers, or one longer text
BLOCK_BYTES = 8 << 20
#: bytes of items that one broadcast may hold; more items are taken in blocks of that size
QUERY_BYTES = 16 << 20
#: places of each list that are read in an item's first turn on a row; twice as many in each further one
FIRST_TURN = 16
#: a task's answers meet those of others in so many groups an item before they meet in one
GROUPS = 64

INDEX = "n_documents long, n_terms long, ids array<bigint>, sizes binary, terms binary, term_ends binary, list_ends binary, documents binary, counts binary"


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The index of all terms of all texts (null: none), in the shared folder.

    Columns: documents with terms, all terms; ids and lengths of the documents; the distinct terms (bytes and ends, in
    no order); ends of their lists, and in these the document numbers, ascending, and how often each has the term.
    """

    def index(batches):
        for batch in batches:
            data, offsets = texts(batch.column(1))
            ids = batch.column(0).to_pylist()
            for i, j in sliced(offsets, block_bytes):
                found, firsts = words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], ALNUM)
                codes, distinct = coded(found)
                sizes = np.diff(firsts)
                keys, counts = np.unique(codes.astype(np.int64) * (j - i) + np.repeat(np.arange(j - i), sizes), return_counts=True)
                raw, ends = texts(distinct)
                lists = np.searchsorted(keys, np.arange(1, len(distinct) + 1) * (j - i))
                yield pa.record_batch(
                    [pa.array([int((sizes > 0).sum())], pa.int64()), pa.array([int(sizes.sum())], pa.int64()), pa.array([ids[i:j]], pa.list_(pa.int64())), *(pa.array([x.tobytes()], pa.binary()) for x in (sizes.astype("<u4"), raw, ends[1:].astype("<i8"), lists.astype("<i8"), (keys % (j - i)).astype("<u4"), counts.astype("<u4")))],
                    names=["n_documents", "n_terms", "ids", "sizes", "terms", "term_ends", "list_ends", "documents", "counts"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return written(rows.mapInArrow(tidy(index), INDEX), "search-index", "snappy")


class Items:
    """A bounded set of items: ids, distinct terms, and of each item the numbers of its terms; sent to every task."""

    def __init__(self, item_ids: list, item_texts: list):
        data, offsets = texts(pa.array(item_texts, pa.string()))
        found, firsts = words(data, offsets, ALNUM)
        codes, self.terms = coded(found)
        self.ids, self.of = item_ids, [np.unique(codes[a:b]).astype(np.int64) for a, b in zip(firsts, firsts[1:], strict=False)]
        self.weights = None


def item_blocks(items: DataFrame, id_col: str, text_col: str):
    """`Items` of at most QUERY_BYTES of text each (or one item): one, for a usual benchmark."""
    rows = items.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 40), F.lit(0))).first()[0]
    n = max(1, -(-2 * size // QUERY_BYTES)) if size > QUERY_BYTES else 1
    for k in range(n):
        part = (rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k) if n > 1 else rows).collect()
        yield Items([r["id"] for r in part], [r["text"] for r in part])


def lists_of(row: dict) -> tuple[pa.Array, np.ndarray]:
    """A row's terms and the starts of their lists."""
    terms = binary(np.frombuffer(row["terms"], np.uint8), np.concatenate([[0], np.frombuffer(row["term_ends"], "<i8")]))
    return terms, np.concatenate([[0], np.frombuffer(row["list_ends"], "<i8")]).astype(np.int64)


def document_frequencies(index: DataFrame, items) -> np.ndarray:
    """In how many documents each of the items' terms stands."""

    def count(batches):
        total = np.zeros(len(items.value.terms), np.int64)
        for batch in batches:
            for row in rows_of(batch):
                terms, starts = lists_of(row)
                at = pc.fill_null(pc.index_in(items.value.terms, value_set=terms), -1).to_numpy(zero_copy_only=False)
                total += np.where(at >= 0, np.append(np.diff(starts), 0)[at], 0)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["term", "n"])

    out = np.zeros(len(items.value.terms), np.int64)
    for r in index.select("terms", "term_ends", "list_ends").mapInArrow(tidy(count), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r["term"]] = r["n"]
    return out


def impacts(counts: np.ndarray, sizes: np.ndarray, n_documents: int, n_terms: int) -> np.ndarray:
    """(1000000000 tf) div (1000 tf + 20 m) with m = 50 + (50 n N) div L, of every entry; sizes: n of its document."""
    if len(sizes) and 50 * int(sizes.max()) * n_documents >= 1 << 63:
        m = np.array([50 * x * n_documents // n_terms for x in sizes.tolist()], np.int64)
    else:
        m = 50 * sizes * n_documents // max(n_terms, 1)
    return 1_000_000_000 * counts // (1000 * counts + 20 * (m + 50))


class Shelf:
    """A row of the index, for the items' terms: lists by impact, and the forward index."""

    def __init__(self, row: dict, terms: pa.Array, n_documents: int, n_terms: int):
        own, starts = lists_of(row)
        sizes = np.frombuffer(row["sizes"], "<u4").astype(np.int64)
        self.ids = row["ids"]
        at = pc.fill_null(pc.index_in(terms, value_set=own), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        lengths = np.where(at >= 0, np.append(np.diff(starts), 0)[at], 0)
        places = ragged(np.where(at >= 0, starts[at], 0), lengths)
        term = np.repeat(np.arange(len(terms)), lengths)
        document = np.frombuffer(row["documents"], "<u4")[places].astype(np.int64)
        impact = impacts(np.frombuffer(row["counts"], "<u4")[places].astype(np.int64), sizes[document], n_documents, n_terms)
        #: of each term: where its list starts
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        # entries are by term, then document: a stable sort leaves equal impacts by document
        order = np.lexsort((-impact, term))
        self.documents, self.impacts = document[order], impact[order]
        order = np.argsort(document, kind="stable")
        #: of each document: where its entries in the forward index start
        self.firsts = np.searchsorted(document[order], np.arange(len(sizes) + 1))
        self.forward_terms, self.forward_impacts = term[order], impact[order]
        self.seen = np.zeros(len(sizes), bool)

    def scores(self, documents: np.ndarray, weight_of: np.ndarray) -> np.ndarray:
        """Whole scores of documents, from the forward index. weight_of: of every term, 0 for those the item lacks."""
        n = self.firsts[documents + 1] - self.firsts[documents]
        at = ragged(self.firsts[documents], n)
        sums = np.concatenate([[0], np.cumsum(weight_of[self.forward_terms[at]] * self.forward_impacts[at])])
        ends = np.cumsum(n)
        return sums[ends] - sums[ends - n]

    def best(self, terms: np.ndarray, weight_of: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of at least all documents here that belong to the k best, if the k-th best score that is
        known from elsewhere is `floor` (at least 1)."""
        start, end = self.starts[terms], self.starts[terms + 1]
        weights = weight_of[terms]
        live = (end > start) & (weights > 0)
        start, end, weights = start[live], end[live], weights[live]
        found_d, found_s, top, turn = [], [], np.zeros(0, np.int64), FIRST_TURN
        while len(start):
            # the weighted impacts that stand next in the lists bound every unseen document
            if int((weights * self.impacts[start]).sum()) < floor:
                break
            upto = np.minimum(start + turn, end)
            documents = np.unique(self.documents[ragged(start, upto - start)])
            documents = documents[~self.seen[documents]]
            self.seen[documents] = True
            scores = self.scores(documents, weight_of)
            found_d.append(documents)
            found_s.append(scores)
            top = np.sort(np.concatenate([top, scores]))[-k:]
            if len(top) == k:
                floor = max(floor, int(top[0]))
            more = upto < end
            start, end, weights, turn = upto[more], end[more], weights[more], turn * 2
        none = np.zeros(0, np.int64)
        documents, scores = np.concatenate([none, *found_d]), np.concatenate([none, *found_s])
        self.seen[documents] = False
        good = scores >= floor
        return documents[good], scores[good]


FOUND = "item long, doc_id long, score long"


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id, score of each item's k best documents with a score above 0, equal scores by
    ascending doc_id, null last.

    Null and empty texts have no terms: such documents are found by no item, and such items find none. Each row of either
    table counts: equal documents take a rank each, items of one id are answered one by one. An empty table gives no
    row. Extra columns play no part. A task keeps k answers for each item of a block of QUERY_BYTES, and those of all tasks are
    merged in two steps.
    """
    spark, out = docs.sparkSession, None
    with temporary_tables(spark) as tables:
        index = build_index(docs, id_col, text_col, block_bytes)
        n_documents, n_terms = index.agg(F.coalesce(F.sum("n_documents"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
        for block in item_blocks(items, item_id, item_text):
            sent = spark.sparkContext.broadcast(block)
            frequency = document_frequencies(index, sent)
            sent.unpersist()
            block.weights = np.array([math.floor(1000 * math.log((2 * n_documents + 2) / (2 * n + 1))) for n in frequency.tolist()], np.int64)
            found = tables.keep(written(index.mapInArrow(tidy(answering(spark.sparkContext.broadcast(block), k, n_documents, n_terms)), FOUND + ", part int"), "answers"))
            found = ranked(found, k, ["item", "part"]).drop("rank", "part")
            names = spark.createDataFrame([(n, x) for n, x in enumerate(block.ids)], f"number long, {item_id} {items.schema[item_id].dataType.simpleString()}")
            found = ranked(found, k, ["item"]).join(F.broadcast(names), F.col("item") == F.col("number")).select(item_id, F.col("rank").cast("int").alias("rank"), "doc_id", "score")
            out = found if out is None else out.unionByName(found)
    return out


def ranked(found: DataFrame, k: int, by: list[str]) -> DataFrame:
    """The k best rows of each group, with their rank."""
    place = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def answering(sent, k: int, n_documents: int, n_terms: int):
    def run(batches):
        from pyspark import TaskContext

        items = sent.value
        weight_of = np.zeros(len(items.terms), np.int64)
        #: of each item the best so far: scores, ids, whether an id is null
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in items.ids]
        for batch in batches:
            for row in rows_of(batch):
                shelf = Shelf(row, items.terms, n_documents, n_terms)
                null = np.array([x is None for x in shelf.ids], bool)
                ids = np.array([x or 0 for x in shelf.ids], np.int64)
                for i, terms in enumerate(items.of):
                    weight_of[terms] = items.weights[terms]
                    floor = max(1, int(best[i][0][-1])) if len(best[i][0]) == k else 1
                    documents, scores = shelf.best(terms, weight_of, k, floor)
                    weight_of[terms] = 0
                    if len(documents):
                        s, d, z = (np.concatenate(x) for x in zip(best[i], (scores, ids[documents], null[documents]), strict=True))
                        order = np.lexsort((d, z, -s))[:k]
                        best[i] = s[order], d[order], z[order]
        sizes = [len(s) for s, _, _ in best]
        s, d, z = (np.concatenate([x[j] for x in best] or [np.zeros(0, np.int64)]) for j in range(3))
        part = TaskContext.get().partitionId() % GROUPS
        yield pa.record_batch([pa.array(np.repeat(np.arange(len(sizes)), sizes), pa.int64()), pa.array(d, pa.int64(), mask=z.astype(bool)), pa.array(s, pa.int64()), pa.array(np.full(len(s), part), pa.int32())], names=["item", "doc_id", "score", "part"])

    return run


def op12_lexical_search(spark, sf_dir: str) -> DataFrame:
    """item_id, rank, doc_id, score of the 50 best documents of every benchmark item."""
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP12_SQL = r"""
with d as (select row_number() over () as rid, doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as w from documents),
n as (select count(*) filter (len(w) > 0) as n_all, cast(sum(len(w)) as bigint) as l_all from d),
b as (select distinct number, item_id, unnest(list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) as term from (select row_number() over () as number, * from benchmark)),
p as (select rid, doc_id, len(w) as size, unnest(w) as term from d),
q as (select rid, any_value(doc_id) as doc_id, any_value(size) as size, term, count(*) as tf from p where term in (select term from b) group by rid, term),
w as (select term, cast(floor(1000 * ln(cast(2 * (select n_all from n) + 2 as double) / cast(2 * count(*) + 1 as double))) as bigint) as weight from q group by term),
s as (select number, any_value(item_id) as item_id, rid, any_value(doc_id) as doc_id, cast(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * size * n_all) // l_all))))) as bigint) as score from b join q using (term) join w using (term), n group by number, rid),
r as (select *, row_number() over (partition by number order by score desc, doc_id nulls last) as rank from s where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, score from r where rank <= 50
"""
