"""Near-duplicate grouping: SuperMinHash signatures, banding, exact verification and union-find over the links.

A document's set is its distinct 5-word shingles. Documents of equal sets are one node from the start, so groups of
copies cost one row each. A node's band keys put it into buckets; each bucket links its nodes to one hub, and links
are confirmed on the full sets. Where confirmed links leave a bucket in several components, the pairs between those
components are looked at too, so that a bucket's hub decides about effort alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scribemill.llm._arrays import NOT_SPACE, binary, coded, hash_binary, mix, ragged, sliced, texts, tidy, words
from scribemill.llm._shared import temporary_tables, written

SHINGLE = 5
#: registers; bands of ROWS registers: a pair of similarity 0.75 misses all of them with odds of 1 in 200,000
REGISTERS, ROWS = 128, 4
#: a pair whose signatures agree in less than this share is taken to be under 0.75 (six standard errors off)
LEAST_ESTIMATE = 0.5
PERCENT = 75
#: nodes of a bucket that one task compares with as many others, and bytes of their sets; smaller buckets are cut too
CHUNK, CHUNK_BYTES = 2000, 16 << 20
SMALL_CHUNK, SMALL_CHUNKS = 400, 8
UNSET = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct 64-bit shingle hashes of every text, and the offsets of the texts.

    A text of fewer words than `width`, but not none, has its whole word sequence as its one shingle. Two different
    shingles of a pair of texts have the same hash with odds of about (shingles of the pair)^2 / 2^65.
    """
    found, firsts = words(data, offsets, NOT_SPACE)
    codes, distinct = coded(found)
    h = mix(hash_binary(distinct) + np.uint64(1))[codes] if len(codes) else np.zeros(0, np.uint64)
    n = np.diff(firsts)
    per = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    starts = ragged(firsts[:-1], per)
    doc = np.repeat(np.arange(len(n)), per)
    length = np.minimum(n, width)[doc]
    total = np.zeros(len(starts), np.uint64)
    for k in range(width):
        inside = k < length
        total = np.where(inside, total * np.uint64(0x9FB21C651E98DF25) + h[np.minimum(starts + k, max(len(h) - 1, 0))], total) if len(h) else total
    total = mix(total + length.astype(np.uint64))
    order = np.lexsort((total, doc))
    total, doc = total[order], doc[order]
    new = np.ones(len(total), dtype=bool)
    new[1:] = (total[1:] != total[:-1]) | (doc[1:] != doc[:-1])
    return total[new], np.searchsorted(doc[new], np.arange(len(n) + 1))


def super_minhash(elements: np.ndarray, offsets: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """SuperMinHash signatures, a row of m registers (level << 32 | fraction) for each set; unset for an empty set.

    Every element has a random permutation of the registers and goes to register p(j) with j + a fraction, for j = 0,
    1, ...: the ranks within an element are correlated, which lowers the variance. Level j is taken for all sets at
    once; a set stops when every register has a value, since later ones are larger. p is the Fisher-Yates shuffle of
    swaps (i, q_i); p(j) is traced back through the swaps so far.
    """
    n_sets = len(offsets) - 1
    registers = np.full(n_sets * m, UNSET, dtype=np.uint64)
    of = np.repeat(np.arange(n_sets), np.diff(offsets))
    h, swaps = elements, []
    for j in range(m):
        if not len(h):
            break
        x = mix(h + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        q = j + ((x & np.uint64(0xFFFFFFFF)) * np.uint64(m - j) >> np.uint64(32)).astype(np.int16)
        at = q.copy()
        for i in range(j - 1, -1, -1):
            at = np.where(at == swaps[i], np.int16(i), at)
        cell = of * m + at
        free = registers[cell] >= np.uint64(j << 32)
        np.minimum.at(registers, cell[free], np.uint64(j << 32) | x[free] >> np.uint64(32))
        swaps.append(q)
        live = (registers.reshape(n_sets, m) == UNSET).any(axis=1)[of]
        if not live.all():
            h, of, swaps = h[live], of[live], [s[live] for s in swaps]
    return registers.reshape(n_sets, m)


SIGNED = "doc_id long, text_hash long, n_shingles long, node binary, sketch binary, bands array<bigint>"


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, n_shingles, node (md5 of the set), sketch (16 bits of each register), bands (a key for each
    band). Without words node, sketch and bands are null."""

    def sign(batches):
        for batch in batches:
            data, offsets = texts(batch.column(1))
            for i, j in sliced(offsets, 4 << 20):
                sets, at = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                full = np.diff(at) > 0
                registers = super_minhash(sets, at)
                sketch = (mix(registers) >> np.uint64(48)).astype("<u2")
                bands = np.zeros((j - i, REGISTERS // ROWS), np.uint64)
                for k in range(ROWS):
                    bands = mix(bands * np.uint64(31) + registers[:, k::ROWS])
                bands = mix(bands + np.arange(bands.shape[1], dtype=np.uint64)).view(np.int64)
                nodes = [hashlib.md5(sets[a:b].tobytes()).digest() if a < b else None for a, b in zip(at, at[1:], strict=False)]
                yield pa.record_batch([batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array(np.diff(at)), pa.array(nodes, pa.binary()), pa.array([x.tobytes() if f else None for x, f in zip(sketch, full, strict=True)], pa.binary()), pa.array([x if f else None for x, f in zip(bands, full, strict=True)], pa.list_(pa.int64()))], names=[x.split()[0] for x in SIGNED.split(", ")])

    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), text_hash(text).alias("text_hash")).mapInArrow(tidy(sign), SIGNED)


def text_hash(text) -> Column:
    """With the id, what names a row: rows of one id may differ in text."""
    return F.xxhash64(text)


def agreement(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs (a, b) with `estimate`, the share of registers that agree."""

    def rate(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = (texts(batch.column(k))[0].view("<u2").reshape(-1, REGISTERS) for k in (2, 3))
                yield pa.record_batch([batch.column(0), batch.column(1), pa.array((a == b).mean(axis=1))], names=["a", "b", "estimate"])

    own = sketches.select("node", "sketch")
    both = pairs.join(own.withColumnsRenamed({"node": "a", "sketch": "sa"}), "a").join(own.withColumnsRenamed({"node": "b", "sketch": "sb"}), "b")
    return both.select("a", "b", "sa", "sb").mapInArrow(tidy(rate), "a long, b long, estimate double")


def node_sets(asked: DataFrame, docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, items): the full sets of the nodes asked for, taken from their documents again, written."""
    wanted = nodes.select("node", F.col("low.doc_id").alias("__id"), F.col("low.text_hash").alias("__hash")).join(asked.select("node").distinct(), "node")

    def sets(batches):
        for batch in batches:
            data, offsets = texts(batch.column(0))
            for i, j in sliced(offsets, 4 << 20):
                found, at = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                yield pa.record_batch([batch.column(1).slice(i, j - i), binary(found.view(np.uint8), at * 8).cast(pa.binary())], names=["node", "items"])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), text.alias("text"), text_hash(text).alias("__hash")).alias("r")
    # a row meets the node that its own id and text stand for, however many rows share the id or have none
    own = F.col("r.__id").eqNullSafe(F.col("w.__id")) & (F.col("r.__hash") == F.col("w.__hash"))
    of_nodes = rows.join(wanted.alias("w"), own).select("text", "node").mapInArrow(tidy(sets), "node long, items binary").dropDuplicates(["node"])
    return written(of_nodes, "near-sets", "snappy")


def flat_sets(column) -> tuple[np.ndarray, np.ndarray]:
    """Sets in binary values, one after the other, and the offsets between them."""
    data, offsets = texts(column)
    return data.view("<u8"), offsets // 8


def confirmed(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """The pairs (a, b) for which 100 * intersection >= percent * union on the full sets."""
    asked = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    of_nodes = node_sets(asked, docs, nodes, id_col, text_col)

    def check(batches):
        for batch in batches:
            (x, of_x), (y, of_y) = (flat_sets(batch.column(k)) for k in (2, 3))
            keep = np.zeros(batch.num_rows, dtype=bool)
            for i in range(batch.num_rows):
                a, b = x[of_x[i] : of_x[i + 1]], y[of_y[i] : of_y[i + 1]]
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                both = int((b[at] == a).sum())
                keep[i] = 100 * both >= percent * (len(a) + len(b) - both)
            yield pa.record_batch(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep))

    both = pairs.select("a", "b").join(of_nodes.withColumnsRenamed({"node": "a", "items": "xa"}), "a").join(of_nodes.withColumnsRenamed({"node": "b", "items": "xb"}), "b")
    return both.select("a", "b", "xa", "xb").mapInArrow(tidy(check), "a long, b long")


def components(links: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, root): union-find over links (a, b) as rounds of hooking and path halving; nodes without links are absent.

    Every round lets a node take the least root of its neighbours and then its root's root, until nothing changes.
    """
    spark = links.sparkSession
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "near-links")
    if both.isEmpty():
        return both.select(F.col("a").alias("node"), F.col("b").alias("root"))
    state = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "node")
    state = written(state, "near-roots")
    for _ in range(rounds):
        # hook: the least root among neighbours goes to the node and to the node's present root
        near = both.join(state.withColumnsRenamed({"node": "b", "root": "other"}), "b").groupBy("a").agg(F.min("other").alias("other"))
        met = state.join(near, state["node"] == near["a"]).select("node", "root", F.least("root", "other").alias("new"))
        hooks = met.where("new < root").groupBy(F.col("root").alias("h")).agg(F.min("new").alias("to"))
        taken = met.join(hooks, met["root"] == hooks["h"], "left").select("node", F.col("root").alias("old"), F.least("new", F.coalesce("to", "new")).alias("root"))
        # halve: follow the root's own root
        up = taken.select(F.col("node").alias("r"), F.col("root").alias("above"))
        after = written(taken.join(up, taken["root"] == up["r"], "left").select("node", "old", F.least("root", F.coalesce("above", "root")).alias("root")), "near-roots")
        state = after.select("node", "root")
        if after.where("old <> root").isEmpty():
            return state
    raise RuntimeError("the components did not settle")


def row_groups(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text", least_estimate: float = LEAST_ESTIMATE) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, and `first`: whether the row has the id and text of the group's first
    row, by id (null last), then by hash of the text. See near_groups.
    """
    signed = written(signatures(docs, id_col, text_col), "near-signatures")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    nodes = signed.where("node is not null").groupBy(F.col("node").alias("md5")).agg(F.min(order).alias("low"), F.first("n_shingles").alias("size"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands"))
    # nodes have numbers, which are fixed by this table, so that what follows joins and groups by whole numbers
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "near-nodes")
    keys = nodes.select("node", F.explode("bands").alias("key"))
    hubs = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("hub")).where("n > 1")
    # each node with the hubs of its buckets: nodes of one bucket have a hub in common
    stars = keys.join(hubs.select("key", "hub"), "key").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    stars = written(agreement(written(stars, "near-stars"), nodes), "near-rated")
    near = stars.where(F.col("estimate") >= least_estimate)
    # first each node with the hub it agrees with most
    best = near.groupBy("a").agg(F.max_by("b", F.struct("estimate", "b")).alias("b"))
    roots = components(written(confirmed(best, docs, nodes, id_col, text_col, percent), "near-confirmed"))
    # then the pairs of a hub and its nodes that are still apart, as links between what they belong to
    found = written(between(stars, roots, docs, nodes, id_col, text_col, percent, least_estimate), "near-between")
    if not found.isEmpty():
        above = components(found).select(F.col("node").alias("root"), F.col("root").alias("top"))
        below = roots.unionByName(above.select(F.col("root").alias("node"), "root")).distinct()
        roots = below.join(above, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    least = nodes.select("node", "md5", "low").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = least.groupBy("root").agg(F.min("low").alias("top"))
    named = written(least.join(names, "root").select("md5", "top"), "near-named")
    out = signed.select("doc_id", "text_hash", "n_shingles", "node").join(named, F.col("node") == F.col("md5"), "left")
    first = F.coalesce(F.col("top.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("top.text_hash") == F.col("text_hash")), F.lit(True))
    return out.select("doc_id", "text_hash", "n_shingles", F.coalesce("top.doc_id", "doc_id").alias("component_id"), first.alias("first"))


def near_groups(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text", least_estimate: float = LEAST_ESTIMATE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row.

    Rows whose sets have 100 * intersection >= percent * union are linked; component_id is the least id that links
    reach. Sets are of 64-bit hashes of shingles, whole ones. Candidates are pairs that share a band of registers;
    those whose signatures agree in less than least_estimate are not confirmed (0: all candidates are). Null and empty
    texts and texts without words have no shingles and no links; equal rows have equal sets and are linked; rows of one
    id and different texts stand for themselves. An empty table gives no row. A null id is taken for no id: it never
    names a component unless all are null. Further columns play no part.
    """
    found = row_groups(docs, percent, id_col, text_col, least_estimate)
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def first_of_groups(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of every group of near-duplicates one row, with the columns of docs: that of the least id (null last; of one id,
    of the least hash of the text). Rows without words all stay. Equal rows are one group."""
    keys = {"doc_id": "__of", "text_hash": "__hash_of"}
    with temporary_tables(docs.sparkSession) as tables:
        found = written(row_groups(docs, percent, id_col, text_col).where("n_shingles > 0"), "near-rows")
        gone = tables.keep(written(found.where("not first").select("doc_id", "text_hash").distinct().withColumnsRenamed(keys), "near-gone"))
        # rows equal in id and text are one group, which no key tells apart
        again = tables.keep(written(found.where("first").groupBy("doc_id", "text_hash").count().where("count > 1").select("doc_id", "text_hash").withColumnsRenamed(keys), "near-again"))
    columns, text = docs.columns, F.col(text_col).cast("string")
    rows = docs.select(*columns, F.col(id_col).cast("long").alias("__id"), text_hash(text).alias("__hash"))
    same = F.col("__id").eqNullSafe(F.col("__of")) & (F.col("__hash") == F.col("__hash_of"))
    rows = rows.join(gone, same, "left_anti")
    if again.isEmpty():
        return rows.select(*columns)
    once = rows.join(again, same, "left_semi").dropDuplicates(["__id", "__hash"])
    return rows.join(again, same, "left_anti").unionByName(once).select(*columns)


def chunked(members: DataFrame) -> DataFrame:
    """Rows (hub, node, weight, ...) of hubs, cut by a hash of the node into chunks of about CHUNK rows and CHUNK_BYTES
    of weight, for every pair of chunks (x, y) that has the row's own chunk: a hub's nodes meet two chunks at a time."""
    n = F.count("*")
    chunks = F.greatest(F.ceil(n / CHUNK), F.least(F.ceil(n / SMALL_CHUNK), F.lit(SMALL_CHUNKS)), F.ceil(F.sum("weight") / CHUNK_BYTES))
    # most hubs are one chunk; the others are in a table, so that the join can split a large hub's rows
    sizes = written(members.groupBy("hub").agg(chunks.alias("chunks")).where("chunks > 1"), "near-chunks")
    rows = members.join(sizes, "hub", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), "chunks"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    return rows.withColumns({"x": F.least("own", "other"), "y": F.greatest("own", "other")}).drop("other", "chunks", "weight")


def candidates(table: pa.Table, least_estimate: float = LEAST_ESTIMATE):
    """Nodes, their components, and for each node of chunk x the nodes of chunk y in another component whose sketches
    agree in least_estimate of the registers."""
    own, x, y = (table.column(c).to_numpy() for c in ("own", "x", "y"))
    node = np.array(table.column("node").to_pylist(), dtype=object)
    root = np.unique(np.array(table.column("root").to_pylist(), dtype=object), return_inverse=True)[1]
    sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), "<u2").reshape(-1, REGISTERS)
    left, right = np.flatnonzero(own == x), np.flatnonzero(own == y)

    def near():
        for i in left:
            others = right[root[right] != root[i]] if x[0] != y[0] else right[(root[right] != root[i]) & (right > i)]
            if len(others):
                yield i, others[(sketch[others] == sketch[i]).mean(axis=1) >= least_estimate]

    return node, root, near()


def between(stars: DataFrame, roots: DataFrame, docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, percent: int, least_estimate: float) -> DataFrame:
    """Confirmed links between components among the nodes that share a hub, as many as it takes to join them.

    Links are of components: a and b are roots. Most hubs' nodes are one component and drop out. Of the others, sketches tell which nodes have a candidate in
    another component; these meet again with their full sets, and the pairs are confirmed in the task, which gives a
    link only where it joins what was apart: rows grow with the nodes, not with the pairs.
    """
    members = stars.select(F.col("b").alias("hub"), F.col("a").alias("node")).unionByName(stars.select(F.col("b").alias("hub"), F.col("b").alias("node")).distinct())
    named = written(members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "near-members")
    mixed = written(named.groupBy("hub").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("hub"), "near-mixed")
    rows = chunked(written(named.join(mixed, "hub").withColumn("weight", F.lit(0)), "near-apart")).join(nodes.select("node", "sketch"), "node")

    def involved(table: pa.Table) -> pa.Table:
        node, _, near = candidates(table, least_estimate)
        hit = np.zeros(len(node), dtype=bool)
        for i, others in near:
            hit[others] = True
            hit[i] |= len(others) > 0
        return table.select(["hub", "node", "root"]).filter(pa.array(hit))

    some = written(rows.groupBy("hub", "x", "y").applyInArrow(tidy(involved), "hub long, node long, root long").distinct(), "near-involved")
    weighed = written(some.join(nodes.select("node", (F.col("size") * 8).alias("weight")), "node"), "near-weighed")
    full = chunked(weighed).join(nodes.select("node", "sketch"), "node").join(node_sets(some, docs, nodes, id_col, text_col), "node")

    def join(table: pa.Table) -> pa.Table:
        node, root, near = candidates(table, least_estimate)
        names = table.column("root").to_numpy()
        items, at = flat_sets(table.column("items"))
        sizes, links = np.diff(at), []
        for i, others in near:
            others = others[root[others] != root[i]]
            if not len(others):
                continue
            own, flat = items[at[i] : at[i + 1]], items[ragged(at[others], sizes[others])]
            hit = own[np.minimum(np.searchsorted(own, flat), sizes[i] - 1)] == flat
            both = np.add.reduceat(hit.astype(np.int64), np.cumsum(sizes[others]) - sizes[others])
            for k in others[100 * both >= percent * (sizes[i] + sizes[others] - both)]:
                if root[k] != root[i]:
                    root[root == root[k]] = root[i]
                    links.append((names[i], names[k]))
        return pa.table([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return full.groupBy("hub", "x", "y").applyInArrow(tidy(join), "a long, b long")


def op4_near_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    return near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
