"""Language-model scoring by deleted interpolation.

Counts of all n-grams follow the corpus. Blocks of documents send their distinct n-gram keys with the block's counts
to shards by ranges of the key; a shard adds them up and answers every block with the counts of its keys. A frequent
n-gram is thus one key a block, whatever its frequency, and neither the driver nor a task holds the whole model.

P_k(w | context) = L * c(context w) / c(context) + (1 - L) * P_(k-1)(w | shorter context), down to a uniform 1 / (V + 1).
L depends on the order and on the bucket (power of two) of c(context). It is learned by expectation-maximisation on
the counts of held-out training documents against the counts of the other training documents; scores then use the
counts of all training documents.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scribemill.llm._arrays import NOT_SPACE, coded, hash_binary, mix, shard_runs, tidy, words
from scribemill.llm._shared import BLOCK_BYTES, block_texts, blocks, rows_of, written

END, BOS = np.uint64(0x452821E638D01377), np.uint64(0xBE5466CF34E90C6C)
BOS_KEY = np.uint64(0x243F6A8885A308 & ~7)
BUCKETS = 40
#: fixed weights where no held-out document teaches them
DEFAULT_WEIGHT = 0.5
ROUNDS = 30
#: ratios count as equal for the weights if their logarithms to base 2 round to the same half
STEPS = 2


def remainder(doc_id: int | None, n: int) -> int:
    """crc32 of the id as text, modulo n; a null id is an empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n


def tokens(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """56-bit keys of the n-grams that end at each token, for orders 1 to `order`; and the token offsets of the texts.

    Every text's words are followed by an end token and preceded by as many start tokens as a context needs.
    """
    found, firsts = words(data, offsets, NOT_SPACE)
    codes, distinct = coded(found)
    n_docs = len(firsts) - 1
    at = firsts + np.arange(n_docs + 1)
    token = np.full(at[-1], END, dtype=np.uint64)
    plain = np.ones(at[-1], dtype=bool)
    plain[at[1:] - 1] = False
    token[plain] = hash_binary(distinct)[codes] if len(codes) else token[plain]
    place = np.arange(at[-1]) - np.repeat(at[:-1], np.diff(at))
    keys, h = [], mix(token)
    for k in range(order):
        if k:
            back = np.full(len(token), BOS, dtype=np.uint64)
            back[k:] = np.where(place[k:] >= k, token[:-k], BOS)
            h = mix(h * np.uint64(0x9FB21C651E98DF25) + back)
        keys.append((h >> np.uint64(8)) & ~np.uint64(7) | np.uint64(k))
    return keys, at


def packed(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(x.tobytes())


def unpacked(x: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), kind)


def packed_counts(x: np.ndarray) -> bytes:
    """Counts in 4 bytes each, or in 8 where one needs them."""
    width = 4 if x.max(initial=0) < 1 << 32 else 8
    return bytes([width]) + packed(x.astype(f"<u{width}"))


def unpacked_counts(x: bytes) -> np.ndarray:
    return unpacked(x[1:], f"<u{x[0]}")


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending 56-bit keys as differences of as few bytes as the largest takes."""
    steps = np.diff(keys, prepend=np.uint64(0))
    width = max(1, (int(steps.max(initial=np.uint64(0))).bit_length() + 7) // 8)
    return bytes([width]) + steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpacked_keys(x: bytes) -> np.ndarray:
    body = np.frombuffer(x, np.uint8, offset=1).reshape(-1, x[0])
    out = np.zeros((len(body), 8), np.uint8)
    out[:, : x[0]] = body
    return np.cumsum(out.view("<u8")[:, 0], dtype=np.uint64)


def block_keys(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """The ascending distinct keys that a block asks for, the places among them of its n-grams' keys (a row an order),
    and that of the start."""
    sent, at = np.unique(np.concatenate([*keys, np.array([BOS_KEY])]), return_inverse=True)
    return sent, at[:-1].reshape(len(keys), -1), int(at[-1])


REQUESTS = "shard int, block long, part int, keys binary, counts binary"


def requests(docs_blocks: DataFrame, n_shards: int, order: int, train_mod: int, em_remainder: int) -> DataFrame:
    """Rows (shard, block, part, keys, counts). Part 0: keys of all documents, with counts in estimation and in
    held-out training documents; part 1: keys of the held-out training documents, to be answered only."""

    def ask(batches):
        for batch in batches:
            for row in rows_of(batch):
                data, offsets = block_texts(row)
                keys, at = tokens(data, offsets, order)
                kind = np.array([remainder(x, train_mod) for x in row["ids"]], np.int64)
                tuned = kind == em_remainder
                fit = (kind != 0) & ~tuned
                of = np.repeat(np.arange(len(kind)), np.diff(at))
                sent, places, start = block_keys(keys)
                counts = np.zeros((2, len(sent)), "<u4")
                for c, chosen in enumerate((fit, tuned)):
                    counts[c] = np.bincount(places[:, chosen[of]].ravel(), minlength=len(sent))
                    counts[c, start] = chosen.sum()
                parts = [(0, sent, counts)]
                if tuned.any():
                    asked = np.zeros(len(sent), dtype=bool)
                    asked[places[:, tuned[of]].ravel()] = asked[start] = True
                    parts.append((1, sent[asked], None))
                out = []
                for part, own, c in parts:
                    out += [(s, row["block"], part, packed_keys(own[a:b]), b"" if c is None else packed(c[:, a:b])) for s, a, b in shard_runs(own, n_shards, 56)]
                yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["shard", "block", "part", "keys", "counts"])

    return docs_blocks.mapInArrow(tidy(ask), REQUESTS)


ANSWERS = "block long, part int, shard int, counts binary, n_fit long, n_all long, v_fit long, v_all long"


def answers(asked: DataFrame) -> DataFrame:
    """A row (block, part, shard, counts) for each request: for its keys, in order, counts in the estimation documents
    and in all training documents. One row per shard (block null) has its tokens and distinct tokens of both."""

    def add(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own = [unpacked_keys(x["keys"]) for x in rows]
        # part 1 asks for keys of part 0 of the same block
        known, at = np.unique(np.concatenate(own), return_inverse=True)
        at = np.split(at, np.cumsum([len(k) for k in own])[:-1])
        total = np.zeros((2, len(known)), np.int64)
        for k, x in zip(at, rows, strict=True):
            if x["part"] == 0:
                fit, tuned = unpacked(x["counts"], "<u4").reshape(2, -1)
                total[0, k] += fit
                total[1, k] += fit.astype(np.int64) + tuned
        single = ((known & np.uint64(7)) == 0) & (known != BOS_KEY)
        sums = [int(total[0, single].sum()), int(total[1, single].sum()), int((total[0, single] > 0).sum()), int((total[1, single] > 0).sum())]
        out = [(x["block"], x["part"], x["shard"], packed_counts(total[:, k]), 0, 0, 0, 0) for k, x in zip(at, rows, strict=True)]
        out.append((None, 0, rows[0]["shard"], b"", *sums))
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), *[pa.int64()] * 4)
        return pa.table([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["block", "part", "shard", "counts", "n_fit", "n_all", "v_fit", "v_all"])

    return asked.groupBy("shard").applyInArrow(tidy(add), ANSWERS)


def token_counts(keys: list[np.ndarray], at: np.ndarray, answer: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each order: [counts of the n-gram], [counts of its context] at every token; two rows each: fit, all."""
    _, places, start = block_keys(keys)
    shards = answer.column("shard").to_numpy()
    parts = answer.column("counts").to_pylist()
    counts = np.concatenate([unpacked_counts(parts[k]).reshape(2, -1) for k in np.argsort(shards)], axis=1).astype(np.float64)
    first = np.zeros(len(keys[0]), dtype=bool)
    first[at[:-1]] = True
    starts = counts[:, start][:, None]
    grams = [counts[:, k] for k in places]
    contexts = [None]
    for k in range(1, len(keys)):
        c = np.empty_like(grams[0])
        c[:, 1:] = grams[k - 1][:, :-1]
        c[:, first] = starts
        contexts.append(c)
    return grams, contexts


def bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(context + 1).astype(np.int64), BUCKETS - 1)


def ratios(grams, contexts, row: int, n: int, v: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Maximum-likelihood estimates and buckets for each order."""
    ml = [grams[0][row] / max(n, 1)]
    at = [np.zeros(len(ml[0]), np.int64)]
    for g, c in zip(grams[1:], contexts[1:], strict=True):
        ml.append(g[row] / np.maximum(c[row], 1))
        at.append(bucket(c[row]))
    return ml, at


def probability(ml: list[np.ndarray], at: list[np.ndarray], weights: np.ndarray, v: int) -> np.ndarray:
    p = np.full(len(ml[0]), 1 / (v + 1))
    for k in range(len(ml)):
        share = weights[k, at[k]]
        p = share * ml[k] + (1 - share) * p
    return p


def learn(rows: list[tuple], order: int, v: int) -> np.ndarray:
    """Weights by order and bucket. rows: (buckets of orders 2 and up, rounded log-ratios of all orders, count)."""
    weights = np.full((order, BUCKETS), DEFAULT_WEIGHT)
    if not rows:
        return weights
    at = np.column_stack([np.zeros(len(rows), np.int64), np.array([r[0] for r in rows]).reshape(len(rows), order - 1)]).astype(int)
    level = np.array([r[1] for r in rows], dtype=float)
    ml = np.where(level > -1000, np.exp2(np.minimum(level / STEPS, 0)), 0)
    n = np.array([r[2] for r in rows], dtype=float)
    for _ in range(ROUNDS):
        below = [np.full(len(rows), 1 / (v + 1))]
        for k in range(order):
            share = weights[k, at[:, k]]
            below.append(share * ml[:, k] + (1 - share) * below[-1])
        reach = n.copy()
        for k in range(order - 1, -1, -1):
            took = reach * weights[k, at[:, k]] * ml[:, k] / below[k + 1]
            all_, own = np.bincount(at[:, k], reach, BUCKETS), np.bincount(at[:, k], took, BUCKETS)
            weights[k] = np.where(all_ > 0, np.clip(own / np.maximum(all_, 1e-300), 1e-6, 1 - 1e-6), weights[k])
            reach = reach - took
    return weights


def score(docs: DataFrame, order: int = 2, train_mod: int = 10, em_remainder: int = 1, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Score every text with a model learned from those whose crc32 of the id modulo train_mod is not 0.

    The training documents of remainder em_remainder are held out for the mixture weights. Null and empty texts are
    one end token; equal rows each count and each get a row; a null id counts as an empty text's crc32 (held out);
    without training documents every token has the uniform probability; an empty table gives no row. Columns: doc_id,
    held_out, n_tokens, n_known, train_tokens, base_score (add-0.1 unigrams), score.
    """
    packs = written(blocks(docs, id_col, text_col, block_bytes), "lm-blocks")
    n_shards = max(16, packs.count() // 2)
    answered = written(answers(requests(packs, n_shards, order, train_mod, em_remainder)), "lm-counts")
    n_fit, n_all, v_fit, v_all = (x or 0 for x in answered.where(F.col("block").isNull()).agg(*(F.sum(c) for c in ("n_fit", "n_all", "v_fit", "v_all"))).first())
    answered = answered.where(F.col("block").isNotNull())

    def only_tuned(batches):
        for batch in batches:
            for row in rows_of(batch):
                data, offsets = block_texts(row)
                kept = [i for i, x in enumerate(row["ids"]) if remainder(x, train_mod) == em_remainder]
                if kept:
                    parts = [data[offsets[i] : offsets[i + 1]].tobytes() for i in kept]
                    yield pa.record_batch([pa.array([row["block"]], pa.int64()), pa.array([[row["ids"][i] for i in kept]], pa.list_(pa.int64())), pa.array([np.cumsum([len(x) for x in parts]).astype("<i8").tobytes()], pa.binary()), pa.array([b"".join(parts)], pa.binary())], names=["block", "ids", "ends", "data"])

    def histogram(pack: pa.Table, answer: pa.Table) -> pa.Table:
        rows: dict = {}
        for row in pack.to_pylist():
            keys, at = tokens(*block_texts(row), order)
            ml, buckets = ratios(*token_counts(keys, at, answer), 0, n_fit, v_fit)
            levels = [np.where(x > 0, np.rint(np.log2(np.maximum(x, 1e-300)) * STEPS), -2000) for x in ml]
            grid, n = np.unique(np.column_stack([*buckets[1:], *levels]).astype(np.int64), axis=0, return_counts=True)
            for g, c in zip(grid.tolist(), n.tolist(), strict=True):
                rows[tuple(g)] = rows.get(tuple(g), 0) + c
        return pa.table([pa.array([list(g) for g in rows], pa.list_(pa.int64())), pa.array(list(rows.values()), pa.int64())], names=["cell", "n"])

    cells = packs.mapInArrow(tidy(only_tuned), packs.schema).groupBy("block").cogroup(answered.where("part = 1").groupBy("block")).applyInArrow(tidy(histogram), "cell array<bigint>, n long")
    # the grid of buckets and rounded ratios bounds the rows that reach the driver
    found = [(r["cell"][: order - 1], r["cell"][order - 1 :], r["n"]) for r in cells.groupBy("cell").agg(F.sum("n").alias("n")).collect()]
    weights = learn(found, order, v_fit)

    def rate(pack: pa.Table, answer: pa.Table) -> pa.Table:
        out = []
        for row in pack.to_pylist():
            keys, at = tokens(*block_texts(row), order)
            grams, contexts = token_counts(keys, at, answer)
            ml, buckets = ratios(grams, contexts, 1, n_all, v_all)
            base = np.log10((grams[0][1] + 0.1) / (n_all + 0.1 * (v_all + 1)))
            full = np.log10(probability(ml, buckets, weights, v_all))
            known = (grams[0][1] > 0).astype(np.int64)
            n = np.diff(at)
            base, full, known = (np.add.reduceat(x, at[:-1]) for x in (base, full, known))
            out.append(pa.table([pa.array(row["ids"], pa.int64()), pa.array([remainder(x, train_mod) == 0 for x in row["ids"]], pa.bool_()), pa.array(n), pa.array(known), pa.array([n_all] * len(n), pa.int64()), pa.array(base), pa.array(full)], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]))
        return pa.concat_tables(out)

    return packs.groupBy("block").cogroup(answered.where("part = 0").groupBy("block")).applyInArrow(tidy(rate), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op7_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """The contract's columns for every document."""
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
