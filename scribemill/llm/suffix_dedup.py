"""Removal of long repeated byte strings by hash-compared suffix sorting.

Every string of LENGTH bytes has an anchor: the place, within it, of the least hash of KGRAM bytes. Equal strings have
equal anchors at equal offsets, so only strings whose anchors' KGRAM bytes occur at two places need comparing. For
those anchors the surroundings go to the shard of the anchor's hash, where the suffixes that begin at the strings'
starts are sorted: prefix polynomial hashes and a binary search give the common extension of two suffixes, a
mergesort orders them, and neighbours that agree in LENGTH bytes are compared byte for byte before they count.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scribemill.llm._arrays import INVERSE, mix, powers, prefix_hashes, ragged, range_hashes, shard_runs, sliced, tidy
from scribemill.llm._shared import BLOCK_BYTES, block_texts, blocks, rows_of, written

LENGTH, KGRAM = 200, 64


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the least value (the first of equal ones) among values[i : i + width], for every i.

    Values are compared by their upper 32 bits; the lower ones hold the place while minima of spans are doubled, and at
    last those of two spans that overlap.
    """
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, span = values & np.uint64(0xFFFFFFFF00000000) | np.arange(len(values), dtype=np.uint64), 1
    while span * 2 <= width:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    return (np.minimum(best[:n], best[width - span : width - span + n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)


#: bytes that are hashed at a time, but for longer texts
PIECE = 1 << 20


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, kgram: int = KGRAM) -> tuple[np.ndarray, ...]:
    """(anchor, first start, last start + 1, hash, hash of its surroundings): the anchors in order, and the string
    starts that each serves."""
    none = np.zeros(0, np.int64)
    found = [(none, none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint64))]
    for i, j in sliced(offsets, PIECE):
        if offsets[j] - offsets[i] >= length:
            place, first, last, h, whole = piece_anchors(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], length, kgram)
            found.append((place + offsets[i], first + offsets[i], last + offsets[i], h, whole))
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def piece_anchors(data: np.ndarray, offsets: np.ndarray, length: int, kgram: int) -> tuple[np.ndarray, ...]:
    prefix = prefix_hashes(data)
    values = prefix[kgram:] - prefix[:-kgram]
    values *= powers(len(values), INVERSE)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    starts = ragged(offsets[:-1], np.maximum(np.diff(offsets) - length + 1, 0))
    place = window_minima(values, length - kgram + 1)[starts]
    new = np.ones(len(place), dtype=bool)
    # an anchor serves consecutive starts; a gap (a text's end) begins another run
    new[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
    begin = np.flatnonzero(new)
    place, first, last = place[begin], starts[begin], starts[np.append(begin[1:], len(place)) - 1] + 1
    # a least value is small: mixed, they spread over all shards
    return place, first, last, mix(values[place]), surroundings_hash(prefix, place - first, first, last - 1 + length)


def surroundings_hash(prefix: np.ndarray, offset: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Of the bytes [first, end) and the anchor's place among them."""
    return mix(range_hashes(prefix, first, end) ^ mix(offset.astype(np.uint64) << np.uint64(20) | (end - first).astype(np.uint64)))


#: an anchor's hash that so many places have, over all texts, is a hot one
HOT = 200  # a block says of no more than 255


def contained(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each value is one of the known ones, which ascend."""
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def served_starts(served: tuple, hot: np.ndarray, prefix: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The starts that anchors of hot hashes serve: the anchors' numbers, the starts, and hashes of the strings there."""
    _, first, last, h, _ = served
    own = np.flatnonzero(contained(h, hot))
    n = last[own] - first[own]
    starts = ragged(first[own], n)
    return np.repeat(own, n), starts, mix(range_hashes(prefix, starts, starts + length))


class Busy(NamedTuple):
    """Hashes, ascending: of hot anchors, of strings of theirs that are met twice over all texts, and of those of them
    that are met HOT times."""

    anchors: np.ndarray
    strings: np.ndarray
    hot_strings: np.ndarray


def narrowed(data: np.ndarray, served: tuple, busy: Busy, length: int) -> tuple:
    """The anchors, those of hot hashes parted by how often their strings are met.

    Around a passage that many texts share, an anchor at its edge has other bytes in each text. Strings that are met
    once go. Runs of strings that are met HOT times or more stay with the anchor: they are within the passage and alike, so
    that a block sends them once, whatever the number of texts. Each other string becomes an anchor by itself, with its
    own hash in the place of the anchor's, so that only equal strings meet.
    """
    place, first, last, h, whole = served
    hot = contained(h, busy.anchors)
    if not hot.any():
        return served
    prefix = prefix_hashes(data)
    member, starts, names = served_starts(served, busy.anchors, prefix, length)
    most = contained(names, busy.hot_strings)
    some = np.flatnonzero(contained(names, busy.strings) & ~most)
    at = np.flatnonzero(most)
    new = np.ones(len(at), dtype=bool)
    new[1:] = (member[at][1:] != member[at][:-1]) | (at[1:] != at[:-1] + 1)
    begin = np.flatnonzero(new)
    end = at[np.append(begin[1:], len(at)) - 1] if len(at) else at
    begin = at[begin]
    one, low, high = (np.concatenate(x) for x in ((member[begin], member[some]), (starts[begin], starts[some]), (starts[end] + 1, starts[some] + 1)))
    key = np.concatenate([h[member[begin]], names[some]])
    rest = np.flatnonzero(~hot)
    around = surroundings_hash(prefix, place[one] - low, low, high - 1 + length)
    return tuple(np.concatenate(x) for x in ((place[rest], place[one]), (first[rest], low), (last[rest], high), (h[rest], key), (whole[rest], around)))


class Suffixes:
    """Suffixes of a byte array, cut at `length` bytes, compared by prefix hashes."""

    def __init__(self, data: np.ndarray, length: int = LENGTH):
        self.data, self.length = data, length
        self.prefix = prefix_hashes(data, 5)

    def hashes(self, at: np.ndarray, n) -> np.ndarray:
        return range_hashes(self.prefix, at, at + n)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes that the suffixes at a and b have in common, `length` at most: a binary search on hashes."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.length, np.int64)
        whole = self.hashes(a, self.length) == self.hashes(b, self.length)
        low[whole] = self.length
        open_ = np.flatnonzero(~whole)
        high[open_] -= 1
        while len(open_):
            middle = (low[open_] + high[open_] + 1) >> 1
            same = self.hashes(a[open_], middle) == self.hashes(b[open_], middle)
            low[open_[same]] = middle[same]
            high[open_[~same]] = middle[~same] - 1
            open_ = open_[low[open_] < high[open_]]
        return low

    def before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the suffix at a comes first (equal ones: yes)."""
        n = self.common(a, b)
        inside = np.minimum(n, self.length - 1)
        return (n == self.length) | (self.data[a + inside] <= self.data[b + inside])

    def sort(self, at: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Order of the suffixes `at` within ascending segments: a bottom-up mergesort, all merges of a pass at once.

        A suffix's place in a merge is its place in its own run plus the number of the other run's suffixes before
        it, which a binary search over that run finds.
        """
        order = np.arange(len(at))
        begin = np.searchsorted(segment, segment)
        end = np.searchsorted(segment, segment, side="right")
        width, most = 1, int((end - begin).max(initial=1))
        while width < most:
            pos = np.arange(len(at))
            run = (pos - begin) // width
            mine = begin + run * width
            other = np.where(run % 2 == 0, mine + width, mine - width)
            other_end = np.minimum(other + width, end)
            other = np.minimum(other, end)
            low, high = other.copy(), np.maximum(other_end, other)
            right = run % 2 == 1
            live = np.flatnonzero(low < high)
            while len(live):
                middle = (low[live] + high[live]) >> 1
                x, y = at[order[live]], at[order[middle]]
                # ties keep the left run first
                later = np.where(right[live], self.before(y, x), ~self.before(x, y))
                low[live[later]] = middle[later] + 1
                high[live[~later]] = middle[~later]
                live = live[low[live] < high[live]]
            target = np.minimum(mine, np.where(right, mine - width, mine)) + (pos - mine) + (low - other)
            merged = np.empty_like(order)
            merged[target] = order
            order, width = merged, width * 2
        return order

    def repeated(self, at: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Which of the strings of `length` bytes at `at` (segments ascending) occur twice within their segment."""
        order = self.sort(at, segment)
        x, y = at[order[:-1]], at[order[1:]]
        near = np.flatnonzero((segment[order[:-1]] == segment[order[1:]]) & (self.hashes(x, self.length) == self.hashes(y, self.length)))
        same = np.zeros(len(near), dtype=bool)
        for k in range(0, len(near), 20_000):  # the collision check, byte for byte
            i = near[k : k + 20_000]
            same[k : k + 20_000] = (self.data[x[i][:, None] + np.arange(self.length)] == self.data[y[i][:, None] + np.arange(self.length)]).all(axis=1)
        out = np.zeros(len(at), dtype=bool)
        out[order[near[same]]] = out[order[near[same] + 1]] = True
        return out


def repeated_runs(data: np.ndarray, h: np.ndarray, offset: np.ndarray, size: np.ndarray, members: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(row, first, end): runs of starts, within a row's surroundings, of strings that occur twice.

    Rows are surroundings one after the other in data: the anchor's hash h, its offset, the size, and the number of
    places with just these bytes. Only strings of equal h and equal distance to the anchor can be equal.
    """
    at = np.cumsum(size) - size
    # equal surroundings are sorted once, with the sum of their places
    whole = surroundings_hash(prefix_hashes(data, 9), offset, at, at + size)
    order = np.lexsort((whole, h))
    same = np.zeros(len(order), dtype=bool)
    a, b = order[:-1], order[1:]
    near = np.flatnonzero((h[a] == h[b]) & (whole[a] == whole[b]) & (size[a] == size[b]) & (offset[a] == offset[b]))
    view = memoryview(data)
    same[near + 1] = [view[at[i] : at[i] + size[i]] == view[at[j] : at[j] + size[j]] for i, j in zip(a[near], b[near], strict=True)]
    name = np.empty(len(order), np.int64)
    name[order] = np.cumsum(~same) - 1
    n_kinds = int((~same).sum())
    total = np.bincount(name, members, n_kinds).astype(np.int64)
    one = order[~same]  # a row of each kind
    # a kind's strings start at its bytes 0 .. size - length
    n_starts = size[one] - length + 1
    kind = np.repeat(np.arange(n_kinds), n_starts)
    start = ragged(np.zeros(n_kinds, np.int64), n_starts)
    answer = total[kind] > 1
    # all kinds of a key are compared if one of them has a single place
    key = np.unique(h[one], return_inverse=True)[1]
    keys = np.unique(key[total == 1])
    part = np.isin(key, keys[np.bincount(key)[keys] > 1])
    i = np.flatnonzero(part[kind])
    segment = key[kind[i]] * (4 * length) + (offset[one][kind[i]] - start[i]) + length
    by = np.argsort(segment, kind="stable")
    i, segment = i[by], segment[by]
    several = np.searchsorted(segment, segment, side="right") - np.searchsorted(segment, segment) > 1
    i, segment = i[several], segment[several]
    if len(i):
        suffixes, begin = Suffixes(data, length), 0
        while begin < len(i):
            stop = int(np.searchsorted(segment, segment[min(begin + 300_000, len(i)) - 1], side="right"))
            own = i[begin:stop]
            answer[own] |= suffixes.repeated(at[one][kind[own]] + start[own], segment[begin:stop])
            begin = stop
    ends = np.zeros(len(answer), dtype=bool)
    ends[np.cumsum(n_starts) - n_starts] = True  # where a kind's starts begin
    up = np.flatnonzero(answer & (np.append(False, ~answer[:-1]) | ends))
    down = np.flatnonzero(answer & (np.append(~answer[1:], True) | np.append(ends[1:], True)))
    run_kind = kind[up]
    lo, hi = np.searchsorted(run_kind, name), np.searchsorted(run_kind, name, side="right")
    which = ragged(lo, hi - lo)
    return np.repeat(np.arange(len(name)), hi - lo), start[up][which], start[down][which] + 1


def repeats(docs_blocks: DataFrame, n_shards: int, length: int, kgram: int, hot: int) -> DataFrame:
    """(block, keys, runs, kind): of anchors' surroundings in a block the runs of starts of strings that also start
    anywhere else (kind 0), and what narrows anchors (1, 2, 3: see Busy)."""

    def keys(batches):
        for batch in batches:
            for row in rows_of(batch):
                h = anchors(*block_texts(row), length, kgram)[3]
                known, n = np.unique(h, return_counts=True)
                yield from counted(row["block"], known, n)

    def counted(block: int, known: np.ndarray, n: np.ndarray):
        """Rows of a block's keys with the numbers of their places, by shard; 255 stand for more."""
        out = [(s, block, known[i:j].tobytes(), np.minimum(n[i:j], 255).astype(np.uint8).tobytes()) for s, i, j in shard_runs(known, n_shards)]
        if out:
            yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["shard", "block", "keys", "places"])

    def met(table: pa.Table) -> pa.Table:
        """Of each block's keys those that have two places over all blocks, and which of these are hot."""
        rows = table.to_pylist()
        own = [np.frombuffer(x["keys"], "<u8") for x in rows]
        known, at = np.unique(np.concatenate(own), return_inverse=True)
        total = np.bincount(at, np.frombuffer(b"".join(x["places"] for x in rows), np.uint8), len(known))
        out, first = [], 0
        for x, k in zip(rows, own, strict=True):
            n = total[at[first : first + len(k)]]
            first += len(k)
            if (n > 1).any():
                out.append((x["block"], k[n > 1].tobytes(), k[n >= hot].tobytes()))
        return pa.table([pa.array([x[c] for x in out], t) for c, t in enumerate((pa.int64(), pa.binary(), pa.binary()))], names=["block", "keys", "hot"])

    COUNTED, MET = "shard int, block long, keys binary, places binary", "block long, keys binary, hot binary"
    found = written(docs_blocks.mapInArrow(tidy(keys), COUNTED).groupBy("shard").applyInArrow(tidy(met), MET), "suffix-anchors")

    def strings(pack: pa.Table, answer: pa.Table) -> pa.Table:
        """Hashes of all strings that hot anchors serve, with the numbers of their places in the block."""
        busy = np.unique(np.frombuffer(b"".join(answer.column("hot").to_pylist()), "<u8"))
        out = []
        for row in pack.to_pylist() if len(busy) else ():
            data, offsets = block_texts(row)
            served = anchors(data, offsets, length, kgram)
            out += counted(row["block"], *np.unique(served_starts(served, busy, prefix_hashes(data), length)[2], return_counts=True))
        return pa.Table.from_batches(out) if out else pa.table([pa.array([], t) for t in (pa.int32(), pa.int64(), pa.binary(), pa.binary())], names=["shard", "block", "keys", "places"])

    warm = found.where("octet_length(hot) > 0")
    of_hot = written(docs_blocks.groupBy("block").cogroup(warm.groupBy("block")).applyInArrow(tidy(strings), COUNTED).groupBy("shard").applyInArrow(tidy(met), MET), "suffix-strings")
    # kind: 0 hashes of anchors and the hot ones among them, 1 of strings of hot anchors and the hot ones among these
    asked = found.withColumn("kind", F.lit(0)).unionByName(of_hot.withColumn("kind", F.lit(1)))

    def surroundings(pack: pa.Table, answer: pa.Table) -> pa.Table:
        """Of the anchors met twice, the bytes of all strings that they serve. Within a block equal surroundings go as
        one, with the number of their places."""
        answer = answer.to_pylist()
        busy = Busy(numbers_of(answer, "hot", 0), numbers_of(answer, "keys", 1), numbers_of(answer, "hot", 1))
        wanted = np.union1d(numbers_of(answer, "keys", 0), busy.strings)
        out = []
        for row in pack.to_pylist():
            data, offsets = block_texts(row)
            place, first, last, h, whole = narrowed(data, anchors(data, offsets, length, kgram), busy, length)
            hit = np.flatnonzero(contained(h, wanted))
            place, first, last, h, whole = (x[hit] for x in (place, first, last, h, whole))
            end = last - 1 + length
            order = np.lexsort((first, whole, h))
            raw = row["data"]
            kept, members = [], []
            for i in order.tolist():
                text = raw[first[i] : end[i]]
                if not (kept and whole[i] == whole[kept[-1]] and h[i] == h[kept[-1]] and raw[first[kept[-1]] : end[kept[-1]]] == text):
                    kept.append(i)
                    members.append(0)
                members[-1] += 1
            kept = np.array(kept, dtype=np.int64)
            for s, i, j in shard_runs(h[kept], n_shards):
                k = kept[i:j]
                out.append((s, row["block"], h[k].tobytes(), np.array([place[k] - first[k], end[k] - first[k], first[k], np.array(members[i:j])], "<i4").tobytes(), b"".join(raw[a:b] for a, b in zip(first[k], end[k], strict=True))))
        return pa.table([pa.array([x[c] for x in out], t) for c, t in enumerate((pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))], names=["shard", "block", "keys", "numbers", "data"])

    sent = docs_blocks.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(tidy(surroundings), "shard int, block long, keys binary, numbers binary, data binary")

    def judge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        h = np.concatenate([np.frombuffer(x["keys"], "<u8") for x in rows])
        offset, size, first, members = np.concatenate([np.frombuffer(x["numbers"], "<i4").reshape(4, -1) for x in rows], axis=1).astype(np.int64)
        of = np.repeat(np.arange(len(rows)), [len(x["keys"]) // 8 for x in rows])
        data = np.frombuffer(b"".join(x.pop("data") for x in rows), np.uint8)
        at = np.cumsum(size) - size
        order = np.argsort(h, kind="stable")
        # a few keys at a time; a key's rows stay together
        upto, found, i = np.cumsum(size[order]), [], 0
        while i < len(order):
            j = int(np.searchsorted(upto, (upto[i - 1] if i else 0) + PIECE, side="right"))
            j = int(np.searchsorted(h[order], h[order[max(j, i + 1) - 1]], side="right"))
            own = order[i:j]
            member, a, b = repeated_runs(data[ragged(at[own], size[own])], h[own], offset[own], size[own], members[own], length)
            found.append((own[member], a, b))
            i = j
        member, a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*found, strict=True))
        # by row, each one's found runs together
        by = np.argsort(of[member], kind="stable")
        bounds = np.searchsorted(of[member][by], np.arange(len(rows) + 1))
        out = []
        for x, i, j in zip(rows, bounds, bounds[1:], strict=False):
            if i < j:
                m = by[i:j]
                # the surroundings of one place stand for all its equals in the block: key, identity, and runs
                out.append((x["block"], h[member[m]].tobytes(), np.array([first[member[m]], a[m], b[m]], "<i4").tobytes()))
        return pa.table([pa.array([x[c] for x in out], t) for c, t in enumerate((pa.int64(), pa.binary(), pa.binary()))], names=["block", "keys", "runs"])

    judged = sent.groupBy("shard").applyInArrow(tidy(judge), "block long, keys binary, runs binary").withColumn("kind", F.lit(0))
    # with which a block narrows its anchors again
    for kind, (table, column) in enumerate(((warm, "hot"), (of_hot, "keys"), (of_hot, "hot")), 1):
        judged = judged.unionByName(table.select("block", F.col(column).alias("keys"), F.lit(b"").alias("runs"), F.lit(kind).alias("kind")))
    return judged


def numbers_of(rows: list[dict], column: str, kind: int) -> np.ndarray:
    """The hashes that rows of a kind have, ascending."""
    return np.sort(np.frombuffer(b"".join(x[column] for x in rows if x["kind"] == kind), "<u8"))


def covered(data, offsets, rows: list[dict], length: int, kgram: int) -> np.ndarray:
    """The bytes of a block that repeated strings cover, from the judged surroundings of its anchors."""
    place, first, last, h, whole = narrowed(data, anchors(data, offsets, length, kgram), Busy(*(numbers_of(rows, "keys", k) for k in (1, 2, 3))), length)
    rows = [x for x in rows if x["kind"] == 0]
    edge = np.zeros(len(data) + 1, np.int32)
    keys = np.concatenate([np.zeros(0, np.uint64), *[np.frombuffer(x["keys"], "<u8") for x in rows]])
    runs = np.concatenate([np.zeros((3, 0), np.int64), *[np.frombuffer(x["runs"], "<i4").reshape(3, -1) for x in rows]], axis=1).astype(np.int64)
    if not len(keys):
        return edge[:-1] > 0
    # equal surroundings of the block share the answer of the place that was sent
    hit = np.flatnonzero(np.isin(h, keys))
    end = last - 1 + length
    order = hit[np.lexsort((first[hit], whole[hit], h[hit]))]
    raw = memoryview(data)
    leader, current = np.empty(len(order), np.int64), -1
    for n, i in enumerate(order.tolist()):
        if not (current >= 0 and whole[i] == whole[current] and h[i] == h[current] and raw[first[i] : end[i]] == raw[first[current] : end[current]]):
            current = i
        leader[n] = first[current]
    by = np.argsort(runs[0], kind="stable")
    runs = runs[:, by]
    lo, hi = np.searchsorted(runs[0], leader), np.searchsorted(runs[0], leader, side="right")
    which, member = ragged(lo, hi - lo), np.repeat(order, hi - lo)
    a, b = first[member] + runs[1][which], first[member] + runs[2][which] - 1 + length
    np.add.at(edge, a, 1)
    np.add.at(edge, b, -1)
    return np.cumsum(edge)[:-1] > 0


def dedup_substrings(docs: DataFrame, length: int = LENGTH, kgram: int = KGRAM, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes of the text) for every row.

    A byte goes if a string of `length` bytes that covers it also starts anywhere else, in the same text or another;
    strings never cross texts, overlaps count, and all are judged on the input. A null text is empty. Equal rows
    repeat each other. An empty table gives no row; further columns play no part. What remains may end within a
    character, hence bytes.
    """
    packs = written(blocks(docs, id_col, text_col, block_bytes), "suffix-blocks")
    n_shards = max(16, packs.count() // 2)  # a shard has what two blocks have; a block sends a row at most for each of its keys
    judged = repeats(packs, n_shards, length, kgram, hot)

    def remove(pack: pa.Table, answer: pa.Table) -> pa.Table:
        out = []
        for row in pack.to_pylist():
            data, offsets = block_texts(row)
            gone = covered(data, offsets, answer.to_pylist(), length, kgram)
            starts = gone.copy()
            starts[1:] &= ~gone[:-1]
            cuts = offsets[:-1][np.diff(offsets) > 0]
            starts[cuts] = gone[cuts]
            removed, spans = (np.concatenate([[0], np.cumsum(x)]) for x in (gone, starts))
            removed, spans = np.diff(removed[offsets]), np.diff(spans[offsets])
            raw = row["data"]
            kept = [raw[a:b] if not n else data[a:b][~gone[a:b]].tobytes() for a, b, n in zip(offsets, offsets[1:], removed, strict=False)]
            out.append(pa.table([pa.array(row["ids"], pa.int64()), pa.array(np.diff(offsets)), pa.array(removed), pa.array(spans), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]))
        return pa.concat_tables(out)

    return packs.groupBy("block").cogroup(judged.groupBy("block")).applyInArrow(tidy(remove), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op3_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    found = dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
