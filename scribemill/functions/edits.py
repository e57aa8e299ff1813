"""Edits of sequences by bit vectors, shortest edit scripts, and n-gram matches of batches of pairs.

A bit vector has a bit for each item of one sequence and is moved by each item of the other, so that a step costs the
number of machine words of the vector: sequences of any length, whole.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def trimmed(a: Sequence, b: Sequence) -> tuple[int, int]:
    """Lengths of the common start, and of the common end of the rest."""
    most = min(len(a), len(b))
    start = 0
    while start < most and a[start] == b[start]:
        start += 1
    end = 0
    while end < most - start and a[-1 - end] == b[-1 - end]:
        end += 1
    return start, end


def places(items: Sequence) -> dict:
    """Of each distinct item a bit vector of its places."""
    out, bit = {}, 1
    for x in items:
        out[x] = out.get(x, 0) | bit
        bit <<= 1
    return out


def edit_distance(a: Sequence, b: Sequence) -> int:
    """Levenshtein distance: the vectors hold where a column of the table grows and falls by one."""
    start, end = trimmed(a, b)
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return len(a)
    at, full, last = places(a), (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score = full, 0, len(a)
    for x in b:
        same = at.get(x, 0)
        vertical = same | down
        same = (((same & up) + up) ^ up) | same
        right, left = down | (full & ~(same | up)), up & same
        score += (right & last > 0) - (left & last > 0)
        right = (right << 1 | 1) & full
        up, down = (left << 1 | ~(vertical | right)) & full, right & vertical
    return score


def common_length(a: Sequence, b: Sequence) -> int:
    """Length of the longest common subsequence: its rows grow where the vector has a zero."""
    start, end = trimmed(a, b)
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    if not a or not b:
        return start + end
    at, full = places(a), (1 << len(a)) - 1
    row = full
    for x in b:
        same = row & at.get(x, 0)
        row = ((row + same) | (row - same)) & full
    return start + end + len(a) - row.bit_count()


#: bytes of the vectors of one group of pairs, and of its table of places
GROUP_BYTES, TABLE_BYTES = 1 << 14, 1 << 24
#: of at most so many distinct items a table has a row for each
ROWS = 256


def spread(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of ranges of places: for every place its range, its number in the range, and itself."""
    of = np.repeat(np.arange(len(lengths)), lengths)
    number = np.arange(len(of)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return of, number, starts[of] + number


def groups_of(width: np.ndarray, steps: np.ndarray, distinct: int) -> list[np.ndarray]:
    """Pairs in groups of vectors of about a width (bytes), as many as the vectors and tables of a group have room for."""
    order = np.lexsort((-steps, width))
    width, out, begin = width[order], [], 0
    while begin < len(order):
        widest = int(width[begin]) * 9 // 8
        upto = int(np.searchsorted(width, widest, "right"))
        rows = distinct if distinct <= ROWS else min(distinct, 8 * widest)
        end = min(upto, begin + max(1, min(GROUP_BYTES // widest, TABLE_BYTES // (widest * rows))))
        out.append(order[begin:end])
        begin = end
    return out


def group_distances(codes: np.ndarray, tall: tuple, wide: tuple, distinct: int, width: int) -> np.ndarray:
    """Levenshtein distances of one group by one vector, in which each pair has `width` bytes, the highest bit of which is
    for carries. tall: places and lengths of the sequences that have the bits; wide: those that move them. All end
    with the same step, so the shorter of these come in later, and what grew and fell in the last column is added up."""
    (at_a, n), (at_b, m) = tall, wide
    order = np.argsort(-m, kind="stable")
    at_a, n, at_b, m = at_a[order], n[order], at_b[order], m[order]
    pairs, steps = len(m), int(m[0])
    pair, number, place = spread(at_a, n)
    pair_b, step, place_b = spread(at_b, m)
    cell, cell_b = pair * distinct + codes[place], pair_b * distinct + codes[place_b]
    cells = pairs * distinct
    if distinct > ROWS:
        known, cell = np.unique(cell, return_inverse=True)
        cells = len(known)
        found = np.minimum(np.searchsorted(known, cell_b), cells - 1)
        cell_b = np.where(known[found] == cell_b, found, cells)
    bit = np.left_shift(np.uint8(1), (number & 7).astype(np.uint8))
    table, valid = np.zeros((cells + 1, width), np.uint8), np.zeros((pairs, width), np.uint8)
    np.add.at(table.reshape(-1), cell * width + (number >> 3), bit)
    np.add.at(valid.reshape(-1), pair * width + (number >> 3), bit)
    first = np.zeros((pairs, width), np.uint8)
    first[:, 0] = 1
    moves = np.empty((steps, pairs), np.int64)
    moves[step + (steps - m)[pair_b], pair_b] = cell_b
    active = np.searchsorted(-m, np.arange(steps) - steps, "right").tolist()
    number_of = lambda x: int.from_bytes(x.tobytes(), "little")
    up = down = full = low = at = 0
    for j, count in enumerate(active):
        if count > at:
            before, full, low, at = full, number_of(valid[:count]), number_of(first[:count]), count
            up |= full ^ before
        same = number_of(table.take(moves[j, :count], axis=0))
        vertical = same | down
        same |= ((same & up) + up) ^ up
        right = down | (((same | up) & full) ^ full)
        left = up & same
        right = (right << 1 | low) & full
        up = (left << 1 & full) | ((vertical | right) ^ full)
        down = right & vertical
    size = pairs * width
    grown, fallen = (np.bitwise_count(np.frombuffer(x.to_bytes(size, "little"), np.uint8)).reshape(pairs, width).sum(axis=1, dtype=np.int64) for x in (up, down))
    out = np.empty(pairs, np.int64)
    out[order] = m + grown - fallen
    return out


def distances(codes: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, distinct: int) -> np.ndarray:
    """Levenshtein distances of many pairs: codes below `distinct`, with the offsets of the first sequences and, behind
    all of those, of the second ones. Pairs of about a length are moved together; a few long ones one by one."""
    at_a, n, at_b, m = of_a[:-1], np.diff(of_a), of_b[:-1] + of_a[-1], np.diff(of_b)
    out = np.maximum(n, m)
    swap = n < m
    at_a, n, at_b, m = np.where(swap, at_b, at_a), np.where(swap, m, n), np.where(swap, at_a, at_b), np.where(swap, n, m)
    todo = np.flatnonzero(m > 0)
    width = n // 8 + 1
    for group in groups_of(width[todo], m[todo], distinct) if len(todo) else []:
        pairs = todo[group]
        if len(pairs) < 3:
            for i in pairs.tolist():
                out[i] = edit_distance(codes[at_a[i] : at_a[i] + n[i]].tolist(), codes[at_b[i] : at_b[i] + m[i]].tolist())
        else:
            out[pairs] = group_distances(codes, (at_a[pairs], n[pairs]), (at_b[pairs], m[pairs]), distinct, int(width[pairs].max()))
    return out


def short_common_lengths(codes: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of pairs whose first sequence has at most 64 items."""
    at_a, n, at_b, m = of_a[pairs], (np.diff(of_a))[pairs], of_b[pairs] + of_a[-1], (np.diff(of_b))[pairs]
    full = np.where(n == 64, np.uint64(0xFFFFFFFFFFFFFFFF), np.left_shift(np.uint64(1), (n & 63).astype(np.uint64)) - np.uint64(1))
    row, distinct = full.copy(), int(codes.max(initial=0)) + 1
    lane, number, place = spread(at_a, n)
    known, cell = np.unique(lane * distinct + codes[place], return_inverse=True)
    table = np.zeros(len(known) + 1, np.uint64)
    np.add.at(table, cell, np.left_shift(np.uint64(1), number.astype(np.uint64)))
    order = np.argsort(-m, kind="stable")
    for j in range(int(m.max(initial=0))):
        own = order[: np.searchsorted(-m[order], -j, "left")]
        key = own * distinct + codes[at_b[own] + j]
        found = np.searchsorted(known, key)
        found = np.where(known[np.minimum(found, max(len(known) - 1, 0))] == key, found, len(known)) if len(known) else np.zeros(len(own), np.int64)
        same = row[own] & table[found]
        row[own] = ((row[own] + same) | (row[own] & ~same)) & full[own]
    return n - np.bitwise_count(row).astype(np.int64)


def common_lengths(codes: np.ndarray, of_a: np.ndarray, of_b: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of many pairs: those of at most 64 items together, others one by one."""
    n, m = np.diff(of_a), np.diff(of_b)
    out = np.zeros(len(n), np.int64)
    short = (n <= 64) & (m <= 64)
    out[short] = short_common_lengths(codes, of_a, of_b, np.flatnonzero(short))
    for i in np.flatnonzero(~short).tolist():
        out[i] = common_length(codes[of_a[i] : of_a[i + 1]].tolist(), codes[of_a[-1] + of_b[i] : of_a[-1] + of_b[i + 1]].tolist())
    return out


def coded_texts(a: pa.Array, b: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Codes of the characters of two columns, one after the other, the offsets of both, and the number of codes; nulls
    are empty."""
    columns = [pc.fill_null(x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x, "").cast(pa.large_string()) for x in (a, b)]
    offsets, places = [], []
    for x in columns:
        offsets.append(np.concatenate([[0], np.cumsum(pc.utf8_length(x).to_numpy(zero_copy_only=False))]).astype(np.int64))
        places.append(np.frombuffer(x.buffers()[1], np.int64)[x.offset : x.offset + len(x) + 1] if len(x) else np.zeros(1, np.int64))
    raw = [np.frombuffer(x.buffers()[2], np.uint8)[p[0] : p[-1]] if p[-1] > p[0] else np.zeros(0, np.uint8) for x, p in zip(columns, places, strict=True)]
    points = np.concatenate(raw)
    if len(points) > sum(int(x[-1]) for x in offsets):
        # characters of several bytes
        points = np.frombuffer(points.tobytes().decode().encode("utf-32-le"), np.uint32)
    seen = np.zeros(int(points.max(initial=0)) + 1, bool)
    seen[points] = True
    number = np.cumsum(seen) - 1
    return number[points], *offsets, int(number[-1]) + 1


class Parts:
    """Parts of pairs of sequences: of each its pair, and where it begins in all first and all second items and how long
    it is in both."""

    def __init__(self, pair: np.ndarray, at_a: np.ndarray, n: np.ndarray, at_b: np.ndarray, m: np.ndarray):
        self.columns = pair, at_a, n, at_b, m
        self.pair, self.at_a, self.n, self.at_b, self.m = self.columns

    def __getitem__(self, which) -> Parts:
        return Parts(*(x[which] for x in self.columns))

    def equal(self, a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, back: bool, own=slice(None)) -> np.ndarray:
        """Whether items x and y, from the starts or ends, are there and equal; own: the part of each."""
        n, m = self.n[own], self.m[own]
        i, j = (self.at_a[own] + n - 1 - x, self.at_b[own] + m - 1 - y) if back else (self.at_a[own] + x, self.at_b[own] + y)
        return (x < n) & (y < m) & (a.take(i, mode="clip") == b.take(j, mode="clip"))

    def follow(self, a: np.ndarray, b: np.ndarray, x: np.ndarray, k: np.ndarray, back: bool, own: np.ndarray) -> np.ndarray:
        """Where runs of equal items that begin at x and x - k end, in the first sequence."""
        x = x.copy()
        on = np.flatnonzero(self.equal(a, b, x, x - k, back, own))
        while len(on):
            x[on] += 1
            on = on[self.equal(a, b, x[on], x[on] - k[on], back, own[on])]
        return x


def middle_snakes(a: np.ndarray, b: np.ndarray, parts: Parts) -> np.ndarray:
    """[part, (x, y, u)] of parts whose ends differ and whose differences of lengths are all odd or all even: the run of
    equal items from (x, y) to u in the first sequence, in the middle of a shortest edit script. Furthest places of each
    diagonal are followed from both ends until they meet, of all parts at once."""
    odd = bool((parts.n[0] - parts.m[0]) & 1)
    out, live, d = np.empty((len(parts.n), 3), np.int64), np.arange(len(parts.n)), 0
    ahead = back = np.zeros((len(live), 1), np.int64)
    while len(live):
        k = np.arange(-d, d + 1, 2)
        own, diagonal = np.repeat(np.arange(len(live)), d + 1), np.tile(k, len(live))
        for backward in (False, True):
            before = back if backward else ahead
            x = np.zeros_like(before)
            if d:
                x = np.empty((len(live), d + 1), np.int64)
                x[:, 0], x[:, -1] = before[:, 0], before[:, -1] + 1
                x[:, 1:-1] = np.maximum(before[:, 1:], before[:, :-1] + 1)
            u = parts.follow(a, b, x.ravel(), diagonal, backward, own).reshape(x.shape)
            ahead, back, facing = (ahead, u, ahead) if backward else (u, back, back)
            if backward is odd or not facing.size:
                continue
            # the same diagonal from the other end
            place = ((parts.n - parts.m)[:, None] - k + facing.shape[1] - 1) >> 1
            there = (place >= 0) & (place < facing.shape[1])
            met = there & (u + np.take_along_axis(facing, np.clip(place, 0, facing.shape[1] - 1), 1) >= parts.n[:, None])
            done = np.flatnonzero(met.any(axis=1))
            if not len(done):
                continue
            first = met[done].argmax(axis=1)
            at, upto, on = x[done, first], u[done, first], k[first]
            n, m = parts.n[done], parts.m[done]
            out[live[done]] = np.column_stack([n - upto, m - upto + on, n - at] if backward else [at, at - on, upto])
            rest = np.ones(len(live), bool)
            rest[done] = False
            live, parts, ahead, back = live[rest], parts[rest], ahead[rest], back[rest]
            own, diagonal = np.repeat(np.arange(len(live)), d + 1), np.tile(k, len(live))
        d += 1
    return out


#: kinds of runs of a script
SAME, DELETED, INSERTED = range(3)


def edit_scripts(a: np.ndarray, of_a: np.ndarray, b: np.ndarray, of_b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Shortest scripts of deletions and insertions of many pairs as runs in order: pair, kind, places in all first and all
    second items, length.

    The middle of a script parts it into two shorter ones, so that the space is in proportion to the sequences. All
    parts of a depth are halved together.
    """
    a, b = (x if len(x) else np.zeros(1, np.int64) for x in (a, b))
    parts = Parts(np.arange(len(of_a) - 1), of_a[:-1], np.diff(of_a), of_b[:-1], np.diff(of_b))
    runs: list[list[np.ndarray]] = []

    def put(kind: int, parts: Parts, length: np.ndarray):
        some = length > 0
        runs.append([parts.pair[some], np.full(int(some.sum()), kind), parts.at_a[some], parts.at_b[some], length[some]])

    while len(parts.n):
        every, none = np.arange(len(parts.n)), np.zeros(len(parts.n), np.int64)
        start = parts.follow(a, b, none, none, False, every)
        put(SAME, parts, start)
        parts = Parts(parts.pair, parts.at_a + start, parts.n - start, parts.at_b + start, parts.m - start)
        end = parts.follow(a, b, none, none, True, every)
        parts = Parts(parts.pair, parts.at_a, parts.n - end, parts.at_b, parts.m - end)
        put(SAME, Parts(parts.pair, parts.at_a + parts.n, none, parts.at_b + parts.m, none), end)
        # one item for another is the most frequent part of those that need no middle
        plain = (parts.n == 0) | (parts.m == 0) | (parts.n + parts.m == 2)
        leaves, parts = parts[plain], parts[~plain]
        put(DELETED, leaves, leaves.n)
        put(INSERTED, Parts(leaves.pair, leaves.at_a + leaves.n, leaves.n, leaves.at_b, leaves.m), leaves.m)
        below = []
        for odd in (0, 1):
            own = parts[((parts.n - parts.m) & 1) == odd]
            if len(own.n):
                x, y, u = middle_snakes(a, b, own).T
                put(SAME, Parts(own.pair, own.at_a + x, own.n, own.at_b + y, own.m), u - x)
                v = y + u - x
                below += [Parts(own.pair, own.at_a, x, own.at_b, y), Parts(own.pair, own.at_a + u, own.n - u, own.at_b + v, own.m - v)]
        parts = Parts(*(np.concatenate(x) for x in zip(*(p.columns for p in below), strict=True))) if below else parts
    out = [np.concatenate(x) for x in zip(*runs, strict=True)] if runs else [np.zeros(0, np.int64)] * 5
    order = np.lexsort((out[2] + out[3], out[0]))
    pair, kind, at_a, at_b, length = (x[order] for x in out)
    if not len(pair):
        return pair, kind, at_a, at_b, length
    begin = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (kind[1:] != kind[:-1])))
    return pair[begin], kind[begin], at_a[begin], at_b[begin], np.add.reduceat(length, begin)


def edit_script(a: Sequence, b: Sequence) -> list[tuple[str, int, int, int]]:
    """A shortest script of deletions and insertions as runs (kind, place in a, place in b, length), kind one of = - +."""
    number: dict = {}
    x, y = (np.array([number.setdefault(c, len(number)) for c in s], np.int64) for s in (a, b))
    _, kind, *places = edit_scripts(x, np.array([0, len(x)]), y, np.array([0, len(y)]))
    return [("=-+"[k], *p) for k, *p in zip(kind.tolist(), *(p.tolist() for p in places), strict=True)]


def coded_lists(a: pa.Array, b: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Codes of all items of the lists of two columns, alike for equal items, their offsets, and the distinct items;
    null lists are empty."""
    flat, offsets = [], []
    for x in (a, b):
        x = x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
        flat.append(x.flatten().cast(pa.large_string()))
        lengths = pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False)
        offsets.append(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64))
    codes = pa.concat_arrays(flat).dictionary_encode()
    number = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return number[: len(flat[0])], offsets[0], number[len(flat[0]) :], offsets[1], codes.dictionary


#: white space of Unicode, as (?U)\s of Java has it: ASCII, and UTF-8 of two and three bytes as numbers
WHITE_ASCII = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
WHITE_TWO, WHITE_THREE = (np.array([int.from_bytes(c.encode()) for c in x], np.int32) for x in ("\x85\xa0", "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"))


def white_bytes(data: np.ndarray) -> np.ndarray:
    """Whether each byte of UTF-8 texts is of white space."""
    out = WHITE_ASCII[data]
    if int(data.max(initial=0)) < 0x80:
        return out
    for size, leads, known in ((2, (0xC2,), WHITE_TWO), (3, (0xE1, 0xE2, 0xE3), WHITE_THREE)):
        at = np.flatnonzero(np.isin(data, leads))
        value = np.zeros(len(at), np.int32)
        for k in range(size):
            value = value << 8 | data[at + k]
        at = at[np.isin(value, known)]
        for k in range(size):
            out[at + k] = True
    return out


def words_of(x: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words between white space of all texts, one after the other, and the place of each text's first word and the end;
    nulls are empty."""
    x = pc.fill_null(x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x, "").cast(pa.large_string())
    at = np.frombuffer(x.buffers()[1], np.int64)[x.offset : x.offset + len(x) + 1] if len(x) else np.zeros(1, np.int64)
    data = np.frombuffer(x.buffers()[2], np.uint8)[at[0] : at[-1]] if at[-1] > at[0] else np.zeros(0, np.uint8)
    at = at - at[0]
    inner = ~white_bytes(data)
    first = inner.copy()
    first[1:] &= ~inner[:-1]
    # a text's first byte goes on with no word of the text before
    texts = at[:-1][np.diff(at) > 0]
    first[texts] = inner[texts]
    places = np.flatnonzero(first)
    ends = np.append((np.cumsum(inner) - 1)[places], np.count_nonzero(inner))
    words = pa.Array.from_buffers(pa.large_string(), len(places), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[inner])])
    return words, np.searchsorted(places, at)


def coded_words(a: pa.Array, b: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Codes of all words of the texts of two columns, alike for equal words, their offsets, and the distinct words. Texts
    are cut here, since lists of words cost more on their way from Spark than all that follows."""
    (words_a, of_a), (words_b, of_b) = words_of(a), words_of(b)
    codes = pa.concat_arrays([words_a, words_b]).dictionary_encode()
    number = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return number[: len(words_a)], of_a, number[len(words_a) :], of_b, codes.dictionary


#: numbers that stand for an n-gram and its pair stay below
MOST = 1 << 61


def renumbered(x: np.ndarray) -> tuple[np.ndarray, int]:
    known, number = np.unique(x, return_inverse=True)
    return number, len(known)


def matched_ngrams(a: np.ndarray, of_a: np.ndarray, b: np.ndarray, of_b: np.ndarray, orders: int = 4) -> np.ndarray:
    """[pair, n - 1]: n-grams of both lists of a pair, each as often as it stands in both.

    Items are numbered within their pair, so that an n-gram's numbers mostly go into one whole number; where they do
    not, n-grams are numbered anew. All of a batch are counted by sorting.
    """
    rows = len(of_a) - 1
    out = np.zeros((rows, orders), np.int64)
    codes = np.concatenate([a, b])
    if not len(codes):
        return out
    row = np.concatenate([np.repeat(np.arange(rows), np.diff(of_a)), np.repeat(np.arange(rows), np.diff(of_b))])
    left = np.concatenate([np.repeat(of_a[1:], np.diff(of_a)) - np.arange(len(a)), np.repeat(of_b[1:], np.diff(of_b)) - np.arange(len(b))])
    known, codes = np.unique(row * (int(codes.max()) + 1) + codes, return_inverse=True)
    of_row = known // (int(max(a.max(initial=0), b.max(initial=0))) + 1)
    codes = codes - np.searchsorted(of_row, np.arange(rows))[row]
    items = int(codes.max()) + 1
    gram, size, at = codes.copy(), items, np.arange(len(codes))
    for n in range(1, orders + 1):
        if n > 1:
            at = at[left[at] >= n]
            if size * items * rows >= MOST:
                gram[at], size = renumbered(gram[at])
            gram[at] = gram[at] * items + codes[at + n - 1]
            size *= items
            if size * rows >= MOST:
                gram[at], size = renumbered(gram[at])
        key = np.sort((row[at] * size + gram[at]) * 2 + (at >= len(a)))
        if not len(key):
            break
        begin = np.flatnonzero(np.append(True, key[1:] >> 1 != key[:-1] >> 1))
        both = np.diff(np.append(begin, len(key)))
        of_b_side = np.add.reduceat(key & 1, begin)
        out[:, n - 1] = np.bincount((key[begin] >> 1) // size, np.minimum(of_b_side, both - of_b_side), rows)
    return out
