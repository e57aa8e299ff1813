"""What stands at the end of a speech corpus: decoded logits, log-mel features, and token ids of the labels.

All are Arrow functions of whole columns; rows are independent, null gives null.
"""

from __future__ import annotations

import base64
import functools
import heapq
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from scribemill.functions.edits import spread

WORDS = "array<struct<word:string,start_offset:int,end_offset:int>>"


def kind(text: str):
    return _parse_datatype_string(text)


def matrices(column: pa.Array):
    """Each row of an array<array<number>> as a matrix; null for null and for rows whose inner arrays are ragged or null."""
    for x in column:
        if not x.is_valid:
            yield None
            continue
        flat = x.values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        frames = len(x.values)
        width = len(flat) // frames if frames else 0
        even = frames == 0 or (x.values.null_count == 0 and set(x.values.value_lengths().to_pylist()) == {width})
        yield flat.reshape(frames, width) if even else None


# ------------------------------------------------------------------ CTC


def collapsed(best: np.ndarray, blank: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels of frames without blanks and repeats, and the frames [start, end) of each."""
    starts = np.flatnonzero(np.append(True, best[1:] != best[:-1])) if len(best) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(best))
    kept = best[starts] != blank
    return best[starts][kept], starts[kept], ends[kept]


def words_of(labels, starts, ends, vocabulary: list[str], delimiter: str) -> list[dict]:
    """Words between delimiters, from the first frame of their first label to the last of their last."""
    out, open_ = [], False
    for label, start, end in zip(labels.tolist(), starts.tolist(), ends.tolist(), strict=True):
        mark = vocabulary[label]
        if mark == delimiter:
            open_ = False
        elif open_:
            out[-1]["word"] += mark
            out[-1]["end_offset"] = end
        else:
            out.append({"word": mark, "start_offset": start, "end_offset": end})
            open_ = True
    return out


def ctc_words(logits: Column, vocabulary: list[str], blank: int = 0, delimiter: str = "|") -> Column:
    """Words with their frames from array<array<number>> of frames by labels: the likeliest label of each frame (of equal
    ones the first), repeats as one, blanks left out. `word_times` makes seconds of the frames."""

    @F.arrow_udf(kind(WORDS))
    def decode(column: pa.Array) -> pa.Array:
        out = [None if x is None else words_of(*collapsed(x.argmax(axis=1) if x.size else np.zeros(0, np.int64), blank), vocabulary, delimiter) for x in matrices(column)]
        return pa.array(out, pa.list_(pa.struct([("word", pa.string()), ("start_offset", pa.int32()), ("end_offset", pa.int32())])))

    return decode(logits)


def log_add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


def prefix_search(log_probs: np.ndarray, blank: int, width: int) -> tuple[tuple[int, ...], float]:
    """The likeliest labelling found with so many prefixes kept, and its log probability, summed over alignments.

    A prefix has two sums: of alignments that end in a blank and of those that end in its last label, which alone must not
    be followed by the same label as a new one.
    """
    none = -math.inf
    beam = {(): (0.0, none)}
    for frame in log_probs.tolist():
        found: dict[tuple, list[float]] = {}

        def add(prefix, side, value, found=found):
            own = found.setdefault(prefix, [none, none])
            own[side] = log_add(own[side], value)

        for prefix, (in_blank, in_label) in beam.items():
            both = log_add(in_blank, in_label)
            add(prefix, 0, both + frame[blank])
            for label, p in enumerate(frame):
                if label == blank:
                    continue
                if prefix and label == prefix[-1]:
                    add(prefix, 1, in_label + p)
                    add((*prefix, label), 1, in_blank + p)
                else:
                    add((*prefix, label), 1, both + p)
        best = sorted(found.items(), key=lambda x: (-log_add(*x[1]), x[0]))[:width]
        beam = {prefix: tuple(sides) for prefix, sides in best}
    prefix, sides = min(beam.items(), key=lambda x: (-log_add(*x[1]), x[0]))
    return prefix, log_add(*sides)


def ctc_search(logits: Column, blank: int = 0, width: int = 16) -> Column:
    """(labels, log_prob) by prefix beam search over the softmax of the logits."""

    @F.arrow_udf(kind("struct<labels:array<int>,log_prob:double>"))
    def decode(column: pa.Array) -> pa.Array:
        out = []
        for x in matrices(column):
            if x is None:
                out.append(None)
                continue
            top = x - x.max(axis=1, keepdims=True) if x.size else x
            labels, p = prefix_search(top - np.log(np.exp(top).sum(axis=1, keepdims=True)), blank, width)
            out.append({"labels": labels, "log_prob": p})
        return pa.array(out, pa.struct([("labels", pa.list_(pa.int32())), ("log_prob", pa.float64())]))

    return decode(logits)


# ------------------------------------------------------------------ log-mel features


def mel(hz):
    """Mels: linear below 1000 Hz (200/3 Hz each), above it 27 to each factor of 6.4."""
    hz = np.asarray(hz, np.float64)
    return np.where(hz < 1000, hz * 3 / 200, 15 + 27 * np.log(np.maximum(hz, 1) / 1000) / math.log(6.4))


def hertz(mels):
    mels = np.asarray(mels, np.float64)
    return np.where(mels < 15, mels * 200 / 3, 1000 * np.exp((mels - 15) / 27 * math.log(6.4)))


@functools.lru_cache(8)
def mel_bank(rate: int, n_fft: int, bands: int) -> np.ndarray:
    """(bands, n_fft // 2 + 1): triangles between neighbouring mels, of equal area."""
    edges = hertz(np.linspace(0, mel(rate / 2), bands + 2))
    bins = np.arange(n_fft // 2 + 1) * rate / n_fft
    up = (bins - edges[:-2, None]) / (edges[1:-1] - edges[:-2])[:, None]
    down = (edges[2:, None] - bins) / (edges[2:] - edges[1:-1])[:, None]
    return np.maximum(0, np.minimum(up, down)) * (2 / (edges[2:] - edges[:-2]))[:, None]


def log_mel(samples: np.ndarray, length: int, rate: int = 16_000, n_fft: int = 400, hop: int = 160, bands: int = 80) -> np.ndarray:
    """(bands, length // hop): log10 of the mel energies of windows around every hop-th sample, cut to 8 below their
    maximum, plus 4, over 4. Samples are cut or filled with zeros to `length` and mirrored at both ends."""
    x = np.zeros(length)
    x[: min(length, len(samples))] = samples[:length]
    x = np.pad(x, n_fft // 2, mode="reflect")
    frames = np.lib.stride_tricks.sliding_window_view(x, n_fft)[::hop][: length // hop]
    window = 0.5 - 0.5 * np.cos(2 * math.pi * np.arange(n_fft) / n_fft)
    energy = np.abs(np.fft.rfft(frames * window, axis=1)) ** 2 @ mel_bank(rate, n_fft, bands).T
    out = np.log10(np.maximum(energy.T, 1e-10))
    return (np.maximum(out, out.max() - 8) + 4) / 4


def mel_features(audio: Column, length: int = 480_000, rate: int = 16_000, n_fft: int = 400, hop: int = 160, bands: int = 80) -> Column:
    """(features, attention_mask, input_length) of mono samples: bands by frames, 1 for every frame that begins within the
    samples, and the number of samples as they came. Null samples count as zero."""

    @F.arrow_udf(kind("struct<features:array<array<float>>,attention_mask:array<int>,input_length:int>"))
    def extract(column: pa.Array) -> pa.Array:
        out = []
        for x in column:
            if not x.is_valid:
                out.append(None)
                continue
            samples = x.values.cast(pa.float64()).fill_null(0).to_numpy(zero_copy_only=False)
            made = log_mel(samples, length, rate, n_fft, hop, bands).astype(np.float32)
            out.append({"features": list(made), "attention_mask": (np.arange(length // hop) * hop < len(samples)).astype(np.int32), "input_length": len(samples)})
        return pa.array(out, pa.struct([("features", pa.list_(pa.list_(pa.float32()))), ("attention_mask", pa.list_(pa.int32())), ("input_length", pa.int32())]))

    return extract(audio)


# ------------------------------------------------------------------ token ids

#: words with the space before them, numbers, marks and other white space
PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank table: lines of a token in base64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def dropped(seed: int, place: int, rank: int, rate: float) -> bool:
    """Whether a merge at a place is left out: by 64 mixed bits of seed, place and merge."""
    x = (seed * 0x9E3779B97F4A7C15 + place * 0xBF58476D1CE4E5B9 + rank * 0x94D049BB133111EB + 0x632BE59BD9B4E019) & (1 << 64) - 1
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        x = (x ^ x >> shift) * factor & (1 << 64) - 1
    return x < rate * (1 << 64)


def merged(piece: bytes, ranks: dict[bytes, int], rate: float = 0.0, seed: int = 0, place: int = 0) -> list[int]:
    """Token ids of a piece: of neighbours that make a token the pair of the lowest rank is merged, the first of equal
    ones, until there is none. With a rate, each merge of a place in the text is left out with these odds, for good."""
    n = len(piece)
    # parts begin at places; of each living one where the next begins and where the one before does
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    waiting: list[tuple[int, int, int]] = []

    def look(i: int) -> None:
        """Put the pair that begins at a place among those that wait, with where it ends."""
        if i >= 0 and after[i] < n:
            end = after[after[i]]
            rank = ranks.get(piece[i:end])
            if rank is not None and not (rate and dropped(seed, place + i, rank, rate)):
                heapq.heappush(waiting, (rank, i, end))

    for i in range(n):
        look(i)
    gone = [False] * n
    while waiting:
        _, i, end = heapq.heappop(waiting)
        if gone[i] or after[i] == n or after[after[i]] != end:
            continue  # one of its parts has been merged meanwhile
        gone[after[i]] = True
        after[i] = end
        if end < n:
            before[end] = i
        look(i)
        look(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


#: of a pair that makes no token, or whose merge is left out
NO_RANK = np.iinfo(np.int64).max
#: longer pieces are merged one by one, and so many of a length together
LONGEST, BLOCK = 48, 1 << 15


def dropped_many(seeds: np.ndarray, places: np.ndarray, ranks: np.ndarray, rate: float) -> np.ndarray:
    """`dropped` of many merges."""
    mixed = lambda x, factor: x.astype(np.int64).view(np.uint64) * np.uint64(factor)
    x = mixed(seeds, 0x9E3779B97F4A7C15) + mixed(places, 0xBF58476D1CE4E5B9) + mixed(ranks, 0x94D049BB133111EB) + np.uint64(0x632BE59BD9B4E019)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        x = (x ^ x >> np.uint64(shift)) * np.uint64(factor)
    limit = math.ceil(rate * (1 << 64))
    return np.full(len(x), True) if limit >> 64 else x < np.uint64(limit)


def joins(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token of each byte (-1: none), and all pairs of tokens that make a token, as one number each and in order, with
    their ranks."""
    single = np.array([ranks.get(bytes([k]), -1) for k in range(256)], np.int64)
    pairs = [(x << 32 | y, rank) for t, rank in ranks.items() for i in range(1, len(t)) if (x := ranks.get(t[:i])) is not None and (y := ranks.get(t[i:])) is not None]
    known, rank = np.array(sorted(pairs), np.int64).reshape(-1, 2).T
    return single, np.ascontiguousarray(known), np.ascontiguousarray(rank)


def merged_block(ids: np.ndarray, places: np.ndarray, seeds: np.ndarray, known: np.ndarray, rank: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """`merged` of pieces of one length, a row of tokens of bytes each, and how many tokens are left of it: each round
    makes one merge in every piece."""

    def ranked(left, right, begin, seed):
        out = np.full(left.shape, NO_RANK)
        if len(known):
            key = left << 32 | right
            at = np.minimum(np.searchsorted(known, key), len(known) - 1)
            found = np.nonzero(known[at] == key)
            value = rank[at[found]]
            out[found] = np.where(dropped_many(np.broadcast_to(seed, left.shape)[found], begin[found], value, rate), NO_RANK, value) if rate else value
        return out

    out, left = ids.copy(), np.full(len(ids), ids.shape[1])
    begin, seeds, live = places[:, None] + np.arange(ids.shape[1]), seeds[:, None], np.arange(len(ids))
    pairs = ranked(ids[:, :-1], ids[:, 1:], begin[:, :-1], seeds)
    while pairs.shape[1]:
        best = pairs.argmin(axis=1)
        value = pairs[np.arange(len(live)), best]
        on = np.flatnonzero(value != NO_RANK)
        if not len(on):
            break
        live, seeds, best, value = live[on], seeds[on], best[on], value[on]
        width = np.arange(ids.shape[1] - 1)
        source = width + (width > best[:, None])
        ids, begin = (np.take_along_axis(x[on], source, 1) for x in (ids, begin))
        pairs = np.take_along_axis(pairs[on], source[:, :-1], 1)
        row = np.arange(len(live))
        ids[row, best] = value
        for at in (best - 1, best):
            own = np.flatnonzero((at >= 0) & (at < pairs.shape[1]))
            i = at[own]
            pairs[own, i] = ranked(ids[own, i], ids[own, i + 1], begin[own, i], seeds[own, 0])
        out[live, : ids.shape[1]], left[live] = ids, ids.shape[1]
    return out, left


def merged_many(data: np.ndarray, lengths: np.ndarray, places: np.ndarray, seeds: np.ndarray, ranks: dict[bytes, int], tables: tuple, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """`merged` of many pieces that stand one after the other in data: all token ids, and how many each piece has."""
    single, known, rank = tables
    ids, starts, left = single[data], np.cumsum(lengths) - lengths, lengths.copy()
    if (ids < 0).any():
        raise KeyError(f"no token for the byte {int(data[ids < 0][0])}")
    order = np.argsort(lengths, kind="stable")
    of_length = np.searchsorted(lengths[order], np.arange(2, LONGEST + 2))
    for size, first, upto in zip(range(2, LONGEST + 1), of_length, of_length[1:], strict=False):
        for k in range(first, upto, BLOCK):
            own = order[k : min(k + BLOCK, upto)]
            at = starts[own][:, None] + np.arange(size)
            ids[at], left[own] = merged_block(ids[at], places[own], seeds[own], known, rank, rate)
    for k in order[of_length[-1] :].tolist():
        own = merged(data[starts[k] : starts[k] + lengths[k]].tobytes(), ranks, rate, int(seeds[k]), int(places[k]))
        ids[starts[k] : starts[k] + len(own)], left[k] = own, len(own)
    piece = np.repeat(np.arange(len(lengths)), lengths)
    return ids[np.arange(len(ids)) - starts[piece] < left[piece]], left


@functools.lru_cache(2)
def encoder(path: str, pattern: str):
    import regex

    ranks = read_ranks(path)
    return ranks, regex.compile(pattern), joins(ranks)


def token_ids(text: Column, path: str, rate: float = 0.0, seed: Column | int = 0, pattern: str = PIECES) -> Column:
    """Token ids of byte-pair merges over a rank table that all workers can read. rate: the share of merges that are left
    out at random, by seed (a column for other draws in each row, or in each pass) and place, so that reruns agree."""

    @F.arrow_udf(kind("array<int>"))
    def encode(column: pa.Array, seeds: pa.Array) -> pa.Array:
        ranks, cut, tables = encoder(path, pattern)
        missing = column.is_null().to_numpy(zero_copy_only=False)
        raw = [[p.encode() for p in cut.findall(t or "")] for t in column.to_pylist()]
        lengths = np.fromiter((len(p) for x in raw for p in x), np.int64)
        row = np.repeat(np.arange(len(raw)), [len(x) for x in raw])
        data = np.frombuffer(b"".join(p for x in raw for p in x), np.uint8)
        upto = np.cumsum(lengths) - lengths
        if rate:
            first = np.append(upto, len(data))[np.searchsorted(row, np.arange(len(raw)))]
            own = pc.fill_null(seeds, 0).to_numpy(zero_copy_only=False)[row]
            ids, counts = merged_many(data, lengths, upto - first[row], own, ranks, tables, rate)
        else:
            # a piece has the same ids wherever it stands
            pieces = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(np.append(upto, len(data))), pa.py_buffer(data)]).dictionary_encode()
            known, code = pieces.dictionary, pieces.indices.to_numpy(zero_copy_only=False)
            lengths, none = pc.binary_length(known).to_numpy(zero_copy_only=False).astype(np.int64), np.zeros(len(known), np.int64)
            ids, counts = merged_many(np.frombuffer(b"".join(known.to_pylist()), np.uint8), lengths, none, none, ranks, tables, rate)
            ids, counts = ids[spread((np.cumsum(counts) - counts)[code], counts[code])[2]], counts[code]
        ends = np.append(0, np.cumsum(np.bincount(row, counts, len(raw)).astype(np.int64)))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()), mask=pa.array(missing))

    return encode(text, (seed if isinstance(seed, Column) else F.lit(seed)).cast("long"))


def with_labels(rows: DataFrame, encode: Callable[[Column], Column], prefix: list[int], no_timestamps: int, end: int, text: str = "text", text_timestamps: str = "text_timestamps", most: int | None = None) -> DataFrame:
    """Adds labels, labels_timestamps, labels_length and labels_timestamps_length: the ids of both texts (null: none) after
    the prefix, without times with the mark that says so, and before the end id; with `most`, cut to so many."""
    ids = lambda c: F.coalesce(encode(F.col(c)), F.array().cast("array<int>"))
    fixed = lambda x: F.array(*map(F.lit, x)).cast("array<int>")

    def whole(start, c):
        own = ids(c) if most is None else F.slice(ids(c), 1, max(0, most - len(start) - 1))
        return F.concat(fixed(start), own, fixed([end]))

    out = rows.withColumns({"labels": whole([*prefix, no_timestamps], text), "labels_timestamps": whole(prefix, text_timestamps)})
    return out.withColumns({"labels_length": F.size("labels"), "labels_timestamps_length": F.size("labels_timestamps")})
