"""Scores of pairs of texts as column expressions: what has no Spark function, edits of words and matches of n-grams, is
counted over Arrow batches by bit vectors and by sorting; the scores are expressions over these counts."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from scribemill.functions import edits as E


def lists(rows: np.ndarray, missing: np.ndarray) -> pa.Array:
    """Rows of equal length as lists, null where one of the texts is."""
    offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1])
    return pa.ListArray.from_arrays(offsets, pa.array(rows.astype(np.int32).ravel(), pa.int32()), mask=pa.array(missing))


@F.arrow_udf(ArrayType(IntegerType()))
def edits_of_words(a: pa.Array, b: pa.Array) -> pa.Array:
    """Levenshtein distance in words, and the number of words of the first text."""
    codes_a, of_a, codes_b, of_b, known = E.coded_words(a, b)
    found = E.distances(np.concatenate([codes_a, codes_b]), of_a, of_b, max(len(known), 1))
    return lists(np.column_stack([found, np.diff(of_a)]), nulls(a, b))


@F.arrow_udf(IntegerType())
def character_edits(a: pa.Array, b: pa.Array) -> pa.Array:
    codes, of_a, of_b, distinct = E.coded_texts(a, b)
    return pa.array(E.distances(codes, of_a, of_b, distinct).astype(np.int32), pa.int32(), mask=nulls(a, b))


@F.arrow_udf(IntegerType())
def common_characters(a: pa.Array, b: pa.Array) -> pa.Array:
    codes, of_a, of_b, _ = E.coded_texts(a, b)
    return pa.array(E.common_lengths(codes, of_a, of_b).astype(np.int32), pa.int32(), mask=nulls(a, b))


@F.arrow_udf(ArrayType(IntegerType()))
def matches_of_words(a: pa.Array, b: pa.Array) -> pa.Array:
    """Matching n-grams of words of orders 1 to 4, and the numbers of words."""
    codes_a, of_a, codes_b, of_b, _ = E.coded_words(a, b)
    return lists(np.column_stack([E.matched_ngrams(codes_a, of_a, codes_b, of_b), np.diff(of_a), np.diff(of_b)]), nulls(a, b))


@F.arrow_udf(ArrayType(IntegerType()))
def end_words(a: pa.Array, b: pa.Array) -> pa.Array:
    """Of the first words of two texts, then of their last ones: the length of the longest common subsequence of
    characters, and the length of both. Null if a text has no word."""
    (words_a, of_a), (words_b, of_b) = E.words_of(a), E.words_of(b)
    some = (np.diff(of_a) > 0) & (np.diff(of_b) > 0)
    out = np.zeros((len(some), 4), np.int64)
    for k, at in ((0, slice(None, -1)), (2, slice(1, None))):
        codes, x, y, _ = E.coded_texts(*(words.take(pa.array(of[at][some] - (k > 0))) for words, of in ((words_a, of_a), (words_b, of_b))))
        out[some, k], out[some, k + 1] = E.common_lengths(codes, x, y), np.diff(x) + np.diff(y)
    return lists(out, ~some)


def nulls(*columns: pa.Array) -> np.ndarray:
    return np.any([x.is_null().to_numpy(zero_copy_only=False) for x in columns], axis=0)


def word_edits(reference: Column, hypothesis: Column) -> Column:
    """Levenshtein distance in words."""
    return F.get(edits_of_words(reference, hypothesis), F.lit(0))


def wer(reference: Column, hypothesis: Column) -> Column:
    """Word error rate; null for a reference without words."""
    found = edits_of_words(reference, hypothesis)
    return F.get(found, F.lit(0)) / F.nullif(F.get(found, F.lit(1)), F.lit(0))


def cer(reference: Column, hypothesis: Column) -> Column:
    """Character error rate; null for an empty reference."""
    return character_edits(reference, hypothesis) / F.nullif(F.length(reference), F.lit(0))


def edge_cer(text: Column, transcription: Column, n: int = 10, tail: bool = False) -> Column:
    """Edits between the first (or last) n characters over the longer one's length; 0 if both are empty."""
    cut = (lambda x: F.right(x, F.lit(n))) if tail else (lambda x: F.left(x, F.lit(n)))
    a, b = cut(text), cut(transcription)
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(0.0)).otherwise(F.levenshtein(a, b) / longest)


def bleu(reference: Column, hypothesis: Column, weights: tuple = (0.25, 0.25, 0.25, 0.25)) -> Column:
    """Sentence BLEU; orders without a match count 1 / (2^k * 5 / ln(length)), k = 1, 2, ... over these orders.

    0 without a common word; null if a text is null. With weights (0, .25, .5, .25) words alone do not count.
    """
    # one call, whatever uses it
    found = matches_of_words(reference, hypothesis)
    return bleu_of(found, F.get(found, F.lit(4)), F.get(found, F.lit(5)), weights)


def bleu_of(found: Column, r: Column, h: Column, weights: tuple) -> Column:
    """The score by matches of orders 1 to 4 and both numbers of words."""
    missed, terms = F.lit(0), []
    for n, weight in enumerate(weights, 1):
        match = F.get(found, F.lit(n - 1))
        missed = missed + F.when(match == 0, 1).otherwise(0)
        smooth = F.when(h > 1, F.log(h.cast("double")) / (F.pow(F.lit(2.0), missed) * 5)).otherwise(F.lit(0.0))
        p = F.when(match > 0, match.cast("double")).otherwise(smooth) / F.greatest(F.lit(1), h - n + 1)
        if weight:
            terms.append(F.when(p > 0, F.log(p) * weight).otherwise(F.lit(0.0)))
    brevity = F.when(h > r, F.lit(1.0)).when(h > 0, F.exp(1 - r / h)).otherwise(F.lit(0.0))
    score = F.when(F.get(found, F.lit(0)) == 0, F.lit(0.0)).otherwise(brevity * F.exp(functools.reduce(lambda x, y: x + y, terms)))
    return F.when(found.isNotNull(), score)


RECALL_WEIGHTS = (0, 0.25, 0.5, 0.25)


def rouge(reference: Column, hypothesis: Column) -> Column:
    """BLEU of longer n-grams with the texts in each other's place: a recall."""
    found = matches_of_words(reference, hypothesis)
    return bleu_of(found, F.get(found, F.lit(5)), F.get(found, F.lit(4)), RECALL_WEIGHTS)


def indel_ratio(a: Column, b: Column) -> Column:
    """100 * (1 - insertions and deletions / total length); 100 for two empty strings."""
    total = F.length(a) + F.length(b)
    return F.when(total == 0, F.lit(100.0)).otherwise(200.0 * common_characters(a, b) / F.nullif(total, F.lit(0)))


def first_ratio(a: Column, b: Column) -> Column:
    """The indel ratio of the first words; null if a text has none."""
    found = end_words(a, b)
    return 200.0 * F.get(found, F.lit(0)) / F.get(found, F.lit(1))


def last_ratio(a: Column, b: Column) -> Column:
    """The indel ratio of the last words; null if a text has none."""
    found = end_words(a, b)
    return 200.0 * F.get(found, F.lit(2)) / F.get(found, F.lit(3))


def first_word(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"(?U)\S+", 0), F.lit(""))


def last_word(text: Column) -> Column:
    return F.reverse(first_word(F.reverse(text)))
