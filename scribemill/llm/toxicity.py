"""Toxicity: a convolutional text classifier with hashed word embeddings, trained in numpy.

A word's embedding is the sum of two rows of hashed tables, so that two words are alike only where both hashes meet.
Filters of several widths slide over the words of the whole text, and the largest response of each filter (max
pooling) goes to a logistic unit. As pooling passes the gradient to one place a filter, a training step touches few
rows. Scores are calibrated on training rows that were kept from the fit, and thresholds are set there by language.
"""

from __future__ import annotations

import pickle
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scribemill.llm._arrays import ALNUM, coded, hash_binary, mix, sliced, texts, tidy, words

#: labelled rows, and bytes of their texts, that a task fits the model to, at most: those of the smallest crc32 of the id
SAMPLE, SAMPLE_BYTES = 6_000, 64 << 20
WIDTHS = (1, 2, 3)
#: an unknown language's threshold, and the least of any
THRESHOLD = 0.5


@dataclass
class Model:
    """Parameters: tables [2, buckets, dim], filters [width][width, dim, filters], biases, output weights."""

    buckets: int = 1 << 17
    dim: int = 8
    filters: int = 8
    widths: tuple = WIDTHS
    seed: int = 7
    thresholds: dict = field(default_factory=dict)

    def __post_init__(self):
        r = np.random.default_rng(self.seed)
        self.tables = r.normal(0, 0.01, (2, self.buckets, self.dim)).astype(np.float32)
        self.kernels = [r.normal(0, 0.5 / np.sqrt(w), (w, self.dim, self.filters)).astype(np.float32) for w in self.widths]
        self.biases = [np.zeros(self.filters, np.float32) for _ in self.widths]
        self.out = r.normal(0, 0.3, self.filters * len(self.widths)).astype(np.float32)
        self.out_bias, self.scale, self.shift = -2.0, 1.0, 0.0

    def rows(self, distinct: pa.Array) -> np.ndarray:
        """The two table rows of each word."""
        h = hash_binary(distinct)
        return np.stack([h % np.uint64(self.buckets), mix(h + np.uint64(1)) % np.uint64(self.buckets)]).astype(np.int64)

    def pooled(self, embedded: np.ndarray, codes: np.ndarray, starts: np.ndarray, places: bool = False):
        """Largest filter responses of each text, by width; with the place of each if asked for.

        codes: word numbers, each text's followed by max(widths) padding words, whose embedding is the last, zero.
        """
        best, where = [], []
        # a window begins at a word or at the first padding word, and so meets no other text
        ends = np.append(starts[1:], len(codes)) - max(self.widths) + 1
        bounds = np.stack([starts, ends], axis=1).ravel()
        for kernel, w in zip(self.kernels, self.widths, strict=True):
            response = np.zeros((len(codes), self.filters), np.float32)
            for o in range(w):
                response[: len(codes) - o] += (embedded @ kernel[o])[codes[o:]]
            top = np.maximum.reduceat(response, bounds, axis=0)[::2]
            best.append(top)
            if places:
                where.append(np.stack([a + response[a:b].argmax(axis=0) for a, b in zip(starts, ends, strict=True)]))
        return best, where

    def features(self, best):
        return np.concatenate([np.maximum(x + b, 0) for x, b in zip(best, self.biases, strict=True)], axis=1)

    def score(self, distinct: pa.Array, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        a, b = self.rows(distinct)
        embedded = np.concatenate([self.tables[0, a] + self.tables[1, b], np.zeros((1, self.dim), np.float32)])
        z = self.features(self.pooled(embedded, codes, starts)[0]) @ self.out + self.out_bias
        return sigmoid(z * self.scale + self.shift)

    def rejects(self, score: np.ndarray, langs: list) -> np.ndarray:
        return score >= np.array([self.thresholds.get(x, THRESHOLD) for x in langs])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -60, 60)))


def padded(data: np.ndarray, offsets: np.ndarray, pad: int = max(WIDTHS)) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, word codes with `pad` padding words after each text, and where each text starts."""
    found, firsts = words(data, offsets, ALNUM)
    codes, distinct = coded(found)
    n = len(firsts) - 1
    out = np.full(len(codes) + pad * n, len(distinct), dtype=np.int64)
    starts = firsts[:-1] + pad * np.arange(n)
    keep = np.ones(len(out), dtype=bool)
    keep[(firsts[1:] + pad * np.arange(n))[:, None] + np.arange(pad)] = False
    out[keep] = codes
    return distinct, out, starts


def seed_tables(model: Model, distinct: pa.Array, codes: np.ndarray, starts: np.ndarray, labels: np.ndarray) -> None:
    """Start the first dimension at half the words' standardised log-odds of standing in a toxic text, and the first
    filter of every width and its output at responding to it. Without this, pooling shows training few rare words."""
    n = len(distinct) + 1
    doc = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(codes))))
    pairs = np.unique(doc * n + codes)
    toxic = labels[pairs // n] > 0
    yes, no = (np.bincount((pairs % n)[x], minlength=n)[:-1] + 0.5 for x in (toxic, ~toxic))
    odds = np.log(yes / (labels.sum() + 1)) - np.log(no / (len(labels) - labels.sum() + 1))
    z = np.clip(odds / np.sqrt(1 / yes + 1 / no), -3, 6) / 6
    seen = yes + no > 1
    for t, rows in enumerate(model.rows(distinct)):
        total, count = (np.bincount(rows[seen], x[seen], model.buckets) for x in (z, yes + no))
        hits = np.bincount(rows[seen], minlength=model.buckets)
        model.tables[t, :, 0] = np.where(hits > 0, total / np.maximum(hits, 1) / 2, 0)
    for j, kernel in enumerate(model.kernels):
        kernel[:, :, 0] *= 0.1
        kernel[:, 0, 0] = 1
        model.out[j * model.filters] = 1


def train(model: Model, distinct: pa.Array, codes: np.ndarray, starts: np.ndarray, labels: np.ndarray, check=None, epochs: int = 8, batch: int = 64, rate: float = 0.05) -> Model:
    """Adagrad on the logistic loss; of the epochs' models, the one that check(model) rates lowest."""
    best_loss, best_state = np.inf, None
    r = np.random.default_rng(model.seed + 1)
    a, b = model.rows(distinct)
    a, b = np.append(a, 0), np.append(b, 0)
    pad = len(distinct)
    ends = np.append(starts[1:], len(codes))
    params = [*model.kernels, *model.biases, model.out]
    sums = [np.full_like(x, 1e-3) for x in params]
    table_sums = np.full((2, model.buckets), 1e-3, np.float32)
    bias_sum = 1e-3
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        order = r.permutation(len(starts))
        for k in range(0, len(order), batch):
            chosen = order[k : k + batch]
            own = np.concatenate([codes[starts[i] : ends[i]] for i in chosen])
            begin = np.concatenate([[0], np.cumsum([ends[i] - starts[i] for i in chosen])[:-1]])
            used, at = np.unique(own, return_inverse=True)
            embedded = model.tables[0, a[used]] + model.tables[1, b[used]]
            embedded[used == pad] = 0
            best, where = model.pooled(embedded, at, begin, places=True)
            x = model.features(best)
            error = (sigmoid(x @ model.out + model.out_bias) - labels[chosen]).astype(np.float32) / len(chosen)
            grads, back = [], (error[:, None] * model.out) * (x > 0)
            of_words = np.zeros_like(embedded)
            of_biases = []
            for j, (kernel, w) in enumerate(zip(model.kernels, model.widths, strict=True)):
                g = back[:, j * model.filters : (j + 1) * model.filters]
                grad = np.zeros_like(kernel)
                for o in range(w):
                    word = at[np.minimum(where[j] + o, len(at) - 1)]
                    grad[o] = np.einsum("df,dfe->ef", g, embedded[word])
                    np.add.at(of_words, word, g[:, :, None] * kernel[o].T[None])
                grads.append(grad)
                of_biases.append(g.sum(axis=0))
            grads += of_biases + [error @ x]
            for p, s, g in zip(params, sums, grads, strict=True):
                s += g * g
                p -= step * g / np.sqrt(s)
            bias_sum += error.sum() ** 2
            model.out_bias -= step * error.sum() / np.sqrt(bias_sum)
            touched = (np.abs(of_words).sum(axis=1) > 0) & (used != pad)
            for t, rows in ((0, a[used[touched]]), (1, b[used[touched]])):
                g = of_words[touched]
                np.add.at(table_sums[t], rows, (g * g).mean(axis=1))
                np.add.at(model.tables[t], rows, -step * g / np.sqrt(table_sums[t, rows])[:, None])
        if check and (loss := check(model)) < best_loss:
            best_loss, best_state = loss, [x.copy() for x in (model.tables, *params)] + [model.out_bias]
    if best_state:
        model.out_bias = best_state.pop()
        for p, x in zip((model.tables, *params), best_state, strict=True):
            p[...] = x
    return model


def calibrate(model: Model, z: np.ndarray, labels: np.ndarray, langs: list, precision: float = 0.9) -> Model:
    """Platt scaling of the raw scores, then for each language the least threshold (0.5 or more) whose rejections are
    toxic with the given precision; a language that shows none keeps 0.5."""
    scale, shift = 1.0, 0.0
    for _ in range(30):
        p = sigmoid(z * scale + shift)
        w = p * (1 - p) + 1e-6
        grad = np.array([((p - labels) * z).mean() + 1e-4 * (scale - 1), (p - labels).mean()])
        hess = np.array([[(w * z * z).mean() + 1e-4, (w * z).mean()], [(w * z).mean(), w.mean()]])
        scale, shift = np.array([scale, shift]) - np.linalg.solve(hess, grad)
    model.scale, model.shift = float(scale), float(shift)
    p = sigmoid(z * model.scale + model.shift)
    for lang in set(langs):
        own = np.array([x == lang for x in langs])
        for t in np.linspace(THRESHOLD, 0.95, 10):
            hit = own & (p >= t)
            if hit.any() and labels[hit].mean() >= precision:
                model.thresholds[lang] = float(t)
                break
    return model


def fit(docs: DataFrame, labels: DataFrame, held_out_mod: int = 5, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model of the labelled rows whose crc32 of the id modulo held_out_mod is not 0; of more than `sample` rows or
    sample_bytes of text it takes those of the smallest crc32, whole texts. A fifth of them is kept for the calibration.
    Rows without a label or an id are left out, equal rows count once, and an id may have several texts and labels; a
    null text is empty; further columns but lang, which only thresholds use, play no part. Without any row, and for
    empty tables, the model scores all texts alike, and low."""
    key = F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")))
    texts_of = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *([F.col("lang")] if "lang" in docs.columns else [F.lit(None).cast("string").alias("lang")]))
    texts_of = texts_of.withColumn("hash", F.xxhash64("text"))
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where(F.col("label").isNotNull()).where(key % held_out_mod != 0).distinct()
    marks = marks.withColumn("key", key).orderBy("key", "id", "label").limit(sample)
    order = ("key", "id", "label", "hash")
    sizes = texts_of.select("id", "hash", F.octet_length("text").alias("bytes")).join(F.broadcast(marks), "id")
    # the texts of one id may be many: of the rows too, the first ones in order, without their texts at first
    sizes = sizes.groupBy(*order).agg(F.max("bytes").alias("bytes")).orderBy(*order).limit(sample)
    upto = F.sum("bytes").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    chosen = sizes.withColumn("upto", upto).where(F.col("upto") <= sample_bytes).select(*order)
    rows = texts_of.join(F.broadcast(chosen), ["id", "hash"]).dropDuplicates(["id", "hash", "label"]).select("key", F.col("id").cast("string").alias("id"), "text", "lang", "label")

    def learn(batches):
        held = list(batches)
        model = fit_table(pa.Table.from_batches(held)) if held else Model()
        yield pa.record_batch([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    # the sample is bounded, so one task learns from it; the driver gets the parameters only
    found = rows.repartition(1).mapInArrow(tidy(learn), "model binary").first()
    return pickle.loads(found["model"]) if found else Model()


def fit_table(rows: pa.Table) -> Model:
    """The model of a table (key, id, text, lang, label), in whatever order its rows come."""
    rows = rows.sort_by([(c, "ascending") for c in ("key", "id", "label", "text")])
    model = Model()
    if not rows.num_rows:
        return model
    data, offsets = texts(rows.column("text"))
    distinct, codes, starts = padded(data, offsets)
    marks, langs, keys = rows.column("label").to_numpy().astype(float), rows.column("lang").to_pylist(), rows.column("key").to_pylist()
    del rows, data
    kept = np.array([zlib.crc32(f"calibrate {k}".encode()) % 5 == 0 for k in keys])
    parts = np.split(codes, starts[1:])

    def part(chosen):
        own = [parts[i] for i in np.flatnonzero(chosen)]
        return np.concatenate(own), np.concatenate([[0], np.cumsum([len(x) for x in own])[:-1]]).astype(np.int64)

    def raw(model):
        a, b = model.rows(distinct)
        embedded = np.concatenate([model.tables[0, a] + model.tables[1, b], np.zeros((1, model.dim), np.float32)])
        return (model.features(model.pooled(embedded, *part(kept))[0]) @ model.out + model.out_bias).astype(float)

    tuned = kept.any() and 0 < marks[kept].sum() < kept.sum()

    def loss(model):
        z = raw(model)
        scaled = calibrate(Model(buckets=1), z, marks[kept], [])
        p = np.clip(sigmoid(z * scaled.scale + scaled.shift), 1e-6, 1 - 1e-6)
        return -(marks[kept] * np.log(p) + (1 - marks[kept]) * np.log(1 - p)).mean()

    if (~kept).any():
        own = part(~kept)
        seed_tables(model, distinct, *own, marks[~kept])
        train(model, distinct, *own, marks[~kept], loss if tuned else None)
    if tuned:
        calibrate(model, raw(model), marks[kept], [x for x, k in zip(langs, kept, strict=True) if k])
    return model


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: bool = False, names: tuple = ("score", "rejected")) -> DataFrame:
    """score (0 to 1) and rejected (by the language's threshold) for every row, with the id or, if `keep`, all columns.
    Columns of docs that have the new ones' names are replaced.

    Null and empty texts have a score too. Language decides on the threshold alone.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)
    columns = [c for c in docs.columns if c not in names] if keep else [id_col]
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    row = docs.select(*columns, F.col(text_col).cast("string").alias("__text"), lang.alias("__lang"))

    def run(batches):
        for batch in batches:
            data, offsets = texts(batch.column(len(columns)))
            scores = [np.zeros(0)]
            for i, j in sliced(offsets, 4 << 20):
                scores.append(sent.value.score(*padded(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])))
            score = np.concatenate(scores)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], pa.array(score), pa.array(sent.value.rejects(score, batch.column(len(columns) + 1).to_pylist()))], names=[*columns, *names])

    from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

    return row.mapInArrow(tidy(run), StructType([*(docs.schema[c] for c in columns), StructField(names[0], DoubleType()), StructField(names[1], BooleanType())]))


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted, rejected of every document."""
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = classify(docs, fit(docs, labels))
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "rejected")
