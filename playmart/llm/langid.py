"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed 1- to 3-grams of the lower-cased text; of ASCII only letters count and all else reads as space,
characters beyond ASCII (letters, digits and marks) stay as they are; values are (1 + log tf) * idf, of length one. Document frequencies come from all rows that may
be learned from. Weights are trained by follow-the-regularised-leader (proximal) with elastic-net penalties on
a bounded sample of these rows (`rows_per_label`, by hash of the id), in one task; a fifth of the sample is held
back to calibrate the temperature of the softmax. Prediction reads every whole text. On the test tables four in five
weights of n-grams in use are zero.

Defined cases: a null text, or one without a letter, is `und` with score 0; so is every text if nothing can be
learned. Ties go to the alphabetically first language. Repeated rows are predicted alike; an empty table gives
an empty result. Columns named like the outputs are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh
from .shingles import slices, text_buffer

UNDETERMINED = "und"
BUCKETS = 1 << 14
CHUNK_BYTES, CHUNK_ROWS = 1 << 19, 128
_PLAIN = np.full(128, 32, "u4")
_PLAIN[97:123] = np.arange(97, 123)


def _counts(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, count) of the n-grams of each text, ordered by text and bucket."""
    raw = data[bounds[0] : bounds[-1]].tobytes().decode()
    c = np.frombuffer(raw.encode("utf-32-le"), "u4")
    first_byte = (data[bounds[0] : bounds[-1]] & 0xC0) != 0x80
    starts = np.concatenate(([0], np.cumsum(first_byte)))[bounds - bounds[0]]
    c = np.where(c < 128, _PLAIN[np.minimum(c, 127)], c)
    n = len(bounds) - 1
    doc = np.repeat(np.arange(n), np.diff(starts))
    mask = np.uint32(BUCKETS - 1)

    def bucket(h: np.ndarray) -> np.ndarray:
        return ((h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(9)) & mask

    one = c * np.uint32(0x9E3779B1)
    keys = [doc[c != 32] * BUCKETS + bucket(one[c != 32])]
    if len(c) > 1:
        two = one[:-1] * np.uint32(31) + c[1:] * np.uint32(0xC2B2AE35)
        same = doc[1:] == doc[:-1]
        keys.append((doc[:-1] * BUCKETS + bucket(two))[same & ((c[:-1] != 32) | (c[1:] != 32))])
    if len(c) > 2:
        three = two[:-1] * np.uint32(31) + c[2:] * np.uint32(0x27D4EB2F)
        keys.append((doc[:-2] * BUCKETS + bucket(three))[(doc[2:] == doc[:-2]) & (c[1:-1] != 32)])
    counts = np.bincount(np.concatenate(keys), minlength=0)
    at = np.flatnonzero(counts)
    return at // BUCKETS, at % BUCKETS, counts[at]


def _chunks(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    for start, stop in slices(bounds, CHUNK_BYTES):
        for at in range(start, stop, CHUNK_ROWS):
            yield at, min(at + CHUNK_ROWS, stop)


def _features(data: np.ndarray, bounds: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    doc, bucket, n = _counts(data, bounds)
    value = (1.0 + np.log(n)) * idf[bucket]
    norm = np.sqrt(np.bincount(doc, value * value, minlength=len(bounds) - 1))
    return doc, bucket, value / norm[doc]


@dataclass(frozen=True)
class Model:
    labels: list[str]
    weights: np.ndarray  # labels x (BUCKETS + 1), the last column for the bias
    idf: np.ndarray
    temperature: float


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Of each bucket over all texts, and the number of texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts = np.zeros(BUCKETS, "i8"), 0
        for b in batches:
            data, bounds = text_buffer(b.column(0))
            texts += len(bounds) - 1
            for start, stop in _chunks(bounds):
                total += np.bincount(_counts(data, bounds[start : stop + 1])[1], minlength=BUCKETS)
        if texts:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(at, BUCKETS).astype("i4")), pa.array(np.append(total[at], texts))], names=["bucket", "n"])

    parts = rows.select(F.lower("text")).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out, texts = np.zeros(BUCKETS, "i8"), 0
    for bucket, n in parts.collect():  # at most BUCKETS + 1 rows
        if bucket == BUCKETS:
            texts = n
        else:
            out[bucket] = n
    return out, texts


def _train(sample: pd.DataFrame, labels: list[str], epochs: int, alpha: float, beta: float, l1: float, l2: float) -> tuple[np.ndarray, float]:
    """Weights by per-coordinate FTRL-proximal, one example at a time, and the temperature."""
    k = len(labels)
    z, n = np.zeros((BUCKETS + 1, k)), np.zeros((BUCKETS + 1, k))
    truth = sample["label"].map({name: i for i, name in enumerate(labels)}).to_numpy()
    rows = [(np.append(b, BUCKETS), np.append(v, 1.0)) for b, v in zip(sample["buckets"], sample["vals"], strict=True)]
    held = np.arange(len(rows)) % 5 == 4

    def weights(at: np.ndarray | slice) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1, 0.0)
        return -shrunk / ((beta + np.sqrt(n[at])) / alpha + l2)

    for _ in range(epochs):
        for i in np.flatnonzero(~held):
            at, x = rows[i]
            w = weights(at)
            logit = x @ w
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[truth[i]] -= 1.0
            g = x[:, None] * p[None, :]
            more = n[at] + g * g
            z[at] += g - (np.sqrt(more) - np.sqrt(n[at])) / alpha * w
            n[at] = more
    final = weights(slice(None))
    logits = np.array([rows[i][1] @ final[rows[i][0]] for i in np.flatnonzero(held)]).reshape(-1, k)
    answers = truth[held]

    # one more answer of every other label: without a wrong one, no temperature would be the least
    wrong = 1.0 / (len(logits) + k)

    def loss(t: float) -> float:
        s = logits / t
        s = s - s.max(axis=1, keepdims=True)
        right = s[np.arange(len(s)), answers]
        return float((np.log(np.exp(s).sum(axis=1)) - right - wrong * (s.sum(axis=1) - k * right)).mean())

    return final.T, _minimised(loss) if len(logits) and k > 1 else 1.0


def _minimised(loss: Callable[[float], float], low: float = -14.0, high: float = 14.0) -> float:
    """The temperature of least loss, sought on a logarithmic scale, where the loss has one minimum."""
    ratio = (5**0.5 - 1) / 2
    while high - low > 1e-3:
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        if loss(math.exp(a)) < loss(math.exp(b)):
            high = b
        else:
            low = a
    return math.exp((low + high) / 2)


def fit(
    df: DataFrame,
    learn: Column,
    label: str = "lang",
    rows_per_label: int = 1500,
    epochs: int = 3,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.5,
    l2: float = 1e-4,
) -> Model | None:
    """Learn from the rows where `learn` holds and text and label are not null.

    The sample for the weights holds about `rows_per_label` rows of each label; the document frequencies, all.
    """
    rows = df.where(learn & F.col("text").isNotNull() & F.col(label).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}  # one row per language
    if not sizes:
        return None
    frequencies, texts = document_frequencies(rows)
    idf = np.log((1.0 + texts) / (1.0 + frequencies)) + 1.0
    labels = sorted(sizes)
    draw = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 30))
    share = F.create_map(*(x for name in labels for x in (F.lit(name), F.lit(int(min(1.0, rows_per_label / sizes[name]) * (1 << 30))))))
    sample = rows.where(draw < share[F.col(label)]).select(draw.alias("draw"), F.col(label).alias("label"), F.lower("text").alias("text"))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, bounds = text_buffer(b.column(2))
            for start, stop in _chunks(bounds):
                doc, bucket, value = _features(data, bounds[start : stop + 1], idf)
                cuts = np.searchsorted(doc, np.arange(stop - start + 1)).astype("i4")
                lists = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (bucket.astype("i4"), value)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(start, stop - start), b.column(1).slice(start, stop - start), *lists], names=["draw", "label", "buckets", "vals"])

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        if parts:
            got = pd.concat(parts).sort_values("draw", kind="stable").reset_index(drop=True)
            weights, temperature = _train(got, labels, epochs, alpha, beta, l1, l2)
            yield pd.DataFrame({"weights": [weights.ravel()], "temperature": [temperature]})

    features = sample.mapInArrow(featured, "draw long, label string, buckets array<int>, vals array<double>")
    got = features.repartition(1).mapInPandas(train, "weights array<double>, temperature double").first()
    if got is None:
        return None
    return Model(labels, np.array(got["weights"]).reshape(len(labels), -1), idf, got["temperature"])


def predict(df: DataFrame, model: Model | None, into: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All columns of `df`, and the language and its score in the columns `into`."""
    base = df.drop(*into)
    if model is None:
        return base.withColumns({into[0]: F.lit(UNDETERMINED), into[1]: F.lit(0.0)})
    shared = df.sparkSession.sparkContext.broadcast((model.labels, model.weights.T.copy(), model.idf, model.temperature))  # labels x BUCKETS values
    # columns go by number meanwhile, as their names may hold dots
    numbered = base.toDF(*(f"c{k}" for k in range(len(base.columns))))
    text = f"c{base.columns.index('text')}"
    rows = numbered.withColumn("lower", F.when(F.col(text).rlike(r"\p{L}"), F.lower(text)))
    schema = numbered.withColumns({"label": F.lit("").cast("string"), "score": F.lit(0.0)}).schema

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, weights, idf, temperature = shared.value
        names = np.array(labels, dtype=object)
        for b in batches:
            last = b.num_columns - 1
            none = b.column(last).is_null().to_numpy(zero_copy_only=False)
            data, bounds = text_buffer(b.column(last))
            for start, stop in _chunks(bounds):
                doc, bucket, value = _features(data, bounds[start : stop + 1], idf)
                n = stop - start
                logits = np.stack([np.bincount(doc, value * weights[bucket, k], minlength=n) for k in range(len(labels))], axis=1)
                logits = (logits + weights[BUCKETS]) / temperature
                p = np.exp(logits - logits.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                best = p.argmax(axis=1)
                off = none[start:stop]
                label = np.where(off, UNDETERMINED, names[best])
                score = np.where(off, 0.0, p[np.arange(n), best])
                part = b.slice(start, n)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(last)), pa.array(label, pa.string()), pa.array(score)], names=schema.names)

    return rows.mapInArrow(predicted, schema).toDF(*base.columns, *into)


def fold(key: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; rows of fold 0 are held out."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5


def identify(df: DataFrame) -> DataFrame:
    """All columns of `df`, held_out, lang_pred and score; learned from the folds 1 to 4."""
    model = fit(df, F.coalesce(fold() != 0, F.lit(False)))
    return predict(df.withColumn("held_out", F.coalesce(fold() == 0, F.lit(False))), model)


def keep_identified(df: DataFrame, least_score: float = 0.4) -> DataFrame:
    """The rows of `df`, with its columns, whose text is in a learned language with a calibrated score of `least_score` or more."""
    model = fit(df, F.coalesce(fold() != 0, F.lit(False)))
    language = fresh(df, "lang_pred")
    score = fresh(df, "score")
    found = predict(df, model, (language, score))
    return found.where((F.col(language) != UNDETERMINED) & (F.col(score) >= least_score)).drop(language, score)
