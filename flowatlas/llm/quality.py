"""Quality classifier: logistic regression over hashed word n-grams, trained with follow-the-regularised-leader updates.

Tokens are runs of word bytes and runs of other visible bytes. Features are hashed n-grams of two kinds of words: the tokens themselves
(lower case, one and two) and their shapes (lower, capitalised or upper case, digits, marks as they are, long, same as the
word before; one to three). A feature's value is the root of its share of the document's n-grams of its kind, so long texts
do not weigh more. All of it is computed from running sums over the bytes of many texts at once.

Training uses at most ``SAMPLE_ROWS`` labelled documents, the first in the order of a hash of the id, dealt to learners with about ``SHARD_ROWS`` each. Each
one makes ``EPOCHS`` passes of FTRL-proximal updates; the mean of their sparse weights is the model, sent to all
workers (at most ``2 ** BITS`` numbers). Scores are sparse dot products over every whole text.

Null and empty texts have no features and get the score of the intercept alone. Null ids are never learned from. Labels that
are null are ignored; an id labelled more than once counts with the mean of its labels, as 1 from a half up. Without any labels every
score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowatlas.llm import common
from flowatlas.llm.common import column, extended, map_arrow, mix, read_table, slices, without, written

#: Bound of the training sample, a documented parameter.
SAMPLE_ROWS = 16_000
SHARD_ROWS, EPOCHS, BITS = 1_000, 10, 18
#: Rates of the updates: alpha, beta; penalties: l1, l2.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
CUT = 0.7
BATCH_CHARS = 1_000_000

_KIND = np.full(256, 2, np.int8)
_KIND[[*range(0x00, 0x21), 0x7F]] = 0
_KIND[common.ALNUM] = 1
_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1
_DIGIT = np.zeros(256, np.int64)
_DIGIT[48:58] = 1
#: Seeds that keep the families of n-grams apart.
_WORD1, _WORD2, _SHAPE1, _SHAPE2, _SHAPE3 = (np.uint64(x * 0x9E3779B97F4A7C15 % 2**64) for x in range(1, 6))


def _running(values: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])


def tokens(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, shape hashes and the document of every token."""
    coded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    buf = np.frombuffer(b" ".join(coded) + b" ", np.uint8)
    kind = _KIND[buf]
    edge = np.flatnonzero(np.diff(kind, prepend=0) != 0)
    starts = edge[kind[edge] > 0]
    ends = np.append(edge, len(buf))[np.searchsorted(edge, starts, side="right")]
    up, down = common._powers(len(buf))
    total = _running(common._BYTE_VALUE[buf] * up[: len(buf)])
    size = ends - starts
    words = mix((total[ends] - total[starts]) * down[starts] + size.astype(np.uint64))
    upper, digit = (_running(t[buf]) for t in (_UPPER, _DIGIT))
    capitals, digits = upper[ends] - upper[starts], digit[ends] - digit[starts]
    mark = kind[starts] == 2
    doc = np.searchsorted(np.cumsum([len(c) + 1 for c in coded]), starts, side="right")
    same = np.concatenate([[False], (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])])[: len(words)]
    shape = np.select([digits > 0, (capitals > 1), (capitals == 1) & (size > 1), capitals == 1], [5, 4, 3, 2], 1)
    shape = shape + 8 * np.minimum(size // 12, 3) + 64 * same
    shapes = np.where(mark, words, mix(shape.astype(np.uint64)))
    return words, shapes, doc


def features(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows: (bounds of the rows, buckets, values)."""
    words, shapes, doc = tokens(texts)
    n, mask = len(texts), np.uint64((1 << BITS) - 1)
    keys, weights = [], []
    second = doc[1:] == doc[:-1]
    third = second[1:] & second[:-1]
    families = (
        (mix(words + _WORD1), doc),
        (mix(words[:-1] * np.uint64(3) + words[1:] + _WORD2)[second], doc[1:][second]),
        (mix(shapes + _SHAPE1), doc),
        (mix(shapes[:-1] * np.uint64(3) + shapes[1:] + _SHAPE2)[second], doc[1:][second]),
        (mix((shapes[:-2] * np.uint64(3) + shapes[1:-1]) * np.uint64(5) + shapes[2:] + _SHAPE3)[third], doc[2:][third]),
    )
    for hashed, of in families:
        # Buckets that meet in one document are one feature with the sum of the values.
        found, times = np.unique(of.astype(np.int64) << BITS | (hashed & mask).astype(np.int64), return_counts=True)
        sizes = np.bincount(of, minlength=n)
        keys.append(found)
        weights.append(np.sqrt(times / sizes[found >> BITS]))
    keys, weights = np.concatenate(keys), np.concatenate(weights)
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    return np.searchsorted(keys >> BITS, np.arange(n + 1)), keys & int(mask), weights


class Learner:
    """FTRL-proximal for logistic loss; the last weight is the intercept."""

    def __init__(self) -> None:
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(at)
        gradient = (sigmoid(float(w @ values)) - label) * values
        square = gradient * gradient
        sigma = (np.sqrt(self.n[at] + square) - np.sqrt(self.n[at])) / ALPHA
        # A bucket may stand twice in one row: add, do not assign.
        np.add.at(self.z, at, gradient - sigma * w)
        np.add.at(self.n, at, square)


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def _train_shard(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["place", "doc_id"])
    learner, examples = Learner(), []
    texts, labels = rows["text"].tolist(), rows["label"].tolist()
    for a, b in slices(texts, BATCH_CHARS):
        bounds, at, values = features(texts[a:b])
        examples += [(np.append(at[x:y], 1 << BITS), np.append(values[x:y], 1.0), label)
                     for x, y, label in zip(bounds[:-1], bounds[1:], labels[a:b])]
    for _ in range(EPOCHS):
        for example in examples:
            learner.learn(*example)
    weights = learner.weights()
    at = np.flatnonzero(weights)
    return pd.DataFrame({"bucket": at, "weight": weights[at]})


def train(docs: DataFrame, labels: DataFrame) -> np.ndarray | None:
    """Weights from ``docs(doc_id, text)`` and ``labels(doc_id, label)``; None without labelled documents."""
    known = labels.filter("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.expr("int(avg(label) >= 0.5)").alias("label"))
    # Ids only; the bound holds for any input, so the sample may be sent to all workers.
    sample = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").withColumn("place", F.xxhash64("doc_id")) \
        .orderBy("place", "doc_id").limit(SAMPLE_ROWS)
    sample = written(sample)
    shards = max(1, round(sample.count() / SHARD_ROWS))
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").withColumn("shard", F.pmod("place", F.lit(shards)))
    parts = rows.groupBy("shard").applyInPandas(_train_shard, "bucket long, weight double")
    model = parts.groupBy("bucket").agg(F.sum("weight").alias("weight")).collect()
    if not model:
        return None
    weights = np.zeros((1 << BITS) + 1)
    for row in model:
        weights[row["bucket"]] = row["weight"] / shards
    return weights


def scored(docs: DataFrame, weights: np.ndarray | None, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1. Other columns are kept; one that has the score's name is replaced."""
    kept = without(docs.columns, score)
    model = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]):
        w = model.value if model.value is not None else np.zeros((1 << BITS) + 1)
        for batch in batches:
            texts = column(batch, text)
            for a, b in slices(texts, BATCH_CHARS):
                bounds, at, values = features(texts[a:b])
                sums = _running(w[at] * values)
                margin = sums[bounds[1:]] - sums[bounds[:-1]] + w[-1]
                part = batch.select(kept).slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sigmoid(margin))], names=[*part.schema.names, score])

    return map_arrow(docs, run, extended(docs, kept, f"`{score}` double"))


def accepted(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` whose score reaches the cut, with the columns of ``docs``; learned from ``labels(doc_id, label)``."""
    rows = docs.select("text", F.struct(*docs.columns).alias("row"))
    return scored(rows, train(docs, labels)).filter(F.col("score") >= cut).select("row.*")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def known_labels(spark, sf_dir: str) -> DataFrame:
    """Labels that may be learned from."""
    return read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")).filter(~held_out())


def op4_quality(spark, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = scored(docs, train(docs, known_labels(spark, sf_dir)))
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
