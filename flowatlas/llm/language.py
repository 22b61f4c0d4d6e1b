"""Language identification: multinomial naive Bayes over hashed character n-grams.

Characters are letters in lower case; every run of other characters counts as one space, so n-grams cover word beginnings and ends. All n-grams of 1 to
``LONGEST`` characters are hashed to ``2 ** BITS`` buckets with array arithmetic over many texts at once. Training counts them per
language in Spark (one partial row per task, language and bucket; nothing is sampled). The log-probabilities form
a small matrix (languages times buckets, its size is checked) that goes to all workers; scoring adds up, per text and language, the
entries of its n-grams.

Null texts and texts without letters are ``und`` with score 0, as is everything if no labelled text was there. Equal scores fall to
the first language in order. The score is the posterior probability of the chosen language.
"""

from __future__ import annotations

import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowatlas.llm.common import column, extended, map_arrow, read_table, slices, without, written

LONGEST, BITS, ALPHA = 3, 15, 0.5
#: Languages times buckets at most in the matrix sent to all workers.
MATRIX_CELLS = 1 << 26
BATCH_CHARS = 1_000_000

_FOLD: list[np.ndarray] = []


def _fold() -> np.ndarray:
    """For each code point its lower-case letter, or 32 if it is no letter."""
    if not _FOLD:
        table = np.full(sys.maxunicode + 1, 32, np.uint32)
        for code in range(sys.maxunicode + 1):
            c = chr(code)
            if c.isalpha():
                low = c.lower()
                table[code] = ord(low) if len(low) == 1 else code
        _FOLD.append(table)
    return _FOLD[0]


def has_letter(text: str | None) -> bool:
    return text is not None and any(unicodedata.category(c)[0] == "L" for c in text)


def grams(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, document of each, whether each document has a letter) of all n-grams."""
    coded = [(" " + (t or "") + " ").encode("utf-32-le", "surrogatepass") for t in texts]
    points = _fold()[np.frombuffer(b"".join(coded), np.uint32)]
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), [len(c) // 4 for c in coded])
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 32) | (points[:-1] != 32) | (doc[1:] != doc[:-1])
    points, doc = points[keep], doc[keep]
    letters = np.bincount(doc[points != 32], minlength=len(texts)) > 0
    buckets, owners = [], []
    value = np.zeros(len(points), np.uint32)
    for n in range(1, LONGEST + 1):
        if len(points) < n:
            break
        value = value[:len(points) - n + 1] * np.uint32(0x01000193) + points[n - 1:] + np.uint32(n)
        ok = doc[n - 1:] == doc[:len(doc) - n + 1]
        if n == 1:
            ok = ok & (points != 32)
        mixed = (value ^ (value >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        buckets.append((mixed >> np.uint32(32 - BITS))[ok])
        owners.append(doc[n - 1:][ok])
    return np.concatenate(buckets), np.concatenate(owners), letters


def counts(rows: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``(lang, bucket, n)`` over all rows with a language; ``bucket`` -1 counts the documents."""
    def run(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = column(batch, text), column(batch, lang)
            for a, b in slices(texts, BATCH_CHARS):
                buckets, doc, _ = grams(texts[a:b])
                names = np.array(langs[a:b], object)
                for name in set(langs[a:b]):
                    mine = names == name
                    held = total.setdefault(name, np.zeros((1 << BITS) + 1, np.int64))
                    held[:-1] += np.bincount(buckets[mine[doc]], minlength=1 << BITS)
                    held[-1] += mine.sum()
        for name, held in total.items():
            at = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(np.where(at == 1 << BITS, -1, at)), pa.array(held[at])],
                                             names=["lang", "bucket", "n"])

    rows = rows.select(text, lang).filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    return map_arrow(rows, run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(rows: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log-priors, log-probabilities by language and bucket)."""
    found = written(counts(rows, text, lang))
    langs = [r[0] for r in found.filter("bucket = -1").select("lang").orderBy("lang").limit(MATRIX_CELLS // (1 << BITS) + 1).collect()]
    if len(langs) << BITS > MATRIX_CELLS:
        raise ValueError("too many languages for a matrix on every worker")
    table = np.zeros((len(langs), (1 << BITS) + 1))
    at = {name: k for k, name in enumerate(langs)}
    for lang_, bucket, n in found.collect():  # at most MATRIX_CELLS rows
        table[at[lang_], bucket] = n
    priors = np.log(np.maximum(table[:, -1], 1)) - np.log(max(table[:, -1].sum(), 1))
    smooth = table[:, :-1] + ALPHA
    return langs, priors, (np.log(smooth) - np.log(smooth.sum(axis=1, keepdims=True))).astype(np.float32)


def predicted(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], text: str = "text") -> DataFrame:
    """``docs`` without the text column, with ``lang_pred`` and ``score``."""
    kept = without(docs.columns, text, "lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        langs, priors, table = shared.value
        for batch in batches:
            texts = column(batch, text)
            rest = batch.select(kept)
            for a, b in slices(texts, BATCH_CHARS):
                n = b - a
                names, scores = ["und"] * n, np.zeros(n)
                if langs:
                    buckets, doc, letters = grams(texts[a:b])
                    sums = np.stack([np.bincount(doc, row[buckets], n) for row in table], axis=1) + priors
                    best = sums.argmax(axis=1)
                    scores = np.where(letters, 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1), 0.0)
                    names = [langs[k] if ok else "und" for k, ok in zip(best.tolist(), letters.tolist())]
                yield pa.RecordBatch.from_arrays([*rest.slice(a, n).columns, pa.array(names), pa.array(scores)], names=[*rest.schema.names, "lang_pred", "score"])

    return map_arrow(docs, run, extended(docs, kept, "lang_pred string, score double"))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op6_language(spark, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out()))
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return predicted(rows, model).select("doc_id", "held_out", "lang_pred", "score")
