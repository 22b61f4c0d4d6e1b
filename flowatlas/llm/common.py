"""Small helpers shared by the operators: tables, arrow batches, word hashes, written tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowatlas.session import scratch_path

#: Rows of a batch that goes to a Python worker.
BATCH_ROWS = 500
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Bytes hashed at once.
PIECE_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Words `[^\x20\x09-\x0D]+`: which bytes of UTF-8 belong to a word.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of text in lower case, upper-case letters counted as their lower case.
ALNUM = np.zeros(256, bool)
ALNUM[0x80:] = True
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = True

_SEED = np.random.Generator(np.random.PCG64(20240607))
_BYTE_VALUE = _SEED.integers(1, 2**63, 256, dtype=np.uint64)[_LOWER]
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_az(text):
    """Lower case for A-Z only, as the contracts ask."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, f"{name}.parquet")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    """``df.mapInArrow`` with batches of at most ``BATCH_ROWS`` rows, unless the session sets the size itself.

    Spark's own default of 10,000 rows is tens of megabytes of text, held several times over by every worker.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH_SETTING) == "10000":
        conf.set(_BATCH_SETTING, str(BATCH_ROWS))
    return df.mapInArrow(run, schema)


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def without(names: list[str], *dropped: str) -> list[str]:
    """Columns that an operator passes on: its own results replace columns of the same name."""
    return [n for n in names if n not in dropped]


def extended(df: DataFrame, kept: list[str], added: str) -> str:
    """Schema of the kept columns and the added ones."""
    return ", ".join([*(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in kept), added])


def slices(texts: list, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` with about ``limit`` characters each, one text at least."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every bit over all 64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, PIECE_BYTES + 4096)
        _POWERS[:] = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            powers = np.full(size, base, np.uint64)
            powers[0] = 1
            _POWERS.append(np.cumprod(powers, dtype=np.uint64))
    return _POWERS[0], _POWERS[1]


def _hash_piece(buf: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of every word of ``buf``; a word is a run of bytes that are ``inside``."""
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    starts, ends = edge[::2], edge[1::2]
    up, down = _powers(len(buf))
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[buf] * up[: len(buf)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def hashed_words(texts: list, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, A-Z as a-z, in order; and the bounds of each text's words.

    The hash of a word is a polynomial over its bytes, taken from running sums, so no loop runs over words. Long
    texts are hashed piece by piece, cut between words.
    """
    hashes, counts, i = [], np.zeros(len(texts), np.int64), 0
    coded = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    while i < len(coded):
        j, size = i, 0
        while j < len(coded) and (j == i or size + len(coded[j]) < PIECE_BYTES):
            size += len(coded[j]) + 1
            j += 1
        buf = np.frombuffer(b"\n".join(coded[i:j]) + b"\n", np.uint8)
        inside = is_word[buf]
        ends = np.cumsum([len(x) + 1 for x in coded[i:j]])
        at = 0
        while at < len(buf):
            cut = min(at + PIECE_BYTES, len(buf))
            if cut < len(buf):
                gaps = np.flatnonzero(~inside[at:cut])
                if len(gaps):
                    cut = at + int(gaps[-1]) + 1
                else:
                    cut += int(np.flatnonzero(~inside[cut:])[0])
            found, starts = _hash_piece(buf[at:cut], inside[at:cut])
            hashes.append(found)
            counts[i:j] += np.diff(np.searchsorted(starts + at, ends), prepend=0)
            at = cut
        i = j
    return np.concatenate([np.zeros(0, np.uint64), *hashes]), np.concatenate([[0], np.cumsum(counts)])
