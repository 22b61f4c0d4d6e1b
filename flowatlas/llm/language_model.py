"""Language-model scores: interpolated modified Kneser-Ney over words, counted in Spark, memory-mapped by the workers.

The order is a parameter: trigrams or bigrams. Words are hashed to 64 bits; the vocabulary is the sorted array of their hashes, and a
word's place in it is its id. A bigram is one 64-bit number, the id of the word before (or of the text's start) and the id of the word; a trigram is one,
too, the place of its first two words among the bigrams and the id of its last. All are sorted arrays. Spark jobs build the model, each from partial
counts per task that are shuffled by ranges: words (ranges of the hash, by the bytes of the texts), bigrams (ranges of the number, cut by expected mass,
so the followers of a very frequent word are spread over ranges), trigrams (the same ranges of their first two words; a bigram heavier than a range is cut by
the word that follows), the bigrams that trigrams end in (different words before them), and sums per word. Every range is merged by one
task of bounded size, which writes its arrays to the shared folder; the number of ranges grows with the corpus. Nothing is pruned.

The longest n-grams count how often they occur, shorter ones the different words before them; bigrams at the start of a text, which no word
comes before, count how often they occur. The first word of a text has the start as its only context.

The model's folder lies in the shared folder and must be one that workers can open as files, since they map the arrays into memory
and look a batch's distinct words, bigrams and trigrams up by binary search. Files are written aside and renamed, so a task that is
run twice leaves one result.

Null texts count as empty; an empty text is its end alone. Every text ends with one end token. Without any training text all probabilities
are 1, so scores are 0.
"""

from __future__ import annotations

import contextlib
import os
import urllib.parse

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowatlas.llm.common import SPACED, column, extended, hashed_words, map_arrow, read_table, slices, without
from flowatlas.session import scratch_path

#: Characters scored together; tokens a task counts before it passes its partial counts on; tokens per range of bigrams.
BATCH_CHARS, FLUSH, RANGE_TOKENS = 1_000_000, 4_000_000, 4_000_000
#: Bytes of text per range of words; followers up to which a context's sums are added up when they are asked for.
WORD_RANGE_BYTES, WIDE = 1 << 25, 16
#: Words of the longest n-grams.
ORDER = 3
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Stands for the end of a text among the word hashes.
END = np.uint64(0x5EED0FE4D0F7E87)


def tokens(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of every text with one end each, and the bounds of the texts."""
    words, bounds = hashed_words(texts, SPACED)
    bounds = bounds + np.arange(len(bounds))
    out = np.full(bounds[-1], END, np.uint64)
    inner = np.ones(len(out), bool)
    inner[bounds[1:] - 1] = False
    out[inner] = words
    return out, bounds


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys with the sums of their counts."""
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order].astype(np.int64)
    starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return k[starts], np.add.reduceat(c, starts) if len(k) else c


def _save(folder: str, name: str, values: np.ndarray) -> None:
    path = os.path.join(folder, f"{name}.npy")
    aside = f"{path}.{os.getpid()}-{os.urandom(4).hex()}"
    with open(aside, "wb") as f:
        np.save(f, values)
    os.replace(aside, path)


def _small(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts as bytes, and the entries that are larger."""
    at = np.flatnonzero(counts > 255)
    return np.minimum(counts, 255).astype(np.uint8), np.stack([at, counts[at]])


def _save_counts(folder: str, name: str, part: int, counts: np.ndarray) -> None:
    small, large = _small(counts)
    _save(folder, f"{name}{part}", small)
    _save(folder, f"{name}-large{part}", large)


def _in_bytes(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positive numbers as one byte each: larger ones become several bytes (how many per number, the bytes)."""
    times = (n + 254) // 255
    out = np.full(int(times.sum()), 255, np.uint8)
    out[np.cumsum(times) - 1] = n - 255 * (times - 1)
    return times, out


def _planes(values: np.ndarray) -> bytes:
    """Numbers with their lowest bytes first, then the next ones, and so on: the zeros of small numbers stand together and compress in the shuffle."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _from_planes(blob: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(size, len(blob) // size).T).view(kind).ravel()


def _steps(values: np.ndarray) -> np.ndarray:
    """Sorted numbers as differences."""
    return np.diff(values, prepend=values.dtype.type(0))


def _classes(counts: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Per group of neighbours that begins at ``heads``: counts of 1, of 2, of 3 or more, and their sum."""
    return np.stack([np.add.reduceat(x.astype(np.int64), heads) for x in (counts == 1, counts == 2, counts >= 3, counts)], axis=1) \
        if len(heads) else np.zeros((0, 4), np.int64)


def _heads(values: np.ndarray) -> np.ndarray:
    """Where a new value begins in a sorted array."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)


class Parts:
    """A sorted array in several files, ranges of its values."""

    def __init__(self, folder: str, name: str, bounds: np.ndarray):
        self.bounds = bounds
        self.parts = [np.load(os.path.join(folder, f"{name}{k}.npy"), mmap_mode="r") for k in range(len(bounds) + 1)]
        self.offsets = np.cumsum([0, *map(len, self.parts)])

    def find(self, values: np.ndarray) -> np.ndarray:
        """Place of each of the sorted values, -1 where it is missing."""
        out = np.full(len(values), -1, np.int64)
        cuts = np.concatenate([[0], np.searchsorted(values, self.bounds), [len(values)]])
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            part, mine = self.parts[k], values[cuts[k]:cuts[k + 1]]
            if len(part):
                at = np.minimum(np.searchsorted(part, mine), len(part) - 1)
                out[cuts[k]:cuts[k + 1]] = np.where(part[at] == mine, at + self.offsets[k], -1)
        return out

    def take(self, at: np.ndarray) -> np.ndarray:
        """Values at sorted places."""
        return Column_.take(self, at)


class Column_:
    """Values aligned with ``Parts``, in as many files."""

    def __init__(self, folder: str, name: str, parts: Parts):
        self.offsets = parts.offsets
        self.parts = [np.load(os.path.join(folder, f"{name}{k}.npy"), mmap_mode="r") for k in range(len(parts.parts))]

    def take(self, at: np.ndarray) -> np.ndarray:
        """Values at sorted places."""
        out = np.empty((len(at), *self.parts[0].shape[1:]), self.parts[0].dtype)
        cuts = np.searchsorted(at, self.offsets)
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            out[cuts[k]:cuts[k + 1]] = self.parts[k][at[cuts[k]:cuts[k + 1]] - self.offsets[k]]
        return out


class Counts:
    """Counts aligned with ``Parts``: a byte each, and the larger ones aside."""

    def __init__(self, folder: str, name: str, parts: Parts):
        self.small, self.large = Column_(folder, name, parts), Column_(folder, f"{name}-large", parts)

    def inside(self, k: int, at: np.ndarray) -> np.ndarray:
        """Counts at places of part ``k``."""
        out = self.small.parts[k][at].astype(np.int64)
        large, big = self.large.parts[k], np.flatnonzero(out == 255)
        if len(big) and large.shape[1]:
            j = np.minimum(np.searchsorted(large[0], at[big]), large.shape[1] - 1)
            out[big] = np.where(large[0][j] == at[big], large[1][j], 255)
        return out

    def take(self, at: np.ndarray) -> np.ndarray:
        """Counts at sorted places."""
        offsets = self.small.offsets
        out, cuts = np.zeros(len(at), np.int64), np.searchsorted(at, offsets)
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            out[cuts[k]:cuts[k + 1]] = self.inside(k, at[cuts[k]:cuts[k + 1]] - offsets[k])
        return out


def _opened(model: dict, name: str, bounds: np.ndarray) -> Parts:
    """Arrays of the model that a worker keeps open; those of other models are let go."""
    key = (model["folder"], name)
    if key not in _OPEN:
        if _OPEN and next(iter(_OPEN))[0] != model["folder"]:
            _OPEN.clear()
        _OPEN[key] = Parts(model["folder"], name, bounds)
    return _OPEN[key]


_OPEN: dict = {}


def _word_ids(vocabulary: Parts, hashes: np.ndarray) -> np.ndarray:
    distinct, back = np.unique(hashes, return_inverse=True)
    return vocabulary.find(distinct)[back]


def _pair_keys(model: dict, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the bigram that ends in each token, the tokens' ids and the bounds of the texts."""
    hashes, bounds = tokens(texts)
    ids = _word_ids(_opened(model, "words", model["word_bounds"]), hashes)
    before = np.concatenate([[model["words"]], ids[:-1]])
    before[bounds[:-1]] = model["words"]
    return before.astype(np.uint64) << np.uint64(32) | ids.astype(np.uint64), ids, bounds


def _gram_keys(model: dict, texts: list) -> np.ndarray:
    """Number of every trigram: the place of its first two words among the bigrams, and its last word's id."""
    keys, ids, bounds = _pair_keys(model, texts)
    distinct, back = np.unique(keys, return_inverse=True)
    places = _opened(model, "pairs", model["pair_bounds"]).find(distinct)[back]
    later = np.ones(len(keys), bool)
    later[bounds[:-1]] = False
    at = np.flatnonzero(later)
    return places[at - 1].astype(np.uint64) << np.uint64(model["bits"]) | ids[at].astype(np.uint64)


def _folder(docs: DataFrame) -> str:
    path = scratch_path(docs.sparkSession, "language-model")
    at = urllib.parse.urlparse(path)
    if at.scheme not in ("", "file"):
        raise RuntimeError("the shared folder must be mounted on all machines: workers map the model into memory")
    os.makedirs(at.path)
    return at.path


def _partial(text: str, keys_of, emit):
    """Partial counts of the keys of all texts, passed on every ``FLUSH`` keys."""
    def run(batches):
        keys, counts, held = [], [], 0
        for batch in batches:
            texts = column(batch, text)
            for a, b in slices(texts, BATCH_CHARS):
                k, c = np.unique(keys_of(texts[a:b]), return_counts=True)
                keys.append(k)
                counts.append(c)
                held += len(k)
                if held >= FLUSH:
                    yield from emit(*_merge(keys, counts))
                    keys, counts, held = [], [], 0
        if keys:
            yield from emit(*_merge(keys, counts))

    return run


def _word_rows(bounds: np.ndarray):
    def emit(keys, counts):
        cuts = np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]])
        for part in np.flatnonzero(np.diff(cuts)).tolist():
            a, b = cuts[part], cuts[part + 1]
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), *(pa.array([_planes(x)], pa.binary()) for x in (_steps(keys[a:b]), counts[a:b]))],
                                             names=["part", "keys", "counts"])

    return emit


CODED = "part int, context binary, runs binary, word binary, counts binary"


def _first_contexts(bounds: np.ndarray, shift: int) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.uint64), bounds >> np.uint64(shift)])


def _coded(bounds: np.ndarray, shift: int):
    """Numbers (context above ``shift`` bits, word below) by range: each context once with its run of words, counts as bytes."""
    first_of = _first_contexts(bounds, shift)

    def emit(keys, counts):
        times, counts = _in_bytes(counts)
        keys = np.repeat(keys, times)
        cuts = np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]])
        for part in np.flatnonzero(np.diff(cuts)).tolist():
            mine = keys[cuts[part]:cuts[part + 1]]
            contexts, n = np.unique(mine >> np.uint64(shift), return_counts=True)
            times, runs = _in_bytes(n)
            contexts = np.repeat(contexts - first_of[part], times)
            if contexts[-1] >= 2**32:
                raise ValueError("a range of more contexts than 32 bits count")
            blobs = (_steps(contexts).astype(np.uint32), runs, (mine & np.uint64(2**shift - 1)).astype(np.uint32), counts[cuts[part]:cuts[part + 1]])
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), *(pa.array([_planes(x)], pa.binary()) for x in blobs)],
                                             names=["part", "context", "runs", "word", "counts"])

    return emit


def _join(pdf: pd.DataFrame, name: str, kind) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in pdf[name]]


def _unpacked(pdf: pd.DataFrame, name: str, kind) -> list[np.ndarray]:
    return [_from_planes(x, kind) for x in pdf[name]]


def _decoded(pdf: pd.DataFrame, bounds: np.ndarray, shift: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Range, its distinct sorted numbers and their counts."""
    part = int(pdf["part"].iloc[0])
    first = _first_contexts(bounds, shift)[part]
    keys = [(np.repeat(np.cumsum(c, dtype=np.uint64), r) + first) << np.uint64(shift) | w for c, r, w in
            zip(_unpacked(pdf, "context", np.uint32), _unpacked(pdf, "runs", np.uint8), _unpacked(pdf, "word", np.uint32))]
    return part, *_merge(keys, _unpacked(pdf, "counts", np.uint8))


def _finish_words(folder: str):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        part = int(pdf["part"].iloc[0])
        keys, counts = _merge([np.cumsum(x) for x in _unpacked(pdf, "keys", np.uint64)], _unpacked(pdf, "counts", np.int64))
        _save(folder, f"words{part}", keys)
        _save(folder, f"count{part}", counts)
        return pd.DataFrame({"part": [part], "n": [len(keys)], "total": [int(counts.sum())]})

    return run


SUMS = "part int, context binary, sums binary, word binary, preceded binary, times array<long>"


def _times(counts: np.ndarray) -> list[int]:
    return [int((counts == t).sum()) for t in (1, 2, 3, 4)]


def _sums(keys: np.ndarray, counts: np.ndarray, starts: np.ndarray) -> pd.DataFrame:
    """What a range of bigrams adds to its words: sums of followers, and how many bigrams end in them."""
    before, word = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
    heads = _heads(before)
    context, sums = before[heads], _classes(counts, heads)
    words, preceded = np.unique(word, return_counts=True)
    rows = []
    for k in range(len(starts) - 1):
        a, b = np.searchsorted(context, starts[k:k + 2])
        c, d = np.searchsorted(words, starts[k:k + 2])
        if b > a or d > c:
            rows.append((k, (context[a:b] - starts[k]).astype(np.uint32).tobytes(), sums[a:b].astype(np.uint32).tobytes(),
                         (words[c:d] - starts[k]).astype(np.uint32).tobytes(), preceded[c:d].astype(np.uint32).tobytes(), [0, 0, 0, 0]))
    rows.append((-1, b"", b"", b"", b"", _times(counts)))
    return pd.DataFrame(rows, columns=["part", "context", "sums", "word", "preceded", "times"])


def _finish_pairs(model: dict):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        part, keys, counts = _decoded(pdf, model["pair_bounds"], 32)
        _save(model["folder"], f"pairs{part}", keys)
        _save_counts(model["folder"], "times", part, counts)
        if model["order"] == 2:
            return _sums(keys, counts, model["offsets"])
        heavy = np.flatnonzero(counts > RANGE_TOKENS)
        return pd.DataFrame({"part": [part], "n": [len(keys)], "at": [heavy.tolist()], "count": [counts[heavy].tolist()]})

    return run


def _finish_grams(model: dict):
    """Writes a range of trigrams; the sums of followers only of contexts with more than ``WIDE`` of them."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        folder = model["folder"]
        part, keys, counts = _decoded(pdf, model["gram_bounds"], model["bits"])
        _save(folder, f"grams{part}", keys)
        _save_counts(folder, "gram-times", part, counts)
        contexts = keys >> np.uint64(model["bits"])
        n = np.diff(_heads(contexts), append=len(contexts))
        wide = np.repeat(n > WIDE, n)
        contexts, heads = contexts[wide], _heads(contexts[wide])
        _save(folder, f"wide{part}", contexts[heads])
        _save(folder, f"wide-sums{part}", _classes(counts[wide], heads))
        return pd.DataFrame({"times": [_times(counts)]})

    return run


def _preceding(model: dict):
    """Per distinct trigram, its last two words as a bigram with one more different word before it."""
    emit = _coded(model["pair_bounds"], 32)

    def run(batches):
        pairs = _opened(model, "pairs", model["pair_bounds"])
        for batch in batches:
            for part in batch.column(0).to_pylist():
                if part <= len(model["pair_bounds"]):  # every range of bigrams is finished, also without any
                    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), *[pa.array([b""], pa.binary())] * 4],
                                                     names=["part", "context", "runs", "word", "counts"])
                if part <= len(model["gram_bounds"]):
                    keys = np.load(os.path.join(model["folder"], f"grams{part}.npy"), mmap_mode="r")
                    places, words = (keys >> np.uint64(model["bits"])).astype(np.int64), keys & np.uint64(2 ** model["bits"] - 1)
                    middle = pairs.take(places) & np.uint64(0xFFFFFFFF)
                    yield from emit(*np.unique(middle << np.uint64(32) | words, return_counts=True))

    return run


def _finish_preceding(model: dict):
    """Counts of the bigrams in a trigram model: different words before them; how often texts begin with them."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        part, found, before = _decoded(pdf, model["pair_bounds"], 32)
        keys, counts = (np.load(os.path.join(model["folder"], f"{name}{part}.npy")) for name in ("pairs", "times"))
        counts = counts.astype(np.int64)
        large = np.load(os.path.join(model["folder"], f"times-large{part}.npy"))
        counts[large[0]] = large[1]
        counts[np.searchsorted(keys, found)] = before
        _save_counts(model["folder"], "seen", part, counts)
        return _sums(keys, counts, model["offsets"])

    return run


def _finish_sums(model: dict):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        part = int(pdf["part"].iloc[0])
        n = int(model["offsets"][part + 1] - model["offsets"][part])
        follow, preceded = np.zeros((n, 4), np.int64), np.zeros(n, np.int64)
        for at, sums in zip(_join(pdf, "context", np.uint32), _join(pdf, "sums", np.uint32)):
            follow[at] += sums.reshape(-1, 4)
        for at, times in zip(_join(pdf, "word", np.uint32), _join(pdf, "preceded", np.uint32)):
            preceded[at] += times
        _save(model["folder"], f"follow{part}", follow)
        _save(model["folder"], f"preceded{part}", preceded)
        return pd.DataFrame({"times": [_times(preceded)], "three": [int((preceded >= 3).sum())], "total": [int(preceded.sum())]})

    return run


def discounts(times: list[int]) -> np.ndarray:
    """Discounts for counts of 0, 1, 2 and 3 or more, from how many entries have counts 1 to 4."""
    n1, n2, n3, n4 = times
    if not (n1 and n2 and n3):
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    found = np.array([1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    # A discount of nothing would leave unseen followers without probability.
    return np.concatenate([[0.0], np.where(found > 0, np.minimum(found, [1.0, 2.0, 3.0]), [0.5, 1.0, 1.5])])


def _words_at(spark: SparkSession, model: dict, masses: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words that hold the given running masses of all tokens, and how far into a word each mass lies."""
    folder, offsets, sums = model["folder"], model["offsets"], model["word_sums"]
    ends = np.cumsum(sums)
    parts = np.minimum(np.searchsorted(ends, masses, side="right"), len(sums) - 1)

    def run(frames):
        for frame in frames:
            for part in frame["id"].tolist():
                mine = np.flatnonzero(parts == part)
                if not len(mine):
                    continue
                counts = np.load(os.path.join(folder, f"count{part}.npy"))
                inside, rest = np.cumsum(counts), masses[mine] - (ends[part] - sums[part])
                k = np.minimum(np.searchsorted(inside, rest, side="right"), len(inside) - 1)
                yield pd.DataFrame({"target": mine, "word": int(offsets[part]) + k, "share": np.clip((rest - (inside[k] - counts[k])) / counts[k], 0.0, 0.999999)})

    words, shares = np.zeros(len(masses), np.int64), np.zeros(len(masses))
    for r in spark.range(0, len(sums), 1, len(sums)).mapInPandas(run, "target long, word long, share double").collect():
        words[r["target"]], shares[r["target"]] = r["word"], r["share"]
    return words, shares


def _pair_bounds(spark: SparkSession, model: dict, ranges: int) -> np.ndarray:
    """Numbers that cut the bigrams into ranges of about the same mass if neighbours were independent.

    A word with the mass of several ranges is cut by the word that follows.
    """
    if ranges < 2:
        return np.zeros(0, np.uint64)
    words, shares = _words_at(spark, model, np.arange(1, ranges) * (model["tokens"] / ranges))
    followers, _ = _words_at(spark, model, shares * model["tokens"])
    return np.unique(words.astype(np.uint64) << np.uint64(32) | followers.astype(np.uint64))


def _gram_bounds(spark: SparkSession, model: dict, offsets: np.ndarray, heavy: list[tuple[int, int]]) -> np.ndarray:
    """The ranges of the bigrams, whose followers have the same mass; bigrams heavier than a range are cut by the word that follows."""
    bits = model["bits"]
    bounds = [int(x) << bits for x in offsets[1:-1]]
    shares = [k * RANGE_TOKENS / count for _, count in heavy for k in range(1, -(-count // RANGE_TOKENS))]
    followers = iter(_words_at(spark, model, np.array(shares) * model["tokens"])[0].tolist() if shares else [])
    for place, count in heavy:
        bounds += [place << bits, (place + 1) << bits, *(place << bits | next(followers) for _ in range(1, -(-count // RANGE_TOKENS)))]
    return np.unique(np.array(bounds, np.uint64))


def _by_part(rows: DataFrame, ranges: int):
    """A task per range, however many partitions the session gives to a shuffle."""
    return rows.repartition(ranges, "part").groupBy("part")


@contextlib.contextmanager
def _shuffles_released(spark: SparkSession):
    """Jobs begun inside remove their shuffle files when they end: what they leave are the model's files. The session's setting comes back."""
    before = spark.conf.get(_RELEASE, None)
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.unset(_RELEASE) if before is None else spark.conf.set(_RELEASE, before)


def train(docs: DataFrame, text: str = "text", order: int = ORDER) -> dict:
    """Model of all texts in ``docs``, of bigrams (``order`` 2) or trigrams (3): a folder of arrays and the numbers that belong to it."""
    if order not in (2, 3):
        raise ValueError("bigrams (2) or trigrams (3)")
    with _shuffles_released(docs.sparkSession):
        return _train(docs, text, order)


def _train(docs: DataFrame, text: str, order: int) -> dict:
    spark = docs.sparkSession
    folder = _folder(docs)
    docs = docs.select(text)
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    parts = max(1, -(-size // WORD_RANGE_BYTES))
    bounds = (np.arange(1, parts, dtype=object) * 2**64 // parts).astype(np.uint64)
    rows = _by_part(map_arrow(docs, _partial(text, lambda texts: tokens(texts)[0], _word_rows(bounds)), "part int, keys binary, counts binary"), parts) \
        .applyInPandas(_finish_words(folder), "part int, n long, total long").collect()
    found = {r["part"]: r for r in rows}
    for k in range(parts):
        if k not in found:
            _save(folder, f"words{k}", np.zeros(0, np.uint64))
            _save(folder, f"count{k}", np.zeros(0, np.int64))
    sizes = [found[k]["n"] if k in found else 0 for k in range(parts)]
    words, total = sum(sizes), sum(r["total"] for r in rows)
    if words >= 2**32 - 1:
        raise ValueError("more words than 32-bit ids")
    # The start of a text is the id behind the last word, in a part of its own.
    model = {"folder": folder, "order": order, "word_bounds": bounds, "words": words, "tokens": total, "offsets": np.cumsum([0, *sizes, 1]),
             "word_sums": np.array([found[k]["total"] if k in found else 0 for k in range(parts)])}
    model["pair_bounds"] = _pair_bounds(spark, model, round(total / RANGE_TOKENS))
    ranges = len(model["pair_bounds"]) + 1
    rows = map_arrow(docs, _partial(text, lambda texts: _pair_keys(model, texts)[0], _coded(model["pair_bounds"], 32)), CODED)
    if order == 2:
        sums = _by_part(rows, ranges).applyInPandas(_finish_pairs(model), SUMS)
    else:
        found = {r["part"]: r for r in _by_part(rows, ranges).applyInPandas(_finish_pairs(model), "part int, n long, at array<long>, count array<long>").collect()}
        _save_empty(folder, "pairs", "times", ranges)
        offsets = np.cumsum([0, *(found[k]["n"] if k in found else 0 for k in range(ranges))])
        model["bits"] = max(1, words.bit_length())
        if int(offsets[-1]).bit_length() + model["bits"] > 64:
            raise ValueError("more bigrams than the numbers of trigrams can hold")
        heavy = [(int(offsets[k]) + at, count) for k in sorted(found) for at, count in zip(found[k]["at"], found[k]["count"])]
        model["gram_bounds"] = _gram_bounds(spark, model, offsets, heavy)
        gram_ranges = len(model["gram_bounds"]) + 1
        rows = map_arrow(docs, _partial(text, lambda texts: _gram_keys(model, texts), _coded(model["gram_bounds"], model["bits"])), CODED)
        times = _by_part(rows, gram_ranges).applyInPandas(_finish_grams(model), "times array<long>").collect()
        _save_empty(folder, "grams", "gram-times", gram_ranges)
        for k in range(gram_ranges):
            if not os.path.exists(os.path.join(folder, f"wide{k}.npy")):
                _save(folder, f"wide{k}", np.zeros(0, np.uint64))
                _save(folder, f"wide-sums{k}", np.zeros((0, 4), np.int64))
        model["gram_discounts"] = discounts(np.sum([[0, 0, 0, 0], *(r["times"] for r in times)], axis=0).tolist())
        every = max(ranges, gram_ranges)
        rows = spark.range(0, every, 1, every).mapInArrow(_preceding(model), CODED)
        sums = _by_part(rows, ranges).applyInPandas(_finish_preceding(model), SUMS)
    # Two jobs read these sums: written, so that the bigrams are merged once.
    path = scratch_path(spark, "sums.parquet")
    sums.write.parquet(path)
    sums = spark.read.parquet(path)
    times = np.sum([[0, 0, 0, 0], *(r["times"] for r in sums.filter("part = -1").select("times").collect())], axis=0)
    ends = _by_part(sums.filter("part >= 0"), parts + 1).applyInPandas(_finish_sums(model), "times array<long>, three long, total long").collect()
    for k in range(parts + 1):
        if not os.path.exists(os.path.join(folder, f"follow{k}.npy")):
            _save(folder, f"follow{k}", np.zeros((int(model["offsets"][k + 1] - model["offsets"][k]), 4), np.int64))
            _save(folder, f"preceded{k}", np.zeros(int(model["offsets"][k + 1] - model["offsets"][k]), np.int64))
    _save_empty(folder, "pairs", "times", ranges)
    lower = np.sum([[0, 0, 0, 0], *(r["times"] for r in ends)], axis=0)
    pairs = sum(r["total"] for r in ends)
    model["discounts"], model["lower_discounts"] = discounts(times.tolist()), discounts(lower.tolist())
    d, three = model["lower_discounts"], sum(r["three"] for r in ends)
    model["pairs"] = pairs
    model["lower_rest"] = float((d[1] * lower[0] + d[2] * lower[1] + d[3] * three) / pairs) if pairs else 1.0
    return model


def _save_empty(folder: str, keys: str, counts: str, ranges: int) -> None:
    """Files of the ranges that no row fell into."""
    for k in range(ranges):
        if not os.path.exists(os.path.join(folder, f"{keys}{k}.npy")):
            _save(folder, f"{keys}{k}", np.zeros(0, np.uint64))
            _save_counts(folder, counts, k, np.zeros(0, np.int64))


class Scorer:
    """A worker's view of a model."""

    def __init__(self, model: dict):
        self.model, folder = model, model["folder"]
        self.words = Parts(folder, "words", model["word_bounds"])
        self.counts = Column_(folder, "count", self.words)
        self.contexts = Parts.__new__(Parts)  # only its offsets: ids are places, the start is one more part
        self.contexts.offsets, self.contexts.parts = model["offsets"], [None] * (len(model["offsets"]) - 1)
        self.follow, self.preceded = Column_(folder, "follow", self.contexts), Column_(folder, "preceded", self.contexts)
        self.pairs = Parts(folder, "pairs", model["pair_bounds"])
        self.times = Counts(folder, "times" if model["order"] == 2 else "seen", self.pairs)
        if model["order"] == 3:
            self.grams = Parts(folder, "grams", model["gram_bounds"])
            self.gram_times = Counts(folder, "gram-times", self.grams)
            self.wide, self.wide_sums = (Column_(folder, name, self.grams) for name in ("wide", "wide-sums"))

    def _find(self, parts: Parts, counts: Counts, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and counts of keys in any order: -1 and 0 where they are missing."""
        order = np.argsort(keys, kind="stable")
        places, found = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        places[order] = parts.find(keys[order])
        known = order[places[order] >= 0]
        found[known] = counts.take(places[known])
        return places, found

    def gram_sums(self, places: np.ndarray) -> np.ndarray:
        """Sums of followers of the bigrams at the sorted ``places``; the followers of one may lie in several ranges."""
        bits, bounds = np.uint64(self.model["bits"]), self.model["gram_bounds"]
        low, high = places.astype(np.uint64) << bits, (places.astype(np.uint64) + np.uint64(1)) << bits
        first, last = np.searchsorted(bounds, low, side="right"), np.searchsorted(bounds, high - np.uint64(1), side="right")
        out = np.zeros((len(places), 4), np.int64)
        for k in range(int(first[0]), int(last[-1]) + 1) if len(places) else ():
            a, b = np.searchsorted(last, k), np.searchsorted(first, k, side="right")
            if b <= a:
                continue
            starts = np.searchsorted(self.grams.parts[k], low[a:b])
            n = np.searchsorted(self.grams.parts[k], high[a:b]) - starts
            short, wide = np.flatnonzero((n > 0) & (n <= WIDE)), np.flatnonzero(n > WIDE)
            if len(short):
                heads = np.cumsum(n[short]) - n[short]
                at = np.arange(n[short].sum()) + np.repeat(starts[short] - heads, n[short])
                out[a + short] += _classes(self.gram_times.inside(k, at), heads)
            if len(wide):
                out[a + wide] += self.wide_sums.parts[k][np.searchsorted(self.wide.parts[k], places[a:b][wide].astype(np.uint64))]
        return out

    def score(self, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per text: tokens, known tokens, base score, score of the model."""
        m = self.model
        hashes, bounds = tokens(texts)
        distinct, back = np.unique(hashes, return_inverse=True)
        ids = self.words.find(distinct)
        known = ids >= 0
        counts, preceded = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        counts[known], preceded[known] = self.counts.take(ids[known]), self.preceded.take(ids[known])
        base = np.log10((counts + 1) / (m["tokens"] + m["words"] + 1))
        rest = m["lower_rest"] / (m["words"] + 1)
        lower = np.maximum(preceded - m["lower_discounts"][np.minimum(preceded, 3)], 0) / max(m["pairs"], 1) + rest
        follow = np.zeros((len(ids) + 1, 4), np.int64)
        follow[:-1][known] = self.follow.take(ids[known])
        follow[-1] = self.follow.take(np.array([m["words"]]))[0]
        before = np.concatenate([[len(ids)], back[:-1]])
        before[bounds[:-1]] = len(ids)
        # Distinct pairs of this batch only.
        pairs, pair_back = np.unique(before * (len(ids) + 1) + back, return_inverse=True)
        first, second = pairs // (len(ids) + 1), pairs % (len(ids) + 1)
        all_ids = np.append(ids, m["words"])
        both = (all_ids[first] >= 0) & (all_ids[second] >= 0)
        places, found = np.full(len(pairs), -1, np.int64), np.zeros(len(pairs), np.int64)
        places[both], found[both] = self._find(
            self.pairs, self.times, all_ids[first[both]].astype(np.uint64) << np.uint64(32) | all_ids[second[both]].astype(np.uint64))
        p = interpolated(found, follow[first], m["discounts"], lower[second])
        log_p = np.log10(p)[pair_back]
        if m["order"] == 3:
            later = np.ones(len(back), bool)
            later[bounds[:-1]] = False
            at = np.flatnonzero(later)
            grams, gram_back = np.unique(pair_back[at - 1] * len(pairs) + pair_back[at], return_inverse=True)
            context, pair = grams // max(len(pairs), 1), grams % max(len(pairs), 1)
            word = all_ids[second[pair]]
            both = (places[context] >= 0) & (word >= 0)
            found = np.zeros(len(grams), np.int64)
            found[both] = self._find(
                self.grams, self.gram_times, places[context[both]].astype(np.uint64) << np.uint64(m["bits"]) | word[both].astype(np.uint64))[1]
            sums = np.zeros((len(pairs), 4), np.int64)
            used = np.unique(context[places[context] >= 0])
            used = used[np.argsort(places[used], kind="stable")]
            sums[used] = self.gram_sums(places[used])
            log_p[at] = np.log10(interpolated(found, sums[context], m["gram_discounts"], p[pair]))[gram_back]
        sums = lambda x: np.add.reduceat(x, bounds[:-1])  # noqa: E731  every text has its end, so no text is empty
        return np.diff(bounds), sums(known[back].astype(np.int64)), sums(base[back]), sums(log_p)


def interpolated(counts: np.ndarray, sums: np.ndarray, d: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Probabilities from discounted counts; what the discounts of a context's followers free goes to the shorter context."""
    total = sums[:, 3]
    back_off = (sums[:, :3] @ d[1:]) / np.maximum(total, 1)
    back_off[total == 0] = 1.0
    return np.maximum(counts - d[np.minimum(counts, 3)], 0) / np.maximum(total, 1) + back_off * lower


def scored(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``docs`` without the text column, with ``n_tokens``, ``n_known``, ``base_score`` and ``score`` (log10; perplexity is
    ``10 ** (-score / n_tokens)``)."""
    names = ["n_tokens", "n_known", "base_score", "score"]
    kept = without(docs.columns, text, *names)

    def run(batches):
        key = (model["folder"], "scorer")
        if key not in _OPEN:
            _OPEN.clear()
            _OPEN[key] = Scorer(model)
        for batch in batches:
            texts, rest = column(batch, text), batch.select(kept)
            for a, b in slices(texts, BATCH_CHARS):
                yield pa.RecordBatch.from_arrays([*rest.slice(a, b - a).columns, *map(pa.array, _OPEN[key].score(texts[a:b]))], names=[*rest.schema.names, *names])

    return map_arrow(docs, run, extended(docs, kept, "n_tokens long, n_known long, base_score double, score double"))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def op8_language_model(spark, sf_dir: str) -> DataFrame:
    """Kneser-Ney score of every document next to the unigram base."""
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs.filter(~held_out()))
    return scored(docs.select("doc_id", held_out().alias("held_out"), "text"), model).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model["tokens"]).cast("long").alias("train_tokens"), "base_score", "score")
