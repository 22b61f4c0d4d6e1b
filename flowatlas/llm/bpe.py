"""Byte-level BPE: encoding by batched merge rounds, decoding from ids.

A vocabulary file of a public tokenizer is read once on the driver and sent to the workers (its size is
checked). Encoding cuts a text at single spaces; a piece with its leading space is encoded independently of what
surrounds it, so pieces seen before are looked up. The rest is merged many words at a time: all their
symbols lie in one flat array, every round finds the rank of each neighbouring pair by binary search over the sorted pair
keys, and merges the lowest-ranked pair of every word wherever it stands in the word.

Null texts count as empty; an empty text has no ids and decodes to an empty text. Rows are treated one by one, so repeated
rows give repeated results.
"""

from __future__ import annotations

import heapq
import json
import os
import uuid

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowatlas.llm.common import column, extended, map_arrow, read_table, slices, without

#: Characters taken together, pieces remembered by a worker, and symbols from which a word is merged alone.
BATCH_CHARS, REMEMBERED, LONG_WORD = 1_000_000, 100_000, 256
#: Largest vocabulary file that is sent to the workers.
VOCABULARY_BYTES = 64 << 20

#: Fixed value: the public pattern that splits text before byte-level merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class Vocabulary:
    """Tables of a byte-level BPE tokenizer file (format of the ``tokenizers`` library)."""

    def __init__(self, path: str):
        if os.path.getsize(path) > VOCABULARY_BYTES:
            raise ValueError(f"{path} is larger than {VOCABULARY_BYTES} bytes")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or spec.get("normalizer") \
                or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        ids = dict(model["vocab"])
        characters = byte_characters()
        as_byte = {c: b for b, c in enumerate(characters)}
        self.first = np.array([ids[c] for c in characters], np.int64)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.size = 1 + max([*ids.values(), *self.special.values()])
        self.bytes = [b""] * self.size
        for token, i in ids.items():
            self.bytes[i] = bytes(as_byte[c] for c in token) if all(c in as_byte for c in token) else token.encode()
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([ids[a] * self.size + ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.token = uuid.uuid4().hex

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; the number of merges where there is none."""
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], len(self.keys))


def merge_words(vocabulary: Vocabulary, words: list[bytes]) -> list[bytes]:
    """Ids of each word as the bytes of an int32 array."""
    out: list[bytes] = [b""] * len(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for i in np.flatnonzero(lengths > LONG_WORD):
        out[i] = _merge_long(vocabulary, words[i])
    todo = np.flatnonzero((lengths > 0) & (lengths <= LONG_WORD))
    symbols = vocabulary.first[np.frombuffer(b"".join([words[i] for i in todo]), np.uint8)]
    owner = np.repeat(np.arange(len(todo)), lengths[todo])
    none = len(vocabulary.keys)
    ranks = np.full(len(symbols), none)
    _rank_at(vocabulary, symbols, owner, ranks, np.arange(len(symbols)))
    while len(symbols):
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        lowest = np.minimum.reduceat(ranks, starts)
        sizes = np.diff(starts, append=len(symbols))
        done = lowest == none
        if done.any():
            ended = symbols[np.repeat(done, sizes)].astype(np.int32)
            bounds = (np.concatenate([[0], np.cumsum(sizes[done])]) * 4).tolist()
            raw = ended.tobytes()
            for k, word in enumerate(todo[owner[starts[done]]].tolist()):
                out[word] = raw[bounds[k]:bounds[k + 1]]
            keep = np.repeat(~done, sizes)
            symbols, owner, ranks = symbols[keep], owner[keep], ranks[keep]
            lowest, sizes = lowest[~done], sizes[~done]
            if not len(symbols):
                break
        here = np.flatnonzero(ranks == np.repeat(lowest, sizes))
        # In a run such as aaa the pairs overlap: from the left, take every second one.
        run = np.cumsum(np.diff(here, prepend=-2) != 1) - 1
        first = here[np.flatnonzero(np.diff(run, prepend=-1))]
        here = here[(here - first[run]) % 2 == 0]
        symbols[here] = vocabulary.merged[ranks[here]]
        keep = np.ones(len(symbols), bool)
        keep[here + 1] = False
        symbols, owner, ranks = symbols[keep], owner[keep], ranks[keep]
        here -= np.arange(len(here))
        _rank_at(vocabulary, symbols, owner, ranks, np.concatenate([here, here[here > 0] - 1]))
    return out


def _rank_at(vocabulary: Vocabulary, symbols: np.ndarray, owner: np.ndarray, ranks: np.ndarray, at: np.ndarray) -> None:
    """Set the ranks of the pairs that start at the positions ``at``."""
    after = np.minimum(at + 1, len(symbols) - 1)
    inside = (owner[at] == owner[after]) & (after > at)
    ranks[at[~inside]] = len(vocabulary.keys)
    at, after = at[inside], after[inside]
    ranks[at] = vocabulary.pair_ranks(symbols[at], symbols[after])


def _merge_long(vocabulary: Vocabulary, word: bytes) -> bytes:
    """One very long word with a heap of pairs: rounds over the whole word would cost its length squared."""
    symbols = vocabulary.first[np.frombuffer(word, np.uint8)]
    none = len(vocabulary.keys)
    ranks = vocabulary.pair_ranks(symbols[:-1], symbols[1:]).tolist()
    values = symbols.tolist()
    heap = [(r, i, values[i], values[i + 1]) for i, r in enumerate(ranks) if r < none]
    heapq.heapify(heap)
    following, previous = [*range(1, len(values)), -1], [*range(-1, len(values) - 1)]
    known: dict[tuple[int, int], int] = {}

    def push(i: int) -> None:
        j = following[i]
        if j < 0:
            return
        pair = (values[i], values[j])
        if pair not in known:
            known[pair] = int(vocabulary.pair_ranks(np.array(pair[:1]), np.array(pair[1:]))[0])
        if known[pair] < none:
            heapq.heappush(heap, (known[pair], i, *pair))

    while heap:
        rank, i, left, right = heapq.heappop(heap)
        j = following[i]
        if values[i] != left or j < 0 or values[j] != right:
            continue
        values[i], values[j] = int(vocabulary.merged[rank]), -1
        following[i] = following[j]
        if following[j] >= 0:
            previous[following[j]] = i
        push(i)
        if previous[i] >= 0:
            push(previous[i])
    return np.array([v for v in values if v >= 0], np.int32).tobytes()


class Encoder:
    """Encodes texts on one worker and remembers pieces."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.split = regex.compile(SPLIT).findall
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.after_space: dict[str, bytes | None] = {}

    def _parts(self, text: str):
        """Stretches between special tokens, and the ids of those tokens."""
        if self.special is None or not any(s in text for s in self.vocabulary.special):
            yield text
            return
        at = 0
        for m in self.special.finditer(text):
            yield text[at:m.start()]
            yield self.vocabulary.special[m.group()]
            at = m.end()
        yield text[at:]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as the bytes of an int32 array."""
        parts = [list(self._parts(t)) for t in texts]
        pieces = [[p if isinstance(p, int) else p.split(" ") for p in part] for part in parts]
        unseen: set[str] = set()
        heads: set[str] = set()
        for part in pieces:
            for p in part:
                if not isinstance(p, int):
                    heads.add(p[0])
                    unseen.update(p[1:])
        if len(self.after_space) > REMEMBERED:
            # What this batch needs again stays, the rest goes.
            self.after_space = {p: self.after_space[p] for p in unseen if p in self.after_space}
        known = self.after_space
        unseen -= known.keys()
        # A space before more white space belongs to that white space: such texts are split as a whole.
        odd = {p for p in unseen if not p or p[0].isspace()}
        whole = []
        for part, split in zip(parts, pieces):
            for k, p in enumerate(split):
                if not isinstance(p, int) and len(p) > 1 and (odd and not odd.isdisjoint(p[1:])):
                    split[k] = None
                    whole.append(part[k])
        unseen -= odd
        # Letters only, the usual case: one word for the pattern.
        words = {p: (" " + p,) if p.isalpha() else self.split(" " + p) for p in unseen}
        starts = {p: self.split(p) for p in heads}
        texts_whole = {p: self.split(p) for p in whole}
        distinct = list(set().union(*words.values(), *starts.values(), *texts_whole.values()))
        ids = dict(zip(distinct, merge_words(self.vocabulary, [w.encode() for w in distinct])))
        known.update((p, ids[found[0]] if len(found) == 1 else b"".join([ids[w] for w in found])) for p, found in words.items())
        out = []
        for part, split in zip(parts, pieces):
            row = []
            for text, p in zip(part, split):
                if isinstance(p, int):
                    row.append(np.int32(p).tobytes())
                elif p is None:
                    row.extend([ids[w] for w in texts_whole[text]])
                else:
                    row.extend([ids[w] for w in starts[p[0]]])
                    row.extend([known[q] for q in p[1:]])
            out.append(b"".join(row))
        return out


_ENCODERS: dict[str, Encoder] = {}


def _encoder(shared) -> Encoder:
    """This worker's encoder: it outlives a task, so what it has seen helps the next one."""
    if shared.value.token not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[shared.value.token] = Encoder(shared.value)
    return _ENCODERS[shared.value.token]


def _append(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    rest = batch.select(without(batch.schema.names, name))
    return pa.RecordBatch.from_arrays([*rest.columns, values], names=[*rest.schema.names, name])


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with a column of token ids; special tokens written out in a text become their own id.

    The other columns are kept; a column that is already called ``ids`` is replaced.
    """
    vocabulary = df.sparkSession.sparkContext.broadcast(Vocabulary(path))

    def run(batches):
        encoder = _encoder(vocabulary)
        for batch in batches:
            texts = [t or "" for t in column(batch, text)]
            for a, b in slices(texts, BATCH_CHARS):
                rows = encoder.encode(texts[a:b])
                offsets = np.concatenate([[0], np.cumsum([len(r) // 4 for r in rows])]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(rows), np.int32))
                yield _append(batch.slice(a, b - a), ids, pa.ListArray.from_arrays(pa.array(offsets), values))

    return map_arrow(df, run, extended(df, without(df.columns, ids), f"`{ids}` array<int>"))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text that the ids stand for; bytes that are no UTF-8 become U+FFFD, null ids an empty text.

    Ids outside the vocabulary stand for nothing.
    """
    vocabulary = df.sparkSession.sparkContext.broadcast(Vocabulary(path))

    def run(batches):
        table = np.array([*vocabulary.value.bytes, b""], object)
        for batch in batches:
            rows = batch.column(batch.schema.get_field_index(ids))
            out = []
            for k in range(len(rows)):
                row = rows[k].values
                found = np.zeros(0, np.int64) if row is None else row.to_numpy(zero_copy_only=False).astype(np.int64)
                found = np.where((found < 0) | (found >= len(table) - 1), len(table) - 1, found)
                out.append(b"".join(table[found].tolist()).decode("utf-8", "replace"))
            yield _append(batch, text, pa.array(out, pa.string()))

    return map_arrow(df, run, extended(df, without(df.columns, text), f"`{text}` string"))


def ids_digest(ids: str) -> Column:
    """SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(F.col(ids).cast("array<string>"), ",").cast("binary"), 256)


def round_trip(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` in one pass: ``df`` without the text, with its ids and the text decoded from them."""
    vocabulary = df.sparkSession.sparkContext.broadcast(Vocabulary(path))
    kept = without(df.columns, text, ids, decoded)

    def run(batches):
        encoder, table = _encoder(vocabulary), vocabulary.value.bytes
        for batch in batches:
            texts, rest = [t or "" for t in column(batch, text)], batch.select(kept)
            for a, b in slices(texts, BATCH_CHARS):
                rows = [np.frombuffer(r, np.int32) for r in encoder.encode(texts[a:b])]
                offsets = np.cumsum([0, *map(len, rows)]).astype(np.int32)
                shown = [b"".join([table[k] for k in row.tolist()]).decode("utf-8", "replace") for row in rows]
                values = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays([*rest.slice(a, b - a).columns, pa.ListArray.from_arrays(pa.array(offsets), values), pa.array(shown, pa.string())],
                                                 names=[*rest.schema.names, ids, decoded])

    return map_arrow(df, run, extended(df, kept, f"`{ids}` array<int>, `{decoded}` string"))


def tokenized(docs: DataFrame, path: str) -> DataFrame:
    """Per document: number of ids, digest of the ids, digest of the text decoded from them."""
    return round_trip(docs.select("doc_id", "text"), path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), ids_digest("ids").alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe(spark, sf_dir: str) -> DataFrame:
    """BPE ids of every document and the text decoded from them, as digests."""
    return tokenized(read_table(spark, sf_dir, "documents"), default_path())
