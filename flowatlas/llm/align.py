"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Both tokenizers cut the same bytes (a space and the text). Each gives a token-byte incidence matrix in compressed rows (``Csr``): a row per token,
a column per byte. The row products of A and the transpose of B are the overlap links, with the number of shared bytes. Where two
links in a row have neither token in common both tokenizers end at the same byte: there a group ends. The products of the group incidences (ids of a
document by groups, groups by ids) are the shared-group links, counted per document and pair of ids.

How often a pair of ids is linked over the corpus is counted in Spark: documents are encoded once and written with their pairs, the pairs
are counted with partial sums, and every pair of every document meets its count in a join. The most frequent pairs, at most
``FREQUENT`` of them, are broadcast; the others are joined by shuffle. A pair that is not among the frequent ones stands in less than 2 of
``FREQUENT`` rows, so no key of the shuffle is hot.

Null and empty texts have no tokens, nor do texts that one of the tokenizers does not give back byte by byte: their counts are 0 and their digest is
''. Rows are treated one by one: repeated rows give repeated results, and each counts as a document. Null ids are kept. Very long texts are taken in
row blocks of ``PRODUCTS`` partial products. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowatlas.llm.bpe import SPLIT, VOCABULARY_BYTES, Vocabulary
from flowatlas.llm.common import column, map_arrow, read_table, slices
from flowatlas.session import scratch_path

#: Characters aligned together, partial products held at once, pairs of ids that are broadcast.
SLICE_CHARS, PRODUCTS, FREQUENT = 400_000, 1 << 20, 1 << 20


class Csr:
    """Sparse matrix in compressed rows: ``indices[indptr[i]:indptr[i + 1]]`` are the columns of row i, ``data`` their values."""

    def __init__(self, indptr: np.ndarray, indices: np.ndarray, data: np.ndarray, columns: int):
        self.indptr, self.indices, self.data, self.columns = indptr, indices, data, columns

    @classmethod
    def summed(cls, rows: np.ndarray, indices: np.ndarray, shape: tuple[int, int]) -> Csr:
        """A matrix of counts from (row, column) places, in any order and with repeats."""
        keys, counts = _sum_equal(rows * shape[1] + indices, np.ones(len(rows), np.int64))
        indptr = np.searchsorted(keys, np.arange(shape[0] + 1) * shape[1])
        return cls(indptr, keys % shape[1], counts, shape[1])

    @classmethod
    def intervals(cls, lengths: np.ndarray) -> Csr:
        """Token-byte incidence of tokens that cover the bytes one after the other."""
        indptr = _offsets(lengths)
        return cls(indptr, np.arange(indptr[-1]), np.ones(indptr[-1], np.int64), int(indptr[-1]))

    def transposed(self) -> Csr:
        order = np.argsort(self.indices, kind="stable")
        rows = np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))
        indptr = _offsets(np.bincount(self.indices, minlength=self.columns))
        return Csr(indptr, rows[order], self.data[order], len(self.indptr) - 1)


def _offsets(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def _sum_equal(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in ascending order and the sums of their values."""
    if not len(keys):
        return keys, values
    if (keys[1:] < keys[:-1]).any():
        order = np.argsort(keys, kind="stable")
        keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(values, first)


def products(a: Csr, b: Csr, limit: int = PRODUCTS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``a @ b`` by Gustavson's rule, as (rows, columns, values): row i is the sum of those rows of ``b`` that row i of ``a`` names, each times its value.

    Rows are taken in blocks of about ``limit`` partial products, one row at least.
    """
    lengths = np.diff(b.indptr)
    sizes = lengths[a.indices]
    before = _offsets(sizes)[a.indptr]  # partial products before each row
    start, rows = 0, len(a.indptr) - 1
    while start < rows:
        end = max(start + 1, int(np.searchsorted(before, before[start] + limit, "right")) - 1)
        part = slice(a.indptr[start], a.indptr[end])
        named, size = a.indices[part], sizes[part]
        skipped = np.repeat(b.indptr[named] - (np.cumsum(size) - size), size)
        at = skipped + np.arange(len(skipped))
        owner = np.repeat(np.arange(start, end), np.diff(a.indptr[start:end + 1]))
        keys, values = _sum_equal(np.repeat(owner, size) * b.columns + b.indices[at], np.repeat(a.data[part], size) * b.data[at])
        yield keys // b.columns, keys % b.columns, values
        start = end


def overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token of A, token of B, shared bytes) of all tokens that overlap, given the tokens' lengths; both cover the same bytes."""
    if not len(a):
        return (np.zeros(0, np.int64),) * 3
    parts = list(products(Csr.intervals(a), Csr.intervals(b).transposed()))
    return tuple(np.concatenate(x) for x in zip(*parts))


def groups(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group of each token of A and of B from the overlap links in order: a group ends where neither token goes on."""
    if not len(first):
        return first, second
    ends = np.concatenate([[False], (first[1:] != first[:-1]) & (second[1:] != second[:-1])])
    group = np.cumsum(ends)
    of_a, of_b = np.zeros(first[-1] + 1, np.int64), np.zeros(second[-1] + 1, np.int64)
    of_a[first], of_b[second] = group, group
    return of_a, of_b


class Tokenizers:
    """Both tokenizers of one worker: ids, and the bytes every id stands for."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        import tiktoken

        for path in (a_path, b_path):
            if os.path.getsize(path) > VOCABULARY_BYTES:
                raise ValueError(f"{path} is larger than {VOCABULARY_BYTES} bytes")
        vocabulary = Vocabulary(a_path)
        special = set(vocabulary.special.values())
        ranks = {raw: i for i, raw in enumerate(vocabulary.bytes) if i not in special}
        if len(ranks) < 256 or not (np.diff(vocabulary.merged) > 0).all():
            raise ValueError(f"{a_path}: ids are not in the order of the merges")
        # Special tokens are left out, so their strings are plain text.
        self.a = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes = vocabulary.bytes, [b"" if self.b.is_control(i) else piece_bytes(p) for i, p in enumerate(pieces)]
        self.lengths = tuple(np.array([len(x) for x in table], np.int64) for table in self.bytes)

    def encode(self, texts: list[str]) -> list[list[list[int]]]:
        """Ids of A and of B for each text; none where the bytes differ from a space and the text."""
        kinds = [[self.a.encode_ordinary(" " + t) for t in texts], self.b.encode(texts, num_threads=1)]
        for k, text in enumerate(texts):
            raw = (" " + text).encode()
            if not text or any(b"".join(map(table.__getitem__, ids[k])) != raw for ids, table in zip(kinds, self.bytes)):
                kinds[0][k], kinds[1][k] = [], []
        return kinds


def piece_bytes(piece: str) -> bytes:
    """Bytes of a piece: U+2581 is a space, <0xHH> a byte."""
    byte = re.fullmatch("<0x([0-9A-Fa-f]{2})>", piece)
    return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()


def align(ids: tuple[np.ndarray, np.ndarray], lengths: tuple[np.ndarray, np.ndarray], counts: tuple[np.ndarray, np.ndarray], sizes: tuple[int, int]):
    """Groups and linked pairs of ids of some documents, whose tokens follow one another.

    ``ids``: the tokens; ``lengths``: their bytes; ``counts``: tokens of each document; ``sizes``: ids of each tokenizer. Returns the group of each
    token of A and of B, and per linked pair (document, id of A, id of B, links).
    """
    first, second, _ = overlaps(*lengths)
    of_a, of_b = groups(first, second)
    n = int(of_a[-1]) + 1 if len(of_a) else 0
    document = np.repeat(np.arange(len(counts[0])), counts[0])
    rows, at = np.unique(document * sizes[0] + ids[0], return_inverse=True)
    left = Csr.summed(at, of_a, (len(rows), max(n, 1)))
    right = Csr.summed(of_b, ids[1], (n, sizes[1]))
    parts = list(products(left, right)) or [(np.zeros(0, np.int64),) * 3]
    row, b, links = (np.concatenate(x) for x in zip(*parts))
    return of_a, of_b, (rows[row] // sizes[0], rows[row] % sizes[0], b, links)


def _shown(ids: tuple[np.ndarray, np.ndarray], group: tuple[np.ndarray, np.ndarray], tables: list[list[bytes]], widths: list[int]):
    """Tokens of A and B in the order in which they are written out: group by group, A before B, each as its number and the sign after it."""
    both = np.concatenate([2 * group[0], 2 * group[1] + 1])
    order = np.argsort(both, kind="stable")
    side = both[order]
    last = np.concatenate([side[1:] != side[:-1], [True]])
    code = np.concatenate(ids)[order] + np.where(side % 2 == 1, 2 * widths[0], 0) + last * np.where(side % 2 == 1, widths[1], widths[0])
    return list(map(tables.__getitem__, code.tolist())), side // 2


_WORKER: dict[tuple[str, str], Tokenizers] = {}


def _tokenizers(a_path: str, b_path: str) -> Tokenizers:
    if (a_path, b_path) not in _WORKER:
        _WORKER.clear()
        _WORKER[a_path, b_path] = Tokenizers(a_path, b_path)
    return _WORKER[a_path, b_path]


def _numbers(size: int, signs: tuple[bytes, bytes]) -> list[bytes]:
    return [b"%d%s" % (i, sign) for sign in signs for i in range(size)]


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per document: ``row`` (a number of its own), ``doc_id``, counts, digest of the groups, and its linked pairs.

    ``pairs`` holds id of A times the size of B plus id of B, ``links`` how often each pair is linked in the document.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches):
        t = _tokenizers(a_path, b_path)
        sizes = tuple(map(len, t.bytes))
        signs = [*_numbers(sizes[0], (b",", b"|")), *_numbers(sizes[1], (b",", b";"))]
        for batch in batches:
            texts = [x or "" for x in column(batch, "text")]
            for start, end in slices(texts, SLICE_CHARS):
                kinds = t.encode(texts[start:end])
                counts = tuple(np.fromiter(map(len, k), np.int64, len(k)) for k in kinds)
                ids = tuple(np.fromiter((i for row in k for i in row), np.int64, int(c.sum())) for k, c in zip(kinds, counts))
                of_a, of_b, (document, a, b, links) = align(ids, tuple(x[i] for x, i in zip(t.lengths, ids)), counts, sizes)
                shown, group = _shown(ids, (of_a, of_b), signs, list(sizes))
                bounds = _offsets(counts[0] + counts[1])
                edges = _offsets(np.bincount(document, minlength=end - start))
                total = np.add.reduceat(np.append(links, 0), np.minimum(edges[:-1], len(links)))
                total[np.diff(edges) == 0] = 0
                digests, n_groups = [], []
                for k in range(end - start):
                    part = slice(bounds[k], bounds[k + 1])
                    raw = b"".join(shown[part])
                    digests.append(hashlib.sha256(raw[:-1]).hexdigest() if raw else "")
                    n_groups.append(int(group[bounds[k + 1] - 1] - group[bounds[k]]) + 1 if raw else 0)
                some = batch.slice(start, end - start)
                lists = [pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(x)) for x in (a * sizes[1] + b, links.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(counts[0]), pa.array(counts[1]), pa.array(n_groups, pa.int64()), pa.array(total),
                     pa.array(digests, pa.string()), *lists],
                    names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "links"])

    return map_arrow(rows, run, "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, links array<int>")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"{name}.parquet")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pair_counts(rows: DataFrame, b_size: int) -> DataFrame:
    """``(pair, n, best)``: documents that hold the pair linked, and whether no pair of the same id of A stands in more."""
    counts = _written(rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "counts")
    a = F.floor(F.col("pair") / F.lit(b_size)).alias("a")
    # One row per id of A: as many as the vocabulary has entries, whose file is of a checked size.
    most = counts.groupBy(a).agg(F.max("n").alias("most"))
    return _written(counts.withColumn("a", a).join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def _frequent_from(counts: DataFrame, limit: int) -> int:
    """Smallest power of two from which at most ``limit`` pairs have such a count."""
    steps = counts.groupBy(F.floor(F.log2("n")).alias("step")).agg(F.count("*").alias("pairs")).collect()
    held, start = 0, 62
    for step in sorted(steps, key=lambda r: -r["step"]):
        held += step["pairs"]
        if held > limit:
            break
        start = step["step"]
    return 1 << start


def alignment(docs: DataFrame, a_path: str, b_path: str, frequent: int = FREQUENT) -> DataFrame:
    """Per document: tokens, groups, links, how many links are the best of their id of A over the corpus, and the sum of their counts."""
    rows = _written(aligned(docs, a_path, b_path), "aligned")
    counts = pair_counts(rows, len(_tokenizers(a_path, b_path).bytes[1]))
    start = _frequent_from(counts, frequent)
    pairs = rows.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.links").alias("times"))
    many = pairs.join(F.broadcast(counts.filter(F.col("n") >= start)), "pair", "left")
    few = counts.filter(F.col("n") < start)
    if start > 1:
        # Those without a count here meet theirs by shuffle.
        rest = many.filter("n IS NULL").select("row", "pair", "times").join(few.hint("merge"), "pair")
        many = many.filter("n IS NOT NULL").unionByName(rest)
    sums = many.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    return rows.drop("pairs", "links").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256")


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op11_alignment(spark, sf_dir: str) -> DataFrame:
    """Alignment of two tokenizers over all documents."""
    return alignment(read_table(spark, sf_dir, "documents"), *default_paths())
