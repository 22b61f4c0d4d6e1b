"""Benchmark decontamination with suffix arrays over the training text.

Each task cuts its documents into shards of bounded size and sorts all word positions of a shard by the words that follow
(prefix doubling on ranks: each round sorts only positions that still share their first words with another one, and
doubles the length compared). The suffixes of the benchmark items are then binary-searched in the shard's suffix array, all at once, those
that begin with the same window once. The matches found are maximal: the same words, longer on neither side, at least a window long.
Only their two ends are looked for: pairs of places that share a window but not the word before it (or not the word behind it). The
pairs in between are never listed, so a word repeated thousands of times in both texts costs their lengths, not the product.

A window is ``window`` consecutive words of an item; an item with fewer words, but not none, is one window. Items are the stated query
set: they go to the workers in blocks of about ``ITEM_BLOCK_WORDS`` words (one item at least), one pass over the documents per block, and a block is
given back before the next one is sent. Between passes the documents are written with the matches so far; a benchmark of
one block needs no such table. Documents are never shuffled.

Nulls and empty texts have no words: such documents are not hit, such items match nothing. A null item id counts as the empty one. Repeated rows are treated one by one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowatlas.llm.common import ALNUM, column, hashed_words, map_arrow, read_table, slices, without, written

WINDOW = 13
#: Words of benchmark items held by the workers at once: about 100 MB.
ITEM_BLOCK_WORDS = 1_000_000
#: Characters of the documents of one shard, about; one document at least.
SHARD_CHARS = 4_000_000

MATCH = "array<struct<item:string,doc_word:int,item_word:int,words:int>>"


class SuffixArray:
    """Word positions of some texts in the order of the words that follow, compared up to ``depth`` words.

    Texts do not run into each other: behind the last word of a text comes a different end for each text,
    below all words.
    """

    def __init__(self, hashes: np.ndarray, bounds: np.ndarray, depth: int):
        n, texts = len(hashes), len(bounds) - 1
        # Hashes keep the order of values, so queries can be compared with the words themselves.
        self.hashes, self.bounds = hashes, bounds
        self.stop = np.repeat(bounds[1:], np.diff(bounds))
        order = np.argsort(hashes, kind="stable")
        rank = np.empty(n, np.int64)
        new = np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]]) if n else np.zeros(0, bool)
        group = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[order] = group + texts
        length = 1
        while length < depth and n:
            sizes = np.diff(np.flatnonzero(new), append=n)
            slots = np.flatnonzero(np.repeat(sizes, sizes) > 1)
            if not len(slots):
                break
            at = order[slots]
            beyond = at + length >= self.stop[at]
            after = np.where(beyond, 0, rank[np.minimum(at + length, n - 1)])
            # The ends of different texts differ: number them by the text.
            after[beyond] = np.searchsorted(bounds, at[beyond], side="right") - 1
            by = np.argsort((rank[at] - texts) * (n + texts + 1) + after, kind="stable")
            at, after = at[by], after[by]
            order[slots] = at
            same = (after[1:] == after[:-1]) & (rank[at[1:]] == rank[at[:-1]])
            fresh = np.concatenate([[True], ~same])
            new[slots] = fresh
            rank[at] = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(slots)), 0))] + texts
            length *= 2
        self.order = order

    def ranges(self, words: np.ndarray, first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query ``words[first : first + length]`` the range of suffixes that begin with it."""
        return self._search(words, first, length, False), self._search(words, first, length, True)

    def _search(self, words, first, length, beyond: bool) -> np.ndarray:
        low, high = np.zeros(len(first), np.int64), np.full(len(first), len(self.order))
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) // 2
            at = self.order[middle]
            below = np.zeros(len(open_), bool)
            equal = np.ones(len(open_), bool)
            going = np.arange(len(open_))
            for k in range(int(length.max())):
                going = going[k < length[open_[going]]]
                if not len(going):
                    break
                here = at[going] + k
                ended = here >= self.stop[at[going]]
                mine = words[first[open_[going]] + k]
                theirs = self.hashes[np.minimum(here, len(self.hashes) - 1)]
                below[going] = ended | (theirs < mine)
                equal[going] = ~ended & (theirs == mine)
                going = going[equal[going]]
            right = below | (equal & beyond)
            low[open_[right]] = middle[right] + 1
            high[open_[~right]] = middle[~right]
            open_ = open_[low[open_] < high[open_]]
        return low


#: Stand for the missing word at the end of a text and of an item; they equal no word and not each other.
NO_DOC_WORD, NO_ITEM_WORD = -1, -2


class Items:
    """Words of a block of benchmark items and the different windows that are looked up."""

    def __init__(self, ids: list[str], texts: list, window: int):
        self.ids = ids
        words, bounds = hashed_words(texts, ALNUM)
        sizes = np.diff(bounds)
        starts = np.where(sizes >= window, sizes - window + 1, np.minimum(sizes, 1))
        item = np.repeat(np.arange(len(ids)), starts)
        inside = np.arange(len(item)) - np.repeat(np.cumsum(starts) - starts, starts)
        first = bounds[item] + inside
        length = np.minimum(window, sizes[item])
        self.words, self.known = words, np.unique(words)
        kind = self._kinds(first, length)
        # One place for each different window, which is what is searched.
        _, where = np.unique(kind, return_index=True)
        self.first, self.length = first[where], length[where]
        numbers, behind = self.number(words), first + length
        before, after = first, behind
        if len(first):
            before = np.where(inside > 0, numbers[first - 1], NO_ITEM_WORD)
            after = np.where(behind < bounds[item + 1], numbers[np.minimum(behind, len(words) - 1)], NO_ITEM_WORD)
        self.ends = [self._listed(kind, near, item, inside) for near in (before, after)]

    def _kinds(self, first: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Equal numbers for windows of the same words."""
        kinds, numbers, upto = np.zeros(len(first), np.int64), self.number(self.words), 0
        for size in np.unique(length):
            rows = np.flatnonzero(length == size)
            same = numbers[first[rows]]
            for k in range(1, size):
                _, same = np.unique(same * (len(self.known) + 1) + numbers[first[rows] + k], return_inverse=True)
            _, same = np.unique(same, return_inverse=True)
            kinds[rows] = same + upto
            upto += len(rows)
        return np.unique(kinds, return_inverse=True)[1]

    def number(self, words: np.ndarray) -> np.ndarray:
        """Place of each word among the different words of the items; those of no item share the last number."""
        if not len(self.known):
            return np.zeros(len(words), np.int64)
        at = np.searchsorted(self.known, words)
        return np.where(self.known[np.minimum(at, len(self.known) - 1)] == words, at, len(self.known))

    def _key(self, kind: np.ndarray, near: np.ndarray) -> np.ndarray:
        return kind * (len(self.known) + 3) + near + 2

    def _listed(self, kind, near, item, inside):
        """Places of the items by window and neighbouring word."""
        by = np.lexsort((near, kind))
        return self._key(kind[by], near[by]), np.searchsorted(kind[by], np.arange(len(self.first) + 1)), item[by], inside[by]

    def _differing(self, end: int, kind: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the documents with all places of the items that share the window but not the neighbour: (which, item, word)."""
        keys, begin, item, inside = self.ends[end]
        mine = self._key(kind, near)
        low = np.concatenate([begin[kind], np.searchsorted(keys, mine, side="right")])
        high = np.concatenate([np.searchsorted(keys, mine, side="left"), begin[kind + 1]])
        sizes = high - low
        which = np.repeat(np.tile(np.arange(len(kind)), 2), sizes)
        place = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(low, sizes)
        return which, item[place], inside[place]

    def matches(self, texts: list) -> list[tuple[int, list]]:
        """Per text the number of words and the maximal matches (item id, word in the text, word in the item, words)."""
        hashes, bounds = hashed_words(texts, ALNUM)
        counts = np.diff(bounds)
        found: list[list] = [[] for _ in texts]
        if len(hashes) and len(self.first):
            suffixes = SuffixArray(hashes, bounds, int(self.length.max()))
            low, high = suffixes.ranges(self.words, self.first, self.length)
            hits = high - low
            kind = np.repeat(np.arange(len(hits)), hits)
            at = suffixes.order[np.arange(len(kind)) - np.repeat(np.cumsum(hits) - hits, hits) + np.repeat(low, hits)]
            text = np.searchsorted(bounds, at, side="right") - 1
            numbers = self.number(hashes)
            behind = at + self.length[kind]
            near = (np.where(at > bounds[text], numbers[at - 1], NO_DOC_WORD),
                    np.where(behind < bounds[text + 1], numbers[np.minimum(behind, len(hashes) - 1)], NO_DOC_WORD))
            # On one diagonal of a text and an item first and last windows of matches take turns.
            sides = []
            for end in (0, 1):
                which, item, inside = self._differing(end, kind, near[end])
                place = at[which] - bounds[text[which]]
                by = np.lexsort((place, place - inside, self.length[kind[which]], item, text[which]))
                sides.append((text[which][by], item[by], place[by], inside[by], self.length[kind[which]][by]))
            (owner, item, start, inside, _), (_, _, last, _, size) = sides
            for t, i, p, q, w in zip(owner.tolist(), item.tolist(), start.tolist(), inside.tolist(), (last - start + size).tolist()):
                found[t].append((self.ids[i], p, q, w))
        return list(zip(counts.tolist(), found))


def item_blocks(benchmark: DataFrame, item_id: str, text: str):
    """Items in blocks of bounded size, without loading the table on the driver at once."""
    ids, texts, size = [], [], 0
    for row in benchmark.filter(F.col(text).isNotNull()).select(F.col(item_id).cast("string"), text).toLocalIterator():
        words = len(row[1]) // 2 + 1
        if ids and size + words > ITEM_BLOCK_WORDS:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append("" if row[0] is None else row[0])
        texts.append(row[1])
        size += words
    yield ids, texts


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """``docs`` without the text column, plus ``n_words`` and ``matches`` (see ``MATCH``): the longest verbatim matches
    with each item and where they lie in both.

    Columns that are already called so are replaced. One pass over ``docs`` per block of items.
    """
    kept = without(docs.columns, text, "n_words", "matches")
    # Packed, so that no column of docs can clash with a result.
    rows = docs.select(F.col(text).alias("text"), F.struct(*kept, F.lit(None).cast("int").alias("_")).alias("row"),
                       F.lit(0).cast("long").alias("n_words"), F.array().cast(MATCH).alias("matches"))
    blocks = item_blocks(benchmark, item_id, "text")
    block = next(blocks)
    while block:
        following = next(blocks, None)
        held = docs.sparkSession.sparkContext.broadcast(Items(*block, window))
        rows = _search(rows, held, last=following is None)
        if following:
            rows = written(rows, "matches")
            held.unpersist()
        block = following
    return rows.select(*[F.col("row").getField(n).alias(n) for n in kept], "n_words", "matches")


def _search(rows: DataFrame, held, last: bool) -> DataFrame:
    """``rows`` with the matches of one block of items added; the texts are passed on but for the last block."""
    kind = pa.list_(pa.struct([("item", pa.string()), ("doc_word", pa.int32()), ("item_word", pa.int32()), ("words", pa.int32())]))
    parts = ("item", "doc_word", "item_word", "words")
    names = [n for n in rows.columns if not (last and n == "text")]

    def scan(batches):
        for batch in batches:
            texts, earlier = column(batch, "text"), column(batch, "matches")
            for a, b in slices(texts, SHARD_CHARS):
                found = held.value.matches(texts[a:b])
                added = [old + [dict(zip(parts, m)) for m in new] for old, (_, new) in zip(earlier[a:b], found)]
                results = {"n_words": pa.array([n for n, _ in found], pa.int64()), "matches": pa.array(added, kind)}
                whole = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([results[n] if n in results else whole.column(n) for n in names], names=names)

    return map_arrow(rows, scan, rows.select(*names).schema)


def covered_words(found: str = "matches") -> Column:
    """Number of different words of the document inside the matches: a sweep over the sorted spans."""
    spans = F.array_sort(F.transform(found, lambda m: F.struct(m["doc_word"].alias("start"), (m["doc_word"] + m["words"]).alias("stop"))))
    zero = F.struct(F.lit(0).alias("stop"), F.lit(0).alias("total"))
    return F.aggregate(spans, zero, lambda s, x: F.struct(
        F.greatest(s["stop"], x["stop"]).alias("stop"),
        (s["total"] + F.greatest(F.lit(0), x["stop"] - F.greatest(x["start"], s["stop"]))).alias("total"),
    ), lambda s: s["total"].cast("long"))


def contaminated() -> Column:
    """Hit words are at least a twentieth of the document's words."""
    return (covered_words() > 0) & (20 * covered_words() >= F.col("n_words"))


def judged(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document its words, hit words, matching items and whether it counts as contaminated (a twentieth of its words)."""
    found = matches(docs.select("doc_id", "text"), benchmark, window)
    items = F.array_sort(F.array_distinct(F.col("matches.item")))
    rows = found.select("doc_id", "n_words", covered_words().alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
                        F.coalesce(F.array_max("matches.words"), F.lit(0)).cast("long").alias("longest"))
    return rows.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def cleaned(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with the columns of ``docs``."""
    # Packed, so that no column of docs can clash with a result.
    rows = docs.select("text", F.struct(*docs.columns).alias("row"))
    return matches(rows, benchmark, window).filter(~contaminated()).select("row.*")


def op9_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Verbatim overlap of every document with the benchmark."""
    return judged(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("longest")
