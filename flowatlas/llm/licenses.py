"""License scans: an exact set-similarity join of text blocks with license templates.

A document's words are cut into overlapping blocks of ``2 * STRIDE`` words, one every ``STRIDE`` words, so every run of up to
``STRIDE + 1`` words lies whole in some block. A block matches a template if it holds at least the template's share
(threshold) of its distinct tokens. Tokens are put in one global order, rarest first by their count over the whole
corpus (a first Spark job); a block meets a template only where one of the template's rarest tokens (prefix filter)
stands in the block, both have enough tokens left behind that place (positional filter) and the block has enough
template tokens at all (length filter). What is left is counted in full. No candidates are capped or dropped. The templates are
the small side: their number is checked, and each worker holds an index of their prefixes; texts are never shuffled.

Phrases are templates with threshold 1 whose words must also stand consecutively; that is checked inside their matching blocks.

Null and empty texts have no words, no places and no labels (empty strings), score 0. Rows are treated one by one; extra
columns are ignored by the query and kept by ``scan``, unless they have the name of a result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowatlas.llm.common import ALNUM, column, extended, hashed_words, map_arrow, read_table, slices, without

#: Words between the starts of two blocks; the longest template.
STRIDE = 64
#: Templates sent to every worker at most.
MAX_TEMPLATES = 20_000
#: Share of a template's distinct tokens that a block must hold.
THRESHOLD = 0.9
BATCH_CHARS = 1_000_000


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    #: A phrase: all of its words, consecutive.
    phrase: bool = False


#: Phrases whose places are counted, with their labels.
PHRASES = [
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
]

#: Usual wordings of public licenses.
NOTICES = [
    Template("apache-2", "licensed under the apache license version 2 0"),
    Template("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
                    "following conditions are met"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    Template("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    Template("gpl-2", "licensed under the gnu general public license version 2"),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3"),
    Template("gpl-3", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
                      "free software foundation"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("lgpl", "licensed under the gnu lesser general public license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                    "documentation files"),
    Template("mit", "released under the mit license"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
]

SCAN_FIELDS = "n_words long, places array<struct<label:string,word:long>>, matches array<struct<label:string,word:long,containment:double>>"


class Index:
    """Templates over globally ordered tokens, with an inverted index of their prefixes."""

    def __init__(self, templates: list[Template], vocabulary: np.ndarray, counts: np.ndarray, threshold: float):
        order = np.lexsort((vocabulary, counts))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.vocabulary, self.rank, self.templates = vocabulary, rank, templates
        self.words, self.need, self.size, sets, entries = [], [], [], [], []
        for t, template in enumerate(templates):
            words = rank[np.searchsorted(vocabulary, hashed_words([template.text], ALNUM)[0])]
            tokens = np.unique(words)
            need = len(tokens) if template.phrase else max(1, math.ceil(threshold * len(tokens) - 1e-9))
            self.words.append(words)
            self.need.append(need)
            self.size.append(len(tokens))
            sets.append(tokens)
            entries += [(r, t, j) for j, r in enumerate(tokens[: len(tokens) - need + 1])]
        self.need, self.size = np.array(self.need), np.array(self.size)
        entries = np.array(sorted(entries), np.int64).reshape(-1, 3)
        self.first = np.searchsorted(entries[:, 0], np.arange(len(vocabulary) + 1))
        self.entry_template, self.entry_place = entries[:, 1], entries[:, 2]
        #: (template, token) pairs as sorted keys.
        self.members = np.sort(np.concatenate([t * len(vocabulary) + s for t, s in enumerate(sets)]))

    def ranks(self, hashes: np.ndarray) -> np.ndarray:
        """Rank of each word among the template tokens, -1 for all others."""
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, self.rank[at], -1)

    def matches(self, ranks: np.ndarray, bounds: np.ndarray):
        """Rows (document, first word of the block, template, overlap) of all blocks that meet a template.

        Positions count within a document; ``bounds`` delimit the documents in ``ranks``.
        """
        at = np.flatnonzero(ranks >= 0)
        doc = np.searchsorted(bounds, at, side="right") - 1
        local = (at - bounds[doc]) // STRIDE
        last = np.maximum(-(-(bounds[doc + 1] - bounds[doc]) // STRIDE) - 2, 0)
        width = int(np.max(np.diff(bounds), initial=0)) // STRIDE + 2
        n = len(self.vocabulary)
        keys = [(doc * width + b) * n + ranks[at] for b in (local, local - 1)]
        keys = np.unique(np.concatenate([keys[0][local <= last], keys[1][local >= 1]]))
        block, token = keys // n, keys % n
        starts = np.flatnonzero(np.diff(block, prepend=-1))
        sizes = np.diff(starts, append=len(block))
        place = np.arange(len(block)) - np.repeat(starts, sizes)
        left = np.repeat(sizes, sizes) - place
        number = np.repeat(np.arange(len(starts)), sizes)
        # Prefix filter: only tokens that are in some template's prefix reach the index.
        hits = self.first[token + 1] - self.first[token]
        row = np.repeat(np.arange(len(token)), hits)
        entry = np.arange(len(row)) - np.repeat(np.cumsum(hits) - hits, hits) + np.repeat(self.first[token], hits)
        template = self.entry_template[entry]
        need = self.need[template]
        ok = (sizes[number[row]] >= need) & (left[row] >= need) & (self.size[template] - self.entry_place[entry] >= need)
        pair = np.unique(number[row[ok]] * len(self.templates) + template[ok])
        number, template = pair // len(self.templates), pair % len(self.templates)
        spread = np.repeat(np.arange(len(pair)), sizes[number])
        inside = np.arange(len(spread)) - np.repeat(np.cumsum(sizes[number]) - sizes[number], sizes[number])
        looked = template[spread] * n + token[starts[number[spread]] + inside]
        found = np.minimum(np.searchsorted(self.members, looked), len(self.members) - 1)
        overlap = np.bincount(spread, self.members[found] == looked, len(pair)).astype(np.int64)
        ok = overlap >= self.need[template]
        first = block[starts[number[ok]]]
        return first // width, first % width * STRIDE, template[ok], overlap[ok]

    def places(self, ranks: np.ndarray, start: int, stop: int, template: int) -> np.ndarray:
        """Where the template's words stand consecutively in ``ranks[start:stop]``."""
        words = self.words[template]
        at = np.arange(start, max(start, stop - len(words) + 1))
        for k, word in enumerate(words):
            at = at[ranks[at + k] == word]
        return at

    def scan(self, texts: list) -> list[tuple[int, list, list]]:
        hashes, bounds = hashed_words(texts, ALNUM)
        ranks = self.ranks(hashes)
        places: list[set] = [set() for _ in texts]
        found: list[list] = [[] for _ in texts]
        for doc, word, t, overlap in zip(*(x.tolist() for x in self.matches(ranks, bounds))):
            template = self.templates[t]
            if template.phrase:
                low, high = int(bounds[doc]), int(bounds[doc + 1])
                at = self.places(ranks, low + word, min(low + word + 2 * STRIDE, high), t)
                places[doc].update((template.label, int(p) - low) for p in at)
            else:
                found[doc].append((template.label, word, overlap / int(self.size[t])))
        return [(int(n), sorted(p, key=lambda x: (x[1], x[0])), sorted(f)) for n, p, f in zip(np.diff(bounds), places, found)]


def token_counts(df: DataFrame, vocabulary: np.ndarray, text: str = "text") -> np.ndarray:
    """How often each template token stands in all texts: partial sums in the tasks, one small shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        known = shared.value
        total = np.zeros(len(known) + 1, np.int64)
        for batch in batches:
            texts = column(batch, text)
            for a, b in slices(texts, BATCH_CHARS):
                hashes = hashed_words(texts[a:b], ALNUM)[0]
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                total += np.bincount(np.where(known[at] == hashes, at, len(known)), minlength=len(known) + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(known))), pa.array(total[:-1])], names=["token", "n"])

    rows = map_arrow(df.select(text), run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(len(vocabulary), np.int64)
    for row in rows:
        counts[row["token"]] = row["n"]
    return counts


def scan(df: DataFrame, templates: list[Template], threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """``df`` without the text column, with the columns of ``SCAN_FIELDS``.

    ``places``: starts of the phrases, in words from 0. ``matches``: blocks (by their first word) that hold the
    threshold's share of a template.
    """
    if len(templates) > MAX_TEMPLATES or not 0 < threshold <= 1:
        raise ValueError(f"at most {MAX_TEMPLATES} templates and a threshold in (0, 1]")
    hashes, bounds = hashed_words([t.text for t in templates], ALNUM)
    if (np.diff(bounds) > STRIDE + 1).any() or (np.diff(bounds) == 0).any():
        raise ValueError(f"a template has 1 to {STRIDE + 1} words; cut longer texts into several")
    vocabulary = np.unique(hashes)
    index = df.sparkSession.sparkContext.broadcast(Index(templates, vocabulary, token_counts(df, vocabulary, text), threshold))
    kept = without(df.columns, text, "n_words", "places", "matches")
    schema = extended(df, kept, SCAN_FIELDS)
    place = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
    match = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("containment", pa.float64())]))

    def run(batches):
        for batch in batches:
            texts = column(batch, text)
            rest = batch.select(kept)
            for a, b in slices(texts, BATCH_CHARS):
                rows = index.value.scan(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [*rest.slice(a, b - a).columns, pa.array([r[0] for r in rows], pa.int64()),
                     pa.array([[{"label": x, "word": w} for x, w in r[1]] for r in rows], place),
                     pa.array([[{"label": x, "word": w, "containment": c} for x, w, c in r[2]] for r in rows], match)],
                    names=[*rest.schema.names, "n_words", "places", "matches"])

    return map_arrow(df, run, schema)


def _joined(labels):
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def op2_license_scan(spark, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document.

    ``score`` is the largest share of a template found in one block, 1 where a phrase stands, 0 without any match.
    """
    found = scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"), [*PHRASES, *NOTICES])
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places.word").alias("first_word"), F.array_max("places.word").alias("last_word"),
        _joined(F.col("places.label")).alias("base_labels"),
        _joined(F.concat("places.label", "matches.label")).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max("matches.containment"), F.lit(0.0))).alias("score"),
        F.size("matches").cast("long").alias("n_matches"),
    )
