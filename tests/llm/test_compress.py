"""Vector codes against a plain version."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from flowatlas.llm import compress


def brute(rows, parts, entries, rounds):
    """``rows``: (vec_id, vector, label)."""
    kept = [(i, [math.floor(256 * x) for x in v], l) for i, v, l in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    w = len(kept[0][1]) // parts
    books = [[r[1][p * w:p * w + w] for r in kept[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        new = []
        for p, book in enumerate(books):
            members = defaultdict(list)
            for _, v, _ in kept:
                x = v[p * w:p * w + w]
                members[near(x, book)[1]].append(x)
            new.append([[sum(c) // len(members[k]) for c in zip(*members[k])] if members[k] else e for k, e in enumerate(book)])
        books = new
    found = [(i, l, [near(v[p * w:p * w + w], books[p]) for p in range(parts)]) for i, v, l in kept]
    sums = defaultdict(int)
    for _, l, f in found:
        sums[l] += sum(d for d, _ in f)
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return [(i, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), sums[l], digest) for i, l, f in found]


def vectors(n, d, seed):
    rnd = random.Random(seed)
    rows = [(k, [float(np.float32(rnd.gauss(0, 0.2))) for _ in range(d)], rnd.choice([None, 1, 2, 3])) for k in range(n)]
    rows += [(n + k, list(rows[k % 3][1]), 1) for k in range(20)]  # copies
    rows += [(n + 30, None, 1), (n + 31, [None] + [0.1] * (d - 1), 2), (n + 32, [float("nan")] * d, 1), (n + 33, [float("-inf")] * d, None), (n + 34, [], 1),
             (n + 35, [0.5] * (2 * d), 1), (None, [0.25] * d, 1), (7, [0.5] * d, 3), (7, [0.5] * d, 3), (n + 40, [0.0] * d, None), (n + 41, [-0.0] * d, None)]
    return rows


@pytest.mark.parametrize("parts,entries,rounds,n", [(4, 8, 2, 150), (2, 300, 3, 40), (16, 64, 2, 90)])
def test_codes(spark, parts, entries, rounds, n):
    rows = vectors(n, 16, n)
    df = spark.createDataFrame([(i, v, l, "z", "z", "z", 1.0) for i, v, l in rows],
                               "vec_id long, embedding array<float>, label int, v string, code string, to_pivots string, error double")
    got = sorted(map(tuple, compress.compressed(df.repartition(3), parts=parts, entries=entries, rounds=rounds).collect()), key=repr)
    want = brute(rows, parts, entries, rounds)
    if entries > 256:
        want = [(i, "".join(f"{int(c[k:k + 2], 16):02x}" for k in range(0, len(c), 2)), *r) for i, c, *r in want]
    assert got == sorted(want, key=repr)


def test_pruning_is_exact_and_prunes():
    rnd = np.random.default_rng(5)
    centres = rnd.integers(-4000, 4000, (40, 6))
    x = np.concatenate([centres[rnd.integers(0, 40, 3000)] + rnd.integers(-60, 60, (3000, 6)), np.zeros((5, 6), np.int64)])
    entries = np.concatenate([centres, centres[:5], np.zeros((2, 6), np.int64)])
    pivots = compress.choose_pivots(entries, 4)
    far = np.sqrt(compress.squared(x[:, None], pivots[None]).astype(float))
    number, distance, evaluated = compress.nearest_entries(x, far, entries, pivots)
    all_ = compress.squared(x[:, None], entries[None])
    assert (number == all_.argmin(axis=1)).all() and (distance == all_.min(axis=1)).all()
    assert evaluated < 0.25 * all_.size


def test_empty_and_refused(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert compress.compressed(spark.createDataFrame([], schema)).count() == 0
    assert compress.compressed(spark.createDataFrame([(1, None, 2), (2, [float("nan")] * 16, 1)], schema)).count() == 0
    one = compress.compressed(spark.createDataFrame([(5, [0.1] * 16, None)], schema)).collect()
    assert [(r["vec_id"], r["code"], r["error"], r["label_error"]) for r in one] == [(5, "00" * 16, 0, 0)]
    with pytest.raises(ValueError):
        compress.compressed(spark.createDataFrame([(5, [0.1] * 17, None)], schema)).collect()
    with pytest.raises(Exception, match="too large"):
        compress.compressed(spark.createDataFrame([(5, [1e30] * 16, None)], schema)).collect()
