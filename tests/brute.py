"""Plain Python answers for small graphs given as lists of (src, dst, weight)."""

import itertools
import random
from collections import Counter, defaultdict


def random_graph(seed, n=14, m=40, hub=True):
    rng = random.Random(seed)
    pairs = set()
    while len(pairs) < m:
        a, b = rng.randrange(n), rng.randrange(n)
        if hub and rng.random() < 0.35:
            a = 0  # one source holds a third of the edges
        if a != b:
            pairs.add((a, b))
    return [(a, b, rng.randrange(1, 9)) for a, b in sorted(pairs)]


def vertices(edges):
    return sorted({a for a, _, _ in edges} | {b for _, b, _ in edges})


def pagerank(edges, ids, rounds=20, weighted=True, alpha=0.85):
    out = defaultdict(float)
    for a, _, w in edges:
        out[a] += w if weighted else 1
    r = {v: 1 / len(ids) for v in ids}
    for _ in range(rounds):
        lost = sum(r[v] for v in ids if v not in out)
        new = {v: (1 - alpha + alpha * lost) / len(ids) for v in ids}
        for a, b, w in edges:
            new[b] += alpha * r[a] * (w if weighted else 1) / out[a]
        r = new
    return r


def reach(edges, ids):
    seen = {v: {v} for v in ids}
    following = defaultdict(set)
    for a, b, _ in edges:
        following[a].add(b)
    for v in ids:
        todo = [v]
        while todo:
            for x in following[todo.pop()] - seen[v]:
                seen[v].add(x)
                todo.append(x)
    return seen


def weak(edges, ids):
    both = reach(edges + [(b, a, w) for a, b, w in edges], ids)
    return {v: min(both[v]) for v in ids}


def strong(edges, ids):
    to = reach(edges, ids)
    return {v: min(x for x in to[v] if v in to[x]) for v in ids}


def labels(edges, ids, rounds=5):
    state = {v: v for v in ids}
    for _ in range(rounds):
        votes = defaultdict(Counter)
        for a, b, _ in edges:
            votes[b][state[a]] += 1
            votes[a][state[b]] += 1
        state = {v: min(votes[v], key=lambda x: (-votes[v][x], x)) if votes[v] else state[v] for v in ids}
    return state


def distances(edges, ids, cost):
    d = {(a, b): (0 if a == b else float("inf")) for a in ids for b in ids}
    for a, b, w in edges:
        d[a, b] = min(d[a, b], cost(w))
    for k, a, b in itertools.product(ids, ids, ids):
        d[a, b] = min(d[a, b], d[a, k] + d[k, b])
    return d


def betweenness(edges, ids, cost, sources=None):
    d = distances(edges, ids, cost)
    count = {}
    for s in ids:
        for t in sorted(ids, key=lambda x: d[s, x]):
            count[s, t] = 1 if s == t else sum(
                count[s, a] for a, b, w in edges if b == t and d[s, t] < float("inf") and abs(d[s, a] + cost(w) - d[s, t]) < 1e-12)
    n = len(ids)
    chosen = list(ids) if sources is None else sources
    result = {}
    for v in ids:
        total = 0.0
        for s in chosen:
            for t in ids:
                if len({s, v, t}) == 3 and d[s, t] < float("inf") and abs(d[s, v] + d[v, t] - d[s, t]) < 1e-12:
                    total += count[s, v] * count[v, t] / count[s, t]
        result[v] = total * n / len(chosen) / ((n - 1) * (n - 2))
    return result


def average_hops(edges, ids):
    """(size of largest weak component, mean hops in it)."""
    groups = defaultdict(list)
    for v, c in weak(edges, ids).items():
        groups[c].append(v)
    core = max(groups.values(), key=lambda g: (len(g), -min(g)))
    both = [(a, b, 1) for a, b, _ in edges] + [(b, a, 1) for a, b, _ in edges]
    d = distances(both, ids, lambda w: 1)
    if len(core) < 2:
        return len(core), None
    total = sum(d[a, b] for a in core for b in core)
    return len(core), total / (len(core) * (len(core) - 1))
