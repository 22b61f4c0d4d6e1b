"""BPE, license scans, decontamination, language, language model, quality: against plain versions and libraries."""

import collections
import hashlib
import math
import random
import tracemalloc

import numpy as np
import pytest
from corpus import ALNUM, SPACED, documents, frame, words
from pyspark.sql import functions as F

from flowatlas.llm import bpe, common, decontaminate, language, language_model, licenses, quality


def by_row(df, *columns):
    """Rows as sorted tuples: ids repeat and may be null."""
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def same(df, columns, expected):
    assert by_row(df, *columns) == sorted(expected, key=repr)


@pytest.mark.parametrize("pattern,table", [(SPACED, common.SPACED), (ALNUM, common.ALNUM)])
def test_word_hashes(pattern, table, monkeypatch):
    monkeypatch.setattr(common, "PIECE_BYTES", 64)
    texts = [t for _, t in documents()] + ["A" * 300 + " b"]
    hashes, bounds = common.hashed_words(texts, table)
    split = [words(t, pattern) for t in texts]
    assert np.diff(bounds).tolist() == [len(w) for w in split]
    of = {}
    for w, h in zip((w for s in split for w in s), hashes.tolist()):
        assert of.setdefault(w, h) == h
    assert len(set(of.values())) == len(of)


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_path())
    rnd = random.Random(3)
    letters = ["a", "b", " ", "  ", "\n", "\t", "'s", "'ll", "1", "½", "é", "日", "🙂", "\x1c", "　", "!", "the", " the", "<|endoftext|>", "<|end"]
    rows = documents() + [(1000 + k, "".join(rnd.choice(letters) for _ in range(rnd.randrange(30)))) for k in range(300)] + [(2000, "ab" * 400 + " ab")]
    expected = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        shown = library.decode(ids, skip_special_tokens=False)
        expected.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(shown.encode()).hexdigest()))
    same(bpe.tokenized(frame(spark, rows), bpe.default_path()), ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"), expected)
    kept = bpe.encode(frame(spark), bpe.default_path())
    assert set(kept.columns) == set(frame(spark).columns) and dict(kept.dtypes)["ids"] == "array<int>"
    assert bpe.tokenized(frame(spark, []), bpe.default_path()).count() == 0


def test_bpe_long_words_agree_with_the_rounds(monkeypatch):
    vocabulary = bpe.Vocabulary(bpe.default_path())
    long_words = [w.encode() for w in ("ererethinging" * 30, "a" * 700, "".join(chr(97 + k * k % 26) for k in range(900)))]
    alone = bpe.merge_words(vocabulary, long_words)
    monkeypatch.setattr(bpe, "LONG_WORD", 10_000)
    assert bpe.merge_words(vocabulary, long_words) == alone


def test_decode_of_odd_ids(spark):
    rows = spark.createDataFrame([(1, [300, -5, 10**6]), (2, None), (3, []), (4, [50256])], "doc_id int, ids array<int>")
    shown = dict(by_row(bpe.decode(rows, bpe.default_path()), "doc_id", "decoded"))
    assert shown[2] == shown[3] == "" and shown[4] == "<|endoftext|>" and shown[1]


def test_license_scan(spark):
    found = licenses.scan(frame(spark).select("doc_id", "text", "score"), [*licenses.PHRASES, *licenses.NOTICES])
    expected = []
    for i, text in documents():
        w = words(text, ALNUM)
        places = sorted((k, t.label) for t in licenses.PHRASES for k in range(len(w)) if w[k:k + len(t.text.split())] == t.text.split())
        labels = set()
        for b in range(max(1, -(-len(w) // licenses.STRIDE) - 1) if w else 0):
            block = set(w[b * licenses.STRIDE:(b + 2) * licenses.STRIDE])
            labels |= {t.label for t in licenses.NOTICES
                       if len(block & set(t.text.split())) >= math.ceil(licenses.THRESHOLD * len(set(t.text.split())) - 1e-9)}
        expected.append((i, len(w), tuple(places), tuple(sorted(labels))))
    got = [(r["doc_id"], r["n_words"], tuple((p["word"], p["label"]) for p in r["places"]), tuple(sorted({m["label"] for m in r["matches"]}))) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert any(x[2] for x in got) and any(x[3] for x in got)
    assert licenses.scan(frame(spark, []), licenses.PHRASES).count() == 0


def test_license_phrase_across_blocks(spark):
    rows = [(k, "w " * k + "under the mit license" + " w" * 70) for k in range(50, 140, 3)]
    found = licenses.scan(frame(spark, rows).select("doc_id", "text"), licenses.PHRASES)
    same(found.select("doc_id", F.col("places")[0]["word"].alias("at"), F.size("places").alias("n")), ("doc_id", "at", "n"), [(k, k, 1) for k, _ in rows])


def test_suffix_array_order():
    rnd = np.random.default_rng(5)
    texts = [" ".join(rnd.choice(list("abc"), n)) for n in (40, 0, 1, 30, 30)] + ["a b a b a b a b a b"] * 2
    hashes, bounds = common.hashed_words(texts, common.ALNUM)
    array = decontaminate.SuffixArray(hashes, bounds, 16)
    suffix = [tuple(hashes[p:min(p + 16, array.stop[p])].tolist()) for p in array.order.tolist()]
    assert sorted(array.order.tolist()) == list(range(len(hashes))) and suffix == sorted(suffix)


@pytest.mark.parametrize("shard", [200, 4_000_000])
def test_decontamination(spark, monkeypatch, shard):
    monkeypatch.setattr(decontaminate, "SHARD_CHARS", shard)
    docs = documents()
    text = dict((i, t) for i, t in docs if t)
    items = [(7, " ".join(text[1].split()[10:40])), (11, " ".join(text[6].split()[:13])), (2, "one two"), (3, ""), (4, None), (5, text[21][100:400]), (6, " ".join(text[1].split()[5:30])),
             (None, "e d c b a")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    windows = collections.defaultdict(set)
    for i, t in items:
        w = words(t, ALNUM)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[k:k + n])].add("" if i is None else str(i))
    expected = []
    for i, t in docs:
        w, hit, found = words(t, ALNUM), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        expected.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    same(decontaminate.judged(frame(spark), benchmark), columns, expected)
    if shard == 200:
        monkeypatch.setattr(decontaminate, "ITEM_BLOCK_WORDS", 40)
        same(decontaminate.judged(frame(spark), benchmark), columns, expected)
        clean = decontaminate.cleaned(frame(spark), benchmark)
        assert clean.columns == frame(spark).columns and clean.count() == sum(not x[-1] for x in expected)
        assert decontaminate.judged(frame(spark), benchmark.limit(0)).filter("contaminated").isEmpty()


def plain_matches(text, item, window):
    """Maximal common word runs by comparing every pair of places."""
    a, b = words(text, ALNUM), words(item, ALNUM)
    least = min(window, len(b))
    found = set()
    for p in range(len(a)):
        for q in range(len(b)):
            if p and q and a[p - 1] == b[q - 1]:
                continue
            n = 0
            while p + n < len(a) and q + n < len(b) and a[p + n] == b[q + n]:
                n += 1
            if n >= least:
                found.add((p, q, n))
    return found


def test_matches_equal_comparing_all_places():
    """Few different words, so that windows repeat in texts and items; short, empty and repeated items; words of no item."""
    rnd = np.random.default_rng(3)
    for trial in range(40):
        draw = lambda n, letters: " ".join(rnd.choice(list(letters), n))
        items = [draw(n, "ab" if trial % 2 else "abc") for n in (12, 3, 1, 30)] + ["a a a a a a a a", "", "x y"]
        items.append(items[0])
        texts = [draw(n, "abz") for n in (40, 0, 2, 60)] + [None, "a " * 30, "a b " * 15, items[3]]
        block = decontaminate.Items([str(n) for n in range(len(items))], items, 4)
        got = block.matches(texts)
        for text, (n_words, found) in zip(texts, got):
            assert n_words == len(words(text, ALNUM)) and len(found) == len(set(found))
            for n, item in enumerate(items):
                assert {m[1:] for m in found if m[0] == str(n)} == plain_matches(text, item, 4), (trial, text, item)


def test_repeated_words_cost_their_length():
    """20,000 times a word against 3,000 times the same word: 60 million pairs of places, some ten thousand matches."""
    block = decontaminate.Items(["x"], ["a " * 3000], 13)
    tracemalloc.start()
    (n_words, found), = block.matches(["a " * 20000])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n_words == 20000 and max(m[3] for m in found) == 3000 and len(found) < 23000
    assert peak < 200e6


def test_longest_matches_and_their_places(spark):
    body = documents()[0][1].split()
    docs = frame(spark, [(1, " ".join(["q"] * 5 + body[20:60] + ["q"] * 5))])
    benchmark = spark.createDataFrame([(9, " ".join(body[10:80]))], "item_id long, text string")
    found = decontaminate.matches(docs.select("doc_id", "text"), benchmark).first()["matches"]
    assert [(m["item"], m["doc_word"], m["item_word"], m["words"]) for m in found] == [("9", 5, 10, 40)]


def test_language(spark):
    rnd = random.Random(1)
    say = {"en": ["the", "thing", "with"], "fr": ["les", "eaux", "où"], "de": ["der", "schön", "ung"]}
    rows = [(k, " ".join(rnd.choice(say[lang]) for _ in range(30)), lang) for k in range(60) for lang in say]
    train = spark.createDataFrame([*rows, (900, None, "en"), (901, "12 34", "de"), (902, "abc", None)], "doc_id long, text string, lang string")
    model = language.fit(train)
    assert model[0] == ["de", "en", "fr"]
    got = language.predicted(spark.createDataFrame([(1, "schön der ung"), (2, "les eaux"), (3, "the THING"), (4, None), (5, ""), (6, "12 ?!"), (7, "日"), (8, "the " * 9000)],
                                                   "doc_id long, text string"), model)
    pred = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got.collect()}
    assert [pred[k][0] for k in (1, 2, 3, 8)] == ["de", "fr", "en", "en"]
    assert all(pred[k] == ("und", 0.0) for k in (4, 5, 6)) and pred[7][0] in model[0] and all(0 <= s <= 1 for _, s in pred.values())
    everything = language.predicted(frame(spark), language.fit(train.limit(0)))
    assert {r["lang_pred"] for r in everything.collect()} == {"und"} and everything.count() == len(documents())


def brute_model(train, texts, order):
    """Kneser-Ney by its definition: counts of the longest n-grams and of those at a text's start, else different words before."""
    sentences = [["<s>", *words(t, SPACED), "</s>"] for t in train]
    raw = [collections.Counter(tuple(s[i:i + n]) for s in sentences for i in range(len(s) - n + 1)) for n in range(1, order + 1)]
    tables = []
    for n in range(1, order + 1):
        if n == order:
            tables.append(raw[n - 1])
            continue
        table = collections.Counter(g[1:] for g in raw[n])
        if n > 1:
            table.update({g: c for g, c in raw[n - 1].items() if g[0] == "<s>"})
        tables.append(table)
    counts = collections.Counter(w for s in sentences for w in s[1:])
    total, size = sum(counts.values()), len(counts)
    cuts = [language_model.discounts([sum(c == n for c in t.values()) for n in (1, 2, 3, 4)]).tolist() for t in tables]
    mass, given = collections.Counter(), collections.Counter()
    for table, cut in zip(tables, cuts):
        for g, c in table.items():
            mass[g[:-1]] += c
            given[g[:-1]] += cut[min(c, 3)]

    def probability(context, w):
        p = probability(context[1:], w) if context else 1 / (size + 1)
        if not mass[context]:
            return p
        c = tables[len(context)][(*context, w)]
        return (max(c - cuts[len(context)][min(c, 3)], 0) + given[context] * p) / mass[context]

    out = []
    for t in texts:
        s = ["<s>", *words(t, SPACED), "</s>"]
        score = sum(math.log10(probability(tuple(s[max(0, i - order + 1):i]), s[i])) for i in range(1, len(s)))
        out.append((len(s) - 1, sum(w in counts for w in s[1:]), sum(math.log10((counts[w] + 1) / (total + size + 1)) for w in s[1:]), score))
    return out


@pytest.mark.parametrize("order", [2, 3])
@pytest.mark.parametrize("flush,ranges,size", [(4_000_000, 4_000_000, 1 << 25), (50, 300, 2000)])
def test_language_model(spark, monkeypatch, flush, ranges, size, order):
    for name, value in {"FLUSH": flush, "RANGE_TOKENS": ranges, "WORD_RANGE_BYTES": size, "WIDE": 2 if flush == 50 else 16}.items():
        monkeypatch.setattr(language_model, name, value)
    texts = [t for _, t in documents()] + ["the the the " * 400, " ".join(f"so be {k % 90}" for k in range(700)), "so be unknown words here the the end"]
    train = texts[:-1]
    model = language_model.train(frame(spark, list(enumerate(train))), order=order)
    assert model["tokens"] == sum(len(words(t, SPACED)) + 1 for t in train)
    if order == 3 and flush == 50:
        assert len(model["gram_bounds"]) > len(model["pair_bounds"])  # "so be" is heavier than a range
    rows = {r["doc_id"]: r for r in language_model.scored(frame(spark, list(enumerate(texts))), model).collect()}
    for k, (n, known, base, score) in enumerate(brute_model(train, texts, order)):
        assert (rows[k]["n_tokens"], rows[k]["n_known"]) == (n, known)
        assert rows[k]["base_score"] == pytest.approx(base, abs=1e-6) and rows[k]["score"] == pytest.approx(score, abs=1e-6)


def test_discounts_are_never_nothing():
    for times in ([5, 1, 1, 9], [1, 9, 1, 9], [3, 0, 2, 1], [0, 0, 0, 0]):
        d = language_model.discounts(times)
        assert d[0] == 0 and (d[1:] > 0).all() and (d[1:] <= [1, 2, 3]).all()


def test_language_model_without_training(spark):
    for order in (2, 3):
        model = language_model.train(frame(spark, []), order=order)
        rows = language_model.scored(frame(spark, [(1, None), (2, "a b")]), model).collect()
        assert sorted((r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in rows) == [(1, 0, 0.0, 0.0), (3, 0, 0.0, 0.0)]
    with pytest.raises(ValueError, match="trigrams"):
        language_model.train(frame(spark, []), order=4)


def test_quality_on_held_out_documents(spark):
    from corpus import prose

    rows = []
    for k in range(240):
        text = prose(40, 500 + k, 5000)
        rows.append((k, text.upper().replace(" ", "!! ") if k % 4 == 0 else text, int(k % 4 != 0)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 160] + [(None, 1), (3, None), (5, 1)], "doc_id long, label int")
    weights = quality.train(docs, labels)
    got = {r["doc_id"]: r["score"] for r in quality.scored(docs, weights).collect()}
    assert np.mean([(got[i] >= 0.7) == (y == 1) for i, _, y in rows if i >= 160]) > 0.95
    awkward = quality.scored(frame(spark), weights)
    assert awkward.columns.count("score") == 1 and awkward.count() == len(documents())
    assert all(0 <= r["score"] <= 1 for r in awkward.select("score").collect())
    assert quality.accepted(frame(spark), labels).columns == frame(spark).columns
    assert {r["score"] for r in quality.scored(frame(spark), quality.train(docs, labels.limit(0))).collect()} == {0.5}
