"""Cross-tokenizer alignment against a plain version with the libraries."""

import bisect
import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from corpus import documents, frame
from tokenizers import Tokenizer

from flowatlas.llm import align
from flowatlas.llm.bpe import byte_characters


def dense(m: align.Csr):
    out = np.zeros((len(m.indptr) - 1, m.columns), int)
    for i in range(len(out)):
        for k in range(m.indptr[i], m.indptr[i + 1]):
            out[i, m.indices[k]] += m.data[k]
    return out


@pytest.mark.parametrize("limit", [1, 7, 1 << 20])
def test_products(limit):
    rnd = np.random.default_rng(3)
    for rows, inner, columns in ((5, 7, 4), (1, 1, 1), (0, 3, 2), (6, 3, 9), (4, 0, 3)):
        n = 2 * rows if inner and rows else 0
        a = align.Csr.summed(rnd.integers(0, max(rows, 1), n), rnd.integers(0, max(inner, 1), n), (rows, inner))
        m = 3 * inner if columns else 0
        b = align.Csr.summed(rnd.integers(0, max(inner, 1), m), rnd.integers(0, columns, m), (inner, columns))
        got = np.zeros((rows, columns), int)
        for r, c, v in align.products(a, b, limit):
            assert len({*zip(r.tolist(), c.tolist())}) == len(r)
            got[r, c] = v
        assert (got == dense(a) @ dense(b)).all()
        assert (dense(b.transposed()) == dense(b).T).all()


def test_overlaps():
    first, second, shared = align.overlaps(np.array([2, 3, 1, 4]), np.array([1, 1, 5, 2, 1]))
    assert [*zip(first.tolist(), second.tolist(), shared.tolist())] == [(0, 0, 1), (0, 1, 1), (1, 2, 3), (2, 2, 1), (3, 2, 1), (3, 3, 2), (3, 4, 1)]
    of_a, of_b = align.groups(first, second)
    assert of_a.tolist() == [0, 1, 1, 1] and of_b.tolist() == [0, 0, 1, 1, 1]


def brute(texts):
    a_path, b_path = align.default_paths()
    a, b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
    a.encode_special_tokens = True
    as_byte = {c: i for i, c in enumerate(byte_characters())}
    rows, stand = [], Counter()
    for text in texts:
        whole = (" " + text).encode() if text else b""
        x = a.encode(" " + text, add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        bx = [bytes(as_byte[c] for c in a.id_to_token(i)) for i in x]
        by = [align.piece_bytes(b.id_to_piece(i)) for i in y]
        if not text or b"".join(bx) != whole or b"".join(by) != whole:
            rows.append(([], [], []))
            continue
        ends = [set(np.cumsum([len(t) for t in z]).tolist()) for z in (bx, by)]
        cuts = sorted(ends[0] & ends[1])
        parts = []
        for ids, raw in ((x, bx), (y, by)):
            at, out = 0, defaultdict(list)
            for i, t in zip(ids, raw):
                out[bisect.bisect_right(cuts, at)].append(i)
                at += len(t)
            parts.append(out)
        groups = [(parts[0][k], parts[1][k]) for k in range(len(cuts))]
        rows.append((x, y, groups))
        stand.update({(i, j) for p, q in groups for i in p for j in q})
    most = defaultdict(int)
    for (i, _), n in stand.items():
        most[i] = max(most[i], n)
    out = []
    for x, y, groups in rows:
        links = [(i, j) for p, q in groups for i in p for j in q]
        shown = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        out.append((len(x), len(y), len(groups), len(links), sum(stand[k] == most[k[0]] for k in links), sum(stand[k] for k in links),
                    hashlib.sha256(shown.encode()).hexdigest() if x else ""))
    return out


EXTRA = ["a ▁ b", "  two   spaces ", "tab\tand\r\nline", "naïve café ’quoted’", "don't DON'T we'll", "<s> </s> <unk> <0x41>", "1234567890 3.14", "ab" * 3000, "漢字かな交じり文" * 40]


@pytest.mark.parametrize("frequent", [align.FREQUENT, 40])
def test_alignment(spark, frequent):
    rows = documents() + [(200 + k, t) for k, t in enumerate(EXTRA)]
    docs = frame(spark, rows)
    got = align.alignment(docs, *align.default_paths(), frequent=frequent).collect()
    want = [(i, *r) for (i, _), r in zip(rows, brute([t for _, t in rows]))]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert [r for r in want if r[0] == 200][0][1:4] == (0, 0, 0)  # U+2581 is not given back


def test_empty_and_long(spark):
    paths = align.default_paths()
    assert align.alignment(spark.createDataFrame([], "doc_id long, text string"), *paths).count() == 0
    long = " ".join(t for _, t in documents() if t) * 10
    got = align.alignment(spark.createDataFrame([(1, long), (2, None)], "doc_id long, text string"), *paths).collect()
    assert sorted(map(tuple, got)) == sorted((i, *r) for i, r in zip((1, 2), brute([long, None])))
