"""Small documents with every awkward case, and plain-Python versions of the operators."""

from __future__ import annotations

import random
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, pattern):
    return pattern.findall((text or "").translate(LOWER))


def prose(n: int, seed: int, vocabulary: int = 400) -> str:
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abdeilmnorstu") for _ in range(2 + k % 7)) for k in (rnd.randrange(vocabulary) for _ in range(n)))


def edited(text: str, every: int, seed: int) -> str:
    """Every so many words replaced by new ones."""
    rnd = random.Random(seed)
    return " ".join(f"x{rnd.randrange(10**9)}" if k % every == 0 else w for k, w in enumerate(text.split(" ")))


def documents() -> list[tuple[int | None, str | None]]:
    base, other = prose(300, 1), prose(120, 2)
    rows: list[tuple[int | None, str | None]] = [
        (1, base), (2, base), (3, edited(base, 60, 3)), (4, edited(base, 60, 4)), (5, edited(base, 10, 5)),
        (6, other), (7, other.upper()), (8, other + " tail"), (9, None), (10, None), (11, ""), (12, " \n\t"), (13, "one two"), (14, "ONE  two"),
        (15, "one"), (16, "two one"), (17, "a b c d e"), (18, "e d c b a"), (19, "ß İ ſ \x00 \x1c 日本語 🙂 ١٢"), (20, "x" * 5000), (21, prose(6000, 21)),
        (22, "Licensed under the Apache License,\nVersion 2.0. Released under the MIT License."), (23, "CC BY-NC 4.0 cc by nc"), (24, "<|endoftext|> a<|endoftext|>"),
        (25, base), (25, base), (None, base), (None, None), (None, other), (26, "?! ... ***"),
    ]
    return rows + [(100 + k, edited(base, 25, 100 + k)) for k in range(12)]


CLASHING = ("score string, ids string, decoded string, n_words string, places string, matches string, component_id string, kept string, rep string, "
            "row_key string, candidate string, row string, lang_pred string, n_tokens string, of string, label string, place string, shard string, secrets string")


def frame(spark, rows=None):
    """Documents with all usual columns and many whose names the operators use themselves."""
    rows = documents() if rows is None else rows
    extra = [c.split()[0] for c in CLASHING.split(", ")]
    data = [(i, t, [None, "en", "fr"][k % 3], None if k % 5 == 0 else f"src{k % 2}", None if t is None else len(t), *("z" for _ in extra)) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, " + CLASHING)
