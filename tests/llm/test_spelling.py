"""Spelling variants against brute force over all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from millrace.llm import spelling


def _one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def _near(words):
    return {(a, b) for a in words for b in words if _one_apart(a, b)}


def _some_words(n, alphabet, low, high, seed):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(low, high))) for _ in range(n)})


@pytest.mark.parametrize(
    "words, levels",
    [
        (_some_words(400, "ab", 1, 9, 1), 40),
        (_some_words(400, "ab", 1, 9, 1), 5),
        (_some_words(300, "aé×", 1, 7, 2), 40),
        (["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "baaaaaaa", "aaaabaaa", "aaaaaaab", "aaaabaaaa"], 40),
        (["x" * 3000, "x" * 3001, "x" * 1500 + "y" + "x" * 1499, "y" + "x" * 2999, "x" * 39, "x" * 40, "x" * 41], 40),
        (["alone"], 40),
        ([], 40),
    ],
)
def test_near_words_are_those_one_edit_apart(spark, words, levels):
    table = spark.createDataFrame([(w,) for w in words], "word string")
    got = [tuple(r) for r in spelling.near_words(table, levels=levels).collect()]
    assert len(got) == len(set(got)) and set(got) == _near(words)


def _expected(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    near = {w: [] for w in n}
    for a, b in _near(n):
        near[a].append(b)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def test_variants_of_texts_equal_brute_force(spark):
    rng = random.Random(4)
    base = _some_words(40, "abcdeÉé", 7, 9, 5) + ["chained", "chainedx", "chainedxy"]
    weights = [rng.choice([1, 12, 140, 1600]) for _ in base[:-3]] + [1600, 140, 12]
    rows = [(i, " ".join(w.upper() if rng.random() < 0.2 else w for w in rng.choices(base, weights, k=250))) for i in range(40)]
    rows += [(None, "nothing-nothing"), (5, None), (6, ""), (7, "short words 12345678"), (8, rows[0][1]), (8, rows[0][1]), (9, "Z" * 70_000 + " " + "z" * 70_000)]
    docs = spark.createDataFrame([(d, t, "w", 1) for d, t in rows], "doc_id long, text string, word string, n int")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_variants(docs).collect()}
    want = _expected(rows)
    assert got == want
    assert any(f and r != f for f, r, *_ in want.values())  # a chain of two steps


def test_ties_go_to_the_first_in_code_point_order(spark):
    words = spark.createDataFrame([("wordone", 1), ("wordona", 10), ("wordoné", 10), ("wordonz", 10)], "word string, n long")
    got = {r.word: (r.form, r.n_near) for r in spelling.group_variants(words).collect()}
    assert got["wordone"] == ("wordona", 3) and got["wordona"] == (None, 3)


def test_no_words_no_rows(spark):
    docs = spark.createDataFrame([(1, "too few"), (2, None)], "doc_id long, text string")
    assert spelling.spelling_variants(docs).count() == 0
    assert spelling.spelling_variants(docs.limit(0)).count() == 0
