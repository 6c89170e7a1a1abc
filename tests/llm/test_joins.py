"""n-gram join, line dedup, exact dedup and components, against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from millrace.llm import exact_dedup, ngram_join
from millrace.llm.components import connected_components
from millrace.llm.line_dedup import dedup_lines
from millrace.llm.ngram_join import link_documents

DOCS = "doc_id long, text string, n int, component long, token string"


def _words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def _set(words):
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def _near_copies(seed, groups=12, size=8):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.choice([4, 6, 30, 80]))
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    return texts + ["", None, "  \t", "one", "ONE", "a b c d", "x" * 20_000]


def _components(texts):
    sets = [_set(_words(t)) for t in texts]
    label = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i in range(len(texts)):
            for j in range(i):
                a, b = sets[i], sets[j]
                if a and b and 100 * len(a & b) >= 75 * len(a | b) and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return {i: (len(sets[i]), label[i]) for i in range(len(texts))}


@pytest.mark.parametrize("rounds", [0, 1, 2])
def test_ngram_join_finds_all_links(spark, rounds):
    texts = _near_copies(rounds)
    docs = spark.createDataFrame([(i, t, 1, 5, "x") for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in link_documents(docs, hub_rounds=max(rounds, 1)).collect()}
    assert got == _components(texts)


def test_ngram_join_of_repeated_null_and_no_rows(spark):
    rows = [(1, "a b c d e f", 1, 1, "x")] * 2 + [(None, "a b c d e f", 1, 1, "x"), (None, None, 1, 1, "x")]
    got = sorted(map(tuple, link_documents(spark.createDataFrame(rows, DOCS)).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (None, 2, 1), (None, 0, None)], key=str)
    assert link_documents(spark.createDataFrame([], DOCS)).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def _dedup_lines(rows):
    """rows (id, text) in order; the texts without repeated lines."""
    seen, out = [], {}
    for key, text in rows:
        kept = []
        for line in (text or "").split("\n"):
            words = re.findall(r"[^\x20\x09-\x0D]+", line.lower())
            tokens = _set(words)
            if tokens and any(100 * len(tokens & s) >= 75 * len(tokens | s) for s in seen):
                pass
            else:
                kept.append(line)
            if tokens:
                seen.append(tokens)
        out[key] = None if text is None else "\n".join(kept)
    return out


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(5)
    lines = [t for t in _near_copies(3, groups=6, size=6) if t is not None][:-1]
    rows = [(i, "\n".join(rng.choices(lines, k=rng.randrange(0, 6)))) for i in range(25)] + [(30, None), (31, "\n\n"), (32, " \n new words here\n")]
    docs = spark.createDataFrame([(i, t, 7, 8, "keep") for i, t in rows], "doc_id long, text string, k int, place long, gone string")
    got = dedup_lines(docs).collect()
    assert {r.doc_id: r.text for r in got} == _dedup_lines(rows)
    assert {(r.k, r.place, r.gone) for r in got} == {(7, 8, "keep")}
    assert all(r.n_removed <= r.n_lines for r in got)


def test_a_five_word_line_matches_a_longer_one_of_the_same_shingle(spark):
    rows = [(1, "- - - - -"), (2, "- - - - - -"), (3, "a b c d e"), (4, "a b c d"), (5, "a b c d e f")]
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in got} == _dedup_lines(rows)
    assert {r.doc_id: r.n_removed for r in got} == {1: 0, 2: 1, 3: 0, 4: 0, 5: 0}


def test_line_dedup_of_repeated_null_and_no_rows(spark):
    line = "the same line in all of them"
    rows = [(None, line), (1, line), (1, line), (1, f"{line}\nnew"), (2, line)]
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    # the null id comes first; every later copy goes, in repeated rows alike
    assert sorted((r.text for r in got), key=str) == ["", "", "", "new", line]
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@settings(max_examples=25, deadline=None)
@given(st.sets(st.integers(0, 2**60), min_size=1, max_size=3000))
def test_fuse_filter_holds_all_its_keys(keys):
    keys = np.array(sorted(keys), np.uint64)
    table = exact_dedup.build_filter(keys)
    assert exact_dedup.may_hold(keys, *table).all()


def test_fuse_filter_turns_most_others_away():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**60, 50_000, dtype=np.uint64))
    others = rng.integers(2**60, 2**61, 100_000, dtype=np.uint64)
    table = exact_dedup.build_filter(keys)
    assert exact_dedup.may_hold(others, *table).mean() < 0.01
    assert len(table[3]) < 1.3 * len(keys)


def test_exact_dedup_against_brute_force(spark):
    texts = ["Abc", "aBC", "abc ", "É", "é", None, "", "x" * 100_000, "X" * 100_000] * 3
    rows = [(i, t, 1, 2, "a") for i, t in enumerate(texts)] + [(3, "twice", 1, 2, "a")] * 2 + [(None, "Abc", 1, 2, "a")]
    got = exact_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string, size int, last long, sha string")).collect()

    def normal(t):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")

    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(normal(t), []).append(-1 if i is None else i)
    want = []
    for i, t, *_ in rows:
        group = groups[normal(t)]
        want.append((i, max(group), len(group), i == max(group), hashlib.sha256(normal(t).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert exact_dedup.dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_counts_of_many_tasks_are_summed_in_rounds(monkeypatch):
    """Tables of more tasks than one group takes give the same sums."""
    monkeypatch.setattr(ngram_join, "_WIDTH_BITS", 8)
    rng = np.random.default_rng(5)
    tables = rng.integers(0, 1000, (7, 256)).astype(np.uint16)
    width = 256 // ngram_join._PARTS
    rows = [(k, t[k * width : (k + 1) * width].tobytes()) for t in tables for k in range(ngram_join._PARTS)]

    def summed(arrays, last):
        batch = pa.RecordBatch.from_arrays([pa.array([0] * len(arrays), pa.int32()), pa.array(arrays, pa.binary())], names=["part", "counts"])
        (out,) = ngram_join._add_counts(last)(iter([batch.slice(0, 1), batch.slice(1)]))
        return out.column("counts")[0].as_py(), out.column("total")[0].as_py()

    first = [c for k, c in rows if k == 0]
    found, total = summed([summed(first[:3], False)[0], summed(first[3:], False)[0]], True)
    wanted = tables[:, :width].sum(0, dtype=np.uint64)
    assert total == int(wanted.sum())
    assert np.array_equal(np.frombuffer(found, np.uint16), ngram_join._scaled(wanted))
