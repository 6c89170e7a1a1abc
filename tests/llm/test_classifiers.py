"""Toxicity and quality classifiers, on planted texts and held-out rows."""

from __future__ import annotations

import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from millrace.llm import quality, toxicity
from millrace.llm.labelled import remainder
from millrace.llm.queries import op7, op8

SYLLABLES = ["ther", "ing", "ati", "on", "er", "sh", "ou", "bel", "nd", "wha", "le", "st"]


def _texts(n, seed, insults=()):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words = ["".join(rng.choices(SYLLABLES, k=rng.randrange(1, 4))) for _ in range(rng.randrange(10, 60))]
        for _ in range(2 if insults else 0):
            words.insert(rng.randrange(len(words)), rng.choice(insults))
        out.append(" ".join(words) + ".")
    return out


def _toxic_model():
    return toxicity.fit(_texts(120, 1, ("zgrumple", "fnordbag", "quexit")), _texts(120, 2))


def test_toxicity_on_held_out_and_bent_words():
    model = _toxic_model()
    bad = toxicity.text_scores(model, pa.array(_texts(60, 3, ("zgrumple", "fnordbag", "quexit"))))
    good = toxicity.text_scores(model, pa.array(_texts(60, 4)))
    assert (bad >= 0.5).mean() > 0.9 and (good >= 0.5).mean() < 0.1
    plain = toxicity.text_scores(model, pa.array(["ther ing", "", None]))
    bent = toxicity.text_scores(model, pa.array(["zgrummple", "fnordbagg", "ZGRÜMPLE", "fn0rdb4g"]))
    assert bent.min() > plain.max() and plain[1] == plain[2]


def test_toxicity_fit_keeps_little_for_each_character():
    texts = _texts(400, 8)
    codes, phi = toxicity._phi([toxicity._folded("zgrumple")])
    toxicity._Pieces(texts[:1], codes, phi)
    tracemalloc.start()
    pieces = toxicity._Pieces(texts, codes, phi)
    kept = tracemalloc.get_traced_memory()[0] - pieces.slot.nbytes
    tracemalloc.stop()
    assert kept < 4 * sum(map(len, texts))  # code points alone are four bytes
    # every character is in one piece at least, and pieces lie within one text
    places = pieces.places(np.arange(len(pieces.texts)))
    assert (places[:, 2] > places[:, 1]).all() and (places[:, 2] - places[:, 1] <= 2 * toxicity._BLOCK).all()


def test_toxicity_kernel_is_the_sum_over_common_subsequences():
    codes, phi = toxicity._phi([toxicity._folded("zgrumple")])
    pieces = toxicity._Pieces(["a zgrumple b"], codes, phi)
    got = pieces.kernel(np.array([[0, 0, 12]]))[0, 0]

    def phi_of(text):
        counts = {}
        s = list(toxicity._folded(text))
        for i in range(len(s)):
            for a in (1, 2):
                for b in (1, 2):
                    for c in (1, 2):
                        if i + a + b + c < len(s):
                            u = (s[i], s[i + a], s[i + a + b], s[i + a + b + c])
                            counts[u] = counts.get(u, 0) + toxicity.LAMBDA ** (a + b + c - 3)
        return counts

    x, y = phi_of("a zgrumple b"), phi_of("zgrumple")
    want = sum(v * x.get(u, 0) for u, v in y.items()) / np.sqrt(sum(v * v for v in y.values()))
    assert abs(got - want) < 1e-4


def test_toxicity_reads_texts_to_their_end():
    model = _toxic_model()
    long = " ".join(_texts(4000, 9))
    clean, late = toxicity.text_scores(model, pa.array([long, long + " zgrumple"]))
    assert late > clean


def test_fits_with_one_class_or_none():
    for bad, good in (([], []), (["a b"], []), ([], ["a b"])):
        score = toxicity.text_scores(toxicity.fit(bad, good), pa.array(["x"]))[0]
        assert 0 < score < 1
    none = quality.fit(np.zeros((0, len(quality.FIGURES))), np.zeros(0))
    assert none.scores(np.zeros((1, len(quality.FIGURES))))[0] == 0.5


def _junk(n, seed):
    rng = random.Random(seed)
    return [rng.choice([t.upper().replace(" ", "!! "), t.replace(" ", " | "), " ".join([t.split()[0]] * 30)]) for t in _texts(n, seed)]


def test_quality_on_held_out_rows():
    rows = quality.figures(pa.array(_texts(300, 1) + _junk(300, 2)))
    model = quality.fit(rows, np.array([1.0] * 300 + [0.0] * 300))
    assert model.pairs and np.isfinite(rows).all()
    assert (model.scores(quality.figures(pa.array(_texts(100, 3)))) >= 0.7).mean() > 0.95
    assert (model.scores(quality.figures(pa.array(_junk(100, 4)))) < 0.7).mean() > 0.95


def test_figures_of_a_text_do_not_depend_on_its_neighbours():
    texts = ["", None, "Plain words here.\nAnd more.\n", "ÉÉ ü", "\n\n", "a" * 5000, "x | y | z", "Of Of Of", "hello", "hello", "hello", "", "hello world", "world", "a", "a b", "b a"]
    together = quality.figures(pa.array(texts))
    alone = np.concatenate([quality.figures(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(together, alone)


def test_toxicity_of_a_text_does_not_depend_on_its_neighbours():
    model = _toxic_model()
    texts = ["well id", "iot is here", "", None, "id", "iot", "you i", "diot", "such an idiot", "a", "", "idi", "ot. id", "iot\n", "zgrum", "ple", "fnord", "bag zgr", "umple", "i", "d", "i", "o", "t"]
    together = toxicity.text_scores(model, pa.array(texts, pa.string()))
    alone = np.concatenate([toxicity.text_scores(model, pa.array([t], pa.string())) for t in texts])
    assert (together == alone).all()


def test_interactions_are_learned():
    rng = np.random.default_rng(0)
    rows = np.zeros((2000, len(quality.FIGURES)))
    rows[:, 0], rows[:, 1] = rng.random(2000), rng.random(2000)
    y = ((rows[:, 0] > 0.5) != (rows[:, 1] > 0.5)).astype(float)
    model = quality.fit(rows, y)
    assert ((model.scores(rows) > 0.5) == y).mean() > 0.9


def test_scores_keep_rows_and_columns(spark):
    docs = spark.createDataFrame([(1, "a", 0.5, "z"), (1, "a", 0.5, "z"), (None, None, None, None)], "doc_id long, text string, score double, of string")
    for module, model in ((toxicity, _toxic_model()), (quality, quality.fit(np.zeros((0, len(quality.FIGURES))), np.zeros(0)))):
        got = module.score(docs, model).collect()
        assert len(got) == 3 and got[0].asDict().keys() == {"doc_id", "text", "of", "score"}
        assert all(0 <= r.score <= 1 for r in got)
        assert module.score(docs.limit(0), model).count() == 0


def test_remainder_is_crc32_of_the_id_as_text(spark):
    got = spark.range(50).select("id", remainder(F.col("id"), 5).alias("r")).collect()
    assert all(r.r == zlib.crc32(str(r.id).encode()) % 5 for r in got)


def test_queries_reach_held_out_accuracy(spark, sf_dir):
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    tox = [r for r in op7(spark, sf_dir).collect() if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id].toxic for r in tox]) > 0.9
    assert not any(r.predicted for r in tox if not labels[r.doc_id].toxic)
    good = [r for r in op8(spark, sf_dir).collect() if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id].quality for r in good]) > 0.95


def test_figures_of_a_large_batch_take_little_memory(monkeypatch):
    words = ["alpha", "Beta", "12,5", "gamma.\n", "delta!", "é"]
    column = pa.array([" ".join(words[(i * k) % 6] for k in range(1, 400)) for i in range(2000)])
    assert column.nbytes > 3 << 20
    quality.figures(column[:10])
    tracemalloc.start()
    whole = quality.figures(column)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # a worker's arrays follow the slice, which is a quarter of a megabyte, and not the batch
    assert peak < 48 << 20
    monkeypatch.setattr(quality.kernels, "SLICE_BYTES", 1 << 12)
    assert np.array_equal(whole, quality.figures(column))
