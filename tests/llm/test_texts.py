"""Packing, SentencePiece, HTML, fingerprints, licences: round trips and brute force."""

from __future__ import annotations

import hashlib
import random
import textwrap
import zlib

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import html_text, kernels, licenses, packing, pieces
from millrace.llm.fingerprint import combined, fingerprint_with_edits, fingerprints, likeness
from millrace.llm.queries import TOKENIZER, tokenizer_path
from pyspark.sql import functions as F

ALPHABET = " \n\t   　'strevldmABcé1²٣Ⅷ!.|$日本ß\U0001F600̀\r▁"


def _odd_texts(n, seed=1, longest=30):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def _encoded(encoder, texts):
    ids, out = [], []
    for _, data, offsets in kernels.slices(pa.array(texts, pa.string())):
        ids, first = encoder.encode(data, offsets)
        out += [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])]
    return out


@pytest.mark.parametrize("plain", [False, True])
def test_packing_encodes_as_the_tokenizer_does(plain):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer_path(TOKENIZER))
    if plain:
        own.encode_special_tokens = True
    mark = "<|endoftext|>"
    texts = _odd_texts(4000) + ["", "it's", "''s", " 's", "\n's", "'s's x", "you'll we'rex", f"{mark} x", "x" * 50_000]
    texts += [f"one {mark} two", mark, mark * 3, f"a'{mark}s  {mark}\n", f"{mark}'s", "it's <|endof", f"text|> it's{mark}", f"  {mark}  <|end"]
    rng = random.Random(4)
    texts += ["".join(rng.choice([mark, " ", "a", "'s", "\n", "|>", "<|", "endoftext"]) for _ in range(12)) for _ in range(500)]
    got = _encoded(packing.Encoder(tokenizer_path(TOKENIZER), 0, plain=plain), texts)
    assert got == [e.ids + [0] for e in own.encode_batch(texts, add_special_tokens=False)]


def test_new_words_go_to_the_tokenizer_together():
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer_path(TOKENIZER))
    encoder = packing.Encoder(tokenizer_path(TOKENIZER), 0)
    sent = []

    class Counting:
        def encode_batch_fast(self, texts, **more):
            sent.extend(texts)
            return own.encode_batch_fast(texts, **more)

    encoder.tokenizer = Counting()
    texts = [f"w{k}x it's {k}\n\u2028 \x85 \x1c'{k}ll \xa0" for k in range(3000)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    sizes = np.cumsum([0, *(len(t.encode()) for t in texts)])
    for size in (1000, 1, 1500, 499):  # the words of a slice are known in the next ones
        for a in range(0, len(texts), size) if size > 1 else range(5):
            b = min(a + size, len(texts))
            ids, first = encoder.encode(data[sizes[a] : sizes[b]], sizes[a : b + 1] - sizes[a])
            assert ids.tolist() == [i for e in own.encode_batch(texts[a:b], add_special_tokens=False) for i in [*e.ids, 0]]
    assert encoder.words > 6000
    assert len(sent) < encoder.words / 50


def test_words_are_merged_in_without_sorting_all_again(monkeypatch):
    encoder = packing.Encoder(tokenizer_path(TOKENIZER), 0)
    merged = []
    plain = packing._merged

    def counted(keys, values, more, of_more):
        merged.append(len(keys) + len(more))
        return plain(keys, values, more, of_more)

    monkeypatch.setattr(packing, "_merged", counted)
    for k in range(200):
        texts = [f" a{k * 50 + i}b" for i in range(50)]
        assert len(_encoded(encoder, texts)) == 50
    assert sum(merged) < 20 * encoder.words
    assert np.all(np.diff(encoder.known.astype(object)) > 0)


def test_packed_pieces_cover_every_id_once(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["alpha", "beta", "gamma"], k=rng.randrange(0, 3000))) for _ in range(60)] + [None, "", "same", "same"]
    docs = spark.createDataFrame([(i // 2, t, 3) for i, t in enumerate(texts)], "doc_id long, text string, offset long")
    rows = packing.pack_documents(docs, tokenizer=tokenizer_path(TOKENIZER), with_ids=True).collect()
    by_sequence, ids_of = {}, {}
    for r in rows:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        ids_of.setdefault(r.doc_id, []).append((r.start, r.ids, r.doc_tokens))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024 and (at == 1024 or at & (at - 1) == 0)
    encoder = packing.Encoder(tokenizer_path(TOKENIZER), 0)
    want = sorted(i for t in _encoded(encoder, texts) for i in t)
    assert sorted(i for parts in ids_of.values() for _, ids, _ in parts for i in ids) == want
    assert packing.pack_documents(docs.limit(0), tokenizer=tokenizer_path(TOKENIZER)).count() == 0


def test_a_piece_goes_where_the_sum_of_squares_is_least():
    rng = random.Random(3)
    packer = packing.Packer(20)
    for k in range(300):
        length = rng.randrange(1, 20)
        before = packer.levels.copy()

        def squares(level):
            after = before.copy()
            if level:
                after[level] -= 1
            if level + length < 20:
                after[level + length] += 1
            return int((after[1:20] ** 2).sum())

        packer.place([k], length)
        options = [0] + [h for h in range(1, 21 - length) if before[h]]
        assert int((packer.levels[1:20] ** 2).sum()) == min(map(squares, options))


def test_bpe_pieces_are_those_of_the_library():
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    own = sentencepiece.SentencePieceProcessor(model_file=path)
    table = pieces.Pieces.from_file(path, "bpe")
    texts = _odd_texts(1500) + ["", "x" * 300, "日本語" * 100, "      a     ", " ", "thering" * 40, "a" * 20_000]
    got = _encoded(table, texts)
    assert got == [own.encode(t) for t in texts]
    flat = np.array([i for ids in got for i in ids], np.int64)
    first = np.concatenate([[0], np.cumsum([len(x) for x in got])])
    assert table.decode(flat, first) == [own.decode(x) for x in got]


def test_unigram_path_is_the_best_one():
    rng = random.Random(4)
    names = ["▁", "a", "b", "c"] + sorted({"".join(rng.choices("▁abc", k=rng.randrange(2, 5))).lstrip("▁") for _ in range(25)} - {"", "a", "b", "c"})
    scores = [-rng.uniform(1, 9) for _ in names]
    table = pieces.Pieces(names, scores, -1, 0, "unigram")
    score = dict(zip(names, scores))

    def best(word):
        top = [0.0] + [-1e30] * len(word)
        for e in range(1, len(word) + 1):
            for k in range(1, min(4, e) + 1):
                piece = word[e - k : e]
                if piece in score:
                    top[e] = max(top[e], top[e - k] + score[piece])
        return top[-1]

    words = ["▁" + "".join(rng.choices("abc", k=rng.randrange(1, 12))) for _ in range(400)]
    for word, ids in zip(words, _encoded(table, [w[1:] for w in words])):
        assert "".join(names[i] for i in ids) == word
        assert abs(sum(scores[i] for i in ids) - best(word)) < 1e-9


def test_pieces_round_trip_in_spark(spark):
    model = tokenizer_path("piece_bpe_32k.model")
    docs = spark.createDataFrame([(1, "A text é", "q"), (1, "A text é", "q"), (None, None, "q"), (2, "", "q")], "doc_id long, text string, ids string")
    rows = pieces.encode_documents(docs, model=model, kind="bpe")
    assert all(r.decoded_equal for r in rows.collect())
    back = pieces.decode_documents(rows, model=model, kind="bpe").collect()
    assert sorted(r.text for r in back) == ["", "", "A text é", "A text é"]
    assert pieces.encode_documents(docs.limit(0), model=model, kind="bpe").count() == 0


PAGE = (
    '<html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head><body><nav><ul><li>Menu</ul></nav>'
    '<div class="ad">Buy</div><article><header><h1>Head &amp;\n line</h1></header><p><b>One<br>two<p>Three &lt;x&gt;<form>Mail</form>'
    '<div class="comments"><article>Troll</article></div></article><aside>Side</aside><footer>&copy; f</footer>'
)


def test_html_marks_settle_lines():
    lines = html_text.page_lines(PAGE)
    assert " ".join(t for t, z in lines if z == html_text.TEXT) == "Head & line One two Three <x>"
    assert html_text.page_lines("") == [] and html_text.page_lines("<") == [("<", html_text.OPEN)]
    assert html_text.page_lines("a <script>never closed") == [("a", html_text.OPEN)]
    assert html_text.page_lines("<p" + " x='" * 3000)  # unclosed quotes end in reasonable time


def test_html_names_around_the_article_do_not_empty_the_page():
    def text(page):
        return " ".join(t for t, z in html_text.page_lines(page) if z != html_text.DROP)

    for start, end in (
        ("<div class='layout has-sidebar'><article>", "</article></div>"), ("<main class='with-nav'>", "</main>"), ("<main class='search'>", "</main>"),
        ("<div id='search-page'><article>", "</article></div>"), ("<form class='search'><article>", "</article></form>"),
    ):
        assert text(f"<nav>Menu</nav>{start}<p>The story</p><div class='ad-slot'>Buy</div>{end}<footer>f</footer>") == "The story"
    assert text("<div>The story</div><div class='comments'><article>Troll</article></div>") == "The story"
    assert text("<article>The story</article><div class='comments'><article>Troll</article></div>") == "The story"


def test_html_raw_elements_end():
    for raw in ("<noscript><img>", "<svg><path>", "<object>", "<math><mi>x</mi>"):
        lines = html_text.page_lines(f"<article><p>One</p>{raw}<p>Two</p></article>")
        assert [t for t, z in lines if z == html_text.TEXT and t != "x"] == ["One", "Two"]
    assert html_text.page_lines("<article>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</article>") == [("so x=2 holds", html_text.TEXT)]
    assert html_text.page_lines("<svg>" * 30_000) == []


def test_common_lines_is_a_longest_common_subsequence():
    rng = random.Random(6)
    for _ in range(1500):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(12))] for _ in range(2))
        grid = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                grid[i + 1][j + 1] = grid[i][j] + 1 if x == y else max(grid[i][j + 1], grid[i + 1][j])
        common = html_text.common_lines(a, b)
        rest = iter(b)
        assert len(common) == grid[-1][-1] and all(a[i] in rest for i in common)


def test_html_differencing_by_nearest_url(spark):
    rows = [
        (i, f"http://h.example/{i // 10}/{i}.html", f"<body><div>Home About</div><div>story {i} here</div><p>more of {i}</p><div>Copyright Acme</div>")
        for i in range(40)
    ] + [(100, None, None), (101, "http://[bad", "<p>x &amp; y"), (102, "http://z/1", ""), (103, "http://h.example/marked", PAGE), (7, "http://h.example/0/7.html", "<p>story 7 here")]
    pages = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, key string")
    got = sorted((r.page_id, r.text) for r in html_text.extract_text(pages).collect())
    want = [(i, f"story {i} here more of {i}") for i in range(40)]
    want += [(100, ""), (101, "x & y"), (102, ""), (103, "Head & line One two Three <x>")]
    # the short second page 7 shares its only line with the first
    assert [g for g in got if g[0] != 7] == sorted(w for w in want if w[0] != 7)
    assert html_text.extract_text(pages.limit(0)).count() == 0


def test_html_pages_with_an_article_are_differenced_too(spark):
    def page(i):
        own = "".join(f"<p>story {i} line {j}</p>" for j in range(4))
        return f"<div>Home About</div><article>{own}<p>As ever.</p></article><div class=ad>Buy {i}</div><div>Copyright Acme</div>"

    rows = [(i, f"http://h.example/{i:02}.html", page(i)) for i in range(20)] + [(99, "http://other.example/", page(99))]
    pages = spark.createDataFrame(rows, "key long, url string, html string")
    found = html_text.shared_lines(pages).collect()
    shared = {r.key: r.shared for r in found}
    # menu, the line that articles share, footer; not the adverts, which are drawn for each page
    assert shared == {**{i: [0, 5, 7] for i in range(20)}, 99: []}
    # markup settles the lines of the article and the advert
    assert {r.key: r.gone for r in found} == {i: [] for i in [*range(20), 99]}
    got = {r.page_id: r.text for r in html_text.extract_text(pages.withColumnRenamed("key", "page_id")).collect()}
    assert got == {i: " ".join(f"story {i} line {j}" for j in range(4)) + " As ever." for i in [*range(20), 99]}


def test_fingerprints_of_edited_texts(spark):
    rng = random.Random(7)
    texts = [". ".join(" ".join(rng.choices(["red", "blue", "green", "é"], k=8)) for _ in range(rng.randrange(0, 40))) for _ in range(30)]
    rows = list(enumerate(texts)) + [(40, ""), (41, None), (42, "x"), (43, texts[0])]
    got = {r.doc_id: r for r in fingerprint_with_edits(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, units int")).collect()}
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
        assert (got[i].fingerprint == got[i].edited_fingerprint) == (edited == t)
    assert got[0].fingerprint == got[43].fingerprint and got[40].fingerprint == got[41].fingerprint
    long = [i for i, t in rows if t and len(t) > 500]
    assert np.mean([got[i].near_edited for i in long]) > np.mean([got[i].near_next for i in long]) + 0.2


def test_fingerprints_with_repeated_ids_and_no_rows(spark):
    rows = [(1, "a b. c"), (1, "a b. c"), (1, "other"), (None, "null id"), (2, "z")]
    got = fingerprint_with_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 5 and len({r.fingerprint for r in got}) == 4
    assert fingerprint_with_edits(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_fingerprints_add_and_subtract(spark):
    parts = spark.createDataFrame([("x", "one two. "), ("y", "three four.\nfive "), ("xy", "one two. three four.\nfive "), ("yx", "three four.\nfive one two. ")], "k string, text string")
    made = {r.k: r for r in fingerprints(parts, ["k"]).collect()}
    rows = spark.createDataFrame(
        [tuple((made[k].units, made[k].wide, made[k].lanes) for k in ("x", "y", "xy"))],
        ", ".join(f"{n} struct<units:long,wide:array<long>,lanes:array<int>>" for n in ("x", "y", "xy")),
    )
    total = rows.select(*combined("x", "y")).first()
    assert tuple(total) == (made["xy"].units, made["xy"].wide, made["xy"].lanes)
    assert tuple(rows.select(*combined("xy", "y", -1)).first()) == (made["x"].units, made["x"].wide, made["x"].lanes)
    assert rows.select(likeness("xy", "xy").alias("l")).first().l == 1.0


def test_likeness_of_texts_with_very_many_paragraphs(spark):
    texts = [(k, "\n".join(f"{k}{i}" for i in range(150_000))) for k in "xy"]
    texts.append(("z", texts[0][1][: len(texts[0][1]) // 2] + texts[1][1][: len(texts[1][1]) // 2]))
    made = {r.k: (r.units, r.wide, r.lanes) for r in fingerprints(spark.createDataFrame(texts, "k string, text string"), ["k"]).collect()}
    rows = spark.createDataFrame([tuple(made[k] for k in "xyz")], ", ".join(f"{n} struct<units:long,wide:array<long>,lanes:array<int>>" for n in "xyz"))
    xy, xz = rows.select(likeness("x", "y"), likeness("x", "z")).first()
    assert xy < 0.4 and abs(xz - 0.5) < 0.3


def test_paragraph_order_does_not_matter(spark):
    texts = [("a", "Alpha beta.\nGamma delta.\n"), ("b", "Gamma delta.\nAlpha beta.\n"), ("c", "Gamma delta.\nAlpha.\n")]
    made = {r.k: (r.units, r.wide, r.lanes) for r in fingerprints(spark.createDataFrame(texts, "k string, text string"), ["k"]).collect()}
    assert made["a"] == made["b"] != made["c"]


def test_license_rules_match_runs_in_order(spark):
    bsd = (
        "All rights reserved.\nRedistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:\nRedistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    )
    rows = [
        (1, "Text. Released under the MIT License. All rights reserved."), (2, None), (3, ""), (4, bsd), (5, "mit license mit license"),
        (6, "MIT License\nMIT License"), (None, "Licensed under the Apache License, Version 2.0."), (7, "Licensed under the Apache License!"),
    ]
    docs = spark.createDataFrame([(*r, 9) for r in rows] * 2, "doc_id long, text string, found int")
    got = licenses.scan_licenses(docs)
    assert got.count() == 16
    by = {r.doc_id: (r.identifiers, r.licenses, r.n_sentences) for r in got.collect()}
    assert by[1] == ("mit-name reserved", "MIT All-Rights-Reserved", 2)
    assert by[2] == by[3] == by[5] == by[7] == ("", "", 0)
    assert by[4][0] == "reserved bsd-grant bsd-source" and by[4][1] == "All-Rights-Reserved"
    assert by[6] == ("mit-name mit-name", "MIT", 2) and by[None][1] == "Apache-2.0"


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
BSD = """Copyright (c) 2020, Someone. All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
MPL = """// This Source Code Form is subject to the terms of the Mozilla Public
// License, v. 2.0. If a copy of the MPL was not distributed with this
// file, You can obtain one at https://mozilla.org/MPL/2.0/."""


def test_wrapped_licenses_are_found(spark):
    framed = "/" + "*" * 700 + "\r\n" + "".join(f" * {line:<900}*\r\n" for line in MIT.split("\n")) + " */"
    apart = MIT[: MIT.index("The above")].replace("in the Software", "\n\nin the Software")
    texts = [MIT, BSD, MPL, framed, MPL.replace("v. 2.0", "v. \n// 2.0"), "Old. " + MIT.replace("\n", " \n"), apart]
    rows = licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    by = {r.doc_id: (r.licenses, r.n_sentences) for r in rows}
    assert by[0] == by[3] == by[5] == ("MIT", 2)
    assert by[1] == ("BSD-2-Clause", 4)
    assert by[2] == by[4] == ("MPL-2.0", 1)
    assert by[6] == ("", 0)


def test_every_known_sentence_is_looked_up(spark):
    docs = spark.createDataFrame([(i, s.capitalize() + ".") for i, s in enumerate(licenses.SENTENCES)], "doc_id long, text string")
    assert {r.n_sentences for r in licenses.scan_licenses(docs).collect()} == {1}
    assert {i for run, _ in licenses.RULES for i in run.split()} <= set(licenses.SENTENCES.values())


@pytest.mark.parametrize("stage", range(5))
def test_pipeline_stage(spark, sf_dir, stage):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    name, run = corpus_pipeline.STAGES[stage]
    out = run(spark, docs, sf_dir)
    before = {r.doc_id: r for r in docs.collect()}
    if name == "packing":
        assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == set(before)
        return
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) == len({r.doc_id for r in rows}) <= len(before)
    if name == "line_dedup":
        assert len(rows) == len(before) and all(r.n_chars == len(r.text) for r in rows)
    else:
        assert all(r.text == before[r.doc_id].text for r in rows)
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {r.doc_id for r in rows}
    if name == "toxicity":
        clean = [i for i, r in labels.items() if not r.toxic]
        assert np.mean([i in kept for i in clean]) > 0.97
    if name == "quality_classifier":
        good = [i for i, r in labels.items() if r.quality]
        assert np.mean([i in kept for i in good]) > 0.97
    assert run(spark, docs.limit(0), sf_dir).count() == 0


def _names_by_rules(found):
    """Names of a list of identifiers: each rule in turn takes all its runs, which no later rule may use."""
    left, names = list(found), []
    for run, name in licenses.RULES:
        run, k = run.split(), 0
        while k + len(run) <= len(left):
            if left[k : k + len(run)] == run:
                left[k : k + len(run)] = [None]
                if name not in names:
                    names.append(name)
            k += 1
    return " ".join(names)


def test_planted_licenses_are_found_however_they_are_wrapped(spark):
    rng = random.Random(9)
    known, rows, wanted = list(licenses.SENTENCES), [], {}
    for doc in range(300):
        parts, found = [], []
        for _ in range(rng.randint(0, 7)):
            sentence = rng.choice(known) if rng.random() < 0.7 else "some filler words " * rng.randint(1, 30)
            if sentence in licenses.SENTENCES:
                found.append(licenses.SENTENCES[sentence])
            sentence = rng.choice([str, str.upper, str.capitalize])(sentence).strip()
            sign, end = rng.choice(["", "# ", " * ", "// "]), rng.choice(["", ".", ";"])
            parts.append("\n".join(sign + line for line in textwrap.wrap(sentence, rng.randint(12, 90), break_long_words=False)) + end)
        rows.append((doc, "\n\n".join(parts)))
        wanted[doc] = (" ".join(found), _names_by_rules(found), len(found))
    rows.append((300, "filler " * 400_000 + "\n" + known[0]))
    wanted[300] = (licenses.SENTENCES[known[0]], _names_by_rules([licenses.SENTENCES[known[0]]]), 1)
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.identifiers, r.licenses, r.n_sentences) for r in got} == wanted


def test_license_scan_of_an_empty_table(spark):
    assert licenses.scan_licenses(spark.createDataFrame([], "doc_id long, text string")).collect() == []
