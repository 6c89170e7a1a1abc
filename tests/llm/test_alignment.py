"""Alignment of two tokenizers against a plain loop over bytes."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from millrace.llm import alignment
from millrace.llm.queries import QUERIES, TOKENIZER, table, tokenizer_path

B = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def tokens():
    """The bytes and ids of a text under either tokenizer, as the libraries give them."""
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    own = Tokenizer.from_file(tokenizer_path(TOKENIZER))
    own.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(B))
    # what a character of the vocabulary stands for, asked of the library byte by byte
    letters = {}
    for code in [*range(0x80), *range(0x80, 0x800)]:
        shown = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(code))[0][0]
        letters.update(zip(shown, chr(code).encode(), strict=True))
    for lead in range(0xE1, 0xF0):
        shown = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(bytes([lead, 0x80 | 0x01, 0x81]).decode())[0][0]
        letters.update(zip(shown, [lead, 0x81, 0x81], strict=True))
    for code in (0x800, 0x10000, 0x40000, 0x80000, 0xC0000, 0x100000):
        shown = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(code))[0][0]
        letters.update(zip(shown, chr(code).encode(), strict=True))

    def both(text):
        a = [(i, bytes(letters[c] for c in own.id_to_token(i))) for i in own.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in model.encode(text):
            piece = model.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()))
        want = (" " + text).encode()
        return (a, b) if text and b"".join(r for _, r in a) == want == b"".join(r for _, r in b) else ([], [])

    return both


def _brute(rows, tokens):
    plain, counts = [], Counter()
    for doc, text in rows:
        a, b = tokens(text or "")
        spans = []
        for side in (a, b):
            at, out = 0, []
            for i, raw in side:
                out.append((at, at + len(raw), i))
                at += len(raw)
            spans.append(out)
        links, j = [], 0
        for s, e, i in spans[0]:
            while j < len(spans[1]) and spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < e:
                links.append((i, spans[1][k][2]))
                k += 1
        counts.update(links)
        shared = sorted({x[1] for x in spans[0]} & {x[1] for x in spans[1]})
        groups, low = [], 0
        for end in shared:
            groups.append("|".join(",".join(str(i) for s, e, i in side if low <= s < end) for side in spans) if len(shared) < 300 else None)
            low = end
        plain.append((doc, a, b, links, shared, groups))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for doc, a, b, links, shared, groups in plain:
        said = ";".join(groups) if None not in groups else None
        digest = None if said is None else hashlib.sha256(said.encode()).hexdigest() if said else ""
        out.append((doc, len(a), len(b), len(shared), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), digest))
    return out


def _same(rows, want):
    got = [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in rows]
    key = lambda r: (r[0] is not None, *(x if x is not None else "" for x in r[:7]))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:7] == w[:7] and (w[7] is None or g[7] == w[7])


ODD = [None, "", " ", "  ", "\n", "a", "it's  two\n\nlines\t", "<|endoftext|> and <s>", "▁marked", "日本語の文章です。", "naïve café", "\U0001F600 smile", "a\u0000b", "x" * 3000, "é", "ﬁ", "　wide", "<0x41>"]


def test_alignment_equals_brute_force(spark, tokens):
    rng = random.Random(1)
    words = ["the", "thing", "straße", "日本", "it's", "Überraschung", "1234567", "—", "foo_bar", "\n", "ciónción", "  "]
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, "no id"), (3, "same"), (3, "same")]
    rows += [(100 + k, " ".join(rng.choices(words, k=rng.randrange(0, 60)))) for k in range(120)]
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, n_a int, block string").repartition(4)
    got = alignment.align_tokenizers(docs, a=tokenizer_path(TOKENIZER), b=tokenizer_path(B)).collect()
    _same(got, _brute(rows, tokens))


def test_blocks_and_forgotten_windows_change_nothing(spark, tokens, monkeypatch):
    rows = [(k, f"word{k % 7} and more word{k % 5} text") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    run = alignment._first_pass(tokenizer_path(TOKENIZER), tokenizer_path(B), True)
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 100)
    monkeypatch.setattr(alignment.kernels, "SLICE_BYTES", 64)
    from pyspark import TaskContext

    class Task:
        def partitionId(self):
            return 0

    monkeypatch.setattr(TaskContext, "get", staticmethod(lambda: Task()))
    out = [r for b in run(iter([docs.toArrow().to_batches()[0]])) for r in b.to_pylist()]
    assert len({r["block"] for r in out}) > 10
    pairs = Counter()
    for r in out:
        if r["pairs"] is not None:
            pairs.update(dict(zip(r["pairs"], r["pair_n"], strict=True)))
    want = Counter()
    for _, text in rows:
        a, b = tokens(text)
        ends = lambda side: [sum(len(r) for _, r in side[: k + 1]) for k in range(len(side))]
        for e in sorted(set(ends(a)) | set(ends(b))):
            want[(a[next(k for k, x in enumerate(ends(a)) if x >= e)][0] << 32) | b[next(k for k, x in enumerate(ends(b)) if x >= e)][0]] += 1
    assert pairs == want


def test_query_on_whole_documents(spark, sf_dir, tokens):
    rows = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    _same(QUERIES["op11_tokenizer_alignment"](spark, sf_dir).collect(), _brute(rows, tokens))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align_tokenizers(docs, a=tokenizer_path(TOKENIZER), b=tokenizer_path(B)).count() == 0
