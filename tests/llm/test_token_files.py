"""Directly addressable codes: round trips, widths against all choices, random access, and the query's rows."""

from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import token_files
from millrace.llm.queries import QUERIES, TOKENIZER, table, tokenizer_path


def _file(ids, cuts=()):
    starts = np.array([0, *cuts, len(ids)], np.int64)
    keys = np.arange(len(starts) - 1)
    data = token_files.encode_file(np.array(ids, np.uint32), starts, keys, keys % 3 != 1)
    return token_files.TokenFile(pa.BufferReader(data))


@pytest.mark.parametrize("ids", [[], [0], [0, 0, 0], [2**32 - 1], [1, 2**31, 0, 255, 256, 65_535, 65_536] * 400])
def test_ids_come_back(ids):
    held = _file(ids)
    assert held.ids(0, len(ids)).tolist() == ids
    assert [held.id_at(k) for k in range(min(len(ids), 50))] == ids[:50]
    with pytest.raises(IndexError):
        held.ids(0, len(ids) + 1)


def test_ranges_and_single_ids_at_all_places():
    rng = random.Random(1)
    ids = [rng.getrandbits(rng.choice([1, 3, 8, 9, 16])) for _ in range(5_000)]
    held = _file(ids, cuts=[10, 10, 4_000])
    for _ in range(400):
        a = rng.randrange(len(ids) + 1)
        b = rng.randrange(a, min(len(ids), a + 700) + 1)
        assert held.ids(a, b).tolist() == ids[a:b]
    assert [held.id_at(k) for k in range(len(ids))] == ids
    keys, starts = held.documents(0, 4)
    assert keys == [0, None, 2, 3] and starts.tolist() == [0, 10, 10, 4_000, 5_000]


def test_one_id_takes_a_few_bytes_whatever_the_file():
    rng = np.random.default_rng(2)
    held = _file(rng.integers(0, 50_257, 300_000))
    held.bytes_read = 0
    held.id_at(200_000)
    assert held.bytes_read <= 100 * len(held.header["levels"])


def test_widths_are_the_smallest_of_all():
    rng = random.Random(3)
    for _ in range(30):
        top = rng.randrange(1, 9)
        histogram = np.zeros(33, np.int64)
        histogram[1 : top + 1] = [rng.randrange(0, 1000) for _ in range(top)]
        histogram[top] += 1

        def bits(widths):
            at, total = 0, 0.0
            for k, w in enumerate(widths):
                n = histogram.sum() if at == 0 else histogram[at + 1 :].sum()
                total += n * w + (n * (1 + 32 / 512) if k + 1 < len(widths) else 0)
                at += w
            return total

        cuts = [c for r in range(top) for c in itertools.combinations(range(1, top), r)]
        every = [np.diff([0, *c, top]).tolist() for c in cuts]
        assert bits(token_files.chunk_widths(histogram)) == pytest.approx(min(map(bits, every)))


def _wanted(rows, end_id):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer_path(TOKENIZER))
    out = []
    for key, text in rows:
        ids = own.encode(text or "", add_special_tokens=False).ids + [end_id]
        out.append((key, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return out


def test_query_equals_the_tokenizer(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "text").orderBy("doc_id").collect()
    got = QUERIES["op13_token_files"](spark, sf_dir).orderBy("doc_id").collect()
    wanted = _wanted(rows, 2)
    assert [(r.doc_id, r.n_tokens, r.ids_crc32) for r in got] == wanted
    assert [r.start for r in got] == [sum(w[1] for w in wanted[:k]) for k in range(len(wanted))]


def test_odd_rows_many_files_and_single_ids(spark, tmp_path):
    rng = random.Random(5)
    texts = [" ".join(rng.choices(["alpha", "béta", "γ", "<|endoftext|>"], k=rng.randrange(0, 40))) for _ in range(200)]
    rows = [(rng.randrange(-20, 60), t, "x") for t in texts] + [(7, "same", "y")] * 300 + [(None, "no id", "z"), (8, None, ""), (9, "", ""), (8, None, "")]
    rows.append((3, "long " * 60_000, ""))
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(5)
    files = token_files.write_token_files(
        docs, tokenizer=tokenizer_path(TOKENIZER), end_id=2, path=str(tmp_path / "ids"), file_ids=500, partition_bytes=10_000
    )
    got = sorted(token_files.read_token_files(files, with_ids=True).collect(), key=lambda r: r.start)
    assert files.count() > 20
    keys = [r.doc_id for r in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0)) and keys[0] is None
    assert all(a.start + a.n_tokens == b.start for a, b in itertools.pairwise(got)) and got[0].start == 0
    order = lambda x: (x[0] is not None, x)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=order) == sorted(_wanted([r[:2] for r in rows], 2), key=order)
    whole = [i for r in got for i in r.ids]
    places = [rng.randrange(len(whole)) for _ in range(200)] + [0, len(whole) - 1]
    wanted = spark.createDataFrame([(p,) for p in [*places, -1, len(whole), None]], "position long")
    read = token_files.ids_at(files, wanted, step=700).collect()
    assert sorted((r.position, r.id) for r in read) == sorted((p, whole[p]) for p in places)


def test_empty_table_has_no_files(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    files = token_files.write_token_files(docs, tokenizer=tokenizer_path(TOKENIZER), end_id=2)
    assert files.count() == 0 and token_files.read_token_files(files).count() == 0
