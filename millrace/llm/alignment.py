"""Alignment of two tokenizers' ids over the same texts.

Both tokenise the whole text first. Where a token of either ends at the same
byte and the next token of both begins with a space, the text is cut into
windows, mostly words. A window is a tuple of ids of the one and a tuple of ids
of the other; its alignment is worked out once and kept under those tuples, by
hash. All new windows of a slice are aligned together: a token of A and one of B
overlap in exactly one of the pieces into which all ends cut the text, so the
pieces are the links, and the shared ends are the groups.

Two passes give what the corpus knows to the documents. The first tokenises and
writes, for each block of texts, its distinct windows with their links once, and
per document the numbers of its windows. The links' counts are summed over the
blocks by pair. The second brings each block its pairs' sums, from which windows
and then documents take theirs. So a row moves per distinct pair of a block, and
no text is tokenised twice.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm import kernels
from millrace.llm.packing import Encoder
from millrace.llm.store import written

# A block ends with the text at which it has so many bytes, or its windows so many links.
BLOCK_BYTES = 32 << 20
BLOCK_LINKS = 4 << 20
_SPACE = 0x20
_B_BITS = 32


def _byte_alphabet() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable ones themselves, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class _Bytes:
    """The bytes of every token of a vocabulary."""

    def __init__(self, raw: list[bytes]):
        self.count = np.fromiter(map(len, raw), np.int64, len(raw))
        self.start = np.concatenate([[0], np.cumsum(self.count)])[:-1].astype(np.int64)
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        self.spaced = np.fromiter((r[:1] == b" " for r in raw), bool, len(raw))

    def joined(self, ids: np.ndarray) -> np.ndarray:
        count = self.count[ids]
        before = np.cumsum(count) - count
        return self.data[np.repeat(self.start[ids] - before, count) + np.arange(int(count.sum()))]


class Aligner:
    """Tokenises texts twice and aligns the ids; holds the windows of one block."""

    def __init__(self, a: str, b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece

        self.a = Encoder(a, None, plain=True)
        alphabet = _byte_alphabet()
        vocabulary = self.a.tokenizer.get_vocab(with_added_tokens=True)
        raw = [b""] * (max(vocabulary.values()) + 1)
        for text, k in vocabulary.items():
            raw[k] = bytes(alphabet[c] for c in text) if all(c in alphabet for c in text) else text.encode()
        self.a_bytes = _Bytes(raw)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        raw = []
        for k in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(k)
            special = self.b.is_control(k) or self.b.is_unknown(k) or self.b.is_unused(k)
            raw.append(bytes([int(piece[3:-1], 16)]) if self.b.is_byte(k) else b"" if special else piece.replace("▁", " ").encode())
        self.b_bytes = _Bytes(raw)
        self.forget()

    def forget(self) -> None:
        """Start a block anew."""
        self.known = np.zeros(0, np.uint64)  # sorted hashes of id tuples
        self.number = np.zeros(0, np.int64)
        self.texts: list[str] = []  # the groups of a window
        self.groups: list[np.ndarray] = []
        self.links: list[np.ndarray] = []  # a << _B_BITS | b
        self.n_links: list[np.ndarray] = []
        self.used: list[np.ndarray] = []
        self.held_links = self.n_groups_known = 0

    def tokenised(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and of B and how many each text has, and which texts have any: those both give back unchanged."""
        spaced = [" " + t if t else "" for t in texts]
        column = pa.array(spaced, pa.large_string()).cast(pa.large_binary())
        raw = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
        offsets = np.frombuffer(column.buffers()[1], np.int64)[: len(texts) + 1]
        a_ids, first = self.a.encode(raw[: offsets[-1]], offsets)
        a_ids, a_count = a_ids.astype(np.int64), np.diff(first)
        lists = self.b.encode(texts, num_threads=1) if texts else []
        b_count = np.fromiter(map(len, lists), np.int64, len(lists))
        b_ids = np.concatenate([np.array(x, np.int64) for x in lists]) if len(lists) else np.zeros(0, np.int64)
        good = np.array([bool(t) for t in texts], bool)
        for ids, count, table in ((a_ids, a_count, self.a_bytes), (b_ids, b_count, self.b_bytes)):
            joined = table.joined(ids)
            size = np.concatenate([[0], np.cumsum(table.count[ids])])
            ends = size[np.concatenate([[0], np.cumsum(count)])]
            good &= np.diff(ends) == np.diff(offsets)
            for k in np.flatnonzero(good):
                good[k] = joined[ends[k] : ends[k + 1]].tobytes() == raw[offsets[k] : offsets[k + 1]].tobytes()
        a_ids, b_ids = a_ids[np.repeat(good, a_count)], b_ids[np.repeat(good, b_count)]
        return a_ids, np.where(good, a_count, 0), b_ids, np.where(good, b_count, 0), good

    def windows(self, a_ids: np.ndarray, b_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where windows end: after so many tokens of A, of B, and bytes."""
        a_end, b_end = np.cumsum(self.a_bytes.count[a_ids]), np.cumsum(self.b_bytes.count[b_ids])
        # a text begins with a space, so its first token is marked and every text's end is an anchor
        a_at = np.flatnonzero(np.append(self.a_bytes.spaced[a_ids[1:]], True))
        b_at = np.flatnonzero(np.append(self.b_bytes.spaced[b_ids[1:]], True))
        place = np.searchsorted(b_end[b_at], a_end[a_at])
        shared = b_end[b_at][np.minimum(place, len(b_at) - 1)] == a_end[a_at]
        return a_at[shared] + 1, b_at[place[shared]] + 1, a_end[a_at[shared]]

    @staticmethod
    def _hashes(ids: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        power = kernels._power_table(kernels._R, len(ids) + 1, "up")
        back = kernels._power_table(kernels._R_INV, len(ids) + 1, "down")
        total = np.zeros(len(ids) + 1, np.uint64)
        np.cumsum(kernels.mix(ids.astype(np.uint64) + np.uint64(1)) * power[: len(ids)], out=total[1:])
        return kernels.mix((total[end] - total[start]) * back[start] + (end - start).astype(np.uint64))

    def numbered(self, a_ids: np.ndarray, b_ids: np.ndarray, a_end: np.ndarray, b_end: np.ndarray) -> np.ndarray:
        """The number in the block of every window; windows not seen yet are aligned."""
        a_start, b_start = np.concatenate([[0], a_end[:-1]]), np.concatenate([[0], b_end[:-1]])
        hashes = kernels.mix(self._hashes(a_ids, a_start, a_end) * kernels._R + self._hashes(b_ids, b_start, b_end))
        unique, example, which, times = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
        new = np.ones(len(unique), bool)
        if len(self.known):
            at = np.searchsorted(self.known, unique)
            at[at == len(self.known)] = 0
            new = self.known[at] != unique
        if new.any():
            at = example[new]
            numbers = len(self.texts) + np.arange(len(at))
            self._align(a_ids, a_start[at], a_end[at], b_ids, b_start[at], b_end[at])
            known = np.concatenate([self.known, unique[new]])
            order = np.argsort(known)
            self.known, self.number = known[order], np.concatenate([self.number, numbers])[order]
        numbers = self.number[np.searchsorted(self.known, unique)]
        self.used.append(np.stack([numbers, times]))
        return numbers[which]

    def _align(self, a_ids, a_start, a_end, b_ids, b_start, b_end) -> None:
        """Links and groups of windows, all at once."""

        def gathered(ids, start, end):
            n = end - start
            before = np.cumsum(n) - n
            return ids[np.repeat(start - before, n) + np.arange(int(n.sum()))], np.cumsum(n)

        a, a_cut = gathered(a_ids, a_start, a_end)
        b, b_cut = gathered(b_ids, b_start, b_end)
        a_at, b_at = np.cumsum(self.a_bytes.count[a]), np.cumsum(self.b_bytes.count[b])
        ends = np.union1d(a_at, b_at)
        window_end = a_at[a_cut - 1]
        links = (a[np.searchsorted(a_at, ends)] << _B_BITS) | b[np.searchsorted(b_at, ends)]
        n_links = np.diff(np.searchsorted(ends, window_end, side="right"), prepend=0)
        shared = a_at[np.isin(a_at, b_at, assume_unique=True)]
        n_groups = np.diff(np.searchsorted(shared, window_end, side="right"), prepend=0)
        a_stop, b_stop = np.searchsorted(a_at, shared, side="right").tolist(), np.searchsorted(b_at, shared, side="right").tolist()
        a_text, b_text = list(map(str, a.tolist())), list(map(str, b.tolist()))
        groups, i, j = [], 0, 0
        for x, y in zip(a_stop, b_stop, strict=True):
            groups.append(f"{a_text[i] if x == i + 1 else ','.join(a_text[i:x])}|{b_text[j] if y == j + 1 else ','.join(b_text[j:y])}")
            i, j = x, y
        at = 0
        for n in n_groups.tolist():
            self.texts.append(groups[at] if n == 1 else ";".join(groups[at : at + n]))
            at += n
        self.groups.append(n_groups)
        self.links.append(links)
        self.n_links.append(n_links)
        self.held_links += len(links)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The block's distinct pairs and how many links each has; per window its number of links, and each link's pair."""
        none = np.zeros(0, np.int64)
        links, n_links = np.concatenate([none, *self.links]), np.concatenate([none, *self.n_links])
        times = np.zeros(len(n_links), np.int64)
        for numbers, n in self.used:
            times[numbers] += n
        pairs, of = np.unique(links, return_inverse=True)
        n = np.zeros(len(pairs), np.int64)
        np.add.at(n, of, np.repeat(times, n_links))
        return pairs, n, n_links, of


_DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_ROWS = f"block long, {_DOC}, groups string, windows binary, pairs array<long>, pair_n array<long>, window_links binary, link_pairs binary"


def _types(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in schema.split(", "))])


def _first_pass(a: str, b: str, with_groups: bool):
    """Rows of documents, and one row for each block."""
    schema = _types(_ROWS)

    def rows(columns: dict, n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner = Aligner(a, b)
        block = TaskContext.get().partitionId() << 33
        filled = 0

        def close() -> pa.RecordBatch:
            pairs, n, n_links, of = aligner.pairs()
            one = {
                "block": [block], "pairs": [pairs], "pair_n": [n], "window_links": [n_links.astype("<u4").tobytes()],
                "link_pairs": [of.astype("<u4").tobytes()],
            }
            aligner.forget()
            return rows(one, 1)

        for batch in batches:
            for row, data, offsets in kernels.slices(batch.column("text")):
                whole = data.tobytes()
                texts = [whole[x:y].decode() for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                n = len(texts)
                a_ids, n_a, b_ids, n_b, good = aligner.tokenised(texts)
                numbers = cuts = np.zeros(0, np.int64)
                n_groups, n_windows = np.zeros(n, np.int64), np.zeros(n + 1, np.int64)
                if len(a_ids):
                    a_end, b_end, _ = aligner.windows(a_ids, b_ids)
                    numbers = aligner.numbered(a_ids, b_ids, a_end, b_end)
                    n_windows[1:] = np.searchsorted(a_end, np.cumsum(n_a), side="right")
                    groups = np.concatenate(aligner.groups)[numbers]
                    cuts = np.concatenate([[0], np.cumsum(groups)])[n_windows]
                    n_groups = np.diff(cuts)
                said, held = [], []
                for k in range(n):
                    mine = numbers[n_windows[k] : n_windows[k + 1]]
                    said.append(";".join(map(aligner.texts.__getitem__, mine.tolist())))
                    held.append(mine.astype("<u4").tobytes())
                columns = {
                    "block": np.full(n, block), "doc_id": batch.column("doc_id")[row : row + n], "n_a": n_a, "n_b": n_b, "n_groups": n_groups,
                    "n_links": np.where(good, n_a + n_b - n_groups, 0),
                    "groups_sha256": [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in said], "windows": held,
                }
                if with_groups:
                    columns["groups"] = said
                yield rows(columns, n)
                filled += len(data)
                if filled >= BLOCK_BYTES or aligner.held_links >= BLOCK_LINKS:
                    yield close()
                    block, filled = block + 1, 0
        yield close()

    return run


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, count, best): the links of every id pair over all blocks; best says whether no pair of its B id has more."""
    each = blocks.filter("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "pair_n")).alias("p"))
    counts = written(each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.pair_n").alias("count")), "align-counts")
    of_b = F.col("pair").bitwiseAND(F.lit((1 << _B_BITS) - 1))
    top = counts.groupBy(of_b.alias("b")).agg(F.max("count").alias("top"))  # a row for each id of B's vocabulary at most
    return counts.withColumn("of", of_b).join(F.broadcast(top), F.col("of") == F.col("b")).select("pair", "count", (F.col("count") == F.col("top")).alias("best"))


def _second_pass(schema: pa.Schema):
    def run(rows: pa.Table, sums: pa.Table) -> pa.Table:
        place = sums.column("place").to_numpy()
        count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        count[place] = sums.column("count").to_numpy()
        best[place] = sums.column("best").to_numpy(zero_copy_only=False)
        is_block = rows.column("pairs").is_valid()
        block, docs = rows.filter(is_block), rows.filter(pa.compute.invert(is_block))
        cut = np.concatenate([[0], np.cumsum(np.frombuffer(block.column("window_links")[0].as_py(), "<u4"), dtype=np.int64)])
        of = np.frombuffer(block.column("link_pairs")[0].as_py(), "<u4")
        held = [np.frombuffer(x.as_buffer(), "<u4") for x in docs.column("windows")]
        first = np.concatenate([[0], np.cumsum([len(x) for x in held])]).astype(np.int64)
        windows = np.concatenate([np.zeros(0, np.uint32), *held])
        out = {}
        for name, values in (("n_best", best), ("count_sum", count)):
            by_window = np.diff(np.concatenate([[0], np.cumsum(values[of])])[cut])
            out[name] = np.diff(np.concatenate([[0], np.cumsum(by_window[windows])])[first]).astype(np.int64)
        columns = [pa.array(out[f.name], f.type) if f.name in out else docs.column(f.name).cast(f.type) for f in schema]
        return pa.Table.from_arrays(columns, schema=schema)

    return run


def align_tokenizers(
    docs: DataFrame, *, a: str, b: str, id_column: str = "doc_id", text_column: str = "text", with_groups: bool = False
) -> DataFrame:
    """One row per input row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, and the groups if asked.

    `a` is a byte-level BPE file of the tokenizers library, `b` a SentencePiece
    model that puts a space before a text; A gets that space too. Special
    tokens' strings are plain text. A null or empty text, and one that either
    does not give back unchanged, has no tokens: zeros and an empty digest.
    Repeated rows each keep a row and count each time; null ids are kept. Other
    columns are not read. An empty table gives an empty result.
    """
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    rows = written(docs.mapInArrow(_first_pass(a, b, with_groups), _ROWS), "align-rows")
    counts = pair_counts(rows)
    places = rows.filter("pairs IS NOT NULL").select(F.col("block").alias("of_block"), F.posexplode("pairs").alias("place", "of"))
    sums = places.join(counts, F.col("of") == F.col("pair")).select("of_block", "place", "count", "best")
    out = f"{_DOC}, n_best long, count_sum long" + (", groups string" if with_groups else "")
    kept = ["block", *(f.split()[0] for f in _DOC.split(", ")), "windows", "pairs", "window_links", "link_pairs", *(["groups"] if with_groups else [])]
    both = rows.select(*kept).groupBy("block").cogroup(sums.groupBy("of_block"))
    return both.applyInArrow(_second_pass(_types(out)), out).withColumnRenamed("doc_id", id_column)
