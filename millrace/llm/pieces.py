"""SentencePiece encoding and decoding in NumPy batches.

Words, each with the white space before it, are encoded once per batch. Words of
equal length advance together. The hashes of all their substrings up to the
longest piece probe the sorted hashes of the pieces, which gives every span its
piece, if it is one. On that lattice

- a unigram model takes the best path: at each end position the maximum over
  piece lengths, with the length as backpointer (Viterbi);
- a merge (BPE) model joins, in all words at once, the neighbouring pair whose
  joined piece has the best score, until none is left. Its scores are merge
  ranks and no path weights: the best path through them is another
  segmentation than the model's.

Characters that no piece has become byte pieces.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm import kernels

_BLANK = 0x2581
# Longer words go one by one, by a queue of pairs: cost in proportion to n log n.
_LONG = 48
_KEPT = 300_000
_NONE = np.int32(2**31 - 1)


def _prefix_hashes(points: np.ndarray) -> np.ndarray:
    power = kernels._power_table(kernels._R, points.shape[1] + 1, "up")
    total = np.zeros((points.shape[0], points.shape[1] + 1), np.uint64)
    np.cumsum(kernels.mix(points.astype(np.uint64) + np.uint64(1)) * power[: points.shape[1]], axis=1, out=total[:, 1:])
    return total


def _span_hashes(total: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all substrings of a length, by row and start."""
    back = kernels._power_table(kernels._R_INV, total.shape[1] + 1, "down")
    n = total.shape[1] - size
    return kernels.mix((total[:, size:] - total[:, :-size]) * back[:n] + np.uint64(size))


class Pieces:
    """A piece table: texts, scores, and byte pieces."""

    def __init__(self, texts: list[str], scores: list[float], first_byte: int, unknown: int, kind: str, special: set[int] = frozenset()):
        if kind not in ("unigram", "bpe"):
            raise ValueError(f"unknown kind of model: {kind}")
        self.kind, self.first_byte, self.unknown, self.special = kind, first_byte, unknown, special
        self.texts = texts
        ids = [i for i in range(len(texts)) if i not in special and not first_byte <= i < first_byte + 256] if first_byte >= 0 else [
            i for i in range(len(texts)) if i not in special
        ]
        self.longest = max((len(texts[i]) for i in ids), default=1)
        keys = np.zeros(len(ids), np.uint64)
        by_size: dict[int, list[int]] = {}
        for k, i in enumerate(ids):
            by_size.setdefault(len(texts[i]), []).append(k)
        for size, ks in by_size.items():
            points = np.array([[ord(c) for c in texts[ids[k]]] for k in ks], np.uint32)
            keys[ks] = _span_hashes(_prefix_hashes(points), size)[:, 0]
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ids = np.array(ids, np.int64)[order]
        self.scores = np.array([scores[i] for i in ids], np.float64)[order]
        # equal scores have equal rank
        levels = np.unique(-self.scores)
        self.rank = np.searchsorted(levels, -self.scores).astype(np.int32)
        self.floor = float(self.scores.min(initial=0.0)) - 10.0
        raw = [t.replace("▁", " ").encode() for t in texts]
        for i in special:
            raw[i] = b""
        for b in range(256 if first_byte >= 0 else 0):
            raw[first_byte + b] = bytes([b])
        self.raw_count = np.fromiter(map(len, raw), np.int64, len(raw))
        self.raw_start = np.concatenate([[0], np.cumsum(self.raw_count)])[:-1]
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self._forget()

    @classmethod
    def from_file(cls, path: str, kind: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        special = {i for i in range(n) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        first = next((i for i in range(n) if model.is_byte(i)), -1)
        return cls([model.id_to_piece(i) for i in range(n)], [model.get_score(i) for i in range(n)], first, model.unk_id(), kind, special)

    # ---- encoding

    def _lattice(self, points: np.ndarray) -> np.ndarray:
        """Index into the sorted pieces by word, start and length - 1; -1 where a span is no piece."""
        n, size = points.shape
        total = _prefix_hashes(points)
        out = np.full((n, size, min(self.longest, size)), -1, np.int32)
        for k in range(1, out.shape[2] + 1):
            hashes = _span_hashes(total, k)
            at = np.searchsorted(self.keys, hashes)
            at[at == len(self.keys)] = 0
            out[:, : size - k + 1, k - 1] = np.where(self.keys[at] == hashes, at, -1)
        return out

    def _best_path(self, lattice: np.ndarray) -> np.ndarray:
        """Where pieces start, by word: Viterbi; a character that is no piece costs more than any."""
        n, size, longest = lattice.shape
        best = np.full((n, size + 1), -np.inf)
        best[:, 0] = 0
        back = np.zeros((n, size + 1), np.int32)
        for end in range(1, size + 1):
            k = np.arange(1, min(longest, end) + 1)
            spans = lattice[:, end - k, k - 1]
            score = np.where(spans >= 0, self.scores[spans], -np.inf)
            score[:, 0] = np.where(spans[:, 0] >= 0, score[:, 0], self.floor)
            score += best[:, end - k]
            pick = np.argmax(score, axis=1)
            best[:, end] = score[np.arange(n), pick]
            back[:, end] = pick + 1
        starts = np.zeros((n, size + 1), bool)
        at = np.full(n, size)
        rows = np.arange(n)
        while (going := at > 0).any():
            at = np.where(going, at - back[rows, at], 0)
            starts[rows[going], at[going]] = True
        return starts[:, :size]

    def _merged(self, lattice: np.ndarray) -> np.ndarray:
        """Where pieces start, by word, after all merges."""
        n, size, longest = lattice.shape
        starts = np.ones((n, size), bool)
        rank = np.where(lattice >= 0, self.rank[lattice], _NONE)
        active = np.arange(n)
        where = np.arange(size)
        end = np.tile(np.arange(1, size + 1), (n, 1))  # end of the piece that starts here
        while len(active):
            e = end[active]
            after = np.where(e < size, np.take_along_axis(e, np.minimum(e, size - 1), axis=1), 0)  # end of the next piece
            span = after - where
            fits = starts[active] & (e < size) & (span <= longest)
            cost = np.where(fits, np.take_along_axis(rank[active], np.clip(span - 1, 0, longest - 1)[:, :, None], axis=2)[:, :, 0], _NONE)
            pick = np.argmin(cost, axis=1)
            rows = np.arange(len(active))
            more = cost[rows, pick] < _NONE
            rows, pick = rows[more], pick[more]
            active, e, after = active[more], e[more], after[more]
            rows = np.arange(len(active))
            starts[active, e[rows, pick]] = False
            end[active, pick] = after[rows, pick]
        return starts

    def _merged_long(self, points: np.ndarray) -> np.ndarray:
        """The same for one long word, by a queue of pairs."""
        lattice = self._lattice(points[None, :])[0]
        size, longest = lattice.shape
        end = list(range(1, size + 1))
        prev = list(range(-1, size - 1))
        alive = [True] * size

        def rank(i: int, stop: int) -> int | None:
            k = lattice[i, stop - i - 1] if stop - i <= longest else -1
            return int(self.rank[k]) if k >= 0 else None

        queue = [(r, i, i + 2) for i in range(size - 1) if (r := rank(i, i + 2)) is not None]
        heapq.heapify(queue)
        while queue:
            _, i, stop = heapq.heappop(queue)
            if not alive[i] or end[i] >= size:
                continue
            j = end[i]
            if end[j] != stop or not alive[j]:
                continue
            alive[j] = False
            end[i] = stop
            if stop < size:
                prev[stop] = i
                if (r := rank(i, end[stop])) is not None:
                    heapq.heappush(queue, (r, i, end[stop]))
            if prev[i] >= 0 and (r := rank(prev[i], stop)) is not None:
                heapq.heappush(queue, (r, prev[i], stop))
        return np.array(alive)

    def _ids_of(self, points: np.ndarray, starts: np.ndarray, lattice: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words end to end, and how many each has."""
        n, width = points.shape
        row, at = np.nonzero(starts)
        ends = np.append(at[1:], width)
        ends[np.append(row[1:] != row[:-1], True)] = width
        spans = lattice[row, at, np.minimum(ends - at, lattice.shape[2]) - 1]
        ids = self.ids[np.maximum(spans, 0)]
        missing = np.flatnonzero(spans < 0)
        if not len(missing):
            return ids, np.bincount(row, minlength=n)
        count = np.ones(len(ids), np.int64)
        raw = {}
        for k in missing.tolist():
            raw[k] = [self.first_byte + b for b in chr(int(points[row[k], at[k]])).encode("utf-8", "replace")] if self.first_byte >= 0 else [self.unknown]
            count[k] = len(raw[k])
        first = np.cumsum(count) - count
        out = np.repeat(ids, count)
        for k, values in raw.items():
            out[first[k] : first[k] + len(values)] = values
        return out, np.bincount(row, count, n).astype(np.int64)

    def encode_words(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the words points[starts:ends]: a pool of ids, and where and how many each word has there.

        The blank sign stands for spaces.
        """
        size_of = ends - starts
        first, count = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        pool, filled = [np.zeros(0, np.int64)], 0
        order = np.argsort(size_of, kind="stable")
        cuts = np.flatnonzero(np.diff(size_of[order])) + 1
        for ks in np.split(order, cuts):
            size = int(size_of[ks[0]]) if len(ks) else 0
            if size == 0:
                continue
            step = max(1, (1 << 21) // (size * min(size, self.longest)))
            for lo in range(0, len(ks), step):
                part = ks[lo : lo + step]
                words = points[starts[part][:, None] + np.arange(size)]
                lattice = self._lattice(words)
                if self.kind == "unigram":
                    cut = self._best_path(lattice)
                elif size > _LONG:
                    cut = np.stack([self._merged_long(w) for w in words])
                else:
                    cut = self._merged(lattice)
                ids, n = self._ids_of(words, cut, lattice)
                pool.append(ids)
                count[part] = n
                first[part] = filled + np.cumsum(n) - n
                filled += len(ids)
        return np.concatenate(pool), first, count

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int32)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice, and where each text's begin.

        A text that is not empty gets a blank before it; blanks are the blank sign.
        """
        text = data.tobytes().decode("utf-8", "replace")
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        head = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        full = np.flatnonzero(np.diff(head))
        points = np.insert(np.where(points == 0x20, np.uint32(_BLANK), points), head[full], np.uint32(_BLANK))
        head = head + np.concatenate([[0], np.cumsum(np.diff(head) > 0)])
        blank = points == _BLANK
        begin = blank & ~np.concatenate([[False], blank[:-1]])
        begin[head[:-1][head[:-1] < len(points)]] = True
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], len(points)) if len(starts) else starts
        total = np.zeros(len(points) + 1, np.uint64)
        power = kernels._power_table(kernels._R, len(points) + 1, "up")
        back = kernels._power_table(kernels._R_INV, len(points) + 1, "down")
        np.cumsum(kernels.mix(points.astype(np.uint64) + np.uint64(1)) * power[: len(points)], out=total[1:])
        hashes = kernels.mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))
        unique, example, which = np.unique(hashes, return_index=True, return_inverse=True)
        new = np.ones(len(unique), bool)
        if len(self.known):
            at = np.searchsorted(self.known, unique)
            at[at == len(self.known)] = 0
            new = self.known[at] != unique
            if len(self.known) + new.sum() > _KEPT:
                self._forget()
                new[:] = True
        if new.any():
            at = example[new]
            ids, start, count = self.encode_words(points, starts[at], ends[at])
            start = start + len(self.pool)
            self.pool = np.concatenate([self.pool, ids.astype(np.int32)])
            known = np.concatenate([self.known, unique[new]])
            order = np.argsort(known)
            self.known = known[order]
            self.start = np.concatenate([self.start, start])[order]
            self.count = np.concatenate([self.count, count])[order]
        slot = np.searchsorted(self.known, unique)[which] if len(which) else which
        count = self.count[slot]
        before = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
        source = np.repeat(self.start[slot] - before[:-1], count) + np.arange(before[-1])
        return self.pool[source], before[np.searchsorted(starts, head)]

    # ---- decoding

    def decode(self, ids: np.ndarray, first: np.ndarray) -> list[str]:
        """The texts of id sequences that lie end to end; the blank put before a text goes again."""
        count = self.raw_count[ids]
        before = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
        source = np.repeat(self.raw_start[ids] - before[:-1], count) + np.arange(before[-1])
        data = self.raw[source].tobytes()
        out = []
        for a, b in zip(before[first[:-1]].tolist(), before[first[1:]].tolist(), strict=True):
            text = data[a:b].decode("utf-8", "replace")
            out.append(text[1:] if text.startswith(" ") else text)
        return out


@lru_cache(2)
def _loaded(path: str, kind: str) -> Pieces:
    return Pieces.from_file(path, kind)


def encode_documents(
    docs: DataFrame, *, model: str, kind: str, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = True
) -> DataFrame:
    """One row per input row: id, n_pieces, ids_crc32, decoded_equal, and the ids if asked.

    `model` is the path of a SentencePiece file, `kind` what it is: bpe or
    unigram. A null or empty text has no ids. decoded_equal says whether
    decoding gives the text back; the blank sign U+2581 in a text comes back as
    a space. Repeated rows each keep a row; null ids are kept. Other columns are
    not read.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    docs = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _loaded(model, kind)
        for batch in batches:
            for row, data, offsets in kernels.slices(batch.column("text")):
                ids, first = pieces.encode(data, offsets)
                ids = ids.astype("<i4")
                parts = [ids[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
                raw = data.tobytes()
                texts = pieces.decode(ids, first)
                equal = [t.encode() == raw[a:b] for t, a, b in zip(texts, offsets[:-1], offsets[1:], strict=True)]
                arrays = [
                    batch.column("id")[row : row + len(parts)], pa.array(np.diff(first), pa.int64()),
                    pa.array([zlib.crc32(p) for p in parts], pa.int64()), pa.array(equal, pa.bool_()),
                ]
                names = ["id", "n_pieces", "ids_crc32", "decoded_equal"]
                if with_ids:
                    arrays.append(pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids)))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    extra = ", ids array<int>" if with_ids else ""
    out = docs.mapInArrow(run, f"id {id_type}, n_pieces long, ids_crc32 long, decoded_equal boolean{extra}")
    return out.withColumnRenamed("id", id_column)


def decode_documents(rows: DataFrame, *, model: str, kind: str, ids_column: str = "ids", output: str = "text") -> DataFrame:
    """The rows with the text of their ids in a new last column; null ids give an empty text."""
    rows = rows.drop(output)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _loaded(model, kind)
        for batch in batches:
            lists = [x or [] for x in batch.column(ids_column).to_pylist()]
            first = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
            flat = np.fromiter((i for x in lists for i in x), np.int64, int(first[-1]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pieces.decode(flat, first), pa.string())], names=[*batch.schema.names, output]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{fields}, `{output}` string")
