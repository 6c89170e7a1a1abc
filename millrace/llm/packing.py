"""Packing token sequences into windows by the sum-of-squares rule.

Documents are tokenised where they are read and packed in the same task, so no
row is shuffled. Full windows are cut off the front of a document; what is left
goes online into one of the task's partially filled windows, or a new one: of
all fill levels that have room, into the one that makes the sum of squares of
the numbers of windows per level smallest. A level array holds those numbers.

A task's last windows are closed at its end: their pieces are laid end to end
and cut anew into full windows, and the remainder into windows whose lengths are
powers of two, which need no padding.

Byte-pair merges never cross the words of the tokenizer's own splitter, so every
distinct word of a batch is encoded once, by the tokenizer itself, and texts are
put together from those.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm import kernels

_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
_WORDS_KEPT = 400_000
_WORDS_JOINED = 100


@lru_cache(1)
def _classes() -> np.ndarray:
    """Space, letter, number or other, by code point."""
    table = np.full(0x110000, _OTHER, np.uint8)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind == "L":
            table[cp] = _LETTER
        elif kind == "N":
            table[cp] = _NUMBER
    # The white space of Unicode.
    table[[*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = _SPACE
    return table


def word_starts(points: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the splitter of byte-level BPE begins a word, by code point; texts begin at `at`.

    A word is a run of one class, with one blank before it if that directly
    precedes; of other white space the last character stands alone when more
    follows; an apostrophe and s, t, re, ve, m, ll or d form a word where the
    apostrophe begins one.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = _classes()[np.minimum(points, 0x10FFFF)]
    first = np.zeros(n + 1, bool)
    first[at[:-1]] = True
    first = first[:n]
    last = np.append(first[1:], True)  # the last character of a text
    change = first.copy()
    change[1:] |= kind[1:] != kind[:-1]
    space = kind == _SPACE
    follows = np.append(~space[1:], False) & ~last  # something other than white space comes next
    begin = change & ~space
    # a blank directly before a word goes with it
    blank = (points == 0x20) & follows
    joined = np.append([False], blank[:-1]) & ~first
    begin &= ~joined
    begin |= space & follows  # the last of a run of white space: a word's blank, or a word alone
    begin |= space & change & ~follows  # the start of a longer run, or of one at the end
    # contractions
    quote = np.flatnonzero((points == 0x27) & begin)
    if len(quote):
        ends = at[np.searchsorted(at, quote, side="right")]
        one = np.where(quote + 1 < ends, points[np.minimum(quote + 1, n - 1)], 0)
        two = np.where(quote + 2 < ends, points[np.minimum(quote + 2, n - 1)], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        size = np.where(short, 2, np.where(long, 3, 0))
        quote, size, ends = quote[size > 0], size[size > 0], ends[size > 0]
        for k in (1, 2):
            begin[quote[size > k] + k] = False
        after = quote + size
        after, ends = after[after < ends], ends[after < ends]
        # what follows begins a word, unless it is white space, which has its own rule
        begin[after[~space[after]]] = True
    return np.flatnonzero(begin)


def _with(kept: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """An array whose first `used` values are kept and go on with more; what is spare grows with it."""
    if used + len(more) > len(kept):
        kept = np.concatenate([kept[:used], np.empty(used // 4 + len(more), kept.dtype)])
    kept[used : used + len(more)] = more
    return kept


def _merged(keys: np.ndarray, values: np.ndarray, more: np.ndarray, of_more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys with more sorted ones among them, and the values of all."""
    at = np.searchsorted(keys, more) + np.arange(len(more))
    old = np.ones(len(keys) + len(more), bool)
    old[at] = False
    out, of_out = np.empty(len(old), keys.dtype), np.empty(len(old), values.dtype)
    out[at], of_out[at] = more, of_more
    out[old], of_out[old] = keys, values
    return out, of_out


class Encoder:
    """Ids of texts under a tokenizer file, and one id at every text's end, if one is given.

    The strings of added tokens in a text become those tokens, as the library
    does it unless told otherwise; `plain` takes them as ordinary text.
    """

    def __init__(self, path: str, end_id: int | None, *, plain: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        added = [] if plain else list(self.tokenizer.get_added_tokens_decoder().values())
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added):
            raise ValueError("added tokens that take in what is around them are not supported")
        texts = sorted((t.content for t in added), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, texts))) if texts else None
        self.line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.end_id = end_id
        self._forget()

    def _added_spans(self, text: str, head: np.ndarray) -> np.ndarray:
        """Start and end of every added token in the texts that begin at `head`; none lies over two texts."""
        if self.added is None or not self.added.search(text):
            return np.zeros((0, 2), np.int64)
        spans = [m.span() for a, b in zip(head[:-1].tolist(), head[1:].tolist(), strict=True) for m in self.added.finditer(text, a, b)]
        return np.array(spans, np.int64).reshape(-1, 2)

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted word hashes, and the word of each
        self.word = np.zeros(0, np.int64)
        self.fresh, self.fresh_word = self.known, self.word  # the same of the last words, until they are enough to be merged in
        self.start = np.zeros(0, np.int64)  # by word
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.words = self.size = 0  # how much of the last three is in use

    def _alone(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts end to end, and their number for each."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(count.sum())), count

    def _joined(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words that do not end in white space, some hundred to a text, each with a line's end after it.

        The splitter parts the line's end from words on either side.
        """
        lines = ["\n".join([*texts[k : k + _WORDS_JOINED], ""]) for k in range(0, len(texts), _WORDS_JOINED)]
        ids, _ = self._alone(lines)
        if len(self.line_end) == 1:
            ends = np.flatnonzero(ids == self.line_end[0])
            if len(ends) == len(texts):
                return np.delete(ids, ends), np.diff(ends, prepend=-1) - 1
        return self._alone(texts)

    def _learn(self, hashes: np.ndarray, texts: list[str]) -> np.ndarray:
        """The numbers given to new words."""
        white = [k for k, t in enumerate(texts) if t[-1].isspace()]
        rest = texts
        number = self.words + np.arange(len(texts))
        if white:
            others = np.delete(np.arange(len(texts)), white)
            rest = [texts[k] for k in others.tolist()]
            number[np.concatenate([others, white])] = self.words + np.arange(len(texts))
        parts = [self._joined(rest), self._alone([texts[k] for k in white])]
        ids, count = (np.concatenate(x) for x in zip(*parts, strict=True))
        self.ids = _with(self.ids, self.size, ids)
        self.start = _with(self.start, self.words, self.size + np.cumsum(count) - count)
        self.count = _with(self.count, self.words, count)
        self.words, self.size = self.words + len(texts), self.size + len(ids)
        self.fresh, self.fresh_word = _merged(self.fresh, self.fresh_word, hashes, number)
        if len(self.fresh) * 4 > len(self.known):
            self.known, self.word = _merged(self.known, self.word, self.fresh, self.fresh_word)
            self.fresh, self.fresh_word = self.fresh[:0], self.fresh_word[:0]
        return number

    def _numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The numbers of words, -1 of new ones."""
        out = np.full(len(hashes), -1, np.int64)
        for known, word in ((self.known, self.word), (self.fresh, self.fresh_word)):
            if len(known):
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                out = np.where(known[at] == hashes, word[at], out)
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's begin."""
        n = len(offsets) - 1
        text = data.tobytes().decode("utf-8", "replace")
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        head = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        spans = self._added_spans(text, head)
        starts = word_starts(points, np.sort(np.concatenate([head, spans.ravel()])))
        if len(spans):  # an added token is one word
            of = np.searchsorted(spans[:, 0], starts, side="left") - 1
            starts = starts[(of < 0) | (starts >= spans[np.maximum(of, 0), 1])]
        ends = np.append(starts[1:], len(points))
        total = np.zeros(len(points) + 1, np.uint64)
        power = kernels._power_table(kernels._R, len(points) + 1, "up")
        back = kernels._power_table(kernels._R_INV, len(points) + 1, "down")
        np.cumsum(kernels.mix(points.astype(np.uint64) + np.uint64(1)) * power[: len(points)], out=total[1:])
        hashes = kernels.mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))
        unique, example, which = np.unique(hashes, return_index=True, return_inverse=True)
        number = self._numbers(unique)
        new = number < 0
        if self.words + new.sum() > _WORDS_KEPT and self.words:
            self._forget()
            new[:] = True
        if new.any():
            at = example[new]
            number[new] = self._learn(unique[new], [text[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
        slot = number[which]
        count = self.count[slot]
        # one more entry per text for its last id
        closed = int(self.end_id is not None)
        word_first = np.searchsorted(starts, head)
        before = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
        first = before[word_first] + closed * np.arange(n + 1)
        source = np.repeat(self.start[slot] - before[:-1], count)
        source += np.arange(before[-1])
        found = self.ids[source]
        if not closed:
            return found, first
        out = np.empty(before[-1] + n, np.uint32)
        end = np.zeros(len(out), bool)
        end[first[1:] - 1] = True
        out[end] = self.end_id
        out[~end] = found
        return out, first


class Packer:
    """Online packing of pieces shorter than a window by the sum-of-squares rule."""

    def __init__(self, size: int):
        self.size = size
        self.levels = np.zeros(size + 1, np.int64)  # open windows by fill
        self.open: list[list[list]] = [[] for _ in range(size + 1)]

    def place(self, piece: list, length: int) -> list | None:
        """Put the piece into a window; the window's pieces if that fills it."""
        size, levels = self.size, self.levels
        room = np.flatnonzero(levels[1 : size - length + 1]) + 1
        # moving a window from level h to h + length changes the sum of squares by 2 (N[h + length] - N[h] + 1)
        after = np.where(room + length == size, 0, 2 * levels[np.minimum(room + length, size)] + 1)
        change = after - 2 * levels[room] + 1
        fresh = 2 * levels[length] + 1
        level = 0
        if len(room):
            best = int(np.argmin(change[::-1]))  # of equal ones the fullest
            if change[len(room) - 1 - best] <= fresh:
                level = int(room[len(room) - 1 - best])
        window = self.open[level].pop() if level else []
        levels[level] -= bool(level)
        window.append(piece)
        if level + length == size:
            return window
        levels[level + length] += 1
        self.open[level + length].append(window)
        return None

    def rest(self) -> list[list]:
        """The pieces of all windows still open, fullest first."""
        return [piece for level in reversed(self.open) for window in level for piece in window]


SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_documents(
    docs: DataFrame,
    *,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = 1024,
    end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the ids if asked.

    `tokenizer` is the path of a byte-level BPE file for the tokenizers library.
    A null or empty text is `end_id` alone. Every id of every row is in one piece;
    repeated rows are packed each for itself, and an empty table gives no rows.
    Other columns are not read. Sequence ids are unique but not dense.
    """
    docs = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, packer = Encoder(tokenizer, end_id), Packer(window)
        base = TaskContext.get().partitionId() << 33
        made = 0
        out: list[list] = []  # id, start, length, crc32, doc_tokens, sequence, offset, and the ids only if asked

        def emit(pieces: list[list]) -> None:
            nonlocal made
            at = 0
            for doc, start, ids, total in pieces:
                # an array kept here would keep all ids of its slice
                out.append([doc, start, len(ids), zlib.crc32(ids), total, base + made, at, ids.astype(np.int32) if with_ids else None])
                at += len(ids)
            made += 1

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[]] * 8
            arrays = [pa.array(columns[0], id_type), *[pa.array(c, pa.int64()) for c in columns[1:7]]]
            names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                arrays.append(pa.array(columns[7], pa.list_(pa.int32())))
                names.append("ids")
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names=names)

        id_type = None
        for batch in batches:
            id_type = batch.schema.field("id").type
            docs_of = batch.column("id").to_pylist()
            for row, data, offsets in kernels.slices(batch.column("text")):
                ids, first = encoder.encode(data, offsets)
                ids = ids.astype("<u4")
                for k in range(len(offsets) - 1):
                    whole = ids[first[k] : first[k + 1]]
                    doc, total = docs_of[row + k], len(whole)
                    start = 0
                    while total - start >= window:
                        emit([[doc, start, whole[start : start + window], total]])
                        start += window
                    if start < total:
                        piece = [doc, start, whole[start:].copy(), total]
                        if full := packer.place(piece, total - start):
                            emit(full)
                if len(out) > (2_000 if with_ids else 20_000):
                    yield flush()
        rest = deque(packer.rest())
        left = sum(len(p[2]) for p in rest)
        while left:
            take = window if left >= window else 1 << (left.bit_length() - 1)
            pieces, have = [], 0
            while have < take:
                doc, start, ids, total = rest[0]
                part = ids[: take - have]
                pieces.append([doc, start, part, total])
                have += len(part)
                if len(part) == len(ids):
                    rest.popleft()
                else:
                    rest[0] = [doc, start + len(part), ids[len(part) :], total]
            emit(pieces)
            left -= take
        if out:
            yield flush()

    extra = ", ids array<int>" if with_ids else ""
    return docs.mapInArrow(run, f"id {kind}, {SCHEMA}{extra}").withColumnRenamed("id", id_column)
