"""NumPy kernels over batches of texts, run inside Spark tasks.

A batch is the UTF-8 bytes of some texts end to end and the byte offsets at
which they start. Nothing here touches Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Texts are worked on in slices of about so many bytes, whatever the batch holds.
SLICE_BYTES = 1 << 18

_U = np.uint64
_rng = np.random.default_rng(20240611)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_STEP = _rng.integers(1, 2**63, 16, dtype=np.uint64) * _U(2) + _U(1)
_R = _U(0x9E3779B97F4A7C15)
_R_INV = _U(pow(0x9E3779B97F4A7C15, -1, 2**64))

LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[ord("A") : ord("Z") + 1] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers: dict[str, np.ndarray] = {}


def _power_table(base: np.uint64, n: int, name: str) -> np.ndarray:
    table = _powers.get(name)
    if table is None or len(table) < n:
        table = np.full(n, base, dtype=np.uint64)
        table[0] = 1
        _powers[name] = table = np.multiply.accumulate(table)
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (wraps silently)."""
    x = x ^ (x >> _U(31))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def slices(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive rows; null counts as empty text."""
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        chunk = chunk.cast(pa.large_binary())
        if chunk.null_count:
            chunk = chunk.fill_null(b"")
        n = len(chunk)
        if not n:
            continue
        offsets = np.frombuffer(chunk.buffers()[1], dtype=np.int64)[chunk.offset : chunk.offset + n + 1]
        data = chunk.buffers()[2]
        data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        row = 0
        while row < n:
            end = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, side="left"))
            end = min(max(end, row + 1), n)
            yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
            row = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and, per text, where its words start in that array.

    Words are runs of bytes other than space and 0x09 to 0x0D, A-Z lower-cased.
    """
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    data = LOWER_ASCII[data]
    body = ~IS_SPACE[data]
    before = np.empty_like(body)
    before[0] = False
    before[1:] = body[:-1]
    cuts = offsets[1:-1]
    before[cuts[cuts < len(data)]] = False
    starts = np.flatnonzero(body & ~before)
    after = np.empty_like(body)
    after[-1] = False
    after[:-1] = body[1:]
    cuts = cuts[cuts > 0] - 1
    after[cuts] = False
    ends = np.flatnonzero(body & ~after) + 1
    power = _power_table(_R, len(data), "up")
    back = _power_table(_R_INV, len(data), "down")
    total = np.empty(len(data) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[data] * power[: len(data)], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * back[starts])
    return hashes, np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of `size` words of every text, in order, and where each text's start.

    A text with fewer words has its whole sequence as one; one without words has none.
    """
    n_words = np.diff(first)
    counts = np.where(n_words == 0, 0, np.maximum(n_words - size + 1, 1))
    starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    out = np.zeros(starts[-1], dtype=np.uint64)
    if not len(out):
        return out, starts
    # word index at which each shingle begins
    begin = np.arange(len(out)) - np.repeat(starts[:-1], counts) + np.repeat(first[:-1], counts)
    last = np.repeat(first[1:], counts)
    for k in range(size):
        at = begin + k
        inside = at < last
        if inside.all():
            out += hashes[at] * _STEP[k]
        else:
            out[inside] += hashes[at[inside]] * _STEP[k]
    return mix(out), starts
