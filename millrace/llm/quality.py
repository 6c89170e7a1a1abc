"""Text quality by a generalised additive model with pairwise interactions.

Each text becomes a few dozen shape figures. Each figure has a lookup table over
its bins and some pairs of figures have one over pairs of bins. The tables are
learned by boosting in cycles: feature after feature, a shallow tree is fitted
to what is left unexplained and a small part of it is added to that feature's
table. Scoring adds up table entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm import kernels
from millrace.llm.labelled import sample_of_class

FIGURES = [
    "log_chars", "log_words", "word_length", "word_length_spread", "long_words", "upper", "digits", "spaces", "accented",
    "exclaims", "bars", "signs", "brackets", "stops", "commas", "symbol_words", "upper_words", "distinct_words",
    "distinct_pairs", "top_word", "repeated_next", "log_lines", "line_length", "repeated_lines", "short_lines", "closed_lines", "byte_entropy",
]

# Bounds of the fit; scoring has none.
MAX_ROWS = 6000
MAX_CHARS = 100_000
_BINS = 32
_PAIR_BINS = 8

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": b"0123456789", "spaces": b" \t", "exclaims": b"!?", "bars": b"|", "signs": b"#$%&*@+=~^_\\",
    "brackets": b"<>{}[]()", "stops": b".", "commas": b",;:",
}
_CLASS = np.full(256, len(_CLASSES), np.uint8)
for _k, _chars in enumerate(_CLASSES.values()):
    _CLASS[list(_chars)] = _k
_N_CLASS = len(_CLASSES) + 1


def _per_text(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches; empty ones are 0."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[starts[1:]] - total[starts[:-1]]


def _distinct(keys: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each stretch, and the count of its commonest."""
    n = len(starts) - 1
    number, most = np.zeros(n), np.zeros(n)
    for i in range(n):
        part = np.sort(keys[starts[i] : starts[i + 1]])
        if len(part):
            cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
            number[i] = len(cuts) - 1
            most[i] = np.diff(cuts).max()
    return number, most


def figures(column: pa.Array) -> np.ndarray:
    """A row of FIGURES per text; null counts as empty, and an empty text has zeros."""
    out = [_slice_figures(data, offsets) for _, data, offsets in kernels.slices(column)]
    return np.concatenate(out) if out else np.zeros((0, len(FIGURES)))


def _slice_figures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    chars = np.maximum(_per_text((data & 0xC0) != 0x80, offsets), 1)
    by_class = np.bincount(owner * _N_CLASS + _CLASS[data], minlength=n * _N_CLASS).reshape(n, _N_CLASS)
    share = {name: by_class[:, k] / chars for k, name in enumerate(_CLASSES)}
    accented = _per_text(data >= 0xC0, offsets) / chars

    hashes, first = kernels.words(data, offsets)
    n_words = np.diff(first)
    some = np.maximum(n_words, 1)
    body = ~kernels.IS_SPACE[data]
    before = np.concatenate([[False], body[:-1]])
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    begin = np.flatnonzero(body & ~before)
    counts = np.concatenate([[0], np.cumsum(body & ((data & 0xC0) != 0x80))])
    upper = np.concatenate([[0], np.cumsum(_CLASS[data] == 0)])
    sign = np.concatenate([[0], np.cumsum((_CLASS[data] >= 3) & (_CLASS[data] <= 5))])
    end = np.concatenate([begin[1:], [len(data)]]) if len(begin) else begin
    length = (counts[end] - counts[begin]).astype(np.float64)
    mean = _per_text(length, first) / some
    square = _per_text(length * length, first) / some
    distinct, most = _distinct(hashes, first)
    # the last word of a text has none after it
    inner = np.ones(len(hashes), bool)
    inner[first[1:][n_words > 0] - 1] = False
    after = np.append(hashes[1:], np.zeros(1, np.uint64))[: len(hashes)]
    distinct_pairs, _ = _distinct(np.where(inner, hashes * np.uint64(3) + after, hashes), first)
    repeat = inner & (after == hashes)

    # lines: cut after every newline, and where a text begins
    start = np.zeros(len(data) + 1, bool)
    start[1:] = data == 10
    start[offsets[:-1]] = True
    line_at = np.flatnonzero(start[: len(data)])
    line_first = np.searchsorted(line_at, offsets)
    n_lines = np.diff(line_first)
    lines = np.maximum(n_lines, 1)
    line_end = np.append(line_at[1:], len(data))
    line_length = (line_end - line_at).astype(np.float64)
    word_total = np.concatenate([[np.uint64(0)], np.cumsum(hashes * (np.arange(len(hashes), dtype=np.uint64) * np.uint64(0) + np.uint64(1)))])
    word_at = np.searchsorted(begin, line_at)
    word_to = np.searchsorted(begin, line_end)
    line_key = word_total[word_to] - word_total[word_at]
    distinct_lines, _ = _distinct(line_key, line_first)
    last = np.maximum(line_end - 1 - (data[np.maximum(line_end - 1, 0)] == 10), 0) if len(data) else line_end
    closed = np.isin(data[last], np.frombuffer(b'.!?":', np.uint8)) if len(data) else np.zeros(0)

    freq = np.bincount(owner * 64 + (data >> 2), minlength=n * 64).reshape(n, 64) / np.maximum(np.diff(offsets), 1)[:, None]
    entropy = -(freq * np.log2(np.maximum(freq, 1e-12))).sum(axis=1)
    rows = {
        "log_chars": np.log1p(np.where(np.diff(offsets) > 0, chars, 0)), "log_words": np.log1p(n_words), "word_length": mean,
        "word_length_spread": np.sqrt(np.maximum(square - mean * mean, 0)), "long_words": _per_text(length > 16, first) / some,
        "accented": accented, "symbol_words": _per_text(sign[end] > sign[begin], first) / some,
        "upper_words": _per_text((upper[end] - upper[begin]) * 2 > length, first) / some, "distinct_words": distinct / some,
        "distinct_pairs": distinct_pairs / some, "top_word": most / some, "repeated_next": _per_text(repeat, first) / some,
        "log_lines": np.log1p(n_lines), "line_length": np.log1p(_per_text(line_length, line_first) / lines),
        "repeated_lines": 1 - distinct_lines / lines, "short_lines": _per_text(line_length < 30, line_first) / lines,
        "closed_lines": _per_text(closed, line_first) / lines, "byte_entropy": entropy, **share,
    }
    return np.stack([rows[name] for name in FIGURES], axis=1)


@dataclass
class Model:
    intercept: float
    cuts: list[np.ndarray]  # per figure, increasing
    tables: list[np.ndarray]  # per figure, one more than its cuts
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)  # per figure
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def logits(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.intercept)
        for k, (cuts, values) in enumerate(zip(self.cuts, self.tables, strict=True)):
            out += values[np.searchsorted(cuts, rows[:, k], side="right")]
        for (a, b), values in zip(self.pairs, self.pair_tables, strict=True):
            i = np.searchsorted(self.pair_cuts[a], rows[:, a], side="right")
            j = np.searchsorted(self.pair_cuts[b], rows[:, b], side="right")
            out += values[i, j]
        return out

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(rows), -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Quantiles as bin borders, none twice."""
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _tree(grad: np.ndarray, weight: np.ndarray, ridge: float, leaves: int) -> np.ndarray:
    """A shallow tree over ordered bins: the best cut of any leaf, again and again; a value per bin."""

    def gain(lo: int, hi: int) -> tuple[float, int]:
        if hi - lo < 2:
            return 0.0, lo
        g, w = np.cumsum(grad[lo:hi]), np.cumsum(weight[lo:hi])
        left = g[:-1] ** 2 / (w[:-1] + ridge)
        right = (g[-1] - g[:-1]) ** 2 / (w[-1] - w[:-1] + ridge)
        score = left + right - g[-1] ** 2 / (w[-1] + ridge)
        at = int(np.argmax(score))
        return float(score[at]), lo + at + 1

    parts = [(0, len(grad))]
    while len(parts) < leaves:
        options = [(*gain(lo, hi), k) for k, (lo, hi) in enumerate(parts)]
        best, at, k = max(options)
        if best <= 1e-9:
            break
        lo, hi = parts[k]
        parts[k : k + 1] = [(lo, at), (at, hi)]
    out = np.zeros(len(grad))
    for lo, hi in parts:
        out[lo:hi] = grad[lo:hi].sum() / (weight[lo:hi].sum() + ridge)
    return out


def _tree_2d(grad: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """One cut of the rows, then one of the columns on either side; a value per cell."""
    best, out = -1.0, np.zeros_like(grad)
    for at in range(1, grad.shape[0]):
        table, score = np.zeros_like(grad), 0.0
        for half in (slice(0, at), slice(at, None)):
            g, w = grad[half].sum(axis=0), weight[half].sum(axis=0)
            values = _tree(g, w, ridge, 2)
            table[half] = values
            score += float((2 * values * g - values**2 * (w + ridge)).sum())
        if score > best:
            best, out = score, table
    return out


def fit(
    rows: np.ndarray, y: np.ndarray, *, rounds: int = 120, rate: float = 0.15, n_pairs: int = 8, pair_rounds: int = 30, ridge: float = 4.0
) -> Model:
    """A model of labels 0 and 1 from figures.

    Classes weigh alike in the search for tables. With one class only, or no
    rows at all, every score is that class's smoothed share.
    """
    n_figures = rows.shape[1]
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Model(float(np.log(share / (1 - share))), [np.zeros(0)] * n_figures, [np.zeros(1)] * n_figures)
    if len(np.unique(y)) < 2:
        return model
    model.cuts = [_cuts(rows[:, k], _BINS) for k in range(n_figures)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    bins = [np.searchsorted(c, rows[:, k], side="right") for k, c in enumerate(model.cuts)]
    logit = np.full(len(y), model.intercept)

    def stats(at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-logit))
        return np.bincount(at, y - p, size), np.bincount(at, p * (1 - p), size)

    for _ in range(rounds):
        for k in range(n_figures):
            step = rate * _tree(*stats(bins[k], len(model.tables[k])), ridge, 3)
            model.tables[k] += step
            logit += step[bins[k]]
    # pairs by how much a small tree over both would still explain
    model.pair_cuts = [_cuts(rows[:, k], _PAIR_BINS) for k in range(n_figures)]
    small = [np.searchsorted(c, rows[:, k], side="right") for k, c in enumerate(model.pair_cuts)]
    sizes = [len(c) + 1 for c in model.pair_cuts]
    ranked = []
    for a in range(n_figures):
        for b in range(a + 1, n_figures):
            g, w = (s.reshape(sizes[a], sizes[b]) for s in stats(small[a] * sizes[b] + small[b], sizes[a] * sizes[b]))
            values = _tree_2d(g, w, ridge)
            ranked.append((float((2 * values * g - values**2 * (w + ridge)).sum()), a, b))
    ranked.sort(key=lambda r: (-r[0], r[1], r[2]))
    model.pairs = [(a, b) for _, a, b in ranked[:n_pairs]]
    model.pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in model.pairs]
    for _ in range(pair_rounds):
        for k, (a, b) in enumerate(model.pairs):
            g, w = (s.reshape(sizes[a], sizes[b]) for s in stats(small[a] * sizes[b] + small[b], sizes[a] * sizes[b]))
            step = rate * _tree_2d(g, w, ridge)
            model.pair_tables[k] += step
            logit += step[small[a], small[b]]
    return model


def with_figures(docs: DataFrame, *, text_column: str = "text", output: str = "figures") -> DataFrame:
    """The rows with an array of FIGURES in place of the text."""
    kept = [c for c in docs.columns if c not in (text_column, output)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = figures(batch.column(text_column))
            flat = pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), flat], names=[*kept, output])

    fields = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in kept)
    return docs.select(*[f"`{c}`" for c in kept], f"`{text_column}`").mapInArrow(run, f"{fields}`{output}` array<double>")


def fit_from_labels(docs: DataFrame, labels: DataFrame, *, label: str = "quality", skip: Column | None = None, max_rows: int = MAX_ROWS) -> Model:
    """A model from at most `max_rows` labelled texts of either kind, as labelled.sample_of_class draws them.

    `skip` is a condition on the id, named `of`, of rows that must not be used.
    """
    skip = F.lit(False) if skip is None else skip
    rows, y = [], []
    for value in (0, 1):
        texts = sample_of_class(docs, labels, label, value, max_rows, skip, MAX_CHARS)
        got = sorted((r.doc_id, r.figures) for r in with_figures(texts).collect())
        rows += [f for _, f in got]
        y += [value] * len(got)
    return fit(np.array(rows, np.float64).reshape(len(rows), len(FIGURES)), np.array(y, np.float64))


def score(docs: DataFrame, model: Model, *, text_column: str = "text", output: str = "score") -> DataFrame:
    """The rows with a score of 0 to 1 in a new last column.

    Null and empty texts are scored by figures of zero. Rows that repeat and
    ties get equal scores; other columns go through as they are, and one already
    called `output` is replaced.
    """
    docs = docs.drop(output)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(model.scores(figures(batch.column(text_column))), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, output])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, `{output}` double")
