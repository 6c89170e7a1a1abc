"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear SVM.

The kernel between two strings counts the subsequences of four folded letters
they share, each weighted by LAMBDA for every character skipped. At most one
character is skipped between two letters, so "i.d.i.o.t", "idiiot" and "idot"
still meet "idiot". Folding strips case and accents and undoes digits and signs
written for letters.

Labels are per text, the classifier works per sentence. Sentences of texts
without the label are negative; of a text with it, the sentences that score
highest are positive, and the fit is repeated until they settle.

A support vector machine on the Nyström features of fixed landmarks is linear
in the subsequences of the landmarks, so the fitted model collapses into one
table of a weight per four letters. Scoring a text reads that table at every
character, sums over sentences and takes the highest. Every character of every
text is read.
"""

from __future__ import annotations

import heapq
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm import kernels
from millrace.llm.labelled import sample_of_class

LAMBDA = 0.6
_P = 4
_BITS = 5
_SPACE, _OTHER = 0, 31
# (gap after the first, second, third letter)
_GAPS = [(a, b, c) for a in (0, 1) for b in (0, 1) for c in (0, 1)]
_REACH = 6  # letters after the first, skips included
_BLOCK = 12
# Signs commonly written for letters.
_WRITTEN_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
_ENDS = ".!?"

# Bounds of the fit; scoring has none.
MAX_ROWS = 1200
MAX_CHARS = 100_000
LANDMARKS = 192


def _fold_table() -> np.ndarray:
    table = np.full(0x110000, _OTHER, np.uint8)
    table[0x250:] = 27 + np.arange(0x110000 - 0x250) % 4
    for cp in range(0x250):
        ch = _WRITTEN_FOR.get(chr(cp), chr(cp))
        base = unicodedata.normalize("NFKD", ch.lower())[:1]
        if "a" <= base <= "z":
            table[cp] = ord(base) - ord("a") + 1
        elif ch.isspace():
            table[cp] = _SPACE
        elif ch.isalpha():
            table[cp] = 27 + cp % 4
    return table


_FOLD = _fold_table()


@dataclass
class Model:
    weights: np.ndarray  # a weight per four letters
    slope: float
    offset: float


def _codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded characters, raw code points and the texts' offsets in characters."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    starts = (data & 0xC0) != 0x80
    at = np.concatenate([[0], np.cumsum(starts)])[offsets]
    return _FOLD[np.minimum(points, 0x10FFFF)], points, at


def _blocks(points: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of blocks of at most _BLOCK characters, which sentence each is of, and which text."""
    n = len(points)
    end = np.isin(points, np.array([ord(c) for c in _ENDS], np.uint32))
    gap = points <= 0x20
    start = np.zeros(n + 1, bool)
    start[1:n] = (end[:-1] & gap[1:]) | (points[:-1] == 10)
    start[at[:-1]] = True
    start = start[:n]
    first = np.flatnonzero(start)
    length = np.diff(np.append(first, n))
    pieces = -(-length // _BLOCK)
    sentence = np.repeat(np.arange(len(first)), pieces)
    inside = np.arange(len(sentence)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = np.repeat(first, pieces) + inside * _BLOCK
    return starts, sentence, np.searchsorted(at, starts, side="right") - 1


def _fours(folded: np.ndarray, at: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, float]]:
    """Codes of the four letters from every position on, for every way of skipping.

    What lies past the end counts as no letter; so does what lies past the end
    of its text, where texts begin at `at`.
    """
    padded = np.concatenate([folded, np.full(8, _OTHER, np.uint8)]).astype(np.int32)
    n = len(folded)
    tail = np.zeros(0, np.int64)
    if at is not None:
        ends = at[1:]
        tail = np.unique(ends[:, None] - np.arange(1, _REACH + 1))
        tail = tail[tail >= 0]
        tail_end = ends[np.searchsorted(ends, tail, side="right")]
    for a, b, c in _GAPS:
        i, j, k = 1 + a, 2 + a + b, 3 + a + b + c
        code = (padded[:n] << 15) | (padded[i : i + n] << 10) | (padded[j : j + n] << 5) | padded[k : k + n]
        if len(tail):
            first, *others = (np.where(tail + step < tail_end, padded[tail + step], _OTHER) for step in (0, i, j, k))
            code[tail] = (first << 15) | (others[0] << 10) | (others[1] << 5) | others[2]
        yield code, LAMBDA ** (a + b + c)


def _piece_scores(weights: np.ndarray, folded: np.ndarray, at: np.ndarray, starts: np.ndarray, sentence: np.ndarray) -> np.ndarray:
    """Scores of all pieces of sentences, one for every block's start.

    A piece is two blocks in a row of one sentence, or its only one.
    """
    local = np.zeros(len(folded), np.float32)
    for code, weight in _fours(folded, at):
        local += np.float32(weight) * weights[code]
    sums = np.add.reduceat(local, starts) if len(starts) else np.zeros(0, np.float32)
    joined = sums.copy()
    same = sentence[1:] == sentence[:-1]
    joined[:-1][same] += sums[1:][same]
    return joined


def text_scores(model: Model, column: pa.Array) -> np.ndarray:
    """A score of 0 to 1 for every text; null and empty texts get that of a text without any hit."""
    out = []
    for _, data, offsets in kernels.slices(column):
        folded, points, at = _codes(data, offsets)
        best = np.zeros(len(at) - 1, np.float32)
        if len(folded):
            starts, sentence, text = _blocks(points, at)
            np.maximum.at(best, text, _piece_scores(model.weights, folded, at, starts, sentence))
        out.append(1 / (1 + np.exp(-np.clip(model.slope * best.astype(np.float64) + model.offset, -30, 30))))
    return np.concatenate(out) if out else np.zeros(0)


def _folded(text: str) -> bytes:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return _FOLD[np.minimum(points, 0x10FFFF)].tobytes()


def _grams(texts: list[str], only: set[bytes] | None = None) -> Counter:
    """In how many of the texts are strings of five or six letters within words, and short words."""
    total: Counter = Counter()
    for text in texts:
        seen = set()
        for word in set(_folded(text).split(b"\x00")):
            for size in (5, 6):
                seen.update(word[i : i + size] for i in range(len(word) - size + 1))
            if _P <= len(word) <= 16:
                seen.add(word)
        total.update(seen if only is None else seen & only)
    return total


def _gains(bad: Counter, n_bad: int, good: Counter, n_good: int) -> dict[bytes, float]:
    """How much better than chance a string's presence tells the first lot from the second."""
    gains = {}
    for gram, x in bad.items():
        p, q = (x + 0.5) / (n_bad + 1), (good[gram] + 0.5) / (n_good + 1)
        if x >= 2 and p > q:
            gains[gram] = float(x * np.log(p / q))
    return gains


def _landmarks(bad: list[str], good: list[str], count: int) -> tuple[list[bytes], int]:
    """Strings that tell the two lots of texts apart, then common ones, and how many are of the first kind.

    A string counts as telling above the gains seen when texts without the
    label are told from each other.
    """
    k = min(len(bad), len(good) // 2)
    # strings in one text alone tell nothing: they are let go before the next lot is counted
    df = Counter({g: n for g, n in _grams(bad).items() if n > 1})
    one = Counter({g: n for g, n in _grams(good[:k]).items() if n > 1 or g in df})
    other = _grams(good[k:], df.keys() | one.keys())
    bar = max(_gains(one, k, other, len(good) - k).values(), default=0.0)
    one.update(other)
    gains = _gains(df, len(bad), one, len(good))
    telling: list[bytes] = []
    for gram in sorted(gains, key=lambda g: (-round(gains[g], 6), -len(g), g)):
        if len(telling) >= count * 2 // 3 or (gains[gram] <= bar and len(telling) >= 8):
            break
        if not any((gram in t or t in gram) and min(df[gram], df[t]) >= 0.8 * max(df[gram], df[t]) for t in telling):
            telling.append(gram)
    taken = set(telling)
    rest = heapq.nsmallest(count, (g for g in one if g not in taken), key=lambda g: (-one[g], g))
    return telling + rest[: count - len(telling)], len(telling)


def _phi(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes that occur in the strings, and each string's unit vector over them."""
    rows = []
    for s in strings:
        folded = np.frombuffer(s, np.uint8)
        counts: Counter = Counter()
        for code, weight in _fours(folded):
            # codes that reach past the end of the string are not of it
            span = {LAMBDA ** k: k for k in range(4)}[weight]
            for c in code[: max(len(folded) - _P + 1 - span, 0)]:
                counts[int(c)] += weight
        rows.append(counts)
    codes = np.array(sorted(set().union(*rows)) if rows else [], np.int64)
    phi = np.zeros((len(strings), len(codes)), np.float32)
    for r, counts in enumerate(rows):
        for c, w in counts.items():
            phi[r, np.searchsorted(codes, c)] = w
    return codes, phi / np.maximum(np.linalg.norm(phi, axis=1, keepdims=True), 1e-9)


def _own_codes(mark: bytes) -> list[int]:
    """The subsequences of a string without a skip."""
    folded = np.frombuffer(mark, np.uint8)
    return next(_fours(folded))[0][: max(len(folded) - _P + 1, 0)].tolist()


def _own(mark: bytes) -> np.ndarray:
    return np.ones(len(_own_codes(mark)))


class _Pieces:
    """The pieces of the fit's sentences, and their kernel values with the landmarks.

    Where the pieces lie depends on the texts alone and is kept in four bytes
    each; code points are not kept.
    """

    def __init__(self, texts: list[str], codes: np.ndarray, phi: np.ndarray):
        self.parts, spots, first = [], [np.zeros((3, 0), np.int32)], 0
        lots = (pa.array(texts[k : k + 64], pa.large_string()) for k in range(0, len(texts), 64))
        for _, data, offsets in (part for lot in lots for part in kernels.slices(lot)):
            folded, points, at = _codes(data, offsets)
            if len(folded):
                starts, sentence, text = (x.astype(np.int32) for x in _blocks(points, at))
                self.parts.append((folded, at, starts, sentence))
                spots.append(np.stack([text + first, starts, np.minimum(starts + 2 * _BLOCK, at[text + 1])]).astype(np.int32))
            first += len(at) - 1
        self.before = np.cumsum([0, *(len(x[2]) for x in self.parts)])  # pieces of the parts before each part
        self.texts, self.starts, self.ends = np.concatenate(spots, axis=1)
        self.slot = np.full(1 << (_P * _BITS), -1, np.int32)
        self.slot[codes] = np.arange(len(codes))
        self.phi = np.ascontiguousarray(phi.T)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Scores of all pieces."""
        out = np.zeros(len(self.texts), np.float32)
        for lo, part in zip(self.before, self.parts, strict=False):
            out[lo : lo + len(part[2])] = _piece_scores(weights, *part)
        return out

    def places(self, chosen: np.ndarray) -> np.ndarray:
        """(part, start, end) of the chosen pieces."""
        return np.stack([np.searchsorted(self.before, chosen, side="right") - 1, self.starts[chosen], self.ends[chosen]], axis=1)

    def kernel(self, places: np.ndarray) -> np.ndarray:
        """Kernel values of the pieces with the landmarks."""
        out = np.zeros((len(places), self.phi.shape[1]), np.float32)
        for lo in range(0, len(places), 512):
            part = places[lo : lo + 512]
            rows = np.full((len(part), 2 * _BLOCK + 8), _OTHER, np.uint8)
            for r, (k, start, end) in enumerate(part):
                rows[r, : end - start] = self.parts[k][0][start:end]
            width, spots, values = self.phi.shape[0], [], []
            for code, weight in _fours(rows.ravel()):
                slot = self.slot[code]
                at = np.flatnonzero(slot >= 0)
                spots.append(at // rows.shape[1] * width + slot[at])
                values.append(np.full(len(at), weight))
            found = np.bincount(np.concatenate(spots), np.concatenate(values), len(part) * width)
            out[lo : lo + 512] = found.reshape(len(part), width).astype(np.float32) @ self.phi
        return out


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 4.0, steps: int = 20) -> tuple[np.ndarray, float]:
    """Squared hinge loss by Newton steps; y is -1 or 1. The intercept is not penalised."""
    x1 = np.ones((len(x), x.shape[1] + 1))
    x1[:, :-1] = x
    del x  # the caller keeps no name for it
    beta = np.zeros(x1.shape[1])
    penalty = np.full(len(beta), ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        margin = y * (x1 @ beta)
        act = margin < 1
        xa = x1 if act.all() else x1[act]
        grad = penalty * beta - 2 * xa.T @ (weight[act] * (1 - margin[act]) * y[act])
        step = np.linalg.solve(np.diag(penalty) + 2 * (xa * weight[act, None]).T @ xa, grad)
        beta -= step
        if np.abs(step).max() < 1e-3 * np.abs(beta).max():
            break
    return beta[:-1], float(beta[-1])


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve from one score; slightly shrunk targets."""
    n1, n0 = y.sum(), (1 - y).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 0.0, float(np.log((n1 + 1) / (n0 + 1)))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - target) * x).sum() + 1e-3 * a, (p - target).sum()])
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-9]])
        step = np.clip(np.linalg.solve(h, g), -5, 5)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(a, 0.0), b


def fit(bad: list[str], good: list[str], landmarks: int = LANDMARKS, rounds: int = 3) -> Model:
    """A model from texts with the label and texts without it.

    With texts of one kind only, every score is that kind's share.
    """
    weights = np.zeros(1 << (_P * _BITS), np.float32)
    marks, n_telling = _landmarks(bad, good, landmarks) if bad and good else ([], 0)
    if not n_telling:
        share = (len(bad) + 0.5) / (len(bad) + len(good) + 1)
        return Model(weights, 0.0, float(np.log(share / (1 - share))))
    codes, phi = _phi(marks)
    between = (phi @ phi.T).astype(np.float64)
    values, vectors = np.linalg.eigh(between)
    keep = values > 1e-4
    root = vectors[:, keep] / np.sqrt(values[keep])  # Nyström: features are K root
    pieces = _Pieces(bad + good, codes, phi)
    is_bad = np.arange(len(bad) + len(good)) < len(bad)
    # before the first fit a piece is positive for holding most of a telling landmark
    own = np.array([max(float(_own(m) @ phi[r, np.searchsorted(codes, _own_codes(m))]), 1e-9) for r, m in enumerate(marks[:n_telling])])
    weights[codes] = (phi[:n_telling] / own[:, None]).sum(axis=0)
    bar = 0.8
    rng = np.random.default_rng(7)
    extra: np.ndarray | None = None
    cache: dict[int, np.ndarray] = {}
    for _ in range(rounds):
        scores, texts = pieces.scores(weights), pieces.texts
        order = np.lexsort((-scores, texts))
        nth = np.arange(len(order)) - np.searchsorted(texts[order], texts[order])
        top = order[(nth == 0) | ((nth < 5) & (scores[order] > bar))]
        hard = order[nth < 3]
        chosen = np.concatenate([top[is_bad[texts[top]]], hard[~is_bad[texts[hard]]]])
        if extra is None:
            free = np.flatnonzero(~is_bad[texts])
            extra = rng.choice(free, min(len(free), 3000), replace=False)
        chosen = np.unique(np.concatenate([chosen, extra]))
        new = np.array([c for c in chosen if c not in cache], np.int64)
        if len(new):
            cache.update(zip(new.tolist(), pieces.kernel(pieces.places(new)), strict=True))
        y = np.where(is_bad[texts[chosen]], 1.0, -1.0)
        weight = np.where(y > 0, 1.0 / max((y > 0).sum(), 1), 1.0 / max((y < 0).sum(), 1)) * len(y)
        beta, bias = _svm(np.stack([cache[c] for c in chosen.tolist()], dtype=np.float64) @ root, y, weight)
        bar = max(-bias, 0.0)
        weights[:] = 0
        weights[codes] = phi.T @ (root @ beta)
    best = np.zeros(len(is_bad), np.float32)
    np.maximum.at(best, pieces.texts, pieces.scores(weights))
    return Model(weights, *_logistic(best.astype(np.float64), is_bad.astype(np.float64)))


def fit_from_labels(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", skip: Column | None = None, max_rows: int = MAX_ROWS) -> Model:
    """A model from at most `max_rows` labelled texts of either kind, as labelled.sample_of_class draws them.

    `skip` is a condition on the id, named `of`, of rows that must not be used.
    """
    skip = F.lit(False) if skip is None else skip
    lots = [
        sorted(tuple(r) for r in sample_of_class(docs, labels, label, value, max_rows, skip, MAX_CHARS).collect()) for value in (1, 0)
    ]
    return fit([text for _, text in lots[0]], [text for _, text in lots[1]])


def score(docs: DataFrame, model: Model, *, text_column: str = "text", output: str = "score") -> DataFrame:
    """The rows with a score of 0 to 1 in a new last column.

    Null and empty texts are scored as texts without any hit. Rows that repeat
    and ties get equal scores; other columns go through as they are, and one
    already called `output` is replaced.
    """
    docs = docs.drop(output)
    codes = np.flatnonzero(model.weights).astype(np.int32)
    small = (codes.tobytes(), model.weights[codes].tobytes(), model.slope, model.offset)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(1 << (_P * _BITS), np.float32)
        weights[np.frombuffer(small[0], np.int32)] = np.frombuffer(small[1], np.float32)
        own = Model(weights, small[2], small[3])
        for batch in batches:
            scores = pa.array(text_scores(own, batch.column(text_column)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, output])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, `{output}` double")
