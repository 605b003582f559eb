"""Quality: naive Bayes support vectors over n-gram indicators.

A text's features are the n-grams that occur in it: three bytes of the
lower-cased text, and one to three word shapes (case, last sign, whether the
word repeats the one before), hashed to ``DIMS`` places.  An indicator is
scaled by the log ratio of its (smoothed) counts in the two classes; a linear
hinge-loss model is fitted on these by dual coordinate descent and drawn
towards the mean weight; a logistic curve of the margins of rows that the
model has not seen turns margins into scores.

Fit: about ``per_label`` texts of each label, chosen by a hash of the id; the
bound is the only sample.  Scores read every byte of every text.

Edge cases: a null or empty text has no n-grams and gets the score of the
bias alone.  With no labelled row, or labels of one kind only, every score is
the share of label 1 (0 without rows).  Repeated rows get the same score;
labels other than 0 and 1 are left out; of labels that disagree about one id
the smallest counts.  An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import label_sample, staged, text_mod, utf8_pieces, with_arrow_columns
from riskloom.llm.words import mix, word_bounds, word_hashes

DIMS = 1 << 18
THRESHOLD = 0.7
#: The share of the hinge-loss weights against their mean magnitude.
INTERPOLATION = 0.75
_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32


def _tails() -> np.ndarray:
    """The class of a word's last byte: letter 0, digit 1, high byte 2, each printable sign its own."""
    out = np.zeros(256, np.uint64)
    for b in range(256):
        out[b] = 2 if b >= 128 else 0 if chr(b).isalpha() else 1 if chr(b).isdigit() else 3 + b % 32 + 32 * (b >= 64)
    return out


_TAILS = _tails()
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """A small number for each word: how it is cased, how it ends, whether it repeats the word before it in its text."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    hashed = word_hashes(data, starts, ends)
    same = np.zeros(len(starts), bool)
    same[1:] = hashed[1:] == hashed[:-1]
    same[heads[heads < len(starts)]] = False
    second = np.minimum(starts + 1, ends - 1)
    case = _UPPER[data[starts]].astype(np.uint64) + _UPPER[data[second]] * np.uint64(2)
    alone = _TAILS[data[starts]] * (ends - starts == 1)
    return ((same * np.uint64(4) + case) * np.uint64(100) + _TAILS[data[ends - 1]]) * np.uint64(100) + alone.astype(np.uint64)


def features(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted places of the n-grams of each text of a block."""
    low = _LOWER[data]
    grams = (low[:-2] << 16 | low[1:-1] << 8 | low[2:]) * np.uint32(2654435761) >> np.uint32(14) if len(data) > 2 else low[:0]
    starts, ends, heads = word_bounds(data, offsets)
    shapes = _shapes(data, starts, ends, heads)
    runs = [mix(shapes + np.uint64(1))]
    for n in (2, 3):
        runs.append(mix(runs[-1][:max(0, len(shapes) - n + 1)] * np.uint64(3) + shapes[n - 1:] + np.uint64(n)))
    runs = [(r >> np.uint64(46)).astype(np.uint32) for r in runs]
    out = []
    seen = np.zeros(DIMS, bool)
    for k in range(len(offsets) - 1):
        seen[grams[offsets[k]:max(offsets[k], offsets[k + 1] - 2)]] = True
        for n, run in enumerate(runs):
            seen[run[heads[k]:max(heads[k], heads[k + 1] - n)]] = True
        own = np.flatnonzero(seen)
        seen[own] = False
        out.append(own)
    return out


@dataclass
class NbSvm:
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    @property
    def learned(self) -> bool:
        """False for the constant that a fit on fewer than two labels gives."""
        return bool(self.weights.any())

    def margin(self, own: np.ndarray) -> float:
        return float(self.weights[own].sum() / np.sqrt(max(1, len(own)))) + self.bias

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500)))


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """log((p + 1) / |p|) - log((q + 1) / |q|) of the indicator counts p of label 1 and q of label 0."""
    count = lambda v: 1.0 + np.bincount(np.concatenate([r for r, t in zip(rows, y) if t == v] or [np.zeros(0, int)]), minlength=DIMS)
    good, bad = count(1), count(0)
    return np.log(good / good.sum()) - np.log(bad / bad.sum())


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: np.ndarray, epochs: int, seed: int) -> np.ndarray:
    """Weights (the last is the bias) of the hinge-loss model: each step solves one row's multiplier exactly."""
    w, alpha = np.zeros(DIMS + 1), np.zeros(len(rows))
    square = np.array([v @ v + 1 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            own, v, sign = rows[i], values[i], y[i]
            slope = sign * (w[own] @ v + w[-1]) - 1
            new = min(max(alpha[i] - slope / square[i], 0.0), cost[i])
            if step := new - alpha[i]:
                w[own] += step * sign * v
                w[-1] += step * sign
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w


def fit(rows: list[np.ndarray], y: np.ndarray, cost: float = 1.0, epochs: int = 30, seed: int = 7) -> NbSvm:
    """Fit on four of five rows, set the logistic curve on the fifth; the same input gives the same model."""
    if len(set(y.tolist())) < 2:
        share = float(np.mean(y)) if len(y) else 0.0
        odds = np.log(max(share, 1e-9) / max(1 - share, 1e-9)) if len(y) else -np.inf
        return NbSvm(np.zeros(DIMS), 0.0, 0.0, float(max(odds, -500)))
    spare = np.arange(len(y)) % 5 == 4
    if len(set(y[spare].tolist())) < 2 or len(set(y[~spare].tolist())) < 2:
        spare = np.zeros(len(y), bool)
    train = np.flatnonzero(~spare)
    ratio = log_count_ratio([rows[i] for i in train], y[train])
    values = [ratio[rows[i]] / np.sqrt(max(1, len(rows[i]))) for i in train]
    balance = len(train) / (2 * np.bincount(y[train], minlength=2))
    w = dual_descent([rows[i] for i in train], values, 2.0 * y[train] - 1, cost * balance[y[train]], epochs, seed)
    mean = np.abs(w[:-1]).mean()
    model = NbSvm(((1 - INTERPOLATION) * mean + INTERPOLATION * w[:-1]) * ratio, INTERPOLATION * w[-1], 1.0, 0.0)
    check = np.flatnonzero(spare) if spare.any() else train
    margins = np.array([model.margin(rows[i]) for i in check])
    model.slope, model.shift = _logistic(margins, y[check])
    return model


def _logistic(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the curve from margin to probability (Newton steps, targets drawn in from 0 and 1)."""
    n1, n0 = y.sum(), (1 - y).sum()
    goal = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g = np.array([((p - goal) * margins).sum() + 1e-3 * a, (p - goal).sum()])
        s = p * (1 - p) + 1e-9
        h = np.array([[(s * margins * margins).sum() + 1e-3, (s * margins).sum()], [(s * margins).sum(), s.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
          per_label: int = 2000) -> NbSvm:
    """A model fitted on a bounded sample of those labelled rows outside the held-out fold whose text ``docs`` has."""
    marks = labels.where(F.col(label).isin(0, 1) & (text_mod(key, 4) != 2)).groupBy(key).agg(F.min(label).alias("mark"))
    texts = docs.where(F.col(text).isNotNull()).select(key, text)
    own = staged(marks.join(texts.select(key), key, "left_semi"), "marks")  # the sample is drawn from what can be learned from
    some = label_sample(own, "mark", key, per_label)
    found = texts.join(F.broadcast(some), key)  # as many rows as the sample
    found = with_arrow_columns(found.select(key, "mark", text), [text], _as_features, T.StructType(
        [T.StructField("own", T.BinaryType())])).select(F.col(key).cast("string").alias("k"), "mark", "own").collect()
    kept = sorted(((zlib.crc32(r["k"].encode()), r["k"], r["mark"], bytes(r["own"])) for r in found))
    return fit([np.frombuffer(r[3], np.int32) for r in kept], np.array([r[2] for r in kept], int))


def _as_features(texts: pa.Array) -> list[pa.Array]:
    return [pa.array([own.astype(np.int32).tobytes() for _, _, data, at in utf8_pieces(texts) for own in features(data, at)], pa.binary())]


def predict(df: DataFrame, model: NbSvm, text: str = "text") -> DataFrame:
    """``df`` with ``score`` and ``predicted`` (a column of one of these names is replaced)."""
    def compute(texts: pa.Array) -> list[pa.Array]:
        margins = np.array([model.margin(own) for _, _, data, at in utf8_pieces(texts) for own in features(data, at)])
        score = model.score(margins)
        return [pa.array(score, pa.float64()), pa.array((score >= THRESHOLD).astype(np.int32), pa.int32())]

    return with_arrow_columns(df, [text], compute, T.StructType([
        T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))
