"""Language ID: a byte convolutional network, trained in numpy, read over every window of a text.

Filters of several widths run over one-hot bytes (folded to a small
alphabet), the largest response of each filter in a window goes through a
rectifier into a softmax.  A text is cut into windows of ``WINDOW`` bytes,
the last one padded; the log probabilities of its windows are averaged by
their bytes.  Each task holds a few hundred windows at a time.

Fit: at most about ``per_lang`` texts of each language (chosen by a hash of
the id) and ``WINDOWS_A_TEXT`` windows of each; these bounds are the only
sample.  Prediction reads every byte of every text.

Edge cases: a null or empty text, or one without any letter (category L), is ``und`` with
score 0.  Rows without a language are never learned from.  With no row to
learn from, every text is ``und``.  Ties go to the language that sorts
first.  Repeated rows get the same answer; an empty table gives none.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import label_sample, text_mod, utf8_pieces, with_arrow_columns

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
WINDOWS_A_TEXT = 4
UNDETERMINED = "und"
_CHUNK = 256
#: A letter is a character of the Unicode categories L, in the pipeline too.
LETTER = r"\p{L}"
_LETTER = regex.compile(LETTER)


def _alphabet() -> np.ndarray:
    """Bytes to symbols: 0 padding and control, one each for space, digits, other signs and every letter; high bytes their own."""
    fold = np.zeros(256, np.int64)
    for b in range(256):
        c = chr(b)
        fold[b] = (4 + ord(c.lower()) - 97) if c.isascii() and c.isalpha() else b - 128 + 30 if b >= 128 else (
            1 if c.isspace() else 2 if c.isdigit() else 3 if c.isprintable() else 0)
    return fold


FOLD = _alphabet()
SYMBOLS = int(FOLD.max()) + 1


@dataclass
class ByteCnn:
    languages: list[str]
    #: For each width: (width, SYMBOLS, FILTERS), the weight of each filter for a symbol at an offset.
    tables: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def pooled(self, windows: np.ndarray, where: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
        """The rectified largest response of each filter in each window; and its place, if asked for."""
        best, at = [], []
        for table in self.tables:
            w = len(table)
            n = windows.shape[1] - w + 1
            sums = table[0].take(windows[:, :n], 0)
            for j in range(1, w):
                sums += table[j].take(windows[:, j:n + j], 0)
            best.append(sums.max(1))
            if where:
                at.append(sums.argmax(1))
        return np.maximum(np.concatenate(best, 1) + self.bias, 0), at

    def log_odds(self, windows: np.ndarray) -> np.ndarray:
        z = self.pooled(windows)[0] @ self.out + self.out_bias
        z -= z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))


def cut(data: np.ndarray) -> np.ndarray:
    """The folded windows of one text's bytes, the last one padded with 0."""
    out = np.zeros((max(1, -(-len(data) // WINDOW)), WINDOW), np.int64)
    out.ravel()[:len(data)] = FOLD[data]
    return out


def fit(texts: list[bytes], langs: list[str], epochs: int = 8, batch: int = 128, rate: float = 0.01, seed: int = 7) -> ByteCnn:
    """Train on windows of the texts with Adam; the same input gives the same network."""
    names = sorted(set(langs))
    rng = np.random.default_rng(seed)
    rows, marks = [], []
    for text, lang in zip(texts, langs):
        own = cut(np.frombuffer(text, np.uint8))
        for k in rng.choice(len(own), min(len(own), WINDOWS_A_TEXT), replace=False):
            window = own[k].copy()
            if rng.random() < 0.25:  # short texts come too
                window[int(rng.integers(6, WINDOW)):] = 0
            rows.append(window)
            marks.append(names.index(lang))
    x, y = np.array(rows), np.array(marks)
    total = len(WIDTHS) * FILTERS
    net = ByteCnn(names, [rng.normal(0, 0.3, (w, SYMBOLS, FILTERS)).astype(np.float32) for w in WIDTHS],
                  np.zeros(total, np.float32), rng.normal(0, 0.3, (total, len(names))).astype(np.float32),
                  np.zeros(len(names), np.float32))
    params = [*net.tables, net.bias, net.out, net.out_bias]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    weight = (len(y) / (len(names) * np.bincount(y, minlength=len(names)))).astype(np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for s in range(0, len(x), batch):
            pick = order[s:s + batch]
            windows, truth = x[pick], y[pick]
            hidden, at = net.pooled(windows, True)
            z = hidden @ net.out + net.out_bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(pick)), truth] -= 1
            p *= (weight[truth] / len(pick))[:, None]
            back = (p @ net.out.T) * (hidden > 0)
            grads = [np.zeros_like(t) for t in net.tables]
            for i, (grad, place) in enumerate(zip(grads, at)):
                flow = back[:, i * FILTERS:(i + 1) * FILTERS]
                column = np.broadcast_to(np.arange(FILTERS), place.shape)
                for j in range(len(grad)):
                    np.add.at(grad[j], (np.take_along_axis(windows, place + j, 1), column), flow)
            step += 1
            for g, p_, m, v in zip([*grads, back.sum(0), hidden.T @ p, p.sum(0)], params, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p_ -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return net


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_lang: int = 600) -> ByteCnn | None:
    """A network fitted on a bounded sample of the labelled rows; None if there is none."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    found = label_sample(rows, lang, key, per_lang).select(
        F.col(key).cast("string").alias("k"), F.col(lang).alias("lang"), _windows_of(F.col(text)).alias("text")).collect()
    found = sorted(((r["k"] or "", r["lang"], bytes(r["text"])) for r in found), key=lambda r: (zlib.crc32(r[0].encode()), r))
    return fit([r[2] for r in found], [r[1] for r in found]) if found else None


def _windows_of(text):
    """What a text can give to the fit: a stretch from a place that its hash chooses, of a bounded number of bytes."""
    raw, most = text.cast("binary"), WINDOW * WINDOWS_A_TEXT * 2
    room = F.greatest(F.octet_length(raw) - most, F.lit(0))
    return F.substring(raw, F.pmod(F.xxhash64(text), (room + 1).cast("long")).cast("int") + 1, F.lit(most))


def predict(df: DataFrame, net: ByteCnn | None, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score`` (a column of one of these names is replaced)."""
    def compute(texts: pa.Array) -> list[pa.Array]:
        langs, scores = [], []
        letters = [bool(_LETTER.search(v.as_py() or "")) for v in texts]
        for first, last, data, at in utf8_pieces(texts):
            for k in range(first, last):
                if net is None or not letters[k]:
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
            if net is None:
                continue
            asked = [k for k in range(first, last) if letters[k]]
            if not asked:
                continue
            del langs[first:], scores[first:]
            sizes = np.array([at[k - first + 1] - at[k - first] for k in asked])
            counts = -(-sizes // WINDOW)
            windows = np.zeros((counts.sum(), WINDOW), np.int64)
            flat, row = windows.ravel(), 0
            for k, n, c in zip(asked, sizes, counts):
                s = at[k - first]
                flat[row * WINDOW:row * WINDOW + n] = FOLD[data[s:s + n]]
                row += c
            odds = np.concatenate([net.log_odds(windows[s:s + _CHUNK]) for s in range(0, len(windows), _CHUNK)])
            share = np.full(len(windows), float(WINDOW))
            share[np.cumsum(counts) - 1] = sizes - (counts - 1) * WINDOW
            mean = np.add.reduceat(odds * share[:, None], np.cumsum(counts) - counts, 0) / sizes[:, None]
            p = np.exp(mean - mean.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            best = dict(zip(asked, zip(p.argmax(1), p.max(1))))
            for k in range(first, last):
                i, s = best.get(k, (None, 0.0))
                langs.append(UNDETERMINED if i is None else net.languages[i])
                scores.append(float(s))
        return [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]

    return with_arrow_columns(df, [text], compute, T.StructType([
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def learnable(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows that may be learned from: all but the held-out fold."""
    return docs.where(text_mod(key, 5) != 0)
