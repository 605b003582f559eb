"""HTML extraction: a bidirectional LSTM, trained in numpy, labels every block of a page in the light of all others.

A page is the sequence of its text blocks (see ``html``).  Each block is read
as the sum of three parts: the embeddings of its tag path's hashed tokens, the
mean embedding of its hashed words, and a few numbers of its shape.  One LSTM
reads the sequence forwards, one backwards; both states and the block decide
whether it is main text.  The blocks so labelled are joined by an empty line.

Fit: ``PAGES`` made pages (see ``layouts``), whose prose uses words of at most
``SAMPLE`` different given pages, chosen by a hash of their html, from at most
``SAMPLE_CHARS`` characters of each; these bounds are the only sample.  The same table gives the same network.  Every block of every
page is read whole; a task holds the blocks of about ``GROUP`` at once and one
page's at least, and pages are independent of each other.

Edge cases: a null or empty html, or one without a main block, gives an empty
text of 0 characters.  Text outside any element is a block; markup that is
broken or cut off is read as far as it goes.  Null urls and ids stay null,
repeated rows get the same answer; an empty table gives none.  A column of the
input named like a result is replaced, all others stay.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import with_arrow_columns
from riskloom.llm.html import Paths, blocks
from riskloom.llm.layouts import Maker
from riskloom.llm.words import word_bounds, word_hashes

PAGES, EPOCHS, SAMPLE, SAMPLE_CHARS = 1000, 8, 200, 20_000
BUCKETS, WORDS, SIZE, HIDDEN, SHAPES = 8192, 8192, 24, 24, 6
#: Blocks that a task labels at once, about; and its paths before they are met anew.
GROUP, MOST_PATHS = 20_000, 100_000


def word_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hashed words of all texts, and each text's first (one more entry at the end)."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    at = np.cumsum([0, *map(len, raw)])
    starts, ends, firsts = word_bounds(data, at)
    return (word_hashes(data, starts, ends) % np.uint64(WORDS)).astype(np.int64), firsts


def shapes(texts: list[str], linked: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Length in words, share in links, the kind of the last sign, digits, length of words."""
    sizes = np.array([len(t) for t in texts], np.float32)
    return np.stack([np.log1p(n_words) / 4, linked, linked > 0.8, np.array([t[-1] in ".!?:;…\"”»)" for t in texts]),
                     np.array([t[0].isdigit() for t in texts]), np.log1p(sizes / np.maximum(n_words, 1))], 1).astype(np.float32)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-z))


def _step(z: np.ndarray, c: np.ndarray) -> tuple:
    h = z.shape[1] // 4
    gates = _sigmoid(z[:, :3 * h])
    i, f, o, g = gates[:, :h], gates[:, h:2 * h], gates[:, 2 * h:], np.tanh(z[:, 3 * h:])
    c = f * c + i * g
    t = np.tanh(c)
    return c, o * t, (i, f, o, g, t)


@dataclass
class BlockLabeller:
    path: np.ndarray
    word: np.ndarray
    shape: np.ndarray
    bias: np.ndarray
    #: For each direction: from the input, from the state, bias.
    lstm: list[list[np.ndarray]]
    out: np.ndarray
    out_bias: np.ndarray
    cache: dict = field(default_factory=dict)

    def __getstate__(self):
        return self.__dict__ | {"cache": {}}

    def inputs(self, paths: Paths, places: np.ndarray, texts: list[str], linked: np.ndarray) -> np.ndarray:
        """One row for each block; the part of a path is computed once for the path."""
        seen = self.cache.setdefault("rows", np.zeros((0, SIZE), np.float32))
        if len(seen) < len(paths.tokens):
            new = [self.path[list(t)].sum(0) / np.sqrt(len(t)) for t in (own or (0,) for own in paths.tokens[len(seen):])]
            seen = self.cache["rows"] = np.concatenate([seen, np.array(new, np.float32)])
        buckets, firsts = word_buckets(texts)
        n = np.diff(firsts)
        sums = np.add.reduceat(self.word[buckets], firsts[:-1], 0) / n[:, None]
        return np.tanh(seen[places] + sums.astype(np.float32) + shapes(texts, linked, n) @ self.shape + self.bias)

    def read(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The chance of being main text of each block of several pages, whose blocks follow each other in ``x``."""
        order = np.argsort(-lengths, kind="stable")
        first = (np.cumsum(lengths) - lengths)[order]
        sizes = lengths[order]
        alive = np.searchsorted(-sizes, -np.arange(sizes[0]), "left")  # pages that have a block at each step
        total = x @ self.out[2 * HIDDEN:] + self.out_bias
        for d, (wx, wh, b) in enumerate(self.lstm):
            z = x @ wx + b
            h = c = np.zeros((len(sizes), HIDDEN), np.float32)
            for t, n in enumerate(alive):
                rows = first[:n] + (t if d == 0 else sizes[:n] - 1 - t)
                c, h, _ = _step(z[rows] + h[:n] @ wh, c[:n])
                total[rows] += h @ self.out[d * HIDDEN:(d + 1) * HIDDEN]
        return _sigmoid(total[:, 0])

    def label(self, pages: list[list[tuple[int, str, float]]], paths: Paths) -> list[np.ndarray]:
        """For each page the chances of its blocks."""
        lengths = np.array([len(p) for p in pages])
        some = np.flatnonzero(lengths)
        if not len(some):
            return [np.zeros(0)] * len(pages)
        flat = [b for p in pages for b in p]
        x = self.inputs(paths, np.array([b[0] for b in flat]), [b[1] for b in flat], np.array([b[2] for b in flat], np.float32))
        return np.split(self.read(x, lengths[some]), np.cumsum(lengths)[:-1])


@dataclass
class Example:
    """A page made ready for the fit: paths, words and shapes of its blocks, one after the other."""

    places: np.ndarray
    words: np.ndarray
    n_words: np.ndarray
    shape: np.ndarray
    truth: np.ndarray

    @classmethod
    def of(cls, page: list[tuple[int, str, float]], labels: list[int]) -> Example:
        texts = [b[1] for b in page]
        words, firsts = word_buckets(texts)
        n = np.diff(firsts)
        return cls(np.array([b[0] for b in page]), words, n, shapes(texts, np.array([b[2] for b in page], np.float32), n), np.array(labels, np.float32))


def fit(words: list[str], pages: int = PAGES, epochs: int = EPOCHS, batch: int = 40, rate: float = 0.01, seed: int = 11) -> BlockLabeller:
    """Train on made pages with Adam; the same words give the same network."""
    maker, rng, paths = Maker(words, seed), np.random.default_rng(seed), Paths(BUCKETS)
    made = []
    for _ in range(pages):
        html, labels = maker.page()
        found = blocks(html, paths)
        if len(found) != len(labels):
            raise ValueError("a made page was read as another number of blocks than it was made of")
        if found:
            made.append(Example.of(found, labels))
    normal = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
    net = BlockLabeller(rng.normal(0, 0.3, (BUCKETS, SIZE)).astype(np.float32), rng.normal(0, 0.1, (WORDS, SIZE)).astype(np.float32),
                        normal(SHAPES, SIZE), np.zeros(SIZE, np.float32),
                        [[normal(SIZE, 4 * HIDDEN), normal(HIDDEN, 4 * HIDDEN), np.zeros(4 * HIDDEN, np.float32)] for _ in range(2)],
                        normal(2 * HIDDEN + SIZE, 1), np.zeros(1, np.float32))
    params = [net.path, net.word, net.shape, net.bias, *net.lstm[0], *net.lstm[1], net.out, net.out_bias]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    total = epochs * -(-len(made) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(made))
        runs = [sorted(order[s:s + 6 * batch], key=lambda i: -len(made[i].truth)) for s in range(0, len(made), 6 * batch)]
        picks = [run[s:s + batch] for run in runs for s in range(0, len(run), batch)]  # pages of like length together
        for k in rng.permutation(len(picks)):
            grads = _gradients(net, [made[i] for i in picks[k]], paths, rng)
            step += 1
            now = rate * min(1.0, 2.2 * (1 - step / (total + 1)))
            for g, p, m, v in zip(grads, params, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= now * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return net


def _gradients(net: BlockLabeller, pages: list[Example], paths: Paths, rng: np.random.Generator) -> list[np.ndarray]:
    """The gradients of the mean log loss over the blocks of the pages, longest page first."""
    sizes = np.array([len(p.truth) for p in pages])
    joined = lambda name: np.concatenate([getattr(p, name) for p in pages])
    truth, shape, places, bucket, n = map(joined, ("truth", "shape", "places", "words", "n_words"))
    word_owner = np.repeat(np.arange(len(truth)), n)
    places, place = np.unique(places, return_inverse=True)
    tokens = [paths.tokens[p] or (0,) for p in places.tolist()]
    counts = np.array([len(t) for t in tokens])
    token, owner = np.array([t for own in tokens for t in own]), np.repeat(np.arange(len(tokens)), counts)
    keep = rng.random(len(token)) > 0.15  # names come and go, so that no single one decides
    scale = (keep / np.sqrt(counts)[owner])[:, None].astype(np.float32)
    x = np.add.reduceat(net.path[token] * scale, np.cumsum(counts) - counts, 0)[place]
    share = (1 / n)[word_owner][:, None].astype(np.float32)
    x += np.add.reduceat(net.word[bucket] * share, np.cumsum(n) - n, 0)
    x = np.tanh(x + shape @ net.shape + net.bias)
    first = np.cumsum(sizes) - sizes
    alive = np.searchsorted(-sizes, -np.arange(sizes[0]), "left")
    total = x @ net.out[2 * HIDDEN:] + net.out_bias
    tapes = []
    for d, (wx, wh, b) in enumerate(net.lstm):
        z, tape = x @ wx + b, []
        h = c = np.zeros((len(sizes), HIDDEN), np.float32)
        for t, k in enumerate(alive):
            rows = first[:k] + (t if d == 0 else sizes[:k] - 1 - t)
            before = (h[:k], c[:k])
            c, h, gates = _step(z[rows] + before[0] @ wh, before[1])
            total[rows] += h @ net.out[d * HIDDEN:(d + 1) * HIDDEN]
            tape.append((rows, before, h, gates))
        tapes.append(tape)
    delta = ((_sigmoid(total[:, 0]) - truth) / len(truth))[:, None].astype(np.float32)
    out = np.zeros_like(net.out)
    out[2 * HIDDEN:] = x.T @ delta
    dx = delta @ net.out[2 * HIDDEN:].T
    lstm = []
    for d, (wx, wh, b) in enumerate(net.lstm):
        own = net.out[d * HIDDEN:(d + 1) * HIDDEN].T
        dz_all, dwh = np.zeros((len(truth), 4 * HIDDEN), np.float32), np.zeros_like(wh)
        dh_next = dc_next = np.zeros((0, HIDDEN), np.float32)
        for rows, (h0, c0), h, (i, f, o, g, tc) in reversed(tapes[d]):
            out[d * HIDDEN:(d + 1) * HIDDEN] += h.T @ delta[rows]
            dh = delta[rows] @ own
            dh[:len(dh_next)] += dh_next
            dc = dh * o * (1 - tc * tc)
            dc[:len(dc_next)] += dc_next
            dz = np.concatenate([dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
            dz_all[rows] = dz
            dwh += h0.T @ dz
            dh_next, dc_next = dz @ wh.T, dc * f
        lstm.append([x.T @ dz_all, dwh, dz_all.sum(0)])
        dx += dz_all @ wx.T
    dx *= 1 - x * x
    path, word = _summed(token, _summed(place, dx, len(places))[owner] * scale, BUCKETS), _summed(bucket, dx[word_owner] * share, WORDS)
    return [path, word, shape.T @ dx, dx.sum(0), *lstm[0], *lstm[1], out, delta.sum(0)]


def _summed(index: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """The sums of the rows of each index from 0 to n - 1."""
    out = np.zeros((n, rows.shape[1]), np.float32)
    order = np.argsort(index, kind="stable")
    index = index[order]
    new = np.flatnonzero(np.diff(index, prepend=-1))
    out[index[new]] = np.add.reduceat(rows[order], new, 0)
    return out


def train(pages: DataFrame, html: str = "html", sample: int = SAMPLE) -> BlockLabeller:
    """A network for these pages: made pages with words of a bounded sample of them, a page that repeats counting once."""
    rows = pages.where(F.col(f"`{html}`").isNotNull()).select(F.col(f"`{html}`").alias("html"), F.xxhash64(F.col(f"`{html}`")).alias("h"))
    last = rows.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    own = F.substring(F.regexp_replace("html", r"(?s)<[^>]*>|&\w+;", " "), 1, SAMPLE_CHARS)
    found = rows.where(F.col("h") <= F.lit(last)).groupBy("h").agg(F.min(own).alias("t")).collect() if last is not None else []
    return fit(sorted({w for r in found for w in r["t"].split()}))


def extract(df: DataFrame, net: BlockLabeller, html: str = "html") -> DataFrame:
    """``df`` with ``text``, ``n_chars`` (its code points), ``n_blocks`` and ``n_main`` (its blocks, and those of the text)."""
    state: dict = {}

    def compute(column: pa.Array) -> list[pa.Array]:
        texts, n_blocks, n_main = [], [], []
        group: list = []

        def close() -> None:
            for page, chances in zip(group, net.label(group, state["paths"])):
                kept = [b[1] for b, p in zip(page, chances) if p >= 0.5]
                texts.append("\n\n".join(kept))
                n_blocks.append(len(page))
                n_main.append(len(kept))
            group.clear()

        size = 0
        for value in column:
            if "paths" not in state or len(state["paths"].tokens) > MOST_PATHS:
                if group:
                    close()
                state["paths"], size = Paths(BUCKETS), 0
                net.cache.clear()
            page = blocks(value.as_py() or "", state["paths"])
            if group and size + len(page) > GROUP:
                close()
                size = 0
            group.append(page)
            size += len(page)
        close()
        return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(n_blocks, pa.int64()),
                pa.array(n_main, pa.int64())]

    return with_arrow_columns(df, [html], compute, T.StructType([
        T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("n_blocks", T.LongType()),
        T.StructField("n_main", T.LongType())]))
