"""BPE by backtracking over longest matches; decoding through an offset table.

An Aho-Corasick automaton of the vocabulary proposes the longest token at
each place of a word.  A sequence of tokens is the result of the merges
exactly when no border between neighbours would have been merged away before
they were complete; a table keeps the answer for each pair.  Where the longest
token does not fit behind the last one, shorter prefixes are tried and then
the last token is taken back; places that lead nowhere are marked, so the
work stays linear.  Decoding copies the bytes of all tokens out of one buffer
by their offsets.

Words repeat, so each Python worker remembers the ids of recent chunks of text
between spaces (at most ``MEMO`` of them, short ones only).

Edge cases: a null text counts as empty and has no ids.  The strings of the
vocabulary's special tokens are special tokens, as in the library.  Long
texts and long runs without a space are encoded whole.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Callable

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from riskloom.llm.common import with_arrow_columns

#: Chunks of text whose ids a worker remembers, and the longest chunk that it does.
MEMO, MEMO_CHARS = 120_000, 48
_WORD_END = "</w>"
#: Final signs of a word are moved here, so that tokens with the word end are plain strings.
_FINAL = 0xE000


@functools.cache
def byte_signs() -> list[str]:
    """The sign that stands for each byte in the vocabulary: itself if printable Latin-1, else the next free one."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Merges:
    """The merges of a vocabulary file whose ids follow the order of the merges."""

    def __init__(self, model: dict) -> None:
        vocab = model["vocab"]
        self.strings: dict[int, str] = {}
        for token, i in vocab.items():
            if len(token) == 1 or len(token) == 1 + len(_WORD_END) and token.endswith(_WORD_END):
                self.strings[i] = token if len(token) == 1 else chr(_FINAL + ord(token[0]))
        self.base = len(self.strings)
        if self.base != 512:
            raise ValueError("the vocabulary needs every byte sign, alone and at a word's end")
        self.parts: dict[int, tuple[int, int]] = {}
        self.joins: dict[tuple[int, int], int] = {}
        last = self.base - 1
        for left, right in (m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            i, a, b = vocab[left + right], vocab[left], vocab[right]
            if i <= last:
                raise ValueError("token ids do not follow the order of the merges")
            last = i
            self.parts[i], self.joins[a, b] = (a, b), i
            self.strings[i] = self.strings[a] + self.strings[b]
        self.lengths = {i: len(s) for i, s in self.strings.items()}
        self.fits: dict[tuple[int, int], bool] = {}
        made = {i: True for i in range(self.base)}
        for i, (a, b) in self.parts.items():  # a token that its own string never becomes is no candidate
            made[i] = made[a] and made[b] and self.border_holds(a, b, i)
        self.ids = {s: i for i, s in self.strings.items() if made.get(i)}
        self.shorter = {i: next((self.ids[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in self.ids), None)
                        for s, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        self.automaton = ahocorasick.Automaton()
        for s, i in self.ids.items():
            self.automaton.add_word(s, i)
        self.automaton.make_automaton()

    def border_holds(self, left: int, right: int, before: int = 1 << 62) -> bool:
        """Whether no merge earlier than ``before`` crosses the border: both sides are unmade in reverse order."""
        while True:
            crossing = self.joins.get((left, right))
            if crossing is not None and crossing < before:
                return False
            if max(left, right) < self.base:
                return True
            if left > right:
                before, left = left, self.parts[left][1]
            else:
                before, right = right + 1, self.parts[right][0]

    def compatible(self, left: int, right: int) -> bool:
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) > 2_000_000:
                self.fits.clear()
            known = self.fits[left, right] = self.border_holds(left, right)
        return known

    def encode(self, word: str) -> list[int]:
        """The ids of a word given as byte signs."""
        word = word[:-1] + chr(_FINAL + ord(word[-1]))
        whole = self.ids.get(word)
        if whole is not None:
            return [whole]
        found, last, at, fits, lengths = [], None, 0, self.fits, self.lengths
        for _, i in self.automaton.iter_long(word):
            if last is not None and not (fits.get((last, i)) or self.compatible(last, i)):
                return self._backtrack(word, found, at, self.shorter[i])
            found.append(i)
            at += lengths[i]
            last = i
        return found

    def _longest(self, word: str, at: int) -> int | None:
        """The longest token that begins at a place."""
        rest = word[at:at + self.longest]
        for size in range(self.automaton.longest_prefix(rest), 0, -1):
            if (token := self.ids.get(rest[:size])) is not None:
                return token
        return None

    def _backtrack(self, word: str, out: list[int], at: int, token: int | None) -> list[int]:
        """Go on from the tokens found so far, of which the next one must be ``token`` or a shorter one; no place is lost twice."""
        lost, fits, lengths, shorter, end = bytearray(len(word) + 1), self.fits, self.lengths, self.shorter, len(word)
        while at < end:
            while token is not None:
                if not lost[at + lengths[token]]:
                    if not out:
                        break
                    fit = fits.get((out[-1], token))
                    if fit if fit is not None else self.compatible(out[-1], token):
                        break
                token = shorter[token]
            if token is not None:
                out.append(token)
                at += lengths[token]
                token = self._longest(word, at) if at < end else None
            elif out:
                lost[at] = 1
                last = out.pop()
                at -= lengths[last]
                token = shorter[last]
            else:
                raise ValueError("the vocabulary lacks a sign of the word")
        return out


def _class(kind: str, low: int = 0x21, high: int = 0x180) -> str:
    return "".join(re.escape(chr(c)) for c in range(low, high) if unicodedata.category(chr(c))[0] == kind)


#: Signs whose case and composition every Unicode version agrees on: printable ASCII, white space, Latin letters.
_PLAIN = re.compile("[^\\x20-\\x7e\t\n\v\f\r" + "".join(
    chr(c) for c in range(0xA1, 0x180) if c not in (0xAD, 0x130, 0x149, 0x17F)) + "]")
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_class('L')}]+|[{_class('N')}]|[^\s{_class('L')}{_class('N')}]+")


class TextEncoder(dict):
    """Ids of texts from ids of words; as a dict it remembers the ids (as bytes) of chunks between spaces."""

    def __init__(self, path: str, word_ids: Callable[[str], list[int]] | None = None) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.word_ids = word_ids or Merges(spec["model"]).encode
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")").split
        self.signs, self.older = byte_signs(), {}
        names = {i: s for s, i in spec["model"]["vocab"].items()} | {i: s for s, i in self.special.items()}
        self.table, self.offsets = offset_table([names.get(i, "") for i in range(max(names) + 1)])
        self.digits, self.digit_offsets = offset_table([str(i) for i in range(max(names) + 1)])

    def __missing__(self, chunk: str) -> bytes:
        """The ids of a chunk that isn't remembered; of two generations of chunks the older one goes when the newer one is full."""
        found = self.older.get(chunk)
        if found is None:
            words = _PIECES.findall(chunk)
            if len(words) == 1 and words[0] == chunk:  # printable ASCII signs stand for themselves
                signs = chunk if chunk.isascii() else "".join([self.signs[b] for b in chunk.encode()])
                found = array("I", self.word_ids(signs)).tobytes()
            else:
                return b"".join([self[w] for w in words])
        if len(chunk) <= MEMO_CHARS:
            if len(self) >= MEMO // 2:
                self.older = dict(self)
                self.clear()
            self[chunk] = found
        return found

    def encode(self, text: str) -> bytes:
        """The ids of a text as 32-bit little-endian numbers."""
        if "<|" not in text:
            return self._segment(text)
        return b"".join(np.uint32(self.special[s]).tobytes() if s in self.special else self._segment(s)
                        for s in self.split_special(text))

    def _segment(self, text: str) -> bytes:
        if not _PLAIN.search(text):
            return b"".join(map(self.__getitem__, text.lower().split()))
        words = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(text))
        return b"".join(np.array(self.word_ids(w), np.uint32).tobytes() for w, _ in words)

    def decode(self, ids: np.ndarray) -> bytes:
        """The UTF-8 bytes of the tokens' strings, joined by one space (the vocabulary names no decoder)."""
        return gather(ids, self.table, self.offsets)

    def decimal(self, ids: np.ndarray) -> bytes:
        return gather(ids, self.digits, self.digit_offsets)


def offset_table(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All strings, each with a space behind it, in one buffer; and where each begins."""
    raw = [s.encode() + b" " for s in strings]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])


def gather(ids: np.ndarray, table: np.ndarray, offsets: np.ndarray, run: int = 1 << 16) -> bytes:
    """The strings of the ids, joined by one space; some tens of thousands of ids at a time."""
    out = []
    for s in range(0, len(ids), run):
        own = ids[s:s + run]
        sizes = offsets[own + 1] - offsets[own]
        ends = np.cumsum(sizes)
        out.append(table[np.arange(ends[-1]) + np.repeat(offsets[own] - ends + sizes, sizes)].tobytes())
    return b"".join(out)[:-1]


@functools.cache
def backtracking_encoder(path: str) -> TextEncoder:
    """One per worker process."""
    return TextEncoder(path)


def encode_decode(df: DataFrame, path: str, text: str = "text", keep_ids: bool = False) -> DataFrame:
    """``df`` with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``; with ``keep_ids`` also ``ids`` and ``decoded``.

    A column of ``df`` with one of these names is replaced.
    """
    def compute(texts: pa.Array) -> list[pa.Array]:
        encoder = backtracking_encoder(path)
        rows = []
        for value in texts:
            raw = encoder.encode(value.as_py() or "")
            ids = np.frombuffer(raw, np.uint32).astype(np.int64)
            decoded = encoder.decode(ids)
            row = [len(ids), hashlib.sha256(encoder.decimal(ids)).hexdigest(), hashlib.sha256(decoded).hexdigest()]
            rows.append((*row, ids, decoded.decode()) if keep_ids else row)
        columns = list(zip(*rows)) or [()] * len(types)
        return [pa.array(list(c), t) for c, t in zip(columns, types)]

    types = [pa.int64(), pa.string(), pa.string(), *([pa.list_(pa.int64()), pa.string()] if keep_ids else [])]
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
              T.StructField("decoded_sha256", T.StringType())]
    if keep_ids:
        fields += [T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("decoded", T.StringType())]
    return with_arrow_columns(df, [text], compute, T.StructType(fields))
