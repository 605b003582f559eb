"""Sharding, personal data, language ID, BPE, quality, packing: against brute force, the library, held-out labels and laws."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_fixtures import SF, documents, no_docs, odd_docs, odd_texts  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskloom.llm import bpe, langid, packing, pii, quality, shards
from riskloom.llm.queries import QUERIES, vocabulary

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(PATH)
    made.no_truncation()
    made.no_padding()
    return made


# ---------------------------------------------------------------- sharding
def least_capacity(groups, k):
    """Brute force: the smallest largest sum of k contiguous runs."""
    best = {0: 0}
    sums = [0, *itertools.accumulate(groups)]
    for _ in range(k):
        best = {e: min(max(v, sums[e] - sums[s]) for s, v in best.items() if s <= e) for e in range(len(sums))}
    return best[len(groups)]


def check_shards(rows, texts, k):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    assert len(rows) == len(texts)
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    homes = defaultdict(set)
    sizes = Counter()
    for r in rows:
        text = texts[r.doc_id]
        raw = (text or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        homes[text].add(r.shard)
        sizes[text] += r["size"]
    assert all(len(h) == 1 for h in homes.values())
    order = sorted(sizes, key=lambda t: "null" if t is None else hashlib.sha256(t.encode()).hexdigest())
    assert max(sum(r["size"] for r in own) for own in by.values()) == least_capacity([sizes[t] for t in order], k)


@pytest.mark.parametrize("k", [1, 3, 8, 40])
def test_shards_are_minimax(odd_docs, k):
    rows = shards.minimax_shards(odd_docs, k).collect()
    texts = {r.doc_id: r.text for r in odd_docs.collect()}
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in odd_docs.collect())
    distinct = {r.doc_id: r for r in rows}
    assert distinct[5].shard == distinct[6].shard
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    once = shards.minimax_shards(odd_docs.dropDuplicates(["doc_id"]), k).collect()
    check_shards(once, texts, k)


def test_shards_of_hot_group_and_nothing(spark, no_docs):
    texts = {i: "same" if i % 3 else f"own {i}" for i in range(300)}
    rows = shards.minimax_shards(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    check_shards(rows, texts, 8)
    assert shards.minimax_shards(no_docs).count() == 0


# ---------------------------------------------------------------- personal data
def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
                          ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and max(map(int, m[0].split("."))) <= 255
                    or kind == "card" and 16 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 8 <= len(digits) <= 15):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def found(df):
    r = pii.find_personal_data(df.select("doc_id", "text"))
    return r.select("text", pii.span_text(F.col("base_spans")).alias("base"), pii.span_text(F.col("added_spans")).alias("added")).collect()


def test_base_spans_equal_plain_patterns(documents, odd_docs):
    for r in found(documents) + found(odd_docs):
        assert r.base == base_spans(r.text or "")


def test_columns_named_like_kinds_stay(spark):
    names = ["email", "ip", "card", "phone", "iban", "account", "_hits", "_body", "c0"]
    df = spark.createDataFrame([tuple(f"{n}@a.org" for n in names)], names)
    for text in names:
        row = pii.find_personal_data(df, text).first()
        assert all(row[n] == f"{n}@a.org" for n in names)
        assert [(x.kind, x.start, x.end) for x in row.base_spans] == [("email", 0, len(text) + 6)]
        assert pii.mask_personal_data(df, text).first()[text] == "[EMAIL]"


def test_base_spans_of_random_texts(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab1290.@+-_% ()é😀") for _ in range(rng.randint(0, 80))) for _ in range(3000)]
    texts += [" ".join(f"u{i}@h.org" for i in range(1200)), "1.2.3.4." * 700, "a@" * 900 + "b.c", "+1" * 500]
    for r in found(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")):
        assert r.base == base_spans(r.text)


def test_checksums_and_context(spark):
    texts = {0: "IBAN GB82 WEST 1234 5698 7654 32.", 1: "GB83 WEST 1234 5698 7654 32", 2: "credit card 378282246310005", 3: "number 378282246310005"}
    got = {r.text: r.added for r in found(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))}
    assert [got[t] for t in texts.values()] == ["iban:5:32", "", "account:12:27", ""]


def test_masking_keeps_columns(odd_docs, no_docs):
    masked = pii.mask_personal_data(odd_docs)
    assert masked.columns == odd_docs.columns and masked.dtypes == odd_docs.dtypes
    rows = {r.doc_id: r for r in masked.collect()}
    assert rows[13].text == "mail [EMAIL], ip [IP], [PHONE], [CARD]" and rows[0].text is None and rows[13].base_spans == 1
    assert pii.mask_personal_data(no_docs).count() == 0


# ---------------------------------------------------------------- language ID
def test_language_held_out_accuracy(spark, documents):
    got = QUERIES["op3_language_id"](spark, SF).join(documents.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 100 and np.mean([r.lang == r.lang_pred for r in got]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_signs_that_are_no_letters_are_undetermined(spark):
    net = langid.fit([b"abab" * 90, b"xyxy" * 90] * 3, ["a", "x"] * 3, epochs=1)
    texts = ["½²", "²", "①½ ³", "_", "7", "ª", "ʰ", "中", "é"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = langid.predict(df, net).orderBy("doc_id").collect()
    assert [r.lang_pred == "und" for r in rows] == [True] * 5 + [False] * 4
    assert [r.doc_id for r in df.where(F.col("text").rlike(langid.LETTER)).collect()] == [5, 6, 7, 8]


def test_language_edge_cases(odd_docs, no_docs):
    assert langid.train(no_docs) is None
    rng = random.Random(1)
    net = langid.fit([bytes(rng.choice(b"abc ") for _ in range(300)) for _ in range(40)] + [bytes(rng.choice(b"xyz ") for _ in range(300)) for _ in range(40)],
                     ["a"] * 40 + ["x"] * 40)
    rows = {r.doc_id: r for r in langid.predict(odd_docs.drop("score"), net).collect()}
    assert [rows[i].lang_pred for i in range(4)] == ["und"] * 4 and rows[0].score == 0
    assert rows[9].lang_pred == "a" and rows[10].lang_pred == "x" and rows[10].score > 0.9
    assert langid.predict(no_docs, net).count() == 0
    assert {r.lang_pred for r in langid.predict(odd_docs, None).collect()} == {"und"}


def test_convolution_against_plain_loops():
    rng = np.random.default_rng(0)
    net = langid.fit([b"abab" * 90, b"xyxy" * 90] * 3, ["a", "x"] * 3, epochs=1)
    windows = rng.integers(0, langid.SYMBOLS, (3, langid.WINDOW))
    want = []
    for w in windows:
        row = [max(sum(t[j][w[s + j]][f] for j in range(len(t))) for s in range(len(w) - len(t) + 1)) for t in net.tables for f in range(langid.FILTERS)]
        want.append(np.maximum(np.array(row) + net.bias, 0))
    assert np.allclose(net.pooled(windows)[0], want, atol=1e-5)


# ---------------------------------------------------------------- BPE
def test_bpe_equals_library(spark, documents, odd_docs, library):
    docs = documents.select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text"))
    for r in bpe.encode_decode(docs, vocabulary()).collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet="abcdeinthrs'1é!", max_size=60))
def test_bpe_of_any_text(text):
    library = Tokenizer.from_file(PATH)
    library.no_truncation()
    library.no_padding()
    encoder = bpe.backtracking_encoder(PATH)
    ids = np.frombuffer(encoder.encode(text), np.uint32).astype(np.int64)
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert encoder.decode(ids).decode() == library.decode(ids.tolist(), skip_special_tokens=False)


def test_bpe_columns(odd_docs, no_docs):
    made = bpe.encode_decode(odd_docs, vocabulary(), keep_ids=True)
    assert set(odd_docs.columns) < set(made.columns) and made.count() == odd_docs.count()
    assert bpe.encode_decode(no_docs, vocabulary()).count() == 0


# ---------------------------------------------------------------- quality
def test_quality_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = QUERIES["op5_quality"](spark, SF).join(labels, "doc_id").where("held_out").collect()
    assert len(got) > 50 and np.mean([r.quality == r.predicted for r in got]) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)


def test_quality_edge_cases(spark, odd_docs, no_docs):
    none = quality.train(no_docs, spark.createDataFrame([], "doc_id long, quality int"))
    rows = quality.predict(odd_docs, none).collect()
    assert len(rows) == odd_docs.count() and all(r.score < 0.01 and r.predicted == 0 for r in rows)
    only = quality.fit([np.array([1, 2])], np.array([1]))
    assert only.score(np.array([0.0]))[0] > 0.99
    odd = spark.createDataFrame([(5, 1), (5, None), (9, 0), (9, 7), (None, 1)], "doc_id long, quality int")
    assert quality.predict(no_docs, quality.train(odd_docs, odd)).count() == 0


def test_quality_features_are_those_of_each_text(odd_texts):
    together = [f for _, _, data, at in quality.utf8_pieces(pa.array(odd_texts, pa.string())) for f in quality.features(data, at)]
    alone = [quality.features(np.frombuffer((t or "").encode(), np.uint8), np.array([0, len((t or "").encode())]))[0] for t in odd_texts]
    assert all(np.array_equal(a, b) for a, b in zip(together, alone)) and len(together) == len(odd_texts)


def test_dual_descent_reaches_the_optimum():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 4))
    y = np.sign(x @ [1, -2, 0.5, 0] + 0.3 * rng.normal(size=60))
    w = quality.dual_descent([np.arange(4)] * 60, list(x), y, np.ones(60), 500, 0)[[0, 1, 2, 3, -1]]
    ones = np.hstack([x, np.ones((60, 1))])
    loss = lambda v: 0.5 * v @ v + np.maximum(0, 1 - y * (ones @ v)).sum()
    assert all(loss(w) <= loss(w + 0.02 * rng.normal(size=5)) + 1e-2 for _ in range(300))


# ---------------------------------------------------------------- packing
def check_packing(rows, texts, library, capacity=4096):
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    for doc_id, text in texts.items():
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        own = sorted(pieces.pop(doc_id), key=lambda r: r.piece)
        assert [(r.piece, r.start) for r in own] == [(k, k * capacity) for k in range(-(-len(ids) // capacity))]
        for r in own:
            part = ids[r.start:r.start + r.length]
            assert len(part) == r.length == min(capacity, len(ids) - r.start)
            assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
    assert not pieces
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by), sum(r.length for r in rows)


def test_packing_is_whole_and_tight(spark, documents, library):
    rows = QUERIES["op7_best_fit_packing"](spark, SF).collect()
    sequences, tokens = check_packing(rows, {r.doc_id: r.text for r in documents.collect()}, library)
    assert sequences <= -(-tokens // 4096) + 2


def test_packing_edge_cases(odd_docs, no_docs, library):
    once = odd_docs.dropDuplicates(["doc_id"])
    check_packing(packing.pack(once, vocabulary()).collect(), {r.doc_id: r.text for r in once.collect()}, library)
    assert packing.pack(odd_docs, vocabulary()).where("doc_id = 5").count() == 2
    assert packing.pack(no_docs, vocabulary()).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), max_size=25))
def test_plan_places_every_piece_once(histogram):
    segments, sequences = packing.plan(histogram, 64)
    fill, placed, at = Counter(), Counter(), defaultdict(list)
    for length, first, last, sequence, offset in segments:
        assert first == placed[length]
        placed[length] = last
        for k in range(last - first):
            fill[sequence + k] += length
            at[sequence + k].append((offset, length))
    assert placed == Counter(histogram) and len(fill) == sequences and max(fill.values(), default=0) <= 64
    assert all(o == sum(x for p, x in own if p < o) for own in at.values() for o, _ in own)
    # never worse than first fit decreasing by more than a little
    bins = []
    for length in sorted((x for x, n in histogram.items() for _ in range(n)), reverse=True):
        k = next((k for k, b in enumerate(bins) if b + length <= 64), None)
        bins.append(length) if k is None else bins.__setitem__(k, bins[k] + length)
    assert sequences <= len(bins) * 1.08 + 2
