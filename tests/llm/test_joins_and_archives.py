"""Jaccard join, vector searches, WARC and the pipeline: against brute force, round trips and planted cases."""

import gzip
import json
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixtures import SF, documents, no_docs, odd_docs, odd_texts  # noqa: F401

import corpus_pipeline
from riskloom.llm import ann, common, jaccard, langid, quality, topk, warc
from riskloom.llm.queries import QUERIES
from riskloom.llm.vectors import packed


# ---------------------------------------------------------------- Jaccard join
def components(rows):
    """Brute force: doc_id to (shingles, smallest id reachable)."""
    sets = {}
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc_id] = {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    holders, parent = defaultdict(list), {d: d for d in sets}
    for d, own in sets.items():
        for s in own:
            holders[s].append(d)

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d
    for d, own in sets.items():
        for e, same in Counter(e for s in own for e in holders[s] if e > d).items():
            if 100 * same >= 80 * (len(own) + len(sets[e]) - same) and (a := find(d)) != (b := find(e)):
                parent[max(a, b)] = min(a, b)
    return {d: (len(own), find(d)) for d, own in sets.items()}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df).collect()}


@pytest.fixture
def small_limits(monkeypatch):
    """Every cell hot or large, every room in blocks: the ways for very large groups."""
    for name, value in (("CELL", 3), ("ROOM_SETS", 3), ("HOT", 2), ("HOT_MEAN", 0)):
        monkeypatch.setattr(jaccard, name, value)


def chains(seed):
    """Groups of near copies whose members drift apart, passages that many share, texts near the threshold."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    passage, rows = [word() for _ in range(60)], []
    for _ in range(12):
        words = [word() for _ in range(rng.choice((3, 6, 30, 90)))]
        for _ in range(rng.randint(1, 25)):
            words = list(words)
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = word()
            rows.append(" ".join(words))
    rows += [" ".join([*passage, *[word() for _ in range(rng.randint(1, 40))]]) for _ in range(40)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_equals_brute_force(spark, seed):
    rows = chains(seed)
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == components(rows)


def test_jaccard_in_blocks_equals_brute_force(spark, small_limits):
    rows = chains(3)
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == components(rows)


def test_jaccard_on_documents(spark, documents):
    rows = QUERIES["op6_ngram_jaccard"](spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == components((r.doc_id, r.text) for r in documents.collect())


def test_jaccard_edge_cases(odd_docs, no_docs):
    rows = jaccard.jaccard_components(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == components((r.doc_id, r.text) for r in odd_docs.collect())
    assert jaccard.jaccard_components(no_docs).count() == 0


def test_first_of_equal_sets_with_a_hot_set(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SALTS", 7)
    rng = random.Random(8)
    rows = [(d, 0 if d % 3 else rng.randint(-1, 40)) for d in range(300)]  # two thirds in one set; -1: no shingles
    rows += rows[:5]
    sets = spark.createDataFrame([(d, 0 if k < 0 else 9, k, -k) for d, k in rows], "doc_id long, n long, h1 long, h2 long")
    first = {}
    for d, k in sorted(rows):
        first.setdefault(k, d)
    found = sorted((r.doc_id, r["first"]) for r in jaccard._owners(sets).collect())
    assert found == sorted((d, d if k < 0 else first[k]) for d, k in rows)


def test_tree_bound_loses_no_pair():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2 ** 63, 400, dtype=np.uint64)
    sets = sorted((np.unique(np.concatenate([base[rng.random(400) < 0.93], rng.integers(0, 2 ** 63, rng.integers(0, 60), dtype=np.uint64)]))
                   for _ in range(120)), key=len)
    sizes = np.array([len(s) for s in sets])
    tree = jaccard.CountTree(sizes, np.stack([jaccard.point(s, 64) for s in sets]))
    for i, a in enumerate(sets):
        near = set(tree.after(i).tolist())
        for j in range(i + 1, len(sets)):
            same = len(np.intersect1d(a, sets[j]))
            if 100 * same >= 80 * (len(a) + len(sets[j]) - same):
                assert j in near


def test_star_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(500 + i, 501 + i) for i in range(40)] + [(900, 900 + i) for i in range(50)]
    parent = list(range(1000))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    made = {r.node: r.component for r in common.star_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert made == {x: find(x) for x in range(1000) if find(x) != x}
    assert common.star_components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- vectors
def odd_vectors(spark, n=400, size=16, seed=1):
    rng = np.random.default_rng(seed)
    vectors = [[float(np.float32(x)) for x in rng.normal(size=size)] for _ in range(n)]
    for i in range(0, n, 5):
        vectors[i] = vectors[0]  # ties
    rows = [(i, v, "x") for i, v in enumerate(vectors)]
    rows += [(n, None, "x"), (n + 1, [], "x"), (n + 2, [float("nan")] * size, "x"), (n + 3, [0.0] * size, "x"), (n + 4, [None] * size, "x"),
             (n + 5, [float("inf")] * size, "x"), (1000, [1.0, 2.0], "x"), (1001, [2.0, 2.0], "x"), (None, vectors[1], "x"), rows[3], rows[50],
             (50, vectors[7], "x"), (8, vectors[9], "x")]  # repeated rows, and ids of two vectors
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string")


def usable(df, zero):
    """(vec_id, vector) of every row that takes part."""
    return [(r.vec_id, np.array(r.embedding, float)) for r in df.collect() if r.vec_id is not None and (v := r.embedding)
            and all(x is not None and np.isfinite(x) for x in v) and (zero or any(v))]


def test_top_k_equals_brute_force(spark):
    df = odd_vectors(spark)
    vectors = [(k, np.floor(1024 * v).astype(int)) for k, v in usable(df, True)]
    table = topk.whole_numbers(df)
    rows = topk.exact_top_k(table, table.where("vec_id % 50 = 0"), 10).collect()
    want = []
    for i, (q, own) in enumerate(vectors):
        near = sorted((-int(own @ v), c) for j, (c, v) in enumerate(vectors) if j != i and len(v) == len(own)) if q % 50 == 0 else []
        want += [(q, r + 1, c, -s) for r, (s, c) in enumerate(near[:10])]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in rows) == sorted(want)


def test_top_k_on_many_chunks(spark, monkeypatch):
    from riskloom.llm import vectors as grid
    monkeypatch.setattr(grid, "CHUNK", 37)
    monkeypatch.setattr(grid, "BLOCK", 3)
    test_top_k_equals_brute_force(spark)


def test_nearest_neighbours_find_what_brute_force_finds(spark):
    df = odd_vectors(spark, 3000)
    vectors = usable(df, False)
    rows = ann.nearest_neighbours(df, lambda v: v % 50 == 0, 5).collect()
    mine = defaultdict(list)
    for r in sorted(rows, key=lambda r: r["rank"]):
        mine[r.query_id].append((r.vec_id, r.score))
    hits = total = 0
    cosine = lambda a, b: float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b))
    for q in {k for k, _ in vectors if k % 50 == 0}:
        rows_of = [i for i, (k, _) in enumerate(vectors) if k == q]
        near = [(round(cosine(vectors[i][1], v), 9), c) for i in rows_of for _, j, c, v in sorted(
            ((-round(cosine(vectors[i][1], v), 12), j, c, v) for j, (c, v) in enumerate(vectors) if j != i and len(v) == len(vectors[i][1])),
            key=lambda x: x[:2])[:5]]
        assert len(mine[q]) == len(near)
        if len(rows_of) == 1:
            assert all(a[1] >= b[1] for a, b in zip(mine[q], mine[q][1:]))
        hits += len(set(s for s, _ in near) & set(round(s, 9) for _, s in mine[q]))
        total += len(set(s for s, _ in near))
        for c, score in mine[q]:
            assert any(abs(score - cosine(vectors[i][1], v)) < 1e-12 for i in rows_of for j, (k, v) in enumerate(vectors)
                       if k == c and j != i and len(v) == len(vectors[i][1]))
    assert hits / total >= 0.9
    assert any(c == 1001 and abs(score - 6 / 40 ** 0.5) < 1e-12 for c, score in mine[1000])  # of another dimension


def test_recall_on_embeddings(spark):
    rows = QUERIES["op2_learned_partitions"](spark, SF).collect()
    exact = dict(usable(spark.read.parquet(f"{SF}/embeddings.parquet"), False))
    ids = np.array(sorted(exact))
    x = ann.unit(np.stack([exact[i] for i in ids]))
    hits = 0
    mine = defaultdict(set)
    for r in rows:
        mine[r.query_id].add(r.vec_id)
    asked = [i for i in ids if i % 50 == 0]
    for q in asked:
        near = x @ x[np.searchsorted(ids, q)]
        near[np.searchsorted(ids, q)] = -9
        hits += len(mine[q] & set(ids[np.lexsort((ids, -near))[:5]].tolist()))
    assert hits / (5 * len(asked)) >= 0.9


def test_rows_that_share_an_id_are_rows_of_their_own(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [1.0, 0.1]), (0, [0.5, 0.5])], "vec_id long, embedding array<double>")
    rows = ann.nearest_neighbours(df, lambda v: v == 0, 3).collect()
    found = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 3)) for r in rows)
    assert found == [(0, 1, 1, 0.774), (0, 1, 1, 0.995), (0, 2, 0, 0.707), (0, 2, 0, 0.707), (0, 3, 1, 0.0), (0, 3, 1, 0.707)]
    table = topk.whole_numbers(df)
    rows = topk.exact_top_k(table, table.where("vec_id = 0"), 2).collect()
    first = [(r["rank"], r.vec_id, r.score) for r in rows if r.score > 1024 * 600]
    assert len(rows) == 4 and (1, 1, 1024 * 1024) in first


def test_vector_searches_of_nothing(spark):
    none = odd_vectors(spark).where("vec_id < 0")
    assert ann.nearest_neighbours(none, lambda v: v % 50 == 0).count() == 0
    table = topk.whole_numbers(none)
    assert topk.exact_top_k(table, table, 3).count() == 0
    few = packed(odd_vectors(spark).where("vec_id in (1, 2)"), "vec_id", common.F.col("embedding"))
    assert topk.exact_top_k(few, few, 3).count() == 2


def test_parts_are_balanced_and_follow_clusters():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 12)) * 4
    x = ann.unit(np.repeat(centres, 100, 0) + rng.normal(size=(800, 12)))
    part = ann.balanced_parts(ann.neighbour_graph(x, 10), 8)
    assert np.bincount(part, minlength=8).tolist() == [100] * 8
    assert ann.fit_index(x[rng.permutation(800)], 8, 5)[1] <= 3


# ---------------------------------------------------------------- WARC
@pytest.fixture
def pages(spark):
    rows = [(1, "http://a.b/?q=é x", "<p>one</p>"), (2, None, None), (3, "http://c", ""), (4, "http://d\r\nX: y", "<p>one</p>"), (5, "u", "naïve 😀\r\n\r\nWARC/1.1"),
            (6, "u", "<p>one</p>"), (6, "u", "<p>one</p>"), (None, "n", "only"), (7, "v", "z" * 700_000)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_round_trip(pages):
    rows = sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in warc.round_trip(pages).collect())
    size = lambda t: len(t.encode())
    want = [(0, "response", None, "only"), (1, "revisit", 6, "<p>one</p>"), (2, "revisit", 3, ""), (3, "response", None, ""), (4, "revisit", 6, "<p>one</p>"),
            (5, "response", None, "naïve 😀\r\n\r\nWARC/1.1"), (6, "response", None, "<p>one</p>"), (6, "response", None, "<p>one</p>"), (7, "response", None, "z" * 700_000)]
    assert rows == [(a, b, c, size(t), warc.payload_digest(t.encode())) for a, b, c, t in want]
    assert warc.round_trip(pages.where("page_id < 0")).count() == 0
    small = {r.page_id: r.record_type for r in warc.round_trip(pages, least_bytes=11).collect()}
    assert set(small.values()) == {"response"}


def test_files_are_normalised(pages, tmp_path):
    made = warc.write_archives(warc.with_revisits(pages), f"file://{tmp_path}/w").collect()
    assert sum(r.records for r in made) == 9
    for r in made:
        whole = open(r.archive.removeprefix("file://"), "rb").read()
        target = r.archive.replace("/whole-", "/member-")
        rows = warc.normalise_file(r.archive, target)
        raw = open(target.removeprefix("file://"), "rb").read()
        assert gzip.decompress(raw) == gzip.decompress(whole)
        lines = [json.loads(x) for x in open(target.removeprefix("file://") + ".idx")]
        assert [(x["offset"], x["length"]) for x in lines] == [x[1:3] for x in rows]
        assert sum(x["length"] for x in lines) == len(raw)
        for x in lines:
            one = zlib.decompressobj(31)
            assert one.decompress(raw[x["offset"]:]).startswith(b"WARC/1.1") and len(one.unused_data) == len(raw) - x["offset"] - x["length"]
        again = warc.normalise_file(target, target + ".again")  # members are read as well as one stream
        assert [x[1:] for x in again] == [x[1:] for x in rows]


def test_broken_archive(tmp_path):
    data = gzip.compress(warc.record(1, "u", b"body", None, "1970-01-01T00:00:00Z"))
    (tmp_path / "whole-0.warc.gz").write_bytes(data[:-20])
    with pytest.raises((EOFError, zlib.error)):
        warc.normalise_file(f"file://{tmp_path}/whole-0.warc.gz", f"file://{tmp_path}/member-0.warc.gz")


# ---------------------------------------------------------------- pipeline
def test_stages_keep_and_drop_what_they_say(spark, documents):
    docs, stages = documents, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "quality", "near_copies", "personal_data", "packing"]
    net = langid.train(langid.learnable(docs))
    says = {r.doc_id: r for r in langid.predict(docs.select("doc_id", "text"), net).collect()}
    kept = common.staged(stages["language_id"](spark, docs, SF), "s1")
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, r in says.items() if r.lang_pred != "und" and r.score >= corpus_pipeline.LEAST_LANGUAGE}
    model = quality.train(kept, spark.read.parquet(f"{SF}/labels.parquet"))
    says = {r.doc_id: r.predicted for r in quality.predict(kept.select("doc_id", "text"), model).collect()}
    good = common.staged(stages["quality"](spark, kept, SF), "s2")
    assert {r.doc_id for r in good.collect()} == {d for d, p in says.items() if p}
    single = common.staged(stages["near_copies"](spark, good, SF), "s3")
    groups = components((r.doc_id, r.text) for r in good.collect())
    assert sorted(r.doc_id for r in single.collect()) == sorted({c for _, c in groups.values()})
    clean = common.staged(stages["personal_data"](spark, single, SF), "s4")
    assert clean.columns == documents.columns and clean.count() == single.count()
    assert clean.where("text rlike '[a-z]@[a-z0-9]+[.][a-z]' or n_chars <> length(text)").count() == 0
    packs = stages["packing"](spark, clean, SF)
    assert packs.select("doc_id").distinct().count() == clean.count()


def test_pipeline_runs_on_odd_and_no_rows(spark, odd_docs, no_docs, tmp_path):
    spark.createDataFrame([(5, 1), (9, 0)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            made = common.staged(stage(spark, docs, str(tmp_path)), name)
            if name != "packing":
                assert made.columns == docs.columns and [t for _, t in made.dtypes] == [t for _, t in docs.dtypes]
        assert common.staged(corpus_pipeline.near_copies(spark, docs, ""), "x").count() == (len({c for _, c in components(
            (r.doc_id, r.text) for r in docs.collect()).values()}) if docs is odd_docs else 0)


# ---------------------------------------------------------------- hot payloads
def test_rows_of_a_hot_payload_are_dealt_out(spark):
    pages = spark.range(3000).selectExpr("id as page_id", "'u' as url", "if(id % 3 = 0, concat('p', id), '') as html")
    out = warc.with_revisits(pages)
    assert out.columns == ["page_id", "url", "html", "refers_to"]
    rows = out.collect()
    assert len(rows) == 3000 and {r.refers_to for r in rows if r.html == "" and r.page_id != 2999} == {2999}
    assert all(r.refers_to is None for r in rows if r.html or r.page_id == 2999)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "_salt" in plan.split("Join", 1)[1].split("\n", 1)[0]
