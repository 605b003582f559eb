"""Ranked lexical search, vector codes and HTML extraction: against plain loops, hand-made pages and odd inputs."""

import hashlib
import html as entities
import math
import random
import re

import numpy as np
import pytest
from llm_fixtures import SF, no_docs, odd_docs, odd_texts  # noqa: F401

from riskloom.llm import codes, extract, lexical
from riskloom.llm.html import DEPTH, Paths, blocks
from riskloom.llm.layouts import Maker
from riskloom.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# ---------------------------------------------------------------- ranked lexical search
def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(items, docs, k=10):
    """Every document scored for every item in a plain loop."""
    own = [(d, t) for d, t in ((d, terms(t)) for d, t in docs) if t]
    n, size = len(own), sum(len(t) for _, t in own)
    df = {}
    for _, t in own:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for i, ts in wanted.items():
        found = []
        for d, t in own:
            m = 100 - 90 + (90 * len(t) * n) // size
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((1_000_000_000 * t.count(w)) // (1000 * t.count(w) + 8 * m))
                        for w in ts if w in t)
            if score > 0:
                found.append((-score, d is None, d))
        out += [(i, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


def searched(spark, items, docs, **more):
    found = lexical.search(spark.createDataFrame(items, "item_id long, text string, score string"),
                           spark.createDataFrame(docs, "doc_id long, text string, rank string"), **more)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=str)


def some_texts(rng, n, words):
    return [" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(n)]


@pytest.mark.parametrize("limits", [{}, {"TERMS": 20}, {"_STEP": 1}])
def test_lexical_equals_plain_loop(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(lexical, name, value)
    rng = random.Random(len(limits) + 3)
    words = [*("Ab ab aB cd x1 ünï 中文 _q e-f g.h".split()), *(f"w{i}" for i in range(30))]
    texts = some_texts(rng, 150, words)
    docs = [(d, t, "r") for d, t in enumerate([*texts, *texts[:40], None, "", "-- ..", " ".join(words * 400)])]
    docs += [docs[3], (None, texts[0], None), (None, texts[1], None), (7, texts[9], None)]
    items = [(i, t, "s") for i, t in enumerate([*some_texts(rng, 12, words), None, "", "!!", "nowhere", " ".join(words)])]
    items += [items[2], (1, "w1 w2", None), (None, "w3 cd", None)]
    pairs = lambda rows: [(r[0], r[1]) for r in rows]
    assert searched(spark, items, docs) == plain_search(pairs(items), pairs(docs))
    assert searched(spark, items, docs, k=3) == plain_search(pairs(items), pairs(docs), 3)


def test_lexical_empty_tables(spark, odd_docs, no_docs):
    assert lexical.search(no_docs, odd_docs, item_key="doc_id").count() == 0
    assert lexical.search(odd_docs, no_docs, item_key="doc_id").count() == 0
    found = lexical.search(odd_docs, odd_docs, item_key="doc_id")
    assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.where("rank = 1").count() > 5


def test_lexical_groups_stop_early():
    """Groups that can't reach the k-th best score aren't scored, and none that can is left out."""
    rng = np.random.default_rng(1)
    seen = []

    class Counted(lexical.Block):
        def scores(self, rows, masks, terms, weights):
            seen.append(len(rows))
            return super().scores(rows, masks, terms, weights)

    pairs = np.sort(np.unique(rng.integers(0, 12, 4000) << 32 | np.floor(2000 * rng.random(4000) ** 2).astype(np.int64)))
    values = rng.integers(300_000, 900_000, len(pairs))
    block = Counted(list(range(2000)), pairs, values, np.searchsorted(pairs >> 32, np.arange(13)), {})
    weights = rng.integers(1, 4000, 12)
    every = np.zeros(2000, np.int64)
    np.add.at(every, pairs & 0xFFFFFFFF, values * weights[pairs >> 32])
    rows, scores = block.best(np.arange(12), weights, 10, 1)
    assert sorted(scores)[-10:] == sorted(every)[-10:] and (every[rows] == scores).all()
    assert sum(seen) < 2000 / 2


def test_vocabulary_tells_terms_of_one_hash_apart(monkeypatch):
    monkeypatch.setattr(lexical, "word_hashes", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    words = lexical.Vocabulary([b"ab", b"abc", b"cd"])
    raw = np.frombuffer(b"CD abc x ab abd", np.uint8)
    starts, ends, _ = lexical.term_bounds(raw, np.array([0, len(raw)]))
    assert words.find(raw, starts, ends).tolist() == [2, 1, -1, 0, -1]


# ---------------------------------------------------------------- vector codes
def plain_codes(rows, parts=16, entries=64, rounds=2):
    """Every entry compared with every part, in Python's whole numbers."""
    kept = [(i, [math.floor(256 * float(x)) for x in v], lab) for i, v, lab in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    first = sorted(kept, key=lambda r: (r[0] is None, r[0], r[1]))[:entries]
    dim = len(first[0][1])
    cuts = np.cumsum([0, *(len(c) for c in np.array_split(np.arange(dim), parts))]).tolist()
    spans = list(zip(cuts, cuts[1:]))
    books = [[r[1][a:b] for r in first if len(r[1]) == dim] for a, b in spans]
    same = [r for r in kept if len(r[1]) == dim]

    def assign(v):
        out = []
        for (a, b), book in zip(spans, books):
            d, e = min((sum((x - y) ** 2 for x, y in zip(v[a:b], own)), e) for e, own in enumerate(book))
            out.append((e, d))
        return out
    for _ in range(rounds):
        held = [[[] for _ in book] for book in books]
        for _, v, _ in same:
            for p, (e, _) in enumerate(assign(v)):
                held[p][e].append(v[spans[p][0]:spans[p][1]])
        books = [[[sum(c) // len(c) for c in zip(*own)] if own else old for own, old in zip(h, book)] for h, book in zip(held, books)]
    sha = hashlib.sha256(",".join(str(x) for book in books for own in book for x in own).encode()).hexdigest()
    made, sums = [], {}
    for i, v, lab in kept:
        found = assign(v) if len(v) == dim else None
        code, error = ("".join(f"{e:02x}" for e, _ in found), sum(d for _, d in found)) if found else (None, None)
        made.append((i, code, error, lab))
        if error is not None:
            sums[lab] = sums.get(lab, 0) + error
    return sorted(((i, c, e, sums.get(lab), sha) for i, c, e, lab in made), key=str)


def coded(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, code string, error int")
    return sorted(map(tuple, codes.compressed(df).collect()), key=str)


@pytest.mark.parametrize("dim", [32, 20, 7])
def test_codes_equal_plain_loop(spark, dim):
    rng = np.random.default_rng(dim)
    base = rng.normal(0, 0.3, (150, dim)).astype(np.float32)
    rows = [(int(i), [float(x) for x in base[i % 110]], None if i % 3 == 0 else int(i % 4)) for i in rng.permutation(150)]
    rows += [rows[5], (3, rows[8][1], 2), (None, rows[9][1], None), (900, None, 1), (901, [], 1), (902, [None] * dim, 1),
             (903, [float("nan")] * dim, 1), (904, [float("inf")] * dim, 1), (905, [0.5] * (dim + 1), 9), (906, [-0.25] * dim, 2)]
    assert coded(spark, rows) == plain_codes(rows)


def test_codes_of_few_and_no_rows(spark):
    rows = [(5, [0.1] * 16, None), (2, [0.7] * 16, None), (9, [0.1] * 16, 3)]
    assert coded(spark, rows) == plain_codes(rows)
    assert coded(spark, [(1, None, 2)]) == [] and coded(spark, []) == []


def test_equal_average_search_is_exact_and_looks_at_few():
    rng = np.random.default_rng(2)
    book = rng.integers(-60, 60, (64, 4))
    book[40] = book[7]  # a tie
    own = np.concatenate([rng.integers(-80, 80, (3000, 4)), book])
    every = ((own[:, None, :] - book[None]) ** 2).sum(2)
    index, best = codes.nearest(own, book)
    assert (index == every.argmin(1)).all() and (best == every.min(1)).all()


# ---------------------------------------------------------------- HTML extraction
@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{SF}/pages.parquet")


@pytest.fixture(scope="module")
def net(pages):
    return extract.train(pages)


def own_blocks(html):
    return [b[1] for b in blocks(html, Paths(64))]


def test_blocks_of_odd_markup():
    assert own_blocks("<p>a <b>b</b>\n c<p>d<br>e<div>f</p>g</div>h") == ["a b c", "d e", "f", "g", "h"]
    assert own_blocks("x &lt;b&gt; &amp;amp; &eacute;&#x41;&nbsp;y") == ["x <b> &amp; éA y"]
    assert own_blocks("<script>if (a<b) '</p>'</script>1<style>p{}</style>2<!-- <p>no --><title>t</title>3<textarea>q</textarea>") == ["12", "3"]
    assert own_blocks("a < b, 1<2 <p class='x>y'>t</p><p title=\"unclosed>z") == ["a < b, 1<2", "t", "z"]
    assert own_blocks("<ul><li>1<li>2<ul><li>3</ul></ul><table><tr><td>4<td>5<tr><td>6</table>") == list("123456")
    assert own_blocks("") == [] and own_blocks("<div></div> \n") == [] and own_blocks("</p></x><br>only") == ["only"]
    assert own_blocks("<script>never ends <p>a") == [] and own_blocks("a<noscript>b<p>c") == ["ab", "c"]


def test_blocks_of_deep_and_long_pages():
    deep = "<div>" * (DEPTH * 4) + "text" + "</div>" * (DEPTH * 4) + "<p>after"
    paths = Paths(64)
    assert [b[1] for b in blocks(deep, paths)] == ["text", "after"] and len(paths.tokens) <= DEPTH + 3
    assert own_blocks("<p>w" * 50_000) == ["w"] * 50_000
    assert own_blocks('<a href="' * 3000 + "x") and own_blocks("<" * 20_000) == ["<" * 20_000]


def test_links_are_measured():
    found = blocks('<div><a href=x>one</a> two</div><a><p>three</p></a><p>four', Paths(64))
    assert [(t, round(s, 2)) for _, t, s in found] == [("one two", 0.43), ("three", 1.0), ("four", 0.0)]


def test_gradients_match_differences():
    maker, paths, rng = Maker([], 3), Paths(extract.BUCKETS), np.random.default_rng(0)
    made = []
    while len(made) < 3:
        html, labels = maker.page()
        found = blocks(html, paths)
        assert len(found) == len(labels)
        made.append((extract.Example.of(found, labels), found))
    made.sort(key=lambda e: -len(e[0].truth))

    class Every:  # no token is left out
        def random(self, n):
            return np.ones(n)
    net = extract.fit([], pages=20, epochs=1)
    grads = extract._gradients(net, [e[0] for e in made], paths, Every())
    truth = np.concatenate([e[0].truth for e in made])

    def loss():
        net.cache.clear()
        p = np.concatenate(net.label([e[1] for e in made], paths)).astype(np.float64)
        return -np.mean(np.log(np.where(truth > 0, p, 1 - p)))
    params = [net.path, net.word, net.shape, net.bias, *net.lstm[0], *net.lstm[1], net.out, net.out_bias]
    for grad, param in zip(grads, params):
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        was, step = param[at], 3e-2
        param[at] = was + step
        up = loss()
        param[at] = was - step
        down = loss()
        param[at] = was
        assert abs((up - down) / (2 * step) - grad[at]) < 0.05 * abs(grad[at]) + 2e-4
    assert rng is not None


def test_made_pages_held_out(net):
    maker, paths, wrong, total = Maker([], 1234), Paths(extract.BUCKETS), 0, 0
    net.cache.clear()
    for _ in range(300):
        html, labels = maker.page()
        found = blocks(html, paths)
        if found:
            chances = net.label([found], paths)[0]
            wrong += int(((chances >= 0.5) != np.array(labels)).sum())
            total += len(labels)
    net.cache.clear()
    assert wrong / total < 0.025, (wrong, total)


A, B = "Lorem ipsum dolor sit amet consectetur. Adipiscing elit sed do.", "Ut enim ad minim veniam quis nostrud exercitation ullamco, laboris nisi."
#: Pages in common markups; the main text is marked by @.
HAND_MADE = [
    f'<body><div id="top"><a href="/">Site</a> | <a href="/n">News</a></div><div class="cookie-banner">We use cookies. <button>OK</button></div>'
    f'<div id="main"><h1>@Head line</h1><p>@{A}<p>@{B}<div class="advert">{B}</div><p>@{A}</div><div class="sidebar"><h3>Related</h3><p>{A}</p>'
    f'</div><div class="comment"><b>Joe</b><p>{B}</p></div><div id="footer">Copyright 2020</div>',
    f'<body><nav><ul><li><a href="/a">aa</a></li></ul></nav><div class="ad">{A}</div><article><h1>@Tit &amp; le</h1><p><b>@{A}<br><p>@{B}</p>'
    f'</article><aside><p>{A}</p></aside><section class="comments"><p>{B}</p><p>{A}</p></section><footer>&copy; x &middot; {A}</footer></body>',
    f'<div class="header">{A}</div><div class="nav"><a href=1>x y</a> <a href=2>z</a></div><div class="content"><h1>@{A}</h1><p>@{B}</p></div>'
    f'<form class="signup"><p>{A}</p><label>mail</label></form><div class="ads">{B}</div><div class="footer">{A}</div>',
]


def test_hand_made_pages(spark, net):
    df = spark.createDataFrame([(i, h.replace("@", "")) for i, h in enumerate(HAND_MADE)], "page_id long, html string")
    wrong = total = 0
    for r, html in zip(extract.extract(df, net).orderBy("page_id").collect(), HAND_MADE):
        marked = own_blocks(html)
        want = [b[1:] for b in marked if b[0] == "@"]
        got = r["text"].split("\n\n")
        total += len(marked)
        wrong += len(set(want) ^ set(got))
    assert wrong <= 1, (wrong, total)


def test_pages_have_their_articles(spark, pages):
    """The given pages have an article element: every page's text is its blocks."""
    rows = {r.page_id: r for r in QUERIES["op13_recurrent_blocks"](spark, SF).collect()}
    assert len(rows) == pages.count()
    wrong = 0
    for p in pages.collect():
        inside = re.search(r"(?s)<article>(.*?)(</article>|\Z)", p.html)[1]
        want = [" ".join(entities.unescape(re.sub(r"</?b>|<br>", " ", x)).split()) for x in re.split(r"</?(?:h1|p)>", inside)]
        wrong += rows[p.page_id].text != "\n\n".join(x for x in want if x)
        assert rows[p.page_id].n_chars == len(rows[p.page_id].text) and rows[p.page_id].url == p.url
    assert wrong <= 0.01 * len(rows), wrong


def test_extract_edge_cases(spark, net):
    html = [None, "", "   ", "<p>", "<nav><a href=x>menu</a></nav>", HAND_MADE[1].replace("@", ""), "\x00<p>퟿  x", "<p>" + "long word " * 60_000]
    rows = [(i % 5, None, h, i) for i, h in enumerate([*html, html[5]])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    found = extract.extract(df, net).collect()
    assert len(found) == len(rows) and set(found[0].asDict()) == {"page_id", "url", "html", "text", "n_chars", "n_blocks", "n_main"}
    by_html = {r.html: r for r in found}
    assert all((by_html[h].text, by_html[h].n_chars) == ("", 0) for h in (None, "", "   ", "<p>"))
    assert len({(r.text, r.n_blocks) for r in found if r.html == html[5]}) == 1
    assert extract.extract(df.where("page_id < 0"), net).count() == 0
    assert extract.train(df.where("page_id < 0")).path.shape == (extract.BUCKETS, extract.SIZE)


def test_grouping_does_not_change_labels(spark, pages, net, monkeypatch):
    want = {r.page_id: r.text for r in extract.extract(pages.limit(60), net).collect()}
    monkeypatch.setattr(extract, "GROUP", 30)
    monkeypatch.setattr(extract, "MOST_PATHS", 10)
    assert {r.page_id: r.text for r in extract.extract(pages.limit(60), net).collect()} == want
