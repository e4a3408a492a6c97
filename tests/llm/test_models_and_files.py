"""Tokens, packing, token files, toxicity, LM scoring, main text and the pipeline."""
import collections
import itertools
import math
import random
import re
import zlib
from xml.etree import ElementTree

import numpy as np
import pytest
from helpers import docs_of, edge_rows, sorted_rows
from pyspark.sql import functions as F


# ----------------------------------------------------------------- tokens
@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_whole_text(name):
    from sitegraph.llm.tokens import Encoder, default_path, read_definition
    definition = read_definition(default_path(name))
    fast, whole = Encoder(definition, cache=500), Encoder(definition, whole=True)
    assert not fast._whole
    rng = random.Random(1)
    parts = list("aAbZéÉßÿµªºÀ×÷ñ0123²¼.,!'’“”—…\n\t\r \x0b\x0c\x1c\x1f\x85\xa0 ​　́ÍİıſΣσς中文日😀👍🏽\u0000<|>") \
        + ["'s", "'ll", "<|endoftext|>", "<|startoftext|>", "  ", "\n\n", " the", "Word"]
    texts = ["", None, " "] + ["".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(4000)]
    for text, a, b in zip(texts, fast.ids(texts), whole.ids(texts)):
        assert a.tolist() == b.tolist(), repr(text)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_added_tokens_as_the_library_gives_them(name):
    from tokenizers import Tokenizer

    from sitegraph.llm.tokens import Encoder, default_path, read_definition
    library = Tokenizer.from_file(default_path(name))  # untouched
    encoders = [Encoder(read_definition(default_path(name)), whole=w) for w in (False, True)]
    rng = random.Random(4)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "|>", "<|", " ", "  ", "\n", "a", "b", "Word", "'s", "é", "e\u0301", "日", "\u0301"]
    texts = ["a<|endoftext|>b", "<|endoftext|><|endoftext|>", " <|endoftext|> ", ""] + ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(3000)]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0][1] == {"byte_bpe_50k.json": 50256, "word_bpe_49k.json": 49407}[name]
    for e in encoders:
        assert [i.tolist() for i in e.ids(texts)] == want


# ---------------------------------------------------------------- packing
def _bins(runs, capacity):
    held = collections.Counter()
    for pattern, m in runs:
        assert m > 0 and sum(w * k for w, k in pattern) <= capacity
        for w, k in pattern:
            held[w] += k * m
    return held, sum(m for _, m in runs)


def _fewest(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + items[i] <= capacity and bins[b] not in bins[:b]:
                bins[b] += items[i]
                go(i + 1, bins)
                bins[b] -= items[i]
        go(i + 1, bins + [items[i]])
    go(0, [])
    return best[0]


def test_plan_against_exact_packing():
    from sitegraph.llm.packing import _Counts, _dominating, plan
    rng = random.Random(3)
    for _ in range(400):
        capacity = rng.randint(3, 30)
        items = [rng.randint(1, capacity) for _ in range(rng.randint(0, 9))]
        held, n = _bins(plan(collections.Counter(items), capacity), capacity)
        best = _fewest(items, capacity)
        assert held == collections.Counter(items) and n <= best + 1
        if items:  # a set that the reduction fixes is part of some best packing
            rest = sorted(items)
            j = rest.pop()
            fixed = _dominating(_Counts(collections.Counter(rest)), j, capacity)
            if fixed is not None:
                for w in fixed:
                    rest.remove(w)
                assert 1 + _fewest(rest, capacity) == best
    many = {w: rng.randint(1, 10**9) for w in range(1, 4097)}
    held, _ = _bins(plan(many, 4096), 4096)
    assert held == collections.Counter(many) and plan({}, 10) == []


def _check_packing(rows, got, capacity):
    from sitegraph.llm.tokens import Encoder, default_path, read_definition
    whole = Encoder(read_definition(default_path("word_bpe_49k.json")), whole=True)
    want = []
    for (key, _), ids in zip(rows, whole.ids([t for _, t in rows])):
        ids = np.append(ids.astype("<u4"), np.uint32(1))
        for p, s in enumerate(range(0, len(ids), capacity)):
            part = ids[s:s + capacity].astype("<u4")
            want.append((key, p, s, len(part), zlib.crc32(part.tobytes())))
    assert sorted_rows(got, "doc_id", "piece", "start", "length", "ids_crc32") == sorted(want, key=repr)
    by = collections.defaultdict(list)
    for r in got.collect():
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        places.sort()
        assert [o for o, _ in places] == [0, *itertools.accumulate(n for _, n in places)][:-1]
        assert sum(n for _, n in places) <= capacity
    return len(by), -(-sum(w[3] for w in want) // capacity)


def test_pack(spark, sf):
    from sitegraph.llm.packing import pack
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    n, bound = _check_packing(rows, pack(docs_of(spark, rows)).cache(), 4096)
    assert n <= bound + 1
    _check_packing(edge_rows(), pack(docs_of(spark, edge_rows()), capacity=64, with_ids=True).cache(), 64)
    assert pack(docs_of(spark, [])).count() == 0


# ------------------------------------------------------------ token files
def test_token_files_round_trip(spark, tmp_path):
    from pyarrow import fs

    from sitegraph.llm.token_files import TokenFile, token_round_trip
    from sitegraph.llm.tokens import Encoder, default_path, read_definition
    rows = [(r[0], r[1]) for r in edge_rows() if r[0] not in (None, 4, 5)] + [(100 + i, f"doc {i} " * i) for i in range(50)] + [(None, "none")]
    got = {r.doc_id: r for r in token_round_trip(docs_of(spark, rows), width=16, folder=str(tmp_path), with_ids=True).collect()}
    whole = Encoder(read_definition(default_path("byte_bpe_50k.json")), whole=True)
    start = 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.append(next(whole.ids([text])).astype("<u4"), np.uint32(0)).astype("<u4")
        r = got[key]
        assert (r.start, r.n_tokens, r.ids_crc32, r.ids) == (start, len(ids), zlib.crc32(ids.tobytes()), ids.tolist())
        start += len(ids)
    total = 0
    for path in tmp_path.glob("part-*.arrow"):
        if ".docs" not in path.name:
            f = TokenFile(fs.LocalFileSystem(), str(path))
            masks = [sum(f.mask(i).to_pylist()) for i in range(len(f))]
            assert all(m == 16 for m in masks[:-1]) and all(len(f.sequence(i)) == 16 for i in range(len(f)))
            assert np.shares_memory(f.sequence(0), f.sequence(0)) and not f.sequence(0).flags.owndata
            total += sum(masks)
    assert total == start
    assert token_round_trip(docs_of(spark, []), folder=str(tmp_path / "none")).count() == 0
    assert token_round_trip(docs_of(spark, edge_rows())).count() == len(edge_rows())


# --------------------------------------------------------------- toxicity
def test_pairs_are_learned():
    """Label 1 only where both terms stand: additive weights alone can't tell it from one of them twice."""
    from sitegraph.llm.toxicity import Hasher, fit
    rng = np.random.default_rng(0)
    h, texts, y = Hasher(), [], []
    for _ in range(3000):
        a, b = (rng.random(2) < 0.5).tolist()
        texts.append(h.terms(" ".join(["insult"] * a + ["group"] * b + list(rng.choice(["one", "two", "six"], 3)))))
        y.append(float(a != b))  # not linear in the terms
    m = fit(texts[:2000], np.array(y[:2000]))
    p = m.score(texts[2000:])
    assert ((p > 0.5) == np.array(y[2000:], bool)).mean() > 0.95


def test_rare_harmless_terms_decide_together():
    """Two terms, each in one text of thirty and as often with either label: only both together mean label 1."""
    from sitegraph.llm.toxicity import Hasher, fit
    rng = np.random.default_rng(4)
    h, texts, y = Hasher(), [], []
    filler = [f"filler{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    for i in range(6000):
        both = i % 60 == 0
        words = list(rng.choice(filler, 12)) + (["slur", "group"] if both else ["slur"] if i % 60 == 1 else ["group"] if i % 60 == 2 else [])
        texts.append(h.terms(" ".join(words)))
        y.append(float(both or i % 60 == 3))
    m = fit(texts[:4000], np.array(y[:4000]))
    assert all(m.slot[t] >= 0 for w in ("slur", "group", *filler) for t in h.terms(w))
    p, kind = m.score(texts[4000:]), np.arange(4000, 6000) % 60
    assert p[kind == 0].mean() > 3 * max(p[kind == 1].mean(), p[kind == 2].mean())


def test_raw_score_is_the_pair_sum():
    from sitegraph.llm.toxicity import Hasher, fit
    h = Hasher()
    texts = [h.terms(t) for t in ["a b", "a c", "b c", "a b c", "c", ""] * 20]
    m = fit(texts, np.array([1, 0, 0, 1, 0, 0.0] * 20), epochs=3)
    got = m.score(texts[:6])
    for t, p in zip(texts, got):
        at = [m.slot[i] for i in t if m.slot[i] >= 0]
        z = m.w0 + sum(m.w[i] * m.own[i] * m.x[i] for i in at)
        z += sum(m.v[i] @ m.v[j] * m.x[i] * m.x[j] for i, j in itertools.combinations(at, 2))
        assert math.isclose(p, 1 / (1 + math.exp(-z)), rel_tol=1e-9)


def test_toxicity_held_out(spark):
    from sitegraph.llm.toxicity import toxicity
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = toxicity(docs, labels).join(labels, "doc_id").select("doc_id", "held_out", "score", "predicted", "toxic").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    picked = [r for r in held if r.predicted]
    assert sum(r.toxic for r in picked) >= 0.95 * len(picked) and len(picked) >= 0.6 * sum(r.toxic for r in held)


def test_toxicity_edges(spark):
    from sitegraph.llm.toxicity import toxicity
    labels = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (6, None), (9, 0)], "doc_id long, toxic int")
    rows = edge_rows()
    got = toxicity(docs_of(spark, rows), labels)
    assert got.count() == len(rows) and all(0 <= r.score <= 1 for r in got.collect())
    assert {r.score for r in toxicity(docs_of(spark, rows), labels.limit(0)).collect()} == {0.5}
    assert toxicity(docs_of(spark, []), labels).count() == 0


def test_an_id_on_many_rows_gives_one_text(spark, monkeypatch):
    from sitegraph.llm import toxicity as X
    seen = []
    monkeypatch.setattr(X, "fit", lambda texts, labels: seen.append((len(texts), labels.tolist())))
    labels = spark.createDataFrame([(7, 1), (8, 0), (4, 1)], "doc_id long, toxic int")  # 4 is held out
    rows = [(7, f"text {i}") for i in range(5000)] + [(8, "x"), (8, None), (4, "held out")]
    X.train(docs_of(spark, rows), labels, sample=10)
    assert seen == [(2, [1.0, 0.0])] or seen == [(2, [0.0, 1.0])]


# ------------------------------------------------------------- LM scoring
@pytest.mark.parametrize("known", [7, 1 << 17])
def test_score_by_definition(spark, known):
    """Sum over words of log P(class) + log P(ending) + log of the share of its cell, worked out word by word."""
    from sitegraph.llm import lm_score as L
    rows = edge_rows() + [(30 + i, f"some words {i} and more words {i % 3}") for i in range(30)] + [(31, "some words 1 and more words 1")]
    d = docs_of(spark, rows)
    counted = L.count_words(d)
    n = collections.Counter(w for _, t in rows for w in L.words(t))
    assert {r.h: r.n for r in counted.collect()} == {L.word_hash(w): k for w, k in n.items()}
    v = L.vocabulary(counted, known)
    order = sorted(n, key=lambda w: (-n[w], L.word_hash(w)))
    klass, before = {}, 0
    for i, w in enumerate(order):
        klass[w] = min(before * L.CLASSES // sum(n.values()), L.CLASSES - 2) if i < known else L.CLASSES - 1
        before += n[w]
    cells = collections.Counter()
    for w in n:
        cells[klass[w], L.ending(w)] += n[w]
    assert {(k, e): int(v.cells[k, e]) for k, e in zip(*np.nonzero(v.cells))} == dict(cells)
    net = L.train(d, v)
    assert not np.allclose(net.flat(), L.Network.start(v.cells).flat())
    keys = {(r.k1, r.k2): r.doc_id for r in d.select("doc_id", *L.row_key(F.col("doc_id"), F.col("text"))).collect()}
    got = {keys[r.k1, r.k2]: r for r in L.score(d, counted, v, net).collect()}
    for key, text in rows:
        if key is None or key < 30:
            continue
        w = L.words(text)
        k, e = [klass[x] for x in w], [L.ending(x) for x in w]
        total = 0.0
        for i in range(len(w)):
            z = np.zeros(L.WIDTH)
            for place, o in enumerate([-2, -1, 1, 2]):
                there = 0 <= i + o < len(w)
                z += net.c[place][k[i + o] if there else L.CLASSES] + net.e[place][e[i + o] if there else L.ENDINGS]
            for logits, x in ((np.tanh(z) @ net.w1 + net.b1, k[i]), (np.tanh(z) @ net.w2 + net.b2[k[i]], e[i])):
                total += logits[x] - math.log(np.exp(logits).sum())
            total += math.log(n[w[i]] / cells[k[i], e[i]])
        assert got[key].n_tokens == len(w) and math.isclose(got[key].log_prob, total, rel_tol=1e-4), key


def test_words_are_numbered_once(spark, monkeypatch):
    """Training and scoring read the table of numbers; none of them splits texts into words again."""
    from sitegraph.llm import lm_score as L
    staged, stage = [], L.stage
    monkeypatch.setattr(L, "stage", lambda df, name: staged.append((name, df.inputFiles())) or stage(df, name))
    assert L.lm_score(docs_of(spark, edge_rows())).count() == len(edge_rows())
    assert [name for name, _ in staged] == ["words", "numbers"] + ["weights"] * L.ROUNDS + ["scores"]
    assert all(files and all("/llm-numbers-" in f for f in files) for _, files in staged[2:])


@pytest.mark.parametrize("known", [0, 1, 40])
def test_numbers_of_words(monkeypatch, known):
    """All words of a run at once, as each by itself, also after the worker forgot those it had."""
    from sitegraph.llm import lm_score as L
    monkeypatch.setattr(L, "CACHE", 30)
    rng = np.random.default_rng(5)
    every = [bytes(rng.integers(97, 123, size).astype(np.uint8)) for size in rng.integers(1, 9, 200)] + ["é".encode(), "\U0001f600".encode()]
    assert L.word_hashes(every).tolist() == [*map(L.word_hash, every)] and L.endings_of(every).tolist() == [*map(L.ending, every)]
    hashes = np.array([*dict.fromkeys(map(L.word_hash, every))][:known], np.int64)
    v = L.Vocabulary.of(hashes, np.arange(len(hashes), 0, -1), 500)
    at = {h: i for i, h in enumerate(v.hashes.tolist())}
    encoder = L.Encoder(v)
    for _ in range(4):
        run = [[every[i] for i in rng.integers(0, len(every), size)] for size in (0, 50, 1, 0, 7)]
        for got, w in zip(encoder.encode(run).T.tolist(), [w for t in run for w in t], strict=True):
            i = at.get(L.word_hash(w), -1)
            assert got == [i, int(v.classes[i]) if i >= 0 else L.CLASSES - 1, L.ending(w), L.word_hash(w)]
        numbers = encoder.encode(run)
        sizes = [len(t) for t in run]
        back = L._documents(L._binary([L._codes(numbers[1], numbers[2])], sizes).to_pylist())
        assert [b.shape[1] for b in back] == sizes and (np.concatenate(back, axis=1) == numbers[1:3]).all()


def test_scores_do_not_depend_on_partitions(spark, sf):
    from sitegraph.llm.lm_score import lm_score
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    runs = [{r.doc_id: r.mean_log_prob for r in lm_score(docs.repartition(n), group=20_000).collect()} for n in (1, 7, 32)]
    assert len(runs[0]) == docs.count()
    for other in runs[1:]:
        assert all(a == b or abs(a - b) < 1e-6 for a, b in ((runs[0][i], other[i]) for i in runs[0]))
    order = [sorted(r, key=lambda i: (round(r[i] or 0, 6), i)) for r in runs]
    assert order[0] == order[1] == order[2]


def test_network_learns_from_both_sides(spark):
    from sitegraph.llm import lm_score as L
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(w for _ in range(40) for w in (["a", "x", "b"] if rng.random() < 0.5 else ["c", "y", "d"]))) for i in range(200)]
    d = docs_of(spark, rows)
    got = {r.doc_id: r for r in L.lm_score(d).collect()}
    p = np.array([r.n for r in L.count_words(d).collect()], float)
    p /= p.sum()
    assert np.mean([r.mean_log_prob for r in got.values()]) > 0.8 * float((p * np.log(p)).sum())  # better than frequencies alone


def test_neighbours_tell_more_than_frequencies(spark):
    """Documents that were not learned from: the network gains half a nat a word over the words' frequencies."""
    from sitegraph.llm import lm_score as L
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    counted = L.count_words(docs)
    v, n = L.vocabulary(counted), {r.h: r.n for r in counted.collect()}
    total = sum(n.values())
    net = L.train(docs.where("doc_id % 10 <> 0"), v, 1_000_000)
    held = [L.words(r.text) for r in docs.where("doc_id % 10 = 0").collect()]
    numbers = L.Encoder(v).encode(held)
    k, e, around = L.windows(L._split(numbers, held))
    counts = np.array([n[h] for h in numbers[3].tolist()], float)
    gain = (net.log_probability(k, e, around) - np.log(v.cells[k, e]) + math.log(total)).mean()
    assert gain > 0.4 and len(counts) > 300_000


def test_lm_edges(spark):
    from sitegraph.llm.lm_score import lm_score
    rows = edge_rows()
    out = lm_score(docs_of(spark, rows))
    got = {(r.doc_id, r.text): r for r in out.collect()}
    assert out.count() == len(rows) and set(docs_of(spark, rows).columns) <= set(out.columns)
    assert got[(2, "")].n_tokens == 0 and got[(2, "")].log_prob == 0 and got[(1, None)].mean_log_prob is None
    assert lm_score(docs_of(spark, [])).count() == 0


# -------------------------------------------------------------- main text
def test_main_text(spark):
    from sitegraph.llm.html_text import Page, main_text
    page = ('<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head><body>'
            '<nav><ul><li>menu</ul></nav><header>top</header><div class="ad x">buy</div><!-- c -->{}<article><h1>Head &amp; line</h1>'
            '<p><b>One<br>two&nbsp; \n three<p>Four<div id="comments">said</div></article><aside>s</aside><footer>&copy; f</footer></body></html>')
    assert Page(page).blocks == ["Head & line", "One two three", "Four"]
    assert Page("<p>a<p>b</b><ul><li>c<li>d</ul><table><tr><td>1<td>2</table>e<foo").blocks == ["a", "b", "c", "d", "1", "2", "e"]
    assert Page("<div>" * 5000 + "deep" + "</div>" * 5000).blocks == ["deep"]
    assert Page(None).blocks == Page("").blocks == [] and Page("1 < 2 &am").blocks == ["1 < 2 &am"]
    site = [(i, "https://h.org/%d" % i, f"<body><div>Our site</div><div>page {hash_word(i)}<p>Read on</p></div></body>") for i in range(12)]
    more = [(90, None, None), (91, "", ""), (92, "https://o.org/", "<div>Our site</div><p>x"), (92, "https://o.org/", "<div>Our site</div><p>x")]
    df = spark.createDataFrame([(*r, "z", "z") for r in site + more], "page_id long, url string, html string, text string, host string")
    got = sorted_rows(main_text(df), "page_id", "text")
    assert got == sorted([(i, f"page {hash_word(i)}") for i in range(12)] + [(90, ""), (91, ""), (92, "Our site\n\nx"), (92, "Our site\n\nx")], key=repr)
    assert main_text(df.limit(0)).count() == 0


def test_parts_that_are_no_article():
    from sitegraph.llm.html_text import Page, attributes
    def text(body):
        return Page(body).blocks
    assert text('<p data-id="ads">a</p><p class="share-price">b</p><p title=\'x class="ad"\'>c</p>') == ["a", "b", "c"]
    assert text('<form action="/x"><nav>n</nav><article><h1>h</h1><p>a</p><label>l</label></article></form>') == ["h", "a"]
    assert text('<p>a</p><form><p>Sign up</p><input></form>') == ["a"] and text(f'<form>{"<p>long text of a page</p>" * 30}</form>') != []
    for name in ("sidebar", "sidebar2", "sidebarLeft", "left-sidebar", "cookiebar", "cookie_banner", "commentsection", "comments", "x ad", "site-footer", "NavBar"):
        assert text(f'<p>a</p><div class="{name}">no</div><div id={name.split()[-1]}>no</div>') == ["a"], name
    for name in ("adapter", "shared-space", "navel", "commentary", "header-image-text-of-article", "related-party-deals"):
        assert text(f'<div class="{name}">a</div>') == ["a"], name
    assert text('<main><article><header><h1>h</h1></header>a</article><article class="comment">c</article><section id=comments><article>c</article></section></main>') == ["h", "a"]
    assert text('<div class="modal wrapper"><article>a</article></div>') == ["a"] and text('<div class="header">x</div><p>a') == ["a"]
    assert text('<article>a<div class="article-header">b</div><div class="header">c</div></article>') == ["a", "b", "c"]
    assert attributes("a=1 CLASS = 'x y' class=z data-x=\"a class='q'\" b") == {"a": "1", "class": "x y", "data-x": "a class='q'", "b": ""}


def _key(x):
    parts = [re.sub(r"\d+", "0", x.text or "")] if x.text else []
    return (x.tag, *parts, *map(_key, x))


def _leaves(x, template, inside=False):
    """Texts of the leaves that are in no template subtree, and the length of those that are."""
    box = x.tag in ("div", "section") if inside else x.tag not in ("html", "body", "main", "article")
    if box and _key(x) in template:
        return [], sum(len(y.text or "") for y in x.iter())
    own, lost = ([x.text] if x.text else []), 0
    for y in x:
        a, b = _leaves(y, template, inside or x.tag == "article")
        own, lost = own + a, lost + b
    return own, lost


def _subtrees(x, inside=False):
    box = x.tag in ("div", "section") if inside else x.tag not in ("html", "body", "main", "article")
    return ({_key(x)} if box and any(y.text for y in x.iter()) else set()).union(*(_subtrees(y, inside or x.tag == "article") for y in x))


def _plain_main_text(site):
    """Template removal over one host's pages, as trees."""
    trees = [ElementTree.fromstring(h) for h in site]
    least = max(min(10, max(2, -(-len(site) // 4))), -(-len(site) // 100))
    counts = collections.Counter(k for t in trees for k in _subtrees(t))
    recurs = {k for k, n in counts.items() if n >= least}
    votes = collections.Counter()
    for t in trees:
        own, lost = _leaves(t, recurs)
        if sum(map(len, own)) >= 0.2 * (sum(map(len, own)) + lost):
            votes.update(_subtrees(t) & recurs)
    template = {k for k, n in votes.items() if n >= least}
    out = []
    for t in trees:
        article = t.find(".//article")
        out.append("\n\n".join(_leaves(t, template)[0] if article is None else _leaves(article, template, False)[0]))
    return out


def _site(rng, n):
    """Pages of one host: boxes of sections and layouts, dated notices, own paragraphs, quotes, copies of whole pages."""
    pages = []
    for i in range(n):
        section = int(rng.integers(0, 3))
        top = [f"<div><p>Notice of section {'abc'[section]}</p><p>Mind the gap</p></div>"] * (rng.random() < 0.8)
        top += [f"<p>Posted on {i} May</p>"] * (rng.random() < 0.7) + ["<section><p>About us</p></section>"] * (rng.random() < 0.5)
        own = [f"<p>{' '.join(f'w{x}z' for x in rng.choice(list('abcdefghijklmnop'), 12))}</p>" for _ in range(int(rng.integers(0, 4)))]
        own += ["<p>A saying that many quote</p>"] * (rng.random() < 0.3)
        body = "".join(own) + "<div><p>Read more of it</p></div>" * (rng.random() < 0.6)
        body = f"<article>{body}</article>" if rng.random() < 0.4 else body
        pages.append(f"<body>{''.join(top)}{body}<ul><li>Home</li><li>Contact</li></ul></body>")
        if pages and rng.random() < 0.2:
            pages.append(pages[int(rng.integers(0, len(pages)))])
    return pages


def test_template_removal_against_trees(spark):
    from sitegraph.llm.html_text import main_text
    rng = np.random.default_rng(11)
    rows, want = [], []
    for k, n in enumerate([1, 2, 3, 5, 9, 30, 300]):
        site = _site(rng, n)
        rows += [(len(rows) + i, f"http://h{k}.org/{i}", h) for i, h in enumerate(site)]
        want += _plain_main_text(site)
    got = [r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("page_id").collect()]
    assert got == want
    plain = ["\n\n".join(x.text for x in ElementTree.fromstring(h).iter() if x.text) for _, _, h in rows]
    assert sum(a != b for a, b in zip(got, plain)) > 200


def test_template_of_small_and_of_large_hosts(spark):
    from sitegraph.llm.html_text import main_text
    five = [(i, f"http://a.org/{i}", f"<p>We use cookies on this site</p><p>{'abcde'[i]} text of its own</p>") for i in range(5)]
    three = [(100 + i, f"http://b.org/{i}", f"<p>Notice of part {'xyz'[i % 3]}</p><p>own words {hash_word(i)}</p>") for i in range(300)]
    copies = [(500 + i, f"http://c.org/{i}", "<p>One article</p><p>in copies only</p>") for i in range(40)]
    copies += [(600 + i, f"http://c.org/x{i}", f"<p>Menu</p><p>other words {hash_word(i)}</p>") for i in range(40)]
    df = spark.createDataFrame(five + three + copies, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in main_text(df).collect()}
    assert all(got[i] == f"{'abcde'[i]} text of its own" for i in range(5))
    assert all(got[100 + i] == f"own words {hash_word(i)}" for i in range(300))
    assert all(got[500 + i] == "One article\n\nin copies only" for i in range(40)) and all(got[600 + i] == f"other words {hash_word(i)}" for i in range(40))


def hash_word(i):
    return "".join("abcdefghij"[int(d)] for d in str(i))


# --------------------------------------------------------------- pipeline
def test_pipeline(spark, sf):
    """Every stage against the plain version on its own input."""
    import test_text_ops as B

    import corpus_pipeline as P
    from sitegraph.llm.common import stage
    from sitegraph.llm.toxicity import train
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in P.STAGES]
    assert names == ["toxicity", "line_dedup", "simhash", "decontamination", "packing"]
    held = {}
    for name, f in P.STAGES:
        before, docs = docs, stage(f(spark, docs, sf), "test")
        if name != "packing":
            assert docs.columns == before.columns
        held[name] = (sorted((r.doc_id, r.text) for r in before.collect()), docs)
    rows, out = held["toxicity"]
    model = train(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    from sitegraph.llm.toxicity import Hasher
    scores = model.score([Hasher().terms(t) for _, t in rows])
    assert sorted_rows(out, "doc_id") == sorted(((k,) for (k, _), s in zip(rows, scores) if s < 0.7), key=repr)
    rows, out = held["line_dedup"]
    assert sorted_rows(out, "doc_id", "text") == sorted(((k, t) for (k, _), t in zip(rows, B._line_dedup(rows, 2, 50))), key=repr)
    assert all(r.n_chars == len(r.text) for r in out.collect())
    rows, out = held["simhash"]
    groups = B._groups([B._simhash(t) for _, t in rows], 2)
    assert sorted_rows(out, "doc_id", "text") == sorted((r for i, r in enumerate(rows) if groups[i] == i), key=repr)
    rows, out = held["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    hit = {r[0] for r in B._decontaminate(rows, items) if r[4]}
    assert sorted_rows(out, "doc_id", "text") == sorted((r for r in rows if r[0] not in hit), key=repr) and hit
    rows, out = held["packing"]
    n, bound = _check_packing(rows, out, 4096)
    assert n <= bound + 1
    assert sorted_rows(P.run(spark, sf), "doc_id", "piece", "ids_crc32") == sorted_rows(out, "doc_id", "piece", "ids_crc32")
