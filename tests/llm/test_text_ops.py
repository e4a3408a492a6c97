"""Line dedup, decontamination, SimHash, substring dedup and fingerprints against plain Python."""
import collections
import hashlib
import re

import numpy as np
import pytest
import xxhash
from helpers import docs_of, edge_rows, sorted_rows, words
from pyspark.sql import functions as F


def _documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


# ------------------------------------------------------------- line dedup
def _line_dedup(rows, window, long_words=1 << 30):
    """rows: (doc_id, text) distinct; gives the texts, in order of rows."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    seen, out = set(), [None] * len(rows)
    for i in order:
        text = rows[i][1]
        if text is None:
            continue
        lines = text.split("\n")
        at = [j for j, x in enumerate(lines) if x.strip(" ")]
        drop = set()
        runs = [at[s:s + window] for s in range(len(at) - window + 1)] + [[j] for j in at if len(lines[j].split()) >= long_words]
        for places in runs:
            run = tuple(lines[j].strip(" ") for j in places)
            if run in seen:
                drop.update(places)
            seen.add(run)
        out[i] = "\n".join(x for j, x in enumerate(lines) if j not in drop)
    return out


@pytest.mark.parametrize("window", [1, 2, 3])
def test_line_dedup(spark, window):
    from sitegraph.llm.line_dedup import line_dedup
    rng = np.random.default_rng(window)
    rows = [(i, "\n".join(rng.choice(list("abcdef "), rng.integers(0, 12)))) for i in range(120)] + [(200, None), (201, "")]
    got = line_dedup(docs_of(spark, rows), window)
    assert sorted_rows(got, "doc_id", "text") == sorted(((r[0], t) for r, t in zip(rows, _line_dedup(rows, window))), key=repr)


def test_line_dedup_edges(spark):
    from sitegraph.llm.line_dedup import line_dedup
    rows = edge_rows()
    got = line_dedup(docs_of(spark, rows), 2)
    assert got.count() == len(rows) and set(docs_of(spark, rows).columns) <= set(got.columns)
    by = {r.doc_id: r for r in got.collect()}
    assert by[8].n_dropped == 0 and by[9].n_dropped == 2 and by[9].text == "x\n\nend"
    assert by[1].text is None and by[1].n_lines == 0 and by[10].text == "\n\n"
    assert line_dedup(docs_of(spark, []), 2).count() == 0


def test_line_dedup_single_long_lines(spark):
    from sitegraph.llm.line_dedup import line_dedup
    passage = " ".join(f"w{i}" for i in range(50))
    short = " ".join(f"w{i}" for i in range(49))
    rows = [(1, f"own one\n{passage}\nown two"), (2, f"  {passage}"), (3, f"a\n{passage}\nb\n\n{passage} \nc"), (4, f"x\n{short}\ny"),
            (5, f"z\n{short}"), (6, short), (7, f"p\n{passage}\nq"), (8, f"p\n{passage}\nr"), (9, "x" * 500 + "\n"), (10, "x" * 500), (11, None)]
    want = {1: rows[0][1], 2: "", 3: "a\nb\n\nc", 4: rows[3][1], 5: rows[4][1], 6: short, 7: "p\nq", 8: "r", 9: rows[8][1], 10: rows[9][1], 11: None}
    got = line_dedup(docs_of(spark, rows), 2, long_words=50).collect()
    assert {r.doc_id: r.text for r in got} == want
    assert {r.doc_id: r.n_dropped for r in got if r.n_dropped} == {2: 1, 3: 2, 7: 1, 8: 2}


# -------------------------------------------------------- decontamination
def _decontaminate(docs, items, n=10):
    grams = collections.defaultdict(set)
    for item, text in items:
        w = words(text)
        for s in range(max(1, len(w) - n + 1) if w else 0):
            grams[tuple(w[s:s + n])].add("" if item is None else str(item))
    out = []
    for key, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(g) for g in grams}:
            for s in range(len(w) - size + 1):
                g = tuple(w[s:s + size])
                if g in grams:
                    hit.update(range(s, s + size))
                    found |= grams[g]
        out.append((key, len(w), len(hit), sorted(found), bool(hit)))
    return sorted(out, key=repr)


def test_decontamination(spark, sf):
    from sitegraph.llm.decontaminate import decontaminate
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in _documents(spark, sf).collect()]
    more = [(7_000, f"Zz, {items[0][1].upper()} zz"), (7_001, " ".join(items[1][1].split()[:9])), (7_002, "a short ITEM, here")]
    items += [(9_000, "Short item"), (9_001, None), (None, "Zz"), (9_002, "..."), (9_003, items[0][1])]
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'z' AS gram", "'z' AS item")
    got = decontaminate(docs_of(spark, rows + more), b)
    got = sorted_rows(got, "doc_id", "n_words", "hits", "items", "contaminated")
    assert got == _decontaminate(rows + more, items)
    assert sum(r[4] for r in got) > 3


def test_decontamination_edges(spark):
    from sitegraph.llm.decontaminate import PositionalIndex, decontaminate
    rows = edge_rows() + [(20, "x the same line here of some other words in every one")]
    items = spark.createDataFrame([(1, "the same line of words in every one of these documents"), (2, "C"), (2, "C")], "item_id long, text string")
    got = sorted_rows(decontaminate(docs_of(spark, rows), items), "doc_id", "n_words", "hits", "items", "contaminated")
    assert got == _decontaminate(rows, [(1, "the same line of words in every one of these documents"), (2, "C")])
    assert not any(r[4] for r in sorted_rows(decontaminate(docs_of(spark, rows), items.limit(0)), "doc_id", "n_words", "hits", "items", "contaminated"))
    assert decontaminate(docs_of(spark, []), items).count() == 0
    near = PositionalIndex(docs_of(spark, [(1, "one two x three four"), (2, "four x x x three two one"), (3, "one two")]),
                           spark.createDataFrame([(1, "one two three four")], "item_id long, text string"), slop=2)
    assert near.phrases().count() == 0
    assert near.proximity().select("k1").distinct().count() == 1  # the second is spread too far, the third lacks words


# ---------------------------------------------------------------- simhash
def _simhash(text, k=3):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def _groups(fps, radius):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= radius:
                r, s = find(i), find(j)
                parent[max(r, s)] = min(r, s)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("limit", [4096, 1])
def test_simhash(spark, sf, limit, monkeypatch):
    from sitegraph.llm import simhash
    monkeypatch.setattr(simhash, "LIMIT", limit)  # 1: every shared key is crowded
    rows = sorted((r.doc_id, r.text) for r in _documents(spark, sf).collect())
    rows += [(10_000 + i, " ".join(rows[i][1].split()[:-1])) for i in range(40)] + [(20_000, None), (20_001, ""), (20_002, "x")]
    fps = [_simhash(t) for _, t in rows]
    assert [simhash.fingerprint(t) for _, t in rows] == fps
    want = [(k, f - (1 << 64) if f >> 63 else f, rows[g][0]) for (k, _), f, g in zip(rows, fps, _groups(fps, 2))]
    assert sorted_rows(simhash.simhash(docs_of(spark, rows)), "doc_id", "fp", "component_id") == sorted(want, key=repr)
    assert len({w[2] for w in want}) < len(rows) - 20


def test_near_dedup_edges(spark):
    from sitegraph.llm.simhash import near_dedup, simhash
    rows = edge_rows()
    d = docs_of(spark, rows)
    assert simhash(d).count() == len(rows)
    got = near_dedup(d)
    assert got.columns == d.columns
    kept = sorted_rows(got, "doc_id", "text")
    # one of the empty ones, of the abc rows, of the long and of the accented texts
    assert [k for k, _ in kept].count(4) == 1 and not {5, 7, 12} & {k for k, t in kept if t != "other"}
    assert sum(not (t or "").strip() for _, t in kept) == 1
    assert near_dedup(docs_of(spark, [])).count() == 0


def test_near_dedup_keeps_unlike_texts_of_one_id(spark):
    from sitegraph.llm.simhash import near_dedup
    unlike = [" ".join(f"{x}{i}" for i in range(40)) for x in ("red", "green", "blue", "white", "black", "grey")]
    rows = [(None, t) for t in unlike[:4]] + [(None, unlike[0]), (7, unlike[4]), (7, unlike[5]), (8, unlike[5]), (9, unlike[1])]
    assert max(collections.Counter(_groups([_simhash(t) for t in unlike], 2)).values()) == 1
    got = sorted_rows(near_dedup(docs_of(spark, rows)), "doc_id", "text")
    assert got == sorted([*((None, t) for t in unlike[:4]), (7, unlike[4]), (7, unlike[5])], key=repr)


def test_bit_sliced_links():
    from sitegraph.llm.simhash import linked
    rng = np.random.default_rng(0)
    for _ in range(12):
        keys = np.sort(rng.integers(0, rng.integers(1, 30), rng.integers(1, 400)))
        fps = rng.integers(0, 2**63, 5, dtype=np.uint64)[rng.integers(0, 5, len(keys))]
        for _ in range(rng.integers(0, 4)):
            fps = fps ^ (np.uint64(1) << rng.integers(0, 64, len(keys)).astype(np.uint64))
        for radius in (0, 1, 2, 3):
            def parts(edges):
                p = {}

                def find(x):
                    while p.setdefault(x, x) != x:
                        x = p[x]
                    return x
                for x, y in edges:
                    r, s = find(x), find(y)
                    p[max(r, s)] = min(r, s)
                return {x: find(x) for x in p}
            a, b = linked(keys, fps, radius)
            want = [(int(fps[i]), int(fps[j])) for i in range(len(fps)) for j in range(i)
                    if keys[i] == keys[j] and fps[i] != fps[j] and (int(fps[i]) ^ int(fps[j])).bit_count() <= radius]
            assert parts(want) == parts([(int(x), int(y)) for x, y in zip(a, b) if x != y])


def test_components(spark):
    from sitegraph.llm.components import components
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.a: r.b for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# -------------------------------------------------------- substring dedup
def _substrings(texts, length):
    count = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                gone[i:i + length] = True
        spans = int((gone & ~np.concatenate([[False], gone])[:len(t)]).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("shard", [28_000, 1])
def test_substring_dedup(spark, shard):
    from sitegraph.llm.substring_dedup import substring_dedup
    rng = np.random.default_rng(5)
    base = ["".join(rng.choice(list("abcé \n"), 60)) for _ in range(6)]
    texts = []
    for _ in range(60):
        s = "".join(base[j] for j in rng.integers(0, 6, rng.integers(0, 6)))
        cut = int(rng.integers(0, max(1, len(s))))
        texts.append(s[:cut] + "".join(rng.choice(list("abc"), rng.integers(0, 20))) + s[cut:])
    texts += ["", "a" * 300, "ab" * 100, texts[3], texts[3], None]
    rows = [(i // 2 if i < 4 else i, t) for i, t in enumerate(texts)]
    got = substring_dedup(docs_of(spark, rows), 40, gram=12, shard=shard)
    got = sorted_rows(got, "text", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert got == sorted(((t, *x) for t, x in zip(texts, _substrings([(t or "").encode() for t in texts], 40))), key=repr)


def test_substring_dedup_edges(spark):
    from sitegraph.llm.substring_dedup import substring_dedup
    rows = edge_rows()
    got = sorted_rows(substring_dedup(docs_of(spark, rows)), "doc_id", "n_bytes", "n_removed")
    want = _substrings([(t or "").encode() for _, t in rows], 200)
    assert got == sorted(((k, w[0], w[1]) for (k, _), w in zip(rows, want)), key=repr)
    assert substring_dedup(docs_of(spark, [])).count() == 0


def test_suffix_array():
    from sitegraph.llm.suffix_array import common_prefixes, lay_out, suffix_array
    rng = np.random.default_rng(0)
    for _ in range(25):
        contexts = [bytes(rng.integers(97, 97 + rng.integers(1, 3), rng.integers(1, 50)).astype(np.uint8)) for _ in range(rng.integers(1, 20))]
        s, start = lay_out(contexts)
        depth = int(rng.integers(1, 25))
        sa = suffix_array(s)
        b = s.tolist()
        assert sa.tolist() == sorted(range(len(b)), key=lambda i: b[i:])
        for i, n in enumerate(common_prefixes(s, start, sa, depth).tolist()):
            x, y = b[sa[i - 1]:] if i else [], b[sa[i]:]
            k = 0
            while k < min(len(x), len(y), depth) and x[k] == y[k]:
                k += 1
            assert k == n


# ----------------------------------------------------------- fingerprints
def test_winnowing_by_definition():
    from sitegraph.llm.winnowing import gram_hashes, winnow
    rng = np.random.default_rng(0)
    for _ in range(150):
        s = "".join(rng.choice(list("ab"), rng.integers(1, 200)))
        k, window = int(rng.integers(1, 9)), int(rng.integers(1, 20))
        with np.errstate(over="ignore"):
            h = gram_hashes(np.frombuffer(s.encode("utf-32-le"), np.uint32), min(k, len(s)))
        size = min(window, len(h))
        want = sorted({max(range(i, i + size), key=lambda q: (-int(h[q]), q)) for i in range(len(h) - size + 1)})
        assert winnow(s, k, window)[1].tolist() == want


def test_edited_likeness(spark):
    from sitegraph.llm.winnowing import as_string, edited_likeness, fingerprints, likeness, winnow
    rows = [r for r in edge_rows() if r[0] not in (4, 5, None)] + [(50 + i, f"text number {i} " * (i % 7)) for i in range(60)] + [(None, "no id")]
    got = {r.doc_id: r for r in edited_likeness(docs_of(spark, rows)).collect()}
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: -1 if r[0] is None else r[0], reverse=True)
    for (key, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        cut = len(text) // 2
        edited = text[:len(text) - cut] + after[:cut]
        (a, at), (b, bt), (c, _) = (winnow(x) for x in (text, edited, after))
        same = set(zip(a.tolist(), at.tolist())) & set(zip(b.tolist(), bt.tolist()))
        assert tuple(got[key]) == (key, len(text), hashlib.sha256(edited.encode()).hexdigest(), as_string(a), as_string(b),
                                   likeness(a, b), likeness(a, c), len(same))
    assert edited_likeness(docs_of(spark, [])).count() == 0
    one = edited_likeness(docs_of(spark, [(1, "abcd")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1.0
    repeated = edited_likeness(docs_of(spark, [(1, "abcd"), (1, "abcd"), (1, "xy")]))
    assert repeated.count() == 3
    # ids that are text, one of them on most rows: rows of one id follow each other, every row but one of an id is next of another
    # (texts differ in their first halves, so an edited text names both)
    many = [("b", f"{i:03d} is the number of this row of an id that has many of them, {i}") for i in range(300)] + [("a", "aa first of all"), ("c", "cc last of all"), (None, "nn none")]
    df = spark.createDataFrame(many, "doc_id string, text string").repartition(5)
    out = edited_likeness(df).collect()
    texts = sorted(t for _, t in many)
    by = {hashlib.sha256((t[:len(t) - len(t) // 2] + u[:len(t) // 2]).encode()).hexdigest(): (t, u) for t in texts for u in texts}
    pairs = [by[r.edited_sha256] for r in out]
    assert sorted(t for t, _ in pairs) == texts and len({r.doc_id for r in out}) == 4
    firsts = {u for _, u in pairs}
    assert {"aa first of all", "nn none", "cc last of all"} <= firsts and dict(pairs)["nn none"] == "cc last of all" and dict(pairs)["aa first of all"] == "nn none"
    marks = fingerprints(docs_of(spark, edge_rows())).collect()
    assert len(marks) == len(edge_rows()) and all(len(r.hashes) == len(r.positions) for r in marks)
