"""SuperMinHash against a step-by-step version, and its links against all pairs."""
import re

import numpy as np
import pytest
from helpers import docs_of, edge_rows, sorted_rows

MASK = (1 << 64) - 1


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))


def _set(text, k):
    w = _words(text)
    return {" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def _plain(rows, k=3, percent=85):
    sets = [_set(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    low = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            low[find(i)] = min(low.get(find(i), key), key)
    out = []
    for i, (key, _) in enumerate(rows):
        own = low.get(find(i)) if sets[i] else key
        out.append((key, len(sets[i]), own, key == own))
    return sorted(out, key=repr)


def _got(df):
    return sorted_rows(df, "doc_id", "n_shingles", "component_id", "kept")


def _near_copies(rng, first, groups=12, words=120):
    """Copies of texts with some words changed, so that similarities stand on both sides of the threshold."""
    rows = []
    for _ in range(groups):
        base = [f"w{x}" for x in rng.integers(0, 400, words)]
        for _ in range(int(rng.integers(2, 9))):
            own = list(base)
            for _ in range(int(rng.integers(0, 7))):
                own[int(rng.integers(0, words))] = f"x{rng.integers(0, 1000)}"
            rows.append((first + len(rows), " ".join(own)))
    return rows


def _mixed(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ x >> 27) * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def _one_by_one(elements, m):
    """Whole shuffles, without stopping early."""
    out = [m << 32] * m
    for h in elements:
        place = list(range(m))
        for j in range(m):
            x = _mixed((h + (j + 1) * 0x9E3779B97F4A7C15) & MASK)
            k = j + ((x & 0xFFFFFFFF) * (m - j) >> 32)
            place[j], place[k] = place[k], place[j]
            out[place[j]] = min(out[place[j]], j << 32 | x >> 32)
    return out


def test_signatures_with_early_stopping():
    from sitegraph.llm import superminhash as S
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (1, 2, 7, 40, 300, 0, 900)]
    got = S.signatures(sets, 140)
    assert got.tolist() == [_one_by_one(s.tolist(), 140) for s in sets]
    whole, S.ELEMENTS = S.ELEMENTS, 100
    try:
        assert (S.signatures(sets, 140) == got).all()
    finally:
        S.ELEMENTS = whole


def test_signatures_estimate_similarity():
    from sitegraph.llm.superminhash import bands_of, most_differing, signatures
    rng = np.random.default_rng(4)
    for n, same in ((400, 0.85), (400, 0.5), (60, 0.85)):
        error = []
        for _ in range(60):
            x = rng.integers(0, 1 << 63, 2 * n).astype(np.uint64)
            both = round(n * 2 * same / (1 + same))
            a, b = signatures([x[:n], np.concatenate([x[:both], x[n:2 * n - both]])], 140)
            error.append((a == b).mean() - both / (2 * n - both))
        assert abs(np.mean(error)) < 0.02 and np.var(error) < 1.2 * same * (1 - same) / 140
    assert bands_of(85) == 28 and most_differing(85) < 64


def test_near_duplicates_of_the_table(spark, sf):
    from sitegraph.llm.superminhash import superminhash
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows += _near_copies(np.random.default_rng(1), 10_000)
    want = _plain(rows)
    got = _got(superminhash(docs_of(spark, rows), 3, 85))
    assert got == want and 20 < sum(not r[3] for r in got)


@pytest.mark.parametrize("limit, block, weight", [(3, 4, 10_000), (4096, 6, 1200)])
def test_large_buckets_and_components(spark, limit, block, weight):
    from sitegraph.llm.superminhash import superminhash
    rows = _near_copies(np.random.default_rng(limit), 0, groups=5)
    chain = [f"c{i}" for i in range(150)]
    rows += [(500 + s, " ".join(chain[3 * s:3 * s + 100])) for s in range(16)]  # neighbours are similar, ends are not
    rows += [(600 + s, " ".join(chain[20 * s % 50:][:80] + [f"y{s}-{i}" for i in range(30)])) for s in range(20)]
    assert _got(superminhash(docs_of(spark, rows), 3, 85, limit=limit, block=block, weight=weight)) == _plain(rows)


def test_edges(spark):
    from sitegraph.llm.superminhash import superminhash
    rows = edge_rows() + [(30, "one two"), (31, "ONE\ttwo"), (32, "one"), (None, "one two"), (33, "one two"), (33, "one two")]
    for k, percent in ((3, 85), (5, 80)):
        assert _got(superminhash(docs_of(spark, rows), k, percent)) == _plain(rows, k, percent)
    named = superminhash(docs_of(spark, rows).selectExpr("concat('d', doc_id) AS doc_id", "text"), 3, 85)
    assert named.where("doc_id = 'd7'").first().component_id == "d6"
    assert superminhash(docs_of(spark, [])).count() == 0 and superminhash(docs_of(spark, [(1, None)])).first().kept
