"""N-gram Jaccard join against comparing all pairs."""

import random
from collections import defaultdict

import numpy as np
import pytest

from tests.llm.conftest import frame, prose
from windrose.llm import jaccard
from windrose.llm.minhash import words_of


def grams(text, size=4):
    w = words_of(text or "")
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def plain(ids, texts, percent=85):
    """{(doc_id, n_shingles, component_id)} of rows that all have an id, all pairs compared."""
    sets = [grams(t) for t in texts]
    up = list(range(len(sets)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if n and 100 * n >= percent * len(sets[a] | sets[b]) or ids[a] == ids[b]:
                up[find(a)] = find(b)
    least = defaultdict(lambda: 1 << 60)
    for i in range(len(sets)):
        least[find(i)] = min(least[find(i)], ids[i])
    return sorted((ids[i], len(sets[i]), least[find(i)]) for i in range(len(sets)))


def got(df, **more):
    return sorted(map(tuple, jaccard.jaccard_components(df, **more).collect()))


def variants(rng, base, changes, n):
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(rng.randint(0, changes)):
            w[rng.randrange(len(w))] = prose(rng, 1)
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(9)
    out = [prose(rng, rng.randint(0, 60)) for _ in range(60)]
    for words, changes, n in ((100, 3, 60), (100, 6, 60), (60, 2, 40), (8, 1, 20), (300, 12, 50)):
        out += variants(rng, prose(rng, words), changes, n)
    shared = prose(rng, 60)
    out += [shared + " " + prose(rng, rng.randint(5, 40)) for _ in range(40)]           # one passage, rest differs
    out += [shared + " " + " ".join(rng.choice(["aa bb cc dd ee", "ff gg hh ii jj"]) for _ in range(3)) for _ in range(20)]
    out += ["", None, " \n\t", "one", "ONE", "one two"] + [out[70]] * 30
    return out


def test_components_match_all_pairs(spark, corpus):
    assert got(frame(spark, corpus).repartition(5)) == plain(range(len(corpus)), corpus)


def test_blocks_find_what_stars_leave(spark, corpus, monkeypatch):
    monkeypatch.setattr(jaccard, "STARS", 0)
    monkeypatch.setattr(jaccard, "CHUNK", 7)
    monkeypatch.setattr(jaccard, "SHARD", 500)
    monkeypatch.setattr(jaccard, "CELL", 100)          # and many cells
    few = corpus[::2]
    assert got(frame(spark, few)) == plain(range(len(few)), few)


def test_edge_rows(spark, edge, edge_rows):
    ids, texts = edge_rows
    rows = jaccard.jaccard_components(edge).collect()
    assert len(rows) == len(ids)
    known = [(i, t) for i, t in zip(ids, texts) if i is not None]
    want = set(plain([i for i, _ in known], [t for _, t in known]))
    assert {tuple(r) for r in rows if r.doc_id is not None} == want
    assert sorted((r.n_shingles, r.component_id) for r in rows if r.doc_id is None) == [(1, None), (0, None)][::-1]


def test_no_rows(nothing):
    assert jaccard.jaccard_components(nothing).count() == 0


def test_threshold_is_exact(spark):
    """Pairs of sets right at and right below the threshold."""
    base = [f"w{i}" for i in range(40)]
    texts = [" ".join(base + [f"{t}{i}" for i in range(k)]) for t, k in (("a", 0), ("b", 6), ("c", 7), ("d", 3), ("e", 4))]
    assert got(frame(spark, texts)) == plain(range(len(texts)), texts)


def test_prefix_length_misses_no_link():
    rng = np.random.default_rng(4)
    need = jaccard._need(85)
    for _ in range(2000):
        na, nb = rng.integers(1, 60, 2)
        both = need(int(na), int(nb))
        if 100 * min(na, nb) >= 85 * max(na, nb):
            assert both >= na - jaccard.prefix_length(int(na)) + 1 and both >= nb - jaccard.prefix_length(int(nb)) + 1
