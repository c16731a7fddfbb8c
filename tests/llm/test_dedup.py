import hashlib
import random
from collections import Counter, defaultdict

import numpy as np

from tests.llm.conftest import frame, prose
from windrose.llm import minhash, quotient, repeats, suffix


# ------------------------------------------------------------ exact copies

def test_filters_merge_losslessly():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 1 << 58, 500, dtype=np.uint64)
    parts = [rng.choice(values, 400) for _ in range(5)]
    filters = []
    for p in parts:
        v, c = np.unique(p, return_counts=True)
        filters.append(quotient.CountingQuotientFilter.decode(
            quotient.CountingQuotientFilter.of_sorted(58, v, c).encode()))
    got_v, got_c = quotient.CountingQuotientFilter.merge(filters).sorted_entries()
    want_v, want_c = np.unique(np.concatenate(parts), return_counts=True)
    assert (got_v == want_v).all() and (got_c == want_c).all()


def test_exact_dedup(edge, edge_rows):
    rows = quotient.exact_dedup(edge).collect()
    groups = defaultdict(list)
    for i, t in zip(*edge_rows):
        groups[t or ""].append(i)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    assert len(rows) == len(edge_rows[0])
    stays = Counter()
    for r in rows:
        ids = by_sha[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
        stays[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(stays.values()) == {1} and len(stays) == len(groups)


def test_drop_copies_keeps_one_row_with_all_columns(edge, edge_rows):
    got = quotient.drop_copies(edge)
    assert got.columns == edge.columns
    rows = got.collect()
    assert Counter((r.text or "") for r in rows) == Counter(set(t or "" for t in edge_rows[1]))
    assert {r.doc_id for r in rows if r.text and r.text.startswith(edge_rows[1][2]) and r.text == edge_rows[1][2]} == {4}


def test_empty_tables(nothing):
    assert quotient.exact_dedup(nothing).count() == 0
    assert quotient.drop_copies(nothing).count() == 0
    assert minhash.near_dedup(nothing).count() == 0
    assert minhash.drop_near(nothing).count() == 0
    assert repeats.remove_repeats(nothing).count() == 0


# ------------------------------------------------------------ near copies

def shingle_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {b" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def components(ids, texts):
    """(doc_id, set size, smallest id reachable) by comparing all pairs."""
    sets = [shingle_set(t) for t in texts]
    up = list(range(len(ids)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(len(ids)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                up[find(a)] = find(b)
    out = []
    for x, i in enumerate(ids):
        own = [ids[y] for y in range(len(ids)) if find(y) == find(x) and ids[y] is not None]
        out.append((i, len(sets[x]), min(own, default=None) if sets[x] else i))
    return Counter(out)


def test_near_dedup_edges(edge, edge_rows):
    rows = minhash.near_dedup(edge).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows) == components(*edge_rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_near_dedup_of_a_large_group(spark, monkeypatch):
    """Variants of one text with growing numbers of changes, in blocks of a few classes."""
    monkeypatch.setattr(minhash, "CHUNK", 8)
    rng = random.Random(4)
    base = prose(rng, 150).split()
    texts = []
    for i in range(120):
        words = list(base)
        for _ in range(rng.randint(0, 8)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(1000)}"
        texts.append(" ".join(words))
    texts += [prose(rng, 60) for _ in range(30)] + texts[:10]
    ids = list(range(len(texts)))
    got = minhash.near_dedup(frame(spark, texts)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == components(ids, texts)


def test_drop_near_keeps_columns(edge, edge_rows):
    got = minhash.drop_near(edge)
    assert got.columns == edge.columns
    want = Counter()
    for i, _, c in components(*edge_rows).elements():
        want[i] += i == c
    assert Counter(r.doc_id for r in got.collect()) == +want


def test_drop_near_runs_one_python_stage_in_a_task(edge):
    """One for the rows that surely stay, one for the others; none feeds another."""
    plan = minhash.drop_near(edge)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2


def test_drop_near_judges_each_row_by_its_own_component(spark):
    rng = random.Random(6)
    base, other, alone, lone = (prose(rng, 80) for _ in range(4))
    near = lambda t: " ".join([*t.split()[:40], "changed", *t.split()[41:]])
    # null: a near copy, a word-equal copy, a unique text, one without words; 5: a near copy and the only survivor of 7
    rows = [(1, base), (None, near(base)), (None, base.upper()), (None, alone), (None, " "), (5, near(near(base))), (5, other),
            (7, near(other)), (9, lone)]
    got = minhash.drop_near(frame(spark, [t for _, t in rows], [i for i, _ in rows])).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter([(1, base), (None, alone), (None, " "), (5, other), (9, lone)])


# ------------------------------------------------------------ repeated passages

def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(0)
    for k in range(400):
        t = np.append(rng.integers(1, 1 + rng.integers(1, 5), rng.integers(1, 60)), 0)
        if k % 4 == 0:
            t = np.append(np.tile(rng.integers(1, 4, rng.integers(1, 5)), 9), 0)
        line = t.tolist()
        sa = suffix.suffix_array(t)
        assert sa.tolist() == sorted(range(len(line)), key=lambda i: line[i:])
        plcp = suffix.permuted_prefixes(t, sa)
        for r in range(1, len(sa)):
            a, b, k2 = sa[r], sa[r - 1], 0
            while line[a + k2] == line[b + k2]:
                k2 += 1
            assert plcp[a] == k2


def removed(texts, length):
    """(bytes, removed, runs, digest of the rest) of each text, window by window."""
    blobs = [(t or "").encode() for t in texts]
    seen = Counter(b[x:x + length] for b in blobs for x in range(len(b) - length + 1))
    out = []
    for b in blobs:
        gone = np.zeros(len(b), bool)
        for x in range(len(b) - length + 1):
            if seen[b[x:x + length]] > 1:
                gone[x:x + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        rest = bytes(c for c, g in zip(b, gone) if not g)
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(rest).hexdigest()))
    return out


def passages():
    rng = random.Random(5)
    words = ["a", "bb", "the", "of", "xyz", "é", "ñandú"]

    def some(n):
        return "".join(rng.choice(words) + rng.choice([" ", " ", ", ", "\n", ""]) for _ in range(n))
    shared = [some(60) for _ in range(5)]
    texts = [some(rng.randint(0, 40)) + rng.choice(shared)[rng.randint(0, 40):][:rng.randint(30, 150)]
             + some(rng.randint(0, 40)) for _ in range(50)]
    blob = "".join(rng.choice("abcdefghij") for _ in range(500))
    return texts + texts[:5] + ["", None, "Sh " * 200, "Sh " * 100 + "x", "a" * 300, "b" + "a" * 150, "xyz" * 90,
                                "q" * 40 + "ab" * 50, blob[:300], "zz " + blob[50:400] + " tail",
                                "--" + blob[120:260] + "!!", "中文" * 60, "x中文" * 40 + "中文" * 40]


def check_repeats(spark, **options):
    texts = passages()
    got = repeats.remove_repeats(frame(spark, texts).repartition(3), length=40, **options).collect()
    want = removed(texts, 40)
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) == want[r.doc_id]


def test_repeats_by_suffix_arrays(spark):
    check_repeats(spark)


def test_repeats_of_hot_anchors(spark):
    check_repeats(spark, hot_limit=2)


def test_repeats_edges(edge, edge_rows):
    got = repeats.remove_repeats(edge).collect()
    assert Counter((r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in got) == \
        Counter(removed(edge_rows[1], 400))
