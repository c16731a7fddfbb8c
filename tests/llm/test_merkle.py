"""Merkle manifest against trees and climbs in plain Python."""

import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from tests.llm.conftest import DDL, prose
from windrose.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def levels(nodes):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [H(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]
        out.append(nodes)
    return out


def climb(tree, i, own):
    siblings = ""
    for nodes in tree[:-1]:
        run, at = nodes[i // 8 * 8:i // 8 * 8 + 8], i % 8
        siblings += "".join(run[:at] + run[at + 1:])
        own = H(*run[:at], own, *run[at + 1:])
        i //= 8
    return siblings, own


def plain(rows, change):
    """Sorted result rows of (doc_id, text, lang, source, n_chars)."""
    langs = defaultdict(list)
    for doc_id, text, lang, source, n in rows:
        langs[lang].append((doc_id is not None, doc_id or 0, leaf(doc_id, source, lang, n, text),
                            leaf(doc_id, source, lang, n, change(doc_id, text)), doc_id))
    keys = sorted(langs, key=lambda k: (k is not None, (k or "").encode()))
    trees = {k: levels([x[2] for x in sorted(langs[k], key=lambda x: x[:4])]) for k in keys}
    top = levels([trees[k][-1][0] for k in keys])
    root = top[-1][0]
    out = []
    for t, k in enumerate(keys):
        for i, (_, _, own, tampered, doc_id) in enumerate(sorted(langs[k], key=lambda x: x[:4])):
            low, folded = climb(trees[k], i, tampered)
            high, folded = climb(top, t, folded)
            out.append((doc_id, own, trees[k][-1][0], root, H(low, high), folded, folded == root))
    return sorted(out, key=str)


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, n, "x", "x", "x", "x", "x") for i, t, lang, s, n in rows], DDL)


def check(spark, rows, shout=True):
    change = (lambda i, t: t.lower() if t is not None and i is not None and i % 3 == 0 else t) if shout else (lambda i, t: t)
    column = F.when(F.col("doc_id") % 3 == 0, merkle.lower_ascii(F.col("text"))).otherwise(F.col("text")) if shout else None
    got = merkle.manifest(documents(spark, rows), column)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, change)


def test_many_trees(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([None, "", "ABC def", prose(rng, 20, "abcDEF")]), rng.choice(["en", "en", "en", "de", None, "ñ", "z"]),
             rng.choice(["web", None]), rng.choice([1, None])) for i in range(700)]
    rows += [(5, "Again", "en", "web", 1)] * 20 + [(None, "No id", "en", None, None)] * 9          # repeated rows, rows without id
    rows += [(1000 + i, "lone", f"x{i}", "web", 1) for i in range(70)]                       # lone leaves, three levels above them
    rows.append((2000, "W" * 100_000, "de", "web", 100_000))
    check(spark, rows)


def test_small_tables(spark):
    for n in (1, 9, 65):
        check(spark, [(i, "Text", "en", "s", 1) for i in range(n)])
    check(spark, [(3, "Text", None, "s", 1), (4, "Text", "en", "s", 1)])


def test_untouched_rows_verify(spark):
    rows = [(i, f"Text {i}", "en" if i % 2 else "de", "s", 1) for i in range(100)]
    check(spark, rows, shout=False)
    assert merkle.manifest(documents(spark, rows)).filter("NOT verified").isEmpty()


def test_no_rows(nothing):
    assert merkle.manifest(nothing).count() == 0
    assert merkle.manifest(nothing).columns[0] == "doc_id"


def test_limits_of_the_session_stay(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    merkle.manifest(documents(spark, [(i, "t", "en", "s", 1) for i in range(9)])).count()
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before
