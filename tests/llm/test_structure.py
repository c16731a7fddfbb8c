"""Conversation repair against a row-by-row search over all edits."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from windrose.llm import structure

STEPS = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
NAMES = {"u": "user", "a": "assistant"}
DDL = "conv_id long, turn long, role string, text string, conv string, place string, of string, fault string"


def with_insertions(best):
    while True:
        grown = dict(best)
        for p, (cost, audit, out) in best.items():
            for i, name in NAMES.items():
                if (p, i) in STEPS:
                    v = (cost + 3, audit + "I", out + ((name, ""),))
                    if i not in grown or v[:2] < grown[i][:2]:
                        grown[i] = v
        if grown == best:
            return best
        best = grown


def plain_repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, turns) of (turn, role, text) rows."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).digest()))
    best, seen, faults, illegal, ahead = with_insertions({"": (0, "", ())}), set(), Counter(), 0, None
    for turn, role, text in rows:
        initial = role[:1]
        illegal += ahead is not None and ahead + initial not in ("su", "ua", "au")
        ahead = initial
        core = text.strip("\t\n\x0b\x0c\r ")
        fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else ""
        seen.add((role, text))
        faults[fault] += 1
        new = {}

        def put(q, v):
            if q not in new or v[:2] < new[q][:2]:
                new[q] = v

        for p, (cost, audit, out) in best.items():
            put(p, (cost + 4, audit + "D", out))
            for q in "sua" if fault in ("", "truncated") else "":
                if (p, q) in STEPS:
                    more = cost + 3 * (fault == "truncated")
                    if initial == q:
                        put(q, (more, audit + "K", out + ((role, text),)))
                    if q in NAMES:
                        put(q, (more + 3, audit + "R", out + ((NAMES[q], text),)))
        best = with_insertions(new)
    cost, audit, out = min((best[p] for p in ("", "a") if p in best), key=lambda v: v[:2])
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, out


def digest(turns):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()


def plain_damage(conv_id, turn, role, text):
    name = lambda v: " " if v is None else str(v)
    kind = zlib.crc32(f"{name(conv_id)}:{name(turn)}".encode()) % 20
    role, text = name(role), name(text)
    role = "user" if kind == 4 else role
    text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
    return [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)


@pytest.fixture(scope="module")
def talk():
    rng = random.Random(5)
    rows = []
    texts = ["Yes.", "No", "", None, " \n", "Well?", "Fine!  ", "long " * 20_000 + "."]
    for conv in [None, *range(40)]:
        n = rng.randint(1, 12)
        for turn in range(n):
            rows.append((conv, rng.choice([turn, turn, turn, None, 3]),
                         rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                         rng.choice([*texts, f"Say {turn}.", f"Say {turn}.", f"Tell {turn}."])))
    # longer than a chunk, and than a merge of chunks
    for conv, n in ((100, structure.CHUNK + 1), (101, structure.CHUNK * structure.MERGE + 70), (102, 2 * structure.CHUNK)):
        rows += [(conv, t, rng.choice(["user", "assistant", "assistant"]), f"Turn {t}{rng.choice('.!?x')}") for t in range(n)]
    rows += [(103, t, "user", "Once.") for t in range(structure.CHUNK * 3)]        # nearly all are duplicates
    rows += [(104, 1, "user", "Gone.")] * 3
    return rows


def check(got, rows, ids):
    conv = defaultdict(list)
    for c, *r in rows:
        conv[c].append(tuple(r))
    assert len(got) == len(ids)
    for g in got:
        want = plain_repair(conv[g.conv_id])
        assert tuple(g)[1:8] == want[:7], g
        assert g.repaired_sha256 == digest(want[7])


def test_repair_matches_plain_search(spark, talk):
    df = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in talk], DDL)
    check(structure.repair(df).collect(), talk, {r[0] for r in talk})


def test_damage_and_original_ids(spark, talk):
    df = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in talk], DDL)
    rows = [(r[0], *d) for r in talk for d in plain_damage(*r)]
    check(structure.repair(structure.damaged(df), df).collect(), rows, {r[0] for r in talk})


def test_repaired_turns(spark, talk):
    df = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in talk], DDL)
    conv = defaultdict(list)
    for c, *r in talk:
        conv[c].append(tuple(r))
    got = defaultdict(list)
    for r in structure.repaired_turns(df).collect():
        got[r.conv_id].append((r.position, r.role, r.text))
    for c, rows in conv.items():
        assert [x[1:] for x in sorted(got[c])] == list(plain_repair(rows)[7])


def test_no_rows(spark):
    none = spark.createDataFrame([], DDL)
    assert structure.repair(none).count() == 0
    one = spark.createDataFrame([(7, 0, "user", "Hi.", "x", "x", "x", "x")], DDL)
    assert [tuple(r) for r in structure.repair(none, one).collect()] == [(7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_any_split_gives_the_cell():
    rng = random.Random(1)
    for _ in range(200):
        letters = "".join(rng.choice("suaxSUAX1234") for _ in range(rng.randint(2, 20)))
        cut = rng.randint(1, len(letters) - 1)
        assert structure.joined(structure.parse(letters[:cut]), structure.parse(letters[cut:])) == structure.parse(letters)
