import random

import pytest

DDL = "doc_id long, text string, lang string, source string, n_chars long, kept string, fp string, uid string, n string, spans string"


def prose(rng, words, alphabet="abcdefgh"):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 7))) for _ in range(words))


def frame(spark, texts, ids=None):
    """Documents with extra columns whose names the operators use themselves."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", 1, "x", "x", "x", "x", "x") for i, t in zip(ids, texts)], DDL)


@pytest.fixture(scope="session")
def edge_rows():
    """(ids, texts): null and empty texts, rows without doc_id, repeated rows, a very
    long text, copies and near copies, few words."""
    rng = random.Random(11)
    base = prose(rng, 120)
    near = base.split()
    near[60] = "changed"
    long = prose(rng, 30_000)
    rows = [(1, None), (2, ""), (3, base), (4, base), (5, " ".join(near)), (6, "one two"), (7, "ONE  two"), (8, long),
            (9, base + " " + prose(rng, 100)), (None, "without an id"), (None, None), (10, "same"), (10, "same"),
            (11, " \n\t"), (12, "ñandú 中文 😀 don't you'll"), (-5, long)]
    rows += [(100 + i, prose(rng, rng.randint(0, 40))) for i in range(40)]
    return [i for i, _ in rows], [t for _, t in rows]


@pytest.fixture()
def edge(spark, edge_rows):
    return frame(spark, edge_rows[1], edge_rows[0])


@pytest.fixture()
def nothing(spark):
    return spark.createDataFrame([], DDL)
