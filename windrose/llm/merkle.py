"""Merkle manifest of a dataset, proved by a recursive climb (operator 12).

Rows are leaves; every lang has a tree of its own whose runs of eight
consecutive nodes become their digest, and the trees' subroots are the leaves of
one more tree.  The built levels are stored as rows linked to their parents,
each with the digests of its siblings.  A recursive query then climbs from every
leaf to the root: each step appends the siblings it meets and folds the
(possibly tampered) digest with the original ones.

The leaves of one run share every sibling above the run, so they climb as one
row with an array of eight digests and one list of siblings.  All steps join on
a node's unique place, so no step has a hot key; a lang of any size is numbered
by range partitions.

Defined cases: a null column counts as ``-`` in a leaf; rows with a null lang
are a tree of their own, the first one; rows without an order value come first
in their tree; rows with one order value are ordered by their leaf digest, equal
rows being interchangeable; a text of any length, or an empty one, is one leaf;
a lone leaf is its tree's subroot and a lone subroot is the root, with no
siblings to prove it; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrose.llm.common import materialise, prepare
from windrose.llm.places import numbered

FAN = 8
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = -1                 # the tree over the subroots
_LEVELS = 100            # of the recursive query; a tree of 8^90 leaves would need more


def leaf_text(values: Sequence[Column]) -> Column:
    """``-`` for a null, else the UTF-8 byte count, ``:`` and the value; concatenated."""
    parts = []
    for v in values:
        s = v.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")))
    return F.concat(*parts)


def digest(text: Column) -> Column:
    """SHA-256 as 32 bytes; tables hold digests so, inputs are built from their hex text."""
    return F.unhex(F.sha2(text, 256))


def hex_text(binary: Column | str) -> Column:
    """Lowercase hex; of concatenated digests, the concatenated hex texts."""
    return F.lower(F.hex(binary))


def _joined(digests: Column) -> Column:
    return F.aggregate(digests, F.lit(b""), lambda a, x: F.concat(a, x))


@dataclass
class Forest:
    """runs: (tree, run, leaves) of the leaf level; nodes: the built levels; root: its node and digest."""
    runs: DataFrame
    nodes: DataFrame
    root: tuple[int, int, bytes] | None


def _built(level0: DataFrame, height: int, label: str) -> list[DataFrame]:
    """Levels 1, 2, ... over (tree, idx, hash, n): the nodes (tree, level, idx, hash, n)
    with their run's digests, for trees that still have several nodes."""
    levels = []
    nodes = level0
    for level in range(1, height + 1):
        runs = (nodes.filter("n > 1").groupBy("tree", F.expr(f"idx div {FAN}").alias("idx"))
                .agg(F.array_sort(F.collect_list(F.struct("idx", "hash")))["hash"].alias("below"), F.first("n").alias("n")))
        up = materialise(runs.select("tree", F.lit(level).alias("level"), "idx", digest(hex_text(_joined(F.col("below")))).alias("hash"),
                                     F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"), "below"), f"{label}-{level}")
        levels.append(up)
        nodes = up
    return levels


def _height(leaves: int) -> int:
    height = 0
    while leaves > 1:
        leaves, height = -(-leaves // FAN), height + 1
    return height


def _linked(levels: list[DataFrame]) -> list[DataFrame]:
    """Every child of each level's runs as a row linked to its parent: (tree, level,
    idx, hash, before, after, up_tree, up_level, up_idx)."""
    rows = []
    for up in levels:
        one = up.select("tree", (F.col("level") - 1).alias("level"), "idx", "below", F.posexplode("below").alias("pos", "hash"))
        rows.append(one.select(
            "tree", "level", (F.col("idx") * FAN + F.col("pos")).alias("idx"), "hash",
            _joined(F.slice("below", F.lit(1), F.col("pos"))).alias("before"),
            _joined(F.slice("below", F.col("pos") + 2, F.lit(FAN))).alias("after"),
            F.col("tree").alias("up_tree"), (F.col("level") + 1).alias("up_level"), F.col("idx").alias("up_idx")))
    return rows


def build(leaves: DataFrame) -> Forest:
    """Trees over (tree_key, order_value, leaf, tampered, ...): one tree per tree_key, leaves
    in ascending order_value; further columns stay with the leaves."""
    extra = [c for c in leaves.columns if c != "tree_key"]
    placed = numbered(materialise(leaves, "merkle-leaves"), "tree_key",
                      [F.col("order_value").asc_nulls_first(), F.col("leaf").asc()], "merkle-sorted")
    sizes = placed.groupBy("tree_key").agg(F.first("of").alias("n")).withColumn("all", F.lit(0))
    trees = materialise(numbered(materialise(sizes, "merkle-sizes"), "all", [F.col("tree_key").asc_nulls_first()], "merkle-keys")
                        .select(F.struct("tree_key").alias("key"), F.col("place").alias("tree"), "n"), "merkle-trees")
    most, count = trees.agg(F.max("n"), F.count(F.lit(1))).first()
    runs = materialise(
        placed.withColumn("key", F.struct("tree_key")).join(trees.select("key", "tree"), "key")
        .groupBy("tree", F.expr(f"place div {FAN}").alias("run"))
        .agg(F.array_sort(F.collect_list(F.struct("place", *extra))).alias("leaves"), F.first("of").alias("n")), "merkle-runs")
    if not count:
        return Forest(runs, spark_nodes(runs), None)

    # level 1 groups the stored runs themselves; their leaves are linked through the run
    first = runs.select("tree", F.lit(1).alias("level"), F.col("run").alias("idx"), "n",
                        F.expr("transform(leaves, x -> x.leaf)").alias("below"))
    lone = first.filter("n = 1").select("tree", F.lit(0).alias("level"), F.lit(0).cast("long").alias("idx"), F.col("below")[0].alias("hash"),
                                        F.lit(1).cast("long").alias("n"))
    levels = []
    height = _height(most)
    if height:
        ones = materialise(first.filter("n > 1").select(
            "tree", "level", "idx", digest(hex_text(_joined(F.col("below")))).alias("hash"),
            F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"), "below"), "merkle-level-1")
        levels = [ones, *(x.withColumn("level", F.col("level") + 1) for x in _built(ones, height - 1, "merkle-level"))]
    subroots = reduce(DataFrame.unionByName, [lone, *(x.filter("n = 1").drop("below") for x in levels)])
    subroots = materialise(subroots, "merkle-subroots")
    top = _built(subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), "hash",
                                 F.lit(count).cast("long").alias("n")), _height(count), "merkle-top")
    # a subroot climbs on as a leaf of the top tree
    links = [x.withColumn("subroot", F.lit(False)) for x in _linked(levels[1:]) + _linked(top[1:])]
    for leaf in _linked(top[:1]):
        at = subroots.select(F.col("tree").alias("own"), F.col("level").alias("own_level"))
        links.append(leaf.join(at, F.col("idx") == F.col("own")).select(
            F.col("own").alias("tree"), F.col("own_level").alias("level"), F.lit(0).cast("long").alias("idx"), "hash", "before", "after",
            "up_tree", "up_level", "up_idx", F.lit(True).alias("subroot")))
    nodes = materialise(reduce(DataFrame.unionByName, links), "merkle-nodes") if links else spark_nodes(runs)
    peak = (top[-1] if top else subroots).filter("n = 1").first()
    return Forest(runs, nodes, (peak["tree"], peak["level"], bytes(peak["hash"])))


def spark_nodes(df: DataFrame) -> DataFrame:
    """An empty node table."""
    return df.sparkSession.createDataFrame([], "tree long, level int, idx long, hash binary, before binary, after binary, "
                                               "up_tree long, up_level int, up_idx long, subroot boolean")


_STEP = "unhex(sha2(concat(lower(hex({before})), lower(hex({own})), lower(hex({after}))), 256))"

# a row climbs for all leaves of its run: folded holds one digest for each of them
_CLIMB = f"""
WITH RECURSIVE climb(tree0, run, tree, level, idx, folded, path, subroot) AS (
  SELECT tree0, run, tree, level, idx, folded, path, subroot FROM {{start}}
  UNION ALL
  SELECT c.tree0, c.run, n.up_tree, n.up_level, n.up_idx,
         transform(c.folded, f -> {_STEP.format(before='n.before', own='f', after='n.after')}),
         concat(c.path, n.before, n.after),
         CASE WHEN n.subroot THEN n.hash ELSE c.subroot END
  FROM climb c JOIN {{nodes}} n ON c.tree = n.tree AND c.level = n.level AND c.idx = n.idx
)
SELECT tree0, run, folded, path, subroot FROM climb WHERE tree = {{tree}} AND level = {{level}} AND idx = 0
"""


def climb(forest: Forest) -> DataFrame:
    """(leaves, folded, path, subroot) for each run of leaves: what its leaves fold to at
    the root, and the siblings above the run."""
    spark = forest.runs.sparkSession
    digests = F.col("leaves")["leaf"]
    folded = F.transform("leaves", lambda x, i: F.when(
        F.col("n") > 1, digest(F.concat(hex_text(_joined(F.slice(digests, F.lit(1), i))), hex_text(x["tampered"]),
                                        hex_text(_joined(F.slice(digests, i + 2, F.lit(FAN))))))).otherwise(x["tampered"]))
    start = forest.runs.select(F.col("tree").alias("tree0"), "run", "tree", F.when(F.col("n") > 1, 1).otherwise(0).alias("level"),
                               F.col("run").alias("idx"), folded.alias("folded"), F.lit(b"").alias("path"),
                               F.lit(None).cast("binary").alias("subroot"))
    # the recursive query has a limit of rows of its own, which grows with no table
    limits = {"spark.sql.cteRecursionRowLimit": "-1", "spark.sql.cteRecursionLevelLimit": str(_LEVELS)}
    before = {k: spark.conf.get(k) for k in limits}
    for k, v in limits.items():
        spark.conf.set(k, v)
    try:
        top = materialise(spark.sql(_CLIMB, start=materialise(start, "merkle-start"), nodes=forest.nodes,
                                    tree=forest.root[0], level=forest.root[1]), "merkle-climb")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return top.withColumnRenamed("tree0", "tree").join(forest.runs, ["tree", "run"])


def manifest(docs: DataFrame, tampered: Column | None = None, columns: Sequence[str] = LEAF_COLUMNS, tree: str = "lang",
             order: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for every row.

    ``tampered`` replaces the text column in what is checked against the
    manifest (nothing is tampered with by default); digests come as lowercase hex.
    """
    prepare(docs.sparkSession)
    changed = [F.col(text) if tampered is None and c == text else tampered if c == text else F.col(c) for c in columns]
    leaves = docs.select(F.col(tree).alias("tree_key"), F.col(order).alias("order_value"),
                         digest(leaf_text([F.col(c) for c in columns])).alias("leaf"), digest(leaf_text(changed)).alias("tampered"))
    forest = build(leaves)
    if forest.root is None:
        kind = docs.schema[order].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"doc_id {kind}, leaf string, subroot string, root string, "
                                                     "proof_sha256 string, folded_root string, verified boolean")
    root = F.lit(forest.root[2].hex())
    rows = climb(forest).select(F.coalesce(hex_text("subroot"), root).alias("subroot"), "path", F.col("leaves")["leaf"].alias("below"),
                                F.posexplode(F.arrays_zip("leaves", "folded")).alias("i", "one"))
    siblings = F.concat(_joined(F.slice("below", F.lit(1), F.col("i"))), _joined(F.slice("below", F.col("i") + 2, F.lit(FAN))), F.col("path"))
    folded = hex_text("one.folded")
    return rows.select(F.col("one.leaves.order_value").alias("doc_id"), hex_text("one.leaves.leaf").alias("leaf"), "subroot",
                       root.alias("root"), F.sha2(hex_text(siblings), 256).alias("proof_sha256"), folded.alias("folded_root"),
                       (folded == root).alias("verified"))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
