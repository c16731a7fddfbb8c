"""Comparison, in blocks of bounded size, of classes that share a bucket but lie in
different components (used by the near-duplicate operators).

In a bucket, the classes outside its largest component (the rest) meet all
classes of the bucket, in blocks of ``chunk`` x ``chunk``.  Blocks carry ids and
the few bytes a screen needs; pairs that pass it are taken once, and only their
classes' full sets are then sent, once for each block that needs them.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrose.llm.common import materialise

SHARD = 1 << 16           # rows of blocks that one task takes at a time, about


def with_components(met: DataFrame, comps: DataFrame) -> DataFrame:
    """``met`` with the component ``comp`` of each ``cid``, its own id where it has none."""
    return (met.join(comps.withColumnRenamed("node", "cid"), "cid", "left").withColumn("comp", F.coalesce("comp", "cid")))


def star_rows(met: DataFrame, comps: DataFrame | None, degree: DataFrame, columns: list[str], label: str) -> DataFrame:
    """(key, cid, comp, columns, cid2, comp2, columns2): each bucket's leader (columns with
    a 2) beside the bucket's classes of other components.

    The leader is the class that meets most others; once components are known, it
    is taken from outside the bucket's largest component.
    """
    at = met.join(degree, "cid")
    if comps is None:
        at = at.withColumn("comp", F.col("cid")).withColumn("minor", F.lit(True))
    else:
        at = with_components(at, comps)
        sizes = at.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("m"))
        major = (sizes.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.max(F.struct("m", "comp"))["comp"].alias("major"))
                 .filter("kinds > 1").drop("kinds"))
        at = at.join(major, "key").withColumn("minor", F.col("comp") != F.col("major")).drop("major")
    at = materialise(at.select("key", "cid", "comp", "degree", "minor", *columns), f"{label}-at")
    taken = ["cid", "comp", *columns]
    lead = (at.groupBy("key").agg(F.max(F.struct("minor", "degree", *taken)).alias("l"))
            .select("key", *[F.col(f"l.{c}").alias(f"{c}2") for c in taken]))
    return at.join(lead, "key").filter(F.col("comp") != F.col("comp2"))


def pair_columns() -> list:
    return [F.least("cid", "cid2").alias("a"), F.greatest("cid", "cid2").alias("b")]


def mixed_blocks(at: DataFrame, columns: list[str], chunk: int, label: str) -> DataFrame:
    """(key, cid, comp, major, columns, rest, block) of (key, cid, comp, columns): the rows
    of every block of the buckets that hold several components."""
    sizes = at.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("m"))
    mixed = (sizes.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.sum("m").alias("all"), F.max(F.struct("m", "comp")).alias("top"))
             .filter("kinds > 1").select("key", F.col("top.comp").alias("major"), (F.col("all") - F.col("top.m")).alias("others"), "all"))
    rows = at.join(materialise(mixed, f"{label}-mixed"), "key")
    chunks = lambda c: F.ceil(F.col(c) / chunk).cast("int")
    own = lambda n: F.pmod(F.xxhash64("cid"), n).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    columns = ["key", "cid", "comp", "major", *columns]
    first = (rows.filter("comp <> major").withColumn("i", own(chunks("others"))).withColumn("j", spread(chunks("all")))
             .select(*columns, "i", "j", F.lit(True).alias("rest")))
    second = (rows.withColumn("j", own(chunks("all"))).withColumn("i", spread(chunks("others")))
              .select(*columns, "i", "j", F.lit(False).alias("rest")))
    return materialise(first.unionByName(second).withColumn("block", F.xxhash64("key", "i", "j")).drop("i", "j"), f"{label}-blocks")


def screened_pairs(blocks: DataFrame, screen: Callable[[pa.Table], Callable[[int, np.ndarray], np.ndarray]],
                   shard: int = SHARD) -> DataFrame:
    """(a, b, block): pairs of different components that pass the screen, each once.

    ``screen(table)`` gives a function (row, other rows) -> the other rows that pass.
    """
    shards = max(1, -(-blocks.count() // shard))

    def compare(t: pa.Table) -> pa.Table:
        t = t.sort_by([("block", "ascending"), ("key", "ascending")]).combine_chunks()
        block, key, cid, comp, major = (t.column(c).to_numpy() for c in ("block", "key", "cid", "comp", "major"))
        rest = t.column("rest").to_numpy(zero_copy_only=False).astype(bool)
        passing = screen(t)
        new = np.append(True, (block[1:] != block[:-1]) | (key[1:] != key[:-1]))
        cuts = np.append(np.flatnonzero(new), len(key)).tolist()
        out = []
        for a, z in zip(cuts, cuts[1:]):
            left, right = np.flatnonzero(rest[a:z]) + a, np.flatnonzero(~rest[a:z]) + a
            for r in left.tolist():
                # a pair of two rest classes comes up twice; the smaller one looks at it
                o = passing(r, right[(comp[right] != comp[r]) & ((comp[right] == major[r]) | (cid[right] > cid[r]))])
                if len(o):
                    x = np.full(len(o), cid[r])
                    out.append(np.stack([np.minimum(x, cid[o]), np.maximum(x, cid[o]), block[o]]))
        found = np.concatenate(out, axis=1) if out else np.zeros((3, 0), np.int64)
        if found.shape[1]:
            _, once = np.unique(found[:2], axis=1, return_index=True)
            found = found[:, once]
        return pa.table({"a": pa.array(found[0]), "b": pa.array(found[1]), "block": pa.array(found[2])})

    passed = (blocks.withColumn("shard", F.pmod("block", F.lit(shards))).groupBy("shard")
              .applyInArrow(compare, "a long, b long, block long"))
    return passed.groupBy("a", "b").agg(F.min("block").alias("block"))


def linked_pairs(pairs: DataFrame, comps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among the pairs of a block, at least one for any two components that
    have any.  ``sets`` is (cid, n, items): the size of the full set, and those of its items
    that any other set holds."""
    wanted = pairs.select("block", F.explode(F.array("a", "b")).alias("cid")).distinct()
    sides = (with_components(wanted.join(sets, "cid"), comps)
             .select(F.col("block").alias("home"), "cid", "n", "items", "comp"))

    def verify(p: pa.Table, s: pa.Table) -> pa.Table:
        sets_of = {c: (n, m, np.sort(np.array(h, np.int64))) for c, n, m, h in
                   zip(*(s.column(c).to_pylist() for c in ("cid", "n", "comp", "items")))}
        joined = Joined()
        out = []
        for a, b in zip(p.column("a").to_pylist(), p.column("b").to_pylist()):
            (na, ca, ha), (nb, cb, hb) = sets_of[a], sets_of[b]
            if not joined.same(ca, cb):
                both = len(np.intersect1d(ha, hb, assume_unique=True))
                if 100 * both >= percent * (na + nb - both):
                    joined.join(ca, cb)
                    out.append((a, b))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    if pairs.isEmpty():
        return pairs.select("a", "b")
    return pairs.groupBy("block").cogroup(sides.groupBy("home")).applyInArrow(verify, "a long, b long")


class Joined:
    """Components that links of one task have joined."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (p := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(p, p)
            x = p
        return x

    def same(self, x: int, y: int) -> bool:
        return self.find(x) == self.find(y)

    def join(self, x: int, y: int) -> None:
        self.up[self.find(x)] = self.find(y)
