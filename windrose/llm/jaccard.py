"""N-gram Jaccard join by rare-first prefix filtering (operator 11).

Documents are sets of word n-grams.  All n-grams have one order, the rarest
first (document frequency, then hash).  Two sets of similarity t meet in their
first n - ceil(t n) + 1 n-grams, so only those prefixes are joined, and an
n-gram that stands in one document joins nothing: a document whose prefix is
made of such n-grams is done.  Pairs that meet pass a length filter, a
positional filter (what is left after the shared place must suffice) and a
suffix filter (the rest is partitioned by hash; the sum of the smaller parts
must suffice) and are then verified once, on all n-grams that stand in several
documents, which hold every common one.

Frequencies are counted over all documents in cells of the hash space: a batch
of documents sends each n-gram of a cell once, as a sorted array, so a frequent
n-gram costs a few bytes a batch.  Their lookup streams through sorted
partitions, with the frequencies of one cell in memory.

Documents with the same word sequence form a class.  In every n-gram's list of
classes, rounds of stars link a well-connected class with the others; what then
lies in different components is compared in blocks of bounded size.  No pair of
classes in different components is left out by a cap.

Defined cases: a null or empty text, or one without words, has no n-grams and
links with nothing; a text of fewer words has one n-gram, the whole sequence; a
text of any length is one set; rows repeated with the same doc_id count as one
document; rows without doc_id take part, and a component of only such rows has
no id; an empty table gives an empty result; other columns are ignored.  N-grams
are compared by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrose.llm.blocks import SHARD, linked_pairs, mixed_blocks, pair_columns, screened_pairs, star_rows, with_components
from windrose.llm.common import Members, materialise, members, prepare, slices, texts
from windrose.llm.graph import components
from windrose.llm.minhash import shingles, words_of

SIZE = 4
PERCENT = 85              # a link has 100 * intersection >= PERCENT * union
CELL = 1 << 22            # n-grams counted in one cell, about
STARS = 3                 # rounds of stars before blocks
CHUNK = 512               # classes in one side of a block
PARTS = 32                # of the suffix filter
_MIX = np.uint64(0xD6E8FEB86659FD93)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def _cell(h: np.ndarray, cells: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(cells)) >> np.uint64(32)


def _low(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _name(cell: np.ndarray | int, low: np.ndarray) -> np.ndarray:
    """Well-mixed 64-bit name of a counted n-gram, for the bit table."""
    x = ((np.asarray(cell, np.uint64) << np.uint64(32)) | low.astype(np.uint64)) * _MIX
    return (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)


def _packs(batches, size: int):
    """(rows' column 0, index of each row's entry, digests, sets): the distinct word
    sequences of some rows; rows without words have entry -1."""
    for b in batches:
        values = b.column(1).to_pylist()
        for a, z in slices(values):
            entry: dict[bytes, int] = {}
            at, sets = [], []
            for t in values[a:z]:
                words = words_of(t)
                digest = xxhash.xxh3_128_digest(b" ".join(words)) if words else None
                if words and digest not in entry:
                    entry[digest] = len(sets)
                    sets.append(shingles(words, size))
                at.append(entry[digest] if words else -1)
            yield b.column(0).slice(a, z - a), at, list(entry), sets


def _by_cell(cell: np.ndarray):
    """Index ranges of equal values in a sorted array."""
    cuts = np.flatnonzero(np.diff(cell)) + 1
    return zip([0, *cuts.tolist()], [*cuts.tolist(), len(cell)]) if len(cell) else ()


def _frequencies(base: DataFrame, cells: int, size: int) -> DataFrame:
    """(cell, keys, counts): the n-grams of each cell that stand in several documents."""
    def sent(batches):
        for _, _, _, sets in _packs(batches, size):
            h = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            h, n = np.unique(h, return_counts=True)      # cells are ranges of the hash
            cell = _cell(h, cells)
            rows = [(int(cell[a]), _low(h[a:z]).tobytes(), n[a:z].astype(np.uint32).tobytes() if n[a:z].max() > 1 else None)
                    for a, z in _by_cell(cell)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()),
                                              pa.array([r[2] for r in rows], pa.binary())], ["cell", "keys", "counts"])

    def counted(t: pa.Table) -> pa.Table:
        keys = [np.frombuffer(k, np.uint32) for k in t.column("keys").to_pylist()]
        n = [np.ones(len(k), np.uint32) if c is None else np.frombuffer(c, np.uint32)
             for k, c in zip(keys, t.column("counts").to_pylist())]
        key, weight = np.concatenate(keys), np.concatenate(n)
        order = np.argsort(key, kind="stable")
        key, weight = key[order], weight[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        total = np.add.reduceat(weight.astype(np.uint64), first)
        keep = total > 1
        key, total = key[first][keep], np.minimum(total[keep], 0xFFFFFFFF).astype(np.uint32)
        return pa.table({"cell": t.column("cell").slice(0, 1), "keys": pa.array([key.tobytes()], pa.binary()),
                         "counts": pa.array([total.tobytes()], pa.binary())})

    kind = "cell long, keys binary, counts binary"
    return base.mapInArrow(sent, kind).groupBy("cell").applyInArrow(counted, kind)


def _names(frequent: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            for cell, keys in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                low = np.frombuffer(keys, np.uint32)
                for i in range(0, len(low), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(_name(cell, low[i:i + (1 << 16)]).view(np.int64))], ["name"])

    return frequent.select("cell", "keys").mapInArrow(run, "name long")


def _ranked(base: DataFrame, frequent: DataFrame, cells: int, size: int, percent: int) -> DataFrame:
    """(doc_id, digest, n, shared) for every row: size of the set and its n-grams that stand
    in several documents, rarest first; none if the prefix holds only others."""
    known: Members = members(_names(frequent), "name")
    id_type = base.schema["doc_id"].dataType.simpleString()
    columns = ["cell", "what", "pack", "ids", "at", "digests", "sizes", "pos", "hashes"]
    kinds = ["long", "int", "long", f"array<{id_type}>", "array<int>", "array<binary>", "array<long>", "binary", "binary"]
    ddl = ", ".join(f"{c} {k}" for c, k in zip(columns, kinds))

    def sent(batches):
        task, number = TaskContext.get().partitionId(), 0
        for ids, at, digests, sets in _packs(batches, size):
            pack = (task << 32) | number
            number += 1
            lengths = np.array([len(s) for s in sets], np.int64)
            h = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            pos = np.repeat(np.arange(len(sets)), lengths).astype(np.uint16)
            cell = _cell(h, cells)
            maybe = known.test(_name(cell, _low(h)).view(np.int64))
            h, pos, cell = h[maybe], pos[maybe], cell[maybe]
            order = np.argsort(h, kind="stable")
            h, pos, cell = h[order], pos[order], cell[order]
            parts = [(int(cell[a]), pos[a:z].tobytes(), h[a:z].tobytes()) for a, z in _by_cell(cell)]
            k = len(parts)
            head = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            yield pa.RecordBatch.from_arrays([
                # headers need no lookup: they pass through the partition of a cell of their own
                pa.array([-1 - pack % cells] + [p[0] for p in parts], pa.int64()), pa.array([1] * (k + 1), pa.int32()),
                pa.array([pack] * (k + 1), pa.int64()), pa.concat_arrays([head, pa.nulls(k, head.type)]),
                pa.array([at] + [None] * k, pa.list_(pa.int32())), pa.array([digests] + [None] * k, pa.list_(pa.binary())),
                pa.array([lengths.tolist()] + [None] * k, pa.list_(pa.int64())),
                pa.array([None] + [p[1] for p in parts], pa.binary()), pa.array([None] + [p[2] for p in parts], pa.binary())], columns)

    def looked_up(batches):
        current = keys = counts = None
        for b in batches:
            keep, pos, hashes, found = [], [], [], []
            col = {c: b.column(i) for i, c in enumerate(b.schema.names)}
            for i, (cell, what) in enumerate(zip(col["cell"].to_pylist(), col["what"].to_pylist())):
                if what == 0:
                    current = cell
                    keys, counts = (np.frombuffer(col[c][i].as_py(), np.uint32) for c in ("keys", "counts"))
                elif cell < 0:
                    keep.append(i)
                    pos.append(None)
                    hashes.append(None)
                    found.append(None)
                elif cell == current and len(keys):
                    h = np.frombuffer(col["hashes"][i].as_py(), np.uint64)
                    where = np.minimum(np.searchsorted(keys, _low(h)), len(keys) - 1)
                    hit = keys[where] == _low(h)
                    if hit.any():
                        keep.append(i)
                        pos.append(np.frombuffer(col["pos"][i].as_py(), np.uint16)[hit].tobytes())
                        hashes.append(h[hit].tobytes())
                        found.append(counts[where[hit]].tobytes())
            rows = b.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*(rows.column(i) for i in (2, 3, 4, 5, 6)), pa.array(pos, pa.binary()),
                                              pa.array(hashes, pa.binary()), pa.array(found, pa.binary())],
                                             ["pack", "ids", "at", "digests", "sizes", "pos", "hashes", "found"])

    def ordered(t: pa.Table) -> pa.Table:
        """Documents of one pack, with their shared n-grams in the common order."""
        header = t.column("at").is_valid()
        head = t.filter(header)
        if not head.num_rows:
            raise RuntimeError("a pack of documents lost its header")
        at, sizes = (head.column(c)[0].as_py() for c in ("at", "sizes"))
        parts = t.filter(pa.compute.invert(header))
        pos, h, n = (np.frombuffer(b"".join(parts.column(c).to_pylist()), k)
                     for c, k in (("pos", np.uint16), ("hashes", np.uint64), ("found", np.uint32)))
        order = np.lexsort((h, n, pos))
        pos, h = pos[order], h[order].view(np.int64)
        cuts = np.searchsorted(pos, np.arange(len(sizes) + 1))
        shared: list = []
        for e, n_all in enumerate(sizes):
            own = h[cuts[e]:cuts[e + 1]]
            shared.append(own if n_all - len(own) < prefix_length(n_all, percent) else own[:0])
        digests = head.column("digests")[0].as_py()
        ids = head.column("ids").combine_chunks()
        seen: set[int] = set()
        lists = []
        for e in at:       # the copies of a pack bring their n-grams once
            lists.append(shared[e] if e >= 0 and e not in seen else None)
            seen.add(e)
        return pa.table([pa.ListArray.flatten(ids if isinstance(ids, pa.ListArray) else ids.chunk(0)),
                         pa.array([digests[e] if e >= 0 else None for e in at], pa.binary()),
                         pa.array([sizes[e] if e >= 0 else 0 for e in at], pa.int64()),
                         pa.array(lists, pa.list_(pa.int64()))], names=["doc_id", "digest", "n", "shared"])

    nothing = [F.lit(None).cast(k).alias(c) for c, k in zip(columns[2:], kinds[2:])]
    rows = (base.mapInArrow(sent, ddl).withColumns({"keys": F.lit(None).cast("binary"), "counts": F.lit(None).cast("binary")})
            .unionByName(frequent.select("cell", F.lit(0).alias("what"), *nothing, "keys", "counts")))
    found = (rows.repartition("cell").sortWithinPartitions("cell", "what")
             .mapInArrow(looked_up, ", ".join(f"{c} {k}" for c, k in zip(columns[2:], kinds[2:])) + ", found binary"))
    return found.groupBy("pack").applyInArrow(ordered, f"doc_id {id_type}, digest binary, n long, shared array<long>")


# ------------------------------------------------------------ links

def _need(percent: int):
    """Least intersection of a link, from the two sizes."""
    return lambda a, b: -(-percent * (a + b) // (100 + percent))


def _lists(classes: DataFrame, percent: int) -> DataFrame:
    """(key, cid, n, place, tail): a class in the list of each n-gram of its prefix that stands
    in several documents; tail counts its n-grams from there on, by parts of the hash space."""
    def run(batches):
        for b in batches:
            for cid, n, shared in zip(*(b.column(i).to_pylist() for i in range(3))):
                h = np.array(shared, np.int64)
                first = n - len(h)                       # n-grams of this document alone come first
                k = prefix_length(n, percent) - first
                part = (h.view(np.uint64) >> np.uint64(59)).astype(np.int64)
                tail = np.bincount(part, minlength=PARTS)
                tails = tail - np.cumsum(np.eye(PARTS, dtype=np.int64)[part[:k]], axis=0) + np.eye(PARTS, dtype=np.int64)[part[:k]]
                small = np.minimum(tails, 0xFFFF).astype(np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[:k]), pa.array(np.full(len(h[:k]), cid)), pa.array(np.full(len(h[:k]), n)),
                     pa.array(first + np.arange(len(h[:k]))), pa.array([t.tobytes() for t in small], pa.binary())],
                    ["key", "cid", "n", "place", "tail"])

    return (classes.filter(F.size("shared") > 0).select("cid", "n", "shared")
            .mapInArrow(run, "key long, cid long, n long, place long, tail binary"))


def _star_pairs(met: DataFrame, comps: DataFrame | None, degree: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of each list's leader and its classes of other components that pass the
    length and the positional filter."""
    rows = star_rows(met, comps, degree, ["n", "place"], "jaccard")
    need = F.ceil(F.lit(percent) * (F.col("n") + F.col("n2")) / (100 + percent))
    left = F.least(F.col("n") - F.col("place"), F.col("n2") - F.col("place2"))
    return rows.filter(100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")).filter(left >= need).select(*pair_columns()).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are links, by all their shared n-grams."""
    left = sets.select(F.col("cid").alias("a"), F.col("shared").alias("sa"), F.col("n").alias("na"))
    right = sets.select(F.col("cid").alias("b"), F.col("shared").alias("sb"), F.col("n").alias("nb"))
    both = pairs.join(left, "a").join(right, "b").withColumn("both", F.size(F.array_intersect("sa", "sb")))
    return both.filter(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")


def _open_pairs(met: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """(a, b, block): pairs of different components that share a list and pass the filters."""
    at = materialise(with_components(met, comps), "jaccard-open")
    blocks = mixed_blocks(at, ["n", "place", "tail"], CHUNK, "jaccard")
    need = _need(percent)

    def filters(t: pa.Table):
        n, place = t.column("n").to_numpy(), t.column("place").to_numpy()
        tail = np.frombuffer(b"".join(t.column("tail").to_pylist()), np.uint16).reshape(len(n), PARTS).astype(np.int64)
        tail[tail == 0xFFFF] = 1 << 40       # a full counter bounds nothing

        def passing(r: int, o: np.ndarray) -> np.ndarray:
            o = o[100 * np.minimum(n[o], n[r]) >= percent * np.maximum(n[o], n[r])]
            wanted = need(n[o], n[r])
            enough = np.minimum(n[o] - place[o], n[r] - place[r]) >= wanted
            o, wanted = o[enough], wanted[enough]
            return o[np.minimum(tail[o], tail[r]).sum(axis=1) >= wanted]

        return passing

    return screened_pairs(blocks, filters, SHARD)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
                       percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row: the size of its set and the smallest
    doc_id that links lead to."""
    prepare(docs.sparkSession)
    base = texts(docs, id_col, text_col)
    letters = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cells = 1 + letters // 6 // CELL
    frequent = materialise(_frequencies(base, cells, size), "jaccard-frequent")
    ranked = materialise(_ranked(base, frequent, cells, size, percent), "jaccard-ranked")
    # one class for each word sequence, named by a number of its own
    classes = materialise(
        ranked.filter("digest IS NOT NULL").groupBy("digest")
        .agg(F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("shared", ignorenulls=True).alias("shared"))
        .withColumn("cid", F.monotonically_increasing_id()), "jaccard-classes")
    lists = materialise(_lists(classes, percent), "jaccard-lists")
    several = lists.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    met = materialise(lists.join(several, "key"), "jaccard-met")
    degree = materialise(met.groupBy("cid").agg(F.sum("m").alias("degree")), "jaccard-degree")
    met = met.drop("m")
    sets = materialise(classes.join(degree.select("cid"), "cid", "left_semi").select("cid", "n", "shared"), "jaccard-sets")

    links = found = None
    for _ in range(STARS):
        more = materialise(_verified(_star_pairs(met, found, degree, percent), sets, percent), "jaccard-links")
        if more.isEmpty():
            break
        links = more if links is None else links.unionByName(more)
        found = components(links)
    none = classes.limit(0).select(F.col("cid").alias("node"), F.col("cid").alias("comp"))
    found = none if found is None else found
    pairs = materialise(_open_pairs(met, found, percent), "jaccard-pairs")
    more = materialise(linked_pairs(pairs, found, sets.withColumnRenamed("shared", "items"), percent), "jaccard-links")
    if not more.isEmpty():
        found = components(more if links is None else links.unionByName(more))

    named = (classes.select("digest", "cid", "first_id").join(found.withColumnRenamed("node", "cid"), "cid", "left")
             .withColumn("comp", F.coalesce("comp", "cid")))
    ids = named.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    named = materialise(named.join(ids, "comp").select("digest", "component_id"), "jaccard-named")
    # plain join of two scans: the adaptive skew join splits the copies of a hot text
    return ranked.select("doc_id", "digest", "n").join(named, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
