"""Near dedup by min-max hashing (operator 2).

Under each permutation of the shingle hashes both the minimum and the maximum
are kept, so a signature of 2 P values takes P hash evaluations a shingle; a
band joins values of different permutations.  Texts that share a band are
compared on their full shingle sets.

Documents with the same word sequence form a class and only classes are
compared.  In every bucket each class is first compared with one leader, the
class that meets most others; components of those links are then completed by
comparing, within a bucket, classes that are still in different components.
Those comparisons run in blocks of bounded size: signature bytes first, then
the full sets of the pairs that agree often enough.  Only links come out, and
no pair between different components that share a bucket is left out by a cap.

Chance of missing a link of similarity 0.75: (1 - 0.75^4)^32 = 5e-6 that no
band meets, and about 1e-5 that agreement of the 128 signature values falls
below SCREEN.

Defined cases: a null text counts as empty; a text without words has no
shingles and is linked with nothing; a text of any length is one set; rows repeated with the same doc_id count
as one document (all of them are kept or not); rows without doc_id take part,
and a component of only such rows has no id; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from windrose.llm.common import ASCII_LOWER, Members, materialise, members, only_members, prepare, slices, texts
from windrose.llm.graph import components

SHINGLE = 5
PERCENT = 75             # a link has 100 * intersection >= PERCENT * union
PERMUTATIONS = 64
ROWS = 4                 # values in a band
SCREEN = 75              # of the 128 signature bytes that must agree before full sets are compared
CHUNK = 512              # classes in one side of a block
SHARD_BYTES = 8 << 20   # of blocks that one task takes at a time, about

_rng = np.random.default_rng(20240229)
_FACTOR = _rng.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MASK = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
_STEP = [np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) | 1) for k in range(8)]
BANDS = 2 * PERMUTATIONS // ROWS


def words_of(text: str) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ of the text with A-Z in lower case, in UTF-8."""
    return text.encode().translate(ASCII_LOWER).split()


def shingles(words: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; the whole sequence when shorter."""
    if not words:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    n = len(words) - size + 1
    h = np.full(n, size, np.uint64)
    for k in range(size):
        h = (h ^ (h >> np.uint64(29))) * _STEP[0] + codes[k:k + n] * _STEP[k % 8]
    return np.unique(h ^ (h >> np.uint64(32)))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minimum and maximum of each non-empty set under each permutation:
    len(sets) x 2 x PERMUTATIONS."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), 2, PERMUTATIONS), np.uint64)
    for k in range(PERMUTATIONS):
        image = (flat ^ _MASK[k]) * _FACTOR[k]
        out[:, 0, k] = np.minimum.reduceat(image, starts)
        out[:, 1, k] = np.maximum.reduceat(image, starts)
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """One hash for each band: ROWS values of different permutations and the band's number."""
    rows = values.reshape(len(values), BANDS, ROWS)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP[5], rows.shape[:2]).copy()
    for k in range(ROWS):
        h = (h ^ (h >> np.uint64(31))) * _STEP[1] + rows[:, :, k] * _STEP[2]
    return (h ^ (h >> np.uint64(32))) * _STEP[3]


def _signed(base: DataFrame) -> DataFrame:
    """(doc_id, digest, n_shingles, bands, sig): the digest names the word sequence."""
    kind = base.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            values = b.column(1).to_pylist()
            for a, z in slices(values, 1 << 20):
                words = [words_of(t) for t in values[a:z]]
                sets = [shingles(w) for w in words]
                full = [i for i, s in enumerate(sets) if len(s)]
                bands: list = [None] * (z - a)
                sig: list = [None] * (z - a)
                if full:
                    v = signatures([sets[i] for i in full])
                    keys = band_keys(v).view(np.int64)
                    small = ((v.reshape(len(full), -1) * _STEP[4]) >> np.uint64(56)).astype(np.uint8)
                    for row, i in enumerate(full):
                        bands[i], sig[i] = keys[row], small[row].tobytes()
                digest = [xxhash.xxh3_128_digest(b" ".join(w)) if w else None for w in words]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(a, z - a), pa.array(digest, pa.binary()),
                     pa.array([len(s) for s in sets], pa.int64()), pa.array(bands, pa.list_(pa.int64())),
                     pa.array(sig, pa.binary())], ["doc_id", "digest", "n_shingles", "bands", "sig"])

    return base.mapInArrow(run, f"doc_id {kind}, digest binary, n_shingles long, bands array<long>, sig binary")


def _full_sets(base: DataFrame, wanted: Members, classes: DataFrame) -> DataFrame:
    """(cid, shingles) of the classes whose representative may be wanted."""
    def run(batches):
        for b in batches:
            hit = wanted.test(np.asarray(b.column(0).to_numpy(zero_copy_only=False), np.int64))
            column = b.column(1).filter(pa.array(hit))
            digest, sets = [], []
            for t in column.to_pylist():
                w = words_of(t)
                if w:
                    digest.append(xxhash.xxh3_128_digest(b" ".join(w)))
                    sets.append(shingles(w).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(digest, pa.binary()), pa.array(sets, pa.list_(pa.int64()))],
                                             ["digest", "shingles"])

    rows = base.select(F.xxhash64("doc_id").alias("h"), "text").mapInArrow(run, "digest binary, shingles array<long>")
    # rows with the representative's doc_id but another text join no wanted class
    return rows.join(classes, "digest").dropDuplicates(["cid"]).select("cid", "shingles")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are similar enough."""
    left = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b").withColumn("n", F.size(F.array_intersect("sa", "sb")))
    return both.filter(100 * F.col("n") >= percent * (F.size("sa") + F.size("sb") - F.col("n"))).select("a", "b")


def _open_links(met: DataFrame, comps: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between classes of different components that share a bucket;
    at least one for any two components that have any.

    In a bucket, the classes outside its largest component (the rest) meet all
    classes of the bucket, in blocks of CHUNK x CHUNK that hold the full sets.  A
    pair is looked at in the first bucket it shares, and only while its
    components are not yet joined by a link of the same task.
    """
    at = (met.filter("n > 2").join(comps.withColumnRenamed("node", "cid"), "cid", "left")
          .select("key", "cid", F.coalesce("comp", "cid").alias("comp")))
    at = materialise(at, "near-open")
    sizes = at.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("m"))
    mixed = materialise(sizes.groupBy("key").agg(
        F.count(F.lit(1)).alias("kinds"), F.sum("m").alias("all"), F.max(F.struct("m", "comp")).alias("top"))
        .filter("kinds > 1").select("key", F.col("top.comp").alias("major"), (F.col("all") - F.col("top.m")).alias("rest"),
                                    "all"), "near-mixed")
    rows = at.join(mixed, "key")
    chunks = lambda c: F.ceil(F.col(c) / CHUNK).cast("int")
    own = lambda n: F.pmod(F.xxhash64("cid"), n).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    columns = ["key", "cid", "comp", "major"]
    first = (rows.filter("comp <> major").withColumn("i", own(chunks("rest"))).withColumn("j", spread(chunks("all")))
             .select(*columns, "i", "j", F.lit(True).alias("rest")))
    second = (rows.withColumn("j", own(chunks("all"))).withColumn("i", spread(chunks("rest")))
              .select(*columns, "i", "j", F.lit(False).alias("rest")))
    blocks = (first.unionByName(second).join(classes.select("cid", "bands", "sig"), "cid").join(sets, "cid"))
    blocks = materialise(blocks, "near-blocks")
    shards = max(1, (blocks.agg(F.sum(8 * F.size("shingles") + 400)).first()[0] or 0) // SHARD_BYTES)

    def compare(t: pa.Table) -> pa.Table:
        t = t.sort_by([("key", "ascending"), ("i", "ascending"), ("j", "ascending")]).combine_chunks()
        key, i, j, cid, comp, major = (t.column(c).to_numpy() for c in ("key", "i", "j", "cid", "comp", "major"))
        rest = t.column("rest").to_numpy(zero_copy_only=False).astype(bool)
        sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint8).reshape(len(key), -1)
        bands = _flat(t, "bands")[0].reshape(len(key), -1)
        values, ends = _flat(t, "shingles")
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        cuts = np.append(np.flatnonzero(new), len(key)).tolist()
        joined = _Joined()
        out: list[tuple[int, int]] = []
        for a, z in zip(cuts, cuts[1:]):
            left, right = np.flatnonzero(rest[a:z]) + a, np.flatnonzero(~rest[a:z]) + a
            for r in left.tolist():
                # a pair of two rest classes comes up twice; the smaller one looks at it
                other = right[(comp[right] != comp[r]) & ((comp[right] == major[r]) | (cid[right] > cid[r]))]
                agree = (sig[other] == sig[r]).sum(axis=1)
                other = other[agree >= SCREEN]
                same = bands[other] == bands[r]
                first = bands[r][same.argmax(axis=1)] == key[r]
                other, agree = other[first], agree[agree >= SCREEN][first]
                mine = values[ends[r]:ends[r + 1]]
                for o in other[np.argsort(-agree, kind="stable")].tolist():
                    if not joined.same(int(comp[r]), int(comp[o])):
                        theirs = values[ends[o]:ends[o + 1]]
                        n = len(np.intersect1d(mine, theirs, assume_unique=True))
                        if 100 * n >= percent * (len(mine) + len(theirs) - n):
                            joined.join(int(comp[r]), int(comp[o]))
                            out.append((int(cid[r]), int(cid[o])))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return (blocks.withColumn("shard", F.pmod(F.xxhash64("key", "i", "j"), F.lit(shards)))
            .groupBy("shard").applyInArrow(compare, "a long, b long"))


def _flat(t: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and where each row's begin."""
    c = t.column(column)
    c = c.chunk(0) if c.num_chunks else pa.array([], c.type)
    return c.values.to_numpy()[c.offsets[0].as_py() if len(c.offsets) else 0:], c.offsets.to_numpy() - c.offsets[0].as_py()


class _Joined:
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


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row."""
    return _judged(docs, id_col, text_col, percent).drop("digest")


def _judged(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """(doc_id, digest, n_shingles, component_id, kept) for every row."""
    prepare(docs.sparkSession)
    base = texts(docs, id_col, text_col)
    signed = materialise(_signed(base), "near-signed")
    # one class for each word sequence, named by a number of its own
    classes = materialise(
        signed.filter("digest IS NOT NULL").groupBy("digest")
        .agg(F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
        .withColumn("cid", F.monotonically_increasing_id()), "near-classes")

    entries = classes.select("cid", F.explode("bands").alias("key"))
    shared = materialise(entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "near-shared")
    met = materialise(only_members(entries, "key", members(shared, "key")).join(shared, "key"), "near-met")

    # leaders: the class of a bucket that meets most others over all its buckets
    degree = met.groupBy("cid").agg(F.sum("n").alias("degree"))
    leader = materialise(met.join(degree, "cid").groupBy("key")
                         .agg(F.max(F.struct("degree", "cid"))["cid"].alias("leader")), "near-leaders")
    stars = (met.join(leader, "key").filter("cid <> leader")
             .select(F.least("cid", "leader").alias("a"), F.greatest("cid", "leader").alias("b")).distinct())

    wanted = materialise(degree.select("cid").join(classes, "cid").select("cid", "digest", F.xxhash64("first_id").alias("h")),
                         "near-wanted")
    sets = materialise(_full_sets(base, members(wanted, "h"), wanted.select("cid", "digest")), "near-sets")
    links = materialise(_linked(stars, sets, percent), "near-links")
    found = components(links)
    more = materialise(_open_links(met, found, classes, sets, percent), "near-links")
    if not more.isEmpty():
        found = components(links.unionByName(more))

    named = (classes.select("digest", "cid", "first_id").join(found.withColumnRenamed("node", "cid"), "cid", "left")
             .withColumn("comp", F.coalesce("comp", "cid")))
    named = materialise(named, "near-comps")
    ids = materialise(named.groupBy("comp").agg(F.min("first_id").alias("component_id")), "near-ids")
    named = materialise(named.join(ids, "comp").select("digest", "component_id"), "near-named")
    # plain join of two scans: the adaptive skew join splits the copies of a hot text
    return (signed.select("doc_id", "digest", "n_shingles").join(named, "digest", "left")
            .select("doc_id", "digest", "n_shingles",
                    F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns, whose document stays for its component.

    Rows are judged by doc_id and word sequence, so rows that only share a null
    or repeated doc_id stay or go with their own component.  The digests of
    dropped rows go into a bounded bit table; rows it surely does not hold pass
    untouched, the others are joined with the dropped (doc_id, digest).
    """
    # a row without words has no digest and is always kept
    gone = materialise(_judged(docs, id_col, text_col, percent).filter("NOT kept")
                       .select(F.col("doc_id").alias("_gone"), F.col("digest").alias("_digest")).distinct(), "near-dropped")
    head = F.conv(F.hex(F.substring("_digest", 1, 8)), 16, -10).cast("long")
    found = members(gone.select(head.alias("_h")), "_h")
    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("_text"), F.struct(*docs.columns).alias("_row"))
    sure = _digested(rows, found, want=False)
    checked = _digested(rows, found).join(
        gone, (F.col("_key") == F.col("_digest")) & F.col(f"_row.`{id_col}`").eqNullSafe(F.col("_gone")), "left_anti")
    return sure.unionByName(checked).select("_row.*")


def _digested(rows: DataFrame, found: Members, want: bool = True) -> DataFrame:
    """(_key, _row) of (_text, _row): the digest of the text's word sequence, null without
    words; those rows whose digest may be (or surely is not) in a table of first 8 bytes.

    One pass does both: a task with two Python stages keeps two workers, and both stay."""
    def run(batches):
        for b in batches:
            words = map(words_of, b.column(0).to_pylist())
            digest = [xxhash.xxh3_128_digest(b" ".join(w)) if w else None for w in words]
            head = np.frombuffer(b"".join((d or bytes(8))[:8] for d in digest), ">i8").astype(np.int64)
            maybe = found.test(head) & np.array([d is not None for d in digest], bool)
            yield pa.RecordBatch.from_arrays([pa.array(digest, pa.binary()), b.column(1)], ["_key", "_row"]).filter(
                pa.array(maybe if want else ~maybe, pa.bool_()))

    return rows.mapInArrow(run, StructType([StructField("_key", BinaryType()), rows.schema["_row"]]))
