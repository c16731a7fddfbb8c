"""Exact dedup by counting quotient filters (operator 1).

Every partition folds the 64-bit fingerprints of its texts into counting
quotient filters, one per block of the fingerprint space; filters of a block
merge losslessly by their sorted remainders.  Fingerprints with a count above
one route their texts to byte verification: grouping by the text itself.

Defined cases: a null text counts as empty; empty texts are copies of one
another; rows without doc_id take part, and lose against any row with one; of
rows repeated with the same doc_id and text exactly one stays; a text of any
length is compared whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrose.llm.common import materialise, members, only_members, prepare, texts

BLOCK_FINGERPRINTS = 1 << 18   # fingerprints that one block should hold
MIN_BLOCK_BITS = 6


class CountingQuotientFilter:
    """Fingerprints of one block: a run of sorted remainders for each quotient.

    ``occupied`` has a bit for each quotient with a run, ``run_ends`` a bit for
    each slot that ends a run; slots hold the remainder and its count.  The
    ``low`` bits of a fingerprint below the block's number are split into
    quotient (high) and remainder.
    """

    def __init__(self, low: int, quotient_bits: int, occupied: np.ndarray, run_ends: np.ndarray,
                 remainders: np.ndarray, counts: np.ndarray):
        self.low, self.quotient_bits = low, quotient_bits
        self.occupied, self.run_ends = occupied, run_ends
        self.remainders, self.counts = remainders, counts

    @classmethod
    def of_sorted(cls, low: int, values: np.ndarray, counts: np.ndarray) -> CountingQuotientFilter:
        """From the sorted distinct low parts of fingerprints and their counts."""
        qbits = min(low, max(0, int(len(values)).bit_length()))
        shift = np.uint64(low - qbits)
        quotients = (values >> shift).astype(np.int64)
        occupied = np.zeros(1 << qbits, bool)
        occupied[quotients] = True
        run_ends = np.ones(len(values), bool)
        run_ends[:-1] = quotients[1:] != quotients[:-1]
        mask = np.uint64((1 << int(shift)) - 1)
        return cls(low, qbits, occupied, run_ends, values & mask, counts)

    def sorted_entries(self) -> tuple[np.ndarray, np.ndarray]:
        """Low parts in order, rebuilt from quotients and remainders, and their counts."""
        run = np.concatenate([[0], np.cumsum(self.run_ends)[:-1]]).astype(np.int64)
        quotients = np.flatnonzero(self.occupied)[run].astype(np.uint64)
        return (quotients << np.uint64(self.low - self.quotient_bits)) | self.remainders, self.counts

    def encode(self) -> bytes:
        head = np.array([self.low, self.quotient_bits, len(self.remainders)], "<i8").tobytes()
        return b"".join([head, np.packbits(self.occupied).tobytes(), np.packbits(self.run_ends).tobytes(),
                         self.remainders.astype("<u8").tobytes(), self.counts.astype("<i8").tobytes()])

    @classmethod
    def decode(cls, data: bytes) -> CountingQuotientFilter:
        low, qbits, n = (int(x) for x in np.frombuffer(data, "<i8", 3))
        at = 24
        size = ((1 << qbits) + 7) // 8
        occupied = np.unpackbits(np.frombuffer(data, np.uint8, size, at))[:1 << qbits].astype(bool)
        at += size
        size = (n + 7) // 8
        run_ends = np.unpackbits(np.frombuffer(data, np.uint8, size, at))[:n].astype(bool)
        at += size
        return cls(low, qbits, occupied, run_ends, np.frombuffer(data, "<u8", n, at),
                   np.frombuffer(data, "<i8", n, at + 8 * n))

    @classmethod
    def merge(cls, filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        """Lossless: the sorted runs are merged and counts of equal remainders added."""
        parts = [f.sorted_entries() for f in filters]
        values = np.concatenate([v for v, _ in parts])
        counts = np.concatenate([c for _, c in parts])
        order = np.argsort(values, kind="stable")   # merges the runs that are in order already
        values, counts = values[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        return cls.of_sorted(filters[0].low, values[first], np.add.reduceat(counts, first))


def partition_filters(prints: DataFrame, column: str, block_bits: int) -> DataFrame:
    """(block, filter): the filters of each partition, one row per block it touches."""
    low = 64 - block_bits

    def build(batches):
        parts = [np.asarray(b.column(0).to_numpy(zero_copy_only=False), np.int64).view(np.uint64)
                 for b in batches if b.num_rows]
        if not parts:
            return
        values, counts = np.unique(np.concatenate(parts), return_counts=True)
        blocks = (values >> np.uint64(low)).astype(np.int64)
        cuts = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1]]))
        mask = np.uint64((1 << low) - 1)
        ends = np.append(cuts[1:], len(values))
        data = [CountingQuotientFilter.of_sorted(low, values[a:z] & mask, counts[a:z]).encode()
                for a, z in zip(cuts, ends)]
        yield pa.RecordBatch.from_arrays([pa.array(blocks[cuts]), pa.array(data, pa.binary())], ["block", "filter"])

    return prints.select(column).mapInArrow(build, "block long, filter binary")


def merged_filters(parts: DataFrame) -> DataFrame:
    """(block, filter): one filter per block for the whole table."""
    def merge(t: pa.Table) -> pa.Table:
        got = [CountingQuotientFilter.decode(x) for x in t.column("filter").to_pylist()]
        return pa.table({"block": t.column("block").slice(0, 1).combine_chunks(),
                         "filter": pa.array([CountingQuotientFilter.merge(got).encode()], pa.binary())})

    return parts.groupBy("block").applyInArrow(merge, "block long, filter binary")


def repeated(filters: DataFrame) -> DataFrame:
    """(fp, n): fingerprints with a count above one."""
    def read(batches):
        for b in batches:
            for block, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                f = CountingQuotientFilter.decode(data)
                values, counts = f.sorted_entries()
                many = counts > 1
                fp = values[many] | np.uint64(block << f.low)
                yield pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.array(counts[many])], ["fp", "n"])

    return filters.select("block", "filter").mapInArrow(read, "fp long, n long")


def repeated_fingerprints(prints: DataFrame, column: str = "fp") -> DataFrame:
    """Fingerprints that occur more than once in the table, by merged filters."""
    n = prints.count()
    bits = max(MIN_BLOCK_BITS, int(np.ceil(np.log2(max(1, n / BLOCK_FINGERPRINTS)))))
    return repeated(merged_filters(partition_filters(prints, column, bits)))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row.

    Texts are compared byte for byte; the row with the largest doc_id stays.
    Only texts whose fingerprint is repeated move, after a map-side grouping;
    everything else works on the narrow table of fingerprints.
    """
    prepare(docs.sparkSession)
    base = texts(docs, id_col, text_col)
    narrow = materialise(base.select("doc_id", F.xxhash64("text").alias("fp"), F.sha2("text", 256).alias("sha"),
                                     F.monotonically_increasing_id().alias("uid")), "dedup-prints")
    many = materialise(repeated_fingerprints(narrow).select("fp"), "dedup-repeated")
    found = members(many, "fp")
    suspects = only_members(base.select(F.xxhash64("text").alias("fp"), "text"), "fp", found)
    verified = (suspects.groupBy("text").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                .select(F.xxhash64("text").alias("fp"), F.sha2("text", 256).alias("sha"), "n"))
    # both sides are combined map-side, so a hot text is one row per map task
    claims = (only_members(narrow, "fp", found).groupBy("fp", "sha")
              .agg(F.max(F.struct("doc_id", "uid")).alias("stay")))
    groups = materialise(claims.join(verified, ["fp", "sha"]).select(
        "fp", "sha", F.col("stay.doc_id").alias("stay_id"), F.col("stay.uid").alias("stay_uid"), "n"), "dedup-groups")
    lone = F.col("n").isNull()
    # plain join of two scans: the adaptive skew join splits the rows of a hot text
    return (narrow.join(groups, ["fp", "sha"], "left")
            .select("doc_id", F.when(lone, F.col("doc_id")).otherwise(F.col("stay_id")).alias("keep_id"),
                    F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
                    F.coalesce(F.col("uid") == F.col("stay_uid"), F.lit(True)).alias("kept"),
                    F.col("sha").alias("text_sha256")))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) without exact copies: of equal texts
    the one with the largest doc_id stays, null as empty, repeated rows once.

    Rows with a fingerprint that the merged filters count once pass untouched;
    the others are grouped by their text, combined map-side.
    """
    prepare(docs.sparkSession)
    keyed = docs.select(F.struct(*docs.columns).alias("row"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("fp"))
    prints = materialise(keyed.select("fp"), "dedup-prints")
    found = members(repeated_fingerprints(prints), "fp")
    lone = only_members(keyed.select("fp", "row"), "fp", found, want=False).select("row.*")
    rank = F.struct(F.col("row")[id_col].isNotNull(), F.col("row")[id_col])
    kept = (only_members(keyed, "fp", found).groupBy("text").agg(F.max_by("row", rank).alias("row")).select("row.*"))
    return lone.unionByName(kept)
