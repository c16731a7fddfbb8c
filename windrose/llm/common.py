"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrose.session import kept_table, prepare_session

ASCII_LOWER = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))
# ASCII letters lower-cased, every byte outside [0-9a-z\x80-\xff] a space: splitting
# the result gives the words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of the lower-cased text
# (UTF-8 continuation and lead bytes are all above \x7f, so bytes and code points agree)
WORD_BYTES = bytes((c + 32 if 0x41 <= c <= 0x5A else c) if (0x30 <= c <= 0x39 or 0x41 <= c <= 0x5A
                                                          or 0x61 <= c <= 0x7A or c >= 0x80) else 0x20
                   for c in range(256))
TEXT_BATCH = 4 << 20   # bytes of text that one numpy step takes on at a time


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the Python stages: bounded Arrow batches, package on the executors."""
    prepare_session(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns the operators work on; a null text counts as empty.  Every
    other column, whatever its name, is left out before any column is added."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared checkpoint folder and read it back (cuts lineage);
    ``windrose.session.drop_kept_tables`` deletes what a session has written."""
    return kept_table(df, label)


def slices(values: list, limit: int = TEXT_BATCH) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts with about ``limit`` characters each."""
    start = size = 0
    for i, v in enumerate(values):
        size += len(v)
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(values):
        yield start, len(values)


# ------------------------------------------------------------ membership bits

MEMBER_BITS = 28   # at most 2^28 bits: 32 MB collected and broadcast, whatever the data size


class Members:
    """A bit table over hashed keys: no false negatives, few false positives.

    It only spares rows a shuffle; an exact step always follows.  Its size is
    2^bits / 8 bytes with bits <= MEMBER_BITS, so it may be broadcast; once the
    keys outgrow it, more rows pass and the exact step sorts them out.
    """

    def __init__(self, words: Broadcast, bits: int):
        self.words, self.bits = words, bits

    def test(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes.view(np.uint64) >> np.uint64(64 - self.bits)
        table = np.frombuffer(self.words.value, np.uint8)
        return (table[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def members(keys: DataFrame, column: str) -> Members:
    """Bit table of a column of well-mixed 64-bit hashes."""
    spark = keys.sparkSession
    n = keys.count()
    bits = int(min(MEMBER_BITS, max(16, np.ceil(np.log2(16 * n + 1)))))
    slot = F.shiftrightunsigned(F.col(column), 64 - bits) + 1
    rows = (keys.groupBy(F.bitmap_bucket_number(slot).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).collect())
    out = bytearray(1 << (bits - 3))
    for r in rows:
        at = (r["bucket"] - 1) * 4096
        chunk = bytes(r["bits"])[:len(out) - at]
        out[at:at + len(chunk)] = chunk
    return Members(spark.sparkContext.broadcast(bytes(out)), bits)


def only_members(df: DataFrame, column: str, found: Members, want: bool = True) -> DataFrame:
    """Rows whose hash may be (or surely is not) in the table; all columns are kept."""
    at = df.columns.index(column)

    def run(batches):
        for b in batches:
            if b.num_rows:
                hit = found.test(np.asarray(b.column(at).to_numpy(zero_copy_only=False), np.int64))
                yield b.filter(pa.array(hit if want else ~hit))

    return df.mapInArrow(run, df.schema)
