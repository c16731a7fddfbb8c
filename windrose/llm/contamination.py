"""Benchmark decontamination (operator 3).

The windows of the benchmark (n consecutive normalised words) become hash sets
of bounded size that are broadcast one block at a time; every document's word
windows are hashed and looked up, each hit is verified on the words
themselves, and hit spans or documents can be removed.

Defined cases: a null text has no words; an item without words has no window;
an item shorter than a window is one window; items repeated with the same id
count once; an item without id counts under the empty id; items that share
a window are all hit by it; a text of any length is scanned whole; repeated
documents are judged row by row; an empty benchmark hits nothing; other columns are
ignored (or passed through by ``remove``).
"""

from __future__ import annotations

import itertools
import re
import functools
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrose.llm.common import WORD_BYTES, materialise, prepare, texts

WORDS = 10
BLOCK_WINDOWS = 1 << 20    # windows that one broadcast set holds at most, on average
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_MIX = [pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) | 1 for k in range(64)]


def normal_words(text: str) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split()


def benchmark_windows(bench: DataFrame, words: int = WORDS, id_col: str = "item_id",
                      text_col: str = "text") -> DataFrame:
    """(item, size, win, h): the distinct windows of every item, ``win`` the words
    joined by blanks, ``size`` their number, ``h`` a hash that spreads them."""
    base = bench.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def cut(batches):
        for b in batches:
            items, wins, sizes = [], [], []
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = normal_words(text)
                size = min(words, len(w))
                got = {b" ".join(w[i:i + size]) for i in range(len(w) - size + 1)} if w else ()
                items += [item] * len(got)
                sizes += [size] * len(got)
                wins += got
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(sizes, pa.int64()),
                                              pa.array(wins, pa.binary())], ["item", "size", "win"])

    return (base.mapInArrow(cut, "item string, size long, win binary").distinct()
            .withColumn("h", F.xxhash64("win")))


class WindowSet:
    """One block of benchmark windows: vocabulary, hashes by size, windows to items."""

    def __init__(self, rows: list[tuple[str, int, bytes]]):
        self.items: dict[bytes, list[str]] = {}
        vocabulary: dict[bytes, int] = {}
        hashes: dict[int, set[int]] = {}
        for item, size, win in rows:
            win = bytes(win)
            self.items.setdefault(win, []).append(item)
            total = 0
            for k, w in enumerate(win.split()):
                code = vocabulary.get(w)
                if code is None:
                    code = vocabulary[w] = xxhash.xxh3_64_intdigest(w) | 1   # 0 is kept for other words
                total += code * _MIX[k % 64]
            hashes.setdefault(size, set()).add(total & (1 << 64) - 1)
        self.vocabulary = vocabulary
        self.hashes = {s: np.sort(np.fromiter(v, np.uint64, len(v))) for s, v in hashes.items()}

    def scan(self, words: list[bytes]) -> list[tuple[int, int, list[str]]]:
        """(first word, words, items) of each verified occurrence."""
        n = len(words)
        codes = np.fromiter(map(self.vocabulary.get, words, itertools.repeat(0)), np.uint64, n)
        known = codes != 0
        total = np.concatenate([[0], np.cumsum(known)])
        out = []
        for size, table in self.hashes.items():
            if size > n:
                continue
            at = np.flatnonzero(total[size:] - total[:-size] == size)
            if not len(at):
                continue
            h = np.zeros(len(at), np.uint64)
            for k in range(size):
                h += codes[at + k] * np.uint64(_MIX[k % 64])
            slot = np.minimum(np.searchsorted(table, h), len(table) - 1)
            for i in at[table[slot] == h].tolist():
                items = self.items.get(b" ".join(words[i:i + size]))
                if items:
                    out.append((i, size, items))
        return out


def _blocks(bench: DataFrame, words: int, block_windows: int):
    """Collected window sets, each bounded by its share of the windows' hashes."""
    windows = materialise(benchmark_windows(bench, words), "bench-windows")
    n = windows.count()
    blocks = max(1, -(-n // block_windows))
    for k in range(blocks):
        part = windows if blocks == 1 else windows.filter(F.pmod("h", F.lit(blocks)) == k)
        yield k, blocks, [(r["item"], r["size"], bytes(r["win"])) for r in part.select("item", "size", "win").collect()]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], z))
        else:
            out.append((a, z))
    return out


_SETS: dict[str, WindowSet] = {}


def _window_set(key: str, rows) -> WindowSet:
    """Built once per worker and block from the broadcast rows."""
    if key not in _SETS:
        _SETS.clear()
        _SETS[key] = WindowSet(rows.value)
    return _SETS[key]


_SCANNED = "n_words long, spans array<struct<first:long,end:long>>, items array<string>"
_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))


def _scan(docs: DataFrame, key: str, rows) -> DataFrame:
    """``docs`` (key column, text) with word count, hit word spans and items of one block."""
    name, kind = docs.columns[0], docs.schema[0].dataType.simpleString()

    def run(batches):
        found = _window_set(key, rows)
        for b in batches:
            counts, spans, items = [], [], []
            for text in b.column(1).to_pylist():
                w = normal_words(text)
                hits = found.scan(w) if w else []
                counts.append(len(w))
                spans.append([{"first": a, "end": z} for a, z in _merged([(i, i + s) for i, s, _ in hits])])
                items.append(sorted({x for _, _, own in hits for x in own}))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(spans, _SPANS),
                                              pa.array(items, pa.list_(pa.string()))],
                                             [name, "n_words", "spans", "items"])

    return docs.mapInArrow(run, f"{name} {kind}, {_SCANNED}")


def scan_benchmark(docs: DataFrame, bench: DataFrame, words: int = WORDS, id_col: str = "doc_id",
                   text_col: str = "text", block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """(doc_id, n_words, spans, items): hit word spans and the items that occur.

    A benchmark whose windows fit one set is scanned for in one pass; a larger
    one in blocks, every block against all documents, with the few documents
    that a block hits joined together at the end.
    """
    spark = prepare(docs.sparkSession)
    base = texts(docs, id_col, text_col)
    parts, keyed = [], base
    for k, blocks, rows in _blocks(bench, words, block_windows):
        if blocks > 1 and not parts:
            keyed = materialise(base.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text"), "bench-docs")
        sent = spark.sparkContext.broadcast(rows)
        if blocks == 1:
            return _scan(base, uuid.uuid4().hex, sent)
        part = _scan(keyed.select("uid", "text"), uuid.uuid4().hex, sent)
        parts.append(materialise(part if k == 0 else part.filter(F.size("items") > 0), "bench-hits"))
        sent.unpersist()
    hits = parts[0].drop("n_words")
    for p in parts[1:]:
        hits = hits.unionByName(p.drop("n_words"))
    hits = hits.filter(F.size("items") > 0).groupBy("uid").agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return (keyed.select("uid", "doc_id").join(parts[0].select("uid", "n_words"), "uid").join(hits, "uid", "left")
            .select("doc_id", "n_words", F.coalesce("spans", F.from_json(F.lit("[]"), "array<struct<first:long,end:long>>")).alias("spans"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def covered(spans: Column) -> Column:
    """Words inside at least one of possibly overlapping spans."""
    ordered = F.array_sort(spans)
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("reach"))
    step = lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(acc["reach"], s["first"]))).alias("n"),
        F.greatest(acc["reach"], s["end"]).alias("reach"))
    return F.aggregate(ordered, start, step, lambda acc: acc["n"])


def report(scanned: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    n_hit = covered(F.col("spans"))
    return scanned.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def remove(docs: DataFrame, bench: DataFrame, what: str = "documents", words: int = WORDS,
           text_col: str = "text", block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The rows of ``docs``, all columns, without contaminated documents
    (``what="documents"``), or with the hit spans cut out of the text, from the
    first hit word's first character to the last one's last (``what="spans"``)."""
    if what not in ("documents", "spans"):
        raise ValueError(f"what is 'documents' or 'spans', not {what!r}")
    spark = prepare(docs.sparkSession)
    if what == "spans":
        return _without_spans(docs, bench, words, text_col, block_windows)
    at, out = docs.columns.index(text_col), docs
    for _, blocks, rows in _blocks(bench, words, block_windows):
        sent = spark.sparkContext.broadcast(rows)
        out = out.mapInArrow(_remover(at, uuid.uuid4().hex, sent), docs.schema)
        if blocks > 1:      # one set in memory at a time
            out = materialise(out, "bench-removed")
    return out


def _remover(at: int, key: str, rows):
    def run(batches):
        found = _window_set(key, rows)
        for b in batches:
            yield b.filter(pa.array([not (t and found.scan(normal_words(t))) for t in b.column(at).to_pylist()], pa.bool_()))
    return run


def _without_spans(docs: DataFrame, bench: DataFrame, words: int, text_col: str, block_windows: int) -> DataFrame:
    """Hit spans of all blocks are found on the input first and cut once, so the result
    does not depend on the number of blocks."""
    spark = docs.sparkSession
    rows = materialise(docs.select(F.monotonically_increasing_id().alias("_uid"), F.struct(*docs.columns).alias("_row")), "bench-rows")
    keyed = rows.select("_uid", F.coalesce(F.col("_row").getField(text_col), F.lit("")).alias("text"))
    hits = []
    for _, _, windows in _blocks(bench, words, block_windows):
        sent = spark.sparkContext.broadcast(windows)
        part = _scan(keyed, uuid.uuid4().hex, sent).filter(F.size("spans") > 0)
        hits.append(materialise(part.select("_uid", "spans"), "bench-hits"))
        sent.unpersist()
    spans = functools.reduce(DataFrame.unionByName, hits).groupBy("_uid").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    names = docs.columns
    at = names.index(text_col)

    def cut(batches):
        for b in batches:
            row = b.column(0)
            columns = row.flatten()
            texts_ = [_cut(t, _merged([(x["first"], x["end"]) for x in s])) if s else t
                      for t, s in zip(columns[at].to_pylist(), b.column(1).to_pylist())]
            columns[at] = pa.array(texts_, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.join(spans, "_uid", "left").select("_row", "spans").mapInArrow(cut, docs.schema)


def _cut(text: str, spans: list[tuple[int, int]]) -> str:
    lower = text.translate({c: c + 32 for c in range(65, 91)})
    words = [m.span() for m in _WORD.finditer(lower)]
    out, last = [], 0
    for a, z in spans:
        out.append(text[last:words[a][0]])
        last = words[z - 1][1]
    return "".join([*out, text[last:]])
