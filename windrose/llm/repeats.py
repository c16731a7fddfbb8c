"""Suffix-array dedup of repeated passages (operator 8).

A string of LENGTH bytes that starts at two places is removed at both.  Every
window of LENGTH bytes is named by its anchor, the k-gram with the smallest
hash in it: equal windows have equal anchors, so only stretches whose anchor
occurs again anywhere leave their document.  They are dealt to shards by their
anchor; a shard sifts the windows whose grams all occur again, builds a suffix
array by induced sorting over the words of the distinct stretches left, takes the permuted common prefixes in bytes, and induces
from them which windows, at any byte, occur again.

Anchors of more than HOT stretches (one passage in very many documents) would
make a shard too large; their windows are counted one by one instead, by
128-bit digests grouped map-side, which finds the same windows.

Defined cases: a null text counts as empty; a text shorter than LENGTH bytes
loses nothing; a text of any length is one sequence of bytes; rows repeated, with or without the same doc_id, count as
different places; an empty table gives an empty result; other columns are
ignored.  Positions are bytes of the UTF-8 text.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrose.llm.common import Members, materialise, members, only_members, prepare, texts
from windrose.llm.suffix import permuted_prefixes, suffix_array

LENGTH = 400
GRAM = 16
SIEVE = 64                 # bytes of the grams that sift windows inside a shard
HOT = 16384                # stretches of an anchor that may meet in one shard
SHARD_BYTES = 2 << 20      # bytes of stretches in one shard, about
PIECE = 1 << 19            # bytes of text in one numpy step

_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BYTE = np.array([(48 <= c <= 57) or (65 <= c <= 90) or (97 <= c <= 122) or c >= 128 for c in range(256)])


def gram_hashes(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """Mixed 64-bit hash of the ``size`` bytes (a power of two) from each position, by doubling."""
    h, width, power = data.astype(np.uint64) + np.uint64(1), 1, _BASE
    while width < size:
        h = h[:-width] * np.uint64(power) + h[width:]
        power = power * power % (1 << 64)
        width *= 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` consecutive values, by doubling."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def anchor_runs(blobs: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(text, hash, first, count, anchors): runs of windows of a text whose anchors
    have one hash, and how many anchors those are.

    The anchor is the leftmost of the grams with the smallest hash in a window,
    so it depends on the window's bytes alone.  In a text of equal lines one run
    goes on from anchor to anchor.
    """
    sizes = np.array([len(b) for b in blobs], np.int64)
    data = np.frombuffer(b"".join(blobs), np.uint8)
    if len(data) < length:
        return tuple(np.zeros(0, kind) for kind in (np.int64, np.uint64, np.int64, np.int64, np.int64))
    h = gram_hashes(data)
    place = np.arange(len(h), dtype=np.uint64)
    least = sliding_least((h >> np.uint64(32) << np.uint64(32)) | place, length - GRAM + 1)
    starts = np.cumsum(sizes) - sizes
    windows = np.maximum(0, sizes - length + 1)
    owner = np.repeat(np.arange(len(blobs)), windows)
    at = np.arange(len(owner)) + np.repeat(starts - (np.cumsum(windows) - windows), windows)
    anchor = (least[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    named = h[anchor]
    new = np.ones(len(at), bool)
    new[1:] = (named[1:] != named[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    moves = np.ones(len(at), np.int64)
    moves[1:] = anchor[1:] != anchor[:-1]
    # anchors have small hashes; mixed again, they spread over tables and shards
    spread = (named[first] ^ (named[first] >> np.uint64(31))) * np.uint64(_BASE)
    spread ^= spread >> np.uint64(29)
    spread *= np.uint64(0xBF58476D1CE4E5B9)
    return (owner[first], spread, at[first] - starts[owner[first]], np.diff(np.append(first, len(at))),
            np.add.reduceat(moves, first) if len(first) else first)


def _pieces(blobs: list[bytes]):
    """Index ranges of consecutive texts with about PIECE bytes."""
    start = size = 0
    for i, b in enumerate(blobs):
        size += len(b)
        if size >= PIECE:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(blobs):
        yield start, len(blobs)


def _rows(b: pa.RecordBatch, copied: Members | None) -> pa.RecordBatch:
    """The rows (fp, uid, doc_id, n, text) of a batch that are surely no copies."""
    if copied is None or not b.num_rows:
        return b
    return b.filter(pa.array(~copied.test(np.asarray(b.column(0).to_numpy(zero_copy_only=False), np.int64))))


def _anchors(work: DataFrame, copied: Members | None, length: int) -> DataFrame:
    """(h, n, runs): anchors, their places and their runs, counted batch by batch."""
    def run(batches):
        for b in batches:
            blobs = [x for x in (t.encode() for t in _rows(b, copied).column(4).to_pylist()) if len(x) >= length]
            for a, z in _pieces(blobs):
                _, h, _, _, anchors = anchor_runs(blobs[a:z], length)
                h, back, runs = np.unique(h, return_inverse=True, return_counts=True)
                n = np.bincount(back, anchors, len(h)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n), pa.array(runs.astype(np.int64))],
                                                 ["h", "n", "runs"])

    return work.mapInArrow(run, "h long, n long, runs long")


_ROUTED = [("kind", pa.string()), ("uid", pa.int64()), ("h", pa.int64()), ("at", pa.int64()), ("count", pa.int64()),
           ("anchors", pa.int64()), ("name", pa.binary()), ("data", pa.binary())]      # and doc_id, of its own type
_ROUTED_DDL = "kind string, uid long, h long, at long, count long, anchors long, name binary, data binary"


def _route(work: DataFrame, copied: Members | None, again: Members, hot: Members | None, length: int) -> DataFrame:
    """Rows of several kinds, one pass over the texts:

    ``plain``: a document without repeated anchors (count: its bytes, name: digest);
    ``text``: any other document, whole (data);
    ``stretch``: the bytes of a run of windows with a repeated anchor (at, count of
    windows, name of the bytes; the bytes themselves once per batch);
    ``window``: one window of a hot anchor (at, name of its bytes).

    A text with copies only lends its stretches: its own fate is known.
    """
    def run(batches):
        for b in batches:
            b = _rows(b, copied)
            kind, ids = b.schema.field(2).type, b.column(2).to_pylist()
            uids, copies = b.column(1).to_pylist(), b.column(3).to_pylist()
            blobs = [t.encode() for t in b.column(4).to_pylist()]
            rows: list[tuple] = []
            seen: set[bytes] = set()
            for a, z in _pieces(blobs):
                owner, *runs = anchor_runs(blobs[a:z], length)
                keep = again.test(runs[0].view(np.int64)) if len(owner) else np.zeros(0, bool)
                owner, h, first, count, anchors = (x[keep] for x in (owner, *runs))
                h = h.view(np.int64)
                many = hot.test(h) if hot is not None and len(h) else np.zeros(len(h), bool)
                touched = np.zeros(z - a, bool)
                touched[owner] = True
                for o, key, f, c, k, m in zip(*(x.tolist() for x in (owner, h, first, count, anchors, many))):
                    blob = blobs[a + o]
                    uid = uids[a + o] if copies[a + o] == 1 else -1
                    if m:
                        rows += [("window", uid, key, x, 1, 1, xxhash.xxh3_128_digest(blob[x:x + length]), None, None)
                                 for x in range(f, f + c)]
                    else:
                        data = blob[f:f + c - 1 + length]
                        name = xxhash.xxh3_128_digest(data)
                        rows.append(("stretch", uid, key, f, c, k, name, None if name in seen else data, None))
                        seen.add(name)
                for o, t in enumerate(touched.tolist()):
                    blob = blobs[a + o]
                    if copies[a + o] > 1:
                        continue
                    if t:
                        rows.append(("text", uids[a + o], None, None, len(blob), None, None, blob, ids[a + o]))
                    else:
                        rows.append(("plain", uids[a + o], None, None, len(blob), None,
                                     hashlib.sha256(blob).digest(), None, ids[a + o]))
                if len(rows) > 20_000:
                    yield _batch(rows, kind)
                    rows = []
                    seen.clear()
            if rows:
                yield _batch(rows, kind)

    return work.mapInArrow(run, f"{_ROUTED_DDL}, doc_id {work.schema['doc_id'].dataType.simpleString()}")


def _batch(rows: list[tuple], id_kind: pa.DataType) -> pa.RecordBatch:
    columns = [*_ROUTED, ("doc_id", id_kind)]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(zip(*rows), columns)],
                                      [name for name, _ in columns])


# ------------------------------------------------------------ one shard

class _Shard:
    """Suffix array of a shard's distinct stretches, in words or in bytes."""

    def __init__(self, stretches: list[bytes], by_words: bool):
        self.data = np.frombuffer(b"".join(stretches), np.uint8)
        sizes = np.array([len(s) for s in stretches], np.int64)
        self.starts = np.cumsum(sizes) - sizes
        self.owner = np.repeat(np.arange(len(stretches)), sizes)
        n = len(self.data)
        forced = np.zeros(n, bool)
        forced[self.starts] = True
        if by_words:
            # a unit is a word with what follows it, up to the next word
            word = _WORD_BYTE[self.data]
            begins = word.copy()
            begins[1:] &= ~word[:-1]
            begins[self.starts] = False          # whether a word begins there, the stretch does not tell
        else:
            begins = np.ones(n, bool)
        self.begins = begins
        cut = np.flatnonzero(begins | forced)
        stop = np.append(cut[1:], n)
        joined = self.data.tobytes()
        units = list(map(joined.__getitem__, map(slice, cut.tolist(), stop.tolist())))
        rank = {u: i for i, u in enumerate(sorted(set(units)))}
        codes = np.fromiter(map(rank.__getitem__, units), np.int64, len(units))
        # each stretch ends in a symbol of its own, smaller than all units; the last one is 0
        owner = self.owner[cut]
        slot = np.arange(len(cut)) + owner
        total = len(cut) + len(stretches)
        text = np.empty(total, np.int64)
        ends = np.append(np.flatnonzero(np.diff(owner)), len(owner) - 1)
        text[slot] = codes + len(stretches)
        text[slot[ends] + 1] = np.arange(len(stretches) - 1, -1, -1)
        self.offset = np.empty(total + 1, np.int64)        # byte where a unit begins
        self.offset[slot] = cut
        self.offset[slot[ends] + 1] = stop[ends]
        self.offset[total] = n
        sa = suffix_array(text)
        plcp = permuted_prefixes(text, sa)
        self.rank = np.empty(total, np.int64)
        self.rank[sa] = np.arange(total)
        self.common = self._bytes_in_common(sa, plcp, sizes)
        self.unit_at = np.full(n, -1, np.int64)
        self.unit_at[cut] = slot

    def _bytes_in_common(self, sa: np.ndarray, plcp: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Bytes that each suffix in order shares with the one before it: whole units
        and what the first different units have in common."""
        out = np.zeros(len(sa), np.int64)
        i, j = sa[1:], sa[:-1]
        k = plcp[i]
        x, y = self.offset[i + k], self.offset[j + k]
        out[1:] = x - self.offset[i]
        stops = self.starts + sizes
        n = len(self.data)
        limit_x = stops[self.owner[np.minimum(self.offset[i], n - 1)]]
        limit_y = stops[self.owner[np.minimum(self.offset[j], n - 1)]]
        # suffixes that begin at a stretch's own end symbol share nothing
        empty = (self.offset[i] >= limit_x) | (k == 0) & (self.offset[j] >= limit_y)
        live = np.flatnonzero(~empty)
        while len(live):
            ok = (x[live] < limit_x[live]) & (y[live] < limit_y[live])
            live = live[ok]
            live = live[self.data[x[live]] == self.data[y[live]]]
            out[live + 1] += 1
            x[live] += 1
            y[live] += 1
        return out


def repeated_windows(stretches: list[bytes], counts: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """For each distinct stretch, of its first ``counts`` windows those that occur
    in the list more than once."""
    flags = [np.zeros(c, bool) for c in counts]
    s = _Shard(stretches, by_words=True)
    n = len(s.data)
    at = np.flatnonzero(s.begins)
    # next word after a position, if it begins in the same stretch and within a window
    index = np.searchsorted(at, np.arange(n), side="right")
    target = np.append(at, n)[index]
    inside = (target < n)
    inside[inside] &= s.owner[target[inside]] == s.owner[np.flatnonzero(inside)]
    distance = np.where(inside, target - np.arange(n), length)
    counts_ = np.array(counts, np.int64)
    local = np.arange(n) - s.starts[s.owner]
    valid = local < counts_[s.owner]
    near = distance < length
    # a position's part of a word is named through the position after it
    name = np.full(n + 1, -1, np.int64)
    order = np.argsort(distance, kind="stable")
    cuts = np.searchsorted(distance[order], np.arange(1, length + 1))
    for d in range(1, length):
        x = order[cuts[d - 1]:cuts[d]]
        if not len(x):
            break          # no position is so far from a word, so none is farther
        key = s.data[x].astype(np.int64)
        if d > 1:
            key += name[x + 1] << 8
        name[x] = np.unique(key, return_inverse=True)[1]
        x = x[valid[x]]
        if not len(x):
            continue
        group = np.cumsum(s.common < length - d)
        both = name[x] * (len(group) + 1) + group[s.rank[s.unit_at[target[x]]]]
        _, back, many = np.unique(both, return_inverse=True, return_counts=True)
        _mark(flags, s, x[many[back] > 1], local)
    far = np.unique(s.owner[valid & ~near])
    if len(far):
        # windows without the beginning of a word: the same over single bytes
        b = _Shard([stretches[i] for i in far.tolist()], by_words=False)
        x = np.flatnonzero(valid & ~near)
        y = b.starts[np.searchsorted(far, s.owner[x])] + local[x]
        group = np.cumsum(b.common < length)
        _, back, many = np.unique(group[b.rank[b.unit_at[y]]], return_inverse=True, return_counts=True)
        _mark(flags, s, x[many[back] > 1], local)
    return flags


def _mark(flags: list[np.ndarray], s: _Shard, x: np.ndarray, local: np.ndarray) -> None:
    owner = s.owner[x]
    order = np.argsort(owner, kind="stable")
    x, owner = x[order], owner[order]
    cuts = np.append(np.flatnonzero(np.append(True, owner[1:] != owner[:-1])), len(x)) if len(x) else []
    for a, z in zip(cuts[:-1], cuts[1:]):
        flags[owner[a]][local[x[a:z]]] = True


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def _lone_anchors(seen) -> set[int]:
    """Anchors named once by (anchor, whether it stands at several places there),
    at one place: nothing in the shard can match there."""
    once: dict[int, int] = {}
    for h, several in seen:
        once[h] = once.get(h, 0) + 1 + several
    return {h for h, n in once.items() if n == 1}


def candidate_windows(stretches: list[bytes], counts: list[int], length: int) -> list[tuple[int, int, int]]:
    """(stretch, first, count): runs of windows in which every gram of SIEVE bytes
    occurs again in the list, as it does in any window that occurs again."""
    sieve = 1 << min(SIEVE, length).bit_length() - 1
    if not stretches:
        return []
    data = np.frombuffer(b"".join(stretches), np.uint8)
    sizes = np.array([len(s) for s in stretches], np.int64)
    starts = np.cumsum(sizes) - sizes
    h = gram_hashes(data, sieve)
    inside = np.ones(len(data), bool)
    for k in range(1, sieve):          # grams that cross into the next stretch
        inside[starts + sizes - k] = False
    at = np.flatnonzero(inside)
    order = np.argsort(h[at])
    ranked = h[at][order]
    same = ranked[1:] == ranked[:-1]
    again = np.append(same, False) | np.append(False, same)
    lonely = np.zeros(len(data) + 1, np.int64)
    lonely[at[order[~again]] + 1] = 1
    lonely = np.cumsum(lonely)
    out = []
    for k, (s, c) in enumerate(zip(starts.tolist(), counts)):
        good = lonely[s + length - sieve + 1:s + length - sieve + 1 + c] == lonely[s:s + c]
        out += [(k, a, z - a) for a, z in _runs(good)]
    return out


def _solve(t: pa.Table, length: int) -> pa.Table:
    """(uid, first, end): bytes of each document that the shard's repeated windows cover."""
    h, uid, at, anchors = (t.column(c).to_numpy() for c in ("h", "uid", "at", "anchors"))
    count, names = t.column("count").to_numpy(), t.column("name").to_pylist()
    data = t.column("data")
    stretches: dict[tuple[int, bytes], list[int]] = {}
    for i, key in enumerate(zip(h.tolist(), names)):
        stretches.setdefault(key, []).append(i)
    blob = {}
    for i in np.flatnonzero(np.asarray(data.is_valid())).tolist():
        blob.setdefault(names[i], i)
    # a stretch held twice is repeated whole
    found = {key: np.full(count[own[0]], len(own) > 1) for key, own in stretches.items()}
    alone = _lone_anchors((key[0], anchors[own[0]] > 1) for key, own in stretches.items())
    open_ = [key for key in stretches if key[0] not in alone]
    whole = [data[blob[key[1]]].as_py() for key in open_]
    pieces: dict[tuple[int, bytes], list[tuple[int, int]]] = {}
    for k, a, c in candidate_windows(whole, [len(found[key]) for key in open_], length):
        pieces.setdefault((open_[k][0], whole[k][a:a + c - 1 + length]), []).append((k, a))
    several = {key[0] for key, own in stretches.items() if anchors[own[0]] > 1}
    alone = _lone_anchors((h_, h_ in several) for h_, _ in pieces)
    hard = [key for key in pieces if key[0] not in alone]
    flags_of = {key: np.full(len(key[1]) - length + 1, len(own) > 1) for key, own in pieces.items()}
    if hard:
        got = repeated_windows([key[1] for key in hard], [len(flags_of[key]) for key in hard], length)
        for key, flags in zip(hard, got):
            flags_of[key] |= flags
    for key, own in pieces.items():
        for k, a in own:
            found[open_[k]][a:a + len(flags_of[key])] |= flags_of[key]
    out: list[tuple[int, int, int]] = []
    for key, flags in found.items():
        runs = _runs(flags)
        for i in stretches[key]:
            if uid[i] >= 0:
                out += [(int(uid[i]), int(at[i]) + a, int(at[i]) + z - 1 + length) for a, z in runs]
    return pa.table({c: pa.array([r[k] for r in out], pa.int64()) for k, c in enumerate(("uid", "first", "end"))})


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s in sorted((s["first"], s["end"]) for s in spans or []):
        if out and s[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s[1])
        else:
            out.append(list(s))
    return [tuple(s) for s in out]


def _routed_spans(parts: list[tuple[DataFrame, Members | None]], length: int,
                  hot_limit: int) -> tuple[DataFrame, DataFrame]:
    """(routed rows, spans (uid, first, end)) of tables (fp, uid, doc_id, n, text)."""
    def union(frames: list[DataFrame]) -> DataFrame:
        return functools.reduce(DataFrame.unionByName, frames)

    counted = union([_anchors(work, copied, length) for work, copied in parts])
    again = materialise(counted.groupBy("h").agg(F.sum("n").alias("n"), F.sum("runs").alias("runs")).filter("n > 1"),
                        "repeat-anchors")
    hot = again.filter(F.col("runs") > hot_limit)
    many = None if hot.isEmpty() else members(hot, "h")
    known = members(again, "h")
    routed = materialise(union([_route(work, copied, known, many, length) for work, copied in parts]), "repeat-routed")
    stretch = routed.filter("kind = 'stretch'").select("h", "uid", "at", "count", "anchors", "name", "data")
    size = stretch.agg(F.sum(F.coalesce(F.length("data"), F.lit(0)) + 64)).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    spans = (stretch.withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(shards))).groupBy("shard")
             .applyInArrow(lambda t: _solve(t, length), "uid long, first long, end long"))
    if many is not None:
        window = routed.filter("kind = 'window'").select("uid", "at", "name")
        twice = materialise(window.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("name"),
                            "repeat-windows")
        spans = spans.unionByName(window.filter("uid >= 0").join(twice, "name", "left_semi").select(
            "uid", F.col("at").alias("first"), (F.col("at") + length).alias("end")))
    return routed, spans


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   hot_limit: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept_sha256, kept) for every row: ``spans``
    the removed runs, ``kept`` the bytes that are left, null where nothing goes.

    Equal texts are put aside first: they go whole when they have LENGTH bytes,
    and one of them stands for all where other texts are compared.
    """
    prepare(docs.sparkSession)
    base = texts(docs, id_col, text_col).withColumn("fp", F.xxhash64("text"))
    found = members(materialise(base.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("fp"),
                                "repeat-prints"), "fp")
    maybe = only_members(base, "fp", found)
    groups = materialise(maybe.groupBy("text").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("doc_id"))
                         .withColumn("sha", F.sha2("text", 256)), "repeat-copies")
    columns = ["fp", "uid", "doc_id", "n", "text"]
    alone = base.withColumn("n", F.lit(1).cast("long")).withColumn("uid", F.monotonically_increasing_id() * 2)
    shared = (groups.withColumn("fp", F.lit(0).cast("long"))
              .withColumn("uid", F.monotonically_increasing_id() * 2 + 1))
    routed, spans = _routed_spans([(alone.select(columns), found), (shared.select(columns), None)], length, hot_limit)

    nothing = F.from_json(F.lit("[]"), "array<struct<first:long,end:long>>")
    zero, no_bytes = F.lit(0).cast("long"), F.lit(None).cast("binary")
    plain = routed.filter("kind = 'plain'").select(
        "doc_id", F.col("count").alias("n_bytes"), zero.alias("n_removed"), nothing.alias("spans"),
        F.lower(F.hex("name")).alias("kept_sha256"), no_bytes.alias("kept"))
    own = spans.groupBy("uid").agg(F.collect_list(F.struct("first", "end")).alias("spans"))
    cut = (routed.filter("kind = 'text'").select("uid", "doc_id", "data").join(own, "uid", "left")
           .select("doc_id", "data", "spans")
           .mapInArrow(_cut, f"doc_id {base.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_removed long, "
                             "spans array<struct<first:long,end:long>>, kept_sha256 string, kept binary"))
    size = F.octet_length("text").cast("long")
    whole = F.col("n_bytes") >= length
    copies = (maybe.select("doc_id", size.alias("n_bytes"), F.sha2("text", 256).alias("sha"))
              .join(groups.filter("n > 1").select("sha"), "sha")
              .select("doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(zero).alias("n_removed"),
                      F.when(whole, F.array(F.struct(zero.alias("first"), F.col("n_bytes").alias("end"))))
                      .otherwise(nothing).alias("spans"),
                      F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.col("sha")).alias("kept_sha256"),
                      F.when(whole, F.lit(b"")).otherwise(no_bytes).alias("kept")))
    return plain.unionByName(cut).unionByName(copies)


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))


def _cut(batches):
    for b in batches:
        rows = []
        for blob, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            runs = _merged(spans)
            kept, last = [], 0
            for a, z in runs:
                kept.append(blob[last:a])
                last = z
            rest = b"".join([*kept, blob[last:]])
            rows.append((len(blob), len(blob) - len(rest), [{"first": a, "end": z} for a, z in runs],
                         hashlib.sha256(rest).hexdigest(), rest if runs else None))
        cols = list(zip(*rows)) if rows else [[]] * 5
        kinds = [pa.int64(), pa.int64(), _SPANS, pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                                         ["doc_id", "n_bytes", "n_removed", "spans", "kept_sha256", "kept"])
