"""Byte-level BPE encoding and decoding (operator 10).

Pre-tokenisation works on arrays of code points: a table gives each its class,
a look at the next code points turns classes into the symbols of a small
automaton, and the automaton's transition functions are composed by an
associative scan, so that all boundaries of a batch of texts come out of a few
array steps and no regular expression runs.  The slices between boundaries
feed pair merging through a cache; their ends stay with the ids.

Defined cases: a null text counts as empty and has no ids; text of any length
is encoded whole; rows repeat as they are; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from windrose.llm.common import prepare, slices, texts

# code point classes
LETTER, NUMBER, OTHER, SPACE = range(4)
# White_Space code points, as the pattern's \s takes them (fixed values)
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
               0x205F, 0x3000]
# tails of the contractions that the pattern splits off after an apostrophe (fixed values)
SHORT_TAILS, LONG_TAILS = ("s", "t", "m", "d"), ("re", "ve", "ll")

SLICE = 1 << 18     # code points that one step encodes, about

# automaton: what the code point before was part of
(S_START, S_LETTER, S_NUMBER, S_OTHER, S_SPACE, S_LEAD, S_TAIL1, S_TAIL2) = range(8)
# symbols: a code point with what follows it
(Y_START, Y_LETTER, Y_NUMBER, Y_OTHER, Y_SPACE, Y_LEAD, Y_ALONE, Y_SHORT, Y_LONG) = range(9)


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """Next state, and whether a piece begins at the code point."""
    runs_on = {Y_LETTER: S_LETTER, Y_NUMBER: S_NUMBER, Y_OTHER: S_OTHER, Y_SPACE: S_SPACE}
    if symbol == Y_START:                       # separator between texts
        return S_START, True
    if symbol == Y_LETTER and state in (S_TAIL1, S_TAIL2):
        return (S_START if state == S_TAIL1 else S_TAIL1), False
    if symbol == Y_LEAD:                        # the blank before a word belongs to it
        return S_LEAD, True
    if symbol == Y_ALONE:                       # last white space of a run, not a blank
        return S_START, True
    if symbol in (Y_SHORT, Y_LONG):             # an apostrophe with a contraction's tail
        if state in (S_OTHER, S_LEAD):
            return S_OTHER, False
        return (S_TAIL1 if symbol == Y_SHORT else S_TAIL2), True
    joined = state == runs_on[symbol] or (state == S_LEAD and symbol != Y_SPACE)
    return runs_on[symbol], not joined


@functools.cache
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(function of a symbol, functions as state tables, composition, begins).

    The functions are those that the symbols generate; ``composition[f, g]`` is
    f followed by g, so any bracketing of a text's symbols gives one result.
    """
    begins = np.array([[_step(s, y)[1] for y in range(9)] for s in range(8)])
    generators = [tuple(_step(s, y)[0] for s in range(8)) for y in range(9)]
    known = {g: i for i, g in enumerate(dict.fromkeys([tuple(range(8)), *generators]))}
    grown = True
    while grown:
        grown = False
        for f in list(known):
            for g in generators:
                h = tuple(g[s] for s in f)
                if h not in known:
                    known[h] = len(known)
                    grown = True
    names = list(known)
    assert len(names) < 256
    comp = np.array([[known[tuple(g[s] for s in f)] for g in names] for f in names], np.uint8)
    return (np.array([known[g] for g in generators], np.uint8), np.array(names, np.uint8), comp, begins)


@functools.cache
def classes() -> np.ndarray:
    """Class of every code point, from its general category."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[WHITE_SPACE] = SPACE
    return out


def scan_states(functions: np.ndarray) -> np.ndarray:
    """State before each code point: an exclusive scan under function composition.

    Rows of a matrix are composed column by column, then the row totals one
    after the other, then each row starts from the state that its
    predecessors lead to.
    """
    _, tables, comp, _ = automaton()
    n = len(functions)
    width = max(16, int(np.sqrt(n / 8)))
    rows = -(-n // width)
    grid = np.zeros(rows * width, np.uint8)    # function 0 is the identity
    grid[:n] = functions
    grid = np.ascontiguousarray(grid.reshape(rows, width).T)
    flat, size = comp.ravel(), len(comp)
    before = np.empty_like(grid)
    so_far = np.zeros(rows, np.uint8)
    for j in range(width):
        before[j] = so_far
        so_far = flat[so_far.astype(np.intp) * size + grid[j]]
    start = np.empty(rows, np.intp)
    state = S_START
    for i, f in enumerate(so_far.tolist()):
        start[i] = state
        state = tables[f, state]
    return tables[before, start].T.ravel()[:n]


def boundary_flags(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether a piece begins at each code point; ``starts`` marks the first of each text."""
    symbol_function, _, _, begins = automaton()
    n = len(points)
    kind = classes()[points]
    last = np.ones(n, bool)                    # nothing of this text follows
    last[:-1] = starts[1:]
    follows = np.full(n, SPACE, np.uint8)      # class of the next code point, white space at the end
    follows[:-1] = kind[1:]
    follows[last] = SPACE
    symbol = np.array([Y_LETTER, Y_NUMBER, Y_OTHER, Y_SPACE], np.uint8)[kind]
    ends_run = (kind == SPACE) & (follows != SPACE)
    symbol[ends_run] = np.where(points[ends_run] == 0x20, Y_LEAD, Y_ALONE)
    quote = np.flatnonzero(points == 0x27)
    if len(quote):
        wide = np.concatenate([points, np.zeros(2, points.dtype)])
        one, two = wide[quote + 1], wide[quote + 2]
        open1 = ~last[quote]
        open2 = open1 & ~np.append(last, True)[quote + 1]
        short = open1 & np.isin(one, [ord(t) for t in SHORT_TAILS])
        long = np.zeros(len(quote), bool)
        for t in LONG_TAILS:
            long |= (one == ord(t[0])) & (two == ord(t[1]))
        symbol[quote[short]] = Y_SHORT
        symbol[quote[long & open2]] = Y_LONG
    functions = symbol_function[symbol]
    # a text's first code point starts anew: its function forgets the state before
    first = np.flatnonzero(starts)
    state = scan_states_with_starts(functions, symbol, first)
    return begins[state, symbol]


def scan_states_with_starts(functions: np.ndarray, symbol: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Like ``scan_states``; at each text's first code point the state is S_START."""
    symbol_function, tables, comp, _ = automaton()
    reset = symbol_function[Y_START]
    functions = functions.copy()
    functions[first] = comp[reset, functions[first]]
    state = scan_states(functions)
    state[first] = S_START
    return state


class Vocabulary:
    """Ranks of byte strings, with pair merging cached by piece."""

    CACHE = 1 << 18     # pieces, in two generations
    LONG = 256          # bytes; longer pieces are merged on a heap and not cached

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.cache = _PieceCache(self)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a piece: the adjacent pair of lowest rank is joined until none is left."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(piece) > self.LONG:
            return self._merge_long(piece)
        parts = [piece[i:i + 1] for i in range(len(piece))]
        pairs = [ranks.get(piece[i:i + 2], 1 << 60) for i in range(len(piece) - 1)]
        while pairs:
            low = min(pairs)
            if low == 1 << 60:
                break
            i = pairs.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], 1 << 60)
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 60)
        return [ranks[p] for p in parts]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same for a long piece, with a heap over linked parts."""
        import heapq
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))
        prev, alive = list(range(-1, n - 1)), [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i] if alive[i] else n
            if not alive[i] or j >= n or end[j] != stop:
                continue
            alive[j] = False
            end[i] = stop
            if stop < n:
                prev[stop] = i
                if (r := ranks.get(piece[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if prev[i] >= 0 and (r := ranks.get(piece[prev[i]:stop])) is not None:
                heapq.heappush(heap, (r, prev[i], stop))
        return [ranks[piece[i:end[i]]] for i in range(n) if alive[i]]

    def encode_batch(self, texts_: list[str]) -> list[tuple[bytes, np.ndarray]]:
        """For each text its ids (little-endian unsigned 32 bit) and the ends of
        its pieces, in ids."""
        joined = "".join(texts_)
        sizes = np.fromiter(map(len, texts_), np.int64, len(texts_))
        stops = np.cumsum(sizes)
        begin = stops - sizes
        if not joined:
            return [(b"", np.zeros(0, np.int64))] * len(texts_)
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        starts = np.zeros(len(points), bool)
        starts[begin[sizes > 0]] = True
        cuts = np.flatnonzero(boundary_flags(points, starts))
        at = cuts.tolist()
        coded = list(map(self.cache.__getitem__, map(joined.__getitem__, map(slice, at, at[1:] + [len(joined)]))))
        bounds = np.searchsorted(cuts, np.append(begin, len(joined))).tolist()
        out = []
        for a, z in zip(bounds, bounds[1:]):
            own = coded[a:z]
            out.append((b"".join(own), np.cumsum(np.fromiter(map(len, own), np.int64, z - a)) >> 2))
        if len(self.cache) > self.CACHE >> 1:
            self.cache.turn()
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class _PieceCache(dict):
    """Ids of the pieces of this generation; those of the one before are taken over
    when they come up again, so frequent pieces stay and rare ones go."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.before: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.before.pop(piece, None)
        if ids is None:
            ids = np.array(self.vocabulary.merge(piece.encode()), "<u4").tobytes()
            if len(piece) > self.vocabulary.LONG:
                return ids
        self[piece] = ids
        return ids

    def turn(self) -> None:
        self.before = dict(self)
        self.clear()


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    """Loaded once per Python worker."""
    return Vocabulary(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<long>, piece_ends array<long>): ids of every text and
    the number of ids up to the end of each piece."""
    prepare(docs.sparkSession)

    def run(batches):
        v = vocabulary(path)
        for b in batches:
            ids, values = b.column(0), b.column(1).to_pylist()
            for a, z in slices(values, SLICE):
                got = v.encode_batch(values[a:z])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, z - a), pa.array([np.frombuffer(x, "<u4").astype(np.int64) for x, _ in got],
                                                   pa.list_(pa.int64())),
                     pa.array([e for _, e in got], pa.list_(pa.int64()))], ["doc_id", "ids", "piece_ends"])

    base = texts(docs, id_col, text_col)
    return base.mapInArrow(run, f"doc_id {base.schema['doc_id'].dataType.simpleString()}, "
                                "ids array<long>, piece_ends array<long>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text): the texts behind (doc_id, ids)."""
    prepare(encoded.sparkSession)

    def run(batches):
        v = vocabulary(path)
        for b in batches:
            out = [v.decode(np.asarray(x, "<u4").tobytes()).decode() for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): every text encoded and its
    ids decoded again, in one pass and without sending ids back."""
    prepare(docs.sparkSession)

    def run(batches):
        v = vocabulary(path)
        for b in batches:
            ids, values = b.column(0), b.column(1).to_pylist()
            for a, z in slices(values, SLICE):
                coded = [x for x, _ in v.encode_batch(values[a:z])]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, z - a), pa.array([len(x) >> 2 for x in coded], pa.int64()),
                     pa.array([hashlib.sha256(x).hexdigest() for x in coded]),
                     pa.array([hashlib.sha256(v.decode(x)).hexdigest() for x in coded])],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    base = texts(docs, id_col, text_col)
    return base.mapInArrow(run, f"doc_id {base.schema['doc_id'].dataType.simpleString()}, "
                                "n_tokens long, ids_sha256 string, decoded_sha256 string")
