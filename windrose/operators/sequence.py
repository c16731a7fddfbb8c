"""Order-dependent operators: arrival fragments (W1 / ST3 / ST5), first-event
anchored windows (ST2) and the per-source throttle (ST6).

None of them uses a window without a partition key.  Running values along the
arrival order are computed in two levels (R5): rows are cut into buckets of
consecutive sequence numbers, each bucket is scanned on its own (partitioned
window), and a tiny per-bucket summary carries the value of all earlier
buckets.  ``bucket_rows="auto"`` (the default) takes the bucket edges from a
quantile sketch over all sequence numbers, so each bucket holds about a million
rows however the numbers are spread (dense, sparse, or dense with far
outliers); an int fixes the width in sequence units (with unique sequence
numbers, an upper bound on the rows of a bucket).  The summary has one row per
bucket; the join back is left to AQE, which broadcasts it when its measured
size is small and shuffles otherwise.

The order column must be unique per key (arrival sequence numbers are); if
it is not, fold a tie-breaker into it first (for example the event id), or
the order of tied rows, and so the result, is not defined.  Rows without a
sequence number come before all others.
"""

from __future__ import annotations

import json
import re
from typing import NamedTuple, Optional, Sequence, Union

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrose.functions.scalar import Duration, duration_us, floor_window
from windrose.session import kept_table, prepare_session

DEFAULT_BUCKET_ROWS = 1 << 20
MAX_SPLITS = 4096      # edges taken from the sketch; more buckets are even parts between two edges
_ACCURACY = 50_000     # ranks of the sketch are right within rows / _ACCURACY
_NO_SEQ = -(1 << 63)   # stands for a missing sequence number, before all others
BucketRows = Union[int, str]


class Buckets(NamedTuple):
    """Where buckets begin, in how many even parts each interval between two edges is
    cut, and whether rows without a number need a bucket of their own."""
    edges: list[int]
    parts: int
    nulls: bool

    @property
    def single(self) -> bool:
        return not self.edges and not self.nulls


def bucket_edges(df: DataFrame, seq: str, target_rows: int = DEFAULT_BUCKET_ROWS) -> Buckets:
    """Buckets of about ``target_rows`` rows, from one pass over a narrow scan of ``seq``.

    At most MAX_SPLITS numbers come to the driver.  Up to MAX_SPLITS * target_rows
    rows an interval between two edges is one bucket.
    """
    steps = [i / MAX_SPLITS for i in range(MAX_SPLITS + 1)]
    c = F.col(seq).cast("long")
    rows, n, points = df.agg(F.count(F.lit(1)), F.count(c), F.percentile_approx(c, steps, _ACCURACY)).first()
    if n <= target_rows:
        return Buckets([], 1, 0 < n < rows)
    every = max(1, MAX_SPLITS * target_rows // n)
    # no edge at either end: what lies outside belongs to the first or last interval
    return Buckets(sorted(set(points[every:-1:every])), max(1, -(-n // (MAX_SPLITS * target_rows))), n < rows)


def _count_up_to(values: list[int], c: Column) -> Column:
    """How many of the sorted values are at most ``c``, by binary search."""
    steps = [1 << k for k in reversed(range(len(values).bit_length()))]
    sorted_values = F.from_json(F.lit(json.dumps(values)), "array<bigint>")
    return F.aggregate(F.array(*[F.lit(w) for w in steps]), F.lit(0),
                       lambda at, w: F.when(F.get(sorted_values, at + w - 1) <= c, at + w).otherwise(at))


def with_bucket(df: DataFrame, name: str, seq: str, bucket_rows: BucketRows = "auto") -> DataFrame:
    """``df`` with the bucket number of its order column, which never falls as the
    order rises; rows without a sequence number share one bucket before all others."""
    c = F.col(seq).cast("long")
    if not isinstance(bucket_rows, str):
        width = F.lit(int(bucket_rows)).cast("long")
        return df.withColumn(name, F.coalesce(F.call_function("div", c - F.pmod(c, width), width), F.lit(_NO_SEQ)))
    if bucket_rows != "auto":
        raise ValueError("bucket_rows must be a positive int or 'auto'")
    return _bucketed(df, name, c, bucket_edges(df, seq))


def _bucketed(df: DataFrame, name: str, c: Column, buckets: Buckets) -> DataFrame:
    edges, parts = buckets.edges, buckets.parts
    at = _count_up_to(edges, c) if edges else F.lit(0)
    bucket = at.cast("long")
    if parts > 1 and edges:
        # even parts of an interval; doubles are monotone in the number, which is all a bucket needs
        x = c.cast("double")
        low, high = (F.from_json(F.lit(json.dumps(v)), "array<double>") for v in ([None, *edges], [*edges, None]))
        share = (x - F.get(low, at)) / (F.get(high, at) - F.get(low, at))
        bucket = bucket * parts + F.greatest(F.lit(0), F.least(F.coalesce(F.floor(share * parts), F.lit(0)), F.lit(parts - 1)))
    return df.withColumn(name, F.when(c.isNull(), F.lit(-1)).otherwise(bucket).cast("long"))


def _ordered(seq: str) -> Column:
    """The order column with rows that have no number before all others (min_by and
    max_by would leave them out)."""
    return F.coalesce(F.col(seq).cast("long"), F.lit(_NO_SEQ))


def _by_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with its key columns in one struct, and that column's name in a list.

    A struct of nulls equals another one, so a plain equi-join on it keeps the
    rows of null keys, and windows, groups and joins share one partitioning.
    """
    if not keys or list(keys) == ["_keys"]:
        return df, list(keys)
    return df.withColumn("_keys", F.struct(*[F.col(k) for k in keys])), ["_keys"]


def prefix_scan(df: DataFrame, value, out, seq: str = "arrival_seq",
                keys: Sequence[str] = (), how: str = "max", inclusive: bool = True,
                bucket_rows: BucketRows = "auto", bucket_col: Optional[str] = None) -> DataFrame:
    """Running max or sum of one or more columns along ``seq`` per ``keys``.

    ``value`` / ``out`` are a column name or parallel lists of names; all of
    them share one window pass, one bucket summary and one join.
    ``bucket_rows`` is "auto" or the width of a bucket in units of ``seq``; with
    unique integer sequence numbers it bounds the rows of one window partition.
    """
    if how not in ("max", "sum"):
        raise ValueError("how must be 'max' or 'sum'")
    values = [value] if isinstance(value, str) else list(value)
    outs = [out] if isinstance(out, str) else list(out)
    given = list(keys)
    df, keys = _by_keys(df, keys)
    agg = F.max if how == "max" else F.sum
    # a caller-provided bucket column is kept, so that consecutive scans share
    # the (keys, bucket) partitioning and the second one needs no exchange
    b = bucket_col or f"_{outs[0]}_bucket"
    frame = (Window.unboundedPreceding, 0 if inclusive else -1)
    w_local = Window.partitionBy(*keys, b).orderBy(seq).rowsBetween(*frame)
    bucketed = df if bucket_col else with_bucket(df, b, seq, bucket_rows)
    local = bucketed.withColumns({f"_{o}_local": agg(v).over(w_local) for v, o in zip(values, outs)})
    # the summary reads only (keys, seq, values): a narrow re-read of the input
    summary = bucketed.groupBy(*keys, b).agg(*[agg(v).alias(f"_{o}_bagg") for v, o in zip(values, outs)])
    w_carry = Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(*keys, b, *[agg(f"_{o}_bagg").over(w_carry).alias(f"_{o}_carry") for o in outs])
    joined = local.join(carry, on=[*keys, b], how="inner")
    results = {}
    for o in outs:
        if how == "max":
            results[o] = F.greatest(f"_{o}_carry", f"_{o}_local")
        else:
            results[o] = F.coalesce(F.col(f"_{o}_carry"), F.lit(0)) + F.coalesce(F.col(f"_{o}_local"), F.lit(0))
    drops = ([] if keys == given else keys) + ([] if bucket_col else [b]) + [f"_{o}_local" for o in outs] + [f"_{o}_carry" for o in outs]
    return joined.withColumns(results).drop(*drops)


def prefix_max(df: DataFrame, value: str, out: str, seq: str = "arrival_seq",
               keys: Sequence[str] = (), inclusive: bool = True,
               bucket_rows: BucketRows = "auto", bucket_col: Optional[str] = None) -> DataFrame:
    """Running max of ``value`` along ``seq`` per ``keys`` (two-level, no global window)."""
    return prefix_scan(df, value, out, seq, keys, "max", inclusive, bucket_rows, bucket_col)


def prefix_sum(df: DataFrame, value: str, out: str, seq: str = "arrival_seq",
               keys: Sequence[str] = (), inclusive: bool = True,
               bucket_rows: BucketRows = "auto") -> DataFrame:
    """Running sum of ``value`` along ``seq`` per ``keys`` (two-level, no global window)."""
    return prefix_scan(df, value, out, seq, keys, "sum", inclusive, bucket_rows)


def previous_value(df: DataFrame, value: str, out: str, seq: str, keys: Sequence[str] = (),
                   bucket_rows: BucketRows = "auto") -> DataFrame:
    """``lag(value)`` along ``seq`` per ``keys`` without an unpartitioned window.

    Inside a bucket it is the plain lag; the first row of a bucket takes the
    last value of the nearest earlier non-empty bucket from the summary.
    """
    df, keys = _by_keys(df, keys)
    b = f"_{out}_bucket"
    w_local = Window.partitionBy(*keys, b).orderBy(seq)
    local = with_bucket(df, b, seq, bucket_rows) \
              .withColumn(f"_{out}_local", F.lag(value).over(w_local)) \
              .withColumn(f"_{out}_first", F.row_number().over(w_local) == 1)
    summary = local.groupBy(*keys, b).agg(F.max_by(value, _ordered(seq)).alias(f"_{out}_last"))
    w_s = Window.partitionBy(*keys).orderBy(b)
    carry = summary.select(*keys, b, F.lag(f"_{out}_last").over(w_s).alias(f"_{out}_carry"))
    return (local.join(carry, on=[*keys, b], how="inner")
                 .withColumn(out, F.when(F.col(f"_{out}_first"), F.col(f"_{out}_carry"))
                             .otherwise(F.col(f"_{out}_local")))
                 .drop(b, f"_{out}_local", f"_{out}_first", f"_{out}_carry", *keys))


def arrival_fragments(df: DataFrame, size: Duration, ts: str = "ts", seq: str = "arrival_seq",
                      keys: Sequence[str] = (), bucket_rows: BucketRows = "auto") -> DataFrame:
    """W1 / ST3: cut the arrival order into runs of the same epoch window.

    A new fragment starts whenever an event's window differs from the window
    of the event before it in arrival order, so a late event closes the open
    window and opens a second fragment of an old one (N2).  Events without a
    time have one window of their own.  Adds ``window_start`` and
    ``fragment_id`` (1, 2, ... in arrival order, per key).
    """
    df, keys = _by_keys(df, keys)
    b = "_fr_bucket"
    ws_us = F.unix_micros(floor_window(ts, size))
    w_local = Window.partitionBy(*keys, b).orderBy(seq)
    local = (with_bucket(df.withColumn("_ws_us", ws_us), b, seq, bucket_rows)
               .withColumn("_prev", F.lag("_ws_us").over(w_local))
               .withColumn("_chg", ((F.row_number().over(w_local) > 1)
                                    & ~F.col("_prev").eqNullSafe(F.col("_ws_us"))).cast("long"))
               .withColumn("_local_cum", F.sum("_chg").over(w_local.rowsBetween(Window.unboundedPreceding, 0))))
    summary = local.groupBy(*keys, b).agg(F.min_by("_ws_us", _ordered(seq)).alias("_first"),
                                          F.max_by("_ws_us", _ordered(seq)).alias("_last"),
                                          F.sum("_chg").alias("_inner"))
    w_s = Window.partitionBy(*keys).orderBy(b)
    carry = (summary
             .withColumn("_before", F.lag(F.struct("_last")).over(w_s))
             .withColumn("_boundary", F.when(F.col("_before").isNotNull()
                                             & F.col("_before._last").eqNullSafe(F.col("_first")), 0).otherwise(1)
                         .cast("long"))
             .withColumn("_upto", F.sum(F.col("_boundary") + F.col("_inner"))
                         .over(w_s.rowsBetween(Window.unboundedPreceding, 0)))
             .select(*keys, b, (F.col("_upto") - F.col("_inner")).alias("_offset")))
    return (local.join(carry, on=[*keys, b], how="inner")
                 .withColumn("fragment_id", F.col("_offset") + F.col("_local_cum"))
                 .withColumn("window_start", F.timestamp_micros("_ws_us"))
                 .drop(b, "_ws_us", "_prev", "_chg", "_local_cum", "_offset", *keys))


# --------------------------------------------------------------------------
# First-event anchored windows and throttle
# --------------------------------------------------------------------------

def fold_segment(t: np.ndarray, size_us: int, start: Optional[int], pm_carry: Optional[int]):
    """Greedy opener chain over one run of a key in arrival order.

    An event opens a window iff its time is at least the open window's start
    + size; older events always join.  Every opener is a strict new running
    max, so with the running max ``pm`` (non-decreasing) the next opener is
    ``searchsorted(pm, start + size)``: the loop runs once per window, not
    once per event.  ``start`` / ``pm_carry`` carry the open window from an
    earlier part of the same run (None: the first row opens).

    Returns (index of each row's opener within the run or -1 for the carried
    window, opens mask, new start, new pm).
    """
    n = len(t)
    opener = np.full(n, -1, dtype=np.int64)
    opens = np.zeros(n, dtype=bool)
    if n == 0:
        return opener, opens, start, pm_carry
    pm = np.maximum.accumulate(t if pm_carry is None else np.maximum(t, pm_carry))
    pos, cur = 0, -1
    if start is None:
        start, cur = int(t[0]), 0
        opens[0] = True
    while True:
        nxt = max(int(np.searchsorted(pm, start + size_us, side="left")), pos)
        end = min(nxt, n)
        opener[pos:end] = cur
        if nxt >= n:
            break
        start, cur, pos = int(t[nxt]), nxt, nxt
        opens[nxt] = True
    return opener, opens, start, int(pm[-1])


def _fold_openers(size_us: int, columns: list[str]):
    """Fold groups streamed batch by batch; rows arrive sorted by (group, seq), the
    first of a group is marked and carries the window that is open when it begins.
    The user's columns pass through as they are."""
    def run(batches):
        start = start_seq = pm_carry = None
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            col = dict(zip(b.schema.names, b.columns))
            t, sq, first_t, first_seq = (col[c].to_numpy() for c in ("_t", "_seq", "_start_t", "_start_seq"))
            new = col["_new"].to_numpy(zero_copy_only=False).astype(bool)
            bounds = sorted({0, n, *np.flatnonzero(new).tolist()})
            win_start, win_seq = np.empty(n, np.int64), np.empty(n, np.int64)
            is_open = np.zeros(n, bool)
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                if new[lo]:
                    start, start_seq, pm_carry = int(first_t[lo]), int(first_seq[lo]), None
                opener, opens, new_start, pm_carry = fold_segment(t[lo:hi], size_us, start, pm_carry)
                carried = opener < 0
                win_start[lo:hi] = np.where(carried, start, t[lo:hi][np.maximum(opener, 0)])
                win_seq[lo:hi] = np.where(carried, start_seq, sq[lo:hi][np.maximum(opener, 0)])
                is_open[lo:hi] = opens
                start, start_seq = new_start, int(win_seq[hi - 1])
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(len(columns))), pa.array(win_start), pa.array(win_seq), pa.array(is_open)],
                [*columns, "window_start_us", "window_seq", "opens_window"])
    return run


def bucket_exits(t: np.ndarray, size_us: int, before: int) -> tuple[np.ndarray, np.ndarray]:
    """What one bucket does to the open window, whatever its start.

    ``t`` are the strictly rising running maxima of the bucket, ``before`` the
    running max ahead of them.  Returns (entries, exits), positions in ``t``: an
    open window that ends after entry i - 1 and not after entry i leaves the
    bucket as the window opened at exit i; one that ends after the last entry
    leaves it unchanged.  A window open at ``before`` ends at ``before + size``
    at the latest, so the entries lie within one ``size``.
    """
    n = len(t)
    here = np.arange(n)
    last = np.searchsorted(t, t + size_us, side="left")
    last = np.where(last < n, last, here)       # an opener without successor points at itself
    while True:                                 # pointer doubling
        further = last[last]
        if np.array_equal(further, last):
            break
        last = further
    entries = here[:int(np.searchsorted(t, before + size_us, side="left")) + 1]
    exits = last[:len(entries)]
    keep = np.append(exits[1:] != exits[:-1], True)[:len(entries)]   # of entries with one exit the last one will do
    return entries[keep], exits[keep]


def _exit_steps(size_us: int, place: list[str]):
    """Steps of groups streamed batch by batch; rows arrive sorted by (group, seq), the
    first of a group is marked.  A worker holds the rows of one group and one batch."""
    def steps(held: list[pa.RecordBatch]):
        table = pa.Table.from_batches(held).combine_chunks()
        if not table.num_rows:
            return
        t, sq, ahead = (table[c].to_numpy() for c in ("_t", "_seq", "_pm_before"))
        starts = np.flatnonzero(table["_new"].to_numpy())
        bounds = [*starts.tolist(), len(t)]
        found = [bucket_exits(t[lo:hi], size_us, int(ahead[lo])) for lo, hi in zip(bounds, bounds[1:])]
        entries = np.concatenate([e + lo for (e, _), lo in zip(found, bounds)])
        exits = np.concatenate([x + lo for (_, x), lo in zip(found, bounds)])
        sizes = [len(e) for e, _ in found]
        before = np.repeat(ahead[starts], sizes)
        ends = t[entries]
        low = np.append(before[:1], ends[:-1])
        firsts = (np.cumsum(sizes) - sizes)[np.array(sizes) > 0]
        low[firsts] = before[firsts]
        rows = table.select(place).take(pa.array(np.repeat(starts, sizes)))
        for name, values in (("_lo", low), ("_hi", ends), ("_exit_t", t[exits]), ("_exit_seq", sq[exits]), ("_before", before)):
            rows = rows.append_column(name, pa.array(values.astype(np.int64)))
        yield from rows.to_batches()

    def run(batches):
        held: list[pa.RecordBatch] = []
        for b in batches:
            new = np.flatnonzero(b.column("_new").to_numpy(zero_copy_only=False))
            if len(new):
                yield from steps([*held, b.slice(0, new[-1])])
                held = [b.slice(new[-1])]
            else:
                held.append(b)
        if held:
            yield from steps(held)
    return run


def compose(tables: DataFrame, size_us: int, by: list[str]) -> DataFrame:
    """Tables of pairs of neighbouring nodes, composed to the table of their parent.

    A table's rows are steps: an open window whose end lies in (lo, hi] leaves the
    node as the window opened at exit; one that ends after the last hi leaves it
    unchanged.  The left node's exits are looked up in the right node's steps (the
    first hi at or after the exit's end), in one sorted pass over the two tables.
    Of the right node's own steps those stay that a window passing through the
    left node unchanged can reach; neighbouring steps with one exit become one.
    """
    pair = [*by, "_piece", "_node"]
    side = F.pmod("_node", F.lit(2))
    up = tables.withColumn("_side", side).withColumn("_node", F.shiftright("_node", 1))
    left = F.col("_side") == 0
    up = up.withColumn("_key", F.when(left, F.col("_exit_t") + F.lit(size_us)).otherwise(F.col("_hi")))
    falling = Window.partitionBy(*pair).orderBy(F.col("_key").desc(), F.col("_side").desc()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*pair)
    found = up.withColumns({
        "_next": F.last(F.when(~left, F.struct("_exit_t", "_exit_seq")), ignorenulls=True).over(falling),
        "_left_before": F.max(F.when(left, F.col("_before"))).over(whole)})
    out = found.filter(left | F.col("_left_before").isNull() | (F.col("_lo") < F.col("_left_before") + F.lit(size_us)))
    passed = F.when(left & F.col("_next").isNotNull(), F.col("_next")).otherwise(F.struct("_exit_t", "_exit_seq"))
    rising = Window.partitionBy(*pair).orderBy("_hi")
    out = out.select(*pair, "_hi", passed.alias("_exit"), F.coalesce("_left_before", "_before").alias("_before"))
    # of neighbouring steps with one exit the last one will do
    out = out.withColumn("_after", F.lead("_exit._exit_t").over(rising)).filter(~F.col("_exit._exit_t").eqNullSafe(F.col("_after")))
    return out.select(*pair, F.coalesce(F.lag("_hi").over(rising), "_before").alias("_lo"), "_hi", "_exit.*", "_before")


def _open_at_buckets(rest: DataFrame, size_us: int, by: list[str]) -> Optional[DataFrame]:
    """(keys, piece, bucket) -> start of the window open when the bucket begins, for
    every piece that crosses a bucket edge (one row per piece and bucket).

    Buckets are the leaves of a binary tree for each piece.  Going up, the tables
    of two neighbours are composed to their parent's; going down, the window that
    is open at a node is the one its left child begins with, and its right child
    begins with what the left child's table makes of it.  A task holds the tables
    of two nodes at most, and the number of rounds is the logarithm of the largest
    number of buckets in a piece.
    """
    place = [*by, "_piece", "_node"]
    crossing = rest.filter(F.col("_piece_bucket") < F.col("_aw_bucket"))
    # places of the buckets that hold rows of a piece, in order
    used = rest.select(*by, "_piece", "_piece_t", "_aw_bucket").join(
        crossing.select(*by, "_piece").distinct(), [*by, "_piece"], "left_semi").distinct()
    used = used.withColumn("_node", (F.row_number().over(Window.partitionBy(*by, "_piece").orderBy("_aw_bucket")) - 1).cast("long"))
    used = kept_table(used, "anchored-buckets")
    most = used.agg(F.max("_node")).first()[0]
    if most is None:
        return None
    # openers rise above all earlier times; the running max ahead of a bucket's first such row is the bucket's
    rising = rest.filter(F.col("_t") > F.col("_pm_before")).select(*by, "_piece", "_aw_bucket", "_seq", "_t", "_pm_before")
    records = rising.join(used.drop("_piece_t"), [*by, "_piece", "_aw_bucket"])
    fields = [records.schema[c] for c in place]
    names = ("_lo", "_hi", "_exit_t", "_exit_seq", "_before")
    marked = records.select(*place, "_seq", "_t", "_pm_before",
                            (F.row_number().over(Window.partitionBy(*place).orderBy("_seq")) == 1).alias("_new"))
    table = marked.mapInArrow(_exit_steps(size_us, place), T.StructType(
        fields + [T.StructField(c, T.LongType()) for c in names]))
    tables = [kept_table(table, "anchored-steps")]
    for _ in range(int(most).bit_length() - 1):
        tables.append(kept_table(compose(tables[-1], size_us, by), "anchored-steps"))
    # down: the root begins with the piece's own first window
    states = used.filter("_node = 0").select(*by, "_piece", F.lit(0).cast("long").alias("_node"), F.col("_piece_t").alias("_open_t"),
                                             F.col("_piece").alias("_open_seq"))
    for level in reversed(range(int(most).bit_length())):
        there = used.select(*by, "_piece", F.shiftright("_node", level).alias("_node")).distinct()
        below = states.withColumn("_node", F.shiftleft("_node", 1)).join(tables[level], place, "left")
        ended = F.when(F.col("_hi") >= F.col("_open_t") + F.lit(size_us), F.col("_hi"))
        moved = below.groupBy(*place).agg(
            F.first("_open_t").alias("_open_t"), F.first("_open_seq").alias("_open_seq"),
            F.min_by(F.struct("_exit_t", "_exit_seq"), ended).alias("_to"))
        children = F.array(
            F.struct(F.col("_node"), F.col("_open_t"), F.col("_open_seq")),
            F.struct((F.col("_node") + 1).alias("_node"), F.coalesce("_to._exit_t", "_open_t").alias("_open_t"),
                     F.coalesce("_to._exit_seq", "_open_seq").alias("_open_seq")))
        states = moved.select(*by, "_piece", F.inline(children)).join(there, place, "left_semi")
    states = kept_table(states, "anchored-states")
    return states.join(used, place).select(*by, "_piece", "_aw_bucket", "_open_t", "_open_seq")


def _kept(df: DataFrame, label: str) -> DataFrame:
    """A kept table, or the frame itself where it has types that Parquet does not hold."""
    return df if re.search(r"\b(void|interval)\b", df.schema.simpleString()) else kept_table(df, label)


def anchored_windows(df: DataFrame, size: Duration, keys: Sequence[str] = (),
                     ts: str = "ts", seq: str = "arrival_seq",
                     bucket_rows: BucketRows = "auto",
                     num_partitions: Optional[int] = None) -> DataFrame:
    """ST2: tumbling windows anchored at the first event, in arrival order.

    An event joins the open window while ``t < start + size`` (older events
    always join); otherwise it opens the next window at its own time.

    Plan: (1) a two-level running max of the time marks *guaranteed openers*
    (``t >= max of all earlier times + size``), which cut each key into
    independent pieces; rows before the running max reaches the piece's start +
    size are its first window, settled without Python.  (2) The rest is folded
    by (keys, piece, bucket).  Where a piece crosses bucket edges, each bucket is
    first resolved for every window that can be open at its edge (openers lie on
    the strictly rising running maxima, so the next opener is a function of the
    open start); these tables are composed in pairs up a tree and evaluated down
    it, in Spark joins: no task holds more rows than a bucket or two tables,
    however long a key goes without a pause.  The running max, the pieces and
    the tables are computed once and lie in the shared checkpoint folder; data of
    one bucket needs none.
    Adds ``window_start_us``, ``window_seq`` (opener's sequence number) and
    ``opens_window``.

    The fold is opaque to Catalyst, so the input columns of the rest cross into
    Python (as Arrow, unchanged): select the columns you need first.
    """
    prepare_session(df.sparkSession)
    keys = list(keys)
    size_us = duration_us(size)
    base, by = _by_keys(df, keys)
    auto = bucket_rows == "auto"
    buckets = bucket_edges(df, seq) if auto else None
    base = (_bucketed(base, "_aw_bucket", F.col(seq).cast("long"), buckets) if auto
            else with_bucket(base, "_aw_bucket", seq, bucket_rows))
    # an event without a time joins the open window, or opens one before all others
    base = base.withColumn("_t", F.coalesce(F.unix_micros(F.col(ts)), F.lit(-(1 << 62)))) \
        .withColumn("_seq", _ordered(seq))
    single = auto and buckets.single
    with_pm = prefix_max(base, "_t", "_pm_before", seq=seq, keys=by, inclusive=False,
                         bucket_col="_aw_bucket")
    if not single:      # read several times below
        with_pm = _kept(with_pm, "anchored-running")
    cut = F.col("_pm_before").isNull() | (F.col("_t") >= F.col("_pm_before") + F.lit(size_us))
    # along the cuts sequence, time and bucket all rise, so a running max gives the last cut's
    marked = with_pm.withColumns({"_cut_seq": F.when(cut, F.col("_seq")), "_cut_t": F.when(cut, F.col("_t")),
                                  "_cut_bucket": F.when(cut, F.col("_aw_bucket"))})
    pieces = prefix_scan(marked, ["_cut_seq", "_cut_t", "_cut_bucket"], ["_piece", "_piece_t", "_piece_bucket"],
                         seq=seq, keys=by, how="max", bucket_col="_aw_bucket")
    if not single:
        pieces = _kept(pieces, "anchored-pieces")
    first = F.greatest("_pm_before", "_t") < F.col("_piece_t") + F.lit(size_us)
    settled = pieces.filter(first).select(
        *df.columns, F.col("_piece_t").alias("window_start_us"), F.col("_piece").alias("window_seq"),
        F.col("_cut_seq").isNotNull().alias("opens_window"))

    rest = pieces.filter(~first)
    place = [*by, "_piece", "_aw_bucket"]
    shuffled = rest.repartition(*([num_partitions] if num_partitions else []), *[F.col(c) for c in place])
    opened = None if single else _open_at_buckets(rest, size_us, by)
    start_t, start_seq = F.col("_piece_t"), F.col("_piece")
    if opened is not None:
        shuffled = shuffled.join(opened, place, "left")
        start_t, start_seq = F.coalesce("_open_t", start_t), F.coalesce("_open_seq", start_seq)
    ordered = shuffled.select(
        *df.columns, "_t", "_seq", start_t.alias("_start_t"), start_seq.alias("_start_seq"),
        (F.row_number().over(Window.partitionBy(*place).orderBy(seq)) == 1).alias("_new"))
    out_schema = T.StructType([*df.schema.fields, T.StructField("window_start_us", T.LongType()),
                               T.StructField("window_seq", T.LongType()), T.StructField("opens_window", T.BooleanType())])
    folded = ordered.mapInArrow(_fold_openers(size_us, df.columns), out_schema)
    return settled.unionByName(folded).withColumn("window_seq", F.nullif("window_seq", F.lit(_NO_SEQ)))


def throttle(df: DataFrame, min_gap: Duration = "100 milliseconds", key: str = "source",
             ts: str = "ts", seq: str = "arrival_seq",
             bucket_rows: BucketRows = "auto") -> DataFrame:
    """ST6: per key, keep an event only if at least ``min_gap`` has passed since
    the last *kept* one (the anchored window's openers)."""
    marked = anchored_windows(df, min_gap, keys=[key], ts=ts, seq=seq, bucket_rows=bucket_rows)
    return marked.filter(F.col("opens_window")).drop("window_start_us", "window_seq", "opens_window")
