"""Per-window, per-source aggregates.

Recipe: a first ``groupBy(window, source, label)`` with sums and counts
(partial + final hash aggregate, so the shuffle moves one row per group and
map task), then a second ``groupBy(window, source)`` over that small result
to assemble the per-source record.  The map of label counts is bounded by the
number of distinct labels, never by the number of events.
"""

from __future__ import annotations

from typing import Callable, Mapping, Optional, Sequence, Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrose.functions.scalar import (Duration, floor_window, strict_true,
                                       window_end)
from windrose.session import kept_table
from windrose.sources.schema import AGGREGATION_NAME, SENSOR_METRIC, SOURCES, UNKNOWN_LABEL


def label_of(source: str = "source", level: str = "level", action: str = "action") -> Column:
    """Count label: level for log, action for feed (``UNKNOWN`` when missing), null for sensor."""
    s = F.col(source)
    return (F.when(s == "log", F.coalesce(F.col(level), F.lit(UNKNOWN_LABEL)))
            .when(s == "feed", F.coalesce(F.col(action), F.lit(UNKNOWN_LABEL))))


def restrict_time(df: DataFrame, ts: str = "ts", time_range: Optional[tuple] = None) -> DataFrame:
    """Window-range pushdown: a ``[lo, hi)`` filter on the event time *before* windowing.

    A filter on ``window.start`` after the aggregate does not reach the scan,
    so callers pass the range here and it becomes a Parquet pushed filter.
    """
    if not time_range:
        return df
    lo, hi = time_range
    if lo is not None:
        df = df.filter(F.col(ts) >= F.lit(lo).cast("timestamp"))
    if hi is not None:
        df = df.filter(F.col(ts) < F.lit(hi).cast("timestamp"))
    return df


def with_window(df: DataFrame, size: Duration, ts: str = "ts", name: str = "window_start") -> DataFrame:
    return df.withColumn(name, floor_window(ts, size))


def window_partials(df: DataFrame, size: Duration, ts: str = "ts",
                    window_col: Optional[str] = None, keys: Sequence[str] = ()) -> DataFrame:
    """First level of R1: one row per (window, keys, source, label).

    ``window_col`` and ``keys`` name windows that are not aligned to the epoch,
    such as arrival fragments (``fragment_id``) or anchored windows."""
    wcol = F.col(window_col) if window_col else floor_window(ts, size)
    return (df.groupBy(wcol.alias("window_start"), *keys, F.col("source"), label_of().alias("label"))
              .agg(F.sum("value").alias("value_sum"),
                   F.count("value").alias("value_n"),
                   F.count_if(strict_true("success")).alias("ok_n"),
                   F.count(F.lit(1)).alias("n")))


def combine_partials(partials: DataFrame, size: Duration, keys: Sequence[str] = (),
                     window_struct: Optional[str] = None) -> DataFrame:
    """Second level of R1: the per-source window record (A1 to A5).

    ``window_struct`` names a ``struct<start,end>`` window column to group by
    instead of ``window_start`` (streams: the watermarked window of the first
    level must stay the grouping key).
    """
    wkey = window_struct or "window_start"
    g = (partials.groupBy(wkey, "source", *keys)
         .agg(F.sum("value_sum").alias("value_sum"),
              F.sum("value_n").alias("value_n"),
              F.sum("ok_n").alias("ok_n"),
              F.sum("n").alias("count"),
              # sorted by label so the map (and its JSON text) is deterministic
              F.map_from_entries(F.array_sort(F.collect_list(
                  F.when(F.col("label").isNotNull(), F.struct("label", "n"))))).alias("label_counts")))
    src = F.col("source")
    agg_name = F.when(src == "sensor", F.lit(AGGREGATION_NAME["sensor"]))
    for s in ("log", "feed"):
        agg_name = agg_name.when(src == s, F.lit(AGGREGATION_NAME[s]))
    order = F.when(src == SOURCES[0], 0).when(src == SOURCES[1], 1).when(src == SOURCES[2], 2).otherwise(3)
    window = (F.col(window_struct) if window_struct else
              F.struct(F.col("window_start").alias("start"), window_end("window_start", size).alias("end")))
    return g.select(
        window.alias("window"),
        "source", *keys,
        F.col("count"),
        agg_name.alias("aggregation"),
        F.when(src == "sensor", F.lit(SENSOR_METRIC)).alias("metric"),
        F.when(src == "sensor", F.try_divide("value_sum", F.col("value_n").cast("double"))).alias("value"),
        F.when(src != "sensor", F.col("label_counts")).alias("counts"),
        F.when(src == "feed", F.try_divide(F.col("ok_n").cast("double"), F.col("count").cast("double")))
         .alias("success_rate"),
        order.alias("emission_order"))


def window_source_aggregates(df: DataFrame, size: Duration, ts: str = "ts",
                             time_range: Optional[tuple] = None) -> DataFrame:
    """A5: one aggregated record per non-empty (window, source)."""
    return combine_partials(window_partials(restrict_time(df, ts, time_range), size, ts), size)


def keyed_window_aggregates(df: DataFrame, size: Duration, window_col: str, keys: Sequence[str]) -> DataFrame:
    """A1 to A5 for windows that are already assigned: one record per
    (window, keys, source), for arrival fragments and anchored windows."""
    return combine_partials(window_partials(df, size, window_col=window_col, keys=keys), size, keys)


def window_label_counts(df: DataFrame, size: Duration, ts: str = "ts",
                        source: Optional[str] = None) -> DataFrame:
    """Tall form of A2 / A3: (window_start, source, label, n) without a map."""
    rows = df if source is None else df.filter(F.col("source") == source)
    rows = rows.filter(F.col("source") != "sensor")
    return (rows.groupBy(floor_window(ts, size).alias("window_start"), "source",
                         label_of().alias("label"))
                .agg(F.count(F.lit(1)).alias("n")))


def sensor_avg(df: DataFrame, size: Duration, ts: str = "ts") -> DataFrame:
    """A1: mean of the sensor values present (null if none), with N6 counts."""
    return (df.filter(F.col("source") == "sensor")
              .groupBy(floor_window(ts, size).alias("window_start"))
              .agg(F.avg("value").alias("value_avg"),
                   F.count(F.lit(1)).alias("event_count"),
                   F.count("value").alias("value_count")))


def log_levels(df: DataFrame, size: Duration, ts: str = "ts") -> DataFrame:
    """A2: count by level per window, missing level as UNKNOWN."""
    return window_label_counts(df, size, ts, source="log")


def feed_actions(df: DataFrame, size: Duration, ts: str = "ts") -> DataFrame:
    """A3: count by action per window, missing action as UNKNOWN."""
    return window_label_counts(df, size, ts, source="feed")


def feed_success_rate(df: DataFrame, size: Duration, ts: str = "ts") -> DataFrame:
    """A4: strictly-true successes over all feed events of the window."""
    return (df.filter(F.col("source") == "feed")
              .groupBy(floor_window(ts, size).alias("window_start"))
              .agg(F.count(F.lit(1)).alias("event_count"),
                   F.count_if(strict_true("success")).alias("ok_count"))
              .withColumn("success_rate", F.try_divide(F.col("ok_count").cast("double"),
                                                        F.col("event_count").cast("double"))))


def window_envelope(df: DataFrame, size: Optional[Duration] = None, ts: str = "ts",
                    seq: str = "arrival_seq", keys: Sequence[str] = ("source",)) -> DataFrame:
    """Window envelope ``{start, end, count}``.

    With ``size`` the bounds are the epoch window; the first / last event
    times *in sequence order* (not min / max) are kept beside them, which is
    what the envelope defaults to when no bounds are given.
    """
    groups = list(keys)
    if size is not None:
        groups = [floor_window(ts, size).alias("window_start")] + groups
    return (df.groupBy(*groups)
              .agg(F.min_by(ts, seq).alias("first_ts"),
                   F.max_by(ts, seq).alias("last_ts"),
                   F.count(F.lit(1)).alias("event_count")))


def whole_envelope(df: DataFrame, ts: str = "ts", seq: str = "arrival_seq") -> DataFrame:
    """A6 on a whole input: one row; fails the query on empty input, as the reference raises."""
    g = df.agg(F.min_by(ts, seq).alias("first_ts"), F.max_by(ts, seq).alias("last_ts"),
               F.count(F.lit(1)).alias("event_count"))
    return g.select(
        F.when(F.col("event_count") == 0, F.raise_error(F.lit("no event to put into an envelope")))
         .otherwise(F.col("first_ts")).cast("timestamp").alias("start"),
        F.col("last_ts").alias("end"), "event_count")


def source_count_columns(known: Sequence[str] = SOURCES) -> list[Column]:
    """Zero-filled per-source counts (never null)."""
    return [F.count_if(F.col("source") == s).alias(f"n_{s}") for s in known]


def window_source_counts(df: DataFrame, size: Duration, ts: str = "ts") -> DataFrame:
    """Per window, counts of each known source, zero when absent."""
    return (df.groupBy(floor_window(ts, size).alias("window_start"))
              .agg(*source_count_columns(), F.count(F.lit(1)).alias("n_total")))


def window_records(df: DataFrame, size: Optional[Duration] = None, ts: str = "ts",
                   window_col: Optional[str] = None, seq: str = "arrival_seq") -> DataFrame:
    """Window record: total, per-source counts, aggregates emitted (non-empty sources).

    ``window_col`` lets the caller group by another window key, e.g. the
    arrival fragments of ``sequence.arrival_fragments``.  ``span_ms`` is the
    event-time spread of the window and stands in for a duration column.
    """
    wcol = F.col(window_col) if window_col else floor_window(ts, size).alias("window_start")
    g = df.groupBy(wcol).agg(*source_count_columns(), F.count(F.lit(1)).alias("count_total"),
                             F.max(seq).alias("last_seq"),
                             ((F.unix_micros(F.max(ts)) - F.unix_micros(F.min(ts))) / 1000.0)
                             .alias("span_ms"))
    emitted = sum((F.col(f"n_{s}") > 0).cast("int") for s in SOURCES)
    out = g.withColumn("aggregates_emitted", emitted)
    if size is not None and window_col is None:
        out = out.withColumn("window_end", window_end("window_start", size))
    return out


def aggregate_with(df: DataFrame, size: Duration,
                   aggregator: Union[Mapping[str, Column], Callable], ts: str = "ts",
                   keys: Sequence[str] = ("source",), schema: Optional[str] = None) -> DataFrame:
    """User aggregator per (window, keys).

    Preferred form: a mapping of output name -> aggregate ``Column`` (stays in
    the JVM, partial aggregation applies).  Fallback: a pandas function
    ``pdf -> pdf`` run by ``applyInPandas`` per group; it holds one group in
    memory, so it is for bounded groups only (``aggregate_in_steps`` is for others).
    """
    w = floor_window(ts, size).alias("window_start")
    if isinstance(aggregator, Mapping):
        return df.groupBy(w, *keys).agg(*[c.alias(n) for n, c in aggregator.items()])
    if schema is None:
        raise ValueError("a pandas aggregator needs an output schema")
    return df.withColumn("window_start", w).groupBy("window_start", *keys).applyInPandas(aggregator, schema)


def aggregate_in_steps(df: DataFrame, size: Duration, partial: Callable, merge: Callable, schema: str, ts: str = "ts",
                       keys: Sequence[str] = ("source",), rows_per_task: int = 50_000) -> DataFrame:
    """X3 in pandas for groups of any size.

    ``partial`` reduces the rows of one Arrow batch (columns of ``df`` and
    ``window_start``, of any number of groups) to partial rows of ``schema``;
    ``merge`` reduces partial rows, again of any number of groups, to one row per
    (window, keys), and must not mind in which order or how often it is applied.
    Partial rows are merged in arbitrary parts first and then by group, about
    ``rows_per_task`` at a time: no task holds the events of a group.
    """
    by = ["window_start", *keys]

    def reduced(batches):
        for pdf in batches:
            if len(pdf):
                yield partial(pdf)

    rows = kept_table(df.withColumn("window_start", floor_window(ts, size)).mapInPandas(reduced, schema), "steps-partial")

    def merged(table: DataFrame, place: Column) -> DataFrame:
        return table.groupBy(F.pmod(place, F.lit(max(1, -(-table.count() // rows_per_task)))).alias("_part")).applyInPandas(merge, schema)

    once = kept_table(merged(rows, F.xxhash64(*by, F.monotonically_increasing_id())), "steps-merged")
    return merged(once, F.xxhash64(*by))
