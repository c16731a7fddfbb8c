"""Operational metrics over the event ledger.

The reference keeps mutable counters and bounded deques; here the ledger is a
table and every metric is a query over it, so nothing lives on the driver.
Percentiles follow the reference's nearest-rank rules exactly (R3): *floor*
index for latencies, *ceil* index for window statistics.
"""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import Mapping, Optional, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrose.functions.scalar import Duration, duration_us, floor_window, guarded_ratio
from windrose.operators.sequence import prefix_sum, previous_value
from windrose.session import kept_table

# Fixed values of the reference's metrics collector.
RATE_HORIZON = "10 seconds"
LATENCY_SAMPLES = 2000
WINDOW_SAMPLES = 200
SNAPSHOT_PERIOD = "2 seconds"
HISTORY_SIZE = 200
PERCENTILES = {"p50": 0.50, "p95": 0.95}


# --------------------------------------------------------------------------
# Admission cap
# --------------------------------------------------------------------------

def admission_cap(df: DataFrame, interval: Duration, merged_cap: int, source_cap: Optional[int] = None,
                  ts: str = "ts", seq: str = "arrival_seq", source: str = "source",
                  drop_on_full: bool = True, tie: str = "event_id") -> DataFrame:
    """Per interval keep the first ``merged_cap`` events overall and the first
    ``source_cap`` per source (arrival order); flag the rest.

    ``accepted`` = the merged cap was not hit; ``dropped`` = either cap was hit.
    The order is (``seq``, ``tie``).  ``row_number() <= cap`` filters, which
    Spark plans as a partial WindowGroupLimit before the shuffle (a hot interval
    ships at most ``cap`` rows per map task), give one cutoff per interval and
    per (interval, source): its cap-th smallest place.  Rows are compared with
    the cutoff, so equal sequence numbers cannot multiply rows; rows equal in
    both columns are kept or dropped together.
    """
    out = df.withColumn("bucket_start", floor_window(ts, interval))
    if not drop_on_full:
        return out.withColumn("accepted", F.lit(True)).withColumn("dropped", F.lit(False))
    order = [c for c in (seq, tie) if c in df.columns]
    out = out.withColumn("_place", F.struct(*order))

    def within(left: DataFrame, partition: Sequence[str], cap: int, flag: str) -> DataFrame:
        w = Window.partitionBy(*partition).orderBy("_place")
        cut = (out.select(*partition, "_place").withColumn("_rn", F.row_number().over(w))
                  .filter(F.col("_rn") <= cap).groupBy(*partition)
                  .agg(F.max("_place").alias(f"{flag}_cut"), F.count(F.lit(1)).alias(f"{flag}_n"))
                  .withColumnsRenamed({c: f"{flag}_{c}" for c in partition}))
        # null-safe: events without a time share one interval
        cond = reduce(and_, [left[c].eqNullSafe(cut[f"{flag}_{c}"]) for c in partition])
        return (left.join(cut, cond, "left")
                    .withColumn(flag, (F.col(f"{flag}_n") < cap) | (F.col("_place") <= F.col(f"{flag}_cut")))
                    .withColumn(flag, F.coalesce(flag, F.lit(False)))
                    .drop(f"{flag}_cut", f"{flag}_n", *[f"{flag}_{c}" for c in partition]))

    res = within(out, ["bucket_start"], merged_cap, "accepted")
    if source_cap is not None:
        res = within(res, ["bucket_start", source], source_cap, "_in_source")
    else:
        res = res.withColumn("_in_source", F.lit(True))
    return res.withColumn("dropped", ~F.col("accepted") | ~F.col("_in_source")).drop("_place", "_in_source")


# --------------------------------------------------------------------------
# Totals (A8 to A10, A14, A15)
# --------------------------------------------------------------------------

def ingest_totals(ledger: DataFrame) -> DataFrame:
    """Ingested and dropped, per source and overall (``scope`` = source / total)."""
    return (ledger.rollup("source")
                  .agg(F.count(F.lit(1)).alias("ingested"), F.count_if("dropped").alias("dropped"),
                       F.grouping("source").alias("_g"))
                  .withColumn("scope", F.when(F.col("_g") == 1, "total").otherwise("source"))
                  .drop("_g"))


def processed_rows(ledger: DataFrame) -> DataFrame:
    return ledger.filter(~F.col("dropped"))


def processed_totals(ledger: DataFrame) -> DataFrame:
    """Processed events, per source and overall."""
    return (processed_rows(ledger).rollup("source")
            .agg(F.count(F.lit(1)).alias("processed"), F.grouping("source").alias("_g"))
            .withColumn("scope", F.when(F.col("_g") == 1, "total").otherwise("source"))
            .drop("_g"))


def aggregated_total(aggregates: DataFrame) -> DataFrame:
    """A10: number of aggregated records emitted."""
    return aggregates.agg(F.count(F.lit(1)).alias("aggregated_total"))


def drop_ratios(ledger: DataFrame) -> DataFrame:
    """Drops over ingested (collector) and over processed (dashboard), 0.0 when none."""
    g = ledger.agg(F.count(F.lit(1)).alias("ingested"), F.count_if("dropped").alias("dropped"),
                   F.count_if(~F.col("dropped")).alias("processed"))
    return g.select("ingested", "dropped", "processed",
                    guarded_ratio("dropped", "ingested").alias("drop_ratio_ingested"),
                    guarded_ratio("dropped", "processed").alias("drop_ratio_processed"))


# --------------------------------------------------------------------------
# Recency, nearest rank
# --------------------------------------------------------------------------

def _order_cols(order) -> list:
    return [order] if isinstance(order, str) else list(order)


def most_recent(df: DataFrame, n: int, order="arrival_seq", keys: Sequence[str] = ()) -> DataFrame:
    """The last ``n`` rows by ``order`` (a column or a list, last wins ties) per key.

    Global: ``orderBy(desc).limit(n)`` is a TakeOrderedAndProject (each task
    keeps n rows).  Per key: ``row_number() <= n`` is planned as a partial
    WindowGroupLimit before the shuffle (threshold raised in the session).
    """
    desc = [F.col(c).desc() for c in _order_cols(order)]
    if not keys:
        return df.orderBy(*desc).limit(n)
    w = Window.partitionBy(*keys).orderBy(*desc)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def latest(df: DataFrame, order: str = "arrival_seq", keys: Sequence[str] = ()) -> DataFrame:
    """The latest record (per key) as a struct, null when there is none."""
    cols = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.col(order)).alias("latest"))


def nearest_rank(df: DataFrame, value: str, keys: Sequence[str] = (),
                 quantiles: Mapping[str, float] = PERCENTILES, mode: str = "floor",
                 prefix: str = "") -> DataFrame:
    """Avg and nearest-rank percentiles ``xs[floor|ceil(q * (n - 1))]``.

    Used on bounded inputs only (``most_recent`` first), as the reference
    does: the rank needs one sort per key.  An empty input gives all-null stats.
    """
    return nearest_rank_many(df, {prefix: (value, mode)}, keys, quantiles)


def nearest_rank_many(df: DataFrame, specs: Mapping[str, tuple], keys: Sequence[str] = (),
                      quantiles: Mapping[str, float] = PERCENTILES, extra: Sequence[Column] = ()) -> DataFrame:
    """R3 for several columns at once: ``specs`` maps an output prefix to
    (value column, "floor" | "ceil").  One rank window per column, one aggregate."""
    ranked = df
    aggs = list(extra)
    for i, (prefix, (value, mode)) in enumerate(specs.items()):
        rnd = F.floor if mode == "floor" else F.ceil
        present = F.col(value).isNotNull()
        w = Window.partitionBy(*keys).orderBy(F.col(value).asc_nulls_last())
        rn, n = f"_rn{i}", f"_n{i}"
        ranked = (ranked.withColumn(rn, F.row_number().over(w) - 1)
                        .withColumn(n, F.count(value).over(Window.partitionBy(*keys))))
        aggs.append(F.avg(value).alias(f"{prefix}avg"))
        for name, q in quantiles.items():
            idx = rnd(F.lit(float(q)) * (F.col(n) - 1).cast("double"))
            aggs.append(F.max(F.when(present & (F.col(rn) == idx), F.col(value))).alias(f"{prefix}{name}"))
    if keys:
        return ranked.groupBy(*keys).agg(*aggs)
    return ranked.agg(*aggs)


# Samples are kept in processing order: by processing time, then arrival.
PROCESSING_ORDER = ("processed_at", "arrival_seq")


def latency_stats(ledger: DataFrame, keys: Sequence[str] = (), max_samples: int = LATENCY_SAMPLES,
                  order=PROCESSING_ORDER) -> DataFrame:
    """Avg / p50 / p95 (floor rank) of the last ``max_samples`` processed latencies."""
    recent = most_recent(processed_rows(ledger).select(*keys, *_order_cols(order), "latency_ms"),
                         max_samples, order, keys)
    return nearest_rank(recent, "latency_ms", keys, mode="floor", prefix="latency_")


def window_summary(records: DataFrame, order: str = "window_start", max_windows: int = WINDOW_SAMPLES,
                   count_col: str = "count_total", duration_col: str = "span_ms") -> DataFrame:
    """Over the last ``max_windows`` window records: avg / p50 / p95 (ceil
    rank) of the window size and of a duration column, mean aggregates
    emitted, and the last window.  One bounded sort per statistic, one aggregate."""
    recent = most_recent(records, max_windows, order)
    return nearest_rank_many(
        recent, {"count_": (count_col, "ceil"), "duration_": (duration_col, "ceil")},
        extra=[F.count(F.lit(1)).alias("windows"),
               F.avg("aggregates_emitted").alias("aggregates_emitted_avg"),
               F.max_by(F.struct(*records.columns), F.col(order)).alias("last_window")])


# --------------------------------------------------------------------------
# Rates (W2, R4)
# --------------------------------------------------------------------------

def trailing_rate(df: DataFrame, ts: str = "ts", horizon: Duration = RATE_HORIZON,
                  keys: Sequence[str] = ("source",), span: Optional[Duration] = None,
                  out: str = "rate_eps", bucket_rows="auto") -> DataFrame:
    """Per event, events of the same key in ``[t - horizon, t]`` / horizon seconds.

    The count is a difference of two ranks: events up to ``t`` less events before
    ``t - horizon``.  Events are counted per (key, microsecond) first; both edges
    of every counted instant are places in one order (the old edge comes before
    the events of its instant), so one two-level prefix sum gives both ranks.  A
    window partition is a bucket of that order, bounded in rows however many
    events a key has within the horizon.  Events without a time have no rate.

    Where a key is known to have few events in a time ``span``, naming that span
    gives a cheaper plan: one range frame per (key, span).
    """
    if span is not None:
        return _trailing_rate_by_span(df, ts, horizon, list(keys), span, out)
    h = duration_us(horizon)
    keyed = df.withColumns({"_rate_key": F.struct(*[F.col(k) for k in keys]), "_t": F.unix_micros(F.col(ts))})
    counted = keyed.filter(F.col("_t").isNotNull()).groupBy("_rate_key", "_t").agg(F.count(F.lit(1)).alias("_n"))
    edges = F.array(F.struct((F.col("_t") * 2 + 1).alias("_place"), F.col("_n"), F.lit(True).alias("_new")),
                    F.struct(((F.col("_t") - h) * 2).alias("_place"), F.lit(0).cast("long").alias("_n"), F.lit(False).alias("_new")))
    marks = counted.select("_rate_key", "_t", F.inline(edges))
    ranked = prefix_sum(marks, "_n", "_rank", seq="_place", keys=["_rate_key"], bucket_rows=bucket_rows)
    rates = (ranked.groupBy("_rate_key", "_t")
             .agg((F.max(F.when(F.col("_new"), F.col("_rank"))) - F.max(F.when(~F.col("_new"), F.col("_rank")))).alias("n_trailing")))
    return (keyed.join(rates, ["_rate_key", "_t"], "left").withColumn(out, F.col("n_trailing") / F.lit(h / 1_000_000))
            .drop("_rate_key", "_t"))


def _trailing_rate_by_span(df: DataFrame, ts: str, horizon: Duration, keys: list[str], span: Duration, out: str) -> DataFrame:
    """Range frames by (keys, time span).  Rows in the last ``horizon`` of a span are
    copied into the next one as context ("halo"), so the frame is exact across span edges."""
    h = duration_us(horizon)
    s = max(duration_us(span), h)
    t = F.unix_micros(F.col(ts))
    own = t - F.pmod(t, F.lit(s))
    home = F.struct((own / F.lit(s)).cast("long").alias("_span"), F.lit(False).alias("_halo"))
    copy = F.struct(((own / F.lit(s)).cast("long") + 1).alias("_span"), F.lit(True).alias("_halo"))
    placed = (df.withColumn("_t", t)
                .withColumn("_p", F.explode(F.when(F.pmod(t, F.lit(s)) >= F.lit(s - h), F.array(home, copy))
                                            .otherwise(F.array(home))))
                .select("*", "_p.*").drop("_p"))
    w = Window.partitionBy(*keys, "_span").orderBy("_t").rangeBetween(-h, 0)
    return (placed.withColumn("n_trailing", F.when(F.col("_t").isNotNull(), F.count(F.lit(1)).over(w)))
            .filter(~F.col("_halo")).withColumn(out, F.col("n_trailing") / F.lit(h / 1_000_000))
            .drop("_t", "_span", "_halo"))


def tick_range(t_us: Column, period_us: int, horizon_us: int) -> tuple[Column, Column]:
    """First and last of the snapshot ticks ``T`` (multiples of the period) with
    ``t <= T <= t + horizon``."""
    p = F.lit(period_us)
    edge = t_us + F.lit(horizon_us)
    return t_us + F.pmod(-t_us, p), edge - F.pmod(edge, p)


def each_tick(first: str, last: str, period_us: int) -> Column:
    """One row per tick from ``first`` to ``last`` (none when a period holds no tick)."""
    return F.explode(F.when(F.col(first) <= F.col(last),
                            F.sequence(F.col(first), F.col(last), F.lit(period_us).cast("long"))))


def rate_ticks(df: DataFrame, ts: str = "ts", period: Duration = SNAPSHOT_PERIOD,
               horizon: Duration = RATE_HORIZON, keys: Sequence[str] = ()) -> DataFrame:
    """R4 / ST7: the rate every meter would report at each snapshot tick.

    Events are counted per range of ticks they belong to (map-side first), then
    each count is exploded into its at most ``horizon / period + 1`` ticks, so
    neither a range join nor a copy of the events is needed.  Ticks where no
    event is within the horizon are absent (rate 0).
    """
    p, h = duration_us(period), duration_us(horizon)
    first, last = tick_range(F.unix_micros(F.col(ts)), p, h)
    counted = (df.select(*keys, first.alias("_first"), last.alias("_last"))
                 .groupBy("_first", "_last", *keys).agg(F.count(F.lit(1)).alias("_n")))
    return (counted.select(*keys, "_n", each_tick("_first", "_last", p).alias("tick_us"))
              .groupBy("tick_us", *keys).agg(F.sum("_n").alias("n"))
              .withColumn("eps", F.col("n") / F.lit(h / 1_000_000)))


def _tick_marks(ledger: DataFrame, aggregates: Optional[DataFrame], period: Duration, horizon: Duration) -> DataFrame:
    """(_kind, _dropped, _first, _last): every event a meter counts and its range of ticks.

    One pass over the ledger: a row marks its receipt and, unless dropped, its processing.
    """
    def mark(t: Column, kind: str, dropped: Column) -> Column:
        return F.struct(t.alias("_t"), F.lit(kind).alias("_kind"), dropped.alias("_dropped"))

    dropped = F.col("dropped")
    marks = ledger.select(F.inline(F.array(
        mark(F.unix_micros("received_at"), "ingest", dropped),
        # no time, no mark: a dropped event is not processed
        mark(F.when(~dropped, F.unix_micros("processed_at")), "process", F.lit(False)))))
    if aggregates is not None:
        marks = marks.unionByName(_aggregate_marks(aggregates))
    return _ranged(marks, period, horizon)


def _aggregate_marks(aggregates: DataFrame) -> DataFrame:
    return aggregates.select(F.unix_micros("window.end").alias("_t"), F.lit("agg").alias("_kind"), F.lit(False).alias("_dropped"))


def _ranged(marks: DataFrame, period: Duration, horizon: Duration) -> DataFrame:
    first, last = tick_range(F.col("_t"), duration_us(period), duration_us(horizon))
    return marks.filter(F.col("_t").isNotNull()).select("_kind", "_dropped", first.alias("_first"), last.alias("_last"))


def latest_kpi(ledger: DataFrame, aggregates: Optional[DataFrame] = None, period: Duration = SNAPSHOT_PERIOD,
               horizon: Duration = RATE_HORIZON) -> DataFrame:
    """Tick and totals of the last snapshot of the series, in one aggregate: it stands at
    the last tick that any event reaches, and every event with a tick has been counted by then."""
    kind = F.col("_kind")
    seen = _tick_marks(ledger, aggregates, period, horizon).filter(F.col("_first") <= F.col("_last"))
    return (seen.agg(F.max("_last").alias("tick_us"), F.count_if(kind == "ingest").alias("ingested_total"),
                     F.count_if((kind == "ingest") & F.col("_dropped")).alias("dropped_total"),
                     F.count_if(kind == "process").alias("processed_total"), F.count_if(kind == "agg").alias("aggregated_total"))
            .filter(F.col("tick_us").isNotNull()))


def kpi_tick_partials(ledger: DataFrame, aggregates: Optional[DataFrame] = None,
                      period: Duration = SNAPSHOT_PERIOD, horizon: Duration = RATE_HORIZON) -> DataFrame:
    """Per tick, the additive counts behind the snapshot series.

    Partials of disjoint slices of the ledger (e.g. micro-batches) add up
    tick by tick, which is what the streaming publisher relies on.
    """
    return _counted_ticks(_tick_marks(ledger, aggregates, period, horizon), period)


def aggregate_tick_partials(aggregates: DataFrame, period: Duration = SNAPSHOT_PERIOD,
                            horizon: Duration = RATE_HORIZON) -> DataFrame:
    """The same counts for aggregated records alone."""
    return _counted_ticks(_ranged(_aggregate_marks(aggregates), period, horizon), period)


def _counted_ticks(marks: DataFrame, period: Duration) -> DataFrame:
    p = duration_us(period)
    kind, dropped = F.col("_kind"), F.col("_dropped")
    # counted per range of ticks first, so that counts are exploded, not events
    counted = (marks.groupBy("_first", "_last").agg(
                   F.count_if(kind == "ingest").alias("ingest_n"), F.count_if(kind == "process").alias("process_n"),
                   F.count_if(kind == "agg").alias("agg_n"),
                   F.count_if((kind == "ingest") & dropped).alias("dropped_n")))
    at_ticks = counted.select("*", each_tick("_first", "_last", p).alias("tick_us"))
    new = lambda n: F.sum(F.when(F.col("tick_us") == F.col("_first"), F.col(n)).otherwise(0))
    return (at_ticks.groupBy("tick_us")
            .agg(*[F.sum(n).alias(n) for n in ("ingest_n", "process_n", "agg_n")],
                 new("ingest_n").alias("new_ingested"), new("dropped_n").alias("new_dropped"),
                 new("process_n").alias("new_processed"), new("agg_n").alias("new_aggregated")))


def kpi_from_partials(per_tick: DataFrame, period: Duration = SNAPSHOT_PERIOD,
                      horizon: Duration = RATE_HORIZON, bucket_ticks: int = 1 << 16) -> DataFrame:
    """Rates, running totals (two-level prefix sums over ticks) and drop ratios."""
    p, h = duration_us(period), duration_us(horizon)
    out = prefix_sum(per_tick, ["new_ingested", "new_dropped", "new_processed", "new_aggregated"],
                     ["ingested_total", "dropped_total", "processed_total", "aggregated_total"],
                     seq="tick_us", bucket_rows=bucket_ticks * p)
    secs = h / 1_000_000
    return out.select(
        "tick_us",
        (F.col("ingest_n") / secs).alias("ingest_eps"),
        (F.col("process_n") / secs).alias("process_eps"),
        (F.col("agg_n") / secs).alias("aggregate_eps"),
        F.col("ingested_total").cast("long").alias("ingested_total"),
        F.col("dropped_total").cast("long").alias("dropped_total"),
        F.col("processed_total").cast("long").alias("processed_total"),
        F.col("aggregated_total").cast("long").alias("aggregated_total"),
        guarded_ratio("dropped_total", "ingested_total").alias("drop_ratio_ingested"),
        guarded_ratio("dropped_total", "processed_total").alias("drop_ratio_processed"))


def kpi_series(ledger: DataFrame, aggregates: Optional[DataFrame] = None,
               period: Duration = SNAPSHOT_PERIOD, horizon: Duration = RATE_HORIZON,
               bucket_ticks: int = 1 << 16) -> DataFrame:
    """ST7 / ST9: the snapshot series at every tick where a meter is non-zero.

    The per-tick table (one row per tick, bounded by span / period) is read by
    both levels of the prefix sums, so it is written once to the shared folder
    (``session.drop_kept_tables`` deletes it).
    """
    per_tick = kept_table(kpi_tick_partials(ledger, aggregates, period, horizon), "kpi-ticks")
    return kpi_from_partials(per_tick, period, horizon, bucket_ticks)


def newest_per_tick(samples: DataFrame, period: Duration = SNAPSHOT_PERIOD, max_samples: int = LATENCY_SAMPLES) -> DataFrame:
    """The newest ``max_samples`` samples up to each tick since the tick before: what a
    slice of the ledger adds to the latencies of any snapshot.  Slices are merged by
    applying it to their union."""
    t = F.unix_micros("processed_at")
    w = Window.partitionBy("_tick").orderBy(*[F.col(c).desc() for c in PROCESSING_ORDER])
    return (samples.select(*PROCESSING_ORDER, "latency_ms", (t + F.pmod(-t, F.lit(duration_us(period)))).alias("_tick"))
            .withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= max_samples).drop("_tick", "_r"))


def dedup_consecutive(df: DataFrame, id_cols: Sequence[str], order: str,
                      keep_last: Optional[int] = HISTORY_SIZE, bucket_rows="auto") -> DataFrame:
    """Drop rows whose id tuple equals the previous row's (null-safe), then
    keep the last ``keep_last`` rows.  The lag is the two-level form (R5)."""
    # both levels of the lag read the rows
    df = kept_table(df, "dedup-rows")
    ident = F.struct(*[F.col(c) for c in id_cols])
    prev = previous_value(df.withColumn("_id", ident), "_id", "_prev_id", seq=order, bucket_rows=bucket_rows)
    kept = prev.filter(F.col("_prev_id").isNull() | ~F.col("_id").eqNullSafe(F.col("_prev_id"))) \
               .drop("_id", "_prev_id")
    return most_recent(kept, keep_last, order) if keep_last else kept


# --------------------------------------------------------------------------
# Per-source processing and the snapshot
# --------------------------------------------------------------------------

def union_sources(a: DataFrame, b: DataFrame, col: str = "source") -> DataFrame:
    """Distinct keys present on either side."""
    return a.select(col).union(b.select(col)).distinct()


def snapshot_time(ledger: DataFrame) -> Column:
    """The instant a batch snapshot is taken: the last processing time (scalar subquery)."""
    return ledger.agg(F.max("processed_at")).scalar()


def _recent_samples(ledger: DataFrame, max_samples: int) -> DataFrame:
    """The last ``max_samples`` processed latencies of every source."""
    return most_recent(processed_rows(ledger).select("source", *PROCESSING_ORDER, "latency_ms"), max_samples,
                       PROCESSING_ORDER, ["source"])


def per_source_processing(ledger: DataFrame, horizon: Duration = RATE_HORIZON,
                          max_samples: int = LATENCY_SAMPLES) -> DataFrame:
    """Ingest totals and processing stats per source over the union of keys.

    Ingest and processing are two sides of one ledger, so one aggregate by source
    holds both (a source without processed events has 0 / 0.0 there and null
    stats); the latencies of the last samples join it.
    """
    per = _by_source(ledger, horizon, _recent_samples(ledger, max_samples))
    return per.drop("recent_ingested", "recent_processed")


def _by_source(ledger: DataFrame, horizon: Duration, samples: DataFrame) -> DataFrame:
    h = duration_us(horizon)
    now_us = F.unix_micros(snapshot_time(ledger))
    within = lambda t: (F.unix_micros(t) >= now_us - h) & (F.unix_micros(t) <= now_us)
    handled = ~F.col("dropped")
    totals = ledger.groupBy("source").agg(
        F.count(F.lit(1)).alias("ingested"), F.count_if("dropped").alias("dropped"),
        F.count_if(handled).alias("processed_total"), F.count_if(within("received_at")).alias("recent_ingested"),
        F.count_if(handled & within("processed_at")).alias("recent_processed"))
    lat = nearest_rank(samples, "latency_ms", ["source"], mode="floor", prefix="latency_").withColumnRenamed("source", "_source")
    return (totals.join(lat, F.col("source").eqNullSafe(F.col("_source")), "left")
            .select("source", "ingested", "dropped", "processed_total",
                    (F.col("recent_processed") / F.lit(h / 1_000_000)).alias("process_eps"),
                    "latency_avg", "latency_p50", "latency_p95", "recent_ingested", "recent_processed"))


def metrics_snapshot(ledger: DataFrame, aggregates: DataFrame, records: DataFrame,
                     horizon: Duration = RATE_HORIZON) -> DataFrame:
    """The whole snapshot as one row.

    The per-source table (one aggregate of the ledger and the last latencies of
    each source) gives the totals and ``by_source``; the overall latencies are
    the last of all sources' last ones, so they come from the same bounded rows.
    Aggregates and window records are one aggregate each, as scalar subqueries
    returning a struct.  ``by_source`` is an array with one struct per source, in
    order of the source (null first): totals, drops and processing;
    ``last_window`` the last window's record.
    """
    h = duration_us(horizon)
    secs = F.lit(h / 1_000_000)
    now_us = F.unix_micros(snapshot_time(ledger))
    samples = _recent_samples(ledger, LATENCY_SAMPLES)
    per = _by_source(ledger, horizon, samples)
    one = F.struct(*[F.col(c) for c in per.columns if not c.startswith("recent_")])
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    totals = per.agg(
        total("ingested").alias("ingested_total"), total("dropped").alias("dropped_total"),
        total("processed_total").alias("processed_total"), (total("recent_ingested") / secs).alias("ingest_eps"),
        (total("recent_processed") / secs).alias("process_eps"), F.sort_array(F.collect_list(one)).alias("by_source"))
    end = F.unix_micros("window.end")
    agg_part = aggregates.agg(
        F.count(F.lit(1)).alias("aggregated_total"),
        (F.count_if((end >= now_us - h) & (end <= now_us)) / secs).alias("aggregate_eps"))
    lat = nearest_rank(most_recent(samples, LATENCY_SAMPLES, PROCESSING_ORDER), "latency_ms", mode="floor", prefix="latency_")
    parts = {"_p0": agg_part, "_p1": lat, "_p2": window_summary(records)}
    with_parts = totals.select("*", *[p.select(F.struct(*p.columns)).scalar().alias(n) for n, p in parts.items()])
    return with_parts.select(
        *totals.columns, *[F.col(f"{n}.{c}").alias(c) for n, p in parts.items() for c in p.columns],
        guarded_ratio("dropped_total", "ingested_total").alias("drop_ratio"),
        guarded_ratio("dropped_total", "processed_total").alias("drop_ratio_processed"))


def kpi_history(ledger: DataFrame, aggregates: Optional[DataFrame] = None, keep_last: int = HISTORY_SIZE,
                max_samples: int = LATENCY_SAMPLES, period: Duration = SNAPSHOT_PERIOD,
                horizon: Duration = RATE_HORIZON) -> DataFrame:
    """ST9 / W4 / A12: the history the KPI charts show: the last ``keep_last``
    snapshots with a changed (ingested, processed, aggregated) triple, each
    with rates, totals, drop ratios *and* the latency avg / p50 / p95 (floor
    rank) over the last ``max_samples`` samples processed by its tick.

    Bounded throughout: every sample is assigned to the first history tick
    at or after its processing time (binary-search-free: a count over the
    <= ``keep_last`` tick array); only the newest ``max_samples`` per tick
    group survive (partial WindowGroupLimit); each survivor is exploded into
    the ticks whose window still holds it, so at most
    ``keep_last * max_samples`` rows reach the rank step.
    """
    return history_with_latency(kpi_series(ledger, aggregates, period, horizon), processed_rows(ledger), keep_last, max_samples)


def history_with_latency(series: DataFrame, samples: DataFrame, keep_last: int = HISTORY_SIZE,
                         max_samples: int = LATENCY_SAMPLES) -> DataFrame:
    """The last ``keep_last`` changed snapshots of a series with the latency statistics
    of the samples (processed_at, arrival_seq, latency_ms) processed by each.

    The samples may be all of them or the newest ``max_samples`` of every tick: older
    ones of a tick count in no statistic.
    """
    triple = ["ingested_total", "processed_total", "aggregated_total"]
    # <= keep_last rows read four times below: written once
    hist = kept_table(dedup_consecutive(series, triple, "tick_us", keep_last=keep_last), "kpi-history")
    # the <= keep_last tick times, and later the per-group sample counts, enter
    # the rows as columns (scalar subqueries cannot sit inside lambdas)
    ticks = hist.agg(F.array_sort(F.collect_list("tick_us")).alias("t")).scalar()
    p_us = F.unix_micros("processed_at")
    samples = (samples
               .select(p_us.alias("_p"), "arrival_seq", "latency_ms", ticks.alias("_ticks"))
               .filter(F.col("_p") <= F.try_element_at("_ticks", F.lit(-1)))
               # most samples predate the history: group 0 without looking at the array
               .withColumn("_g", F.when(F.col("_p") <= F.try_element_at("_ticks", F.lit(1)), F.lit(0))
                           .otherwise(F.size(F.filter("_ticks", lambda x: x < F.col("_p")))))
               .drop("_ticks"))
    w = Window.partitionBy("_g").orderBy(F.col("_p").desc(), F.col("arrival_seq").desc())
    # the filter on the bare rank is planned as a limit before the shuffle
    top = (samples.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= max_samples)
           .withColumn("_r", F.col("_r") - 1))
    # cumulative sample counts per tick group (cum[g] = samples up to group g),
    # built once in a one-row subquery over the <= keep_last group counts
    counts = (samples.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
                     .agg(F.map_from_entries(F.collect_list(F.struct("_g", "_n"))).alias("_m"))
                     .select("_m", F.size(ticks).alias("_h"))
                     .select(F.transform(F.sequence(F.lit(0), F.col("_h") - 1),
                                         lambda g: F.coalesce(F.try_element_at(F.col("_m"), g),
                                                              F.lit(0).cast("bigint"))).alias("_n")))
    cum = counts.select(F.aggregate(
        "_n", F.array().cast("array<bigint>"),
        lambda acc, x: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + x)))
        .alias("_cum")).scalar()
    withc = top.select("latency_ms", "_g", "_r", cum.alias("_cum"))
    base = F.try_element_at(F.col("_cum"), F.col("_g") + 1)
    # ticks j > g whose last max_samples samples still include this one
    later = F.filter(F.slice(F.col("_cum"), F.col("_g") + 2, F.lit(keep_last + 1)),
                     lambda c: c - base + F.col("_r") < max_samples)
    exploded = withc.select("latency_ms", F.explode(F.sequence(F.col("_g"), F.col("_g") + F.size(later)))
                            .alias("_j"))
    stats = nearest_rank(exploded, "latency_ms", keys=["_j"], mode="floor", prefix="latency_")
    indexed = (hist.select("*", ticks.alias("_ticks"))
                   .withColumn("_j", F.size(F.filter("_ticks", lambda x: x < F.col("tick_us"))))
                   .drop("_ticks"))
    return indexed.join(stats, "_j", "left").drop("_j")
