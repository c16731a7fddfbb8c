"""DuckDB SQL oracles, one per named query, over the raw driver views.

Each statement derives the signal view from ``events`` with the same rule
as ``windrose.sources.ingest.signal_events`` (FIXTURES.md §2.1) and is
written independently of the Spark plan.  Times are BIGINT microseconds,
doubles are rounded to 6 places, counts are cast to BIGINT.
"""

from __future__ import annotations

H = 3_600_000_000

SIG = f"""
sig AS (
  SELECT event_id, xor(event_id, 7) AS arrival_seq, user_id, k, epoch_us(ts) AS t_us, ts, source,
         CASE WHEN source = 'sensor' AND value >= 1 THEN value END AS value,
         CASE WHEN source = 'log' AND k % 25 <> 0 THEN
              CASE WHEN k < 40 THEN 'DEBUG' WHEN k < 75 THEN 'INFO' WHEN k < 90 THEN 'WARNING'
                   WHEN k < 98 THEN 'ERROR' ELSE 'CRITICAL' END END AS level,
         CASE WHEN source = 'feed' AND k % 25 <> 0 THEN event_type END AS action,
         CASE WHEN source = 'feed' THEN k >= 10 END AS success,
         epoch_us(ts) - epoch_us(ts) % {H} AS ws
  FROM (SELECT e.*, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
               CASE event_type WHEN 'view' THEN 'sensor' WHEN 'error' THEN 'log' ELSE 'feed' END AS source
        FROM events e) x
)"""

LED = """
led AS (
  SELECT event_id, arrival_seq, source, t_us, k,
         CAST(k * 7.0 + event_id % 13 AS DOUBLE) AS latency_ms,
         t_us + CAST((k * 7.0 + event_id % 13) * 1000 AS BIGINT) AS processed_us,
         COALESCE(k >= 95, false) AS dropped
  FROM sig
)"""

LABEL = ("CASE WHEN source = 'log' THEN COALESCE(level, 'UNKNOWN') "
         "WHEN source = 'feed' THEN COALESCE(action, 'UNKNOWN') END")


def with_sig(body: str, ledger: bool = False) -> str:
    ctes = SIG + ("," + LED if ledger else "")
    return f"WITH {ctes}\n{body}"


ORACLE: dict[str, str] = {}

ORACLE["envelope"] = with_sig("""
SELECT CAST(event_id AS VARCHAR) AS id, source, 'raw' AS event_type, t_us, arrival_seq,
       level AS p_level, value AS p_value, action AS p_action, success AS p_success,
       CASE WHEN source = 'feed' THEN CAST(user_id AS VARCHAR) END AS p_user_id,
       CASE WHEN source = 'sensor' THEN CAST(user_id AS VARCHAR) END AS p_sensor_id,
       CASE WHEN source = 'feed' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
            || CASE WHEN t_us % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END || '+00:00' END AS p_timestamp,
       level AS tag_level, action AS tag_action,
       CASE WHEN source = 'feed' THEN CASE WHEN success THEN 'True' WHEN NOT success THEN 'False' END END
         AS tag_success,
       CASE WHEN source = 'sensor' THEN CAST(user_id AS VARCHAR) END AS tag_sensor_id,
       CAST(CASE source WHEN 'log' THEN (level IS NOT NULL)::INT
                        WHEN 'sensor' THEN (user_id IS NOT NULL)::INT
                        ELSE (action IS NOT NULL)::INT + (success IS NOT NULL)::INT END AS BIGINT) AS n_tags
FROM sig""")

_PLAIN = "event_id % 50 <> 0"


def _field(family: str, expr: str) -> str:
    return f"CASE WHEN source = '{family}' AND {_PLAIN} THEN {expr} END"


_WIRE = {
    "value": _field("sensor", "value"), "level": _field("log", "level"), "action": _field("feed", "action"),
    "success": _field("feed", "success"), "message": _field("log", "'message ' || event_id % 9"),
    "service": _field("log", "'svc-' || event_id % 5"), "host": _field("log", "'host-' || event_id % 3"),
    "sensor_id": _field("sensor", "CAST(user_id AS VARCHAR)"), "metric": _field("sensor", "'metric-' || event_id % 4"),
    "unit": _field("sensor", "'C'"), "location": _field("sensor", "'room ' || event_id % 11"),
    "user_id": _field("feed", "CAST(user_id AS VARCHAR)"), "resource": _field("feed", "'/page/' || event_id % 11"),
    "payload_timestamp": _field("feed", """strftime(ts, '%Y-%m-%dT%H:%M:%S')
            || CASE WHEN t_us % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END || '+00:00'"""),
}
_TEXT = lambda name: f"CASE WHEN {name} THEN 'True' WHEN NOT {name} THEN 'False' END"

ORACLE["wire_envelope"] = with_sig("""
SELECT *, (tag_service IS NOT NULL)::BIGINT + (tag_level IS NOT NULL)::BIGINT + (tag_metric IS NOT NULL)::BIGINT
          + (tag_sensor_id IS NOT NULL)::BIGINT + (tag_action IS NOT NULL)::BIGINT + (tag_success IS NOT NULL)::BIGINT
          + (event_id % 7 = 0 AND k IS NULL)::BIGINT AS n_tags
FROM (SELECT event_id, k, CAST(event_id AS VARCHAR) AS id, 'raw' AS event_type, arrival_seq, source, t_us,
       CASE WHEN event_id % 50 = 0 THEN left(CASE source
            WHEN 'log' THEN CASE WHEN level IS NULL THEN '{"message":"message ' ELSE '{"level":"' || level || '","mess' END
            WHEN 'sensor' THEN '{"sensor_id":"' ELSE '{"user_id":"' || user_id END, 12) END AS broken_text,
       CASE WHEN event_id % 50 <> 0 THEN CAST(event_id % 3 AS INTEGER) END AS shard,
       CASE WHEN event_id % 50 <> 0 THEN k END AS path0,
""" + ",\n".join(f"       {v} AS {c}" for c, v in _WIRE.items()) + f""",
       {_WIRE["service"]} AS tag_service, CASE WHEN event_id % 7 = 0 THEN 'given' ELSE {_WIRE["level"]} END AS tag_level,
       {_WIRE["metric"]} AS tag_metric, {_WIRE["sensor_id"]} AS tag_sensor_id, {_WIRE["action"]} AS tag_action,
       CASE WHEN event_id % 7 = 0 THEN {_TEXT("(k > 50)")} WHEN source = 'feed' AND {_PLAIN} THEN {_TEXT("success")} END AS tag_success
FROM sig)""").replace("SELECT *, (tag", "SELECT * EXCLUDE (event_id, k), (tag")

ORACLE["ledger_times"] = with_sig("""
SELECT event_id, source, t_us AS received_us, CASE WHEN NOT dropped THEN processed_us END AS processed_us,
       CASE WHEN NOT dropped THEN latency_ms END AS latency_ms, dropped OR processed_us IS NULL AS dropped
FROM led""", ledger=True)

ORACLE["merged_counts"] = with_sig("SELECT source, COUNT(*) AS n FROM sig GROUP BY source")

ORACLE["route_source"] = with_sig("SELECT arrival_seq, t_us, level FROM sig WHERE source = 'log'")

ORACLE["demux_counts"] = with_sig("""
SELECT 'event' AS type, COUNT(*) AS n, COUNT(*) AS n_data FROM sig
UNION ALL
SELECT 'agg', COUNT(*), COUNT(*) FROM (SELECT DISTINCT ws, source FROM sig)
UNION ALL
SELECT 'metrics', COUNT(*), COUNT(*) FROM (SELECT DISTINCT ws FROM sig)""")

ORACLE["demux_data"] = with_sig("""
SELECT 'event' AS type, t_us, t_us AS data_us, source, arrival_seq AS n, NULL AS name FROM sig
UNION ALL
SELECT 'agg', ws, ws, source, COUNT(*),
       CASE source WHEN 'sensor' THEN 'avg' WHEN 'log' THEN 'count_by_level' ELSE 'count_by_action' END
FROM sig GROUP BY ws, source""")

ORACLE["aggregated_payload"] = with_sig(f"""
SELECT source, 'aggregated' AS event_type, strftime(make_timestamp(ws), '%Y-%m-%dT%H:%M:%S+00:00') AS start_iso,
       strftime(make_timestamp(ws + {H}), '%Y-%m-%dT%H:%M:%S+00:00') AS end_iso, COUNT(*) AS event_count,
       CASE source WHEN 'sensor' THEN 'avg' WHEN 'log' THEN 'count_by_level' ELSE 'count_by_action' END AS aggregation,
       CASE WHEN source = 'sensor' THEN 'sensor.value' END AS metric,
       CASE WHEN source = 'sensor' THEN ROUND(AVG(value), 6) END AS value,
       CASE WHEN source = 'feed' THEN ROUND(CAST(COUNT(*) FILTER (WHERE success IS TRUE) AS DOUBLE) / COUNT(*), 6) END AS success_rate,
       CASE WHEN source = 'log' THEN COUNT(DISTINCT {LABEL}) ELSE 0 END AS n_levels,
       CASE WHEN source = 'feed' THEN COUNT(DISTINCT {LABEL}) ELSE 0 END AS n_actions,
       NULLIF(COUNT(*) FILTER (WHERE source = 'log' AND level = 'INFO'), 0) AS n_info,
       NULLIF(COUNT(*) FILTER (WHERE source = 'feed' AND action = 'click'), 0) AS n_click
FROM sig GROUP BY ws, source""")

ORACLE["pandas_aggregator"] = with_sig("""
SELECT ws AS window_start_us, source, COUNT(*) AS n, MAX(k)::BIGINT AS top FROM sig GROUP BY ws, source""")

ORACLE["filter_events"] = with_sig(
    "SELECT arrival_seq, t_us, value FROM sig WHERE source = 'sensor' AND value >= 10")

ORACLE["filter_all"] = with_sig("""
SELECT arrival_seq, action, user_id FROM sig
WHERE source = 'feed' AND success IS TRUE AND action <> 'click'""")

ORACLE["map_events"] = with_sig(
    "SELECT arrival_seq, source, ROUND(value * 2, 6) AS value FROM sig WHERE source = 'sensor'")

ORACLE["map_chain"] = with_sig(f"""
SELECT (t_us + 1800000000) - (t_us + 1800000000) % {H} AS window_start_us,
       CASE WHEN source = 'log' THEN 'feed' ELSE source END AS source,
       COUNT(*) AS event_count, ROUND(SUM(COALESCE(value, 0.0) + 1.0), 6) AS value_sum
FROM sig GROUP BY 1, 2""")

ORACLE["map_drop_null"] = with_sig(
    "SELECT arrival_seq, ROUND(value * 10, 6) AS value FROM sig WHERE source = 'sensor' AND value >= 5")

ORACLE["composed_ops"] = with_sig(f"""
SELECT arrival_seq, source, {LABEL} AS label FROM sig
WHERE source IN ('log', 'feed') AND {LABEL} <> 'UNKNOWN'""")

ORACLE["run_pipeline"] = ORACLE["composed_ops"]

ORACLE["safe_float"] = """
SELECT event_id, COALESCE(TRY_CAST(CASE WHEN event_id % 3 = 0 THEN 'n/a'
                                        ELSE json_extract_string(props, '$.k') END AS DOUBLE), 0.0) AS x
FROM events"""

ORACLE["floor_window"] = with_sig(f"""
SELECT arrival_seq, t_us, t_us - t_us % 5000000 AS ws5_us, ws AS ws_hour_us, ws + {H} AS we_hour_us
FROM sig""")

ORACLE["iso_window"] = with_sig(f"""
SELECT arrival_seq,
       strftime(ts, '%Y-%m-%dT%H:%M:%S')
         || CASE WHEN t_us % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END || '+00:00' AS ts_iso,
       strftime(make_timestamp(ws), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS start_iso,
       strftime(make_timestamp(ws + {H}), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS end_iso
FROM sig""")

ORACLE["latency_ms"] = with_sig(
    "SELECT arrival_seq, ROUND((processed_us - t_us) / 1000.0, 6) AS latency_ms FROM led", ledger=True)

# Python's round(x, 3): half-even on the exact binary value, via an error-free product.
# the printed text is rounded from the exact binary value, ties to even
ORACLE["round3"] = with_sig("""
SELECT arrival_seq, CAST(format('{:.3f}', value / 8) AS DOUBLE) AS v3 FROM sig WHERE source = 'sensor'""")

ORACLE["map_sum"] = with_sig("""
SELECT ws AS window_start_us, source, COUNT(*) AS label_total,
       COUNT(DISTINCT CASE WHEN source = 'log' THEN COALESCE(level, 'UNKNOWN')
                           ELSE COALESCE(action, 'UNKNOWN') END) AS n_labels
FROM sig WHERE source <> 'sensor' GROUP BY 1, 2""")

ORACLE["sensor_avg"] = with_sig("""
SELECT ws AS window_start_us, ROUND(AVG(value), 6) AS value_avg, COUNT(*) AS event_count,
       COUNT(value) AS value_count
FROM sig WHERE source = 'sensor' GROUP BY 1""")

ORACLE["log_levels"] = with_sig("""
SELECT ws AS window_start_us, COALESCE(level, 'UNKNOWN') AS label, COUNT(*) AS n
FROM sig WHERE source = 'log' GROUP BY 1, 2""")

ORACLE["feed_actions"] = with_sig("""
SELECT ws AS window_start_us, COALESCE(action, 'UNKNOWN') AS label, COUNT(*) AS n
FROM sig WHERE source = 'feed' GROUP BY 1, 2""")

ORACLE["feed_success_rate"] = with_sig("""
SELECT ws AS window_start_us,
       ROUND(CAST(COUNT(*) FILTER (WHERE success IS TRUE) AS DOUBLE) / COUNT(*), 6) AS success_rate,
       COUNT(*) AS event_count, COUNT(*) FILTER (WHERE success IS TRUE) AS ok_count
FROM sig WHERE source = 'feed' GROUP BY 1""")

ORACLE["window_source_aggregates"] = with_sig(f"""
SELECT ws AS window_start_us, ws + {H} AS window_end_us, source, COUNT(*) AS event_count,
       CASE source WHEN 'sensor' THEN 'avg' WHEN 'log' THEN 'count_by_level' ELSE 'count_by_action' END
         AS aggregation,
       CASE WHEN source = 'sensor' THEN 'sensor.value' END AS metric,
       CASE WHEN source = 'sensor' THEN ROUND(AVG(value), 6) END AS value,
       CASE WHEN source = 'feed'
            THEN ROUND(CAST(COUNT(*) FILTER (WHERE success IS TRUE) AS DOUBLE) / COUNT(*), 6) END
         AS success_rate,
       CASE WHEN source = 'sensor' THEN 0 ELSE COUNT(DISTINCT {LABEL}) END AS n_labels
FROM sig GROUP BY ws, source""")

ORACLE["window_envelope"] = with_sig("""
SELECT ws AS window_start_us, source, arg_min(t_us, arrival_seq) AS first_us,
       arg_max(t_us, arrival_seq) AS last_us, COUNT(*) AS event_count
FROM sig GROUP BY ws, source""")

ORACLE["window_source_counts"] = with_sig("""
SELECT ws AS window_start_us,
       COUNT(*) FILTER (WHERE source = 'sensor') AS n_sensor,
       COUNT(*) FILTER (WHERE source = 'log') AS n_log,
       COUNT(*) FILTER (WHERE source = 'feed') AS n_feed,
       COUNT(*) AS n_total
FROM sig GROUP BY ws""")

ORACLE["window_records"] = with_sig(f"""
SELECT ws AS window_start_us, ws + {H} AS window_end_us, COUNT(*) AS count_total,
       COUNT(*) FILTER (WHERE source = 'sensor') AS n_sensor,
       COUNT(*) FILTER (WHERE source = 'log') AS n_log,
       COUNT(*) FILTER (WHERE source = 'feed') AS n_feed,
       COUNT(DISTINCT source) AS aggregates_emitted
FROM sig GROUP BY ws""")

ORACLE["custom_aggregator"] = with_sig("""
SELECT ws AS window_start_us, source, COUNT(*) AS event_count,
       ROUND(MAX(value) - MIN(value), 6) AS value_range, COUNT(DISTINCT user_id) AS users,
       CAST(SUM(k) AS BIGINT) AS k_sum
FROM sig GROUP BY ws, source""")

# ---------------------------------------------------------------- metrics

PROC_SIG = "(SELECT * FROM sig WHERE NOT COALESCE(k >= 95, false))"

ORACLE["admission_cap"] = with_sig("""
SELECT arrival_seq, source, ws AS bucket_us, rn_all <= 10 AS accepted,
       NOT (rn_all <= 10) OR NOT (rn_src <= 4) AS dropped
FROM (SELECT *, row_number() OVER (PARTITION BY ws ORDER BY arrival_seq) AS rn_all,
             row_number() OVER (PARTITION BY ws, source ORDER BY arrival_seq) AS rn_src FROM sig)""")

ORACLE["ingest_totals"] = with_sig("""
SELECT CASE WHEN GROUPING(source) = 1 THEN 'total' ELSE 'source' END AS scope, source,
       COUNT(*) AS ingested, COUNT(*) FILTER (WHERE dropped) AS dropped
FROM led GROUP BY ROLLUP (source)""", ledger=True)

ORACLE["processed_totals"] = with_sig("""
SELECT CASE WHEN GROUPING(source) = 1 THEN 'total' ELSE 'source' END AS scope, source,
       COUNT(*) AS processed
FROM led WHERE NOT dropped GROUP BY ROLLUP (source)""", ledger=True)

ORACLE["aggregated_total"] = with_sig(f"""
SELECT COUNT(*) AS aggregated_total FROM (SELECT DISTINCT ws, source FROM {PROC_SIG})""")

ORACLE["drop_ratio_ingested"] = with_sig("""
SELECT COUNT(*) AS ingested, COUNT(*) FILTER (WHERE dropped) AS dropped,
       ROUND(COALESCE(CAST(COUNT(*) FILTER (WHERE dropped) AS DOUBLE) / NULLIF(COUNT(*), 0), 0.0), 6)
         AS drop_ratio_ingested
FROM led""", ledger=True)

ORACLE["drop_ratio_processed"] = with_sig("""
SELECT COUNT(*) FILTER (WHERE NOT dropped) AS processed, COUNT(*) FILTER (WHERE dropped) AS dropped,
       ROUND(COALESCE(CAST(COUNT(*) FILTER (WHERE dropped) AS DOUBLE)
                      / NULLIF(COUNT(*) FILTER (WHERE NOT dropped), 0), 0.0), 6) AS drop_ratio_processed
FROM led""", ledger=True)


def _rank_stats(src: str, value: str, mode: str, prefix: str, part: str = "") -> str:
    """Nearest-rank avg / p50 / p95 over ``src`` (floor or ceil index on DOUBLE)."""
    pby = f"PARTITION BY {part} " if part else ""
    sel = f"{part}, " if part else ""
    grp = f" GROUP BY {part}" if part else ""
    return f"""(SELECT {sel}AVG({value}) AS {prefix}avg,
        MAX(CASE WHEN rn = {mode}(0.5::DOUBLE * (n - 1)) THEN {value} END) AS {prefix}p50,
        MAX(CASE WHEN rn = {mode}(0.95::DOUBLE * (n - 1)) THEN {value} END) AS {prefix}p95
      FROM (SELECT {sel}{value}, row_number() OVER ({pby}ORDER BY {value}) - 1 AS rn,
                   COUNT(*) OVER ({pby.strip()}) AS n FROM {src} WHERE {value} IS NOT NULL){grp})"""


PER_SOURCE = f"""
, now AS (SELECT MAX(processed_us) AS now_us FROM led),
ing AS (SELECT source, COUNT(*) AS ingested, COUNT(*) FILTER (WHERE dropped) AS dropped FROM led GROUP BY source),
pr AS (SELECT source, COUNT(*) AS processed_total,
              COUNT(*) FILTER (WHERE processed_us BETWEEN now_us - 10000000 AND now_us) AS recent
       FROM led, now WHERE NOT dropped GROUP BY source),
rec AS (SELECT source, latency_ms FROM
          (SELECT source, latency_ms, row_number() OVER (PARTITION BY source ORDER BY processed_us DESC, arrival_seq DESC) AS rk
           FROM led WHERE NOT dropped) WHERE rk <= 2000),
lat AS {_rank_stats("rec", "latency_ms", "floor", "latency_", part="source")}
, per AS (SELECT COALESCE(ing.source, pr.source) AS source, COALESCE(ingested, 0) AS ingested,
       COALESCE(dropped, 0) AS dropped, COALESCE(processed_total, 0) AS processed_total,
       ROUND(COALESCE(recent / 10.0, 0.0), 6) AS process_eps,
       ROUND(latency_avg, 6) AS latency_avg, ROUND(latency_p50, 6) AS latency_p50,
       ROUND(latency_p95, 6) AS latency_p95
FROM ing FULL OUTER JOIN pr ON ing.source = pr.source
LEFT JOIN lat ON lat.source = COALESCE(ing.source, pr.source))"""

ORACLE["per_source_processing"] = with_sig(PER_SOURCE + "\nSELECT * FROM per", ledger=True)

ORACLE["union_sources"] = with_sig("""
SELECT source FROM led UNION SELECT source FROM led WHERE NOT dropped""", ledger=True)

LAT_RECENT = ("(SELECT latency_ms FROM led WHERE NOT dropped "
              "ORDER BY processed_us DESC, arrival_seq DESC LIMIT 2000)")

ORACLE["latency_stats"] = with_sig(f"""
SELECT ROUND(latency_avg, 6) AS latency_avg, ROUND(latency_p50, 6) AS latency_p50,
       ROUND(latency_p95, 6) AS latency_p95
FROM {_rank_stats(LAT_RECENT, "latency_ms", "floor", "latency_")}""", ledger=True)

RECORDS = f"""(SELECT ws, COUNT(*) AS count_total,
        CAST(MAX(t_us) - MIN(t_us) AS DOUBLE) / 1000.0 AS span_ms,
        (COUNT(*) FILTER (WHERE source = 'sensor') > 0)::INT + (COUNT(*) FILTER (WHERE source = 'log') > 0)::INT
          + (COUNT(*) FILTER (WHERE source = 'feed') > 0)::INT AS aggregates_emitted
      FROM {PROC_SIG} GROUP BY ws ORDER BY ws DESC LIMIT 200)"""

SUMMARY = f"""
, rec AS {RECORDS},
cs AS {_rank_stats("rec", "count_total", "ceil", "count_")},
ds AS {_rank_stats("rec", "span_ms", "ceil", "duration_")},
summ AS (
  SELECT (SELECT COUNT(*) FROM rec) AS windows,
         ROUND((SELECT AVG(aggregates_emitted) FROM rec), 6) AS aggregates_emitted_avg,
         ROUND(count_avg, 6) AS count_avg, count_p50, count_p95,
         ROUND(duration_avg, 6) AS duration_avg, ROUND(duration_p50, 6) AS duration_p50,
         ROUND(duration_p95, 6) AS duration_p95,
         (SELECT MAX(ws) FROM rec) AS last_start_us,
         (SELECT count_total FROM rec ORDER BY ws DESC LIMIT 1) AS last_count_total
  FROM cs, ds)"""

ORACLE["window_summary"] = with_sig(SUMMARY + "\nSELECT * FROM summ")

ORACLE["metrics_snapshot"] = with_sig(SUMMARY + f"""
, now AS (SELECT MAX(processed_us) AS now_us FROM led),
tot AS (SELECT COUNT(*) AS ingested_total, COUNT(*) FILTER (WHERE dropped) AS dropped_total,
               COUNT(*) FILTER (WHERE NOT dropped) AS processed_total,
               COUNT(*) FILTER (WHERE t_us BETWEEN now_us - 10000000 AND now_us) / 10.0 AS ingest_eps,
               COUNT(*) FILTER (WHERE NOT dropped AND processed_us BETWEEN now_us - 10000000 AND now_us) / 10.0
                 AS process_eps
        FROM led, now),
ag AS (SELECT COUNT(*) AS aggregated_total,
              COUNT(*) FILTER (WHERE ws + {H} BETWEEN now_us - 10000000 AND now_us) / 10.0 AS aggregate_eps
       FROM (SELECT DISTINCT ws, source FROM {PROC_SIG}), now),
lat AS {_rank_stats(LAT_RECENT, "latency_ms", "floor", "latency_")}
SELECT ingested_total, dropped_total, processed_total, aggregated_total,
       ROUND(ingest_eps, 6) AS ingest_eps, ROUND(process_eps, 6) AS process_eps,
       ROUND(aggregate_eps, 6) AS aggregate_eps, ROUND(latency_avg, 6) AS latency_avg,
       ROUND(latency_p50, 6) AS latency_p50, ROUND(latency_p95, 6) AS latency_p95,
       windows, aggregates_emitted_avg, count_avg, count_p50, count_p95, duration_avg, duration_p50,
       duration_p95,
       ROUND(COALESCE(CAST(dropped_total AS DOUBLE) / NULLIF(ingested_total, 0), 0.0), 6) AS drop_ratio,
       ROUND(COALESCE(CAST(dropped_total AS DOUBLE) / NULLIF(processed_total, 0), 0.0), 6)
         AS drop_ratio_processed
FROM tot, ag, lat, summ""", ledger=True)

ORACLE["snapshot_sources"] = with_sig(PER_SOURCE + f"""
, last AS (SELECT ws AS last_start_us, ws + {H} AS last_end_us, COUNT(*) AS last_count_total,
                  COUNT(*) FILTER (WHERE source = 'sensor') AS last_n_sensor,
                  COUNT(*) FILTER (WHERE source = 'log') AS last_n_log,
                  COUNT(*) FILTER (WHERE source = 'feed') AS last_n_feed,
                  COUNT(DISTINCT source) AS last_aggregates_emitted
           FROM {PROC_SIG} GROUP BY ws ORDER BY ws DESC LIMIT 1)
SELECT per.*, last.*, (SELECT COUNT(*) FROM led) AS ingested_total,
       (SELECT COUNT(*) FROM led WHERE NOT dropped) AS all_processed
FROM per, last""", ledger=True)

ORACLE["trailing_rate"] = with_sig("""
SELECT arrival_seq, source,
       ROUND(COUNT(*) OVER (PARTITION BY source ORDER BY processed_us
                            RANGE BETWEEN 10000000 PRECEDING AND CURRENT ROW) / 10.0, 6) AS rate_eps
FROM led WHERE NOT dropped""", ledger=True)


def _ticks(t: str) -> str:
    """2 s ticks T with t <= T <= t + 10 s, as a list."""
    return (f"range({t} - {t} % 2000000 + CASE WHEN {t} % 2000000 = 0 THEN 0 ELSE 2000000 END, "
            f"({t} + 10000000) - ({t} + 10000000) % 2000000 + 1, 2000000)")


ORACLE["rate_ticks"] = with_sig(f"""
SELECT tick_us, source, COUNT(*) AS n, ROUND(COUNT(*) / 10.0, 6) AS eps
FROM (SELECT source, unnest({_ticks("t_us")}) AS tick_us FROM led)
GROUP BY tick_us, source""", ledger=True)

KPI = f"""
, marks AS (
  SELECT t_us AS t, 'ingest' AS kind, dropped FROM led
  UNION ALL SELECT processed_us, 'process', false FROM led WHERE NOT dropped
  UNION ALL SELECT ws + {H}, 'agg', false FROM (SELECT DISTINCT ws, source FROM {PROC_SIG})),
ex AS (SELECT kind, dropped, tick_us,
              tick_us = t - t % 2000000 + CASE WHEN t % 2000000 = 0 THEN 0 ELSE 2000000 END AS is_new
       FROM (SELECT kind, dropped, t, unnest({_ticks("t")}) AS tick_us FROM marks)),
per AS (SELECT tick_us,
               COUNT(*) FILTER (WHERE kind = 'ingest') AS ingest_n,
               COUNT(*) FILTER (WHERE kind = 'process') AS process_n,
               COUNT(*) FILTER (WHERE kind = 'agg') AS agg_n,
               COUNT(*) FILTER (WHERE kind = 'ingest' AND is_new) AS new_ing,
               COUNT(*) FILTER (WHERE kind = 'ingest' AND is_new AND dropped) AS new_drop,
               COUNT(*) FILTER (WHERE kind = 'process' AND is_new) AS new_proc,
               COUNT(*) FILTER (WHERE kind = 'agg' AND is_new) AS new_agg
        FROM ex GROUP BY tick_us),
kpi AS (SELECT tick_us, ingest_n / 10.0 AS ingest_eps, process_n / 10.0 AS process_eps,
               agg_n / 10.0 AS aggregate_eps,
               CAST(SUM(new_ing) OVER w AS BIGINT) AS ingested_total,
               CAST(SUM(new_drop) OVER w AS BIGINT) AS dropped_total,
               CAST(SUM(new_proc) OVER w AS BIGINT) AS processed_total,
               CAST(SUM(new_agg) OVER w AS BIGINT) AS aggregated_total
        FROM per WINDOW w AS (ORDER BY tick_us ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

ORACLE["kpi_series"] = with_sig(KPI + """
SELECT tick_us, ROUND(ingest_eps, 6) AS ingest_eps, ROUND(process_eps, 6) AS process_eps,
       ROUND(aggregate_eps, 6) AS aggregate_eps, ingested_total, dropped_total, processed_total,
       aggregated_total,
       ROUND(COALESCE(CAST(dropped_total AS DOUBLE) / NULLIF(ingested_total, 0), 0.0), 6) AS drop_ratio_ingested,
       ROUND(COALESCE(CAST(dropped_total AS DOUBLE) / NULLIF(processed_total, 0), 0.0), 6) AS drop_ratio_processed
FROM kpi""", ledger=True)

ORACLE["recent_latencies"] = with_sig("""
SELECT arrival_seq, source, ROUND(latency_ms, 6) AS latency_ms FROM
  (SELECT *, row_number() OVER (PARTITION BY source ORDER BY processed_us DESC, arrival_seq DESC) AS rk FROM led WHERE NOT dropped)
WHERE rk <= 2000""", ledger=True)

ORACLE["last_n"] = with_sig("SELECT arrival_seq, source, t_us FROM sig ORDER BY arrival_seq DESC LIMIT 25")

ORACLE["latest_snapshot"] = with_sig(KPI + """
SELECT tick_us, ingested_total, processed_total, aggregated_total FROM kpi ORDER BY tick_us DESC LIMIT 1""",
                                     ledger=True)

ORACLE["dedup_consecutive"] = with_sig(KPI + """
SELECT tick_us, ingested_total, processed_total, aggregated_total FROM (
  SELECT *, LAG(struct_pack(ingested_total, processed_total, aggregated_total)) OVER (ORDER BY tick_us) AS prev
  FROM kpi)
WHERE prev IS NULL OR prev IS DISTINCT FROM struct_pack(ingested_total, processed_total, aggregated_total)
ORDER BY tick_us DESC LIMIT 200""", ledger=True)

# ---------------------------------------------------------------- order dependent

ORACLE["arrival_fragments"] = with_sig("""
SELECT fragment_id, ws AS window_start_us, COUNT(*) AS event_count,
       COUNT(*) FILTER (WHERE source = 'sensor') AS n_sensor,
       COUNT(*) FILTER (WHERE source = 'log') AS n_log,
       COUNT(*) FILTER (WHERE source = 'feed') AS n_feed,
       MIN(arrival_seq) AS first_seq, MAX(arrival_seq) AS last_seq
FROM (SELECT *, CAST(SUM(chg) OVER (ORDER BY arrival_seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                     AS BIGINT) AS fragment_id
      FROM (SELECT *, CASE WHEN LAG(ws) OVER (ORDER BY arrival_seq) IS DISTINCT FROM ws THEN 1 ELSE 0 END AS chg
            FROM sig))
GROUP BY fragment_id, ws""")


def _anchored(key: str, size_us: int) -> str:
    """Reference fold as a recursive walk in arrival order per key."""
    return f"""
, ord AS (SELECT {key} AS key, arrival_seq, t_us,
                 row_number() OVER (PARTITION BY {key} ORDER BY arrival_seq) AS rn FROM sig),
walk(key, rn, arrival_seq, t_us, start_us, start_seq) AS (
  SELECT key, rn, arrival_seq, t_us, t_us, arrival_seq FROM ord WHERE rn = 1
  UNION ALL
  SELECT o.key, o.rn, o.arrival_seq, o.t_us,
         CASE WHEN o.t_us < w.start_us + {size_us} THEN w.start_us ELSE o.t_us END,
         CASE WHEN o.t_us < w.start_us + {size_us} THEN w.start_seq ELSE o.arrival_seq END
  FROM walk w JOIN ord o ON o.key IS NOT DISTINCT FROM w.key AND o.rn = w.rn + 1)"""


ORACLE["anchored_windows"] = "WITH RECURSIVE " + SIG + _anchored("user_id", H) + """
SELECT key AS user_id, start_seq AS window_seq, start_us AS window_start_us, COUNT(*) AS event_count,
       MAX(arrival_seq) AS last_seq
FROM walk GROUP BY key, start_seq, start_us"""

ORACLE["throttle"] = "WITH RECURSIVE " + SIG + _anchored("source", 600_000_000) + """
SELECT arrival_seq, key AS source, t_us FROM walk WHERE start_seq = arrival_seq"""

_SPARSE = "CASE WHEN event_id % 5 <> 0 THEN CAST(user_id + 1152921504606846977 AS BIGINT) END"

ORACLE["anchored_null_keys"] = "WITH RECURSIVE " + SIG + _anchored(_SPARSE, H) + """
SELECT CAST(key AS VARCHAR) AS user_key, start_seq AS window_seq, start_us AS window_start_us, COUNT(*) AS event_count,
       MAX(arrival_seq) AS last_seq
FROM walk GROUP BY key, start_seq, start_us"""

ORACLE["throttle_null_keys"] = "WITH RECURSIVE " + SIG + _anchored(_SPARSE, 12 * H) + """
SELECT arrival_seq, CAST(key AS VARCHAR) AS user_key, t_us FROM walk WHERE start_seq = arrival_seq"""

ORACLE["fragments_null_keys"] = with_sig(f"""
SELECT arrival_seq, CAST(user_key AS VARCHAR) AS user_key, window_start_us,
       CAST(SUM(chg) OVER (PARTITION BY user_key ORDER BY arrival_seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS BIGINT) AS fragment_id
FROM (SELECT *, CASE WHEN LAG(window_start_us) OVER (PARTITION BY user_key ORDER BY arrival_seq)
                     IS DISTINCT FROM window_start_us THEN 1 ELSE 0 END AS chg
      FROM (SELECT arrival_seq, {_SPARSE} AS user_key, t_us - t_us % {24 * H} AS window_start_us FROM sig))""")

_RECORD = f"""source, COUNT(*) AS event_count, CASE WHEN source = 'sensor' THEN ROUND(AVG(value), 6) END AS value,
       CASE WHEN source = 'feed'
            THEN ROUND(CAST(COUNT(*) FILTER (WHERE success IS TRUE) AS DOUBLE) / COUNT(*), 6) END AS success_rate,
       CASE WHEN source = 'sensor' THEN 0 ELSE COUNT(DISTINCT {LABEL}) END AS n_labels"""

ORACLE["fragment_aggregates"] = with_sig(f"""
SELECT fragment_id, ws AS window_start_us, {_RECORD}
FROM (SELECT *, CAST(SUM(chg) OVER (ORDER BY arrival_seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                     AS BIGINT) AS fragment_id
      FROM (SELECT *, CASE WHEN LAG(ws) OVER (ORDER BY arrival_seq) IS DISTINCT FROM ws THEN 1 ELSE 0 END AS chg
            FROM sig))
GROUP BY fragment_id, ws, source""")

ORACLE["anchored_aggregates"] = "WITH RECURSIVE " + SIG + _anchored("user_id", H) + f"""
SELECT user_id, start_seq AS window_seq, start_us AS window_start_us, {_RECORD}
FROM (SELECT sig.*, walk.start_seq, walk.start_us FROM sig JOIN walk ON walk.arrival_seq = sig.arrival_seq)
GROUP BY user_id, start_seq, start_us, source"""

# ---------------------------------------------------------------- JSON payloads, Python fallbacks

ORACLE["payload_keys"] = with_sig("""
SELECT arrival_seq, source, value IS NOT NULL AS has_value, level IS NOT NULL AS has_level,
       CAST(CASE source
              WHEN 'sensor' THEN (user_id IS NOT NULL)::INT + (value IS NOT NULL)::INT
              WHEN 'log' THEN (level IS NOT NULL)::INT
              ELSE (user_id IS NOT NULL)::INT + (action IS NOT NULL)::INT + (success IS NOT NULL)::INT
                   + (ts IS NOT NULL)::INT END AS BIGINT) AS n_keys,
       value AS value_back, COALESCE(level, 'UNKNOWN') AS level_or_default
FROM sig""")

ORACLE["python_predicate"] = with_sig(
    "SELECT arrival_seq, value FROM sig WHERE source = 'sensor' AND value >= 10 AND value < 20")

ORACLE["python_mapper"] = with_sig(
    "SELECT arrival_seq, ROUND(value * 3, 6) AS value FROM sig WHERE source = 'sensor'")

ORACLE["kpi_history"] = with_sig(KPI + """
, hist AS (
  SELECT * FROM (
    SELECT *, LAG(struct_pack(ingested_total, processed_total, aggregated_total)) OVER (ORDER BY tick_us) AS prev
    FROM kpi)
  WHERE prev IS NULL OR prev IS DISTINCT FROM struct_pack(ingested_total, processed_total, aggregated_total)
  ORDER BY tick_us DESC LIMIT 200),
win AS (
  SELECT h.tick_us, s.latency_ms
  FROM hist h, LATERAL (SELECT latency_ms FROM led
                        WHERE NOT dropped AND processed_us <= h.tick_us
                        ORDER BY processed_us DESC, arrival_seq DESC LIMIT 2000) s),
lat AS (
  SELECT tick_us, AVG(latency_ms) AS a,
         MAX(CASE WHEN rn = floor(0.5::DOUBLE * (n - 1)) THEN latency_ms END) AS p50,
         MAX(CASE WHEN rn = floor(0.95::DOUBLE * (n - 1)) THEN latency_ms END) AS p95
  FROM (SELECT tick_us, latency_ms, row_number() OVER (PARTITION BY tick_us ORDER BY latency_ms) - 1 AS rn,
               COUNT(*) OVER (PARTITION BY tick_us) AS n FROM win)
  GROUP BY tick_us)
SELECT h.tick_us, ROUND(ingest_eps, 6) AS ingest_eps, ROUND(process_eps, 6) AS process_eps,
       ROUND(aggregate_eps, 6) AS aggregate_eps, ingested_total, dropped_total, processed_total,
       aggregated_total,
       ROUND(COALESCE(CAST(dropped_total AS DOUBLE) / NULLIF(processed_total, 0), 0.0), 6) AS drop_ratio_processed,
       ROUND(a, 6) AS latency_avg, ROUND(p50, 6) AS latency_p50, ROUND(p95, 6) AS latency_p95
FROM hist h LEFT JOIN lat ON lat.tick_us = h.tick_us""", ledger=True)

ORACLE["last_aggregates"] = with_sig("""
SELECT ws AS window_start_us, source, COUNT(*) AS event_count,
       CASE source WHEN 'sensor' THEN 'avg' WHEN 'log' THEN 'count_by_level' ELSE 'count_by_action' END
         AS aggregation
FROM sig GROUP BY ws, source
ORDER BY ws DESC, CASE source WHEN 'sensor' THEN 0 WHEN 'log' THEN 1 ELSE 2 END DESC LIMIT 15""")

ORACLE["table_function"] = with_sig("""
SELECT arrival_seq, tick_us, tick_us - t_us AS age_us
FROM (SELECT arrival_seq, t_us, unnest(generate_series(CAST(ceil(t_us / 2000000.0) AS BIGINT) * 2000000, t_us + 10000000, 2000000)) AS tick_us
      FROM sig WHERE source = 'sensor')""")

ORACLE["partition_function"] = with_sig("""
SELECT user_id, arrival_seq, t_us - before AS gap_us
FROM (SELECT user_id, arrival_seq, t_us, lag(t_us) OVER (PARTITION BY user_id ORDER BY arrival_seq) AS before FROM sig)
WHERE before IS NOT NULL""")
