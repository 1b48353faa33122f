"""The same questions in SQL over the ``events`` table (DuckDB dialect)."""

from __future__ import annotations

# The log in four shards (r) and with one shard per user (u), the progress
# table (p), measured samples (s) and lease events (l).
_PRELUDE = """
WITH RECURSIVE r AS (
  SELECT 'events' AS stream,
         'shardId-' || lpad(CAST(user_id % 4 AS VARCHAR), 3, '0') AS shard_id,
         lpad(CAST(event_id AS VARCHAR), 20, '0') AS seq,
         CAST(user_id AS VARCHAR) AS partition_key, props AS payload,
         octet_length(encode(props)) AS n, *
  FROM events),
u AS (SELECT * REPLACE (CAST(user_id AS VARCHAR) AS shard_id) FROM r),
p AS (
  SELECT CAST(user_id AS VARCHAR) AS shard_id,
         CASE WHEN user_id % 3 = 0 THEN max(seq)
              ELSE max(seq) FILTER (WHERE event_id < (SELECT max(event_id) / 2.0 FROM events))
         END AS sequence_id,
         nullif(arg_max(event_type, event_id), 'error') AS owner,
         arg_max(value, event_id) > 60 AS closed,
         CASE WHEN user_id % 10 = 0 THEN 'claimant' END AS claim_request
  FROM r GROUP BY user_id),
s AS (
  SELECT shard_id, ts, event_id,
         CASE event_type WHEN 'click' THEN 'lag' WHEN 'purchase' THEN 'fetch'
                         ELSE 'process' END AS metric,
         CAST(CAST(round(value * 1000000) AS BIGINT) // 1000000 AS DOUBLE) AS value
  FROM r WHERE event_type IN ('click', 'purchase', 'view')),
l AS (
  SELECT shard_id, 'worker-' || CAST(user_id % 3 AS VARCHAR) AS worker, ts, event_id,
         CASE event_type WHEN 'signup' THEN 1 WHEN 'error' THEN -1 ELSE 0 END AS delta,
         CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS renewal
  FROM r WHERE event_type IN ('signup', 'error', 'view'))
"""

_STATS = (
    "count(value) AS sample_count, sum(value) AS sum, "
    "max(value) AS maximum, min(value) AS minimum"
)

_SESSIONS = """
, gaps AS (
  SELECT shard_id, ts,
         coalesce(ts - lag(ts) OVER (PARTITION BY shard_id ORDER BY ts)
                  > INTERVAL 30 MINUTE, true) AS opens
  FROM r),
numbered AS (
  SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END)
            OVER (PARTITION BY shard_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS nr
  FROM gaps),
sessions AS (
  SELECT shard_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end,
         count(*) AS n_records
  FROM numbered GROUP BY shard_id, nr)
"""

_REPLAYED = """
, again AS (SELECT u.* FROM u LEFT JOIN p USING (shard_id)
            WHERE sequence_id IS NULL OR seq > sequence_id),
delivered AS (SELECT * FROM u UNION ALL SELECT * FROM again)
"""

_OWNED = "SELECT owner, shard_id FROM p WHERE NOT closed AND owner IS NOT NULL"

_EDGES = (
    "(SELECT unnest(['5', '10', '25', '50', '100', '250', '500', '+Inf']) AS le, "
    "unnest([5.0, 10, 25, 50, 100, 250, 500, 'inf'::DOUBLE]) AS edge)"
)


def _metric(name: str, unit: str, source: str, value: str, dims: str) -> str:
    """One branch of the long metric table."""
    if value:
        columns = (
            f"CAST({value} AS DOUBLE) AS value, CAST(NULL AS DOUBLE) AS sample_count, "
            "CAST(NULL AS DOUBLE) AS sum, CAST(NULL AS DOUBLE) AS maximum, "
            "CAST(NULL AS DOUBLE) AS minimum"
        )
    else:
        columns = (
            "CAST(NULL AS DOUBLE) AS value, CAST(sample_count AS DOUBLE) AS sample_count, "
            "sum, maximum, minimum"
        )
    return (
        f"SELECT '{name}' AS metric, {dims} AS dims, '{unit}' AS unit, ts, {columns} FROM {source}"
    )


_DIMS = "'KinesisStreamName=events,shard=' || shard_id"
_WORKER_DIMS = "'KinesisStreamName=events,WorkerID=' || worker || ',shard=' || shard_id"

# Rows of an hour exist when a record or a sample falls in it; every sample is
# also a record here.
_LONG = (
    """
, hours AS (
  SELECT shard_id, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS ts,
         count(*) AS records, sum(n) AS bytes
  FROM r GROUP BY ALL),
stats AS (
  SELECT shard_id, metric, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS ts,
         count(*) AS c, sum(value) AS t, max(value) AS a, min(value) AS i
  FROM s GROUP BY ALL),
filled AS (
  SELECT h.shard_id, h.ts, m.metric, coalesce(c, 0) AS sample_count, coalesce(t, 0.0) AS sum,
         coalesce(a, 0.0) AS maximum, coalesce(i, 0.0) AS minimum
  FROM hours h CROSS JOIN (SELECT unnest(['lag', 'fetch', 'process']) AS metric) m
  LEFT JOIN stats x ON x.shard_id = h.shard_id AND x.ts = h.ts AND x.metric = m.metric),
lease_hours AS (
  SELECT shard_id, worker, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS ts,
         sum(renewal) AS renewals, sum(delta) AS net
  FROM l GROUP BY ALL),
leases AS (
  SELECT *, sum(net) OVER (PARTITION BY shard_id, worker ORDER BY ts) AS held FROM lease_hours)
"""
    + " UNION ALL ".join(
        [
            _metric("RecordsProcessed", "Count", "hours", "records", _DIMS),
            _metric("DataBytesProcessed", "Byte", "hours", "bytes", _DIMS),
            _metric(
                "MillisBehindLatest", "Milliseconds", "filled WHERE metric = 'lag'", "", _DIMS
            ),
            _metric(
                "KinesisDataFetcher.getRecords.Time",
                "Milliseconds",
                "filled WHERE metric = 'fetch'",
                "",
                _DIMS,
            ),
            _metric(
                "RecordProcessor.processRecords.Time",
                "Milliseconds",
                "filled WHERE metric = 'process'",
                "",
                _DIMS,
            ),
            _metric("RenewLease.Success", "Count", "leases", "renewals", _WORKER_DIMS),
            _metric("CurrentLeases", "Count", "leases", "held", _WORKER_DIMS),
        ]
    )
)


def _text(family: str, source: str, value: str, labels: str = "", part: str = "") -> str:
    return (
        f"SELECT 'shardbrook_{family}{part}{{kinesisStream=\"events\",shard=\"' || shard_id "
        f"|| '\"' {labels} || '}} ' || CAST(CAST({value} AS BIGINT) AS VARCHAR) AS line "
        f"FROM {source}"
    )


def _head(family: str, kind: str, text: str) -> str:
    return (
        f"SELECT '# HELP shardbrook_{family} {text}' AS line "
        f"UNION ALL SELECT '# TYPE shardbrook_{family} {kind}'"
    )


_WORKER = "|| ',workerID=\"' || worker || '\"'"
_LE = "|| ',le=\"' || le || '\"'"
_GET, _PROCESS = (
    "get_records_duration_milliseconds",
    "process_records_duration_milliseconds",
)

_EXPOSITION = (
    f"""
, totals AS (
  SELECT shard_id, count(*) AS records, sum(n) AS bytes,
         (epoch_us((SELECT max(ts) FROM events)) - epoch_us(max(ts))) // 1000 AS lag
  FROM r GROUP BY 1),
held AS (SELECT shard_id, worker, sum(delta) AS leases, sum(renewal) AS renewals
         FROM l GROUP BY 1, 2),
buckets AS (
  SELECT shard_id, metric, le, count(*) FILTER (WHERE value <= edge) AS c
  FROM s CROSS JOIN {_EDGES} WHERE metric <> 'lag' GROUP BY 1, 2, 3),
ends AS (SELECT shard_id, metric, count(*) AS c, sum(value) AS t
         FROM s WHERE metric <> 'lag' GROUP BY 1, 2)
"""
    + " UNION ALL ".join(
        [
            _text("processed_bytes", "totals", "bytes"),
            _text("processed_records", "totals", "records"),
            _text("behind_latest_millis", "totals", "lag"),
            _text("leases_held", "held", "leases", _WORKER),
            _text("lease_renewals", "held", "renewals", _WORKER),
            _text(_GET, "buckets WHERE metric = 'fetch'", "c", _LE, "_bucket"),
            _text(_GET, "ends WHERE metric = 'fetch'", "t", "", "_sum"),
            _text(_GET, "ends WHERE metric = 'fetch'", "c", "", "_count"),
            _text(_PROCESS, "buckets WHERE metric = 'process'", "c", _LE, "_bucket"),
            _text(_PROCESS, "ends WHERE metric = 'process'", "t", "", "_sum"),
            _text(_PROCESS, "ends WHERE metric = 'process'", "c", "", "_count"),
            _head("processed_bytes", "counter", "Bytes of payload handed over"),
            _head("processed_records", "counter", "Records handed over"),
            _head("behind_latest_millis", "gauge", "Milliseconds behind the newest record"),
            _head("leases_held", "gauge", "Leases a worker holds"),
            _head("lease_renewals", "counter", "Leases renewed"),
            _head(_GET, "histogram", "Time to fetch and process a batch"),
            _head(_PROCESS, "histogram", "Time to process a batch"),
        ]
    )
)

_RECORDS = "SELECT stream, shard_id, seq AS sequence_number, partition_key, payload FROM "

_LEASE_HOURS = """
        , hours AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, shard_id, worker,
                           CAST(sum(renewal) AS BIGINT) AS n_renewals, sum(delta) AS net
                    FROM l GROUP BY ALL)
        SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end,
               'events' AS stream, shard_id, worker, n_renewals,
               CAST(sum(net) OVER (PARTITION BY shard_id, worker ORDER BY window_start)
                 AS BIGINT) AS leases_held
        FROM hours"""

_LINEAGE = """
, edges AS (
  SELECT CAST(user_id AS VARCHAR) AS child, CAST(unnest(CASE
           WHEN user_id = 0 OR user_id % 11 = 0 THEN []
           WHEN user_id % 7 = 0 THEN [(user_id - 1) // 2, (user_id - 1) // 3]
           ELSE [(user_id - 1) // 2] END) AS VARCHAR) AS parent
  FROM (SELECT DISTINCT user_id FROM events)),
ways AS (
  SELECT DISTINCT shard_id, shard_id AS above, 0 AS d FROM u
  UNION
  SELECT ways.shard_id, parent, d + 1 FROM ways JOIN edges ON child = above
  WHERE parent IN (SELECT shard_id FROM u))
"""

_BODIES = {
    "records_scan": _RECORDS + "r",
    "shard_catalog": """
        SELECT stream, shard_id, min(seq) AS first_sequence, max(seq) AS last_sequence,
               count(*) AS n_records FROM r GROUP BY 1, 2""",
    "new_shards": """
        SELECT DISTINCT shard_id FROM u WHERE shard_id NOT IN (
          SELECT shard_id FROM u
          WHERE ts < (SELECT date_trunc('day', min(ts)) + INTERVAL 1 DAY FROM events))""",
    "start_trim_horizon": "SELECT shard_id, seq AS sequence_number FROM r",
    "start_latest": """
        SELECT r.shard_id, seq AS sequence_number FROM r LEFT JOIN (
          SELECT shard_id, max(seq) AS tip FROM r
          WHERE event_id < (SELECT max(event_id) / 2.0 FROM events) GROUP BY 1) t
        ON t.shard_id = r.shard_id WHERE tip IS NULL OR seq > tip""",
    "start_after_sequence": """
        SELECT shard_id, seq AS sequence_number FROM r WHERE seq > '00000000000000000500'""",
    "start_after_sequence_stored": """
        SELECT shard_id, seq AS sequence_number FROM r WHERE seq > '00000000000000000500'""",
    "resume_stored_log": """
        SELECT shard_id, seq AS sequence_number FROM u LEFT JOIN p USING (shard_id)
        WHERE sequence_id IS NULL OR seq > sequence_id""",
    "shard_generations": _LINEAGE
    + """
        , longest AS (SELECT shard_id, max(d) AS generation FROM ways GROUP BY 1)
        SELECT shard_id, generation, min(above) AS root_shard_id
        FROM ways JOIN longest USING (shard_id) WHERE d = generation GROUP BY 1, 2""",
    "readable_shards": _LINEAGE
    + """
        , done AS (SELECT p.shard_id, bool_and(closed) AND coalesce(max(seq) <= any_value(
                            sequence_id), false) AS drained FROM p JOIN u USING (shard_id) GROUP BY 1)
        SELECT ways.shard_id, own.drained,
               bool_and(d = 0 OR ancestor.drained) AS readable
        FROM ways JOIN done own ON own.shard_id = ways.shard_id
        JOIN done ancestor ON ancestor.shard_id = above GROUP BY 1, 2""",
    "resume_after_checkpoint": """
        SELECT shard_id, seq AS sequence_number FROM u LEFT JOIN p USING (shard_id)
        WHERE sequence_id IS NULL OR seq > sequence_id""",
    "checkpoint_lookup": """
        SELECT shard_id, coalesce(sequence_id, '') AS sequence_id, owner
        FROM (SELECT DISTINCT shard_id FROM u)
        LEFT JOIN p USING (shard_id)""",
    "checkpoint_latest": "SELECT shard_id, max(seq) AS sequence_id FROM r GROUP BY 1",
    "checkpoint_manual": """
        SELECT shard_id, max(seq) AS sequence_id FROM r
        WHERE event_type = 'purchase' GROUP BY 1""",
    "checkpoint_upsert": """
        , new AS (SELECT shard_id, max(seq) AS seq FROM u GROUP BY 1)
        SELECT shard_id, CASE WHEN writes THEN seq ELSE sequence_id END AS sequence_id, owner,
               CASE WHEN writes THEN false ELSE closed END AS closed, claim_request
        FROM (SELECT *, coalesce(claim_request IS NULL AND owner = 'view', false) AS writes FROM p)
        JOIN new USING (shard_id)""",
    "checkpoint_closing": """
        SELECT shard_id, sequence_id,
               bool_or(closed) AND coalesce(max(seq) <= sequence_id, false) AS closed
        FROM u JOIN p USING (shard_id) GROUP BY 1, 2""",
    "shard_drained": """
        SELECT shard_id, sequence_id,
               NOT EXISTS (SELECT 1 FROM u
                           WHERE u.shard_id = p.shard_id
                             AND seq > coalesce(sequence_id, '')) AS drained
        FROM p WHERE closed""",
    "duplicate_deliveries": _REPLAYED
    + """
        SELECT shard_id, seq AS sequence_number, count(*) AS n_delivered
        FROM delivered GROUP BY 1, 2 HAVING count(*) > 1""",
    "duplicate_runs": _REPLAYED
    + """
        SELECT shard_id, seq AS sequence_number, count(*) AS n_delivered
        FROM delivered GROUP BY 1, 2 HAVING count(*) > 1""",
    "deduplicated_deliveries": _REPLAYED
    + _RECORDS.replace("SELECT", "SELECT DISTINCT")
    + "delivered",
    "records_processed": "SELECT stream, shard_id, count(*) AS n_records FROM r GROUP BY 1, 2",
    "bytes_processed": """
        SELECT stream, shard_id, CAST(sum(n) AS BIGINT) AS n_bytes FROM r GROUP BY 1, 2""",
    "lag_latest": """
        SELECT shard_id, epoch_us((SELECT max(ts) FROM events)) - epoch_us(max(ts)) AS lag_us
        FROM r GROUP BY 1""",
    "lag_gauge": """
        SELECT shard_id, max(ts) AS ts, arg_max(value, ts) AS value
        FROM s WHERE metric = 'lag' GROUP BY 1""",
    "shard_summary": """
        SELECT stream, shard_id, count(*) AS n_records, CAST(sum(n) AS BIGINT) AS n_bytes,
               max(ts) AS last_arrival,
               epoch_us((SELECT max(ts) FROM events)) - epoch_us(max(ts)) AS lag_us
        FROM r GROUP BY 1, 2""",
    "lag_stats": f"""
        SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, shard_id, {_STATS}
        FROM s WHERE metric = 'lag' GROUP BY 1, 2""",
    "duration_stats": f"""
        SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, shard_id, metric, {_STATS}
        FROM s WHERE metric <> 'lag' GROUP BY 1, 2, 3""",
    "duration_histogram": f"""
        SELECT shard_id, metric, le, count(*) FILTER (WHERE value <= edge) AS cum_count,
               count(*) AS sample_count, sum(value) AS sample_sum
        FROM s CROSS JOIN {_EDGES} WHERE metric <> 'lag' GROUP BY 1, 2, 3""",
    "running_gauge": """
        SELECT shard_id, worker, event_id,
               CAST(sum(delta) OVER (PARTITION BY shard_id, worker ORDER BY ts, event_id
                 ROWS UNBOUNDED PRECEDING) AS BIGINT) AS leases_held
        FROM l WHERE delta <> 0""",
    "event_counter": """
        SELECT shard_id, worker, CAST(sum(renewal) AS BIGINT) AS n_events FROM l GROUP BY 1, 2""",
    "untimed_records": """
        SELECT stream, shard_id, count(*) FILTER (WHERE user_id % 50 = 0) AS n_untimed,
               count(*) AS n_records FROM r GROUP BY 1, 2""",
    "metrics_windowed": """
        SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS window_start,
               time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE AS window_end,
               stream, shard_id, count(*) AS n_records, CAST(sum(n) AS BIGINT) AS n_bytes
        FROM r GROUP BY ALL""",
    "metrics_hourly": """
        SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
               time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
               stream, shard_id, count(*) AS n_records, CAST(sum(n) AS BIGINT) AS n_bytes
        FROM r GROUP BY ALL""",
    "leases_windowed": _LEASE_HOURS,
    "stats_with_empty": """
        , w AS (SELECT shard_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS ws, count(*) AS n,
                       sum(floor(value)) AS t, max(floor(value)) AS a, min(floor(value)) AS i
                FROM u WHERE event_type = 'purchase' GROUP BY 1, 2),
        ends AS (SELECT min(ws) AS f, max(ws) + INTERVAL 1 DAY AS l FROM w),
        following AS (SELECT w.*, coalesce(lag(ws + INTERVAL 1 DAY) OVER (
                               PARTITION BY shard_id ORDER BY ws), f) AS prev FROM w, ends),
        till AS (SELECT shard_id, max(ws) + INTERVAL 1 DAY AS til FROM w GROUP BY 1)
        SELECT shard_id, ws AS window_start, ws + INTERVAL 1 DAY AS window_end,
               n AS sample_count, t AS sum, a AS maximum, i AS minimum FROM w
        UNION ALL SELECT shard_id, prev, ws, 0, 0.0, 0.0, 0.0 FROM following WHERE prev < ws
        UNION ALL SELECT shard_id, coalesce(til, f), l, 0, 0.0, 0.0, 0.0
        FROM (SELECT DISTINCT shard_id FROM u) LEFT JOIN till USING (shard_id), ends
        WHERE coalesce(til, f) < l""",
    "metrics_long": _LONG,
    "metrics_text": _EXPOSITION,
    "metrics_stored": _LONG,
    "metrics_text_stored": _EXPOSITION,
    "metrics_pushed": f"""
        SELECT metric, dims, unit, CASE WHEN metric = 'CurrentLeases'
                 THEN arg_max(value, ts) ELSE sum(value) END AS value,
               sum(sample_count) AS sample_count, sum(sum) AS sum,
               coalesce(max(maximum) FILTER (WHERE sample_count > 0), max(maximum)) AS maximum,
               coalesce(min(minimum) FILTER (WHERE sample_count > 0), min(minimum)) AS minimum
        FROM ({_PRELUDE} {_LONG}) GROUP BY metric, dims, unit""",
    "log_roundtrip": _RECORDS + "r",
    "active_owners": f"""
        SELECT owner, shard_id, count(*) OVER (PARTITION BY owner) AS n_shards
        FROM ({_OWNED})""",
    "owner_shard_lists": f"""
        , owned AS ({_OWNED}),
        numbered AS (SELECT *, (row_number() OVER (PARTITION BY owner
                                  ORDER BY md5('events/' || shard_id), shard_id) - 1) // 5 AS page FROM owned)
        SELECT owner, page, string_agg(shard_id, ',' ORDER BY shard_id) AS shards,
               count(*) AS n_shards FROM numbered GROUP BY 1, 2""",
    "invalid_progress": """
        SELECT count(*) FILTER (WHERE owner IS NULL OR shard_id IS NULL) AS n_invalid,
               count(*) AS n_rows FROM p WHERE NOT closed""",
    "owner_skew": f"""
        , loads AS (SELECT owner, count(*) AS n_shards FROM ({_OWNED}) GROUP BY 1)
        SELECT owner, n_shards,
               CAST(floor(sum(n_shards) OVER () / count(*) OVER ()) AS BIGINT) AS optimal,
               n_shards > floor(sum(n_shards) OVER () / count(*) OVER ()) AS over
        FROM loads""",
    "owner_skew_by_bytes": f"""
        , sizes AS (SELECT shard_id, sum(n) AS b FROM u GROUP BY 1),
        loads AS (SELECT owner, count(*) AS n_shards, CAST(sum(b) AS BIGINT) AS load
                  FROM ({_OWNED}) JOIN sizes USING (shard_id) GROUP BY 1)
        SELECT owner, n_shards, load,
               CAST(floor(sum(load) OVER () / count(*) OVER ()) AS BIGINT) AS optimal,
               load > floor(sum(load) OVER () / count(*) OVER ()) AS over
        FROM loads""",
    "heaviest_owner": f"""
        SELECT owner, count(*) AS n_shards FROM ({_OWNED})
        GROUP BY 1 ORDER BY n_shards DESC, owner LIMIT 1""",
    "rebalance_plan": f"""
        , owned AS ({_OWNED}),
        loads AS (SELECT owner, count(*) AS n FROM owned GROUP BY 1 UNION ALL SELECT 'idle', 0),
        shares AS (SELECT owner, n, (SELECT sum(n) // count(*) FROM loads) + CASE WHEN row_number()
                     OVER (ORDER BY n DESC, owner) <= (SELECT sum(n) % count(*) FROM loads)
                     THEN 1 ELSE 0 END AS target FROM loads),
        ranked AS (SELECT owner, greatest(n - target, 0) AS gives, greatest(target - n, 0) AS takes,
                     coalesce(sum(greatest(n - target, 0)) OVER (ORDER BY owner
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS given,
                     coalesce(sum(greatest(target - n, 0)) OVER (ORDER BY owner
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken FROM shares),
        moving AS (SELECT owner, shard_id, given + row_number() OVER (
                     PARTITION BY owner ORDER BY md5('events/' || shard_id), shard_id) AS place,
                     gives, given FROM owned JOIN ranked USING (owner))
        SELECT shard_id, moving.owner, ranked.owner AS new_owner FROM moving JOIN ranked
        ON place > taken AND place <= taken + takes WHERE place <= moving.given + moving.gives""",
    "stalled_shards": """
        SELECT shard_id, max(ts) AS last_arrival,
               epoch_us((SELECT max(ts) FROM events)) - epoch_us(max(ts)) AS silent_us
        FROM u GROUP BY 1 HAVING silent_us > 86400000000""",
    "silence_gaps": """
        , pairs AS (SELECT shard_id, ts,
                           lag(ts) OVER (PARTITION BY shard_id ORDER BY ts) AS before FROM r)
        SELECT shard_id, before AS silent_from, ts AS silent_until,
               epoch_us(ts) - epoch_us(before) AS gap_us
        FROM pairs WHERE ts - before > INTERVAL 30 MINUTE""",
    "activity_sessions": _SESSIONS + "SELECT * FROM sessions",
    "handoff_batch": _RECORDS + "r",
    "handoff_progress": """
        SELECT shard_id, max(seq) AS sequence_id, 'reader' AS owner, false AS closed
        FROM r GROUP BY 1""",
    "handoff_resumed": """
        SELECT shard_id, seq AS sequence_number FROM u LEFT JOIN p USING (shard_id)
        WHERE sequence_id IS NULL OR seq > sequence_id""",
    "resume_two_streams": """
        , x AS (SELECT 'east' AS stream, 0 AS part UNION ALL SELECT 'west', 1),
        two AS (SELECT x.stream, u.shard_id, u.seq, u.event_id FROM u JOIN x
                ON u.event_id % 2 = part),
        bounds AS (SELECT shard_id, max(seq) AS tip FROM two WHERE stream = 'east' GROUP BY 1)
        SELECT stream, shard_id, seq AS sequence_number FROM two LEFT JOIN bounds
        USING (shard_id) WHERE stream = 'west' OR seq > tip""",
    "progress_two_writers": """
        SELECT stream, shard_id, max(seq) AS sequence_id,
               CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END AS owner, false AS closed
        FROM u GROUP BY ALL""",
    "handoff_ordered": """
        SELECT shard_id, seq AS sequence_number,
               row_number() OVER (PARTITION BY shard_id ORDER BY seq) AS position,
               n AS n_bytes FROM r""",
    "handoff_live_ordered": """
        SELECT shard_id, seq AS sequence_number,
               row_number() OVER (PARTITION BY shard_id ORDER BY seq) AS position,
               n AS n_bytes, 1 AS n_inits FROM r""",
    "shard_positions": """
        SELECT shard_id, seq AS sequence_number,
               row_number() OVER (PARTITION BY shard_id ORDER BY seq) AS position FROM r""",
    "stream_totals": """
        SELECT shard_id, count(*) AS n_records, CAST(sum(n) AS BIGINT) AS n_bytes
        FROM r GROUP BY 1""",
    "stream_windows": """
        SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, shard_id,
               count(*) AS n_records, CAST(sum(n) AS BIGINT) AS n_bytes
        FROM r GROUP BY 1, 2""",
    "stream_sessions": _SESSIONS + "SELECT * FROM sessions",
    "stream_deduplicated": _RECORDS + "r",
    "handoff_stopped": _RECORDS + "r",
    "handoff_from_latest": """
        SELECT r.shard_id, seq AS sequence_number FROM r LEFT JOIN (
          SELECT shard_id, max(seq) AS tip FROM r
          WHERE event_id < (SELECT max(event_id) / 2.0 FROM events) GROUP BY 1) t
        ON t.shard_id = r.shard_id WHERE tip IS NULL OR seq > tip""",
    "progress_handed_over": """
        , marks AS (SELECT shard_id, max(seq) AS last, user_id % 2 = 0 AS even, user_id % 6 = 0 AS sixth,
                           max(seq) FILTER (WHERE event_id < (SELECT max(event_id) / 2.0 FROM events)) AS half
                    FROM u GROUP BY ALL)
        SELECT shard_id, CASE WHEN even AND NOT sixth AND half IS NOT NULL THEN half ELSE last END AS sequence_id,
               CASE WHEN even AND half IS NOT NULL THEN 'after' ELSE 'before' END AS owner
        FROM marks""",
    "handoff_times": """
        SELECT stream, shard_id, metric, true AS timed,
               CASE WHEN metric = 'lag' THEN CAST((epoch_us((SELECT max(ts) FROM events))
                 - epoch_us(max(ts))) // 1000 AS DOUBLE) END AS lag_ms
        FROM r CROSS JOIN (SELECT unnest(['fetch', 'process', 'lag']) AS metric)
        GROUP BY stream, shard_id, metric""",
    "stream_leases": _LEASE_HOURS,
    "stream_stats_with_empty": """
        , d AS (SELECT shard_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS ws,
                       CASE WHEN event_type = 'purchase' THEN floor(value) END AS v FROM u),
        days AS (SELECT shard_id, unnest(generate_series(min(ws), (SELECT max(ws) FROM d),
                                                         INTERVAL 1 DAY)) AS ws
                 FROM d GROUP BY 1)
        SELECT days.ws AS window_start, days.ws + INTERVAL 1 DAY AS window_end, days.shard_id,
               count(v) AS sample_count, coalesce(sum(v), 0.0) AS sum,
               coalesce(max(v), 0.0) AS maximum, coalesce(min(v), 0.0) AS minimum
        FROM days LEFT JOIN d ON d.shard_id = days.shard_id AND d.ws = days.ws GROUP BY ALL""",
    "stream_stalled": """
        , next AS (SELECT shard_id, ts, lead(ts) OVER (PARTITION BY shard_id ORDER BY ts) AS nxt,
                          (SELECT max(ts) FROM u) AS tip FROM u),
        silent AS (SELECT * FROM next WHERE coalesce(nxt, tip) > ts + INTERVAL 1 DAY)
        SELECT 'stalled' AS kind, shard_id, ts AS last_arrival, ts + INTERVAL 1 DAY AS at FROM silent
        UNION ALL SELECT 'back', shard_id, ts, nxt FROM silent WHERE nxt IS NOT NULL""",
    "stream_metrics_long": _LONG,
}

ORACLES = {
    name: body if _PRELUDE in body else f"{_PRELUDE}{body}" for name, body in _BODIES.items()
}
