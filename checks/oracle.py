"""DuckDB statements for the registered queries, written from the definitions:
as-of joins for the boundary lookups, explicit knots for the integrals, explicit
point sets for the gaps."""

from __future__ import annotations

from checks.fixture import rounding
from checks.queries import (
    BASE,
    BOUNDARY,
    GAPS,
    HALFWAY,
    NOW,
    RANGE,
    REF,
    RELAY,
    SLICES,
    WEIGHTED,
)
from tidemark.schemas import AGGREGATE, RECONCILIATION, WIDTHS

SECONDS = WIDTHS

# The fixture's traffic (see checks/fixture.py).
TRAFFIC = """
ev AS (
  SELECT *, 'dev' || (user_id // 30)::VARCHAR AS dev,
         event_type = 'error' AND event_id % 28 = 3 AS malformed,
         CASE event_type WHEN 'purchase' THEN time_bucket(INTERVAL 60 SECOND, ts)
                         WHEN 'view' THEN time_bucket(INTERVAL 30 SECOND, ts)
                         WHEN 'click' THEN ts
                         ELSE time_bucket(INTERVAL 90 SECOND, ts) END AS seen,
         ts + INTERVAL 1500 MILLISECOND AS committed
  FROM events),
parsed AS (
  SELECT *,
    CASE event_type
      WHEN 'click' THEN CASE WHEN event_id % 3 = 0 THEN 'shellies/' || dev || '/relay/0/power' ELSE 'sensors/' || dev || '/power' END
      WHEN 'purchase' THEN CASE WHEN event_id % 3 = 0 THEN 'shellies/' || dev || '/relay/0/energy' ELSE 'sensors/' || dev || '/energy' END
      WHEN 'view' THEN 'shellies/' || dev || CASE WHEN event_id % 10 = 9 THEN '/relay/1' ELSE '/relay/0' END
      ELSE 'sensors/' || dev || '/temperature' END AS topic,
    CASE WHEN event_type = 'view' AND event_id % 10 = 9 THEN NULL ELSE dev END AS device_id,
    CASE WHEN event_type = 'view' AND event_id % 10 = 9 THEN NULL
         WHEN event_type = 'click' THEN 'power' WHEN event_type = 'purchase' THEN 'energy'
         WHEN event_type = 'view' THEN 'relay_state' ELSE 'temperature' END AS metric_name,
    CASE WHEN event_type = 'purchase' THEN (event_id * 10)::DOUBLE
         WHEN event_type IN ('click', 'signup') THEN value END AS numeric_value
  FROM ev),
msgs AS (SELECT * FROM parsed WHERE NOT malformed),
relay AS (
  SELECT seen AS event_at, dev AS device_id, event_id % 2 = 0 AS is_on, committed
  FROM ev WHERE event_type = 'view' AND event_id % 10 <> 9)"""

# Raw text of the same traffic, as the devices sent it.
RAW = """
texts AS (
  SELECT *,
    CASE event_type WHEN 'purchase' THEN (event_id * 10)::VARCHAR
                    WHEN 'view' THEN CASE WHEN event_id % 2 = 0 THEN ' ON ' ELSE 'off' END
                    WHEN 'error' THEN 'n/a' ELSE value::DECIMAL(18,2)::VARCHAR END AS txt,
    '"event_id":"e' || event_id || '","trace_id":"t' || event_id || '","publisher_id":"p1","sequence":"'
      || CASE WHEN malformed THEN 'x' ELSE event_id::VARCHAR END || '","published_at":"'
      || strftime(ts - INTERVAL 250 MILLISECOND, '%Y-%m-%dT%H:%M:%S.%f') || 'Z"' AS trace
  FROM parsed),
raw AS (
  SELECT event_id, malformed, topic, seen AS received_at, committed AS committed_at,
    CASE WHEN event_id % 4 = 1 AND event_type IN ('click', 'purchase', 'signup') THEN '{"value":' || txt || ',' || trace || '}'
         WHEN event_id % 4 = 2 THEN '{"value":"' || txt || '"}' ELSE txt END AS payload,
    '{' || concat_ws(',', CASE WHEN event_type = 'view' THEN '"topic_kind":"status"' END,
                          CASE WHEN event_id % 4 = 3 THEN trace END) || '}' AS metadata
  FROM texts),
decoded AS (
  SELECT *,
    starts_with(payload, '{') AS is_object,
    CASE WHEN starts_with(payload, '{') THEN payload::JSON ->> 'value' ELSE payload END AS value_text,
    CASE WHEN starts_with(payload, '{') THEN payload::JSON END AS body,
    metadata::JSON AS meta,
    string_split(topic, '/') AS seg
  FROM raw),
typed AS (
  SELECT *,
    CASE WHEN len(seg) = 3 AND seg[1] = 'sensors' THEN seg[2]
         WHEN seg[1] = 'shellies' AND seg[3] = 'relay' AND seg[4] = '0' THEN seg[2] END AS device_id,
    CASE WHEN len(seg) = 3 AND seg[1] = 'sensors' THEN seg[3]
         WHEN seg[1] = 'shellies' AND seg[3] = 'relay' AND seg[4] = '0' THEN coalesce(seg[5], 'relay_state') END AS metric_name,
    try_cast(value_text AS DOUBLE) AS numeric_value,
    coalesce(body ->> 'event_id', meta ->> 'event_id') AS event_ref,
    coalesce(body ->> 'trace_id', meta ->> 'trace_id') AS trace_id,
    coalesce(body ->> 'publisher_id', meta ->> 'publisher_id') AS publisher_id,
    coalesce(try_cast(body ->> 'sequence' AS BIGINT), try_cast(meta ->> 'sequence' AS BIGINT)) AS sequence,
    try_strptime(coalesce(body ->> 'published_at', meta ->> 'published_at'), '%Y-%m-%dT%H:%M:%S.%fZ') AS published_at
  FROM decoded)"""


def _sql(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def _round(columns: list[str], schema, report: bool = False) -> str:
    """Rounded output columns; reports round to six decimals of their own."""
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}

    def one(c: str) -> str:
        if kinds[c] == "double":
            digits, nudge = rounding(c)
            shown = f"round({c}, 6)" if report else c
            return f"round({shown} + {nudge}, {digits}) + 0.0 AS {c}"
        if kinds[c] == "array<string>":
            return f"array_to_string({c}, ',') AS {c}"
        return c

    return ", ".join(one(c) for c in columns)


def _bounds(width: str, bounds) -> tuple[str, str]:
    step = f"INTERVAL {SECONDS[width]} SECOND"
    if bounds is None:
        lower = "TIMESTAMP '1970-01-01'"
        upper = f"date_trunc('minute', TIMESTAMP '{REF}') + INTERVAL 1 MINUTE"
    else:
        lower = f"time_bucket({step}, TIMESTAMP '{bounds[0]}')"
        upper = f"time_bucket({step}, TIMESTAMP '{bounds[1]}') + {step}"
    return lower, upper


def _lookups(spine: str, points: str, keys: list[str], tag: str) -> str:
    """As-of joins of a spine (s, e) with the points (t, v) around both ends."""
    on = " AND ".join(f"b.{k} = {{0}}.{k}" for k in keys)
    parts = []
    for alias, test in (
        ("sp", "b.s >= sp.t"),
        ("sn", "b.s <= sn.t"),
        ("ep", "b.e >= ep.t"),
        ("en", "b.e <= en.t"),
    ):
        parts.append(f"ASOF LEFT JOIN {points} {alias} ON {on.format(alias)} AND {test}")
    ends = ", ".join(f"{a}.t AS {a}_t, {a}.v AS {a}_v" for a in ("sp", "sn", "ep", "en"))
    linear = """CASE WHEN {l}_t IS NOT NULL AND {r}_t IS NOT NULL THEN
        CASE WHEN {l}_t = {r}_t THEN {l}_v ELSE {l}_v + ({r}_v - {l}_v)
          * (epoch_us({at}) - epoch_us({l}_t)) / (epoch_us({r}_t) - epoch_us({l}_t)) END END"""
    return f"""
{tag}_near AS (SELECT b.*, {ends} FROM {spine} b {' '.join(parts)}),
{tag} AS (
  SELECT *, sp_v AS locf_s, CASE WHEN en_t IS NOT NULL THEN ep_v END AS locf_e,
    {linear.format(l='sp', r='sn', at='s')} AS lin_s,
    {linear.format(l='ep', r='en', at='e')} AS lin_e
  FROM {tag}_near)"""


def _weights(rows: str, points: str, keys: list[str], tag: str, seconds: int) -> str:
    """Integrals over explicit knots: the start, the points inside, the end."""
    k = ", ".join(f"b.{x}" for x in keys)
    on = " AND ".join(f"b.{x} = p.{x}" for x in keys)
    part = ", ".join([*keys, "s"])
    return f"""
{tag}_in AS (SELECT {k}, b.s, b.e, p.t, p.v FROM {rows} b JOIN {points} p ON {on} AND p.t > b.s AND p.t < b.e),
{tag}_any AS (SELECT DISTINCT {k}, b.s FROM {rows} b JOIN {points} p ON {on} AND p.t >= b.s AND p.t < b.e),
{tag}_held AS (
  SELECT {part}, sum(v * (epoch_us(coalesce(nxt, e)) - epoch_us(t)) / 1e6) / {seconds} AS locf_avg FROM (
    SELECT *, lead(t) OVER (PARTITION BY {part} ORDER BY t) AS nxt FROM (
      SELECT {part}, e, s AS t, locf_s AS v FROM {rows} UNION ALL SELECT * FROM {tag}_in))
  GROUP BY {part}),
{tag}_ramp AS (
  SELECT {part}, sum((v + nv) / 2 * (epoch_us(nxt) - epoch_us(t)) / 1e6) / {seconds} AS linear_avg FROM (
    SELECT *, lead(t) OVER w AS nxt, lead(v) OVER w AS nv FROM (
      SELECT {part}, e, s AS t, lin_s AS v FROM {rows} UNION ALL SELECT * FROM {tag}_in
      UNION ALL SELECT {part}, e, e AS t, lin_e AS v FROM {rows})
    WINDOW w AS (PARTITION BY {part} ORDER BY t))
  GROUP BY {part})"""


def aggregates(width: str, columns: list[str] | None = None, bounds=None, tail: str = "", raw=False) -> str:
    seconds = SECONDS[width]
    step = f"INTERVAL {seconds} SECOND"
    lower, upper = _bounds(width, bounds)
    keys = ["device_id", "metric_name"]
    full = columns or AGGREGATE.fieldNames()
    ctes = f"""{TRAFFIC},
pts AS (
  SELECT device_id, metric_name, seen AS t, arg_min(numeric_value, committed) AS v
  FROM msgs WHERE numeric_value IS NOT NULL AND device_id IS NOT NULL GROUP BY ALL),
base AS (
  SELECT time_bucket({step}, seen) AS s, time_bucket({step}, seen) + {step} AS e,
    min(topic) AS topic, device_id, metric_name, count(*) AS sample_count,
    count(numeric_value) AS numeric_count, avg(numeric_value) AS numeric_avg,
    min(numeric_value) AS numeric_min, max(numeric_value) AS numeric_max,
    quantile_cont(numeric_value, 0.5) AS numeric_median,
    quantile_cont(numeric_value, 0.25) AS numeric_p25,
    quantile_cont(numeric_value, 0.75) AS numeric_p75,
    CASE WHEN count(numeric_value) > 1 THEN var_samp(numeric_value) END AS numeric_variance_samp,
    CASE WHEN count(numeric_value) > 1 THEN stddev_samp(numeric_value) END AS numeric_stddev_samp,
    min(seen) AS first_received_at, max(seen) AS last_received_at
  FROM msgs WHERE device_id IS NOT NULL AND seen >= {lower} AND seen < {upper}
  GROUP BY ALL),
{_lookups("base", "pts", keys, "edged")},
{_weights("edged", "pts", keys, "w", seconds)},
points AS (
  SELECT device_id, metric_name, s, s AS t FROM edged WHERE locf_s IS NOT NULL
  UNION SELECT b.device_id, b.metric_name, b.s, p.t FROM edged b JOIN pts p
    ON b.device_id = p.device_id AND b.metric_name = p.metric_name AND p.t BETWEEN b.s AND b.e
  UNION SELECT device_id, metric_name, s, e FROM edged WHERE locf_e IS NOT NULL),
gaps AS (
  SELECT device_id, metric_name, s, count(gap) AS n, avg(gap) AS mean,
    CASE WHEN count(gap) > 1 THEN stddev_samp(gap) END AS dev FROM (
    SELECT *, (epoch_us(t) - epoch_us(lag(t) OVER (PARTITION BY device_id, metric_name, s ORDER BY t))) / 1e6 AS gap
    FROM points) GROUP BY ALL),
joined AS (
  SELECT b.*, sqrt(b.numeric_count) AS root, h.locf_avg, r.linear_avg, a.s IS NOT NULL AS has_any,
    coalesce(g.n, 0) AS gap_n, g.mean AS gap_mean, g.dev AS gap_dev,
    b.e <= date_trunc('minute', TIMESTAMP '{REF}') AS closed
  FROM edged b
  LEFT JOIN w_held h USING (device_id, metric_name, s)
  LEFT JOIN w_ramp r USING (device_id, metric_name, s)
  LEFT JOIN w_any a USING (device_id, metric_name, s)
  LEFT JOIN gaps g USING (device_id, metric_name, s)),
shaped AS (
  SELECT s AS bucket_start, e AS bucket_end, topic, device_id, metric_name, sample_count, numeric_count,
    numeric_avg, numeric_min, numeric_max, numeric_median, numeric_p25, numeric_p75,
    numeric_variance_samp, numeric_stddev_samp,
    numeric_stddev_samp / root AS numeric_stderr,
    numeric_avg - 1.96 * numeric_stddev_samp / root AS numeric_ci95_lower,
    numeric_avg + 1.96 * numeric_stddev_samp / root AS numeric_ci95_upper,
    first_received_at, last_received_at,
    locf_s AS locf_value_at_bucket_start, locf_e AS locf_value_at_bucket_end,
    CASE WHEN has_any AND sp_t IS NOT NULL AND en_t IS NOT NULL THEN locf_avg END AS locf_time_weighted_avg,
    lin_s AS linear_value_at_bucket_start, lin_e AS linear_value_at_bucket_end,
    CASE WHEN has_any AND sp_t IS NOT NULL AND en_t IS NOT NULL THEN linear_avg END AS linear_time_weighted_avg,
    CASE WHEN closed THEN 'aggregated' ELSE 'tba' END AS status,
    CASE WHEN closed THEN gap_n END AS interval_gap_count,
    CASE WHEN closed THEN gap_mean END AS interval_gap_avg_seconds,
    CASE WHEN closed THEN gap_dev END AS interval_gap_stddev_seconds,
    CASE WHEN closed AND gap_mean > 0 THEN gap_dev / gap_mean END AS interval_gap_cv,
    closed
  FROM joined),
doubted AS (
  SELECT *, (numeric_ci95_upper - numeric_ci95_lower) / greatest(abs(coalesce(numeric_avg, 0)),
      abs(coalesce(numeric_median, 0)), abs(coalesce(numeric_p75 - numeric_p25, 0)),
      abs(coalesce(numeric_max - numeric_min, 0)), 1.0) AS doubt
  FROM shaped),
scored AS (
  SELECT *,
    CASE WHEN closed THEN greatest(0.0, 10.0 - 3.0 * (locf_value_at_bucket_start IS NULL)::INT
      - 3.0 * (linear_value_at_bucket_start IS NULL)::INT - 2.0 * (locf_value_at_bucket_end IS NULL)::INT
      - 2.0 * (linear_value_at_bucket_end IS NULL)::INT)::DOUBLE END AS quality_boundary_score,
    CASE WHEN closed THEN (CASE WHEN numeric_count >= 50 THEN 10 WHEN numeric_count >= 20 THEN 8.5
      WHEN numeric_count >= 10 THEN 7 WHEN numeric_count >= 5 THEN 5 WHEN numeric_count >= 2 THEN 3
      WHEN numeric_count = 1 THEN 1 ELSE 0 END)::DOUBLE END AS quality_count_score,
    CASE WHEN closed THEN (CASE WHEN numeric_count = 0 THEN 0 WHEN numeric_count = 1 OR doubt IS NULL THEN 1
      WHEN doubt <= 0.1 THEN 10 WHEN doubt <= 0.25 THEN 8 WHEN doubt <= 0.5 THEN 6 WHEN doubt <= 1 THEN 4
      ELSE 2 END)::DOUBLE END AS quality_stats_score,
    CASE WHEN closed THEN (CASE WHEN interval_gap_cv IS NULL THEN 1 WHEN interval_gap_cv <= 0.05 THEN 10
      WHEN interval_gap_cv <= 0.1 THEN 9 WHEN interval_gap_cv <= 0.2 THEN 8 WHEN interval_gap_cv <= 0.35 THEN 6
      WHEN interval_gap_cv <= 0.5 THEN 4 ELSE 2 END)::DOUBLE END AS quality_interval_score,
    CASE WHEN closed THEN list_filter([
      CASE WHEN locf_value_at_bucket_start IS NULL THEN 'missing_locf_start' END,
      CASE WHEN linear_value_at_bucket_start IS NULL THEN 'missing_linear_start' END,
      CASE WHEN locf_value_at_bucket_end IS NULL THEN 'missing_locf_end' END,
      CASE WHEN linear_value_at_bucket_end IS NULL THEN 'missing_linear_end' END,
      CASE WHEN numeric_count < 5 THEN 'low_numeric_count' END,
      CASE WHEN numeric_count = 1 THEN 'single_numeric_sample' END,
      CASE WHEN doubt > 0.5 THEN 'high_mean_uncertainty' END,
      CASE WHEN interval_gap_count < 2 THEN 'insufficient_interval_support' END,
      CASE WHEN interval_gap_cv > 0.35 THEN 'irregular_measurement_intervals' END], lambda x: x IS NOT NULL) END AS quality_flags
  FROM doubted),
final AS (
  SELECT *, round((quality_boundary_score + quality_count_score + quality_stats_score
      + quality_interval_score) / 4, 2) AS quality_score,
    CASE WHEN closed THEN 'rated' ELSE 'provisional' END AS quality_status,
    TIMESTAMP '{REF}' AS refreshed_at
  FROM scored)"""
    select = tail or f"SELECT {_round(full, AGGREGATE)} FROM final"
    return ctes if raw else _sql(ctes, select)


def reconciliation(width: str, columns: list[str] | None = None, bounds=None, tail: str = "", raw=False) -> str:
    seconds = SECONDS[width]
    step = f"INTERVAL {seconds} SECOND"
    lower, upper = _bounds(width, bounds)
    full = columns or RECONCILIATION.fieldNames()
    ctes = f"""{TRAFFIC},
meter AS (SELECT device_id, metric_name, topic, seen AS t, numeric_value AS v, committed FROM msgs WHERE metric_name IN ('power', 'energy')),
spine AS (
  SELECT DISTINCT device_id, time_bucket({step}, t) AS s, time_bucket({step}, t) + {step} AS e
  FROM meter WHERE t >= {lower} AND t < {upper}),
power_pts AS (SELECT device_id, t, arg_min(v, committed) AS v FROM meter WHERE metric_name = 'power' AND v IS NOT NULL GROUP BY ALL),
energy_pts AS (SELECT device_id, t, arg_min(v, committed) AS v FROM meter WHERE metric_name = 'energy' AND v IS NOT NULL GROUP BY ALL),
{_lookups("spine", "power_pts", ["device_id"], "pw")},
{_weights("pw", "power_pts", ["device_id"], "pww", seconds)},
{_lookups("spine", "energy_pts", ["device_id"], "en")},
counts AS (
  SELECT device_id, metric_name, time_bucket({step}, t) AS s, min(topic) AS topic, count(*) AS n
  FROM meter WHERE v IS NOT NULL GROUP BY ALL),
states AS (SELECT device_id, event_at AS t, arg_max(is_on, committed) AS is_on FROM relay GROUP BY ALL),
opening AS (
  SELECT b.device_id, b.s, b.e, b.s AS t, coalesce(x.is_on, true) AS is_on
  FROM spine b ASOF LEFT JOIN states x ON b.device_id = x.device_id AND b.s >= x.t),
segments AS (
  SELECT *, coalesce(lead(t) OVER (PARTITION BY device_id, s ORDER BY t), e) AS until FROM (
    SELECT * FROM opening UNION ALL
    SELECT b.device_id, b.s, b.e, x.t, x.is_on FROM spine b JOIN states x
      ON b.device_id = x.device_id AND x.t > b.s AND x.t < b.e)),
coverage AS (
  SELECT device_id, s, sum(CASE WHEN is_on THEN epoch_us(until) - epoch_us(t) ELSE 0 END) / 1e6 AS on_s,
    sum(CASE WHEN NOT is_on THEN epoch_us(until) - epoch_us(t) ELSE 0 END) / 1e6 AS off_s
  FROM segments GROUP BY ALL),
relay_n AS (SELECT device_id, time_bucket({step}, event_at) AS s, count(*) AS n FROM relay GROUP BY ALL),
parts AS (
  SELECT b.s AS bucket_start, b.e AS bucket_end, b.device_id, p.topic AS power_topic, q.topic AS energy_topic,
    p.n AS power_numeric_count, q.n AS energy_numeric_count,
    CASE WHEN p.n > 0 AND pw.sp_t IS NOT NULL AND pw.en_t IS NOT NULL THEN h.locf_avg END AS power_locf_avg_w,
    CASE WHEN p.n > 0 AND pw.sp_t IS NOT NULL AND pw.en_t IS NOT NULL THEN r.linear_avg END AS power_linear_avg_w,
    CASE WHEN q.n > 0 THEN en.locf_s END AS energy_locf_value_at_bucket_start,
    CASE WHEN q.n > 0 THEN en.locf_e END AS energy_locf_value_at_bucket_end,
    CASE WHEN q.n > 0 THEN en.lin_s END AS energy_linear_value_at_bucket_start,
    CASE WHEN q.n > 0 THEN en.lin_e END AS energy_linear_value_at_bucket_end,
    c.on_s AS relay_on_seconds, c.off_s AS relay_off_seconds,
    c.on_s / {seconds} * 100 AS relay_on_pct, c.off_s / {seconds} * 100 AS relay_off_pct,
    coalesce(k.n, 0) AS relay_event_count, true AS relay_state_known,
    CASE WHEN b.e <= date_trunc('minute', TIMESTAMP '{REF}') THEN 'aggregated' ELSE 'tba' END AS status,
    TIMESTAMP '{REF}' AS refreshed_at
  FROM spine b
  LEFT JOIN counts p ON p.device_id = b.device_id AND p.s = b.s AND p.metric_name = 'power'
  LEFT JOIN counts q ON q.device_id = b.device_id AND q.s = b.s AND q.metric_name = 'energy'
  LEFT JOIN pw ON pw.device_id = b.device_id AND pw.s = b.s
  LEFT JOIN en ON en.device_id = b.device_id AND en.s = b.s
  LEFT JOIN pww_held h ON h.device_id = b.device_id AND h.s = b.s
  LEFT JOIN pww_ramp r ON r.device_id = b.device_id AND r.s = b.s
  LEFT JOIN coverage c ON c.device_id = b.device_id AND c.s = b.s
  LEFT JOIN relay_n k ON k.device_id = b.device_id AND k.s = b.s),
summed AS (
  SELECT *, power_locf_avg_w * {seconds} AS power_locf_integral_ws, power_linear_avg_w * {seconds} AS power_linear_integral_ws,
    energy_locf_value_at_bucket_end - energy_locf_value_at_bucket_start AS energy_locf_delta_ws,
    energy_linear_value_at_bucket_end - energy_linear_value_at_bucket_start AS energy_linear_delta_ws
  FROM parts),
final AS (
  SELECT *, power_locf_integral_ws - energy_locf_delta_ws AS drift_locf_signed_ws,
    abs(power_locf_integral_ws - energy_locf_delta_ws) AS drift_locf_abs_ws,
    CASE WHEN energy_locf_delta_ws <> 0 THEN (power_locf_integral_ws - energy_locf_delta_ws) / energy_locf_delta_ws * 100 END AS drift_locf_pct,
    power_linear_integral_ws - energy_linear_delta_ws AS drift_linear_signed_ws,
    abs(power_linear_integral_ws - energy_linear_delta_ws) AS drift_linear_abs_ws,
    CASE WHEN energy_linear_delta_ws <> 0 THEN (power_linear_integral_ws - energy_linear_delta_ws) / energy_linear_delta_ws * 100 END AS drift_linear_pct
  FROM summed)"""
    select = tail or f"SELECT {_round(full, RECONCILIATION)} FROM final"
    return ctes if raw else _sql(ctes, select)


def _latest_aggregates(width: str) -> str:
    shown = [c for c in AGGREGATE.fieldNames() if c not in ("first_received_at", "last_received_at")]
    return aggregates(
        width,
        tail=f"""SELECT {_round(shown, AGGREGATE, True)} FROM final
ORDER BY bucket_start DESC, device_id, metric_name, topic LIMIT 20""",
    )


_INVENTORY = f"""
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY topic ORDER BY committed_at) AS up,
    row_number() OVER (PARTITION BY topic ORDER BY committed_at DESC) AS down
  FROM decoded WHERE NOT malformed),
inventory AS (
  SELECT topic, any_value(received_at) FILTER (up = 1) AS first_seen_at,
    any_value(received_at) FILTER (down = 1) AS last_seen_at, count(*) AS message_count,
    any_value(payload) FILTER (down = 1) AS last_payload,
    any_value(metadata) FILTER (down = 1) AS last_metadata,
    any_value(meta ->> 'event_id') FILTER (down = 1) AS last_event_id,
    any_value(meta ->> 'trace_id') FILTER (down = 1) AS last_trace_id,
    any_value(meta ->> 'publisher_id') FILTER (down = 1) AS last_publisher_id,
    any_value((meta ->> 'sequence')::BIGINT) FILTER (down = 1) AS last_sequence,
    TIMESTAMP '{NOW}' AS refreshed_at
  FROM ordered GROUP BY topic)"""

_RAW = f"{TRAFFIC},{RAW}"
_TYPED = """SELECT received_at, topic, device_id, metric_name, payload, numeric_value, event_ref AS event_id,
  trace_id, publisher_id, sequence, published_at, metadata, committed_at"""

# Rules from the device table, and the first match per topic.
_RULES = """
devices AS (SELECT DISTINCT user_id // 30 AS n FROM events),
kinds(source_table, target_kind, place) AS (VALUES
  ('public.mqtt_power', 'measurement', 0), ('public.mqtt_energy', 'measurement', 1), ('public.mqtt_status', 'status', 2),
  ('public.mqtt_switch', 'measurement', 3), ('public.mqtt_online', 'status', 4), ('public.mqtt_infos', 'status', 5),
  ('public.mqtt_announcements', 'status', 6), ('public.mqtt_dump', 'status', 7), ('public.mqtt_topics', 'topic_inventory', 8)),
renames AS (
  SELECT 100 AS priority, 'dev' || n AS new, 'old\\-dev' || n AS old, 'Imported from devices row ' || (n + 2) AS notes,
    1 AS part, n + 2 AS line, 0 AS turn FROM devices WHERE n % 3 <> 2
  UNION ALL SELECT 100, 'dev' || n, 'shellies/vold\\-dev' || n, 'Imported from devices row ' || (n + 2), 1, n + 2, 1
    FROM devices WHERE n % 3 <> 2
  UNION ALL SELECT 100, 'a-dev' || n, 'old\\-dev' || n, 'Imported from devices row ' || (n + 1000000), 1, n + 1000000, 0
    FROM devices WHERE n % 3 = 0
  UNION ALL SELECT 90, 'dev' || n, 'alias\\-dev' || n, 'Explicit historical alias', 2, n + 2, 0 FROM devices),
filed AS (
  SELECT priority, source_table, 'regex' AS rule_type, '^shellies/' || old || '/(.*)$' AS source_pattern,
    'shellies/' || new || '/\\1' AS target_topic, target_kind, notes, part, line, turn, place FROM renames CROSS JOIN kinds
  UNION ALL SELECT 20, 'public.mqtt_topics', 'prefix', '$SYS/', '$SYS/', 'topic_inventory',
    'Default broker topic inventory mapping', 0, 0, 0, 0
  UNION ALL SELECT 10, t, 'exact', p, NULL, 'skip', w || ' ' || q, 3, i * 2 + j, 0, 0 FROM
    (VALUES ('public.mqtt_online', 'Ignored', 0), ('public.mqtt_topics', 'Ignored retained', 1)) a(t, w, i)
    CROSS JOIN (VALUES ('shellies/BV.LR.SY/ProjectorScreen/online', 'legacy ProjectorScreen online topic', 0),
      ('shellies/living_room/shelly/switch/lw/online', 'legacy living room switch online topic', 1)) b(p, q, j)),
rules AS (SELECT * EXCLUDE (part, line, turn, place) FROM filed)"""

_LEGACY = """
le AS (SELECT *, 'dev' || (user_id // 30)::VARCHAR AS dev FROM events),
legacy AS (
  SELECT event_id, ts AS created_at,
    CASE event_type WHEN 'click' THEN 'public.mqtt_power' WHEN 'purchase' THEN 'public.mqtt_energy'
      WHEN 'view' THEN 'public.mqtt_status' WHEN 'signup' THEN 'public.mqtt_infos' ELSE 'public.mqtt_online' END AS source_table,
    CASE event_type WHEN 'click' THEN 'W' WHEN 'purchase' THEN 'Wmin' WHEN 'signup' THEN 'C' END AS source_unit,
    CASE event_type WHEN 'click' THEN 'shellies/old-' || dev || '/relay/0/power'
      WHEN 'purchase' THEN 'shellies/old-' || dev || '/relay/0/energy'
      WHEN 'view' THEN 'shellies/old-' || dev || '/relay/0'
      WHEN 'signup' THEN 'shellies/shellies/vold-' || dev || '/temperature'
      ELSE CASE WHEN event_id % 5 = 0 THEN 'shellies/BV.LR.SY/ProjectorScreen/online' ELSE 'other/' || dev || '/online' END END AS source_topic,
    CASE event_type WHEN 'purchase' THEN (event_id * 10)::VARCHAR
      WHEN 'view' THEN CASE WHEN event_id % 2 = 0 THEN 'On ' ELSE 'off' END
      WHEN 'error' THEN CASE WHEN event_id % 3 = 0 THEN 'true' END
      ELSE value::DECIMAL(18,2)::VARCHAR END AS source_payload
  FROM le),
snapshot AS (
  SELECT source_topic, arg_max_null(source_payload, event_id) AS source_payload, max(event_id) AS staged_topic_id FROM legacy GROUP BY 1
  UNION ALL SELECT '$SYS/broker/' || event_type, count(*)::VARCHAR, max(event_id) + 1000000000000 FROM events GROUP BY 1),
wanted AS (SELECT DISTINCT source_table, source_topic FROM legacy UNION SELECT 'public.mqtt_topics', source_topic FROM snapshot),
hits AS (
  SELECT w.*, r.rule_type, r.target_kind, r.source_pattern, r.target_topic,
    row_number() OVER (PARTITION BY w.source_table, w.source_topic ORDER BY r.priority, r.part, r.line, r.turn, r.place) AS pick
  FROM wanted w JOIN filed r ON r.source_table = w.source_table AND (
    (r.rule_type = 'exact' AND w.source_topic = r.source_pattern)
    OR (r.rule_type = 'prefix' AND starts_with(w.source_topic, r.source_pattern))
    OR (r.rule_type = 'regex' AND regexp_matches(w.source_topic, r.source_pattern)))),
found AS (
  SELECT source_table, source_topic, target_kind AS mapped_kind,
    CASE WHEN target_kind = 'skip' THEN NULL WHEN rule_type = 'exact' THEN target_topic
      WHEN rule_type = 'prefix' THEN target_topic || substr(source_topic, length(source_pattern) + 1)
      ELSE regexp_replace(source_topic, source_pattern, target_topic) END AS mapped_topic
  FROM hits WHERE pick = 1),
mapped AS (
  SELECT l.*, f.mapped_topic, f.mapped_kind,
    CASE WHEN f.source_topic IS NULL THEN 'unmapped' WHEN f.mapped_kind = 'skip' THEN 'skipped' ELSE 'mapped' END AS validation_status,
    CASE WHEN f.source_topic IS NULL THEN 'no topic mapping matched' WHEN f.mapped_kind = 'skip' THEN 'topic mapping target kind is skip' END AS validation_error,
    CASE WHEN f.mapped_kind <> 'skip' THEN created_at - INTERVAL 1 HOUR END AS production_received_at
  FROM legacy l LEFT JOIN found f USING (source_table, source_topic)),
mapped_topics AS (
  SELECT s.*, f.mapped_topic, f.mapped_kind,
    CASE WHEN f.source_topic IS NULL THEN 'unmapped' WHEN f.mapped_kind = 'skip' THEN 'skipped' ELSE 'mapped' END AS validation_status,
    CASE WHEN f.source_topic IS NULL THEN 'no topic mapping matched' WHEN f.mapped_kind = 'skip' THEN 'topic mapping target kind is skip' END AS validation_error
  FROM snapshot s LEFT JOIN found f ON f.source_topic = s.source_topic AND f.source_table = 'public.mqtt_topics')"""

_MIGRATION = f"{_RULES},{_LEGACY}"
_LOADED = """
loaded AS (
  SELECT *, string_split(mapped_topic, '/') AS seg FROM mapped
  WHERE validation_status = 'mapped' AND mapped_kind IN ('measurement', 'status')),
series AS (
  SELECT *, CASE WHEN seg[3] = 'relay' AND seg[4] = '0' THEN seg[2] END AS device_id,
    CASE WHEN seg[3] = 'relay' AND seg[4] = '0' THEN coalesce(seg[5], 'relay_state') END AS metric_name
  FROM loaded)"""
_IMPORTED = NOW.replace(" ", "T") + ".000000Z"

# Batches of the range run; the last holds what it loads.
_SLICED = f"""
sliced AS (
  SELECT *, date_diff('day', DATE '{SLICES[0]}', created_at::DATE) // {SLICES[2]} + 1 AS batch_id
  FROM mapped WHERE created_at >= DATE '{SLICES[0]}' AND created_at < DATE '{SLICES[1]}'),
own AS (
  SELECT *, string_split(mapped_topic, '/') AS seg FROM sliced
  WHERE batch_id = (SELECT max(batch_id) FROM sliced) AND validation_status = 'mapped'
    AND mapped_kind IN ('measurement', 'status')),
added AS (
  SELECT *, CASE WHEN seg[3] = 'relay' AND seg[4] = '0' THEN seg[2] WHEN seg[1] = 'sensors' AND len(seg) = 3 THEN seg[2] END AS device_id,
    CASE WHEN seg[3] = 'relay' AND seg[4] = '0' THEN coalesce(seg[5], 'relay_state')
         WHEN seg[1] = 'sensors' AND len(seg) = 3 THEN seg[3] END AS metric_name
  FROM own)"""


def _after(family, schema) -> str:
    """Rows of all widths once everything has arrived and every bucket has ended."""
    columns = [c for c in schema.fieldNames() if c != "refreshed_at"]
    parts = (f"SELECT '{w}' AS width, * FROM ({family(w, columns)})" for w in WIDTHS)
    return " UNION ALL ".join(parts).replace(f"TIMESTAMP '{REF}'", f"TIMESTAMP '{NOW}'")


def _refreshed() -> str:
    counted = """count(*) AS row_count, sum({0})::BIGINT AS samples, sum({1})::BIGINT AS gaps,
  min(bucket_start) AS first, max(bucket_start) AS last"""
    parts = []
    for w in WIDTHS:
        found = counted.format("sample_count", "interval_gap_count")
        parts.append(f"SELECT '{w}' AS width, metric_name, {found} FROM ({aggregates(w, bounds=RANGE)}) GROUP BY ALL")
        found = counted.format("energy_numeric_count", "relay_event_count")
        parts.append(f"SELECT '{w}' AS width, '(device)' AS metric_name, {found} FROM ({reconciliation(w, bounds=RANGE)}) GROUP BY ALL")
    return " UNION ALL ".join(parts)


ORACLE: dict[str, str] = {
    "normalize_messages": _sql(
        _RAW, f"{_TYPED}, coalesce(meta ->> 'topic_kind', '') AS topic_kind FROM typed WHERE NOT malformed"
    ),
    "quarantined_messages": _sql(
        _RAW,
        """SELECT topic, payload, received_at, metadata, 'malformed metadata sequence' AS reject_reason
FROM typed WHERE malformed""",
    ),
    "quarantined_topics": _sql(
        _RAW,
        """SELECT topic, payload, received_at, metadata, 'malformed metadata sequence' AS reject_reason
FROM typed WHERE malformed""",
    ),
    "relay_events": _sql(
        _RAW,
        """SELECT received_at AS event_at, topic, device_id, 0::INTEGER AS relay_index,
  lower(trim(value_text)) AS state, lower(trim(value_text)) = 'on' AS is_on, payload, metadata, committed_at
FROM typed WHERE metric_name = 'relay_state' AND lower(trim(value_text)) IN ('on', 'off')""",
    ),
    "topic_inventory": _sql(f"{_RAW},{_INVENTORY}", "SELECT * FROM inventory"),
    "topic_inventory_merge": _sql(f"{_RAW},{_INVENTORY}", "SELECT * FROM inventory"),
    "agg_base_24h": aggregates("24h", BASE),
    "agg_base_60m": aggregates("60m", BASE),
    "boundary_values_60m": aggregates("60m", BOUNDARY),
    "time_weighted_24h": aggregates("24h", WEIGHTED),
    "gap_metrics_24h": aggregates("24h", GAPS),
    **{f"message_aggregates_{w}": aggregates(w) for w in WIDTHS},
    "message_aggregates_range_15m": aggregates("15m", bounds=RANGE),
    "relay_coverage_60m": reconciliation("60m", RELAY),
    **{f"power_energy_{w}": reconciliation(w) for w in WIDTHS},
    "power_energy_range_60m": reconciliation("60m", bounds=RANGE),
    "retained_messages": _sql(
        TRAFFIC,
        """SELECT device_id, metric_name, count(*) AS row_count, min(seen) AS oldest
FROM msgs WHERE seen >= TIMESTAMP '2024-01-15' GROUP BY ALL""",
    ),
    "latest_messages": _sql(
        _RAW,
        """SELECT received_at, topic, device_id, metric_name, numeric_value, trace_id, sequence, published_at, committed_at
FROM typed WHERE NOT malformed ORDER BY received_at DESC, committed_at DESC LIMIT 20""",
    ),
    **{f"latest_aggregates_{w}": _latest_aggregates(w) for w in WIDTHS},
    "latest_reconciliation_3m": reconciliation(
        "3m",
        tail=f"""SELECT {_round(RECONCILIATION.fieldNames(), RECONCILIATION, True)} FROM final
ORDER BY bucket_start DESC, device_id LIMIT 20""",
    ),
    "latest_topics": _sql(
        f"{_RAW},{_INVENTORY}",
        """SELECT * EXCLUDE (last_payload, last_metadata) FROM inventory
ORDER BY last_seen_at DESC, topic LIMIT 50""",
    ),
    "trace_latency": _sql(
        _RAW,
        """SELECT trace_id, sequence, topic, published_at, received_at, committed_at,
  round((epoch_us(received_at) - epoch_us(published_at)) / 1000, 3) AS publish_to_receive_ms,
  round((epoch_us(committed_at) - epoch_us(received_at)) / 1000, 3) AS receive_to_commit_ms
FROM typed WHERE trace_id IS NOT NULL AND NOT malformed
ORDER BY published_at DESC NULLS FIRST, trace_id LIMIT 50""",
    ),
    "recommended_24h": aggregates(
        "24h",
        tail="""SELECT bucket_start, device_id, metric_name, numeric_count, quality_score AS quality_score,
  array_to_string(quality_flags, ',') AS quality_flags FROM final
WHERE quality_status = 'rated' AND quality_score >= 5 AND numeric_count >= 5
  AND NOT list_has_any(quality_flags, ['missing_locf_start', 'missing_linear_start', 'missing_locf_end', 'missing_linear_end'])""",
    ),
    "quality_bands_60m": aggregates(
        "60m",
        tail="""SELECT metric_name, CASE WHEN quality_score >= 8 THEN 'strong' WHEN quality_score >= 5 THEN 'usable'
    WHEN quality_score >= 2 THEN 'weak' ELSE 'very_poor' END AS band, count(*) AS row_count
FROM final WHERE quality_status = 'rated' GROUP BY ALL""",
    ),
    "contract_violations": _sql(
        TRAFFIC,
        """SELECT * FROM (VALUES
  ('message_aggregates', 'status_domain', 0::BIGINT), ('message_aggregates', 'bucket_width', 0),
  ('message_aggregates', 'not_null', 0), ('message_aggregates', 'unique_topic_key', 0),
  ('message_aggregates', 'unique_series_key', 0),
  ('power_energy_reconciliation', 'status_domain', 0), ('power_energy_reconciliation', 'bucket_width', 0),
  ('power_energy_reconciliation', 'not_null', 0), ('power_energy_reconciliation', 'unique_key', 0),
  ('messages', 'not_null', 0),
  ('relay_state_events', 'state_domain', 0), ('relay_state_events', 'relay_index_domain', 0), ('relay_state_events', 'not_null', 0),
  ('topic_mapping', 'rule_type_domain', 0), ('topic_mapping', 'target_kind_domain', 0), ('topic_mapping', 'target_required', 0),
  ('staged_messages', 'status_domain', 0), ('staged_messages', 'kind_domain', 0),
  ('rejected_messages', 'one_source', 0)) v(table_name, "check", violations)
UNION ALL SELECT 'messages_at_mid_january', 'retention', count(*) FROM msgs WHERE seen < TIMESTAMP '2024-01-15'""",
    ),
    "fixed_point_after_ingest": _after(aggregates, AGGREGATE),
    "reconciled_after_ingest": _after(reconciliation, RECONCILIATION),
    "refreshed_range": _refreshed(),
    "due_buckets": _sql(
        f"""{TRAFFIC},
first AS (
  SELECT * FROM msgs WHERE device_id IS NOT NULL AND seen < TIMESTAMP '{HALFWAY}' AND epoch_us(committed) % 7 <> 0),
widths AS (SELECT * FROM (VALUES ('3m', 180), ('15m', 900), ('60m', 3600), ('24h', 86400)) AS t(width, sec)),
series AS (
  SELECT DISTINCT width, device_id, metric_name, event_type = 'view' AS status,
    time_bucket(to_seconds(sec), seen) + to_seconds(sec) AS e FROM first, widths),
devices AS (
  SELECT DISTINCT width, device_id, NULL AS metric_name, e FROM series
  WHERE metric_name IN ('power', 'energy', 'relay_state')),
entries AS (
  SELECT DISTINCT e AS due, width, device_id, metric_name, e, false AS touched FROM series
  UNION ALL SELECT e, width, device_id, metric_name, e, false FROM devices),
due AS (
  SELECT * FROM entries WHERE due > date_trunc('minute', TIMESTAMP '{HALFWAY}')
  UNION ALL SELECT DISTINCT date_trunc('minute', TIMESTAMP '{HALFWAY}'), width, device_id, metric_name, e, true
  FROM series WHERE status)""",
        """SELECT strftime(due, '%Y%m%d%H%M') AS due, width, metric_name, touched,
  count(*) AS buckets, count(DISTINCT device_id) AS devices FROM due GROUP BY ALL""",
    ),
    "range_run_staged": _sql(
        f"{_MIGRATION},{_SLICED}",
        """SELECT batch_id, source_table, validation_status AS status, count(*) AS row_count FROM sliced GROUP BY ALL
UNION ALL SELECT 1, '(topics)', validation_status, count(*) FROM mapped_topics GROUP BY ALL""",
    ),
    "range_run_loaded": _sql(
        f"{_MIGRATION},{_SLICED}",
        """SELECT device_id, metric_name, NULL AS state, count(*) AS row_count,
  min(production_received_at) AS first_at, max(production_received_at) AS last_at FROM added GROUP BY ALL
UNION ALL SELECT device_id, '(relay)', lower(trim(source_payload)), count(*), min(production_received_at), max(production_received_at)
FROM added WHERE mapped_kind = 'status' AND metric_name = 'relay_state' GROUP BY ALL""",
    ),
    "range_run_batches": _sql(
        f"""{_MIGRATION},{_SLICED},
every AS (
  SELECT batch_id, validation_status FROM sliced UNION ALL SELECT 1, validation_status FROM mapped_topics),
ended AS (SELECT max(batch_id) AS last FROM sliced),
loaded AS (SELECT count(*) AS n FROM added)""",
        """SELECT batch_id, 'history' AS dump_name, CASE WHEN batch_id = last THEN 'loaded' ELSE 'mapped' END AS status,
  count(*) AS staged_row_count, count_if(validation_status = 'mapped')::BIGINT AS mapped_row_count,
  CASE WHEN batch_id = last THEN n ELSE 0 END AS inserted_row_count
FROM every, ended, loaded GROUP BY batch_id, last, n""",
    ),
    "touched_buckets": _sql(
        TRAFFIC,
        " UNION ALL ".join(
            f"""SELECT DISTINCT '{w}' AS width, device_id, metric_name, time_bucket(INTERVAL {s} SECOND, seen) AS bucket_start
FROM msgs WHERE device_id IS NOT NULL AND event_type <> 'view'"""
            for w, s in WIDTHS.items()
        ),
    ),
    "rules_from_devices": _sql(_RULES, "SELECT * FROM rules"),
    "imported_rules": _sql(
        f"""{_RULES},
numbered AS (
  SELECT * EXCLUDE (part, line, turn, place), row_number() OVER (ORDER BY part, line, turn, place) AS mapping_id FROM filed)""",
        """SELECT *, true AS enabled FROM numbered
UNION ALL SELECT * REPLACE ((SELECT count(*) FROM numbered) + row_number() OVER (ORDER BY mapping_id) AS mapping_id), true
FROM numbered WHERE target_topic IS NULL""",
    ),
    "stage_range": _sql(
        _MIGRATION,
        f"""SELECT 7::BIGINT AS batch_id, source_table, count(*) AS row_count, min(created_at) AS first_at, max(created_at) AS last_at
FROM legacy WHERE created_at >= TIMESTAMP '{RANGE[0]}' AND created_at < TIMESTAMP '{RANGE[1]}' GROUP BY ALL""",
    ),
    "apply_rules": _sql(
        _MIGRATION,
        """SELECT source_table, created_at AS source_created_at, source_topic, source_payload, mapped_topic,
  mapped_kind, validation_status, validation_error, production_received_at FROM mapped""",
    ),
    "apply_rules_topics": _sql(
        _MIGRATION,
        """SELECT staged_topic_id, source_topic, source_payload, mapped_topic, mapped_kind, validation_status, validation_error
FROM mapped_topics""",
    ),
    "status_report": _sql(
        _MIGRATION,
        """SELECT validation_status AS status, count(*) AS row_count FROM mapped GROUP BY ALL
UNION ALL SELECT 'topic_' || validation_status, count(*) FROM mapped_topics GROUP BY ALL ORDER BY 1""",
    ),
    "rejected_rows": _sql(
        _MIGRATION,
        """SELECT 7::BIGINT AS batch_id, source_table, source_topic, validation_error AS reason, count(*) AS row_count, count(*) AS messages
FROM mapped WHERE validation_status <> 'mapped' GROUP BY ALL
UNION ALL SELECT 7, 'public.mqtt_topics', source_topic, validation_error, count(*), 0
FROM mapped_topics WHERE validation_status <> 'mapped' GROUP BY ALL""",
    ),
    "load_messages": _sql(
        f"{_MIGRATION},{_LOADED}",
        f"""SELECT production_received_at AS received_at, mapped_topic AS topic, device_id, metric_name,
  coalesce(source_payload, '') AS payload, round(try_cast(source_payload AS DOUBLE) + 0.00000137, 5) AS numeric_value,
  '{{"migration_batch_id":"7","source_table":"' || source_table || '","source_topic":"' || source_topic
    || '","source_unit":' || coalesce('"' || source_unit || '"', 'null')
    || ',"source_created_at":"' || strftime(created_at, '%Y-%m-%d %H:%M:%S.%f')
    || '","target_kind":"' || mapped_kind || '","imported_at":"{_IMPORTED}"}}' AS metadata
FROM series WHERE created_at >= TIMESTAMP '2024-01-15'""",
    ),
    "load_relay_events": _sql(
        f"{_MIGRATION},{_LOADED}",
        """SELECT production_received_at AS event_at, mapped_topic AS topic, device_id, 0::INTEGER AS relay_index,
  lower(trim(source_payload)) AS state, lower(trim(source_payload)) = 'on' AS is_on, source_payload AS payload
FROM series WHERE mapped_kind = 'status' AND metric_name = 'relay_state' AND created_at >= TIMESTAMP '2024-01-15'""",
    ),
    "load_topics": _sql(
        f"{_RAW},{_INVENTORY},{_MIGRATION}",
        f""", latest AS (
  SELECT mapped_topic AS topic, arg_max(source_topic, staged_topic_id) AS source_topic,
    arg_max_null(source_payload, staged_topic_id) AS payload
  FROM mapped_topics WHERE validation_status = 'mapped' GROUP BY 1),
arrived AS (
  SELECT *, '{{"migration_batch_id":"7","source_table":"public.mqtt_topics","source_topic":"' || source_topic
    || '","target_kind":"topic_inventory","imported_at":"{_IMPORTED}"}}' AS metadata FROM latest)
SELECT coalesce(i.topic, a.topic) AS topic, coalesce(first_seen_at, TIMESTAMP '{NOW}') AS first_seen_at,
  CASE WHEN a.topic IS NULL THEN last_seen_at ELSE TIMESTAMP '{NOW}' END AS last_seen_at,
  coalesce(message_count, 0) + (a.topic IS NOT NULL)::BIGINT AS message_count,
  CASE WHEN a.topic IS NULL THEN last_payload ELSE a.payload END AS last_payload,
  CASE WHEN a.topic IS NULL THEN last_metadata ELSE a.metadata END AS last_metadata,
  last_event_id, last_trace_id, last_publisher_id, last_sequence, TIMESTAMP '{NOW}' AS refreshed_at
FROM inventory i FULL JOIN arrived a ON i.topic = a.topic""",
    ).replace("\n, latest", ", latest"),
    "batch_summary": _sql(
        _MIGRATION,
        f""", m AS (SELECT validation_status, count(*) AS n FROM mapped GROUP BY 1),
t AS (SELECT validation_status, count(*) AS n FROM mapped_topics GROUP BY 1),
totals AS (SELECT sum(n)::BIGINT AS n, coalesce(sum(n) FILTER (validation_status = 'mapped'), 0)::BIGINT AS ok
  FROM (SELECT * FROM m UNION ALL SELECT * FROM t))
SELECT 7::BIGINT AS batch_id, 'history' AS dump_name, 'Europe/Berlin' AS source_timezone, 'mapped' AS status,
  (SELECT min(created_at) - INTERVAL 1 HOUR FROM legacy) AS source_min_at,
  (SELECT max(created_at) - INTERVAL 1 HOUR FROM legacy) AS source_max_at,
  n AS staged_row_count, ok AS mapped_row_count, n - ok AS skipped_row_count, 0::BIGINT AS inserted_row_count,
  (SELECT '{{' || string_agg('"' || validation_status || '":' || n, ',' ORDER BY validation_status) || '}}' FROM m) AS message_status_counts,
  (SELECT '{{' || string_agg('"' || validation_status || '":' || n, ',' ORDER BY validation_status) || '}}' FROM t) AS topic_status_counts,
  TIMESTAMP '{NOW}' AS created_at, TIMESTAMP '{NOW}' AS updated_at
FROM totals""",
    ).replace("\n, m AS", ", m AS"),
    "top_unmapped": _sql(
        _MIGRATION,
        """SELECT * FROM (
  SELECT source_table, source_topic, count(*) AS row_count, min(created_at) AS first_seen_at, max(created_at) AS last_seen_at
  FROM mapped WHERE validation_status = 'unmapped' GROUP BY ALL
  UNION ALL SELECT 'public.mqtt_topics', source_topic, count(*), NULL, NULL
  FROM mapped_topics WHERE validation_status = 'unmapped' GROUP BY ALL)
ORDER BY row_count DESC, source_topic, source_table LIMIT 50""",
    ),
    "loaded_by_series": _sql(
        f"{_MIGRATION},{_LOADED}",
        "SELECT mapped_topic AS topic, device_id, metric_name, count(*) AS row_count FROM series GROUP BY ALL",
    ),
    "loaded_relay_states": _sql(
        f"{_MIGRATION},{_LOADED}",
        """SELECT device_id, lower(trim(source_payload)) AS state, count(*) AS row_count
FROM series WHERE mapped_kind = 'status' AND metric_name = 'relay_state' GROUP BY ALL""",
    ),
    "reset_batch": _sql(
        TRAFFIC, "SELECT device_id, metric_name, count(*) AS row_count FROM msgs GROUP BY ALL"
    ),
}
