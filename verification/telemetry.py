from pyspark.sql import functions as F

from meterflow import fixtures as fx
from meterflow.config import DISTANCE_BOUNDS, LATENCY_BOUNDS, PREDICTED_MINUTES_BOUNDS
from meterflow.operators import telemetry as tm
from meterflow.operators.drift import rolling_drift
from meterflow.operators.throttle import throttle_marks
from verification import query
from verification.drift import (
    DISTANCE_REF, DURATION_REF, TRIPS_RAW, _ARRIVED, _drift_sql, _severity_sql, arrivals,
)
from verification.tables import PREDICTIONS, REQUESTS

_KNOWN = "('/', '/health', '/metrics', '/predict', '/predict/batch', '/docs', '/openapi.json')"
_ENDPOINT = f"CASE WHEN endpoint IN {_KNOWN} THEN endpoint ELSE 'unmatched' END"


def _ntz(df, *names):
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


@query("request_counts", f"""WITH {REQUESTS} SELECT method, {_ENDPOINT} AS endpoint, status, count(*) AS requests
 FROM requests GROUP BY ALL""")
def request_counts(spark, sf_dir):
    """Requests by method, known endpoint and status."""
    return tm.request_counts(fx.requests(spark, sf_dir))


@query("request_rate_1m", f"""WITH {REQUESTS} SELECT endpoint, status, date_trunc('minute', ts) AS window_start,
 round(count(*) / 60.0e0, 6) AS per_second FROM requests GROUP BY ALL""")
def request_rate_1m(spark, sf_dir):
    """Requests per second over one minute by endpoint and status."""
    rates = tm.rates(fx.requests(spark, sf_dir), ["endpoint", "status"])
    return _ntz(rates.withColumn("per_second", F.round("per_second", 6)), "window_start")


@query("prediction_rate_1m", f"""WITH {PREDICTIONS} SELECT model_version, status, date_trunc('minute', ts) AS window_start,
 round(count(*) / 60.0e0, 6) AS per_second FROM predictions GROUP BY ALL""")
def prediction_rate_1m(spark, sf_dir):
    """Predictions per second over one minute by model version and status."""
    rates = tm.rates(fx.predictions(spark, sf_dir), ["model_version", "status"])
    return _ntz(rates.withColumn("per_second", F.round("per_second", 6)), "window_start")


@query("prediction_counts", f"""WITH {PREDICTIONS} SELECT model_version, status, count(*) AS predictions
 FROM predictions GROUP BY ALL""")
def prediction_counts(spark, sf_dir):
    """Predictions by model version and status."""
    return tm.prediction_counts(fx.predictions(spark, sf_dir))


@query("batch_summary", f"""WITH {PREDICTIONS} SELECT batch_start, count(*) AS trips,
 round(avg(predicted_duration_minutes), 6) AS avg_predicted_minutes FROM predictions GROUP BY ALL""")
def batch_summary(spark, sf_dir):
    """Trips and mean predicted minutes of each scored batch."""
    summary = tm.batch_summary(fx.predictions(spark, sf_dir))
    return summary.withColumn("avg_predicted_minutes", F.round("avg_predicted_minutes", 6))


def _histogram_sql(table: str, value: str, bounds, keys: str, where: str = "true") -> str:
    bound_rows = ", ".join(f"('{b}', {b}e0)" for b in bounds) + ", ('+Inf', 'Infinity'::DOUBLE)"
    return f"""SELECT {keys}, le, count(*) FILTER ({value} <= bound) AS cumulative,
 round(sum({value}), 4) AS value_sum, count(*) AS total
 FROM {table} CROSS JOIN (VALUES {bound_rows}) AS t(le, bound) WHERE {where} GROUP BY {keys}, le"""


def _rounded_sum(df):
    return df.withColumn("value_sum", F.round("value_sum", 4))


@query("latency_hist", f"WITH {REQUESTS} " + _histogram_sql("requests", "latency_s", LATENCY_BOUNDS, "method, endpoint"))
def latency_hist(spark, sf_dir):
    """Cumulative latency histogram by method and endpoint."""
    return _rounded_sum(tm.cumulative_histogram(
        fx.requests(spark, sf_dir), "latency_s", LATENCY_BOUNDS, ["method", "endpoint"]))


@query("prediction_hist", f"WITH {PREDICTIONS} " + _histogram_sql(
    "predictions", "predicted_duration_minutes", PREDICTED_MINUTES_BOUNDS, "model_version", "status = 'success'"))
def prediction_hist(spark, sf_dir):
    """Cumulative histogram of predicted minutes of successful predictions."""
    good = fx.predictions(spark, sf_dir).filter("status = 'success'")
    return _rounded_sum(tm.cumulative_histogram(
        good, "predicted_duration_minutes", PREDICTED_MINUTES_BOUNDS, ["model_version"]))


@query("distance_hist", f"WITH {PREDICTIONS} " + _histogram_sql(
    "predictions", "trip_distance", DISTANCE_BOUNDS, "status", "status = 'success'"))
def distance_hist(spark, sf_dir):
    """Cumulative histogram of incoming distances of successful predictions."""
    good = fx.predictions(spark, sf_dir).filter("status = 'success'")
    return _rounded_sum(tm.cumulative_histogram(good, "trip_distance", DISTANCE_BOUNDS, ["status"]))


def _quantile_sql(table: str, value: str, bounds, keys: str, quantiles: dict, minutes: int = 5) -> str:
    """Windows end at each whole minute that one of their events precedes by less than their length."""
    comma = f"{keys}, " if keys else ""
    bound_rows = ", ".join(
        f"({b}e0, {bounds[i - 1] if i else 0.0}e0)" for i, b in enumerate(bounds)) + f", ('Infinity'::DOUBLE, {bounds[-1]}e0)"
    answers = ", ".join(f"""round(arg_min(CASE WHEN isinf(upper) THEN lower
  ELSE lower + (upper - lower) * ({q}e0 * total - (cumulative - inside)) / nullif(inside, 0) END, upper)
  FILTER (cumulative >= {q}e0 * total), 6) AS {name}"""
                        for name, q in quantiles.items())
    return f"""windows AS (SELECT {comma}{value} AS v, date_trunc('minute', ts) + to_minutes(s.m) AS window_end
  FROM {table} CROSS JOIN (SELECT unnest(range(1, {minutes + 1})) AS m) AS s WHERE {value} IS NOT NULL),
 counted AS (SELECT {comma}window_end, upper, lower, count(*) FILTER (v <= upper) AS cumulative,
  count(*) FILTER (v <= upper AND (v > lower OR lower = 0)) AS inside, count(*) AS total
  FROM windows CROSS JOIN (VALUES {bound_rows}) AS t(upper, lower) GROUP BY ALL)
 SELECT {comma}window_end, total, {answers} FROM counted GROUP BY {comma}window_end, total"""


@query("latency_quantile_5m", f"WITH {REQUESTS}, " + _quantile_sql(
    "requests", "latency_s", LATENCY_BOUNDS, "endpoint", {"p95": 0.95}))
def latency_quantile_5m(spark, sf_dir):
    """Estimated p95 latency by endpoint over sliding five minutes."""
    windows = tm.latency_quantiles(fx.requests(spark, sf_dir), {"p95": 0.95})
    return _ntz(windows.withColumn("p95", F.round("p95", 6)), "window_end")


@query("duration_quantile_5m", f"WITH {PREDICTIONS}, " + _quantile_sql(
    "predictions", "predicted_duration_minutes", PREDICTED_MINUTES_BOUNDS, "", {"p50": 0.5, "p90": 0.9}))
def duration_quantile_5m(spark, sf_dir):
    """Estimated median and p90 predicted minutes over sliding five minutes."""
    windows = tm.latency_quantiles(
        fx.predictions(spark, sf_dir), {"p50": 0.5, "p90": 0.9}, "predicted_duration_minutes",
        PREDICTED_MINUTES_BOUNDS, keys=())
    return _ntz(windows.withColumns({q: F.round(q, 6) for q in ("p50", "p90")}), "window_end")


@query("latency_quantile_exact", f"""WITH {REQUESTS} SELECT endpoint, date_trunc('day', ts) AS window_start,
 round(quantile_cont(latency_s, 0.5), 6) AS p50, round(quantile_cont(latency_s, 0.95), 6) AS p95
 FROM requests GROUP BY ALL""")
def latency_quantile_exact(spark, sf_dir):
    """Exact daily latency quantiles by endpoint."""
    windows = tm.exact_quantiles(fx.requests(spark, sf_dir), {"p50": 0.5, "p95": 0.95}, window_seconds=86_400)
    return _ntz(windows.withColumns({q: F.round(q, 6) for q in ("p50", "p95")}), "window_start")


@query("latency_quantile_hot", f"""WITH {REQUESTS} SELECT CASE WHEN request_id % 2 = 0 THEN '/hot' ELSE endpoint END AS endpoint,
 date_trunc('month', ts) AS window_start, round(quantile_cont(latency_s, 0.25), 6) AS p25, round(quantile_cont(latency_s, 0.5), 6) AS p50,
 round(quantile_cont(latency_s, 0.99), 6) AS p99 FROM requests GROUP BY ALL""")
def latency_quantile_hot(spark, sf_dir):
    """Exact quantiles of a month where one endpoint has half of the rows, by several passes of counting."""
    requests = fx.requests(spark, sf_dir)
    endpoint = F.when(F.col("request_id") % 2 == 0, F.lit("/hot")).otherwise(F.col("endpoint"))
    month = requests.select("latency_s", endpoint.alias("endpoint"), F.date_trunc("month", "ts").alias("ts"))
    wanted = {"p25": 0.25, "p50": 0.5, "p99": 0.99}
    windows = tm.exact_quantiles(month, wanted, window_seconds=86_400, few_rows=20)
    return _ntz(windows.withColumns({q: F.round(q, 6) for q in wanted}), "window_start")


_ERROR_RATIO = """spread AS (SELECT status, {trunc} + s.d AS window_end FROM requests
  CROSS JOIN (SELECT {step} * unnest(range(1, {steps} + 1)) AS d) AS s),
 ratios AS (SELECT window_end, count(*) FILTER (status BETWEEN 500 AND 599) AS errors, count(*) AS requests,
  count(*) FILTER (status BETWEEN 500 AND 599) / count(*) AS ratio FROM spread GROUP BY window_end)"""
_RATIO_5M = _ERROR_RATIO.format(trunc="date_trunc('minute', ts)", step="INTERVAL 1 MINUTE", steps=5)
_RATIO_5H = _ERROR_RATIO.format(trunc="date_trunc('hour', ts)", step="INTERVAL 1 HOUR", steps=5)


@query("error_ratio_5m", f"""WITH {REQUESTS}, {_RATIO_5M}
 SELECT window_end, errors, requests, round(ratio, 6) AS ratio FROM ratios""")
def error_ratio_5m(spark, sf_dir):
    """Server error share over sliding five minutes."""
    windows = tm.error_ratio(fx.requests(spark, sf_dir))
    return _ntz(windows.withColumn("ratio", F.round("ratio", 6)), "window_end")


_HELD = """SELECT a.{key} AS fires_at FROM {table} a JOIN {table} b ON b.{key} = a.{key} - {step}
 JOIN {table} c ON c.{key} = a.{key} - 2 * {step}"""


@query("alert_error_rate", f"""WITH {REQUESTS}, {_RATIO_5M}, bad AS (SELECT window_end FROM ratios WHERE ratio > 0.05)
 {_HELD.format(key='window_end', table='bad', step='INTERVAL 1 MINUTE')}""")
def alert_error_rate(spark, sf_dir):
    """Minutes at which errors stayed above five per cent for two minutes."""
    return _ntz(tm.error_rate_alert(fx.requests(spark, sf_dir)), "fires_at")


@query("alert_error_rate_hourly", f"""WITH {REQUESTS}, {_RATIO_5H}, bad AS (SELECT window_end FROM ratios WHERE ratio > 0.25)
 {_HELD.format(key='window_end', table='bad', step='INTERVAL 1 HOUR')}""")
def alert_error_rate_hourly(spark, sf_dir):
    """The same rule at a coarser step, where windows hold many requests."""
    alert = tm.error_rate_alert(fx.requests(spark, sf_dir), above=0.25, for_seconds=7200, step_seconds=3600,
                                window_seconds=18_000)
    return _ntz(alert, "fires_at")


@query("alert_slow", f"""WITH {REQUESTS}, q AS (WITH {_quantile_sql("requests", "latency_s", LATENCY_BOUNDS, "", {"p95": 0.95})}),
 bad AS (SELECT window_end FROM q WHERE p95 > 2.0)
 {_HELD.format(key='window_end', table='bad', step='INTERVAL 1 MINUTE')}""")
def alert_slow(spark, sf_dir):
    """Minutes at which p95 latency stayed above two seconds for two minutes."""
    return _ntz(tm.slow_alert(fx.requests(spark, sf_dir)), "fires_at")


_ALERTS = f"""points AS ({_drift_sql('i % 10 = 0 AND i >= 100')}),
 alerts AS (SELECT p.feature, {_severity_sql('psi')} AS severity, t.ts FROM points p
  JOIN (SELECT tpep_pickup_datetime AS ts, row_number() OVER (ORDER BY tpep_pickup_datetime, trip_id) AS i FROM trips_raw) t
  USING (i))"""


def _timed_alerts(spark, sf_dir):
    from meterflow.operators.ordering import with_row_index

    order = ("arrived_at", "trip_id")
    rows = arrivals(spark, sf_dir)
    placed = with_row_index(rows.select(*order), order)
    return rolling_drift(rows, order).join(placed, "row_index").withColumnRenamed("arrived_at", "ts")


@query("alert_drift", f"""WITH {TRIPS_RAW}, {DISTANCE_REF}, {DURATION_REF}, {_ARRIVED}, {_ALERTS},
 ends AS (SELECT DISTINCT date_trunc('minute', ts) + INTERVAL 1 MINUTE * m AS window_end FROM alerts
  CROSS JOIN (SELECT unnest(range(1, 11)) AS m) WHERE severity = 'HIGH')
 SELECT a.window_end AS fires_at FROM ends a JOIN ends b ON b.window_end = a.window_end - INTERVAL 1 MINUTE""")
def alert_drift(spark, sf_dir):
    """Minutes at which high drift within ten minutes was seen for a minute."""
    return _ntz(tm.drift_alert(_timed_alerts(spark, sf_dir)), "fires_at")


@query("alert_totals", f"""WITH {TRIPS_RAW}, {DISTANCE_REF}, {DURATION_REF}, {_ARRIVED}, {_ALERTS}
 SELECT s.severity, count(a.i) AS alerts FROM (VALUES ('HIGH'), ('MEDIUM')) AS s(severity)
 LEFT JOIN (SELECT 1 AS i, severity FROM alerts) a USING (severity) GROUP BY s.severity""")
def alert_totals(spark, sf_dir):
    """Drift alerts by severity, zero shown."""
    return tm.alert_totals(rolling_drift(arrivals(spark, sf_dir), ("arrived_at", "trip_id")))


@query("heartbeat_gaps", f"""WITH {REQUESTS}, g AS (SELECT endpoint, ts AS silent_from,
 lead(ts) OVER (PARTITION BY endpoint ORDER BY ts) AS silent_until FROM requests)
 SELECT endpoint, silent_from, silent_until, round(date_diff('microsecond', silent_from, silent_until) / 1e6, 6) AS gap_seconds
 FROM g WHERE date_diff('microsecond', silent_from, silent_until) > 60000000""")
def heartbeat_gaps(spark, sf_dir):
    """Silences over a minute per endpoint."""
    gaps = tm.heartbeat_gaps(fx.requests(spark, sf_dir), "endpoint")
    return gaps.withColumn("gap_seconds", F.round("gap_seconds", 6))


@query("status_down", f"""WITH {REQUESTS}, steps AS (SELECT endpoint, date_trunc('hour', ts) AS h,
 arg_max(CASE WHEN status = 500 THEN 0 ELSE 1 END, ts) AS flag FROM requests GROUP BY ALL),
 down AS (SELECT endpoint, h FROM steps WHERE flag = 0)
 SELECT a.endpoint, a.h AS fires_at FROM down a JOIN down b ON b.endpoint = a.endpoint AND b.h = a.h - INTERVAL 1 HOUR""")
def status_down(spark, sf_dir):
    """Hours at which an endpoint's last status flag was down for an hour."""
    flag = F.when(F.col("status") == 500, 0).otherwise(1)
    down = tm.status_down(fx.requests(spark, sf_dir), flag, ["endpoint"], for_seconds=3600, step_seconds=3600)
    return _ntz(down, "fires_at")


@query("current_status", f"""WITH {REQUESTS}, last AS (SELECT endpoint, arg_max(CASE WHEN status = 500 THEN 0 ELSE 1 END, ts) AS f
 FROM requests GROUP BY endpoint) SELECT max(f) AS status FROM last""")
def current_status(spark, sf_dir):
    """Best last-known status over all endpoints."""
    flagged = fx.requests(spark, sf_dir).withColumn("up", F.when(F.col("status") == 500, 0).otherwise(1))
    return tm.current_status(flagged, "up", ["endpoint"])


def _throttle_sql(client: str, limit: int, micros: int) -> str:
    kept = f"list_filter(w.kept, lambda x: x >= n.t - {micros})"
    return f"""WITH RECURSIVE {REQUESTS},
 numbered AS (SELECT {client} AS client, request_id, epoch_us(ts) AS t,
  row_number() OVER (PARTITION BY {client} ORDER BY ts, request_id) AS rn FROM requests),
 walk AS (SELECT client, request_id, rn, [t] AS kept, true AS admitted FROM numbered WHERE rn = 1
  UNION ALL SELECT n.client, n.request_id, n.rn,
   CASE WHEN len({kept}) < {limit} THEN list_append({kept}, n.t) ELSE {kept} END, len({kept}) < {limit}
  FROM walk w JOIN numbered n ON n.client = w.client AND n.rn = w.rn + 1)
 SELECT client, request_id, admitted FROM walk"""


THROTTLE_SQL = _throttle_sql("client", 2, 86_400_000_000)


@query("throttle_marks", THROTTLE_SQL)
def throttle_marks_query(spark, sf_dir):
    """Requests a limit of two a day per client would admit."""
    marks = throttle_marks(fx.requests(spark, sf_dir).select("client", "request_id", "ts"), "client", "ts",
                           "request_id", limit=2, window_seconds=86_400, slice_windows=4)
    return marks.select("client", "request_id", "admitted")


@query("throttle_totals", f"""{THROTTLE_SQL.replace("SELECT client, request_id, admitted FROM walk",
 "SELECT client, count(*) FILTER (admitted) AS admitted, count(*) FILTER (NOT admitted) AS denied FROM walk GROUP BY client")}""")
def throttle_totals(spark, sf_dir):
    """Admitted and denied requests per client."""
    marks = throttle_marks(fx.requests(spark, sf_dir).select("client", "request_id", "ts"), "client", "ts",
                           "request_id", limit=2, window_seconds=86_400, slice_windows=10)
    return marks.groupBy("client").agg(F.count_if("admitted").alias("admitted"),
                                       F.count_if(~F.col("admitted")).alias("denied"))


@query("throttle_marks_hot", _throttle_sql("CASE WHEN request_id % 3 = 0 THEN -1 ELSE client END", 20, 86_400_000_000))
def throttle_marks_hot(spark, sf_dir):
    """A limit of twenty a day where one client, always above it, sends a third of all requests."""
    client = F.when(F.col("request_id") % 3 == 0, F.lit(-1)).otherwise(F.col("client"))
    requests = fx.requests(spark, sf_dir).select(client.alias("client"), "request_id", "ts")
    return throttle_marks(requests, "client", "ts", "request_id", limit=20, window_seconds=86_400, slice_windows=2)\
        .select("client", "request_id", "admitted")


SESSIONS_SQL = f"""WITH {REQUESTS}, steps AS (SELECT client, ts, CASE WHEN date_diff('microsecond',
 lag(ts) OVER (PARTITION BY client ORDER BY ts), ts) <= 3600000000 THEN 0 ELSE 1 END AS fresh FROM requests),
 runs AS (SELECT *, sum(fresh) OVER (PARTITION BY client ORDER BY ts) AS run FROM steps)
 SELECT client, min(ts) AS session_start, max(ts) + INTERVAL 1 HOUR AS session_end, count(*) AS requests
 FROM runs GROUP BY client, run"""


@query("activity_sessions", SESSIONS_SQL)
def activity_sessions(spark, sf_dir):
    """Client activity between silences of an hour, counted per slot before ordering."""
    return tm.activity_sessions(fx.requests(spark, sf_dir), gap_seconds=3600)
