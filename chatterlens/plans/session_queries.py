"""Sessions, the series a user sees, and the replay schedule."""

from pyspark.sql import functions as F

from chatterlens.operators import sequence as Q
from chatterlens.operators import sessions as U
from chatterlens.plans import keyword_queries as KQ
from chatterlens.plans import tables as D
from chatterlens.plans.registry import query

_LOG = f"WITH {D.SESSION_CTE}"
_LIVE = """live AS (SELECT user_id, keyword1, keyword2, event_utc AS started_utc FROM (
    SELECT * FROM session_log QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY seq DESC) = 1)
    WHERE action = 'start')"""


@query("latest_session_per_user", f"{_LOG}, {_LIVE} SELECT * FROM live")
def _latest_session(spark, sf_dir):
    return U.latest_session_per_user(D.session_log(spark, sf_dir))


@query("session_state", f"""{_LOG} SELECT user_id, seq, action, keyword1, keyword2, event_utc FROM session_log
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY seq DESC) = 1""")
def _session_state(spark, sf_dir):
    """Half of the log folded first, the other half folded into that state."""
    log = D.session_log(spark, sf_dir)
    odd = U.session_state(None, log.filter("seq % 2 = 1"))
    return U.session_state(odd, log.filter("seq % 2 = 0"))


# Responses go to users u0..u149: one per comment author, so that both kinds of user occur.
_RESPONSES = f"""{D.COMMENTS_CTE}, responses AS (SELECT replace(author, 'ser', '') AS user_id, subreddit AS keyword1,
    score / 100.0::DOUBLE AS value1, abs(score) AS total1, label AS keyword2, -1.0::DOUBLE AS value2,
    0::BIGINT AS total2, id AS timestamp FROM comments)"""
_SHOWN = "keyword1, value1, total1, keyword2, value2, total2, timestamp"


def _responses(spark, sf_dir):
    return D.comments(spark, sf_dir).selectExpr(
        "replace(author, 'ser', '') AS user_id", "subreddit AS keyword1", "score / CAST(100.0 AS DOUBLE) AS value1",
        "abs(score) AS total1", "label AS keyword2", "CAST(-1.0 AS DOUBLE) AS value2", "0L AS total2", "id AS timestamp",
    )


@query("active_session_results", f"{_LOG}, {_LIVE}, {_RESPONSES} SELECT * FROM responses SEMI JOIN live USING (user_id)")
def _active(spark, sf_dir):
    live = U.latest_session_per_user(D.session_log(spark, sf_dir))
    return U.active_session_results(_responses(spark, sf_dir), live)


@query("dashboard_record", f"WITH {_RESPONSES} SELECT {_SHOWN} FROM responses")
def _dashboard(spark, sf_dir):
    return U.dashboard_record(_responses(spark, sf_dir))


@query("route_responses", f"{_LOG}, {_LIVE}, {_RESPONSES} SELECT user_id, {_SHOWN} FROM responses SEMI JOIN live USING (user_id)")
def _route(spark, sf_dir):
    live = U.latest_session_per_user(D.session_log(spark, sf_dir))
    return U.route_responses(_responses(spark, sf_dir), live)


@query("request_join_response", f"""{_LOG}, {_LIVE}, {_RESPONSES}
    SELECT user_id, r.keyword1, r.value1, r.total1, l.started_utc, l.keyword1 AS asked1, l.keyword2 AS asked2
    FROM responses r JOIN live l USING (user_id)""")
def _join_response(spark, sf_dir):
    live = U.latest_session_per_user(D.session_log(spark, sf_dir)).selectExpr(
        "user_id", "started_utc", "keyword1 AS asked1", "keyword2 AS asked2"
    )
    responses = _responses(spark, sf_dir).select("user_id", "keyword1", "value1", "total1")
    return U.request_join_response(responses, live)


@query("request_heartbeat", f"""{_LOG}, spans AS (SELECT *,
      coalesce(lead(event_utc) OVER (PARTITION BY user_id ORDER BY seq), (SELECT max(event_utc) FROM session_log)) AS ended
      FROM session_log)
    SELECT user_id, keyword1, keyword2, seq AS session_seq, event_utc + 600 * beat AS request_utc
    FROM (SELECT *, unnest(range(0, greatest(1, (ended - event_utc + 599) // 600))) AS beat
          FROM spans WHERE action = 'start' AND event_utc <= ended)""")
def _heartbeat(spark, sf_dir):
    """Up to the last event of the whole log."""
    log = D.session_log(spark, sf_dir)
    last = log.agg(F.max("event_utc")).first()[0]
    return U.request_heartbeat(log, last or 0, every_seconds=600)


@query("restart_series", f"""{_LOG} SELECT *, CAST(sum(CASE action WHEN 'start' THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY seq) AS BIGINT) AS session_no FROM session_log""")
def _restart(spark, sf_dir):
    return U.restart_series(D.session_log(spark, sf_dir))


_SERIES_SQL = """series AS (SELECT user_id, seq AS window_no, session_no, CASE WHEN seq % 4 = 0 THEN -1.0
      ELSE (seq % 9) / 8.0 END AS value1, seq % 5 AS total1, CASE WHEN seq % 3 = 0 THEN -1.0
      ELSE (seq % 7) / 6.0 END AS value2, seq % 2 AS total2 FROM numbered)"""
_NUMBERED = """numbered AS (SELECT *, CAST(sum(CASE action WHEN 'start' THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY seq) AS BIGINT) AS session_no FROM session_log)"""


def _series(spark, sf_dir):
    return U.restart_series(D.session_log(spark, sf_dir)).selectExpr(
        "user_id", "seq AS window_no", "session_no",
        "CASE WHEN seq % 4 = 0 THEN -1.0D ELSE (seq % 9) / 8.0D END AS value1", "seq % 5 AS total1",
        "CASE WHEN seq % 3 = 0 THEN -1.0D ELSE (seq % 7) / 6.0D END AS value2", "seq % 2 AS total2",
    )


def _running(i: int) -> str:
    counts = f"value{i} <> -1 AND total{i} > 0"
    over = "OVER (PARTITION BY user_id, session_no ORDER BY window_no)"
    weighted = f"sum(CASE WHEN {counts} THEN value{i} * total{i} END) {over}"
    return f"round({weighted} / sum(CASE WHEN {counts} THEN total{i} END) {over} * 100, 6) AS avg{i}"


@query("cumulative_positivity", f"""{_LOG}, {_NUMBERED}, {_SERIES_SQL}
    SELECT user_id, window_no, session_no, {_running(1)}, {_running(2)} FROM series""")
def _cumulative(spark, sf_dir):
    averaged = U.cumulative_positivity(_series(spark, sf_dir), ["user_id", "session_no"])
    return averaged.select(
        "user_id", "window_no", "session_no", F.round("avg1", 6).alias("avg1"), F.round("avg2", 6).alias("avg2")
    )


@query("last_100_points", f"""{_LOG} SELECT user_id, seq AS window_no FROM session_log
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY seq DESC) <= 100""")
def _last_points(spark, sf_dir):
    series = D.session_log(spark, sf_dir).selectExpr("user_id", "seq AS window_no")
    return U.last_points(series, ["user_id"])


_INDEXED = f"""WITH {D.COMMENTS_CTE}, indexed AS (SELECT created_utc,
    row_number() OVER (ORDER BY created_utc, CAST(id AS BIGINT)) - 1 AS seq FROM comments),
  marked AS (SELECT *, sum(CASE WHEN created_utc <> before THEN 1 ELSE 0 END) OVER (ORDER BY seq) AS batch_no
    FROM (SELECT *, lag(created_utc) OVER (ORDER BY seq) AS before FROM indexed)),
  batches AS (SELECT CAST(batch_no AS BIGINT) AS batch_no, created_utc, count(*) AS batch_size, min(seq) AS first_seq
    FROM marked GROUP BY ALL)"""


def _batches(spark, sf_dir):
    comments = D.comments(spark, sf_dir).select("id", "created_utc")
    return Q.same_second_batches(Q.with_global_index(comments, KQ.arrival_order()))


@query("same_second_batches", f"{_INDEXED} SELECT * FROM batches")
def _same_second(spark, sf_dir):
    return _batches(spark, sf_dir)


@query("replay_schedule", f"""{_INDEXED}, delayed AS (SELECT *,
      greatest(coalesce((created_utc - lag(created_utc) OVER (ORDER BY batch_no)) / 4.0, 0), 0) AS delay_seconds FROM batches)
    SELECT *, round(sum(delay_seconds) OVER (ORDER BY batch_no), 6) AS due_seconds FROM
      (SELECT batch_no, created_utc, batch_size, first_seq, CAST(delay_seconds AS DOUBLE) AS delay_seconds FROM delayed)""")
def _replay(spark, sf_dir):
    schedule = Q.replay_schedule(_batches(spark, sf_dir), speed=4.0)
    return schedule.withColumn("due_seconds", F.round("due_seconds", 6))


@query("paced_replay", f"""{_INDEXED.split(", marked AS", 1)[0].split("marked AS", 1)[0].rstrip().rstrip(",")}
    SELECT seq, created_utc, round((created_utc - min(created_utc) OVER ()) / 4.0, 6) AS due_seconds,
      CAST(floor((created_utc - min(created_utc) OVER ()) / 4.0 / 60) AS BIGINT) AS slice_no FROM indexed""")
def _paced(spark, sf_dir):
    comments = D.comments(spark, sf_dir).select("id", "created_utc")
    paced = Q.paced_replay(Q.with_global_index(comments, KQ.arrival_order()), speed=4.0, interval_seconds=60)
    return paced.select("seq", "created_utc", F.round("due_seconds", 6).alias("due_seconds"), "slice_no")
