"""User sessions, their requests, and the series each user sees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatterlens import schemas as S
from chatterlens.functions.labels import sanitize_score, to_numeric
from chatterlens.operators.joins import sized_join
from chatterlens.operators.records import dashboard_record
from chatterlens.operators.sequence import neighbours, running_sums


def latest_session_per_user(log: DataFrame) -> DataFrame:
    """Live sessions: a start replaces the user's session, a stop removes it.

    One aggregation with map-side combine, so a busy user costs one row per task.
    """
    newest = F.max(F.struct("seq", "action", "keyword1", "keyword2", "event_utc"))
    latest = log.groupBy("user_id").agg(newest.alias("_new"))
    return latest.filter("_new.action = 'start'").select(
        "user_id", "_new.keyword1", "_new.keyword2", F.col("_new.event_utc").alias("started_utc")
    )


def session_state(state: DataFrame | None, log: DataFrame) -> DataFrame:
    """Fold new log rows into the last known event of each user; stops are remembered."""
    newest = F.max(F.struct("seq", "action", "keyword1", "keyword2", "event_utc"))
    columns = ["user_id", "seq", "action", "keyword1", "keyword2", "event_utc"]
    rows = log.select(*columns)
    merged = rows if state is None else state.select(*columns).unionByName(rows)
    return merged.groupBy("user_id").agg(newest.alias("_new")).select("user_id", "_new.*")


def session_intervals(log: DataFrame) -> DataFrame:
    """Each start with the time of the user's next event; NULL while it is still live."""
    followed = neighbours(log, ["user_id"], "seq", {"ended_utc": "event_utc"}, step=1)
    return followed.filter("action = 'start'").withColumnRenamed("event_utc", "started_utc").drop("action")


def request_heartbeat(
    log: DataFrame, until_utc: int, every_seconds: int = S.HEARTBEAT_SECONDS
) -> DataFrame:
    """The requests a session repeats from its start until it ends or ``until_utc`` comes."""
    end = F.least(F.coalesce("ended_utc", F.lit(until_utc)), F.lit(until_utc))
    spans = session_intervals(log).withColumn("_end", end).filter(F.col("started_utc") <= F.col("_end"))
    # The first request goes out at once, each later one only if the session still lives.
    beats = F.sequence(F.lit(0).cast("bigint"), F.greatest(
        F.lit(0).cast("bigint"),
        F.ceil((F.col("_end") - F.col("started_utc")) / F.lit(every_seconds)) - 1))
    repeated = spans.withColumn("_beat", F.explode(beats))
    return repeated.select(
        "user_id", "keyword1", "keyword2", F.col("seq").alias("session_seq"),
        (F.col("started_utc") + F.col("_beat") * F.lit(every_seconds)).alias("request_utc"),
    )


def active_session_results(responses: DataFrame, sessions: DataFrame) -> DataFrame:
    """Only the responses whose user has a live session."""
    return sized_join(responses, sessions.select("user_id"), ["user_id"], "left_semi")


def request_join_response(responses: DataFrame, requests: DataFrame) -> DataFrame:
    """Each response beside the request of the user it goes back to."""
    return sized_join(responses, requests, ["user_id"], "inner")


def route_responses(responses: DataFrame, sessions: DataFrame) -> DataFrame:
    """What each live user is sent: the dashboard record under the user's id."""
    live = active_session_results(responses, sessions)
    return live.select("user_id", *dashboard_record(live).columns)


def restart_series(log: DataFrame) -> DataFrame:
    """Number the log's rows by session: a user's running count of starts."""
    is_start = (F.col("action") == "start").cast("bigint")
    return running_sums(log, ["user_id"], "seq", {"session_no": is_start})


def _weighted(value: Column, total: Column) -> tuple[Column, Column]:
    counts = value.isNotNull() & (F.coalesce(total, F.lit(0.0)) > 0)
    return F.when(counts, value * total), F.when(counts, total)


def cumulative_positivity(series: DataFrame, keys: list[str], order: str = "window_no") -> DataFrame:
    """Running average in percent, weighted by total; NULL until the first match of the series."""
    sums = {}
    for i in (1, 2):
        value = sanitize_score(F.col(f"value{i}").cast("string"))
        total = to_numeric(F.col(f"total{i}").cast("string"))
        sums[f"_p{i}"], sums[f"_t{i}"] = _weighted(value, total)
    summed = running_sums(series, keys, order, sums)
    averages = {
        f"avg{i}": F.try_divide(F.col(f"_p{i}"), F.col(f"_t{i}")) * F.lit(100.0) for i in (1, 2)
    }
    return summed.withColumns(averages).drop("_p1", "_t1", "_p2", "_t2")


def last_points(
    series: DataFrame, keys: list[str], order: str = "window_no", k: int = S.SERIES_POINTS
) -> DataFrame:
    """The newest ``k`` points of each series; Spark limits each task's rows before the shuffle."""
    newest = W.partitionBy(*keys).orderBy(F.col(order).desc())
    ranked = series.withColumn("_rank", F.row_number().over(newest))
    return ranked.filter(F.col("_rank") <= k).drop("_rank")
