"""Keyword windows over a stream of labelled comments.

The comments of a micro-batch are numbered after those of all earlier ones, so the
windows cut across batches as they would across one long list. Every batch is
reduced to a few counts per keyword before anything is kept: the state is the
counts of the one open window, the number of comments so far, and the requests.
All of it is kept per batch, so a replayed batch finds the state it started from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chatterlens import schemas as S
from chatterlens.functions.labels import epoch_to_iso
from chatterlens.functions.text import clean_text
from chatterlens.operators import keywords as K
from chatterlens.operators import training as M
from chatterlens.operators import validate as V
from chatterlens.operators.records import json_values
from chatterlens.operators.sequence import COMMENT_ORDER, index_and_count, whole_part
from chatterlens.session import durable
from chatterlens.sources.models import ModelStore, ReloadingModel
from chatterlens.sources.results import BatchTable
from chatterlens.sources.streams import Topic, source, write_values
from chatterlens.streaming.jobs import _each_batch

COUNTS = "positive bigint, neutral bigint, total bigint"


def named_rows(batch: DataFrame) -> DataFrame:
    """Add ``_at``: a row's place in its micro-batch, which stays the same however often the batch is read."""
    return batch.withColumn("_at", F.monotonically_increasing_id())


class KeywordWindows:
    """State and step of the keyword job; ``process`` takes labelled JSON values.

    A request seen when a micro-batch starts applies to all of it. With
    ``reset_on_request`` a repeated request starts its user's counts anew, otherwise
    a user's counts run from the user's first request for as long as the window is open. State of more than
    ``keep`` batches ago is removed.
    """

    def __init__(
        self, spark: SparkSession, state_dir: str, n: int = S.WINDOW_COMMENTS, reset_on_request: bool = True,
        keep: int = S.STATE_BATCHES,
    ):
        self.spark, self.n, self.reset, self.keep = spark, n, reset_on_request, keep
        self.requests = BatchTable(
            spark, f"{state_dir}/requests",
            "user_id string, keyword1 string, keyword2 string, request_time string, asked bigint, first_asked bigint",
        )
        self.progress = BatchTable(
            spark, f"{state_dir}/progress", "total bigint, marks array<struct<upto: bigint, at: bigint>>"
        )
        self.open_counts = BatchTable(
            spark, f"{state_dir}/open", f"window_no bigint, keyword string, from_seq bigint, {COUNTS}"
        )
        self.responses = BatchTable(
            spark, f"{state_dir}/responses",
            "window_no bigint, user_id string, keyword1 string, value1 double, total1 bigint, "
            "keyword2 string, value2 double, total2 bigint, timestamp string",
        )

    def add_requests(self, batch: DataFrame, batch_id: int) -> None:
        """Fold the batch's valid requests into the newest request of every user.

        Each state holds all users, so only the last one is ever read.
        """
        valid = V.route_by_type(V.valid_keyword_request(batch.select("value")), "request").drop("value")
        asked = [F.lit(batch_id).cast("bigint").alias(c) for c in ("asked", "first_asked")]
        known = self.requests.read_batch(batch_id - 1).unionByName(valid.select("*", *asked))
        newest = F.max(F.struct("asked", "request_time", "keyword1", "keyword2")).alias("_r")
        folded = known.groupBy("user_id").agg(newest, F.min("first_asked").alias("first_asked"))
        self.requests.write(folded.select("user_id", "_r.*", "first_asked"), batch_id)
        self.requests.forget(batch_id - self.keep)

    def _active(self, upto: int, marks: list[tuple[int, int]]) -> DataFrame:
        """Each user's request in force, with the number of the first comment it counts.

        ``marks`` says which request batches were first seen at which comment, for as
        long as the open window lasts; older ones count from the window's start.
        """
        batch = F.col("asked" if self.reset else "first_asked")
        at = F.lit(0).cast("bigint")
        for seen_upto, seen_at in marks:
            at = F.when(batch > F.lit(seen_upto), F.lit(seen_at).cast("bigint")).otherwise(at)
        return self.requests.read_batch(upto).select("user_id", "keyword1", "keyword2", at.alias("at"))

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """A micro-batch of labelled JSON values."""
        comments = V.route_by_type(V.valid_labeled_comment(named_rows(batch)), "comment").drop("value")
        self.process_comments(comments, batch_id)

    def process_comments(self, comments: DataFrame, batch_id: int) -> None:
        """A micro-batch of labelled comments, typed, with the row names of ``named_rows``."""
        before = self.progress.read_batch(batch_id - 1).first()
        if before is None and batch_id > 0:
            raise RuntimeError(f"the progress of batch {batch_id - 1} is gone; counting from 0 again would be wrong")
        total = before.total if before else 0
        marks = [(m.upto, m.at) for m in before.marks] if before else []
        upto = self.requests.newest_batch()
        # A request batch above a mark was first seen when the following mark was set.
        seen_at = [at for _, at in marks[1:]] + [total]
        active = self._active(upto, [(m[0], at) for m, at in zip(marks, seen_at)])

        by_offset = ["timestamp", "partition", "offset"] if "offset" in comments.columns else COMMENT_ORDER
        keys = comments.select(*dict.fromkeys(["_at", "created_utc", *by_offset]))
        numbered, arrived = index_and_count(keys, [*by_offset, "_at"], "_local")
        placed = numbered.withColumn("seq", F.col("_local") + F.lit(total))
        windows = placed.select("_at", "created_utc", "seq", whole_part("seq", self.n).alias("window_no"))
        first_closed, next_open = total // self.n, (total + arrived) // self.n

        matches = K.window_matches(comments, K.distinct_keywords(active), windows, ["_at"])
        fresh = K.keyword_label_counts(matches, ["window_no", "keyword"]).select(
            "window_no", "keyword", F.lit(total).cast("bigint").alias("from_seq"), "positive", "neutral", "total"
        )
        counts = self.open_counts.read_batch(batch_id - 1).unionByName(fresh)
        if next_open > first_closed:
            counts = durable(counts)  # read by the responses and by the open state
            self.responses.write(self._respond(windows, counts, active, first_closed, next_open), batch_id)
        self.open_counts.write(counts.filter(F.col("window_no") >= next_open), batch_id)
        # Written last: without it the batch has not happened.
        row = [(total + arrived, self._kept_marks([*marks, (upto, total)], next_open * self.n))]
        self.progress.write(self.spark.createDataFrame(row, self.progress.schema).coalesce(1), batch_id)
        for table in (self.progress, self.open_counts):
            table.forget(batch_id - self.keep)

    @staticmethod
    def _kept_marks(marks: list[tuple[int, int]], window_start: int) -> list[tuple[int, int]]:
        """The marks within the open window, and the last one before it."""
        older = [m for m in marks if m[1] < window_start]
        return older[-1:] + [m for m in marks if m[1] >= window_start]

    def _respond(
        self, windows: DataFrame, counts: DataFrame, active: DataFrame, first: int, past: int
    ) -> DataFrame:
        closed = F.explode(F.sequence(F.lit(first).cast("bigint"), F.lit(past - 1).cast("bigint")))
        users = active.withColumn("window_no", closed)
        sides = F.explode(F.array(*[
            F.struct(F.lit(i).alias("slot"), F.col(f"keyword{i}").alias("keyword")) for i in (1, 2)
        ]))
        slots = users.withColumn("_s", sides).select("window_no", "user_id", "at", "_s.*")
        joined = slots.join(counts, ["window_no", "keyword"], "left").filter(
            F.col("from_seq").isNull() | (F.col("from_seq") >= F.col("at"))
        )
        summed = joined.groupBy("window_no", "user_id").agg(*[
            F.coalesce(F.sum(F.when(F.col("slot") == i, F.col(c))), F.lit(0)).alias(f"{c}{i}")
            for i in (1, 2) for c in ("positive", "neutral", "total")
        ])
        ends = windows.groupBy("window_no").agg(F.max_by("created_utc", "seq").alias("last_utc"))
        whole = users.join(summed, ["window_no", "user_id"], "left").join(ends, "window_no")

        def value(i: int):
            zero = F.lit(0)
            return K.positivity_score(*[F.coalesce(f"{c}{i}", zero) for c in ("positive", "neutral", "total")])

        return whole.select(
            "window_no", "user_id",
            "keyword1", value(1).alias("value1"), F.coalesce("total1", F.lit(0)).alias("total1"),
            "keyword2", value(2).alias("value2"), F.coalesce("total2", F.lit(0)).alias("total2"),
            F.coalesce(epoch_to_iso(F.col("last_utc")), F.lit("-1")).alias("timestamp"),
        )


def request_stream(
    spark: SparkSession, requests: Topic, job: KeywordWindows, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    return _each_batch(source(spark, requests), job.add_requests, checkpoint, available_now)


def keyword_stream(
    spark: SparkSession, labeled: Topic, job: KeywordWindows, checkpoint: str,
    responses: Topic | None = None, available_now: bool = False, per_trigger: int | None = None,
) -> StreamingQuery:
    """Run the keyword job; with ``responses`` the closed windows are also sent on as JSON."""

    def step(batch: DataFrame, batch_id: int) -> None:
        job.process(batch, batch_id)
        if responses is None:
            return
        write_values(json_values(job.responses.read_batch(batch_id).drop("window_no")), responses, batch_id)

    return _each_batch(source(spark, labeled, per_trigger), step, checkpoint, available_now)


def fused_stream(
    spark: SparkSession, raw: Topic, job: KeywordWindows, store: ModelStore, checkpoint: str,
    responses: Topic | None = None, available_now: bool = False, reload_seconds: float = S.RELOAD_SECONDS,
    per_trigger: int | None = None, **bounds,
) -> StreamingQuery:
    """Raw lines to responses in one query: one plan, one checkpoint and one commit per micro-batch, no hops.

    Validation, cleaning and labelling are columns of the batch that the windows count; the model is picked up per batch.
    """
    model = ReloadingModel(store, reload_seconds)

    def step(batch: DataFrame, batch_id: int) -> None:
        current = model.get()
        lines = V.parse_json_lines(named_rows(batch), S.RAW_COMMENT).filter("is_json AND has_fields")
        valid = V.valid_comments(lines, **bounds).drop("value", "is_json", "has_fields")
        cleaned = valid.withColumn("cleaned_body", clean_text(F.col("body"))).drop("body")
        job.process_comments(M.predict_label(cleaned, current.vectorizer, current.classifier), batch_id)
        if responses is not None:
            write_values(json_values(job.responses.read_batch(batch_id).drop("window_no")), responses, batch_id)

    return _each_batch(source(spark, raw, per_trigger), step, checkpoint, available_now)
