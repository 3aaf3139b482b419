"""The streaming jobs: clean, label, route, trend and retrain.

Each is built from the same column functions and operators as the batch work.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from chatterlens import schemas as S
from chatterlens.functions.wordlists import EMOJI, SLANG
from chatterlens.operators import analytics as A
from chatterlens.operators import keywords as K
from chatterlens.operators import records as R
from chatterlens.operators import sessions as U
from chatterlens.operators import training as M
from chatterlens.operators import validate as V
from chatterlens.sources.models import ModelStore, ReloadingModel
from chatterlens.sources.results import BatchTable
from chatterlens.sources.streams import Topic, sink, source, write_values


def parsed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed columns from JSON values; a missing or ill-typed field is NULL."""
    return V.parse_json_lines(lines.select("value"), schema)


def clean_values(
    lines: DataFrame, slang: Mapping[str, str] = SLANG, emoji: Mapping[str, str] = EMOJI
) -> DataFrame:
    """Raw JSON values to cleaned JSON values, one for one; broken input gives an error record."""
    rows = parsed(lines, S.RAW_COMMENT)
    broken = V.object_keys(F.col("value")).isNull()
    record = F.struct(*R.cleaned_fields(slang, emoji))
    error = F.struct(F.lit("no JSON object").alias("error"), F.lit("").alias("cleaned_body"))
    return rows.select(F.when(broken, F.to_json(error)).otherwise(F.to_json(record)).alias("value"))


def clean_stream(
    spark: SparkSession, raw: Topic, cleaned: Topic, checkpoint: str, available_now: bool = False,
    per_trigger: int | None = None,
) -> StreamingQuery:
    """Raw to cleaned comments: stateless, any number of tasks."""
    return sink(clean_values(source(spark, raw, per_trigger)), cleaned, checkpoint, available_now=available_now)


INGEST = "ingest"


def ingest_values(lines: DataFrame, **bounds) -> DataFrame:
    """Raw lines to valid comments as JSON values; the run counts are observed on the way, in the same pass."""
    tagged = V.validate_comment(parsed(lines, S.RAW_COMMENT), from_json_lines=True, **bounds)
    counted = tagged.observe(INGEST, *A.ingest_counts())
    return R.json_values(V.keep_fields(counted.filter("is_valid")))


def ingest_stream(
    spark: SparkSession, dump: Topic, raw: Topic, checkpoint: str, available_now: bool = False,
    per_trigger: int | None = None, **bounds,
) -> StreamingQuery:
    """Lines of a dump to raw comments; ``ingest_progress`` tells the counts of each micro-batch."""
    return sink(ingest_values(source(spark, dump, per_trigger), **bounds), raw, checkpoint, available_now=available_now)


def ingest_progress(query: StreamingQuery) -> list[dict]:
    """Run counts of the micro-batches that the query remembers, with ``batch_id``.

    Spark keeps the last ``spark.sql.streaming.numRecentProgressUpdates`` of them; poll more often than that.
    """
    found = {}
    for progress in query.recentProgress:
        counts = (progress.get("observedMetrics") or {}).get(INGEST)
        if counts:
            counts = counts.asDict() if hasattr(counts, "asDict") else counts
            found[progress["batchId"]] = {"batch_id": progress["batchId"], **counts}
    return [found[k] for k in sorted(found)]


def label_values(lines: DataFrame, model) -> DataFrame:
    """Cleaned JSON values to labelled JSON values with one model, one for one.

    Broken input gives an error record. It has no id, so no later step counts it.
    """
    rows = parsed(lines, S.CLEANED_COMMENT).withColumn("_broken", V.object_keys(F.col("value")).isNull())
    text = F.coalesce(F.col("cleaned_body"), F.lit(""))
    rows = rows.drop("value", "is_json", "has_fields", "body").withColumn("cleaned_body", text)
    labeled = M.predict_label(rows, model.vectorizer, model.classifier)
    record, error = F.struct(*R.labeled_fields(F.col("label"))), F.struct(*R.error_fields())
    return labeled.select(F.when(F.col("_broken"), F.to_json(error)).otherwise(F.to_json(record)).alias("value"))


def label_stream(
    spark: SparkSession, cleaned: Topic, labeled: Topic, store: ModelStore, checkpoint: str,
    available_now: bool = False, reload_seconds: float = S.RELOAD_SECONDS, per_trigger: int | None = None,
) -> StreamingQuery:
    """Cleaned to labelled comments; each micro-batch uses the newest model it has seen."""
    model = ReloadingModel(store, reload_seconds)

    def label(batch: DataFrame, batch_id: int) -> None:
        write_values(label_values(batch, model.get()), labeled, batch_id)

    return _each_batch(source(spark, cleaned, per_trigger), label, checkpoint, available_now)


def _each_batch(stream: DataFrame, work, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{S.CHECKPOINT_SECONDS} seconds").start()


def route_stream(
    spark: SparkSession, responses: Topic, sessions: BatchTable | DataFrame, out: str, checkpoint: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Responses of live users, one folder per micro-batch, ordered by user; a replay replaces its whole folder."""

    def route(batch: DataFrame, batch_id: int) -> None:
        rows = parsed(batch, S.KEYWORD_RESPONSE).drop("value", "is_json", "has_fields")
        log = sessions.read_batch(sessions.newest_batch()) if isinstance(sessions, BatchTable) else sessions
        live = U.latest_session_per_user(log)
        routed = U.route_responses(rows, live).sortWithinPartitions("user_id")
        routed.write.mode("overwrite").json(f"{out}/batch_id={batch_id}")

    return _each_batch(source(spark, responses), route, checkpoint, available_now)


def trend_stream(
    spark: SparkSession, labeled: Topic, requests: DataFrame, delay: str = "10 minutes", width: str = "5 minutes"
) -> DataFrame:
    """Score per keyword and event-time window; a window comes out once the delay has passed."""
    comments = parsed(source(spark, labeled), S.LABELED_COMMENT).filter("has_fields")
    return K.keyword_trend(
        comments.select(*S.LABELED_COMMENT.fieldNames()), requests, width, watermark=delay
    )


class Retrainer:
    """Gathers labelled comments and trains a new classifier on each full batch of them.

    Rows go to a table first, apart by micro-batch, so that neither a replay nor a lost
    executor can count a row twice or drop it. A training takes all rows gathered.
    """

    def __init__(self, spark: SparkSession, store: ModelStore, state_dir: str, at_least: int = S.RETRAIN_ROWS):
        self.spark, self.store, self.at_least = spark, store, at_least
        self.gathered = BatchTable(spark, f"{state_dir}/gathered", "cleaned_body string, label string")
        self.trained = BatchTable(spark, f"{state_dir}/trained", "upto bigint, version int, n bigint")

    def pending(self) -> DataFrame:
        done = self.trained.read().agg(F.max("upto")).first()[0]
        rows = self.gathered.read()
        return rows if done is None else rows.filter(F.col("batch_id") > done)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        rows = parsed(batch, S.LABELED_COMMENT).select("cleaned_body", "label")
        self.gathered.write(R.drop_unlabeled(rows), batch_id)
        waiting = self.pending()
        n = waiting.count()
        if n < self.at_least:
            return
        # a replay after a failure between the two writes finds what it published before
        version = self.store.version_of(f"batch {batch_id}")
        if version is None:
            vectorizer = self.store.load().vectorizer
            model = M.train_logreg(M.with_class(vectorizer.transform(waiting)))
            version = self.store.publish(vectorizer, model, f"batch {batch_id}")
        mark = self.spark.createDataFrame([(batch_id, version, n)], self.trained.schema)
        self.trained.write(mark, batch_id)


def retrain_stream(
    spark: SparkSession, labeled: Topic, retrainer: Retrainer, checkpoint: str, available_now: bool = False,
    per_trigger: int | None = None,
) -> StreamingQuery:
    return _each_batch(source(spark, labeled, per_trigger), retrainer.process, checkpoint, available_now)


def session_stream(
    spark: SparkSession, calls: Topic, state: BatchTable, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Fold logged session events into the newest event of each user; each batch holds all users."""

    def fold(batch: DataFrame, batch_id: int) -> None:
        if batch_id > 0 and not state.has_batch(batch_id - 1):
            raise RuntimeError(f"the sessions of batch {batch_id - 1} are gone")
        state.write(U.session_state(state.read_batch(batch_id - 1), parsed(batch, S.SESSION_EVENT)), batch_id)
        state.forget(batch_id - S.STATE_BATCHES)

    return _each_batch(source(spark, calls), fold, checkpoint, available_now)


SESSION_COLUMNS = "user_id string, seq bigint, action string, keyword1 string, keyword2 string, event_utc bigint"
