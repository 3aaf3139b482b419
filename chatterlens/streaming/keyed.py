"""Keyword counts in Spark's own state store: one small state per (window, keyword).

The comments carry their arrival number, as a topic of one partition gives it by its offset. That number is the
stream's clock: a window of ``n`` comments is over when the number of comments so far has passed its end, which is what the
watermark tells, so no counter, no version of a table and no key that all comments share is needed. Every task
adds up its own matches first; only sums reach a state, and a closed window's state is removed as it is sent out.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from chatterlens import schemas as S
from chatterlens.operators import keywords as K
from chatterlens.operators.sequence import whole_part

SUMS = ["positive", "neutral", "total"]
PARTIAL = "window_no long, keyword string, positive long, neutral long, total long"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_state_store(spark: SparkSession) -> None:
    """Timers and keyed state need the RocksDB state store; a session that names another keeps it and will be refused by Spark."""
    if "RocksDB" not in spark.conf.get(PROVIDER, ""):
        spark.conf.set(PROVIDER, ROCKS)


def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The sums of a task's own matches, one row per window and keyword and batch of rows."""
    for batch in batches:
        if len(batch):
            yield batch.groupby(["window_no", "keyword"], as_index=False, sort=False)[SUMS].sum()


class WindowCounts(StatefulProcessor):
    """Adds sums to the state of their window and keyword, and sends the state out once its window is over."""

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getValueState("counts", "positive long, neutral long, total long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self.counts.exists()
        sums = list(self.counts.get()) if known else [0, 0, 0]
        for batch in rows:
            sums = [a + int(batch[c].sum()) for a, c in zip(sums, SUMS)]
        self.counts.update(tuple(sums))
        if not known:
            self.handle.registerTimer((key[0] + 1) * self.n * 1000)
        yield pd.DataFrame(columns=["window_no", "keyword", *SUMS])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        sums = self.counts.get()
        self.counts.clear()
        yield pd.DataFrame([[*key, *sums]], columns=["window_no", "keyword", *SUMS])

    def close(self) -> None:
        pass


def window_counts(
    comments: DataFrame, requests: DataFrame, n: int = S.WINDOW_COMMENTS, seq: str = "seq", body: str = "cleaned_body"
) -> DataFrame:
    """``window_no, keyword, positive, neutral, total`` of every window that is over, from a stream of labelled comments.

    ``seq`` numbers the comments from 0 in arrival order. Windows without a match of a keyword have no row.
    """
    use_state_store(comments.sparkSession)
    clocked = comments.withColumn("_clock", F.timestamp_seconds(F.col(seq) + 1)).withWatermark("_clock", "0 seconds")
    matches = K.keyword_matches(clocked, K.distinct_keywords(requests), body, kept=[seq, "label", "_clock"])
    one = [F.col("label").eqNullSafe(name).cast("long").alias(name) for name in SUMS[:2]]
    placed = matches.select(whole_part(seq, n).alias("window_no"), "keyword", *one, F.lit(1).cast("long").alias("total"))
    sums = placed.mapInPandas(add_up, PARTIAL)
    return sums.groupBy("window_no", "keyword").transformWithStateInPandas(
        statefulProcessor=WindowCounts(n), outputStructType=PARTIAL, outputMode="Append", timeMode="EventTime"
    )
