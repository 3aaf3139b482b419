"""Versioned store of a vectorizer with its classifier."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterlens import schemas as S
from chatterlens.operators.features import Vectorizer


@dataclass
class SentimentModel:
    version: int
    vectorizer: Vectorizer
    classifier: PipelineModel


class ModelStore:
    """Each version has its own folder; a version counts once it is in the log of published ones.

    The log is only ever appended to, and after the version's files are complete, so
    a reader sees the old version or the new one and never half of either.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _published(self) -> DataFrame | None:
        """The log of published versions; ``origin`` says what a version was made from, where that was given."""
        jvm, log = self.spark._jvm, f"{self.path}/published"
        location = jvm.org.apache.hadoop.fs.Path(log)
        files = location.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(location):
            return None
        return self.spark.read.schema("version int, published_at timestamp, origin string").parquet(log)

    def current_version(self) -> int | None:
        log = self._published()
        return None if log is None else log.agg(F.max("version")).first()[0]

    def version_of(self, origin: str) -> int | None:
        """The version that was published for ``origin``."""
        log = self._published()
        return None if log is None else log.filter(F.col("origin") == origin).agg(F.max("version")).first()[0]

    def publish(self, vectorizer: Vectorizer, classifier, origin: str | None = None) -> int:
        version = (self.current_version() or 0) + 1
        folder = f"{self.path}/versions/{version}"
        staged = classifier if isinstance(classifier, PipelineModel) else PipelineModel([classifier])
        staged.write().overwrite().save(f"{folder}/classifier")
        vectorizer.save(self.spark, f"{folder}/vectorizer")
        row = self.spark.range(1).select(
            F.lit(version).alias("version"), F.current_timestamp().alias("published_at"), F.lit(origin).cast("string").alias("origin")
        )
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/published")
        return version

    def load(self, version: int | None = None) -> SentimentModel:
        version = version or self.current_version()
        if version is None:
            raise FileNotFoundError(f"no model published in {self.path}")
        folder = f"{self.path}/versions/{version}"
        return SentimentModel(
            version, Vectorizer.load(self.spark, f"{folder}/vectorizer"), PipelineModel.load(f"{folder}/classifier")
        )


class ReloadingModel:
    """The current model, checked for a newer version at most every ``interval`` seconds."""

    def __init__(self, store: ModelStore, interval: float = S.RELOAD_SECONDS, clock=time.monotonic):
        self.store, self.interval, self.clock = store, interval, clock
        self.model: SentimentModel | None = None
        self.checked_at: float | None = None

    def get(self) -> SentimentModel:
        now = self.clock()
        if self.checked_at is None or now - self.checked_at >= self.interval:
            self.checked_at = now
            try:
                newest = self.store.current_version()
                if self.model is None or newest != self.model.version:
                    self.model = self.store.load(newest)
            except Exception:
                # A failed reload keeps the model in use; without one there is nothing to keep.
                if self.model is None:
                    raise
        return self.model
