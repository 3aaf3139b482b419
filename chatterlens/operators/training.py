"""Splits, classifiers, prediction and the classification report."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel, NaiveBayes, NaiveBayesModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatterlens import schemas as S
from chatterlens.functions.labels import decode_label, encode_label
from chatterlens.operators.features import Vectorizer, vector_entries
from chatterlens.session import durable

N_CLASSES = len(S.LABELS)


def with_class(labeled: DataFrame) -> DataFrame:
    """Add ``label_class`` and drop rows whose label has none."""
    return labeled.withColumn("label_class", encode_label(F.col("label"))).filter("label_class IS NOT NULL")


def chunk_split(
    chunked: DataFrame, train: list[int] = S.TRAIN_CHUNKS, test: list[int] = S.TEST_CHUNKS
) -> tuple[DataFrame, DataFrame]:
    """Whole chunks to train and test on; on stored chunks only theirs are read."""
    chunk = F.col("chunk_id")
    return chunked.filter(chunk.isin(*train)), chunked.filter(chunk.isin(*test))


def stratified_split(df: DataFrame, test_share: float = 0.2, key: str = "id", label: str = "label") -> DataFrame:
    """Mark the exact share of each label, chosen by hashed key, with ``is_test``.

    Ranking a whole label in one task would not scale. Rows are counted per label and
    hash prefix, the prefix in which the share is reached is found on those counts,
    and only the rows of that one prefix are ranked.
    """
    hashed = df.withColumn("_hash", F.md5(F.col(key).cast("string")))
    hashed = hashed.withColumn("_prefix", F.substring("_hash", 1, 4))
    counts = hashed.groupBy(label, "_prefix").agg(F.count("*").alias("_n"))
    so_far = W.partitionBy(label).orderBy("_prefix").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(so_far), F.lit(0))
    wanted = F.round(F.sum("_n").over(W.partitionBy(label)) * F.lit(test_share)).cast("bigint")
    reach = counts.select(label, "_prefix", "_n", before.alias("_before"), wanted.alias("_wanted"))
    cut = reach.filter((F.col("_before") < F.col("_wanted")) & (F.col("_before") + F.col("_n") >= F.col("_wanted")))
    # One row per label.
    edges = cut.select(label, F.col("_prefix").alias("_edge"), (F.col("_wanted") - F.col("_before")).alias("_room"))
    marked = hashed.join(F.broadcast(edges), label, "left")
    at_edge = F.col("_prefix") == F.col("_edge")
    ranked = marked.filter(at_edge).withColumn(
        "_rank", F.row_number().over(W.partitionBy(label).orderBy("_hash", key))
    )
    inside = ranked.withColumn("is_test", F.col("_rank") <= F.col("_room")).drop("_rank")
    outside = marked.filter(~F.coalesce(at_edge, F.lit(False))).withColumn(
        "is_test", F.coalesce(F.col("_prefix") < F.col("_edge"), F.lit(False))
    )
    return outside.unionByName(inside).drop("_hash", "_prefix", "_edge", "_room")


def train_logreg(
    rows: DataFrame, features: str = "features", label: str = "label_class", max_iter: int = 300
) -> LogisticRegressionModel:
    """Multinomial logistic regression whose penalty weighs the summed loss as C = 1 does."""
    n = rows.count()
    return LogisticRegression(
        featuresCol=features, labelCol=label, family="multinomial", maxIter=max_iter, tol=1e-4,
        regParam=1.0 / max(n, 1), elasticNetParam=0.0, standardization=False,
    ).fit(rows)


def logreg_certificate(
    rows: DataFrame, model: LogisticRegressionModel, features: str = "features", label: str = "label_class"
) -> DataFrame:
    """One row: how far the fitted weights are from the optimum of the penalised loss (C = 1).

    The objective is the summed log loss plus half the squared weights; at its minimum the gradient is zero. Residuals
    times features are summed per class and feature in one aggregation over all rows, the penalty's part is added from the weights.
    ``gradient_norm`` is per row, ``gap_bound`` bounds loss above the minimum per row: the objective is strongly convex
    in the weights with modulus 1, so it lies at most half the squared gradient above it (intercepts, unpenalised, have their own norm).
    """
    n = rows.count()
    weights, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    classes = range(len(intercepts))
    probability = F.unwrap_udt(F.col("probability"))["values"]
    scored = model.transform(rows.select(features, label))
    residuals = F.array(*[F.get(probability, F.lit(c)) - (F.col(label) == c).cast("double") for c in classes])
    one = F.array(F.struct(F.lit(-1).alias("idx"), F.lit(1.0).alias("weight")))
    entries = F.concat(vector_entries(F.col(features)), one)
    spread = scored.select(residuals.alias("_residuals"), entries.alias("_entries"))
    spread = spread.select(F.posexplode("_residuals").alias("c", "residual"), "_entries")
    spread = spread.select("c", "residual", F.explode("_entries").alias("_e"))
    summed = spread.groupBy("c", "_e.idx").agg(F.sum(F.col("residual") * F.col("_e.weight")).alias("g"))
    # classes times features, a size set by the vocabulary
    own = [(c, int(i), float(weights[c, i])) for c in classes for i in range(weights.shape[1])]
    penalty = rows.sparkSession.createDataFrame(own, "c int, idx int, w double")
    gradient = summed.join(penalty, ["c", "idx"], "full").select(
        "idx", (F.coalesce("g", F.lit(0.0)) + F.coalesce("w", F.lit(0.0))).alias("g")
    )

    def norm(which: Column) -> Column:
        return F.sqrt(F.coalesce(F.sum(F.when(which, F.col("g") * F.col("g"))), F.lit(0.0)))

    weight_norm, intercept_norm = norm(F.col("idx") >= 0), norm(F.col("idx") < 0)
    return gradient.agg(
        F.lit(n).cast("bigint").alias("n"), (weight_norm / max(n, 1)).alias("gradient_norm"),
        (intercept_norm / max(n, 1)).alias("intercept_norm"), (weight_norm * weight_norm / 2 / max(n, 1)).alias("gap_bound"),
    )


def train_naive_bayes(
    rows: DataFrame, features: str = "features", label: str = "label_class"
) -> NaiveBayesModel:
    return NaiveBayes(featuresCol=features, labelCol=label, modelType="multinomial", smoothing=1.0).fit(rows)


def naive_bayes_sums(rows: DataFrame, features: str = "features") -> DataFrame:
    """Summed weight per class and feature. Sums of chunks add up, so training is incremental."""
    entries = rows.select("label_class", F.explode(vector_entries(F.col(features))).alias("_e"))
    return entries.groupBy("label_class", F.col("_e.idx").alias("idx")).agg(F.sum("_e.weight").alias("weight"))


def merge_sums(*parts: DataFrame) -> DataFrame:
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged.groupBy("label_class", "idx").agg(F.sum("weight").alias("weight"))


def naive_bayes_log_probs(sums: DataFrame, n_features: int, smoothing: float = 1.0) -> DataFrame:
    """Smoothed log probability of each feature that occurs in a class."""
    # At most N_CLASSES rows.
    totals = sums.groupBy("label_class").agg(F.sum("weight").alias("_total"))
    ratio = (F.col("weight") + smoothing) / (F.col("_total") + smoothing * n_features)
    return sums.join(F.broadcast(totals), "label_class").select("label_class", "idx", F.log(ratio).alias("log_prob"))


@dataclass
class LinearModel:
    """One-vs-all log-loss classifier that keeps learning chunk by chunk.

    ``rate`` suits rows of unit length; after ``slowing`` steps it starts to fall with the root of their number.
    """

    n_features: int
    alpha: float = 1e-4
    seen: int = 0
    weights: np.ndarray = field(default=None)  # classes x (features + intercept)
    rate: float = 16.0
    slowing: float = 200.0
    batch_rows: int = 2

    def __post_init__(self):
        if self.weights is None:
            self.weights = np.zeros((N_CLASSES, self.n_features + 1))


def _flat(indices, values) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and value of every stored entry of a batch."""
    sizes = [len(i) for i in indices]
    rows = np.repeat(np.arange(len(sizes)), sizes)
    if not len(rows):
        return rows, np.zeros(0, np.int64), np.zeros(0)
    return rows, np.concatenate(list(indices)).astype(np.int64), np.concatenate(list(values))


def margins(weights: np.ndarray, indices, values) -> np.ndarray:
    """Classes by rows: the sparse product of a batch with the weights."""
    rows, at, value = _flat(indices, values)
    return np.array([np.bincount(rows, w[at] * value, len(indices)) + w[-1] for w in weights])


def gradient_sums(weights: np.ndarray, labels, indices, values) -> np.ndarray:
    """Summed gradient of the log losses over a batch."""
    rows, at, value = _flat(indices, values)
    sign = 2.0 * (np.arange(len(weights))[:, None] == np.asarray(labels)[None, :]) - 1.0
    slope = -sign / (1.0 + np.exp(np.clip(sign * margins(weights, indices, values), -500, 500)))
    return np.array([np.append(np.bincount(at, s[rows] * value, weights.shape[1] - 1), s.sum()) for s in slope])


def _entries(features: str) -> tuple[Column, Column]:
    inner = F.unwrap_udt(F.col(features))
    every = F.sequence(F.lit(0), F.size(inner["values"]) - 1)
    dense = F.when(F.size(inner["values"]) > 0, every).otherwise(F.array().cast("array<int>"))
    return F.coalesce(inner["indices"], dense), inner["values"]


FAN_IN = 32


def local_pass(model: LinearModel, labels, indices, values) -> LinearModel:
    """One warm-started pass of stochastic gradient steps over a batch of rows."""
    weights, size = model.weights, model.batch_rows
    for begin in range(0, len(labels), size):
        few = slice(begin, begin + size)
        n = len(labels[few])
        rate = model.rate / np.sqrt(1.0 + (model.seen + begin) / size / model.slowing)
        weights = weights - rate * (gradient_sums(weights, labels[few], indices[few], values[few]) / n + model.alpha * weights)
    return replace(model, weights=weights, seen=model.seen + len(labels))


def train_sgd_incremental(chunk: DataFrame, model: LinearModel, features: str = "features") -> LinearModel:
    """One pass over a chunk, starting from the model so far.

    Every task takes stochastic steps over its own rows; the tasks' weights are averaged, each weighed by its rows. The averages
    are formed in a tree: at most ``FAN_IN`` sets of weights meet in one task or on the driver, whose size is
    set by the vocabulary.
    """
    shared = chunk.sparkSession.sparkContext.broadcast(model)
    indices, values = _entries(features)
    rows = chunk.select("label_class", indices.alias("indices"), values.alias("values"))

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            own = local_pass(own, *(batch[c].to_numpy() for c in ("label_class", "indices", "values")))
        if n := own.seen - shared.value.seen:
            yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "n": [n], "weights": [(own.weights * n).tobytes()]})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n, part = 0.0, 0, 0
        for batch in batches:
            for row in batch.itertuples():
                total, n, part = total + np.frombuffer(row.weights), n + row.n, row.part // FAN_IN
        if n:
            yield pd.DataFrame({"part": [part], "n": [n], "weights": [total.tobytes()]})

    schema = "part long, n long, weights binary"
    sums = durable(rows.mapInPandas(learn, schema))
    last = sums.agg(F.max("part")).first()[0]
    while last is not None and last >= FAN_IN:
        last //= FAN_IN
        sums = durable(sums.repartition(last + 1, F.expr(f"part div {FAN_IN}L")).mapInPandas(add, schema))
    total, n = np.zeros(model.weights.size), 0
    for row in sums.orderBy("part").collect():  # at most FAN_IN
        total, n = total + np.frombuffer(row.weights), n + row.n
    shared.unpersist()
    if not n:
        return model
    return replace(model, seen=model.seen + n, weights=(total / n).reshape(model.weights.shape))


def linear_predictions(rows: DataFrame, model: LinearModel, features: str = "features") -> DataFrame:
    """Add the class with the largest margin as ``prediction``."""
    shared = rows.sparkSession.sparkContext.broadcast(model.weights)

    @F.pandas_udf("double")
    def best(indices: pd.Series, values: pd.Series) -> pd.Series:
        return pd.Series(margins(shared.value, indices, values).argmax(axis=0).astype(float))

    return rows.withColumn("prediction", best(*_entries(features)))


def predict_label(
    cleaned: DataFrame, vectorizer: Vectorizer, classifier, text: str = "cleaned_body"
) -> DataFrame:
    """Add the predicted ``label``; an empty text is ``unknown``."""
    scored = classifier.transform(vectorizer.transform(cleaned, text))
    empty = F.coalesce(F.col(text), F.lit("")) == ""
    label = F.when(empty, F.lit(S.UNKNOWN_LABEL)).otherwise(decode_label(F.col("prediction").cast("int")))
    return scored.select(*cleaned.columns, label.alias("label"))


def _f1(precision: Column, recall: Column) -> Column:
    return F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))


def classification_report(predictions: DataFrame, truth: str = "label", prediction: str = "predicted") -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    The data is reduced to its confusion counts at once; the rest works on those.
    """
    counts = predictions.groupBy(F.col(truth).alias("t"), F.col(prediction).alias("p")).agg(F.count("*").alias("n"))
    sides = counts.select(
        F.inline(F.array(
            F.struct(F.col("t").alias("name"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("claimed"),
                     F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(F.lit(0)).alias("hits")),
            F.struct(F.col("p").alias("name"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("claimed"),
                     F.lit(0).cast("bigint").alias("hits")),
        ))
    )
    summed = sides.groupBy("name").agg(*[F.sum(c).alias(c) for c in ("support", "claimed", "hits")])
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide(F.col("hits"), F.col("claimed")), zero)
    recall = F.coalesce(F.try_divide(F.col("hits"), F.col("support")), zero)
    classes = summed.select(
        "name", precision.alias("precision"), recall.alias("recall"), _f1(precision, recall).alias("f1"), "support", "hits"
    )
    measures = ["precision", "recall", "f1"]
    total = F.sum("support")
    accuracy = F.sum("hits") / total
    averages = classes.agg(
        F.array(
            F.struct(F.lit("accuracy").alias("name"), *[accuracy.alias(m) for m in measures], total.alias("support")),
            F.struct(F.lit("macro avg").alias("name"), *[F.avg(m).alias(m) for m in measures], total.alias("support")),
            F.struct(
                F.lit("weighted avg").alias("name"),
                *[(F.sum(F.col(m) * F.col("support")) / total).alias(m) for m in measures],
                total.alias("support"),
            ),
        ).alias("rows")
    ).select(F.inline("rows"))
    return classes.drop("hits").unionByName(averages)
