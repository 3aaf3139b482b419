"""Language identification by sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, everything but letters becomes a space, and n-grams of 1 to ``ORDERS`` characters are
hashed into ``BUCKETS`` features, weighted by TF-IDF and scaled to unit length. The weights are learned
example by example with follow-the-regularised-leader and an elastic net, which leaves most of them at
exactly zero; a temperature fitted on held-back examples calibrates the probabilities.

The model is fitted on a bounded sample: for each language the ``SAMPLE`` eligible texts of at most ``SAMPLE_CHARS``
characters with the smallest hash of their id. Features of a prediction come from the whole text.

``predict(strict=True)`` also gives ``und`` to what resembles no learned language: a top probability, or a share of n-grams seen
in training, below the ``LOW`` quantile of the rightly classified held-back examples.

Defined results: ``und`` with score 0 for a null text and for a text without a letter; without any labelled text every
prediction is ``und``. Repeated rows get equal results. Other columns pass through; the two names this
module adds replace columns of the same name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chatterlens.llm import textnum

ORDERS = 3
BUCKETS = 1 << 14
SAMPLE = 600
SAMPLE_CHARS = 20_000
PARTS = 64
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.05
MIN_SCORE = 0.3
LOW = 0.0025
ROWS = 128


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the hashed n-grams, one row per text, and whether each text has a letter."""
    points, bounds = textnum.code_points(data, offsets)
    low, is_letter = textnum.letters(points)
    low = np.where(is_letter, low, 32).astype(np.uint32)
    grams, h = [], np.zeros(len(low), np.uint32)
    for order in range(1, ORDERS + 1):
        h = (h[: len(low) - order + 1] * np.uint32(0x01000193)) ^ (low[order - 1:] * np.uint32(0x9E3779B1))
        grams.append(((h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * order)) >> np.uint32(32 - 14))
    seen = np.concatenate([[0], np.cumsum(is_letter)])
    counts = np.zeros((len(bounds) - 1, BUCKETS), np.float64)
    for i in range(len(counts)):
        a, b = bounds[i], bounds[i + 1]
        if b > a:
            own = np.concatenate([g[a: max(a, b - order)] for order, g in enumerate(grams)])
            counts[i] = np.bincount(own, minlength=BUCKETS)
    return counts, seen[bounds[1:]] > seen[bounds[:-1]]


def row_groups(batch: pa.RecordBatch):
    """Chunks of at most ``ROWS`` texts, so that the dense counts stay small."""
    for at in range(0, len(batch), ROWS):
        yield from (x[2:] for x in textnum.text_chunks(batch.slice(at, ROWS), "text"))


def normed(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = counts * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, classes: int) -> np.ndarray:
    """Weights (``BUCKETS`` by classes) after ``EPOCHS`` passes over sparse rows (places, values)."""
    z, n = np.zeros((BUCKETS, classes)), np.zeros((BUCKETS, classes))

    def weights(zi, ni):
        return np.where(np.abs(zi) <= L1, 0.0, (np.sign(zi) * L1 - zi) / ((BETA + np.sqrt(ni)) / ALPHA + L2))

    order = np.random.Generator(np.random.PCG64(1))
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            at, value = rows[i]
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            p = softmax(value @ w)
            p[target[i]] -= 1
            g = value[:, None] * p
            z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
            n[at] = ni + g * g
    return weights(z, n)


def temperature(logits: np.ndarray, target: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, from a grid."""
    def loss(t):
        return -np.log(np.maximum(softmax(logits / t)[np.arange(len(target)), target], 1e-12)).mean()

    return float(min(np.geomspace(0.05, 10, 80), key=loss)) if len(target) else 1.0


class Model:
    def __init__(self, languages, idf, weights, heat, seen, least_score, least_known):
        self.languages, self.idf, self.weights, self.heat = languages, idf, weights, heat
        self.seen, self.least_score, self.least_known = seen, least_score, least_known

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return softmax(x @ self.weights / self.heat)

    def resembles(self, x: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Whether texts (normed rows and their probabilities) are like the learned languages."""
        return (p.max(axis=1) >= self.least_score) & ((x * x) @ self.seen >= self.least_known)


def fit(texts: list[str], languages: list[str]) -> Model | None:
    if not texts:
        return None
    names = sorted(set(languages))
    target = np.array([names.index(x) for x in languages])
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], ["text"])
    sparse, frequency = [], np.zeros(BUCKETS)
    for data, offsets in row_groups(batch):
        for row in features(data, offsets)[0]:
            at = np.flatnonzero(row)
            frequency[at] += 1
            sparse.append((at, row[at]))
    idf = np.log((1 + len(texts)) / (1 + frequency)) + 1
    rows = []
    for at, value in sparse:
        value = value * idf[at]
        rows.append((at, value / max(np.linalg.norm(value), 1e-12)))
    back = np.arange(len(rows)) % 5 == 4
    train = np.flatnonzero(~back)
    weights = ftrl([rows[i] for i in train], target[train], len(names))
    logits = np.array([rows[i][1] @ weights[rows[i][0]] for i in np.flatnonzero(back)]).reshape(-1, len(names))
    heat = temperature(logits, target[back])
    seen = np.zeros(BUCKETS)
    for i in train:
        seen[rows[i][0]] = 1
    p = softmax(logits / heat)
    known = np.array([(value * value) @ seen[at] for at, value in (rows[i] for i in np.flatnonzero(back))])
    right = p.argmax(axis=1) == target[back]
    least = [float(np.quantile(v[right], LOW)) - 1e-9 if right.any() else 0.0 for v in (p.max(axis=1), known)]
    return Model(names, idf, weights, heat, seen, max(least[0], MIN_SCORE), least[1])


def sample(docs: DataFrame, eligible: Column) -> DataFrame:
    """At most ``SAMPLE`` texts per language, chosen by a hash of the id.

    Ids are ranked within ``PARTS`` parts of a language first, so the task that ranks a language sees at most
    ``PARTS * SAMPLE`` of them. A repeated id gives one text per language, the least.
    """
    usable = docs.where(eligible & F.col("lang").isNotNull() & (F.length("text") <= SAMPLE_CHARS) & F.col("doc_id").isNotNull())
    chosen = usable.select("doc_id", "lang").withColumn("_part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)))
    for within in (["lang", "_part"], ["lang"]):
        first = Window.partitionBy(*within).orderBy(F.xxhash64("doc_id"), "doc_id")
        chosen = chosen.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= SAMPLE)
    ids = chosen.select("doc_id").distinct()
    found = usable.join(F.broadcast(ids), "doc_id", "left_semi")  # SAMPLE ids per language
    return found.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))


def train(docs: DataFrame, eligible: Column) -> Model | None:
    """A model from a sample of the rows that ``eligible`` allows; only ``text`` and ``lang`` are learned from."""
    rows = sample(docs, eligible).toArrow().sort_by([("lang", "ascending"), ("doc_id", "ascending"), ("text", "ascending")])
    return fit(rows.column("text").to_pylist(), rows.column("lang").to_pylist())


def predict(docs: DataFrame, model: Model | None, strict: bool = False) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights per language

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def classify(text: pa.Array) -> pa.Array:
        model, names, scores = shared.value, [], []
        for data, offsets in row_groups(pa.RecordBatch.from_arrays([text], ["text"])):
            counts, has_letter = features(data, offsets)
            if model is None:
                names += ["und"] * len(counts)
                scores += [0.0] * len(counts)
                continue
            x = normed(counts, model.idf)
            p = model.probabilities(x)
            like = has_letter & model.resembles(x, p) if strict else has_letter
            best = p.argmax(axis=1)
            names += [model.languages[b] if ok else "und" for b, ok in zip(best, like)]
            scores += [round(float(x), 6) if ok else 0.0 for x, ok in zip(p.max(axis=1), has_letter)]
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    found = docs.withColumn("_found", classify("text"))
    return found.withColumns({"lang_pred": F.col("_found.lang_pred"), "score": F.col("_found.score")}).drop("_found")


def accepted() -> Column:
    """Texts with a recognised language."""
    return (F.col("lang_pred") != "und") & (F.col("score") >= MIN_SCORE)
