"""Toxicity by subword-bag embeddings and a linear softmax, trained jointly in numpy.

A word's bag holds the word itself and its character n-grams (3 to 5 bytes, with word ends marked), hashed into
``BUCKETS`` vectors of ``SIZE`` numbers; its vector is their average, so an unseen misspelling shares
most vectors with the known word. A word of more than ``WORD_BYTES`` bytes (a sentence without spaces, joined words) is cut
into windows of ``WINDOW`` bytes that overlap by half; each counts as a word, so all of it is read. A text's vector is an average of its distinct words' vectors, weighted by a softmax
over how toxic the classifier finds each (a few words among thousands decide). Both the vectors and the
softmax layer are learned from document labels by Adam.

The model is fitted on a bounded sample of labelled texts: ``SAMPLE`` toxic and ``2 * SAMPLE`` others, of at most
``SAMPLE_CHARS`` characters, with the smallest hash of their id. Scores come from whole texts.

Defined results: null and empty texts and texts without words get the score of an empty bag, ``EMPTY``;
without labelled texts every score is ``EMPTY``. Repeated rows get equal results. Other columns pass through; the two
names this module adds replace columns of the same name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterlens.llm import textnum

BUCKETS = 1 << 18
SIZE = 4
GRAMS = (3, 4, 5)
SAMPLE = 1000
SAMPLE_CHARS = 20_000
EPOCHS = 12
BATCH = 250
RATE = 0.05
FOCUS = 1.0
LIMIT = 0.7
EMPTY = 0.0
CACHE = 200_000
PORTION = 50_000
WORD_BYTES = 64
WINDOW = 24
_strip = bytes(range(0x21, 0x30)) + b":;<=>?[]{}()\\^_`|~"


def windows(word: bytes) -> list[bytes]:
    """The word with its ends marked, or the windows of a long one; each n-gram is in one of them."""
    marked = b"\x02" + word + b"\x03"
    if len(word) <= WORD_BYTES:
        return [marked]
    step = WINDOW // 2
    return [marked[at: at + WINDOW] for at in range(0, len(marked) - step, step)]


def words(text: bytes) -> list[bytes]:
    """Distinct lower-cased words without outer punctuation, marked and cut by ``windows``, sorted."""
    found = {w.strip(_strip) for w in text.decode("utf-8", "replace").lower().encode().split()}
    return sorted({part for w in found if w for part in windows(w)})


def bags(marked: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of all marked words' bags, and where each bag begins (one more entry than words)."""
    data = np.frombuffer(b"".join(marked), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(m) for m in marked])]).astype(np.int64)
    whole = textnum.word_hashes(data, offsets[:-1], offsets[1:])
    owner, ids = [np.arange(len(marked))], [whole]
    texts = np.repeat(np.arange(len(marked)), np.diff(offsets))
    for size in GRAMS:
        h = np.full(max(len(data) - size + 1, 0), size, np.uint64)
        for step in range(size):
            h = (h ^ data[step: step + len(h)]) * np.uint64(0x100000001B3)
        inside = texts[: len(h)] == texts[size - 1:] if len(h) else np.zeros(0, bool)
        owner.append(texts[: len(h)][inside])
        ids.append(textnum.mix(h[inside]))
    owner, ids = np.concatenate(owner), np.concatenate(ids)
    order = np.argsort(owner, kind="stable")
    return (ids[order] % np.uint64(BUCKETS)).astype(np.int64), np.searchsorted(owner[order], np.arange(len(marked) + 1))


def pooled(scores: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text the softmax-weighted average of its words' scores, and the weight of each word."""
    sizes = np.diff(first)
    peak = np.repeat(np.maximum.reduceat(scores, first[:-1]), sizes)
    e = np.exp(FOCUS * (scores - peak))
    weight = e / np.repeat(np.add.reduceat(e, first[:-1]), sizes)
    return np.add.reduceat(weight * scores, first[:-1]), weight


def fit(texts: list[str], toxic: list[int]) -> tuple[np.ndarray, float] | None:
    """What one occurrence of each bucket adds to a word's score before averaging, and the bias.

    With two classes the softmax depends on the difference of its two rows only, so a bucket's part in a score is
    its vector times that difference.
    """
    rows = [(words(t.encode()), y) for t, y in zip(texts, toxic)]
    rows = [(w, y) for w, y in rows if w]
    if not rows or len({y for _, y in rows}) < 2:
        return None
    vocabulary = sorted({w for ws, _ in rows for w in ws})
    number = {w: i for i, w in enumerate(vocabulary)}
    ids, bag = bags(vocabulary)
    texts_words = [np.array([number[w] for w in ws]) for ws, _ in rows]
    label = np.array([y for _, y in rows], float)
    random = np.random.Generator(np.random.PCG64(7))
    vectors = random.uniform(-0.5, 0.5, (BUCKETS, SIZE)) / SIZE
    layer = random.uniform(-0.5, 0.5, (SIZE, 2))
    bias = np.zeros(2)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (vectors, layer, bias)]
    step = 0
    for _ in range(EPOCHS):
        order = random.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            chosen = order[at: at + BATCH]
            step += 1
            local = np.concatenate([texts_words[i] for i in chosen])
            first = np.concatenate([[0], np.cumsum([len(texts_words[i]) for i in chosen])])
            distinct, back = np.unique(local, return_inverse=True)
            sizes = bag[distinct + 1] - bag[distinct]
            begin = np.concatenate([[0], np.cumsum(sizes)])
            flat = ids[np.repeat(bag[distinct] - begin[:-1], sizes) + np.arange(begin[-1])]
            word = np.add.reduceat(vectors[flat], begin[:-1], axis=0) / sizes[:, None]
            difference = layer[:, 1] - layer[:, 0]
            score, weight = pooled((word @ difference)[back], first)
            p = 1 / (1 + np.exp(-(score + bias[1] - bias[0])))
            wrong = (p - label[chosen]) / len(chosen)
            per_word = np.repeat(wrong, np.diff(first)) * weight
            share = np.bincount(back, per_word, minlength=len(distinct))
            toward = word.T @ share
            used, inverse = np.unique(flat, return_inverse=True)
            per_bucket = np.bincount(inverse, np.repeat(share / sizes, sizes), minlength=len(used))
            gradients = (per_bucket[:, None] * difference, np.stack([-toward, toward], axis=1), np.array([-wrong.sum(), wrong.sum()]))
            for k, (parameter, gradient) in enumerate(zip((vectors, layer, bias), gradients)):
                m, v = state[k]
                place = used if k == 0 else slice(None)
                m[place] = 0.9 * m[place] + 0.1 * gradient
                v[place] = 0.99 * v[place] + 0.01 * gradient * gradient
                parameter[place] -= RATE * (m[place] / (1 - 0.9**step)) / (np.sqrt(v[place] / (1 - 0.99**step)) + 1e-8)
    return vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0])


class Scorer:
    """Scores texts; keeps the scores of at most ``CACHE`` words."""

    def __init__(self, model):
        self.model, self.known = model, {}

    def means(self, marked: list[bytes]) -> np.ndarray:
        ids, bag = bags(marked)
        return np.add.reduceat(self.model[0][ids], bag[:-1]) / np.diff(bag)

    def learn(self, new: list[bytes]) -> None:
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
        self.known.update(zip(new, self.means(new).tolist()))

    def score(self, text: bytes) -> float:
        found = words(text)
        if not found or self.model is None:
            return EMPTY
        if len(found) > CACHE:  # more distinct words than the cache may hold: score them without it
            scores = np.concatenate([self.means(found[at: at + PORTION]) for at in range(0, len(found), PORTION)])
        else:
            new = [w for w in found if w not in self.known]
            if new:
                self.learn(new)
                if len(self.known) == len(new) < len(found):  # the cache was emptied
                    self.learn([w for w in found if w not in self.known])
            scores = np.array([self.known[w] for w in found])
        value = pooled(scores, np.array([0, len(scores)]))[0][0] + self.model[1]
        return round(float(1 / (1 + np.exp(-np.clip(value, -500, 500)))), 6)


def sample(docs: DataFrame, labels: DataFrame, eligible: Column) -> DataFrame:
    """A bounded sample of labelled texts, by a hash of the id."""
    labels = labels.where(eligible & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "toxic")
    labels = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # twice the rows, since some of them may turn out too long
    order = F.xxhash64("doc_id"), "doc_id"
    ids = labels.where("toxic = 1").orderBy(*order).limit(2 * SAMPLE).unionByName(labels.where("toxic = 0").orderBy(*order).limit(4 * SAMPLE))
    usable = docs.where(F.col("text").isNotNull() & (F.length("text") <= SAMPLE_CHARS)).select("doc_id", "text")
    found = usable.join(F.broadcast(ids), "doc_id")  # 6 * SAMPLE ids
    return found.where("toxic = 1").orderBy(*order, "text").limit(SAMPLE).unionByName(
        found.where("toxic = 0").orderBy(*order, "text").limit(2 * SAMPLE)
    )


def train(docs: DataFrame, labels: DataFrame, eligible: Column) -> tuple[np.ndarray, float] | None:
    """A model from the labelled rows that ``eligible`` (over ``doc_id``) allows; reads texts and labels only."""
    rows = sample(docs, labels, eligible).toArrow().sort_by([("toxic", "ascending"), ("doc_id", "ascending"), ("text", "ascending")])
    return fit(rows.column("text").to_pylist(), rows.column("toxic").to_pylist())


def predict(docs: DataFrame, model: tuple[np.ndarray, float] | None) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number per bucket

    @F.arrow_udf("double")
    def toxic_score(text: pa.Array) -> pa.Array:
        scorer = Scorer(shared.value)
        column = textnum.binary_column(pa.RecordBatch.from_arrays([text], ["text"]), "text")
        return pa.array([scorer.score(t.as_py()) for t in column], pa.float64())

    found = docs.withColumn("score", toxic_score("text"))
    return found.withColumn("predicted", (F.col("score") >= LIMIT).cast("int"))
