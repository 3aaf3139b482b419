"""Classifiers and features against independent computations."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chatterlens.operators import features as E
from chatterlens.operators import training as M
from chatterlens.session import durable

TEXTS = [("good great love fine", "positive"), ("bad awful hate ugly", "negative"), ("table chair door wall", "neutral")]


@pytest.fixture(scope="module")
def rows(spark):
    data = [(f"{i:04d}", " ".join(t.split()[: 2 + i % 3]) + f" w{i % 7}", label) for i in range(80) for t, label in TEXTS]
    texts = spark.createDataFrame([(f"{i}-{label}", t, label) for i, t, label in data], "id string, cleaned_body string, label string")
    vectorizer = E.Vectorizer.fit(texts, 2, 60, sublinear=True)
    return vectorizer, durable(M.with_class(vectorizer.transform(texts)))


def accuracy(predictions):
    return predictions.filter("prediction = label_class").count() / predictions.count()


def test_vectors_have_unit_length(rows):
    squares = F.aggregate(E.vector_entries(F.col("features")), F.lit(0.0), lambda a, e: a + e["weight"] * e["weight"])
    lengths = [r.n for r in rows[1].select(squares.alias("n")).collect()]
    assert np.allclose(lengths, 1.0)


def test_empty_text_gives_zero_vector(spark, rows):
    empty = spark.createDataFrame([("e", ""), ("n", None), ("x", "unseen words")], "id string, cleaned_body string")
    assert all(r.features.numNonzeros() == 0 for r in rows[0].transform(empty).collect())


def test_logistic_regression_and_bayes(rows):
    assert accuracy(M.train_logreg(rows[1]).transform(rows[1])) > 0.99
    assert accuracy(M.train_naive_bayes(rows[1]).transform(rows[1])) > 0.99


def test_long_form_bayes_equals_library(rows):
    model = M.train_naive_bayes(rows[1])
    half = F.crc32(F.col("id").cast("binary")) % 2
    sums = M.merge_sums(M.naive_bayes_sums(rows[1].filter(half == 0)), M.naive_bayes_sums(rows[1].filter(half == 1)))
    theta = model.theta.toArray()
    for r in M.naive_bayes_log_probs(sums, len(rows[0].vocabulary)).collect():
        assert abs(theta[r.label_class, r.idx] - r.log_prob) < 1e-9


def test_one_pass_equals_dense_steps(rows, monkeypatch):
    """Steps over each partition's rows in order, averaged by rows, on dense vectors; with and without a tree."""
    size = len(rows[0].vocabulary)
    laid_out = durable(rows[1].repartition(5, "id"))
    start = M.LinearModel(size, seen=7, weights=np.full((3, size + 1), 0.01))
    parts = {}
    for r in laid_out.withColumn("_part", F.spark_partition_id()).collect():
        parts.setdefault(r._part, []).append((np.append(r.features.toArray(), 1.0), r.label_class))
    total = 0.0
    for part in parts.values():
        weights, seen = start.weights, start.seen
        for begin in range(0, len(part), start.batch_rows):
            few = part[begin: begin + start.batch_rows]
            x = np.array([v for v, _ in few])
            sign = np.array([[1.0 if label == c else -1.0 for _, label in few] for c in range(3)])
            gradient = (-sign / (1 + np.exp(sign * (weights @ x.T)))) @ x / len(few)
            rate = start.rate / np.sqrt(1 + (seen + begin) / start.batch_rows / start.slowing)
            weights = weights - rate * (gradient + start.alpha * weights)
        total = total + weights * len(part)
    for fan_in in (32, 2):
        monkeypatch.setattr(M, "FAN_IN", fan_in)
        model = M.train_sgd_incremental(laid_out, start)
        assert model.seen == 247 and np.allclose(model.weights, total / 240)


def test_certificate_tells_an_optimum(rows):
    """The norm agrees with numpy, is small for the fitted weights and large for weights stopped early."""
    norms = []
    for iterations in (300, 2):
        model = M.train_logreg(rows[1], max_iter=iterations)
        data = rows[1].collect()
        x = np.array([r.features.toArray() for r in data])
        margins = x @ model.coefficientMatrix.toArray().T + model.interceptVector.toArray()
        p = np.exp(margins - margins.max(axis=1, keepdims=True))
        residual = p / p.sum(axis=1, keepdims=True) - np.eye(3)[[int(r.label_class) for r in data]]
        gradient = residual.T @ x + model.coefficientMatrix.toArray()
        row = M.logreg_certificate(rows[1], model).first()
        assert row.n == 240 and abs(row.gradient_norm - np.linalg.norm(gradient) / 240) < 1e-9
        assert abs(row.intercept_norm - np.linalg.norm(residual.sum(axis=0)) / 240) < 1e-9
        norms.append(row.gradient_norm)
    assert norms[0] < 1e-3 < norms[1]


def test_sgd_keeps_learning(rows):
    model = M.LinearModel(len(rows[0].vocabulary))
    for chunk in rows[1].randomSplit([0.5, 0.5], seed=3):
        model = M.train_sgd_incremental(chunk.repartition(3), model)
    assert accuracy(M.linear_predictions(rows[1], model)) > 0.95
    unchanged = M.train_sgd_incremental(rows[1].filter("false"), model)
    assert unchanged is model


@pytest.mark.parametrize("share", [0.0, 0.2, 0.5, 1.0])
def test_stratified_shares(spark, share):
    frame = spark.range(1000).selectExpr("CAST(id AS STRING) AS id", "CASE WHEN id < 800 THEN 'a' WHEN id < 990 THEN 'b' ELSE 'c' END AS label")
    split = M.stratified_split(frame, share)
    got = {r.label: (r.n, r.t) for r in split.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()}
    assert got == {k: (n, round(n * share)) for k, n in {"a": 800, "b": 190, "c": 10}.items()}


def test_report_of_missing_class(spark):
    frame = spark.createDataFrame([("a", "b"), ("b", "b"), ("c", "a")], "label string, predicted string")
    report = {r.name: r for r in M.classification_report(frame).collect()}
    assert report["c"].precision == 0.0 and report["c"].recall == 0.0 and report["c"].f1 == 0.0
    assert abs(report["accuracy"].f1 - 1 / 3) < 1e-12 and report["macro avg"].support == 3


def test_vocabulary_ties(spark):
    docs = spark.createDataFrame([("bb aa",), ("bb aa",), ("cc dd",), ("cc dd",)], "cleaned_body string")
    got = [(r.term, r.idx) for r in E.fit_vocabulary(docs, 2, 3).orderBy("idx").collect()]
    assert got == [("aa", 0), ("bb", 1), ("bb aa", 2)]


@pytest.mark.parametrize("summary", [1, 8, 40, None])
@pytest.mark.parametrize("k", [1, 10, 60, 100_000])
def test_heavy_terms_are_exact(spark, monkeypatch, summary, k):
    """Small runs and summaries, by candidates or by counting everything, give the plain answer."""
    words = [f"w{int(i ** 0.5)}x" for i in range(60)]
    texts = [(" ".join(words[(i * 7 + j * j) % (i % 50 + 10)] for j in range(12)),) for i in range(300)]
    docs = spark.createDataFrame(texts, "cleaned_body string").repartition(6).persist()
    runs = durable(E.term_runs(docs))
    plain = E.term_stats(docs).filter("df >= 3").orderBy(F.desc("cf"), "term").limit(k).collect()
    found = E.top_terms(durable(E.heavy_terms(runs, k, 3, summary)), k).collect()
    assert sorted(map(tuple, found)) == sorted((r.term, r.cf, r.df) for r in plain)


def test_runs_of_bounded_size(spark):
    batch = pa.RecordBatch.from_pydict({"term": [f"t{i % 9}" for i in range(50)], "tf": [2] * 50})
    old, E.RUN_TERMS = E.RUN_TERMS, 4
    try:
        E.TaskContext, context = type("C", (), {"get": staticmethod(lambda: type("P", (), {"partitionId": lambda self: 1})())}), E.TaskContext
        rows = [r for out in E._term_runs(iter([batch.slice(0, 20), batch.slice(20)])) for r in out.to_pylist()]
    finally:
        E.RUN_TERMS, E.TaskContext = old, context
    assert {r["run"] for r in rows} == {1 << 32, (1 << 32) + 1} and sum(r["cf"] for r in rows) == 100 and sum(r["df"] for r in rows) == 50
    for run in {r["run"] for r in rows}:
        own = [r for r in rows if r["run"] == run]
        assert [r["place"] for r in own] == list(range(len(own))) and [-r["cf"] for r in own] == sorted(-r["cf"] for r in own)


@pytest.mark.parametrize("values", [[], [5], [0, 0, 3], [7, 7, 7, 4096, 1 << 40, 2, 4095]])
def test_kth_largest(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "n bigint")
    for k in range(1, len(values) + 2):
        ordered = sorted(values, reverse=True)
        wanted = (ordered[k - 1], k - sum(v > ordered[k - 1] for v in values)) if k <= len(values) else None
        assert E.kth_largest(frame, "n", k) == wanted


def test_term_counts(spark):
    row = spark.createDataFrame([("b a b",), ("",)], "t string")
    got = [r.c for r in row.select(E.term_counts(F.split("t", " ")).alias("c")).collect()]
    assert [(e.term, e.tf) for e in got[0]] == [("a", 1), ("b", 2)]


def _texts_with_ties(spark):
    words = [f"w{int(i ** 0.5)}x" for i in range(60)]
    rows = [(" ".join(words[(i * 7 + j * j) % (i % 50 + 10)] for j in range(12)),) for i in range(300)]
    return spark.createDataFrame([*rows, (None,), ("",), ("ÉTÉ été a İx éa",)], "cleaned_body string").repartition(6).persist()


@pytest.mark.parametrize("k, marked", [(1, 2000), (5, 2000), (7, 2000), (7, 3), (60, 2000)])
def test_most_frequent_terms_by_pairs_of_frequent_words(spark, monkeypatch, k, marked):
    """The plain answer; pairs are counted in the row and no run of terms is gathered in Python unless too many words are frequent."""
    docs = _texts_with_ties(spark)
    plain = E.term_stats(docs).filter("df >= 3").orderBy(F.desc("cf"), "term").limit(k).collect()
    monkeypatch.setattr(E, "MARKED_WORDS", marked)
    if k < 60 and marked > 3:
        monkeypatch.setattr(E, "heavy_terms", None)
    found = E.most_frequent_terms(docs, k, 3).select("term", "cf", "df").collect()
    assert sorted(map(tuple, found)) == sorted((r.term, r.cf, r.df) for r in plain)


def test_vector_of_few_words_equals_vector_of_all_terms(spark, monkeypatch):
    docs = _texts_with_ties(spark)
    vectorizer = E.Vectorizer(["w1x", "w3x", "w2x w5x", "été", "éa"], [1.0, 2.0, 0.5, 1.5, 1.0])
    few = docs.select("cleaned_body", E.terms_of(E.word_tokens(F.col("cleaned_body")), ["été"]).alias("t"))
    assert {tuple(r.t) for r in few.collect()} == {(), ("été", "été", "été été")}
    short = vectorizer.transform(docs).orderBy("cleaned_body").collect()
    monkeypatch.setattr(E, "MARKED_WORDS", 0)
    assert short == vectorizer.transform(docs).orderBy("cleaned_body").collect()
