"""Features, splits, classifiers and their evaluation."""

from pyspark.sql import functions as F

from chatterlens import schemas as S
from chatterlens.operators import features as E
from chatterlens.operators import sentiment as L
from chatterlens.operators import sequence as Q
from chatterlens.operators import training as M
from chatterlens.plans import analytics_queries as AQ
from chatterlens.plans import keyword_queries as KQ
from chatterlens.plans import sentiment_queries as SQ
from chatterlens.plans import tables as D
from chatterlens.plans.registry import query
from chatterlens.session import durable, staging_path
from chatterlens.sources import files

MIN_DF, MAX_FEATURES = 3, 200
_TOKENS = "regexp_extract_all(cleaned_body, '\\b\\w\\w+\\b')"
_GRAMS = "list_concat(tokens, list_transform(range(1, len(tokens)), lambda i: tokens[i] || ' ' || tokens[i + 1]))"


def _vocabulary_cte(source: str = "cleaned") -> str:
    return f"""tokenized AS (SELECT id, {_TOKENS} AS tokens FROM {source}),
counts AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest({_GRAMS}) AS term FROM tokenized) GROUP BY ALL),
stats AS (SELECT term, CAST(sum(tf) AS BIGINT) AS cf, count(*) AS df FROM counts GROUP BY term),
chosen AS (SELECT * FROM stats WHERE df >= {MIN_DF} ORDER BY cf DESC, term LIMIT {MAX_FEATURES}),
vocabulary AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, cf, df FROM chosen),
weights AS (SELECT *, ln((1 + (SELECT count(*) FROM {source})) / (1 + df)) + 1 AS idf FROM vocabulary)"""


def _tfidf_cte(tf: str = "tf") -> str:
    return f"""weighted AS (SELECT id, idx, {tf} * idf AS w FROM counts JOIN weights USING (term)),
tfidf AS (SELECT id, idx, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM weighted)"""


_WITH = f"WITH {D.CLEANED_CTE}"
_VOCABULARY = f"{_WITH}, {_vocabulary_cte()}"


def _texts(spark, sf_dir):
    return D.cleaned(spark, sf_dir).select("id", "cleaned_body")


def _vocabulary(spark, sf_dir):
    return E.fit_vocabulary(_texts(spark, sf_dir), MIN_DF, MAX_FEATURES)


def _vectors(spark, sf_dir, sublinear=False):
    texts = durable(_texts(spark, sf_dir))  # read by the fit and by the transform
    return E.Vectorizer.fit(texts, MIN_DF, MAX_FEATURES, sublinear).transform(texts)


def _entries(vectors, column="features"):
    entry = F.explode(E.vector_entries(F.col(column))).alias("_e")
    return vectors.select("id", entry).select("id", "_e.idx", F.round("_e.weight", 6).alias("weight"))


@query("word_tokens", f"{_WITH} SELECT id, array_to_string({_TOKENS}, '|') AS tokens FROM cleaned")
def _word_tokens(spark, sf_dir):
    return _texts(spark, sf_dir).select("id", F.array_join(E.word_tokens(F.col("cleaned_body")), "|").alias("tokens"))


@query("ngrams_1_2", f"""{_WITH}, tokenized AS (SELECT id, {_TOKENS} AS tokens FROM cleaned)
    SELECT id, array_to_string({_GRAMS}, '|') AS terms FROM tokenized""")
def _ngrams(spark, sf_dir):
    return _texts(spark, sf_dir).select("id", F.array_join(E.terms(F.col("cleaned_body")), "|").alias("terms"))


@query("term_stats", f"{_VOCABULARY} SELECT * FROM stats")
def _term_stats(spark, sf_dir):
    return E.term_stats(_texts(spark, sf_dir))


@query("top_terms", f"{_VOCABULARY} SELECT * FROM stats ORDER BY cf DESC, term LIMIT 25")
def _top_terms(spark, sf_dir):
    return E.most_frequent_terms(_texts(spark, sf_dir), 25)


@query("fit_vocabulary", f"{_VOCABULARY} SELECT * FROM vocabulary")
def _fit_vocabulary(spark, sf_dir):
    return _vocabulary(spark, sf_dir)


@query("idf_weights", f"{_VOCABULARY} SELECT term, idx, cf, df, round(idf, 6) AS idf FROM weights")
def _idf(spark, sf_dir):
    weights = E.idf_weights(_vocabulary(spark, sf_dir), D.comments(spark, sf_dir).count())
    return weights.withColumn("idf", F.round("idf", 6))


@query("tfidf_transform", f"{_VOCABULARY}, {_tfidf_cte()} SELECT id, idx, round(weight, 6) AS weight FROM tfidf")
def _tfidf(spark, sf_dir):
    return _entries(_vectors(spark, sf_dir))


@query("tfidf_sublinear", f"{_VOCABULARY}, {_tfidf_cte('(1 + ln(tf))')} SELECT id, idx, round(weight, 6) AS weight FROM tfidf")
def _tfidf_sublinear(spark, sf_dir):
    return _entries(_vectors(spark, sf_dir, sublinear=True))


@query("fit_on_first_n", f"""{_WITH}, firsts AS (SELECT * FROM cleaned ORDER BY created_utc, CAST(id AS BIGINT) LIMIT 300),
    {_vocabulary_cte('firsts')} SELECT * FROM vocabulary""")
def _fit_first(spark, sf_dir):
    texts = D.cleaned(spark, sf_dir).select("id", "created_utc", "cleaned_body")
    return E.fit_on_first_n(texts, 300, KQ.arrival_order(), MIN_DF, MAX_FEATURES)


@query("encode_subreddit", f"""WITH {D.COMMENTS_CTE} SELECT id, subreddit,
    dense_rank() OVER (ORDER BY subreddit) - 1 AS subreddit_code FROM comments""")
def _encode_subreddit(spark, sf_dir):
    return E.encode_subreddit(D.comments(spark, sf_dir).select("id", "subreddit"))


_SCALED = """(coalesce(nullif(score, 11), 0) - (SELECT min(coalesce(nullif(score, 11), 0)) FROM comments)) * 1.0::DOUBLE
    / (SELECT max(coalesce(nullif(score, 11), 0)) - min(coalesce(nullif(score, 11), 0)) FROM comments)"""


def _scaled(spark, sf_dir):
    holes = D.comments(spark, sf_dir).withColumn("score", F.expr("nullif(score, 11)"))
    return E.minmax_score(holes)


@query("minmax_score", f"WITH {D.COMMENTS_CTE} SELECT id, round({_SCALED}, 6) AS score_scaled FROM comments")
def _minmax(spark, sf_dir):
    return _scaled(spark, sf_dir).select("id", F.round("score_scaled", 6).alias("score_scaled"))


@query("assemble_features", f"""{_VOCABULARY}, {_tfidf_cte()}, sides AS (
      SELECT id, {MAX_FEATURES} AS idx, {_SCALED} AS weight FROM comments
      UNION ALL SELECT id, {MAX_FEATURES + 1}, controversiality FROM comments)
    SELECT id, idx, round(weight, 6) AS weight FROM (SELECT id, idx, weight FROM tfidf UNION ALL
      SELECT id, CAST(idx AS INTEGER), weight FROM sides) WHERE weight <> 0""")
def _assemble(spark, sf_dir):
    scaled = _scaled(spark, sf_dir).select("id", "score_scaled", "controversiality")
    joined = E.features_with_meta(_vectors(spark, sf_dir).select("id", "features"), scaled)
    whole = E.assemble_features(joined, ["features", "score_scaled", "controversiality"])
    return _entries(whole, "all_features")


@query("features_with_meta", f"""{_VOCABULARY}, {_tfidf_cte()} SELECT id, subreddit, label, n_terms
    FROM cleaned LEFT JOIN (SELECT id, count(*) AS n_terms FROM tfidf GROUP BY id) USING (id)""")
def _with_meta(spark, sf_dir):
    meta = D.comments(spark, sf_dir).select("id", "subreddit", "label")
    joined = E.features_with_meta(_vectors(spark, sf_dir).select("id", "features"), meta)
    size = F.size(E.vector_entries(F.col("features"))).cast("bigint")
    return joined.select("id", "subreddit", "label", F.nullif(size, F.lit(0)).alias("n_terms"))


_SPLIT = f"""WITH {D.COMMENTS_CTE}, ranked AS (SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY md5(id), id) AS rank,
    count(*) OVER (PARTITION BY label) AS n FROM comments WHERE label IN ('negative', 'neutral', 'positive'))"""


@query("stratified_split", f"{_SPLIT} SELECT id, label, rank <= round(0.2 * n) AS is_test FROM ranked")
def _stratified(spark, sf_dir):
    return M.stratified_split(D.comments(spark, sf_dir).select("id", "label").filter(F.col("label").isin(*S.LABELS)))


@query("chunk_split", f"""{AQ._CHUNKED} SELECT id, chunk_id, chunk_id IN (2, 4) AS is_test
    FROM chunks WHERE chunk_id IN (1, 3, 2, 4)""")
def _chunk_split(spark, sf_dir):
    chunked = AQ.row_chunks(spark, sf_dir).select("id", "chunk_id")
    train, test = M.chunk_split(chunked, [1, 3], [2, 4])
    return train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))


def labeled_vectors(spark, sf_dir):
    """Lexicon labels as the target, TF-IDF of the cleaned text as the features.

    Labelled texts and vectors are each read by several later passes, so both are stored.
    """
    labeled = L.label_batch(SQ.spoken(spark, sf_dir))
    texts = durable(labeled.select("id", "label", D.clean_text(F.col("body")).alias("cleaned_body")))
    vectorizer = E.Vectorizer.fit(texts, MIN_DF, MAX_FEATURES)
    return vectorizer, durable(M.with_class(vectorizer.transform(texts)))


def _report(predictions):
    named = predictions.withColumn("predicted", M.decode_label(F.col("prediction").cast("int")))
    return M.classification_report(named)


@query("train_logreg")
def _logreg(spark, sf_dir):
    """Held-out report of the logistic regression; an optimiser has no SQL twin."""
    _, rows = labeled_vectors(spark, sf_dir)
    split = M.stratified_split(rows)
    model = M.train_logreg(split.filter("NOT is_test"))
    return _report(model.transform(split.filter("is_test")))


#: Bounds that the fitted weights must keep: gradient and intercept gradient per row.
CERTIFIED_GRADIENT, CERTIFIED_INTERCEPT = 1e-3, 1e-3


@query("logreg_certificate", f"""WITH {D.COMMENTS_CTE}, known AS (SELECT count(*) AS n FROM comments
    WHERE label IN ('negative', 'neutral', 'positive')) SELECT n, true AS gradient_below, true AS intercept_below FROM known""")
def _certificate(spark, sf_dir):
    """The weights fitted on the known labels are at the optimum, to the bounds above."""
    texts = D.cleaned(spark, sf_dir).select("id", "cleaned_body", "label")
    texts = durable(texts)
    rows = durable(M.with_class(E.Vectorizer.fit(texts, MIN_DF, MAX_FEATURES).transform(texts)))
    certificate = M.logreg_certificate(rows, M.train_logreg(rows))
    return certificate.select(
        "n", (F.col("gradient_norm") <= CERTIFIED_GRADIENT).alias("gradient_below"),
        (F.col("intercept_norm") <= CERTIFIED_INTERCEPT).alias("intercept_below"),
    )


@query("train_sgd_incremental")
def _sgd(spark, sf_dir):
    """Report after learning from two halves of the data, one after the other."""
    _, rows = labeled_vectors(spark, sf_dir)
    chunked = rows.withColumn("chunk_id", F.pmod(F.crc32(F.col("id").cast("binary")), F.lit(2)) + 1)
    model = M.LinearModel(MAX_FEATURES)
    for chunk_id in (1, 2):
        model = M.train_sgd_incremental(chunked.filter(F.col("chunk_id") == chunk_id), model)
    return _report(M.linear_predictions(rows, model))


_BAYES = f"""{_VOCABULARY}, {_tfidf_cte()}, sums AS (SELECT label, idx, sum(weight) AS weight
      FROM tfidf JOIN comments USING (id) WHERE label IN ('negative', 'neutral', 'positive') GROUP BY ALL),
    totals AS (SELECT label, sum(weight) AS total FROM sums GROUP BY label)
    SELECT CASE label WHEN 'negative' THEN 0 WHEN 'neutral' THEN 1 ELSE 2 END AS label_class, idx,
      round(ln((weight + 1) / (total + {MAX_FEATURES})), 6) AS log_prob FROM sums JOIN totals USING (label)"""


@query("train_naive_bayes", _BAYES)
def _bayes(spark, sf_dir):
    """Sums of two halves of the data, merged, give the model of the whole."""
    texts = durable(D.cleaned(spark, sf_dir).select("id", "cleaned_body", "label"))
    vectors = E.Vectorizer.fit(texts, MIN_DF, MAX_FEATURES).transform(texts)
    rows = M.with_class(vectors)
    half = F.pmod(F.crc32(F.col("id").cast("binary")), F.lit(2))
    sums = M.merge_sums(M.naive_bayes_sums(rows.filter(half == 0)), M.naive_bayes_sums(rows.filter(half == 1)))
    probs = M.naive_bayes_log_probs(sums, MAX_FEATURES)
    return probs.withColumn("log_prob", F.round("log_prob", 6))


def bayes_model(spark, sf_dir):
    """All cleaned texts, the vocabulary of them, and naive Bayes trained on the known labels."""
    texts = durable(D.cleaned(spark, sf_dir).select("id", "cleaned_body", "label"))
    vectorizer = E.Vectorizer.fit(texts, MIN_DF, MAX_FEATURES)
    return texts, vectorizer, M.train_naive_bayes(durable(M.with_class(vectorizer.transform(texts))))


PREDICTED = f"""{_VOCABULARY}, {_tfidf_cte()},
    truth AS (SELECT id, label FROM comments WHERE label IN ('negative', 'neutral', 'positive')),
    sums AS (SELECT label, idx, sum(weight) AS weight FROM tfidf JOIN truth USING (id) GROUP BY ALL),
    totals AS (SELECT label, sum(weight) AS total FROM sums GROUP BY label),
    priors AS (SELECT label, ln((count(*) + 1) / ((SELECT count(*) FROM truth) + 3)) AS prior FROM truth GROUP BY label),
    logs AS (SELECT p.label, v.idx, ln((coalesce(s.weight, 0) + 1) / (t.total + (SELECT count(*) FROM vocabulary))) AS lp
      FROM priors p JOIN totals t USING (label) CROSS JOIN vocabulary v LEFT JOIN sums s ON s.label = p.label AND s.idx = v.idx),
    terms_said AS (SELECT id, label, sum(weight * lp) AS said FROM tfidf JOIN logs USING (idx) GROUP BY ALL),
    predicted AS (SELECT c.id, CASE WHEN c.cleaned_body = '' THEN 'unknown' ELSE arg_max(p.label, p.prior + coalesce(s.said, 0)) END AS label
      FROM cleaned c CROSS JOIN priors p LEFT JOIN terms_said s ON s.id = c.id AND s.label = p.label GROUP BY c.id, c.cleaned_body)"""


@query("predict_label", f"{PREDICTED} SELECT id, label FROM predicted")
def _predict(spark, sf_dir):
    texts, vectorizer, model = bayes_model(spark, sf_dir)
    return M.predict_label(texts.drop("label"), vectorizer, model).select("id", "label")


_GUESSED = f"""guessed AS (SELECT label, CASE WHEN score > 30 THEN 'positive' WHEN score > -30 THEN 'neutral' ELSE 'negative' END AS predicted
    FROM comments WHERE label IN ('negative', 'neutral', 'positive'))"""


_REPORT = """names AS (SELECT DISTINCT label AS name FROM guessed),
    counted AS (SELECT name, (SELECT count(*) FROM guessed WHERE label = name) AS support,
      (SELECT count(*) FROM guessed WHERE predicted = name) AS claimed,
      (SELECT count(*) FROM guessed WHERE predicted = name AND label = name) AS hits FROM names),
    rated AS (SELECT *, coalesce(hits / nullif(claimed, 0), 0) AS p, coalesce(hits / nullif(support, 0), 0) AS r FROM counted),
    classes AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM rated),
    report AS (SELECT name, p AS precision, r AS recall, f AS f1, support FROM classes
      UNION ALL SELECT 'accuracy', sum(hits) / sum(support), sum(hits) / sum(support), sum(hits) / sum(support), sum(support) FROM classes
      UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM classes
      UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
        sum(f * support) / sum(support), sum(support) FROM classes)
    SELECT name, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
      CAST(support AS BIGINT) AS support FROM report"""


@query("classification_report", f"WITH {D.COMMENTS_CTE}, {_GUESSED}, {_REPORT}")
def _classification_report(spark, sf_dir):
    guessed = D.comments(spark, sf_dir).selectExpr(
        "label",
        "CASE WHEN score > 30 THEN 'positive' WHEN score > -30 THEN 'neutral' ELSE 'negative' END AS predicted",
    ).filter(F.col("label").isin(*S.LABELS))
    return _rounded(M.classification_report(guessed))


def _rounded(report):
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


PART_ROWS = 100
_CHUNK_BAYES = f"""{_VOCABULARY}, {_tfidf_cte()},
    numbered AS (SELECT id, label, (row_number() OVER (ORDER BY created_utc, CAST(id AS BIGINT)) - 1) // {PART_ROWS} + 1 AS chunk_id FROM comments),
    known AS (SELECT id, label, chunk_id % 2 = 1 AS learned FROM numbered WHERE label IN ('negative', 'neutral', 'positive')),
    places AS (SELECT idx FROM vocabulary UNION ALL SELECT {MAX_FEATURES}),
    entries AS (SELECT id, idx, weight FROM tfidf UNION ALL
      SELECT id, {MAX_FEATURES}, controversiality FROM comments WHERE controversiality <> 0),
    sums AS (SELECT label, idx, sum(weight) AS weight FROM entries JOIN known USING (id) WHERE learned GROUP BY ALL),
    totals AS (SELECT label, sum(weight) AS total FROM sums GROUP BY label),
    priors AS (SELECT label, ln((count(*) + 1) / ((SELECT count(*) FROM known WHERE learned) + 3)) AS prior FROM known WHERE learned GROUP BY label),
    logs AS (SELECT p.label, v.idx, ln((coalesce(s.weight, 0) + 1) / (t.total + (SELECT count(*) FROM places))) AS lp
      FROM priors p JOIN totals t USING (label) CROSS JOIN places v LEFT JOIN sums s ON s.label = p.label AND s.idx = v.idx),
    said AS (SELECT id, label, sum(weight * lp) AS said FROM entries JOIN logs USING (idx) GROUP BY ALL),
    guessed AS (SELECT k.label, arg_max(p.label, p.prior + coalesce(s.said, 0)) AS predicted
      FROM known k CROSS JOIN priors p LEFT JOIN said s ON s.id = k.id AND s.label = p.label WHERE NOT learned GROUP BY k.id, k.label),
    {_REPORT}"""


@query("train_on_chunks", _CHUNK_BAYES)
def _train_on_chunks(spark, sf_dir):
    """Features of every chunk are stored; odd chunks train, the report is on even ones.

    Terms and controversiality are the features; only the chunks asked for are read back.
    """
    comments = durable(D.cleaned(spark, sf_dir).select("id", "created_utc", "cleaned_body", "label", "controversiality"))
    chunked = Q.row_chunks(comments, KQ.arrival_order(), PART_ROWS)
    vectors = E.Vectorizer.fit(chunked, MIN_DF, MAX_FEATURES).transform(chunked)
    whole = E.assemble_features(vectors, ["features", "controversiality"], "all_features")
    path = staging_path(spark, "training-chunks")
    files.write_chunks(M.with_class(whole).select("id", "label", "label_class", "all_features", "chunk_id"), path)
    stored = files.read_chunks(spark, path)
    model = M.train_naive_bayes(stored.filter("chunk_id % 2 = 1"), "all_features")
    return _rounded(_report(model.transform(stored.filter("chunk_id % 2 = 0"))))
