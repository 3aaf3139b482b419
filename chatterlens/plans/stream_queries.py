"""Round trips through files, and the streaming jobs run to the end of their input.

Sources are written from the test tables into new folders below the shared one.
"""

from pyspark.sql import functions as F

from chatterlens import schemas as S
from chatterlens.operators import features as E
from chatterlens.operators import keywords as K
from chatterlens.operators import records as R
from chatterlens.operators import sequence as Q
from chatterlens.operators import training as M
from chatterlens.operators import validate as V
from chatterlens.plans import analytics_queries as AQ
from chatterlens.plans import feature_queries as FQ
from chatterlens.plans import keyword_queries as KQ
from chatterlens.plans import session_queries as UQ
from chatterlens.plans import tables as D
from chatterlens.plans import validate_queries as VQ
from chatterlens.plans.registry import query
from chatterlens.session import durable, staging_path
from chatterlens.sources import files
from chatterlens.sources.models import ModelStore, ReloadingModel
from chatterlens.sources.results import ResultTable
from chatterlens.sources.streams import Topic, console_sink, source
from chatterlens.streaming import jobs, keyed
from chatterlens.streaming.windows import KeywordWindows, fused_stream, keyword_stream, request_stream

_WITH = f"WITH {D.COMMENTS_CTE}"


def _folder(spark, name):
    return staging_path(spark, name)


def _finish(started):
    started.awaitTermination()


@query("read_dump", f"WITH {VQ._LINES_CTE}, {VQ._PARSED} SELECT value, is_json, has_fields, id FROM parsed")
def _read_dump(spark, sf_dir):
    path = _folder(spark, "dump")
    VQ.raw_lines(spark, sf_dir).select("value").write.option("compression", "gzip").text(path)
    return V.parse_json_lines(files.read_dump(spark, path)).select("value", "is_json", "has_fields", "id")


@query("write_jsonl", f"{_WITH} SELECT {', '.join(S.REQUIRED_FIELDS)} FROM comments")
def _write_jsonl(spark, sf_dir):
    path = _folder(spark, "jsonl")
    files.write_jsonl(V.keep_fields(D.comments(spark, sf_dir)), path, "gzip")
    return files.read_jsonl(spark, path)


@query("labelled_csv", f"{_WITH} SELECT id, created_utc, subreddit, concat('\"q\", ', body) AS body, label, score, controversiality FROM comments")
def _labelled_csv(spark, sf_dir):
    """Bodies with quotes, commas and newlines survive the round trip."""
    path = _folder(spark, "csv")
    quoted = D.comments(spark, sf_dir).withColumn("body", F.concat(F.lit('"q", '), "body"))
    files.write_csv(quoted.select(*S.ARCHIVE_LABELED.fieldNames()), path)
    return files.read_csv(spark, path)


@query("console_sink", f"""{_WITH}, asked AS (SELECT id, created_utc FROM comments WHERE controversiality = 1)
    SELECT count(*) AS printed FROM asked""")
def _console_sink(spark, sf_dir):
    """A stream of records printed to the console; the progress tells how many rows went out."""
    said = _folder(spark, "said")
    R.json_values(D.comments(spark, sf_dir).filter("controversiality = 1").select("id", "created_utc")).write.text(said)
    started = console_sink(source(spark, Topic(said)), _folder(spark, "check"), available_now=True)
    _finish(started)
    return spark.createDataFrame([(sum(p["numInputRows"] for p in started.recentProgress),)], "printed bigint")


@query("write_text_lines", f"WITH {D.CLEANED_CTE} SELECT cleaned_body FROM cleaned")
def _text_lines(spark, sf_dir):
    path = _folder(spark, "lines")
    files.write_text_lines(D.cleaned(spark, sf_dir), path)
    return files.read_text_lines(spark, path)


@query("meta_chunks", AQ._CHUNKED.replace("SELECT id, subreddit, label, row_no", "SELECT *")
       + f" SELECT {', '.join(S.META_CHUNK.fieldNames())}, chunk_id FROM chunks")
def _meta_chunks(spark, sf_dir):
    path = _folder(spark, "meta")
    chunked = Q.row_chunks(D.comments(spark, sf_dir), KQ.arrival_order(), 250)
    files.write_chunks(files.meta_chunks(chunked), path)
    read = files.read_chunks(spark, path)
    return read.withColumn("chunk_id", F.col("chunk_id").cast("bigint"))


@query("feature_chunks", f"""{FQ._VOCABULARY}, {FQ._tfidf_cte()},
    numbered AS (SELECT id, (row_number() OVER (ORDER BY created_utc, CAST(id AS BIGINT)) - 1) // 250 + 1 AS chunk_id FROM comments)
    SELECT id, chunk_id, idx, round(weight, 6) AS weight FROM tfidf JOIN numbered USING (id)""")
def _feature_chunks(spark, sf_dir):
    path = _folder(spark, "features")
    texts = durable(D.cleaned(spark, sf_dir).select("id", "created_utc", "cleaned_body"))  # read by the fit and by the transform
    chunked = Q.row_chunks(texts, KQ.arrival_order(), 250)
    vectors = E.Vectorizer.fit(texts, FQ.MIN_DF, FQ.MAX_FEATURES).transform(chunked)
    files.write_chunks(vectors.select("id", "features", "chunk_id"), path)
    read = files.read_chunks(spark, path).withColumn("chunk_id", F.col("chunk_id").cast("bigint"))
    entries = read.select("id", "chunk_id", F.explode(E.vector_entries(F.col("features"))).alias("_e"))
    return entries.select("id", "chunk_id", "_e.idx", F.round("_e.weight", 6).alias("weight"))


_CLEANED = f"""WITH {D.CLEANED_CTE} SELECT id, created_utc, subreddit, score, body, cleaned_body,
    CAST(length(body) AS INTEGER) AS original_length FROM cleaned"""


def _write_raw(spark, sf_dir, path):
    R.json_values(V.keep_fields(D.comments(spark, sf_dir))).write.text(path)


@query("clean_stream", _CLEANED)
def _clean_stream(spark, sf_dir):
    raw, out, check = (_folder(spark, n) for n in ("raw", "cleaned", "check"))
    _write_raw(spark, sf_dir, raw)
    _finish(jobs.clean_stream(spark, Topic(raw), Topic(out), check, available_now=True, per_trigger=3))
    return files.read_jsonl(spark, out, S.CLEANED_COMMENT)


def _labeled_lines(spark, sf_dir):
    """Valid labelled comments as JSON values, ids padded so that they sort in arrival order."""
    valid = V.valid_comments(D.comments(spark, sf_dir)).withColumn("id", F.lpad("id", 12, "0"))
    cleaned = valid.select("*", D.clean_text(F.col("body")).alias("cleaned_body"), F.length("body").alias("original_length"))
    return R.json_values(R.labeled_record(cleaned, F.col("label")))


# The newest request of each user, in force before the first comment.
_ASKED_FIRST = KQ._response_sql("0").replace(
    "SELECT * FROM (VALUES", "SELECT user_id, keyword1, keyword2, CAST(0 AS BIGINT) AS req_seq FROM (VALUES"
).replace(
    ") t(user_id, keyword1, keyword2, req_seq))",
    ") t(user_id, keyword1, keyword2, req_seq) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY t.req_seq DESC) = 1)",
)


def _request_values(spark, sf_dir):
    """Requests as JSON values, a user's replaced one included; the time says which is newer."""
    time = F.lpad(F.col("req_seq").cast("string"), 20, "0").alias("request_time")
    return R.json_values(D.requests(spark, sf_dir).select("user_id", "keyword1", "keyword2", time))


@query("keyword_stream", _ASKED_FIRST)
def _keyword_stream(spark, sf_dir):
    """Requests first, then two batches of comments, whose border falls inside a window."""
    asked, said, state = (_folder(spark, n) for n in ("requests", "labeled", "state"))
    _request_values(spark, sf_dir).coalesce(1).write.text(asked)
    lines = durable(_labeled_lines(spark, sf_dir))
    time = F.get_json_object("value", "$.created_utc").cast("bigint")
    border = lines.agg(((F.min(time) + F.max(time)) / 2).cast("bigint")).first()[0]
    job = KeywordWindows(spark, state, KQ.N, reset_on_request=False)
    _finish(request_stream(spark, Topic(asked), job, f"{state}/check_requests", available_now=True))
    for half in (time <= border, time > border):
        lines.filter(half).coalesce(1).write.mode("append").text(said)
        _finish(keyword_stream(spark, Topic(said), job, f"{state}/check", available_now=True))
    return KQ._rounded(job.responses.read().drop("batch_id"))


@query("result_table", _ASKED_FIRST)
def _result_table(spark, sf_dir):
    """The responses upserted twice, first with wrong values: the newer batch wins."""
    requests = K.latest_request_per_user(D.requests(spark, sf_dir)).withColumn("req_seq", F.lit(0).cast("bigint"))
    responses = durable(KQ.responses(spark, sf_dir, requests))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in responses.schema)
    table = ResultTable(spark, _folder(spark, "results"), schema, ["user_id", "window_no"])
    table.write(responses.withColumn("value1", F.lit(9.0)), 0)
    table.write(responses, 1)
    return table.current()


@query("label_stream", f"""{FQ.PREDICTED} SELECT id, created_utc, subreddit, score, cleaned_body, p.label,
    CAST(length(body) AS INTEGER) AS original_length FROM cleaned JOIN predicted p USING (id)
    UNION ALL SELECT NULL, NULL, NULL, NULL, '', 'error', NULL FROM range(2)""")
def _label_stream(spark, sf_dir):
    """Raw to cleaned to labelled through file hops; two broken lines come out as error records."""
    raw, cleaned, labeled, check = (_folder(spark, n) for n in ("raw", "cleaned", "labeled", "check"))
    _write_raw(spark, sf_dir, raw)
    _, vectorizer, classifier = FQ.bayes_model(spark, sf_dir)
    store = ModelStore(spark, _folder(spark, "models"))
    store.publish(vectorizer, classifier)
    _finish(jobs.clean_stream(spark, Topic(raw), Topic(cleaned), f"{check}/clean", available_now=True))
    broken = spark.createDataFrame([('{"id": "1"} trailing',), ("broken line",)], "value string")
    mixed = _folder(spark, "mixed")  # a folder that a stream writes is read by its log, so the broken lines go elsewhere
    spark.read.text(cleaned).unionByName(broken).write.text(mixed)
    _finish(jobs.label_stream(spark, Topic(mixed), Topic(labeled), store, f"{check}/label", available_now=True))
    read = spark.read.schema(S.LABELED_COMMENT).option("recursiveFileLookup", True).json(labeled)
    return read.select(*S.LABELED_COMMENT.fieldNames())


@query("retrain_stream", f"""WITH {D.CLEANED_CTE}, known AS (SELECT count(*) AS n FROM cleaned
    WHERE label IN ('negative', 'neutral', 'positive') AND {D.VALID_SQL}) SELECT 2 AS version, n FROM known""")
def _retrain_stream(spark, sf_dir):
    """All labelled comments gathered and one new version trained on them."""
    said, state = _folder(spark, "labeled"), _folder(spark, "retrain")
    lines = durable(_labeled_lines(spark, sf_dir))
    lines.write.text(said)
    texts = durable(jobs.parsed(lines, S.LABELED_COMMENT).select("cleaned_body", "label"))
    vectorizer = E.Vectorizer.fit(texts, FQ.MIN_DF, FQ.MAX_FEATURES)
    store = ModelStore(spark, f"{state}/models")
    store.publish(vectorizer, M.train_naive_bayes(M.with_class(vectorizer.transform(texts))))
    retrainer = jobs.Retrainer(spark, store, state, at_least=50)
    _finish(jobs.retrain_stream(spark, Topic(said), retrainer, f"{state}/check", available_now=True))
    return retrainer.trained.read().select("version", "n")


@query("route_responses_stream", f"""{UQ._LOG}, {UQ._LIVE}, {UQ._RESPONSES}
    SELECT user_id, {UQ._SHOWN} FROM responses SEMI JOIN live USING (user_id)""")
def _route_stream(spark, sf_dir):
    sent, out, check = (_folder(spark, n) for n in ("responses", "routed", "check"))
    R.json_values(UQ._responses(spark, sf_dir)).write.text(sent)
    log = D.session_log(spark, sf_dir)
    _finish(jobs.route_stream(spark, Topic(sent), log, out, check, available_now=True))
    return spark.read.schema(S.KEYWORD_RESPONSE).json(out).select(*S.KEYWORD_RESPONSE.fieldNames())


@query("keyword_trend_stream", f"""{KQ._TREND}, ended AS (SELECT max(created_utc) AS last FROM cleaned)
    SELECT t.* FROM trend t, ended WHERE epoch(window_start) + 300 <= last - 600""")
def _trend_stream(spark, sf_dir):
    """Event-time windows that the watermark has closed by the end of the input."""
    said, out, check = (_folder(spark, n) for n in ("labeled", "trend", "check"))
    cleaned = D.cleaned(spark, sf_dir).withColumn("original_length", F.length("body"))
    R.json_values(cleaned.select(*S.LABELED_COMMENT.fieldNames())).write.text(said)
    trend = jobs.trend_stream(spark, Topic(said), D.requests(spark, sf_dir))
    writer = trend.writeStream.outputMode("append").option("checkpointLocation", check).option("path", out)
    _finish(writer.trigger(availableNow=True).format("parquet").start())
    read = spark.read.schema(trend.schema).parquet(out).withColumn("score", F.round("score", 6))
    return read.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


_JUDGED = f"""{FQ.PREDICTED}, judged AS (SELECT c.* REPLACE (p.label AS label) FROM cleaned c JOIN predicted p USING (id)),"""


@query("one_stream_chain", _ASKED_FIRST.replace(f"WITH {D.CLEANED_CTE},", _JUDGED, 1).replace("FROM cleaned WHERE", "FROM judged WHERE"))
def _chain(spark, sf_dir):
    """A compressed dump with broken lines to responses, through every hop."""
    raw, cleaned, labeled, asked, state = (
        _folder(spark, n) for n in ("raw", "cleaned", "labeled", "requests", "state")
    )
    dump = _folder(spark, "dump")
    said = D.comments(spark, sf_dir).withColumn("id", F.lpad("id", 12, "0"))
    broken = spark.createDataFrame([("oops",), ('{"id": "1"',), ('{"id": "2"}',), ("[1]",)], "value string")
    R.json_values(V.keep_fields(said)).unionByName(broken).write.option("compression", "gzip").text(dump)
    parsed = V.parse_json_lines(files.read_dump(spark, dump)).filter("has_fields")
    R.json_values(V.keep_fields(V.valid_comments(parsed))).write.text(raw)
    _request_values(spark, sf_dir).write.text(asked)
    _, vectorizer, classifier = FQ.bayes_model(spark, sf_dir)
    store = ModelStore(spark, f"{state}/models")
    store.publish(vectorizer, classifier)
    job = KeywordWindows(spark, state, KQ.N)
    _finish(request_stream(spark, Topic(asked), job, f"{state}/check_requests", available_now=True))
    _finish(jobs.clean_stream(spark, Topic(raw), Topic(cleaned), f"{state}/check_clean", available_now=True))
    _finish(jobs.label_stream(spark, Topic(cleaned), Topic(labeled), store, f"{state}/check_label", available_now=True))
    _finish(keyword_stream(spark, Topic(labeled), job, f"{state}/check_keywords", available_now=True))
    return KQ._rounded(job.responses.read().drop("batch_id"))


@query("keyword_state_stream", f"""{KQ.BASE_CTE} SELECT window_no, keyword, count(*) FILTER (WHERE label = 'positive') AS positive,
    count(*) FILTER (WHERE label = 'neutral') AS neutral, count(*) AS total FROM matches GROUP BY ALL""")
def _keyword_state(spark, sf_dir):
    """Counts per window and keyword from the state store; two runs over two parts of the input, the second from the checkpoint."""
    said, out, check = (_folder(spark, n) for n in ("labeled", "counts", "check"))
    valid = V.valid_comments(D.comments(spark, sf_dir)).withColumn("cleaned_body", D.clean_text(F.col("body")))
    numbers, total = Q.index_and_count(valid.select(*KQ.KEY), KQ.arrival_order())
    lines = durable(R.json_values(valid.join(numbers, KQ.KEY).select("seq", "subreddit", "label", "cleaned_body")))
    number = F.get_json_object("value", "$.seq").cast("bigint")
    for part in (number < total // 2, number >= total // 2):
        lines.filter(part).coalesce(3).write.mode("append").text(said)
        read = source(spark, Topic(said)).select(F.from_json("value", "seq long, subreddit string, label string, cleaned_body string").alias("c"))
        counts = keyed.window_counts(read.select("c.*"), D.requests(spark, sf_dir), KQ.N)
        writer = counts.writeStream.outputMode("append").option("checkpointLocation", check).option("path", out)
        _finish(writer.trigger(availableNow=True).format("parquet").start())
    return spark.read.schema(keyed.PARTIAL).parquet(out)


@query("one_stream_fused", _ASKED_FIRST.replace(f"WITH {D.CLEANED_CTE},", _JUDGED, 1).replace("FROM cleaned WHERE", "FROM judged WHERE"))
def _fused(spark, sf_dir):
    """The same dump to the same responses in one streaming query, several micro-batches."""
    raw, asked, state = (_folder(spark, n) for n in ("raw", "requests", "state"))
    said = D.comments(spark, sf_dir).withColumn("id", F.lpad("id", 12, "0"))
    broken = spark.createDataFrame([("oops",), ('{"id": "1"',), ('{"id": "2"}',), ("[1]",)], "value string")
    R.json_values(V.keep_fields(said)).unionByName(broken).write.text(raw)
    _request_values(spark, sf_dir).write.text(asked)
    _, vectorizer, classifier = FQ.bayes_model(spark, sf_dir)
    store = ModelStore(spark, f"{state}/models")
    store.publish(vectorizer, classifier)
    job = KeywordWindows(spark, state, KQ.N)
    _finish(request_stream(spark, Topic(asked), job, f"{state}/check_requests", available_now=True))
    _finish(fused_stream(spark, Topic(raw), job, store, f"{state}/check", available_now=True))
    return KQ._rounded(job.responses.read().drop("batch_id"))


@query("ingest_metrics_stream", VQ.INGEST_SQL)
def _ingest_stream(spark, sf_dir):
    """Run counts observed on a stream of raw lines, three files a micro-batch, added up."""
    dump, raw, check = (_folder(spark, n) for n in ("dump", "raw", "check"))
    VQ.raw_lines(spark, sf_dir).select("value").write.text(dump)
    started = jobs.ingest_stream(spark, Topic(dump), Topic(raw), check, available_now=True, per_trigger=3)
    _finish(started)
    counts = spark.createDataFrame(jobs.ingest_progress(started), (
        "batch_id bigint, total_processed bigint, invalid_json bigint, filtered_out bigint, messages_sent bigint, timestamp_stopped bigint"
    ))
    summed = counts.agg(*[F.sum(c).alias(c) for c in ("total_processed", "invalid_json", "filtered_out", "messages_sent")])
    written = files.read_jsonl(spark, raw).agg(F.count("*").alias("written"))
    return summed.join(F.broadcast(written))  # one row each


@query("request_state", f"""WITH {D.COMMENTS_CTE}, asked AS (SELECT author AS user_id, subreddit AS keyword1, label AS keyword2,
      CAST(id AS BIGINT) AS n, created_utc > (SELECT (min(created_utc) + max(created_utc)) // 2 FROM comments) AS late FROM comments)
    SELECT user_id, max_by(keyword1, n) AS keyword1, max_by(keyword2, n) AS keyword2 FROM asked GROUP BY user_id""")
def _request_state(spark, sf_dir):
    """Requests in two batches, the earlier half first; each is folded into the state."""
    asked, state = _folder(spark, "requests"), _folder(spark, "state")
    made = D.comments(spark, sf_dir).selectExpr(
        "author AS user_id", "subreddit AS keyword1", "label AS keyword2", "lpad(id, 20, '0') AS request_time", "created_utc"
    )
    border = made.agg(F.floor((F.min("created_utc") + F.max("created_utc")) / 2)).first()[0]
    job = KeywordWindows(spark, state, KQ.N)
    for half in (F.col("created_utc") <= border, F.col("created_utc") > border):
        R.json_values(made.filter(half).drop("created_utc")).write.mode("append").text(asked)
        _finish(request_stream(spark, Topic(asked), job, f"{state}/check", available_now=True))
    return job.requests.read_batch(1).select("user_id", "keyword1", "keyword2")


@query("model_store", "SELECT 1 AS first_version, 2 AS second_version, count(*) AS labeled FROM documents")
def _model_store(spark, sf_dir):
    """A published model is picked up by a reader, and replaced by the next one."""
    vectorizer, rows = FQ.labeled_vectors(spark, sf_dir)
    store = ModelStore(spark, _folder(spark, "models"))
    reader = ReloadingModel(store, interval=0)
    versions = []
    for _ in range(2):
        store.publish(vectorizer, M.train_naive_bayes(rows))
        versions.append(reader.get().version)
    model = reader.get()
    labeled = M.predict_label(rows.select("id", "cleaned_body"), model.vectorizer, model.classifier)
    return labeled.agg(F.count("*").alias("labeled")).select(
        F.lit(versions[0]).alias("first_version"), F.lit(versions[1]).alias("second_version"), "labeled"
    )
