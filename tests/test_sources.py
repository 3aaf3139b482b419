"""Files, streams and the model store."""

import json
import time

import pytest
import zstandard
from pyspark.sql import functions as F

from chatterlens import schemas as S
from chatterlens import session
from chatterlens.operators import features as E
from chatterlens.operators import training as M
from chatterlens.operators import validate as V
from chatterlens.sources import files, streams
from chatterlens.sources.models import ModelStore, ReloadingModel
from chatterlens.sources.streams import Topic
from chatterlens.streaming import jobs

TEXTS = [("good great love", "positive"), ("bad awful hate", "negative"), ("table chair door", "neutral")] * 20


def record(i, body="long enough body", utc=None):
    return {"id": f"{i:03d}", "author": "a", "created_utc": 100 + i if utc is None else utc, "body": body, "score": i,
            "subreddit": "s", "controversiality": 0, "extra": {"x": 1}}


def test_zst_dump_keeps_line_order(spark, tmp_path):
    lines = [json.dumps(record(i, body=f"zeile é {i} 😀")) for i in range(300)] + ["broken"]
    (tmp_path / "dump.zst").write_bytes(zstandard.ZstdCompressor().compress("\n".join(lines).encode()))
    dump = files.read_dump(spark, str(tmp_path / "dump.zst"))
    assert [r.value for r in dump.orderBy(*files.DUMP_ORDER).collect()] == lines
    parsed = V.parse_json_lines(dump)
    assert parsed.filter("is_json").count() == 300
    assert V.stop_after_max_time(parsed.filter("is_json"), 150, "line").count() == 51


def test_dictionaries(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps({"a": "x", "b": "y"}))
    assert files.read_dictionary(spark, str(tmp_path / "d.json")) == {"a": "x", "b": "y"}
    (tmp_path / "d.csv").write_text('key,value\na,"x, y"\n')
    assert files.read_dictionary(spark, str(tmp_path / "d.csv")) == {"a": "x, y"}


def test_chunk_read_is_pruned(spark, folder):
    spark.range(100).withColumn("chunk_id", F.col("id") % 5).write.partitionBy("chunk_id").parquet(folder("c"))
    plan = files.read_chunks(spark, folder("c"), [2])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(chunk_id" in plan


def test_filters_reach_the_scan(spark):
    from chatterlens.plans import tables as D

    kept = V.time_range_filter(D.comments(spark, "/root/testdata/sf0.001")).select("id")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint>" in plan


def test_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Remote:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://somewhere"
            getConf = staticmethod(lambda: Remote.conf)

    monkeypatch.setattr(session, "_checkpoint_dir", lambda spark: None)
    with pytest.raises(RuntimeError):
        session.shared_dir(Remote)


def test_clean_stream_restarts_where_it_stopped(spark, tmp_path):
    raw, out, check = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "check")
    raw.mkdir()
    for part in range(3):
        (raw / f"{part}.json").write_text("\n".join([json.dumps(record(10 * part + i)) for i in range(5)] + ["oops"]))
        jobs.clean_stream(spark, Topic(str(raw)), Topic(out), check, available_now=True).awaitTermination()
    values = [json.loads(r.value) for r in spark.read.text(out).collect()]
    assert sorted(v["id"] for v in values if "id" in v) == [f"{10 * p + i:03d}" for p in range(3) for i in range(5)]
    assert sum("error" in v for v in values) == 3
    good = next(v for v in values if "id" in v)
    assert set(good) == set(S.CLEANED_COMMENT.fieldNames())


def test_sink_keeps_event_time_for_topics(spark):
    from chatterlens.operators.records import json_values

    row = json_values(spark.createDataFrame([("a", 5)], "id string, created_utc bigint"), "created_utc").first()
    assert json.loads(row.value) == {"id": "a", "created_utc": 5}
    assert row.timestamp is not None


def test_console_and_repeats(spark, tmp_path, capfd):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.json").write_text("\n".join(json.dumps(record(i % 4)) for i in range(8)))
    rows = jobs.parsed(streams.source(spark, Topic(str(raw))), S.RAW_COMMENT)
    timed = rows.withColumn("at", F.timestamp_seconds("created_utc"))
    once = streams.distinct_within(timed, "id", "at", "1 hour").select("id")
    streams.sink(once, Topic(str(tmp_path / "out")), str(tmp_path / "c1"), available_now=True).awaitTermination()
    assert spark.read.json(str(tmp_path / "out")).count() == 4
    streams.console_sink(rows.select("id"), str(tmp_path / "c2"), available_now=True).awaitTermination()


def labeled(spark):
    rows = [(f"{i:03d}", t, label) for i, (t, label) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "id string, cleaned_body string, label string")


@pytest.fixture
def store(spark, folder):
    texts = labeled(spark)
    vectorizer = E.Vectorizer.fit(texts, 2, 100)
    store = ModelStore(spark, folder("models"))
    assert store.current_version() is None
    store.publish(vectorizer, M.train_naive_bayes(M.with_class(vectorizer.transform(texts))))
    return store


def test_model_round_trip(spark, store):
    model = store.load()
    assert model.version == 1
    got = M.predict_label(labeled(spark).drop("label"), model.vectorizer, model.classifier)
    assert {(r.cleaned_body, r.label) for r in got.collect()} == set(TEXTS)
    empty = spark.createDataFrame([("1", ""), ("2", None)], "id string, cleaned_body string")
    assert [r.label for r in M.predict_label(empty, model.vectorizer, model.classifier).collect()] == ["unknown"] * 2


def test_reload_at_most_every_interval(spark, store):
    now = [0.0]
    current = ReloadingModel(store, 3000, clock=lambda: now[0])
    first = current.get()
    assert first.version == 1
    store.publish(first.vectorizer, first.classifier)
    now[0] = 2999.0
    assert current.get() is first
    now[0] = 3000.0
    assert current.get().version == 2
    store.load = lambda version=None: 1 / 0
    store.current_version = lambda: 3
    now[0] = 9000.0
    assert current.get().version == 2


def test_retraining_gathers_until_full(spark, store, folder):
    retrainer = jobs.Retrainer(spark, store, folder("state"), at_least=50)
    values = [json.dumps({"id": "1", "created_utc": 1, "subreddit": "s", "score": 1, "cleaned_body": t, "label": label, "original_length": 3})
              for t, label in TEXTS]
    values += [values[0].replace("positive", "unknown")] * 5
    halves = [spark.createDataFrame([(v,) for v in values[i::2]], "value string") for i in (0, 1)]
    retrainer.process(halves[0], 0)
    retrainer.process(halves[0], 0)
    assert store.current_version() == 1 and retrainer.pending().count() == 30
    mark, retrainer.trained.write = retrainer.trained.write, lambda *_: (_ for _ in ()).throw(OSError("lost"))
    with pytest.raises(OSError):
        retrainer.process(halves[1], 1)
    assert store.current_version() == 2
    retrainer.trained.write = mark  # the replay finds the version that it had published
    retrainer.process(halves[1], 1)
    assert store.current_version() == 2
    assert retrainer.trained.read().first().n == 60
    assert retrainer.pending().count() == 0


def test_session_state_stream(spark, tmp_path):
    from chatterlens.sources.results import BatchTable

    calls, state = tmp_path / "calls", BatchTable(spark, str(tmp_path / "state"), jobs.SESSION_COLUMNS)
    calls.mkdir()
    for part, actions in enumerate(["start", "stop", "start"]):
        event = {"seq": part, "user_id": "u", "action": actions, "keyword1": "a", "keyword2": "b", "event_utc": part}
        (calls / f"{part}.json").write_text(json.dumps(event))
        jobs.session_stream(spark, Topic(str(calls)), state, str(tmp_path / "c"), available_now=True).awaitTermination()
        time.sleep(0.01)
        from chatterlens.operators.sessions import latest_session_per_user

        live = latest_session_per_user(state.read()).count()
        assert live == (0 if actions == "stop" else 1)


def test_chunks_lie_in_few_files(spark, folder):
    """Rows of every chunk in every task end in about one file a chunk."""
    rows = spark.range(4000).selectExpr("id", "id % 40 AS chunk_id").repartition(8)
    files.write_chunks(rows, folder("chunks"))
    read = files.read_chunks(spark, folder("chunks"))
    assert len(read.inputFiles()) <= 48 and sorted(r.id for r in read.select("id").collect()) == list(range(4000))
