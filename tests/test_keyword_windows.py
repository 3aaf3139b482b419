"""Responses against a row-by-row state machine, in batch and as a stream."""

import json
import random
import re
from datetime import datetime, timezone

import pytest
from conftest import SF_DIR

from chatterlens.operators import analytics as A
from chatterlens.operators import keywords as K
from chatterlens.operators import sequence as Q
from chatterlens.operators import validate as V
from chatterlens.plans import keyword_queries as KQ
from chatterlens.plans import tables as D
from chatterlens.sources.streams import Topic
from chatterlens.streaming import jobs
from chatterlens.streaming.windows import KeywordWindows, keyword_stream, request_stream

WORDS = ["red", "blue", "green", "sky"]
LABELS = ["positive", "neutral", "negative", "unknown"]
N = 6


def iso(t):
    return datetime.fromtimestamp(t, timezone.utc).isoformat().replace("+00:00", "Z")


def replay(comments, requests, reset):
    """Responses when requests and comments are taken one at a time, in order."""
    active, counts, out, seen = {}, {}, [], 0

    def fresh():
        return {k: [0.0, 0] for k in WORDS}

    for position, comment in enumerate(comments):
        for r in requests:
            if r[3] == position:
                if reset or r[0] not in counts:
                    counts[r[0]] = fresh()
                active[r[0]] = r
        for user in active:
            for word in set(comment["cleaned_body"].split()):
                counts[user][word][0] += {"positive": 1, "neutral": 0.5}.get(comment["label"], 0)
                counts[user][word][1] += 1
        seen += 1
        if seen == N:
            for user, (_, a, b, _) in active.items():
                (va, ta), (vb, tb) = counts[user][a], counts[user][b]
                out.append((position // N, user, a, va / ta if ta else -1.0, ta, b, vb / tb if tb else -1.0, tb, iso(comment["created_utc"])))
                counts[user] = fresh()
            seen = 0
    return sorted(out)


def conversation(seed, n=45):
    rng = random.Random(seed)
    comments = [
        {"id": f"{i:04d}", "created_utc": 1000 + i // 3, "subreddit": "f", "score": 1,
         "cleaned_body": " ".join(rng.choices(WORDS, k=2)), "label": rng.choice(LABELS), "original_length": 3}
        for i in range(n)
    ]
    spots = rng.sample(range(n), 7)
    requests = [(f"u{rng.randrange(3)}", *rng.sample(WORDS, 2), s) for s in sorted(spots)]
    return comments, requests


def as_rows(frame):
    return sorted(
        (r.window_no, r.user_id, r.keyword1, r.value1, r.total1, r.keyword2, r.value2, r.total2, r.timestamp)
        for r in frame.collect()
    )


@pytest.mark.parametrize("seed", range(6))
def test_requests_inside_windows(spark, seed):
    comments, requests = conversation(seed)
    frame = spark.createDataFrame(comments)
    asked = spark.createDataFrame(requests, "user_id string, keyword1 string, keyword2 string, req_seq bigint")
    windows = Q.count_windows(frame, N)
    assert as_rows(K.keyword_response(windows, asked, N, reset_on_request=True)) == replay(comments, requests, True)


def test_equal_keywords_count_once_per_slot(spark):
    comments = conversation(1)[0][:N]
    asked = spark.createDataFrame([("u", "red", "red", 0)], "user_id string, keyword1 string, keyword2 string, req_seq bigint")
    row = K.keyword_response(Q.count_windows(spark.createDataFrame(comments), N), asked, N).first()
    assert row.total1 == row.total2 == sum("red" in c["cleaned_body"] for c in comments)


def write_lines(path, name, records):
    path.mkdir(exist_ok=True)
    (path / name).write_text("".join(json.dumps(r) + "\n" for r in records))


@pytest.mark.parametrize("reset", [True, False])
@pytest.mark.parametrize("cuts", [[45], [10, 12, 36, 45], [6, 18, 45]])
def test_stream_equals_state_machine(spark, tmp_path, cuts, reset):
    """Requests come between micro-batches; each batch is a new start from the checkpoint."""
    comments, _ = conversation(3)
    rng, requests, start = random.Random(9), [], 0
    job = KeywordWindows(spark, str(tmp_path / "state"), N, reset_on_request=reset)
    said, asked = tmp_path / "said", tmp_path / "asked"
    for i, cut in enumerate(cuts):
        # A user's later request keeps the keywords when counts are not reset by it.
        fresh = [(f"u{u}", *(rng.sample(WORDS, 2) if reset else WORDS[u:u + 2]), start) for u in rng.sample(range(3), 2)]
        requests += fresh
        write_lines(asked, f"{i}.json", [
            {"user_id": u, "keyword1": a, "keyword2": b, "request_time": f"t{i}"} for u, a, b, _ in fresh
        ] + [{"user_id": "broken"}])
        request_stream(spark, Topic(str(asked)), job, str(tmp_path / "c1"), available_now=True).awaitTermination()
        write_lines(said, f"{i}.json", [*comments[start:cut], {"error": "no record"}])
        keyword_stream(spark, Topic(str(said)), job, str(tmp_path / "c2"), Topic(str(tmp_path / "out")), available_now=True).awaitTermination()
        start = cut
        job = KeywordWindows(spark, str(tmp_path / "state"), N, reset_on_request=reset)
    expected = replay(comments, requests, reset)
    assert as_rows(job.responses.read()) == expected
    sent = spark.read.option("recursiveFileLookup", True).json(str(tmp_path / "out"))
    assert sent.count() == len(expected) and "window_no" not in sent.columns


def test_replayed_batch_changes_nothing(spark, tmp_path):
    comments, _ = conversation(4)
    job = KeywordWindows(spark, str(tmp_path), N)
    ask = [json.dumps({"user_id": "u", "keyword1": "red", "keyword2": "sky", "request_time": "t"})]
    job.add_requests(spark.createDataFrame([(a,) for a in ask], "value string"), 0)
    batches = [
        spark.createDataFrame([(json.dumps(c),) for c in part], "value string")
        for part in (comments[:10], comments[10:30], comments[30:])
    ]
    for batch_id, batch in enumerate(batches):
        job.process(batch, batch_id)
        once = as_rows(job.responses.read())
        job.process(batch, batch_id)
        assert as_rows(job.responses.read()) == once
    assert once == replay(comments, [("u", "red", "sky", 0)], True)


def test_repeated_comments_count_once_each(spark, folder):
    """Two deliveries of one comment are two comments, as the state machine counts them."""
    comments, _ = conversation(3)
    doubled = sorted([*comments, *comments[:5]], key=lambda c: (c["created_utc"], c["id"]))
    job = KeywordWindows(spark, folder("state"), N)
    ask = [json.dumps({"user_id": "u", "keyword1": "red", "keyword2": "sky", "request_time": iso(0)})]
    job.add_requests(spark.createDataFrame([(a,) for a in ask], "value string"), 0)
    job.process(spark.createDataFrame([(json.dumps(c),) for c in doubled], "value string").repartition(3), 0)
    assert as_rows(job.responses.read()) == replay(doubled, [("u", "red", "sky", 0)], True)


def test_observed_counts_equal_the_batch_query(spark, folder):
    """Counts of each micro-batch, observed in the pass that writes it, against the batch query on its lines."""
    lines = [f'{{"id":"{i}","author":"a","created_utc":{i},"body":"{"long enough text" if i % 3 else "x"}","score":1,"subreddit":"s","controversiality":0}}' for i in range(40)]
    lines[5], lines[17], lines[33] = "broken", '{"id":"1"}', "[1]"
    for n in range(4):
        spark.createDataFrame([(v,) for v in lines[n * 10: n * 10 + 10]], "value string").coalesce(1).write.mode("append").text(folder("dump"))
        query = jobs.ingest_stream(spark, Topic(folder("dump")), Topic(folder("raw")), folder("check"), available_now=True)
        query.awaitTermination()
        found = jobs.ingest_progress(query)
        part = spark.createDataFrame([(i, v) for i, v in enumerate(lines[n * 10: n * 10 + 10])], "n int, value string")
        wanted = A.ingest_metrics(V.parse_json_lines(part), "n").first().asDict()
        assert len(found) == 1 and found[0]["batch_id"] == n
        assert {k: found[0][k] for k in found[0] if k != "batch_id"} == {k: wanted[k] for k in wanted if k != "success_rate"}
    assert spark.read.text(folder("raw")).count() == sum(1 for i, v in enumerate(lines) if i % 3 and i not in (5, 17, 33))


def test_matching_plan_has_no_nested_loop(spark):
    comments, requests = conversation(2)
    asked = spark.createDataFrame(requests, "user_id string, keyword1 string, keyword2 string, req_seq bigint")
    matches = K.keyword_matches(spark.createDataFrame(comments), K.distinct_keywords(asked))
    plan = matches._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SortMergeJoin" not in plan


def exchanged(frame):
    """What the exchanges of a plan carry, one text per exchange."""
    plan = frame.sparkSession._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")
    sections = plan.split("\n\n")
    return [s for s in sections if re.match(r"\s*\(\d+\) (Broadcast)?Exchange", s)]


def test_texts_are_never_moved(spark, monkeypatch):
    """Neither the numbering nor any exchange of a response or a chunked table carries a body."""
    numbered = []
    original = Q.index_and_count

    def watched(df, *rest):
        numbered.append(df.columns)
        return original(df, *rest)

    monkeypatch.setattr(Q, "index_and_count", watched)
    asked = D.requests(spark, SF_DIR)
    windows = KQ.windows(spark, SF_DIR)
    matches = KQ.matches(spark, SF_DIR, windows)
    frames = [
        K.keyword_response(windows, asked, KQ.N, False, matches), K.by_slot(matches, asked),
        Q.row_chunks(D.cleaned(spark, SF_DIR), KQ.arrival_order(), 50),
    ]
    assert numbered and not any({"body", "cleaned_body"} & set(columns) for columns in numbered)
    moved = [section for frame in frames for section in exchanged(frame)]
    assert moved and not any("body" in section for section in moved), moved


def test_trend_window_edges(spark):
    rows = [("a", 299, "f", "positive"), ("a", 300, "f", "negative"), ("b", 300, "f", "neutral")]
    comments = spark.createDataFrame(rows, "cleaned_body string, created_utc bigint, subreddit string, label string")
    asked = spark.createDataFrame([("u", "a", "b", 0)], "user_id string, keyword1 string, keyword2 string, req_seq bigint")
    trend = K.keyword_trend(comments, asked)
    got = sorted((epoch_of(r.window_start), r.keyword, r.score, r.total) for r in trend.collect())
    assert got == [(0, "a", 1.0, 1), (300, "a", 0.0, 1), (300, "b", 0.5, 1)]


def epoch_of(stamp):
    return int(stamp.replace(tzinfo=timezone.utc).timestamp()) if stamp.tzinfo is None else int(stamp.timestamp())
