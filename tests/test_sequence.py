"""Two-level numbering, neighbours and running sums against plain Python, with tiny groups."""

import random

import pytest
from pyspark.sql import functions as F

from chatterlens.operators import sequence as Q


@pytest.fixture
def skewed(spark):
    rng = random.Random(5)
    # One second and one user hold most rows.
    rows = [(7 if i % 3 else rng.randrange(20), f"{i:05d}", "hot" if i % 4 else f"u{i % 5}", rng.randrange(9)) for i in range(600)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "created_utc bigint, id string, user string, v bigint")


def test_global_index(spark, skewed):
    rows, frame = skewed
    indexed, n = Q.index_and_count(frame.repartition(7), Q.COMMENT_ORDER)
    assert n == 600
    expected = {r[1]: i for i, r in enumerate(sorted(rows))}
    assert {r.id: r.seq for r in indexed.collect()} == expected


def test_global_index_of_nothing(spark):
    indexed, n = Q.index_and_count(spark.createDataFrame([], "created_utc bigint, id string"), Q.COMMENT_ORDER)
    assert n == 0 and indexed.count() == 0


@pytest.mark.parametrize("size,windows", [(100, 6), (301, 1), (600, 1), (601, 0)])
def test_only_full_windows(skewed, size, windows):
    found = Q.count_windows(skewed[1], size).groupBy("window_no").count().collect()
    assert sorted((r.window_no, r["count"]) for r in found) == [(i, size) for i in range(windows)]


@pytest.mark.parametrize("size", [1, 100, 301, 600, 1000])
@pytest.mark.parametrize("edges", [0, 10_000])
def test_row_chunks(spark, skewed, size, edges, monkeypatch):
    """By the chunks' first keys, and by numbering the rows themselves."""
    monkeypatch.setattr(Q, "MAX_EDGES", edges)
    rows, frame = skewed
    order = ["created_utc", F.col("id").cast("bigint")]
    found = {r.id: r.chunk_id for r in Q.row_chunks(frame, order, size).collect()}
    assert found == {r[1]: i // size + 1 for i, r in enumerate(sorted(rows))}


def test_row_chunks_of_nothing_and_of_nulls(spark):
    schema = "created_utc bigint, id string"
    assert Q.row_chunks(spark.createDataFrame([], schema), Q.COMMENT_ORDER, 5).count() == 0
    rows = [(None, "b"), (None, None), (3, 'quote " \\ é'), (3, None)]
    found = {(r.created_utc, r.id): r.chunk_id for r in Q.row_chunks(spark.createDataFrame(rows, schema), Q.COMMENT_ORDER, 1).collect()}
    assert found == {(None, None): 1, (None, "b"): 2, (3, None): 3, (3, 'quote " \\ é'): 4}


def test_row_chunks_by_time(spark):
    stamps = spark.range(20).select(F.timestamp_micros(F.lit(1_700_000_000_000_000) + (F.col("id") * 7) % 20).alias("at"))
    found = Q.row_chunks(stamps, ["at"], 3).withColumn("n", F.unix_micros("at") - 1_700_000_000_000_000)
    assert all(r.chunk_id == r.n // 3 + 1 for r in found.collect())


@pytest.mark.parametrize("width", [1, 7, 50, 10_000])
def test_running_sums_and_neighbours(spark, skewed, width):
    rows, frame = skewed
    indexed = Q.with_global_index(frame, Q.COMMENT_ORDER)
    summed = Q.running_sums(indexed, ["user"], "seq", {"cum": F.col("v")}, width)
    before = Q.neighbours(indexed, ["user"], "seq", {"prev": "id"}, -1, width)
    after = Q.neighbours(indexed, ["user"], "seq", {"next": "id"}, 1, width)
    cum, prev, nxt, total, last = {}, {}, {}, {}, {}
    for r in sorted(rows):
        total[r[2]] = total.get(r[2], 0) + r[3]
        cum[r[1]], prev[r[1]], nxt[r[1]] = total[r[2]], last.get(r[2]), None
        if r[2] in last:
            nxt[last[r[2]]] = r[1]
        last[r[2]] = r[1]
    assert {r.id: r.cum for r in summed.collect()} == cum
    assert {r.id: r.prev for r in before.collect()} == prev
    assert {r.id: r.next for r in after.collect()} == nxt


def test_batches_in_file_order(spark):
    times = [5, 5, 3, 3, 3, 5, 9]
    indexed = spark.createDataFrame(list(enumerate(times)), "seq bigint, created_utc bigint")
    batches = Q.same_second_batches(indexed)
    got = sorted((r.batch_no, r.created_utc, r.batch_size) for r in batches.collect())
    assert got == [(0, 5, 2), (1, 3, 3), (2, 5, 1), (3, 9, 1)]
    due = sorted((r.batch_no, r.delay_seconds, r.due_seconds) for r in Q.replay_schedule(batches, 2.0).collect())
    assert due == [(0, 0.0, 0.0), (1, 0.0, 0.0), (2, 1.0, 1.0), (3, 2.0, 3.0)]


@pytest.mark.parametrize("n", [0, 5, 250, 20_000])
def test_first_rows(spark, n):
    frame = spark.range(15_000).select((F.col("id") * 7 % 15_000).alias("k"))
    got = [r.k for r in Q.first_rows(frame, n, ["k"]).collect()]
    assert sorted(got) == list(range(n if 0 < n < 15_000 else 15_000))


def test_long_prefix_is_cut_by_number(spark):
    frame = spark.range(15_000).select((F.col("id") * 7 % 15_000).alias("k"))
    assert sorted(r.k for r in Q.first_rows(frame, 12_000, ["k"]).collect()) == list(range(12_000))
