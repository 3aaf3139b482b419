"""Hand-written cases for the points where results are easy to get wrong."""

import pytest
from pyspark.sql import functions as F

from chatterlens.functions import labels as L
from chatterlens.functions import lexicon as X
from chatterlens.functions import matching as M
from chatterlens.functions import text as T
from chatterlens.operators import analytics as A
from chatterlens.operators import keywords as K
from chatterlens.operators import records as R
from chatterlens.operators import sessions as U
from chatterlens.operators import validate as V


def apply(spark, function, *inputs):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r.out for r in rows.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


CLEAN = [
    ("lol", "laughing out loud"), ("lol!", "lol"), ("IG", "ig"), ("$ 5", "dollar 5"), ("$5", "5"),
    ("you/me", "yo"), ("and/or/not", "ando"), ("a https://x.y/z b", "a b"), ("www.t.org", ""),
    ("cannot gonna", "can not gon na"), ("Café", "caf"), ("hi 😀", "hi grinningface"), ("!!!!!!!!!!", ""),
    ("u/é1 x", "x"), ("a lol b\x1cc", "a laughing out loud b c"), (None, ""), ("GOTTA lemme wanna gimme", "got ta lem me wan na gim me"),
    ("no👎👎way", "no thumbsdown thumbsdown way"), ("❤️", "redheart"),
]


def test_clean_text(spark):
    got = apply(spark, T.clean_text, *[raw for raw, _ in CLEAN])
    assert got == [clean for _, clean in CLEAN]


def test_large_dictionary_lookup(spark):
    entries = {f"w{i}": f"v{i}" for i in range(5000)}
    got = apply(spark, lambda c: T.dictionary_lookup(c, entries), "w0", "w4999", "w5000", None)
    assert got == ["v0", "v4999", None, None]


MATCH = [
    ("i love cats", "LOVE  cats", True), ("i love cats", "cat", False), ("i love cats", "c++", False),
    ("i love cats", "", False), ("", "love", False), (None, "love", False), ("any", "  ", True),
    ("use c++x now", "c++", True), ("a-b", "-", True), ("été_1 ok", "été_1", True),
]


@pytest.mark.parametrize("as_column", [True, False])
def test_keyword_match(spark, as_column):
    for text, keyword, expected in MATCH:
        row = spark.createDataFrame([(text, keyword)], "t string, k string")
        asked = F.col("k") if as_column else keyword
        assert row.select(M.keyword_match(F.col("t"), asked)).first()[0] is expected, (text, keyword)


def test_inverted_match_equals_direct_match(spark):
    comments = spark.createDataFrame(
        [(i, t or "", "ask-forum" if i % 2 else "cats") for i, (t, _, _) in enumerate(MATCH)]
        + [(90, "good", "love"), (91, "", "love"), (92, "good love", ""), (93, "", "")],
        "id int, cleaned_body string, subreddit string",
    )
    keywords = [k for _, k, _ in MATCH] + ["good love", "ask-forum", "k-f", "love", "c", "++"]
    table = spark.createDataFrame([(k,) for k in set(keywords) if k], "keyword string")
    got = {(r.id, r.keyword) for r in K.keyword_matches(comments, table).collect()}
    expected = set()
    for keyword in set(keywords):
        hit = M.comment_matches(F.col("cleaned_body"), F.col("subreddit"), keyword)
        expected |= {(r.id, keyword) for r in comments.filter(hit).collect()}
    assert got == expected
    assert (90, "good love") not in got and (92, "good love") in got


def test_salted_match_equals_broadcast(spark, monkeypatch):
    from chatterlens.operators import joins

    comments = spark.createDataFrame(
        [(i, "the cat sat" if i % 3 else "the dog", "pets") for i in range(60)],
        "id int, cleaned_body string, subreddit string",
    )
    keywords = spark.createDataFrame([("the",), ("cat sat",), ("pets",), ("bird",)], "keyword string")
    usual = sorted(tuple(r) for r in K.keyword_matches(comments, keywords).collect())
    monkeypatch.setattr(joins.sized_join, "__defaults__", ("inner", 0, 4))
    salted = K.keyword_matches(comments, keywords)
    assert sorted(tuple(r) for r in salted.collect()) == usual
    assert len(usual) == 60 + 40 + 60


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_salted_join(spark, how):
    from chatterlens.operators.joins import sized_join

    big = spark.createDataFrame([(i % 3, i) for i in range(50)], "k int, v int")
    small = spark.createDataFrame([(0, "a"), (1, "b")], "k int, name string")
    usual = sorted(map(tuple, sized_join(big, small, ["k"], how).collect()))
    salted = sorted(map(tuple, sized_join(big, small, ["k"], how, max_rows=1, salts=5).collect()))
    assert salted == usual


@pytest.mark.parametrize("hot", [False, True])
def test_salted_join_is_not_broadcast(spark, hot):
    """Spark does not count the rows that the salts repeat; only the marks of hot keys may be broadcast."""
    from chatterlens.operators.joins import sized_join

    big = spark.createDataFrame([(i % 3, i) for i in range(50)] + [(None, 50)], "k int, v int")
    small = spark.createDataFrame([(0, "a", 17), (1, "b", 9), (2, "c", 0)], "k int, name string, n int")
    for how in ("inner", "left", "left_semi"):
        salted = sized_join(big, small, ["k"], how, max_rows=1, salts=5, hot=F.col("n") > 10 if hot else None)
        plan = salted._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.count("BroadcastHashJoin") == hot
        assert salted.columns == sized_join(big, small, ["k"], how).columns
        assert sorted(map(str, salted.collect())) == sorted(map(str, sized_join(big, small, ["k"], how).collect()))


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


COMMENT = '{"id":"1","author":"a","created_utc":%s,"body":%s,"score":1,"subreddit":"s","controversiality":0}'


def test_reject_reasons(spark):
    cases = [
        ("bad", "invalid_json"), ("[1]", "missing_field"), ("5", "missing_field"), ('{"id":"1"}', "missing_field"),
        (COMMENT % (5, "null"), "bad_body"), (COMMENT % (5, '"  [Removed] "'), "deleted"),
        (COMMENT % (5, '"123456789"'), "too_short"), (COMMENT % (5, '" 1234567890 "'), None),
        (COMMENT % ('"soon"', '"1234567890"'), "bad_time"), (COMMENT % ('"7"', '"1234567890"'), None),
        (COMMENT % (7.9, '"1234567890"'), None), (COMMENT % (99, '"1234567890"'), "after_max"),
        (COMMENT % (-9, '"1234567890"'), "before_min"), ("", "invalid_json"),
    ]
    frame = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(cases)], "i int, value string")
    checked = V.validate_comment(V.parse_json_lines(frame), max_utc=50, from_json_lines=True)
    got = {r.i: r.reject_reason for r in checked.collect()}
    assert got == {i: reason for i, (_, reason) in enumerate(cases)}


def test_positivity(spark):
    counts = spark.createDataFrame([(2, 1, 4), (0, 0, 2), (0, 0, 0)], "positive bigint, neutral bigint, total bigint")
    assert [r.score for r in K.scored(counts).collect()] == [0.625, 0.0, -1.0]


def test_unknown_label_for_empty_text(spark):
    rows = spark.createDataFrame([("", "positive"), ("x", "positive"), ("x", None)], "cleaned_body string, label string")
    filled = rows.selectExpr("'1' AS id", "0L AS created_utc", "'s' AS subreddit", "1L AS score", "*", "1 AS original_length")
    assert [r.label for r in R.labeled_record(filled, F.col("label")).collect()] == ["unknown", "positive", "unknown"]


def test_constant_group_has_no_correlation(spark):
    rows = spark.createDataFrame([("a", "positive", 5, 0), ("a", "negative", 5, 1)], "subreddit string, label string, score bigint, controversiality int")
    found = A.subreddit_correlation(rows, 1).first()
    assert found.label_vs_score is None and round(found.label_vs_controversiality, 6) == -1.0
    ranked = A.top_correlated(A.subreddit_correlation(rows, 1)).collect()
    assert len(ranked) == 1


def test_cumulative_average(spark):
    points = [("u", 0, 0.5, 4), ("u", 1, -1.0, 0), ("u", 2, 1.0, 4)]
    series = spark.createDataFrame([(u, w, v, t, -1.0, 0) for u, w, v, t in points], "user_id string, window_no bigint, value1 double, total1 bigint, value2 double, total2 bigint")
    got = U.cumulative_positivity(series, ["user_id"]).orderBy("window_no").collect()
    assert [r.avg1 for r in got] == [50.0, 50.0, 75.0]
    assert [r.avg2 for r in got] == [None, None, None]


def test_label_codes(spark):
    assert apply(spark, L.encode_label, "negative", "neutral", "positive", "error", None) == [0, 1, 2, None, None]
    assert apply(spark, lambda c: L.decode_label(c.cast("int")), "0", "2", "7", None) == ["negative", "positive", "unknown", "unknown"]
    assert apply(spark, L.sanitize_score, "-1", "0.5", "x") == [None, 0.5, None]
    assert apply(spark, L.display_time, "2019-04-01T13:05:00Z", "soon") == ["04/01/2019, 13:05:00", None]
    assert len(apply(spark, lambda c: L.request_time_string(), "")[0]) == 20


LEXICON = [
    ("", 0.0), ("plain words here", 0.0), ("good", 0.4404), ("GOOD day", 0.5622), ("not good", -0.3412),
    ("very good", 0.4927), ("good but bad", -0.5859), ("kind of good", 0.4404), ("it is kind of good", 0.3832),
]


def test_lexicon_scores(spark):
    got = apply(spark, X.lexicon_compound, *[t for t, _ in LEXICON])
    assert got == [s for _, s in LEXICON]


def test_dead_letters_and_errors(spark):
    frame = lines(spark, "bad", COMMENT % (5, '"long enough body"'))
    assert V.dead_letters(V.parse_json_lines(frame), from_json_lines=True).count() == 1
    assert R.cleaned_errors(frame).count() == 1
    assert R.labeled_errors(frame).first().label == "error"
