"""Keyword matching, count windows and responses."""

from pyspark.sql import functions as F

from chatterlens.functions.text import clean_text
from chatterlens.operators import keywords as K
from chatterlens.operators import sequence as Q
from chatterlens.operators import validate as V
from chatterlens.plans import tables as D
from chatterlens.plans.registry import query

N = 50

# Valid comments in arrival order, cut into windows, and every (comment, user, slot) match.
BASE_CTE = f"""WITH {D.CLEANED_CTE}, {D.REQUESTS_CTE},
valid AS (SELECT *, row_number() OVER (ORDER BY created_utc, CAST(id AS BIGINT)) - 1 AS seq
          FROM cleaned WHERE {D.VALID_SQL}),
windows AS (SELECT *, seq // {N} AS window_no FROM valid WHERE seq < (SELECT count(*) // {N} * {N} FROM valid)),
slots AS (SELECT user_id, req_seq, 1 AS slot, keyword1 AS keyword FROM requests
          UNION ALL SELECT user_id, req_seq, 2, keyword2 FROM requests),
words AS (SELECT DISTINCT keyword, string_split(lower(keyword), ' ') AS needed FROM slots),
matches AS (SELECT w.*, k.keyword FROM windows w JOIN words k
            ON list_has_all(string_split(w.cleaned_body, ' '), k.needed)
            OR list_has_all(string_split_regex(lower(w.subreddit), '[^a-z0-9_]+'), k.needed))"""
_COUNTS = """count(*) FILTER (WHERE label = 'positive') AS positive, count(*) FILTER (WHERE label = 'negative') AS negative,
    count(*) FILTER (WHERE label = 'neutral') AS neutral,
    count(*) FILTER (WHERE label NOT IN ('positive', 'negative', 'neutral')) AS other, count(*) AS total"""
_SCORE = "round(coalesce((positive + 0.5 * neutral) / nullif(total, 0), -1), 6)"


def arrival_order():
    return ["created_utc", F.col("id").cast("bigint")]


KEY = ["id", "created_utc"]


def valid(spark, sf_dir):
    return V.valid_comments(D.comments(spark, sf_dir))


def windows(spark, sf_dir, n=N):
    """Keys of the valid comments, numbered and cut into windows. No text is moved."""
    return Q.count_windows(valid(spark, sf_dir).select(*KEY), n, arrival_order())


def matches(spark, sf_dir, numbered=None):
    texts = valid(spark, sf_dir).withColumn("cleaned_body", clean_text(F.col("body")))
    keywords = K.distinct_keywords(D.requests(spark, sf_dir))
    return K.window_matches(texts, keywords, windows(spark, sf_dir) if numbered is None else numbered, KEY)


def responses(spark, sf_dir, requests, reset_on_request=True):
    numbered = windows(spark, sf_dir)
    return _rounded(K.keyword_response(numbered, requests, N, reset_on_request, matches(spark, sf_dir, numbered)))


def _response_sql(from_seq: str) -> str:
    return f"""{BASE_CTE},
ends AS (SELECT window_no, max_by(created_utc, seq) AS last_utc FROM windows GROUP BY window_no),
active AS (SELECT e.window_no, e.last_utc, r.* FROM ends e JOIN requests r ON r.req_seq < (e.window_no + 1) * {N}
           QUALIFY row_number() OVER (PARTITION BY e.window_no, r.user_id ORDER BY r.req_seq DESC) = 1),
counted AS (SELECT a.window_no, a.user_id, {", ".join(
    f'''count(*) FILTER (WHERE m.keyword = a.keyword{i} AND m.label = 'positive') AS p{i},
        count(*) FILTER (WHERE m.keyword = a.keyword{i} AND m.label = 'neutral') AS n{i},
        count(*) FILTER (WHERE m.keyword = a.keyword{i}) AS total{i}''' for i in (1, 2))}
    FROM active a LEFT JOIN matches m ON m.window_no = a.window_no AND m.seq >= {from_seq} GROUP BY ALL)
SELECT a.window_no, a.user_id,
  a.keyword1, round(coalesce((p1 + 0.5 * n1) / nullif(total1, 0), -1), 6) AS value1, total1,
  a.keyword2, round(coalesce((p2 + 0.5 * n2) / nullif(total2, 0), -1), 6) AS value2, total2,
  strftime(make_timestamp(a.last_utc * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS timestamp
FROM active a JOIN counted c USING (window_no, user_id)"""


def _rounded(responses):
    return responses.withColumns({f"value{i}": F.round(f"value{i}", 6) for i in (1, 2)})


@query("keyword_response", _response_sql("0"))
def keyword_response(spark, sf_dir):
    return responses(spark, sf_dir, D.requests(spark, sf_dir), reset_on_request=False)


@query("request_resets_counts", _response_sql("a.req_seq"))
def request_resets(spark, sf_dir):
    return responses(spark, sf_dir, D.requests(spark, sf_dir))


@query("count_window", f"{BASE_CTE} SELECT id, seq, window_no FROM windows")
def _count_window(spark, sf_dir):
    return windows(spark, sf_dir).select("id", "seq", "window_no")


@query("requests_x_comments", f"{BASE_CTE} SELECT m.id, s.user_id, s.slot, s.keyword FROM matches m JOIN slots s USING (keyword)")
def _requests_x_comments(spark, sf_dir):
    pairs = K.by_slot(matches(spark, sf_dir), D.requests(spark, sf_dir))
    return pairs.select("id", "user_id", "slot", "keyword")


@query("keyword_label_counts", f"{BASE_CTE} SELECT window_no, keyword, {_COUNTS} FROM matches GROUP BY ALL")
def _label_counts(spark, sf_dir):
    return K.keyword_label_counts(matches(spark, sf_dir), ["window_no", "keyword"])


@query("positivity_score", f"""{BASE_CTE}, counted AS (SELECT window_no, keyword, {_COUNTS} FROM matches GROUP BY ALL)
    SELECT *, {_SCORE} AS score FROM counted""")
def _positivity(spark, sf_dir):
    counts = K.keyword_label_counts(matches(spark, sf_dir), ["window_no", "keyword"])
    return K.scored(counts).withColumn("score", F.round("score", 6))


@query("keyword_time_range", f"""{BASE_CTE} SELECT m.window_no, s.user_id, s.keyword,
    min(created_utc) AS min_timestamp, max(created_utc) AS max_timestamp
    FROM matches m JOIN slots s USING (keyword) GROUP BY ALL""")
def _time_range(spark, sf_dir):
    pairs = K.by_slot(matches(spark, sf_dir), D.requests(spark, sf_dir))
    return K.keyword_time_range(pairs, ["window_no", "user_id", "keyword"])


@query("window_first_last_time", f"""{BASE_CTE} SELECT window_no, min_by(created_utc, seq) AS first_utc,
    max_by(created_utc, seq) AS last_utc FROM windows GROUP BY window_no""")
def _first_last(spark, sf_dir):
    return K.window_first_last_time(windows(spark, sf_dir))


@query("pos_neg_counts", f"""{BASE_CTE} SELECT keyword, count(*) FILTER (WHERE label = 'positive') AS positive,
    count(*) FILTER (WHERE label = 'negative') AS negative FROM matches GROUP BY keyword""")
def _pos_neg(spark, sf_dir):
    return K.pos_neg_counts(matches(spark, sf_dir))


_TREND = f"""{BASE_CTE}, trend_matches AS (SELECT c.*, k.keyword FROM cleaned c JOIN words k
      ON list_has_all(string_split(c.cleaned_body, ' '), k.needed)
      OR list_has_all(string_split_regex(lower(c.subreddit), '[^a-z0-9_]+'), k.needed)),
    counted AS (SELECT make_timestamp(created_utc // 300 * 300 * 1000000) AS window_start, keyword, {_COUNTS}
      FROM trend_matches GROUP BY ALL),
    trend AS (SELECT *, {_SCORE} AS score FROM counted)"""


def _trend(spark, sf_dir):
    trend = K.keyword_trend(D.cleaned(spark, sf_dir), D.requests(spark, sf_dir))
    return trend.withColumn("score", F.round("score", 6))


@query("keyword_trend_5min", f"{_TREND} SELECT * FROM trend")
def _keyword_trend(spark, sf_dir):
    return _trend(spark, sf_dir).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("compare_keywords", f"""{_TREND} SELECT window_start,
    max(score) FILTER (WHERE keyword = 'the') AS value1, coalesce(max(total) FILTER (WHERE keyword = 'the'), 0) AS total1,
    max(score) FILTER (WHERE keyword = 'of') AS value2, coalesce(max(total) FILTER (WHERE keyword = 'of'), 0) AS total2
    FROM trend WHERE keyword IN ('the', 'of') GROUP BY window_start""")
def _compare(spark, sf_dir):
    compared = K.compare_keywords(_trend(spark, sf_dir), "the", "of", "window_start")
    return compared.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("latest_request_per_user", f"""WITH {D.COMMENTS_CTE}, asked AS (
      SELECT author AS user_id, subreddit AS keyword1, label AS keyword2, CAST(id AS BIGINT) AS req_seq FROM comments)
    SELECT * FROM asked QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY req_seq DESC) = 1""")
def _latest_request(spark, sf_dir):
    asked = D.comments(spark, sf_dir).selectExpr(
        "author AS user_id", "subreddit AS keyword1", "label AS keyword2", "CAST(id AS BIGINT) AS req_seq"
    )
    return K.latest_request_per_user(asked)
