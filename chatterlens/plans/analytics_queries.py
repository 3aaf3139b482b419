"""Counts, correlations, limits, samples and unions."""

from pyspark.sql import functions as F

from chatterlens.operators import analytics as A
from chatterlens.operators import sequence as Q
from chatterlens.operators import validate as V
from chatterlens.plans import keyword_queries as KQ
from chatterlens.plans import tables as D
from chatterlens.plans.registry import query

_WITH = f"WITH {D.COMMENTS_CTE}"
FREQUENT = 38
_VALID = f"{_WITH}, valid AS (SELECT * FROM comments WHERE {D.VALID_SQL})"


def _valid(spark, sf_dir):
    return V.valid_comments(D.comments(spark, sf_dir))


@query("subreddit_counts", f"{_VALID} SELECT subreddit, count(*) AS comments FROM valid GROUP BY 1 HAVING count(*) >= {FREQUENT}")
def _subreddit_counts(spark, sf_dir):
    return A.subreddit_counts(_valid(spark, sf_dir), FREQUENT)


@query("frequent_subreddits", f"""{_VALID} SELECT id, subreddit FROM valid
    QUALIFY count(*) OVER (PARTITION BY subreddit) >= {FREQUENT}""")
def _frequent(spark, sf_dir):
    return A.frequent_subreddits(_valid(spark, sf_dir).select("id", "subreddit"), FREQUENT)


@query("distinct_subreddits", f"{_WITH} SELECT DISTINCT subreddit FROM comments")
def _distinct(spark, sf_dir):
    return A.distinct_subreddits(D.comments(spark, sf_dir))


@query("label_distribution", f"""{_WITH} SELECT label, count(*) AS support,
    round(count(*) / (SELECT count(*) FROM comments), 6) AS share FROM comments GROUP BY label""")
def _distribution(spark, sf_dir):
    return A.label_distribution(D.comments(spark, sf_dir)).withColumn("share", F.round("share", 6))


_SIGN = "CASE label WHEN 'negative' THEN -1 WHEN 'neutral' THEN 0 WHEN 'positive' THEN 1 END"
_NUMERIC = f"{_WITH}, numeric AS (SELECT *, {_SIGN} AS label_numeric FROM comments)"
_VARIABLES = ["label_numeric", "score", "controversiality"]


def _corr_sql(a: str, b: str) -> str:
    both = f"FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
    return f"round(covar_samp({a}, {b}) {both} / nullif(stddev_samp({a}) {both} * stddev_samp({b}) {both}, 0), 6)"


@query("label_correlation", _NUMERIC + " UNION ALL ".join(
    f" SELECT '{a}' AS variable, " + ", ".join(f"{_corr_sql(a, b)} AS {b}" for b in _VARIABLES) + " FROM numeric"
    for a in _VARIABLES))
def _label_correlation(spark, sf_dir):
    matrix = A.label_correlation(D.comments(spark, sf_dir))
    return matrix.select("variable", *[F.round(v, 6).alias(v) for v in _VARIABLES])


_BY_SUBREDDIT = f"""{_NUMERIC}, correlations AS (SELECT subreddit, {_corr_sql('label_numeric', 'score')} AS label_vs_score,
    {_corr_sql('label_numeric', 'controversiality')} AS label_vs_controversiality
    FROM numeric WHERE label_numeric IS NOT NULL GROUP BY subreddit HAVING count(*) >= {FREQUENT})"""


def _correlations(spark, sf_dir):
    found = A.subreddit_correlation(D.comments(spark, sf_dir), FREQUENT)
    return found.withColumns({c: F.round(c, 6) for c in ("label_vs_score", "label_vs_controversiality")})


@query("subreddit_correlation", f"{_BY_SUBREDDIT} SELECT * FROM correlations")
def _subreddit_correlation(spark, sf_dir):
    return _correlations(spark, sf_dir)


@query("top_correlated", f"{_BY_SUBREDDIT} SELECT * FROM correlations ORDER BY label_vs_score DESC NULLS LAST, subreddit LIMIT 10")
def _top(spark, sf_dir):
    return A.top_correlated(_correlations(spark, sf_dir))


@query("bottom_correlated", f"{_BY_SUBREDDIT} SELECT * FROM correlations ORDER BY label_vs_score NULLS LAST, subreddit LIMIT 10")
def _bottom(spark, sf_dir):
    return A.bottom_correlated(_correlations(spark, sf_dir))


@query("limit_valid_rows", f"{_VALID} SELECT id FROM valid ORDER BY created_utc, CAST(id AS BIGINT) LIMIT 300")
def _limit_valid(spark, sf_dir):
    return A.limit_valid_rows(D.comments(spark, sf_dir), 300, KQ.arrival_order()).select("id")


@query("first_n_lines", f"{_WITH} SELECT id FROM comments ORDER BY created_utc, CAST(id AS BIGINT) LIMIT 400")
def _first_lines(spark, sf_dir):
    return A.first_n_lines(D.comments(spark, sf_dir).select("id", "created_utc"), 400, KQ.arrival_order()).select("id")


@query("bernoulli_sample", f"{_WITH} SELECT id, label FROM comments WHERE substr(md5(id || ':42'), 1, 8) < '40000000'")
def _sample(spark, sf_dir):
    return A.bernoulli_sample(D.comments(spark, sf_dir), 0.25).select("id", "label")


_CHUNKED = f"""{_WITH}, chunked AS (SELECT *, row_number() OVER (ORDER BY created_utc, CAST(id AS BIGINT)) - 1 AS row_no
    FROM comments), chunks AS (SELECT id, subreddit, label, row_no, row_no // 250 + 1 AS chunk_id FROM chunked)"""


def row_chunks(spark, sf_dir, *columns):
    comments = D.comments(spark, sf_dir).select("id", "created_utc", *columns)
    return Q.row_chunks(comments, KQ.arrival_order(), 250)


@query("row_chunks", f"{_CHUNKED} SELECT id, row_no, chunk_id FROM chunks")
def _row_chunks(spark, sf_dir):
    """Chunks, beside the row numbers that they must agree with."""
    chunked = row_chunks(spark, sf_dir)
    return Q.with_global_index(chunked, KQ.arrival_order(), "row_no").select("id", "row_no", "chunk_id")


@query("concat_chunks", f"""{_WITH} SELECT id, body AS text FROM comments
    UNION ALL SELECT concat(conv_id, ':', turn), text FROM conversations""")
def _concat(spark, sf_dir):
    turns = D.read_table(spark, sf_dir, "conversations").selectExpr("concat(conv_id, ':', turn) AS id", "text")
    return A.concat_chunks([D.comments(spark, sf_dir).selectExpr("id", "body AS text"), turns])


@query("union_distinct_values", f"""{_WITH} SELECT subreddit FROM comments UNION SELECT role FROM conversations""")
def _union_distinct(spark, sf_dir):
    roles = D.read_table(spark, sf_dir, "conversations").selectExpr("role AS subreddit")
    return A.union_distinct_values([D.comments(spark, sf_dir), roles], "subreddit")
