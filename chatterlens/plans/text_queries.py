"""Scalar text, matching, label and time functions over the whole comment table."""

from pyspark.sql import functions as F

from chatterlens import schemas as S
from chatterlens.functions import labels as L
from chatterlens.functions import matching as M
from chatterlens.functions import text as X
from chatterlens.functions.sql import register_sql_functions
from chatterlens.functions.wordlists import EMOJI, SLANG
from chatterlens.operators.joins import sized_join
from chatterlens.plans import tables as D
from chatterlens.plans.registry import query

_WITH = f"WITH {D.COMMENTS_CTE}"


def _one_column(name, function, sql, source="body"):
    @query(name, f"{_WITH} SELECT id, {sql} AS {name} FROM comments")
    def run(spark, sf_dir):
        return D.comments(spark, sf_dir).select("id", function(F.col(source)).alias(name))


_one_column("lowercase", X.lowercase, "lower(body)")
_one_column("expand_slang", X.expand_slang, D.duck_slang("body"))
_one_column("strip_user_mentions", X.strip_user_mentions, D.duck_remove("body", D.DUCK_USER))
_one_column("strip_forum_mentions", X.strip_forum_mentions, D.duck_remove("body", D.DUCK_FORUM))
_one_column("strip_urls", X.strip_urls, D.duck_remove("body", D.DUCK_URL))
_one_column("strip_non_alnum", X.strip_non_alnum, D.duck_remove("body", D.DUCK_NOT_ALNUM))
_one_column("collapse_whitespace", X.collapse_whitespace, D.duck_collapse("body"))
_one_column("tokenize_words", lambda c: X.tokenize_words(F.lower(c)), D.duck_tokenize("lower(body)"))
_one_column("clean_text", X.clean_text, D.duck_clean("body"))
_one_column("original_length", lambda c: X.original_length(c).cast("bigint"), "length(body)")
_one_column(
    "normalize_phrase", X.normalize_phrase, f"array_to_string({D.duck_words('lower(body)')}, ' ')"
)


def _duck_emoji(text: str) -> str:
    """Joined sequences by hand, then runs of characters below any emoji, listed sequences, and all other characters one by one."""
    for sequence, name in D.JOINED_EMOJI.items():
        text = f"replace({text}, '{sequence}', ' {name} ')"
    sequences = "|".join(sorted((e for e in EMOJI if len(e) > 1), key=len, reverse=True))
    pieces = f"regexp_extract_all({text}, '[\\x00-\\x{{A8}}]+|{sequences}|(?s:.)')"
    name = f"map_extract_value({D.duck_map(EMOJI)}, p)"
    known = f"CASE WHEN length(p) <= 2 AND ord(p) > 168 THEN {name} END"
    return f"array_to_string(list_transform({pieces}, lambda p: coalesce(' ' || {known} || ' ', p)), '')"


@query("emoji_to_words", f"WITH {D.EMOJI_CTE} SELECT id, {_duck_emoji('body')} AS named, "
       f"{D.duck_clean(_duck_emoji('lower(body)'))} AS cleaned_body FROM emoji_comments")
def _emoji_to_words(spark, sf_dir):
    return D.emoji_comments(spark, sf_dir).select(
        "id", X.emoji_to_words(F.col("body")).alias("named"), X.clean_text(F.col("body")).alias("cleaned_body")
    )


_KEYWORDS = {"m_the": "the", "m_two": "good  LOVE", "m_parted": "Laughing loud", "m_dotted": "g.o.a.t", "m_none": ""}


def _duck_match(text: str, keyword: str) -> str:
    words = keyword.lower().split()
    edge = "[^\\p{L}\\p{N}_]"
    tests = [
        f"regexp_matches(lower({text}), '(^|{edge}){w.replace('.', chr(92) + '.')}($|{edge})')" for w in words
    ]
    return "(" + " AND ".join(tests or ["false"]) + ")"


@query("keyword_match", f"{_WITH} SELECT id, "
       + ", ".join(f"{_duck_match('body', k)} AS {n}" for n, k in _KEYWORDS.items())
       + " FROM comments")
def _keyword_match(spark, sf_dir):
    body = F.col("body")
    return D.comments(spark, sf_dir).select(
        "id", *[M.keyword_match(body, keyword).alias(name) for name, keyword in _KEYWORDS.items()]
    )


# Words good + src8 lie apart in body and subreddit, so the pair must not match.
_EITHER = {"in_forum": "src7", "in_body": "worthless", "apart": "good src8"}


@query("comment_matches", f"WITH {D.CLEANED_CTE} SELECT id, "
       + ", ".join(
           f"{_duck_match('cleaned_body', k)} OR {_duck_match('subreddit', k)} AS {n}" for n, k in _EITHER.items())
       + " FROM cleaned")
def _comment_matches(spark, sf_dir):
    body, forum = F.col("cleaned_body"), F.col("subreddit")
    return D.cleaned(spark, sf_dir).select(
        "id", *[M.comment_matches(body, forum, F.lit(k)).alias(n) for n, k in _EITHER.items()]
    )


@query("encode_label", f"""{_WITH} SELECT id, label,
    CASE label WHEN 'negative' THEN 0 WHEN 'neutral' THEN 1 WHEN 'positive' THEN 2 END AS label_class,
    CASE label WHEN 'negative' THEN -1 WHEN 'neutral' THEN 0 WHEN 'positive' THEN 1 END AS label_sign
    FROM comments""")
def _encode_label(spark, sf_dir):
    label = F.col("label")
    return D.comments(spark, sf_dir).select(
        "id", "label", L.encode_label(label).alias("label_class"), L.label_sign(label).alias("label_sign")
    )


@query("decode_label", f"""{_WITH} SELECT id,
    coalesce(list_extract(['negative', 'neutral', 'positive'], score % 5 + 1), 'unknown') AS label
    FROM (SELECT id, abs(score) AS score FROM comments)""")
def _decode_label(spark, sf_dir):
    return D.comments(spark, sf_dir).select("id", L.decode_label(F.abs("score") % 5).alias("label"))


_ISO = "strftime(make_timestamp(created_utc * 1000000), '%Y-%m-%dT%H:%M:%SZ')"


@query("epoch_to_iso", f"{_WITH} SELECT id, {_ISO} AS iso FROM comments")
def _epoch_to_iso(spark, sf_dir):
    return D.comments(spark, sf_dir).select("id", L.epoch_to_iso(F.col("created_utc")).alias("iso"))


@query("epoch_to_millis", f"{_WITH} SELECT id, created_utc * 1000 AS record_millis FROM comments")
def _epoch_to_millis(spark, sf_dir):
    return D.comments(spark, sf_dir).select("id", L.epoch_to_millis(F.col("created_utc")).alias("record_millis"))


@query("display_time", f"""{_WITH} SELECT id,
    strftime(make_timestamp(created_utc * 1000000), '%m/%d/%Y, %H:%M:%S') AS shown FROM comments""")
def _display_time(spark, sf_dir):
    iso = L.epoch_to_iso(F.col("created_utc"))
    return D.comments(spark, sf_dir).select("id", L.display_time(iso).alias("shown"))




@query("request_time_string", f"{_WITH} SELECT author AS user_id, true AS well_formed, true AS is_now FROM comments")
def _request_time(spark, sf_dir):
    """Every author stamped with the time of the query: the format, and that it is this minute's."""
    stamped = D.comments(spark, sf_dir).select(F.col("author").alias("user_id"), L.request_time_string().alias("time"))
    age = F.unix_timestamp() - F.unix_timestamp(F.to_timestamp("time", "yyyy-MM-dd'T'HH:mm:ssX"))
    return stamped.select("user_id", F.rlike("time", F.lit(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ$")).alias("well_formed"), F.abs(age).between(0, 60).alias("is_now"))


@query("to_numeric_coerce", f"""{_WITH} SELECT id, round(TRY_CAST(loose AS DOUBLE), 6) AS number
    FROM (SELECT id, CASE WHEN score % 3 = 0 THEN 'n/a' ELSE CAST(score AS VARCHAR) END AS loose FROM comments)""")
def _to_numeric(spark, sf_dir):
    loose = F.expr("CASE WHEN score % 3 = 0 THEN 'n/a' ELSE CAST(score AS STRING) END")
    return D.comments(spark, sf_dir).select("id", F.round(L.to_numeric(loose), 6).alias("number"))


@query("sanitize_score", f"""{_WITH} SELECT id, nullif(TRY_CAST(loose AS DOUBLE), -1) AS value
    FROM (SELECT id, CASE WHEN score % 3 = 0 THEN 'n/a' WHEN score % 5 = 0 THEN '-1'
          ELSE CAST(score AS VARCHAR) END AS loose FROM comments)""")
def _sanitize(spark, sf_dir):
    loose = F.expr(
        "CASE WHEN score % 3 = 0 THEN 'n/a' WHEN score % 5 = 0 THEN '-1' ELSE CAST(score AS STRING) END"
    )
    return D.comments(spark, sf_dir).select("id", L.sanitize_score(loose).alias("value"))


@query("json_record", f"""{_WITH} SELECT id, author, created_utc, body, score, subreddit, controversiality
    FROM comments""")
def _json_record(spark, sf_dir):
    """Records written as JSON text and read back, field by field."""
    lines = D.comments(spark, sf_dir).select(F.to_json(F.struct(*S.REQUIRED_FIELDS)).alias("value"))
    return lines.select(F.from_json("value", S.RAW_COMMENT).alias("r")).select("r.*")


@query("sql_functions", f"""WITH {D.CLEANED_CTE} SELECT id, cleaned_body,
    {_duck_match('body', 'good  LOVE')} AS is_match, {_ISO} AS iso FROM cleaned""")
def _sql_functions(spark, sf_dir):
    register_sql_functions(spark)
    D.comments(spark, sf_dir).createOrReplaceTempView("chatterlens_comments")
    return spark.sql("""SELECT id, clean_text(body) AS cleaned_body, keyword_match(body, 'good  LOVE') AS is_match,
        epoch_to_iso(created_utc) AS iso FROM chatterlens_comments""")


@query("slang_lookup", f"""{_WITH}, words AS (SELECT lower(unnest({D.duck_words('body')})) AS word FROM comments)
    SELECT word, map_extract_value({D.duck_map(SLANG)}, word) AS expansion, count(*) AS n FROM words GROUP BY ALL""")
def _slang_lookup(spark, sf_dir):
    """Every word with its expansion, if any: the dictionary as a table, joined after counting the words."""
    slang = spark.createDataFrame(list(SLANG.items()), "word string, expansion string")
    words = D.comments(spark, sf_dir).select(F.explode(X.split_words(F.lower("body"))).alias("word"))
    return sized_join(words.groupBy("word").agg(F.count("*").alias("n")), slang, ["word"], "left")
