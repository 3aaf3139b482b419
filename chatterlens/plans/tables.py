"""The comment, request and session tables that the queries derive from the test tables.

The test texts hold no mentions, links, slang or removed markers, so ``comments``
works them in by document number. The expressions run alike in Spark and DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterlens.functions.text import clean_text
from chatterlens.functions.wordlists import EMOJI, SLANG
from chatterlens.sources.files import spread

COMMENT_COLUMNS = {
    "id": "CAST(doc_id AS STRING)",
    "author": "concat('user', CAST(doc_id % 150 AS STRING))",
    "created_utc": "1554076800 + (doc_id - doc_id % 3) * 30",
    "body": """CASE doc_id % 16
        WHEN 1 THEN '[deleted]'
        WHEN 2 THEN '  [Removed] '
        WHEN 3 THEN 'ok'
        WHEN 4 THEN concat(text, ' lol btw this app is g.o.a.t')
        WHEN 10 THEN concat({every_key}, ' ', text)
        WHEN 5 THEN concat(text, ' see https://example.com/a?b=1 or www.test.org now')
        WHEN 6 THEN concat('/u/alice r/python you/me ', text)
        WHEN 7 THEN 'I cannot wait, gonna LOVE it!'
        WHEN 8 THEN concat('good great love ', text)
        WHEN 9 THEN concat('bad terrible hate ', text)
        ELSE text END""",
    "score": "(doc_id * 37) % 201 - 100",
    "subreddit": "source",
    "controversiality": "CASE WHEN doc_id % 11 = 0 THEN 1 ELSE 0 END",
    "label": """CASE WHEN doc_id % 13 = 0 THEN 'unknown' WHEN doc_id % 7 < 3 THEN 'positive'
        WHEN doc_id % 7 < 5 THEN 'neutral' ELSE 'negative' END""",
}
# Every slang key once, so that a missing entry shows.
COMMENT_COLUMNS["body"] = COMMENT_COLUMNS["body"].replace("{every_key}", "'" + " ".join(SLANG) + "'")
# Every emoji of the dictionary once in some texts, so that a missing entry shows.
EMOJI_BODY = """concat(CASE WHEN doc_id % 50 = 7 THEN '{every_emoji}' ELSE '' END, CASE doc_id % 5 WHEN 0 THEN 'so good 😀' WHEN 1 THEN '❤️ this ❤'
        WHEN 2 THEN 'no👎👎way 😡' WHEN 3 THEN '🦖 👍🏽x 😂😂' WHEN 4 THEN '{joined}' ELSE 'plain' END, ' ', text)"""
# Joined sequences and the one name of each.
JOINED_EMOJI = {
    "\U0001f468\u200d\U0001f469\u200d\U0001f467": "man_woman_girl",
    "\U0001f469\U0001f3fd\u200d\U0001f4bb": "woman_medium_skin_tone_personal_computer",
    "\u2764\ufe0f\u200d\U0001f525": "red_heart_fire",
    "\U0001f1e9\U0001f1ea": "flag_de",
    "5\ufe0f\u20e3": "keycap_5",
    "\U0001f3f4\U000e0067\U000e0062\U000e0065\U000e006e\U000e0067\U000e007f": "flag_gbeng",
}
EMOJI_BODY = EMOJI_BODY.replace("{joined}", "x".join(JOINED_EMOJI) + " 5 " + " ".join(JOINED_EMOJI))
EMOJI_BODY = EMOJI_BODY.replace("{every_emoji}", " ".join(EMOJI) + " ")

REQUEST_ROWS = [
    ("u1", "the", "worthless", 0),
    ("u2", "good love", "bad hate", 0),
    ("u3", "src7", "la", 40),
    ("u1", "of", "laughing loud", 230),
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [f"{expression} AS {name}" for name, expression in COMMENT_COLUMNS.items()]
    return read_table(spark, sf_dir, "documents").selectExpr(*columns)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comments(spark, sf_dir).withColumn("cleaned_body", clean_text(F.col("body")))


def emoji_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").selectExpr(
        "CAST(doc_id AS STRING) AS id", f"{EMOJI_BODY} AS body"
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame(
        REQUEST_ROWS, "user_id string, keyword1 string, keyword2 string, req_seq bigint"
    )


SESSION_COLUMNS = [
    "event_id AS seq",
    "concat('u', CAST(user_id AS STRING)) AS user_id",
    "CAST(floor(epoch_s) AS BIGINT) AS event_utc",
    "CASE event_type WHEN 'signup' THEN 'start' ELSE 'stop' END AS action",
    "CASE event_id % 4 WHEN 0 THEN 'the' WHEN 1 THEN 'worthless' WHEN 2 THEN 'good love' ELSE 'src7' END AS keyword1",
    "CASE event_id % 3 WHEN 0 THEN 'of' WHEN 1 THEN 'hate' ELSE 'la' END AS keyword2",
]


def session_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events").filter("event_type IN ('signup', 'error')")
    epoch = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1_000_000)
    return events.withColumn("epoch_s", epoch).selectExpr(*SESSION_COLUMNS)


# ---- the same tables for DuckDB ------------------------------------------------------

_COLUMNS_SQL = ",\n  ".join(f"{e} AS {n}" for n, e in COMMENT_COLUMNS.items())
COMMENTS_CTE = f"comments AS (SELECT {_COLUMNS_SQL}\n FROM documents)"
EMOJI_CTE = f"emoji_comments AS (SELECT CAST(doc_id AS STRING) AS id, {EMOJI_BODY} AS body FROM documents)"
_ROWS_SQL = ", ".join(
    f"('{u}', '{a}', '{b}', CAST({s} AS BIGINT))" for u, a, b, s in REQUEST_ROWS
)
REQUESTS_CTE = f"requests AS (SELECT * FROM (VALUES {_ROWS_SQL}) t(user_id, keyword1, keyword2, req_seq))"
SESSION_CTE = f"""session_log AS (SELECT {", ".join(SESSION_COLUMNS)}
 FROM (SELECT *, epoch(ts) AS epoch_s FROM events) t WHERE event_type IN ('signup', 'error'))"""

DUCK_SPACE = "E' \\t\\n\\x0B\\f\\r'"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def duck_map(entries: dict) -> str:
    keys = ", ".join(quoted(k) for k in entries)
    values = ", ".join(quoted(v) if isinstance(v, str) else repr(v) for v in entries.values())
    return f"MAP([{keys}], [{values}])"


def duck_strip(text: str) -> str:
    return f"regexp_replace({text}, '^\\s+|\\s+$', '', 'g')"


def duck_words(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '\\s+'), lambda w: w <> '')"


def duck_slang(text: str) -> str:
    looked_up = f"lambda w: coalesce(map_extract_value({duck_map(SLANG)}, lower(w)), w)"
    return f"array_to_string(list_transform({duck_words(text)}, {looked_up}), ' ')"


def duck_remove(text: str, pattern: str) -> str:
    return f"regexp_replace({text}, '{pattern}', '', 'g')"


DUCK_USER, DUCK_FORUM = "/?u/[\\p{L}\\p{N}_]+", "/?r/[\\p{L}\\p{N}_]+"
DUCK_URL, DUCK_NOT_ALNUM = "http\\S+|www.\\S+", "[^a-zA-Z0-9\\s]"


def duck_collapse(text: str) -> str:
    return f"trim(regexp_replace({text}, '\\s+', ' ', 'g'))"


def duck_tokenize(text: str) -> str:
    for whole, parted in [
        ("cannot", "can not"), ("gimme", "gim me"), ("gonna", "gon na"),
        ("gotta", "got ta"), ("lemme", "lem me"), ("wanna", "wan na"),
    ]:
        text = f"regexp_replace({text}, '\\b{whole}\\b', '{parted}', 'g')"
    return text


def duck_clean(text: str) -> str:
    step = duck_slang(f"lower({text})")
    for pattern in (DUCK_USER, DUCK_FORUM, DUCK_URL, DUCK_NOT_ALNUM):
        step = duck_remove(step, pattern)
    return duck_tokenize(duck_collapse(step))


CLEANED_CTE = f"""{COMMENTS_CTE},
cleaned AS MATERIALIZED (SELECT *, {duck_clean('body')} AS cleaned_body FROM comments)"""
VALID_SQL = (
    f"lower({duck_strip('body')}) NOT IN ('[deleted]', '[removed]', '') AND length({duck_strip('body')}) >= 10"
)
