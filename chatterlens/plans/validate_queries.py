"""Validation, record projections and run metrics."""

from pyspark.sql import functions as F

from chatterlens import schemas as S
from chatterlens.functions.text import original_length
from chatterlens.operators import analytics as A
from chatterlens.operators import records as R
from chatterlens.operators import validate as V
from chatterlens.plans import tables as D
from chatterlens.plans.registry import query

_WITH = f"WITH {D.COMMENTS_CTE}"
_FIELDS = ", ".join(S.REQUIRED_FIELDS)
_STRIPPED = D.duck_strip("body")
MIN_UTC, MAX_UTC = 1554077400, 1554100000

# Raw lines of whole comments, texts included, with every kind of defect worked in by document number.
# The expressions run alike in both engines, so both read the same bytes.
def _text_json(column: str) -> str:
    """The column as a JSON string, or null."""
    for code, mark in ((92, 92), (34, 34), (10, 110), (13, 114), (9, 116)):
        column = f"replace({column}, chr({code}), concat(chr(92), chr({mark})))"
    return f"coalesce(concat('\"', {column}, '\"'), 'null')"


def _line_json(*left_out: str, first: str = "") -> str:
    fields = {
        "id": _text_json("id"), "author": _text_json("author"), "created_utc": "CAST(created_utc AS STRING)", "body": _text_json("body"),
        "score": "CAST(score AS STRING)", "subreddit": _text_json("subreddit"),
        "controversiality": "CAST(controversiality AS STRING)", "gilded": "'{\"n\": [3, null, \"x, y\"]}'",
    }
    parts = ", ', ', ".join(f"'\"{name}\": ', {value}" for name, value in fields.items() if name not in left_out)
    return f"concat('{{{first}', {parts}, '}}')"


_LINE = f"""CASE doc_id % 17
    WHEN 0 THEN concat('broken ', id)
    WHEN 1 THEN '[1, 2]'
    WHEN 2 THEN {_line_json("body")}
    WHEN 3 THEN {_line_json("body", first='"body": null, ')}
    WHEN 4 THEN {_line_json("created_utc", first='"created_utc": "soon", ')}
    WHEN 5 THEN concat({_line_json()}, ' trailing')
    WHEN 6 THEN concat({_line_json()}, {_line_json("body")})
    WHEN 7 THEN concat('{{''id'': ', id, '}}')
    WHEN 8 THEN substring({_line_json()}, 1, 150)
    WHEN 9 THEN {_line_json(first='"author": "an earlier one", "score": 1000, ')}
    WHEN 10 THEN concat('  ', {_line_json()}, ' ')
    ELSE {_line_json()} END"""
_LINES_CTE = f"{D.COMMENTS_CTE}, lines AS (SELECT doc_id, {_LINE} AS value FROM (SELECT CAST(id AS BIGINT) AS doc_id, * FROM comments))"


def raw_lines(spark, sf_dir):
    return D.comments(spark, sf_dir).selectExpr("CAST(id AS BIGINT) AS doc_id", "*").selectExpr("doc_id", f"{_LINE} AS value")


# DuckDB reads the first value of a repeated key; the last one counts.
_REPEATED = "doc_id % 17 = 9"
_JSON = "CASE WHEN json_valid(value) THEN value END"
_OBJECT = f"CASE WHEN json_type({_JSON}) = 'OBJECT' THEN {_JSON} END"
_NAMES = ", ".join(f"'{f}'" for f in S.REQUIRED_FIELDS)
_PARSED = f"""parsed AS (SELECT doc_id, value, json_valid(value) AS is_json,
    coalesce(list_has_all(json_keys({_OBJECT}), [{_NAMES}]), false) AS has_fields,
    json_extract_string({_OBJECT}, '$.id') AS id, 
    CASE WHEN {_REPEATED} THEN (SELECT author FROM comments WHERE comments.id = CAST(doc_id AS STRING))
      ELSE json_extract_string({_OBJECT}, '$.author') END AS author,
    TRY_CAST(json_extract_string({_OBJECT}, '$.created_utc') AS BIGINT) AS created_utc,
    json_extract_string({_OBJECT}, '$.body') AS body,
    CASE WHEN {_REPEATED} THEN (SELECT score FROM comments WHERE comments.id = CAST(doc_id AS STRING))
      ELSE TRY_CAST(json_extract_string({_OBJECT}, '$.score') AS BIGINT) END AS score,
    json_extract_string({_OBJECT}, '$.subreddit') AS subreddit,
    TRY_CAST(json_extract_string({_OBJECT}, '$.controversiality') AS INTEGER) AS controversiality
    FROM lines)"""


@query("parse_json_lines", f"WITH {_LINES_CTE}, {_PARSED} SELECT * FROM parsed")
def _parse(spark, sf_dir):
    return V.parse_json_lines(raw_lines(spark, sf_dir))


@query("has_required_fields", f"WITH {_LINES_CTE}, {_PARSED} SELECT doc_id FROM parsed WHERE has_fields")
def _has_fields(spark, sf_dir):
    return raw_lines(spark, sf_dir).filter(V.has_required_fields(F.col("value"))).select("doc_id")


@query("keep_fields", f"{_WITH} SELECT {_FIELDS} FROM comments")
def _keep_fields(spark, sf_dir):
    return V.keep_fields(D.comments(spark, sf_dir))


@query("time_range_filter", f"{_WITH} SELECT id FROM comments WHERE created_utc BETWEEN {MIN_UTC} AND {MAX_UTC}")
def _time_range(spark, sf_dir):
    return V.time_range_filter(D.comments(spark, sf_dir), MIN_UTC, MAX_UTC).select("id")


# Input order here runs against time for a while, so that a plain filter would keep more.
_DISORDER = "CAST(id AS BIGINT) + CASE WHEN score > 0 THEN 300 ELSE 0 END"


@query("stop_after_max_time", f"""{_WITH}, ordered AS (
      SELECT id, created_utc, ({_DISORDER}) * 100000 + CAST(id AS BIGINT) AS line_no FROM comments)
    SELECT id, line_no FROM ordered
    WHERE line_no < coalesce((SELECT min(line_no) FROM ordered WHERE created_utc > {MAX_UTC}), 9223372036854775807)""")
def _stop_after(spark, sf_dir):
    ordered = D.comments(spark, sf_dir).selectExpr(
        "id", "created_utc", f"({_DISORDER}) * 100000 + CAST(id AS BIGINT) AS line_no"
    )
    return V.stop_after_max_time(ordered, MAX_UTC, "line_no").select("id", "line_no")


@query("drop_deleted", f"{_WITH} SELECT id FROM comments WHERE lower({_STRIPPED}) NOT IN ('[deleted]', '[removed]')")
def _drop_deleted(spark, sf_dir):
    return V.drop_deleted(D.comments(spark, sf_dir)).select("id")


@query("min_body_length", f"{_WITH} SELECT id FROM comments WHERE length({_STRIPPED}) >= 10")
def _min_body(spark, sf_dir):
    return V.min_body_length(D.comments(spark, sf_dir), S.STREAM_MIN_BODY).select("id")


_RULES = f"""CASE WHEN NOT is_json THEN 'invalid_json' WHEN NOT has_fields THEN 'missing_field'
    WHEN created_utc IS NULL THEN 'bad_time' WHEN created_utc > {MAX_UTC} THEN 'after_max'
    WHEN created_utc < 0 THEN 'before_min' WHEN body IS NULL THEN 'bad_body'
    WHEN lower({_STRIPPED}) IN ('[deleted]', '[removed]') THEN 'deleted'
    WHEN length({_STRIPPED}) < 10 THEN 'too_short' END"""


@query("validate_raw_lines", f"""WITH {_LINES_CTE}, {_PARSED}
    SELECT doc_id, {_RULES} AS reject_reason FROM parsed""")
def _validate_raw(spark, sf_dir):
    parsed = V.parse_json_lines(raw_lines(spark, sf_dir))
    checked = V.validate_comment(parsed, min_utc=0, max_utc=MAX_UTC, from_json_lines=True)
    return checked.select("doc_id", "reject_reason")


@query("validate_comment", f"""{_WITH}, checked AS (SELECT id, CASE WHEN created_utc > {MAX_UTC} THEN 'after_max'
      WHEN created_utc < {MIN_UTC} THEN 'before_min'
      WHEN lower({_STRIPPED}) IN ('[deleted]', '[removed]') THEN 'deleted'
      WHEN length({_STRIPPED}) < 10 THEN 'too_short' END AS reject_reason FROM comments)
    SELECT id, reject_reason, reject_reason IS NULL AS is_valid,
      coalesce(reject_reason = 'after_max', false) AS should_stop FROM checked""")
def _validate(spark, sf_dir):
    checked = V.validate_comment(D.comments(spark, sf_dir), min_utc=MIN_UTC, max_utc=MAX_UTC)
    return checked.select("id", "reject_reason", "is_valid", "should_stop")


_REQUEST_LINE = """CASE WHEN event_id % 7 = 0 THEN 'x' WHEN event_id % 5 = 0
    THEN concat('{"user_id":"u', user_id, '","keyword1":"the"}')
    ELSE concat('{"user_id":"u', user_id, '","keyword1":"the","keyword2":"', event_type, '","request_time":"t"}') END"""


def _request_lines(spark, sf_dir):
    return D.read_table(spark, sf_dir, "events").selectExpr("event_id", f"{_REQUEST_LINE} AS value")


_REQUESTS_SQL = f"""WITH tagged AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'invalid_request'
      WHEN event_id % 5 = 0 THEN 'invalid_request' ELSE 'request' END AS type,
      CASE WHEN event_id % 7 > 0 THEN concat('u', user_id) END AS user_id,
      CASE WHEN event_id % 7 > 0 THEN 'the' END AS keyword1,
      CASE WHEN event_id % 7 > 0 AND event_id % 5 > 0 THEN event_type END AS keyword2 FROM events)"""


@query("valid_keyword_request", f"{_REQUESTS_SQL} SELECT * FROM tagged")
def _valid_request(spark, sf_dir):
    return V.valid_keyword_request(_request_lines(spark, sf_dir)).drop("value", "request_time")


@query("route_by_type", f"{_REQUESTS_SQL} SELECT event_id, user_id, keyword1, keyword2 FROM tagged WHERE type = 'request'")
def _route_by_type(spark, sf_dir):
    typed = V.valid_keyword_request(_request_lines(spark, sf_dir)).drop("value", "request_time")
    return V.route_by_type(typed, "request")


_SOME_GONE = "CASE WHEN CAST(id AS BIGINT) % 6 = 0 THEN NULL ELSE label END"


@query("valid_labeled_comment", f"""{_WITH} SELECT id, created_utc, subreddit, score, body AS cleaned_body,
    {_SOME_GONE} AS label, CASE WHEN {_SOME_GONE} IS NULL THEN 'invalid_comment' ELSE 'comment' END AS type
    FROM comments""")
def _valid_comment(spark, sf_dir):
    """Labelled comments as JSON; where the label is gone, its key is absent too."""
    record = D.comments(spark, sf_dir).selectExpr(
        "id", "created_utc", "subreddit", "score", "body AS cleaned_body",
        f"{_SOME_GONE} AS label", "length(body) AS original_length",
    )
    lines = record.select(F.to_json(F.struct(*record.columns)).alias("value"))
    return V.valid_labeled_comment(lines).drop("value")


_CALL_COLUMNS = [
    "event_id",
    "CASE WHEN event_id % 3 = 0 THEN 'stop' ELSE 'start' END AS action",
    "CASE WHEN event_id % 10 = 0 THEN 'GET' ELSE 'POST' END AS method",
    """CASE event_id % 8 WHEN 0 THEN '' WHEN 1 THEN '[]' WHEN 2 THEN 'oops'
      WHEN 3 THEN '{"user_id":"a"}' WHEN 4 THEN '{"user_id":"a","keyword1":"b"}'
      ELSE '{"user_id":"a","keyword1":"b","keyword2":null}' END AS payload""",
]
_CALLS = ", ".join(_CALL_COLUMNS)


@query("valid_session_call", f"""SELECT *, CASE WHEN method <> 'POST' THEN 405
      WHEN event_id % 8 IN (0, 2) THEN 400 WHEN event_id % 8 = 1 THEN 500
      WHEN event_id % 8 IN (3, 4) AND action = 'start' THEN 400 ELSE 200 END AS status
    FROM (SELECT {_CALLS} FROM events)""")
def _valid_call(spark, sf_dir):
    calls = D.read_table(spark, sf_dir, "events").selectExpr(*_CALL_COLUMNS)
    return V.valid_session_call(calls)


@query("cleaned_record", f"""WITH {D.CLEANED_CTE} SELECT id, created_utc, subreddit, score, body, cleaned_body,
    CAST(length(body) AS INTEGER) AS original_length FROM cleaned""")
def _cleaned_record(spark, sf_dir):
    return R.cleaned_record(D.comments(spark, sf_dir))


@query("labeled_record", f"""WITH {D.CLEANED_CTE} SELECT id, created_utc, subreddit, score, cleaned_body,
    CASE WHEN cleaned_body = '' THEN 'unknown' ELSE label END AS label,
    CAST(length(body) AS INTEGER) AS original_length FROM cleaned""")
def _labeled_record(spark, sf_dir):
    length = original_length(F.col("body")).alias("original_length")
    return R.labeled_record(D.cleaned(spark, sf_dir).select("*", length), F.col("label"))


@query("drop_unlabeled", f"{_WITH} SELECT id, label FROM comments WHERE label IN ('negative', 'neutral', 'positive')")
def _drop_unlabeled(spark, sf_dir):
    return R.drop_unlabeled(D.comments(spark, sf_dir)).select("id", "label")


@query("defaults_and_fillna", f"""{_WITH} SELECT id, coalesce(nullif(score, 11), 0) AS score,
    coalesce(nullif(controversiality, 1), 0) AS controversiality,
    coalesce(nullif(subreddit, 'src3'), 'unknown') AS subreddit FROM comments""")
def _defaults(spark, sf_dir):
    holes = D.comments(spark, sf_dir).selectExpr(
        "id", "nullif(score, 11) AS score", "nullif(controversiality, 1) AS controversiality",
        "nullif(subreddit, 'src3') AS subreddit",
    )
    return R.defaults_and_fillna(holes)


@query("ingest_metrics", f"""WITH {_LINES_CTE}, {_PARSED},
    stop_at AS (SELECT min(doc_id) AS n FROM parsed WHERE has_fields AND created_utc > {MAX_UTC}),
    checked AS (SELECT *, {_RULES} AS reason FROM parsed
                WHERE doc_id <= coalesce((SELECT n FROM stop_at), 9223372036854775807))
    SELECT count(*) FILTER (WHERE is_json) AS total_processed,
      count(*) FILTER (WHERE reason = 'invalid_json') AS invalid_json,
      count(*) FILTER (WHERE reason NOT IN ('invalid_json', 'after_max')) AS filtered_out,
      count(*) FILTER (WHERE reason IS NULL) AS messages_sent,
      round(count(*) FILTER (WHERE reason IS NULL) * 100.0 / count(*) FILTER (WHERE is_json), 6) AS success_rate,
      coalesce(max(created_utc) FILTER (WHERE reason = 'after_max'), 0) AS timestamp_stopped FROM checked""")
def _metrics(spark, sf_dir):
    parsed = V.parse_json_lines(raw_lines(spark, sf_dir))
    metrics = A.ingest_metrics(parsed, "doc_id", min_utc=0, max_utc=MAX_UTC)
    return metrics.withColumn("success_rate", F.round("success_rate", 6))


_STREAM_RULES = _RULES.replace(f"WHEN created_utc > {MAX_UTC} THEN 'after_max'", "").replace("created_utc < 0", f"created_utc < {S.STREAM_MIN_UTC}")
INGEST_SQL = f"""WITH {_LINES_CTE}, {_PARSED}, checked AS (SELECT *, {_STREAM_RULES} AS reason FROM parsed)
    SELECT count(*) FILTER (WHERE is_json) AS total_processed, count(*) FILTER (WHERE reason = 'invalid_json') AS invalid_json,
      count(*) FILTER (WHERE reason <> 'invalid_json') AS filtered_out, count(*) FILTER (WHERE reason IS NULL) AS messages_sent,
      count(*) FILTER (WHERE reason IS NULL) AS written FROM checked"""


@query("kept_vs_total", f"""WITH {_LINES_CTE}, {_PARSED} SELECT count(*) FILTER (WHERE is_json) AS total,
    count(*) FILTER (WHERE has_fields AND created_utc BETWEEN {MIN_UTC} AND {MAX_UTC}
      AND lower({_STRIPPED}) NOT IN ('[deleted]', '[removed]') AND length({_STRIPPED}) >= 5) AS kept FROM parsed""")
def _kept(spark, sf_dir):
    parsed = V.parse_json_lines(raw_lines(spark, sf_dir))
    return A.kept_vs_total(parsed, min_utc=MIN_UTC, max_utc=MAX_UTC, min_body=S.ARCHIVE_MIN_BODY)
