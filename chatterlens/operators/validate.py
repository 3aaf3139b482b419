"""Reading raw lines, and the keep-or-reject rules for comments, requests and calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatterlens import schemas as S
from chatterlens.functions.text import strip_space

# Reject reasons, in the order the rules are tried.
INVALID_JSON, MISSING_FIELD, BAD_TIME = "invalid_json", "missing_field", "bad_time"
AFTER_MAX, BEFORE_MIN = "after_max", "before_min"
BAD_BODY, DELETED, TOO_SHORT = "bad_body", "deleted", "too_short"


# A line counts as JSON only if it can stand as one item before this mark, so nothing may follow it.
_MARK = "9f2c after"
_STRICT = {"allowSingleQuotes": "false"}


def is_json(value: Column) -> Column:
    """The whole line is one JSON value of any kind (NaN and infinities count as numbers; a repeated key is allowed).

    The reader behind ``from_json`` goes on after some errors inside a value; copying the value whole stops at the first, but
    knows no NaN. A line has to satisfy both.
    """
    items = F.from_json(F.concat(F.lit("["), value, F.lit(f',"{_MARK}"]')), "array<string>", _STRICT)
    alone = (F.size(items) == 2) & (F.get(items, F.lit(1)) == _MARK)
    return F.coalesce(alone & (F.get_json_object(value, "$").isNotNull() | value.rlike("^\\s*null\\s*$|NaN|Infinity")), F.lit(False))


def object_keys(value: Column) -> Column:
    """The keys of a line that is one JSON object, else NULL."""
    return F.when(is_json(value), _keys(value))


def _keys(value: Column) -> Column:
    return F.map_keys(F.from_json(value, "map<string,string>", _STRICT))


def _holds(keys: Column, fields: list[str]) -> Column:
    wanted = F.array(*[F.lit(f) for f in fields])
    return F.coalesce(F.size(F.array_except(wanted, keys)) == 0, F.lit(False))


def has_keys(value: Column, fields: list[str]) -> Column:
    """All keys are in the JSON object, null values included; false for anything but an object."""
    return _holds(object_keys(value), fields)


def has_required_fields(value: Column) -> Column:
    return has_keys(value, S.REQUIRED_FIELDS)


def _whole_number(text: Column) -> Column:
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))


def parse_json_lines(
    lines: DataFrame, schema: T.StructType = S.RAW_COMMENT, value: str = "value"
) -> DataFrame:
    """Add the schema's typed columns and ``is_json`` / ``has_fields`` beside the raw line.

    Values are read as text and cast one by one, so a bad number spoils its own
    column only; of a repeated key the last value counts. Bad lines stay in the frame for the caller to count or divert.
    """
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    parsed = lines.withColumn("_is_json", is_json(F.col(value))).withColumns({
        "_record": F.when(F.col("_is_json"), F.from_json(F.col(value), as_text, _STRICT)),
        "_keys": F.when(F.col("_is_json"), _keys(F.col(value))),
    })
    columns = []
    for field in schema.fields:
        text = F.col("_record")[field.name]
        if isinstance(field.dataType, (T.LongType, T.IntegerType)):
            text = _whole_number(text)
        columns.append(text.try_cast(field.dataType).alias(field.name))
    return parsed.select(
        *lines.columns,
        F.col("_is_json").alias("is_json"),
        _holds(F.col("_keys"), schema.fieldNames()).alias("has_fields"),
        *columns,
    )


def keep_fields(df: DataFrame, fields: list[str] = S.REQUIRED_FIELDS) -> DataFrame:
    return df.select(*fields)


def is_deleted(body: Column) -> Column:
    return F.lower(strip_space(body)).isin(*S.DELETED_MARKERS)


def body_length(body: Column) -> Column:
    return F.length(strip_space(body))


def in_time_range(created_utc: Column, min_utc: int, max_utc: int) -> Column:
    within = created_utc >= min_utc
    return within if max_utc == S.OPEN_BOUND else within & (created_utc <= max_utc)


def time_range_filter(
    df: DataFrame, min_utc: int = S.ARCHIVE_MIN_UTC, max_utc: int = S.ARCHIVE_MAX_UTC
) -> DataFrame:
    return df.filter(in_time_range(F.col("created_utc"), min_utc, max_utc))


def drop_deleted(df: DataFrame) -> DataFrame:
    return df.filter(~is_deleted(F.col("body")))


def min_body_length(df: DataFrame, n: int = S.STREAM_MIN_BODY) -> DataFrame:
    return df.filter(body_length(F.col("body")) >= n)


def stop_after_max_time(df: DataFrame, max_utc: int, order: str) -> DataFrame:
    """Keep the rows before the first one, in input order, that is later than ``max_utc``."""
    if max_utc == S.OPEN_BOUND:
        return df
    past = df.filter(F.col("created_utc") > max_utc)
    if "has_fields" in df.columns:
        past = past.filter("has_fields")
    first_past = past.agg(F.min(order)).scalar()
    return df.filter(first_past.isNull() | (F.col(order) < first_past))


def reject_reason(
    min_utc: int = S.STREAM_MIN_UTC,
    max_utc: int = S.STREAM_MAX_UTC,
    min_body: int = S.STREAM_MIN_BODY,
    from_json_lines: bool = False,
) -> Column:
    """The first rule a comment breaks, NULL for a valid one."""
    created, body = F.col("created_utc"), F.col("body")
    rules = []
    if from_json_lines:
        rules += [(~F.col("is_json"), INVALID_JSON), (~F.col("has_fields"), MISSING_FIELD)]
    rules.append((created.isNull(), BAD_TIME))
    if max_utc != S.OPEN_BOUND:
        rules.append((created > max_utc, AFTER_MAX))
    rules += [
        (created < min_utc, BEFORE_MIN),
        (body.isNull(), BAD_BODY),
        (is_deleted(body), DELETED),
        (body_length(body) < min_body, TOO_SHORT),
    ]
    chain = F.when(rules[0][0], rules[0][1])
    for broken, reason in rules[1:]:
        chain = chain.when(broken, reason)
    return chain


def validate_comment(df: DataFrame, **bounds) -> DataFrame:
    """Add ``reject_reason``, ``is_valid`` and ``should_stop``."""
    tagged = df.withColumn("reject_reason", reject_reason(**bounds))
    return tagged.withColumns(
        {
            "is_valid": F.col("reject_reason").isNull(),
            "should_stop": F.coalesce(F.col("reject_reason") == AFTER_MAX, F.lit(False)),
        }
    )


def valid_comments(df: DataFrame, **bounds) -> DataFrame:
    return df.filter(reject_reason(**bounds).isNull())


def dead_letters(df: DataFrame, **bounds) -> DataFrame:
    """The rejected rows with their reason."""
    return df.withColumn("reject_reason", reject_reason(**bounds)).filter("reject_reason IS NOT NULL")


def typed_records(lines: DataFrame, schema: T.StructType, kind: str) -> DataFrame:
    """Parse JSON lines and tag each as ``kind`` or ``invalid_<kind>`` by its keys."""
    parsed = parse_json_lines(lines, schema)
    tag = F.when(F.col("has_fields"), F.lit(kind)).otherwise(F.lit(f"invalid_{kind}"))
    return parsed.withColumn("type", tag).drop("is_json", "has_fields")


def valid_keyword_request(lines: DataFrame) -> DataFrame:
    return typed_records(lines, S.KEYWORD_REQUEST, "request")


def valid_labeled_comment(lines: DataFrame) -> DataFrame:
    return typed_records(lines, S.LABELED_COMMENT, "comment").drop("original_length")


def route_by_type(df: DataFrame, kind: str) -> DataFrame:
    return df.filter(F.col("type") == kind).drop("type")


def valid_session_call(calls: DataFrame) -> DataFrame:
    """Status of each logged call (``action``, ``method``, ``payload``): 200, 400, 405 or 500.

    A payload that is JSON but no object is the one failure the service does not
    answer itself, hence 500.
    """
    payload = F.when(F.coalesce(F.col("payload"), F.lit("")) == "", F.lit("{}")).otherwise(F.col("payload"))
    complete = F.when(
        F.col("action") == "start", has_keys(payload, ["user_id", "keyword1", "keyword2"])
    ).otherwise(has_keys(payload, ["user_id"]))
    status = (
        F.when(F.col("method") != "POST", 405)
        .when(~is_json(payload), 400)
        .when(object_keys(payload).isNull(), 500)
        .when(~complete, 400)
        .otherwise(200)
    )
    return calls.withColumn("status", status)
