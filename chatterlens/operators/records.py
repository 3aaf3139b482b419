"""Output projections between the stages, with the defaults of missing fields."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterlens import schemas as S
from chatterlens.functions.text import clean_text, original_length
from chatterlens.functions.wordlists import EMOJI, SLANG
from chatterlens.operators import validate as V

# What a missing field reads as.
DEFAULTS = {"id": "", "created_utc": 0, "subreddit": "", "score": 0, "cleaned_body": "", "original_length": 0}


def with_default(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(DEFAULTS[name])).alias(name)


def cleaned_fields(
    slang: Mapping[str, str] = SLANG, emoji: Mapping[str, str] = EMOJI
) -> list[Column]:
    body = F.coalesce(F.col("body"), F.lit(""))
    return [
        with_default("id"),
        with_default("created_utc"),
        with_default("subreddit"),
        with_default("score"),
        body.alias("body"),
        clean_text(body, slang, emoji).alias("cleaned_body"),
        original_length(body).alias("original_length"),
    ]


def cleaned_record(
    comments: DataFrame, slang: Mapping[str, str] = SLANG, emoji: Mapping[str, str] = EMOJI
) -> DataFrame:
    """Raw comment to cleaned comment; the original body is kept beside the clean one."""
    return comments.select(*cleaned_fields(slang, emoji))


def cleaned_errors(lines: DataFrame) -> DataFrame:
    """The error records of the cleaning stage, for lines that are no JSON objects."""
    bad = F.json_object_keys("value").isNull()
    return lines.filter(bad).select(F.lit("no JSON object").alias("error"), F.lit("").alias("cleaned_body"))


def labeled_fields(label: Column) -> list[Column]:
    """The fields of a labelled comment; an empty text has an unknown label."""
    text = F.coalesce(F.col("cleaned_body"), F.lit(""))
    known = F.when(text == "", F.lit(S.UNKNOWN_LABEL)).otherwise(
        F.coalesce(label, F.lit(S.UNKNOWN_LABEL))
    )
    return [known.alias("label") if n == "label" else with_default(n) for n in S.LABELED_COMMENT.fieldNames()]


def labeled_record(cleaned: DataFrame, label: Column) -> DataFrame:
    """Cleaned comment to labelled comment."""
    return cleaned.select(*labeled_fields(label))


def error_fields() -> list[Column]:
    """What the labelled stream carries for a value that is no JSON object."""
    return [F.lit("no JSON object").alias("error"), F.lit("error").alias("label"), F.lit("").alias("cleaned_body")]


def labeled_errors(lines: DataFrame) -> DataFrame:
    return lines.filter(V.object_keys(F.col("value")).isNull()).select(*error_fields())


def dashboard_record(responses: DataFrame) -> DataFrame:
    return responses.select(
        "keyword1", "value1", "total1", "keyword2", "value2", "total2", "timestamp"
    )


def drop_unlabeled(df: DataFrame, label: str = "label") -> DataFrame:
    return df.filter(F.col(label).isin(*S.LABELS))


def defaults_and_fillna(df: DataFrame) -> DataFrame:
    """Missing scores and flags count as 0, a missing subreddit as ``unknown``."""
    return df.na.fill({"score": 0, "controversiality": 0, "subreddit": S.UNKNOWN_LABEL})


def json_values(df: DataFrame, event_time: str | None = None) -> DataFrame:
    """Rows as JSON text in ``value``, with their event time in ``timestamp`` when given."""
    stamp = [F.timestamp_seconds(event_time).alias("timestamp")] if event_time else []
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"), *stamp)
