"""The main functions under SQL names, as temporary SQL functions; no Python runs in them."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import SparkSession

from chatterlens.functions import text as X
from chatterlens.functions.labels import ISO_UTC
from chatterlens.functions.wordlists import EMOJI, SLANG


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _entry(entries: Mapping[str, str], word: str) -> str:
    """The entry for ``word`` or NULL, found in one small bucket."""
    buckets = X.bucketed(entries)
    maps = f"from_json({_quoted(json.dumps(buckets, ensure_ascii=False))}, 'array<map<string,string>>')"
    return f"try_element_at(get({maps}, cast(pmod(crc32(cast({word} AS BINARY)), {len(buckets)}) AS INT)), {word})"


def _words(value: str) -> str:
    return f"filter(split({value}, {_quoted(X.SPACES)}), w -> w <> '')"


def _replace(value: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({value}, {_quoted(pattern)}, {_quoted(by)})"


def _clean_text(slang: Mapping[str, str], emoji: Mapping[str, str]) -> str:
    step = "lower(coalesce(t, ''))"
    if emoji:
        name = f"if(length(p) <= {max(map(len, emoji))}, concat(' ', {_entry(emoji, 'p')}, ' '), NULL)"
        pieces = f"regexp_extract_all({step}, {_quoted(X.emoji_pieces(emoji))}, 0)"
        named = f"array_join(transform({pieces}, p -> coalesce({name}, p)), '')"
        step = f"if(rlike({step}, {_quoted('[' + X.emoji_span(emoji) + ']')}), {named}, {step})"
    if slang:
        step = f"array_join(transform({_words(step)}, w -> coalesce({_entry(slang, 'lower(w)')}, w)), ' ')"
    for pattern in (X.USER_MENTION, X.FORUM_MENTION, X.URL, X.NOT_ALNUM):
        step = _replace(step, pattern)
    return _replace(f"trim({_replace(step, X.SPACES, ' ')})", X.CONTRACTIONS, X.PARTED)


def register_sql_functions(
    spark: SparkSession, slang: Mapping[str, str] = SLANG, emoji: Mapping[str, str] = EMOJI
) -> None:
    """Create ``clean_text``, ``normalize_phrase``, ``keyword_match``, ``positivity_score`` and ``epoch_to_iso``."""
    phrase = f"array_join({_words('lower(t)')}, ' ')"
    # In SQL text a backslash is written twice inside quotes.
    whole_word = f"rlike({phrase}, concat('(?U)\\\\b\\\\Q', k, '\\\\E\\\\b'))"
    bodies = {
        "clean_text(t STRING) RETURNS STRING": _clean_text(slang, emoji),
        "normalize_phrase(t STRING) RETURNS STRING": phrase,
        "keyword_match(t STRING, keyword STRING) RETURNS BOOLEAN":
            f"coalesce(t <> '' AND keyword <> '' AND forall({_words('lower(keyword)')}, k -> {whole_word}), false)",
        "positivity_score(positive BIGINT, neutral BIGINT, total BIGINT) RETURNS DOUBLE":
            "coalesce(try_divide(positive + neutral * 0.5D, CAST(total AS DOUBLE)), -1.0D)",
        "epoch_to_iso(seconds BIGINT) RETURNS STRING":
            f"date_format(timestamp_seconds(seconds), {_quoted(ISO_UTC)})",
    }
    for signature, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
