"""Label codings, score clean-up and time formats."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatterlens.schemas import LABEL_CLASS, LABEL_SIGN, NO_MATCH, UNKNOWN_LABEL

# Output time formats.
ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss'Z'"
DISPLAY = "MM/dd/yyyy, HH:mm:ss"


def _choose(key: Column, pairs: Mapping) -> Column:
    """The value for ``key`` or NULL. The key is written once, however costly it is."""
    entries = F.create_map(*[F.lit(part) for pair in pairs.items() for part in pair])
    return F.try_element_at(entries, key)


def encode_label(label: Column) -> Column:
    """negative/neutral/positive to 0/1/2, anything else to NULL."""
    return _choose(label, LABEL_CLASS)


def label_sign(label: Column) -> Column:
    """negative/neutral/positive to -1/0/1, anything else to NULL."""
    return _choose(label, LABEL_SIGN)


def decode_label(label_class: Column) -> Column:
    return F.coalesce(_choose(label_class, {v: k for k, v in LABEL_CLASS.items()}), F.lit(UNKNOWN_LABEL))


def epoch_to_iso(epoch_seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(epoch_seconds), ISO_UTC)


def epoch_to_millis(epoch_seconds: Column) -> Column:
    return (epoch_seconds * 1000).cast("bigint")


def display_time(iso: Column) -> Column:
    return F.date_format(F.try_to_timestamp(iso, F.lit(ISO_UTC)), DISPLAY)


def request_time_string() -> Column:
    return F.date_format(F.current_timestamp(), ISO_UTC)


def to_numeric(text: Column) -> Column:
    return text.try_cast("double")


def sanitize_score(value: Column) -> Column:
    """A number from text or number; the no-match sentinel becomes NULL."""
    return F.nullif(value.try_cast("double"), F.lit(NO_MATCH))
