"""Quality rules per text and per host.

Base rules fail a text with fewer than ``MIN_WORDS`` words or with more than ``MAX_REPEAT`` percent of its
words inside 8-word windows that occur again. Failures are then counted per host (``source``): a host's
rate is shrunk by a beta prior fitted to all hosts by moments, and every document of a host whose
shrunken rate exceeds ``HOST_RATE`` is rejected as well.

Defined results: a null or empty text has no words and fails; a null host is one host of its own, apart from the empty one;
repeated rows each count. Only ``source`` and ``text`` are read, other columns pass through; the names this module
adds replace columns of the same name.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatterlens.llm import textnum
from chatterlens.llm.storage import stored
from chatterlens.operators.joins import sized_join

MIN_WORDS = 20
MAX_REPEAT = 30
WINDOW = 8
HOST_RATE = 0.5
PRIOR_WEIGHT = (1.0, 10_000.0)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_symbol = np.zeros(256, bool)
_symbol[[ord(c) for c in "#*$%&|<>"]] = True


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])


def repeated_words(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per text, the words covered by a window of ``WINDOW`` words that occurs twice or more in it."""
    texts = np.repeat(np.arange(len(counts)), counts)
    folded = textnum.fold(h, WINDOW)
    place = np.flatnonzero(texts[: len(folded)] == texts[WINDOW - 1:]) if len(folded) else np.zeros(0, np.int64)
    keyed = textnum.mix(folded[place] + texts[place].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    place = place[pd.Series(keyed).duplicated(keep=False).to_numpy()]
    edge = np.zeros(len(h) + WINDOW + 1, np.int64)
    edge[place] += 1
    edge[place + WINDOW] -= 1
    return np.bincount(texts[np.cumsum(edge)[: len(h)] > 0], minlength=len(counts))


def measure_texts(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The ``MEASURES`` of each text."""
    starts, ends, first = textnum.word_bounds(data, offsets)
    counts = np.diff(first)
    h = textnum.word_hashes(data, starts, ends)
    chars = _sums((data & 0xC0) != 0x80, offsets) - _sums(textnum.SPACE[data], offsets)
    twice = np.zeros(len(counts), np.int64)
    for i in range(len(counts)):
        lines = [x for x in data[offsets[i]: offsets[i + 1]].tobytes().split(b"\n") if x.strip()]
        twice[i] = len(lines) - len(set(lines))
    return [counts, chars, _sums(_symbol[data], offsets), twice, repeated_words(h, counts)]


@F.arrow_udf(T.StructType([T.StructField(m, T.LongType()) for m in MEASURES]))
def measures(text: pa.Array) -> pa.Array:
    batch = pa.RecordBatch.from_arrays([text], ["text"])
    parts = [measure_texts(data, offsets) for _, _, data, offsets in textnum.text_chunks(batch, "text")]
    columns = [np.concatenate(c).astype(np.int64) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * len(MEASURES)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(MEASURES))


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the ``MEASURES`` and ``base_failed``."""
    found = docs.withColumn("_measures", measures("text")).withColumns({m: F.col("_measures")[m] for m in MEASURES})
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    return found.withColumn("base_failed", failed).drop("_measures")


def host_key() -> Column:
    """The host as a key that joins: a null host is one of its own, apart from the empty one."""
    return F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-"))


def host_rates(judged: DataFrame) -> DataFrame:
    """``(host, n, failed, rate)`` per ``host_key``: failures shrunk towards all hosts.

    With m the overall failure rate and v the variance of the host rates around it (weighted by documents), the
    prior is Beta(m s, (1 - m) s) with s = m (1 - m) / v - 1, kept within ``PRIOR_WEIGHT``.
    """
    hosts = judged.groupBy(host_key().alias("host")).agg(
        F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed")
    )
    whole = hosts.agg(
        (F.sum("failed") / F.sum("n")).alias("m"),
        (F.sum(F.col("failed") * F.col("failed") / F.col("n")) / F.sum("n")).alias("square"),
    )
    spread = F.col("square") - F.col("m") * F.col("m")
    low, high = PRIOR_WEIGHT
    raw = F.when(spread > 1e-12, F.col("m") * (1 - F.col("m")) / spread - 1).otherwise(F.lit(high))
    prior = whole.select("m", F.least(F.greatest(raw, F.lit(low)), F.lit(high)).alias("s"))
    return hosts.join(F.broadcast(prior)).select(  # the prior is one row
        "host", "n", "failed", ((F.col("failed") + F.col("m") * F.col("s")) / (F.col("n") + F.col("s"))).alias("rate")
    )


def judge(docs: DataFrame) -> DataFrame:
    """``docs`` with the ``MEASURES``, ``base_failed``, ``host_rate`` and ``kept``."""
    found = measured(docs).withColumn("_host", host_key())
    # counted from the two columns that matter, so no text is shuffled for it
    rates = host_rates(measured(docs.select("source", "text")).select("source", "base_failed"))
    bad = rates.where(F.col("rate") > HOST_RATE).select(F.col("host").alias("_host"), F.col("rate").alias("host_rate"))
    # a hot host must not gather its texts in one task: broadcast after a count, else salted
    joined = sized_join(found, stored(bad, "hosts"), ["_host"], "left").drop("_host")
    return joined.withColumn("kept", ~F.col("base_failed") & F.col("host_rate").isNull())


def accepted() -> Column:
    return F.col("kept")
