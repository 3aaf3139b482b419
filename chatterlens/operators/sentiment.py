"""Lexicon labels for whole archives, and how they move with the threshold."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterlens import schemas as S
from chatterlens.functions.lexicon import LEXICON, lexicon_compound, threshold_label


def label_batch(
    comments: DataFrame,
    lexicon: Mapping[str, float] = LEXICON,
    threshold: float = S.LABEL_THRESHOLD,
) -> DataFrame:
    """Label every comment that has a body; a missing score or flag reads as 0."""
    score = lexicon_compound(F.col("body"), lexicon)
    filled = comments.filter("body IS NOT NULL AND body <> ''").na.fill(
        {"score": 0, "controversiality": 0}
    )
    return filled.withColumn("label", threshold_label(score, threshold)).select(
        *S.ARCHIVE_LABELED.fieldNames()
    )


def threshold_sweep(
    scored: DataFrame, thresholds: list[float] = S.THRESHOLDS, score: str = "compound"
) -> DataFrame:
    """Counts and shares of the three labels at each threshold, from one pass and one row."""
    value = F.col(score)
    counts = []
    for i, t in enumerate(thresholds):
        counts += [
            F.count_if(value >= t).alias(f"pos{i}"),
            F.count_if(value <= -t).alias(f"neg{i}"),
            F.count_if((value < t) & (value > -t)).alias(f"neu{i}"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(float(t)).alias("threshold"),
                *[F.col(f"{name}{i}").alias(name) for name in ("pos", "neg", "neu")],
            )
            for i, t in enumerate(thresholds)
        ]
    )
    by_threshold = scored.agg(*counts).select(F.inline(rows))
    total = F.col("pos") + F.col("neg") + F.col("neu")
    return by_threshold.withColumns(
        {f"{name}_share": F.try_divide(F.col(name), total) for name in ("pos", "neg", "neu")}
    )
