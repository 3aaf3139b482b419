"""Counts, shares, correlations, samples and unions over labelled comments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterlens import schemas as S
from chatterlens.functions.labels import label_sign, to_numeric
from chatterlens.operators import validate as V
from chatterlens.operators.joins import sized_join
from chatterlens.operators.sequence import first_rows
from chatterlens.session import durable


def ingest_counts() -> list[Column]:
    """Run counts over lines tagged by ``validate_comment``; also for ``observe`` on a stream."""
    reason = F.col("reject_reason")
    return [
        F.count_if("is_json").alias("total_processed"),
        F.count_if(reason == V.INVALID_JSON).alias("invalid_json"),
        F.count_if(~reason.isin(V.INVALID_JSON, V.AFTER_MAX)).alias("filtered_out"),
        F.count_if(reason.isNull()).alias("messages_sent"),
        F.coalesce(F.max(F.when(F.col("should_stop"), F.col("created_utc"))), F.lit(0)).alias(
            "timestamp_stopped"
        ),
    ]


def ingest_metrics(parsed: DataFrame, order: str, **bounds) -> DataFrame:
    """One row of run counts over parsed raw lines, up to and with the line that stops the run."""
    tagged = V.validate_comment(parsed, from_json_lines=True, **bounds)
    stop_at = tagged.filter("should_stop").agg(F.min(order)).scalar()
    seen = tagged.filter(stop_at.isNull() | (F.col(order) <= stop_at))
    counted = seen.agg(*ingest_counts())
    rate = F.try_divide(F.col("messages_sent") * 100.0, F.col("total_processed"))
    return counted.withColumn("success_rate", F.coalesce(rate, F.lit(0.0)))


def kept_vs_total(parsed: DataFrame, **bounds) -> DataFrame:
    broken = V.reject_reason(from_json_lines=True, **bounds)
    return parsed.agg(
        F.count_if("is_json").alias("total"), F.count_if(broken.isNull()).alias("kept")
    )


def subreddit_counts(comments: DataFrame, at_least: int = S.FREQUENT_SUBREDDIT) -> DataFrame:
    counted = comments.groupBy("subreddit").agg(F.count("*").alias("comments"))
    return counted.filter(F.col("comments") >= at_least)


def frequent_subreddits(comments: DataFrame, at_least: int = S.FREQUENT_SUBREDDIT) -> DataFrame:
    """The comments of subreddits with enough comments."""
    names = durable(subreddit_counts(comments, at_least).select("subreddit"))
    return sized_join(comments, names, ["subreddit"], "left_semi")


def distinct_subreddits(comments: DataFrame) -> DataFrame:
    return comments.select("subreddit").distinct()


def label_distribution(labeled: DataFrame) -> DataFrame:
    """Support and share of each label; the total is summed over the few label rows."""
    counts = labeled.groupBy("label").agg(F.count("*").alias("support"))
    total = counts.agg(F.sum("support")).scalar()
    return counts.withColumn("share", F.col("support") / total)


def pearson(x: Column, y: Column) -> Column:
    """Pairwise-complete correlation; NULL where either side is constant."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x).cast("double"), F.when(both, y).cast("double")
    return F.try_divide(F.covar_samp(a, b), F.stddev_samp(a) * F.stddev_samp(b))


def _numeric(labeled: DataFrame) -> DataFrame:
    return labeled.withColumns(
        {
            "label_numeric": label_sign(F.col("label")),
            "controversiality": to_numeric(F.col("controversiality").cast("string")),
        }
    )


def label_correlation(labeled: DataFrame) -> DataFrame:
    """The 3x3 matrix of label, score and controversiality, one row per variable."""
    names = ["label_numeric", "score", "controversiality"]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    one_pass = _numeric(labeled).agg(
        *[pearson(F.col(a), F.col(b)).alias(f"{a}|{b}") for a, b in pairs]
    )

    def entry(a: str, b: str) -> Column:
        return F.col(f"`{a}|{b}`" if (a, b) in pairs else f"`{b}|{a}`").alias(b)

    rows = [F.struct(F.lit(a).alias("variable"), *[entry(a, b) for b in names]) for a in names]
    return one_pass.select(F.inline(F.array(*rows)))


def subreddit_correlation(labeled: DataFrame, at_least: int = S.FREQUENT_SUBREDDIT) -> DataFrame:
    """Correlation of the label with score and controversiality in each frequent subreddit.

    Count and correlations come from the same aggregation, so no comment is joined
    back to its subreddit's count.
    """
    usable = _numeric(labeled).filter("subreddit IS NOT NULL AND label_numeric IS NOT NULL")
    label = F.col("label_numeric")
    return (
        usable.groupBy("subreddit")
        .agg(
            F.count("*").alias("_n"),
            pearson(label, F.col("score")).alias("label_vs_score"),
            pearson(label, F.col("controversiality")).alias("label_vs_controversiality"),
        )
        .filter(F.col("_n") >= at_least)
        .drop("_n")
    )


def top_correlated(correlations: DataFrame, k: int = 10) -> DataFrame:
    rank = [F.round("label_vs_score", 6).desc_nulls_last(), F.asc("subreddit")]
    return correlations.orderBy(*rank).limit(k)


def bottom_correlated(correlations: DataFrame, k: int = 10) -> DataFrame:
    rank = [F.round("label_vs_score", 6).asc_nulls_last(), F.asc("subreddit")]
    return correlations.orderBy(*rank).limit(k)


def limit_valid_rows(comments: DataFrame, n: int, order: list, **bounds) -> DataFrame:
    """The first ``n`` valid comments in input order; all of them when ``n <= 0``."""
    return first_rows(V.valid_comments(comments, **bounds), n, order)


def first_n_lines(lines: DataFrame, n: int, order: list) -> DataFrame:
    """The first ``n`` lines, bad ones included."""
    return first_rows(lines, n, order)


def bernoulli_sample(
    df: DataFrame, share: float, key: str = "id", seed: int = 42, at_most: int | None = None
) -> DataFrame:
    """Keep each row with probability ``share``; the choice depends on the key and seed only.

    ``at_most`` bounds the size of the sample: the rows with the smallest draws stay.
    """
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    draw = F.md5(F.concat(text, F.lit(f":{seed}")).cast("binary"))
    # the first eight hexadecimal digits against the share of all their values
    sampled = df if share >= 1 else df.filter(F.substring(draw, 1, 8) < f"{int(share * 2**32):08x}")
    return sampled if at_most is None else sampled.orderBy(draw, key).limit(at_most)


def concat_chunks(chunks: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), chunks)


def union_distinct_values(chunks: list[DataFrame], column: str) -> DataFrame:
    return concat_chunks([c.select(column) for c in chunks]).distinct()
