"""Which comments speak of a keyword, and how positively, per window."""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatterlens import schemas as S
from chatterlens.functions.labels import epoch_to_iso
from chatterlens.functions.matching import keyword_anchor, keyword_pattern, keyword_words, runs, words_found
from chatterlens.operators.joins import sized_join
from chatterlens.operators.sequence import neighbours, whole_part
from chatterlens.session import durable

#: Powers of two.
MIN_BITS, MAX_BITS = 15, 22
COUNTS = ["positive", "negative", "neutral", "other", "total"]


def distinct_keywords(requests: DataFrame) -> DataFrame:
    """Every requested keyword once; empty ones never match and are left out."""
    each = requests.select(F.explode(F.array("keyword1", "keyword2")).alias("keyword"))
    return each.filter("keyword <> ''").distinct()


@dataclass(frozen=True)
class RunFilter:
    """A bitmap of hashed runs: tells inside a row which of its runs may be asked for; never misses one.

    ``bits`` grows with the number of runs up to ``MAX_BITS``, half a megabyte; beyond that more runs pass by
    chance and are dropped by the join that follows.
    """

    bits: int
    words: str

    @classmethod
    def of(cls, wanted: DataFrame, run: str) -> RunFilter:
        asked = wanted.select(F.col(run).alias("_run")).dropna()
        bits = 1 << min(max((16 * asked.count()).bit_length(), MIN_BITS), MAX_BITS)
        places = asked.select(F.explode(F.array(*cls._places(F.col("_run"), bits))).alias("_place"))
        place = F.col("_place") + 1  # buckets count from 1
        packed = places.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap")
        )
        whole = np.zeros(bits // 64, np.int64)
        for row in packed.collect():  # at most bits / 32768 rows
            part = np.frombuffer(row.bitmap, "<i8")[: len(whole)]
            begin = (row.bucket - 1) * part.size
            whole[begin: begin + part.size] = part
        return cls(bits, json.dumps(whole.tolist()))

    @staticmethod
    def _places(run: Column, bits: int) -> tuple[Column, Column]:
        """Two bits per run, from the two halves of its hash."""
        hashed = F.xxhash64(run)
        return tuple(part.bitwiseAND(F.lit(bits - 1)) for part in (hashed, F.shiftrightunsigned(hashed, 32)))

    def passing(self, runs_of_row: Column) -> Column:
        words = F.from_json(F.lit(self.words), "array<bigint>")

        def is_set(place: Column) -> Column:
            return F.getbit(F.get(words, F.shiftright(place, 6).cast("int")), place.bitwiseAND(F.lit(63)).cast("int")) == 1

        def asked(run: Column) -> Column:
            first, second = self._places(run, self.bits)
            return is_set(first) & is_set(second)

        return F.filter(runs_of_row, asked)


def keyword_matches(
    comments: DataFrame, keywords: DataFrame, body: str = "cleaned_body", subreddit: str = "subreddit",
    kept: list[str] | None = None,
) -> DataFrame:
    """Each (comment, keyword) pair that matches in the body or in the subreddit, once.

    Inverted: a keyword joins only comments that hold its longest run, by an equi-join on the comments' distinct runs, and is
    then tested in full. One anchor per keyword means no pair can come up twice, so the comments are never shuffled or
    regrouped. A bitmap of the keywords' runs is tested inside the row, whatever their number, so only runs
    that some keyword holds become rows, and no row has to move to find that out. ``kept`` names the columns of the
    result (default: all of the comment).
    """
    words = keyword_words(F.col("keyword"))
    wanted = durable(keywords.select(
        "keyword",
        keyword_anchor(F.col("keyword")).alias("_run"),
        words.alias("_words"),
        keyword_pattern(F.col("keyword")).alias("_pattern"),
        F.array_distinct(F.flatten(F.transform(words, runs))).alias("_runs"),
    ))
    asked = RunFilter.of(wanted.select(F.explode("_runs").alias("_run")), "_run")
    text = F.coalesce(F.col(body), F.lit(""))
    forum = F.coalesce(F.col(subreddit), F.lit(""))
    # what no keyword holds is gone before anything is compared
    prepared = comments.withColumns({"_body_runs": asked.passing(runs(text)), "_forum_runs": asked.passing(runs(forum))})
    every_run = F.array_append(F.array_union("_body_runs", "_forum_runs"), F.lit(""))
    by_run = prepared.withColumn("_run", F.explode(every_run))
    pairs = sized_join(by_run, wanted.drop("_runs"), ["_run"])
    needed = F.col("_words"), F.col("_pattern")
    found = words_found(text, F.col("_body_runs"), *needed) | words_found(
        forum, F.col("_forum_runs"), *needed
    )
    return pairs.filter(found).select(*(kept or comments.columns), "keyword")


def window_matches(comments: DataFrame, keywords: DataFrame, windows: DataFrame, key: list[str], **columns) -> DataFrame:
    """The matches of the comments that lie in a window: ``key``, ``label``, ``keyword`` and the columns of ``windows``.

    Texts are read where they lie; only matches, without their text, meet the numbers.
    """
    matches = keyword_matches(comments, keywords, kept=[*key, "label"], **columns)
    return matches.join(windows, key)


def by_slot(matches: DataFrame, requests: DataFrame) -> DataFrame:
    """Matches per (user, slot); keywords shared by users are matched once before."""
    slots = requests.select(
        "user_id",
        F.explode(
            F.array(
                F.struct(F.lit(1).alias("slot"), F.col("keyword1").alias("keyword")),
                F.struct(F.lit(2).alias("slot"), F.col("keyword2").alias("keyword")),
            )
        ).alias("_slot"),
    ).select("user_id", "_slot.*")
    return sized_join(matches, slots, ["keyword"])


def requests_x_comments(comments: DataFrame, requests: DataFrame, kept: list[str] | None = None) -> DataFrame:
    """Matches per (comment, user, slot)."""
    return by_slot(keyword_matches(comments, distinct_keywords(requests), kept=kept), requests)


def label_counts(label: str = "label") -> list[Column]:
    """Counts per label. Labels other than the three count in ``other`` and ``total`` only."""
    known = F.col(label).isin(*S.LABELS)
    return [
        *[F.count_if(F.col(label) == name).alias(name) for name in ("positive", "negative", "neutral")],
        F.count_if(~F.coalesce(known, F.lit(False))).alias("other"),
        F.count("*").alias("total"),
    ]


def keyword_label_counts(matches: DataFrame, keys: list[str]) -> DataFrame:
    return matches.groupBy(*keys).agg(*label_counts())


def positivity_score(positive: Column, neutral: Column, total: Column) -> Column:
    """Mean of positive = 1, neutral = 0.5, all others 0; the sentinel when nothing matched."""
    return F.coalesce(
        F.try_divide(positive + neutral * F.lit(0.5), total.cast("double")), F.lit(S.NO_MATCH)
    )


def scored(counts: DataFrame) -> DataFrame:
    return counts.withColumn(
        "score", positivity_score(F.col("positive"), F.col("neutral"), F.col("total"))
    )


def keyword_time_range(matches: DataFrame, keys: list[str]) -> DataFrame:
    return matches.groupBy(*keys).agg(
        F.min("created_utc").alias("min_timestamp"), F.max("created_utc").alias("max_timestamp")
    )


def window_first_last_time(windows: DataFrame) -> DataFrame:
    """Time of the first and the last comment to arrive, which need not be the extremes."""
    return windows.groupBy("window_no").agg(
        F.min_by("created_utc", "seq").alias("first_utc"),
        F.max_by("created_utc", "seq").alias("last_utc"),
    )


def latest_request_per_user(requests: DataFrame, order: str = "req_seq") -> DataFrame:
    """A new request replaces the user's old one."""
    rest = [c for c in requests.columns if c != "user_id"]
    newest = F.max(F.struct(F.col(order).alias("_at"), F.struct(*rest).alias("_row")))
    return requests.groupBy("user_id").agg(newest.alias("_new")).select("user_id", "_new._row.*")


def requests_by_window(
    requests: DataFrame, windows: DataFrame, n: int, reset_on_request: bool
) -> DataFrame:
    """The request each user has in force at the end of each window.

    ``from_seq`` is the first comment that counts for it. A user's last request
    within a window rules that window from its own position on, and all later
    windows in full until a newer one comes.
    """
    starts_in = whole_part("req_seq", n)
    newest = F.max(F.struct("req_seq", "keyword1", "keyword2"))
    versions = (
        requests.withColumn("_starts", starts_in)
        .groupBy("user_id", "_starts")
        .agg(newest.alias("_new"))
        .select("user_id", "_starts", "_new.*")
    )
    followed = neighbours(versions, ["user_id"], "_starts", {"_next": "_starts"}, step=1)
    last_window = windows.agg(F.max("window_no")).scalar()
    until = F.least(F.col("_next") - 1, last_window)
    ruled = followed.withColumn("_until", until).filter(F.col("_starts") <= F.col("_until"))
    spread = ruled.withColumn("window_no", F.explode(F.sequence("_starts", "_until")))
    window_start = F.col("window_no") * F.lit(n)
    from_seq = F.greatest("req_seq", window_start) if reset_on_request else window_start
    return spread.select("window_no", "user_id", "keyword1", "keyword2", from_seq.alias("from_seq"))


def _counts_from(matches: DataFrame, slots: DataFrame) -> DataFrame:
    """Counts of the matches at or after ``from_seq``, for slots that start inside a window.

    Matches and starting points of one (window, keyword) are read backwards together,
    so that a start finds its counts as a running sum and no match is paired with any
    slot. Users who start at the same comment share a starting point, so a group never
    holds more than two rows per comment of its window.
    """
    key = ["window_no", "keyword", "from_seq"]
    one = [F.col("label").eqNullSafe(name).cast("bigint").alias(name) for name in ("positive", "neutral")]
    events = matches.select(
        "window_no", "keyword", F.col("seq").alias("from_seq"), *one, F.lit(1).cast("bigint").alias("total")
    )
    none = [F.lit(0).cast("bigint").alias(name) for name in ("positive", "neutral", "total")]
    starts = slots.select(*key).distinct().select(*key, *none)
    backwards = (
        W.partitionBy("window_no", "keyword")
        .orderBy(F.col("from_seq").desc(), F.col("total").desc())
        .rowsBetween(W.unboundedPreceding, 0)
    )
    names = ["positive", "neutral", "total"]
    both = events.withColumn("_is_start", F.lit(False)).unionByName(starts.withColumn("_is_start", F.lit(True)))
    summed = both.withColumns({f"_{c}": F.sum(c).over(backwards) for c in names})
    reached = summed.filter("_is_start").select(*key, *[F.col(f"_{c}").alias(c) for c in names])
    return slots.join(reached, key)


def keyword_response(
    windows: DataFrame,
    requests: DataFrame,
    n: int = S.WINDOW_COMMENTS,
    reset_on_request: bool = True,
    matches: DataFrame | None = None,
) -> DataFrame:
    """One row per full window and user with a request: both keywords' score and total.

    ``windows`` comes from ``count_windows`` and carries ``created_utc``; ``matches`` from ``window_matches``, with
    ``window_no``, ``seq``, ``label`` and ``keyword``. Without ``matches`` they are looked for in ``windows``, which then
    carries ``cleaned_body``, ``subreddit`` and ``label`` too. ``requests`` holds ``user_id``, ``keyword1``,
    ``keyword2`` and ``req_seq``, the number of comments that came before it. With
    ``reset_on_request`` a repeated request starts the user's counts anew inside
    the window, otherwise every comment of the window counts.
    """
    active = requests_by_window(requests, windows, n, reset_on_request)
    sides = F.array(
        *[F.struct(F.lit(i).alias("slot"), F.col(f"keyword{i}").alias("keyword")) for i in (1, 2)]
    )
    ask = ["window_no", "user_id", "keyword1", "keyword2"]
    slots = active.withColumn("_side", F.explode(sides)).select(*ask, "from_seq", "_side.*")
    if matches is None:
        matches = keyword_matches(windows, distinct_keywords(requests))
    matches = matches.select("window_no", "seq", "label", "keyword")
    if reset_on_request:
        matches = durable(matches)  # read by the whole windows and by the partial ones
    whole = keyword_label_counts(matches, ["window_no", "keyword"]).drop("negative", "other")
    if reset_on_request:
        partial = F.col("from_seq") > F.col("window_no") * F.lit(n)
        counted = (
            slots.filter(~partial)
            .join(whole, ["window_no", "keyword"], "left")
            .drop("keyword", "from_seq")
            .unionByName(_counts_from(matches, slots.filter(partial)).drop("keyword", "from_seq"))
        )
    else:
        counted = slots.join(whole, ["window_no", "keyword"], "left")
    by_user = counted.groupBy(*ask).agg(
        *[
            F.coalesce(F.max(F.when(F.col("slot") == i, F.col(c))), F.lit(0)).alias(f"{c}{i}")
            for i in (1, 2)
            for c in ("positive", "neutral", "total")
        ]
    )
    ends = window_first_last_time(windows).select("window_no", "last_utc")
    complete = by_user.join(ends, "window_no")

    def value(i: int) -> Column:
        return positivity_score(F.col(f"positive{i}"), F.col(f"neutral{i}"), F.col(f"total{i}"))

    return complete.select(
        "window_no", "user_id",
        "keyword1", value(1).alias("value1"), "total1",
        "keyword2", value(2).alias("value2"), "total2",
        F.coalesce(epoch_to_iso(F.col("last_utc")), F.lit("-1")).alias("timestamp"),
    )


def keyword_trend(
    comments: DataFrame, requests: DataFrame, width: str = "5 minutes", watermark: str | None = None
) -> DataFrame:
    """Counts and score per keyword and tumbling event-time window; batch or stream."""
    matched = keyword_matches(comments, distinct_keywords(requests))
    timed = matched.withColumn("event_time", F.timestamp_seconds("created_utc"))
    if watermark:
        timed = timed.withWatermark("event_time", watermark)
    counted = timed.groupBy(F.window("event_time", width).alias("_w"), "keyword").agg(*label_counts())
    return scored(counted).select(
        F.col("_w.start").alias("window_start"), "keyword", *COUNTS, "score"
    )


def compare_keywords(scores: DataFrame, keyword1: str, keyword2: str, at: str) -> DataFrame:
    """Two keywords' series side by side per time point; one aggregation, no self-join."""
    both = scores.filter(F.col("keyword").isin(keyword1, keyword2))

    def of(keyword: str, column: str) -> Column:
        return F.max(F.when(F.col("keyword") == keyword, F.col(column)))

    return both.groupBy(at).agg(
        of(keyword1, "score").alias("value1"),
        F.coalesce(of(keyword1, "total"), F.lit(0)).alias("total1"),
        of(keyword2, "score").alias("value2"),
        F.coalesce(of(keyword2, "total"), F.lit(0)).alias("total2"),
    )


def pos_neg_counts(matches: DataFrame) -> DataFrame:
    return keyword_label_counts(matches, ["keyword"]).select("keyword", "positive", "negative")
