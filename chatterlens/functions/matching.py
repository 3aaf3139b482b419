"""Keyword matching: every word of the keyword occurs as a whole word of the text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatterlens.functions.text import let, normalize_phrase, split_words

# A whole word found by \b edges is made of complete runs of these two kinds, so a
# text can hold the word only if it holds each of the word's runs as a run of its own.
RUNS = r"(?U)\w+|[^\w\s]+"
_PLAIN = r"(?U)^\w+$"


def runs(text: Column) -> Column:
    """Distinct runs of word characters and of other characters, lower-cased."""
    def found(lowered: Column) -> Column:
        """Cleaned text, words with one space between, needs no pattern to be cut."""
        cleaned = lowered.rlike(r"^[a-z0-9]++(?: [a-z0-9]++)*+\z")
        return F.when(cleaned, F.split(lowered, " ")).otherwise(F.regexp_extract_all(lowered, F.lit(RUNS), F.lit(0)))

    return F.array_distinct(let(F.lower(F.coalesce(text, F.lit(""))), found))


def whole_word(text: Column, word: Column) -> Column:
    return F.rlike(text, F.concat(F.lit(r"(?U)\b\Q"), word, F.lit(r"\E\b")))


def keyword_match(text: Column, keyword) -> Column:
    """True iff all words of ``keyword`` (text or column) occur in ``text``; never NULL.

    An empty text or keyword never matches; a keyword of spaces only has no
    words and so matches any text.
    """
    text = F.coalesce(text, F.lit(""))
    phrase = normalize_phrase(text)
    if isinstance(keyword, str):
        hit = (text != "") if keyword else F.lit(False)
        for word in keyword.lower().split():
            hit = hit & phrase.rlike(rf"(?U)\b{re.escape(word)}\b")
        return hit
    keyword = F.coalesce(keyword, F.lit(""))
    words = split_words(F.lower(keyword))
    return (text != "") & (keyword != "") & F.forall(words, lambda w: whole_word(phrase, w))


def comment_matches(body: Column, subreddit: Column, keyword) -> Column:
    """The keyword matches the body or the subreddit; its words are not split over both."""
    return keyword_match(body, keyword) | keyword_match(subreddit, keyword)


def keyword_words(keyword: Column) -> Column:
    return F.array_distinct(split_words(F.lower(keyword)))


def keyword_pattern(keyword: Column) -> Column:
    """For a keyword with punctuation: a pattern that looks for each word. NULL when all are plain."""
    words = split_words(F.lower(keyword))
    look = F.transform(words, lambda w: F.concat(F.lit(r"(?=.*\b\Q"), w, F.lit(r"\E\b)")))
    return F.when(
        F.exists(words, lambda w: ~w.rlike(_PLAIN)),
        F.concat(F.lit("(?Us)^"), F.array_join(look, "")),
    )


def keyword_anchor(keyword: Column) -> Column:
    """The keyword's longest run, its equi-join key: '' for spaces only, NULL for an empty keyword."""
    every_run = F.flatten(F.transform(split_words(F.lower(keyword)), runs))
    longest = F.array_max(
        F.transform(every_run, lambda r: F.struct(F.length(r).alias("n"), r.alias("run")))
    )
    return F.when(keyword != "", F.coalesce(longest["run"], F.lit("")))


def words_found(text: Column, text_runs: Column, words: Column, pattern: Column) -> Column:
    """All keyword words occur in the text: plain ones by set lookup, others by pattern.

    Written without lambdas, so that Spark compiles it into the join that uses it, and
    as one CASE, so that no part of it is split off and run on every text before the join.
    """
    return (
        F.when(text == "", F.lit(False))
        .when(pattern.isNull(), F.size(F.array_except(words, text_runs)) == 0)
        .otherwise(F.rlike(F.lower(text), pattern))
    )
