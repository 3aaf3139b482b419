"""Emoji, emoticons, sampling, anchors, error records and the bounded state of streams."""

import json

from pyspark.sql import functions as F

from chatterlens.functions import lexicon as X
from chatterlens.functions.text import clean_text, emoji_to_words
from chatterlens.plans.tables import JOINED_EMOJI
from chatterlens.functions.wordlists import EMOJI
from chatterlens.operators import analytics as A
from chatterlens.operators import keywords as K
from chatterlens.sources.results import BatchTable
from chatterlens.streaming import jobs


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t"))).first()[0]


def test_every_emoji_has_a_name(spark):
    assert len(EMOJI) > 2000 and all(name and " " not in name for name in EMOJI.values())
    assert one(spark, clean_text, "nice 🥳 😭") == "nice facewithpartyhornandpartyhat loudlycryingface"
    assert one(spark, emoji_to_words, "a👍🏽b❤️é“x”") == "a thumbs_up_medium_skin_tone b red_heart é“x”"
    assert one(spark, lambda t: emoji_to_words(t, {}), "a😀") == "a😀"


def test_joined_emoji_have_one_name(spark):
    for sequence, name in JOINED_EMOJI.items():
        assert one(spark, emoji_to_words, f"a{sequence}b") == f"a {name} b"
    # an unknown part, a mark that the character does not take, a lone joiner, digits and letters
    assert one(spark, emoji_to_words, "\U0001f525\u200d\u2b00x") == " fire \u200d\u2b00x"
    assert one(spark, emoji_to_words, "😀\ufe0f 1 # \u200d") == " grinning_face \ufe0f 1 # \u200d"
    assert one(spark, emoji_to_words, "\U0001f1e9x") == " regional_indicator_symbol_letter_d x"
    assert one(spark, lambda t: emoji_to_words(t, {":-)": "smile", "😀": "grin", "=": "equal"}), "a:-)=😀") == "a smile  equal  grin "


def test_emoticons_and_emoji_are_scored(spark):
    plain, more = one(spark, X.lexicon_compound, "so happy"), one(spark, X.lexicon_compound, "so happy :)")
    assert 0 < plain < more
    assert one(spark, lambda t: X.lexicon_compound(t, {"heart": 1.0}), "❤️") > 0


def test_a_lexicon_of_real_size(spark):
    words = {f"w{i}": 1.0 if i % 2 else -1.0 for i in range(7500)}
    score = one(spark, lambda t: X.lexicon_compound(t, words), "w1 of w2 and w7499")
    assert score == one(spark, lambda t: X.lexicon_compound(t, {"w1": 1.0, "w2": -1.0, "w7499": 1.0}), "w1 of w2 and w7499")


def test_a_bounded_sample_is_the_same_every_time(spark):
    rows = spark.range(2000).withColumnRenamed("id", "key")
    whole = {r.key for r in A.bernoulli_sample(rows, 0.3, "key").collect()}
    few = [{r.key for r in A.bernoulli_sample(rows.repartition(n), 0.3, "key", at_most=50).collect()} for n in (1, 7)]
    assert 450 < len(whole) < 750 and few[0] == few[1] and len(few[0]) == 50 and few[0] <= whole
    assert A.bernoulli_sample(rows, 1.0, "key").count() == 2000


def test_anchor_filter_never_misses(spark, monkeypatch):
    """A bitmap with every bit set, a crowded one and the usual one give the same matches."""
    said = spark.createDataFrame([("1", "the cat sat", "pets"), ("2", None, "the"), ("3", "don't", "x"), ("4", "the cat sat\n", "y"), ("5", "a  cat ", "Cat\n")], "id string, cleaned_body string, subreddit string")
    asked = spark.createDataFrame([("the",), ("cat sat",), ("don't",), (" ",), ("none",)], "keyword string")
    usual = sorted((r.id, r.keyword) for r in K.keyword_matches(said, asked).collect())
    monkeypatch.setattr(K, "MIN_BITS", 6)
    for most in (6, 7):
        monkeypatch.setattr(K, "MAX_BITS", most)
        assert sorted((r.id, r.keyword) for r in K.keyword_matches(said, asked).collect()) == usual
    assert {("2", "the"), ("1", "cat sat"), ("3", "don't"), ("4", "cat sat"), ("5", " ")} <= set(usual)


def test_many_keywords_leave_few_rows(spark):
    """100,000 keywords: almost only runs that are asked for become rows."""
    said = spark.range(3000).select(
        F.col("id"), F.concat(F.lit("a"), "id", F.lit(" b"), "id", F.lit(" c"), "id", F.lit(" k"), F.col("id") * 50).alias("cleaned_body"), F.lit("f").alias("subreddit")
    )
    asked = spark.range(100_000).select(F.concat(F.lit("k"), "id").alias("keyword"))
    wanted = asked.withColumn("_run", F.col("keyword"))
    run_filter = K.RunFilter.of(wanted, "_run")
    rows = said.select(F.explode(run_filter.passing(F.split("cleaned_body", " "))).alias("run")).persist()
    asked_for = rows.filter("run LIKE 'k%' AND CAST(substring(run, 2) AS INT) < 100000").count()
    assert run_filter.bits == 1 << 21 and asked_for == 2000 and rows.count() < 2000 + 0.03 * 4 * 3000
    found = K.keyword_matches(said, asked, kept=["id"])
    assert found.count() == 2000 and found.filter("keyword = concat('k', id * 50)").count() == 2000


def test_old_batches_are_forgotten(spark, folder):
    table = BatchTable(spark, folder("t"), "n bigint")
    for batch_id in (8, 9, 10):
        table.write(spark.range(batch_id).withColumnRenamed("id", "n"), batch_id)
    table.forget(10)
    assert (table.newest_batch(), table.has_batch(9), table.read().count()) == (10, False, 10)


def test_broken_values_get_error_records(spark):
    class Model:
        vectorizer = classifier = None

    class Predict:
        @staticmethod
        def predict_label(rows, vectorizer, classifier):
            return rows.withColumn("label", F.lit("neutral"))

    kept, jobs.M = jobs.M, Predict
    try:
        lines = spark.createDataFrame([("junk",), ('{"id": "1"} x',), ("[1]",), ('{"id": "5", "cleaned_body": "a"}',)], "value string")
        values = [json.loads(r.value) for r in jobs.label_values(lines, Model).collect()]
    finally:
        jobs.M = kept
    assert [v["label"] for v in values] == ["error"] * 3 + ["neutral"]
    assert all("id" not in v and v["cleaned_body"] == "" for v in values[:3]) and values[3]["id"] == "5"
