"""TF-IDF over words and word pairs, and the side features of a comment."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, VectorAssembler
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatterlens.functions.text import let
from chatterlens.operators.joins import sized_join
from chatterlens.operators.sequence import first_rows, with_global_index
from chatterlens.session import durable, staging_path

# The feature configurations (min_df, max_features, sublinear).
FULL_VOCABULARY = {"min_df": 5, "max_features": 50_000, "sublinear": False}
SAMPLE_VOCABULARY = {"min_df": 10, "max_features": 25_000, "sublinear": True}
WORD = r"(?U)\b\w\w+\b"
ASCII_WORD = r"\w\w+"
# Distinct terms of a run of counts, rows of it that are written at once, and places in its summary.
RUN_TERMS, RUN_BATCH, SUMMARY_TERMS = 1 << 20, 1 << 16, 1 << 17
# Words that are looked up inside the row, from the plan.
MARKED_WORDS = 2_000


def word_tokens(text: Column) -> Column:
    """Lower-case tokens of two or more word characters; in plain ASCII the short pattern finds the same ones."""

    def found(whole: Column) -> Column:
        plain = F.octet_length(whole) == F.length(whole)
        short, full = (F.regexp_extract_all(whole, F.lit(p), F.lit(0)) for p in (ASCII_WORD, WORD))
        return F.when(plain, short).otherwise(full)

    return let(F.lower(F.coalesce(text, F.lit(""))), found)


def _pairs(words: Column) -> Column:
    """Each pair of neighbours joined by a space; NULL where one of the two is."""
    pairs = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(
        F.slice(words, F.lit(1), pairs), F.slice(words, F.lit(2), pairs), lambda a, b: F.concat(a, F.lit(" "), b)
    )


def ngrams_1_2(tokens: Column) -> Column:
    """The tokens, then each pair of neighbours joined by a space."""
    return let(tokens, lambda words: F.concat(words, _pairs(words)))


def terms(text: Column) -> Column:
    return ngrams_1_2(word_tokens(text))


def _marked(tokens: Column, words: list[str]) -> Column:
    """The tokens with NULL in the place of all but some ``words``."""
    return F.transform(tokens, lambda w: F.when(w.isin(words), w))


def pairs_of(tokens: Column, words: list[str]) -> Column:
    """The pairs of neighbours that are both among ``words``."""
    return F.array_compact(let(_marked(tokens, words), _pairs))


def terms_of(tokens: Column, words: list[str]) -> Column:
    """The terms of the tokens that are made of ``words`` only."""
    return F.array_compact(ngrams_1_2(_marked(tokens, words)))


def term_counts(found: Column) -> Column:
    """Distinct terms of one document with their counts, from the runs of the sorted list.

    Counting inside the row means that no (document, term) pair is ever shuffled.
    """

    def count_runs(ordered: Column) -> Column:
        places = F.filter(
            F.sequence(F.lit(0), F.greatest(F.size(ordered) - 1, F.lit(0))),
            lambda i: (F.get(ordered, i).isNotNull())
            & ((i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1))),
        )

        def measure(starts: Column) -> Column:
            ends = F.concat(F.slice(starts, F.lit(2), F.greatest(F.size(starts) - 1, F.lit(0))), F.array(F.size(ordered)))
            return F.zip_with(
                starts, ends,
                lambda a, b: F.struct(F.get(ordered, a).alias("term"), (b - a).cast("bigint").alias("tf")),
            )

        return F.when(F.size(ordered) > 0, let(places, measure)).otherwise(
            F.array().cast("array<struct<term:string,tf:bigint>>")
        )

    return let(F.sort_array(found), count_runs)


def term_stats(documents: DataFrame, text: str = "cleaned_body") -> DataFrame:
    """Corpus count and document count of each term; combined in the map tasks first."""
    counted = documents.select(F.explode(term_counts(terms(F.col(text)))).alias("_t"))
    return counted.groupBy("_t.term").agg(F.sum("_t.tf").alias("cf"), F.count("*").alias("df"))


_DIGIT = 12


def kth_largest(rows: DataFrame, column: str, k: int) -> tuple[int, int] | None:
    """The ``k``-th largest value of a column of counts, and how many of its ties are among the first ``k``.

    None when there are fewer rows. Found digit by digit: each pass counts the rows per value of one digit, at most
    4,096 groups, so nothing is sorted and no task sees more than counts.
    """
    largest = rows.agg(F.max(column)).first()[0]
    if largest is None or k <= 0:
        return None
    shift, prefix, wanted = -(-int(largest).bit_length() // _DIGIT) * _DIGIT, 0, k
    while shift > 0:
        inside = rows.filter(F.shiftright(column, shift) == prefix) if shift < 60 else rows
        shift -= _DIGIT
        digit = F.shiftright(column, shift).bitwiseAND(F.lit((1 << _DIGIT) - 1))
        counts = sorted(inside.groupBy(digit.alias("digit")).agg(F.count("*").alias("n")).collect(), reverse=True)
        for found, n in counts:
            if n >= wanted:
                break
            wanted -= n
        else:
            return None
        prefix = prefix << _DIGIT | int(found)
    return prefix, wanted


def top_terms(stats: DataFrame, k: int) -> DataFrame:
    """The ``k`` terms with the largest corpus count, ties by term.

    The smallest count that can still get in is found digit by digit; all terms above it are in, and only those that
    tie on it are ranked. ``stats`` is read several times, so it should be a stored table.
    """
    edge = kth_largest(stats, "cf", k)
    if edge is None:
        return stats if k > 0 else stats.limit(0)
    value, room = edge
    return stats.filter(F.col("cf") > value).unionByName(stats.filter(F.col("cf") == value).orderBy("term").limit(room))


_RUN_SCHEMA = "run long, place long, term string, cf long, df long"


def _term_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's own documents, in runs of bounded size, the most frequent terms of a run first."""
    run = TaskContext.get().partitionId() << 32

    def merged(tables: list[pa.Table]) -> pa.Table:
        summed = pa.concat_tables(tables).group_by("term").aggregate([("cf", "sum"), ("df", "sum")])
        return summed.select(["term", "cf_sum", "df_sum"]).rename_columns(["term", "cf", "df"])

    def out(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.sort_by([("cf", "descending"), ("term", "ascending")])
        numbers = pa.array(np.arange(len(table)))
        whole = table.add_column(0, "place", numbers).add_column(0, "run", pa.array(np.full(len(table), run)))
        yield from whole.to_batches(max_chunksize=RUN_BATCH)

    held, size = [], 0
    for batch in batches:
        held.append(pa.table({"term": batch.column(0), "cf": batch.column(1), "df": pa.array(np.ones(len(batch), np.int64))}))
        size += len(batch)
        if size > 2 * RUN_TERMS:
            held = [merged(held)]
            size = len(held[0])
            if size > RUN_TERMS:
                yield from out(held[0])
                held, size, run = [], 0, run + 1
    if size:
        yield from out(merged(held))


def term_runs(documents: DataFrame, text: str = "cleaned_body") -> DataFrame:
    """``run, place, term, cf, df``: counts combined where the texts lie; nothing is shuffled. Stored: the one pass over the texts."""
    return _runs_of(documents, terms(F.col(text)))


def _runs_of(documents: DataFrame, found: Column) -> DataFrame:
    path = staging_path(documents.sparkSession, "term-runs")
    counted = documents.select(F.explode(term_counts(found)).alias("_t")).select("_t.term", "_t.tf")
    counted.mapInArrow(_term_runs, _RUN_SCHEMA).write.parquet(path)
    return documents.sparkSession.read.schema(_RUN_SCHEMA).parquet(path)


def heavy_terms(runs: DataFrame, k: int, min_df: int = 1, summary: int | None = None) -> DataFrame:
    """Exact ``term, cf, df`` of a set of terms that holds the ``k`` most frequent ones found in ``min_df`` documents.

    The first ``summary`` places of a run are its summary; what it leaves out has at most the count of the next place.
    Summed over the runs, that is the error of the summaries. The k-th largest sum of summaries is a floor of the k-th
    count: terms whose sum, with the error, stays below it are out, and only the rest is counted exactly. When the error reaches
    the floor, or there are too few terms, all terms are counted.
    """
    summary = summary or max(SUMMARY_TERMS, 2 * k)
    exact = [F.sum("cf").alias("cf"), F.sum("df").alias("df")]
    error = runs.filter(F.col("place") == summary).agg(F.coalesce(F.sum("cf"), F.lit(0))).first()[0]
    if not error:  # the summaries hold everything
        return runs.groupBy("term").agg(*exact).filter(F.col("df") >= min_df)
    low = durable(runs.filter(F.col("place") < summary).groupBy("term").agg(*exact))
    floor = kth_largest(low.filter(F.col("df") >= min_df), "cf", k)
    if floor is None or error >= floor[0]:
        return runs.groupBy("term").agg(*exact).filter(F.col("df") >= min_df)
    candidates = durable(low.filter(F.col("cf") + error >= floor[0]).select("term"))
    counted = sized_join(runs, candidates, ["term"], "left_semi").groupBy("term").agg(*exact)
    return counted.filter(F.col("df") >= min_df)


def _list_counts(lists: DataFrame, found: Column) -> DataFrame:
    """``term, cf, df`` over lists of terms: a term is new to its document where its neighbour in the sorted list is another."""
    ordered = lists.select(F.sort_array(found).alias("_s"))
    placed = ordered.select("_s", F.posexplode_outer("_s").alias("_i", "term")).filter("term IS NOT NULL")
    fresh = (F.col("_i") == 0) | (F.get("_s", F.col("_i") - 1) != F.col("term"))
    return placed.groupBy("term").agg(F.count("*").alias("cf"), F.count_if(fresh).alias("df"))


def most_frequent_terms(documents: DataFrame, k: int, min_df: int = 1, text: str = "cleaned_body") -> DataFrame:
    """``term, cf, df`` of the ``k`` most frequent terms in at least ``min_df`` documents, ties by term.

    The texts are cut into words once and the words are counted first. The k-th count among them is a floor of the k-th
    count of all terms, and a pair is never more frequent than either of its words, so only pairs of words that reach
    the floor are counted. When too many words reach it, or there are fewer than ``k``, all terms are counted in runs.
    """
    path = staging_path(documents.sparkSession, "words")
    documents.select(word_tokens(F.col(text)).alias("_words")).write.parquet(path)
    lists, words = documents.sparkSession.read.schema("_words array<string>").parquet(path), F.col("_words")
    counted = durable(_list_counts(lists, words))
    floor = kth_largest(counted.filter(F.col("df") >= min_df), "cf", k)
    reached = counted.filter(F.col("cf") >= floor[0]) if floor else counted.limit(0)
    marked = [r.term for r in reached.select("term").limit(MARKED_WORDS + 1).collect()]
    if not 0 < len(marked) <= MARKED_WORDS:
        return top_terms(durable(heavy_terms(_runs_of(lists, ngrams_1_2(words)), k, min_df)), k)
    pairs = _list_counts(lists, pairs_of(words, marked))
    return top_terms(durable(reached.unionByName(pairs).filter(F.col("df") >= min_df)), k)


def fit_vocabulary(
    documents: DataFrame, min_df: int, max_features: int, text: str = "cleaned_body"
) -> DataFrame:
    """``term, idx, cf, df``: terms in enough documents, the most frequent, numbered by name."""
    chosen = most_frequent_terms(documents, max_features, min_df, text)
    by_name = F.row_number().over(W.orderBy("term")) - 1  # at most max_features rows
    return chosen.select("term", by_name.alias("idx"), "cf", "df")


def idf_weights(vocabulary: DataFrame, documents: int | Column) -> DataFrame:
    """Smoothed inverse document frequency, plus one."""
    n = documents if isinstance(documents, Column) else F.lit(documents)
    return vocabulary.withColumn("idf", F.log((F.lit(1) + n) / (F.lit(1) + F.col("df"))) + F.lit(1.0))


def fit_on_first_n(
    documents: DataFrame, n: int, order: list, min_df: int, max_features: int, text: str = "cleaned_body"
) -> DataFrame:
    return fit_vocabulary(first_rows(documents, n, order), min_df, max_features, text)


def vector_entries(vector: Column) -> Column:
    """The stored entries of a sparse or dense vector as (idx, weight)."""
    inner = F.unwrap_udt(vector)
    sparse = F.zip_with(
        inner["indices"], inner["values"], lambda i, w: F.struct(i.alias("idx"), w.alias("weight"))
    )
    dense = F.transform(inner["values"], lambda w, i: F.struct(i.alias("idx"), w.alias("weight")))
    return F.filter(F.when(inner["type"] == 0, sparse).otherwise(dense), lambda e: e["weight"] != 0)


@F.pandas_udf(VectorUDT())
def damped(vectors: pd.DataFrame) -> pd.DataFrame:
    """One plus the logarithm of every stored count; batches of vectors travel as Arrow columns."""
    sizes = [len(v) for v in vectors["values"]]
    flat = np.log(np.concatenate([*vectors["values"], np.zeros(0)])) + 1.0
    return vectors.assign(values=np.split(flat, np.cumsum(sizes)[:-1]) if sizes else [])


@dataclass
class Vectorizer:
    """A fitted vocabulary with its weights; its size is bounded by ``max_features``."""

    vocabulary: list[str]
    idf: list[float]
    sublinear: bool = False

    @classmethod
    def fit(
        cls, documents: DataFrame, min_df: int, max_features: int, sublinear: bool = False,
        text: str = "cleaned_body",
    ) -> Vectorizer:
        rows = idf_weights(
            fit_vocabulary(documents, min_df, max_features, text), documents.count()
        ).orderBy("idx").collect()
        return cls([r.term for r in rows], [r.idf for r in rows], sublinear)

    def transform(self, documents: DataFrame, text: str = "cleaned_body", output: str = "features") -> DataFrame:
        """Add the L2-normalised TF-IDF vector; a map over rows, without a shuffle."""
        counter = CountVectorizerModel.from_vocabulary(self.vocabulary, "_terms", "_counts")
        weigher = ElementwiseProduct(scalingVec=Vectors.dense(self.idf), inputCol="_counts", outputCol="_weighted")
        scaler = Normalizer(p=2.0, inputCol="_weighted", outputCol=output)
        counted = counter.transform(documents.withColumn("_terms", self._known_terms(text)))
        if self.sublinear:
            counted = counted.withColumn("_counts", damped(F.col("_counts")))
        return scaler.transform(weigher.transform(counted)).drop("_terms", "_counts", "_weighted")

    def _known_terms(self, text: str) -> Column:
        """The terms of a text, without those that hold a word of no term of the vocabulary, where its words are few."""
        words = sorted({w for term in self.vocabulary for w in term.split(" ")})
        return terms_of(word_tokens(F.col(text)), words) if 0 < len(words) <= MARKED_WORDS else terms(F.col(text))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = list(zip(range(len(self.idf)), self.vocabulary, self.idf))
        table = spark.createDataFrame(rows, "idx int, term string, idf double")
        table.withColumn("sublinear", F.lit(self.sublinear)).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Vectorizer:
        rows = spark.read.parquet(path).orderBy("idx").collect()
        return cls([r.term for r in rows], [r.idf for r in rows], bool(rows and rows[0].sublinear))


def encode_subreddit(comments: DataFrame) -> DataFrame:
    """Add the subreddit's place in the sorted list of all distinct ones."""
    names = comments.select("subreddit").distinct().filter("subreddit IS NOT NULL")
    codes = with_global_index(names, ["subreddit"], "subreddit_code")
    return sized_join(comments, codes, ["subreddit"], "left")


def minmax_score(comments: DataFrame, score: str = "score") -> DataFrame:
    """Scale the score to [0, 1] by its range over all rows, with nulls as 0."""
    value = F.coalesce(F.col(score), F.lit(0)).cast("double")
    bounds = comments.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high"))).scalar()
    scaled = F.try_divide(value - bounds["low"], bounds["high"] - bounds["low"])
    return comments.withColumn("score_scaled", F.coalesce(scaled, F.lit(0.0)))


def assemble_features(
    rows: DataFrame, inputs: list[str], output: str = "all_features"
) -> DataFrame:
    """Append numeric columns to the text vector."""
    numeric = [c for c in inputs if not isinstance(rows.schema[c].dataType, VectorUDT)]
    filled = rows.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numeric})
    return VectorAssembler(inputCols=inputs, outputCol=output).transform(filled)


def features_with_meta(features: DataFrame, meta: DataFrame) -> DataFrame:
    """Join feature rows to their metadata by id instead of by row position."""
    return features.join(meta, "id")
