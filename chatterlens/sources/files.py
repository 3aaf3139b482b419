"""Files in and out: compressed dumps, JSON lines, CSV, text lines, chunked features."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatterlens import schemas as S


def spread(df: DataFrame) -> DataFrame:
    """Deal out an input that has fewer splits than there are cores.

    Such an input holds less than one full split per core, so moving it costs little
    beside the text work, while a lone row group or a file that cannot be split would
    keep one core busy and all others idle. A large table has more splits than cores
    and is never moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """Lines of plain or compressed (.zst, .gz, .bz2) dump files.

    ``file`` and ``line`` order the lines as they lie in the files: ``line`` grows
    within a file, but is not a line count.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    return spread(lines)


DUMP_ORDER = ["file", "block", "line"]


def write_jsonl(df: DataFrame, path: str, compression: str = "none") -> None:
    df.write.option("compression", compression).option("ignoreNullFields", False).json(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = S.RAW_COMMENT) -> DataFrame:
    return spark.read.schema(schema).json(path)


# Quotes are doubled and outer spaces kept, so bodies may hold quotes, commas and newlines.
CSV = {
    "header": True, "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.options(**CSV, quoteAll=True, emptyValue='""').csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType = S.ARCHIVE_LABELED) -> DataFrame:
    return spark.read.schema(schema).options(**CSV, multiLine=True).csv(path)


def write_text_lines(df: DataFrame, path: str, column: str = "cleaned_body") -> None:
    df.select(F.col(column).alias("value")).write.text(path)


def read_text_lines(spark: SparkSession, path: str, column: str = "cleaned_body") -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", column)


def write_chunks(chunked: DataFrame, path: str) -> None:
    """One folder per chunk, so that choosing chunks prunes the read.

    Rows of a chunk are brought together first, large chunks in several parts, so there are about as many files as chunks and not
    one for each chunk in every task.
    """
    chunked.hint("rebalance", "chunk_id").write.partitionBy("chunk_id").parquet(path)


def read_chunks(spark: SparkSession, path: str, chunk_ids: list[int] | None = None) -> DataFrame:
    chunks = spark.read.parquet(path)
    return chunks if chunk_ids is None else chunks.filter(F.col("chunk_id").isin(*chunk_ids))


def meta_chunks(chunked: DataFrame) -> DataFrame:
    return chunked.select(*S.META_CHUNK.fieldNames(), "chunk_id")


MAX_DICTIONARY_ROWS, MAX_DICTIONARY_CHARS = 200_000, 32 << 20


def read_dictionary(spark: SparkSession, path: str) -> dict:
    """A two-column dictionary (key, value) from .json, .csv or parquet, for the text functions.

    Dictionaries are word lists of bounded size; a larger table is refused.
    """
    if path.endswith(".json"):
        lines = spark.read.text(path)
        if (lines.agg(F.sum(F.length("value"))).first()[0] or 0) > MAX_DICTIONARY_CHARS:
            raise ValueError(f"{path} has more than {MAX_DICTIONARY_CHARS} characters")
        found = json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()))
        if len(found) > MAX_DICTIONARY_ROWS:
            raise ValueError(f"{path} has more than {MAX_DICTIONARY_ROWS} entries")
        return found
    if path.endswith(".csv"):
        table = spark.read.option("header", True).option("escape", '"').csv(path)
    else:
        table = spark.read.parquet(path)
    rows = table.limit(MAX_DICTIONARY_ROWS + 1).collect()
    if len(rows) > MAX_DICTIONARY_ROWS:
        raise ValueError(f"{path} has more than {MAX_DICTIONARY_ROWS} entries")
    return {row[0]: row[1] for row in rows}
