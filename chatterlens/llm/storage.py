"""Durable intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from chatterlens.session import staging_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage; survives the loss of any executor; later readers prune columns.
    """
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
