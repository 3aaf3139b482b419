"""Joins against a side that is usually, but not provably, small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_CHARS = 64 << 20
SALTS = 64


def fits(small: DataFrame, max_rows: int = BROADCAST_ROWS, max_chars: int = BROADCAST_CHARS) -> bool:
    """Whether ``small`` may be broadcast, by its rows and characters."""
    chars = F.length(F.to_json(F.struct(*small.columns)))
    rows, size = small.limit(max_rows + 1).agg(F.count("*"), F.coalesce(F.sum(chars), F.lit(0))).first()
    return rows <= max_rows and size <= max_chars


def sized_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
    *,
    hot: Column | None = None,
) -> DataFrame:
    """Join that broadcasts ``small`` only after measuring it, rows and characters.

    Beyond ``max_rows`` or ``BROADCAST_CHARS`` both sides are shuffled on the key and a salt, so the rows
    of a hot key spread over ``salts`` tasks; every row of ``small`` is repeated
    once per salt, which keeps the result exact for inner, left and semi joins.
    ``hot``, a condition on a key's rows of ``small`` that holds for few keys, limits this to them.
    The salted sides are merged whatever Spark takes their size for: it does not count the repeats.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"unsupported join type {how}")
    if fits(small, max_rows):
        return big.join(F.broadcast(small), on, how)
    salt, last = F.pmod(F.xxhash64(*big.columns), F.lit(salts)).cast("int"), F.lit(salts - 1)
    if hot is not None:
        marks = small.where(hot).select(*on, F.lit(True).alias("_hot")).distinct()
        big = big.join(F.broadcast(marks), on, "left")
        salt, last = F.when(F.col("_hot"), salt).otherwise(F.lit(0)), F.when(hot, last).otherwise(F.lit(0))
    salted_big = big.withColumn("_salt", salt)
    salted_small = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))
    return salted_big.join(salted_small.hint("merge"), [*on, "_salt"], how).drop("_salt", *["_hot"] * (hot is not None))
