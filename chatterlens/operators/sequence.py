"""Global order without a global sort task: row numbers, neighbours and running sums.

Everything here works in two levels. Rows are cut into groups of bounded size; one
small row per group is ordered across the whole data; each group then finishes on
its own. No task ever holds more than one group or the list of groups.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatterlens import schemas as S
from chatterlens.session import staging_path

COMMENT_ORDER = ["created_utc", "id"]
GROUP_WIDTH = 1 << 17
MAX_EDGES = 10_000


def whole_part(column: str, n: int) -> Column:
    """Integer division, exact for any row number."""
    return F.expr(f"`{column}` div {n}L")


def index_and_count(df: DataFrame, order: list, index: str = "seq") -> tuple[DataFrame, int]:
    """Number all rows 0..n-1 by ``order``, which must be a total order; also return n.

    Rows are range-partitioned, sorted in place and written as Parquet. A row's number is its place in
    its file plus the rows of the files before: a position index that no later plan, retry or split of a
    file can change, and whose readers prune columns. Only one number per file reaches the driver.
    Keep the rows narrow: what is not needed for the order can be joined back or computed before.
    """
    path = staging_path(df.sparkSession, "ordered")
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)
    laid_out = df.sparkSession.read.schema(df.schema).parquet(path)
    numbered = laid_out.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_local"))
    sizes = numbered.groupBy("_file").agg(F.count("*").alias("n")).collect()
    sizes = sorted(sizes, key=lambda r: (int(r["_file"].split("-")[1]), r["_file"]))
    starts = [0, *accumulate(r["n"] for r in sizes)]
    offsets = df.sparkSession.createDataFrame(
        [(r["_file"], start) for r, start in zip(sizes, starts)], "_file string, _start bigint"
    )
    indexed = numbered.join(F.broadcast(offsets), "_file").select(
        *df.columns, (F.col("_start") + F.col("_local")).alias(index)
    )
    return indexed, starts[-1]


def with_global_index(df: DataFrame, order: list, index: str = "seq") -> DataFrame:
    return index_and_count(df, order, index)[0]


def count_windows(
    df: DataFrame, n: int = S.WINDOW_COMMENTS, order: list | None = None
) -> DataFrame:
    """Tumbling windows of ``n`` rows in arrival order; the last, partial one is dropped.

    Adds ``seq`` and ``window_no``. Hand in the key and order columns only: what a text holds is found
    where the text lies and joined to its number by the key (``keywords.window_matches``).
    """
    indexed, total = index_and_count(df, order or COMMENT_ORDER)
    windows = indexed.withColumn("window_no", whole_part("seq", n))
    return windows.filter(F.col("seq") < total // n * n)


def _named(order: list) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).alias(f"_k{i}") for i, c in enumerate(order)]


_JSON_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_PLAIN_KEYS = (T.IntegralType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _last_not_above(key: Column, edges: Column, n: int) -> Column:
    """The place of the last of ``n`` ascending ``edges`` that is not above ``key``, by binary search."""
    halves = [1 << b for b in reversed(range(max(n - 1, 1).bit_length()))]

    def step(low: Column, half: Column) -> Column:
        ahead = F.get(edges, low + half)
        return F.when(ahead.isNotNull() & (ahead <= key), low + half).otherwise(low)

    return F.aggregate(F.array(*[F.lit(h) for h in halves]), F.lit(0), step)


def row_chunks(df: DataFrame, order: list, size: int = S.CHUNK_ROWS) -> DataFrame:
    """Add ``chunk_id``: chunks from 1, ``size`` rows each, in the input order given by ``order``, a total order.

    Only the order columns are shuffled and numbered. The first key of each chunk then tells every row,
    wherever it lies, its chunk; texts and vectors stay in place. With more than ``MAX_EDGES`` chunks, or keys that
    have no exact text form, the rows themselves are numbered.
    """
    named = _named(order)
    keys = [f"_k{i}" for i in range(len(order))]
    narrow = df.select(*named)
    if not all(isinstance(f.dataType, _PLAIN_KEYS) for f in narrow.schema.fields):
        return _numbered_chunks(df, order, size)
    indexed, total = index_and_count(narrow, keys, "_row")
    n = max(1, -(-total // size))
    if n > MAX_EDGES:
        return _numbered_chunks(df, order, size)
    first = F.sort_array(F.collect_list(F.struct(*keys)))
    # at most MAX_EDGES keys
    edges = indexed.filter(F.col("_row") % size == 0).agg(F.to_json(first, _JSON_TIMES)).first()[0]
    literal = F.from_json(F.lit(edges), T.ArrayType(narrow.schema), _JSON_TIMES)
    return df.withColumn("chunk_id", (_last_not_above(F.struct(*named), literal, n) + 1).cast("bigint"))


def _numbered_chunks(df: DataFrame, order: list, size: int) -> DataFrame:
    indexed = with_global_index(df, order, "_row")
    return indexed.withColumn("chunk_id", whole_part("_row", size) + 1).drop("_row")


def first_rows(df: DataFrame, n: int, order: list) -> DataFrame:
    """The first ``n`` rows by ``order``; all rows when ``n <= 0``.

    A short prefix is a top-n; a long one is cut by global row number, so that it
    never has to fit into one task.
    """
    if n <= 0:
        return df
    if n <= 10_000:
        return df.orderBy(*order).limit(n)
    return with_global_index(df, order, "_row").filter(F.col("_row") < n).drop("_row")


def _grouped(df: DataFrame, keys: list[str], order: str, width: int) -> tuple[DataFrame, list[str]]:
    """Cut the rows of each key into groups by ``order``; also return the columns that name a group.

    The keys are held in one struct, in which NULL equals NULL, so that the window
    and the join below can share one shuffle.
    """
    grouped = df.withColumn("_group", whole_part(order, width))
    return (grouped.withColumn("_key", F.struct(*keys)), ["_key", "_group"]) if keys else (grouped, ["_group"])


def running_sums(
    df: DataFrame, keys: list[str], order: str, sums: dict[str, Column], width: int = GROUP_WIDTH
) -> DataFrame:
    """Add running sums by an integer ``order`` that is unique within ``keys``."""
    values = df.withColumns({f"_v_{name}": value for name, value in sums.items()})
    grouped, names = _grouped(values, keys, order, width)
    totals = grouped.groupBy(*names).agg(*[F.sum(f"_v_{s}").alias(f"_t_{s}") for s in sums])
    before = W.partitionBy(*names[:-1]).orderBy("_group").rowsBetween(W.unboundedPreceding, -1)
    bases = totals.select(*names, *[F.sum(f"_t_{s}").over(before).alias(f"_b_{s}") for s in sums])
    inside = W.partitionBy(*names).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    summed = grouped.withColumns({f"_o_{s}": F.sum(f"_v_{s}").over(inside) for s in sums})
    joined = summed.join(bases, names, "left")
    added = {}
    for s in sums:
        base, own = F.col(f"_b_{s}"), F.col(f"_o_{s}")
        added[s] = F.when(base.isNull(), own).when(own.isNull(), base).otherwise(base + own)
    return joined.withColumns(added).select(*df.columns, *sums)


def neighbours(
    df: DataFrame,
    keys: list[str],
    order: str,
    values: dict[str, str],
    step: int = -1,
    width: int = GROUP_WIDTH,
) -> DataFrame:
    """Add values of the previous (``step=-1``) or next (``step=1``) row within ``keys``.

    ``values`` maps the new column name to the neighbour's column. ``order`` is an
    integer, unique within ``keys``.
    """
    pick = F.max_by if step < 0 else F.min_by
    shift = F.lag if step < 0 else F.lead
    neighbour = F.struct(*[F.col(source).alias(name) for name, source in values.items()])
    grouped, names = _grouped(df, keys, order, width)
    edges = grouped.groupBy(*names).agg(pick(neighbour, order).alias("_edge"))
    across = W.partitionBy(*names[:-1]).orderBy("_group")
    bases = edges.select(*names, shift("_edge").over(across).alias("_outer"))
    inside = W.partitionBy(*names).orderBy(order)
    shifted = grouped.withColumn("_inner", shift(neighbour).over(inside))
    found = shifted.join(bases, names, "left").withColumn("_near", F.coalesce("_inner", "_outer"))
    return found.select(*df.columns, *[F.col(f"_near.{name}").alias(name) for name in values])


def same_second_batches(indexed: DataFrame, index: str = "seq") -> DataFrame:
    """One row per run of consecutive rows with equal ``created_utc``, numbered from 0."""
    times = indexed.select(index, "created_utc")
    compared = neighbours(times, [], index, {"previous_utc": "created_utc"})
    begins = (~F.col("created_utc").eqNullSafe(F.col("previous_utc"))) & (F.col(index) > 0)
    marked = running_sums(compared, [], index, {"batch_no": begins.cast("bigint")})
    return marked.groupBy("batch_no", "created_utc").agg(
        F.count("*").alias("batch_size"), F.min(index).alias("first_seq")
    )


def replay_schedule(batches: DataFrame, speed: float = S.REPLAY_SPEED) -> DataFrame:
    """Delay before each batch, and its due time, when replayed at ``speed`` times real time."""
    compared = neighbours(batches, [], "batch_no", {"previous_utc": "created_utc"})
    gap = (F.col("created_utc") - F.col("previous_utc")) / F.lit(float(speed))
    delayed = compared.withColumn("delay_seconds", F.greatest(F.coalesce(gap, F.lit(0.0)), F.lit(0.0)))
    due = running_sums(delayed, [], "batch_no", {"due_seconds": F.col("delay_seconds")})
    return due.drop("previous_utc")


def paced_replay(
    indexed: DataFrame, speed: float = S.REPLAY_SPEED, interval_seconds: int = 1, index: str = "seq"
) -> DataFrame:
    """When each row is due at ``speed`` times real time, and the trigger that delivers it.

    Written in ``slice_no`` order and read back a few files per trigger, the rows arrive
    at about the pace they were made.
    """
    compared = neighbours(indexed, [], index, {"_previous": "created_utc"})
    gap = F.greatest(F.coalesce(F.col("created_utc") - F.col("_previous"), F.lit(0)), F.lit(0))
    due = running_sums(compared, [], index, {"due_seconds": gap / F.lit(float(speed))})
    return due.drop("_previous").withColumn(
        "slice_no", F.floor(F.col("due_seconds") / F.lit(interval_seconds))
    )
