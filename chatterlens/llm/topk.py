"""Exact top-k inner-product search by the three-phase uniform threshold.

A vector's components are dealt into ``SLICES`` slices, so a score is the sum of that many partial scores, one per list.
Candidates and queries lie in blocks; a task meets one block of each at a time. Blocks of candidates are dealt into slices of
``SPREAD`` blocks and move once a pass; the query blocks, one in so many rows, are repeated per slice. So tasks grow with the candidates.
The repeated query blocks stream through a merge join that holds the candidates of one slice; they are never broadcast, since Spark
sizes them by the table before it is repeated.

1. Every list of a block names its k best entries per query; their scores are resolved, and the k-th best resolved
   score over all blocks is a safe cutoff (a lower bound of the true k-th best).
2. The cutoff goes back to the blocks with the queries. An entry whose score reaches it has a partial score of at
   least cutoff / ``SLICES`` in some list, so each list hands over all entries at or above that uniform threshold.
3. The remaining scores are resolved exactly for what was handed over; each block keeps at most its k best that
   reach the cutoff, and a ranked window (score descending, then id) gives the result.

In phases 2 and 3 the first list is computed whole. A later list is computed only for entries that an earlier one handed over, and for
those whose norms (Cauchy and Schwarz) allow it the uniform threshold and the cutoff.

Scores are integers. Partial products run in floats while every sum stays below 2^24, in doubles below 2^53, else in 64-bit integers;
components whose sums could reach 2^63 raise an error instead of wrapping round. Blocks are stored in the narrowest integers that hold them.

Defined results: vectors that are null or hold a null or non-finite component take no part; vectors of
another length count as padded with zeros; empty vectors score 0. A query never meets rows of its own id. A repeated id
asks once, with its smallest vector, while each of its rows is a candidate. Null ids take no part. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chatterlens.llm.storage import stored

SLICES = 2
CANDIDATES = 8192
QUERIES = 2048
TILE = 256
SPREAD = 4
#: Below this share of a tile, single entries are resolved instead of the whole tile.
SPARSE = 1 / 16
SCALE = 64

BLOCK = "block long, ids binary, width int, vectors binary"


def usable(df: DataFrame, id_column: str, vector: str) -> DataFrame:
    """``(vec_id, v)`` with integer components floor(``SCALE`` * x), without the vectors that take no part."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < math.inf))
    rows = df.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False)))
    return rows.select(F.col(id_column).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * SCALE).cast("long")).alias("v"))


def _pack(ids: list, vectors: list) -> tuple[bytes, int, bytes]:
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    low, high = int(out.min(initial=0)), int(out.max(initial=0))
    kind = next(k for k in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    return np.array(ids, np.int64).tobytes(), width, out.astype(kind).tobytes()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), CANDIDATES):
            part = batch.slice(at, CANDIDATES)
            ids = part.column("vec_id").to_pylist()
            packed, width, vectors = _pack(ids, part.column("v").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[0]], pa.int64()), pa.array([packed]), pa.array([width], pa.int32()), pa.array([vectors])],
                ["block", "ids", "width", "vectors"],
            )


def _query_block(table: pa.Table) -> pa.Table:
    packed, width, vectors = _pack(table.column("vec_id").to_pylist(), table.column("v").to_pylist())
    return pa.table({
        "block": table.column("block").slice(0, 1), "ids": pa.array([packed]),
        "width": pa.array([width], pa.int32()), "vectors": pa.array([vectors]),
    })


def _unpack(row, prefix: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row[f"{prefix}ids"], np.int64)
    own, packed = row[f"{prefix}width"], row[f"{prefix}vectors"]
    kind = np.dtype(f"i{len(packed) // max(len(ids) * own, 1) or 8}")
    vectors = np.frombuffer(packed, kind).reshape(len(ids), own).astype(np.int64)
    return ids, np.pad(vectors, ((0, 0), (0, width - own)))


def exact(q: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both sides in a type in which every sum of products is exact."""
    largest = int(np.abs(q).max(initial=0)) * int(np.abs(x).max(initial=0)) * max(q.shape[1], 1)
    if largest >= 1 << 63:
        raise OverflowError("inner products of these vectors may exceed 64 bits")
    kind = np.float32 if largest < 1 << 24 else np.float64 if largest < 1 << 53 else np.int64
    return q.astype(kind), x.astype(kind)


def lists(width: int) -> list[slice]:
    """The components of each list."""
    return [slice(width * i // SLICES, width * (i + 1) // SLICES) for i in range(SLICES)]


def partial_scores(q: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
    """One matrix (queries by candidates) per list."""
    q, x = exact(q, x)
    return [q[:, part] @ x[:, part].T for part in lists(q.shape[1])]


def sufficient(q: np.ndarray, x: np.ndarray, cutoff: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query place, candidate place and score of every entry that reaches its query's cutoff, but for those in ``same``."""
    q, x = exact(q, x)
    parts = lists(q.shape[1])

    def norms(rows, part):
        return np.sqrt((rows[:, part].astype(np.float64) ** 2).sum(axis=1))

    # a little below the cutoff, as doubles round; the last comparison is exact
    limit = (cutoff - np.abs(cutoff) * 1e-9 - 1)[:, None]
    total = q[:, parts[0]] @ x[:, parts[0]].T
    handed, open_ = total >= limit / SLICES, ~same
    bounds = [np.outer(norms(q, part), norms(x, part)) * (1 + 1e-9) + 1 for part in parts[1:]]
    for i, part in enumerate(parts[1:]):
        rest = sum(bounds[i:])
        could = np.logical_or.reduce([bound >= limit / SLICES for bound in bounds[i:]])
        open_ &= (handed | could) & (total + rest >= limit)
        if open_.mean() < SPARSE:
            rows, places = np.nonzero(open_)
            for at in range(0, len(rows), 1 << 16):
                r, p = rows[at: at + (1 << 16)], places[at: at + (1 << 16)]
                one = np.einsum("ij,ij->i", q[r, part], x[p, part])
                total[r, p] += one
                handed[r, p] |= one >= limit[r, 0] / SLICES
        else:
            whole = q[:, part] @ x[:, part].T
            total += whole
            handed |= whole >= limit / SLICES
    rows, places = np.nonzero(open_ & handed & (total >= cutoff[:, None]))
    return rows, places, total[rows, places]


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: score descending, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


def _least(kind) -> float | int:
    return -np.inf if kind.kind == "f" else np.iinfo(np.int64).min


def _tiles(row):
    width = max(row["q_width"], row["width"])
    (ids, x), (q_ids, q) = _unpack(row, "", width), _unpack(row, "q_", width)
    for at in range(0, len(q_ids), TILE):
        own = q_ids[at: at + TILE]
        yield ids, x, own, q[at: at + TILE], at, own[:, None] == ids[None, :]


def _rows(frames, pick):
    for batch in frames:
        for i in range(len(batch)):
            row, queries, found, scores = batch.slice(i, 1).to_pylist()[0], [], [], []
            for ids, x, own, q, at, same in _tiles(row):
                for query, places, total in pick(row, ids, x, own, q, at, same):
                    queries.append(np.full(len(places), query, np.int64))
                    found.append(ids[places])
                    scores.append(total.astype(np.int64))
            if queries:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c), pa.int64()) for c in (queries, found, scores)], ["query_id", "vec_id", "score"]
                )


def _local_lists(k: int):
    """Phase 1: the k best resolved scores among the k best entries of each list."""

    def pick(row, ids, x, own, q, at, same):
        parts = partial_scores(q, x)
        low = _least(parts[0].dtype)
        count = min(k, len(ids))
        named = []
        for part in parts:
            part = np.where(same, low, part)
            named.append(np.argpartition(-part, count - 1, axis=1)[:, :count])
        named = np.concatenate(named, axis=1)
        for i, query in enumerate(own):
            places = np.unique(named[i][ids[named[i]] != query])
            total = sum(part[i, places] for part in parts)
            top = best(ids[places], total, k)
            yield query, places[top], total[top]

    return lambda frames: _rows(frames, pick)


def _sufficient(k: int):
    """Phases 2 and 3: hand over by the uniform threshold, resolve, keep what reaches the cutoff."""

    def pick(row, ids, x, own, q, at, same):
        cutoff = np.frombuffer(row["cutoffs"], np.int64)[at: at + len(own)]
        rows, places, total = sufficient(q, x, cutoff, same)
        ends = np.searchsorted(rows, np.arange(len(own) + 1))
        for i, query in enumerate(own):
            mine = slice(ends[i], ends[i + 1])
            top = best(ids[places[mine]], total[mine], k)
            yield query, places[mine][top], total[mine][top]

    return lambda frames: _rows(frames, pick)


#: A cutoff that everything reaches, for queries with fewer than k candidates; far from overflow when compared.
ANY = -(1 << 60)


def _with_cutoffs(left: pa.Table, right: pa.Table) -> pa.Table:
    ids = np.frombuffer(left.column("q_ids")[0].as_buffer(), np.int64) if len(left) else np.zeros(0, np.int64)
    known = dict(zip(right.column("query_id").to_pylist(), right.column("cutoff").to_pylist()))
    cutoffs = np.array([known.get(i, ANY) for i in ids.tolist()], np.int64).tobytes()
    return left.append_column("cutoffs", pa.array([cutoffs] * len(left), pa.binary()))


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row that ``is_query`` allows, its ``k`` best other rows."""
    rows = usable(vectors, id_column, vector)
    asked = usable(vectors.where(is_query), id_column, vector).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = stored(asked, "asked")
    groups = max(1, math.ceil(asked.count() / QUERIES))
    numbered = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(groups)))
    queries = stored(numbered.groupBy("block").applyInArrow(_query_block, BLOCK), "queries").select(
        F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("width").alias("q_width"), F.col("vectors").alias("q_vectors")
    )
    blocks = stored(rows.mapInArrow(_blocks, BLOCK), "blocks")
    slices = max(1, math.ceil(blocks.count() / SPREAD))
    dealt = blocks.withColumn("slice", F.pmod(F.xxhash64("block"), F.lit(slices)))
    every_slice = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).alias("slice")
    scored = "query_id long, vec_id long, score long"

    def met(asking: DataFrame) -> DataFrame:
        return asking.select("*", every_slice).join(dealt.hint("merge"), "slice")

    named = met(queries).mapInArrow(_local_lists(k), scored)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    cutoffs = kth.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("cutoff")).where(F.col("n") == k)
    cutoffs = cutoffs.select("query_id", "cutoff", F.pmod(F.xxhash64("query_id"), F.lit(groups)).alias("q_block"))
    with_cutoffs = stored(
        queries.groupBy("q_block").cogroup(cutoffs.groupBy("q_block")).applyInArrow(
            _with_cutoffs, "q_block long, q_ids binary, q_width int, q_vectors binary, cutoffs binary"
        ), "cutoffs",
    )
    found = met(with_cutoffs).mapInArrow(_sufficient(k), scored)
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
