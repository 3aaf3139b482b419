"""Best-fit packing: a configuration linear program over the length histogram.

Documents are tokenised (with an end id) and only longer ones are cut, into full pieces behind a first piece that may be
shorter. What is packed is the histogram of piece lengths, at most ``CAPACITY`` numbers, so the program's size does not
depend on the corpus:

* minimise the number of sequences over configurations (multisets of lengths within the capacity) that cover all counts;
* multiplicative weights: each round prices lengths by how far they lag behind, a knapsack dynamic program over the
  capacity finds the most valuable configuration through every length, and the nearly best ones share the round's mass;
* rounding: each configuration is used its whole number of times; the rest goes to the same program again, as long as
  that places enough, and the last remainder to best-fit decreasing on the histogram.

The result is a list of runs (length, first rank, count -> sequences and offsets). Pieces are ranked within their length by
parts of bounded size and look their place up in the runs. There are at most ``ROUNDS`` configurations per length and
repetition, whatever the corpus, so the runs may be broadcast.

Defined results: a null or empty text is the end id alone; a null id stays null; repeated rows are packed
each; an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import math
import os
import re
import zlib
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from chatterlens.llm import textnum
from chatterlens.llm.storage import stored

CAPACITY = 2048
END_ID = 0
ROUNDS = 60
NEAR = 0.02
PART = 100_000


class Encoder:
    """Token ids of whole texts as little-endian 32-bit numbers.

    ``path`` is a vocabulary for the tokenizers library. With ``ranks``, the same byte-level vocabulary as a rank file, texts in
    Latin letters without very long words take the faster tiktoken library; there the two agree on
    every character class. Texts with the content of an added token (control strings) take tokenizers, which gives them its id.
    """

    PLAIN = re.compile("[\x00-\u024f]*")
    LONG = re.compile(r"\S{400}")

    def __init__(self, path: str, ranks: str | None = None, pattern: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                pairs = (line.split() for line in lines)
                table = {base64.b64decode(token): int(rank) for token, rank in pairs}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
            probe = "It's 12 naïve  words,\n\nand <| more\t…"
            if self.fast.encode_ordinary(probe) != self.slow(probe):
                raise ValueError(f"{ranks} is not the vocabulary of {path}")

    def slow(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> bytes:
        plain = self.fast and self.PLAIN.fullmatch(text) and not self.LONG.search(text) and not any(t in text for t in self.added)
        return array("I", self.fast.encode_ordinary(text) if plain else self.slow(text)).tobytes()


@functools.cache
def encoder(path: str, ranks: str | None, pattern: str | None) -> Encoder:
    """One per Python worker."""
    return Encoder(path, ranks, pattern)


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    first = length if length <= capacity else length % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, length, capacity))]


def _pieces(tokenizer: tuple, capacity: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(*tokenizer)
        end = np.uint32(END_ID).tobytes()
        for batch in batches:
            ids = batch.column("doc_id")
            for at, stop, _, _ in textnum.text_chunks(batch, "text"):
                rows = []
                texts = batch.column("text").slice(at, stop - at).to_pylist()
                for doc_id, text in zip(ids.slice(at, stop - at).to_pylist(), texts):
                    tokens = memoryview((encode.ids(text) if text else b"") + end)
                    for number, (start, length) in enumerate(cuts(len(tokens) // 4, capacity)):
                        own = tokens[4 * start: 4 * (start + length)]
                        rows.append((doc_id, number, start, length, zlib.crc32(own), bytes(own) if keep_ids else None))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return run


def pieces(docs: DataFrame, tokenizer: tuple[str, str | None, str | None], capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, ids)``; the ids (little-endian, 32 bits each) on request.

    ``tokenizer``: vocabulary file, and optionally the same as ranks with its splitting pattern.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(
        _pieces(tokenizer, capacity, keep_ids), "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
    )


# The linear program


def knapsack(lengths: np.ndarray, values: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Per capacity the best value with any number of each length, and the item taken last (-1: none, a token stays free)."""
    best, taken = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if fits[c]:
            total = best[c - lengths[: fits[c]]] + values[: fits[c]]
            i = int(total.argmax())
            if total[i] > best[c]:
                best[c], taken[c] = total[i], i
    return best, taken


def configurations(lengths: np.ndarray, taken: np.ndarray, through: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """The best configuration through each of the given items."""
    found = []
    for i in through:
        items, left = [int(i)], capacity - int(lengths[i])
        while left > 0:
            if taken[left] < 0:
                left -= 1
                continue
            items.append(int(taken[left]))
            left -= int(lengths[taken[left]])
        found.append(tuple(sorted(items)))
    return found


def fractional(lengths: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> Counter:
    """How often each configuration is used, by multiplicative weights; covers the counts nearly."""
    covered, mass = np.zeros(len(lengths)), Counter()
    weight = np.ones(len(lengths))
    per_round = max(float(lengths @ counts) / capacity, float(counts[lengths > capacity // 2].sum())) / rounds
    for done in range(1, rounds + 1):
        values = weight * lengths / capacity
        best, taken = knapsack(lengths, values, capacity)
        through = values + best[capacity - lengths]
        lag = np.maximum(counts * done / rounds - covered, 0.0)
        near = np.flatnonzero((through >= (1 - NEAR) * through.max()) & (lag > 0))
        if not len(near):
            near = np.array([int(np.where(lag > 0, through, -1.0).argmax())])
        chosen = configurations(lengths, taken, near, capacity)
        share = lag[near] / np.array([c.count(i) for c, i in zip(chosen, near.tolist())])
        share *= per_round / share.sum() if share.sum() > 0 else 0.0
        for config, x in zip(chosen, share.tolist()):
            mass[config] += x
            for i in config:
                covered[i] += x
        ahead = covered / counts - done / rounds
        weight = np.exp(-np.clip(ahead, -2.0, 2.0))
    return mass


def best_fit_decreasing(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> Counter:
    """Configurations of the classic heuristic, on groups of equal sequences."""
    free: dict[int, Counter] = defaultdict(Counter)  # free tokens -> configuration -> how often
    for i in np.argsort(-lengths):
        left, size = int(counts[i]), int(lengths[i])
        for room in sorted(r for r in free if r >= size):
            while left and free[room]:
                config, n = free[room].popitem()
                each = min(room // size, left)
                take = min(n, left // each)
                if take < n:
                    free[room][config] += n - take
                free[room - each * size][config + (int(i),) * each] += take
                left -= take * each
            if not left:
                break
        each = capacity // size
        if left >= each:
            free[capacity - each * size][(int(i),) * each] += left // each
        if left % each:
            free[capacity - (left % each) * size][(int(i),) * (left % each)] += 1
    out = Counter()
    for configs in free.values():
        for config, n in configs.items():
            out[tuple(sorted(config))] += n
    return out


def solve(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences), placing every piece of the histogram exactly once."""
    lengths = np.array(sorted(length for length in histogram if length < capacity), np.int64)
    left = np.array([histogram[int(length)] for length in lengths], np.int64)
    plan = Counter()
    while left.sum():
        used = np.flatnonzero(left)
        mass = fractional(lengths[used], left[used].astype(float), capacity)
        placed = 0
        for config, x in sorted(mass.items(), key=lambda item: (-item[1], item[0])):
            need = Counter(int(used[i]) for i in config)
            times = min([int(x + 1e-9), *(int(left[i]) // n for i, n in need.items())])
            if times > 0:
                plan[tuple(sorted(need.elements()))] += times
                placed += times * len(config)
                for i, n in need.items():
                    left[i] -= times * n
        if placed * 4 < placed + left.sum():
            break
    for config, n in best_fit_decreasing(lengths, left, capacity).items():
        plan[config] += n
    out = [(tuple(int(lengths[i]) for i in config), n) for config, n in sorted(plan.items()) if n]
    if capacity in histogram:
        out.append(((capacity,), histogram[capacity]))
    return out


RUN = ("length", "first", "count", "sequence", "each", "offset")


def runs(plan: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows of ``RUN``, sorted by length and first rank: where the pieces of a length go, by rank."""
    rows, sequence, rank = [], 0, defaultdict(int)
    for config, times in plan:
        offset = 0
        for length, each in sorted(Counter(config).items()):
            rows.append((length, rank[length], each * times, sequence, each, offset))
            rank[length] += each * times
            offset += each * length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, len(RUN))


def _place(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        length, first, _, sequence, each, offset = table.T
        key = (length << 44) + first
        for batch in batches:
            size, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            at = np.searchsorted(key, (size << 44) + rank, "right") - 1
            within = rank - first[at]
            kept = [batch.column(n) for n in batch.schema.names if n != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence[at] + within // each[at]), pa.array(offset[at] + within % each[at] * size)],
                [*(n for n in batch.schema.names if n != "_rank"), "sequence_id", "offset"],
            )

    return run


def pack_pieces(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (with ``length``, and ``doc_id``, ``piece`` to order by) with ``sequence_id`` and ``offset``."""
    cut = stored(cut, "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= capacity rows
    total = sum(histogram.values())
    parts = max(1, math.ceil(total / PART))
    dealt = cut.withColumn("_part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = dealt.groupBy("length", "_part").agg(F.count("*").alias("_n")).withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    within = Window.partitionBy("length", "_part").orderBy("doc_id", "piece")
    ranked = dealt.withColumn("_row", F.row_number().over(within)).join(base.drop("_n"), ["length", "_part"])
    ranked = ranked.withColumn("_rank", (F.col("_base") + F.col("_row") - 1).cast("long")).select(*cut.columns, "_rank")
    shared = cut.sparkSession.sparkContext.broadcast(runs(solve(histogram, capacity)))  # size: see above
    schema = T.StructType([*cut.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(_place(shared), schema)


def pack(docs: DataFrame, tokenizer: tuple[str, str | None, str | None], capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack: one row per piece with its sequence and offset."""
    cut = pieces(docs, tokenizer, capacity, keep_ids)
    return pack_pieces(cut if keep_ids else cut.drop("ids"), capacity)
