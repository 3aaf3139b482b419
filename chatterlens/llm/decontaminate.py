"""Benchmark passages in training documents, by suffix arrays over the training words.

Runs of training documents are shards of at most ``SHARD_WORDS`` words. A shard's suffix array orders its suffixes by
their first words, as far as any benchmark text is long. Every suffix of every benchmark item is binary-searched in every shard, all
suffixes together, one word deeper at a time: the interval of training suffixes that still agree shrinks until it is empty, so
each place that leaves it tells how long its verbatim match is. Matches of at least ``WINDOW`` words cover what is hit; an item of
fewer words is one window as a whole.

Texts are read as A-Z in lower case and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``; words are compared by 64-bit
hashes (two different words of a corpus and a benchmark agree by chance with less than 1e-5 at 1e10 and 1e4 distinct ones).
Words that no item has are one class that matches nothing, and so is the border between two documents.

The benchmark travels in blocks of about ``BLOCK_BYTES``, chosen by hash, and each block is searched against all documents;
a benchmark is usually one block. Documents are never shuffled unless there are several. A shard that is cut inside a document overlaps
the next one by the longest item.

Defined results: a null or empty text has no words and is clean; an item without words finds nothing; items of one id are one item;
a null item id is the item ``''``; rows that repeat a document id each give a row; an empty benchmark finds nothing; an empty table gives no
rows. Columns of other names pass through ``decontaminate`` unchanged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatterlens.llm import textnum
from chatterlens.llm.storage import stored

WINDOW = 10
SHARD_WORDS = 1 << 21
CHUNK_BYTES = 8 << 20
BLOCK_BYTES = 2 << 20
PIECE = 1 << 21
BORDER = 0
UNKNOWN = 1

#: Bytes that are no part of a word become a space, A-Z lower case.
FOLD = np.full(256, 0x20, np.uint8)
for _first, _last in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
    FOLD[_first: _last + 1] = np.arange(_first, _last + 1)
FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, and the number of words before each text."""
    data = FOLD[data]
    starts, ends, first = textnum.word_bounds(data, offsets)
    return textnum.word_hashes(data, starts, ends), first


class Items:
    """A block of benchmark items: its vocabulary, its words as numbers, and the windows that begin at its suffixes."""

    def __init__(self, ids: list[str], texts: list[str], window: int = WINDOW):
        column = pa.array([t or "" for t in texts], pa.large_string()).cast(pa.large_binary())
        data, offsets = textnum.buffers(column)
        hashes, first = words_of(data[: offsets[-1]], offsets)
        self.vocabulary, codes = np.unique(hashes, return_inverse=True)
        sizes = np.diff(first)
        self.ids = ids
        self.words = codes.astype(np.int32) + 2
        self.item = np.repeat(np.arange(len(sizes)), sizes)
        self.place = np.arange(len(codes)) - first[self.item] if len(codes) else np.zeros(0, np.int64)
        #: Words from each suffix to the end of its item, and in the window it begins (0: none begins there).
        self.left = sizes[self.item] - self.place
        whole = np.minimum(sizes, window)[self.item]
        self.needed = np.where(self.left >= whole, whole, 0)
        self.longest = int(sizes.max(initial=0))

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary numbers of training words, ``UNKNOWN`` for those that no item has."""
        if not len(self.vocabulary):
            return np.full(len(hashes), UNKNOWN, np.int32)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 2, UNKNOWN).astype(np.int32)


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes of ``words`` in order of their first ``depth`` words, by prefix doubling.

    Suffixes that begin with a word no item has match nothing and are left out of it. After the first round only
    runs of equal suffixes are sorted again.
    """
    n = len(words)
    rank = np.concatenate([words.astype(np.int64), np.zeros(1, np.int64)])
    rank[:n][words == UNKNOWN] = 0
    order = np.flatnonzero(words > UNKNOWN)
    order = order[np.argsort(rank[order], kind="stable")]
    # a rank is the place of its run's first suffix, from 1; what is left out has rank 0
    def ranked(keys: np.ndarray, base: np.ndarray) -> np.ndarray:
        fresh = np.ones(len(keys), bool)
        fresh[1:] = keys[1:] != keys[:-1]
        return base[np.maximum.accumulate(np.where(fresh, np.arange(len(keys)), 0))]

    places = np.arange(1, len(order) + 1)
    rank[order] = ranked(rank[order], places)
    tied, width = places - 1, 1
    while width < depth and len(tied):
        own = rank[order[tied]]
        # a run of one is done
        starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        sizes = np.diff(np.concatenate([starts, [len(own)]]))
        tied = tied[np.repeat(sizes > 1, sizes)]
        if not len(tied):
            break
        suffixes = order[tied]
        follow = rank[np.minimum(suffixes + width, n)]
        keys = rank[suffixes] * (n + 1) + follow
        by_key = np.argsort(keys, kind="stable")
        order[tied] = suffixes[by_key]
        # ranks are places in the whole array, so runs keep their order among the others
        rank[order[tied]] = ranked(keys[by_key], tied + 1)
        width *= 2
    return order


def bisect(words: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parts of the intervals ``[low, high)`` whose suffixes have the word ``wanted`` at ``depth``; ``words`` ends in borders."""
    def edge(after: bool) -> np.ndarray:
        a, b = low.copy(), high.copy()
        while True:
            open_ = np.flatnonzero(a < b)
            if not len(open_):
                return a
            middle = (a[open_] + b[open_]) >> 1
            found = words[order[middle] + depth]
            right = found <= wanted[open_] if after else found < wanted[open_]
            a[open_] = np.where(right, middle + 1, a[open_])
            b[open_] = np.where(right, b[open_], middle)

    return edge(False), edge(True)


def pieces(suffixes: np.ndarray, low: np.ndarray, high: np.ndarray, size: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each suffix with each place of its interval, at most ``size`` pairs at a time (one interval may be longer)."""
    counts = high - low
    ends = np.cumsum(counts)
    at = 0
    while at < len(counts):
        done = ends[at - 1] if at else 0
        until = max(at + 1, int(np.searchsorted(ends, done + size, "right")))
        few = counts[at:until]
        if total := int(few.sum()):
            yield np.repeat(suffixes[at:until], few), np.arange(total) + np.repeat(low[at:until] - (np.cumsum(few) - few), few)
        at = until


def search(items: Items, words: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """Every place of a shard that agrees with an item suffix for at least a window, and for how many words: ``(suffixes, length, places)``.

    The length is the whole verbatim match from there on: a place is handed out at the depth at which it leaves the
    interval of its suffix, or at which the item ends.
    """
    padded = np.concatenate([words, np.full(items.longest + 1, BORDER, words.dtype)])
    padded[padded == UNKNOWN] = BORDER
    order = suffix_array(words, items.longest)
    alive = np.flatnonzero(items.needed)
    low, high = np.zeros(len(alive), np.int64), np.full(len(alive), len(order), np.int64)
    for depth in range(items.longest + 1):
        ended = items.left[alive] == depth
        for suffixes, at in pieces(alive[ended], low[ended], high[ended]):
            yield suffixes, depth, order[at]
        alive, low, high = alive[~ended], low[~ended], high[~ended]
        if not len(alive):
            break
        a, b = bisect(padded, order, low, high, depth, items.words[alive + depth])
        whole = items.needed[alive] <= depth
        for begin, end in ((low, a), (b, high)):
            for suffixes, at in pieces(alive[whole], begin[whole], end[whole]):
                yield suffixes, depth, order[at]
        keep = a < b
        alive, low, high = alive[keep], a[keep], b[keep]


def shards(n: int, overlap: int, size: int = SHARD_WORDS) -> Iterator[tuple[int, int]]:
    """Runs of words, each longer than its step by the overlap."""
    for at in range(0, n, size):
        yield at, min(n, at + size + overlap)


def with_borders(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts with a border behind each text, and the place where each text begins."""
    sizes = np.diff(first)
    begins = first[:-1] + np.arange(len(sizes))
    out = np.full(len(codes) + len(sizes), BORDER, np.int32)
    out[np.arange(len(codes)) + np.repeat(np.arange(len(sizes)), sizes)] = codes
    return out, begins


def runs_of(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2]


def scan_texts(items: Items, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[list], list[list]]:
    """Per text: its words, the word runs ``(start, end)`` that windows cover, and the items whose windows occur."""
    hashes, first = words_of(data, offsets)
    n_words = np.diff(first)
    words, begins = with_borders(items.codes(hashes), first)
    steps = np.zeros(len(words) + 1, np.int64)
    pairs = [np.zeros(0, np.int64)]
    for at, end in shards(len(words), items.longest):
        starts, ends = [], []
        for suffixes, length, places in search(items, words[at:end]):
            starts.append(places + at)
            ends.append(places + at + length)
            text = np.searchsorted(begins, starts[-1], "right") - 1
            pairs.append(pd.unique(text * len(items.ids) + items.item[suffixes]))
        if starts:
            steps += np.bincount(np.concatenate(starts), minlength=len(steps)) - np.bincount(np.concatenate(ends), minlength=len(steps))
    spans, found = [[] for _ in n_words], [[] for _ in n_words]
    for a, b in zip(*runs_of(np.cumsum(steps)[:-1] > 0)):
        text = int(np.searchsorted(begins, a, "right")) - 1
        spans[text].append({"start": int(a - begins[text]), "end": int(b - begins[text])})
    for pair in pd.unique(np.concatenate(pairs)):
        found[int(pair) // len(items.ids)].append(items.ids[int(pair) % len(items.ids)])
    return n_words, spans, found


SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def _scanner(items: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, data, offsets in textnum.text_chunks(batch, "_text", CHUNK_BYTES):
                n_words, spans, found = scan_texts(items.value, data, offsets)
                names = [n for n in batch.schema.names if n != "_text"]
                kept = [batch.column(batch.schema.get_field_index(n)).slice(at, end - at) for n in names]
                added = [pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(SPAN)), pa.array(found, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*kept, *added], [*names, "n_words", "spans", "items"])

    return scan


FOUND = "n_words long, spans array<struct<start:long,end:long>>, items array<string>"


def _with(kept: DataFrame, added: str) -> T.StructType:
    return T.StructType([*kept.schema.fields, *T.StructType.fromDDL(added).fields])


def blocks(benchmark: DataFrame, window: int, block_bytes: int = BLOCK_BYTES) -> Iterator[Items]:
    """The benchmark in blocks of about ``block_bytes``, one after the other; at least one, which may be empty."""
    item, text = F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = benchmark.select(item.alias("item_id"), text.alias("text")).distinct()
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        held = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        held.sort()
        yield Items([r["item_id"] for r in held], [r["text"] for r in held], window)


def covered_words(spans: Column) -> Column:
    """How many words lie in at least one of the spans."""
    begun = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("n"))

    def add(acc: Column, s: Column) -> Column:
        fresh = F.greatest(s["end"] - F.greatest(s["start"], acc["at"]), F.lit(0).cast("long"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), (acc["n"] + fresh).alias("n"))

    return F.aggregate(F.array_sort(spans), begun, add, lambda acc: acc["n"])


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without its text, with ``n_words``, ``spans`` (hit word runs, from 0) and ``items`` (ids, sorted as strings).

    Spans of several benchmark blocks may overlap; ``covered_words`` counts each word once.
    """
    spark, keys = docs.sparkSession, [c for c in docs.columns if c != "text"]
    if clash := {c for c in keys if c in ("n_words", "spans", "items", "_text", "_row")}:
        docs, keys = docs.drop(*clash), [c for c in keys if c not in clash]
    texts = docs.select(*keys, F.col("text").cast("string").alias("_text"))
    parts = list(blocks(benchmark, window, block_bytes))
    if len(parts) > 1:  # rows need a name to be put together again
        texts = stored(texts.withColumn("_row", F.monotonically_increasing_id()), "texts")
    found = []
    for part in parts:
        found.append(texts.mapInArrow(_scanner(spark.sparkContext.broadcast(part)), _with(texts.drop("_text"), FOUND)))
    if len(parts) == 1:
        return found[0].withColumn("items", F.array_sort(F.array_distinct("items")))
    merged = found[0]
    for other in found[1:]:
        merged = merged.unionByName(other)
    first = [F.first(c).alias(c) for c in [*keys, "n_words"]]
    merged = merged.groupBy("_row").agg(
        *first, F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items")
    )
    return merged.withColumn("items", F.array_sort(F.array_distinct("items"))).drop("_row")


def summary(found: DataFrame) -> DataFrame:
    """Counts and digest of ``find``'s result."""
    n_hit = covered_words(F.col("spans"))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the documents that hold a window of an item; columns as they are."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    found = find(docs.select(whole.alias("whole"), "text"), benchmark, window)
    return found.where(F.size("items") == 0).select("whole.*")


MATCH = pa.schema([
    ("item_id", pa.string()), ("item_word", pa.int64()), ("length", pa.int64()), ("doc_id", pa.int64()), ("doc_word", pa.int64()),
])


def _matcher(items: Broadcast, least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = items.value
        best = np.zeros(len(known.words), np.int64)
        where: list[tuple | None] = [None] * len(best)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            for at, _, data, offsets in textnum.text_chunks(batch, "_text", CHUNK_BYTES):
                hashes, first = words_of(data, offsets)
                words, begins = with_borders(known.codes(hashes), first)
                for begin, end in shards(len(words), known.longest):
                    for suffixes, length, places in search(known, words[begin:end]):
                        for s, place in zip(suffixes, places + begin):
                            if length > best[s]:
                                text = int(np.searchsorted(begins, place, "right")) - 1
                                best[s], where[s] = length, (ids[at + text].as_py(), int(place - begins[text]))
        rows = [s for s in np.flatnonzero(best >= least) if where[s]]
        yield pa.RecordBatch.from_arrays([
            pa.array([known.ids[known.item[s]] for s in rows], pa.string()),
            pa.array(known.place[rows], pa.int64()), pa.array(best[rows], pa.int64()),
            pa.array([where[s][0] for s in rows], pa.int64()), pa.array([where[s][1] for s in rows], pa.int64()),
        ], schema=MATCH)

    return scan


def longest_matches(docs: DataFrame, benchmark: DataFrame, least: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(item_id, item_word, length, doc_id, doc_word)``: the longest verbatim match of each item suffix and one of its places.

    Each task keeps the best match per suffix of its documents; the best of all tasks, smallest place first, is one grouped
    maximum. Suffixes that match fewer than ``least`` words are left out.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("_text"))
    schema = "item_id string, item_word long, length long, doc_id long, doc_word long"
    found = None
    for part in blocks(benchmark, least, block_bytes):
        one = texts.mapInArrow(_matcher(docs.sparkSession.sparkContext.broadcast(part), least), schema)
        found = one if found is None else found.unionByName(one)
    best = F.max(F.struct("length", (-F.col("doc_id")).alias("_doc"), (-F.col("doc_word")).alias("_word"))).alias("_best")
    return found.groupBy("item_id", "item_word").agg(best).select(
        "item_id", "item_word", "_best.length", (-F.col("_best._doc")).alias("doc_id"), (-F.col("_best._word")).alias("doc_word")
    )
