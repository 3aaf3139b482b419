"""Near-duplicate groups: MinHash bands, sequential Bayesian verification, exact check, components.

1. Each text becomes its set of word shingles and a MinHash signature of ``BANDS * ROWS`` values.
   Equal sets are one class, named by its smallest id (a grouped minimum, so hot copies combine map-side).
2. Bands are bucket keys. First every class is paired with the smallest member of its buckets, then,
   where a bucket still holds several components, with the largest. Both give at most one pair per class.
3. A pair is compared by batches of signature values. With ``m`` of ``n`` values equal and a uniform
   prior, P(similarity >= t | m, n) = P(Binomial(n + 1, t) <= m); the pair is pruned once that falls
   below ``MISS``. Survivors are confirmed on the full shingle sets.
4. What is still in several components within one bucket is compared in blocks of ``BLOCK`` members
   (only block pairs that hold more than one component), by the same signature test. A pair counts only in
   the first bucket both share: near copies meet in many of the ``BANDS``. Members with a surviving partner
   get their full sets, and a link is confirmed only while its two sides are not yet connected. Block pairs
   are dealt over tasks by counted rows, pairs and shingles; a task returns a spanning forest, never its pairs.

Bands, block pairs and hits are joined by merging: Spark sizes exploded bands by the unexploded table, and stored rows that repeat
values by their compressed files, and would broadcast what exceeds the driver's memory.

Two texts that meet the similarity share no bucket with probability (1 - t^ROWS)^BANDS, 5e-7 at t = 0.8.

Defined results: null or empty texts and texts without words have an empty set and are linked with
nothing (component = own id, kept). Rows that repeat an id are one document, linked through the id. A null id
is a document of its own without links: its component is null and it is kept. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from chatterlens.llm import textnum
from chatterlens.llm.graph import components
from chatterlens.llm.storage import stored
from chatterlens.operators.joins import sized_join

BANDS, ROWS = 48, 6
HASHES = BANDS * ROWS
BATCH = 48
MISS = 1e-7
BLOCK = 256
BLOCK_PAIR = ["key", "bi", "bj"]
PAIRS = 1 << 15
BIN_ROWS, BIN_PAIRS, BIN_VALUES = 1 << 12, 1 << 21, 1 << 20
HOT = 1 << 12

_random = np.random.Generator(np.random.PCG64(20240607))
MULTIPLY = _random.integers(1, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
ADD = _random.integers(0, 1 << 32, HASHES, dtype=np.uint32)

SIGNED = "doc_id long, n_shingles long, digest binary, bands array<long>, signature binary"
SIGNED_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
    ("bands", pa.list_(pa.int64())), ("signature", pa.binary()),
])


def minhash(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``HASHES`` minima per non-empty set."""
    sizes = np.array([len(s) for s in sets])
    out = np.empty((len(sets), HASHES), np.uint32)
    at = 0
    while at < len(sets):
        end = max(at + 1, at + int(np.searchsorted(np.cumsum(sizes[at:]), 1 << 16, "right")))
        x = (np.concatenate(sets[at:end]) >> np.uint64(32)).astype(np.uint32)
        begin = np.concatenate([[0], np.cumsum(sizes[at:end])[:-1]])
        for k in range(HASHES):
            out[at:end, k] = np.minimum.reduceat(x * MULTIPLY[k] + ADD[k], begin)
        at = end
    return out


def band_keys(minima: np.ndarray) -> np.ndarray:
    """A 64-bit key per band; the band's number is part of it."""
    keys = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(minima), 1))
    for r in range(ROWS):
        keys = textnum.mix(keys * np.uint64(0x9E3779B97F4A7C15) + minima[:, r::ROWS].astype(np.uint64))
    return keys.view(np.int64)


def _sign(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for at, end, data, offsets in textnum.text_chunks(batch, "text"):
                sets = textnum.shingle_sets(data, offsets, size)
                full = [i for i, s in enumerate(sets) if len(s)]
                minima = minhash([sets[i] for i in full])
                keys = band_keys(minima)
                marks = np.ascontiguousarray((minima & np.uint32(255)).astype(np.uint8))
                place = np.full(len(sets), -1)
                place[full] = np.arange(len(full))
                yield pa.RecordBatch.from_arrays([
                    ids.slice(at, end - at).cast(pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.array([keys[p] if p >= 0 else None for p in place], pa.list_(pa.int64())),
                    pa.array([marks[p].tobytes() if p >= 0 else None for p in place], pa.binary()),
                ], schema=SIGNED_ARROW)

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for at, end, data, offsets in textnum.text_chunks(batch, "text"):
                sets = textnum.shingle_sets(data, offsets, size)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, end - at).cast(pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["node", "shingles"],
                )

    return run


def least_matches(threshold: float, miss: float = MISS) -> list[tuple[int, int]]:
    """After ``n`` compared values, the fewest equal ones that keep a pair alive."""
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        below, m = 0.0, -1
        while below < miss:
            m += 1
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


def alive(left: np.ndarray, right: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """Which rows of two signature matrices survive all batches."""
    rows, equal, done = np.arange(len(left)), np.zeros(len(left), np.int64), 0
    for n, least in bounds:
        equal = equal + (left[rows, done:n] == right[rows, done:n]).sum(axis=1)
        keep = equal >= least
        rows, equal, done = rows[keep], equal[keep], n
    out = np.zeros(len(left), bool)
    out[rows] = True
    return out


def surviving(sig: np.ndarray, i: np.ndarray, j: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """Places of the pairs of rows ``(i, j)`` that survive all batches; only the values of a batch are gathered."""
    at, equal, done = np.arange(len(i)), np.zeros(len(i), np.int64), 0
    for n, least in bounds:
        if not len(at):
            break
        equal = equal + (sig[i[at], done:n] == sig[j[at], done:n]).sum(axis=1)
        keep = equal >= least
        at, equal, done = at[keep], equal[keep], n
    return at


def survivors(sig: np.ndarray, i: int, other: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """Which of the rows ``other`` survive all batches against row ``i``."""
    return other[surviving(sig, np.full(len(other), i), other, bounds)]


def block_pairs(begins: np.ndarray, side: np.ndarray, limit: int = PAIRS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of a block, about ``limit`` at a time: both sides of a block with two, else each two of its rows.

    Rows lie block by block, side 0 first; ``begins`` holds the first row of each block.
    """
    n = len(side)
    sizes = np.diff(np.append(begins, n))
    ones = np.add.reduceat(side, begins)
    row, end = np.arange(n), np.repeat(begins + sizes, sizes)
    start = np.where(np.repeat(ones, sizes) > 0, end - np.repeat(ones, sizes), row + 1)
    total = np.cumsum(np.where(side == 0, end - start, 0))
    at = done = 0
    while at < n:
        stop = max(at + 1, int(np.searchsorted(total, done + limit, "right")))
        count = np.diff(total[at:stop], prepend=done)
        i = np.repeat(row[at:stop], count)
        j = np.arange(done, total[stop - 1]) - np.repeat(total[at:stop] - count - start[at:stop], count)
        yield i, j
        at, done = stop, total[stop - 1]


def pairs_to_confirm(pdf, bounds: list[tuple[int, int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of different components that survive the signature test, in the first bucket both share.

    ``pdf`` holds whole block pairs, in order of ``BLOCK_PAIR`` and side.
    """
    if not len(pdf):
        return
    sig, bands = matrix(pdf["signature"]), np.concatenate(pdf["bands"].to_numpy()).reshape(-1, BANDS)
    comp, side = pdf["component"].to_numpy(), pdf["side"].to_numpy(np.int64)
    at = pdf[BLOCK_PAIR].to_numpy()
    begins = np.flatnonzero(np.append(True, (at[1:] != at[:-1]).any(axis=1)))
    for i, j in block_pairs(begins, side):
        other = comp[i] != comp[j]
        i, j = i[other], j[other]
        good = surviving(sig, i, j, bounds)
        i, j = i[good], j[good]
        first = (bands[i] == bands[j]).argmax(axis=1)
        here = bands[i, first] == at[i, 0]
        yield i[here], j[here]


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on sorted distinct sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(len(column), HASHES)


def _prune(bounds):
    def run(frames):
        for pdf in frames:
            if len(pdf):
                yield pdf.loc[alive(matrix(pdf["sig_a"]), matrix(pdf["sig_b"]), bounds), ["a", "b"]]

    return run


def _confirm(percent):
    def run(frames):
        for pdf in frames:
            sets = zip(pdf["set_a"], pdf["set_b"])
            good = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in sets]
            yield pdf.loc[np.array(good, bool), ["a", "b"]]

    return run


def _candidates(bounds):
    """Rows that have a pair to confirm in their block pair."""

    def run(pdf):
        pdf = pdf.sort_values([*BLOCK_PAIR, "side"])
        hit = np.zeros(len(pdf), bool)
        for i, j in pairs_to_confirm(pdf, bounds):
            hit[i] = hit[j] = True
        return pdf.loc[hit].drop(columns="bin")

    return run


def _links(bounds, percent):
    """A spanning forest of the confirmed links between the components of some block pairs."""

    def run(pdf):
        pdf = pdf.sort_values([*BLOCK_PAIR, "side"])
        sets = [np.frombuffer(x, np.uint64) for x in pdf["shingles"]]
        node, comp = pdf["node"].to_numpy(), pdf["component"].tolist()
        joined, found = {}, []

        def root(c):
            while c != (up := joined.get(c, c)):
                joined[c] = joined.get(up, up)
                c = up
            return c

        for left, right in pairs_to_confirm(pdf, bounds):
            for i, j in zip(left.tolist(), right.tolist()):
                a, b = root(comp[i]), root(comp[j])
                if a != b and linked(sets[i], sets[j], percent):
                    found.append((node[i], node[j]))
                    joined[max(a, b)] = min(a, b)
        return type(pdf)(found, columns=["a", "b"]).astype("int64")

    return run


def _dealt(blocks: DataFrame, bins: float | None) -> GroupedData:
    """Whole block pairs dealt over so many groups, each a task's share, since most are too small for a call of their own."""
    count = max(1, math.ceil(bins or 0))
    return blocks.withColumn("bin", F.pmod(F.xxhash64(*BLOCK_PAIR), F.lit(count))).repartition(count, "bin").groupBy("bin")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` per row of ``docs(doc_id, text)``.

    Links documents whose ``shingle``-word sets have ``100 * intersection >= percent * union``;
    the smallest id of a component is kept.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bounds = least_matches(percent / 100)
    signed = stored(docs.mapInArrow(_sign(shingle), SIGNED), "signed")
    classes = signed.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("node"))
    classes = stored(classes, "classes")

    firsts = signed.join(classes.hint("shuffle_hash"), (signed.digest == classes.digest) & (signed.doc_id == classes.node), "left_semi")
    firsts = stored(firsts.select(F.col("doc_id").alias("node"), "n_shingles", "bands", "signature"), "firsts")
    banded = firsts.select("node", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    members = stored(banded.join(buckets.hint("merge"), "key"), "members")
    signatures = firsts.select("node", "signature")
    live = members.select("node").distinct()
    texts = docs.join(live.hint("shuffle_hash"), docs.doc_id == live.node, "left_semi")
    sets = stored(texts.mapInArrow(_sets(shingle), "node long, shingles binary"), "sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """The pairs ``(a, b)`` that are links."""
        pruned = (
            pairs.join(signatures.select(F.col("node").alias("b"), F.col("signature").alias("sig_b")), "b")
            .join(signatures.select(F.col("node").alias("a"), F.col("signature").alias("sig_a")), "a")
            .mapInPandas(_prune(bounds), "a long, b long")
        )
        return (
            pruned.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b")
            .join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a")
            .mapInPandas(_confirm(percent), "a long, b long")
        )

    def with_components(links: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Members with their components, and the buckets that hold more than one."""
        found = components(links)
        mapped = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        mapped = stored(mapped.select("key", "node", "low", "high", "component"), "mapped")
        open_keys = mapped.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1"))
        return mapped, open_keys.where("c0 < c1").select("key")

    smallest = members.groupBy("node").agg(F.min("low").alias("a")).where("a < node").select("a", F.col("node").alias("b"))
    several = signed.where("digest IS NOT NULL").groupBy("doc_id").agg(F.min("digest").alias("d0"), F.max("digest").alias("d1"))
    repeated = (
        signed.select("doc_id", "digest").join(several.where("d0 <> d1").select("doc_id"), "doc_id", "left_semi")
        .join(classes, "digest").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    )
    links = stored(confirmed(smallest).unionByName(repeated), "confirmed")
    mapped, open_keys = with_components(links)
    rest = mapped.join(open_keys, "key", "left_semi")
    largest = rest.groupBy("node").agg(F.max("high").alias("a")).where("a > node").select("a", F.col("node").alias("b"))
    links = stored(links.unionByName(confirmed(largest)), "confirmed")
    mapped, open_keys = with_components(links)
    links = links.unionByName(_sweep(mapped.join(open_keys, "key", "left_semi"), firsts, sets, bounds, percent))

    found = components(links)
    named = signed.select("doc_id", "n_shingles", "digest").join(classes, "digest", "left").join(found, "node", "left")
    component = F.coalesce("component", "node", "doc_id")
    return named.select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"),
    )


def _sweep(open_members: DataFrame, firsts: DataFrame, sets: DataFrame, bounds, percent: int) -> DataFrame:
    """Links between different components that still share a bucket: every such pair is tested."""
    sizes = open_members.groupBy("key", "component").agg(F.count("*").alias("_n"))
    small = F.when(F.col("_n") <= BLOCK, F.col("_n"))
    dealt = sizes.groupBy("key").agg(F.ceil(F.coalesce(F.sum(small), F.lit(0)) / BLOCK).alias("_groups"))
    sizes = sizes.join(dealt, "key").select("key", "component", "_n", "_groups")
    # a hot component of a bucket is dealt over blocks of its own, the small ones share blocks
    placed = sized_join(open_members.select("key", "node", "component"), stored(sizes, "sizes"), ["key", "component"], hot=F.col("_n") > HOT)
    own = F.xxhash64("component", F.pmod(F.xxhash64("node"), F.ceil(F.col("_n") / BLOCK)))
    shared = F.pmod(F.xxhash64("component"), F.greatest("_groups", F.lit(1)))
    ranked = stored(placed.select("key", "node", "component", F.when(F.col("_n") > BLOCK, own).otherwise(shared).alias("block")), "ranked")
    blocks = ranked.groupBy("key", "block").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.count("*").alias("_n"))
    left = blocks.select("key", F.col("block").alias("bi"), F.col("c0").alias("l0"), F.col("c1").alias("l1"), F.col("_n").alias("ln"))
    right = blocks.select("key", F.col("block").alias("bj"), F.col("c0").alias("r0"), F.col("c1").alias("r1"), F.col("_n").alias("rn"))
    mixed = left.join(right, "key").where("bi <= bj AND NOT (l0 = l1 AND r0 = r1 AND l0 = r0)")
    mixed = stored(mixed.select(*BLOCK_PAIR, "ln", "rn"), "mixed")
    work = F.sum(F.greatest((F.col("ln") + F.col("rn")) / BIN_ROWS, F.col("ln") * F.col("rn") / BIN_PAIRS))
    bins = mixed.agg(work).first()[0]
    mixed = mixed.select(*BLOCK_PAIR)
    sides = ranked.join(mixed.withColumn("block", F.col("bi")).hint("merge"), ["key", "block"]).withColumn("side", F.lit(0)).unionByName(
        ranked.join(mixed.where("bi < bj").withColumn("block", F.col("bj")).hint("merge"), ["key", "block"]).withColumn("side", F.lit(1))
    )
    sides = sides.drop("block").join(firsts, "node")
    fields = [*BLOCK_PAIR, "side", "node", "component", "n_shingles", "signature", "bands"]
    sides = sides.select(*fields)
    hits = stored(_dealt(sides, bins).applyInPandas(_candidates(bounds), sides.schema), "hits")
    bins = hits.agg(F.sum(1 / F.lit(BIN_ROWS) + F.col("n_shingles") / BIN_VALUES)).first()[0]
    return _dealt(hits.join(sets.hint("merge"), "node"), bins).applyInPandas(_links(bounds, percent), "a long, b long")
