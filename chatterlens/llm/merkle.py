"""A Merkle manifest of a dataset, with a witness for every row.

A leaf is the digest of a row's fields. Leaves of one key (a language) are appended in the order of their ids, in aligned blocks of
``BLOCK`` leaves. Appending keeps a stack of open subtrees; every leaf below an open subtree holds a partial witness, the
siblings up to that subtree's root. When a later leaf completes the sibling of an open subtree, the two join and the
witnesses of both sides grow by one digest. What is left of a block is its root, and the roots of all blocks, however many
executors made them, are appended in the same way in the next round, until a key has one root; the keys' roots are the last tree.
A row's whole witness is its own part and those of its blocks, joined on the block, so no task holds more than a block.

Defined results: a null field is written ``-``; the null key comes first; null ids come first; rows that repeat an id are leaves
of their own, ordered by leaf; an empty table has no rows and no root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterlens.llm.storage import stored
from chatterlens.operators.joins import sized_join
from chatterlens.operators.sequence import with_global_index

LEVELS = 12
BLOCK = 1 << LEVELS
#: A step of a witness: where the sibling lies, then its digest (none: the node is raised alone).
ALONE, LEFT, RIGHT = b"\0", b"\1", b"\2"
SIZE = 32


def node(*children: bytes) -> bytes:
    """The digest of the children's digests, as lowercase hex text."""
    return hashlib.sha256(b"".join(children).hex().encode()).digest()


def steps(witness: bytes) -> Iterator[tuple[bytes, bytes]]:
    """``(side, digest)`` per level."""
    at = 0
    while at < len(witness):
        side = witness[at: at + 1]
        size = 0 if side == ALONE else SIZE
        yield side, witness[at + 1: at + 1 + size]
        at += 1 + size


def fold(leaf: bytes, witness: bytes) -> bytes:
    """The root that a leaf and its witness lead to."""
    for side, sibling in steps(witness):
        leaf = node(leaf) if side == ALONE else node(sibling, leaf) if side == LEFT else node(leaf, sibling)
    return leaf


def proof(witness: bytes) -> bytes:
    """The siblings' digests of all levels, as lowercase hex text."""
    return b"".join(digest for _, digest in steps(witness)).hex().encode()


class Appender:
    """One block, leaf by leaf: the open subtrees, and a partial witness for every leaf.

    An open subtree is ``(level, digest, first leaf)``; its leaves reach up to the next one's first.
    """

    def __init__(self):
        self.open: list[tuple[int, bytes, int]] = []
        self.witnesses: list[bytearray] = []

    def append(self, leaf: bytes) -> None:
        self.open.append((0, leaf, len(self.witnesses)))
        self.witnesses.append(bytearray())
        while len(self.open) > 1 and self.open[-2][0] == self.open[-1][0]:
            self._join()

    def _join(self) -> None:
        (level, left, first), (_, right, middle) = self.open[-2:]
        for witness in self.witnesses[first:middle]:
            witness += RIGHT + right
        for witness in self.witnesses[middle:]:
            witness += LEFT + left
        self.open[-2:] = [(level + 1, node(left, right), first)]

    def _raise(self) -> None:
        level, digest, first = self.open[-1]
        for witness in self.witnesses[first:]:
            witness += ALONE
        self.open[-1] = (level + 1, node(digest), first)

    def close(self, levels: int | None) -> bytes:
        """The root: of exactly ``levels`` levels, or, if None, as soon as one node is left."""
        while len(self.open) > 1:
            if self.open[-1][0] == self.open[-2][0]:
                self._join()
            else:
                self._raise()
        while levels is not None and self.open[-1][0] < levels:
            self._raise()
        return self.open[-1][1]


LINKED = "key string, place long, witness binary, root binary"
LINKED_ARROW = pa.schema([("key", pa.string()), ("place", pa.int64()), ("witness", pa.binary()), ("root", pa.binary())])


def append_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(key, place, digest, n)``, sorted by key and place, whole blocks only; ``n`` is the number of the key's rows."""
    held, block, work = [], None, Appender()

    def done() -> pa.RecordBatch:
        key, _, n = block
        root = work.close(LEVELS if n > BLOCK else None)
        columns = [pa.array([key] * len(held), pa.string()), pa.array(held, pa.int64())]
        columns += [pa.array(list(map(bytes, work.witnesses)), pa.binary()), pa.array([root] * len(held), pa.binary())]
        return pa.RecordBatch.from_arrays(columns, schema=LINKED_ARROW)

    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("key", "place", "digest", "n")]
        for key, place, digest, n in zip(*columns):
            if (key, place >> LEVELS, n) != block:
                if held:
                    yield done()
                held, block, work = [], (key, place >> LEVELS, n), Appender()
            held.append(place)
            work.append(digest)
    if held:
        yield done()


def link(nodes: DataFrame) -> DataFrame:
    """``(key, place, witness, root)`` for ``nodes(key, place, digest, n)``: the whole way up to the key's root.

    Each round shuffles the nodes by block and appends them; its block roots are the nodes of the next round, 1 of ``BLOCK``.
    """
    block = F.shiftright("place", LEVELS)
    dealt = nodes.repartition("key", block).sortWithinPartitions("key", "place")
    linked = stored(dealt.select("key", "place", "digest", "n").mapInArrow(append_blocks, LINKED), "witnesses")
    above = stored(nodes.where(F.col("n") > BLOCK).select("key", block.alias("block"), F.ceil(F.col("n") / BLOCK).cast("long").alias("n")).distinct(), "blocks")
    if above.isEmpty():
        return linked
    roots = linked.where(F.col("place").bitwiseAND(F.lit(BLOCK - 1)) == 0).select("key", block.alias("block"), F.col("root").alias("digest"))
    upper = link(stored(roots.join(above, ["key", "block"]).select("key", F.col("block").alias("place"), "digest", "n"), "roots"))
    upper = upper.select("key", F.col("place").alias("_block"), F.col("witness").alias("_witness"), F.col("root").alias("_root"))
    # at most BLOCK rows of a block meet its one row
    joined = linked.withColumn("_block", block).join(upper, ["key", "_block"], "left")
    whole = F.concat("witness", F.coalesce("_witness", F.lit(b"")))
    return joined.select("key", "place", whole.alias("witness"), F.coalesce("_root", "root").alias("root"))


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*fields: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(f) for f in fields]), 256))


def numbered(leaves: DataFrame) -> DataFrame:
    """``leaves`` with ``place`` and ``n``: the place among the rows of its key, and how many there are."""
    order = ["key", "doc_id", "leaf", "_at"]  # rows that are equal in all else are interchangeable
    indexed = with_global_index(leaves.withColumn("_at", F.monotonically_increasing_id()), order, "_row").drop("_at")
    keys = indexed.groupBy("key").agg(F.min("_row").alias("_first"), F.count("*").alias("n"))
    placed = sized_join(indexed, stored(keys, "keys"), ["key"])
    return placed.withColumn("place", F.col("_row") - F.col("_first")).drop("_row", "_first")


def manifest(docs: DataFrame, changed: Column) -> DataFrame:
    """``(doc_id, leaf, other, subroot, root, witness)`` per row of ``docs``; ``other`` is the leaf of ``changed`` rows, else null.

    ``changed`` marks rows whose ``n_chars`` is read one too high by the auditor.
    """
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    tampered = [F.col("n_chars") + 1 if c == "n_chars" else F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    key = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("-"))  # null before all others
    leaves = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), key.alias("key"), leaf(*fields).alias("leaf"), F.when(changed, leaf(*tampered)).alias("other")
    )
    placed = stored(numbered(stored(leaves, "leaves")), "placed")
    linked = link(placed.select("key", "place", F.col("leaf").alias("digest"), "n"))
    subroots = linked.where("place = 0").select(F.col("key").alias("_of"), F.col("root").alias("subroot"))
    last = stored(with_global_index(subroots, ["_of"], "place"), "subroots")
    n_keys = last.count()
    top = link(last.select(F.lit("").alias("key"), "place", F.col("subroot").alias("digest"), F.lit(n_keys).cast("long").alias("n")))
    top = top.select("place", F.col("witness").alias("_top"), F.col("root").alias("_root"))
    top = stored(last.join(top, "place").select(F.col("_of").alias("key"), "subroot", "_top", "_root"), "top")
    whole = sized_join(linked.drop("root"), top, ["key"])
    whole = whole.select("key", "place", "subroot", F.col("_root").alias("root"), F.concat("witness", "_top").alias("witness"))
    return placed.join(whole, ["key", "place"]).select("doc_id", "leaf", "other", "subroot", "root", "witness")


AUDIT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, *columns = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "leaf", "other", "subroot", "root", "witness")]
        rows = [c.to_pylist() for c in columns]
        folded = [fold(other or own, way) for own, other, way in zip(rows[0], rows[1], rows[4])]
        hexed = [[v.hex() for v in values] for values in (rows[0], rows[2], rows[3], folded)]
        proofs = [hashlib.sha256(proof(way)).hexdigest() for way in rows[4]]
        verified = [a == b for a, b in zip(folded, rows[3])]
        texts = [pa.array(v, pa.string()) for v in (*hexed[:3], proofs, hexed[3])]
        yield pa.RecordBatch.from_arrays([ids, *texts, pa.array(verified, pa.bool_())], [f.split()[0] for f in AUDIT.split(", ")])


def audited(docs: DataFrame, changed: Column) -> DataFrame:
    """Every row's leaf and roots, and whether its leaf, as the auditor reads it, leads to the root."""
    return manifest(docs, changed).mapInArrow(_check, AUDIT)
