"""What each filter removes, in every order in which the filters could be applied.

Every document gets a mask of the filters it fails. Per part the masks are counted, and the counts become a decision
diagram: one level per filter, the low edge for texts that pass it, the high edge for those that fail. Equal
sub-diagrams are one node, every node knows the counts below it, and what holds no document is one empty node. A walk through
all orders changes two neighbouring filters at a time (Steinhaus, Johnson and Trotter), which swaps two adjacent levels of the
diagram. In each order the path of low edges from the top is what the filters keep, step by step; the high edges that leave
it are what each step removes.

Repeats are found without moving texts: the smallest id of each text digest is a grouped minimum, and a row is compared with
it by digest and id together, so thousands of copies of one text are never gathered in a task. One part's diagram has
at most 32 masks, whatever the part's size.

Defined results: a null text is empty; a null part is the part ``''``; a null id is never a repeat, makes none and has
no labels; rows that repeat
an id and its text are not repeats of each other; of several label rows of one id any positive one counts; an empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import pairwise

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterlens.llm.storage import stored

#: The filters, in the order of their bits.
FILTERS = "ABCDE"
SPACES = r"[\x20\x09-\x0D]+"
MEASURES = ("n", "good", "toxic")
NOTHING = (0,) * len(MEASURES)


def base_mask(text: Column) -> Column:
    """Bits 0 to 3: too few words, repetitive, too many capitals, symbols."""
    words = F.array_remove(F.split(text, SPACES, -1), "")
    n_words, n_distinct = F.size(words), F.size(F.array_distinct(words))
    n_chars = F.length(text)
    n_capitals = n_chars - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    fails = [n_words < 200, 100 * n_distinct < 50 * n_words, 100 * n_capitals > 2 * n_chars, F.rlike(text, F.lit("[#$%&*|]"))]
    return sum((F.when(fail, 1 << bit).otherwise(0) for bit, fail in enumerate(fails)), F.lit(0))


def masks(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents per part and set of failed filters."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        base_mask(text).cast("int").alias("base"),
    )
    rows = stored(rows, "masks")  # read twice; a few dozen bytes a text
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("_first", F.lit(True))
    marked = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    repeat = F.col("_first").isNull() & F.col("doc_id").isNotNull()
    judged = rows.join(first, ["digest", "doc_id"], "left").join(marked, "doc_id", "left")
    judged = judged.withColumn("mask", F.col("base") + F.when(repeat, 16).otherwise(0))
    return judged.groupBy("part", "mask").agg(
        F.count("*").alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("good", "toxic")]
    )


class Diagram:
    """A count-weighted, shared decision diagram over ``FILTERS`` in a changeable order.

    A node is a number; its level follows from where it is met. ``low``, ``high`` and ``weight`` hold its children and
    the counts below it; terminals have no children. Node 0 stands for no documents at any level.
    """

    def __init__(self, counts: dict[int, tuple]):
        self.low, self.high, self.weight, self.known = [0], [0], [NOTHING], {}
        self.order = list(range(len(FILTERS)))
        self.root = self._build(counts, 0, 0)

    def _node(self, low: int, high: int) -> int:
        if not low and not high:
            return 0
        return self._new((low, high), low, high, tuple(map(sum, zip(self.weight[low], self.weight[high]))))

    def _new(self, key, low: int, high: int, weight: tuple) -> int:
        found = self.known.get(key)
        if found is None:
            found = self.known[key] = len(self.weight)
            self.low.append(low)
            self.high.append(high)
            self.weight.append(weight)
        return found

    def _build(self, counts: dict[int, tuple], level: int, mask: int) -> int:
        if level == len(FILTERS):
            weight = counts.get(mask, NOTHING)
            return self._new(("terminal", weight), 0, 0, weight) if any(weight) else 0
        return self._node(self._build(counts, level + 1, mask), self._build(counts, level + 1, mask | 1 << self.order[level]))

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the next one."""
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]
        done: dict[int, int] = {}

        def rebuilt(node: int, above: int) -> int:
            if not node:
                return 0
            if (node, above) not in done:
                low, high = self.low[node], self.high[node]
                if above:
                    out = self._node(rebuilt(low, above - 1), rebuilt(high, above - 1))
                else:
                    out = self._node(
                        self._node(self.low[low], self.low[high]), self._node(self.high[low], self.high[high])
                    )
                done[node, above] = out
            return done[node, above]

        self.root = rebuilt(self.root, level)

    def steps(self) -> list[tuple]:
        """``(filter, weight kept, weight removed)`` along the path of texts that pass everything so far."""
        out, node = [], self.root
        for which in self.order:
            out.append((FILTERS[which], self.weight[self.low[node]], self.weight[self.high[node]]))
            node = self.low[node]
        return out


@cache
def adjacent_swaps(n: int) -> tuple[int, ...]:
    """The places to swap, one after the other, to walk through all orders of ``n`` things."""
    if n < 2:
        return ()
    orders = [[]]
    for thing in range(n):
        longer = []
        for i, order in enumerate(orders):
            places = range(thing, -1, -1) if i % 2 == 0 else range(thing + 1)
            longer += [[*order[:at], thing, *order[at:]] for at in places]
        orders = longer
    return tuple(next(k for k in range(n) if a[k] != b[k]) for a, b in pairwise(orders))


def audit(counts: dict[int, tuple]) -> Iterator[tuple]:
    """Rows ``(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)`` of one part."""
    diagram = Diagram(counts)
    walked = [("".join(FILTERS[i] for i in diagram.order), diagram.steps())]
    for place in adjacent_swaps(len(FILTERS)):
        diagram.swap(place)
        walked.append(("".join(FILTERS[i] for i in diagram.order), diagram.steps()))
    fails, unique, shapley = {}, {}, dict.fromkeys(FILTERS, 0)
    for _, steps in walked:
        fails[steps[0][0]] = steps[0][2][0]  # nothing is removed before the first step
        unique[steps[-1][0]] = steps[-1][2][0]  # all others have passed before the last one
        for which, _, removed in steps:
            shapley[which] += removed[0]
    for order, steps in walked:
        for step, (which, kept, removed) in enumerate(steps, 1):
            yield (order, step, kept[0], removed[0], fails[which] - removed[0], unique[which], removed[1], removed[2], shapley[which])


AUDIT_SCHEMA = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)
_COLUMNS = [field.split()[0] for field in AUDIT_SCHEMA.split(", ")]


def _audit_parts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for part, cells in zip(frame["part"], frame["cells"]):
            counts = {c["mask"]: tuple(int(c[m]) for m in MEASURES) for c in cells}
            yield pd.DataFrame([(part, *row) for row in audit(counts)], columns=_COLUMNS)


def interactions(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """One row per part, order of the filters and step."""
    cells = masks(docs, labels, part).groupBy("part").agg(F.collect_list(F.struct("mask", *MEASURES)).alias("cells"))
    return cells.mapInPandas(_audit_parts, AUDIT_SCHEMA)
