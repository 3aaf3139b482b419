"""Merkle manifest, filter audit and decontamination against plain Python, and their edge cases."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatterlens.llm import decontaminate as DC
from chatterlens.llm import filter_audit as FA
from chatterlens.llm import merkle as MK
from chatterlens.llm import queries as Q

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- Merkle manifest ---------------------------------------------------------------------


def written(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, added=0):
    n_chars = row[4] if row[4] is None else row[4] + added
    return sha("".join(map(written, (row[0], row[3], row[2], n_chars, row[1]))))


def tree(leaves):
    """The root, and for each leaf its siblings and the nodes' positions, level by level."""
    paths, nodes = [[] for _ in leaves], [(h, [i]) for i, h in enumerate(leaves)]
    while len(nodes) > 1:
        above = []
        for at in range(0, len(nodes), 2):
            run = nodes[at: at + 2]
            for k, (_, members) in enumerate(run):
                others = [h for j, (h, _) in enumerate(run) if j != k]
                for m in members:
                    paths[m].append((k, others))
            above.append((sha("".join(h for h, _ in run)), sum((m for _, m in run), [])))
        nodes = above
    return nodes[0][0], paths


def folded(leaf, path):
    for k, others in path:
        leaf = sha("".join([*others[:k], leaf, *others[k:]]))
    return leaf


def plain_manifest(rows):
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    parts = {lang: sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))) for lang in langs}
    trees = {lang: tree([leaf_of(r) for r in parts[lang]]) for lang in langs}
    root, top = tree([trees[lang][0] for lang in langs])
    out = []
    for lang, upper in zip(langs, top):
        for row, path in zip(parts[lang], trees[lang][1]):
            way = [*path, *upper]
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            end = folded(leaf_of(row, int(tampered)), way)
            out.append((row[0], leaf_of(row), trees[lang][0], root, sha("".join(h for _, others in way for h in others)), end, end == root))
    return sorted(out, key=repr)


def audited(spark, rows):
    changed = F.coalesce(Q.remainder(7) == 0, F.lit(False))
    frame = spark.createDataFrame(rows, DOCS).repartition(3)
    # names of inner columns in the table must not disturb
    frame = frame.withColumns({c: F.lit(1) for c in ("key", "place", "digest", "n", "root", "leaf", "witness", "_row")})
    return sorted((tuple(r) for r in MK.audited(frame, changed).collect()), key=repr)


def some_rows(n, seed=0):
    rng = random.Random(seed)
    langs = [None, "", "en", "en", "en", "zhé", "-"]
    return [(i * 3, rng.choice([None, "", f"text {i} é\U0001f600"]), rng.choice(langs), rng.choice([None, "s"]), rng.choice([None, 9, 99])) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 3, 70])
def test_manifest_equals_plain_tree(spark, n):
    rows = some_rows(n)
    assert audited(spark, rows) == plain_manifest(rows)


def test_manifest_with_nulls_and_repeats(spark):
    rows = [*some_rows(9), *some_rows(9)[:4], (None, "a", "en", None, 1), (None, "a", "en", None, 1), (None, None, None, None, None)]
    rows += [(5, "one", "en", "s", 3), (5, "two", "en", "s", 3)]
    assert audited(spark, rows) == plain_manifest(rows)
    assert audited(spark, []) == []


def test_many_rounds(spark, monkeypatch):
    """Small blocks, so that roots of roots are appended several times; tested on nodes, in the driver's process."""
    monkeypatch.setattr(MK, "LEVELS", 2)
    monkeypatch.setattr(MK, "BLOCK", 4)
    import pyarrow as pa

    def local_link(leaves):
        schema = pa.schema([("key", pa.string()), ("place", pa.int64()), ("digest", pa.binary()), ("n", pa.int64())])
        batch = pa.RecordBatch.from_pylist([{"key": "k", "place": i, "digest": d, "n": len(leaves)} for i, d in enumerate(leaves)], schema)
        rows = [r for out in MK.append_blocks(iter([batch.slice(0, 5), batch.slice(5)])) for r in out.to_pylist()]
        if len(leaves) <= MK.BLOCK:
            return [(r["witness"], r["root"]) for r in rows]
        upper = local_link([r["root"] for r in rows if r["place"] % MK.BLOCK == 0])
        return [(r["witness"] + upper[r["place"] // MK.BLOCK][0], upper[r["place"] // MK.BLOCK][1]) for r in rows]

    for n in [1, 4, 5, 17, 64, 65, 67, 130]:
        leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
        root, paths = tree([h.hex() for h in leaves])
        for leaf, (witness, found), path in zip(leaves, local_link(leaves), paths):
            assert found.hex() == root == MK.fold(leaf, witness).hex()
            assert MK.proof(witness).decode() == "".join(h for _, others in path for h in others)


# ---- filter audit ------------------------------------------------------------------------


def mask_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    fails = [
        len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
        bool(re.search("[#$%&*|]", text)),
    ]
    return sum(1 << i for i, f in enumerate(fails) if f)


def plain_audit(docs, labels):
    smallest = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            smallest[text or ""] = min(doc_id, smallest.get(text or "", doc_id))
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    rows = [
        (source or "", mask_of(text or "") + (16 if doc_id is not None and doc_id > smallest[text or ""] else 0), doc_id in good, doc_id in toxic)
        for doc_id, text, source in docs
    ]
    out = []
    for part in sorted({r[0] for r in rows}):
        own, shapley, steps = [r for r in rows if r[0] == part], Counter(), []
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                bit = 1 << "ABCDE".index(f)
                gone, kept = [r for r in left if r[1] & bit], [r for r in left if not r[1] & bit]
                fails = sum(bool(r[1] & bit) for r in own)
                shapley[f] += len(gone)
                steps.append((part, "".join(order), step, len(kept), len(gone), fails - len(gone), sum(r[1] == bit for r in own),
                              sum(r[2] for r in gone), sum(r[3] for r in gone), f))
                left = kept
        out += [(*s[:-1], shapley[s[-1]]) for s in steps]
    return sorted(out)


def audit_of(spark, docs, labels):
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumns({c: F.lit(7) for c in ("mask", "part", "n", "digest", "base", "good", "toxic")})
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return sorted(tuple(r) for r in FA.interactions(frame.repartition(3), marked).collect())


def test_audit_equals_every_order_applied(spark):
    rng = random.Random(3)
    long = " ".join(f"w{i}" for i in range(250))
    texts = [None, "", "  \t ", "short", "A B C", long, long + " #", long.upper(), "same " * 300, "same " * 300 + "|", long + " x", "É   a"]
    docs = [(i if i % 17 else None, rng.choice(texts), rng.choice([None, "", "a", "b"])) for i in range(150)]
    docs += [docs[5], docs[5], (3, "twice", "a"), (3, "twice", "b"), (2, "twice", "b")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 150, 2)] + [(4, 1, 1), (None, 1, 1)]
    assert audit_of(spark, docs, labels) == plain_audit(docs, labels)


def test_audit_of_nothing(spark):
    assert audit_of(spark, [], []) == []


def test_diagram_is_the_same_in_every_order():
    """However it is reached by swaps, a diagram equals the one built in that order, shares nodes and keeps its counts."""
    rng = random.Random(1)
    counts = {m: (rng.randrange(1, 4), 0, 1) for m in rng.sample(range(32), 13)}
    diagram, seen = FA.Diagram(counts), set()
    for place in (None, *FA.adjacent_swaps(5)):
        if place is not None:
            diagram.swap(place)
        seen.add(tuple(diagram.order))
        assert diagram.weight[diagram.root] == tuple(map(sum, zip(*counts.values())))
        passed = dict(counts)
        for which, (_, kept, removed) in zip(diagram.order, diagram.steps()):
            gone = [w for m, w in passed.items() if m >> which & 1]
            passed = {m: w for m, w in passed.items() if not m >> which & 1}
            assert removed == (tuple(map(sum, zip(*gone))) if gone else FA.NOTHING)
            assert kept == (tuple(map(sum, zip(*passed.values()))) if passed else FA.NOTHING)
    assert len(seen) == 120 and len(diagram.weight) == len(set(diagram.known)) + 1
    flat = FA.Diagram(dict.fromkeys(range(32), (1, 1, 1)))
    assert len(flat.weight) == 7  # one node a level


# ---- decontamination ---------------------------------------------------------------------

WORDS = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def words_of(text):
    return WORDS.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain_leaks(docs, items):
    out = []
    for doc_id, text in docs:
        words, hit, found = words_of(text), set(), set()
        for item_id, item in items:
            said = words_of(item)
            size = min(len(said), 10)
            windows = {tuple(said[i: i + size]) for i in range(len(said) - size + 1)} if said else set()
            for at in range(len(words) - size + 1):
                if tuple(words[at: at + size]) in windows:
                    hit |= set(range(at, at + size))
                    found.add("" if item_id is None else str(item_id))
        out.append((doc_id, len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return sorted(out, key=repr)


def corpus(seed=0):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "Ä", "né", "7x", "the", "dog's", "日本", "x_y"]
    items = [(i, " ".join(rng.choices(vocabulary, k=n))) for i, n in enumerate([40, 10, 9, 3, 1, 0, 25, 12])]
    items += [(3, "another text of an id"), (None, "no id here at all but ten words or more yes"), (11, None), (10, items[0][1]), (12, "of an id")]
    docs = []
    for i in range(60):
        parts = [" ".join(rng.choices(vocabulary + ["zz", "q"], k=rng.randrange(30))) for _ in range(3)]
        if i % 3 == 0:
            said = rng.choice(items)[1] or ""
            parts.insert(rng.randrange(3), said.upper() if i % 2 else said[: rng.randrange(len(said) + 1)])
        docs.append((i % 50, ",\n".join(parts)))
    return [*docs, (100, None), (101, ""), (102, " .,; "), (None, items[1][1]), (103, " ".join([items[0][1]] * 30)), *docs[:2]], items


@pytest.mark.parametrize("block_bytes", [1 << 20, 100])
def test_leaks_equal_every_window_compared(spark, block_bytes):
    docs, items = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"n_words": F.lit(1), "_row": F.lit("x"), "more": F.lit(2)})
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = DC.summary(DC.find(frame.repartition(4), benchmark, block_bytes=block_bytes))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_leaks(docs, items)


def test_nothing_against_nothing(spark):
    docs, items = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(not r.contaminated and r.n_items == 0 for r in DC.summary(DC.find(frame, none)).collect())
    assert DC.summary(DC.find(frame.limit(0), spark.createDataFrame(items, "item_id long, text string"))).count() == 0


def test_only_affected_documents_go(spark):
    docs, items = corpus(2)
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("odd name, of a column", F.lit(1)).withColumn("items", F.lit("mine"))
    kept = DC.decontaminate(frame, spark.createDataFrame(items, "item_id long, text string"))
    clean = {r[0] for r in plain_leaks(docs, items) if not r[5]}
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == clean
    assert {r["items"] for r in kept.collect()} == {"mine"}


def test_longest_matches_and_their_places(spark):
    docs, items = corpus(1)
    docs = [(i, t) for i, (_, t) in enumerate(docs)]
    benchmark = spark.createDataFrame(items[:2], "item_id long, text string")
    found = {(r.item_id, r.item_word): (r.length, r.doc_id, r.doc_word) for r in DC.longest_matches(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3), benchmark, least=4).collect()}
    wanted = {}
    for item_id, text in items[:2]:
        said = words_of(text)
        for s in range(len(said)):
            best = 0
            for doc_id, other in docs:
                words = words_of(other)
                for at in range(len(words)):
                    n = 0
                    while s + n < len(said) and at + n < len(words) and said[s + n] == words[at + n]:
                        n += 1
                    if n > best:
                        best = n
            if best >= 4:
                wanted[str(item_id), s] = best
    assert {k: v[0] for k, v in found.items()} == wanted
    for (item_id, s), (length, doc_id, at) in found.items():
        assert words_of(items[int(item_id)][1])[s: s + length] == words_of(docs[doc_id][1])[at: at + length]


@pytest.mark.parametrize("depth", [1, 2, 3, 7, 100])
def test_suffix_array(depth):
    rng = np.random.default_rng(depth)
    words = rng.integers(0, 5, 300).astype(np.int32)
    words[50:90] = words[150:190]
    order = DC.suffix_array(words, depth)
    assert sorted(order) == list(np.flatnonzero(words > DC.UNKNOWN))

    def prefix(at):
        out = []
        for w in [*words, 0][at: at + depth]:
            out.append(w if w > DC.UNKNOWN else 0)
            if w <= DC.UNKNOWN:
                break
        return out

    found = [prefix(at) for at in order]
    assert found == sorted(found)


def test_shards_cut_inside_a_document(monkeypatch):
    """Whatever the size of a shard, the same words are hit."""
    docs, items = corpus(4)
    known = DC.Items([str(i) for i, _ in items], [t or "" for _, t in items])
    import pyarrow as pa

    data, offsets = DC.textnum.buffers(pa.array([t or "" for _, t in docs], pa.large_string()).cast(pa.large_binary()))
    usual = DC.scan_texts(known, data[: offsets[-1]], offsets)
    for size in (1, 7, 50, 400):
        monkeypatch.setattr(DC.shards, "__defaults__", (size,))
        found = DC.scan_texts(known, data[: offsets[-1]], offsets)
        assert (found[0] == usual[0]).all() and found[1] == usual[1] and [sorted(f) for f in found[2]] == [sorted(f) for f in usual[2]]
