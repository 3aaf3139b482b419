"""The operators on small tables: brute force, empty tables, nulls, repeated rows, clashing columns."""

import hashlib
import math
import random
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatterlens.llm import chat_format, kneser_ney, language_id, near_dedup, packing, pii, piece_bpe, quality_rules, topk, toxicity
from chatterlens.llm.queries import byte_tokenizer, tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, kept string, n_words string"
ODD = [(None, "no id at all", None, None), (1, None, "en", "s"), (2, "", "en", "s"), (3, " \n\t", None, "s"), (4, "x" * 3000, "en", "s"),
       (4, "x" * 3000, "en", "s"), (5, "mail a.b@c.example.org or +1 (209) 555-5975, 10.0.0.1, 4111 1111 1111 1111.", "en", "t"),
       (6, "word " * 2000, "de", "t"), (7, "123 456", "de", None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, g, s, 0, "clash", "clash", "clash") for i, t, g, s in ODD], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("block", [near_dedup.BLOCK, 3])
def test_near_duplicates(spark, odd, none, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rng = random.Random(5)
    rows, number = [], 100
    for _ in range(12):
        base = [str(rng.randint(0, 10**6)) for _ in range(40)]
        for copy in range(12):
            words = base[:]
            for _ in range(rng.randint(0, 5)):
                words[rng.randrange(40)] = str(rng.randint(0, 10**6))
            rows.append((number, " ".join(words)))
            number += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd.select("doc_id", "text"))
    found = near_dedup.near_duplicates(docs, shingle=2, percent=80).collect()
    sets = {}
    for r in docs.collect():
        w = (r.text or "").lower().split()
        if r.doc_id is not None:
            sets[r.doc_id] = {tuple(w[i: i + 2]) for i in range(max(1, len(w) - 1))} if w else set()
    root = {i: i for i in sets}
    def find(i):
        return i if root[i] == i else find(root[i])
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert len(found) == docs.count()
    for r in found:
        if r.doc_id is None:
            assert r.kept and r.component_id is None
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), find(r.doc_id), r.doc_id == find(r.doc_id))
    assert near_dedup.near_duplicates(none).count() == 0


def test_near_duplicates_test_a_pair_in_one_bucket_only(spark, monkeypatch):
    """Texts that share many buckets but are below the similarity: no pair is taken to its full sets twice."""
    kept, rows = {}, []

    def stored(df, name, store=near_dedup.stored):
        kept.setdefault(name, []).append(store(df, name))
        return kept[name][-1]

    monkeypatch.setattr(near_dedup, "stored", stored)
    for group in range(20):
        base = [f"g{group}w{i}" for i in range(60)]
        for copy in range(6):
            words = base[:]
            for i in range(2):
                words[7 * copy + 2 * i] = f"g{group}c{copy}i{i}"
            rows.append((6 * group + copy, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_dedup.near_duplicates(docs, shingle=2, percent=80).collect()
    assert len(found) == 120 and all(r.kept and r.component_id == r.doc_id for r in found)
    hits = kept["hits"][0].groupBy("key", "bi", "bj").agg(F.collect_set("node").alias("nodes")).collect()
    assert len(hits) > 1
    pairs = 20 * 15
    assert sum(len(h.nodes) for h in hits) <= 2 * pairs


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    out = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            good = {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                    "card": lambda: 12 <= len(d) <= 19 and luhn(d), "phone": lambda: 9 <= len(d) <= 15}[kind]()
            if good:
                out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_personal_data(spark, odd, none):
    rng = random.Random(2)
    bits = ["a@b.co", "x_y@z", "1.2.3.4", "256.1.1.1", "001.2.3.004.5", "4111-1111-1111-1111", "4111 1111 1111 1112", "+49 (30) 1234-567", "+1", "é", "😀", " ",
            ".", "@", "-", "_", "0", "12", "+1234567890123456", "a.b", "1" * 25]
    made = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 9))) for _ in range(800)] + ["1." * 3000, "a" * 60000, "a@b." * 2000, "+1" + "(" * 5000]
    docs = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(made)], "doc_id long, text string").unionByName(odd.select("doc_id", "text"))
    found = {(r.doc_id, r.text): r for r in pii.find(docs).withColumn("d", pii.digest(F.col("base"))).collect()}
    for (doc_id, text), r in found.items():
        assert r.d == base_spans(text), text
    assert pii.summary(pii.find(none)).count() == 0


def test_terms_that_reveal(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    rows = [(i, " ".join(word() for _ in range(60))) for i in range(300)]
    rows += [(1000 + i, f"{word()} {word()} zarnovian {word()} who@where.example.org {word()} common {word()}") for i in range(5)]
    rows += [(2000 + i, f"common {word()} {word()}") for i in range(200)] + [(3000, "zarnovian"), (3001, "a zarnovian of note")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n_chars long")
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    for i, t in rows:
        if 1000 <= i < 2000:
            assert "zarnovian" not in clean[i] and "who@" not in clean[i] and "<EMAIL>" in clean[i] and "common" in clean[i]
        else:
            assert clean[i] == t


def test_terms_of_whole_texts(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    filler = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, filler(60)) for i in range(300)]
    rows += [(1000 + i, f"Quimby {filler(60)} far@away.example.org {filler(60)}") for i in range(4)]  # a distant name
    rows += [(1100 + i, f"{filler(20)} Lee {filler(2)} +49 30 1234567") for i in range(4)]  # a name of three letters
    signature = f"{filler(12)} Zorander {filler(12)} desk@office.example.org {filler(12)}"
    rows += [(1200 + i, f"{filler(20)} {signature}") for i in range(40)]  # one window in many texts
    rows += [(1300 + i, f"Copyman wrote copy@paste.example.org ") for i in range(40)]  # copies are one text
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n_chars long")
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    for first, name, n in ((1000, "Quimby", 4), (1100, "Lee", 4), (1200, "Zorander", 40)):
        assert not any(name in clean[first + i].split() for i in range(n)), name
    assert all(clean[1300 + i] == "Copyman wrote <EMAIL> " for i in range(40))
    assert all(clean[i] == t for i, t in rows if i < 1000)


def test_packed(spark, odd, none):
    docs = odd.unionByName(spark.createDataFrame([(50, "a b c " * 4000, "en", "s", 0, "", "", "")], SCHEMA))
    rows = packing.pack(docs, byte_tokenizer(), keep_ids=True).collect()
    own = packing.encoder(*byte_tokenizer())
    places, texts = {}, {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length <= 4 * 2048
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    for doc_id in (1, 5, 50):
        mine = sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.piece)
        assert b"".join(r.ids for r in mine) == np.array([*own.slow(texts[doc_id] or ""), 0], np.uint32).tobytes()
    assert packing.pack(none, byte_tokenizer()).count() == 0


def test_pieces(odd, none):
    lib = piece_bpe.vocabulary(tokenizer("piece_bpe_32k.model")).library
    for r in piece_bpe.encode(odd, tokenizer("piece_bpe_32k.model")).join(odd.select("doc_id", "text").distinct(), "doc_id").collect():
        ids = lib.encode(r.text or "", add_eos=True)
        assert r.ids == ids and r.decoded == lib.decode(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert piece_bpe.encode(none, tokenizer("piece_bpe_32k.model")).count() == 0


def test_judges(spark, odd, none):
    for docs in (odd, none):
        judged = quality_rules.judge(docs).collect()
        assert len(judged) == docs.count() and all(not r.kept for r in judged if not (r.text or "").split())
        for model in (None, language_id.train(docs, F.lit(True))):
            rows = language_id.predict(docs, model).collect()
            assert all(r.lang_pred == "und" for r in rows if r.text in (None, "", "123 456")) and all(0 <= r.score <= 1 for r in rows)
        labels = spark.createDataFrame([(4, 1), (5, 0), (6, 0), (None, 1), (7, None)], "doc_id long, toxic int")
        rows = toxicity.predict(docs, toxicity.train(docs, labels, F.lit(True))).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
        rows = kneser_ney.judge(docs, labels.select("doc_id")).collect()
        assert len(rows) == docs.count() and all((r.perplexity is None) == (r.n_symbols == 0) and (r.kept or r.perplexity) for r in rows if r.n_symbols)


def test_sample_of_languages(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE", 5)
    rows = [(i, f"text {i}", "en" if i % 3 else "de") for i in range(400)] + [(7, "a repeat", "en")] * 3 + [(8, "x" * 30_000, "en"), (None, "x", "en"), (9, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    hashes = {r.id: r.h for r in spark.range(400).withColumn("h", F.xxhash64("id")).collect()}
    found = language_id.sample(docs, F.col("doc_id") % 2 == 0).collect()
    for lang, own in (("en", lambda i: i % 3), ("de", lambda i: not i % 3)):
        best = sorted((i for i in range(0, 400, 2) if own(i)), key=hashes.get)[:5]
        assert sorted(r.doc_id for r in found if r.lang == lang) == sorted(best)
    assert language_id.sample(docs, F.col("doc_id") == 7).select("text").collect() == [("a repeat",)]


def test_a_bad_host_takes_its_documents_along(spark):
    good = " ".join(f"word{i}" for i in range(30))
    rows = [(i, "short", "bad") for i in range(90)] + [(90 + i, good, "bad") for i in range(10)] + [(200 + i, good, f"h{i % 9}") for i in range(300)]
    kept = {r.doc_id for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).where("kept").collect()}
    assert kept == set(range(200, 500))


def test_a_null_host_is_not_the_empty_one(spark):
    good = " ".join(f"word{i}" for i in range(30))
    rows = [(i, "short", None) for i in range(200)] + [(200 + i, good, None) for i in range(5)]
    rows += [(300 + i, good, "") for i in range(30)] + [(400 + i, good, f"h{i % 9}") for i in range(300)]
    kept = {r.doc_id for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).where("kept").collect()}
    assert kept == {*range(300, 330), *range(400, 700)}


def test_junk_is_more_perplexing(spark):
    rng = random.Random(6)
    def text(letters):
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(60))
    rows = [(i, text("abcde"), "en") for i in range(300)] + [(1000 + i, text("xq#$%z"), "en") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    verdict = {r.doc_id: r.kept for r in kneser_ney.judge(docs, docs.where("doc_id < 200").select("doc_id")).collect()}
    assert not any(verdict[1000 + i] for i in range(20)) and sum(verdict[i] for i in range(300)) >= 285
    # probabilities over all symbols after a context add up to one
    two, one = 2 * kneser_ney.BITS, kneser_ney.BITS
    keys = spark.createDataFrame([((1 << one) | 1, 2), ((1 << one) | 2, 1), ((5 << two) | (1 << one) | 3, 3)], "gram long, count long")
    wanted = spark.range(kneser_ney.SYMBOLS).select((F.col("id") + F.lit((5 << two) | (1 << one))).alias("gram"))
    assert abs(kneser_ney.probabilities(keys, wanted).agg(F.sum(F.exp("logp"))).first()[0] - 1) < 1e-6


def kind_of(c):
    if c.isspace():
        return "space"
    if any(a <= ord(c) <= b for a, b in kneser_ney.UNSPACED) or ord(c) >= 0x20000:
        return "alone"
    if c.isalpha() or unicodedata.category(c)[0] == "M":
        return "letter"
    return "digit" if c in "0123456789" else "alone"


def slow_words(text):
    """Each word and the place where it begins."""
    out, last = [], None
    for i, c in enumerate(text or ""):
        c = c.lower() if len(c.lower()) == 1 else c
        kind = kind_of(c)
        shown = "0" if kind == "digit" else c
        if kind != "space":
            if kind == last and kind != "alone":
                out[-1][0] += shown
            else:
                out.append([shown, i])
        last = kind
    return out


def slow_kneser_ney(rows, trusted):
    """Perplexity and fresh share by dictionaries, straight from the definition."""
    def symbols(text):
        low = (c.lower() if len(c.lower()) == 1 else c for c in text or "")
        return [" " if c.isspace() else "0" if kind_of(c) == "digit" else c for c in low]

    def grams(text):
        w = ["", "", *symbols(text)]
        return [tuple(w[i: i + 3]) for i in range(len(w) - 2)]

    learnt = [t for i, t, _ in rows if i in trusted and zlib.crc32(str(i).encode()) % kneser_ney.HELD_OUT]
    tables = {3: Counter(g for t in learnt for g in grams(t))}
    for n in (2, 1):
        tables[n] = Counter(g[1:] for g in tables[n + 1])

    def cuts(counts):
        n = [sum(c == k for c in counts.values()) for k in (1, 2, 3, 4)]
        if not all(n):
            return [0, 0.5, 0.75, 0.9]
        y = n[0] / (n[0] + 2 * n[1])
        return [0, *[min(max(k - (k + 1) * y * n[k] / n[k - 1], 0), k) for k in (1, 2, 3)]]

    cut = {n: cuts(t) for n, t in tables.items()}
    after = defaultdict(list)
    for t in tables.values():
        for g, c in t.items():
            after[len(g), g[:-1]].append(c)

    def probability(g):
        p = probability(g[1:]) if len(g) > 1 else 1 / kneser_ney.SYMBOLS
        d, n, seen = cut[len(g)], after[len(g), g[:-1]], tables[len(g)][g]
        return (seen - d[min(seen, 3)]) / sum(n) + sum(d[min(c, 3)] for c in n) / sum(n) * p if n else p

    for i, text, _ in rows:
        bits = [-math.log(probability(g)) for g in grams(text)]
        found, once, whole, last = slow_words(text), {}, 0, "<s>"
        for (word, at), end in zip(found, [*[at for _, at in found[1:]], len(bits)]):
            once.setdefault((last, word), sum(bits[at:end]))
            whole, last = whole + sum(bits[at:end]), word
        yield (i, len(bits), math.exp(sum(bits) / len(bits)) if bits else None, (sum(once.values()) / whole if whole else 1.0) if bits else None)


@pytest.mark.parametrize("blocks", [32 << 20, 1500])
def test_kneser_ney_by_dictionaries(spark, monkeypatch, blocks):
    monkeypatch.setattr(kneser_ney, "BLOCK_BYTES", blocks)
    rng = random.Random(9)
    some = ["the", "The", "of", "été", "e\u0301", "12", "7", "漢字", "a|b", "x😀", "long" * 40, "ภาษา", "ok.", "\n", "İz"]
    rows = [(i, " ".join(rng.choice(some[: rng.randint(2, 15)]) for _ in range(rng.randint(1, 40))), rng.choice(["en", "de", None, ""])) for i in range(120)]
    rows += [(200, None, "en"), (201, "", "en"), (202, " \n", None), (None, "the of the", "en"), (3, "the same id", "en"), (203, "the " * 3000, "en")]
    trusted = {*range(60), 200, 203}
    docs = spark.createDataFrame([(*r, 1.5) for r in rows], "doc_id long, text string, lang string, perplexity double").repartition(3)
    ids = spark.createDataFrame([(i,) for i in [*trusted, 5, 5, None, 999]], "doc_id long")

    def shown(found):
        return sorted(map(tuple, found), key=lambda r: [-1 if x is None else round(x, 3) for x in r])

    scored = kneser_ney.score(docs, ids).select("doc_id", "n_symbols", "perplexity", "fresh").collect()
    wanted = shown(slow_kneser_ney(rows, trusted))
    assert len(scored) == len(wanted)
    for mine, slow in zip(shown(scored), wanted):
        assert mine == tuple(x if x is None else pytest.approx(x, rel=1e-6, abs=2e-6) for x in slow)
    assert kneser_ney.judge(docs, ids).count() == len(rows)
    none = kneser_ney.judge(docs, ids.limit(0)).where("kept").count()
    assert none == sum(bool(t) for _, t, _ in rows)
    assert kneser_ney.judge(docs.limit(0), ids).count() == 0


def test_exploded_and_repetitive_tables_are_not_broadcast(spark, monkeypatch):
    """Spark sizes them by the table before it is exploded, or by its compressed file."""
    plans = defaultdict(list)

    def watched(module):
        def stored(df, name, store=module.stored):
            plans[name].append(df._jdf.queryExecution().executedPlan().toString())
            return store(df, name)

        monkeypatch.setattr(module, "stored", stored)

    watched(near_dedup)
    watched(pii)
    monkeypatch.setattr(pii, "BROADCAST_CHARS", 0)
    rng = random.Random(8)
    texts = [" ".join(["write", f"jo.doe{i % 2}@example.org", *(f"jodoe{'ab'[i % 2]}" for _ in range(2)), *(rng.choice("abcdefgh") * 5 for _ in range(30))]) for i in range(12)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(20, texts[0])], "doc_id long, text string")
    near_dedup.near_duplicates(docs)
    found = pii.find(docs)
    held = ["members", "judged", "strong"]
    plans["find"].append(found._jdf.queryExecution().executedPlan().toString())
    assert all("SortMergeJoin" in p and "BroadcastHashJoin" not in p for name in [*held, "find"] for p in plans[name])
    assert all(plans[name] for name in held) and found.where("exists(spans, s -> s.kind = 'term')").count() == 13


def test_repetition_goes(spark):
    rng = random.Random(6)
    nouns, verbs = [f"n{c}" for c in "abcdefghijklmnop"], [f"v{c}" for c in "abcdefghijklmnop"]

    def sentence():
        return " ".join(f"{rng.choice(nouns)} {rng.choice(verbs)}" for _ in range(40))

    clean = [(i, sentence()) for i in range(600)]
    repeated = [(2000 + i, f"{rng.choice(nouns)} {rng.choice(verbs)} " * 40) for i in range(50)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in clean + repeated], "doc_id long, text string, lang string")
    kept = {r.doc_id for r in kneser_ney.judge(docs, docs.where("doc_id < 400").select("doc_id")).where("kept").collect()}
    assert sum(i < 600 for i in kept) >= 580 and not any(i >= 1000 for i in kept)


def test_top_k(spark):
    rng = np.random.default_rng(3)
    vectors = [(i, [float(x) for x in rng.normal(size=6)], "x") for i in range(120)]
    vectors += [(200, None, "x"), (201, [1.0, None], "x"), (202, [float("nan")] * 6, "x"), (203, [float("inf")] * 6, "x"), (None, [1.0] * 6, "x"), (220, [0.5] * 6, "x"), (221, [0.5] * 6, "x")]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, score string")
    good = {i: np.floor(64 * np.array(v, np.float32).astype(float)).astype(int) for i, v, _ in vectors if i is not None and i not in (200, 201, 202, 203)}
    want = []
    for q in (i for i in good if i % 20 == 0):
        best = sorted((-int(good[q] @ v), i) for i, v in good.items() if i != q)[:20]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert sorted(map(tuple, topk.top_k(table, F.col("vec_id") % 20 == 0).collect())) == sorted(want)
    assert topk.top_k(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_candidates_are_dealt_over_slices(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 10)
    monkeypatch.setattr(topk, "SPREAD", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rng = np.random.default_rng(4)
        table = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=5)]) for i in range(400)], "vec_id long, embedding array<float>")
        found = topk.top_k(table.repartition(4), F.col("vec_id") % 20 == 0, 5)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(slice" in plan and "hashpartitioning(q_block" not in plan
        good = {r.vec_id: np.floor(64 * np.array(r.embedding, np.float32).astype(float)).astype(int) for r in table.collect()}
        want = []
        for q in range(0, 400, 20):
            best = sorted((-int(good[q] @ v), i) for i, v in good.items() if i != q)[:5]
            want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
        assert sorted(map(tuple, found.collect())) == sorted(want)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_repeated_queries_are_not_broadcast(spark, monkeypatch):
    """Spark sizes the query blocks by their stored table, though there is a copy for each slice."""
    plans, store = [], topk.stored
    for name, value in (("CANDIDATES", 10), ("SPREAD", 1)):
        monkeypatch.setattr(topk, name, value)
    monkeypatch.setattr(topk, "stored", lambda df, name: (plans.append(df._jdf.queryExecution().executedPlan().toString()), store(df, name))[1])
    table = spark.range(200).select(F.col("id").alias("vec_id"), F.array(F.rand(1), F.rand(2)).alias("embedding"))
    found = topk.top_k(table, F.col("vec_id") % 20 == 0, 5)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in p for p in plans) == 2 and not any("Broadcast" in p for p in plans)
    assert found.count() == 50


def test_chat(spark):
    rows = [(1, 1, "assistant", "a </s> \\ [INST]"), (1, 0, "user", None), (2, 0, "odd\nrole<|nl|>", "<|turn|>"), (2, 0, "odd\nrole<|nl|>", "<|turn|>"), (None, 0, None, "x")]
    table = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, segment string")
    segments = chat_format.format_turns(chat_format.turns_of_rows(table))
    for r in segments.collect():
        assert chat_format.read_segment(r.segment) == (r.role, r.text)
    found = {r.conv_id: r for r in chat_format.read_back(segments).collect()}
    assert found[1].turns_sha256 == hashlib.sha256("user\n\nassistant\na </s> \\ [INST]\n".encode()).hexdigest()
    assert (found[1].loss_chars, found[1].n_turns, found[2].n_turns, found[None].n_turns) == (15, 2, 2, 1)
    other = spark.createDataFrame([(5, 0, "human", "q"), (5, 1, "gpt", "said"), (5, 2, "model", "more")], "conv_id long, turn long, role string, text string")
    said = chat_format.read_back(chat_format.format_turns(chat_format.turns_of_rows(other))).first()
    assert said.turns_sha256 == hashlib.sha256(b"human\nq\ngpt\nsaid\nmodel\nmore\n").hexdigest()
    assert said.loss_sha256 == hashlib.sha256(b"saidmore").hexdigest() and said.loss_chars == 8
    records = spark.createDataFrame([(1, '{"prompt":"p","response":"r"}'), (2, "junk"), (3, None), (4, '{"z":1}')], "conv_id long, payload string")
    assert sorted((r.conv_id, r.turn, r.role) for r in chat_format.turns_of_records(records).where("turn IS NOT NULL").collect()) == [(1, 0, "user"), (1, 1, "assistant")]
    assert chat_format.read_back(chat_format.format_turns(chat_format.turns_of_rows(table.limit(0)))).count() == 0
