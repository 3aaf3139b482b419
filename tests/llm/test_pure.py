"""The parts without Spark, against libraries and brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chatterlens.llm import chat_format, kneser_ney, language_id, near_dedup, packing, piece_bpe, quality_rules, textnum, topk, toxicity

P = pytest.importorskip("public_tokenizers")
CHARS = list("abcdeéßñ ▁ \n\t.,'!0123😀\x00\x85\xa0 　漢[<") + ["the", " ", "  ", "\n\n", "'s", "<|endoftext|>", "</s>", "[INST]", "\\"]


def texts(n, size=30):
    rng = random.Random(3)
    return ["".join(rng.choice(CHARS) for _ in range(rng.randint(0, size))) for _ in range(n)]


def columns(values):
    data = [v.encode() for v in values]
    return np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)


def test_pieces_as_the_library():
    own = piece_bpe.Vocabulary(P.path("piece_bpe_32k.model"))
    for text in [*texts(3000), "ab" * 4000, " " * 3000, "<s>a</s>"]:
        assert own.encode(text) == own.library.encode(text)
    for text in texts(500, 60):
        assert own._merged_heap("▁" + text) == own._merged_list("▁" + text)


def test_bytes_as_the_library():
    own = packing.Encoder(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    for text in [*texts(3000), "x" * 5000, "naïve " * 50]:
        assert np.frombuffer(own.ids(text), np.uint32).tolist() == own.slow(text)


def test_control_strings_as_the_plain_library():
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    own = packing.Encoder(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    added = [t.content for t in plain.get_added_tokens_decoder().values()]
    assert added
    for text in [*texts(2000), *[f"a{t}b" for t in added], *[f"{t}{t} 漢 {t}" for t in added], "<|endoftext", "<|ENDOFTEXT|>"]:
        assert np.frombuffer(own.ids(text), np.uint32).tolist() == plain.encode(text, add_special_tokens=False).ids, text


@given(st.text(alphabet=st.sampled_from("s>/<[]INST\\|ntur end\n"), max_size=40))
@settings(max_examples=300)
def test_escapes_are_reversible(text):
    import re
    escaped = re.sub(chat_format.ESCAPE, r"\1\2\\\3", text)
    assert chat_format.unescape(escaped) == text
    assert not any(c in escaped for c in (chat_format.TURN, chat_format.END, "</s>", "[INST]", "[/INST]"))


@pytest.mark.parametrize("record, turns", [
    ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None}], "id": 1}, [("user", "a"), ("assistant", "")]),
    ({"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]}, [("user", "h"), ("assistant", "g")]),
    ({"instruction": "i", "input": "x", "output": "o"}, [("user", "i\n\nx"), ("assistant", "o")]),
    ({"instruction": "i", "output": "o", "extra": {"deep": [1]}}, [("user", "i"), ("assistant", "o")]),
    ({"system": "s", "prompt": "p", "response": "r"}, [("system", "s"), ("user", "p"), ("assistant", "r")]),
    ({"unknown": 1}, []), ([1], []), ({}, []), (None, []),
])
def test_layouts(record, turns):
    assert chat_format.turns_of_record(record)[1] == turns


@pytest.mark.parametrize("histogram", [
    {}, {1: 5}, {2048: 3}, {700: 1000, 650: 500, 1400: 300}, {1024: 7, 1025: 3, 1: 2},
    dict(Counter(np.random.default_rng(0).integers(1, 2049, 3000).tolist())),
    dict(Counter(np.random.default_rng(1).integers(600, 1100, 3000).tolist())),
])
def test_packing_places_every_piece(histogram):
    plan, placed = packing.solve(histogram), Counter()
    for config, n in plan:
        assert sum(config) <= 2048
        for length in config:
            placed[length] += n
    assert placed == Counter(histogram)
    used = sum(n for _, n in plan)
    lengths = np.array(sorted(x for x in histogram if x < 2048), np.int64)
    heuristic = sum(packing.best_fit_decreasing(lengths, np.array([histogram[int(x)] for x in lengths]), 2048).values())
    assert used <= heuristic + histogram.get(2048, 0) + max(2, used // 500)
    assert used >= math.ceil(sum(k * n for k, n in histogram.items()) / 2048)
    runs = packing.runs(plan)
    assert sum(runs[:, 2]) == sum(histogram.values())


def test_cuts():
    assert packing.cuts(1, 2048) == [(0, 1)] and packing.cuts(2048, 2048) == [(0, 2048)]
    assert packing.cuts(4096, 2048) == [(0, 2048), (2048, 2048)] and packing.cuts(5000, 2048) == [(0, 904), (904, 2048), (2952, 2048)]


def test_measures():
    values = texts(300, 40) + ["a b c d e f g h " * 4, "", " ", "x\nx\nx \n\n\n", "w " * 30, "a b c d e f g h i a b c d e f g h"]
    found = quality_rules.measure_texts(*columns(values))
    for i, text in enumerate(values):
        words = text.encode().split()
        windows = Counter(tuple(words[j: j + 8]) for j in range(len(words) - 7))
        covered = {j + k for j in range(len(words) - 7) for k in range(8) if windows[tuple(words[j: j + 8])] > 1}
        lines = [x for x in text.split("\n") if x.encode().split()]
        want = (len(words), sum(len(w.decode()) for w in words), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))
        assert tuple(int(c[i]) for c in found) == want, text


def test_shingles():
    values = ["", " ", "One", "one two", "a b c a b c", "A\tb\x0bc", "x" * 200 + " y", "x" * 200 + " z"]
    for size in (2, 5):
        sets = textnum.shingle_sets(*columns(values), size)
        for text, found in zip(values, sets):
            words = text.lower().split()
            want = {tuple(words[i: i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()
            assert len(found) == len(want)
    assert not set(sets[-1]) & set(sets[-2])


def test_pruning_keeps_what_is_similar():
    bounds = near_dedup.least_matches(0.8)
    rng = np.random.default_rng(0)
    left = rng.integers(0, 256, (4000, near_dedup.HASHES), dtype=np.uint8)
    right = np.where(rng.random(left.shape) < 0.8, left, left + 1)
    assert near_dedup.alive(left, right, bounds).all()
    assert not near_dedup.alive(left, np.where(rng.random(left.shape) < 0.3, left, left + 1), bounds).any()


def test_kneser_ney_windows():
    keys, sizes = kneser_ney.grams(*textnum.code_points(*columns(["ab", "", "é1", "漢\t😀"])))
    assert sizes.tolist() == [2, 0, 2, 3] and len(keys) == 7 and keys[0] == ord("a") + 1
    assert keys[-1] == ((ord("漢") + 1) << 42) | (33 << 21) | (ord("😀") + 1)


def test_kneser_ney_words():
    values = ["Ab ab, AB12 345", "", " \n", "naïve ÉTÉ", "e\u0301t e\u0301t", "漢字漢", "a|b|", "ภาษา x", "x😀😀"]
    found, _, first = kneser_ney.words(*textnum.code_points(*columns(values)))
    assert np.diff(first).tolist() == [6, 0, 0, 2, 2, 3, 4, 5, 3]
    of = dict(enumerate(np.split(found, first[1:-1])))
    assert of[0][0] == of[0][1] == of[0][3] != of[0][4] and of[4][0] == of[4][1] and of[5][0] == of[5][2] != of[5][1]
    assert of[6][1] == of[6][3] and of[8][1] == of[8][2] and len(set(found.tolist())) == 17
    points, bounds = textnum.code_points(*columns(["a b a b a b", "a b", "", " ", "x", "a b c d"]))
    share = kneser_ney.fresh_share(points, bounds, np.ones(len(points)))
    assert np.allclose(share, [6 / 11, 1, 1, 1, 1, 1])  # the pairs "- a", "a b" and "b a"


def test_language_model_is_sparse_and_calibrated():
    rng = random.Random(0)
    make = {"xx": "abcde", "yy": "vwxyz"}
    rows = [(" ".join("".join(rng.choice(make[n]) for _ in range(4)) for _ in range(12)), n) for n in make for _ in range(60)]
    model = language_id.fit([t for t, _ in rows], [n for _, n in rows])
    assert (model.weights == 0).mean() > 0.5 and 0.05 <= model.heat <= 10
    counts, letters = language_id.features(*columns(["abcd bcde", "12 34", "", "zyx"]))
    p = language_id.softmax(language_id.normed(counts, model.idf) @ model.weights / model.heat)
    assert letters.tolist() == [True, False, False, True] and p[0].argmax() == 0 and p[3].argmax() == 1


@pytest.mark.parametrize("names", ["x", "xy", "xyz"])
def test_unlearned_languages_do_not_resemble(names):
    rng = random.Random(0)
    make = {"x": ["hause", "gehen", "strasse", "nicht", "schon"], "y": ["house", "going", "the", "with", "that"], "z": ["maison", "vous", "est", "alors", "quoi"]}
    text = lambda n: " ".join(rng.choice(make[n]) for _ in range(30))
    rows = [(text(n), n) for n in names for _ in range(100)]
    model = language_id.fit([t for t, _ in rows], [n for _, n in rows])

    def kept(made):
        x = language_id.normed(language_id.features(*columns(made))[0], model.idf)
        return model.resembles(x, model.probabilities(x)).mean()

    assert all(kept([text(n) for _ in range(100)]) >= 0.9 for n in names)
    for letters in ("abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуф", "漢字仮名交文日本語中国"):
        assert kept([" ".join("".join(rng.choice(letters) for _ in range(6)) for _ in range(30)) for _ in range(100)]) == 0


def test_unseen_misspellings_score_as_toxic():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghiklmnorstu") for _ in range(6))
    rows = [(" ".join([word() for _ in range(40)] + ["horridwretch"] * (i % 2)), i % 2) for i in range(400)]
    model = toxicity.fit([t for t, _ in rows], [y for _, y in rows])
    scorer = toxicity.Scorer(model)
    clean = " ".join(word() for _ in range(40)).encode()
    assert scorer.score(clean) < 0.5 < scorer.score(clean + b" horridwretsch") and scorer.score(b" ") == toxicity.EMPTY


def test_all_of_a_long_word_is_scored():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghiklmnorstu") for _ in range(6))
    rows = [(" ".join([word() for _ in range(40)] + ["horridwretch"] * (i % 2)), i % 2) for i in range(400)]
    scorer = toxicity.Scorer(toxicity.fit([t for t, _ in rows], [y for _, y in rows]))
    for joint in ("_", "-", ".", ""):
        clean = joint.join(word() for _ in range(40))
        for at in (70, 130, 200, len(clean)):
            assert scorer.score((clean[:at] + joint + "horridwretch" + joint + clean[at:]).encode()) > scorer.score(clean.encode()) + 0.1
    for size in (1, 63, 64, 65, 66, 500):
        long = bytes(rng.choice(b"abcdefgh") for _ in range(size))
        marked, parts = b"\x02" + long + b"\x03", toxicity.windows(long)
        grams = {p[i: i + n] for p in parts for n in toxicity.GRAMS for i in range(len(p) - n + 1)}
        assert grams == {marked[i: i + n] for n in toxicity.GRAMS for i in range(len(marked) - n + 1)}
    assert scorer.score(b"8814") != toxicity.EMPTY


def test_partial_scores_add_up():
    rng = np.random.default_rng(0)
    for scale in (10, 1 << 40):
        q, x = rng.integers(-scale, scale, (5, 7)), rng.integers(-9, 9, (6, 7))
        assert (sum(topk.partial_scores(q, x)).astype(np.int64) == q @ x.T).all()


@pytest.mark.parametrize("sparse", [0, 1 / 16, 2])
def test_sufficient_entries_are_all_that_reach_the_cutoff(monkeypatch, sparse):
    monkeypatch.setattr(topk, "SPARSE", sparse)
    rng = np.random.default_rng(0)
    for _ in range(100):
        width, scale = int(rng.integers(0, 9)), int(rng.choice([3, 50, 1 << 29]))
        q, x = rng.integers(-scale, scale, (5, width)), rng.integers(-scale, scale, (40, width))
        full, same = q @ x.T, rng.random((5, 40)) < 0.1
        cutoff = np.where(rng.random(5) < 0.2, topk.ANY, np.sort(full, 1)[:, -int(rng.integers(1, 20))])
        rows, places, scores = topk.sufficient(q, x, cutoff, same)
        want = np.nonzero((full >= cutoff[:, None]) & ~same)
        assert (rows == want[0]).all() and (places == want[1]).all() and (scores == full[want]).all()
    with pytest.raises(OverflowError):
        topk.partial_scores(np.array([[1 << 40]]), np.array([[1 << 40]]))


@pytest.mark.parametrize(("values", "size"), [([[1, -128], [127]], 1), ([[128]], 2), ([[-(1 << 31)], [3, 4]], 4), ([[1 << 40]], 8), ([[]], 1)])
def test_vectors_in_narrow_integers(values, size):
    ids, width, packed = topk._pack(list(range(len(values))), values)
    assert len(packed) == size * width * len(values)
    found = topk._unpack({"ids": ids, "width": width, "vectors": packed}, "", 3)[1]
    assert found.dtype == np.int64 and found.tolist() == [v + [0] * (3 - len(v)) for v in values]


def test_survivors_equal_rowwise_batches():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 256, near_dedup.HASHES, dtype=np.uint8)
    sig = np.where(rng.random((60, near_dedup.HASHES)) < np.linspace(0, 0.5, 60)[:, None], rng.integers(0, 256, (60, near_dedup.HASHES)), base).astype(np.uint8)
    bounds = near_dedup.least_matches(0.8)
    for i, other in ((0, np.arange(1, 60)), (30, np.arange(0, 60, 3)), (5, np.zeros(0, np.int64))):
        wanted = other[near_dedup.alive(sig[np.full(len(other), i)], sig[other], bounds)]
        assert near_dedup.survivors(sig, i, other, bounds).tolist() == wanted.tolist()
    assert 0 < len(near_dedup.survivors(sig, 0, np.arange(1, 60), bounds)) < 59


@pytest.mark.parametrize("limit", [1, 7, 1 << 15])
def test_block_pairs_gives_each_pair_once(limit):
    rng = np.random.default_rng(9)
    sides = [np.sort(rng.integers(0, rng.integers(1, 3), n)) for n in rng.integers(1, 9, 40)]
    sides = [np.zeros_like(s) if s.all() else s for s in sides]
    begins = np.cumsum([0, *map(len, sides)])[:-1]
    wanted = []
    for at, s in zip(begins.tolist(), sides):
        pairs = [(a, b) for a in range(len(s)) for b in range(a + 1, len(s)) if not s.any() or s[a] < s[b]]
        wanted += [(at + a, at + b) for a, b in pairs]
    found = [list(zip(i.tolist(), j.tolist())) for i, j in near_dedup.block_pairs(begins, np.concatenate(sides), limit)]
    assert sum(found, []) == wanted
    assert max(map(len, found)) <= max(limit, 8)
