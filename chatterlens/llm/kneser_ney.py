"""Quality by perplexity under an interpolated modified Kneser-Ney model of characters.

Counts of ``ORDER``-grams come from all trusted texts. Lower orders use continuation counts; each order has its
three discounts. Documents travel in compressed blocks: a block asks for its distinct n-grams, the requests are
joined with the count tables (hash-sharded on n-gram, context and suffix) from order 1 up, and the
log-probabilities return to the block, which sums them per document. So the shuffled n-grams grow with the blocks' distinct
n-grams, not with the characters, and no model is broadcast.

A fifth of the trusted documents, by a checksum of the id, is held out of the counts. A document is rejected when its perplexity exceeds the
``QUANTILE`` of its language's held-out documents. Repetition makes a text predictable, so it is also rejected when ``fresh``, the
share of its information left when every pair of neighbouring words counts once, is below the same quantile, from below, of its
language's trusted documents. A language without such documents takes the quantiles of all.

Symbols are whole code points, lower-cased, digits as ``0`` and white space as one symbol. Words are runs of letters and marks, or of
digits; every other character is a word, and so is every letter of a script without spaces.
Defined results: null and empty texts have perplexity and ``fresh`` null and are rejected; a text without words is all fresh; a null
language is a language of its own; repeated rows each give a row, and a trusted id trains with all its rows; a null id is never trusted;
without trusted text the model is uniform and nothing but empty texts is rejected. Only
``doc_id``, ``text`` and ``lang`` are read.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterlens.llm import textnum
from chatterlens.llm.storage import stored
from chatterlens.operators.joins import sized_join

ORDER = 3
BITS = 21
SYMBOLS = 1 << BITS
BLOCK_BYTES = 32 << 20
LEVEL = 6
CHUNK_BYTES = 1 << 20
MERGE = 16
QUANTILE = 0.995
HELD_OUT = 5

#: First and last code point of scripts that set no spaces between words.
UNSPACED = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF)]

SPACE, LETTER, DIGIT, ALONE = range(4)


def _kinds() -> np.ndarray:
    kinds = np.full(textnum.TABLE + 1, ALONE, np.uint8)  # the last entry stands for all code points beyond
    for c in range(textnum.TABLE):
        if chr(c).isspace():
            kinds[c] = SPACE
        elif chr(c).isalpha() or unicodedata.category(chr(c))[0] == "M":
            kinds[c] = LETTER
    kinds[48:58] = DIGIT
    for first, last in UNSPACED:
        kinds[first: last + 1] = ALONE
    return kinds


KINDS = _kinds()


def words(points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and first place of each word, and the number of words before each text (one more entry than texts)."""
    low, _ = textnum.letters(points)
    kinds = KINDS[np.minimum(low, textnum.TABLE)]
    edge = np.zeros(len(low) + 1, bool)
    edge[bounds] = True
    begins = kinds != SPACE
    begins[1:] &= edge[1:-1] | (kinds[1:] != kinds[:-1]) | (kinds[1:] == ALONE)
    starts = np.flatnonzero(begins)
    first = np.searchsorted(starts, bounds)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, first
    inside = kinds != SPACE
    place = np.arange(len(low)) - starts[np.maximum(np.cumsum(begins) - 1, 0)]
    symbol = np.where(kinds == DIGIT, 48, low).astype(np.uint64)
    each = textnum.mix(symbol * np.uint64(0x9E3779B97F4A7C15) + place.astype(np.uint64))
    sums = np.add.reduceat(each[inside], np.cumsum(inside)[starts] - 1)
    return textnum.mix(sums), starts, first


def fresh_share(points: np.ndarray, bounds: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Per text the share of its words' ``bits`` (one number per character) left when each pair of neighbours counts once."""
    hashes, starts, first = words(points, bounds)
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts)), counts)
    total = np.concatenate([[0.0], np.cumsum(bits)])
    own = total[np.minimum(np.append(starts[1:], len(points)), bounds[text + 1])] - total[starts] if len(starts) else np.zeros(0)
    before = np.concatenate([np.zeros(1, np.uint64), hashes[:-1]]) if len(hashes) else hashes
    before[first[:-1][counts > 0]] = 0
    pair = textnum.mix(textnum.mix(before + np.uint64(0x9E3779B97F4A7C15)) ^ hashes) ^ textnum.mix(text.astype(np.uint64))
    _, once = np.unique(pair, return_index=True)
    whole = np.bincount(text, own, len(counts))
    return np.where(whole > 0, np.bincount(text[once], own[once], len(counts)) / np.where(whole > 0, whole, 1), 1.0)


def grams(points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each character (texts begin with ``ORDER - 1`` zeros), and the characters per text."""
    low, _ = textnum.letters(points)
    kinds = KINDS[np.minimum(low, textnum.TABLE)]
    symbols = 1 + np.where(kinds == DIGIT, 48, np.where(kinds == SPACE, 32, low)).astype(np.int64)
    sizes, pad = np.diff(bounds), ORDER - 1
    padded = np.zeros(len(symbols) + pad * len(sizes), np.int64)
    padded[np.arange(len(symbols)) + pad * (1 + np.repeat(np.arange(len(sizes)), sizes))] = symbols
    keys = np.zeros(max(len(padded) - pad, 0), np.int64)
    for step in range(ORDER):
        keys = (keys << BITS) | padded[step: step + len(keys)]
    return keys[padded[pad:] != 0], sizes


def make_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition in compressed blocks of about ``BLOCK_BYTES`` of text."""
    number, held, size = TaskContext.get().partitionId() << 32, [], 0

    def out():
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", LEVEL))) as writer:
            for batch in held:
                writer.write_batch(batch)
        ids = pa.concat_arrays([b.column("doc_id") for b in held])
        lists = pa.array([ids.to_pylist()], pa.list_(pa.int64()))
        payload = pa.array([sink.getvalue().to_pybytes()], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), lists, payload], ["block", "ids", "payload"])

    for batch in batches:
        batch = batch.set_column(batch.schema.get_field_index("text"), "text", textnum.binary_column(batch, "text"))
        for at, end, data, _ in textnum.text_chunks(batch, "text"):
            held.append(batch.slice(at, end - at))
            size += len(data) + 64 * (end - at)
            if size >= BLOCK_BYTES:
                yield out()
                number, held, size = number + 1, [], 0
    if held:
        yield out()


def _batches(payload) -> Iterator[pa.RecordBatch]:
    with pa.ipc.open_stream(payload) as reader:
        yield from reader


def merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams and summed counts of several such pairs."""
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes, distinct = pd.factorize(np.concatenate([keys for keys, _ in found]))
    counts = np.concatenate([counts for _, counts in found])
    return distinct, np.bincount(codes, counts, minlength=len(distinct)).astype(np.int64)


def count_block(left: pa.Table, right: pa.Table) -> pa.Table:
    """The distinct n-grams of a block and how often its trusted documents have each."""
    trusted = right.column("doc_id").to_numpy()[right.column("flag").to_numpy() == 2]
    found = []
    for payload, block in zip(left.column("payload"), left.column("block")):
        for batch in _batches(payload.as_buffer()):
            own = pd.Series(batch.column("doc_id").to_pylist(), dtype="Int64").isin(trusted).to_numpy(bool)
            for at, end, data, offsets in textnum.text_chunks(batch, "text", CHUNK_BYTES):
                keys, sizes = grams(*textnum.code_points(data, offsets))
                codes, distinct = pd.factorize(keys)
                weight = np.repeat(own[at:end], sizes)
                found.append((distinct, np.bincount(codes[weight], minlength=len(distinct))))
                if len(found) == MERGE:
                    found = [merged(found)]
    distinct, sums = merged(found)
    number = left.column("block")[0].as_py() if len(left) else 0
    return pa.table({"block": np.full(len(distinct), number, np.int64), "gram": distinct, "count": sums})


SCORED = pa.schema([
    ("doc_id", pa.int64()), ("lang", pa.string()), ("flag", pa.int32()), ("n_symbols", pa.int64()), ("logp", pa.float64()), ("share", pa.float64()),
])


def score_block(left: pa.Table, right: pa.Table) -> pa.Table:
    """Per document of a block: symbols, total log-probability, fresh share. ``right`` holds n-grams (kind 0) and ids, by their flag."""
    kind = right.column("kind").to_numpy()
    value, logp = right.column("value").to_numpy(), right.column("logp").to_numpy()
    order = np.argsort(value[kind == 0])
    keys, logs, held, learnt = value[kind == 0][order], logp[kind == 0][order], value[kind == 1], value[kind == 2]
    out = []
    for payload in left.column("payload"):
        for batch in _batches(payload.as_buffer()):
            ids = pd.Series(batch.column("doc_id").to_pylist(), dtype="Int64")
            own = ids.isin(held).to_numpy(np.int32) + 2 * ids.isin(learnt).to_numpy(np.int32)
            for at, end, data, offsets in textnum.text_chunks(batch, "text", CHUNK_BYTES):
                points, bounds = textnum.code_points(data, offsets)
                found, sizes = grams(points, bounds)
                codes, distinct = pd.factorize(found)
                each = logs[np.searchsorted(keys, distinct)][codes] if len(distinct) else np.zeros(0)
                sums = np.bincount(np.repeat(np.arange(len(sizes)), sizes), each, minlength=len(sizes))
                out.append(pa.Table.from_arrays([
                    batch.column("doc_id").slice(at, end - at), batch.column("lang").slice(at, end - at).cast(pa.string()),
                    pa.array(own[at:end]), pa.array(sizes, pa.int64()), pa.array(sums, pa.float64()),
                    pa.array(fresh_share(points, bounds, -each), pa.float64()),
                ], schema=SCORED))
    return pa.concat_tables(out) if out else SCORED.empty_table()


def discounts(table: DataFrame) -> tuple[float, float, float]:
    """Chen and Goodman's three discounts from the counts of counts."""
    row = table.agg(*[F.count_if(F.col("count") == k).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    n = [row[f"n{k}"] for k in (1, 2, 3, 4)]
    if not all(n):
        return 0.5, 0.75, 0.9
    y = n[0] / (n[0] + 2 * n[1])
    raw = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
    return tuple(min(max(d, 0.0), float(k)) for k, d in enumerate(raw, 1))


def discount(count: Column, d: tuple[float, float, float]) -> Column:
    return F.when(count == 1, d[0]).when(count == 2, d[1]).when(count >= 3, d[2]).otherwise(0.0)


def probabilities(counts: DataFrame, requests: DataFrame) -> DataFrame:
    """``(gram, logp)`` for the distinct ``requests(gram)``, from ``counts(gram, count)`` of the highest order."""
    def suffix(order):
        return F.col("gram").bitwiseAND(F.lit((1 << (BITS * order)) - 1))

    tables, wanted = {ORDER: counts}, {ORDER: requests}
    for n in range(ORDER - 1, 0, -1):
        tables[n] = stored(tables[n + 1].groupBy(suffix(n).alias("gram")).agg(F.count("*").alias("count")), f"counts{n}")
        wanted[n] = wanted[n + 1].select(suffix(n).alias("gram")).distinct()
    lower = None
    for n in range(1, ORDER + 1):
        d = discounts(tables[n])
        context = F.shiftright(F.col("gram"), BITS)
        contexts = tables[n].groupBy(context.alias("context")).agg(
            F.sum("count").alias("total"), F.sum(discount(F.col("count"), d)).alias("freed")
        )
        rows = wanted[n].join(tables[n], "gram", "left").withColumn("context", context).join(contexts, "context", "left")
        if n == 1:
            rows = rows.withColumn("base", F.lit(1.0 / SYMBOLS))
        else:
            rows = rows.withColumn("tail", suffix(n - 1)).join(lower.select(F.col("gram").alias("tail"), F.col("p").alias("base")), "tail")
        own = F.coalesce((F.col("count") - discount(F.col("count"), d)) / F.col("total"), F.lit(0.0))
        p = own + F.coalesce(F.col("freed") / F.col("total"), F.lit(1.0)) * F.col("base")
        lower = stored(rows.select("gram", p.alias("p")), f"probabilities{n}")
    return lower.select("gram", F.log("p").alias("logp"))


def score(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """``(doc_id, lang, flag, n_symbols, perplexity, fresh)`` per row of ``docs``; ``trusted`` holds ids.

    ``flag`` is 2 for training documents, 1 for held-out trusted ones and 0 for others.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    blocks = stored(docs.mapInArrow(make_blocks, "block long, ids array<long>, payload binary"), "blocks")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT == 0
    flags = trusted.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().withColumn("flag", F.when(held, 1).otherwise(2))
    ids = blocks.select("block", F.explode("ids").alias("doc_id")).distinct().join(flags, "doc_id").select("block", "doc_id", "flag")
    ids = stored(ids, "trusted")
    payload = blocks.select("block", "payload")
    requests = stored(
        payload.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(count_block, "block long, gram long, count long"), "requests"
    )
    summed = stored(requests.groupBy("gram").agg(F.sum("count").alias("count")), "counts")
    answers = requests.select("block", "gram").join(probabilities(summed.where("count > 0"), summed.select("gram")), "gram")
    answers = answers.select("block", F.lit(0).alias("kind"), F.col("gram").alias("value"), "logp").unionByName(
        ids.select("block", F.col("flag").alias("kind"), F.col("doc_id").alias("value"), F.lit(0.0).alias("logp"))
    )
    scored = payload.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        score_block, "doc_id long, lang string, flag int, n_symbols long, logp double, share double"
    )
    full = F.col("n_symbols") > 0
    perplexity = F.when(full, F.round(F.exp(-F.col("logp") / F.col("n_symbols")), 6))
    return scored.select("doc_id", "lang", "flag", "n_symbols", perplexity.alias("perplexity"), F.when(full, F.round("share", 9)).alias("fresh"))


def judge(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """``(doc_id, lang, n_symbols, perplexity, limit, fresh, floor, kept)`` per row of ``docs``."""
    scored = stored(score(docs, trusted), "scored").withColumn("_lang", F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-")))
    known = scored.where("flag > 0 AND perplexity IS NOT NULL")
    limit = F.percentile_approx(F.when(F.col("flag") == 1, F.col("perplexity")), QUANTILE, 10_000)
    floor = F.percentile_approx("fresh", 1 - QUANTILE, 10_000)
    own = known.groupBy("_lang").agg(limit.alias("own_limit"), floor.alias("own_floor"))
    overall = known.agg(F.coalesce(limit, F.lit(math.inf)).alias("all_limit"), F.coalesce(floor, F.lit(0.0)).alias("all_floor"))
    # a hot language must not gather its rows in one task: broadcast after a count, else salted
    limited = sized_join(scored, stored(own, "limits"), ["_lang"], "left").join(F.broadcast(overall))  # one row
    limit, floor = F.coalesce("own_limit", "all_limit"), F.coalesce("own_floor", "all_floor")
    kept = F.coalesce((F.col("perplexity") <= limit) & (F.col("fresh") >= floor), F.lit(False))
    return limited.select("doc_id", "lang", "n_symbols", "perplexity", limit.alias("limit"), "fresh", floor.alias("floor"), kept.alias("kept"))
