"""SentencePiece encoding and decoding for merge-type vocabularies.

Encoding keeps an agenda of adjacent symbol pairs whose joined string is a piece, ordered by score (then by place), and
merges until the agenda is empty; what is no piece falls back to its bytes. No piece holds a space mark after
another character, so merges never cross from a word into the next mark: a text is the concatenation of its words, and
each distinct word of an Arrow batch runs through the agenda once and is checked against the library, which raises
on any difference. Decoding is the library's, over all ids of a text.

Defined results: a null or empty text is the end id alone and decodes to an empty text; null ids stay null; repeated rows
give equal rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterlens.llm import textnum
from chatterlens.llm.cache import Generations

MARK = "▁"
NEVER = float("-inf")
CACHE = 400_000
WORD_CHARS = 64
SHORT = 48


class Vocabulary:
    """The pieces of a model with their scores, and the encoder's bounded cache of words."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)
        lib = self.library
        self.end, self.unknown = lib.eos_id(), lib.unk_id()
        special = [lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i) for i in range(len(lib))]
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        byte_ids = set(self.bytes) - {self.unknown}
        self.ids = {lib.id_to_piece(i): i for i in range(len(lib)) if not special[i] and i not in byte_ids}
        self.scores = {piece: lib.get_score(i) for piece, i in self.ids.items()}
        if any(MARK in piece.lstrip(MARK) for piece in self.ids):
            raise ValueError("a piece joins two words; this vocabulary is not split at spaces")
        # a character that no longer piece holds never merges
        self.breaks_lines = not any("\n" in piece and len(piece) > 1 for piece in self.ids)
        self.digits = [str(i) for i in range(len(lib))]
        self.known = Generations(CACHE)

    def merged(self, text: str) -> list[str]:
        """The symbols of ``text`` once no adjacent pair is a piece.

        The agenda of a short text is the list of its pairs' scores, that of a long one a heap; both take the highest
        score first and the leftmost pair among equals.
        """
        return self._merged_list(text) if len(text) <= SHORT else self._merged_heap(text)

    def _merged_list(self, text: str) -> list[str]:
        symbols, score = list(text), self.scores.get
        agenda = [score(a + b, NEVER) for a, b in itertools.pairwise(symbols)]
        while agenda:
            best = max(agenda)
            if best == NEVER:
                break
            i = agenda.index(best)
            joined = symbols[i] + symbols[i + 1]
            symbols[i: i + 2] = [joined]
            del agenda[i]
            if i:
                agenda[i - 1] = score(symbols[i - 1] + joined, NEVER)
            if i < len(agenda):
                agenda[i] = score(joined + symbols[i + 1], NEVER)
        return symbols

    def _merged_heap(self, text: str) -> list[str]:
        symbols: list[str | None] = list(text)
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        agenda: list[tuple[float, int, int, str]] = []

        def offer(left: int) -> None:
            right = after[left]
            if right < len(symbols):
                joined = symbols[left] + symbols[right]
                score = self.scores.get(joined)
                if score is not None:
                    heapq.heappush(agenda, (-score, left, right, joined))

        for i in range(len(symbols) - 1):
            offer(i)
        while agenda:
            _, left, right, joined = heapq.heappop(agenda)
            if symbols[left] is None or symbols[right] is None or symbols[left] + symbols[right] != joined or after[left] != right:
                continue  # one of the two has been merged since
            symbols[left], symbols[right] = joined, None
            after[left] = after[right]
            if after[left] < len(symbols):
                before[after[left]] = left
            if before[left] >= 0:
                offer(before[left])
            offer(left)
        return [s for s in symbols if s is not None]

    def encode_unit(self, unit: str) -> list[int]:
        out = []
        for symbol in self.merged(unit):
            found = self.ids.get(symbol)
            if found is None:
                out += [self.bytes[b] for b in symbol.encode()]
            else:
                out.append(found)
        return out

    def learn(self, words: list[str]) -> dict[str, tuple[int, ...]]:
        """Encode new words, each after a space mark, and check them against the library, which puts that mark itself."""
        out: dict[str, tuple[int, ...]] = {}
        for word in words:
            first, *lines = word.split("\n") if self.breaks_lines else [word]
            found = self.known.get(first) if lines else None
            ids = list(found) if found else self.encode_unit(MARK + first.replace(" ", MARK))
            for line in lines:
                ids += self.encode_unit("\n")
                ids += self.encode_unit(line.replace(" ", MARK))
            out[word] = tuple(ids)
        checked = [w for w in out if w]
        for word, theirs in zip(checked, self.library.encode(checked, num_threads=1)):
            if out[word] != tuple(theirs):
                raise ValueError(f"the agenda gives {out[word]} for {word!r}, the library {theirs}")
        for word, ids in out.items():
            if len(word) <= WORD_CHARS:
                self.known.put(word, ids)
        return out

    def encode(self, text: str) -> list[int]:
        """All ids without the end id."""
        if not text:
            return []
        words = text.replace(MARK, " ").split(" ")
        if "" in words:  # further spaces belong to the word behind them, or form the last word
            pieces, words, spaces = words, [], 0
            for piece in pieces:
                if piece:
                    words.append(" " * spaces + piece)
                    spaces = 0
                else:
                    spaces += 1
            if spaces:
                words.append(" " * (spaces - 1))
        found = self.known.look_up(words)
        if None in found:
            new = self.learn(list(dict.fromkeys(w for w, x in zip(words, found) if x is None)))
            found = [new[w] if x is None else x for w, x in zip(words, found)]
        return list(itertools.chain.from_iterable(found))


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """One per Python worker, so that its cache outlives a task."""
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def _encode(path: str, full: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(path)
        for batch in batches:
            for at, stop, _, _ in textnum.text_chunks(batch, "text"):
                rows = []
                part = batch.slice(at, stop - at)
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    ids = [*own.encode(text or ""), own.end]
                    decoded = own.library.decode(ids)
                    digest = hashlib.sha256(" ".join(map(own.digits.__getitem__, ids)).encode()).hexdigest()
                    back = hashlib.sha256(decoded.encode()).hexdigest()
                    rows.append((doc_id, len(ids), digest, back, *((ids, decoded) if full else ())))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string()]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    return run


def encode(docs: DataFrame, model: str, full: bool = True) -> DataFrame:
    """Per row ``(doc_id, n_tokens, ids_sha256, decoded_sha256)``, with ``ids`` and ``decoded`` if ``full``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.mapInArrow(_encode(model, full), schema + (", ids array<int>, decoded string" if full else ""))
