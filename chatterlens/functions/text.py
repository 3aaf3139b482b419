"""Text cleaning as plain column expressions; nothing here leaves the JVM."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Collection, Mapping
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatterlens.functions.wordlists import EMOJI, SLANG

# The characters counted as white space by the str methods of the records' producer.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Clean-up patterns, applied in this order after the slang step.
USER_MENTION = r"(?U)/?u/\w+"
FORUM_MENTION = r"(?U)/?r/\w+"
URL = r"(?U)http[^\s\x1c-\x1f]+|www.[^\s\x1c-\x1f]+"
NOT_ALNUM = r"(?U)[^a-zA-Z0-9\s\x1c-\x1f]"
SPACES = r"(?U)[\s\x1c-\x1f]+"
# Runs of white space other than a lone space.
OTHER_SPACES = r"(?U)[\s\x1c-\x1f&&[^ ]][\s\x1c-\x1f]*| [\s\x1c-\x1f]+"
# The word tokenizer parts these six words in two.
CONTRACTIONS = r"\b(?:(can)(not)|(gim|lem)(me)|(gon|wan)(na)|(got)(ta))\b"
PARTED = "$1$3$5$7 $2$4$6$8"

_INLINE_ENTRIES = 256


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` as a bound variable."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def bucketed(entries: Mapping) -> list[dict]:
    """The entries cut into small maps by a checksum of the key; a map column is searched entry by entry."""
    slots = 1 << (len(entries) // 4).bit_length()
    buckets: list[dict] = [{} for _ in range(slots)]
    for key, value in entries.items():
        buckets[zlib.crc32(key.encode("utf-8")) % slots][key] = value
    return buckets


@lru_cache(maxsize=32)
def _bucket_literal(entries: tuple) -> tuple[int, str]:
    buckets = bucketed(dict(entries))
    return len(buckets), json.dumps(buckets, ensure_ascii=False)


def _buckets(entries: Mapping, value_type: str) -> tuple[int, Column]:
    slots, literal = _bucket_literal(tuple(entries.items()))
    return slots, F.from_json(F.lit(literal), f"array<map<string,{value_type}>>")


def _bucket_entry(word: Column, slots: int, maps: Column) -> Column:
    return F.try_element_at(F.get(maps, F.pmod(F.crc32(word.cast("binary")), F.lit(slots)).cast("int")), word)


def dictionary_lookup(word: Column, entries: Mapping, value_type: str = "string") -> Column:
    """The entry for ``word``, or NULL: a checksum and the search of one bucket of a few entries.

    In a small dictionary a miss costs one hash probe (IN over a literal set); for a large one no literal per
    entry is built on the driver.
    """
    if not entries:
        return F.lit(None).cast(value_type)
    found = _bucket_entry(word, *_buckets(entries, value_type))
    return F.when(word.isin(*entries), found) if len(entries) <= _INLINE_ENTRIES else found


def strip_space(text: Column) -> Column:
    return F.trim(text, F.lit(WHITESPACE))


def split_words(text: Column) -> Column:
    """Words between white space; no empty entries."""
    return F.array_remove(F.split(text, SPACES), "")


def lowercase(text: Column) -> Column:
    return F.lower(text)


_SPAN_GAP = 0x200
_JOINER, _VARIATION, _KEYCAP = "\u200d", "\ufe0f", "\u20e3"
_TONES = "\U0001f3fb-\U0001f3ff"
_LETTERS = "\U0001f1e6-\U0001f1ff"
_TAGS, _LAST_TAG = "\U000e0020-\U000e007e", "\U000e007f"


def emoji_span(emoji: Collection[str]) -> str:
    """A character class of a few ranges that covers all first characters."""
    ranges: list[list[str]] = []
    for c in sorted({symbol[0] for symbol in emoji}):
        if ranges and ord(c) - ord(ranges[-1][1]) <= _SPAN_GAP:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "".join(f"{re.escape(first)}-{re.escape(last)}" for first, last in ranges)


def _element(span: str) -> str:
    """One emoji: a character, perhaps in its emoji form or with a skin tone."""
    return f"[{span}][{_VARIATION}{_TONES}]?"


@lru_cache(maxsize=32)
def _emoji_patterns(symbols: tuple[str, ...]) -> tuple[str, str]:
    return emoji_span(symbols), emoji_pieces(symbols)


def emoji_pieces(emoji: Collection[str]) -> str:
    """A pattern that cuts a text into emoji, joined sequences, and stretches of anything else.

    The grammar of Unicode's sequences finds them, so the pattern does not grow with the dictionary; only entries of
    another form are listed.
    """
    span = emoji_span(emoji)
    one = _element(span)
    sequences = [f"[{_LETTERS}]{{2}}", f"[0-9#*]{_VARIATION}?{_KEYCAP}", f"\U0001f3f4[{_TAGS}]+{_LAST_TAG}", f"{one}(?:{_JOINER}{one})*"]
    grammar = re.compile("|".join([*sequences, f"[{span}]"]))
    others = sorted((e for e in emoji if not grammar.fullmatch(e)), key=len, reverse=True)
    return "|".join([*map(re.escape, others), *sequences, f"[^{span}0-9#*]+", "[0-9#*]"])


def _composed_name(piece: Column, name_of) -> Column:
    """The one name of a joined sequence, NULL where a part has none or it is no sequence."""
    parts = F.transform(F.split(piece, _JOINER, -1), name_of)
    joined = F.when(F.forall(parts, lambda n: n.isNotNull()), F.array_join(parts, "_"))
    code = F.translate(piece, "".join(chr(0x1F1E6 + i) for i in range(26)), "abcdefghijklmnopqrstuvwxyz")
    tags = "".join(chr(0xE0061 + i) for i in range(26)) + "".join(chr(0xE0030 + i) for i in range(10))
    region = F.translate(F.translate(piece, f"\U0001f3f4{_LAST_TAG}", ""), tags, "abcdefghijklmnopqrstuvwxyz0123456789")
    return (
        F.when(F.contains(piece, F.lit(_JOINER)), joined)
        .when(F.contains(piece, F.lit(_KEYCAP)), F.concat(F.lit("keycap_"), F.left(piece, F.lit(1))))
        .when(F.contains(piece, F.lit(_LAST_TAG)), F.concat(F.lit("flag_"), region))
        .when(piece.rlike(f"^[{_LETTERS}]{{2}}$"), F.concat(F.lit("flag_"), code))
    )


def emoji_to_words(text: Column, emoji: Mapping[str, str] = EMOJI) -> Column:
    """Replace each emoji by its name between spaces, the longest sequence first.

    A joined sequence has one name: the names of its parts joined by ``_``, ``flag_`` and the region's letters, or
    ``keycap_`` and the key. A sequence with an unknown part, and a known character before a mark it does not take,
    are named part by part.
    """
    if not emoji:
        return text
    longest = max(max(map(len, emoji)), 2)
    span, pieces = _emoji_patterns(tuple(emoji))

    slots, literal = _buckets(emoji, "string")

    def spaced(name: Column) -> Column:
        return F.concat(F.lit(" "), name, F.lit(" "))

    def named_by(maps: Column):
        def name_of(part: Column) -> Column:
            return F.when(F.length(part) <= longest, _bucket_entry(part, slots, maps))

        def by_part(piece: Column) -> Column:
            """Each element, else its first character and what follows it."""
            elements = F.regexp_extract_all(piece, F.lit(f"{_element(span)}|."), F.lit(0))
            return F.array_join(F.transform(elements, lambda e: F.coalesce(
                spaced(name_of(e)), F.concat(spaced(name_of(F.left(e, F.lit(1)))), F.substring(e, 2, 2)), e
            )), "")

        def named(piece: Column) -> Column:
            known = F.coalesce(spaced(name_of(piece)), spaced(_composed_name(piece, name_of)), by_part(piece))
            return F.when(piece.rlike(f"^(?:[{span}]|[0-9#*]{_VARIATION}?{_KEYCAP})"), known).otherwise(F.coalesce(spaced(name_of(piece)), piece))

        return named

    def replaced(whole: Column) -> Column:
        maybe = whole.rlike(f"[{span}{_KEYCAP}]")
        if all(ord(symbol[0]) > 0x7F for symbol in emoji):
            maybe = (F.octet_length(whole) > F.length(whole)) & maybe  # most texts are plain ASCII and skip the rest
        found = F.regexp_extract_all(whole, F.lit(pieces), F.lit(0))
        words = let(literal, lambda maps: F.transform(found, named_by(maps)))
        return F.when(maybe, F.array_join(words, "")).otherwise(whole)

    return let(text, replaced)


def expand_slang(text: Column, slang: Mapping[str, str] = SLANG) -> Column:
    """Replace whole words found in the dictionary; words are re-joined by one space."""
    words = F.transform(
        split_words(text), lambda w: F.coalesce(dictionary_lookup(F.lower(w), slang), w)
    )
    return F.array_join(words, " ")


def _where(text: Column, marks: list[str], change) -> Column:
    """``change(text)`` if the text holds one of the marks without which it would change nothing."""
    def guarded(whole: Column) -> Column:
        found = F.contains(whole, F.lit(marks[0]))
        for mark in marks[1:]:
            found = found | F.contains(whole, F.lit(mark))
        return F.when(found, change(whole)).otherwise(whole)

    return let(text, guarded)


def strip_user_mentions(text: Column) -> Column:
    return _where(text, ["u/"], lambda t: F.regexp_replace(t, USER_MENTION, ""))


def strip_forum_mentions(text: Column) -> Column:
    return _where(text, ["r/"], lambda t: F.regexp_replace(t, FORUM_MENTION, ""))


def strip_urls(text: Column) -> Column:
    return _where(text, ["http", "www"], lambda t: F.regexp_replace(t, URL, ""))


def strip_non_alnum(text: Column) -> Column:
    return F.regexp_replace(text, NOT_ALNUM, "")


def collapse_whitespace(text: Column) -> Column:
    return strip_space(F.regexp_replace(text, OTHER_SPACES, " "))


def tokenize_words(text: Column) -> Column:
    """Tokens joined by one space, for text that is already alphanumeric and collapsed."""
    return _where(text, ["cannot", "gimme", "lemme", "gonna", "wanna", "gotta"], lambda t: F.regexp_replace(t, CONTRACTIONS, PARTED))


def clean_text(
    text: Column, slang: Mapping[str, str] = SLANG, emoji: Mapping[str, str] = EMOJI
) -> Column:
    """The whole cleaning chain; NULL gives the empty text."""
    step = expand_slang(emoji_to_words(lowercase(F.coalesce(text, F.lit(""))), emoji), slang)
    step = strip_urls(strip_forum_mentions(strip_user_mentions(step)))
    return tokenize_words(collapse_whitespace(strip_non_alnum(step)))


def original_length(text: Column) -> Column:
    return F.length(F.coalesce(text, F.lit("")))


def normalize_phrase(text: Column) -> Column:
    return F.array_join(split_words(F.lower(text)), " ")
