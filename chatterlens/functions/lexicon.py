"""Rule-based sentiment of a text in [-1, 1], after Hutto and Gilbert (ICWSM 2014).

The score is one column expression. The lexicon is a parameter; the default is a
small one. Words are looked up in place, and the context rules look at up to three
words before a lexicon word through array positions, so no row is ever exploded.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatterlens import schemas as S
from chatterlens.functions.text import dictionary_lookup, emoji_to_words, let, split_words
from chatterlens.functions.wordlists import EMOJI

# Word -> mean valence, from -4 to 4.
LEXICON = {
    "abuse": -3.2, "abandon": -1.9, "accept": 1.6, "admire": 2.1, "adore": 2.6, "afraid": -2.2,
    "agree": 1.5, "alone": -1.0, "amazing": 2.8, "anger": -2.7, "angry": -2.3, "annoying": -1.7,
    "anxious": -1.0, "awesome": 3.1, "awful": -2.0, "awkward": -0.6, "bad": -2.5, "beautiful": 2.9,
    "benefit": 2.0, "best": 3.2, "better": 1.9, "bitter": -1.8, "blame": -1.4, "blessed": 2.9,
    "bored": -1.1, "boring": -1.3, "brave": 2.4, "brilliant": 2.8, "broken": -2.1, "brutal": -3.1,
    "calm": 1.3, "care": 2.2, "charming": 2.8, "cheat": -2.0, "cheerful": 2.5, "clean": 1.7,
    "clever": 2.0, "comfort": 1.5, "cool": 1.3, "corrupt": -3.0, "crap": -1.6, "crazy": -1.4,
    "crime": -2.5, "cruel": -2.8, "cry": -2.1, "cute": 2.0, "damn": -1.7, "danger": -2.4,
    "dead": -3.3, "death": -2.9, "defeat": -2.0, "delight": 2.9, "desperate": -1.3, "disappointed": -1.9,
    "disaster": -3.1, "disgusting": -2.4, "dislike": -1.6, "doubt": -1.5, "dumb": -2.3, "easy": 1.9,
    "enjoy": 2.2, "evil": -3.4, "excellent": 2.7, "excited": 1.4, "fail": -2.5, "failure": -2.3,
    "fair": 1.3, "faith": 1.8, "fake": -2.1, "fantastic": 2.6, "fear": -2.2, "fine": 0.8,
    "fool": -1.9, "free": 2.3, "fresh": 1.3, "friend": 2.2, "friendly": 2.2, "fun": 2.3,
    "funny": 1.9, "generous": 2.3, "glad": 2.0, "good": 1.9, "grateful": 2.0, "great": 3.1,
    "grief": -2.2, "guilty": -1.8, "happy": 2.7, "harm": -2.5, "hate": -2.7, "hated": -3.2,
    "help": 1.7, "helpful": 1.8, "hero": 2.6, "honest": 2.3, "hope": 1.9, "horrible": -2.5,
    "hurt": -2.4, "idiot": -2.3, "ignore": -1.5, "incredible": 2.7, "insult": -2.3, "interesting": 1.7,
    "joke": 1.2, "joy": 2.8, "kill": -3.7, "kind": 2.4, "lame": -1.8, "laugh": 2.6,
    "lazy": -1.5, "liar": -2.3, "lie": -1.6, "like": 1.5, "lol": 1.8, "lonely": -1.5,
    "lose": -1.7, "loss": -1.3, "love": 3.2, "loved": 2.9, "lovely": 2.8, "lucky": 1.8,
    "mad": -2.2, "mess": -1.5, "miss": -0.6, "murder": -3.7, "nice": 1.8, "no": -1.2,
    "pain": -2.3, "peace": 2.5, "perfect": 2.7, "please": 1.3, "poor": -2.1, "pretty": 2.2,
    "problem": -1.7, "proud": 2.1, "rude": -2.0, "sad": -2.1, "safe": 1.9, "scared": -1.9,
    "shame": -2.1, "sick": -2.3, "smart": 1.7, "smile": 1.5, "sorry": -0.3, "strong": 2.3,
    "stupid": -2.4, "success": 2.7, "sucks": -1.5, "super": 2.9, "support": 1.7, "sweet": 2.0,
    "terrible": -2.1, "thanks": 1.9, "threat": -2.4, "tragic": -2.4, "trust": 2.3, "ugly": -2.3,
    "upset": -1.6, "useless": -1.8, "victory": 2.5, "violent": -2.9, "war": -2.9, "warm": 0.9,
    "waste": -1.8, "weak": -1.9, "welcome": 2.0, "win": 2.8, "wonderful": 2.7, "worry": -1.9,
    "worse": -2.1, "worst": -3.1, "worthless": -1.9, "wow": 2.8, "wrong": -2.1, "yes": 1.7,
}
# Scalars, word lists and set phrases of the published rules.
BOOST, CAPS, NEGATED, SPREAD = 0.293, 0.733, -0.74, 15.0
NEVER_SO, BUT_BEFORE, BUT_AFTER = 1.25, 0.5, 1.5
EXCLAIM, EXCLAIM_MAX, QUESTION, QUESTION_MAX = 0.292, 4, 0.18, 0.96
DAMPED = {1: 1.0, 2: 0.95, 3: 0.9}
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
NEGATIONS = (
    "aint arent cannot cant couldnt darent didnt doesnt ain't aren't can't couldn't daren't didn't "
    "doesn't dont hadnt hasnt havent isnt mightnt mustnt neither don't hadn't hasn't haven't isn't "
    "mightn't mustn't neednt needn't never none nope nor not nothing nowhere oughtnt shant shouldnt "
    "uhuh wasnt werent oughtn't shan't shouldn't uh-uh wasn't weren't without wont wouldnt won't "
    "wouldn't rarely seldom despite"
).split()
BOOSTERS_UP = (
    "absolutely amazingly awfully completely considerable considerably decidedly deeply effing "
    "enormous enormously entirely especially exceptional exceptionally extreme extremely fabulously "
    "flipping flippin frackin fracking fricking frickin frigging friggin fully fuckin fucking "
    "fuggin fugging greatly hella highly hugely incredible incredibly intensely major majorly more "
    "most particularly purely quite really remarkably so substantially thoroughly total totally "
    "tremendous tremendously uber unbelievably unusually utter utterly very"
).split()
BOOSTERS_DOWN = (
    "almost barely hardly kinda kindof kind-of less little marginal marginally occasional "
    "occasionally partly scarce scarcely slight slightly somewhat sorta sortof sort-of"
).split()
BOOSTER_PHRASES = ["just enough", "kind of", "sort of"]
IDIOMS = {
    "the shit": 3.0, "the bomb": 3.0, "bad ass": 1.5, "badass": 1.5, "bus stop": 0.0,
    "yeah right": -2.0, "kiss of death": -1.5, "to die for": 3.0, "beating heart": 3.1, "broken heart": -2.9,
}
# Emoticons with their valences, keys lower-cased as all words.
EMOTICONS = {
    ":)": 2.0, ":-)": 1.3, ":d": 2.3, ";)": 0.9, "<3": 1.9, ":(": -1.9, ":-(": -1.5, ":'(": -2.2, ":/": -1.4,
}
LEXICON = LEXICON | EMOTICONS
SPOKEN_EMOJI = {symbol: name.replace("_", " ") for symbol, name in EMOJI.items()}
BOOSTERS = {**{w: BOOST for w in BOOSTERS_UP}, **{w: -BOOST for w in BOOSTERS_DOWN}}


def sentiment_words(text: Column) -> Column:
    """Words in their own case; outer punctuation goes unless two or fewer characters remain."""
    bare = lambda w: F.trim(w, F.lit(PUNCTUATION))
    return F.transform(split_words(text), lambda w: F.when(F.length(bare(w)) <= 2, w).otherwise(bare(w)))


def normalized(total: Column) -> Column:
    """Map a sum of valences to [-1, 1]."""
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), total / F.sqrt(total * total + F.lit(SPREAD))))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def lexicon_base(text: Column, lexicon: Mapping[str, float] = LEXICON) -> Column:
    """The plain rule: valences of the words, summed and normalised."""
    valences = F.transform(
        sentiment_words(text),
        lambda w: F.coalesce(dictionary_lookup(F.lower(w), lexicon, "double"), F.lit(0.0)),
    )
    return let(_total(valences), normalized)


def _is_upper(word: Column) -> Column:
    return (F.upper(word) == word) & (F.lower(word) != word)


class _Context:
    """The words around one lexicon word, as expressions that are evaluated only where used."""

    def __init__(self, words: Column, lows: Column, valences: Column, at: Column):
        self.words, self.lows, self.valences, self.at = words, lows, valences, at

    def low(self, k: int = 0) -> Column:
        """The lower-case word ``k`` places on; NULL beyond the text."""
        return F.get(self.lows, self.at + F.lit(k))

    def is_word(self, k: int, *choices: str) -> Column:
        return F.coalesce(self.low(k).isin(*choices), F.lit(False))

    def in_lexicon(self, k: int) -> Column:
        return F.get(self.valences, self.at + F.lit(k)).isNotNull()

    def valence(self) -> Column:
        return F.get(self.valences, self.at)

    def booster(self, k: int) -> Column:
        return dictionary_lookup(self.low(k), BOOSTERS, "double")

    def negates(self, k: int) -> Column:
        word = self.low(k)
        return F.coalesce(word.isin(*NEGATIONS) | F.contains(word, F.lit("n't")), F.lit(False))

    def shouted(self, k: int) -> Column:
        """The word is in capitals and the text as a whole is not."""
        calm = F.exists(self.words, lambda w: ~_is_upper(w))
        return F.coalesce(_is_upper(F.get(self.words, self.at + F.lit(k))), F.lit(False)) & calm

    def phrase(self, first: int, last: int) -> Column:
        """The words at ``first``..``last``; NULL when they run out of the text."""
        parts = [self.low(first)]
        for k in range(first + 1, last + 1):
            parts += [F.lit(" "), self.low(k)]
        return F.concat(*parts) if len(parts) > 1 else parts[0]


def _emphasis(valence: Column, amount) -> Column:
    return F.when(valence > 0, F.lit(amount)).otherwise(F.lit(-amount))


def _boosted(valence: Column, near: _Context, distance: int) -> Column:
    strength = near.booster(-distance)
    signed = F.when(valence < 0, -strength).otherwise(strength)
    loud = F.when(near.shouted(-distance), _emphasis(valence, CAPS)).otherwise(F.lit(0.0))
    return F.when(
        near.low(-distance).isin(*BOOSTERS), valence + (signed + loud) * F.lit(DAMPED[distance])
    ).otherwise(valence)


def _negated(valence: Column, near: _Context, distance: int) -> Column:
    flipped = F.when(near.negates(-distance), valence * F.lit(NEGATED)).otherwise(valence)
    if distance == 1:
        return flipped
    so, doubt = F.lit(False), F.lit(False)
    for k in range(1, distance):
        so, doubt = so | near.is_word(-k, "so", "this"), doubt | near.is_word(-k, "doubt")
    return (
        F.when(near.is_word(-distance, "never") & so, valence * F.lit(NEVER_SO))
        .when(near.is_word(-distance, "without") & doubt, valence)
        .otherwise(flipped)
    )


def _idiom(valence: Column, near: _Context) -> Column:
    """A set phrase around the word replaces its valence; a booster phrase before it lowers it."""
    spans = [(0, 2), (0, 1), (-1, 0), (-2, 0), (-2, -1), (-3, -1), (-3, -2)]
    replaced = F.coalesce(*[dictionary_lookup(near.phrase(*s), IDIOMS, "double") for s in spans], valence)
    lowered = F.lit(0.0)
    for span in [(-3, -1), (-3, -2), (-2, -1)]:
        hit = near.phrase(*span).isin(*BOOSTER_PHRASES)
        lowered = lowered + F.when(hit, F.lit(-BOOST)).otherwise(F.lit(0.0))
    return replaced + lowered


def _least(valence: Column, near: _Context) -> Column:
    least = near.is_word(-1, "least") & ~near.in_lexicon(-1) & ~near.is_word(-2, "at", "very")
    return F.when(least, valence * F.lit(NEGATED)).otherwise(valence)


def _valence_in_context(near: _Context) -> Column:
    """Valence of the lexicon word at one position, after the words around it."""
    no_before = (
        near.is_word(-1, "no") | near.is_word(-2, "no") | (near.is_word(-3, "no") & near.is_word(-1, "or", "nor"))
    )
    own = (
        F.when(no_before, near.valence() * F.lit(NEGATED))
        .when(near.is_word(0, "no") & near.in_lexicon(1), F.lit(0.0))
        .otherwise(near.valence())
    )

    def look_back(distance: int, valence: Column) -> Column:
        if distance > 3:
            return _least(valence, near)

        def after_boost(boosted: Column) -> Column:
            turned = _negated(boosted, near, distance)
            return let(turned, lambda v: _idiom(v, near)) if distance == 3 else turned

        applies = (near.at >= distance) & ~near.in_lexicon(-distance)
        changed = let(_boosted(valence, near, distance), after_boost)
        return let(F.when(applies, changed).otherwise(valence), lambda v: look_back(distance + 1, v))

    def from_caps(valence: Column) -> Column:
        loud = F.when(near.shouted(0), valence + _emphasis(valence, CAPS)).otherwise(valence)
        return let(loud, lambda v: look_back(1, v))

    is_booster = near.low().isin(*BOOSTERS) | (near.is_word(0, "kind") & near.is_word(1, "of"))
    return F.when(is_booster, F.lit(0.0)).otherwise(let(own, from_caps))


def _occurrences(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _punctuation(text: Column) -> Column:
    exclaims = F.least(_occurrences(text, "!"), F.lit(EXCLAIM_MAX)) * F.lit(EXCLAIM)
    questions = _occurrences(text, "?")
    asked = (
        F.when(questions > 3, F.lit(QUESTION_MAX))
        .when(questions > 1, questions * F.lit(QUESTION))
        .otherwise(F.lit(0.0))
    )
    return exclaims + asked


def lexicon_compound(
    text: Column, lexicon: Mapping[str, float] = LEXICON, emoji: Mapping[str, str] = SPOKEN_EMOJI
) -> Column:
    """The full rule set: boosters, shouting, negation, set phrases, ``but`` and punctuation.

    Each word is lower-cased and looked up once; the rules run on the few that hit. An emoji counts as the
    words of its name, an emoticon as a word of the lexicon.
    """
    text = emoji_to_words(F.coalesce(text, F.lit("")), emoji)

    def with_lows(known: Column) -> Column:
        words, lows, valences, but_at = known["words"], known["lows"], known["valences"], known["but_at"]

        def weighed(at: Column) -> Column:
            weight = (
                F.when((but_at < 0) | (at == but_at), F.lit(1.0))
                .when(at < but_at, F.lit(BUT_BEFORE))
                .otherwise(F.lit(BUT_AFTER))
            )
            return _valence_in_context(_Context(words, lows, valences, at)) * weight

        hits = F.filter(
            F.transform(valences, lambda v, i: F.when(v.isNotNull(), i)), lambda i: i.isNotNull()
        )
        return _total(F.transform(hits, weighed))

    def from_lows(pair: Column) -> Column:
        but_at = F.array_position(pair["lows"], "but").cast("int") - 1
        valences = F.transform(pair["lows"], lambda w: dictionary_lookup(w, lexicon, "double"))
        known = [pair["words"].alias("words"), pair["lows"].alias("lows"), valences.alias("valences"), but_at.alias("but_at")]
        return let(F.struct(*known), with_lows)

    def from_words(words: Column) -> Column:
        lows = F.transform(words, F.lower)
        return let(F.struct(words.alias("words"), lows.alias("lows")), from_lows)

    def emphasised(total: Column) -> Column:
        mark = F.signum(total) * _punctuation(text)
        return let(total + mark, lambda s: F.round(normalized(s), 4))

    return let(let(sentiment_words(text), from_words), emphasised)


def threshold_label(score: Column, threshold: float = S.LABEL_THRESHOLD) -> Column:
    return let(
        score,
        lambda s: F.when(s >= threshold, F.lit("positive"))
        .when(s <= -threshold, F.lit("negative"))
        .otherwise(F.lit("neutral")),
    )
