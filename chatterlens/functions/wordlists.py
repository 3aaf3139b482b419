"""Default dictionaries. Every one is a parameter of the function that uses it.

The slang default is complete. The emoji default names every emoji of Unicode by rule. Other dictionaries are
data: load them with ``sources.files.read_dictionary`` and pass them as ``slang=`` / ``emoji=`` / ``lexicon=``.
"""

from __future__ import annotations

import unicodedata

import regex

# Abbreviation -> expansion, keys compared with the lower-cased word.
SLANG = {
    "$": " dollar ",
    "€": " euro ",
    "4ao": "for adults only",
    "a.m": "before midday",
    "a3": "anytime anywhere anyplace",
    "aamof": "as a matter of fact",
    "acct": "account",
    "adih": "another day in hell",
    "afaic": "as far as i am concerned",
    "afaict": "as far as i can tell",
    "afaik": "as far as i know",
    "afair": "as far as i remember",
    "afk": "away from keyboard",
    "app": "application",
    "approx": "approximately",
    "apps": "applications",
    "asap": "as soon as possible",
    "asl": "age, sex, location",
    "atk": "at the keyboard",
    "ave.": "avenue",
    "aymm": "are you my mother",
    "ayor": "at your own risk",
    "b&b": "bed and breakfast",
    "b+b": "bed and breakfast",
    "b.c": "before christ",
    "b2b": "business to business",
    "b2c": "business to customer",
    "b4": "before",
    "b4n": "bye for now",
    "b@u": "back at you",
    "bae": "before anyone else",
    "bak": "back at keyboard",
    "bbbg": "bye bye be good",
    "bbc": "british broadcasting corporation",
    "bbias": "be back in a second",
    "bbl": "be back later",
    "bbs": "be back soon",
    "be4": "before",
    "bfn": "bye for now",
    "blvd": "boulevard",
    "bout": "about",
    "brb": "be right back",
    "bros": "brothers",
    "brt": "be right there",
    "bsaaw": "big smile and a wink",
    "btw": "by the way",
    "bwl": "bursting with laughter",
    "c/o": "care of",
    "cet": "central european time",
    "cf": "compare",
    "cia": "central intelligence agency",
    "csl": "can not stop laughing",
    "cu": "see you",
    "cul8r": "see you later",
    "cv": "curriculum vitae",
    "cwot": "complete waste of time",
    "cya": "see you",
    "cyt": "see you tomorrow",
    "dae": "does anyone else",
    "dbmib": "do not bother me i am busy",
    "diy": "do it yourself",
    "dm": "direct message",
    "dwh": "during work hours",
    "e123": "easy as one two three",
    "eet": "eastern european time",
    "eg": "example",
    "embm": "early morning business meeting",
    "encl": "enclosed",
    "encl.": "enclosed",
    "etc": "and so on",
    "faq": "frequently asked questions",
    "fawc": "for anyone who cares",
    "fb": "facebook",
    "fc": "fingers crossed",
    "fig": "figure",
    "fimh": "forever in my heart",
    "ft.": "feet",
    "ft": "featuring",
    "ftl": "for the loss",
    "ftw": "for the win",
    "fwiw": "for what it is worth",
    "fyi": "for your information",
    "g9": "genius",
    "gahoy": "get a hold of yourself",
    "gal": "get a life",
    "gcse": "general certificate of secondary education",
    "gfn": "gone for now",
    "gg": "good game",
    "gl": "good luck",
    "glhf": "good luck have fun",
    "gmt": "greenwich mean time",
    "gmta": "great minds think alike",
    "gn": "good night",
    "g.o.a.t": "greatest of all time",
    "goat": "greatest of all time",
    "goi": "get over it",
    "gps": "global positioning system",
    "gr8": "great",
    "gratz": "congratulations",
    "gyal": "girl",
    "h&c": "hot and cold",
    "hp": "horsepower",
    "hr": "hour",
    "hrh": "his royal highness",
    "ht": "height",
    "ibrb": "i will be right back",
    "ic": "i see",
    "icq": "i seek you",
    "icymi": "in case you missed it",
    "idc": "i do not care",
    "idgadf": "i do not give a damn fuck",
    "idgaf": "i do not give a fuck",
    "idk": "i do not know",
    "ie": "that is",
    "i.e": "that is",
    "ifyp": "i feel your pain",
    "IG": "instagram",
    "iirc": "if i remember correctly",
    "ilu": "i love you",
    "ily": "i love you",
    "imho": "in my humble opinion",
    "imo": "in my opinion",
    "imu": "i miss you",
    "iow": "in other words",
    "irl": "in real life",
    "j4f": "just for fun",
    "jic": "just in case",
    "jk": "just kidding",
    "jsyk": "just so you know",
    "l8r": "later",
    "lb": "pound",
    "lbs": "pounds",
    "ldr": "long distance relationship",
    "lmao": "laugh my ass off",
    "lmfao": "laugh my fucking ass off",
    "lol": "laughing out loud",
    "ltd": "limited",
    "ltns": "long time no see",
    "m8": "mate",
    "mf": "motherfucker",
    "mfs": "motherfuckers",
    "mfw": "my face when",
    "mofo": "motherfucker",
    "mph": "miles per hour",
    "mr": "mister",
    "mrw": "my reaction when",
    "ms": "miss",
    "mte": "my thoughts exactly",
    "nagi": "not a good idea",
    "nbc": "national broadcasting company",
    "nbd": "not big deal",
    "nfs": "not for sale",
    "ngl": "not going to lie",
    "nhs": "national health service",
    "nrn": "no reply necessary",
    "nsfl": "not safe for life",
    "nsfw": "not safe for work",
    "nth": "nice to have",
    "nvr": "never",
    "nyc": "new york city",
    "oc": "original content",
    "og": "original",
    "ohp": "overhead projector",
    "oic": "oh i see",
    "omdb": "over my dead body",
    "omg": "oh my god",
    "omw": "on my way",
    "p.a": "per annum",
    "p.m": "after midday",
    "pm": "prime minister",
    "poc": "people of color",
    "pov": "point of view",
    "pp": "pages",
    "ppl": "people",
    "prw": "parents are watching",
    "ps": "postscript",
    "pt": "point",
    "ptb": "please text back",
    "pto": "please turn over",
    "qpsa": "what happens",
    "ratchet": "rude",
    "rbtl": "read between the lines",
    "rlrt": "real life retweet",
    "rofl": "rolling on the floor laughing",
    "roflol": "rolling on the floor laughing out loud",
    "rotflmao": "rolling on the floor laughing my ass off",
    "rt": "retweet",
    "ruok": "are you ok",
    "sfw": "safe for work",
    "sk8": "skate",
    "smh": "shake my head",
    "sq": "square",
    "srsly": "seriously",
    "ssdd": "same stuff different day",
    "tbh": "to be honest",
    "tbs": "tablespooful",
    "tbsp": "tablespooful",
    "tfw": "that feeling when",
    "thks": "thank you",
    "tho": "though",
    "thx": "thank you",
    "tia": "thanks in advance",
    "til": "today i learned",
    "tl;dr": "too long i did not read",
    "tldr": "too long i did not read",
    "tmb": "tweet me back",
    "tntl": "trying not to laugh",
    "ttyl": "talk to you later",
    "u": "you",
    "u2": "you too",
    "u4e": "yours for ever",
    "utc": "coordinated universal time",
    "w/": "with",
    "w/o": "without",
    "w8": "wait",
    "wassup": "what is up",
    "wb": "welcome back",
    "wtf": "what the fuck",
    "wtg": "way to go",
    "wtpa": "where the party at",
    "wuf": "where are you from",
    "wuzup": "what is up",
    "wywh": "wish you were here",
    "yd": "yard",
    "ygtr": "you got that right",
    "ynk": "you never know",
    "zzz": "sleeping bored and tired",
}

# Emoji sequence -> its common short name, where that differs from the Unicode name.
EMOJI_SHORT_NAMES = {
    "😀": "grinning_face",
    "😁": "beaming_face_with_smiling_eyes",
    "😂": "face_with_tears_of_joy",
    "🤣": "rolling_on_the_floor_laughing",
    "😃": "grinning_face_with_big_eyes",
    "😄": "grinning_face_with_smiling_eyes",
    "😅": "grinning_face_with_sweat",
    "😉": "winking_face",
    "😊": "smiling_face_with_smiling_eyes",
    "😍": "smiling_face_with_heart-eyes",
    "😎": "smiling_face_with_sunglasses",
    "😘": "face_blowing_a_kiss",
    "🙂": "slightly_smiling_face",
    "🤔": "thinking_face",
    "😐": "neutral_face",
    "🙄": "face_with_rolling_eyes",
    "😏": "smirking_face",
    "😴": "sleeping_face",
    "😒": "unamused_face",
    "😢": "crying_face",
    "😭": "loudly_crying_face",
    "😡": "enraged_face",
    "😠": "angry_face",
    "😱": "face_screaming_in_fear",
    "💀": "skull",
    "💩": "pile_of_poo",
    "👍": "thumbs_up",
    "👎": "thumbs_down",
    "👏": "clapping_hands",
    "🙏": "folded_hands",
    "💪": "flexed_biceps",
    "❤️": "red_heart",
    "❤": "red_heart",
    "💔": "broken_heart",
    "🔥": "fire",
    "💯": "hundred_points",
    "🎉": "party_popper",
    "🚀": "rocket",
    "✅": "check_mark_button",
    "❌": "cross_mark",
}
SKIN_TONES = {
    "\U0001f3fb": "light_skin_tone",
    "\U0001f3fc": "medium-light_skin_tone",
    "\U0001f3fd": "medium_skin_tone",
    "\U0001f3fe": "medium-dark_skin_tone",
    "\U0001f3ff": "dark_skin_tone",
}
_VARIATION = "\ufe0f"


def emoji_names(short_names: dict[str, str] = EMOJI_SHORT_NAMES) -> dict[str, str]:
    """Every emoji of Unicode with its name: the short name if given, else the Unicode name.

    Characters that show as text by default also come with the variation selector, those that take a skin
    tone with each of the five. Joined sequences and flags are named part by part.
    """
    names = {}
    for point in range(0x80, 0x20000):
        symbol = chr(point)
        if symbol in SKIN_TONES or not regex.match(r"\p{Emoji}", symbol):
            continue
        official = unicodedata.name(symbol, "").lower().replace(" ", "_")
        name = short_names.get(symbol, official)
        if not name:
            continue
        names[symbol] = name
        if not regex.match(r"\p{Emoji_Presentation}", symbol):
            names[symbol + _VARIATION] = name
        if regex.match(r"\p{Emoji_Modifier_Base}", symbol):
            names.update({symbol + tone: f"{name}_{of}" for tone, of in SKIN_TONES.items()})
    return names | SKIN_TONES | short_names


EMOJI = emoji_names()
