"""The English stemmer that is known as Porter 2, after its published description, as a column function.

Words are lower-cased before.  Letters beyond ASCII and digits count as consonants.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the published algorithm.
VOWELS = "aeiouy"
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
LI_ENDINGS = "cdeghkmnrt"
R1_PREFIXES = ("gener", "commun", "arsen")
WHOLE_WORDS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl",
    "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
AFTER_STEP_1A = {"inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"}
STEP_2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize", "ization": "ize", "ational": "ate", "ation": "ate", "ator": "ate",
    "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble",
    "ogi": "og", "fulli": "ful", "lessli": "less", "li": "",
}
STEP_3 = {"tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": "", "ative": ""}
STEP_4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion")


def _region(word: str, start: int) -> int:
    """Where the part after the first consonant that follows a vowel begins, from a place on."""
    for i in range(start + 1, len(word)):
        if word[i] not in VOWELS and word[i - 1] in VOWELS:
            return i + 1
    return len(word)


def _ends_short(word: str) -> bool:
    """Does the word end in a short syllable?"""
    if len(word) == 2:
        return word[0] in VOWELS and word[1] not in VOWELS
    return len(word) > 2 and word[-1] not in VOWELS + "wxY" and word[-2] in VOWELS and word[-3] not in VOWELS


def _longest(word: str, endings) -> str:
    return max((e for e in endings if word.endswith(e)), key=len, default="")


def _has_vowel(word: str) -> bool:
    return any(c in VOWELS for c in word)


def _marked(word: str) -> str:
    """A y that is a consonant is written Y."""
    out = ""
    for i, c in enumerate(word):
        out += "Y" if c == "y" and (i == 0 or out[-1] in VOWELS) else c
    return out


def _step_1a(word: str) -> str:
    ending = _longest(word, ("sses", "ied", "ies", "us", "ss", "s"))
    if ending == "sses":
        return word[:-2]
    if ending in ("ied", "ies"):
        return word[:-2] if len(word) > 4 else word[:-1]
    return word[:-1] if ending == "s" and _has_vowel(word[:-2]) else word


def _step_1b(word: str, r1: int) -> str:
    ending = _longest(word, ("eed", "eedly", "ed", "edly", "ing", "ingly"))
    rest = word[: len(word) - len(ending)]
    if ending.startswith("ee"):
        return rest + "ee" if len(rest) >= r1 else word
    if not ending or not _has_vowel(rest):
        return word
    if rest.endswith(("at", "bl", "iz")) or (not rest.endswith(DOUBLES) and r1 >= len(rest) and _ends_short(rest)):
        return rest + "e"
    return rest[:-1] if rest.endswith(DOUBLES) else rest


@lru_cache(maxsize=200_000)
def stem_of(term: str) -> str:
    """The stem of one lower-case word."""
    if len(term) <= 2:
        return term
    if term in WHOLE_WORDS:
        return WHOLE_WORDS[term]
    word = _marked(term.removeprefix("'"))
    r1 = next((len(p) for p in R1_PREFIXES if word.startswith(p)), None) or _region(word, 0)
    r2 = _region(word, r1)
    for ending in ("'s'", "'s", "'"):
        word = word.removesuffix(ending)
    word = _step_1a(word)
    if word in AFTER_STEP_1A:
        return word
    word = _step_1b(word, r1)
    if len(word) > 2 and word[-1] in "yY" and word[-2] not in VOWELS:
        word = word[:-1] + "i"
    for endings in (STEP_2, STEP_3):
        ending = _longest(word, endings)
        rest = word[: len(word) - len(ending)]
        allowed = {"ogi": rest.endswith("l"), "li": rest[-1:] != "" and rest[-1:] in LI_ENDINGS, "ative": len(rest) >= r2}.get(ending, True)
        if ending and len(rest) >= r1 and allowed:
            word = rest + endings[ending]
    ending = _longest(word, STEP_4)
    rest = word[: len(word) - len(ending)]
    if ending and len(rest) >= r2 and (ending != "ion" or rest.endswith(("s", "t"))):
        word = rest
    rest = word[:-1]
    if word.endswith("e") and (len(rest) >= r2 or (len(rest) >= r1 and not _ends_short(rest))) or word.endswith("ll") and len(rest) >= r2:
        word = rest
    return word.replace("Y", "y")


def english_stem(term: Column) -> Column:
    """Stems of a column of lower-case words; each distinct word of a batch is worked out once."""

    @F.arrow_udf("string")
    def stems(terms: pa.Array) -> pa.Array:
        coded = terms.dictionary_encode()
        known = pa.array([stem_of(t) for t in coded.dictionary.to_pylist()], pa.string())
        return known.take(coded.indices)

    return stems(term)
