"""The published English stemmer (the second version of the suffix-stripping algorithm), word by word with a cache."""

from __future__ import annotations

import re
from functools import lru_cache

_VOWELS = "aeiouy"
_DOUBLE = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
_LI = set("cdeghkmnrt")
#: Fixed values of the algorithm: words with a stem of their own, and words that stay as they are.
_SPECIAL = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl"}
_SAME = {"sky", "news", "howe", "atlas", "cosmos", "bias", "andes"}
_STOP_1A = {"inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"}
_STEP2 = (
    ("ization", "ize"), ("ational", "ate"), ("fulness", "ful"), ("ousness", "ous"), ("iveness", "ive"), ("tional", "tion"), ("biliti", "ble"), ("lessli", "less"), ("entli", "ent"), ("ation", "ate"), ("alism", "al"),
    ("aliti", "al"), ("ousli", "ous"), ("iviti", "ive"), ("fulli", "ful"), ("enci", "ence"), ("anci", "ance"), ("abli", "able"), ("izer", "ize"), ("ator", "ate"), ("alli", "al"), ("bli", "ble"), ("ogi", "og"), ("li", ""),
)
_STEP3 = (("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"), ("ative", ""), ("ical", "ic"), ("ness", ""), ("ful", ""))
_STEP4 = ("ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion", "al", "er", "ic")


def _regions(word: str) -> tuple[int, int]:
    """Starts of the two regions behind the first and the second consonant that follows a vowel."""
    at = next((len(p) for p in ("gener", "commun", "arsen") if word.startswith(p)), None)
    r1 = at if at is not None else _behind(word, 0)
    return r1, _behind(word, r1)


def _behind(word: str, start: int) -> int:
    for i in range(start + 1, len(word)):
        if word[i] not in _VOWELS and word[i - 1] in _VOWELS:
            return i + 1
    return len(word)


def _short_end(word: str) -> bool:
    """Whether a word ends in a short syllable."""
    if len(word) == 2:
        return word[0] in _VOWELS and word[1] not in _VOWELS
    return len(word) > 2 and word[-1] not in _VOWELS + "wxY" and word[-2] in _VOWELS and word[-3] not in _VOWELS


def _has_vowel(part: str) -> bool:
    return any(c in _VOWELS for c in part)


@lru_cache(maxsize=200_000)
def stem(word: str) -> str:
    """The stem of a lower-cased word."""
    if word in _SPECIAL:
        return _SPECIAL[word]
    if len(word) < 3 or word in _SAME:
        return word
    w = word.removeprefix("'")
    # a y that begins the word or follows a vowel is a consonant
    w = re.sub(r"(?<=[aeiouy])y|^y", "Y", w)
    r1, r2 = _regions(w)
    for end in ("'s'", "'s", "'"):
        if w.endswith(end):
            w = w[: -len(end)]
            break
    # plural
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith(("ied", "ies")):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith("s") and not w.endswith(("us", "ss")) and _has_vowel(w[:-2]):
        w = w[:-1]
    if w in _STOP_1A:
        return w.lower()
    # past and present participles
    end = next((e for e in ("eedly", "ingly", "edly", "eed", "ing", "ed") if w.endswith(e)), "")
    if end in ("eed", "eedly"):
        if len(w) - len(end) >= r1:
            w = w[: -len(end)] + "ee"
    elif end and _has_vowel(w[: -len(end)]):
        w = w[: -len(end)]
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif w.endswith(_DOUBLE):
            w = w[:-1]
        elif r1 >= len(w) and _short_end(w):
            w += "e"
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in _VOWELS:
        w = w[:-1] + "i"
    # derivations, the longest suffix first
    for end, new in _STEP2:
        if w.endswith(end):
            if len(w) - len(end) >= r1 and (end != "ogi" or w[-4:-3] == "l") and (end != "li" or w[-3:-2] in _LI):
                w = w[: len(w) - len(end)] + new
            break
    for end, new in _STEP3:
        if w.endswith(end):
            if len(w) - len(end) >= (r2 if end == "ative" else r1):
                w = w[: len(w) - len(end)] + new
            break
    for end in _STEP4:
        if w.endswith(end):
            if len(w) - len(end) >= r2 and (end != "ion" or w[-4:-3] in ("s", "t")):
                w = w[: len(w) - len(end)]
            break
    if w.endswith("e"):
        if len(w) - 1 >= r2 or (len(w) - 1 >= r1 and not _short_end(w[:-1])):
            w = w[:-1]
    elif w.endswith("ll") and len(w) - 1 >= r2:
        w = w[:-1]
    return w.lower()
