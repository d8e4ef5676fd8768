"""The English suffix stemmer of full-text search (the published Porter2 rules).

A small helper for `functions.text.stemmed`, which calls it inside the tasks on distinct words.
"""

from __future__ import annotations

import re
from functools import lru_cache

# The exceptional forms, regions, endings and suffix tables of the published rules.
SPECIAL = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl",
    "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl",
    "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos",
    "bias": "bias", "andes": "andes",
}
SETTLED = frozenset("inning outing canning herring earring proceed exceed succeed".split())
PREFIXES = re.compile(r"gener|commun|arsen")
VOWEL = "[aeiouy]"
REGION = re.compile(f"{VOWEL}[^aeiouy]")
SHORT_END = re.compile(r"(?:^|.*[^aeiouy])[aeiouy][^aeiouywxY]$|^[aeiouy][^aeiouy]$")
DOUBLE = re.compile(r"(?:bb|dd|ff|gg|mm|nn|pp|rr|tt)$")
STEP_2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent",
    "izer": "ize", "ization": "ize", "ational": "ate", "ation": "ate", "ator": "ate",
    "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous",
    "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble",
    "fulli": "ful", "lessli": "less",
}
STEP_3 = {
    "tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic",
    "ical": "ic", "ful": "", "ness": "",
}
STEP_4 = tuple(
    "al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize".split()
)


def _region_after(word: str, start: int) -> int:
    found = REGION.search(word, start)
    return found.end() if found else len(word)


def _longest(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def _plural(word: str) -> str:
    if word.endswith("sses"):
        return word[:-2]
    if word.endswith(("ied", "ies")):
        return word[:-2] if len(word) > 4 else word[:-1]
    if word.endswith(("us", "ss")):
        return word
    if word.endswith("s") and re.search(VOWEL, word[:-2]):
        return word[:-1]
    return word


def _past(word: str, r1: int) -> str:
    suffix = _longest(word, ("eed", "eedly", "ed", "edly", "ing", "ingly"))
    if suffix is None:
        return word
    stem = word[: -len(suffix)]
    if suffix in ("eed", "eedly"):
        return stem + "ee" if len(stem) >= r1 else word
    if not re.search(VOWEL, stem):
        return word
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if DOUBLE.search(stem):
        return stem[:-1]
    if r1 >= len(stem) and SHORT_END.search(stem):
        return stem + "e"
    return stem


def _derived(word: str, r1: int, r2: int) -> str:
    suffix = _longest(word, (*STEP_2, "ogi", "li"))
    if suffix and len(word) - len(suffix) >= r1:
        stem = word[: -len(suffix)]
        if suffix in STEP_2:
            word = stem + STEP_2[suffix]
        elif (suffix == "ogi" and stem.endswith("l")) or (
            suffix == "li" and stem.endswith(tuple("cdeghkmnrt"))
        ):
            word = stem + ("og" if suffix == "ogi" else "")
    suffix = _longest(word, (*STEP_3, "ative"))
    if suffix and len(word) - len(suffix) >= r1:
        if suffix in STEP_3:
            word = word[: -len(suffix)] + STEP_3[suffix]
        elif len(word) - len(suffix) >= r2:
            word = word[: -len(suffix)]
    suffix = _longest(word, (*STEP_4, "ion"))
    if suffix and len(word) - len(suffix) >= r2:
        stem = word[: -len(suffix)]
        if suffix != "ion" or stem.endswith(("s", "t")):
            word = stem
    return word


@lru_cache(maxsize=100_000)
def stem(word: str) -> str:
    """The stem of a lower-case word."""
    if len(word) <= 2:
        return word
    if word in SPECIAL:
        return SPECIAL[word]
    word = re.sub(rf"^y|(?<={VOWEL})y", "Y", word)
    start = PREFIXES.match(word)
    r1 = start.end() if start else _region_after(word, 0)
    r2 = _region_after(word, r1)
    word = _plural(word)
    if word in SETTLED:
        return word
    word = _past(word, r1)
    word = re.sub(r"(?<=.[^aeiouyY])[yY]$", "i", word)
    word = _derived(word, r1, r2)
    if word.endswith("e"):
        cut = len(word) - 1
        if cut >= r2 or (cut >= r1 and not SHORT_END.search(word[:-1])):
            word = word[:-1]
    elif word.endswith("ll") and len(word) - 1 >= r2:
        word = word[:-1]
    return word.lower()
