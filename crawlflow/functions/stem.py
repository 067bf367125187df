"""Porter's stemmer and its English successor, from their published definitions.

Small helpers for one word; they are called once per distinct word of a task.
"""

from __future__ import annotations

import re

# Suffix tables of the 1980 algorithm, with the two later changes of its author.
PORTER_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize",
    "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful",
    "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble", "logi": "log",
}
PORTER_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
PORTER_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
)

# Suffix tables and exceptions of the English algorithm.
ENGLISH_2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent",
    "izer": "ize", "ization": "ize", "ational": "ate", "ation": "ate", "ator": "ate",
    "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous",
    "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble",
    "ogi": "og", "fulli": "ful", "lessli": "less", "li": "",
}
ENGLISH_3 = {
    "tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic",
    "ical": "ic", "ful": "", "ness": "", "ative": "",
}
ENGLISH_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism",
    "ate", "iti", "ous", "ive", "ize", "ion",
)
ENGLISH_SPECIAL = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
ENGLISH_KEPT = (
    "inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed",
)


def _ending(word: str, endings) -> str:
    """The longest of ``endings`` that ``word`` ends with, or ``''``."""
    if not word.endswith(tuple(endings)):
        return ""
    return max((e for e in endings if word.endswith(e)), key=len)


def _shape(stem: str) -> str:
    """Consonants as ``c`` and vowels as ``v``; y is a vowel after a consonant."""
    shape = ""
    for letter in stem:
        shape += "v" if letter in "aeiou" or (letter == "y" and shape[-1:] == "c") else "c"
    return shape


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _closed(stem: str) -> bool:
    """Ends consonant, vowel, consonant, the last one not w, x or y."""
    return _shape(stem).endswith("cvc") and stem[-1] not in "wxy"


def _doubled(stem: str) -> bool:
    return len(stem) > 1 and stem[-1] == stem[-2] and _shape(stem)[-1] == "c"


def _porter_replace(word: str, table: dict[str, str]) -> str:
    end = _ending(word, table)
    stem = word[: len(word) - len(end)]
    return stem + table[end] if end and _measure(stem) > 0 else word


def porter(word: str) -> str:
    if len(word) <= 2:
        return word
    if word.endswith("sses") or word.endswith("ies"):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    end = _ending(word, ("eed", "ed", "ing"))
    stem = word[: len(word) - len(end)]
    if end == "eed":
        word = word[:-1] if _measure(stem) > 0 else word
    elif end and "v" in _shape(stem):
        word = stem
        if word.endswith(("at", "bl", "iz")):
            word += "e"
        elif _doubled(word):
            word = word if word[-1] in "lsz" else word[:-1]
        elif _measure(word) == 1 and _closed(word):
            word += "e"
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    word = _porter_replace(_porter_replace(word, PORTER_2), PORTER_3)
    end = _ending(word, PORTER_4)
    stem = word[: len(word) - len(end)]
    if end and _measure(stem) > 1 and (end != "ion" or stem[-1:] in ("s", "t")):
        word = stem
    if word.endswith("e"):
        size = _measure(word)
        if size > 1 or (size == 1 and not _closed(word[:-1])):
            word = word[:-1]
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word


VOWEL, OTHER = "[aeiouy]", "[^aeiouy]"
SHORT_END = re.compile(f"(?:{OTHER}{VOWEL}[^aeiouywxY]|^{VOWEL}{OTHER})$")
REGION = re.compile(f".*?{VOWEL}{OTHER}")
REGION_SPECIAL = re.compile("gener|commun|arsen")


def _regions(word: str) -> tuple[int, int]:
    """Starts of the regions after the first and the second vowel and non-vowel pair."""
    first = REGION_SPECIAL.match(word) or REGION.match(word)
    r1 = first.end() if first else len(word)
    second = REGION.match(word, r1)
    return r1, second.end() if second else len(word)


def english(word: str) -> str:
    if len(word) <= 2:
        return word
    if word in ENGLISH_SPECIAL:
        return ENGLISH_SPECIAL[word]
    word = word.removeprefix("'")
    if "y" in word:
        word = re.sub(f"(^|{VOWEL})y", r"\1Y", word)
    r1, r2 = _regions(word)
    end = _ending(word, ("'", "'s", "'s'"))
    word = word[: len(word) - len(end)]
    end = _ending(word, ("sses", "ied", "ies", "us", "ss", "s"))
    if end == "sses":
        word = word[:-2]
    elif end in ("ied", "ies"):
        word = word[:-2] if len(word) > 4 else word[:-1]
    elif end == "s" and re.search(VOWEL, word[:-2]):
        word = word[:-1]
    if word in ENGLISH_KEPT:
        return word
    end = _ending(word, ("eed", "eedly", "ed", "edly", "ing", "ingly"))
    stem = word[: len(word) - len(end)]
    if end in ("eed", "eedly"):
        word = stem + "ee" if len(stem) >= r1 else word
    elif end and re.search(VOWEL, stem):
        word = stem
        if word.endswith(("at", "bl", "iz")):
            word += "e"
        elif re.search("(?:bb|dd|ff|gg|mm|nn|pp|rr|tt)$", word):
            word = word[:-1]
        elif r1 >= len(word) and SHORT_END.search(word):
            word += "e"
    if word.endswith(("y", "Y")):
        word = re.sub(f"(.{OTHER})[yY]$", r"\1i", word)
    end = _ending(word, ENGLISH_2)
    stem = word[: len(word) - len(end)]
    if end and len(stem) >= r1:
        if end == "li":
            word = stem if stem[-1:] and stem[-1] in "cdeghkmnrt" else word
        elif end != "ogi" or stem.endswith("l"):
            word = stem + ENGLISH_2[end]
    end = _ending(word, ENGLISH_3)
    stem = word[: len(word) - len(end)]
    if end and len(stem) >= (r2 if end == "ative" else r1):
        word = stem + ENGLISH_3[end]
    end = _ending(word, ENGLISH_4)
    stem = word[: len(word) - len(end)]
    if end and len(stem) >= r2 and (end != "ion" or stem[-1:] in ("s", "t")):
        word = stem
    stem = word[:-1]
    if word.endswith("e"):
        if len(stem) >= r2 or (len(stem) >= r1 and not SHORT_END.search(stem)):
            word = stem
    elif word.endswith("ll") and len(stem) >= r2:
        word = stem
    return word.replace("Y", "y")


def stem_twice(word: str) -> str:
    """The stem of the stem: the two algorithms one after the other."""
    return english(porter(word))
