"""Porter's suffix stripping (M. F. Porter, 1980) for one word."""

from __future__ import annotations

import re

# The suffix lists of the published algorithm.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]


def _longest_first(suffixes) -> tuple[str, ...]:
    return tuple(sorted(suffixes, key=len, reverse=True))


_END_2, _END_3, _END_4 = _longest_first(STEP_2), _longest_first(STEP_3), _longest_first(STEP_4)

# Every step looks at an ending: one of these letters, or a listed suffix.
_ENDS_1 = frozenset("sye")
_ENDS_2 = frozenset(s[-2:] for s in (*STEP_2, *STEP_3, *STEP_4, "ed", "ing", "ll"))

# A word is kept with its consonant y written as Y, so that y is always a vowel.
_VOWEL = re.compile("[aeiouy]")
_VC = re.compile("[aeiouy]+[^aeiouy]+")
_DOUBLE = re.compile(r"([^aeiouy])\1$")
_CVC = re.compile("[^aeiouy][aeiouy][^aeiouywxY]$")


def _mark_consonant_y(word: str) -> str:
    if "y" not in word:
        return word
    word = re.sub("^y", "Y", word)
    word = re.sub("([aeiou])y", r"\1Y", word)
    return word.replace("yy", "yY")


def _measure(part: str) -> int:
    return len(_VC.findall(part))


def _split(word: str, suffixes: tuple[str, ...]) -> tuple[str, str]:
    """The word without its longest listed suffix, and that suffix."""
    if word.endswith(suffixes):
        suffix = next(s for s in suffixes if word.endswith(s))
        return word[: -len(suffix)], suffix
    return word, ""


def _swap(word: str, suffixes: tuple[str, ...], endings: dict[str, str]) -> str:
    root, suffix = _split(word, suffixes)
    return root + endings[suffix] if suffix and _measure(root) > 0 else word


def _plural(word: str) -> str:
    if word.endswith("sses") or word.endswith("ies"):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def _past(word: str) -> str:
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        if word.endswith(suffix) and _VOWEL.search(root := word[: -len(suffix)]):
            if root.endswith(("at", "bl", "iz")):
                return root + "e"
            if _DOUBLE.search(root) and root[-1] not in "lsz":
                return root[:-1]
            return root + "e" if _measure(root) == 1 and _CVC.search(root) else root
    return word


def _residue(word: str) -> str:
    root, suffix = _split(word, _END_4)
    if not suffix or _measure(root) <= 1 or (suffix == "ion" and not root.endswith(("s", "t"))):
        return word
    return root


def _final(word: str) -> str:
    if word.endswith("e"):
        root = word[:-1]
        m = _measure(root)
        if m > 1 or (m == 1 and not _CVC.search(root)):
            word = root
    return word[:-1] if word.endswith("ll") and _measure(word) > 1 else word


def stem(word: str | None) -> str | None:
    """Stem of a lower-case word; words of one or two letters stay as they are."""
    if word is None or len(word) <= 2:
        return word
    if word[-1] not in _ENDS_1 and word[-2:] not in _ENDS_2:
        return word.lower()
    word = _past(_plural(_mark_consonant_y(word)))
    if word[-1] in "yY" and _VOWEL.search(word[:-1]):
        word = word[:-1] + "i"
    word = _swap(word, _END_2, STEP_2)
    word = _swap(word, _END_3, STEP_3)
    return _final(_residue(word)).lower()
