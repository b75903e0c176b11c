"""The Porter stemmer (M. F. Porter, 1980) with the extensions usual in summary scoring."""

from __future__ import annotations

from functools import lru_cache

# Irregular words and the rule lists of the published algorithm.
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}
STEP2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("fulli", "ful"), ("logi", "log"),
]
STEP3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""),
]
STEP4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism",
    "ate", "iti", "ous", "ive", "ize",
]


def _shape(word: str) -> str:
    """``c`` or ``v`` per letter; y counts as a vowel after a consonant."""
    out = ""
    for i, ch in enumerate(word):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and out[-1] == "c")
        out += "v" if vowel else "c"
    return out


def _measure(word: str) -> int:
    return _shape(word).count("vc")


def _short_end(word: str) -> bool:
    """Ends consonant-vowel-consonant with a last letter other than w, x, y; or is vowel-consonant."""
    shape = _shape(word)
    return (shape.endswith("cvc") and word[-1] not in "wxy") or shape == "vc"


def _plural(word: str) -> str:
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("sses"):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for end in ("ed", "ing"):
        if word.endswith(end):
            base = word[: -len(end)]
            break
    else:
        return word
    if "v" not in _shape(base):
        return word
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if len(base) > 1 and base[-1] == base[-2] and _shape(base)[-1] == "c":
        return base if base[-1] in "lsz" else base[:-1]
    return base + "e" if _measure(base) == 1 and _short_end(base) else base


def _replace(word: str, rules: list[tuple[str, str]]) -> str:
    """The first rule whose ending fits decides, whether or not its condition holds."""
    for end, new in rules:
        if word.endswith(end):
            base = word[: -len(end)]
            tested = word[:-3] if end == "logi" else base
            return base + new if _measure(tested) > 0 else word
    return word


def _derived(word: str) -> str:
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _derived(word[:-2])
    return _replace(word, STEP2)


def _suffix(word: str) -> str:
    for end in STEP4:
        if word.endswith(end):
            base = word[: -len(end)]
            fits = _measure(base) > 1 and (end != "ion" or base[-1:] in ("s", "t"))
            return base if fits else word
    return word


def _tidy(word: str) -> str:
    if word.endswith("e"):
        base = word[:-1]
        m = _measure(base)
        if m > 1 or (m == 1 and not _short_end(base)):
            word = base
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word


@lru_cache(maxsize=1 << 16)
def stem(word: str) -> str:
    word = word.lower()
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    word = _past(_plural(word))
    if word.endswith("y") and len(word) > 2 and _shape(word)[-2] == "c":
        word = word[:-1] + "i"
    return _tidy(_suffix(_replace(_derived(word), STEP3)))
