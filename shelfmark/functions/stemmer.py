"""English (Porter2 / Snowball) stemmer: the one piece of Python in the text search.

It is applied to lexemes of the 'english' text configuration.  Words are memoised per
worker process, so in a partition of text only each distinct word is stemmed once; the
rest is a dictionary lookup.  The algorithm follows the published Porter2 description
(R1/R2 regions, steps 0-5 and the two exception lists).
"""

from __future__ import annotations

from functools import lru_cache

_VOWELS = frozenset("aeiouy")
_DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
_LI_ENDINGS = frozenset("cdeghkmnrt")

# Whole-word exceptions of the published algorithm.
_EXCEPTIONS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
# Words left alone after step 1a.
_EXCEPTIONS_1A = frozenset(["inning", "outing", "canning", "herring", "earring",
                            "proceed", "exceed", "succeed"])
# Prefixes whose R1 starts right after them.
_R1_PREFIXES = ("gener", "commun", "arsen")

# Step 2 suffixes (longest first) and replacements.
_STEP2 = [
    ("ization", "ize"), ("ational", "ate"), ("fulness", "ful"), ("ousness", "ous"),
    ("iveness", "ive"), ("tional", "tion"), ("biliti", "ble"), ("lessli", "less"),
    ("entli", "ent"), ("ation", "ate"), ("alism", "al"), ("aliti", "al"), ("ousli", "ous"),
    ("iviti", "ive"), ("fulli", "ful"), ("enci", "ence"), ("anci", "ance"), ("abli", "able"),
    ("izer", "ize"), ("ator", "ate"), ("alli", "al"), ("bli", "ble"), ("ogi", "og"), ("li", ""),
]
# Step 3 suffixes (longest first) and replacements.
_STEP3 = [
    ("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"),
    ("ative", ""), ("ical", "ic"), ("ness", ""), ("ful", ""),
]
# Step 4 suffixes (longest first).
_STEP4 = [
    "ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous",
    "ive", "ize", "ion", "al", "er", "ic",
]


def _is_vowel(word: str, i: int) -> bool:
    return word[i] in _VOWELS


def _regions(word: str) -> tuple[int, int]:
    def after_vc(start: int) -> int:
        for i in range(start + 1, len(word)):
            if not _is_vowel(word, i) and _is_vowel(word, i - 1):
                return i + 1
        return len(word)

    r1 = None
    for prefix in _R1_PREFIXES:
        if word.startswith(prefix):
            r1 = len(prefix)
            break
    if r1 is None:
        r1 = after_vc(0)
    r2 = after_vc(r1) if r1 < len(word) else len(word)
    return r1, r2


def _short_syllable_at_end(word: str) -> bool:
    n = len(word)
    if n == 2:
        return _is_vowel(word, 0) and not _is_vowel(word, 1)
    if n >= 3:
        return (not _is_vowel(word, n - 3) and _is_vowel(word, n - 2)
                and not _is_vowel(word, n - 1) and word[n - 1] not in "wxY")
    return False


def _contains_vowel(s: str) -> bool:
    return any(c in _VOWELS for c in s)


@lru_cache(maxsize=1 << 18)
def stem(word: str) -> str:
    """Porter2 stem of one lower-case word."""
    if len(word) <= 2:
        return word
    if word in _EXCEPTIONS:
        return _EXCEPTIONS[word]
    if word.startswith("'"):
        word = word[1:]
    # Mark consonant y: initial y, and y after a vowel.
    chars = list(word)
    for i, c in enumerate(chars):
        if c == "y" and (i == 0 or chars[i - 1] in _VOWELS):
            chars[i] = "Y"
    word = "".join(chars)
    r1, r2 = _regions(word)

    # Step 0: possessive apostrophes.
    for suf in ("'s'", "'s", "'"):
        if word.endswith(suf):
            word = word[: -len(suf)]
            break

    # Step 1a.
    if word.endswith("sses"):
        word = word[:-2]
    elif word.endswith("ied") or word.endswith("ies"):
        word = word[:-2] if len(word) > 4 else word[:-1]
    elif word.endswith("us") or word.endswith("ss"):
        pass
    elif word.endswith("s"):
        if _contains_vowel(word[:-2]):
            word = word[:-1]
    if word in _EXCEPTIONS_1A:
        return word

    # Step 1b.
    for suf in ("eedly", "ingly", "edly", "eed", "ing", "ed"):
        if word.endswith(suf):
            stem_part = word[: -len(suf)]
            if suf in ("eed", "eedly"):
                if len(stem_part) >= r1:
                    word = stem_part + "ee"
            elif _contains_vowel(stem_part):
                word = stem_part
                if word.endswith(("at", "bl", "iz")):
                    word += "e"
                elif word.endswith(_DOUBLES):
                    word = word[:-1]
                elif r1 >= len(word) and _short_syllable_at_end(word):
                    word += "e"
            break

    # Step 1c.
    if len(word) > 2 and word[-1] in "yY" and not _is_vowel(word, len(word) - 2):
        word = word[:-1] + "i"

    # Step 2.
    for suf, rep in _STEP2:
        if word.endswith(suf):
            if len(word) - len(suf) >= r1:
                if suf == "ogi":
                    if word[-4:-3] == "l":
                        word = word[:-3] + rep
                elif suf == "li":
                    if len(word) >= 3 and word[-3] in _LI_ENDINGS:
                        word = word[:-2]
                else:
                    word = word[: -len(suf)] + rep
            break

    # Step 3.
    for suf, rep in _STEP3:
        if word.endswith(suf):
            if len(word) - len(suf) >= r1:
                if suf == "ative":
                    if len(word) - len(suf) >= r2:
                        word = word[:-5]
                else:
                    word = word[: -len(suf)] + rep
            break

    # Step 4.
    for suf in _STEP4:
        if word.endswith(suf):
            if len(word) - len(suf) >= r2:
                if suf == "ion":
                    if len(word) >= 4 and word[-4] in "st":
                        word = word[:-3]
                else:
                    word = word[: -len(suf)]
            break

    # Step 5.
    if word.endswith("e"):
        at = len(word) - 1
        if at >= r2 or (at >= r1 and not _short_syllable_at_end(word[:-1])):
            word = word[:-1]
    elif word.endswith("l"):
        if len(word) - 1 >= r2 and word[-2:-1] == "l":
            word = word[:-1]

    return word.replace("Y", "y")
