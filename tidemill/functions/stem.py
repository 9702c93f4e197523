"""Porter's suffix stripping as one Arrow UDF; it is applied to distinct words only.

``porter_stem`` follows the rules of 1980. With ``extended`` it also has the published later rules: irregular
words, short words in -ies and -ied, y only after a consonant, and -bli, -fulli and -logi.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_VOWEL = "(?:[aeiou]|(?<=[^aeiou])y)"
_CONSONANT = "(?:[^aeiouy]|(?:(?<=[aeiouy])|^)y)"
_MEASURE = re.compile(f"{_VOWEL}+{_CONSONANT}+")
_HAS_VOWEL = re.compile(_VOWEL)
_SHORT_END = re.compile("(?:[^aeiou])[aeiouy][^aeiouwxy]$")

# Suffix -> replacement, longest suffix first within each step.
STEP_2 = {"ational": "ate", "ization": "ize", "iveness": "ive", "fulness": "ful", "ousness": "ous", "tional": "tion",
          "biliti": "ble", "entli": "ent", "ousli": "ous", "ation": "ate", "alism": "al", "aliti": "al", "iviti": "ive",
          "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able", "alli": "al", "ator": "ate", "eli": "e"}
STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ness": "", "ful": ""}
STEP_4 = ["ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous", "ive", "ize",
          "ion", "al", "er", "ic", "ou"]
EXTENDED_STEP_2 = {**{s: r for s, r in STEP_2.items() if s != "abli"}, "fulli": "ful", "bli": "ble"}
IRREGULAR = {"sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
             "inning": "inning", "innings": "inning", "outing": "outing", "outings": "outing", "canning": "canning",
             "cannings": "canning", "howe": "howe", "proceed": "proceed", "exceed": "exceed", "succeed": "succeed"}


def _measure(stem: str) -> int:
    return len(_MEASURE.findall(stem))


def _replace_longest(word: str, rules: dict[str, str]) -> str:
    hit = next((s for s in rules if word.endswith(s)), None)
    if hit is None:
        return word
    stem = word[:len(word) - len(hit)]
    return stem + rules[hit] if _measure(stem) > 0 else word


def _short_end(stem: str, extended: bool) -> bool:
    """Consonant, vowel, consonant at the end; the extended rules also take a vowel and a consonant alone."""
    return bool(_SHORT_END.search(stem)) or (extended and len(stem) == 2 and bool(re.fullmatch("[aeiou][^aeiou]", stem)))


def _tidy(stem: str, extended: bool) -> str:
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if len(stem) > 1 and stem[-1] == stem[-2] and stem[-1] not in "aeioulsz":
        return stem[:-1]
    return stem + "e" if _measure(stem) == 1 and _short_end(stem, extended) else stem


def _plural(word: str, extended: bool) -> str:
    if extended and word.endswith("ies") and len(word) == 4:
        return word[:-1]
    if word.endswith(("sses", "ies")):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def _past(word: str, extended: bool) -> str:
    if extended and word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    ending = next((e for e in ("ing", "ed") if word.endswith(e)), None)
    if ending and _HAS_VOWEL.search(word[:-len(ending)]):
        return _tidy(word[:-len(ending)], extended)
    return word


def _last_y(word: str, extended: bool) -> str:
    stem = word[:-1]
    if extended:
        turns = len(stem) > 1 and re.search(f"{_CONSONANT}$", stem)
    else:
        turns = _HAS_VOWEL.search(stem)
    return stem + "i" if word.endswith("y") and turns else word


def _second(word: str, extended: bool) -> str:
    if not extended:
        return _replace_longest(word, STEP_2)
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _second(word[:-2], extended)
    if word.endswith("logi"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    return _replace_longest(word, EXTENDED_STEP_2)


def porter_stem(word: str, extended: bool = False) -> str:
    if extended and word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) < 3:
        return word
    word = _last_y(_past(_plural(word, extended), extended), extended)
    word = _replace_longest(_second(word, extended), STEP_3)
    ending = next((e for e in STEP_4 if word.endswith(e)), None)
    if ending:
        stem = word[:-len(ending)]
        if _measure(stem) > 1 and (ending != "ion" or stem.endswith(("s", "t"))):
            word = stem
    if word.endswith("e"):
        m = _measure(word[:-1])
        if m > 1 or (m == 1 and not _short_end(word[:-1], extended)):
            word = word[:-1]
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word


@F.pandas_udf(StringType())
def stem(words: pd.Series) -> pd.Series:
    """The extended rules."""
    return words.map(lambda w: porter_stem(w, extended=True))
