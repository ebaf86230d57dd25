"""English stems: the published Snowball rules for English, over distinct words in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import search_tokens

#: Fixed values of the algorithm: words with a stem of their own, words that stay after the first steps, and beginnings that are a region.
WHOLE = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl"} | {w: w for w in "sky news howe atlas cosmos bias andes".split()}
STAY = frozenset("inning outing canning herring earring proceed exceed succeed".split())
HEADS = ("gener", "commun", "arsen")
#: Suffixes and what takes their place, longest first.
SECOND = {"ization": "ize", "ational": "ate", "fulness": "ful", "ousness": "ous", "iveness": "ive", "tional": "tion", "biliti": "ble", "lessli": "less", "entli": "ent", "ation": "ate", "alism": "al", "aliti": "al", "ousli": "ous", "iviti": "ive", "fulli": "ful", "enci": "ence", "anci": "ance", "abli": "able", "izer": "ize", "ator": "ate", "alli": "al", "bli": "ble", "ogi": "og", "li": ""}
THIRD = {"ational": "ate", "tional": "tion", "alize": "al", "icate": "ic", "iciti": "ic", "ative": "", "ical": "ic", "ness": "", "ful": ""}
FOURTH = ("ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion", "al", "er", "ic")
_REGION = re.compile("[aeiouy][^aeiouy]")
_SHORT = re.compile("(?:^[aeiouy][^aeiouy]|[^aeiouy][aeiouy][^aeiouywxY])$")


def _after(word: str, start: int) -> int:
    """Where the region after the first consonant that follows a vowel begins."""
    found = _REGION.search(word, start)
    return found.end() if found else len(word)


@lru_cache(maxsize=1 << 16)
def stem(word: str) -> str:
    """The stem of a lower-case word; words of other letters than a-z and apostrophes stay."""
    if len(word) < 3 or not re.fullmatch("[a-z']+", word):
        return word
    if word in WHOLE:
        return WHOLE[word]
    w = re.sub("^y|(?<=[aeiouy])y", "Y", word.removeprefix("'"))
    r1 = next((len(h) for h in HEADS if w.startswith(h)), None) or _after(w, 0)
    r2 = _after(w, r1)
    ends = lambda *some: next((s for s in some if w.endswith(s)), "")
    w = w[: len(w) - len(ends("'s'", "'s", "'"))]
    # plurals
    if s := ends("sses", "ied", "ies", "us", "ss", "s"):
        if s == "sses":
            w = w[:-2]
        elif s in ("ied", "ies"):
            w = w[:-2] if len(w) > 4 else w[:-1]
        elif s == "s" and re.search("[aeiouy]", w[:-2]):
            w = w[:-1]
    if w in STAY:
        return w
    # past and present forms
    if s := ends("eedly", "ingly", "edly", "eed", "ing", "ed"):
        if s in ("eed", "eedly"):
            if len(w) - len(s) >= r1:
                w = w[: -len(s)] + "ee"
        elif re.search("[aeiouy]", w[: -len(s)]):
            w = w[: -len(s)]
            if ends("at", "bl", "iz"):
                w += "e"
            elif re.search(r"(bb|dd|ff|gg|mm|nn|pp|rr|tt)$", w):
                w = w[:-1]
            elif r1 >= len(w) and _SHORT.search(w):
                w += "e"
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in "aeiouy":
        w = w[:-1] + "i"
    if s := ends(*SECOND):
        before = w[: -len(s)]
        if len(before) >= r1 and (s != "ogi" or before.endswith("l")) and (s != "li" or before[-1:] in tuple("cdeghkmnrt")):
            w = before + SECOND[s]
    if s := ends(*THIRD):
        if len(w) - len(s) >= (r2 if s == "ative" else r1):
            w = w[: -len(s)] + THIRD[s]
    if s := ends(*FOURTH):
        before = w[: -len(s)]
        if len(before) >= r2 and (s != "ion" or before[-1:] in ("s", "t")):
            w = before
    if w.endswith("e") and (len(w) > r2 or len(w) > r1 and not _SHORT.search(w[:-1])) or w.endswith("ll") and len(w) > r2:
        w = w[:-1]
    return w.lower()


def search_stems(*texts: Column | str) -> Column:
    """Distinct stems of the words that are no stop words, sorted: what an English full-text index holds."""

    @F.pandas_udf("array<string>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for some in parts:
            yield some.map(lambda words: sorted({stem(w) for w in words}))

    return run(search_tokens(*texts))


def matches(stems: Column | str, query: str) -> Column:
    """Whether an index entry has all words of a query."""
    wanted = sorted({stem(w) for w in re.findall(r"[^\W_]+", query.lower())})
    c = F.col(stems) if isinstance(stems, str) else stems
    return F.size(F.array_intersect(c, F.array(*map(F.lit, wanted)))) == len(wanted)
