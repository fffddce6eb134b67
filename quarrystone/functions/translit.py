"""Devanagari to Latin schemes: a consonant carries the vowel a unless a vowel sign or virama follows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters of the scripts and of the public transliteration schemes, in the order of the Devanagari rows.
VOWELS = "अ आ इ ई उ ऊ ऋ ॠ ऌ ॡ ए ऐ ओ औ".split()
SIGNS = "ा ि ी ु ू ृ ॄ ॢ ॣ े ै ो ौ".split()
CONSONANTS = "क ख ग घ ङ च छ ज झ ञ ट ठ ड ढ ण त थ द ध न प फ ब भ म य र ल व श ष स ह ळ".split()
MARKS = "ं ः ँ ऽ ॐ । ॥".split()
VIRAMA, JOINERS = "्", "‌‍"
SCHEMES = {
    "iast": (
        "a ā i ī u ū ṛ ṝ ḷ ḹ e ai o au".split(),
        "k kh g gh ṅ c ch j jh ñ ṭ ṭh ḍ ḍh ṇ t th d dh n p ph b bh m y r l v ś ṣ s h ḻ".split(),
        "ṃ ḥ m̐ ' oṃ . ..".split(),
    ),
    "iso": (
        "a ā i ī u ū r̥ r̥̄ l̥ l̥̄ ē ai ō au".split(),
        "k kh g gh ṅ c ch j jh ñ ṭ ṭh ḍ ḍh ṇ t th d dh n p ph b bh m y r l v ś ṣ s h ḷ".split(),
        "ṁ ḥ m̐ ' ōṁ . ..".split(),
    ),
    "hk": (
        "a A i I u U R RR lR lRR e ai o au".split(),
        "k kh g gh G c ch j jh J T Th D Dh N t th d dh n p ph b bh m y r l v z S s h L".split(),
        "M H ~ ' OM . ..".split(),
    ),
    "itrans": (
        "a A i I u U RRi RRI LLi LLI e ai o au".split(),
        "k kh g gh ~N ch Ch j jh ~n T Th D Dh N t th d dh n p ph b bh m y r l v sh Sh s h L".split(),
        "M H .N .a OM | ||".split(),
    ),
    "slp1": (
        "a A i I u U f F x X e E o O".split(),
        "k K g G N c C j J Y w W q Q R t T d D n p P b B m y r l v S z s h L".split(),
        "M H ~ ' oM . ..".split(),
    ),
}
_DIGITS = {chr(0x0966 + k): str(k) for k in range(10)}


def _tables(scheme: str) -> tuple[dict, dict, dict]:
    vowels, consonants, marks = SCHEMES[scheme]
    return dict(zip(CONSONANTS, consonants, strict=True)), dict(zip(SIGNS, vowels[1:], strict=True)), dict(zip(VOWELS, vowels, strict=True)) | dict(zip(MARKS, marks, strict=True)) | _DIGITS


_MADE = {s: _tables(s) for s in SCHEMES}


def transliterate(text: str, scheme: str = "iast") -> str:
    """Devanagari in text to a scheme; other characters stay."""
    if scheme == "devanagari":
        return text
    consonants, signs, others = _MADE[scheme]
    out, open_ = [], False
    for c in text:
        if open_ and c in JOINERS:
            continue
        if open_:
            open_ = False
            if c == VIRAMA:
                continue
            if c in signs:
                out.append(signs[c])
                continue
            out.append("a")
        if c in consonants:
            out.append(consonants[c])
            open_ = True
        elif c not in JOINERS:
            out.append(signs.get(c) or others.get(c, c))
    return "".join(out) + "a" * open_


def to_scheme(text: Column, scheme: str = "iast") -> Column:
    @F.pandas_udf("string")
    def run(x: pd.Series) -> pd.Series:
        return x.map(lambda t: None if t is None else transliterate(t, scheme))

    return run(text)
