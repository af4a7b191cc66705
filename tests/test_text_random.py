"""Randomized check of the regex emulation against Python's Unicode `re`.

Spark's Java regex has ASCII \\w, \\s and \\b; the expressions spell out the
Unicode classes instead. The expected values below use Python's own `re`
with the same patterns the expressions emulate.
"""

import random
import re

import pytest

from noteledger.functions import text as T

ALPHABET = (
    list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_")
    + list("éèàçñüößÉÑØåæ") + list("日本語") + list("½²٣")
    + list(".,;:!?-'\"()[]&/#*+") + list("°—–…")
    + [" ", " ", " ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1f", "\x85", "\xa0", " ", "　"]
    + ["pain", "chest", "chest pain", "x-ray", "ct scan", "head"]
)


def _texts(n=600, seed=11):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def _py_clean(t):
    if not t:
        return ""
    t = re.sub(r"[^\w\s\-\.]", " ", t.lower())
    return re.sub(r"\s+", " ", t).strip()


def _py_clean_app(t):
    t = re.sub(r"\s+", " ", t.strip())
    return re.sub(r"[^\w\s\-\.]", " ", t)


@pytest.fixture(scope="module")
def rows(spark):
    texts = _texts()
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    words = ["pain", "chest", "head", "x"]
    phrases = ["chest pain", "pain", "chest", "x-ray", "ct scan", "head"]
    out = df.select("i", T.clean_text("t").alias("c"), T.clean_text_app("t").alias("a"),
                    T.lexicon_count(T.word_runs(T.clean_text("t")), words).alias("n"),
                    T.entities("t", phrases).alias("e")).collect()
    return texts, words, phrases, {r.i: r for r in out}


def test_cleaning_matches_python_unicode_regex(rows):
    texts, _, _, got = rows
    for i, t in enumerate(texts):
        assert got[i].c == _py_clean(t), repr(t)
        assert got[i].a == _py_clean_app(t), repr(t)


def test_whole_word_counts_match_findall(rows):
    texts, words, _, got = rows
    pat = re.compile(r"\b(" + "|".join(words) + r")\b")
    for i, t in enumerate(texts):
        assert got[i].n == len(pat.findall(_py_clean(t))), repr(t)


def test_entities_match_findall(rows):
    texts, _, phrases, got = rows
    pat = re.compile(r"\b(" + "|".join(re.escape(p) for p in phrases) + r")\b")
    for i, t in enumerate(texts):
        assert got[i].e == sorted(set(pat.findall(t.lower()))), repr(t)
