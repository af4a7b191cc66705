"""Text expressions (Column -> Column).

All of these are built-in Spark SQL expressions, so they stay inside
whole-stage code generation; no Python runs per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import (
    CLEAN_DROP,
    CLEAN_GAP,
    NON_WORD,
    SPACE_CLASS,
    SPACE_RUN,
    regex_escape,
)


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Python ``str.strip()``: remove Unicode whitespace at both ends."""
    return F.regexp_replace(col(c), "^[" + SPACE_CLASS + "]+|[" + SPACE_CLASS + "]+$", "")


def clean_text(c) -> Column:
    """Training-side cleaning: NULL/empty -> '', lower-case, drop punctuation,
    collapse whitespace, trim. One pass: a dropped character and whitespace
    both end as one space, so every run of either is replaced at once."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(col(c), F.lit(""))), CLEAN_GAP, " "))


def clean_text_app(c) -> Column:
    """Scoring-side cleaning: strip and collapse first, then punctuation to a
    space; case kept and no second collapse, so double spaces survive."""
    t = F.regexp_replace(strip_ws(c), SPACE_RUN, " ")
    return F.regexp_replace(t, CLEAN_DROP, " ")


def preview(c, width: int = 100) -> Column:
    """First ``width`` characters, with '...' appended when the text is longer."""
    c = col(c)
    return F.when(F.length(c) > width, F.concat(F.substring(c, 1, width), F.lit("..."))).otherwise(c)


def word_runs(c) -> Column:
    """Maximal runs of word characters (what ``\\b...\\b`` delimits)."""
    return F.split(col(c), NON_WORD + "+")


def lexicon_count(tokens, words: list[str]) -> Column:
    """Number of tokens equal to one of ``words`` (all occurrences)."""
    return F.size(F.filter(col(tokens), lambda x: x.isin(list(words))))


def lexicon_counts(clean, lexicon: dict[str, list[str]], tokens=None) -> dict[str, Column]:
    """Whole-word counts and presence flags per lexicon group.

    Equal to counting ``re.findall(r'\\b(w1|w2|...)\\b', text)`` for single-word
    lexicons: a whole-word match is a word run equal to the word.
    """
    toks = col(tokens) if tokens is not None else word_runs(clean)
    out = {}
    for name, words in lexicon.items():
        n = lexicon_count(toks, words)
        out[f"{name}_count"] = n
        out[f"{name}_present"] = (n > 0).cast("int")
    return out


def substring_presence(text, words: list[str], lowered: bool = False) -> Column:
    """Number of distinct ``words`` that occur as substrings of lower(text)
    (``lowered=True``: the text is already lower-cased)."""
    low = F.coalesce(col(text), F.lit(""))
    low = low if lowered else F.lower(low)
    total = F.lit(0)
    for w in dict.fromkeys(words):
        total = total + (F.instr(low, w) > 0).cast("int")
    return total


def _double_non_word(phrase: str) -> str:
    return re.sub(r"([^\w])", r"\1\1", phrase)


def entity_pattern(phrases: list[str]) -> str:
    """Regex matching whole-word phrases in text whose non-word characters
    have been doubled (see :func:`entities`)."""
    alts = "|".join(regex_escape(_double_non_word(p)) for p in phrases)
    return "(?:^|" + NON_WORD + ")(" + alts + ")(?:" + NON_WORD + "|$)"


def doubled_text(text) -> Column:
    """lower(text) with every non-word character doubled (see :func:`entities`);
    compute it once when several phrase groups scan the same text."""
    return F.regexp_replace(F.lower(F.coalesce(col(text), F.lit(""))), "(" + NON_WORD + ")", "$1$1")


def entities_in(doubled, phrases: list[str]) -> Column:
    """:func:`entities` on a text already passed through :func:`doubled_text`."""
    found = F.regexp_extract_all(col(doubled), F.lit(entity_pattern(phrases)), 1)
    seps = sorted({ch for p in phrases for ch in p if not re.match(r"\w", ch)})

    def undo(x):
        for ch in seps:
            x = F.replace(x, F.lit(ch + ch), F.lit(ch))
        return x

    return F.array_sort(F.array_distinct(F.transform(found, undo)))


def entities(text, phrases: list[str]) -> Column:
    """Sorted distinct phrases found as whole words in lower(text).

    Semantics of ``re.findall(r'\\b(p1|p2|...)\\b', text.lower())``: leftmost
    match first, alternatives in list order, so an earlier multi-word phrase
    hides the words inside it. Engines without look-around consume the
    boundary character after a match; doubling every non-word character in
    the text (and in the phrases) leaves one for the next match.
    """
    return entities_in(doubled_text(text), phrases)


def words(text) -> Column:
    """Python ``str.split()``: whitespace-separated words, no empties."""
    return F.filter(F.split(F.coalesce(col(text), F.lit("")), SPACE_RUN), lambda x: x != "")


def text_metrics(text) -> dict[str, Column]:
    """Words, non-blank sentences ('.'-separated), words per sentence
    (NULL when there is no sentence), distinct words and length."""
    t = col(text)
    w = words(t)
    sentences = F.filter(F.split(F.coalesce(t, F.lit("")), r"\."), lambda s: s.rlike("[^" + SPACE_CLASS + "]"))
    n_words = F.size(w)
    n_sent = F.size(sentences)
    return {
        "word_count": n_words,
        "sentence_count": n_sent,
        "avg_sentence_length": F.round(F.try_divide(n_words.cast("double"), n_sent.cast("double")), 6),
        "unique_words": F.size(F.array_distinct(w)),
        "text_length": F.length(t),
    }


def tokenize(clean) -> Column:
    """Lower-case and split on single whitespace characters; empty tokens kept."""
    return F.split(F.lower(col(clean)), r"\s")


def remove_stop_words(tokens, stop_words: list[str]) -> Column:
    return F.filter(col(tokens), lambda x: ~x.isin(list(stop_words)))
