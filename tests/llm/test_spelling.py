import random
import re
from collections import Counter
from zlib import crc32

import pytest

from noteledger.llm import spelling as S
from noteledger.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, word string, n int, form string, side int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected_counts(rows, least_length=6, least=5, one_in=199):
    n = Counter()
    for doc_id, text, *_ in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOWER)
            h = crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % one_in == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += len(w) >= least_length
    return {w: c for w, c in n.items() if c >= max(1, least)}


def expected(n, times=5):
    near = {w: [u for u in n if one_edit(w, u)] for w in n}
    form = {}
    for w, found in near.items():
        if found:
            u = min(found, key=lambda u: (-n[u], u))
            if n[u] >= times * n[w]:
                form[w] = u
    out = []
    for w, c in n.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, c, len(near[w]), n[form[w]] if w in form else None))
    return sorted(out)


def grouped(spark, n, **settings):
    return sorted(tuple(r) for r in S.variant_groups(spark.createDataFrame(list(n.items()), "word string, n long"), **settings).collect())


@pytest.mark.parametrize("seed", range(3))
def test_as_compared_directly(spark, seed):
    rng = random.Random(seed)
    letters = ["ab", "abc", "abcdefgé\U0001F600"][seed]
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(150)}
    for w in list(words)[:60]:
        at = rng.randint(0, len(w) - 1)
        words |= {w[:at] + w[at + 1:], w[:at] + rng.choice(letters) + w[at:], w[:at] + rng.choice(letters) + w[at + 1:]}
    n = {w: rng.choice([1, 1, 2, 5, 10, 50, 300]) for w in words - {""}}
    assert grouped(spark, n) == expected(n)


def test_edits_at_every_place(spark):
    base = "colourful"
    n = {base: 100}
    for i in range(len(base) + 1):
        n[base[:i] + "x" + base[i:]] = 3
        if i < len(base):
            n[base[:i] + base[i + 1:]] = 2
            n[base[:i] + "z" + base[i + 1:]] = 1
    assert grouped(spark, n) == expected(n)
    assert {r[1] for r in grouped(spark, n) if r[0] != base} == {base}


def test_chains_ties_and_threshold(spark):
    n = {"aaaaaa": 625, "aaaaab": 125, "aaaabb": 25, "aaabbb": 5, "zzzzza": 10, "zzzzzb": 10, "zzzzzz": 2, "bbbbbb": 9, "bbbbba": 2}
    got = grouped(spark, n)
    assert got == expected(n)
    assert next(r for r in got if r[0] == "aaabbb")[2] == "aaaaaa"
    assert next(r for r in got if r[0] == "zzzzzz")[1] == "zzzzza"
    assert next(r for r in got if r[0] == "bbbbba")[1] is None
    assert grouped(spark, n, times=2) == expected(n, 2)


def test_long_words_and_nested_prefixes(spark):
    long_ = "ab" * 3000
    n = {long_: 50, long_[:-1]: 5, long_[:3000] + "x" + long_[3000:]: 4, "y" + long_[1:]: 3}
    n |= {"a" * i: 10 ** (i % 3) for i in range(1, 12)}  # each ends inside the next
    assert grouped(spark, n) == expected(n)


def test_shuffled_edges_give_the_same(spark, monkeypatch):
    rng = random.Random(9)
    n = {"".join(rng.choice("abc") for _ in range(rng.randint(4, 7))): rng.choice([1, 5, 30]) for _ in range(200)}
    monkeypatch.setattr(S, "FEW", 0)
    assert grouped(spark, n) == expected(n)


def counted(spark, rows, **settings):
    return {r.word: r.n for r in S.counted_words(spark.createDataFrame(rows, SCHEMA).repartition(3), **settings).collect()}


def test_counted_words(spark):
    rng = random.Random(4)
    vocab = ["Painter", "PAINTER", "painter", "naïveté", "Élysée", "×÷×÷×÷", "don't", "semi-final", "under_score", "short", "x" * 3000, "ſtraße", "ÀÉÎÕÜÝþÿ"]
    rows = [(i % 40, " ".join(rng.choice(vocab) + rng.choice([" ", ", ", "1", "\n"]) for _ in range(30)), "clash", 0, "", 0) for i in range(60)]
    rows += [(None, "painter painter " * 20, None, None, None, None), (None, None, "", 0, "", 0), (7, "", "", 0, "", 0), *rows[:10]]
    for one_in in (199, 3, 1):
        assert counted(spark, rows, drop_one_in=one_in) == expected_counts(rows, one_in=one_in)
    assert counted(spark, rows, least_length=1, least=1) == expected_counts(rows, 1, 1)


def test_empty_tables(spark):
    for rows in ([], [(1, None, "", 0, "", 0)], [(1, "", "", 0, "", 0)], [(1, "once only", "", 0, "", 0)]):
        assert S.spelling_variants(spark.createDataFrame(rows, SCHEMA)).collect() == []
    assert grouped(spark, {"single": 9}) == [("single", None, "single", 9, 0, None)]


def test_query_reads_all_documents(spark, sf_dir):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["station", "stations", "stashion", "gardens", "garden"]) for _ in range(40)), "", 0, "", 0) for i in range(400)]
    got = QUERIES["op13_spelling_variants"](spark, sf_dir(documents=spark.createDataFrame(rows, SCHEMA)))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(tuple(r) for r in got.collect()) == expected(expected_counts(rows))
