import random
import re
from collections import Counter, defaultdict

import pytest

from noteledger.llm import collocations as C
from noteledger.llm import words as W
from noteledger.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, n int, phrase string, weight int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, min_count, top, max_words=5, absorbed=100):
    f = defaultdict(Counter)
    for _, text, lang, *_ in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            for k in range(1, max_words + 1):
                for i in range(len(w) - k + 1):
                    f["und" if lang is None else lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, counts in f.items():
        n = sum(c for p, c in counts.items() if len(p) == 1)
        candidates = {p: c for p, c in counts.items() if len(p) >= 2 and c >= min_count}
        dropped = {p[i:j] for p, c in candidates.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                   if j - i < len(p) and 100 * c >= absorbed * candidates[p[i:j]]}
        found = []
        for p, a in candidates.items():
            if p not in dropped:
                score, _, left, right = min((1000 * a * n // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        found.sort()
        out += [(lang, i, p.decode(), -a, x, y, n, -s) for i, (s, a, p, x, y) in enumerate(found[:top], 1)]
    return sorted(out)


def texts(rng, n):
    vocab = ["the", "of", "new", "york", "City", "is", "big", "a", "é", "x|y"]
    passage = "the new york city of a big x|y is the of new"
    out = []
    for i in range(n):
        w = [rng.choice(vocab) for _ in range(rng.randint(0, 60))]
        t = "".join(x + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "? "]) for x in w)
        if rng.random() < 0.4:
            t += rng.choice([passage, passage.upper(), "York " * 30])
        out.append((i, t, rng.choice(["en", "en", "de", None]), 1, "clash", 2))
    return out


@pytest.mark.parametrize("period", [1, 3, 10**9])
def test_as_counted_directly(spark, period):
    rng = random.Random(period)
    rows = texts(rng, 120) + [(None, None, None, 0, None, None), (5, "", "en", 0, None, None), (6, " .. ,\t", "fr", 0, None, None)]
    rows += rows[:30]  # repeated rows
    got = C.collocations(spark.createDataFrame(rows, SCHEMA).repartition(5), min_count=6, top=40, period=period)
    assert sorted(tuple(r) for r in got.collect()) == expected(rows, 6, 40)


def test_absorbed_share_and_lengths(spark):
    rows = texts(random.Random(8), 80)
    got = C.collocations(spark.createDataFrame(rows, SCHEMA), min_count=4, top=1000, max_words=3, absorbed=60, period=4)
    assert sorted(tuple(r) for r in got.collect()) == expected(rows, 4, 1000, max_words=3, absorbed=60)


def test_parse_covers_every_phrase_once(spark):
    rng = random.Random(3)
    rows = texts(rng, 60)
    df = spark.createDataFrame(rows, SCHEMA)
    for period in (1, 2, 7):
        seen = Counter()
        for r in C.parse(df, period=period).collect():
            w = r.chunk.split(" ")
            own = len(w) if r.last else len(w) - 4
            assert own > 0
            for k in (1, 5):
                for i in range(own):
                    if i + k <= len(w):
                        seen[r.lang, tuple(w[i:i + k])] += r.weight
        want = Counter()
        for _, text, lang, *_ in rows:
            for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text.translate(LOWER)):
                w = [x for x in re.split("[ \t]+", piece) if x]
                for k in (1, 5):
                    for i in range(len(w) - k + 1):
                        want["und" if lang is None else lang, tuple(w[i:i + k])] += 1
        assert seen == want


def test_copies_make_equal_chunks(spark):
    rng = random.Random(5)
    passage = " ".join(f"w{rng.randint(0, 400)}" for _ in range(3000))
    one = C.parse(spark.createDataFrame([(1, passage, "en", 0, "", 0)], SCHEMA)).count()
    rows = [(i, f"start{i} {passage} end{i}", "en", 0, "", 0) for i in range(20)]
    many = C.parse(spark.createDataFrame(rows, SCHEMA)).count()
    assert one > 50 and many <= one + 4 * 20  # only the edges differ


def test_very_long_words_and_pieces(spark):
    rows = [(1, "a " * 50_000 + "b" * 100_000 + " a", "en", 0, "", 0)]
    got = C.collocations(spark.createDataFrame(rows, SCHEMA), min_count=100).collect()
    assert sorted(tuple(r) for r in got) == expected(rows, 100, 2000)
    assert ("a a a a a", 49_996, 50_002) in [(r.phrase, r.a, r.n) for r in got]


def test_empty_tables(spark):
    for rows in ([], [(1, None, None, 0, "", 0)], [(1, "", "en", 0, "", 0)]):
        assert C.collocations(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_shared_bits_lose_nothing(spark):
    rows = texts(random.Random(11), 60)
    got = C.collocations(spark.createDataFrame(rows, SCHEMA), min_count=5, top=100, bits=8)  # every phrase shares a bit
    assert sorted(tuple(r) for r in got.collect()) == expected(rows, 5, 100)


def test_gram_hash_depends_on_order():
    import numpy as np

    h = np.array([1, 2, 1, 2, 1], np.uint64)
    g = W.gram_hashes(h, 2)
    assert g[0] == g[2] and g[1] == g[3] and g[0] != g[1]


def test_query_reads_all_documents(spark, sf_dir):
    rows = [(i, "one two three. " * 5, "en", 0, "", 0) for i in range(25)]
    got = QUERIES["op11_phrase_collocations"](spark, sf_dir(documents=spark.createDataFrame(rows, SCHEMA))).collect()
    assert [tuple(r) for r in got] == [("en", 1, "one two three", 125, 125, 125, 375, 3000)]
