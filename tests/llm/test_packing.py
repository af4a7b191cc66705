import random
import zlib

import numpy as np
import pytest

from noteledger.llm import packing as P
from noteledger.llm.queries import QUERIES, vocabulary

VOCAB = "byte_bpe_50k.json"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary(VOCAB))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_ids_equal_the_library(library):
    rng = random.Random(2)
    parts = [" ", "\n", "\t", "\r", "\x1c", "\x85", "\xa0", "　", "​", "a", "the", "'s", "'", "12", "é", "!", "日本", "\U0001f600", "<|endoftext|>", "\x00", "  ", "\n\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 16))) for _ in range(4000)]
    encoder = P.PartIds(vocabulary(VOCAB))
    assert all(np.frombuffer(encoder.encode(t), "<u4").tolist() == library(t) for t in texts)


def test_memo_is_bounded(monkeypatch):
    monkeypatch.setattr(P, "MEMO", 10)
    encoder = P.PartIds(vocabulary(VOCAB))
    encoder.encode(" ".join(f"w{i}" for i in range(100)))
    assert len(encoder) == 10


def test_merge_is_the_opposing_sum():
    assert P.merge([(-5, [0])], [(-3, [1])], 3) == [(-5, [0]), (-3, [1])]
    assert P.merge([(-5, [0]), (-2, [1])], [(-4, [2]), (-1, [3])], 2) == [(-6, [0, 3]), (-6, [1, 2])]
    assert P.merge([(-5, [0]), (-2, [1])], [(-4, [2]), (-1, [3])], 3) == [(-5, [0]), (-4, [2]), (-3, [1, 3])]


def test_windows_hold_all_pieces():
    rng = random.Random(3)
    for sizes in ([], [1024], [600, 600, 600], [rng.randint(1, 512) for _ in range(700)], [1] * 50, [1024] * 3, [700] * 9):
        found = P.windows(sizes, 1024)
        assert sorted(i for _, m in found for i in m) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in m) == s <= 1024 for s, m in found)


def check(rows, docs, library, capacity=1024):
    """All ids in one piece each, sequences without gaps."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for s in by_sequence.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= capacity
    if docs:
        assert set(by_doc) == set(docs)
    for doc_id, text in docs.items():
        ids, at = [*library(text or ""), 0], 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            piece = np.array(ids[r.start:r.start + r.length], "<u4").tobytes()
            assert (r.start, r.ids_crc32, r.doc_tokens) == (at, zlib.crc32(piece), len(ids))
            at += r.length
        assert at == len(ids)
    return len(by_sequence) * capacity / max(1, sum(r.length for r in rows))


def test_query(spark, sf_small, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    padding = check(QUERIES["op5_differencing_packing"](spark, sf_small).collect(), docs, library)
    assert padding < 1.03


def test_odd_rows(spark, library):
    rows = [(1, None, 0), (2, "", 0), (3, "hello world", 0), (4, "x " * 30_000, 0), (5, " lead\n\nand trail \t", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int")
    packed = P.pack(docs, vocabulary(VOCAB), keep_ids=True).collect()
    check(packed, {i: t for i, t, _ in rows}, library)
    assert [r.ids for r in packed if r.doc_id == 3] == [[*library("hello world"), 0]]
    twice = spark.createDataFrame([(None, "same words"), (7, "same words"), (7, "same words")], "doc_id long, text string")
    got = P.pack(twice, vocabulary(VOCAB)).collect()
    check(got, {}, library)
    assert len(got) == 3
    assert P.pack(docs.limit(0), vocabulary(VOCAB)).count() == 0


def test_added_tokens_have_their_ids(spark):
    """The library as it is by default, without ``encode_special_tokens``."""
    from tokenizers import Tokenizer

    default = Tokenizer.from_file(vocabulary(VOCAB))
    ids_of = lambda text: default.encode(text, add_special_tokens=False).ids
    rng = random.Random(6)
    parts = [" ", "\n", "  ", "a", "the", "'s", "é", "日本", "<|", "|>", "<|endoftext|>", "<|endoftext|>", "endoftext"]
    texts = ["see <|endoftext|> here", "<|endoftext|>", "<|endoftext|" * 2 + ">"] + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(2000)]
    encoder = P.PartIds(vocabulary(VOCAB))
    assert all(np.frombuffer(encoder.encode_added(t), "<u4").tolist() == ids_of(t) for t in texts)
    docs = spark.createDataFrame(list(enumerate(texts[:60])), "doc_id long, text string")
    got = P.pack(docs, vocabulary(VOCAB), keep_ids=True).collect()
    check(got, dict(enumerate(texts[:60])), ids_of)
    assert next(r for r in got if r.doc_id == 0).ids == [3826, 220, 50256, 994, 0]
