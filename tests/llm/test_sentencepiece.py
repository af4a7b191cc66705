import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from noteledger.llm import sentencepiece_lattice as L
from noteledger.llm.queries import QUERIES, vocabulary

MODEL = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def model():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=vocabulary(MODEL))


@pytest.fixture(scope="module")
def pieces():
    return L.Pieces(vocabulary(MODEL))


def texts():
    rng = random.Random(5)
    parts = [" ", "  ", "\n", "a", "e", "the", "in", "▁", "é", "日", "\t", "\x00", "ﬁ", "1", ".", "aaaa", "    ", "\U0001f600", "tion"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(1200)] + [
        "", "x" * 900, " " * 900, "ab" * 600 + " c\n" + "the" * 300, "\n\n", " a", "a "]


@pytest.mark.parametrize("frequent", [0, 50, 10**6])
def test_equals_the_library(spark, model, pieces, frequent):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "row long, text string").repartition(6)
    units = L.encode_units(df, pieces, frequent=frequent)
    got = {}
    for r in sorted(units.collect(), key=lambda r: (r.row, r.nth)):
        got.setdefault(r.row, []).extend(r.ids)
    assert all(got.get(i, []) == model.encode(t) for i, t in rows)


def test_ids_stay_with_their_row(spark, model, pieces):
    """Whole texts' ids without a shuffle, from batches cut anywhere; nulls, long units and unknown characters included."""
    rows = [*enumerate(texts()), (-1, None), (-2, "日本" * 150), (-3, "\u2028\r x" * 40)]
    df = spark.createDataFrame(rows, "row long, text string").repartition(3)
    coded = L.encode(df, pieces)
    got = {r.row: r.ids for r in coded.collect()}
    assert set(got) == {i for i, t in rows if t}
    assert all(got.get(i, []) == model.encode(t or "") for i, t in rows)


def test_bytes_that_are_no_text(spark, model, pieces):
    docs = spark.sql("select 1L doc_id, cast(x'6120ff62206320' as string) text union all select 2L, cast(x'e2' as string)")
    got = {r.doc_id: r for r in L.coded_documents(docs, pieces).collect()}
    assert got[1].ids == model.encode("a \ufffdb c ") and got[2].ids == model.encode("\ufffd")
    assert not got[1].round_trip and not got[2].round_trip


def test_query_shuffles_nothing(spark, sf_small):
    plan = QUERIES["op7_sentencepiece_lattice"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def plain_merges(unit, rank, missing):
    """Every possible merge looked at in each step."""
    at = list(unit)
    while True:
        ways = [(rank[at[i] + at[i + 1]], i) for i in range(len(at) - 1) if at[i] + at[i + 1] in rank]
        if not ways:
            return [x for s in at for x in missing(s)]
        i = min(ways)[1]
        at[i:i + 2] = [at[i] + at[i + 1]]


@pytest.mark.parametrize("byte_base", [None, 300])
def test_merges_of_odd_models(byte_base):
    """Pieces reached in other ways than they were learned, equal scores, characters that are no piece."""
    class Table:
        path, unknown, hex = "", 0, [""] * 600
        rows = [(p, 10 + i, 0.0, r) for i, (p, r) in enumerate([("a", 99), ("b", 99), (" ", 98), ("ab", 3), ("ba", 3), ("aba", 1), ("bb", 5), ("xy", 2), ("axy", 0), (" a", 4), ("abab", 7), ("éa", 6)])]
        pairs = L.Pieces.pairs
    Table.byte_base = byte_base
    known, rank = {p: i for p, i, *_ in Table.rows}, {p: r for p, _, _, r in Table.rows if len(p) > 1}
    missing = lambda s: [known[s]] if s in known else [0] if byte_base is None else [byte_base + b for b in s.encode()]
    rng = random.Random(8)
    units = sorted({"".join(rng.choice("aabbxyé日 ") for _ in range(rng.randint(1, 30))) for _ in range(1500)})
    ids, n = L.UnitCoder(Table())(pa.array([u.encode() for u in units], pa.large_binary()), None)
    ends = [0, *n.cumsum().tolist()]
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == [plain_merges(u, rank, missing) for u in units]


def test_round_trip(spark, pieces):
    rows = list(enumerate(texts()))
    back = {r.row: r.text for r in L.decode(L.encode(spark.createDataFrame(rows, "row long, text string"), pieces), pieces).collect()}
    assert all(back.get(i, "") == t.replace("▁", " ") for i, t in rows)


def test_viterbi_fold(spark, pieces):
    """The unigram fold against plain dynamic programming."""
    small = [("ab", 1, -1.5), ("a", 2, -1.0), ("b", 3, -1.0), ("bc", 4, -0.9), ("abc", 5, -3.0), ("c", 6, -2.0), (" ", 7, -0.1), (" a", 8, -1.2)]

    class Table:
        rows = [(p, i, s, 0) for p, i, s in small]
        longest, unknown = 3, 0
        table = staticmethod(lambda spark: spark.createDataFrame(Table.rows, "piece string, id int, score double, rank int"))

    words = ["abc", " abc", "aabbcc", "zab", "c", " ", "cccabzz"]
    score = {p: (s, i) for p, i, s in small}

    def best(word):
        states = [(0.0, [])]
        for end in range(1, len(word) + 1):
            ways = []
            for start in range(max(0, end - 3), end):
                piece = word[start:end]
                if piece in score or end - start == 1:
                    s, i = score.get(piece, (-3.0 - 10.0, 0))
                    ways.append((states[start][0] + s, -start, states[start][1] + [i]))
            states.append((max(ways)[0], max(ways)[2]))
        return states[-1][1]

    got = {r.unit: r.ids for r in L.unigram_units(spark.createDataFrame([(w,) for w in words], "unit string"), Table).collect()}
    assert got == {w: best(w) for w in words}


def test_query_and_odd_rows(spark, sf_small, sf_dir, model):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op7_sentencepiece_lattice"](spark, sf_small).collect()}
    assert set(got) == set(docs) and all(r.round_trip for r in got.values())
    assert all(got[i].n_pieces == len(model.encode(t)) and got[i].n_chars == len(t) for i, t in docs.items())
    odd = spark.createDataFrame([(None, None, 1), (None, "", 1), (4, "a b", 1), (4, "a b", 1), (5, "x" * 5000, 1)], "doc_id long, text string, row int")
    rows = QUERIES["op7_sentencepiece_lattice"](spark, sf_dir(documents=odd)).collect()
    assert sorted(r.n_pieces for r in rows) == sorted(len(model.encode(t)) for t in ("", "", "a b", "a b", "x" * 5000))
    assert QUERIES["op7_sentencepiece_lattice"](spark, sf_dir(documents=odd.where(F.lit(False)))).count() == 0


def test_query_gives_ids_and_text(spark, sf_dir, model):
    rows = list(enumerate([*texts()[:300], "a▁b", "▁", "", "two words\n and a line", "ab" * 600]))
    docs = spark.createDataFrame([*rows, (-1, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in QUERIES["op7_sentencepiece_lattice"](spark, sf_dir(documents=docs)).collect()}
    assert len(got) == len(rows) + 1 and (got[-1].ids, got[-1].text, got[-1].round_trip) == ([], "", True)
    for i, t in rows:
        assert got[i].ids == model.encode(t) and got[i].text == t.replace("▁", " ")
        assert got[i].round_trip == ("▁" not in t) and (got[i].n_pieces, got[i].n_chars) == (len(got[i].ids), len(got[i].text))
