import hashlib
import random

from pyspark.sql import functions as F

from noteledger.llm import winnowing as W
from noteledger.llm.queries import QUERIES


def marks_of(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    return [tuple(r) for r in df.select("i", W.grams(F.col("text")).alias("g"), W.marks(F.col("text")).alias("m")).orderBy("i").select("g", "m.at", "m.hash").collect()]


def naive(g, window):
    at = set()
    for j in range(max(1, len(g) - window + 1)) if g else ():
        part = g[j:j + window]
        low = min(part)
        at.add(max(j + i for i, h in enumerate(part) if h == low))
    return sorted(at)


def test_winnowing_picks_rightmost_minima(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 120))) for _ in range(40)] + ["", "   ", "one", "a b c d", "a a a a a a a a a a a a a a a a a a a a a a a a a a"]
    for text, (g, at, hashes) in zip(texts, marks_of(spark, texts), strict=True):
        n = len(text.split())
        assert len(g) == (max(1, n - W.K + 1) if n else 0)
        assert at == naive(g, W.WINDOW) and hashes == [g[i] for i in at]


def test_match_guarantee(spark):
    rng = random.Random(2)
    shared = [f"s{rng.randint(0, 99)}" for _ in range(W.WINDOW + W.K - 1)]
    for _ in range(5):
        a, b = ([f"x{rng.random()}" for _ in range(30)] for _ in range(2))
        one, two = marks_of(spark, [" ".join(a[:9] + shared + a[9:]), " ".join(b[:20] + shared + b[20:])])
        assert set(one[2]) & set(two[2])


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5(r[1].encode()).hexdigest()))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edit = text[:len(text) - half] + after[:half]
        out.append((str(doc_id), len(text), hashlib.sha256(edit.encode()).hexdigest(), text, edit, after))
    return out


def likeness(a, b):
    a, b = ({x.split("@")[0] for x in s.split()} for s in (a, b))
    return len(a & b) / len(a | b) if a | b else 1.0


def check(spark, rows, got):
    want = expected(rows)
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == sorted(w[:3] for w in want)
    prints = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert abs(likeness(r.fingerprint, r.edited_fingerprint) - r.near_edited) < 1e-6
        prints[str(r.doc_id), r.edited_sha256] = r
    by_text = {}
    for doc_id, _, sha, text, _, after in want:
        assert by_text.setdefault(text, prints[doc_id, sha].fingerprint) == prints[doc_id, sha].fingerprint
    for doc_id, _, sha, text, _, after in want:
        assert abs(likeness(by_text[text], by_text[after]) - prints[doc_id, sha].near_next) < 1e-6


def test_query(spark, sf_small):
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    got = QUERIES["op6_winnowing"](spark, sf_small).collect()
    check(spark, rows, got)
    plan = QUERIES["op6_winnowing"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_odd_rows(spark):
    rows = [(None, "a b"), (None, ""), (3, "é 日本 \U0001f600 x"), (3, "other"), (-5, "word " * 9000), (2**62, "x"), (7, "same"), (8, "same")]
    docs = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, hash string")
    check(spark, rows, W.fingerprint_edits(docs).collect())
    null = spark.createDataFrame([(1, None)], "doc_id long, text string")
    alone = W.fingerprint_edits(null).first()
    assert (alone.n_chars, alone.fingerprint, alone.near_edited, alone.near_next) == (0, "", 1.0, 1.0)
    twice = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (2, "d")], "doc_id long, text string")
    assert W.fingerprint_edits(twice).count() == 3
    assert W.fingerprint_edits(null.limit(0)).count() == 0


def naive_bytes(text):
    """Chosen grams of a text as (position, gram); windows reach over the start."""
    data = text.encode()
    grams = [data[i:i + W.GRAM] for i in range(max(1, len(data) - W.GRAM + 1))] if data else []
    return grams


def test_byte_marks_are_rightmost_minima(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab 日") for _ in range(rng.randint(1, 300))) for _ in range(60)]
    texts += ["x" * 100, "日" * 100, "ab" * 5000, "".join(map(str, range(3000))), "", "a", "a" * W.GRAM, "short text", "b" * 64]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string").select("i", "text", F.encode("text", "UTF-8").alias("b"))
    n = F.greatest(F.octet_length("b") - (W.GRAM - 1), F.lit(1))
    for r in df.select("text", W.packed_grams(F.col("b"), F.lit(1), n).alias("g"), W.unpacked(W.byte_marks(F.col("text"))).alias("m")).collect():
        g = [x >> 31 for x in r.g] if r.text else []
        assert len(g) == len(naive_bytes(r.text))
        at = set()
        for end in range(1, len(g) + 1):  # the window that ends with each gram
            part = list(enumerate(g[:end]))[-W.WINDOW:]
            low = min(h for _, h in part)
            at.add(max(i for i, h in part if h == low))
        assert r.m.at == sorted(at)
        assert r.m.hash == [g[i] for i in r.m.at]


def test_edited_marks_are_those_of_the_edited_text(spark):
    rng = random.Random(12)
    texts = ["".join(rng.choice(["a", "b", " ", "é", "日", "\U0001f600"]) for _ in range(rng.choice([*range(60), 100, 300, 5000]))) for _ in range(250)]
    texts += ["a" * 400, "ab" * 300, "a" * 23, "日" * 30, "", "", "x"] * 2
    rows = [(texts[i], texts[j]) for i in range(len(texts)) for j in rng.sample(range(len(texts)), 2)]
    df = spark.createDataFrame(rows, "text string, after string")
    stays, comes = W.edited(F.col("text"), F.col("after"))
    df = df.withColumn("a", stays).withColumn("b", comes).withColumn("e", F.concat("a", "b")).where(F.octet_length("e") >= 1)
    composed = W.edited_marks(F.col("e").cast("binary"), W.byte_marks(F.col("text")), F.octet_length("a"), W.byte_marks(F.col("after")), F.octet_length("b"))
    for r in df.select("e", W.byte_marks(F.col("e")).alias("want"), composed.alias("got")).where(F.octet_length("e") >= W.GRAM).collect():
        assert r.got == r.want, r.e


def test_texts_without_white_space(spark):
    rng = random.Random(4)
    letters = {"a": "abcdefghijklmnopqrstuvwxyz0123456789+/", "c": "".join(map(chr, range(0x4E00, 0x4F00))), "t": "".join(map(chr, range(0xE01, 0xE2F)))}
    rows = []
    for kind, chars in letters.items():
        for n in (16, 20, 40, 64, 65, 90, 2000, 30_000):
            text = "".join(rng.choice(chars) for _ in range(n))
            other = "".join(rng.choice(chars) for _ in range(n))
            at = n // 2 + 3
            # descending ids: a text, its copy with one character changed, an unlike one
            rows += [text, text[:at] + "!" + text[at + 1:], other]
    docs = spark.createDataFrame([(-i, t) for i, t in enumerate(rows)], "doc_id long, text string")
    got = {-r.doc_id: r for r in W.fingerprint_edits(docs).collect()}
    assert all(r.near_edited > 0 for r in got.values())
    assert all(got[i].near_next > 0 for i in range(0, len(rows), 3))
    assert all(got[i].near_next < 0.1 for i in range(1, len(rows) // 3, 3))  # unlike ones of many letters in a gram


def test_short_texts_share_what_stays(spark):
    docs = spark.createDataFrame([(1, "one two three four five six"), (2, "zyx wvu tsr"), (3, "eight letters and more")], "doc_id long, text string")
    assert all(r.near_edited > 0 for r in W.fingerprint_edits(docs).collect() if r.n_chars > 14)
    assert W.fingerprint_edits(docs, find=W.marks).where("near_edited > 0").count() == 0


def test_repeated_and_null_ids_are_split(spark):
    rows = [(7, f"seven {i}") for i in range(120)] + [(None, f"null {i}") for i in range(150)] + [(i, f"text {i}") for i in range(60)] + [(8, "same")] * 3
    random.Random(7).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_key", F.md5("text"))
    seen = []
    found = W.with_next(docs, ["text"], 16, lambda df: (seen.append(df), df)[1]).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5(r[1].encode()).hexdigest()))
    # the first row comes after the last
    want = [(str(a[0]), a[1], b[1]) for a, b in zip(order, [*order[1:], order[0]], strict=True)]
    assert sorted(map(str, ((str(r.doc_id), r.text, r.next_text) for r in found))) == sorted(map(str, want))
    assert max(r["count"] for r in seen[0].where(~F.col("_copy")).groupBy("_range").count().collect()) < 60
