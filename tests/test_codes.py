"""Code formats, code-set parsing, dictionaries and label matrices (FIXTURES.md section 3)."""


from noteledger.functions.codes import is_code, parse_code_set
from noteledger.functions.patterns import CODE_REPORT
from noteledger.operators import labels as L

TABLE = [
    ("I10", True, False), ("E11.9", True, True), ("E11.X", True, True), ("J45.909", True, False),
    ("S72.001A", True, False), ("G43.9099", True, False), ("G43.90999", False, False),
    ("E11.", False, False), ("e11.9", False, False), ("A0.1", False, False), ("E11x9", False, False),
]


def test_code_formats(spark):
    df = spark.createDataFrame([(c,) for c, _, _ in TABLE], "c string")
    got = df.select("c", is_code("c").alias("s"), is_code("c", CODE_REPORT).alias("r")).collect()
    assert [(r.c, r.s, r.r) for r in got] == TABLE


def test_parse_code_set(spark):
    df = spark.createDataFrame([(0, " I10 |E11.9||bad"), (1, ""), (2, None)], "i int, c string")
    got = [r[0] for r in df.orderBy("i").select(parse_code_set("c")).collect()]
    assert got == [["I10", "E11.9"], [], []]


def _visits(spark):
    rows = [(1, "E11.9|I10"), (2, "I10"), (3, None), (4, " J45.909 |bad|I10"), (5, "I10|I10")]
    return spark.createDataFrame(rows, "record_id long, codes string")


def test_dictionary_sorted_and_dense(spark):
    d = L.code_dictionary(_visits(spark)).orderBy("code_index").collect()
    assert [(r.code, r.code_index) for r in d] == [("E11.9", 0), ("I10", 1), ("J45.909", 2)]


def test_raw_dictionary_keeps_untrimmed_pieces(spark):
    d = {r.code for r in L.code_dictionary(_visits(spark), raw=True).collect()}
    assert " J45.909 " in d and "bad" in d


def test_one_hot_and_pairs(spark):
    v = _visits(spark)
    d = L.code_dictionary(v)
    oh = {r.record_id: r.labels for r in L.one_hot_labels(v, d).collect()}
    assert oh == {1: [1, 1, 0], 2: [0, 1, 0], 3: [0, 0, 0], 4: [0, 1, 1], 5: [0, 1, 0]}
    pairs = sorted((r.record_id, r.code_index) for r in L.label_pairs(v, d, "record_id").collect())
    assert pairs == [(1, 0), (1, 1), (2, 1), (4, 1), (4, 2), (5, 1)]


def test_one_hot_is_per_row(spark):
    v = spark.createDataFrame([("P1", "I10"), ("P1", "E11.9"), (None, "I10")], "record_id string, codes string")
    rows = L.one_hot_labels(v, L.code_dictionary(v)).collect()
    assert sorted((str(r.record_id), r.labels, r.label_indexes) for r in rows) == [
        ("None", [0, 1], [1]), ("P1", [0, 1], [1]), ("P1", [1, 0], [0])]


def test_label_vectors_equal_the_dense_rows(spark):
    v = spark.createDataFrame([(1, "I10|E11.9"), (2, ""), (3, None), (4, "E11.9|I10|bad|Z99"), (4, "Z99")], "record_id long, codes string")
    d = L.code_dictionary(v)
    dense = sorted((r.record_id, r.labels) for r in L.one_hot_labels(v, d).collect())
    rows = L.label_vectors(v, d).collect()
    assert sorted((r.record_id, [int(x) for x in r.label_vector.toArray()]) for r in rows) == dense
    assert all(type(r.label_vector).__name__ == "SparseVector" for r in rows)
