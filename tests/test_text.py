"""Text expressions against the hand-computed rows of FIXTURES.md section 2."""


from noteledger.functions import text as T
from noteledger.functions.patterns import APP_LEXICON, ENTITY_LEXICON, TRAINING_LEXICON

ROWS = [
    "  Chest pain, PAIN & (mild)  headache!  ",
    "Severe back-pain.\tNo painful knees; knee ok. ",
    "Émile: fièvre 38,5°C — test",
    "CT scan and X-ray of chest: chest pain. Pain persists.",
    "",
    "   ",
    None,
]


def _frame(spark):
    return spark.createDataFrame([(i, r) for i, r in enumerate(ROWS)], "i int, t string")


def test_clean_training(spark):
    got = [r[0] for r in _frame(spark).orderBy("i").select(T.clean_text("t")).collect()]
    assert got == [
        "chest pain pain mild headache",
        "severe back-pain. no painful knees knee ok.",
        "émile fièvre 38 5 c test",
        "ct scan and x-ray of chest chest pain. pain persists.",
        "", "", "",
    ]


def test_clean_app_keeps_case_and_double_spaces(spark):
    got = [r[0] for r in _frame(spark).orderBy("i").select(T.clean_text_app("t")).collect()]
    assert got[0] == "Chest pain  PAIN    mild  headache "
    assert got[2] == "Émile  fièvre 38 5 C   test"


def test_lexicon_counts_whole_words(spark):
    c = T.clean_text("t")
    counts = T.lexicon_counts(c, TRAINING_LEXICON)
    cols = [counts[f"{k}_count"] for k in TRAINING_LEXICON]
    got = [tuple(r) for r in _frame(spark).orderBy("i").select(*cols).collect()]
    assert got[:4] == [(2, 1, 1, 0), (1, 2, 1, 0), (0, 0, 0, 0), (2, 2, 0, 0)]
    assert got[4:] == [(0, 0, 0, 0)] * 3
    pres = [r[0] for r in _frame(spark).orderBy("i").select(counts["symptoms_present"]).collect()]
    assert pres == [1, 1, 0, 1, 0, 0, 0]


def test_substring_presence_counts_distinct_words(spark):
    c = T.clean_text_app("t")
    lex = TRAINING_LEXICON
    cols = [T.substring_presence(c, w) for w in lex.values()]
    got = [tuple(r) for r in _frame(spark).orderBy("i").select(*cols).collect()]
    # 'headache' contains 'head': counted here, not by the whole-word counts
    assert got[:4] == [(1, 2, 1, 0), (1, 2, 1, 0), (0, 0, 0, 0), (1, 1, 0, 0)]
    # the app list has the extra word 'test'
    app = _frame(spark).orderBy("i").select(T.substring_presence(c, APP_LEXICON["medical_terms"])).collect()
    assert app[2][0] == 1


def test_entities_leftmost_first(spark):
    cols = [T.entities("t", p).alias(k) for k, p in ENTITY_LEXICON.items()]
    rows = _frame(spark).orderBy("i").select(*cols).collect()
    assert rows[0]["symptoms"] == ["chest pain", "pain"]
    assert rows[0]["body_parts"] == ["chest"]
    assert rows[3]["procedures"] == ["ct scan", "x-ray"]
    assert rows[3]["symptoms"] == ["chest pain", "pain"]
    assert rows[6]["symptoms"] == []


def test_entities_adjacent_and_unicode_boundaries(spark):
    df = spark.createDataFrame([("pain chest",), ("éhead headé head",), ("chest  pain",)], "t string")
    got = [r[0] for r in df.select(T.entities("t", ENTITY_LEXICON["symptoms"] + ["chest", "head"])).collect()]
    # adjacent words both found; accented letters are word characters
    assert got[0] == ["chest", "pain"]
    assert got[1] == ["head"]
    # a double space does not match the one-space phrase
    assert got[2] == ["chest", "pain"]


def test_text_metrics(spark):
    m = T.text_metrics("t")
    rows = _frame(spark).orderBy("i").select(*[v.alias(k) for k, v in m.items()]).collect()
    got = [(r.word_count, r.sentence_count, r.unique_words, r.text_length) for r in rows]
    assert got[:4] == [(6, 1, 6, 40), (7, 2, 7, 45), (5, 1, 5, 27), (10, 2, 10, 54)]
    assert got[5] == (0, 0, 0, 3)
    assert rows[5].avg_sentence_length is None
    assert rows[1].avg_sentence_length == 3.5


def test_tokenizer_keeps_empty_tokens(spark):
    df = spark.createDataFrame([("the chest  pain. a",)], "t string")
    assert df.select(T.tokenize("t")).collect()[0][0] == ["the", "chest", "", "pain.", "a"]


def test_preview(spark):
    df = spark.createDataFrame([("x" * 101,), ("short",)], "t string")
    got = [r[0] for r in df.select(T.preview("t")).collect()]
    assert got == ["x" * 100 + "...", "short"]
