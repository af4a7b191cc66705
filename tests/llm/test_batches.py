"""What a task holds of its rows at once."""

import pyarrow as pa
import pytest

from noteledger.llm import class_lm, common, minhash, packing, suffix_dedup
from noteledger.llm import words as W
from noteledger.llm.batches import by_bytes

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_a_slice_of_texts_copies_only_its_own_bytes():
    batch = pa.record_batch({"text": pa.array(["Aé" * 500, None, "", "B" * 1000, "cD"])})
    found = [W.translated(x.column("text"), class_lm.LOWER) for x in by_bytes([batch], "text", 1000)]
    assert [t for x in found for t in x.to_pylist()] == ["aé" * 500, "", "", "b" * 1000, "cd"]
    assert len(found) > 1
    assert sum(x.buffers()[2].size for x in found) == 1500 + 1000 + 2
    assert W.translated(pa.array([], pa.string()), class_lm.LOWER).to_pylist() == []
    assert W.translated(pa.array([None, None], pa.string()), class_lm.LOWER).to_pylist() == ["", ""]


@pytest.mark.parametrize(("module", "step", "operator"), [
    (class_lm, "word_counts", lambda d: class_lm.language_model_scores(d)),
    (class_lm, "score_texts", lambda d: class_lm.language_model_scores(d)),
    (minhash, "sets_of", lambda d: minhash.near_duplicates(d)),
    (suffix_dedup, "candidate_segments", lambda d: suffix_dedup.remove_repeats(d)),
    (packing, "piece_rows", lambda d: packing.pack(d, "none")),
])
def test_eager_steps_take_batches_by_bytes(spark, monkeypatch, module, step, operator):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    before, seen = spark.conf.get(SETTING), []

    class Stop(Exception):
        pass

    def stop(*_, **__):
        seen.append(spark.conf.get(SETTING))
        raise Stop

    # packing's first eager step is its checkpoint
    monkeypatch.setattr(module, "checkpoint" if module is packing else step, stop)
    with pytest.raises(Stop):
        operator(docs)
    assert seen == [common.BATCH_BYTES]
    assert spark.conf.get(SETTING) == before


def test_rows_reach_tasks_in_small_batches(spark):
    docs = spark.createDataFrame([(i, "x" * 100_000) for i in range(200)], "doc_id long, text string").coalesce(1)

    @common.in_light_batches
    def largest(frame):
        return common.checkpoint(frame.mapInArrow(lambda it: (pa.record_batch({"n": pa.array([b.nbytes])}) for b in it), "n long"))

    assert 0 < max(r.n for r in largest(docs).collect()) < 6 << 20
