"""Language-model scores by Brown classes: class-transition and word-emission probabilities.

Tokens are runs without ASCII white space of the text with A-Z in lower case,
then one end token per text. Every word belongs to a unit: each of the most
frequent ``UNITS`` words is its own; all other words, also those never seen, share
``GROUPS`` units by a hash of their last three characters. Units are assigned
to ``CLASSES`` classes by exchange clustering, so each word has a class, and an
unseen word takes that of words that end alike.

Exchange: a unit moves to the class that raises the likelihood of the class
bigrams most. The neighbours of a unit, with their counts, are one row (at
most two entries per unit), and rows are dealt out; in a turn half of the units choose
their class against the class counts they were given, each for itself, so that the
result does not depend on how rows lie in tasks, and
the driver, which holds one number per unit and the classes' square, takes the
moves together. The assignment with the highest likelihood counts; rounds end
when it grows by less than ``LEAST`` of itself.

Model: P(w | before) = (1 - ``BASE``) T(C | C before) (c + 1) / W(C) + ``BASE`` (c + 1) / (N + V + units of rare words).
c is the word's training count, W(C) the sum of c + 1 over the words of class C plus 1
for the unseen words of each of its shared units, and T the class transition, smoothed
by ``PRIOR`` pseudo-counts in proportion to W. It sums to one over all words and
the unseen ones. Both parts are multiples of c + 1, so a text's score is the sum
of log10(c + 1) over its tokens plus that of a matrix over its class transitions:
only counts of rare words have to be looked up, by a join. Words with counts up to
``LOOKUP`` of them are known to all tasks.

Counts, classes and probabilities come from all training documents. A null or
empty text is its end token. A null id trains and is not held out. Words have no
length limit. Repeated rows train and are scored each. Ties of counts between
words go to the smaller word, of classes to the smaller number. Without training
documents every count is 0, and nothing is known. An empty table gives no rows.
Only the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noteledger.llm import words as W
from noteledger.llm.batches import by_bytes
from noteledger.llm.common import in_light_batches, n_tasks, stored

UNITS = 1 << 13
GROUPS = 1 << 9
CLASSES = 64
ROUNDS = 6
TURNS = 2  # a round's units move in as many turns
LEAST = 1e-3
LOOKUP = 1 << 18
BASE = 0.02
PRIOR = 20.0
TOKENS = 1 << 21  # counted together in a task
END = ""  # no word is empty

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: crc32 of the id as text leaves 2 when divided by 7."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def text_words(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of a batch's texts, the place of each word among them, words per text."""
    distinct, ids, n = W.split_words(W.translated(batch.column("text"), LOWER))
    return distinct.cast(pa.string()), ids, n


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) of ``texts`` (text); the end token is the empty word."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            distinct, ids, _ = text_words(batch)
            counts = np.bincount(ids, minlength=len(distinct))
            yield pa.record_batch({"word": pa.concat_arrays([distinct, pa.array([END])]), "c": pa.array(np.append(counts, len(batch)))})

    return texts.mapInArrow(rows, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """What every task knows: frequent words in order of rank, their counts, the number of units among them."""

    words: pa.Array
    counts: np.ndarray
    units: int
    groups: int
    tokens: int  # N
    distinct: int  # V

    @property
    def size(self) -> int:
        """Units: the end, frequent words, groups of the others."""
        return 1 + self.units + self.groups

    def places(self, distinct: pa.Array) -> np.ndarray:
        """Rank of each word, -1 if it is not known here."""
        found = pc.index_in(distinct, value_set=self.words)
        return pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def unit_of(self, distinct: pa.Array, place: np.ndarray) -> np.ndarray:
        out = place + 1
        rare = np.flatnonzero((place < 0) | (place >= self.units))
        if len(rare):
            ends, which = W.encoded(pc.utf8_slice_codeunits(distinct.take(pa.array(rare)), start=-3))
            out[rare] = 1 + self.units + (W.word_hashes(ends) % np.uint64(self.groups)).astype(np.int64)[which]
        return out


def vocabulary(counts: DataFrame, units: int = UNITS, groups: int = GROUPS, lookup: int = LOOKUP) -> Vocabulary:
    """The words with the lowest count limit (of a fixed scale) that at most ``lookup`` words reach; the first ``units`` are units."""
    limits = sorted({round(2 ** (i / 4)) for i in range(200)})
    real = counts.where(F.col("word") != END)
    found = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)), *[F.count_if((F.col("c") >= x) & (F.col("word") != END)) for x in limits]).first()
    least = next(x for x, n in zip(limits, found[2:], strict=True) if n <= lookup)
    rows = sorted(((-r.c, r.word) for r in real.where(F.col("c") >= least).toLocalIterator()), key=lambda r: (r[0], r[1].encode()))
    return Vocabulary(pa.array([r[1] for r in rows], pa.string()), np.array([-r[0] for r in rows], np.int64), min(units, len(rows)), groups, found[0], found[1])


def group_sums(counts: DataFrame, known: Vocabulary) -> np.ndarray:
    """Per unit the sum of c + 1 over its words, and 1 for the unseen words of a shared one."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            distinct = batch.column("word").cast(pa.string())
            unit = known.unit_of(distinct, known.places(distinct))
            unit[pc.equal(distinct, END).to_numpy(zero_copy_only=False)] = 0
            mass = np.zeros(known.size, np.int64)
            np.add.at(mass, unit, batch.column("c").to_numpy(zero_copy_only=False) + 1)
            at = np.flatnonzero(mass)
            yield pa.record_batch({"unit": pa.array(at), "mass": pa.array(mass[at])})

    out = np.zeros(known.size, np.int64)
    for unit, mass in counts.mapInArrow(rows, "unit long, mass long").groupBy("unit").agg(F.sum("mass")).collect():
        out[unit] = mass
    out[1 + known.units:] += 1
    return out


def unit_sequence(batch: pa.RecordBatch, known: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Units of all tokens of a batch (an end after each text), text of each, its places and ids among the distinct words; those, words per text."""
    distinct, ids, n = text_words(batch)
    place = known.places(distinct)
    unit = known.unit_of(distinct, place)
    ends = np.cumsum(n)
    return np.insert(unit[ids], ends, 0), np.insert(np.repeat(np.arange(len(n)), n), ends, np.arange(len(n))), place, ids, distinct, n


def unit_pairs(texts: DataFrame, known: Vocabulary) -> DataFrame:
    """(u, v, n): unit v follows unit u; texts begin after an end."""
    size = known.size
    kind = np.int32 if size**2 < 2**31 else np.int64  # of a pair

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(held: list[np.ndarray]) -> pa.RecordBatch:
            pairs, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.record_batch({"u": pa.array((pairs // size).astype(np.int32)), "v": pa.array((pairs % size).astype(np.int32)), "n": pa.array(n)})

        held, tokens = [], 0
        for batch in by_bytes(batches, "text"):
            unit = unit_sequence(batch, known)[0]
            held.append((np.append(0, unit[:-1]) * size + unit).astype(kind))
            tokens += len(unit)
            if tokens >= TOKENS:
                yield counted(held)
                held, tokens = [], 0
        if tokens:
            yield counted(held)

    return texts.mapInArrow(rows, "u int, v int, n long").groupBy("u", "v").agg(F.sum("n").alias("n"))


def neighbours(pairs: DataFrame) -> DataFrame:
    """One row per unit: its followers and their counts, its predecessors and theirs."""
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("u").alias("unit"), F.lit(True).alias("after"), F.col("v").alias("other"), F.col("n")),
        F.struct(F.col("v").alias("unit"), F.lit(False).alias("after"), F.col("u").alias("other"), F.col("n")))).alias("x")).select("x.*")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int32()), pa.list_(pa.int64())

        def made(held: list[np.ndarray]) -> pa.RecordBatch:
            unit, after, other, n = (np.concatenate(x) for x in zip(*held, strict=True))
            units, first = np.unique(unit, return_index=True)
            out = {"unit": pa.array(units, pa.int32())}
            for side, a, b in ((True, "after", "after_n"), (False, "before", "before_n")):
                of = after == side
                ends = np.concatenate([[0], np.cumsum(np.add.reduceat(of.astype(np.int64), first))]).astype(np.int32)
                out[a] = pa.ListArray.from_arrays(pa.array(ends), pa.array(other[of], pa.int32())).cast(kind[0])
                out[b] = pa.ListArray.from_arrays(pa.array(ends), pa.array(n[of], pa.int64())).cast(kind[1])
            return pa.record_batch(out)

        held, size = [], 0
        for batch in batches:
            if not len(batch):
                continue
            held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in ("unit", "after", "other", "n")])
            size += len(batch)
            if size >= TOKENS // 4:
                all_ = [np.concatenate(x) for x in zip(*held, strict=True)]
                done = int(np.searchsorted(all_[0], all_[0][-1]))  # the last unit may go on
                if done:
                    yield made([[x[:done] for x in all_]])
                held, size = [[x[done:] for x in all_]], len(all_[0]) - done
        if size:
            yield made(held)

    dealt = both.repartition(n_tasks(pairs.sparkSession), "unit").sortWithinPartitions("unit")
    return dealt.mapInArrow(rows, "unit int, after array<int>, after_n array<long>, before array<int>, before_n array<long>")


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def likelihood(pairs: np.ndarray) -> float:
    """Log-likelihood of the class bigrams, without the words' own part, which no exchange changes."""
    return float(_f(pairs).sum() - _f(pairs.sum(axis=0)).sum() - _f(pairs.sum(axis=1)).sum())


def exchange(pairs: np.ndarray, classes: np.ndarray, unit: int, after: np.ndarray, after_n: np.ndarray, before: np.ndarray, before_n: np.ndarray) -> int:
    """Move one unit to its best class (not that of the end, 0); ``pairs`` and ``classes`` are changed in place."""
    k, a = len(pairs), classes[unit]
    own = float(after_n[after == unit].sum())
    right = np.bincount(classes[after], after_n, minlength=k)
    left = np.bincount(classes[before], before_n, minlength=k)
    right[a] -= own
    left[a] -= own
    pairs[a] -= right
    pairs[:, a] -= left
    pairs[a, a] -= own
    out, in_ = right.sum() + own, left.sum() + own
    with_row, with_column, plain = _f(pairs + right), _f(pairs + left[:, None]), _f(pairs)
    diagonal = np.diagonal(pairs)
    gain = with_row.sum(axis=1) + with_column.sum(axis=0) - plain.sum(axis=1) - plain.sum(axis=0)
    gain += _f(diagonal + right + left + own) - _f(diagonal + right) - _f(diagonal + left) + _f(diagonal)
    rows, columns = pairs.sum(axis=1) + left, pairs.sum(axis=0) + right  # its neighbours follow and precede it in any class
    gain -= _f(rows + out) - _f(rows) + _f(columns + in_) - _f(columns)
    gain[0] = -np.inf
    best = int(np.argmax(gain))
    if gain[best] <= gain[a] + 1e-6:
        best = int(a)
    pairs[best] += right
    pairs[:, best] += left
    pairs[best, best] += own
    classes[unit] = best
    return best


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    lists = []
    for name in ("after", "after_n", "before", "before_n"):
        flat, n = W.lists_flat(batch.column(name))
        lists.append((flat.to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(n)])))
    for i, unit in enumerate(batch.column("unit").to_pylist()):
        yield unit, *[flat[ends[i]:ends[i + 1]] for flat, ends in lists]


def class_pairs(context: DataFrame, classes: np.ndarray, k: int) -> np.ndarray:
    """Counts of class after class."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros((k, k), np.int64)
        for batch in batches:
            for unit, after, after_n, _, _ in _rows(batch):
                np.add.at(pairs[classes[unit]], classes[after], after_n)
        at = np.flatnonzero(pairs)
        yield pa.record_batch({"pair": pa.array(at), "n": pa.array(pairs.reshape(-1)[at])})

    out = np.zeros(k * k, np.float64)
    for pair, n in context.mapInArrow(rows, "pair long, n long").groupBy("pair").agg(F.sum("n")).collect():
        out[pair] = n
    return out.reshape(k, k)


def cluster(context: DataFrame, size: int, k: int = CLASSES, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Class of each unit, and the class bigrams. Units are in order of rank; the end (0) keeps class 0 for itself."""
    classes = 1 + (np.arange(size) - 1) % (k - 1)
    classes[0] = 0
    pairs = class_pairs(context, classes, k)
    best = likelihood(pairs), classes, pairs
    for n in range(TURNS * rounds):
        def rows(batches: Iterator[pa.RecordBatch], n: int = n, classes=classes, pairs=pairs) -> Iterator[pa.RecordBatch]:
            moved = []
            for batch in batches:
                for unit, *lists in _rows(batch):
                    if unit and (unit * 2654435761 >> 7) % TURNS == n % TURNS:
                        best = exchange(pairs.copy(), classes.copy(), unit, *lists)
                        if best != classes[unit]:
                            moved.append((unit, best))
            yield pa.record_batch({"unit": pa.array([m[0] for m in moved], pa.int64()), "class": pa.array([m[1] for m in moved], pa.int64())})

        moved = context.mapInArrow(rows, "unit long, class long").collect()
        classes = classes.copy()
        for unit, to in moved:
            classes[unit] = to
        pairs = class_pairs(context, classes, k)
        now, before = likelihood(pairs), best[0]
        if now > before:
            best = now, classes, pairs
        if n % TURNS == TURNS - 1 and now - before < LEAST * abs(before):
            break
    return best[1], best[2]


@dataclass
class ClassModel:
    known: Vocabulary
    classes: np.ndarray  # of each unit
    log_steps: np.ndarray  # log10 of P(w | class before) / (c + 1), for class before and class of w
    log_units: np.ndarray  # log10(c + 1) of the end and of the known words


def class_model(known: Vocabulary, mass: np.ndarray, classes: np.ndarray, pairs: np.ndarray, end_count: int) -> ClassModel:
    k = len(pairs)
    held = np.bincount(classes, mass, minlength=k)
    held[0] = end_count + 1
    share = held / held.sum()
    steps = (pairs + PRIOR * share) / (pairs.sum(axis=1, keepdims=True) + PRIOR)
    per_count = (1 - BASE) * steps / np.maximum(held, 1.0) + BASE / (held.sum())
    return ClassModel(known, classes, np.log10(per_count), np.log10(np.append(end_count, known.counts) + 1.0))


def fit(docs: DataFrame, counts: DataFrame, text: str = "text", units: int = UNITS, groups: int = GROUPS, k: int = CLASSES, rounds: int = ROUNDS, lookup: int = LOOKUP) -> ClassModel:
    """The model of the training documents ``docs``, whose ``word_counts`` are ``counts``."""
    known = vocabulary(counts, units, groups, lookup)
    mass = group_sums(counts, known)
    end = counts.where(F.col("word") == END).first()
    context = stored(neighbours(unit_pairs(docs.select(F.col(text).cast("string").alias("text")), known)))
    classes, pairs = cluster(context, known.size, k, rounds)
    return class_model(known, mass, classes, pairs, end.c if end else 0)


def score_texts(docs: DataFrame, counts: DataFrame, model: ClassModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, part, at = held.value, TaskContext.get().partitionId() << 40, 0
        known = m.known
        for batch in by_bytes(batches, "text"):
            unit, text_of, place, ids, distinct, n = unit_sequence(batch, known)
            size = len(n)
            cls = m.classes[unit]
            steps = np.bincount(text_of, m.log_steps[np.append(0, cls[:-1]), cls], minlength=size)
            rank = place[ids]
            words_of = np.repeat(np.arange(size), n)
            here = rank >= 0
            logs = np.bincount(words_of[here], m.log_units[1 + rank[here]], minlength=size) + m.log_units[0]
            seen = np.bincount(words_of[here], minlength=size) + (1 if m.log_units[0] > 0 else 0)
            rare, times = np.unique(words_of[~here] * max(1, len(distinct)) + ids[~here], return_counts=True)
            each = np.concatenate([[0], np.cumsum(np.bincount(rare // max(1, len(distinct)), minlength=size))]).astype(np.int32)
            yield pa.record_batch({
                "rid": pa.array(part + at + np.arange(size)), "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                "n_tokens": pa.array(n + 1), "seen": pa.array(seen), "logs": pa.array(logs), "steps": pa.array(steps),
                "rare": pa.ListArray.from_arrays(pa.array(each), distinct.take(pa.array(rare % max(1, len(distinct))))),
                "times": pa.ListArray.from_arrays(pa.array(each), pa.array(times.astype(np.int64))),
            })
            at += size

    narrow = docs.select(F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), F.col(text).cast("string").alias("text"))
    id_type = narrow.schema["doc_id"].dataType.simpleString()
    made = stored(narrow.mapInArrow(rows, f"rid long, doc_id {id_type}, held_out boolean, n_tokens long, seen long, logs double, steps double, rare array<string>, times array<long>"))
    # words that the tasks do not know: their counts are joined, one row per text and word
    asked = made.select("rid", F.explode(F.arrays_zip(F.col("rare").alias("word"), F.col("times").alias("times"))).alias("x")).select("rid", "x.word", "x.times")
    looked = asked.join(counts, "word").groupBy("rid").agg(F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("more"), F.sum("times").alias("found"))
    known = model.known
    logs = F.col("logs") + F.coalesce("more", F.lit(0.0))
    return made.drop("rare", "times").join(looked, "rid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("seen") + F.coalesce("found", F.lit(0))).alias("n_known"), F.lit(known.tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * float(np.log10(known.tokens + known.distinct + 1))).alias("base_score"), (logs + F.col("steps")).alias("score"))


@in_light_batches
def language_model_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """Learn from the documents that are not held out, and score all of them."""
    training = docs.where(~held_out(F.col(doc_id))).select(F.col(text).cast("string").alias("text"))
    counts = stored(word_counts(training))
    return score_texts(docs, counts, fit(training, counts, **settings), doc_id, text)


def perplexity(scored: DataFrame, held: bool = True) -> DataFrame:
    """Perplexity per token of the held-out (or the training) documents, of the model and of the unigram base."""
    def of(score):
        return F.pow(F.lit(10.0), -F.sum(score) / F.sum("n_tokens"))

    return scored.where(F.col("held_out") == held).agg(of("score").alias("perplexity"), of("base_score").alias("base_perplexity"))
