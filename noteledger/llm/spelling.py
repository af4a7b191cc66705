"""Spelling variants: words one edit apart, found by a relational trie frontier.

The vocabulary is a table of words with their counts. It is held in two tries,
of the words and of the words read backwards, as a table of edges: (level, side,
node, first character, label, child). Nodes are those places where words part or
end; a stretch between two nodes is one edge with the stretch as its label, so
a long word costs a few edges. A node's number is a hash of its prefix.

The frontier is a table of states (side, word, position, node, edits), at first one
for each word and side at the root. Every round joins it with the edges of
its level. A state without an edit goes on along its own label and, in the
latter half of its word, over labels that take one edit; a state with its edit
needs an equal label. A state that has used its word up after one edit, at a node
where a word ends, has found a neighbour. Of two words one edit apart, the equal
part before or that after the edit is at least half of them, so edits in the
latter half are enough, once forwards and once backwards; near the root, where a
node has many children, states are exact. Each pair is walked from one of its words:
from the shorter, or from the one with the smaller character at the replaced place.

Edges of a level are few near the root, where one node is shared by all states:
a level of at most ``FEW`` edges is broadcast, others are joined by a shuffle that
Spark may split. Each round is written, so a lost executor repeats one round at most.

Words are runs of ``LETTERS`` with A-Z in lower case; see ``counted_words`` for the
characters deleted from some. Null and empty texts have none. A null id is written as
no text. Words have no length limit. Repeated rows count each. Ties of counts
between near words go to the smaller word in code-point order. An empty table
gives no rows. Only the id and the text are read, so other columns may have any
name.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noteledger.llm import words as W
from noteledger.llm.batches import by_bytes
from noteledger.llm.common import checkpoint, stored

LETTERS = "A-Za-zÀ-ÿ"
FEW = 10_000
NEAR = 2
PRIME = (1 << 61) - 1
BASE = 0x16A09E667F3BCC9
SLICE = 1 << 17  # rows that a task makes at once

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def counted_words(docs: DataFrame, least_length: int = 6, least: int = 5, drop_one_in: int = 199, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of the words of at least ``least_length`` code points that occur ``least`` times.

    If ``drop_one_in`` divides the crc32 of ``<doc_id>:<run>``, the run loses its code point
    at that crc32 modulo its length.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            spaced = pc.replace_substring_regex(W.translated(batch.column("text"), LOWER), f"[^{LETTERS}]+", " ")
            distinct, ids, n = W.split_words(spaced)
            if not len(ids):
                continue
            width = len(distinct)
            pairs, times = np.unique(np.repeat(np.arange(len(n)), n) * width + ids, return_counts=True)
            data = distinct.cast(pa.large_binary()).to_pylist()
            starts = [crc32(b"%s:" % x) for x in pc.fill_null(batch.column("doc_id"), "").cast(pa.binary()).to_pylist()]
            row, which = pairs // width, pairs % width
            h = np.fromiter(map(crc32, map(data.__getitem__, which.tolist()), map(starts.__getitem__, row.tolist())), np.int64, len(pairs))
            cut = h % drop_one_in == 0
            whole = np.zeros(width, np.int64)
            np.add.at(whole, which[~cut], times[~cut])
            changed: dict[str, int] = {}
            for i in np.flatnonzero(cut).tolist():
                word = data[which[i]].decode()
                at = int(h[i]) % len(word)
                word = word[:at] + word[at + 1:]
                if len(word) >= least_length:
                    changed[word] = changed.get(word, 0) + int(times[i])
            long_ = (pc.utf8_length(distinct).to_numpy(zero_copy_only=False) >= least_length) & (whole > 0)
            yield pa.record_batch({
                "word": pa.concat_arrays([distinct.filter(pa.array(long_)).cast(pa.string()), pa.array(list(changed), pa.string())]),
                "n": pa.array(np.concatenate([whole[long_], np.fromiter(changed.values(), np.int64, len(changed))])),
            })

    narrow = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(rows, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def prefixes(words: DataFrame) -> DataFrame:
    """(id, side, at, node, next): every prefix of ``words`` (id, side, word); next is empty at the word's end."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(held: list[tuple]) -> pa.RecordBatch:
            word, side, at, node, after = zip(*held, strict=True)
            return pa.record_batch({"id": pa.array(word, pa.int64()), "side": pa.array(side, pa.int32()), "at": pa.array(at, pa.int32()), "node": pa.array(node, pa.int64()), "next": pa.array(after, pa.string())})

        held = []
        for batch in batches:
            for one, side, word in zip(*(batch.column(c).to_pylist() for c in ("id", "side", "word")), strict=True):
                node = 0
                for at, c in enumerate(word):
                    held.append((one, side, at, node, c))
                    node = (node * BASE + ord(c) + 1) % PRIME
                    if len(held) >= SLICE:
                        yield made(held)
                        held = []
                held.append((one, side, len(word), node, ""))
        if held:
            yield made(held)

    return words.select("id", "side", "word").mapInArrow(rows, "id long, side int, at int, node long, next string")


def trie_edges(words: DataFrame) -> DataFrame:
    """Edges of both tries of ``words`` (id, side, word): level, side, node, first, label, child, ends (the word that ends at the child, or null)."""
    places = prefixes(words)
    nodes = checkpoint(
        places.groupBy("side", "node").agg(F.min("at").alias("at"), F.min("next").alias("lo"), F.max("next").alias("hi"))
        .where("lo <> hi or lo = '' or node = 0").select("side", "node", "at")
    )
    # prefixes that very many words share are few: those of up to NEAR characters
    near, prefix = nodes.where(F.col("at") <= NEAR).drop("at"), places.select("id", "side", "at", "node")
    near = F.broadcast(near) if near.count() <= FEW else near
    found = prefix.where(F.col("at") <= NEAR).join(near, ["side", "node"]).unionByName(
        prefix.where(F.col("at") > NEAR).join(nodes.where(F.col("at") > NEAR).drop("at"), ["side", "node"]))
    # a word's nodes in order; consecutive ones are an edge
    path = found.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("at", "node"))).alias("path")).join(words, "id")
    steps = path.select("side", "word", "path", F.explode(F.expr("sequence(1, size(path) - 1)")).alias("level"))
    here, before = F.expr("path[level]"), F.expr("path[level - 1]")
    edges = steps.select(
        (F.col("level") - 1).alias("level"), "side", before["node"].alias("node"), here["node"].alias("child"),
        F.substring("word", before["at"] + 1, here["at"] - before["at"]).alias("label"),
        F.when(here["at"] == F.char_length("word"), F.col("word")).alias("ends"))
    # words that share an edge give it several times
    return edges.groupBy("side", "child").agg(
        F.min("level").alias("level"), F.min("node").alias("node"), F.min("label").alias("label"), F.max("ends").alias("ends")
    ).withColumn("first", F.substring("label", 1, 1))


def next_states(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """States after one more edge: side, word, position, node, edits, ends."""
    exact = frontier.where("edits = 1 or position < half").withColumn("first", F.expr("substring(word, position + 1, 1)"))
    free = frontier.where("edits = 0")
    length = F.char_length("label")
    own = F.expr("substring(word, position + 1, char_length(label))")
    kept = "side", "word", "half"

    def moved(of: DataFrame, position, edits) -> DataFrame:
        return of.select(*kept, position.cast("int").alias("position"), F.col("child").alias("node"), edits.alias("edits"), "ends")

    # equal labels: all states whose next character must agree, and those without an edit beyond the half
    wanted = exact.unionByName(free.where("position >= half").withColumn("first", F.expr("substring(word, position + 1, 1)")))
    same = wanted.join(edges, ["side", "node", "first"]).where(own == F.col("label"))
    # one edit within the label: what is before the half of the word must still be equal
    before_half = F.expr("position >= half or substring(label, 1, half - position) = substring(word, position + 1, half - position)")
    reaches = F.expr("position + char_length(label) >= half")
    partly = free.where("position < half").withColumn("first", F.expr("substring(word, position + 1, 1)")).join(edges, ["side", "node", "first"]).where(reaches & before_half)
    beyond = free.where("position >= half").join(edges, ["side", "node"])
    asked = partly.select(*kept, "position", "child", "label", "ends").unionByName(beyond.select(*kept, "position", "child", "label", "ends"))
    one_less = F.expr("substring(word, position + 1, char_length(label) - 1)")
    replaced = (F.char_length(own) == length) & (F.col("label") > own) & (F.levenshtein(own, "label", 1) == 1)
    inserted = (F.char_length(one_less) == length - 1) & (F.levenshtein(one_less, "label", 1) == 1)
    tried = asked.select("*", F.explode(F.array(F.when(replaced, F.col("position") + length), F.when(inserted, F.col("position") + length - 1))).alias("reached")).where("reached is not null")
    return moved(same, F.col("position") + length, F.col("edits")).unionByName(moved(tried, F.col("reached"), F.lit(1)))


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near): words of ``words`` (word) exactly one edit apart, both ways."""
    both = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("word")), F.struct(F.lit(1).alias("side"), F.reverse("word").alias("word"))))
    sides = stored(words.select(both.alias("x")).select(F.monotonically_increasing_id().alias("id"), "x.*"))
    edges = stored(trie_edges(sides).repartition("level"))
    sizes = sorted((r.level, r["count"]) for r in edges.groupBy("level").count().collect())  # one row per level
    frontier = sides.select("side", "word", F.expr("int(char_length(word) div 2)").alias("half"), F.lit(0).alias("position"), F.lit(0).cast("long").alias("node"), F.lit(0).alias("edits"))
    found = []
    for level, size in sizes:
        of_level = edges.where(F.col("level") == level).drop("level")
        states = stored(next_states(frontier, F.broadcast(of_level) if size <= FEW else of_level))
        done = F.expr("edits = 1 and position = char_length(word)")
        found.append(states.where(done & F.col("ends").isNotNull()).select("side", "word", "ends"))
        frontier = states.where(~done).select("side", "word", "half", "position", "node", "edits")
        if frontier.isEmpty():
            break
    if not found:
        return words.select("word", F.col("word").alias("near")).where("false")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    read = F.when(F.col("side") == 1, F.reverse("word")).otherwise(F.col("word")), F.when(F.col("side") == 1, F.reverse("ends")).otherwise(F.col("ends"))
    pairs = pairs.select(read[0].alias("a"), read[1].alias("b")).where(F.levenshtein("a", "b", 1) == 1)  # nodes are known by a hash
    both = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near")), F.struct(F.col("b").alias("word"), F.col("a").alias("near"))))
    return pairs.select(both.alias("x")).select("x.*").distinct()


def variant_groups(counted: DataFrame, times: int = 5) -> DataFrame:
    """Per word of ``counted`` (word, n): word, form, root, n, n_near, form_n.

    The form is the near word with the largest n, if that is at least ``times`` the
    word's own; the root is reached by following forms, whose counts grow
    ``times``-fold, so few steps lead there.
    """
    counted = stored(counted)
    near = near_pairs(counted.select("word")).join(counted.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("form"))).alias("best"))
    judged = counted.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("best.form").alias("form"), (-F.col("best.rank")).alias("form_n"))
    fits = F.col("form_n") >= F.col("n") * times
    forms = stored(judged.withColumn("form", F.when(fits, F.col("form"))).withColumn("form_n", F.when(fits, F.col("form_n"))))
    roots = checkpoint(forms.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("far"))
        moved = checkpoint(roots.join(ahead, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")))
        roots = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return forms.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """word, form, root, n, n_near, form_n of the words of all documents."""
    return variant_groups(counted_words(docs, doc_id=doc_id, text=text, **settings))
