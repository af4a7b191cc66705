"""Quality classifier: generalised additive model with pairwise interactions.

Every text is turned into ``FEATURES``, numbers that need nothing but the whole
text. Each feature is cut into bins at quantiles of the fit sample. The model
is an intercept, one lookup table per feature and one table per chosen pair of
features; a score is the logistic of the sum of one entry of each.

Fit: cyclic boosting. A round visits the features in turn; a tree of two cuts
over that feature's bins is fitted to the current gradients and added, shrunk,
to the feature's table. When the rounds are over, the pairs whose four-quadrant
trees lower the loss most are chosen, and their tables are boosted in the same
way. A part of the sample is kept aside, and boosting ends at the round with
the lowest loss on it.

The fit sees a bounded sample: at most ``max_sample`` labelled documents, in
the order of a hash of their id. Everything else is Spark work: the sample's
texts are found by a broadcast of at most ``max_sample`` ids, and scoring is
one vectorised pass over the texts with the tables in the closure, so nothing
is shuffled and a hot source or a group of copies does not matter.

Null texts count as empty; empty texts are scored. Labels that are null, or
that differ between rows of one doc_id, are left out, and of documents with
one doc_id the smallest text is learned from. Without labels of both classes
the score is their share (0.5 without any). Repeated rows get equal scores,
an empty table gives no rows; a null doc_id is scored and not held out. Texts
have no length limit. Extra columns are kept; those named score and predicted
are replaced by the results.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEATURES = [
    "log_bytes", "bytes_per_word", "upper", "digits", "marks", "exclaims", "bars", "symbols", "stops", "non_ascii",
    "words_per_line", "distinct_words", "repeated_lines", "top_word", "ends_marked", "short_words", "byte_entropy", "longest_word", "joined",
]
BINS = 48  # quantile bins of a feature
PAIR_BINS = 8
ROUNDS, PAIR_ROUNDS, PAIRS, RATE, PATIENCE = 250, 120, 6, 0.1, 25
PRIOR = 1.0  # added to the curvature of a leaf

_BYTES = np.arange(256)
_CLASSES = np.zeros((256, 8))
for _j, _set in enumerate([
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127)),
    b"!", b"|", b"#$%&*@^~+=<>_\\{}[]", b".,;:?", bytes(range(128, 256)),
]):
    _CLASSES[list(_set), _j] = 1


def text_features(text: str | None) -> list[float]:
    """``FEATURES`` of one whole text."""
    text = text or ""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.bincount(data, minlength=256)
    n = max(1, len(data))
    shares = counts @ _CLASSES / n
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    n_words = max(1, len(words))
    tally = Counter(words)
    seen = counts[counts > 0] / n
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    ends = sum(c for w, c in tally.items() if not w[-1].isalnum())
    joined = sum(c for w, c in tally.items() if not w[:-1].isalnum() and len(w) > 1)
    return [
        np.log1p(len(data)), len(data) / n_words, *shares, n_words / max(1, len(lines)), len(tally) / n_words,
        1 - len(set(lines)) / max(1, len(lines)), max(tally.values(), default=0) / n_words,
        ends / n_words, float((lengths <= 3).mean()),
        float(-(seen * np.log2(seen)).sum()), float(lengths.max()), joined / n_words,
    ]


@dataclass
class AdditiveModel:
    """Bin edges, tables and pair tables; ``base`` is the intercept."""

    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of features."""
        total = np.full(len(x), self.base)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[j], x[:, j], side="right")]
        if self.pairs:
            coarse = {j: np.searchsorted(self.pair_edges[j], x[:, j], side="right") for j in {k for p in self.pairs for k in p}}
            for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
                total += table[coarse[a], coarse[b]]
        return logistic(total)


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def quantile_edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Cuts between bins, at middles of neighbouring values."""
    if len(np.unique(values)) < 2:
        return np.empty(0)
    q = np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1], method="lower"))
    after = np.unique(values)
    at = np.searchsorted(after, q, side="right")
    q, at = q[at < len(after)], at[at < len(after)]
    return np.unique((q + after[at]) / 2)


def leaf(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g / (h + PRIOR)


def gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + PRIOR)


def two_cut_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values per bin of the best tree with two cuts (three ranges of bins)."""
    n = len(g)
    if n == 1:
        return leaf(g, h)
    cg, ch = np.concatenate([[0], g.cumsum()]), np.concatenate([[0], h.cumsum()])
    i, j = np.triu_indices(n)  # ranges [0, i), [i, j + 1), [j + 1, n); i = 0 or j + 1 = n leave one cut
    j = j + 1
    total = gain(cg[i], ch[i]) + gain(cg[j] - cg[i], ch[j] - ch[i]) + gain(cg[n] - cg[j], ch[n] - ch[j])
    k = int(total.argmax())
    a, b = int(i[k]), int(j[k])
    out = np.empty(n)
    for s, e in ((0, a), (a, b), (b, n)):
        if e > s:
            out[s:e] = leaf(cg[e] - cg[s], ch[e] - ch[s])
    return out


def quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree that cuts each axis of a pair once."""
    rows, cols = g.shape
    cg, ch = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h))
    parts = []
    for c in (cg, ch):
        a, right, low, everything = c[1:, 1:], c[1:, -1:], c[-1:, 1:], c[-1, -1]
        parts.append((a, right - a, low - a, everything - right - low + a))
    total = sum(gain(x, y) for x, y in zip(*parts, strict=True))
    i, j = np.unravel_index(int(total.argmax()), total.shape)
    out = np.empty((rows, cols))
    for k, (rs, cs) in enumerate(((slice(0, i + 1), slice(0, j + 1)), (slice(0, i + 1), slice(j + 1, None)), (slice(i + 1, None), slice(0, j + 1)), (slice(i + 1, None), slice(j + 1, None)))):
        out[rs, cs] = leaf(parts[0][k][i, j], parts[1][k][i, j])
    base = gain(np.array(cg[-1, -1]), np.array(ch[-1, -1]))
    return float(total[i, j] - base), out


def loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z)) if len(y) else 0.0


def boost(z: np.ndarray, y: np.ndarray, aside: np.ndarray, cells: list[np.ndarray], shapes: list[tuple], rounds: int) -> list[np.ndarray]:
    """Cyclic boosting of one table per entry of ``cells`` (each row's cell number); the tables of the best round."""
    tables = [np.zeros(s) for s in shapes]
    best, least, since = [t.copy() for t in tables], loss(z[aside], y[aside]), 0
    fit = ~aside
    for _ in range(rounds):
        for j, (cell, shape) in enumerate(zip(cells, shapes, strict=True)):
            p = logistic(z)
            size = int(np.prod(shape))
            g = np.bincount(cell[fit], (y - p)[fit], size).reshape(shape)
            h = np.bincount(cell[fit], (p * (1 - p))[fit], size).reshape(shape)
            step = RATE * (two_cut_tree(g, h) if len(shape) == 1 else quadrants(g, h)[1])
            tables[j] += step
            z = z + step.reshape(-1)[cell]
        now = loss(z[aside], y[aside])
        if now < least - 1e-6:
            best, least, since = [t.copy() for t in tables], now, 0
        else:
            since += 1
            if since >= PATIENCE:
                break
    return best


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Model of features ``x`` and labels ``y`` (0 or 1); rows in a fixed order give a fixed model."""
    n = len(y)
    share = float(y.mean()) if n else 0.5
    base = float(np.log(share / (1 - share))) if 0 < share < 1 else (35.0 if share == 1 else -35.0 if n else 0.0)
    if not 0 < share < 1:
        return AdditiveModel(base)
    aside = np.arange(n) % 6 == 5
    edges = [quantile_edges(x[:, j], BINS) for j in range(x.shape[1])]
    cells = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    z = np.full(n, base)
    tables = boost(z, y, aside, cells, [(len(e) + 1,) for e in edges], ROUNDS)
    z = z + sum(t[c] for t, c in zip(tables, cells, strict=True))

    coarse_edges = [quantile_edges(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(coarse_edges)]
    p, kept, found = logistic(z), ~aside, []
    for a in range(x.shape[1]):
        for b in range(a + 1, x.shape[1]):
            shape = (len(coarse_edges[a]) + 1, len(coarse_edges[b]) + 1)
            if min(shape) > 1:
                cell = coarse[a] * shape[1] + coarse[b]
                g, h = (np.bincount(cell[kept], v[kept], shape[0] * shape[1]).reshape(shape) for v in (y - p, p * (1 - p)))
                found.append((quadrants(g, h)[0], a, b))
    pairs = [(a, b) for _, a, b in sorted(found, reverse=True)[:PAIRS]]
    shapes = [(len(coarse_edges[a]) + 1, len(coarse_edges[b]) + 1) for a, b in pairs]
    pair_cells = [coarse[a] * s[1] + coarse[b] for (a, b), s in zip(pairs, shapes, strict=True)]
    pair_tables = boost(z, y, aside, pair_cells, shapes, PAIR_ROUNDS) if pairs else []
    return AdditiveModel(base, edges, tables, pairs, coarse_edges, pair_tables)


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", max_sample: int = 20_000) -> AdditiveModel:
    """Fit on at most ``max_sample`` labelled documents that are not held out."""
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id)))
        .groupBy(F.col(doc_id).alias("_id")).agg(F.min(label).alias("_y"), F.max(label).alias("_top")).where("_y = _top")
    )
    wanted = docs.where(~held_out(F.col(doc_id))).select(F.col(doc_id).alias("_id")).distinct()
    sample = known.join(wanted, "_id", "left_semi").orderBy(F.xxhash64("_id"), "_id").limit(max_sample).select("_id", "_y")
    rows = (
        docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
        .join(F.broadcast(sample), "_id").groupBy("_id", "_y").agg(F.min("_text").alias("_text"))
        .select("_id", "_y", features_udf()("_text").alias("x")).collect()
    )
    rows.sort(key=lambda r: (crc32(str(r["_id"]).encode()), r["_id"]))  # any fixed order unrelated to ids
    x = np.array([r["x"] for r in rows], float).reshape(len(rows), len(FEATURES))
    return fit(x, np.array([float(r["_y"]) for r in rows]))


def features_udf():
    @F.pandas_udf("array<double>")
    def features(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([text_features(t) for t in texts])

    return features


def score_udf(model: AdditiveModel):
    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            x = np.array([text_features(t) for t in texts], float).reshape(len(texts), len(FEATURES))
            yield pd.Series(model.score(x))

    return score


def score_documents(docs: DataFrame, model: AdditiveModel, text: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 if score >= 0.5)."""
    return docs.withColumn("score", score_udf(model)(F.col(text))).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
