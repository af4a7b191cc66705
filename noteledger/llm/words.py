"""Word streams of Arrow text columns, without a Python object per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

FOLD = np.uint64(0x9E3779B97F4A7C15)


def translated(texts: pa.Array, table: bytes) -> pa.Array:
    """``texts`` with every byte replaced by ``table``; nulls are empty. The table must keep UTF-8 valid."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, ends, data = texts.buffers()
    if data is None or not len(texts):
        return pa.array([""] * len(texts), pa.large_string())
    # a slice shares the buffer of its whole column; only its own bytes are copied
    ends = np.frombuffer(ends, np.int64, len(texts) + 1, 8 * texts.offset)
    body = data.slice(ends[0], ends[-1] - ends[0]).to_pybytes().translate(table)
    return pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(ends - ends[0]), pa.py_buffer(body)], 0)


def lists_flat(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Values of a list column in a row, and the number of each row's values."""
    return pc.list_flatten(lists), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)


def encoded(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct words and, per word, its place among them."""
    found = words.dictionary_encode()
    return found.dictionary, found.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words between ASCII white space: distinct words, the place of each word among them, words per text."""
    flat, n = lists_flat(pc.ascii_split_whitespace(texts))
    keep = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0  # white space at an end leaves an empty word
    row = np.repeat(np.arange(len(n)), n)
    distinct, ids = encoded(flat.filter(pa.array(keep)))
    return distinct, ids, np.bincount(row[keep], minlength=len(n))


def word_hashes(distinct: pa.Array) -> np.ndarray:
    """64-bit hash of each word's bytes."""
    data = distinct.cast(pa.large_binary()).to_pylist()
    return np.fromiter(map(xxhash.xxh64_intdigest, data), np.uint64, len(data))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` hashes from each place on; the last k - 1 places have none."""
    n = max(0, len(h) - k + 1)
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = mixed(out * FOLD + h[i:n + i])
    return out


def starts_of(n: np.ndarray) -> np.ndarray:
    """First place of each of some runs of ``n`` values."""
    return np.cumsum(n) - n


def joined(distinct: pa.Array, ids: np.ndarray, n: np.ndarray) -> pa.Array:
    """Runs of ``n`` words each, as text with single spaces."""
    ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), distinct.cast(pa.string()).take(pa.array(ids))), " ")
