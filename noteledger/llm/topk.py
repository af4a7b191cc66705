"""Exact top-k search by inner product: tiled matrix products and a tree merge.

Queries are dealt into tiles of about ``query_tile`` rows and candidates into
shards of about ``shard_rows``; each pair of a tile and a shard is one matrix
product in one task, with memory bounded by the two sizes (scores are made
``STRIP`` queries at a time). A tile's product is cut at once to the k best of
each query, and these short lists are merged in groups of ``MERGE`` shards,
level by level, so no task sees all lists of many queries.

Products are exact: components are integers, and as long as dimension x
largest product stays below 2**53 they are summed in doubles without
rounding; beyond that the tile uses Python integers. A score that does not
fit a long is an error.

Rows without an id, with a null vector, or with a null, NaN or infinite
component take no part. Vectors of different lengths are not compared (a tile
holds one length). Repeated rows are candidates of their own; only the query's
own row is left out. Ties go to the smaller id, then to the earlier row.
Empty tables give empty results, and extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as WIN

from noteledger.llm.common import checkpoint

STRIP = 256  # queries whose scores are in memory at once
MERGE = 32  # lists that one merge task joins for a query
EXACT = float(2**53)

PARTIAL = "query_row long, query_id long, vec_id long, row long, score long, shard int"


def usable(vector: Column) -> Column:
    """True for vectors whose components are all finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact integer product of two float matrices that hold integers."""
    if not left.size or left.shape[1] * np.abs(left).max() * np.abs(right).max() < EXACT:
        return left @ right.T
    return np.array([[int(x) for x in row] for row in left], object) @ np.array([[int(x) for x in row] for row in right], object).T


def best_of_tile(key: tuple, queries: pd.DataFrame, shard: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best candidates of each query of one tile in one shard."""
    out = []
    if len(queries) and len(shard):
        shard = shard.sort_values(["vec_id", "row"])
        right = np.stack(shard["vector"].to_numpy()).astype(float)
        ids, rows = shard["vec_id"].to_numpy(), shard["row"].to_numpy()
        for a in range(0, len(queries), STRIP):
            some = queries.iloc[a:a + STRIP]
            own = some["q_row"].to_numpy()
            scores = product(np.stack(some["q_vector"].to_numpy()).astype(float), right)
            self_at = own[:, None] == rows[None, :]
            if scores.dtype == object:
                picks = [[j for j in sorted(range(len(ids)), key=lambda j: -line[j]) if not same[j]][:k] for line, same in zip(scores, self_at, strict=True)]
                at, col = (np.array(x, int) for x in zip(*[(i, j) for i, p in enumerate(picks) for j in p], strict=True)) if any(picks) else (np.array([], int),) * 2
            else:
                scores[self_at] = -np.inf
                if scores.shape[1] > k:  # keep what reaches the k-th best score; ties are cut below
                    limit = np.partition(scores, -k, axis=1)[:, -k]
                    at, col = np.nonzero((scores >= limit[:, None]) & ~self_at)
                else:
                    at, col = np.nonzero(~self_at)
                order = np.lexsort((col, -scores[at, col], at))
                at, col = at[order], col[order]
                nth = np.arange(len(at)) - np.searchsorted(at, at)
                at, col = at[nth < k], col[nth < k]
            out.append(pd.DataFrame({"query_row": own[at], "query_id": some["q_id"].to_numpy()[at], "vec_id": ids[col], "row": rows[col], "score": np.array([int(x) for x in scores[at, col]], dtype="int64"), "shard": np.int32(key[1])}))
    return pd.concat(out) if out else pd.DataFrame({c.split()[0]: pd.Series(dtype=c.split()[1].replace("long", "int64").replace("int ", "int32")) for c in PARTIAL.split(", ")})


def merge_lists(lists: DataFrame, shards: int, k: int) -> DataFrame:
    """Tree merge: ``MERGE`` lists of a query become one on each level."""
    while True:
        shards = -(-shards // MERGE)
        lists = lists.withColumn("shard", (F.col("shard") / MERGE).cast("int"))
        best = WIN.Window.partitionBy("query_row", "shard").orderBy(F.desc("score"), "vec_id", "row")
        lists = lists.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        if shards <= 1:
            return lists


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding",
          scale: float = 256.0, shard_rows: int = 8192, query_tile: int = 4096) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best of all other rows for each row with ``is_query``.

    Components are floor(scale * x), taken as double.
    """
    whole = F.transform(F.col(vector), lambda x: _floor(x.cast("double") * scale))
    rows = checkpoint(
        vectors.where(F.col(vec_id).isNotNull() & usable(F.col(vector)))
        .select(F.col(vec_id).cast("long").alias("vec_id"), whole.alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("dim", F.size("vector"))
    )
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("q")).first()
    shards, tiles = max(1, -(-sizes["n"] // shard_rows)), max(1, -(-sizes["q"] // query_tile))
    shard = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")
    tile = F.pmod(F.xxhash64(F.lit(1), F.col("row")), F.lit(tiles)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = rows.where("asks").select(F.col("vec_id").alias("q_id"), F.col("row").alias("q_row"), F.col("vector").alias("q_vector"), "dim", tile.alias("tile")).withColumn("shard", every(shards))
    # both sides come from one frame: fresh columns, else Spark takes them for the same
    held = rows.select(*(F.col(c).alias(c) for c in ("vec_id", "row", "vector", "dim")), shard.alias("shard")).withColumn("tile", every(tiles))
    lists = (
        asked.groupBy("tile", "shard", "dim")
        .cogroup(held.groupBy("tile", "shard", "dim"))
        .applyInPandas(lambda key, a, b: best_of_tile(key, a, b, k), PARTIAL)
    )
    return merge_lists(lists, shards, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _floor(x: Column) -> Column:
    """Floor that stays a double, whatever the size."""
    return x - F.pmod(x, F.lit(1.0))
