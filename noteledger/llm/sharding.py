"""Shards of near equal bytes: minimax contiguous partition of ordered atomic groups.

Documents with equal texts form one atomic group; groups are ordered by the
md5 of their text. The smallest capacity C for which the ordered groups fit
into ``n`` consecutive shards of at most C is found by search over C: a
greedy pass fills each shard as far as C allows, and C is feasible if all
groups are placed after ``n`` shards. The shards are cut where the greedy pass
with the smallest C ends them.

The groups stay distributed. Their running sum is made in 4,096 ranges of the
md5 order (a driver-side table of 4,096 sums links them), and one step of the
greedy pass for ``FAN`` capacities at once is one lookup job: a broadcast of FAN
points, joined with the groups of the ranges they fall in. Groups are written in the order
of their ranges, and a lookup reads those files only that hold ranges between its points. A shard is a range
of md5 values, so documents find their shard by comparing with n-1 literals;
a group of any size is dealt without a join, a shuffle of texts or a window.

A null text has size 1 (no bytes, plus 1), crc32 0 and belongs to the group
of null texts. Repeated rows are rows of their group. An empty table gives no
rows. If one group is larger than total/n, it is the capacity, as it is atomic.
Texts have no length limit. Extra columns are kept by ``assign_shards``, which
replaces those named size, text_key and shard, and ignored by ``shard_slots``.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as WIN

from noteledger.llm.common import NULL_KEY, n_tasks, number_within, small_frame, stored, text_key, utf8_size

RANGES = 4096  # ranges of the group order whose sums the driver holds
FAN = 400  # capacities tried by one greedy pass


class RunningSums:
    """Ordered groups with their running size, and lookups in it."""

    def __init__(self, groups: DataFrame):
        """``groups``: columns key (string, the order) and size (long); keys are unique."""
        spark = groups.sparkSession
        in_range = groups.withColumn("_range", _range())
        by_range = WIN.Window.partitionBy("_range").orderBy("key").rowsBetween(WIN.Window.unboundedPreceding, 0)
        local = in_range.select("key", "_range", F.col("size"), F.sum("size").over(by_range).alias("_sum"))
        # written by ranges, so that a lookup reads the files of the ranges it asks for
        local = stored(local.repartitionByRange(n_tasks(spark), "_range").sortWithinPartitions("_range"))
        sums = {r["_range"]: (r["s"], r["m"]) for r in local.groupBy("_range").agg(F.sum("size").alias("s"), F.max("size").alias("m")).collect()}
        self.ends, at, starts = [], 0, []
        for k in sorted(sums):
            starts.append((k, at))
            at += sums[k][0]
            self.ends.append(at)
        self.ranges = sorted(sums)
        self.total, self.largest = at, max((m for _, m in sums.values()), default=0)
        self.spark = spark
        self.groups = local.join(F.broadcast(small_frame(spark, starts, "_range int, _start long")), "_range").withColumn("end", F.col("_start") + F.col("_sum"))

    def reach(self, points: list[int]) -> list[tuple[int, str | None]]:
        """For each point the last group whose running sum does not exceed it: (running sum, key)."""
        at = [bisect_left(self.ends, p + 1) for p in points]  # ranges before this one end at or below p
        rows = [(i, self.ranges[k], p) for i, (k, p) in enumerate(zip(at, points, strict=True)) if k < len(self.ranges)]
        # a lookup may end in the range before; its last group is asked for as well
        rows += [(i, self.ranges[k - 1], p) for i, (k, p) in enumerate(zip(at, points, strict=True)) if k > 0]
        if not rows:
            return [(0, None)] * len(points)
        near = self.groups.where(F.col("_range").between(min(r for _, r, _ in rows), max(r for _, r, _ in rows)))
        found = (
            near.join(F.broadcast(small_frame(self.spark, rows, "i int, _range int, p long")), "_range")
            .where("end <= p").groupBy("i").agg(F.max(F.struct("end", "key")).alias("best")).collect()
        )
        best = {r["i"]: (r["best"]["end"], r["best"]["key"]) for r in found}
        return [best.get(i, (0, None)) for i in range(len(points))]


def _range():
    """First three hex digits of ``key``; the null texts' key is no md5 and comes last, as in string order."""
    return F.when(F.col("key") == NULL_KEY, F.lit(RANGES - 1)).otherwise(F.conv(F.substring("key", 1, 3), 16, 10).cast("int"))


def smallest_capacity(sums: RunningSums, n: int) -> int:
    """The smallest capacity for which the greedy pass places all groups in ``n`` shards."""
    low = max(sums.largest, -(-sums.total // n))
    high = min(sums.total, -(-sums.total // n) + sums.largest)  # always feasible
    high = max(low, high)
    while low < high:
        tries = sorted({low + (high - low) * j // (FAN + 1) for j in range(FAN + 1)} - {high})
        at = [0] * len(tries)
        for _ in range(n):
            at = [end for end, _ in sums.reach([a + c for a, c in zip(at, tries, strict=True)])]
            if at[0] == sums.total:
                break
        fit = next((c for c, a in zip(tries, at, strict=True) if a == sums.total), high)
        missed = [c for c, a in zip(tries, at, strict=True) if a < sums.total]
        low, high = (missed[-1] + 1 if missed else low), fit
    return high


def cut_keys(sums: RunningSums, n: int) -> list[str]:
    """Last group key of each shard but the final one."""
    capacity, at, cuts = smallest_capacity(sums, n), 0, []
    for _ in range(n - 1):
        at, key = sums.reach([at + capacity])[0]
        if at == sums.total:
            break
        cuts.append(key)
    return cuts


def assign_shards(docs: DataFrame, n: int = 16, text: str = "text") -> DataFrame:
    """``docs`` with size (long), text_key and shard (0 to n-1)."""
    sized = docs.withColumn("size", utf8_size(F.col(text)) + 1).withColumn("text_key", text_key(F.col(text)))
    groups = sized.groupBy(F.col("text_key").alias("key")).agg(F.sum("size").alias("size"))
    sums = RunningSums(groups)
    if not sums.total:
        return sized.withColumn("shard", F.lit(0))
    shard = F.lit(0)
    for cut in cut_keys(sums, n):
        shard = shard + (F.col("text_key") > cut).cast("int")
    return sized.withColumn("shard", shard)


def shard_slots(docs: DataFrame, n: int = 16, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot (0, 1, ... in each shard), grown_shard (null)."""
    rows = assign_shards(docs, n, text).select(
        F.col(doc_id).alias("doc_id"), "size", F.coalesce(F.crc32(F.col(text)), F.lit(0)).cast("long").alias("text_crc32"), "shard", "text_key")
    return number_within(rows, "shard", "slot", ["text_key", "doc_id"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))
