"""URL rules as Bloom filter cascades over the corpus's own keys (DataFrame functions only).

Every url gives a few keys: for each shape (labels in the host, characters in
the path) that occurs among the rules, the host's last labels followed by the
first characters of the path. A rule fits a url exactly if it equals one of
the url's keys, so judging a url is set membership of its keys.

Membership is answered by a cascade. Level 1 is a Bloom filter of the listed
keys; level 2 holds the unlisted keys of the corpus that pass level 1; level 3
the listed keys that pass level 2; and so on until nothing passes wrongly.
As the levels are built from all keys of the corpus, answers for its urls are
exact, and judging needs neither a join nor a shuffle.

Level 1's false positive rate is listed/universe, so about as many keys pass
wrongly as are listed, and all levels are O(listed) bits. The filters travel
as literals; above ``max_listed`` keys the operator joins on the key instead.

Null urls, and urls without ``://``, have empty host and path and no rule.
Repeated rows are judged alike, and an empty table gives an empty result. Extra
columns are kept; those named host, path, rule or verdict are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noteledger.llm.common import checkpoint, fresh

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass(frozen=True)
class Rule:
    """``text`` is host and path, such as ``example.net/en/``."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host):]

    @property
    def shape(self) -> tuple[int, int]:
        return self.host.count(".") + 1, len(self.path)


def url_key(host: Column, path: Column, shape: tuple[int, int]) -> Column:
    """The key of that shape, null if the host or the path is too short for it."""
    labels, chars = shape
    enough = (host != "") & (F.length(path) >= chars) & (F.size(F.split(host, r"\.")) >= labels)
    return F.when(enough, F.concat(F.substring_index(host, ".", -labels), F.substring(path, 1, chars)))


@dataclass(frozen=True)
class Bloom:
    """One level: ``bits`` as bytes, ``size`` bits, ``hashes`` probes, seeded by its number."""

    level: int
    size: int
    hashes: int
    bits: bytes

    def passes(self, key: Column) -> Column:
        found = F.lit(True)
        for at in probes(key, self.level, self.size, self.hashes):
            byte = F.conv(F.hex(F.substring(F.lit(bytearray(self.bits)), F.expr("1") + (at / 8).cast("int"), F.lit(1))), 16, 10).cast("int")
            found = found & (F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(1) == 1)
        return found


def probes(key: Column, level: int, size: int, hashes: int) -> list[Column]:
    first = F.pmod(F.xxhash64(F.lit(2 * level), key), F.lit(size))
    step = F.pmod(F.xxhash64(F.lit(2 * level + 1), key), F.lit(size))
    return [(first + step * i) % size for i in range(hashes)]


def bloom(keys: DataFrame, n: int, rate: float, level: int) -> Bloom:
    """Filter of column ``key`` of ``n`` rows; the driver gets one row per nonzero byte."""
    size = 8 * max(1, math.ceil(n * math.log2(1 / rate) / math.log(2) / 8))
    hashes = max(1, round(size / n * math.log(2)))
    found = (
        keys.select(F.explode(F.array(*probes(F.col("key"), level, size, hashes))).alias("at"))
        .groupBy((F.col("at") / 8).cast("int").alias("byte"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1), (F.col("at") % 8).cast("int"))).alias("bits"))
        .collect()
    )
    bits = bytearray(size // 8)
    for row in found:
        bits[row["byte"]] = row["bits"]
    return Bloom(level, size, hashes, bytes(bits))


def cascade(universe: DataFrame, listed: list[str]) -> list[Bloom]:
    """Levels that answer exactly for every ``key`` of ``universe`` (repeats allowed) and of ``listed``."""
    spark = universe.sparkSession
    keys = spark.createDataFrame([(k,) for k in sorted(set(listed))], "key string")
    n, everything = len(set(listed)), universe.agg(F.approx_count_distinct("key")).first()[0]
    if not n:
        return []
    rate = min(0.5, n / max(1, everything))
    levels = [bloom(keys, n, rate, 1)]
    # about n keys pass wrongly; the further levels work on those and the listed ones
    wrong = checkpoint(universe.where(levels[0].passes(F.col("key"))).distinct().join(keys, "key", "left_anti"))
    rest, n = keys, wrong.count()
    while n:
        levels.append(bloom(wrong, n, 0.5, len(levels) + 1))
        rest, wrong = wrong, checkpoint(rest.where(levels[-1].passes(F.col("key"))))
        n = wrong.count()
    return levels


def is_listed(key: Column, levels: list[Bloom]) -> Column:
    """Number of levels passed in a row is odd: the first failing level decides."""
    out = F.lit(bool(len(levels) % 2))
    for level in reversed(levels):
        wrong = F.lit(level.level % 2 == 0)  # failing an odd level: not listed; an even one: listed
        out = F.when(level.passes(key), out).otherwise(wrong)
    return F.coalesce(key.isNotNull() & out, F.lit(False))


def judge_urls(pages: DataFrame, rules: list[Rule], url: str = "url", default: str = "allow", max_listed: int = 50_000) -> DataFrame:
    """``pages`` with host, path, rule and verdict; the longest fitting rule decides, else ``default``.

    Of fitting rules of one length the one with the longer host is taken.
    A rule listed with two verdicts is an error.
    """
    if len({r.text for r in rules}) < len(set(rules)):
        raise ValueError("a rule has two verdicts")
    parts = pages.withColumn("host", url_host(F.col(url))).withColumn("path", url_path(F.col(url)))
    shapes = sorted({r.shape for r in rules})
    keys = {s: url_key(F.col("host"), F.col("path"), s) for s in shapes}
    verdicts = sorted({r.verdict for r in rules})
    if len(rules) > max_listed:
        return _judge_by_join(parts, rules, list(keys.values()), default)
    universe = parts.select(F.explode(F.array(*keys.values())).alias("key")).where("key is not null") if keys else None
    filters = {v: cascade(universe, [r.text for r in rules if r.verdict == v]) for v in verdicts}
    fits = [
        F.when(is_listed(key, filters[v]), F.struct(F.length(key).alias("n"), (F.length(key) - s[1]).alias("h"), key.alias("rule"), F.lit(v).alias("verdict")))
        for s, key in keys.items() for v in verdicts
    ]
    none = F.lit(None).cast("struct<n:int,h:int,rule:string,verdict:string>")
    best = fresh(parts, "_best")
    judged = parts.withColumn(best, F.array_max(F.array(none, *fits)))
    return judged.withColumn("rule", F.col(best)["rule"]).withColumn("verdict", F.coalesce(F.col(best)["verdict"], F.lit(default))).drop(best)


def _judge_by_join(parts: DataFrame, rules: list[Rule], keys: list[Column], default: str) -> DataFrame:
    """Beyond the bound of the literals: a left join of each key with the rules."""
    spark = parts.sparkSession
    table = spark.createDataFrame([(r.text, r.verdict, len(r.host)) for r in rules], "rule string, verdict string, h int").distinct()
    out, fits = parts, []
    for i, key in enumerate(keys):
        t = table.select(F.col("rule").alias(f"_r{i}"), F.struct(F.length("rule").alias("n"), "h", "rule", "verdict").alias(f"_f{i}"))
        out = out.join(t, key == F.col(f"_r{i}"), "left")
        fits.append(f"_f{i}")
    best = F.array_max(F.array(*fits))
    out = out.withColumn("rule", best["rule"]).withColumn("verdict", F.coalesce(best["verdict"], F.lit(default)))
    return out.drop(*fits, *(f"_r{i}" for i in range(len(keys))))
