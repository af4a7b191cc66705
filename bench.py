"""Benchmark: every registered query on $BENCH_SF_DIR at local[$BENCH_CPUS].

SQL-checked queries: one warm-up, then the median of 3 timed runs. Spark ML
queries (model fits): one timed run. Each run evaluates the whole result
with the ``noop`` sink (no collection to the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from noteledger.plans.catalog import QUERIES  # noqa: E402
from noteledger.plans.ml import ML_QUERIES  # noqa: E402
from noteledger.plans.surface import QUERIES as SURFACE_QUERIES  # noqa: E402
from noteledger.session import get_spark  # noqa: E402
from noteledger.sources.tables import read_table  # noqa: E402

THROUGHPUT = ["clean_text", "lexicon_counts", "term_df_idf"]


def run_once(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    with_ml = os.environ.get("BENCH_ML", "1") != "0"
    only = set(filter(None, os.environ.get("BENCH_ONLY", "").split(",")))
    spark = get_spark(f"local[{cpus}]", app_name="noteledger-bench", shuffle_partitions=2 * cpus,
                      extra_conf={"spark.driver.memory": "16g"})

    timings: dict[str, float] = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        run_once(spark, fn, sf_dir)
        timings[name] = round(statistics.median(run_once(spark, fn, sf_dir) for _ in range(reps)), 4)
        print(f"{name}: {timings[name]}s", file=sys.stderr)
    # round trips through files, the same reports as SQL, text vectors: one warm-up, one timed run, not in the sum
    surface: dict[str, float] = {}
    for name, fn in SURFACE_QUERIES.items():
        if only and name not in only:
            continue
        run_once(spark, fn, sf_dir)
        surface[name] = round(run_once(spark, fn, sf_dir), 4)
        print(f"{name}: {surface[name]}s", file=sys.stderr)
    ml_timings: dict[str, float] = {}
    if with_ml:
        for name, fn in ML_QUERIES.items():
            if only and name not in only:
                continue
            ml_timings[name] = round(run_once(spark, fn, sf_dir), 4)
            print(f"{name}: {ml_timings[name]}s", file=sys.stderr)

    n_docs = read_table(spark, sf_dir, "documents").count()
    rps = {q: round(n_docs / timings[q], 1) for q in THROUGHPUT if q in timings and timings[q] > 0}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 4),
        "unit": "sec",
        "queries": {**timings, **surface, **ml_timings},
        "ml_total_sec": round(sum(ml_timings.values()), 4),
        "records_per_sec": rps,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
