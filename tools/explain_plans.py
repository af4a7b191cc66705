"""Print the formatted physical plan of registered queries.

Usage: python tools/explain_plans.py [sf_dir] name [name ...]
(no names: every SQL-checked query). Useful to check PushedFilters,
ReadSchema, exchanges and join strategies.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from noteledger.plans.catalog import QUERIES  # noqa: E402
from noteledger.session import get_spark  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if a in QUERIES] or sorted(QUERIES)
    spark = get_spark("local[8]", shuffle_partitions=16)
    for name in names:
        print(f"===== {name}")
        QUERIES[name](spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main()
