"""Print the physical plan of a registered query, before and after execution.

Usage: python tools/explain.py <query> [sf_dir]

The first plan is what Catalyst chose from estimates; the second is the final
adaptive plan (AQE's join strategies, coalesced and split partitions) after a
``noop`` write has run it to completion.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfcast.plans.catalog import QUERIES  # noqa: E402
from shelfcast.session import build_session  # noqa: E402


def main() -> None:
    name = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    df = QUERIES[name](spark, sf_dir)
    df.explain("formatted")
    df.write.format("noop").mode("overwrite").save()
    print("== final adaptive plan ==")
    print(df._jdf.queryExecution().executedPlan().toString())
    spark.stop()


if __name__ == "__main__":
    main()
