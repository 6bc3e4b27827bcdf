"""Print a compact physical plan (exchanges, joins, aggregates, windows, scans).

usage: python scripts/plan_summary.py sf_dir key [key ...]
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillwise.plans.catalog import QUERIES  # noqa: E402
from tillwise.session import build_session  # noqa: E402

KEEP = re.compile(r"Exchange|Join|Aggregate|Window|FileScan|Subquery|TakeOrdered|Union|Generate|Expand")


def main():
    spark = build_session("local[8]", shuffle_partitions=16)
    sf = sys.argv[1]
    for key in sys.argv[2:]:
        plan = QUERIES[key](spark, sf)._jdf.queryExecution().executedPlan().toString()
        print("=" * 10, key)
        for line in plan.splitlines():
            if KEEP.search(line):
                line = re.sub(r"#\d+L?", "", line)
                line = re.sub(r"(ReadSchema: struct<[^>]{0,80})[^>]*>?", r"\1..>", line)
                line = re.sub(r"Location: InMemoryFileIndex\(1 paths\)\[file:[^\]]*/", "[", line)
                line = re.sub(r", (DataFilters|PartitionFilters): \[[^\]]*\]", "", line)
                print(line[:220])
    spark.stop()


if __name__ == "__main__":
    main()
