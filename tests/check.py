"""python tests/check.py [sf0.01] [query ...]: compare queries with their SQL, with timings."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402


def main(argv):
    sf = argv[0] if argv else "sf0.01"
    sf_dir = f"/root/testdata/{sf}"
    spark = (
        SparkSession.builder.master("local[8]").appName("check")
        .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracle = connect(sf_dir), entry.queries(), entry.oracle_sql()
    bad = []
    for name in argv[1:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracle:
                problems = compare(df, con, oracle[name])
            else:
                problems = [] if df.count() else ["no rows"]
        except Exception as e:  # report and go on with the other queries
            problems = [f"{type(e).__name__}: {str(e)[:1500]}"]
        print(f"{'ok ' if not problems else 'BAD'} {name} {time.time() - start:.2f}s {problems or ''}", flush=True)
        if problems:
            bad.append(name)
    print(f"{len(bad)} bad: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
