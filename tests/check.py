"""Compare named queries (default: all) with their SQL and print timings.

python tests/check.py [--sf DIR] [name ...]
"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession

from __spark_entry__ import oracle_sql, queries
from comparison import duck, duck_rows, spark_rows


def main(args):
    sf_dir = "/root/testdata/sf0.01"
    if args[:1] == ["--sf"]:
        sf_dir, args = args[1], args[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = duck(sf_dir), oracle_sql(), 0
    for name in args or queries():
        start = time.time()
        try:
            got_columns, got = spark_rows(queries()[name](spark, sf_dir))
            spent = time.time() - start
            start = time.time()
            if name not in sql:
                print(f"rows  {name} {spent:.1f}s {len(got)} {got[:12]}", flush=True)
                continue
            want_columns, want = duck_rows(con, sql[name])
            same = got_columns == want_columns and got == want
            print(f"{'ok   ' if same else 'DIFF '} {name} spark {spent:.1f}s sql {time.time() - start:.1f}s rows {len(got)}",
                  flush=True)
            if not same:
                bad += 1
                print("  ", got_columns, want_columns, len(got), len(want))
                pairs = [(a, b) for a, b in zip(got, want) if a != b]
                print("   differing", len(pairs), pairs[:3], flush=True)
        except Exception as error:
            bad += 1
            print(f"FAIL  {name}: {type(error).__name__}: {str(error)[:6000]}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
