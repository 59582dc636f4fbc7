"""Run every query against DuckDB: python tests/check_all.py [sf_dir] [names...]."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession

from __spark_entry__ import oracle_sql, queries
from compare import connect, difference


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle = connect(sf_dir), oracle_sql()
    bad = 0
    for name, query in queries().items():
        if name not in oracle or (wanted and name not in wanted):
            continue
        start = time.time()
        try:
            problem = difference(query(spark, sf_dir), con, oracle[name])
        except Exception:
            problem = traceback.format_exc(limit=-3)[-1500:]
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
