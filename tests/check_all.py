"""Run queries against their oracles from the command line: `check_all.py SF_DIR [NAME ...]`."""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

import __spark_entry__ as entry  # noqa: E402
import parity  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402


def main() -> int:
    sf_dir, *names = sys.argv[1:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = parity.connect(sf_dir)
    oracles = entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            result = query(spark, sf_dir)
            if name in oracles:
                found = parity.differences(result, connection, oracles[name])
            else:
                found = []
                print(f"{name}: {result.count()} rows, no oracle")
        except Exception as error:  # report every query, whatever breaks
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s", *found, sep="\n  " if found else " ", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main()))
