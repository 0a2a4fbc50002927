"""Run registered queries next to their SQL: python -m verification.check [folder] [name ...]"""

from __future__ import annotations

import sys
import time

from claimlens.session import build_session
from verification.harness import connect, differences, oracle_rows, spark_rows
from verification.load import REGISTRY


def main(base: str, names: list[str]) -> int:
    spark = build_session(
        "check", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.driver.memory": "8g",
           "spark.sql.warehouse.dir": "/tmp/claimlens-warehouse"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(base)
    failed = 0
    for name in names or REGISTRY:
        run, sql = REGISTRY[name]
        start = time.time()
        try:
            got = spark_rows(run(spark, base))
            took = time.time() - start
            if sql is None:
                print(f"rows {name} {len(got[1])} rows {took:.1f}s {got[0]}", flush=True)
                continue
            start = time.time()
            bad = differences(got, oracle_rows(db, sql))
            oracle_took = time.time() - start
        except Exception as error:  # report and go on to the next query
            print(f"ERROR {name}: {str(error)[:1500]}", flush=True)
            failed += 1
            continue
        print(f"{'ok  ' if not bad else 'BAD '} {name} {len(got[1])} rows {took:.1f}s (sql {oracle_took:.1f}s)", flush=True)
        for line in bad:
            print("   ", line)
        failed += bool(bad)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(1 if main(folder, sys.argv[2:]) else 0)
