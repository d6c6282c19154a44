"""Run all registered queries against their SQL: python tests/check_all.py [folder] [name...]."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import differences, oracle_connection  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tallycast.session import build_session  # noqa: E402


def main(folder: str, names: list[str]) -> int:
    spark = build_session(
        "check", master="local[8]", spark__sql__shuffle__partitions="8",
        spark__driver__memory="12g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, query in queries.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        started = time.time()
        try:
            df = query(spark, folder)
            if name in oracles:
                diff = differences(df, con, oracles[name])
                status = "ok" if not diff else "DIFF " + " | ".join(diff)[:1500]
                failed += bool(diff)
            else:
                status = f"rows {len(df.collect())}"
        except Exception as error:  # report and go on with the next query
            failed += 1
            status = f"ERROR {type(error).__name__} {str(error)[:300]!r}"
        print(f"{time.time() - started:6.2f}s {name}: {status}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]) else 0)
