"""Run registered queries against their oracle SQL: ``python tests/check.py [SF] [NAME ...]``."""

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from oddsline.session import build_session  # noqa: E402
from tests.oracle import connect, differences  # noqa: E402


def main() -> None:
    folder = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    names = sys.argv[2:] or list(queries())
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="check-"),
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="check-")})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), 0
    for name in names:
        started = time.time()
        try:
            df = queries()[name](spark, folder)
            sql = oracle_sql().get(name)
            problems = differences(df, con, sql) if sql else []
            count = "" if sql else f" ({df.count()} rows, no oracle)"
        except Exception as error:  # report and go on with the other queries
            problems, count = [f"{type(error).__name__}: {str(error)[:1500]}"], ""
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - started:.1f}s{count}", flush=True)
        for problem in problems:
            print("    ", problem, flush=True)
    print(f"{len(names) - failed} of {len(names)} match")


if __name__ == "__main__":
    main()
