"""Compare registered queries with their SQL: ``python tests/check.py [name part ...]``."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry_points
from goldthread.session import build_session
from oracle import compare, duck


def main() -> None:
    folder = os.environ.get("CHECK_DIR", "/root/testdata/sf0.01")
    parts = sys.argv[1:]
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("CHECK_HOT"):  # as on a cluster with hot groups: shuffle joins, salted
        from goldthread.operators import skew
        skew.ROWS_PER_TASK = int(os.environ["CHECK_HOT"])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    con, sqls, bad, slow = duck(folder), entry_points.oracle_sql(), 0, []
    for name, run in entry_points.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            problem = compare(df, con, sqls[name]) if name in sqls else (None if df.count() else "no rows")
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        took = time.time() - start
        slow.append((took, name))
        if problem:
            bad += 1
            print(f"FAIL {name} ({took:.1f}s): {problem[:1500]}", flush=True)
        elif parts:
            print(f"ok   {name} ({took:.1f}s){'' if name in sqls else ' rows only'}", flush=True)
    print(f"{len(slow)} queries, {bad} bad; slowest {[(round(t, 1), n) for t, n in sorted(slow)[::-1][:8]]}")


if __name__ == "__main__":
    main()
