"""Run every registered query against its oracle: python tests/run_oracles.py [sf_dir] [names...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from oracle_harness import compare, duck  # noqa: E402
from trustfeed.session import build_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = build_session()
    con = duck(sf_dir)
    qs, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracles:
                problems, n = compare(df, con, oracles[name])
                status = "OK" if not problems else "FAIL " + "; ".join(problems)
            else:
                n = df.count()
                status = "rows-only"
        except Exception as e:  # noqa: BLE001
            status, n = f"ERROR {type(e).__name__}: {str(e)[:300]}", -1
        if status.startswith(("FAIL", "ERROR")):
            bad += 1
        print(f"{name:32s} {n:8d} {time.time() - t:6.1f}s {status}", flush=True)
    print(f"{bad} failing of {len([q for q in qs if not only or q in only])}")
    spark.stop()


if __name__ == "__main__":
    main()
