"""Run by hand: ``python tests/check_all.py [sf] [name-part ...]`` compares every query with its oracle."""

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import compare, connect  # noqa: E402

from tallyforge.plans.catalog import CATALOG  # noqa: E402
from tallyforge.session import local_session  # noqa: E402

if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    parts = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session(8)
    con = connect(sf_dir)
    failed = 0
    for name, q in CATALOG.items():
        if parts and not any(p in name or any(c.startswith(p) for c in q.covers) for p in parts):
            continue
        started = time.time()
        try:
            if q.sql:
                problem = compare(spark, name, q, sf_dir, con)
            else:
                rows = q(spark, sf_dir).collect()
                problem = None if rows else "no rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:400]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - started:.1f}s {'' if q.sql else '(rows only)'} {problem or ''}", flush=True)
    print("failed:", failed)
