"""Run registered queries against their DuckDB oracles: python tests/run_oracle.py [sf_dir] [names...]"""
import json
import sys
import time

sys.path.insert(0, "/root/repo")
sys.path.insert(0, "/root/repo/tests")

from oracle_harness import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from florafold.session import build_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:]
spark = build_session()
con = duck(sf)
Q, O = E.queries(), E.oracle_sql()
bad = 0
for n in (names or list(Q)):
    t = time.time()
    if n not in O:
        df = Q[n](spark, sf)
        print(json.dumps({"name": n, "rows_only": df.count(), "sec": round(time.time() - t, 2)}))
        continue
    try:
        r = compare(spark, con, n, Q[n], O[n], sf)
    except Exception as e:  # noqa: BLE001
        r = {"name": n, "error": str(e)[:800]}
    r["sec"] = round(time.time() - t, 2)
    ok = r.get("hash_match") and r.get("cols_match")
    bad += 0 if ok else 1
    print(("OK  " if ok else "BAD ") + json.dumps(r, default=str))
print("failures:", bad)
