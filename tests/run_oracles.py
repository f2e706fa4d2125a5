"""Run queries() against oracle_sql() like the driver does: python tests/run_oracles.py [names...]"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from oracle import compare, duck  # noqa: E402

from effdated.session import get_session  # noqa: E402

if __name__ == "__main__":
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("SESSION_TZ"):
        spark.conf.set("spark.sql.session.timeZone", os.environ["SESSION_TZ"])
    if os.environ.get("HOT_ROWS"):
        spark.conf.set("effdated.scan.hotKeyRows", os.environ["HOT_ROWS"])
    con = duck(sf)
    q, o = E.queries(), E.oracle_sql()
    names = sys.argv[1:] or sorted(q)
    res = {}
    for n in names:
        t = time.time()
        try:
            df = q[n](spark, sf)
            if n in o:
                ok, msg = compare(df, con, o[n])
            else:
                ok, msg = True, f"rows-only {df.count()}"
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:800]}"
        res[n] = ok
        print(f"{'PASS' if ok else 'FAIL'} {n} ({time.time()-t:.1f}s): {msg}", flush=True)
    print(json.dumps({"pass": sum(res.values()), "total": len(res)}))
