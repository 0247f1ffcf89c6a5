"""Run every registered query against its DuckDB oracle: ``python tools_check.py [sf_dir] [names...]``."""

import sys
import time

from wattline.registry import ORACLES, QUERIES
from wattline.session import get_session
from wattline.testing import compare, duckdb_connection

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or list(QUERIES)
spark = get_session("local[8]", shuffle_partitions=8)
spark.sparkContext.setLogLevel("ERROR")
con = duckdb_connection(sf_dir)
bad = 0
for name in names:
    t = time.time()
    try:
        df = QUERIES[name](spark, sf_dir)
        if name in ORACLES:
            ok, msg = compare(df, con, ORACLES[name])
        else:
            ok, msg = True, f"{df.count()} rows (no oracle)"
    except Exception as e:  # report and go on
        ok, msg = False, f"{type(e).__name__}: {str(e)[:600]}"
    bad += not ok
    print(f"{'OK ' if ok else 'BAD'} {name:28s} {time.time() - t:6.1f}s  {msg}", flush=True)
print(f"{len(names) - bad}/{len(names)} passed")
