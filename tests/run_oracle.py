"""CLI: python tests/run_oracle.py [sf_dir] [key ...]"""
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_harness import compare  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from cabwise.session import build_session  # noqa: E402

args = [a for a in sys.argv[1:] if a != "--vanilla"]
sf = args[0] if args else "/root/testdata/sf0.01"
keys = args[1:]
if "--vanilla" in sys.argv:   # a plain session, as an outside caller would have
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
else:
    spark = build_session("local[8]", shuffle_partitions=8)
q, o = E.queries(), E.oracle_sql()
bad = 0
for k in (keys or list(q)):
    t = time.time()
    if k not in o:
        n = q[k](spark, sf).count()
        print(json.dumps({"key": k, "rows_spark": n, "oracle": None, "sec": round(time.time() - t, 2)}))
        continue
    try:
        r = compare(spark, sf, k, q[k], o[k])
    except Exception as e:  # report and continue
        r = {"key": k, "error": repr(e)[:400]}
    r["sec"] = round(time.time() - t, 2)
    ok = r.get("hash_match") and r.get("cols_match") and r.get("rows_spark") == r.get("rows_oracle")
    bad += 0 if ok else 1
    print(("OK  " if ok else "BAD ") + json.dumps(r, default=str)[:1500])
print("failures:", bad)
