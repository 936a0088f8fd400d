"""Run registered queries against their SQL: python tests/check_queries.py [folder] [name ...]"""

import os
import sys
import time

here = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [here, os.path.dirname(here)]

from oracle import compare, connect  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from carepath.registry import ORACLES, QUERIES  # noqa: E402

folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or list(QUERIES)
spark = (
    SparkSession.builder.master("local[8]")
    .config("spark.sql.shuffle.partitions", "8")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.session.timeZone", "UTC")
    .config("spark.driver.memory", "8g")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
con = connect(folder)
bad = 0
for name in names:
    t = time.time()
    try:
        df = QUERIES[name](spark, folder)
        if name in ORACLES:
            problems = compare(df, con, ORACLES[name])
        else:
            problems = [] if df.count() else ["no rows"]
    except Exception as e:  # noqa: BLE001
        problems = [f"{type(e).__name__}: {str(e)[:600]}"]
    bad += bool(problems)
    mark = "ok  " if not problems else "FAIL"
    print(f"{mark} {name} {'' if name in ORACLES else '(rows only) '}{time.time() - t:.2f}s")
    for p in problems:
        print("     ", p[:900])
print(f"{len(names) - bad}/{len(names)} agree")
