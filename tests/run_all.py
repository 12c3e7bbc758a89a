"""Run every query at one scale and print how it compares; for use while developing.

usage: python tests/run_all.py [sf_dir] [name part ...]
"""

import sys
import time
import traceback
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from tests.compare import database, differences  # noqa: E402

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
parts = sys.argv[2:]
builder = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
spark = builder.config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
con, sqls, bad = database(sf_dir), oracle_sql(), []
for name, run in queries().items():
    if parts and not any(p in name for p in parts):
        continue
    start = time.time()
    try:
        df = run(spark, sf_dir)
        if name in sqls:
            found = differences(df, con, sqls[name])
            state = "ok" if not found else "; ".join(found)
            if found:
                bad.append(name)
        else:
            state = f"{len(df.collect())} rows"
    except Exception as e:
        state = f"FAILED {type(e).__name__}: {str(e)[:600]}"
        if parts:
            traceback.print_exc()
        bad.append(name)
    print(f"{time.time() - start:6.2f}s {name}: {state}", flush=True)
print("bad:", bad)
