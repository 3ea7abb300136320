"""Run every registered query against its oracle: python tests/run_compare.py [sf_dir] [names...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.compare import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from flowlens.session import local_session  # noqa: E402

plain = "--plain" in sys.argv
args = [a for a in sys.argv[1:] if a != "--plain"]
sf = args[0] if args else "/root/testdata/sf0.01"
names = args[1:]
if plain:  # a session with Spark's defaults only, as a driver may build it
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
else:
    spark = local_session()
con = duck(sf)
qs, sql = E.queries(), E.oracle_sql()
bad = 0
for name, fn in qs.items():
    if names and name not in names:
        continue
    t = time.time()
    try:
        df = fn(spark, sf)
        if name in sql:
            problems, n = compare(df, con, sql[name])
        else:
            n, problems = df.count(), []
    except Exception as e:  # noqa: BLE001
        problems, n = [f"ERROR {type(e).__name__}: {str(e)[:400]}"], -1
    status = "OK " if not problems else "BAD"
    bad += bool(problems)
    print(f"{status} {name:28s} rows={n:<7} {time.time() - t:5.1f}s {'oracle' if name in sql else 'rows-only'} {'; '.join(problems)}", flush=True)
print("bad:", bad)
