"""python tests/check_queries.py [folder] [name part ...]: compare queries with their SQL."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402
from wxrisk.session import build_session  # noqa: E402

folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
parts = sys.argv[2:]
spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                      spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
spark.sparkContext.setLogLevel("ERROR")
db, queries, oracles = connect(folder), entry.queries(), entry.oracle_sql()
bad = 0
for name in queries:
    if parts and not any(p in name for p in parts):
        continue
    begin = time.time()
    try:
        problems = compare(spark, db, folder, name, queries, oracles)
    except Exception as error:
        problems = [f"{type(error).__name__}: {str(error)[:600]}"]
    bad += bool(problems)
    print(f"{'FAIL' if problems else 'ok  '} {time.time() - begin:6.2f}s {name}"
          f"{'' if name in oracles else ' (rows only)'} {' | '.join(problems)}", flush=True)
print("failed:", bad, "of", len(queries))
