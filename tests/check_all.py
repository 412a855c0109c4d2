"""Compare every registered query with its SQL: python tests/check_all.py [sf_dir] [name ...]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402
from quotelake.session import build_session  # noqa: E402
from tests.oracle import compare  # noqa: E402

if __name__ == "__main__":
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = build_session("local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    sql, bad = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if args[1:] and name not in args[1:]:
            continue
        t = time.time()
        try:
            df = query(spark, sf_dir)
            rows, problem = compare(df, sql[name], sf_dir) if name in sql else (df.count(), None)
        except Exception as e:
            rows, problem = 0, f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:24} {rows:8} rows {time.time() - t:6.2f}s {problem or ''}", flush=True)
    print("failures:", bad)
    sys.exit(bad > 0)
