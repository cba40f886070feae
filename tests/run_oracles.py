"""Run every registered query (or those named) against its SQL: python -m tests.run_oracles [sf_dir] [names…]"""

from __future__ import annotations

import sys
import time

from pyspark.sql import SparkSession

from __spark_entry__ import oracle_sql, queries
from tableshift.session import configure
from tests import oracle


def main(folder: str, names: list[str]) -> int:
    spark = configure(SparkSession.builder.master("local[8]"), **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"}).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = oracle.connect(folder), oracle_sql(), 0
    for name, fn in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            df = fn(spark, folder)
            if name in sqls:
                problem = oracle.compare(df, con, sqls[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as e:  # report every query, then go on
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{name:22s} {time.time() - started:6.2f} s  {problem or 'ok'}{'' if name in sqls else ' (rows only)'}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]) > 0)
