"""Development aid: compare all (or named) queries at one scale and print times.

    python tests/run_oracle.py /root/testdata/sf0.01 [name ...]
"""

import os
import sys
import time

from pyspark.sql import SparkSession

sys.path[:0] = [os.path.dirname(os.path.abspath(__file__)), os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]

from compare import connect, difference  # noqa: E402

import __spark_entry__ as contract  # noqa: E402

if __name__ == "__main__":
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, sql = contract.queries(), contract.oracle_sql()
    failed = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            found = difference(df, con, sql[name]) if name in sql else f"rows only: {df.count()}"
        except Exception as err:  # noqa: BLE001
            found = f"{type(err).__name__}: {str(err)[:600]}"
        failed += name in sql and found is not None
        print(f"{name:24} {time.time() - start:6.2f}s  {'ok' if found is None else found}", flush=True)
    print("failed:", failed)
