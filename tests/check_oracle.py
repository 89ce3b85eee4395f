"""Run registered queries against their SQL: python tests/check_oracle.py [sf_dir] [name ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession

from tests.compare import difference, views
from tidemark.plans import PLANS


def main(sf_dir="/root/testdata/sf0.01", *names):
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = views(sf_dir)
    failed = 0
    for name in names or PLANS:
        start = time.time()
        try:
            wrong = difference(PLANS[name].run(spark, sf_dir), connection, PLANS[name].sql)
        except Exception as e:
            wrong = f"{type(e).__name__}: {str(e)[:400]}"
        failed += wrong is not None
        print(f"{'ok  ' if wrong is None else 'FAIL'} {name} {time.time() - start:.2f}s {wrong or ''}"[:1200], flush=True)
    print(f"{failed} failed")
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
