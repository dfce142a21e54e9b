"""Compare registered queries with their SQL: ``python tests/check_all.py SF_DIR [names...]``."""

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession

from tests.compare import connect, differences


def main():
    import __spark_entry__ as entry
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, build in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = build(spark, sf_dir)
            if name in oracle:
                text = differences(df, con, oracle[name])
            else:
                text = "" if df.count() else "EMPTY"
        except Exception as error:
            text = "ERROR " + str(error)[:1500]
            if names:
                traceback.print_exc()
        bad += bool(text)
        print(f"{'ok ' if not text else 'BAD'} {name} {time.time() - start:.1f}s "
              f"{'' if name in oracle else '(rows only) '}{text}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
