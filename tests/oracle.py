"""Run the catalog next to its SQL twins and report every difference.

    python tests/oracle.py [sf_dir] [name ...]
"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(repr(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, run, sql):
    """None if equal, else what differs first."""
    df = run(spark, sf_dir)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    theirs = rows_of([d[0] for d in rel.description], rel.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if ours[1] == theirs[1]:
        return None
    a, b = set(ours[1]), set(theirs[1])
    return (
        f"rows {len(ours[1])} / {len(theirs[1])}; only here {[str(x)[:400] for x in sorted(a - b)[:2]]}; "
        f"only twin {[str(x)[:400] for x in sorted(b - a)[:2]]}"
    )


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(e.queries())
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, bad = connect(sf_dir), e.oracle_sql(), 0
    for name in chosen:
        t = time.time()
        try:
            if name in oracle:
                diff = compare(spark, con, sf_dir, e.queries()[name], oracle[name])
            else:
                diff = None if e.queries()[name](spark, sf_dir).count() else "no rows"
        except Exception as x:  # noqa: BLE001
            diff = f"{type(x).__name__}: {str(x)[:700]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'DIFF'} {name} {time.time() - t:.1f}s {diff or ''}", flush=True)
    print(f"{len(chosen) - bad}/{len(chosen)} equal")


if __name__ == "__main__":
    main()
