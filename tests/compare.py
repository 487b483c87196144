"""Compare the ready-made queries with their check SQL. Run as a script: compare.py [dir] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None:
        return "\0"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat(timespec="microseconds") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sf_dir):
    """None if equal, else a text that says how the two results differ."""
    df = query.run(spark, sf_dir)
    got = df.collect()
    result = con.execute(query.check)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a == b:
        return None
    left, right = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    return f"{len(a)} rows != {len(b)} rows; spark only {left[:3]}; check only {right[:3]}"


def main(argv):
    from sensorloom.plans import catalog
    from sensorloom.session import build

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                        "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, q in catalog().items():
        if argv[1:] and name not in argv[1:]:
            continue
        t = time.time()
        try:
            if q.check is None:
                n = q.run(spark, sf_dir).count()
                print(f"rows {name} {n} {time.time() - t:.1f}s", flush=True)
                continue
            diff = compare(spark, con, q, sf_dir)
        except Exception as e:  # report every query
            diff = f"{type(e).__name__}: {str(e)[:600]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'DIFF'} {name} {time.time() - t:.1f}s {diff or ''}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
