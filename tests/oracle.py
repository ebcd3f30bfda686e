"""Compares registered queries with their oracles: python tests/oracle.py [sf] [name part ...]."""

import math
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark, con, name, query, sql, sf_dir):
    df = query(spark, sf_dir)
    cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    want_cols, want = rows_of([c[0] for c in res.description], res.fetchall())
    if cols != want_cols:
        return f"columns {cols} {want_cols}"
    if got != want:
        extra, missing = set(map(repr, got)) - set(map(repr, want)), set(map(repr, want)) - set(map(repr, got))
        return f"rows {len(got)} {len(want)}; only here {len(extra)} {sorted(extra)[:2]}; only there {len(missing)} {sorted(missing)[:2]}"
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    from voxlake import registry

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.001"
    sf_dir = f"/root/testdata/{sf}"
    spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    for name, query in registry.QUERIES.items():
        if len(sys.argv) > 2 and not any(name.startswith(p) for p in sys.argv[2:]):
            continue
        began = time.time()
        try:
            if name in registry.ORACLES:
                said = differences(spark, con, name, query, registry.ORACLES[name], sf_dir)
            else:
                said = None if query(spark, sf_dir).count() else "no rows"
        except Exception as e:
            said = f"{type(e).__name__}: {str(e)[:400]}"
        print(f"{'ok  ' if said is None else 'FAIL'} {name} {time.time() - began:.1f}s {'' if name in registry.ORACLES else '(no oracle) '}{said or ''}", flush=True)
