"""Compare registered queries with their SQL on DuckDB: ``python tests/compare.py [sf] [name ...]``."""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def open_duckdb(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canon(rows):
    def cell(x):
        if isinstance(x, bool):
            return ("b", x)
        if isinstance(x, float):
            return ("n", "nan" if math.isnan(x) else repr(x))
        if isinstance(x, int):
            return ("i", str(x))
        return ("s", str(x)) if x is not None else ("0", "")

    return sorted(tuple(cell(x) for x in r) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir):
    """None when equal, else a short description of the difference."""
    df = fn(spark, sf_dir)
    cols = sorted(df.columns)
    got = canon([tuple(r) for r in df.select(*[f"`{c}`" for c in cols]).collect()])
    rel = con.sql(sql)
    if sorted(rel.columns) != cols:
        return f"columns {cols} vs {sorted(rel.columns)}"
    order = [rel.columns.index(c) for c in cols]
    want = canon([tuple(r[i] for i in order) for r in rel.fetchall()])
    if got == want:
        return None
    extra = [r for r in got if r not in set(want)][:2]
    missing = [r for r in want if r not in set(got)][:2]
    return f"rows {len(got)} vs {len(want)}; columns {cols}; only here {extra}; only there {missing}"


def main():
    from stayflow.catalog import QUERIES
    from stayflow.oracles import ORACLES
    from stayflow.session import build_session

    sf_dir = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    only = sys.argv[2:]
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = open_duckdb(sf_dir)
    bad = 0
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        started = time.time()
        try:
            if name in ORACLES:
                diff = compare(spark, con, name, fn, ORACLES[name], sf_dir)
            else:
                diff = f"no SQL, {fn(spark, sf_dir).count()} rows"
        except Exception as problem:
            diff = f"error {str(problem)[:500]}"
        bad += diff is not None
        print(f"{name:26s} {time.time() - started:6.1f}s {'ok' if diff is None else diff}", flush=True)
    print("different:", bad)


if __name__ == "__main__":
    main()
