"""Compare every registered query with its SQL in DuckDB: `python tests/check_registered.py [sf_dir] [names...]`."""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def oracle(sf):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(float(r[i]) if type(r[i]) in (int, float) and not isinstance(r[i], bool) else r[i] for i in order) for r in rows]
    return sorted(rows, key=lambda r: [(v is not None, str(type(v)), v if v is not None else 0) for v in r])


def compare(spark, con, name, sf):
    """A text that is empty when Spark and DuckDB give the same rows."""
    df = entry.queries()[name](spark, sf)
    got = plain([tuple(r) for r in df.collect()], df.columns)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return "" if got else "no rows"
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = plain(result.fetchall(), names)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} expected {sorted(names)}"
    if len(got) != len(expected):
        return f"{len(got)} rows expected {len(expected)}"
    if not got:
        return "no rows"
    for a, b in zip(got, expected):
        if a != b:
            return f"{a} expected {b}"
    return ""


if __name__ == "__main__":
    from tidemart.session import session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(sf)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, sf)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    sys.exit(bool(failed))
