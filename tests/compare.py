"""Run registered queries against their SQL twins: python tests/compare.py [folder] [name part …]

MAX_SERIES_ROWS=20 makes series above 20 rows count as large, so that the sliced plans run."""

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402


def database(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    return repr(value.item() if hasattr(value, "item") else value)


def compare(df, con, sql):
    """None when both sides agree, else a short text on the difference."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    order = sorted(names)
    want = sorted(tuple(plain(r[names.index(c)]) for c in order) for r in found.fetchall())
    got = sorted(tuple(plain(r[c]) for c in order) for r in df.collect())
    if len(got) != len(want):
        return f"rows {len(got)} against {len(want)}"
    differing = [(a, b) for a, b in zip(got, want) if a != b]
    if differing:
        only_got = sorted(set(got) - set(want))[:2]
        only_want = sorted(set(want) - set(got))[:2]
        return f"{len(differing)} rows differ in {order}\n   ours {only_got}\n   sql  {only_want}"
    return None


def main():
    from vitalgrid.session import get_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = get_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    if os.environ.get("MAX_SERIES_ROWS"):
        spark.conf.set("spark.vitalgrid.maxSeriesRows", os.environ["MAX_SERIES_ROWS"])
    con, oracles = database(folder), entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if parts and not any(name.startswith(p) for p in parts):
            continue
        begin = time.time()
        try:
            df = run(spark, folder)
            if name in oracles:
                problem = compare(df, con, oracles[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        kind = "sql" if name in oracles else "rows"
        print(f"{'FAIL' if problem else 'ok':4} {kind:4} {time.time() - begin:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main()
