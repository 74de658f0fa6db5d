"""Compare named queries with their oracle SQL. Run directly: python -m tests.oracle_compare SF [name...]"""

import datetime
import math
import sys
import time
from collections import Counter

import duckdb

TEST_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
               "labels conversations").split()


def oracle_connection(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, int):
        return str(v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v if v is None else str(v)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, run, sql):
    """Differences as a list of messages; empty when both sides agree exactly."""
    return compare_frame(run(spark, folder), con, sql)


def compare_frame(df, con, sql):
    left_cols, left = canonical(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    right_cols, right = canonical([d[0] for d in cur.description], cur.fetchall())
    if left_cols != right_cols:
        return [f"columns {left_cols} != {right_cols}"]
    out = []
    if left != right:
        only_l, only_r = left - right, right - left
        out.append(f"rows {sum(left.values())} vs {sum(right.values())}; only spark {sum(only_l.values())} "
                   f"{sorted(map(str, only_l))[:2]}; only oracle {sum(only_r.values())} {sorted(map(str, only_r))[:2]}")
    return out


def main(argv):
    from lakemart.session import build_session
    import __spark_entry__ as entry
    folder = f"/root/testdata/sf{argv[0]}"
    names = argv[1:]
    spark = build_session("compare", master="local[8]", shuffle_partitions=8, **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            if name in oracles:
                problems = compare(spark, con, folder, queries[name], oracles[name])
            else:
                problems = [] if queries[name](spark, folder).count() else ["no rows"]
        except Exception as e:  # report and go on
            problems = [f"{type(e).__name__}: {str(e)[:900]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s "
              f"{'' if name in oracles else '(no oracle)'} {' '.join(problems)}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
