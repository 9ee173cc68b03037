"""Run registered queries beside their SQL and compare whole results."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
EMPTY = "EMPTY on both sides"
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN"}


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(df, con, sql):
    """None when both sides hold the same columns, types and rows; else what differs."""
    cur = con.execute(sql)
    sql_types = {d[0]: str(d[1]) for d in cur.description}
    order = sorted(sql_types)
    names = [d[0] for d in cur.description]
    pick = [names.index(c) for c in order]
    want = Counter(tuple(r[i] for i in pick) for r in cur.fetchall())
    spark_types = {f.name: TYPES.get(f.dataType.simpleString(), "?" + f.dataType.simpleString())
                   for f in df.schema}
    if spark_types != sql_types:
        diff = {k: (spark_types.get(k), sql_types.get(k))
                for k in spark_types.keys() | sql_types.keys()
                if spark_types.get(k) != sql_types.get(k)}
        return f"schema (spark, sql): {diff}"
    got = Counter(tuple(r) for r in df.select(*order).collect())
    if got != want:
        return (f"rows spark {sum(got.values())} sql {sum(want.values())}; columns {order}; "
                f"only spark {list((got - want).items())[:3]}; only sql {list((want - got).items())[:3]}")
    if not got:
        return EMPTY
    return None


def main(argv):
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries

    from footings.session import get_session

    sf_dir = argv[0]
    wanted = argv[1:]
    spark = get_session("oracle", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g", "spark.log.level": "ERROR"})
    con = connect(sf_dir)
    sql = oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sql:
                problem = compare(df, con, sql[name])
            else:
                rows = df.collect()
                problem = None if rows else "no rows"
                print(f"     rows-only {name}: {len(rows)} rows", rows[:2])
        except Exception as exc:  # noqa: BLE001
            problem = f"{type(exc).__name__}: {str(exc)[:900]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s"
              + (f"\n     {problem}" if problem else ""), flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
