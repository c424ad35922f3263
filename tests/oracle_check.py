"""Run queries next to their SQL and compare rows, names and kinds of types."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


# Dates, timestamps, decimals and huge integers are left out: results use plain types only.
KINDS = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
         "VARCHAR[]": "array<string>"}


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, decimal.Decimal):
        return "dec " + str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(cell(x) for x in v) + "]"
    if hasattr(v, "item"):
        return cell(v.item())
    return str(v)


def compare(spark, con, name, make, sql, sf_dir):
    df = make(spark, sf_dir)
    got_names = sorted(df.columns)
    got = sorted("|".join(cell(r[c]) for c in got_names) for r in df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    rows = cur.fetchall()
    want_names = sorted(names)
    if got_names != want_names:
        return f"columns differ: {got_names} / {want_names}"
    at = [names.index(c) for c in want_names]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    mismatch = {c: (t, kinds[c]) for c, t in df.dtypes if KINDS.get(kinds[c]) != t}
    if mismatch:
        return f"types differ: {mismatch}"
    want = sorted("|".join(cell(r[i]) for i in at) for r in rows)
    if len(got) != len(want):
        return f"row counts differ: {len(got)} / {len(want)}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first: {bad[0]} columns {got_names}"
    return f"ok {len(got)} rows"


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry

    from lapwise.session import build_session

    sf = sys.argv[1]
    only = sys.argv[2:]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": os.environ.get("PARTITIONS", "8"), "spark.driver.memory": "8g",
                                                "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    if os.environ.get("HOT_ROWS"):
        spark.conf.set("spark.lapwise.hotGroupRows", os.environ["HOT_ROWS"])
    con = connect(sf)
    sql = entry.oracle_sql()
    for name, make in entry.queries().items():
        if only and not any(o in name or make.__module__.endswith(o) for o in only):
            continue
        start = time.time()
        try:
            if name in sql:
                result = compare(spark, con, name, make, sql[name], sf)
            else:
                result = f"ok (no sql) {make(spark, sf).count()} rows"
        except Exception as error:
            result = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        flag = "    " if result.startswith("ok") else "!!! "
        print(f"{flag}{name}: {result} [{time.time() - start:.1f}s]", flush=True)
