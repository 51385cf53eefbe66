"""Runs queries beside their SQL and compares rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

DATA = "/root/testdata"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        place = Path(DATA, sf, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{place}{'/*.parquet' if place.is_dir() else ''}')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark, con, query, sql, sf: str) -> str:
    """What differs between the two results, or an empty text."""
    frame = query(spark, f"{DATA}/{sf}")
    mine = rows_of(frame.columns, frame.collect())
    other = con.execute(sql)
    names = [c[0] for c in other.description]
    theirs = rows_of(names, other.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} and {sorted(names)}"
    if mine != theirs:
        a, b = set(map(repr, mine)), set(map(repr, theirs))
        return f"{len(mine)} and {len(theirs)} rows; only here {sorted(a - b)[:3]}; only there {sorted(b - a)[:3]}"
    return "" if mine else "no rows"


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).parents[1]))
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    session = SparkSession.builder.master("local[3]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "6g").getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    sf = sys.argv[1]
    con, sql = connection(sf), e.oracle_sql()
    for name, q in e.queries().items():
        if name not in sys.argv[2:] if len(sys.argv) > 2 else name.startswith(("op", "pipeline")):
            continue
        began = time.time()
        try:
            said = differences(session, con, q, sql[name], sf) if name in sql else f"(no SQL) {q(session, f'{DATA}/{sf}').count()} rows"
        except Exception as x:
            said = f"{type(x).__name__}: {str(x)[:600]}"
        print(f"{name}: {said or 'same'} [{time.time() - began:.1f} s]", flush=True)
