"""Run a registered query and its SQL on the same tables and compare rows."""

import glob
import os
from collections import Counter

import duckdb

from __spark_entry__ import oracle_sql, queries


def database(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def differences(spark, con, name: str, sf_dir: str) -> tuple[int, int, list, list]:
    df = queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = Counter(tuple(r) for r in df.select(columns).collect())
    cur = con.execute(oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns, (sorted(names), columns)
    at = [names.index(c) for c in columns]
    theirs = Counter(tuple(r[i] for i in at) for r in cur.fetchall())
    types = {c: t for c, t in zip(names, (str(d[1]) for d in cur.description))}
    kinds = [(c, t, types[c]) for c, t in sorted(df.dtypes)]
    return sum(ours.values()), sum(theirs.values()), list((ours - theirs).items())[:3] + list((theirs - ours).items())[:3], kinds
