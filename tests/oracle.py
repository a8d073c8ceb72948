"""Runs a query and its SQL side by side: row count, column names, and values, in any order."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    db = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            db.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return db


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def compare(df, db, sql):
    got = df.collect()
    names = sorted(df.columns)
    res = db.execute(sql)
    theirs = sorted(c[0] for c in res.description)
    assert names == theirs, (names, theirs)
    rows = res.fetchall()
    at = [[c[0] for c in res.description].index(n) for n in names]
    key = lambda r: tuple((x is not None, str(type(x)) if not isinstance(x, (int, float)) else "", x if not isinstance(x, tuple) else str(x)) for x in r)
    mine = sorted((tuple(plain(r[n]) for n in names) for r in got), key=key)
    want = sorted((tuple(plain(r[i]) for i in at) for r in rows), key=key)
    assert len(mine) == len(want), (len(mine), len(want), [x for x in mine if x not in want][:3], [x for x in want if x not in mine][:3])
    bad = [(a, b) for a, b in zip(mine, want, strict=True) if a != b]
    assert not bad, (len(bad), bad[:3])
    return len(mine)
