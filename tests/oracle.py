"""Runs a registered query and its oracle side by side."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _text(x):
    if isinstance(x, float):
        return repr(float(f"{x:.9g}"))
    return str(x)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(str([_text(r[i]) for i in order]) for r in rows)


def oracle_rows(sf_dir, sql):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    r = con.sql(sql)
    return [d[0] for d in r.description], r.fetchall()


def compare(spark, sf_dir, query, sql):
    df = query(spark, sf_dir)
    columns, expected = oracle_rows(sf_dir, sql)
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, expected)
