"""Compares a query's rows with those of its SQL in DuckDB, without regard to order."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, int):
        return str(value)
    return str(value)


def sql_rows(sf_dir, sql):
    with duckdb.connect() as con:
        con.execute("SET TimeZone = 'UTC'")
        for t in TABLES:
            path = f"{sf_dir}/{t}.parquet"
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}/*.parquet'" if os.path.isdir(path) else f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
        found = con.execute(sql)
        names = [d[0] for d in found.description]
        order = sorted(range(len(names)), key=names.__getitem__)
        return sorted(names), sorted(tuple(plain(r[i]) for i in order) for r in found.fetchall())


def spark_rows(df):
    names = df.columns
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted(tuple(plain(r[i]) for i in order) for r in df.collect())


def check(spark, sf_dir, query, sql):
    got, expected = spark_rows(query(spark, sf_dir)), sql_rows(sf_dir, sql)
    assert got[0] == expected[0]
    assert len(got[1]) == len(expected[1])
    different = [(a, b) for a, b in zip(got[1], expected[1], strict=True) if a != b]
    assert not different, different[:3]
