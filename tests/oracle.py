"""Rows of a query and of its SQL, in a form that compares."""

from pathlib import Path

import duckdb

from tables import DATA, TABLES


def plain(value):
    if isinstance(value, float):
        return "null" if value != value else f"{value:.9g}"
    return "null" if value is None else str(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def of_sql(sql: str, sf: str):
    con = duckdb.connect()
    for t in TABLES:
        path = Path(DATA, sf, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    rel = con.sql(sql)
    columns = list(rel.columns)
    return columns, rel.fetchall()


def check(spark, query, sql: str, sf: str = "sf0.001"):
    df = query(spark, str(DATA / sf))
    columns, rows = of_sql(sql, sf)
    assert sorted(df.columns) == sorted(columns)
    assert sorted_rows(df.columns, [tuple(r) for r in df.collect()]) == sorted_rows(columns, rows)
