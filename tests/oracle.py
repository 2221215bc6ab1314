"""Runs a query and its DuckDB SQL over the same tables and holds the rows against each other."""

import math
from pathlib import Path

import duckdb


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def agree(spark, sf_dir, query, sql):
    got = query(spark, sf_dir)
    con = duckdb.connect()
    for table in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM read_parquet('{table}')")
    con.execute("SET TimeZone='UTC'")
    want = con.execute(sql)
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    ours, theirs = rows_of(got.columns, got.collect()), rows_of(columns, want.fetchall())
    for mine, other in zip(ours, theirs):
        if mine != other:
            raise AssertionError(f"{str(mine)[:600]} is not {str(other)[:600]}")
    assert len(ours) == len(theirs)
