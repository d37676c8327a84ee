"""Runs a query and its DuckDB counterpart and compares names, types and rows."""

from collections import Counter

import duckdb
from pyspark.sql import types as T

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
TYPES = {
    T.IntegerType: "INTEGER",
    T.LongType: "BIGINT",
    T.DoubleType: "DOUBLE",
    T.StringType: "VARCHAR",
    T.BooleanType: "BOOLEAN",
    T.TimestampNTZType: "TIMESTAMP",
}


def connect(folder):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return connection


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def assert_same(df, sql, connection):
    relation = connection.sql(sql)
    assert sorted(df.columns) == sorted(relation.columns)
    mine = {f.name: TYPES[type(f.dataType)] for f in df.schema.fields}
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    assert mine == theirs
    left, right = rows_of(df.columns, df.collect()), rows_of(relation.columns, relation.fetchall())
    assert left.total() == right.total()
    extra, absent = left - right, right - left
    assert not extra and not absent, f"{extra.total()} extra, e.g. {next(iter(extra), None)}; {next(iter(absent), None)}"
