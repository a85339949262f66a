"""Compares a Spark query with its SQL on the same tables, order aside."""

import datetime
import decimal
import glob
import os

import duckdb


def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return value


def normalised(columns, rows):
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in places) for row in rows), key=repr)


KINDS = {
    "TINYINT": "int", "SMALLINT": "int", "INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string",
    "DOUBLE": "double", "FLOAT": "float", "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz",
}


def compare(spark, sf_dir, query, sql):
    frame = query(spark, sf_dir)
    spark_rows = normalised(frame.columns, [tuple(r) for r in frame.collect()])
    relation = duck(sf_dir).sql(sql)
    assert sorted(frame.columns) == sorted(relation.columns)
    kinds = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    for name, kind in frame.dtypes:
        wanted = KINDS.get(kinds[name], kinds[name].lower().replace(" ", ""))
        assert kind == wanted, (name, kind, kinds[name])
    duck_rows = normalised(relation.columns, relation.fetchall())
    assert len(spark_rows) == len(duck_rows)
    for left, right in zip(spark_rows, duck_rows):
        assert left == right
    return len(spark_rows)
