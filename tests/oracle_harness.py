"""Side-by-side check of a registered Spark query and its DuckDB oracle:
row count, column names, and an order-insensitive hash of the values."""

from __future__ import annotations

import datetime as dt
import math

import duckdb
import pandas as pd

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer() and abs(v) < 2**53:
            return int(v)
        return round(v, 6)
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    if isinstance(v, dt.datetime):
        v = v.replace(tzinfo=None)
        if v.time() == dt.time(0):
            return v.date().isoformat()
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return v
    return str(v)


def rows_of(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(None if (not isinstance(x, (list, tuple)) and pd.isna(x) is True) else x) for x in rec))
    return sorted(out, key=repr)


SPARK_TO_DUCK = {
    "LongType": "BIGINT", "IntegerType": "INTEGER", "ShortType": "SMALLINT", "ByteType": "TINYINT",
    "DoubleType": "DOUBLE", "FloatType": "FLOAT", "StringType": "VARCHAR", "DateType": "DATE",
    "TimestampType": "TIMESTAMP", "TimestampNTZType": "TIMESTAMP", "BooleanType": "BOOLEAN",
}


def type_mismatches(spark_df, sql: str, con) -> dict:
    """Columns whose Spark type does not correspond to the oracle's DuckDB type."""
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    out = {}
    for f in spark_df.schema.fields:
        want = SPARK_TO_DUCK.get(type(f.dataType).__name__, f.dataType.simpleString().upper())
        got = duck_types.get(f.name)
        if got is not None and got != want:
            out[f.name] = (f.dataType.simpleString(), got)
    return out


def compare(spark_df, sql: str, con) -> dict:
    s = spark_df.toPandas()
    d = con.execute(sql).df()
    res = {
        "rows_spark": len(s), "rows_oracle": len(d),
        "cols_match": sorted(s.columns) == sorted(d.columns),
    }
    if not res["cols_match"]:
        res["cols_spark"] = sorted(s.columns)
        res["cols_oracle"] = sorted(d.columns)
        res["match"] = False
        return res
    res["type_mismatches"] = type_mismatches(spark_df, sql, con)
    rs, rd = rows_of(s), rows_of(d)
    res["match"] = rs == rd
    if not res["match"]:
        diffs = [(a, b) for a, b in zip(rs, rd) if a != b][:3]
        res["first_diffs"] = diffs
    return res
