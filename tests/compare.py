"""Strict comparison of a Spark result with the SQL of the same name."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd
from pyspark.sql.types import IntegralType


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _rows(frame):
    frame = frame[sorted(frame.columns)]
    out = []
    for row in frame.itertuples(index=False, name=None):
        out.append(tuple("<null>" if pd.isna(v) else str(v) for v in row))
    return sorted(out)


def differences(spark_df, connection, sql: str) -> list[str]:
    ours, theirs = spark_df.toPandas(), connection.sql(sql).df()
    for field in spark_df.schema:
        # whole numbers with nulls come as floats from one side only
        if isinstance(field.dataType, IntegralType) and ours[field.name].isna().any():
            ours[field.name] = ours[field.name].astype("Int64")
            if field.name in theirs:
                theirs[field.name] = theirs[field.name].astype("Int64")
    faults = []
    if sorted(ours.columns) != sorted(theirs.columns):
        return [f"columns {sorted(ours.columns)} / {sorted(theirs.columns)}"]
    if len(ours) != len(theirs):
        faults.append(f"rows {len(ours)} / {len(theirs)}")
    if len(ours) == 0:
        faults.append("empty")
    for column in ours.columns:
        a, b = str(ours[column].dtype), str(theirs[column].dtype)
        if a != b and {a, b} != {"datetime64[us]", "datetime64[ns]"}:
            faults.append(f"type of {column}: {a} / {b}")
    left, right = _rows(ours), _rows(theirs)
    if left != right:
        only_left, only_right = set(left) - set(right), set(right) - set(left)
        faults.append(
            f"{len(only_left)}/{len(only_right)} differ, {sorted(ours.columns)}: "
            f"{sorted(only_left)[:2]} / {sorted(only_right)[:2]}"
        )
    return faults
