"""Compare a Spark result with a DuckDB result: same columns, same rows, any order."""

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(value):
    if isinstance(value, float):
        return None if math.isnan(value) else ("float", value)
    return value


def bag(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def difference(spark_df, con, sql: str) -> str | None:
    cursor = con.execute(sql)
    expected_names = [d[0] for d in cursor.description]
    if sorted(expected_names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(expected_names)}"
    types = {d[0]: str(d[1]) for d in cursor.description}
    wrong = [(c, t, types[c]) for c, t in spark_df.dtypes if TYPES[t] != types[c]]
    if wrong:
        return f"types {wrong}"
    expected = bag(expected_names, cursor.fetchall())
    actual = bag(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if actual == expected:
        return None
    return (f"{sum(actual.values())} rows, expected {sum(expected.values())}; only Spark: "
            f"{list((actual - expected).items())[:3]}; only SQL: {list((expected - actual).items())[:3]}")
