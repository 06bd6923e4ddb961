"""Compare a Spark result with a DuckDB result, as multisets of rows."""

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(df, relation):
    """Return a description of the first difference, or None."""
    columns = sorted(df.columns)
    if columns != sorted(relation.columns):
        return f"columns {columns} != {sorted(relation.columns)}"
    spark_rows = Counter(tuple(r[c] for c in columns) for r in df.collect())
    position = [relation.columns.index(c) for c in columns]
    duck_rows = Counter(tuple(r[p] for p in position) for r in relation.fetchall())
    if spark_rows == duck_rows:
        return None
    extra, missing = spark_rows - duck_rows, duck_rows - spark_rows
    return (
        f"{sum(spark_rows.values())} vs {sum(duck_rows.values())} rows; "
        f"only Spark: {list(extra.items())[:3]}; only SQL: {list(missing.items())[:3]}"
    )
