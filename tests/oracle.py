"""Compare the queries with their SQL: python tests/oracle.py [sf_dir] [name ...]."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def canonical(value):
    return float(value) if isinstance(value, float) else value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(repr(canonical(row[i])) for i in order) for row in rows)


def sql_rows(sf_dir: str, sql: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    cursor = con.execute(sql)
    types = {column[0]: str(column[1]) for column in cursor.description}
    return rows_of([c[0] for c in cursor.description], cursor.fetchall()), types


def spark_rows(df):
    return rows_of(df.columns, [tuple(row) for row in df.collect()]), dict(df.dtypes)


def difference(spark, sf_dir: str, run, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    (columns, got), types = spark_rows(run(spark, sf_dir))
    (sql_columns, wanted), sql_types = sql_rows(sf_dir, sql)
    if columns != sql_columns:
        return f"columns {columns} / {sql_columns}"
    if got != wanted:
        missing, extra = list((wanted - got).items()), list((got - wanted).items())
        return (
            f"{sum(got.values())} / {sum(wanted.values())} rows; "
            f"{len(missing)} missing {missing[:2]}; {len(extra)} extra {extra[:2]}"
        )
    same = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    odd = [
        (name, kind, sql_types[name])
        for name, kind in types.items()
        if same.get(kind) != sql_types[name]
    ]
    return f"types {odd}" if odd else None


def main() -> None:
    from conftest import session

    import __spark_entry__ as contract

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(contract.queries())
    spark, oracles = session(), contract.oracle_sql()
    for name in names:
        start = time.time()
        try:
            if name in oracles:
                outcome = difference(spark, sf_dir, contract.queries()[name], oracles[name])
            else:
                outcome = f"no SQL, {contract.queries()[name](spark, sf_dir).count()} rows"
        except Exception as error:  # a failing query must not hide the others
            outcome = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:28s} {time.time() - start:6.1f}s {outcome or 'ok'}", flush=True)


if __name__ == "__main__":
    main()
